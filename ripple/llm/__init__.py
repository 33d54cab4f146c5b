"""Operators a training-data pipeline needs, each over whole tables."""
