"""Social-network analytics as Spark DataFrame operators."""
