"""Present state from a saved snapshot and the rows of a log that came after it.

A snapshot is the fold of the log up to some event id. Bringing it up to date folds the newer rows alone and joins them in
by key. A key whose newer rows all lie after everything the snapshot has seen of it needs no more; a key with a late row,
one that is newer by id but older by time, is folded again from its own part of the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_rows(log: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Last ``value`` of each key with its ``ts`` and ``event_id``: a snapshot of the changes in a log."""
    at = F.struct("ts", "event_id")
    return log.groupBy(*keys).agg(F.max_by(value, at).alias(value), F.max(at).alias("at")).select(*keys, value, "at.ts", "at.event_id")


def advance_newest(snapshot: DataFrame, newer: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The snapshot with newer rows of the log. Late rows need no care: the larger time wins on either side."""
    return newest_rows(snapshot.unionByName(newer.select(*keys, value, "ts", "event_id")), keys, value)


def presences(log: DataFrame, keys: list[str], enter: str) -> DataFrame:
    """What is known of each key: the last removal, the first ``enter`` after it, and the first and last row.

    Each a (ts, event_id); null if there is none.
    """
    at = F.struct(F.col("ts").cast("bigint").alias("ts"), F.col("event_id").cast("bigint").alias("event_id"))
    rows = log.select(*keys, (F.col("op") == enter).alias("enters"), at.alias("at"))
    removed = rows.groupBy(*keys).agg(F.max(F.when(~F.col("enters"), F.col("at"))).alias("removed"),
                                      F.min("at").alias("first"), F.max("at").alias("last"))
    since = rows.filter("enters").join(removed.select(*keys, "removed"), keys) \
        .filter(F.col("removed").isNull() | (F.col("at") > F.col("removed"))).groupBy(*keys).agg(F.min("at").alias("since"))
    return removed.join(since, keys, "left").select(*keys, "removed", "since", "first", "last")


def advance_presences(snapshot: DataFrame, log: DataFrame, upto: int, keys: list[str], enter: str) -> DataFrame:
    """The snapshot of :func:`presences` up to event ``upto``, brought to the end of the log.

    The whole log is read for the keys with late rows only.
    """
    newer = presences(log.filter(F.col("event_id") > upto), keys, enter)

    def named(rows: DataFrame, side: str) -> DataFrame:
        return rows.select(*keys, *[F.col(c).alias(f"{side}_{c}") for c in ("removed", "since", "first", "last")])
    both = named(snapshot, "old").join(named(newer, "new"), keys, "full")
    late = F.coalesce(F.col("new_first") < F.col("old_last"), F.lit(False))
    merged = both.filter(~late).select(
        *keys, F.coalesce("new_removed", "old_removed").alias("removed"),
        # a removal among the newer rows ends what was before
        F.when(F.col("new_removed").isNotNull(), F.col("new_since")).otherwise(F.coalesce("old_since", "new_since")).alias("since"),
        F.coalesce("old_first", "new_first").alias("first"), F.coalesce("new_last", "old_last").alias("last"))
    again = presences(log.join(both.filter(late).select(*keys), keys, "left_semi"), keys, enter)
    return merged.unionByName(again)


def present(snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are in, with the time since when: the rows of ``state.room_state`` and ``state.invite_state``."""
    return snapshot.filter(F.col("since").isNotNull()).select(*keys, F.col("since.ts").alias("since"))


def thirds(log: DataFrame, n: int = 3) -> list[int]:
    """Event ids that cut a log into ``n`` parts of about equal width; the last is its largest id."""
    low, high = log.agg(F.min("event_id"), F.max("event_id")).first()
    return [] if low is None else [low + (high - low) * i // n for i in range(1, n + 1)]


def up_to(log: DataFrame, event_id: int) -> DataFrame:
    return log.filter(F.col("event_id") <= event_id)
