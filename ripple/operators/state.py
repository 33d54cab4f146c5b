"""Present state from logs of changes, for all keys at once.

Each fold keeps the newest change per key with ``max_by``, which is combined on
the map side: a key with a third of all changes sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripple.functions import scalars
from ripple.session import Scratch


def _newest(log: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Last ``value`` per key; changes at the same time go by event id."""
    return log.groupBy(*keys).agg(
        F.max_by(value, F.struct("ts", "event_id")).alias(value), F.max(F.struct("ts", "event_id")).alias("at"))


def new_users(rows: DataFrame, now_ms: int) -> tuple[DataFrame, DataFrame]:
    """Accepted sign-ups as (user rows, friend edges); a new user is its own first friend.

    The password is kept as a hash, interests as a set; a new user has no rooms and no invites.
    """
    none = F.array().cast("array<string>")
    users = rows.select(
        "username", scalars.password_hash(F.col("password")).alias("password"), "firstname", "lastname", "email",
        "affiliation", "birthday", F.array_sort(F.array_distinct("interests")).alias("interests"),
        F.lit(now_ms).cast("bigint").alias("lastAction"), none.alias("chatInvites"), none.alias("rooms"))
    return users, rows.select("username", F.col("username").alias("friend"))


def profile_latest(log: DataFrame) -> DataFrame:
    """Present value of each field of each user from (event_id, ts, username, field, value)."""
    return _newest(log, ["username", "field"], "value").select("username", "field", "value")


def derived_posts(log: DataFrame) -> DataFrame:
    """Posts that changes of affiliation or interests bring about."""
    interests = F.split("value", ",")
    content = F.when(F.col("field") == "affiliation", scalars.affiliation_post(F.col("value"))) \
        .otherwise(scalars.interests_post(interests))
    return log.filter(F.col("field").isin("affiliation", "interests")).select(
        F.col("username").alias("author"), F.col("ts").alias("timestamp"), content.alias("content"),
        F.lit(0).cast("bigint").alias("likes"), F.col("username").alias("isWall"))


def mirrored_friend_ops(log: DataFrame) -> DataFrame:
    """The newest operation for each ordered pair of users; an operation concerns both sides.

    The result has the shape of a log of ordered pairs, so parts of a log can
    be reduced on their own and reduced again together.
    """
    columns = ["ts", "event_id", "op"]
    one = log.select(F.col("sender").alias("username"), F.col("receiver").alias("friend"), *columns)
    other = log.select(F.col("receiver").alias("username"), F.col("sender").alias("friend"), *columns)
    return newest_friend_ops(one.unionByName(other))


def newest_friend_ops(ops: DataFrame) -> DataFrame:
    return _newest(ops, ["username", "friend"], "op").select("username", "friend", "op", "at.ts", "at.event_id")


def friends_of(ops: DataFrame) -> DataFrame:
    """Friend edges from the newest operations; every user seen is also their own friend.

    A user may unfriend themselves in the log, which leaves no edge to self removed.
    """
    others = ops.filter("op = 'ADD' and username <> friend").select("username", "friend")
    selves = ops.select("username").distinct().select("username", F.col("username").alias("friend"))
    return others.unionByName(selves)


def friend_state(log: DataFrame) -> DataFrame:
    """Friend edges after a log of (event_id, ts, sender, receiver, op), op ADD or DELETE."""
    return friends_of(mirrored_friend_ops(log))


def _present(log: DataFrame, keys: list[str], enter: str) -> DataFrame:
    """Keys that an ``enter`` added since any other operation removed them, with the time of the first such ``enter``.

    A second ``enter`` changes nothing, so the list order of entries is that of the first. Two aggregates that
    are combined on the map side. The last removals are written in between: the join with them then has no aggregate on its
    key, and adaptive execution splits a key with very many entries. Removals and entries are different rows of the log.
    """
    at = F.struct("ts", "event_id")
    removed = Scratch(log.sparkSession, "removals").save(
        log.filter(F.col("op") != enter).groupBy(*keys).agg(F.max(at).alias("removed")), "table")
    known = log.filter(F.col("op") == enter).join(removed, keys, "left")
    return known.filter(F.col("removed").isNull() | (at > F.col("removed"))).groupBy(*keys) \
        .agg(F.min(at)["ts"].alias("since"))


def room_state(log: DataFrame) -> DataFrame:
    """Rooms each user is in after a log of (event_id, ts, username, room, op), op JOIN or LEAVE."""
    return _present(log, ["username", "room"], "JOIN")


def invite_state(log: DataFrame) -> DataFrame:
    """Open invites after a log of (event_id, ts, receiver, sender, op), op INVITE, DECLINE or ACCEPT.

    Declining or accepting removes the invite of that sender and no other.
    """
    return _present(log, ["receiver", "sender"], "INVITE")


def accepted_rooms(log: DataFrame, friend_edge: DataFrame | None = None) -> DataFrame:
    """Room changes that accepted invites bring about: everyone concerned joins the room.

    The sender of an invite is a user, or for a group the room's list of users; the room is theirs and the
    receiver's. With ``friend_edge``, an acceptance counts only if the receiver is a friend of everyone
    in the room. Same shape as the log of :func:`room_state`.
    """
    everyone = F.array_append(F.split("sender", ","), F.col("receiver"))
    accepted = log.filter("op = 'ACCEPT'").withColumn("members", F.array_distinct(everyone)) \
        .withColumn("room", F.array_join(F.array_sort(everyone), ","))
    if friend_edge is not None:
        friends = friend_edge.select(F.col("username").alias("receiver"), F.col("friend").alias("member"))
        strangers = accepted.select("event_id", "receiver", F.explode("members").alias("member")) \
            .join(friends, ["receiver", "member"], "left_anti")
        accepted = accepted.join(strangers.select("event_id").distinct(), "event_id", "left_anti")
    return accepted.select("event_id", "ts", F.explode("members").alias("username"), "room", F.lit("JOIN").alias("op"))
