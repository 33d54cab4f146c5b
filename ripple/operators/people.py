"""People search, presence, relationships and friend expansion.

``friend_edge`` holds each (username, friend) once, as it comes from sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripple.functions import scalars
from ripple.session import Scratch


def people_search(users: DataFrame, text: str) -> DataFrame:
    """Users whose first name contains the first word and whose last name the second.

    Both words are capitalised and matched with case; a missing second word
    matches every last name, further words are ignored.
    """
    first, last = (scalars.capitalise(scalars.token(F.lit(text), i)) for i in (1, 2))
    return users.filter(F.contains("firstname", first) & F.contains("lastname", last)) \
        .select("username", "firstname", "lastname")


def _grams(text: Column) -> Column:
    """All strings of at most three characters in a text, each once, the empty one too."""
    def of(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))
    lists = [F.when(F.length(text) >= n, of(n)).otherwise(F.array().cast("array<string>")) for n in (1, 2, 3)]
    return F.array_distinct(F.concat(F.array(F.lit("")), *lists))


def people_search_each(users: DataFrame, searches: DataFrame) -> DataFrame:
    """Users that each text of a table (column ``text``) finds, by the rules of :func:`people_search`.

    Distinct names are indexed by the strings of up to three characters in them. Of a text's own strings, of three
    characters where its words are that long, the one that the fewest names have brings it to its candidates, which are then
    checked; so no text is compared with all names unless it is empty.
    """
    run = Scratch(users.sparkSession, "people-search")
    names = run.save(users.select("firstname", "lastname").distinct(), "names")
    index = run.save(names.select("firstname", "lastname", F.explode(F.array(
        F.struct(F.lit("firstname").alias("of"), _grams(F.col("firstname")).alias("grams")),
        F.struct(F.lit("lastname").alias("of"), _grams(F.col("lastname")).alias("grams")))).alias("x"))
        .select("firstname", "lastname", "x.of", F.explode("x.grams").alias("gram")), "index")
    counts = index.groupBy("of", "gram").agg(F.count(F.lit(1)).alias("n"))

    words = searches.select("text").distinct().select(
        "text", *[scalars.capitalise(scalars.token(F.col("text"), i)).alias(c) for i, c in ((1, "first"), (2, "last"))])

    def longest(word: str) -> Column:
        return F.filter(_grams(F.col(word)), lambda g: F.length(g) == F.least(F.length(word), F.lit(3)))
    asked = words.select("text", "first", "last", F.explode(F.array(
        F.struct(F.lit("firstname").alias("of"), longest("first").alias("grams")), F.struct(F.lit("lastname").alias("of"), longest("last").alias("grams")))).alias("x")) \
        .select("text", "first", "last", "x.of", F.explode("x.grams").alias("gram"))
    # a string that no name has ends the search for its text
    rarest = asked.join(counts, ["of", "gram"], "left").groupBy("text", "first", "last") \
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "of", "gram")).alias("by")).filter("by.n > 0") \
        .select("text", "first", "last", "by.of", "by.gram")
    found = run.save(rarest, "rarest").join(index, ["of", "gram"]) \
        .filter(F.contains("firstname", "first") & F.contains("lastname", "last")).select("text", "firstname", "lastname")
    return found.join(users.select("username", "firstname", "lastname"), ["firstname", "lastname"]) \
        .select("text", "username", "firstname", "lastname")


def last_action(activity: DataFrame) -> DataFrame:
    """Latest action per user from (username, ts)."""
    return activity.groupBy("username").agg(F.max("ts").alias("last_action"))


def presence(users: DataFrame, now_ms: int, window_ms: int = scalars.ONLINE_WINDOW_MS) -> DataFrame:
    return users.select(
        "username", scalars.is_online(F.col("lastAction"), F.lit(now_ms), window_ms).alias("online"))


def friends_online(friend_edge: DataFrame, users: DataFrame, now_ms: int, viewer: str | None = None,
                   window_ms: int = scalars.ONLINE_WINDOW_MS) -> DataFrame:
    """Friends list with presence, for one viewer or for all."""
    edges = friend_edge if viewer is None else friend_edge.filter(F.col("username") == viewer)
    online = presence(users, now_ms, window_ms).withColumnRenamed("username", "friend")
    return edges.filter("username <> friend").join(online, "friend").select("username", "friend", "online")


def relationship(friend_edge: DataFrame, pairs: DataFrame) -> DataFrame:
    """For (viewer, owner): self, friend or stranger."""
    friends = friend_edge.select(F.col("username").alias("viewer"), F.col("friend").alias("owner"),
                                 F.lit(True).alias("is_friend"))
    return pairs.join(friends, ["viewer", "owner"], "left").select(
        "viewer", "owner",
        F.when(F.col("viewer") == F.col("owner"), "self").when(F.col("is_friend"), "friend")
         .otherwise("stranger").alias("relation"))


# Fields and messages of the site's forms.
SIGNUP_FIELDS = ("username", "password", "firstname", "lastname", "email", "affiliation", "birthday")
FEW_INTERESTS = "You must have at least two interests."
EMPTY_FIELD = "All input fields need to be completed!"


def validate_users(rows: DataFrame) -> DataFrame:
    """Sign-up rows with a flag and, where refused, the reason. The interests are looked at first."""
    empty: Column = F.lit(False)
    for field in SIGNUP_FIELDS:
        empty = empty | (F.coalesce(F.length(field), F.lit(0)) == 0)
    reason = F.when(F.coalesce(F.size("interests"), F.lit(0)) < 2, FEW_INTERESTS).when(empty, EMPTY_FIELD)
    return rows.withColumn("reason", reason).withColumn("ok", F.col("reason").isNull())


# Messages of the site's forms.
EMPTY_FORM = {
    "comment": "You cannot make an empty comment",
    "post": "You cannot make an empty post",
    "email": "You cannot change to an empty email",
    "password": "You cannot change to an empty password",
    "affiliation": "You cannot change to an empty affiliation",
}


def validate_rows(rows: DataFrame) -> DataFrame:
    """Form rows (kind, value) with a flag and, where refused, the reason: texts may not be empty, a list of interests
    (joined by comma) has at least two."""
    empty = F.coalesce(F.length("value"), F.lit(0)) == 0
    reason = F.when((F.col("kind") == "interests") & (empty | (F.size(F.split("value", ",")) < 2)), FEW_INTERESTS)
    for kind, message in EMPTY_FORM.items():
        reason = reason.when((F.col("kind") == kind) & empty, message)
    return rows.withColumn("reason", reason).withColumn("ok", F.col("reason").isNull())


def friend_expand(friend_edge: DataFrame, users: DataFrame, viewer: str | None = None) -> DataFrame:
    """Friends of a viewer (or of all) with their first names, without the viewer."""
    edges = friend_edge if viewer is None else friend_edge.filter(F.col("username") == viewer)
    names = users.select(F.col("username").alias("friend"), "firstname")
    return edges.filter("username <> friend").join(names, "friend") \
        .select(F.col("username").alias("viewer"), "friend", "firstname")


def friend_expand_visible(friend_edge: DataFrame, users: DataFrame, requests: DataFrame) -> DataFrame:
    """Friends of ``user`` that ``viewer`` may see, for each request (viewer, user).

    A friend shows when it is a friend of the viewer, who is one of their own
    friends, or shares the viewer's affiliation.
    """
    # the viewer's affiliation joins the requests, before they fan out
    asked = requests.select("viewer", "user").distinct().join(
        users.select(F.col("username").alias("viewer"), F.col("affiliation").alias("viewer_affiliation")),
        "viewer", "left")
    mine = friend_edge.select(F.col("username").alias("viewer"), F.col("friend"), F.lit(True).alias("is_friend"))
    about = users.select(F.col("username").alias("friend"), "firstname", "affiliation")
    # names join the edges, also before the fan-out, once per edge
    theirs = friend_edge.filter("username <> friend").join(about, "friend").withColumnRenamed("username", "user")
    return asked.join(theirs, "user").join(mine, ["viewer", "friend"], "left") \
        .filter(F.col("is_friend") | (F.col("affiliation") == F.col("viewer_affiliation"))) \
        .select("viewer", "user", "friend", "firstname")


def invite_check(friend_edge: DataFrame, requests: DataFrame) -> DataFrame:
    """Group-chat requests (request_id, sender, participants): is every named user a friend of the sender?

    The sender is one of the participants, and one of their own friends.
    """
    named = requests.select(
        "request_id", "sender",
        F.explode(F.array_append(F.split("participants", ","), F.col("sender"))).alias("friend"))
    friends = friend_edge.select(F.col("username").alias("sender"), "friend", F.lit(True).alias("is_friend"))
    return named.join(friends, ["sender", "friend"], "left") \
        .groupBy("request_id", "sender").agg(F.bool_and(F.coalesce("is_friend", F.lit(False))).alias("allowed"))


def invite_new(requests: DataFrame, friend_edge: DataFrame, invites: DataFrame, rooms: DataFrame) -> DataFrame:
    """Requests (sender, receiver) that lead to an invite.

    The receiver is a friend of the sender, has no invite from the sender yet
    and is not yet in the room of the two.
    """
    asked = requests.select("sender", "receiver").distinct() \
        .withColumn("room", scalars.room_id(F.col("receiver"), F.col("sender")))
    friends = friend_edge.select(F.col("username").alias("sender"), F.col("friend").alias("receiver"))
    return asked.join(friends, ["sender", "receiver"], "left_semi") \
        .join(invites.select("receiver", "sender"), ["receiver", "sender"], "left_anti") \
        .join(rooms.select(F.col("username").alias("receiver"), "room"), ["receiver", "room"], "left_anti") \
        .select("sender", "receiver")


def group_invite_new(requests: DataFrame, friend_edge: DataFrame, invites: DataFrame) -> DataFrame:
    """Requests (inviter, room, receiver) that lead to an invite into a group's room; the room is stored as its sender.

    The receiver is a friend of the inviter and has no open invite under the inviter's own name. Whether the
    receiver is in the room already is not asked.
    """
    friends = friend_edge.select(F.col("username").alias("inviter"), F.col("friend").alias("receiver"))
    open_ = invites.select(F.col("sender").alias("inviter"), "receiver")
    return requests.join(friends, ["inviter", "receiver"], "left_semi").join(open_, ["inviter", "receiver"], "left_anti") \
        .select(F.col("room").alias("sender"), "receiver").distinct()
