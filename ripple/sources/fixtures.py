"""Social-network tables derived from the driver's parquet tables.

Every derivation grows linearly with its inputs: equi-joins, one-to-few
explodes and grouped aggregates only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripple.functions import scalars
from ripple.sources.tables import table

# Each user u is befriended with (u * m + 7) mod n for these m.
FRIEND_MULTIPLIERS = (2, 3, 5, 11)

# Stand-in for the current time in presence queries, epoch milliseconds.
NOW_MS = 1_706_659_200_000

# Publication day the recommendation job looks at.
NEWS_DATE = "2017-12-21"


def user(key: str | Column) -> Column:
    return F.concat(F.lit("u"), (F.col(key) if isinstance(key, str) else key).cast("string"))


def millis(ts: str | Column) -> Column:
    return F.unix_millis((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


class Fixtures:
    """The derived tables of one data folder, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    def n_customers(self) -> int:
        return self.raw("customer").count()   # answered from the parquet footers

    # -- people -------------------------------------------------------------

    def friend_edge(self) -> DataFrame:
        """Symmetric friendships, every user also with itself."""
        n = self.n_customers()
        targets = F.array(F.col("a"), *[(F.col("a") * m + 7) % n for m in FRIEND_MULTIPLIERS])
        made = self.raw("customer").select(F.col("c_custkey").alias("a")) \
            .select("a", F.explode(targets).alias("b"))
        return made.unionByName(made.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct() \
            .select(user("a").alias("username"), user("b").alias("friend"))

    def user_interest(self) -> DataFrame:
        """The brands each customer has ordered most often."""
        bought = self.raw("lineitem").join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey")) \
            .join(self.raw("part"), F.col("l_partkey") == F.col("p_partkey")) \
            .groupBy("o_custkey", "p_brand").agg(F.count(F.lit(1)).alias("times"))
        most = bought.groupBy("o_custkey").agg(F.max("times").alias("times"))
        return bought.join(most, ["o_custkey", "times"]).select(user("o_custkey").alias("username"), F.col("p_brand").alias("interest"))

    def users(self) -> DataFrame:
        latest = self.raw("events").groupBy("user_id").agg(F.max(millis("ts")).alias("lastAction"))
        return self.raw("customer").join(latest, F.col("user_id") == F.col("c_custkey"), "left").select(
            user("c_custkey").alias("username"),
            F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string")).alias("firstname"),
            scalars.capitalise(F.col("c_mktsegment")).alias("lastname"),
            F.col("c_mktsegment").alias("affiliation"),
            "lastAction")

    def signups(self) -> DataFrame:
        """Sign-up forms; some lack a field or a second interest."""
        key, money = F.col("c_custkey"), F.col("c_acctbal")
        return self.raw("customer").select(
            user(key).alias("username"),
            scalars.password_hash(F.col("c_name")).alias("password"),
            F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string")).alias("firstname"),
            scalars.capitalise(F.col("c_mktsegment")).alias("lastname"),
            F.when(money < 0, "").otherwise(F.concat(user(key), F.lit("@mail.test"))).alias("email"),
            F.col("c_mktsegment").alias("affiliation"),
            F.when(money >= 9000, F.lit(None).cast("string")).otherwise("1990-01-01").alias("birthday"),
            F.when(money < 1000, F.array(F.lit("Brand#1")))
             .otherwise(F.array(F.concat(F.lit("Brand#"), F.col("c_nationkey").cast("string")),
                                F.lit("Brand#30"))).alias("interests"))

    # -- news ---------------------------------------------------------------

    def newslikes(self) -> DataFrame:
        """Every part a customer has ordered."""
        return self.raw("lineitem").join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey")) \
            .select("o_custkey", "l_partkey").distinct().select(
                user("o_custkey").alias("userid"), F.concat(F.lit("part/"), F.col("l_partkey").cast("string")).alias("url"))

    def news(self) -> DataFrame:
        """News items; the part size stands in for the publication day."""
        return self.raw("part").select(
            F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("url"),
            F.col("p_brand").alias("category"), F.col("p_name").alias("headline"),
            F.date_add(F.lit("2017-12-01").cast("date"), F.col("p_size")).cast("string").alias("date"))

    def article(self) -> DataFrame:
        """Corpus of the keyword index."""
        return self.raw("documents").select(
            F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
            F.get(F.split("text", "\n"), F.lit(0)).alias("headline"),
            F.col("source").alias("category"), F.col("text").alias("body"))

    def search_requests(self) -> DataFrame:
        """What users type in conversations, as search texts."""
        return self.raw("conversations").filter("role = 'user'").select(
            F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"),
            F.col("text"))

    # -- posts, comments, messages -------------------------------------------

    def posts(self) -> DataFrame:
        first_friend = self.friend_edge().filter("friend <> username") \
            .groupBy("username").agg(F.min("friend").alias("friend"))
        events = self.raw("events").filter(F.col("event_type").isin("view", "click", "purchase")) \
            .withColumn("author", user("user_id"))
        wall = F.when(F.col("event_type") == "purchase", F.coalesce("friend", "author")).otherwise(F.col("author"))
        return events.join(first_friend, events.author == first_friend.username, "left").select(
            "event_id", "author", millis("ts").alias("timestamp"),
            F.concat_ws(" ", "event_type", "props").alias("content"),
            F.lit(0).cast("bigint").alias("likes"), wall.alias("isWall"))

    def reactions(self) -> DataFrame:
        comments = self.raw("events").filter("event_type = 'error'").select(
            (F.col("event_id") - 1 - F.col("event_id") % 5).alias("post_id"),
            millis("ts").alias("timestamp"), user("user_id").alias("author"), F.col("props").alias("content"))
        posts = self.raw("events").filter(F.col("event_type").isin("view", "click", "purchase")).select(
            F.col("event_id").alias("post_id"),
            scalars.post_key(user("user_id"), millis("ts")).alias("authortime"))
        return comments.join(posts, "post_id").select("authortime", "timestamp", "author", "content")

    def messages(self) -> DataFrame:
        return self.raw("conversations").select(
            F.concat(F.lit("room"), F.col("conv_id").cast("string")).alias("groupid"),
            (F.lit(1_700_000_000_000) + F.col("conv_id") * 100_000 + F.col("turn") * 1_000)
            .cast("string").alias("timestamp"),
            F.col("text").alias("message"), F.col("role").alias("author"))

    # -- logs and requests, one row per event ---------------------------------

    def _events(self) -> DataFrame:
        k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
        return self.raw("events").withColumn("k", k).withColumn("actor", user("user_id"))

    def friend_ops(self) -> DataFrame:
        return self._events().select(
            "event_id", "ts", F.col("actor").alias("sender"), user(F.col("k") % 10).alias("receiver"),
            F.when(F.col("event_type") == "error", "DELETE").otherwise("ADD").alias("op"))

    def profile_log(self) -> DataFrame:
        """One changed field per row; a list of interests is joined by comma."""
        brand = [F.concat(F.lit("Brand#"), ((F.col("k") + d) % 25).cast("string")) for d in (0, 7, 11)]
        kind = F.col("event_type")
        return self._events().select(
            "event_id", millis("ts").alias("ts"), F.col("actor").alias("username"),
            F.when(kind == "view", "affiliation").when(kind == "click", "email")
             .when(kind == "error", "password").when(kind == "signup", "interests")
             .otherwise("lastAction").alias("field"),
            F.when(kind == "view", F.concat(F.lit("Org_"), (F.col("k") % 12).cast("string")))
             .when(kind == "click", F.concat(F.col("actor"), F.lit("."), F.col("k").cast("string"), F.lit("@mail.test")))
             .when(kind == "error", scalars.password_hash(F.col("props")))
             .when((kind == "signup") & (F.col("k") % 2 == 0), F.concat_ws(",", *brand))
             .when(kind == "signup", F.concat_ws(",", *brand[:2]))
             .otherwise(millis("ts").cast("string")).alias("value"))

    def room_log(self) -> DataFrame:
        """Users entering and leaving rooms; the room is typed as a list of users."""
        room = scalars.room_id(user(F.col("k") % 10), F.col("actor"))
        return self._events().filter("event_type in ('signup', 'click', 'error')").select(
            "event_id", millis("ts").alias("ts"), F.col("actor").alias("username"), room.alias("room"),
            F.when(F.col("event_type") == "error", "LEAVE").otherwise("JOIN").alias("op"))

    def invite_log(self) -> DataFrame:
        """Chat invites: sent, declined or accepted. The sender is a user, or a group's room."""
        kind, n = F.col("event_type"), self.n_customers()
        group = scalars.room_id(user((F.col("user_id") * 2 + 7) % n), user((F.col("user_id") * 3 + 7) % n))
        return self._events().select(
            "event_id", millis("ts").alias("ts"), F.col("actor").alias("receiver"),
            F.when(F.col("k") % 4 == 3, group).otherwise(user(F.col("k") % 10)).alias("sender"),
            F.when(kind == "error", "DECLINE").when(kind == "purchase", "ACCEPT").otherwise("INVITE").alias("op"))

    def group_requests(self) -> DataFrame:
        """Requests to open a group chat; not all named users are friends of the sender."""
        n = self.n_customers()
        u = F.col("user_id")
        return self._events().filter("event_type = 'signup'").select(
            F.col("event_id").alias("request_id"), F.col("actor").alias("sender"),
            F.concat_ws(",", user((u * 2 + 7) % n), user((u * (F.col("k") % 6) + 7) % n)).alias("participants"))

    def group_invites(self) -> DataFrame:
        """Who invites whom into which group's room."""
        n = self.n_customers()
        return self._events().filter("event_type = 'click'").select(
            F.col("event_id").alias("request_id"), F.col("actor").alias("inviter"),
            scalars.room_id(user((F.col("user_id") * 5 + 7) % n), F.col("actor")).alias("room"),
            user((F.col("user_id") * (F.col("k") % 4 + 1) + 7) % n).alias("receiver"))

    def form_rows(self) -> DataFrame:
        """What users type into the forms of the site; some fields are left empty."""
        kinds = ("comment", "post", "email", "password", "affiliation", "interests")
        kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("event_id") % 6 + 1).cast("int"))
        return self._events().select(
            "event_id", kind.alias("kind"),
            F.when(F.col("k") % 5 == 0, "").when(F.col("k") % 7 == 0, F.lit(None).cast("string"))
             .when(F.col("k") % 2 == 0, F.col("props")).otherwise(F.concat(F.lit("Brand#1,Brand#"), F.col("k").cast("string"))).alias("value"))

    def graph_requests(self) -> DataFrame:
        """Who opens whose node in the friend graph: each commenter looks at the author of the post."""
        return self.reactions().select(
            F.col("author").alias("viewer"), F.get(F.split("authortime", "[$]"), F.lit(0)).alias("user")).distinct()

    def rank_edge(self) -> DataFrame:
        """Directed graph with sinks."""
        n = self.raw("part").count()
        part, supplier = F.col("l_partkey"), F.col("l_suppkey")
        # from parts to parts, and to suppliers, which are numbered after the parts and have no edge out
        ends = F.explode(F.array((part * 7 + supplier) % n, supplier + n + 1))
        return self.raw("lineitem").select(part.alias("src"), ends.alias("dst")).distinct()
