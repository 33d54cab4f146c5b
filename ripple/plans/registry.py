"""Every query by name: operators applied to the derived tables of one data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripple.functions import scalars
from ripple.operators import edges, feeds, people, propagation, rank, search, snapshots, state
from ripple.session import Scratch, prepare
from ripple.sources import tables
from ripple.sources.fixtures import NEWS_DATE, NOW_MS, Fixtures, millis, user
from ripple.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Callable[[Fixtures], DataFrame]] = {}

# Text typed into people search; the third word is ignored.
PEOPLE_SEARCH = "nation_1 auto extra"
EARLY_STOP = 0.6
RANK_DMAX = 0.001
# Words of a stop list made from the articles.
STOP_WORDS = 500
# Whose pages the lookups show.
PAGE_USER = "u1"
# Batches of the streams whose batches matter.
STREAM_BATCHES = 4


def query(f: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    def bind(f: Callable[[Fixtures], DataFrame]) -> Query:
        return lambda spark, folder: f(Fixtures(prepare(spark), folder))
    return {name: bind(f) for name, f in _QUERIES.items()}


class StreamFixtures(Fixtures):
    """The same derivations over one table read as a stream of several batches: its rows, dealt over files."""

    def __init__(self, base: Fixtures, streamed: str, by: str, batches: int = 4):
        super().__init__(base.spark, base.folder)
        self.streamed, self.files = streamed, Scratch(base.spark, f"stream-{streamed}")
        super().raw(streamed).repartitionByRange(batches, by).write.parquet(self.files.path("in"))

    def raw(self, name: str) -> DataFrame:
        static = super().raw(name)
        if name != self.streamed:
            return static
        return streams.read_stream(self.spark, self.files.path("in"), "part-", static.schema, files_per_batch=1)


# -- the graph -------------------------------------------------------------------

def _kind_inputs(f: Fixtures, date: str | None) -> tuple[DataFrame, ...]:
    """The base edges, written once: degrees and weights, in both directions, read them from there."""
    run = Scratch(f.spark, "base-edges")
    return (run.save(edges.friend_edges(f.friend_edge()), "friends"), run.save(edges.like_edges(f.newslikes()), "likes"),
            run.save(edges.interest_edges(f.user_interest()), "interests"),
            run.save(edges.article_edges(edges.news_for_date(f.news(), date)), "articles"))


def graph(f: Fixtures, date: str | None = NEWS_DATE) -> DataFrame:
    return edges.weighted_edges(*_kind_inputs(f, date))


def seeds(f: Fixtures) -> DataFrame:
    """Users with at least one interest."""
    return f.user_interest().select(F.col("username").alias("node")).distinct()


def day_recommendations(f: Fixtures) -> DataFrame:
    articles = edges.news_for_date(f.news(), NEWS_DATE).select("url")
    labels = propagation.propagate(seeds(f), graph(f), keep=articles.withColumnRenamed("url", "node"))
    return propagation.recommendations(labels, articles)


def _weights(rows: DataFrame) -> DataFrame:
    """For comparison with SQL; last, as whatever ranks by weight needs all of it."""
    return rows.withColumn("weight", scalars.quantise(F.col("weight")))


def _labels(labels: DataFrame) -> DataFrame:
    return labels.withColumn("w", scalars.quantise(F.col("w")))


@query
def edge_list_scan(f):
    path = Scratch(f.spark, "edge-list").path("text")
    tables.write_edge_list(f.rank_edge(), path)
    return tables.read_edge_list(f.spark, path)


@query
def graph_stats(f):
    return edges.graph_stats(f.rank_edge())


@query
def friend_edges(f):
    return edges.friend_edges(f.friend_edge())


@query
def like_edges(f):
    return edges.like_edges(f.newslikes())


@query
def interest_edges(f):
    return edges.interest_edges(f.user_interest())


@query
def news_for_date(f):
    return edges.news_for_date(f.news(), NEWS_DATE)


@query
def news_all(f):
    return edges.news_for_date(f.news())


@query
def node_degrees(f):
    return edges.node_degrees(edges.edge_kinds(*_kind_inputs(f, NEWS_DATE)))


@query
def weighted_edges(f):
    return graph(f).withColumn("w", scalars.quantise(F.col("w")))


@query
def shared_ids(f):
    """Empty unless a user, a url and an interest or category share a name."""
    return edges.shared_ids(f.users().select(F.col("username").alias("node")),
                            f.news().select(F.col("url").alias("node")),
                            f.user_interest().select(F.col("interest").alias("node"))
                             .unionByName(f.news().select(F.col("category").alias("node"))))


@query
def label_propagation(f):
    return _labels(propagation.propagate(seeds(f), graph(f)))


@query
def label_propagation_early_stop(f):
    return _labels(propagation.propagate(seeds(f), graph(f), threshold=EARLY_STOP))


@query
def label_delta(f):
    # below 0 no round stops the loop
    before, after = propagation.last_two(seeds(f), graph(f), rounds=3, threshold=-1.0, packed=True)
    return propagation.label_delta(before, after).withColumn("max_delta", scalars.quantise(F.col("max_delta")))


@query
def recommendations(f):
    return _weights(day_recommendations(f))


@query
def recommendations_all_nodes(f):
    labels = propagation.propagate(seeds(f), graph(f, date=None))
    return propagation.recommendations(labels).withColumn("weight", scalars.quantise(F.col("weight")))


@query
def recommendations_upsert(f):
    stored = f.newslikes().select(F.col("userid").alias("username"), "url", F.lit(0.25).alias("weight"))
    fresh = f.user_interest().join(edges.news_for_date(f.news(), NEWS_DATE),
                                   F.col("interest") == F.col("category")) \
        .select("username", "url", F.lit(0.75).alias("weight"))
    return tables.upsert(stored, fresh, ["username", "url"])


@query
def recommendations_table(f):
    """The stored table, read back."""
    path = Scratch(f.spark, "recommendations").path("table")
    likes = f.newslikes().select(F.col("userid").alias("username"), "url")
    number = F.substring("url", 6, 20).cast("bigint")
    tables.write_recommendations(likes.withColumn("weight", F.lit(0.5)), path)
    # a second run: other users' rows stay, equal keys get the new weight
    tables.write_recommendations(likes.withColumn("weight", (number % 7) / 8).filter(number % 3 == 0), path)
    return tables.read_stored(f.spark, path)


@query
def top_recommendations(f):
    return _weights(feeds.top_recommendations(day_recommendations(f)))


@query
def news_feed(f):
    return _weights(feeds.news_feed(day_recommendations(f), f.news()))


# -- ranks -----------------------------------------------------------------------

def _rank_graph(f: Fixtures) -> DataFrame:
    """Intended chain: distinct edges, sinks, edges back from the sinks."""
    network = edges.graph_distinct(f.rank_edge())
    return edges.add_backlinks(network, edges.sinks(network))


@query
def graph_distinct(f):
    lineitem = f.raw("lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))
    return edges.graph_distinct(lineitem)


@query
def degree_table(f):
    return edges.degree_table(f.rank_edge())


@query
def graph_sinks(f):
    return edges.sinks(f.rank_edge())


@query
def graph_backlinks(f):
    return _rank_graph(f)


@query
def social_rank(f):
    return rank.social_rank(_rank_graph(f)).withColumn("r", scalars.quantise(F.col("r")))


@query
def social_rank_converged(f):
    return rank.social_rank(_rank_graph(f), dmax=RANK_DMAX).withColumn("r", scalars.quantise(F.col("r")))


@query
def social_rank_top10(f):
    return rank.top_ranks(rank.social_rank(_rank_graph(f))).withColumn("r", scalars.quantise(F.col("r")))


# -- feeds and lookups -------------------------------------------------------------

@query
def posts_by_author(f):
    return feeds.posts_by_author(f.posts(), f.users().select(F.col("username").alias("author")))


@query
def comments_by_post(f):
    keys = f.posts().select(scalars.post_key(F.col("author"), F.col("timestamp")).alias("authortime"))
    return feeds.comments_by_post(f.reactions(), keys)


@query
def messages_by_room(f):
    return feeds.messages_by_room(f.messages(), viewer="user")


# One page each: a table stored by key, of which the lookup reads one bucket.

def _keyed(f: Fixtures, rows: DataFrame, key: str, order: list[str], name: str) -> str:
    path = Scratch(f.spark, f"keyed-{name}").path("table")
    tables.write_keyed(rows, path, key, order)
    return path


def _posts_of(f: Fixtures, path: str, friends: DataFrame) -> DataFrame:
    return tables.lookup_each(f.spark, path, "author", friends.select(F.col("friend").alias("author")))


@query
def one_author_posts(f):
    return tables.lookup(f.spark, _keyed(f, f.posts(), "author", ["timestamp"], "posts"), "author", PAGE_USER)


@query
def one_post_comments(f):
    path = _keyed(f, f.reactions(), "authortime", ["timestamp"], "comments")
    key = f.reactions().agg(F.min("authortime")).first()[0]
    return tables.lookup(f.spark, path, "authortime", key or "")


@query
def one_room_messages(f):
    path = _keyed(f, f.messages(), "groupid", ["timestamp"], "messages")
    key = f.messages().agg(F.min("groupid")).first()[0]
    return feeds.messages_by_room(tables.lookup(f.spark, path, "groupid", key or ""), viewer="user")


@query
def one_user_recommendations(f):
    """Top five of one user's stored recommendations, with their headlines."""
    likes = f.newslikes().select(F.col("userid").alias("username"), "url")
    number = F.substring("url", 6, 20).cast("bigint")
    path = Scratch(f.spark, "recommendations").path("table")
    tables.write_recommendations(likes.withColumn("weight", (number % 7) / 8), path)
    return feeds.news_feed(tables.lookup(f.spark, path, "username", PAGE_USER), f.news())


@query
def one_user_feed(f):
    friends = tables.lookup(f.spark, _keyed(f, f.friend_edge(), "username", ["friend"], "friends"), "username", PAGE_USER)
    posts = _posts_of(f, _keyed(f, f.posts(), "author", ["timestamp"], "posts"), friends)
    return feeds.friend_feed(friends, posts, f.reactions(), PAGE_USER) \
        .withColumn("comment_timestamp", F.col("comment_timestamp").cast("string"))


@query
def one_user_wall(f):
    friends = tables.lookup(f.spark, _keyed(f, f.friend_edge(), "username", ["friend"], "friends"), "username", PAGE_USER)
    posts = tables.lookup(f.spark, _keyed(f, f.posts(), "isWall", ["timestamp"], "walls"), "isWall", PAGE_USER)
    return feeds.wall_feed(friends, posts, f.reactions(), PAGE_USER) \
        .withColumn("comment_timestamp", F.col("comment_timestamp").cast("string"))


@query
def posts_append(f):
    """All posts as the table, the derived posts as the rows to add."""
    columns = ["author", "timestamp", "content", "likes", "isWall"]
    stored = f.posts().select(*columns).withColumn("batch", F.struct(F.lit(0), F.col("content")))
    fresh = state.derived_posts(f.profile_log()).withColumn("batch", F.struct(F.lit(1), F.col("content")))
    return tables.append_rows(stored, fresh, ["author", "timestamp"], "batch").drop("batch")


@query
def friend_feed(f):
    return feeds.friend_feed(f.friend_edge(), f.posts(), f.reactions()) \
        .withColumn("comment_timestamp", F.col("comment_timestamp").cast("string"))


@query
def wall_feed(f):
    return feeds.wall_feed(f.friend_edge(), f.posts(), f.reactions()) \
        .withColumn("comment_timestamp", F.col("comment_timestamp").cast("string"))


# -- people ------------------------------------------------------------------------

@query
def people_search(f):
    return people.people_search(f.users(), PEOPLE_SEARCH)


@query
def people_search_each(f):
    """All texts that were typed into people search."""
    segment = F.when(F.col("c_custkey") % 4 == 0, "").otherwise(
        F.concat(F.lit(" "), F.lower(F.left("c_mktsegment", (F.col("c_custkey") % 4).cast("int") + 1))))
    typed = f.raw("customer").select(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"), segment).alias("text"))
    return people.people_search_each(f.users(), typed)


@query
def last_action(f):
    return people.last_action(f.raw("events").select(user("user_id").alias("username"), millis("ts").alias("ts")))


@query
def presence(f):
    return people.presence(f.users(), NOW_MS)


@query
def friends_online(f):
    return people.friends_online(f.friend_edge(), f.users(), NOW_MS)


@query
def relationship(f):
    pairs = f.friend_ops().select(F.col("sender").alias("viewer"), F.col("receiver").alias("owner")).distinct()
    return people.relationship(f.friend_edge(), pairs)


@query
def validate_users(f):
    return people.validate_users(f.signups()).select("username", "ok", "reason")


@query
def validate_rows(f):
    return people.validate_rows(f.form_rows()).select("event_id", "kind", "ok", "reason")


@query
def friend_expand(f):
    return people.friend_expand(f.friend_edge(), f.users())


@query
def friend_expand_visible(f):
    return people.friend_expand_visible(f.friend_edge(), f.users(), f.graph_requests())


@query
def invite_check(f):
    return people.invite_check(f.friend_edge(), f.group_requests())


@query
def invite_new(f):
    return people.invite_new(f.friend_ops(), f.friend_edge(), state.invite_state(f.invite_log()),
                             state.room_state(f.room_log()))


# -- state from logs -----------------------------------------------------------------

@query
def new_users(f):
    users, friends = state.new_users(people.validate_users(f.signups()).filter("ok"), NOW_MS)
    lists = {"interests": F.array_join("interests", ","), "rooms": F.size("rooms"), "chatInvites": F.size("chatInvites")}
    return users.join(friends, "username").select(*[lists.get(c, F.col(c)).alias(c) for c in users.columns], "friend")


@query
def profile_latest(f):
    return state.profile_latest(f.profile_log())


@query
def derived_posts(f):
    return state.derived_posts(f.profile_log())


@query
def friend_state(f):
    return state.friend_state(f.friend_ops())


@query
def room_state(f):
    return state.room_state(f.room_log().unionByName(state.accepted_rooms(f.invite_log(), f.friend_edge())))


@query
def room_id(f):
    return f.group_requests().select(
        "request_id", scalars.room_id(F.col("participants"), F.col("sender")).alias("room"))


@query
def invite_state(f):
    return state.invite_state(f.invite_log())


@query
def accepted_rooms(f):
    return state.accepted_rooms(f.invite_log(), f.friend_edge())


@query
def group_accept(f):
    """Joins by acceptance of invites into groups alone."""
    return state.accepted_rooms(f.invite_log().filter(F.contains("sender", F.lit(","))), f.friend_edge())


@query
def group_invite_new(f):
    return people.group_invite_new(f.group_invites(), f.friend_edge(), state.invite_state(f.invite_log()))


def _in_three(f: Fixtures, log: DataFrame, name: str, first: Callable[[DataFrame], DataFrame],
              advance: Callable[[DataFrame, DataFrame, int], DataFrame]) -> DataFrame:
    """Three snapshots, each saved: of the first third of a log, then brought up to the end of the second and the third."""
    run = Scratch(f.spark, name)
    cuts = snapshots.thirds(log)
    if not cuts:
        return first(log)
    snapshot = run.save(first(snapshots.up_to(log, cuts[0])), "snapshot-0")
    for i, (before, cut) in enumerate(zip(cuts, cuts[1:]), 1):
        snapshot = run.save(advance(snapshot, snapshots.up_to(log, cut), before), f"snapshot-{i}")
    return snapshot


@query
def profile_snapshots(f):
    keys = ["username", "field"]
    return _in_three(f, f.profile_log(), "profiles", lambda log: snapshots.newest_rows(log, keys, "value"),
                     lambda s, log, upto: snapshots.advance_newest(s, log.filter(F.col("event_id") > upto), keys, "value")).select(*keys, "value")


@query
def friend_snapshots(f):
    keys = ["username", "friend"]
    both = f.friend_ops().select("event_id", "ts", "op", F.explode(F.array(
        F.struct(F.col("sender").alias("username"), F.col("receiver").alias("friend")),
        F.struct(F.col("receiver").alias("username"), F.col("sender").alias("friend")))).alias("x")).select("event_id", "ts", "op", "x.*")
    return state.friends_of(_in_three(
        f, both, "friends", lambda log: snapshots.newest_rows(log, keys, "op"),
        lambda s, log, upto: snapshots.advance_newest(s, log.filter(F.col("event_id") > upto), keys, "op")))


@query
def room_snapshots(f):
    keys = ["username", "room"]
    log = f.room_log().unionByName(state.accepted_rooms(f.invite_log(), f.friend_edge()))
    log = Scratch(f.spark, "room-log").save(log, "log")
    return snapshots.present(_in_three(f, log, "rooms", lambda part: snapshots.presences(part, keys, "JOIN"),
                                       lambda s, part, upto: snapshots.advance_presences(s, part, upto, keys, "JOIN")), keys)


@query
def invite_snapshots(f):
    keys = ["receiver", "sender"]
    return snapshots.present(_in_three(f, f.invite_log(), "invites", lambda part: snapshots.presences(part, keys, "INVITE"),
                                       lambda s, part, upto: snapshots.advance_presences(s, part, upto, keys, "INVITE")), keys)


# -- search ----------------------------------------------------------------------------

@query
def keyword_index_raw(f):
    return search.keyword_index(f.article(), stem=False)


@query
def keyword_index(f):
    return search.keyword_index(f.article())


@query
def keyword_index_stop_table(f):
    """With a stop list that is a table of hundreds of words."""
    return search.keyword_index(f.article(), search.frequent_words(f.article(), STOP_WORDS))


@query
def keyword_hits(f):
    return search.keyword_hits(search.keyword_index(f.article(), stem=False), f.search_requests(), stem=False)


@query
def keyword_top5(f):
    return search.search_top(search.keyword_index(f.article(), stem=False), f.search_requests(), stem=False)


@query
def news_search(f):
    return search.news_search(search.keyword_index(f.article()), f.article(), f.search_requests())


# -- scalars -------------------------------------------------------------------------

@query
def scalar_functions(f):
    address = F.concat(F.lit("/wall?username="), "author")
    posts = f.posts().join(f.users(), F.col("author") == F.col("username"))
    interests = F.array(F.lit("A"), F.col("lastname"), F.col("firstname"))
    return posts.select(
        "event_id",
        scalars.capitalise(F.concat_ws(" ", "affiliation", "author")).alias("capitalised"),
        scalars.post_key(F.col("author"), F.col("timestamp")).alias("post_key"),
        scalars.affiliation_post(F.col("affiliation")).alias("affiliation_post"),
        scalars.interests_post(interests).alias("three_interests"),
        scalars.interests_post(F.slice(interests, 1, 2)).alias("two_interests"),
        scalars.password_hash(F.col("content")).alias("password_hash"),
        scalars.display_date(F.col("timestamp")).alias("display_date"),
        scalars.wall_owner(address).alias("wall_owner"),
        scalars.chat_line(F.col("author"), F.col("content")).alias("chat_line"))


# -- streams ---------------------------------------------------------------------------

def _run(start: Callable[[str], object], f: Fixtures, name: str) -> str:
    path = Scratch(f.spark, name).path("out")
    start(path).awaitTermination()
    return path


@query
def stream_presence(f):
    activity = StreamFixtures(f, "events", "event_id").raw("events").select(user("user_id").alias("username"), millis("ts").alias("ts"))
    path = _run(lambda p: streams.stream_presence(activity, p), f, "stream-presence")
    last = streams.read_presence(f.spark, path)
    return last.select("username", "last_action",
                       scalars.is_online(F.col("last_action"), F.lit(NOW_MS)).alias("online"))


@query
def stream_chat(f):
    messages = StreamFixtures(f, "conversations", "turn").messages()
    path = _run(lambda p: streams.stream_chat(messages, p), f, "stream-chat")
    return streams.read_chat(f.spark, path)


@query
def stream_friend_state(f):
    ops = StreamFixtures(f, "events", "user_id").friend_ops()
    path = _run(lambda p: streams.stream_friend_state(ops, p), f, "stream-friends")
    return streams.read_friend_state(f.spark, path, ops.schema)


def _arriving(f: Fixtures, rows: DataFrame, batch: Column, name: str, batches: int = STREAM_BATCHES) -> DataFrame:
    """A table as a stream whose batches come in the order of ``batch``, a number from 0 on; one file each."""
    files = Scratch(f.spark, f"stream-{name}")
    held = files.save(rows.withColumn("_batch", batch), "all")
    for b in range(batches):
        held.filter(F.col("_batch") == b).drop("_batch").coalesce(1).write.mode("append").parquet(files.path("in"))
    return streams.read_stream(f.spark, files.path("in"), "part-", rows.schema, files_per_batch=1)


@query
def stream_presence_expiry(f):
    """Presence held as state: users go offline by a timer, and reading computes nothing. Two ticks of the clock end the stream."""
    actions = f.raw("events").select(user("user_id").alias("username"), millis("ts").alias("ts"))
    ticks = f.spark.createDataFrame([(None, NOW_MS, STREAM_BATCHES), (None, NOW_MS, STREAM_BATCHES + 1)], "username string, ts bigint, _batch int")
    first, span = actions.agg(F.min("ts"), F.max("ts") - F.min("ts") + 1).first()
    dealt = actions.withColumn("_batch", F.floor((F.col("ts") - first) * STREAM_BATCHES / span).cast("int")).unionByName(ticks)
    stream = _arriving(f, dealt.withColumnRenamed("_batch", "at_batch"), F.col("at_batch"), "presence", STREAM_BATCHES + 2).drop("at_batch")
    path = _run(lambda p: streams.stream_presence_expiry(stream, p), f, "stream-presence-expiry")
    return streams.read_presence_expiry(f.spark, path)


@query
def stream_recommend(f):
    """Interests arrive in batches; the recommendations are brought up to date once per batch, from all interests so far."""
    number = F.substring("username", 2, 20).cast("bigint")
    interests = _arriving(f, f.user_interest(), (number % STREAM_BATCHES).cast("int"), "interests")
    articles = edges.news_for_date(f.news(), NEWS_DATE)
    # what does not change between batches is written once
    run = Scratch(f.spark, "standing-edges")
    friends, likes = run.save(edges.friend_edges(f.friend_edge()), "friends"), run.save(edges.like_edges(f.newslikes()), "likes")
    listed = run.save(edges.article_edges(articles), "articles")
    urls = run.save(articles.select("url"), "urls")

    standing = propagation.Standing()

    def recompute(known: DataFrame) -> DataFrame:
        network = edges.weighted_edges(friends, likes, edges.interest_edges(known), listed)
        labels = standing.update(known.select(F.col("username").alias("node")), network, urls.withColumnRenamed("url", "node"))
        return propagation.recommendations(labels, urls)

    path = _run(lambda p: streams.stream_recommend(interests, p, recompute), f, "stream-recommend")
    return streams.read_recommendations(f.spark, path) \
        .withColumn("weight", scalars.quantise(F.col("weight")))
