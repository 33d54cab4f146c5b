"""Edge builders, degrees and the weighted graph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripple.session import Scratch

# Share of its weight that a node sends along all its edges of one kind.
USER_FRIEND, USER_ARTICLE, ARTICLE_USER = 0.3, 0.4, 0.4
USER_INTEREST, CATEGORY_USER = 0.3, 0.3
ARTICLE_CATEGORY, CATEGORY_ARTICLE = 1.0, 1.0


def friend_sets_to_edges(friends: DataFrame) -> DataFrame:
    """(username, array of friends) to one row per friend."""
    return friends.select("username", F.explode("friends").alias("friend"))


def friend_edges(friend_edge: DataFrame) -> DataFrame:
    """Friend edges without the edge of each user to itself."""
    return friend_edge.filter(F.col("username") != F.col("friend")) \
        .select(F.col("username").alias("src"), F.col("friend").alias("dst"))


def like_edges(newslikes: DataFrame) -> DataFrame:
    return newslikes.select(F.col("userid").alias("src"), F.col("url").alias("dst"))


def interest_edges(user_interest: DataFrame) -> DataFrame:
    return user_interest.select(F.col("username").alias("src"), F.col("interest").alias("dst"))


def news_for_date(news: DataFrame, date: str | None = None) -> DataFrame:
    """News that have both key and category, of one day or of all days."""
    kept = news.filter(F.col("url").isNotNull() & F.col("category").isNotNull())
    return kept if date is None else kept.filter(F.col("date") == date)


def article_edges(articles: DataFrame) -> DataFrame:
    return articles.select(F.col("url").alias("src"), F.col("category").alias("dst"))


def reverse(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def node_degrees(kinds: DataFrame) -> DataFrame:
    """Edges of each kind that leave each node."""
    return kinds.groupBy("kind", "src").agg(F.count("*").alias("n"))


def edge_kinds(friends: DataFrame, likes: DataFrame, interests: DataFrame, articles: DataFrame) -> DataFrame:
    """All seven kinds of edge with the share ``k`` of the source they divide among them."""
    kinds = [
        ("user_friend", friends, USER_FRIEND),
        ("user_article", likes, USER_ARTICLE),
        ("article_user", reverse(likes), ARTICLE_USER),
        ("user_interest", interests, USER_INTEREST),
        ("category_user", reverse(interests), CATEGORY_USER),
        ("article_category", articles, ARTICLE_CATEGORY),
        ("category_article", reverse(articles), CATEGORY_ARTICLE),
    ]
    return reduce(DataFrame.unionByName, [
        edges.select(F.lit(name).alias("kind"), "src", "dst", F.lit(share).alias("k"))
        for name, edges, share in kinds])


def weighted_edges(friends: DataFrame, likes: DataFrame, interests: DataFrame, articles: DataFrame) -> DataFrame:
    """The graph: each edge carries its kind's share divided by the edges of that kind leaving the source.

    An article gives its whole weight to each category it has. The counts are
    combined on the map side, written once and joined back, rather than taken over a window; as the
    written table is no aggregate on the join key, adaptive execution splits the edges of a category followed by a
    third of all users.
    """
    kinds = edge_kinds(friends, likes, interests, articles)
    degrees = Scratch(kinds.sparkSession, "degrees").save(node_degrees(kinds), "table")
    weight = F.when(F.col("kind") == "article_category", F.col("k")).otherwise(F.col("k") / F.col("n"))
    return kinds.join(degrees, ["kind", "src"]).select("src", "dst", "kind", weight.alias("w"))


def shared_ids(users: DataFrame, articles: DataFrame, categories: DataFrame) -> DataFrame:
    """Names that stand for nodes of more than one type; each input has one column ``node``.

    The graph holds all names in one key space, so such a name would merge two nodes.
    """
    typed = [df.select("node").distinct() for df in (users, articles, categories)]
    return reduce(DataFrame.unionByName, typed).groupBy("node").agg(F.count("*").alias("n_types")) \
        .filter("n_types > 1")


def degree_table(edges: DataFrame) -> DataFrame:
    """In-degree and out-degree of every vertex."""
    ends = edges.select(F.col("src").alias("v"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(
        edges.select(F.col("dst").alias("v"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return ends.groupBy("v").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))


def graph_stats(edges: DataFrame) -> DataFrame:
    """Number of edges and of vertices, as one row; the vertices are counted in the same pass."""
    return degree_table(edges).agg(
        F.coalesce(F.sum("out_degree"), F.lit(0)).alias("n_edges"), F.count("*").alias("n_vertices"))


def graph_distinct(edges: DataFrame) -> DataFrame:
    return edges.distinct()


def sinks(edges: DataFrame) -> DataFrame:
    """Vertices with incoming but no outgoing edges, from one aggregate instead of an anti-join."""
    return degree_table(edges).filter("out_degree = 0").select("v")


def sink_backlinks(edges: DataFrame, sink_vertices: DataFrame) -> DataFrame:
    """For each edge into a sink, the edge back."""
    return edges.join(sink_vertices.select(F.col("v").alias("dst")), "dst") \
        .select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def add_backlinks(edges: DataFrame, sink_vertices: DataFrame) -> DataFrame:
    """The graph with an edge from each sink back to each of its sources; repeats are kept."""
    return edges.select("src", "dst").unionByName(sink_backlinks(edges, sink_vertices))
