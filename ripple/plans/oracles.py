"""DuckDB SQL for the queries of ``plans.registry``, written from the rules, not from the operators."""

from __future__ import annotations

import re

from ripple.functions.stopwords import DEFAULT_STOP_WORDS
from ripple.operators.people import EMPTY_FIELD, EMPTY_FORM, FEW_INTERESTS
from ripple.plans.porter_sql import stems
from ripple.plans.registry import EARLY_STOP, PAGE_USER, RANK_DMAX, STOP_WORDS, STREAM_BATCHES
from ripple.sources.fixtures import FRIEND_MULTIPLIERS, NEWS_DATE, NOW_MS


def _ms(column: str) -> str:
    """Epoch milliseconds; DuckDB's epoch_ms rounds where Spark floors."""
    return f"(epoch_us({column}) // 1000)"


def _q(expression: str) -> str:
    return f"CAST(FLOOR(({expression}) * 1e6 + 0.3719) AS BIGINT)"


_K = "CAST(REGEXP_EXTRACT(props, '([0-9]+)', 1) AS BIGINT)"

# Derived tables; each may use those before it.
VIEWS = {
    "friend_edge": f"""
        SELECT DISTINCT 'u' || a AS username, 'u' || b AS friend FROM (
          WITH made AS (
            SELECT c_custkey AS a, (c_custkey * m + 7) % (SELECT COUNT(*) FROM customer) AS b
            FROM customer, (VALUES {", ".join(f"({m})" for m in FRIEND_MULTIPLIERS)}) AS v(m)
            UNION ALL SELECT c_custkey, c_custkey FROM customer)
          SELECT a, b FROM made UNION ALL SELECT b, a FROM made)""",
    "user_interest": """
        SELECT 'u' || o_custkey AS username, p_brand AS interest
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
        GROUP BY o_custkey, p_brand
        QUALIFY RANK() OVER (PARTITION BY o_custkey ORDER BY COUNT(*) DESC) = 1""",
    "newslikes": """
        SELECT DISTINCT 'u' || o_custkey AS userid, 'part/' || l_partkey AS url
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "news": """
        SELECT 'part/' || p_partkey AS url, p_brand AS category, p_name AS headline,
               CAST(CAST(DATE '2017-12-01' + CAST(p_size AS INT) AS DATE) AS VARCHAR) AS date FROM part""",
    "news_day": f"SELECT * FROM news WHERE date = '{NEWS_DATE}' AND url IS NOT NULL AND category IS NOT NULL",
    "users": f"""
        SELECT 'u' || c_custkey AS username, 'Nation_' || c_nationkey AS firstname,
               SUBSTRING(c_mktsegment, 1, 1) || LOWER(SUBSTRING(c_mktsegment, 2)) AS lastname,
               c_mktsegment AS affiliation, last_action AS lastAction
        FROM customer LEFT JOIN (SELECT user_id, MAX({_ms("ts")}) AS last_action FROM events GROUP BY user_id)
          ON user_id = c_custkey""",
    "signups": """
        SELECT 'u' || c_custkey AS username, c_acctbal < 0 OR c_acctbal >= 9000 AS lacks_field,
               CASE WHEN c_acctbal < 1000 THEN 1 ELSE 2 END AS n_interests FROM customer""",
    "article": """
        SELECT 'doc/' || doc_id AS url, split_part(text, chr(10), 1) AS headline, source AS category,
               text AS body FROM documents""",
    "search_requests": """
        SELECT conv_id || '-' || turn AS query_id, text FROM conversations WHERE role = 'user'""",
    "posts": f"""
        SELECT event_id, 'u' || user_id AS author, {_ms("ts")} AS timestamp,
               event_type || ' ' || props AS content, CAST(0 AS BIGINT) AS likes,
               CASE WHEN event_type = 'purchase' THEN COALESCE(first_friend, 'u' || user_id)
                    ELSE 'u' || user_id END AS isWall
        FROM events LEFT JOIN (
          SELECT username, MIN(friend) AS first_friend FROM friend_edge WHERE friend <> username GROUP BY username)
          ON username = 'u' || user_id
        WHERE event_type IN ('view', 'click', 'purchase')""",
    "reactions": f"""
        SELECT p.author || '$' || p.timestamp AS authortime, {_ms("c.ts")} AS timestamp,
               'u' || c.user_id AS author, c.props AS content
        FROM events c JOIN posts p ON p.event_id = c.event_id - 1 - (c.event_id % 5) WHERE c.event_type = 'error'""",
    "messages": """
        SELECT 'room' || conv_id AS groupid, CAST(1700000000000 + conv_id * 100000 + turn * 1000 AS VARCHAR) AS timestamp,
               text AS message, role AS author FROM conversations""",
    "friend_ops": f"""
        SELECT event_id, ts, 'u' || user_id AS sender, 'u' || ({_K} % 10) AS receiver,
               CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'ADD' END AS op FROM events""",
    "profile_log": f"""
        SELECT event_id, {_ms("ts")} AS ts, 'u' || user_id AS username,
               CASE event_type WHEN 'view' THEN 'affiliation' WHEN 'click' THEN 'email' WHEN 'error' THEN 'password'
                 WHEN 'signup' THEN 'interests' ELSE 'lastAction' END AS field,
               CASE event_type WHEN 'view' THEN 'Org_' || ({_K} % 12)
                 WHEN 'click' THEN 'u' || user_id || '.' || {_K} || '@mail.test'
                 WHEN 'error' THEN sha256(props)
                 WHEN 'signup' THEN 'Brand#' || ({_K} % 25) || ',Brand#' || (({_K} + 7) % 25)
                   || CASE WHEN {_K} % 2 = 0 THEN ',Brand#' || (({_K} + 11) % 25) ELSE '' END
                 ELSE CAST({_ms("ts")} AS VARCHAR) END AS value FROM events""",
    "room_log": f"""
        SELECT event_id, {_ms("ts")} AS ts, 'u' || user_id AS username,
               LEAST('u' || user_id, 'u' || ({_K} % 10)) || ',' || GREATEST('u' || user_id, 'u' || ({_K} % 10)) AS room,
               CASE WHEN event_type = 'error' THEN 'LEAVE' ELSE 'JOIN' END AS op
        FROM events WHERE event_type IN ('signup', 'click', 'error')""",
    "invite_log": f"""
        SELECT event_id, {_ms("ts")} AS ts, 'u' || user_id AS receiver,
               CASE WHEN {_K} % 4 = 3 THEN array_to_string(list_sort(['u' || ((user_id * 2 + 7) % (SELECT COUNT(*) FROM customer)),
                 'u' || ((user_id * 3 + 7) % (SELECT COUNT(*) FROM customer))]), ',') ELSE 'u' || ({_K} % 10) END AS sender,
               CASE event_type WHEN 'error' THEN 'DECLINE' WHEN 'purchase' THEN 'ACCEPT' ELSE 'INVITE' END AS op
        FROM events""",
    "accepted": """
        SELECT event_id, ts, sender, member AS username, array_to_string(list_sort(everyone), ',') AS room, 'JOIN' AS op
        FROM (SELECT *, unnest(list_distinct(everyone)) AS member FROM (
          SELECT *, list_append(string_split(sender, ','), receiver) AS everyone FROM invite_log WHERE op = 'ACCEPT'))
        WHERE event_id NOT IN (
          SELECT event_id FROM (SELECT event_id, receiver, unnest(list_append(string_split(sender, ','), receiver)) AS member
                                FROM invite_log WHERE op = 'ACCEPT') e
          WHERE NOT EXISTS (SELECT 1 FROM friend_edge f WHERE f.username = e.receiver AND f.friend = e.member))""",
    "rooms": """
        SELECT username, room, MIN(ts) AS since FROM (SELECT * FROM room_log UNION ALL SELECT event_id, ts, username, room, op FROM accepted) came WHERE op = 'JOIN' AND NOT EXISTS (
          SELECT 1 FROM (SELECT * FROM room_log UNION ALL SELECT event_id, ts, username, room, op FROM accepted) gone WHERE gone.username = came.username AND gone.room = came.room AND gone.op <> 'JOIN' AND (gone.ts, gone.event_id) > (came.ts, came.event_id))
        GROUP BY username, room""",
    "plain_rooms": """
        SELECT username, room, MIN(ts) AS since FROM room_log came WHERE op = 'JOIN' AND NOT EXISTS (
          SELECT 1 FROM room_log gone WHERE gone.username = came.username AND gone.room = came.room AND gone.op <> 'JOIN' AND (gone.ts, gone.event_id) > (came.ts, came.event_id))
        GROUP BY username, room""",
    "invites": """
        SELECT receiver, sender, MIN(ts) AS since FROM invite_log came WHERE op = 'INVITE' AND NOT EXISTS (
          SELECT 1 FROM invite_log gone WHERE gone.receiver = came.receiver AND gone.sender = came.sender AND gone.op <> 'INVITE' AND (gone.ts, gone.event_id) > (came.ts, came.event_id))
        GROUP BY receiver, sender""",
    "group_requests": f"""
        SELECT event_id AS request_id, 'u' || user_id AS sender,
               'u' || ((user_id * 2 + 7) % n) AS one, 'u' || ((user_id * ({_K} % 6) + 7) % n) AS two
        FROM events, (SELECT COUNT(*) AS n FROM customer) WHERE event_type = 'signup'""",
    "group_invites": f"""
        SELECT 'u' || user_id AS inviter,
               array_to_string(list_sort(['u' || ((user_id * 5 + 7) % n), 'u' || user_id]), ',') AS room,
               'u' || ((user_id * ({_K} % 4 + 1) + 7) % n) AS receiver
        FROM events, (SELECT COUNT(*) AS n FROM customer) WHERE event_type = 'click'""",
    "form_rows": f"""
        SELECT event_id, ['comment', 'post', 'email', 'password', 'affiliation', 'interests'][event_id % 6 + 1] AS kind,
               CASE WHEN {_K} % 5 = 0 THEN '' WHEN {_K} % 7 = 0 THEN NULL WHEN {_K} % 2 = 0 THEN props
                 ELSE 'Brand#1,Brand#' || {_K} END AS value FROM events""",
    "graph_requests": """
        SELECT DISTINCT author AS viewer, split_part(authortime, '$', 1) AS "user" FROM reactions""",
    "rank_edge": """
        SELECT l_partkey AS src, (l_partkey * 7 + l_suppkey) % (SELECT COUNT(*) FROM part) AS dst FROM lineitem
        UNION SELECT l_partkey, l_suppkey + (SELECT COUNT(*) FROM part) + 1 FROM lineitem""",
    "rank_backlink": """
        SELECT dst AS src, src AS dst FROM rank_edge WHERE dst NOT IN (SELECT src FROM rank_edge)""",
    "rank_graph": "SELECT src, dst FROM rank_edge UNION ALL SELECT src, dst FROM rank_backlink",
    "index_raw": f"""
        SELECT DISTINCT keyword, url FROM (
          SELECT url, lower(unnest(regexp_extract_all(body, '\\p{{L}}+'))) AS keyword FROM article)
        WHERE keyword NOT IN ({", ".join(f"'{w}'" for w in DEFAULT_STOP_WORDS)})""",
    "hits": """
        SELECT query_id, url, CAST(COUNT(*) AS BIGINT) AS hits
        FROM (SELECT query_id, unnest(string_split(lower(text), ' ')) AS keyword FROM search_requests)
          JOIN index_raw USING (keyword) WHERE keyword <> '' GROUP BY query_id, url""",
}

# Views that others select from more than once.
_MATERIALISED = {"friend_edge", "user_interest", "newslikes", "posts", "rank_edge", "rank_graph", "index_raw"}

_USES = {name: [v for v in VIEWS if v != name and v in text.replace("'", " ").replace(",", " ").replace(")", " ")
                .replace("(", " ").split()] for name, text in VIEWS.items()}


def _ctes(names: list[str]) -> list[str]:
    """The named views and all they use, in order."""
    wanted: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += _USES[name]
    return [f"{name} AS {'MATERIALIZED ' if name in _MATERIALISED else ''}({VIEWS[name]})"
            for name in VIEWS if name in wanted]


def _sql(body: str, *views: str, extra: list[str] | None = None) -> str:
    ctes = _ctes(list(views)) + (extra or [])
    return (f"WITH {', '.join(ctes)} " if ctes else "") + body


# -- label propagation, unrolled ------------------------------------------------------

def _kinds(news: str) -> str:
    return f"""
        SELECT 'user_friend' AS kind, username AS src, friend AS dst, 0.3 AS k FROM friend_edge WHERE username <> friend
        UNION ALL SELECT 'user_article', userid, url, 0.4 FROM newslikes
        UNION ALL SELECT 'article_user', url, userid, 0.4 FROM newslikes
        UNION ALL SELECT 'user_interest', username, interest, 0.3 FROM user_interest
        UNION ALL SELECT 'category_user', interest, username, 0.3 FROM user_interest
        UNION ALL SELECT 'article_category', url, category, 1.0 FROM {news}
        UNION ALL SELECT 'category_article', category, url, 1.0 FROM {news}"""


def _edge(news: str = "news_day") -> str:
    return f"""
        SELECT src, dst, kind, CASE WHEN kind = 'article_category' THEN 1e0
          ELSE CAST(k AS DOUBLE) / COUNT(*) OVER (PARTITION BY kind, src) END AS w FROM ({_kinds(news)})"""


def _propagation(rounds: int = 15, threshold: float = 0.15, news: str = "news_day") -> list[str]:
    """CTEs ending in ``label_state`` (node, label, w): one per round, the stop decided afterwards.

    Names become numbers for the loop.
    """
    ctes = [
        f"edge AS MATERIALIZED ({_edge(news)})",
        """node_id AS MATERIALIZED (SELECT name, ROW_NUMBER() OVER () AS id FROM (
             SELECT src AS name FROM edge UNION SELECT dst FROM edge UNION SELECT username FROM user_interest))""",
        """e AS MATERIALIZED (SELECT s.id AS src, d.id AS dst, w FROM edge
             JOIN node_id s ON s.name = edge.src JOIN node_id d ON d.name = edge.dst)""",
        """seed AS MATERIALIZED (SELECT id FROM node_id WHERE name IN (SELECT username FROM user_interest))""",
        "s0 AS MATERIALIZED (SELECT id AS node, id AS label, 1e0 AS w FROM seed)",
    ]
    stops = []
    for i in range(rounds):
        # nothing is left to send once a round before has stopped
        on = f"(SELECT NOT over FROM stop{i - 1})" if i > 1 else "true"
        ctes.append(f"""s{i + 1} AS MATERIALIZED (
            SELECT node, label, w / SUM(w) OVER (PARTITION BY node) AS w FROM (
              SELECT e.dst AS node, s.label, SUM(s.w * e.w) AS w FROM (SELECT * FROM s{i} WHERE {on}) s JOIN e ON s.node = e.src
              GROUP BY e.dst, s.label) QUALIFY node <> label
            UNION ALL SELECT id, id, 1e0 FROM seed WHERE {on})""")
        if i > 0:
            # a pair held in both states has two rows here; grouping costs less than joining the states
            ctes.append(f"""stop{i} AS MATERIALIZED (SELECT {'NOT ' + on if i > 1 else 'false'} OR COALESCE((
                SELECT MAX(moved) FROM (SELECT MAX(w) - MIN(w) AS moved
                  FROM (SELECT * FROM s{i} UNION ALL SELECT * FROM s{i + 1})
                  GROUP BY node, label HAVING COUNT(*) = 2)), 0) <= {threshold} AS over)""")
            stops.append(f"SELECT {i} AS result FROM stop{i} WHERE over")
    stops.append(f"SELECT {rounds}")
    ctes.append(f"stop_at AS MATERIALIZED (SELECT MIN(result) AS result FROM ({' UNION ALL '.join(stops)}))")
    states = " UNION ALL ".join(
        f"SELECT node, label, w FROM s{i} WHERE (SELECT result FROM stop_at) = {i}" for i in range(1, rounds + 1))
    ctes.append(f"""label_state AS (SELECT n.name AS node, l.name AS label, w FROM ({states}) s
        JOIN node_id n ON n.id = s.node JOIN node_id l ON l.id = s.label)""")
    return ctes


def _batched_propagation(batches: int) -> list[str]:
    """The loop once per batch of interests, each with all interests so far; ends in ``batch_recs`` (batch, username, url, weight)."""
    own = re.compile(r"\b(edge|node_id|e|seed|s\d+|stop\d+|stop_at|label_state|user_interest)\b(?!')")
    ctes, runs = [], []
    for b in range(batches):
        ctes.append(f"user_interest_{b} AS MATERIALIZED (SELECT * FROM user_interest WHERE CAST(SUBSTRING(username, 2) AS BIGINT) % {batches} <= {b})")
        ctes += [own.sub(rf"\1_{b}", cte) for cte in _propagation()]
        runs.append(f"SELECT {b} AS batch, label AS username, node AS url, w AS weight FROM label_state_{b} WHERE node IN (SELECT url FROM news_day)")
    return [*ctes, f"batch_recs AS ({' UNION ALL '.join(runs)})"]


_GRAPH_VIEWS = ("friend_edge", "newslikes", "user_interest", "news_day")
_RECS = """recs AS MATERIALIZED (SELECT label AS username, node AS url, w AS weight
    FROM label_state WHERE node IN (SELECT url FROM news_day))"""
_RECS_Q = f"SELECT username, url, {_q('weight')} AS weight FROM recs"


def _by_weight(w: str) -> str:
    """Twelve significant digits, largest first."""
    return f"FLOOR(LOG10({w})) DESC, ROUND({w} * POW(10e0, 11 - FLOOR(LOG10({w})))) DESC"


_TOP = f"""top AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY username ORDER BY {_by_weight("weight")}, url) AS place
    FROM recs QUALIFY place <= 5)"""


# -- ranks, unrolled --------------------------------------------------------------------

def _ranks(rounds: int = 25, dmax: float = 30.0) -> list[str]:
    ctes = [
        "pass_on AS MATERIALIZED (SELECT src, dst, 1e0 / COUNT(*) OVER (PARTITION BY src) AS w FROM rank_graph)",
        "r0 AS MATERIALIZED (SELECT DISTINCT src AS v, 1e0 AS r FROM rank_graph)",
    ]
    stops = []
    for i in range(rounds):
        ctes.append(f"""r{i + 1} AS MATERIALIZED (SELECT dst AS v, 0.15e0 + 0.85e0 * SUM(w * r) AS r
            FROM pass_on JOIN r{i} ON v = src GROUP BY dst)""")
        stops.append(f"""SELECT {i + 1} AS result WHERE NOT EXISTS (
            SELECT 1 FROM r{i} a JOIN r{i + 1} b USING (v) WHERE ABS(a.r - b.r) >= {dmax})""")
    stops.append(f"SELECT {rounds}")
    ctes.append(f"stop_at AS MATERIALIZED (SELECT MIN(result) AS result FROM ({' UNION ALL '.join(stops)}))")
    states = " UNION ALL ".join(
        f"SELECT v, r FROM r{i} WHERE (SELECT result FROM stop_at) = {i}" for i in range(1, rounds + 1))
    ctes.append(f"ranks AS ({states})")
    return ctes


_DEGREES = """SELECT v, SUM(o) AS out_degree, SUM(i) AS in_degree FROM (
    SELECT src AS v, 1 AS o, 0 AS i FROM rank_edge UNION ALL SELECT dst, 0, 1 FROM rank_edge) GROUP BY v"""
_FEED = """LEFT JOIN (SELECT authortime, CAST(timestamp AS VARCHAR) AS comment_timestamp, author AS comment_author, content AS comment
    FROM reactions) c ON c.authortime = p.author || '$' || p.timestamp"""
_NEWEST_FRIEND_OP = """
    SELECT username, friend, op FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY username, friend ORDER BY ts DESC, event_id DESC) AS n FROM (
        SELECT event_id, ts, op, sender AS username, receiver AS friend FROM friend_ops
        UNION ALL SELECT event_id, ts, op, receiver, sender FROM friend_ops)) WHERE n = 1"""
_FRIEND_STATE = f"""
    SELECT username, friend FROM ({_NEWEST_FRIEND_OP}) WHERE op = 'ADD' AND username <> friend
    UNION ALL SELECT DISTINCT username, username FROM ({_NEWEST_FRIEND_OP})"""
_DERIVED = """SELECT username AS author, ts AS timestamp,
    CASE WHEN field = 'affiliation' THEN 'I changed my affiliation to ' || value || '!'
         ELSE 'I am now interested in ' || array_to_string(list_slice(string_split(value, ','), 1, -2), ', ')
              || ', and ' || list_extract(string_split(value, ','), -1) || '!' END AS content,
    CAST(0 AS BIGINT) AS likes, username AS isWall
    FROM profile_log WHERE field IN ('affiliation', 'interests')"""
# words of articles and of search texts, stemmed
_STEMMED = ["""vocabulary AS MATERIALIZED (SELECT DISTINCT word FROM (SELECT keyword AS word FROM index_raw
                UNION ALL SELECT unnest(string_split(lower(text), ' ')) FROM search_requests) WHERE word <> '')""",
            *stems("vocabulary"),
            "stem_index AS MATERIALIZED (SELECT DISTINCT stem AS keyword, url FROM index_raw JOIN stems ON word = keyword)"]
_SEARCH = f"""SELECT query_id, CAST(place AS INT) AS place, url, CAST(hits AS BIGINT) AS hits, headline, category FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY hits DESC, url) AS place FROM (
      SELECT query_id, url, COUNT(*) AS hits
      FROM (SELECT query_id, unnest(string_split(lower(text), ' ')) AS word FROM search_requests)
        JOIN stems USING (word) JOIN stem_index ON stem = keyword GROUP BY query_id, url) QUALIFY place <= 5)
  LEFT JOIN article USING (url)"""
_ONLINE = f"COALESCE({NOW_MS} - lastAction <= 300000, FALSE)"


def oracle_sql() -> dict[str, str]:
    edge = [f"edge AS ({_edge()})"]
    propagated = _propagation()
    ranks_q = f"SELECT v, {_q('r')} AS r FROM ranks"
    return {
        # the graph
        "edge_list_scan": _sql("SELECT CAST(src AS INT) AS src, CAST(dst AS INT) AS dst FROM rank_edge", "rank_edge"),
        "graph_stats": _sql(f"""SELECT (SELECT COUNT(*) FROM rank_edge) AS n_edges, COUNT(*) AS n_vertices
            FROM (SELECT src FROM rank_edge UNION SELECT dst FROM rank_edge)""", "rank_edge"),
        "friend_edges": _sql("SELECT username AS src, friend AS dst FROM friend_edge WHERE username <> friend",
                             "friend_edge"),
        "like_edges": _sql("SELECT userid AS src, url AS dst FROM newslikes", "newslikes"),
        "interest_edges": _sql("SELECT username AS src, interest AS dst FROM user_interest", "user_interest"),
        "news_for_date": _sql("SELECT url, category, headline, date FROM news_day", "news_day"),
        "news_all": _sql("SELECT url, category, headline, date FROM news", "news"),
        "node_degrees": _sql(f"SELECT kind, src, COUNT(*) AS n FROM ({_kinds('news_day')}) GROUP BY kind, src",
                             *_GRAPH_VIEWS),
        "weighted_edges": _sql(f"SELECT src, dst, kind, {_q('w')} AS w FROM edge", *_GRAPH_VIEWS, extra=edge),
        "shared_ids": _sql("""SELECT node, COUNT(*) AS n_types FROM (
            SELECT DISTINCT 1 AS t, username AS node FROM users UNION SELECT 2, url FROM news
            UNION SELECT 3, interest FROM user_interest UNION SELECT 3, category FROM news)
            GROUP BY node HAVING COUNT(*) > 1""", "users", "news", "user_interest"),
        "label_propagation": _sql(f"SELECT node, label, {_q('w')} AS w FROM label_state", *_GRAPH_VIEWS,
                                  extra=propagated),
        "label_propagation_early_stop": _sql(f"SELECT node, label, {_q('w')} AS w FROM label_state", *_GRAPH_VIEWS,
                                             extra=_propagation(threshold=EARLY_STOP)),
        "label_delta": _sql(f"""SELECT COUNT(*) FILTER (ABS(a.w - b.w) > 0.15) AS n_moved,
            {_q('MAX(ABS(a.w - b.w))')} AS max_delta FROM s2 a JOIN s3 b ON a.node = b.node AND a.label = b.label""",
                            *_GRAPH_VIEWS, extra=_propagation(rounds=3, threshold=-1.0)),
        "recommendations": _sql(_RECS_Q, *_GRAPH_VIEWS, extra=propagated + [_RECS]),
        "recommendations_all_nodes": _sql(
            f"SELECT label AS username, node AS url, {_q('w')} AS weight FROM label_state",
            *_GRAPH_VIEWS, "news", extra=_propagation(news="news")),
        "recommendations_upsert": _sql("""
            SELECT username, url, 0.75e0 AS weight FROM fresh UNION ALL
            SELECT userid, url, 0.25e0 FROM newslikes
            WHERE NOT EXISTS (SELECT 1 FROM fresh WHERE fresh.username = userid AND fresh.url = newslikes.url)""",
            "newslikes", "user_interest", "news_day",
            extra=["fresh AS (SELECT DISTINCT username, url FROM user_interest JOIN news_day ON interest = category)"]),
        "recommendations_table": _sql("""SELECT userid AS username, url,
            CASE WHEN CAST(SUBSTRING(url, 6) AS BIGINT) % 3 = 0 THEN CAST(CAST(SUBSTRING(url, 6) AS BIGINT) % 7 AS DOUBLE) / 8
                 ELSE 0.5e0 END AS weight FROM newslikes""", "newslikes"),
        "top_recommendations": _sql(f"SELECT username, url, {_q('weight')} AS weight, CAST(place AS INT) AS place FROM top",
                                    *_GRAPH_VIEWS, extra=propagated + [_RECS, _TOP]),
        "news_feed": _sql(f"""SELECT username, CAST(place AS INT) AS place, url, {_q('weight')} AS weight, headline, category, date
            FROM top LEFT JOIN news USING (url)""", *_GRAPH_VIEWS, "news", extra=propagated + [_RECS, _TOP]),
        # ranks
        "graph_distinct": "SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem",
        "degree_table": _sql(f"SELECT v, CAST(out_degree AS BIGINT) AS out_degree, CAST(in_degree AS BIGINT) AS in_degree FROM ({_DEGREES})", "rank_edge"),
        "graph_sinks": _sql("SELECT DISTINCT dst AS v FROM rank_edge WHERE dst NOT IN (SELECT src FROM rank_edge)",
                            "rank_edge"),
        "graph_backlinks": _sql("SELECT src, dst FROM rank_graph", "rank_graph"),
        "social_rank": _sql(ranks_q, "rank_graph", extra=_ranks()),
        "social_rank_converged": _sql(ranks_q, "rank_graph", extra=_ranks(dmax=RANK_DMAX)),
        "social_rank_top10": _sql(f"SELECT v, {_q('r')} AS r FROM (SELECT * FROM ranks ORDER BY {_by_weight('r')}, v LIMIT 10)", "rank_graph", extra=_ranks()),
        # feeds and lookups
        "posts_by_author": _sql("""SELECT author, event_id, timestamp, content, likes, isWall FROM posts
            WHERE author IN (SELECT username FROM users)""", "posts", "users"),
        "comments_by_post": _sql("""SELECT authortime, timestamp, author, content FROM reactions
            WHERE authortime IN (SELECT author || '$' || timestamp FROM posts)""", "reactions"),
        "messages_by_room": _sql("""SELECT groupid, CAST(timestamp AS BIGINT) AS timestamp, author, message,
            '(' || author || ') :' || message AS line, author = 'user' AS is_mine FROM messages""", "messages"),
        "one_author_posts": _sql(f"SELECT author, event_id, timestamp, content, likes, isWall FROM posts WHERE author = '{PAGE_USER}'", "posts"),
        "one_post_comments": _sql("""SELECT authortime, timestamp, author, content FROM reactions
            WHERE authortime = (SELECT MIN(authortime) FROM reactions)""", "reactions"),
        "one_room_messages": _sql("""SELECT groupid, CAST(timestamp AS BIGINT) AS timestamp, author, message,
            '(' || author || ') :' || message AS line, author = 'user' AS is_mine FROM messages
            WHERE groupid = (SELECT MIN(groupid) FROM messages)""", "messages"),
        "one_user_recommendations": _sql(f"""SELECT username, CAST(place AS INT) AS place, url, weight, headline, category, date FROM (
            SELECT *, ROW_NUMBER() OVER (ORDER BY weight DESC, url) AS place FROM (
              SELECT userid AS username, url, CAST(CAST(SUBSTRING(url, 6) AS BIGINT) % 7 AS DOUBLE) / 8 AS weight FROM newslikes
              WHERE userid = '{PAGE_USER}') QUALIFY place <= 5) LEFT JOIN news USING (url)""", "newslikes", "news"),
        "one_user_feed": _sql(f"""SELECT f.username, p.author, p.timestamp, p.content, comment_timestamp, comment_author,
            comment FROM (SELECT * FROM friend_edge WHERE username = '{PAGE_USER}') f JOIN posts p ON p.author = f.friend {_FEED}""",
                              "friend_edge", "reactions"),
        "one_user_wall": _sql(f"""SELECT p.isWall AS owner, p.author, p.timestamp, p.content, comment_timestamp,
            comment_author, comment FROM (SELECT * FROM posts WHERE isWall = '{PAGE_USER}') p
            JOIN friend_edge f ON f.username = p.isWall AND f.friend = p.author {_FEED}""", "friend_edge", "reactions"),
        "posts_append": _sql(f"""SELECT author, timestamp, content, likes, isWall FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY author, timestamp ORDER BY batch DESC, content DESC) AS n FROM (
              SELECT author, timestamp, content, likes, isWall, 0 AS batch FROM posts
              UNION ALL SELECT *, 1 FROM ({_DERIVED}))) WHERE n = 1""", "posts", "profile_log"),
        "friend_feed": _sql(f"""SELECT f.username, p.author, p.timestamp, p.content, comment_timestamp, comment_author,
            comment FROM friend_edge f JOIN posts p ON p.author = f.friend {_FEED}""", "friend_edge", "reactions"),
        "wall_feed": _sql(f"""SELECT p.isWall AS owner, p.author, p.timestamp, p.content, comment_timestamp,
            comment_author, comment FROM posts p JOIN friend_edge f ON f.username = p.isWall AND f.friend = p.author
            {_FEED}""", "friend_edge", "reactions"),
        # people
        "people_search": _sql("""SELECT username, firstname, lastname FROM users
            WHERE contains(firstname, 'Nation_1') AND contains(lastname, 'Auto')""", "users"),
        "people_search_each": _sql("""SELECT text, username, firstname, lastname FROM (
              SELECT DISTINCT 'nation_' || c_nationkey || CASE WHEN c_custkey % 4 = 0 THEN ''
                ELSE ' ' || lower(left(c_mktsegment, CAST(c_custkey % 4 AS INT) + 1)) END AS text FROM customer)
            JOIN users ON contains(firstname, 'N' || substr(split_part(text, ' ', 1), 2))
              AND contains(lastname, upper(left(split_part(text, ' ', 2), 1)) || substr(split_part(text, ' ', 2), 2))""", "users"),
        "last_action": f"SELECT 'u' || user_id AS username, MAX({_ms('ts')}) AS last_action FROM events GROUP BY user_id",
        "presence": _sql(f"SELECT username, {_ONLINE} AS online FROM users", "users"),
        "friends_online": _sql(f"""SELECT f.username, f.friend, {_ONLINE} AS online
            FROM friend_edge f JOIN users u ON u.username = f.friend WHERE f.username <> f.friend""",
                               "friend_edge", "users"),
        "relationship": _sql("""SELECT viewer, owner, CASE WHEN viewer = owner THEN 'self'
            WHEN EXISTS (SELECT 1 FROM friend_edge WHERE username = viewer AND friend = owner) THEN 'friend'
            ELSE 'stranger' END AS relation
            FROM (SELECT DISTINCT sender AS viewer, receiver AS owner FROM friend_ops)""", "friend_edge", "friend_ops"),
        "validate_users": _sql(f"""SELECT username, n_interests >= 2 AND NOT lacks_field AS ok,
            CASE WHEN n_interests < 2 THEN '{FEW_INTERESTS}' WHEN lacks_field THEN '{EMPTY_FIELD}' END AS reason
            FROM signups""", "signups"),
        "friend_expand": _sql("""SELECT f.username AS viewer, f.friend, u.firstname
            FROM friend_edge f JOIN users u ON u.username = f.friend WHERE f.friend <> f.username""",
                              "friend_edge", "users"),
        "friend_expand_visible": _sql("""SELECT q.viewer, q."user", f.friend, u.firstname
            FROM graph_requests q JOIN friend_edge f ON f.username = q."user" AND f.friend <> q."user"
            JOIN users u ON u.username = f.friend LEFT JOIN users v ON v.username = q.viewer
            WHERE u.affiliation = v.affiliation
               OR EXISTS (SELECT 1 FROM friend_edge m WHERE m.username = q.viewer AND m.friend = f.friend)""",
                                      "graph_requests", "friend_edge", "users"),
        "invite_check": _sql("""SELECT request_id, sender,
            EXISTS (SELECT 1 FROM friend_edge WHERE username = sender AND friend = one)
            AND EXISTS (SELECT 1 FROM friend_edge WHERE username = sender AND friend = two) AS allowed
            FROM group_requests""", "friend_edge", "group_requests"),
        "invite_new": _sql("""SELECT sender, receiver FROM (SELECT DISTINCT sender, receiver FROM friend_ops) q
            WHERE EXISTS (SELECT 1 FROM friend_edge f WHERE f.username = q.sender AND f.friend = q.receiver)
              AND NOT EXISTS (SELECT 1 FROM invites i WHERE i.receiver = q.receiver AND i.sender = q.sender)
              AND NOT EXISTS (SELECT 1 FROM plain_rooms r WHERE r.username = q.receiver
                AND r.room = LEAST(q.sender, q.receiver) || ',' || GREATEST(q.sender, q.receiver))""",
                           "friend_edge", "friend_ops", "invites", "plain_rooms"),
        # state from logs
        "new_users": f"""SELECT 'u' || c_custkey AS username, sha256(sha256(c_name)) AS password,
            'Nation_' || c_nationkey AS firstname, SUBSTRING(c_mktsegment, 1, 1) || LOWER(SUBSTRING(c_mktsegment, 2)) AS lastname,
            'u' || c_custkey || '@mail.test' AS email, c_mktsegment AS affiliation, '1990-01-01' AS birthday,
            array_to_string(list_sort(list_distinct(['Brand#' || c_nationkey, 'Brand#30'])), ',') AS interests,
            CAST({NOW_MS} AS BIGINT) AS lastAction, CAST(0 AS INT) AS chatInvites, CAST(0 AS INT) AS rooms,
            'u' || c_custkey AS friend FROM customer WHERE c_acctbal >= 1000 AND c_acctbal < 9000""",
        "profile_latest": _sql("""SELECT username, field, value FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY username, field ORDER BY ts DESC, event_id DESC) AS n
            FROM profile_log) WHERE n = 1""", "profile_log"),
        "derived_posts": _sql(_DERIVED, "profile_log"),
        "friend_state": _sql(_FRIEND_STATE, "friend_ops"),
        "room_state": _sql("SELECT username, room, since FROM rooms", "rooms"),
        "profile_snapshots": _sql("""SELECT username, field, value FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY username, field ORDER BY ts DESC, event_id DESC) AS n
            FROM profile_log) WHERE n = 1""", "profile_log"),
        "friend_snapshots": _sql(_FRIEND_STATE, "friend_ops"),
        "room_snapshots": _sql("SELECT username, room, since FROM rooms", "rooms"),
        "invite_snapshots": _sql("SELECT receiver, sender, since FROM invites", "invites"),
        "room_id": _sql("""SELECT request_id, array_to_string(list_sort([one, two, sender]), ',') AS room
            FROM group_requests""", "group_requests"),
        "invite_state": _sql("SELECT receiver, sender, since FROM invites", "invites"),
        "accepted_rooms": _sql("SELECT event_id, ts, username, room, op FROM accepted", "accepted"),
        "group_accept": _sql("SELECT event_id, ts, username, room, op FROM accepted WHERE contains(sender, ',')", "accepted"),
        "group_invite_new": _sql("""SELECT DISTINCT room AS sender, receiver FROM group_invites q
            WHERE EXISTS (SELECT 1 FROM friend_edge f WHERE f.username = q.inviter AND f.friend = q.receiver)
              AND NOT EXISTS (SELECT 1 FROM invites i WHERE i.receiver = q.receiver AND i.sender = q.inviter)""",
                                 "group_invites", "friend_edge", "invites"),
        "validate_rows": _sql(f"""SELECT event_id, kind, reason IS NULL AS ok, reason FROM (SELECT *, CASE
              WHEN kind = 'interests' THEN CASE WHEN contains(coalesce(value, ''), ',') THEN NULL ELSE '{FEW_INTERESTS}' END
              WHEN coalesce(value, '') <> '' THEN NULL
              {" ".join(f"WHEN kind = '{k}' THEN '{m}'" for k, m in EMPTY_FORM.items())} END AS reason FROM form_rows)""", "form_rows"),
        # search
        "keyword_index": _sql("SELECT keyword, url FROM stem_index", "index_raw", "search_requests", extra=_STEMMED),
        "news_search": _sql(_SEARCH, "index_raw", "search_requests", "article", extra=_STEMMED),
        "keyword_index_stop_table": _sql("SELECT DISTINCT stem AS keyword, url FROM all_words JOIN stems ON word = keyword", "article", extra=[
            """all_words AS MATERIALIZED (SELECT DISTINCT keyword, url FROM (
                 SELECT url, lower(unnest(regexp_extract_all(body, '\\p{L}+'))) AS keyword FROM article))""",
            f"""vocabulary AS MATERIALIZED (SELECT DISTINCT keyword AS word FROM all_words WHERE keyword NOT IN (
                 SELECT keyword FROM all_words GROUP BY keyword ORDER BY COUNT(*) DESC, keyword LIMIT {STOP_WORDS}))""",
            *stems("vocabulary")]),
        "keyword_index_raw": _sql("SELECT keyword, url FROM index_raw", "index_raw"),
        "keyword_hits": _sql("SELECT query_id, url, hits FROM hits", "hits"),
        "keyword_top5": _sql("""SELECT query_id, url, hits, CAST(place AS INT) AS place FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY hits DESC, url) AS place FROM hits)
            WHERE place <= 5""", "hits"),
        # scalars
        "scalar_functions": _sql("""SELECT event_id,
            SUBSTRING(affiliation, 1, 1) || LOWER(SUBSTRING(affiliation, 2)) || ' ' || author AS capitalised,
            author || '$' || timestamp AS post_key,
            'I changed my affiliation to ' || affiliation || '!' AS affiliation_post,
            'I am now interested in A, ' || lastname || ', and ' || firstname || '!' AS three_interests,
            'I am now interested in A, and ' || lastname || '!' AS two_interests,
            sha256(content) AS password_hash,
            strftime(make_timestamp(timestamp * 1000), '%b %d %Y %H:%M') AS display_date,
            author AS wall_owner, '(' || author || ') :' || content AS chat_line
            FROM posts JOIN users ON author = username""", "posts", "users"),
        # streams: the state after all rows
        "stream_presence": f"""SELECT username, lastAction AS last_action, {_ONLINE} AS online FROM (
            SELECT 'u' || user_id AS username, MAX({_ms('ts')}) AS lastAction FROM events GROUP BY user_id)""",
        "stream_chat": _sql("SELECT DISTINCT groupid, author, message FROM messages", "messages"),
        "stream_friend_state": _sql(_FRIEND_STATE, "friend_ops"),
        "stream_presence_expiry": f"""SELECT username, lastAction AS last_action, {_ONLINE} AS online FROM (
            SELECT 'u' || user_id AS username, MAX({_ms('ts')}) AS lastAction FROM events GROUP BY user_id)""",
        "stream_recommend": _sql(f"""SELECT username, url, {_q('weight')} AS weight FROM (SELECT * FROM batch_recs
            QUALIFY ROW_NUMBER() OVER (PARTITION BY username, url ORDER BY batch DESC) = 1)""",
                                 *_GRAPH_VIEWS, extra=_batched_propagation(STREAM_BATCHES)),
    }
