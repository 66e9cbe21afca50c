"""Reusable DuckDB SQL fragments for the oracle queries.

They spell out the same catalog mapping as ``tastebud.sources.catalog``:
ratings = last order line per (customer, part), rating = ceil(quantity/10),
hash split (31*user + 17*item) mod 10 < 7 for train.
"""

from __future__ import annotations

RATINGS = """
_rt_raw AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
         CAST(ceil(l.l_quantity / 10.0) AS INTEGER) AS rating, o.o_orderdate AS ts,
         row_number() OVER (PARTITION BY o.o_custkey, l.l_partkey
                            ORDER BY o.o_orderdate DESC, l.l_orderkey DESC,
                                     l.l_linenumber DESC, l.l_quantity DESC) AS _rn
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
ratings AS (SELECT user_id, item_id, rating, ts FROM _rt_raw WHERE _rn = 1),
train AS (SELECT * FROM ratings WHERE (user_id * 31 + item_id * 17) % 10 < 7),
test AS (SELECT * FROM ratings WHERE (user_id * 31 + item_id * 17) % 10 >= 7)"""

IMPLICIT = """
implicit AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         value AS weight, event_type, ts
  FROM events)"""

# binary item cosine (S4), both directions
ITEM_COS = """
pop AS (SELECT item_id, COUNT(*) AS n FROM train GROUP BY item_id),
co AS (SELECT a.item_id AS i, b.item_id AS j, COUNT(*) AS c
       FROM train a JOIN train b ON a.user_id = b.user_id AND a.item_id <> b.item_id
       GROUP BY a.item_id, b.item_id),
isim AS (SELECT co.i, co.j, co.c / sqrt(CAST(p1.n * p2.n AS DOUBLE)) AS w
         FROM co JOIN pop p1 ON co.i = p1.item_id JOIN pop p2 ON co.j = p2.item_id)"""

# binary user cosine (S5), both directions
USER_COS = """
ucnt AS (SELECT user_id, COUNT(*) AS n FROM train GROUP BY user_id),
uco AS (SELECT a.user_id AS i, b.user_id AS j, COUNT(*) AS c
        FROM train a JOIN train b ON a.item_id = b.item_id AND a.user_id <> b.user_id
        GROUP BY a.user_id, b.user_id),
usim AS (SELECT uco.i, uco.j, uco.c / sqrt(CAST(p1.n * p2.n AS DOUBLE)) AS w
         FROM uco JOIN ucnt p1 ON uco.i = p1.user_id JOIN ucnt p2 ON uco.j = p2.user_id)"""


def topk(src: str, k: int, name: str) -> str:
    return f"""
{name} AS (SELECT i, j, w FROM (
   SELECT i, j, w, row_number() OVER (PARTITION BY i ORDER BY w DESC, j) AS _rk FROM {src})
   WHERE _rk <= {k})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"

USER_MOVIES = """
user_movies AS (
  SELECT CAST(user_id AS VARCHAR) AS "user",
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS item_id,
         CASE WHEN event_type = 'error' THEN -1 ELSE CAST(ceil(value / 100.0) AS INTEGER) END AS "count",
         event_id
  FROM events)"""

WIDE = """
_evs AS (SELECT user_id, COUNT(*) AS ne,
                CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / (100.0 * COUNT(*)) AS mv,
                COUNT(DISTINCT event_type) AS nt
         FROM events GROUP BY user_id),
wide AS (
  SELECT c.c_custkey AS id, CAST(c.c_mktsegment = 'BUILDING' AS INTEGER) AS target,
         c.c_acctbal AS acctbal, c.c_nationkey AS nation, c.c_mktsegment AS segment,
         CAST(COALESCE(e.ne, -1) AS BIGINT) AS n_events,
         CAST(COALESCE(e.mv, -1.0) AS DOUBLE) AS mean_value,
         CAST(COALESCE(e.nt, -1) AS BIGINT) AS n_types
  FROM customer c LEFT JOIN _evs e ON c.c_custkey = e.user_id)"""

# most active user in ratings (ties: smallest id), and its train items
TOP_USER = """
top_user AS (SELECT user_id AS x FROM ratings GROUP BY user_id
             ORDER BY COUNT(*) DESC, user_id LIMIT 1)"""
