"""DuckDB SQL twins of ``tessera.plans.frames`` (as CTE bodies)."""

from __future__ import annotations

LINE4 = """line4 AS (
  SELECT l_orderkey, chunk,
         max(CASE WHEN i = 0 THEN c END) AS v1, max(CASE WHEN i = 1 THEN c END) AS v2,
         max(CASE WHEN i = 2 THEN c END) AS v3, max(CASE WHEN i = 3 THEN c END) AS v4
  FROM (SELECT l_orderkey, c, (rn - 1) // 4 AS chunk, (rn - 1) % 4 AS i
        FROM (SELECT l_orderkey, CAST(round_even(l_discount * 100, 0) AS BIGINT) AS c,
                     row_number() OVER (PARTITION BY l_orderkey
                                        ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn
              FROM lineitem) t) t
  GROUP BY l_orderkey, chunk)"""

FEES4 = """fees4 AS (
  SELECT w.f1, w.f2, w.f3, w.f4, c.c_custkey, c.c_nationkey, c.c_mktsegment, c.c_acctbal,
         coalesce(w.chunk, 0) AS chunk, c.c_custkey * 1048576 + coalesce(w.chunk, 0) AS row_id
  FROM customer c LEFT JOIN (SELECT o_custkey, chunk,
               max(CASE WHEN i = 0 THEN c END) AS f1, max(CASE WHEN i = 1 THEN c END) AS f2,
               max(CASE WHEN i = 2 THEN c END) AS f3, max(CASE WHEN i = 3 THEN c END) AS f4
        FROM (SELECT o_custkey, c, (rn - 1) // 4 AS chunk, (rn - 1) % 4 AS i
              FROM (SELECT o_custkey, CAST(round_even(o_totalprice * 100, 0) AS BIGINT) AS c,
                           row_number() OVER (PARTITION BY o_custkey
                                              ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
                    FROM orders) t) t
        GROUP BY o_custkey, chunk) w
  ON w.o_custkey = c.c_custkey)"""

RAWTEXT = """rawtext AS (
  SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderstatus,
         CASE WHEN o_orderkey % 17 = 0 THEN '\\N'
              WHEN o_orderkey % 13 = 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
              ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END AS fee
  FROM orders)"""

USERS = """users AS (SELECT user_id, ts, event_id, event_type, value FROM events)"""


def _slice(i: int) -> str:
    return (f"CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), {1 + 8 * i}, 8))::UBIGINT AS DOUBLE)")


PROB3 = f"""prob3 AS (
  SELECT o_orderkey, a / (a + b + c) AS p_0, b / (a + b + c) AS p_1, c / (a + b + c) AS p_2,
         CAST(o_orderkey % 3 AS INTEGER) AS true_class
  FROM (SELECT o_orderkey, {_slice(0)} AS a, {_slice(1)} AS b, {_slice(2)} AS c FROM orders) t)"""

FRAMES = {"line4": LINE4, "fees4": FEES4, "rawtext": RAWTEXT, "users": USERS, "prob3": PROB3}


def with_frames(body: str, *names: str, extra: str | None = None) -> str:
    """``WITH <frames>[, extra] <body>``."""
    ctes = [FRAMES[n] for n in names]
    if extra:
        ctes.append(extra)
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
