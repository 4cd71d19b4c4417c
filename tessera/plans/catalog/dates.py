"""Queries: date arithmetic on text dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.plans.registry import query
from tessera.session import read_table


def _txt(c):
    return F.col(c).cast("string")


@query("diff_days", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
  CAST(date_diff('day', CAST(substr(CAST(o.o_orderdate AS VARCHAR), 1, 10) AS DATE),
                   CAST(substr(CAST(l.l_shipdate AS VARCHAR), 1, 10) AS DATE)) AS INTEGER) AS days
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def diff_days(spark, sf_dir):
    """Whole days from order date to ship date (first 10 characters)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", "l_partkey",
                    D.diff_days(_txt("l_shipdate"), _txt("o_orderdate")).alias("days"))


_US = "epoch_us(CAST(CAST(ts AS VARCHAR) AS TIMESTAMP))"
_DAY_US = "epoch_us(CAST(strftime(ts, '%Y-%m-%d') AS TIMESTAMP))"


@query("diff_minutes_hours", f"""
SELECT event_id,
  CAST(abs(floor(({_US} - {_DAY_US}) / 60000000.0)) AS BIGINT) AS min_fwd,
  CAST(abs(floor(({_DAY_US} - {_US}) / 60000000.0)) AS BIGINT) AS min_back,
  CAST(abs(floor(({_US} - {_DAY_US}) / 3600000000.0)) AS BIGINT) AS hour_fwd,
  CAST(abs(floor(({_DAY_US} - {_US}) / 3600000000.0)) AS BIGINT) AS hour_back
FROM events""")
def diff_minutes_hours(spark, sf_dir):
    """Minutes/hours between an event and its midnight, both directions
    (floor before abs)."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts")
    day = F.date_format("ts", "yyyy-MM-dd")
    return e.select("event_id", D.diff_minutes(_txt("ts"), day).alias("min_fwd"),
                    D.diff_minutes(day, _txt("ts")).alias("min_back"),
                    D.diff_hours(_txt("ts"), day).alias("hour_fwd"),
                    D.diff_hours(day, _txt("ts")).alias("hour_back"))


@query("date_add", """
SELECT o_orderkey,
  strftime(CAST(substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS DATE) + INTERVAL 45 DAY, '%Y-%m-%d') AS plus45d,
  strftime(CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) + INTERVAL 30 HOUR, '%Y-%m-%d %H:%M:%S') AS plus30h
FROM orders""")
def date_add(spark, sf_dir):
    """Dates shifted by days / hours and formatted as text."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return o.select("o_orderkey", D.add_days(_txt("o_orderdate"), 45).alias("plus45d"),
                    D.add_hours(_txt("o_orderdate"), 30).alias("plus30h"))
