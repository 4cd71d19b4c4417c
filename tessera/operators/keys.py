"""Key handling shared by every operator: null-safe joins, join-backs and
skew-safe positions.

Skew rule used throughout: a single key may hold a third of all rows, so no
operator puts all rows of one key into one task.  Group statistics are
computed with ``groupBy`` (partial aggregation before the shuffle, so a hot
key costs one row per map task) and attached back with a join of two shuffled
sides, which AQE turns into a broadcast when the statistics are small at
runtime and whose hot partition it splits otherwise (:func:`join_back`).
Order-dependent work (ranks, shifts, first/last, running totals) goes through
a written rank index (:func:`rank_index`): rows range-partitioned by key and
order, numbered within (key, part), and for the few keys that go on from one
part to the next the rows of their earlier parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (list, tuple)):
        return list(x)
    return [x]


def tmp_names(df: DataFrame, *names: str) -> list[str]:
    """Column names guaranteed not to clash with ``df``."""
    taken = set(df.columns)
    out = []
    for n in names:
        cand = f"__{n}"
        while cand in taken:
            cand += "_"
        taken.add(cand)
        out.append(cand)
    return out


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
            null_safe: bool = True) -> DataFrame:
    """Join on same-named keys; keeps the left key columns only.

    ``null_safe=True`` matches null to null (pandas ``merge`` semantics);
    ``False`` is SQL equality, under which null keys never match.
    """
    keys = as_list(keys)
    if not null_safe:
        return left.join(right, on=keys, how=how)
    ren = tmp_names(left, *[f"r_{k}" for k in keys])
    r = right.withColumnsRenamed(dict(zip(keys, ren)))
    cond = None
    for k, rk in zip(keys, ren):
        c = left[k].eqNullSafe(r[rk])
        cond = c if cond is None else (cond & c)
    out = left.join(r, on=cond, how=how)
    if how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti"):
        return out
    return out.drop(*ren)


def join_back(df: DataFrame, stats: DataFrame, keys: Sequence[str],
              null_keys_match: bool = False) -> DataFrame:
    """Attach per-key statistics to every row of ``df`` (left join).

    ``null_keys_match=False`` follows pandas ``groupby``: rows whose key is
    null get null statistics.

    An aggregate by ``keys`` is already partitioned by them and would be
    joined as it lies; its side would be no shuffle stage, and AQE splits hot
    partitions of joins of two shuffle stages only.  A hash of the keys as one
    more join key makes both sides be shuffled for the join.
    """
    keys = as_list(keys)
    types = dict(df.dtypes)
    if null_keys_match or any(types[k] != t for k, t in stats.dtypes if k in keys):
        return join_on(df, stats, keys, "left", null_safe=null_keys_match)
    (s,) = tmp_names(df, "spread")
    spread = F.xxhash64(*keys)
    return df.withColumn(s, spread).join(stats.withColumn(s, spread), on=[*keys, s], how="left").drop(s)


def any_null(cols: Sequence[str]) -> Column:
    c = None
    for k in cols:
        t = F.col(k).isNull()
        c = t if c is None else (c | t)
    return c if c is not None else F.lit(False)


def global_position(df: DataFrame, order: Sequence[Column | str], name: str = "pos") -> DataFrame:
    """Add the 0-based position of each row in the total order ``order``.

    ``order`` should end in a unique column so the position is a function of
    the data.  The frame is range-partitioned by ``order`` (one hot value of a
    leading key is spread over many partitions), each row gets its offset
    inside its partition, and partition offsets come from a table with one
    row per partition (bounded by the partition count, hence broadcast).
    """
    pid, mid, loc, cnt, off = tmp_names(df, "pid", "mid", "loc", "cnt", "off")
    s = (df.orderBy(*order)
         .withColumn(pid, F.spark_partition_id())
         .withColumn(mid, F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition index << 33) + row index
    s = s.withColumn(loc, F.col(mid) - F.shiftleft(F.col(pid).cast("long"), 33)).drop(mid)
    # The partition sizes and the rows are two branches over the same sorted
    # data.  Writing it once as a table in the shared checkpoint folder (one
    # sort, one write; survives executor loss) keeps it from being scanned
    # and range-sorted once per branch.  Row order need not survive the
    # write: each row carries its partition index and offset.
    s = cut_lineage(s, "sorted")
    per_part = s.groupBy(pid).agg(F.count(F.lit(1)).alias(cnt))
    w = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(pid, F.coalesce(F.sum(cnt).over(w), F.lit(0)).alias(off))
    return (s.join(F.broadcast(offsets), pid)
             .withColumn(name, F.col(off) + F.col(loc))
             .drop(pid, loc, off))


class RankIndex(NamedTuple):
    """A written table of rows dealt out by ranges of (key, order).

    ``rows`` has the input's columns and ``part``, the number of the range;
    every row of a part comes before every row of the next one.  ``carried``
    has a row per (key, part) that continues a key of earlier parts: the rows
    (or the weight) of the key in these, ``before``, and its ``last`` part.
    Ranges are in the order of the keys, so that at most one key goes on from
    a part to the next: ``carried`` has fewer rows than there are parts."""

    rows: DataFrame
    carried: DataFrame
    keys: list[str]
    order: list[Column]
    part: str

    def window(self):
        """A key's rows of one part, in order."""
        return Window.partitionBy(*self.keys, self.part).orderBy(*self.order)

    def with_carried(self, rows: DataFrame, before: str) -> DataFrame:
        """``rows`` with column ``before``: what the key's earlier parts have."""
        few = self.carried.select(*self.keys, self.part, F.col("before").alias(before))
        out = join_on(rows, F.broadcast(few), [*self.keys, self.part], "left")  # under one row per part
        return out.withColumn(before, F.coalesce(before, F.lit(0)))


def rank_index(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], weight: str | None = None) -> RankIndex:
    """The rank index of ``df``: one scan and one shuffle by ranges, as many
    as there are shuffle partitions with rows, so that parts grow in number
    with the rows and a key of any share of them is cut into as many as it
    fills.  Written once: rows and part sizes are read from the same parts."""
    keys = as_list(keys)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    (part,) = tmp_names(df, "part")
    rows = cut_lineage(df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], *order)
                       .withColumn(part, F.spark_partition_id()), "rank-index")
    each = F.lit(1) if weight is None else F.col(weight)
    sizes = rows.groupBy(*keys, part).agg(F.sum(each).alias("size"))
    # at most as many rows of a key as there are parts
    key_parts = Window.partitionBy(*keys).orderBy(part)
    carried = sizes.select(*keys, part, F.sum("size").over(key_parts.rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    return RankIndex(rows, carried.filter("before is not null"), keys, order, part)


def ordinal_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   name: str = "ordinal", weight: str | None = None) -> DataFrame:
    """0-based row number within each key in ``order`` (columns, possibly with
    a direction, that should end in a unique one); with ``weight``, the sum of
    that column over the earlier rows of the key instead.  Null keys form a
    group.  Rows are numbered within the parts of a :func:`rank_index`."""
    (off,) = tmp_names(df, "off")
    index = rank_index(df, keys, order, weight)
    w = index.window()
    inner = (F.row_number().over(w) - 1 if weight is None else
             F.coalesce(F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    p = index.with_carried(index.rows.withColumn(name, inner), off)
    return p.withColumn(name, (F.col(name) + F.col(off)).cast("bigint")).drop(index.part, off)


def lag_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str, n: int,
               name: str) -> DataFrame:
    """``value`` of the row ``n`` places earlier (n > 0) or later (n < 0) of
    the same key as column ``name``, null where there is none: ``lag`` within
    the parts of a :func:`rank_index`, and for the first ``n`` rows of a part
    that continues a key the last ``n`` before it, which are carried over (at
    most ``n`` rows for each part of the table)."""
    index = rank_index(df, keys, order)
    keys = index.keys
    at, off, has, got = tmp_names(df, "at", "off", "has", "got")
    w = index.window()
    moved_by = (lambda c: F.lag(c, n)) if n >= 0 else (lambda c: F.lead(c, -n))
    p = index.rows.withColumns({at: F.row_number().over(w) - 1, has: moved_by(F.lit(1)).over(w), name: moved_by(value).over(w)})
    p = index.with_carried(p, off).withColumn(at, F.col(at) + F.col(off))
    # the places of a key that rows on the other side of one of its cuts look for
    cut = F.col("before")
    places = F.sequence(cut - n, cut - 1) if n > 0 else F.sequence(cut, cut - n - 1) if n < 0 else F.array()
    wanted = index.carried.select(*keys, F.explode(places.cast("array<bigint>")).alias(at)).distinct()
    seen = join_on(p.select(*keys, at, F.col(value).alias(got)), F.broadcast(wanted), [*keys, at], "inner")
    found = seen.select(*keys, (F.col(at) + n).alias(at), got)
    out = join_on(p.withColumn(at, F.when(F.col(has).isNull(), F.col(at))), F.broadcast(found), [*keys, at], "left")
    return out.withColumn(name, F.when(F.col(has).isNull(), F.col(got)).otherwise(F.col(name))).drop(at, off, has, got, index.part)


def with_group_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows per key attached to every row (partial aggregate + join-back,
    null keys form one group)."""
    keys = as_list(keys)
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return join_on(df, n, keys, "left", null_safe=True)


def attach_scalar(df: DataFrame, stats: DataFrame, name: str) -> DataFrame:
    """Attach a 1-row statistics frame to every row as struct column ``name``.

    Uses a scalar subquery (evaluated once, result shipped with the plan), so
    no join is planned; ``stats`` must be a global aggregate (one row).
    """
    return df.withColumn(name, stats.select(F.struct(*[F.col(c) for c in stats.columns])).scalar())
