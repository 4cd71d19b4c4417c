"""Per-group standardisation, normalisation, ranks and shifts.

Whole-group statistics are partial aggregates joined back; order-dependent
results (ranks, lag/lead, n-th from first/last) come from the written rank
index of ``keys``, which cuts a hot key into as many parts as it fills instead
of one window partition.  Rows with a null key get the pandas ``groupby`` result
for a dropped group (0 / ``start`` for the scalers, null otherwise).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.keys import any_null, as_list, join_back, lag_within, ordinal_within, tmp_names, with_group_count
from tessera.session import cut_lineage


def grp_standard(df: DataFrame, key: str | Sequence[str], names: Sequence[str], drop: bool = False) -> DataFrame:
    """``(x - mean) / std`` per key (std n-1); undefined or null → 0."""
    keys = as_list(key)
    kname = "_".join(keys)
    tm = tmp_names(df, *[f"m{i}" for i in range(len(names))], *[f"s{i}" for i in range(len(names))])
    means, stds = tm[:len(names)], tm[len(names):]
    st = df.groupBy(*keys).agg(*[F.avg(n).alias(m) for n, m in zip(names, means)],
                               *[F.stddev_samp(n).alias(s) for n, s in zip(names, stds)])
    out = join_back(df, st, keys)
    new = {}
    for n, m, s in zip(names, means, stds):
        z = F.try_divide(F.col(n) - F.col(m), F.col(s))
        new[n if drop else f"{n}_{kname}_standardize"] = F.coalesce(z, F.lit(0.0))
    return out.withColumns(new).drop(*means, *stds)


def grp_normalize(df: DataFrame, key: str | Sequence[str], names: Sequence[str], start: float = 0.0,
                  drop: bool = False) -> DataFrame:
    """``(x - min) / (max - min)`` per key; undefined or null → ``start``."""
    keys = as_list(key)
    kname = "_".join(keys)
    tm = tmp_names(df, *[f"lo{i}" for i in range(len(names))], *[f"hi{i}" for i in range(len(names))])
    los, his = tm[:len(names)], tm[len(names):]
    st = df.groupBy(*keys).agg(*[F.min(n).alias(a) for n, a in zip(names, los)],
                               *[F.max(n).alias(b) for n, b in zip(names, his)])
    out = join_back(df, st, keys)
    new = {}
    for n, lo, hi in zip(names, los, his):
        z = F.try_divide((F.col(n) - F.col(lo)).cast("double"), F.col(hi) - F.col(lo))
        new[n if drop else f"{n}_{kname}_normalize"] = F.coalesce(z, F.lit(float(start)))
    return out.withColumns(new).drop(*los, *his)


def grp_rank(df: DataFrame, key: str | Sequence[str], names: Sequence[str], tiebreak: Sequence[str],
             ascending: bool = True, suffix: str = "_rank") -> DataFrame:
    """0-based position of each row within its key ordered by the value
    (nulls last, ties by ``tiebreak``); one ``<name><suffix>`` per column;
    null for a null key.

    Several columns: the rows are written once with a row number, each column
    is ranked as a narrow table of keys, value and ties, and the ranks are
    joined to the rows by the number; the input is read once however many
    columns are ranked."""
    keys, names, ties = as_list(key), as_list(names), as_list(tiebreak)
    row, v = tmp_names(df, "row", "v")
    rows = df if len(names) < 2 else cut_lineage(df.withColumn(row, F.monotonically_increasing_id()), "ranked-rows")
    out = rows
    for n in names:
        order = [F.col(v).asc_nulls_last() if ascending else F.col(v).desc_nulls_last(), *[F.col(t) for t in ties]]
        if len(names) == 1:
            out = ordinal_within(rows.withColumn(v, F.col(n)), keys, order, f"{n}{suffix}").drop(v)
        else:
            narrow = rows.select(*dict.fromkeys([*keys, *ties, row]), F.col(n).alias(v))
            out = out.join(ordinal_within(narrow, keys, order, f"{n}{suffix}").select(row, f"{n}{suffix}"), row)
        out = out.withColumn(f"{n}{suffix}", F.when(~any_null(keys), F.col(f"{n}{suffix}")))
    return out.drop(row)


def group_rank(df: DataFrame, keys: Sequence[str], value: str, tiebreak: Sequence[str],
               ascending: bool = True, name: str = "rank") -> DataFrame:
    """As :func:`grp_rank` for a key tuple, one rank column ``name``."""
    keys = as_list(keys)
    v = F.col(value).asc_nulls_last() if ascending else F.col(value).desc_nulls_last()
    out = ordinal_within(df, keys, [v] + [F.col(t) for t in as_list(tiebreak)], name)
    return out.withColumn(name, F.when(~any_null(keys), F.col(name)))


def diff_prev(df: DataFrame, keys: Sequence[str], value: str, n: int, order: Sequence[Column | str],
              name: str | None = None) -> DataFrame:
    """``value - value n rows earlier`` (n < 0: later) within the key (pandas
    ``shift(n)``); null where there is none or the key is null."""
    keys = as_list(keys)
    name = name or f"{value}_diff{n}"
    (prev,) = tmp_names(df, "prev")
    out = lag_within(df, keys, order, value, n, prev)
    return out.withColumn(name, F.when(~any_null(keys), F.col(value) - F.col(prev))).drop(prev)


def _nth_from_end(data: DataFrame, stat: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                  value: str, shift: int, name: str, from_last: bool) -> DataFrame:
    keys = as_list(keys)
    o, cnt = tmp_names(stat, "ord", "cnt")
    p = with_group_count(ordinal_within(stat, keys, order, o), keys, cnt)  # Catalyst prunes unused columns
    target = (F.col(cnt) - 1 - F.lit(shift)) if from_last else F.lit(shift)
    picked = p.filter(F.col(o) == target).select(*keys, F.col(value).alias(name))
    return join_back(data, picked, keys)


def nth_from_last(data: DataFrame, stat: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                  value: str, shift: int, name: str = "value") -> DataFrame:
    """Per key of ``stat`` (sorted by ``order``): the value ``shift`` rows
    before the last row; attached to ``data`` by key."""
    return _nth_from_end(data, stat, keys, order, value, shift, name, True)


def nth_from_first(data: DataFrame, stat: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   value: str, shift: int, name: str = "value") -> DataFrame:
    """Per key: the value ``shift`` rows after the first row."""
    return _nth_from_end(data, stat, keys, order, value, shift, name, False)
