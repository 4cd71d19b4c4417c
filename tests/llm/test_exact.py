import hashlib
from collections import defaultdict

import pytest

import __spark_entry__ as entry
from oracle_compare import run_pair
from tessera.llm import exact

ROWS = [(1, "Abc", "x"), (2, "aBC", "y"), (3, None, None), (4, "", "z"), (5, "É", "x"), (6, "é", "x"),
        (7, "abd", "x"), (7, "abd", "x"), (None, "abc", "n"), (8, "w " * 50_000, "x"), (9, "W " * 50_000, "x"),
        (10, "w " * 49_999 + "v ", "x")]


def brute(rows):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))
    g = defaultdict(list)
    for i, t, _ in rows:
        g[low(t)].append(i)
    out = []
    for i, t, _ in rows:
        ids = g[low(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(low(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("slots", [1, 7, exact.SLOTS])
def test_groups_match_brute_force(spark, slots):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, keep_id string")
    got = exact.exact_groups(df, digest_of_all=True, slots=slots)
    rows = [tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "digest").collect()]
    assert sorted(rows, key=str) == brute(ROWS)


def test_drop_copies_keeps_one_row_of_each(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, keep_id string")
    got = exact.drop_copies(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == [2, 4, 5, 6, 7, 9, 10]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact.exact_groups(df).count() == 0 and exact.drop_copies(df).count() == 0


def test_query_matches_sql(spark):
    err = run_pair(spark, "op4_exact_dedup", "/root/testdata/sf0.01", entry.queries(), entry.oracle_sql())[2]
    assert err is None, err
