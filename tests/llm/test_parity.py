import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.llm import parity
from tessera.llm.base import shingle_set
from tessera.session import cut_lineage

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, words, num, den):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        n = min(words, len(w))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    having = {}
    for i, s in sets.items():
        for e in s:
            having.setdefault(e, []).append(i)
    pairs = {p for v in having.values() for p in combinations(sorted(set(v)), 2)}
    for a, b in pairs:
        c = len(sets[a] & sets[b])
        if c * den >= len(sets[a] | sets[b]) * num:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def random_rows(seed, n=260):
    """Families of copies with edits around the threshold, chains, tiny texts."""
    r = random.Random(seed)
    word = lambda: "w%d" % r.randrange(400)
    rows = []
    while len(rows) < n:
        base = [word() for _ in range(r.choice([1, 2, 3, 4, 6, 9, 15, 30, 60, 200]))]
        for _ in range(r.randrange(1, 9)):
            t = list(base)
            for _ in range(r.randrange(0, 1 + len(t) // 25)):
                t[r.randrange(len(t))] = word()
            base = t if r.random() < 0.5 else base
            rows.append((len(rows), " ".join(t).upper() if r.random() < 0.2 else "\t".join(t)))
    return rows


@pytest.mark.parametrize("seed, words, num, den", [(1, 3, 9, 10), (2, 5, 4, 5), (3, 1, 4, 5), (4, 2, 1, 2)])
def test_components_match_brute_force(spark, monkeypatch, seed, words, num, den):
    monkeypatch.setattr(parity, "TILE", 3)
    rows = random_rows(seed) + [(9001, None), (9002, ""), (9003, " \n\t"), (9004, "One"), (9005, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", parity.F.lit(1))
    got = sorted(tuple(x) for x in parity.similar_groups(df, words=words, num=num, den=den).collect())
    assert got == brute(rows, words, num, den)


@pytest.mark.parametrize("num, den", [(9, 10), (4, 5), (1, 2)])
def test_linked_sets_share_a_key(num, den):
    r = np.random.default_rng(0)
    for n in [*range(1, 40), 100, 333, 1000]:
        for _ in range(6):
            a = r.integers(0, 2 ** 63, n).astype(np.uint64)
            b = a.copy()
            extra = r.integers(0, 2 ** 63, n).astype(np.uint64)
            out, more = r.integers(0, n // 5 + 1, 2)
            b = np.unique(np.r_[b[out:], extra[:more]])
            common = len(np.intersect1d(a, b))
            if len(b) and common * den >= (len(np.union1d(a, b))) * num:
                assert np.intersect1d(parity.block_keys(np.unique(a), num, den), parity.block_keys(b, num, den)).size


@pytest.mark.parametrize("bits, tile", [(64, 40), (64, 5), (2048, 1500)])
def test_large_families_of_close_texts(spark, monkeypatch, bits, tile):
    """Texts around one base, most of them too far apart to be linked; narrow
    sketches allow many pairs that fail."""
    monkeypatch.setattr(parity, "BITS", bits)
    monkeypatch.setattr(parity, "TILE", tile)
    r = random.Random(7)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(220):
        t = list(base)
        for _ in range(r.choice([1, 2, 2, 3])):
            t[r.randrange(len(t))] = f"e{r.randrange(10 ** 6)}"
        rows.append((i, " ".join(t)))
    want = brute(rows, 3, 9, 10)
    assert 20 < len({c for _, _, c in want}) < 220
    got = sorted(tuple(x) for x in parity.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == want


def test_a_tile_gives_fewer_pairs_than_rows(spark):
    """A family of 3,000 close rows: what comes out grows with the rows, not
    with their pairs."""
    df = spark.range(3000).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("v"), F.col("id").alias("c"),
                                  F.lit(200).cast("long").alias("n"), F.array_repeat(F.lit(0).cast("long"), 32).alias("bits"))
    out = parity._tiles(df, 9, 10, 1500).collect()
    assert 2999 <= len(out) < 3 * 3000


def test_parity_bits_bound_the_difference():
    a = shingle_set(" ".join(f"x{i}" for i in range(300)), 3)
    b = shingle_set(" ".join(f"x{i}" for i in range(20, 310)), 3)
    apart = np.bitwise_count((parity.parity_bits(a) ^ parity.parity_bits(b)).view(np.uint64)).sum()
    assert 0 < apart <= len(np.setxor1d(a, b))


def test_drop_similar_and_edges(spark):
    long = " ".join(f"t{i}" for i in range(20_000))
    rows = [(5, long, 1), (3, long + " end", 2), (8, None, 3), (9, "", 4), (None, long, 5), (7, "a b", 6), (7, "a b", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = parity.drop_similar(df)
    assert got.columns == df.columns
    assert sorted((str(r.doc_id) for r in got.collect())) == ["3", "7", "7", "8", "9", "None"]
    assert parity.similar_groups(df.limit(0)).count() == 0


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in entry.queries()["op10_jaccard_join"](spark, sf).collect())
    assert got == brute(rows, 3, 9, 10)


def test_a_tile_task_holds_one_batch_at_a_time(spark, monkeypatch):
    """The batches of a task are read as they are worked on."""
    read, seen = [], []

    def run(self, f, schema):
        n = 4
        def batches():
            for k in range(n):
                read.append(k)
                yield pa.RecordBatch.from_pydict({
                    **{c: pa.array(v, pa.int64()) for c, v in zip(
                        ("k", "p", "q", "own", "v", "c", "n"), ([k, k], [0, 0], [0, 0], [0, 0], [1, 2], [1, 2], [9, 9]))},
                    "bits": pa.array([[1], [1]], pa.list_(pa.int64()))})
        for b in f(batches()):
            seen.append((b["k"].to_pylist(), len(read)))
        return self
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", run)
    rows = spark.createDataFrame([(1, 1, 1, 9, [1])], "k long, v long, c long, n long, bits array<long>")
    parity._tiles(rows, 9, 10, 100)
    # a tile is given out when the next one begins
    assert seen == [([0], 2), ([1], 3), ([2], 4), ([3], 4)]


def test_keys_are_shuffled_once(spark, monkeypatch):
    written = {}

    def cut(df, name=None, *args):
        written.setdefault(name, df)
        return cut_lineage(df, name, *args)

    monkeypatch.setattr(parity, "cut_lineage", cut)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    rows = [(i, " ".join(f"w{j}" for j in range(40)) + f" x{i % 7} y{i % 3}") for i in range(30)] + [(99, "a b"), (98, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = parity.similar_groups(df, words=3, num=4, den=5).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: 0 if i < 30 else i for i, _ in rows}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # a plan that shows what is read twice
        plans = {n: df.select("*")._jdf.queryExecution().executedPlan().toString() for n, df in written.items()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    shuffled = [line for p in plans.values() for line in p.split("\n") if "Exchange hashpartitioning(k#" in line]
    keyed = {n: p for n, p in plans.items() if "explode(keys" in p}
    assert list(keyed) == ["sharing"]
    assert keyed["sharing"].count("Exchange hashpartitioning(k#") - keyed["sharing"].count("ReusedExchange") in (0, 1)
    assert keyed["sharing"].count("ReusedExchange") == 1 and shuffled


def test_keys_with_the_same_rows_are_compared_once(spark):
    rows = [(1, 10), (1, 11), (1, 12), (2, 12), (2, 10), (2, 11), (3, 10), (3, 11), (3, 13), (4, 10), (4, 10), (4, 12),
            (5, 10), (5, 11), (5, 11), (6, 20), (6, 21)]
    members = spark.createDataFrame(rows, "k long, v long")
    label = spark.createDataFrame([(20, 20), (21, 20)], "v long, c long")
    got = sorted(tuple(r) for r in parity._apart(members, label).select("k", "v", "c").collect())
    assert got == sorted((k, v, v) for k, v in rows if k not in (2, 6))


def test_only_rows_joined_with_a_failed_pair_are_compared_again(spark):
    """Of one key, the rows around four texts and one by itself; one pair fails."""
    bits = lambda x: [(1 << 62) - 1 if i == x else 0 for i in range(32)]
    c = {1: 1, 2: 2, 3: 1, 4: 4, 5: 5, 6: 4, 7: 7, 8: 8, 9: 9}
    family = {1: 0, 2: 0, 3: 3, 4: 1, 5: 1, 6: 4, 7: 2, 8: 2, 9: 5}
    rows = cut_lineage(spark.createDataFrame([(k, v, c[v], 100, bits(family[v])) for k in (1, 2) for v in c],
                                             "k long, v long, c long, n long, bits array<long>"))
    found = cut_lineage(parity._tiles(rows, 9, 10, 100))
    assert sorted({(r.a, r.b) for r in found.collect()}) == [(1, 2), (4, 5), (7, 8)]
    failed = spark.createDataFrame([(4, 5)], "a long, b long")
    got = sorted(tuple(r) for r in parity._torn(rows.select("k", "v", "c"), found, failed).collect())
    assert got == [(4, 4), (4, 5), (4, 6)]  # once, though they share two keys; 6 is of the component of 4
