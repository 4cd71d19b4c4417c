import random

import pytest

import __spark_entry__ as entry
from tessera.llm import packing


def brute(sizes, sources, clusters, capacity):
    bins, where, offset = [], [], []
    for n, s, c in zip(sizes, sources, clusters):
        fit = [b for b, (used, ss, cc) in enumerate(bins) if capacity - used >= n and not ss & s and not cc & c]
        b = min(fit, key=lambda b: (capacity - bins[b][0], b), default=len(bins))
        if b == len(bins):
            bins.append((0, 0, 0))
        used, ss, cc = bins[b]
        where.append(b)
        offset.append(used)
        bins[b] = (used + n, ss | s, cc | c)
    return where, offset


@pytest.mark.parametrize("seed", range(12))
def test_best_fit_matches_brute_force(seed):
    r = random.Random(seed)
    cap, n = r.choice([5, 20, 100]), 400
    sizes = [r.randint(1, cap) for _ in range(n)]
    if seed % 2:
        sizes.sort(reverse=True)
    sources = [1 << min(r.randrange(12), r.randrange(12)) if r.random() < 0.9 else 0 for _ in range(n)]
    clusters = [1 << r.randrange(9) if r.random() < 0.3 else 0 for _ in range(n)]
    assert packing.best_fit(sizes, sources, clusters, cap) == brute(sizes, sources, clusters, cap)


def check(rows, got, capacity):
    by_doc, by_bin = {}, {}
    for p in got:
        by_doc.setdefault(p.doc_id, []).append(p)
        if p.bin is not None:
            by_bin.setdefault(p.bin, []).append(p)
    words = {}
    for i, t, s in rows:
        words.setdefault(i, []).append(len((t or "").split()))
    assert by_doc.keys() == words.keys()
    for i, w in words.items():
        assert sorted(p.n_tokens for p in by_doc[i]) == sorted(x for n in w for x in [capacity] * (n // capacity) + ([n % capacity] if n % capacity or not n else []))
    source = {i: s for i, t, s in rows}
    text = {i: (t or "").lower() for i, t, s in rows}
    for ps in by_bin.values():
        ps.sort(key=lambda p: p.bin_offset)
        at = 0
        for p in ps:
            assert p.bin_offset == at and p.n_tokens > 0
            at += p.n_tokens
        assert at <= capacity
        named = [source[p.doc_id] for p in ps if source[p.doc_id] is not None]
        assert len(set(named)) == len(named) and len({text[p.doc_id] for p in ps}) == len(ps)
    return by_bin


def test_query_keeps_the_constraints(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text", "source").collect()]
    bins = check(rows, entry.queries()["op5_best_fit_packing"](spark, sf).collect(), packing.CAPACITY)
    total = sum(len((t or "").split()) for _, t, _ in rows)
    assert len(bins) <= 1.25 * total / packing.CAPACITY + 20


def test_edges(spark):
    rows = [(1, "a b c", "s"), (2, None, "s"), (3, "", None), (4, "w " * 50_001, "t"), (5, "A B c", "u"), (6, "a b c", None),
            (7, "x", None), (8, "y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS bin", "2 AS piece")
    got = packing.pack(df, 10, group_rows=100).collect()
    bins = check(rows, got, 10)
    assert {p.bin for p in got if p.doc_id in (2, 3)} == {None} and len(bins) == 5000 + 3
    twice = spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (None, "c", None)], "doc_id long, text string, source string")
    assert len({p.bin for p in packing.pack(twice, 10).collect() if p.doc_id == 1}) == 2
    assert packing.pack(df.limit(0), 10).count() == 0
