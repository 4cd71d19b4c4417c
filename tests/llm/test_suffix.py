import hashlib
import random

import numpy as np
import pytest

import __spark_entry__ as entry
from tessera.llm import suffix


def brute(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out[i] = (i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS d", "2 AS spans", "3 AS raw")
    return [tuple(r) for r in suffix.without_repeats(df, **kw).collect()]


def make(seed, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 9)))
    text = lambda m: " ".join(word() for _ in range(m))
    shared = [text(r.choice([15, 22, 30, 60])) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [text(r.randrange(1, 40)) for _ in range(r.randrange(0, 4))]
        parts += [r.choice(shared)[r.randrange(20):] for _ in range(r.randrange(0, 3))]
        if r.random() < 0.3 and rows:
            old = r.choice(rows)[1]
            cut = r.randrange(len(old) + 1)
            parts.append(old[:cut] + r.choice(["", "X"]) + old[cut:])
        r.shuffle(parts)
        rows.append((i, r.choice([" ", "", "\n"]).join(parts)))
    rows += [(n + 1, "z" * 350), (n + 2, "ab" * 200 + "z" * 120), (n + 3, shared[0] * 3), (n + 4, None), (n + 5, "")]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(suffix, "BUCKET_ROWS", 20)  # many buckets, so that runs cross them
    monkeypatch.setattr(suffix, "CHUNK", 500 if seed == 2 else suffix.CHUNK)
    rows = make(seed)
    want = brute(rows)
    assert {x[0]: x for x in got(spark, rows)} == want
    assert sum(w[2] for w in want.values()) > 3000


def test_edges(spark):
    t = " ".join(f"word{i}" for i in range(40))
    rows = [(None, t), (5, t + "!"), (5, t + "!"), (3, "short"), (9, "x" * 99), (8, "x" * 100), (7, " ".join(str(i) for i in range(30_000)))]
    out = got(spark, rows)
    by = {}
    for x in out:
        by.setdefault(x[0], []).append(x[1:])
    assert by[None][0][1] == 0 and len(by[5]) == 2 and by[5][0] == by[5][1] and by[5][0][1] == len(t)
    assert by[9][0][1:3] == by[8][0][1:3] == (0, 0) and by[7][0][:2] == (len(rows[-1][1]), 0)
    assert got(spark, []) == []


def test_multikey_sort():
    r = np.random.default_rng(0)
    w = r.integers(0, 3, (500, 6)).astype(np.uint64)
    o = suffix.multikey_sort(w)
    assert w[o].tolist() == sorted(w.tolist())


def test_equal_windows_have_equal_anchors():
    r = np.random.default_rng(1)
    a, b = (r.integers(97, 100, 3000).astype(np.uint8) for _ in range(2))
    b[500:900] = a[1200:1600]
    place = lambda s: {p: (int(g), int(x) - p) for g, f, l, x in zip(s[0], s[2], s[3], s[4]) for p in range(f, l + 1)}
    pa_, pb = place(suffix.segments(a)), place(suffix.segments(b))
    assert sorted(pa_) == list(range(2901)) and all(pb[500 + i] == pa_[1200 + i] for i in range(301))


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    out = [tuple(r) for r in entry.queries()["op7_suffix_dedup"](spark, sf).collect()]
    assert {x[0]: x for x in out} == brute(rows) and len(out) == len(rows)
