import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.llm import ctph


def slow_print(text):
    """The fingerprint, a byte at a time."""
    data, ends = (text or "").encode(), []
    if not data:
        return "0::"
    for i in range(len(data)):
        h = sum((b + 1) * pow(0x9E3779B1, k, 2 ** 32) for k, b in enumerate(data[max(0, i - 6):i + 1][::-1])) % 2 ** 32
        h ^= h >> 15
        h = h * 0x85EBCA6B % 2 ** 32
        h ^= h >> 13
        ends.append(next(z for z in range(33) if z == 32 or h >> z & 1))
    level = next(z for z in range(34) if sum(e >= z for e in ends) <= 64)

    def signature(z):
        cut, out = 0, ""
        for i, e in enumerate(ends):
            if e >= z or i == len(ends) - 1:
                v = xxhash.xxh3_64_intdigest(data[cut:i + 1]) % 4096
                out, cut = out + ctph.DIGITS[v // 64] + ctph.DIGITS[v % 64], i + 1
        return out
    return f"{2 ** level}:{signature(level)}:{signature(level + 1)}"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def slow_likeness(a, b):
    if a == b:
        return 1.0
    (n, *p), (m, *q) = [(int(x.split(":")[0]), *[[s[i:i + 2] for i in range(0, len(s), 2)] for s in x.split(":")[1:]])
                        for x in (a, b)]
    for x, px in ((n, p[0]), (2 * n, p[1])):
        for y, py in ((m, q[0]), (2 * m, q[1])):
            if x == y and n and m and (x != 2 * n or y != 2 * m):
                return 1 - distance(px, py) / max(len(px), len(py))
    return 0.0


def brute(rows):
    """In descending order of ids, nulls last."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        t, after = t or "", after or ""
        m = len(t) // 3
        e = t[:len(t) - m] + after[:m]
        a, b, c = slow_print(t), slow_print(e), slow_print(after)
        out.append((str(i), len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, round(slow_likeness(a, b), 9),
                    round(slow_likeness(a, c), 9)))
    return sorted(out)


def got(df):
    return sorted((str(r[0]), *r[1:5], round(r[5], 9), round(r[6], 9)) for r in df.collect())


def texts(n, seed=0):
    r = random.Random(seed)
    words = ["w%d\u00e9" % i for i in range(300)]
    return [" ".join(r.choice(words) for _ in range(r.choice([1, 2, 5, 30, 200, 700]))) for _ in range(n)]


def test_fingerprints_match_the_slow_ones(monkeypatch):
    samples = [*texts(30), "a", "ab", "x" * 5000, "ab" * 3000, "\U0001F600" * 400, " ", "\x00" * 100]
    for block in (ctph.BLOCK, 37, 5):
        monkeypatch.setattr(ctph, "BLOCK", block)
        assert [ctph.fingerprint(t) for t in samples] == [slow_print(t) for t in samples]
    assert ctph.fingerprint(None) == ctph.fingerprint("") == "0::"


def test_signatures_are_short_and_edits_stay_local():
    for t in [*texts(40, 1), "ab" * 50_000, "x" * 100_000]:
        size, fine, coarse = ctph.fingerprint(t).split(":")
        assert 2 <= len(fine) <= 2 * (ctph.CHUNKS + 1) and len(coarse) <= len(fine)
    long = texts(1, 5)[0] + " ".join(texts(60, 6))
    assert ctph.likeness(ctph.fingerprint(long), ctph.fingerprint(long[:4000] + "!" + long[4000:])) > 0.8
    assert ctph.likeness(ctph.fingerprint(long), ctph.fingerprint(long[1500:])) > 0.6
    assert ctph.likeness(ctph.fingerprint(long), ctph.fingerprint(" ".join(texts(60, 7)))) < 0.1


def test_likeness_of_pairs():
    prints = [ctph.fingerprint(t) for t in [*texts(25, 3), "", "a", "b", "a" * 9000]]
    pairs = [(a, b) for a in prints for b in prints]
    assert [round(x, 9) for x in ctph.likenesses(pairs)] == [round(slow_likeness(a, b), 9) for a, b in pairs]
    assert ctph.likeness("0::", "0::") == 1 and ctph.likeness("0::", prints[0]) == 0


@pytest.mark.parametrize("ids", [list(range(1, 60)), [i ** 9 - 10 ** 15 for i in range(57)] + [None, 2 ** 62], [5], [5, 9], []])
def test_compare_edits_matches_brute_force(spark, ids):
    t = texts(len(ids), 2)
    rows = [(i, None if k % 13 == 3 else "" if k % 13 == 4 else t[k - k % 3 // 2]) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"part": F.lit(1), "id": F.lit("x"), "to": F.lit(2)})
    res = ctph.compare_edits(df.repartition(5))
    assert res.columns[:5] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
    assert got(res) == brute(rows)


def test_rows_of_one_id(spark):
    """Repeated rows and ids: each row has one next row, and the same result on every run."""
    rows = [(3, "abc" * 30)] * 4 + [(3, "other " * 20), (2, "end of it " * 9), (9, "first " * 12)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, two = got(ctph.compare_edits(df)), got(ctph.compare_edits(df.repartition(7)))
    assert one == two and len(one) == len(rows)
    near = [r[6] for r in one if r[3] == slow_print("abc" * 30)]
    assert sorted(near)[-3:] == [1.0, 1.0, 1.0]


def test_with_fingerprint(spark):
    df = spark.createDataFrame([(1, "some text " * 40), (2, None)], "doc_id long, text string")
    assert [r.fp for r in ctph.with_fingerprint(df, name="fp").orderBy("doc_id").collect()] == [slow_print("some text " * 40), "0::"]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    res = got(entry.queries()["op12_piecewise_fingerprints"](spark, sf))
    assert res == brute(rows)
    assert sum(r[5] > r[6] for r in res) > 0.9 * len(res)
