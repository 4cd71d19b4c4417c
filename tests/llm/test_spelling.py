import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.llm import spelling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near_words(words):
    """Words one edit apart, by their texts without one code point."""
    words, near = set(words), {}
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1:]), []).append(w)
            short = w[:i] + w[i + 1:]
            if short in words:
                near.setdefault(w, set()).add(short)
                near.setdefault(short, set()).add(w)
    for v in holes.values():
        for w in v:
            near.setdefault(w, set()).update(x for x in v if x != w)
    return near


def brute(n, ratio=10):
    near, form = near_words(n), {}
    for w in n:
        best = min(near.get(w, ()), key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near.get(w, ())), n.get(form[w])))
    return sorted(out)


def counted(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                n[w] += 1
    return {w: c for w, c in n.items() if c >= 2}


def edits(r, w, letters):
    i, kind = r.randrange(len(w) + 1), r.randrange(3)
    c = r.choice(letters)
    return w[:i] + c + w[i:] if kind == 0 else w[:i] + w[i + 1:] if kind == 1 else w[:i] + c + w[i + 1:]


@pytest.mark.parametrize("letters, share", [("ab", 0.9), ("ab", 0.5), ("abcd", 0.3), ("abcdefghé\U0001F600", 0.1)])
def test_an_edit_affects_only_grams_within_reach(letters, share):
    r = random.Random(len(letters))
    for _ in range(1500):
        w = "".join(r.choice(letters) for _ in range(r.randrange(7, 16)))
        v = edits(r, w, letters)
        frequent = {x[i:i + q]: 9 for x in (w, v, w + w, v[::-1] + v) for q in range(2, 6) for i in range(len(x))
                    if r.random() < share}
        short = min(len(w), len(v))
        if short < 4 or w == v:
            continue
        q = spelling._longest(short)
        for a, b in ((w, v), (v, w)):
            mine, other, d = spelling.decompose(a, frequent, q), spelling.decompose(b, frequent, q), len(b) - len(a)
            kept = [g for g in mine if g in other or (g[0] + d, g[1]) in other]
            ends = [p + len(g) for p, g in mine if (p, g) not in kept]
            assert not ends or max(ends) - min(ends) < q
            assert set(spelling.out_of_reach(mine, frequent, q)) & set(kept)
        (s, l) = sorted((w, v), key=len)
        _, same, longer = spelling.keys_of(l, frequent)
        assert set(spelling.keys_of(s, frequent)[0]) & set(same if len(s) == len(l) else longer)
        assert (spelling.letter_parities(s) ^ spelling.letter_parities(l)).bit_count() <= 2 or \
            ((spelling.letter_parities(s) ^ spelling.letter_parities(l)) % 2 ** 64).bit_count() <= 2


def test_variants_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LEAST", 3)
    r = random.Random(1)
    words = Counter()
    for _ in range(120):
        base = "".join(r.choice(["th", "on", "ing", "er", "é", "tion", "a", "\U0001F600", "z"]) for _ in range(r.randrange(3, 9)))
        for _ in range(r.randrange(1, 12)):
            words[base] += r.choice([1, 2, 20, 300])
            base = edits(r, base, "thoneé") if r.random() < 0.8 else base
    # a chain of forms, ties, and a family that shares its grams
    words.update({"abcdefgh": 2, "abcdefghi": 20, "abcdefghij": 200, "abcdefghijk": 2000, "zzzzzzzz": 2, "zzzzzzzy": 20, "zzzzzzzx": 20})
    words.update({"common" + chr(97 + i) + chr(97 + j) + "prefix": 2 + i for i in range(20) for j in range(20)})
    words = {w: c for w, c in words.items() if w}
    rows = [(w, c, 1) for w, c in words.items()] + [("abcdefgh", 1, 1), (None, 5, 1), ("", 7, 2)]
    words["abcdefgh"] += 1
    df = spark.createDataFrame(rows, "word string, n long, k int")
    res = spelling.variants(df)
    assert res.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(x) for x in res.collect()) == brute({w: c for w, c in words.items() if len(w) >= 7 and c >= 2})
    assert sorted(tuple(x) for x in spelling.variants(df, 3, 4, 1).collect()) == brute({w: c for w, c in words.items() if len(w) >= 4}, 3)
    assert spelling.variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(df, min_len=3)


def test_runs_and_typos(spark):
    rows = [(i, "Abcdefgh-Étudiant×x 7letters? sevenxx sixsix " * (i % 3 + 1)) for i in range(200)]
    rows += [(None, "Nothing nothing NOTHING"), (5, None), (6, ""), (7, "q" * 100_000 + " " + "q" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    words = spelling.with_typos(spelling.runs(df, min_len=7), "doc_id").groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    got = {r.word: r.n for r in words.filter("length(word) >= 7 and n >= 2").collect()}
    assert got == counted(rows)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(x) for x in entry.queries()["op11_spelling_variants"](spark, sf)
                 .select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == brute(counted(rows))
    assert any(r[1] for r in got)


def test_letters_one_by_one_and_grams_once(monkeypatch):
    every = "".join(map(chr, range(0x300)))
    assert re.findall(spelling.LETTERS, every) == re.findall("[A-Za-zÀ-ÿ]", every)
    assert "-" not in spelling.LETTERS  # ranges are slow in Java
    calls = []
    real = spelling.decompose
    monkeypatch.setattr(spelling, "decompose", lambda *a: calls.append(a) or real(*a))
    spelling.keys_of("lengthily", {})  # grams as long as for a word of one less
    assert len(calls) == 1
    spelling.keys_of("lengthen", {})
    assert len(calls) == 3
