import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.llm import merkle
from tessera.llm.queries import TAMPERED

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*[said(v) for v in (doc_id, source, lang, n_chars, text)])


def tree(leaves, k):
    """Root, and each leaf's siblings: [(left, right)] from the leaf up."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for p, i in zip(paths, at):
            run = level[i - i % k:i - i % k + k]
            p.append((run[:i % k], run[i % k + 1:]))
        level = [H(*level[j:j + k]) for j in range(0, len(level), k)]
        at = [i // k for i in at]
    return level[0], paths


def brute(rows, k=2):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    subs = []
    for g in langs:
        by_lang[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        subs.append(tree([leaf_of(*r) for r in by_lang[g]], k))
    if not subs:
        return []
    root, trunks = tree([s[0] for s in subs], k)
    out = []
    for g, (sub, paths), trunk in zip(langs, subs, trunks):
        for r, p in zip(by_lang[g], paths):
            path = p + trunk
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            h = leaf_of(*r[:4], r[4] + 1) if hit else leaf_of(*r)
            for left, right in path:
                h = H(*left, h, *right)
            out.append((str(r[0]), leaf_of(*r), sub, root, H(*[x for a, b in path for x in a + b]), h, h == root))
    return sorted(out)


def got(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


ROWS = ([(i, f"text {i} é" * (i % 4), ["en", "de", None, "fr", "é"][i % 5 if i < 40 else 0], "web" if i % 3 else None,
          None if i % 11 == 0 else i) for i in range(1, 90)]
        + [(200, None, "lone", "a", 1), (201, "", "pair", "", 0), (202, "x" * 300_000, "pair", "b", -5),
           (None, "no id", "en", "c", 3), (None, "no id", "en", "c", 3), (7, "again", "en", "d", 2 ** 63 - 1),
           (7, "again", "en", "d", 2 ** 63 - 1), (49, "z", "en", None, 9)])


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_matches_brute_force(spark, fanout):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({"h": F.lit(1), "g": F.lit("x"), "path": F.lit(2.5)})
    res = merkle.audit(df, changed=TAMPERED, fanout=fanout)
    assert res.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got(res) == brute(ROWS, fanout)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_small_tables(spark, n):
    df = spark.createDataFrame(ROWS[:n], SCHEMA)
    assert got(merkle.audit(df, changed=TAMPERED)) == brute(ROWS[:n])


def test_any_change_shows_and_every_row_proves(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    m = merkle.manifest(df, changed={"text": "concat(coalesce(text, ''), '.')"})
    folds = m.select((merkle.text(merkle.fold(F.unhex("leaf"), F.col("path"))) == F.col("root")).alias("whole"),
                     (merkle.text(merkle.fold(F.col("seen"), F.col("path"))) == F.col("root")).alias("changed"))
    assert {tuple(r) for r in folds.distinct().collect()} == {(True, False)}


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet")
            .select("doc_id", "text", "lang", "source", "n_chars").collect()]
    res = got(entry.queries()["op13_merkle_manifest"](spark, sf))
    assert res == brute(rows)
    assert {r[-1] for r in res} == {True, False}
