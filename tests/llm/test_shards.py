import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from tessera.llm import shards


def check(rows, got, n=8):
    assert len(got) == len(rows)
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((str(g.doc_id), g.size, g.text_crc32) for g in got) == \
        sorted((str(i), size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    assert {g.law for g in got} <= {"bytes"} and all(g.grown_shard is None for g in got)
    load = np.bincount([g.shard for g in got], weights=[g.size for g in got], minlength=n)
    for s in range(n):
        assert sorted(g.slot for g in got if g.shard == s) == list(range(sum(g.shard == s for g in got)))
    return load


def test_query_is_even_and_gapless(spark):
    for sf, off in (("/root/testdata/sf0.001", 0.02), ("/root/testdata/sf0.01", 0.001)):
        rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
        load = check(rows, entry.queries()["op8_sharding"](spark, sf).collect())
        assert load.max() - load.min() <= off * load.mean()


def test_edges(spark, tmp_path):
    rows = [(1, None), (2, ""), (None, "a"), (None, "b"), (5, "x" * 90_000), (6, "é"), (7, "dup"), (7, "dup")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS shard", "'q' AS size")
    a = shards.assign(df, str(tmp_path / "a"), 3).collect()
    check(rows, a, 3)
    assert sorted(map(str, a)) == sorted(map(str, shards.assign(df.repartition(5), str(tmp_path / "b"), 3).collect()))
    assert shards.assign(df.limit(0), str(tmp_path / "c"), 3).count() == 0


def test_map_versions(spark, tmp_path):
    shards.store_map(spark, str(tmp_path), 1, np.arange(10) % 3)
    shards.store_map(spark, str(tmp_path), 2, np.zeros(10, int))
    assert [r.shard for r in shards.load_map(spark, str(tmp_path), 1).orderBy("vslot").collect()] == [i % 3 for i in range(10)]
    assert {r.shard for r in shards.load_map(spark, str(tmp_path), 2).collect()} == {0}


@pytest.mark.parametrize("seed", range(5))
def test_edits(seed):
    r = np.random.default_rng(seed)
    size = (r.pareto(1.3, 500) * 1000).astype(np.int64)
    first = np.arange(500) % 8
    out = shards.rebalanced(first, size, 8)
    before, after = (np.bincount(m, weights=size, minlength=8) for m in (first, out))
    assert after.max() <= before.max() and after.max() <= max(size.max(), size.sum() / 8 * 1.01)
    assert (shards.rebalanced(out, size, 8) == out).all()
    more = shards.grown(out, size, 9)
    assert set(more[more != out]) == {8}
    assert np.bincount(more, weights=size, minlength=9)[8] >= size.sum() / 9 * 0.8 or size.max() > size.sum() / 9
