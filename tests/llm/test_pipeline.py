import glob
import time

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tessera.llm import decontaminate, exact, langid, packing
from tessera.session import cut_lineage

from test_packing import check
from test_parity import brute as components

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    stage = dict(cp.STAGES)
    assert list(stage) == ["language_id", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    # some documents for each stage to drop
    text = docs.orderBy("doc_id").first().text
    item = spark.read.parquet(SF + "/benchmark.parquet").first().text
    more = [(100_001, "12 34 !", "en", "x", 7), (100_002, None, None, None, None), (100_003, text.upper(), "fr", "x", 1),
            (100_004, text + " end", "fr", "x", 1), (100_005, "Before. " + item + " After.", "en", "x", 1)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    a = cut_lineage(stage["language_id"](spark, docs, SF))
    assert a.columns == docs.columns
    gone = {r[0] for r in rows(docs)} - {r[0] for r in rows(a)}
    assert {100_001, 100_002} <= gone and len(gone) <= 4
    b = cut_lineage(stage["exact_dedup"](spark, a, SF))
    low = {}
    for r in rows(a):
        k = r[1].translate(str.maketrans(exact.UPPER, exact.LOWER))
        low[k] = max(low.get(k, r), r)
    assert rows(b) == sorted(low.values())
    c = cut_lineage(stage["ngram_jaccard_join"](spark, b, SF))
    keep = {i for i, _, k in components([(r[0], r[1]) for r in rows(b)], 5, 4, 5) if i == k}
    assert rows(c) == [r for r in rows(b) if r[0] in keep] and c.count() < b.count()
    d = cut_lineage(stage["benchmark_decontamination"](spark, c, SF))
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(SF + "/benchmark.parquet").collect()]
    leaked = {r[0] for r in rows(c) if any(i in " ".join(r[1].lower().split()) for i in items)}
    assert 100_005 in leaked and rows(d) == [r for r in rows(c) if r[0] not in leaked]
    e = cut_lineage(stage["best_fit_packing"](spark, d, SF))
    check([(r.doc_id, r.text, r.source) for r in d.collect()], e.collect(), packing.CAPACITY)


def test_run_chains_the_stages(spark):
    got = cp.run(spark, SF)
    assert {"doc_id", "bin", "bin_offset"} <= set(got.columns) and got.count() > 50
    docs = spark.read.parquet(SF + "/documents.parquet").limit(0)
    for _, f in cp.STAGES:
        docs = f(spark, docs, SF)
        assert docs.count() == 0


def test_stages_hand_few_rows_to_python_at_a_time(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        cp.drop_near_copies(spark, spark.createDataFrame([(1, "a b c d e f"), (2, "x y")], "doc_id long, text string"), "")
        assert int(spark.conf.get(key)) == cp.BATCH_ROWS
    finally:
        spark.conf.set(key, before)


def test_shuffle_files_go_when_a_query_ends(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")
        cp.drop_near_copies(spark, spark.createDataFrame([(1, "a b c d e f"), (2, "x y")], "doc_id long, text string"), "")
        assert spark.conf.get(key) == "true"
        table = spark.range(20_000).selectExpr("id % 5000 AS k", "uuid() AS u").repartition(7, "k").groupBy("k").count()
        local = spark.sparkContext.getConf().get("spark.local.dir", "/tmp")
        shuffles = lambda: set(glob.glob(f"{local}/blockmgr-*/*/shuffle_*"))
        kept = shuffles()
        cut_lineage(table, "counted")
        for _ in range(50):  # the files are deleted in the background
            if not shuffles() - kept:
                break
            time.sleep(0.2)
        assert not shuffles() - kept
    finally:
        spark.conf.set(key, before)


def test_stages_hand_few_bytes_to_python_at_a_time(spark):
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(k) for k in keys]

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "bytes": [b.nbytes]})

    try:
        cp.small_batches(spark)
        wide = spark.range(0, 900, 1, 1).select(F.array_repeat("id", 8192).alias("bits"))
        got = wide.mapInArrow(sizes, "n long, bytes long").collect()
        assert sum(r.n for r in got) == 900 and max(r.bytes for r in got) < 3 * cp.BATCH_BYTES
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
