"""Flows of plans.chains and the CSV sources on small literal frames."""

import os
import uuid

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tessera.plans import chains
from tessera.session import checkpoint_dir
from tessera.sources import csv as C


def test_white_list_drops_sentinel_and_matches_nulls(spark):
    train = spark.createDataFrame([(1, 10, None, 3), (2, 10, 5, 999999), (3, 11, 5, 4), (4, 10, None, 7)],
                                  "uid int, a int, b int, current_service int")
    test = spark.createDataFrame([(100, 10, None), (101, 10, 5), (102, 12, 5)], "uid int, a int, b int")
    out = chains.white_list(train, test, ["a", "b"], "uid", "current_service", ["uid"]).collect()
    assert sorted(map(tuple, out)) == [(100, 3)]   # first of the (10, null) pair; sentinel row not used


def test_magic_lookups_exclude_and_include_old(spark):
    import random
    from test_properties import _ref_mine
    rnd = random.Random(8)
    rows = [(i, *[rnd.choice([None, 1, 2, 3, 4, 5]) for _ in range(4)]) for i in range(600)]
    schema = "uid int, f1 int, f2 int, f3 int, f4 int"
    train, test, old = (spark.createDataFrame(rows[:300], schema), spark.createDataFrame(rows[300:450], schema),
                        spark.createDataFrame(rows[450:], schema))
    ex, inc = chains.magic_lookups(train, test, old, ["uid"], ["f1", "f2", "f3", "f4"], ["uid"], min_count=2)
    assert {r["first"]: r["second"] for r in ex.collect()} == _ref_mine([r[1:] for r in rows[:450]], 2)
    assert {r["first"]: r["second"] for r in inc.collect()} == _ref_mine([r[1:] for r in rows], 2)


def test_build_features_columns(spark):
    df = spark.createDataFrame([(1, 16.0, 26.5, None, 46.0, 1), (2, 106.0, 106.0, 106.0, 106.0, 2)],
                               "uid int, a double, b double, c double, d double, g int")
    out = chains.build_features(df, ["a", "b", "c", "d"], size_cols=["g"], group_key="g", group_values=["a"])
    r = {x["uid"]: x for x in out.collect()}
    assert r[1]["fee_min"] == 16.0 and r[1]["a_decimal"] == 0 and r[1]["b_decimal"] == 50
    assert r[2]["fee_unum"] == 1 and r[1]["fee_unum"] == 3
    assert r[1]["c_b_delta_cents"] == 999999        # null delta → fill value, truncated
    assert r[2]["b_a_delta_cents_is_5"] == 0        # zero delta is not a multiple


def test_stacked_prediction_uses_both_levels(spark):
    import random
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.sql import functions as F
    rnd = random.Random(3)
    rows = [(i, "abc"[i % 3], i % 3 + 0.8 * rnd.random(), i // 3 % 5) for i in range(120)]
    d = spark.createDataFrame(rows, "id int, y string, x double, fold int")
    train, test, old = d.filter("id < 60"), d.filter("id >= 90").drop("y"), d.filter("id >= 60 and id < 90")
    white = spark.createDataFrame([(95, "z"), (1, "z")], "id int, y string")
    est = DecisionTreeClassifier(maxDepth=3, seed=1)
    # the second level sees the first one's probabilities and nothing else of use
    out = chains.stacked_prediction(train, test, ["x"], "y", "id", ["a", "b", "c"], white, est, old=old,
                                    final_features=["fold"])
    got = {r["id"]: r["y"] for r in out.collect()}
    assert len(got) == 30 and got.pop(95) == "z"
    assert sum(y == "abc"[i % 3] for i, y in got.items()) >= 27


def test_csv_typed_scan_keeps_raw_text(spark):
    df = spark.createDataFrame([(1, "1.50"), (2, "\\N"), (3, "7"), (4, None)], "k long, fee string")
    path = os.path.join(checkpoint_dir(spark), f"t-{uuid.uuid4().hex}")
    C.sink_csv(df, path, float_digits=None)
    schema = StructType([StructField("k", LongType()), StructField("fee", DoubleType())])
    out = {r["k"]: (r["fee_raw"], r["fee"]) for r in C.scan_csv_typed(spark, path, schema, ["fee"]).collect()}
    assert out == {1: ("1.50", 1.5), 2: ("\\N", None), 3: ("7", 7.0), 4: (None, None)}


def test_stack_table_roundtrip(spark):
    df = spark.createDataFrame([("u1", 0.123456, 0.876544)], "user_id string, class_0 double, class_1 double")
    path = os.path.join(checkpoint_dir(spark), f"s-{uuid.uuid4().hex}")
    C.sink_csv(df, path)
    schema = StructType([StructField("user_id", StringType()), StructField("class_0", DoubleType()),
                         StructField("class_1", DoubleType())])
    r = C.load_stack_table(spark, path, "user_id", "m1_", schema).first()
    assert r["m1_class_0"] == 0.1235 and r["m1_class_1"] == 0.8765


def test_a_named_table_is_reused_until_plan_or_input_change(spark, tmp_path):
    from pyspark.sql import functions as F
    from tessera.sources.store import materialize, plan_fingerprint
    src, root = str(tmp_path / "src"), str(tmp_path / "tables")
    rows = spark.range(50).select("id", (F.col("id") % 5).alias("k"), *[F.lit(i).alias(f"c{i}") for i in range(40)])
    rows.write.parquet(src)
    made = lambda c=7: spark.read.parquet(src).groupBy("k").agg(F.sum(F.col("id") * c).alias("s"), F.max("c39").alias("m"))
    files = lambda: sorted(str(f.relative_to(root)) + str(f.stat().st_mtime_ns) for f in (tmp_path / "tables").rglob("*.parquet"))
    first = sorted(tuple(r) for r in materialize(made(), "t", root).collect())
    kept = files()
    assert sorted(tuple(r) for r in materialize(made(), "t", root).collect()) == first
    assert files() == kept  # read, not written
    assert sorted(tuple(r) for r in materialize(made(8), "t", root).collect()) != first
    assert len(files()) > len(kept)
    next((tmp_path / "tables").rglob("_SUCCESS")).unlink()  # a run that was lost before its commit
    assert sorted(tuple(r) for r in materialize(made(), "t", root).collect()) == first
    rows.filter("id < 10").write.mode("append").parquet(src)
    assert sorted(tuple(r) for r in materialize(made(), "t", root).collect()) != first
    assert plan_fingerprint(spark.createDataFrame([(1,)], "a int")) is None
    assert plan_fingerprint(made().withColumn("u", F.udf(lambda x: x, "long")("s"))) is None
