"""Edge cases on small literal frames (FIXTURES.md §3): null keys,
single-row and constant groups, ties, floor modulo, text parsing, time
differences, probability ties."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.functions import numeric as N
from tessera.functions import rows as RW
from tessera.functions import text as T
from tessera.operators import aggs, dedup, metrics, rates, windows


def rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def keyed(spark):
    data = [("a", 1.0, 1), ("a", 3.0, 2), ("a", 3.0, 3), ("b", 5.0, 4), ("c", 2.0, 5), ("c", 2.0, 6),
            (None, 7.0, 7), (None, None, 8), ("a", None, 9)]
    return spark.createDataFrame(data, "k string, v double, pos int")


def test_group_size_null_key(keyed):
    out = rows(aggs.group_size(keyed, ["k"]).select("pos", "k_count"), ["pos"])
    assert out == [(1, 4), (2, 4), (3, 4), (4, 1), (5, 2), (6, 2), (7, None), (8, None), (9, 4)]


def test_group_stats_single_and_constant(keyed):
    out = aggs.group_stats(keyed, ["k"], "v", ["var", "size", "mean", "skew"])
    got = {r["pos"]: r for r in out.collect()}
    assert got[4]["k_v_var_size_mean_skewvar"] is None          # one row: var undefined
    assert got[5]["k_v_var_size_mean_skewvar"] == 0.0           # constant group
    assert got[5]["k_v_var_size_mean_skewskew"] is None         # n < 3
    assert got[1]["k_v_var_size_mean_skewsize"] == 4            # size counts null values
    assert got[1]["k_v_var_size_mean_skewskew"] == pytest.approx(-1.7320508, abs=1e-6)  # pandas skew of 1,3,3
    assert got[7]["k_v_var_size_mean_skewmean"] is None         # null key dropped


def test_grp_standard_constant_and_null_key(keyed):
    out = {r["pos"]: r["v_k_standardize"] for r in windows.grp_standard(keyed, "k", ["v"]).collect()}
    assert out[5] == 0.0 and out[6] == 0.0      # std 0
    assert out[4] == 0.0                         # single row: std null
    assert out[7] == 0.0 and out[8] == 0.0       # null key
    assert out[1] == pytest.approx((1 - 7 / 3) / math.sqrt(4 / 3))


def test_grp_rank_ties_nulls_last(keyed):
    out = {r["pos"]: r["v_rank"] for r in windows.grp_rank(keyed, "k", ["v"], ["pos"]).collect()}
    assert [out[1], out[2], out[3], out[9]] == [0, 1, 2, 3]   # ties by pos, null last
    assert out[7] is None


def test_dedup_keeps_first_and_groups_null_keys(keyed):
    out = rows(dedup.dedup_first(keyed, ["k"], ["pos"]), ["pos"])
    assert [r[2] for r in out] == [1, 4, 5, 7]
    last = rows(dedup.dedup_last(keyed, ["k"], ["pos"]), ["pos"])
    assert [r[2] for r in last] == [4, 6, 8, 9]


def test_flag_duplicates(keyed):
    out = {r["pos"]: r["is_duplicated"] for r in dedup.flag_duplicates(keyed, ["k", "v"]).collect()}
    assert out == {1: 0, 2: 1, 3: 1, 4: 0, 5: 1, 6: 1, 7: 0, 8: 0, 9: 0}


def test_ngroup_and_label_encode(keyed):
    out = {r["pos"]: r["k_ngroup"] for r in aggs.ngroup(keyed, ["k"]).collect()}
    assert out[1] == 0 and out[4] == 1 and out[5] == 2 and out[7] == -1
    enc = {r["pos"]: r["k"] for r in aggs.label_encode(keyed, "k").collect()}
    assert enc[1] == 0 and enc[7] == 3  # 'nan' sorts after a, b, c


@pytest.fixture(scope="module")
def labelled(spark):
    data = [("x", i % 3 if i % 5 else None, i % 2) for i in range(20)] + \
           [("y", i % 2, i % 2) for i in range(19)] + [(None, 1, 0)]
    return spark.createDataFrame(data, "cat string, label int, fold int")


def test_class_rates_support_and_null_labels(labelled):
    out = rates.class_rates(labelled, "cat", "label", [0, 1, 2], min_support=20)
    got = {r["cat"]: r for r in out.collect()}
    x = got["x"]
    # 20 rows incl. 4 null labels; label = i % 3 for i not divisible by 5
    n0 = sum(1 for i in range(20) if i % 5 and i % 3 == 0)
    assert x["cat_0_conversion"] == pytest.approx(n0 / 20)
    assert got["y"]["cat_0_conversion"] is None          # 19 rows < 20
    assert [r for r in out.collect() if r["cat"] is None][0]["cat_1_conversion"] is None


def test_oof_rates_use_other_folds(labelled):
    out = rates.oof_class_rates(labelled, "cat", "label", "fold", [0, 1])
    r = [x for x in out.collect() if x["cat"] == "y" and x["fold"] == 0][0]
    other = [i % 2 for i in range(19) if i % 2 == 1]
    assert r["cat_1_conversion"] == pytest.approx(sum(1 for v in other if v == 1) / len(other))


def test_multiple_flags_floor_mod(spark):
    df = spark.createDataFrame([(-0.5,), (0.0,), (2.5,), (27.0,), (512.0,), (1.00005,), (None,), (-27.0,)], "x double")
    out = [tuple(r) for r in df.select("x", N.multiple_of("x", 27.0).alias("m27"), N.multiple_of("x", 0.5).alias("mh"),
                                        N.overage("x").alias("ov"), F.pmod("x", F.lit(1.0)).alias("fm")).collect()]
    d = {r[0]: r[1:] for r in out}
    assert d[27.0][0] == 1 and d[-27.0][0] == 1 and d[0.0][0] == 0 and d[None][0] == 0
    assert d[-0.5][1] == 1 and d[2.5][1] == 1
    assert d[-0.5][3] == 0.5                       # Python: -0.5 % 1 == 0.5
    assert d[2.5][2] == (2.5 * 100 - 600) % 1000   # floor modulo of a negative


def test_text_parsing(spark):
    vals = ["1.50", "1.5", "150", "1.", "", "\\N", "3.0", " 7 ", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = df.select("s", T.lenient_double("s").alias("d"), T.lenient_int("s").alias("i"), T.have_0("s").alias("h"),
                    T.decimal_length("s").alias("dl"), T.len_after_decimal("s").alias("la"),
                    T.ends_with_00("s").alias("e00"), T.null_token("s").alias("nt")).collect()
    d = {r["s"]: r for r in out}
    assert d["1.50"]["d"] == 1.5 and d["1.50"]["h"] == 0 and d["1.50"]["dl"] == 2
    assert d["1.5"]["h"] == 1 and d["150"]["h"] == 1 and d["1."]["h"] == 1 and d[None]["h"] == 1
    assert d["3.0"]["i"] is None and d[" 7 "]["i"] == 7 and d["150"]["i"] == 150
    assert d["\\N"]["d"] is None and d["\\N"]["nt"] is None and d[""]["d"] is None
    assert d["1."]["la"] == 0 and d["150"]["la"] is None and d["150"]["dl"] == 0
    assert d[None]["e00"] is None and d["1.50"]["e00"] == 0


def test_parse_fee_first_match(spark):
    df = spark.createDataFrame([(16.0,), (31.0,), (30.99,), (106.0,), (None,)], "x double")
    out = {r["x"]: (r["p"], r["m"]) for r in df.select("x", T.parse_fee("x").alias("p"),
                                                          T.parse_fee_exact("x").alias("m")).collect()}
    assert out[31.0] == (0, None) and out[30.99] == (None, None) and out[16.0] == (None, 0)
    assert out[106.0] == (0, 7) and out[None] == (None, None)


def test_money_digits(spark):
    df = spark.createDataFrame([(16.07,), (-1.0,), (None,), (106.5,)], "x double")
    out = {r["x"]: tuple(r)[1:] for r in df.select("x", *[N.money_digit("x", p).alias(f"d{p}") for p in range(3)],
                                                     N.tens("x").alias("t")).collect()}
    assert out[16.07] == (7, 0, 6, 1) and out[None] == (0, 0, 1, -1) and out[106.5] == (0, 5, 6, 10)


def test_time_differences(spark):
    df = spark.createDataFrame([("2024-01-31 23:59:30", "2024-02-01 00:01:00")], "a string, b string")
    r = df.select(D.diff_minutes("a", "b").alias("m"), D.diff_hours("a", "b").alias("h"),
                  D.diff_days("b", "a").alias("d"), D.add_days("a", 1).alias("ad"),
                  D.add_hours("a", 1).alias("ah")).first()
    assert r["m"] == 2 and r["h"] == 1 and r["d"] == 1        # floor(-1.5) = -2 → 2
    assert r["ad"] == "2024-02-01" and r["ah"] == "2024-02-01 00:59:30"


def test_row_stats(spark):
    df = spark.createDataFrame([(1.0, 3.0, 3.0, None), (None, None, None, None), (2.0, None, None, None)],
                               "a double, b double, c double, d double")
    cols = ["a", "b", "c", "d"]
    out = df.select(RW.row_sum(cols).alias("s"), RW.row_var(cols).alias("v"), RW.row_second_min(cols).alias("m2"),
                    RW.row_mode_count(cols).alias("mc"), RW.row_nunique(cols).alias("nu")).collect()
    assert out[0]["s"] == 7.0 and out[0]["v"] == pytest.approx(4 / 3) and out[0]["m2"] == 3.0
    assert out[0]["mc"] == 2 and out[0]["nu"] == 2
    assert out[1]["s"] == 0.0 and out[1]["v"] is None and out[1]["mc"] is None
    assert out[2]["m2"] is None and out[2]["v"] is None


def test_argmax_first_max_and_thresholds(spark):
    df = spark.createDataFrame([(1, 0.4, 0.4, 0.2), (2, 0.6, 0.3, 0.1), (3, 0.2, 0.3, 0.5), (4, 0.1, 0.45, 0.45)],
                               "id int, p_0 double, p_1 double, p_2 double")
    a = {r["id"]: r["a"] for r in df.select("id", RW.argmax(["p_0", "p_1", "p_2"]).alias("a")).collect()}
    assert a == {1: 0, 2: 0, 3: 2, 4: 1}
    out = {r["id"]: r["pred"] for r in metrics.multi_f1_threshold(df, ["p_0", "p_1", "p_2"]).collect()}
    assert out[2] == 0   # confident rows keep their arg-max


@pytest.fixture(scope="module")
def events(spark):
    data = [("u", 1, 1, 1.0), ("u", 1, 2, 4.0), ("u", 2, 3, 9.0), ("u", 3, 4, 16.0), ("w", 1, 5, 2.0)]
    return spark.createDataFrame(data, "key string, ts int, id int, v double")


def test_shifts_equal_timestamps_and_short_keys(events):
    out = {r["id"]: r["v_diff2"] for r in windows.diff_prev(events, ["key"], "v", 2, ["ts", "id"]).collect()}
    assert out == {1: None, 2: None, 3: 8.0, 4: 12.0, 5: None}
    data = events.select("key").distinct()
    last = {r["key"]: r["value"] for r in windows.nth_from_last(data, events, ["key"], ["ts", "id"], "v", 1).collect()}
    assert last == {"u": 9.0, "w": None}
    first = {r["key"]: r["value"] for r in windows.nth_from_first(data, events, ["key"], ["ts", "id"], "v", 3).collect()}
    assert first == {"u": 16.0, "w": None}


def test_trend_and_mode(events, spark):
    t = {r["key"]: r["trend"] for r in aggs.trend_per_key(events, "key", "v", ["ts", "id"]).collect()}
    assert t["u"] == pytest.approx(5.0) and t["w"] == 0.0
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 3), ("a", 1), ("b", 2), ("b", 5)], "k string, x int")
    m = {r["k"]: r["mode"] for r in aggs.mode_per_key(df, "k", "x").collect()}
    assert m == {"a": 1, "b": None}


def test_group_stats_median_is_exact(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("a", 2.0), ("a", 7.0), ("b", 3.0), (None, 5.0)],
                               "k string, v double")
    out = {(r["k"], r["v"]): r["k_v_medianmedian"] for r in aggs.group_stats(df, ["k"], "v", ["median"]).collect()}
    assert out[("a", 1.0)] == 3.0 and out[("b", 3.0)] == 3.0 and out[(None, 5.0)] is None


def test_narrow_types_casts_to_chosen_types(spark):
    df = spark.createDataFrame([(1, 100, 40000, 3000000000, 1.5, 1e12), (-5, -100, 5, 1, None, 2.0)],
                               "a bigint, b bigint, c int, d bigint, x double, y double")
    rep = {r["column"]: r["chosen_type"] for r in aggs.narrow_types_report(df).collect()}
    assert rep == {"a": "tinyint", "b": "tinyint", "c": "int", "d": "bigint", "x": "float", "y": "double"}
    out = aggs.narrow_types(df)
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types == {"a": "tinyint", "b": "tinyint", "c": "int", "d": "bigint", "x": "float", "y": "double"}
    assert [tuple(r) for r in out.collect()][0][:4] == (1, 100, 40000, 3000000000)


def test_size_shuffles(spark):
    from tessera.session import size_shuffles
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 100 * 1024 ** 4) == 200_000
        assert size_shuffles(spark, 10 * 1024 ** 3) == 200
        assert size_shuffles(spark, 1024 ** 4) == 4096
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def _py_float(x):
    try:
        return float(x)
    except (TypeError, ValueError):
        return None


def _py_int(x):
    try:
        return int(x)
    except (TypeError, ValueError):
        return None


def _py_have_0(x):
    try:
        return 0 if x.split(".")[1][-1] == "0" else 1
    except (AttributeError, IndexError):
        return 1


def _py_decimal_length(x):
    x = "nan" if x is None else x
    return 0 if "." not in x else len(x.split(".")[1])


def test_text_parsers_random_strings(spark):
    import random as _r
    rnd = _r.Random(17)
    alphabet = "0123456789.+- e"
    vals = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 6))) for _ in range(400)] + [None, "\\N"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    out = df.select("i", T.lenient_double("s").alias("d"), T.lenient_int("s").alias("n"), T.have_0("s").alias("h"),
                    T.decimal_length("s").alias("dl")).collect()
    for r in out:
        v = vals[r["i"]]
        assert r["d"] == _py_float(v), (v, r["d"])
        assert r["n"] == _py_int(v), (v, r["n"])
        assert r["h"] == _py_have_0(v), v
        assert r["dl"] == _py_decimal_length(v), v


def test_money_digits_match_two_decimal_text(spark):
    import random as _r
    rnd = _r.Random(23)
    vals = [round(rnd.uniform(-1000, 1000), rnd.choice([2, 3])) for _ in range(1000)] + [None, 0.005, 1.005, 2.675]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    out = df.select("i", *[N.money_digit("x", p).alias(f"d{p}") for p in range(3)], N.tens("x").alias("t")).collect()
    for r in out:
        x = vals[r["i"]]
        txt = "%.2f" % (-1 if x is None else x)
        assert (r["d0"], r["d1"], r["d2"]) == (int(txt[-1]), int(txt[-2]), int(txt[-4])), (x, txt)
        assert r["t"] == (-1 if x is None else x) // 10
