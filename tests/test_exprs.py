import datetime as dt

from pyspark.sql import functions as F

from tradeflow.functions import exprs as X


def test_blank_rules(spark):
    df = spark.createDataFrame([("",), ("  ",), (None,), ("A",), ("A  ",)], "s string")
    got = df.select("s", X.is_blank("s").alias("b"), X.eq_blank("s").alias("e"),
                    X.ne_blank("s").alias("n")).collect()
    m = {r.s: (r.b, r.e, r.n) for r in got}
    assert m[""] == (True, True, False)
    assert m["  "] == (True, True, False)       # trailing blanks ignored, as the source dialect does
    assert m[None] == (True, None, None)        # bare comparison with null is unknown
    assert m["A"] == (False, False, True)
    assert m["A  "] == (False, False, True)


def test_strict_date_parse_matches_strptime(spark):
    texts = ["2024-11-01", "2024-11-1", "2024-1-01", "2024-11-31", "2024-11-07T10", "", None,
             "24-11-01", "2024-13-01", "2024-00-10", " 2024-11-01", "2024-02-29", "2023-02-29"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.d for r in df.select("t", X.parse_strict_date("t").alias("d")).collect()}

    def py(t):
        if t is None:
            return None
        try:
            return dt.datetime.strptime(t, "%Y-%m-%d").date()
        except ValueError:
            return None

    for t in texts:
        assert got[t] == py(t), t


def test_object_id_and_concat(spark):
    df = spark.createDataFrame([('{"$oid": "abc"}', "X", None), ("plain", None, "P")], "i string, a string, b string")
    rows = df.select(X.object_id_text("i").alias("i"), X.concat_key("a", "b").alias("k")).collect()
    assert [tuple(r) for r in rows] == [("abc", "X-"), ("plain", "-P")]


def test_exact_sum_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 1e6 + 0.01, -0.07, 12345.6789] * 50
    a = spark.createDataFrame([(v,) for v in vals], "v double")
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "v double").repartition(7)
    sa = a.agg(X.exact_sum("v", 4).alias("s")).first().s
    sb = b.agg(X.exact_sum("v", 4).alias("s")).first().s
    assert sa == sb
    assert abs(sa - sum(vals)) < 1e-6


def test_sentinel_and_ratio(spark):
    df = spark.createDataFrame([(None, 1.0, 0.0), (dt.datetime(2024, 1, 2), 4.0, 2.0)],
                               "ts timestamp_ntz, a double, b double")
    rows = df.select(X.sentinel_ts("ts").alias("ts"), X.safe_ratio("a", "b").alias("r")).collect()
    assert rows[0].ts == dt.datetime(1900, 1, 1) and rows[0].r is None
    assert rows[1].r == 2.0


def test_exact_sum_has_no_cap(spark):
    df = spark.createDataFrame([(1e14,), (1e14,), (0.25,)], "v double")
    assert df.agg(X.exact_sum("v", 6).alias("s")).first().s == 2e14 + 0.25
    big = spark.createDataFrame([(9e16,)] * 100, "v double")
    assert big.agg(X.exact_sum("v", 2).alias("s")).first().s == 9e18


def test_bit_to_tiny(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r.t for r in df.select(X.bit_to_tiny("b").alias("t")).collect()] == [1, 0, None]
