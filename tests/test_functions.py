from pyspark.sql import functions as F

from barline.functions import argmax3, null_if_nan, order_key, population_std, prefix_length, safe_div


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_division_by_zero_and_nan_are_null(spark):
    got = one(
        spark,
        zero=safe_div(F.lit(1.0), F.lit(0.0)),
        nan=null_if_nan(F.lit(float("nan"))),
        plain=null_if_nan(F.lit(2.5)),
    )
    assert got == {"zero": None, "nan": None, "plain": 2.5}


def test_standard_deviation_of_a_flat_series_is_zero(spark):
    value = 0.1 + 0.2
    got = one(
        spark,
        flat=population_std(F.lit(value), F.lit(value * value)),
        below=population_std(F.lit(value), F.lit(value * value - 1e-17)),
        real=population_std(F.lit(1.0), F.lit(5.0)),
        unknown=population_std(F.lit(None).cast("double"), F.lit(None).cast("double")),
    )
    assert got == {"flat": 0.0, "below": 0.0, "real": 2.0, "unknown": None}


def test_prefix_length_is_four_fifths_rounded_down(spark):
    rows = spark.range(0, 5000).select("id", prefix_length(F.col("id")).alias("cut")).collect()
    assert all(r.cut == int(r.id * 0.8) == r.id * 4 // 5 for r in rows)


def test_first_score_wins_a_tie(spark):
    def best(*scores):
        return one(spark, p=argmax3(*[F.lit(s) for s in scores]))["p"]

    assert best(0.4, 0.4, 0.2) == -1
    assert best(0.2, 0.4, 0.4) == 0
    assert best(0.4, 0.2, 0.4) == -1
    assert best(0.3, 0.3, 0.4) == 1
    assert best(1 / 3, 1 / 3, 1 / 3) == -1


def test_order_key_orders_by_both_parts(spark):
    pairs = [(0, 0), (0, 10**17), (1, 0), (1, 5), (2, 3), (10**17, 1)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a bigint, b bigint")
    got = [r.i for r in df.orderBy(order_key(F.col("a"), F.col("b"))).collect()]
    assert got == list(range(len(pairs)))
