import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from shoplens.functions.scalar import exact_avg, exact_sum, exact_terms, exact_total
from shoplens.operators import rfm


def _sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    return df.agg(exact_sum("v").alias("s")).first().s


def test_no_digit_is_cut(spark):
    assert _sum(spark, [4e-7] * 1000) == 4e-4
    assert _sum(spark, [1e15] + [4e-7] * 1000) == 1e15
    assert _sum(spark, [1e15, 4e-7, -1e15]) == 4e-7
    assert _sum(spark, [1e25, 1.0]) == 1e25 and math.isclose(_sum(spark, [1e-40] * 10), 1e-39, rel_tol=1e-14)
    assert _sum(spark, [0.1] * 10) == 1.0 and _sum(spark, [1.0, None, 2.5]) == 3.5
    assert _sum(spark, [None, None]) is None and _sum(spark, []) is None
    assert math.isnan(_sum(spark, [1.0, float("nan")])) and _sum(spark, [1.0, float("inf")]) == float("inf")


def test_sum_does_not_depend_on_the_order(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 9) for _ in range(3000)]
    seen = set()
    for k in range(3):
        rng.shuffle(values)
        seen.add(_sum(spark, values))
    assert len(seen) == 1
    # Values count as the shortest decimals that stand for them.
    want = float(sum(Fraction(repr(v)) for v in values))
    assert math.isclose(seen.pop(), want, rel_tol=1e-15)


def test_two_levels_and_other_types(spark):
    df = spark.createDataFrame([(k % 3, k % 5, 0.1 * k, k) for k in range(300)], "g int, h int, v double, n int")
    per = df.groupBy("g", "h").agg(*[F.sum(t).alias(f"t{i}") for i, t in enumerate(exact_terms("v"))])
    two = per.groupBy("g").agg(exact_total(*[F.sum(f"t{i}") for i in range(3)]).alias("s"))
    one = df.groupBy("g").agg(exact_sum("v").alias("s"))
    assert sorted(two.collect()) == sorted(one.collect())
    r = df.agg(exact_sum("n").alias("n"), exact_avg(F.col("n").cast("decimal(12,2)")).alias("d")).first()
    assert (r.n, r.d) == (44850.0, 149.5)


def test_money_keeps_its_thousandths(spark):
    orders = spark.createDataFrame([(1, "u", "2024-01-01 00:00:00", 0.004), (2, "u", "2024-01-02 00:00:00", 0.004)],
                                   "order_id int, user_id string, order_date string, total_amount double")
    orders = orders.withColumn("order_date", F.to_timestamp("order_date"))
    assert rfm.rfm_base(orders).first().monetary == 0.008
