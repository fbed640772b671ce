"""How often the training queries compute their rows, and how they deal them out."""

from pyspark.sql import functions as F

from shoplens.functions.scalar import exact_avg
from shoplens.ml import train as ML
from shoplens.operators import explore as EX

N = 200
SCHEMA = "user_id long, age int, spend double, will_purchase int"


def counted(spark):
    """A frame and the number of its rows computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def row(i):
        seen.add(1)
        return i, i % 50, i * 0.25, i % 3 % 2

    return spark.createDataFrame(spark.sparkContext.parallelize(range(N), 4).map(row), SCHEMA), seen


def test_correlation_computes_its_columns_once(spark):
    df, seen = counted(spark)
    got = {r.feature: r.abs_corr for r in EX.target_correlation(df, "will_purchase").collect()}
    assert seen.value == N
    want = df.agg(*[F.abs(F.corr(c, "will_purchase")).alias(c) for c in ("age", "spend")]).first()
    assert all(abs(got[c] - want[c]) < 1e-12 for c in ("age", "spend"))


def test_training_data_computes_the_matrix_once(spark):
    df, seen = counted(spark)
    train, test = ML.prepare(df, "will_purchase")
    assert train.count() + test.count() == N and seen.value == N


def test_training_rows_have_one_even_wave_of_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 400_000, 1, 10 * cores).select("id", *[F.lit(1.0).alias(f"x{i}") for i in range(60)])
    kept = ML.sized(rows)
    sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == cores and max(sizes) - min(sizes) <= 10 * cores and sum(sizes) == 400_000
    kept.unpersist()
    assert ML.sized(spark.range(100)).rdd.getNumPartitions() == 1
    # A task holds at most 256 MB, whatever the cores.
    assert [ML.fit_partitions(b, 12) for b in (0, 24 << 20, 1500 << 20, 6 << 30)] == [1, 6, 12, 24]


def test_small_integers_have_the_mean_of_the_decimals(spark):
    df = spark.createDataFrame([(2**31 - 1,), (2**31 - 1,), (-7,), (None,)], "n int")
    r = df.agg(exact_avg("n", "integer").alias("a"), exact_avg("n").alias("b")).first()
    assert r.a == r.b == (2**32 - 9) / 3


def test_forest_sums_stay_in_a_core_s_cache(spark):
    est = ML.random_forest(["x"], "y").getStages()[-1]
    assert est.getMaxMemoryInMB() == ML.FOREST_GROUP_MB <= 8
    # Groups of few nodes give the same kind of forest: same depth, trees and fit.
    rows = spark.range(3_000).select(F.col("id").alias("user_id"), ((F.col("id") * 37) % 101).cast("double").alias("x"),
                                     ((F.col("id") * 53) % 97).cast("double").alias("z"), F.lit(1.0).alias("weight"))
    rows = rows.withColumn("y", (F.col("x") + F.col("z") > 95).cast("int")).persist()
    right = {}
    for mb in (ML.FOREST_GROUP_MB, 256):
        pipeline = ML.random_forest(["x", "z"], "y", num_trees=20, max_depth=6)
        pipeline.getStages()[-1].setMaxMemoryInMB(mb)
        model = pipeline.fit(rows)
        last = model.stages[-1]
        assert last.getNumTrees == 20 and max(t.depth for t in last.trees) == 6
        right[mb] = ML.score(model, rows, "y").where("y_true = y_pred").count() / 3_000
    rows.unpersist()
    assert min(right.values()) > 0.95 and abs(right[256] - right[ML.FOREST_GROUP_MB]) < 0.02
