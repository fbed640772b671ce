import random

from pyspark.sql import functions as F

from shoplens.operators import clean as C
from shoplens.operators import explore as EX
from shoplens.operators import metrics as ME
from shoplens.operators import quality as Q
from shoplens.operators.fingerprint import distinct_rows, repeated_rows
from shoplens.operators.ranking import global_rank, with_next


def _frame(spark):
    rows = [(k % 40, None if k % 7 == 0 else f"t{k % 9}", float(k % 3) if k % 5 else None) for k in range(500)]
    rows += [(None, "x", 1.0), (None, None, None), (None, None, None), (1, None, 0.0), (1, None, -0.0)]
    return spark.createDataFrame(rows, "a int, `b.c` string, d double").repartition(5)


def test_counts_and_rows_equal_a_full_comparison(spark):
    df = _frame(spark)
    want = df.dropDuplicates()
    assert repeated_rows(df).first().n_duplicates == df.count() - want.count()
    assert sorted(distinct_rows(df).collect(), key=repr) == sorted(want.collect(), key=repr)
    assert C.remove_duplicates(df).count() == want.count()
    empty = df.where("false")
    assert repeated_rows(empty).first().n_duplicates == 0 and distinct_rows(empty).count() == 0


def test_forced_collisions_change_nothing(spark):
    df = _frame(spark)
    same = lambda cols: [F.lit(5).cast("long"), F.lit(7).cast("long")]
    few = lambda cols: [F.xxhash64("a") % 3, F.lit(7).cast("long")]
    n = df.count() - df.dropDuplicates().count()
    for fp in (same, few):
        assert repeated_rows(df, fp).first().n_duplicates == n
        assert distinct_rows(df, fp).count() == df.count() - n


def test_only_rows_that_meet_are_shuffled(spark):
    df = spark.range(2000).select("id", F.concat(F.lit("wide "), F.col("id")).alias("text"))
    assert Q.count_duplicates(df).first().n_duplicates == 0
    plan = Q.count_duplicates(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "_meets" in plan or "_bits" in plan
    assert EX.table_profile({"t": df.union(df.limit(3))}).first().duplicate_rows == 3


def test_modes_without_a_buffer(spark):
    rows = [("b", None, "z"), ("a", None, "z"), ("b", None, None), ("a", None, "y"), (None, None, "y")]
    df = spark.createDataFrame(rows, "s string, n string, t string")
    assert C.modes(df, ["s", "n", "t"]) == {"s": "a", "n": None, "t": "y"}
    distinct = spark.range(3000).select(F.format_string("v%05d", "id").alias("s"))
    assert C.modes(distinct, ["s"]) == {"s": "v00000"}
    filled = C.handle_missing_values(df, "median").collect()
    assert [r.s for r in filled].count("a") == 3 and all(r.n is None for r in filled)


def test_facts_are_counted_before_the_join(spark):
    facts = spark.createDataFrame([(k % 4,) for k in range(10)] + [(None,), (99,)], "k int")
    dim = spark.createDataFrame([(0, "x"), (1, "x"), (2, "y"), (3, None)], "k int, attr string")
    got = {r.attr: r["count"] for r in EX.count_by_dimension(facts, dim, "k", "attr").collect()}
    assert got == {"x": 6, "y": 2, None: 4}


def test_next_row_across_stretches(spark):
    n = (1 << 16) + 5
    r = global_rank(spark.range(n).withColumn("v", F.col("id") * 2), "id", rank_col="point")
    bad = with_next(r, ["v"], "point").where(~F.col("next_v").eqNullSafe(F.when(F.col("id") < n - 1, F.col("v") + 2)))
    assert bad.count() == 0


def test_roc_points_equal_brute_force(spark):
    rng = random.Random(6)
    rows = [(rng.randint(0, 1), rng.randint(0, 30) / 30) for _ in range(200)]
    df = spark.createDataFrame(rows, "y_true int, y_score double").repartition(6)
    got = sorted((r.point, round(r.fpr, 12), round(r.tpr, 12)) for r in ME.roc_points(df, max_points=None).collect())
    p, n = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    curve = [(sum(1 - y for y, s in rows if s >= t), sum(y for y, s in rows if s >= t)) for t in sorted({s for _, s in rows}, reverse=True)]
    keep = [k for k in range(len(curve)) if k in (0, len(curve) - 1)
            or any(curve[k - 1][i] - 2 * curve[k][i] + curve[k + 1][i] for i in (0, 1))]
    want = [(0, 0.0, 0.0)] + [(j + 1, round(curve[k][0] / n, 12), round(curve[k][1] / p, 12)) for j, k in enumerate(keep)]
    assert got == want


def test_grouped_metrics_equal_the_single_ones(spark):
    rng = random.Random(2)
    rows = [("m" if k % 2 else None, k % 3, rng.randint(0, 1), rng.randint(0, 20) / 20) for k in range(600)]
    rows += [("one class", 0, 1, 0.5), ("one class", 0, 1, None), ("m", 0, None, 0.1)]
    df = spark.createDataFrame(rows, "g string, h int, y_true int, y_score double").withColumn("y_pred", (F.col("y_score") >= 0.5).cast("int"))
    got = ME.grouped_metrics(df.repartition(9), ["g", "h"]).collect()
    assert len(got) == 7
    for r in got:
        part = df.where(F.col("g").eqNullSafe(F.lit(r.g)) & (F.col("h") == r.h))
        m, a = ME.binary_metrics(part).first(), ME.roc_auc(part).first().auc
        assert (r.accuracy, r.precision, r.recall, r.f1) == tuple(m)
        assert r.auc_roc == a


def test_grouped_rank_of_one_group_that_is_the_table(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), F.when(F.col("id") < 4990, "all").otherwise("rest").alias("g"))
    r = global_rank(df.repartition(8), "v", sums=["v"], groups=["g"])
    from pyspark.sql import Window

    w = Window.partitionBy("g").orderBy("v")
    want = df.withColumn("rank", F.row_number().over(w)).withColumn("cum_v", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(r.select("g", "v", "rank", "cum_v").collect()) == sorted(want.select("g", "v", "rank", "cum_v").collect())
