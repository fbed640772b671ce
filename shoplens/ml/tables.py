"""Fitted models as tables (M2-M4, M15, T5): one row per tree node or coefficient.

A table of nodes can be kept, joined and read by any SQL engine.  Scores come from
walking it, importances from sums over it, and a linear model shows by the
gradient of its loss how near to its optimum the fit ended.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators._util import written
from shoplens.session import checkpoint_dir

#: Tables of at most so many nodes (some 64 bytes each) are sent to every executor.
BROADCAST_NODES = 1 << 20
#: A node's key: its tree above, its number below these bits.
NODE_BITS = 32

FOREST, BOOSTED = "forest", "boosted"


@dataclass(frozen=True)
class TreeTable:
    """An ensemble of binary classification trees.

    ``nodes`` has tree, weight (of the tree), node (numbered without gaps, 0 is the root), feature (its place
    in ``features``, -1 in a leaf), threshold (values up to it go left), categories
    (null, or the values that go left), left, right (the node itself in a leaf), value
    (share of class 1 of a forest, prediction of a boosted tree), gain and n_rows
    (summed weight of the training rows).
    """

    nodes: DataFrame
    kind: str
    depth: int
    features: tuple[str, ...]
    n_trees: int
    n_nodes: int

    def write(self, path: str) -> None:
        spark = self.nodes.sparkSession
        self.nodes.write.parquet(f"{path}/nodes")
        spark.createDataFrame([(self.kind, self.depth, list(self.features), self.n_trees, self.n_nodes)],
                              "kind string, depth int, features array<string>, n_trees int, n_nodes long").write.parquet(f"{path}/about")


def read_trees(spark: SparkSession, path: str) -> TreeTable:
    """The ensemble that ``TreeTable.write`` left under ``path``."""
    about = spark.read.parquet(f"{path}/about").first()
    return TreeTable(spark.read.parquet(f"{path}/nodes"), about["kind"], about["depth"], tuple(about["features"]),
                     about["n_trees"], about["n_nodes"])


def tree_table(model: PipelineModel, features: Sequence[str]) -> TreeTable:
    """The trees of a fitted forest or boosting pipeline, from its saved form."""
    last = model.stages[-1]
    if not hasattr(last, "getNumTrees") or last.numClasses != 2:
        raise ValueError("not an ensemble of binary classification trees")
    kind = BOOSTED if isinstance(last, GBTClassificationModel) else FOREST
    spark = SparkSession.getActiveSession()
    path = _saved(last, spark)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "_about", "weight").select("tree", "weight")
    stats = F.col("n.impurityStats")
    # Regression trees keep (weight, sum, sum of squares), classification trees the weight of each class.
    rows = stats[0] if kind == BOOSTED else stats[0] + stats[1]
    value = F.col("n.prediction") if kind == BOOSTED else F.try_divide(stats[1], stats[0] + stats[1])
    leaf = F.col("n.leftChild") < 0
    split = F.col("n.split.leftCategoriesOrThreshold")
    categorical = ~leaf & (F.col("n.split.numCategories") >= 0)
    saved = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), F.col("nodeData").alias("n"))
    nodes = written(saved.join(F.broadcast(weights), "tree").select(  # one row per tree
        "tree", "weight", F.col("n.id").alias("node"),
        F.when(leaf, -1).otherwise(F.col("n.split.featureIndex")).alias("feature"),
        F.when(~leaf & ~categorical, F.get(split, F.lit(0))).alias("threshold"),
        F.when(categorical, split).alias("categories"),
        F.when(leaf, F.col("n.id")).otherwise(F.col("n.leftChild")).alias("left"),
        F.when(leaf, F.col("n.id")).otherwise(F.col("n.rightChild")).alias("right"),
        value.alias("value"), F.when(~leaf, F.col("n.gain")).alias("gain"), rows.alias("n_rows")), "nodes")
    n_trees, n_nodes = nodes.agg(F.count_distinct("tree"), F.count(F.lit(1))).first()
    return TreeTable(nodes, kind, last.getMaxDepth(), tuple(features), n_trees, n_nodes)


def _saved(model, spark: SparkSession) -> str:
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex[:12]}"
    model.write().save(path)
    return path


def _key(tree: Column, node: Column) -> Column:
    return F.shiftleft(tree.cast("long"), NODE_BITS) + node


def _goes_left(x: Column, feature: Column, threshold: Column, categories: Column | None) -> Column:
    found = F.get(x, feature)
    below = found <= threshold
    return below if categories is None else F.when(categories.isNotNull(), F.array_contains(categories, found)).otherwise(below)


def _ends_in_memory(at: DataFrame, trees: TreeTable) -> DataFrame:
    """(_id, weight, value) of the leaf that each row of ``at`` (_id, _x, _tree) ends at.

    One row a tree, with its nodes as an array, is sent to the executors; a step down is
    a look into this array, in the row's own task.  The steps are one generated method,
    which the JVM runs compiled only up to 8,000 bytes: a step has to be short, and
    looks at categories only where some split has them.
    """
    nodes = F.sort_array(F.collect_list(F.struct("node", "feature", "threshold", "left", "right", "value", "categories")))
    whole = written(trees.nodes.groupBy("tree").agg(F.first("weight").alias("weight"), nodes.alias("_nodes"),
                                                    F.count("categories").alias("_sets")), "trees")
    sets = not whole.where("_sets > 0").isEmpty()
    if not sets:
        whole = whole.withColumn("_nodes", F.transform("_nodes", lambda n: n.dropFields("node", "categories")))
    at = at.join(F.broadcast(whole.drop("_sets")), F.col("_tree") == F.col("tree")).withColumn("_n", F.get("_nodes", F.lit(0)))
    left = _goes_left(F.col("_x"), F.col("_n.feature"), F.col("_n.threshold"), F.col("_n.categories") if sets else None)
    for _ in range(trees.depth):
        at = at.withColumn("_n", F.get("_nodes", F.when(left, F.col("_n.left")).otherwise(F.col("_n.right"))))
    return at.select("_id", "weight", F.col("_n.value").alias("value"))


def _ends_by_joins(at: DataFrame, trees: TreeTable) -> DataFrame:
    """The same by one join with the nodes a level, for tables too large to send."""
    table = trees.nodes.select(
        _key(F.col("tree"), F.col("node")).alias("_key"), "feature", "threshold", "categories",
        _key(F.col("tree"), F.col("left")).alias("_left"), _key(F.col("tree"), F.col("right")).alias("_right"),
        "weight", "value")
    left = _goes_left(F.col("_x"), F.col("feature"), F.col("threshold"), F.col("categories"))
    at = at.select("_id", "_x", _key(F.col("_tree"), F.lit(0)).alias("_at"))
    for _ in range(trees.depth):
        at = at.join(table, F.col("_at") == F.col("_key")).select(
            "_id", "_x", F.when(left, F.col("_left")).otherwise(F.col("_right")).alias("_at"))
    return at.select("_id", "_at").join(table, F.col("_at") == F.col("_key")).select("_id", "weight", "value")


def tree_scores(df: DataFrame, trees: TreeTable, id_col: str = "user_id") -> DataFrame:
    """(``id_col``, y_score): the probability of class 1, from the table alone.

    Every row meets every tree and goes down it a level at a time; rows at a leaf stay
    there.  The trees are sent to the executors while their nodes are few
    (``BROADCAST_NODES``), so all of a row's steps are taken in one task, and one partial
    sum per id is left.  A row is many steps of work, so rows are first dealt out over
    all cores, however few partitions they lie in.  Missing values go right, as NaN does.
    Rows of one id (and those without an id) get the mean of their scores (forest) or of
    their margins (boosting).
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    values = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in trees.features])
    at = (df.select(F.col(f"`{id_col}`").alias("_id"), values.alias("_x")).repartition(parts)
          .select("_id", "_x", F.explode(F.sequence(F.lit(0), F.lit(trees.n_trees - 1))).alias("_tree")))
    ends = (_ends_in_memory if trees.n_nodes <= BROADCAST_NODES else _ends_by_joins)(at, trees).groupBy("_id")
    if trees.kind == FOREST:
        return ends.agg(F.avg("value").alias("y_score")).withColumnRenamed("_id", id_col)
    sums = ends.agg(F.sum(F.col("weight") * F.col("value")).alias("_m"), (F.count(F.lit(1)) / trees.n_trees).alias("_copies"))
    score = 1.0 / (1.0 + F.exp(-2.0 * F.col("_m") / F.col("_copies")))
    return sums.select(F.col("_id").alias(id_col), score.alias("y_score"))


def tree_importances(trees: TreeTable) -> DataFrame:
    """(feature, importance) from the nodes, largest first; shares of 1.

    A split counts its gain times the rows it saw.  A forest's trees count alike, a
    boosted model's by their gains.  Features without a split have 0; without any
    split at all every importance is 0.
    """
    spark = trees.nodes.sparkSession
    names = spark.createDataFrame(list(enumerate(trees.features)), "_f int, feature string")
    gains = trees.nodes.where("feature >= 0").groupBy("tree", F.col("feature").alias("_f")).agg(
        F.sum(F.col("gain") * F.col("n_rows")).alias("_g"))
    if trees.kind == FOREST:
        whole = gains.groupBy("tree").agg(F.sum("_g").alias("_w"))
        gains = gains.join(whole, "tree").withColumn("_g", F.try_divide("_g", "_w"))
    gains = gains.groupBy("_f").agg(F.sum("_g").alias("_g"))
    total = gains.agg(F.sum("_g").alias("_all"))
    share = F.coalesce(F.try_divide("_g", "_all"), F.lit(0.0))
    return (names.join(gains, "_f", "left").crossJoin(F.broadcast(total))  # one row
            .select("feature", share.alias("importance")).orderBy(F.desc("importance"), "feature"))


def logistic_gradient(model: PipelineModel, df: DataFrame, features: Sequence[str], label: str,
                      weight: str = "weight") -> DataFrame:
    """(feature, coefficient, gradient) of a fitted logistic pipeline over its training rows.

    The gradient is that of the mean weighted log loss plus the penalty, by the scaled
    features; the row "(intercept)" has no penalty.  For coefficients at zero under an
    l1 penalty it is the least subgradient.  At the optimum all are zero.  One
    aggregate gives them all; rows with a null label or weight take no part.
    """
    lr = model.stages[-1]
    l2 = lr.getRegParam() * (1.0 - lr.getElasticNetParam())
    l1 = lr.getRegParam() * lr.getElasticNetParam()
    scored = model.transform(df).select(vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p"),
                                        F.col(f"`{label}`").cast("double").alias("y"), F.col(f"`{weight}`").cast("double").alias("w"))
    pull = F.col("w") * (F.col("p") - F.col("y"))
    seen = scored.where("y IS NOT NULL AND w IS NOT NULL")
    names = [*features, "(intercept)"]
    sums = [F.sum(pull * F.col("x")[i]) for i in range(len(features))] + [F.sum(pull)]
    means = seen.agg(F.array(*[F.try_divide(s, F.sum("w")) for s in sums]).alias("g"))
    table = df.sparkSession.createDataFrame(
        [(i, n, c) for i, (n, c) in enumerate(zip(names, [*lr.coefficients.toArray().tolist(), lr.intercept]))],
        "_i int, feature string, coefficient double")
    smooth = F.get(F.col("g"), F.col("_i")) + F.when(F.col("_i") < len(features), l2 * F.col("coefficient")).otherwise(0.0)
    b = F.col("coefficient")
    slack = F.signum("_s") * F.greatest(F.abs("_s") - F.lit(l1), F.lit(0.0))
    whole = F.when(F.col("_i") == len(features), F.col("_s")).when(b == 0, slack).otherwise(F.col("_s") + F.lit(l1) * F.signum(b))
    return (table.crossJoin(F.broadcast(means)).withColumn("_s", smooth)  # one row
            .select("feature", "coefficient", whole.alias("gradient")))
