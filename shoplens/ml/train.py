"""Purchase-intent classifiers on Spark ML.

Estimators are Spark ML pipelines (VectorAssembler -> optional scaler ->
classifier) trained with a balanced ``weight`` column.  Scoring produces a
``(user_id, y_true, y_score, y_pred)`` frame, so every metric comes from the
DataFrame operators in ``operators.metrics``.  Hyper-parameter names are
Spark's; see the README for the mapping from the original search spaces.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import RobustScaler, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators import metrics as ME
from shoplens.operators._util import written
from shoplens.operators.business import apply_decay
from shoplens.ml.spaces import ADVANCED_SPACES, draw, param_map
from shoplens.ml.rates import RateModel
from shoplens.session import checkpoint_dir
from shoplens.operators.splits import kfold_assign, stratified_split, with_weights

# Training-set shares of a learning curve (fixed values).
CURVE_SIZES = tuple(0.1 + 0.9 * i / 7 for i in range(8))
METRICS = ["accuracy", "precision", "recall", "f1", "auc_roc"]


# ------------------------------------------------------------------ encoding
def encode_strings(train: DataFrame, others: Sequence[DataFrame], cols: Sequence[str]):
    """M1: label-encode string features fitted on ``train`` (alphabetical
    codes); categories unseen in training map to code 0, the first class."""
    out_train, out_others = train, list(others)
    for c in cols:
        model = StringIndexer(inputCol=c, outputCol=f"{c}__idx", stringOrderType="alphabetAsc",
                              handleInvalid="keep").fit(train)
        n = len(model.labels)

        def apply(df: DataFrame) -> DataFrame:
            idx = model.transform(df)
            code = F.when(F.col(f"{c}__idx") >= n, F.lit(0.0)).otherwise(F.col(f"{c}__idx"))
            return idx.withColumn(c, code).drop(f"{c}__idx")

        out_train = apply(out_train)
        out_others = [apply(d) for d in out_others]
    return out_train, out_others


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("user_id", "will_purchase", "weight", "fold", "split")):
    return [f.name for f in df.schema.fields if f.name not in exclude and f.dataType.typeName() in
            ("integer", "long", "double", "float", "short")]


# ---------------------------------------------------------------- estimators
#: MB of sums that a pass over the rows of a forest fit fills at a time.  Each row adds to
#: a node of every tree; in the 256 MB of the default nearly every addition misses the
#: cores' caches.  A smaller group takes more passes, with fewer trees in each.
FOREST_GROUP_MB = 4


def logistic_regression(features: Sequence[str], label: str, n_rows: int, C: float = 1.0,
                        penalty: str = "l2", l1_ratio: float = 0.5, robust: bool = False, max_iter: int = 100) -> Pipeline:
    """M2 / M7: scaled logistic regression; sklearn's C maps to
    regParam = 1 / (C * n); l1 / l2 / elastic-net map to elasticNetParam."""
    scaler = (RobustScaler(inputCol="features_raw", outputCol="features", withCentering=True)
              if robust else StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True))
    enet = {"l2": 0.0, "l1": 1.0, "elasticnet": l1_ratio}[penalty]
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight", maxIter=max_iter,
                            regParam=1.0 / (C * max(n_rows, 1)), elasticNetParam=enet, standardization=False)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="keep"),
                            scaler, lr])


def random_forest(features: Sequence[str], label: str, num_trees: int = 200, max_depth: int = 10,
                  min_instances: int = 1, subsampling: float = 1.0, seed: int = 42) -> Pipeline:
    """M3: weighted random forest."""
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="weight", numTrees=num_trees,
                                maxDepth=max_depth, minInstancesPerNode=min_instances,
                                maxMemoryInMB=FOREST_GROUP_MB, subsamplingRate=subsampling, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"), rf])


def gradient_boosting(features: Sequence[str], label: str, max_iter: int = 300, step: float = 0.05,
                      max_depth: int = 5, subsampling: float = 1.0, seed: int = 42, bins: int = 32) -> Pipeline:
    """M4: the three boosting presets of the original are one Spark GBT with
    different (maxIter, stepSize, maxDepth, maxBins)."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight", maxIter=max_iter, maxBins=bins,
                        stepSize=step, maxDepth=max_depth, subsamplingRate=subsampling, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"), gbt])


# ------------------------------------------------------------------- scoring
def score(model: PipelineModel, df: DataFrame, label: str, id_col: str = "user_id", threshold: float = 0.5) -> DataFrame:
    """(id, y_true, y_score, y_pred) with y_score = P(class 1)."""
    p = F.col("probability") if isinstance(model, RateModel) else vector_to_array(F.col("probability"))[1]
    return model.transform(df).select(
        id_col, F.col(label).cast("int").alias("y_true"), p.alias("y_score"),
        (p >= threshold).cast("int").alias("y_pred"),
    )


def evaluate(scored: DataFrame) -> DataFrame:
    """Five headline metrics as one row."""
    return ME.binary_metrics(scored).crossJoin(ME.roc_auc(scored).withColumnRenamed("auc", "auc_roc"))


def _long(metrics_row: DataFrame, model_name: str, split: str) -> DataFrame:
    pairs = ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in METRICS)
    return metrics_row.selectExpr(f"'{model_name}' AS model", f"'{split}' AS split",
                                  f"stack({len(METRICS)}, {pairs}) AS (metric, value)")


#: Fits that run at a time: the small jobs of one fit leave most cores idle.
FITS_AT_A_TIME = 4


def fit_all(jobs: dict, width: int = FITS_AT_A_TIME) -> dict:
    """Runs independent fits (name -> callable) side by side, ``width`` at a time.

    The first failure is raised once the fits that already run have ended.
    """
    own = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPoolExecutor(max_workers=max(1, min(width, len(jobs)))) as pool:
        running = {name: pool.submit(own(job)) for name, job in jobs.items()}
        try:
            return {name: f.result() for name, f in running.items()}
        except BaseException:
            for f in running.values():
                f.cancel()
            raise


def scored_table(parts: dict, label: str, id_col: str = "user_id") -> tuple[dict, DataFrame]:
    """Fits and scores side by side: models by name, and one table of all scores.

    ``parts`` has by name a callable that gives a model, and the frames it scores
    with their labels, which become columns.  Each model's scores are written once,
    next to those of the others; every metric reads them from there and no model
    is applied again.
    """
    spark = SparkSession.getActiveSession()
    base = f"{checkpoint_dir(spark).rstrip('/')}/scored-{uuid.uuid4().hex[:12]}"

    def run(k: int, fit, sides) -> tuple:
        model = fit()
        frames = [score(model, df, label, id_col).withColumns({c: F.lit(v) for c, v in labels.items()}) for labels, df in sides]
        out = reduce(DataFrame.unionByName, frames)
        out.write.parquet(f"{base}/{k}")
        return model, out.schema

    done = fit_all({name: lambda k=k, part=part: run(k, *part) for k, (name, part) in enumerate(parts.items())})
    schema = next(iter(done.values()))[1]
    scored = spark.read.schema(schema).parquet(*[f"{base}/{k}" for k in range(len(parts))])
    return {name: m for name, (m, _) in done.items()}, scored


def results_of(scored: DataFrame) -> DataFrame:
    """(model, split, metric, value) of a table of scores with model and split."""
    pairs = ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in METRICS)
    return ME.grouped_metrics(scored, ["model", "split"]).selectExpr(
        "model", "split", f"stack({len(METRICS)}, {pairs}) AS (metric, value)")


def train_all(train: DataFrame, test: DataFrame, estimators: dict[str, Pipeline], label: str,
              id_col: str = "user_id") -> tuple[dict[str, PipelineModel], DataFrame]:
    """M5: fit every estimator once, score both splits once; leaderboard rows
    (model, split, metric, value) from one grouped pass over the scores."""
    models, scored = scored_table({name: (lambda est=est: est.fit(train), _both(name, train, test))
                                   for name, est in estimators.items()}, label, id_col)
    return models, results_of(scored)


def _both(name: str, train: DataFrame, test: DataFrame) -> list[tuple[dict, DataFrame]]:
    return [({"model": name, "split": "test"}, test), ({"model": name, "split": "train"}, train)]


def leaderboard(results: DataFrame) -> DataFrame:
    """T4: test metrics per model (rounded to 4), best AUC first."""
    wide = results.where(F.col("split") == "test").groupBy("model").pivot("metric", METRICS).agg(F.first("value"))
    return wide.select("model", *[F.round(m, 4).alias(m) for m in METRICS]).orderBy(F.desc("auc_roc"), "model")


def overfit_report(results: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Train, test and gap per (model, metric); a model is flagged
    when any |gap| exceeds ``threshold``; sorted by AUC gap."""
    tr = results.where(F.col("split") == "train").select("model", "metric", F.col("value").alias("train"))
    te = results.where(F.col("split") == "test").select("model", "metric", F.col("value").alias("test"))
    j = tr.join(te, ["model", "metric"]).withColumn("gap", F.col("train") - F.col("test"))
    flags = j.groupBy("model").agg(
        (F.max(F.abs("gap")) > threshold).alias("overfit"),
        F.max(F.when(F.col("metric") == "auc_roc", F.col("gap"))).alias("auc_gap"),
    )
    return j.join(flags, "model").orderBy(F.desc("auc_gap"), "model", "metric")


def choose_model(report: DataFrame) -> str:
    """Best test AUC among models not flagged; if all are flagged, the
    smallest AUC gap (the documented intent)."""
    auc = report.where(F.col("metric") == "auc_roc").select("model", "test", "overfit", "auc_gap")
    ok = auc.where(~F.col("overfit")).orderBy(F.desc("test"), "model").limit(1).collect()
    if ok:
        return ok[0]["model"]
    return auc.orderBy(F.abs("auc_gap"), "model").limit(1).collect()[0]["model"]


def importances(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """M15 + T5: tree importances or |coefficients| per feature, largest
    first; a length mismatch gives an empty frame."""
    spark = SparkSession.getActiveSession()
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray().tolist()
    elif hasattr(last, "coefficients"):
        vals = [abs(v) for v in last.coefficients.toArray().tolist()]
    else:
        vals = []
    rows = list(zip(features, [float(v) for v in vals])) if len(vals) == len(features) else []
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def linear_attributions(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean |w_j * (x_j - mean x_j)| over rows in the scaled space -- the
    exact SHAP value of a linear model -- in one aggregate pass."""
    lr = model.stages[-1]
    w = lr.coefficients.toArray().tolist()
    x = vector_to_array(F.col("features"))
    prepared = PipelineModel(stages=model.stages[:-1]).transform(df).select(x.alias("_x"))
    means = prepared.agg(*[F.avg(F.col("_x")[i]).alias(f"m{i}") for i in range(len(features))])
    j = prepared.crossJoin(F.broadcast(means))
    agg = j.agg(*[F.avg(F.abs(F.lit(w[i]) * (F.col("_x")[i] - F.col(f"m{i}")))).alias(f"a{i}")
                  for i in range(len(features))])
    pairs = ", ".join(f"'{f}', a{i}" for i, f in enumerate(features))
    return agg.selectExpr(f"stack({len(features)}, {pairs}) AS (feature, mean_abs_shap)").orderBy(
        F.desc("mean_abs_shap"), "feature")


# -------------------------------------------------------------------- tuning
def tune_model(est: Pipeline, space: dict[str, list], train: DataFrame, label: str, n_iter: int = 30, folds: int = 5,
               seed: int = 42, parallelism: int = 2):
    """Random search over a space of ``ml.spaces`` with stratified
    folds fixed by hash (``foldCol``), AUC as the score."""
    n = train.count()
    maps = [param_map(est.getStages()[-1], point, n) for point in draw(space, n_iter, seed)]
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC",
                                              weightCol="weight")
    data = kfold_assign(train, label, folds, seed).withColumn("fold", F.col("fold").cast("int"))
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=evaluator, foldCol="fold", numFolds=folds,
                        parallelism=parallelism, seed=seed)
    return cv.fit(data)


def cross_validate_all(df: DataFrame, estimators: dict[str, Pipeline], label: str, k: int = 5, seed: int = 42,
                       id_col: str = "user_id") -> DataFrame:
    """M9: per model, mean and population std of F1 and AUC over k folds."""
    data = kfold_assign(df, label, k, seed, id_col).persist()
    try:
        _, scored = scored_table({(name, f): (lambda est=est, f=f: est.fit(data.where(F.col("fold") != f)),
                                              [({"model": name, "fold": f}, data.where(F.col("fold") == f).drop("fold"))])
                                  for name, est in estimators.items() for f in range(k)}, label, id_col)
    finally:
        data.unpersist()
    return ME.grouped_metrics(scored, ["model", "fold"]).groupBy("model").agg(
        F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std"),
        F.avg("auc_roc").alias("auc_mean"), F.stddev_pop("auc_roc").alias("auc_std"),
    )


def learning_curve(df: DataFrame, est: Pipeline, label: str, sizes: Sequence[float] = CURVE_SIZES,
                   k: int = 5, seed: int = 42, id_col: str = "user_id") -> DataFrame:
    """Train / validation AUC mean and std per training-size fraction;
    the subsets are nested prefixes of the seeded hash order."""
    data = kfold_assign(df, label, k, seed, id_col).withColumn(
        "_h", F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|lc|"), F.col(id_col).cast("string"))), 1, 13), 16, 10)
        .cast("double") / float(16 ** 13)).persist()
    train = lambda frac, f: data.where((F.col("fold") != f) & (F.col("_h") < frac))
    try:
        _, scored = scored_table({
            (frac, f): (lambda frac=frac, f=f: est.fit(train(frac, f)),
                        [({"size": frac, "fold": f, "side": "train"}, train(frac, f)),
                         ({"size": frac, "fold": f, "side": "val"}, data.where(F.col("fold") == f))])
            for frac in sizes for f in range(k)}, label, id_col)
    finally:
        data.unpersist()
    m = ME.grouped_metrics(scored, ["size", "fold", "side"])
    of = lambda side: F.when(F.col("side") == side, F.col("auc_roc"))
    return m.groupBy("size").agg(
        F.avg(of("train")).alias("train_mean"), F.stddev_pop(of("train")).alias("train_std"),
        F.avg(of("val")).alias("val_mean"), F.stddev_pop(of("val")).alias("val_std"),
    ).orderBy("size")


# ------------------------------------------------------------ batch scoring
def align_features(df: DataFrame, feature_names: Sequence[str]) -> DataFrame:
    """P20: reorder to the trained feature list; missing features become 0."""
    return df.select(*[c for c in df.columns if c not in feature_names],
                     *[(F.col(c) if c in df.columns else F.lit(0.0)).cast("double").alias(c) for c in feature_names])


def batch_score(model: PipelineModel, df: DataFrame, feature_names: Sequence[str]) -> DataFrame:
    """Align, transform, take P(1) and apply the recency decay rules.

    Rate models take their columns as they are, text included.
    """
    if isinstance(model, RateModel):
        scored = model.transform(df)
    else:
        scored = model.transform(align_features(df, feature_names)).withColumn("probability", vector_to_array(F.col("probability"))[1])
    keep = [c for c in df.columns] + ["probability"]
    return apply_decay(scored.select(*keep))


# ------------------------------------------------------------ persistence
def save_model(model: PipelineModel, path: str, metadata: dict) -> None:
    """Model plus a JSON metadata row (metrics, params, feature names,
    ``trained_at``) next to it."""
    model.write().overwrite().save(f"{path}/model")
    meta = dict(metadata)
    meta.setdefault("trained_at", _dt.datetime.now(_dt.timezone.utc).isoformat())
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta), meta["trained_at"])], "metadata string, trained_at string") \
        .write.mode("overwrite").json(f"{path}/metadata")


def load_latest(spark: SparkSession, root: str) -> tuple[PipelineModel, dict]:
    """The model whose metadata has the newest ``trained_at`` under
    ``root/*``."""
    meta = spark.read.json(f"{root}/*/metadata").withColumn("_path", F.input_file_name())
    row = meta.orderBy(F.desc("trained_at")).limit(1).collect()[0]
    path = row["_path"].split("/metadata/")[0].replace("file:", "")
    return PipelineModel.load(f"{path}/model"), json.loads(row["metadata"])


def prepare(fm: DataFrame, label: str, seed: int = 42, test_size: float = 0.2):
    """Stratified split + balanced weights + string encoding, ready to fit."""
    # The matrix is computed once: drawing range borders, class sizes and the ranked
    # rows each read it again.  The split is kept, as both sides are cut from it.
    split = stratified_split(written(fm, "matrix"), label, test_size, seed).hint("rebalance").persist()
    train = with_weights(split.where(F.col("split") == "train").drop("split"), label)
    test = with_weights(split.where(F.col("split") == "test").drop("split"), label)
    strings = [f.name for f in fm.schema.fields if f.dataType.typeName() == "string" and f.name not in ("user_id",)]
    if strings:
        train, (test,) = encode_strings(train, [test], strings)
    return train, test


def fit_partitions(n_bytes: int, cores: int, task_bytes: int = 4 << 20, most_bytes: int = 256 << 20) -> int:
    """Partitions for rows that thousands of short jobs read.

    Tasks without work cost more than the work, so small data has few; beyond one
    wave of ``cores`` tasks more partitions only add aggregates to merge (a whole
    histogram each), so large data has a task a core until one would hold too much.
    """
    wave = max(1, min(-(-n_bytes // task_bytes), cores))
    return max(wave, -(-n_bytes // most_bytes))


def sized(df: DataFrame) -> DataFrame:
    """``df`` kept, dealt out evenly over as many partitions as ``fit_partitions`` says."""
    kept = df.persist()
    need = fit_partitions(kept.count() * len(df.columns) * 8, df.sparkSession.sparkContext.defaultParallelism)
    even = kept.repartition(need).persist()
    even.count()
    kept.unpersist()
    return even


# -------------------------------------------------- presets and bundles
def baseline_estimators(features: Sequence[str], label: str, n_rows: int, trees: int = 200,
                        iterations: int = 300) -> dict[str, Pipeline]:
    """M2-M4 presets: logistic regression, random forest and the three
    boosting presets (as Spark GBT)."""
    boosted = lambda depth, bins=32: gradient_boosting(features, label, max_iter=iterations, step=0.05, max_depth=depth, bins=bins)
    return {
        "logistic_regression": logistic_regression(features, label, n_rows),
        "random_forest": random_forest(features, label, num_trees=trees, max_depth=10),
        "boosted_depth": boosted(5),
        "boosted_leaves": boosted(6),
        "boosted_shallow": boosted(6, 254),  # finer borders, as its original has by default
    }


def regularised_estimators(features: Sequence[str], label: str, n_rows: int) -> dict[str, Pipeline]:
    """M7: the estimators of the regularised search, by their space's name;
    logistic regression is robustly scaled."""
    robust = lambda: logistic_regression(features, label, n_rows, robust=True, max_iter=2000)
    return {
        "logistic_l1_l2": robust(),
        "logistic_elasticnet": robust(),
        "random_forest": random_forest(features, label),
        **{name: gradient_boosting(features, label) for name in ("boosted_depth", "boosted_leaves", "boosted_shallow")},
    }


def train_regularised(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, n_iter: int = 20,
                      folds: int = 5, names: Sequence[str] | None = None) -> dict[str, PipelineModel]:
    """M7: searches every advanced space; of the two logistic searches the one
    with the higher test AUC is kept (l1 / l2 on a tie)."""
    ests = regularised_estimators(features, label, train.count())
    models = {n: tune_model(ests[n], ADVANCED_SPACES[n], train, label, n_iter, folds).bestModel for n in names or ests}
    pair = [n for n in ("logistic_l1_l2", "logistic_elasticnet") if n in models]
    if len(pair) == 2:
        auc = {n: ME.roc_auc(score(models[n], test, label)).first()[0] or 0.0 for n in pair}
        del models[pair[1] if auc[pair[0]] >= auc[pair[1]] else pair[0]]
    return {f"{n} (adv)": m for n, m in models.items()}


def train_all_advanced(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, threshold: float = 0.05,
                       n_iter: int = 20, folds: int = 5, trees: int = 200, iterations: int = 300,
                       names: Sequence[str] | None = None):
    """M8: baselines plus the regularised search (``names`` picks its spaces),
    then the overfit-aware choice (M11-M13).  Returns (models, results,
    report, chosen name)."""
    ests = baseline_estimators(features, label, train.count(), trees, iterations)
    models, results = train_all(train, test, ests, label)
    more = train_regularised(train, test, features, label, n_iter, folds, names)
    if more:
        more, scored = scored_table({name: (lambda m=m: m, _both(name, train, test)) for name, m in more.items()}, label)
        models |= more
        results = results.unionByName(results_of(scored))
    report = overfit_report(results, threshold)
    return models, results, report, choose_model(report)


def tune_best(name: str, est: Pipeline, space: dict[str, list], train: DataFrame, test: DataFrame, label: str,
              n_iter: int = 30, folds: int = 5, seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Random-search the current winner (``SPACES[name]``) and rescore it
    on the test split under the name "<name> (tuned)"."""
    cv = tune_model(est, space, train, label, n_iter, folds, seed)
    best = cv.bestModel
    return best, _long(evaluate(score(best, test, label)), f"{name} (tuned)", "test")


def live_metrics(model: PipelineModel, fm: DataFrame, features: Sequence[str], label: str = "will_purchase",
                 top: int = 10) -> DataFrame:
    """One-row bundle over the whole matrix -- headline metrics, ROC
    points (thinned), top importances and customer statistics."""
    from shoplens.operators.explore import customer_stats

    scored = score(model, align_features(fm, features), label)
    roc = ME.roc_points(scored, drop_intermediate=False).agg(
        F.sort_array(F.collect_list(F.struct("point", "fpr", "tpr"))).alias("roc_curve"))
    imp = importances(model, features).limit(top).agg(
        F.collect_list("feature").alias("labels"), F.collect_list("importance").alias("values"))
    stats = customer_stats(fm, label)
    return (evaluate(scored).select(F.struct("*").alias("metrics"))
            .crossJoin(roc).crossJoin(imp.select(F.struct("labels", "values").alias("feature_importance")))
            .crossJoin(stats.select(F.struct("*").alias("customer_stats"))))
