"""Scoring: an isolation forest and boosted trees, fitted and applied as Spark jobs."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..fixed import MODEL_FEATURES
from ..functions.columns import blend
from ..schemas import SCORE_COLUMNS
from . import boosting
from .typology import coarse_type, typology_label

HOLDOUT_PERCENT = 25


def feature_matrix(g: DataFrame, *keep: str) -> DataFrame:
    """The model's inputs as doubles, nulls as 0."""
    inputs = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in MODEL_FEATURES]
    return g.select("txn_id", *keep, *inputs)


def feature_stats(x: DataFrame) -> DataFrame:
    """Mean and population deviation of each input, as one row."""
    parts = []
    for n in MODEL_FEATURES:
        parts += [F.avg(n).alias(f"mean_{n}"), F.stddev_pop(n).alias(f"std_{n}")]
    return x.agg(*parts)


def _scaled(name: str, mean: Column, std: Column) -> Column:
    return ((F.col(name) - mean) / F.when(std > 0, std).otherwise(1.0)).alias(name)


def standard_scale(x: DataFrame) -> DataFrame:
    """Each input less its mean, over its deviation (1 where it does not vary)."""
    stats = feature_stats(x)
    one = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    scaled = [_scaled(n, one[f"mean_{n}"], one[f"std_{n}"]) for n in MODEL_FEATURES]
    return x.select(*[c for c in x.columns if c not in MODEL_FEATURES], *scaled)


# ---- isolation forest ----------------------------------------------------------------------------------

NODE_SCHEMA = "tree int, node int, feature int, threshold double, value double"


def _average_path(n: int) -> float:
    """Expected depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def _grow(points: np.ndarray, rng: np.random.Generator, height: int) -> list[tuple]:
    """Nodes as (position, feature, threshold, depth reached); children of i are at 2i+1 and 2i+2."""
    nodes, open_nodes = [], [(0, 0, points)]
    while open_nodes:
        at, depth, rows = open_nodes.pop()
        varying = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
        if depth == height or not len(varying):
            nodes.append((at, -1, 0.0, depth + _average_path(len(rows))))
            continue
        feature = int(rng.choice(varying))
        column = rows[:, feature]
        cut = float(rng.uniform(column.min(), column.max()))
        nodes.append((at, feature, cut, 0.0))
        open_nodes += [(2 * at + 1, depth + 1, rows[column <= cut]), (2 * at + 2, depth + 1, rows[column > cut])]
    return nodes


def _uniform(*parts) -> Column:
    """A number in [0, 1) that depends on the row's id only, so retries draw the same sample."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


def anomaly_fit(x: DataFrame, trees: int = 300, sample: int = 256, seed: int = 42) -> DataFrame:
    """Fit the forest: the model is a DataFrame of at most trees * (4 * sample) nodes.

    First a sample of about trees * sample rows is cut from the table by hash, then each tree draws from
    that; so the table is read twice (its size, the sample) and never shuffled, and a group holds about
    `sample` rows whatever the table's size.
    """
    height = max(1, math.ceil(math.log2(sample)))
    total = x.agg(F.count(F.lit(1)).alias("n")).scalar().cast("double")
    pool = F.least(total, F.lit(float(trees * sample)))
    pooled = x.filter(_uniform("txn_id", F.lit(seed)) < pool / total).withColumn("share", F.lit(float(sample)) / pool)
    mine = F.filter(  # the trees a row is drawn for; only those copies of it are made
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda tree: _uniform(F.col("txn_id"), tree, F.lit(seed + 1)) < F.col("share"))
    drawn = pooled.withColumn("tree", F.explode(mine))

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf.sort_values("txn_id")[MODEL_FEATURES].to_numpy(float)
        nodes = _grow(points, np.random.default_rng([seed, int(key[0])]), height)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "value"])
        out.insert(0, "tree", int(key[0]))
        return out

    return drawn.select("tree", "txn_id", *MODEL_FEATURES).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def _forest_arrays(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The forest as three arrays. Its size is bounded by trees and sample, never by the data scored."""
    pdf = nodes.toPandas()
    order = {t: i for i, t in enumerate(sorted(pdf["tree"].unique()))}
    shape = (len(order), int(pdf["node"].max()) + 1)
    feature, threshold, value = np.full(shape, -1, np.int16), np.zeros(shape), np.zeros(shape)
    at = (pdf["tree"].map(order).to_numpy(), pdf["node"].to_numpy())
    feature[at], threshold[at], value[at] = pdf["feature"], pdf["threshold"], pdf["value"]
    return feature, threshold, value


def raw_anomaly(x: DataFrame, nodes: DataFrame, sample: int = 256) -> DataFrame:
    """Rows with ``raw``: 2 to the minus mean path length over the expected one."""
    forest = x.sparkSession.sparkContext.broadcast(boosting.padded(*_forest_arrays(nodes)))
    expected = _average_path(sample)

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        total = boosting.tree_sums(np.column_stack([c.to_numpy(float) for c in columns]), forest.value)
        return pd.Series(np.exp2(-total / max(len(forest.value[0]), 1) / expected))

    return x.withColumn("raw", score(*MODEL_FEATURES))


def normalise(raw: Column, low, high) -> Column:
    return (raw - low) / (high - low + 1e-9)


def normalise_rows(scored: DataFrame) -> DataFrame:
    """``raw`` as a score between 0 and 1 over the given rows (0.5 for a single row). The rows are read twice:
    store them first where scoring them costs much."""
    ends = scored.agg(F.struct(F.min("raw").alias("lo"), F.max("raw").alias("hi"), F.count(F.lit(1)).alias("n")).alias("s")).scalar()
    value = F.when(ends["n"] > 1, normalise(F.col("raw"), ends["lo"], ends["hi"])).otherwise(0.5)
    return scored.withColumn("anomaly_score", value).drop("raw")


def anomaly_score(x: DataFrame, nodes: DataFrame, sample: int = 256) -> DataFrame:
    return normalise_rows(raw_anomaly(x, nodes, sample))


# ---- boosted trees -------------------------------------------------------------------------------------


def is_holdout(txn_id: Column) -> Column:
    digits = F.conv(F.substring(F.md5(txn_id), 1, 6), 16, 10).cast("long")
    return digits % 100 < HOLDOUT_PERCENT


def split_holdout(g: DataFrame) -> DataFrame:
    """Labelled rows with their part. A hash of the id decides, so a row keeps its part for ever; each class
    is split in the same proportion up to chance."""
    return g.filter(F.col("is_fraud").isNotNull()).select(
        "txn_id", "is_fraud", F.when(is_holdout(F.col("txn_id")), "test").otherwise("train").alias("part"))


def gbt_fit(x: DataFrame, rounds: int = 200, depth: int = 3, lr: float = 0.08, seed: int = 42) -> boosting.BoostedTrees:
    """Fit on rows with ``is_fraud`` set."""
    rows = x.select(*[F.col(n).cast("double").alias(n) for n in MODEL_FEATURES], F.col("is_fraud").cast("double").alias("is_fraud"))
    return boosting.fit(rows, MODEL_FEATURES, "is_fraud", rounds, depth, lr, seed)


def gbt_score(x: DataFrame, model: boosting.BoostedTrees) -> DataFrame:
    trees = x.sparkSession.sparkContext.broadcast(
        (boosting.padded(model.feature, model.threshold, model.value), model.weights))

    @F.pandas_udf("double")
    def probability(*columns: pd.Series) -> pd.Series:
        points = np.column_stack([c.to_numpy(float) for c in columns])
        if np.isnan(points).any():
            raise ValueError("inputs hold nulls or NaN")
        return pd.Series(1.0 / (1.0 + np.exp(-2.0 * boosting.tree_sums(points, *trees.value))))

    return x.withColumn("fraud_probability", probability(*[F.col(n).cast("double") for n in MODEL_FEATURES]))


def eval_auc(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve of ``fraud_probability`` for labelled rows."""
    labelled = scored.filter(F.col("is_fraud").isNotNull()).select(
        F.col("is_fraud").cast("double").alias("label"), F.col("fraud_probability").alias("score"))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    return scored.sparkSession.createDataFrame([(float(evaluator.evaluate(labelled)),)], "auc double")


def eval_report(scored: DataFrame, cut: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, from one pass of counts."""
    truth, guess = F.col("is_fraud") == 1, F.col("fraud_probability") > cut
    counts = scored.filter(F.col("is_fraud").isNotNull()).agg(
        F.count_if(truth & guess).alias("tp"), F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"), F.count_if(~truth & ~guess).alias("tn"))
    row = lambda label, hit, extra, missed: F.struct(
        F.lit(label).alias("label"), F.col(hit).alias("hit"), F.col(extra).alias("extra"), F.col(missed).alias("missed"))
    rows = counts.select(F.explode(F.array(row(0, "tn", "fn", "fp"), row(1, "tp", "fp", "fn"))).alias("r")).select("r.*")
    share = lambda part, whole: F.coalesce(F.try_divide(part, whole), F.lit(0.0))
    hit, extra, missed = F.col("hit"), F.col("extra"), F.col("missed")
    return rows.select(
        "label", share(hit, hit + extra).alias("precision"), share(hit, hit + missed).alias("recall"),
        share(hit * 2, hit * 2 + extra + missed).alias("f1"), (hit + missed).alias("support"))


# ---- the whole model -----------------------------------------------------------------------------------


@dataclass
class RiskModel:
    """Everything a scorer needs: scaling, forest, the forest's score range on its training rows, boosting."""

    means: list[float]
    stds: list[float]
    nodes: DataFrame
    raw_min: float
    raw_max: float
    gbt: boosting.BoostedTrees
    sample: int = 256

    def scale(self, x: DataFrame) -> DataFrame:
        scaled = [_scaled(n, F.lit(m), F.lit(s)) for n, m, s in zip(MODEL_FEATURES, self.means, self.stds)]
        return x.select(*[c for c in x.columns if c not in MODEL_FEATURES], *scaled)


def fit_model(g: DataFrame, nodes_path: str, trees: int = 300, rounds: int = 200, sample: int = 256) -> RiskModel:
    """Fit both models on gold rows. The forest is written to ``nodes_path`` and read back, so that scoring
    never grows it again."""
    x = feature_matrix(g)
    stats = feature_stats(x).first()
    means = [stats[f"mean_{n}"] for n in MODEL_FEATURES]
    stds = [stats[f"std_{n}"] for n in MODEL_FEATURES]
    model = RiskModel(means, stds, None, 0.0, 1.0, None, sample)
    scaled = model.scale(x)
    anomaly_fit(scaled, trees, sample).write.mode("overwrite").parquet(nodes_path)
    model.nodes = g.sparkSession.read.parquet(nodes_path)
    ends = raw_anomaly(scaled, model.nodes, sample).agg(F.min("raw"), F.max("raw")).first()
    model.raw_min, model.raw_max = ends[0], ends[1]
    labelled = feature_matrix(g.filter(F.col("is_fraud").isNotNull()), "is_fraud")
    model.gbt = gbt_fit(labelled.filter(~is_holdout(F.col("txn_id"))), rounds)
    return model


def model_save(model: RiskModel, path: str) -> None:
    spark = model.nodes.sparkSession
    model.nodes.write.mode("overwrite").parquet(f"{path}/forest")
    model.gbt.to_rows(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/gbt")
    row = (MODEL_FEATURES, model.means, model.stds, model.raw_min, model.raw_max, model.sample)
    spark.createDataFrame(
        [row], "features array<string>, means array<double>, stds array<double>, raw_min double, raw_max double, sample int"
    ).write.mode("overwrite").parquet(f"{path}/about")


def model_load(spark: SparkSession, path: str) -> RiskModel:
    about = spark.read.parquet(f"{path}/about").first()
    if about["features"] != MODEL_FEATURES:
        raise ValueError("the stored model was fitted on other features")
    return RiskModel(about["means"], about["stds"], spark.read.parquet(f"{path}/forest"), about["raw_min"],
                     about["raw_max"], boosting.BoostedTrees.from_rows(spark.read.parquet(f"{path}/gbt")), about["sample"])


def blend_score(scored: DataFrame) -> DataFrame:
    return scored.withColumn("final_risk_score", blend(F.col("anomaly_score"), F.col("fraud_probability")))


def score_rows(g: DataFrame, model: RiskModel, mode: str = "train") -> DataFrame:
    """Gold rows with the three scores. ``train`` measures anomaly on the training range, so a row's score
    does not depend on its batch; ``batch`` on the range of the rows given."""
    scaled = model.scale(feature_matrix(g))
    if mode == "batch":
        anomalies = anomaly_score(scaled, model.nodes, model.sample).select("txn_id", "anomaly_score")
        scored = gbt_score(feature_matrix(g), model.gbt).select("txn_id", "fraud_probability")
        return blend_score(g.join(anomalies, "txn_id").join(scored, "txn_id"))
    rows = g.select("*", F.struct(*[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in MODEL_FEATURES]).alias("x"))
    flat = rows.select(F.struct(*g.columns).alias("g"), "x.*")
    flat = gbt_score(flat, model.gbt).select("g", "fraud_probability", *MODEL_FEATURES)
    flat = raw_anomaly(model.scale(flat), model.nodes, model.sample)
    value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), normalise(F.col("raw"), F.lit(model.raw_min), F.lit(model.raw_max))))
    return blend_score(flat.select("g.*", value.alias("anomaly_score"), "fraud_probability"))


def _score_table(scored: DataFrame, at) -> DataFrame:
    when = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return scored.withColumn("scored_at", when).select(*SCORE_COLUMNS)


def ml_risk_scores(g: DataFrame, model: RiskModel, at=None) -> DataFrame:
    """The full score table with typologies."""
    return _score_table(typology_label(score_rows(g, model)), at)


def unscored_transactions(g: DataFrame, m: DataFrame) -> DataFrame:
    return g.join(m.select("txn_id"), "txn_id", "left_anti")


def score_new(g: DataFrame, m: DataFrame, model: RiskModel, at=None, mode: str = "train") -> DataFrame:
    """Scores for rows that have none yet; their label is unknown."""
    scored = score_rows(unscored_transactions(g, m), model, mode)
    return _score_table(scored.withColumns({
        "fraud_type": coarse_type(F.col("final_risk_score")), "is_fraud": F.lit(None).cast("int")}), at)
