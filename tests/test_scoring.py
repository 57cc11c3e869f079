"""The models: planted signals are found, scoring equals a plain walk of the trees, runs repeat."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnwatch.fixed import MODEL_FEATURES
from txnwatch.operators import boosting, flags, scoring
from txnwatch.plans.tables import tables
from txnwatch.session import scratch_path


@pytest.fixture(scope="module")
def planted(spark):
    """2000 ordinary rows and 10 far ones; the far ones are the frauds, and so are large amounts."""
    rng = np.random.default_rng(3)
    points = rng.normal(size=(2010, len(MODEL_FEATURES)))
    points[:10] += 12
    label = (points[:, 0] > 0.5).astype(int)
    rows = [(f"T{i:05d}", int(y), *map(float, p)) for i, (p, y) in enumerate(zip(points, label))]
    return spark.createDataFrame(rows, "txn_id string, is_fraud int, " + ", ".join(f"{n} double" for n in MODEL_FEATURES))


def test_forest_finds_what_is_far(planted):
    nodes = scoring.anomaly_fit(planted, trees=60, sample=128)
    scored = scoring.anomaly_score(planted, nodes, 128).orderBy(F.desc("anomaly_score")).limit(10)
    assert {r["txn_id"] for r in scored.collect()} == {f"T{i:05d}" for i in range(10)}


def test_forest_size_does_not_grow_with_the_table(planted):
    nodes = scoring.anomaly_fit(planted, trees=20, sample=64)
    assert nodes.select("tree").distinct().count() == 20
    assert nodes.agg(F.max("node")).first()[0] < 2 ** (6 + 1) - 1


def test_forest_is_the_same_on_every_run(planted):
    once, twice = (sorted(map(tuple, scoring.anomaly_fit(df, trees=10).collect()))
                   for df in (planted, planted.repartition(7)))
    assert once == twice


def test_scores_equal_a_walk_of_each_tree(planted):
    nodes = scoring.anomaly_fit(planted, trees=15, sample=64)
    trees = {}
    for r in nodes.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = r
    some = planted.limit(25)
    for row in scoring.raw_anomaly(some, nodes, 64).collect():
        depths = []
        for tree in trees.values():
            at = 0
            while tree[at]["feature"] >= 0:
                right = row[MODEL_FEATURES[tree[at]["feature"]]] > tree[at]["threshold"]
                at = 2 * at + 1 + int(right)
            depths.append(tree[at]["value"])
        assert row["raw"] == pytest.approx(2 ** (-np.mean(depths) / scoring._average_path(64)))


def test_boosting_learns_the_label(planted):
    part = scoring.is_holdout(F.col("txn_id"))
    model = scoring.gbt_fit(planted.filter(~part), rounds=10)
    assert scoring.eval_auc(scoring.gbt_score(planted.filter(part), model)).first()["auc"] > 0.95


def test_holdout_is_a_quarter_of_each_class(planted):
    shares = planted.groupBy("is_fraud").agg(F.avg(scoring.is_holdout(F.col("txn_id")).cast("int")).alias("share"))
    assert all(0.2 < r["share"] < 0.3 for r in shares.collect())


def test_constant_feature_scales_to_zero(planted):
    scaled = scoring.standard_scale(planted.withColumn("is_cash", F.lit(3.0)))
    assert scaled.agg(F.max(F.abs("is_cash"))).first()[0] == 0.0


def test_stored_model_scores_alike_and_batches_do_not_matter(spark, sf_dir):
    t = tables(spark, sf_dir)
    path = scratch_path(spark, "model")
    scoring.model_save(t.model, path)
    whole = scoring.score_rows(t.gold, t.model).select("txn_id", F.col("final_risk_score").alias("a"))
    few = scoring.score_rows(t.gold.orderBy("txn_id").limit(7), scoring.model_load(spark, path))
    joined = few.select("txn_id", "final_risk_score").join(whole, "txn_id")
    assert joined.count() == 7 and joined.filter("abs(a - final_risk_score) > 1e-9").count() == 0


def test_one_row_batch_is_half_anomalous(spark, sf_dir):
    t = tables(spark, sf_dir)
    one = scoring.score_rows(t.gold.orderBy("txn_id").limit(1), t.model, mode="batch").first()
    assert one["anomaly_score"] == 0.5


def test_flags_are_raised_once(spark, sf_dir):
    t = tables(spark, sf_dir)
    first = flags.ml_flags(t.scores)
    assert first.count() > 0 and flags.ml_flags(t.scores, first).count() == 0
    circles = flags.circular_flags(t.silver)
    assert circles.count() > 0 and flags.circular_flags(t.silver, circles).count() == 0
    ids = circles.select("flag_id")
    assert ids.distinct().count() == ids.count()


def test_boosting_gives_the_trees_of_spark_ml(planted):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    noisy = planted.withColumn("is_fraud", F.when(F.xxhash64("txn_id") % 9 == 0, 1 - F.col("is_fraud")).otherwise(F.col("is_fraud")))
    mixed = noisy.withColumn("is_cash", (F.col("is_cash") > 0).cast("double")).withColumn("country_risk", F.lit(1.0))
    mine = scoring.gbt_fit(mixed, rounds=25)
    vectors = VectorAssembler(inputCols=MODEL_FEATURES, outputCol="features").transform(mixed)
    theirs = GBTClassifier(labelCol="is_fraud", maxIter=25, maxDepth=3, stepSize=0.08, seed=42).fit(vectors)
    assert mine.node_counts() == [t.numNodes for t in theirs.trees] and list(mine.weights) == theirs.treeWeights
    both = scoring.gbt_score(theirs.transform(vectors), mine).select("fraud_probability", vector_to_array("probability")[1].alias("p"))
    assert both.count() == 2010 and both.filter("abs(fraud_probability - p) > 1e-9").count() == 0


def test_rows_to_fit_on_take_a_byte_an_input(planted):
    """Passes read blocks of whole rows, one byte for each input and one for the label, whatever the values are."""
    inputs = [F.col(n) * 1e9 for n in MODEL_FEATURES]
    rows = planted.select(*[c.alias(n) for c, n in zip(inputs, MODEL_FEATURES)], F.col("is_fraud").cast("double").alias("y"))
    blocks = boosting.binned(rows.coalesce(1), MODEL_FEATURES, "y", boosting.bin_bounds(rows, MODEL_FEATURES, 1)).collect()
    assert sum(len(b["codes"]) + len(b["label"]) for b in blocks) == 2010 * (len(MODEL_FEATURES) + 1)
    assert len(blocks) == 1


def test_margins_start_again_from_the_stored_rows(planted, monkeypatch):
    whole = scoring.gbt_fit(planted, rounds=7)
    monkeypatch.setattr(boosting, "RESTART", 2)
    again = scoring.gbt_fit(planted, rounds=7)
    assert (whole.feature == again.feature).all() and np.allclose(whole.value, again.value)


def test_trees_that_end_early_are_walked_to_their_value():
    feature = np.array([[1, -1, 0, 0, 0, -1, -1]])
    threshold, value = np.array([[0.5, 0, 2.0, 9, 9, 0, 0]]), np.array([[9.0, 1.0, 9.0, 9, 9, 2.0, 3.0]])
    points = np.array([[5.0, 0.5], [2.0, 0.6], [2.1, 0.6], [np.inf, np.inf], [np.nan, -np.inf]])
    trees = boosting.padded(feature, threshold, value)
    assert boosting.tree_sums(points, trees, np.array([2.0]), chunk=2).tolist() == [2.0, 4.0, 6.0, 6.0, 2.0]
    assert boosting.BoostedTrees(feature, threshold, value, np.ones(1)).node_counts() == [5]


def test_boosting_refuses_what_it_cannot_learn_from(planted):
    for rows, said in ((planted.limit(0), "no rows"), (planted.withColumn("amount", F.lit(float("nan"))), "NaN"),
                       (planted.withColumn("is_fraud", F.lit(2)), "0 or 1")):
        with pytest.raises(Exception, match=said):
            scoring.gbt_fit(rows, rounds=1)


def test_many_levels_walked_at_once_equal_a_walk_node_by_node():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, boosting.BINS, (6, 500)).astype(np.uint8)
    for depth in (1, 3, 5):
        size = (2 << depth) - 1
        feature, cut = rng.integers(-1, 6, size), rng.integers(0, boosting.BINS - 1, size)
        feature[size // 2:] = -1
        for levels in range(depth + 1):
            found = boosting._walker(feature, cut, levels, lambda node, ended: -node - 1 if ended else node)(codes)
            for row, got in enumerate(found):
                at, more = 0, levels
                while more and feature[at] >= 0:
                    at, more = 2 * at + 1 + int(codes[feature[at], row] > cut[at]), more - 1
                assert got == (-at - 1 if more else at)


def test_margins_are_the_same_however_often_they_are_stored(planted, monkeypatch):
    models = []
    for keep in (1, 4, 20):
        monkeypatch.setattr(boosting, "KEEP", keep)
        models.append(scoring.gbt_fit(planted, rounds=7))
    for other in models[1:]:
        assert np.array_equal(models[0].value, other.value) and np.array_equal(models[0].threshold, other.threshold)
