"""Models as tables against the fitted models themselves."""

import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import models, trees

NUMBERS = ["rainfall_previous_5m", "rainfall_previous_30m", "rainfall_previous_60m", "threshold_mm"]


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(2)
    items = []
    for i in range(900):
        sid, wet = rnd.choice(["hot"] * 6 + ["b", "c", "d"]), rnd.choice([0.0, 0.0, rnd.random() * 9])
        items.append((i, sid, rnd.randrange(5), rnd.randrange(1, 4), wet, wet * 1.5, wet * 2 + rnd.random(), rnd.choice([0.0, 1.0, 5.0]), float(rnd.random() < 0.2 + wet / 12)))
    return spark.createDataFrame(items, "id int, station_id string, hour int, month int, rainfall_previous_5m double, rainfall_previous_30m double, "
                                        "rainfall_previous_60m double, threshold_mm double, label double").repartition(4).persist()


def test_long_encoding_is_the_one_hot_vector(rows):
    train, strange = rows.where("id < 600 and station_id != 'd'"), rows.withColumn("hour", F.when(F.col("id") % 7 == 0, 99).otherwise(F.col("hour")))
    encoder = models.fit_onehot(train)
    positions = trees.category_positions(train, models.CATEGORIES)
    long = trees.encoded_long(strange, positions, models.CATEGORIES, NUMBERS, ["id"])
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, trees.long_form(encoder.transform(strange), ["id"]).collect()))
    own = trees.encoded_long(train, positions, models.CATEGORIES, NUMBERS, ["id"])
    got = {r.feature: r.variance for r in trees.long_variances(own, train).collect()}
    want = {r.feature: r.variance for r in models.feature_variances(encoder.transform(train)).collect()}
    assert all(got.get(f, 0.0) == pytest.approx(v, abs=1e-12) for f, v in want.items())


@pytest.mark.parametrize("boosted", [False, True])
def test_scores_by_joins_are_the_models(spark, rows, tmp_path, boosted):
    encoder, bins = models.ordinal_encoder(rows.where("station_id != 'd'"))
    coded = encoder.transform(rows)
    model = (models.boosted(5, 3, bins=bins) if boosted else models.forest(7, 4).setMaxBins(bins)).fit(coded)
    model.write().save(str(tmp_path / "m"))
    nodes = trees.node_table(spark, str(tmp_path / "m"), boosted).persist()
    assert nodes.where("groups is not null").count() > 0 and nodes.where("cut is not null").count() > 0
    leaves = trees.routed(coded, nodes, ["id"], model.getNumTrees, 3 if boosted else 4)
    both = trees.disagreement(models.score(model, coded, ["id", "p"]), trees.tree_scores(leaves, ["id"], boosted), ["id"], [])
    assert tuple(both.first()) == (900, 0)
    if boosted:
        assert {(r.tree, r.rows, r.differing_leaves) for r in trees.leaf_counts(leaves).collect()} == {(t, 900, 0) for t in range(5)}


def test_optimality_tells_a_least_point_from_another(rows):
    coded = models.fit_onehot(rows).transform(rows).select("features", "label", "threshold_mm").persist()
    caps = models.coefficient_caps(models.feature_variances(coded))

    def failures(reg, fitted_reg, steps):
        model = models.monotone_lr(caps, fitted_reg, steps).fit(coded)
        checked = trees.optimality(model, models.score(model, coded, ["features", "label", "p"]), caps, reg)
        assert checked.count() == len(caps) + 1
        return checked.where("not holds").count()

    assert failures(0.05, 0.05, 500) == 0
    assert failures(0.05, 0.5, 500) > 0 and failures(0.05, 0.05, 1) > 0


def test_threshold_steps_name_the_offending_pair(spark):
    from gaugeworks.operators.evaluate import threshold_steps

    df = spark.createDataFrame([("a", 1, t, p) for t, p in ((5.0, 0.2), (0.0, 0.6), (1.0, 0.7))] + [("b", 1, 0.0, 0.5)],
                               "station_id string, prediction_time int, threshold_mm double, p double")
    assert [(r.lower, r.higher) for r in threshold_steps(df).where("rise > 0").collect()] == [(0.0, 1.0)]
