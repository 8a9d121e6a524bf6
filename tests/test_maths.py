"""Percentiles, areas, neighbours, projection and polygons against plain recomputation."""

import json
import math

import numpy as np
import pytest
from compare import rows
from pyspark.sql import functions as F

from gaugeworks.functions.order import order_image
from gaugeworks.functions.projection import SVY21
from gaugeworks.operators import evaluate, ranking, spatial, summaries
from gaugeworks.spec import SeriesSpec

S = SeriesSpec()


def test_exact_percentiles_with_a_hot_group(spark):
    rng = np.random.default_rng(1)
    groups = {"hot": np.concatenate([np.full(4000, 3.25), rng.gamma(1.0, 9.0, 3000)]), "few": np.array([1.0, 2.0]),
              "one": np.array([7.5]), "minus": -rng.random(50) * 40}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("none", None), (None, 2.0), (None, 4.0)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}
    got = {r.g: r for r in ranking.exact_percentiles(df, ["g"], "v", probs, count="n").collect()}
    for g, vs in groups.items():
        assert got[g].n == len(vs)
        assert [got[g][n] for n in probs] == pytest.approx(list(np.quantile(vs, list(probs.values()))))
    assert got["none"].n == 0 and got["none"].c is None and got[None].c == 3.0


def test_exact_percentiles_whatever_the_range(spark):
    rng = np.random.default_rng(3)
    groups = {"wide": np.concatenate([rng.choice([-1, 1], 3000) * 10.0 ** rng.uniform(-300, 300, 3000), np.zeros(50)]),
              "next": 1.0 + np.arange(4000) * 2.0 ** -52, "tiny": np.arange(300) * 5e-324, "whole": rng.integers(0, 1 << 20, 2000).astype(float)}
    data = [(g, float(v), 1 + i % 3) for g, vs in groups.items() for i, v in enumerate(vs)] + [("ends", float("inf"), 2), ("ends", -float("inf"), 2)]
    df = spark.createDataFrame(data, "g string, v double, n long").repartition(7)
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.93, "e": 1.0}
    got = {r.g: r for r in ranking.exact_percentiles(df, ["g"], "v", probs, count="n", weight=F.col("n")).collect()}
    for g, vs in groups.items():
        every = np.sort(np.repeat(vs, 1 + np.arange(len(vs)) % 3))
        for name, p in probs.items():
            at = p * (len(every) - 1)
            low, high = every[math.floor(at)], every[math.ceil(at)]
            assert got[g][name] == (low if low == high else low + (high - low) * (at - math.floor(at)))
    assert (got["ends"].a, got["ends"].b, got["ends"].e) == (-float("inf"), -float("inf"), float("inf"))


def test_order_image_is_the_order_of_doubles(spark):
    rng = np.random.default_rng(4)
    bits = np.concatenate([rng.integers(0, 0x7FF0000000000000, 3000), [k << 52 for k in range(2047)], [(k << 52) - 1 for k in range(1, 2047)], range(4)])
    values = bits.astype(np.int64).view(np.float64)
    df = spark.createDataFrame([(float(v),) for v in np.concatenate([values, -values])], "v double")
    got = {r.v: r.i for r in df.select("v", order_image(F.col("v")).alias("i")).collect()}
    assert all(got[float(v)] == b and got[-float(v)] == -b for v, b in zip(values.tolist(), bits.tolist()))
    odd = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.7976931348623157e308,), (None,), (-float("inf"),)], "v double")
    a, b, c, d, e = [r[0] for r in odd.select(order_image(F.col("v"))).collect()]
    assert b > a > c and d is None and e == -a


def test_top_rows_per_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1)], "g string, v int")
    assert rows(ranking.top_rows(df, 2, [F.desc("v")], ["g"]), "g", "v") == [("a", 48), ("a", 49), ("b", 1)]


def plain_areas(y, p):
    pos, neg = p[y == 1], p[y == 0]
    roc = (np.sum(pos[:, None] > neg[None, :]) + 0.5 * np.sum(pos[:, None] == neg[None, :])) / (len(pos) * len(neg))
    points, last = [], None
    for cut in sorted(set(p), reverse=True):
        hit = p >= cut
        points.append((y[hit].sum() / y.sum(), y[hit].mean()))
    pr = 0.0
    last = (0.0, points[0][1])
    for q in points:
        pr += (q[0] - last[0]) * (q[1] + last[1]) / 2
        last = q
    return roc, pr


def test_areas_with_ties_and_a_hot_score(spark):
    rng = np.random.default_rng(2)
    p = np.concatenate([np.full(300, 0.001), rng.random(300) * 1e-6, np.round(rng.random(400), 2), [0.0, 1.0]])
    y = (rng.random(len(p)) < 0.2 + 0.5 * p).astype(float)
    data = [(1.0, float(a), float(b)) for a, b in zip(y, p)] + [(2.0, 1.0, 0.3)]
    df = spark.createDataFrame(data, "threshold_mm double, label double, p double")
    got = {r.threshold_mm: r for r in evaluate.auc_rank(df).collect()}
    assert (got[1.0].roc_auc, got[1.0].pr_auc) == pytest.approx(plain_areas(y, p))
    assert got[2.0].roc_auc is None and got[2.0].pr_auc is None
    binned = {r.threshold_mm: r for r in evaluate.auc_binned(df).collect()}
    assert binned[1.0].roc_auc == pytest.approx(got[1.0].roc_auc, abs=0.01)


def scored(spark):
    return spark.createDataFrame([(0.0, 0.0, 0.2), (0.0, 1.0, 0.8), (10.0, 0.0, 0.1)],
                                 "threshold_mm double, label double, p double")


def test_metrics_case(spark):
    got = {r.threshold_mm: r for r in evaluate.evaluate(scored(spark)).collect()}
    assert got[0.0].brier == pytest.approx(0.04) and got[0.0].roc_auc == 1.0 and got[10.0].roc_auc is None
    assert got[0.0].log_loss == pytest.approx(-math.log(0.8))
    assert evaluate.reliability(scored(spark)).agg(F.sum("n")).first()[0] == 3


def test_monotonicity_case(spark):
    df = spark.createDataFrame([("a", 1, t, p) for t, p in zip((0.0, 1.0, 5.0, 10.0), (0.6, 0.7, 0.2, 0.1))],
                               "station_id string, prediction_time int, threshold_mm double, p double")
    assert rows(evaluate.monotonicity(df)) == [(3, 1, pytest.approx(1 / 3))]


def test_confusion_from_bins_case(spark):
    bins = spark.createDataFrame([(0.0, 0, 4, 0.25), (0.0, 4, 1, 1.0), (0.0, 5, 2, 0.5), (0.0, 9, 1, 0.0)],
                                 "threshold_mm double, bin long, n long, observed_frequency double")
    metric = spark.createDataFrame([(0.0, 8, 3.0)], "threshold_mm double, n long, positives double")
    got = evaluate.confusion_from_bins(bins, metric).first()
    assert (got.true_positive, got.false_positive, got.false_negative, got.true_negative) == (1, 2, 2, 3)
    assert (got.precision, got.recall, got.f1, got.reconciles) == (*[pytest.approx(1 / 3)] * 3, True)
    wrong = spark.createDataFrame([(0.0, 9, 3.0)], "threshold_mm double, n long, positives double")
    assert not evaluate.confusion_from_bins(bins, wrong).first().reconciles


def test_no_predicted_positive_leaves_precision_undefined(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0.1), (0.0, 0.0, 0.2)], "threshold_mm double, label double, p double")
    got = evaluate.confusion(df).first()
    assert got.precision is None and got.recall == 0.0 and got.f1 == 0.0
    assert sorted(r["count"] for r in evaluate.confusion_cells(evaluate.confusion(df)).collect()) == [0, 0, 1, 1]


def test_histogram_total_and_exceedance_order(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(2020, float(v)) for v in np.round(rng.gamma(0.3, 4.0, 800), 1)], "year int, rainfall double")
    m = summaries.metrics(df, ["year"], S).first()
    hist = summaries.histogram(df, ["year"], S).collect()
    assert len(hist) == 10 and sum(r["count"] for r in hist) == m.rainy_intervals
    counts = [m[f"exceed_{t}_mm_intervals"] for t in ("0p0", "0p2", "1p0", "5p0", "10p0")]
    assert counts == sorted(counts, reverse=True)


# --- maps ---


def plain_nearest(targets, points, k):
    out = {}
    for t, x, y in targets:
        ranked = sorted((math.sqrt((x - px) ** 2 + (y - py) ** 2), i) for i, px, py, _ in points)
        out[t] = [i for _, i in ranked[:k]]
    return out


@pytest.mark.parametrize("shape", ["even", "cluster", "copies", "line", "single"])
def test_nearest_is_exact(spark, shape):
    rng = np.random.default_rng(7)
    if shape == "even":
        xy = rng.random((300, 2)) * 1000
    elif shape == "cluster":
        xy = np.vstack([rng.random((400, 2)) * 0.5 + 700, rng.random((20, 2)) * 1000])
    elif shape == "copies":
        xy = np.vstack([np.repeat([[10.0, 10.0]], 200, axis=0), rng.random((30, 2)) * 1000])
    elif shape == "line":
        xy = np.column_stack([np.linspace(0, 1000, 64), np.full(64, 5.0)])
    else:
        xy = np.array([[3.0, 4.0]])
    points = [(i, float(x), float(y), float(i)) for i, (x, y) in enumerate(xy)]
    targets = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.random((60, 2)) * 1400 - 200)]
    targets += [(1000 + i, points[i][1], points[i][2]) for i in range(min(5, len(points)))]
    p = spark.createDataFrame(points, "point_id int, x double, y double, value double")
    t = spark.createDataFrame(targets, "target_id int, x double, y double")
    got = {}
    for r in spatial.nearest(t, p, 8).orderBy("target_id", "distance", "point_id").collect():
        got.setdefault(r.target_id, []).append(r.point_id)
    assert got == plain_nearest(targets, points, 8)


def test_neighbours_in_a_very_crowded_spot(spark):
    """10 000 points in a millionth of the side: few pairs per target, wherever the target is."""
    rng = np.random.default_rng(8)
    xy = np.vstack([rng.random((10_000, 2)) * 1e-3 + [700.0, 300.0], rng.random((200, 2)) * 1000, np.repeat([[700.0, 300.0]], 500, axis=0)])
    points = [(i, float(x), float(y), 0.0) for i, (x, y) in enumerate(xy)]
    where = np.vstack([rng.random((30, 2)) * 1000, rng.random((30, 2)) * 1e-3 + [700.0, 300.0], [[700.0, 300.0], [1e6, 1e6]]])
    targets = [(i, float(x), float(y)) for i, (x, y) in enumerate(where)]
    p = spark.createDataFrame(points + [(-1, None, 3.0, 0.0), (-2, float("nan"), 3.0, 0.0)], "point_id int, x double, y double, value double").repartition(8)
    t = spark.createDataFrame(targets, "target_id int, x double, y double")
    sc = spark.sparkContext
    sc.setJobGroup("planning", "planning")
    index = spatial.point_index(p, 8).persist()
    found, pairs = spatial.nearest(t, p, 8, index=index), spatial.neighbour_pairs(t, index, 8)
    assert list(sc.statusTracker().getJobIdsForGroup("planning")) == []
    sc.setJobGroup("running", "running")
    got = {}
    for r in found.orderBy("target_id", "distance", "point_id").collect():
        got.setdefault(r.target_id, []).append(r.point_id)
    assert got == plain_nearest(targets, points, 8)
    sizes = [r["count"] for r in pairs.groupBy("target_id").count().collect()]
    assert len(sizes) == len(targets) and max(sizes) <= 1500 and np.mean(sizes) <= 500


def test_pairs_are_few_and_unplaced_targets_meet_the_first_ids(spark):
    """A box within reach gives its nearest points only; a target without a place is as far from one point as from another."""
    rng = np.random.default_rng(10)
    points = [(i, float(x), float(y), 0.0) for i, (x, y) in enumerate(rng.random((4000, 2)) * 1000)]
    targets = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.random((100, 2)) * 1000)]
    nan, inf = float("nan"), float("inf")
    odd = [(-1, None, None), (-2, None, 5.0), (-3, nan, 5.0), (-4, 5.0, -inf), (None, 500.0, 500.0), (None, 0.0, 0.0)]
    schema = "point_id int, x double, y double, value double"
    t = spark.createDataFrame(targets + odd, "target_id int, x double, y double")
    pairs = spatial.neighbour_pairs(t, spatial.point_index(spark.createDataFrame(points, schema), 8), 8)
    sizes = [r["count"] for r in pairs.where("target_id >= 0").groupBy("target_id").count().collect()]
    assert len(sizes) == len(targets) and np.mean(sizes) <= 80
    got = {}
    for r in spatial.nearest(t, spark.createDataFrame(points + [(-9, inf, 3.0, 0.0)], schema).repartition(4), 8).orderBy("target_id", "distance", "point_id").collect():
        got.setdefault(r.target_id, []).append((r.point_id, r.distance))
    assert {i: [n for n, _ in got[i]] for i, _, _ in targets} == plain_nearest(targets, points, 8)
    assert got[-1] == got[-2] == [(-9, None), *((i, None) for i in range(7))]
    assert [n for n, _ in got[-3]] == [-9, *range(7)] and all(math.isnan(d) for _, d in got[-3])
    assert [n for n, _ in got[-4]] == [-9, *range(7)] and all(d == inf for _, d in got[-4])
    both = [(math.sqrt((x - a) ** 2 + (x - b) ** 2), i) for i, a, b, _ in points for x in (500.0, 0.0)]
    assert [n for n, _ in got[None]] == [i for _, i in sorted(both)[:8]]


def test_nearest_without_points(spark):
    t = spark.createDataFrame([(1, 0.0, 0.0)], "target_id int, x double, y double")
    assert spatial.nearest(t, t.limit(0).withColumnRenamed("target_id", "point_id"), 3).collect() == []


def test_distributed_rank_with_hot_codes(spark):
    rng = np.random.default_rng(9)
    codes = np.concatenate([rng.integers(0, 1 << 62, 500), np.full(300, 7), rng.integers(0, 1 << 20, 300), [0, (1 << 62) - 1]])
    df = spark.createDataFrame([(i, int(c)) for i, c in enumerate(codes)], "id int, code long").repartition(5)
    got = {r.id: r.place for r in ranking.distributed_rank(df, "code", [F.desc("id")], 62, "place").collect()}
    order = sorted(range(len(codes)), key=lambda i: (codes[i], -i))
    assert got == {i: n for n, i in enumerate(order)}


def test_idw_exact_hit_and_mask(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0, 10.0), (2, 100.0, 0.0, 20.0)], "point_id int, x double, y double, value double")
    t = spark.createDataFrame([(1, 0.0, 0.0), (2, 50.0, 0.0), (3, 900.0, 0.0)], "target_id int, x double, y double")
    got = {r.target_id: r.estimate for r in spatial.idw(t, p, "value").collect()}
    assert got[1] == 10.0 and got[2] == pytest.approx(15.0)
    assert rows(spatial.distance_mask(t, p, 60.0).select("target_id"), "target_id") == [(1,), (2,)]
    assert spatial.distance_mask(t, p, 0.0) is t


def test_projection_origin_and_scale(spark):
    lat, lon = SVY21.latitude_origin, SVY21.longitude_origin
    df = spark.createDataFrame([(lat, lon), (lat + 0.001, lon), (lat, lon + 0.001)], "latitude double, longitude double")
    got = [(r.x, r.y) for r in spatial.project_tm(df).collect()]
    assert got[0] == pytest.approx((28_001.642, 38_744.572), abs=1e-6)
    e2 = 2 / SVY21.inverse_flattening - 1 / SVY21.inverse_flattening ** 2
    sine = math.sin(math.radians(lat))
    meridian = SVY21.semi_major * (1 - e2) / (1 - e2 * sine ** 2) ** 1.5
    normal = SVY21.semi_major / math.sqrt(1 - e2 * sine ** 2)
    assert got[1][1] - got[0][1] == pytest.approx(meridian * math.radians(0.001), rel=1e-5)
    assert got[2][0] - got[0][0] == pytest.approx(normal * math.cos(math.radians(lat)) * math.radians(0.001), rel=1e-5)


def test_raster_covers_the_padded_bounds(spark):
    pts = spark.createDataFrame([(0.0, 0.0), (1000.0, 300.0)], "x double, y double")
    cells = spatial.raster(spatial.bounds_of(pts), 100, pad=10.0)
    edge = cells.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.count("*")).first()
    assert tuple(edge) == (pytest.approx(-10), pytest.approx(1010), pytest.approx(-10), pytest.approx(310), 100 * 90)


def test_boundary_file_and_cover(spark, tmp_path):
    square = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]]
    hole = [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0], [4.0, 4.0]]
    other = [[20.0, 0.0], [30.0, 0.0], [25.0, 9.0], [20.0, 0.0]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[square, hole], [other]]}}]}
    path = tmp_path / "boundary.geojson"
    path.write_text(json.dumps(doc))
    edges = spatial.boundary_edges(spark, str(path))
    assert edges.count() == 11 and edges.select("polygon", "ring").distinct().count() == 3
    places = {1: (1.0, 1.0), 2: (5.0, 5.0), 3: (0.0, 5.0), 4: (10.0, 10.0), 5: (25.0, 3.0), 6: (15.0, 5.0), 7: (-1.0, 5.0), 8: (5.0, 0.0)}
    pts = spark.createDataFrame([(i, *p) for i, p in places.items()], "point_id int, x double, y double")
    for band in (0.7, 5.0, 100.0):
        assert rows(spatial.inside(pts, edges, band).select("point_id"), "point_id") == [(1,), (3,), (4,), (5,), (8,)]


@pytest.mark.parametrize("indent", [None, 1])
def test_one_document_is_read_by_many_tasks(spark, tmp_path, indent):
    rng = np.random.default_rng(10)
    features = []
    for i in range(300):
        shape = [[[float(x), float(y)] for x, y in rng.random((4, 2))] for _ in range(2)]
        geometry = {"type": "Polygon", "coordinates": shape} if i % 3 else {"coordinates": [shape, shape[:1]], "type": "MultiPolygon"}
        parts = {"type": "Feature", "properties": {"name": "a {x}" if i % 2 else 'a "Feature" b', "id": i}, "geometry": geometry}
        features.append({k: parts[k] for k in (("geometry", "properties", "type") if i % 5 == 0 else parts)})
    (tmp_path / "all.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=indent))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({"id": i, **f}) for i, f in enumerate(features)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        whole = spatial.boundary_edges(spark, str(tmp_path / "all.geojson"))
        assert spatial._collected_features(spark, str(tmp_path / "all.geojson")).select("feature").distinct().count() == 300
        assert spark.read.option("lineSep", '"Feature"').text(str(tmp_path / "all.geojson")).rdd.getNumPartitions() > 3
        lines = spatial.boundary_edges(spark, str(tmp_path / "lines.json"), one_document=False)
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, lines.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
