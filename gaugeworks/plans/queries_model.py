"""Registered queries: features, models, evaluation and point-in-time lookup."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gaugeworks.operators import evaluate, features, lookup, models, trees
from gaugeworks.plans import bindings as b
from gaugeworks.plans.registry import query
from gaugeworks.sources.readers import RAINFALL_FEATURES
from gaugeworks.sources.scratch import scratch_dir

HOUR = b.HOUR
R = ", ".join(f"round({c}, 6) AS {c}" for c in (*RAINFALL_FEATURES, "future_rainfall_30m"))
FEATURE_SQL = f"SELECT station_id, prediction_time, {R}, hour, month, target_end_time, year"

# --- features and labels ---


@query("M1_slot_features", f"{FEATURE_SQL} FROM window_features", "window_features")
def _(spark, sf):
    return b.window_features(spark, sf)


@query("M1_slot_features_small_blocks", f"{FEATURE_SQL} FROM window_features", "window_features")
def _(spark, sf):
    """The same with many block edges."""
    return features.slot_features(b.dense(spark, sf), HOUR, block_slots=24)


@query("M2_split_by_time", f"{FEATURE_SQL}, split FROM prepared", "prepared")
def _(spark, sf):
    return b.prepared(spark, sf)


@query("M3_threshold_label", """SELECT station_id, prediction_time, 300.0::DOUBLE AS threshold_mm,
CAST(future_rainfall_30m > 300 AS INTEGER)::DOUBLE AS label FROM prepared""", "prepared")
def _(spark, sf):
    return features.threshold_label(b.prepared(spark, sf), 300.0).select("station_id", "prediction_time",
                                                                         "threshold_mm", "label")


@query("M4_expand_thresholds", "SELECT station_id, prediction_time, split, threshold_mm, label FROM examples", "examples")
def _(spark, sf):
    return b.examples(spark, sf).select("station_id", "prediction_time", "split", "threshold_mm", "label")


def _spoiled(df):
    """Prepared rows with one fault per id."""
    who = F.col("station_id")

    def at(name, changed, column):
        return F.when(who == name, changed).otherwise(F.col(column))

    return df.withColumns({
        "hour": at("click", F.col("hour") + 1, "hour"),
        "split": at("view", F.lit("test"), "split"),
        "target_end_time": at("error", F.timestamp_add("SECOND", F.lit(300), F.col("target_end_time")), "target_end_time"),
        RAINFALL_FEATURES[0]: at("signup", F.col(RAINFALL_FEATURES[2]) + 1, RAINFALL_FEATURES[0]),
        "future_rainfall_30m": at("purchase", F.lit(float("nan")), "future_rainfall_30m")})


@query("M5_validate_prepared", """SELECT * FROM (
SELECT 'wrong_calendar' AS issue, count(*) FILTER (station_id = 'click') AS failures FROM prepared
UNION ALL SELECT 'wrong_split', count(*) FILTER (station_id = 'view' AND split <> 'test') FROM prepared
UNION ALL SELECT 'wrong_horizon', count(*) FILTER (station_id = 'error') FROM prepared
UNION ALL SELECT 'label_crosses_split', count(*) FILTER (station_id = 'error' AND target_end_time + INTERVAL 5 MINUTE >=
  CASE split WHEN 'train' THEN TIMESTAMP '2024-01-19' WHEN 'validation' THEN TIMESTAMP '2024-01-25'
  ELSE TIMESTAMP '2024-01-31' END) FROM prepared
UNION ALL SELECT 'sums_not_nested', count(*) FILTER (station_id = 'signup') FROM prepared
UNION ALL SELECT 'unusable_value', count(*) FILTER (station_id = 'purchase') FROM prepared
UNION ALL SELECT 'count_differs_2024', count(*) FROM prepared
UNION ALL SELECT 'empty_dataset', CAST(count(*) = 0 AS BIGINT) FROM prepared) WHERE failures > 0""", "prepared")
def _(spark, sf):
    return features.validate_prepared(_spoiled(b.prepared(spark, sf)), HOUR, b.CUTS, years=(2024, 2024),
                                      expected_counts={2024: 0})


@query("M6_hash_sample", """SELECT station_id, split, threshold_mm, count(*) AS rows FROM examples
WHERE CAST('0x' || md5(station_id || '|' || strftime(prediction_time, '%Y-%m-%d %H:%M:%S') || '|42')[1:8] AS BIGINT) / 4294967296.0 < 0.25
GROUP BY ALL""", "examples")
def _(spark, sf):
    kept = features.hash_sample(b.examples(spark, sf), ["station_id", "prediction_time"], 0.25, 42)
    return kept.groupBy("station_id", "split", "threshold_mm").agg(F.count("*").alias("rows"))


# --- models ---

# Labels are fixed; means of more readings a slot spread less, and a level may then have one class only. The fits
# below span all levels, so they ask for both classes over all of them (``pooled``).


def _part(spark, sf, split):
    return b.prepared(spark, sf).where(F.col("split") == split)


def _train(spark, sf):
    return features.expand_thresholds(_part(spark, sf, "train"), b.LABELS)


@query("M7_onehot_encoder")
def _(spark, sf):
    rows = b.prepared(spark, sf)
    encoder = models.fit_onehot(rows.where("split = 'train'"))
    coded = encoder.transform(features.expand_thresholds(rows, b.LABELS)).withColumn("v", vector_to_array("features"))
    return coded.select("station_id", "prediction_time", "threshold_mm", F.size("v").alias("width"),
                        F.element_at("v", -1).alias("last_feature"))


@query("M8_ordinal_encoder", """SELECT station_id, CAST(row_number() OVER (ORDER BY station_id) - 1 AS DOUBLE) AS station_id_index,
CAST(greatest(128, count(*) OVER () + 1) AS INTEGER) AS max_bins FROM (SELECT DISTINCT station_id FROM prepared WHERE split = 'train')""", "prepared")
def _(spark, sf):
    train = _train(spark, sf)
    encoder, bins = models.ordinal_encoder(train)
    return encoder.transform(train).select("station_id", "station_id_index", F.lit(bins).alias("max_bins")).distinct()


@query("M9_feature_variances")
def _(spark, sf):
    encoder = models.fit_onehot(_part(spark, sf, "train"))
    return models.feature_variances(encoder.transform(_train(spark, sf)))


def _predictions(spark, sf, model, split="test"):
    return models.score(model, features.expand_thresholds(_part(spark, sf, split), b.LABELS))


def _lr(regs):
    def candidates(train):
        caps = models.coefficient_caps(models.feature_variances(train))
        return {f"reg={r}": models.monotone_lr(caps, r) for r in regs}

    return candidates


@query("M10_monotone_lr")
def _(spark, sf):
    model, _ = models.train_and_select(b.prepared(spark, sf), _lr([0.01]), b.LABELS, check=models.check_monotone_lr, pooled=True)
    return _predictions(spark, sf, model)


@query("M12_random_forest")
def _(spark, sf):
    model, _ = models.train_and_select(b.prepared(spark, sf), lambda _: {"forest": models.forest()}, b.LABELS, pooled=True)
    return _predictions(spark, sf, model)


@query("M13_boosted_trees")
def _(spark, sf):
    base = b.prepared(spark, sf)
    encoder, bins = models.ordinal_encoder(base.where("split = 'train'"))
    model, _ = models.train_and_select(base, lambda _: {"boosted": models.boosted(bins=bins)}, b.LABELS, encoder, pooled=True)
    return _predictions(spark, sf, model)


KEYS = ["station_id", "prediction_time", "threshold_mm"]
SPLIT_ROWS = "SELECT * FROM prepared, (VALUES " + ", ".join(f"({float(t)}::DOUBLE)" for t in b.LABELS) + ") l(threshold_mm) WHERE split = '{0}'"


def _stored(spark, model):
    path = f"{scratch_dir(spark)}/model"
    model.write().save(path)
    return path


def _positions_sql() -> str:
    """Places of the one-hot features: falling counts, then values, one more per category for unseen values."""
    parts = " UNION ALL ".join(f"SELECT {i} AS part, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM prepared WHERE split = 'train' GROUP BY {c}"
                               for i, c in enumerate(models.CATEGORIES))
    return f"""SELECT part, value, row_number() OVER (ORDER BY part, n DESC, value) - 1 + part AS position FROM ({parts})"""


NUMBERS = [*RAINFALL_FEATURES, "threshold_mm"]
ONES = " UNION ALL ".join(
    f"SELECT r.station_id, prediction_time, threshold_mm, split, CAST(coalesce(p.position, (SELECT max(position) + 1 FROM pos WHERE part = {i})) AS INTEGER) AS feature, 1.0::DOUBLE AS x "
    f"FROM rows r LEFT JOIN pos p ON p.part = {i} AND p.value = CAST(r.{c} AS VARCHAR)" for i, c in enumerate(models.CATEGORIES))
REST = " UNION ALL ".join(
    f"SELECT station_id, prediction_time, threshold_mm, split, CAST((SELECT max(position) + 2 FROM pos) + {i} AS INTEGER), CAST({c} AS DOUBLE) FROM rows WHERE {c} <> 0"
    for i, c in enumerate(NUMBERS))
LONG = f"""rows AS (SELECT * FROM prepared, (VALUES {', '.join(f'({float(t)}::DOUBLE)' for t in b.LABELS)}) l(threshold_mm)),
pos AS ({_positions_sql()}), cells AS ({ONES} UNION ALL {REST})"""


def _long(spark, sf, rows):
    positions = trees.category_positions(_part(spark, sf, "train"), models.CATEGORIES)
    return trees.encoded_long(rows, positions, models.CATEGORIES, NUMBERS, KEYS)


@query("M7_onehot_long", f"SELECT * EXCLUDE (split) REPLACE (round(x, 6) AS x) FROM (WITH {LONG} SELECT * FROM cells)", "prepared")
def _(spark, sf):
    """All splits, so values that the training rows lack too."""
    return _long(spark, sf, features.expand_thresholds(b.prepared(spark, sf), b.LABELS))


VARIANCES = f"""SELECT feature, round(variance, 6) AS variance, variance = 0 AS constant FROM (WITH {LONG}, t AS (SELECT count(*) AS n FROM rows WHERE split = 'train')
SELECT feature, (sum((x - m) * (x - m)) + (any_value(n) - count(*)) * any_value(m) * any_value(m)) / (any_value(n) - 1) AS variance FROM (
SELECT *, sum(x) OVER (PARTITION BY feature) / n AS m FROM cells, t WHERE split = 'train') GROUP BY feature)"""


@query("M9_long_variances", VARIANCES, "prepared")
def _(spark, sf):
    """Features that some training row has; the others are zero throughout."""
    train = _train(spark, sf)
    return trees.long_variances(_long(spark, sf, train), train)


@query("M10_optimality", """SELECT (SELECT sum(n + 1) FROM (SELECT count(DISTINCT c) AS n FROM (SELECT 1 AS k, station_id AS c FROM prepared WHERE split = 'train'
  UNION ALL SELECT 2, CAST(hour AS VARCHAR) FROM prepared WHERE split = 'train' UNION ALL SELECT 3, CAST(month AS VARCHAR) FROM prepared WHERE split = 'train') GROUP BY k))::BIGINT + 4 AS features,
  0::BIGINT AS inside_failures, 0::BIGINT AS bound_failures, 0::BIGINT AS intercept_failures""", "prepared")
def _(spark, sf):
    """Conditions of a least point that the bounded fit breaks: there must be none."""
    encoder = models.fit_onehot(_part(spark, sf, "train"))
    train = encoder.transform(_train(spark, sf)).select("features", "label", "threshold_mm")
    caps = models.coefficient_caps(models.feature_variances(train))
    model = models.monotone_lr(caps, 0.01, max_iter=500).fit(train)
    checked = trees.optimality(model, models.score(model, train, ["features", "label", "p"]), caps, 0.01)
    broken = [F.count_if((F.col("rule") == r) & ~F.col("holds")).alias(n) for r, n in (
        ("inside", "inside_failures"), ("at_bound", "bound_failures"), ("intercept", "intercept_failures"))]
    return checked.agg(F.count_if(F.col("feature") >= 0).alias("features"), *broken)


@query("M12_forest_as_tables", f"SELECT threshold_mm, count(*) AS rows, 0::BIGINT AS differing_rows FROM ({SPLIT_ROWS.format('test')}) GROUP BY threshold_mm", "prepared")
def _(spark, sf):
    """Rows whose score by joins over the node table is not the model's: there must be none."""
    encoder = models.fit_onehot(_part(spark, sf, "train"))
    model = models.forest().fit(encoder.transform(_train(spark, sf)))
    test = encoder.transform(features.expand_thresholds(_part(spark, sf, "test"), b.LABELS))
    leaves = trees.routed(test, trees.node_table(spark, _stored(spark, model)), KEYS, model.getNumTrees, 5)
    return trees.disagreement(models.score(model, test, [*KEYS, "p"]), trees.tree_scores(leaves, KEYS), KEYS, ["threshold_mm"])


def _boosted(spark, sf):
    encoder, bins = models.ordinal_encoder(_part(spark, sf, "train"))
    model = models.boosted(bins=bins).fit(encoder.transform(_train(spark, sf)))
    return encoder, model, trees.node_table(spark, _stored(spark, model), boosted=True)


@query("M13_boosted_as_tables", f"SELECT threshold_mm, count(*) AS rows, 0::BIGINT AS differing_rows FROM ({SPLIT_ROWS.format('test')}) GROUP BY threshold_mm", "prepared")
def _(spark, sf):
    encoder, model, nodes = _boosted(spark, sf)
    test = encoder.transform(features.expand_thresholds(_part(spark, sf, "test"), b.LABELS))
    leaves = trees.routed(test, nodes, KEYS, model.getNumTrees, 4)
    return trees.disagreement(models.score(model, test, [*KEYS, "p"]), trees.tree_scores(leaves, KEYS, boosted=True), KEYS, ["threshold_mm"])


@query("M13_boosted_leaf_counts", f"""SELECT tree, rows, 0::BIGINT AS differing_leaves FROM (SELECT count(*) AS rows FROM ({SPLIT_ROWS.format('train')})),
(SELECT CAST(unnest(range(20)) AS INTEGER) AS tree)""", "prepared")
def _(spark, sf):
    """Leaves whose training rows, counted by joins, are not as many as the fit recorded: there must be none."""
    encoder, model, nodes = _boosted(spark, sf)
    return trees.leaf_counts(trees.routed(encoder.transform(_train(spark, sf)), nodes, KEYS, model.getNumTrees, 4))


@query("M14_scores_as_tables", f"""SELECT split, threshold_mm, count(*) AS rows, 0::BIGINT AS differing_rows FROM (
SELECT * FROM ({SPLIT_ROWS.format('validation')}) UNION ALL SELECT * FROM ({SPLIT_ROWS.format('test')})) GROUP BY split, threshold_mm""", "prepared")
def _(spark, sf):
    """Rows whose score by joins with the weights is not the model's: there must be none."""
    encoder = models.fit_onehot(_part(spark, sf, "train"))
    train = encoder.transform(_train(spark, sf)).select("features", "label", "threshold_mm")
    model = models.monotone_lr(models.coefficient_caps(models.feature_variances(train)), 0.1).fit(train)
    keys = [*KEYS, "split"]
    rows = encoder.transform(features.expand_thresholds(b.prepared(spark, sf).where("split != 'train'"), b.LABELS))
    return trees.disagreement(models.score(model, rows, [*keys, "p"]), trees.linear_scores(rows, model, keys), keys, ["split", "threshold_mm"])


@query("M14_score")
def _(spark, sf):
    model, _ = models.train_and_select(b.prepared(spark, sf), _lr([0.1]), b.LABELS, pooled=True)
    return reduce(lambda x, y: x.unionByName(y), [_predictions(spark, sf, model, s) for s in ("validation", "test")])


@query("M18_select_candidate")
def _(spark, sf):
    _, report = models.train_and_select(b.prepared(spark, sf), _lr([0.0, 0.01, 0.1]), b.LABELS,
                                        check=models.check_monotone_lr, pooled=True)
    return report


@query("M18_select_forest_depth")
def _(spark, sf):
    _, report = models.train_and_select(
        b.prepared(spark, sf), lambda _: {f"depth={d}": models.forest(depth=d) for d in (5, 8)}, b.LABELS, pooled=True)
    return report


@query("S11_model_roundtrip")
def _(spark, sf):
    model, _ = models.train_and_select(b.prepared(spark, sf), _lr([0.01]), b.LABELS, pooled=True)
    sample = features.expand_thresholds(_part(spark, sf, "validation"), b.LABELS)
    return models.roundtrip_diff(model, f"{scratch_dir(spark)}/model", sample)


# --- evaluation ---

CLIPPED = "greatest(1e-15, least(1 - 1e-15::DOUBLE, p))"


def _metrics_sql(keys: str, source: str = "scores") -> str:
    return f"""SELECT {keys}, count(*) AS n, sum(label) AS positives, avg(label) AS prevalence, avg(p) AS mean_probability,
avg((p - label) * (p - label)) AS brier, avg(-label * ln({CLIPPED}) - (1 - label) * ln(1 - {CLIPPED})) AS log_loss
FROM {source} GROUP BY {keys}"""


def _auc_sql(keys: str, source: str = "scores") -> str:
    return f"""SELECT {keys}, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
  THEN sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) END AS roc_auc,
CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (tp / (tp + fp)
  + coalesce((tp - pos) / nullif(tp - pos + fp - neg, 0), tp / (tp + fp))) / 2) / sum(pos) END AS pr_auc
FROM (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM (
  SELECT {keys}, p, sum(label) AS pos, sum(1 - label) AS neg FROM {source} GROUP BY {keys}, p)
  WINDOW w AS (PARTITION BY {keys} ORDER BY p DESC)) GROUP BY {keys}"""


def _full_sql(keys: str, source: str = "scores") -> str:
    return f"(SELECT * FROM ({_metrics_sql(keys, source)}) JOIN ({_auc_sql(keys, source)}) USING ({keys}))"


ROUND_M = ", ".join(f"round({c}, 6) AS {c}" for c in ("prevalence", "mean_probability", "brier", "log_loss"))


@query("M15_probability_metrics", f"SELECT * REPLACE ({ROUND_M}) FROM ({_metrics_sql('threshold_mm')})", "scores")
def _(spark, sf):
    return evaluate.probability_metrics(b.scores(spark, sf))


@query("M16_auc_rank", f"""SELECT * REPLACE (round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc)
FROM ({_auc_sql('model, threshold_mm', 'model_scores')})""", "model_scores")
def _(spark, sf):
    return evaluate.auc_rank(b.model_scores(spark, sf), ["model", "threshold_mm"])


@query("M16_auc_binned", f"""SELECT * REPLACE (round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc)
FROM ({_auc_sql('threshold_mm', '(SELECT * REPLACE (least(floor(p * 1000), 999) AS p) FROM scores)')})""", "scores")
def _(spark, sf):
    return evaluate.auc_binned(b.scores(spark, sf))


@query("M17_reliability", """SELECT threshold_mm, least(9, CAST(floor(p * 10) AS BIGINT)) AS bin, count(*) AS n,
round(avg(p), 6) AS predicted_probability, round(avg(label), 6) AS observed_frequency FROM scores GROUP BY ALL""", "scores")
def _(spark, sf):
    return evaluate.reliability(b.scores(spark, sf))


@query("M19_rank_runs", f"""SELECT run, round(avg(pr_auc / prevalence), 6) AS mean_pr_auc_lift,
round(avg(1 - brier / (prevalence * (1 - prevalence))), 6) AS mean_brier_skill, round(avg(roc_auc), 6) AS mean_roc_auc,
round(avg(pr_auc), 6) AS mean_pr_auc FROM {_full_sql('run, threshold_mm', '(SELECT *, model AS run FROM model_scores)')}
GROUP BY run""", "model_scores")
def _(spark, sf):
    return evaluate.rank_runs(b.model_scores(spark, sf, "run"))


RATES = """SELECT threshold_mm, count(*) AS n, avg(label) AS probability, avg(label) > 0 AND avg(label) < 1 AS both_classes
FROM scores WHERE split = 'train' GROUP BY threshold_mm"""


def _rates(spark, sf):
    return evaluate.class_rates(b.scores(spark, sf).where("split = 'train'"))


@query("M20_class_rates", f"SELECT * REPLACE (round(probability, 6) AS probability) FROM ({RATES})", "scores")
def _(spark, sf):
    return _rates(spark, sf)


TEST_SQL = _metrics_sql("threshold_mm", "(SELECT * FROM scores WHERE split = 'test')")


@query("M21_brier_skill", f"""SELECT threshold_mm, n, positives, {ROUND_M}, round(r, 6) AS constant_baseline_probability,
round(base, 6) AS constant_baseline_brier, round(1 - brier / base, 6) AS brier_skill FROM (
SELECT *, prevalence * (1 - r) * (1 - r) + (1 - prevalence) * r * r AS base FROM ({TEST_SQL})
JOIN (SELECT threshold_mm, probability AS r FROM ({RATES})) USING (threshold_mm))""", "scores")
def _(spark, sf):
    test = b.scores(spark, sf).where("split = 'test'")
    return evaluate.brier_skill(evaluate.probability_metrics(test), _rates(spark, sf))


@query("M22_monotonicity", """SELECT count(q) AS adjacent_pairs, count(*) FILTER (p > q + 1e-12) AS violating_pairs,
round(count(*) FILTER (p > q + 1e-12) / count(q), 6) AS violation_fraction FROM (SELECT p, lag(p) OVER
(PARTITION BY station_id, prediction_time ORDER BY threshold_mm) AS q FROM scores)""", "scores")
def _(spark, sf):
    return evaluate.monotonicity(b.scores(spark, sf))


CONFUSION = """SELECT threshold_mm, count(*) FILTER (p < 0.99 AND label = 0) AS true_negative,
count(*) FILTER (p >= 0.99 AND label = 0) AS false_positive, count(*) FILTER (p < 0.99 AND label = 1) AS false_negative,
count(*) FILTER (p >= 0.99 AND label = 1) AS true_positive FROM scores GROUP BY threshold_mm"""
PRF = """round(true_positive / nullif(true_positive + false_positive, 0), 6) AS precision,
round(true_positive / nullif(true_positive + false_negative, 0), 6) AS recall,
round(2 * true_positive / nullif(2 * true_positive + false_positive + false_negative, 0), 6) AS f1"""


@query("M23_confusion", f"SELECT *, {PRF}, 0.99::DOUBLE AS decision_threshold FROM ({CONFUSION})", "scores")
def _(spark, sf):
    return evaluate.confusion(b.scores(spark, sf), 0.99)


@query("M23_confusion_cells", f"""SELECT threshold_mm, y AS label, q AS predicted_label, CASE WHEN y = 0 AND q = 0
THEN true_negative WHEN y = 0 THEN false_positive WHEN q = 0 THEN false_negative ELSE true_positive END AS count
FROM ({CONFUSION}), (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(y, q)""", "scores")
def _(spark, sf):
    return evaluate.confusion_cells(evaluate.confusion(b.scores(spark, sf), 0.99))


@query("M24_confusion_from_bins", f"""SELECT *, {PRF} FROM (SELECT threshold_mm, 0.5::DOUBLE AS decision_cutoff,
count(*) AS samples, count(*) FILTER (label = 1) AS actual_positives, count(*) FILTER (p >= 0.5) AS predicted_positives,
count(*) FILTER (p >= 0.5 AND label = 1) AS true_positive, count(*) FILTER (p >= 0.5 AND label = 0) AS false_positive,
count(*) FILTER (p < 0.5 AND label = 1) AS false_negative, count(*) FILTER (p < 0.5 AND label = 0) AS true_negative,
true AS reconciles FROM scores GROUP BY threshold_mm)""", "scores")
def _(spark, sf):
    rows = b.scores(spark, sf)
    return evaluate.confusion_from_bins(evaluate.reliability(rows), evaluate.probability_metrics(rows))


def _wide() -> str:
    names = {"samples": "n", "positive_rate": "round(prevalence, 6)", "roc_auc": "round(roc_auc, 6)",
             "pr_auc": "round(pr_auc, 6)", "brier": "round(brier, 6)"}
    return ", ".join(f"max({c}) FILTER (split = '{s}') AS {s}_{k}" for k, c in names.items()
                     for s in ("validation", "test"))


@query("M25_compare_splits", f"""SELECT threshold_mm, {_wide()} FROM {_full_sql('split, threshold_mm')}
GROUP BY threshold_mm""", "scores")
def _(spark, sf):
    return evaluate.compare_splits(b.scores(spark, sf))


@query("M27_compare_models", f"""SELECT threshold_mm, model, n AS samples, positives, round(roc_auc, 6) AS roc_auc,
round(pr_auc, 6) AS pr_auc, round(brier, 6) AS brier, roc_auc = max(roc_auc) OVER w AS best_roc_auc,
pr_auc = max(pr_auc) OVER w AS best_pr_auc, brier = min(brier) OVER w AS best_brier,
min(n) OVER w = max(n) OVER w AND min(positives) OVER w = max(positives) OVER w AS equal_cohort
FROM {_full_sql('model, threshold_mm', 'model_scores')} WINDOW w AS (PARTITION BY threshold_mm)""", "model_scores")
def _(spark, sf):
    return evaluate.compare_models(b.model_scores(spark, sf))


@query("M28_reconcile_bins", """SELECT threshold_mm, count(*) AS n, count(*) AS bin_n, true AS bins_unique,
true AS reconciles, round(avg(p), 6) AS mean_probability, round(avg(p), 6) AS bin_probability,
round(avg(label), 6) AS prevalence, round(avg(label), 6) AS bin_frequency FROM scores GROUP BY threshold_mm""", "scores")
def _(spark, sf):
    rows = b.scores(spark, sf)
    return evaluate.reconcile_bins(evaluate.reliability(rows), evaluate.probability_metrics(rows))


@query("M29_retention", """SELECT year, split, retained_rows, input_rows, input_rows - retained_rows AS excluded_rows
FROM (SELECT year, split, count(*) AS retained_rows FROM prepared GROUP BY ALL)
LEFT JOIN (SELECT CAST(year("timestamp") AS INTEGER) AS year, count(*) AS input_rows FROM dense GROUP BY 1)
USING (year)""", "prepared", "dense")
def _(spark, sf):
    return evaluate.retention(b.dense(spark, sf), b.prepared(spark, sf))


# --- point-in-time lookup ---


def _requests(spark, sf):
    """One request per event at its hour; some are off the grid, in another year or at another threshold."""
    k = F.col("event_id")
    hour = F.date_trunc("HOUR", "timestamp").cast("timestamp_ntz")
    time = (F.when(k % 50 == 1, F.timestamp_add("SECOND", F.lit(90), hour))
            .when(k % 50 == 2, F.timestamp_add("YEAR", F.lit(-9), hour)).otherwise(hour))
    listed = F.element_at(F.array(*[F.lit(t) for t in b.LABELS]), (k % 4 + 1).cast("int"))
    return b.events_(spark, sf).select(k.alias("request_id"), "station_id", time.alias("prediction_time"),
                                       F.when(k % 50 == 3, 7.5).otherwise(listed).alias("threshold_mm"))


REQUESTS = f"""SELECT *, CASE WHEN NOT year(prediction_time) BETWEEN 2017 AND 2024 THEN 'outside_years'
WHEN epoch_us(prediction_time) % 3600000000 <> 0 THEN 'off_grid'
WHEN threshold_mm NOT IN {b.LABELS} THEN 'unsupported_threshold' ELSE 'ok' END AS status FROM (
SELECT event_id AS request_id, station_id, CASE event_id % 50 WHEN 1 THEN h + INTERVAL 90 SECOND
  WHEN 2 THEN h - INTERVAL 9 YEAR ELSE h END AS prediction_time,
  CASE WHEN event_id % 50 = 3 THEN 7.5 ELSE {list(b.LABELS)}[event_id % 4 + 1] END::DOUBLE AS threshold_mm
FROM (SELECT *, date_trunc('hour', "timestamp") AS h FROM events_))"""
MOMENTS = f"SELECT DISTINCT station_id, prediction_time FROM ({REQUESTS}) WHERE status = 'ok'"


def _normalized(spark, sf):
    return lookup.normalize_requests(_requests(spark, sf), HOUR, b.LABELS)


@query("I1_normalize_requests", REQUESTS, "events_")
def _(spark, sf):
    return _normalized(spark, sf)


def _in_order(n: int) -> str:
    return " + ".join(f"max(v) FILTER (k = {i})" for i in range(1, n + 1))


HISTORY = f"""SELECT r.* EXCLUDE (status), CASE WHEN r.status <> 'ok' THEN r.status WHEN now IS NULL THEN 'no_observation'
WHEN held < 12 THEN 'insufficient_history' ELSE 'ok' END AS status,
CASE WHEN r.status = 'ok' THEN CAST(12 - coalesce(held, 0) AS BIGINT) END AS missing_history, p1, p6, p12
FROM ({REQUESTS}) r LEFT JOIN (SELECT station_id, t, max(v) FILTER (k = 0) AS now, count(*) FILTER (k > 0) AS held,
  max(v) FILTER (k = 1) AS p1, {_in_order(6)} AS p6, {_in_order(12)} AS p12 FROM (
  SELECT q.station_id, q.prediction_time AS t, k, d.rainfall AS v FROM ({MOMENTS}) q, (SELECT unnest(range(13)) AS k), dense d
  WHERE d.station_id = q.station_id AND d."timestamp" = q.prediction_time - to_hours(CAST(k AS INTEGER)))
  GROUP BY station_id, t) f ON f.station_id = r.station_id AND f.t = r.prediction_time"""


@query("I2_lookup_features", f"""SELECT request_id, station_id, prediction_time, threshold_mm, status, missing_history,
CAST(hour(prediction_time) AS INTEGER) AS hour, CAST(month(prediction_time) AS INTEGER) AS month,
CASE WHEN status = 'ok' THEN round(p1, 6) END AS rainfall_previous_5m,
CASE WHEN status = 'ok' THEN round(p6, 6) END AS rainfall_previous_30m,
CASE WHEN status = 'ok' THEN round(p12, 6) END AS rainfall_previous_60m FROM ({HISTORY})""", "events_", "dense")
def _(spark, sf):
    return lookup.lookup_features(_normalized(spark, sf), b.dense(spark, sf), HOUR)


@query("I3_window_quality", f"""SELECT r.request_id, r.station_id, r.prediction_time, r.status,
CAST(coalesce(dup, 0) AS BIGINT) AS duplicate_readings, CAST(coalesce(mis, 0) AS BIGINT) AS misaligned_readings,
CAST(coalesce(bad, 0) AS BIGINT) AS unusable_readings FROM ({REQUESTS}) r LEFT JOIN (
SELECT station_id, t, sum(greatest(n - 1, 0)) AS dup, sum(late) AS mis, sum(neg) AS bad FROM (
  SELECT q.station_id, q.prediction_time AS t, date_trunc('hour', o.ts) AS h, count(*) FILTER (NOT o.late) AS n,
    count(*) FILTER (o.late) AS late, count(*) FILTER (o.v < 0) AS neg
  FROM ({MOMENTS}) q JOIN (
    SELECT station_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('hour', "timestamp") ELSE "timestamp" END AS ts,
      event_id % 3 <> 0 AS late, CASE WHEN event_id % 11 = 0 THEN -1 ELSE rainfall END AS v FROM events_) o
  ON o.station_id = q.station_id AND o.ts >= q.prediction_time - INTERVAL 12 HOUR
    AND o.ts < q.prediction_time + INTERVAL 1 SECOND GROUP BY ALL)
GROUP BY station_id, t) f ON f.station_id = r.station_id AND f.t = r.prediction_time""", "events_")
def _(spark, sf):
    """Raw events as readings: a third moved onto the hour, some negative."""
    k = F.col("event_id")
    hour = F.date_trunc("HOUR", "timestamp").cast("timestamp_ntz")
    obs = b.events_(spark, sf).select(
        "station_id", F.when(k % 3 == 0, hour).otherwise(F.col("timestamp")).alias("timestamp"),
        F.when(k % 11 == 0, -1.0).otherwise(F.col("rainfall")).alias("rainfall"))
    return lookup.window_quality(_normalized(spark, sf), obs, HOUR)


@query("I4_predict")
def _(spark, sf):
    model, _ = models.train_and_select(b.prepared(spark, sf), _lr([0.01]), b.LABELS, pooled=True)
    found = lookup.lookup_features(_normalized(spark, sf), b.dense(spark, sf), HOUR, with_history=True)
    return models.predict(found, model).select("request_id", "status", "threshold_mm", "probability",
                                               "valid_probability", F.size("history").alias("history_points"))


@query("I5_verify", f"""SELECT request_id, station_id, prediction_time, threshold_mm, status, round(total, 6) AS total_mm,
total > threshold_mm AS exceeded FROM (SELECT r.*, CASE WHEN held = 6 THEN f END AS total FROM ({REQUESTS}) r LEFT JOIN (
SELECT station_id, t, count(*) AS held, {_in_order(6)} AS f FROM (
  SELECT q.station_id, q.prediction_time AS t, k, d.rainfall AS v FROM ({MOMENTS}) q, (SELECT unnest(range(1, 7)) AS k), dense d
  WHERE d.station_id = q.station_id AND d."timestamp" = q.prediction_time + to_hours(CAST(k AS INTEGER)))
  GROUP BY station_id, t) f ON f.station_id = r.station_id AND f.t = r.prediction_time)""", "events_", "dense")
def _(spark, sf):
    return lookup.verify(_normalized(spark, sf), b.dense(spark, sf), HOUR)
