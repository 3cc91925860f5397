"""Registered queries: correlation analysis, feature selection, training and calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks import sql as S
from checks.queries import metric_ctes, r6
from checks.registry import query
from clickloom.operators import correlation as C
from clickloom.operators import train as T
from clickloom.operators.calibrate import Calibrator
from clickloom.sources import impressions as imp

FEATURES = imp.FEATURES


def pairs(spark, sf) -> DataFrame:
    return C.correlation_pairs(imp.feature_table(spark, sf), FEATURES)


def targets(spark, sf) -> DataFrame:
    return C.target_correlations(imp.feature_table(spark, sf), FEATURES)


def both(spark, sf) -> C.CorrelationTables:
    return C.correlation_tables(imp.feature_table(spark, sf), FEATURES)


P = f"WITH RECURSIVE {S.FT}, {S.PAIRS}"
T_ = f"WITH {S.FT}, {S.TARGETS}"
PT = f"WITH RECURSIVE {S.FT}, {S.PAIRS}, {S.TARGETS}, {S.RANKED}"
BOTH = ("bw AS (SELECT feature1, feature2, correlation FROM pairs UNION ALL "
        "SELECT feature2, feature1, correlation FROM pairs)")
LIST = "('history_b_1', 'history_b_2', 'history_b_3')"
LISTED = ["history_b_1", "history_b_2", "history_b_3"]


@query("corr_matrix", f"{P} SELECT feature1, feature2, round(correlation, 6) AS correlation FROM pairs")
def corr_matrix(spark, sf):
    return pairs(spark, sf).select("feature1", "feature2", r6("correlation"))


@query("corr_matrix_wide", """WITH e AS (
  SELECT vec_id, unnest(range(0, 64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
SELECT printf('emb_%02d', a.i) AS feature1, printf('emb_%02d', b.i) AS feature2, round(corr(a.x, b.x), 6) AS correlation
FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i""")
def corr_matrix_wide(spark, sf):
    df = imp.embedding_table(spark, sf)
    names = [c for c in df.columns if c.startswith("emb_")]
    return C.correlation_pairs(df, names).select("feature1", "feature2", r6("correlation"))


@query("high_corr_pairs", f"{P} SELECT feature1, feature2, round(correlation, 6) AS correlation FROM pairs WHERE abs(correlation) >= 0.7")
def high_corr_pairs(spark, sf):
    return C.strong_pairs(pairs(spark, sf), 0.7).select("feature1", "feature2", r6("correlation"))


@query("corr_bands", f"""{P} SELECT * FROM (
  SELECT '0.1-0.5' AS band, count(*) FILTER (abs(correlation) >= 0.1 AND abs(correlation) < 0.5) AS pairs FROM pairs
  UNION ALL SELECT '0.5-0.7', count(*) FILTER (abs(correlation) >= 0.5 AND abs(correlation) < 0.7) FROM pairs
  UNION ALL SELECT '0.7-0.99', count(*) FILTER (abs(correlation) >= 0.7 AND abs(correlation) < 0.99) FROM pairs
  UNION ALL SELECT '>=0.99', count(*) FILTER (abs(correlation) >= 0.99) FROM pairs)""")
def corr_bands(spark, sf):
    return C.band_counts(pairs(spark, sf), (0.1, 0.5, 0.7, 0.99))


@query("subset_corr", f"""{P} SELECT count(*) AS pairs, round(avg(correlation), 6) AS mean_correlation FROM pairs
WHERE feature1 IN {LIST} AND feature2 IN {LIST}""")
def subset_corr(spark, sf):
    return C.subset_summary(pairs(spark, sf), LISTED).select("pairs", r6("mean_correlation"))


@query("group_corr_pairs", f"""{P} SELECT feature1, feature2, round(correlation, 6) AS correlation, {S.group_of('feature1')} AS "group"
FROM pairs WHERE {S.group_of('feature1')} = {S.group_of('feature2')} AND abs(correlation) >= 0.6""")
def group_corr_pairs(spark, sf):
    return C.group_pairs(pairs(spark, sf), 0.6).select("feature1", "feature2", r6("correlation"), "group")


@query("top_partners", f"""{P}, {BOTH} SELECT feature1, feature2, round(correlation, 6) AS correlation, CAST(rnk AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY feature1 ORDER BY abs(correlation) DESC, feature2) AS rnk FROM bw
  WHERE feature1 IN {LIST} AND feature2 NOT IN {LIST}) WHERE rnk <= 5""")
def top_partners(spark, sf):
    return C.top_partners(both(spark, sf).pairs, LISTED, 5).select("feature1", "feature2", r6("correlation"), "rank")


@query("target_correlation", f"{T_} SELECT feature, round(correlation, 6) AS correlation, round(a, 6) AS abs_correlation FROM targets")
def target_correlation(spark, sf):
    return targets(spark, sf).select("feature", r6("correlation"), r6("abs_correlation"))


@query("top_target_corr", f"""{PT} SELECT feature, round(correlation, 6) AS correlation, CAST(rnk AS INTEGER) AS rank,
  rnk <= 3 AS is_top, rnk > 9 AS is_bottom FROM ranked WHERE rnk <= 3 OR rnk > 9""")
def top_target_corr(spark, sf):
    return C.extremes(targets(spark, sf), 3).select("feature", r6("correlation"), "rank", "is_top", "is_bottom")


@query("corr_classes", f"""{T_} SELECT CASE WHEN a >= 0.2 THEN 'high' WHEN a >= 0.01 THEN 'medium' ELSE 'low' END AS class,
  count(*) AS features, string_agg(feature, ',' ORDER BY round(a, 9) DESC, feature) AS names FROM targets GROUP BY 1""")
def corr_classes(spark, sf):
    steady = targets(spark, sf).withColumn("abs_correlation", F.round("abs_correlation", 9))
    return C.target_classes(steady, 0.2, 0.01)


@query("corr_distribution", f"""{P} SELECT round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(stddev_pop(v), 6) AS std,
  round(min(v), 6) AS min, round(max(v), 6) AS max, round(stddev_pop(v) / avg(v), 6) AS cv,
  round(quantile_cont(v, 0.9), 6) AS p90, round(quantile_cont(v, 0.95), 6) AS p95, round(quantile_cont(v, 0.99), 6) AS p99
FROM (SELECT abs(correlation) AS v FROM pairs)""")
def corr_distribution(spark, sf):
    df = C.distribution(pairs(spark, sf))
    return df.select(*[r6(c) for c in df.columns])


@query("top_bottom_gap", f"""{PT}, g AS (SELECT avg(a) FILTER (rnk <= 5) AS t, avg(a) FILTER (rnk > 5) AS b FROM ranked)
SELECT round(t, 6) AS top_mean, round(b, 6) AS rest_mean, round(t - b, 6) AS difference, round((t - b) / b * 100, 6) AS uplift_pct FROM g""")
def top_bottom_gap(spark, sf):
    df = C.top_bottom_gap(targets(spark, sf))
    return df.select(*[r6(c) for c in df.columns])


_CAND = """cand AS (SELECT p.feature1, p.feature2, abs(p.correlation) AS c, x.a AS a1, y.a AS a2,
  (x.a + y.a) * (1 - abs(p.correlation)) AS s FROM pairs p JOIN ranked x ON x.feature = p.feature1 JOIN ranked y ON y.feature = p.feature2
  WHERE abs(p.correlation) < 0.3 AND x.a > 0.01 AND y.a > 0.01 AND x.rnk <= 20 AND y.rnk <= 20)"""


@query("interaction_candidates", f"""{PT}, {_CAND} SELECT feature1, feature2, round(c, 6) AS feature_correlation,
  round(a1, 6) AS feat1_target_corr, round(a2, 6) AS feat2_target_corr, round(s, 6) AS interaction_score FROM cand""")
def interaction_candidates(spark, sf):
    t = both(spark, sf)
    df = C.interaction_candidates(t.pairs, t.targets)
    return df.select("feature1", "feature2", *[r6(c) for c in df.columns[2:]])


@query("cross_group_candidates", f"""{PT}, {_CAND}, b AS (SELECT * FROM cand ORDER BY s DESC, feature1, feature2 LIMIT 20)
SELECT feature1, {S.group_of('feature1')} AS group1, feature2, {S.group_of('feature2')} AS group2, round(s, 6) AS interaction_score
FROM b WHERE {S.group_of('feature1')} <> {S.group_of('feature2')} ORDER BY s DESC, feature1, feature2 LIMIT 10""")
def cross_group_candidates(spark, sf):
    t = both(spark, sf)
    df = C.cross_group_candidates(C.interaction_candidates(t.pairs, t.targets))
    return df.withColumn("interaction_score", F.round("interaction_score", 6))


@query("named_pairs", f"""{PT}, {BOTH}, w AS (SELECT * FROM (VALUES ('history_a_1', 'feat_e_3'), ('history_b_1', 'history_a_2'),
  ('history_a_1', 'inventory_id'), ('age_group', 'day_of_week')) v(feature1, feature2))
SELECT w.feature1, w.feature2, round(bw.correlation, 6) AS correlation, round(x.correlation, 6) AS target_corr1,
  round(y.correlation, 6) AS target_corr2, concat_ws(',', CASE WHEN x.feature IS NULL THEN w.feature1 END,
  CASE WHEN y.feature IS NULL THEN w.feature2 END) AS missing
FROM w LEFT JOIN bw ON bw.feature1 = w.feature1 AND bw.feature2 = w.feature2
  LEFT JOIN targets x ON x.feature = w.feature1 LEFT JOIN targets y ON y.feature = w.feature2""")
def named_pairs(spark, sf):
    wanted = [("history_a_1", "feat_e_3"), ("history_b_1", "history_a_2"), ("history_a_1", "inventory_id"),
              ("age_group", "day_of_week")]
    t = both(spark, sf)
    df = C.named_pairs(t.pairs, t.targets, wanted)
    return df.select("feature1", "feature2", r6("correlation"), r6("target_corr1"), r6("target_corr2"), "missing")


_REACH = """edges AS (SELECT feature1 AS a, feature2 AS b FROM pairs WHERE abs(correlation) >= 0.95
  UNION ALL SELECT feature2, feature1 FROM pairs WHERE abs(correlation) >= 0.95),
reach AS (SELECT a AS node, a AS other FROM edges UNION SELECT reach.node, edges.b FROM reach JOIN edges ON edges.a = reach.other),
comp AS (SELECT node AS feature, min(other) AS component FROM reach GROUP BY 1),
red AS (SELECT component, feature, correlation, row_number() OVER (PARTITION BY component ORDER BY round(t.a, 9) DESC, feature) = 1 AS keep
  FROM comp JOIN targets t USING (feature))"""


def _redundant(spark, sf) -> DataFrame:
    t = both(spark, sf)
    steady = t.targets.withColumn("abs_correlation", F.round("abs_correlation", 9))
    return C.redundancy_groups(t.pairs, steady, 0.95)


@query("redundancy_groups", f"{PT}, {_REACH} SELECT component, feature, round(correlation, 6) AS correlation, keep FROM red")
def redundancy_groups(spark, sf):
    return _redundant(spark, sf).select("component", "feature", r6("correlation"), "keep")


@query("drop_list_summary", f"""{PT}, {_REACH}, g AS (
  SELECT {S.group_of('feature')} AS "group", count(*) AS features, string_agg(feature, ',' ORDER BY feature) AS names
  FROM red WHERE NOT keep GROUP BY 1)
SELECT "group", features, names, CAST(sum(features) OVER () AS BIGINT) AS total FROM g""")
def drop_list_summary(spark, sf):
    from clickloom.functions.columns import feature_group

    dropped = _redundant(spark, sf).where(~F.col("keep")).withColumn("group", feature_group(F.col("feature")))
    return C.drop_list_summary(dropped)


@query("post_drop_check", f"""{P} SELECT count(*) FILTER (kept AND abs(correlation) >= 0.7) AS pairs_ge_0_7,
  count(*) FILTER (kept AND abs(correlation) >= 0.99) AS pairs_ge_0_99, 9 AS features_left, 25.0::DOUBLE AS reduction_pct
FROM (SELECT *, feature1 NOT IN {LIST} AND feature2 NOT IN {LIST} AS kept FROM pairs)""")
def post_drop_check(spark, sf):
    return C.post_drop_check(pairs(spark, sf), LISTED, len(FEATURES))


@query("drop_justification", f"""{T_}, m AS (SELECT avg(a) FILTER (feature IN {LIST}) AS x, avg(a) AS y FROM targets)
SELECT round(x, 6) AS dropped_mean, round(y, 6) AS overall_mean, x < y AS justified FROM m""")
def drop_justification(spark, sf):
    return C.drop_justification(targets(spark, sf), LISTED).select(r6("dropped_mean"), r6("overall_mean"), "justified")


@query("corr_histogram", f"""{T_}, r AS (SELECT round(correlation, 9) AS v FROM targets),
e AS (SELECT min(v) AS lo, max(v) AS hi FROM r)
SELECT least(CAST(floor((v - lo) / (hi - lo) * 30) AS INTEGER), 29) AS bin, count(*) AS features FROM r, e GROUP BY 1""")
def corr_histogram(spark, sf):
    return C.histogram(targets(spark, sf).withColumn("correlation", F.round("correlation", 9)), 30)


@query("top_pair_submatrix", f"""{P}, t AS (SELECT * FROM pairs ORDER BY abs(correlation) DESC, feature1, feature2 LIMIT 20),
n AS (SELECT feature1 AS f FROM t UNION SELECT feature2 FROM t)
SELECT feature1, feature2, round(correlation, 6) AS correlation FROM pairs
WHERE feature1 IN (SELECT f FROM n) AND feature2 IN (SELECT f FROM n)""")
def top_pair_submatrix(spark, sf):
    return C.top_pair_submatrix(both(spark, sf).pairs, 20).select("feature1", "feature2", r6("correlation"))


# ---------------------------------------------------------------- training
# Trees have no SQL form: the oracles check which rows and folds are scored and what must hold for the scores; the
# tests recompute the numbers.

SMALL = T.BoostParams(learning_rate=0.2, max_depth=3, min_data_in_leaf=5, rounds=4, max_bins=32)
# all rounds, until no fold gets better
STOPPING = T.BoostParams(learning_rate=0.7, max_depth=3, min_data_in_leaf=20, patience=2, max_bins=32)
HELD = f"{S.DRAW}::DOUBLE / 1152921504606846976.0::DOUBLE < 0.2"
LEARNABLE = f"{S.IMP}, {S.TRAIN}, {S.TEST}"


def learnable(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with a label that depends on the features."""
    df = imp.impressions(spark, sf).withColumns({
        "clicked": F.col("learnable"), "age": F.col("age_group").cast("int"), "inv": F.col("inventory_id").cast("int")})
    df = df.drop("learnable", "_low_k", "age_group", "inventory_id", "day_of_week", "hour")
    return imp.train_part(df), imp.test_part(df)


def probability(column: str):
    return F.coalesce(F.col(column).between(0, 1), F.lit(False))


@query("gbt_oof", f"WITH {LEARNABLE} SELECT row_idx, learnable AS clicked, {S.FOLD} AS fold, true AS scored FROM train")
def gbt_oof(spark, sf):
    oof = T.train_folds(learnable(spark, sf)[0], STOPPING).oof
    return oof.select("row_idx", "clicked", "fold", probability("raw_pred").alias("scored"))


@query("ensemble_scores", f"WITH {LEARNABLE} SELECT CAST(row_idx AS VARCHAR) AS ID, true AS scored FROM test")
def ensemble_scores(spark, sf):
    rows, new = learnable(spark, sf)
    return T.submission(T.train_folds(rows, SMALL, folds=2), new).select("ID", probability("clicked").alias("scored"))


@query("holdout_scores", f"WITH {LEARNABLE} SELECT row_idx, learnable AS clicked, true AS scored FROM train WHERE {HELD}")
def holdout_scores(spark, sf):
    scores = T.train_holdout(learnable(spark, sf)[0], SMALL)[1]
    return scores.select("row_idx", "clicked", probability("raw_pred").alias("scored"))


_NUMBERS = {"age": "CAST(age_group AS DOUBLE)", "inv": "CAST(inventory_id AS DOUBLE)", **{
    c: f"CAST({c} AS DOUBLE)" for c in ("gender", "feat_e_3", "history_a_6", "history_b_11", "history_b_22", "history_b_23")}}
_COLUMNS = " UNION ALL ".join(f"SELECT '{c}' AS feature, {x} AS x, learnable AS y FROM own" for c, x in _NUMBERS.items())
# the feature whose best single split leaves the least variance of the label; gaps are medians marked by a flag
SPLITS = f"""own AS (SELECT * FROM train WHERE NOT ({HELD})), cells AS ({_COLUMNS}),
medians AS (SELECT feature, quantile_disc(x, 0.5) AS m FROM cells GROUP BY 1),
filled AS (SELECT feature, coalesce(x, m) AS x, y FROM cells JOIN medians USING (feature)
  UNION ALL SELECT feature || '_isnull', CAST(x IS NULL AS DOUBLE), y FROM cells),
levels AS (SELECT feature, x, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s FROM filled GROUP BY 1, 2),
below AS (SELECT feature, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(n) OVER f AS all_n, sum(s) OVER f AS all_s
  FROM levels WINDOW w AS (PARTITION BY feature ORDER BY x), f AS (PARTITION BY feature)),
gains AS (SELECT feature, max(s * s / n + (all_s - s) * (all_s - s) / (all_n - n)) AS gain FROM below WHERE n < all_n GROUP BY 1)"""


@query("feature_importance", f"""WITH {LEARNABLE}, c AS (SELECT count(gender) < count(*) AS g, count(feat_e_3) < count(*) AS e,
  count(history_a_6) < count(*) AS a, count(history_b_22) < count(*) AS b FROM train), {SPLITS}
SELECT 8::BIGINT + g::INTEGER + e::INTEGER + a::INTEGER + b::INTEGER AS features, 1.0::DOUBLE AS total,
  (SELECT feature FROM gains ORDER BY gain DESC, feature LIMIT 1) AS best FROM c""")
def feature_importance(spark, sf):
    """The label follows from the value, which feat_e_3 holds with gaps and history_b_11 without its decimals."""
    rows = T.importance(T.train_holdout(learnable(spark, sf)[0], SMALL)[0])
    return rows.agg(F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("total"),
                    F.max_by("feature", "importance").alias("best"))


@query("permutation_importance", """SELECT feature, feature = 'value' AS matters FROM (VALUES ('age'), ('value'), ('gender'),
  ('history_a_6'), ('history_b_22'), ('history_b_23'), ('inv')) t(feature)""")
def permutation_importance(spark, sf):
    rows, _ = learnable(spark, sf)
    model, _ = T.train_holdout(rows, SMALL)
    drops = T.permutation_importance(model, rows)
    # two columns hold the value, and a model may use either
    name = F.when(F.col("feature").isin("feat_e_3", "history_b_11"), "value").otherwise(F.col("feature"))
    return drops.groupBy(name.alias("feature")).agg((F.max("mean_importance") > 0.01).alias("matters"))


@query("oof_metrics", f"""WITH {LEARNABLE}, f AS (SELECT 'fold_' || ({S.FOLD} + 1) AS stage FROM train)
SELECT DISTINCT stage, true AS measured FROM f UNION ALL SELECT 'overall', true""")
def oof_metrics(spark, sf):
    table = T.oof_metrics(T.train_folds(learnable(spark, sf)[0], SMALL).oof)
    good = probability("ap") & (F.col("logloss") > 0) & (F.col("wll") > 0) & probability("score")
    return table.select("stage", good.alias("measured"))


def _calibrated(spark, sf):
    """Scores of three digits, so that SQL can try every pair of levels."""
    df = imp.scored(spark, sf).withColumn("score", F.round("score", 3))
    return Calibrator().fit(df), df


@query("platt", "SELECT 0.0::DOUBLE AS residual, 0.0::DOUBLE AS slope")
def platt(spark, sf):
    """At the optimum the residuals sum to zero, and their products with the score to the penalised coefficient."""
    model, df = _calibrated(spark, sf)
    left = F.col("clicked") - F.col("platt_pred")
    coefficient = model.summary()["platt_coef"][0]
    return model.transform(df).agg((F.round(F.sum(left), 2) + 0.0).alias("residual"),
                                   (F.round(F.sum(left * F.col("score")) - coefficient, 2) + 0.0).alias("slope"))


SCORED3 = S.RARE + """, scored AS (SELECT row_idx, clicked,
  round(('0x' || substr(md5('7|' || row_idx), 1, 4))::BIGINT / 65536.0::DOUBLE, 3) AS score FROM imp)"""


@query("isotonic", f"""WITH {SCORED3}, levels AS (SELECT score, count(*) AS n, sum(clicked) AS y FROM scored GROUP BY 1),
c AS (SELECT score, sum(n) OVER (ORDER BY score) AS n, sum(y) OVER (ORDER BY score) AS y, n AS own_n, y AS own_y FROM levels),
p AS (SELECT a.score AS a, b.score AS b, (b.y - a.y + a.own_y) / (b.n - a.n + a.own_n)::DOUBLE AS mean
      FROM c a JOIN c b ON a.score <= b.score),
low AS (SELECT a, b, min(mean) OVER (PARTITION BY a ORDER BY b DESC) AS least FROM p)
SELECT b AS score, round(max(least), 6) AS isotonic_pred FROM low GROUP BY b""")
def isotonic(spark, sf):
    """The largest, over levels at or below, of the smallest mean of a range of levels that begins there."""
    model, df = _calibrated(spark, sf)
    return model.transform(df.select("score").distinct()).select("score", r6("isotonic_pred"))


@query("calibration_stages", f"""WITH {SCORED3}, {metric_ctes('scored')}
SELECT 'raw' AS stage, round(ap, 6) AS ap, round(logloss, 6) AS logloss, round(wll, 6) AS wll, true AS measured FROM m
UNION ALL SELECT unnest(['platt', 'isotonic']), NULL, NULL, NULL, true""")
def calibration_stages(spark, sf):
    model, df = _calibrated(spark, sf)
    raw = F.col("stage") == "raw"
    return model.stages(df).select("stage", *[F.when(raw, F.round(c, 6)).alias(c) for c in ("ap", "logloss", "wll")],
                                   probability("score").alias("measured"))
