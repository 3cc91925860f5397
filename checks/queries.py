"""Registered queries: sources, projections, joins, aggregates, encodings, cross-fit, sampling, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from checks import sql as S
from checks.registry import query
from clickloom import defaults as d
from clickloom.functions import calendar, columns, keys, missing, sequence
from clickloom.operators import binning, crossfit, eda, encode, lookup, metrics, order_stats, sampling
from clickloom.operators.crossfit import SliceDelta, SliceDeltas
from clickloom.operators.train import load_frames
from clickloom.plans import jobs
from clickloom.plans.preprocess import Preprocessor
from clickloom.session import Scratch
from clickloom.sources import impressions as imp

PAIRS = d.TARGET_ENCODED_PAIRS


def events(spark: SparkSession, sf: str, seq: bool = False) -> DataFrame:
    return imp.impressions(spark, sf, seq)


def train(spark: SparkSession, sf: str, seq: bool = False) -> DataFrame:
    return imp.train_part(imp.public(imp.impressions(spark, sf, seq)))


def test(spark: SparkSession, sf: str, seq: bool = False) -> DataFrame:
    return imp.test_part(imp.public(imp.impressions(spark, sf, seq)))


def rare_train(spark: SparkSession, sf: str) -> DataFrame:
    return imp.train_part(imp.public(imp.rare(imp.impressions(spark, sf))))


def r6(name: str, alias: str | None = None):
    return F.round(name, 6).alias(alias or name)


# ---------------------------------------------------------------- sources, projections, predicates (A, B)

@query("table_summary", """
SELECT 'events' AS "table", count(*) AS num_rows, 6 AS num_columns FROM events
UNION ALL SELECT 'documents', count(*), 5 FROM documents
UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem""")
def table_summary(spark, sf):
    parts = [eda.table_summary(imp.table(spark, sf, t)).select(F.lit(t).alias("table"), "num_rows", "num_columns")
             for t in ("events", "documents", "lineitem")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("limit_by_key", f"WITH {S.IMP}, {S.TRAIN} SELECT row_idx, clicked FROM train ORDER BY row_idx LIMIT 700")
def limit_by_key(spark, sf):
    return sampling.first_by_key(train(spark, sf), 700).select("row_idx", "clicked")


@query("filter_label", f"WITH {S.IMP} SELECT row_idx, inventory_id FROM imp WHERE clicked = 1")
def filter_label(spark, sf):
    return events(spark, sf).where(F.col("clicked") == 1).select("row_idx", "inventory_id")


@query("slice_counts", f"""WITH {S.IMP}, {S.TRAIN}
SELECT count(*) FILTER (day_of_week = '7') AS day7_rows, CAST(sum(clicked) FILTER (day_of_week = '7') AS BIGINT) AS day7_clicks,
  count(*) FILTER (day_of_week <> '7') AS rest_rows, CAST(sum(clicked) FILTER (day_of_week <> '7') AS BIGINT) AS rest_clicks
FROM train""")
def slice_counts(spark, sf):
    inside = calendar.in_slice()
    return train(spark, sf).agg(
        F.count_if(inside).alias("day7_rows"), F.sum(F.when(inside, F.col("clicked"))).alias("day7_clicks"),
        F.count_if(~inside).alias("rest_rows"), F.sum(F.when(~inside, F.col("clicked"))).alias("rest_clicks"))


@query("semi_join_keys", f"""WITH {S.IMP} SELECT row_idx, clicked FROM imp
WHERE row_idx IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def semi_join_keys(spark, sf):
    wanted = imp.table(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").alias("row_idx"))
    return lookup.keep_keys(events(spark, sf), wanted).select("row_idx", "clicked")


@query("drop_columns", f"WITH {S.IMP}, {S.TRAIN} SELECT row_idx, gender, feat_e_3, hour FROM train")
def drop_columns(spark, sf):
    kept, _ = load_frames(train(spark, sf), test(spark, sf), [
        "clicked", "age_group", "inventory_id", "day_of_week", "history_a_6", "history_b_11", "history_b_22",
        "history_b_23", "history_b_3", "l_feat_16"])
    return columns.drop_columns(kept, d.COLLINEAR)


@query("select_numeric", f"""WITH {S.IMP}
SELECT gender, feat_e_3, history_a_6, history_b_11, history_b_22, history_b_23 FROM imp""")
def select_numeric(spark, sf):
    df = imp.public(events(spark, sf)).drop("ts")
    return df.select(columns.numeric_columns(df, ["clicked", "row_idx"], parity=True))


@query("cast_fill_zero", f"""WITH {S.IMP}
SELECT row_idx, CAST(coalesce(gender, 0) AS DOUBLE) AS gender, coalesce(feat_e_3, 0) AS feat_e_3,
  coalesce(try_cast(hour AS DOUBLE), 0) AS hour FROM imp""")
def cast_fill_zero(spark, sf):
    return events(spark, sf).select("row_idx", *[columns.cast_fill(c).alias(c) for c in ("gender", "feat_e_3", "hour")])


@query("align_features", f"""WITH {S.IMP}, {S.TEST}
SELECT CAST(row_idx AS VARCHAR) AS "ID", history_b_11, 0.0::DOUBLE AS history_b_99, CAST(gender AS DOUBLE) AS gender FROM test""")
def align_features(spark, sf):
    return columns.align(test(spark, sf), ["history_b_11", "history_b_99", "gender"], keep=["ID"])


@query("fill_categorical", f"""WITH {S.IMP}
SELECT row_idx, coalesce(gender, -1) AS gender, coalesce(CASE WHEN row_idx % 5 <> 0 THEN hour END, 'Unknown') AS hour FROM imp""")
def fill_categorical(spark, sf):
    holes = events(spark, sf).withColumn("hour", F.when(F.col("row_idx") % 5 != 0, F.col("hour")))
    return missing.fill_categories(holes, ["gender", "hour", "absent"]).select("row_idx", "gender", "hour")


HISTORY = ["history_a_6", "history_b_11", "history_b_22", "history_b_23"]
MEDIANS = "med AS (SELECT " + ", ".join(f"median({c}) AS {c}" for c in HISTORY) + " FROM train)"
FILLED = ("filled AS (SELECT train.* REPLACE (" + ", ".join(f"coalesce(train.{c}, med.{c}) AS {c}" for c in HISTORY)
          + ") FROM train, med)")


@query("median_fill", f"WITH {S.IMP}, {S.TRAIN}, {MEDIANS}, {FILLED} SELECT row_idx, {', '.join(HISTORY)} FROM filled")
def median_fill(spark, sf):
    df = train(spark, sf)
    return missing.fill_values(df, order_stats.medians(df, HISTORY)).select("row_idx", *HISTORY)


@query("missing_flags", f"""WITH {S.IMP}
SELECT row_idx, CAST(feat_e_3 IS NULL AS INTEGER) AS feat_e_3_missing,
  CAST(history_a_6 IS NULL AND gender IS NULL AS INTEGER) AS both_missing FROM imp""")
def missing_flags(spark, sf):
    groups = {"feat_e_3_missing": ["feat_e_3"], "both_missing": ["history_a_6", "gender", "absent"], "none": ["absent"]}
    df = missing.missing_flags(events(spark, sf), groups)
    return df.select("row_idx", F.col("feat_e_3_missing").cast("int"), F.col("both_missing").cast("int"))


# ---------------------------------------------------------------- calendar and sequence features

@query("cyclical_features", f"""WITH {S.IMP}
SELECT row_idx, round(sin(2 * pi() * CAST(day_of_week AS DOUBLE) / 7), 6) AS dow_sin,
  round(cos(2 * pi() * CAST(day_of_week AS DOUBLE) / 7), 6) AS dow_cos,
  CAST(day_of_week IN ('1', '7') AS INTEGER) AS is_weekend,
  round(sin(2 * pi() * CAST(hour AS DOUBLE) / 24), 6) AS hour_sin,
  round(cos(2 * pi() * CAST(hour AS DOUBLE) / 24), 6) AS hour_cos FROM imp""")
def cyclical_features(spark, sf):
    df = calendar.cyclical(events(spark, sf))
    return df.select("row_idx", r6("dow_sin"), r6("dow_cos"), F.col("is_weekend").cast("int"), r6("hour_sin"), r6("hour_cos"))


@query("time_period", f"WITH {S.IMP} SELECT row_idx, {S.PERIOD} AS time_period FROM imp")
def time_period(spark, sf):
    return events(spark, sf).select("row_idx", calendar.time_period().alias("time_period"))


@query("pair_keys", f"""WITH {S.IMP}
SELECT row_idx, day_of_week || '|' || hour AS dow_hour, inventory_id || '|' || gender AS inventory_id__X__gender FROM imp""")
def pair_keys(spark, sf):
    return events(spark, sf).select("row_idx", calendar.pair_key("day_of_week", "hour").alias("dow_hour"),
                                    calendar.pair_key("inventory_id", "gender").alias("inventory_id__X__gender"))


@query("day7_early_flag", f"""WITH {S.IMP}
SELECT row_idx, CAST(day_of_week = '7' AND CAST(hour AS INTEGER) <= 5 AS INTEGER) AS day7_early_hour_flag FROM imp""")
def day7_early_flag(spark, sf):
    return events(spark, sf).select("row_idx", calendar.early_flag().cast("int").alias("day7_early_hour_flag"))


@query("sample_weights", f"""WITH {S.IMP}
SELECT row_idx, CASE WHEN day_of_week = '7' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END
  * CASE WHEN day_of_week = '7' AND CAST(hour AS INTEGER) <= 5 THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END
  * CASE WHEN clicked = 1 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM imp""")
def sample_weights(spark, sf):
    return events(spark, sf).select("row_idx", calendar.sample_weight(2.0, 3.0, 5, 1.5).alias("weight"))


@query("seq_features", f"""WITH {S.SEQS}
SELECT row_idx, CAST({S.LEN} AS INTEGER) AS seq_len,
  CAST(nullif(regexp_extract(seq, '^([0-9]+)', 1), '') AS INTEGER) AS seq_first,
  CAST(nullif(regexp_extract(seq, '([0-9]+)$', 1), '') AS INTEGER) AS seq_last, 1 AS seq_available FROM seqs""")
def seq_features(spark, sf):
    return sequence.add_seq_features(imp.sequences(spark, sf)).select(
        "row_idx", "seq_len", "seq_first", "seq_last", "seq_available")


@query("seq_len_bucket", f"""WITH {S.SEQS} SELECT row_idx, {S.buckets(S.LEN, '5000+')} AS seq_len_bucket,
  {S.buckets(f'coalesce({S.LEN}, 0)', '10000+', True)} AS seq_bucket FROM seqs""")
def seq_len_bucket(spark, sf):
    df = imp.sequences(spark, sf).withColumns({
        "n": sequence.seq_length(), "n0": sequence.seq_length(null_as_zero=True)})
    return df.select("row_idx", sequence.seq_len_bucket(F.col("n")).alias("seq_len_bucket"),
                     sequence.seq_report_bucket(F.col("n0")).alias("seq_bucket"))


@query("seq_cross", f"""WITH {S.IMP_SEQ}, f AS (SELECT row_idx, day_of_week, hour, {S.LEN} AS n,
  nullif(regexp_extract(seq, '([0-9]+)$', 1), '') AS l FROM imp)
SELECT row_idx, CAST(CAST(n AS FLOAT) * CAST(hour AS FLOAT) AS DOUBLE) AS "seq_len_X_hour",
  CAST(CAST(n AS FLOAT) * CAST(day_of_week AS FLOAT) AS DOUBLE) AS "seq_len_X_day_of_week",
  CAST(CAST(l AS FLOAT) * CAST(day_of_week AS FLOAT) AS DOUBLE) AS "seq_last_X_day_of_week",
  CAST(CAST(l AS FLOAT) * CAST(hour AS FLOAT) AS DOUBLE) AS "seq_last_X_hour" FROM f""")
def seq_cross(spark, sf):
    df = sequence.add_seq_crosses(sequence.add_seq_features(events(spark, sf, True)))
    return df.select("row_idx", *[F.col(f"{a}_X_{b}").cast("double") for a, b in d.SEQ_CROSSES])


@query("seq_stats", f"""WITH {S.SEQS}, t AS (
  SELECT row_idx, CASE WHEN seq IS NULL THEN [] ELSE [CAST(x AS DOUBLE) for x in string_split(seq, ',')] END AS x FROM seqs)
SELECT row_idx, round(coalesce(list_avg(x), 0), 6) AS seq_mean, round(coalesce(list_stddev_pop(x), 0), 6) AS seq_std,
  coalesce(list_min(x), 0) AS seq_min, coalesce(list_max(x), 0) AS seq_max, CAST(len(x) AS DOUBLE) AS seq_len,
  coalesce(list_sum(x), 0) AS seq_sum, coalesce(list_median(x), 0) AS seq_median FROM t""")
def seq_stats(spark, sf):
    df = sequence.add_seq_stats(imp.sequences(spark, sf))
    return df.select("row_idx", r6("seq_mean"), r6("seq_std"), "seq_min", "seq_max", "seq_len", "seq_sum", "seq_median")


@query("seq_diversity", f"""WITH {S.SEQS}, t AS (
  SELECT clicked, len(list_distinct(string_split(seq, ','))) / ({S.LEN})::DOUBLE AS r FROM seqs WHERE seq IS NOT NULL)
SELECT CASE WHEN r < 0.1 THEN '<0.1' WHEN r < 0.2 THEN '0.1-0.2' WHEN r < 0.4 THEN '0.2-0.4' WHEN r < 0.6 THEN '0.4-0.6'
  ELSE '>=0.6' END AS diversity_bucket, count(*) AS rows, CAST(sum(clicked) AS BIGINT) AS clicks,
  round(avg(clicked), 6) AS click_rate FROM t GROUP BY 1""")
def seq_diversity(spark, sf):
    return eda.diversity_rates(imp.sequences(spark, sf))


@query("clip_seq_len", f"WITH {S.SEQS} SELECT row_idx, CAST(CASE WHEN seq IS NOT NULL THEN least({S.LEN}, 5000) END AS INTEGER) AS seq_len FROM seqs")
def clip_seq_len(spark, sf):
    df = imp.sequences(spark, sf).withColumn("n", sequence.seq_length())
    return df.select("row_idx", sequence.clip_length(F.col("n")).alias("seq_len"))


# ---------------------------------------------------------------- joins (C)

@query("attach_features", f"""WITH {S.IMP}, extra AS (
  SELECT o_orderkey AS row_idx, count(*) AS orders, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1)
SELECT imp.row_idx, clicked, orders, spent FROM imp LEFT JOIN extra ON imp.row_idx = extra.row_idx""")
def attach_features(spark, sf):
    extra = imp.table(spark, sf, "orders").groupBy(F.col("o_orderkey").alias("row_idx")).agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return lookup.attach_by_row(events(spark, sf), extra).select("row_idx", "clicked", "orders", "spent")


_DIMENSIONS = ", ".join(f"round(CAST(e.embedding[{i + 1}] AS DOUBLE), 6) AS emb_{i:02d}" for i in range(imp.DIMENSIONS))


@query("merge_embeddings", f"""WITH {S.IMP} SELECT imp.row_idx, clicked, {_DIMENSIONS}
FROM imp LEFT JOIN embeddings e ON imp.row_idx = e.vec_id""")
def merge_embeddings(spark, sf):
    emb = imp.embedding_table(spark, sf).drop("label")
    return lookup.attach_by_row(events(spark, sf), emb).select(
        "row_idx", "clicked", *[r6(f"emb_{i:02d}") for i in range(imp.DIMENSIONS)])


@query("slice_full_outer", f"""WITH {S.IMP}, {S.TRAIN},
a AS (SELECT inventory_id, hour, avg(clicked) AS day7_ctr, count(*) AS day7_cnt FROM train WHERE day_of_week = '7' GROUP BY ALL),
b AS (SELECT inventory_id, hour, avg(clicked) AS rest_ctr, count(*) AS rest_cnt FROM train WHERE day_of_week <> '7' GROUP BY ALL)
SELECT inventory_id, hour, round(day7_ctr, 6) AS day7_ctr, day7_cnt, round(rest_ctr, 6) AS rest_ctr, rest_cnt
FROM a FULL OUTER JOIN b USING (inventory_id, hour)""")
def slice_full_outer(spark, sf):
    df = crossfit.slice_full_outer(train(spark, sf), ["inventory_id", "hour"])
    return df.select("inventory_id", "hour", r6("day7_ctr"), "day7_cnt", r6("rest_ctr"), "rest_cnt")


# ---------------------------------------------------------------- profile tables (D, L, M2)

@query("dataset_overview", f"""WITH {S.IMP}
SELECT 'rows' AS metric, format('{{:,}}', count(*)) AS value FROM imp
UNION ALL SELECT 'clicks', format('{{:,}}', CAST(sum(clicked) AS BIGINT)) FROM imp
UNION ALL SELECT 'click_rate', format('{{:.6f}}', avg(clicked)) FROM imp""")
def dataset_overview(spark, sf):
    return eda.overview(events(spark, sf))


RATES = "count(*) AS rows, CAST(sum(clicked) AS BIGINT) AS clicks, round(avg(clicked), 6) AS click_rate"


@query("ctr_by_day", f"WITH {S.IMP} SELECT day_of_week, {RATES} FROM imp GROUP BY 1")
def ctr_by_day(spark, sf):
    return eda.rates_by(events(spark, sf), ["day_of_week"])


@query("ctr_by_hour", f"WITH {S.IMP} SELECT hour, {RATES} FROM imp GROUP BY 1")
def ctr_by_hour(spark, sf):
    return eda.rates_by(events(spark, sf), ["hour"])


@query("ctr_by_keys", f"WITH {S.IMP} SELECT inventory_id, gender, {RATES} FROM imp GROUP BY 1, 2")
def ctr_by_keys(spark, sf):
    return eda.rates_by(events(spark, sf), ["inventory_id", "gender"])


@query("cyclic_by_day", f"""WITH {S.IMP} SELECT day_of_week, count(*) AS rows, round(avg(clicked), 6) AS click_rate,
  round(avg(sin((CAST(day_of_week AS DOUBLE) - 1) * 2 * pi() / 7)), 6) AS mean_sin,
  round(avg(cos((CAST(day_of_week AS DOUBLE) - 1) * 2 * pi() / 7)), 6) AS mean_cos FROM imp GROUP BY 1""")
def cyclic_by_day(spark, sf):
    return eda.cyclic_by(events(spark, sf), "day_of_week", 7, 1)


@query("cyclic_by_hour", f"""WITH {S.IMP} SELECT hour, count(*) AS rows, round(avg(clicked), 6) AS click_rate,
  round(avg(sin(CAST(hour AS DOUBLE) * 2 * pi() / 24)), 6) + 0.0 AS mean_sin,
  round(avg(cos(CAST(hour AS DOUBLE) * 2 * pi() / 24)), 6) + 0.0 AS mean_cos FROM imp GROUP BY 1""")
def cyclic_by_hour(spark, sf):
    df = eda.cyclic_by(events(spark, sf), "hour", 24)
    return df.withColumns({"mean_sin": F.col("mean_sin") + 0.0, "mean_cos": F.col("mean_cos") + 0.0})


@query("seq_length_summary", f"""WITH {S.SEQS}, t AS (SELECT CAST(coalesce({S.LEN}, 0) AS INTEGER) AS n FROM seqs),
o AS (SELECT n, row_number() OVER (ORDER BY n) - 1 AS i, count(*) OVER () AS c FROM t)
SELECT round(avg(n), 2) AS mean, CAST(median(n) AS DOUBLE) AS median, min(n) AS min, max(n) AS max,
  CAST(max(n) FILTER (i = round_even((c - 1) * 0.25::DOUBLE, 0)) AS DOUBLE) AS q1,
  CAST(max(n) FILTER (i = round_even((c - 1) * 0.75::DOUBLE, 0)) AS DOUBLE) AS q3 FROM o""")
def seq_length_summary(spark, sf):
    return eda.seq_length_summary(imp.sequences(spark, sf))


@query("seq_bucket_ctr", f"""WITH {S.SEQS}
SELECT {S.buckets(f'coalesce({S.LEN}, 0)', '10000+', True)} AS seq_bucket, {RATES} FROM seqs GROUP BY 1""")
def seq_bucket_ctr(spark, sf):
    return eda.seq_bucket_rates(imp.sequences(spark, sf))


_miss = ["gender", "inventory_id", "feat_e_3", "history_a_6", "history_b_22"]


@query("missing_rates", f"WITH {S.IMP} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(avg(CAST({c} IS NULL AS DOUBLE)), 6) AS missing_rate FROM imp""" for c in _miss))
def missing_rates(spark, sf):
    return eda.missing_rates(events(spark, sf), _miss).select("column", r6("missing_rate"))


_group_cols = ["clicked", "gender", "feat_e_3", "history_a_6", "history_b_11", "history_b_22", "history_b_23"]


@query("feature_group_counts", f"""WITH {S.IMP}, m AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(CAST({c} IS NULL AS DOUBLE)) AS missing FROM imp" for c in _group_cols) + f""")
SELECT {S.group_of('feature')} AS "group", count(*) AS features, round(avg(missing), 6) AS mean_missing FROM m GROUP BY 1""")
def feature_group_counts(spark, sf):
    rates = eda.missing_rates(events(spark, sf), _group_cols)
    return rates.groupBy(columns.feature_group(F.col("column")).alias("group")).agg(
        F.count("*").alias("features"), F.round(F.avg("missing_rate"), 6).alias("mean_missing"))


@query("feature_index", f"""WITH {S.IMP}, m AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(CAST({c} IS NULL AS DOUBLE)) AS missing FROM imp" for c in _group_cols) + """)
SELECT feature, try_cast(list_last(string_split(feature, '_')) AS INTEGER) AS number, round(missing, 6) AS missing FROM m""")
def feature_index(spark, sf):
    rates = eda.missing_rates(events(spark, sf), _group_cols)
    return rates.select(F.col("column").alias("feature"), columns.trailing_index(F.col("column")).alias("number"),
                        r6("missing_rate", "missing"))


_chi = ["gender", "age_group", "inventory_id", "day_of_week", "hour"]


@query("chi_square", f"WITH {S.IMP}, " + ", ".join(f"""
o{i} AS (SELECT v, y, coalesce(n, 0) AS n FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM imp WHERE {c} IS NOT NULL)
  CROSS JOIN (SELECT unnest([0, 1]) AS y) LEFT JOIN
  (SELECT CAST({c} AS VARCHAR) AS v, clicked AS y, count(*) AS n FROM imp GROUP BY 1, 2) USING (v, y)),
e{i} AS (SELECT n, sum(n) OVER (PARTITION BY v) * sum(n) OVER (PARTITION BY y) / (sum(n) OVER ())::DOUBLE AS e FROM o{i})"""
    for i, c in enumerate(_chi)) + ", t AS (" + " UNION ALL ".join(f"""
SELECT '{c}' AS feature, sum((n - e) * (n - e) / e) AS s, count(*) // 2 - 1 AS d FROM e{i}"""
    for i, c in enumerate(_chi)) + """)
SELECT feature, round(s, 6) AS statistic, d AS degrees, round(1 - list_sum(list_transform(range(0, 400), lambda k:
  exp((d / 2.0::DOUBLE + k) * ln(s / 2) - s / 2 - lgamma(d / 2.0::DOUBLE + k + 1)))), 9) AS p_value FROM t""")
def chi_square(spark, sf):
    from clickloom.operators.correlation import chi_square as run

    return run(events(spark, sf), _chi).select("feature", r6("statistic"), "degrees",
                                               F.round("p_value", 9).alias("p_value"))


# ---------------------------------------------------------------- encodings

@query("freq_encoding", f"""WITH {S.IMP}, {S.TRAIN}, {S.TEST}, n AS (SELECT count(*)::DOUBLE AS n FROM train),
g AS (SELECT coalesce(gender, -1) AS gender, count(*) / max(n.n) AS f FROM train, n GROUP BY 1),
i AS (SELECT inventory_id, count(*) / max(n.n) AS f FROM train, n GROUP BY 1),
both_parts AS (SELECT row_idx, coalesce(gender, -1) AS gender, inventory_id FROM train
  UNION ALL SELECT row_idx, coalesce(gender, -1), inventory_id || CASE WHEN row_idx % 9 = 0 THEN 'x' ELSE '' END FROM test)
SELECT row_idx, round(coalesce(g.f, 0), 6) AS gender_freq, round(coalesce(i.f, 0), 6) AS inventory_id_freq
FROM both_parts b LEFT JOIN g ON b.gender = g.gender LEFT JOIN i ON b.inventory_id = i.inventory_id""")
def freq_encoding(spark, sf):
    tr, te = (missing.fill_categories(x(spark, sf)) for x in (train, test))
    unseen = F.when(F.col("row_idx") % 9 == 0, F.concat("inventory_id", F.lit("x"))).otherwise(F.col("inventory_id"))
    model = encode.RateEncoder(target=[]).fit(tr)
    out = ["row_idx", r6("gender_freq"), r6("inventory_id_freq")]
    return model.transform_frequency(tr).select(*out).unionByName(
        model.transform_frequency(te.withColumn("inventory_id", unseen)).select(*out))


def _te_cte(i: int, left: str, right: str, held: str) -> str:
    if held:
        return f"""k{i} AS (SELECT held, {left}, {right}, sum(clicked) AS s, count(*) AS n FROM folded, folds
  WHERE fold <> held GROUP BY ALL)"""
    return f"k{i} AS (SELECT {left}, {right}, sum(clicked) AS s, count(*) AS n FROM tf GROUP BY ALL)"


def _te_sql(oof: bool) -> str:
    ctes = ", ".join(_te_cte(i, a, b, "held" if oof else "") for i, (a, b) in enumerate(PAIRS))
    cols = ", ".join(f"""round((coalesce(k{i}.s, 0) + 50 * p.p) / (coalesce(k{i}.n, 0) + 50), 6) AS "{a}__X__{b}_te" """
                     for i, (a, b) in enumerate(PAIRS))
    src = "folded" if oof else "sf"
    joins = " ".join(f"LEFT JOIN k{i} ON k{i}.{a} = r.{a} AND k{i}.{b} = r.{b}" + (f" AND k{i}.held = r.fold" if oof else "")
                     for i, (a, b) in enumerate(PAIRS))
    head = f"tf AS (SELECT {S.FILL} FROM train), p AS (SELECT avg(clicked) AS p FROM train)"
    folded = f", folded AS (SELECT *, {S.FOLD} AS fold FROM tf), {S.FOLDS}" if oof else f", sf AS (SELECT {S.FILL} FROM test)"
    return f"WITH {S.IMP}, {S.TRAIN}, {S.TEST}, {head}{folded}, {ctes} SELECT row_idx, {cols} FROM {src} r CROSS JOIN p {joins}"


@query("target_encoding_oof", _te_sql(True))
def target_encoding_oof(spark, sf):
    df = missing.fill_categories(train(spark, sf))
    out = encode.RateEncoder(frequency=[]).fit(df).transform_train(df)
    return out.select("row_idx", *[r6(f"{a}__X__{b}_te") for a, b in PAIRS])


@query("target_encoding_test", _te_sql(False))
def target_encoding_test(spark, sf):
    model = encode.RateEncoder(frequency=[]).fit(missing.fill_categories(train(spark, sf)))
    out = model.transform_new(missing.fill_categories(test(spark, sf)))
    return out.select("row_idx", *[r6(f"{a}__X__{b}_te") for a, b in PAIRS])


@query("category_codes", f"""WITH {S.IMP}, {S.TRAIN}, {S.TEST},
b AS (SELECT row_idx, CAST(gender AS VARCHAR) AS gender, inventory_id, day_of_week || '|' || hour AS dow_hour FROM train
  UNION ALL SELECT row_idx, CAST(gender AS VARCHAR), inventory_id, day_of_week || '|' || hour FROM test)
SELECT row_idx, CAST(CASE WHEN gender IS NOT NULL THEN dense_rank() OVER (ORDER BY gender NULLS LAST) - 1 END AS INTEGER) AS gender_cat,
  CAST(dense_rank() OVER (ORDER BY inventory_id) - 1 AS INTEGER) AS inventory_id_cat,
  CAST(dense_rank() OVER (ORDER BY dow_hour) - 1 AS INTEGER) AS dow_hour_cat FROM b""")
def category_codes(spark, sf):
    tr, te = (x(spark, sf).withColumn("dow_hour", calendar.pair_key("day_of_week", "hour")) for x in (train, test))
    model = encode.DictionaryEncoder(["gender", "inventory_id", "dow_hour"]).fit(tr, te)
    out = ["row_idx", "gender_cat", "inventory_id_cat", "dow_hour_cat"]
    return model.transform(tr).select(*out).unionByName(model.transform(te).select(*out))


# ---------------------------------------------------------------- cross-fit deltas

def coded(df: DataFrame) -> DataFrame:
    """Integer keys as after dictionary encoding."""
    df = df.withColumns({"inventory_id_cat": F.col("inventory_id").cast("int"), "gender_cat": F.col("gender"),
                         "hour": F.col("hour").cast("int")})
    if "seq" in df.columns:
        df = df.withColumn("_len", sequence.seq_length())
        code = binning.digitize(F.col("_len"), [b for b, _ in d.SEQ_BUCKETS])
        df = df.withColumn("seq_len_bucket_cat", code).drop("seq", "_len")
    return df


CODED = (f"*, CAST(inventory_id AS INTEGER) AS inventory_id_cat, gender AS gender_cat, CAST(hour AS INTEGER) AS hr, ")
CODED_CTE = "ctrain AS (SELECT {c}{s} AS seq_len_bucket_cat FROM train), ctest AS (SELECT {c}{s} AS seq_len_bucket_cat FROM test)".format(
    c=CODED, s=f"CAST({S.SEQ_CODE} AS INTEGER)")
GLOBAL = ("g AS (SELECT coalesce(avg(clicked) FILTER (day_of_week = '7'), avg(clicked)) AS m1, "
          "coalesce(avg(clicked) FILTER (day_of_week <> '7'), avg(clicked)) AS m0 FROM train)")


def _delta_sql(keys: list[str], name: str, oof: bool, alpha: float | None = None, min_count: int = 0,
               source: str = "ctrain", target: str = "ctest", tag: str = "") -> tuple[str, str, str]:
    """CTE, expression and join of one delta, by brute force over the folds."""
    k = ", ".join(keys)
    sums = ("count(*) FILTER (day_of_week = '7') AS n1, coalesce(sum(clicked) FILTER (day_of_week = '7'), 0) AS y1, "
            "count(*) FILTER (day_of_week <> '7') AS n0, coalesce(sum(clicked) FILTER (day_of_week <> '7'), 0) AS y0")
    if oof:
        cte = (f"q{tag} AS (SELECT held, {k}, {sums} FROM (SELECT *, {S.FOLD} AS fold FROM {source}), folds "
               f"WHERE fold <> held GROUP BY ALL)")
    else:
        cte = f"q{tag} AS (SELECT {k}, {sums} FROM {source} GROUP BY ALL)"
    q = f"q{tag}"
    if alpha is None:
        expr = f"coalesce({q}.y1 / nullif({q}.n1, 0) - {q}.y0 / nullif({q}.n0, 0), g.m1 - g.m0)"
    else:
        side = lambda i: (f"CASE WHEN coalesce({q}.n{i}, 0) >= {min_count} THEN (coalesce({q}.y{i}, 0) + {alpha} * g.m{i}) / "  # noqa: E731
                          f"(coalesce({q}.n{i}, 0) + {alpha}) ELSE g.m{i} END")
        expr = f"{side(1)} - {side(0)}"
    on = " AND ".join(f"{q}.{c} = r.{c}" for c in keys) + (f" AND {q}.held = r.fold" if oof else "")
    return cte, f"round({expr}, 6) AS {name}", f"LEFT JOIN {q} ON {on}"


def _deltas(base: str, specs, oof: bool, extra_cte: str = "", source="ctrain", target="ctest") -> str:
    parts = [_delta_sql(*spec[:2], oof, *spec[2:], source=source, target=target, tag=str(i)) for i, spec in enumerate(specs)]
    rows = f"(SELECT *, {S.FOLD} AS fold FROM {source}) r" if oof else f"{target} r"
    return (f"WITH {base}, {S.TRAIN}, {S.TEST}, {GLOBAL}, {S.FOLDS}{extra_cte}, " + ", ".join(p[0] for p in parts)
            + " SELECT row_idx, " + ", ".join(p[1] for p in parts) + f" FROM {rows} CROSS JOIN g "
            + " ".join(p[2] for p in parts))


NOSEQ = (f", ctrain AS (SELECT {CODED}1 AS one FROM train), ctest AS (SELECT {CODED}1 AS one FROM test)")
INV_HOUR = [(["inventory_id_cat", "hr"], "day7_ctr_delta_inv_hour"), (["gender_cat"], "day7_ctr_delta_gender")]
_inv_hour = [SliceDelta("day7_ctr_delta_inv_hour", ("inventory_id_cat", "hour")),
             SliceDelta("day7_ctr_delta_gender", ("gender_cat",))]


@query("cross_fit_delta", _deltas(S.IMP, INV_HOUR, True, NOSEQ))
def cross_fit_delta(spark, sf):
    df = coded(train(spark, sf))
    return SliceDeltas(_inv_hour).fit(df).transform_train(df).select(
        "row_idx", r6("day7_ctr_delta_inv_hour"), r6("day7_ctr_delta_gender"))


@query("cross_fit_delta_test", _deltas(S.IMP, INV_HOUR, False, NOSEQ))
def cross_fit_delta_test(spark, sf):
    model = SliceDeltas(_inv_hour).fit(coded(train(spark, sf)))
    return model.transform_new(coded(test(spark, sf))).select(
        "row_idx", r6("day7_ctr_delta_inv_hour"), r6("day7_ctr_delta_gender"))


@query("seq_bucket_delta", _deltas(S.IMP_SEQ, [(["seq_len_bucket_cat"], "day7_seq_bucket_delta")], True, ", " + CODED_CTE))
def seq_bucket_delta(spark, sf):
    df = Scratch(spark).keep(coded(train(spark, sf, True)))
    return SliceDeltas(jobs.SEQ_BUCKET_DELTA).fit(df).transform_train(df).select("row_idx", r6("day7_seq_bucket_delta"))


@query("freq_ratio", f"""WITH {S.IMP}, {S.TRAIN}, {S.TEST}, s AS (
  SELECT inventory_id, (count(*) FILTER (day_of_week = '7') + 1) / (count(*) + 2) AS r FROM train GROUP BY 1),
w AS (SELECT count(*) FILTER (day_of_week = '7') / count(*) AS r FROM train)
SELECT row_idx, round(coalesce(s.r, w.r), 6) AS day7_freq_ratio_inv FROM
  (SELECT row_idx, CASE WHEN row_idx % 9 <> 0 THEN inventory_id END AS inventory_id FROM train
   UNION ALL SELECT row_idx, CASE WHEN row_idx % 9 <> 0 THEN inventory_id END FROM test) b
  CROSS JOIN w LEFT JOIN s ON s.inventory_id = b.inventory_id""")
def freq_ratio(spark, sf):
    tr, te = train(spark, sf), test(spark, sf)
    holes = F.when(F.col("row_idx") % 9 != 0, F.col("inventory_id"))
    model = SliceDeltas([], share_key="inventory_id").fit(tr)
    both = tr.select("row_idx", "inventory_id").unionByName(te.select("row_idx", "inventory_id"))
    return model.transform_new(both.withColumn("inventory_id", holes)).select("row_idx", r6("day7_freq_ratio_inv"))


@query("slice_means", f"""WITH {S.IMP}, {S.TRAIN}, {GLOBAL}
SELECT round(m1, 6) AS day7_mean, round(m0, 6) AS rest_mean, round(m1 - m0, 6) AS delta FROM g""")
def slice_means(spark, sf):
    return crossfit.slice_means(train(spark, sf)).select(r6("day7_mean"), r6("rest_mean"), r6("delta"))


def _edges(bins: int) -> str:
    """Nearest-rank quantile values of every filled history column."""
    each = " UNION ALL ".join(f"""SELECT '{c}' AS col, v FROM (
      SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS i, count(*) OVER () AS n FROM filled)
      WHERE i IN (SELECT round_even((n - 1) * (b / {bins}.0::DOUBLE), 0) FROM (SELECT unnest(range(0, {bins + 1})) AS b))"""
                              for c in HISTORY)
    return f"""q AS (SELECT DISTINCT col, v FROM ({each})),
inner_e AS (SELECT col, v FROM q QUALIFY v > min(v) OVER (PARTITION BY col) AND v < max(v) OVER (PARTITION BY col))"""


@query("quantile_edges", f"""WITH {S.IMP}, {S.TRAIN}, {MEDIANS}, {FILLED}, {_edges(24)}
SELECT col AS "column", CAST(row_number() OVER (PARTITION BY col ORDER BY v) - 1 AS INTEGER) AS edge, v AS value FROM q""")
def quantile_edges(spark, sf):
    df = train(spark, sf)
    df = missing.fill_values(df, order_stats.medians(df, HISTORY))
    probs = binning.QuantileBinner(HISTORY, 24).quantiles()
    found = order_stats.order_statistics(df, {c: probs for c in HISTORY}).select("column", "value").distinct()
    place = F.row_number().over(Window.partitionBy("column").orderBy("value")) - 1
    return found.select("column", place.alias("edge"), "value")


def _bin(column: str, alias: str = "f") -> str:
    return f"CAST((SELECT count(*) FROM inner_e WHERE col = '{column}' AND v <= {alias}.{column}) AS INTEGER)"


BINNED = "binned AS (SELECT f.*, " + ", ".join(f"{_bin(c)} AS {c}_bin" for c in HISTORY) + " FROM filled f)"
GRID = ("nb AS (SELECT col, count(*) + 1 AS n FROM inner_e GROUP BY 1)")


@query("digitize", f"""WITH {S.IMP}, {S.TRAIN}, {MEDIANS}, {FILLED}, {_edges(24)}, {BINNED}
SELECT row_idx, {', '.join(f'{c}_bin' for c in HISTORY)} FROM binned""")
def digitize(spark, sf):
    df = train(spark, sf)
    return binning.QuantileBinner(HISTORY, 24).fit(df).transform(df).select("row_idx", *[f"{c}_bin" for c in HISTORY])


def _grid_cols(source: str) -> str:
    return ", ".join(
        f"CAST({a}_bin * (SELECT n FROM nb WHERE col = '{b}') + {b}_bin AS INTEGER) AS {a}_{b}_bin_idx"
        for a, b, _ in d.HISTORY_PAIRS)


@query("history_grid_bins", f"""WITH {S.IMP}, {S.TRAIN}, {MEDIANS}, {FILLED}, {_edges(24)}, {BINNED}, {GRID}
SELECT row_idx, {_grid_cols('binned')} FROM binned""")
def history_grid_bins(spark, sf):
    df = train(spark, sf)
    out = jobs.with_grid(df, binning.QuantileBinner(HISTORY, 24).fit(df))
    return out.select("row_idx", *[f"{a}_{b}_bin_idx" for a, b, _ in d.HISTORY_PAIRS])


HBINS, HALPHA, HMIN = 3, 100.0, 5
_tfill = ("tfilled AS (SELECT test.* REPLACE (" + ", ".join(f"coalesce(test.{c}, med.{c}) AS {c}" for c in HISTORY)
          + ") FROM test, med)")
_tbin = "tbinned AS (SELECT f.*, " + ", ".join(f"{_bin(c)} AS {c}_bin" for c in HISTORY) + " FROM tfilled f)"


def _history_sql(oof: bool, extra: list[str], bins: int = HBINS, fewest: int = HMIN) -> str:
    code = f"CAST({S.SEQ_CODE} AS INTEGER) AS seq_len_bucket_cat, gender AS gender_cat"
    cte = (f", {MEDIANS}, {FILLED}, {_edges(bins)}, {BINNED}, {_tfill}, {_tbin}, {GRID}, "
           f"ctrain AS (SELECT *, {code}, {_grid_cols('binned')} FROM binned), "
           f"ctest AS (SELECT *, {code}, {_grid_cols('tbinned')} FROM tbinned)")
    specs = [(["seq_len_bucket_cat", *extra, f"{a}_{b}_bin_idx"], name, HALPHA, fewest) for a, b, name in d.HISTORY_PAIRS]
    return _deltas(S.IMP_SEQ, specs, oof, cte)


def _history(spark, sf, extra=(), new=False, bins=HBINS, fewest=HMIN):
    df = Scratch(spark).keep(coded(train(spark, sf, True)))
    binner, model = jobs.history_model(df, extra, bins, HALPHA, fewest)
    rows = coded(test(spark, sf, True)) if new else df
    gridded = jobs.with_grid(rows, binner)
    out = model.transform_new(gridded) if new else model.transform_train(gridded)
    return out.select("row_idx", *[r6(name) for _, _, name in d.HISTORY_PAIRS])


@query("history_cross_delta", _history_sql(True, []))
def history_cross_delta(spark, sf):
    return _history(spark, sf)


@query("history_cross_delta_test", _history_sql(False, []))
def history_cross_delta_test(spark, sf):
    return _history(spark, sf, new=True)


@query("history_cross_delta_extra", _history_sql(True, ["gender_cat"]))
def history_cross_delta_extra(spark, sf):
    return _history(spark, sf, ["gender_cat", "gender_cat"])


@query("history_cross_delta_defaults", _history_sql(True, [], d.HISTORY_BINS, d.MIN_COUNT))
def history_cross_delta_defaults(spark, sf):
    return _history(spark, sf, bins=d.HISTORY_BINS, fewest=d.MIN_COUNT)


# ---------------------------------------------------------------- sampling and splits (G, M6)

STRATA = ["inventory_id", "day_of_week", "hour"]
NEG = "neg AS (SELECT * FROM train WHERE clicked = 0), pos AS (SELECT * FROM train WHERE clicked = 1)"


def _strat(ratio: float) -> str:
    return f"""{S.RARE}, {S.TRAIN}, {NEG}, c AS (SELECT (SELECT count(*) FROM pos) AS p, (SELECT count(*) FROM neg) AS n),
t AS (SELECT p, n, least(CAST(floor(p * {ratio}) AS BIGINT), n) AS target FROM c),
o AS (SELECT neg.*, row_number() OVER (PARTITION BY {', '.join(STRATA)} ORDER BY {S.DRAW}, row_idx) AS rn,
  count(*) OVER (PARTITION BY {', '.join(STRATA)}) AS sn FROM neg),
taken AS (SELECT o.* FROM o, t WHERE rn <= greatest(1, least(sn, CAST(round_even(sn * (target / n::DOUBLE), 0) AS BIGINT))))"""


@query("stratified_downsample", f"""WITH {_strat(4.0)}
SELECT row_idx, clicked, inventory_id FROM taken UNION ALL SELECT row_idx, clicked, inventory_id FROM pos""")
def stratified_downsample(spark, sf):
    out = sampling.stratified_downsample(rare_train(spark, sf), sampling.strata_columns(rare_train(spark, sf)))
    return out.select("row_idx", "clicked", "inventory_id")


@query("downsample_stats", f"""WITH {_strat(4.0)}, a AS (SELECT count(*) AS k FROM taken)
SELECT p AS total_pos, n AS total_neg, target AS target_neg, k AS actual_neg, round(k / p::DOUBLE, 6) AS ratio FROM t, a""")
def downsample_stats(spark, sf):
    df = rare_train(spark, sf)
    out = sampling.downsample_stats(df, sampling.stratified_downsample(df, STRATA))
    return out.withColumn("ratio", F.round("ratio", 6))


@query("random_downsample", f"""WITH {S.RARE}, {S.TRAIN}, {NEG}
SELECT row_idx, clicked FROM pos UNION ALL SELECT row_idx, clicked FROM (
  SELECT row_idx, clicked, row_number() OVER (ORDER BY {S.DRAW}, row_idx) AS rn FROM neg)
  WHERE rn <= 2 * (SELECT count(*) FROM pos)""")
def random_downsample(spark, sf):
    return sampling.random_downsample(rare_train(spark, sf)).select("row_idx", "clicked")


@query("random_sample_n", f"""WITH {S.IMP} SELECT row_idx, hour FROM (
  SELECT row_idx, hour, row_number() OVER (ORDER BY {S.DRAW}, row_idx) AS rn FROM imp) WHERE rn <= 500""")
def random_sample_n(spark, sf):
    return sampling.sample_rows(events(spark, sf), 500).select("row_idx", "hour")


@query("hash_folds", f"WITH {S.IMP} SELECT row_idx, {S.FOLD} AS fold FROM imp")
def hash_folds(spark, sf):
    return events(spark, sf).select("row_idx", keys.hash_fold().alias("fold"))


@query("stratified_folds", f"""WITH {S.RARE}, {S.TRAIN}
SELECT row_idx, clicked, CAST((row_number() OVER (PARTITION BY clicked ORDER BY {S.DRAW}, row_idx) * 5 - 1)
  // count(*) OVER (PARTITION BY clicked) AS INTEGER) AS fold FROM train""")
def stratified_folds(spark, sf):
    return sampling.stratified_folds(rare_train(spark, sf)).select("row_idx", "clicked", "fold")


@query("hash_split", f"WITH {S.IMP} SELECT row_idx, {S.DRAW}::DOUBLE / 1152921504606846976.0::DOUBLE < 0.2 AS held_out FROM imp")
def hash_split(spark, sf):
    kept, held = sampling.split(events(spark, sf))
    return kept.select("row_idx", F.lit(False).alias("held_out")).unionByName(held.select("row_idx", F.lit(True).alias("held_out")))


@query("day7_holdout", f"WITH {S.IMP}, {S.TRAIN} SELECT row_idx, clicked FROM train WHERE day_of_week = '7'")
def day7_holdout(spark, sf):
    return sampling.slice_holdout(train(spark, sf))[1].select("row_idx", "clicked")


# ---------------------------------------------------------------- metrics

_P = "least(greatest(score, 1e-15), 1 - 1e-15)"


def metric_ctes(source: str, by: str = "") -> str:
    part, sel, grp = (f"PARTITION BY {by} ", f"{by}, ", f"GROUP BY {by}") if by else ("", "", "")
    return f"""l AS (SELECT {sel}avg(CASE WHEN clicked = 1 THEN -ln({_P}) ELSE -ln(1 - {_P}) END) AS logloss,
  count(*) FILTER (clicked = 0) / greatest(count(*) FILTER (clicked = 1), 1)::DOUBLE AS pw,
  sum(CASE WHEN clicked = 1 THEN -ln({_P}) ELSE 0 END) AS l1, sum(CASE WHEN clicked = 0 THEN -ln(1 - {_P}) ELSE 0 END) AS l0,
  count(*) FILTER (clicked = 1) AS n1, count(*) FILTER (clicked = 0) AS n0 FROM {source} {grp}),
cum AS (SELECT {sel}clicked, sum(clicked) OVER ({part}ORDER BY score DESC) AS tp, count(*) OVER ({part}ORDER BY score DESC) AS seen,
  sum(clicked) OVER ({'PARTITION BY ' + by if by else ''}) AS allpos FROM {source}),
ap AS (SELECT {sel}sum(clicked * tp / seen::DOUBLE) / max(allpos) AS ap FROM cum {grp}),
m AS (SELECT {'l.' + by + ', ' if by else ''}ap, logloss, (pw * l1 + l0) / (pw * n1 + n0) AS wll FROM l {'JOIN ap USING (' + by + ')' if by else ', ap'})"""


@query("logloss", f"WITH {S.SCORED}, {metric_ctes('scored')} SELECT round(logloss, 6) AS logloss FROM m")
def logloss(spark, sf):
    return metrics.log_losses(imp.scored(spark, sf)).select(r6("logloss"))


@query("weighted_logloss", f"WITH {S.SCORED}, {metric_ctes('scored')} SELECT round(wll, 6) AS wll FROM m")
def weighted_logloss(spark, sf):
    return metrics.log_losses(imp.scored(spark, sf)).select(r6("wll"))


@query("average_precision", f"WITH {S.SCORED}, {metric_ctes('scored')} SELECT round(ap, 6) AS ap FROM m")
def average_precision(spark, sf):
    return metrics.average_precision(imp.scored(spark, sf)).select(r6("ap"))


@query("competition_score", f"""WITH {S.SCORED}, {metric_ctes('scored')}
SELECT round(ap, 6) AS ap, round(wll, 6) AS wll, round(0.5 * ap + 0.5 / (1 + wll), 6) AS score FROM m""")
def competition_score(spark, sf):
    return metrics.metric_bundle(imp.scored(spark, sf)).select(r6("ap"), r6("wll"), r6("score"))


_STAGED = ("staged AS (SELECT 'raw' AS stage, clicked, score FROM scored UNION ALL "
           "SELECT 'sharp', clicked, score * score FROM scored)")


@query("metrics_by_stage", f"""WITH {S.SCORED}, {_STAGED}, {metric_ctes('staged', 'stage')}
SELECT stage, round(ap, 6) AS ap, round(logloss, 6) AS logloss, round(wll, 6) AS wll,
  round(0.5 * ap + 0.5 / (1 + wll), 6) AS score FROM m""")
def metrics_by_stage(spark, sf):
    df = imp.scored(spark, sf).withColumn("sharp", F.col("score") * F.col("score"))
    out = metrics.metric_bundle(metrics.by_stage(df, {"raw": "score", "sharp": "sharp"}), groups=["stage"])
    return out.select("stage", r6("ap"), r6("logloss"), r6("wll"), r6("score"))


@query("score_range", f"WITH {S.SCORED} SELECT min(score) AS min_score, max(score) AS max_score FROM scored")
def score_range(spark, sf):
    return metrics.score_range(imp.scored(spark, sf))


@query("temperature_scaling", f"""WITH {S.SCORED}
SELECT row_idx, round(CASE WHEN score > 0 AND score < 1 THEN 1 / (1 + exp(-ln(score / (1 - score)) / 1.75)) ELSE score END, 6) AS score
FROM scored""")
def temperature_scaling(spark, sf):
    from clickloom.operators.calibrate import temperature

    return imp.scored(spark, sf).select("row_idx", F.round(temperature(F.col("score")), 6).alias("score"))


# ---------------------------------------------------------------- the whole recipe

_BASE = f"""{S.IMP_SEQ}, {S.TRAIN}, {S.TEST}, rows_all AS (
  SELECT {S.FILL}, true AS is_train FROM train UNION ALL SELECT {S.FILL}, false FROM test),
feat AS (SELECT *, {S.PERIOD} AS time_period, day_of_week || '|' || hour AS dow_hour, CAST({S.LEN} AS INTEGER) AS seq_len,
  CAST(nullif(regexp_extract(seq, '^([0-9]+)', 1), '') AS INTEGER) AS seq_first,
  CAST(nullif(regexp_extract(seq, '([0-9]+)$', 1), '') AS INTEGER) AS seq_last,
  {S.buckets(S.LEN, '5000+')} AS seq_len_bucket, {S.FOLD} AS fold FROM rows_all),
tf AS (SELECT * FROM feat WHERE is_train), p AS (SELECT avg(clicked) AS p, count(*)::DOUBLE AS n FROM tf), {S.FOLDS},
gf AS (SELECT gender, count(*) AS n FROM tf GROUP BY 1), nf AS (SELECT inventory_id, count(*) AS n FROM tf GROUP BY 1)"""


def _code_sql(c: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY CAST({c} AS VARCHAR)) - 1 AS INTEGER) AS {c}_cat"


def _recipe_sql(is_train: bool) -> str:
    te = ", ".join(
        (f"k{i} AS (SELECT held, {a}, {b}, sum(clicked) AS s, count(*) AS n FROM tf, folds WHERE fold <> held GROUP BY ALL)"
         if is_train else f"k{i} AS (SELECT {a}, {b}, sum(clicked) AS s, count(*) AS n FROM tf GROUP BY ALL)")
        for i, (a, b) in enumerate(PAIRS))
    te_cols = ", ".join(f"""round((coalesce(k{i}.s, 0) + 50 * p.p) / (coalesce(k{i}.n, 0) + 50), 6) AS "{a}__X__{b}_te" """
                        for i, (a, b) in enumerate(PAIRS))
    joins = " ".join(f"LEFT JOIN k{i} ON k{i}.{a} = r.{a} AND k{i}.{b} = r.{b}" + (f" AND k{i}.held = r.fold" if is_train else "")
                     for i, (a, b) in enumerate(PAIRS))
    codes = ", ".join(f"{c}_cat" for c in d.DICTIONARY_ENCODED)
    cross = ", ".join(f'CAST(CAST(r.{a} AS FLOAT) * CAST(r.{b} AS FLOAT) AS DOUBLE) AS "{a}_X_{b}"' for a, b in d.SEQ_CROSSES)
    first = "r.clicked" if is_train else 'CAST(r.row_idx AS VARCHAR) AS "ID"'
    return f"""WITH {_BASE}, codes AS (SELECT *, {', '.join(_code_sql(c) for c in d.DICTIONARY_ENCODED)} FROM feat), {te}
SELECT r.row_idx, {first}, r.day_of_week, r.hour, r.feat_e_3, r.history_a_6, r.history_b_11, r.history_b_22, r.history_b_23,
  round(sin(2 * pi() * CAST(r.day_of_week AS DOUBLE) / 7), 6) AS dow_sin, round(cos(2 * pi() * CAST(r.day_of_week AS DOUBLE) / 7), 6) AS dow_cos,
  CAST(r.day_of_week IN ('1', '7') AS INTEGER) AS is_weekend, round(sin(2 * pi() * CAST(r.hour AS DOUBLE) / 24), 6) AS hour_sin,
  round(cos(2 * pi() * CAST(r.hour AS DOUBLE) / 24), 6) AS hour_cos, seq_len, seq_first, seq_last, 1 AS seq_available, {cross},
  round(coalesce(gf.n, 0) / p.n, 6) AS gender_freq, round(coalesce(nf.n, 0) / p.n, 6) AS inventory_id_freq, {te_cols},
  CAST(r.feat_e_3 IS NULL AS INTEGER) AS feat_e_3_missing, {codes}
FROM codes r CROSS JOIN p LEFT JOIN gf ON gf.gender = r.gender LEFT JOIN nf ON nf.inventory_id = r.inventory_id {joins}
WHERE {'is_train' if is_train else 'NOT is_train'}"""


def _recipe(spark, sf, new: bool) -> DataFrame:
    recipe = Preprocessor()
    scratch = Scratch(spark)
    tr, te = (scratch.keep(recipe.prepare(x(spark, sf, True))) for x in (train, test))
    model = recipe.fit(tr, te, prepared=True)
    out = (model.transform_new(te, keep_key=True, prepared=True) if new
           else model.transform_train(tr, keep_key=True, prepared=True))
    rounded = [c for c in out.columns if c.endswith(("_te", "_freq", "_sin", "_cos"))]
    changes = {c: F.round(c, 6) for c in rounded}
    changes |= {c: F.col(c).cast("double") for c in out.columns if "_X_" in c and not c.endswith("_te")}
    changes |= {c: F.col(c).cast("int") for c in ("is_weekend", "feat_e_3_missing")}
    return out.withColumns(changes)


@query("preprocess_train", _recipe_sql(True))
def preprocess_train(spark, sf):
    return _recipe(spark, sf, False)


@query("preprocess_test", _recipe_sql(False))
def preprocess_test(spark, sf):
    return _recipe(spark, sf, True)
