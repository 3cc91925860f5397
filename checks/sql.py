"""Common table expressions of the oracle SQL: the impression tables, built without any of our code."""

from __future__ import annotations

FOLD = "CAST(('0x' || substr(md5('42|' || row_idx), 1, 8))::BIGINT % 5 AS INTEGER)"
DRAW = "('0x' || substr(md5('42|' || row_idx), 1, 15))::BIGINT"
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
WORDS = "array_to_string([length(t) for t in string_split(text, ' ')], ',')"

EVENTS = f"""imp0 AS (
  SELECT event_id AS row_idx, CAST(event_type = 'click' AS INTEGER) AS clicked,
    CASE WHEN event_id % 97 <> 0 THEN CAST(user_id % 3 AS INTEGER) END AS gender,
    CAST(user_id % 8 AS VARCHAR) AS age_group, CAST({K} AS VARCHAR) AS inventory_id,
    CAST(isodow(ts) AS VARCHAR) AS day_of_week, strftime(ts, '%H') AS hour,
    CASE WHEN event_id % 10 <> 3 THEN value END AS feat_e_3,
    CASE WHEN event_id % 53 <> 0 THEN CAST({K} % 17 AS DOUBLE) END AS history_a_6,
    floor(value) AS history_b_11,
    CASE WHEN event_id % 41 <> 0 THEN CAST(event_id % 97 AS DOUBLE) END AS history_b_22,
    CAST(event_id % 23 AS DOUBLE) AS history_b_23,
    {K} < 10 AS low_k, CAST(value + user_id > 90 AS INTEGER) AS learnable, ts
  FROM events)"""
IMP = EVENTS + ", imp AS (SELECT * FROM imp0)"
IMP_SEQ = EVENTS + f""", words AS (SELECT doc_id, {WORDS} AS seq FROM documents),
imp AS (SELECT imp0.*, CASE WHEN row_idx % 71 <> 7 THEN words.seq END AS seq FROM imp0 LEFT JOIN words ON words.doc_id = imp0.row_idx // 10)"""
# the rare label
RARE = EVENTS + ", imp AS (SELECT * REPLACE (CASE WHEN low_k THEN clicked ELSE 0 END AS clicked) FROM imp0)"
TRAIN = "train AS (SELECT * FROM imp WHERE ts < TIMESTAMP '2024-01-28')"
TEST = "test AS (SELECT * FROM imp WHERE ts >= TIMESTAMP '2024-01-28')"
FILL = ("* REPLACE (coalesce(gender, -1) AS gender, coalesce(age_group, 'Unknown') AS age_group, "
        "coalesce(inventory_id, 'Unknown') AS inventory_id, coalesce(day_of_week, 'Unknown') AS day_of_week, "
        "coalesce(hour, 'Unknown') AS hour)")
FOLDED = f"folded AS (SELECT *, {FOLD} AS fold FROM train)"
FOLDS = "folds AS (SELECT unnest([0, 1, 2, 3, 4]) AS held)"

SEQS = f"""seqs AS (
  SELECT d.doc_id AS row_idx, CASE WHEN d.doc_id % 67 <> 5 THEN {WORDS} END AS seq,
    CAST(coalesce(l.toxic, 0) AS INTEGER) AS clicked
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
LEN = "length(seq) - length(replace(seq, ',', '')) + 1"

SCORED = RARE + """, scored AS (
  SELECT row_idx, clicked, ('0x' || substr(md5('7|' || row_idx), 1, 4))::BIGINT / 65536.0::DOUBLE AS score FROM imp)"""

FEATURES = ["feat_a_1", "feat_a_2", "feat_b_1", "feat_c_1", "feat_d_1", "feat_e_3",
            "history_a_1", "history_a_2", "history_b_1", "history_b_2", "history_b_3", "l_feat_1"]
FT = """ft AS (
  SELECT CAST(l_quantity > 30 AND l_discount < 0.05 AND l_returnflag = 'R' AS INTEGER) AS clicked,
    l_discount AS feat_a_1, l_tax AS feat_a_2, CAST(l_partkey AS DOUBLE) AS feat_b_1,
    CAST(l_suppkey AS DOUBLE) AS feat_c_1, CAST(l_linenumber AS DOUBLE) AS feat_d_1,
    CASE WHEN l_orderkey % 10 <> 3 THEN l_discount * l_extendedprice END AS feat_e_3,
    l_quantity AS history_a_1, l_extendedprice AS history_a_2,
    l_extendedprice * (1 - l_discount) AS history_b_1,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS history_b_2, l_quantity * 2 + 1 AS history_b_3,
    CAST(dayofyear(l_shipdate) AS DOUBLE) AS l_feat_1
  FROM lineitem)"""
_wide = ", ".join(f"corr({a}, {b}) AS c{i}_{j}" for i, a in enumerate(FEATURES)
                  for j, b in enumerate(FEATURES) if i < j)
_pairs = " UNION ALL ".join(f"SELECT '{a}' AS feature1, '{b}' AS feature2, c{i}_{j} AS correlation FROM pw"
                            for i, a in enumerate(FEATURES) for j, b in enumerate(FEATURES) if i < j)
PAIRS = f"pw AS MATERIALIZED (SELECT {_wide} FROM ft), pairs AS MATERIALIZED ({_pairs})"
_twide = ", ".join(f"corr({a}, clicked) AS t{i}" for i, a in enumerate(FEATURES))
_targets = " UNION ALL ".join(f"SELECT '{a}' AS feature, t{i} AS correlation FROM tw" for i, a in enumerate(FEATURES))
TARGETS = (f"tw AS MATERIALIZED (SELECT {_twide} FROM ft), "
           f"targets AS MATERIALIZED (SELECT *, abs(correlation) AS a FROM ({_targets}))")
RANKED = "ranked AS (SELECT *, row_number() OVER (ORDER BY a DESC, feature) AS rnk FROM targets)"
GROUPS = ["history_a", "history_b", "feat_a", "feat_b", "feat_c", "feat_d", "feat_e", "l_feat", "seq"]


def group_of(column: str) -> str:
    cases = " ".join(f"WHEN starts_with({column}, '{g}_') THEN '{g}'" for g in GROUPS)
    return f"CASE {cases} ELSE 'others' END"


def buckets(value: str, top: str, extra: bool = False) -> str:
    cuts = [(10, "0-9"), (25, "10-24"), (50, "25-49"), (100, "50-99"), (250, "100-249"), (500, "250-499"),
            (1000, "500-999"), (2500, "1000-2499"), (5000, "2500-4999")]
    if extra:
        cuts.append((10000, "5000-9999"))
    return "CASE " + " ".join(f"WHEN {value} < {c} THEN '{n}'" for c, n in cuts) + f" ELSE '{top}' END"


PERIOD = ("CASE WHEN CAST(hour AS INTEGER) BETWEEN 0 AND 4 THEN 'late_night' "
          "WHEN CAST(hour AS INTEGER) BETWEEN 5 AND 9 THEN 'early_morning' "
          "WHEN CAST(hour AS INTEGER) BETWEEN 10 AND 16 THEN 'daytime' "
          "WHEN CAST(hour AS INTEGER) BETWEEN 17 AND 20 THEN 'evening' "
          "WHEN CAST(hour AS INTEGER) BETWEEN 21 AND 23 THEN 'late_evening' ELSE 'other' END")
# ordinal of the length bucket, as a stand-in for its dictionary code
SEQ_CODE = " + ".join(f"CAST({LEN} >= {c} AS INTEGER)" for c in (10, 25, 50, 100, 250, 500, 1000, 2500, 5000))
