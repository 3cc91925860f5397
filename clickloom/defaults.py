"""Default configuration.  Fixed values: they define the features, so they are stated literally."""

LABEL = "clicked"
ROW_KEY = "row_idx"
TEST_ID = "ID"
SEED = 42
FOLDS = 5

CATEGORICAL = ["gender", "age_group", "inventory_id", "day_of_week", "hour"]
FREQUENCY_ENCODED = ["gender", "inventory_id"]
TARGET_ENCODED_PAIRS = [
    ("gender", "age_group"),
    ("day_of_week", "hour"),
    ("inventory_id", "age_group"),
    ("inventory_id", "gender"),
]
DICTIONARY_ENCODED = ["gender", "age_group", "inventory_id", "time_period", "dow_hour", "seq_len_bucket"]
TARGET_ENCODING_WEIGHT = 50.0

# inclusive hour ranges
TIME_PERIODS = [
    (0, 4, "late_night"),
    (5, 9, "early_morning"),
    (10, 16, "daytime"),
    (17, 20, "evening"),
    (21, 23, "late_evening"),
]
WEEKEND_CODES = (1, 7)
SLICE_DAY = 7
EARLY_HOUR = 5

# a sequence shorter than the bound belongs to the label
SEQ_BUCKETS = [
    (10, "0-9"),
    (25, "10-24"),
    (50, "25-49"),
    (100, "50-99"),
    (250, "100-249"),
    (500, "250-499"),
    (1000, "500-999"),
    (2500, "1000-2499"),
    (5000, "2500-4999"),
]
SEQ_BUCKET_TOP = "5000+"
SEQ_BUCKETS_REPORT = [*SEQ_BUCKETS, (10000, "5000-9999")]
SEQ_BUCKET_REPORT_TOP = "10000+"
SEQ_CROSSES = [
    ("seq_len", "hour"),
    ("seq_len", "day_of_week"),
    ("seq_last", "day_of_week"),
    ("seq_last", "hour"),
]

NUMERIC_PREFIXES = [
    "l_feat_", "feat_a_", "feat_b_", "feat_c_", "feat_d_", "feat_e_", "history_a_", "history_b_",
]
FEATURE_GROUPS = [
    "history_a", "history_b", "feat_a", "feat_b", "feat_c", "feat_d", "feat_e", "l_feat", "seq",
]
MISSING_FLAGS = {
    "feat_a_all_missing": [f"feat_a_{i}" for i in range(1, 19)],
    "feat_e_3_missing": ["feat_e_3"],
    "other_all_missing": [
        "l_feat_2", "l_feat_8", "l_feat_18", "l_feat_19", "l_feat_20", "l_feat_21", "l_feat_22", "l_feat_23", "l_feat_24",
    ],
}
COLLINEAR = [
    "history_b_3", "history_b_4", "history_b_5", "history_b_16", "history_b_18", "history_b_21", "history_b_24",
    "l_feat_16", "l_feat_17", "l_feat_20", "l_feat_23",
]

STRATA = ["inventory_id", "day_of_week", "hour", "device"]
NEGATIVE_RATIO = 4.0

HISTORY_PAIRS = [
    ("history_a_6", "history_b_11", "day7_hist_a6_b11_delta"),
    ("history_a_6", "history_b_22", "day7_hist_a6_b22_delta"),
    ("history_a_6", "history_b_23", "day7_hist_a6_b23_delta"),
]
HISTORY_BINS = 24
SMOOTHING_ALPHA = 100.0
MIN_COUNT = 50

TEMPERATURE = 1.75
