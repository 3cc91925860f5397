"""Features of a comma-separated behaviour sequence, all evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from clickloom import defaults as d


def seq_length(seq: str = "seq", null_as_zero: bool = False) -> Column:
    """Commas plus one; a null sequence has a null length, or zero in the report variant.

    Bytes lost when the commas are removed: no list is built, however long the sequence.
    """
    text = F.col(seq).cast("string")
    length = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(","), F.lit(""))) + 1
    return F.coalesce(length, F.lit(0)) if null_as_zero else length


def bucket(value: Column, cuts: Iterable[tuple[int, str]], top: str) -> Column:
    """Label of the first bound above the value; null falls through to the top label.

    Pass a stored column: the chain evaluates its value once per bound.
    """
    expr = None
    for bound, name in cuts:
        expr = F.when(value < bound, name) if expr is None else expr.when(value < bound, name)
    return F.lit(top) if expr is None else expr.otherwise(top)


def seq_len_bucket(length: Column) -> Column:
    """ten labels; a null length lands in the top one."""
    return bucket(length, d.SEQ_BUCKETS, d.SEQ_BUCKET_TOP)


def seq_report_bucket(length: Column) -> Column:
    """eleven labels over a length that is never null."""
    return bucket(length, d.SEQ_BUCKETS_REPORT, d.SEQ_BUCKET_REPORT_TOP)


def _digits(text: Column, pattern: str) -> Column:
    # regexp_extract gives '' for no match; \z is the true end of the text, unlike $
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("int")


def add_seq_features(df: DataFrame, seq: str = "seq") -> DataFrame:
    """length, first and last token, constant availability flag and length bucket."""
    if seq not in df.columns:
        return df
    text = F.col(seq).cast("string")
    return df.withColumns({
        "seq_len": seq_length(seq),
        "seq_first": _digits(text, r"^([0-9]+)"),
        # trailing digits hold no comma, so the part after the last comma is enough for the pattern
        "seq_last": _digits(F.substring_index(text, ",", -1), r"([0-9]+)\z"),
        "seq_available": F.lit(1),
    }).withColumn("seq_len_bucket", seq_len_bucket(F.col("seq_len")))


def add_seq_crosses(df: DataFrame, crosses: Iterable[tuple[str, str]] = d.SEQ_CROSSES) -> DataFrame:
    """F8: products of numeric columns in single precision; pairs with an absent side are skipped."""
    new = {
        f"{a}_X_{b}": F.col(a).try_cast("float") * F.col(b).try_cast("float")
        for a, b in crosses if a in df.columns and b in df.columns
    }
    return df.withColumns(new) if new else df


_STATS = ["mean", "std", "min", "max", "len", "sum", "median"]


def add_seq_stats(df: DataFrame, seq: str = "seq", prefix: str = "seq_") -> DataFrame:
    """mean, population std, min, max, length, sum and median of the parsed tokens.

    A null, empty or unparsable sequence gives zeros throughout.  Spaces around tokens and one trailing
    comma are tolerated.  Only digits, signs, points, exponents, commas and blanks count as parsable,
    because a Java cast would also accept suffixes such as ``5d``.
    """
    text = F.trim(F.col(seq).cast("string"))
    text = F.when(text.endswith(","), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    clean = F.length(F.translate(text, "0123456789.,+-eE \t", "")) == 0
    # a stored column per step, so that no step is evaluated twice; a token that is no number is null and
    # makes the sum null
    df = df.withColumn("_tokens", F.when(clean, F.split(text, ",").try_cast("array<double>")))
    x = F.col("_tokens")
    df = df.withColumn("_sum", F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v))
    n = F.size(x).cast("double")
    df = df.withColumns({"_mean": F.col("_sum") / n, "_ordered": F.sort_array(x)})
    mean, ordered = F.col("_mean"), F.col("_ordered")
    df = df.withColumn("_sq", F.aggregate(x, F.lit(0.0), lambda acc, v: acc + (v - mean) * (v - mean)))
    half = F.floor(F.size(ordered) / 2).cast("int")
    middle = F.when(F.size(ordered) % 2 == 1, F.element_at(ordered, half + 1)).otherwise(
        (F.element_at(ordered, half) + F.element_at(ordered, half + 1)) / 2)
    values = {
        "mean": mean,
        "std": F.sqrt(F.col("_sq") / n),
        "min": F.element_at(ordered, 1),
        "max": F.element_at(ordered, -1),
        "len": n,
        "sum": F.col("_sum"),
        "median": middle,
    }
    df = df.withColumns({
        prefix + k: F.when(F.col("_sum").isNull(), F.lit(0.0)).otherwise(values[k]) for k in _STATS
    })
    return df.drop("_tokens", "_sum", "_mean", "_ordered", "_sq")


def unique_count(seq: str = "seq") -> Column:
    """M1: number of different tokens."""
    return F.size(F.array_distinct(F.split(F.col(seq).cast("string"), ",")))


def diversity_ratio(seq: str = "seq") -> Column:
    """M1: different tokens divided by tokens."""
    return unique_count(seq) / seq_length(seq)


def clip_length(length: Column, limit: int = 5000) -> Column:
    """M3: sequence length clipped at an outlier bound."""
    return F.when(length.isNotNull(), F.least(length, F.lit(limit)))
