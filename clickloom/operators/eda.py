"""Profile tables of an impression table and their Markdown report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickloom import defaults as d
from clickloom.functions.calendar import report_phase
from clickloom.functions.sequence import bucket, diversity_ratio, seq_length, seq_report_bucket
from clickloom.operators.order_stats import order_statistics


def _rates(label: str) -> list[Column]:
    return [F.count("*").alias("rows"), F.sum(label).alias("clicks"), F.avg(label).alias("click_rate")]


def table_summary(df: DataFrame) -> DataFrame:
    """Row and column count; Parquet answers the count from its footers."""
    return df.agg(F.count("*").alias("num_rows")).withColumn("num_columns", F.lit(len(df.columns)))


def overview(df: DataFrame, label: str = d.LABEL) -> DataFrame:
    """Rows, clicks and click rate as formatted strings."""
    return df.agg(*_rates(label)).select(F.inline(F.array(
        F.struct(F.lit("rows").alias("metric"), F.format_number("rows", 0).alias("value")),
        F.struct(F.lit("clicks").alias("metric"), F.format_number("clicks", 0).alias("value")),
        F.struct(F.lit("click_rate").alias("metric"), F.format_string("%.6f", "click_rate").alias("value")))))


def rates_by(df: DataFrame, keys: Sequence[str], label: str = d.LABEL, digits: int | None = 6) -> DataFrame:
    """Rows, clicks and click rate per key combination, in key order."""
    table = df.groupBy(*keys).agg(*_rates(label))
    if digits is not None:
        table = table.withColumn("click_rate", F.round("click_rate", digits))
    return table.orderBy(*keys)


def cyclic_by(df: DataFrame, column: str, period: int, origin: int = 0, label: str = d.LABEL) -> DataFrame:
    """Rows, click rate and mean sine and cosine per value."""
    phase = report_phase(column, period, origin)
    return df.groupBy(column).agg(
        F.count("*").alias("rows"), F.round(F.avg(label), 6).alias("click_rate"),
        F.round(F.avg(F.sin(phase)), 6).alias("mean_sin"), F.round(F.avg(F.cos(phase)), 6).alias("mean_cos"),
    ).orderBy(column)


def with_seq_length(df: DataFrame, seq: str = "seq") -> DataFrame:
    return df.withColumn("seq_length", seq_length(seq, null_as_zero=True))


def seq_length_summary(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Mean, exact median, range and nearest-rank quartiles; a null sequence has length 0.

    One scan counts the rows per length; everything else reads that small table.
    """
    cells = with_seq_length(df, seq).groupBy("seq_length").agg(F.count("*").alias("n")).persist()
    kinds = {0.25: "nearest", 0.5: "linear", 0.75: "nearest"}
    ranks = order_statistics(cells, {"seq_length": list(kinds)}, kinds, weight="n")
    plain = cells.agg(F.round(F.sum(F.col("seq_length") * F.col("n")) / F.sum("n"), 2).alias("mean"),
                      F.min("seq_length").alias("min"), F.max("seq_length").alias("max"))
    at = {q: F.max(F.when(F.col("q") == q, F.col("value"))) for q in kinds}
    both = plain.select("*", F.lit(True).alias("_one")).join(
        ranks.agg(at[0.5].alias("median"), at[0.25].alias("q1"), at[0.75].alias("q3")).withColumn("_one", F.lit(True)),
        "_one")
    return both.select("mean", "median", "min", "max", "q1", "q3")


def seq_bucket_rates(df: DataFrame, seq: str = "seq", label: str = d.LABEL) -> DataFrame:
    """Click rate per length bucket, most rows first."""
    table = with_seq_length(df, seq).groupBy(seq_report_bucket(F.col("seq_length")).alias("seq_bucket")).agg(*_rates(label))
    return table.withColumn("click_rate", F.round("click_rate", 6)).orderBy(F.desc("rows"), "seq_bucket")


DIVERSITY_CUTS = [(0.1, "<0.1"), (0.2, "0.1-0.2"), (0.4, "0.2-0.4"), (0.6, "0.4-0.6")]


def diversity_rates(df: DataFrame, seq: str = "seq", label: str = d.LABEL) -> DataFrame:
    """M1: click rate per band of the share of different tokens; rows without a sequence are left out."""
    rated = df.where(F.col(seq).isNotNull()).withColumn("_ratio", diversity_ratio(seq))
    named = rated.withColumn("diversity_bucket", bucket(F.col("_ratio"), DIVERSITY_CUTS, ">=0.6"))
    return rates_by(named, ["diversity_bucket"], label)


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """M2: share of nulls per column, all columns in one pass."""
    columns = list(columns or df.columns)
    shares = df.agg(F.array(*[
        F.struct(F.lit(c).alias("column"), F.avg(F.col(c).isNull().cast("double")).alias("missing_rate"))
        for c in columns]).alias("t"))
    return shares.select(F.inline("t"))


def to_markdown(df: DataFrame, digits: int = 6, max_rows: int = 10_000) -> str:
    """A small, already aggregated table as Markdown."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError("only aggregated tables are formatted as Markdown")
    if not rows:
        return "_no data_"
    text = lambda v: f"{v:.{digits}f}" if isinstance(v, float) else str(v)
    lines = [df.columns, ["---"] * len(df.columns), *[[text(v) for v in r] for r in rows]]
    return "\n".join("| " + " | ".join(line) + " |" for line in lines)


def report(train: DataFrame, sample: DataFrame | None = None, source: str = "", generated: str = "",
           label: str = d.LABEL) -> str:
    """The whole profile.  Day and hour tables share one scan through their common cells."""
    sample = train if sample is None else sample
    cells = train.groupBy("day_of_week", "hour").agg(F.count("*").alias("_n"), F.sum(label).alias("_y")).persist()

    def calendar(column: str) -> DataFrame:
        table = cells.groupBy(column).agg(F.sum("_n").alias("rows"), F.sum("_y").alias("clicks"))
        return table.withColumn("click_rate", F.round(F.col("clicks") / F.col("rows"), 6)).orderBy(column)

    def cyclic(column: str, period: int, origin: int) -> DataFrame:
        phase = report_phase(column, period, origin)
        return calendar(column).drop("clicks").withColumns({
            "mean_sin": F.round(F.sin(phase), 6), "mean_cos": F.round(F.cos(phase), 6)})

    total = cells.agg(F.sum("_n").alias("rows"), F.sum("_y").alias("clicks")).first()
    rate = total["clicks"] / total["rows"] if total["rows"] else 0.0
    sections = [
        "# Impression profile",
        f"- generated: {generated}",
        f"- source: `{source}`",
        "\n## Overview",
        "\n".join(["| metric | value |", "| --- | --- |", f"| rows | {total['rows']:,} |",
                   f"| clicks | {total['clicks']:,} |", f"| click_rate | {rate:.6f} |"]),
        "\n## Clicks by day_of_week", to_markdown(calendar("day_of_week")),
        "\n## Clicks by hour", to_markdown(calendar("hour")),
        "\n## Sequence length", to_markdown(seq_length_summary(sample), 2),
        "\n### Clicks by sequence length", to_markdown(seq_bucket_rates(sample, label=label)),
        "\n## Cyclical encoding by day", to_markdown(cyclic("day_of_week", 7, 1)),
        "\n## Cyclical encoding by hour", to_markdown(cyclic("hour", 24, 0)),
    ]
    cells.unpersist()
    return "\n".join(sections) + "\n"
