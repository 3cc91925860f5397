"""Exact order statistics and cumulative sums without a single-task sort.

Values are cut into ranges of roughly equal size at approximate quantiles.  The approximation only
decides how evenly the work is spread; the results are exact for any cut points.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.session import ONE_TASK_ROWS

RANGES = 256
MOST_RANGES = 10_000


def ranges_for(rows: int) -> int:
    """Ranges that one task each can sort, as far as the driver can hold their cut points."""
    return min(MOST_RANGES, max(RANGES, -(-rows // ONE_TASK_ROWS)))


def cut_points(df: DataFrame, columns: Iterable[str], ranges: int = RANGES) -> dict[str, list[float]]:
    """Inner cut points per column: one aggregate over the data, at most ``ranges - 1`` numbers each."""
    columns = list(columns)
    probs = [i / ranges for i in range(1, ranges)]
    found = df.agg(*[
        F.percentile_approx(F.col(c).cast("double"), probs, 20 * ranges).alias(c) for c in columns
    ]).first()
    return {c: sorted({v for v in (found[c] or []) if math.isfinite(v)}) for c in columns}


def with_range(df: DataFrame, cuts: Mapping[str, list[float]], suffix: str = "_range") -> DataFrame:
    """Add the index of the range each value falls into (binary search over the cut points)."""
    columns = list(cuts)
    splits = [[-math.inf, *(cuts[c] or [0.0]), math.inf] for c in columns]
    doubles = df.withColumns({f"{c}{suffix}_in": F.col(c).cast("double") for c in columns})
    cut = Bucketizer(splitsArray=splits, inputCols=[f"{c}{suffix}_in" for c in columns],
                     outputCols=[f"{c}{suffix}_out" for c in columns], handleInvalid="keep").transform(doubles)
    return cut.withColumns({f"{c}{suffix}": F.col(f"{c}{suffix}_out").cast("int") for c in columns}).drop(
        *[f"{c}{suffix}_{e}" for c in columns for e in ("in", "out")])


def _long(df: DataFrame, cuts: Mapping[str, list[float]], weight: str | None) -> DataFrame:
    """One row (column, range, value, n) per non-null value; n rows stand behind it."""
    n = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    picked = df.select(*cuts, n.alias("_weight"))
    cut = with_range(picked, cuts) if any(cuts.values()) else picked.withColumns(
        {f"{c}_range": F.lit(0) for c in cuts})
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"{c}_range").alias("range"),
                      F.col(c).cast("double").alias("value"), F.col("_weight").alias("n")) for c in cuts]
    return cut.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def value_counts(df: DataFrame, columns: Iterable[str], weight: str | None = None) -> tuple[int, dict[str, int]]:
    """Rows to sort, and non-null rows per column."""
    columns = list(columns)
    rows = F.sum(F.when(F.col(weight) > 0, F.lit(1))) if weight else F.count("*")
    per_column = [F.sum(F.when(F.col(c).isNotNull(), F.col(weight))) if weight else F.count(c) for c in columns]
    first = df.agg(rows, *per_column).first()
    return first[0] or 0, {c: first[i + 1] or 0 for i, c in enumerate(columns)}


# Size of the quantile sketches; the rank error is about 0.13 % then, and a wanted rank is bracketed by three times that.
SKETCH_K, SKETCH_MARGIN = 4096, 0.004


@dataclass
class Summary:
    """One row about a table: its rows, per column the non-null rows and their sum, and where their quantiles lie."""

    rows: int
    counts: dict[str, int]
    sums: dict[str, float]
    sketches: DataFrame  # one row, a sketch per column

    def brackets(self, ranks: Mapping[str, Iterable[int]],
                 always: bool = False) -> dict[str, list[tuple[float | None, float | None]]]:
        """Disjoint ranges of values, in order, that hold the wanted ranks unless a sketch errs; None is open.

        A table that one task can sort has a single range for all, unless ``always`` is set.
        """
        shares, asked = {}, []
        for c, wanted in ranges_of(ranks):
            n = self.counts[c]
            if not always and self.rows * len(self.counts) <= ONE_TASK_ROWS:
                shares[c] = [(0.0, 1.0)]
                continue
            merged: list[tuple[float, float]] = []
            for r in sorted(set(wanted)):
                low, high = r / n - SKETCH_MARGIN, (r + 1) / n + SKETCH_MARGIN
                if merged and low <= merged[-1][1]:
                    merged[-1] = (merged[-1][0], high)
                else:
                    merged.append((low, high))
            shares[c] = merged
            asked += [F.kll_sketch_get_quantile_double(f"`{c}`", F.array(*[
                F.lit(float(min(max(x, 0.0), 1.0))) for pair in merged for x in pair])).alias(c)]
        found = self.sketches.select(*asked).first().asDict() if asked else {}
        out = {}
        for c, pairs in shares.items():
            values = found.get(c)
            out[c] = joined([(None if low <= 0 else values[2 * i], None if high >= 1 or math.isinf(values[2 * i + 1])
                              else values[2 * i + 1]) for i, (low, high) in enumerate(pairs)])
        return out

    def release(self) -> None:
        self.sketches.unpersist()


def ranges_of(ranks: Mapping[str, Iterable[int]]) -> list[tuple[str, list[int]]]:
    return [(c, list(r)) for c, r in ranks.items() if list(r)]


def joined(ranges: list[tuple[float | None, float | None]]) -> list[tuple[float | None, float | None]]:
    """Ranges in order, overlapping ones as one."""
    out: list[tuple[float | None, float | None]] = []
    for low, high in ranges:
        if out and (out[-1][1] is None or low is None or low <= out[-1][1]):
            last = out.pop()
            low, high = last[0], None if high is None or last[1] is None else max(high, last[1])
        out.append((low, high))
    return out


def summarise(df: DataFrame, columns: Iterable[str]) -> Summary:
    """One scan: counts, sums and quantile sketches of all columns, merged in two levels."""
    columns = list(columns)
    value = {c: F.col(c).cast("double") for c in columns}
    # a NaN is larger than all numbers, and sketches would skip it
    parts = df.groupBy((F.spark_partition_id() % 64).alias("_part")).agg(
        F.count("*").alias("_rows"), *[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)],
        *[F.sum(value[c]).alias(f"_s{i}") for i, c in enumerate(columns)],
        *[F.kll_sketch_agg_double(F.nanvl(value[c], F.lit(math.inf)), F.lit(SKETCH_K)).alias(f"_k{i}")
          for i, c in enumerate(columns)])
    whole = parts.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"), *[F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"_n{i}") for i in range(len(columns))],
        *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(columns))],
        *[F.kll_merge_agg_double(f"_k{i}").alias(c) for i, c in enumerate(columns)]).persist()
    row = whole.select("_rows", *[f"_n{i}" for i in range(len(columns))], *[f"_s{i}" for i in range(len(columns))]).first()
    return Summary(row["_rows"], {c: row[f"_n{i}"] for i, c in enumerate(columns)},
                   {c: row[f"_s{i}"] for i, c in enumerate(columns)}, whole.select(*[f"`{c}`" for c in columns]))


def values_at(df: DataFrame, ranks: Mapping[str, Iterable[int]], summary: Summary,
              always: bool = False) -> dict[str, dict[int, float]]:
    """The values at zero-based ranks of the sorted non-null values of every column, exactly.

    One scan counts the rows between the brackets and the values inside them.  The rows before a bracket say whether it
    holds the rank; where a sketch has erred, the scan is repeated with the gap that does.
    """
    left = dict(ranges_of(ranks))
    brackets = summary.brackets(left, always)
    out: dict[str, dict[int, float]] = {c: {} for c in ranks}
    while left:
        cells = []
        for c in left:
            v = F.col(c).cast("double")
            # even cells are gaps, odd ones the brackets between them
            cell = F.lit(0)
            for low, high in brackets[c]:
                cell = cell + (F.lit(1) if low is None else F.when(v >= F.lit(low), 1).otherwise(0))
                cell = cell + (F.lit(0) if high is None else F.when(v > F.lit(high), 1).otherwise(0))
            cells.append(F.struct(F.lit(c).alias("column"), cell.alias("cell"), v.alias("value")))
        long = df.select(F.inline(F.array(*cells))).where("value is not null")
        counted = long.groupBy("column", "cell", F.when(F.col("cell") % 2 == 1, F.col("value")).alias("value")).agg(
            F.count("*").alias("n")).persist()
        sizes: dict[str, dict[int, tuple[int, int]]] = {c: {} for c in left}
        for r in counted.groupBy("column", "cell").agg(F.sum("n").alias("n"), F.count("*").alias("values")).collect():
            sizes[r["column"]][r["cell"]] = (r["n"], r["values"])
        requests, again = [], {}
        for c, wanted in left.items():
            for rank in wanted:
                before = 0
                for cell in sorted(sizes[c]):
                    n, values = sizes[c][cell]
                    if rank < before + n:
                        if cell % 2:
                            requests.append((c, cell, rank - before, rank, values))
                        else:
                            again.setdefault(c, {}).setdefault(cell, []).append(rank)
                        break
                    before += n
        for column, rank, value in _picked(counted.where("value is not null"), requests):
            out[column][rank] = value
        counted.unpersist()
        left = {c: [r for rs in gaps.values() for r in rs] for c, gaps in again.items()}
        brackets = {c: joined([(None if cell == 0 else brackets[c][cell // 2 - 1][1],
                                None if cell // 2 >= len(brackets[c]) else brackets[c][cell // 2][0])
                               for cell in sorted(gaps)]) for c, gaps in again.items()}
    return out


def _picked(counted: DataFrame, requests: list[tuple[str, int, int, int, int]]) -> list[tuple[str, int, float]]:
    """(column, rank, value) for requests (column, cell, rank in the cell, rank, values of the cell)."""
    if not requests:
        return []
    spark = counted.sparkSession
    asked = spark.createDataFrame([r[:4] for r in requests], "column string, cell int, at long, rank long")
    keys = ["column", "cell"]
    rows = counted.select("column", F.col("cell").cast("int").alias("cell"), "value", "n", F.lit(0).alias("sub"))
    most = max(r[4] for r in requests)
    if most > ONE_TASK_ROWS:
        # a cell with more values than one task sorts is cut at its own quantiles
        pieces = min(MOST_RANGES, -(-2 * most // ONE_TASK_ROWS))
        cuts = rows.groupBy(*keys).agg(F.percentile_approx(
            "value", [i / pieces for i in range(1, pieces)] or [0.5], 20 * max(pieces, 50)).alias("cuts"))
        rows = rows.join(F.broadcast(cuts), keys).withColumn(
            "sub", F.size(F.filter("cuts", lambda x: x < F.col("value")))).drop("cuts")
        subs = rows.groupBy(*keys, "sub").agg(F.sum("n").alias("c"))
        before = Window.partitionBy(*keys).orderBy("sub")  # one row per piece
        asked = subs.withColumn("upto", F.sum("c").over(before)).join(F.broadcast(asked), keys).where(
            (F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("c"))).select(
            *keys, "sub", (F.col("at") - F.col("upto") + F.col("c")).alias("at"), "rank")
    else:
        asked = asked.withColumn("sub", F.lit(0))
    hit = rows.join(F.broadcast(asked.select(*keys, "sub").distinct()), [*keys, "sub"])
    w = Window.partitionBy(*keys, "sub").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    found = hit.withColumn("upto", F.sum("n").over(w)).join(F.broadcast(asked), [*keys, "sub"]).where(
        (F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("n")))
    return [(r["column"], r["rank"], r["value"]) for r in found.select("column", "rank", "value").collect()]


def nearest_rank(n: int, q: float) -> int:
    """Zero-based rank of the nearest-rank quantile; halves go to the even rank."""
    return min(max(round((n - 1) * q), 0), n - 1)


def _wanted(n: int, q: float, kind: str) -> list[tuple[int, float]]:
    """Ranks to read and the weight of each in the result."""
    if kind == "nearest":
        return [(nearest_rank(n, q), 1.0)]
    at = (n - 1) * q
    low = math.floor(at)
    part = at - low
    return [(low, 1.0)] if part == 0 else [(low, 1.0 - part), (low + 1, part)]


def order_statistics(df: DataFrame, probs: Mapping[str, Iterable[float]], kind: str | Mapping[float, str] = "nearest",
                     weight: str | None = None, ranges: int | None = None,
                     totals: Mapping[str, int] | None = None) -> DataFrame:
    """Exact quantiles of several columns as rows ``(column, q, value)``; nulls are ignored.

    ``kind`` is "nearest" (an element of the data) or "linear" (interpolated; q = 0.5 is the median), for
    all quantiles or per quantile.
    ``weight`` names a column that says how many rows stand behind each row of ``df``.  ``totals``, the
    non-null rows per column, spares step 1 when they are known.

    Rows that count once are read twice, see :func:`values_at`.  With weights, or a given number of ranges:
    1. rows per column; a table that one task can sort needs no cuts.  Otherwise 2. approximate cut points
    and 3. rows per (column, range), both tiny results.  4. Only the ranges that hold a wanted rank are
    grouped by value and ranked, each range on its own.  Equal values collapse in the partial aggregation,
    so one dominating value costs a single row.
    """
    spark = df.sparkSession
    columns = list(probs)
    if weight is None and ranges is None and totals is None:
        return _from_two_scans(df, probs, kind)
    if totals is None:
        rows, totals = value_counts(df, columns, weight)
    else:
        rows = max(totals.values(), default=0)
    if ranges is None:
        ranges = 1 if rows * len(columns) <= ONE_TASK_ROWS else ranges_for(rows)
    cuts = cut_points(df, columns, ranges) if ranges > 1 else {c: [] for c in columns}
    sizes: dict[str, dict[int, int]] = {c: {} for c in columns}
    if any(cuts.values()):
        for r in _long(df, cuts, weight).groupBy("column", "range").agg(F.sum("n").alias("n")).collect():
            sizes[r["column"]][r["range"]] = r["n"]
    else:
        sizes = {c: {0: totals[c]} for c in columns}

    wanted = []
    for c in columns:
        for q in probs[c]:
            how = kind if isinstance(kind, str) else kind[q]
            for rank, share in (_wanted(totals[c], q, how) if totals[c] else []):
                before = 0
                for rng in sorted(sizes[c]):
                    if rank < before + sizes[c][rng]:
                        wanted.append((c, float(q), rng, rank - before, share))
                        break
                    before += sizes[c][rng]
    requests = spark.createDataFrame(wanted, "column string, q double, range int, rank long, share double")

    narrow = F.lit(False)
    for c in columns:
        hit = sorted({rng for name, _, rng, _, _ in wanted if name == c})
        if hit:
            narrow = narrow | ((F.col("column") == c) & F.col("range").isin(hit))
    cells = _long(df, cuts, weight).where(narrow).groupBy("column", "range", "value").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("column", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = cells.withColumn("upto", F.sum("n").over(w))
    # the request list has at most two rows per column and quantile
    return (
        ranked.join(F.broadcast(requests), ["column", "range"])
        .where((F.col("rank") >= F.col("upto") - F.col("n")) & (F.col("rank") < F.col("upto")))
        .groupBy("column", "q").agg(F.sum(F.col("share") * F.col("value")).alias("value"))
    )


def _from_two_scans(df: DataFrame, probs: Mapping[str, Iterable[float]], kind: str | Mapping[float, str]) -> DataFrame:
    summary = summarise(df, probs)
    parts = {c: {float(q): _wanted(summary.counts[c], q, kind if isinstance(kind, str) else kind[q]) for q in qs}
             for c, qs in probs.items() if summary.counts[c]}
    found = values_at(df, {c: [r for ws in qs.values() for r, _ in ws] for c, qs in parts.items()}, summary)
    summary.release()
    rows = [(c, q, sum(share * found[c][r] for r, share in ws)) for c, qs in parts.items() for q, ws in qs.items()]
    return df.sparkSession.createDataFrame(rows, "column string, q double, value double")


def medians(df: DataFrame, columns: Iterable[str], ranges: int | None = None,
            totals: Mapping[str, int] | None = None) -> dict[str, float]:
    """Exact medians of a fixed list of columns, on the driver (one number per column)."""
    rows = order_statistics(df, {c: [0.5] for c in columns}, "linear", ranges=ranges, totals=totals).collect()
    return {r["column"]: r["value"] for r in rows}


def running_sums(cells: DataFrame, range_col: str, order: list[Column], sums: Mapping[str, str],
                 groups: Iterable[str] = (), descending: bool = False) -> DataFrame:
    """Inclusive cumulative sums over ``(range, order)`` within ``groups``.

    Each (group, range) is summed on its own; the totals of the ranges before it, at most one row per
    group and range, are added from a broadcast.  ``cells`` must hold one row per ordering value, and
    ``groups`` must be a short list such as report stages.
    """
    groups = list(groups)
    inner = Window.partitionBy(*groups, range_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    first = F.col(range_col).desc() if descending else F.col(range_col).asc()
    if groups:
        outer = Window.partitionBy(*groups).orderBy(first)
    else:
        outer = Window.partitionBy(F.lit(0)).orderBy(first)  # as many rows as there are ranges
    totals = cells.groupBy(*groups, range_col).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    before = totals.select(*groups, range_col, *[
        (F.sum(f"_t_{n}").over(outer) - F.col(f"_t_{n}")).alias(f"_b_{n}") for n in sums])
    local = cells.withColumns({n: F.sum(c).over(inner) for n, c in sums.items()})
    joined = local.join(F.broadcast(before), [*groups, range_col])
    return joined.withColumns({n: F.col(n) + F.col(f"_b_{n}") for n in sums}).drop(*[f"_b_{n}" for n in sums])
