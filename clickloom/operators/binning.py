"""Quantile binning of numeric columns and two-feature grids."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clickloom import defaults as d
from clickloom.functions.missing import fill_values
from clickloom.operators.order_stats import nearest_rank, summarise, values_at


def digitize(value: Column, inner: Sequence[float]) -> Column:
    """Number of inner edges not above the value.

    NaN sorts last, so it gets the last bin; null stays null.  A chain of comparisons over a few dozen
    literals compiles into the surrounding stage.  Pass a stored column: it is read once per edge.
    """
    expr = F.lit(0)
    for edge in inner:
        expr = expr + F.when(value >= F.lit(float(edge)), 1).otherwise(0)
    return F.when(value.isNotNull(), expr)


def inner_edges(quantiles: Sequence[float], mean: float | None) -> list[float]:
    """E5: inner edges from nearest-rank quantiles (minimum first, maximum last).

    Duplicates collapse.  A constant column keeps its value as the one inner edge, and with two distinct
    values the mean separates them; an empty column gets 0.0.
    """
    edges = sorted(set(quantiles))
    if not edges:
        return [0.0]
    if len(edges) == 1:
        return edges
    if len(edges) == 2:
        return sorted({edges[0], float(mean), edges[1]})[1:-1]
    return edges[1:-1]


@dataclass
class QuantileBinner:
    """Fit medians and nearest-rank quantile edges; transform by filling nulls and digitizing."""

    columns: Sequence[str]
    bins: int = d.HISTORY_BINS
    fill: bool = True
    # more than 1: look for the quantiles in ranges even where one task could sort the table
    ranges: int | None = None

    def quantiles(self) -> list[float]:
        bins = max(2, self.bins)
        return [i * (1.0 / bins) for i in range(bins)] + [1.0]

    def fit(self, df: DataFrame) -> "BinModel":
        """Two scans: one for counts and sketches, one that reads medians and edges together.

        Filled nulls stand right behind the lower half of the values, so the rank in the filled column says which value
        it is without filling anything.
        """
        columns = list(self.columns)
        summary = summarise(df, columns)
        ranks, nulls = {}, {}
        for c in columns:
            n = summary.counts[c]
            nulls[c] = summary.rows - n if self.fill and n else 0
            half = (n - 1) // 2
            # of an even number of values both middle ones make the median
            ranks[c] = {half, n // 2} if n else set()
            for q in self.quantiles() if n else []:
                rank = nearest_rank(n + nulls[c], q)
                if rank <= half:
                    ranks[c].add(rank)
                elif rank > half + nulls[c]:
                    ranks[c].add(rank - nulls[c])
        values = values_at(df, ranks, summary, always=(self.ranges or 1) > 1)
        summary.release()
        fills, edges = {}, {}
        for c in columns:
            n = summary.counts[c]
            if not n:
                edges[c] = [0.0]
                continue
            half = (n - 1) // 2
            middle = (values[c][half] + values[c][n // 2]) / 2
            if self.fill:
                fills[c] = middle
            found = [values[c][r] if r <= half else middle if r <= half + nulls[c] else values[c][r - nulls[c]]
                     for r in (nearest_rank(n + nulls[c], q) for q in self.quantiles())]
            mean = (summary.sums[c] + nulls[c] * middle) / (n + nulls[c])
            edges[c] = inner_edges(found, mean)
        return BinModel(columns, fills, edges)


@dataclass
class BinModel:
    """A few dozen numbers per column, so transforming is a plain projection."""

    columns: list[str]
    fills: dict[str, float]
    edges: dict[str, list[float]]

    def bin_count(self, column: str) -> int:
        return len(self.edges[column]) + 1

    def transform(self, df: DataFrame) -> DataFrame:
        df = fill_values(df, self.fills)
        return df.withColumns({
            f"{c}_bin": digitize(F.col(c).cast("double"), self.edges[c]) for c in self.columns if c in df.columns})

    def grid(self, left: str, right: str) -> Column:
        """composite bin id ``left_bin * right_bins + right_bin``."""
        return (F.col(f"{left}_bin") * self.bin_count(right) + F.col(f"{right}_bin")).cast("int")

    def to_json_dict(self) -> dict:
        """Inner edges only, so the file is valid JSON; the outer edges are always infinite."""
        return {"fill_values": self.fills, "inner_edges": self.edges}

    @classmethod
    def from_json_dict(cls, data: dict) -> "BinModel":
        return cls(list(data["inner_edges"]), dict(data["fill_values"]), dict(data["inner_edges"]))


def grid_columns(model: BinModel, pairs: Iterable[tuple[str, str]]) -> dict[str, Column]:
    return {f"{a}_{b}_bin_idx": model.grid(a, b) for a, b in pairs}


