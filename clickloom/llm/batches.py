"""Run a function over the texts of a table in slices of bounded size, inside Spark's own partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

# A slice holds at most this many bytes of text, or one text.
SLICE_BYTES = 4 << 20


def cuts(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut rows into ranges whose sizes sum to at most ``limit``; a larger row is a range of its own."""
    upto = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
        yield start, end
        start = end


def map_texts(docs: DataFrame, text: str, carry: Iterable[str], compute: Callable[[list], list],
              schema: str, limit: int = SLICE_BYTES) -> DataFrame:
    """One row per row of ``docs``: the carried columns, then the columns that ``compute`` gives.

    ``compute`` takes the texts of a slice as UTF-8 bytes (or None) and returns one Arrow array or list for each
    column of ``schema``.  Carried columns travel by position, so their names may be anything, those of the
    results included; such a result has two columns of one name, to be renamed by position.
    """
    carry = list(carry)
    results = StructType.fromDDL(schema)
    inside = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)],
                         F.col(f"`{text}`").cast("string").cast("binary").alias("_text"))
    types = StructType([*inside.schema.fields[:-1], *[
        type(f)(f"_r{i}", f.dataType, True) for i, f in enumerate(results.fields)]])
    n = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = [f.type for f in to_arrow_schema(StructType(types.fields[n:]))]
        names = [f"_c{i}" for i in range(n)] + [f"_r{i}" for i in range(len(wanted))]
        for batch in batches:
            column = batch.column(n)
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            for start, end in cuts(sizes, limit):
                made = compute(column.slice(start, end - start).to_pylist())
                arrays = [batch.column(i).slice(start, end - start) for i in range(n)]
                arrays += [a if isinstance(a, pa.Array) and a.type == t else pa.array(a, t)
                           for a, t in zip(made, wanted, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return inside.mapInArrow(run, types).toDF(*carry, *results.names)


def keep_rows(docs: DataFrame, text: str, verdict: Callable[[list], list], limit: int = SLICE_BYTES) -> DataFrame:
    """The rows for which ``verdict`` is true, all columns as they were."""
    marked = map_texts(docs, text, docs.columns, lambda texts: [verdict(texts)], "kept boolean", limit)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    return marked.toDF(*names, "_kept").where("_kept").select(*[
        F.col(a).alias(c) for a, c in zip(names, docs.columns)])
