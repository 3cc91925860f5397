"""Attaching per-key statistics and per-row features."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from clickloom import defaults as d
from clickloom.session import Measured

# A measured table up to this many rows, and bytes of text, is broadcast; a bigger one is joined by a shuffle.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# In the shuffle join, a key holding more than this share of the rows to be joined is split.
HOT_SHARE = 1 / 1000
SALTS = 64


def _small(stats: Measured, broadcast_rows: int | None) -> bool:
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    return stats.rows <= limit and stats.bytes <= BROADCAST_BYTES


def attach(rows: DataFrame, stats: Measured, keys: Iterable[str], weight: str | None = None,
           row_key: str = d.ROW_KEY, broadcast_rows: int | None = None, total: int | None = None) -> DataFrame:
    """Left join of ``rows`` with a measured statistics table that is unique on ``keys``.

    Small statistics are broadcast, which leaves the rows where they are.  Otherwise the rows are shuffled
    on the keys.  With ``weight``, a column of the statistics that is left out of the result, keys that hold more than
    ``HOT_SHARE`` of ``rows`` (``total`` rows, counted if not given), known to the statistics or not, are spread over
    ``SALTS`` reducers, their statistics row copied to each.  At most ``1 / HOT_SHARE`` keys can be that heavy, so the
    hot-key list is safe to broadcast.  Rows with a null key match nothing and are spread the same way.
    """
    keys = list(keys)
    if _small(stats, broadcast_rows):
        side = stats.df.drop(weight) if weight else stats.df
        return rows.join(F.broadcast(side), keys, "left")
    if weight is None:
        return rows.join(stats.df, keys, "left")

    counts = rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    total = rows.count() if total is None else total
    hot = counts.where(F.col("_rows") > F.lit(HOT_SHARE) * total).select(*keys, F.lit(True).alias("_is_hot"))
    copies = stats.df.drop(weight).join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(
        F.when(F.col("_is_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread = F.pmod(F.xxhash64(row_key), F.lit(SALTS)).cast("int")
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_is_hot") | null_key, spread).otherwise(F.lit(0))).drop("_is_hot")
    return salted.join(copies.drop("_is_hot"), [*keys, "_salt"], "left").drop("_salt")


@dataclass
class Lookup:
    """A statistics table to attach: ``made`` are keys computed from the rows first, ``defaults`` fill what is not found."""

    table: Measured
    keys: Sequence[str]
    made: Mapping[str, Column] = field(default_factory=dict)
    defaults: Mapping[str, Column] = field(default_factory=dict)
    weight: str | None = "_w"

    @property
    def values(self) -> list[str]:
        return [c for c in self.table.df.columns if c not in self.keys and c != self.weight]


def attach_all(rows: DataFrame, lookups: Sequence[Lookup], row_key: str = d.ROW_KEY,
               broadcast_rows: int | None = None) -> DataFrame:
    """Attach several tables, moving the rows once at most.

    Small tables are broadcast.  One that is too large is joined as it is; several are attached to the row key and their
    keys alone, and the values found for a row come back in one join on the unique row key.
    """
    made = {n: c for x in lookups for n, c in x.made.items()}
    keyed = rows.withColumns(made) if made else rows
    large = [x for x in lookups if not _small(x.table, broadcast_rows)]
    for x in lookups:
        if x not in large or len(large) == 1:
            keyed = attach(keyed, x.table, x.keys, x.weight, row_key, broadcast_rows)
    if len(large) > 1:
        needed = dict.fromkeys(k for x in large for k in x.keys)
        narrow = rows.withColumns(made).select(row_key, *[k for k in needed if k != row_key])
        total = narrow.count()
        for x in large:
            narrow = attach(narrow, x.table, x.keys, x.weight, row_key, broadcast_rows, total)
        keyed = attach_by_row(keyed, narrow.select(row_key, *[c for x in large for c in x.values]), row_key)
    filled = {c: F.coalesce(c, v) for x in lookups for c, v in x.defaults.items()}
    # in the order of the list, whatever way each table took
    names = [*rows.columns, *[c for x in lookups for c in x.values]]
    return (keyed.withColumns(filled) if filled else keyed).select(*names)


def attach_by_row(rows: DataFrame, features: DataFrame, key: str = d.ROW_KEY) -> DataFrame:
    """Re-attach features (or an embedding) on the unique row key.

    Both sides are unique on the key, so no reducer can be hot; there is no positional fallback.
    """
    for side, name in ((rows, "rows"), (features, "features")):
        if key not in side.columns:
            raise ValueError(f"{name} need the row key {key!r}; positions are not stable in Spark")
    return rows.join(features, key, "left")


def keep_keys(rows: DataFrame, ids: DataFrame, key: str = d.ROW_KEY) -> DataFrame:
    """Rows whose key is in the list (semi join)."""
    return rows.join(ids.select(key), key, "left_semi")
