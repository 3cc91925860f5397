"""Exact random order by hashed row key, within groups of any size.

A group of n rows is cut into about ``n / slot_rows`` equal slots of the hash range, so even a group that
holds most of the table is ranked by many tasks.  The order is (draw, key), the same whatever the slots.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom import defaults as d
from clickloom.functions.keys import draw, draw_bucket
from clickloom.operators.lookup import attach
from clickloom.session import Measured, measure

SLOT_ROWS = 100_000


def grouped(df: DataFrame, groups: list[str]) -> DataFrame:
    """Add the group as one text column ``_g``."""
    # nulls count as a value of their own, and joins need a key that is never null; the length in front
    # of each part keeps different combinations apart
    parts = []
    for g in groups:
        text = F.col(g).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return df.withColumn("_g", F.concat(*parts) if parts else F.lit(""))


def _slots(slot_rows: int):
    return F.ceil(F.col("_n") / F.lit(float(slot_rows))).cast("bigint")


def group_sizes(df: DataFrame, groups: Iterable[str]) -> DataFrame:
    """Rows per group: ``_g``, ``_n``."""
    return grouped(df, list(groups)).groupBy("_g").agg(F.count("*").alias("_n"))


def hash_limits(df: DataFrame, quotas: DataFrame, groups: Iterable[str], key: str = d.ROW_KEY,
                seed: int = d.SEED, slot_rows: int = SLOT_ROWS) -> Measured:
    """For every group the place in hash order where its quota is used up: ``_last_draw, _last_key``.

    ``quotas`` has ``_g, _n, _quota``.  The rows are counted per slot of the hash range, and only the slot in
    which the quota is reached is ranked, so no group is sorted as a whole.  Only the key and the group
    columns are read.  Groups that are taken whole, or not at all, need no limit and get nulls.
    """
    quotas = measure(quotas.withColumns({
        "_slots": _slots(slot_rows), "_cut": (F.col("_quota") > 0) & (F.col("_quota") < F.col("_n"))}))
    narrow = grouped(df, list(groups)).select("_g", key, draw(key, seed).alias("_draw"))
    slotted = attach(narrow, quotas, ["_g"], "_n", key).where("_cut").withColumn(
        "_slot", draw_bucket(F.col("_draw"), F.col("_slots")))
    cells = slotted.groupBy("_g", "_slot").agg(F.count("*").alias("_c"), F.first("_quota").alias("_quota"))
    upto = F.sum("_c").over(Window.partitionBy("_g").orderBy("_slot"))
    edges = measure(cells.withColumn("_upto", upto).where(
        (F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_c") < F.col("_quota"))
    ).select("_g", F.col("_slot").alias("_edge"), (F.col("_quota") - F.col("_upto") + F.col("_c")).alias("_left"))
        .join(quotas.df.select("_g", "_n"), "_g"))
    inside = attach(slotted, edges, ["_g"], "_n", key).where(F.col("_slot") == F.col("_edge"))
    order = Window.partitionBy("_g").orderBy("_draw", key)
    last = inside.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == F.col("_left")).select(
        "_g", F.col("_draw").alias("_last_draw"), F.col(key).alias("_last_key"))
    return measure(quotas.df.select("_g", "_n", "_quota").join(last, "_g", "left"))


def within_limits(df: DataFrame, limits: Measured, groups: Iterable[str], key: str = d.ROW_KEY,
                  seed: int = d.SEED, always: Column | None = None) -> DataFrame:
    """Rows up to the limit of their group, and the rows for which ``always`` holds: one scan and a filter."""
    cols = df.columns
    keyed = grouped(df, list(groups)).withColumn("_draw", draw(key, seed))
    ready = attach(keyed, limits, ["_g"], "_n", key)
    last = F.col("_last_draw")
    chosen = (F.col("_quota") > 0) & (
        last.isNull() | (F.col("_draw") < last) | ((F.col("_draw") == last) & (F.col(key) <= F.col("_last_key"))))
    if always is not None:
        chosen = F.coalesce(chosen, F.lit(False)) | always
    return ready.where(chosen).select(*cols)


def first_by_hash(df: DataFrame, quotas: DataFrame, groups: Iterable[str], key: str = d.ROW_KEY,
                  seed: int = d.SEED, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """The first ``_quota`` rows of every group in hash order, exactly."""
    groups = list(groups)
    return within_limits(df, hash_limits(df, quotas, groups, key, seed, slot_rows), groups, key, seed)


def hash_cuts(df: DataFrame, groups: Iterable[str], parts: int, key: str = d.ROW_KEY, seed: int = d.SEED,
              slot_rows: int = SLOT_ROWS) -> Measured:
    """Where every group's hash order is cut into ``parts`` equal parts: ``_g, _n, _cuts``.

    ``_cuts`` holds the (draw, key) of the last row of each part but the last; parts without a row before them have none
    and are counted in ``_skip``.  Only keys and groups are read, and only the slots with a cut are ranked.
    """
    groups = list(groups)
    sizes = measure(group_sizes(df, groups).withColumns({"_slots": _slots(slot_rows), "_w": F.col("_n")}))
    narrow = grouped(df, groups).select("_g", F.col(key).alias("_key"), draw(key, seed).alias("_draw"))
    slotted = attach(narrow, sizes, ["_g"], "_w", "_key").withColumn("_slot", draw_bucket(F.col("_draw"), F.col("_slots")))
    cells = slotted.groupBy("_g", "_slot").agg(F.count("*").alias("_c"), F.first("_n").alias("_n"))
    upto = F.sum("_c").over(Window.partitionBy("_g").orderBy("_slot"))
    quota = lambda i: F.floor(i * F.col("_n") / F.lit(parts)).cast("bigint")
    ends = F.filter(F.transform(F.sequence(F.lit(1), F.lit(max(parts - 1, 1))), quota),
                    lambda q: (q <= F.col("_upto")) & (q > F.col("_upto") - F.col("_c")))
    # the ranks inside a slot at which a part ends; several parts may end at one row of a small group
    edges = measure(cells.withColumn("_upto", upto).select("_g", "_slot", F.transform(
        ends, lambda q: q - F.col("_upto") + F.col("_c")).alias("_ranks")).where(F.size("_ranks") > 0))
    inside = attach(slotted, edges, ["_g", "_slot"], None, "_key").where(F.col("_ranks").isNotNull())
    order = Window.partitionBy("_g", "_slot").orderBy("_draw", "_key")
    last = inside.withColumn("_rank", F.row_number().over(order).cast("bigint")).select(
        "_g", "_draw", "_key", F.explode(F.filter("_ranks", lambda r: r == F.col("_rank"))))
    cuts = last.groupBy("_g").agg(F.sort_array(F.collect_list(F.struct("_draw", "_key"))).alias("_cuts"))
    empty = F.size(F.filter(F.transform(F.sequence(F.lit(1), F.lit(max(parts - 1, 1))), quota), lambda q: q == 0))
    return measure(sizes.df.join(cuts, "_g", "left").select("_g", "_n", "_cuts", empty.alias("_skip")))


def hash_parts(df: DataFrame, groups: Iterable[str], parts: int, key: str = d.ROW_KEY, seed: int = d.SEED,
               slot_rows: int = SLOT_ROWS, name: str = "part") -> DataFrame:
    """Add the part, 0 to ``parts - 1``, of every row in its group's hash order: one comparison per cut, where the row is.

    Parts of a group differ by at most one row.
    """
    groups = list(groups)
    cols = df.columns
    if parts <= 1:
        return df.withColumn(name, F.lit(0))
    cuts = hash_cuts(df, groups, parts, key, seed, slot_rows)
    ready = attach(grouped(df, groups).withColumn("_draw", draw(key, seed)), cuts, ["_g"], "_n", key)
    behind = F.size(F.filter("_cuts", lambda c: (c["_draw"] < F.col("_draw")) | (
        (c["_draw"] == F.col("_draw")) & (c["_key"] < F.col(key)))))
    passed = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(behind)
    return ready.select(*cols, (passed + F.col("_skip")).cast("int").alias(name))


def hash_ordinal(df: DataFrame, groups: Iterable[str], key: str = d.ROW_KEY, seed: int = d.SEED,
                 slot_rows: int = SLOT_ROWS, name: str = "ordinal") -> DataFrame:
    """Add the zero-based position of every row in its group's hash order."""
    groups = list(groups)
    cols = df.columns
    sizes = measure(group_sizes(df, groups).withColumn("_slots", _slots(slot_rows)))
    keyed = grouped(df, groups).withColumn("_draw", draw(key, seed))
    slotted = attach(keyed, sizes, ["_g"], "_n", key).withColumn(
        "_slot", draw_bucket(F.col("_draw"), F.col("_slots")))
    cells = slotted.groupBy("_g", "_slot").agg(F.count("*").alias("_c"))
    before = F.sum("_c").over(Window.partitionBy("_g").orderBy("_slot")) - F.col("_c")
    offsets: Measured = measure(cells.select("_g", "_slot", before.alias("_before")))
    rank = F.row_number().over(Window.partitionBy("_g", "_slot").orderBy("_draw", key))
    ranked = slotted.withColumn("_rank", rank)
    return attach(ranked, offsets, ["_g", "_slot"], row_key=key).select(
        *cols, (F.col("_before") + F.col("_rank") - 1).alias(name))


