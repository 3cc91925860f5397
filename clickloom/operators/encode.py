"""Frequency, target and dictionary encodings (F10-F13): fit small tables, transform by lookup."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom import defaults as d
from clickloom.functions.keys import hash_fold
from clickloom.operators.lookup import Lookup, attach_all
from clickloom.session import ONE_TASK_ROWS, Measured, measure, use_checkpoint_dir
from clickloom.sources.files import read_text, write_text


@dataclass
class Cells:
    """One aggregate table for several key sets; ``_set`` is the position of the key set in the list."""

    df: DataFrame
    rows: dict[int, int]

    def of(self, number: int) -> DataFrame:
        return self.df.where(F.col("_set") == number)

    def derived(self, number: int, df: DataFrame) -> Measured:
        """A table computed from one key set that has at most as many rows."""
        return Measured(df, self.rows.get(number, 0))

    def release(self) -> None:
        self.df.unpersist()

    def save(self, path: str) -> None:
        self.df.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Cells":
        return counted_cells(spark.read.parquet(path))

    def merged(self, other: "Cells", sums: Iterable[str]) -> "Cells":
        """The cells of both tables' rows together: sums and counts add up, null keys included."""
        sums = list(sums)
        both = self.df.unionByName(other.df)
        keys = [c for c in both.columns if c not in sums]
        return counted_cells(both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]).select(*self.df.columns))


def counted_cells(df: DataFrame) -> Cells:
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    return Cells(kept, {r["_set"]: r["count"] for r in kept.groupBy("_set").count().collect()})


def grouped_cells(df: DataFrame, sets: Iterable[Iterable[str]], aggregates) -> Cells:
    """Aggregate one scan by several key sets at once (GROUPING SETS), keep the result and count it.

    A null key stays distinguishable from a key that is absent from the set.
    """
    sets = [list(s) for s in sets]
    columns = list(dict.fromkeys(c for s in sets for c in s))
    cells = df.groupingSets(sets, *columns).agg(F.grouping_id().alias("_gid"), *aggregates)
    # bit i of grouping_id (from the left) is 1 when column i is not part of the set
    gid = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s) for s in sets]
    if len(set(gid)) != len(gid):
        raise ValueError("key sets must differ")
    number = F.lit(None).cast("int")
    for i, g in enumerate(gid):
        number = F.when(F.col("_gid") == g, F.lit(i)).otherwise(number)
    return counted_cells(cells.withColumn("_set", number).drop("_gid"))


def pair_name(keys: Iterable[str]) -> str:
    return "__X__".join(keys)


@dataclass
class RateEncoder:
    """F10 frequency and F11/F12 target encoding, fitted together in one scan of the training rows."""

    frequency: list[str] = field(default_factory=lambda: list(d.FREQUENCY_ENCODED))
    target: list[tuple[str, ...]] = field(default_factory=lambda: list(d.TARGET_ENCODED_PAIRS))
    label: str = d.LABEL
    weight: float = d.TARGET_ENCODING_WEIGHT
    folds: int = d.FOLDS
    seed: int = d.SEED
    row_key: str = d.ROW_KEY

    def fit(self, train: DataFrame) -> "RateModel":
        have = set(train.columns)
        freq = [c for c in self.frequency if c in have]
        pairs = [tuple(k) for k in self.target if set(k) <= have] if self.label in have else []
        sets = [[c] for c in freq] + [[*k, "_fold"] for k in pairs] + [[]]
        folded = train.withColumn("_fold", hash_fold(self.row_key, self.folds, self.seed))
        positives = F.sum(self.label).cast("double") if self.label in have else F.lit(0.0)
        return self.model(grouped_cells(folded, sets, [positives.alias("_y"), F.count("*").alias("_n")]), freq, pairs)

    def model(self, cells: Cells, freq: list[str], pairs: list[tuple[str, ...]]) -> "RateModel":
        """The model of counted cells: one set per frequency column, one per pair and fold, and one for all rows."""
        total = cells.of(len(freq) + len(pairs)).select("_y", "_n").first()
        rows = total["_n"]
        prior = total["_y"] / rows if rows else 0.0

        freq_tables = {
            c: cells.derived(i, cells.of(i).select(
                c, (F.col("_n") / F.lit(float(rows))).alias(f"{c}_freq"), F.col("_n").alias("_w")))
            for i, c in enumerate(freq)
        }
        loo, full = {}, {}
        for i, keys in enumerate(pairs, start=len(freq)):
            name = f"{pair_name(keys)}_te"
            by_key = Window.partitionBy(*keys)  # one row per fold
            both = cells.of(i).select(*keys, "_fold", "_y", "_n", F.sum("_y").over(by_key).alias("_ty"),
                                      F.sum("_n").over(by_key).alias("_tn"))
            rate = self._smooth(F.col("_ty") - F.col("_y"), F.col("_tn") - F.col("_n"), prior)
            loo[keys] = cells.derived(i, both.select(*keys, "_fold", rate.alias(name), F.col("_n").alias("_w")))
            sums = cells.of(i).groupBy(*keys).agg(F.sum("_y").alias("_y"), F.sum("_n").alias("_n"))
            rate = self._smooth(F.col("_y"), F.col("_n"), prior)
            full[keys] = cells.derived(i, sums.select(*keys, rate.alias(name), F.col("_n").alias("_w")))
        return RateModel(self, prior, rows, cells, freq_tables, loo, full)

    def _smooth(self, positives, count, prior: float):
        return (positives + F.lit(self.weight * prior)) / (count + F.lit(self.weight))


@dataclass
class RateModel:
    """Small tables derived from the kept cells; joins broadcast them below a counted size."""

    spec: RateEncoder
    prior: float
    rows: int
    cells: Cells
    frequency: dict[str, Measured]
    leave_out: dict[tuple[str, ...], Measured]
    full: dict[tuple[str, ...], Measured]

    def frequency_lookups(self, df: DataFrame) -> list[Lookup]:
        """Share of training rows per value; values never seen get 0.0."""
        return [Lookup(t, [c], defaults={f"{c}_freq": F.lit(0.0)}) for c, t in self.frequency.items() if c in df.columns]

    def train_lookups(self, df: DataFrame) -> list[Lookup]:
        """Target encoding that leaves out the row's own fold."""
        fold = {"_fold": hash_fold(self.spec.row_key, self.spec.folds, self.spec.seed)}
        return [Lookup(t, [*keys, "_fold"], fold, self._prior(keys)) for keys, t in self.leave_out.items()]

    def new_lookups(self, df: DataFrame) -> list[Lookup]:
        """Target encoding from all training rows, for rows that were not trained on."""
        return [Lookup(t, list(keys), defaults=self._prior(keys)) for keys, t in self.full.items()
                if set(keys) <= set(df.columns)]

    def _prior(self, keys: Iterable[str]) -> dict[str, Column]:
        return {f"{pair_name(keys)}_te": F.lit(self.prior)}

    def transform_frequency(self, df: DataFrame) -> DataFrame:
        return attach_all(df, self.frequency_lookups(df), self.spec.row_key)

    def transform_train(self, df: DataFrame) -> DataFrame:
        return attach_all(df, self.train_lookups(df), self.spec.row_key)

    def transform_new(self, df: DataFrame) -> DataFrame:
        return attach_all(df, self.new_lookups(df), self.spec.row_key)

    def release(self) -> None:
        self.cells.release()

    def save(self, path: str) -> None:
        """The cells as Parquet and the settings as JSON; a loaded model transforms, and merges with other days."""
        self.cells.save(f"{path}/cells")
        spec = {**asdict(self.spec), "frequency": list(self.frequency), "target": [list(k) for k in self.full]}
        write_text(self.cells.df.sparkSession, f"{path}/encoder.json", json.dumps(spec))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "RateModel":
        spec = json.loads(read_text(spark, f"{path}/encoder.json"))
        spec["target"] = [tuple(k) for k in spec["target"]]
        encoder = RateEncoder(**spec)
        return encoder.model(Cells.load(spark, f"{path}/cells"), encoder.frequency, encoder.target)

    def merge(self, other: "RateModel") -> "RateModel":
        """The model of both models' training rows, as if they had been fitted together."""
        if (list(self.frequency), list(self.full)) != (list(other.frequency), list(other.full)) or (
                self.spec.folds, self.spec.seed) != (other.spec.folds, other.spec.seed):
            raise ValueError("only models of the same columns and folds can be merged")
        return self.spec.model(self.cells.merged(other.cells, ["_y", "_n"]), list(self.frequency), list(self.full))


def dense_codes(values: DataFrame) -> DataFrame:
    """Number the values of every column 0..n-1 in sort order, without a global window.

    ``values`` holds each (column, value) once, plus any other columns.  It is range-sorted and
    checkpointed, which freezes its layout.  In the frozen table ``monotonically_increasing_id`` carries the
    partition number (high bits) and the position (low 33 bits); adding the sizes of the earlier partitions
    gives the place in the whole table, and subtracting where the column begins gives the code.
    """
    use_checkpoint_dir(values.sparkSession)
    ordered = values.orderBy("column", "value").checkpoint()
    placed = ordered.withColumn("_id", F.monotonically_increasing_id()).withColumns({
        "_part": F.shiftright("_id", 33), "_pos": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id")
    one_group = Window.partitionBy(F.lit(0))  # as many rows as partitions, or as columns
    parts = placed.groupBy("_part").agg(F.count("*").alias("_c")).select(
        "_part", (F.sum("_c").over(one_group.orderBy("_part")) - F.col("_c")).alias("_start"))
    columns = placed.groupBy("column").agg(F.count("*").alias("_c")).select(
        "column", (F.sum("_c").over(one_group.orderBy("column")) - F.col("_c")).alias("_begin"))
    coded = placed.join(F.broadcast(parts), "_part").join(F.broadcast(columns), "column")
    code = (F.col("_start") + F.col("_pos") - F.col("_begin")).cast("int").alias("code")
    return coded.select(*values.columns, code)


@dataclass
class DictionaryEncoder:
    """one shared dictionary per column for all given frames; the source column is replaced by a code."""

    columns: list[str] = field(default_factory=lambda: list(d.DICTIONARY_ENCODED))
    row_key: str = d.ROW_KEY
    one_task_rows: int = ONE_TASK_ROWS

    def fit(self, *frames: DataFrame) -> "DictionaryModel":
        # one scan per frame for all columns: each value of each column once, with its row count
        seen = None
        for f in frames:
            pairs = f.select(F.inline(F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                for c in self.columns if c in f.columns])))
            part = pairs.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("_w"))
            seen = part if seen is None else seen.unionByName(part)
        distinct = measure(seen.groupBy("column", "value").agg(F.sum("_w").alias("_w")))
        coded = self.coded(distinct).persist(StorageLevel.MEMORY_AND_DISK)
        model = self.model(coded, [c for c in self.columns if any(c in f.columns for f in frames)])
        distinct.release()
        return model

    def coded(self, distinct: Measured) -> DataFrame:
        """Every column's values with codes 0, 1, .. in sort order."""
        if distinct.rows <= self.one_task_rows:
            order = Window.partitionBy("column").orderBy("value")
            return distinct.df.withColumn("code", F.row_number().over(order) - 1)
        return dense_codes(distinct.df)

    def model(self, coded: DataFrame, columns: list[str]) -> "DictionaryModel":
        sizes = {r["column"]: r["count"] for r in coded.groupBy("column").count().collect()}
        tables = {c: Measured(coded.where(F.col("column") == c).select("value", F.col("code").alias(f"{c}_cat"), "_w"),
                              sizes.get(c, 0)) for c in columns}
        return DictionaryModel(self, Measured(coded, sum(sizes.values())), tables)


@dataclass
class DictionaryModel:
    spec: DictionaryEncoder
    codes: Measured
    tables: dict[str, Measured]

    def lookups(self, df: DataFrame) -> list[Lookup]:
        """Codes for known values, null for null and for values outside the dictionary."""
        out = []
        for c in self.tables:
            if c in df.columns:
                table, key = self.tables[c], f"_text_{c}"
                side = Measured(table.df.withColumnRenamed("value", key), table.rows, table.bytes)
                out.append(Lookup(side, [key], {key: F.col(c).cast("string")}))
        return out

    def transform(self, df: DataFrame, drop: bool = True) -> DataFrame:
        return self.without_sources(attach_all(df, self.lookups(df), self.spec.row_key), drop)

    def without_sources(self, df: DataFrame, drop: bool = True) -> DataFrame:
        return df.drop(*[c for c in self.tables if c in df.columns]) if drop else df

    def release(self) -> None:
        self.codes.release()

    def save(self, path: str) -> None:
        self.codes.df.write.mode("overwrite").parquet(f"{path}/codes")
        spec = {"columns": list(self.tables), "row_key": self.spec.row_key, "one_task_rows": self.spec.one_task_rows}
        write_text(self.codes.df.sparkSession, f"{path}/dictionary.json", json.dumps(spec))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "DictionaryModel":
        spec = DictionaryEncoder(**json.loads(read_text(spark, f"{path}/dictionary.json")))
        return spec.model(spark.read.parquet(f"{path}/codes").persist(StorageLevel.MEMORY_AND_DISK), spec.columns)

    def merge(self, other: "DictionaryModel") -> "DictionaryModel":
        """This model's codes, and further ones, in sort order, for the values that only the other one has seen."""
        mine = self.codes.df
        theirs = other.codes.df.select("column", "value", F.col("_w").alias("_more"))
        known = mine.join(theirs, ["column", "value"], "left").select(
            "column", "value", (F.col("_w") + F.coalesce("_more", F.lit(0))).alias("_w"), "code")
        fresh = measure(other.codes.df.join(mine, ["column", "value"], "left_anti").select("column", "value", "_w"))
        # one row per column
        begin = mine.groupBy("column").agg((F.max("code") + 1).alias("_begin"))
        added = self.spec.coded(fresh).join(F.broadcast(begin), "column", "left").select(
            "column", "value", "_w", (F.col("code") + F.coalesce("_begin", F.lit(0))).cast("int").alias("code"))
        both = known.unionByName(added).persist(StorageLevel.MEMORY_AND_DISK)
        return self.spec.model(both, list(dict.fromkeys([*self.tables, *other.tables])))
