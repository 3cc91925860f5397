"""Boosted-tree training, scoring, importance and search on Spark ML."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickloom import defaults as d
from clickloom.functions.columns import drop_columns, numeric_columns
from clickloom.functions.keys import draw, draw_bucket, hash_fold, hash_split
from clickloom.operators.boosting import (  # noqa: F401
    Bins, Boosting, Progress, Tree, best_round, classifier, read_tree,
)
from clickloom.operators.calibrate import probability
from clickloom.operators.metrics import metric_bundle
from clickloom.session import use_checkpoint_dir
from clickloom.sources.files import read_text, write_text


def load_frames(train: DataFrame, test: DataFrame, drop: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Drop the sequence and any listed columns from both frames."""
    unwanted = ["seq", *drop]
    return drop_columns(train, unwanted), drop_columns(test, unwanted)


@dataclass
class FeatureAssembler:
    """Numeric columns to a vector; nulls and NaN become the (approximate) median, marked by a flag."""

    exclude: Sequence[str] = (d.LABEL, d.ROW_KEY, d.TEST_ID)
    parity: bool = False

    def fit(self, df: DataFrame, columns: Sequence[str] | None = None) -> "AssemblerModel":
        names = list(columns) if columns else numeric_columns(df, self.exclude, self.parity)
        if not names:
            raise ValueError("no numeric feature columns")
        x = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in names}
        row = df.agg(*[e for i, c in enumerate(names) for e in (
            F.count_if(x[c].isNull()).alias(f"h{i}"), F.percentile_approx(x[c], 0.5, 1000).alias(f"m{i}"))]).first()
        # a column without any value has no median and becomes zero
        fills = {c: row[f"m{i}"] or 0.0 for i, c in enumerate(names) if row[f"h{i}"]}
        return AssemblerModel(names, fills)


@dataclass
class AssemblerModel:
    columns: list[str]
    fills: dict[str, float]

    @property
    def feature_names(self) -> list[str]:
        return [*self.columns, *[f"{c}_isnull" for c in self.fills]]

    def transform(self, df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
        """Columns to keep plus the feature vector; features are matched by name, absent ones are zero."""
        keep = [c for c in dict.fromkeys(keep) if c in df.columns]
        have = set(df.columns)
        out = []
        for i, c in enumerate(self.columns):
            raw = F.col(c).cast("double") if c in have else F.lit(0.0)
            x = F.nanvl(raw, F.lit(None).cast("double"))
            # a hole in a column that had none in training has no flag of its own
            out.append(F.coalesce(x, F.lit(float(self.fills.get(c, 0.0)))).alias(f"_x{i}"))
            if c in self.fills:
                out.append(x.isNull().cast("double").alias(f"_n{i}"))
        names = [f"_x{i}" for i in range(len(self.columns))]
        names += [f"_n{self.columns.index(c)}" for c in self.fills]
        wide = df.select(*keep, *out)
        return VectorAssembler(inputCols=names, outputCol="features").transform(wide).select(*keep, "features")

    def to_json(self) -> str:
        return json.dumps({"columns": self.columns, "fills": self.fills})

    @classmethod
    def from_json(cls, text: str) -> "AssemblerModel":
        data = json.loads(text)
        return cls(data["columns"], data["fills"])


@dataclass(frozen=True)
class BoostParams:
    """The tunable parameters.  Gains and penalties are in units of the summed log-loss and its Hessian."""

    learning_rate: float = 0.05
    num_leaves: int = 64
    max_depth: int = 6
    min_data_in_leaf: int = 500
    feature_fraction: float = 0.9   # of the features, drawn for each tree
    bagging_fraction: float = 0.8   # of the rows, drawn by a hash of their keys
    bagging_freq: int = 1           # rounds that a drawn bag is kept for
    lambda_l1: float = 0.0
    lambda_l2: float = 0.0
    min_gain_to_split: float = 0.0
    rounds: int = 300
    patience: int = 50              # rounds without a better held-out loss before a fold stops
    max_bins: int = 64
    seed: int = d.SEED


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model cut to its first ``n`` trees."""
    if n >= model.getNumTrees:
        return model
    gateway = SparkSession.getActiveSession().sparkContext._gateway
    kind = gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, weights = gateway.new_array(kind, n), gateway.new_array(gateway.jvm.double, n)
    every = model._java_obj.trees()
    for i in range(n):
        trees[i], weights[i] = every[i], model.treeWeights[i]
    cut = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        model.uid, trees, weights, model.numFeatures, model.numClasses)
    out = GBTClassificationModel(model._java_obj.copyValues(cut, gateway.jvm.org.apache.spark.ml.param.ParamMap.empty()))
    out._transfer_params_from_java()
    return out


@dataclass
class FoldModels:
    models: list[GBTClassificationModel]
    assembler: AssemblerModel
    oof: DataFrame | None = None
    kept: DataFrame | None = None
    progress: list[Progress] = field(default_factory=list)

    def release(self) -> None:
        """Drop the persisted bins; the models stay."""
        if self.kept is not None:
            self.kept.unpersist()

    def score(self, df: DataFrame, keep: Iterable[str], name: str = "raw_pred") -> DataFrame:
        """Mean probability of the fold models, in one pass over the rows."""
        keep = [c for c in keep if c in df.columns]
        scored = self.assembler.transform(df, keep)
        parts = []
        for i, model in enumerate(self.models):
            view = model.copy()
            view.setProbabilityCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setPredictionCol(f"_c{i}")
            scored = view.transform(scored)
            parts.append(probability(f"_p{i}"))
        total = parts[0]
        for p in parts[1:]:
            total = total + p
        return scored.select(*keep, (total / F.lit(float(len(parts)))).alias(name))

    def save(self, path: str) -> None:
        """One model directory per fold, numbered from 1."""
        for i, model in enumerate(self.models, start=1):
            model.write().overwrite().save(f"{path}/fold_{i}")
        spark = SparkSession.getActiveSession()
        write_text(spark, f"{path}/features.json", self.assembler.to_json())


def load_models(spark: SparkSession, path: str, folds: int = d.FOLDS) -> FoldModels:
    """The fold models with the feature list they were trained on."""
    assembler = AssemblerModel.from_json(read_text(spark, f"{path}/features.json"))
    return FoldModels([GBTClassificationModel.load(f"{path}/fold_{i}") for i in range(1, folds + 1)], assembler)


@dataclass
class Binned:
    """The table that all folds, and all trials of a search, share: key, label, fold or hold-out, weight, bin numbers."""

    table: DataFrame
    bins: Bins
    assembler: AssemblerModel
    key: str
    label: str
    weight: str | None
    split: str

    def _half(self, progress: Progress, params: BoostParams, rows: DataFrame) -> DataFrame:
        """Rows scored by a fold's trees up to its best round."""
        spark, n = rows.sparkSession, len(self.bins.cuts)
        model = classifier(spark, progress, Bins([[] for _ in range(n)]), params, binned=True)
        return model.transform(rows.withColumn("features", array_to_vector(F.col("bins").cast("array<double>"))))

    def held_scores(self, progress: Sequence[Progress], params: BoostParams) -> DataFrame:
        """Key, label, fold and ``raw_pred`` of every row, by the model that did not see it."""
        parts = []
        for k, made in enumerate(progress):
            held = self._half(made, params, self.table.where(F.col(self.split) == k))
            parts.append(held.select(self.key, F.col(self.label).cast("int").alias(self.label),
                                     F.col(self.split).alias("fold"), probability().alias("raw_pred")))
        return reduce(DataFrame.unionByName, parts)

    def boost(self, params: BoostParams, splits: Sequence[int], rounds: int | None = None,
              progress: Sequence[Progress] | None = None, parallel: int = 4) -> list[Progress]:
        """The folds' rounds, several folds at a time; each goes on from its ``progress``."""
        progress = progress or [Progress() for _ in splits]

        def one(k: int, made: Progress) -> Progress:
            return Boosting(self.table, F.col(self.split) == k, len(self.bins.cuts), params, self.key, self.label,
                            self.weight, made).run(params.rounds if rounds is None else rounds)

        pool = ThreadPool(max(1, min(parallel, len(splits))))
        try:
            run = inheritable_thread_target(self.table.sparkSession)(one)
            return pool.starmap(run, zip(splits, progress))
        finally:
            pool.close()

    def models(self, progress: Sequence[Progress], params: BoostParams) -> list[GBTClassificationModel]:
        return [classifier(self.table.sparkSession, p, self.bins, params) for p in progress]


def binned(df: DataFrame, split: str, max_bins: int, label: str = d.LABEL, key: str = d.ROW_KEY,
           weight: str | None = None, columns: Sequence[str] | None = None) -> Binned:
    """Assemble and bin the features once; the table is persisted until it is released."""
    use_checkpoint_dir(df.sparkSession)  # boosting writes its margins there
    exclude = (label, key, d.TEST_ID, split, *([weight] if weight else []))
    assembler = FeatureAssembler(exclude).fit(df, columns)
    names = [key, label, split, *([weight] if weight else [])]
    data = assembler.transform(df, names).withColumn(label, F.col(label).cast("double"))
    bins = Bins.fit(data, "features", len(assembler.feature_names), max_bins)
    table = data.select(*names, bins.number("features").alias("bins")).persist()
    table.count()  # before several folds read it at once
    return Binned(table, bins, assembler, key, label, weight, split)


def train_folds(df: DataFrame, params: BoostParams = BoostParams(), folds: int = d.FOLDS, label: str = d.LABEL,
                key: str = d.ROW_KEY, weight: str | None = None, fold: str | None = None,
                columns: Sequence[str] | None = None, seed: int = d.SEED) -> FoldModels:
    """One boosted model per held-out fold, up to its best round there; ``oof`` holds the held-out scores.

    ``fold`` names a column with fold numbers, such as :func:`stratified_folds` adds; without it the folds are drawn by
    a hash.  The binned features are persisted once, shared by all folds and released with :meth:`FoldModels.release`.
    """
    if fold is None:
        fold = "_fold"
        df = df.withColumn(fold, hash_fold(key, folds, seed))
    data = binned(df, fold, params.max_bins, label, key, weight, columns)
    progress = data.boost(params, range(folds))
    return FoldModels(data.models(progress, params), data.assembler, data.held_scores(progress, params), data.table,
                      progress)


def train_holdout(df: DataFrame, params: BoostParams = BoostParams(learning_rate=0.1, max_depth=5, rounds=1000),
                  label: str = d.LABEL, key: str = d.ROW_KEY, share: float = 0.2,
                  seed: int = d.SEED) -> tuple[FoldModels, DataFrame]:
    """One model with a random held-out share; returns it with the scores of that share."""
    keyed = df.withColumn("_held", F.when(hash_split(key, share, seed), 0).otherwise(1))
    data = binned(keyed, "_held", params.max_bins, label, key)
    progress = data.boost(params, [0])
    scores = data.held_scores(progress, params).drop("fold")
    return FoldModels(data.models(progress, params), data.assembler, kept=data.table, progress=progress), scores


def oof_metrics(oof: DataFrame, label: str = d.LABEL) -> DataFrame:
    """Metrics per fold and, as stage ``overall``, of all held-out scores together."""
    long = oof.select(label, "raw_pred", F.explode(F.array(
        F.concat(F.lit("fold_"), (F.col("fold") + 1).cast("string")), F.lit("overall"))).alias("stage"))
    return metric_bundle(long, label, "raw_pred", ["stage"])


def submission(models: FoldModels, test: DataFrame, row_id: str = d.TEST_ID) -> DataFrame:
    """``ID, clicked``, or only ``clicked`` when the test frame has no id."""
    return models.score(test, [row_id], "clicked")


def importance(models: FoldModels, top: int | None = None) -> DataFrame:
    """Mean gain importance per feature over the fold models, best first."""
    spark = SparkSession.getActiveSession()
    names = models.assembler.feature_names
    rows = []
    for i, name in enumerate(names):
        values = [float(m.featureImportances[i]) for m in models.models]
        rows.append((name, sum(values) / len(values)))
    table = spark.createDataFrame(rows, "feature string, importance double")
    ranked = table.orderBy(F.desc("importance"), "feature")
    return ranked.limit(top) if top else ranked


def shuffled(df: DataFrame, column: str, key: str = d.ROW_KEY, seed: int = d.SEED, rows: int | None = None,
             slot_rows: int = 100_000) -> DataFrame:
    """Permute one column: every row gets the value of its successor in a random cyclic order.

    Rows are dealt to slots by their hash, and each slot is permuted on its own, so the work is spread
    evenly whatever the data looks like.
    """
    n = df.count() if rows is None else rows
    slots = max(1, math.ceil(n / slot_rows))
    slot = draw_bucket(draw(key, seed), F.lit(slots))
    ring = Window.partitionBy("_slot").orderBy("_draw", key)
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = df.withColumns({"_slot": slot, "_draw": draw(key, seed + 1)})
    moved = F.when(F.row_number().over(ring) == F.count("*").over(Window.partitionBy("_slot")),
                   F.first(column).over(whole)).otherwise(F.lead(column).over(ring))
    return dealt.withColumn(column, moved).drop("_slot", "_draw")


def _margins(models: Sequence[GBTClassificationModel]) -> list[list[tuple[float, Tree]]]:
    """Every model's trees as flat arrays with their weights."""
    return [[(float(w), read_tree(t.toDebugString)) for w, t in zip(m.treeWeights, m.trees)] for m in models]


def permuted_scores(models: FoldModels, df: DataFrame, columns: Sequence[str] | None = None, label: str = d.LABEL,
                    key: str = d.ROW_KEY, seed: int = d.SEED, base: bool = False,
                    slot_rows: int = 100_000) -> DataFrame:
    """``feature, label, raw_pred``: every row once per column, scored with the column's value of the row's successor in a
    random cyclic order; with ``base`` also as it is, as feature ``""``.

    The successor brings all of its features at once, so the rows are shuffled and read once for all columns.  A batch
    evaluates its trees once, and for each column only those that use it.  A column that no tree uses has the plain score.
    """
    names = models.assembler.feature_names
    chosen = list(models.assembler.columns if columns is None else columns)
    places = {c: [i for i, n in enumerate(names) if n in (c, f"{c}_isnull")] for c in chosen}
    rows = models.assembler.transform(df, [key, label]).withColumn("_other", F.col("features"))
    moved = shuffled(rows, "_other", key, seed, slot_rows=slot_rows).select(
        F.col(label).cast("int").alias("y"), vector_to_array("features").alias("x"),
        vector_to_array("_other").alias("o"))
    forests = _margins(models.models)
    trees = [(m, w, t, set(t.feature) - {-1}) for m, forest in enumerate(forests) for w, t in forest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, o = (batch.column(i).flatten().to_numpy().reshape(len(batch), -1) for i in (1, 2))
            parts = np.zeros((len(trees), len(batch)))
            for i, (_, w, tree, _) in enumerate(trees):
                parts[i] = w * tree.predict(x)

            def score(rows: np.ndarray, used: set[int] | None) -> np.ndarray:
                margins = np.zeros((len(forests), len(batch)))
                for i, (m, w, tree, uses) in enumerate(trees):
                    margins[m] += parts[i] if used is None or not uses & used else w * tree.predict(rows)
                return (1 / (1 + np.exp(-2 * margins))).sum(axis=0) / len(forests)

            plain = score(x, None)
            for name in ([""] if base else []) + chosen:
                used = set(places.get(name, ()))
                swapped = x.copy() if used else x
                for i in used:
                    swapped[:, i] = o[:, i]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(batch)), batch.column(0),
                                                  pa.array(score(swapped, used) if used else plain)],
                                                 names=["feature", "y", "raw_pred"])

    return moved.mapInArrow(run, "feature string, y int, raw_pred double").toDF("feature", label, "raw_pred")


def permutation_importance(models: FoldModels, df: DataFrame, columns: Sequence[str] | None = None, repeats: int = 2,
                           label: str = d.LABEL, key: str = d.ROW_KEY, seed: int = d.SEED) -> DataFrame:
    """M7: mean and standard deviation of the blended-score drop when a column is shuffled; all columns unless given."""
    parts = [permuted_scores(models, df, columns, label, key, seed + 2 * r, base=not r).withColumn("round", F.lit(r))
             for r in range(repeats)]
    scores = metric_bundle(reduce(DataFrame.unionByName, parts), label, "raw_pred", ["feature", "round"])
    base = scores.where(F.col("feature") == "").select(F.col("score").alias("_base"))
    drops = scores.where(F.col("feature") != "").join(F.broadcast(base)).withColumn("drop", F.col("_base") - F.col("score"))
    return drops.groupBy("feature").agg(
        F.avg("drop").alias("mean_importance"), F.stddev_pop("drop").alias("std_importance"))


# fixed values: the nine dimensions of the search, with their ranges and steps
SEARCH_SPACE: Mapping[str, tuple] = {
    "learning_rate": ("log", 0.01, 0.2),
    "num_leaves": ("int", 32, 512, 32),
    "min_data_in_leaf": ("int", 100, 2000, 100),
    "feature_fraction": ("float", 0.6, 1.0),
    "bagging_fraction": ("float", 0.6, 1.0),
    "bagging_freq": ("int", 1, 7),
    "lambda_l1": ("log", 1e-3, 10.0),
    "lambda_l2": ("log", 1e-3, 10.0),
    "min_gain_to_split": ("float", 0.0, 1.0),
}


def trial_params(base: BoostParams, trial: int, seed: int = d.SEED,
                 space: Mapping[str, tuple] = SEARCH_SPACE) -> BoostParams:
    """Parameters of one trial, a function of (seed, trial) so that a search can be resumed.

    Trees are grown deep enough for the drawn number of leaves.
    """
    rng = random.Random(f"{seed}|{trial}")
    drawn = {}
    for name, (kind, low, high, *step) in space.items():
        if kind == "log":
            drawn[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        elif kind == "int":
            drawn[name] = rng.randrange(low, high + 1, *step)
        else:
            drawn[name] = rng.uniform(low, high)
    if "num_leaves" in drawn and "max_depth" not in drawn:
        drawn["max_depth"] = max(base.max_depth, math.ceil(math.log2(drawn["num_leaves"])) + 1)
    return replace(base, **drawn)


@dataclass
class Search:
    """Seeded random search that maximises the blended held-out score, by successive halving.

    All trials run for a few rounds; of each rung the best one in ``eta`` goes on, from its own trees, to ``eta`` times
    the rounds, the last rung to all of them.  Fewer than ``eta`` trials make a single rung.  Every finished (trial,
    rounds) is appended with its trees to a Parquet table under ``path``; a restarted search skips them and goes on.
    """

    path: str
    study: str = "search"
    trials: int = 10
    base: BoostParams = field(default_factory=BoostParams)
    folds: int = d.FOLDS
    seed: int = d.SEED
    space: Mapping[str, tuple] = field(default_factory=lambda: dict(SEARCH_SPACE))
    eta: int = 3

    _SCHEMA = ("study string, trial int, rounds int, params map<string,double>, ap double, logloss double, wll double, "
               "score double, progress array<string>")

    def history(self, spark) -> DataFrame:
        try:
            found = spark.read.schema(self._SCHEMA).parquet(self.path)
        except Exception as error:  # the table does not exist before the first trial
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return spark.createDataFrame([], self._SCHEMA)
        return found.where(F.col("study") == self.study)

    def rungs(self) -> list[tuple[int, int]]:
        """(trials, rounds) of every rung."""
        steps = 0
        while self.eta ** (steps + 1) <= self.trials:
            steps += 1
        return [(max(1, self.trials // self.eta ** j), max(1, self.base.rounds // self.eta ** (steps - j)))
                for j in range(steps + 1)]

    def run(self, df: DataFrame, label: str = d.LABEL, key: str = d.ROW_KEY, weight: str | None = None,
            fold: str | None = None, columns: Sequence[str] | None = None) -> BoostParams:
        spark = df.sparkSession
        if fold is None:
            fold = "_fold"
            df = df.withColumn(fold, hash_fold(key, self.folds, self.seed))
        shared: dict[int, Binned] = {}
        chosen, before = list(range(self.trials)), None
        for n, rounds in self.rungs():
            if before is not None:
                chosen = self._ranked(spark, before, chosen)[:n]
            done = {r["trial"] for r in self._rung(spark, rounds).select("trial").collect()}
            for trial in chosen:
                if trial in done:
                    continue
                params = trial_params(self.base, trial, self.seed, self.space)
                if params.max_bins not in shared:
                    shared[params.max_bins] = binned(df, fold, params.max_bins, label, key, weight, columns)
                self._go_on(shared[params.max_bins], params, trial, rounds, before)
            before = rounds
        for data in shared.values():
            data.table.unpersist()
        return trial_params(self.base, self._ranked(spark, before, chosen)[0], self.seed, self.space)

    def _rung(self, spark, rounds: int) -> DataFrame:
        return self.history(spark).where(F.col("rounds") == rounds)

    def _ranked(self, spark, rounds: int, trials: Sequence[int]) -> list[int]:
        rows = self._rung(spark, rounds).where(F.col("trial").isin(list(trials))).select("trial", "score")
        return [r["trial"] for r in rows.orderBy(F.desc("score"), "trial").collect()]

    def _go_on(self, data: Binned, params: BoostParams, trial: int, rounds: int, before: int | None) -> None:
        """Bring a trial to ``rounds`` and log it."""
        spark = data.table.sparkSession
        progress = None
        if before is not None:
            row = self._rung(spark, before).where(F.col("trial") == trial).select("progress").first()
            progress = [Progress.from_json(p) for p in row["progress"]]
        progress = data.boost(params, range(self.folds), rounds, progress)
        row = metric_bundle(data.held_scores(progress, params), data.label, "raw_pred").first()
        spark.createDataFrame(
            [(self.study, trial, rounds, {k: float(v) for k, v in asdict(params).items()}, row["ap"], row["logloss"],
              row["wll"], row["score"], [p.to_json() for p in progress])], self._SCHEMA,
        ).coalesce(1).write.mode("append").parquet(self.path)
