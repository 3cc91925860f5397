"""The full preprocessing recipe (F24): fit on the training rows, transform any rows."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame

from clickloom import defaults as d
from clickloom.functions.calendar import add_time_period, cyclical
from clickloom.functions.columns import drop_columns
from clickloom.functions.missing import fill_categories, missing_flags
from clickloom.functions.sequence import add_seq_crosses, add_seq_features
from clickloom.operators.encode import DictionaryEncoder, DictionaryModel, RateEncoder, RateModel
from clickloom.operators.lookup import Lookup, attach_all, attach_by_row


@dataclass
class PreprocessConfig:
    categorical: list[str] = field(default_factory=lambda: list(d.CATEGORICAL))
    frequency: list[str] = field(default_factory=lambda: list(d.FREQUENCY_ENCODED))
    target_pairs: list[tuple[str, str]] = field(default_factory=lambda: list(d.TARGET_ENCODED_PAIRS))
    dictionary: list[str] = field(default_factory=lambda: list(d.DICTIONARY_ENCODED))
    crosses: list[tuple[str, str]] = field(default_factory=lambda: list(d.SEQ_CROSSES))
    periods: list[tuple[int, int, str]] = field(default_factory=lambda: list(d.TIME_PERIODS))
    flags: dict[str, list[str]] = field(default_factory=lambda: dict(d.MISSING_FLAGS))
    collinear: list[str] = field(default_factory=lambda: list(d.COLLINEAR))
    label: str = d.LABEL
    row_key: str = d.ROW_KEY
    folds: int = d.FOLDS
    seed: int = d.SEED

    def to_dict(self) -> dict:
        return asdict(self)


def row_features(df: DataFrame, config: PreprocessConfig) -> DataFrame:
    """The stages that look at one row only; one projection over the scan.

    Missing flags see the raw numbers, because the category fill touches only the category columns.
    """
    df = fill_categories(df, config.categorical)
    df = cyclical(df)
    df = add_time_period(df, config.periods)
    df = add_seq_features(df)
    df = add_seq_crosses(df, config.crosses)
    return missing_flags(df, config.flags).drop("seq")


@dataclass
class Preprocessor:
    config: PreprocessConfig = field(default_factory=PreprocessConfig)

    def prepare(self, df: DataFrame) -> DataFrame:
        """The row-wise stages.  Written out once, the result spares the later scans the long sequence text."""
        return row_features(df, self.config)

    def fit(self, train: DataFrame, test: DataFrame | None = None, prepared: bool = False) -> "PreprocessModel":
        """Two scans of the training rows and one of the test rows; only small tables are kept."""
        c = self.config
        frames = [f if prepared else row_features(f, c) for f in (train, test) if f is not None]
        rates = RateEncoder(c.frequency, c.target_pairs, c.label, folds=c.folds, seed=c.seed, row_key=c.row_key).fit(frames[0])
        codes = DictionaryEncoder(c.dictionary, c.row_key).fit(*frames)
        return PreprocessModel(c, rates, codes)


@dataclass
class PreprocessModel:
    config: PreprocessConfig
    rates: RateModel
    codes: DictionaryModel

    def transform_train(self, df: DataFrame, embeddings: DataFrame | None = None, keep_key: bool = False,
                        prepared: bool = False) -> DataFrame:
        ready = df if prepared else row_features(df, self.config)
        return self._finish(ready, self.rates.train_lookups(ready), embeddings, keep_key)

    def transform_new(self, df: DataFrame, embeddings: DataFrame | None = None, keep_key: bool = False,
                      prepared: bool = False) -> DataFrame:
        ready = df if prepared else row_features(df, self.config)
        return self._finish(ready, self.rates.new_lookups(ready), embeddings, keep_key)

    def _finish(self, df: DataFrame, targets: list[Lookup], embeddings: DataFrame | None, keep_key: bool) -> DataFrame:
        """All tables at once, so that the rows move once at most."""
        lookups = [*self.rates.frequency_lookups(df), *targets, *self.codes.lookups(df)]
        df = self.codes.without_sources(attach_all(df, lookups, self.config.row_key))
        df = drop_columns(df, self.config.collinear)
        if embeddings is not None:
            df = attach_by_row(df, embeddings, self.config.row_key)
        return df if keep_key else df.drop(self.config.row_key)

    def release(self) -> None:
        self.rates.release()
        self.codes.release()
