"""Deterministic pseudo-random draws from a stable row key.

Every draw is a pure function of (seed, key): it does not depend on row position, partitioning or
retries, and any engine with MD5 can reproduce it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from clickloom import defaults as d

DRAW_BITS = 60
_DRAW_RANGE = float(1 << DRAW_BITS)


def _hex_prefix(key: str | Column, seed: int, digits: int) -> Column:
    col = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}|"), col.cast("string")))
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def hash_fold(key: str | Column = d.ROW_KEY, folds: int = d.FOLDS, seed: int = d.SEED) -> Column:
    """Fold number 0..folds-1."""
    return (_hex_prefix(key, seed, 8) % folds).cast("int")


def draw(key: str | Column = d.ROW_KEY, seed: int = d.SEED) -> Column:
    """A uniform 60-bit integer; sort by (draw, key) for a full shuffle."""
    return _hex_prefix(key, seed, 15)


def unit_draw(key: str | Column = d.ROW_KEY, seed: int = d.SEED) -> Column:
    """A uniform number in [0, 1)."""
    return draw(key, seed).cast("double") / _DRAW_RANGE


def draw_bucket(drawn: Column, buckets: Column) -> Column:
    """Which of ``buckets`` equal slices of the draw range a draw falls into; monotone in the draw."""
    slot = F.floor(drawn.cast("double") / _DRAW_RANGE * buckets.cast("double")).cast("bigint")
    return F.least(slot, buckets.cast("bigint") - 1)


def hash_split(key: str | Column = d.ROW_KEY, share: float = 0.2, seed: int = d.SEED) -> Column:
    """True for the held-out share."""
    return unit_draw(key, seed) < share
