"""Standardization that is fitted on training rows alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .history import split_rows


def fold_statistics(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: each feature's mean, population deviation, count and whether it doesn't vary, over the rows whose split is train."""
    train = rows.filter("split = 'train'")
    flat = lambda c: F.coalesce(F.min(c) == F.max(c), F.lit(False))
    # partial means of equal values differ in their last bits, which leaves a deviation when they are merged
    std = lambda c: F.when(flat(c) & (F.abs(F.min(c)) < float("inf")), 0.0).otherwise(F.stddev_pop(c))
    return train.agg(*[f(c).alias(f"{c}_{n}") for c in features for n, f in (("mean", F.avg), ("std", std), ("count", F.count), ("zero_variance", flat))])


def standardize(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Each feature as (x - mean) / std; null where the value or the mean is, or where the training values don't vary.

    A value that is not finite is an error.
    """
    stats = fold_statistics(rows, features)  # one row
    finite = lambda c: F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.raise_error(F.lit(f"{c} is not finite")).cast("double")).otherwise(F.col(c))
    scaled = [F.when(F.col(f"{c}_std") > 0, (finite(c) - F.col(f"{c}_mean")) / F.col(f"{c}_std")).alias(c) for c in features]
    other = [c for c in rows.columns if c not in features]
    return rows.join(F.broadcast(stats), how="cross").select(*other, *scaled)


def standardize_fold(rows: DataFrame, fold: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """standardize() of rows whose split comes from a fold (keys and split) that must cover them exactly."""
    return standardize(split_rows(rows, fold, keys), features)
