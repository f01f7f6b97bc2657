"""Upsert as delete-matching-keys-then-append, on DataFrames.

Not a merge: a key's old rows all go and its new rows all come, duplicates
included. Rows with a null in the key delete nothing and are always appended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.operators.sizes import broadcast_if_small


def key_set(new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return new.select(*keys).dropna().distinct()


def _side(new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key set as a join side: broadcast once measured small, so the target is not
    shuffled to replace a few days or ids."""
    return broadcast_if_small(key_set(new, keys))


def matching(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows an upsert would delete."""
    return target.join(_side(new, keys), list(keys), "left_semi")


def matching_keys(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the target that an upsert would replace."""
    return matching(target.select(*keys).distinct(), new, keys)


def matching_count(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return matching(target.select(*keys), new, keys).agg(F.count(F.lit(1)).alias("matched"))


def unmatched(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows an upsert keeps."""
    return target.join(_side(new, keys), list(keys), "left_anti")


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return unmatched(target, new, keys).unionByName(new)
