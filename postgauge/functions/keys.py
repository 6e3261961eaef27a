"""Hash order keys, name slugs and run identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(seed: int, value: Column) -> Column:
    """A repeatable pseudo-random sort key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), value.cast("string")))


def hash_fold(seed: int, value: Column, n_folds: int) -> Column:
    """Fold 1..n from the leading hash digits; needs no pass over the data."""
    digits = F.conv(F.substring(order_key(seed, value), 1, 8), 16, 10).cast("bigint")
    return (F.pmod(digits, F.lit(n_folds)) + 1).cast("int")


def slug(value: Column) -> Column:
    """Lower-case letters and digits joined by hyphens."""
    joined = F.regexp_replace(F.lower(value), "[^a-z0-9]+", "-")
    trimmed = F.regexp_replace(joined, "^-+|-+$", "")
    return F.when(trimmed == "", "sin-nombre").otherwise(trimmed)


def model_slug(value: Column) -> Column:
    """Letters and digits joined by underscores, lower case."""
    joined = F.regexp_replace(value, "[^a-zA-Z0-9]+", "_")
    return F.lower(F.regexp_replace(joined, "^_+|_+$", ""))


def run_id(experiment: Column, classifier: Column, features: Column, started_at: Column) -> Column:
    """Slugs of the three names and the compact start time."""
    compact = F.regexp_replace(started_at, "[-:+]", "")
    compact = F.replace(F.replace(compact, F.lit("T"), F.lit("-")), F.lit("Z"), F.lit("z"))
    return F.concat_ws("__", slug(experiment), slug(classifier), slug(features), compact)
