"""Grouping keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timing import as_column

# Fixed values.
SALT_PREFIX = "groupKey_"
SALT_COUNT = 5


def key_text(col: str | Column) -> Column:
    """A key as text; a null key fails the query."""
    return F.coalesce(as_column(col).cast("string"), F.raise_error(F.lit("null key")).cast("string"))


def salt_key(row_id: str | Column, salts: int = SALT_COUNT) -> Column:
    """One of ``salts`` keys by row id. A retried task computes the same key again."""
    return F.concat(F.lit(SALT_PREFIX), F.pmod(as_column(row_id), F.lit(salts)).cast("string"))


def hashed_salt_key(*cols: str | Column, salts: int = SALT_COUNT) -> Column:
    """G2 for rows without a numeric id."""
    return salt_key(F.xxhash64(*[as_column(c) for c in cols]), salts)


def random_salt_key(salts: int = SALT_COUNT) -> Column:
    """G2 drawn at random. A retried task draws anew, so prefer the forms above."""
    return F.concat(F.lit(SALT_PREFIX), F.floor(F.rand() * salts).cast("string"))


def key_by(df: DataFrame, key: str | Column, row_id: str | Column, spread: int = 16) -> DataFrame:
    """G1 without an aggregate: bring the rows of a key together.

    Each key goes to at most ``spread`` partitions, so that one that holds a third of all rows
    does not land in a single task. ``spread=1`` keeps a key whole.
    """
    salt = F.pmod(F.xxhash64(as_column(row_id)), F.lit(spread))
    return df.withColumn("key", key_text(key)).withColumn("__salt", salt).repartition("key", "__salt").drop("__salt")
