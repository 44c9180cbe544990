"""Splitting hot join keys.

AQE already splits a skewed partition of a single join. It cannot do so in a
chain of joins on one key, where the next join needs the partitioning that the
split would break. Such chains spread their fact table with ``HotKeys``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outledger.session import pin

# Rows without a key match nothing; they only have to leave one another's partition.
KEYLESS_PARTS = 4096

SALT = "_salt"


class HotKeys:
    """The hot keys of a fact table, and the two sides of a join that spreads them.

    One counting pass over the key columns writes every key with at least ``floor`` rows; the table
    is joined without a hint, so Spark broadcasts it only if its size allows. Without hot keys the
    join stays as it is. Otherwise ``spread`` gives the fact rows of a hot key one of
    ceil(rows / per_part) salts and ``repeat`` repeats the matching rows of another table once per
    salt; both then join on ``join_on``. The salt is a hash of the row, so a retried task chooses
    the same one.
    """

    def __init__(
        self, fact: DataFrame, on: Sequence[str], floor: int = 1_000_000, per_part: int = 1_000_000
    ):
        self.on = list(on)
        parts = F.ceil(F.col("_n") / per_part).cast("int")
        counts = fact.dropna(subset=self.on).groupBy(*on).agg(F.count("*").alias("_n"))
        hot = pin(counts.filter(F.col("_n") >= floor).select(*on, parts.alias("_parts")))
        self.rows = None if hot.isEmpty() else hot
        self.join_on = self.on if self.rows is None else [*self.on, SALT]

    def spread(self, fact: DataFrame) -> DataFrame:
        """Fact rows with their salt. Rows without a key match nothing and simply spread."""
        if self.rows is None:
            return fact
        keyless = reduce(or_, [F.col(c).isNull() for c in self.on])
        parts = F.when(keyless, KEYLESS_PARTS).otherwise(F.coalesce("_parts", F.lit(1)))
        row_hash = F.xxhash64(*[F.col(c) for c in fact.columns])
        return (
            fact.join(self.rows, self.on, "left")
            .withColumn(SALT, F.pmod(row_hash, parts).cast("int"))
            .drop("_parts")
        )

    def repeat(self, other: DataFrame) -> DataFrame:
        """Rows of another table, those of hot keys once per salt."""
        if self.rows is None:
            return other
        last = F.coalesce("_parts", F.lit(1)) - 1
        return (
            other.join(self.rows, self.on, "left")
            .withColumn(SALT, F.explode(F.sequence(F.lit(0), last)))
            .drop("_parts")
        )


def salted_join(
    fact: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner", **limits: int
) -> DataFrame:
    """Equi-join (inner, left, left_semi or left_anti) that spreads hot fact keys."""
    hot = HotKeys(fact, on, **limits)
    return hot.spread(fact).join(hot.repeat(other), hot.join_on, how).drop(SALT)
