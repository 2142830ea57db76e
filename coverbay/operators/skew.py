"""A join that survives keys holding a large share of one side's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A key is hot above this. At most rows / ROWS_PER_SLICE keys can be, so the list that is broadcast
# has a millionth of the table's rows: about 20 MB for 10^12 of them.
ROWS_PER_SLICE = 1_000_000


def hot_keys(df: DataFrame, key: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Keys, NULL included, with very many rows, and the number of slices to cut each into."""
    counts = df.groupBy(F.col(key).alias("hot_key")).agg(F.count("*").alias("n"))
    hot = counts.where(F.col("n") > rows_per_slice)
    return hot.select("hot_key", F.ceil(F.col("n") / rows_per_slice).cast("int").alias("slices"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str,
    how: str = "left",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``left`` joined to ``right`` on ``key``, inner or left, with hot keys of ``left`` cut up.

    A row of a hot key goes to the slice its ``spread_by`` value hashes to, the same slice on
    every attempt of a task. Rows of ``right`` are repeated once per slice of their key, so every
    pair still meets exactly once. A hot key costs about one task per ``rows_per_slice`` rows.
    """
    hot = F.broadcast(hot_keys(left, key, rows_per_slice))
    slices = F.coalesce("slices", F.lit(1))
    salt = F.pmod(F.xxhash64(spread_by), slices).cast("int")
    salted_left = (
        left.join(hot, F.col(key).eqNullSafe(F.col("hot_key")), "left")
        .withColumn("salt", salt)
        .drop("hot_key", "slices")
    )
    salted_right = (
        right.join(hot, F.col(key) == F.col("hot_key"), "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("hot_key", "slices")
    )
    return salted_left.join(salted_right, [key, "salt"], how).drop("salt")
