"""Joins in which one key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def hot_keys(rows: DataFrame, on: list[str], least: int = 20_000, parts: int = 10_000, spots: int = 0) -> DataFrame | None:
    """(keys, _salts): the keys that more than `least` rows and more than one in `parts` of all rows share, with the number
    of tasks to spread each over. There are at most `parts` of them whatever the size, so the table may be broadcast.

    Rows are counted under partial aggregation. None if there is no such key.

    With spots, for rows that are dear to make and whose keys hardly repeat, they are counted by so many hash values first: no
    key has more rows than its spot, so only the keys of spots above the bound are counted, and mostly there are none.
    """
    spot = F.pmod(F.xxhash64(*on), F.lit(spots or 1)).cast("int")
    by_spot = rows.groupBy(spot.alias("_spot")).agg(F.count("*").alias("_n")) if spots else None
    n, most = [x or 0 for x in by_spot.agg(F.sum("_n"), F.max("_n")).first()] if spots else [rows.count()] * 2
    bound = max(least, -(-n // parts))
    if most <= bound:
        return None
    if spots:
        rows = rows.withColumn("_spot", spot).join(F.broadcast(cut(by_spot.where(F.col("_n") > bound).select("_spot"))), "_spot", "left_semi")
    counts = rows.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > bound)
    hot = cut(counts.select(*on, F.ceil(F.col("_n") / bound).cast("int").alias("_salts")))
    return hot if hot.limit(1).count() else None


def spread_join(left: DataFrame, right: DataFrame, on: list[str], hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """left.join(right, on, how), where the left rows of each hot key (as of hot_keys()) go to several tasks and its right
    rows are copied to each of them; no other row is copied."""
    if hot is None:
        return left.join(right, on, how)
    salts = F.coalesce("_salts", F.lit(1))
    mine = left.join(F.broadcast(hot), on, "left").withColumn("_salt", F.pmod(F.xxhash64(*left.columns), salts).cast("int")).drop("_salts")
    theirs = right.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return mine.join(theirs, [*on, "_salt"], how).drop("_salt")


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", least: int = 20_000, parts: int = 10_000) -> DataFrame:
    """left.join(right, on, how) for inner, left and semi joins, in which a hot key of `left` is spread over several tasks.

    left is read more than once: give a table or a checkpoint. Null keys join nothing, as in any join.
    """
    return spread_join(left, right, on, hot_keys(left, on, least, parts), how)
