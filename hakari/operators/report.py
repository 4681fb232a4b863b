"""Checks of the results: histograms, coverage, hosts and addresses shared by too many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_values(rows: DataFrame, value: Column, name: str, top: int = 30, least: int = 5) -> DataFrame:
    """The `top` most frequent values, of those that occur `least` times or more; ties by value."""
    counts = rows.where(F.coalesce(value, F.lit("")) != "").groupBy(value.alias(name)).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), name).limit(top).where(F.col("n") >= least)


def shared_values(rows: DataFrame, value: Column, example: Column, order: Column, name: str, least: int = 5, top: int = 10) -> DataFrame:
    """Values on `least` or more rows, the `top` first of them, with the first three examples by `order`.

    Examples are looked up for the top values only, and by rank, so no group is collected whole.
    """
    r = rows.select(value.alias(name), example.alias("_e"), order.alias("_o")).where(F.coalesce(F.col(name), F.lit("")) != "")
    best = r.groupBy(name).agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), name).limit(top)
    lead = r.join(best.select(name), name)
    for_each = lead.groupBy(name).agg(*[F.min_by("_e", "_o").alias("e1")])
    ranked = lead.selectExpr(f"`{name}`", "_e", f"row_number() over (partition by `{name}` order by _o) as k").where("k <= 3")
    three = ranked.groupBy(name).agg(F.array_sort(F.collect_list(F.struct("k", "_e"))).alias("x")).select(name, F.transform("x", lambda x: x["_e"]).alias("examples"))
    return best.join(three, name).join(for_each.select(name), name)


def coverage(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row: n and, for each name, the rows where its column has a value."""
    return rows.agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(F.col(c), F.lit("")) != "").alias(k) for k, c in columns.items()])


def violations(rows: DataFrame, bad: Column) -> DataFrame:
    return rows.where(F.coalesce(bad, F.lit(False)))


def sample_of(rows: DataFrame, n: int = 20, seed: int = 1) -> DataFrame:
    """n rows at random, the same for the same seed and rows: this operator is the one that samples."""
    return rows.orderBy(F.xxhash64(F.lit(seed), *[c for c in rows.columns]), *rows.columns).limit(n)
