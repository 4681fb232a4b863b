"""Cutting a table into numbered parts and joining lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .resolve import numbered


def without_headers(rows: DataFrame) -> DataFrame:
    """rows without repeated header lines: those that hold their column's name in every text column."""
    text = [c for c, kind in rows.dtypes if kind == "string"]
    if not text or len(text) < len(rows.columns):
        return rows
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.lit(c)) for c in text])
    return rows.where(~same)


def union_lists(lists: list[DataFrame], column: str = "list_id") -> DataFrame:
    """The lists one after another, each row with the number of its list; missing columns are null, repeated header lines
    of tables of text are dropped."""
    if not lists:
        raise ValueError("no list")
    each = [without_headers(d).withColumn(column, F.lit(i)) for i, d in enumerate(lists, 1)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each)


def row_parts(rows: DataFrame, order: list[str], size: int = 20_000, name: str = "part") -> DataFrame:
    """rows with the number of the part (from 0) that they fall into in the order given, `size` rows a part."""
    return numbered(rows, order, "_i").withColumn(name, F.expr(f"(_i - 1) div {int(size)}")).drop("_i")


def head(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n records in order; records, not lines, so line ends inside a field don't matter."""
    return rows.orderBy(*order).limit(n)
