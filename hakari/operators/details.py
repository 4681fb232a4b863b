"""Columns with hours, closing days and departments from what was kept of the pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.clock import closed_days, time_ranges
from ..functions.departments import basic_areas, merged

SLOTS, DEPARTMENT_CELLS, AREA_CELLS = 3, 8, 5


def _cells(values: Column, names: list[str]) -> dict[str, Column]:
    return {n: F.coalesce(F.get(values, F.lit(i)), F.lit("")) for i, n in enumerate(names)}


def details(raw: DataFrame) -> DataFrame:
    """raw (record, name, tables, context, found: struct<title, section, nav>, …) with the detail columns.

    Missing parts are empty lists; the columns of the input stay. Everything can be made again from the raw parts.
    """
    none = F.array().cast("array<string>")
    lines = F.concat(F.coalesce("tables", none), F.coalesce("context", none))
    x = raw.withColumn("_raw", T.strip(F.array_join(lines, "\n"))).withColumn("_f", T.nfkc(F.col("_raw"))).withColumn("_n", T.nfkc(F.col("name")))
    x = x.withColumn("_r", F.slice(time_ranges(F.col("_f")), 1, SLOTS)).withColumn("休診日", closed_days(F.col("_f"))).withColumn("_d", merged(F.col("found"), F.col("_n")))
    shown = F.concat_ws("　", F.when(F.size("_r") > 0, F.array_join("_r", " / ")), F.when(F.col("休診日") != "", F.concat(F.lit("休診: "), F.col("休診日"))))
    x = x.withColumn("診療時間（整形）", shown)
    ends = F.flatten(F.transform("_r", lambda r: F.split(r, "-")))
    x = x.withColumns(_cells(ends, [f"時間帯{i}{e}" for i in range(1, SLOTS + 1) for e in ("開始", "終了")]))
    names, areas = F.col("_d.names"), basic_areas(F.col("_d.names"))
    x = x.withColumn("診療科目", F.array_join(names, "・")).withColumns(_cells(names, [f"診療科目{i}" for i in range(1, DEPARTMENT_CELLS + 1)])).withColumn("診療科目数", F.size(names)).withColumn("診療科目の出所", F.col("_d.source"))
    x = x.withColumn("基本領域", F.array_join(areas, ";")).withColumns(_cells(areas, [f"基本領域{i}" for i in range(1, AREA_CELLS + 1)])).withColumn("基本領域数", F.size(areas))
    return x.withColumn("診療時間（原文）", F.substring(F.regexp_replace("_raw", r"(?U)\s*\n\s*", " / "), 1, 900)).drop("_raw", "_f", "_n", "_r", "_d")


def coverage(detailed: DataFrame) -> DataFrame:
    """One row: rows, rows with times, departments and basic areas, and their shares (null without rows)."""
    has = {"n_parsed": "時間帯1開始", "n_dept": "診療科目", "n_basic": "基本領域"}
    one = detailed.agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(F.col(c), F.lit("")) != "").alias(k) for k, c in has.items()])
    return one.select("*", *[F.try_divide(F.col(k), F.col("n")).alias(k.replace("n_", "share_")) for k in has])


def crm_rows(rows: DataFrame, columns: list[tuple[str, str]], key: str = "レコードID") -> DataFrame:
    """Key and renamed columns, of rows with a key and at least one value; missing columns are empty, a missing key
    is an error."""
    if key not in rows.columns:
        raise ValueError(f"there is no column {key}: rows could not be told apart")
    out = [(F.coalesce(T.strip(F.col(s).cast("string")), F.lit("")) if s in rows.columns else F.lit("")).alias(d) for d, s in columns]
    got = rows.select(T.blank(F.col(key).cast("string")).alias(key), *out)
    any_value = F.exists(F.array(*[F.col(d) for d, _ in columns]), lambda v: v != "")
    return got.where((F.col(key) != "") & any_value)


def fill_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n): rows with a value, a line for each column, from one pass."""
    one = rows.agg(*[F.count_if(F.coalesce(F.col(c), F.lit("")) != "").alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n")) for i, c in enumerate(columns)])
    return one.select(F.inline(pairs))
