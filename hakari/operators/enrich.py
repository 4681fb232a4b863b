"""Filling values from other tables: by key with a fallback key, first or last row wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import blank


def one_per_key(rows: DataFrame, key: Column, order: list[Column], last: bool, columns: list[str]) -> DataFrame:
    """(_key, _row): the first or last row of each non-blank key, as a struct of `columns`.

    By min_by or max_by under partial aggregation, so a hot key is combined on the map side.
    """
    row, by = F.struct(*columns), F.struct(*order)
    pick = F.max_by(row, by) if last else F.min_by(row, by)
    return rows.where(F.coalesce(key, F.lit("")) != "").groupBy(key.alias("_key")).agg(pick.alias("_row"))


def fallback_join(left: DataFrame, right: DataFrame, keys: list[tuple[Column, Column, bool]], order: list[Column], columns: list[str], out: str = "hit") -> DataFrame:
    """left with the struct `out`: columns of the right row that the first matching key finds, else null.

    keys: (expression over left, expression over right, whether the last row of a key wins). A blank key never
    matches; a key that is there but unmatched gives way to the next. Every join is on at most one row a key, so
    left rows never multiply. Small sides are broadcast by the optimizer's own size check.
    """
    found = []
    for i, (mine, theirs, last) in enumerate(keys):
        side = one_per_key(right, theirs, order, last, columns).select(F.col("_key").alias(f"_k{i}"), F.col("_row").alias(f"_r{i}"))
        left = left.withColumn(f"_m{i}", F.nullif(mine, F.lit(""))).join(side, F.col(f"_m{i}") == F.col(f"_k{i}"), "left")
        found.append(f"_r{i}")
    return left.withColumn(out, F.coalesce(*found)).drop(*[f"_{a}{i}" for i in range(len(keys)) for a in "kmr"])


def fill_urls(work: DataFrame, opened: DataFrame, url: str = "url", code: str = "code", phone: str = "phone", order: list[Column] | None = None) -> DataFrame:
    """work with `url` filled by code, else telephone, from opened (url, code, phone), and url_source.

    The first row of a key wins; codes need ten digits, telephones nine or more. Rows with a URL keep it.
    """
    usable = opened.where(F.lower("url").startswith("http"))
    ten = F.when(F.length(F.col("code")) == 10, F.col("code"))
    nine = F.when(F.length(F.col("phone")) >= 9, F.col("phone"))
    hit = fallback_join(work, usable, [(F.col(code), ten, False), (F.col(phone), nine, False)], order or [F.col("url")], ["url"])
    own = blank(F.col(url)) != ""
    source = F.when(own, "元データ").when(F.col("hit").isNotNull(), "オープンデータ").otherwise("")
    return hit.withColumn("url_source", source).withColumn(url, F.when(own, F.col(url)).otherwise(F.coalesce(F.col("hit.url"), F.lit("")))).drop("hit")


def fill_stats(filled: DataFrame) -> DataFrame:
    n = lambda s: F.count_if(F.col("url_source") == s)
    return filled.agg(F.count("*").alias("n_rows"), n("元データ").alias("n_already"), n("オープンデータ").alias("n_filled"), n("").alias("n_left"))


def outcomes(rows: DataFrame, url: Column, source: Column, hit: Column, hit_confidence: Column, hit_url: Column, apply: tuple[str, ...] = ("高",)) -> DataFrame:
    """rows with confidence, outcome, final_url and final_source.

    A row's own URL counts as sure, under its source; without it the found row decides: none is 未処理, a confidence
    outside 高 中 低 is 未検出, and only a confidence in `apply` brings its URL in.
    """
    own = blank(url) != ""
    said = F.when(hit_confidence.isin("高", "中", "低"), hit_confidence).otherwise("未検出")
    conf = F.when(own, "高").when(hit.isNull(), "未処理").otherwise(said)
    known = F.when(source.isin("元データ", "オープンデータ"), source).otherwise("元データ")
    take = ~own & hit.isNotNull() & conf.isin(*apply)
    return (
        rows.withColumn("confidence", conf).withColumn("outcome", F.when(own, known).otherwise(conf))
        .withColumn("final_url", F.when(own, url).when(take, hit_url).otherwise(""))
        .withColumn("final_source", F.when(take, "検索+照合").otherwise(F.coalesce(source, F.lit(""))))
    )


def histogram(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def without_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """rows without those of the columns that are there."""
    return rows.drop(*[n for n in names if n in rows.columns])


def merge_details(audit: DataFrame, details: DataFrame, record: str, codes: list[str], order: list[Column], known: list[str] = rules.DETAILS_KNOWN, hit: str = "hit") -> DataFrame:
    """audit with the columns of details that it doesn't know, '' where there are none, and whether a row was found: by
    record id (the last such row by `order`), else by code (the first). codes: columns of audit that may hold the code, the
    first that has one counts. details has `record` and the last of the known code columns' names."""
    own = [c for c in details.columns if c not in {*known, record, *codes}]
    code = F.coalesce(*[F.nullif(blank(F.col(c).cast("string")), F.lit("")) for c in codes if c in audit.columns], F.lit(""))
    theirs = next(c for c in codes if c in details.columns)
    side = details.select(blank(F.col(record).cast("string")).alias("_rid"), blank(F.col(theirs).cast("string")).alias("_code"), F.struct(*order).alias("_at"), F.struct(*[F.col(c) for c in own]).alias("_d"))
    j = fallback_join(audit, side, [(blank(F.col(record).cast("string")), F.col("_rid"), True), (code, F.col("_code"), False)], [F.col("_at")], ["_d"], "_hit")
    return j.select(*audit.columns, *[F.coalesce(F.col(f"_hit._d.`{c}`").cast("string"), F.lit("")).alias(c) for c in own if c not in audit.columns], F.col("_hit").isNotNull().alias(hit))


def hit_rate(merged: DataFrame, hit: str = "hit") -> DataFrame:
    """One row: rows, rows with details, and their share (null without rows)."""
    one = merged.agg(F.count("*").alias("n"), F.count_if(hit).alias("n_hit"))
    return one.withColumn("share", F.try_divide(F.col("n_hit").cast("double"), F.col("n")))
