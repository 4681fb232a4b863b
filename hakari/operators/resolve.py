"""Exact duplicates on a key: groups, representatives, look-alikes that are not duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank
from ..session import cut
from .skew import salted_join


def numbered(keys: DataFrame, order: list[str], name: str = "n", parts: int | None = None) -> DataFrame:
    """keys with their place (from 1) in the order of the columns `order`, without gathering them in one task.

    The rows are range-partitioned and sorted; each partition counts its rows, and the few counts of partitions are
    added up. Ties in `order` get places in no stated order. Null sorts first.
    """
    n = parts or max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut(keys.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id()))
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_b"))
    place = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) + F.col("_b")
    return ranged.join(F.broadcast(before), "_p").withColumn(name, place).drop("_p", "_b")


def _told_apart(rows: DataFrame, record: str, url: str, order: str | None) -> DataFrame:
    """rows with the struct _r that orders them within a group: a URL, the record id, earliness by `order`, and at last a
    number that no other row has. Written once, so that the number stays the same however often it is read."""
    has = (blank(F.col(url)) != "").cast("int")
    first = (-F.col(order) if order else F.lit(0)).cast("bigint")
    rank = F.struct(has.alias("u"), F.coalesce(F.col(record).cast("string").try_cast("bigint"), F.lit(0)).alias("r"), first.alias("o"), (-F.monotonically_increasing_id()).alias("n"))
    return rows.withColumn("_r", rank)


def duplicate_groups(rows: DataFrame, kind: str, key: str, record: str, url: str, order: str | None = None) -> DataFrame:
    """rows with dup_gid and is_rep: the group's number in the order of all keys, on groups of two or more; '1' on
    the one row that has a URL, else the highest record id, else comes first by `order`, else by the rows' own order.

    Numbers are given over all distinct keys (sparse, as only groups show theirs). Representatives come from max()
    under partial aggregation, and the rows of a key that a third of them share are joined over several tasks.
    Null keys are one group of their own; empty input gives an empty table.
    """
    k, v = F.coalesce(F.col(kind), F.lit("")), F.coalesce(F.col(key), F.lit(""))
    keyed = cut(_told_apart(rows.withColumn("_k", k).withColumn("_v", v), record, url, order))
    groups = keyed.groupBy("_k", "_v").agg(F.count("*").alias("_size"), F.max("_r").alias("_best"))
    groups = numbered(groups, ["_k", "_v"], "_at")
    out = salted_join(keyed, groups, ["_k", "_v"])
    gid = F.when(F.col("_size") > 1, F.format_string("G%06d", "_at")).otherwise("")
    return out.withColumn("dup_gid", gid).withColumn("is_rep", F.when(F.col("_r") == F.col("_best"), "1").otherwise("")).drop("_k", "_v", "_r", "_size", "_best", "_at")


def duplicate_groups_early(rows: DataFrame, kind: str, key: str, record: str, url: str, order: str) -> DataFrame:
    """The earlier form: every group has a number, by first appearance; the flag says 代表 on one row and 重複 on the others."""
    k, v = F.coalesce(F.col(kind), F.lit("")), F.coalesce(F.col(key), F.lit(""))
    keyed = cut(_told_apart(rows.withColumn("_k", k).withColumn("_v", v), record, url, order))
    groups = numbered(keyed.groupBy("_k", "_v").agg(F.min(order).alias("_first"), F.max("_r").alias("_best")), ["_first"], "_at")
    out = salted_join(keyed, groups, ["_k", "_v"])
    return out.withColumn("dup_gid", F.format_string("G%06d", "_at")).withColumn("is_rep", F.when(F.col("_r") == F.col("_best"), "代表").otherwise("重複")).drop("_k", "_v", "_r", "_first", "_best", "_at")


def collision_flags(rows: DataFrame, name: str, zip_: str, addr: str, out: str = "warn") -> DataFrame:
    """rows with marks for a name, or a postal code and address, that stands on several rows.

    name and addr are compared forms, zip_ digits. Counts are made on distinct values and joined back, so that a hot
    value is counted under partial aggregation. An empty postal code gives no address mark.
    """
    by_name = rows.groupBy(F.col(name).alias("_n")).agg(F.count("*").alias("_cn"))
    by_addr = rows.groupBy(F.col(zip_).alias("_z"), F.col(addr).alias("_a")).agg(F.count("*").alias("_ca"))
    x = rows.join(by_name, F.col(name).eqNullSafe(F.col("_n"))).join(by_addr, F.col(zip_).eqNullSafe(F.col("_z")) & F.col(addr).eqNullSafe(F.col("_a")))
    same_name = F.when(F.col("_cn") > 1, "同名別施設あり")
    same_addr = F.when((F.coalesce(F.col(zip_), F.lit("")) != "") & (F.col("_ca") > 1), "同一住所に別施設あり")
    return x.withColumn(out, F.concat_ws("／", same_name, same_addr)).drop("_n", "_cn", "_z", "_a", "_ca")


def prepare_stats(prepared: DataFrame, url: str = "url", gid: str = "dup_gid", warn: str = "warn") -> DataFrame:
    """One row: rows, duplicate groups and their rows, rows with a URL, rows with either mark."""
    has = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    return prepared.agg(
        F.count("*").alias("n_rows"), F.count_distinct(F.nullif(F.col(gid), F.lit(""))).alias("n_groups"), has(gid).alias("n_group_rows"), has(url).alias("n_url"),
        F.count_if(F.col(warn).contains("同名")).alias("n_same_name"), F.count_if(F.col(warn).contains("同一住所")).alias("n_same_addr"),
    )


def backfill_unique(rows: DataFrame, base: DataFrame, keys: list[tuple[Column, Column]], target: str, source: str) -> DataFrame:
    """rows whose blank `target` is filled from base's `source` by the first key that exactly one base row has.

    keys: pairs of (expression over rows, expression over base); blank keys never match. Rows that no key resolves
    keep null.
    """
    out = rows.withColumn("_got", F.nullif(blank(F.col(target).cast("string")), F.lit("")))
    for i, (mine, theirs) in enumerate(keys):
        only = base.select(theirs.alias(f"_k{i}"), F.col(source).cast("string").alias("_s")).where(f"coalesce(_k{i}, '') <> ''")
        only = only.groupBy(f"_k{i}").agg(F.count("*").alias("_n"), F.first("_s").alias("_s")).where("_n = 1").drop("_n")
        out = out.withColumn("_m", mine).join(only, F.col("_m") == F.col(f"_k{i}"), "left")
        out = out.withColumn("_got", F.coalesce("_got", "_s")).drop("_m", "_s", f"_k{i}")
    return out.withColumn(target, F.col("_got")).drop("_got")


def duplicate_report(rows: DataFrame, kind: str, key: str, name: str, order: str) -> DataFrame:
    """(kind, key, n, order, name): every member of the keys that two or more rows have, a row each, with the group's size.
    Groups of any size come out whole and none is collected; null kinds and keys are empty, a null name too."""
    r = cut(rows.select(F.coalesce(F.col(kind), F.lit("")).alias(kind), F.coalesce(F.col(key), F.lit("")).alias(key), order, F.coalesce(F.col(name), F.lit("")).alias(name)))
    groups = r.groupBy(kind, key).agg(F.count("*").alias("n")).where("n > 1")
    return salted_join(r, groups, [kind, key]).select(kind, key, "n", order, name)


def repaired(found: DataFrame, verified: DataFrame, details: DataFrame, base: DataFrame, record: str, code: str, name_addr: str) -> dict[str, DataFrame]:
    """The three kept tables with record ids filled in: search results by code, then name and address; verified rows by
    code only; both without what stays unknown; details by code, and only those of surviving records."""
    c = lambda k: F.coalesce(F.col(k), F.lit(""))
    by_code, by_name = (c(code), c(code)), (c(name_addr), c(name_addr))
    known = lambda d: d.where(F.col(record).isNotNull())
    kept = known(backfill_unique(verified, base, [by_code], record, record))
    return {
        "found": known(backfill_unique(found, base, [by_code, by_name], record, record)),
        "verified": kept,
        "details": known(backfill_unique(details, base, [by_code], record, record)).join(kept.select(record).distinct(), record, "left_semi"),
    }
