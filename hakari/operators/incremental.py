"""Taking up where a run left off, and doing again only what a changed rule concerns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank


def todo(rows: DataFrame, done: DataFrame, key: Column, done_key: Column, url: str | None = None, most: int = 0, order: Column | None = None) -> DataFrame:
    """rows without a URL whose key is not done; the first `most` by `order`, if asked for."""
    if url:
        rows = rows.where(blank(F.col(url)) == "")
    left = rows.withColumn("_key", key).join(done.select(done_key.alias("_key")).distinct(), "_key", "left_anti").drop("_key")
    return left.orderBy(order).limit(most) if most else left


def invalidated(verified: DataFrame, url: Column, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): verified rows whose adopted URL a rule now forbids are dropped; sentinels in brackets stay."""
    u = blank(url)
    drop = F.coalesce((u != "") & ~u.startswith("（") & bad, F.lit(False))
    return verified.where(~drop), verified.where(drop)


def without(rows: DataFrame, key: Column, dropped: DataFrame, dropped_key: Column) -> DataFrame:
    return rows.withColumn("_key", key).join(dropped.select(dropped_key.alias("_key")).distinct(), "_key", "left_anti").drop("_key")


def surviving(rows: DataFrame, key: Column, kept: DataFrame, kept_key: Column) -> DataFrame:
    """rows whose non-blank key is among the kept ones."""
    return rows.withColumn("_key", F.nullif(key, F.lit(""))).join(kept.select(kept_key.alias("_key")).distinct(), "_key", "left_semi").drop("_key")


def portal_hosts(audit: DataFrame, host: Column, name: Column, pref: Column, already: Column, least: int, allowed: list[str] | None = None) -> DataFrame:
    """(host, n_names, n_prefs, examples) of hosts that stand on `least` or more distinct names. Counts are exact."""
    h = audit.select(host.alias("host"), F.coalesce(name, F.lit("")).alias("name"), F.coalesce(pref, F.lit("")).alias("pref"), already.alias("known")).where("host <> '' and not known")
    if allowed:
        h = h.where(~F.col("host").isin(allowed))
    names = h.groupBy("host", "name").agg(F.lit(1).alias("_"))
    counts = names.groupBy("host").agg(F.count("*").alias("n_names"))
    prefs = h.select("host", "pref").distinct().groupBy("host").agg(F.count("*").alias("n_prefs"))
    big = counts.where(F.col("n_names") >= least)
    few = names.join(big.select("host"), "host").selectExpr("host", "name", "row_number() over (partition by host order by name) as k").where("k <= 3")
    few = few.groupBy("host").agg(F.array_sort(F.collect_list("name")).alias("examples"))
    return big.join(prefs, "host").join(few, "host").orderBy(F.desc("n_names"), F.desc("n_prefs"), F.desc("host"))


def feedback(audit: DataFrame, verified: DataFrame, details: DataFrame, extra: list[str], columns: dict[str, str], blocked: Callable[[list[str]], Column], find: Callable[[DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """One pass of the loop: portals found in the audit join the extra hosts, verified rows and details that rest on
    them are dropped. The rules are handed over, never kept in a module. Found hosts are a short list by nature and are
    counted before they are taken to the driver."""
    found = [r.host for r in find(audit).limit(20_001).collect()]
    if len(found) > 20_000:
        raise ValueError("more than 20,000 portals: the bound for the rule is too low")
    hosts = sorted({*extra, *found})
    kept, gone = invalidated(verified, F.col(columns["url"]), blocked(hosts))
    k = F.col(columns["record"]).cast("string")
    return {"verified": kept, "details": without(details, k, gone, k), "dropped": gone, "extra": audit.sparkSession.createDataFrame([(h,) for h in hosts], "host string")}
