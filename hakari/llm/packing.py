"""Filling fixed-capacity containers: best fit over the histogram of lengths."""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import tokens


def plan(lengths: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int]]:
    """(length, first rank, first container, items each) from (length, count) pairs, lengths within the capacity.

    Best-fit decreasing over counts: containers with equal space left form a run [first, first + count). Items
    of a length go to the run with the least space that still takes one, as many into each container as fit;
    a run that is taken in part is split. The work grows with the number of lengths, not with the items.
    Each line says that from first rank on, items of the length go to consecutive containers, so many to each,
    up to the next line of the length.
    """
    spaces: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = {}
    lines, made = [], 0

    def put(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in runs:
                bisect.insort(spaces, space)
            runs.setdefault(space, []).append((first, count))

    for length, n in sorted(lengths, reverse=True):
        rank = 0
        while rank < n:
            at = bisect.bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, count = runs[space].pop()
                if not runs[space]:
                    del runs[space], spaces[at]
            else:
                space, first = capacity, made
                count = -(-(n - rank) // (capacity // length))
                made += count
            each = space // length
            full = min(count, (n - rank) // each)
            if full:
                lines.append((length, rank, first, each))
                rank += full * each
                put(space - each * length, first, full)
            first, count = first + full, count - full
            if count and rank < n:
                rest = n - rank  # fewer than one container takes
                lines.append((length, rank, first, rest))
                rank = n
                put(space - rest * length, first, 1)
                first, count = first + 1, count - 1
            put(space, first, count)
    return lines


def token_counts(docs: DataFrame, doc: str, text: str, path: str) -> DataFrame:
    """(doc, n_tokens) of whole texts; null and empty texts have 0."""

    @F.pandas_udf("long")
    def count(s: pd.Series) -> pd.Series:
        enc = tokens.encoding(path)
        return s.map(lambda t: len(enc.encode_ordinary(t)) if t else 0)

    return docs.select(F.col(doc).alias("doc"), count(text).alias("n_tokens"))


def pack(sizes: DataFrame, capacities: list[tuple[int, int]], per_bucket: int = 200_000) -> DataFrame:
    """(limit_id, container, doc, part, from_token, n_tokens): every item's place in containers of each capacity.

    sizes: (doc, n_tokens), one row an item; capacities: (limit_id, tokens). Only an item larger than the capacity is
    divided: into full containers of its own and a rest that is packed like an item. An item of 0 tokens takes
    no space and stands in container 0. The driver gets the histogram of rests: at most `capacity` lines for
    each limit, however many items there are. Items find their slots by joining on their rank within the length;
    the rank is counted within buckets of (length, hash of item) and added to the buckets' offsets, so a length
    that a third of all items share is not gathered in one task. Null items and sizes are left out; an item
    given twice is two items of the same name.
    """
    if not capacities:
        return sizes.limit(0).selectExpr("0L limit_id", "0L container", "doc", "0L part", "0L from_token", "n_tokens")
    limits = F.array(*[F.struct(F.lit(i).cast("long").alias("limit_id"), F.lit(c).cast("long").alias("cap")) for i, c in capacities])
    s = cut(sizes.where("doc is not null and n_tokens is not null"))
    each = s.select("doc", "n_tokens", F.explode(limits).alias("l")).select("doc", "n_tokens", "l.*")
    each = each.withColumn("whole", F.expr("if(n_tokens > cap, n_tokens div cap, 0)")).withColumn("rest", F.col("n_tokens") - F.col("whole") * F.col("cap"))
    items = each.where("rest > 0 or n_tokens = 0").select("limit_id", "cap", "doc", "whole", F.col("rest").alias("length"))
    hist = items.groupBy("limit_id", "length").agg(F.count("*").alias("n")).collect()
    spark = sizes.sparkSession
    lines = []
    top: dict[int, int] = {}
    for i, cap in capacities:
        p = plan([(r.length, r.n) for r in hist if r.limit_id == i and r.length], cap)
        lines += [(i, *x) for x in p]
        n = {r.length: r.n for r in hist if r.limit_id == i}
        ends = [*p[1:], None]
        top[i] = max((f + -(-((e[1] if e and e[0] == L else n[L]) - k) // m) for (L, k, f, m), e in zip(p, ends)), default=0)
    most = max([1, *(r.n for r in hist)])
    salts = max(1, -(-most // per_bucket))
    planned = spark.createDataFrame(lines or [(-1, -1, 0, 0, 1)], "limit_id long, length long, k long, first long, each long")
    planned = planned.groupBy("limit_id", "length").agg(F.array_sort(F.collect_list(F.struct("k", "first", "each"))).alias("plan"))
    items = items.withColumn("b", F.pmod(F.xxhash64("doc"), F.lit(salts)))
    sums = items.groupBy("limit_id", "length", "b").agg(F.count("*").alias("n"))
    sums = sums.selectExpr("limit_id", "length", "b", "sum(n) over (partition by limit_id, length order by b) - n as before")
    ranked = items.selectExpr("*", "row_number() over (partition by limit_id, length, b order by doc) - 1 as r")
    ranked = ranked.join(sums, ["limit_id", "length", "b"]).withColumn("rank", F.col("r") + F.col("before"))
    slot = ranked.join(planned, ["limit_id", "length"], "left").withColumn("p", F.element_at(F.filter("plan", lambda x: x.k <= F.col("rank")), -1))
    placed = slot.select("limit_id", F.coalesce(F.expr("p.first + (rank - p.k) div p.each"), F.lit(0)).alias("container"), "doc", F.col("whole").alias("part"), (F.col("whole") * F.col("cap")).alias("from_token"), F.col("length").alias("n_tokens"))
    start = F.create_map(*[F.lit(x).cast("long") for i, c in top.items() for x in (i, c)])
    big = each.where("whole > 0")
    bucket = big.withColumn("b", F.pmod(F.xxhash64("doc"), F.lit(1024)))
    offs = bucket.groupBy("limit_id", "b").agg(F.sum("whole").alias("n")).selectExpr("limit_id", "b", "sum(n) over (partition by limit_id order by b) - n as before")
    big = bucket.join(offs, ["limit_id", "b"]).selectExpr("*", "sum(whole) over (partition by limit_id, b order by doc rows unbounded preceding) - whole as own")
    full = big.select("limit_id", (start[F.col("limit_id")] + F.col("before") + F.col("own")).alias("c0"), "doc", "cap", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("part"))
    full = full.select("limit_id", (F.col("c0") + F.col("part")).alias("container"), "doc", "part", (F.col("part") * F.col("cap")).alias("from_token"), F.col("cap").alias("n_tokens"))
    return placed.unionByName(full)
