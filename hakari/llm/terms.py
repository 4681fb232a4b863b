"""Frequency of every distinct term, with heavy-light aggregation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.width import narrow
from ..operators.skew import salted_join
from ..session import cut


def hosts(c: Column) -> Column:
    """The distinct-keeping list of web hosts a field names; an empty list for null, blanks and fillers.

    Narrow, lower case, without scheme, user, leading www., port, final dots and path. A host has a dot in it.
    """
    parts = F.split(F.lower(narrow(c)), r"(?U)[\s、，,;|｜；<>()\"']+")
    at = lambda x: F.regexp_replace(F.regexp_replace(x, r"^[a-z][a-z0-9+.\-]*:/+", ""), r"[/?#\\].*$", "")
    bare = lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(at(x), r"^.*@|:\d*$", ""), r"\.+$", ""), r"^www\.", "")
    named = F.filter(F.transform(parts, bare), lambda h: h.rlike(r"(?U)^[\w\-]+(\.[\w\-]+)+$"))
    return F.coalesce(named, F.array().cast("array<string>"))


def heavy_terms(lists: DataFrame, terms: str, most: int = 256, share: float = 0.001) -> list[str]:
    """At most `most` terms that seem to make up `share` of all occurrences or more, from one pass with a bounded sketch;
    exactness doesn't hang on them."""
    got = lists.select(F.explode(terms).alias("term")).agg(F.expr(f"approx_top_k(term, {most}, {most * 32})").alias("t"), F.count("term").alias("n")).first()
    return sorted(x[0] for x in got["t"] or [] if x[0] is not None and x[1] >= share * got["n"])


#: Record ids in several rows that are broadcast at most; more of them are joined.
REPEATED = 1_000_000


def frequencies(rows: DataFrame, record: str, terms: Column, heavy: int = 256, repeated: int = REPEATED) -> DataFrame:
    """(term, occurrences, records): how often each distinct term stands in `terms` and in how many records.

    Heavy-light aggregation: heavy terms are found by a sketch and broadcast (at most `heavy` strings, a fixed bound);
    each task counts them in an exact array of counters and sends one line a term; only the other terms are shuffled,
    by term, and both tables are put together. A row whose record stands in no other row, and that names no term
    twice, adds one occurrence and one record to each of its terms, so no heavy row is exchanged. Records that were
    delivered several times are found by their bare ids; their rows, few as they are, take the exact way by
    (record, term). These ids are broadcast up to `repeated` of them, else joined with hot ids spread.
    A null record id is one record of its own name-less kind: its terms count as occurrences, and as one record.
    Null and empty fields name no term. Other columns of the rows don't matter. Nothing is sampled or capped.
    """
    base = rows.select(F.col(record).alias("_r"), F.filter(terms, lambda x: x.isNotNull()).alias("_t")).where("size(_t) > 0")
    ids = rows.select(F.col(record).alias("_r")).where("_r is not null").groupBy("_r").agg(F.count("*").alias("_n")).where("_n > 1").select("_r", F.lit(True).alias("_again"))
    ids = cut(ids)
    if ids.limit(repeated + 1).count() <= repeated:
        base = base.join(F.broadcast(ids), "_r", "left")
    else:
        base = salted_join(base, ids, ["_r"], "left")
    twice = F.coalesce("_again", F.lit(False)) | F.col("_r").isNull() | (F.size(F.array_distinct("_t")) < F.size("_t"))
    top = heavy_terms(rows.select(terms.alias("_t")), "_t", heavy)
    shape = "term string, occurrences long, records long"

    def count(batches):
        at, n = pa.array(top, pa.string()), np.zeros(len(top), np.int64)
        for b in batches:
            n += np.bincount(pc.index_in(b.column(0), at).to_numpy(zero_copy_only=False).astype(np.int64), minlength=len(top))
        here = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([top[i] for i in here], pa.string()), pa.array(n[here]), pa.array(n[here])], names=["term", "occurrences", "records"])

    each = base.select(twice.alias("_twice"), "_r", F.explode("_t").alias("term"))
    light = each.where(F.col("_twice") | ~F.col("term").isin(top)) if top else each
    light = light.groupBy("_twice", F.when(F.col("_twice"), F.col("_r")).alias("_r"), "term").agg(F.count("*").alias("occurrences"))
    every = light.select("term", "occurrences", F.when(F.col("_twice"), F.lit(1).cast("long")).otherwise(F.col("occurrences")).alias("records"))
    if top:
        every = every.unionByName(base.where(~twice).select(F.explode("_t").alias("term")).where(F.col("term").isin(top)).mapInArrow(count, shape))
    return every.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


def marked(counts: DataFrame, rare: int = 1, common: int = 20) -> DataFrame:
    """The counts with a column mark: 'rare' for at most `rare` records, 'common' for at least `common`, else null."""
    return counts.withColumn("mark", F.when(F.col("records") <= rare, "rare").when(F.col("records") >= common, "common"))
