"""Variant spellings of names: prefix-filtered set-similarity join on tokens, verified by soft weighted similarity."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..operators.skew import hot_keys, salted_join, spread_join
from ..session import cut
from .names import FAMILIES, parts
from .skeleton import skeleton

#: Least soft similarity of two names: with a department in common, with departments missing, with others; and the least
#: share of equal q-grams, which the prefix filter rests on.
LIKE, LIKE_BARE, LIKE_OTHER, EQUAL = 0.25, 0.3, 0.75, 0.15
#: What a q-gram counts that has no equal but an ideograph in common with one, in the same place.
HALF = 0.5
#: Counters of q-grams: they stand for the counts of all q-grams, however many there are, in a table of fixed size.
COUNTERS = 1 << 20
_DEPARTMENTS = {line.split()[0]: i for i, line in enumerate(FAMILIES.strip().split("\n"))}


def _gram(x: str) -> tuple[int, int, int]:
    """A q-gram as (hash, its first and its last character where these are ideographs, else 0)."""
    wide = lambda c: ord(c) if ord(c) > 127 else 0
    return zlib.crc32(x.encode()) - (1 << 31), wide(x[0]), wide(x[-1])


def profiles(rows: DataFrame) -> DataFrame:
    """rows (record, name, …) with look (a hash of the skeleton), depts (a bit for each department family), and the q-grams
    of the proper part as it sounds: g hashes, a and z their first and last ideographs (0 where these are none). Rows
    without a name have no look and no q-grams."""

    def go(batches):
        for b in batches:
            look, depts, lists = [], [], []
            for n in b.column(b.schema.get_field_index("name")).to_pylist():
                if not n:
                    look.append(None), depts.append(0), lists.append([])
                    continue
                _, s, d = parts(n)
                look.append(skeleton(n))
                depts.append(sum(1 << _DEPARTMENTS[x] for x in d))
                lists.append(sorted({_gram(s[i : i + 2]) for i in range(len(s) - 1)} or ({_gram(s)} if s else set())))
            bounds = pa.array(np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int32))
            flat = np.array([y for x in lists for y in x], np.int32).reshape(-1, 3)
            arrays = [pa.ListArray.from_arrays(bounds, pa.array(np.ascontiguousarray(flat[:, j]))) for j in range(3)]
            keep = [i for i, c in enumerate(b.schema.names) if c != "name"]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(look, pa.string()), pa.array(depts, pa.int32()), *arrays], names=[*(b.schema.names[i] for i in keep), "look", "depts", "g", "a", "z"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "name")
    got = rows.mapInArrow(go, f"{shape}, look string, depts int, g array<int>, a array<int>, z array<int>")
    return got.withColumn("look", F.when(F.col("look").isNotNull(), F.xxhash64("look")))


def counted(lists: DataFrame, column: str) -> np.ndarray:
    """How many of the distinct lists of hashes in `column` have a hash, by counter, from 1; and at last the number of lists.
    All rows are counted; only sums go to the driver, at most COUNTERS."""
    out = np.ones(COUNTERS + 1, np.int64)
    each = lists.select(column).distinct().select(F.explode(F.array_append(column, F.lit(None))).alias("g"))
    for r in each.groupBy(F.coalesce(F.pmod("g", F.lit(COUNTERS)), F.lit(COUNTERS)).alias("at")).agg(F.count("*").alias("n")).toLocalIterator():
        out[r["at"]] = max(1, r.n)
    return out


def weighted(lists: DataFrame, counts: np.ndarray) -> DataFrame:
    """lists (pid, depts, code, g, a, z) with the q-grams in order of rarity, their weights w (the rarer, the heavier), the sum
    total, and pre: how many of them, rarest first, make up all but the share EQUAL of the weight."""
    sent = lists.sparkSession.sparkContext.broadcast(counts)

    def go(batches):
        count = sent.value
        for b in batches:
            g, a, z = (b.column(b.schema.get_field_index(k)) for k in "gaz")
            size = np.diff(g.offsets.to_numpy())
            row = np.repeat(np.arange(b.num_rows), size)
            flat = [x.flatten().to_numpy() for x in (g, a, z)]
            w = np.log(1 + count[-1] / count[np.mod(flat[0], COUNTERS)]).astype(np.float64)
            order = np.lexsort((flat[0], -w, row))
            flat, w = [x[order] for x in flat], w[order]
            bounds = np.append(0, np.cumsum(size))
            run = np.append(0.0, np.cumsum(w))
            total = run[bounds[1:]] - run[bounds[:-1]]
            before = run[:-1] - run[bounds[:-1]][row]
            pre = np.bincount(row[before <= total[row] * (1 - EQUAL) + 1e-9], minlength=b.num_rows)
            listed = lambda v: pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(v))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *map(listed, flat), listed(w), pa.array(total), pa.array(pre.astype(np.int32))], names=["pid", "depts", "code", "g", "a", "z", "w", "total", "pre"])

    return lists.select("pid", "depts", "code", "g", "a", "z").mapInArrow(go, "pid bigint, depts int, code string, g array<int>, a array<int>, z array<int>, w array<double>, total double, pre int")


def alike(pairs: DataFrame) -> DataFrame:
    """The pairs (columns x_… and y_…, x the lighter name; sure) whose names are alike: soft weighted similarity over the lighter
    side, where an official code or group in common (sure) asks for no more than EQUAL. An equal q-gram counts its weight; one with an ideograph in common in the same place counts HALF of it."""
    parts_ = F.arrays_zip("x_g", "x_a", "x_z", "x_w")
    has = lambda k, v: F.array_contains(f"y_{k}", v)
    equal = F.aggregate(parts_, F.lit(0.0), lambda t, q: t + F.when(has("g", q["x_g"]), q["x_w"]).otherwise(0.0))
    near = F.aggregate(parts_, F.lit(0.0), lambda t, q: t + F.when(has("g", q["x_g"]), 0.0).when(((q["x_a"] > 0) & has("a", q["x_a"])) | ((q["x_z"] > 0) & has("z", q["x_z"])), q["x_w"] * HALF).otherwise(0.0))
    both, least = F.bit_count(F.col("x_depts").bitwiseAND(F.col("y_depts"))), F.least(F.bit_count("x_depts"), F.bit_count("y_depts"))
    bound = F.when(F.col("sure"), EQUAL).when(least == 0, LIKE_BARE).when(both * 2 >= least, LIKE).otherwise(LIKE_OTHER)
    p = pairs.withColumn("_e", equal / F.col("x_total")).where(F.col("_e") >= EQUAL - 1e-9).withColumn("_s", F.col("_e") + near / F.col("x_total"))
    return p.where(F.col("_s") >= bound).drop("_e", "_s")


def similar(members: DataFrame, names: DataFrame, per_token: int = 20_000) -> DataFrame:
    """(a, b) of members (block, sure, pid, id) that share a context and have like names, by the names of weighted().

    One join over the whole table: a token is a context value with a q-gram. Prefix filter: a name probes with its rarest
    q-grams, as many as make up all but the share EQUAL of its weight, and a pair is found from its lighter side, so none
    that is alike is lost. Different valid codes are different facilities. Only numbers are joined; q-grams are fetched
    for distinct pairs of names, which are verified once. A hot token is spread over several tasks.
    """
    several = members.groupBy("block").agg(F.count("*").alias("n")).where("n > 1").select("block")
    m = members.join(several, "block", "left_semi").join(names.select("pid", "g", "pre", "total", F.xxhash64("code").alias("c"), F.col("code").isNotNull().alias("k")), "pid")
    m = cut(m.select("block", "sure", "pid", "id", "total", "k", "c", F.posexplode("g").alias("at", "q"), "pre").where("q is not null"))
    index = m.select(F.xxhash64("block", "q").alias("t"), F.col("block"), F.col("pid").alias("q_b"), F.col("id").alias("b"), F.col("total").alias("tb"), F.col("k").alias("kb"), F.col("c").alias("cb"))
    probe = m.where("at < pre").select(F.xxhash64("block", "q").alias("t"), F.col("block").alias("block_a"), "sure", F.col("pid").alias("q_a"), F.col("id").alias("a"), F.col("total").alias("ta"), F.col("k").alias("ka"), F.col("c").alias("ca"))
    met = spread_join(probe, index, ["t"], hot_keys(probe, ["t"], per_token))
    met = met.where("block = block_a and q_a <> q_b and (ta < tb or (ta = tb and q_a < q_b)) and (not ka or not kb or ca = cb)").select("q_a", "q_b", "sure", "a", "b").distinct()
    side = lambda p, k: names.select(F.col("pid").alias(k), *[F.col(c).alias(f"{p}_{c}") for c in ("g", "a", "z", "w", "total", "depts")])
    met = cut(met)
    good = alike(met.select("q_a", "q_b", "sure").distinct().join(side("x", "q_a"), "q_a").join(side("y", "q_b"), "q_b")).select("q_a", "q_b", "sure")
    return met.join(good, ["q_a", "q_b", "sure"]).select("a", "b").distinct()


def entities(rows: DataFrame, contexts: dict[str, bool], per_token: int = 20_000) -> DataFrame:
    """(record, look, entity) of rows (record, name, code, and the context columns): records of one entity.

    A context is a value that records of one entity may share: an official code or a group (True: sure, so that names need no more
    than some q-grams in common), a place or a web host (False: names must be alike by themselves). Records that
    share one and have like names (similar()) are linked, and what is linked is closed to components: a name alone links
    nothing, as one name at another place is another entity, and neither does a context. Names are reduced to distinct
    (q-grams, departments, code) within a context before the join; equal ones are linked to the first.
    Null contexts link nothing; rows without a name, or whose name has no proper part, are linked to none. Null records are
    left out; records delivered again count once.
    """
    blocks = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.xxhash64(F.lit(c), F.col(c).cast("string")).alias("block"), F.lit(sure).alias("sure"))) for c, sure in contexts.items()]))
    r = profiles(rows.where("record is not null").withColumn("_blocks", blocks).select("record", "name", "code", "_blocks"))
    r = cut(r.withColumn("pid", F.xxhash64("g", "depts", "code")))
    named = r.where("size(g) > 0")
    names = cut(weighted(named.select("pid", "depts", "code", "g", "a", "z").dropDuplicates(["pid"]), counted(named, "g")))
    e = cut(named.select(F.inline("_blocks"), "pid", "record").distinct())
    same = cut(e.groupBy("block", "sure", "pid").agg(F.min("record").alias("id"), F.count("*").alias("n")))
    first = same.where("n > 1").select("block", "pid", F.col("id").alias("b"))
    links = salted_join(e, first, ["block", "pid"]).select(F.col("record").alias("a"), "b").where("a <> b")
    comp = components(links.unionByName(similar(same.select("block", "sure", "pid", "id"), names, per_token)), "a", "b")
    return r.select("record", "look").distinct().join(comp, F.col("record") == F.col("node"), "left").select("record", "look", F.coalesce("component", "record").alias("entity"))


def variant_pairs(members: DataFrame, per_task: int = 4000) -> DataFrame:
    """(record_id_a, record_id_b), a < b, of records of one entity whose names look different."""
    m = members.where("look is not null").groupBy("entity", "record", "look").agg(F.lit(1).alias("_")).drop("_")
    mixed = m.groupBy("entity").agg(F.min("look").alias("lo"), F.max("look").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("entity", F.ceil(F.col("n") / per_task).alias("salts"))
    m = m.join(mixed, "entity")
    left = m.withColumn("salt", F.pmod(F.xxhash64("record"), F.col("salts")))
    right = m.select("entity", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.col("look").alias("look_b"), F.col("record").alias("record_id_b"))
    return left.join(right, ["entity", "salt"]).where("record < record_id_b and look <> look_b").select(F.col("record").alias("record_id_a"), "record_id_b").distinct()
