"""Best representative of each duplicate group: Bayesian fusion with copy detection."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.width import digits, narrow, strip
from ..operators.skew import salted_join
from ..session import cut

N_FALSE, COPIED, PRIOR = 20, 0.8, 0.1


def plain_group(c: Column) -> Column:
    """A group id in plain form: narrow, upper case, without blanks; null where it isn't G and eight digits."""
    g = F.upper(strip(narrow(c)))
    return F.when(g.rlike(r"^G[0-9]{8}$"), g)


def url_host(c: Column) -> Column:
    """The host of an http(s) address: narrow, lower case, without user, port and final dots; null if there is none."""
    u = F.lower(strip(narrow(c)))
    h = F.regexp_extract(u, r"^https?://([^/?#\s\\]*)", 1)
    h = F.regexp_replace(F.regexp_replace(F.regexp_replace(h, r"^.*@", ""), r":\d*$", ""), r"\.+$", "")
    return F.when(h.rlike(r"^[^.\s]+(\.[^.\s]+)+$"), h)


def good_host(host: Column, blocked: list[str]) -> Column:
    """Whether a host is there and neither is a blocked one nor lies under one. Give a column, not a long expression."""
    if not blocked:
        return host.isNotNull()
    if len(blocked) <= 500:
        bad = host.rlike(r"(?:^|\.)(?:" + "|".join(b.replace(".", r"\.") for b in blocked) + ")$")
    else:
        labels = F.split(host, r"\.")
        ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
        bad = F.arrays_overlap(ends, F.array(*map(F.lit, blocked)))
    return F.coalesce(host.isNotNull() & ~bad, F.lit(False))


def blocked_hosts(rules: DataFrame, most: int = 20_000) -> list[str]:
    """The hosts of a rule table, without comments and blanks. A rule table is kept by hand; it is counted first."""
    h = rules.select(F.lower(strip(narrow(F.col("host")))).alias("h")).where("h <> '' and not h like '#%'").distinct()
    got = [r.h for r in h.limit(most + 1).collect()]
    if len(got) > most:
        raise ValueError(f"more than {most} blocked hosts: no rule table")
    return sorted(got)


def good_zip(c: Column) -> Column:
    d = digits(c)
    return F.coalesce(d.rlike(r"^[0-9]{7}$") & ~d.rlike(r"^(\d)\1*$"), F.lit(False))


def good_address(c: Column) -> Column:
    return F.coalesce(c.rlike(r"[\p{Nd}〇一二三四五六七八九十]"), F.lit(False))


def _dependence(kt, kf, kd, acc) -> np.ndarray:
    """Probability that two sources are dependent, given the true, false and differing values they share."""
    a = np.clip((acc[:, None] + acc[None, :]) / 2, 0.05, 0.95)
    t, f = a * a, (1 - a) ** 2 / N_FALSE
    d = 1 - t - f
    log = kt * np.log(t / (a * COPIED + t * (1 - COPIED))) + kf * np.log(f / ((1 - a) * COPIED + f * (1 - COPIED))) - kd * np.log(1 - COPIED)
    return 1 / (1 + (1 - PRIOR) / PRIOR * np.exp(np.clip(log, -50, 50)))


def _start(both: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Accuracies and dependences to begin with, from agreement alone, so that many copies of a poor source don't pass
    for a majority: independent sources agree as often as their accuracies make it likely, copies more often."""
    n = len(both)
    rate = np.divide(same, both, out=np.full((n, n), np.nan), where=both > 0)
    acc = np.full(n, 0.8)
    for _ in range(20):
        ratio = rate / acc[None, :]
        acc = np.array([np.clip(np.nanquantile(r, 1 / 3), 0.05, 0.95) if np.isfinite(r).any() else 0.8 for r in ratio]) * 0.5 + acc * 0.5
    alone = np.clip(acc[:, None] * acc[None, :] + (1 - acc[:, None]) * (1 - acc[None, :]) / N_FALSE, 0.01, 0.99)
    copied = alone + (1 - alone) * COPIED
    log = same * np.log(alone / copied) + (both - same) * np.log((1 - alone) / (1 - copied))
    dep = 1 / (1 + (1 - PRIOR) / PRIOR * np.exp(np.clip(log, -50, 50)))
    np.fill_diagonal(dep, 0)
    return acc, np.where(both > 0, dep, 0.0)


def _vote_udf(acc: np.ndarray, dep: np.ndarray):
    """Weight of the sources that claim one value; a source's vote is discounted by the sources counted before it."""
    score = np.log(N_FALSE * np.clip(acc, 0.05, 0.95) / (1 - np.clip(acc, 0.05, 0.95)))

    @F.pandas_udf("double")
    def vote(s: pd.Series) -> pd.Series:
        known: dict[tuple, float] = {}  # few sets of sources occur, however many values

        def one(x):
            k = tuple(x)
            if k not in known:
                x = sorted(k, key=lambda i: -acc[i])
                known[k] = float(sum(score[i] * np.prod([1 - COPIED * dep[i, j] for j in x[:n]]) for n, i in enumerate(x)))
            return known[k]

        return s.map(one)

    return vote


@dataclass
class Model:
    """What is known of the sources: names, accuracies, dependences."""

    names: list[str]
    acc: np.ndarray
    dep: np.ndarray

    @property
    def most(self) -> float:
        """More than all votes together can make up."""
        return 1.0 + len(self.names) * float(np.log(N_FALSE * 0.95 / 0.05))


def reduced(claims: DataFrame, names: list[str]) -> DataFrame:
    """(object, value, s, best: struct<prior, record>, n): claims of one value in one line, under partial aggregation; s
    are the numbers of the sources, best the claim with the highest prior, of equals with the larger record."""
    have = claims.columns
    ids = F.create_map(*[x for i, s in enumerate(names) for x in (F.lit(s), F.lit(i))]) if names else F.lit(None).cast("map<string,int>")
    best = F.struct(F.col("prior") if "prior" in have else F.lit(0.0).alias("prior"), F.col("record") if "record" in have else F.lit(None).cast("long").alias("record"))
    return claims.groupBy("object", "value").agg(F.array_sort(F.collect_set(F.try_element_at(ids, F.col("source")))).alias("s"), F.max(best).alias("best"), F.count("*").alias("n"))


def _claims(claims: DataFrame) -> DataFrame:
    return claims.where("object is not null and value is not null and source is not null")


def estimate(claims: DataFrame, rounds: int = 2, most_sources: int = 1024) -> Model:
    """Accuracies of sources and their dependence, in turn with the posteriors of the values, from claims (object, value,
    source).

    Two sources that share values that are probably false are probably copies. Values of an object that the same
    sources claim have the same posterior, so the work is on (object, set of sources) with a count: an object that a
    third of all rows describe is a few lines. Pairs are of sources, of which there are at most `most_sources`
    (counted, else an error), never of records. Objects with one claim say nothing here.
    """
    base = _claims(claims)
    names = [r.source for r in base.select("source").distinct().limit(most_sources + 1).collect()]
    if len(names) > most_sources:
        raise ValueError(f"more than {most_sources} sources; name coarser ones")
    names.sort(key=str)
    n = max(1, len(names))
    sets = cut(reduced(base, names).groupBy("object", "s").agg(F.count("*").cast("double").alias("m")))
    both = _pairs(sets.groupBy("object").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("s")))).alias("s")).withColumn("p", F.lit(1.0)).withColumn("m", F.lit(1.0)), n)[0]
    acc, dep = _start(both, _pairs(sets.withColumn("p", F.lit(1.0)), n)[0])
    for _ in range(rounds):
        scored = sets.withColumn("v", _vote_udf(acc, dep)("s"))
        top = scored.groupBy("object").agg(F.max("v").alias("top"), F.collect_list(F.struct("v", "m")).alias("vs"), F.sum(F.col("m") * F.size("s")).alias("c")).where("c > 1")
        total = F.aggregate("vs", F.lit(0.0), lambda z, x: z + x.m * F.exp(x.v - F.col("top"))) + F.greatest(F.lit(0.0), F.lit(N_FALSE + 1.0) - F.aggregate("vs", F.lit(0.0), lambda z, x: z + x.m)) * F.exp(-F.col("top"))
        p = scored.join(top.select("object", "top", total.alias("total")), "object").select("s", "m", (F.exp(F.col("v") - F.col("top")) / F.col("total")).alias("p"))
        p = p.groupBy("s", "p").agg(F.sum("m").alias("m"))
        per = p.select(F.explode("s").alias("i"), "p", "m").groupBy("i").agg((F.sum(F.col("p") * F.col("m")) / F.sum("m")).alias("a")).collect()
        both_same, true = _pairs(p, n)
        for r in per:
            acc[r.i] = min(0.95, max(0.05, r.a))
        dep = _dependence(true, both_same - true, np.maximum(0, both - both_same), acc)
        np.fill_diagonal(dep, 0)
    return Model(names, acc, dep)


def _pairs(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Matrices over pairs of sources: how often both stand in one set s of weight m, and the sum of p over that."""
    two = rows.where("size(s) > 1").select("p", "m", F.explode("s").alias("i"), "s").select("p", "m", "i", F.explode("s").alias("j")).where("i < j")
    count, weight = np.zeros((n, n)), np.zeros((n, n))
    for r in two.groupBy("i", "j").agg(F.sum("m").alias("c"), F.sum(F.col("p") * F.col("m")).alias("w")).collect():
        count[r.i, r.j] = count[r.j, r.i] = r.c
        weight[r.i, r.j] = weight[r.j, r.i] = r.w
    return count, weight


def weighed(claims: DataFrame, model: Model) -> DataFrame:
    """(object, value, score, record, n) from claims (object, value, source; prior and record where there are): the log of
    the posterior but for each object's constant. score is the prior of the value's best claim and the discounted votes
    for the value; record is that claim's; n the number of claims."""
    r = reduced(_claims(claims), model.names)
    return r.select("object", "value", (F.col("best.prior") + _vote_udf(model.acc, model.dep)("s")).alias("score"), F.col("best.record").alias("record"), "n")


def fuse(claims: DataFrame, model: Model | None = None, **options) -> DataFrame:
    """(object, value, posterior, score, record): which value of an object is true, by maximum posterior.

    Bayesian fusion: sources' accuracies and dependences (estimate(), unless a model is given), votes of copies
    discounted, and the claims' own log priors. Claims are first reduced to one line a value, so a group with a third of
    all rows sends few lines; what of it is left is joined to its total over several tasks. Claims with a null in
    object, value or source are no claims. An empty table of claims gives an empty table.
    """
    model = model or estimate(claims, **options)
    w = cut(weighed(claims, model))
    top = w.groupBy("object").agg(F.max("score").alias("top"), F.count("*").alias("k"))
    share = salted_join(w, top, ["object"]).withColumn("e", F.exp(F.col("score") - F.col("top")))
    rest = F.greatest(F.lit(0.0), F.lit(N_FALSE + 1.0) - F.first("k")) * F.exp(-F.first("top"))
    total = share.groupBy("object").agg((F.sum("e") + rest).alias("total"))
    return salted_join(cut(share), total, ["object"]).select("object", "value", (F.col("e") / F.col("total")).alias("posterior"), "score", "record")


def survivors(
    rows: DataFrame, record: str, group: Column, source: Column, fields: dict[str, tuple[Column, Column]], lead: str, drift: float | None = 0.0, flag: str = "代表"
) -> DataFrame:
    """(dup_group_id, field, record_id, score): the surviving record of each group and of each field, by maximum posterior.

    fields: by name, the value that is compared and whether it is usable. A record claims its values; the posterior
    of a claim comes from the votes of all sources for its value (copies discounted) and from its log prior:
    `drift` for each step of the record id, as an older record has more likely been overtaken (None: so much
    that no vote makes up for it, for lists in which the last edit is the state; 0: age says nothing); less than any
    usable claim for an unusable one; and, in the fields, more than any other for the survivor's own usable value, so
    that the parts of a record stay together. The survivor (field `flag`) is the best claim of `lead`. Equal
    posteriors go to the larger record id. Groups of one record have no row; records delivered again count once; null
    record ids and groups have none. A field that nobody can supply has no row.
    Claims are reduced to one line a value and the best is taken by max() over structs, both under partial
    aggregation; the survivor's own values are looked up by record. No group is gathered in one task.
    """
    names = list(fields)
    r = rows.select(group.alias("g"), F.col(record).cast("long").alias("r"), source.alias("source"), *[x for i, (v, ok) in enumerate(fields.values()) for x in (v.alias(f"v{i}"), ok.alias(f"k{i}"))])
    r = r.where("g is not null and r is not null")
    r = r.groupBy("g", "r").agg(F.min(F.coalesce("source", F.lit(""))).alias("source"), *[F.max(F.struct(f"k{i}", f"v{i}")).alias(f"x{i}") for i in range(len(names))])
    r = cut(r.select("g", "r", "source", *[x for i in range(len(names)) for x in (F.coalesce(f"x{i}.k{i}", F.lit(False)).alias(f"k{i}"), F.col(f"x{i}.v{i}").alias(f"v{i}"))]))

    def claims(d: DataFrame, of: list[int]) -> DataFrame:
        each = F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"v{i}").alias("value"), F.col(f"k{i}").alias("k")) for i in of])
        d = d.select("g", "r", "source", F.explode(each).alias("x")).select("g", "r", "source", "x.*")
        return d.withColumn("object", F.concat_ws("\x1f", "g", F.col("f").cast("string")))

    model = estimate(claims(r, list(range(len(names)))).where("k"))
    lo, hi = r.agg(F.min("r"), F.max("r")).first()
    step = model.most if drift is None else float(drift)
    sure = model.most + step * ((hi or 0) - (lo or 0) + 1)
    age = (F.col("r") - F.lit(hi or 0)).cast("double") * step
    at = names.index(lead)
    first = claims(r, [at]).withColumn("value", F.when(F.col("k"), F.col("value")).otherwise("")).withColumn("prior", age - F.when(F.col("k"), 0.0).otherwise(2 * sure))
    best = F.max(F.struct("score", "record")).alias("b")
    leads = weighed(first.withColumn("record", F.col("r")), model).groupBy("object").agg(best, F.sum("n").alias("n")).where("n > 1")
    leads = cut(leads.select(F.substring_index("object", "\x1f", 1).alias("g"), F.col("b.record").alias("r"), F.col("b.score").alias("score")))
    rest = claims(r, list(range(len(names)))).where("k").withColumn("prior", age)
    own = claims(r.join(leads.select("g", "r"), ["g", "r"]), list(range(len(names)))).where("k").withColumn("prior", age + sure)
    got = weighed(rest.unionByName(own).withColumn("record", F.col("r")), model).groupBy("object").agg(best)
    got = got.select(F.substring_index("object", "\x1f", 1).alias("g"), F.substring_index("object", "\x1f", -1).cast("int").alias("f"), F.col("b.record").alias("r"), F.col("b.score").alias("score"))
    got = got.join(leads.select("g"), "g", "left_semi")
    label = F.element_at(F.array(*map(F.lit, names)), F.col("f") + 1)
    return leads.select(F.col("g").alias("dup_group_id"), F.lit(flag).alias("field"), F.col("r").alias("record_id"), "score").unionByName(
        got.select(F.col("g").alias("dup_group_id"), label.alias("field"), F.col("r").alias("record_id"), "score")
    )
