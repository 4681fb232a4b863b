"""Same place in many writings: blocks on postal code or town, component levels, linkage weights by EM."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.width import digits
from ..operators.components import components
from ..operators.skew import hot_keys, spread_join
from ..session import cut
from .address import parse

#: Number of levels of each compared component; level 0 is disagreement, the last agreement. Missing is a level of city,
#: ward, zip and pref. A lot agrees, or lacks its last part (0); other lots are other places, and never meet.
LEVELS = {"city": 4, "ward": 4, "town": 3, "zip": 4, "pref": 3, "lot": 2}
#: What is believed of two writings of one place, and of any two, before data: shares of the levels, worth BELIEF pairs.
SAME = {"city": (0.004, 0.1, 0.2, 0.696), "ward": (0.01, 0.1, 0.4, 0.49), "town": (0.0005, 0.15, 0.8495), "zip": (0.02, 0.08, 0.2, 0.7), "pref": (0.002, 0.2, 0.798), "lot": (0.1, 0.9)}
ANY = {"city": (0.8, 0.05, 0.1, 0.05), "ward": (0.1, 0.1, 0.7, 0.1), "town": (0.9, 0.09, 0.01), "zip": (0.9, 0.01, 0.08, 0.01), "pref": (0.8, 0.05, 0.15), "lot": (0.1, 0.9)}
NEXT_ZIP, BELIEF = (0.4, 0.05, 0.15, 0.4), 20.0
#: Share of the pairs of one place whose towns differ by more than a typing error. It is not estimated: it is what tells
#: another town of the same city from a badly written one.
FAR = SAME["town"][0]


def zip_code(c: Column) -> Column:
    """Seven digits, not all the same; else null."""
    d = F.when(c.rlike(r"\A[0-9]{3}-?[0-9]{4}\z"), F.replace(c, F.lit("-"), F.lit(""))).otherwise(digits(c))
    return F.when((F.length(d) == 7) & (F.replace(d, F.substring(d, 1, 1), F.lit("")) != ""), d)


def parsed(rows: DataFrame) -> DataFrame:
    """rows (record, addr, zip, pref) with city, ward, town and lots ('3-12-5'); rows without a number are left out."""

    def go(batches):
        for b in batches:
            keep, out = [], ([], [], [], [])
            for i, (a, p) in enumerate(zip(b.column(b.schema.get_field_index("addr")).to_pylist(), b.column(b.schema.get_field_index("pref")).to_pylist())):
                if got := parse(a, p):
                    keep.append(i)
                    for o, v in zip(out, (*got[:3], "-".join(map(str, got[3])))):
                        o.append(v)
            t = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*t.columns, *(pa.array(o, pa.string()) for o in out)], names=[*b.schema.names, "city", "ward", "town", "lots"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", city string, ward string, town string, lots string"
    return rows.where("addr is not null").mapInArrow(go, shape)


def _plain_town(p: str = "") -> Column:
    """The town without 町 at its end, unless it is nothing else. It is asked for many times over, hence no pattern."""
    town = F.col(f"{p}town")
    return F.concat(F.substring(town, 1, 1), F.rtrim(F.substring(town, 2, 1 << 30), F.lit("町")))


def _outer_lots() -> Column:
    """The lot without its last part."""
    return F.left("lots", F.length("lots") - F.instr(F.reverse("lots"), "-"))


def _keys(lots: Column) -> Column:
    """Block keys: postal code, or city and ward, with the town's first or last character (one typing error spares
    one of them), and the town, with loose kana and old forms folded, with anything: there is no dictionary of readings to
    make a sound of ideographs. Null where a part is missing; _blocks() leaves those out."""
    t = F.col("plain_town")
    with_zip = lambda tag, part: F.when(F.col("zip").isNotNull() & (F.length(t) > 0), F.xxhash64(lots, F.col("zip"), F.lit(tag), part))
    in_city = lambda tag, part: F.when((F.col("city") != "") & (F.length(t) > 0), F.xxhash64(lots, F.col("city"), F.col("ward"), F.lit(tag), part))
    return F.array(with_zip("a", F.substring(t, 1, 1)), with_zip("z", F.substring(t, -1, 1)), F.when(F.length(t) > 0, F.xxhash64(lots, F.lit("t"), t)), in_city("a", F.substring(t, 1, 1)), in_city("z", F.substring(t, -1, 1)))


def _level(a: Column, b: Column, full: Column) -> Column:
    return F.when((a == "") & (b == ""), 2).when(a == b, 3).when((a == "") | (b == ""), 2).when(full | (F.levenshtein(a, b, 1) >= 0), 1).otherwise(0)


def compared(pairs: DataFrame, part: Column) -> DataFrame:
    """pairs of writings (columns x_… and y_…) with the column `levels`, one digit for each component; part is true where
    the lot of one lacks its last part."""
    c = F.col
    full = F.levenshtein(F.concat("x_city", "x_ward", "x_town"), F.concat("y_city", "y_ward", "y_town"), 1) >= 0
    tx, ty = _plain_town("x_"), _plain_town("y_")
    town = F.when(tx == ty, 2).when(full | (F.levenshtein(tx, ty, 1) >= 0), 1).otherwise(0)
    zips = F.when(c("x_zip").isNull() | c("y_zip").isNull(), 2).when(c("x_zip") == c("y_zip"), 3).when(F.levenshtein("x_zip", "y_zip", 1) >= 0, 1).otherwise(0)
    pref = F.when(c("x_pref").isNull() | c("y_pref").isNull(), 1).when(c("x_pref") == c("y_pref"), 2).otherwise(0)
    all_ = (_level(c("x_city"), c("y_city"), full), _level(c("x_ward"), c("y_ward"), full), town, zips, pref, F.when(part, 0).otherwise(1))
    return pairs.withColumn("levels", F.concat(*[x.cast("string") for x in all_]))


def linkage(counts: dict[str, int], chance: dict[str, int] | None = None, near: float = 0.15, steps: int = 60) -> dict[str, float]:
    """Posterior of a link for each pattern of levels, by expectation-maximization.

    Pairs that share a block are of one of three kinds: the same place; another town of the same municipality (then
    city, ward and prefecture agree as in one place, and the town by chance); or a town of the same name in another
    municipality (then the town agrees as in one place, and all else by chance). chance are the patterns of pairs of any
    two writings, with "-" for a component that is not told; near is the share of unlike towns with a character in common
    that are still within a typing error.
    Shares of levels and of kinds are estimated together; within a kind the components are independent.
    """
    if not counts:
        return {}
    at = {c: j for j, c in enumerate(LEVELS)}
    table = lambda t: (np.array([[-1 if d == "-" else int(d) for d in k] for k in t], int).reshape(-1, len(LEVELS)), np.array([*t.values()], float))
    (x, n), (rx, rn) = table(counts), table(chance or {})
    share = lambda j, rows, weight, size, prior: (np.bincount(rows[:, j], weight, size) + BELIEF * np.array(prior)) / (weight.sum() + BELIEF)
    told = lambda j: (j, rx[rx[:, j] >= 0], rn[rx[:, j] >= 0])
    any_ = {c: share(*told(at[c]), LEVELS[c], ANY[c]) for c in LEVELS}
    same = {c: np.array(v) for c, v in SAME.items()}
    other_town, other_zip = np.array([1 - near - 1e-4, near, 1e-4]), np.array(NEXT_ZIP)
    lots = [np.array(SAME["lot"])] * 3
    start = np.array([0.9, 0.05, 0.05])
    p = start
    for _ in range(steps):
        of = lambda c, t: t[x[:, at[c]]]  # noqa: B023, E731
        area = of("city", same["city"]) * of("ward", same["ward"]) * of("pref", same["pref"])
        town = of("town", same["town"])
        like = np.array([
            area * town * of("zip", same["zip"]),
            area * of("town", other_town) * of("zip", other_zip),
            town * np.prod([of(c, any_[c]) for c in ("city", "ward", "zip", "pref")], axis=0),
        ]) * np.array([of("lot", t) for t in lots]) * p[:, None]
        w = like / like.sum(0)
        t = w * n
        p = (t.sum(1) + BELIEF * start) / (n.sum() + BELIEF)
        again = lambda c, weight, prior: share(at[c], x, weight, LEVELS[c], prior)
        for c in ("city", "ward", "pref"):
            same[c] = again(c, t[0] + t[1], SAME[c])
        towns = again("town", t[0] + t[2], SAME["town"])[1:]
        same["town"] = np.append(FAR, towns * (1 - FAR) / towns.sum())
        same["zip"], other_zip = again("zip", t[0], SAME["zip"]), again("zip", t[1], NEXT_ZIP)
        lots = [again("lot", k, SAME["lot"]) for k in t]
    return dict(zip(counts, w[0].tolist()))


def _blocks(rows: DataFrame, *names: str) -> DataFrame:
    """(k, …): a row for each block key of rows, with its w under each of the names. The outer form makes the keys once: else
    a filter on their number is put before it, which makes them too."""
    return rows.select(F.explode_outer("keys").alias("k"), *[F.col("w").alias(n) for n in names]).where("k is not null")


_PARTS = ["w", "zip", "pref", "city", "ward", "town"]


def _candidates(left: DataFrame, right: DataFrame, hot: DataFrame | None) -> DataFrame:
    """(x_w, y_w, part): pairs of writings that share a block key. Only numbers meet in the blocks; a hot one is spread."""
    return spread_join(_blocks(left, "x_w"), _blocks(right, "y_w"), ["k"], hot).where("x_w < y_w" if left is right else "x_w <> y_w").select("x_w", "y_w").distinct().withColumn("part", F.lit(left is not right))


def _neighbours(rows: DataFrame, text: str, on: list[str]) -> DataFrame:
    """(x_…, y_…) of rows (distinct; columns on, text, …): all pairs within `on` whose texts are at most a typing error apart, each
    once. Two such texts are equal when a character is left out of one or both, so they meet in one of these forms."""
    t = F.col(text)
    forms = F.array_distinct(F.concat(F.array(F.xxhash64(t)), F.transform(F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))), lambda i: F.xxhash64(F.concat(t.substr(F.lit(1), i - 1), t.substr(i + 1, F.length(t)))))))
    r = cut(rows.withColumn("_r", F.xxhash64(*rows.columns)).withColumn("_f", F.explode(forms)))
    side = lambda p: r.select(*on, "_f", *[F.col(c).alias(f"{p}_{c}") for c in r.columns if c not in (*on, "_f")])
    met = spread_join(side("x"), side("y"), [*on, "_f"], hot_keys(r, [*on, "_f"])).where(F.col("x__r") < F.col("y__r"))
    return met.where(F.levenshtein(f"x_{text}", f"y_{text}", 1) >= 0).drop("_f").distinct()


def by_chance(plain: DataFrame) -> tuple[dict[str, int], float]:
    """How often any two of the writings agree by chance: the patterns of all pairs, each component by itself ("-" for the others),
    and the share of unlike towns with a first or last character in common that are within a typing error.

    All pairs are counted, none is formed but those that are nearly alike: equal values follow from the numbers of writings
    that have them, near ones from a join of the distinct values, the rest is what is left over. Only sums go to the driver.
    """
    # most writings differ in the lot alone: what follows reads the others' numbers
    plain = cut(plain.groupBy("city", "ward", "zip", "pref", "town").agg(F.count("*").alias("n")))
    t = _plain_town()
    ends = {"town": t, "first": F.substring(t, 1, 1), "last": F.substring(t, -1, 1), "ends": F.concat(F.substring(t, 1, 1), F.substring(t, -1, 1))}
    kinds = {k: F.col(k) for k in ("city", "ward", "zip", "pref")} | ends
    valued = plain.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("v")) for k, v in kinds.items()])).alias("s"), "n").select("s.*", "n")
    valued = cut(valued.where("v is not null and (v <> '' or kind in ('zip', 'pref'))").groupBy("kind", "v").agg(F.sum("n").alias("n")))
    equal = {r.kind: (r.same, r.n * (r.n - 1) // 2) for r in valued.groupBy("kind").agg(F.sum(F.expr("n * (n - 1) div 2")).alias("same"), F.sum("n").alias("n")).collect()}
    same, told = ({k: equal.get(k, (0, 0))[i] for k in kinds} for i in (0, 1))
    touch = lambda x, y: (F.substring(x, 1, 1) == F.substring(y, 1, 1)) | (F.substring(x, -1, 1) == F.substring(y, -1, 1))
    of, typed = F.col("x_n") * F.col("y_n"), lambda x, y: F.levenshtein(x, y, 1) >= 0
    close = _neighbours(valued.where(F.col("kind").isin("city", "ward", "zip", "town")), "v", ["kind"])
    close = close.where((F.col("kind") != "town") | touch(F.col("x_v"), F.col("y_v"))).groupBy("kind").agg(F.sum(of).alias("n"))
    near = dict.fromkeys(kinds, 0) | {r.kind: r.n for r in close.collect()}
    # parts that are far apart may still be one municipality and town, parted in two ways
    whole = plain.groupBy("city", "ward", "town").agg(F.sum("n").alias("n")).withColumn("all", F.concat("city", "ward", "town"))
    pairs = _neighbours(whole, "all", [])
    apart = lambda x, y: (x != "") & (y != "") & (x != y) & ~typed(x, y)
    x, y = _plain_town("x_"), _plain_town("y_")
    more = pairs.agg(*[F.sum(F.when(c, of)).alias(k) for k, c in (("city", apart(F.col("x_city"), F.col("y_city"))), ("ward", apart(F.col("x_ward"), F.col("y_ward"))), ("town", apart(x, y) & touch(x, y)))]).first()
    for k in ("city", "ward", "town"):
        near[k] += more[k] or 0
    n = plain.agg(F.sum("n")).first()[0] or 0
    every, counts = n * (n - 1) // 2, {}
    for k in ("city", "ward", "zip", "pref"):
        levels = [told[k] - same[k] - near[k], near[k], every - told[k], same[k]] if k != "pref" else [told[k] - same[k], every - told[k], same[k]]
        counts |= {"".join(str(i) if c == k else "-" for c in LEVELS): v for i, v in enumerate(levels)}
    touching = same["first"] + same["last"] - same["ends"] - same["town"]
    return counts, (near["town"] + 3.0) / (touching + 20.0)  # a belief worth 20 pairs


def places(rows: DataFrame, per_block: int = 20_000) -> DataFrame:
    """(record, addr, place) of rows (record, addr, zip, pref): records of one place have the same number; addr is
    a 64-bit hash of the string.

    Addresses are parsed and reduced to distinct writings (postal code, prefecture, municipality, town, lot), so
    copies of an address, however many, are one line. Writings are compared within blocks of equal lot numbers (typing
    errors occur in municipality and town, not in lot numbers) and a shared postal code or town; levels of agreement
    include close and missing; the posterior of a link is estimated by expectation-maximization over the table of level
    patterns (at most 1,152 lines on the driver) and alone decides: it links from one half on. Linked writings form
    places. A writing whose lot lacks its last part joins the only place that extends it; if
    several do it has no place and no row. An address without a number, empty or null has no row.
    """
    p = parsed(rows).select("record", F.xxhash64("addr").alias("addr"), F.xxhash64("zip", "pref", "city", "ward", "town", "lots").alias("w"), *_PARTS[1:], "lots")
    p = cut(p)
    plain = cut(p.select("w", *_PARTS[1:], "lots").distinct())
    towns = plain.withColumn("plain_town", _plain_town())
    ws = towns.withColumn("keys", _keys(F.col("lots")))
    outer = towns.where("instr(lots, '-') > 0").withColumn("lots", _outer_lots()).withColumn("keys", _keys(F.col("lots")))
    part = lambda s: plain.select(*[F.col(c).alias(f"{s}_{c}") for c in _PARTS])
    hot = hot_keys(_blocks(ws), ["k"], per_block, spots=1 << 15)
    pairs = _candidates(ws, ws, hot).unionByName(_candidates(ws, outer, hot))
    both = cut(compared(pairs.join(part("x"), "x_w").join(part("y"), "y_w"), F.col("part")).select("x_w", "y_w", "part", "levels"))
    weight = linkage({r.levels: r.n for r in both.groupBy("levels").agg(F.count("*").alias("n")).collect()}, *by_chance(plain))
    good = [k for k, v in weight.items() if v >= 0.5]
    links = both.where(F.col("levels").isin(good) if good else F.lit(False))
    comp = components(links.where("not part"), "x_w", "y_w")
    comp = cut(comp.select(F.col("node").alias("w"), F.col("component").alias("c")))  # read five times: else each plan holds all rounds as often
    end = lambda k, c: comp.select(F.col("w").alias(k), F.col("c").alias(c))
    fit = links.where("part").select("x_w", "y_w").join(end("x_w", "cx"), "x_w", "left").join(end("y_w", "cy"), "y_w", "left")
    fit = fit.groupBy(F.coalesce("cx", "x_w").alias("c")).agg(F.min(F.coalesce("cy", "y_w")).alias("lo"), F.max(F.coalesce("cy", "y_w")).alias("hi"))
    alone = fit.join(comp.select("c").distinct(), "c", "left_anti").select(F.col("c").alias("w"), F.col("lo"), F.col("hi"))
    of = comp.join(fit, "c", "left").select("w", F.coalesce("lo", "c").alias("lo"), F.coalesce("hi", "c").alias("hi")).unionByName(alone)
    put = p.select("record", "addr", "w").join(of, "w", "left").where("lo is null or lo = hi")
    return cut(put.select("record", "addr", F.coalesce("lo", "w").alias("place")))


def same_place_pairs(placed: DataFrame, per_task: int = 4000) -> DataFrame:
    """(record_id_a, record_id_b), a < b, of records at one place whose addresses are different strings; placed is what
    places() gives.

    Places with one string are left out first. A place with up to `per_task` rows is brought together once, and that
    exchange serves to drop repetitions and to join; the rows of a larger one are kept apart by record all along and
    joined in as many tasks as it has so many.
    """
    m = placed
    kinds = m.groupBy("place").agg(F.min("addr").alias("lo"), F.max("addr").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("place", F.ceil(F.col("n") / per_task).alias("salts"))
    other = lambda d, *k: d.select(*k, F.col("addr").alias("addr_b"), F.col("record").alias("record_id_b"))
    hot = cut(m.join(kinds.where("salts > 1"), "place").groupBy("place", "record", "addr").agg(F.first("salts").alias("salts")))
    salted = hot.withColumn("salt", F.pmod(F.xxhash64("record"), F.col("salts"))).join(other(hot, "place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")), ["place", "salt"]).select("place", "record", "addr", "addr_b", "record_id_b")
    small = m.join(hot.select("place").distinct(), "place", "left_anti").join(kinds.where("salts = 1").select("place").hint("merge"), "place").dropDuplicates(["place", "record", "addr"])
    few = small.join(other(small, "place").hint("merge"), "place")
    return few.unionByName(salted).where("record < record_id_b and addr <> addr_b").select(F.col("record").alias("record_id_a"), "record_id_b").distinct()
