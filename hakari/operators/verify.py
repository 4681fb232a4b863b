"""Scoring candidate pages against a record and choosing one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T
from ..functions.url import blocked
from ..session import cut


def candidates(found: Column, extra: list[str] | None = None, most: int = rules.CANDIDATES_PER_QUERY) -> Column:
    """The first search hits (array of structs with url) that have a URL and are no portal's."""
    return F.slice(F.filter(found, lambda h: (F.coalesce(h["url"], F.lit("")) != "") & ~blocked(h["url"], extra)), 1, most)


def evidence(phone: Column, numbers: Column, name: Column, city: Column, page: Column, page_name: Column) -> Column:
    """struct<points, reasons>: telephone 3, lot numbers 2, name 2, city 1.

    phone: digits; numbers: the address' numbers; name and city: compared forms; page: NFKC text; page_name: its
    compared form. Lot numbers count if all but one of the first three, two at least, stand alone in the page, or
    all of them in a row in its digits.
    """
    digits = F.regexp_replace(page, r"(?U)\D", "")
    three = F.slice(numbers, 1, 3)
    alone = F.size(F.filter(three, lambda n: F.array_contains(F.regexp_extract_all(page, F.lit(r"(?U)(\d+)"), 1), n)))
    tests = [
        ((F.length(phone) >= 9) & digits.contains(phone), 3, "電話一致"),
        ((F.size(numbers) >= 2) & ((alone >= F.greatest(F.lit(2), F.size(three) - 1)) | digits.contains(F.array_join(three, ""))), 2, "番地一致"),
        ((F.length(name) >= 3) & page_name.contains(name), 2, "施設名一致"),
        ((city != "") & page_name.contains(city), 1, "市区町村一致"),
    ]
    points = sum((F.when(F.coalesce(t, F.lit(False)), p).otherwise(0) for t, p, _ in tests), F.lit(0))
    return F.struct(points.alias("points"), F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(w)) for t, _, w in tests])).alias("reasons"))


def with_subpage(first: Column, second: Column, idx: Column, high: int = rules.HIGH) -> Column:
    """The better of a page's evidence and that with its subpage, which is only looked at for the first candidate
    while it is short of `high`."""
    better = (idx == 0) & (first["points"] < high) & (F.coalesce(second["points"], F.lit(-1)) > first["points"])
    return F.when(better, F.struct(second["points"].alias("points"), F.array_append(second["reasons"], F.lit("下層ページで確認")).alias("reasons"))).otherwise(first)


def best_candidate(scored: DataFrame, record: str, idx: str, points: str, columns: list[str], high: int = rules.HIGH) -> DataFrame:
    """(record, columns …, points) of the chosen candidate: the first that reaches `high`, else the most points, the
    earliest of equals. No loop: the order is one struct, and min_by() is combined before the shuffle."""
    order = F.struct(F.when(F.col(points) >= high, 0).otherwise(1), F.when(F.col(points) >= high, F.col(idx)).otherwise(-F.col(points)), F.col(idx))
    got = scored.groupBy(record).agg(F.min_by(F.struct(*dict.fromkeys([*columns, points])), order).alias("b"))
    return got.select(record, "b.*")


def band(points: Column) -> Column:
    return F.when(points >= rules.HIGH, "高").when(points == rules.MID, "中").when(points == rules.LOW, "低").otherwise("未検出")


def verdict(points: Column, reasons: Column, tried: Column, top: Column) -> Column:
    """The sentence that says why: the evidence with the points, or that no candidate fits."""
    no = F.concat(F.lit("候補"), tried.cast("string"), F.lit("件すべて照合不一致"), F.when(F.coalesce(top, F.lit("")) != "", F.concat(F.lit("（最有力 "), top, F.lit("）"))).otherwise(""))
    return F.when(F.coalesce(points, F.lit(0)) < rules.LOW, no).otherwise(F.concat(F.array_join(reasons, "・"), F.lit("（スコア"), points.cast("string"), F.lit("）")))


#: Characters of text and records of a URL that one task's row holds; a URL with more is spread over several rows.
PART_CHARS, PART_RECORDS = 1_000_000, 5_000
#: Tests of evidence() in its order: points times 16, and a bit each.
_PHONE, _LOT, _NAME, _CITY = 3 << 4 | 8, 2 << 4 | 4, 2 << 4 | 2, 1 << 4 | 1


def _where_found(needles: set[str], texts: list[str], size: int) -> dict[str, np.ndarray]:
    """For each needle that occurs, in which texts. Many needles are looked up by their first characters, `size` at
    most, among those of the text, so that the work grows with the text and not with texts times needles."""
    got: dict[str, np.ndarray] = {}
    heads: dict[int, dict[str, list[str]]] = {}
    for n in needles:
        k = min(size, len(n))
        heads.setdefault(k, {}).setdefault(n[:k], []).append(n)
    for i, t in enumerate(texts):
        near = needles if len(needles) <= 8 else (n for k, of in heads.items() for h in of.keys() & {t[j : j + k] for j in range(len(t) - k + 1)} for n in of[h])
        for n in near:
            if n in t:
                if n not in got:
                    got[n] = np.zeros(len(texts), np.int16)
                got[n][i] = 1
    return got


def _best_codes(texts: list[dict], recs: list[dict]) -> list[int]:
    """For each record (p, x, n, c) the best code over the texts (name, runs): points of evidence() and its tests."""
    none = np.zeros(len(texts), np.int16)
    names, digits = [t["name"] for t in texts], ["".join(t["runs"]) for t in texts]
    lots = ["".join(r["x"][:3]) if len(r["x"]) >= 2 else "" for r in recs]
    named = _where_found({n for r in recs for n in (r["n"], r["c"]) if n}, names, 3)
    rows = _where_found({r["p"] for r in recs if len(r["p"]) >= 9} | {x for x in lots if x}, digits, 6)
    asked = {n for r in recs for n in r["x"][:3]}
    alone: dict[str, np.ndarray] = {}
    for i, t in enumerate(texts):
        for n in asked.intersection(t["runs"]):
            alone.setdefault(n, np.zeros(len(texts), np.int16))[i] = 1
    out = []
    for r, lot in zip(recs, lots):
        code = named.get(r["c"], none) * _CITY
        if len(r["n"]) >= 3:
            code = code + named.get(r["n"], none) * _NAME
        if len(r["p"]) >= 9:
            code = code + rows.get(r["p"], none) * _PHONE
        if lot:
            three = r["x"][:3]
            enough = sum(alone.get(n, none) for n in three) >= max(2, len(three) - 1)
            code = code + (enough | (rows.get(lot, none) > 0)) * np.int16(_LOT)
        out.append(int(code.max()))
    return out


def _scored(pairs: DataFrame, pages: DataFrame) -> DataFrame:
    """(record, idx, url, points, reasons, error): the best evidence of each pair over all texts of its URL.

    pairs: (record, idx, url, _n, _p, _x, _c), once each; pages: (url, html), any number a URL. Equal texts are one. A
    URL's texts and pairs are brought together, in parts where there are many, and each text is folded once.
    """
    from ..functions.html import page_text

    c = F.col
    parts = lambda d, n, size, k: F.broadcast(d.groupBy("url").agg(F.ceil(n / size).cast("int").alias(k)).where(c(k) > 1))
    long = parts(pages, F.sum(F.length("html")), PART_CHARS, "_t")
    many = parts(pairs, F.count("*"), PART_RECORDS, "_m")
    r = pairs.join(long, "url", "left").join(many, "url", "left").withColumn("_i", F.explode(F.sequence(F.lit(0), F.coalesce("_t", F.lit(1)) - 1)))
    r = r.withColumn("_j", F.pmod(F.xxhash64("record"), F.coalesce("_m", F.lit(1))).cast("int"))
    r = r.groupBy("url", "_i", "_j").agg(F.collect_list(F.struct("record", "idx", c("_p").alias("p"), c("_x").alias("x"), c("_n").alias("n"), c("_c").alias("c"))).alias("recs"))
    t = pages.join(long, "url", "left").withColumn("_i", F.pmod(F.xxhash64("html"), F.coalesce("_t", F.lit(1))).cast("int")).select("url", "_i", "html")
    keys = pairs.select("url").distinct().join(long, "url", "left").select("url", F.explode(F.sequence(F.lit(0), F.coalesce("_t", F.lit(1)) - 1)).alias("_i"))
    t = t.join(keys, ["url", "_i"], "left_semi").distinct().withColumn("page", page_text(c("html")))
    text = F.struct(T.name_key(c("page")).alias("name"), F.regexp_extract_all("page", F.lit(r"(?U)(\d+)"), 1).alias("runs"))
    t = t.groupBy("url", "_i").agg(F.collect_list(text).alias("texts"))
    kind, order = (pairs.schema[k].dataType.simpleString() for k in ("record", "idx"))

    def go(batches):
        for b in batches:
            recs, texts = b.column(1).to_pylist(), b.column(2)
            codes, errors = [], []
            for i, of in enumerate(recs):
                try:
                    got, said = _best_codes(texts[i].as_py(), of), None
                except Exception as e:  # a page that can't be judged is a row that says so, not a failed task
                    got, said = [0] * len(of), str(e) or type(e).__name__
                codes += got
                errors += [said] * len(of)
            flat, row = b.column(1).flatten(), np.repeat(np.arange(b.num_rows), [len(of) for of in recs])
            yield pa.RecordBatch.from_arrays([flat.field("record"), flat.field("idx"), b.column(0).take(pa.array(row)), pa.array(codes, pa.int32()), pa.array(errors, pa.string())], names=["record", "idx", "url", "code", "error"])

    s = r.join(t, ["url", "_i"]).select("url", "recs", "texts").mapInArrow(go, f"record {kind}, idx {order}, url string, code int, error string")
    s = s.groupBy("record", "idx", "url").agg(F.max("code").alias("code"), F.max("error").alias("error"))
    why = [F.when(c("code").bitwiseAND(bit) > 0, F.lit(w)) for bit, w in ((8, "電話一致"), (4, "番地一致"), (2, "施設名一致"), (1, "市区町村一致"))]
    return s.select("record", "idx", "url", F.shiftright("code", 4).alias("points"), F.array_compact(F.array(*why)).alias("reasons"), "error")


def _with_subpages(first: DataFrame, pairs: DataFrame, pages: DataFrame) -> DataFrame:
    """first, as _scored() gives it, with the evidence of page and subpage together where that is better: for first
    candidates that fall short, over the two hinted pages of their host that the page links to, where these are stored."""
    from ..functions.html import subpages

    short = first.where((F.col("idx") == 0) & (F.col("points") < rules.HIGH)).select("record", "idx", "url")
    linked = pages.where(F.lower("html").contains("href")).join(short.select("url").distinct(), "url", "left_semi")
    linked = linked.select("url", "html", F.explode(subpages(F.col("html"), F.col("url"))).alias("sub"))
    both = linked.join(pages.select(F.col("url").alias("sub"), F.col("html").alias("more")), "sub").select("url", F.concat_ws(" ", "html", "more").alias("html"))
    both = cut(both)
    if not both.limit(1).count():
        return first
    again = _scored(cut(pairs.join(short, ["record", "idx", "url"], "left_semi")), both).select("record", "idx", "url", F.struct("points", "reasons").alias("_s"))
    x = first.join(again, ["record", "idx", "url"], "left").withColumn("_e", with_subpage(F.struct("points", "reasons"), F.col("_s"), F.col("idx")))
    return x.select("record", "idx", "url", "_e.points", "_e.reasons", "error")


def judge(records: DataFrame, cands: DataFrame, pages: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """(record, url, confidence, reason) for records (record, name, addr, phone), cands (record, idx, url) and
    pages (url, html), any number a URL: of its texts that with the most points counts, and of equal points the one
    with a telephone, then a lot, then a name.

    Blocked and unfetched candidates are passed over; pages are joined on URL, never fetched here. A first candidate that
    falls short is looked at together with its subpages. Texts and records are folded once, and only those that meet. A
    record without a fitting page has the sentinel as URL; one whose pages can't be judged says why.
    """
    from ..functions.url import blocked_for

    pages = pages.where("html <> ''").select("url", "html")
    there = pages.select("url").distinct()
    pairs = cands.select("record", "idx", "url").where(~blocked(F.col("url"), extra)).join(there, "url", "left_semi").distinct()
    s = pairs.join(records.select("record", "name", "addr", "phone"), "record").where(~blocked_for(F.col("url"), F.col("name"), extra))
    s = s.withColumn("_a", T.nfkc(F.col("addr"))).withColumn("_n", T.name_key(T.nfkc(F.col("name")))).withColumn("_p", T.phone_digits(T.nfkc(F.col("phone"))))
    s = cut(s.select("record", "idx", "url", "_n", "_p", T.address_numbers(F.col("_a")).alias("_x"), T.name_key(T.city_part(F.col("_a"))).alias("_c")))
    scored = cut(_with_subpages(cut(_scored(s, pages)), s, pages))
    best = best_candidate(scored, "record", "idx", "points", ["url", "reasons"])
    failed = scored.where("error is not null").groupBy("record").agg(F.min_by("error", "idx").alias("error"))
    tried = cands.groupBy("record").agg(F.count("*").alias("tried"), F.min_by("url", "idx").alias("top"))
    out = records.select("record").join(tried, "record", "left").join(best, "record", "left").join(failed, "record", "left")
    bad = F.col("error").isNotNull()
    conf = F.when(bad, "未検出").otherwise(band(F.coalesce("points", F.lit(0))))
    reason = F.when(bad, F.concat(F.lit("照合エラー: "), "error")).otherwise(verdict(F.col("points"), F.col("reasons"), F.coalesce("tried", F.lit(0)), F.col("top")))
    return out.select("record", F.when(conf == "未検出", rules.NOT_FOUND).otherwise(F.col("url")).alias("url"), conf.alias("confidence"), reason.alias("reason"))


def hours_found(judged: DataFrame, pages: DataFrame) -> DataFrame:
    """(record, url, hours, source): opening hours of the adopted page (judged: record, url), else of the one hinted page
    of its host behind it, with the URL they are from; pages: (url, html), one row a URL."""
    from ..functions.html import opening_hours, page_or_subpage, subpages

    p = judged.where(F.col("url") != rules.NOT_FOUND).join(pages, "url").withColumn("sub", F.get(subpages(F.col("html"), F.col("url"), rules.HOURS_LINK_HINTS, 1), F.lit(0)))
    p = p.join(pages.select(F.col("url").alias("sub"), F.col("html").alias("more")), "sub", "left")
    p = p.withColumn("own", opening_hours("html")).withColumn("behind", F.when(F.col("more").isNotNull(), opening_hours("more")))
    return p.select("record", "url", page_or_subpage(F.col("own"), F.col("url"), F.col("behind"), F.col("sub")).alias("h")).select("record", "url", "h.hours", "h.source")
