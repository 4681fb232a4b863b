"""Evaluation texts in training texts: winnowed fingerprints, joined and extended to shared spans."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import salted_join
from ..session import cut

K, WINDOW = 14, 11
_MIX = np.uint64(0x9E3779B97F4A7C15)
_KEEP: dict[int, int | None] = {}


class _Folder(dict):
    """Character table made as needed: letters, marks and digits stay, all else goes."""

    def __missing__(self, c: int) -> int | None:
        self[c] = out = c if unicodedata.category(chr(c))[0] in "LNM" else None
        return out


_FOLD = _Folder()


def folded(text: str | None) -> str:
    """One writing for width, case, blanks, line ends, punctuation, tags and markup signs."""
    if text and "<" in text:
        text = re.sub(r"</?[A-Za-z][^<>]{0,200}>", " ", text)
    return unicodedata.normalize("NFKC", text or "").lower().translate(_FOLD)


def grams(codes: np.ndarray, k: int = K) -> np.ndarray:
    """Hash of each k-gram, by doubling; k-grams are cheap whatever k is."""
    h, have, base = codes.astype(np.uint64) * _MIX + np.uint64(12345), 1, np.uint64(0x100000001B3)
    out, done, todo = None, 0, k
    with np.errstate(over="ignore"):
        power = base
        while todo:
            if todo & 1:
                out = h if out is None else out[: len(h) - done] * power + h[done:] if len(h) > done else h[:0]
                done += have
            todo >>= 1
            if todo:
                if len(h) <= have:
                    return h[:0]
                h = h[:-have] * power + h[have:]
                power = power * power
                have *= 2
        out = out[: max(0, len(codes) - k + 1)]
        out = (out ^ (out >> np.uint64(31))) * _MIX
        return out ^ (out >> np.uint64(29))


def minima(h: np.ndarray, w: int = WINDOW) -> np.ndarray:
    """Least hash of each window of w hashes; of all where there are fewer than w."""
    if len(h) < w:
        return np.array([h.min()], np.uint64) if len(h) else h
    have, m = 1, h
    while have * 2 <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[: len(h) - w + 1], m[w - have : w - have + len(h) - w + 1])


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


def prints(h: np.ndarray, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, windows): the fingerprints of a text with k-gram hashes h, each with the first of the windows it stands for."""
    m = minima(h, w)
    new = np.flatnonzero(np.append(True, m[1:] != m[:-1])) if len(m) else np.zeros(0, np.int64)
    return m[new], new


def last_places(h: np.ndarray, m: np.ndarray, at: np.ndarray, w: int = WINDOW) -> np.ndarray:
    """The last place in the windows `at` of h that has their least hash m."""
    w = min(w, len(h))
    if not len(at):
        return at
    return at + w - 1 - np.argmax(np.lib.stride_tricks.sliding_window_view(h, w)[at][:, ::-1] == m[:, None], axis=1)


def item_prints(text: str, k: int = K, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places): every place of a folded item that carries one of its fingerprints."""
    h = grams(_codes(text), k)
    at = np.flatnonzero(np.isin(h, minima(h, w))) if len(h) else np.zeros(0, np.int64)
    return h[at], at


def covered(c: np.ndarray, a: np.ndarray, hits: list[tuple[int, int]], least: int) -> int:
    """Characters of item a in spans of at least `least` that it shares with text c, from hits (place in c, place in a)."""
    spans, seen = [], {}
    for at, p in sorted(hits):
        if seen.get(at - p, -1) > at:
            continue
        back, room = min(at, p), min(len(c) - at, len(a) - p)
        left = np.flatnonzero(c[at - back : at] != a[p - back : p])
        right = np.flatnonzero(c[at : at + room] != a[p : p + room])
        left, right = back - int(left[-1]) - 1 if len(left) else back, int(right[0]) if len(right) else room
        seen[at - p] = at + right
        if left + right >= least:
            spans.append((p - left, p + right))
    total = end = 0
    for x, y in sorted(spans):
        total += max(0, y - max(x, end))
        end = max(end, y)
    return total


def _bits(items: DataFrame, most: int) -> np.ndarray:
    """One bit for each item fingerprint, by its low bits: 8 MB, or more with more fingerprints, at most 2**most bits.
    It only spares the shuffle fingerprints that no item has; the join decides. (The bitmap functions count from 1.)"""
    n = items.agg(F.approx_count_distinct("h").alias("n")).first().n
    size = min(most, max(22, int(n * 64).bit_length()))
    low = F.col("h").bitwiseAND(F.lit((1 << size) - 1))
    got = items.select((low + 1).alias("x")).groupBy(F.call_function("bitmap_bucket_number", "x").alias("b")).agg(F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", "x")).alias("m"))
    out = np.zeros((1 << size) // 8 + 8192, np.uint8)
    for r in got.toLocalIterator():
        m = np.frombuffer(bytes(r.m), np.uint8)
        out[(r.b - 1) * 4096 : (r.b - 1) * 4096 + len(m)] = m
    return out[: (1 << size) // 8 + 4096]


def leaks(docs: DataFrame, items: DataFrame, doc: str, doc_text: str, item: str, item_text: str, share: float = 0.38, most_bits: int = 30) -> DataFrame:
    """(item_id, doc_id, share): the documents that hold at least `share` of an item's text in long shared spans.

    Winnowing: from each window of WINDOW k-grams the least hash is kept, in both tables, so every shared span of
    WINDOW + K - 1 = 24 characters has a common fingerprint. The two tables of fingerprints are joined by hash, hits
    are brought together by document and item, and extended to the longest equal spans; spans shorter than 24
    don't count, so the fixed words of a wording whose facts differ don't add up. Whole texts are folded and read, once;
    order of sentences doesn't matter.
    The corpus is read in one pass whatever the number of items. Of its fingerprints only those that have their bit
    set in a map of the items' (at most 2**most_bits bits, 128 MB) are joined, and only texts that have one are kept.
    A span with n fingerprints is at most (n + 1) * WINDOW + K - 2 long, so pairs with too few are left out before their texts
    are fetched. Neither items nor fingerprints go to the driver. A fingerprint that very many documents share is joined over
    several tasks. Ids may be of any type. Empty and null texts hold nothing; items shorter than 24 folded characters
    can't be found; null ids are left out. Rows with equal ids count once.
    """
    spark, k, w = docs.sparkSession, K, WINDOW
    kind_i, kind_d = items.schema[item].dataType.simpleString(), docs.schema[doc].dataType.simpleString()

    def of_items(batches):
        for x in batches:
            at, h, p, n = [], [], [], []
            for r, t in enumerate(x.column(1).to_pylist()):
                f = folded(t)
                hs, ps = item_prints(f, k, w)
                at.append(np.full(len(hs), r)), h.append(hs), p.append(ps), n.append(np.full(len(hs), len(f)))
            rows = np.concatenate(at) if at else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([x.column(0).take(pa.array(rows)), pa.array(np.concatenate(h).view(np.int64) if h else np.zeros(0, np.int64)), pa.array(np.concatenate(p).astype(np.int32) if p else np.zeros(0, np.int32)), pa.array(np.concatenate(n).astype(np.int32) if n else np.zeros(0, np.int32))], names=["i", "h", "p", "n"])

    q = items.select(F.col(item).alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null").distinct()
    q = cut(q.withColumn("v", F.xxhash64("t")))
    mine = cut(q.select(F.struct("i", "v").alias("i"), "t").mapInArrow(of_items, f"i struct<i: {kind_i}, v: bigint>, h long, p int, n int"))
    bits = spark.sparkContext.broadcast(_bits(mine, most_bits))

    def of_docs(batches):
        held = bits.value
        size = int(len(held) - 4096).bit_length() + 2
        mask = np.uint64((1 << size) - 1)
        for x in batches:
            keep, texts, hits = [], [], []
            for r, t in enumerate(x.column(1).to_pylist()):
                if not t:
                    continue
                f = folded(t)
                g = grams(_codes(f), k)
                h, at = prints(g, w)
                x64 = h & mask
                ok = np.flatnonzero(held[x64 >> np.uint64(3)] >> (x64 & np.uint64(7)).astype(np.uint8) & 1)
                if len(ok):
                    keep.append(r), texts.append(f)
                    hits.append(pa.StructArray.from_arrays([pa.array(h[ok].view(np.int64)), pa.array(last_places(g, h[ok], at[ok], w).astype(np.int32))], names=["h", "at"]))
            bounds = pa.array(np.append(0, np.cumsum([len(y) for y in hits])).astype(np.int32))
            flat = pa.concat_arrays(hits) if hits else pa.StructArray.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int32())], names=["h", "at"])
            yield pa.RecordBatch.from_arrays([x.column(0).take(pa.array(keep, pa.int64())), pa.array(texts, pa.string()), pa.ListArray.from_arrays(bounds, flat)], names=["d", "t", "hits"])

    kept = docs.select(F.col(doc).alias("d"), doc_text).where("d is not null").mapInArrow(of_docs, f"d {kind_d}, t string, hits array<struct<h: bigint, at: int>>")
    kept = cut(kept.select(F.struct("d", F.xxhash64("t").alias("v")).alias("d"), "t", "hits"))
    met = salted_join(cut(kept.select("d", F.inline("hits")).distinct()), mine, ["h"])
    met = met.groupBy("d", "i").agg(F.collect_set(F.struct("at", "p")).alias("hits"), F.first("n").alias("n"))
    enough = F.size(F.array_distinct(F.transform("hits", lambda x: x["p"]))) * (2 * w + k - 2) >= F.col("n") * share
    met = met.where(enough).drop("n")
    met = met.join(kept.select("d", "t").dropDuplicates(["d"]), "d").join(q.select(F.struct("i", "v").alias("i"), F.col("t").alias("own")), "i")

    def extended(batches):
        for x in batches:
            good, part = [], []
            own: dict[str, np.ndarray] = {}
            for r, (t, o, hits) in enumerate(zip(x.column(1).to_pylist(), x.column(2).to_pylist(), x.column(3).to_pylist())):
                if o not in own:
                    own[o] = _codes(folded(o))
                a = own[o]
                have = covered(_codes(t), a, [(y["at"], y["p"]) for y in hits], w + k - 1)
                if have and have >= share * len(a):
                    good.append(r), part.append(have / len(a))
            ids = x.column(0).take(pa.array(good, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(part, pa.float64())], names=["k", "share"])

    found = met.select(F.struct("i.i", "d.d").alias("k"), "t", "own", "hits").mapInArrow(extended, f"k struct<i: {kind_i}, d: {kind_d}>, share double")
    return found.select(F.col("k.i").alias("item_id"), F.col("k.d").alias("doc_id"), "share").groupBy("item_id", "doc_id").agg(F.max("share").alias("share"))
