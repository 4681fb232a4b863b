"""Splitting oversized texts at natural boundaries: regular expressions over a string of token classes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens

#: Classes of a token by what may follow it, weakest first. z: inside a character, never a cut.
CLASSES = "zxwcslp"
_CLASS = np.zeros(0x110000, np.uint8)
_CLASS[[ord(c) for c in "、，,;；:：・)）」』】]"]] = 3
_CLASS[[ord(c) for c in "。．.!！?？｡"]] = 4
_CLASS[[ord(c) for c in "\n\r\x0b\x0c  \x85"]] = 5
_SPACE = np.zeros(0x110000, bool)
_SPACE[[i for i in range(0x3001) if chr(i).isspace()]] = True
_BLOCK = 128  # pieces that are summed up together
_BACK = 3  # tokens that the overlap may be longer than stated, to begin with a whole character


def classify(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the tokens of some texts, one after another: class letters; twice the bytes up to each token's end within
    its text, plus 1 where a character ends; and where each text's tokens end."""
    enc, width = tokens.encoding(path), tokens.widths(path)
    ids = [np.array(enc.encode_ordinary(t), np.int32) for t in texts]
    stops = np.cumsum([len(i) for i in ids])
    ends = np.cumsum(width[np.concatenate(ids)], dtype=np.int64)
    whole_text = "".join(texts)
    raw = np.frombuffer(whole_text.encode("utf-8", "surrogatepass"), np.uint8)
    first = (raw & 0xC0) != 0x80
    at = np.cumsum(first, dtype=np.int32)[ends - 1] - 1  # the character that each token's last byte belongs to
    whole = np.append(first, True)[ends]
    cp = np.frombuffer(whole_text.encode("utf-32-le", "surrogatepass"), np.uint32)
    strength, space = _CLASS[cp], _SPACE[np.minimum(cp, 0x3000)]
    after, blank = np.append(strength, 0)[at + 1], np.append(space, True)[at + 1]
    blank[stops - 1] = True
    after[stops - 1] = 0
    last = strength[at]
    kind = np.maximum(np.where(blank | space[at], 2, 1).astype(np.uint8), last)
    kind[(cp[at] == 46) & ~blank] = 1  # a full stop within a number or name
    line = np.flatnonzero(last == 5)
    here = at[line]
    back = np.maximum(here - 1, 0)
    kind[line[(strength[back] == 5) & ~((cp[here] == 10) & (cp[back] == 13))]] = 6
    kind[line[after[line] == 5]] = 2  # between two line ends
    kind[~whole] = 0
    begin = np.repeat(np.append(0, ends[stops[:-1] - 1]), np.diff(np.append(0, stops)))
    return np.frombuffer(CLASSES.encode(), np.uint8)[kind], ((ends - begin) * 2 + whole).astype(np.int32), stops


def pattern(limit: int, overlap: int) -> str:
    """Alternatives by strength of boundary, each up to the limit; a first piece has no overlap to leave room for.
    What is left goes whole if it fits; else the second half of the room is searched for each kind of mark or line
    end, then the first half, before a blank, which any ideograph or kana counts as, or any character will do."""

    def part(most: int) -> str:
        least = max(0, most // 2 - 1)
        marks = lambda room: "|".join(f".{{0,{room}}}[{c}]" for c in ("p", "lp", "slp", "cslp"))
        half = most - 1 - least
        return f".{{1,{most}}}+$|.{{{least}}}(?:{marks(half)})|{marks(most - 1)}|.{{{least}}}.{{0,{half}}}w|.{{0,{most - 1}}}w|.{{0,{most - 1}}}[^z]"

    later = limit - overlap - (_BACK if overlap else 0)
    return f"(?s)^(?:{part(limit)})|(?:{part(later)})" if overlap else f"(?s){part(limit)}"


def _pieces(limit_id: int, limit: int, overlap: int) -> Column:
    """array<struct<limit_id, piece, from_byte, to_byte, n_tokens>> from the columns `k` of class letters and `e` of ends.

    The matches' lengths are summed up in blocks of _BLOCK, so that the work is linear in the text; each expression stands
    once, as the functions over arrays evaluate what they are given each time that it stands there.
    """
    size = F.transform(F.regexp_extract_all("k", F.lit(pattern(limit, overlap)), F.lit(0)), F.length)
    size = F.when(F.length("k") > limit, size).otherwise(F.array().cast("array<int>"))
    pairs = "array<struct<a: int, b: int>>"
    none = F.struct(F.array().cast(f"array<{pairs}>").alias("done"), F.array().cast(pairs).alias("open"), F.lit(0).alias("at"))

    def add(z: Column, n: Column) -> Column:
        one = F.array(F.struct(z["at"].alias("a"), (z["at"] + n).alias("b")))
        full = F.size(z["open"]) >= _BLOCK
        done = F.when(full, F.concat(z["done"], F.array(z["open"]))).otherwise(z["done"])
        return F.struct(done.alias("done"), F.when(full, one).otherwise(F.concat(z["open"], one)).alias("open"), (z["at"] + n).alias("at"))

    both = F.aggregate(size, none, add, lambda z: F.flatten(F.concat(z["done"], F.array(z["open"]))))

    def start(own: Column) -> Column:
        back = own - overlap
        inside = lambda i: F.coalesce(F.get("e", back - i) % 2 == 0, F.lit(False))
        return F.when(back <= 0, 0).when(~inside(1), back).when(~inside(2), back - 1).when(~inside(3), back - 2).otherwise(back - 3)

    to = lambda i: F.coalesce(F.shiftright(F.get("e", i - 1), 1), F.lit(0))
    begun = F.transform(both, lambda x, i: F.struct(i.alias("i"), (start(x["a"]) if overlap else x["a"]).alias("s"), x["b"].alias("b")))
    return F.transform(begun, lambda x: F.struct(F.lit(limit_id).cast("long").alias("limit_id"), x["i"].alias("piece"), to(x["s"]).alias("from_byte"), to(x["b"]).alias("to_byte"), (x["b"] - x["s"]).alias("n_tokens")))


def _sliced(batches):
    """Batches (doc_id, t, p) as a row a piece: the bytes of a text are cut once each, piece by piece."""
    for b in batches:
        ids, texts, listed = b.column(0), b.column(1).cast(pa.binary()), b.column(2)
        flat = listed.flatten()
        if not len(flat):
            continue
        row = np.repeat(np.arange(b.num_rows), listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        begin, end = flat.field("from_byte").to_numpy(), flat.field("to_byte").to_numpy()
        at = np.append(np.flatnonzero(np.append(True, row[1:] != row[:-1])), len(row))
        out = []
        for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
            raw = texts[int(row[i])].as_py()
            out += [raw[x:y] for x, y in zip(begin[i:j].tolist(), end[i:j].tolist())]
        yield pa.RecordBatch.from_arrays([flat.field("limit_id"), ids.take(pa.array(row)), flat.field("piece"), flat.field("from_byte").cast(pa.int64()), flat.field("n_tokens"), pa.array(out, pa.binary()).cast(pa.string())], names=["limit_id", "doc_id", "piece", "from_byte", "n_tokens", "piece_text"])


def cut_texts(docs: DataFrame, doc: str, text: str, limits: list[tuple[int, int, int]], path: str) -> DataFrame:
    """(limit_id, doc_id, piece, from_byte, n_tokens, piece_text) of the texts that exceed a limit.

    limits: (limit_id, most tokens, overlap tokens). A text is turned into one letter a token: what kind of
    boundary follows it. A regular expression with bounded quantifiers eats that string piece by piece: up to the
    end, else the strongest mark or line end in the second half of the room, else in the first, else the last blank,
    ideograph or kana, else any whole character. Each piece but the first begins the stated overlap earlier (up to three tokens more where a character would be broken), within
    the limit. Pieces without their overlaps put together are the text; from_byte counts its UTF-8 bytes. Texts
    within a limit, empty and null texts have no row for it. Texts need not be unique; pieces are numbered from 0
    for each row. Every text is tokenized once for all limits.
    """
    if any(o >= m - _BACK for _, m, o in limits):
        raise ValueError("the overlap must be less than the limit")
    least = min((m for _, m, _ in limits), default=1 << 60)

    def go(batches):
        for b in batches:
            ids, texts, size, group = b.column(0), b.column(1).to_pylist(), 0, []
            for i, t in enumerate(texts):
                if t and len(t) * 4 > least:
                    group.append(i)
                    size += len(t)
                if group and (size > 1_000_000 or i + 1 == len(texts)):
                    k, e, stops = classify([texts[j] for j in group], path)
                    bounds = pa.array(np.append(0, stops).astype(np.int32))
                    letters = pa.Array.from_buffers(pa.string(), len(group), [None, bounds.buffers()[1], pa.py_buffer(k.tobytes())])
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(group, pa.int64())), pa.array([texts[j] for j in group], pa.string()), letters, pa.ListArray.from_arrays(bounds, pa.array(e))], names=["doc_id", "t", "k", "e"])
                    size, group = 0, []

    kind = docs.schema[doc].dataType.simpleString()
    rows = docs.select(doc, text).mapInArrow(go, f"doc_id {kind}, t string, k string, e array<int>").where(F.length("k") > least)
    if not limits:
        rows = rows.where(F.lit(False))
    pieces = F.concat(*[_pieces(*x) for x in limits or [(0, 1, 0)]])
    return rows.select("doc_id", "t", pieces.alias("p")).mapInArrow(_sliced, f"limit_id long, doc_id {kind}, piece int, from_byte long, n_tokens int, piece_text string")
