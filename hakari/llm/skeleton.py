"""One form for texts that look the same: confusables skeletons and what becomes equal through them."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators.skew import hot_keys, salted_join, spread_join
from ..session import cut

# Look-alike letters, each prototype followed by the characters that share its shape.
LOOK_ALIKES = """
A А Α Ꭺ ꓮ
B В Β Ᏼ ꓐ
C С Ϲ Ꮯ ꓚ
D Ꭰ ꓓ
E Е Ε Ꭼ ꓰ
F Ϝ ꓝ
G Ԍ Ꮐ ꓖ
H Н Η Ꮋ ꓧ
I І Ι Ӏ ꓲ
J Ј Ϳ Ꭻ ꓙ
K К Κ Ꮶ ꓗ
L Ꮮ ꓡ
M М Μ Ϻ Ꮇ ꓟ
N Ν ꓠ
O О Ο Օ ꓳ
P Р Ρ Ꮲ ꓑ
Q Ԛ
R Ꭱ ꓣ
S Ѕ Տ Ꮪ ꓢ
T Т Τ Ꭲ ꓔ
U Ս ꓴ
V Ѵ Ꮩ ꓦ
W Ԝ Ꮃ ꓪ
X Х Χ ꓫ
Y Ү Υ ꓬ
Z Ζ Ꮓ ꓜ
a а α ɑ
b Ь
c с ϲ
d ԁ
e е ҽ
g ɡ ց
h һ հ
i і ι ı
j ј ϳ
k к κ
l ⅼ
n ո
o о ο օ
p р ρ
q ԛ
r г
s ѕ
u υ ս
v ν ѵ
w ԝ
x х
y у γ ү
z ᴢ
ニ 二
ハ 八
ロ 口 囗
ト 卜
タ 夕
エ 工
カ 力
オ 才
ム 厶
ヘ へ
チ 千
ノ 丿
メ 乂
ヌ 又
ヒ 匕
ー 一 — ― ─ ━
・ · • ∙ ⋅ ‧
- ‐ ‑ ‒ – − ﹣
/ ⁄ ∕
~ 〜 ∼ ˜
| ∣ ǀ
! ǃ
' ’ ʼ ′ ＇
, ‚
: ： ∶
"""
# Radicals that stand for the ideograph of the same shape (the Kangxi block follows by rule).
RADICALS = "⺟母 ⺠民 ⺩王 ⻁虎 ⻄西 ⻆角 ⻑長 ⻘青 ⻝食 ⻤鬼 ⻣骨 ⻥鱼 ⻦鸟 ⻨麦 ⻩黄 ⻫斉 ⻬齐 ⻭歯 ⻮齿 ⻯竜 ⻰龙 ⻱龟 ⻲亀 ⻳龟 ⻲亀 ⻟飠"


def read_confusables(path: str) -> dict[int, str]:
    """Prototypes from a file in the format of the published confusables data: lines `code point ; code points ; type`, in
    hexadecimal, with comments after #."""
    to = {}
    with open(path, encoding="utf-8-sig") as f:
        for line in f:
            cells = line.partition("#")[0].split(";")
            if len(cells) >= 2 and cells[0].strip():
                to[int(cells[0], 16)] = unicodedata.normalize("NFD", "".join(chr(int(x, 16)) for x in cells[1].split()))
    return to


@lru_cache(4)
def prototypes(path: str = "") -> dict[int, str]:
    """Character to prototype. The bulk follows from the character data: width, font and no-break variants and
    radicals by their decomposition, blanks to one blank, invisible characters to nothing. path: a file with the whole
    published table (read_confusables()), which comes first where these rules say nothing."""
    to: dict[int, str] = read_confusables(path) if path else {}
    for i in range(sys.maxunicode + 1):
        c, kind = chr(i), unicodedata.category(chr(i))
        tag = unicodedata.decomposition(c)
        if kind in ("Zs", "Zl", "Zp") or c in "\t\n\r\x0b\x0c":
            to[i] = " "
        elif kind == "Cf" or 0xFE00 <= i <= 0xFE0F or 0xE0100 <= i <= 0xE01EF or 0x180B <= i <= 0x180F or i in (0x34F, 0x115F, 0x1160, 0x3164, 0xFFA0):
            to[i] = ""
        elif tag.startswith(("<wide>", "<narrow>", "<font>", "<noBreak>")) or 0x2E80 <= i <= 0x2FD5 and tag.startswith("<compat>"):
            to[i] = unicodedata.normalize("NFD", "".join(chr(int(x, 16)) for x in tag.split()[1:]))
    to[0x309B], to[0x309C] = "゙", "゚"
    for pair in RADICALS.split():
        to[ord(pair[0])] = pair[1]
    for line in LOOK_ALIKES.split("\n"):
        shape, *same = line.split() or [""]
        for c in same:
            to[ord(c)] = shape
    return to


def skeleton(text: str | None, path: str = "") -> str | None:
    """Decompose, replace each character by its prototype, decompose again. Null stays null."""
    if text is None:
        return None
    once = unicodedata.normalize("NFD", text).translate(prototypes(path))
    return unicodedata.normalize("NFD", once.translate(prototypes(path)))


def skeleton_of(c: Column, path: str = "") -> Column:
    """The skeleton of a text column; path: a file of the published table that every executor can read, see prototypes()."""

    @F.pandas_udf(StringType())
    def of(s: pd.Series) -> pd.Series:
        return s.map(lambda t: skeleton(t, path), na_action="ignore")

    return of(c)


def same_look(rows: DataFrame, record: str, fields: list[str], path: str = "") -> DataFrame:
    """(field, skeleton, value, record): each distinct value of a record, with its skeleton.

    The skeleton is computed once per distinct value, not once per row. Null is no value and has no row; an empty
    text has the empty skeleton. Records delivered again count once.
    """
    one = None
    for f in fields:
        part = rows.select(F.lit(f).alias("field"), F.col(record).alias("record"), F.col(f).alias("value"))
        one = part if one is None else one.unionByName(part)
    one = cut(one.where("value is not null and record is not null").distinct())
    values = one.groupBy("value").agg(F.count("*").alias("_n")).select("value", skeleton_of(F.col("value"), path).alias("skeleton"))
    return salted_join(one, values, ["value"]).select("field", "skeleton", "value", "record")


def look_alike_pairs(rows: DataFrame, record: str, fields: list[str], per_task: int = 4000, path: str = "") -> DataFrame:
    """(field, record_id_a, record_id_b), a < b: records whose values of a field look the same but differ.

    Only skeletons with two or more different values enter the join. Skeletons are compared by 128 bits of hash. One with many
    records is spread over several tasks, the others are not copied; the result itself has its pairs by definition.
    same_look() has the classes with their members.
    """
    key = ["field", "s", "s2"]
    m = same_look(rows, record, fields, path).select("field", F.xxhash64("skeleton").alias("s"), F.xxhash64(F.lit("2"), "skeleton").alias("s2"), F.xxhash64("value").alias("v"), "record")
    m = cut(m)
    mixed = m.groupBy(*key).agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo <> hi").select(*key)
    m = cut(salted_join(m, mixed, key, "left_semi"))
    other = m.select(*key, F.col("v").alias("v_b"), F.col("record").alias("record_id_b"))
    pairs = spread_join(m, other, key, hot_keys(m, key, per_task)).where("record < record_id_b and v <> v_b")
    return pairs.select("field", F.col("record").alias("record_id_a"), "record_id_b").distinct()
