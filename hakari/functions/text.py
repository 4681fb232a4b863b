"""Normalization of names, codes, telephones and addresses as column functions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import rules
from .width import strip

#: Legal forms of the earlier name key: one less.
LEGAL_FORMS_EARLY = rules.LEGAL_FORMS[:-1]


_DIGIT = {c: str(i) for i, c in enumerate("〇一二三四五六七八九")} | {"零": "0"}
_BEFORE_UNIT = re.compile("[〇零一二三四五六七八九十]+(?=丁目|丁|番地|番|号|条)")


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


def nfkc(c: Column) -> Column:
    """Compatibility form of Unicode; null becomes empty. It needs a Python worker: use it once a column."""
    return F.coalesce(_nfkc(c), F.lit(""))


def blank(c: Column) -> Column:
    """Null as empty, without blanks at both ends (the ideographic space too)."""
    return F.coalesce(strip(c), F.lit(""))


def only_digits(c: Column) -> Column:
    """Decimal digits of any script; wide digits stay wide."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\D", "")


def name_key(folded: Column, legal: list[str] = rules.LEGAL_FORMS, noise: str = rules.NAME_NOISE) -> Column:
    """Compared form of an NFKC name: legal forms out in their order, then noise, then lower case."""
    for w in legal:
        folded = F.replace(folded, F.lit(w), F.lit(""))
    return F.lower(F.regexp_replace(folded, "(?U)" + noise, ""))


def facility_code(c: Column) -> Column:
    """Digits, with leading zeros up to ten; longer ones as they are, empty stays empty."""
    d = only_digits(c)
    return F.when(F.length(d).between(1, 10), F.lpad(d, 10, "0")).otherwise(d)


def zip_digits(c: Column) -> Column:
    return F.substring(only_digits(c), 1, 7)


def zip_shown(c: Column) -> Column:
    """ddd-dddd where there are seven digits, else the trimmed original."""
    d = only_digits(c)
    return F.when(F.length(d) == 7, F.concat_ws("-", F.substring(d, 1, 3), F.substring(d, 4, 4))).otherwise(blank(c))


def phone_digits(folded: Column) -> Column:
    """Digits of an NFKC telephone; the country code 81 gives way to one zero."""
    d = F.regexp_replace(folded, r"(?U)\D", "")
    rest = F.substring(d, 3, 1 << 20)
    return F.when(d.startswith("81") & (F.length(d) >= 11), F.when(rest.startswith("0"), rest).otherwise(F.concat(F.lit("0"), rest))).otherwise(d)


def city_part(folded: Column) -> Column:
    """City with ward, else city, ward, town, village: the first that an NFKC address begins with; else six characters."""
    found = [F.nullif(F.regexp_extract(folded, f"^(.+?{x})", 1), F.lit("")) for x in ("市.+?区", "市", "区", "町", "村")]
    return F.coalesce(*found, F.substring(folded, 1, 6))


def city_part_early(folded: Column) -> Column:
    """The earlier city: with ward, else up to the first of city, ward, town and village; else six characters."""
    return F.coalesce(F.nullif(F.regexp_extract(folded, "^(.+?市.+?区|.+?[市区町村])", 1), F.lit("")), F.substring(folded, 1, 6))


def numeral(text: str) -> str:
    """Chinese numerals as digits, by place or with 十: 二十三, 二三 and 二〇 are 23, 23 and 20."""
    value, open_unit = 0, False
    for c in text:
        if c == "十":
            value, open_unit = max(value, 1) * 10, True
        else:
            value = value + int(_DIGIT[c]) if open_unit else value * 10 + int(_DIGIT[c])
            open_unit = False
    return str(value)


@F.pandas_udf(StringType())
def _unit_numerals(s: pd.Series) -> pd.Series:
    return s.str.replace(_BEFORE_UNIT, lambda m: numeral(m[0]), regex=True)


def address_numbers(folded: Column, most: int = 4) -> Column:
    """The first digit runs behind the city of an NFKC address; numerals before 丁目, 番, 号 and the like count."""
    tail = F.substring(folded, F.length(city_part(folded)) + 1, F.length(folded))
    tail = F.when(tail == "", folded).otherwise(tail)
    return F.slice(F.regexp_extract_all(_unit_numerals(tail), F.lit(r"(?U)(\d+)"), 1), 1, most)


def search_query(folded_name: Column, folded_addr: Column) -> Column:
    return F.concat_ws(" ", strip(folded_name), city_part(folded_addr), F.lit("公式サイト"))


def row_key(record: Column, code: Column, name: Column, addr: Column) -> Column:
    """Identity of a row: record id, else code, else name and address."""
    keep = lambda c: F.coalesce(c, F.lit(""))
    return F.when(blank(record) != "", F.concat(F.lit("R:"), blank(record))).when(blank(code) != "", F.concat(F.lit("C:"), blank(code))).otherwise(F.concat(F.lit("N:"), keep(name), F.lit("|"), keep(addr)))


def duplicate_key(code: Column, phone: Column, zip_: Column, name: Column, pref: Column) -> Column:
    """struct<kind, key> of normalized parts: code of ten, telephone of nine or more, postal code and name, else
    prefecture and name."""
    z = F.coalesce(zip_, F.lit(""))
    n, p = F.coalesce(name, F.lit("")), F.coalesce(pref, F.lit(""))
    pair = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
    return F.when(F.length(code) == 10, pair("CODE", code)).when(F.length(phone) >= 9, pair("PHONE", phone)).when((z != "") & (n != ""), pair("ZIP+NAME", F.concat_ws(":", z, n))).otherwise(pair("PREF+NAME", F.concat_ws(":", p, n)))


def duplicate_key_early(code: Column, zip_: Column, name: Column, pref: Column) -> Column:
    """The earlier rule: any nine digits are a code, without padding; no telephone."""
    return duplicate_key(F.when(F.length(code) >= 9, F.lpad(F.lit(""), 10, "0")), F.lit(""), zip_, name, pref).withField("key", F.when(F.length(code) >= 9, code).otherwise(duplicate_key(F.lit(""), F.lit(""), zip_, name, pref).key))


def fold(text: str | None) -> str:
    return unicodedata.normalize("NFKC", text or "")
