"""Departments named in texts and pages, and the basic areas they belong to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from . import html as H

#: Longest first; equally long ones in the order of the table.
NAMES = sorted(rules.BASIC_AREA, key=len, reverse=True)
_MASK = "�"


def departments(folded: Column, names: list[str] = NAMES) -> Column:
    """Department names in an NFKC text, longest first; what one name has taken no other can take.

    A name that does not occur unmasked any more is passed over; each is named once. All in built-in expressions:
    the text is masked step by step while the names that occur in it are folded over it.
    """

    def step(z: Column, w: Column) -> Column:
        at = F.position(w, z.t)
        hit = F.struct(F.overlay(z.t, F.repeat(F.lit(_MASK), F.length(w)), at).alias("t"), F.array_append(z.found, w).alias("found"))
        return F.when(at > 0, hit).otherwise(z)

    def one(t: Column) -> Column:
        words = F.array_compact(F.array(*[F.when(t.contains(w), F.lit(w)) for w in names]))
        return F.aggregate(words, F.struct(t.alias("t"), F.array().cast("array<string>").alias("found")), step, lambda z: z.found)

    return F.element_at(F.transform(F.array(folded), one), 1)  # so that the text is made once, whatever it comes from


def page_departments(html: Column) -> Column:
    """struct<title, section, nav>: departments in title and headings, after the first section word, and in menus."""
    h = F.coalesce(html, F.lit(""))
    head = F.array_join(F.concat(F.slice(H.titles(h), 1, 1), F.slice(H.headings(h), 1, 6)), " ")
    body = H.page_text(h)
    at = F.regexp_instr(body, F.lit("診療科目|診療科|標榜科|診療内容|診療案内"))
    section = F.when(at > 0, F.substring(body, at, F.lit(500))).otherwise("")
    menus = F.slice(H.menus(h), 1, 4)
    menu = F.array_join(menus, " ‖ ")
    return F.struct(departments(H.page_text(head)).alias("title"), departments(section).alias("section"), departments(H.page_text(menu)).alias("nav"))


def merged(found: Column, folded_name: Column) -> Column:
    """struct<names, source>: title, section and menu in this order; else what the facility's name says."""
    said = F.array_distinct(F.concat(found["title"], found["section"], found["nav"]))
    label = F.concat_ws("+", F.when(F.size(found["title"]) > 0, "見出し"), F.when(F.size(found["section"]) > 0, "診療科目欄"), F.when(F.size(found["nav"]) > 0, "メニュー"))
    own = departments(folded_name)
    return F.when(F.size(said) > 0, F.struct(said.alias("names"), label.alias("source"))).otherwise(F.struct(own.alias("names"), F.when(F.size(own) > 0, "施設名").otherwise("").alias("source")))


def basic_areas(names: Column, area: dict[str, str] = rules.BASIC_AREA) -> Column:
    """Basic areas of departments, in their order, each once; departments without an area are left out."""
    table = F.create_map(*[F.lit(x) for k, v in area.items() if v for x in (k, v)])
    return F.array_distinct(F.array_compact(F.transform(names, lambda d: F.try_element_at(table, d))))
