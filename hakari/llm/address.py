"""Parsing of addresses into region parts and lot numbers."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Place-name characters with an older or looser writing, each with the form that is compared.
VARIANTS = str.maketrans("ケヶが之の乃澤邊邉濱廣國條瀧龍櫻嶋齋髙﨑鹽稻關龜黑", "ガガガノノノ沢辺辺浜広国条滝竜桜島斎高崎塩稲関亀黒")
_KANJI = {c: i for i, c in enumerate("〇一二三四五六七八九")} | {"零": 0}
_NUMERAL = re.compile(r"[〇零一二三四五六七八九十百]+(?=\s*(?:丁目|丁|番|号|条|線|の|ノ|-|\d|$))")
_DIRECTION = {"N": "北", "S": "南", "E": "東", "W": "西"}
_GAP = re.compile(r"(?<=[〇一二三四五六七八九十])\s+(?=丁目|番|号)")
_LINES = re.compile(r"\s*[\r\n]+\s*")
_DASH = re.compile(r"(?<=\d)\s*[‐‑‒–—―−ーｰ\-－~〜](?=\s*\d)")
_FILLER = re.compile(r"^[\s\-－―ー\[\]()（）]*(?:不明|未入力|未登録|確認中|要確認|なし|n/?a|null|none)?[\s\-－―ー()（）]*$", re.I)
_POST = re.compile(r"〒?\s*\d{3}\s*-\s*\d{4}(?!\d)|〒\s*\d{7}")
_PREF = re.compile(r"^(北海道|.{2,3}?[都道府県])(?=.)")
_GRID = re.compile(r"([NSEW北南東西])(\d+)(?:条)?([NSEW北南東西])(\d+)(?:丁目)?")
_NEXT = re.compile(r"(?:丁目|丁|番地の|番地|番|号の|条|線|の|ノ|-)\s*(\d+)")
_LOT = re.compile(r"(?<![\d第])\d+(?=\s*(?:丁目|丁|番|条|の\d|ノ\d|-\d))")
_BUILDING = re.compile(r"^.*(?:号室|階|\dF|ビル\S*|タワー|プラザ|モール|マンション|BLD\.?)[)）]?\s+(?=\S)", re.I)
_MUNI = re.compile(r"^(?:([^市区]{1,7}?市)(?=.{2}))?(?:([^市区]{1,4}?区)(?=.))?(.*)$")
_SMALL = re.compile(r"^(.{1,3}?[町村])(?=.{2})(.+)$")
_SWAPPED = re.compile(r"^(?:丁目|番地|番|号)?\s*[、,]\s*(\S+?[市区町村])(?=$|\s|[(（])")
_THIRD = re.compile(r"\s*-?\s*(\d+)")
_NUMBER = re.compile(r"\d+")
# Characters without which a pattern has nothing to match: most addresses have none, and looking for one is cheaper.
_NUMERALS, _DASHES, _OLD = frozenset(_KANJI) | {"十", "百"}, frozenset("‐‑‒–—―−ーｰ－~〜"), frozenset(map(chr, VARIANTS))


def kanji_number(s: str) -> str:
    """二十三 and 二三 as 23; 百 counts hundreds."""
    if not any(c in "十百" for c in s):
        return "".join(str(_KANJI[c]) for c in s)
    total = digit = 0
    for c in s:
        if c in "十百":
            total, digit = total + (digit or 1) * (10 if c == "十" else 100), 0
        else:
            digit = digit * 10 + _KANJI[c]
    return str(total + digit)


@lru_cache(200_000)
def parse(address: str | None, pref: str | None = None) -> tuple[str, str, str, tuple[int, ...]] | None:
    """(city, ward, town, lot numbers), blank parts where missing; None for an address without any number.

    The building, floor and room don't count. Width, numerals, old character forms, 大字 and 字, a swapped order of
    municipality and lot, and a leading postal code or prefecture make no difference.
    """
    if not address or _FILLER.match(address):
        return None
    a = unicodedata.normalize("NFKC", address)
    if "-" in a or "〒" in a:
        a = _POST.sub("", a)
    a = a.strip()
    if not _NUMERALS.isdisjoint(a):
        a = _NUMERAL.sub(lambda m: kanji_number(m[0]), _GAP.sub("", a))
    bare = "".join(a.split())
    if not _DASHES.isdisjoint(a) or ("-" in a and len(bare) < len(a)):
        a = _DASH.sub("-", a)
        bare = "".join(a.split())
    if "\n" in a or "\r" in a:
        a = _LINES.sub(" ", a)
    m = _BUILDING.match(a) if len(bare) < len(a) else None
    if m and not _LOT.search(m[0]) and not _GRID.search(m[0]) and ((x := _LOT.search(a, m.end())) and x.start() > m.end()):
        a = a[m.end() :]
        bare = "".join(a.split())
    grid = _GRID.search(bare)
    if grid:
        flat = re.sub(r"\s+(?=[^\d]*\d)", " ", a)
        flat = re.sub(r"(?<=[^\d])\s+|\s+(?=[NSEW北南東西]\d)", "", flat)
        grid = _GRID.search(flat)
    if grid:
        head, tail = flat[: grid.start()], flat[grid.end() :]
        numbers = [int(grid[2]), int(grid[4])]
        head += _DIRECTION.get(grid[1], grid[1]) + _DIRECTION.get(grid[3], grid[3])
        most = 4
        m = _THIRD.match(tail)
        if m:
            numbers.append(int(m[1]))
            tail = tail[m.end() :]
    else:
        m = _LOT.search(a) or _NUMBER.search(a)
        if not m:
            return None
        head, tail, numbers, most = a[: m.start()], a[m.end() :], [int(m[0])], 3
    while len(numbers) < most and (m := _NEXT.match(tail)):
        numbers.append(int(m[1]))
        tail = tail[m.end() :]
    swapped = _SWAPPED.match(tail)
    head = "".join(head.split())
    if swapped:
        head = swapped[1] + head
    if pref and head.startswith(pref) and len(head) > len(pref):
        head = head[len(pref) :]
    elif (m := _PREF.match(head)) and m[1][-1] in "都道府県":
        head = head[m.end() :]
    head = head.replace("大字", "").replace("字", "")
    if not _OLD.isdisjoint(head):
        head = head.translate(VARIANTS)
    city, ward, town = _MUNI.match(head).groups()
    if not city and not ward and (m := _SMALL.match(town)):
        city, town = m.groups()
    return city or "", ward or "", town, tuple(numbers)
