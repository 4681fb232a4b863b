"""Facility names taken apart: legal form, kind of house, departments, and the part that is a proper name."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from .skeleton import skeleton

# Legal forms and the ways they are shortened.
LEGAL = "地方独立行政法人 独立行政法人 特定非営利活動法人 医療法人社団 医療法人財団 一般社団法人 公益社団法人 一般財団法人 公益財団法人 社会医療法人 特定医療法人 社会福祉法人 宗教法人 医療法人 学校法人 医療生協 厚生連 (医社) (医財) (社福) (医) 【医】 (一社) (社医) 医社) 医)".split()
# Kinds of house, each with its kana, abbreviations and the homophones and look-alikes that are typed for it, and
# what is put after a person's name.
KINDS = "クリニック くりにっく clinic 診療所 診寮所 診療書 しんりょうじょ 病院 病員 びょういん 医院 委員 いいん 医療センター hospital cl. hp".split()
PERSON = "せんせい 先生 さんち さん dr. dr 院長".split()
# Departments and their short forms, each family on a line.
FAMILIES = """
ペインクリニック内科 ペインクリニック ペイン pain
循環器内科 循環器科 循環器 循環 循内 cardiology
呼吸器内科 呼吸器科 呼吸器 呼内
消化器内科 消化器科 消化器 消内
心療内科 心療内 心療 心内 mentalhealth mental
脳神経外科 脳神経外 脳神経 脳外科 脳外 neurosurgery
整形外科 整形外 整形 orthopedics orthopedic
形成外科 形成外 形成
皮膚科 皮ふ科 ひふ科 皮膚 皮ふ skin dermatology
小児科 小児 こども pediatrics
耳鼻咽喉科 耳鼻科 耳鼻咽喉 耳鼻 咽喉 ent
産婦人科 産婦人 産婦 婦人科 産科 women
泌尿器科 泌尿器 泌尿 urology
アレルギー科 アレルギー アレ科 allergy
リハビリテーション科 リハビリテーション リハビリ科 リハビリ リハ科 リハ rehabilitation
矯正歯科 矯正 orthodontics
歯科 デンタル dental 歯
口腔外科 口腔外 口腔
眼科 eye 眼
内科 内 internalmedicine internal
外科 外
"""
# Usual readings of characters in family names.
READINGS = """
熊kuma 柏kashiwa 岩iwa 荒ara 深fuka 星hoshi 菅suga 鶴tsuru 稲ina 楠kusu 石ishi 堀hori 国kuni 鮎ayu 館tate 絹kinu 砂suna
笹sasa 栗kuri 糸ito 杉sugi 梅ume 柿kaki 細hoso 黒kuro 桑kuwa 菊kiku 金kane 亀kame 萩hagi 浅asa 里sato 塩shio 渡wata
椿tsubaki 赤aka 竹take 高taka 月tsuki 舟funa 水mizu 広hiro 麦mugi 島shima 辺be 沢sawa 田ta 林hayashi 風kaze 塚tsuka
家ie 屋ya 井i 津tsu 間ma 村mura 城shiro 川kawa 部be 代shiro 江e 本moto 尾o 下shita 越koshi 上ue 葉ha 関seki 岸kishi 根ne
谷tani 垣kaki 倉kura 木ki 条jo 山yama 内uchi 口kuchi 坂saka 原hara 橋hashi 野no 崎saki 滝taki
"""
_OLD = str.maketrans("髙﨑澤邊邉嶋齋濱廣國條瀧龍櫻鹽稻關龜黑醫桒會藏惠", "高崎沢辺辺島斎浜広国条滝竜桜塩稲関亀黒医桑会蔵恵")
_FAMILY = {w: line.split()[0] for line in FAMILIES.strip().split("\n") for w in line.split()}
_KANA_ROWS = {"": "アイウエオ", "k": "カキクケコ", "s": "サシスセソ", "t": "タチツテト", "n": "ナニヌネノ", "h": "ハヒフヘホ", "m": "マミムメモ", "r": "ラリルレロ", "g": "ガギグゲゴ", "z": "ザジズゼゾ", "d": "ダヂヅデド", "b": "バビブベボ", "p": "パピプペポ"}
_KANA = {k: c + v for c, row in _KANA_ROWS.items() for k, v in zip(row, "aiueo")} | {"ヤ": "ya", "ユ": "yu", "ヨ": "yo", "ワ": "wa", "ヲ": "o", "ン": "n", "ヴ": "bu"}
_SOUND = {x[0]: x[1:] for x in READINGS.split()}
_ROMAN = [("shi", "si"), ("chi", "ti"), ("tsu", "tu"), ("fu", "hu"), ("ji", "zi"), ("sh", "sy"), ("ch", "ty"), ("j", "zy")]
_WORDS = re.compile("|".join(map(re.escape, sorted(_FAMILY, key=len, reverse=True))))
_KIND = re.compile("|".join([*map(re.escape, KINDS), "ク[リッニツイク]{1,5}ク", r"\bcl\b", "(?<=科)医$|(?<=科)病$|(?<=科)診(?:療)?$"]))
_LEGAL = re.compile("(?:" + "|".join(map(re.escape, LEGAL)) + r")\s*(?:[^\s]{2}会(?=[^\s科]|\s))?")

# Katakana and the ideographs that the skeleton takes for them; a lone one is the ideograph.
_IDEOGRAPH = dict(zip("ロハニカトタエオチ", "口八二力卜夕工才千"))
_LONE = re.compile("(?<![ァ-ヶー])[" + "".join(_IDEOGRAPH) + "](?![ァ-ヶー])")


def sounded(s: str) -> str:
    """A rough sound: kana by rule, family-name characters by their usual reading, voiced as unvoiced, no long vowels.
    Characters without a reading stay."""
    out = []
    for c in s:
        if c in "ァィゥェォャュョ" and out and out[-1]:
            v = {"ァ": "a", "ィ": "i", "ゥ": "u", "ェ": "e", "ォ": "o", "ャ": "ya", "ュ": "yu", "ョ": "yo"}[c]
            out[-1] = out[-1][:-1] + v
        elif c in "ッー":
            continue
        else:
            out.append(_KANA.get(c) or _SOUND.get(c) or c)
    s = "".join(out)
    s = "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c))
    for a, b in _ROMAN:
        s = s.replace(a, b)
    s = s.translate(str.maketrans("gzdbpv", "ksthhh"))
    return re.sub(r"([aeiou])\1+|(?<=o)u", lambda m: m[1] or "", s)


@lru_cache(300_000)
def parts(name: str) -> tuple[str, str, tuple[str, ...]]:
    """(core, proper part as it sounds, departments) of a name."""
    s = unicodedata.normalize("NFKC", skeleton(name) or "").lower()
    s = _LONE.sub(lambda m: _IDEOGRAPH[m[0]], s)
    s = _LEGAL.sub(" ", _LEGAL.sub(" ", s)).translate(_OLD)
    core = "".join(c for c in s if c.isalnum())
    core = "".join(chr(ord(c) + 96) if "ぁ" <= c <= "ゖ" else c for c in core)
    found: list[str] = []

    def take(m: re.Match) -> str:
        found.append(_FAMILY[m[0]])
        return " "

    s = re.sub("|".join(map(re.escape, PERSON)), " ", s)
    glued = re.sub(r"[\s・/\-]+(?=科)|(?<=[外内歯器])[・/\-](?=\s*$)", "", s)
    rest = _WORDS.sub(take, _KIND.sub(" ", glued))
    rest = "".join(c for c in rest if c.isalnum() and c not in "科ヶヵケ")
    rest = "".join(chr(ord(c) + 96) if "ぁ" <= c <= "ゖ" else c for c in rest)
    return core, sounded(rest), tuple(sorted(set(found)))
