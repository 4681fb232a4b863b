"""Operators for training data: brute force, exact round trips, held-out accuracy, and hard inputs."""

import itertools
import os
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from hakari.llm import address, cutting, fusion, leaks, matching, names, packing, places, skeleton, terms, tokens, variants

PATH = tokens.default_path()


def rows(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=str)


# 5: terms


def test_hosts(spark):
    said = ["HTTPS://www.A.example:443/x", "a.example. / b.test", "（候補なし）", None, "ｈｔｔｐ：／／Ｃ．ｔｅｓｔ／", "N/A", "http://www/", "x@d.example", "a.example、a.example\nhttp://e.test?x=1"]
    d = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i int, u string")
    got = [r.h for r in d.select("i", terms.hosts(F.col("u")).alias("h")).orderBy("i").collect()]
    assert got == [["a.example"], ["a.example", "b.test"], [], [], ["c.test"], [], [], ["d.example"], ["a.example", "a.example", "e.test"]]


def test_frequencies_against_counting(spark):
    rnd = random.Random(1)
    data = [(rnd.randrange(300), ["hot"] * rnd.randrange(3) + [f"t{int(rnd.expovariate(0.05))}" for _ in range(rnd.randrange(4))], "x") for _ in range(3000)] + [(None, ["n", None], "x"), (1, None, "x"), (2, [], "x")]
    d = spark.createDataFrame(data, "r int, term array<string>, occurrences string")
    want = {}
    for r, ts, _ in data:
        for t in ts or []:
            if t is not None:
                n, who = want.setdefault(t, (0, set()))
                want[t] = (n + 1, who | {r})
    for heavy in (3, 64):
        got = {r.term: (r.occurrences, r.records) for r in terms.frequencies(d, "r", F.col("term"), heavy).collect()}
        assert got == {t: (n, len(who)) for t, (n, who) in want.items()}
    assert {(r.term, r.occurrences, r.records) for r in terms.frequencies(d, "r", F.col("term"), repeated=2).collect()} == {(t, n, len(who)) for t, (n, who) in want.items()}
    once = spark.range(2000).selectExpr("id r", "array('hot', concat('t', id % 700)) term")
    assert {(r.occurrences, r.records) for r in terms.frequencies(once, "r", F.col("term")).where("term = 'hot'").collect()} == {(2000, 2000)}
    assert terms.frequencies(d.where("false"), "r", F.col("term")).count() == 0
    marks = {r.term: r.mark for r in terms.marked(terms.frequencies(d, "r", F.col("term"))).collect()}
    assert marks["n"] == "rare" and marks["hot"] == "common"


# 2: skeletons


@pytest.mark.parametrize(
    "a,b",
    [("ﾊﾞ", "バ"), ("バ", "ハ゛"), ("é", "é"), ("Ａ１", "A1"), ("リ八ビリ", "リハビリ"), ("Саno", "Cano"), ("歯", "⻭"), ("皮", "⽪"), ("a　b", "a b"), ("病​院︀", "病院"), ("林", "林"), ("Tοmo", "Tomo"), ("クリ二ック", "クリニック"), ("へ", "ヘ"), ("千フ", "チフ"), ("〜", "～")],
)
def test_same_look(a, b):
    assert skeleton.skeleton(a) == skeleton.skeleton(b)


@pytest.mark.parametrize("a,b", [("ab", "a b"), ("ッ", "ツ"), ("髙", "高"), ("濱", "浜"), ("バ", "ハ"), ("é", "e"), ("㈱", "(株)"), ("①", "1"), ("a", "A")])
def test_unlike_look(a, b):
    assert skeleton.skeleton(a) != skeleton.skeleton(b)


def test_published_table(spark, tmp_path):
    """A file in the published format adds to the rules and does not undo them."""
    f = tmp_path / "confusables.txt"
    f.write_text("\ufeff# a comment\n0251 ;\t0061 ;\tMA\t# x\n\n1D6FC ; 0061 ; MA\n0430 ;\t0061 ;\tMA\n4E8C ; 30CB ; MA\n2103 ; 00B0 0043 ; MA\n", encoding="utf-8")
    assert skeleton.skeleton("℃", str(f)) == "°C" and skeleton.skeleton("℃") == "℃" and skeleton.skeleton("二а", str(f)) == skeleton.skeleton("ニa")
    d = spark.createDataFrame([(1, "℃"), (2, "°C"), (3, None)], "rid long, n string")
    assert rows(skeleton.look_alike_pairs(d, "rid", ["n"], path=str(f)), "record_id_a", "record_id_b") == [(1, 2)]
    assert skeleton.look_alike_pairs(d, "rid", ["n"]).count() == 0


def test_skeleton_is_stable():
    for i in random.Random(2).sample(range(0x20, 0x2FFFF), 20000):
        if not 0xD800 <= i < 0xE000:
            s = skeleton.skeleton(chr(i))
            assert skeleton.skeleton(s) == s
    assert skeleton.skeleton(None) is None and skeleton.skeleton("") == ""


def test_look_alike_pairs(spark):
    d = spark.createDataFrame([(1, "ア", None, "k"), (2, "ｱ", "", "k"), (3, "ア", "​", "k"), (2, "ｱ", "", "again"), (4, None, "x", "k"), (None, "ア", "x", "k")], "rid long, n string, m string, value string")
    want = [("m", 2, 3), ("n", 1, 2), ("n", 2, 3)]
    for size in (1, 4000):
        assert rows(skeleton.look_alike_pairs(d, "rid", ["n", "m"], size), "field", "record_id_a", "record_id_b") == want
    assert skeleton.look_alike_pairs(d.where("false"), "rid", ["n"]).count() == 0


# 1: fusion


def test_plain_group_and_usable(spark):
    d = spark.createDataFrame([("ｇ００００００１２", "http://x.example:80/a"), ("　G00000012", "HTTP://X.example./"), ("G12", "http://www/"), (None, None), ("", "ftp://x.example"), ("G00000001", "https://sub.bad.example")], "g string, u string").withColumn("h", fusion.url_host(F.col("u")))
    got = d.select(fusion.plain_group(F.col("g")).alias("g"), "h", fusion.good_host(F.col("h"), ["bad.example"]).alias("k")).collect()
    assert [tuple(r) for r in got] == [("G00000012", "x.example", True), ("G00000012", "x.example", True), (None, None, False), (None, None, False), (None, None, False), ("G00000001", "sub.bad.example", False)]
    many = [f"h{i}.example" for i in range(600)] + ["bad.example"]
    assert [r[0] for r in d.select(fusion.good_host(F.col("h"), many)).collect()] == [r.k for r in got]
    z = spark.createDataFrame([("〒１２３-4567",), ("0000000",), ("123456",), (None,)], "z string")
    assert [r[0] for r in z.select(fusion.good_zip(F.col("z"))).collect()] == [True, False, False, False]


def test_fusion_discounts_copies(spark):
    """Held-out accuracy: one poor source is copied four times; fusion beats the vote that the copies win."""
    rnd = random.Random(9)
    claims, vote = [], 0
    for o in range(300):
        said = {s: "true" if rnd.random() < 0.75 else f"wrong{rnd.randrange(15)}" for s in "abcdefg"}
        said["x"] = "true" if rnd.random() < 0.4 else f"wrong{rnd.randrange(15)}"
        for s in "yzuv":
            said[s] = said["x"] if rnd.random() < 0.95 else ("true" if rnd.random() < 0.4 else f"wrong{rnd.randrange(15)}")
        votes = list(said.values())
        vote += max(sorted(set(votes)), key=votes.count) == "true"
        claims += [(f"o{o}", v, s) for s, v in said.items()]
    claims += [(None, "v", "a"), ("o", None, "a"), ("o", "v", None)]
    d = spark.createDataFrame(claims, "object string, value string, source string")
    best = {}
    for r in fusion.fuse(d, rounds=4).collect():
        best[r.object] = max(best.get(r.object, (0, "")), (r.posterior, r.value))
    right = sum(v == "true" for _, v in best.values())
    assert len(best) == 300 and right >= 280 > vote + 10
    assert fusion.fuse(d.where("false")).count() == 0
    with pytest.raises(ValueError):
        fusion.fuse(d, most_sources=2)
    model = fusion.estimate(d, 4)
    far = d.withColumn("prior", F.when(F.col("value").startswith("wrong"), model.most * 4).otherwise(0.0))
    far = fusion.fuse(far, model).groupBy("object").agg(F.max_by("value", "score").alias("v"))
    assert far.where("v like 'wrong%'").count() >= 280


def test_survivors(spark):
    data = [(1, "G1", "u1", "z"), (2, "G1", None, "z2"), (3, "G1", None, None), (3, "G1", None, None), (4, "G2", None, None), (5, "G2", None, "z"), (6, "G3", "u", "z"), (7, None, "u", "z"), (None, "G1", "u", "z")]
    d = spark.createDataFrame(data, "rid long, grp string, url string, zip string").withColumn("posterior", F.lit("clash"))
    fields = {"url": (F.col("url"), F.col("url").isNotNull()), "zip": (F.col("zip"), F.col("zip").isNotNull())}
    got = fusion.survivors(d, "rid", F.col("grp"), F.lit("s"), fields, "url", None, flag="rep")
    assert rows(got, "dup_group_id", "field", "record_id") == [("G1", "rep", 1), ("G1", "url", 1), ("G1", "zip", 1), ("G2", "rep", 5), ("G2", "zip", 5)]
    assert fusion.survivors(d.where("false"), "rid", F.col("grp"), F.lit("s"), fields, "url").count() == 0


def test_posterior_decides_the_survivors(spark, small, monkeypatch):
    """Other posteriors give other rows: nothing stands beside the fusion."""
    from hakari.llm import catalogue

    got = {tuple(r) for r in catalogue.p1_found(spark, small).collect()}
    whole = fusion.weighed
    monkeypatch.setattr(fusion, "weighed", lambda c, m: whole(c, m).withColumn("score", F.rand(3)))
    other = {tuple(r) for r in catalogue.p1_found(spark, small).collect()}
    assert len(got & other) < 0.9 * len(got)
    monkeypatch.setattr(fusion, "weighed", lambda c, m: whole(c.withColumn("prior", F.lit(0.0)) if "prior" in c.columns else c, m))
    assert len({tuple(r) for r in catalogue.p1_found(spark, small).collect()} & got) < len(got)


def test_a_hot_group_has_its_survivor(spark):
    d = spark.range(3000).selectExpr("id rid", "if(id % 3 = 0, concat('G', id), 'G') grp", "if(id < 2990, concat('u', id % 700), null) url")
    got = fusion.survivors(d, "rid", F.col("grp"), F.lit("s"), {"url": (F.col("url"), F.col("url").isNotNull())}, "url", None, flag="rep")
    assert rows(got, "dup_group_id", "field", "record_id") == [("G", "rep", 2989), ("G", "url", 2989)]
    whole = fusion.fuse(d.selectExpr("grp object", "url value", "'s' source")).groupBy("object").agg(F.sum("posterior").alias("p")).where("p > 1.000001")
    assert whole.count() == 0


# 3: places


@pytest.mark.parametrize(
    "said,parsed",
    [
        ("柊浦市中央区N5W13-36-51 第2ビル", ("柊浦市", "中央区", "北西", (5, 13, 36, 51))),
        ("柊浦市中央区\n北二十八条西二十七丁目四十五番七十二号", ("柊浦市", "中央区", "北西", (28, 27, 45, 72))),
        ("黄金本町6丁目 4番 4号、榎沢市", ("榎沢市", "", "黄金本町", (6, 4, 4))),
        ("〒123-4567 青磯県桐里市字楢谷町６丁目 ５２番 ５号 駅前ビル 102号室", ("桐里市", "", "楢谷町", (6, 52, 5))),
        ("プラムビル6階 粟垣五丁目５２番４号", ("", "", "粟垣", (5, 52, 4))),
        ("菫町鐘田町２ー４１ー１５", ("菫町", "", "鐘田町", (2, 41, 15))),
        ("不明", None), ("", None), (None, None), ("榊木市西区", None),
    ],
)
def test_parse(said, parsed):
    assert address.parse(said) == parsed


def test_parse_leaves_out_no_rare_form():
    """Patterns that are only tried where one of their characters stands."""
    assert address.parse("〒1234567 甲市乙 1 - 2 〜 3") == ("", "", "甲市乙", (1, 2, 3))
    assert address.parse("甲市澤ヶ丘\u3000百二番\r\n 三号") == ("甲市", "", "沢ガ丘", (102, 3))
    assert address.parse("甲ビル2F\u2003乙町〇三丁目４－５") == ("", "", "乙町", (3, 4, 5))


def test_parse_finds_a_grid_behind_a_long_lead():
    assert address.parse("案内所の奥" * 13 + "柊浦市中央区北3条西17丁目4番5号")[3] == (3, 17, 4, 5)


def test_places(spark):
    z = "1234567"
    data = [(1, "甲市乙町1丁目2番3号", z, "丙県"), (2, "甲市乙町１－２－３ ビル2F", z, "丙県"), (3, "乙町一丁目2-3", z, None), (4, "甲市乙町1-2", None, "丙県"), (5, "甲市乙街1-2-3", z, "丙県"), (6, "甲市乙町1-2-4", z, "丙県"), (7, "甲市", z, "丙県"), (8, None, None, None), (9, "丁市乙町1-2-3", "7654321", "戊県"), (1, "甲市乙町1丁目2番3号", z, "丙県"), (10, "丁市乙町1-2", "7654321", "戊県")]
    d = spark.createDataFrame(data, "record long, addr string, zip string, pref string")
    p = places.places(d)
    of = dict(rows(p, "record", "place"))
    assert of[1] == of[2] == of[3] == of[5] != of[6] and of[9] == of[10] != of[1] and 4 not in of and 7 not in of and 8 not in of
    got = {tuple(sorted(x)) for x in rows(places.same_place_pairs(p, 1), "record_id_a", "record_id_b")}
    assert got == {*itertools.combinations([1, 2, 3, 5], 2), (9, 10)}
    again = dict(rows(places.places(d, per_block=1), "record", "place"))
    assert {k: sorted(r for r in again if again[r] == v) for k, v in again.items()} == {k: sorted(r for r in of if of[r] == v) for k, v in of.items()}
    assert places.places(d.where("false")).count() == 0


def test_linkage_separates():
    """One place, another town of the same city, and a town of the same name elsewhere."""
    chance = {"020001": 700, "020101": 20, "320021": 60, "322321": 5, "022001": 15, "021001": 20}
    w = places.linkage({"332321": 900, "232321": 60, "331321": 80, "330321": 9, "022001": 12, "020001": 1}, chance)
    assert min(w["332321"], w["232321"], w["331321"]) > 0.9 and max(w["330321"], w["022001"], w["020001"]) < 0.5
    assert places.linkage({}) == {}


def test_chance_agreement_is_that_of_all_pairs(spark):
    """By component, against every pair compared by itself; towns with an end in common, too."""
    rnd = random.Random(3)
    pick = lambda *x: rnd.choice(x)
    data = {(pick(None, "1234567", "1234568", "7654321"), pick(None, "甲県", "乙県"), pick("", "丙市", "丙丁市", "戊辰市", "己町丙"), pick("", "北区", "南区", "南北区"), pick("", "町", "旭", "旭町", "旭ヶ丘", "旭丘", "岡旭", "丙旭", "戊己庚"), pick("1", "1-2")) for _ in range(400)}
    data |= {(None, None, "丙丁", "", "戊己庚", "1"), (None, None, "丙", "", "丁戊己庚", "1"), (None, None, "丙", "丁", "戊己庚", "1"), (None, None, "己庚辛", "壬", "癸", "1"), (None, None, "己", "庚辛壬", "癸", "1")}
    d = spark.createDataFrame([(i, *x) for i, x in enumerate(sorted(data, key=str))], "w long, zip string, pref string, city string, ward string, town string, lots string")
    counts, near = places.by_chance(d)
    side = lambda p: d.select(*[F.col(c).alias(f"{p}_{c}") for c in d.columns])
    tx, ty = places._plain_town("x_"), places._plain_town("y_")
    touch = (F.substring(tx, 1, 1) == F.substring(ty, 1, 1)) | (F.substring(tx, -1, 1) == F.substring(ty, -1, 1))
    every = places.compared(side("x").join(side("y"), F.col("x_w") < F.col("y_w")), F.lit(False)).groupBy("levels", touch.alias("touch")).count().collect()
    for j, c in enumerate(places.LEVELS):
        if c in ("city", "ward", "zip", "pref"):
            for level in range(places.LEVELS[c]):
                want = sum(r["count"] for r in every if r.levels[j] == str(level))
                assert counts["-" * j + str(level) + "-" * (5 - j)] == want, (c, level)
    ends = [sum(r["count"] for r in every if r.touch and r.levels[2] == k) for k in "01"]
    assert near == pytest.approx((ends[1] + 3) / (sum(ends) + 20))
    assert places.by_chance(d.where("false"))[1] == 0.15


def test_weights_decide_the_places_and_blocks_lose_few(spark, small, monkeypatch):
    """With all weights at one other pairs come out; with one block for each lot hardly any more do."""
    from hakari.llm import catalogue

    d = catalogue._addresses(spark, "/root/testdata/sf0.01" if os.path.isdir("/root/testdata/sf0.01") else small)
    pairs = lambda: {tuple(r) for r in places.same_place_pairs(places.places(d)).collect()}
    fitted, model = {}, places.linkage
    every_level = ["".join(map(str, x)) for x in itertools.product(*map(range, places.LEVELS.values()))]

    def fit(counts, *a):
        fitted.update(model(dict.fromkeys(every_level, 1e-9) | counts, *a))
        return {k: fitted[k] for k in counts}

    with monkeypatch.context() as m:
        m.setattr(places, "linkage", fit)
        got = pairs()
    with monkeypatch.context() as m:
        m.setattr(places, "_keys", lambda lots: F.array(F.xxhash64(lots)))
        m.setattr(places, "linkage", lambda counts, *a: {k: fitted[k] for k in counts})
        every = pairs()
    assert len(got & every) >= 0.99 * len(every) and len(got - every) <= 0.01 * len(got)
    monkeypatch.setattr(places, "linkage", lambda counts, *a: dict.fromkeys(counts, 1.0))
    assert pairs() != got


def test_long_chains_of_links_make_no_larger_plans(spark, monkeypatch):
    joins, cut = [], places.cut

    def spied(d, *a):
        joins.append(d._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return cut(d, *a)

    def most(towns):
        joins.clear()
        places.places(spark.createDataFrame([(i, f"甲市{t}1-2-3", "1234567", None) for i, t in enumerate(towns)], "record long, addr string, zip string, pref string"))
        return max(joins)

    monkeypatch.setattr(places, "cut", spied)
    monkeypatch.setattr(places, "by_chance", lambda plain: ({}, 0.15))
    monkeypatch.setattr(places, "linkage", lambda counts, *a: {k: float(k[2] > "0") for k in counts})
    a, b = "旭鳩山桜鷺亀城榊柊葵雲森", "梅松竹菊藤萩桐杉楓椿桃柳"
    assert most([b[:i] + a[i:-1] + "田" for i in range(12)]) == most(["旭山田", "旭川田"])


def test_block_keys_are_made_once_without_patterns(spark, monkeypatch):
    """A plan that goes through them makes each of the five keys once, and no pattern is matched."""
    seen, hot = [], places.hot_keys

    def spied(rows, *a, **k):
        seen.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return hot(rows, *a, **k)

    monkeypatch.setattr(places, "hot_keys", spied)
    places.places(spark.createDataFrame([(1, "甲市乙町1-2-3", "1234567", None), (2, "甲市乙1-2-3", "1234567", None)], "record long, addr string, zip string, pref string"))
    assert seen[0].count("xxhash64(") == 5 and "regexp" not in seen[0]


def test_places_without_patterns_are_as_with_them(spark):
    towns = ["".join(x) for k in range(4) for x in itertools.product("町旭𠮷", repeat=k)]
    d = spark.createDataFrame([(t,) for t in towns], "town string")
    assert d.where(places._plain_town() != F.regexp_replace("town", "(?<=.)町+$", "")).count() == 0
    d = spark.createDataFrame([(x,) for x in ("1-2", "12-345", "1-2-3-44")], "lots string")
    assert d.where(places._outer_lots() != F.regexp_replace("lots", r"-\d+$", "")).count() == 0
    zips = {"123-4567": "1234567", "1234567": "1234567", "〒１２３－４５６７": "1234567", "123-4567\n": "1234567", "1111111": None, "111-1111": None, "1111112": "1111112", "123-456": None, "12345678": None, "1234-567": "1234567", "": None, "x": None, None: None}
    d = spark.createDataFrame([(k, v) for k, v in zips.items()], "z string, want string")
    assert d.where(~places.zip_code(F.col("z")).eqNullSafe(F.col("want"))).count() == 0


# 4: variants


def test_name_parts():
    assert names.parts("医療法人財団慈徳会渚崎 星口内科・循環器科病院")[2] == ("内科", "循環器内科")
    assert names.parts("クスギシ泌尿器科 医院")[1] == names.parts("楠岸泌尿器科医院")[1] == names.parts("Kusugishi Clinic")[1]
    assert names.parts("")[1] == ""


def test_entities(spark):
    data = [
        (1, "凪沼楠岸眼科医院", "0123456789", "p1", None), (2, "クスギシ眼科", "0123456789", None, None), (3, "凪沼クスギシ眼科", None, "p1", None),
        (4, "暁原星上皮膚科", None, "p1", None), (5, "凪沼楠岸眼科医院", None, "p2", None), (6, None, None, "p1", None), (7, "医療法人凪沼楠岸眼科医院", None, None, "h"), (5, "凪沼楠岸眼科医院", None, "p2", None), (8, "凪沼楠岸眼科医院", None, "p2", "h"),
    ]
    d = spark.createDataFrame(data, "record long, name string, code string, place string, host string")
    contexts = {"code": True, "place": False, "host": False}
    for size in (20_000, 1):
        m = variants.entities(d, contexts, size)
        of = dict(rows(m, "record", "entity"))
        assert of[1] == of[2] == of[3] and of[5] == of[7] == of[8] and len({of[1], of[4], of[5], of[6]}) == 4
        assert rows(variants.variant_pairs(m, 1), "record_id_a", "record_id_b") == [(1, 2), (1, 3), (2, 3), (5, 7), (7, 8)]
    assert variants.variant_pairs(variants.entities(d.where("false"), contexts)).count() == 0
    unlike = spark.createDataFrame([(1, "凪沼楠岸眼科医院", "0123456789"), (2, "暁原星上皮膚科", "0123456789")], "record long, name string, code string")
    assert len(set(dict(rows(variants.entities(unlike, {"code": True}), "record", "entity")).values())) == 2


def _names(spark, lists):
    d = spark.createDataFrame([(i, 1, None, sorted(set(x))) for i, x in enumerate(lists)], "pid long, depts int, code string, g array<int>")
    d = d.withColumn("a", F.transform("g", lambda x: x % 3)).withColumn("z", F.transform("g", lambda x: x % 5)).where("size(g) > 0")
    return variants.weighted(d, variants.counted(d, "g")).cache()


def test_prefix_filter_loses_nothing(spark):
    rnd = random.Random(4)
    names_ = _names(spark, [[int(rnd.expovariate(0.2)) for _ in range(rnd.randrange(1, 9))] for _ in range(150)])
    members = names_.selectExpr("pid % 2 block", "false sure", "pid", "pid id")
    got = {frozenset((r.a, r.b)) for r in variants.similar(members, names_).collect()}
    w = {r.pid: r for r in names_.collect()}
    want = set()
    for x, y in itertools.combinations(w.values(), 2):
        x, y = sorted((x, y), key=lambda r: (r.total, r.pid))
        equal = sum(v for g, v in zip(x.g, x.w) if g in y.g)
        near = sum(v for g, a, z, v in zip(x.g, x.a, x.z, x.w) if g not in y.g and ((a and a in y.a) or (z and z in y.z)))
        if x.pid % 2 == y.pid % 2 and equal >= variants.EQUAL * x.total and (equal + variants.HALF * near) >= variants.LIKE * x.total:
            want.add(frozenset((x.pid, y.pid)))
    assert got == want and len(want) > 100
    assert {frozenset((r.a, r.b)) for r in variants.similar(members, names_, 20).collect()} == want
    assert all(r.pre < len(r.g) for r in w.values() if len(r.g) > 7)


def test_names_decide_the_entities(spark, small, monkeypatch):
    """Without the join of names nothing but equal names is linked; against all pairs of each context few links are lost."""
    from hakari.llm import catalogue

    pairs = lambda: {tuple(r) for r in catalogue.p4_found(spark, small).collect()}
    got, weighted = pairs(), variants.weighted
    with monkeypatch.context() as m:
        m.setattr(variants, "weighted", lambda *a: weighted(*a).withColumn("pre", F.size("g")))
        every = pairs()
    assert len(got & every) >= 0.99 * len(every) and got <= every
    monkeypatch.setattr(variants, "similar", lambda members, *a: members.selectExpr("id a", "id b").where("false"))
    assert len(pairs()) < 0.5 * len(got)


def test_entities_take_chance_agreement_from_all_pairs(spark, small, monkeypatch):
    from hakari.llm import catalogue

    seen, whole = [], places.by_chance

    def spied(plain):
        seen.append((plain.count(), *whole(plain)))
        return seen[-1][1:]

    monkeypatch.setattr(places, "by_chance", spied)
    catalogue._entities(spark, small)
    (n, counts, _), each = seen[0], {}
    for k, v in counts.items():
        c = next(c for c, d in zip(places.LEVELS, k) if d != "-")
        each[c] = each.get(c, 0) + v
    assert n > 100 and each == dict.fromkeys(("city", "ward", "zip", "pref"), n * (n - 1) // 2)


# 6: matching


def test_matches_against_brute_force(spark, small, monkeypatch):
    """Recall of walks, hashing and confidence against all pairs under the exact check, with vectors fitted on all records
    and on a tenth; and what is left of it when the vectors say nothing or belong to other records."""
    from hakari.llm import catalogue

    d = catalogue._two_sources(spark, small)
    pairs = lambda **k: {(r.a, r.b) for r in matching.matches(d, **k).select("a", "b").collect()}
    got, few, whole, split = pairs(), pairs(fit=200), matching.hashed, matching._refined
    with monkeypatch.context() as m:
        m.setattr(matching, "hashed", lambda *a: whole(*a).withColumn("keys", F.array(F.lit(1).cast("long"))))
        every = {(r.a, r.b) for r in matching.scored(d).where(matching.AGREED).select("a", "b").collect()}
        m.setattr(matching, "_refined", lambda k, r: split(k, r, 1))
        assert {(r.a, r.b) for r in matching.scored(d).where(matching.AGREED).select("a", "b").collect()} == every
    assert got <= every and min(len(got), len(few)) >= 0.95 * len(every) > 0
    with monkeypatch.context() as m:
        none = lambda r: np.array(sorted(x.h for x in r.select(F.explode(F.flatten("tokens")).alias("h")).distinct().collect()), np.int64)
        m.setattr(matching, "hashed", lambda r, v, c, b: whole(r, ((h := none(r)), np.zeros((len(h), matching.DIM), np.float32)), c, b))
        assert len(pairs() & every) < 0.1 * len(every)
    with monkeypatch.context() as m:
        of = lambda *a: whole(*a).withColumns({k: F.expr(f"lag({k}, 7) over (partition by side order by id)") for k in ("keys", "vec", "named", "placed")})
        m.setattr(matching, "hashed", of)
        assert len(pairs() & every) < 0.5 * len(every)


def test_confidence_decides(spark, small):
    """The confidence alone, without the exact check, gives almost the same pairs."""
    from hakari.llm import catalogue

    folder = "/root/testdata/sf0.01" if os.path.isdir("/root/testdata/sf0.01") else small
    f = matching.scored(catalogue._two_sources(spark, folder)).withColumn("agreed", F.expr(matching.AGREED)).cache()
    sure = f.where(f"confidence >= {matching.CUT}")
    assert sure.where("agreed").count() >= 0.97 * sure.count() and sure.count() < 0.6 * f.count()
    assert sure.where("agreed").count() >= 0.97 * f.where("agreed").count()
    f.unpersist()


def test_all_records_and_labels_make_the_model(spark):
    """With shards of 20 something is learned of every telephone that two records share; all labelled pairs are counted."""
    n = 200
    shape = "side int, id long, name string, addr string, pref string, phone string, code string, host string"
    d = spark.createDataFrame([(side, i, "凪沼楠岸眼科医院", None, None, f"03{i:08d}", None, None) for side in (0, 1) for i in range(n)], shape)
    r = matching.tokens_of(matching.described(d).na.fill("", ["phone", "code", "host"])).cache()
    phones = np.array([x.t for x in r.selectExpr("tokens[5][0] t").distinct().collect()], np.int64)
    none, learned = matching.fit_vectors(r, 20)
    assert none is None and len(phones) == n and (np.abs(learned[phones & (matching.LEARNED - 1)]).sum(1) > 0).all()
    assert (matching.fit_vectors(r, 20)[1] == pytest.approx(learned, abs=1e-3)) and not matching.fit_vectors(r.where("false"))[1].any()
    r.unpersist()
    pairs = spark.range(60_000).selectExpr("id a", "id b", "if(id % 3 = 0 or id % 7 = 0, 2, -1) code", "if(id % 5 = 0, 2, 0) name", "true place", "true phone", *[f"double(pmod(hash(id, '{k}'), 100)) / 100 {k}" for k in matching.SCORED if k not in ("place", "phone")])
    known = [i for i in range(0, 60_000, 5)]
    w, right = matching.calibrate(pairs)
    assert right == (sum(i % 3 == 0 or i % 7 == 0 for i in known) + 10) / (len(known) + 10) and np.isfinite(w).all()


def test_walks_go_from_record_to_record():
    groups = [(np.array([0, 2, 2, 3]), np.array([0, 1, 1])), (np.array([0, 0, 1, 2]), np.array([2, 2]))]
    lines = matching._walks(groups, 3, 5, 6, np.random.default_rng(1))
    assert lines.shape == (15, 6) and set(lines.ravel().tolist()) <= {0, 1, 2} and (lines[5:10, 0] == 2).all()


def test_matches_hard_rows(spark):
    shape = "side int, id long, name string, addr string, pref string, phone string, code string, host string"
    data = [(0, 1, "凪沼楠岸眼科医院", "甲市乙町1-2-3", "丙県", "0312345678", None, None), (0, 2, None, None, None, None, None, None), (1, 7, "楠岸眼科", "甲市乙町1丁目2番3号", "丙県", None, None, None), (1, 8, "暁原星上皮膚科", "甲市乙町1-2-3", None, "0312345678", None, None), (1, 7, "楠岸眼科", "甲市乙町1丁目2番3号", "丙県", None, None, None), (1, 9, "", "", "", "", "", ""), (0, None, "x", "y", "z", None, None, None)]
    got = matching.matches(spark.createDataFrame(data, shape)).collect()
    assert {(r.a, r.b) for r in got} == {(1, 7)} and all(0 <= r.confidence <= 1 for r in got)
    assert matching.matches(spark.createDataFrame([], shape)).count() == 0


def test_own_host_links(spark):
    """One facility's host stays its own with its code blank, short and long, and with many spellings; a portal's goes."""
    shape = "side int, id long, name string, addr string, pref string, phone string, code string, host string"
    name, at, moved = "凪沼楠岸眼科医院", "甲市乙町1-2-3", "甲市丙町5-6-7"
    data = [(0, 1, name, at, None, None, None, "own.example"), (1, 7, name, moved, None, None, None, "own.example"), (0, 2, name, at, None, None, "0123456789", "own.example"), (1, 8, name, at, None, None, "3456789", "own.example")]
    data += [(0, 10 + i, name + chr(0x4E00 + i), "甲市乙町1-2", None, None, None, "own.example") for i in range(20)]
    data += [(0, 50, name, "丁市戊町8-8-8", None, None, None, "portal.example"), (1, 51, name, "丁市己町9-9-9", None, None, None, "portal.example"), (1, 52, "暁原星上皮膚科", "丁市庚町4-4-4", None, None, None, "portal.example")]
    d = spark.createDataFrame(data, shape)
    r = matching.described(d).na.fill("", ["phone", "code", "host"])
    assert rows(matching.shared_hosts(r), "host") == [("portal.example",)]
    got = {(x.a, x.b) for x in matching.matches(d).collect()}
    assert {(1, 7), (2, 7), (1, 8), (2, 8)} <= got and (50, 51) not in got


# 7: packing


def test_plan_is_whole_and_tight():
    rnd = random.Random(5)
    for cap in (1, 7, 100, 512):
        hist = {}
        for _ in range(4000):
            k = min(cap, 1 + int(rnd.expovariate(3 / cap)))
            hist[k] = hist.get(k, 0) + 1
        load, seen = {}, {}
        lines = packing.plan(list(hist.items()), cap)
        for n, (k, first, box, each) in enumerate(lines):
            end = lines[n + 1][1] if n + 1 < len(lines) and lines[n + 1][0] == k else hist[k]
            assert first == seen.get(k, 0)
            for r in range(first, end):
                c = box + (r - first) // each
                load[c] = load.get(c, 0) + k
            seen[k] = end
        assert seen == hist and max(load.values()) <= cap and sorted(load) == list(range(len(load)))
        assert len(load) <= 1.25 * -(-sum(k * v for k, v in hist.items()) // cap) + 1
    assert packing.plan([], 5) == []


def test_pack(spark):
    sizes = [(i, s) for i, s in enumerate([0, 1, 5, 10, 11, 25, 3, 3, 3, 7, 10])] + [(None, 3), (99, None)]
    d = spark.createDataFrame(sizes, "doc long, n_tokens long")
    for bucket in (1, 100):
        got = packing.pack(d, [(1, 10), (2, 100)], bucket).collect()
        for limit, cap in ((1, 10), (2, 100)):
            mine = [r for r in got if r.limit_id == limit]
            for doc, n in sizes[:-2]:
                at = sorted((r.from_token, r.n_tokens) for r in mine if r.doc == doc)
                assert sum(n for _, n in at) == n and len(at) == max(1, -(-n // cap))
            load = {}
            for r in mine:
                load[r.container] = load.get(r.container, 0) + r.n_tokens
            assert max(load.values()) <= cap
    assert packing.pack(d.where("false"), [(1, 10)]).count() == 0 and packing.pack(d, []).count() == 0


def test_equal_lengths_are_spread(spark):
    got = packing.pack(spark.range(5000).selectExpr("id doc", "cast(3 as long) n_tokens"), [(1, 10)], 100)
    assert got.groupBy("container").agg(F.sum("n_tokens").alias("n")).where("n > 10").count() == 0
    assert got.select("container").distinct().count() == 1667 and got.select("doc").distinct().count() == 5000


# 8: leaks


def test_winnowing_guarantee():
    rnd = random.Random(6)
    for _ in range(50):
        text = "".join(rnd.choice("あいうえおかきくけこ") for _ in range(300))
        at = rnd.randrange(200)
        span = text[at : at + leaks.K + leaks.WINDOW - 1]
        other = "".join(rnd.choice("さしすせそたちつてと") for _ in range(100)) + span + "なにぬ"
        a, b = (set(leaks.minima(leaks.grams(leaks._codes(x))).tolist()) for x in (text, other))
        assert a & b
    assert len(leaks.grams(leaks._codes("ab"))) == 0


def test_leaks(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("日月火水木金土山川田上下左右中大小") for _ in range(rnd.randrange(2, 6)))
    item = ["".join(word() for _ in range(8)) + f"{i}件" for i in range(6)]
    noise = "".join(word() for _ in range(200))
    whole = "。".join(item)
    docs = [
        (1, noise + whole, True), (2, "、\n".join(reversed(item)) + noise, True), (3, noise + "<b>" + whole.replace("件", "個") + "</b>", True), (4, noise + item[0], False), (5, noise, False), (6, "", False), (7, None, False),
        (8, unicodedata.normalize("NFKC", whole).replace("1", "１") * 2, True), (9, noise * 20 + item[1] + noise + item[2] + noise + item[3] + item[4], True), (1, noise + whole, True),
    ]
    d = spark.createDataFrame([x[:2] for x in docs], "doc_id long, text string").withColumn("share", F.lit(1))
    q = spark.createDataFrame([(50, whole), (51, "短い"), (52, None), (None, whole)], "item_id long, text string")
    for bits in (22, 30):
        got = rows(leaks.leaks(d, q, "doc_id", "text", "item_id", "text", most_bits=bits), "item_id", "doc_id")
        assert got == sorted({(50, i) for i, _, leak in docs if leak})
    named = leaks.leaks(d.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), q.withColumn("item_id", F.concat(F.lit("q"), "item_id")), "doc_id", "text", "item_id", "text")
    assert rows(named, "item_id", "doc_id") == sorted({("q50", f"d{i}") for i, _, leak in docs if leak})
    assert leaks.leaks(d, q.where("false"), "doc_id", "text", "item_id", "text").count() == 0 == leaks.leaks(d.where("false"), q, "doc_id", "text", "item_id", "text").count()


# 9: cutting

LIMITS = [(1, 16, 0), (2, 24, 6)]


def hard_texts():
    rnd = random.Random(8)
    out = [None, "", "短い。", "終わりのない" * 400, "a" * 3000, "😀" * 200, "行\r\n\r\n行\n" * 60, "Dr. 3.14 and so on, etc. " * 40, " " * 500, "​é" * 90]
    return out + ["".join(rnd.choice("あ漢a1 。、\n😀é.") for _ in range(rnd.randrange(900))) for _ in range(40)]


def test_cut_is_a_round_trip(spark):
    texts = hard_texts()
    d = spark.createDataFrame(list(enumerate(texts)), "id long, t string").withColumn("piece", F.lit("clash"))
    enc = tokens.encoding(PATH)
    by = {}
    for r in cutting.cut_texts(d, "id", "t", LIMITS, PATH).collect():
        by.setdefault((r.limit_id, r.doc_id), []).append(r)
    for i, t in enumerate(texts):
        for limit, most, overlap in LIMITS:
            got = sorted(by.get((limit, i), []), key=lambda r: r.piece)
            if len(enc.encode_ordinary(t or "")) <= most:
                assert not got
                continue
            raw, end = t.encode(), 0
            assert [r.piece for r in got] == list(range(len(got)))
            for r in got:
                piece = r.piece_text.encode()
                assert raw[r.from_byte : r.from_byte + len(piece)] == piece and r.from_byte <= end
                assert len(enc.encode_ordinary(r.piece_text)) <= r.n_tokens <= most
                if r.piece and overlap:
                    assert overlap <= r.n_tokens and len(raw[r.from_byte : end]) > 0
                end = r.from_byte + len(piece)
            assert end == len(raw)
    with pytest.raises(ValueError):
        cutting.cut_texts(d, "id", "t", [(1, 10, 9)], PATH)
    assert cutting.cut_texts(d.where("false"), "id", "t", LIMITS, PATH).count() == 0 == cutting.cut_texts(d, "id", "t", [], PATH).count()


def test_cut_prefers_strong_boundaries(spark):
    text = "今日は晴れです。明日は雨、たぶん。\n\n" * 30
    d = spark.createDataFrame([(1, text)], "id long, t string")
    got = cutting.cut_texts(d, "id", "t", [(1, 64, 0)], PATH).orderBy("piece").collect()
    assert all(re.search(r"\n\n$", r.piece_text) for r in got) and "".join(r.piece_text for r in got) == text


def test_cut_looks_in_the_first_half_too(spark):
    text = "今日は晴れ。" + "終わりのない" * 100
    d = spark.createDataFrame([(1, text)], "id long, t string")
    for overlap in (0, 8):
        got = cutting.cut_texts(d, "id", "t", [(1, 64, overlap)], PATH).orderBy("piece").collect()
        assert got[0].piece_text == "今日は晴れ。" and len(got) > 2 and all(r.n_tokens <= 64 for r in got)


def test_classes():
    k, e, stops = cutting.classify(["あ。い 3.5\n\nう", "a"], PATH)
    assert len(k) == len(e) == stops[-1] and int(e[-1]) == 3 and np.all(np.diff(e[: stops[0]] // 2) > 0)


# queries


def test_too_many_limits_are_an_error(spark, tmp_path):
    from hakari.llm import catalogue

    d = spark.range(1001).selectExpr("id limit_id", "'cut' purpose", "cast(100 as int) max_tokens", "cast(0 as int) overlap_tokens")
    d.write.parquet(str(tmp_path / "a/token_limits.parquet"))
    with pytest.raises(ValueError):
        catalogue._limits(spark, str(tmp_path / "a"), "cut")
    d.where("limit_id < 1000").write.parquet(str(tmp_path / "b/token_limits.parquet"))
    assert len(catalogue._limits(spark, str(tmp_path / "b"), "cut")) == 1000 and catalogue._limits(spark, str(tmp_path / "b"), "pack") == []


@pytest.mark.parametrize("name", sorted(__import__("hakari.llm.catalogue", fromlist=["x"]).QUERIES))
def test_query(spark, small, name):
    from hakari.llm import catalogue

    got = catalogue.QUERIES[name](spark, small).toPandas()
    if name in catalogue.SQL:
        import glob
        import os

        import duckdb

        c = duckdb.connect()
        for f in glob.glob(small + "/*.parquet"):
            c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
        want = c.sql(catalogue.SQL[name]).df()
        cols = sorted(got.columns)
        line = lambda x: sorted(map(str, x[cols].astype(object).where(x[cols].notna(), None).values.tolist()))
        assert cols == sorted(want.columns) and line(got) == line(want)
    elif name.endswith("_found"):
        assert not got.duplicated().any()
