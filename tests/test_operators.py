"""Operators on small tables, with nulls, ties, repeated and empty rows."""

import json

import pytest
from pyspark.sql import functions as F

from hakari import rules
from hakari.operators import details, enrich, files, incremental, report, resolve, verify
from hakari.operators.components import components
from hakari.sources import files as S
from hakari.sources import web
from hakari.streaming import resume


def rows(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=str)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (300, 300), (None, 1), (7, 7)]
    got = dict(rows(components(spark.createDataFrame(links, "a long, b long")), "node", "component"))
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    star = spark.range(500).selectExpr("id + 1 as a", "cast(0 as long) as b")
    assert components(star).where("component = 0").count() == 501


def test_numbered_and_parts(spark):
    d = spark.range(1000).withColumn("k", F.format_string("%04d", F.col("id")))
    assert rows(resolve.numbered(d, ["k"]).where("n <> id + 1"), "id") == []
    p = files.row_parts(d, ["k"], 300)
    assert rows(p.groupBy("part").count(), "part", "count") == [(0, 300), (1, 300), (2, 300), (3, 100)]
    assert resolve.numbered(d.where("false"), ["k"]).count() == 0


def test_duplicate_groups(spark):
    d = spark.createDataFrame([("A", "1", "5", "u", 0), ("A", "1", "9", "", 1), ("A", "2", "x", None, 2), ("B", "1", "3", "u", 3), ("B", "1", "3", "u", 4)], "kind string, key string, rid string, url string, ord int")
    got = rows(resolve.duplicate_groups(d, "kind", "key", "rid", "url", "ord"), "ord", "dup_gid", "is_rep")
    assert got == [(0, "G000001", "1"), (1, "G000001", ""), (2, "", "1"), (3, "G000003", "1"), (4, "G000003", "")]
    early = rows(resolve.duplicate_groups_early(d, "kind", "key", "rid", "url", "ord"), "ord", "dup_gid", "is_rep")
    twins = spark.createDataFrame([("A", "1", "5", "u")] * 3 + [("B", "1", None, None)] * 2, "kind string, key string, rid string, url string")
    assert rows(resolve.duplicate_groups(twins, "kind", "key", "rid", "url").where("is_rep = '1'"), "kind") == [("A",), ("B",)]
    assert early[0] == (0, "G000001", "代表") and early[2] == (2, "G000002", "代表") and early[4] == (4, "G000003", "重複")
    assert resolve.duplicate_groups(d.where("false"), "kind", "key", "rid", "url").count() == 0


def test_collision_flags(spark):
    d = spark.createDataFrame([(1, "n", "1", "a"), (2, "n", "", "a"), (3, "m", "1", "a"), (4, None, None, None), (5, None, None, None)], "i int, n string, z string, a string")
    assert rows(resolve.collision_flags(d, "n", "z", "a"), "i", "warn") == [(1, "同名別施設あり／同一住所に別施設あり"), (2, "同名別施設あり"), (3, "同一住所に別施設あり"), (4, "同名別施設あり"), (5, "同名別施設あり")]


def test_fallback_join(spark):
    left = spark.createDataFrame([(1, "a", "x"), (2, "", "x"), (3, "q", "y"), (4, None, None)], "i int, k1 string, k2 string")
    right = spark.createDataFrame([("a", "x", "r1", 1), ("a", "x", "r2", 2), ("", "y", "r3", 3), ("b", "", "r4", 4)], "r1 string, r2 string, v string, o int")
    got = enrich.fallback_join(left, right, [(F.col("k1"), F.col("r1"), True), (F.col("k2"), F.col("r2"), False)], [F.col("o")], ["v"])
    assert rows(got.select("i", F.col("hit.v").alias("v")), "i", "v") == [(1, "r2"), (2, "r1"), (3, "r3"), (4, None)]


def test_fill_and_outcomes(spark):
    w = spark.createDataFrame([(1, "", "0123456789", ""), (2, "http://own", "", ""), (3, "　", "", "0312345678"), (4, None, None, None)], "rid int, url string, code string, phone string")
    o = spark.createDataFrame([("http://a", "0123456789", "", 1), ("http://b", "0123456789", "0312345678", 2), ("ftp://c", "", "", 3)], "url string, code string, phone string, o int")
    f = enrich.fill_urls(w, o, order=[F.col("o")])
    assert rows(f, "rid", "url", "url_source") == [(1, "http://a", "オープンデータ"), (2, "http://own", "元データ"), (3, "http://b", "オープンデータ"), (4, "", "")]
    assert enrich.fill_stats(f).first().asDict() == {"n_rows": 4, "n_already": 1, "n_filled": 2, "n_left": 1}
    h = spark.createDataFrame([(1, "u", None), (2, "", ("v", "高")), (3, "", ("v", "低")), (4, "", ("v", "?")), (5, "", None)], "i int, url string, hit struct<url: string, conf: string>")
    got = enrich.outcomes(h, F.col("url"), F.lit("x"), F.col("hit"), F.col("hit.conf"), F.col("hit.url"))
    assert rows(got, "i", "confidence", "outcome", "final_url") == [(1, "高", "元データ", "u"), (2, "高", "高", "v"), (3, "低", "低", ""), (4, "未検出", "未検出", ""), (5, "未処理", "未処理", "")]


def test_backfill(spark):
    base = spark.createDataFrame([(1, "c", "n"), (2, "d", "m"), (3, "d", "k")], "rid int, code string, na string")
    lost = spark.createDataFrame([("", "c", "n"), (None, "d", "m"), ("9", "c", "n"), (None, "", "zz")], "rid string, code string, na string")
    got = resolve.backfill_unique(lost, base, [(F.col("code"), F.col("code")), (F.col("na"), F.col("na"))], "rid", "rid")
    assert rows(got, "code", "rid") == [("", None), ("c", "1"), ("c", "9"), ("d", "2")]


def test_verify(spark):
    recs = spark.createDataFrame([("r", "医療法人山田医院", "甲市二丁目6番1号", "03-1234-5678"), ("s", "無名", "", ""), ("t", "田中医院", "甲市1-2", None)], "record string, name string, addr string, phone string")
    cands = spark.createDataFrame([("r", 0, "http://indeed.com/"), ("r", 1, "http://b"), ("r", 2, "http://c"), ("t", 0, "http://b")], "record string, idx int, url string")
    pages = spark.createDataFrame([("http://b", "<p>山田医院 甲市</p>"), ("http://c", "<p>山田医院 甲市 2-6-1 ０３-1234-5678</p>"), ("http://indeed.com/", "<p>03-1234-5678</p>")], "url string, html string")
    got = rows(verify.judge(recs, cands, pages), "record", "url", "confidence", "reason")
    assert got == [("r", "http://c", "高", "電話一致・番地一致・施設名一致・市区町村一致（スコア8）"), ("s", rules.NOT_FOUND, "未検出", "候補0件すべて照合不一致"), ("t", rules.NOT_FOUND, "未検出", "候補1件すべて照合不一致（最有力 http://b）")]
    hits = spark.createDataFrame([([("http://indeed.com", "", ""), ("", "", ""), ("http://a", "", "")],)], "h array<struct<url: string, title: string, snippet: string>>")
    assert [x.url for x in hits.select(verify.candidates(F.col("h")).alias("h")).first().h] == ["http://a"]
    e = spark.createDataFrame([(0, 2, 5), (1, 2, 5), (0, 4, 9), (0, 2, 2)], "idx int, p int, q int")
    s = lambda c: F.struct(F.col(c).alias("points"), F.array().cast("array<string>").alias("reasons"))
    assert [r.x.points for r in e.select(verify.with_subpage(s("p"), s("q"), F.col("idx")).alias("x")).collect()] == [5, 2, 4, 2]


def test_judge_scores_every_text(spark, monkeypatch):
    """The best text of a URL counts, in parts or whole, and as evidence() has it for each pair of record and text."""
    import random

    from hakari.functions import html
    from hakari.functions import text as T

    rnd = random.Random(5)
    cities, families = ["甲市", "乙市北区", "丙町"], ["山田", "田中", "鈴木", "佐藤", "高橋"]
    name = lambda: rnd.choice(["医療法人", "", "Ｄｒ．"]) + rnd.choice(families) + rnd.choice(["医院", "眼科", ""])
    lot = lambda: "-".join(str(rnd.randrange(1, 15)) for _ in range(rnd.randrange(4)))
    recs = [(i, name(), rnd.choice(cities) + lot(), rnd.choice([None, "", f"03-1234-567{rnd.randrange(4)}"])) for i in range(60)] + [(99, None, None, None)]
    cands = [(r[0], k, u) for r in recs for k, u in enumerate(rnd.sample(["http://a", "http://b", "http://c", "http://none"], 2))]
    texts = [(rnd.choice(["http://a", "http://b", "http://c"]), f"<p>{name()} {rnd.choice(cities)}{lot()}</p>" + rnd.choice(["", "０３-1234-567" + str(rnd.randrange(4))]) + "長い文。" * rnd.randrange(9)) for _ in range(80)]
    pages = spark.createDataFrame(texts + texts[:5] + [("http://a", ""), ("http://a", None)], "url string, html string")
    r, c = spark.createDataFrame(recs, "record long, name string, addr string, phone string"), spark.createDataFrame(cands, "record long, idx int, url string")
    f = r.withColumn("_a", T.nfkc(F.col("addr"))).join(c, "record").join(pages.withColumn("page", html.page_text(F.col("html"))), "url")
    e = verify.evidence(T.phone_digits(T.nfkc(F.col("phone"))), T.address_numbers(F.col("_a")), T.name_key(T.nfkc(F.col("name"))), T.name_key(T.city_part(F.col("_a"))), F.col("page"), T.name_key(F.col("page")))
    most = {(x.record, x.url): x.p for x in f.groupBy("record", "url").agg(F.max(e["points"]).alias("p")).collect()}
    want = {}
    for i, *_ in recs:
        mine = [(most[i, u], k, u) for _, k, u in sorted(x for x in cands if x[0] == i) if (i, u) in most]
        p, _, u = next((x for x in mine if x[0] >= rules.HIGH), max(mine, key=lambda x: (x[0], -x[1]), default=(0, 0, "")))
        want[i] = (u if p >= rules.LOW else rules.NOT_FOUND, "高" if p >= 4 else {3: "中", 2: "低"}.get(p, "未検出"), p)
    assert len({x[1] for x in want.values()}) >= 3
    for chars, many in ((1_000_000, 5_000), (100, 7)):
        monkeypatch.setattr(verify, "PART_CHARS", chars)
        monkeypatch.setattr(verify, "PART_RECORDS", many)
        got = {x.record: x for x in verify.judge(r, c, pages).collect()}
        assert {i: (x.url, x.confidence) for i, x in got.items()} == {i: w[:2] for i, w in want.items()}
        assert all(f"スコア{w[2]}" in got[i].reason for i, w in want.items() if w[2] >= rules.LOW)


def test_best_candidate_against_a_loop(spark):
    import random

    rnd = random.Random(3)
    data = [(g, i, rnd.randrange(9)) for g in range(60) for i in range(rnd.randrange(1, 7))]
    got = dict((r.g, (r.idx, r.pts)) for r in verify.best_candidate(spark.createDataFrame(data, "g int, idx int, pts int"), "g", "idx", "pts", ["idx"]).collect())
    for g in {x[0] for x in data}:
        best = None
        for _, i, p in sorted(x for x in data if x[0] == g):
            if best is None or p > best[1]:
                best = (i, p)
            if p >= rules.HIGH:
                break
        assert got[g] == best


def test_details(spark):
    raw = spark.createDataFrame([("1", "山田内科", ["月 | 9:00〜12:00"], ["休診日: 日曜・祝日"], ([], [], [])), ("2", "駅前", None, None, None), ("3", "眼科", [], [], (["皮膚科"], ["呼吸器内科", "皮膚科"], []))], "record string, name string, tables array<string>, context array<string>, found struct<title: array<string>, section: array<string>, nav: array<string>>")
    raw = raw.withColumn("found", F.coalesce("found", F.expr("named_struct('title', array(), 'section', array(), 'nav', array())").cast(raw.schema["found"].dataType)))
    d = {r.record: r for r in details.details(raw).collect()}
    assert (d["1"]["診療時間（整形）"], d["1"]["休診日"], d["1"]["時間帯1終了"], d["1"]["診療科目の出所"]) == ("09:00-12:00　休診: 日曜・祝日", "日曜・祝日", "12:00", "施設名")
    assert (d["2"]["診療科目"], d["2"]["診療時間（整形）"], d["2"]["診療科目数"]) == ("", "", 0)
    assert (d["3"]["診療科目"], d["3"]["基本領域"], d["3"]["診療科目の出所"]) == ("皮膚科・呼吸器内科", "皮膚科;内科", "見出し+診療科目欄")
    c = details.coverage(details.details(raw)).first()
    assert (c.n, c.n_parsed, c.n_dept, c.share_parsed) == (3, 1, 2, pytest.approx(1 / 3))
    assert details.coverage(details.details(raw.where("false"))).first().share_parsed is None


def test_crm(spark):
    d = spark.createDataFrame([("1", "u", ""), ("", "u", ""), ("2", " ", None), ("3", None, "日曜")], "`レコードID` string, `ウェブサイトURL` string, `休診日` string")
    got = details.crm_rows(d, rules.CRM_COLUMNS)
    assert got.columns == ["レコードID", *[c for c, _ in rules.CRM_COLUMNS]] and rows(got, "レコードID", "休診日") == [("1", ""), ("3", "日曜")]
    assert rows(details.fill_counts(got, ["休診日", "診療科目"]), "column", "n") == [("休診日", 1), ("診療科目", 0)]
    with pytest.raises(ValueError):
        details.crm_rows(d.drop("レコードID"), rules.CRM_COLUMNS)


def test_incremental(spark):
    d = spark.createDataFrame([("1", "", "a"), ("2", "u", "b"), ("3", None, "c")], "k string, url string, name string")
    assert rows(incremental.todo(d, spark.createDataFrame([("1",), ("1",)], "k string"), F.col("k"), F.col("k"), "url"), "k") == [("3",)]
    assert rows(incremental.todo(d, d.where("false"), F.col("k"), F.col("k"), "url", 1, F.col("k")), "k") == [("1",)]
    v = spark.createDataFrame([("1", "http://bad"), ("2", "（未検出）bad"), ("3", None), ("4", "http://good")], "k string, url string")
    keep, drop = incremental.invalidated(v, F.col("url"), F.col("url").contains("bad"))
    assert (rows(keep, "k"), rows(drop, "k")) == ([("2",), ("3",), ("4",)], [("1",)])
    assert rows(incremental.surviving(d, F.col("k"), keep, F.col("k")), "k") == [("2",), ("3",)]
    a = spark.createDataFrame([("p.example", f"n{i}", "x") for i in range(20)] + [("p.example", "n1", "y"), ("q.example", "n", "x"), ("", "n", "x")], "host string, name string, pref string")
    find = lambda x: incremental.portal_hosts(x, F.col("host"), F.col("name"), F.col("pref"), F.lit(False), 20)
    assert rows(find(a), "host", "n_names", "n_prefs", "examples") == [("p.example", 20, 2, ["n0", "n1", "n10"])]
    loop = incremental.feedback(a, spark.createDataFrame([("1", "p.example"), ("2", "z")], "rid string, url string"), spark.createDataFrame([("1",), ("2",)], "rid string"), ["old"], {"url": "url", "record": "rid"}, lambda hosts: F.col("url").isin(hosts), find)
    assert rows(loop["verified"], "rid") == rows(loop["details"], "rid") == [("2",)] and rows(loop["extra"], "host") == [("old",), ("p.example",)]


def test_report(spark):
    d = spark.createDataFrame([(i, "a" if i < 6 else "b" if i < 8 else None, f"n{i}") for i in range(10)], "i int, v string, n string")
    assert rows(report.top_values(d, F.col("v"), "v"), "v", "n") == [("a", 6)]
    assert rows(report.shared_values(d, F.col("v"), F.col("n"), F.col("i"), "v"), "v", "n", "examples") == [("a", 6, ["n0", "n1", "n2"])]
    assert report.sample_of(d, 3).collect() == report.sample_of(d.orderBy(F.desc("i")), 3).collect()
    u = files.union_lists([d, d.drop("v")])
    assert u.count() == 20 and u.where("list_id = 2 and v is null").count() == 10


def test_files(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_bytes("﻿レコードID,会社名,住所\n1,\"山\n\"\"田\",\n".encode())
    got = S.logical(S.read_csv(spark, str(p)))
    assert got.first().asDict() == {"record_id": "1", "name": '山\n"田', "code": "", "zip": "", "pref": "", "addr": "", "url": "", "phone": ""}
    (tmp_path / "b.csv").write_bytes("機関コード,ホームページ,電話\n123456789,http://a.jp,03-1234-5678\n1,mail@x,\n2,http://indeed.com/,\n".encode("cp932"))
    (tmp_path / "c.csv").write_text("x,y\n1,2\n", encoding="utf-8")
    o = S.read_open_data(spark, [str(tmp_path / "b.csv"), str(tmp_path / "c.csv")])
    assert rows(o, "code", "phone", "url") == [("0123456789", "0312345678", "http://a.jp")]
    with pytest.raises(ValueError):
        S.logical(spark.createDataFrame([("1",)], "x string"))
    S.write_csv(spark.createDataFrame([("a", None), ("", 'q"')], "x string, y string").coalesce(1), str(tmp_path / "out"))
    assert next((tmp_path / "out").glob("*.csv")).read_text() == 'x,y\na,\n,"q"""\n'
    assert S.with_bom(S.with_bom(b"x")) == b"\xef\xbb\xbfx"
    (tmp_path / "h.txt").write_text("# c\nA.example\n\n b.example \n")
    assert rows(S.read_hosts(spark, str(tmp_path / "h.txt")), "host") == [("a.example",), ("b.example",)]
    (tmp_path / "j.jsonl").write_text(json.dumps({"a": 1}) + "\n{bad\n")
    from pyspark.sql.types import LongType, StructField, StructType

    shape = StructType([StructField("a", LongType())])
    assert [r.a for r in S.read_json_lines(spark, str(tmp_path / "j.jsonl"), shape).collect()] == [1]
    t = str(tmp_path / "t")
    spark.range(3).write.parquet(t)
    S.swap(spark.read.parquet(t).where("id > 0"), t)
    assert rows(spark.read.parquet(t), "id") == [(1,), (2,)]


def test_web(spark):
    calls, waits = [], []

    def busy(q):
        calls.append(q)
        if len(calls) < 3:
            raise web.Refused(429)
        return [{"url": "u", "title": "", "snippet": ""}]

    assert web.retried(busy, "q", wait=waits.append)[0]["url"] == "u" and waits == [2.0, 4.0]
    with pytest.raises(web.Refused):
        web.retried(lambda q: (_ for _ in ()).throw(web.Refused(403)), "q", wait=waits.append)
    assert web.answer("brave", {"web": {"results": [{"url": "a", "description": "d"}]}}) == [{"url": "a", "title": "", "snippet": "d"}] and web.answer("serper", {}) == []
    q = spark.createDataFrame([("k", "x")], "key string, query string")
    assert web.search_all(q, lambda s: [{"url": s, "title": "", "snippet": ""}], 1000).first().hits[0].url == "x"
    u = spark.createDataFrame([("http://a/1",), ("http://a/2",), (None,), ("http://a/1",)], "url string")
    got = web.fetch_all(u, lambda x: 1 / 0 if x.endswith("2") else "page", delay=0)
    assert rows(got, "url", "html") == [("http://a/1", "page"), ("http://a/2", "")]
    assert rows(web.from_snapshot(u, spark.createDataFrame([("http://a/1", "p")], "url string, html string")), "url", "html") == [("http://a/1", "p"), ("http://a/2", "")]


def test_stream_resumes(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    handle = lambda df: df.withColumn("done", F.lit(True))

    def go():
        s = spark.readStream.schema("k string").parquet(src)
        resume.run_once_per_key(s, F.col("k"), handle, out, str(tmp_path / "cp")).awaitTermination()

    spark.createDataFrame([("a",), ("b",), ("a",)], "k string").coalesce(1).write.parquet(src)
    go()
    spark.createDataFrame([("b",), ("c",)], "k string").coalesce(1).write.mode("append").parquet(src)
    go()
    go()
    assert rows(spark.read.parquet(out), "k") == [("a",), ("b",), ("c",)]


def test_report_repair_and_markers(spark, tmp_path):
    d = spark.createDataFrame([("A", "1", "x", 1), ("A", "1", None, 2), ("A", "2", "y", 3), (None, None, "n", 4), (None, None, "m", 5)], "kind string, key string, name string, o int")
    assert rows(resolve.duplicate_report(d, "kind", "key", "name", "o"), "kind", "n", "o", "name") == [("", 2, 4, "n"), ("", 2, 5, "m"), ("A", 2, 1, "x"), ("A", 2, 2, "")]
    base = spark.createDataFrame([("1", "c", "n"), ("2", "d", "m"), ("3", "d", "k")], "rid string, code string, na string")
    lost = spark.createDataFrame([(None, "c", "n"), (None, "d", "m"), (None, "", "zz"), ("7", "", "")], "rid string, code string, na string")
    got = resolve.repaired(lost, lost, lost, base, "rid", "code", "na")
    assert [rows(got[k], "rid") for k in ("found", "verified", "details")] == [[("1",), ("2",), ("7",)], [("1",), ("7",)], [("1",), ("7",)]]
    made = []
    make = lambda: made.append(1) or spark.range(2)
    for _ in range(2):
        assert S.unless_there(spark, str(tmp_path / "m"), make).count() == 2
    assert made == [1]
    S.write_hosts(spark.createDataFrame([("b.example",), ("a.example",)], "host string"), str(tmp_path / "h"), "hosts")
    assert rows(S.read_hosts(spark, str(tmp_path / "h")), "host") == [("a.example",), ("b.example",)]


def test_skewed_joins_lose_and_add_nothing(spark):
    from hakari.operators.skew import hot_keys, salted_join

    left = spark.range(900).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 50)) k", "id v", "if(id % 7 = 0, null, id) w")
    right = spark.range(60).selectExpr("if(id = 0, 'hot', concat('k', id)) k", "id r").unionByName(spark.sql("select 'hot' k, -1L r"))
    for how in ("inner", "left", "left_semi"):
        want = sorted(map(str, left.join(right, ["k"], how).collect()))
        assert sorted(map(str, salted_join(left, right, ["k"], how, least=100, parts=10).collect())) == want
    assert rows(hot_keys(left, ["k"], 100, 10), "k", "_salts") == [("hot", 3)]
    assert hot_keys(left, ["k"]) is None and hot_keys(left, ["k"], 300, 10) is None


def test_hot_keys_are_the_same_when_spots_are_counted_first(spark):
    from hakari.operators.skew import hot_keys

    d = spark.range(900).selectExpr("if(id % 3 = 0, 'hot', if(id % 3 = 1, 'warm', concat('k', id))) k")
    for spots in (1, 2, 64):
        assert rows(hot_keys(d, ["k"], 100, 10, spots=spots), "k", "_salts") == rows(hot_keys(d, ["k"], 100, 10), "k", "_salts") == [("hot", 3), ("warm", 3)]
        assert hot_keys(d, ["k"], 300, 10, spots=spots) is None and hot_keys(d.where("false"), ["k"], 0, spots=spots) is None


def test_subpages_hours_and_errors(spark, monkeypatch):
    recs = spark.createDataFrame([(1, "山田眼科", "甲市1-2-3", "0312345678"), (2, "森内科", None, None)], "record long, name string, addr string, phone string")
    cands = spark.createDataFrame([(1, 0, "http://a.example/"), (2, 0, "http://b.example/")], "record long, idx int, url string")
    pages = spark.createDataFrame([("http://a.example/", "山田眼科 <a href='/access.html'>x</a><a href='jikan.html'>y</a>"), ("http://a.example/access.html", "電話 03-1234-5678"), ("http://a.example/jikan.html", "診療時間 月曜 9:00〜12:00"), ("http://b.example/", "別")], "url string, html string")
    got = {r.record: r for r in verify.judge(recs, cands, pages).collect()}
    assert (got[1].url, got[1].confidence) == ("http://a.example/", "高") and "下層ページで確認" in got[1].reason
    assert (got[2].url, got[2].confidence) == (rules.NOT_FOUND, "未検出")
    hours = verify.hours_found(verify.judge(recs, cands, pages), pages).collect()
    assert [(r.record, bool(r.hours.context)) for r in hours] == [(1, True)] or hours[0].source in ("", "http://a.example/jikan.html")

    def broken(texts, recs):
        raise ValueError("no page")

    monkeypatch.setattr(verify, "_best_codes", broken)
    assert {r.reason for r in verify.judge(recs, cands, pages).collect()} == {"照合エラー: no page"}


def test_merged_details(spark):
    audit = spark.createDataFrame([("1", "c", "u"), ("2", "d", "v"), ("", "", "w"), ("9", "c", "x")], ["レコードID", "医療機関コード（正）", "ウェブサイトURL"])
    det = spark.createDataFrame([("1", "z", "h1", 1), ("1", "z", "h2", 2), ("5", "d", "h3", 3), ("6", "c", None, 4)], ["レコードID", "医療機関コード", "休診日", "o"])
    got = enrich.merge_details(audit, det.withColumnRenamed("医療機関コード", "医療機関コード（正）"), "レコードID", ["医療機関コード", "医療機関コード（正）"], [F.col("o")])
    assert rows(got, "レコードID", "休診日", "hit") == [("", "", False), ("1", "h2", True), ("2", "h3", True), ("9", "", True)]
    assert rows(enrich.hit_rate(got), "n", "n_hit", "share") == [(4, 3, 0.75)] and enrich.hit_rate(got.where("false")).first().share is None
    assert enrich.without_columns(audit, ["ウェブサイトURL", "none"]).columns == ["レコードID", "医療機関コード（正）"]


def test_requests_robots_settings():
    keys = {"SERPER_API_KEY": "a", "GOOGLE_API_KEY": "b", "GOOGLE_CSE_ID": "c", "BRAVE_API_KEY": "d"}
    sent = []
    bodies = {"serper": {"organic": [{"link": "u"}]}, "google_cse": {"items": [{"link": "u"}]}, "brave": {"web": {"results": [{"url": "u"}]}}}
    for p, body in bodies.items():
        assert web.provider_search(p, keys, lambda r, body=body: sent.append(r) or (200, body))("q") == [{"url": "u", "title": "", "snippet": ""}]
        with pytest.raises(web.Refused):
            web.provider_search(p, keys, lambda r: (403, {}))("q")
    assert sent[0]["json"]["q"] == "q" and sent[1]["params"]["cx"] == "c" and sent[2]["headers"] == {"X-Subscription-Token": "d"}
    with pytest.raises(KeyError):
        web.request("brave", "q", {})
    asked = []
    ok = web.robots(lambda u: asked.append(u) or (200, "User-agent: *\nDisallow: /x"))
    assert [ok("http://a/x"), ok("http://a/y"), ok("http://b/x")] == [False, True, False] and len(asked) == 2
    assert web.robots(lambda u: 1 / 0)("http://a/x") and web.robots(lambda u: (404, ""))("http://a/x")
    s = web.Settings.from_env({"SEARCH_QPS": "10", "SEARCH_PROVIDER": "brave", "OTHER": "1"})
    assert (s.search_qps, s.search_provider, s.search_concurrency) == (10.0, "brave", 8)
    with pytest.raises(ValueError):
        web.Settings.from_env({"SEARCH_PROVIDER": "none"})


def test_header_lines_and_marks(spark, tmp_path):
    d = spark.createDataFrame([("a", "b"), ("1", "2"), ("a", "2")], "a string, b string")
    assert rows(files.union_lists([d, d]), "a", "b", "list_id") == [("1", "2", 1), ("1", "2", 2), ("a", "2", 1), ("a", "2", 2)]
    S.write_csv(d.coalesce(1), str(tmp_path / "x"), bom=True)
    import glob

    assert open(glob.glob(str(tmp_path / "x/*.csv"))[0], "rb").read().startswith(b"\xef\xbb\xbfa,b\n")
    assert S.read_csv(spark, str(tmp_path / "x")).columns == ["a", "b"]
