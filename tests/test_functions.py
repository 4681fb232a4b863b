"""Table-driven cases of the column functions."""

import pytest
from pyspark.sql import functions as F

from hakari.functions import clock, departments, html, text, url
from hakari.functions.width import digits, narrow, strip


def values(spark, rows, f):
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{j} string" for j in range(len(rows[0]))))
    return [r[0] for r in d.select(f(*[F.col(f"c{j}") for j in range(len(rows[0]))]).alias("v"), "i").orderBy("i").collect()]


def check(spark, f, cases):
    got = values(spark, [c[0] if isinstance(c[0], tuple) else (c[0],) for c in cases], f)
    assert got == [c[1] for c in cases]


def test_width(spark):
    check(spark, narrow, [("Ａ１　－", "A1 -"), (None, None), ("", ""), ("漢字", "漢字")])
    check(spark, strip, [("　 a ", "a"), ("", ""), (None, None), ("a b", "a b")])
    check(spark, digits, [("１-2三", "12"), (None, None)])


def test_codes_and_zip(spark):
    check(spark, text.facility_code, [("123456789", "0123456789"), ("1", "0000000001"), ("12345678901", "12345678901"), ("", ""), (None, ""), ("01-2345-678", "0012345678")])
    check(spark, text.zip_shown, [("1120013", "112-0013"), (" 112 ", "112"), (None, ""), ("〒112-0013", "112-0013")])
    check(spark, text.zip_digits, [("112-00134", "1120013"), (None, "")])


def test_phone(spark):
    check(spark, lambda c: text.phone_digits(text.nfkc(c)), [("810467468610", "0467468610"), ("+81 (0)46-746-8610", "0467468610"), ("０４６７-46-8610", "0467468610"), ("81", "81"), (None, "")])


def test_names(spark):
    check(spark, lambda c: text.name_key(text.nfkc(c)), [("医療法人社団 ＡＢＣ・クリニック", "abcクリニック"), ("(医)山田　医院", "医山田医院"), ("リハビリテーション", "リハビリテション"), (None, ""), ("医療法人", "")])


@pytest.mark.parametrize("said,number", [("二十三", "23"), ("十", "10"), ("一二三", "123"), ("二〇", "20"), ("十二", "12"), ("零", "0")])
def test_numeral(said, number):
    assert text.numeral(said) == number


def test_addresses(spark):
    f = lambda c: text.city_part(text.nfkc(c))
    check(spark, f, [("羽村市本町1", "羽村市"), ("甲市乙区丙町2", "甲市乙区"), ("四日市市諏訪", "四日市"), ("港区芝3", "港区"), ("なにもない", "なにもない"), (None, "")])
    g = lambda c: text.address_numbers(text.nfkc(c))
    check(spark, g, [("甲市二丁目6番1号", ["2", "6", "1"]), ("甲市三崎町５－４－３－２－１", ["5", "4", "3", "2"]), ("", []), (None, [])])
    check(spark, lambda c: text.city_part_early(text.nfkc(c)), [("羽村市本町1", "羽村"), ("甲市乙区丙町2", "甲市乙区"), ("丙町2", "丙町"), (None, "")])
    check(spark, lambda n, a: text.search_query(text.nfkc(n), text.nfkc(a)), [((" 山田医院 ", "甲市乙1"), "山田医院 甲市 公式サイト")])


def test_row_and_duplicate_keys(spark):
    check(spark, text.row_key, [((" 7 ", "c", "n", "a"), "R:7"), (("", "c", "n", "a"), "C:c"), ((None, None, "n", "a"), "N:n|a"), ((None, None, None, None), "N:|")])
    f = lambda *c: F.to_json(text.duplicate_key(*c))
    k = lambda a, b: f'{{"kind":"{a}","key":"{b}"}}'
    check(spark, f, [(("0123456789", "0312345678", "1", "n", "p"), k("CODE", "0123456789")), (("", "031234567", "1", "n", "p"), k("PHONE", "031234567")), (("", "", "1", "n", "p"), k("ZIP+NAME", "1:n")), (("", "", "", "n", None), k("PREF+NAME", ":n")), ((None, None, None, None, None), k("PREF+NAME", ":"))])
    early = lambda *c: F.to_json(text.duplicate_key_early(*c))
    check(spark, early, [(("123456789", "1", "n", "p"), k("CODE", "123456789")), (("12345678", "1", "n", "p"), k("ZIP+NAME", "1:n")), (("", "", "n", "p"), k("PREF+NAME", "p:n"))])


def test_urls(spark):
    check(spark, url.host, [("https://A.jp:80/x", "a.jp"), ("HTTPS://x", "https"), ("", ""), (None, ""), ("a.jp/x", "a.jp")])
    check(spark, url.blocked, [("https://www.indeed.com/a", True), ("https://notindeed.com", False), ("http://x-med.or.jp/", True), ("http://a.mhlw.go.jp", True), ("http://doctormap.example", True), ("http://own.example", False), (None, False)])
    check(spark, lambda u: url.blocked(u, ["own.example"]), [("http://own.example/a", True), ("http://sub.own.example/a", False)])
    check(spark, url.blocked_for, [(("http://city.x.jp", "山田医院"), True), (("http://city.x.jp", "甲市立病院"), False), (("http://a.lg.jp", None), True), (("http://a.jp", None), False)])


def test_times(spark):
    check(spark, clock.clock, [("9:00", "09:00"), ("24時59", "24:59"), ("25:00", ""), ("9時", "09:00"), ("", "")])
    check(spark, clock.time_ranges, [("9:00〜12:30 9:00~12:30 13:00-13:00", ["09:00-12:30"]), ("9時30分〜12時", []), ("", []), ("99:00-10:00 8:30ー12:00", ["08:30-12:00"])])


@pytest.mark.parametrize("said,days", [("土、日", "土曜・日曜"), ("日曜、その他に臨時休診あり", "日曜"), ("1月5日(月)から通常通り診療", ""), ("第2・4土曜", "第2土曜・第4土曜"), ("水曜・日曜", "水曜・日曜"), ("年中無休", "なし"), ("木・土日祝 年末年始", "木曜・土曜・日曜・祝日・年末年始"), (None, ""), ("平日", ""), ("第三火曜", "第3火曜")])
def test_regular_days(spark, said, days):
    assert values(spark, [(said,)], clock.regular_days) == [days]


def test_closed_days(spark):
    check(spark, clock.closed_days, [("診療時間 9:00 休診日：日曜・祝日  電話", "日曜・祝日"), ("土日祝も診療しています", "なし"), ("9時から", "")])


def test_departments(spark):
    f = lambda c: departments.departments(text.nfkc(c))
    check(spark, f, [("呼吸器内科", ["呼吸器内科"]), ("呼吸器内科と呼吸器内科", ["呼吸器内科", "内科"]), ("眼科 内科", ["内科", "眼科"]), ("", []), (None, [])])
    check(spark, lambda c: departments.basic_areas(f(c)), [("呼吸器内科 循環器内科 皮膚科 歯科", ["内科", "皮膚科"]), ("", [])])
    page = "<title>皮膚科</title><h1>小児科</h1><p>診療科目 眼科</p><ul><li>外科</li></ul>"
    got = values(spark, [(page,), (None,)], departments.page_departments)
    assert (got[0].title, got[0].nav) == (["小児科", "皮膚科"], ["外科"]) and "眼科" in got[0].section and got[1].title == []


def test_pages(spark):
    check(spark, html.page_text, [("<b>ａ</b><script>x<y</script>b", " a  b"), (None, "")])
    check(spark, html.hinted_links, [("<a href='/access.html'><a href=\"/x\"><A HREF='ABOUT'>", ["/access.html", "ABOUT"])])
    check(spark, html.subpages, [(("<a href='/access'><a href='/access'><a href='http://o.jp/about'><a href='info'><a href='/about2'>", "http://a.jp/b/"), ["http://a.jp/access", "http://a.jp/b/info"]), (("", None), [])])
    table = "<table><tr><td>月</td><td>9:00-12:00</td></tr></table>"
    assert html.hours_of(table) == (["月 | 9:00-12:00 |"], [])
    assert html.hours_of("<p>診療時間 月 9:00〜12:00</p>")[1] and html.hours_of(None) == ([], []) and html.hours_of("<table>9:00</table>") == ([], [])
    got = values(spark, [(table,), (None,)], html.opening_hours)
    assert got[0].tables == ["月 | 9:00-12:00 |"] and got[1].tables == []


def test_page_or_subpage(spark):
    table = "<table><tr><td>月</td><td>9:00-12:00</td></tr></table>"
    got = values(spark, [(table, table), ("", table), ("", None)], lambda a, b: html.page_or_subpage(html.opening_hours(a), F.lit("own"), F.when(b.isNotNull(), html.opening_hours(b)), F.lit("sub")))
    assert [r.source for r in got] == ["own", "sub", ""]
