"""Queries over the operators of this package and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.width import digits, strip
from ..operators.skew import salted_join
from ..session import cut, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _survivors(spark: SparkSession, folder: str, drift: float | None) -> DataFrame:
    from . import fusion as u

    rows = table(spark, folder, "work_rows").withColumn("_host", u.url_host(F.col("ウェブサイトURL")))
    host = F.col("_host")
    fields = {
        "ウェブサイトURL": (host, u.good_host(host, u.blocked_hosts(table(spark, folder, "extra_blocked")))),
        "郵便番号": (digits(F.col("郵便番号")), u.good_zip(F.col("郵便番号"))),
        "市区町村": (strip(F.col("市区町村")), u.good_address(F.col("市区町村"))),
    }
    source = F.concat_ws("/", F.coalesce(F.col("名寄せキー種別"), F.lit("")), F.date_format("取込日時", "yyyy-MM"))
    return u.survivors(rows, "レコードID", u.plain_group(F.col("重複グループID")), source, fields, "ウェブサイトURL", drift)


_FOLD = """translate(%s, '！＂＃＄％＆＇（）＊＋，－．／０１２３４５６７８９：；＜＝＞？＠ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ［＼］＾＿｀ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ｛｜｝～　', '!"#$%%&''()*+,-./0123456789:;<=>?@ABCDEFGHIJKLMNOPQRSTUVWXYZ[\\]^_`abcdefghijklmnopqrstuvwxyz{|}~ ')"""
_P1 = rf"""
with w as (select distinct "レコードID" r, upper(trim({_FOLD % '"重複グループID"'})) g, lower(trim({_FOLD % '"ウェブサイトURL"'})) u, regexp_replace({_FOLD % '"郵便番号"'}, '[^0-9]', '', 'g') z, "市区町村" a from work_rows),
b as (select lower(trim(host)) h from extra_blocked where trim(host) <> '' and trim(host) not like '#%'),
h as (select *, regexp_replace(regexp_replace(regexp_replace(regexp_extract(coalesce(u, ''), '^https?://([^/?#\s\\]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '\.+$', '') host from w where regexp_full_match(g, 'G[0-9]{{8}}')),
k as (select r, g, coalesce(regexp_full_match(host, '[^.\s]+(\.[^.\s]+)+') and not exists (select 1 from b where host = b.h or ends_with(host, '.' || b.h)), false) ku,
 coalesce(length(z) = 7 and length(replace(z, substr(z, 1, 1), '')) > 0, false) kz, coalesce(regexp_matches(a, '[\p{{Nd}}〇一二三四五六七八九十]'), false) ka from h where g in (select g from h group by g having count(distinct r) > 1)),
s as (select g, arg_max(r, (ku, r)) s from k group by g),
f as (select k.g, s.s, max((ku, k.r = s.s, k.r)) mu, max((kz, k.r = s.s, k.r)) mz, max((ka, k.r = s.s, k.r)) ma from k join s on k.g = s.g group by k.g, s.s)
select g as dup_group_id, '代表' as field, s as record_id from f union all select g, 'ウェブサイトURL', mu[3] from f where mu[1] union all select g, '郵便番号', mz[3] from f where mz[1] union all select g, '市区町村', ma[3] from f where ma[1]
"""


@query(_P1)
def p1_found(spark, folder):
    return _survivors(spark, folder, None).select("dup_group_id", "field", "record_id")


@query()
def p1_fused(spark, folder):
    return _survivors(spark, folder, 0.0).select("dup_group_id", "field", "record_id", F.round("score", 4).alias("score"))


@query()
def p2_found(spark, folder):
    from . import skeleton as u

    return u.look_alike_pairs(table(spark, folder, "work_rows"), "レコードID", ["会社名", "正規化名"])


def _classes(members: DataFrame, keys: list[str], record: str) -> DataFrame:
    """members (a row a record) with the size of their class."""
    m = cut(members.distinct())
    return salted_join(m, m.groupBy(*keys).agg(F.count_distinct(record).alias("n_records")), keys)


@query()
def p2_consistent(spark, folder):
    """Each record's one consistent form of each field, with how many records share it."""
    from . import skeleton as u

    m = u.same_look(table(spark, folder, "work_rows"), "レコードID", ["会社名", "正規化名"])
    return _classes(m.select("field", "skeleton", F.col("record").alias("record_id")), ["field", "skeleton"], "record_id")


_P5 = r"""
with f as (select "レコードID" r, lower(translate("ウェブサイトURL", '！＂＃＄％＆＇（）＊＋，－．／０１２３４５６７８９：；＜＝＞？＠ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ［＼］＾＿｀ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ｛｜｝～　', '!"#$%&''()*+,-./0123456789:;<=>?@ABCDEFGHIJKLMNOPQRSTUVWXYZ[\]^_`abcdefghijklmnopqrstuvwxyz{|}~ ')) u from output_rows),
p as (select r, unnest(regexp_split_to_array(u, '[\s、，,;|<>()"'']+')) x from f),
h as (select r, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '^[a-z][a-z0-9+.\-]*:/+', ''), '[/?#\\].*$', ''), '^.*@|:[0-9]*$', '', 'g'), '\.+$', ''), '^www\.', '') host from p),
c as (select host, count(*) n, count(distinct r) k from h where regexp_full_match(host, '[\w\-]+(\.[\w\-]+)+') group by host)
"""


@query(_P5 + "select host, case when k = 1 then 'rare' else 'common' end as mark from c where k = 1 or k >= 20")
def p5_found(spark, folder):
    from . import terms as u

    counts = u.frequencies(table(spark, folder, "output_rows"), "レコードID", u.hosts(F.col("ウェブサイトURL")))
    return u.marked(counts).where("mark is not null").select(F.col("term").alias("host"), "mark")


@query(_P5 + "select host, n as occurrences, k as records, case when k = 1 then 'rare' when k >= 20 then 'common' end as mark from c")
def p5_counts(spark, folder):
    from . import terms as u

    counts = u.frequencies(table(spark, folder, "output_rows"), "レコードID", u.hosts(F.col("ウェブサイトURL")))
    return u.marked(counts).withColumnRenamed("term", "host")


def _limits(spark: SparkSession, folder: str, purpose: str) -> list[tuple[int, int, int]]:
    """The rule rows of one purpose; a table of limits is a handful of rows kept by hand. It is counted first."""
    rows = table(spark, folder, "token_limits").where(F.col("purpose") == purpose).orderBy("limit_id").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError(f"more than 1000 limits to {purpose}: no rule table")
    return [(r.limit_id, r.max_tokens, r.overlap_tokens) for r in rows]


@query()
def p7_pack(spark, folder):
    from . import packing as u
    from . import tokens

    sizes = u.token_counts(table(spark, folder, "documents"), "doc_id", "text", tokens.default_path())
    return u.pack(sizes, [(i, m) for i, m, _ in _limits(spark, folder, "pack")]).withColumnRenamed("doc", "doc_id")


@query("""select limit_id, max_tokens::bigint as capacity, (select count(*) from documents where doc_id is not null) as n_docs, 0::bigint as n_overfull, 0::bigint as n_needless_cuts, 0::bigint as n_incomplete from token_limits where purpose = 'pack'""")
def p7_checked(spark, folder):
    """What must hold of p7_pack, limit by limit: every document is there whole, none that fits is divided, no container
    holds more than its capacity."""
    from . import packing as u
    from . import tokens

    sizes = cut(u.token_counts(table(spark, folder, "documents"), "doc_id", "text", tokens.default_path()))
    limits = _limits(spark, folder, "pack")
    placed = cut(u.pack(sizes, [(i, m) for i, m, _ in limits]))
    caps = spark.createDataFrame([(i, m) for i, m, _ in limits], "limit_id long, capacity long")
    loads = placed.groupBy("limit_id", "container").agg(F.sum("n_tokens").alias("load")).join(F.broadcast(caps), "limit_id").groupBy("limit_id").agg(F.count_if(F.col("load") > F.col("capacity")).alias("n_overfull"))
    docs = placed.groupBy("limit_id", "doc").agg(F.sum("n_tokens").alias("size"), F.count("*").alias("parts")).join(sizes, "doc").join(F.broadcast(caps), "limit_id")
    docs = docs.groupBy("limit_id", "capacity").agg(F.count("*").alias("n_docs"), F.count_if((F.col("n_tokens") <= F.col("capacity")) & (F.col("parts") > 1)).alias("n_needless_cuts"), F.count_if(F.col("size") != F.col("n_tokens")).alias("n_incomplete"))
    return docs.join(loads, "limit_id").select("limit_id", "capacity", "n_docs", "n_overfull", "n_needless_cuts", "n_incomplete")


@query()
def p8_found(spark, folder):
    from . import leaks as u

    return u.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"), "doc_id", "text", "item_id", "text").select("item_id", "doc_id")


@query()
def p9_cut(spark, folder):
    from . import cutting as u
    from . import tokens

    return u.cut_texts(table(spark, folder, "documents"), "doc_id", "text", _limits(spark, folder, "cut"), tokens.default_path())


@query("""select limit_id, 0::bigint as n_too_long, 0::bigint as n_gaps, 0::bigint as n_short_overlaps, 0::bigint as n_unlike from token_limits where purpose = 'cut'""")
def p9_checked(spark, folder):
    """What must hold of p9_cut, limit by limit: no piece is longer than the limit, each begins where the piece before it ends
    or earlier by the overlap at least, and its text is that stretch of the document's bytes."""
    from . import cutting as u
    from . import tokens

    limits = _limits(spark, folder, "cut")
    docs = table(spark, folder, "documents")
    p = u.cut_texts(docs, "doc_id", "text", limits, tokens.default_path())
    p = p.withColumn("to_byte", F.col("from_byte") + F.octet_length("piece_text")).join(docs.select("doc_id", F.col("text").cast("binary").alias("raw")), "doc_id")
    unlike = F.expr("cast(substring(raw, int(from_byte) + 1, int(to_byte - from_byte)) as string)") != F.col("piece_text")
    p = cut(p.select("limit_id", "doc_id", "piece", "from_byte", "to_byte", "n_tokens", unlike.alias("unlike"), F.octet_length("raw").alias("size")))
    before = p.select("limit_id", "doc_id", (F.col("piece") + 1).alias("piece"), F.col("to_byte").alias("ended"))
    x = p.join(before, ["limit_id", "doc_id", "piece"], "full").join(F.broadcast(spark.createDataFrame(limits, "limit_id long, most int, overlap int")), "limit_id")
    last = F.col("from_byte").isNull()
    whole = p.groupBy("limit_id", "doc_id").agg(F.max("to_byte").alias("end"), F.max("size").alias("size")).groupBy("limit_id").agg(F.count_if(F.col("end") != F.col("size")).alias("cut_off"))
    begins = F.when(last, False).when(F.col("piece") == 0, F.col("from_byte") != 0).when(F.col("overlap") == 0, F.col("from_byte") != F.col("ended")).otherwise(F.col("from_byte") > F.col("ended"))
    short = ~last & (F.col("piece") > 0) & (F.col("overlap") > 0) & (F.col("from_byte") >= F.col("ended"))
    x = x.groupBy("limit_id").agg(F.count_if(F.col("n_tokens") > F.col("most")).alias("n_too_long"), F.count_if(begins).alias("gaps"), F.count_if(short).alias("n_short_overlaps"), F.count_if("unlike").alias("n_unlike"))
    return x.join(whole, "limit_id").select("limit_id", "n_too_long", (F.col("gaps") + F.col("cut_off")).alias("n_gaps"), "n_short_overlaps", "n_unlike")


def _addresses(spark: SparkSession, folder: str, both: bool = True) -> DataFrame:
    from .places import zip_code

    pref = lambda c: F.when(strip(F.col(c)) != "", strip(F.col(c)))
    w = table(spark, folder, "work_rows").select(F.col("レコードID").alias("record"), F.col("市区町村").alias("addr"), zip_code(F.col("郵便番号")).alias("zip"), pref("都道府県／地域").alias("pref"))
    p = table(spark, folder, "prepared_rows").select(F.col("レコードID").alias("record"), F.col("住所").alias("addr"), zip_code(F.col("郵便番号")).alias("zip"), pref("都道府県").alias("pref"))
    return w.unionByName(p) if both else w


@query()
def p3_found(spark, folder):
    from . import places as u

    return u.same_place_pairs(u.places(_addresses(spark, folder)))


@query()
def p3_places(spark, folder):
    from . import places as u

    return _classes(u.places(_addresses(spark, folder)).select(F.col("record").alias("record_id"), "place"), ["place"], "record_id")


def code10(c):
    """A facility code of ten digits; nine have lost a leading zero; else null."""
    d = digits(c)
    return F.when(F.length(d) == 10, d).when(F.length(d) == 9, F.concat(F.lit("0"), d))


def with_own_host(rows: DataFrame, blocked: list[str], url: str = "host") -> DataFrame:
    """rows whose column `url` became the host where that can be a facility's own, without www.; else null."""
    from . import fusion as u

    rows = rows.withColumn(url, u.url_host(F.col(url)))
    return rows.withColumn(url, F.when(u.good_host(F.col(url), blocked), F.regexp_replace(url, r"^www\.", "")))


def _entities(spark: SparkSession, folder: str) -> DataFrame:
    from . import fusion, places, variants

    rows = table(spark, folder, "work_rows")
    blocked = fusion.blocked_hosts(table(spark, folder, "extra_blocked"))
    at = places.places(_addresses(spark, folder, both=False)).groupBy("record").agg(F.min("place").alias("place"))
    r = rows.select(F.col("レコードID").alias("record"), F.col("会社名").alias("name"), code10(F.col("医療機関コード（正）")).alias("code"), fusion.plain_group(F.col("重複グループID")).alias("grp"), F.col("ウェブサイトURL").alias("host")).distinct()
    r = with_own_host(r, blocked)
    own = r.where("host is not null").groupBy("host").agg(F.count_distinct("code").alias("n")).where("n < 2").select("host", F.lit(True).alias("own"))
    r = r.join(own, "host", "left").withColumn("host", F.when(F.col("own"), F.col("host"))).drop("own")
    return variants.entities(r.join(at, "record", "left"), {"code": True, "grp": True, "place": False, "host": False})


@query()
def p4_found(spark, folder):
    from . import variants as u

    return u.variant_pairs(_entities(spark, folder))


@query()
def p4_entities(spark, folder):
    return _classes(_entities(spark, folder).select(F.col("record").alias("record_id"), "entity"), ["entity"], "record_id")


def _two_sources(spark: SparkSession, folder: str) -> DataFrame:
    from . import fusion

    blocked = fusion.blocked_hosts(table(spark, folder, "extra_blocked"))

    def phone(c):
        d = digits(F.regexp_replace(F.col(c), r"内線.*$|(?i)ext.*$", ""))
        d = F.when((F.length(d) >= 11) & d.startswith("81"), F.concat(F.lit("0"), F.regexp_replace(d, "^810?", ""))).otherwise(d)
        return F.when(F.length(d).between(9, 11), d)

    def code(c):
        d = digits(F.col(c))
        d = F.when(~d.rlike(r"^(\d)\1*$"), d)  # one digit over and over is a filler
        return F.when(F.length(d) == 9, F.concat(F.lit("0"), d)).when(F.length(d).isin(7, 10), d)

    text = lambda c: F.when(strip(F.col(c)) != "", F.col(c))
    p = table(spark, folder, "prepared_rows").select(F.lit(0).alias("side"), F.col("レコードID").alias("id"), text("会社名").alias("name"), text("住所").alias("addr"), text("都道府県").alias("pref"), phone("電話番号").alias("phone"), code("医療機関コード").alias("code"), F.col("ウェブサイトURL").alias("host"))
    o = table(spark, folder, "opendata_rows").select(F.lit(1).alias("side"), F.col("施設番号").alias("id"), text("医療機関名").alias("name"), text("所在地").alias("addr"), text("都道府県名").alias("pref"), phone("電話").alias("phone"), code("医療機関番号").alias("code"), F.col("ホームページ").alias("host"))
    return with_own_host(p.unionByName(o), blocked)


@query()
def p6_found(spark, folder):
    from . import matching as u

    return u.matches(_two_sources(spark, folder)).select(F.col("a").alias("record_id"), F.col("b").alias("facility_no")).distinct()


@query()
def p6_links(spark, folder):
    from . import matching as u

    return u.matches(_two_sources(spark, folder)).groupBy(F.col("a").alias("record_id"), F.col("b").alias("facility_no")).agg(F.round(F.max("confidence"), 4).alias("confidence"))
