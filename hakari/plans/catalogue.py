"""Queries over the core operators and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import clock as C
from ..functions import departments as D
from ..functions import html as H
from ..functions import text as T
from ..functions import url as U
from ..operators import details as DT
from ..operators import enrich as E
from ..operators import files as FL
from ..operators import incremental as I
from ..operators import report as R
from ..operators import resolve as RS
from ..operators import verify as V
from ..functions import width as W
from ..session import scratch, table
from ..sources import files as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
ID, NAME, CODE, ZIP, PREF, ADDR, URL = "レコードID", "会社名", "医療機関コード（正）", "郵便番号", "都道府県／地域", "市区町村", "ウェブサイトURL"


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def work(spark: SparkSession, folder: str) -> DataFrame:
    """The work table in short names, one row a record (deliveries of a record are equal but for the arrival)."""
    c = F.col
    return table(spark, folder, "work_rows").select(c(ID).alias("rid"), c(NAME).alias("name"), c(CODE).alias("code"), c(ZIP).alias("zip"), c(PREF).alias("pref"), c(ADDR).alias("addr"), c(URL).alias("url"), c("正規化名").alias("norm"), c("重複グループID").alias("gid"), c("名寄せキー種別").alias("kind")).distinct()


_W = f"""w as (select distinct "{ID}" rid, "{NAME}" "name", "{CODE}" code, "{ZIP}" zip, "{PREF}" pref, "{ADDR}" addr, "{URL}" url, "正規化名" norm, "重複グループID" gid, "名寄せキー種別" kind from work_rows)"""
_D = lambda c: f"regexp_replace(coalesce({c},''), '[^\\p{{Nd}}]', '', 'g')"
_CODE10 = lambda c: f"case when length({_D(c)}) between 1 and 10 then lpad({_D(c)}, 10, '0') else {_D(c)} end"
_STRIP = lambda c: f"regexp_replace(coalesce({c},''), '^[\\s\\x{{3000}}\\x{{a0}}]+|[\\s\\x{{3000}}\\x{{a0}}]+$', '', 'g')"
_HOST = lambda c: f"split_part(lower(split_part(regexp_replace(coalesce({c},''), '^https?://', ''), '/', 1)), ':', 1)"
_LIST = lambda xs: ", ".join(f"'{x}'" for x in xs)


def _blocked_sql(c: str) -> str:
    h = _HOST(c)
    ends = " or ".join(f"ends_with({h}, '{s}')" for s in rules.BLOCKED_SUFFIXES)
    words = " or ".join(f"contains({h}, '{w}')" for w in rules.BLOCKED_WORDS)
    doms = " or ".join(f"{h} = '{d}' or ends_with({h}, '.{d}')" for d in rules.BLOCKED_DOMAINS)
    return f"({ends} or {words} or {doms})"


@query(f"with {_W} select rid, {_CODE10('code')} as code10, {_D('code')} as digits from w")
def code_pad(spark, folder):
    return work(spark, folder).select("rid", T.facility_code(F.col("code")).alias("code10"), T.only_digits(F.col("code")).alias("digits"))


@query(f"with {_W} select rid, substr({_D('zip')}, 1, 7) as zip7, case when length({_D('zip')}) = 7 then substr({_D('zip')},1,3) || '-' || substr({_D('zip')},4,4) else {_STRIP('zip')} end as shown from w")
def zip_format(spark, folder):
    return work(spark, folder).select("rid", T.zip_digits(F.col("zip")).alias("zip7"), T.zip_shown(F.col("zip")).alias("shown"))


_PH = "regexp_replace(translate(coalesce(\"電話番号\",''), '０１２３４５６７８９', '0123456789'), '[^0-9]', '', 'g')"


@query(f"""with p as (select distinct "{ID}" rid, {_PH} d from prepared_rows) select rid, case when starts_with(d,'81') and length(d) >= 11 then case when substr(d,3,1) = '0' then substr(d,3) else '0' || substr(d,3) end else d end as phone from p""")
def phone_digits(spark, folder):
    p = table(spark, folder, "prepared_rows")
    return p.select(F.col(ID).alias("rid"), T.phone_digits(T.nfkc(F.col("電話番号"))).alias("phone")).distinct()


@query(f"with {_W} select rid, {_HOST('url')} as host, {_blocked_sql('url')} as blocked from w")
def url_hosts(spark, folder):
    return work(spark, folder).select("rid", U.host(F.col("url")).alias("host"), U.blocked(F.col("url")).alias("blocked"))


_EXTRA = "(select lower(trim(host)) from extra_blocked where trim(host) <> '' and not starts_with(host, '#'))"


def _blocked_for_sql(url: str, name: str) -> str:
    """The portals, the extra hosts, and municipal hosts unless the name is that of a public facility."""
    h = _HOST(url)
    ends = " or ".join(f"ends_with({h}, '{x}')" for x in rules.PUBLIC_SUFFIXES)
    return f"({_blocked_sql(url)} or {h} in {_EXTRA} or (({ends} or regexp_matches({h}, '(^|\\.)({'|'.join(rules.PUBLIC_LABELS)})\\.')) and not regexp_matches(coalesce({name}, ''), '{'|'.join(rules.PUBLIC_WORDS)}')))"


@query(f"with {_W} select rid, {_blocked_for_sql('url', 'name')} as blocked from w")
def blocked_for_name(spark, folder):
    x = _extra(spark, folder)
    return work(spark, folder).select("rid", U.blocked_for(F.col("url"), F.col("name"), x).alias("blocked"))


@query()
def name_keys(spark, folder):
    return work(spark, folder).select("rid", T.name_key(T.nfkc(F.col("name"))).alias("name_key"))


@query()
def address_parts(spark, folder):
    w = work(spark, folder).withColumn("f", T.nfkc(F.col("addr")))
    return w.select("rid", T.city_part(F.col("f")).alias("city"), T.address_numbers(F.col("f")).alias("numbers"), T.search_query(T.nfkc(F.col("name")), F.col("f")).alias("query"))


_KEY = f"""k as (select *, {_CODE10('code')} c10, substr({_D('zip')},1,7) z from w),
d as (select *, case when length(c10) = 10 then 'CODE' when z <> '' and coalesce(norm,'') <> '' then 'ZIP+NAME' else 'PREF+NAME' end key_kind,
 case when length(c10) = 10 then c10 when z <> '' and coalesce(norm,'') <> '' then z || ':' || norm else coalesce(pref,'') || ':' || coalesce(norm,'') end "key" from k)"""


def keyed(spark: SparkSession, folder: str) -> DataFrame:
    """The work table with its duplicate key; it has no telephone."""
    k = T.duplicate_key(T.facility_code(F.col("code")), F.lit(""), T.zip_digits(F.col("zip")), F.col("norm"), F.col("pref"))
    return work(spark, folder).withColumn("_d", k).select("*", F.col("_d.kind").alias("key_kind"), F.col("_d.key").alias("key")).drop("_d")


@query(f"with {_W}, {_KEY} select rid, key_kind, \"key\" from d")
def dedup_key_tiers(spark, folder):
    return keyed(spark, folder).select("rid", "key_kind", "key")


_GROUPS = f"""g as (select key_kind, "key", count(*) n, row_number() over (order by key_kind, "key") pos from d group by 1, 2),
r as (select d.*, n, pos, row_number() over (partition by d.key_kind, d."key" order by ({_STRIP('url')} = ''), rid desc) rn from d join g on d.key_kind = g.key_kind and d."key" = g."key"),
q as (select *, case when n > 1 then 'G' || lpad(pos::varchar, greatest(6, length(pos::varchar))::int, '0') else '' end dup_gid, case when rn = 1 then '1' else '' end is_rep from r)"""


@query(f"with {_W}, {_KEY}, {_GROUPS} select rid, dup_gid, is_rep from q")
def dedup_groups(spark, folder):
    return RS.duplicate_groups(keyed(spark, folder), "key_kind", "key", "rid", "url").select("rid", "dup_gid", "is_rep")


@query(f"""with {_W}, k as (select *, {_D('code')} c, {_D('zip')} z from w),
d as (select *, case when length(c) >= 9 then 'CODE' when z <> '' and coalesce(norm,'') <> '' then 'ZIP+NAME' else 'PREF+NAME' end kk,
 case when length(c) >= 9 then c when z <> '' and coalesce(norm,'') <> '' then z || ':' || norm else coalesce(pref,'') || ':' || coalesce(norm,'') end ky from k),
g as (select kk, ky, row_number() over (order by min(rid)) pos from d group by 1, 2)
select rid, 'G' || lpad(pos::varchar, greatest(6, length(pos::varchar))::int, '0') as dup_gid, case when row_number() over (partition by d.kk, d.ky order by ({_STRIP('url')} = ''), rid desc) = 1 then '代表' else '重複' end as is_rep from d join g using (kk, ky)""")
def dedup_groups_early(spark, folder):
    w = work(spark, folder)
    k = T.duplicate_key_early(T.only_digits(F.col("code")), T.only_digits(F.col("zip")), F.col("norm"), F.col("pref"))
    w = w.withColumn("_d", k).select("*", F.col("_d.kind").alias("kk"), F.col("_d.key").alias("ky"))
    return RS.duplicate_groups_early(w, "kk", "ky", "rid", "url", "rid").select("rid", "dup_gid", "is_rep")


@query(f"""with {_W}, {_KEY}, g as (select key_kind, "key", count(*) n from d group by 1, 2 having count(*) > 1)
select key_kind, "key", n, rid, coalesce(name,'') as name from d join g using (key_kind, "key")""")
def duplicate_report(spark, folder):
    return RS.duplicate_report(keyed(spark, folder), "key_kind", "key", "name", "rid")


_FLAGS = f"""f as (select *, count(*) over (partition by norm) cn, count(*) over (partition by substr({_D('zip')},1,7), coalesce(addr,'')) ca, substr({_D('zip')},1,7) z7 from %s),
fl as (select *, concat_ws('／', case when cn > 1 then '同名別施設あり' end, case when z7 <> '' and ca > 1 then '同一住所に別施設あり' end) warn from f)"""


def flagged(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("_z7", T.zip_digits(F.col("zip"))).withColumn("_addr", F.coalesce("addr", F.lit("")))
    return RS.collision_flags(rows, "norm", "_z7", "_addr").drop("_z7", "_addr")


@query(f"with {_W}, {_FLAGS % 'w'} select rid, warn from fl")
def collision_flags(spark, folder):
    return flagged(work(spark, folder)).select("rid", "warn")


@query(f"""with {_W}, {_KEY}, {_GROUPS}, {_FLAGS % 'q'}
select count(*) n_rows, count(distinct nullif(dup_gid,'')) n_groups, count(*) filter (dup_gid <> '') n_group_rows, count(*) filter (coalesce(url,'') <> '') n_url, count(*) filter (contains(warn,'同名')) n_same_name, count(*) filter (contains(warn,'同一住所')) n_same_addr from fl""")
def prepare_stats(spark, folder):
    return RS.prepare_stats(flagged(RS.duplicate_groups(keyed(spark, folder), "key_kind", "key", "rid", "url")))


@query(f"with {_W} select rid, case when rid is not null then 'R:' || rid else '' end as row_key from w")
def row_keys(spark, folder):
    return work(spark, folder).select("rid", T.row_key(F.col("rid").cast("string"), F.col("code"), F.col("name"), F.col("addr")).alias("row_key"))


def _extra(spark: SparkSession, folder: str) -> list[str]:
    """The hosts of the rule table kept by hand, which is counted first."""
    h = table(spark, folder, "extra_blocked").select(F.lower(F.trim("host")).alias("h")).where("h <> '' and not h like '#%'").distinct().limit(20_001).collect()
    if len(h) > 20_000:
        raise ValueError("too many extra hosts for a rule table")
    return sorted(r.h for r in h)


_OPEN = f"""o as (select "施設番号" ord, {_CODE10('"医療機関番号"')} c, regexp_replace(translate(coalesce("電話",''), '０１２３４５６７８９', '0123456789'), '[^0-9]', '', 'g') p0, {_STRIP('"ホームページ"')} u from opendata_rows),
o2 as (select *, case when starts_with(p0,'81') and length(p0) >= 11 then case when substr(p0,3,1)='0' then substr(p0,3) else '0' || substr(p0,3) end else p0 end p from o where starts_with(lower(u),'http') and not {_blocked_sql('u')}),
bc as (select c, arg_min(u, ord) u from o2 where length(c) = 10 group by c), bp as (select p, arg_min(u, ord) u from o2 where length(p) >= 9 group by p),
t as (select distinct "{ID}" rid, {_STRIP('"医療機関コード"')} code, {_PH} d, coalesce("ウェブサイトURL",'') url from prepared_rows),
t2 as (select *, case when starts_with(d,'81') and length(d) >= 11 then case when substr(d,3,1)='0' then substr(d,3) else '0' || substr(d,3) end else d end ph from t),
j as (select rid, case when {_STRIP('url')} <> '' then url else coalesce(bc.u, bp.u, '') end url, case when {_STRIP('url')} <> '' then '元データ' when coalesce(bc.u, bp.u) is not null then 'オープンデータ' else '' end url_source
 from t2 left join bc on t2.code <> '' and t2.code = bc.c left join bp on t2.ph <> '' and t2.ph = bp.p)"""


def filled(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    o = table(spark, folder, "opendata_rows").select(c("施設番号").alias("ord"), T.facility_code(c("医療機関番号")).alias("code"), T.phone_digits(T.nfkc(c("電話"))).alias("phone"), T.blank(c("ホームページ")).alias("url"))
    o = o.where(~U.blocked(c("url")))
    p = table(spark, folder, "prepared_rows").select(c(ID).alias("rid"), T.blank(c("医療機関コード")).alias("code"), T.phone_digits(T.nfkc(c("電話番号"))).alias("phone"), F.coalesce(c(URL), F.lit("")).alias("url")).distinct()
    return E.fill_urls(p, o, order=[c("ord")])


@query(f"with {_OPEN} select rid, url, url_source from j")
def opendata_fill(spark, folder):
    return filled(spark, folder).select("rid", "url", "url_source")


@query(f"with {_OPEN} select count(*) n_rows, count(*) filter (url_source = '元データ') n_already, count(*) filter (url_source = 'オープンデータ') n_filled, count(*) filter (url_source = '') n_left from j")
def fill_stats(spark, folder):
    return E.fill_stats(filled(spark, folder))


_HIT = f"""v as (select "{ID}"::varchar rid, {_STRIP('"' + CODE + '"')} code, coalesce("{URL}",'') u, "URL確度" conf, "判定根拠" why, "出力日時" ord from output_rows),
vr as (select rid, max_by(row(u, conf, why), row(ord, u)) h from v group by rid),
vc as (select code, min_by(row(u, conf, why), row(ord, u)) h from v where code <> '' group by code),
x as (select w.rid, coalesce(w.url,'') url, coalesce(vr.h, vc.h) h from w left join vr on w.rid::varchar = vr.rid left join vc on {_STRIP('w.code')} <> '' and {_STRIP('w.code')} = vc.code),
y as (select rid, case when {_STRIP('url')} <> '' then '高' when h is null then '未処理' when h[2] in ('高','中','低') then h[2] else '未検出' end confidence, case when {_STRIP('url')} <> '' then '元データ' when h is null then '未処理' when h[2] in ('高','中','低') then h[2] else '未検出' end outcome, case when {_STRIP('url')} <> '' then url when h is not null and h[2] = '高' then h[1] else '' end final_url from x)"""


def judged(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    v = table(spark, folder, "output_rows").select(c(ID).cast("string").alias("v_rid"), T.blank(c(CODE)).alias("v_code"), F.coalesce(c(URL), F.lit("")).alias("v_url"), c("URL確度").alias("v_conf"), c("判定根拠").alias("v_why"), c("出力日時").alias("v_at"))
    keys = [(c("rid").cast("string"), c("v_rid"), True), (T.blank(c("code")), c("v_code"), False)]
    j = E.fallback_join(work(spark, folder), v, keys, [c("v_at"), c("v_url")], ["v_url", "v_conf", "v_why"])
    return E.outcomes(j, F.coalesce(c("url"), F.lit("")), F.lit("元データ"), c("hit"), c("hit.v_conf"), c("hit.v_url"))


@query(f"with {_W}, {_HIT} select rid, confidence, outcome, final_url from y")
def verified_join(spark, folder):
    return judged(spark, folder).select("rid", "confidence", "outcome", "final_url")


@query(f"with {_W}, {_HIT} select outcome, count(*) n from y group by outcome")
def outcome_histogram(spark, folder):
    return E.histogram(judged(spark, folder), "outcome")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """What became of each record of the work table, counted."""
    return outcome_histogram(spark, folder)


@query(f"with {_W} select rid from w where {_STRIP('url')} = '' and rid not in (select \"{ID}\" from output_rows)")
def resume_anti(spark, folder):
    done = table(spark, folder, "output_rows")
    return I.todo(work(spark, folder), done, F.col("rid"), F.col(ID), "url").select("rid")


@query(f"with {_W} select rid from w where {_STRIP('url')} = '' and rid not in (select \"{ID}\" from output_rows) order by rid limit 50")
def next_batch(spark, folder):
    done = table(spark, folder, "output_rows")
    return I.todo(work(spark, folder), done, F.col("rid"), F.col(ID), "url", 50, F.col("rid")).select("rid")


_V = f"""v as (select distinct "{ID}" rid, "{URL}" url, "{NAME}" nm, {_STRIP('"' + URL + '"')} u from output_rows), dr as (select * from v where u <> '' and not starts_with(u,'（') and {_blocked_for_sql('u', 'nm')})"""


def _recheck(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    v = table(spark, folder, "output_rows").select(F.col(ID).alias("rid"), F.col(URL).alias("url"), F.col(NAME).alias("name")).distinct()
    return I.invalidated(v, F.col("url"), U.blocked_for(T.blank(F.col("url")), F.col("name"), _extra(spark, folder)))


@query(f"with {_V} select rid, url from v except all select rid, url from dr")
def recheck_kept(spark, folder):
    return _recheck(spark, folder)[0].select("rid", "url")


@query(f"with {_V} select rid, url from dr")
def recheck_dropped(spark, folder):
    return _recheck(spark, folder)[1].select("rid", "url")


@query(f"with {_W}, {_V} select w.rid from w where w.rid not in (select rid from dr)")
def dropped_details_anti(spark, folder):
    w = work(spark, folder)
    return I.without(w, F.col("rid"), _recheck(spark, folder)[1], F.col("rid")).select("rid")


@query(f"with {_W} select w.rid from w where w.rid in (select \"{ID}\" from output_rows)")
def surviving_semi(spark, folder):
    w = work(spark, folder)
    return I.surviving(w, F.col("rid").cast("string"), table(spark, folder, "output_rows"), F.col(ID).cast("string")).select("rid")


@query(f"""with {_W}, one as (select {_STRIP('code')} c, any_value(rid) r from w where {_STRIP('code')} <> '' group by 1 having count(*) = 1),
na as (select coalesce(name,'') || '|' || coalesce(addr,'') k, any_value(rid) r from w where coalesce(name,'') || '|' || coalesce(addr,'') <> '' group by 1 having count(*) = 1),
o as (select distinct {_STRIP('"' + CODE + '"')} c, coalesce("{NAME}",'') || '|' || coalesce("{ADDR}",'') k from output_rows)
select o.c as code, o.k as name_addr, coalesce(one.r, na.r)::varchar as rid from o left join one on o.c <> '' and o.c = one.c left join na on o.k = na.k""")
def unique_backfill(spark, folder):
    c, empty = F.col, F.lit("")
    na = F.concat(F.coalesce(c("name"), empty), F.lit("|"), F.coalesce(c("addr"), empty))
    lost = table(spark, folder, "output_rows").select(T.blank(c(CODE)).alias("code"), F.concat(F.coalesce(c(NAME), empty), F.lit("|"), F.coalesce(c(ADDR), empty)).alias("name_addr"), F.lit(None).cast("string").alias("rid")).distinct()
    base = work(spark, folder)
    return RS.backfill_unique(lost, base, [(c("code"), T.blank(c("code"))), (c("name_addr"), na)], "rid", "rid").select("code", "name_addr", "rid")


@query("""select coalesce(nullif(trim("URL確度"),''),'（空）') as confidence, count(*) n from output_rows group by 1""")
def qa_confidence(spark, folder):
    c = F.trim(F.coalesce("URL確度", F.lit("")))
    return table(spark, folder, "output_rows").groupBy(F.when(c == "", "（空）").otherwise(c).alias("confidence")).agg(F.count("*").alias("n"))


_HIGH = f"""h as (select *, {_HOST('"' + URL + '"')} hst from output_rows where trim("URL確度") = '高' and {_STRIP('"' + URL + '"')} <> '')"""


def _high(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "output_rows")
    return d.where((F.trim("URL確度") == "高") & (T.blank(F.col(URL)) != ""))


@query(f"with {_HIGH} select * from (select hst as host, count(*) n from h where hst <> '' group by 1 order by n desc, host limit 30) where n >= 5")
def qa_top_hosts(spark, folder):
    return R.top_values(_high(spark, folder), U.host(F.col(URL)), "host")


@query(f"""with {_HIGH}, s as (select "{URL}" url, count(*) n from h group by 1 having count(*) >= 2 order by n desc, url limit 10),
e as (select "{URL}" url, "{NAME}" nm, row_number() over (partition by "{URL}" order by "{ID}", "出力日時") k from h)
select s.url, s.n, string_agg(e.nm, ' / ' order by k) filter (k <= 3) as examples from s join e using (url) group by s.url, s.n""")
def qa_shared_urls(spark, folder):
    return R.shared_values(_high(spark, folder), F.col(URL), F.col(NAME), F.struct(F.col(ID), F.col("出力日時")), "url", least=2).withColumn("examples", F.array_join("examples", " / "))


@query(f"""with {_HIGH} select "{ID}" rid, "{URL}" url from h where {_blocked_for_sql('"' + URL + '"', '"' + NAME + '"')}""")
def qa_blocked_high(spark, folder):
    return R.violations(_high(spark, folder), U.blocked_for(F.col(URL), F.col(NAME), _extra(spark, folder))).select(F.col(ID).alias("rid"), F.col(URL).alias("url"))


@query("""select count(*) n, count(*) filter (coalesce("ウェブサイトURL",'') <> '') n_url, count(*) filter (coalesce("郵便番号",'') <> '') n_zip, count(*) filter (coalesce("市区町村",'') <> '') n_addr from output_rows""")
def qa_coverage(spark, folder):
    return R.coverage(table(spark, folder, "output_rows"), {"n_url": URL, "n_zip": ZIP, "n_addr": ADDR})


@query(f"""with {_HIGH}, b as (select hst host, coalesce("{NAME}",'') nm, coalesce("{PREF}",'') pf from h where hst <> '' and not {_blocked_sql('"' + URL + '"')}),
g as (select host, count(distinct nm) n_names, count(distinct pf) n_prefs from b group by 1 having count(distinct nm) >= 20),
x as (select host, nm, row_number() over (partition by host order by nm) k from (select distinct host, nm from b))
select g.host, n_names, n_prefs, string_agg(nm, ' / ' order by nm) filter (k <= 3) as examples from g join x using (host) group by all""")
def portal_hosts(spark, folder):
    return I.portal_hosts(_high(spark, folder), U.host(F.col(URL)), F.col(NAME), F.col(PREF), U.blocked(F.col(URL)), rules.PORTAL_LEAST).withColumn("examples", F.array_join("examples", " / "))


@query(f"""select {_STRIP('"' + ID + '"::varchar')} as "{ID}", {_STRIP('"' + URL + '"')} as "ウェブサイトURL", {_STRIP('"' + ADDR + '"')} as "住所", '' as "休診日" from output_rows
where {_STRIP('"' + URL + '"')} <> '' or {_STRIP('"' + ADDR + '"')} <> ''""")
def crm_rows(spark, folder):
    return DT.crm_rows(table(spark, folder, "output_rows"), [("ウェブサイトURL", URL), ("住所", ADDR), ("休診日", "休診日")])


@query(f"""select '{URL}' as "column", count(*) filter (coalesce("{URL}",'') <> '') as n from work_rows union all select '{CODE}', count(*) filter (coalesce("{CODE}",'') <> '') from work_rows union all select '{ADDR}', count(*) filter (coalesce("{ADDR}",'') <> '') from work_rows""")
def crm_fill_counts(spark, folder):
    return DT.fill_counts(table(spark, folder, "work_rows"), [URL, CODE, ADDR])


@query(f"""select part, count(*) n, min(rid) lo, max(rid) hi from (select "{ID}" rid, (row_number() over (order by "{ID}", "取込日時") - 1) // 1000 part from work_rows) group by part""")
def row_parts(spark, folder):
    w = table(spark, folder, "work_rows").select(F.col(ID).alias("rid"), F.col("取込日時").alias("at"))
    return FL.row_parts(w, ["rid", "at"], 1000).groupBy("part").agg(F.count("*").alias("n"), F.min("rid").alias("lo"), F.max("rid").alias("hi"))


@query(f"""select "{ID}" rid, "{NAME}" as name from work_rows order by "{ID}", "取込日時" limit 100""")
def head_records(spark, folder):
    return FL.head(table(spark, folder, "work_rows"), [F.col(ID), F.col("取込日時")], 100).select(F.col(ID).alias("rid"), F.col(NAME).alias("name"))


@query(f"""select list_id, count(*) n, count(distinct rid) n_records from (select 1 list_id, "{ID}" rid from work_rows union all select 2, "{ID}" from prepared_rows) group by 1""")
def union_lists(spark, folder):
    lists = [table(spark, folder, t).select(F.col(ID).alias("rid")) for t in ("work_rows", "prepared_rows")]
    return FL.union_lists(lists).groupBy("list_id").agg(F.count("*").alias("n"), F.count_distinct("rid").alias("n_records"))


@query(f"""with f as (select {_STRIP('"' + CODE + '"')} c, max_by(row("{URL}", "URL確度", "判定根拠"), row("出力日時", coalesce("{URL}",''))) h from output_rows group by 1),
{_W}, j as (select rid, w.url, h, regexp_replace(coalesce(h[1],''), '^[（）() ]+|[（）() ]+$', '', 'g') s from w left join f on {_STRIP('w.code')} = f.c)
select rid, case when h is null or s in ('未検出','未調査') then url else h[1] end as url, case when h is null then '' when s in ('未検出','未調査') then s else h[2] end as confidence from j""")
def merge_early(spark, folder):
    c = F.col
    f = table(spark, folder, "output_rows").groupBy(T.blank(c(CODE)).alias("fc")).agg(F.max_by(F.struct(c(URL).alias("u"), c("URL確度").alias("k")), F.struct("出力日時", F.coalesce(c(URL), F.lit("")))).alias("h"))
    j = work(spark, folder).join(f, T.blank(c("code")) == c("fc"), "left")
    s = F.regexp_replace(F.coalesce("h.u", F.lit("")), "^[（）() ]+|[（）() ]+$", "")
    none = s.isin("未検出", "未調査")
    return j.select("rid", F.when(c("h").isNull() | none, c("url")).otherwise(c("h.u")).alias("url"), F.when(c("h").isNull(), "").when(none, s).otherwise(c("h.k")).alias("confidence"))


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every text of each host as a page of it."""
    return table(spark, folder, "documents").where("host is not null and text is not null").select(F.col("host").alias("url"), F.col("text").alias("html"))


def _judged_records(spark: SparkSession, folder: str) -> DataFrame:
    """(record, name, addr, phone) of both lists, which share no record; work_rows has no telephone."""
    w = work(spark, folder).select(F.col("rid").alias("record"), "name", "addr", F.lit(None).cast("string").alias("phone"))
    p = table(spark, folder, "prepared_rows").select(F.col(ID).alias("record"), F.col(NAME).alias("name"), F.col("住所").alias("addr"), F.col("電話番号").alias("phone"))
    return w.unionByName(p).distinct()


def _judged_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """(record, idx, url): each host that a record's own URL or its output names, once: its own first, then the latest."""
    c, never = F.col, F.lit(None).cast("timestamp")
    own = [table(spark, folder, t).select(c(ID).alias("record"), F.lit(0).alias("src"), never.alias("at"), c(URL).alias("u")) for t in ("work_rows", "prepared_rows")]
    out = table(spark, folder, "output_rows").select(c(ID).alias("record"), F.lit(1).alias("src"), c("出力日時").alias("at"), c(URL).alias("u"))
    named = own[0].unionByName(own[1]).unionByName(out).where("u is not null").select("record", "src", "at", F.posexplode(U.named_hosts(c("u"))).alias("pos", "url"))
    place = F.struct("src", (-F.unix_micros("at")).alias("at"), "pos")
    first = named.groupBy("record", "url").agg(F.min(place).alias("place"))
    return first.select("record", (F.row_number().over(Window.partitionBy("record").orderBy("place", "url")) - 1).alias("idx"), "url")


@query()
def judge_candidates(spark, folder):
    return V.judge(_judged_records(spark, folder), _judged_candidates(spark, folder), _pages(spark, folder), _extra(spark, folder))


_POINTS = """s as (select event_id, user_id, (event_id % 9)::int pts, row_number() over (partition by user_id order by ts, event_id) - 1 idx from events)"""


@query(f"""with {_POINTS} select user_id, event_id, pts as points, case when pts >= 4 then '高' when pts = 3 then '中' when pts = 2 then '低' else '未検出' end as confidence from
(select *, row_number() over (partition by user_id order by case when pts >= 4 then 0 else 1 end, case when pts >= 4 then idx else -pts end, idx) k from s) where k = 1""")
def best_candidate(spark, folder):
    e = table(spark, folder, "events").selectExpr("event_id", "user_id", "cast(event_id % 9 as int) points", "row_number() over (partition by user_id order by ts, event_id) - 1 idx")
    return V.best_candidate(e, "user_id", "idx", "points", ["event_id"]).withColumn("confidence", V.band(F.col("points")))


@query()
def hours_in_documents(spark, folder):
    d = table(spark, folder, "documents").withColumn("f", T.nfkc(F.col("text")))
    return d.select("doc_id", C.time_ranges(F.col("f")).alias("ranges"), C.closed_days(F.col("f")).alias("closed"))


@query()
def departments_in_documents(spark, folder):
    d = table(spark, folder, "documents").where("text is not null").withColumn("names", D.departments(T.nfkc(F.col("text"))))
    return d.select("doc_id", "names", D.basic_areas(F.col("names")).alias("areas"))


@query()
def details_of_documents(spark, folder):
    d = table(spark, folder, "documents").select(F.col("doc_id").alias("record"), F.col("host").alias("name"), H.opening_hours("text").alias("h"), D.page_departments(F.col("text")).alias("found"))
    return DT.details(d.select("record", "name", "h.tables", "h.context", "found")).drop("tables", "context", "found")


@query("""select doc_id, array_to_string(regexp_extract_all(coalesce(text,''), '[0-9]+')[1:4], '-') as runs from documents""")
def digit_runs(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.array_join(F.slice(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([0-9]+)"), 1), 1, 4), "-").alias("runs"))


@query("""select doc_id, len(regexp_extract_all(coalesce(text,''), '(?i)href=[\"'']([^\"'']+)[\"'']', 1)) as n_links from documents""")
def link_counts(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"""(?i)href=["']([^"']+)["']"""), 1)).cast("long").alias("n_links"))


@query(f"""with t as (select 1 list_id, "{ID}" rid, coalesce("{URL}",'') url from work_rows) select count(*) n_target, count(*) filter (url = '') n_todo, (select count(distinct "{ID}") from output_rows) n_done from t""")
def progress(spark, folder):
    w = table(spark, folder, "work_rows").select(F.lit(1).alias("t"), (F.coalesce(F.col(URL), F.lit("")) == "").cast("int").alias("todo"), F.lit(None).cast("long").alias("done"))
    o = table(spark, folder, "output_rows").select(F.lit(0).alias("t"), F.lit(0).alias("todo"), F.col(ID).alias("done"))
    return w.unionByName(o).agg(F.sum("t").alias("n_target"), F.sum("todo").alias("n_todo"), F.count_distinct("done").alias("n_done"))


@query()
def sampled_for_review(spark, folder):
    return R.sample_of(_high(spark, folder).select(F.col(ID).alias("rid"), F.col(URL).alias("url")))


_NARROW = lambda c: "translate(coalesce({},''), '{}', '{}')".format(c, W._WIDE, W._NARROW.replace("'", "''"))
_SPACE = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _name_sql(c: str, legal: list[str]) -> str:
    for w in legal:
        c = f"replace({c}, '{w}', '')"
    noise = rules.NAME_NOISE.replace("\\s", _SPACE[1:-1]).replace("'", "''")
    return f"lower(regexp_replace({c}, '{noise}', '', 'g'))"


@query(f"with {_W} select rid, {_name_sql(_NARROW('name'), rules.LEGAL_FORMS)} as name_key, {_name_sql(_NARROW('name'), T.LEGAL_FORMS_EARLY)} as early from w")
def name_keys_narrow(spark, folder):
    n = W.narrow(F.coalesce("name", F.lit("")))
    return work(spark, folder).select("rid", T.name_key(n).alias("name_key"), T.name_key(n, T.LEGAL_FORMS_EARLY).alias("early"))


_ANY = r"[^\n\r\x{85}\x{2028}\x{2029}]+?"
_FIRST = lambda a, p: f"nullif(regexp_extract({a}, '^({p})', 1), '')"
_CITY = lambda a: "coalesce(" + ", ".join(_FIRST(a, _ANY + x) for x in (f"市{_ANY}区", "市", "区", "町", "村")) + f", substr({a}, 1, 6))"


@query(f"with {_W}, x as (select rid, {_NARROW('addr')} a, {_NARROW('name')} nm from w) select rid, {_CITY('a')} as city, coalesce({_FIRST('a', f'{_ANY}市{_ANY}区|{_ANY}[市区町村]')}, substr(a, 1, 6)) as early, concat_ws(' ', {_STRIP('nm')}, {_CITY('a')}, '公式サイト') as query from x")
def city_parts(spark, folder):
    a, n = W.narrow(F.coalesce("addr", F.lit(""))), W.narrow(F.coalesce("name", F.lit("")))
    return work(spark, folder).select("rid", T.city_part(a).alias("city"), T.city_part_early(a).alias("early"), T.search_query(n, a).alias("query"))


def _clock_sql(c: str) -> str:
    h, m = f"try_cast(regexp_extract({c}, '([0-9]{{1,2}})\\s*[:：時]', 1) as int)", f"coalesce(try_cast(regexp_extract({c}, '[0-9]{{1,2}}\\s*[:：時]\\s*([0-9]{{1,2}})', 1) as int), 0)"
    return f"case when {h} <= 24 and {m} <= 59 then lpad({h}::varchar, 2, '0') || ':' || lpad({m}::varchar, 2, '0') else '' end"


_RANGE = "([0-9]{1,2}\\s*[:：時]\\s*[0-9]{0,2})\\s*[~〜～\\-−–—ー]\\s*([0-9]{1,2}\\s*[:：時]\\s*[0-9]{0,2})"


@query(f"""with d as (select doc_id, {_NARROW('text')} f from documents),
r as (select doc_id, f, regexp_extract_all(f, '{_RANGE}', 1) a, regexp_extract_all(f, '{_RANGE}', 2) b from d),
x as (select doc_id, unnest(a) a, unnest(b) b, generate_subscripts(a, 1) i from r),
y as (select doc_id, i, {_clock_sql('a')} p, {_clock_sql('b')} q from x),
z as (select doc_id, p || '-' || q t, min(i) i from y where p <> '' and q <> '' and p <> q group by 1, 2),
g as (select doc_id, string_agg(t, '|' order by i) ranges from z group by 1)
select d.doc_id, {_clock_sql('f')} as clock, coalesce(ranges, '') as ranges from d left join g on d.doc_id = g.doc_id""")
def times_in_documents(spark, folder):
    d = table(spark, folder, "documents").withColumn("f", W.narrow(F.coalesce("text", F.lit(""))))
    return d.select("doc_id", C.clock(F.col("f")).alias("clock"), F.array_join(C.time_ranges(F.col("f")), "|").alias("ranges"))


@query(f"""with d as (select doc_id, {_NARROW('text')} f from documents), t as (select doc_id, regexp_replace(regexp_extract(f, '(?:休診日?|休み|定休日?)\\s*[:：]?\\s*([^\\n。]{{1,60}})', 1), '^[ |:：・]+|[ |:：・]+$', '', 'g') t from d)
select doc_id, trim(regexp_split_to_array(t, '\\s{{2,}}|\\|')[1]) as phrase from t""")
def closed_phrases(spark, folder):
    return table(spark, folder, "documents").select("doc_id", C.closed_phrase(W.narrow(F.coalesce("text", F.lit("")))).alias("phrase"))


def _departments_sql(source: str) -> str:
    """The names taken out one after another, longest first; each masked where it first stands."""
    parts = [f"n0 as ({source})"]
    for i, w in enumerate(D.NAMES):
        parts.append(f"n{i + 1} as (select rid, regexp_replace(t, '{w}', '{D._MASK * len(w)}') t, case when contains(t, '{w}') then list_append(f, '{w}') else f end f from n{i})")
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in rules.BASIC_AREA.items() if v)
    areas = f"list_filter(list_transform(f, lambda x: map {{{pairs}}}[x]), lambda x: x is not null)"
    return f"with {', '.join(parts)}, z as (select rid, f, {areas} a from n{len(D.NAMES)}) select rid, array_to_string(f, '・') as names, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), ';') as areas from z"


@query(_departments_sql(f"""select distinct "{ID}" rid, {_NARROW('"' + NAME + '"')} t, []::varchar[] f from work_rows"""))
def departments_in_names(spark, folder):
    d = table(spark, folder, "work_rows").select(F.col(ID).alias("rid"), D.departments(W.narrow(F.coalesce(NAME, F.lit("")))).alias("f")).distinct()
    return d.select("rid", F.array_join("f", "・").alias("names"), F.array_join(D.basic_areas(F.col("f")), ";").alias("areas"))


@query(f"""select {_STRIP('"' + ID + '"::varchar')} as record_id, {_STRIP('"' + NAME + '"')} as name, {_STRIP('"' + CODE + '"')} as code, {_STRIP('"' + ZIP + '"')} as zip, {_STRIP('"' + PREF + '"')} as pref, {_STRIP('"' + ADDR + '"')} as addr, {_STRIP('"' + URL + '"')} as url, '' as phone from work_rows""")
def logical_columns(spark, folder):
    return S.logical(table(spark, folder, "work_rows"))


@query(f"""with c as (select "{ID}" rid, "出力日時" seen, unnest(string_split({_STRIP('"' + URL + '"')}, ' ')) u, generate_subscripts(string_split({_STRIP('"' + URL + '"')}, ' '), 1) i from output_rows),
k as (select *, row_number() over (partition by rid, seen order by i) k from c where u <> '' and not {_blocked_sql('u')})
select rid, k - 1 as idx, u as url from k where k <= 5""")
def first_candidates(spark, folder):
    o = table(spark, folder, "output_rows")
    hits = F.transform(F.split(T.blank(F.col(URL)), " "), lambda x: F.struct(x.alias("url")))
    return o.select(F.col(ID).alias("rid"), F.posexplode(V.candidates(hits)).alias("idx", "c")).select("rid", F.col("idx").cast("long").alias("idx"), "c.url")


_MERGED = f"""dt as (select "{ID}"::varchar rid, {_STRIP('"' + CODE + '"')} code, coalesce("正規化名",'') norm, coalesce("名寄せキー種別",'') kind, "取込日時" seen from work_rows),
mr as (select rid, max_by(row(norm, kind), seen) h from dt group by rid), mc as (select code, min_by(row(norm, kind), row(seen, rid)) h from dt where code <> '' group by code),
m as (select o."{ID}" rid, o."出力日時" seen, coalesce(mr.h, mc.h) h from output_rows o left join mr on o."{ID}"::varchar = mr.rid left join mc on {_STRIP('o."' + CODE + '"')} <> '' and {_STRIP('o."' + CODE + '"')} = mc.code)"""


def _merged(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "output_rows").select(F.col(ID), F.col(CODE), F.col("出力日時").alias("seen"))
    d = table(spark, folder, "work_rows").select(ID, CODE, NAME, "正規化名", "名寄せキー種別", "取込日時")
    return E.merge_details(a, d, ID, ["医療機関コード", CODE], [F.col("取込日時"), F.col(ID)])


@query(f"with {_MERGED} select rid, seen, coalesce(h[1],'') as norm, coalesce(h[2],'') as kind, h is not null as hit from m")
def merged_details(spark, folder):
    return _merged(spark, folder).select(F.col(ID).alias("rid"), "seen", F.col("正規化名").alias("norm"), F.col("名寄せキー種別").alias("kind"), "hit")


@query(f"with {_MERGED} select count(*) n, count(*) filter (h is not null) n_hit, count(*) filter (h is not null)::double / count(*) as share from m")
def merge_hit_rate(spark, folder):
    return E.hit_rate(_merged(spark, folder))


@query("with q as (" + SQL["merge_early"] + ") select confidence, count(*) n from q group by 1")
def merge_early_histogram(spark, folder):
    return E.histogram(merge_early(spark, folder), "confidence")


@query(f"""with x as (select {_STRIP('"' + URL + '"')} u, coalesce("{ZIP}",'') z, coalesce("{ADDR}",'') a from output_rows)
select count(*) n, count(*) filter (u <> '') n_parsed, count(*) filter (z <> '') n_dept, count(*) filter (a <> '') n_basic, count(*) filter (u <> '') / count(*) as share_parsed, count(*) filter (z <> '') / count(*) as share_dept, count(*) filter (a <> '') / count(*) as share_basic from x""")
def details_coverage(spark, folder):
    o = table(spark, folder, "output_rows")
    return DT.coverage(o.select(T.blank(F.col(URL)).alias("時間帯1開始"), F.col(ZIP).alias("診療科目"), F.col(ADDR).alias("基本領域")))


@query(f"""with {_W}, one as (select {_STRIP('code')} c, any_value(rid)::varchar r from w where {_STRIP('code')} <> '' group by 1 having count(*) = 1),
na as (select coalesce(name,'') || '|' || coalesce(addr,'') k, any_value(rid)::varchar r from w where coalesce(name,'') || '|' || coalesce(addr,'') <> '' group by 1 having count(*) = 1),
o as (select {_STRIP('"' + CODE + '"')} c, coalesce("{NAME}",'') || '|' || coalesce("{ADDR}",'') k from output_rows),
f as (select coalesce(one.r, na.r) r, one.r v from o left join one on o.c <> '' and o.c = one.c left join na on o.k = na.k)
select 'found' as part, count(r) as n, count(distinct r) as n_records from f union all select 'verified', count(v), count(distinct v) from f union all select 'details', count(v), count(distinct v) from f""")
def repaired_tables(spark, folder):
    c, empty = F.col, F.lit("")
    lost = table(spark, folder, "output_rows").select(F.lit(None).cast("string").alias("rid"), T.blank(c(CODE)).alias("code"), F.concat(F.coalesce(c(NAME), empty), F.lit("|"), F.coalesce(c(ADDR), empty)).alias("na"))
    base = work(spark, folder).select(c("rid").cast("string").alias("rid"), T.blank(c("code")).alias("code"), F.concat(F.coalesce(c("name"), empty), F.lit("|"), F.coalesce(c("addr"), empty)).alias("na"))
    got = RS.repaired(lost, lost, lost, base, "rid", "code", "na")
    one = lambda k: got[k].agg(F.lit(k).alias("part"), F.count("rid").alias("n"), F.count_distinct("rid").alias("n_records"))
    return one("found").unionByName(one("verified")).unionByName(one("details"))


@query(f"""with {_W}, {_HIGH}, b as (select hst host, coalesce("{NAME}",'') nm from h where hst <> '' and not {_blocked_sql('"' + URL + '"')}), p as (select host from b group by 1 having count(distinct nm) >= 20),
v as (select "{ID}" rid, "{NAME}" nm, {_STRIP('"' + URL + '"')} u from output_rows), g as (select * from v where u <> '' and not starts_with(u,'（') and ({_blocked_for_sql('u', 'nm')} or {_HOST('u')} in (select host from p)))
select 'verified' as part, (select count(*) from v) - (select count(*) from g) as n union all select 'dropped', count(*) from g union all select 'details', count(*) from w where rid not in (select rid from g)
union all select 'extra', count(*) from (select host from p union select * from {_EXTRA})""")
def feedback_pass(spark, folder):
    extra = _extra(spark, folder)
    find = lambda d: I.portal_hosts(d, U.host(F.col(URL)), F.col(NAME), F.col(PREF), U.blocked(F.col(URL)), rules.PORTAL_LEAST)
    bad = lambda hosts: U.blocked_for(T.blank(F.col(URL)), F.col(NAME), hosts)
    got = I.feedback(_high(spark, folder), table(spark, folder, "output_rows"), work(spark, folder).withColumnRenamed("rid", ID), extra, {"url": URL, "record": ID}, bad, find)
    one = lambda k: got[k].agg(F.lit(k).alias("part"), F.count("*").alias("n"))
    return one("verified").unionByName(one("dropped")).unionByName(one("details")).unionByName(one("extra"))


_TEXTS = f"""select "{ID}"::varchar as rid, coalesce("{NAME}",'') as name, coalesce("{ADDR}",'') as addr, coalesce("{URL}",'') as url from work_rows"""


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "work_rows").select(F.col(ID).cast("string").alias("rid"), F.col(NAME).alias("name"), F.col(ADDR).alias("addr"), F.col(URL).alias("url"))


@query(_TEXTS)
def csv_round_trip(spark, folder):
    """Written with the mark and read again, line ends, quotes and blanks inside the fields kept."""
    at = scratch(spark, "csv")
    S.write_csv(_texts(spark, folder), at, bom=True)
    return S.read_csv(spark, at, "UTF-8")


@query(_TEXTS)
def tab_round_trip(spark, folder):
    at = scratch(spark, "tab")
    d = _texts(spark, folder).na.fill("")
    d.write.option("header", True).option("sep", "\t").option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(at)
    return S.read_csv(spark, at, "UTF-8", "\t")


@query(_TEXTS)
def json_lines_round_trip(spark, folder):
    at = scratch(spark, "json")
    d = _texts(spark, folder).na.fill("")
    d.write.json(at)
    return S.read_json_lines(spark, at, d.schema, strict=True)


@query(f"""select distinct lower(trim(host)) as host from extra_blocked where trim(host) <> '' and not starts_with(host, '#')""")
def host_list_round_trip(spark, folder):
    at = scratch(spark, "hosts")
    S.write_hosts(spark.createDataFrame([(h,) for h in _extra(spark, folder)], "host string"), at, "portals")
    return S.read_hosts(spark, at)


@query(f"""with u as (select 1 l, "{ID}" rid from work_rows union all select 2, "{ID}" from prepared_rows), n as (select (row_number() over (order by l, rid) - 1) // 500 part, rid from u) select part, count(*) n, min(rid)::varchar lo, max(rid)::varchar hi from n group by part""")
def exported_parts(spark, folder):
    """Both lists in files of 500 rows, without one column, each part with its header."""
    at = scratch(spark, "parts")
    lists = [table(spark, folder, t).select(F.col(ID).alias("rid"), F.col(NAME).alias("name"), F.lit("x").alias("raw")) for t in ("work_rows", "prepared_rows")]
    S.export_parts(lists, ["rid"], at, 500, ["raw"])
    d = S.read_csv(spark, at, "UTF-8").withColumn("rid", F.col("rid").cast("long"))
    return d.groupBy(F.col("part").cast("long").alias("part")).agg(F.count("*").alias("n"), F.min("rid").cast("string").alias("lo"), F.max("rid").cast("string").alias("hi"))


@query(f"""with {_W}, {_HIT} select 'import' as part, count(*) filter ({_STRIP('final_url')} <> '') as n from y union all select 'audit', count(*) from y""")
def exported_pair(spark, folder):
    a, b = scratch(spark, "import"), scratch(spark, "audit")
    S.export_pair(judged(spark, folder).select("rid", "final_url", "confidence"), "rid", "final_url", ["rid", "final_url", "confidence"], a, b)
    one = lambda k, at: S.read_csv(spark, at, "UTF-8").agg(F.lit(k).alias("part"), F.count("*").alias("n"))
    return one("import", a).unionByName(one("audit", b))


@query(f"""select distinct "{ID}" rid from output_rows where coalesce("{URL}",'') <> ''""")
def swapped_table(spark, folder):
    """A table that is replaced by a part of itself."""
    at = scratch(spark, "swap")
    table(spark, folder, "output_rows").select(F.col(ID).alias("rid"), F.col(URL).alias("url")).write.parquet(at)
    S.swap(spark.read.parquet(at).where("coalesce(url, '') <> ''").select("rid").distinct(), at)
    return spark.read.parquet(at)


@query(f"with {_OPEN.split('bc as (')[0].rstrip().rstrip(',')} select c as code, p as phone, u as url from o2")
def open_data_scan(spark, folder):
    """Two files with unlike headers below one folder, found and read by their hints."""
    at = scratch(spark, "open")
    o = table(spark, folder, "opendata_rows")
    half = F.pmod(F.col("施設番号"), F.lit(2))
    S.write_csv(o.where(half == 0).select(F.col("医療機関番号"), F.col("ホームページ"), F.col("電話").alias("電話番号")).coalesce(1), at + "/a/x.csv")
    S.write_csv(o.where(half == 1).select(F.col("電話").alias("TEL"), F.col("ホームページ").alias("施設のURL"), F.col("医療機関番号").alias("保険医療機関コード")).coalesce(1), at + "/b/y.csv", bom=True)
    return S.read_open_data(spark, at).select("code", "phone", "url")
