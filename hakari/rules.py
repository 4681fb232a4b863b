"""Rule tables of the domain. All of them are fixed values and can be replaced by the caller."""

from __future__ import annotations

# Source columns by logical name, in order of preference.
COLUMN_ALIASES = {
    "record_id": ["レコードID", "Record ID", "レコードＩＤ"],
    "name": ["会社名", "医療機関名", "Company name", "施設名"],
    "code": ["医療機関コード（正）", "医療機関コード", "保険医療機関コード"],
    "zip": ["郵便番号", "Postal code", "〒"],
    "pref": ["都道府県／地域", "都道府県", "State/Region"],
    "addr": ["市区町村", "住所", "City", "所在地"],
    "url": ["ウェブサイトURL", "Website URL", "ホームページ", "URL"],
    "phone": ["電話番号", "Phone Number", "TEL", "電話"],
}
REQUIRED = ("record_id", "name", "addr")

# Hints for the columns of open data files.
CODE_HINTS = ["医療機関コード", "機関コード", "kikanCd", "医療機関番号"]
URL_HINTS = ["ホームページ", "ＵＲＬ", "URL", "url", "ウェブサイト", "アドレス"]
PHONE_HINTS = ["電話番号", "電話", "TEL", "ＴＥＬ"]

# Legal forms, in the order in which they are taken out of a name.
LEGAL_FORMS = (
    "医療法人社団 医療法人財団 一般社団法人 公益社団法人 一般財団法人 公益財団法人 社会医療法人 特定医療法人 独立行政法人 地方独立行政法人 "
    "社会福祉法人 医療法人 医療生協 厚生連 学校法人 特定非営利活動法人"
).split()
# Fixed value: characters that don't count in a compared name (a class for regular expressions).
NAME_NOISE = r"[\s　・･,，.。'’\"“”\-－―ー‐–—_/／\\()（）［］\[\]{}]"

# Domains that are never a facility's own site.
BLOCKED_DOMAINS = """
byoinnavi.jp caloo.jp doctorsfile.jp fdoc.jp medimap.jp doctor-map.info 659naoso.com qlife.jp hospita.jp mrso.jp itot.jp medley.life
clinic.medley.life byoin.me iryou.jp epark.jp scuel.me medicalnote.jp m-life.jp estdoc.jp tokyo-doctors.com saitama-doctors.com
gmo-clinic-map.com clinic.mynavi.jp health.ne.jp itsudokomap.info navita.co.jp t-pec.jp 10man-doc.co.jp fastdoctor.jp sokuyaku.jp
kireipass.jp mymeii.jp narne.jp opendata-japan.com indeed.com jp.indeed.com guppy.jp job-medley.com jobmedley.com co-medical.com
kango-roo.com mynavi-iryofukushi.jp works.medical.nikkeibp.co.jp nurse-senka.jp townpage.goo.ne.jp mapion.co.jp map.yahoo.co.jp
navitime.co.jp ekiten.jp facebook.com instagram.com x.com twitter.com youtube.com line.me ja.wikipedia.org hotpepper.jp e-shops.jp
doctorqube.com apokul.jp icall-web.net machimachi.com web-clover.net yomiuri.co.jp melmo-app.com yoku-mite.care med-pro.jp
smile-nurse.jp jmap.jp kaigokensaku.mhlw.go.jp wam.go.jp
""".split()
BLOCKED_SUFFIXES = [".mhlw.go.jp", "med.or.jp", "ishikai.or.jp", "-ishikai.jp"]
BLOCKED_WORDS = (
    "ishikai 医師会 doctormap doctor-map renkei.hosp kenshin-navi -med.org -med.com -med.jp mediasso sousa.jp iryou21 ayamu.casio asitano "
    "home-dr.jp bihokuikiiki rakuraku.or.jp hamamatsu-pippi comhbo sma.or.jp aichi-hifu osaka-ganka neconome park.paa.jp web.clinicn"
).split()
# Municipal hosts, which only public facilities may have as their own, and words of public names.
PUBLIC_SUFFIXES = [".lg.jp"]
PUBLIC_LABELS = ["pref", "city", "town", "vill"]
PUBLIC_WORDS = "保健所 県立 市立 町立 村立 都立 府立 道立 国立 公立 大学 医療センター 保健センター 保健福祉 市民病院 町民病院".split()

PORTAL_LEAST = 20
CANDIDATES_PER_QUERY = 5
HIGH, MID, LOW = 4, 3, 2
# What stands for a URL that was not found, and the columns of a details table that the audit has already.
NOT_FOUND = "（未検出）"
DETAILS_KNOWN = ["レコードID", "医療機関コード", "会社名", "ウェブサイトURL"]

# Words of links to look behind, for access and outline pages and for pages with hours.
SUBPAGE_HINTS = ["access", "アクセス", "clinic", "about", "gaiyo", "概要", "information", "info", "contact", "outline"]
HOURS_LINK_HINTS = ["shinryo", "shinryou", "診療", "時間", "jikan", "gairai", "outpatient", "access", "アクセス", "clinic", "about", "guide", "info"]
# Words near which opening hours stand.
HOURS_WORDS = ["診療時間", "受付時間", "外来受付", "診療案内", "診療日", "休診日", "診療時間・", "受付", "外来時間", "営業時間", "開院時間"]

# Departments, each with its basic area after a colon (none where it has no area).
DEPARTMENTS = """
総合内科:内科 呼吸器内科:内科 循環器内科:内科 消化器内科:内科 胃腸内科:内科 腎臓内科:内科 脳神経内科:内科 神経内科:内科 糖尿病内科:内科
代謝内科:内科 内分泌内科:内科 血液内科:内科 感染症内科:内科 漢方内科:内科 老年内科:内科 緩和ケア内科:内科 人工透析内科:内科 肝臓内科:内科
膠原病内科:内科 アレルギー内科:内科 心療内科:精神科 精神科:精神科 神経科:精神科 リウマチ科:内科 アレルギー科:内科 小児科:小児科
小児外科:外科 新生児科:小児科 内科:内科
消化器外科:外科 呼吸器外科:外科 心臓血管外科:外科 乳腺外科:外科 内分泌外科:外科 大腸肛門外科:外科 肛門外科:外科 脳神経外科:脳神経外科
整形外科:整形外科 形成外科:形成外科 美容外科:形成外科 美容皮膚科:皮膚科 皮膚科:皮膚科 泌尿器科:泌尿器科 腎泌尿器科:泌尿器科 外科:外科
産婦人科:産婦人科 産科:産婦人科 婦人科:産婦人科 眼科:眼科 耳鼻咽喉科:耳鼻咽喉科 耳鼻科:耳鼻咽喉科 気管食道科:耳鼻咽喉科 放射線科:放射線科
放射線診断科:放射線科 放射線治療科:放射線科 麻酔科:麻酔科 ペインクリニック:麻酔科 リハビリテーション科:リハビリテーション科 病理診断科:病理
救急科:救急科 総合診療科:総合診療科 透析:内科 歯科口腔外科: 口腔外科: 矯正歯科: 小児歯科: 審美歯科: 歯科:
人間ドック: 健康診断: 健診: 予防接種: 訪問診療:総合診療科 在宅診療:総合診療科 禁煙外来: 睡眠外来: 甲状腺:内科 性感染症: 内視鏡:内科
"""
BASIC_AREA = {k: v for k, _, v in (x.partition(":") for x in DEPARTMENTS.split())}

# Properties of the customer system and the columns that fill them.
CRM_COLUMNS = [
    ("ウェブサイトURL", "ウェブサイトURL"), ("休診日", "休診日"), ("診療時間帯1 開始", "時間帯1開始"), ("診療時間帯1 終了", "時間帯1終了"),
    ("診療時間帯2 開始", "時間帯2開始"), ("診療時間帯2 終了", "時間帯2終了"), ("診療時間帯3 開始", "時間帯3開始"), ("診療時間帯3 終了", "時間帯3終了"),
    ("診療科目", "診療科目"), ("基本領域科", "基本領域"),
]
