"""Every core query runs on the given tables, with a stable schema, and agrees with its SQL."""

import glob
import os

import duckdb
import pytest

from hakari.plans import catalogue as C


def tables(folder):
    c = duckdb.connect()
    for f in glob.glob(folder + "/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def lines(df):
    return sorted(str([None if v is None else list(v) if hasattr(v, "tolist") or isinstance(v, list) else v for v in r]) for r in df.astype(object).where(df.notna(), None).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(C.QUERIES))
def test_query(spark, small, name):
    got = C.QUERIES[name](spark, small).toPandas()
    if name in C.SQL:
        want = tables(small).sql(C.SQL[name]).df()
        cols = sorted(got.columns)
        assert cols == sorted(want.columns) and lines(got[cols]) == lines(want[cols])


def test_judged_pairs_have_pages(spark, small):
    """Candidates meet pages, pairs get points and some records are found; both lists come out, each record once."""
    cands, pages = C._judged_candidates(spark, small), C._pages(spark, small)
    met = cands.join(pages, "url").select("record").distinct().count()
    got = C.judge_candidates(spark, small).toPandas()
    n = duckdb.sql(f"""select count(distinct r) from (select "レコードID" r from '{small}/work_rows.parquet' union all select "レコードID" from '{small}/prepared_rows.parquet')""").fetchall()[0][0]
    assert len(got) == got.record.nunique() == n
    assert met >= 30 and (got.confidence != "未検出").sum() > 0


def test_pages_are_all_texts(spark, small):
    want = duckdb.sql(f"select count(*), count(distinct (host, text)) from '{small}/documents.parquet' where host is not null and text is not null").fetchall()[0]
    pages = C._pages(spark, small)
    assert (pages.count(), pages.distinct().count()) == want and want[1] > pages.select("url").distinct().count()


def test_nothing_outside_imports_llm():
    root = os.path.dirname(os.path.dirname(os.path.abspath(C.__file__)))
    for path in glob.glob(root + "/**/*.py", recursive=True):
        if os.sep + "llm" + os.sep not in path:
            assert ".llm" not in open(path, encoding="utf-8").read()
