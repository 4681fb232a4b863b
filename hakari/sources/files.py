"""Delimited and JSON files: encodings found by bytes, columns by aliases, nothing inferred."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import rules
from ..functions import text as T
from ..functions.url import blocked


def encoding_of(first: bytes) -> str:
    """UTF-8 where the first bytes decode as such (a character may be cut at the end), else Windows Japanese."""
    for cut in range(4):
        try:
            first[: len(first) - cut or None].decode("utf-8")
            return "UTF-8"
        except UnicodeDecodeError as e:
            if e.start < len(first) - 4:
                break
    return "MS932"


def read_csv(spark: SparkSession, path: str, encoding: str | None = None, sep: str = ",") -> DataFrame:
    """A headered file with every column a string. Quoted line ends stay inside their record; doubled quotes are
    quotes. The encoding is found from the first 64 KB of one file unless given; missing fields are empty."""
    if encoding is None:
        head = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 65536).alias("b")).limit(1).collect()
        encoding = encoding_of(bytes(head[0].b)) if head else "UTF-8"
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    d = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding=encoding, sep=sep)
    d = d.toDF(*[c.removeprefix(BOM) for c in d.columns])
    return d.na.fill("")


def read_json_lines(spark: SparkSession, path: str, schema: StructType, strict: bool = False) -> DataFrame:
    """Records of a JSON lines file; bad lines are skipped, or an error if strict."""
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


def read_hosts(spark: SparkSession, path: str) -> DataFrame:
    """(host) of a rule file: one a line in any case, without comments and blank lines."""
    h = F.lower(T.strip(F.col("value")))
    return spark.read.text(path).where(~F.col("value").startswith("#")).select(h.alias("host")).where("host <> ''")


def resolve(columns: Iterable[str], aliases: dict[str, list[str]] = rules.COLUMN_ALIASES) -> dict[str, str | None]:
    """The column of each logical name: the first alias that is there, else None."""
    have = set(columns)
    return {k: next((a for a in v if a in have), None) for k, v in aliases.items()}


def logical(df: DataFrame, aliases: dict[str, list[str]] = rules.COLUMN_ALIASES, required: Iterable[str] = rules.REQUIRED) -> DataFrame:
    """df in logical names, trimmed, blank where a column is missing; a missing required column is an error."""
    at = resolve(df.columns, aliases)
    lost = [k for k in required if not at.get(k)]
    if lost:
        raise ValueError(f"required columns not found: {', '.join(lost)} in {df.columns}")
    return df.select(*[(T.blank(F.col(f"`{c}`").cast("string")) if c else F.lit("")).alias(k) for k, c in at.items()])


def hinted(columns: list[str], hints: list[str]) -> str | None:
    """The column that holds the first hint that any column holds."""
    return next((c for h in hints for c in columns if h in c), None)


def csv_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """Files below a folder, at any depth, in the order of their paths. Only paths are read; a folder of open data is
    some hundreds of files."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return sorted(r.path for r in d.select("path").distinct().toLocalIterator())


def read_open_data(spark: SparkSession, paths: list[str] | str, extra: list[str] | None = None) -> DataFrame:
    """(code, phone, url, file_ord) of open data files with unlike headers; files without usable columns are skipped.

    paths: files, or a folder that is searched for .csv files. Only rows with an http address that is no portal's stay;
    codes and telephones are normalized.
    """
    paths = csv_files(spark, paths) if isinstance(paths, str) else paths
    out = None
    for i, path in enumerate(sorted(paths)):
        d = read_csv(spark, path)
        code, url, phone = (hinted(d.columns, h) for h in (rules.CODE_HINTS, rules.URL_HINTS, rules.PHONE_HINTS))
        if not url or not (code or phone):
            continue
        u = T.blank(F.col(f"`{url}`"))
        one = d.where(F.lower(u).startswith("http") & ~blocked(u, extra)).select(
            (T.facility_code(F.col(f"`{code}`")) if code else F.lit("")).alias("code"),
            (T.phone_digits(T.nfkc(F.col(f"`{phone}`"))) if phone else F.lit("")).alias("phone"),
            u.alias("url"), F.lit(i).alias("file_ord"),
        )
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "code string, phone string, url string, file_ord int")


#: The mark by which spreadsheets know UTF-8; it goes before the first column's name.
BOM = "\ufeff"


def write_csv(df: DataFrame, path: str, per_file: int = 0, mode: str = "errorifexists", bom: bool = False, by: str | None = None) -> None:
    """Headered files; empty and null are written alike as nothing, quotes doubled; per_file bounds a file's records; with
    `bom` each file begins with the mark; `by` is a column whose values become folders."""
    names = [c for c in df.columns if c != by]
    marked = {names[0]: BOM + names[0]} if bom and names else {}
    d = df.select(*[F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")).alias(marked.get(c, c)) for c in names], *([by] if by else []))
    w = d.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "")
    w = w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    w = w.partitionBy(by) if by else w
    (w.option("maxRecordsPerFile", per_file) if per_file else w).csv(path)


def export_pair(rows: DataFrame, key: str, url: str, audit: list[str], import_path: str, audit_path: str) -> None:
    """Two exports from rows that are computed once: key and URL of the rows that have one, and all columns of `audit`."""
    from ..session import cut

    once = cut(rows.select(*dict.fromkeys([key, url, *audit])))
    write_csv(once.where(T.blank(F.col(url)) != "").select(key, url), import_path, bom=True)
    write_csv(once.select(*audit), audit_path, bom=True)


def export_parts(lists: list[DataFrame], order: list[str], path: str, size: int = 20_000, drop: list[str] | None = None) -> None:
    """The lists one after another in `order`, without the columns of `drop`, in parts of `size` rows: a folder part=n with
    one headered file each. A part is written by one task, however many rows there are."""
    from ..operators.enrich import without_columns
    from ..operators.files import row_parts, union_lists

    all_ = row_parts(union_lists(lists), ["list_id", *order], size)
    parts = without_columns(all_, ["list_id", *(drop or [])]).repartition("part").sortWithinPartitions("part", *[o for o in order if o not in (drop or [])])
    write_csv(parts, path, bom=True, by="part")


def with_bom(text: bytes) -> bytes:
    """The bytes with the mark that spreadsheets look for, once."""
    return text if text.startswith(b"\xef\xbb\xbf") else b"\xef\xbb\xbf" + text


def swap(df: DataFrame, path: str) -> None:
    """Replace the table at path by df, which may read it: written beside it first, then renamed."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    new, old = jvm.org.apache.hadoop.fs.Path(path + ".new"), jvm.org.apache.hadoop.fs.Path(path + ".old")
    df.write.mode("overwrite").parquet(path + ".new")
    fs.delete(old, True)
    if fs.exists(at) and not fs.rename(at, old):
        raise OSError(f"could not set {path} aside")
    if not fs.rename(new, at):
        raise OSError(f"could not put {path} in place")
    fs.delete(old, True)


def write_hosts(hosts: DataFrame, path: str, title: str) -> None:
    """One file of hosts, one a line, under a comment; it can be read by read_hosts."""
    spark = hosts.sparkSession
    head = spark.createDataFrame([(0, f"# {title}")], "k int, value string")
    lines = hosts.where("host is not null").select(F.lit(1).alias("k"), F.col("host").alias("value"))
    head.unionByName(lines).repartition(1).sortWithinPartitions("k", "value").select("value").write.text(path)


def unless_there(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at path; it is made and written first unless a finished one is there."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


HIT = StructType([StructField(n, StringType()) for n in ("url", "title", "snippet")])
