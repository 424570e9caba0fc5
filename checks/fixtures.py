"""Mail-shaped views of ``documents``, as SQL text that both engines understand.

The tables hold no addresses, quotes or headers, so every row gets some, depending
on its id. No row is left out and no text is shortened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termloom.sources.spread import spread

NL, TAB = "chr(10)", "chr(9)"

EMAIL_COLUMNS = {
    "doc_id": "doc_id",
    "id": "'<' || cast(doc_id as varchar(20)) || '@fixture>'",
    "author": "source",
    "email": "' ' || upper(source) || '@Example.COM '",
    "subject": "'doc ' || cast(doc_id as varchar(20))",
    "date": "'2013-05-31T16:00:00Z'",
    "replyid": "case when doc_id % 3 = 0 then '' else '<' || cast(doc_id - 1 as varchar(20)) || '@fixture>' end",
    "content": (
        "case doc_id % 5"
        f" when 1 then ' On Wed, Jan 17, 2018 at 9:30 AM, A <a@b.c> wrote:' || {NL} || text"
        f" when 2 then '> quoted line' || {NL} || '>> deeper line' || {NL} || text"
        f" when 3 then '>tight line' || {NL} || text || {TAB} || 'column'"
        f" when 4 then '> On Thu, Feb 08, 2018 at 7:45 PM, B <b@c.d>wrote:' || {NL} || text"
        " else text end"
    ),
}

# body lines that look like a divider are stuffed, as mail programs do
STUFFED = f"substr(replace({NL} || text, {NL} || 'From ', {NL} || '>From '), 2)"
# day, hour and zone vary; all zones are given as header text and as hours from UTC
DAY, HOUR = "(1 + doc_id % 28)", "(doc_id % 24)"
ZONE = "case doc_id % 3 when 0 then '-0700' when 1 then '+0000 (UTC)' else 'GMT' end"
ZONE_HOURS = "case doc_id % 3 when 0 then -7 else 0 end"
FROM_HEADER = (
    "case doc_id % 4 when 0 then 'From: Ann Other <' || source || '@example.com>'"
    " when 1 then 'from: ' || source || '@example.com (Ann)'"
    " when 2 then 'From: \"Other, Ann\" <' || source || '@Example.com>'"
    " else 'FROM: nobody' end"
)
HEADERS = (
    f"'Message-ID: <' || cast(doc_id as varchar(20)) || '@fixture>' || {NL}"
    f" || {FROM_HEADER} || {NL}"
    f" || 'Subject: doc ' || cast(doc_id as varchar(20)) || {NL} || {TAB} || 'continued' || {NL}"
    f" || 'Date: Fri, ' || cast({DAY} as varchar(20)) || ' May 2013 '"
    f" || lpad(cast({HOUR} as varchar(20)), 2, '0') || ':05:30 ' || {ZONE} || {NL}"
    f" || case when doc_id % 3 = 0 then '' else 'In-Reply-To: <' || cast(doc_id - 1 as varchar(20))"
    f" || '@fixture>' || {NL} end"
    f" || 'To: \"B, C\" <b' || cast(doc_id as varchar(20)) || '@x.org>, d@x.org' || {NL}"
)
DIVIDER = f"'From ' || source || '@example.com Fri May 31 16:00:00 2013' || {NL}"
MESSAGE = f"{DIVIDER} || {HEADERS} || {NL} || {STUFFED}"

# what parsing gives back
PARSED = {
    "id": EMAIL_COLUMNS["id"],
    "author": "case doc_id % 4 when 0 then 'Ann Other' when 2 then 'Other, Ann' else '' end",
    "email": (
        "case doc_id % 4 when 2 then source || '@Example.com' when 3 then ''"
        " else source || '@example.com' end"
    ),
    "subject": "'doc ' || cast(doc_id as varchar(20)) || ' continued'",
    "epoch": f"1369958400 + ({DAY} - 31) * 86400 + ({HOUR} - ({ZONE_HOURS})) * 3600 + 330",
    "replyid": EMAIL_COLUMNS["replyid"],
    "content": f"rtrim({STUFFED}, {NL}) || {NL}",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# bytes of stored texts that one task analyses: what it holds does not grow with the table
PIECE_BYTES = 16 << 20


def pieces(stored: int, cores: int) -> int:
    """Pieces of a table of so many bytes: as many as there are cores, more if it is large."""
    return max(cores, -(-stored // PIECE_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # test files have one row group each, so their splits say little
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/documents.parquet")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stored = found.getContentSummary(path).getLength()
    return spread(table(spark, sf_dir, "documents"), pieces(stored, spark.sparkContext.defaultParallelism))


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).selectExpr(*[f"{sql} as {name}" for name, sql in EMAIL_COLUMNS.items()])


def emails_sql() -> str:
    cols = ", ".join(f"{sql} as {name}" for name, sql in EMAIL_COLUMNS.items())
    return f"select {cols} from documents"


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole mbox messages, one per document."""
    return documents(spark, sf_dir).selectExpr("doc_id", "source as path", f"{MESSAGE} as message")


def parsed_sql(*names: str) -> str:
    return ", ".join(f"{PARSED[n]} as {n}" for n in names)
