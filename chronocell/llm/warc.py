"""Content-addressed WARC archive.

Two tables in the archive folder: `payloads` keeps each distinct payload's bytes once under their
SHA-256, `records` keeps every record's exact header text and the digest it points to. Reading joins
them on the digest and parses the headers: a payload whose bytes do not hash to its name, to the header's
payload digest, or to its length fails the read.

The owner of a payload is the smallest page_id (least over a partially aggregated group, so a payload
shared by a third of all pages costs one row a task); the join on reading may be split. Defined results: a null html
is the empty payload; null page_ids sort last; of rows repeating one (page_id, payload) the first is the response and
the others revisit it; line ends in a url are percent-coded in headers; an empty table gives an empty archive; other
columns are ignored. Records carry the date given, as pages have none, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronocell.llm.common import shared_path

#: Fixed values of WARC 1.1 and RFC 4648.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_FROM = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
DATE = "2000-01-01T00:00:00Z"
LAST = (1 << 63) - 1


def base32_sha1(payload: Column) -> Column:
    """RFC 4648 upper-case base32 of SHA-1: eight groups of five hex digits, four letters each."""
    h = F.sha1(payload)
    return F.translate(F.concat(*[F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]), BASE32_FROM, BASE32_TO)


def _payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def plan_records(pages: DataFrame, revisit_from: int = 0, date: str = DATE) -> DataFrame:
    """A row per record: page_id, url, digest, type, refers_to, header. Payload bytes are not shuffled."""
    p = _payload(F.col("html"))
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    slim = pages.select("page_id", url.alias("url"), F.sha2(p, 256).alias("digest"), base32_sha1(p).alias("sha1"), F.octet_length(p).cast("long").alias("n"))
    same = slim.groupBy("page_id", "url", "digest", "sha1", "n").agg(F.count(F.lit(1)).alias("times"))
    first = same.groupBy("digest").agg(F.min("page_id").alias("owner"), F.min_by("url", F.struct("page_id", "url")).alias("owner_url"))
    r = same.join(first, "digest")
    # equal (page_id, payload) rows: the first one of the owner's answers, all others revisit
    own = F.col("page_id").eqNullSafe(F.col("owner")) & F.col("url").eqNullSafe(F.col("owner_url"))
    r = r.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    plain = (F.col("n") < revisit_from) | (own & (F.col("i") == 1))
    r = r.select(
        "page_id", "url", "digest", "sha1", "n",
        F.when(plain, "response").otherwise("revisit").alias("type"),
        F.when(~plain, F.col("owner")).alias("refers_to"),
        F.when(~plain, F.col("owner_url")).alias("refers_url"),
    )
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.col("type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(F.col("type") == "revisit", F.concat(
            line("WARC-Profile", F.lit(REVISIT_PROFILE)),
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("refers_to").cast("string"), F.lit("null")), F.lit(">"))),
            line("WARC-Refers-To-Target-URI", F.col("refers_url")),
        )).otherwise(""),
        line("Content-Length", F.when(F.col("type") == "revisit", F.lit("0")).otherwise(F.col("n").cast("string"))),
        F.lit(CRLF),
    )
    return r.withColumn("header", head)


def write_archive(pages: DataFrame, path: str, revisit_from: int = 0) -> None:
    records = plan_records(pages, revisit_from)
    records.select("page_id", "digest", "header").write.parquet(f"{path}/records")
    # a payload's copy is taken from its owner's row: both sides are dealt by (digest, id), so no group is hot
    pid = F.coalesce(F.col("page_id").cast("long"), F.lit(LAST))
    mine = pages.select(pid.alias("pid"), _payload(F.col("html")).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    written = pages.sparkSession.read.parquet(f"{path}/records")
    owner = written.select(pid.alias("pid"), "digest").groupBy("digest").agg(F.min("pid").alias("pid"))
    kept = mine.join(owner, ["digest", "pid"], "left_semi").dropDuplicates(["digest", "pid"])
    kept.select("digest", "payload").write.parquet(f"{path}/payloads")


def _field(name: str) -> Column:
    """The value of a header's field; empty without it."""
    return F.regexp_extract("header", rf"\n{name}: ([^\r\n]*)\r", 1)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, header, payload (the full one, also of revisits), payload_bytes, payload_digest, record_type, refers_to.

    payload_bytes comes from the stored bytes, the last three from the header, after all have been held against
    each other.
    """
    p = spark.read.parquet(f"{path}/payloads")
    sound = F.sha2("payload", 256) == F.col("digest")
    p = p.select(
        "digest", "payload",
        F.when(sound, F.octet_length("payload").cast("long")).otherwise(F.raise_error(F.lit("payload does not match its digest")).cast("long")).alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("sha1"),
    )
    r = spark.read.parquet(f"{path}/records").select(
        "page_id", "digest", "header",
        _field("WARC-Type").alias("record_type"),
        F.regexp_extract(_field("WARC-Refers-To"), r"^<urn:page:(.*)>$", 1).try_cast("long").alias("refers_to"),
        F.regexp_extract(_field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("told"),
        _field("Content-Length").try_cast("long").alias("length"),
    )
    r = r.join(p, "digest")
    length = F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("payload_bytes"))
    fits = (F.col("told") == F.col("sha1")) & (F.col("length") == length)
    digest = F.when(fits, F.col("told")).otherwise(F.raise_error(F.concat(F.lit("header does not fit its payload: "), "header")).cast("string"))
    return r.select("page_id", "header", "payload", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")


def record_bytes(records: DataFrame) -> DataFrame:
    """Exact bytes of each record, as in a WARC file; a revisit carries no payload."""
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return records.select("page_id", F.concat(F.encode("header", "UTF-8"), body, F.lit(b"\r\n\r\n")).alias("record"))


def archived(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """pages written to a new archive in the shared folder and read back."""
    path = shared_path(pages.sparkSession, "warc")
    write_archive(pages, path, revisit_from)
    return read_archive(pages.sparkSession, path)


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, encode(coalesce(html, '')) AS b FROM pages),
x AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(h) AS s, sha256(h) AS d FROM p),
o AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS owner FROM x)
SELECT page_id, payload_bytes,
       translate(concat({groups}), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM o
""".replace("{groups}", ", ".join(f"to_base(('0x' || substr(s, {1 + 5 * i}, 5))::BIGINT, 32, 4)" for i in range(8)))
