"""A content-addressed archive of WARC records.

``headers`` holds every record's header block byte for byte, with the digest of the payload it
once had; ``payloads`` holds each payload once under its SHA-256. A record is put together again
by a join on the digest. Of equal payloads of a size worth it the first record is a response, the
others revisits of it, as WARC/1.1 has them; smaller ones are responses each. DataFrame functions only.

A digest stands for a payload only after a check: writing raises where two payloads of one digest
differ in length or in a second hash, reading raises where stored bytes don't give their digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import join_counted
from ledgerlens.plans import scratch

#: Payloads of fewer bytes are never revisited.
LEAST_BYTES = 100
#: Records of one payload that one task puts together; a payload that more records have goes to several tasks.
TOGETHER = 10_000
DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def record_id(page_id: Column) -> Column:
    """A URN that holds a whole number, which ``page_of`` reads again; that of null is the nil UUID."""
    h = F.lpad(F.lower(F.hex(page_id.cast("long"))), 16, "0")
    urn = F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-8000-8000-"), F.substring(h, 13, 4), F.lit("00000000>"))
    return F.coalesce(urn, F.lit("<urn:uuid:00000000-0000-0000-0000-000000000000>"))


def page_of(urn: Column) -> Column:
    h = F.regexp_replace(urn, "^<urn:uuid:(.{8})-(.{4})-8000-8000-(.{4})0{8}>$", "$1$2$3")
    return F.when(F.length(h) == 16, F.conv(h, 16, -10).cast("long"))


def field(header: Column, name: str) -> Column:
    """The value of a named field of a header block; null where there is none."""
    found = F.regexp_extract(header.cast("string"), rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def store(records: DataFrame, path: str) -> None:
    """Archive ``records(record_id, header, payload)``: any id, the exact bytes of the header block and of the payload (null: empty).

    Repeated records are kept as often as they are there. Payloads go through one shuffle, each task sending a payload once.
    """
    payload = F.coalesce(F.col("payload").cast("binary"), F.lit(b""))
    rows = records.select("record_id", F.col("header").cast("binary").alias("header"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    rows.select("record_id", "header", "digest").write.mode("overwrite").parquet(f"{path}/headers")
    store_payloads(rows.select("digest", "payload"), path)


def store_payloads(rows: DataFrame, path: str) -> None:
    """``rows(digest, payload)`` with repeats, each payload once, with the number of its records."""
    size, other = F.octet_length("payload"), F.xxhash64("payload")
    once = rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.count("*").alias("records"), F.min(size).alias("a"), F.max(size).alias("b"), F.min(other).alias("c"), F.max(other).alias("d"))
    same = (F.col("a") == F.col("b")) & (F.col("c") == F.col("d"))
    checked = F.when(same, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("different payloads of digest "), F.col("digest"))).cast("binary"))
    once.select("digest", checked.alias("payload"), "records").write.mode("overwrite").parquet(f"{path}/payloads")


def headers(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, header, digest) of every record."""
    return spark.read.parquet(f"{path}/headers")


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(digest, payload, records, n_bytes) of every payload; raises where the bytes don't give the digest."""
    p = spark.read.parquet(f"{path}/payloads")
    actual = F.sha2("payload", 256)
    digest = F.when(actual == F.col("digest"), actual).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))))
    return p.select(digest.alias("digest"), "payload", "records", F.octet_length("payload").cast("long").alias("n_bytes"))


def restore(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, header, payload) as they were stored. Records of a frequent payload are dealt to several tasks, the payload with them."""
    p = payloads(spark, path)
    part = lambda n: F.ceil(n / TOGETHER).cast("long")
    frequent = scratch.keep(p.where(F.col("records") > TOGETHER).select("digest", "records"), "frequent")
    h = join_left(headers(spark, path), frequent).withColumn("__part", F.pmod(F.xxhash64("record_id", "header"), part(F.coalesce("records", F.lit(1))))).drop("records")
    copies = p.select("digest", "payload", F.explode(F.sequence(F.lit(0).cast("long"), part(F.col("records")) - 1)).alias("__part"))
    return h.join(copies, ["digest", "__part"]).select("record_id", "header", "payload")


def join_left(left: DataFrame, frequent: DataFrame) -> DataFrame:
    """``left`` with the column records of the digests that have very many; null for others.

    Those of over 1/512 of the rows, at most 512, are broadcast, so that none of them gathers in one task.
    """
    total = frequent.agg(F.sum("records")).first()[0] or 0
    hot = F.col("records") * 512 > F.lit(total)
    most = left.join(F.broadcast(frequent.where(hot).withColumnRenamed("records", "__hot")), "digest", "left")
    # rows that have their number already are dealt by their own hash and meet nothing
    key = F.when(F.col("__hot").isNull(), F.col("digest")).otherwise(F.concat(F.lit("hot"), F.xxhash64("record_id", "header").cast("string")))
    rest = frequent.where(~hot).select(F.col("digest").alias("__key"), "records")
    return most.withColumn("__key", key).join(rest, "__key", "left").withColumn("records", F.coalesce("__hot", "records")).drop("__key", "__hot")


def warc_bytes(record_type: Column, header: Column, payload: Column) -> Column:
    """The record as it stands in a WARC file: header block, content (none for a revisit), two line ends."""
    return F.concat(header, F.lit(b"\r\n"), F.when(record_type == "revisit", F.lit(b"")).otherwise(payload), F.lit(END))


def write_files(spark: SparkSession, path: str, out: str) -> None:
    """WARC/1.1 files of all archived records, written and committed by Spark's text writer, whose line end is the last byte of each record."""
    r = restore(spark, path)
    whole = warc_bytes(field(F.col("header"), "WARC-Type"), F.col("header"), F.col("payload"))
    line = F.substring(whole, F.lit(1), F.octet_length(whole) - 1)
    r.select(line.cast("string").alias("value")).write.mode("overwrite").option("lineSep", "\n").text(out)


def header_block(record_type: Column, page_id: Column, url: Column, digest: Column, n_bytes: Column, refers_to: Column, date: str = DATE) -> Column:
    """The header lines of a page's record, each with its line end. Line ends and NULs in the url are percent-encoded; a null url has no line."""
    safe = F.replace(F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit("\0"), F.lit("%00"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    lines = [
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", record_type),
        line("WARC-Record-ID", record_id(page_id)),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", safe),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(record_type == "revisit", line("WARC-Refers-To", record_id(refers_to))),
        F.when(record_type == "revisit", line("WARC-Profile", F.lit(REVISIT))),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(record_type == "revisit", F.lit("0")).otherwise(n_bytes.cast("string"))),
    ]
    return F.concat_ws("", *lines).cast("binary")


def archive_pages(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Archive ``pages(page_id, url, html)``, the html in UTF-8 as payload (null: empty).

    Of records with equal payloads of ``least`` bytes or more, that of the smallest page_id is the response. Rows that repeat
    this id are responses too. A null id is never referred to: such rows revisit a page with an id, or, where there is none, are responses.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    found = scratch.keep(rows.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("n_bytes")), "pages")
    groups = scratch.keep(found.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("rows")), "groups")
    again = (F.col("n_bytes") >= least) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    kind = F.when(again, "revisit").otherwise("response")
    h = join_counted(found, groups, ["digest"], "rows").select("page_id", "digest", header_block(kind, F.col("page_id"), F.col("url"), F.col("digest"), F.col("n_bytes"), F.when(again, F.col("first"))).alias("header"))
    h.select(F.col("page_id").alias("record_id"), "header", "digest").write.mode("overwrite").parquet(f"{path}/headers")
    store_payloads(rows.select("digest", "payload"), path)
    scratch.drop(found)
    scratch.drop(groups)


def judge(pages: DataFrame, path: str | None = None) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, read back from an archive of them at ``path``.

    Length and digest are those of the stored bytes, joined to the records by digest; types, ids and references are read from the header blocks.
    """
    spark = pages.sparkSession
    path = path or scratch.new_path(spark, "archive")
    archive_pages(pages, path)
    text = F.col("header")
    read = headers(spark, path).select(page_of(field(text, "WARC-Record-ID")).alias("page_id"), field(text, "WARC-Payload-Digest").alias("named"), field(text, "WARC-Type").alias("record_type"), page_of(field(text, "WARC-Refers-To")).alias("refers_to"))
    read = read.withColumn("digest", F.substring("named", len("sha256:") + 1, 64)).drop("named")
    facts = scratch.keep(payloads(spark, path).select("digest", F.col("n_bytes").alias("payload_bytes"), "records"), "facts")
    out = join_counted(read, facts, ["digest"], "records")
    return out.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id <> first THEN first END AS refers_to FROM d
"""
