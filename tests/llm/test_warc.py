"""op12: exact round trips, revisits, files, damage."""

import glob
import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import queries, warc
from ledgerlens.plans import scratch

D = "/root/testdata/sf0.001"


def definition(pages):
    payload = [(h or "").encode() for _, h in pages]
    out = []
    for (i, _), p in zip(pages, payload):
        same = [j for (j, _), q in zip(pages, payload) if q == p and j is not None]
        again = len(p) >= 100 and same and i != min(same)
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_query_is_its_sql_and_definition(spark):
    got = queries.op12_warc_archive(spark, D)
    assert dict(got.dtypes) == {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{D}/pages.parquet'")
    want = con.sql(queries.oracle_sql()["op12_warc_archive"])
    assert sorted(want.columns) == sorted(got.columns)
    assert rows(got) == sorted(want.fetchall(), key=repr) == definition(con.sql("SELECT page_id, html FROM pages").fetchall())


ODD = [(5, "u", "a" * 100), (3, None, "a" * 100), (None, "u", "a" * 100), (3, "again", "a" * 100), (9, "u", "é" * 50), (8, "u", "é" * 50), (1, "u", "a" * 99), (2, "u", "a" * 99), (4, "", None), (6, "u", ""), (None, None, "z" * 300), (None, None, "z" * 300), (-7, "x\r\nWARC-Type: revisit\r\n\0", "q" * 200), (2**62, "x", "q" * 200), (11, "big", "0123456789" * 300_000), (10, "big", "0123456789" * 300_000)]


def test_odd_pages(spark):
    df = spark.createDataFrame(ODD, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("digest", "header", "payload", "records", "first", "n_bytes")})
    assert rows(warc.judge(df)) == definition([(i, h) for i, _, h in ODD])
    assert warc.judge(df.limit(0)).count() == 0


def test_records_of_any_bytes_come_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "TOGETHER", 3)
    rnd = random.Random(2)
    body = [bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 1, 50, 500]))) for _ in range(6)]
    records = [(i, b"WARC/1.1\r\nX-Odd: " + bytes(rnd.randrange(256) for _ in range(9)) + b"\r\n", body[min(rnd.randrange(12), 5)]) for i in range(60)]
    records += [(60, None, None), (60, b"", None), (60, b"", None), (None, b"h", b"p")]
    path = scratch.new_path(spark, "archive")
    warc.store(spark.createDataFrame(records, "record_id long, header binary, payload binary").withColumn("digest", F.lit(1)), path)
    got = sorted(((r.record_id, r.header and bytes(r.header), bytes(r.payload)) for r in warc.restore(spark, path).collect()), key=repr)
    assert got == sorted(((i, h, p or b"") for i, h, p in records), key=repr)
    assert warc.payloads(spark, path).count() == len({p or b"" for _, _, p in records})


def test_files_are_warc(spark):
    df = spark.createDataFrame(ODD, "page_id long, url string, html string")
    path, out = scratch.new_path(spark, "archive"), scratch.new_path(spark, "files")
    warc.archive_pages(df, path)
    warc.write_files(spark, path, out)
    found = []
    for f in glob.glob(out.removeprefix("file://") + "/part-*"):
        data = open(f, "rb").read()
        while data:
            head, data = data.split(b"\r\n\r\n", 1)
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            h = dict(x.split(": ", 1) for x in lines[1:])
            n = int(h["Content-Length"])
            content, end, data = data[:n], data[n : n + 4], data[n + 4 :]
            assert end == b"\r\n\r\n"
            if h["WARC-Type"] == "response":
                assert h["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(content).hexdigest()
            else:
                assert n == 0 and h["WARC-Profile"] == warc.REVISIT
            found.append((h["WARC-Type"], h["WARC-Record-ID"], h.get("WARC-Refers-To"), h["WARC-Payload-Digest"][7:]))
    name = lambda i: "<urn:uuid:" + (re.sub("(.{8})(.{4})(.{4})", r"\1-\2-8000-8000-\g<3>00000000", f"{i % 2**64:016x}") if i is not None else "00000000-0000-0000-0000-000000000000") + ">"
    assert sorted(found, key=repr) == sorted(((k, name(i), None if r is None else name(r), d) for i, _, d, k, r in definition([(i, h) for i, _, h in ODD])), key=repr)


def test_damage_is_found(spark):
    path = scratch.new_path(spark, "archive")
    warc.archive_pages(spark.createDataFrame(ODD, "page_id long, url string, html string"), path)
    p = spark.read.parquet(f"{path}/payloads")
    p.withColumn("payload", F.when(F.octet_length("payload") == 99, F.lit(b"b" * 99)).otherwise(F.col("payload"))).write.parquet(f"{path}/bad/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.payloads(spark, f"{path}/bad").collect()
    with pytest.raises(Exception, match="different payloads"):
        warc.store_payloads(spark.createDataFrame([("d", b"1"), ("d", b"2")], "digest string, payload binary"), f"{path}/worse")
