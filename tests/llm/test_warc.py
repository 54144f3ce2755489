import gzip
import hashlib
import os

import pyarrow.fs as fs
from pyspark.sql import functions as F

from clinicpulse.llm import warc


def written(spark, tmp_path, rows, schema="page_id bigint, url string, html string"):
    path = f"file://{tmp_path}/archive"
    warc.archive(spark.createDataFrame(rows, schema), path)
    return path


def test_round_trip_with_revisits(spark, tmp_path):
    long, other = "é" * 700, "x" * 1000
    rows = [(1, "http://a/\r\nb", long), (2, "u", "short"), (9, None, long), (3, "u", "short"), (4, "u", None), (5, "u", ""),
            (6, "u", other), (7, "u", other[:-1]), (8, "u", other[:-1]), (None, "u", other), (6, "u", other),
            (10, "u", "a\r\n\r\nb\x00" * 300)]
    found = warc.read(spark, written(spark, tmp_path, rows)).collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        page = r["record_id"].split(":")[2]
        by.setdefault(int(page) if page else None, []).append(r)
    for page, _, html in rows:
        raw = (html or "").encode()
        for r in by[page]:
            assert r["payload_bytes"] == len(raw) and r["payload_digest"] == hashlib.sha1(raw).hexdigest()
            assert (r["payload"] is None) if r["record_type"] == "revisit" else (bytes(r["payload"]) == raw)
    revisits = {p: r["refers_to"].split(":")[2] for p, rs in by.items() for r in rs if r["record_type"] == "revisit"}
    assert revisits == {1: "9"}
    assert by[1][0]["target_uri"] == "http://a/%0D%0Ab"


def test_filters_reach_the_reader(spark, tmp_path):
    long = "y" * 2000
    path = written(spark, tmp_path, [(i, f"http://h/{i % 2}", long if i < 3 else f"page {i}") for i in range(10)])
    df = warc.read(spark, path, payloads=False)
    some = df.filter((F.col("record_type") == "revisit") & F.col("target_uri").isin("http://h/1", "http://h/7"))
    assert [r["payload_bytes"] for r in some.collect()] == [2000]
    assert "EqualTo" not in str(some._jdf.queryExecution().executedPlan()) or some.count() == 1
    reader = warc.WarcReader(path, False)
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("payload_bytes",), 3), In(("target_uri",), ("a", "b")), EqualTo(("payload_digest",), "x")]))
    assert [type(f).__name__ for f in left] == ["GreaterThan", "EqualTo"]
    assert reader.wanted == {"record_type": {"response"}, "target_uri": {"a", "b"}}


def test_unwanted_payloads_are_not_inflated(spark, tmp_path, monkeypatch):
    folder = tmp_path / "one"
    folder.mkdir()
    big = os.urandom(1 << 20)
    row = {"record_type": "response", "record_id": "<urn:page:1:x>", "target_uri": "u", "refers_to": None,
           "payload_digest": "x", "payload_bytes": len(big), "payload": big}
    (folder / "a.warc.gz").write_bytes(warc.member(warc.page_record(row, "now")) * 5)
    seen = []
    plain = warc._inflated
    monkeypatch.setattr(warc, "_inflated", lambda s, o, t, enough: seen.append(enough) or plain(s, o, t, enough))
    with fs.LocalFileSystem().open_input_file(str(folder / "a.warc.gz")) as source:
        assert list(warc.records(warc._Stream(source), lambda h: h["warc-type"] == "revisit", True)) == []
    assert seen == [b"\r\n\r\n"] * 5
    with gzip.open(folder / "a.warc.gz") as again:
        assert again.read().count(big) == 5


def test_reads_members_without_a_length_and_plain_archives(tmp_path):
    rows = [{"record_type": "response", "record_id": f"<urn:page:{i}:x>", "target_uri": "u", "refers_to": None, "payload_digest": "x",
             "payload_bytes": 50_000, "payload": bytes([65 + i]) * 50_000} for i in range(3)]
    plain = [warc.page_record(r, "now") for r in rows]
    for name, data in (("a.warc.gz", b"".join(gzip.compress(p) for p in plain)), ("a.warc", b"".join(plain))):
        (tmp_path / name).write_bytes(data)
        for payloads in (True, False):
            with fs.LocalFileSystem().open_input_file(str(tmp_path / name)) as source:
                got = list(warc.records(warc._Stream(source), lambda h: h["warc-record-id"] != "<urn:page:1:x>", payloads))
            assert [h["warc-record-id"] for h, _ in got] == ["<urn:page:0:x>", "<urn:page:2:x>"]
            assert all(b.startswith(b"HTTP/1.1 200 OK") for _, b in got)
            assert not payloads or [b[-50_000:] for _, b in got] == [b"A" * 50_000, b"C" * 50_000]


def test_empty_table_and_extra_columns(spark, tmp_path):
    assert warc.read(spark, written(spark, tmp_path, [])).count() == 0
    (tmp_path / "b").mkdir()
    schema = "page_id bigint, url string, html string, payload int, kept string, record_type string"
    path = written(spark, tmp_path / "b", [(1, "u", "h", 3, "k", "z")], schema)
    assert [(r["record_type"], r["payload_bytes"]) for r in warc.read(spark, path).collect()] == [("response", 1)]


def test_only_committed_files_are_read(spark, tmp_path):
    path = written(spark, tmp_path, [(1, "u", "h")])
    (tmp_path / "archive" / "pages-lost.warc.gz").write_bytes(b"half a record")
    assert warc.read(spark, path).count() == 1


def pages(found):
    return sorted(int(r["record_id"].split(":")[2]) for r in found.select("record_id").collect())


def test_commits_add_up_and_overwriting_replaces_them(spark, tmp_path):
    path = written(spark, tmp_path, [(1, "u", "a"), (2, "u", "b")])
    more = spark.createDataFrame([(3, "u", "c")], "page_id bigint, url string, html string")
    warc.archive(more, path)
    assert pages(warc.read(spark, path)) == [1, 2, 3]
    warc.archive(more.withColumn("page_id", F.lit(4)), path, mode="overwrite")
    assert pages(warc.read(spark, path)) == [4]
    warc.archive(more, path)
    assert pages(warc.read(spark, path)) == [3, 4]


def foreign(kind, n, block, content_type):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{n}:x>\r\nContent-Type: {content_type}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def test_folders_made_elsewhere_are_read(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    http = b"HTTP/1.1 200 OK\r\nContent-Length: 99\r\n\r\nhello"
    some = [foreign("warcinfo", 0, b"software: x\r\n\r\nmore", "application/warc-fields"), foreign("response", 1, http, "application/http; msgtype=response")]
    (tmp_path / "in" / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in some))
    (tmp_path / "in" / "deep" / "b.warc").write_bytes(foreign("response", 2, b"HTTP/1.1 200 OK\r\n\r\n", "application/http"))
    (tmp_path / "in" / "other.txt").write_text("none")
    for payloads in (True, False):
        found = warc.read(spark, f"file://{tmp_path}/in", payloads).collect()
        got = {r["record_id"].split(":")[2]: (r["record_type"], r["payload_bytes"], r["payload"] and bytes(r["payload"])) for r in found}
        assert got["1"] == ("response", 5, b"hello" if payloads else None)
        assert got["2"][:2] == ("response", 0) and got["0"][:2] == ("warcinfo", 19)


def test_a_payload_larger_than_a_batch(spark, tmp_path):
    df = spark.range(6).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.when(F.col("id") == 3, F.repeat(F.lit("0123456789abcdef"), 1_200_000)).otherwise(F.repeat(F.sha2(F.col("id").cast("string"), 256), 100)).alias("html"),
    )
    path = f"file://{tmp_path}/archive"
    warc.archive(df.coalesce(1), path)
    large = warc.read(spark, path).filter("payload_bytes > 16000000").select("payload_bytes", F.sha1("payload").alias("d"), "payload_digest").collect()
    assert [(r["payload_bytes"], r["d"] == r["payload_digest"]) for r in large] == [(19_200_000, True)]


def test_files_are_read_in_parts_from_known_starts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "_MARK", 3000)
    (tmp_path / "a").mkdir()
    rows = [{"record_type": "response", "record_id": f"<urn:page:{i}:x>", "target_uri": "u", "refers_to": None, "payload_digest": "x",
             "payload_bytes": 1000, "payload": os.urandom(1000)} for i in range(60)]
    import pyarrow as pa

    writer = warc.WarcWriter(f"{tmp_path}/a", False)
    writer.commit([writer.write(iter([pa.RecordBatch.from_pylist(rows)]))])
    for tasks in (1, 4, 1000):
        reader = warc.WarcReader(f"{tmp_path}/a", True, tasks)
        planned = reader.partitions()
        read = [r["record_id"] for part in planned for batch in reader.read(part) for r in batch.to_pylist()]
        assert sorted(read) == sorted(r["record_id"] for r in rows)
        assert len(planned) == 1 if tasks == 1 else 4 <= len(planned) <= 20
