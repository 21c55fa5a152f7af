"""WARC: what is written is read back, copies are revisits, and odd rows survive."""

import hashlib

from velotrace.llm import warc

SCHEMA = "page_id long, url string, html string"


def read_back(spark, pages, **options):
    path = warc.new_archive_folder(spark)
    warc.write_archives(pages, path, **options)
    return path, [r.asDict() for r in warc.read_archives(spark, path).collect()]


def test_types_digests_and_odd_rows(spark, frame):
    long, other = "é" * 600, "x\r\n\r\nWARC/1.1\r\n" * 100
    rows = [
        (1, "http://a/", long), (2, "http://b/\r\nX: y", long), (3, None, long), (4, "u", other),
        (None, "v", other), (5, "w", "short"), (6, "w", "short"), (7, "w", None), (8, "w", ""),
        (9, "w", "z" * 1000), (9, "w", "z" * 1000), (10, "w", "z" * 999), (11, "w", "z" * 999),
        (12, "big", "漢" * 700_000),
    ]
    path, got = read_back(
        spark, frame(SCHEMA + ", record string, payload_digest int", *[(*r, "r", 1) for r in rows]), file_bytes=50_000
    )
    assert len(got) == len(rows) and all(r["whole"] for r in got)
    want = []
    for page, url, html in rows:
        raw = (html or "").encode()
        want.append((page, len(raw), hashlib.sha1(raw).hexdigest(), url and url.replace("\r", "%0D").replace("\n", "%0A")))
    assert sorted(map(str, want)) == sorted(str((r["page_id"], r["payload_bytes"], r["payload_digest"], r["url"])) for r in got)
    kinds = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in got), key=str)
    assert (1, "revisit", 3) in kinds and (2, "revisit", 3) in kinds and (3, "response", None) in kinds
    assert (4, "response", None) in kinds and (None, "revisit", 4) in kinds
    assert (9, "response", None) in kinds and (9, "revisit", 9) in kinds
    assert sum(k == "revisit" for _, k, _ in kinds) == 4
    files = spark.read.format("binaryFile").load(path + "/*.gz").select("path")
    assert files.count() > 1


def test_many_copies_and_no_rows(spark, frame):
    rows = frame(SCHEMA, *[(i, f"u{i}", "same" * 400) for i in range(500)])
    _, got = read_back(spark, rows)
    assert sum(r["record_type"] == "response" for r in got) == 1
    assert {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {499}
    assert read_back(spark, spark.createDataFrame([], SCHEMA))[1] == []
