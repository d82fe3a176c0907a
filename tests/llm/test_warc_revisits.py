"""Archives by exact round trip and by a reader of their bytes; revisits against grouping by hand."""

from __future__ import annotations

import glob
import gzip
import hashlib
import re

import pytest
from oracle import differences
from pyspark.sql import functions as F

from lustra.llm import warc_revisits
from lustra.llm.queries import op13_warc_revisits
from lustra.llm.warc_revisits import deduplicate, many_to_one, oracle_sql, read_archives, resolved, write_archives

NASTY = "☃ é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3
ROWS = [
    (5, "http://a/5", NASTY),
    (2, "http://a/2 \r\nInjected: yes", NASTY),
    (9, None, NASTY),
    (None, "http://a/none", NASTY),
    (1, "http://a/1", None),
    (3, "http://a/3", ""),
    (4, "", "short"),
    (6, "http://a/6", "short"),
    (7, "http://a/7", "y" * 99),
    (8, "http://a/8", "y" * 99),
    (10, "http://a/10", "y" * 100),
    (11, "http://a/é", "y" * 100),
    (12, "http://a/12", "long" * 300_000),
    (12, "http://a/12", "long" * 300_000),
    (13, "http://a/13", "\r\n\r\n" * 40),
]


def pages(spark, rows=ROWS):
    schema = "page_id long, url string, html string, payload string, record_id string, first string"
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], schema)


def folders(tmp_path):
    return str(tmp_path / "captured"), str(tmp_path / "kept")


def records_of(folder: str) -> list[tuple[dict, bytes]]:
    """Records by Content-Length alone, as any reader of such archives finds them."""
    found = []
    for path in glob.glob(f"{folder}/*.gz"):
        data = gzip.open(path).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(line.split(": ", 1) for line in lines[1:])
            assert len(fields) == len(lines) - 1
            n = int(fields["Content-Length"])
            assert rest[n : n + 4] == b"\r\n\r\n"
            found.append((fields, rest[:n]))
            data = rest[n + 4 :]
    return found


def by_hand(rows):
    out = []
    for i, (page, _, html) in enumerate(rows):
        payload = (html or "").encode()
        same = [j for j, r in enumerate(rows) if (r[2] or "").encode() == payload]
        ids = [rows[j][0] for j in same if rows[j][0] is not None]
        again = len(payload) >= 100 and len(same) > 1 and (page is None or page > min(ids))
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(), again, min(ids) if again else None))
    return out


def test_round_trip_and_revisits(spark, tmp_path):
    captured, kept = folders(tmp_path)
    write_archives(pages(spark).repartition(3), captured)
    read = read_archives(spark, captured)
    assert sorted(map(str, ((r.page_id, r.payload) for r in read.collect()))) == sorted(
        str((p, h or "")) for p, _, h in ROWS
    )
    deduplicate(spark, captured, kept)
    rows = resolved(read_archives(spark, kept), with_payload=True).collect()
    plain = [r for r in rows if r.page_id != 12]
    want = [r for r in by_hand(ROWS) if r[0] != 12]
    have = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type == "revisit", r.refers_to) for r in plain]
    assert sorted(map(str, have)) == sorted(map(str, want))
    assert all(hashlib.sha256(r.payload.encode()).hexdigest() == r.payload_digest for r in rows)
    twins = [r for r in rows if r.page_id == 12]
    assert sorted((r.record_type, r.refers_to) for r in twins) == [("response", None), ("revisit", 12)]


def test_bytes_are_an_archive_with_fresh_headers(spark, tmp_path):
    captured, kept = folders(tmp_path)
    write_archives(pages(spark).repartition(2), captured)
    deduplicate(spark, captured, kept)
    old, new = records_of(captured), records_of(kept)
    assert len(old) == len(new) == len(ROWS)
    ids = {fields["WARC-Record-ID"]: fields for fields, _ in new}
    assert len(ids) == len(ROWS) and not ids.keys() & {fields["WARC-Record-ID"] for fields, _ in old}
    assert all("Injected" not in fields for fields, _ in new)
    assert sum(len(block) for _, block in new) < sum(len(block) for _, block in old) - 1_200_000
    for fields, block in new:
        digest = fields["WARC-Payload-Digest"]
        if fields["WARC-Type"] == "revisit":
            original = ids[fields["WARC-Refers-To"]]
            assert original["WARC-Type"] == "response" and original["WARC-Payload-Digest"] == digest
            assert fields["WARC-Refers-To-Date"] == original["WARC-Date"]
            assert fields.get("WARC-Refers-To-Target-URI") == original.get("WARC-Target-URI")
            assert block.endswith(b"\r\n\r\n") and block.startswith(b"HTTP/1.1 200 OK\r\n")
        else:
            payload = block.partition(b"\r\n\r\n")[2]
            assert "sha256:" + hashlib.sha256(payload).hexdigest() == digest


def test_torn_archives_raise(spark, tmp_path):
    captured, torn = folders(tmp_path)
    write_archives(pages(spark).coalesce(1), captured)
    data = gzip.open(glob.glob(f"{captured}/*.gz")[0]).read()
    (tmp_path / "kept").mkdir()
    for text in (data[:-30], re.sub(b"yyyy", b"yzyy", data, count=1)):
        with gzip.open(f"{torn}/part.txt.gz", "w") as out:
            out.write(text)
        with pytest.raises(Exception, match="torn record"):
            read_archives(spark, torn).collect()


def test_no_pages(spark, tmp_path):
    captured, kept = folders(tmp_path)
    write_archives(pages(spark, []), captured)
    deduplicate(spark, captured, kept)
    assert resolved(read_archives(spark, kept)).count() == 0


def test_hot_keys_keep_all_rows(spark, monkeypatch):
    monkeypatch.setattr(warc_revisits, "_HOT_ROWS", 50)
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 > 0, F.col("id") % 40).alias("k"), "id")
    one = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    want = sorted(map(str, many.join(one, "k", "left").collect()))
    assert sorted(map(str, many_to_one(many, one, "k").collect())) == want


def test_query_matches_oracle(spark):
    assert differences(spark, op13_warc_revisits, oracle_sql(), "/root/testdata/sf0.001") is None
