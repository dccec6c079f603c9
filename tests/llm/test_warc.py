from __future__ import annotations

import hashlib
import io
import os
import random

import pytest

from reviewmill.llm import warc as W

PAGES = "page_id bigint, url string, html string"


def member(i, payload=b"x"):
    return W.record_member([("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:page:{i}>")], payload, 1)


def ids(data, split):
    out = []
    for start in range(0, max(len(data), 1), split):
        out += [int(f["warc-record-id"][10:-1]) for f, _ in W.records_between(io.BytesIO(data), start, start + split)]
    return out


@pytest.mark.parametrize("split", [1, 37, 500, 4096, 1 << 20])
def test_every_record_belongs_to_one_range(split, monkeypatch):
    monkeypatch.setattr(W, "READ_BYTES", 256)
    data = b"".join(member(i, os.urandom(i * 53)) for i in range(12))
    assert ids(data, split) == list(range(12))


def test_damage_and_false_magic():
    nested = member(100, b"inside") + b"tail"
    parts = [member(0), b"garbage" + W.MAGIC + b"\0\0", member(1, nested), W.MAGIC * 3, member(2)]
    data = b"".join(parts)
    assert ids(data, 1 << 20) == ids(data, 64) == [0, 1, 2] or ids(data, 64) == [1, 2]
    cut = member(5) + member(6, os.urandom(500))[:-100]
    assert ids(cut, 1 << 20) in ([5], [])
    assert ids(b"", 10) == ids(b"no gzip here", 10) == []


def test_header_values():
    text = "http://a/b%0Ac\r\nWARC-Type: x é"
    fields, payload = W.parse_record(W.zlib.decompress(W.record_member([("WARC-Target-URI", W.header_value(text))], b"\r\n\r\n", 1), 31))
    assert W.plain_value(fields["warc-target-uri"]) == text and payload == b"\r\n\r\n"


def rows():
    long = "<p>ä</p>" * 40
    draw = random.Random(1)
    out = [(i, f"http://h/{i}", "".join(draw.choice("abc<>é") for _ in range(draw.randint(0, 3000)))) for i in range(40)]
    out += [(100, None, long), (50, "http://x/\n", long), (70, "", long), (200, "u", "short"), (201, "u", "short"), (202, "u", None), (203, "u", "")]
    return out + [(None, "n", long), (None, "n", "lonely " * 30), (50, "again", long), (300, "big", "z" * 2_000_000)]


@pytest.mark.parametrize("split", [300, 4 << 20])
def test_round_trip(spark, stage, split):
    pages = spark.createDataFrame(rows(), PAGES).selectExpr("*", "'x' as digest", "1 as payload", "2 as first").repartition(3)
    got = sorted(map(tuple, W.round_trip(pages, stage, split).collect()), key=str)
    expected = []
    for i, _, html in rows():
        data = (html or "").encode()
        same = [p for p, _, h in rows() if (h or "").encode() == data and p is not None]
        first = min(same, default=None)
        again = len(data) >= 100 and first is not None and first != i
        expected.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(expected, key=str)


def test_archives_roll_and_only_listed_files_count(spark, stage):
    pages = spark.createDataFrame([(i, "u", "text " * 200 + str(i)) for i in range(50)], PAGES).coalesce(1)
    records = pages.selectExpr(
        "concat('urn:page:', page_id) as record_id", "'response' as record_type", "url as target_uri", "cast(null as string) as refers_to",
        "sha2(html, 256) as digest", "cast(html as binary) as payload",
    )
    folder = W.qualified(spark, stage.path("rolled"))
    manifest = stage.put(W.write_archives(records, folder, archive_bytes=500), "manifest")
    assert manifest.count() > 5
    with open(folder.removeprefix("file://") + "/left-by-a-lost-task.warc.gz", "wb") as stray:
        stray.write(member(9))
    read = W.read_archives(manifest, 100).collect()
    assert len(read) == 50 and {bytes(r["payload"]).decode() for r in read} == {"text " * 200 + str(i) for i in range(50)}


def test_empty(spark, stage):
    assert W.round_trip(spark.createDataFrame([], PAGES), stage).count() == 0


def test_whole_members_beside_damage_are_read():
    first, second, third = member(0), member(1), member(2, os.urandom(500))
    broken = bytearray(third)
    broken[len(third) // 2] ^= 255
    for split in (16, 64, 1 << 20):
        assert ids(first + b"garbage" + second + third, split) == [0, 1, 2]
        assert ids(first + second + b"\0" * 8, split) == [0, 1]
        assert ids(first + second[:-1], split) == [0]
        assert ids(first + bytes(broken) + second, split) == [0, 1]


@pytest.mark.parametrize("split", [40, 700, 1 << 20])
def test_archives_inside_payloads_are_no_records(spark, stage, split):
    inner = member(8, b"in") + member(9, b"side")
    outer = W.record_member([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:1>")], os.urandom(900) + inner + os.urandom(900), 0)
    data = member(0) + outer + b"junk" + member(2)
    path = stage.path("archive")
    os.makedirs(path.removeprefix("file://"))
    path = W.qualified(spark, path)
    with open(path.removeprefix("file://") + "/a.warc.gz", "wb") as file:
        file.write(data)
    manifest = stage.put(spark.createDataFrame([(path + "/a.warc.gz", len(data))], "path string, bytes bigint"), "manifest")
    records = stage.put(W.read_archives(manifest, split).drop("payload"), "found").transform(W.outermost, split)
    assert sorted(r["record_id"] for r in records.collect()) == ["urn:page:0", "urn:page:1", "urn:page:2"]
    assert [r["passed_over"] for r in W.passed_over(manifest, records).collect()] == [4]


def test_ranges_are_dealt_by_number(spark, stage):
    manifest = stage.put(spark.createDataFrame([("a", 5000), ("b", 10)], "path string, bytes bigint"), "manifest")
    plan = W.read_archives(manifest, 100)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(51)" in plan and "REPARTITION_BY_NUM" in plan
