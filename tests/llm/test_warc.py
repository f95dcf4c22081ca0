import base64
import gzip
import hashlib
import io
import os
import uuid
from collections import defaultdict

import pytest
from inputs import FOLDER

from shelfmark.llm import warc
from shelfmark.llm.queries import QUERIES

ROWS = [
    (5, "u\r\nx", "a"), (3, "v", "a"), (3, "v", "a"), (3, "w", "a"), (9, None, None), (8, "w", ""), (None, "z", "q"),
    (None, "z", "q"), (1, "a", "é" * 5000), (2, "b", "\r\n\r\nWARC/1.1\r\n"), (4, "c", "x" * 3_000_000),
    *[(100 + i, "h", "hot") for i in range(300)],
]


def pages(spark, rows):
    """Pages with further columns of names that records use."""
    return spark.createDataFrame(
        [(i, u, h, "x", "y", 1, "z") for i, u, h in rows],
        "page_id long, url string, html string, payload string, record_type string, copy int, `a.b` string",
    )


def brute(rows, least=0):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[(html or "").encode()].append(i)
    out = []
    for body, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i))
        code = base64.b32encode(hashlib.sha1(body).digest()).decode()
        for place, i in enumerate(ids):
            first = place == 0 or len(body) < least
            out.append((i, len(body), code, "response" if first else "revisit", None if first else ids[0]))
    return sorted(out, key=repr)


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return lambda: str(tmp_path_factory.mktemp("warc") / uuid.uuid4().hex)


@pytest.mark.parametrize("least", [0, 2])
def test_pages_there_and_back(spark, folder, least):
    path = folder()
    warc.archive_pages(pages(spark, ROWS), path, least=least, file_bytes=20_000)
    assert result(warc.archived_pages(spark, path)) == brute(ROWS, least)


def test_no_pages(spark, folder):
    path = folder()
    warc.archive_pages(pages(spark, []), path)
    assert warc.archived_pages(spark, path).count() == 0


def test_expanded(spark):
    rows = spark.createDataFrame([("a", 1), ("b", (1 << 16) + 3)], "k string, copies long")
    got = warc._expanded(rows, "copies").groupBy("k").agg({"copy": "max", "*": "count"}).collect()
    assert sorted(map(tuple, got)) == [("a", 1, 1), ("b", 65539, 65539)]


def test_base32(spark):
    bodies = [os.urandom(20) for _ in range(50)]
    frame = spark.createDataFrame([(b,) for b in bodies], "b binary").select(
        "b", warc._base32(warc.F.sha1("b")).alias("d")
    )
    for row in frame.collect():
        assert row.d == "sha1:" + warc.digest(bytes(row.b))


def foreign(level, sl):
    """An archive of another writer: plain, or compressed without lengths in the gzip headers."""
    out = b""
    for i, kind in enumerate(["warcinfo", "response", "request", "response", "metadata"]):
        block = (b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" if kind == "response" else b"") + bytes([65 + i]) * (i * 50_000)
        head = (
            f"WARC/1.0\r\nWARC-Type: {kind}\r\nwarc-record-id: <r:{i}>\r\nX-Folded: a\r\n  b\r\n"
            + ("Content-Type: application/http; msgtype=response\r\n" if kind == "response" else "")
            + f"Content-Length: {len(block)}\r\n\r\n"
        )
        record = head.encode() + block + b"\r\n\r\n"
        out += gzip.compress(record, level) if sl else record
    return out


@pytest.mark.parametrize("packed", [True, False])
def test_foreign_archives(spark, folder, packed):
    path = folder()
    os.makedirs(path)
    data = foreign(6, packed)
    with open(f"{path}/x.warc" + ".gz" * packed, "wb") as file:
        file.write(data)
    with open(f"{path}/other.txt", "w") as file:
        file.write("no archive")
    rows = warc.read_warc(spark, path, "record_type string, record_id string, x_folded string, block_length long, payload binary").collect()
    assert [(r.record_type, r.record_id, r.x_folded) for r in rows] == [
        (k, f"<r:{i}>", "a b") for i, k in enumerate(["warcinfo", "response", "request", "response", "metadata"])
    ]
    assert [bytes(r.payload) for r in rows] == [bytes([65 + i]) * (i * 50_000) for i in range(5)]
    with open(f"{path}/x.warc" + ".gz" * packed, "wb") as file:
        file.write(data[:-30_000] if not packed else data[:-60])
    with pytest.raises(Exception, match="cut off|no record"):
        warc.read_warc(spark, path).collect()


def test_payloads_not_wanted_are_not_read():
    """Of a record whose length is known only the beginning is read."""
    data = b"".join(
        warc.encoded({"WARC-Type": kind}, os.urandom(1 << 20), 0) for kind in ["response", "metadata", "response"]
    )

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            got = super().read(n)
            Counted.taken += len(got)
            return got

    found = list(warc.records(Counted(data), len(data), lambda f: f["warc-type"] == "metadata", False))
    assert [f["warc-type"] for f, _ in found] == ["metadata"] and Counted.taken < len(data) // 10
    assert len(list(warc.records(io.BytesIO(data), len(data), lambda f: True, True))) == 3


def test_filters_are_pushed_down(spark, folder):
    path = folder()
    warc.archive_pages(pages(spark, ROWS), path)
    want = warc.read_warc(spark, path).where("record_type = 'response' and target_uri like 'v%'").count()
    with warc.pushing_down(spark):
        frame = warc.read_warc(spark, path, "record_type string, target_uri string, page_id string, n long").where(
            "record_type in ('response', 'x') and target_uri like 'v%' and page_id is not null"
        )
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "Filter" not in text.replace("RuntimeFilters", "") and frame.count() == want == 1
        kept = warc.read_warc(spark, path, "page_id string, record_type string").where("page_id > '2' or record_type = 'x'")
        assert kept.count() == sum(1 for i, *_ in ROWS if i is not None and str(i) > "2")
    assert spark.conf.get(warc.PUSHDOWN) == "false"


def test_only_committed_files_are_read(spark, folder):
    path = folder()
    warc.archive_pages(pages(spark, ROWS[:4]), path)
    with open(f"{path}/part-lost-0000.warc.gz", "wb") as file:  # of a lost executor
        file.write(warc.encoded({"WARC-Type": "response"}, b"x", 1)[:-9])
    assert warc.archived_pages(spark, path).count() == 4
    warc.archive_pages(pages(spark, ROWS[4:6]), path)
    assert warc.archived_pages(spark, path).count() == 6
    failing = warc.page_records(pages(spark, ROWS[:2])).withColumn("boom", warc.F.raise_error(warc.F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        warc.write_warc(failing, path, "overwrite")
    assert warc.archived_pages(spark, path).count() == 6
    warc.write_warc(warc.page_records(pages(spark, ROWS[6:8])), path, "overwrite")
    assert result(warc.archived_pages(spark, path)) == brute(ROWS[6:8])
    assert not os.path.exists(f"{path}/part-lost-0000.warc.gz")


def test_wrong_digest(spark, folder):
    path = folder()
    rows = spark.createDataFrame([("response", "sha1:AAAA", "x")], "record_type string, payload_digest string, payload string")
    warc.write_warc(rows, path)
    assert warc.read_warc(spark, path).where("record_type = 'response'").count() == 1
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_warc(spark, path, verify=True).collect()


def test_files_to_partitions(tmp_path):
    for i, size in enumerate([10, 20, 500, 30, 40]):
        (tmp_path / f"{i}.warc").write_bytes(b"x" * size)
    reader = warc.WarcReader({"path": str(tmp_path), "partition_bytes": 75}, None)
    assert [[s for _, s in p.paths] for p in reader.partitions()] == [[10, 20], [500], [30, 40]]


def test_query(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    got = QUERIES["op11_warc"](spark, FOLDER).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert result(got) == brute(rows)
