import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from cohortlake.llm import warc

REPLICAS = ["a", "b", "c"]


def record(k, size=200):
    body = (f"record {k} " * size)[:size].encode()
    return b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)


@pytest.fixture
def copies(spark):
    """Three replicas as {(replica, file, offset): bytes}, and a function that makes their table."""
    held = {}
    for file, count in (("x.warc", 900), ("y.warc", 3), ("z.warc", 1)):
        at = 0
        for k in range(count):
            for replica in REPLICAS:
                held[replica, file, at] = record(k, 100 + k % 50)
            at += len(record(k, 100 + k % 50))

    def table(more=()):
        rows = [(r, f, o, bytearray(b) if b is not None else None) for (r, f, o), b in held.items()] + list(more)
        return spark.createDataFrame(rows, "replica string, file string, offset long, record binary")

    return held, table


def test_intact_replicas_agree_at_the_roots(copies, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 1024)
    _, table = copies
    assert warc.audit(warc.leaves(table()), REPLICAS).count() == 0


def test_damage_is_located_below_the_differing_branches(copies, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 1024)
    held, table = copies
    places = sorted(o for r, f, o in held if (r, f) == ("a", "x.warc"))
    first, lost, twice = places[3], places[500], places[899]
    held["b", "x.warc", first] = held["b", "x.warc", first].replace(b"record", b"rEcord")
    del held["c", "x.warc", lost]
    held["a", "x.warc", twice] = b"one"
    held["c", "x.warc", twice] = b"two"
    held["b", "y.warc", 10_000_000] = b"surplus"
    held["b", "z.warc", 0] = None
    repeated = ("a", "x.warc", places[7], bytearray(held["a", "x.warc", places[7]]))
    ignored = [("d", "x.warc", 0, bytearray(b"?")), (None, "x.warc", 0, None), ("a", None, 0, None), ("a", "x.warc", None, None)]
    frame = table([repeated, *ignored]).withColumns({c: F.lit(1) for c in ("node", "digest", "range", "below", "n", "length")})
    rows = {(r.replica, r.file, r.offset): (r.length, r.state) for r in warc.audit(warc.leaves(frame), REPLICAS).collect()}
    whole = len(held["b", "x.warc", twice])
    assert rows == {
        ("b", "x.warc", first): (len(held["b", "x.warc", first]), "changed"),
        ("c", "x.warc", lost): (len(held["a", "x.warc", lost]), "missing"),
        ("b", "x.warc", twice): (whole, "changed"),  # three opinions: the first replica is right
        ("c", "x.warc", twice): (3, "changed"),
        ("b", "y.warc", 10_000_000): (7, "extra"),
        ("b", "z.warc", 0): (len(held["a", "z.warc", 0]), "changed"),
        ("a", "x.warc", places[7]): (len(held["a", "x.warc", places[7]]), "extra"),
    }


def test_trees_have_one_root_per_file_and_replica(copies, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 1024)
    _, table = copies
    levels = warc.build_trees(warc.leaves(table()))
    assert levels[-1].count() == 9 and len(levels) > 2
    widths = levels[0].groupBy("replica", "file", F.expr(f"node div {warc.FAN_OUT}")).count().agg(F.max("count")).first()[0]
    assert widths <= warc.FAN_OUT


def test_empty_tables_and_null_pages(spark):
    empty = spark.createDataFrame([], "replica string, file string, offset long, record binary")
    assert warc.audit(warc.leaves(empty), REPLICAS).count() == 0
    pages = spark.createDataFrame(
        [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (2, None, None), (None, "v", "x"), (None, None, None), (700, "w", "é")],
        "page_id long, url string, html string",
    ).withColumns({"file": F.lit("clash"), "record": F.lit(0)})
    rows = warc.archive_pages(pages).orderBy("file", "offset").collect()
    assert len(rows) == 6 and len({(r.file, r.offset) for r in rows}) == 6
    assert [r.offset for r in rows if r.file == "pages-0.warc"][0] == 0
    for r in rows:  # every record parses back to itself
        assert list(warc.split_records(bytes(r.record))) == [(0, bytes(r.record))]


def test_files_are_read_plain_and_compressed(spark, tmp_path):
    records = [record(k) for k in range(5)]
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    (tmp_path / "packed.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "empty.warc").write_bytes(b"")
    (tmp_path / "cut.warc").write_bytes(records[0] + records[1][:30])
    rows = warc.read_warc(spark, str(tmp_path)).orderBy("file", "offset").collect()
    found = {}
    for r in rows:
        found.setdefault(r.file, []).append(bytes(r.record))
    assert found == {"plain.warc": records, "packed.warc.gz": records, "cut.warc": [records[0], records[1][:30]]}
    assert hashlib.sha256(found["plain.warc"][2]).hexdigest() == warc.leaves(
        spark.createDataFrame([("a", "f", 0, bytearray(records[2]))], "replica string, file string, offset long, record binary")
    ).first().digest


def test_damaged_members_are_reported_and_the_rest_is_read(spark, tmp_path):
    members = [gzip.compress(record(k, 70_000), mtime=0) for k in range(5)]
    whole = b"".join(members)
    starts = [sum(map(len, members[:k])) for k in range(5)]
    assert [(at, r) for at, r in warc.split_records(whole)] == [(s, record(k, 70_000)) for k, s in enumerate(starts)]
    for flipped in (starts[2] + 30, starts[2] + len(members[2]) // 2, starts[2] + len(members[2]) - 5):
        broken = bytearray(whole)
        broken[flipped] ^= 0xFF
        found = dict(warc.split_records(bytes(broken)))
        assert {at: r for at, r in found.items() if at in starts and at != starts[2]} == {
            s: record(k, 70_000) for k, s in enumerate(starts) if k != 2
        }
        assert found[starts[2]] != record(2, 70_000)
    cut = dict(warc.split_records(whole[:-9]))
    assert list(cut) == starts and cut[starts[4]] == members[4][:-9]

    rows = []
    for replica in REPLICAS:
        folder = tmp_path / replica
        folder.mkdir()
        (folder / "p.warc.gz").write_bytes(bytes(broken) if replica == "b" else whole)
        rows.append(warc.read_warc(spark, str(folder)).withColumn("replica", F.lit(replica)))
    audited = warc.audit(warc.leaves(rows[0].unionByName(rows[1]).unionByName(rows[2])), REPLICAS).collect()
    assert {(r.replica, r.offset) for r in audited} == {("b", starts[2])}


def test_many_members_take_linear_time():
    import time

    whole = gzip.compress(record(1, 50), mtime=0) * 60_000
    began = time.process_time()
    assert sum(1 for _ in warc.split_records(whole)) == 60_000
    assert time.process_time() - began < 30
