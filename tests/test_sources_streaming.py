import json

import pytest
from pyspark.sql import functions as F

from cohortlake import schema
from cohortlake.fixtures import students
from cohortlake.operators import records
from cohortlake.plans import cases
from cohortlake.sources import batches, delimited, messages
from cohortlake.streaming import ingest

RECORD = {name: 1 if kind == "int" else 1.5 for name, _, kind in schema.NUMERIC_FIELDS}
RECORD |= {"target": "Graduate", "event_id": "0_1", "event_ts_ms": 5}


def text(**changes):
    return json.dumps({k: v for k, v in (RECORD | changes).items() if v is not ...})


GOOD = [
    text(),
    " " + text() + "\n",
    text(note="a: [b] {c}"),
    text(note=[1, {"x": "]"}]),
    text(event_id=..., event_ts_ms=...),
    text(gdp=3),
    text(target="a:b]"),
    text()[:-1] + ', "note": 1, "note": 2}',
    text(target="ünï \" \\ ]"),
]
BAD = [
    text(gdp=...),
    text(target=...),
    text(gender=1.5),
    text(gender=1.0),
    text(gender="1"),
    text(gender=2**31),
    text(gender=None),
    text(gdp="2.5"),
    text(gdp="NaN"),
    text(gdp=float("nan")),
    text()[:-1] + ', "gdp": 1e400}',
    text(target=5),
    text(target=None),
    text(target={"a": 1}),
    text(event_id=None),
    text(event_id=7),
    text(event_ts_ms="x"),
    text(event_ts_ms=-1),
    text(event_ts_ms=None),
    text()[:-1] + ', "gender" : 1}',
    text(event_id=...)[:-1] + ', "gender": 1}',
    "not json",
    "",
    " ",
    "null",
    "[1, 2]",
    "[" + text() + "]",
    text() + " tail",
    text() + "]",
    text() + "] }",
    text() + "}",
    text() + "} ]",
    text() + text(),
    text() + "," + text(),
    text() + ",",
    text()[:-1],
    text().replace('"', "'"),
]


def test_strict_decoding(spark):
    rows = [(f"g{i}", v) for i, v in enumerate(GOOD)] + [(f"b{i}", v) for i, v in enumerate(BAD)]
    frame = spark.createDataFrame([*rows, ("n", None)], "key string, value string")
    decoded = messages.decode_json(frame).select("key", "valid").collect()
    assert len(decoded) == len(rows) + 1
    assert {r["key"] for r in decoded if r["valid"]} == {f"g{i}" for i in range(len(GOOD))}
    good, rejects = messages.decode_strict(frame)
    assert good.schema == schema.RECORD or good.columns == schema.RECORD.names
    assert rejects.columns == ["key", "value"] and rejects.count() == len(BAD) + 1
    assert good.filter("event_id = '' and event_ts_ms = 0").count() == 1


def test_message_sinks_without_a_broker(spark, tmp_path):
    sent = spark.createDataFrame([(1, "x")], "seq bigint, target string")
    encoded = messages.encode_messages(sent, F.col("seq"), ["target"])
    for sink, key in (("parquet", "1"), ("text", None)):
        path = str(tmp_path / sink)
        messages.write_messages(encoded, sink, path)
        back = messages.read_messages(spark, sink, path, streaming=False).collect()
        assert [tuple(r) for r in back] == [(key, '{"target":"x"}')]


def test_lenient_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(' Gender\t,GDP,Target,Extra\n1,2.5,"Gra""duate",z\nx,,,\n')
    frame = delimited.read_lenient_csv(spark, str(tmp_path / "a.csv"), file_order=True)
    rows = frame.orderBy(*delimited.FILE_ORDER).collect()
    assert [(r["gender"], r["gdp"], r["target"]) for r in rows] == [(1, 2.5, 'Gra"duate'), (0, 0.0, "null")]
    assert {r["marital_status"] for r in rows} == {0}
    assert frame.columns == [*schema.RAW_RECORD.names, *delimited.FILE_ORDER]


def test_missing_target_column_is_empty_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Gender\n1\n")
    assert delimited.read_lenient_csv(spark, str(tmp_path / "a.csv")).first()["target"] == ""


def test_normalize_keeps_quoted_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a;b\n"x,y";"say ""hi"""\n;2\n')
    delimited.normalize_delimited(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"))
    rows = delimited.read_cells(spark, str(tmp_path / "out")).collect()
    assert [tuple(r) for r in rows] == [("x,y", 'say "hi"'), (None, "2")]


def test_table_csv_blanks(spark, tmp_path):
    frame = spark.createDataFrame([(1, None)], "b int, a string")
    delimited.write_table_csv(frame.coalesce(1), str(tmp_path / "t"), ["a", "b", "c"])
    part = next((tmp_path / "t").glob("part-*.csv"))
    assert part.read_text() == "a,b,c\n,1,\n"


def test_batches(spark, tmp_path):
    path = str(tmp_path / "b")
    batches.write_batches(spark.range(2500).coalesce(1), path, rows_per_file=1000)
    assert sorted(r["rows"] for r in batches.rows_per_file(spark, path).collect()) == [500, 1000, 1000]
    batches.write_batches(spark.range(3), path)
    assert batches.scan_parquet(spark, path).count() == 3
    batches.assert_nonempty(spark, path)


def test_missing_and_empty_outputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        batches.scan_parquet(spark, str(tmp_path / "none"))
    (tmp_path / "hollow").mkdir()
    for name in ("none", "hollow"):
        with pytest.raises(batches.EmptyOutputError):
            batches.assert_nonempty(spark, str(tmp_path / name))
    batches.write_batches(spark.range(0), str(tmp_path / "zero"))
    with pytest.raises(batches.EmptyOutputError):
        batches.assert_nonempty(spark, str(tmp_path / "zero"))


def test_unsigned_times_are_read_as_bigint(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    table = pa.table({"event_ts_ms": pa.array([5], pa.uint64())})
    pq.write_table(table, tmp_path / "u.parquet")
    frame = batches.scan_parquet(spark, str(tmp_path / "u.parquet"))
    assert frame.dtypes == [("event_ts_ms", "bigint")] and frame.first()[0] == 5


def test_stream_equals_batch_and_resumes(spark, sf_dir, tmp_path):
    inbox, out, mark, bad = (str(tmp_path / n) for n in ("in", "out", "mark", "bad"))
    sent = cases.spoiled_messages(students(spark, sf_dir).filter("event_seq < 600"))
    sent.filter("cast(key as int) < 300").write.parquet(inbox)

    def run():
        stream = messages.read_messages(spark, "parquet", inbox, maxFilesPerTrigger=1)
        return ingest.drain(ingest.stream_ingest(stream, out, mark, extra=("event_id",)))

    first = run()
    sent.filter("cast(key as int) >= 300").write.mode("append").parquet(inbox)
    second, third = run(), run()
    assert (first.received, second.received, third.received) == (300, 300, 0)
    batch = records.project_record(records.enrich(messages.decode_strict(sent)[0]), ["event_id"])
    stored = batches.scan_parquet(spark, out).select(*batch.columns)
    assert stored.exceptAll(batch).isEmpty() and batch.exceptAll(stored).isEmpty()
    assert first.kept + second.kept == stored.count() and first.dropped > 0

    stream = messages.read_messages(spark, "parquet", inbox)
    ingest.drain(ingest.stream_rejects(stream, bad, str(tmp_path / "bad-mark")))
    assert spark.read.parquet(bad).count() == first.dropped + second.dropped


def test_live_stream_stops_when_idle(spark, tmp_path):
    spark.createDataFrame([("1", text())], "key string, value string").write.parquet(str(tmp_path / "in"))
    stream = messages.read_messages(spark, "parquet", str(tmp_path / "in"))
    running = ingest.stream_ingest(
        stream, str(tmp_path / "out"), str(tmp_path / "mark"), until_drained=False, interval="100 milliseconds"
    )
    counted = ingest.drain(running, idle_s=4.0, timeout_s=90)
    assert (counted.received, counted.kept) == (1, 1) and not running.isActive


def test_paced_replay(spark, tmp_path):
    import time

    from cohortlake.operators.replay import with_sequence
    from cohortlake.streaming.replay import replay_stream

    numbered = with_sequence(spark.createDataFrame([("a",), ("b",), ("c",)], "target string"), ["target"])
    stream = replay_stream(numbered, rate=5, iterations=2)
    out = str(tmp_path / "out")
    writer = stream.writeStream.format("parquet").option("path", out)
    query = writer.option("checkpointLocation", str(tmp_path / "mark")).start()
    deadline, found = time.monotonic() + 90, []
    while len(found) < 6 and time.monotonic() < deadline:
        time.sleep(1)
        if query.lastProgress is not None and (tmp_path / "out" / "_spark_metadata").exists():
            found = spark.read.schema(stream.schema).parquet(out).collect()
    query.stop()
    assert sorted((r["event_id"], r["target"]) for r in found) == [
        (f"{i}_{s}", t) for i in (0, 1) for s, t in enumerate("abc")
    ]
    times = [r["event_ts_ms"] for r in sorted(found, key=lambda r: (r["iteration"], r["seq"]))]
    assert all(later - earlier >= 190 for earlier, later in zip(times, times[1:]))
    with pytest.raises(ValueError):
        replay_stream(numbered, rate=0)


def test_messages_sent_again_are_stored_once(spark, sf_dir, tmp_path):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    sent = cases.spoiled_messages(students(spark, sf_dir).filter("event_seq < 600"))

    def run(arrived):
        arrived.write.mode("append").parquet(inbox)
        stream = messages.read_messages(spark, "parquet", inbox)
        return ingest.drain(ingest.stream_ingest(stream, out, mark, extra=("event_id",), once_within="1 minute"))

    again = sent.filter("cast(key as int) % 2 = 1")
    first, second = run(sent.unionByName(again)), run(again)
    good = messages.decode_strict(sent)[0].cache()
    unnamed = good.filter("event_id = ''").count()
    stored = batches.scan_parquet(spark, out)
    ids = [r["event_id"] for r in stored.collect()]
    named = sorted(i for i in ids if i)
    assert named == sorted(r["event_id"] for r in good.filter("event_id <> ''").collect())
    assert unnamed and len(ids) - len(named) == 3 * unnamed  # nothing tells these apart
    assert first.repeated > 0 and second.repeated > 0 and first.late == second.late == 0
    assert first.stored + second.stored == len(ids)
    batch = ingest.ingest(sent.unionByName(again), ("event_id",), once_within="1 minute").filter("event_id <> ''")
    assert batch.count() == len(named)


def test_late_records_are_counted(spark, tmp_path):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def run(*stamps):
        rows = [(str(t), text(event_ts_ms=t, event_id=f"e{t}")) for t in stamps]
        spark.createDataFrame(rows, "key string, value string").write.mode("append").parquet(inbox)
        stream = messages.read_messages(spark, "parquet", inbox)
        return ingest.drain(ingest.stream_ingest(stream, out, mark, once_within="1 second"))

    assert run(100_000, 200_000).stored == 2
    counted = run(100_001, 199_500)
    assert (counted.kept, counted.late, counted.repeated) == (2, 1, 0)
    assert batches.scan_parquet(spark, out).count() == 3


def test_retries_wait_longer_and_keep_their_counts(spark, tmp_path):
    """A source that fails twice: what earlier tries finished is counted once, in the end."""
    inbox, out, mark, bad = (str(tmp_path / n) for n in ("in", "out", "mark", "bad"))
    for k in range(4):
        spark.createDataFrame([(str(k), text())] * (k + 1), "key string, value string").coalesce(1).write.mode("append").parquet(inbox)
    pauses, starts = [], []

    def start():
        from pyspark.sql import functions as F

        starts.append(1)
        stream = messages.read_messages(spark, "parquet", inbox, maxFilesPerTrigger=1)
        if len(starts) <= 2:  # the second, or the next, batch breaks
            rotten = F.when(F.col("key").cast("int") >= 2, F.raise_error(F.lit("source lost"))).otherwise(F.col("value"))
            stream = stream.withColumn("value", rotten.cast("string"))
        return ingest.stream_ingest(stream, out, mark)

    counted = ingest.run_until_drained(start, tries=3, pause_s=0.5, sleep=pauses.append)
    assert len(starts) == 3 and pauses == [0.5, 1.0]
    stored = batches.scan_parquet(spark, out).count()
    assert (counted.received, counted.kept, stored) == (10, 10, 10)
    with pytest.raises(ValueError):
        ingest.run_until_drained(start, tries=0)


def test_lasting_errors_are_raised_at_once(spark, tmp_path):
    from pyspark.errors import StreamingQueryException
    from pyspark.sql import functions as F

    spark.createDataFrame([("1", text())], "key string, value string").write.parquet(str(tmp_path / "in"))
    pauses = []

    def start():
        stream = messages.read_messages(spark, "parquet", str(tmp_path / "in"))
        broken = F.raise_error(F.lit("AnalysisException: no such column")).cast("string")
        return ingest.stream_ingest(stream.withColumn("value", broken), str(tmp_path / "out"), str(tmp_path / "mark"))

    with pytest.raises(StreamingQueryException):
        ingest.run_until_drained(start, sleep=pauses.append)
    assert pauses == []
    with pytest.raises(StreamingQueryException):
        ingest.run_until_drained(start, tries=4, pause_s=3, longest_s=5, passing=lambda error: True, sleep=pauses.append)
    assert pauses == [3, 5, 5]
