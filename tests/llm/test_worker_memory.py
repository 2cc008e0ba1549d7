import platform
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlake.llm import decontam, langid, texts


def test_tasks_that_keep_nothing_let_go_of_an_earlier_operators_memory(spark):
    def keep(parts):
        texts.per_worker(("language", "some"), lambda: [0])
        yield from parts

    docs = spark.range(64).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text")).repartition(8)
    docs.mapInArrow(keep, docs.schema).count()

    def make():
        return lambda rows: [{"held": len(texts._held)} for _ in rows]

    found = texts.annotate(docs, ["doc_id"], "found", "held int", make)
    assert {r.found.held for r in found.collect()} == {0}
    texts.per_worker(("language", "some"), lambda: [0])
    list(decontam._searcher(None)(iter(())))
    assert not texts._held


def test_kept_scorers_stay_from_task_to_task(spark):
    docs = spark.range(64).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text")).repartition(8)

    def make():
        texts.per_worker(("language", "other"), lambda: [0])
        return lambda rows: [{"held": len(texts._held)} for _ in rows]

    found = texts.annotate(docs, ["doc_id"], "found", "held int", make, keeps=True)
    assert {r.found.held for r in found.collect()} == {1}


def test_stages_send_texts_to_workers_in_bounded_batches(spark, sf_dir):
    def sizes(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array([part.num_rows]), pa.array([part.nbytes])], ["rows", "size"])

    session = spark.newSession()
    session.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = session.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    corpus_pipeline.without_benchmark(session, docs, sf_dir)
    rows = session.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000))
    found = rows.mapInArrow(sizes, "rows long, size long").collect()
    assert sum(r.rows for r in found) == 3000
    assert max(r.size for r in found) < 2 * texts.BATCH_BYTES
    session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    texts.bounded_batches(session)
    assert session.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="another C library gives memory back in its own way")
def test_released_memory_goes_back_to_the_system():
    def resident():
        return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

    before = resident()
    texts.per_worker(("language", "large"), lambda: [np.ones(8000) for _ in range(2000)])
    later = np.ones(8000)  # lies above what is let go of
    assert resident() > before + 100
    texts.release()
    assert resident() < before + 40 and later[0] == 1


def test_new_words_are_scored_in_little_memory():
    model = langid.estimate({"a": {"\x01\x01\x01k": 2, "\x01\x01ka": 1}, "b": {"\x01\x01\x01m": 3, "\x01\x01mo": 1}})
    words = [f"{chr(97 + k % 26)}{k:x}word".translate({48 + d: 107 + d for d in range(10)}) for k in range(60_000)]
    score = langid._scorer(model, langid._verdict)
    score(["ka mo"])
    tracemalloc.start()
    try:
        said = score([" ".join(words)])
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    alone = langid._scorer(model, langid._verdict)
    for at in range(0, len(words), 7000):
        alone([" ".join(words[at : at + 7000])])
    assert said == alone([" ".join(words)])
    assert most < 60e6
