"""Phrase mining against plain counting."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlake.llm import collocations
from cohortlake.llm.texts import BATCH_BYTES

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, best=collocations.BEST):
    """rows are (text, lang)."""
    counts, size = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            size[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= 30}
        covered = set()
        for p, a in often.items():
            for m in range(2, len(p)):
                for s in range(len(p) - m + 1):
                    if 100 * a >= 80 * f[p[s : s + m]]:
                        covered.add(p[s : s + m])
        rows = []
        for p, a in often.items():
            if p not in covered:
                score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), a, l, r))
        for rank, (score, _, phrase, a, l, r) in enumerate(sorted(rows)[:best]):
            out.append((lang, rank + 1, phrase.decode(), a, l, r, size[lang], -score))
    return sorted(out)


def mined(spark, docs_of, rows, best=collocations.BEST):
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    found = collocations.phrases(docs.repartition(3), best).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found)


@pytest.fixture(scope="module")
def spoken():
    draw = random.Random(2)
    words = [f"w{k}" for k in range(40)] + ["the", "of"]
    weight = [1 / (k + 1) for k in range(40)] + [3, 3]
    rows = []
    for i in range(300):
        said = draw.choices(words, weight, k=40)
        said[10:10] = ["new", "York", "city"] if i % 3 else ["new", "york", "city", "hall"]
        said[30] += draw.choice([".", ",", "\n", "!", ""])
        rows.append((" ".join(said), ["a", "b", None][i % 3]))
    return rows


def test_whole_table_against_counting(spark, docs_of, sf_dir):
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = mined(spark, docs_of, rows)
    assert found and found == brute(rows)


def test_small_chunks_many_buckets_and_hot_words(spark, docs_of, spoken, monkeypatch):
    for name, value in (("CHUNK_WORDS", 500), ("BUCKET_SUFFIXES", 400), ("HOT", 150)):
        monkeypatch.setattr(collocations, name, value)
    assert mined(spark, docs_of, spoken) == brute(spoken)


def test_cut_of_the_list_and_ties(spark, docs_of):
    pairs = [f"{a}x {a}y" for a in "zyxwvutsrq"]
    rows = [(". ".join(pairs), "en")] * 30 + [("á b. Ö b. 日本 語", "en")] * 31
    for best in (4, 12, 50):
        assert mined(spark, docs_of, rows, best) == brute(rows, best)


def test_every_word_hot(spark, docs_of, monkeypatch):
    monkeypatch.setattr(collocations, "HOT", 1)
    monkeypatch.setattr(collocations, "BUCKET_SUFFIXES", 50)
    rows = [("a b a b b a a c", "x")] * 40 + [("c c c c c c", "y")] * 9
    assert mined(spark, docs_of, rows) == brute(rows)


def test_routes_keep_together_what_is_counted_together():
    draw = np.random.default_rng(4)
    found, _ = collocations.suffixes(draw.integers(0, 12, 3000).astype("<i4"))
    bucket = collocations.routes(found, 7)
    of = defaultdict(set)
    for column, b in zip(found.T.tolist(), bucket):
        end = next((k for k, w in enumerate(column) if w % 2 == 0), len(column) - 1)
        of[tuple(column[: end + 1])].add(int(b))
    assert all(len(b) == 1 for b in of.values()) and len(set(bucket.tolist())) == 7


def test_odd_rows(spark, docs_of, odd_rows):
    rows = [(t, "en") for _, t in odd_rows] + [("a\tb  a b\x0bx y", None)] * 31 + [("a b", "und"), ("", "fr"), (None, "de")]
    assert mined(spark, docs_of, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark, docs_of):
    docs = docs_of([(i, "one two three", "en") for i in range(30)]).selectExpr("*", "1 AS n", "2 AS rank", "'x' AS phrase")
    assert [tuple(r) for r in collocations.phrases(docs).collect()] == [("en", 1, "one two three", 30, 30, 30, 90, 1000000)]
    none = collocations.phrases(docs.limit(0))
    assert none.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and none.count() == 0


def test_rows_and_sorts_in_small_pieces(spark, docs_of, spoken, monkeypatch):
    small = (("CHUNK_WORDS", 500), ("BUCKET_SUFFIXES", 400), ("HOT", 150), ("ROW_BYTES", 60), ("SORTED_AT_ONCE", 7))
    for name, value in (*small, ("PHRASES_AT_ONCE", 5)):
        monkeypatch.setattr(collocations, name, value)
    assert mined(spark, docs_of, spoken) == brute(spoken)


def test_routed_rows_are_bounded():
    said = np.random.default_rng(6).integers(0, 3000, 100_000).astype("<i4")
    chunks = pa.table({"said": pa.array([said.tobytes()], pa.binary()), "known": [3000]})
    words = pa.table({"place": np.arange(3000), "code": 2 * np.arange(3000)})
    routed = collocations._route("<i4", 2)(chunks, words)
    sizes = [len(w) + len(c) for w, c in zip(routed.column("words").to_pylist(), routed.column("counts").to_pylist())]
    assert max(sizes) <= 1 << 18 and sum(sizes) == 20 * collocations.suffixes(2 * said)[0].shape[1]


def test_sort_needs_less_than_two_buckets_of_memory():
    draw = np.random.default_rng(5)
    found, counts = collocations.suffixes((2 * (draw.zipf(1.2, 1 << 20) % 50_000)).astype("<i4"))
    found, counts = found.astype("<i4"), counts.astype("<i4")
    tracemalloc.start()
    try:
        rows = sum(len(total) for _, total in collocations.sort_suffixes(found, counts))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows > 1000 and most < 2 * (found.nbytes + counts.nbytes)


def test_texts_and_buckets_come_in_bounded_batches(spark, docs_of):
    session = spark.newSession()
    session.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = session.createDataFrame([], "doc_id long, text string, lang string")
    collocations.frequent(docs)

    def sizes(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            yield pa.RecordBatch.from_arrays([pa.array([part.num_rows]), pa.array([part.nbytes])], ["rows", "size"])

    rows = session.range(0, 3000, 1, 1).select(F.lit(1).alias("bucket"), F.repeat(F.lit("x"), 10_000).alias("words"))
    found = rows.groupBy("bucket").applyInArrow(sizes, "rows long, size long").collect()
    assert sum(r.rows for r in found) == 3000 and max(r.size for r in found) < 2 * BATCH_BYTES


def test_chunks_are_sent_in_small_rows(spark, docs_of):
    draw = random.Random(8)
    text = " ".join(draw.choices([f"w{k}" for k in range(500)], k=150_000))
    docs = docs_of([(1, text, "en"), (2, text, "fr")]).coalesce(1)
    longest = collocations._chunks(docs).agg(F.max(F.length("said"))).first()[0]
    assert 0 < longest <= collocations.ROW_BYTES
    assert mined(spark, docs_of, [(text, "en"), (text + ". " + text, "fr")], 50) == brute([(text, "en"), (text + ". " + text, "fr")], 50)


def test_routed_rows_come_in_bounded_batches():
    said = np.random.default_rng(7).integers(0, 5000, 1_000_000).astype("<i4")
    chunks = pa.table({"said": pa.array([said.tobytes()], pa.binary()), "known": [5000]})
    words = pa.table({"place": np.arange(5000), "code": 2 * np.arange(5000)})
    routed = collocations._route("<i4", 3)(chunks, words)
    assert max(b.nbytes for b in routed.to_batches()) < 2 * BATCH_BYTES
    parts = pa.table({"part": [2, 0, 1], "said": [s.tobytes() for s in (said[700_000:], said[:300_000], said[300_000:700_000])]})
    assert collocations._route("<i4", 3)(parts, words).equals(routed)
