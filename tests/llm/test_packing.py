import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortlake.llm import packing

PATH = public_tokenizers.path(packing.TOKENIZER)


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")


def check(rows, documents, plain):
    """Every id of every document lies in one piece, and sequences are gapless."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = defaultdict(list)
    for doc_id, text in documents:
        expected[doc_id].append(plain(text))
    assert pieces.keys() == expected.keys()
    for doc_id, ids in expected.items():
        mine = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[doc_id])
        assert sum(length for _, length, _, _ in mine) == sum(map(len, ids))
        if len(ids) == 1:
            at = 0
            for start, length, crc, total in mine:
                assert start == at and total == len(ids[0])
                assert crc == zlib.crc32(ids[0][at : at + length].tobytes())
                at += length
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW
    return sequences


@pytest.mark.parametrize("text", ["", None, "Don't WE'LL 's a,b. c!! d", "x<|endoftext|>y z", "É́ 日本 \x1c q\x85r", "a." * 9])
def test_words_are_encoded_as_the_tokenizer_does(text, plain):
    assert packing.word_encoder(PATH)([text])[0].tolist() == plain(text).tolist()


def test_remembered_words_stay_bounded(monkeypatch, plain):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    encode = packing._word_encoder(PATH, packing.END_ID)
    for text in ("one two three four five six seven", "seven six, one. two", "naïve!! één&& e\u0301!! x'!! 12,", "one two!!"):
        assert encode([text])[0].tolist() == plain(text).tolist()


def test_a_worker_keeps_one_memory():
    first = packing.word_encoder(PATH)
    assert packing.word_encoder(PATH) is first
    assert packing.word_encoder(PATH, 3) is not first
    assert packing.word_encoder(PATH) is not first


def test_packer_fills_the_fullest_when_none_fits():
    packer = packing.Packer(2, 0)
    for doc_id, n in ((1, 3000), (2, 2500), (3, 2000)):
        packer.add(doc_id, 0, np.arange(n, dtype="<u4"), n)
    first = [r for r in packer.done if r[5] == 0]
    assert [(r[0], r[2]) for r in first] == [(1, 3000), (3, 1096)]
    packer.flush()
    assert sum(r[2] for r in packer.done) == 7500


def test_odd_rows(docs_of, odd_rows, plain):
    rows = packing.pack(docs_of(odd_rows).repartition(3)).collect()
    check(rows, odd_rows, plain)


def test_leftovers_of_many_tasks_are_merged(spark, docs_of, plain, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 3)
    documents = [(k, "word " * (k % 700)) for k in range(300)]
    sequences = check(packing.pack(docs_of(documents).repartition(20)).collect(), documents, plain)
    filled = [sum(n for _, n in parts) for parts in sequences.values()]
    assert sum(filled) > 0.98 * packing.WINDOW * (len(filled) - 1)


def test_empty_table_and_clashing_columns(docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(1, "a b")]).withColumns({c: F.lit(0) for c in ("start", "length", "part", "ids", "offset")})
    assert packing.pack(docs.limit(0)).count() == 0
    assert packing.pack(docs).columns == [c.split()[0] for c in packing.PIECE.split(", ")]


def test_whole_table(spark, sf_dir, plain):
    import __spark_entry__

    rows = __spark_entry__.queries()["op6_packing"](spark, sf_dir).collect()
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    filled = [sum(n for _, n in parts) for parts in check(rows, documents, plain).values()]
    assert sum(filled) > 0.97 * packing.WINDOW * len(filled)


def test_long_words_that_weighted_sums_confuse(plain):
    thue = "".join("ab"[bin(k).count("1") % 2] for k in range(2048))
    other = "".join("ba"[bin(k).count("1") % 2] for k in range(2048))
    far = "x" * 5000
    swapped = [far[:7] + "q" + far[8:4103] + "z" + far[4104:], far[:7] + "z" + far[8:4103] + "q" + far[4104:]]
    words = [thue, other, thue[:1024], other[:1024], *swapped, "a" * 64, "a" * 65, "b" * 65, "日" * 50, "日" * 49 + "本"]
    hashes = packing._hashed_words(" ".join(words).encode())[2]
    assert len(set(hashes.tolist())) == len(words)
    texts = [f"one {w} two {w}" for w in words] + [" ".join(words)]
    encode = packing.word_encoder(PATH)
    for ids, text in zip(encode(texts), texts):
        assert np.array_equal(ids, plain(text))


def test_word_table_takes_room_for_the_words_it_holds():
    hashes = np.unique(np.random.default_rng(3).integers(1, 1 << 63, 100_000, np.uint64) * np.uint64(2))
    np.random.default_rng(4).shuffle(hashes)
    ids = [[k & 1023] * (k % 4) for k in range(len(hashes))]
    table = packing._WordTable(1_000_000)
    for at in range(0, len(hashes), 30_000):
        table.add(hashes[at : at + 30_000], ids[at : at + 30_000])
    place = table.places(hashes)
    assert (table.keys[place] == hashes).all() and table.held == len(hashes)
    start, count = table.start[place].tolist(), table.count[place].tolist()
    assert [table.ids[a : a + n].tolist() for a, n in zip(start, count)] == ids
    assert sum(a.nbytes for a in (table.keys, table.start, table.count, table.ids)) < 12e6
