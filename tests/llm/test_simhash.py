from collections import Counter

import pytest
import xxhash

from cohortlake.llm import simhash


def brute_fingerprint(text):
    words, now = [], b""
    for b in (text or "").encode():
        b = b + 32 if 65 <= b <= 90 else b
        if b == 32 or 9 <= b <= 13:
            words, now = words + ([now] if now else []), b""
        else:
            now += bytes([b])
    words += [now] if now else []
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    bits = Counter(k for s in shingles for k in range(64) if xxhash.xxh64_intdigest(s, 42) >> k & 1)
    return sum(1 << k for k in range(64) if 2 * bits[k] > len(shingles))


def brute_components(fps):
    """Smallest id reachable, for a list of (id, fingerprint)."""
    root = {i: i for i, _ in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in fps:
        for j, b in fps:
            if i < j and (a ^ b).bit_count() <= 3:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in fps}


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "one", "One two", "a b c d", "É x é\x0b y\xa0z", "The cat the cat the cat THE CAT"]
)
def test_fingerprint_follows_the_definition(text):
    assert simhash.fingerprint(text) & (1 << 64) - 1 == brute_fingerprint(text)


def test_masks_cover_every_choice_of_changed_bits():
    masks = [m & (1 << 64) - 1 for m in simhash.block_masks()]
    assert len(masks) == 20
    for changed in ((0, 1, 2), (0, 20, 63), (10, 11, 12), (5, 31, 47)):
        difference = sum(1 << b for b in changed)
        assert any(not m & difference for m in masks)


def test_links_join_what_all_pairs_join(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)  # so that values are dealt over several chunks
    fps, base = [], 0x0123456789ABCDEF
    for k in range(40):
        fps.append((k, base ^ (1 << k)))
    for k in range(40, 80):
        fps.append((k, base ^ (0xF0F0 << 30) ^ (1 << (k - 40)) ^ (1 << (k - 39))))
    chain = 0xFFFF0000FFFF0000
    for k in range(80, 100):
        chain ^= 0b111 << (3 * (k - 80))
        fps.append((k, chain))
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in fps]
    found = simhash.connected_components(simhash.links(spark.createDataFrame(signed, "id long, fp long")))
    named = {r.id: r.component for r in found.collect()}
    assert {i: named.get(i, i) for i, _ in fps} == brute_components(fps)


def test_near_duplicates_of_odd_rows(docs_of, odd_rows):
    rows = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(docs_of(odd_rows)).collect()]
    assert len(rows) == len(odd_rows)
    by_id = {i: c for i, _, c in rows if i is not None}
    assert by_id == {1: 1, 2: 2, 3: 2, 4: 2, 5: 5, 6: 6, 7: 7}
    assert sorted(c for i, _, c in rows if i is None) == [1, 2]  # those of equal fingerprints with an id


def test_clashing_columns_and_empty_tables(docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(1, "a b c d")]).withColumns({c: F.lit("x") for c in ("fp", "id", "component_id", "t", "block")})
    assert simhash.near_duplicates(docs).columns == ["doc_id", "fp", "component_id"]
    assert simhash.near_duplicates(docs).count() == 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_whole_table_against_brute_force(spark, sf_dir):
    import __spark_entry__

    rows = __spark_entry__.queries()["op4_simhash"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fps = [(i, simhash.fingerprint(t) & (1 << 64) - 1) for i, t in sorted(texts.items())]
    expected = brute_components(fps)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{f:016x}", expected[i]) for i, f in fps}
