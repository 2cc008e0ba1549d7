"""Ranked lexical search against the formula by plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from cohortlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, best=lexical.BEST):
    said = [(i, Counter(terms(t))) for i, t in docs]
    said = [(i, c) for i, c in said if c]
    total, spoken = len(said), sum(sum(c.values()) for _, c in said)
    df = Counter(t for _, c in said for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    found = []
    for item, asked in wanted.items():
        scores = []
        for doc, counts in said:
            n = sum(counts.values())
            m = 100 - 90 + (90 * n * total) // spoken
            score = 0
            for t in asked & counts.keys():
                weight = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                score += weight * (1000000000 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        found += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scores)[:best])]
    return sorted(found, key=str)


def ranked(spark, docs_of, docs, items, best=lexical.BEST):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = lexical.rank(docs_of(docs).repartition(3), benchmark, best).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=str)


@pytest.fixture(scope="module")
def spoken():
    """Documents of very different lengths over words that follow a skewed law, and items of them."""
    draw = random.Random(5)
    vocabulary = [f"w{k}" for k in range(300)]
    weight = [1 / (k + 1) for k in range(300)]
    said = lambda n: " ".join(draw.choices(vocabulary, weight, k=n))
    docs = [(i, said(draw.choice([1, 5, 40, 200]))) for i in range(600)]
    return docs, [(i, said(12)) for i in range(30)]


def test_whole_table_against_the_formula(spark, docs_of, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert ranked(spark, docs_of, docs, items) == brute(docs, items)


def test_small_blocks_bundles_and_passes_change_nothing(spark, docs_of, spoken, monkeypatch):
    for name, value in (("BLOCK_DOCS", 64), ("BUNDLE_ITEMS", 4), ("TERMS_AT_ONCE", 100), ("BLOCK_POSTINGS", 1500)):
        monkeypatch.setattr(lexical, name, value)
    assert ranked(spark, docs_of, *spoken) == brute(*spoken)


def test_pruning_keeps_every_tie(spark, docs_of):
    docs = [(i, "common rare" if i < 30 else "common") for i in range(300)]
    items = [(1, "common rare"), (2, "common"), (3, "nowhere"), (4, "rare rare RARE")]
    assert ranked(spark, docs_of, docs, items) == brute(docs, items)
    assert ranked(spark, docs_of, docs, items, 40) == brute(docs, items, 40)


def test_odd_rows(spark, docs_of, odd_rows):
    rows = [*odd_rows, (None, "fox fox"), (8, "日本語 ÜBER über ſ K"), (9, "fox's\x00fox_fox")]
    items = [(1, "The fox, the DOG"), (1, "alpha"), (2, None), (3, ""), (None, "日本語 naïve"), (4, "über Über"), (2, "a")]
    assert ranked(spark, docs_of, rows, items) == brute(rows, items)


def test_empty_tables_and_clashing_columns(spark, docs_of):
    items = spark.createDataFrame([(1, "a b", 7)], "item_id long, text string, doc_id long")
    none = lexical.rank(docs_of([]), items)
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.count() == 0
    assert lexical.rank(docs_of([(1, "a")]), items.limit(0)).count() == 0
    docs = docs_of([(5, "a"), (6, "c")]).selectExpr("*", "1 AS item_id", "2 AS score", "3 AS block")
    assert [r.doc_id for r in lexical.rank(docs, items).collect()] == [5]
