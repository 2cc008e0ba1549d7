import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cohortlake.llm import sharding


def placed(docs, **more):
    return sharding.shards(docs, sharding.text_bytes(docs.text), **more)


def test_rows_are_dealt_evenly_and_slots_are_gapless(spark, sf_dir):
    import __spark_entry__

    rows = __spark_entry__.queries()["op10_sharding"](spark, sf_dir).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t) + 1, zlib.crc32(t)) for i, t in texts.items()}
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(16)) and len(rows) == len(texts)
    counts = [len(s) for s in slots.values()]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_order_is_shuffled_and_repeats_for_a_seed(docs_of):
    docs = docs_of([(k, f"text {k}") for k in range(500)]).coalesce(2)

    def order(seed):
        rows = placed(docs, count=4, seed=seed, bucket_bytes=600).orderBy("shard", "slot").collect()
        return [r.record.doc_id for r in rows]

    first = order(1)
    assert sorted(first) == list(range(500)) and first != list(range(500))
    assert order(1) == first and order(2) != first
    moved = sum(abs(a - b) for a, b in enumerate(first)) / 500
    assert moved > 500 / 5  # a uniform order moves rows by a third


def test_equal_rows_scatter(docs_of):
    docs = docs_of([(1, "same")] * 600 + [(k, "other") for k in range(2, 302)])
    rows = placed(docs, count=3, bucket_bytes=100).collect()
    per_shard = Counter(r.shard for r in rows if r.record.doc_id == 1)
    assert sum(per_shard.values()) == 600 and min(per_shard.values()) > 150


def test_odd_rows_few_rows_and_clashing_columns(docs_of, odd_rows):
    docs = docs_of(odd_rows).withColumns({c: F.lit("x") for c in ("bucket", "shard", "slot", "position", "place", "total", "first")})
    rows = placed(docs).collect()
    assert Counter((r.record.doc_id, r.record.text) for r in rows) == Counter((r[0], r[1]) for r in odd_rows)
    assert max(Counter(r.shard for r in rows).values()) == 1
    assert placed(docs.limit(0)).count() == 0


def test_written_shards_hold_all_records(spark, docs_of, odd_rows, tmp_path):
    sharding.write_shards(placed(docs_of(odd_rows), count=3), f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == len(odd_rows)
    assert sorted(r["count"] for r in back.groupBy("_shard").count().collect()) == [3, 3, 4]


def test_no_python_runs_in_the_plan(docs_of):
    plan = placed(docs_of([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
