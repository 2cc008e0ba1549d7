import os
import random
import subprocess
import sys

import pytest

import corpus_pipeline
from cohortlake.llm import decontam, packing
from cohortlake.session import materialize
from tests.llm.test_packing import PATH, check


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    """The smallest tables with planted documents: strange, blank, poor, copied, leaked and clean ones."""
    path = str(tmp_path_factory.mktemp("tables"))
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = documents.orderBy("doc_id").collect()
    clean = next(r.text for r in rows if r.lang == "en" and len(r.text) > 3000 and not any(c in r.text for c in "!#|"))
    words = clean.split()
    draw = random.Random(8)
    fresh = [" ".join(draw.sample(words, 300)).capitalize() + "." for _ in range(6)]
    item = next(r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").collect() if len(r.text) > 150)
    planted = [
        (100_001, "Привет мир, это совсем другой язык и другие буквы. " * 8, "strange"),
        (100_002, None, "blank"),
        (100_003, "12345 !! 67890 ...", "blank"),
        (100_004, " ".join(w.upper() + "!!" for w in fresh[0].split()), "poor"),
        (100_005, fresh[1], "clean"),
        (100_006, fresh[1], "copy"),
        (100_007, fresh[2], "clean"),
        (100_008, fresh[2].replace(".", ".\n"), "copy"),
        (100_009, f"{fresh[3]} {item} {fresh[4]}", "leak"),
        (100_010, fresh[5], "clean"),
        (None, fresh[0], "clean"),
    ]
    # Strange documents have no label: a language is what its labelled documents are written in.
    rows = [(i, t, None if k == "strange" else "en", "planted", len(t or "")) for i, t, k in planted]
    more = spark.createDataFrame(rows, documents.schema)
    documents.unionByName(more).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return path, {i: kind for i, _, kind in planted}


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Each stage's name, its input and its output."""
    docs, steps = spark.read.parquet(f"{folder[0]}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, folder[0]), f"test-{name}")
        steps.append((name, docs, out))
        docs = out
    return {name: (before, after) for name, before, after in steps}


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def test_stages_keep_the_columns_and_the_clean_documents(stages, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "decontamination", "packing"]
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.dtypes == before.dtypes
        kept = set(ids(after))
        assert {i for i, kind in folder[1].items() if kind == "clean"} <= kept


def test_each_kind_goes_at_its_stage(stages, folder):
    gone = {name: set(ids(before)) - set(ids(after)) for name, (before, after) in stages.items()}
    kinds = {"language": {"strange", "blank"}, "quality": {"poor"}, "near_duplicates": {"copy"}, "decontamination": {"leak"}, "packing": set()}
    for name, expected in kinds.items():
        assert {folder[1][i] for i in gone[name] if i in folder[1]} == expected


def test_language_and_quality_against_plain_rules(stages, spark, sf_dir):
    before, after = stages["language"]
    assert len(ids(before)) - len(ids(after)) == 3  # all documents of the four languages stay
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before, after = stages["quality"]
    kept = set(ids(after))
    judged = [i for i in ids(before) if i in labels]
    assert sum((i in kept) == (labels[i] == 1) for i in judged) >= 0.95 * len(judged)


def test_near_duplicates_against_all_pairs(stages):
    before, after = stages["near_duplicates"]
    sets = {}
    for r in before.where("doc_id is not null").collect():
        said = (r.text or "").encode().lower().split()
        assert r.doc_id not in sets
        sets[r.doc_id] = {tuple(said[k : k + 5]) for k in range(max(1, len(said) - 4))} if said else set()
    least = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    while any(least[a] != least[b] for a, b in pairs):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    assert [i for i in ids(after) if i is not None] == sorted(set(least.values()), key=str)
    assert len(set(least.values())) < len(sets) and ids(after).count(None) == 1


def test_rows_that_share_an_id_are_decided_one_by_one(spark, docs_of, folder):
    texts = [" ".join(f"{w}{k}" for k in range(40)) for w in "abc"]
    rows = [(3, texts[0]), (5, texts[0]), (5, texts[1]), (7, texts[2]), (7, texts[2]), (None, texts[0]), (9, ""), (8, None)]
    kept = corpus_pipeline.without_copies(spark, docs_of(rows), folder[0])
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert found == sorted([(3, texts[0]), (5, texts[1]), (7, texts[2]), (None, texts[0]), (8, None)], key=str)


def test_rows_without_an_id_are_compared(spark, docs_of, folder):
    words = [f"w{k}" for k in range(200)]
    near, bridge, far = (" ".join(words[:n]) for n in (200, 170, 142))  # neighbours at 0.8 or more, the ends below
    texts = [" ".join(f"{w}{k}" for k in range(40)) for w in "abcd"]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[0] + " more"), (None, texts[1]), (2, texts[1]), (1, texts[1])]
    rows += [(None, texts[2]), (4, texts[3]), (5, near), (None, bridge), (6, far), (None, ""), (None, None)]
    found = [(r.doc_id, r.text) for r in corpus_pipeline.without_copies(spark, docs_of(rows), folder[0]).collect()]
    assert sorted(i for i, _ in found if i is not None) == [1, 4, 5]
    nameless = [t for i, t in found if i is None]
    assert len(nameless) == 5 and {texts[1], texts[2], bridge} <= set(nameless)
    assert sum((t or "").startswith(texts[0]) for t in nameless) == 1 and sum(not t for t in nameless) == 1


def test_decontamination_against_shingles(stages, spark, folder):
    def shingles(text):
        said = decontam.words(text)
        return {tuple(said[i : i + 5]) for i in range(max(0, len(said) - 4))}

    items = [shingles(r.text) for r in spark.read.parquet(f"{folder[0]}/benchmark.parquet").collect()]
    before, after = stages["decontamination"]
    expected = [
        r.doc_id for r in before.collect() if not any(len(shingles(r.text) & s) >= 0.8 * len(s) for s in items)
    ]
    assert ids(after) == sorted(expected, key=str)


def test_run_packs_what_the_stages_keep(spark, folder, stages):
    from tokenizers import Tokenizer

    import numpy as np

    tokenizer = Tokenizer.from_file(PATH)
    rows = corpus_pipeline.run(spark, folder[0]).collect()
    documents = [(r.doc_id, r.text) for r in stages["packing"][0].collect()]
    check(rows, documents, lambda t: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID], "<u4"))


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, folder[0]), f"empty-{name}")
        assert docs.count() == 0


def test_entry_works_without_the_subpackage(tmp_path):
    """The other queries are there where this package and the pipeline are not installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    os.symlink(f"{root}/__spark_entry__.py", tmp_path / "__spark_entry__.py")
    os.mkdir(tmp_path / "cohortlake")
    for name in os.listdir(f"{root}/cohortlake"):
        if name != "llm":
            os.symlink(f"{root}/cohortlake/{name}", tmp_path / "cohortlake" / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') for n in e.queries()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert found.stdout.split()[1:] == ["0"], found.stderr
