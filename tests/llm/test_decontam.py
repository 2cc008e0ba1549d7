import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.llm import decontam

DRAW = random.Random(17)
VOCABULARY = ["".join(DRAW.choices("abcdefghijklmnop", k=DRAW.randint(3, 8))) for _ in range(3000)]


def prose(n, draw=DRAW):
    return " ".join(draw.choice(VOCABULARY) for _ in range(n))


def brute_lcs(a, b, weight):
    best = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + (weight[x] if x == y else 0))
    return best[-1][-1] / sum(weight[x] for x in a)


def test_common_share_is_the_weighted_subsequence():
    draw = random.Random(2)
    weight = np.array([draw.random() + 0.1 for _ in range(7)])
    for _ in range(50):
        a, b = ([draw.randrange(7) for _ in range(draw.randint(1, 12))] for _ in range(2))
        assert decontam.common_share(np.array(a), np.array(b), weight) == pytest.approx(brute_lcs(a, b, weight))


def test_latent_space_holds_the_passages(spark):
    draw = np.random.default_rng(4)
    rows = [(np.sort(draw.choice(90, 12, replace=False)), draw.random(12) + 0.1) for _ in range(70)]
    space = decontam.latent_space(spark, rows, 90)
    dense = np.zeros((70, 90))
    for k, (t, w) in enumerate(rows):
        dense[k, t] = w
    latent = dense @ space
    assert np.allclose(latent @ latent.T, dense @ dense.T, atol=1e-6)
    assert np.allclose(space.T @ space, np.eye(space.shape[1]), atol=1e-8)


@pytest.fixture(scope="module")
def planted(spark, docs_of):
    """Documents with whole, cased, paraphrased, half and no benchmark items, and what must be found."""
    draw = random.Random(23)
    items = [(k, prose(draw.randint(8, 60)) + ". " + prose(6) + ".") for k in range(30)]
    items += [(100, prose(150) + "."), (101, "two words"), (102, None), (None, prose(20)), (103, items[3][1])]
    texts = dict(items)
    documents, expected = [], set()
    for k in range(30):
        place = prose(draw.choice((0, 15, 31, 33, 700)))
        said = texts[k]
        if k % 3 == 1:
            said = said.upper().replace(" ", "\n ", 5)
        if k % 3 == 2:
            words = said.split()
            for at in range(1, max(2, len(words) - 7), 9):
                words[at] = "other"
            said = " ".join(words)
        documents.append((k, f"{place} {said} {prose(40)}"))
        expected.add((k, k))
    expected.add((3, 103))
    documents.append((100, prose(50) + " " + texts[100] + " " + prose(50)))
    expected.add((100, 100))
    documents.append((200, prose(30) + " " + " ".join(texts[5].split()[: len(texts[5].split()) // 3]) + " " + prose(30)))
    documents += [(300 + k, prose(draw.randint(1, 400))) for k in range(120)]
    documents += [(900, None), (901, ""), (None, f"x {texts[7]}"), (7, f"{texts[7]}")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return docs_of(documents), benchmark, expected


def test_planted_items_are_found_and_nothing_else(planted, monkeypatch):
    docs, benchmark, expected = planted
    rows = decontam.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected | {(None, 7)}
    assert sum((r.doc_id, r.item_id) == (7, 7) for r in rows) == 2  # two documents with that id
    assert all(0 < r.cosine <= 1 and r.lcs >= decontam.PARAPHRASE for r in rows)
    monkeypatch.setattr(decontam, "ITEMS_AT_ONCE", 9)
    monkeypatch.setattr(decontam, "RANK", 8)
    again = decontam.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in again} == expected | {(None, 7)}


def test_paraphrases_need_their_answer(spark, docs_of):
    body, answer = prose(40), prose(3)
    changed = " ".join(w if k % 4 else "zzz" for k, w in enumerate(body.split()))
    benchmark = spark.createDataFrame([(1, body, answer)], "item_id long, text string, answer string")
    docs = docs_of([(1, f"{changed} so {answer} it is"), (2, changed), (3, prose(80))] + [(k, prose(60)) for k in range(10, 60)])
    assert {r.doc_id for r in decontam.contaminated(docs, benchmark).collect()} == {1}


def test_empty_tables_and_clashing_columns(spark, planted):
    docs, benchmark, _ = planted
    more = docs.withColumns({"leaks": F.lit(1), "doc": F.lit("x"), "item_id": F.lit(2)})
    assert "lcs" in decontam.contaminated(more.limit(5), benchmark).columns
    kept = decontam.annotate_leaks(more, benchmark).select("doc.*")
    assert kept.columns == more.columns
    assert decontam.contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), benchmark).count() == 0


def test_query_finds_what_shingles_find(spark, sf_dir):
    import __spark_entry__

    def shingles(text):
        said = decontam.words(text)
        return {tuple(said[i : i + 5]) for i in range(max(0, len(said) - 4))}

    benchmark = {r.item_id: shingles(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    documents = {r.doc_id: shingles(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    expected = {(d, i) for d, s in documents.items() for i, b in benchmark.items() if len(s & b) >= 0.8 * len(b)}
    rows = __spark_entry__.queries()["op5_decontam"](spark, sf_dir).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected and expected


def test_paraphrases_with_rare_words_replaced_are_candidates(spark, docs_of):
    """Thirty common words and three rare ones of ten times their weight, two of these replaced; the answer is there."""
    common = [f"c{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(30)]
    question = [*common[:10], "rarex", *common[10:20], "rarey", *common[20:26], "rarez"]
    item = f"{' '.join(question)}. {' '.join(common[26:])}."
    copy = item.replace("rarex", "otherx").replace("rarey", "othery")
    others = [(k, " ".join(common)) for k in range(100, 300)] + [(k, f"filler{k} words") for k in range(300, 450)]
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    found = decontam.contaminated(docs_of([(1, copy), *others]), benchmark).collect()
    index = decontam.build_index(docs_of([(1, copy), *others]), benchmark.selectExpr("item_id", "text", "cast(null as string) answer"))
    rare, plain = index.weight[index.terms[b"rarex"]], index.weight[index.terms[b"caa"]]
    assert 7 < rare / plain < 12
    assert [r.item_id for r in found if r.doc_id == 1] == [7]


def test_short_items_and_scripts_without_spaces(spark, docs_of):
    items = [
        (1, "東京都の人口は約千四百万人で、日本の都道府県の中で最も多い。首都はどこですか。東京です。"),
        (2, "ประเทศไทยมีเมืองหลวงชื่อกรุงเทพมหานคร"),
        (3, "Quizzical zebras jump"),
        (4, "seven whole words make another longer item"),
        (5, "xylophone"),
        (6, "中国的首都是北京"),
        (7, "don’t “panic”"),
        (8, "—…"),
        (9, "Quizzical, zebras: JUMP!"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    fill = prose(70)
    docs = [
        (10, f"{fill}。{items[0][1]}{fill}"),
        (20, f"คำนำ {items[1][1]}ครับ {fill}"),
        (30, f"{fill} quizzical zebras — jump {fill}"),
        (31, f"{fill} quizzical zebras jumped {fill}"),
        (32, f"{fill} zebras jump quizzical"),
        (40, f"{fill} {items[3][1]} {fill}"),
        (50, "xylophone"),
        (51, "xylophones"),
        (60, f"我知道{items[5][1]}。{fill}"),
        (61, f"中国的首都，{fill}"),
        (70, "Don't “don’t panic”, they said"),
        (80, "quizzical"),
        (81, "zebras jump"),
        (90, "— …"),
    ]
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs_of(docs), benchmark).collect()}
    assert found == {(10, 1), (20, 2), (30, 3), (30, 9), (40, 4), (50, 5), (60, 6), (70, 7)}


def test_words_of_all_scripts():
    assert decontam.words("Naïve Café—über’s 3½ x_y") == [w.encode() for w in ("naïve", "café", "über", "s", "3½", "x", "y")]
    assert decontam.words("日本語 text，ＡＢ") == [w.encode() for w in ("日", "本", "語", "text", "ａｂ")]
    assert decontam.words("हिन्दी भाषा") == [w.encode() for w in ("हिन्दी", "भाषा")]
    assert decontam.words(None) == decontam.words(" \n—") == []


def test_candidates_hold_all_that_a_brute_force_subsequence_finds(spark, sf_dir):
    """Every item against every region of every text, without a candidate search."""
    draw = random.Random(9)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").collect()][:12]
    docs = []
    for k, (_, text) in enumerate(items):
        said = text.split()
        for share in (0.05, 0.1, 0.15, 0.25):
            changed = [draw.choice(VOCABULARY) if draw.random() < share else w for w in said]
            docs.append((len(docs), f"{prose(draw.randint(0, 90), draw)} {' '.join(changed)} {prose(draw.randint(0, 90), draw)}"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    index = decontam.build_index(frame, decontam._blocks(benchmark)[0])
    other, expected = len(index.terms), set()
    for doc_id, text in docs:
        ids = np.array([index.terms.get(w, other) for w in decontam.words(text)])
        for item in index.items:
            n = len(item.words)
            for low in range(0, max(1, len(ids) - n + 1), max(1, n // 8)):
                region = ids[low : low + n + n // 8]
                share = decontam.common_share(item.words, region, index.weight)
                if share >= decontam.COPY or share >= decontam.PARAPHRASE and decontam.common_share(item.answer, region, index.weight) >= decontam.ANSWER:
                    expected.add((doc_id, item.item_id))
    found = {(k, leak["item_id"]) for k, leaks in enumerate(decontam.search(index, [t for _, t in docs])) for leak in leaks}
    assert len(expected) > 25 and len(expected & found) >= 0.9 * len(expected)
