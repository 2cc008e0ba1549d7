"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.texts import Scorer, annotate, fold, per_worker

FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
ORDER = 4
#: Rows per language that the models are learned from, in expectation (a hash of the id decides).
TRAIN_ROWS = 2000
#: One in so many of these calibrates the rejection and is not counted.
CALIBRATION = 5
#: Characters per language that the models are learned from, in expectation; rows of longer texts are fewer.
#: It bounds the n-grams of a language before they are counted, so that all counts are whole.
TRAIN_CHARACTERS = 8_000_000
#: Words whose scores a Python worker remembers, and new words that are scored together.
REMEMBERED = 300_000
WORDS_AT_ONCE = 1 << 12
#: Calibration rows beyond a bound. A language's bound is at least as far off as its own texts reach
#: and as this part of the way to the nearest texts of a language that the models do not have.
TAIL, WAY = 0.002, 1 / 3
#: Share of the texts of a left-out language that are nearer than the nearest ones the bound looks at;
#: a text that mixes its language with known ones is no measure.
NEAREST = 0.1
#: What the bound of a text of one letter is higher, in centres; it falls with the root of the letters.
SHORT = 1
#: Distinct words from which on the strangest one of a text does not count against it.
SPARING = 4
#: Letters from which on a longer text does not make the score surer.
SURE_LETTERS = 60

_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_EDGE = 1  # code point that stands before and after a word
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _runs(word: str) -> list[str]:
    return _LETTERS.findall(word.lower())


def _codes(runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All runs one after the other, each with ``ORDER - 1`` edges before and one after it; the places to predict."""
    pad = chr(_EDGE)
    whole = "".join(pad * (ORDER - 1) + run + pad for run in runs)
    codes = np.frombuffer(whole.encode("utf-32-le"), "<u4").astype(np.uint64)
    predicted = np.ones(len(codes), bool)
    ends = np.cumsum([len(run) + ORDER for run in runs]) if runs else np.array([], int)
    for k in range(ORDER - 1):
        predicted[ends - [len(run) + ORDER for run in runs] + k] = False
    return codes, predicted


def _hashes(codes: np.ndarray) -> list[np.ndarray]:
    """For each order, the hash of the n-gram that ends at each place (those over the start are void)."""
    with np.errstate(over="ignore"):
        rolled, found = np.zeros(len(codes), np.uint64), []
        for k in range(ORDER):
            back = np.concatenate([np.zeros(min(k, len(codes)), np.uint64), codes[: max(0, len(codes) - k)]])
            rolled = (rolled ^ (back + np.uint64(k + 1))) * _MIX
            rolled ^= rolled >> np.uint64(29)
            found.append(rolled)
    return found


@dataclass
class KneserNey:
    """The models of all languages in one sorted hash array per order, with a column per language.

    ``share[k]`` is the discounted share of an n-gram of order k + 1 after its context, ``weight[k]``
    what the context of that hash leaves to the lower order (1 where a language never saw it).
    """

    languages: list[str]
    keys: list[np.ndarray]
    share: list[np.ndarray]
    weight: list[np.ndarray]
    floor: np.ndarray
    #: Per language: the cross-entropy, each word in its best language, up to which a text is taken, and
    #: what one letter adds to it.
    bounds: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def bits(self, runs: list[str], owner: np.ndarray, words: int) -> np.ndarray:
        """Per word its bits in each language and its predicted letters; ``owner`` has the word of each run."""
        result = np.zeros((words, len(self.languages) + 1))
        if not runs:
            return result
        codes, predicted = _codes(runs)
        hashes = _hashes(codes)
        at = np.flatnonzero(predicted)
        p = np.broadcast_to(self.floor, (len(at), len(self.languages)))
        for k in range(ORDER):
            if k:
                p = p * self._find(k - 1, hashes[k - 1][at - 1], self.weight, 1.0)
            else:
                p = p * self.weight[ORDER][0]
            p = p + self._find(k, hashes[k][at], self.share, 0.0)
        of_run = np.repeat(owner, [len(run) + 1 for run in runs])
        logs = -np.log2(p)
        for j in range(len(self.languages)):
            result[:, j] = np.bincount(of_run, logs[:, j], words)
        result[:, -1] = np.bincount(of_run, minlength=words)
        return result

    def _find(self, k: int, hashes: np.ndarray, values: list[np.ndarray], missing: float) -> np.ndarray:
        places = np.minimum(np.searchsorted(self.keys[k], hashes), len(self.keys[k]) - 1)
        return np.where((self.keys[k][places] == hashes)[:, None], values[k][places], missing)


def estimate(counts: dict[str, dict[str, int]]) -> KneserNey:
    """Models from counts of n-grams of the highest order, for each language."""
    languages = sorted(counts)
    keys: list[np.ndarray] = []
    share: list[np.ndarray] = []
    weight: list[np.ndarray] = []
    columns: list[list[tuple]] = [[] for _ in range(ORDER)]
    root = np.ones((1, len(languages)))
    alphabet = {g[-1] for grams in counts.values() for g in grams}
    for j, language in enumerate(languages):
        level = counts[language]
        for k in range(ORDER, 0, -1):
            once, twice = (sum(1 for c in level.values() if c == n) for n in (1, 2))
            discount = once / (once + 2 * twice) if once and twice else 0.5
            total, kinds = Counter(), Counter()
            for gram, c in level.items():
                total[gram[:-1]] += c
                kinds[gram[:-1]] += 1
            for gram, c in level.items():
                columns[k - 1].append((gram, j, "share", max(c - discount, 0) / total[gram[:-1]]))
            for context, n in kinds.items():
                left = discount * n / total[context]
                if k > 1:
                    columns[k - 2].append((context, j, "weight", left))
                else:
                    root[0, j] = left
            level = Counter(gram[1:] for gram in level)  # continuations: distinct letters before
    for k in range(ORDER):
        grams = sorted({c[0] for c in columns[k]})
        row = {g: i for i, g in enumerate(grams)}
        s, w = np.zeros((len(grams), len(languages))), np.ones((len(grams), len(languages)))
        for gram, j, what, value in columns[k]:
            (s if what == "share" else w)[row[gram], j] = value
        codes = np.frombuffer("".join(grams).encode("utf-32-le"), "<u4").astype(np.uint64)
        hashes = _hashes(codes)[k][k :: k + 1] if grams else np.array([], np.uint64)
        order = np.argsort(hashes)
        keys.append(hashes[order])
        share.append(s[order])
        weight.append(w[order])
    floor = np.full(len(languages), 1 / (len(alphabet) + 1))
    return KneserNey(languages, keys, share, [*weight, root], floor, np.full((len(languages), 2), np.inf))


def scorer(model: KneserNey) -> Scorer:
    """The scorer of ``model``, which a Python worker keeps from task to task."""
    return per_worker(("language", model.name), lambda: _scorer(model, _verdict))


def _best_language(model: KneserNey, bits: np.ndarray) -> np.ndarray:
    """Each word's bits in the language that knows it best: what a text of several languages is made of."""
    return bits[:, :-1].min(axis=1, keepdims=True)


def _best_others(model: KneserNey, bits: np.ndarray) -> np.ndarray:
    """The same, then without one of the languages after the other, as if the models did not have it."""
    found = [_best_language(model, bits)]
    for j in range(len(model.languages)):
        others = np.delete(bits[:, :-1], j, axis=1)
        found.append(others.min(axis=1, keepdims=True) if others.shape[1] else -np.log2(model.floor[j]) * bits[:, -1:])
    return np.hstack(found)


def _scorer(model: KneserNey, say: Callable[[KneserNey, np.ndarray], dict], more: Callable = _best_language) -> Scorer:
    """What ``say`` makes of the bits of each text, and of ``more`` columns of its words.

    Words recur, so each is scored once as long as it is remembered.
    """
    known: dict[bytes, int] = {}
    table = np.zeros((0, 0))  # its width is known from the first words on

    def learn(words: list[bytes]) -> None:
        nonlocal table
        runs, owner = [], []
        for i, word in enumerate(words):
            found = _runs(word.decode())
            runs += found
            owner += [i] * len(found)
        bits = model.bits(runs, np.array(owner, int), len(words))
        fresh = np.hstack([bits, more(model, bits)])
        first = len(known)
        if first + len(words) > len(table):
            # memory is taken only for rows that are written, so most often this one is enough
            wider = np.zeros((max(REMEMBERED, 2 * len(table), first + len(words)), fresh.shape[1]))
            wider[:first] = table[:first] if first else 0.0
            table = wider
        table[first : first + len(words)] = fresh
        known.update((w, first + i) for i, w in enumerate(words))

    def score(texts: list[str | None]) -> list[dict]:
        split = [(text or "").encode().lower().split() for text in texts]
        new = list(set().union(*split) - known.keys())
        for at in range(0, len(new), WORDS_AT_ONCE):
            learn(new[at : at + WORDS_AT_ONCE])
        said = []
        for words in split:
            places = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            said.append(say(model, table[places]))
        if len(known) > REMEMBERED:
            for word in new:  # words met early are the common ones
                del known[word]
        return said

    return score


def _verdict(model: KneserNey, rows: np.ndarray) -> dict:
    n = len(model.languages)
    sums = rows.sum(axis=0)
    letters = int(sums[n]) if len(sums) else 0
    if not letters:
        return {"lang_pred": UNKNOWN, "score": 0.0, "cross_entropy": None, "rejected": True}
    entropy = sums[:n] / letters
    best = int(np.argmin(entropy))  # of equal ones the first by name
    odds = np.exp2(-(entropy - entropy[best]) * min(letters, SURE_LETTERS))
    bound, short = model.bounds[best]
    beyond = sums[n + 1] / letters > bound + short / np.sqrt(letters)
    return {
        "lang_pred": model.languages[best],
        "score": float(1 / odds.sum()),
        "cross_entropy": float(entropy[best]),
        "rejected": bool(beyond and _strange(rows[:, n:], bound, short)),
    }


def _strange(rows: np.ndarray, bound: float, short: float) -> bool:
    """Whether more than one word is at fault; ``rows`` has the letters of each word and its least bits.

    Repetitions make a text no surer, and in a text of a few words one of them may be a key or a name.
    """
    words, times = np.unique(rows, axis=0, return_counts=True)
    allowed = bound + short / np.sqrt(words[:, 0].sum())
    excess = times * (words[:, 1] - allowed * words[:, 0])
    spared = max(0.0, excess.max()) if len(words) >= SPARING else 0.0
    return excess.sum() > spared


def _sample(docs: DataFrame, learnable: Column) -> DataFrame | None:
    """About ``TRAIN_ROWS`` rows of each language, by a hash of the id, or fewer that have ``TRAIN_CHARACTERS``.

    None if there is none to learn from.
    """
    usable = docs.where(learnable & F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length(F.col("text").cast("string"))).alias("size"))
    rates = {r.lang: min(1.0, TRAIN_ROWS / r.n, TRAIN_CHARACTERS / max(1, r.size)) for r in sizes.collect()}
    if not rates:
        return None
    # one row per language, which the driver holds anyway
    shares = docs.sparkSession.createDataFrame(sorted(rates.items()), "lang string, rate double")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    drawn = usable.select("doc_id", F.col("lang").cast("string"), F.col("text").cast("string")).join(F.broadcast(shares), "lang")
    return drawn.where(place < F.col("rate")).select("doc_id", "lang", "text")


def _ngrams(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the highest order of n-grams per language in one task."""
    words: dict[str, Counter] = defaultdict(Counter)
    for part in parts:
        for language, text in zip(*(c.to_pylist() for c in part.columns)):
            words[language].update((text or "").lower().split())
    grams: Counter = Counter()
    pad = chr(_EDGE)
    for language, found in words.items():
        for word, n in found.items():
            for run in _runs(word):
                whole = pad * (ORDER - 1) + run + pad
                for i in range(len(run) + 1):
                    grams[language, whole[i : i + ORDER]] += n
    columns = list(zip(*((a, b, n) for (a, b), n in grams.items()))) or [(), (), ()]
    kinds = (pa.string(), pa.string(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "gram", "n"])


def learn(docs: DataFrame, learnable: Column) -> KneserNey | None:
    """Models and rejection bounds from the rows of ``docs(doc_id, text, lang)`` that may be learned from."""
    sample = _sample(docs, learnable)
    if sample is None:
        return None
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CALIBRATION)) == 0
    counted = (
        sample.where(~calibrates)
        .select("lang", "text")
        .mapInArrow(_ngrams, "lang string, gram string, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for row in counted.collect():
        counts[row.lang][row.gram] = row.n
    if not counts:
        return None
    model = estimate(counts)
    own = annotate(
        sample.where(calibrates),
        ["lang"],
        "found",
        "letters long, entropy array<double>, mixed double, without array<double>",
        lambda: _scorer(model, _raw, _best_others),
    )
    return _calibrated(model, own.where("found.letters > 0").select("lang", "found.*").collect())


def _raw(model: KneserNey, rows: np.ndarray) -> dict:
    n = len(model.languages)
    sums = rows.sum(axis=0) if rows.size else np.zeros(2 * n + 2)
    each = sums / max(1, sums[n])
    return {
        "letters": int(sums[n]), "entropy": each[:n].tolist(), "mixed": float(each[n + 1]) if sums[n] else 0.0,
        "without": each[n + 2 :].tolist(),
    }


def _calibrated(model: KneserNey, rows: list) -> KneserNey:
    """Set each language's bound from calibration texts of its own, and of every language as if it were unknown."""
    bounds = np.full((len(model.languages), 2), np.inf)
    unknown = [[r.without[j] for r in rows if r.lang == language] for j, language in enumerate(model.languages)]
    nearest = min((np.quantile(u, NEAREST) for u in unknown if u), default=np.inf)
    for j, language in enumerate(model.languages):
        own = np.array([(r.mixed, r.letters) for r in rows if r.lang == language and min(r.entropy) == r.entropy[j]])
        if not len(own):
            continue
        centre = np.median(own[:, 0])
        reach = np.quantile(own[:, 0], 1 - TAIL)
        bound = max(reach, centre + WAY * (nearest - centre))
        short = np.quantile(np.maximum(own[:, 0] - bound, 0) * np.sqrt(own[:, 1]), 1 - TAIL)
        bounds[j] = bound, max(short, SHORT * centre)
    return replace(model, bounds=bounds, name=uuid.uuid4().hex)


FIELDS = "lang_pred string, score double, cross_entropy double, rejected boolean"


def _nothing_learned(texts: list[str | None]) -> list[dict]:
    return [{"lang_pred": UNKNOWN, "score": 0.0, "cross_entropy": None, "rejected": True} for _ in texts]


def identify(docs: DataFrame, columns: list[str], learnable: Column) -> DataFrame:
    """``columns`` of every row of ``docs`` and a struct ``language`` with the fields of ``FIELDS``.

    ``lang_pred`` is the language with the lowest cross-entropy per letter of the whole text, ``und``
    for a null text, one without letters, or where nothing could be learned. ``score`` is 1 for a sure
    prediction, and 0 for ``und``. ``rejected`` marks ``und`` and texts whose cross-entropy, with every
    word in its best language so that mixtures of known languages stay, is beyond what calibration texts
    of that language have. Equal entropies go to the first language by name;
    repeated rows get the same answer. Rows with a null id, text or language are predicted but not
    learned from. Columns that are not named are not read; an empty table gives an empty result.
    """
    model = learn(docs, learnable)
    make = (lambda: scorer(model)) if model else (lambda: _nothing_learned)
    return annotate(docs, columns, "language", FIELDS, make, keeps=True)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning; false for a null id, which is not learned from either."""
    return F.coalesce(fold(doc_id, FOLDS) == HELD_OUT, F.lit(False))


def learnable(doc_id: Column) -> Column:
    return fold(doc_id, FOLDS) != HELD_OUT
