"""Document quality by Bradley-Terry pairwise ranking."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.texts import Scorer, annotate, fold
from cohortlake.session import materialize

FOLDS, HELD_OUT = 3, 1
#: Pull of the weights to zero, per pair.
RIDGE = 1e-3
#: The change of the weights at which they are taken as found, and the steps at most.
SETTLED, STEPS = 1e-3, 50
#: Documents whose raw scores lie in the same of these parts of a unit meet others as one sum.
PARTS, WIDEST = 8, 32
#: Decimals that are kept, so that the order in which sums arrive does not show.
DIGITS = 6
#: Parts into which a range of scores is cut at a time to find a rank.
CUTS = 4096

_SENTENCE = b".,;:?'\"()-"
_SHOUT = b"!"
_SYMBOLS = b"#$%&*@^~<>=_+/\\{}[]`"
_TABLE = b"|"
#: Names of the features, in the order of ``features``.
FEATURES = (
    "letters", "upper", "sentence", "shout", "symbols", "table", "repeated_lines", "repeated_words",
    "log_shout", "log_symbols", "log_table", "log_repeated_words",
)


def _places(characters: bytes) -> np.ndarray:
    return np.frombuffer(characters, np.uint8)


def features(text: str | None) -> np.ndarray:
    """Shares and logarithms over the whole text; all zero for a null or blank one."""
    data = (text or "").encode()
    words = data.lower().split()
    if not words:
        return np.zeros(len(FEATURES))
    n = len(data)
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    small, capital, high = count[97:123].sum(), count[65:91].sum(), count[128:].sum()
    letters = small + capital + high
    lines = [line for line in data.split(b"\n") if line]
    sentence, shout, symbols, table = (
        count[_places(c)].sum() / n for c in (_SENTENCE, _SHOUT, _SYMBOLS, _TABLE)
    )
    again = sum(map(eq, words, words[1:])) / len(words)
    return np.array([
        letters / n, capital / max(1, small + capital), sentence, shout, symbols, table,
        1 - len(set(lines)) / max(1, len(lines)), again,
        np.log(1e-3 + shout), np.log(1e-3 + symbols), np.log(1e-3 + table), np.log(1e-2 + again),
    ])


@dataclass
class Ranking:
    """Weights on standardised features, and the score at the quantile that parts the labels."""

    centre: np.ndarray
    width: np.ndarray
    weights: np.ndarray
    threshold: float
    steepness: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) / self.width @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, and 0.5 at the threshold."""
        return 1 / (1 + np.exp(-np.clip(self.steepness * (self.raw(x) - self.threshold), -36, 36)))


def _standard(x: np.ndarray, centre: np.ndarray, width: np.ndarray) -> np.ndarray:
    return (x - centre) / width


def _scale(centre, width) -> tuple[np.ndarray, np.ndarray]:
    centre, width = np.round(np.array(centre, float), 12), np.round(np.array(width, float), 12)
    width[width < 1e-9] = 1.0
    return centre, width


def sums(z: np.ndarray, good: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(kind, part)`` of the raw score, and per such pair the rows' number, sum and sum of products."""
    part = np.floor(np.clip(z @ weights, -WIDEST, WIDEST) * PARTS).astype(np.int64)
    keys, place = np.unique(np.stack([good.astype(np.int64), part], 1), axis=0, return_inverse=True)
    place, (over, down) = place.ravel(), np.triu_indices(z.shape[1])
    each = np.concatenate([np.ones((len(z), 1)), z, z[:, over] * z[:, down]], 1)
    total = np.zeros((len(keys), each.shape[1]))
    np.add.at(total, place, each)
    return keys, total


def step(keys: np.ndarray, total: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One Newton step of the Bradley-Terry loss over all pairs of a good and another document.

    Every pair counts. Its margin is that of the means of the parts that the two documents are in, which
    are an eighth of a unit wide; what a pair adds to gradient and curvature is taken from the sums.
    """
    size = len(weights)
    over, down = np.triu_indices(size)
    kinds = []
    for kind in (1, 0):
        n, first, second = np.split(total[keys[:, 0] == kind], [1, 1 + size], 1)
        square = np.zeros((len(n), size, size))
        square[:, over, down] = square[:, down, over] = second / n
        kinds.append((n[:, 0] / n.sum(), first / n, square))
    (share, mean, square), (share_0, mean_0, square_0) = kinds
    p = 1 / (1 + np.exp(-np.clip(np.subtract.outer(mean @ weights, mean_0 @ weights), -36, 36)))
    pull, bend = (p - 1) * np.outer(share, share_0), p * (1 - p) * np.outer(share, share_0)
    gradient = pull.sum(1) @ mean - pull.sum(0) @ mean_0 + RIDGE * weights
    cross = mean.T @ bend @ mean_0
    curve = np.tensordot(bend.sum(1), square, 1) + np.tensordot(bend.sum(0), square_0, 1) - cross - cross.T
    return np.linalg.solve(curve + RIDGE * np.eye(size), gradient)


def _solve(sums_at: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    weights = np.zeros(size)
    for _ in range(STEPS):
        change = step(*sums_at(weights), weights)
        weights = weights - change
        if np.abs(change).max() < SETTLED:
            break
    return np.round(weights, DIGITS)


def fit(x: np.ndarray, good: np.ndarray) -> Ranking | None:
    """Bradley-Terry weights: logistic loss on feature differences of all pairs of a good and another row.

    The threshold is the score's quantile at the share of the other documents. None without both kinds.
    ``learn`` does the same with rows that stay in their tasks.
    """
    if good.all() or not good.any():
        return None
    centre, width = _scale(x.mean(axis=0), x.std(axis=0))
    z = _standard(x, centre, width)
    weights = _solve(lambda w: sums(z, good, w), z.shape[1])
    raw = np.sort(z @ weights)
    below, above = (raw[rank] for rank in _ranks(len(raw), int((~good).sum())))
    return Ranking(centre, width, weights, round(float(below + above) / 2, DIGITS), 1.0)


def _ranks(rows: int, others: int) -> tuple[int, int]:
    """Places, from 0, on both sides of the quantile at the share of the others, one row in a hundred away."""
    share = others / rows
    return tuple(round(min(1.0, max(0.0, at)) * (rows - 1)) for at in (share - 0.01, share + 0.01))


def _scorer(ranking: Ranking | None) -> Scorer:
    def score(texts: list[str | None]) -> list[dict]:
        if ranking is None:
            return [{"score": 0.5, "predicted": 1} for _ in texts]
        found = ranking.score(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES)))
        return [{"score": float(s), "predicted": int(s >= 0.5)} for s in found]

    return score


def _sums(rows: DataFrame, centre: np.ndarray, width: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``sums`` of all ``rows(quality, x)``: added up in each task, then by kind and part."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
            keys, total = sums(_standard(x, centre, width), part.column(0).to_numpy() == 1, weights)
            columns = [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(total.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "part", "sums"])

    size = 1 + len(weights) + len(weights) * (len(weights) + 1) // 2
    partial = rows.select("quality", "x").mapInArrow(batches, "kind long, part long, sums array<double>")
    added = partial.groupBy("kind", "part").agg(F.array(*(F.sum(F.col("sums")[k]) for k in range(size))).alias("sums"))
    found = added.collect()  # at most 2 * (2 * WIDEST * PARTS + 1) rows
    return np.array([(r.kind, r.part) for r in found]), np.array([r.sums for r in found])


def value_at(scores: DataFrame, rank: int, low: float, high: float) -> float:
    """The value of that rank, from 0, in the column ``raw``, whose values lie from ``low`` to ``high``.

    The range that holds it is cut and counted until a cut is narrower than what ``DIGITS`` keep.
    """
    while high - low > 10.0 ** -(DIGITS + 2):
        wide = (high - low) / CUTS
        inside = scores.where((F.col("raw") >= low) & (F.col("raw") <= high))
        cut = F.least(F.floor((F.col("raw") - low) / wide), F.lit(CUTS - 1)).alias("cut")
        for found in sorted(inside.groupBy(cut).agg(F.count("*"), F.min("raw"), F.max("raw")).collect()):
            if rank < found[1]:
                low, high = found[2], found[3]
                break
            rank -= found[1]
    return (low + high) / 2


def learn(docs: DataFrame, labels: DataFrame, learnable: Column) -> Ranking | None:
    """A ranking from all labelled rows of ``docs(doc_id, text)`` that may be learned from.

    Features are written to the shared folder and stay there: the driver gets sums by part of the score,
    a number of rows that does not grow with the tables, and counts of score ranges for the threshold.
    Labels other than 0 and 1 and null ids are left out.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")

    def measure(texts: list[str | None]) -> list[dict]:
        return [{"x": features(t).tolist()} for t in texts]

    measured = annotate(docs.select("doc_id", "text").where(learnable), ["doc_id"], "found", "x array<double>", lambda: measure)
    joined = measured.join(usable.where(learnable).distinct(), "doc_id")
    rows = materialize(joined.select(F.col("quality").cast("long").alias("quality"), F.col("found.x").alias("x")), "features")
    value = [F.col("x")[k] for k in range(len(FEATURES))]
    seen = rows.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("quality") == 0).alias("others"),
        F.array(*map(F.avg, value)).alias("centre"),
        F.array(*map(F.stddev_pop, value)).alias("width"),
    ).first()
    if seen.others in (0, seen.rows):
        return None
    centre, width = _scale(seen.centre, seen.width)
    weights = _solve(lambda w: _sums(rows, centre, width, w), len(FEATURES))
    raw = sum((v - float(c)) / float(s) * float(w) for v, c, s, w in zip(value, centre, width, weights))
    scores = rows.select(raw.alias("raw"))
    low, high = scores.agg(F.min("raw"), F.max("raw")).first()
    below, above = (value_at(scores, rank, low, high) for rank in _ranks(seen.rows, seen.others))
    return Ranking(centre, width, weights, round((below + above) / 2, DIGITS), 1.0)


def rank(docs: DataFrame, labels: DataFrame, columns: list[str], learnable: Column) -> DataFrame:
    """``columns`` of every row of ``docs`` and a struct ``quality`` of ``score`` and ``predicted``.

    ``score`` (0 to 1, higher is better) comes from the whole text alone; ``predicted`` is 1 from 0.5
    on. A null, empty or blank text has all features zero and is scored like any other. Repeated rows
    get the same score. Where there are no labels of both kinds, every score is 0.5. Columns that are
    not named are not read; an empty table gives an empty result.
    """
    ranking = learn(docs, labels, learnable)
    return annotate(docs, columns, "quality", "score double, predicted int", lambda: _scorer(ranking))


def learnable(doc_id: Column) -> Column:
    return fold(doc_id, FOLDS) != HELD_OUT


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning; false for a null id, which is not learned from either."""
    return F.coalesce(fold(doc_id, FOLDS) == HELD_OUT, F.lit(False))
