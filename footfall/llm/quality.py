"""Quality scores by Bradley-Terry ranking: a text's strength is learned from pairs of a better and a worse text.

The chance that one text of a pair is preferred is the logistic function of the difference of their strengths, and a
strength is linear in features of the text, so the loss is logistic on feature differences. Every labelled text that may
be learned from takes part: texts are dealt over blocks of bounded size, in which each good one meets each bad one, and
Newton's steps need of all blocks only sums as large as the square of the features. Strengths become scores between 0 and
1 so that the quantile of the training strengths at the share of bad texts falls on the cut.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from math import ceil, isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import labels_to_learn, stored, text_or_empty
from footfall.llm.ordering import running

#: At most so many pairs meet in one block, which bounds its memory; there are as many blocks as all texts need.
PAIRS = 65_536
#: Newton's steps at most, and the pull of the weights towards zero.
ROUNDS = 40
RIDGE = 1e-3
#: The score at which a text counts as good.
CUT = 0.3
_SYMBOLS = re.compile(r"[#*$%&|<>{}\[\]=_~^\\]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTERS = re.compile(r"[^\W\d_]")
_PUNCTUATION = re.compile(r"[!?;:\"']")
FEATURES = (
    "words", "word_length", "distinct_words", "repeated_next", "top_word", "symbols", "upper", "punctuation", "digits",
    "letters", "pipes", "exclamations", "repeated_lines", "line_words", "stops", "most_words_per_line", "short",
)


def features(text: str) -> list[float]:
    """What is measured of a text, most of it between 0 and 1, all of it over the whole text."""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    if not n:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    upper = len(_UPPER.findall(text))
    letters = len(_LETTERS.findall(text))
    repeated = sum(map(str.__eq__, words, words[1:]))
    longest = max(x.count(" ") + 1 for x in lines) if lines else n
    return [
        np.log1p(n) / 10,
        min(1.0, sum(map(len, counts)) / len(counts) / 20),
        len(counts) / n,
        repeated / n,
        max(counts.values()) / n,
        min(1.0, 5 * len(_SYMBOLS.findall(text)) / chars),
        upper / max(1, letters),
        min(1.0, 5 * len(_PUNCTUATION.findall(text)) / chars),
        sum(map(str.isdigit, text)) / chars if n < 20 else len(re.findall(r"\d", text)) / chars,
        letters / chars,
        min(1.0, text.count(" | ") / n * 4),
        min(1.0, text.count("!!") / n),
        1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, n / max(1, len(lines)) / 100),
        min(1.0, (text.count(". ") + text.count(".\n") + 1) / n * 4),
        min(1.0, longest / 400),
        1.0 if n < 20 else 0.0,
    ]


class Ranking:
    """Strength of a text: weights on standardised features and on their squares; ``shift`` and ``slope`` make scores."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray, shift: float = 0.0, slope: float = 1.0):
        self.mean, self.spread, self.weights, self.shift, self.slope = mean, spread, weights, shift, slope

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.hstack([z, z**2, np.maximum(z - 1, 0), np.maximum(-z - 1, 0)])

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        margin = np.clip(self.slope * (self.strengths(x) - self.shift) + np.log(CUT / (1 - CUT)), -30, 30)
        return 1 / (1 + np.exp(-margin))


#: Of some pairs: their number, the loss summed over them, its gradient and its second derivatives.
Sums = tuple[float, float, np.ndarray, np.ndarray]


def _block_sums(good: np.ndarray, bad: np.ndarray, w: np.ndarray) -> Sums:
    """Each row of ``good`` (expanded) preferred to each of ``bad``. No pair's difference is held, only its margin."""
    margin = np.clip((good @ w)[:, None] - (bad @ w)[None, :], -30, 30)
    wrong = 1 / (1 + np.exp(margin))
    bend = wrong * (1 - wrong)
    across = good.T @ bend @ bad
    curve = good.T @ (bend.sum(axis=1)[:, None] * good) + bad.T @ (bend.sum(axis=0)[:, None] * bad) - across - across.T
    return float(margin.size), float(np.log1p(np.exp(-margin)).sum()), bad.T @ wrong.sum(axis=0) - good.T @ wrong.sum(axis=1), curve


def _total(parts: list[Sums]) -> Sums:
    return tuple(sum(each) for each in zip(*parts))


def _minimise(sums: Callable[[np.ndarray], Sums], size: int, rounds: int, ridge: float) -> np.ndarray:
    """Newton's method on the mean loss and the ridge; a step that does not lower it is halved."""
    w, step, least = np.zeros(size), np.zeros(size), np.inf
    for _ in range(rounds):
        to = w - step
        pairs, loss, grad, curve = sums(to)
        value = loss / pairs + ridge / 2 * float(to @ to)
        if value > least:
            step = step / 2
        else:
            w, least = to, value
            step = np.linalg.solve(curve / pairs + ridge * np.eye(size), grad / pairs + ridge * w)
        if np.abs(step).max() < 1e-7:
            break
    return w


def _side(pairs: int) -> int:
    """Texts of the commoner label in a block."""
    return max(1, isqrt(pairs))


def _unfitted(mean: np.ndarray, spread: np.ndarray) -> Ranking:
    return Ranking(mean, np.where(spread > 1e-9, spread, 1.0), np.zeros(4 * len(FEATURES)))


def rank(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, rounds: int = ROUNDS, ridge: float = RIDGE) -> Ranking:
    """Fits strengths to rows in memory: all are dealt over blocks of at most ``pairs`` pairs, as ``fit`` does with a table."""
    model = _unfitted(x.mean(axis=0) if len(x) else np.zeros(len(FEATURES)), x.std(axis=0) if len(x) else np.ones(len(FEATURES)))
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return model  # nothing to prefer: every text scores the cut
    z = model.expand(x)
    blocks = ceil(max(len(good), len(bad)) / _side(pairs))
    rows = [[side[k % len(side) :: blocks] if len(side) < blocks else side[k::blocks] for side in (good, bad)] for k in range(blocks)]
    model.weights = _minimise(lambda w: _total([_block_sums(z[g], z[b], w) for g, b in rows]), z.shape[1], rounds, ridge)
    strength = z @ model.weights
    # the quantile at the share of bad texts; the middle between its neighbours
    in_order = np.sort(strength)
    at = len(bad)
    model.shift = float((in_order[at - 1] + in_order[min(at, len(in_order) - 1)]) / 2)
    model.slope = _slope(float(np.abs(strength - model.shift).mean()))
    return model


def _slope(mean_distance: float) -> float:
    return 4 / max(1e-6, mean_distance)


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``x`` (the features of the whole text; null counts as empty) and ``digest``, equal for equal texts."""

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    text = text_or_empty()
    return docs.select("doc_id", run(text).alias("x"), F.unhex(F.md5(text.cast("binary"))).alias("digest"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def blocks(rows: DataFrame, sizes: dict[int, int], pairs: int = PAIRS) -> DataFrame:
    """``good``, ``bad``: all rows of ``label``, ``digest``, ``x``, dealt over blocks of at most ``pairs`` pairs.

    Rows of the commoner label go round the blocks one by one, and those of the other too, each once if they suffice
    for all blocks and else again from the first, so that every block holds both. ``sizes`` are the rows of each label.
    """
    many = ceil(max(sizes.values()) / _side(pairs))
    dealt = None
    for label, size in sizes.items():
        own, _ = running(rows.where(F.col("label") == label).withColumn("one", F.lit(1).cast("long")), [F.col("digest")], "one", "place")
        place = F.col("place")
        every = F.sequence(place, F.lit(many - 1).cast("long"), F.lit(size).cast("long"))
        block = F.explode(every) if size < many else F.pmod(place, F.lit(many).cast("long"))
        part = own.select(block.alias("block"), "label", "x")
        dealt = part if dealt is None else dealt.unionByName(part)
    of = lambda label: F.array_sort(F.collect_list(F.when(F.col("label") == label, F.col("x"))))
    return dealt.groupBy("block").agg(of(1).alias("good"), of(0).alias("bad"))


def _sums_over(dealt: DataFrame, model: Ranking) -> Callable[[np.ndarray], Sums]:
    """``_block_sums`` added up over stored blocks: each partition sends one row of bounded size."""
    size = len(model.weights)

    def at(w: np.ndarray) -> Sums:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pairs, loss, grad, curve = 0.0, 0.0, np.zeros(size), np.zeros((size, size))
            for batch in batches:
                for k in range(batch.num_rows):
                    good, bad = (model.expand(_matrix(batch.column(c)[k].values)) for c in ("good", "bad"))
                    n, own, slope, bend = _block_sums(good, bad, w)
                    pairs, loss, grad, curve = pairs + n, loss + own, grad + slope, curve + bend
            yield pa.RecordBatch.from_pydict({"sums": pa.array([np.concatenate([[pairs, loss], grad, curve.ravel()])], pa.list_(pa.float64()))})

        parts = [np.array(r[0]) for r in dealt.mapInArrow(run, "sums array<double>").collect()]
        return _total([(p[0], p[1], p[2 : 2 + size], p[2 + size :].reshape(size, size)) for p in parts])

    return at


def fit(rows: DataFrame, labels: DataFrame, label: str = "quality", pairs: int = PAIRS) -> Ranking:
    """Fits to every labelled text of ``measured`` rows but the held-out ones; equal texts of a label count once."""
    known = labels_to_learn(labels, label)
    learned = stored(rows.join(known, "doc_id").groupBy("label", "digest").agg(F.first("x").alias("x")), "labelled")
    numbers = range(len(FEATURES))
    of = [measure(F.col("x")[k]) for measure in (F.avg, F.stddev_pop) for k in numbers]
    found = learned.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0), *of).first()
    good, bad, moments = found[0], found[1], np.array(found[2:], float).reshape(2, -1)
    model = _unfitted(*moments) if good + bad else _unfitted(np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    if not good or not bad:
        return model  # nothing to prefer: every text scores the cut
    dealt = stored(blocks(learned, {1: good, 0: bad}, pairs), "blocks")
    model.weights = _minimise(_sums_over(dealt, model), len(model.weights), ROUNDS, RIDGE)
    strength = learned.select(_of_features(F.col("x"), model.strengths).alias("strength"), F.lit(1).cast("long").alias("one"))
    placed, total = running(strength, [F.col("strength")], "one", "place")
    # the quantile at the share of bad texts; the middle between its neighbours
    next_to = placed.where(F.col("place").isin(bad - 1, min(bad, total - 1)))
    model.shift = float(next_to.agg(F.avg("strength")).first()[0])
    model.slope = _slope(placed.agg(F.avg(F.abs(F.col("strength") - model.shift))).first()[0])
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Ranking:
    """Fits to the texts of all labelled documents but the held-out ones."""
    return fit(stored(measured(docs), "measured"), labels, label)


def _of_features(x: Column, number: Callable[[np.ndarray], np.ndarray]) -> Column:
    @F.pandas_udf("double")
    def run(rows: pd.Series) -> pd.Series:
        return pd.Series(number(np.array(rows.tolist(), float).reshape(-1, len(FEATURES))))

    return run(x)


def score(x: Column, model: Ranking) -> Column:
    """The quality of a text by its features (``measured``), 0 to 1."""
    return _of_features(x, model.scores)
