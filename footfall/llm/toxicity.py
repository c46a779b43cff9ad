"""Toxic texts by a support vector machine over a gap-weighted subsequence kernel, with Nyström landmarks.

Two words are alike in the measure of the character subsequences they share, where gaps weaken a subsequence but do not
end it: an insult with characters put between or an ending put after still shares most of them. Letters that stand
alone one after the other count as one word. A sentence is judged by its worst word, a text by its worst sentence.

Labels are given to whole texts. Training starts from the words that mark labelled sentences of toxic texts, takes the
word by which each toxic text is condemned as its example, and the worst words of clean texts as theirs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import own_name, sample_texts

#: At most so many texts of each label are used to fit; all texts are scored.
TRAINING_TEXTS = 1_500
LANDMARKS = 96
#: Length of the subsequences compared, and the weight of each character that one spans.
LENGTH, DECAY = 3, 0.6
#: Times that the examples are chosen anew.
ROUNDS = 4
#: Characters of a word the kernel sees at once; longer words are judged by overlapping parts, all of them.
SPAN = 24
REMEMBERED = 100_000
_SENTENCE = re.compile(r"[.!?\n]+(?:\s|$)")
_SPELT = re.compile(r"(?:^|\s)\S\s+\S\s+\S(?:\s|$)")
_EDGES = re.compile(r"^\W+|\W+$")
#: Characters that landmarks may consist of, the most frequent ones; the mark of a beginning is the first.
ALPHABET = 128


def words_of(text: str) -> set[str]:
    """The lower-case words of a text. Three or more characters of a sentence that stand alone are one word as well."""
    text = text.lower()
    words = set(text.split())
    if _SPELT.search(text):
        for sentence in _SENTENCE.split(text):
            run: list[str] = []
            for w in [*sentence.split(), ""]:
                if len(w) == 1:
                    run.append(w)
                else:
                    if len(run) > 2:
                        words.add("".join(run))
                    run = []
    return words


def parts_of(word: str) -> list[str]:
    if not word.isalnum():
        word = _EDGES.sub("", word)
    if len(word) <= SPAN:
        return [word] if len(word) >= LENGTH else []
    return [word[i : i + SPAN] for i in range(0, len(word) - SPAN // 2, SPAN // 2)]


def _codes(words: list[str]) -> np.ndarray:
    """Words as rows of code points behind a mark for their beginning, filled up with zeros to the longest."""
    lengths = np.array([len(w) for w in words])
    out = np.zeros((len(words), 1 + lengths.max()), np.int32)
    out[:, 0] = 1
    out[:, 1:][np.arange(lengths.max()) < lengths[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), np.int32)
    return out


def _own(codes: np.ndarray) -> np.ndarray:
    """The kernel of each word with itself: sum over pairs of equal subsequences of ``LENGTH`` characters, each weighing
    DECAY to the power of what it spans in either place."""
    n = codes.shape[1]
    step = np.arange(n)[None, :] - np.arange(n)[:, None] - 1
    earlier = np.where(step >= 0, DECAY ** np.maximum(step, 0), 0).astype(np.float32)  # decay from a place to later ones
    match = ((codes[:, :, None] == codes[:, None, :]) & (codes != 0)[:, :, None]) * np.float32(DECAY**2)
    ending = match
    for _ in range(LENGTH - 1):  # ``ending`` is symmetric in its two places, so each turn sums over one of them
        ending = match * ((ending @ earlier).transpose(0, 2, 1) @ earlier)
    return ending.sum(axis=(1, 2))


def _triples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All choices of three of ``n`` places in order, and the weight of what they span."""
    i, j, k = np.array([(i, j, k) for i in range(n) for j in range(i + 1, n) for k in range(j + 1, n)]).T
    return i, j, k, (DECAY ** (k - i + 1)).astype(np.float32)


class Kernel:
    """The normalised kernel of words with fixed landmarks.

    It is linear in the weighted subsequences of a word, so any fixed combination of landmarks is one table with a
    value for each subsequence of three characters, and its value for a word takes one sweep over the word.
    """

    def __init__(self, landmarks: list[str]):
        used = Counter(c for w in landmarks for c in w)
        chars = sorted(used, key=lambda c: (-used[c], c))[: ALPHABET - 2]
        self.size = len(chars) + 2
        self.classes = np.zeros(0x110000, np.int32)
        self.classes[1] = 1
        self.classes[[ord(c) for c in chars]] = np.arange(2, self.size)
        codes = _codes(landmarks)
        norms = np.sqrt(np.maximum(_own(codes), 1e-12))
        self.tables = []  # for each landmark: places in the table, and their values
        for row, norm in zip(self._classed(codes), norms):
            i, j, k, weight = _triples(int((row != 0).sum()))
            at = self._place(row[i], row[j], row[k])
            found, where = np.unique(at, return_inverse=True)
            self.tables.append((found, np.bincount(where, weight) / norm))
        basis = self.similar(landmarks)
        values, vectors = np.linalg.eigh(basis)
        good = values > 1e-4
        self.root = vectors[:, good] / np.sqrt(values[good])

    def _place(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (a * self.size + b) * self.size + c

    def _classed(self, codes: np.ndarray) -> np.ndarray:
        """Classes of characters; those that no landmark has are class 0, for which every table holds 0."""
        return self.classes[codes]

    def table(self, weights: np.ndarray) -> np.ndarray:
        """The combination of the landmarks with ``weights``."""
        out = np.zeros(self.size**3, np.float32)
        for (at, value), w in zip(self.tables, weights):
            out[at] += (w * value).astype(np.float32)
        grid = out.reshape(self.size, self.size, self.size)
        grid[0], grid[:, 0], grid[:, :, 0] = 0, 0, 0
        return out

    def apply(self, table: np.ndarray, words: list[str]) -> np.ndarray:
        """What the combination in ``table`` gives for each word."""
        return self.apply_all([table], words)[:, 0]

    def apply_all(self, tables: list[np.ndarray], words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(tables)), np.float32)
        lengths = np.array([len(w) for w in words])
        for n in np.unique(lengths):  # words of one length are worked on together
            of_length = np.flatnonzero(lengths == n)
            i, j, k, weight = _triples(n + 1)
            step = max(16, min(2048, 200_000 // len(i)))  # bounds the memory of a sweep
            for at in range(0, len(of_length), step):
                rows = of_length[at : at + step]
                codes = _codes([words[r] for r in rows])
                classed = self._classed(codes).T
                place = self._place(classed[i], classed[j], classed[k])
                norm = np.sqrt(np.maximum(_own(codes), 1e-12))
                for t, table in enumerate(tables):
                    out[rows, t] = weight @ table[place] / norm
        return out

    def similar(self, words: list[str]) -> np.ndarray:
        """Rows by word, columns by landmark."""
        eye = np.eye(len(self.tables))
        return self.apply_all([self.table(e) for e in eye], words).astype(np.float64)


class Model:
    """A separating plane over the landmarks, and the slope that turns margins into scores."""

    def __init__(self, landmarks: list[str], weights: np.ndarray, bias: float, slope: float):
        self.landmarks, self.weights, self.bias, self.slope = landmarks, weights, bias, slope

    def scorer(self) -> Callable[[list[str]], list[float]]:
        """From texts to scores between 0 and 1. New words of many texts are judged together and remembered."""
        kernel, known = Kernel(self.landmarks), {}
        table = kernel.table(self.weights)

        def run(texts: list[str]) -> list[float]:
            out: list[float] = []
            for at in range(0, len(texts), 128):
                if len(known) > REMEMBERED:
                    known.clear()
                words = [words_of(t) for t in texts[at : at + 128]]
                self._judge(kernel, table, list(set().union(*words) - known.keys()), known)
                out += [max(map(known.__getitem__, own), default=-10.0) for own in words]
            return (1 / (1 + np.exp(-self.slope * np.clip(np.array(out), -10, 10)))).tolist()

        return run

    def _judge(self, kernel: Kernel, table: np.ndarray, new: list[str], known: dict[str, float]) -> None:
        parts, owner = [], []
        for w in new:
            known[w] = -10.0
            own = parts_of(w)
            parts += own
            owner += [w] * len(own)
        if parts:
            margins = (kernel.apply(table, parts) + self.bias).tolist()
            for w, margin in zip(owner, margins):
                if margin > known[w]:
                    known[w] = margin


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 400, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Squared hinge loss by accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = weight / weight.sum()
    step = 1 / (2 * (weight * (x**2).sum(axis=1)).sum() + ridge)
    w = v = np.zeros(x.shape[1])
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v))
        grad = -2 * x.T @ (weight * y * slack) + ridge * np.append(v[:-1], 0)
        w, old = v - step * grad, w
        v = w + k / (k + 3) * (w - old)
    return w[:-1], float(w[-1])


def fit(toxic: list[str], clean: list[str], landmarks: int = LANDMARKS) -> Model:
    """Learns from texts of either label. Without any of one label nothing can be told apart: all score 0."""
    bags = [sorted({p for w in words_of(t) for p in parts_of(w)}) for t in toxic]
    others = [sorted({p for w in words_of(t) for p in parts_of(w)}) for t in clean]
    bags, others = [b for b in bags if b], [b for b in others if b]
    if not bags or not others:
        return Model(["none"], np.zeros(1), -10.0, 1.0)
    seen, clear = Counter(p for b in bags for p in b), Counter(p for b in others for p in b)
    rate = lambda p: (seen[p] + 0.1) / len(bags) / ((clear[p] + 0.5) / len(others))
    marked = sorted((p for p in seen if seen[p] > 1 or len(bags) < 20), key=lambda p: (-seen[p] * np.log(rate(p)), p))
    chosen: list[str] = []
    shared = Counter()
    for p in marked:  # words that begin alike share landmarks
        if rate(p) > 3 and shared[p[:4]] < 8 and len(chosen) < landmarks * 2 // 3:
            shared[p[:4]] += 1
            chosen.append(p)
    frequent = [p for p, _ in sorted(clear.items(), key=lambda x: (-x[1], x[0])) if p not in chosen and len(p) > 3]
    chosen += frequent[: landmarks - len(chosen)]
    if not chosen:
        return Model(["none"], np.zeros(1), -10.0, 1.0)
    kernel = Kernel(chosen)
    vocabulary = sorted({p for b in bags + others for p in b})
    place = {p: i for i, p in enumerate(vocabulary)}
    index = [np.array([place[p] for p in b]) for b in bags]
    index_clean = [np.array([place[p] for p in b]) for b in others]
    margin = np.array([np.log(rate(p)) * np.log1p(seen[p]) for p in vocabulary])
    negatives: set[int] = {place[p] for p in chosen if clear[p]}
    weights, bias = np.zeros(len(chosen)), 0.0
    for _ in range(ROUNDS):
        witness = Counter(int(i[np.argmax(margin[i])]) for i in index)
        negatives |= {int(i[np.argmax(margin[i])]) for i in index_clean}
        bad, good = list(witness), sorted(negatives)
        count_bad = np.array([witness[i] for i in bad], float)
        count_clean = np.array([max(1, min(50, clear[vocabulary[i]])) for i in good], float)
        x = kernel.similar([vocabulary[i] for i in bad + good]) @ kernel.root
        y = np.concatenate([np.ones(len(bad)), -np.ones(len(good))])
        plane, bias = _svm(x, y, np.concatenate([count_bad / count_bad.sum(), count_clean / count_clean.sum()]))
        weights = kernel.root @ plane
        margin = kernel.apply(kernel.table(weights), vocabulary) + bias
    top = np.array([margin[i].max() for i in index])
    low = np.array([margin[i].max() for i in index_clean])
    cuts = np.unique(np.concatenate([top, low]))
    cuts = (cuts[:-1] + cuts[1:]) / 2 if len(cuts) > 1 else cuts
    tops, lows = np.sort(top), np.sort(low)
    wrong = np.searchsorted(tops, cuts) / len(tops) + 1 - np.searchsorted(lows, cuts) / len(lows)
    best = cuts[np.flatnonzero(wrong == wrong.min())]
    return Model(chosen, weights, bias - float(np.median(best)), 4.0)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", at_most: int = TRAINING_TEXTS) -> Model:
    """Fits on at most ``at_most`` labelled texts of either label, chosen by a hash of their ids; held-out rows never."""
    rows = sorted(sample_texts(docs, labels, label, at_most).collect())
    return fit([r.text for r in rows if r.label == 1], [r.text for r in rows if r.label == 0])


def score(text: Column, model: Model) -> Column:
    """The toxicity of a whole text, 0 to 1; null and empty texts have a score near 0."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        judge = model.scorer()
        for texts in batches:
            yield pd.Series(judge([t if isinstance(t, str) else "" for t in texts]))

    return run(text)


def without_toxic(docs: DataFrame, model: Model, at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``at``, as they were."""
    found = own_name("toxicity")
    return docs.withColumn(found, score(F.col("text"), model)).where(F.col(found) < at).drop(found)
