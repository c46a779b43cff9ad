"""Line deduplication by an edit join over segments.

A line is a sequence of words; an edit replaces, adds or leaves out one. The threshold grows with the length of a line.
A line of n words falls into threshold + 1 segments. A line within the threshold holds at least one segment unchanged,
near its own place, so each line is indexed by its segments, with its length and the segment's number, and probes the
index with those of its runs of words that a segment of an equal or shorter line could be. Lines that meet in an entry
of the index are compared there by a banded, bit-parallel edit distance, in the order in which they stand in the corpus
and only with those that nothing before them is near to; pairs that are not near never leave the task. A line goes for
an earlier line that stays, never for one that goes itself. Equal lines are one entry, whatever their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import own_name, stored

#: Lines with fewer words are one another's copies only if they are equal. From here on one word may differ, and one
#: more each time the length is four-fold: two from 64 words, three from 256.
MIN_WORDS = 16
#: Bits of the filter that tells which lines take part in a pair; its size is fixed, so it may be sent to all tasks.
FILTER_BITS = 1 << 23
#: Bytes of lines that are indexed together, and distinct lines a task remembers to have indexed.
STRETCH = 1 << 20
SEEN = 60_000
_PROBE = 1 << 62


def edits(n: int, min_words: int = MIN_WORDS) -> int:
    """The edits within which a line of ``n`` words is near to another that is not shorter; 0: equal lines only."""
    k = 0
    while n >= min_words << 2 * k:
        k += 1
    return k


def segments(n: int, max_edits: int) -> list[tuple[int, int]]:
    """Start and length of the segments of a line of ``n`` words; the last ones are the longer by one."""
    parts = max_edits + 1
    short, longer = n // parts, n % parts
    out, at = [], 0
    for i in range(parts):
        size = short + (i >= parts - longer)
        out.append((at, size))
        at += size
    return out


def places(n: int, length: int, number: int, start: int, size: int, max_edits: int) -> range:
    """Where in a line of ``n`` words the segment ``number`` of a line of ``length`` <= n can stand unchanged.

    Of ``number`` segments to the left at least that many edits are spent when none of them is unchanged, and the same
    holds seen from the right end, which leaves few places.
    """
    more = n - length
    low = max(0, start - number, start + more - (max_edits - number))
    high = min(n - size, start + number, start + more + (max_edits - number))
    return range(low, high + 1)


def within(a: Sequence, b: Sequence, max_edits: int) -> bool:
    """Whether the edit distance of ``a`` and ``b`` is at most ``max_edits``.

    Equal ends go first. Of the rest, a word of 2 * max_edits + 1 bits holds one diagonal band of the table: bit i says
    that the differences down the band rise there. Each word shifts the band by one.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > max_edits:
        return False
    if a == b:
        return True
    low, high = 0, len(a)
    while low < high:  # the longest common beginning, by halves
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    a, b = a[low:], b[low:]
    low, high = 0, len(a)
    while low < high:
        mid = (low + high + 1) // 2
        if a[len(a) - mid :] == b[len(b) - mid :]:
            low = mid
        else:
            high = mid - 1
    a, b = a[: len(a) - low], b[: len(b) - low]
    if not a:
        return True
    return _band(a, b, max_edits)


def _band(a: Sequence, b: Sequence, k: int) -> bool:
    """Bit-parallel states of at most 0..k edits over the band of diagonals -k..k (a is the shorter).

    Bit d of ``reach[e]`` after i words of ``a`` says that they meet i + d - k words of ``b`` in at most e edits.
    """
    full = (1 << 2 * k + 1) - 1
    n = len(b)
    reach = []
    for e in range(k + 1):
        reach.append(((1 << k + e + 1) - 1) & ~((1 << k) - 1) & full)  # the first e words of b left out
    for i, c in enumerate(a):
        equal = 0
        for d in range(2 * k + 1):
            j = i + d - k
            if 0 <= j < n and b[j] == c:
                equal |= 1 << d
        after = []
        for e in range(k + 1):
            bits = reach[e] & equal  # the same word on both sides
            if e:
                bits |= reach[e - 1]  # one word replaced
                bits |= reach[e - 1] >> 1  # one of a left out
                bits |= after[e - 1] << 1  # one of b left out
            after.append(bits & full)
        if not after[k]:
            return False
        reach = after
    d = n - len(a) + k
    return bool(reach[k] >> d & 1)


# ---------------------------------------------------------------------------------------------------- lines


def _lines(text: str | None) -> list[bytes]:
    """The lines of a text, their words joined by one space each; empty where a line has no word."""
    return [b" ".join(x.split()) for x in text.encode("utf-8").split(b"\n")] if text else []


def line_key(line: bytes) -> tuple[int, int]:
    """Two numbers of 62 and 64 bits that stand for a line."""
    key = xxhash.xxh3_128_intdigest(line)
    return key >> 66, key & (1 << 64) - 1


def _longs(values: list[int] | np.ndarray) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _identified(docs: DataFrame) -> DataFrame:
    """Rows of one id and one text are one document: ``doc_id`` with the hash ``th`` of the text."""
    return docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("th"), "text")


def _occurrences(docs: DataFrame) -> DataFrame:
    """``k1``, ``k2`` (the line), ``doc_id``, ``th``, ``line_no`` of every line with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, number, k1, k2 = [], [], [], []
            for r, text in enumerate(batch.column("text").to_pylist()):
                for i, line in enumerate(_lines(text)):
                    if line:
                        a, b = line_key(line)
                        own.append(r)
                        number.append(i)
                        k1.append(a)
                        k2.append(b)
            rows = pa.array(own, pa.int64())
            columns = [_longs(k1), _longs(k2), batch.column("doc_id").take(rows), batch.column("th").take(rows), pa.array(number, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "doc_id", "th", "line_no"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _identified(docs).mapInArrow(run, f"k1 long, k2 long, doc_id {kind}, th long, line_no int")


# ---------------------------------------------------------------------------------------------------- the index


@lru_cache(4096)
def _entries_of(n: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The entries of a line of ``n`` words: first and last word, what length and segment they stand for, whether a probe."""
    rows = [(at, at + size - 1, n * 64 + i, 0) for i, (at, size) in enumerate(segments(n, edits(n, min_words)))]
    for length in range(max(min_words, n - edits(n, min_words)), n + 1):
        k = edits(length, min_words)
        for i, (at, size) in enumerate(segments(length, k)):
            rows += [(p, p + size - 1, length * 64 + i, 1) for p in places(n, length, i, at, size, k) if length != n or p != at]
    return tuple(np.array(c, np.int64) for c in zip(*rows))


@lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo two to the 64th."""
    base = 0x9E3779B97F4A7C15
    both = []
    for x in (base, pow(base, -1, 1 << 64)):
        powers = np.full(size + 1, x, np.uint64)
        powers[0] = 1
        both.append(np.cumprod(powers, dtype=np.uint64))
    return both[0], both[1]


def _hashed(lines: list[bytes], keys: list[int], min_words: int) -> pa.RecordBatch:
    """The entries of lines. Runs of words are hashed by differences of running sums; equal hashes are only candidates."""
    text = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    end = np.flatnonzero((text == 32) | (text == 10))
    start = np.concatenate(([0], end[:-1] + 1))
    up, down = _powers(max(STRETCH, 1 << int(len(text) - 1).bit_length()))
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[: len(text)], out=sums[1:])
    sizes = np.array([line.count(b" ") + 1 for line in lines])
    opens = np.cumsum(sizes) - sizes
    own = np.array(keys, np.int64)
    h, k = [], []
    for n in np.unique(sizes):
        of = np.flatnonzero(sizes == n)
        first, last, stands, probe = _entries_of(int(n), min_words)
        a, b = start[opens[of, None] + first], end[opens[of, None] + last]
        value = (sums[b] - sums[a]) * down[a]
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + stands.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        h.append((value ^ (value >> np.uint64(32))).ravel())
        k.append((own[of, None] + probe * _PROBE).ravel())
    return pa.RecordBatch.from_arrays([_longs(np.concatenate(h)), pa.array(np.concatenate(k))], names=["h", "k"])


def _entries(docs: DataFrame, min_words: int) -> DataFrame:
    """``h`` (a segment or a probe with the length and number it stands for), ``k`` (the line; from ``_PROBE`` on a probe)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # what this task gave already; forgetting gives it again, which changes nothing
        lines, keys, size = [], [], 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for line in _lines(text):
                    if line.count(b" ") + 1 < min_words:
                        continue
                    key = line_key(line)[0]
                    if key in seen:
                        continue
                    if len(seen) > SEEN:
                        seen.clear()
                    seen.add(key)
                    if lines and size + len(line) >= STRETCH - 1:
                        yield _hashed(lines, keys, min_words)
                        lines, keys, size = [], [], 0
                    lines.append(line)
                    keys.append(key)
                    size += len(line) + 1
        if lines:
            yield _hashed(lines, keys, min_words)

    return docs.select("text").mapInArrow(run, "h long, k long")


def _met(entries: DataFrame) -> DataFrame:
    """``h``, ``k1``: entries of the index in which a line meets another. Sorted, so nothing of an entry is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 0), np.int64)  # the last entry so far: its first row, or two rows once lines have met in it
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in ("h", "k")])
            fresh = held.shape[1]
            rows = np.concatenate((held, rows), axis=1)
            if not rows.shape[1]:
                continue
            h, key = rows[0], rows[1] & (_PROBE - 1)
            opens = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            group = np.repeat(np.arange(len(opens)), np.diff(np.append(opens, len(h))))
            indexed = rows[1][opens] < _PROBE  # segments sort before probes
            several = np.logical_or.reduceat(key != key[opens][group], opens)
            give = (indexed & several)[group]
            given = give.copy()
            if fresh == 2:
                given[:2] = False  # these two have been given already
            yield pa.RecordBatch.from_arrays([pa.array(h[given]), pa.array(key[given])], names=["h", "k1"])
            last = slice(opens[-1], len(h))
            if give[-1]:
                other = opens[-1] + int(np.flatnonzero(key[last] != key[opens[-1]])[0])
                held = rows[:, [opens[-1], other]]
            else:
                held = rows[:, opens[-1] : opens[-1] + 1]

    return entries.repartition("h").sortWithinPartitions("h", "k").mapInArrow(run, "h long, k1 long").distinct()


# ---------------------------------------------------------------------------------------------------- links


def _filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of ``FILTER_BITS`` bits with those of ``keys`` set. It only spares lines a way: more keys, more ways."""
    at = F.pmod("k1", F.lit(FILTER_BITS))
    words = keys.groupBy(F.floor(at / 32).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (at % 32).cast("int"))).alias("bits"))
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    for word, bits in words.collect():  # at most FILTER_BITS / 32 rows
        out[word] = bits
    return out


def _texts(docs: DataFrame, wanted: np.ndarray, min_words: int) -> DataFrame:
    """``k1``, ``k2``, ``line`` of the lines the bitmap lets through."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, seen = sent.value, set()
        for batch in batches:
            k1, k2, found = [], [], []
            for text in batch.column("text").to_pylist():
                for line in _lines(text):
                    if line.count(b" ") + 1 >= min_words:
                        key, more = line_key(line)
                        at = key % FILTER_BITS
                        if bitmap[at >> 5] >> np.uint32(at & 31) & 1 and key not in seen:
                            if len(seen) > SEEN:
                                seen.clear()
                            seen.add(key)
                            k1.append(key)
                            k2.append(more)
                            found.append(line)
            yield pa.RecordBatch.from_arrays([_longs(k1), _longs(k2), pa.array(found, pa.binary())], names=["k1", "k2", "line"])

    return docs.select("text").mapInArrow(run, "k1 long, k2 long, line binary")


class _Meeting:
    """The lines of one entry in the order of the corpus, told apart into leaders and those near an earlier leader."""

    def __init__(self, min_words: int):
        self.min_words = min_words
        self.lines: list[tuple[tuple, list[bytes]]] = []
        self.leads: list[bool] = []
        self.marks = np.zeros(16, np.uint64)
        self.sizes = np.zeros(16, np.int64)

    def add(self, key: tuple, line: bytes) -> list[tuple]:
        """The earlier lines that ``line`` is near to: leaders, or all if it becomes a leader itself."""
        words = line.split()
        mark = 0
        for w in words:
            mark ^= 1 << (xxhash.xxh32_intdigest(w) & 63)  # an edit changes two of these bits at most
        n = len(self.lines)
        if n == len(self.marks):
            self.marks, self.sizes = np.resize(self.marks, 2 * n), np.resize(self.sizes, 2 * n)
        k = edits(len(words), self.min_words)
        apart = np.abs(self.sizes[:n] - len(words))
        close = (apart <= k) & (np.bitwise_count(self.marks[:n] ^ np.uint64(mark)) <= 2 * k)
        near, follows = [], False
        for lead in (True, False):
            if lead or not follows:
                for i in np.flatnonzero(close).tolist():
                    other, theirs = self.lines[i]
                    if self.leads[i] == lead and within(words, theirs, edits(min(len(words), len(theirs)), self.min_words)):
                        near.append(other)
                        follows |= lead
        self.lines.append((key, words))
        self.leads.append(not follows)
        self.marks[n], self.sizes[n] = mark, len(words)
        return near


def _links(met: DataFrame, lines: DataFrame, min_words: int) -> DataFrame:
    """``a1``, ``a2``, ``b1``, ``b2``: pairs of near lines, the earlier first, at least one of them a leader where they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, meeting = None, None
        for batch in batches:
            out = []
            for h, k1, k2, line in zip(*(batch.column(c).to_pylist() for c in ("h", "k1", "k2", "line"))):
                if h != at:
                    at, meeting = h, _Meeting(min_words)
                out += [(*other, k1, k2) for other in meeting.add((k1, k2), line)]
            columns = [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(columns, names=["a1", "a2", "b1", "b2"])

    placed = met.join(lines, "k1").select("h", "at", "k1", "k2", "line").repartition("h")
    return placed.sortWithinPartitions("h", "at", "k1", "k2").drop("at").mapInArrow(run, "a1 long, a2 long, b1 long, b2 long").distinct()


def _decided(links: DataFrame) -> DataFrame:
    """``k1``, ``k2``, ``stays`` of every line that is linked to an earlier one: it goes if one of these stays.

    A line is decided once all it hangs on is, or one of it stays; each round decides the earliest open line at least.
    """
    later = links.select(F.col("b1").alias("k1"), F.col("b2").alias("k2")).distinct()
    state = stored(later.withColumn("stays", F.lit(None).cast("boolean")), "line-state")
    while not state.where("stays is null").isEmpty():
        of = state.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.coalesce(F.col("stays").cast("int"), F.lit(2)).alias("earlier"))
        seen = links.join(of, ["a1", "a2"], "left").withColumn("earlier", F.coalesce("earlier", F.lit(1)))
        seen = seen.groupBy(F.col("b1").alias("k1"), F.col("b2").alias("k2")).agg(
            F.max(F.col("earlier") == 1).alias("goes"), F.max(F.col("earlier") == 2).alias("waits")
        )
        now = F.when(F.col("goes"), False).when(F.col("waits"), None).otherwise(True)
        state = stored(state.drop("stays").join(seen, ["k1", "k2"]).select("k1", "k2", now.alias("stays")), "line-state")
    return state


def _gone(docs: DataFrame, first: DataFrame, min_words: int) -> DataFrame:
    """``k1``, ``k2`` of the lines that are near to an earlier line that stays.

    Two lines that both follow leaders are not compared where they meet; should both stay, as their leaders go, they
    meet again without the others, until no link is new.
    """
    met = stored(_met(_entries(docs, min_words)), "line-met")
    keys = met.select("k1").distinct()
    texts = _texts(docs, _filter(keys), min_words).join(keys, "k1", "left_semi").dropDuplicates(["k1", "k2"])
    lines = stored(texts.join(first, ["k1", "k2"]), "line-texts")
    links = stored(_links(met, lines, min_words), "line-links")
    while True:
        state = _decided(links)
        again = stored(state.where("stays").select("k1", "k2"), "line-again")
        if again.isEmpty():
            break
        own = lines.join(again, ["k1", "k2"], "left_semi")
        more = _links(met.join(own.select("k1").distinct(), "k1", "left_semi"), own, min_words)
        new = stored(more.join(links, ["a1", "a2", "b1", "b2"], "left_anti"), "line-more")
        if new.isEmpty():
            break
        links = stored(links.unionByName(new), "line-links")
    return state.where(~F.col("stays")).select("k1", "k2")


def kept_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``th`` (hash of the text), ``keep``: the numbers of the lines that stay, for texts that keep any.

    A line stays if no line before it, in the order of doc_id (null first), hash of the text and line number, is equal
    to it, and none before it that stays is near to it: within ``edits`` of the shorter one's words. White space around
    and between words doesn't count.
    """
    at = F.struct("doc_id", "th", "line_no")
    first = stored(_occurrences(docs).groupBy("k1", "k2").agg(F.min(at).alias("at")), "line-firsts")
    stay = first.join(_gone(docs, first, min_words), ["k1", "k2"], "left_anti")
    return stay.groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.th").alias("th")).agg(F.collect_list("at.line_no").alias("keep"))


def _joined(docs: DataFrame, min_words: int, names: tuple[str, str]) -> DataFrame:
    keep, th = names
    found = kept_lines(docs, min_words).select(F.col("doc_id").alias("id"), F.col("th").alias("hash"), F.col("keep").alias(keep))
    rows = docs.withColumn(th, F.xxhash64(F.coalesce(F.col("text"), F.lit("")))).alias("rows")
    found = found.alias("found")
    met = F.col("rows.doc_id").eqNullSafe(F.col("found.id")) & (F.col(f"rows.{th}") == F.col("found.hash"))
    return rows.join(found, met, "left").select("rows.*", f"found.{keep}")


def _rest(text: str, keep: set[int]) -> tuple[str, int, int]:
    """What is left of a text, its lines and how many stay. Blank lines stay unless nothing else does."""
    lines = text.split("\n")
    filled = [bool(x.strip(" \t\n\r\x0b\x0c")) for x in lines]
    if not any(i in keep for i, x in enumerate(filled) if x):
        return "", sum(filled), 0
    left = [x for i, x in enumerate(lines) if not filled[i] or i in keep]
    return "\n".join(left), sum(filled), sum(i in keep for i, x in enumerate(filled) if x)


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of lines taken out of ``text``; every row stays, a text without a line left is empty.

    Null texts stay null. Rows of equal id and text are one document and keep the same lines. An empty table gives none.
    """
    keep, th = own_name("keep"), own_name("th")

    @F.pandas_udf("string")
    def rest(texts: pd.Series, kept: pd.Series) -> pd.Series:
        return pd.Series([_rest(t, set() if k is None else set(k))[0] if isinstance(t, str) else None for t, k in zip(texts, kept)])

    return _joined(docs, min_words, (keep, th)).withColumn("text", rest("text", keep)).select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``n_lines`` (not blank), ``n_kept``, ``kept_sha256`` (of what is left of the text) of every row.

    Null and empty texts have no lines; repeated rows get the same answer; an empty table gives none.
    """

    @F.pandas_udf("n_lines long, n_kept long, kept_sha256 string")
    def told(texts: pd.Series, kept: pd.Series) -> pd.DataFrame:
        rows = []
        for t, k in zip(texts, kept):
            left, n, stay = _rest(t if isinstance(t, str) else "", set() if k is None else set(k))
            rows.append((n, stay, hashlib.sha256(left.encode("utf-8")).hexdigest()))
        return pd.DataFrame(rows, columns=["n_lines", "n_kept", "kept_sha256"])

    rows = _joined(docs.select("doc_id", "text"), min_words, ("keep", "row_th"))
    return rows.select("doc_id", told("text", "keep").alias("told")).select("doc_id", "told.*")
