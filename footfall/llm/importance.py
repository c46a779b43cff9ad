"""Importance resampling towards a target: documents are drawn by how much more their word runs belong to it.

Features are runs of one to three words, hashed by CRC-32. The checksum is linear up to a constant of the length: each
byte adds, by exclusive or, what a table holds for it and its distance from the end. So all features of a batch of texts
come from one table lookup for each byte and run length and ``bitwise_xor.reduceat`` over the spans; spans longer than
the table are taken in blocks, each folded over the next.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored
from footfall.llm.ordering import running

#: Hash buckets of the features.
BUCKETS = 10_000
#: Distances from the end that the table holds; longer spans fold blocks of as many bytes.
REACH = 128
#: Words of a run, at most; words a document needs to be drawn; per cent drawn; seed of the draw.
RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Bytes of text and words looked at together.
STRETCH = 1 << 20


# ---------------------------------------------------------------------------------------------------- checksums


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a byte adds by its distance from the end (row 0: nothing, row d + 1: distance d); the constants of the
    lengths up to ``REACH``; for each byte of a checksum, what it becomes over ``REACH`` further bytes."""
    zero = zlib.crc32(b"\0")
    single = np.array([zlib.crc32(bytes([b])) ^ zero for b in range(256)], np.uint32)
    by_place = np.zeros((REACH + 1, 256), np.uint32)
    by_place[1] = single
    for d in range(2, REACH + 1):
        by_place[d] = by_place[d - 1] >> 8 ^ single[by_place[d - 1] & 255]
    lengths = np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)
    fold = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    for _ in range(REACH):
        fold = fold >> 8 ^ single[fold & 255]
    return by_place, lengths, fold


def _long(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Checksums of spans of any length: blocks of ``REACH`` bytes, the first one filled up with zeros in front."""
    by_place, _, fold = _tables()
    blocks = -(-(end - start) // REACH)
    first = np.cumsum(blocks) - blocks
    parts = np.zeros(int(blocks.sum()), np.uint32)
    places = np.arange(REACH, 0, -1) * 256
    for i in range(len(start)):  # long spans are few
        padded = np.zeros(int(blocks[i]) * REACH, np.uint8)
        padded[len(padded) - int(end[i] - start[i]) :] = text[start[i] : end[i]]
        index = (padded.reshape(-1, REACH) + places).ravel()
        parts[first[i] : first[i] + blocks[i]] = np.bitwise_xor.reduceat(by_place.ravel()[index], np.arange(0, len(index), REACH))
    state = np.zeros(len(start), np.uint32)
    for turn in range(int(blocks.max(initial=0))):
        on = np.flatnonzero(blocks > turn)
        s = state[on]
        s = fold[0][s & 255] ^ fold[1][s >> 8 & 255] ^ fold[2][s >> 16 & 255] ^ fold[3][s >> 24]
        state[on] = s ^ parts[first[on] + turn]
    constants = {n: zlib.crc32(bytes(n)) for n in set((end - start).tolist())}
    return state ^ np.array([constants[n] for n in (end - start).tolist()], np.uint32)


def checksums(text: np.ndarray, start: np.ndarray, length: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """For runs of 1 to ``RUN`` words, the CRC-32 of the run that ends with each word, and whether there is one.

    ``text`` holds the words, each followed by a space; word j starts at ``start[j]`` and belongs to ``doc[j]``. The
    bytes of word k and of the space behind it add the same to every run that ends with word k + s.
    """
    by_place, lengths, _ = _tables()
    flat = by_place.ravel()
    words, end = len(start), start + length
    out: list[np.ndarray] = []
    state = np.zeros(words, np.uint32)
    for s in range(min(RUN, words)):
        adds = np.zeros(words, np.uint32)
        whole = np.zeros(words, bool)
        whole[s:] = doc[s:] == doc[: words - s]
        span = np.zeros(words, np.int64)
        span[s:] = end[s:] - start[: words - s]
        for a, b in _stretches(start, end, words - s):
            at = np.arange(start[a], end[b - 1] + 1)
            place = np.repeat(end[a + s : b + s], length[a:b] + 1) - at  # the distance from the end, and 1
            index = np.clip(place, 0, REACH) * 256 + text[at]
            adds[a + s : b + s] = np.bitwise_xor.reduceat(flat[index], start[a:b] - start[a])
        state = state ^ adds
        found = state ^ lengths[np.minimum(span, REACH)]
        far = np.flatnonzero(whole & (span > REACH))
        if len(far):
            found[far] = _long(text, start[far - s], end[far])
        out.append(np.where(whole, found.astype(np.int64), -1))
    return out


def _stretches(start: np.ndarray, end: np.ndarray, words: int) -> Iterator[tuple[int, int]]:
    """Ranges of the first ``words`` words, of about ``STRETCH`` bytes each."""
    a = 0
    while a < words:
        b = max(a + 1, int(np.searchsorted(end[:words], start[a] + STRETCH)))
        yield a, b
        a = b


# Word characters keep, letters A-Z lose, their case; all else parts words.
_AS_WORD = np.full(256, 32, np.uint8)
for _range in (range(0x30, 0x3A), range(0x61, 0x7B), range(0x80, 0x100)):
    _AS_WORD[list(_range)] = list(_range)
_AS_WORD[list(range(0x41, 0x5B))] = list(range(0x61, 0x7B))


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts that lie one after the other, as ``checksums`` takes them: text, starts, lengths, documents."""
    lowered = _AS_WORD[raw]
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = lowered != 32
    borders = np.zeros(len(raw) + 1, bool)
    borders[offsets] = True
    first = np.flatnonzero(inside[1:] & (~inside[:-1] | borders))
    last = np.flatnonzero(inside[:-1] & (~inside[1:] | borders))
    length = last - first
    start = np.cumsum(length + 1) - (length + 1)
    text = np.full(int((length + 1).sum()), 32, np.uint8)
    shift = np.repeat(first - start, length)
    at = np.ones(len(text), bool)
    at[start + length] = False
    target = np.flatnonzero(at)
    text[target] = lowered[target + shift]
    return text, start, length, np.searchsorted(offsets, first, side="right") - 1


def _batches(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of rows of about ``STRETCH`` bytes with the bytes of their texts and where each text starts."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = min(len(column), max(a + 1, int(np.searchsorted(bounds, bounds[a] + STRETCH))))
        yield a, b, raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
        a = b


# ---------------------------------------------------------------------------------------------------- the draw


def histogram(texts: DataFrame) -> np.ndarray:
    """How many features of all texts (column ``text``, null: none) fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, raw, bounds in _batches(batch.column(0)):
                for found in checksums(*words_of(raw, bounds)):
                    counts += np.bincount(found[found >= 0] % BUCKETS, minlength=BUCKETS)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(counts[own])], names=["bucket", "n"])

    summed = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in summed.collect():  # at most BUCKETS rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier a bucket is in the target than in the source, rounded down."""
    all_source, all_target = int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((int(t) + 1) * (all_source + BUCKETS) / ((int(s) + 1) * (all_target + BUCKETS))))
            for s, t in zip(source, target)
        ],
        np.int64,
    )


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` (the sum of the gains of its features) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.zeros((3, batch.num_rows), np.int64)
            for a, b, raw, bounds in _batches(batch.column("text")):
                text, start, length, doc = words_of(raw, bounds)
                worth, features = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
                for found in checksums(text, start, length, doc):
                    worth += np.where(found >= 0, gain[found % BUCKETS], 0)
                    features += found >= 0
                first = np.searchsorted(doc, np.arange(b - a + 1))
                for row, values in zip(sums, (np.ones(len(start), np.int64), features, worth)):
                    run_up = np.concatenate(([0], np.cumsum(values)))
                    row[a:b] = run_up[first[1:]] - run_up[first[:-1]]
            columns = [batch.column("doc_id"), *(pa.array(x) for x in sums)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def _noise(seed: int) -> Column:
    """Gumbel noise in thousandths, fixed by the id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_features``, ``weight``, ``score`` and its ``rank`` among those drawn.

    Of the rows with at least ``least_words`` words, ``percent`` of a hundred (rounded down) are drawn: those of the
    highest scores, that is weight plus noise; ties go to the smaller doc_id (null first), then the text's counts, then
    any of the equal rows. Rows that are not drawn have no rank. A null text has no words and a null id the noise of an
    empty one. Repeated rows are rows of their own. With an empty target the gains are those of a uniform one; an empty
    table gives none.
    """
    gain = gains(histogram(docs), histogram(target))
    rows = weigh(docs, gain).withColumn("score", F.col("weight") + _noise(seed))
    rows = rows.withColumns({"open": F.col("n_words") >= least_words, "one": F.lit(1).cast("long")})
    rows = stored(rows.withColumn("own", F.monotonically_increasing_id()), "importance-rows")
    eligible = rows.where("open").count()
    order = [F.col("open").desc(), F.col("score").desc(), *(F.col(c).asc() for c in ("doc_id", "n_features", "weight", "own"))]
    placed, _ = running(rows, order, "one", "before")
    drawn = F.when(F.col("open") & (F.col("before") < percent * eligible // 100), F.col("before") + 1)
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", drawn.cast("long").alias("rank"))
