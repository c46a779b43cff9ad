"""Packing documents into training sequences along a space-filling curve.

Each document is encoded, its ids are hashed into a vector of counts, and the vector is projected to a few dimensions.
The place of that point on a Hilbert curve is the document's key: documents near each other on the curve are near in the
projection. In the order of the keys the documents form one stream of ids, cut every ``length`` ids, so a sequence
holds neighbours and is full. What is left at the end is cut into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import own_name, stored
from footfall.llm.ordering import running

#: Tokens of a sequence.
LENGTH = 4096
#: The id that ends each document.
END = 2
#: Hash buckets of a document vector, dimensions of its projection, bits of the curve for each dimension.
BUCKETS = 4096
DIMENSIONS = 4
BITS = 15
#: Words a worker remembers in each of two generations. More are encoded again: memory only, never results.
REMEMBERED = 300_000


# ---------------------------------------------------------------------------------------------------- encoding

# How the lower-casing word tokenizer prepares a text. Any other preparation is left to the library whole.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# The same split over ASCII and the letters of Latin-1, where lower case and NFC are those of Python character by character.
_LETTERS = "a-zß-öø-ÿ"
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\t-\r {_LETTERS}0-9]+")
_OTHERS = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ÿ]")
_CHUNKS = re.compile(r"[^\t-\r ]+")


def _byte_letters() -> dict[int, int]:
    """The characters that stand for bytes in the vocabulary: printable ones for themselves, the others from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + k for k, b in enumerate(hidden)}


class Encoder(dict):
    """Ids exactly as the tokenizers library gives them; each different word goes to the library's merges once.

    A text is cut where the tokenizer cuts it anyway. A stretch without white space that holds a character outside
    ASCII and Latin-1 letters goes to the library as it is, a text with a special token as a whole. The dictionary holds
    the ids of the words met so far; when it is full it becomes the older one, from which words still in use come back.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.special = [t["content"] for t in told["added_tokens"]]
        steps = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
        cut = {"pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}
        to_bytes = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
        known = len(steps) == 2 and cut.items() <= steps[0].items() and to_bytes.items() <= steps[1].items()
        self.by_words = known and (told["normalizer"] or {}).get("normalizers") == _NORMALIZER
        self.type = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "HI"[self.type.itemsize // 4]  # machines of this byte order only, as Spark's Arrow batches
        self.merges = self.library.model.tokenize
        self.letters = _byte_letters()
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            if word.isascii() and word.isprintable():
                ids = [t.id for t in self.merges(word)]
            elif _OTHERS.search(word):
                ids = self.library.encode(word, add_special_tokens=False).ids
            else:
                ids = [t.id for t in self.merges(word.encode().decode("latin-1").translate(self.letters))]
            found = array(self.code, ids).tobytes()
        self[word] = found
        return found

    def _one(self, text: str) -> bytes:
        """The ids of a text with characters beyond Latin-1 letters or special tokens."""
        if not self.by_words or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.type).tobytes()
        words: list[str] = []
        for part in _CHUNKS.findall(text):
            if _OTHERS.search(part):
                words.append(part)
            else:
                words += _WORDS.findall(part.lower())
        return b"".join([self[w] for w in words])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian, of ``type``."""
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()
        plain = [i for i, t in enumerate(texts) if self.by_words and not _OTHERS.search(t) and not any(s in t for s in self.special)]
        out = dict(zip(plain, self._plain([texts[i] for i in plain])))
        return [out[i] if i in out else self._one(t) for i, t in enumerate(texts)]

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Texts of ASCII and Latin-1 letters, a byte a character: cut and told apart all at once."""
        raw = b"".join([t.lower().encode("latin-1") + b"\n" for t in texts])
        text = np.frombuffer(raw, np.uint8)
        if not len(text):
            return []
        start, end = cut(text)
        bounds = np.concatenate(([0], np.cumsum(np.array([len(t) + 1 for t in texts]))))
        if not len(start):
            return [b""] * len(texts)
        which, first = _alike(text, start, end)
        found = [self[raw[a:b].decode("latin-1")] for a, b in zip(start[first].tolist(), end[first].tolist())]
        size = np.array([len(f) // self.type.itemsize for f in found])
        flat = np.frombuffer(b"".join(found), self.type)
        opens = np.cumsum(size) - size
        sizes = size[which]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(opens[which] - (ends - sizes), sizes) + np.arange(ends[-1])]
        before = np.concatenate(([0], ends))[np.searchsorted(start, bounds)]
        return [ids[a:b].tobytes() for a, b in zip(before[:-1], before[1:])]


# What the split tells apart, for characters up to Latin-1: white space, digits, letters, all else.
_SPACE, _DIGIT, _LETTER, _ELSE = range(4)
_CLASS = np.full(256, _ELSE, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[[*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = _LETTER


def cut(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of lower-case Latin-1 text that ends in white space, as the split has them."""
    kind = _CLASS[text]
    opens = kind != _SPACE
    opens[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    # an apostrophe that no other mark stands before, and the letters of a contraction behind it, are a word
    at = np.flatnonzero(opens & (text == 0x27))
    after = np.concatenate((text, np.zeros(2, np.uint8)))
    one, two = after[at + 1], after[at + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)
    for own, size in ((at[short], 2), (at[long], 3)):
        opens[own + 1] = False
        next_ = own + size
        opens[next_[kind[next_] == _LETTER]] = True
    start = np.flatnonzero(opens)
    closes = np.flatnonzero((kind[1:] == _SPACE) & (kind[:-1] != _SPACE)) + 1  # ends at white space
    following = np.append(start[1:], len(text))
    space = closes[np.searchsorted(closes, start, side="right")]
    return start, np.minimum(following, space)


def _alike(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the number of its like, and for each number the first word of it. Equal hashes are compared."""
    base = np.uint64(0x9E3779B97F4A7C15)
    up = np.full(int((end - start).max()) + 1, base, np.uint64)
    up[0] = 1
    up = np.cumprod(up, dtype=np.uint64)
    size = end - start
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    letters = text[np.repeat(start, size) + place]
    h = np.add.reduceat((letters.astype(np.uint64) + np.uint64(1)) * up[place], np.cumsum(size) - size)
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    like = start[first][which]
    same = size == size[first][which]
    if same.all():
        same = np.logical_and.reduceat(letters == text[np.repeat(like, size) + place], np.cumsum(size) - size)
    if not same.all():  # two words of one hash: told apart by themselves
        raw = text.tobytes()
        numbers: dict[bytes, int] = {}
        which = np.array([numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(start.tolist(), end.tolist())])
        first = np.unique(which, return_index=True)[1]
    return which, first


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for each worker process: tasks that follow each other in it share what it remembers."""
    return Encoder(path)


def _by_bytes(texts: list[str], at_most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``at_most`` characters, so that long texts do not meet in memory."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= at_most:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


# ---------------------------------------------------------------------------------------------------- the curve


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """32 well-mixed bits of each value."""
    x = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xBF58476D1CE4E5B9 & (1 << 64) - 1)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


def _signs() -> np.ndarray:
    """The projection: a sign for each bucket and dimension."""
    buckets = np.arange(BUCKETS)
    return np.stack([(_mixed(buckets, 7 + d) & 1) * 2.0 - 1.0 for d in range(DIMENSIONS)], axis=1)


def project(ids: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """The point of a document: its hashed counts, damped by a logarithm, at length 1, projected. No ids give the origin."""
    counts = np.bincount(_mixed(ids, 1) % BUCKETS, minlength=BUCKETS)
    own = np.flatnonzero(counts)
    if not len(own):
        return np.zeros(signs.shape[1])
    vector = np.log1p(counts[own])
    return vector @ signs[own] / np.sqrt(vector @ vector)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of whole-numbered points (rows) with ``bits`` bits a dimension.

    From the top bit down, each half that a coordinate lies in turns or mirrors the lower bits of the first one; the
    Gray code of the bits, dimension by dimension, is then undone.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for d in range(n):
            upper = x[d] & bit != 0
            x[0] = np.where(upper, x[0] ^ low, x[0])
            swapped = np.where(upper, 0, (x[0] ^ x[d]) & low)
            x[0] ^= swapped
            x[d] ^= swapped
    for d in range(1, n):
        x[d] ^= x[d - 1]
    turned = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turned = np.where(x[n - 1] & (1 << level) != 0, turned ^ ((1 << level) - 1), turned)
    x ^= turned
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(n):
            key = key << 1 | x[d] >> level & 1
    return key


def _curve_key(points: list[Column], centre: list[float], spread: list[float]) -> Column:
    """The Hilbert key of points whose coordinates spread evenly over the cube after a logistic curve."""

    @F.pandas_udf("long")
    def run(*columns):
        if not len(columns[0]):
            return columns[0].astype("int64")
        rows = np.stack([c.to_numpy(np.float64) for c in columns], axis=1)
        even = 1 / (1 + np.exp(-1.702 * np.clip((rows - centre) / spread, -20, 20)))
        import pandas as pd

        return pd.Series(hilbert(np.minimum((even * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS))

    return run(*points)


# ---------------------------------------------------------------------------------------------------- packing


def _encoded(docs: DataFrame, path: str) -> DataFrame:
    """``row`` (a number of its own for each row), ``doc_id``, ``n`` (tokens with the end id), ``ids`` (compressed),
    ``x0``.. (the point) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, signs, squeeze = encoder(path), _signs(), zstandard.ZstdCompressor(level=1).compress
        end = np.array([END], model.type).tobytes()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for first, last in _by_bytes(texts):
                raw = model.encode(texts[first:last])
                points = np.array([project(np.frombuffer(r, model.type), signs) for r in raw]).reshape(-1, DIMENSIONS)
                part = batch.slice(first, last - first)
                own = [pa.array([len(r) // model.type.itemsize + 1 for r in raw], pa.int64())]
                own.append(pa.array([squeeze(r + end) for r in raw], pa.binary()))
                own += [pa.array(points[:, d], pa.float64()) for d in range(DIMENSIONS)]
                names = ["row", "doc_id", "n", "ids", *(f"x{d}" for d in range(DIMENSIONS))]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), *own], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    places = ", ".join(f"x{d} double" for d in range(DIMENSIONS))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(run, f"row long, doc_id {kind}, n long, ids binary, {places}")


def cuts(total: int, length: int) -> tuple[int, list[int]]:
    """Where full sequences end, and the starts of those after it, whose lengths are the powers of two in the rest."""
    full = total - total % length
    starts, at = [], full
    for level in range(length.bit_length() - 1, -1, -1):
        if (total - full) >> level & 1:
            starts.append(at)
            at += 1 << level
    return full, starts


def pack(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """Every document (``doc_id``, ``text``) in pieces that lie in sequences of at most ``length`` tokens.

    Columns: ``doc_id``, ``start`` (ids of the document before the piece), ``length``, ``ids`` (binary, unsigned 32-bit,
    little-endian), ``doc_tokens`` (with the end id), ``sequence_id``, ``offset`` (in the sequence). ``path`` is a file
    of the tokenizers library. ``length`` is a power of two; sequences are full, but for the last few, whose lengths are
    different smaller powers of two. A null text counts as empty: the end id alone. Rows are packed one by one, also
    equal ones and those of a null id; documents of one key (copies) follow each other by id. An empty table gives none.
    """
    if length < 1 or length & length - 1:
        raise ValueError(f"a sequence length is a power of two, not {length}")
    rows = stored(_encoded(docs, path), "pack-encoded")
    points = [f"x{d}" for d in range(DIMENSIONS)]
    found = rows.agg(*[f(p) for p in points for f in (F.avg, F.stddev_pop)]).first()
    centre, spread = [round(x or 0.0, 6) for x in found[0::2]], [round(x or 0.0, 6) or 1.0 for x in found[1::2]]
    keyed = rows.select("row", "doc_id", "n", _curve_key([F.col(p) for p in points], centre, spread).alias("key"))
    at = own_name("at")
    placed, total = running(keyed, [F.col("key"), F.col("doc_id"), F.col("row")], "n", at)
    full, tail = cuts(total, length)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        ends = np.array([*tail[1:], total])
        for batch in batches:
            out: list[tuple] = []
            size = 0
            ids = batch.column("doc_id").to_pylist()
            for i, (first, n, packed) in enumerate(zip(*(batch.column(c).to_pylist() for c in (at, "n", "ids")))):
                raw = open_(packed)
                raw = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4").tobytes()
                here, last = first, first + n
                while here < last:
                    if here < full:
                        sequence, begin = here // length, here - here % length
                        end = begin + length
                    else:
                        k = int(np.searchsorted(ends, here, side="right"))
                        sequence, begin, end = full // length + k, tail[k], int(ends[k])
                    end = min(end, last)
                    a, b = here - first, end - first
                    out.append((ids[i], a, b - a, raw[4 * a : 4 * b], n, sequence, here - begin))
                    here = end
                size += len(raw)
                if size > 1 << 23:
                    yield _pieces(out, batch.schema.field("doc_id").type)
                    out, size = [], 0
            if out:
                yield _pieces(out, batch.schema.field("doc_id").type)

    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    starts = placed.select("row", at).hint("shuffle_hash")
    return rows.select("row", "doc_id", "n", "ids").join(starts, "row").drop("row").mapInArrow(run, schema)


def _pieces(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
