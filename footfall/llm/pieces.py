"""Encoding to and decoding from merge-type pieces of a SentencePiece model, by longest matches with backtracking.

A sequence of pieces is the model's encoding of a text exactly if each two neighbours are, re-merged alone, left as they
are. So the encoder takes at each place the longest piece that an Aho-Corasick automaton found there, checks it against
its left neighbour, tries shorter ones, and goes back a piece where none fits; a bitfield marks the places that led
nowhere, so no place is tried twice. Characters without a piece become byte pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import per_text

MARK = "▁"
#: Stretches of a text, and pairs of pieces, that a worker remembers in each of two generations; stretches of more
#: characters are worked out each time. More of them cost work again: memory only, never results.
REMEMBERED = 200_000
SHORT = 32


class _Known(dict):
    """Remembers what ``work`` gave. When full it becomes the older one, from which what is still in use comes back."""

    def __init__(self, work: Callable):
        super().__init__()
        self.work = work
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.work(key)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Pieces:
    """The pieces of one model, with its merge order. Ids from ``size`` on stand for characters without a piece."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = model.get_piece_size()
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        self.byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(n) if model.is_byte(i)}
        self.bytes_of = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.unknown = model.unk_id()
        self.text_of = {i: model.id_to_piece(i) for i in range(n) if not model.is_byte(i) and not special(i)}
        self.id_of = {t: i for i, t in self.text_of.items()}
        self.score = {t: model.get_score(i) for t, i in self.id_of.items()}
        self.spaced = {i: t.replace(MARK, " ") for i, t in self.text_of.items()}
        #: Whether two neighbours, as left * ``NEXT`` + right, stay as they are when merged alone.
        self.fits = _Known(self._stay)
        joined = [t for t in self.id_of if len(t) > 1]
        reached = [t for t in self.id_of if len(t) == 1 or self.merge(t) == [t]]  # no other piece stands in an encoding
        self.automaton = ahocorasick.Automaton()
        for t in reached:
            self.automaton.add_word(t, (len(t) - 1, self.id_of[t]))
        self.automaton.make_automaton()
        #: The longest piece that a piece properly begins with.
        known = set(reached)
        begins = lambda t: next((t[:k] for k in range(len(t) - 1, 0, -1) if t[:k] in known), t[0])
        self.shorter = {self.id_of[t]: self._single(s) if len(s := begins(t)) == 1 else self.id_of[s] for t in joined}
        self.length = {i: len(t) for i, t in self.text_of.items()}
        #: Texts fall into stretches that no piece crosses: marks open one, a line end that is in no piece stands alone.
        inner = "" if any("\n" in t for t in joined) else "\n"
        crossing = any(MARK in t.lstrip(MARK) for t in joined)
        self.stretch = re.compile("(?s).+" if crossing else f"{MARK}+[^{MARK}{inner}]*|[^{MARK}{inner}]+" + ("|\n" if inner else ""))
        #: Of a stretch: how many ids, these in decimal joined by commas, and the text they decode to.
        self.known = _Known(self._round)

    def _single(self, char: str) -> int:
        return self.id_of.get(char, self.size + ord(char))

    def _text(self, i: int) -> str:
        return self.text_of[i] if i < self.size else chr(i - self.size)

    def _stay(self, pair: int) -> bool:
        left, right = map(self._text, divmod(pair, NEXT))
        return self.merge(left + right) == [left, right]

    def merge(self, text: str) -> list[str]:
        """Merges in the order of the scores, the leftmost first: the definition, used on short strings."""
        parts = list(text)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, text: str) -> list[int]:
        """The pieces of ``text`` in order. Where the longest matches fit each other from the first on, they are it."""
        out: list[int] = []
        at, left, fits = 0, -1, self.fits
        for end, (before, i) in self.automaton.iter_long(text):
            if end - before != at:
                return self._backtrack(text, out, at, None)
            if left >= 0 and not fits[left * NEXT + i]:
                return self._backtrack(text, out, at, self.shorter.get(i))
            out.append(i)
            at, left = end + 1, i
        return out if at == len(text) else self._backtrack(text, out, at, None)

    def _backtrack(self, text: str, out: list[int], at: int, i: int | None) -> list[int]:
        """Goes on from ``out``, the pieces up to ``at``; ``i`` is the next to try there, the longest if None."""
        n = len(text)
        longest: list[int | None] = [None] * (n + 1)
        failed = bytearray((n >> 3) + 1)  # a bit for each place that led nowhere
        fits, shorter, length = self.fits, self.shorter, self.length
        while at < n:
            if i is None:
                i = longest[at]
                if i is None:
                    i = self._longest(text, at, longest)
            while i is not None:
                end = at + length.get(i, 1)
                if not failed[end >> 3] >> (end & 7) & 1 and (not out or fits[out[-1] * NEXT + i]):
                    break
                i = shorter.get(i)
            if i is not None:
                out.append(i)
                at, i = end, None
                continue
            while i is None:  # nothing fits here, and nothing shorter fits where the piece before begins
                failed[at >> 3] |= 1 << (at & 7)
                i = out.pop()
                at -= length.get(i, 1)
                i = shorter.get(i)
        return out

    def _longest(self, text: str, at: int, longest: list) -> int:
        """Fills in the longest pieces from ``at`` on, as they follow each other, up to a place already known."""
        longest[at] = self._single(text[at])
        for end, (before, i) in self.automaton.iter_long(text, at):
            start = end - before
            if start > at and longest[start] is not None:
                break
            longest[start] = i
        return longest[at]

    def ids(self, text: str) -> list[int]:
        out: list[int] = []
        for i in self.split(text):
            if i < self.size:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in chr(i - self.size).encode("utf-8")]
            else:
                out.append(self.unknown)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids`` with marks as spaces; the mark that opens every text is still there."""
        try:
            return "".join([self.spaced[i] for i in ids])
        except KeyError:  # bytes, or ids that stand for no text
            raw = b"".join(self.bytes_of.get(i) or self.spaced.get(i, "").encode("utf-8") for i in ids)
            return raw.decode("utf-8", "replace")

    def _round(self, stretch: str) -> tuple[int, str, str]:
        ids = self.ids(stretch)
        return len(ids), ",".join(map(str, ids)), self.decode(ids)

    def stretches(self, text: str) -> list[tuple[int, str, str]]:
        """``known`` of each stretch of a text; their ids together are those of the text."""
        if not text:
            return []
        known, work = self.known, self._round
        return [known[s] if len(s) <= SHORT else work(s) for s in self.stretch.findall(MARK + text.replace(" ", MARK))]


#: More than there are pieces and characters.
NEXT = 1 << 32


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    """One for each worker process: tasks that follow each other in it share what it remembers."""
    return Pieces(path)


def encode(text: Column, path: str) -> Column:
    """The ids of a text as an array; null and empty texts have none."""

    def make():
        run = pieces(path).stretches
        return lambda t: ([int(i) for _, s, _ in run(t) for i in s.split(",")],)

    return per_text(make, "ids array<int>", ["ids"])(text)["ids"]


def decode(ids: Column, path: str) -> Column:
    """The text of an array of ids; null and empty arrays give the empty text, ids without text nothing."""

    @F.pandas_udf("string")
    def run(arrays: pd.Series) -> pd.Series:
        model = pieces(path)
        texts = arrays.map(lambda x: model.decode([] if x is None else list(x)))
        return texts.map(lambda t: t[1:] if t.startswith(" ") else t)

    return run(ids)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of every row of ``docs``, encoded and decoded again.

    A null text counts as empty: no ids, and the digests of the empty string. Repeated rows and null ids are kept.
    """

    def make():
        run = pieces(path).stretches
        digest = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()

        def one(text: str) -> tuple:
            found = run(text)
            back = "".join([t for _, _, t in found])
            return sum([n for n, _, _ in found]), digest(",".join([s for _, s, _ in found])), digest(back[1:] if back.startswith(" ") else back)

        return one

    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    done = per_text(make, "n_tokens long, ids_sha256 string, decoded_sha256 string", names)
    return docs.select("doc_id", done("text").alias("found")).select("doc_id", "found.*")
