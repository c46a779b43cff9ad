"""Packing, the divergence audit and importance resampling against brute force, with nulls, long texts, ties and repeats."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as driver
from compare import differences, oracle_rows
from footfall.llm import divergence, importance, packing
from footfall.llm.common import ship
from footfall.llm.ordering import running
from footfall.llm.queries import tokenizer_path

SCHEMA = (
    "doc_id long, text string, lang string, source string, row long, n long, key string, ids string, part string, value long, "
    "rank int, open boolean, before long, block int, weight long, one long, total long, term string"
)


def _rows(texts):
    return [(i, t, lang, source, 1, 2, "k", "x", "p", 3, 4, True, 5, 6, 7, 8, 9, "t") for i, t, lang, source in texts]


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="module")
def texts():
    """Columns beside the usual ones have names that the operators use inside."""
    deal = random.Random(11)
    words = [f"{a}{b}{c}" for a in "bdf" for b in ("an", "é", "X9") for c in ("", "o", "ß", "'s")]
    many = [
        (i, " ".join(deal.choice(words) for _ in range(deal.randint(1, 90))), deal.choice(["en", "en", "de"]), f"s{i % 5 if i % 3 else 0}")
        for i in range(240)
    ]
    odd = [None, "", " \n\t ", "a<|endoftext|>b", "İstanbul ﬁ ½ 日本語", "x" * 700 + " y " + "Z" * 129, "\x00a\x1cb", "é", "word " * 12_000]
    many += [(1000 + i, t, None if i % 2 else "en", None) for i, t in enumerate(odd)]
    many += [(None, "no id " * 30, "fr", "s1"), *[(2000, "same row " * 15, "en", "s0")] * 40, *[(3000 + i, "same text " * 15, "en", "s0") for i in range(60)]]
    return many


@pytest.fixture(scope="module")
def docs(shipped, texts):
    return shipped.createDataFrame(_rows(texts), SCHEMA).repartition(7)


@pytest.fixture(scope="module")
def empty(shipped):
    return shipped.createDataFrame([], SCHEMA)


def test_running_totals_follow_the_order(shipped):
    rows = shipped.createDataFrame([(i * 7 % 50, i) for i in range(50)], "place int, size long").repartition(5)
    found, total = running(rows, [rows.place], "size", "before")
    at = 0
    for r in sorted(found.collect()):
        assert r.before == at
        at += r["size"]
    assert total == at


def test_pieces_hold_each_id_once_in_full_sequences(docs, empty, texts):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    length = 256
    found = packing.pack(docs, path, length).collect()
    library = Tokenizer.from_file(path)
    wanted = Counter((i, np.array([*library.encode(t or "", add_special_tokens=False).ids, packing.END], "<u4").tobytes()) for i, t, *_ in texts)
    chains = defaultdict(list)  # pieces of a row follow each other in the order of the sequences
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append(r)
        chains[r.doc_id].append(r)
        assert r["length"] * 4 == len(r.ids) and 0 < r["length"] <= length
    got = Counter()
    for doc_id, pieces in chains.items():
        raw, at = b"", 0
        for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
            assert r.start == at
            raw, at = raw + bytes(r.ids), at + r["length"]
            if at == r.doc_tokens:
                got[doc_id, raw] += 1
                raw, at = b"", 0
        assert not raw
    assert got == wanted
    assert sorted(sequences) == list(range(len(sequences)))
    sizes = []
    for number in sorted(sequences):
        at = 0
        for r in sorted(sequences[number], key=lambda r: r.offset):
            assert r.offset == at
            at += r["length"]
        sizes.append(at)
    rest = sizes[sum(s == length for s in sizes) :]
    assert len(set(rest)) == len(rest) and all(s & s - 1 == 0 for s in rest)
    assert packing.pack(empty, path, length).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, path, 100)


def test_the_encoder_forgets_without_changing_ids(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    model = packing.Encoder(tokenizer_path("word_bpe_49k.json"))
    texts = ["one two three four", "two five six", "seven two one", "Ünï's ß!? 'S don't", "a<|endoftext|>b", "\x00 \x7f \x1c-é", "日本 é½"]
    deal = random.Random(8)
    texts += ["".join(deal.choice("aé'' stvelrmd!1ß\n\x1c") for _ in range(deal.randint(0, 60))) for _ in range(400)]
    wanted = [np.array(model.library.encode(t, add_special_tokens=False).ids, model.type).tobytes() for t in texts]
    for _ in range(3):
        assert model.encode(texts) == wanted
        assert [model.encode([t])[0] for t in texts] == wanted
    assert model.encode([]) == []


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(packing.np, "cumprod", lambda a, **kw: np.ones_like(a))  # words of the same letters now collide
    text = np.frombuffer(b"ab ba ab abc cab ba ", np.uint8)
    start, end = packing.cut(text)
    which, first = packing._alike(text, start, end)
    raw = text.tobytes()
    assert [raw[start[first[w]] : end[first[w]]] for w in which] == raw.split()


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_and_steps_to_a_neighbour(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), axis=-1).reshape(-1, dimensions)
    keys = packing.hilbert(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_on_the_curve_share_words(shipped):
    deal = random.Random(3)
    topics = [[f"t{k}w{i}" for i in range(40)] for k in range(6)]
    texts = [(i, " ".join(deal.choice(topics[i % 6]) for _ in range(80)), "en", "s") for i in range(300)]
    found = packing.pack(shipped.createDataFrame(_rows(texts), SCHEMA), tokenizer_path("word_bpe_49k.json"), 1024).collect()
    order = [r.doc_id % 6 for r in sorted(found, key=lambda r: (r.sequence_id, r.offset))]
    same = sum(a == b for a, b in zip(order, order[1:])) / (len(order) - 1)
    assert same > 0.5  # by chance about a sixth


def _audited(texts, least, most):
    """The definition, cell by cell."""
    word = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    groups, holders = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in texts:
        found = word.findall((text or "").translate(lower))
        groups[lang or "", source or ""].update(found)
        holders[lang or ""].update(set(found))
    rows = []
    share = lambda count, n, v: 1 + (10**9 * (count + 5)) // (n + 5 * v) if v else 1
    for (lang, source), counts in groups.items():
        kept = [t for t, n in holders[lang].items() if n >= least]
        size = lambda c: sum(c[t] for t in kept)
        whole = sum((c for (other, _), c in groups.items() if other == lang), Counter())
        p = {t: share(counts[t], size(counts), len(kept)) for t in kept}
        q = {t: share(whole[t], size(whole), len(kept)) for t in kept}
        apart = []
        for (other, item), c in groups.items():
            if other == lang and item != source:
                n = size(c)
                apart.append((-sum(abs(p[t] - share(c[t], n, len(kept))) for t in kept), item.encode()))
        rows += [(lang, source, "pair", item.decode(), -v, k) for k, (v, item) in enumerate(sorted(apart), 1)]
        out = sorted((q[t] - p[t], t.encode()) for t in kept if counts[t] and p[t] > q[t])
        rows += [(lang, source, "term", item.decode(), -v, k) for k, (v, item) in enumerate(out[:most], 1)]
    return Counter(rows)


def test_the_audit_is_the_definition(docs, empty, texts):
    for least, most in ((30, 50), (2, 4), (10_000, 50)):
        found = Counter(tuple(r) for r in divergence.audit(docs, least, most).collect())
        assert found == _audited(texts, least, most)
    assert divergence.audit(empty).count() == 0


def test_the_audit_over_many_sources_and_terms(shipped):
    """More groups than a block of rows and more terms than a strip of columns, most cells empty."""
    deal = random.Random(2)
    vocabulary = ["".join(deal.choice("abcdefghij") for _ in range(6)) for _ in range(6000)]
    texts = [(i, " ".join(deal.choices(vocabulary, k=60)), "en", f"s{i % 131}" if i % 3 else "s0") for i in range(1500)]
    found = Counter(tuple(r) for r in divergence.audit(shipped.createDataFrame(_rows(texts), SCHEMA), 2, 5).collect())
    word_groups = defaultdict(Counter)
    holders = Counter()
    for _, text, _, source in texts:
        word_groups[source].update(text.split())
        holders.update(set(text.split()))
    kept = sorted(t for t, n in holders.items() if n >= 2)
    assert len(kept) > divergence.SIDE * divergence.STRIP
    names = sorted(word_groups)
    counts = np.array([[word_groups[s][t] for t in kept] for s in names], np.int64)
    shares = 1 + 10**9 * (counts + 5) // (counts.sum(axis=1, keepdims=True) + 5 * len(kept))
    for k in (0, 1, 70, 130):
        apart = np.abs(shares - shares[k]).sum(axis=1)
        order = sorted((-int(v), s) for s, v in zip(names, apart) if s != names[k])
        for rank, (v, s) in enumerate(order, 1):
            assert found["en", names[k], "pair", s, -v, rank] == 1


def test_the_audit_agrees_with_sql(shipped, sf_dir):
    name = "op12_divergence"
    assert differences(driver.queries()[name](shipped, sf_dir), sf_dir, driver.oracle_sql()[name]) is None
    assert oracle_rows(sf_dir, driver.oracle_sql()[name])[1]


def _features(text):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = word.findall((text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


@pytest.mark.parametrize("reach", [2, 9, 128])
def test_checksums_are_those_of_zlib(monkeypatch, reach):
    monkeypatch.setattr(importance, "REACH", reach)
    importance._tables.cache_clear()
    monkeypatch.setattr(importance, "STRETCH", 50)
    texts = ["", "One two  three-four", "é", "x" * 1000 + " b " + "c" * 127, "", "a b", "1" * 128 + "-" + "2" * 129, "last\x7fone"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *(len(t.encode()) for t in texts)])
    text, start, length, doc = importance.words_of(raw, bounds)
    found = defaultdict(Counter)
    for values in importance.checksums(text, start, length, doc):
        for d, v in zip(doc, values):
            if v >= 0:
                found[int(d)][int(v)] += 1
    importance._tables.cache_clear()
    for i, t in enumerate(texts):
        assert found[i] == Counter(zlib.crc32(f.encode()) for f in _features(t)[1])


def test_the_draw_is_the_definition(docs, empty, shipped, texts):
    aim = [(i, t) for i, t in enumerate(["same text same", "bané bX9o word", None, ""])]
    target = shipped.createDataFrame(aim, "item_id long, text string")
    found = importance.resample(docs, target, percent=20).collect()
    hist = lambda own: Counter(zlib.crc32(f.encode()) % 10_000 for t in own for f in _features(t)[1])
    source, goal = hist(t for _, t, *_ in texts), hist(t for _, t in aim)
    s_all, t_all = sum(source.values()), sum(goal.values())
    gain = lambda b: math.floor(1000 * math.log((goal[b] + 1) * (s_all + 10_000) / ((source[b] + 1) * (t_all + 10_000))))
    rows = []
    for i, t, *_ in texts:
        words, features = _features(t)
        weight = sum(gain(zlib.crc32(f.encode()) % 10_000) for f in features)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(words), len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    for k, r in enumerate(able[: 20 * len(able) // 100], 1):
        r[5] = k
    assert Counter(tuple(r) for r in found) == Counter(map(tuple, rows))
    assert importance.resample(empty, target).count() == 0
    assert importance.resample(docs, empty).count() == len(texts)


def test_page_model_takes_nulls_repeats_and_empty_tables(shipped):
    from footfall.llm import html

    page = "<html><body><nav><a href='/'>Home</a></nav><article><p>%s</p></article><footer>About us</footer></body></html>"
    text = "A sentence of the article that is long enough to be one of its paragraphs, number %d. It goes on for a while."
    rows = [(i, f"u{i}", page % (text % i), "x") for i in range(30)] + [(None, None, None, "x"), (31, "e", "", "x"), *[(7, "u7", page % (text % 7), "x")] * 20]
    pages = shipped.createDataFrame(rows, "page_id long, url string, html string, place string")
    model = html.train(pages)
    found = html.extract(pages, model).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.n_chars == len(r.text)
        if r.page_id is None or r.page_id == 31:
            assert r.text == ""
    right = sum(r.text == text % r.page_id for r in found if r.url and r.page_id != 31)
    assert right >= 40  # of 50
    assert html.extract(pages.limit(0), html.train(pages.limit(0))).count() == 0
