"""The training-data operators against brute force, on rows with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from footfall.llm import html, lines, mixing, pieces, pii, quality, rules, simhash, topk, toxicity
from footfall.llm.common import ship
from footfall.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slice int, key string, size int, found string, keep int"
SENTENCE = "the quick brown fox jumps over a lazy dog near the river bank today"


def rows_of(texts: list[tuple]) -> list[tuple]:
    return [(i, t, "en", s, len(t or ""), 0, "k", 1, "f", 2) for i, t, s in texts]


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="module")
def docs(shipped):
    """Columns beside the usual ones have names that the operators use inside."""
    deal = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = [(i, " ".join(deal.choice(words) for _ in range(deal.randint(1, 60))), f"s{i % 3 if i % 4 else 0}") for i in range(60)]
    texts += [(100, None, "s0"), (101, "", None), (102, " \n\t ", "s1"), (None, "no id here", "s1"), (103, "x " * 30_000, "s2")]
    texts += [(104, SENTENCE, "s2"), (104, SENTENCE, "s2"), (105, SENTENCE + "!", None), (106, SENTENCE + "\n" + SENTENCE, "s0")]
    return shipped.createDataFrame(rows_of(texts), SCHEMA)


@pytest.fixture(scope="module")
def empty(shipped):
    return shipped.createDataFrame([], SCHEMA)


def test_mix_takes_words_near_the_targets(docs, empty):
    found = mixing.mix(docs).collect()
    assert len(found) == docs.count()
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    by_source: dict[float, list] = {}
    for r in found:
        by_source.setdefault((r.source_size, r.target), []).append(r)
        assert r.taken in (0, r.size, 2 * r.size)
    total = sum(size for size, _ in by_source)
    assert total == sum(len(WORD.findall(t or "")) for _, t in texts) + len(WORD.findall(SENTENCE))
    assert sum(t for _, t in by_source) == pytest.approx(min(1.5 * total, 2 * total))
    for (size, target), own in by_source.items():
        assert target <= 2 * size
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own)
    assert sorted(found, key=str) == sorted(mixing.mix(docs).collect(), key=str)
    assert mixing.mix(empty).count() == 0
    taken = mixing.mixed(docs)
    assert taken.columns == docs.columns
    assert taken.count() == sum(r.copies for r in found)


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        twice = int(c) * (1 + i % 2)
        total += twice - 9 if twice > 9 else twice
    return total % 10 == 0


def base_spans(text: str) -> list[tuple]:
    return sorted((m.start(), k, m.end(), kind) for k, (kind, form, good) in enumerate(BASE) for m in re.finditer(form, text) if good(m[0]))


def test_base_identifiers_are_those_of_the_plain_patterns(shipped, empty):
    deal = random.Random(1)
    parts = ["a@b.c", "x.y@z-1.de.", "@", "1.2.3.4", "256.1.1.1", "001.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+12", "é", "😀", " ", "_", "-", ".", "a", "9" * 15]
    texts = ["".join(deal.choice(parts) for _ in range(deal.randint(0, 12))) for _ in range(300)] + ["1" * 20_000, "a" * 20_000, "1 " * 5_000]
    frame = shipped.createDataFrame(rows_of([(i, t, "s") for i, t in enumerate(texts)] + [(900, None, None), (None, "a@b.c", "s"), (None, "a@b.c", "s")]), SCHEMA)
    found = pii.report(frame).collect()
    assert len(found) == len(texts) + 3
    for r in found:
        spans = base_spans(texts[r.doc_id] if r.doc_id is not None and r.doc_id < 900 else "a@b.c" if r.doc_id is None else "")
        told = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k, _, _ in BASE]
        assert set(filter(None, told.split(","))) <= set(r.spans.split(","))
    assert pii.report(empty).count() == 0


def test_contexts_of_known_identifiers_find_unseen_ones(shipped):
    rows = [(i, f"please write to mail{i}@host.org before the deadline comes", "s") for i in range(60)]
    rows += [(100, "please write to mail7(at)host before the deadline comes", "s"), (101, "see version 2.0 of the text", "s")]
    found = {r.doc_id: r.spans for r in pii.report(shipped.createDataFrame(rows_of(rows), SCHEMA)).collect()}
    assert found[100] == "context:16:29"  # 13 characters
    assert found[101] == ""


def test_one_sided_contexts_find_unseen_identifiers(shipped):
    deal = random.Random(11)
    word = lambda: "".join(deal.choice("abcdefgh") for _ in range(7))
    rows = [(i, f"{word()} mail: box{i}@host.org {word()} {word()}", "s") for i in range(200)]
    rows += [(1000 + i, f"{word()} phone: +1 (555) 123-{1000 + i} {word()}", "s") for i in range(200)]
    rows += [(2000 + i, f"{word()} mail: user{i}(at)host {word()}", "s") for i in range(20)]
    rows += [(3000 + i, f"{word()} phone: call-{i}-now {word()}", "s") for i in range(20)]
    rows += [(4000, "see version 2.0 of mail: and phone: and the text", "s")] + [(4001 + i, f"this and that {word()}", "s") for i in range(20)]
    found = {r.doc_id: r.spans for r in pii.report(shipped.createDataFrame(rows_of(rows), SCHEMA)).collect()}
    assert all(found[2000 + i] == f"context:14:{26 + len(str(i))}" for i in range(20))
    assert all(found[3000 + i] == f"context:15:{24 + len(str(i))}" for i in range(20))
    assert not any(found[i] for i in found if i >= 4000)


def test_contexts_find_identifiers_of_letters_only(shipped):
    """A common word before a few seeds finds nothing, however many seeds it has."""
    deal = random.Random(12)
    word = lambda: "".join(deal.choice("abcdefgh") for _ in range(7))
    rows = [(i, f"{word()} mail: box{i}@host.org {word()} {word()}", "s") for i in range(100)]
    rows += [(1000 + i, f"{word()} mail: {'jkl'[i]}ane(at)host(dot)org {word()}", "s") for i in range(3)]
    rows += [(2000 + i, f"{word()} the seed{i}@host.net {word()}", "s") for i in range(40)]
    rows += [(3000 + i, f"{word()} the {word()} {word()}", "s") for i in range(400)]
    found = {r.doc_id: r.spans for r in pii.report(shipped.createDataFrame(rows_of(rows), SCHEMA)).collect()}
    assert [found[1000 + i] for i in range(3)] == ["context:14:34"] * 3
    assert not any(found[3000 + i] for i in range(400))


def test_quality_ranks_good_texts_higher(shipped, empty):
    deal = random.Random(2)
    good = lambda: " ".join(deal.choice(SENTENCE.split()) + deal.choice("abcdefgh") for _ in range(60)).capitalize() + "."
    bad = lambda: " ".join([deal.choice(["BUY!!", "spam***", "| win |"])] * 40)
    x = np.array([quality.features(t) for t in [good() for _ in range(50)] + [bad() for _ in range(50)]])
    label = np.array([1] * 50 + [0] * 50)
    model = quality.rank(x, label, pairs=2000)
    scores = model.scores(np.array([quality.features(t) for t in [good() for _ in range(20)] + [bad() for _ in range(20)] + [""]]))
    assert scores[:20].min() > quality.CUT > scores[20:40].max()
    assert ((scores >= 0) & (scores <= 1)).all()
    none = quality.train(empty, shipped.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert none.scores(x[:1])[0] == pytest.approx(quality.CUT)


def test_quality_is_learned_from_every_labelled_text(shipped):
    """Blocks hold every row of both labels, whichever is rarer, and the model is that of all rows at once."""
    deal = np.random.default_rng(3)
    good = [(1, bytes([0, k]), [float(v) for v in deal.normal(0.3, 0.2, len(quality.FEATURES))]) for k in range(60)]
    bad = [(0, bytes([1, k]), [float(v) for v in deal.normal(0.0, 0.2, len(quality.FEATURES))]) for k in range(3)]
    for sides in ([*good, *bad], [(1 - label, digest, x) for label, digest, x in [*good, *bad]]):
        sizes = {x: sum(label == x for label, _, _ in sides) for x in (0, 1)}
        rows = shipped.createDataFrame(sides, "label int, digest binary, x array<double>")
        found = quality.blocks(rows, sizes, pairs=64).collect()
        assert len(found) == 8 and all(r.good and r.bad and len(r.good) * len(r.bad) <= 64 for r in found)
        for label, held in ((1, [x for r in found for x in r.good]), (0, [x for r in found for x in r.bad])):
            assert {tuple(x) for x in held} == {tuple(x) for own, _, x in sides if own == label}
            assert len(held) == max(sizes[label], len(found))


def test_quality_fits_a_table_as_it_fits_rows_in_memory(shipped):
    """Copies count once, held-out rows never; every other labelled text moves the model."""
    deal = random.Random(8)
    words = [[deal.choice(SENTENCE.split()) for _ in range(deal.randint(5, 60))] for _ in range(300)]
    texts = [(i, " ".join(w if i % 4 else [x + "!!" if deal.random() < 0.4 else x for x in w]), "s") for i, w in enumerate(words)]
    texts += [(1000 + i, t, s) for i, t, s in texts[:40]]
    labels = [(i, int(i % 4 != 0), 0) for i in [*range(300), *range(1000, 1040)]]
    docs = shipped.createDataFrame(rows_of(texts), SCHEMA)
    model = quality.train(docs, shipped.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    learned = sorted({(t, int(i % 4 != 0)) for i, t, _ in texts if zlib.crc32(str(i).encode()) % 5})
    x, label = np.array([quality.features(t) for t, _ in learned]), np.array([y for _, y in learned])
    plain = quality.rank(x, label)
    assert np.allclose(model.mean, plain.mean) and np.allclose(model.spread, plain.spread)
    assert np.allclose(model.scores(x), plain.scores(x), atol=1e-6)


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def changed(deal: random.Random, text: str, times: int) -> str:
    out = list(text)
    for _ in range(times):
        at, kind = deal.randrange(len(out)), deal.random()
        out[at : at + (kind < 0.7)] = [] if kind < 0.35 else [deal.choice("abé")]
    return "".join(out)


@pytest.mark.parametrize("max_edits", [1, 2, 3])
def test_banded_distance_is_exact(max_edits):
    deal = random.Random(3)
    for _ in range(3000):
        a = "".join(deal.choice("ab") for _ in range(deal.randint(1, 10)))
        b = changed(deal, a, deal.randint(0, 4) if len(a) > 4 else 0)
        assert lines.within(a, b, max_edits) == (edits(a, b) <= max_edits)


def staying(placed: list[tuple], min_words: int) -> set[int]:
    """Places of the lines that stay, line by line against those that stayed."""
    near = lambda x, y: abs(len(x) - len(y)) < 5 and edits(x, y) <= lines.edits(min(len(x), len(y)), min_words)
    stay: list[int] = []
    seen: set[tuple] = set()
    for k, (*_, x) in enumerate(placed):
        words = tuple(x.split())
        if words not in seen and not any(near(words, placed[j][-1].split()) for j in stay):
            stay.append(k)
        seen.add(words)
    return set(stay)


def moved(deal: random.Random, line: str, times: int) -> str:
    """``line`` with so many words replaced, added or left out."""
    out = line.split()
    for _ in range(times):
        at, kind = deal.randrange(len(out)), deal.random()
        out[at : at + (kind < 0.7)] = [] if kind < 0.2 and len(out) > 1 else [deal.choice(["x", "yé", "zz"])]
    return " ".join(out)


@pytest.mark.parametrize("min_words", [4, 16])
def test_lines_that_stand_earlier_go(shipped, empty, min_words):
    deal = random.Random(min_words)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "aeiouß"]
    stock = [" ".join(deal.choice(words) for _ in range(deal.randint(1, 40 if i % 4 else 110))) for i in range(30)]
    stock += [" ".join(stock[1].split()[:12] + [deal.choice(words) for _ in range(12)]) for _ in range(12)]  # one beginning
    texts = []
    for i in range(60):
        own = [moved(deal, deal.choice(stock), deal.choice([0, 0, 1, 1, 2, 3])) for _ in range(deal.randint(0, 6))]
        texts.append((i, "\n".join(own), "s"))
    texts += [(70, None, "s"), (71, "", "s"), (72, "\n \n", None), (73, "e" * 50_000, "s"), (5, texts[5][1], "s"), (None, "  " + stock[0].replace(" ", "\t "), "s")]
    texts += [(74, " ".join(["long"] * 3000 + ["a"]), "s"), (75, " ".join(["long"] * 3000 + ["b"]), "s")]
    frame = shipped.createDataFrame(rows_of(texts), SCHEMA)
    hashes = {(r.doc_id, r.text): r.th for r in frame.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th")).collect()}
    placed = {(i, hashes[i, t], n, x.strip()) for i, t, _ in texts for n, x in enumerate((t or "").split("\n")) if x.strip()}
    placed = sorted(placed, key=lambda p: (-1 if p[0] is None else p[0], *p[1:3]))
    stay: dict[tuple, set] = {}
    for k in staying(placed, min_words):
        stay.setdefault(placed[k][:2], set()).add(placed[k][2])
    left = {(r.doc_id, r.n_chars): r.text for r in lines.dedup(frame, min_words).collect()}
    for i, t, _ in texts:
        own = (t or "").split("\n")
        keep = stay.get((i, hashes[i, t]), set())
        want = "\n".join(x for n, x in enumerate(own) if n in keep or not x.strip()) if keep else ""
        assert (left[i, len(t or "")] or "") == want
    told = lines.report(frame, min_words).collect()
    assert len(told) == len(texts)
    assert sum(r.n_kept for r in told) == sum(len(stay.get((i, hashes[i, t]), ())) for i, t, _ in texts)
    assert lines.report(empty).count() == 0
    assert lines.dedup(frame).columns == frame.columns


def test_a_line_goes_only_for_one_that_stays(shipped):
    """A chain whose ends are far apart loses every second line, in whatever documents its lines stand."""
    base = [f"w{i}" for i in range(20)]
    chain = [" ".join(["new"] * k + base[k:]) for k in range(9)]
    deal = random.Random(1)
    order = list(range(9))
    for _ in range(3):
        frame = shipped.createDataFrame(rows_of([(i, chain[k], "s") for i, k in enumerate(order)]), SCHEMA)
        left = {r.doc_id for r in lines.dedup(frame).collect() if r.text}
        assert left == staying([(chain[k],) for k in order], lines.MIN_WORDS)
        deal.shuffle(order)


def test_a_large_group_of_near_lines_gives_few_links(shipped):
    """Lines near to each other, and lines that share most words but are not near, make links by lines, not by pairs."""
    base = [f"w{i}" for i in range(40)]
    near = [" ".join(base[:20] + [f"x{i}"] + base[21:]) for i in range(400)]
    apart = [" ".join([f"a{i}", f"b{i}", f"c{i}"] + [f"v{k}" for k in range(37)]) for i in range(400)]
    frame = shipped.createDataFrame(rows_of([(i, t, "s") for i, t in enumerate(near + apart)]), SCHEMA)
    first = lines._occurrences(frame).groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "th", "line_no")).alias("at"))
    met = lines._met(lines._entries(frame, lines.MIN_WORDS))
    texts = lines._texts(frame, np.full(lines.FILTER_BITS // 32, -1, np.int32).view(np.uint32), lines.MIN_WORDS).join(first, ["k1", "k2"])
    assert lines._links(met, texts, lines.MIN_WORDS).count() == 399
    assert {r.doc_id for r in lines.dedup(frame).collect() if r.text} == {0, *range(400, 800)}


def test_pages_lose_what_is_not_the_article():
    model = html.fit([SENTENCE + ", and then it slept. " + SENTENCE + "."] * 20 + ["Another text, of other words. It has two sentences."], pages=250)
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=/a>Home</a></li><li><a>News</a></li></ul></nav>"
        f"<article><h1>Head &amp; line</h1><p>{SENTENCE}, and\n more of it, it went on.<br><p>{SENTENCE}. It ended there.</p></article>"
        "<footer>&copy; site</footer><script>var t='</p>';</script></body></html>"
    )
    text, *rest = html.text_of(model, [page, "", "<p>unclosed", "plain"])
    assert text == f"Head & line\n{SENTENCE}, and more of it, it went on.\n{SENTENCE}. It ended there."
    assert rest[0] == ""
    assert html.text_of(model, []) == []


def test_decoding_never_takes_below_what_is_left_out():
    root = html.parse("<div><p>a<b>c</b></p><div><p>text of this</p></div></div>")
    nodes, x = html.measure(root)
    deal = np.random.default_rng(1)
    for _ in range(50):
        odds = deal.normal(size=len(nodes))
        chosen = html.decode(nodes, odds)
        taken = {id(n) for n, c in zip(nodes, chosen) if c}
        assert all(id(n.parent) in taken for n, c in zip(nodes, chosen) if c and n.parent)


def test_pieces_agree_with_the_library(shipped, docs, empty):
    import sentencepiece

    path = tokenizer_path()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    deal = random.Random(6)
    texts = ["", " ", "\n", "  a  b\n\tc \x00 ▁x <s> </s>", "a▁b", "日本 😀 é", "x" * 3000, " " * 60 + "y"]
    texts += ["".join(deal.choice("abcdeinrst ö\n▁.,0<") for _ in range(deal.randint(1, 80))) for _ in range(500)]
    model = pieces.pieces(path)
    for t in texts:
        found = model.stretches(t)
        ids = [int(i) for _, s, _ in found for i in s.split(",")]
        assert ids == library.encode(t)
        assert "".join(back for *_, back in found)[1:] == library.decode(ids)
    for r in pieces.round_trip(docs, path).join(docs.select("doc_id", "text"), "doc_id").collect():
        ids = library.encode(r.text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert pieces.round_trip(docs, path).count() == docs.count()
    assert pieces.round_trip(empty, path).count() == 0
    again = docs.select("text", pieces.decode(pieces.encode(F.col("text"), path), path).alias("again"))
    assert all(r.again == (r.text or "") for r in again.collect())


@pytest.mark.parametrize("spread", [0.0, 0.1, 1.0])
def test_cover_trees_cover_and_separate(spread):
    deal = np.random.default_rng(3)
    middles = 64 * deal.normal(size=(12, 8))
    points = np.floor(middles[deal.integers(0, 12, 3000)] + 64 * spread * deal.normal(size=(3000, 8)))
    tree = topk.CoverTree(points)
    assert sorted(tree.order) == list(range(3000))
    for node, below in enumerate(tree.children):
        level = tree.levels[node]
        rows = points[tree.order[slice(*tree.span[node])]]
        away = np.sqrt(((rows - points[tree.centres[node]]) ** 2).sum(axis=1)).max()
        assert away == tree.radius[node]
        assert away <= (0 if level is None else 2.0**level)
        if not len(below):
            assert len(rows) <= topk.LEAF or level is None
            continue
        centres = [tree.centres[x] for x in below]
        assert tree.centres[node] in centres
        assert all(tree.levels[x] is None or tree.levels[x] < level for x in below)
        apart = np.sqrt(((points[centres][:, None] - points[centres][None]) ** 2).sum(axis=2))
        assert len(centres) == 1 or apart[~np.eye(len(centres), dtype=bool)].min() > 2.0 ** (level - 1)


def test_dual_tree_search_multiplies_few_pairs_of_clustered_points(monkeypatch):
    deal = np.random.default_rng(4)
    middles = deal.normal(size=(40, 64))
    x = np.floor(64 * (middles[deal.integers(0, 40, 4000)] + 0.1 * deal.normal(size=(4000, 64)))).astype(np.int64)
    ids, asked = np.arange(4000), np.arange(4000) % 20 == 0
    met, add = [], topk._Best.add
    monkeypatch.setattr(topk._Best, "add", lambda self, rows, scores, *rest: (met.append(scores.size), add(self, rows, scores, *rest)))
    got = topk.search(ids[asked], x[asked], ids, x, 20, np.full(asked.sum(), -np.inf))
    want = []
    for q in ids[asked]:
        scores = x @ x[q]
        want += [(q, i, scores[i]) for i in np.lexsort((ids, -scores)) if i != q][:20]
    assert sorted(got) == sorted(want)
    assert sum(met) < 0.2 * asked.sum() * 4000


def test_topk_is_brute_force(shipped):
    deal = random.Random(7)
    vectors = [(i, [deal.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(6)], 1) for i in range(700)]
    vectors += [(1000, None, 1), (1001, [1.0, None] * 3, 1), (1002, [float("nan")] * 6, 1), (1003, [float("inf")] * 6, 1), (1004, [], 1), (2000, [1.0, 2.0], 1)]
    vectors += [(1100 + i, vectors[3][1], 2) for i in range(40)]
    frame = shipped.createDataFrame(vectors, "vec_id long, embedding array<float>, v int")
    rows = topk.top(topk.quantised(frame), F.col("id") % 20 == 0, k=7).collect()
    whole = {i: np.floor(64 * np.array(v, float)).astype(int) for i, v, _ in vectors if i < 1000 or 1100 <= i < 2000}
    want = []
    for q in (i for i in whole if i % 20 == 0):
        scored = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:7]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    assert sorted(tuple(r) for r in rows) == sorted(want)
    assert topk.top(topk.quantised(frame.limit(0)), F.col("id") % 20 == 0).count() == 0


def test_topk_over_a_tree_of_cells_is_brute_force(shipped, monkeypatch):
    """Cells are cut more than once, and a third of the rows are one vector."""
    for name, value in (("BLOCK", 60), ("QUERY_BLOCK", 10), ("SAMPLE", 40)):
        monkeypatch.setattr(topk, name, value)
    deal = np.random.default_rng(9)
    middles = deal.normal(size=(6, 5))
    x = np.floor(64 * (middles[deal.integers(0, 6, 3000)] + 0.2 * deal.normal(size=(3000, 5)))).astype(int)
    x[::3] = x[3]
    rows = shipped.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<long>")
    want = []
    for q in range(0, 3000, 20):
        scores = x @ x[q]
        first = [i for i in np.lexsort((np.arange(3000), -scores)) if i != q][:5]
        want += [(q, n, int(i), int(scores[i])) for n, i in enumerate(first, 1)]
    grown, depth = topk._grown(rows.withColumn("cell", F.lit(0).cast("long")))
    assert depth > 1
    assert sorted(tuple(r) for r in topk.top(rows, F.col("id") % 20 == 0, k=5).collect()) == sorted(want)
    heads = grown.groupBy("cell").count().orderBy(F.desc("count")).collect()
    assert len(heads) > 40


def test_rules_count_like_the_definitions(docs, empty):
    found = rules.judged(rules.count(docs), []).join(docs.select("doc_id", "text"), "doc_id").collect()
    for r in found:
        t = r.text or ""
        words = WORD.findall(t)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        filled = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(filled) - len(set(filled)), len(repeated))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 20 or 100 * len(repeated) > 30 * len(words))
        assert r.kept == (not r.base_failed)
    assert rules.judged(rules.count(empty), []).count() == 0


def test_rules_are_learned_from_counts(shipped):
    deal = random.Random(8)
    texts = [(i, " ".join(deal.choice(SENTENCE.split()) + str(deal.randint(0, 99)) + ("***" if i % 3 == 0 else "") for _ in range(40)), "s") for i in range(400)]
    frame = shipped.createDataFrame(rows_of(texts), SCHEMA)
    labels = shipped.createDataFrame([(i, int(i % 3 != 0), 0) for i, _, _ in texts], "doc_id long, quality int, toxic int")
    counted = rules.count(frame)
    learned = rules.train(counted, labels)
    assert learned
    assert all(r.kept == (r.doc_id % 3 != 0) for r in rules.judged(counted, learned).collect())
    assert rules.train(counted, labels.limit(0)) == []


def plain_fingerprint(text: str) -> int:
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups_are_the_components(shipped, docs, empty):
    found = simhash.near_duplicates(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.fp & (1 << 64) - 1 == plain_fingerprint(texts[r.doc_id] or "") for r in found)
    assert {r.component_id for r in found if r.doc_id in (100, 101, 102)} == {100}
    assert simhash.near_duplicates(empty).count() == 0
    left = simhash.kept(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id in (100, 101, 102, 104)) == [100, 104]

    deal = random.Random(9)
    prints = [deal.getrandbits(64) for _ in range(30)]
    for _ in range(200):
        prints.append(deal.choice(prints) ^ 1 << deal.randrange(64) ^ 1 << deal.randrange(64))
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    near = {(a, b) for a, b in itertools.combinations(prints, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    pairs = simhash.links(shipped.createDataFrame([(p,) for p in prints], "fp long"))
    assert sorted(tuple(r) for r in pairs.collect()) == sorted(near)
    root = {p: p for p in prints}
    for _ in prints:
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    assert {r.node: r.root for r in simhash.components(pairs).collect()} == {p: root[p] for pair in near for p in pair}


def test_sources_dealt_over_slices_are_never_broadcast(shipped, docs, monkeypatch):
    """A slice stands for each source 64 times, and Spark judges them all by the size of the sources."""
    few = sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    monkeypatch.setattr(mixing, "SENT", 2)
    many = mixing.mix(docs)
    assert sorted(map(tuple, many.collect()), key=str) == few
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_simhash_postings_are_never_broadcast(shipped):
    """They are 28 times as many as the fingerprints by whose size Spark judges them."""
    pairs = simhash.links(shipped.range(500).select(F.xxhash64("id").alias("fp")))
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def plain_kernel(a: str, b: str) -> float:
    def weights(word: str) -> Counter:
        out: Counter = Counter()
        for i, j, k in itertools.combinations(range(len(word) + 1), 3):
            marked = "\1" + word
            out[marked[i] + marked[j] + marked[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    x, y = weights(a), weights(b)
    dot = lambda p, q: sum(v * q.get(u, 0) for u, v in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


def test_kernel_is_the_sum_over_subsequences():
    kernel = toxicity.Kernel(["idiot", "loser", "aaab"])
    words = ["idiiot", "lxoser", "aaaa", "zzz", "iot"]
    want = [[plain_kernel(w, m) for m in ("idiot", "loser", "aaab")] for w in words]
    assert np.allclose(kernel.similar(words), want, atol=1e-4)


def test_toxic_words_are_found_with_gaps_and_endings(shipped, empty):
    deal = random.Random(10)
    plain = lambda: " ".join(deal.choice(SENTENCE.split()) + deal.choice(["ing", "es", "", "ly"]) for _ in range(30))
    toxic = lambda: f"{plain()} {deal.choice(['blorgush', 'blorgen', 'blorgtum', 'blorg'])} {plain()}"
    model = toxicity.fit([toxic() for _ in range(150)], [plain() for _ in range(150)], landmarks=30)
    judge = model.scorer()
    assert min(judge([toxic() for _ in range(20)] + ["a blorgly b", "you b l o r g e n there", "blo-rgen"])) >= 0.5
    assert max(judge([plain() for _ in range(20)] + ["", "x"])) < 0.5
    rows = [(1, plain(), "s"), (2, toxic(), "s"), (2, toxic(), "s"), (None, plain(), None), (4, None, "s"), (5, "", "s"), (6, "blorgen" + " a" * 50_000, "s")]
    left = toxicity.without_toxic(shipped.createDataFrame(rows_of(rows), SCHEMA), model)
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 4, 5]
    assert toxicity.without_toxic(empty, model).count() == 0
    none = toxicity.train(empty, shipped.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert none.scorer()(["anything"])[0] < 0.5


def test_pipeline_stages_follow_each_other(shipped, docs):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["toxic_texts", "line_dedup", "near_duplicates", "source_mix", "encoding"]
    left = docs
    for _, stage in corpus_pipeline.STAGES[1:4]:
        left = stage(shipped, left, "")
        assert left.columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](shipped, left, "").columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def plain_groups(prints: list[int], max_bits: int = 2) -> list[int]:
    """The smallest position of each one's group, by all pairs."""
    root = list(range(len(prints)))
    for _ in prints:
        for a, b in itertools.combinations(range(len(prints)), 2):
            if (prints[a] ^ prints[b]).bit_count() <= max_bits:
                root[a] = root[b] = min(root[a], root[b])
    return root


def test_one_document_of_each_group_stays(shipped, empty):
    """Copies with many ids, with one id, without an id, and equal rows; the same id in two groups; maps among the columns."""
    deal = random.Random(12)
    text = lambda: " ".join(deal.choice("abcdefgh") + str(deal.randrange(90)) for _ in range(40))
    a, b, c, d = (text() for _ in range(4))
    rows = [(i, a, "s") for i in range(40, 20, -1)] + [(7, b, "s"), (7, c, "s"), (9, b, "s"), (8, c, "t"), (8, c, "t")]
    rows += [(None, d, "s"), (None, d, "t"), (None, d, "t"), (3, None, "s"), (3, "", "s"), (None, " ", "s")]
    frame = shipped.createDataFrame(rows_of(rows), SCHEMA).withColumn("extra", F.create_map(F.lit("k"), F.col("doc_id")))
    roots = plain_groups([plain_fingerprint(t or "") for _, t, _ in rows])
    want = []
    for group in set(roots):
        ids = [rows[k][0] for k in range(len(rows)) if roots[k] == group]
        want.append((group, min((i for i in ids if i is not None), default=None)))
    first = simhash.kept(frame)
    assert first.columns == frame.columns
    found = sorted(first.collect(), key=str)
    by_text = {(t or ""): root for (_, t, _), root in zip(rows, roots)}
    assert sorted(((by_text[r.text or ""], r.doc_id) for r in found), key=str) == sorted(want, key=str)
    assert sorted(simhash.kept(frame.repartition(5)).collect(), key=str) == found
    assert simhash.kept(empty).count() == 0


def test_the_rows_of_the_pipeline(shipped, tmp_path):
    """``run`` on a folder of tables against the stages done plainly: toxic texts, near lines and copies go."""
    import sentencepiece

    deal = random.Random(21)
    words = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in "rst"]
    line = lambda n: " ".join(deal.choice(words) for _ in range(n))
    shared, near = line(30), line(40)
    texts: dict[int, str] = {i: "\n".join(line(deal.randint(18, 30)) for _ in range(4)) for i in range(300)}
    toxic = set(range(0, 300, 3))
    for i in toxic:
        texts[i] += " " + deal.choice(["blorgush", "blorgen", "blorgtum"])
    for i in (1, 4, 7, 10):
        texts[i] += "\n" + shared
    texts[13] += "\n" + near
    texts[16] += "\n" + moved(deal, near, 1)
    rows = [(i, t, f"s{i % 2}") for i, t in texts.items()]
    rows += [(400, None, "s0"), (401, "", "s0"), (402, texts[2], "s1"), (403, texts[2], "s1")]
    shipped.createDataFrame(rows_of(rows), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in texts]
    shipped.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    clean = [(i, t, s) for i, t, s in rows if i not in toxic]
    placed = sorted((i, 0, n, x.strip()) for i, t, _ in clean for n, x in enumerate((t or "").split("\n")) if x.strip())
    stay = {placed[k][:3] for k in staying(placed, lines.MIN_WORDS)}
    left = []
    for i, t, s in clean:
        own = (t or "").split("\n")
        keep = [n for n in range(len(own)) if (i, 0, n) in stay]
        left.append((i, None if t is None else "\n".join(x for n, x in enumerate(own) if n in keep or not x.strip()) if keep else "", s))
    roots = plain_groups([plain_fingerprint(t or "") for _, t, _ in left])
    single = [left[k] for k in sorted(set(roots))]
    assert {16, 4, 402, 403, 401} & {i for i, _, _ in single} == {16, 4}
    copies = {r.doc_id: r.copies for r in mixing.mix(shipped.createDataFrame(rows_of(single), SCHEMA)).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
    want: list[tuple] = []
    for i, t, _ in single:
        ids = library.encode(t or "")
        want += [(i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))] * copies[i]
    found = corpus_pipeline.run(shipped, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(tuple(r) for r in found) == sorted(want)
    assert corpus_pipeline.ORACLE_SQL is None
