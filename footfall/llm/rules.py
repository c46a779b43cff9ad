"""Quality rules as a learned decision list: ordered conjunctions of thresholds, found by sequential covering.

All learning is on counts. A labelled text is a row of measures; a rule grows by the threshold that gains most on the
growing part of the rows, until it takes no good text or nothing is gained, and is pruned back on the other part. The
rows it covers leave, and the next rule is sought. The list becomes one Spark conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import WORD, labels_to_learn, own_name, stored, text_or_empty

WINDOW_WORDS = 8
#: Thresholds tried of each measure: quantiles of the labelled rows.
CUTS = 12
MAX_RULES, MAX_CONDITIONS = 8, 3
#: A rule stays if of the pruning rows it covers at least this share is bad, and it covers so many bad rows.
PRECISION, LEAST = 0.8, 3
MEASURES = ("n_words", "word_length", "symbols", "dup_lines", "repeats", "distinct", "upper", "words_per_line")


def _with_hashes(rows: DataFrame, words: str, name: str) -> DataFrame:
    """``rows`` with a hash of each window of eight words, made from hashes of single words, pairs and fours.

    Each step is a column of its own, since each is read twice; the last windows run over the end and are cut off.
    """
    steps = [own_name(f"hash{k}") for k in (1, 2, 4)] + [name]
    rows = rows.withColumn(steps[0], F.transform(words, lambda w: F.xxhash64(w)))
    for width, before, after in zip((1, 2, 4), steps, steps[1:]):
        rest = F.slice(before, width + 1, F.greatest(F.size(before), F.lit(1)))
        rows = rows.withColumn(after, F.zip_with(before, rest, lambda a, b: F.xxhash64(a, b)))
    whole = F.slice(name, 1, F.greatest(F.size(words) - (WINDOW_WORDS - 1), F.lit(1)))
    return rows.withColumn(name, F.when(F.size(words) >= WINDOW_WORDS, whole)).drop(*steps[:-1])


def _repeated_words(hashes: Column) -> Column:
    """How many words lie in a window that stands twice or more: sorted by hash, equal windows are neighbours."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(sorted_: Column) -> Column:
        at = lambda k: F.get(sorted_, k)["h"]
        twice = F.filter(F.transform(sorted_, lambda x, k: F.when((x["h"] == at(k - 1)) | (x["h"] == at(k + 1)), x["i"])), lambda i: i.isNotNull())
        starts = F.array_sort(twice)
        own = F.zip_with(
            starts, F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))),
            lambda a, b: F.least(F.lit(WINDOW_WORDS), F.coalesce(b - a, F.lit(WINDOW_WORDS))),
        )
        return F.aggregate(own, F.lit(0).cast("long"), lambda s, x: s + x)

    # a lambda's argument is worked out once, where a column put in twice would be worked out twice
    return F.get(F.transform(F.array(placed), covered), 0)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column ``found`` of counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and more.

    A null or empty text has no words and every count 0.
    """
    found, words, hashes = own_name("found"), own_name("words"), own_name("hashes")
    whole = text_or_empty(text)
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD))
    rows = docs.withColumn(words, F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)))
    rows = _with_hashes(rows, words, hashes)
    n = F.size(words).cast("long")
    repeats = F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _repeated_words(F.col(hashes))).otherwise(F.lit(0))
    count_of = lambda pattern: F.regexp_count(whole, F.lit(pattern)).cast("long")
    line_counts = F.get(F.transform(F.array(lines), lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))), 0)
    rows = rows.withColumn(
        found,
        F.struct(
            n.alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda s, w: s + F.length(w)).alias("word_chars"),
            count_of("[#*$%&|<>]").alias("n_symbols"),
            line_counts["dup"].cast("long").alias("n_dup_lines"),
            line_counts["n"].cast("long").alias("n_lines"),
            F.coalesce(repeats, F.lit(0)).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
            count_of("[A-Z]").alias("n_upper"),
        ),
    )
    return rows.drop(words, hashes).withColumnRenamed(found, "found") if "found" not in docs.columns else rows.drop(words, hashes)


def measures(found: str = "found") -> dict[str, Column]:
    """What rules may speak of: shares that do not depend on a text's length, and its number of words."""
    c = lambda name: F.col(f"{found}.{name}")
    words, chars = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("word_chars"), F.lit(1))
    share = lambda a, b: a / b
    return {
        "n_words": c("n_words").cast("double"),
        "word_length": share(c("word_chars"), words),
        "symbols": share(c("n_symbols"), chars),
        "dup_lines": share(c("n_dup_lines"), F.greatest(c("n_lines"), F.lit(1))),
        "repeats": share(c("n_repeat_words"), words),
        "distinct": share(c("n_distinct"), words),
        "upper": share(c("n_upper"), chars),
        "words_per_line": share(words, F.greatest(c("n_lines"), F.lit(1))),
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    cut: float

    def holds(self, of: dict[str, Column]) -> Column:
        return of[self.measure] > self.cut if self.above else of[self.measure] <= self.cut


def rejects(rules: list[tuple[Condition, ...]], of: dict[str, Column]) -> Column:
    """The number of the first rule that takes a row (from 1), 0 if none does: one conditional expression."""
    taken = F.lit(0)
    for number, rule in reversed(list(enumerate(rules, 1))):
        every = F.lit(True)
        for condition in rule:
            every = every & condition.holds(of)
        taken = F.when(every, number).otherwise(taken)
    return taken


def learn(rows: DataFrame) -> list[tuple[Condition, ...]]:
    """Rules that take bad rows; ``rows`` has ``label`` (0 is bad), ``grow`` and a double for each of ``MEASURES``.

    Only counts by condition come to the driver. Without rows of either label no rule is found.
    """
    of = {m: F.col(m) for m in MEASURES}
    shares = [(i + 1) / (CUTS + 1) for i in range(CUTS)]
    quantiles = rows.agg(
        *[F.percentile_approx(F.when((F.col("label") == label) & F.col("grow"), F.col(m)), shares, 2000).alias(f"{m}_{label}") for m in MEASURES for label in (0, 1)],
    ).first()
    cuts = {m: sorted({*(quantiles[f"{m}_0"] or ()), *(quantiles[f"{m}_1"] or ())}) for m in MEASURES}
    if not any(cuts.values()):
        return []
    # how many cuts of a measure lie below its value: above cut j means a place greater than j
    place = lambda m: F.size(F.filter(F.array(*map(F.lit, cuts[m])), lambda c: c < F.col(m))) if cuts[m] else F.lit(0)
    placed = F.array(*[F.struct(F.lit(i).alias("measure"), place(m).alias("place")) for i, m in enumerate(MEASURES)])
    rows = stored(rows.withColumn("places", placed), "rule-places")
    rules: list[tuple[Condition, ...]] = []
    while len(rules) < MAX_RULES:
        left = rows.where(rejects(rules, of) == 0)
        grown = _grow(left.where("grow"), cuts, of)
        rule = _pruned(left.where(~F.col("grow")), grown, of) if grown else ()
        if not rule:
            break
        rules.append(rule)
    return rules


def _histograms(rows: DataFrame) -> dict[tuple[int, int, int], int]:
    """Rows by measure, place and label: a bounded table, from which the counts under every threshold follow."""
    each = rows.select("label", F.explode("places").alias("at")).groupBy("at.measure", "at.place", "label").count()
    return {(r[0], r[1], r[2]): r[3] for r in each.collect()}


def _grow(rows: DataFrame, cuts: dict[str, list[float]], of: dict[str, Column]) -> tuple[Condition, ...]:
    rule: tuple[Condition, ...] = ()
    while len(rule) < MAX_CONDITIONS:
        found = _histograms(rows)
        good, bad = (sum(n for (m, _, label), n in found.items() if m == 0 and label == wanted) for wanted in (1, 0))
        if not bad or not good:
            break
        share = lambda g, b: math.log2((b + 1e-9) / (g + b + 1e-9))
        best, condition = 1e-6, None
        for i, m in enumerate(MEASURES):
            g = b = 0
            for j, cut in enumerate(cuts[m]):
                g, b = g + found.get((i, j, 1), 0), b + found.get((i, j, 0), 0)  # rows at or below this cut
                for above, taken_good, taken_bad in ((False, g, b), (True, good - g, bad - b)):
                    gain = taken_bad * (share(taken_good, taken_bad) - share(good, bad)) if taken_bad else 0.0
                    if gain > best:
                        best, condition = gain, Condition(m, above, cut)
        if condition is None:
            break
        rule = (*rule, condition)
        rows = rows.where(condition.holds(of))
    return rule


def _counts(rows: DataFrame, conditions: list[Column]) -> list[tuple[int, int]]:
    """Good and bad rows under each condition, in one pass."""
    sums = [F.count(F.when(c & (F.col("label") == label), True)) for c in conditions for label in (1, 0)]
    found = rows.agg(*[s.alias(f"c{i}") for i, s in enumerate(sums)]).first()
    return [(found[2 * i], found[2 * i + 1]) for i in range(len(conditions))]


def _pruned(rows: DataFrame, rule: tuple[Condition, ...], of: dict[str, Column]) -> tuple[Condition, ...]:
    """The beginning of ``rule`` that does best on rows it was not grown on; nothing if none is precise enough."""
    beginnings, so_far = [], F.lit(True)
    for condition in rule:
        so_far = so_far & condition.holds(of)
        beginnings.append(so_far)
    counted = _counts(rows, beginnings)
    worth = [((b - g) / (b + g) if b + g else -1.0, b) for g, b in counted]
    precise = [i for i, (g, b) in enumerate(counted) if b >= LEAST and b >= PRECISION * (g + b)]
    if not precise:
        return ()
    best = max(precise, key=lambda i: (round(worth[i][0], 2), worth[i][1], -i))
    return rule[: best + 1]


def count(docs: DataFrame) -> DataFrame:
    """``doc_id`` and counts of every row, stored: texts are read once, for learning and for judging."""
    return stored(measured(docs.select("doc_id", "text")).select("doc_id", "found"), "rule-counts")


def train(counted: DataFrame, labels: DataFrame, label: str = "quality") -> list[tuple[Condition, ...]]:
    """Learns from every labelled row of ``count`` that is not held out; two thirds grow rules, one third prunes them."""
    of = measures()
    grow = F.pmod(F.xxhash64("doc_id", F.lit("grow")), F.lit(3)) != 0
    rows = counted.join(labels_to_learn(labels, label), "doc_id")
    return learn(stored(rows.select("label", grow.alias("grow"), *[of[m].alias(m) for m in MEASURES]), "rule-rows"))


def judged(counted: DataFrame, rules: list[tuple[Condition, ...]]) -> DataFrame:
    """For every row of ``count``: ``doc_id``, the base counts, ``base_failed``, ``kept`` and the number of the rule that took the row (0: none).

    A text fails the base with under 20 words, or if over 30 % of its words stand in repeated windows; null counts as
    empty and fails. Rows with null ids or repeated rows are judged like others.
    """
    base = (F.col("found.n_words") < 20) | (100 * F.col("found.n_repeat_words") > 30 * F.col("found.n_words"))
    told = counted.select(
        "doc_id",
        *[F.col(f"found.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base.alias("base_failed"),
        rejects(rules, measures()).alias("rule"),
    )
    counts = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return told.select(*counts, (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
