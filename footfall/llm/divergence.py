"""How far sources of a language differ in their words: a quadtree over the matrix of groups and terms.

The rows of a language's matrix are its (lang, source) groups, the columns its kept terms, the most frequent first. The
matrix falls into squares of ``SIDE`` by ``SIDE`` cells, each split in ``K`` by ``K`` quadrants down to single cells;
quadrants without a count are not kept. Two groups are compared by walking both trees at once, down to the cells where
either has a count. In all other columns both have no count, so each of these adds the same known difference.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored
from footfall.llm.ordering import running

#: Documents of its language that a term needs; occurrences added to each count; what the shares are of.
LEAST_DOCUMENTS = 30
ADDED = 5
SCALE = 1_000_000_000
#: Terms a group reports.
TERMS = 50
#: Quadrants of a node in each direction, cells of a tree in each direction, trees that are walked together.
K = 4
LEVELS = 3
SIDE = K**LEVELS
STRIP = 64
#: Terms that a task counts before it hands them on.
HELD = 200_000

# Letters A-Z lose their case, other ASCII parts terms, bytes from 128 on are parts of letters.
_TERMS = bytes(range(256)).lower().translate(bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)))


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode("utf-8").translate(_TERMS).split()


def _counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences), ``docs`` (rows that hold it), summed over each task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurrences: dict[tuple, Counter] = defaultdict(Counter)
        holders: dict[tuple, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                found = terms(text)
                occurrences[lang, source].update(found)
                holders[lang, source].update(set(found))
                if sum(map(len, holders.values())) > HELD:
                    yield from _summed(occurrences, holders)
        yield from _summed(occurrences, holders)

    read = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*read).mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _summed(occurrences: dict, holders: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), found in holders.items():
        size = len(found)
        counts = occurrences[lang, source]
        columns = [
            pa.array([lang] * size, pa.string()),
            pa.array([source] * size, pa.string()),
            pa.array([t.decode("utf-8") for t in found], pa.string()),
            pa.array([counts[t] for t in found], pa.int64()),
            pa.array(found.values(), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
    occurrences.clear()
    holders.clear()


def _share(count: Column, all_: str, terms_: str) -> Column:
    """1 + floor(SCALE * (count + ADDED) / (all + ADDED * terms)) in whole numbers."""
    whole = lambda c: c.cast("decimal(20,0)")
    above = F.lit(SCALE).cast("decimal(10,0)") * whole(count + ADDED)
    below = whole(F.greatest(F.col(all_) + ADDED * F.col(terms_), F.lit(1)))
    return F.lit(1) + F.call_function("div", above, below)


class Side:
    """The trees of up to ``SIDE`` groups over one strip of columns: shares, and at each level which quadrants hold counts."""

    def __init__(self, zero: np.ndarray, row: np.ndarray, col: np.ndarray, share: np.ndarray):
        self.share = np.repeat(zero[:, None], SIDE * STRIP, axis=1)
        self.share[row, col] = share
        self.levels = []
        for level in range(LEVELS + 1):
            size = SIDE // K**level
            held = np.zeros((K**level, STRIP * K**level), bool)
            held[row // size, col // size] = True
            self.levels.append(held)


def walk(a: Side, b: Side, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``a`` and of ``b``: the summed difference over the cells where either holds a count, and how many.

    With ``same`` both are one block and only the pairs of a row with a later one are walked.
    """
    sums, cells = np.zeros(SIDE * SIDE, np.int64), np.zeros(SIDE * SIDE, np.int64)
    steps = np.array([(i, j, c) for i in range(K) for j in range(K) for c in range(K)])
    for tree in range(STRIP):
        if not (a.levels[0][0, tree] or b.levels[0][0, tree]):
            continue  # no count on either side: priced with the other columns that are never walked
        nodes = np.array([[0, 0, tree]])
        for level in range(1, LEVELS + 1):
            nodes = (nodes[:, None, :] * K + steps[None]).reshape(-1, 3)
            i, j, c = nodes.T
            held = a.levels[level][i, c] | b.levels[level][j, c]
            if same:
                held &= i < j if level == LEVELS else i <= j
            nodes = nodes[held]
        i, j, c = nodes.T
        pair = i * SIDE + j
        apart = np.abs(a.share[i, c] - b.share[j, c])
        sums += np.bincount(pair, weights=apart, minlength=SIDE * SIDE).astype(np.int64)  # at most SIDE * SCALE: exact
        cells += np.bincount(pair, minlength=SIDE * SIDE)
    return sums.reshape(SIDE, SIDE), cells.reshape(SIDE, SIDE)


def _walked(cells: DataFrame, blocks: DataFrame) -> DataFrame:
    """``lang``, ``a``, ``b`` (rows, a < b), ``apart``, ``columns``: what the cells with a count on either side add.

    Strips of a block of groups go to each pair of blocks that theirs is part of; a block without a count in a strip
    that the other one has takes part with its zeros.
    """
    own = F.collect_list(F.struct("row", "col", "p")).alias("cells")  # at most SIDE * SIDE * STRIP
    strips = cells.groupBy("lang", "block", "strip").agg(own)
    strips = strips.select("lang", "block", "strip", *[F.col(f"cells.{c}").alias(c) for c in ("row", "col", "p")])
    other = F.explode(F.sequence(F.lit(0), F.col("last_block"))).alias("other")
    sizes = blocks.groupBy("lang").agg(F.max("block").alias("last_block"))
    dealt = strips.join(sizes, "lang").select("*", other)
    dealt = dealt.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    zeros = lambda x: blocks.select("lang", F.col("block").alias(x), F.col("zero").alias(f"zero_{x}"))
    dealt = dealt.join(zeros("lo"), ["lang", "lo"]).join(zeros("hi"), ["lang", "hi"])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        head = group.iloc[0]
        lo, hi = int(head["lo"]), int(head["hi"])
        of = {int(r["block"]): r for _, r in group.iterrows()}
        sides = {}
        for block, zero in ((lo, head["zero_lo"]), (hi, head["zero_hi"])):
            padded = np.zeros(SIDE, np.int64)
            padded[: len(zero)] = zero
            own = of.get(block)
            row, col, p = (np.array([] if own is None else own[c], np.int64) for c in ("row", "col", "p"))
            sides[block] = (Side(padded, row, col, p), len(zero))
        (a, rows_a), (b, rows_b) = sides[lo], sides[hi]
        sums, cells_ = walk(a, b, lo == hi)
        i, j = np.nonzero(cells_[:rows_a, :rows_b])
        found = {"lang": head["lang"], "a": lo * SIDE + i, "b": hi * SIDE + j, "apart": sums[i, j], "columns": cells_[i, j]}
        return pd.DataFrame(found, columns=["lang", "a", "b", "apart", "columns"])

    by_pair = dealt.groupBy("lang", "strip", "lo", "hi").applyInPandas(run, "lang string, a long, b long, apart long, columns long")
    return by_pair.groupBy("lang", "a", "b").agg(F.sum("apart").alias("apart"), F.sum("columns").alias("columns"))


def _ranked(rows: DataFrame, at_most: int | None = None) -> DataFrame:
    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    ranked = rows.withColumn("rank", F.row_number().over(by))
    return ranked if at_most is None else ranked.where(F.col("rank") <= at_most)


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, most_terms: int = TERMS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: how each source differs from others, and by which terms.

    Part ``pair`` has a row for each other source of the language, part ``term`` the ``most_terms`` terms that stand out
    most against the whole language. Null text, lang and source count as ''; each row is a document, also a repeated
    one. Ties go by item. A language without kept terms has pairs of value 0 and no terms; an empty table gives none.
    """
    counts = stored(_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "audit-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_documents)
    order = [F.col("lang"), F.col("total").desc(), F.col("term")]
    kept, _ = running(kept.withColumn("one", F.lit(1).cast("long")), order, "one", "place")
    kept = stored(kept.select("lang", "term", "total", "place"), "audit-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"), F.min("place").alias("first_place"))
    cells = stored(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "audit-cells")

    read = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    groups = docs.select(*read).distinct().join(cells.groupBy("lang", "source").agg(F.sum("n").alias("n_group")), ["lang", "source"], "left")
    groups = groups.join(langs, "lang", "left").fillna(0, ["n_group", "v", "n_lang", "first_place"]).withColumn("one", F.lit(1).cast("long"))
    groups, _ = running(groups, [F.col("lang"), F.col("source")], "one", "number")
    groups = stored(groups.withColumn("zero", _share(F.lit(0).cast("long"), "n_group", "v")), "audit-groups")
    firsts = groups.groupBy("lang").agg(F.min("number").alias("first_number"))
    groups = groups.join(firsts, "lang").withColumn("number", F.col("number") - F.col("first_number"))
    groups = groups.withColumn("block", F.floor(F.col("number") / SIDE).cast("int"))

    of_group = ["lang", "source", "number", "block", "n_group", "v", "n_lang", "first_place"]
    cells = cells.join(groups.select(*of_group), ["lang", "source"])
    cells = cells.withColumns({"p": _share(F.col("n"), "n_group", "v"), "q": _share(F.col("total"), "n_lang", "v")})
    cells = stored(cells.withColumn("column", F.col("place") - F.col("first_place")), "audit-shares")
    placed = cells.select(
        "lang",
        "block",
        F.floor(F.col("column") / (SIDE * STRIP)).alias("strip"),
        (F.col("number") % SIDE).cast("int").alias("row"),
        (F.col("column") % (SIDE * STRIP)).cast("int").alias("col"),
        "p",
    )
    by_block = F.transform(F.sort_array(F.collect_list(F.struct("number", "zero"))), lambda s: s["zero"])  # at most SIDE
    blocks = groups.groupBy("lang", "block").agg(by_block.alias("zero"))
    walked = _walked(placed, blocks)

    # every pair of sources is a row of the result; blocks of sources meet, so that no language is one task
    last = groups.groupBy("lang").agg(F.max("block").alias("last_block"))
    left = groups.join(last, "lang").withColumn("other_block", F.explode(F.sequence(F.lit(0), F.col("last_block"))))
    right = groups.select(
        "lang", F.col("block").alias("other_block"), F.col("source").alias("item"), F.col("number").alias("other"), F.col("zero").alias("other_zero")
    )
    pairs = left.join(right, ["lang", "other_block"]).where("number != other")
    pairs = pairs.withColumns({"a": F.least("number", "other"), "b": F.greatest("number", "other")}).join(walked, ["lang", "a", "b"], "left")
    never = F.col("v") - F.coalesce("columns", F.lit(0))
    value = F.coalesce("apart", F.lit(0)) + never * F.abs(F.col("zero") - F.col("other_zero"))
    pair = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))
    term = cells.where("n > 0 and p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).cast("long").alias("value")
    )
    return _ranked(pair).unionByName(_ranked(term, most_terms))


#: The audit in SQL: every kept term of a language for every group of it, whether it occurs there or not.
ORACLE = """
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
found AS (
  SELECT row_id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM found GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n_lang FROM kept GROUP BY lang),
sizes AS (SELECT lang, source, sum(n) AS n_group FROM counts GROUP BY lang, source),
groups AS (
  SELECT g.lang, g.source, coalesce(n_group, 0) AS n_group, coalesce(v, 0) AS v, coalesce(n_lang, 0) AS n_lang
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes USING (lang, source) LEFT JOIN langs USING (lang)),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + CAST(1000000000 * (coalesce(n, 0) + 5) AS HUGEINT) // CAST(n_group + 5 * v AS HUGEINT) AS p,
         1 + CAST(1000000000 * (total + 5) AS HUGEINT) // CAST(n_lang + 5 * v AS HUGEINT) AS q
  FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q),
both_parts AS (SELECT * FROM pairs UNION ALL SELECT * FROM terms),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
