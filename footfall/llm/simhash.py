"""SimHash near-duplicates: fingerprints linked through an inverted index on their bytes by position.

Two fingerprints of eight bytes that differ in at most k bits share at least 8 - k bytes by position. Each different
fingerprint is posted under every choice of 8 - k of its positional bytes, so a pair that shares the guaranteed number
meets in a posting list, and one that shares fewer never does: the choice does the counting, and the bits decide. Lists
of single bytes with a tally for each pair would give the same links, but every list holds a 256th of all fingerprints
or more, so that their pairs grow with the square of the input. Copies of one fingerprint are one entry of the index,
whatever their number.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import own_name, stored

#: 64 bits in eight bytes.
BYTES = 8
_LANES = np.uint64(0x0101010101010101)


def fingerprint_of(text: str, shingle: int = 3, seed: int = 42) -> int:
    """Majority of the bits of the hashes of all shingles, repeats included, of the words in lower-case ASCII."""
    words = text.encode("utf-8").lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    last = ends[shingle - 1 :].tolist()
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, last)), np.uint64, len(last))
    counts = np.zeros(64, np.int64)
    for lane in range(8):  # bits lane, lane + 8, ...: one byte for each, summed 255 hashes at a time
        bits = (hashes >> np.uint64(lane)) & _LANES
        sums = np.add.reduceat(bits, np.arange(0, len(bits), 255))
        counts[lane::8] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * counts > len(hashes))
    return int(sum(1 << int(b) for b in set_bits))


def fingerprint(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """The fingerprint as a signed long; null counts as the empty text, which has fingerprint zero."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        values = [fingerprint_of(t, shingle, seed) if isinstance(t, str) else 0 for t in texts]
        return pd.Series(np.array(values, np.uint64).view(np.int64))

    return run(text)


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs ``a < b`` of different fingerprints (column ``fp``, each once) that differ in at most ``max_bits`` bits.

    A pair that shares more bytes than guaranteed meets in several lists; only the first of them, by the choice of
    positions, gives it out. Spark takes the postings to be as large as the fingerprints, a fraction of what they are, so
    it is told to merge: it would broadcast them.
    """
    shared = BYTES - max_bits
    choices = list(combinations(range(BYTES), shared))
    masks = [sum(255 << 8 * p for p in c) for c in choices]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes")) for i, m in enumerate(signed)])
    posted = prints.select("fp", F.explode(keys).alias("key")).select("fp", "key.choice", "key.bytes")
    a, b = F.col("l.fp"), F.col("r.fp")
    # the first choice of positions in which the pair agrees everywhere
    first = F.coalesce(*[F.when(a.bitwiseXOR(b).bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(signed)])
    near = F.bit_count(a.bitwiseXOR(b)) <= max_bits
    pairs = posted.alias("l").join(
        posted.alias("r").hint("merge"),
        (F.col("l.choice") == F.col("r.choice")) & (F.col("l.bytes") == F.col("r.bytes")) & (a < b) & near & (F.col("l.choice") == first),
    )
    return pairs.select(a.alias("a"), b.alias("b"))


def components(pairs: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) for the nodes of the undirected ``pairs`` (``a``, ``b``).

    Each round gives a node the smallest root of its neighbours, then that root's own root; stored rounds, so that the
    plan never grows. Only the number of changes comes to the driver.
    """
    edges = stored(pairs.select("a", "b").union(pairs.select("b", "a")), "links")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        up = step.select(F.col("node").alias("root"), F.col("root").alias("above"))
        after = stored(step.join(up, "root").select("node", "was", F.least("root", "above").alias("root")), "roots")
        labels = after.select("node", "root")
        if after.where("root <> was").isEmpty():
            return labels


def _groups(rows: DataFrame, max_bits: int) -> DataFrame:
    """``fp``, ``root`` (its group), ``component_id`` (smallest id of the group), stored, for each fingerprint of ``rows``."""
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    grouped = components(links(prints.select("fp"), max_bits))
    joined = prints.join(grouped, prints.fp == grouped.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return stored(joined.select("fp", "root").join(least, "root"), "groups")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """``doc_id``, ``fp`` (signed), ``root`` (its group), ``component_id`` (smallest id of the group) for every row.

    Null and empty texts have fingerprint zero and are linked like any other. Repeated rows share their group. A null
    id is no one's smallest id; a group of null ids only has a null ``component_id``. An empty table gives no rows.
    """
    rows = stored(docs.select("doc_id", fingerprint(F.col("text"), shingle, seed).alias("fp")), "prints")
    return rows.join(_groups(rows, max_bits), "fp").select("doc_id", "fp", "root", "component_id")


def kept(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id, of equal ids that of the smallest hash of its row.

    A null id comes after all others. Of rows equal throughout one stays. Columns with maps do not enter the hash: of rows
    that differ in those alone any one stays. Texts are hashed once and move once, to the choice of their group, which is
    made from ids, hashes and fingerprints alone: first for each fingerprint, so that no group of copies is a heavy key.
    """
    pick, row = own_name("pick"), F.xxhash64(*[F.col(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()])
    rows = stored(docs.select("doc_id", row.alias("row"), fingerprint(F.col("text"), shingle, seed).alias("fp")), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row"))
    best = rows.groupBy("fp").agg(first.alias("best")).join(_groups(rows, max_bits), "fp")
    chosen = best.groupBy("root").agg(F.min("best").alias("best"))
    label = lambda doc_id, hashed: F.concat_ws(":", doc_id.cast("string"), hashed.cast("string"))
    chosen = chosen.select(label(F.col("best.doc_id"), F.col("best.row")).alias(pick)).distinct()
    return docs.withColumn(pick, label(F.col("doc_id"), row)).join(chosen, pick, "left_semi").dropDuplicates([pick]).drop(pick)
