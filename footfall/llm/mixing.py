"""Mixing sources to target weights by thresholds on a hash, found from nested histograms; nothing is sorted.

Every row has a hash of 32 hex digits, made of its id and text. A source that is to give a share of its words takes
the rows below a threshold. To find it, words are summed by source and by the first three digits; the bucket in which
the running sum passes the budget is the only one looked into again, by the next three digits, until it holds one hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import SLICES, WORD, own_name, stored, text_or_empty

#: Hex digits a level of the histogram looks at: 4,096 buckets for each source.
DIGITS = 3
LEVELS = 11
#: So many sources go to where the rows are; more are dealt over slices.
SENT = 10_000
ABOVE_ALL = "~"


def size_of(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def _key() -> Column:
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text_or_empty()).cast("binary"))


def _source() -> Column:
    """Never null, so that the null source joins like the others."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """``src``, ``source_size`` with ``target`` added; ``sizes`` has one row per source.

    Sources in code point order, null last, get ``weights`` in turn. ``share`` times all words is dealt by weight; a
    target stops at ``most`` times its source's size, and what is above goes to the others by weight.
    """
    in_order = Window.orderBy(F.col("src") == "", "src")  # one row for each source
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("place", F.row_number().over(in_order) - 1).withColumn("weight", weight.cast("double"))
    rows = stored(rows.withColumn("most", (F.col("source_size") * most).cast("double")), "mix-sources")
    total = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while total:
        above = F.col("weight") * level > F.col("most")
        found = rows.agg(
            F.sum(F.when(above, F.col("most")).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.count(F.when(above, True)),
        ).first()
        if found[2] == full or not found[1]:
            break
        full, level = found[2] if level else -1, (total - found[0]) / found[1]
    return rows.select("src", "source_size", F.least("most", F.col("weight") * level).alias("target"))


def _thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``goals`` with ``whole`` (copies of every row) and ``below`` (rows with a smaller key are taken once more)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = goals.withColumn("whole", whole.cast("long"))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    state = stored(goals.withColumns({"left": rest, "below": F.lit(""), "done": rest <= 0}), "mix-level")
    for level in range(LEVELS):
        open_ = state.where(~F.col("done"))
        if open_.isEmpty():
            break
        bucket = F.substring("key", level * DIGITS + 1, DIGITS)
        inside = _with(rows, open_.select("src", "below")).where(F.col("key").startswith(F.col("below")))
        sums = inside.groupBy("src", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("key").alias("first"), F.max("key").alias("last")
        )
        run = F.sum("words").over(Window.partitionBy("src").orderBy("bucket"))  # at most 4,096 rows for each source
        passed = sums.withColumn("run", run).join(open_.select("src", F.col("left").alias("budget")), "src")
        passed = passed.where("run > budget").groupBy("src").agg(F.min_by(F.struct("first", "last", "words", "run"), "bucket").alias("b"))
        single = F.col("b.first") == F.col("b.last")
        before = F.col("left") - (F.col("b.run") - F.col("b.words"))
        nearer = F.concat("b.first", F.when(2 * before >= F.col("b.words"), ABOVE_ALL).otherwise(""))
        digits = F.substring("b.first", 1, (level + 1) * DIGITS)
        state = state.join(passed, "src", "left").select(
            *[c for c in goals.columns],
            F.when(F.col("done"), F.col("left")).otherwise(before).alias("left"),
            F.when(F.col("done"), F.col("below"))
            .when(F.col("b").isNull(), ABOVE_ALL)
            .when(single, nearer)
            .otherwise(digits)
            .alias("below"),
            (F.col("done") | F.col("b").isNull() | single).alias("done"),
        )
        state = stored(state, "mix-level")
    return state.drop("left", "done")


def _with(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source. Of many sources, slices keep the join even where one has most rows; Spark
    takes the slices to be as large as the sources, so it is told to merge: it would broadcast them."""
    if per_source.limit(SENT + 1).count() <= SENT:
        return rows.join(F.broadcast(per_source), "src")
    dealt = per_source.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    return rows.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(SLICES)).cast("int")).join(dealt.hint("merge"), ["src", "slice"]).drop("slice")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``, ``source``) with ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``copies`` is how often the mix takes the row, ``taken`` the words this gives. A null or empty text has size 0 and
    still gets a row; the null source is a source. Equal rows are taken alike, so reruns agree. An empty table gives none.
    """
    rows = docs.select("doc_id", _source().alias("src"), size_of().alias("size"), _key().alias("key"))
    rows = stored(rows, "mix-rows")
    goals = targets(rows.groupBy("src").agg(F.sum("size").alias("source_size")), weights, share, most)
    found = _with(rows, _thresholds(rows.where("size > 0"), goals))
    found = found.withColumn("copies", F.col("whole") + F.when(F.col("key") < F.col("below"), 1).otherwise(0))
    return found.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """``docs`` as the mix takes them: a row taken twice stands twice, with the same columns."""
    rows = docs.select("doc_id", _source().alias("src"), size_of().alias("size"), _key().alias("key"))
    rows = stored(rows, "mix-rows")
    goals = targets(rows.groupBy("src").agg(F.sum("size").alias("source_size")), weights, share, most)
    limits = _thresholds(rows.where("size > 0"), goals).select("src", "whole", "below")
    whole = own_name("whole")
    with_key = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _source().alias("src"), _key().alias("key"))
    copies = (F.col("whole") + F.when(F.col("key") < F.col("below"), 1).otherwise(0)).cast("int")
    taken = _with(with_key, limits).select("row", F.explode(F.array_repeat(F.lit(1), copies)).alias(whole))
    return taken.select("row.*")


#: The mix in SQL: the same thresholds from running sums in the order of the keys.
ORACLE = """
WITH docs AS (
  SELECT doc_id, coalesce('s' || source, '') AS src,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
  FROM documents),
sizes AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY src),
weighed AS (
  SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY src = '', src) - 1) % 3 + 1] AS DOUBLE) AS weight,
         CAST(2 * source_size AS DOUBLE) AS most, 1.5 * sum(source_size) OVER () AS total
  FROM sizes),
levels AS (
  SELECT *, (total - coalesce(sum(most) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS lev
  FROM weighed
  WINDOW before AS (ORDER BY most / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT src, source_size, least(most, weight * (SELECT min_by(lev, most / weight) FROM levels WHERE most / weight >= lev)) AS target
  FROM levels),
split AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM goals),
runs AS (
  SELECT docs.*, source_size, target, whole, target - whole * source_size AS budget,
         sum(size) OVER (PARTITION BY docs.src ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
         sum(size) OVER (PARTITION BY docs.src, key) AS own
  FROM docs JOIN split ON docs.src = split.src)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
       CAST((whole + CASE WHEN budget > 0 AND run - own + run <= 2 * budget THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM runs
"""
