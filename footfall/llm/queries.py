"""The queries of this subpackage by name, with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import divergence, html, importance, lines, mixing, packing, pieces, pii, quality, rules, simhash, topk, toxicity
from footfall.llm.common import held_out, ship, stored, table


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixes all documents; see ``mixing.mix``."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(quality.measured(table(spark, sf_dir, "documents")), "measured")
    model = quality.fit(rows, table(spark, sf_dir, "labels"))
    scored = rows.select("doc_id", held_out().alias("held_out"), quality.score(F.col("x"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.CUT).cast("int"))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.train(pages))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top(vectors, F.col("id") % 20 == 0)


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = rules.count(table(spark, sf_dir, "documents"))
    return rules.judged(counted, rules.train(counted, table(spark, sf_dir, "labels")))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 4,096 tokens, with a checksum of each piece; see ``packing.pack``."""
    pieces_ = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces_.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits the sources of all documents; see ``divergence.audit``."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws the twentieth of all documents that is nearest the benchmark texts; see ``importance.resample``."""
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def _with_package(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


_ALL = (
    op1_mix, op2_pii, op3_quality, op4_lines, op5_html, op6_pieces, op7_topk, op8_rules, op9_simhash, op10_toxicity,
    op11_packing, op12_divergence, op13_importance,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _with_package(f) for f in _ALL}
ORACLES: dict[str, str] = {"op1_mix": mixing.ORACLE, "op12_divergence": divergence.ORACLE}
