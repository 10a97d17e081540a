"""From raw documents to token ids: five stages, each written as Parquet and read again.

Every stage but the last returns the columns of ``documents``. A stage that deletes text
brings ``n_chars`` up to date; documents that lose all their text go.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.llm import jaccard, line_runs, pieces, quality, templates
from boxlake.llm.common import Scratch, held_out, table, text_of

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts."""
    labels = table(spark, sf_dir, "labels").filter(~held_out("doc_id", 5, 0))
    model = quality.fit(docs, labels)
    return docs.filter(quality.score(model, text_of()) >= quality.ACCEPT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of lines that stand earlier."""
    # The other columns travel as one, whatever their names are.
    found = line_runs.deduplicated(docs.select("doc_id", "text", F.struct("*").alias("row")), Scratch(spark))
    found = found.filter((F.size("_deleted") == 0) | (text_of() != ""))
    size = F.when(F.size("_deleted") == 0, F.col("row.n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    new = {"text": F.col("text"), "n_chars": size}
    return found.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links join, the one of least id; rows without an id stay."""
    gone = jaccard.similar(docs).filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaked into."""
    return templates.clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and source ends of pieces (little-endian unsigned 32-bit integers), and digests."""
    found = pieces.encoded(docs, PIECE_MODEL)
    return found.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", "ends",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: The classifier is a trained model and ids come from a tokenizer: SQL has neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
