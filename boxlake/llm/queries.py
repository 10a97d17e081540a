"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.llm import alignment, bwt, ctw, jaccard, line_runs, minhash, pieces, pii, quality, sketches, syncmers, templates, url_lists
from boxlake.llm.common import Scratch, held_out, table, text_of

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.filter(~held_out("doc_id", 5, 0)))
    scored = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), quality.score(model, text_of()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.ACCEPT).cast("int"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))
    return found.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.concat("begins", "ends"), 256).alias("spans_sha256"),
    )


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = alignment.scored(
        table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_MODEL), public_tokenizers.PATTERN,
        public_tokenizers.path(PIECE_MODEL), Scratch(spark),
    )
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs.deduplicated(table(spark, sf_dir, "documents"), Scratch(spark))
    return found.select(
        "doc_id", F.col("_lines").alias("n_lines"), F.size("_deleted").cast("long").alias("n_deleted"),
        F.col("_runs").alias("n_runs"), F.sha2(text_of().cast("binary"), 256).alias("kept_sha256"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.found(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = [k.name for k in pii.KINDS if k.base]
    return found.select(
        "doc_id", *map(number, base),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op1_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.neighbours(table(spark, sf_dir, "documents"), Scratch(spark))


def op9_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = ctw.scored(docs, ~held_out("doc_id", 7, 2), Scratch(spark))
    return found.withColumn("held_out", ~F.col("training")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op5_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bwt.deduplicated(table(spark, sf_dir, "documents"), Scratch(spark))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _dated(keys: DataFrame, name: str) -> DataFrame:
    """List entries of keys on days that a digest of the key gives: on, off and maybe on again."""

    def day(at: int):
        number = F.conv(F.substring(F.md5(F.col("key").cast("binary")), at, 4), 16, 10).cast("int") % 366
        return F.date_add(F.lit("2024-01-01").cast("date"), number)

    turns = F.array(*[F.struct(day(at).alias("at"), F.lit(action).alias("action")) for at, action in ((1, "add"), (5, "remove"), (9, "add"))])
    return keys.select(F.lit(name).alias("list"), "key", F.inline(turns))


def op3_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures, one list of their domains and one of their first folders."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7919 % 366).cast("int"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", day.alias("fetched"))
    keys = pages.select(F.explode(url_lists.keys_of(F.col("url"), 1)).alias("key")).distinct()
    domains = keys.filter(r"key rlike '^d:[^.]+\\.[^.]+\\.[^.]+$'")
    folders = keys.filter("key rlike '^p:[^/]+/[^/]+/$'")
    found = url_lists.judged(pages, _dated(domains, "domains").unionByName(_dated(folders, "folders")))
    return found.select(
        "page_id", "url", F.col("fetched").cast("string").alias("fetched"), F.array_join("lists", ",").alias("lists"),
        (F.size("lists") > 0).alias("blocked"),
    )


QUERIES = {
    "op11_alignment": op11_alignment,
    "op12_ranked_search": op12_ranked_search,
    "op13_minhash": op13_minhash,
    "op3_url_lists": op3_url_lists,
    "op5_bwt_dedup": op5_bwt_dedup,
    "op9_ctw": op9_ctw,
    "op1_syncmers": op1_syncmers,
    "op4_sentencepiece": op4_sentencepiece, "op8_quality_classifier": op8_quality_classifier,
    "op10_pii": op10_pii,
    "op6_decontamination": op6_decontamination,
    "op2_line_dedup": op2_line_dedup,
    "op7_ngram_jaccard": op7_ngram_jaccard,
}
