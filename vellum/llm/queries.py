"""The operators' queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from vellum.llm.packing import Limits, pack_tokens

    packed = pack_tokens(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        limits=Limits(tokens=2048, segments=256, loss_tokens=2048),
    )
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "loss_tokens", "padded_length",
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.line_dedup import Near, line_dedup

    return line_dedup(_table(spark, sf_dir, "documents"), Near(edits=2, least=20, short=((8, 1),)))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.secret_ledger import BASE, BlobLedger, scan_versions, spans_of, spans_text

    found = scan_versions(_table(spark, sf_dir, "documents"), BlobLedger(spark))
    counts = [F.size(spans_of(F.col("spans"), (r.kind,))).cast("long").alias(f"n_{r.kind}") for r in BASE]
    base = spans_text(spans_of(F.col("spans"), tuple(r.kind for r in BASE)))
    return found.select(
        F.col("path").alias("doc_id"), *counts, F.sha2(base, 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans")
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.suffix_dedup import suffix_dedup

    done = suffix_dedup(_table(spark, sf_dir, "documents"), length=100)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.cotraining import quality

    scored = quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.mixing import mix

    mixed = mix(_table(spark, sf_dir, "documents"), weights=(1, 2, 3), most_passes=3, block_words=64)
    return mixed.documents.select("doc_id", "size", "source_size", "target", "taken")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.jaccard import Alike, JaccardJoin

    join = JaccardJoin(_table(spark, sf_dir, "documents"), Alike(words=3, percent=90))
    return join.groups().select("doc_id", "n_shingles", "component_id", "class_id")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.exact_dedup import exact_dedup

    return exact_dedup(_table(spark, sf_dir, "documents"))


def op9_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.hamming_topk import top_k

    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0).select("vec_id"), k=10)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.toxicity import held_out, toxicity

    scored = toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op11_cohort_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.retention import retention_matrix

    # A third of the clicks, by their ids' checksum, arrive late.
    mark = F.crc32(F.col("click_id").cast("string"))
    late = F.when(mark % 3 == 0, mark % 100).otherwise(0).cast("int")
    arrived = F.col("arrived_at") + F.make_dt_interval(days=F.coalesce(late, F.lit(0)))
    clicks = _table(spark, sf_dir, "clicks")
    cutoff = F.lit("2024-02-15 00:00:00").cast(clicks.schema["arrived_at"].dataType)
    return retention_matrix(
        clicks,
        _table(spark, sf_dir, "clients"),
        known=(arrived < cutoff, F.lit(True)),
        starts=F.col("kind") == "signup",
        amount=F.floor(100 * F.col("value") + 0.5),
    )


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.byte_bpe import decode, encode, public_vocabulary

    vocabulary = public_vocabulary()
    done = decode(encode(_table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vellum.llm.resampling import Draw, resample

    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), Draw())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    from vellum.llm.oracles import ORACLES

    return dict(ORACLES)
