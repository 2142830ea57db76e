"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from coverbay.llm import decontaminate, hardneg, language, merkle, mixing, neardup, quality, secretscan, sharding, topk, toxicity, warc, wavelet
from coverbay.llm.shared import remainder, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, name = decontaminate.annotate(documents, table(spark, sf_dir, "benchmark"))
    n_words, spans, items = name["n_words"], name["spans"], name["items"]
    return found.select(
        "doc_id",
        F.col(n_words).alias("n_words"),
        decontaminate.hit_words(spans).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
        decontaminate.contaminated(n_words, spans).alias("contaminated"),
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    queries = documents.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), "text")
    # rounded, so that engines that add in another order agree
    return topk.search(documents, queries).withColumn("score", F.round("score", 6))


def _judged(spark: SparkSession, sf_dir: str, operator, threshold: float) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = remainder(F.col("doc_id"), 3)
    model = operator.train(documents, table(spark, sf_dir, "labels"), rest != 1)
    found, score = operator.score_documents(documents, model)
    return found.select(
        "doc_id",
        F.coalesce(rest == 1, F.lit(False)).alias("held_out"),
        F.col(score).alias("score"),
        (F.col(score) >= threshold).cast("int").alias("predicted"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, toxicity, 0.7)


def op4_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.numbered(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = remainder(F.col("doc_id"), 5)
    model, sharpness, threshold = language.train(documents, rest != 0)
    found, name = language.identify(documents.select("doc_id", "text"), model, sharpness, threshold)
    return found.select(
        "doc_id",
        F.coalesce(rest == 0, F.lit(False)).alias("held_out"),
        F.col(name["lang_pred"]).alias("lang_pred"),
        F.col(name["score"]).alias("score"),
        F.col(name["cross_entropy"]).alias("cross_entropy"),
        F.col(name["rejected"]).alias("rejected"),
    )


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.dealt(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = (F.col("size") * F.size("copies")).alias("taken")
    shards, positions = F.col("copies.shard").alias("shards_of_copies"), F.col("copies.position").alias("positions_of_copies")
    return rows.select("doc_id", "size", "source_size", "target", taken, shards, positions)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, spans = secretscan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [rule.kind for rule in secretscan.RULES[: secretscan.BASE]]
    of = lambda kinds: F.filter(spans, lambda span: span["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *(F.size(of([kind])).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(secretscan.listed(of(base)), 256).alias("base_sha256"),
        secretscan.listed(F.col(spans)).alias("spans"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, quality, 0.5)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_folder(spark)
    archives = warc.normalise(warc.write_archives(table(spark, sf_dir, "pages"), folder), folder)
    rows = warc.read_records(archives)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    return merkle.proofs(merkle.build(documents, remainder(F.col("doc_id"), 3) == 0))


def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = wavelet.write_files(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return wavelet.read_files(files, with_ids=False)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.mine(hardneg.typed(table(spark, sf_dir, "embeddings"), label=hardneg.flipped()))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_topk": op2_topk,
    "op3_toxicity": op3_toxicity,
    "op4_shard": op4_shard,
    "op5_language": op5_language,
    "op6_mix": op6_mix,
    "op7_secrets": op7_secrets,
    "op8_quality": op8_quality,
    "op9_warc": op9_warc,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_merkle": op11_merkle,
    "op12_tokens": op12_tokens,
    "op13_hard_negatives": op13_hard_negatives,
}
