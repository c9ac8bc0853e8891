"""The registered queries of the numbered operators, over whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import (
    decontaminate,
    hard_negatives,
    language_cnn,
    licenses,
    line_dedup,
    lsh_forest,
    packing,
    prefix_trie,
    quality,
    sharding,
    token_counts,
    token_files,
    warc,
)
from threadloom.session import materialise


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs).select("doc_id", "n_lines", "n_removed", "removed_lines", "text")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.recount(_table(spark, sf_dir, "documents"), keep=("doc_id",))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.archive_pages(_table(spark, sf_dir, "pages"))
    return warc.read(archives, warc.shared_folder(spark)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held_out = F.crc32(number.cast("binary")) % 5 == 0
    model = language_cnn.fit(docs, ~held_out)
    judged = docs.select("doc_id", "text", held_out.alias("held_out"))
    return language_cnn.identify(judged, model, keep=("doc_id", "held_out"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
    )
    return sharding.shard(docs, shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lsh_forest.join(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.col("group_id").alias("class_id"), "n_links", F.col("class_id").alias("copy_id"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.assess(docs, keep=("doc_id",)).drop("char_distance", "word_distance", "judged_by")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"), keep=("doc_id",)).select(
        "doc_id",
        "n_sentences",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"), keep=("doc_id",))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "items").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.checksums(token_files.round_trip(_table(spark, sf_dir, "documents")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = materialise(prefix_trie.turns(_table(spark, sf_dir, "conversations")))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return prefix_trie.trie(*prefix_trie.with_shared_heads(own, 20, head))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_token_counts,
        op3_warc,
        op4_language_id,
        op5_sharding,
        op6_ngram_jaccard,
        op7_packing,
        op8_quality_rules,
        op9_license_scan,
        op10_decontamination,
        op11_hard_negatives,
        op12_token_files,
        op13_prefix_trie,
    )
}
