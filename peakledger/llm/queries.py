"""The registered queries of this subpackage: each applies one operator to its whole table and derives the columns asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import conversations, decontaminate, htmltext, jaccard, langid, packing, pii, quality, secrets, simhash, urlfilter, warc, whitening
from .common import table

#: Rules (verdict, host, path).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = packing.cuts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return packing.place(cuts.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    filters = langid.learn(docs.where(~F.coalesce(held_out, F.lit(False))))
    return langid.predict(docs.withColumn("held_out", F.coalesce(held_out, F.lit(False))), filters, keep=["doc_id", "held_out"])


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.learn(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def _counted(kinds: list[str]) -> list[Column]:
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return [count(k) for k in kinds]


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _span_columns(found: DataFrame, base: list[str]) -> DataFrame:
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *_counted(base), F.sha2(_listed(own), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_columns(pii.find(table(spark, sf_dir, "documents")), ["email", "ip", "card", "phone"])


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = secrets.find(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return _span_columns(found, ["assign", "access", "hex"])


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.rule_table(spark, URL_RULES))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.sort_array("items")
    return found.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "contaminated")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


def op12_jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_pack_sequences, op2_simhash_groups, op3_language, op4_quality, op5_main_text, op6_personal_data, op7_warc,
                                   op8_secrets, op9_url_rules, op10_decontaminate, op11_conversations, op12_jaccard_classes, op13_whitening)}
