"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from moneyflow.llm.common import fold_of, table


def op1_token_store(spark: SparkSession, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    import public_tokenizers

    from moneyflow.llm.token_store import stored_tokens

    return stored_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(tokenizer), end_id=1)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from moneyflow.llm.simhash import near_duplicates

    out = near_duplicates(table(spark, sf_dir, "documents"), words=4, budget=4)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    from moneyflow.llm.interleave import interleave

    out = interleave(table(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from moneyflow.llm.line_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_pieces(spark: SparkSession, sf_dir: str, model: str = "piece_bpe_32k.model") -> DataFrame:
    import public_tokenizers

    from moneyflow.llm import pieces

    return pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(model), described=True)


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from moneyflow.llm.decontam import contaminations

    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from moneyflow.llm import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.learning_rows())
    out = toxicity.score(docs, model)
    held_out = fold_of(F.col("doc_id"), 5) == 0
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from moneyflow.llm import langid

    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, fold_of(F.col("doc_id"), 3) != 1)
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from moneyflow.llm.media import stored_payloads

    return stored_payloads(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from moneyflow.llm import quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), quality.learning_rows())
    out = quality.score(docs, model)
    held_out = fold_of(F.col("doc_id"), 3) == 1
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_store": op1_token_store,
    "op2_simhash": op2_simhash,
    "op3_interleave": op3_interleave,
    "op4_line_dedup": op4_line_dedup,
    "op5_pieces": op5_pieces,
    "op6_decontam": op6_decontam,
    "op7_toxicity": op7_toxicity,
    "op8_langid": op8_langid,
    "op9_media": op9_media,
    "op10_quality": op10_quality,
}

SQL: dict[str, str] = {}
