"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.llm import (
    chat_format, crf_language, decontaminate, fill_middle, packing, reshard, secrets, simhash, spelling, token_files, warc, wrapper,
)
from cloakframe.llm import quality_rules as rules
from cloakframe.llm.common import new_dir, stored
from cloakframe.llm.oracle import SQL
from cloakframe.sources.tables import load_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, directory: str) -> DataFrame:
    docs, items = (load_table(spark, directory, t) for t in ("documents", "benchmark"))
    judged = decontaminate.decontaminate(docs, items)
    listed = F.sha2(F.array_join("items", ","), 256)
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed.alias("items_sha256"),
        "contaminated",
    )


def op2_crf_language(spark: SparkSession, directory: str) -> DataFrame:
    docs = load_table(spark, directory, "documents").select("doc_id", "text", "lang")
    return crf_language.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op3_chat_format(spark: SparkSession, directory: str) -> DataFrame:
    """Formats every conversation, writes the result and derives all columns from what was written."""
    rows = load_table(spark, directory, "conversations").select("conv_id", "turn", "role", "text")
    odd = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], rows.schema)
    records = chat_format.rows_to_records(rows.unionByName(added))
    lost = F.raise_error(F.concat(F.lit("no turns in a record of conversation "), F.coalesce(F.col("conv").cast("string"), F.lit("null"))))
    turns = chat_format.canonical_turns(records).drop("record").withColumn("turns", F.coalesce("turns", lost.cast(chat_format.TURNS)))
    written = stored(chat_format.format_turns(turns).drop("turns"), "chat")

    said = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    blocks = written.withColumn("read", chat_format.read_turns(F.col("formatted"))).select(
        "conv",
        F.size("read").alias("n"),
        F.length("formatted").alias("chars"),
        F.struct(
            "block",
            F.array_join(said, "").alias("turns"),
            chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        ).alias("part"),
    )
    whole = blocks.groupBy("conv").agg(
        F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sort_array(F.collect_list("part")).alias("parts")
    )
    loss = F.array_join("parts.loss", "")
    return whole.select(
        F.col("conv").alias("conv_id"),
        F.col("n").alias("n_turns"),
        F.sha2(F.array_join("parts.turns", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )


def op4_token_files(spark: SparkSession, directory: str) -> DataFrame:
    import public_tokenizers  # only this query needs the vocabulary files

    docs = load_table(spark, directory, "documents")
    manifest = token_files.write_token_files(docs, new_dir(spark, "ids"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_token_files(manifest)


def op5_reshard(spark: SparkSession, directory: str) -> DataFrame:
    """From twelve shards by the text's checksum to sixteen of nearly equal bytes; all shards are written and read."""
    docs = load_table(spark, directory, "documents").select("doc_id", "text")
    checksum = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    plan = reshard.plan_reshard(docs, F.pmod(checksum, F.lit(12)), 16)
    written = reshard.rewrite(plan, new_dir(spark, "shards"), only_changed=False)
    return reshard.with_slots(written).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        checksum.alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_simhash(spark: SparkSession, directory: str) -> DataFrame:
    return simhash.near_duplicates(load_table(spark, directory, "documents"))


def op7_warc(spark: SparkSession, directory: str) -> DataFrame:
    manifest = warc.write_archives(load_table(spark, directory, "pages"), new_dir(spark, "warc"))
    return warc.read_archives(manifest).drop("url")


def op9_wrapper(spark: SparkSession, directory: str) -> DataFrame:
    found = wrapper.extract(load_table(spark, directory, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def word_length() -> Column:
    """The words of a text and one for its end."""
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1


def op10_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.best_fit(load_table(spark, directory, "documents"), word_length())


def op8_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    return rules.quality_rules(load_table(spark, directory, "documents")).drop("cleaned")


def op11_secret_crf(spark: SparkSession, directory: str) -> DataFrame:
    docs = load_table(spark, directory, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, secrets.learn(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op12_fill_middle(spark: SparkSession, directory: str) -> DataFrame:
    docs = load_table(spark, directory, "documents").select("doc_id", "text")
    restored = fill_middle.restore(F.col("output"), F.col("form"))
    return fill_middle.fill_in_middle(docs).select(
        "doc_id", F.col("units").alias("n"), "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


def op13_spelling(spark: SparkSession, directory: str) -> DataFrame:
    words = spelling.vocabulary(load_table(spark, directory, "documents").select("doc_id", "text"), drop_one_in=31)
    return spelling.spelling_variants(words)


QUERIES: dict[str, Query] = {
    "op10_packing": op10_packing,
    "op11_secret_crf": op11_secret_crf,
    "op12_fill_middle": op12_fill_middle,
    "op13_spelling": op13_spelling,
    "op1_decontaminate": op1_decontaminate,
    "op2_crf_language": op2_crf_language,
    "op3_chat_format": op3_chat_format,
    "op4_token_files": op4_token_files,
    "op5_reshard": op5_reshard,
    "op6_simhash": op6_simhash,
    "op7_warc": op7_warc,
    "op8_quality_rules": op8_quality_rules,
    "op9_wrapper": op9_wrapper,
}

ORACLE: dict[str, str] = dict(SQL)
