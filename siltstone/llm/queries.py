"""The registered queries of this subpackage: each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import chat, codes, decontaminate, language, lines, middles, mixing, near, neighbours, quality, shards, suffixes, tokens
from siltstone.llm.common import read, save

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_shards(spark, sf):
    rows = shards.shard_documents(read(spark, sf, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op2_language(spark, sf):
    docs = read(spark, sf, "documents")
    told = language.identify(docs, language.learn(language.training_rows(docs)))
    return told.select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


@query
def op3_decontaminate(spark, sf):
    told = decontaminate.contaminated(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    return told.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op4_near_duplicates(spark, sf):
    """(doc_id, class_id, kept, n_words): class_id is the least doc_id of a group of near copies."""
    return near.near_duplicates(read(spark, sf, "documents")).select("doc_id", "class_id", "kept", "n_words")


@query
def op5_lines(spark, sf):
    """(doc_id, n_lines, n_removed, removed): lines that repeat an earlier one, by their number."""
    told = lines.repeated_lines(read(spark, sf, "documents"))
    return told.select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"))


@query
def op6_quality(spark, sf):
    return quality.quality(read(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_lines_kept", "chars_kept")


@query
def op7_tokens(spark, sf):
    """(doc_id, n_tokens): documents as flat token files, counted by their separators alone."""
    files = save(tokens.token_files(read(spark, sf, "documents")), "token-files")
    counted = tokens.count_tokens(files.filter("data is not null"))
    order = files.filter("ordinal is not null").select("file", "ordinal", "doc_id")
    return order.join(counted, ["file", "ordinal"], "left").select("doc_id", "n_tokens")


@query
def op8_mixture(spark, sf):
    return mixing.mix(read(spark, sf, "documents")).select(
        "doc_id", "source", "lang", "topic", "tokens", "rate", "taken")


@query
def op9_chats(spark, sf):
    """Digests of the conversations as read back from their formatted text."""
    turns = read(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    planted = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], turns.schema)
    told = chat.format_chats(turns.unionByName(extra))
    told = told.select(
        "conv_id", "valid", chat.formatted().alias("formatted"), chat.learned_text().alias("learned"))
    told = told.withColumn("back", chat.parse_chat(F.col("formatted")))
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


@query
def op10_repeats(spark, sf):
    return suffixes.remove_repeats(read(spark, sf, "documents"))


@query
def op11_codes(spark, sf):
    """Four bytes per vector, and the digest of the codebooks they refer to."""
    coded, books = codes.compress(read(spark, sf, "embeddings"))
    return codes.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest() if books else None).alias("codebooks_sha256"))


@query
def op12_neighbours(spark, sf):
    """The nearest rows of every twentieth id."""
    return neighbours.nearest(read(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op13_middles(spark, sf):
    """Digests of the fill-in-middle texts and of what is rebuilt from them."""
    told = middles.fill_in_middle(read(spark, sf, "documents"))
    return told.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middles.restored(), 256).alias("restored_sha256"))
