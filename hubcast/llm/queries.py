"""The registered queries of the text operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubcast.llm import (bpe, chat_format, conversation_trie, decontamination, exact_dedup, language_id, mixing, ngram_join, quality_rules,
                         spelling, substring_dedup, token_shards, url_filter)
from hubcast.llm.common import lower_ascii, table
from hubcast.llm.oracle import SQL

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS, END_MARK = public_tokenizers.path("byte_bpe_50k.tiktoken"), 50256

# Rules of the URL query (host/path, verdict) and names of hosts known to be unwanted, its training labels.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
BLOCKED_NAMES = ["spam-farm", "cheap-pills", "casino-win", "adult-x", "free-bets", "ads-track"]

# Conversation -7 of the chat query: texts full of control strings.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict for every document."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for its text, by a fresh digest index."""
    index = exact_dedup.fresh_index(spark)
    out = exact_dedup.decide(table(spark, sf_dir, "documents"), index)
    index.drop()  # decisions are checkpointed; an index that is to last gets a name and a path
    return out


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 20 words or more that occur earlier."""
    return substring_dedup.strip(table(spark, sf_dir, "documents"), length=20, with_text=False)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned where crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = language_id.fit(docs.filter(~held))
    return (language_id.predict(docs, model)
            .select("doc_id", held.alias("held_out"), "lang_pred", "score"))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as sequences of 2048 ids in training order, 4096 sequences a shard."""
    packed = token_shards.pack(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, END_MARK)
    return token_shards.training_order(packed)


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose sets of 4-word shingles overlap by 85 %."""
    return ngram_join.classes(table(spark, sf_dir, "documents"), n=4, percent=85)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 3, 1, 2 with 150 % of all words and at most two epochs."""
    plan = mixing.repetitions(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_epochs=2.0)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict for every page."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, BLOCKED_NAMES)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and what reading the output back gives."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = turns.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    done = chat_format.conversations(chat_format.messages_of(turns.unionByName(extra)))
    back = F.transform(chat_format.read_back(F.col("formatted")),
                       lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    read = done.select("conv_id", F.size(back).cast("long").alias("n_turns"),
                       F.array_join(back, "").alias("turns"), "formatted",
                       chat_format.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return read.select("conv_id", "n_turns", sha(F.col("turns")).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of five letters or more that occurs three times or more, with its near words, form and root.

    One run in 97, chosen by a hash of document and run, loses a letter first.
    """
    letters = F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z\x{C0}-\x{FF}]+"), F.lit(0))).alias("run")
    runs = table(spark, sf_dir, "documents").select("doc_id", letters).filter(F.length("run") >= 5).select(
        "doc_id", lower_ascii(F.col("run")).alias("run"))
    told = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    runs = runs.select("run", F.crc32(told.cast("binary")).alias("h")).withColumn("at", (F.col("h") % F.length("run")).cast("int"))
    lost = F.concat(F.substring("run", F.lit(1), F.col("at")), F.substring("run", F.col("at") + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % 97 == 0, lost).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= 5)
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3")
    return spelling.variants(counted).select("word", "form", "root", "n", "n_near", "form_n")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each begun by up to five turns of the first of its hundred."""
    c = F.col("conv_id")
    taken = (F.crc32(c.cast("string").cast("binary")) % 6).cast("int")
    rows = conversation_trie.with_heads(conversation_trie.turns_of(table(spark, sf_dir, "conversations")), c - c % 100, taken, most=5)
    return conversation_trie.trie(rows)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that stand in a passage of 10 words of a benchmark item."""
    docs = table(spark, sf_dir, "documents")
    index = decontamination.PositionalIndex.fresh(spark).add(docs)
    out = decontamination.flag(docs, table(spark, sf_dir, "benchmark"), index, length=10)
    index.drop()  # its matches are checkpointed; an index that is to last gets a path
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_exact_dedup, op3_substring_dedup, op4_language_id, op5_bpe_codec, op6_token_shards, op7_ngram_jaccard, op8_mix_sources,
                            op9_url_filter, op10_chat_format, op11_spelling_variants, op12_conversation_trie, op13_decontaminate)}

ORACLE_SQL = {k: v for k, v in SQL.items() if k in QUERIES}
