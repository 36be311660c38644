"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, oracles
from .bpe import encode_bytes
from .chat import format_chat, loss_text, read_chat
from .chunks import find_repeats
from .common import stage, table
from .decontaminate import find_leaks
from .fingerprint import as_text, fingerprint_edits, likeness
from .neardup import near_duplicates
from .pieces import PieceModel, encode_pieces
from .ranking import rank_documents
from .secrets import BASE_KINDS, scan_secrets
from .trie import conversation_trie
from .unigram import count_tokens, zipf_scores
from .warc import read_archives, write_archives

PIECE_MODEL = "piece_bpe_32k.model"
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def tokenizer_path(name: str = PIECE_MODEL) -> str:
    """Place of a public vocabulary file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_repeats(table(spark, sf_dir, "documents"), within=True)

    def total(spans: str) -> F.Column:
        return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])

    def listed(spans: str) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        F.size("repeats").cast("long").alias("n_repeats"),
        total("repeats").alias("repeat_bytes"),
        total("removable").alias("removable_bytes"),
        listed("repeats").alias("repeats"),
        listed("removable").alias("removable"),
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def joined(spans) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id", *(count(k) for k in BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_pieces(table(spark, sf_dir, "documents"), tokenizer_path())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = zipf_scores(PieceModel.load(tokenizer_path()))
    return count_tokens(table(spark, sf_dir, "documents"), scores, PIECE_MODEL)


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fingerprint_edits(table(spark, sf_dir, "documents"))
    return docs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    chats = format_chat(turns.unionByName(extra)).withColumn("back", read_chat(F.col("formatted")))
    chats = chats.withColumn("loss_text", loss_text(F.col("segments")))
    listing = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(listing, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("valid"),
    )


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # a null id has no checksum: its row is not held out
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    net = langid.fit(docs.where(~held_out))
    return langid.predict(docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = stage(write_archives(table(spark, sf_dir, "pages")), "warc")
    return read_archives(bundles, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_bytes(table(spark, sf_dir, "documents"), tokenizer_path(RANK_FILE))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_secret_scan,
        op3_sentencepiece,
        op4_token_counts,
        op5_fingerprint,
        op6_decontaminate,
        op7_chat_format,
        op8_ngram_join,
        op9_language_id,
        op10_warc,
        op11_ranked_search,
        op12_byte_bpe,
        op13_conversation_trie,
    )
}
LLM_ORACLES: dict[str, str] = {
    "op5_fingerprint": oracles.OP5,
    "op7_chat_format": oracles.OP7,
    "op8_ngram_join": oracles.OP8,
    "op10_warc": oracles.OP10,
    "op11_ranked_search": oracles.OP11,
    "op13_conversation_trie": oracles.OP13,
}
