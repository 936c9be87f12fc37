"""One query per operator, over whole tables and with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm.chat import canonical_turns, conversation_records, read_loss, read_turns, render
from tickloom.llm.collocations import collocations
from tickloom.llm.conversation_trie import conversation_sequences, prefix_nodes
from tickloom.llm.decontaminate import contamination
from tickloom.llm.fingerprint import as_text, containment, distinct_shingles, edited_neighbours
from tickloom.llm.language import fit_language, predict_language
from tickloom.llm.licence_scan import scan_licences
from tickloom.llm.line_dedup import drop_repeated_lines
from tickloom.llm.near_dedup import near_duplicates
from tickloom.llm.pieces import encode_pieces, token_numbers
from tickloom.llm.quality_votes import fit_votes, score_quality
from tickloom.llm.secret_scan import scan_secrets, span_count, span_text
from tickloom.llm.sharding import shards
from tickloom.llm.tables import hex_digest, read, stored


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_neighbours(read(spark, folder, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("fingerprint").alias("fingerprint"),
        as_text("edited_fingerprint").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        distinct_shingles("fingerprint").alias("n_shingles"),
        containment("edited_fingerprint", "fingerprint").alias("edited_contained"),
    )


def op2_licences(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_licences(read(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.array_join("licences", ",").alias("licences"),
        F.array_join(F.transform(F.coalesce("sentences", F.array().cast("array<struct<place:int,sentence:string>>")), lambda s: F.concat_ws(":", s["place"], s["sentence"])), ",").alias("sentences"),
    )


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(read(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[span_count("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(span_text("base"), 256).alias("base_sha256"),
        span_text("spans").alias("spans"),
    )


def piece_vocabulary() -> str:
    """Where the public vocabulary file is installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = near_duplicates(read(spark, folder, "documents"), words=3, similarity=85)
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from three folds of four, told by the id, and predicts all."""
    docs = read(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = fit_language(docs.where(~held_out & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang"))
    predicted = predict_language(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_pieces(spark: SparkSession, folder: str, vocabulary: str | None = None) -> DataFrame:
    rows = encode_pieces(read(spark, folder, "documents"), vocabulary or piece_vocabulary())
    return rows.select(
        "doc_id",
        token_numbers().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        hex_digest("decoded").alias("decoded_sha256"),
    )


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text after line dedup, as a digest."""
    rows = drop_repeated_lines(read(spark, folder, "documents"), drop_empty=False)
    return rows.select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.size(F.split("text", "\n", -1)).cast("bigint").alias("n_lines"),
        F.sha2("text", 256).alias("text_sha256"),
        F.col("text").rlike(r"[^ \t\r\n]").alias("has_text"),
    )


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    rows = contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        hex_digest(F.array_join("items", ",")).alias("items_sha256"),
        "contaminated",
    )


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op9_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards(read(spark, folder, "documents"))
    return placed.select("doc_id", "bytes", F.col("prefix").alias("shard"), "depth", "oversized")


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one, numbered -1, whose texts are control strings of other templates;
    the columns are read back from the output."""
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    speaker = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    more = spark.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"), speaker.alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    rows = rows.unionByName(more)
    # The table's roles are canonical already and are kept as they are.
    turns = canonical_turns(conversation_records(rows), "record", names={})
    out = render(turns).select("conv_id", "layout", "formatted", "loss")
    out = out.withColumns({"turns": read_turns("formatted"), "learned": F.array_join(read_loss("formatted", "loss"), "")})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        "layout",
    )


GROUP, HEADS = 5, 9


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Trie of conversations rebuilt so that they share beginnings: each takes its first turns, up to
    eight of them, from the conversation whose number is the next lower multiple of five."""
    own = stored(conversation_sequences(read(spark, folder, "conversations")), "turns")
    head = F.crc32(F.col("id").cast("string")) % HEADS
    own = own.withColumns({"h": head.cast("int"), "donor": F.col("id") - F.col("id") % GROUP})
    heads = own.where("id = donor").select("donor", F.slice("turns", 1, HEADS - 1).alias("given"))
    none = F.array().cast(own.schema["turns"].dataType)
    rebuilt = F.concat(F.slice(F.coalesce("given", none), F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns")))
    return prefix_nodes(own.join(heads, "donor", "left").select("id", rebuilt.alias("turns")))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(read(spark, folder, "documents"))


QUALITY_THRESHOLD = 0.3


def op13_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Learns labels from four folds of five, told by the id, and scores all."""
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = fit_votes(docs.select("doc_id", "text"), labels.where(fold != 0).select("doc_id", "quality"))
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_licences": op2_licences,
    "op3_secrets": op3_secrets,
    "op4_near_dedup": op4_near_dedup,
    "op5_language_id": op5_language_id,
    "op6_pieces": op6_pieces,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_shards": op9_shards,
    "op10_chat_format": op10_chat_format,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_collocations": op12_collocations,
    "op13_quality": op13_quality,
}
