"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith.llm._tokens import tokenizer_path
from loadsmith.llm.oracle import ORACLE_SQL  # noqa: F401

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(column, folds: int):
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(folds))


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.token_files import read_token_files, write_token_files
    from loadsmith.scratch import scratch_path

    path = write_token_files(_table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"),
                             tokenizer_path(WORD_TOKENIZER), end_id=2)
    return read_token_files(spark, path).select(F.col("doc").alias("doc_id"), "start", "n_tokens",
                                                F.crc32("ids").alias("ids_crc32"))


def op2_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.compression_quality import fit_quality, score_quality

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, _table(spark, sf_dir, "labels"), learn=_fold(F.col("id"), 3) != 1)
    return score_quality(docs, model).select(
        "doc_id", F.coalesce(_fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.sentence_pieces import decode_pieces, encode_pieces

    model = tokenizer_path(PIECE_MODEL)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decode_pieces(encode_pieces(docs, model), model)
    return both.select("doc_id", (F.octet_length("piece_ids") / 4).cast("long").alias("n_ids"),
                       F.crc32("piece_ids").alias("ids_crc32"), F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.language_id import fit_languages, predict_languages

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_languages(docs, learn=_fold(F.col("id"), 5) != 0)
    return predict_languages(docs, model).select(
        "doc_id", F.coalesce(_fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.packing import pack

    pieces = pack(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.line_rules import judged

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return judged(docs)[0].select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                  "base_failed", "kept", "left_words", "removed_lines")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.line_dedup import dedup_lines

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs, removed_col="removed_chunks")
    return out.select("doc_id", "removed_chunks", F.octet_length("text").cast("long").alias("kept_bytes"),
                      F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.simhash_dedup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text")) \
        .select("doc_id", "fingerprint", "component_id")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


# The rules that the query judges by.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.url_filters import judge_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), F.col("url_rule").alias("rule"),
        F.col("url_verdict").alias("verdict"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.conversation_trie import ordered_turns, prefix_trie, rebuilt

    turns = ordered_turns(_table(spark, sf_dir, "conversations"))
    conv = F.col("conv")
    turns, convs = rebuilt(turns, heads=_fold(conv, 6), base=conv - F.pmod(conv, F.lit(100)), most=5)
    return prefix_trie(turns, convs).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                            "saved_tokens", "ends_sha256")


def op12_grouped_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.grouped_packing import pack_best_fit

    pieces = pack_best_fit(_table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER), end_id=1, with_ids=False)
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.filter_audit import audit

    return audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_compression_quality": op2_compression_quality,
    "op3_line_rules": op3_line_rules,
    "op4_sentence_pieces": op4_sentence_pieces,
    "op5_line_dedup": op5_line_dedup,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_top_k": op7_top_k,
    "op8_url_filters": op8_url_filters,
    "op9_language_id": op9_language_id,
    "op10_packing": op10_packing,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_grouped_packing": op12_grouped_packing,
    "op13_filter_audit": op13_filter_audit,
}
