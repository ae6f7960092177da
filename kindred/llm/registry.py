"""The operators as queries over the test tables, and SQL where SQL can express one."""

import os
import pathlib

import public_tokenizers

from kindred.llm.bytebpe import digests, read_ranks, read_tokenizer, round_trip, tokenizer_from_ranks
from kindred.llm import alignment, lines, prefixes, rollup, substrings, topk
from kindred.llm.curves import nearest
from kindred.llm.kneser_ney import language_model_scores
from kindred.llm.packing import pack
from kindred.llm.ppm import language_id
from kindred.llm.probminhash import near_duplicates
from kindred.llm.toxicity import toxicity
from kindred.storage import scratch_path

_ROOT = str(pathlib.Path(__file__).resolve().parents[2])


def reachable(spark):
    """Let the Python workers that Spark starts from now on import this package."""
    environment = spark.sparkContext.environment
    held = environment.get("PYTHONPATH", "")
    if _ROOT not in held.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (_ROOT, held) if p)


def table(spark, folder, name):
    """A test table."""
    reachable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark, folder):
    return substrings.digests(substrings.drop_repeats(table(spark, folder, "documents")))


def op2_packing(spark, folder):
    return pack(table(spark, folder, "documents"), read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")))


def op3_nearest(spark, folder):
    return nearest(table(spark, folder, "embeddings"))


def op4_byte_bpe(spark, folder):
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return digests(round_trip(table(spark, folder, "documents"), tokenizer_from_ranks(ranks, public_tokenizers.PATTERN)))


def op5_kneser_ney(spark, folder):
    return language_model_scores(table(spark, folder, "documents"))


def op6_near_duplicates(spark, folder):
    return near_duplicates(table(spark, folder, "documents"), weight="count")


def op7_exact_top_k(spark, folder):
    return topk.exact_top_k(table(spark, folder, "embeddings"))


def op8_language_id(spark, folder):
    return language_id(table(spark, folder, "documents"))


def op9_token_counts(spark, folder):
    withdrawn = table(spark, folder, "labels").where("quality = 0")
    return rollup.maintained(table(spark, folder, "documents"), withdrawn, scratch_path(spark, "rollup"))


def op10_toxicity(spark, folder):
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_prefix_trie(spark, folder):
    return prefixes.rebuilt_trie(table(spark, folder, "conversations"))


def op12_cross_tokenizer(spark, folder):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as model:
        pieces = model.read()
    tokenizer = read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    return alignment.align(table(spark, folder, "documents"), tokenizer, pieces)[0]


def op13_line_dedup(spark, folder):
    return lines.digests(lines.kept_texts(lines.keep_bitmaps(table(spark, folder, "documents"), ("doc_id", "text"))))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_packing": op2_packing,
    "op3_nearest": op3_nearest,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_kneser_ney": op5_kneser_ney,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_language_id": op8_language_id,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_cross_tokenizer": op12_cross_tokenizer,
    "op13_line_dedup": op13_line_dedup,
}

ORACLE_SQL = {
    "op7_exact_top_k": topk.SQL,
    "op9_token_counts": rollup.SQL,
    "op11_prefix_trie": prefixes.SQL,
    "op13_line_dedup": lines.SQL,
}
