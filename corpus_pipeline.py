"""From documents to training sequences: five stages, each written and reread.

Each stage works on all that the one before it kept. All but the last return the columns
of documents.
"""

import public_tokenizers
from pyspark.sql import functions as F

from kindred.llm import probminhash
from kindred.llm.bytebpe import read_tokenizer
from kindred.llm.packing import pack
from kindred.llm.ppm import UNDECIDED, language_id
from kindred.llm.registry import table
from kindred.llm.substrings import drop_repeats
from kindred.llm.toxicity import toxicity
from kindred.storage import materialize

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark, docs, sf_dir):
    """Rows that are not predicted toxic.

    Each row is judged by its own text, so repeated rows go or stay together, whatever
    their id, null included. A null or empty text gets the score of a text without words. An
    empty table gives no rows.
    """
    judged = toxicity(docs, table(spark, sf_dir, "labels"), keep=DOCUMENT_COLUMNS)
    return judged.where("predicted = 0").select(*DOCUMENT_COLUMNS)


def keep_identified(spark, docs, sf_dir):
    """Rows whose language can be told; `lang` becomes the predicted language.

    Texts without a letter go, null and empty ones among them; repeated rows and null ids
    are judged by their texts like others. An empty table gives no rows.
    """
    judged = language_id(docs, keep=DOCUMENT_COLUMNS).where(F.col("lang_pred") != UNDECIDED)
    return judged.withColumn("lang", F.col("lang_pred")).select(*DOCUMENT_COLUMNS)


def drop_near_duplicates(spark, docs, sf_dir):
    """Of each group of near copies the row with the smallest id; rows go only if their own text is linked.

    Rows without an id and texts without words (null, empty, blanks) stay; of equal rows
    one stays. An empty table gives no rows.
    """
    return probminhash.drop_near_duplicates(docs, DOCUMENT_COLUMNS)


def drop_repeated_passages(spark, docs, sf_dir):
    """Documents without the passages that are in an earlier one; texts without such stay as they are."""
    judged = drop_repeats(docs, keep=DOCUMENT_COLUMNS)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return judged.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of the documents in sequences of 2048 tokens.

    Every row is a document of its own, also with a repeated or null id; a null or empty
    text is one token, the end. An empty table gives no rows.
    """
    return pack(docs, read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_identified),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", drop_repeated_passages),
    ("packing", pack_sequences),
]

# Trained models and near copies have no SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order over the whole table, each result written before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
