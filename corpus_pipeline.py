"""The corpus pipeline: from ``documents`` to token ids of a cleaned, de-duplicated, masked and mixed corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.mixing import mix_documents
from tidemark.llm.ngramjoin import keep_one
from tidemark.llm.pii import mask_pii
from tidemark.llm.quality import keep_good
from tidemark.llm.queries import PIECE_MODEL
from tidemark.llm.sentencepieces import encode
from tidemark.llm.store import cut, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts by plain rules and by their language's perplexity band."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near-duplicates the document with the smallest id."""
    return keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data, disguised or not, by its kind."""
    return mask_pii(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, mixed to the stated weights, each document at most once."""
    chosen = mix_documents(docs, fraction=0.9, max_epochs=1).select(*[F.col(c).alias(f"__{c}") for c in ("doc_id", "lang", "source")]).distinct()
    # An id may be null, or stand in several leaves of which one is chosen; null labels are mixed as "".
    leaf = [F.coalesce(c, F.lit("")) == F.col(f"__{c}") for c in ("lang", "source")]
    return docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & leaf[0] & leaf[1], "left_semi").select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    return encode(docs, PIECE_MODEL)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", mask_personal_data),
    ("mixing", mix_to_weights),
    ("encoding", encode_pieces),
]

#: Perplexity bands, disguised identifiers and the Viterbi search are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows materialised before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else cut(docs), sf_dir)
    return docs
