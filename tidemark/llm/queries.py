"""The ``op<N>_<name>`` queries and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.store import table

#: Where public vocabulary files lie; read on the driver only.
TOKENIZERS = "/opt/tokenizers"
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents chosen, with their copies, for three fifths of all tokens mixed to the stated weights."""
    from tidemark.llm.mixing import mix_documents

    return mix_documents(table(spark, sf_dir, "documents"), fraction=0.6, max_epochs=2)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece tokens of every document."""
    from tidemark.llm.wordpiece import token_counts

    return token_counts(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components and numbers of links of all documents by 5-word shingles."""
    from tidemark.llm.ngramjoin import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), count_links=True)


def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's log probability by prediction by partial matching, beside an add-one unigram model's."""
    from tidemark.llm.ppm import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives with revisits resolved, and read back."""
    from tidemark.llm.store import fresh_path
    from tidemark.llm.warc import read_archive, restore, write_archive

    path = fresh_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return restore(read_archive(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain statistics and the verdict of rules and perplexity bands."""
    from tidemark.llm.quality import judge

    out = judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", *(F.col(f"q_{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ppl")))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain and disguised personal data."""
    from tidemark.llm.pii import find_pii

    return find_pii(table(spark, sf_dir, "documents")).drop("base_spans")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by family first."""
    from tidemark.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth one."""
    from tidemark.llm.annpartition import search

    return search(table(spark, sf_dir, "embeddings"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document as count and digest, and whether they decode to it."""
    from tidemark.llm.sentencepieces import encode

    return encode(table(spark, sf_dir, "documents"), PIECE_MODEL).drop("ids")


QUERIES = {"op1_mixing": op1_mixing, "op2_token_counts": op2_token_counts, "op3_ngram_join": op3_ngram_join, "op4_ppm": op4_ppm, "op5_warc": op5_warc, "op6_quality": op6_quality, "op7_pii": op7_pii, "op8_langid": op8_langid, "op9_ann": op9_ann, "op10_sentencepiece": op10_sentencepiece}

def _split_sql(source: str, parent: str, name: str) -> str:
    """The DuckDB form of one level's split."""
    part = f"PARTITION BY {parent}" if parent else ""
    return f"""
        SELECT *, CASE WHEN fits THEN cap ELSE (budget - sum(CASE WHEN fits THEN cap ELSE 0 END) OVER ({part})) / sum(CASE WHEN fits THEN 0 ELSE weight END) OVER ({part}) * weight END AS share
        FROM (SELECT *, coalesce(sum(cap) OVER ({part} ORDER BY cap / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                     + cap / weight * (sum(weight) OVER ({part}) - coalesce(sum(weight) OVER ({part} ORDER BY cap / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) <= budget AS fits
              FROM ({source}))"""


_MIXING_SQL = f"""
    WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, try_cast(regexp_extract(source, '([0-9]+)$', 1) AS int) AS number,
                      len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents),
    docs AS (SELECT doc_id, CASE WHEN number < 8 THEN 'web' WHEN number < 14 THEN 'books' WHEN number IS NOT NULL THEN 'forums' ELSE 'other' END AS domain, lang, source, n_tokens FROM d),
    leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::DOUBLE * 2 AS cap, 1.0::DOUBLE AS weight FROM docs GROUP BY ALL),
    langs AS (SELECT domain, lang, sum(cap) AS cap, (CASE WHEN domain = 'other' THEN 1 WHEN lang = 'en' THEN 4 WHEN lang IN ('de', 'fr', 'es') THEN 2 ELSE 1 END)::DOUBLE AS weight FROM leaves GROUP BY ALL),
    domains AS (SELECT domain, sum(cap) AS cap, (CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'forums' THEN 2 ELSE 1 END)::DOUBLE AS weight FROM langs GROUP BY ALL),
    a AS ({_split_sql("SELECT *, (SELECT floor(sum(n_tokens) * 0.6::DOUBLE) FROM docs) AS budget FROM domains", "", "domain")}),
    b AS ({_split_sql("SELECT langs.*, a.share AS budget FROM langs JOIN a USING (domain)", "domain", "lang")}),
    c AS ({_split_sql("SELECT leaves.*, b.share AS budget FROM leaves JOIN b USING (domain, lang)", "domain, lang", "source")}),
    r AS (SELECT domain, lang, source, floor(share + 1e-6)::BIGINT // tokens AS passes, floor(share + 1e-6)::BIGINT % tokens AS rest FROM c WHERE tokens > 0),
    o AS (SELECT docs.*, passes, rest, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('17:' || passes || ':' || doc_id), doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM docs JOIN r USING (domain, lang, source))
    SELECT doc_id, domain, lang, source, n_tokens, passes + (upto <= rest)::BIGINT AS copies FROM o WHERE passes + (upto <= rest)::BIGINT > 0"""

ORACLE_SQL: dict[str, str] = {
    "op1_mixing": _MIXING_SQL,
    "op3_ngram_join": """
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
        g AS (SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS gram FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS i FROM w)),
        n AS (SELECT doc_id, count(*) AS size FROM g GROUP BY doc_id),
        o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
        link AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * shared >= 80 * (p.size + q.size - shared)),
        reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
        SELECT w.doc_id, coalesce(size, 0) AS n_shingles, least(w.doc_id, coalesce(low, w.doc_id)) AS component_id, coalesce(n_links, 0) AS n_links
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) USING (doc_id)
             LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM link GROUP BY a) USING (doc_id)""",
    "op5_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS winner FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> winner THEN winner END AS refers_to
        FROM w""",
}
