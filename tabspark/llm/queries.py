"""Registered queries of the corpus operators: ``opN_<name>(spark, sf_dir)``, and DuckDB SQL where SQL can
express the result. Each query applies its operator with production parameters to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm import (
    bpe,
    decontam,
    embed_dedup,
    html_text,
    langid,
    lexical_search,
    near_dedup,
    pii,
    quality,
    spelling,
    token_counts,
    toxicity,
    warc,
)
from tabspark.llm.common import fold_of, table, written
from tabspark.session import scratch_path


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every document, as digests."""
    return bpe.encode(table(spark, sf_dir, "documents"), ids=False, digests=True)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; fold 0 of 5 is held out."""
    documents, fold = table(spark, sf_dir, "documents"), fold_of(F.col("doc_id"), 5)
    scorer = toxicity.train(documents, table(spark, sf_dir, "labels"), fold != 0)
    return toxicity.score(documents, scorer).select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


def op3_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and tokens by source, language and tokenizer version after four commits: all documents are
    inserted; those labelled toxic are revised to the counts without their digits; those of quality 0 are
    deleted; the revision is sent again and changes nothing."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    plain = token_counts.counted(documents)
    # written before the join with labels: Spark pushes a semi join below the counting and would shuffle the texts
    bare = written(token_counts.counted(documents.withColumn("text", F.regexp_replace("text", "[0-9]+", ""))), "bare")
    rollup = token_counts.Rollup(spark, scratch_path(spark, f"rollup-{uuid.uuid4().hex}"))
    change = lambda df, op, seq: df.withColumns({"op": F.lit(op), "seq": F.lit(seq)})
    rollup.commit("load", change(plain, "insert", 1))
    named = lambda rule: labels.where(rule).select("doc_id").distinct()
    revised = written(change(bare.join(named("toxic = 1"), "doc_id", "left_semi"), "revise", 2), "revised")
    rollup.commit("revise", revised)
    gone = change(named("quality = 0").withColumn("version", F.explode(F.array(*map(F.lit, token_counts.PATTERNS)))), "delete", 3)
    rollup.commit("remove", gone.withColumns({c: F.lit(None).cast(t) for c, t in (("source", "string"), ("lang", "string"), ("n_tokens", "long"))}))
    rollup.commit("revise", revised)
    return rollup.totals()


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, read back and merged into capture histories. Pages have no time of
    their own: a page is captured as many seconds after a fixed time as its id says."""
    captured = F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0)))
    return warc.histories(table(spark, sf_dir, "pages"), captured).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "merge_part", "merge_row")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; fold 2 of 4 is held out."""
    documents, fold = table(spark, sf_dir, "documents"), fold_of(F.col("doc_id"), 4)
    network = langid.train(documents, fold != 2)
    return langid.predict(documents, network).select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts of the base kinds, the hash of their places, all spans."""
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict of the line field for every document."""
    documents = table(spark, sf_dir, "documents")
    return quality.assess(documents, quality.train(documents, table(spark, sf_dir, "labels"))).drop("line_labels")


def op9_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document: shingles of four words, similarity 0.8 or more."""
    return near_dedup.groups(table(spark, sf_dir, "documents"), words=4)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they hold, with the best window's similarity and place."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words and forms of every word of six letters and five occurrences. One run in 199, by hash,
    loses a letter first, so that the texts hold misspelt words."""
    found = spelling.occurrences(table(spark, sf_dir, "documents"), damage=199)
    return spelling.variants(spelling.vocabulary(found))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every vector: cosine 0.93 or more within a label."""
    return embed_dedup.groups(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_token_rollup": op3_token_rollup,
    "op4_warc_index": op4_warc_index,
    "op5_main_text": op5_main_text,
    "op6_language_id": op6_language_id,
    "op7_pii": op7_pii,
    "op8_line_crf": op8_line_crf,
    "op9_super_minhash": op9_super_minhash,
    "op10_decontamination": op10_decontamination,
    "op11_lexical_search": op11_lexical_search,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_dedup": op13_embedding_dedup,
}

ORACLE: dict[str, str] = {
    "op3_token_rollup": r"""
        WITH kept AS (
            SELECT d.source, d.lang,
                   CASE WHEN l.toxic = 1 THEN regexp_replace(coalesce(d.text, ''), '[0-9]+', '', 'g') ELSE coalesce(d.text, '') END AS body
            FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
            WHERE coalesce(l.quality, 1) <> 0),
        counted AS (
            SELECT source, lang, 'words.v1' AS version, len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) AS n FROM kept
            UNION ALL
            SELECT source, lang, 'pieces.v1', len(regexp_extract_all(body, '[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]')) FROM kept)
        SELECT source, lang, version, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens
        FROM counted GROUP BY ALL""",
    "op11_lexical_search": r"""
        WITH cut AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
            FROM documents),
        totals AS (SELECT count(*) FILTER (WHERE len(words) > 0) AS docs, sum(len(words)) AS in_all FROM cut),
        tf AS (SELECT r, doc_id, len(words) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, words, unnest(words) AS term FROM cut) GROUP BY ALL),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        scores AS (
            SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // in_all)))) AS BIGINT) AS score
            FROM asked JOIN tf USING (term) JOIN weights USING (term), totals GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
        FROM scores WHERE score > 0 QUALIFY rank <= 10""",
    "op13_embedding_dedup": r"""
        WITH RECURSIVE able AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b
            ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.93),
        reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a AS vec_id, min(b) AS low FROM reach GROUP BY a),
        degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(low, e.vec_id)) AS component_id,
               e.vec_id <= coalesce(low, e.vec_id) AS kept
        FROM embeddings e LEFT JOIN least USING (vec_id) LEFT JOIN degree USING (vec_id)""",
}
