"""Named queries of the training-data operators, and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.llm import markup, mixture, neardup, relevance, repetition, splitting, tokens, unify
from folioscan.llm.batches import one_per_id
from folioscan.session import materialize, table


def p1_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.corpus_budget(table(spark, sf_dir, "documents"), table(spark, sf_dir, "chunks"), table(spark, sf_dir, "document_index"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_pairs(table(spark, sf_dir, "chunks"))


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(table(spark, sf_dir, "chunks"), bag=True)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the wrappers of hosts; every row of a chunk is read."""
    texts = _with_hosts(spark, sf_dir, table(spark, sf_dir, "chunks"))
    return markup.found_by_wrappers(texts, markup.host_wrappers(texts))


def _with_hosts(spark: SparkSession, sf_dir: str, chunks: DataFrame) -> DataFrame:
    """(chunk_id, host, text). A host is the folder that a document's Markdown was parsed into, by its latest state."""
    index = table(spark, sf_dir, "document_index").where("source_markdown_path IS NOT NULL")
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("host")
    hosts = index.groupBy("doc_id").agg(F.max_by("source_markdown_path", F.struct("indexed_at", "source_markdown_path")).alias("path")).select("doc_id", folder)
    return materialize(chunks.join(materialize(hosts, "hosts"), "doc_id", "left").select("chunk_id", "host", "text"), "host-texts")


def _chunks_of_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chunk_id, host, text), a row per chunk."""
    return _with_hosts(spark, sf_dir, one_per_id(table(spark, sf_dir, "chunks"), "chunk_id", ["doc_id", "text"]))


def p3_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk cleaned with the wrapper of its host."""
    texts = _chunks_of_hosts(spark, sf_dir)
    return markup.cleaned_texts(texts, markup.host_wrappers(texts))


def p3_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.host_wrappers(_chunks_of_hosts(spark, sf_dir)).drop("nodes")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the length of the squeezed text."""
    return splitting.split_oversized(table(spark, sf_dir, "chunks"), keep=["doc_id", "title_path"]).where("piece = 1").select("chunk_id")


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the length of the text as stored."""
    return splitting.split_oversized(table(spark, sf_dir, "chunks"), keep=["doc_id", "title_path"], stored=True)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unify.differing_twins(table(spark, sf_dir, "chunks"))


def p5_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per chunk."""
    chunks = one_per_id(table(spark, sf_dir, "chunks"), "chunk_id", ["text", "retrieval_text"])
    return unify.unify(chunks, ["text", "retrieval_text"]).select("chunk_id", "text_form", "retrieval_text_form")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relevance.shared_codes(table(spark, sf_dir, "chunks"))


def p6_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term of every chunk."""
    return relevance.record_scores(table(spark, sf_dir, "chunks"), "chunk_id", ["retrieval_text", "section_title"])


def p6_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of the 10 best terms of each chunk."""
    return relevance.characteristic_terms(table(spark, sf_dir, "chunks"), "chunk_id", ["retrieval_text", "section_title"])


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_ids(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.document_mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.document_mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetitive(table(spark, sf_dir, "documents"))


def p9_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (p1_budget, p2_found, p2_groups, p3_found, p3_clean, p3_wrappers, p4_found, p4_pieces, p5_found, p5_unified, p6_found, p6_terms, p6_top_terms, p7_ids, p8_mix, p8_shares, p9_found, p9_profile)}


_SPACE = "[ \\t\\n\\r\\x{a0}\\x{2000}-\\x{200a}\\x{202f}\\x{3000}]+"
_ONE = "SELECT DISTINCT ON (chunk_id) * FROM chunks"
#: Full-width letters, digits and hyphen: the compatibility forms that SQL can undo.
_WIDE = "".join(chr(0xFF00 + i) for i in range(0x10, 0x5B))
_NARROW = "".join(chr(0x20 + i) for i in range(0x10, 0x5B))

_SQL = {
    "p4_found": f"SELECT chunk_id FROM ({_ONE}) WHERE length(trim(regexp_replace(text, '{_SPACE}', ' ', 'g'))) > 1400",
    "p6_found": f"""
        WITH runs AS (
            SELECT DISTINCT chunk_id, upper(run) AS term FROM (
                SELECT chunk_id, unnest(regexp_extract_all(translate(coalesce(nullif(retrieval_text, ''), text, ''), '{_WIDE}－', '{_NARROW}-'), '[A-Za-z0-9-]+')) AS run FROM ({_ONE}))
            WHERE length(regexp_replace(run, '[^A-Za-z]', '', 'g')) BETWEEN 2 AND 6 AND length(regexp_replace(run, '[^-]', '', 'g')) <= 1 AND length(regexp_replace(run, '[^0-9]', '', 'g')) >= 4)
        SELECT chunk_id, term FROM runs WHERE term IN (SELECT term FROM runs GROUP BY term HAVING count(*) BETWEEN 2 AND 8)""",
    "p9_found": f"""
        WITH bare AS (SELECT doc_id, regexp_replace(text, '{_SPACE}', '', 'g') AS t FROM documents WHERE text IS NOT NULL),
            windows AS (SELECT doc_id, substring(t, i, 20) AS w FROM (SELECT doc_id, t, unnest(range(1, length(t) - 18)) AS i FROM bare WHERE length(t) >= 100))
        SELECT doc_id FROM windows GROUP BY doc_id HAVING (count(*) - count(DISTINCT w)) * 10 >= 3 * count(*)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
