"""Document recall, keyword search and fused evidence for many questions at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import rules
from folioscan.functions.text import compact, matched_in, normalize
from folioscan.operators.bm25 import Bm25Index
from folioscan.operators.recall import DOC_K, DOC_PREFIX, document_heads, recalled, signal_weights
from folioscan.operators.scoring import match_terms, numbered_terms, search_within, terms_of_queries
from folioscan.session import materialize

BM25_K, TOP_K = 30, 15
TEXT_KEY, EVIDENCE_CHARS = 120, 1200
KEYWORD_FACTOR = 1.2
#: Characters of a document's text in one row, and the range of ord whose chunks make up a piece of a longer one.
TEXT_CHARS, TEXT_RANGE = 1 << 26, 1 << 14


def distinct_questions(questions: DataFrame) -> DataFrame:
    """Questions with one row per qid and without null qid; a null domain is empty."""
    return questions.where(F.col("qid").isNotNull()).dropDuplicates(["qid"]).withColumn("domain", F.coalesce("domain", F.lit("")))


def question_texts(questions: DataFrame) -> DataFrame:
    """Query texts: qid, query (qid and number), place (0 for the question), query_source, option, domain, text, k."""
    options = F.coalesce(F.map_entries("options"), F.array().cast("array<struct<key:string,value:string>>"))
    base = normalize("question")
    texts = F.concat(
        F.array(F.struct(F.lit(None).cast("string").alias("option"), rules.question_query(F.col("question"), F.col("options")).alias("text"))),
        F.transform(options, lambda o: F.struct(o["key"].alias("option"), F.concat(base, F.lit(" "), normalize(o["value"])).alias("text"))),
    )
    rows = questions.select("qid", "domain", F.posexplode(texts).alias("place", "t"))
    return rows.select(
        "qid", F.struct("qid", "place").alias("query"), "place", F.col("t.option").alias("option"),
        F.coalesce(F.concat(F.lit("option_"), F.col("t.option")), F.lit("question")).alias("query_source"), "domain", F.col("t.text").alias("text"),
        F.when(F.col("place") == 0, BM25_K).otherwise(max(5, BM25_K // 2)).alias("k"),
    )


def document_texts(chunks: DataFrame, most_chars: int = TEXT_CHARS) -> DataFrame:
    """doc_id, piece, ord (of its first chunk), domain (last that is not empty) and text: the first 800 characters of each chunk in order.

    The text of a document comes in one piece, number 0, or, if it has more than most_chars characters, in pieces
    from 0 that make it up in order: the chunks of a range of ord each. No row holds more than that, or than a range.
    """
    heads = chunks.select("doc_id", "ord", "domain", F.substring("text", 1, DOC_PREFIX).alias("piece"), F.floor(F.col("ord") / TEXT_RANGE).alias("range"))
    joined = lambda c: F.concat(F.lit(" "), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", c))), lambda r: r[c]), " "))
    ranges = heads.groupBy("doc_id", "range").agg(F.min("ord").alias("ord"), joined("piece").alias("text"))
    ranges = materialize(ranges, "ranges")
    facts = ranges.groupBy("doc_id").agg(F.min("ord").alias("first"), F.sum(F.length("text")).alias("size"))
    facts = materialize(facts.join(document_heads(chunks).select("doc_id", "domain"), "doc_id"), "documents")
    rows = ranges.join(facts, "doc_id")
    whole = rows.where(F.col("size") <= most_chars).groupBy("doc_id").agg(
        F.lit(0).alias("piece"), F.first("first").alias("ord"), F.first("domain").alias("domain"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda r: r["text"]), "").alias("text")
    )
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("range")) - 1
    parts = rows.where(F.col("size") > most_chars).select("doc_id", place.alias("piece"), F.col("first").alias("ord"), "domain", "text")
    return whole.unionByName(parts)


def candidate_documents(questions: DataFrame, chunks: DataFrame, doc_k: int = DOC_K) -> DataFrame:
    """(qid, doc_id): the documents a question names, or else those recalled for it."""
    return recalled(chunks, questions, doc_k).select("qid", "doc_id")


def keyword_search(chunks: DataFrame, queries: DataFrame, restrict: DataFrame) -> DataFrame:
    """The best chunks of each query by keyword score, among the documents of `restrict` (query, doc_id).

    queries: query, text, domain, k, signals. Result: query, ord, score, rank; ties go by ord. Terms of all queries are
    matched against each chunk once. A query without documents in `restrict` is searched over all chunks that its domain meets.
    """
    asked = queries.select("query", F.col("domain").alias("asked"), F.col("signals").alias("s"), F.col("k").cast("int").alias("k"))
    wanted = materialize(signal_weights(asked, "query"), "wanted")
    stated = numbered_terms(wanted)
    held = materialize(match_terms(chunks.select("ord", "doc_id", "domain", "text"), stated), "held")
    return search_within(held, terms_of_queries(wanted, stated, ["query"]).join(asked.select("query", "asked", "k"), "query"), restrict)


def fused_evidence(chunks: DataFrame, questions: DataFrame, top_k: int = TOP_K, index: Bm25Index | None = None, doc_k: int = DOC_K,
                   candidates: DataFrame | None = None) -> DataFrame:
    """The evidence of every question: qid, rank and the chunk with its score and matched terms.

    Hits of BM25 and of keywords, for the question and for each of its options, gain for clauses, numbers
    and dates that they contain. Of the hits of one chunk the best stays, of equal ones the first in order of query, search and
    rank, but it keeps the place of the first; of chunks with equal first 120 characters the best stays.
    A question without candidate documents is searched over all chunks that its domain meets. candidates (qid, doc_id): those of
    candidate_documents, if they are known already.
    """
    chunks = materialize(chunks.withColumn("bare", compact(F.col("text"))), "chunks")
    questions = materialize(distinct_questions(questions), "questions")
    index = index or Bm25Index.build(chunks).kept()
    signals = rules.extract_signals(F.col("text"), F.col("domain"))
    queries = materialize(question_texts(questions).withColumn("signals", signals), "queries")
    restrict = queries.select("qid", "query").join(candidates if candidates is not None else candidate_documents(questions, chunks, doc_k), "qid").select("query", "doc_id")
    restrict = materialize(restrict, "restrict")
    lexical = index.search(queries.select("query", "text", "domain", "k"), restrict, "k").select("query", "ord", "score", "rank", F.lit(0).alias("search"))
    keyword = keyword_search(chunks, queries, restrict).select("query", "ord", "score", "rank", F.lit(1).alias("search"))
    hits = lexical.unionByName(keyword).join(queries.select("query", "qid", "place", "option", "query_source", "signals"), "query")
    hits = hits.join(chunks.select("ord", "chunk_id", "doc_id", F.col("domain").alias("chunk_domain"), "text", "original_text", "bare"), "ord")
    gain = lambda name, most, weight: F.least(F.size(matched_in(F.col("bare"), F.col("signals")[name])), F.lit(most)) * weight
    bonus = gain("clauses", 3, 3.0) + gain("numbers", 5, 2.0) + gain("dates", 3, 1.0)
    factor = F.when(F.col("search") == 1, KEYWORD_FACTOR).otherwise(1.0)
    hits = hits.select(
        "qid", "ord", "chunk_id", "doc_id", "chunk_domain", "text", "original_text", "query_source", "option",
        F.round(F.col("score") * factor + bonus, 6).alias("score"), F.when(F.col("search") == 1, "keyword").otherwise("bm25").alias("source"),
        "bare", "signals",
        F.struct("place", "search", "rank").alias("at"),
    )
    by_chunk = Window.partitionBy("qid", "ord")
    first = F.min("at").over(by_chunk)
    best = hits.withColumn("first_at", first).withColumn("n", F.row_number().over(by_chunk.orderBy(F.desc("score"), "at"))).where("n = 1")
    by_text = Window.partitionBy("qid", F.substring("text", 1, TEXT_KEY)).orderBy(F.desc("score"), "first_at")
    one = best.withColumn("n", F.row_number().over(by_text)).where("n = 1")
    ranked = one.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "first_at"))).where(F.col("rank") <= top_k)
    shown = normalize(F.coalesce(F.when(F.col("original_text") != "", F.col("original_text")), F.col("text")))
    return ranked.select(
        "qid", "rank", "doc_id", "chunk_id", F.col("chunk_domain").alias("domain"), F.substring(shown, 1, EVIDENCE_CHARS).alias("text"), "score", "source", "query_source", "option",
        matched_in(F.col("bare"), rules.all_terms(F.col("signals"))).alias("matched_terms"),
    )


def evidence_by_question(evidence: DataFrame) -> DataFrame:
    """K5: (qid, evidence): a question's evidence as one array in order of rank; at most top_k items a question."""
    item = F.struct("rank", "doc_id", F.lit(None).cast("int").alias("page"), "chunk_id", "domain", "text", "score", "source", "query_source", "option", "matched_terms")
    return evidence.groupBy("qid").agg(F.array_sort(F.collect_list(item)).alias("evidence"))


def prefix_dedupe(chunks: DataFrame, length: int = TEXT_KEY) -> DataFrame:
    """One chunk for each distinct first `length` characters: the least ord, and how many share it."""
    return chunks.groupBy(F.substring("text", 1, length).alias("text_key")).agg(F.min("ord").alias("ord"), F.count("*").alias("n"))
