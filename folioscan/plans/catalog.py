"""The named queries of the core and their SQL."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan import jobs
from folioscan.functions import answers as A
from folioscan.functions import rules as R
from folioscan.functions import text as X
from folioscan.operators import chunking, evaluate, recall, retrieve, structure
from folioscan.operators.bm25 import Bm25Index
from folioscan.plans import sql as S
from folioscan.session import materialize, shared_folder, table
from folioscan.sources import files, json_tables, sinks
from folioscan.streaming.traces import run_token_windows

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def corpus(spark: SparkSession, d: str) -> DataFrame:
    return chunking.search_chunks(table(spark, d, "chunks"), table(spark, d, "document_index"))


def questions(spark: SparkSession, d: str) -> DataFrame:
    return retrieve.distinct_questions(table(spark, d, "questions"))


def pages(spark: SparkSession, d: str) -> DataFrame:
    """The chunks of a document stand for its pages."""
    return table(spark, d, "chunks").select("chunk_id", "doc_id", F.col("chunk_index").alias("page"), "text").dropDuplicates(["chunk_id"]).drop("chunk_id")


def parsed(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.parsed_answers(table(spark, d, "traces"), questions(spark, d))


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    """The first answer to a question stands for the gold answer, the last one for the submission."""
    rows = parsed(spark, d)
    at = F.struct("logged_at", "trace_id")
    one = rows.groupBy("qid").agg(
        F.max("domain").alias("domain"), F.max("split").alias("split"), F.min_by("answer", at).alias("gold"), F.max_by("answer", at).alias("answer"), F.sum("total_tokens").alias("total_tokens")
    )
    return evaluate.judged(one.select("qid", "domain", "split", "gold"), one.select("qid", "answer", "total_tokens"))


# --- text -----------------------------------------------------------------------------------------------


@query(S.build("one", f"SELECT chunk_id, md5({S.norm('text')}) AS normalized, length({S.bare('text')}) >= 2 AS meaningful, length({S.norm('text')}) AS n_chars FROM one"))
def normalized_text(spark, d):
    """F1, F7."""
    one = table(spark, d, "chunks").select("chunk_id", "text").dropDuplicates(["chunk_id"])
    return one.select("chunk_id", F.md5(X.normalize("text")).alias("normalized"), X.has_meaningful_text("text").alias("meaningful"), F.length(X.normalize("text")).cast("long").alias("n_chars"))


@query(S.build("pages", f"""SELECT doc_id, page, line_no, {S.is_marker('line')} AS page_marker, {S.is_generic('line')} AS generic, {S.is_toc('line')} AS toc, {S.level('line')} AS level, {S.title('line')} AS title
    FROM (SELECT doc_id, page, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS line_no FROM pages)"""))
def line_flags(spark, d):
    """F3, F5, F6, F8, F9."""
    lines = structure.with_lines(pages(spark, d)).select("doc_id", "page", F.posexplode("lines").alias("line_no", "line"))
    x = F.col("line")
    return lines.select("doc_id", "page", F.col("line_no").cast("long").alias("line_no"), X.is_page_marker(x).alias("page_marker"), X.is_generic_heading(x).alias("generic"), X.is_toc_line(x).alias("toc"), X.heading_level(x).alias("level"), X.heading_title(x).alias("title"))


@query(S.build("one", f"SELECT chunk_id, md5({S.cleaned('text')}) AS cleaned FROM one"))
def cleaned_text(spark, d):
    """F2."""
    return table(spark, d, "chunks").select("chunk_id", "text").dropDuplicates(["chunk_id"]).select("chunk_id", F.md5(X.clean_text("text")).alias("cleaned"))


@query(S.build("tok", "SELECT ord, len(toks) AS n_tokens, len(list_distinct(toks)) AS n_terms, md5(array_to_string(toks, ' ')) AS tokens FROM tok"))
def tok_terms(spark, d):
    """F12."""
    rows = corpus(spark, d).select("ord", X.tokenize("text").alias("t"))
    return rows.select("ord", F.size("t").cast("long").alias("n_tokens"), F.size(F.array_distinct("t")).cast("long").alias("n_terms"), F.md5(F.array_join("t", " ")).alias("tokens"))


@query(S.build("sig", "SELECT qid, place, " + ", ".join(f"array_to_string(s.{n}, '|') AS {n}" for n in R.SIGNALS) + " FROM sig"))
def signals_extract(spark, d):
    """F13-F16."""
    texts = retrieve.question_texts(questions(spark, d))
    found = texts.select("qid", F.col("place").cast("long").alias("place"), R.extract_signals(F.col("text"), F.col("domain")).alias("s"))
    return found.select("qid", "place", *(F.array_join(F.col("s")[n], "|").alias(n) for n in R.SIGNALS))


_FIRST = f"SELECT ord, c.doc_id, c.domain, length(text) AS n_chars, md5(text) AS text, source_path FROM ch c"


@query(S.build("ch", _FIRST))
def search_chunks(spark, d):
    """S7, T1, J8."""
    return corpus(spark, d).select("ord", "doc_id", "domain", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text"), "source_path")


_STEP = """
, parts(ord, k, start, stop, size) AS (
    SELECT ord, 0, -1, 0, length(t) FROM plain WHERE length(t) > 1400
    UNION ALL
    SELECT ord, k, start, stop, size FROM (
        SELECT p.ord, k + 1 AS k, p.begin AS start, p.size,
            CASE WHEN p.begin + 1400 >= p.size THEN p.size WHEN cut > 700 THEN p.begin + cut + 1 ELSE p.begin + 1400 END AS stop
        FROM (SELECT r.*, CASE WHEN k = 0 THEN 0 ELSE stop - 120 END AS begin, length(substring(t, CASE WHEN k = 0 THEN 1 ELSE stop - 119 END, 1400)) - least(
                coalesce(nullif(strpos(reverse(substring(t, CASE WHEN k = 0 THEN 1 ELSE stop - 119 END, 1400)), '。'), 0), 100000),
                coalesce(nullif(strpos(reverse(substring(t, CASE WHEN k = 0 THEN 1 ELSE stop - 119 END, 1400)), '；'), 0), 100000)) AS cut
            FROM parts r JOIN plain USING (ord) WHERE k = 0 OR stop < r.size) p)
)
SELECT ord, CAST(k - 1 AS BIGINT) AS part, md5(trim(substring(t, start + 1, stop - start))) AS text FROM parts JOIN plain USING (ord) WHERE k > 0 AND trim(substring(t, start + 1, stop - start)) <> ''
UNION ALL SELECT ord, 0, md5(t) FROM plain WHERE length(t) BETWEEN 1 AND 1400"""


@query(f"WITH RECURSIVE plain AS MATERIALIZED (SELECT DISTINCT ON (chunk_id) ord, {S.norm('text')} AS t FROM chunks)" + _STEP)
def split_long_text(spark, d):
    """F11."""
    one = table(spark, d, "chunks").select("chunk_id", "ord", "text").dropDuplicates(["chunk_id"])
    return one.select("ord", F.posexplode(chunking.split_long_text(F.col("text"))).alias("part", "text")).select("ord", F.col("part").cast("long").alias("part"), F.md5("text").alias("text"))


# --- pages ------------------------------------------------------------------------------------------------


@query(S.build("repeated", "SELECT doc_id, edge, line, n FROM repeated"))
def page_edge_lines(spark, d):
    """A13."""
    return structure.repeated_edge_lines(pages(spark, d))


@query(S.build("stripped", "SELECT doc_id, page, md5(text) AS text FROM stripped"))
def page_strip(spark, d):
    """W1."""
    return structure.strip_page_edges(pages(spark, d)).select("doc_id", "page", F.md5("text").alias("text"))


@query(S.build("typed", "SELECT doc_id, page, page_type, CAST(len(l) AS BIGINT) AS n_lines FROM typed"))
def page_types(spark, d):
    """A14, W8."""
    return structure.page_types(structure.strip_page_edges(pages(spark, d))).withColumn("n_lines", F.col("n_lines").cast("long"))


_TOC = f"""SELECT doc_id, source_page, line_no, {S.strip("regexp_extract(t, '" + S.ENTRY + "', 1)")} AS title, TRY_CAST(regexp_extract(t, '{S.ENTRY}', 2) AS INTEGER) AS target_page FROM (
    SELECT doc_id, page AS source_page, i - 1 AS line_no, line, {S.norm('line')} AS t FROM (SELECT doc_id, page, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM typed WHERE {S.toc_page('l')}))
    WHERE line <> '目录' AND {S.is_toc('line')} AND regexp_matches(t, '{S.ENTRY}')"""


@query(S.build("typed", _TOC))
def toc_entries(spark, d):
    """F10, W5."""
    return structure.toc_entries(structure.strip_page_edges(pages(spark, d))).withColumn("line_no", F.col("line_no").cast("long"))


def _valid(name: str) -> str:
    above = structure.LEVELS[1 : structure.LEVELS.index(name)] if name != "heading" else ()
    return "t_heading" if name == "heading" else f"CASE WHEN p_{name} > greatest(0{''.join(f', coalesce(p_{h}, 0)' for h in above)}) THEN t_{name} END"


@query(S.build("state", "SELECT doc_id, page, CAST(segment AS BIGINT) AS segment, md5(text) AS text, coalesce(own_title, " + ", ".join(f"h_{n}" for n in reversed(structure.LEVELS)) + ", '') AS title, "
    + ", ".join(f"h_{n}" for n in structure.LEVELS) + " FROM (SELECT *, " + ", ".join(f"{_valid(n)} AS h_{n}" for n in structure.LEVELS) + " FROM state)"))
def segment_hierarchy(spark, d):
    """W2-W4."""
    found = structure.segments(structure.strip_page_edges(pages(spark, d)))
    return found.withColumn("text", F.md5("text")).withColumn("segment", F.col("segment").cast("long"))


@query(S.build("stripped state", "SELECT p.doc_id, page_count, coalesce(segment_count, 0) AS segment_count, coalesce(char_count, 0) AS char_count FROM (SELECT doc_id, count(*) AS page_count FROM stripped GROUP BY doc_id) p LEFT JOIN (SELECT doc_id, count(*) AS segment_count, CAST(sum(length(text)) AS BIGINT) AS char_count FROM state GROUP BY doc_id) s ON s.doc_id = p.doc_id"))
def document_records(spark, d):
    """A15, T3."""
    return structure.build_documents(pages(spark, d))


# --- retrieval ----------------------------------------------------------------------------------------------


@query(S.build("df", "SELECT term, df, round(idf, 6) AS idf FROM df"))
def bm25_df_idf(spark, d):
    """A1, A2, A5."""
    return Bm25Index.build(corpus(spark, d)).terms.withColumn("idf", F.round("idf", 6))


@query(S.build("dl corpus", "SELECT ord, dl, n, round(avgdl, 6) AS avgdl FROM dl, corpus"))
def bm25_lengths(spark, d):
    """A3, A4."""
    index = Bm25Index.build(corpus(spark, d))
    return index.docs.crossJoin(F.broadcast(index.corpus)).select("ord", F.col("dl").cast("long").alias("dl"), "n", F.round("avgdl", 6).alias("avgdl"))


_TOPK = f"""SELECT qid, ord, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, ord) AS rank FROM (
        SELECT q.qid, tf.ord, round(sum(q.qtf * idf * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * dl / avgdl))), 6) AS score
        FROM (SELECT qid, term, count(*) AS qtf FROM (SELECT qid, unnest({S.tokens('question')}) AS term FROM qs) GROUP BY ALL) q JOIN tf USING (term) JOIN df USING (term) JOIN dl ON dl.ord = tf.ord, corpus GROUP BY ALL)
    WHERE score > 0) WHERE rank <= 20"""


@query(S.build("qs tf df dl corpus", _TOPK))
def bm25_topk(spark, d):
    """Question texts against all chunks."""
    asked = questions(spark, d).select(F.col("qid").alias("query"), F.lit("").alias("domain"), F.col("question").alias("text"))
    return Bm25Index.build(corpus(spark, d)).kept().search(asked).select(F.col("query").alias("qid"), "ord", "score", F.col("rank").cast("long").alias("rank"))


@query(S.build("lexhits", "SELECT qid, place, ord, score, rank FROM lexhits"))
def bm25_filtered_topk(spark, d):
    """Every query text among its candidate documents, with statistics of the whole index."""
    chunks, asked = materialize(corpus(spark, d), "chunks"), questions(spark, d)
    texts = retrieve.question_texts(asked)
    candidates = retrieve.candidate_documents(asked, chunks)
    restrict = texts.select("qid", "query").join(candidates, "qid").select("query", "doc_id")
    hits = Bm25Index.build(chunks).kept().search(texts.select("query", "text", "domain", "k"), restrict, "k")
    return hits.select("query.qid", F.col("query.place").cast("long").alias("place"), "ord", "score", F.col("rank").cast("long").alias("rank"))


@query(S.build("docs", "SELECT doc_id, ord, domain, md5(text) AS text FROM docs"))
def document_texts(spark, d):
    """A8, A9."""
    return retrieve.document_texts(corpus(spark, d)).drop("piece").withColumn("text", F.md5("text"))


@query(S.build("recall", "SELECT qid, doc_id, domain, score, rank FROM recall"))
def doc_recall_topk(spark, d):
    """A10, L4, J5."""
    asked = questions(spark, d).where("coalesce(size(doc_ids), 0) <= 0")
    return recall.recall_documents(materialize(corpus(spark, d), "chunks"), asked).withColumn("rank", F.col("rank").cast("long"))


@query(S.build("kwhits", "SELECT qid, place, ord, score, rank FROM kwhits"))
def keyword_topk(spark, d):
    """A7, L2, J4."""
    chunks, asked = materialize(corpus(spark, d), "chunks"), questions(spark, d)
    texts = materialize(retrieve.question_texts(asked).withColumn("signals", R.extract_signals(F.col("text"), F.col("domain"))), "queries")
    candidates = retrieve.candidate_documents(asked, chunks)
    restrict = materialize(texts.select("qid", "query").join(candidates, "qid").select("query", "doc_id"), "restrict")
    hits = retrieve.keyword_search(chunks, texts, restrict)
    return hits.select("query.qid", F.col("query.place").cast("long").alias("place"), "ord", "score", F.col("rank").cast("long").alias("rank"))


_ALL = "list_concat(list_concat(list_concat(list_concat(s.keywords, s.clauses), s.numbers), s.dates), s.codes)"


@query(S.build("uniq", f"""SELECT qid, rank, doc_id, chunk_id, domain, substring({S.norm("coalesce(nullif(original_text, ''), text)")}, 1, 1200) AS text, score, CASE WHEN search = 1 THEN 'keyword' ELSE 'bm25' END AS source,
    coalesce('option_' || option, 'question') AS query_source, option, array_to_string({S.matched('text', 'every')}, '|') AS matched_terms
    FROM (SELECT *, list_filter({_ALL}, lambda t, i: list_position({_ALL}, t) = i) AS every, row_number() OVER (PARTITION BY qid ORDER BY score DESC, first_at) AS rank FROM uniq QUALIFY rank <= 15)"""))
def fused_evidence(spark, d):
    """The whole retrieval."""
    found = retrieve.fused_evidence(corpus(spark, d), table(spark, d, "questions"))
    return found.withColumn("matched_terms", F.array_join("matched_terms", "|")).withColumn("rank", F.col("rank").cast("long"))


@query(S.build("ch", "SELECT substring(text, 1, 120) AS text_key, min(ord) AS ord, count(*) AS n FROM ch GROUP BY 1"))
def near_copy_prefix_dedupe(spark, d):
    """L5, U5."""
    return retrieve.prefix_dedupe(corpus(spark, d))


# --- files and jobs ---------------------------------------------------------------------------------------------


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/folioscan/{name}-{uuid.uuid4().hex}"


def raw_files(spark: SparkSession, d: str) -> str:
    """A folder of raw files of a domain: documents as text, every third also as a PDF that must not be chosen, and the chunks of documents as volumes of 50 pages in PDF (whose pages a reader of JSON gives back)."""
    documents = table(spark, d, "documents").select(F.concat(F.lit("doc_"), "doc_id").alias("name"), F.coalesce("text", F.lit("")).alias("content"), "doc_id")
    volume = F.md5(F.concat("doc_id", F.lit("-"), F.floor(F.col("chunk_index") / 50).cast("string"))).alias("name")
    chunks = table(spark, d, "chunks").dropDuplicates(["chunk_id"]).select(volume, "chunk_index", F.coalesce("text", F.lit("")).alias("text"))
    volumes = chunks.groupBy("name").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "text"))), lambda x: x["text"])).alias("content"))  # 50 at most
    text = documents.select(F.concat("name", F.lit(".txt")).alias("path"), "content")
    twice = documents.where("doc_id % 3 = 0").select(F.concat(F.lit("a/"), "name", F.lit(".PDF")).alias("path"), F.lit('["not this"]').alias("content"))
    to = folder(spark, "raw")
    within = lambda rows: rows.withColumn("path", F.concat(F.lit("research/"), "path"))
    sinks.write_each(within(text.unionByName(twice).unionByName(volumes.select(F.concat("name", F.lit(".pdf")).alias("path"), "content"))), to)
    return to


def json_pages(content: bytes) -> list[str]:
    return json.loads(content)


def processed(spark: SparkSession, d: str) -> str:
    """The raw files as a processed root."""
    raw, to = raw_files(spark, d), folder(spark, "processed")
    asked = f"{to}/questions/group_a/research_questions.json"
    sinks.write_each(spark.createDataFrame([("group_a/research_questions.json", "[]")], "path string, content string"), f"{to}/questions")
    config = jobs.ProcessConfig(raw, asked, f"{to}/out", reader=json_pages)
    jobs.process(spark, config)
    return config.output_subdir


@query(S.build("rawpages", "SELECT doc_id, page, md5(text) AS text FROM rawpages", S.RAW_PAGES))
def raw_pages(spark, d):
    """Pages of a folder of raw files."""
    return files.read_pages(spark, raw_files(spark, d), reader=json_pages).withColumn("text", F.md5("text"))


_TOCS = f"SELECT doc_id, count(*) AS n_toc FROM ({_TOC}) GROUP BY doc_id"


@query(S.build("rawpages stripped state typed", f"""SELECT p.doc_id, 'research' AS domain, page_count, CAST(coalesce(char_count, 0) AS BIGINT) AS char_count, kind AS source_type, coalesce(n_toc, 0) AS n_toc, coalesce(n_segments, 0) AS n_segments, n_content
    FROM (SELECT s.doc_id, count(*) AS page_count, any_value(kind) AS kind, count(*) FILTER (page_type = 'content') AS n_content FROM typed s JOIN rawpages r ON r.doc_id = s.doc_id AND r.page = s.page GROUP BY s.doc_id) p
    LEFT JOIN (SELECT doc_id, count(*) AS n_segments, sum(length(text)) AS char_count FROM state GROUP BY doc_id) s ON s.doc_id = p.doc_id LEFT JOIN ({_TOCS}) t ON t.doc_id = p.doc_id""", S.RAW_PAGES))
def processed_documents(spark, d):
    """Raw files processed into document files and an index, both read back."""
    root = processed(spark, d)
    documents = json_tables.load_documents(spark, f"{root}/documents")
    index = spark.read.json(f"{root}/document_index", schema=sinks.INDEX)
    count = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    total = F.aggregate("pages", F.lit(0), lambda n, p: n + F.size(p["segments"])).cast("long")
    rows = documents.select("doc_id", "domain", count("toc").alias("n_toc"), total.alias("n_segments"), count(F.filter("pages", lambda p: p["page_type"] == "content")).alias("n_content"))
    return rows.join(index.select("doc_id", "page_count", "char_count", "source_type"), "doc_id")


_WHOLE = f"concat_ws(chr(10), nullif(above, ''), nullif({S.norm('title')}, ''), nullif(above, ''), nullif({S.norm('text')}, ''))"
_ABOVE = "array_to_string(list_filter(list_transform([" + ", ".join(f"h_{n}" for n in structure.LEVELS) + f"], lambda x: {S.norm('x')}), lambda x: x <> ''), ' ')"
_TITLED = "SELECT doc_id, page, segment, text, coalesce(own_title, " + ", ".join(f"h_{n}" for n in reversed(structure.LEVELS)) + ", '') AS title, " + ", ".join(f"h_{n}" for n in structure.LEVELS) + " FROM (SELECT *, " + ", ".join(f"{_valid(n)} AS h_{n}" for n in structure.LEVELS) + " FROM state)"
_SEGMENTS = {
    "titled": ("state", f"SELECT *, {_ABOVE} AS above FROM ({_TITLED})"),
    "plain": ("titled", f"SELECT row_number() OVER () AS ord, doc_id || ':p' || page || ':s' || segment AS chunk_id, {S.norm('text')} AS body, {S.norm(_WHOLE)} AS t FROM titled WHERE {S.norm('text')} <> ''"),
}


@query(S.build("plain", f"{_STEP.replace('SELECT ord, CAST(k', ', found AS (SELECT ord, CAST(k', 1)}) SELECT chunk_id || ':c' || part AS chunk_id, md5(f.text) AS text, md5(body) AS original_text FROM found f JOIN plain p ON p.ord = f.ord".replace("md5(trim(", "(trim(").replace("SELECT ord, 0, md5(t)", "SELECT ord, 0, t"), S.RAW_PAGES | _SEGMENTS, recursive=True))
def page_chunks(spark, d):
    """Chunks of processed roots."""
    rows = jobs.build_chunks(spark, [processed(spark, d)])
    return rows.select("chunk_id", F.md5("text").alias("text"), F.md5("original_text").alias("original_text"))


@query(S.build("typed", _TOC, S.CONTENTS_PAGES))
def contents_pages(spark, d):
    """Lines of contents, made of the titles of chunks."""
    one = table(spark, d, "chunks").dropDuplicates(["chunk_id"])
    title, number = F.coalesce("section_title", F.lit("无题")), F.col("chunk_index")
    text = F.concat(F.lit("目录\n"), title, F.lit("......"), number, F.lit("\n第一章 "), title, F.lit(" … "), number + 7, F.lit("\n附录 … "), number)
    found = structure.toc_entries(structure.strip_page_edges(one.select("doc_id", number.alias("page"), text.alias("text"))))
    return found.withColumn("line_no", F.col("line_no").cast("long"))


@query(S.build("stripped repeated", "SELECT s.doc_id, page, md5(text) AS text, coalesce(n_lines, 0) AS n_lines FROM stripped s LEFT JOIN (SELECT doc_id, count(*) AS n_lines FROM repeated GROUP BY doc_id) r ON r.doc_id = s.doc_id", S.EDGED_PAGES))
def edged_pages(spark, d):
    """Pages with a header, a page marker and one of two footers, made of chunks."""
    one = table(spark, d, "chunks").dropDuplicates(["chunk_id"])
    number = F.col("chunk_index")
    text = F.concat(F.lit("年度报告 "), "doc_id", F.lit("\n"), number, F.lit("-"), number + 1, F.lit("\n"), F.coalesce("text", F.lit("")), F.lit("\n内部资料请勿外传 "), number % 2)
    pages_ = materialize(one.select("doc_id", number.alias("page"), text.alias("text")), "pages")
    lines = structure.repeated_edge_lines(pages_).groupBy("doc_id").agg(F.count("*").alias("n_lines"))
    return structure.strip_page_edges(pages_).join(lines, "doc_id", "left").select("doc_id", "page", F.md5("text").alias("text"), F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"))


@query(S.build("", f"""SELECT o.chunk_id, o.doc_id, coalesce(o.domain, '') AS domain, md5({S.norm('o.text')}) AS text, section_title FROM (SELECT DISTINCT ON (chunk_id) * FROM chunks) o WHERE {S.norm("coalesce(o.text, '')")} <> ''"""))
def chunk_files(spark, d):
    """Chunks as JSON lines, read back with their metadata."""
    to = folder(spark, "chunk-lines")
    sinks.write_chunks(table(spark, d, "chunks").dropDuplicates(["chunk_id"]).withColumnRenamed("text", "content"), to)
    found = json_tables.load_chunks(spark, to, lines=True)
    return found.select("chunk_id", "doc_id", "domain", F.md5("text").alias("text"), json_tables.nested(F.col("metadata"), "section_title").alias("section_title"))


def question_files(spark: SparkSession, d: str) -> list[str]:
    """The questions in three files: a list, and objects with `questions` and `data`, by the first letters of a hash of qid."""
    rows = questions(spark, d).select(F.pmod(F.xxhash64("qid"), F.lit(3)).alias("n"), F.to_json(F.struct("qid", "domain", "split", "question", "options", "answer_format", "type", "doc_ids")).alias("item"))
    listed = F.concat(F.lit("["), F.array_join(F.collect_list("item"), ","), F.lit("]"))  # a question file is one value
    held = rows.groupBy("n").agg(listed.alias("list"))
    content = F.when(F.col("n") == 0, F.col("list")).when(F.col("n") == 1, F.concat(F.lit('{"questions":'), "list", F.lit("}"))).otherwise(F.concat(F.lit('{"data":'), "list", F.lit("}")))
    to = folder(spark, "questions")
    names = [f"{n}_questions.json" for n in range(3)]
    every = spark.range(3).select(F.col("id").alias("n")).join(held, "n", "left").withColumn("list", F.coalesce("list", F.lit("[]")))
    sinks.write_each(every.select(F.concat(F.lit("group_a/"), F.col("n").cast("string"), F.lit("_questions.json")).alias("path"), content.alias("content")), to)
    return [f"{to}/group_a/{n}" for n in names]


@query(S.build("qs", "SELECT qid, domain, split, question, coalesce(array_to_string(list_transform(map_entries(options), lambda o: o.key || '=' || coalesce(o.value, '')), '|'), '') AS options, answer_format, coalesce(array_to_string(doc_ids, '|'), '') AS doc_ids FROM qs"))
def questions_of_files(spark, d):
    """Questions of several files of all shapes."""
    rows = json_tables.load_questions(spark, question_files(spark, d))
    shown = F.array_join(F.transform(F.map_entries("options"), lambda o: F.concat(o["key"], F.lit("="), F.coalesce(o["value"], F.lit("")))), "|")
    empty = lambda c: F.coalesce(c, F.lit(""))
    return rows.select("qid", "domain", "split", "question", empty(shown).alias("options"), "answer_format", empty(F.array_join("doc_ids", "|")).alias("doc_ids"))


def first_chunks(spark: SparkSession, d: str) -> DataFrame:
    """(qid, evidence): the first chunk of each named document as evidence, as items of an evidence file."""
    asked = questions(spark, d)
    first = corpus(spark, d).groupBy("doc_id").agg(F.min("ord").alias("ord"), F.min_by("text", "ord").alias("text"))
    named = asked.select("qid", F.explode("doc_ids").alias("doc_id")).distinct().join(first, "doc_id")
    item = F.struct("ord", "doc_id", F.lit(None).cast("int").alias("page"), F.substring("text", 1, retrieve.EVIDENCE_CHARS).alias("text"))
    return named.groupBy("qid").agg(F.array_sort(F.collect_list(item)).alias("evidence"))


_FIRST_CHUNKS = """SELECT qid, string_agg('[证据' || i || ']' || chr(10) || 'doc_id: ' || doc_id || chr(10) || 'page: ' || chr(10) || 'text: ' || text, chr(10) || chr(10) ORDER BY i) AS ev FROM (
    SELECT qid, doc_id, text, row_number() OVER (PARTITION BY qid ORDER BY ord) AS i FROM (
        SELECT qid, n.doc_id, first.ord, substring(first.text, 1, 1200) AS text FROM (SELECT DISTINCT qid, unnest(doc_ids) AS doc_id FROM qs) n
        JOIN (SELECT doc_id, min(ord) AS ord, arg_min(text, ord) AS text FROM ch GROUP BY doc_id) first ON first.doc_id = n.doc_id)) GROUP BY qid"""


@query(S.build("qs ch", f"SELECT qid, md5(ev) AS evidence FROM ({_FIRST_CHUNKS})"))
def evidence_files(spark, d):
    """Evidence as JSON lines, read back as texts."""
    to = folder(spark, "evidence")
    sinks.write_evidence(first_chunks(spark, d), to)
    return json_tables.load_evidence(spark, to, lines=True).withColumn("evidence", F.md5("evidence"))


@query(S.build("qs tf df dl corpus", _TOPK))
def index_files(spark, d):
    """The question texts searched in an index that was saved and loaded."""
    to = folder(spark, "index")
    Bm25Index.build(corpus(spark, d)).save(to)
    asked = questions(spark, d).select(F.col("qid").alias("query"), F.lit("").alias("domain"), F.col("question").alias("text"))
    found = Bm25Index.load(spark, to).search(asked)
    return found.select(F.col("query").alias("qid"), "ord", "score", F.col("rank").cast("long").alias("rank"))


@query(S.build("tr", "SELECT trace_id, qid, answer, model, coalesce(usage.total_tokens, -1) AS total_tokens, len(messages) AS n_messages, messages[1].role AS first_role FROM tr"))
def trace_files(spark, d):
    """K7: traces as files of their own, read back."""
    rows = evaluate.distinct_traces(table(spark, d, "traces"))
    at = F.col("logged_at").cast("timestamp")
    named = rows.withColumn("run_time", F.col("logged_at")).withColumn("timestamp", at).withColumn("evidence", F.col("trace_id").cast("string")).drop("logged_at", "received_at", "trace_id", "run_dir")
    to = folder(spark, "traces")
    # times of two traces may be equal, and with them their names
    sinks.write_traces(named.withColumn("qid", F.concat(F.coalesce("qid", F.lit("")), F.lit("."), "evidence")), to)
    found = json_tables.load_traces(spark, to)
    text = F.to_json(F.struct("messages"))
    return found.select(
        F.col("evidence").cast("long").alias("trace_id"), F.nullif(F.regexp_replace("qid", "[.][^.]*$", ""), F.lit("")).alias("qid"), "answer", "model", F.coalesce("usage.total_tokens", F.lit(-1)).cast("long").alias("total_tokens"),
        F.coalesce(F.size("messages"), F.lit(0)).cast("long").alias("n_messages"), json_tables.nested(text, "messages", 0, "role").alias("first_role"),
    )


@query(S.build("tr", "SELECT trace_id, messages[1].role AS first_role, messages[2].content AS second_content, CAST(usage.total_tokens AS VARCHAR) AS total_tokens FROM tr"))
def nested_values(spark, d):
    """values below keys and places of traces as JSON."""
    rows = evaluate.distinct_traces(table(spark, d, "traces")).select("trace_id", json_tables.to_plain(F.struct("messages", "usage")).alias("j"))
    at = lambda *keys: json_tables.nested(F.col("j"), *keys)
    return rows.select("trace_id", at("messages", 0, "role").alias("first_role"), at("messages", 1, "content").alias("second_content"), at("usage", "total_tokens").alias("total_tokens"))


@query(S.build("sig", f"SELECT qid, place, array_to_string({S.ordered_unique('list_concat(every, ' + S.tokens('text') + ')')}, '|') AS terms FROM (SELECT *, list_filter({_ALL}, lambda t, i: list_position({_ALL}, t) = i) AS every FROM sig)"))
def question_terms(spark, d):
    """F17."""
    texts = retrieve.question_texts(questions(spark, d))
    return texts.select("qid", F.col("place").cast("long").alias("place"), F.array_join(R.query_terms(F.col("text"), F.col("domain")), "|").alias("terms"))


@query(S.build("qs recall", """SELECT qid, doc_id, 999.0::DOUBLE AS score, 'provided_doc_id' AS source, domain, rank FROM (SELECT qid, domain, unnest(l) AS doc_id, generate_subscripts(l, 1) AS rank FROM (SELECT qid, domain, list_filter(doc_ids, lambda x, i: x IS NOT NULL AND list_position(doc_ids, x) = i) AS l FROM qs WHERE coalesce(len(doc_ids), 0) > 0))
    UNION ALL SELECT qid, doc_id, score, 'document_keyword_recall', domain, rank FROM recall"""))
def recalled_documents(spark, d):
    """Named documents with their fixed score, and recalled ones."""
    found = recall.recalled(materialize(corpus(spark, d), "chunks"), questions(spark, d))
    return found.withColumn("rank", F.col("rank").cast("long"))


@query(S.build("uniq cand qs", f"""SELECT e.qid, split, coalesce(docs, '') AS candidate_doc_ids, rank, chunk_id, score, matched_terms FROM (
    SELECT qid, rank, chunk_id, score, array_to_string({S.matched('text', 'every')}, '|') AS matched_terms FROM (SELECT *, list_filter({_ALL}, lambda t, i: list_position({_ALL}, t) = i) AS every, row_number() OVER (PARTITION BY qid ORDER BY score DESC, first_at) AS rank FROM uniq QUALIFY rank <= 15)) e
    JOIN qs ON qs.qid = e.qid LEFT JOIN (SELECT qid, string_agg(doc_id, '|' ORDER BY doc_id) AS docs FROM cand WHERE doc_id IS NOT NULL GROUP BY qid) c ON c.qid = e.qid"""))
def evidence_job(spark, d):
    """Evidence of question files, written and read back."""
    found = jobs.generate_evidence(spark, corpus(spark, d), question_files(spark, d), folder(spark, "evidence"))
    rows = found.select("qid", "split", F.coalesce(F.array_join("candidate_doc_ids", "|"), F.lit("")).alias("candidate_doc_ids"), F.explode("evidence").alias("e"))
    return rows.select("qid", "split", "candidate_doc_ids", F.col("e.rank").cast("long").alias("rank"), "e.chunk_id", "e.score", F.array_join("e.matched_terms", "|").alias("matched_terms"))


_LETTERS = "CASE WHEN answer_format = 'multi' THEN array_to_string(list_sort(list_distinct(regexp_extract_all(upper(coalesce(answer, '')), '[A-D]'))), '') ELSE coalesce(regexp_extract_all(upper(coalesce(answer, '')), '[A-D]')[1], '') END"


@query(S.build("tr qs", f"""SELECT qid, answer, prompt_tokens, completion_tokens, total_tokens FROM (WITH said AS (
    SELECT q.qid, {_LETTERS} AS answer, coalesce(usage.input_tokens, 0) AS prompt_tokens, coalesce(usage.output_tokens, 0) AS completion_tokens,
        CASE WHEN coalesce(usage.total_tokens, 0) <> 0 THEN usage.total_tokens ELSE coalesce(usage.input_tokens, 0) + coalesce(usage.output_tokens, 0) END AS total_tokens
    FROM qs q LEFT JOIN (SELECT tr.qid, arg_max(struct_pack(a := coalesce(answer, '')), (logged_at, trace_id)).a AS answer, arg_max(struct_pack(u := usage), (logged_at, trace_id)).u AS usage FROM tr WHERE qid IS NOT NULL GROUP BY qid) t ON t.qid = q.qid)
    SELECT 'summary' AS qid, '' AS answer, {", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in ("prompt_tokens", "completion_tokens", "total_tokens"))} FROM said UNION ALL SELECT qid, answer, prompt_tokens, completion_tokens, total_tokens FROM said)"""))
def answer_run(spark, d):
    """Questions answered by replay of traces; the answer file is read back."""
    to, evidence = folder(spark, "answers"), folder(spark, "evidence")
    sinks.write_evidence(first_chunks(spark, d), evidence)
    texts = json_tables.load_evidence(spark, evidence, lines=True)
    jobs.run_answers(questions(spark, d), texts, jobs.Replay(evaluate.distinct_traces(table(spark, d, "traces"))), to)
    kinds = "qid string, answer string, prompt_tokens long, completion_tokens long, total_tokens long"
    return spark.read.option("header", True).schema(kinds).csv(to).withColumn("answer", F.coalesce("answer", F.lit("")))


@query(S.build("qs", f"""SELECT qid, place, role, md5(content) AS content FROM (SELECT qid, 0 AS place, 'system' AS role, {S.quoted(A.SYSTEM_PROMPT)} AS content FROM qs UNION ALL SELECT qid, 1, 'user', chr(10) || chr(10) || '【题目】' || chr(10) || coalesce(question, '') || chr(10) || chr(10) || '【选项】' || chr(10)
    || coalesce(array_to_string(list_transform(map_entries(options), lambda o: o.key || '. ' || coalesce(o.value, '') || chr(10)), ''), '') || chr(10) || '【要求】' || chr(10) || CASE answer_format WHEN 'mcq' THEN '只输出一个大写字母，例如：A' WHEN 'multi' THEN '只输出所有正确答案的大写字母，按字母顺序，不加空格或逗号，例如：AC' WHEN 'tf' THEN '只输出A或B' ELSE '只输出答案字母' END || chr(10) || chr(10) || '答案：' FROM qs)"""))
def prompt_messages(spark, d):
    """system and user message of questions without evidence."""
    prompt = A.build_prompt(F.col("question"), F.col("options"), F.lit(None).cast("string"), F.col("answer_format"))
    rows = questions(spark, d).select("qid", F.posexplode(A.messages(prompt)).alias("place", "m"))
    return rows.select("qid", F.col("place").cast("long").alias("place"), "m.role", F.md5("m.content").alias("content"))


# --- answers --------------------------------------------------------------------------------------------------


@query(S.build("parsed", "SELECT trace_id, qid, domain, split, answer FROM parsed"))
def answer_normalise(spark, d):
    """F19, J9."""
    return parsed(spark, d).select("trace_id", "qid", "domain", "split", "answer")


_CONTENT = "CASE WHEN coalesce(reasoning, '') <> '' THEN '<think>' || reasoning || '</think>' || coalesce(answer, '') ELSE coalesce(answer, '') END"


@query(S.build("tr", f"""SELECT trace_id, CASE WHEN b > 0 THEN {S.strip("substring(c, 8, b - 1)")} ELSE '' END AS reasoning, CASE WHEN b > 0 THEN {S.strip("substring(c, 8 + b + 7)")} ELSE c END AS answer
    FROM (SELECT trace_id, c, CASE WHEN starts_with(c, '<think>') THEN strpos(substring(c, 8), '</think>') ELSE 0 END AS b FROM (SELECT trace_id, {_CONTENT} AS c FROM tr))"""))
def think_split(spark, d):
    """F20, F21."""
    filled = F.coalesce("reasoning", F.lit("")) != ""
    content = F.when(filled, F.concat(F.lit(A.THINK_OPEN), "reasoning", F.lit(A.THINK_CLOSE), F.coalesce("answer", F.lit("")))).otherwise(F.coalesce("answer", F.lit("")))
    rows = evaluate.distinct_traces(table(spark, d, "traces")).select("trace_id", A.reasoning_and_content(content).alias("x"))
    return rows.select("trace_id", "x.reasoning", "x.answer")


@query(S.build("tr", """SELECT trace_id, coalesce(usage.input_tokens, 0) AS prompt_tokens, coalesce(usage.output_tokens, 0) AS completion_tokens,
    CASE WHEN coalesce(usage.total_tokens, 0) <> 0 THEN usage.total_tokens ELSE coalesce(usage.input_tokens, 0) + coalesce(usage.output_tokens, 0) END AS total_tokens,
    coalesce(usage.total_tokens, coalesce(usage.input_tokens, 0) + coalesce(usage.output_tokens, 0)) AS logged_total FROM tr"""))
def usage_totals(spark, d):
    """F22, F23."""
    u = F.col("usage")
    rows = evaluate.distinct_traces(table(spark, d, "traces"))
    return rows.select("trace_id", A.prompt_tokens(u).alias("prompt_tokens"), A.completion_tokens(u).alias("completion_tokens"), A.total_tokens(u).alias("total_tokens"), A.logged_total(u).alias("logged_total"))


_SUMS = ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in ("prompt_tokens", "completion_tokens", "total_tokens"))


@query(S.build("parsed", f"SELECT 'summary' AS qid, '' AS answer, {_SUMS}, 0 AS place FROM parsed UNION ALL SELECT qid, arg_max(answer, (logged_at, trace_id)), {_SUMS}, 1 FROM parsed GROUP BY qid"))
def token_ledger(spark, d):
    """A16, K6."""
    return evaluate.token_ledger(parsed(spark, d))


_SCORE = "round(greatest(0.0::DOUBLE, 100 * accuracy * (0.7::DOUBLE + 0.3::DOUBLE * CASE WHEN total_tokens > 0 THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, (5000000 - total_tokens) / 5000000::DOUBLE)) ELSE 0.0::DOUBLE END)), 6) AS score"


@query(S.build("verdict", f"SELECT n, round(accuracy, 6) AS accuracy, total_tokens, {_SCORE} FROM (SELECT count(*) AS n, avg(correct) AS accuracy, CAST(sum(total_tokens) AS BIGINT) AS total_tokens FROM verdict)"))
def final_score(spark, d):
    """A17, A18, J11."""
    one = verdicts(spark, d).agg(F.count("*").alias("n"), F.avg("correct").alias("accuracy"), F.sum("total_tokens").alias("total_tokens"))
    return one.select("n", F.round("accuracy", 6).alias("accuracy"), "total_tokens", F.round(evaluate.final_score(F.col("accuracy"), F.col("total_tokens")), 6).alias("score"))


@query(S.build("verdict", "SELECT CASE WHEN grouping(domain) = 1 THEN 'all' ELSE coalesce(domain, '') END AS domain, CASE WHEN grouping(split) = 1 THEN 'all' ELSE coalesce(split, '') END AS split, count(*) AS n, round(avg(correct), 6) AS accuracy, CAST(coalesce(sum(total_tokens), 0) AS BIGINT) AS total_tokens FROM verdict GROUP BY ROLLUP (domain, split)"))
def score_breakdown(spark, d):
    """A19."""
    return evaluate.score_breakdown(verdicts(spark, d))


@query(S.build("verdict tr", f"""SELECT run, accuracy, total_tokens, strftime(submitted_at, '%Y-%m-%d %H:%M:%S.%f') AS submitted_at, score, row_number() OVER (ORDER BY score DESC, accuracy DESC, total_tokens, submitted_at, run) AS place FROM (SELECT *, {_SCORE} FROM (
    SELECT coalesce(run_dir, '') AS run, round(avg(CASE WHEN v.gold <> '' AND p.answer = v.gold THEN 1 ELSE 0 END), 6) AS accuracy, CAST(sum(p.total_tokens) AS BIGINT) AS total_tokens, max(t.logged_at) AS submitted_at
    FROM tr t JOIN parsed p ON p.trace_id = t.trace_id JOIN verdict v ON v.qid = p.qid GROUP BY 1))"""))
def leaderboard(spark, d):
    """The runs of the traces."""
    runs = evaluate.distinct_traces(table(spark, d, "traces")).select("trace_id", F.coalesce("run_dir", F.lit("")).alias("run"))
    rows = parsed(spark, d).select("trace_id", "qid", "answer", "total_tokens", "logged_at").join(verdicts(spark, d).select("qid", "gold"), "qid").join(runs, "trace_id")
    right = F.when((F.col("gold") != "") & (F.col("answer") == F.col("gold")), 1).otherwise(0)
    per = rows.groupBy("run").agg(F.round(F.avg(right), 6).alias("accuracy"), F.sum("total_tokens").alias("total_tokens"), F.max("logged_at").alias("submitted_at"))
    ranked = evaluate.leaderboard(per).withColumn("place", F.col("place").cast("long"))
    return ranked.withColumn("submitted_at", F.date_format("submitted_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(S.build("", "SELECT doc_id, path, suffix FROM (SELECT regexp_replace(regexp_extract(path, '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1') AS doc_id, path, lower(regexp_extract(regexp_extract(path, '([^/]*)$', 1), '.\\.([^.]*)$', 1)) AS suffix FROM (SELECT DISTINCT source_markdown_path AS path FROM document_index WHERE source_markdown_path IS NOT NULL)) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN suffix = 'txt' THEN 0 ELSE 1 END, path) = 1"))
def source_preference(spark, d):
    """The paths of the document index."""
    paths = table(spark, d, "document_index").select(F.col("source_markdown_path").alias("path")).where("path IS NOT NULL").distinct()
    return files.prefer_sources(files.with_name(paths)).select("doc_id", "path", "suffix")


@query(f"""SELECT doc_id AS idx, coalesce(index_doc_id, '') || '#' || doc_id AS chunk_id, coalesce(index_doc_id, '') AS doc_id, coalesce(lang, '') AS domain, md5({S.norm('text')}) AS text FROM documents WHERE {S.norm('text')} <> ''""")
def alias_load(spark, d):
    """Documents under the aliases content, document_id and category."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("idx"), F.col("text").alias("content"), F.col("index_doc_id").alias("document_id"), F.col("lang").alias("category"))
    return json_tables.aliased(rows).withColumn("text", F.md5("text"))


def _safe(x: str) -> str:
    return f"coalesce(nullif(trim(regexp_replace(coalesce(nullif({x}, ''), 'unknown'), '[^A-Za-z0-9_.-]+', '_', 'g'), '._'), ''), 'unknown')"


_USED = "coalesce(usage.total_tokens, coalesce(usage.input_tokens, 0) + coalesce(usage.output_tokens, 0))"


@query(S.build("tr", f"""SELECT trace_id, {_safe('domain')} AS safe_domain, strftime(logged_at, '%Y%m%d') || '-' || strftime(logged_at, '%H%M%S%f') || '-Conversation/' || strftime(logged_at, '%Y%m%d') || '-' || {_safe('domain')} || '/' || strftime(logged_at, '%H%M%S%f') || '_' || {_safe("coalesce(nullif(qid, ''), 'no_qid')")} || '_tokens-' || {_USED} || '.json' AS path FROM tr"""))
def safe_filename(spark, d):
    """The time of the answer stands for the time of the run."""
    rows = evaluate.distinct_traces(table(spark, d, "traces"))
    at = F.col("logged_at")
    return rows.select("trace_id", A.safe_filename(F.col("domain")).alias("safe_domain"), A.trace_path(at, at, F.col("domain"), F.col("qid"), F.col("usage")).alias("path"))


_OPTIONS = "coalesce(array_to_string(list_transform(map_entries(options), lambda o: o.key || '. ' || coalesce(o.value, '') || chr(10)), ''), '')"
_HOW = "CASE answer_format " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in A.INSTRUCTIONS.items()) + f" ELSE '{A.OTHER_INSTRUCTION}' END"


@query(S.build("qs ch", f"""SELECT qid, CASE WHEN ev <> '' THEN chr(10) || chr(10) || '【证据材料】' || chr(10) || ev ELSE '' END || chr(10) || chr(10) || '【题目】' || chr(10) || coalesce(question, '') || chr(10) || chr(10) || '【选项】' || chr(10) || {_OPTIONS} || chr(10) || '【要求】' || chr(10)
    || CASE WHEN ev <> '' THEN '严格依据证据材料作答。' || chr(10) ELSE '' END || {_HOW} || chr(10) || chr(10) || '答案：' AS prompt
    FROM (SELECT q.*, coalesce(e.ev, '') AS ev FROM qs q LEFT JOIN (
        SELECT qid, string_agg('[证据' || i || ']' || chr(10) || 'doc_id: ' || doc_id || chr(10) || 'page: ' || chr(10) || 'text: ' || text, chr(10) || chr(10) ORDER BY i) AS ev FROM (
            SELECT qid, doc_id, text, row_number() OVER (PARTITION BY qid ORDER BY ord) AS i FROM (
                SELECT qid, n.doc_id, first.ord, substring(first.text, 1, 1200) AS text FROM (SELECT DISTINCT qid, unnest(doc_ids) AS doc_id FROM qs) n
                JOIN (SELECT doc_id, min(ord) AS ord, arg_min(text, ord) AS text FROM ch GROUP BY doc_id) first ON first.doc_id = n.doc_id)) GROUP BY qid) e ON e.qid = q.qid)"""))
def prompt_build(spark, d):
    """Prompts with the first chunk of each named document as evidence."""
    asked = questions(spark, d)
    first = corpus(spark, d).groupBy("doc_id").agg(F.min("ord").alias("ord"), F.min_by("text", "ord").alias("text"))
    named = asked.select("qid", F.explode("doc_ids").alias("doc_id")).distinct().join(first, "doc_id")
    items = F.array_sort(F.collect_list(F.struct("ord", "doc_id", F.lit(None).cast("int").alias("page"), F.substring("text", 1, retrieve.EVIDENCE_CHARS).alias("text"))))
    evidence = named.groupBy("qid").agg(A.evidence_text(items).alias("evidence"))
    return asked.join(evidence, "qid", "left").select("qid", A.build_prompt(F.col("question"), F.col("options"), F.col("evidence"), F.col("answer_format")).alias("prompt"))


@query(S.build("one idx", f"""SELECT i.doc_id, c.n AS n_chunks, c.chars AS char_count, coalesce(x.chunk_count, -1) AS stated_chunks, coalesce(x.char_count, -1) AS stated_chars FROM idx i JOIN (SELECT doc_id, count(*) AS n, CAST(sum(length({S.bare('text')})) AS BIGINT) AS chars FROM one GROUP BY doc_id) c ON c.doc_id = i.doc_id
    JOIN (SELECT doc_id, arg_max(chunk_count, (indexed_at, coalesce(chunk_count, -1))) AS chunk_count, max(char_count) AS char_count FROM document_index GROUP BY doc_id) x ON x.doc_id = i.doc_id WHERE c.n <> coalesce(x.chunk_count, -1) OR c.chars <> coalesce(x.char_count, -1)"""))
def index_check(spark, d):
    """Documents whose index states other numbers of chunks or characters than there are; an unstated one is -1."""
    one = table(spark, d, "chunks").select("chunk_id", "doc_id", "text").dropDuplicates(["chunk_id"])
    real = one.groupBy("doc_id").agg(F.count("*").alias("n_chunks"), F.sum(F.length(X.without_space("text"))).cast("long").alias("char_count"))
    stated = table(spark, d, "document_index").groupBy("doc_id").agg(
        F.max_by("chunk_count", F.struct("indexed_at", F.coalesce("chunk_count", F.lit(-1)))).alias("stated_chunks"), F.max("char_count").alias("stated_chars")
    )
    both = real.join(stated, "doc_id").withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("stated_chunks", "stated_chars")})
    return both.where("n_chunks != stated_chunks OR char_count != stated_chars")


@query(f"""SELECT strftime(date_trunc('hour', logged_at), '%Y-%m-%d %H:%M:%S') AS window_start, coalesce(domain, '') AS domain, count(*) AS n_traces, CAST(sum(coalesce(usage.input_tokens, 0)) AS BIGINT) AS prompt_tokens, CAST(sum(coalesce(usage.output_tokens, 0)) AS BIGINT) AS completion_tokens,
    CAST(sum(CASE WHEN coalesce(usage.total_tokens, 0) <> 0 THEN usage.total_tokens ELSE coalesce(usage.input_tokens, 0) + coalesce(usage.output_tokens, 0) END) AS BIGINT) AS total_tokens
    FROM (SELECT DISTINCT ON (trace_id) * FROM traces) WHERE logged_at IS NOT NULL GROUP BY ALL""")
def stream_token_windows(spark, d):
    """Tumbling windows of token use, by a stream."""
    return run_token_windows(spark, f"{d}/traces.parquet", "token_windows")


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
