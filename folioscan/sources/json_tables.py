"""JSON interchange: chunks under aliased names, questions, evidence, documents, traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.functions.answers import evidence_text
from folioscan.functions.text import first_filled, normalize
from folioscan.operators import chunking

# Names under which a field may come, first come first.
ALIASES = {
    "text": ("text", "content", "chunk_text", "paragraph"),
    "doc_id": ("doc_id", "document_id", "source"),
    "chunk_id": ("chunk_id", "id"),
    "domain": ("domain", "category"),
}
QUESTION = "qid string, domain string, split string, question string, options map<string,string>, answer_format string, type string, doc_ids array<string>"
CHUNK = (
    "chunk_id string, doc_id string, domain string, chunk_index int, title_path array<string>, section_title string, context_before string, "
    "text string, retrieval_text string, line_start int, line_end int, char_count int"
)
SEGMENT = "title string, text string, hierarchy map<string,string>, keywords array<string>"
DOCUMENT = (
    "doc_id string, domain string, path string, metadata struct<doc_id:string,domain:string,title:string,source_markdown_path:string,source_relative_path:string>, "
    "source_type string, page_count int, char_count bigint, toc array<struct<title:string,target_page:int,source_page:int>>, "
    "chunks array<struct<{}>>, pages array<struct<page:int,page_type:string,segments:array<struct<{}>>>>"
).format(*(", ".join(f.strip().replace(" ", ":", 1) for f in _split) for _split in (CHUNK.split(", "), SEGMENT.split(", "))))
TRACE = (
    "timestamp timestamp, messages array<struct<role:string,content:string>>, answer string, reasoning string, "
    "usage struct<input_tokens:bigint,output_tokens:bigint,total_tokens:bigint>, model string, qid string, domain string, evidence string"
)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, idx, item): the JSON items of files with one on each line, which are read in splits; idx follows the order of lines."""
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("idx"), F.col("value").alias("item"))
    return read.where("item != ''")


def _items(spark: SparkSession, path: str | list[str], keys: tuple[str, ...], lines: bool = False) -> DataFrame:
    """(path, idx, item): the JSON items of files that hold a list, or an object with a list under one of keys; or, with lines, one on each line.

    A file that holds a list is one value; what may be large is kept as lines, which are read in splits.
    """
    if lines:
        return _lines(spark, path)
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.trim(F.regexp_replace("value", r"^\x{feff}|\s+$", "")).alias("value"))
    as_list = F.from_json("value", T.ArrayType(T.StringType()))
    nested = F.from_json("value", T.StructType([T.StructField(k, T.ArrayType(T.StringType())) for k in keys]))
    under = F.coalesce(*(nested[k] for k in keys))
    items = F.when(F.ltrim("value").startswith("["), as_list).otherwise(under)
    checked = F.when(items.isNull(), F.raise_error(F.concat(F.lit("unsupported format: "), "path")).cast("array<string>")).otherwise(items)
    return whole.select("path", F.posexplode(checked).alias("idx", "item"))


def aliased(df: DataFrame, idx: str = "idx") -> DataFrame:
    """Idx, chunk_id, doc_id, domain and normalized text from columns under any of the aliases; rows without text go.

    Of several aliases the first that is neither null nor empty counts; a missing chunk_id is doc_id#idx.
    """
    have = {c.lower() for c in df.columns}
    pick = lambda field: first_filled(*([F.col(a).cast("string") for a in ALIASES[field] if a in have] or [F.lit(None).cast("string")]))
    doc_id = F.coalesce(pick("doc_id"), F.lit(""))
    rows = df.select(
        F.col(idx).alias("idx"), F.coalesce(pick("chunk_id"), F.concat(doc_id, F.lit("#"), F.col(idx).cast("string"))).alias("chunk_id"),
        doc_id.alias("doc_id"), F.coalesce(pick("domain"), F.lit("")).alias("domain"), normalize(pick("text")).alias("text"),
    )
    return rows.where("text != ''")


def load_chunks(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """Chunks of JSON files, with ord (file, then place) and metadata (the item as JSON, P10); items that are no objects are skipped but counted."""
    items = _items(spark, path, ("chunks", "data"), lines).where(F.ltrim("item").startswith("{"))
    fields = sorted({a for names in ALIASES.values() for a in names})
    parsed = items.select("path", "idx", "item", *(F.get_json_object("item", f"$.{f}").alias(f) for f in fields))
    chunks = aliased(parsed.withColumn("idx", F.struct("path", "idx", "item")).drop("path", "item").withColumnRenamed("idx", "place").withColumn("idx", F.col("place.idx")), "place")
    default = F.when(F.col("chunk_id").contains("#{"), F.concat("doc_id", F.lit("#"), F.col("idx.idx").cast("string"))).otherwise(F.col("chunk_id"))
    return chunks.select(F.struct("idx.path", "idx.idx").alias("ord"), default.alias("chunk_id"), "doc_id", "domain", "text", F.col("idx.item").alias("metadata"))


def load_questions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Questions of one or several JSON files that hold a list, or an object with `questions` or `data`."""
    items = _items(spark, path, ("questions", "data"))
    return items.select(F.from_json("item", QUESTION).alias("q")).select("q.*")


def load_traces(spark: SparkSession, path: str) -> DataFrame:
    """Traces, one JSON object a file."""
    return spark.read.schema(TRACE).option("multiLine", True).option("recursiveFileLookup", True).json(path)


def load_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Processed documents of one or several folders, one JSON object a file, of either shape; doc_id falls back to the metadata and the file's stem."""
    docs = spark.read.schema(DOCUMENT).option("multiLine", True).json(path).withColumn("processed_path", F.col("_metadata.file_path"))
    stem = F.regexp_extract("processed_path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    return docs.withColumn("doc_id", F.coalesce(first_filled(F.col("doc_id"), F.col("metadata.doc_id")), stem)).withColumn(
        "domain", F.coalesce(first_filled(F.col("domain"), F.col("metadata.domain")), F.regexp_extract("processed_path", "([^/]*)/documents/[^/]*$", 1))
    )


def chunks_of_documents(documents: DataFrame) -> DataFrame:
    """The chunks that documents bring along; those without retrieval text and text are left out."""
    rows = documents.select("doc_id", "domain", "processed_path", F.posexplode("chunks").alias("chunk_index", "c"))
    text = normalize(first_filled(F.col("c.retrieval_text"), F.col("c.text")))
    return rows.select(
        F.coalesce(first_filled(F.col("c.chunk_id")), F.concat("doc_id", F.lit(":c"), F.col("chunk_index").cast("string"))).alias("chunk_id"),
        F.coalesce(first_filled(F.col("c.doc_id")), F.col("doc_id")).alias("doc_id"), F.coalesce(first_filled(F.col("c.domain")), F.col("domain")).alias("domain"),
        text.alias("text"), F.col("c.text").alias("original_text"), "processed_path", "chunk_index",
    ).where("text != ''")


def chunks_of_pages(documents: DataFrame, max_chars: int = chunking.MAX_CHARS) -> DataFrame:
    """The chunks of the segments of documents' pages, numbered by page, segment and part."""
    rows = documents.select("doc_id", "domain", "processed_path", F.explode("pages").alias("p"))
    rows = rows.select("doc_id", "domain", "processed_path", F.col("p.page").alias("page"), F.posexplode("p.segments").alias("segment", "s"))
    flat = rows.select("doc_id", "domain", "processed_path", "page", "segment", "s.title", "s.text", F.map_values("s.hierarchy").alias("above"), "s.keywords")
    return chunking.split_segments(flat, max_chars)


def load_evidence(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(qid, evidence): evidence texts of JSON files; of rows with one qid the last counts."""
    item = "struct<qid:string,evidence:array<struct<doc_id:string,text:string,page:string,metadata:struct<page:string>>>>"
    rows = _items(spark, path, ("evidence",), lines).select(F.struct("path", "idx").alias("at"), F.from_json("item", item).alias("e"))
    blocks = F.transform("e.evidence", lambda c: F.struct(c["doc_id"].alias("doc_id"), F.coalesce(c["metadata"]["page"], c["page"]).alias("page"), c["text"].alias("text")))
    return rows.groupBy("e.qid").agg(F.max_by(evidence_text(blocks), "at").alias("evidence"))


def nested(value: Column, *keys: str | int) -> Column:
    """what lies below keys (of objects) and places (of lists) of a JSON value, or null where there is no such place."""
    path = "$" + "".join(f"[{k}]" if isinstance(k, int) else f"['{k}']" for k in keys)
    return F.get_json_object(value, path)


def to_plain(value: Column) -> Column:
    """a nested value as JSON; null fields are left out."""
    return F.to_json(value)
