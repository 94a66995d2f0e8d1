"""Sinks: documents, chunks, evidence, answers and traces."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.functions.answers import trace_path


# What the sinks write, for readers.
INDEX = "doc_id string, domain string, source_path string, output_path string, page_count bigint, char_count bigint, source_type string"
EVIDENCE = (
    "qid string, domain string, split string, candidate_doc_ids array<string>, evidence array<struct<rank:int,doc_id:string,page:int,chunk_id:string,domain:string,"
    "text:string,score:double,source:string,query_source:string,option:string,matched_terms:array<string>>>"
)


def write_each(rows: DataFrame, folder: str) -> int:
    """Every row (path, content) as a file of its own below a folder that all executors reach; how many there are.

    content is text or bytes; null writes an empty file. A task that is run again writes the same files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        made: set[str] = set()
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                path = f"{base}/{name}"
                parent = path.rpartition("/")[0]
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(path) as file:
                    file.write(content.encode("utf-8") if isinstance(content, str) else content or b"")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return rows.select("path", "content").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def write_documents(documents: DataFrame, folder: str) -> DataFrame:
    """K1, K2: each document (document_records with domain, path and source_type) as `documents/<doc_id>.json`, and the index of them as JSON lines."""
    names = ["doc_id", "domain", "path", "page_count", "toc", "pages", "char_count", "source_type"]
    name = F.concat(F.lit("documents/"), "doc_id", F.lit(".json"))
    write_each(documents.select(name.alias("path"), F.to_json(F.struct(*names)).alias("content")), folder)
    index = documents.select(
        "doc_id", "domain", F.col("path").alias("source_path"), F.concat(F.lit(f"{folder}/"), name).alias("output_path"), "page_count", "char_count", "source_type"
    )
    index.write.mode("overwrite").json(f"{folder}/document_index")
    return index


def write_chunks(chunks: DataFrame, path: str) -> None:
    """K3: as JSON lines, as load_chunks reads them with `lines`."""
    chunks.write.mode("overwrite").json(path)


def write_evidence(by_question: DataFrame, path: str) -> None:
    """K5: one JSON object per question."""
    by_question.write.mode("overwrite").json(path)


def write_answers(ledger: DataFrame, path: str) -> None:
    """K6: one CSV file: the header, the summary, then the questions; a row per question, so it is small beside the corpus."""
    rows = ledger.orderBy("place", "qid").select("qid", "answer", "prompt_tokens", "completion_tokens", "total_tokens")
    rows.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_traces(traces: DataFrame, folder: str) -> int:
    """K7: each trace (run_time, timestamp and the fields of a trace) as a JSON file named by run, domain, question and tokens; how many there are."""
    name = trace_path(F.col("run_time"), F.col("timestamp"), F.col("domain"), F.col("qid"), F.col("usage"))
    fields = [c for c in traces.columns if c != "run_time"]
    return write_each(traces.select(name.alias("path"), F.to_json(F.struct(*fields)).alias("content")), folder)
