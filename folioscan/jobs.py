"""The jobs of the pipeline: raw files to documents, chunks and questions to evidence, prompts to answers.

Each reads and writes folders, so that it can be run by itself, and gives back what it wrote as a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.functions import answers as A
from folioscan.operators import chunking, evaluate, retrieve, structure
from folioscan.session import materialize
from folioscan.sources import files, json_tables, sinks

# --- raw files to documents -------------------------------------------------------------------------


@dataclass(frozen=True)
class ProcessConfig:
    """Where raw files lie (one folder a domain), which questions they are for, and where documents go."""

    raw_dir: str
    question_file: str
    output_dir: str
    prefer_txt: bool = True
    reader: Callable[[bytes], list[str]] = field(default=files.pdf_texts)

    @property
    def output_subdir(self) -> str:
        split, domain = files.output_layout(self.question_file)
        return f"{self.output_dir}/{split}/{domain}"

    def validate(self, spark: SparkSession) -> None:
        """K8: raw files and questions must be there."""
        for name, path in (("raw_dir", self.raw_dir), ("question_file", self.question_file)):
            if not files.exists(spark, path):
                raise FileNotFoundError(f"{name} not found: {path}")


def process(spark: SparkSession, config: ProcessConfig) -> DataFrame:
    """T4: documents of the raw files of a domain, a JSON file each below `documents`, and their index, which is given back.

    A document is one row, as its raw file is one value.
    """
    config.validate(spark)
    _, domain = files.output_layout(config.question_file)
    chosen = files.prefer_sources(files.scan_files(spark, f"{config.raw_dir}/{domain}"), config.prefer_txt)
    pages = files.extract_pages(chosen, config.reader)
    sources = chosen.select("doc_id", "path", F.col("suffix").alias("source_type"))
    records = structure.document_records(pages).join(sources, "doc_id").withColumn("domain", F.lit(domain))
    folder = config.output_subdir
    sinks.write_documents(materialize(records, "documents"), folder)
    return spark.read.json(f"{folder}/document_index", schema=sinks.INDEX)


# --- chunks and questions to evidence ------------------------------------------------------------------


def build_chunks(spark: SparkSession, roots: list[str], max_chars: int = chunking.MAX_CHARS) -> DataFrame:
    """Chunks of processed roots, each a folder with `documents`: those that documents bring along, and those of their pages.

    No chunks at all are an error.
    """
    documents = materialize(json_tables.load_documents(spark, [f"{r}/documents" for r in roots]), "documents")
    chunks = json_tables.chunks_of_documents(documents).unionByName(json_tables.chunks_of_pages(documents, max_chars), allowMissingColumns=True)
    chunks = materialize(chunks, "chunks")
    if chunks.isEmpty():
        raise ValueError(f"no chunks in {', '.join(roots)}: documents must have chunks[] or pages[].segments[]")
    return chunks


def generate_evidence(spark: SparkSession, chunks: DataFrame, question_files: list[str], output: str, top_k: int = retrieve.TOP_K) -> DataFrame:
    """The evidence of all questions of the files: qid, domain, split, candidate_doc_ids and evidence, written as JSON, a line each.

    chunks: as of search_chunks. Rows of one qid are one question.
    """
    questions = materialize(retrieve.distinct_questions(json_tables.load_questions(spark, question_files)), "questions")
    chunks = materialize(chunks, "chunks")
    candidates = materialize(retrieve.candidate_documents(questions, chunks), "candidates")
    by_question = retrieve.evidence_by_question(retrieve.fused_evidence(chunks, questions, top_k, candidates=candidates))
    documents = candidates.groupBy("qid").agg(F.sort_array(F.collect_list("doc_id")).alias("candidate_doc_ids"))  # named by one question
    rows = questions.select("qid", "domain", "split").join(documents, "qid", "left").join(by_question, "qid", "left")
    sinks.write_evidence(rows, output)
    return spark.read.json(output, schema=sinks.EVIDENCE)


# --- prompts to answers ----------------------------------------------------------------------------------


class Answerer(Protocol):
    """What answers prompts: requests (qid, domain, messages) get content, reasoning, usage and model; one row each."""

    def answer(self, requests: DataFrame) -> DataFrame: ...


REPLY = "content string, reasoning string, usage struct<input_tokens:bigint,output_tokens:bigint,total_tokens:bigint>, model string"


@dataclass(frozen=True)
class Replay:
    """Answers from recorded traces (qid, answer, reasoning, usage, model, logged_at, trace_id): of one qid the last.

    A question without a trace has a null content and no usage.
    """

    traces: DataFrame

    def answer(self, requests: DataFrame) -> DataFrame:
        at = F.struct("logged_at", "trace_id")
        reply = F.struct(F.col("answer").alias("content"), "reasoning", "usage", "model")
        last = self.traces.where(F.col("qid").isNotNull()).groupBy("qid").agg(F.max_by(reply, at).alias("reply"))
        return requests.join(last, "qid", "left").select(*requests.columns, "reply.*")


@dataclass(frozen=True)
class Client:
    """Answers by a function from a list of messages (role, content) to a reply (a dict of REPLY's fields), called by executors."""

    call: Callable[[list[dict]], dict]

    def answer(self, requests: DataFrame) -> DataFrame:
        keep, call = requests.columns, self.call
        names = [part.split(" ")[0] for part in ("content", "reasoning", "usage", "model")]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                replies = [call([m if isinstance(m, dict) else m.asDict() for m in messages]) for messages in batch["messages"]]
                yield batch.assign(**{n: [r.get(n) for r in replies] for n in names})[[*keep, *names]]

        kinds = ", ".join(f"`{c}` {requests.schema[c].dataType.simpleString()}" for c in keep)
        return requests.mapInPandas(run, f"{kinds}, {REPLY}")


def run_answers(questions: DataFrame, evidence: DataFrame, answerer: Answerer, output: str | None = None) -> DataFrame:
    """The ledger of answers: qid, answer, prompt, completion and total tokens, place; and, with `output`, the answer file.

    questions: in distinct rows; evidence: (qid, evidence text), which a question may lack. A reply may hold its reasoning
    in its content. The first row is the summary of all tokens.
    """
    prompt = A.build_prompt(F.col("question"), F.col("options"), F.col("evidence"), F.col("answer_format"))
    requests = questions.join(evidence, "qid", "left").select("qid", "domain", "answer_format", A.messages(prompt).alias("messages"))
    replies = answerer.answer(requests)
    said = A.reasoning_and_content(F.col("content"), F.col("reasoning"))
    usage = F.col("usage")
    rows = replies.select(
        "qid", A.parse_answer(said["answer"], F.col("answer_format")).alias("answer"), F.lit(None).cast("timestamp_ntz").alias("logged_at"), F.lit(0).alias("trace_id"),
        A.prompt_tokens(usage).alias("prompt_tokens"), A.completion_tokens(usage).alias("completion_tokens"), A.total_tokens(usage).alias("total_tokens"),
    )
    ledger = materialize(evaluate.token_ledger(rows), "ledger")
    if output:
        sinks.write_answers(ledger, output)
    return ledger


def answer_questions(spark: SparkSession, question_files: list[str], evidence_files: str, answerer: Answerer, output: str) -> DataFrame:
    """T9 from files: questions of several files, evidence of one folder."""
    questions = retrieve.distinct_questions(json_tables.load_questions(spark, question_files))
    return run_answers(questions, json_tables.load_evidence(spark, evidence_files), answerer, output)
