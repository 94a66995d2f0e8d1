"""Raw files: scan, preference among sources of one document, text and PDF pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscan.functions.text import clean_text

SUFFIXES = ("txt", "pdf")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def with_name(paths: DataFrame, path: str = "path") -> DataFrame:
    """doc_id (file stem) and suffix (lower case) of each path."""
    name = F.regexp_extract(path, "([^/]*)$", 1)
    return paths.withColumn("doc_id", F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")).withColumn("suffix", F.lower(F.regexp_extract(name, r"(?<=.)\.([^.]*)$", 1)))


def empty_files(spark: SparkSession, folder: str) -> DataFrame:
    """path and content of the empty files below a folder, which a scan leaves out; a task lists them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            if batch.num_rows:
                system, base = fs.FileSystem.from_uri(folder)
                found = system.get_file_info(fs.FileSelector(base, recursive=True))
                paths = [f.path for f in found if f.type == fs.FileType.File and f.size == 0]
                yield pa.RecordBatch.from_arrays([pa.array([folder.removesuffix(base) + p for p in paths], pa.string()), pa.array([b""] * len(paths), pa.binary())], ["path", "content"])

    return spark.range(1, numPartitions=1).mapInArrow(run, "path string, content binary")


def scan_files(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """Path, doc_id, suffix and content of the files below a folder with one of the suffixes, in any case."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "content")
    return with_name(found.unionByName(empty_files(spark, folder))).where(F.col("suffix").isin(*suffixes))


def prefer_sources(files: DataFrame, prefer_txt: bool = True, path: str = "path") -> DataFrame:
    """One row per doc_id: the first by path, but with prefer_txt a text file before all others."""
    kind = F.when(F.col("suffix") == "txt", 0).otherwise(1) if prefer_txt else F.lit(0)
    order = Window.partitionBy("doc_id").orderBy(kind, path)
    return files.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def text_pages(files: DataFrame) -> DataFrame:
    """S3: a text file is one page, number 1, of its cleaned UTF-8 text."""
    return files.where("suffix = 'txt'").select("doc_id", F.lit(1).alias("page"), clean_text(F.decode("content", "UTF-8")).alias("text"))


def pdf_texts(content: bytes) -> list[str]:
    """The text layer of a PDF's pages, by pypdf."""
    try:
        from pypdf import PdfReader
    except ImportError as missing:
        raise ImportError("reading PDF needs pypdf, or another reader passed as `reader`") from missing
    import io

    return [page.extract_text() or "" for page in PdfReader(io.BytesIO(content)).pages]


def pdf_pages(files: DataFrame, reader: Callable[[bytes], list[str]] = pdf_texts) -> DataFrame:
    """Pages from 1 of the text layer; `reader` gives the texts of a file's pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(d, i, t) for d, c in zip(batch["doc_id"], batch["content"]) for i, t in enumerate(reader(bytes(c)), 1)]
            yield pd.DataFrame(rows, columns=["doc_id", "page", "text"])

    pages = files.where("suffix = 'pdf'").select("doc_id", "content").mapInPandas(run, "doc_id string, page int, text string")
    return pages.withColumn("text", clean_text("text"))


def extract_pages(files: DataFrame, reader: Callable[[bytes], list[str]] = pdf_texts) -> DataFrame:
    """Pages of all files; another suffix is an error."""
    checked = files.withColumn("suffix", F.when(F.col("suffix").isin(*SUFFIXES), F.col("suffix")).otherwise(F.raise_error(F.concat(F.lit("unsupported file type: "), "path"))))
    return text_pages(checked).unionByName(pdf_pages(checked, reader))


def read_pages(spark: SparkSession, folder: str, prefer_txt: bool = True, reader: Callable[[bytes], list[str]] = pdf_texts) -> DataFrame:
    """Pages of the preferred file of every document below a folder."""
    return extract_pages(prefer_sources(scan_files(spark, folder), prefer_txt), reader)


def output_layout(question_file: str) -> tuple[str, str]:
    """K8: split and domain of a question file: its folder, and its stem without `_questions`."""
    parts = question_file.replace("\\", "/").rstrip("/").split("/")
    stem = parts[-1].rpartition(".")[0] or parts[-1]
    return parts[-2] if len(parts) > 1 else "", stem.removesuffix("_questions")
