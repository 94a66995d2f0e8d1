"""Token counts, token ids and token budgets under a public tokenizer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.llm import bpe
from folioscan.llm.batches import apart, slices

DEFAULT_TOKENIZER = "byte_bpe_50k"
# Function words by which a language written in Latin letters is told.
FUNCTION_WORDS = {
    "en": "the of and to in is for by on with or shall be are from".split(),
    "fr": "le la les de des du et est une un pour par dans que sur au aux".split(),
}


def token_counts(df: DataFrame, text: str = "text", out: str = "n_tokens", vocabulary: str | None = None) -> DataFrame:
    """df without `text`, with the exact number of its tokens in `out` (long).

    Null and empty texts have 0 tokens; blank texts are encoded as they are. A column of df that is already
    named `out` is replaced. `vocabulary` is the path of a rank file (default: byte_bpe_50k).
    """
    path = vocabulary or bpe.tokenizer_file(DEFAULT_TOKENIZER)
    keep = [c for c in df.columns if c not in (text, out)]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.load(path)
        for batch in slices(batches, text):
            counts = model.count(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(counts, pa.int64())], [*keep, out])

    return df.select(*keep, text).mapInArrow(run, schema)


def token_ids(df: DataFrame, text: str = "text", out: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """df without `text`, with the ids of its tokens in `out` (array<int>), without special tokens.

    Null and empty texts get an empty list; blank texts are encoded as they are. A column of df that is
    already named `out` is replaced.
    """
    path = vocabulary or bpe.tokenizer_file(DEFAULT_TOKENIZER)
    keep = [c for c in df.columns if c not in (text, out)]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.load(path)
        for batch in slices(batches, text):
            ids, offsets = model.encode(batch.column(text).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists], [*keep, out])

    return df.select(*keep, text).mapInArrow(run, schema)


def decode_ids(df: DataFrame, ids: str = "ids", out: str = "text", vocabulary: str | None = None) -> DataFrame:
    """The way back from token_ids: texts of lists of ids; a null list gives a null text, an empty one an empty text."""
    path = vocabulary or bpe.tokenizer_file(DEFAULT_TOKENIZER)
    keep = [c for c in df.columns if c not in (ids, out)]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.load(path)
        for batch in batches:
            rows = batch.column(ids)
            sizes = np.array([0 if r is None else len(r) for r in rows], dtype=np.int64)
            flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = model.decode(flat, np.concatenate([[0], np.cumsum(sizes)]))
            column = pa.array([None if not v.is_valid else t for v, t in zip(rows, texts)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), column], [*keep, out])

    return df.select(*keep, ids).mapInArrow(run, schema)


def tidy_name(name: Column) -> Column:
    """One spelling of a source or domain: lower case, blanks and hyphens as underscores; null and blank are 'unknown'."""
    plain = F.regexp_replace(F.trim(F.lower(name)), "[ \\-]+", "_")
    return F.when(plain.isNull() | (plain == ""), "unknown").otherwise(plain)


def tidy_language(lang: Column) -> Column:
    """Primary tag in lower case; null, blank and undetermined are 'und'."""
    plain = F.element_at(F.split(F.trim(F.lower(lang)), "[-_]"), 1)
    return F.when(plain.isNull() | (plain == ""), "und").otherwise(plain)


def text_language(text: Column) -> Column:
    """zh where at least a fifth of the characters are Han characters, else the language of most function words, else und."""
    han = F.length(F.regexp_replace(text, "[^\\x{4e00}-\\x{9fff}]+", ""))
    found = [F.struct(F.regexp_count(F.lower(text), F.lit(rf"\b(?:{'|'.join(words)})\b")).alias("n"), F.lit(lang).alias("lang")) for lang, words in FUNCTION_WORDS.items()]
    most = F.greatest(*found)
    return F.when(han * 5 >= F.greatest(F.length(text), F.lit(1)), "zh").when(most["n"] > 0, most["lang"]).otherwise("und")


def latest_domains(index: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, domain): the last known domain of each document, whatever the order in which its states arrived."""
    return (
        index.where(F.col("domain").isNotNull())
        .groupBy(doc_id)
        .agg(F.max_by("domain", F.struct("indexed_at", "domain")).alias("domain"))
        .withColumn("domain", tidy_name(F.col("domain")))
    )


def token_budget(sized: DataFrame, dimensions: list[str], fixed: list[str]) -> DataFrame:
    """Totals over every subset of `dimensions`, apart for each value of `fixed`.

    sized: the dimensions and n_docs, n_chars, n_tokens. A dimension that is summed over is null and its bit in
    grouping_level is set (first dimension: highest bit); a null dimension of an input row must be named before.
    """
    sets = [[]]
    for d in dimensions:
        sets += [[*s, d] for s in sets]
    level = sum(F.grouping(d).cast("int") * (1 << (len(dimensions) - 1 - i)) for i, d in enumerate(dimensions))
    return sized.groupingSets([[F.col(c) for c in [*fixed, *s]] for s in sets], *fixed, *dimensions).agg(
        level.alias("grouping_level"),
        F.sum("n_docs").alias("n_docs"),
        F.sum("n_chars").alias("n_chars"),
        F.sum("n_tokens").alias("n_tokens"),
    )


def corpus_budget(documents: DataFrame, chunks: DataFrame, index: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Token totals by collection and every subset of source, language and domain.

    Documents carry their own source and language, and their index document's last known domain. Chunks (one
    per chunk_id, and each row without one) have source 'chunks', their document's domain, and the language of their text
    (text_language). Redelivered chunks are few and go after they are counted, so that no text is shuffled. Sums are
    formed before the join with domains, so that a document with very many rows arrives there as few.
    """
    sums = [F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"), F.sum("n_tokens").alias("n_tokens")]
    text_size = F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars")
    docs = token_counts(
        documents.select(
            F.lit("documents").alias("collection"), tidy_name(F.col("source")).alias("source"),
            tidy_language(F.col("lang")).alias("lang"), F.col("index_doc_id").alias("of"), text_size, "text",
        ),
        vocabulary=vocabulary,
    ).groupBy("collection", "source", "lang", "of").agg(*sums)
    parts = token_counts(
        chunks.select(
            "chunk_id", apart("chunk_id").alias("apart"), F.lit("chunks").alias("collection"), F.lit("chunks").alias("source"),
            text_language(F.col("text")).alias("lang"),
            F.col("doc_id").alias("of"), text_size, "text",
        ),
        vocabulary=vocabulary,
    )
    parts = (
        parts.groupBy("chunk_id", "apart").agg(*(F.max(c).alias(c) for c in parts.columns if c not in ("chunk_id", "apart")))
        .groupBy("collection", "source", "lang", "of").agg(*sums)
    )
    domains = latest_domains(index).withColumnRenamed("doc_id", "of")
    sized = (
        docs.unionByName(parts).join(domains, "of", "left")
        .groupBy("collection", "source", "lang", F.coalesce("domain", F.lit("unknown")).alias("domain"))
        .agg(*(F.sum(c).alias(c) for c in ("n_docs", "n_chars", "n_tokens")))
    )
    return token_budget(sized, ["source", "lang", "domain"], ["collection"])
