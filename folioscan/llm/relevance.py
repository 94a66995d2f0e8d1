"""How characteristic a term is of a record, compared with the whole collection.

Terms are weighted by probabilistic relevance: the logarithm of the odds of not meeting the term in a record, times a
term frequency that saturates and is set against the record's length. Document frequencies, the number of
records and their average length are taken over all records.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.llm.batches import apart, slices
from folioscan.session import materialize

K1, B = 1.5, 0.75
#: Terms whose document frequencies are broadcast, the most frequent first, and how long they may be.
HEAD_TERMS, HEAD_CHARS = 50_000, 64

_ASCII_RUN = re.compile(r"[A-Za-z0-9-]+")
_WORD = re.compile(r"[^\W_]+")
_HAN = re.compile(r"[㐀-䶿一-鿿]+")


def codes(text: str) -> list[str]:
    """Maximal runs of ASCII letters, digits and hyphens with 2 to 6 letters, at most one hyphen and 4 digits or more, upper case."""
    out = []
    for run in _ASCII_RUN.findall(text):
        hyphens = run.count("-")
        digits = sum(map(run.count, "0123456789")) if hyphens < 2 else 0
        if digits >= 4 and 2 <= len(run) - digits - hyphens <= 6:
            out.append(run.upper())
    return out


def words(text: str) -> list[str]:
    """Codes, words in lower case, and for runs of Han characters their pairs (a single one stands alone)."""
    out = codes(text)
    whole = {c.lower() for c in out}
    for run in _WORD.findall(text.lower()):
        at = 0
        for m in _HAN.finditer(run):
            if m.start() > at:
                out.append(run[at : m.start()])
            han = m[0]
            out += [han] if len(han) == 1 else [han[i : i + 2] for i in range(len(han) - 1)]
            at = m.end()
        if at < len(run):
            out.append(run[at:])
    return [t for t in out if t not in whole]


EXTRACTORS = {"code": codes, "word": words}


def record_terms(df: DataFrame, id_col: str, fields: list[str], terms: str) -> DataFrame:
    """(id, length, terms, tfs): one row per row of df, of its text in compatibility normal form.

    length is the number of its terms, however long; a row without terms has empty arrays.
    """
    extract = EXTRACTORS[terms]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, fields[0], 1 << 20):
            names: list[str] = []
            tfs: list[int] = []
            ends, lengths = [0], []
            for values in zip(*(batch.column(c).to_pylist() for c in fields)):
                text = "\n".join(v for v in values if v)
                if not text.isascii():
                    text = unicodedata.normalize("NFKC", text)
                found = Counter(extract(text))
                lengths.append(found.total())
                names += found.keys()
                tfs += found.values()
                ends.append(len(names))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(lengths, pa.int32()), pa.ListArray.from_arrays(at, pa.array(names, pa.string())), pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32()))],
                [id_col, "length", "terms", "tfs"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, *fields).mapInArrow(run, f"`{id_col}` {kind}, length int, terms array<string>, tfs array<int>")


def scored_terms(df: DataFrame, id_col: str = "chunk_id", fields: list[str] = ("text",), terms: str = "word",
                 k1: float = K1, b: float = B, head: int = HEAD_TERMS) -> tuple[DataFrame, DataFrame]:
    """(scored, records): record, id, term, tf, df, n, idf and score of every term of every record; and record, id.

    Null and empty fields add no terms, and a record without terms still counts in the collection. Rows of one id are
    one record (they are taken to be equal), each row without id is one of its own. Records are numbered, so that postings
    can carry a number for the id. The number of records and their average length are one row, which is broadcast. Document
    frequencies are partial counts first; those of the `head` most frequent terms, a bounded table, are broadcast, so that
    hot terms are scored where they lie, and the postings of all other terms meet theirs in a shuffle by term.
    """
    if terms == "code":  # few terms: copies are dropped after them
        rows = record_terms(df, id_col, list(fields), terms).withColumn("_apart", apart(id_col))
        one = rows.groupBy(id_col, "_apart").agg(*(F.first(c).alias(c) for c in ("length", "terms", "tfs"))).drop("_apart")
    else:
        one = record_terms(df.withColumn("_apart", apart(id_col)).groupBy(id_col, "_apart").agg(*(F.first(c).alias(c) for c in fields)), id_col, list(fields), terms)
    records = materialize(one.withColumn("record", F.monotonically_increasing_id()), "records")
    collection = records.agg(F.count("*").alias("n"), F.avg("length").alias("mean"))
    posted = records.select("record", id_col, "length", F.explode(F.arrays_zip("terms", "tfs")).alias("p")).select(
        "record", id_col, "length", F.col("p.terms").alias("term"), F.col("p.tfs").alias("tf")
    )
    frequency = posted.groupBy("term").agg(F.count("*").alias("df"))
    if head:
        frequency = materialize(frequency, "frequency")
        often = materialize(frequency.where(F.length("term") <= HEAD_CHARS).orderBy(F.desc("df"), "term").limit(head), "often")
        seldom = posted.join(F.broadcast(often), "term", "left_anti").join(frequency.hint("shuffle_hash"), "term")
        met = posted.join(F.broadcast(often), "term").unionByName(seldom)
    else:
        met = posted.join(frequency.hint("shuffle_hash"), "term")
    tf = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    scored = met.crossJoin(F.broadcast(collection)).withColumn("idf", weight_of(F.col("df"), F.col("n")))
    return scored.select("record", id_col, "term", "tf", "df", "n", "idf", (F.col("idf") * tf).alias("score")), records.select("record", id_col)


def weight_of(df: Column, n: Column) -> Column:
    """The relevance weight of a term that df of n records hold; it falls as df grows."""
    return F.log1p((n - df + 0.5) / (df + 0.5))


def record_scores(df: DataFrame, id_col: str, fields: list[str], head: int = HEAD_TERMS) -> DataFrame:
    """Every term of every record with its score (6 places): id, term, tf, df, score. Nothing is ranked or cut."""
    scored, _ = scored_terms(df, id_col, fields, head=head)
    return scored.select(id_col, "term", "tf", "df", F.round("score", 6).alias("score"))


def characteristic_terms(df: DataFrame, id_col: str, fields: list[str], k: int = 10) -> DataFrame:
    """A report: only the k highest-scored terms of each record, ties by term: id, rank (from 1), term, tf, df, score."""
    scored, records = scored_terms(df, id_col, fields)
    best = Window.partitionBy("record").orderBy(F.desc("score"), "term")
    top = scored.select("record", "term", "tf", "df", "score").withColumn("score", F.round("score", 6)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.join(records, "record").select(id_col, "rank", "term", "tf", "df", "score")


def shared_codes(df: DataFrame, id_col: str = "chunk_id", field: str = "retrieval_text", otherwise: str = "text", low: int = 2, high: int = 8) -> DataFrame:
    """(id, term) of the codes that low to high records hold, of `field`, or of `otherwise` where that is null or empty.

    A view of the scored codes: those whose relevance weight lies between the weights of half a record less than low and half a
    record more than high, and which have a score.
    """
    chosen = df.select(id_col, F.coalesce(F.when(F.col(field) != "", F.col(field)), F.col(otherwise)).alias("_text"))
    scored, records = scored_terms(chosen, id_col, ["_text"], "code")
    least, most = (weight_of(F.lit(edge), F.col("n")) for edge in (high + 0.5, low - 0.5))
    shared = scored.where((F.col("idf") > least) & (F.col("idf") < most) & (F.col("score") > 0))
    return shared.select("record", "term").join(records, "record").select(id_col, "term")
