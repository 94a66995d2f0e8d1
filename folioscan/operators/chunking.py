"""Chunks for retrieval: from chunks that documents bring along, and from segments of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.functions.text import first_filled, let, normalize, text_of
from folioscan.operators.structure import LEVELS

MAX_CHARS, OVERLAP = 1400, 120


def split_long_text(text: Column, max_chars: int = MAX_CHARS, overlap: int = OVERLAP) -> Column:
    """overlapping parts of a normalized text as an array; an empty text has none.

    A part ends after the last 。 or ； of its window if that lies in the second half, else with the window; the next
    starts `overlap` characters before that end. All of it is one expression, without recursion.
    """
    if max_chars <= 2 * overlap or overlap < 0:
        raise ValueError("max_chars must exceed twice the overlap, or parts may not advance")

    def parts(plain: Column) -> Column:
        size = F.length(plain)
        steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(size / (max_chars // 2 - overlap + 1)).cast("int")))

        def step(state: Column, _: Column) -> Column:
            start = state["start"]
            window = F.substr(plain, start + 1, F.lit(max_chars))
            last = lambda mark: F.length(window) - F.coalesce(F.nullif(F.instr(F.reverse(window), mark), F.lit(0)), F.lit(max_chars + 1))
            cut = F.greatest(last("。"), last("；"))
            ends = start + max_chars >= size
            end = F.when(ends, size).when(cut > max_chars * 0.5, start + cut + 1).otherwise(start + max_chars)
            grown = let(end, lambda e: F.struct(
                F.when(ends, F.lit(-1)).otherwise(e - overlap).cast("int").alias("start"),
                F.concat(state["parts"], F.array(F.trim(F.substr(plain, start + 1, e - start)))).alias("parts"),
            ))
            return F.when(start < 0, state).otherwise(grown)

        none = F.struct(F.lit(0).alias("start"), F.array().cast("array<string>").alias("parts"))
        long = F.filter(F.aggregate(steps, none, step)["parts"], lambda p: p != "")
        return F.when(size > max_chars, long).when(size > 0, F.array(plain)).otherwise(F.array().cast("array<string>"))

    return let(normalize(text), parts)


def tidy_domain(domain: Column) -> Column:
    """One spelling of a domain: lower case, trimmed, blanks as underscores; null becomes empty."""
    return F.regexp_replace(F.trim(F.lower(text_of(domain))), " +", "_")


def latest_index(index: DataFrame) -> DataFrame:
    """One row per document: its domain, title and path as last known, by time of indexing and not of arrival."""
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("indexed_at", c))).alias(c)
    return index.groupBy("doc_id").agg(last("domain"), last("title"), last("source_markdown_path"))


def search_chunks(chunks: DataFrame, index: DataFrame) -> DataFrame:
    """Chunks ready for search: ord, chunk_id, doc_id, domain, text, original_text, source_path.

    Rows of one chunk_id are one chunk. text is the normalized retrieval text, or where that is null or empty the text;
    chunks without any are left out. A chunk without domain takes its document's; spellings are made one.
    """
    known = latest_index(index).select("doc_id", F.col("domain").alias("known_domain"), F.col("source_markdown_path").alias("source_path"))
    one = chunks.select("ord", "chunk_id", "doc_id", "domain", "text", "retrieval_text").dropDuplicates(["chunk_id"])
    searched = normalize(first_filled(F.col("retrieval_text"), F.col("text")))
    return (
        one.withColumn("search_text", searched).where("search_text != ''")
        .join(known, "doc_id", "left")
        .select(
            "ord", "chunk_id", "doc_id", tidy_domain(first_filled(F.col("domain"), F.col("known_domain"))).alias("domain"),
            F.col("search_text").alias("text"), F.col("text").alias("original_text"), "source_path",
        )
    )


def split_segments(segments: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """Chunks of segments (doc_id, page, segment, title, text, above, keywords and others, which are kept).

    Headings above, title, keywords and text, normalized, without empty ones, are put together and split; above and keywords
    are arrays. A segment without text has none. chunk_id is doc:p<page>:s<segment>:c<part>.
    """
    words = lambda c: normalize(F.array_join(F.transform(F.filter(c, lambda x: x != ""), normalize), " "))
    whole = F.concat_ws("\n", *(F.when(c != "", c) for c in (words("above"), normalize("title"), words("keywords"), normalize("text"))))
    keep = [c for c in segments.columns if c not in ("above", "keywords", "text")]
    parts = segments.where(normalize("text") != "").select(*keep, normalize("text").alias("original_text"), F.posexplode(split_long_text(whole, max_chars)).alias("part", "text"))
    return parts.withColumn("chunk_id", F.format_string("%s:p%d:s%d:c%d", "doc_id", "page", "segment", "part"))


def chunks_from_segments(segments: DataFrame, domain: Column, max_chars: int = MAX_CHARS) -> DataFrame:
    """Chunks of segments as structure.segments has them; the headings above are the keywords too."""
    above = F.array(*(F.coalesce(F.col(f"h_{n}"), F.lit("")) for n in LEVELS))
    rows = segments.select("doc_id", domain.alias("domain"), "page", "segment", "title", "text", above.alias("above"), above.alias("keywords"))
    return split_segments(rows, max_chars)
