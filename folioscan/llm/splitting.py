"""Splitting oversized text at natural boundaries.

A text starts as atomic segments: paragraphs, lines, sentences, clauses, words, and, where none of these is
small enough, runs of characters. Neighbouring segments are merged, those with the weakest boundary between
them first and the smallest of equals, while both together and the overlap fit the limit. What boundaries remain
are the strongest that the limit allows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.llm.batches import apart, slices
from folioscan.llm.unify import WHITE_SPACE

MAX_CHARS = 1400
OVERLAP = 120

_RUN = re.compile(f"[{WHITE_SPACE}]+")
#: Ends of atomic segments, strongest first: 5 paragraph (blank line) or heading, 4 line, 3 sentence, 2 clause, 1 word; a run of white space is told apart by its line breaks.
_END = re.compile(f"(?P<s1>[{WHITE_SPACE}]+)|(?P<s3>[。！？；!?;]+[”’」』）)\"']*|\\.(?=[{WHITE_SPACE}]))|(?P<s2>[，、：,:]+)")
_BREAK = re.compile(r"\r\n|\n|\r")
_HEADING = re.compile(r"第[一二三四五六七八九十百零〇0-9]+[章节条]|[一二三四五六七八九十]+、|（[一二三四五六七八九十]+）|#{1,6} ")


def squeezed(text: str) -> str:
    """Each run of white space as one character (a line feed where the run holds one), none at the ends."""
    return _RUN.sub(lambda m: "\n" if "\n" in m[0] or "\r" in m[0] else " ", text).strip(" \n")


def squeezed_length(text: Column) -> Column:
    """Characters of a text once each run of white space counts as one and none is left at the ends."""
    return F.length(F.trim(F.regexp_replace(text, f"[{WHITE_SPACE}]+", " ")))


def segments(text: str, room: int) -> list[tuple[int, int, int]]:
    """Atomic segments (start, end, strength of the boundary at the end), none longer than room."""
    out, start = [], 0
    ends = []
    for m in _END.finditer(text):
        breaks = list(_BREAK.finditer(m[0])) if m.lastgroup == "s1" else []
        if breaks:  # indentation stays with its line
            strength = 5 if len(breaks) > 1 or _HEADING.match(text, m.end()) else 4
            ends.append((m.start() + breaks[-1].end(), strength))
        else:
            ends.append((m.end(), int(m.lastgroup[1])))
    if not ends or ends[-1][0] < len(text):
        ends.append((len(text), 5))
    for end, strength in ends:
        while end - start > room:  # no boundary within: cut between characters
            out.append((start, start + room, 0))
            start += room
        if end > start:
            out.append((start, end, strength))
            start = end
    return out


def pieces(text: str, limit: int = MAX_CHARS, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of consecutive pieces of a text as it stands, each at most limit - overlap characters (one piece: limit)."""
    if len(text) <= limit:
        return [(0, len(text))] if text else []
    room = limit - overlap
    parts = segments(text, room)
    n = len(parts)
    start, end, strength = ([p[i] for p in parts] for i in range(3))
    after, before, alive, version = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n, [0] * n
    heap: list[tuple] = []

    def offer(i: int) -> None:
        """The boundary between segment i and the next, if both fit together."""
        j = after[i]
        if j < n and end[j] - start[i] <= room:
            heapq.heappush(heap, (strength[i], end[j] - start[i], i, version[i], version[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, _, i, mine, next_ = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or version[i] != mine or version[j] != next_:
            continue
        end[i], strength[i], after[i], alive[j] = end[j], strength[j], after[j], False
        version[i] += 1
        version[j] += 1
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [(start[i], end[i]) for i in range(n) if alive[i]]


def split_oversized(df: DataFrame, id_col: str = "chunk_id", text: str = "text", keep: list[str] = (),
                    limit: int = MAX_CHARS, overlap: int = OVERLAP, stored: bool = False) -> DataFrame:
    """One row per piece of every record whose squeezed text, or with `stored` whose text as stored, is longer than limit.

    id, `keep`, piece (from 0), n_pieces, piece_text, core_start and core_end (the piece without its overlap).
    Boundaries are looked for in the stored text, and pieces are cut from it, white space and all. A piece after the first starts with the last `overlap` characters (or all) of the one before.
    Null, empty and short texts have no rows. Rows with one id are one record; each row without id is one of its own.
    """
    if not 0 <= overlap * 2 < limit:
        raise ValueError("limit must exceed twice the overlap, and overlap must not be negative")
    keep = [c for c in keep if c not in (id_col, text)]
    outs = ["piece", "n_pieces", "piece_text", "core_start", "core_end"]
    schema = T.StructType(
        [df.schema[c] for c in [id_col, *keep]]
        + [T.StructField(c, T.StringType() if c == "piece_text" else T.IntegerType()) for c in outs]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            rows: list[tuple] = []
            of: list[int] = []
            for i, raw in enumerate(batch.column(text).to_pylist()):
                cut, previous = pieces(raw, limit, overlap), ""
                for k, (a, b) in enumerate(cut):
                    previous = (previous[-overlap:] if overlap and k else "") + raw[a:b]
                    rows.append((k, len(cut), previous, a, b))
                    of.append(i)
            made = [pa.array([r[i] for r in rows], pa.string() if i == 2 else pa.int32()) for i in range(5)]
            kept = batch.take(pa.array(of, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in [id_col, *keep]), *made], [id_col, *keep, *outs])

    # a text that is short as it stands needs no closer look
    long_texts = df.select(id_col, *keep, text).where(F.length(text) > limit)
    if not stored:
        long_texts = long_texts.where(squeezed_length(F.col(text)) > limit)
    one = long_texts.withColumn("_apart", apart(id_col)).groupBy(id_col, "_apart").agg(*(F.first(c).alias(c) for c in [*keep, text]))
    return one.mapInArrow(run, schema)
