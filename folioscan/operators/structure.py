"""From pages to a table of segments with their heading hierarchy.

Input is a table of pages (doc_id, page, text). Everything within a page is array expressions on its row; only
counts of repeated lines and the heading state cross pages, and they move no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import text as X
from folioscan.session import materialize

LEVELS = ("heading", "chapter", "section", "article", "part", "item", "subitem")
EDGE_LINES, EDGE_LENGTH, TOC_TITLE, TOC_LINES = 3, 6, "目录", 5


def with_lines(pages: DataFrame) -> DataFrame:
    """Pages with their lines, unless they bring them along."""
    return pages if "lines" in pages.columns else pages.withColumn("lines", X.split_lines("text"))


def repeated_edge_lines(pages: DataFrame) -> DataFrame:
    """(doc_id, edge, line, n): lines of at least 6 characters that repeat at the top or bottom of pages.

    The first page of a document is not looked at; a document of fewer than 3 pages has none. A line counts once for each
    of the 3 places at an edge where it stands, and must reach a third of the pages, at least 2.
    """
    spans = pages.groupBy("doc_id").agg(F.count("*").alias("n_pages"), F.min("page").alias("first_page"))
    edges = with_lines(pages).select("doc_id", "page", F.explode(F.array(
        F.struct(F.lit("header").alias("edge"), F.slice("lines", 1, EDGE_LINES).alias("at")),
        F.struct(F.lit("footer").alias("edge"), F.slice("lines", F.greatest(F.size("lines") - (EDGE_LINES - 1), F.lit(1)), EDGE_LINES).alias("at")),
    )).alias("e"))
    lines = edges.select("doc_id", "page", F.col("e.edge").alias("edge"), F.explode("e.at").alias("line")).where(F.length("line") >= EDGE_LENGTH)
    counted = lines.groupBy("doc_id", "edge", "line").agg(F.count("*").alias("n_all"), F.min("page").alias("least"))
    at_first = lines.join(spans.select("doc_id", F.col("first_page").alias("page")), ["doc_id", "page"]).groupBy("doc_id", "edge", "line").agg(F.count("*").alias("n_first"))
    return (
        counted.join(at_first, ["doc_id", "edge", "line"], "left").join(spans, "doc_id")
        .withColumn("n", F.col("n_all") - F.coalesce("n_first", F.lit(0)))
        .where((F.col("n_pages") >= 3) & (F.col("n") >= F.greatest(F.lit(2), F.floor(F.col("n_pages") / 3))))
        .select("doc_id", "edge", "line", "n")
    )


def strip_page_edges(pages: DataFrame) -> DataFrame:
    """Pages (doc_id, page, text, lines) without repeated edge lines and page markers at their top and bottom.

    A document has at most 9 repeated lines an edge, as each takes a third of 3 places a page.
    """
    repeated = repeated_edge_lines(pages).groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("edge") == "header", F.col("line"))).alias("headers"),
        F.collect_list(F.when(F.col("edge") == "footer", F.col("line"))).alias("footers"),
    )
    none = F.array().cast("array<string>")
    kept = lambda which: F.transform("lines", lambda x: ~(F.array_contains(F.coalesce(F.col(which), none), x) | X.is_page_marker(x)))
    start = F.array_position(kept("headers"), True)
    after = F.array_position(F.reverse(kept("footers")), True)
    end = F.size("lines") + 1 - after
    middle = F.when((start > 0) & (after > 0) & (end >= start), F.slice("lines", start.cast("int"), (end - start + 1).cast("int"))).otherwise(none)
    kept_lines = with_lines(pages).join(repeated, "doc_id", "left").select("doc_id", "page", middle.alias("lines"))
    return kept_lines.select("doc_id", "page", X.join_lines(F.col("lines")).alias("text"), "lines")


def is_toc_page(lines: Column) -> Column:
    """A line 目录 among the first five, or at least five lines of contents."""
    return F.exists(F.slice(lines, 1, 5), lambda x: x == TOC_TITLE) | (F.size(F.filter(lines, X.is_toc_line)) >= TOC_LINES)


def page_types(pages: DataFrame) -> DataFrame:
    """(doc_id, page, page_type, n_lines): empty, toc or content."""
    kind = F.when(~X.has_meaningful_text("text"), "empty").when(is_toc_page(F.col("lines")), "toc").otherwise("content")
    return with_lines(pages).select("doc_id", "page", kind.alias("page_type"), F.size("lines").alias("n_lines"))


def toc_entries(pages: DataFrame) -> DataFrame:
    """(doc_id, source_page, line_no, title, target_page) of the lines of contents that parse; page numbers beyond an int are null."""
    lines = with_lines(pages).where(is_toc_page(F.col("lines"))).select("doc_id", "page", F.posexplode("lines").alias("line_no", "line"))
    return (
        lines.where((F.col("line") != TOC_TITLE) & X.is_toc_line(F.col("line")) & X.normalize("line").rlike(X.TOC_ENTRY))
        .select("doc_id", F.col("page").alias("source_page"), "line_no", X.toc_title(F.col("line")).alias("title"), X.toc_target(F.col("line")).alias("target_page"))
    )


def segments(pages: DataFrame) -> DataFrame:
    """One row per segment of a content page, with its title, text and the headings above it.

    A segment starts at a heading or at the first line of a page, where a short line of letters is a heading too.
    Headings last until one of a higher level; one of the first line of a page ('heading') stands apart. A
    segment that starts without heading is titled by the deepest one. The running state (heading_state) is found over starts
    of segments only, without texts, which meet it again by page and segment.
    """
    content = with_lines(pages).where(X.has_meaningful_text("text") & ~is_toc_page(F.col("lines")))
    line = lambda i: F.element_at("lines", i)
    starts = F.filter(F.sequence(F.lit(1), F.size("lines")), lambda i: (i == 1) | X.heading_level(line(i)).isNotNull())
    spans = F.transform(starts, lambda s, k: F.struct(s.alias("first"), F.coalesce(F.get(starts, k + 1), F.size("lines") + 1).alias("next")))
    cut = content.where(F.size("lines") > 0).select("doc_id", "page", "lines", F.posexplode(spans).alias("segment", "at"))
    first = line(F.col("at.first"))
    level, generic = X.heading_level(first), (F.col("at.first") == 1) & X.is_generic_heading(first)
    cut = cut.select(
        "doc_id", "page", "segment",
        X.join_lines(F.slice("lines", F.col("at.first"), F.col("at.next") - F.col("at.first"))).alias("text"),
        F.coalesce(level, F.when(generic, "heading")).alias("level"), F.coalesce(X.heading_title(first), F.when(generic, first)).alias("own_title"),
    )
    cut = materialize(cut, "segments")  # read twice: with texts and without
    state = heading_state(cut.select("doc_id", "page", "segment", "level", "own_title"))
    return cut.select("doc_id", "page", "segment", "text").join(state, ["doc_id", "page", "segment"])


def heading_state(starts: DataFrame) -> DataFrame:
    """doc_id, page, segment, title and h_<level> of starts of segments (doc_id, page, segment, level, own_title).

    The state of headings is the last title and its place of each level, and two stretches of a document make one by taking the
    later of each. So starts lie in ranges of the document's order, the state after each range is an aggregate, a window over
    ranges (a row each) hands every range the state before it, and only within its range is a start looked at in order.
    """
    spark = starts.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = starts.repartitionByRange(ranges, "doc_id", "page", "segment").withColumn("block", F.spark_partition_id()).withColumn("place", F.struct("page", "segment"))
    rows = materialize(rows, "starts")
    mine = lambda name: F.when(F.col("level") == name, F.struct("place", F.col("own_title").alias("title")))
    after = rows.groupBy("doc_id", "block").agg(*(F.max_by(mine(n), F.when(F.col("level") == n, F.col("place"))).alias(f"s_{n}") for n in LEVELS))
    before = Window.partitionBy("doc_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = after.select("doc_id", "block", *(F.last(f"s_{n}", ignorenulls=True).over(before).alias(f"c_{n}") for n in LEVELS))
    so_far = Window.partitionBy("doc_id", "block").orderBy("page", "segment").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = rows.join(carried, ["doc_id", "block"])
    state = state.withColumns({f"x_{n}": F.coalesce(F.last(mine(n), ignorenulls=True).over(so_far), F.col(f"c_{n}")) for n in LEVELS})
    valid = {"heading": F.col("x_heading.title")}
    for i, name in enumerate(LEVELS[1:], start=1):
        above = [F.col(f"x_{h}.place") for h in LEVELS[1:i]]
        highest = F.greatest(*above) if len(above) > 1 else above[0] if above else F.lit(None)
        lasts = highest.isNull() | (F.col(f"x_{name}.place") > highest) if above else F.lit(True)
        valid[name] = F.when(lasts, F.col(f"x_{name}.title"))
    return state.select(
        "doc_id", "page", "segment", F.coalesce("own_title", *(valid[n] for n in reversed(LEVELS)), F.lit("")).alias("title"),
        *(valid[n].alias(f"h_{n}") for n in LEVELS),
    )


def build_documents(pages: DataFrame) -> DataFrame:
    """(doc_id, page_count, segment_count, char_count) after edges are stripped."""
    stripped = materialize(strip_page_edges(pages), "pages")
    counts = segments(stripped).groupBy("doc_id").agg(F.count("*").alias("segment_count"), F.sum(F.length("text")).alias("char_count"))
    return stripped.groupBy("doc_id").agg(F.count("*").alias("page_count")).join(counts, "doc_id", "left").select(
        "doc_id", "page_count", F.coalesce("segment_count", F.lit(0)).alias("segment_count"), F.coalesce("char_count", F.lit(0)).alias("char_count")
    )


def document_records(pages: DataFrame) -> DataFrame:
    """doc_id, page_count, toc, pages (page, page_type, segments of title, text, hierarchy and keywords) and char_count, a row a document.

    For documents that came as one file each; of larger ones segments() has the rows.
    """
    stripped = materialize(strip_page_edges(pages), "pages")
    above = F.filter(F.array(*(F.struct(F.lit(n).alias("key"), F.col(f"h_{n}").alias("value")) for n in LEVELS)), lambda x: F.coalesce(x["value"], F.lit("")) != "")
    segment = F.struct("title", "text", F.map_from_entries(above).alias("hierarchy"), F.transform(above, lambda x: x["value"]).alias("keywords"))
    # structs that hold maps have no order, so items are put in order by their numbers
    in_order = lambda numbered: F.transform(F.array_sort(F.map_keys(numbered)), lambda n: F.element_at(numbered, n))
    by_page = segments(stripped).groupBy("doc_id", "page").agg(F.map_from_entries(F.collect_list(F.struct("segment", segment.alias("s")))).alias("found"), F.sum(F.length("text")).alias("chars"))
    none = F.expr("cast(array() AS array<struct<title:string,text:string,hierarchy:map<string,string>,keywords:array<string>>>)")
    rows = page_types(stripped).join(by_page, ["doc_id", "page"], "left")
    listed = F.struct("page", "page_type", F.coalesce(in_order(F.col("found")), none).alias("segments"))
    made = rows.groupBy("doc_id").agg(
        F.count("*").alias("page_count"), F.map_from_entries(F.collect_list(F.struct("page", listed.alias("p")))).alias("by_page"), F.coalesce(F.sum("chars"), F.lit(0)).alias("char_count"),
    )
    made = made.withColumn("pages", in_order(F.col("by_page"))).drop("by_page")
    entry = F.struct("source_page", "line_no", "title", "target_page")
    toc = toc_entries(stripped).groupBy("doc_id").agg(F.array_sort(F.collect_list(entry)).alias("toc"))
    shown = F.transform(F.coalesce("toc", F.expr("cast(array() AS array<struct<source_page:int,line_no:int,title:string,target_page:int>>)")), lambda t: F.struct(t["title"].alias("title"), t["target_page"].alias("target_page"), t["source_page"].alias("source_page")))
    return made.join(toc, "doc_id", "left").select("doc_id", "page_count", shown.alias("toc"), "pages", "char_count")
