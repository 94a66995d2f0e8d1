"""Text functions as column expressions: no Python runs per row, all of it stays in generated code.

Every function takes and gives Columns. Null texts count as empty unless said otherwise; lengths and places are in
code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Everything that counts as white space, in Java's syntax: Unicode white space and the four separators of ASCII.
SPACE = r"(?U)[\s\x1c-\x1f]+"
#: Line ends: LF, CR, CRLF, VT, FF, FS, GS, RS, NEL, LS, PS.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}]"

# Patterns that must match as in the reference behaviour.
TERM_RUN = r"[\x{4e00}-\x{9fff}A-Za-z0-9%％]{2,}"
HAN = r"[\x{4e00}-\x{9fff}]"
STOPWORDS = ["关于", "以下", "下列", "正确", "错误", "的是", "根据", "结合", "假设", "分别", "需要", "应当", "进行", "其中"]
NUMERAL = "一二三四五六七八九十百零〇0-9"
HEADINGS = {
    "chapter": rf"^(第[{NUMERAL}]+章)(?U:\s*)(.+)?$",
    "section": rf"^(第[{NUMERAL}]+节)(?U:\s*)(.+)?$",
    "article": rf"^(第[{NUMERAL}]+条)(?U:\s*)(.+)?$",
    "part": r"^([一二三四五六七八九十]+、)(?U:\s*)(.+)$",
    "item": r"^(（[一二三四五六七八九十]+）)(?U:\s*)(.+)$",
    "subitem": r"^((?U:\d+)[、.])(?U:\s*)(.+)$",
}
PAGE_MARKER = r"^(?U:\d+(-\d+)+|[IVXLCivxlc]+|第?\d+页)$"
GENERIC_HEADING = r"^[\x{4e00}-\x{9fff}A-Za-z（）()“”‘’《》\-]+$"
TOC_DOTS, TOC_NUMBER = r"[.。…]{3,}", r"(?U)\d+$"
TOC_HEADING = rf"(?U)(第[{NUMERAL}]+[章节条]|[一二三四五六七八九十]+、).+\d+$"
TOC_ENTRY = r"(?U)(.+?)[.。…\s]+(\d+)$"


def text_of(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty, or null."""
    return F.coalesce(*(F.when(c != "", c) for c in columns))


def let(value: Column, body) -> Column:
    """body(value), with value computed once: inside a lambda an expression is computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize(column: Column | str) -> Column:
    """runs of white space as one space, none at the ends; null becomes empty."""
    return F.trim(F.regexp_replace(text_of(column), SPACE, " "))


def without_space(column: Column | str) -> Column:
    return F.regexp_replace(text_of(column), SPACE, "")


def clean_text(column: Column | str) -> Column:
    """full-width and no-break spaces as spaces, runs of blanks as one, at most one empty line, trimmed."""
    plain = F.regexp_replace(F.translate(text_of(column), "　\u00a0", "  "), r"[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(plain, r"\n{3,}", "\n\n"), r"^(?U)[\s\x1c-\x1f]+|(?U)[\s\x1c-\x1f]+$", "")


def strip(column: Column) -> Column:
    return F.regexp_replace(column, r"^(?U)[\s\x1c-\x1f]+|(?U)[\s\x1c-\x1f]+$", "")


def split_lines(column: Column | str) -> Column:
    """the stripped lines that are not blank, in order."""
    return F.filter(F.transform(F.split(text_of(column), LINE_END), strip), lambda x: x != "")


def join_lines(lines: Column) -> Column:
    """F4."""
    return strip(F.array_join(lines, "\n"))


def is_page_marker(line: Column) -> Column:
    """1-2, a Roman number, or 第3页; a bare number is none."""
    return without_space(line).rlike(PAGE_MARKER)


def is_generic_heading(line: Column) -> Column:
    """1 to 20 letters, Han characters or brackets, without digits and punctuation; no page marker."""
    bare = without_space(line)
    return F.length(bare).between(1, 20) & ~bare.rlike(PAGE_MARKER) & ~bare.rlike(r"(?U)[，。；：,.!?\d]") & bare.rlike(GENERIC_HEADING)


def has_meaningful_text(column: Column | str) -> Column:
    """at least two characters besides white space."""
    return F.length(without_space(column)) >= 2


def is_toc_line(line: Column) -> Column:
    """F8: leader dots and a number at the end, or a numbered heading that ends in a number."""
    bare = without_space(line)
    return (line.rlike(TOC_DOTS) & bare.rlike(TOC_NUMBER)) | bare.rlike(TOC_HEADING)


def heading_level(line: Column) -> Column:
    """the first level whose pattern matches, or null."""
    return F.coalesce(*(F.when(line.rlike(p), F.lit(level)) for level, p in HEADINGS.items()))


def heading_title(line: Column) -> Column:
    """number and title with one space between, or null."""
    whole = [F.when(line.rlike(p), strip(F.concat(strip(F.regexp_extract(line, p, 1)), F.lit(" "), strip(F.regexp_extract(line, p, 2))))) for p in HEADINGS.values()]
    return F.coalesce(*whole)


def toc_title(line: Column) -> Column:
    """the title of a table-of-contents line, or an empty text if it does not parse."""
    return strip(F.regexp_extract(normalize(line), TOC_ENTRY, 1))


def toc_target(line: Column) -> Column:
    """its page number, null if it has none or too large a one."""
    return F.regexp_extract(normalize(line), TOC_ENTRY, 2).try_cast("int")


def term_runs(column: Column | str) -> Column:
    return F.regexp_extract_all(normalize(column), F.lit(TERM_RUN), F.lit(0))


def tokenize(column: Column | str) -> Column:
    """lower-case runs of Han characters, letters and digits; of runs longer than 2 with Han characters also all pairs and triples.

    Stop words are dropped; repeats are kept, in order of runs.
    """

    def grams(run: Column) -> Column:
        # looked at, not consumed: one match at each character, in time linear in the run
        pieces = lambda n: F.regexp_extract_all(run, F.lit(f"(?=({'.' * n}))"), F.lit(1))
        return F.when(run.rlike(HAN) & (F.length(run) > 2), F.concat(F.array(run), pieces(2), pieces(3))).otherwise(F.array(run))

    runs = F.regexp_extract_all(F.lower(normalize(column)), F.lit(TERM_RUN), F.lit(0))
    stop = F.expr(f"array({', '.join(map(repr, STOPWORDS))})")
    return F.filter(F.flatten(F.transform(runs, grams)), lambda t: ~F.array_contains(stop, t))


def unique_terms(terms: Column) -> Column:
    """normalized, not empty, each at its first place."""
    return F.filter(F.array_distinct(F.transform(terms, normalize)), lambda t: t != "")


def compact(column: Column) -> Column:
    """Normalized and without spaces."""
    return F.replace(normalize(column), F.lit(" "), F.lit(""))


def matched_in(bare: Column, terms: Column, most: int = 20) -> Column:
    """the terms contained in a text that is compact, both without spaces; the first `most`. Terms must be normalized."""
    return F.slice(F.filter(terms, lambda t: (t != "") & F.contains(bare, F.replace(t, F.lit(" "), F.lit("")))), 1, most)


def matched_terms(text: Column, terms: Column, most: int = 20) -> Column:
    """matched_in for a text as it stands."""
    return let(compact(text), lambda whole: matched_in(whole, terms, most))
