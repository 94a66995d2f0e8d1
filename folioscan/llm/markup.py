"""Markup residue: token streams, clean text that keeps structure, and wrappers of hosts.

A text is read as a stream of markup tokens and lines of text by one grammar of HTML, Markdown, wiki and LaTeX. The
stream serves three ends: a text without markup tokens is left alone, others are written out as clean text in one plain
notation, and the streams of all texts of a host are aligned into its wrapper, a regular expression without unions
(module wrappers). Texts are read by the wrapper of their host: markup residue is what the wrapper has as markup, and
what it shows to be the host's template is taken out of its texts when they are cleaned.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.entities import html5

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.llm import wrappers as W
from folioscan.llm.batches import slices
from folioscan.session import materialize

# Elements and commands that are markup even without attributes, end tags or arguments, and attributes without value.
ELEMENTS = (
    "a abbr address article aside audio b base bdi bdo blockquote body br button canvas caption center cite code col "
    "colgroup data dd del details dfn div dl dt em embed fieldset figcaption figure font footer form gallery h1 h2 h3 "
    "h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark math meta nav noscript "
    "nowiki object ol optgroup option p param picture pre q ref references rp rt ruby s samp script section select "
    "small source span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time "
    "title tr tt u ul var video wbr"
).split()
BARE_ATTRIBUTES = "allowfullscreen async autofocus autoplay checked compact controls default defer disabled hidden ismap loop multiple muted noshade novalidate nowrap open readonly required reversed selected".split()
COMMANDS = (
    "alpha beta gamma delta epsilon varepsilon zeta eta theta vartheta iota kappa lambda mu nu xi pi varpi rho varrho sigma "
    "varsigma tau upsilon phi varphi chi psi omega Gamma Delta Theta Lambda Xi Pi Sigma Upsilon Phi Psi Omega "
    "sum prod int frac sqrt leq geq neq approx times cdot infty partial left right begin end item hline par newline newpage "
    "noindent centering label ref cite maketitle tableofcontents ldots dots quad qquad text mathrm emph textbf textit "
    "underline section subsection subsubsection paragraph chapter footnote caption includegraphics url href "
    "LaTeX TeX bf it rm sf tt em sc sl to nabla"
).split()

_VALUE = r"\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s\"'<>]+)"
_ATTRIBUTE = rf"\s+(?:[A-Za-z_:][\w:.-]*{_VALUE}|(?i:{'|'.join(BARE_ATTRIBUTES)})(?=[\s/>]))"
_QUOTED = r"\s+[A-Za-z_:][\w:.-]*\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*')"
_PUNCTUATION = r"\s!-/:-@\[-`{-~，。；：、！？（）《》“”‘’…—"
_ROW = r"[ \t]*\|(?!\|)[^|\n]*(?:\|[^|\n]*)+\|[ \t]*$"
_TARGET = r"\(\s*(?:(?=[^()\s]*[A-Za-z/\#])[^()\s]*[./\#:][^()\s]*(?:\s+\"[^\"\n]*\")?|(?:[A-Za-z0-9_-]*[A-Za-z][A-Za-z0-9_-]*)?)\s*\)"
GRAMMAR = {
    "path": r"(?<![A-Za-z])[A-Za-z]:(?:\\[\w.\-~\u4e00-\u9fff]+)+\\?(?![{\w])|(?:(?<=[\s(（“\"])|^)\\\\[\w.$-]+(?:\\[\w.$-]+)+",
    "html_comment": r"<!--",
    "html_declaration": r"<!(?i:doctype)\s[^<>]*>|<\?[A-Za-z][^<>?]*\?>|<!\[CDATA\[",
    "html_tag": rf"</?(?i:{'|'.join(sorted(ELEMENTS, key=len, reverse=True))})(?:{_ATTRIBUTE})*\s*/?>"
    rf"|</?[A-Za-z][\w.-]*:[A-Za-z][\w.-]*(?:{_ATTRIBUTE})*\s*/?>|<[A-Za-z][\w-]*(?:{_QUOTED})+\s*/?>|</[A-Za-z][\w-]*\s*>|<[A-Za-z][\w-]*\s*/>",
    "html_reference": r"&(?:[A-Za-z][A-Za-z0-9]{1,31}|\#[0-9]{1,7}|\#[xX][0-9A-Fa-f]{1,6});",
    "md_fence": r"^[ \t>]*(?:```|~~~)[^\n`]*$|```",
    "md_code": r"`[^`\n]+`",
    "wiki_table": r"^[ \t]*\{\|[^\n]*|^[ \t]*\|\}|^[ \t]*\|-[^\n|]*$",
    "md_table": rf"^[ \t>]*\|?[ \t]*:?-{{2,}}:?[ \t]*(?:\|[ \t]*:?-{{2,}}:?[ \t]*)+\|?[ \t]*$|^(?=[ \t]*\|[ \t]){_ROW}|^{_ROW}(?=\n{_ROW})|(?<=\|\n){_ROW}",
    "md_heading": r"^ {0,3}\#{1,6}[ \t]+(?=\S)",
    "md_setext": r"(?:\A|(?<=\n\n))(?![ \t]*[|>\#=*+\-])[^\n|]{0,99}[^\s|。；，,;]\n(?:={3,}|-{3,})[ \t]*$",
    "md_quote": r"^ {0,3}>(?![=\d])",
    "wiki_heading": r"^(?P<eq>={2,6})[ \t]*[^=\s][^\n]*?(?P=eq)[ \t]*$",
    "md_footnote": r"\[\^[^\[\]\n]+\]:?",
    "wiki_link": r"\[\[[^\[\]\n]*\]\]|\[https?://[^\[\]\s]+[^\[\]\n]*\]",
    "md_image": r"!\[[^\[\]\n]*\]\([^)\n]*\)",
    "md_link": rf"\[[^\[\]\n]*\]{_TARGET}|<https?://[^\s<>]+>",
    "md_reference": r"^ {0,3}\[[^\[\]\n^]+\]:[ \t]*(?:https?://|[./\#])\S*|\[[^\[\]\n]+\]\[[A-Za-z][\w-]{2,}\]",
    "wiki_template": r"\{\{[^{}]+\}\}",
    "wiki_magic": r"__[A-Z]{2,}__",
    "wiki_emphasis": r"(?P<ap>'{2,5})(?!')[^'\n]+(?P=ap)",
    "md_strong": r"\*\*(?![\s*])[^*\n]+\*\*|(?<![\w_])__(?![\s_])[^_\n]+__(?![\w_])",
    "md_strike": r"~~[^~\n]+~~",
    "latex_display": r"\\\[(?:(?!\\[\[\]])[\s\S])*\\\]|\\\((?:(?!\\[()])[^\n])*\\\)|\$\$[^$]+\$\$",
    "latex_inline": r"\$(?![\s\d])(?=[^$\n]*[\\^_={])[^$\n]*[^\s$]\$|\$[A-Za-z]\$",
    "latex_command": rf"\\(?:[A-Za-z]+\*?(?:\[[^\[\]\n]*\])?(?=\{{)|(?:{'|'.join(sorted(COMMANDS, key=len, reverse=True))})(?![A-Za-z]))"
    r"|(?<![\w\\.:/])\\(?![ntr]|u[0-9A-Fa-f]{4}|x[0-9A-Fa-f]{2})[A-Za-z]{2,}(?![\w\\.])",
    "md_emphasis": rf"(?<![*A-Za-z0-9)\]])\*(?![*{_PUNCTUATION}])[^*\n]*[^*\s]\*(?![*A-Za-z0-9(])|(?:(?<=[{_PUNCTUATION}])|^)(?<![*)\]])\*(?![\s*])[^*\n]*[^*\s]\*(?![*A-Za-z0-9(])|(?<!\w)_(?![\s_])[^_\n]+_(?!\w)",
}
_TOKEN = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern in GRAMMAR.items()), re.MULTILINE)
#: Without one of these characters there is no token.
_SIGNS = re.compile(r"[<&`|\[{*~\\$]|^ {0,3}[>#]|^-{3}|==|''|(?<![A-Za-z0-9])_", re.MULTILINE)


def tokens(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the markup tokens of a text, from left to right."""
    if not _SIGNS.search(text):
        return []
    out = []
    at = 0
    while m := _TOKEN.search(text, at):
        kind = m.lastgroup
        if kind == "html_reference" and m[0][1] != "#" and m[0][1:] not in html5:
            at = m.start() + 1
            continue
        if kind != "path":
            out.append((kind, m.start(), m.end()))
        at = max(m.end(), m.start() + 1)
    return out


#: Tokens that are part of a line of text; other tokens are nodes of a stream.
_INLINE = {"html_reference"}
_NAME = re.compile(r"</?([A-Za-z][\w.:-]*)|\\([A-Za-z]+)|\{\{\s*([^\s|{}]*)|^[ \t]*(\#+|=+)")


def symbol(kind: str, piece: str) -> str:
    """The node of a markup token: a tag, a command, a template or a heading by name, others by kind."""
    m = _NAME.match(piece)
    if m and kind == "html_tag":
        return f"<{'/' if piece[1] == '/' else ''}{m[1].lower()}>"
    if m and kind == "latex_command":
        return f"\\{m[2]}"
    if m and kind == "wiki_template":
        return "{{" + re.sub(r"[()+*?\"#\s]", "_", m[3])
    if m and kind in ("md_heading", "wiki_heading"):
        return f"{kind}{len(m[4])}"
    return kind


def stream(text: str, found: list[tuple[str, int, int]], literals: bool = True) -> list[tuple[str, int, int]]:
    """(symbol, start, end) of the nodes of a text: its markup tokens, and the lines of text between them, which are slots without `literals`."""
    out = []
    at = 0
    for kind, start, end in [*((k, a, b) for k, a, b in found if k not in _INLINE), ("", len(text), len(text))]:
        for line in re.finditer(r"[^\n]*[^\s][^\n]*", text[at:start]):
            out.append((W.literal(line[0]) if literals else W.SLOT, at + line.start(), at + line.end()))
        if kind:
            out.append((symbol(kind, text[start:end]), start, end))
        at = end
    return out


# --- clean text -------------------------------------------------------------------------------------

_FENCE = re.compile(r"^[ \t>]*(?:```|~~~)[^\n`]*\n([\s\S]*?)^[ \t>]*(?:```|~~~)[ \t]*$|<pre[^<>]*>((?:(?!<pre)[\s\S])*?)</pre>", re.MULTILINE)
_VERBATIM = re.compile(r"\\begin\{(?:verbatim|lstlisting)\}\n?((?:(?!\\begin\{)[\s\S])*?)\\end\{(?:verbatim|lstlisting)\}")
_FORMULA = re.compile(f"{GRAMMAR['latex_display']}|{GRAMMAR['latex_inline']}|" r"\\begin\{(equation|align)\*?\}(?:(?!\\begin\{)[\s\S])*?\\end\{\1\*?\}")
_TABULAR = re.compile(r"\\begin\{tabular\}(?:\{[^{}\n]*\})?((?:(?!\\begin\{tabular\})[\s\S])*?)\\end\{tabular\}")
_WIKI_TABLE = re.compile(r"^[ \t]*\{\|[^\n]*\n((?:(?!^[ \t]*\{\|)[\s\S])*?)^[ \t]*\|\}", re.MULTILINE)
_DELIMITER_ROW = re.compile(r"^[ \t>]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*\n?", re.MULTILINE)
_SETEXT = re.compile(GRAMMAR["md_setext"], re.MULTILINE)
_TAG = re.compile(GRAMMAR["html_tag"])
_OTHER_TAG = re.compile(r"<([A-Za-z][\w-]*)>")
_MARK = re.compile("\ue000(\\d+)\ue001")
_BRACE = re.compile(r"\\([A-Za-z]+)\*?(?:\[[^\[\]\n]*\])?\{|[{}]")
# Commands of layout with what stands for them; other bare commands of the list above are signs of formulas.
_LAYOUT = {
    "noindent": "", "centering": "", "maketitle": "", "tableofcontents": "", "newpage": "\n", "hline": "", "par": "\n", "newline": "\n", "ldots": "…", "dots": "…", "quad": " ", "qquad": " ",
    "bf": "", "it": "", "rm": "", "sf": "", "tt": "", "em": "", "sc": "", "sl": "", "LaTeX": "LaTeX", "TeX": "TeX",
}
_BARE = re.compile(rf"\\({'|'.join(sorted(COMMANDS, key=len, reverse=True))})(?![A-Za-z{{])(?:\{{\}})?[ \t]*")
_SECTION_DEPTH = {"chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4}
#: Commands whose argument is no text.
_SILENT = {"cite", "citep", "citet", "label", "ref", "eqref", "pageref", "includegraphics", "vspace", "hspace", "bibliography", "bibliographystyle", "usepackage", "documentclass"}


class Held:
    """Parts of a text that no rule may touch, each behind a mark; characters of marks that a text has of its own are such parts."""

    def __init__(self, text: str):
        self.parts: list[str] = []
        self.text = re.sub("[\ue000\ue001]+", lambda m: self.hold(m[0]), text)

    def hold(self, content: str) -> str:
        self.parts.append(content)
        return f"\ue000{len(self.parts) - 1}\ue001"

    def written(self, text: str, last=lambda piece: piece) -> str:
        """text with the parts behind its marks, `last` done to all else. A part has marks of earlier parts only, so this ends."""
        done: list[str] = []

        def restored(piece: str, limit: int) -> str:
            return _MARK.sub(lambda m: done[int(m[1])] if int(m[1]) < limit else m[0], piece)

        for i, part in enumerate(self.parts):
            done.append(restored(part, i))
        out, at = [], 0
        for m in _MARK.finditer(text):
            if int(m[1]) < len(done):
                out += [last(text[at : m.start()]), done[int(m[1])]]
                at = m.end()
        return "".join([*out, last(text[at:])])


def _without_comments(text: str) -> str:
    """Closed comments go, and the mark of one that is not closed; linear, however many are not."""
    out, at = [], 0
    while (start := text.find("<!--", at)) >= 0:
        out.append(text[at:start])
        end = text.find("-->", start + 4)
        if end < 0:
            return "".join(out) + text[start:].replace("<!--", "")
        at = end + 3
    return "".join(out) + text[at:]


def _row(cells: list[str]) -> str:
    return "| " + " | ".join(c.strip() for c in cells) + " |"


def _tabular(m: re.Match) -> str:
    rows = [r.replace("\\hline", "").strip() for r in re.split(r"\\\\", m[1])]
    return "\n" + "\n".join(_row(r.split("&")) for r in rows if r) + "\n"


def _wiki_rows(m: re.Match) -> str:
    rows: list[list[str]] = [[]]
    for line in m[1].split("\n"):
        line = line.strip()
        if line.startswith("|-"):
            rows.append([])
        elif line.startswith(("|", "!")):
            rows[-1] += re.split(r"\|\||!!", line[1:])
        elif line and rows[-1]:
            rows[-1][-1] += " " + line
    return "\n" + "\n".join(_row(r) for r in rows if r) + "\n"


def _tag_text(m: re.Match) -> str:
    name = re.match(r"</?([A-Za-z0-9]+)", m[0])[1].lower()
    closing = m[0].startswith("</")
    if re.fullmatch(r"h[1-6]", name):
        return "\n" if closing else "\n" + "#" * int(name[1]) + " "
    if name in ("li", "dt", "dd"):
        return "" if closing else "\n- "
    if name in ("td", "th"):
        return " |" if closing else " "
    if name == "tr":
        return "\n" if closing else "\n|"
    if name == "blockquote":
        return "\n"
    if name == "code":
        return "`"
    if name in ("p", "div", "br", "hr", "table", "ul", "ol", "dl", "section", "article", "caption", "figure"):
        return "\n"
    return ""


def _command_text(name: str, content: str) -> str:
    if name in _SECTION_DEPTH:
        return f"\n{'#' * _SECTION_DEPTH[name]} {content.strip()}\n"
    if name in ("begin", "end"):
        return "\n"
    return "" if name in _SILENT else f"（{content}）" if name == "footnote" else content


def _without_commands(text: str) -> str:
    """Commands with arguments as their text, however deep they are nested; braces that do not close stay. One pass."""
    open_: list[tuple[str | None, str]] = []  # command (None: a plain brace) and its sign as written
    held: list[list[str]] = [[]]
    at = 0
    for m in _BRACE.finditer(text):
        held[-1].append(text[at : m.start()])
        at = m.end()
        if m[0] != "}":
            open_.append((m[1], m[0]))
            held.append([])
        elif not open_:
            held[-1].append("}")
        else:
            (name, _), content = open_.pop(), "".join(held.pop())
            if name is None:
                switch = re.match(r"\\(?:bf|it|rm|sf|tt|em|sc|sl|large|small|footnotesize|bfseries|itshape)(?![A-Za-z])\s*", content)
                held[-1].append(content[switch.end() :] if switch else "{" + content + "}")
            else:
                held[-1].append(_command_text(name, content))
                at += name in _SILENT and text[at : at + 1] == "~"
    held[-1].append(text[at:])
    while open_:
        _, sign = open_.pop()
        content = "".join(held.pop())
        held[-1] += [sign, content]
    return "".join(held[0])


def clean(text: str) -> str:
    """Text without markup, in one notation: `# ` headings, `- ` list items, `| a | b |` rows, fenced code, `$...$` formulas.

    Marks of emphasis, links, references, comments and magic words go, their words stay; categories and files go. A text
    without markup tokens is returned as it is.
    """
    if not tokens(text):
        return text
    held = Held(text)
    hold, out = held.hold, held.text
    # also tags and references that were escaped, however often
    out = re.sub(r"&(?:amp;)+(?=(?:\#\w+|[A-Za-z]\w+);)", "&", out)
    out = re.sub(r"&lt;(/?[A-Za-z][^&<>\n]*?|!--.*?--)&gt;", r"<\1>", out)
    out = _without_comments(out)
    out = _FENCE.sub(lambda m: "\n" + hold("```\n" + (m[1] or m[2] or "").strip("\n") + "\n```") + "\n", out)
    out = _VERBATIM.sub(lambda m: "\n" + hold("```\n" + m[1].strip("\n") + "\n```") + "\n", out)
    out = re.sub(r"`[^`\n]+`", lambda m: hold(m[0]), out)
    out = re.sub(GRAMMAR["path"], lambda m: hold(m[0]), out, flags=re.MULTILINE)
    out = _FORMULA.sub(lambda m: hold("$" + re.sub(r"^(?:\\\[|\\\(|\$\$?)|(?:\\\]|\\\)|\$\$?)$", "", m[0]).strip() + "$"), out)
    out = _TABULAR.sub(_tabular, out)
    out = _WIKI_TABLE.sub(_wiki_rows, out)
    out = _DELIMITER_ROW.sub("", out)
    # LaTeX
    out = re.sub(r"\\item(?![A-Za-z])\s*", "\n- ", out)
    out = re.sub(r"\\(href|textcolor|colorbox)\{[^{}]*\}(?=\{)", r"\\text", out)
    out = re.sub(r"(\\begin\{[^{}\n]*\})(?:\[[^\[\]\n]*\])?", r"\1", out)
    out = _BARE.sub(lambda m: m[0] if m[1] in _LAYOUT or m[1] == "item" else hold(f"${m[0].strip()}$") + m[0][len(m[0].rstrip()) :], out)
    out = _without_commands(out)
    out = _BARE.sub(lambda m: _LAYOUT.get(m[1], "") + (m[0][len(m[0].rstrip()) :] if m[1].endswith("TeX") else ""), out)
    # wiki
    out = re.sub(r"\[\[(?:Category|File|Image|分类|文件)[:：][^\[\]\n]*\]\]", "", out, flags=re.IGNORECASE)
    out = re.sub(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]\n]*)\]\]", r"\1", out)
    out = re.sub(r"\[https?://\S+?(?:\s+([^\[\]\n]*))?\]", lambda m: m[1] or "", out)
    out = re.sub(r"\{\{([^{}|]*)\|?([^{}]*)\}\}", lambda m: " ".join(m[2].replace("|", " ").split()), out)
    out = re.sub(GRAMMAR["wiki_magic"], "", out)
    out = re.sub(r"^(={2,6})[ \t]*([^=\s][^\n]*?)[ \t]*\1[ \t]*$", lambda m: "#" * (len(m[1]) - 1) + " " + m[2], out, flags=re.MULTILINE)
    out = re.sub(r"('{2,5})(?!')([^'\n]+)\1", r"\2", out)
    # Markdown
    out = _SETEXT.sub(lambda m: ("# " if m[0].rstrip()[-1] == "=" else "## ") + m[0].split("\n")[0], out)
    out = re.sub(r"!\[([^\[\]\n]*)\]\([^)\n]*\)", r"\1", out)
    out = re.sub(GRAMMAR["md_footnote"], "", out)
    out = re.sub(rf"\[([^\[\]\n]*)\]{_TARGET}", r"\1", out)
    out = re.sub(r"^ {0,3}\[[^\[\]\n^]+\]:[ \t]*(?:https?://|[./\#])\S*[^\n]*\n?", "", out, flags=re.MULTILINE)
    out = re.sub(r"\[([^\[\]\n]+)\]\[[A-Za-z][\w-]{2,}\]", r"\1", out)
    out = re.sub(r"^ {0,3}(?:> ?)+(?![=\d])", "", out, flags=re.MULTILINE)
    out = re.sub(r"~~([^~\n]+)~~", r"\1", out)
    out = re.sub(r"\*\*(?![\s*])([^*\n]+)\*\*", r"\1", out)
    out = re.sub(GRAMMAR["md_emphasis"], lambda m: m[0][1:-1], out, flags=re.MULTILINE)
    # HTML
    out = re.sub(GRAMMAR["html_declaration"], "", out)
    closed = {m[1].lower() for m in re.finditer(r"</([A-Za-z][\w-]*)\s*>", out)}
    out = _TAG.sub(_tag_text, out)
    if closed:
        out = _OTHER_TAG.sub(lambda m: "" if m[1].lower() in closed else m[0], out)
    out = held.written(re.sub(r"[ \t]+\n", "\n", out), html.unescape)
    return re.sub(r"\n{3,}", "\n\n", out).strip()


def without_template(text: str, found: list[tuple[str, int, int]], literals: list[str]) -> tuple[str, int]:
    """The text without the lines that are its host's template, in their order, and how many they were."""
    out, at, n = [], 0, 0
    left = iter(literals)
    want = next(left, None)
    for name, start, end in stream(text, found) if literals else []:
        if name == want:
            out.append(text[at:start])
            at, n, want = end, n + 1, next(left, None)
    return "".join(out) + text[at:], n


# --- operators ------------------------------------------------------------------------------------------


def markup_streams(df: DataFrame, id_col: str = "chunk_id", text: str = "text") -> DataFrame:
    """(id, kinds, n_tokens) of every row: its markup token kinds in order of appearance; null texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = [tokens(t) if t else [] for t in batch.column(text).to_pylist()]
            kinds = pa.array([list(dict.fromkeys(k for k, _, _ in f)) for f in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(id_col), kinds, pa.array([len(f) for f in found], pa.int32())], [id_col, "kinds", "n_tokens"])

    schema = T.StructType([df.schema[id_col], T.StructField("kinds", T.ArrayType(T.StringType())), T.StructField("n_tokens", T.IntegerType())])
    return df.select(id_col, text).mapInArrow(run, schema)


def with_markup(df: DataFrame, id_col: str = "chunk_id", text: str = "text") -> DataFrame:
    """(id): records whose stream has a markup token; rows of one id are one record."""
    return markup_streams(df, id_col, text).where("n_tokens > 0").select(id_col).distinct()


def host_wrappers(texts: DataFrame, host: str = "host", text: str = "text", fan: int = 64) -> DataFrame:
    """(host, wrapper, n_texts, nodes): the wrapper of each host from (host, text), one row per text; nodes is its stored form.

    The streams of a host are aligned where they lie, batch by batch, so what is shuffled are wrappers; those of a host are
    aligned in groups of about `fan`, round by round until one is left, so no task holds all of a host. Null hosts are a
    host. A text without nodes (null, empty, blank) is counted, and is aligned like any other: what its host has is then optional.
    """
    kind = texts.schema[host].dataType.simpleString()
    schema = f"`{host}` {kind}, nodes string, n_texts long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in slices(batches, text):
            for of, t in zip(batch.column(host).to_pylist(), batch.column(text).to_pylist()):
                mine = W.of_stream(s for s, _, _ in stream(t or "", tokens(t) if t else []))
                known = held.get(of)
                held[of] = (W.align(known[0], mine), known[1] + 1) if known else (mine, 1)
            if len(held) > 1000:  # what is held does not follow the number of hosts
                yield written(held)
                held = {}
        yield written(held)

    def written(held: dict) -> pa.RecordBatch:
        arrays = [pa.array(list(held), texts_type), pa.array([W.dumped(w) for w, _ in held.values()], pa.string()), pa.array([n for _, n in held.values()], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, [host, "nodes", "n_texts"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        first, *others = sorted(zip(group["nodes"], group["n_texts"]))
        merged = W.loaded(first[0])
        for nodes, _ in others:
            merged = W.align(merged, W.loaded(nodes))
        return pd.DataFrame({host: [group[host].iloc[0]], "nodes": [W.dumped(merged)], "n_texts": [group["n_texts"].sum()]})

    from pyspark.sql.pandas.types import to_arrow_type

    texts_type = to_arrow_type(texts.schema[host].dataType)
    parts = materialize(texts.select(host, text).mapInArrow(read, schema), "wrappers")
    most = parts.groupBy(host).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    while most > 1:
        groups = -(-most // fan) if most > fan else 1
        parts = materialize(parts.groupBy(host, F.pmod(F.xxhash64("nodes"), F.lit(groups))).applyInPandas(merge, schema), "wrappers")
        most = groups
    as_text = F.udf(lambda nodes: W.written(W.loaded(nodes)), "string")  # a row per host
    return parts.select(host, as_text("nodes").alias("wrapper"), "n_texts", "nodes")


def _with_nodes(df: DataFrame, wrappers: DataFrame, id_col: str, host: str, text: str) -> DataFrame:
    """(id, text, nodes): every row with the wrapper of its host, null without one. Adaptive execution splits the join for a hot host."""
    of = [F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"), F.col(host).isNull().alias("_none")]
    known = materialize(wrappers.select(*of, "nodes"), "wrappers")
    return df.select(id_col, text, *of).join(known, ["_host", "_none"], "left").select(id_col, text, "nodes")


def found_by_wrappers(df: DataFrame, wrappers: DataFrame, id_col: str = "chunk_id", host: str = "host", text: str = "text") -> DataFrame:
    """(id): records of df (id, host, text) in which the wrapper of their host (host_wrappers) has markup.

    A text is read by its wrapper: each of its tokens must be a fixed node of the wrapper, or one of its groups or gaps,
    and character references count in the lines that fill slots. Rows of one id are one record.
    """
    joined = _with_nodes(df, wrappers, id_col, host, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        markup: dict[str | None, set[str]] = {None: set()}
        for batch in slices(batches, text):
            held = []
            for t, nodes in zip(batch.column(text).to_pylist(), batch.column("nodes").to_pylist()):
                if nodes not in markup:
                    if len(markup) > 1000:
                        markup = {None: set()}
                    markup[nodes] = W.symbols(W.loaded(nodes))
                held.append(any(k in _INLINE or symbol(k, t[a:b]) in markup[nodes] for k, a, b in tokens(t)) if t else False)
            yield pa.RecordBatch.from_arrays([batch.column(id_col)], [id_col]).filter(pa.array(held, pa.bool_()))

    return joined.mapInArrow(run, T.StructType([df.schema[id_col]])).distinct()


def cleaned_texts(df: DataFrame, wrappers: DataFrame, id_col: str = "chunk_id", host: str = "host", text: str = "text", least_texts: int = 3) -> DataFrame:
    """(id, kinds, n_tokens, n_template, clean_text, structure) of every row of df (id, host, text).

    n_template: lines that went as the template of the host, which are those that its wrapper (host_wrappers) has as fixed
    texts, of hosts with least_texts texts or more. structure: the stream of the text, with slots for its texts. Null
    texts have no tokens and a null clean text; empty and blank texts come out as they are.
    """
    joined = _with_nodes(df, wrappers.where(F.col("n_texts") >= least_texts), id_col, host, text)
    names = [id_col, "kinds", "n_tokens", "n_template", "clean_text", "structure"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates: dict[str | None, list[str]] = {None: []}
        for batch in slices(batches, text):
            kinds, counts, gone, cleaned, structures = [], [], [], [], []
            for t, nodes in zip(batch.column(text).to_pylist(), batch.column("nodes").to_pylist()):
                if nodes not in templates:
                    if len(templates) > 1000:
                        templates = {None: []}
                    templates[nodes] = W.template(W.loaded(nodes))
                found = tokens(t) if t else []
                left, n = without_template(t, found, templates[nodes]) if t else (t, 0)
                kinds.append(list(dict.fromkeys(k for k, _, _ in found)))
                counts.append(len(found))
                gone.append(n)
                cleaned.append(clean(left) if found else left)
                structures.append(W.written(W.of_stream(s for s, _, _ in stream(t or "", found, literals=False))))
            made = [pa.array(kinds, pa.list_(pa.string())), pa.array(counts, pa.int32()), pa.array(gone, pa.int32()), pa.array(cleaned, pa.string()), pa.array(structures, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *made], names)

    schema = T.StructType([
        df.schema[id_col], T.StructField("kinds", T.ArrayType(T.StringType())), T.StructField("n_tokens", T.IntegerType()), T.StructField("n_template", T.IntegerType()),
        T.StructField("clean_text", T.StringType()), T.StructField("structure", T.StringType()),
    ])
    return joined.mapInArrow(run, schema)
