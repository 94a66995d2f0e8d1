"""Repetition inside single documents.

Line-first cleaning: every line is judged by itself, lines that fail are removed, and a document that loses too much of its
text is rejected. Rules of a line are punctuation, navigation, boilerplate and repetition. Repetition is measured in
windows: of all windows of fixed width, one from each character that is no white space, those that are equal to a window
which starts earlier in the document are repeated, and count for the line in which they start. A line that stood before
fails, and so does one most of whose windows are repeated; summed over its lines they are a document's exact share
of repeated content, within lines and across them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.llm.batches import slices
from folioscan.llm.neardup import mix, window_hashes
from folioscan.llm.unify import WHITE_SPACE

WINDOW = 20
MIN_LENGTH = 100
REPEATED_SHARE = 0.3
#: A line fails if more than this part of its windows is repeated, and a document that loses more than this part of its characters is rejected.
LINE_SHARE = 0.5
LOST_SHARE = 0.5
#: Items of a menu or a trail have at most so many characters.
ITEM_CHARS = 12

_BLANKS = re.compile(f"[{WHITE_SPACE}]+")
_INNER = re.compile(_BLANKS.pattern.replace("\n", ""))
_WORDS = re.compile(r"[^\W\d_]+")
_LETTERS = re.compile(r"\w")
_ENDS = re.compile(r"[。！？；!?;]|\.(?:\s|$)")
_ITEMS = re.compile(r"\s*(?:[|｜›»>·•/]|<<|>>|\s{2,}|→)\s*")
_COUNTER = re.compile(r"[\d.,:：/\-]+\s*[^\W\d_]{1,12}\s*[\d.,:：/\-]*")
# Words of controls, and phrases of notices.
_CONTROL = re.compile(r"上一页|下一页|上一篇|下一篇|返回|首页|目录|末页|顶部|更多|登录|注册|more|next|previous|prev|back|home|menu|top|read more|log ?in|sign ?(?:in|up)|share|suivant|précédent|accueil|retour|haut", re.IGNORECASE)
_NOTICE = re.compile(r"版权所有|未经许可|未经授权|免责声明|仅供参考|all rights reserved|copyright|©|cookie|terms of use|privacy policy|tous droits réservés|mentions légales", re.IGNORECASE)


def line_failure(line: str) -> str | None:
    """Why a stripped line fails by its own form, or None.

    punctuation: under half of it letters and digits. navigation: a number with at most one word, words of controls only, or
    three or more short items between separators. boilerplate: at least half of its sentences hold a phrase of notices.
    """
    letters = len(_LETTERS.findall(line))
    if letters * 2 < len(line) - line.count(" "):
        return "punctuation"
    if not _WORDS.search(line) or _COUNTER.fullmatch(line) and len(line) <= 2 * ITEM_CHARS:
        return "navigation"
    if not _ENDS.search(line):
        items = [i for i in _ITEMS.split(line) if i]
        if all(_CONTROL.fullmatch(i) for i in items) or len(items) > 2 and max(map(len, items)) <= ITEM_CHARS:
            return "navigation"
    if _NOTICE.search(line):
        sentences = [x for x in _ENDS.split(line) if x.strip()]
        if sum(_NOTICE.search(x) is not None for x in sentences) * 2 >= len(sentences):
            return "boilerplate"
    return None


def repeated_windows(texts: list[str], width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in it, repeated) of every window, in order; windows are compared by a 64-bit hash."""
    owner, hashes = window_hashes(texts, width)
    with np.errstate(over="ignore"):
        keyed = mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    again = np.ones(len(keyed), dtype=bool)
    again[np.unique(keyed, return_index=True)[1]] = False
    begins = np.searchsorted(owner, np.arange(len(texts)))
    return owner, np.arange(len(owner)) - begins[owner] if len(owner) else owner, again


def dense_lines(text: str) -> tuple[list[str], np.ndarray]:
    """The lines of a text without white space, and where each begins among its characters (one more at the end)."""
    dense = [_BLANKS.sub("", x) for x in text.split("\n")]
    return dense, np.concatenate([[0], np.cumsum([len(x) for x in dense])])


def judged_lines(text: str, repeated: np.ndarray, width: int = WINDOW, line_share: float = LINE_SHARE) -> list[tuple[str, str | None, int, int, int]]:
    """(line, failure, characters without white space, windows, repeated windows) of every line that is not blank.

    repeated: for each window of the text without white space, whether it is.
    """
    dense, at = dense_lines(text)
    upto = np.concatenate([[0], np.cumsum(repeated)])
    places = np.minimum(at, len(repeated))
    windows, again = np.diff(places).tolist(), np.diff(upto[places]).tolist()
    out, seen = [], set()
    for raw, bare, n, r in zip(text.split("\n"), dense, windows, again):
        if not bare:
            continue
        line = _INNER.sub(" ", raw).strip(" ")
        failure = line_failure(line)
        if failure is None and (bare in seen or r > line_share * n):
            failure = "repeated"
        seen.add(bare)
        out.append((raw, failure, len(bare), n, r))
    return out


def clean_lines(text: str, width: int = WINDOW, line_share: float = LINE_SHARE) -> str:
    """The lines that do not fail."""
    _, _, again = repeated_windows(["".join(dense_lines(text)[0])], width)
    return "\n".join(line for line, failure, *_ in judged_lines(text, again, width, line_share) if failure is None)


def repetition(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WINDOW, lost_share: float = LOST_SHARE, rules: bool = True) -> DataFrame:
    """One row per row of df: the id and measures of repetition of the whole text.

    n_chars: characters that are no white space; n_windows, n_repeated and repeated_share: the windows of all its lines.
    With `rules` also n_lines, n_failed and lost_share of line-first cleaning, n_lost_repeated (failing for repetition),
    and rejected where lost_share exceeds the limit. Null, empty and blank texts have zeros, and are not
    rejected; so has the share of a text shorter than a window.
    """
    facts = ["n_chars", "n_windows", "n_repeated"]
    judged = ["n_lines", "n_failed", "n_lost_repeated"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 2 << 20):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            dense = [_BLANKS.sub("", t) for t in texts]
            sizes = np.fromiter(map(len, dense), dtype=np.int64, count=len(dense))
            owner, _, again = repeated_windows(dense, width)
            windows, repeated = np.bincount(owner, minlength=len(texts)), np.bincount(owner[again], minlength=len(texts))
            columns = [sizes, windows, repeated, repeated / np.maximum(windows, 1)]
            if rules:
                ends = np.concatenate([[0], np.cumsum(windows)])
                lines = [judged_lines(t, again[a:b], width) for t, a, b in zip(texts, ends[:-1], ends[1:])]
                lost = np.array([sum(x[2] for x in doc if x[1]) for doc in lines], dtype=np.int64) / np.maximum(sizes, 1)
                columns += [np.array([len(doc) for doc in lines], dtype=np.int64), np.array([sum(x[1] is not None for x in doc) for doc in lines], dtype=np.int64)]
                columns += [np.array([sum(x[2] for x in doc if x[1] == "repeated") for doc in lines], dtype=np.int64), lost, lost > lost_share]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *map(pa.array, columns)], [id_col, *facts, "repeated_share", *([*judged, "lost_share", "rejected"] if rules else [])])

    kind = df.schema[id_col].dataType.simpleString()
    made = f"`{id_col}` {kind}, n_chars long, n_windows long, n_repeated long, repeated_share double"
    return df.select(id_col, text).mapInArrow(run, made + (", n_lines long, n_failed long, n_lost_repeated long, lost_share double, rejected boolean" if rules else ""))


def repetitive(df: DataFrame, id_col: str = "doc_id", text: str = "text", least: float = REPEATED_SHARE, min_length: int = MIN_LENGTH) -> DataFrame:
    """(id): records of at least min_length characters, at least `least` of whose windows are repeated.

    A view of the profile; the rules that do not bear on it are left out.
    """
    profile = repetition(df, id_col, text, rules=False)
    # whole numbers, so that a share of exactly `least` is not lost to rounding
    return profile.where((F.col("n_chars") >= min_length) & (F.col("n_repeated") * 1000 >= F.col("n_windows") * round(least * 1000))).select(id_col)
