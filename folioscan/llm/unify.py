"""One consistent form for text that reads the same.

The common form of a text has no invisible characters, Latin letters where Cyrillic or Greek letters are
shaped like them, compatibility characters and accents in composed compatibility normal form, and no white
space. Case counts unless it is folded. Forms are computed once for each distinct value of a batch.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.llm.batches import slices
from folioscan.llm.pairs import pairs_within
from folioscan.session import materialize

# White space, characters that are not displayed, and letters shaped like a Latin letter.
WHITE_SPACE = " \t\n\r\u00a0\u2000-\u200a\u202f\u3000"
INVISIBLE = (
    "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e"
    "\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8"
    "\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff"
)
LOOK_ALIKES = {
    "АВЕКМНОРСТУХІЈЅԌԚԜӀѴҮ": "ABEKMHOPCTYXIJSGQWIVY",
    "аеорсухіјѕһԁԛԝѵӏү": "aeopcyxijshdqwvly",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ": "ABEZHIKMNOPTYXCJ",
    "αγικνορυχϲϳ": "ayikvopuxcj",
}

_DROP = re.compile(f"[{WHITE_SPACE}{INVISIBLE}]+")
_UNSEEN = re.compile(f"[{INVISIBLE}]+")
_BLANK = re.compile(f"[{WHITE_SPACE}]+")
_FOREIGN = re.compile("[Ͱ-ԯ]")
_AS_LATIN = str.maketrans("".join(LOOK_ALIKES), "".join(LOOK_ALIKES.values()))


def common_form(text: str, fold_case: bool = False, keep_spaces: bool = False) -> str:
    """The common form of one text; keep_spaces leaves one space for each inner run of white space."""
    out = _UNSEEN.sub("", text) if keep_spaces else _DROP.sub("", text)
    if _FOREIGN.search(out):  # before the normal form too, which takes some look-alikes for the letters that they stand for
        out = out.translate(_AS_LATIN)
    out = unicodedata.normalize("NFKC", out)
    if _FOREIGN.search(out):
        out = unicodedata.normalize("NFKC", unicodedata.normalize("NFKD", out).translate(_AS_LATIN))
    if fold_case:
        out = unicodedata.normalize("NFKC", out.casefold())
    # normal form may bring white space of its own, whose removal may join an accent to a letter
    again = _BLANK.sub(" ", out).strip(" ") if keep_spaces else _DROP.sub("", out)
    return again if again == out else unicodedata.normalize("NFKC", again)


def distinct_forms(column: pa.Array, fold_case: bool = False, keep_spaces: bool = False) -> tuple[list[str | None], np.ndarray]:
    """The forms of a column's distinct values, and for each row the place of its form (the last for null)."""
    encoded = column.dictionary_encode()
    forms = [common_form(v, fold_case, keep_spaces) for v in encoded.dictionary.to_pylist()]
    codes = encoded.indices.fill_null(len(forms)).to_numpy(zero_copy_only=False)
    return [*forms, None], codes


def unify(df: DataFrame, columns: list[str], suffix: str = "_form", fold_case: bool = False, keep_spaces: bool = False) -> DataFrame:
    """df with a column `<name><suffix>` for each of `columns`: its common form.

    Null stays null; an empty text and one of white space and invisible characters only become empty. All other
    columns are kept, but for one that already has an output's name, which is replaced.
    """
    outs = [c + suffix for c in columns]
    keep = [c for c in df.columns if c not in outs]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(c, T.StringType()) for c in outs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, columns):
            made = []
            for c in columns:
                forms, codes = distinct_forms(batch.column(c), fold_case, keep_spaces)
                made.append(pa.array(forms, pa.string()).take(pa.array(codes)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made], [*keep, *outs])

    return df.select(*keep).mapInArrow(run, schema)


def key_of(form: str) -> tuple[int, int]:
    """128 bits of a form, as two longs: equal forms have equal keys, and no two others in practice."""
    digest = hashlib.blake2b(form.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def form_keys(df: DataFrame, text: str = "text", min_length: int = 0, fold_case: bool = False) -> DataFrame:
    """df without `text`, with form_hi, form_lo (the key of its common form) and form_length.

    Rows whose form is shorter than min_length, and rows with a null text, are left out.
    """
    outs = ["form_hi", "form_lo", "form_length"]
    keep = [c for c in df.columns if c not in (text, *outs)]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in outs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            forms, codes = distinct_forms(batch.column(text), fold_case)
            facts = np.array([(*key_of(f), len(f)) if f is not None else (0, 0, -1) for f in forms], dtype=np.int64)[codes]
            rows = np.flatnonzero(facts[:, 2] >= min_length)
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in keep), *(pa.array(facts[rows, i]) for i in range(3))], [*keep, *outs])

    return df.select(*keep, text).mapInArrow(run, schema)


def differing_twins(df: DataFrame, id_col: str = "chunk_id", text: str = "text", min_length: int = 30) -> DataFrame:
    """(<id>_a, <id>_b), a < b: records with equal common forms of at least min_length characters whose stored text differs.

    Rows with one id are one record (they are taken to be equal). Null texts are no case. Stored texts are compared by
    64-bit hash. Forms held with one stored text only are dropped by an aggregate before rows are brought together; a
    form held by very many records is split into parts.
    """
    keyed = materialize(form_keys(df.select(id_col, F.xxhash64(text).alias("stored"), text), text, min_length), "forms")
    key = ["form_hi", "form_lo"]
    varied = keyed.groupBy(*key).agg(F.min("stored").alias("low"), F.max("stored").alias("high")).where("low < high").select(*key)
    rows = keyed.join(varied, key, "left_semi").groupBy(*key, id_col).agg(F.max("stored").alias("stored"))
    return pairs_within(rows, key, id_col, ["stored"]).where("stored_a != stored_b").select(f"{id_col}_a", f"{id_col}_b")
