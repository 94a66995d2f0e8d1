"""Near-duplicate records: weighted-Jaccard signatures (BagMinHash), banding, and an exact check of candidates.

A record is the bag of k-character substrings of its common form. Every substring owns a Poisson process of
points in (time, weight level, component); a record sees the points of its substrings below their weights, and a
component of its signature is the earliest time seen in it. Two records agree in a component with probability
equal to their weighted Jaccard similarity. Weight levels are laid out in blocks that double in height, each
with a process of its own that is thinned to the weight, so a weight w costs about log2(w) processes, and
processes stop once they are later than all of the signature: the cost of a record is that of its substrings plus
m log m, instead of their product.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.llm.batches import slices
from folioscan.llm.pairs import linked_groups, pairs_across, pairs_within
from folioscan.llm.unify import common_form, distinct_forms, form_keys, key_of
from folioscan.session import materialize

SHINGLE = 5
SIMILARITY = 0.6
MIN_LENGTH = 30
#: 64 bands of 5 components find a pair of similarity 0.6 with probability 0.994, one of 0.65 with 0.9996.
BANDS, ROWS = 64, 5
#: Buckets that are broadcast at most, each about 50 bytes.
BROADCAST_BUCKETS = 1_000_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters in a row as numbers, and where each text begins (one more at the end)."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points, np.concatenate([[0], np.cumsum(sizes)])


def window_hashes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every substring of `width` characters, in order; a shorter text has none."""
    points, at = code_points(texts)
    n = len(points) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    letters = mix(points.astype(np.uint64) + _GOLDEN)
    hashes = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        hashes = hashes * np.uint64(0x2545F4914F6CDD1D) + letters[i : i + n]
    owner = np.repeat(np.arange(len(texts)), np.diff(at))[:n]
    inside = np.arange(n) + width <= at[owner + 1]
    return owner[inside], mix(hashes[inside])


def bag_signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, records: int, m: int) -> np.ndarray:
    """Signatures (records, m) of float64 times. `owner` is in order.

    Weights are positive and count in whole steps. Where all are 1 the records are sets: each element has the first block,
    in full, and may be given more than once. A record without elements has infinity everywhere.
    """
    if (weight == 1).all():
        width = share = None
    else:  # levels [0,1), [1,2), [2,4), [4,8), ...; the last block of an element is held in part
        top = np.maximum(1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1)
        block = np.arange(int(top.sum())) - np.repeat(np.cumsum(top) - top, top)
        owner, element, weight = (np.repeat(v, top) for v in (owner, element, weight))
        low = np.where(block > 0, 2.0 ** (block - 1), 0.0)
        width = np.where(block > 0, low, 1.0)
        share = np.clip((weight - low) / width, 0, 1)
        element = np.where(block > 0, mix(element + block.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), element)
    signature = np.full(records * m, np.inf)
    grid = signature.reshape(records, m)
    time = np.zeros(len(owner))
    step = np.uint64(0)
    with np.errstate(over="ignore"):
        while len(owner):
            step += _GOLDEN
            word = mix(element + step)
            gap = -np.log(((word >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0**-32)
            time = time + (gap if width is None else gap / width)
            place = owner * m + (((word & np.uint64(0xFFFFFFFF)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
            if share is None:
                np.minimum.at(signature, place, time)
            else:
                seen = (mix(word) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < share
                np.minimum.at(signature, place[seen], time[seen])
            first = np.append(True, owner[1:] != owner[:-1])  # only records that still have processes
            latest = grid[owner[first]].max(axis=1)
            go = np.flatnonzero(time < latest[np.cumsum(first) - 1])
            owner, element, time = owner[go], element[go], time[go]
            if share is not None:
                width, share = width[go], share[go]
    return grid


def band_hashes(grid: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(records, bands) of int64: one hash for the components of each band and its place, so that bands share no values."""
    words = grid[:, : bands * rows].copy().view(np.uint64).reshape(len(grid), bands, rows)
    with np.errstate(over="ignore"):
        out = np.repeat(mix(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN)[None, :], len(grid), axis=0)
        for r in range(rows):
            out = mix((out + _GOLDEN) ^ words[:, :, r])
    return out.view(np.int64)


def _weighted(owner: np.ndarray, element: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each record with their number as weight."""
    order = np.lexsort((element, owner))
    owner, element = owner[order], element[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (element[1:] != element[:-1])
    first = np.flatnonzero(new)
    return owner[first], element[first], np.diff(np.append(first, len(owner))).astype(np.float64)


def signatures(df: DataFrame, number: str, text: str, bag: bool, shingle: int, min_length: int, bands: int, rows: int) -> DataFrame:
    """(number, form_hi, form_lo, bands) of the records whose common form has at least min_length characters."""
    least = max(min_length, shingle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, _SLICE):
            forms, codes = distinct_forms(batch.column(text))
            long_enough = np.array([f is not None and len(f) >= least for f in forms])
            place = np.cumsum(long_enough) - 1
            texts = [f for f, ok in zip(forms, long_enough) if ok]
            if not texts:
                continue
            owner, element = window_hashes(texts, shingle)
            weighted = _weighted(owner, element) if bag else (owner, element, np.ones(len(owner)))
            grid = bag_signatures(*weighted, len(texts), bands * rows)
            hashes = band_hashes(grid, bands, rows)
            keys = np.array([key_of(t) for t in texts], dtype=np.int64)
            kept = np.flatnonzero(long_enough[codes])
            mine = place[codes[kept]]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(mine) + 1, dtype=np.int32) * bands), pa.array(hashes[mine].ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(number).take(pa.array(kept)), pa.array(keys[mine, 0]), pa.array(keys[mine, 1]), lists],
                [number, "form_hi", "form_lo", "bands"],
            )

    kind = df.schema[number].dataType.simpleString()
    return df.select(number, text).mapInArrow(run, f"`{number}` {kind}, form_hi long, form_lo long, bands array<long>")


def similarity(a: str, b: str, shingle: int, bag: bool) -> float:
    """Exact (weighted) Jaccard similarity of two forms' substrings."""
    one, two = ([t[i : i + shingle] for i in range(len(t) - shingle + 1)] for t in (a, b))
    if not bag:
        x, y = set(one), set(two)
        both = len(x & y)
        return both / (len(x) + len(y) - both) if x or y else 0.0
    x, y = Counter(one), Counter(two)
    both = sum((x & y).values())
    return both / (len(one) + len(two) - both) if one or two else 0.0


def _verified(pairs: DataFrame, number: str, shingle: int, bag: bool, least: float) -> DataFrame:
    a, b = f"{number}_a", f"{number}_b"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "text_a"):
                known: dict[str, str] = {}
                values = []
                for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                    for t in (x, y):
                        if t not in known:
                            known[t] = common_form(t)
                    values.append(similarity(known[x], known[y], shingle, bag))
                found = np.array(values)
                kept = np.flatnonzero(found >= least)
                at = pa.array(kept)
                yield pa.RecordBatch.from_arrays([batch.column(a).take(at), batch.column(b).take(at), pa.array(found[kept])], [a, b, "similarity"])

    kind = pairs.schema[a].dataType.simpleString()
    return pairs.select(a, b, "text_a", "text_b").mapInArrow(run, f"`{a}` {kind}, `{b}` {kind}, similarity double")


def _in_buckets(df: DataFrame, number: str, text: str, bag: bool, shingle: int, min_length: int, bands: int, rows: int) -> DataFrame:
    """(bucket, number): every text (the least number of its form) in the bucket of each of its bands; a bucket is a 64-bit hash."""
    signed = signatures(df, number, text, bag, shingle, min_length, bands, rows)
    texts = materialize(signed.groupBy("form_hi", "form_lo").agg(F.min(number).alias(number), F.first("bands").alias("bands")), "signatures")
    return texts.select(F.explode("bands").alias("bucket"), number)


def small_enough(buckets: DataFrame, most: int = BROADCAST_BUCKETS) -> DataFrame:
    """buckets, to be broadcast if they are few, so that the bands of all texts need not be shuffled once more to meet them."""
    return F.broadcast(buckets) if buckets.count() <= most else buckets


def _measured(df: DataFrame, candidates: DataFrame, number: str, text: str, shingle: int, bag: bool, least: float) -> DataFrame:
    """Candidates (<number>_a, <number>_b) with their exact similarity, those of at least `least`."""
    a, b = f"{number}_a", f"{number}_b"
    needed = candidates.select(F.col(a).alias(number)).unionByName(candidates.select(F.col(b).alias(number))).distinct()
    held = df.select(number, text).join(needed, number).groupBy(number).agg(F.first(text).alias("text"))
    both = candidates.join(held.select(F.col(number).alias(a), F.col("text").alias("text_a")), a).join(
        held.select(F.col(number).alias(b), F.col("text").alias("text_b")), b
    )
    return _verified(both, number, shingle, bag, least)


def near_links(df: DataFrame, number: str = "ord", text: str = "text", *, bag: bool = False, least: float = SIMILARITY,
               shingle: int = SHINGLE, min_length: int = MIN_LENGTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(<number>_a, <number>_b, similarity): all links between different texts, each text by the least number that holds it.

    Records with equal common forms count as one text. Null texts, and texts whose form is shorter than min_length,
    have no links. Rows of one number are one record. The bucket of a band that many texts share is split
    into parts. Every link found is exact; a link of similarity s is missed with probability (1 - s**rows) ** bands.
    """
    spread = _in_buckets(df, number, text, bag, shingle, min_length, bands, rows)
    a, b = f"{number}_a", f"{number}_b"
    buckets = materialize(spread.groupBy("bucket").agg(F.count("*").alias("n"), F.min(number).alias(a), F.max(number).alias(b)).where("n > 1"), "buckets")
    larger = spread.join(small_enough(buckets.where("n > 2").select("bucket")), "bucket")
    candidates = materialize(
        buckets.where("n = 2").select(a, b).unionByName(pairs_within(larger, ["bucket"], number).select(a, b)).distinct(), "candidates"
    )
    return _measured(df, candidates, number, text, shingle, bag, least)


def near_roots(df: DataFrame, number: str = "ord", text: str = "text", *, bag: bool = False, least: float = SIMILARITY,
               shingle: int = SHINGLE, min_length: int = MIN_LENGTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(<number>, root): the texts that have a link, with the least text that they reach over links; buckets as in near_links.

    No bucket lists all its pairs. First each of its texts is measured against its least one, its centre, and what is
    linked so is one group. A link between groups can then only lie between a text that is not linked to the
    centre and one of another group. As 1 - similarity is a metric, only those can be linked whose similarities to
    the centre differ by at most 1 - least, and these pairs are measured too. So no link that joins groups is lost.
    """
    spread = _in_buckets(df, number, text, bag, shingle, min_length, bands, rows)
    a, b = f"{number}_a", f"{number}_b"
    centres = materialize(spread.groupBy("bucket").agg(F.count("*").alias("n"), F.min(number).alias(a)).where("n > 1"), "buckets")
    spokes = materialize(spread.withColumnRenamed(number, b).join(small_enough(centres), "bucket").where(F.col(a) != F.col(b)).select("bucket", a, b, "n"), "spokes")
    measured = materialize(_measured(df, spokes.select(a, b).distinct(), number, text, shingle, bag, -1.0), "measured")
    near = linked_groups(measured.where(F.col("similarity") >= least), a, b).withColumnRenamed("node", b)

    placed = spokes.where("n > 2").join(measured, [a, b]).join(near, b, "left").select("bucket", "n", F.col(b).alias("x"), "similarity", F.coalesce("root", b).alias("root"))
    placed = materialize(placed, "placed")
    far = placed.where(F.col("similarity") < least)
    pairs = pairs_across(
        far.select("bucket", "n", F.col("x").alias("x1"), F.col("similarity").alias("s1"), F.col("root").alias("r1")),
        placed.join(far.select("bucket").distinct(), "bucket", "left_semi").select("bucket", "n", F.col("x").alias("x2"), F.col("similarity").alias("s2"), F.col("root").alias("r2")), ["bucket"], "n", "x2",
    )
    open_ = pairs.where((F.col("r1") != F.col("r2")) & (F.abs(F.col("s1") - F.col("s2")) <= 1 - least + 1e-9))
    asked = materialize(open_.select(F.least("x1", "x2").alias(a), F.greatest("x1", "x2").alias(b)).distinct(), "candidates")
    more = _measured(df, asked, number, text, shingle, bag, least).drop("similarity")
    return linked_groups(near.select(F.col(b).alias(a), F.col("root").alias(b)).unionByName(more), a, b).withColumnRenamed("node", number)


def _members(df: DataFrame, number: str, id_col: str, text: str, min_length: int) -> DataFrame:
    """(number, id, form_hi, form_lo, first): every record with the least number of its form."""
    forms = materialize(form_keys(df.select(number, id_col, text), text, min_length).drop("form_length"), "forms")
    least = materialize(forms.groupBy("form_hi", "form_lo").agg(F.min(number).alias("first")), "classes")
    return forms.groupBy("form_hi", "form_lo", id_col).agg(F.min(number).alias(number)).join(least, ["form_hi", "form_lo"])


def near_pairs(df: DataFrame, id_col: str = "chunk_id", number: str = "ord", text: str = "text", **options) -> DataFrame:
    """(<id>_a, <id>_b), a < b: all pairs of near-duplicate records, records with equal common forms included.

    The result lists every pair of a group, so it is as large as its groups squared; near_groups has one row
    per record instead. The members of a class of very many equal forms meet its links in parts. Nulls and short texts
    as in near_links.
    """
    members = materialize(_members(df, number, id_col, text, options.get("min_length", MIN_LENGTH)), "members")
    links = near_links(df, number, text, **options).drop("similarity")
    sizes = materialize(members.groupBy("first").agg(F.count("*").alias("n")), "sizes")
    sized = members.select("first", id_col).join(sizes, "first")
    for side in ("a", "b"):
        first = f"{number}_{side}"
        links = links.join(sizes.withColumnRenamed("first", first), first)
        links = pairs_across(links, sized.select(F.col("first").alias(first), "n", F.col(id_col).alias(f"id_{side}")), [first], "n", f"id_{side}").drop("n")
    out = [F.least("id_a", "id_b").alias(f"{id_col}_a"), F.greatest("id_a", "id_b").alias(f"{id_col}_b")]
    equal = pairs_within(members, ["form_hi", "form_lo"], id_col).select(f"{id_col}_a", f"{id_col}_b")
    return links.select(*out).unionByName(equal)


def near_groups(df: DataFrame, id_col: str = "chunk_id", number: str = "ord", text: str = "text", **options) -> DataFrame:
    """One row per record of at least min_length characters: id, class_id and group_id.

    class_id is the least number among records with an equal common form, group_id the least among those
    that are linked to it over any number of links.
    """
    members = _members(df, number, id_col, text, options.get("min_length", MIN_LENGTH))
    roots = materialize(near_roots(df, number, text, **options).withColumnRenamed(number, "first"), "roots")
    return members.join(roots, "first", "left").select(id_col, F.col("first").alias("class_id"), F.coalesce("root", "first").alias("group_id"))
