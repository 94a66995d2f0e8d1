"""Mixing sources to target weights, measured in tokens.

Records are laid out along their source by a hash, and each source is cut into blocks, ranges of that order, so a block is
a random part of its source. The tokens that each source must give are draws of whole blocks (a full pass over
a source draws each of its blocks once) and, in the last pass, its first blocks, of which the last ends at a record. A
splitting tree divides the draws of all sources among the output shards: at each node the number of draws from each
source that goes left follows the multivariate hypergeometric distribution, so the totals are exact and every shard
holds a random share. The draws of a source are numbered, every node has a range of numbers, and a pseudo-random permutation
of the numbers gives the blocks, so shards hold disjoint permuted blocks and each is shuffled within itself.

Blocks and shards grow together. The driver holds the top of the tree, a fixed number of nodes; below it the tree and the
draws are made where they are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscan.llm.batches import apart
from folioscan.llm.neardup import mix
from folioscan.llm.tokens import tidy_name, token_counts
from folioscan.session import materialize

#: Tokens of an output shard, and blocks that make up a shard on average.
SHARD_TOKENS = 1 << 20
BLOCKS_A_SHARD = 32
#: Nodes of the tree on the driver, and bins of a source's order that it looks at in one step.
TOP_NODES = 256
BIN_BITS = 12
_PLACE_BITS = 63
_MOST_EXACT = 10**9


def _hypergeometric(rng: np.random.Generator, good: np.ndarray, bad: np.ndarray, take: np.ndarray) -> np.ndarray:
    """Draws by element; where a number is beyond what the generator takes, by the normal limit, within what is possible."""
    exact = (good < _MOST_EXACT) & (bad < _MOST_EXACT)
    out = np.zeros(len(good), dtype=np.int64)
    out[exact] = rng.hypergeometric(good[exact], bad[exact], take[exact])
    if not exact.all():
        g, b, t = (v[~exact].astype(np.float64) for v in (good, bad, take))
        n = g + b
        guess = np.rint(t * g / n + np.sqrt(t * (g / n) * (b / n) * (n - t) / (n - 1)) * rng.standard_normal(len(g))).astype(np.int64)
        out[~exact] = np.clip(guess, np.maximum(0, (take - bad)[~exact]), np.minimum(good, take)[~exact])
    return out


def split_draws(low: int, high: int, have: np.ndarray, first: np.ndarray, seed: int, until: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The nodes of at most `until` shards below the node of shards low to high - 1: (low, high, draws, first draw) of each.

    have, first: how many draws of each source the node has, and the number of the first of them. Nodes without draws
    are left out; all shards have draws if there are as many draws as shards, and differ by one at most.
    """
    rng = np.random.default_rng([seed, low, high])
    low, high = np.array([low], dtype=np.int64), np.array([high], dtype=np.int64)
    have, first = np.asarray(have, dtype=np.int64)[None, :], np.asarray(first, dtype=np.int64)[None, :]
    done: list[tuple] = []
    while len(low):
        live = have.sum(axis=1) > 0
        leaf = live & (high - low <= until)
        done.append((low[leaf], high[leaf], have[leaf], first[leaf]))
        low, high, have, first = (v[live & ~leaf] for v in (low, high, have, first))
        middle = (low + high) // 2
        rest = have.sum(axis=1)
        # a share of the draws, rounded down, by whole numbers that stay within 64 bits
        size = high - low
        todo = (rest // size) * (middle - low) + (rest % size) * (middle - low) // size
        left = np.zeros_like(have)
        for k in range(have.shape[1]):
            rest = rest - have[:, k]
            left[:, k] = _hypergeometric(rng, have[:, k], rest, todo)
            todo = todo - left[:, k]
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
        have, first = np.concatenate([left, have - left]), np.concatenate([first, first + left])
    return tuple(np.concatenate([d[i] for d in done]) for i in range(4))


def permuted(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudo-random permutation of 0 to n - 1 at `numbers`: a network over the next power of four, walked until within n."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> half, out[todo] & mask
            for turn in range(4):
                word = mix(right + mix(np.full(1, key * 4 + turn + 1, dtype=np.uint64)))
                left, right = right, left ^ (word >> np.uint64(7) & mask)
            out[todo] = left << half | right
            todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def draw_plan(spark: SparkSession, draws: list[int], blocks: list[int], shards: int, seed: int) -> DataFrame:
    """(source_no, block, use, shard): all draws, each in its shard. `draws`, `blocks`: how many each source has."""
    low, high, have, first = split_draws(0, shards, np.array(draws), np.zeros(len(draws)), seed, -(-shards // TOP_NODES))
    rows = list(zip(low.tolist(), high.tolist(), have.tolist(), first.tolist()))
    nodes = spark.createDataFrame(rows, "low long, high long, have array<long>, first array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node in batch.to_pylist():
                shard, _, counts, begins = split_draws(node["low"], node["high"], node["have"], node["first"], seed)
                for k in range(len(draws)):
                    many, begin = counts[:, k], begins[:, k]
                    owner = np.repeat(np.arange(len(many)), many)
                    number = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + begin[owner]
                    place = permuted(number, draws[k], seed * 1009 + k)
                    for a in range(0, len(place), 100_000):
                        cut = slice(a, a + 100_000)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(place[cut]), k, dtype=np.int32)), pa.array(place[cut] % blocks[k]), pa.array((place[cut] // blocks[k]).astype(np.int32)), pa.array(shard[owner[cut]])],
                            ["source_no", "block", "use", "shard"],
                        )

    return nodes.repartition(max(1, min(len(rows), 64))).mapInArrow(run, "source_no int, block long, use int, shard long")


def last_places(records: DataFrame, wanted: dict[int, int]) -> dict[int, int]:
    """The place of the record of each source at which its tokens, in order of places, reach what is wanted.

    records: source_no, place (63 bits), n_tokens. The order is narrowed down by bins of sums, at most 4,096 a source
    and step, so the driver holds a fixed number of sums. Records of one place are taken together.
    """
    found: dict[int, int] = {}
    inside = {k: (0, n) for k, n in wanted.items() if n > 0}  # prefix of places, tokens wanted of it
    shift = _PLACE_BITS
    while inside:
        before, shift = shift, max(0, shift - BIN_BITS)
        at = lambda bits: F.shiftright("place", bits) if bits < _PLACE_BITS else F.lit(0).cast("long")
        chosen = F.lit(False)
        for k, (prefix, _) in inside.items():
            chosen = chosen | ((F.col("source_no") == k) & (at(before) == prefix))
        bins = records.where(chosen).groupBy("source_no", at(shift).alias("bin")).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n"), F.max("place").alias("last"))
        by_source: dict[int, list] = {}
        for r in bins.collect():
            by_source.setdefault(r.source_no, []).append((r.bin, r.tokens, r.n, r.last))
        for k, (_, rest) in list(inside.items()):
            del inside[k]
            for prefix, tokens, n, last in sorted(by_source.get(k, [])):
                if tokens < rest:
                    rest -= tokens
                elif n == 1 or shift == 0:
                    found[k] = last
                    break
                else:
                    inside[k] = (prefix, rest)
                    break
    return found


def mix_plan(available: dict[str, int], weights: dict[str, float], repeats: dict[str, int], total: int | None = None) -> dict[str, int]:
    """Tokens wanted of each source.

    Sources without tokens or with no positive weight give nothing and their share goes to the others in
    proportion. Without `total` the mix is the largest in which every other source meets its share within
    its repeats; with a larger total a scarce source gives all it may, and its shortfall shows in the report.
    """
    usable = {s: w for s, w in weights.items() if available.get(s, 0) > 0 and (w or 0) > 0 and (repeats.get(s) or 0) > 0}
    whole = sum(usable.values())
    if not usable:
        return {s: 0 for s in weights}
    caps = {s: available[s] * repeats[s] for s in usable}
    size = min(caps[s] * whole / w for s, w in usable.items()) if total is None else total
    return {s: min(caps[s], int(round(size * usable[s] / whole))) if s in usable else 0 for s in weights}


def mixture(sized: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 17,
            shard_tokens: int = SHARD_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(draws, shares) of a mix of `sized` (doc_id, source, n_tokens) to `targets` (source, target_weight, max_repeats).

    draws: one row per use of a record: shard, position in the shard, doc_id, source, use (from 0), n_tokens.
    shares: one row per target with the tokens available, wanted and drawn, the wanted and the actual share, and
    the most often any record of it may have been used.
    Records without tokens, and of sources that are no target, are never drawn. Targets that are named
    twice count with the sum of their weights and the least of their repeats; null weights and repeats are 0. Rows of one
    id lie together, rows without id anywhere.
    """
    spark = sized.sparkSession
    wanted = (
        targets.groupBy(tidy_name(F.col("source")).alias("source"))
        .agg(F.sum(F.coalesce("target_weight", F.lit(0.0))).alias("w"), F.min(F.coalesce("max_repeats", F.lit(0))).alias("r"))
        .orderBy("source").collect()
    )
    names = [x.source for x in wanted]
    weights, repeats = {x.source: float(x.w) for x in wanted}, {x.source: int(x.r) for x in wanted}
    number_of = F.element_at(F.create_map(*(F.lit(x) for k, s in enumerate(names) for x in (s, k))), F.col("source")) if names else F.lit(None).cast("int")
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", F.coalesce(apart("doc_id"), F.lit(-1))), 1)
    records = materialize(
        sized.where(F.col("n_tokens") > 0).select("doc_id", "source", "n_tokens", number_of.alias("source_no"), place.alias("place")).where(F.col("source_no").isNotNull()), "mix-records"
    )
    available = {x.source: int(x.n) for x in records.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    quota = mix_plan(available, weights, repeats, total)
    size = sum(quota.values())
    shards = max(1, -(-size // shard_tokens))
    block_tokens = max(1, size // (shards * BLOCKS_A_SHARD))
    blocks = [max(1, round(available.get(s, 0) / block_tokens)) for s in names]
    passes, rests = ([divmod(quota[s], available[s])[i] if available.get(s) else 0 for s in names] for i in range(2))
    last = last_places(records, dict(enumerate(rests)))
    ends = [int(last[k] / 2.0**_PLACE_BITS * n) if k in last else -1 for k, n in enumerate(blocks)]
    draws = [p * n + min(end, n - 1) + 1 for p, n, end in zip(passes, blocks, ends)]

    by_source = lambda values: F.element_at(F.array(*(F.lit(int(v)).cast("long") for v in values)), F.col("source_no") + 1) if names else F.lit(None).cast("long")
    block = F.least(F.floor(F.col("place") / F.lit(2.0**_PLACE_BITS) * by_source(blocks)), by_source(blocks) - 1)
    plan = draw_plan(spark, draws, blocks, shards, seed)
    used = records.withColumn("block", block).join(plan, ["source_no", "block"])
    used = used.where((F.col("use") < by_source(passes)) | (F.col("place") <= by_source([last.get(k, -1) for k in range(len(names))])))
    within = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 2), "doc_id", "use"), "place", "doc_id", "use")
    draws = used.select("shard", (F.row_number().over(within) - 1).alias("position"), "doc_id", "source", "use", "n_tokens")
    target_type = "source string, target_share double, max_repeats int, available_tokens long, wanted_tokens long"
    whole = sum(weights.values()) or 1.0
    facts = spark.createDataFrame([(s, weights[s] / whole, repeats[s], available.get(s, 0), quota[s]) for s in names], target_type)
    got = draws.groupBy("source").agg(F.sum("n_tokens").alias("drawn_tokens"), F.count("*").alias("draws"), (F.max("use") + 1).alias("most_uses"))
    everything = Window.partitionBy(F.lit(0))  # a row per target
    shares = facts.join(F.broadcast(got), "source", "left").select(
        "source", "target_share",
        (F.coalesce("drawn_tokens", F.lit(0)) / F.sum("drawn_tokens").over(everything)).alias("actual_share"),
        "available_tokens", "wanted_tokens", F.coalesce("drawn_tokens", F.lit(0)).alias("drawn_tokens"),
        F.coalesce("draws", F.lit(0)).alias("draws"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"), "max_repeats",
    )
    return draws, shares


def document_mix(documents: DataFrame, targets: DataFrame, vocabulary: str | None = None) -> tuple[DataFrame, DataFrame]:
    """mixture() of documents; mixture writes the token count of each once and reads it in every later step."""
    sized = token_counts(documents.select("doc_id", tidy_name(F.col("source")).alias("source"), "text"), vocabulary=vocabulary)
    return mixture(sized, targets)
