"""Pairs of records within groups, and groups of linked records, without large groups in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.session import materialize

#: Members of a group that meet the whole group in one task.
PART_ROWS = 1000


def pairs_across(left: DataFrame, right: DataFrame, keys: list[str], size: str, spread_by: str, part_rows: int = PART_ROWS) -> DataFrame:
    """The equi-join of left and right on keys, with the right rows of a large key in parts.

    Both sides hold in `size` how many rows the key has on the right (of those that may be there). A right row belongs to one
    part, by a hash of `spread_by`; a left row meets every part. Null keys do not join.
    """
    parts = F.ceil(F.col(size) / part_rows).cast("int")
    one = right.withColumn("_part", F.pmod(F.xxhash64(spread_by), parts).cast("int")).drop(size)
    return left.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).join(one, [*keys, "_part"]).drop("_part")


def pairs_within(rows: DataFrame, keys: list[str], id_col: str, others: list[str] = (), part_rows: int = PART_ROWS) -> DataFrame:
    """All pairs a < b of the different ids of a group: keys, <id>_a, <id>_b and both sides of `others`.

    For results that must list all pairs of a group. A group of more than part_rows members is split: each
    member belongs to one part on the right and meets every part from the left, so no task holds more than
    part_rows by the group. The sizes of groups are a table of their own, so that adaptive execution can split the
    join that hands them out. Null keys make no group. Ids must be unique within a group.
    """
    sizes = materialize(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1"), "group-sizes")
    rows = rows.select(*keys, id_col, *others).join(sizes, keys)
    side = lambda x: rows.select(*keys, "_n", F.col(id_col).alias(f"{id_col}_{x}"), *(F.col(c).alias(f"{c}_{x}") for c in others))
    met = pairs_across(side("a"), side("b"), keys, "_n", f"{id_col}_b", part_rows)
    return met.where(F.col(f"{id_col}_a") < F.col(f"{id_col}_b")).drop("_n")


def linked_groups(links: DataFrame, a: str, b: str, rounds: int = 64) -> DataFrame:
    """(node, root): the connected groups of undirected links, named by their least node.

    Each round links the larger neighbours of every node to the least node it sees, then the smaller ones
    (large-star and small-star), which ends after about log2 of the longest chain. The links of a round are
    written to the shared folder; nothing but counts comes to the driver. A node without a link to another
    (or linked to itself only) is not in the result; nulls make no link.
    """
    edges = (
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    edges = materialize(edges, "links")
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # a table, so that adaptive execution can split the join with the links of a hub
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        edges = materialize(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        now = mark(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("groups were not complete after all rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
