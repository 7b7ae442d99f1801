"""Sharding by a hierarchical weighted hash tree of regions, racks and shards.

A row descends from the root: at every node the children draw, each from a hash of (level, child, key), an
exponential variate divided by the summed weight below the child, and the least draw wins. A child is
so chosen in proportion to its weight, and a changed weight moves rows into or out of its own subtree at
every level: racks whose region keeps its weight keep their rows, and shards whose rack does. Cost per
row: the sum of the numbers of children on its way, not the number of shards.

Shards beyond a laid-out tree join as regions of their own, so that a further shard takes rows for itself
and moves no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.session import pin, shuffle_partitions

REGIONS = 4
RACKS = 2
LAW = "key"


def layout(shards: int, grown: int = 0, regions: int = REGIONS, racks: int = RACKS) -> list[tuple[int, int, int]]:
    """(region, rack, shard) of each shard, dealt in turn; ``grown`` further ones are each a region."""
    first = [(s % regions, s // regions % racks, s) for s in range(shards)]
    return first + [(regions + i, 0, shards + i) for i in range(grown)]


def shard_of(key: Column, tree: list[tuple[int, int, int]], weights: dict[int, float] | None = None) -> Column:
    """The shard of a key. ``weights``: by shard number, 1 by default; 0 takes no rows."""
    weights = weights or {}
    live = {p: float(weights.get(p[2], 1.0)) for p in tree if weights.get(p[2], 1.0) > 0}
    if not live:
        raise ValueError("no shard has a weight")
    node = F.lit(0)
    parents: list[tuple[int, ...]] = [()]
    for level in (1, 2, 3):
        # The children of each node of the level above, numbered through the level.
        names = sorted({p[:level] for p in live})
        table = [
            [(n, names[n][-1], sum(w for p, w in live.items() if p[:level] == names[n]))
             for n in range(len(names)) if names[n][: level - 1] == parent]
            for parent in parents
        ]
        choices = F.array(*[
            F.array(*[F.struct(F.lit(n).alias("node"), F.lit(name).alias("name"), F.lit(w).alias("weight")) for n, name, w in row])
            for row in table
        ])
        node = _least(F.get(choices, node), level, key)
        parents = names
    return F.get(F.array(*[F.lit(p[2]) for p in parents]), node)


def _least(children: Column, level: int, key: Column) -> Column:
    """The number of the child with the least draw."""

    def draw(child: Column) -> Column:
        # The hash as a number in (0, 1).
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), child["name"], key), 11)
        variate = -F.log((bits.cast("double") + 0.5) / float(1 << 53))
        return F.struct((variate / child["weight"]).alias("draw"), child["node"].alias("node"))

    return F.array_min(F.transform(children, draw))["node"]


def assign(
    docs: DataFrame, shards: int, weights: dict[int, float] | None = None, grown: int = 1
) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) as doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes plus 16. A null text has 0 bytes, a null doc_id is a key of its own. slot
    numbers the rows of a shard from 0 in the order of doc_id, size, crc; rows equal in all of
    them are interchangeable. grown_shard: the shard with ``grown`` more, each a region of its own. Other columns are
    ignored. Empty table: no rows.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    placed = docs.select(
        "doc_id",
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        shard_of(key, layout(shards), weights).alias("shard"),
        shard_of(key, layout(shards, grown), weights).alias("grown_shard"),
    )
    return number(pin(placed), "shard", ["doc_id", "size", "text_crc32"], "slot")


def number(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Number the rows of each group from 0. Ranges of (group, order) are sorted apart, and the
    counts of earlier ranges added, so a group may span any number of tasks."""
    columns = rows.columns
    parts = shuffle_partitions(rows.sparkSession)
    ranged = pin(
        rows.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
        .withColumn("__llm_at", F.monotonically_increasing_id())
    )
    part = F.shiftright(F.col("__llm_at"), 33)
    runs = ranged.groupBy(part.alias("__llm_of"), F.col(group).alias("__llm_group")).agg(
        F.count("*").alias("__llm_n"), F.min("__llm_at").alias("__llm_first")
    )
    # At most one row per range and per group; bounded by their numbers, not by the rows.
    before = Window.partitionBy("__llm_group").orderBy("__llm_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn("__llm_before", F.coalesce(F.sum("__llm_n").over(before), F.lit(0)))
    numbered = ranged.withColumn("__llm_part", part).join(
        F.broadcast(starts), (F.col("__llm_part") == F.col("__llm_of")) & (F.col(group) == F.col("__llm_group"))
    )
    slot = F.col("__llm_at") - F.col("__llm_first") + F.col("__llm_before")
    return numbered.select(*columns, slot.alias(name))
