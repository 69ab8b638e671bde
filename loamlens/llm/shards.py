"""Sharding by a hierarchical weighted hash tree: regions, racks and shards are drawn level by level."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from loamlens.llm.ranking import with_positions
from loamlens.session import durable

#: region, rack and shard number to the shard's weight
Tree = Mapping[str, Mapping[str, Mapping[int, float]]]

#: shards of the query, and how many regions, and racks in each, hold them
SHARDS, REGIONS, RACKS = 40, 4, 2
SEED = 2024
#: fixed bytes a row takes in a shard beside its text
ROW_BYTES = 16
#: hex digits of a digest that make a draw
DIGITS = 12


def even_tree(shards: int = SHARDS, regions: int = REGIONS, racks: int = RACKS) -> Tree:
    """Shards of weight 1, dealt to all racks in blocks of nearly equal size; racks without one are left out."""
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for shard in range(shards):
        rack = shard * regions * racks // shards
        region = tree.setdefault(f"region {rack // racks}", {})
        region.setdefault(f"rack {rack}", {})[shard] = 1.0
    return tree


def with_shard(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, numbered after the others, in a region of its own.

    The weights of all regions stay, so the new region takes rows and no other subtree does: one more
    shard takes rows only into itself.
    """
    shard = 1 + max((s for racks in tree.values() for shards in racks.values() for s in shards), default=-1)
    return {**tree, f"region of {shard}": {f"rack of {shard}": {shard: weight}}}


def tree_of(shards: int, planned: int = SHARDS) -> Tree:
    """The tree of ``shards`` shards: those beyond the planned ones were added one after the other."""
    tree = even_tree(min(shards, planned))
    for _ in range(planned, shards):
        tree = with_shard(tree)
    return tree


def children(tree: Tree) -> dict[str, list[tuple[str, float]]]:
    """Each inner node's children with the weights below them; what weighs nothing is never drawn."""
    found: dict[str, list[tuple[str, float]]] = {"": []}
    for region, racks in tree.items():
        for rack, shards in racks.items():
            leaves = [(str(shard), float(weight)) for shard, weight in shards.items() if weight > 0]
            if leaves:
                found[rack] = leaves
                found.setdefault(region, []).append((rack, sum(w for _, w in leaves)))
        if region in found:
            found[""].append((region, sum(w for _, w in found[region])))
    names = [name for below in found.values() for name, _ in below]
    if len(set(names)) != len(names):
        raise ValueError("regions, racks and shards need names of their own")
    if not names:
        raise ValueError("no shard has a weight")
    return found


def _draw(key: Column, child: Column, seed: int) -> Column:
    """The weighted draw of a child: the logarithm of a number in (0, 1) that key and child alone decide,
    divided by the weight. The largest wins with a probability in proportion to its weight."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), child["name"], F.lit(":"), key).cast("binary"))
    number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
    return F.log((number + 0.5) / float(16 ** DIGITS)) / child["weight"]


def shard_of(key: Column, tree: Tree, seed: int = SEED) -> Column:
    """The shard of a key: the winner of the draws at each level, from the root down.

    The tree is a literal of the plan, of one entry per node. A draw does not depend on other
    children or on their number. If weights change, only draws of the nodes above them change, so a row
    moves only if a subtree whose weight rose takes it or one whose weight fell gives it up. Equal draws
    go to the larger name.
    """
    nodes = children(tree)
    literal = F.create_map(*[part for node, below in nodes.items() for part in (
        F.lit(node), F.array(*[F.struct(F.lit(name).alias("name"), F.lit(weight).alias("weight"))
                               for name, weight in below]))])

    def winner(node: Column) -> Column:
        draws = F.transform(F.element_at(literal, node), lambda child: F.struct(
            _draw(key, child, seed).alias("draw"), child["name"].alias("name")))
        return F.array_max(draws)["name"]

    return winner(winner(winner(F.lit("")))).cast("int")


def assigned(docs: DataFrame, shards: int = SHARDS, carry: tuple[str, ...] = ("doc_id",), seed: int = SEED,
             ) -> DataFrame:
    """Every row's shard, its place there, and its shard if there were one more.

    ``docs`` has ``doc_id`` and ``text``; the columns in ``carry`` are kept in a struct ``row``, so no
    name can clash. ``doc_id`` and the number of shards decide the shard. ``slot`` is gapless in
    a shard and follows a digest of the id, then id, size and checksum; rows equal in all of them, such as repeated rows, take
    neighbouring slots in the order they are stored. Null texts are empty, a null id is a key like any
    other, an empty table gives an empty one. A text's length costs one pass for its checksum; it
    moves only if it is carried.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = durable(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col("doc_id").alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:slot:"), key).cast("binary")).alias("place"),
        shard_of(key, tree_of(shards), seed).alias("shard"),
        shard_of(key, tree_of(shards + 1), seed).alias("grown_shard")))
    order = [F.col("place"), F.col("id").asc_nulls_first(), F.col("size"), F.col("text_crc32")]
    return with_positions(rows, ["shard"], order, "slot").select(
        "row", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """All columns of ``docs`` as Parquet files in one folder per shard, with ``size`` and ``slot`` beside them.

    Files are cut by slots, so that no task writes a whole shard.
    """
    rows = assigned(docs, shards, tuple(docs.columns), seed).select("row", "size", "slot", "shard")
    rows.repartition("shard", F.floor(F.col("slot") / F.lit(10_000))).sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)
