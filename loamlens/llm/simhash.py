"""SimHash near-duplicates: pigeonhole blocks find the pairs, the bit distance settles them."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from loamlens.llm.common import packed, unpacked
from loamlens.llm.components import components
from loamlens.session import durable

BITS = 64
#: shingles turned into bits at once, which bounds a worker's memory for any text
STEP = 1 << 15
#: texts that a worker holds besides the batch it was given
ROWS = 512
#: fingerprints of one block compared in memory; larger blocks go through their neighbour balls
BLOCK_LIMIT = 20_000
_WEIGHTS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def fingerprint(text: str | None, words_each: int = 4, seed: int = 42) -> int:
    """The signed 64-bit SimHash of a text; 0 without words.

    A-Z is lower-cased, words are separated by ASCII white space, shingles are joined by one space
    and counted as often as they occur; a shorter text is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    count = max(1, len(words) - words_each + 1)
    last = min(words_each, len(words)) - 1
    ends = (starts + lengths)[last:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, STEP):
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(joined[a:b], seed)
             for a, b in zip(starts[at:at + STEP].tolist(), ends[at:at + STEP].tolist())),
            np.uint64, min(STEP, count - at))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(_WEIGHTS[ones * 2 > count].sum(dtype=np.uint64).view(np.int64))


def fingerprints(texts: pa.Array, words_each: int = 4) -> list[int]:
    """The SimHash of each text; a worker makes at most ``ROWS`` of them strings at a time."""
    return [fingerprint(t, words_each) for at in range(0, len(texts), ROWS)
            for t in texts.slice(at, ROWS).to_pylist()]


def with_fingerprint(docs: DataFrame, words_each: int = 4) -> DataFrame:
    """``row`` columns plus ``text`` become the same without the text but with ``fp``, a bigint."""
    kept = [c for c in docs.columns if c != "text"]
    schema = docs.select(*kept, F.lit(0).cast("bigint").alias("fp")).schema

    def run(batches):
        for batch in batches:
            fps = fingerprints(batch.column("text"), words_each)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(fps, pa.int64())], [*kept, "fp"])

    return docs.mapInArrow(run, schema)


def block_masks(distance: int, blocks: int) -> list[int]:
    """A mask for every choice of ``blocks - distance`` of ``blocks`` even blocks of bits.

    Fingerprints at most ``distance`` bits apart agree in at least that many blocks, so they are equal
    under one of the masks.
    """
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [sum(1 << bit for bit in range(a, b)) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _spanning(members: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Edges that join what is linked within one block, one per fingerprint reached."""
    far, near, rest = [], [], members
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            close = np.bitwise_count(rest ^ at) <= distance
            if close.any():
                found = rest[close]
                far.append(found)
                near.append(np.full(len(found), at))
                frontier.extend(found)
                rest = rest[~close]
    return far, near


def _linked(distance: int, limit: int):
    """Rows sorted by block to edges ``(a, b)``; members of an oversized block have a null ``b``."""
    def run(batches):
        held = (np.empty(0, np.int64),) * 3
        oversized = None
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "block", "fp")]
            mask, block, fp = (np.concatenate([a, b]) for a, b in zip(held, new))
            if not len(fp):
                continue
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (block[1:] != block[:-1])) + 1
            starts = np.concatenate([[0], cuts])
            yield from _edges(fp, mask, block, starts[:-1], starts[1:], oversized)
            tail = starts[-1]
            held = mask[tail:], block[tail:], fp[tail:]
            if oversized is not None and (held[0][0], held[1][0]) != oversized:
                oversized = None
            if oversized is not None or len(held[2]) > limit:  # passed on at once, never gathered
                yield _batch(held[2], None)
                oversized = (held[0][-1], held[1][-1])
                # one member stays, marks the block and is passed on again with what follows
                held = tuple(x[-1:] for x in held)
        if len(held[2]):
            yield from _edges(held[2], held[0], held[1], np.array([0]), np.array([len(held[2])]),
                              oversized)

    def _edges(fp, mask, block, starts, ends, oversized):
        several = np.flatnonzero(ends - starts > 1)
        far, near = [], []
        for i in several:
            members = fp[starts[i]:ends[i]].view(np.uint64)
            if len(members) > limit or (mask[starts[i]], block[starts[i]]) == oversized:
                yield _batch(members.view(np.int64), None)
                continue
            a, b = _spanning(members, distance)
            far += a
            near += b
        if far:
            yield _batch(np.concatenate(far).view(np.int64), np.concatenate(near).view(np.int64))

    def _batch(a, b):
        b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b], ["a", "b"])

    return run


def _ball_links(members: DataFrame, distance: int) -> DataFrame:
    """Exact links for blocks too large to compare: balls of half the distance that meet.

    Two fingerprints at most ``distance`` apart have a point within half of it of each. Every member
    names the points of its ball, and is tied to the smallest member of each point: linear in the
    members, whatever the size of a block. For an odd distance the rounded-up radius is too wide, so
    it isn't offered.
    """
    if distance % 2:
        raise ValueError("the distance must be even")
    masks = [_signed(sum(1 << b for b in flips))
             for r in range(distance // 2 + 1) for flips in combinations(range(BITS), r)]
    points = members.select("a", F.explode(F.array(F.lit(masks))[0]).alias("mask")).select(
        "a", F.col("a").bitwiseXOR(F.col("mask")).alias("point"))
    least = points.groupBy("point").agg(F.min("a").alias("b"))
    return points.join(least, "point").where("a != b").select("a", "b").distinct()


def links(fingerprints: DataFrame, distance: int = 4, blocks: int = 7,
          block_limit: int = BLOCK_LIMIT) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct ``fp`` at most ``distance`` bits apart.

    Every fingerprint has one row per mask (35 of at least 27 bits for 4 of 64), which is all that is
    shuffled. Within a block only a spanning forest is emitted, not all pairs.
    """
    masks = [_signed(m) for m in block_masks(distance, blocks)]
    rows = fingerprints.select("fp", F.posexplode(F.array(*[F.lit(m) for m in masks]))
                               .alias("mask", "bits"))
    rows = rows.select("mask", F.col("fp").bitwiseAND(F.col("bits")).alias("block"), "fp")
    sorted_rows = rows.repartition("mask", "block").sortWithinPartitions("mask", "block", "fp")
    found = durable(sorted_rows.mapInArrow(_linked(distance, block_limit), "a bigint, b bigint"))
    edges = found.where("b is not null").distinct()
    crowded = found.where("b is null").select("a").distinct()
    if crowded.isEmpty():
        return edges
    return edges.unionByName(_ball_links(crowded, distance)).distinct()


def _grouped(docs: DataFrame, words_each: int, distance: int, blocks: int, block_limit: int):
    """The fingerprint of every row, and of every fingerprint ``root``, ``component_id`` and ``first``.

    ``first`` is the id and the text digest of the row that comes first in the component, null ids last.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    printed = durable(with_fingerprint(keyed, words_each))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    nodes = durable(printed.groupBy("fp").agg(F.min(place).alias("least")))
    roots = components(links(nodes.select("fp"), distance, blocks, block_limit))
    rooted = nodes.join(roots.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return printed, rooted.join(first, "root").select(
        "fp", "root", F.col("first.doc_id").alias("component_id"), "first")


def near_duplicates(docs: DataFrame, words_each: int = 4, distance: int = 4, blocks: int = 7,
                    block_limit: int = BLOCK_LIMIT) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``.

    Equal fingerprints are one node, so copies cost nothing further. ``component_id`` is the smallest
    ``doc_id`` of the component; rows without an id get a component too, which is null only if no
    member has an id. Null and empty texts have fingerprint 0 and are linked like others. Repeated
    rows stay. An empty table gives an empty one. Of the input only ``doc_id`` and ``text`` are read.
    """
    printed, groups = _grouped(docs, words_each, distance, blocks, block_limit)
    return printed.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, words_each: int = 4, distance: int = 4,
                            blocks: int = 7, block_limit: int = BLOCK_LIMIT) -> DataFrame:
    """``docs`` with one row per component: that of the smallest ``doc_id``.

    Of its rows that share this id the one with the smallest text digest stays, so a component keeps one
    of its own rows even if the id is in others as well. A component without any id keeps the row with
    the smallest text digest. All columns of the input are kept as they are.
    """
    columns = docs.columns
    rows = packed(docs).select("row", F.col("row.doc_id").alias("doc_id"),
                               F.xxhash64("row.text").alias("key")).alias("d")
    _, groups = _grouped(docs, words_each, distance, blocks, block_limit)
    # equal texts have equal fingerprints, so an id and a text digest name one component
    first = durable(groups.select("root", "first").distinct()).select(
        "root", F.col("first.doc_id").alias("doc_id"), F.col("first.key").alias("key")).alias("f")
    least = rows.join(first, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
                      & (F.col("d.key") == F.col("f.key")))
    return unpacked(least.groupBy("root").agg(F.first("row").alias("row")), columns)
