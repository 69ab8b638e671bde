"""Sharding: the law, the draws against plain Python, movement, odd rows, files."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loamlens.llm import shards
from loamlens.llm.ranking import with_positions
from loamlens.session import durable


def _place(key, tree, seed=shards.SEED):
    nodes, node = shards.children(tree), ""
    for _ in range(3):
        def draw(child):
            digest = hashlib.md5(f"{seed}:{child[0]}:{key}".encode()).hexdigest()[:shards.DIGITS]
            return math.log((int(digest, 16) + 0.5) / 16 ** shards.DIGITS) / child[1], child[0]
        node = max(nodes[node], key=draw)[0]
    return int(node)


def test_documents_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    rows = shards.assigned(docs).select("row.doc_id", "size", "text_crc32", "law", "shard", "slot",
                                        "grown_shard").collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id]
        assert (r.size, r.text_crc32, r.law) == (len(text) + 16, zlib.crc32(text), "key")
        assert r.shard == _place(r.doc_id, shards.tree_of(40))
        assert r.grown_shard in (r.shard, 40)
    by_shard = {}
    for r in rows:
        place = hashlib.md5(f"{shards.SEED}:slot:{r.doc_id}".encode()).hexdigest()
        by_shard.setdefault(r.shard, []).append((place, r.slot))
    for placed in by_shard.values():
        assert [slot for _, slot in sorted(placed)] == list(range(len(placed)))


def _shards_of(spark, n, tree):
    keys = spark.range(n).select(F.col("id").cast("string").alias("key"))
    return {int(r.key): r.s for r in keys.select("key", shards.shard_of(F.col("key"), tree).alias("s")).collect()}


def test_one_more_shard_takes_rows_only_into_itself(spark):
    before = _shards_of(spark, 20_000, shards.tree_of(40))
    for n in (41, 42, 43):
        after = _shards_of(spark, 20_000, shards.tree_of(n))
        moved = {k for k in before if before[k] != after[k]}
        assert {after[k] for k in moved} == {n - 1}
        assert 0.7 / n < len(moved) / 20_000 < 1.3 / n
        before = after
    counts = Counter(before.values())
    assert set(counts) == set(range(43))
    assert max(counts.values()) < 1.35 * 20_000 / 43 and min(counts.values()) > 0.7 * 20_000 / 43


def test_weights_draw_and_confine(spark):
    tree = {"a": {"a1": {0: 1.0, 1: 3.0}, "a2": {2: 2.0}}, "b": {"b1": {3: 2.0, 4: 0.0}}}
    before = _shards_of(spark, 16_000, tree)
    share = Counter(before.values())
    assert [round(share[s] / 2000) for s in range(5)] == [1, 3, 2, 2, 0]
    heavier = {"a": {"a1": {0: 1.0, 1: 3.0}, "a2": {2: 4.0}}, "b": {"b1": {3: 2.0, 4: 0.0}}}
    after = _shards_of(spark, 16_000, heavier)
    # region a grew: rows come into it, and within it into rack a2 alone
    for key in before:
        if before[key] == 3:
            assert after[key] in (0, 1, 2, 3)
        else:
            assert after[key] in (before[key], 2)


def test_tree_needs_names_and_weights():
    with pytest.raises(ValueError):
        shards.children({"a": {"x": {0: 1.0}}, "b": {"x": {1: 1.0}}})
    with pytest.raises(ValueError):
        shards.children({"a": {"x": {0: 0.0}}})


def test_odd_rows(spark):
    rows = [(None, None, "n", 1), (None, "", "n", 1), (7, "ü" * 300_000, "x", 2)] + [(5, "same", "x", 3)] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string, slot int")
    docs = docs.withColumns({n: F.lit(n) for n in ("row", "size", "id", "place", "_id", "_range", "law")})
    found = shards.assigned(docs, carry=tuple(docs.columns))
    assert found.select("row.*").columns == docs.columns
    got = found.select("row.doc_id", "size", "text_crc32", F.col("shard").alias("s"), F.col("slot").alias("at"))
    got = got.collect()
    assert len(got) == len(rows)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.s, []).append(r.at)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert len({r.s for r in got if r.doc_id == 5}) == 1
    assert [r["size"] for r in got if r.doc_id == 7] == [600_016]
    assert {(r["size"], r.text_crc32) for r in got if r.doc_id is None} == {(16, 0)}
    assert shards.assigned(docs.limit(0)).count() == 0


def test_positions_of_a_hot_key_span_ranges(spark):
    rows = durable(spark.createDataFrame(
        [("hot", 1)] * 500 + [("hot", i) for i in range(200)] + [("b", i) for i in range(50)], "g string, x int"))
    found = with_positions(rows, ["g"], [F.col("x")], range_rows=40).collect()
    for group in ("hot", "b"):
        placed = sorted((r.position, r.x) for r in found if r.g == group)
        assert [p for p, _ in placed] == list(range(len(placed)))
        assert [x for _, x in placed] == sorted(x for _, x in placed)
    whole = with_positions(rows, [], [F.col("x").desc()], range_rows=40).collect()
    assert sorted(r.position for r in whole) == list(range(750))


def test_written_shards_hold_all_columns(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shards.write_shards(docs, str(tmp_path / "out"), shards=8)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select("row.*").exceptAll(docs).isEmpty() and back.count() == docs.count()
    assert {r.shard for r in back.select("shard").distinct().collect()} <= set(range(8))
