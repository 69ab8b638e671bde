"""Importance resampling against brute force in plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loamlens.llm import resample

# fixed values of the contract
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _features(text, max_run=1):
    words = re.findall(WORD, (text or "").translate(LOWER))
    return len(words), [" ".join(words[i:i + n]) for n in range(1, max_run + 1) for i in range(len(words) - n + 1)]


def _bucket(feature, buckets=10_000):
    return zlib.crc32(feature.encode()) % buckets


def _expected(docs, target, percent=10, min_words=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(_bucket, _features(text)[1]))
    for text in target:
        t.update(map(_bucket, _features(text)[1]))
    all_s, all_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log(
        (t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    rows = []
    for doc_id, text in docs:
        n_words, features = _features(text)
        weight = sum(gain(_bucket(f)) for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(features), weight, score, n_words >= min_words))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    drawn = able[:len(able) * percent // 100]
    left = [(*r[:4], None) for r in able[len(drawn):] + [r for r in rows if not r[4]]]
    return sorted([(*r[:4], i) for i, r in enumerate(drawn, 1)] + left, key=repr)


def _found(df):
    return sorted((tuple(r) for r in df.select("row.doc_id", "n_features", "weight", "score", "rank").collect()),
                  key=repr)


def test_documents_equal_brute_force(spark, sf_dir):
    docs, target = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    expected = _expected([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert _found(resample.resampled(docs, target)) == expected
    assert sum(r[4] is not None for r in expected) > 10


@pytest.mark.parametrize("max_run", [1, 2, 4])
@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_runs_go_on_over_steps(monkeypatch, max_run, step):
    monkeypatch.setattr(resample, "STEP", step)
    draw = random.Random(max_run * step)
    for _ in range(200):
        text = "".join(draw.choice(["A", "b", "Z9", " ", " ", "\t", "-", "é", " ", "字", "\x00", "_", "{"])
                       for _ in range(draw.randint(0, 40)))
        n_words, features = _features(text, max_run)
        assert resample.feature_counts(text, 97, max_run) == (
            n_words, Counter(_bucket(f, 97) for f in features)), text


def test_odd_rows(spark):
    long = " ".join(f"w{i % 50}" for i in range(300_000))
    rows = [(None, None), (None, "a " * 30), (None, "b " * 30), (1, ""), (2, "..."), (3, long)]
    rows += [(4, "same words again " * 10)] * 60
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs = docs.withColumns({n: F.lit(n) for n in ("row", "id", "able", "score", "rank", "_id", "bucket")})
    target = spark.createDataFrame([("same words",), (None,), ("",)], "text string")
    found = resample.resampled(docs, target, percent=50, carry=tuple(docs.columns))
    assert found.select("row.*").columns == docs.columns
    assert _found(found) == _expected(rows, ["same words"], percent=50)
    assert resample.resampled(docs.limit(0), target).count() == 0
    assert _found(resample.resampled(docs, target.limit(0))) == _expected(rows, [])


def test_drawn_rows_look_like_the_target(spark):
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choice(["soil", "clay", "silt"] if i % 10 == 0 else ["rain", "snow", "sun"])
                         for _ in range(25))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    target = spark.createDataFrame([("clay silt soil " * 4000,)], "text string")
    drawn = resample.resampled(docs, target, carry=("doc_id", "text")).where("rank is not null")
    assert sorted(r.rank for r in drawn.collect()) == list(range(1, 41))
    assert all(r.doc_id % 10 == 0 for r in drawn.select("row.*").collect())
