"""Benchmark decontamination: one Aho-Corasick automaton over test items, one scan of each text."""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loamlens.llm.common import packed

#: words of a window; an item of fewer words is one window
WINDOW = 10
#: windows of one automaton; more are dealt over several, each scanned over the carried rows
MAX_WINDOWS = 50_000
#: rows scanned and given back at once
ROWS = 512

# A-Z to a-z, letters of other scripts and digits kept, everything else of ASCII to a space
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))


def _folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def words_of(text: str | None) -> list[bytes]:
    """Normalised words, as UTF-8; none for a null text."""
    return _folded(text).split()


def windows_of(text: str | None, size: int = WINDOW) -> set[bytes]:
    words = words_of(text)
    return {b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} - {b""}


def automaton(windows: dict[bytes, list]) -> ahocorasick.Automaton:
    """Patterns are padded with a space at both ends, so that they match whole words only.

    Bytes are given to the automaton as one character each. A value is the number of words and the
    items of the window.
    """
    built = ahocorasick.Automaton()
    for window, items in windows.items():
        built.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, tuple(items)))
    if windows:
        built.make_automaton()
    return built


def scan(text: str | None, built: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, merged half-open ranges of hit words, and the items found, in one scan."""
    words = words_of(text)
    if not words or not len(built):
        return len(words), [], set()
    hits, items = [], set()
    for end, (size, found) in built.iter(f" {b' '.join(words).decode('latin-1')} "):
        hits.append((end, size))
        items.update(found)
    if not hits:
        return len(words), [], items
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    last = np.searchsorted(ends, [end for end, _ in hits])
    return len(words), merged((int(i) + 1 - n, int(i) + 1) for i, (_, n) in zip(last, hits)), items


def merged(ranges) -> list[tuple[int, int]]:
    """Overlapping or touching half-open ranges as one."""
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as ranges of code points of the text as it was given."""
    if not ranges:
        return []
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.frombuffer(_folded(text), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [(int(point[starts[a]]), int(point[ends[b - 1]])) for a, b in ranges]


def _windows(items: DataFrame, size: int) -> list[dict[bytes, list]]:
    """The windows of all items, in blocks of bounded size, read from the driver's side one by one."""
    blocks: list[dict[bytes, list]] = []
    found: dict[bytes, set] = {}
    for row in items.select("item_id", "text").toLocalIterator():
        for window in windows_of(row.text, size):
            found.setdefault(window, set()).add(row.item_id)
    ordered = sorted(found)
    for at in range(0, len(ordered), MAX_WINDOWS):
        blocks.append({w: sorted(found[w], key=lambda i: (i is None, i))
                       for w in ordered[at:at + MAX_WINDOWS]})
    return blocks or [{}]


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``row`` (the whole row of ``docs``), ``n_words``, ``spans``, ``ranges`` and ``item_ids``.

    ``docs`` needs ``text``, ``items`` needs ``item_id`` and ``text``. ``ranges`` are the merged
    half-open ranges of hit words, ``spans`` the same in code points of the original text,
    ``item_ids`` the distinct items as strings, sorted as strings; an item without an id counts as
    "null". Null texts have no words; items without a word have no window; without any item nothing
    is hit; repeated rows of either table give the same results again. The documents are neither
    shuffled nor joined. The items are the stated query set: they are held by the driver, and in tasks
    one automaton of at most ``MAX_WINDOWS`` windows is held at a time.
    """
    spark = docs.sparkSession
    df = packed(docs).select("row", F.col("row.text").alias("text"))
    df = df.withColumns({"n_words": F.lit(0).cast("bigint"),
                         "ranges": F.lit(None).cast("array<struct<a:bigint,b:bigint>>"),
                         "spans": F.lit(None).cast("array<struct<a:bigint,b:bigint>>"),
                         "item_ids": F.lit(None).cast("array<string>")})
    for block in _windows(items, size):
        key = hashlib.sha256(repr(sorted(block.items())).encode()).hexdigest()
        df = df.mapInArrow(_scanner(spark.sparkContext.broadcast(block), key), df.schema)
    return df.drop("text")


_built: dict[str, ahocorasick.Automaton] = {}


def _scanner(shared, key: str):
    def run(batches):
        if key not in _built:  # one automaton per worker, whatever the number of its tasks
            _built.clear()
            _built[key] = automaton(shared.value)
        built = _built[key]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                yield _scanned(whole.slice(at, ROWS), built)
    return run


def _scanned(batch: pa.RecordBatch, built: ahocorasick.Automaton) -> pa.RecordBatch:
    n_words, ranges, spans, item_ids = [], [], [], []
    earlier = zip(batch.column("ranges").to_pylist(), batch.column("item_ids").to_pylist())
    for text, (hit, known) in zip(batch.column("text").to_pylist(), earlier):
        n, new, items = scan(text, built)
        if hit:
            new = merged([*new, *((h["a"], h["b"]) for h in hit)])
        n_words.append(n)
        ranges.append([{"a": a, "b": b} for a, b in new])
        spans.append([{"a": a, "b": b} for a, b in original_spans(text, new)] if new else [])
        item_ids.append(sorted({"null" if i is None else str(i) for i in items} | set(known or ())))
    columns = {"n_words": n_words, "ranges": ranges, "spans": spans, "item_ids": item_ids}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else batch.column(f.name)
         for f in batch.schema], schema=batch.schema)


def report(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document: counts of words, hit words and items, and a digest of the items."""
    found = contamination(docs.select("doc_id", "text"), items, size)
    hit = F.aggregate("ranges", F.lit(0).cast("bigint"), lambda s, r: s + r["b"] - r["a"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", hit.alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of an item; columns as given."""
    found = contamination(docs, items, size).where(F.size("ranges") == 0)
    return found.select("row.*")
