"""Line dedup over three-line windows that occur again anywhere in the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from loamlens.llm.common import packed, text_key
from loamlens.session import durable

#: ASCII white space
BLANK = " \t\n\x0b\x0c\r"
#: consecutive lines of a window
LINES = 3


def _worded(text: str | Column) -> Column:
    """The lines that hold a word, trimmed, in order."""
    lines = F.transform(F.split(text, "\n", -1),
                        lambda l: F.trim(l, F.lit(BLANK)))
    return F.filter(lines, lambda l: l != "")


def _windows(docs: DataFrame, size: int, short: bool) -> DataFrame:
    """One narrow row per window: 128 bits of digest, and the place of its first line."""
    held = docs.select("doc_id", "key", _worded("text").alias("lines"))
    held = held.where(F.size("lines") >= (1 if short else size))
    parts = lambda i: [F.col("lines")[i + k] for k in range(size)]
    windows = F.transform(
        F.sequence(F.lit(0), F.size("lines") - size),
        lambda i: F.struct(F.xxhash64(*parts(i)).alias("h1"),
                           F.xxhash64(F.lit(size), *parts(i)).alias("h2")))
    if short:  # the whole sequence, and its length, so that it equals no part of a longer one
        whole = F.struct(F.xxhash64(F.size("lines"), "lines").alias("h1"),
                         F.xxhash64(F.lit(size), F.size("lines"), "lines").alias("h2"))
        windows = F.when(F.size("lines") >= size, windows).otherwise(F.array(whole))
    hashed = held.select("doc_id", "key", F.posexplode(windows).alias("pos", "h"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "pos")
    return hashed.select(F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2"), place.alias("place"))


def _rebuilt(size: int):
    @F.pandas_udf(StringType())
    def rebuild(texts, starts):
        return texts.combine(starts, lambda t, s: t if t is None or s is None else _cut(t, s, size))

    return rebuild


def _cut(text: str, starts, size: int) -> str:
    """``text`` without the worded lines covered by a window that starts at one of ``starts``."""
    covered = {start + k for start in starts for k in range(size)}
    kept, at = [], 0
    for line in text.split("\n"):
        if line.strip(BLANK):
            if at not in covered:
                kept.append(line)
            at += 1
        else:
            kept.append(line)
    return "\n".join(kept)


def repeated_windows(docs: DataFrame, size: int = LINES, short: bool = False) -> DataFrame:
    """``doc_id``, ``key`` (digest of the text) and ``starts``: later occurrences in each document.

    With ``short`` a text of fewer than ``size`` worded lines has one window of all of them.

    Occurrences are ordered by ``doc_id`` (null last), text digest and position; the first stays.
    Rows equal in id and text are the same occurrence. Counting combines before the shuffle, and the
    join back has one row per repeated window on its other side, so a window that a third of the rows
    share is split by adaptive execution.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.select("doc_id", "text", text_key().alias("key"))
    windows = durable(_windows(keyed, size, short))
    first = windows.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    first = first.where("last > first").drop("last")
    later = windows.join(first, ["h1", "h2"]).where("place > first")
    return later.groupBy("place.doc_id", "place.key").agg(
        F.collect_set("place.pos").alias("starts"))


def dedup_lines(docs: DataFrame, size: int = LINES, short: bool = False) -> DataFrame:
    """``row`` (the whole row of ``docs``), the new ``text`` and ``n_removed`` lines.

    Lines are compared without white space at their ends; lines without a word never count and always
    stay. Every window of ``size`` consecutive lines that occurred before (see
    ``repeated_windows``) is removed, overlapping windows as one range. Texts of fewer lines have no
    window and stay, or with ``short`` one window of all their lines; null stays null; repeated rows are
    treated alike; an empty table stays empty.
    """
    rows = packed(docs).select("row", F.col("row.doc_id").alias("doc_id"),
                               F.col("row.text").alias("text"))
    rows = rows.withColumn("key", text_key())
    starts = repeated_windows(docs, size, short)
    rows, starts = rows.alias("d"), starts.alias("s")
    joined = rows.join(starts, F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
                       & (F.col("d.key") == F.col("s.key")), "left")
    cut = joined.select("row", F.col("d.text").alias("old"), "starts",
                        _rebuilt(size)(F.when(F.col("starts").isNotNull(), F.col("d.text")),
                                       "starts").alias("cut"))
    spread = F.array_distinct(F.flatten(F.transform(
        "starts", lambda s: F.sequence(s, s + size - 1))))
    # the window of a shorter text ends with the text
    covered = F.least(F.size(spread), F.size(_worded("old"))) if short else F.size(spread)
    return cut.select("row", F.coalesce("cut", "old").alias("text"),
                      F.when(F.col("starts").isNull(), 0).otherwise(covered).cast("bigint")
                      .alias("n_removed"))
