"""Quality rules: repetition within a text, and lines that too many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loamlens.llm.common import SPACE, packed, text_key, unpacked
from loamlens.session import durable

SYMBOLS = r"[#*$%&|<>]"
#: white space within a line that is not one space
UNEVEN = r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]"
#: fewest words; largest share (in percent) of words in repeated three-word windows
MIN_WORDS, MAX_REPEATED = 50, 50
#: a line is boilerplate beyond so many documents of its host, and beyond this share of them (of a share of
#: None, the number alone decides)
MAX_DOCS, MAX_SHARE = 20, 0.1
#: a document is depleted if more than this share of its words stood in removed lines
MAX_REMOVED = 0.5


def _words(text: str | Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def normalised(line: Column) -> Column:
    """Lower case, one space between words, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))


def _lines(text: str | Column) -> Column:
    """Every line that has a word, normalised; the text is searched once, for what isn't a single space already."""
    column = F.col(text) if isinstance(text, str) else text
    spaced = F.regexp_replace(F.lower(column), UNEVEN, " ")
    return F.array_remove(F.transform(F.split(spaced, "\n", -1), lambda l: F.trim(l)), "")


def _line_digests(text: str | Column) -> Column:
    return F.transform(_lines(text), lambda l: F.xxhash64(l))


def _line_rows(text: str | Column) -> Column:
    """Digest and number of words of every line that has a word, after normalising."""
    return F.transform(_lines(text), lambda l: F.struct(
        F.xxhash64(l).alias("h"),
        (F.octet_length(l) - F.octet_length(F.replace(l, F.lit(" "))) + 1).cast("bigint").alias("w")))


def base_rules(docs: DataFrame) -> DataFrame:
    """Adds the base counts and ``base_failed`` to rows that have a ``text``; the text goes.

    All of it is arithmetic on one row's arrays: windows are sorted by digest, so that equal ones are
    neighbours, which takes n log n steps for n words. Texts without equal windows, most of them, sort nothing.
    """
    kept = [c for c in docs.columns if c != "text"]
    worded = F.filter(F.split("text", "\n", -1), lambda l: F.ltrim(l, F.lit(" \t\n\x0b\x0c\r")) != "")
    df = docs.select(
        *kept, _words("text").alias("words"), worded.alias("worded"),
        (F.size(F.split("text", SYMBOLS, -1)) - 1).cast("bigint").alias("n_symbols"))
    digests = F.when(F.size("words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
    df = df.select(*kept, F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"), "n_symbols",
                   F.size("words").cast("bigint").alias("n_words"),
                   (F.size("worded") - F.size(F.array_distinct("worded"))).cast("bigint")
                   .alias("n_dup_lines"),
                   F.coalesce(digests, F.array().cast("array<bigint>")).alias("digests"))
    windows = F.when(F.size(F.array_distinct("digests")) < F.size("digests"), F.sort_array(F.transform(
        "digests", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.select(*kept, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                   F.coalesce(windows, F.array().cast("array<struct<h:bigint,i:int>>")).alias("windows"))
    twice = F.filter("windows", lambda x, i: (F.get("windows", i + 1)["h"] == x["h"])
                     | (F.get("windows", i - 1)["h"] == x["h"]))
    spread = F.array_distinct(F.flatten(F.transform(
        twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    df = df.select(*kept, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                   F.size(spread).cast("bigint").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    return df.withColumn("base_failed", failed)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("*", F.coalesce("source", F.lit("")).alias("host"), text_key().alias("key"))


def frequent_lines(docs: DataFrame, max_docs: int = MAX_DOCS,
                   max_share: float | None = MAX_SHARE) -> DataFrame:
    """``host`` and digest ``h`` of the lines above the limits; a stored table.

    A document counts once per host and line, and equal texts are one document, so that copies alone
    don't make a text boilerplate. Counts combine before every shuffle, so neither a hot host nor a hot
    line meets in one task. With a ``max_share`` a host has at most 1/``max_share`` times as many such
    lines as its documents have on average, but the limit grows with the host; without (None) it is the
    same for every size of host.
    """
    lines = _keyed(docs.select("source", F.coalesce("text", F.lit("")).alias("text")))
    lines = lines.select("host", "key", F.array_distinct(_line_digests("text")).alias("hs"))
    each = lines.select("host", "key", F.explode("hs").alias("h")).distinct()
    counts = each.groupBy("host", "h").agg(F.count("*").alias("n")).where(F.col("n") > max_docs)
    if max_share is None:
        return durable(counts.select("host", "h"))
    sizes = lines.select("host", "key").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    return durable(counts.join(sizes, "host").where(F.col("n") > F.col("docs") * max_share)
                   .select("host", "h"))


def _removed(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """``host``, ``key`` and the digests ``gone`` of a text's lines above the limits."""
    lines = _keyed(docs.select("source", F.coalesce("text", F.lit("")).alias("text")))
    each = lines.select("host", "key", F.explode(F.array_distinct(_line_digests("text"))).alias("h"))
    return each.join(frequent, ["host", "h"]).groupBy("host", "key").agg(
        F.collect_set("h").alias("gone"))


def verdicts(docs: DataFrame, max_docs: int = MAX_DOCS, max_share: float | None = MAX_SHARE,
             max_removed: float = MAX_REMOVED) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``, ``source``): counts, ``base_failed``, ``kept``.

    Lines above the limits of their host are taken out; a text that loses more than ``max_removed`` of
    its words is depleted and not kept. Null texts have no words and fail; a null ``source`` is a host
    of its own (that of the empty name); repeated rows get the same verdict; an empty table gives an
    empty one.
    """
    judged = _judged(docs, ["doc_id"], max_docs, max_share, max_removed)
    return judged.drop("host", "key", "gone")


def _judged(docs: DataFrame, kept: list[str], max_docs: int, max_share: float | None,
            max_removed: float) -> DataFrame:
    """Counts and verdict of every row with ``host``, ``key``, ``gone`` and the columns in ``kept``."""
    gone = _removed(docs, frequent_lines(docs, max_docs, max_share))
    rows = _keyed(docs.select(*kept, "source", F.coalesce("text", F.lit("")).alias("text")))
    # stored, as a filter on a count would else be pushed into the arrays and split texts per word
    base = durable(base_rules(rows.select(*kept, "host", "key", "text",
                                          _line_rows("text").alias("lines"))))
    lost = F.aggregate(F.filter("lines", lambda l: F.array_contains("gone", l["h"])),
                       F.lit(0).cast("bigint"), lambda s, l: s + l["w"])
    joined = base.join(gone, ["host", "key"], "left").withColumn(
        "n_removed_words", F.when(F.col("gone").isNull(), F.lit(0).cast("bigint")).otherwise(lost))
    stays = ~F.col("base_failed") & (F.col("n_removed_words") <= F.col("n_words") * max_removed)
    return joined.select(*kept, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "n_removed_words", "base_failed", stays.alias("kept"),
                         "host", "key", "gone")


def filtered(docs: DataFrame, max_docs: int = MAX_DOCS, max_share: float | None = MAX_SHARE,
             max_removed: float = MAX_REMOVED) -> DataFrame:
    """``docs`` without rejected documents, the others without their lines above the limits.

    ``n_chars`` is counted anew where the text changes, all other columns stay.
    """
    columns = docs.columns
    # equal texts of a host have one verdict
    passed = _judged(docs, [], max_docs, max_share, max_removed).where("kept")
    passed = durable(passed.select("host", "key", "gone").dropDuplicates(["host", "key"]))
    rows = packed(docs).select("row", F.coalesce("row.source", F.lit("")).alias("host"),
                               text_key("row.text").alias("key"))
    kept = rows.join(passed, ["host", "key"]).withColumn(
        "kept_lines", F.filter(F.split("row.text", "\n", -1), lambda l: ~F.array_contains(
            "gone", F.xxhash64(normalised(l)))))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join("kept_lines", "\n"))
    changed = {"text": text}
    if "n_chars" in columns:
        changed["n_chars"] = F.when(F.col("gone").isNull(), F.col("row.n_chars")).otherwise(
            F.char_length(text)).cast(docs.schema["n_chars"].dataType)
    return unpacked(kept, columns, **changed)
