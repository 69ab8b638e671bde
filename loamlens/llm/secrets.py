"""Secret scans over an incremental ledger of blobs: each text is scanned once per rule version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from loamlens.session import durable


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``body`` whose ``group`` has ``least`` code points.

    No match starts after one of the characters ``before``: a body that could start at each character of a
    long run, and run to its end, would take the square of its length.
    """

    kind: str
    version: int
    body: str
    group: int = 0
    least: int = 1
    before: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}/{self.version}"

    @property
    def pattern(self) -> str:
        return f"(?<![{self.before}]){self.body}" if self.before else self.body


# fixed values: the patterns. Character runs state their least length in the pattern where a shorter
# run can hold no match of its own.
RULES = (
    Rule("assign", 1, r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
                      r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?"
                      r"([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", 2, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", before="A-Za-z0-9_-"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")
BASE_RULES = tuple(r for r in RULES if r.kind in BASE)


def blob_of(text: str | Column = "text") -> Column:
    """The address of a content: SHA-256 of its UTF-8; null is the empty text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.coalesce(column, F.lit("")).cast("binary"), 256))


def _matches(rule: Rule) -> Column:
    """Every match with the length of the gap before it; null without a match."""
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(F.split("text", rule.pattern, -1).alias("gap"),
                          F.regexp_extract_all("text", pattern, F.lit(0)).alias("match"),
                          F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("value"))
    # the gap after the last match has no match beside it
    rows = F.filter(zipped, lambda x: x["match"].isNotNull())
    return F.when(F.array_contains("todo", rule.name) & F.col("text").rlike(rule.pattern), F.transform(
        rows, lambda x, i: F.struct(
            F.lit(rule.name).alias("rule"), F.lit(rule.kind).alias("kind"), i.alias("i"),
            F.char_length(x["gap"]).alias("gap"), F.char_length(x["match"]).alias("length"),
            (F.char_length(x["value"]) >= rule.least).alias("holds"))))


def _scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob``, ``text`` and ``todo`` (names of rules) to ``blob``, ``rule``, ``kind``, ``start``, ``end``.

    Positions are running sums of gaps and matches; a window is one blob's matches of one rule.
    """
    none = F.array().cast("array<struct<rule:string,kind:string,i:int,gap:int,length:int,holds:boolean>>")
    found = blobs.select("blob", F.explode(F.flatten(F.array(
        *[F.coalesce(_matches(rule), none) for rule in rules]))).alias("m")).select("blob", "m.*")
    order = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("length")).over(order)
    placed = found.select("blob", "rule", "kind", "holds", "length", end.alias("end"))
    return placed.where("holds").select(
        "blob", "rule", "kind", (F.col("end") - F.col("length")).alias("start"), "end")


def _blobs(versions: DataFrame) -> DataFrame:
    texts = versions.select(F.coalesce("text", F.lit("")).alias("text"))
    return texts.select(blob_of().alias("blob"), "text")


def unseen(versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob``, ``text`` and ``todo``: the distinct blobs, with the rule versions not yet applied to them."""
    names = F.array(*[F.lit(r.name) for r in rules])
    blobs = _blobs(versions).dropDuplicates(["blob"])
    if ledger is None:
        return blobs.withColumn("todo", names)
    done = F.coalesce("rules", F.array().cast("array<string>"))
    return blobs.join(ledger.select("blob", "rules"), "blob", "left").select(
        "blob", "text", F.array_except(names, done).alias("todo")).where(F.size("todo") > 0)


def scan_history(versions: DataFrame, ledger: DataFrame | None = None,
                 rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Scan what no earlier scan has seen; give the findings of all blobs and the new ledger.

    ``versions`` has ``text``, one row for each path and historical version. The ledger has ``blob``,
    ``rules`` (names with versions already applied) and ``findings`` (``rule, kind, start, end``). A
    blob is read in full once per rule version, however many paths and versions hold it. Findings of
    rules that are no longer given stay in the ledger but aren't reported. Both results are stored
    tables. Copies meet after a combine on the map side, so a text held by a third of the rows is no
    hot key. Null texts are the empty blob.
    """
    names = F.array(*[F.lit(r.name) for r in rules])
    new = durable(_scan(unseen(versions, ledger, rules), rules)).groupBy("blob").agg(
        F.collect_list(F.struct("rule", "kind", "start", "end")).alias("fresh"))
    seen = _blobs(versions).select("blob").distinct().join(new, "blob", "left")
    none = F.array().cast("array<struct<rule:string,kind:string,start:bigint,end:bigint>>")
    if ledger is None:
        whole = seen.select("blob", names.alias("rules"), F.coalesce("fresh", none).alias("findings"))
    else:
        old = ledger.select("blob", F.col("rules").alias("old_rules"), F.col("findings").alias("old"))
        whole = seen.withColumn("here", F.lit(True)).join(old, "blob", "full").select(
            "blob",
            F.array_union(F.coalesce("old_rules", F.array().cast("array<string>")),
                          F.when(F.col("here"), names).otherwise(F.array().cast("array<string>")))
            .alias("rules"),
            F.concat(F.coalesce("old", none), F.coalesce("fresh", none)).alias("findings"))
    whole = durable(whole)
    current = F.filter("findings", lambda f: F.array_contains(names, f["rule"]))
    return whole.select("blob", current.alias("findings")), whole


def _written(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def by_path(versions: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id`` and the findings of its text, for every row: counts, base digest and all spans.

    Spans are ``kind:start:end`` in code points, sorted by start and by the place of the rule; repeated
    rows are each reported; a blob shared by many paths is a skewed join side that adaptive execution
    splits.
    """
    rank = F.create_map(*[F.lit(v) for i, r in enumerate(rules) for v in (r.kind, i)])
    ordered = F.array_sort(F.transform("findings", lambda f: F.struct(
        f["start"].alias("start"), F.element_at(rank, f["kind"]).alias("rank"), f["end"].alias("end"),
        f["kind"].alias("kind"))))
    told = findings.where(F.size("findings") > 0).select("blob", ordered.alias("all")).select(
        "blob", "all", F.filter("all", lambda f: f["kind"].isin(*BASE)).alias("base"))
    count = lambda kind: F.size(F.filter("base", lambda f: f["kind"] == kind)).cast("bigint")
    told = told.select("blob", *[count(k).alias(f"n_{k}") for k in BASE],
                       _written(F.col("base")).alias("base_spans"), _written(F.col("all")).alias("spans"))
    paths = versions.select("doc_id", blob_of().alias("blob"))
    joined = paths.join(told, "blob", "left")
    return joined.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("bigint")).alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base_spans", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))


def secrets(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Findings of every row of ``docs`` (``doc_id``, ``text``); an empty table gives an empty one.

    Very long texts are searched whole, in time linear in their length; other columns are not read.
    """
    findings, _ = scan_history(docs, ledger)
    return by_path(docs, findings)
