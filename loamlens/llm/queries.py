"""One query per operator over its whole table, and SQL for the same rows where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loamlens.llm import (
    decontam, html_text, langid, line_dedup, negatives, quality, resample, secrets, shards, simhash,
    toxicity, unigram, warc)
from loamlens.llm.common import read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(F.col("row.doc_id").alias("doc_id"), "text", "n_removed")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(read(spark, sf_dir, "documents"))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.revisits_of_pages(spark, sf_dir)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions are scanned with the base rules; then only what that ledger lacks, the added rules."""
    docs = read(spark, sf_dir, "documents")
    _, ledger = secrets.scan_history(docs, rules=secrets.BASE_RULES)
    return secrets.secrets(docs, ledger)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(read(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(read(spark, sf_dir, "pages"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.round_trip(read(spark, sf_dir, "documents"), unigram.default_model(spark))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resample.resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return rows.select(F.col("row.doc_id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assigned(read(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "size", "text_crc32", "law", "shard", "slot", "grown_shard")


QUERIES = {q.__name__: q for q in (
    op1_toxicity, op2_line_dedup, op3_simhash, op4_language, op5_warc_revisits, op6_secrets,
    op7_quality, op8_decontamination, op9_html_text, op10_sentencepiece, op11_negatives, op12_resampling, op13_shards)}

_SPACE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LINE_DEDUP = rf"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(generate_series(1, len(string_split(text, chr(10))))) AS raw
  FROM documents WHERE text IS NOT NULL),
tidy AS (SELECT *, regexp_replace(line, '^{_SPACE}|{_SPACE}\z', '', 'g') AS t FROM cut),
worded AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY raw) AS i
           FROM tidy WHERE t <> ''),
wins AS (SELECT doc_id, i, t AS t0, lead(t, 1) OVER w AS t1, lead(t, 2) OVER w AS t2
         FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY t0, t1, t2 ORDER BY doc_id, i) AS nth
           FROM wins WHERE t2 IS NOT NULL),
covered AS (SELECT DISTINCT doc_id, i + k AS i FROM ranked, (VALUES (0), (1), (2)) ks(k) WHERE nth > 1),
gone AS (SELECT w.doc_id, w.raw FROM worded w JOIN covered c ON w.doc_id = c.doc_id AND w.i = c.i),
kept AS (SELECT t.doc_id, string_agg(t.line, chr(10) ORDER BY t.raw) AS text
         FROM tidy t ANTI JOIN gone g ON t.doc_id = g.doc_id AND t.raw = g.raw GROUP BY t.doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(c.n, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id LEFT JOIN counts c ON d.doc_id = c.doc_id
"""

_CANONICAL = r"""
host_path AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*\z', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
  FROM log),
pieces AS (
  SELECT *, regexp_extract(bare, '^([^?]*)', 1) AS address, regexp_extract(bare, '\?(.*)\z', 1) AS q
  FROM host_path),
named AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(address, '^([^/]*)', 1)),
              ':(80|443)\z', ''), '^(www|m)\.', '')
         || regexp_replace(regexp_extract(address, '^[^/]*(.*)\z', 1), '/+\z', '') AS place,
         list_sort(list_filter(string_split(q, '&'), lambda p: p <> ''
           AND NOT regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid|sessionid)(=|\z)'))) AS args
  FROM pieces),
canon AS (SELECT *, place || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&')
                                  ELSE '' END AS curl FROM named)"""

_WARC = rf"""
WITH log AS (
  SELECT page_id * 3 AS record_id, url, page_id * 10 AS seen, 'response' AS kind,
         md5(coalesce(html, '')) AS etag, 'day ' || (page_id % 30) AS modified,
         md5(coalesce(html, '')) AS digest FROM pages
  UNION ALL
  SELECT page_id * 3 + 1, url, page_id * 10 + 5 + (page_id % 7) * 1000, 'revisit',
         CASE WHEN page_id % 5 = 0 THEN 'stale' ELSE md5(coalesce(html, '')) END, NULL,
         md5(coalesce(html, '')) FROM pages
  UNION ALL
  SELECT page_id * 3 + 2, url, page_id * 10 + 8 + (page_id % 11) * 5000, 'revisit', NULL,
         'day ' || (page_id % 30), NULL FROM pages WHERE page_id % 3 = 0),
{_CANONICAL},
responses AS (SELECT * FROM canon WHERE kind = 'response'
              QUALIFY row_number() OVER (PARTITION BY curl, seen ORDER BY record_id DESC) = 1),
found AS (
  SELECT v.record_id, v.url, v.seen, r.record_id AS original_id, r.seen AS original_at, r.etag AS tag,
         coalesce(v.etag = r.etag, v.modified = r.modified, v.digest = r.digest) AS same
  FROM (SELECT * FROM canon WHERE kind = 'revisit') v
  ASOF LEFT JOIN responses r ON v.curl = r.curl AND v.seen > r.seen),
told AS (
  SELECT *, CASE WHEN original_id IS NULL THEN 'missing' WHEN same IS NULL THEN 'unchecked'
                 WHEN same THEN 'resolved' ELSE 'mismatch' END AS status FROM found)
SELECT record_id, url, seen AS at, original_id, original_at, status,
       CASE WHEN status <> 'resolved' THEN ''
            WHEN record_id % 3 = 1 THEN 'cache-control=max-age=90;content-type=text/html;date=' || seen
                                        || ';etag=' || tag
            ELSE 'cache-control=max-age=60;content-type=text/html;date=' || seen || ';etag=' || tag
                 || ';expires=0' END AS headers
FROM told
"""


def _secrets_sql() -> str:
    scans = []
    for rank, rule in enumerate(secrets.RULES):
        # this engine has no look-behind: the character before is part of the match, then left out
        body = rule.body.replace("'", "''")
        pattern, inner = (f"(?:^|[^{rule.before}])({body})", 1) if rule.before else (body, 0)
        scans.append(f"""
  SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, {rule.least} AS least,
         list_transform(string_split_regex(body, '{pattern}'), lambda x: length(x)) AS gaps,
         list_transform(regexp_extract_all(body, '{pattern}', 0), lambda x: length(x)) AS sizes,
         list_transform(regexp_extract_all(body, '{pattern}', {inner}), lambda x: length(x)) AS inner_sizes,
         list_transform(regexp_extract_all(body, '{pattern}', {rule.group or inner}), lambda x: length(x)) AS held
  FROM docs WHERE regexp_matches(body, '{pattern}')""")
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
scans AS ({' UNION ALL '.join(scans)}),
numbered AS (SELECT *, unnest(generate_series(1, len(sizes))) AS i FROM scans),
spans AS (
  SELECT doc_id, rank, kind,
         CAST(list_sum(gaps[1:i]) + list_sum(sizes[1:i]) - inner_sizes[i] AS BIGINT) AS start,
         CAST(list_sum(gaps[1:i]) + list_sum(sizes[1:i]) AS BIGINT) AS stop
  FROM numbered WHERE held[i] >= least),
told AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)
           FILTER (rank < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM docs d LEFT JOIN told t ON d.doc_id = t.doc_id
"""


_QUALITY = rf"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS body FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(body, '{_SPACE}'), lambda w: w <> '') AS words,
         list_filter(string_split(body, chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS worded
  FROM docs),
places AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i
           FROM split WHERE len(words) >= 3),
wins AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i+1], words[i+2]) AS n
         FROM places),
spread AS (SELECT DISTINCT doc_id, i + k AS i FROM wins, (VALUES (0), (1), (2)) ks(k) WHERE n > 1),
repeats AS (SELECT doc_id, count(*) AS n FROM spread GROUP BY doc_id),
base AS (
  SELECT s.doc_id, host, body, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(worded) - len(list_distinct(worded)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM split s LEFT JOIN repeats r ON s.doc_id = r.doc_id),
lines AS (
  SELECT doc_id, host, body,
         unnest(list_transform(string_split(body, chr(10)), lambda l:
           trim(regexp_replace(lower(l), '{_SPACE}', ' ', 'g'), ' '))) AS line FROM docs),
counted AS (SELECT host, line, count(DISTINCT body) AS n FROM lines WHERE line <> '' GROUP BY ALL),
sizes AS (SELECT host, count(DISTINCT body) AS docs FROM docs GROUP BY host),
frequent AS (SELECT host, line FROM counted JOIN sizes USING (host)
             WHERE n > {quality.MAX_DOCS} AND n > docs * {quality.MAX_SHARE}),
lost AS (SELECT doc_id, sum(len(string_split(line, ' '))) AS n
         FROM lines JOIN frequent USING (host, line) GROUP BY doc_id),
judged AS (
  SELECT b.*, coalesce(l.n, 0) AS n_removed_words,
         n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words
           AS base_failed
  FROM base b LEFT JOIN lost l ON b.doc_id = l.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       CAST(n_removed_words AS BIGINT) AS n_removed_words, base_failed,
       NOT base_failed AND n_removed_words <= n_words * {quality.MAX_REMOVED} AS kept
FROM judged
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                             '{_WORD}') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                         '{_WORD}') AS words FROM benchmark),
items AS (
  SELECT DISTINCT item_id, least({decontam.WINDOW}, len(words)) AS n, unnest(list_transform(
           generate_series(1, greatest(1, len(words) - {decontam.WINDOW - 1})),
           lambda i: array_to_string(words[i:i + {decontam.WINDOW - 1}], ' '))) AS win
  FROM b WHERE len(words) > 0),
places AS (
  SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i
  FROM d, (SELECT DISTINCT n FROM items) WHERE len(words) >= n),
hits AS (
  SELECT p.doc_id, p.i, p.n, t.item_id FROM places p
  JOIN items t ON p.n = t.n AND array_to_string(p.words[p.i:p.i + p.n - 1], ' ') = t.win),
hit_words AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS w
              FROM (SELECT DISTINCT doc_id, i, n FROM hits)),
per_doc AS (SELECT doc_id, count(*) AS n_hit FROM hit_words GROUP BY doc_id),
per_item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per_doc p ON d.doc_id = p.doc_id LEFT JOIN per_item i ON d.doc_id = i.doc_id
"""

#: the steps of CRC-32 over the bytes ``bs``, with a table built from its polynomial
_CRC_TABLE = """
crc_steps(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM crc_steps WHERE k = 8)"""
_CRC = "xor(list_reduce(bs, lambda s, x: xor(s >> 8, crcs[(xor(s, x) & 255) + 1]), 4294967295), 4294967295)"
_BYTES = """list_transform(generate_series(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)"""


def _shards_sql() -> str:
    def descent(name: str, n_shards: int) -> str:
        nodes = shards.children(shards.tree_of(n_shards))
        listed = ", ".join(f"('{node}', '{child}', {weight}::DOUBLE)"
                           for node, below in nodes.items() for child, weight in below)
        levels, at = [f"{name}_0 AS (SELECT key, '' AS node FROM keys)"], f"{name}_0"
        for level in (1, 2, 3):
            levels.append(f"""
{name}_{level} AS (
  SELECT key, child AS node FROM {at} JOIN {name}_tree t ON node = t.parent
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY ln(
    (('0x' || substr(md5('{shards.SEED}:' || child || ':' || key), 1, {shards.DIGITS}))::BIGINT + 0.5::DOUBLE)
    / {float(16 ** shards.DIGITS)}::DOUBLE) / weight DESC, child DESC) = 1)""")
            at = f"{name}_{level}"
        return f"{name}_tree(parent, child, weight) AS (VALUES {listed}), " + ", ".join(levels)

    return f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key, coalesce(text, '') AS text,
                hex(encode(coalesce(text, ''))) AS h FROM documents),
keys AS (SELECT DISTINCT key FROM docs),
{descent("now", shards.SHARDS)}, {descent("grown", shards.SHARDS + 1)},
sums AS (SELECT text, {_CRC} AS text_crc32
         FROM (SELECT DISTINCT text, {_BYTES} AS bs FROM docs), crc_table),
placed AS (
  SELECT d.doc_id, d.key, CAST(octet_length(encode(d.text)) + {shards.ROW_BYTES} AS BIGINT) AS size,
         CAST(s.text_crc32 AS BIGINT) AS text_crc32, CAST(n.node AS INTEGER) AS shard,
         CAST(g.node AS INTEGER) AS grown_shard
  FROM docs d JOIN sums s ON d.text = s.text JOIN now_3 n ON d.key = n.key JOIN grown_3 g ON d.key = g.key)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5('{shards.SEED}:slot:' || key), doc_id NULLS FIRST,
                          size, text_crc32) - 1 AS slot
FROM placed
"""

_NEGATIVES = f"""
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({negatives.SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
near AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {negatives.POSITIVES})
SELECT n.anchor_id, positive_id, s.id AS negative_id, positive_score, s.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY n.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
FROM near n JOIN scored s ON n.anchor_id = s.anchor_id AND NOT s.same
 AND 100 * s.score BETWEEN {negatives.LOWEST} * positive_score AND {negatives.HIGHEST} * positive_score
QUALIFY rank <= {negatives.NEGATIVES}
"""

_RESAMPLING = rf"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS i, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS words
      FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}')) AS w
      FROM benchmark),
per_doc AS (SELECT i, w, count(*) AS n FROM (SELECT i, unnest(words) AS w FROM d) GROUP BY i, w),
hashed AS (
  SELECT w, {_CRC} % {resample.BUCKETS} AS bucket
  FROM (SELECT w, {_BYTES} AS bs FROM (SELECT w, hex(encode(w)) AS h
        FROM (SELECT w FROM per_doc UNION SELECT w FROM b))), crc_table),
ours AS (SELECT bucket, CAST(sum(n) AS DOUBLE) AS s FROM per_doc JOIN hashed USING (w) GROUP BY bucket),
theirs AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS t FROM b JOIN hashed USING (w) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM ours) AS all_s, (SELECT coalesce(sum(t), 0) FROM theirs) AS all_t),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + {resample.BUCKETS})
                      / ((s + 1) * (all_t + {resample.BUCKETS})))) AS BIGINT) AS gain
  FROM ours LEFT JOIN theirs USING (bucket), sums),
weights AS (
  SELECT i, CAST(floor(sum(gain * n)::DOUBLE / sum(n)) AS BIGINT) AS weight
  FROM per_doc JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY i),
scored AS (
  SELECT d.i, doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((
           ('0x' || substr(sha256('{resample.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights v ON d.i = v.i),
ranked AS (
  SELECT i, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS able
  FROM scored WHERE n_features >= {resample.MIN_WORDS})
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN rank <= able * {resample.PERCENT} // 100 THEN rank END AS rank
FROM scored s LEFT JOIN ranked r ON s.i = r.i
"""


SQL = {"op2_line_dedup": _LINE_DEDUP, "op5_warc_revisits": _WARC, "op6_secrets": _secrets_sql(),
       "op7_quality": _QUALITY, "op8_decontamination": _DECONTAMINATION,
       "op11_negatives": _NEGATIVES, "op12_resampling": _RESAMPLING, "op13_shards": _shards_sql()}
