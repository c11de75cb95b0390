"""The llm operators as queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fim, fingerprints, near_dup, packing, pii, pu, quality_rules, secrets, token_counts, vector_codes, warc
from .common import table


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules, word-window repeats and policy verdict of every document."""
    rows = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file; a machine without the package sets a path of its own."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document by the transducer, decoded again by the streaming decoder."""
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted by scanning flat files of ids for the free id 50256."""
    import public_tokenizers

    rows = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50256)
    return rows.select("doc_id", "n_tokens")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited text, with likeness to that and to the next document."""
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as dictionary-compressed archives and read back."""
    rows = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base patterns, and disguised identifiers by their source spans."""
    return pii.detect(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document, links confirmed on full shingle sets."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).withColumn("component_id", F.col("component_id").cast("long"))


def op2_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from trusted good ones and unlabelled text."""
    return pu.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", 3, lambda r: r == 1, pu.QUALITY)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids along the Hilbert curve."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op6_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document from confirmed toxic ones and unlabelled text."""
    return pu.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", 5, lambda r: r == 0, pu.TOXICITY)


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base patterns, and random strings by two Markov models."""
    rows = secrets.detect(table(spark, sf_dir, "documents"))
    kinds = F.col("base")["kind"]
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in secrets.KINDS[:3]]
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rows.select("doc_id", *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors by 16 codebooks of 64 entries, after two rounds."""
    return vector_codes.codes(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at line ends into prefix, middle and suffix, and rebuilt from its output."""
    rows = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    output = F.sha2("fim_output", 256)
    return rows.select(
        "doc_id", F.col("fim_lines").alias("n"), F.col("fim_form").alias("form"), F.col("fim_prefix").alias("prefix_chars"), F.col("fim_middle").alias("middle_chars"),
        output.alias("output_sha256"), F.sha2(fim.restore(F.col("fim_output"), F.col("fim_form")), 256).alias("restored_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if re.match(r"op\d+_", name) and callable(f)}


OP8_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win) WHERE n >= 2),
nrep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup, 0) AS n_dup_lines, coalesce(nrep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
  length(t) - length(replace(t, '|', '')) AS n_pipes,
  (length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) - length(replace(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'), '!!', ''))) // 2 AS n_bangs
  FROM w LEFT JOIN ln USING (doc_id) LEFT JOIN nrep USING (doc_id)),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
  + (CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END)
  + (CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words) THEN 8 ELSE 0 END)
  + (CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines THEN 16 ELSE 0 END)
  + (CASE WHEN 100 * n_bangs > 30 * n_words THEN 32 ELSE 0 END) + (CASE WHEN 100 * n_pipes > 20 * n_words THEN 64 ELSE 0 END) AS failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  failed % 4 > 0 AS base_failed, failed = 0 AS kept, CAST(failed AS BIGINT) AS failed FROM f
"""


OP9_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i : i + 4], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
link AS (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.k, y.k HAVING 100 * count(*) >= 85 * (x.k + y.k - count(*))),
reach AS (SELECT DISTINCT u AS id, u AS r FROM link UNION SELECT link.v, reach.r FROM reach JOIN link ON link.u = reach.id),
c AS (SELECT id, min(r) AS r FROM reach GROUP BY id)
SELECT w.doc_id, CAST(coalesce(n.k, 0) AS BIGINT) AS n_shingles, coalesce(c.r, w.doc_id) AS component_id, coalesce(c.r, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.id = w.doc_id
"""

OP4_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS b, sha256(coalesce(html, '')) AS d FROM pages),
m AS (SELECT d, min(page_id) AS first FROM p WHERE b >= 100 GROUP BY d)
SELECT page_id, CAST(b AS BIGINT) AS payload_bytes, p.d AS payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM p LEFT JOIN m ON p.d = m.d AND b >= 100
"""


OP13_SQL = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS x FROM documents),
d AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, ('0x' || x[1:8])::UBIGINT AS h1, ('0x' || x[9:16])::UBIGINT AS h2, ('0x' || x[25:32])::UBIGINT AS h4 FROM h),
k AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""

_ASSIGNED = """a{i} AS MATERIALIZED (SELECT x.vec_id, x.part, arg_min(c.idx, d * 64 + c.idx) AS idx, min(d) AS d FROM (SELECT x.vec_id, x.part, c.idx,
  (x.v[1] - c.v[1]) ** 2 + (x.v[2] - c.v[2]) ** 2 + (x.v[3] - c.v[3]) ** 2 + (x.v[4] - c.v[4]) ** 2 AS d FROM x JOIN c{i} c USING (part)) x JOIN c{i} c USING (part, idx) GROUP BY 1, 2)"""
_UPDATED = """c{j} AS MATERIALIZED (SELECT c.part, c.idx, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (SELECT part, idx, [floor(avg(v[1])), floor(avg(v[2])), floor(avg(v[3])), floor(avg(v[4]))] AS v
  FROM a{i} JOIN x USING (vec_id, part) GROUP BY 1, 2) m USING (part, idx))"""
#: Vectors of 64 components, each vec_id once.
OP12_SQL = f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda e: floor(CAST(e AS DOUBLE) * 256)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS MATERIALIZED (SELECT vec_id, part, v[4 * part + 1:4 * part + 4] AS v FROM k, (SELECT unnest(range(16)) AS part)),
c0 AS MATERIALIZED (SELECT part, rank - 1 AS idx, v FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rank FROM k) USING (vec_id) WHERE rank <= 64),
{", ".join(_ASSIGNED.replace("{i}", str(i)) + "," + _UPDATED.replace("{i}", str(i)).replace("{j}", str(i + 1)) for i in range(2))}, {_ASSIGNED.replace("{i}", "2")},
s AS (SELECT sha256(string_agg(concat_ws(',', CAST(v[1] AS BIGINT), CAST(v[2] AS BIGINT), CAST(v[3] AS BIGINT), CAST(v[4] AS BIGINT)), ',' ORDER BY part, idx)) AS h FROM c2),
r AS (SELECT vec_id, string_agg(printf('%02x', idx), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM r JOIN k USING (vec_id), s
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_vector_codes": OP12_SQL.strip(), "op13_fill_in_middle": OP13_SQL.strip(), "op4_warc": OP4_SQL.strip(), "op8_quality_rules": OP8_SQL.strip(), "op9_near_duplicates": OP9_SQL.strip()}
