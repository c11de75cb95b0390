"""Views that give the driver's tables the shapes of barcoded reads and clusters. The texts run on Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events".split()

VIEWS = {
    # one row per (cluster, position)
    "positions_v": """
WITH b AS (SELECT l_orderkey % 4000 AS k, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem),
t AS (SELECT b.*, concat('NYBot', cast(k % 24 AS string)) AS y,
  CASE WHEN k % 37 = 0 THEN 'NOT_FOUND' ELSE concat('ROUND3_', cast(k % 12 AS string)) END AS r3,
  concat('ROUND2_', cast(k AS string)) AS r2,
  concat('ROUND1_', CASE WHEN k % 3 = 0 THEN 'CNTRL' WHEN k % 3 = 1 THEN 'TORIN' ELSE 'BLANK' END, '_A', cast(k % 7 AS string)) AS r1,
  concat('EXP', cast(k % 2 AS string)) AS library,
  CASE WHEN l_returnflag = 'R' THEN 'BPM' WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN 'DPM' ELSE 'RPM' END AS read_type FROM b)
SELECT concat_ws('.', y, CASE WHEN k % 41 = 0 THEN r2 ELSE r3 END, CASE WHEN k % 41 = 0 THEN r3 ELSE r2 END, r1, library) AS barcode,
  y AS tag0, CASE WHEN k % 41 = 0 THEN r2 ELSE r3 END AS tag1, CASE WHEN k % 41 = 0 THEN r3 ELSE r2 END AS tag2, r1 AS tag3, library, read_type,
  CASE WHEN read_type = 'BPM' THEN '' WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS feature,
  CASE WHEN read_type = 'BPM' THEN concat('L', cast(CASE WHEN l_linenumber <= 4 THEN k % 20 ELSE l_suppkey % 20 END AS string))
    WHEN l_partkey % 25 < 22 THEN concat('chr', cast(l_partkey % 25 + 1 AS string)) WHEN l_partkey % 25 = 22 THEN 'chrX' WHEN l_partkey % 25 = 23 THEN '45S' ELSE 'MT' END AS chrom,
  CASE WHEN read_type = 'BPM' THEN l_partkey % 64 ELSE (l_partkey % 60) * 50 END AS start_pos,
  CASE WHEN read_type = 'BPM' THEN 0 ELSE (l_partkey % 60) * 50 + 20 + 10 * (l_linenumber % 2) END AS end_pos,
  l_linenumber % 4 AS chunk, l_orderkey AS ord1, l_linenumber AS ord2, l_suppkey AS ord3, l_partkey AS ord4
FROM t""",
    # allowed tag positions, counted from 0
    "format_v": """
SELECT DISTINCT 0 AS pos, concat('NYBot', cast(l_orderkey % 4000 % 24 AS string)) AS name FROM lineitem
UNION SELECT DISTINCT 1, concat('ROUND3_', cast(l_orderkey % 4000 % 12 AS string)) FROM lineitem
UNION SELECT DISTINCT 2, concat('ROUND2_', cast(l_orderkey % 4000 AS string)) FROM lineitem
UNION SELECT DISTINCT 3, tag3 FROM positions_v""",
    # barcoded read names with a sequence of 64 bases
    "reads_v": """
SELECT o_orderkey AS rec_no, o_orderkey % 8 AS chunk,
  concat('@SIM:1:', cast(o_orderkey AS string), '::[',
    CASE WHEN o_custkey % 3 = 0 THEN concat('BEAD_L', cast(o_custkey % 20 AS string)) ELSE 'NOT_FOUND' END, '][NYBot', cast(o_orderkey % 24 AS string), '][',
    CASE WHEN o_orderkey % 11 = 0 THEN 'NOT_FOUND' ELSE concat('ROUND2_', cast(o_orderkey % 96 AS string)) END, '][',
    CASE WHEN o_orderkey % 7 = 0 THEN 'NOT_FOUND' ELSE concat('ROUND1_', CASE WHEN o_orderstatus = 'F' THEN 'CNTRL' ELSE 'TORIN' END, '_A', cast(o_orderkey % 12 AS string)) END, ']') AS name,
  translate(concat(md5(cast(o_orderkey AS string)), md5(concat('x', cast(o_orderkey AS string)))), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq
FROM orders""",
    # tags of 7 or 8 bases for lookup with one mismatch
    "tags_v": """
SELECT p_partkey AS ord, concat('O', cast(p_partkey AS string)) AS name,
  substring(translate(md5(concat('t', cast(p_partkey AS string))), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, CASE WHEN p_partkey % 2 = 0 THEN 7 ELSE 8 END) AS tag
FROM part WHERE p_partkey < 96""",
    # lines of a run log
    "log_v": """
SELECT event_id AS line_no,
  CASE WHEN event_type = 'error' THEN concat('Error in rule rule_', cast(user_id % 10 AS string), ':')
    WHEN event_type = 'click' THEN concat('    jobid: ', cast(event_id AS string))
    WHEN event_type = 'view' THEN concat('    log: logs/', cast(user_id AS string), '.log')
    WHEN event_type = 'signup' THEN '' ELSE concat('Finished job ', cast(event_id AS string), '.') END AS line
FROM events""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a table of the folder, as a frame."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text, needed = VIEWS[name], {}
    for other in [*TABLES, *VIEWS]:
        if other != name and f"FROM {other}" in text:
            text = text.replace(f"FROM {other}", f"FROM {{{other}}}")
            needed[other] = view(spark, sf_dir, other)
    return spark.sql(text, **needed)


def oracle(body: str) -> str:
    """`body` behind the views that it names, as one statement."""
    used: list[str] = []

    def need(text: str) -> None:
        for v in VIEWS:
            if v in text and v not in used:
                need(VIEWS[v])
                used.append(v)

    need(body)
    views = ", ".join(f"{v} AS ({VIEWS[v].strip()})" for v in used)
    body = body.strip()
    if not views:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views}, {body[15:]}"
    return f"WITH {views}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {views} {body}"
