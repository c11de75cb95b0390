"""SQL twins of the queries, for DuckDB over the same tables; written apart from the Spark side, from what each should return."""

from __future__ import annotations

from ..operators.genome import SIZES, chromosomes
from ..operators.reads import ADAPTER_1, ADAPTER_2
from .adapters import oracle

_DEDUP = """dd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY barcode, read_type, chrom, start_pos, end_pos
  ORDER BY ord1, ord2, ord3, ord4, feature) AS rn FROM positions_v) WHERE rn = 1)"""
_LABEL = _DEDUP + """, bc AS (SELECT barcode, chrom AS bead, count(*) AS n FROM dd WHERE read_type = 'BPM' GROUP BY barcode, chrom),
tb AS (SELECT barcode, bead, n, sum(n) OVER (PARTITION BY barcode) AS total, row_number() OVER (PARTITION BY barcode ORDER BY n DESC, bead) AS rn FROM bc),
sz AS (SELECT barcode, count(*) AS size, count(*) FILTER (WHERE read_type = 'BPM') AS n_bpm, count(*) FILTER (WHERE read_type = 'RPM') AS n_rpm, count(*) FILTER (WHERE read_type = 'DPM') AS n_dpm FROM dd GROUP BY barcode),
lab AS (SELECT sz.barcode, size, n_bpm, CASE WHEN n_bpm = 0 THEN 'none' WHEN size - n_bpm > 13 THEN 'filtered' WHEN n < 2 THEN 'uncertain' WHEN CAST(n AS DOUBLE) / n_bpm < 0.6 THEN 'ambiguous' ELSE bead END AS label
  FROM sz LEFT JOIN tb ON sz.barcode = tb.barcode AND rn = 1)"""
_READS = _LABEL + """, al AS (SELECT *, ord2 % 2 = 1 AS is_read1 FROM positions_v WHERE read_type = 'RPM'),
lr AS (SELECT al.*, label, {place} AS place FROM al LEFT JOIN (SELECT * FROM lab WHERE label <> 'none') l ON al.barcode = l.barcode),
lf AS (SELECT *, CASE WHEN label IS NULL THEN 'skipped' WHEN row_number() OVER (PARTITION BY barcode, place ORDER BY ord1, ord2, ord3, ord4, feature, chunk) = 1 THEN 'written' ELSE 'duplicate' END AS fate FROM lr)"""
_FULL = "CASE WHEN is_read1 THEN concat_ws('_', chrom, start_pos, end_pos) ELSE concat_ws('_', chrom, end_pos, start_pos) END"
_FATES = _READS.replace("{place}", _FULL)
_TAGS = r"regexp_extract_all(name, '\[([a-zA-Z0-9_\-]+)\]', 1)"
_TEXT = "concat(read_type, '[', feature, ']_', chrom, ':', start_pos, '-', end_pos)"
_BALL = """ltr AS (SELECT unnest(['A', 'C', 'G', 'T']) AS c),
ball AS (SELECT DISTINCT ord, name, concat(substr(tag, 1, p - 1), c, substr(tag, p + 1)) AS nb FROM (SELECT *, unnest(range(1, length(tag) + 1)) AS p FROM tags_v), ltr)"""
# windows at offsets 0-6 and sizes 7, 8 from a start (base 0), against tags by distance, not by neighbours
_WIN = """wn AS (SELECT rec_no, slot, seq, start, o, s FROM st, (SELECT unnest(range(0, 7)) AS o), (SELECT unnest([7, 8]) AS s)
  WHERE start + o + s <= length(seq) AND (o = 0 OR start + o - 1 + 8 <= length(seq))),
ht AS (SELECT rec_no, slot, o, s, name, start + o + s AS hit_end, row_number() OVER (PARTITION BY rec_no, slot ORDER BY o, s, ord DESC) AS rn
  FROM wn JOIN tags_v ON length(tag) = s AND hamming(tag, substr(seq, CAST(start + o + 1 AS BIGINT), CAST(s AS BIGINT))) <= 1),
hit AS (SELECT * FROM ht WHERE rn = 1)"""
_Y = """yl AS (SELECT rec_no, r.seq, t.name, length(t.tag) AS n, row_number() OVER (PARTITION BY rec_no ORDER BY length(t.tag), ord DESC) AS rn
  FROM reads_v r JOIN tags_v t ON substr(seq, {at}, length(t.tag)) = t.tag),
y AS (SELECT r.rec_no, r.seq, coalesce(yl.name, 'NOT_FOUND') AS name, coalesce(n, 8) AS adv FROM reads_v r LEFT JOIN yl ON r.rec_no = yl.rec_no AND rn = 1)"""
_HG38 = ", ".join(f"({i}, '{c}', {n})" for i, c, n in chromosomes("hg38"))
_OFFSETS = f"""asm AS (SELECT * FROM (VALUES {_HG38}) t(ord, chrom, size)),
ofs AS (SELECT chrom, ord, coalesce(sum(CAST(ceil(size / 1000000.0) AS BIGINT)) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM asm)"""
_UMI = "um AS (SELECT barcode, concat_ws('_', chrom, start_pos) AS umi, count(*) AS n FROM positions_v WHERE read_type = 'BPM' GROUP BY 1, 2)"
_ALIGNED = """SELECT concat_ws(':', ord1, ord2, ord3, ord4) AS qname, CAST((CASE WHEN feature = '-' THEN 16 ELSE 0 END) + (CASE WHEN ord2 % 2 = 1 THEN 64 ELSE 128 END) AS BIGINT) AS flag,
  chrom AS ref_name, start_pos, end_pos, barcode FROM positions_v WHERE read_type = 'RPM'"""
# the first place of each adapter with at most k mismatches, place by place
_TRIM = """WITH x AS (SELECT rec_no, CASE WHEN rec_no % 6 > 0 THEN concat(substr(seq, 1, rec_no % 45), '{c}', 'GGGG') ELSE seq END AS seq1,
  CASE WHEN rec_no % 5 > 0 THEN concat(substr(seq, 1, rec_no % 50), '{d}', substr(seq, rec_no % 50 + 1)) ELSE seq END AS seq2 FROM reads_v),
p AS (SELECT rec_no, min(i) FILTER (WHERE length(substr(seq1, i, 18)) = 18 AND hamming(rpad(substr(seq1, i, 18), 18, '-'), '{a}') <= {k}) AS p1,
  min(i) FILTER (WHERE length(substr(seq2, i, 18)) = 18 AND hamming(rpad(substr(seq2, i, 18), 18, '-'), '{b}') <= {k}) AS p2 FROM x, (SELECT unnest(range(1, 90)) AS i) GROUP BY rec_no),
c AS (SELECT rec_no, CASE WHEN p1 IS NULL THEN seq1 ELSE substr(seq1, 1, p1 - 1) END AS seq1, CASE WHEN p2 IS NULL THEN seq2 ELSE substr(seq2, p2 + 18) END AS seq2 FROM x JOIN p USING (rec_no))
SELECT * FROM c WHERE length(seq1) >= 20 AND length(seq2) >= 20"""
_MAXREP = _LABEL + ", mr AS (SELECT barcode, n AS top, round(CAST(n AS DOUBLE) / total, 6) AS share FROM tb WHERE rn = 1 AND total >= {least})"


def _ecdf(value: str, source: str = "mr") -> str:
    return f"""SELECT {value} AS value, CAST(n AS BIGINT) AS n, round(sum(n) OVER (ORDER BY {value}) / CAST(sum(n) OVER () AS DOUBLE), 6) AS ecdf
FROM (SELECT {value}, count(*) AS n FROM {source} GROUP BY 1)"""


def _walk(mate: int, parts: str, spacer: int, laxity: int) -> tuple[str, list[str]]:
    """A table per part of a layout, each from where the one before it ended; and the names of those that hold tags."""
    out, slots, last = [f"w{mate} AS (SELECT rec_no, seq{mate} AS seq, 0::BIGINT AS pos FROM pr)"], [], f"w{mate}"
    for i, part in enumerate(parts.split("|")):
        new = f"w{mate}_{i}"
        if part == "SPACER":
            out.append(f"{new} AS (SELECT rec_no, seq, least(pos + {spacer}, length(seq)) AS pos FROM {last})")
        else:
            reach = laxity if i else 0
            out.append(f"""h{mate}_{i} AS (SELECT rec_no, arg_min(t.name, o * 1000000 + length(tag) * 10000 - t.ord) AS name, arg_min(pos + o + length(tag), o * 1000000 + length(tag) * 10000 - t.ord) AS stop
  FROM {last}, (SELECT unnest(range(0, {reach + 1})) AS o), cf t WHERE kind = '{part}' AND pos + o + length(tag) <= length(seq) AND hamming(rpad(substr(seq, CAST(pos + o + 1 AS BIGINT), length(tag)), CAST(length(tag) AS INT), '-'), tag) <= tol GROUP BY rec_no)""")
            out.append(f"{new} AS (SELECT w.rec_no, seq, coalesce(h.name, 'NOT_FOUND') AS name, coalesce(stop, least(pos + {reach} + (SELECT max(length(tag)) FROM cf WHERE kind = '{part}'), length(seq))) AS pos FROM {last} w LEFT JOIN h{mate}_{i} h USING (rec_no))")
            slots.append(new)
        last = new
    return ",\n".join(out), slots


_WALKS = [_walk(1, "DPM|SPACER|ODD", 4, 3), _walk(2, "Y|SPACER|ODD|EVEN|SPACER|ODD", 4, 3)]
_SLOTS = [s for _, slots in _WALKS for s in slots]
_ANY_LAYOUT = """WITH cf AS (SELECT CASE ord % 4 WHEN 0 THEN 'DPM' WHEN 1 THEN 'Y' WHEN 2 THEN 'ODD' ELSE 'EVEN' END AS kind, name, substr(tag, 1, CAST(6 + ord // 4 % 2 AS BIGINT)) AS tag, ord // 4 % 3 AS tol, ord FROM tags_v),
ny AS (SELECT rec_no, CASE WHEN rec_no % 5 = 0 THEN concat(substr(seq, 1, 8), 'N', substr(seq, 10)) ELSE seq END AS seq FROM reads_v),
pr AS (SELECT rec_no, substr(seq, 1, 20 + rec_no % 45) AS seq1, reverse(seq) AS seq2 FROM ny),
""" + ",\n".join(w for w, _ in _WALKS) + f", bar AS (SELECT rec_no, concat_ws('|', {', '.join(s + '.name' for s in _SLOTS)}) AS barcode FROM {_SLOTS[0]} " + " ".join(f"JOIN {s} USING (rec_no)" for s in _SLOTS[1:]) + ")\n"


_SQL = {
    "fastq_record_framing": "SELECT rec_no, name, seq, '+' AS plus, CAST(length(seq) AS BIGINT) AS qual_length FROM reads_v",
    "render_clusters": f"""WITH {_DEDUP}, x AS (SELECT barcode, {_TEXT} AS t, CASE WHEN read_type = 'BPM' THEN 1 WHEN read_type = 'RPM' AND chrom LIKE 'chr%' THEN 2 WHEN read_type = 'RPM' THEN 3 ELSE 4 END AS score FROM dd)
SELECT concat(barcode, chr(9), string_agg(t, chr(9) ORDER BY score, t)) AS line FROM x GROUP BY barcode""",
    "parse_cluster_lines": f"WITH {_DEDUP} SELECT barcode, read_type, feature, chrom, CAST(start_pos AS BIGINT) AS start_pos, CAST(end_pos AS BIGINT) AS end_pos FROM dd",
    "discover_samples": """SELECT sample, read, string_agg(DISTINCT file, ',' ORDER BY file) AS paths FROM (SELECT concat('S', rec_no % 7, '_L', chunk % 2) AS sample, concat('R', rec_no % 3 + 1) AS read,
  concat('S', rec_no % 7, '_L', chunk % 2, '_R', rec_no % 3 + 1, CASE WHEN rec_no % 2 = 0 THEN '.fastq.gz' ELSE '.fq' END) AS file FROM reads_v) WHERE read <> 'R3' GROUP BY 1, 2""",
    "route_by_label": f"""WITH {_LABEL}, al AS (SELECT *, ord2 % 2 = 1 AS is_read1 FROM dd WHERE read_type = 'RPM'),
lr AS (SELECT al.*, label, {_FULL} AS place FROM al JOIN lab USING (barcode)),
lf AS (SELECT *, row_number() OVER (PARTITION BY barcode, place ORDER BY ord1, ord2, ord3, ord4, feature, chunk) AS rn FROM lr)
SELECT label, count(*) AS n, count(DISTINCT barcode) AS barcodes FROM lf WHERE rn = 1 GROUP BY label""",
    "concat_reports": "SELECT concat('report_', line_no % 5, '.txt') AS file, upper(trim(line)) AS line, line_no FROM log_v",
    "paired_only": "SELECT concat_ws('_', ord1, ord3) AS name, count(*) AS n, CAST(sum(ord2) AS BIGINT) AS mates FROM positions_v GROUP BY 1 HAVING count(*) = 2",
    "hamming_ball": f"WITH {_BALL} SELECT name, nb AS neighbour FROM ball",
    "bead_lookup": f"WITH {_Y.replace('{at}', '4')} SELECT rec_no, name FROM y",
    "terminal_lookup": f"WITH {_Y.replace('{at}', '1')} SELECT rec_no, name, CAST(adv AS BIGINT) AS advance FROM y",
    "fuzzy_tag_lookup": f"WITH st AS (SELECT rec_no, 0 AS slot, seq, 10 AS start FROM reads_v), {_WIN} SELECT st.rec_no, coalesce(name, 'NOT_FOUND') AS name FROM st LEFT JOIN hit USING (rec_no)",
    "fuzzy_tag_lookup_n": f"WITH st AS (SELECT rec_no, 0 AS slot, seq, 10 AS start FROM reads_v), {_WIN} SELECT st.rec_no, coalesce(name, 'NOT_FOUND') AS name, CAST(coalesce(hit_end, st.start) AS BIGINT) AS next_start FROM st LEFT JOIN hit USING (rec_no)",
    "barcode_layout": f"""WITH {_Y.replace('{at}', '1')}, st AS (SELECT rec_no, seq, slot, adv + 7 + slot * 24 AS start FROM y, (SELECT unnest([0, 1, 2]) AS slot) WHERE length(seq) - (adv + 7 + slot * 24) >= 17), {_WIN}
SELECT y.rec_no, concat_ws('|', y.name, coalesce(a.name, 'NOT_FOUND'), coalesce(b.name, 'NOT_FOUND'), coalesce(c.name, 'NOT_FOUND')) AS barcode
FROM y LEFT JOIN hit a ON a.rec_no = y.rec_no AND a.slot = 0 LEFT JOIN hit b ON b.rec_no = y.rec_no AND b.slot = 1 LEFT JOIN hit c ON c.rec_no = y.rec_no AND c.slot = 2""",
    "pad_barcode": f"SELECT rec_no, concat(array_to_string({_TAGS}, '|'), '|NOT_FOUND|NOT_FOUND') AS barcode FROM reads_v",
    "annotate_name": "SELECT rec_no, name FROM reads_v",
    "tag_ambiguity": f"WITH {_BALL} SELECT nb AS neighbour, count(DISTINCT name) AS n_names, min(name) AS first_name, max(name) AS last_name FROM ball GROUP BY nb HAVING count(DISTINCT name) > 1",
    "hamming_distance": "SELECT rec_no, hamming(substr(seq, 1, 32), substr(seq, 33, 32)) AS distance FROM reads_v",
    "extract_tags": f"SELECT rec_no, array_to_string({_TAGS}, ',') AS tags FROM reads_v",
    "barcode_key": f"SELECT rec_no, concat(array_to_string({_TAGS}[2:], '.'), '.EXP', chunk) AS barcode FROM reads_v",
    "classify_reads": f"SELECT rec_no, CASE WHEN list_contains({_TAGS}[2:], 'NOT_FOUND') THEN 'short' WHEN contains(name, 'BEAD') THEN 'BPM' ELSE 'RPM' END AS read_class FROM reads_v",
    "classify_reads_dpm": f"SELECT rec_no, CASE WHEN list_contains({_TAGS}, 'NOT_FOUND') THEN 'short' WHEN contains(name, 'DPM') THEN 'DPM' WHEN contains(name, 'BEAD') THEN 'BPM' ELSE 'other' END AS read_class FROM reads_v",
    "full_barcodes": f"""WITH x AS (SELECT rec_no, concat(CASE WHEN contains(name, 'BEAD') THEN {_TAGS}[1] ELSE 'RPM' END, '|', array_to_string({_TAGS}[2:], '|')) AS barcode,
  CASE WHEN contains(name, 'BEAD') THEN regexp_extract(name, '([^_]*)$', 1) ELSE seq END AS seq FROM reads_v)
SELECT rec_no, barcode, seq, repeat('F', length(seq)) AS qual FROM x WHERE NOT contains(barcode, 'NOT_FOUND')""",
    "umi_encode": "SELECT rec_no, CASE WHEN rec_no % 9 = 0 THEN 0 ELSE CAST(translate(substr(seq, 1, 8), 'ACGTN', '12340') AS BIGINT) END AS umi FROM reads_v",
    "bead_name": r"SELECT rec_no, regexp_extract(name, '\[BEAD_([a-zA-Z0-9_\-]+)\]', 1) AS bead FROM reads_v WHERE contains(name, '[BEAD_')",
    "ab_oligo": "SELECT rec_no, regexp_extract(name, '([^_]*)$', 1) AS seq, replace(name, 'NOT_FOUND', 'PPM') AS name FROM reads_v",
    "rpm_rename": "SELECT rec_no, replace(name, 'NOT_FOUND', 'RPM') AS name FROM reads_v WHERE contains(name, 'NOT_FOUND')",
    "chrom_filter": f"WITH {_OFFSETS} SELECT chrom, count(*) AS n FROM positions_v WHERE read_type = 'RPM' AND chrom IN (SELECT chrom FROM asm) GROUP BY chrom",
    "flag_filter": "SELECT chrom <> 'MT' AS mapped, CASE WHEN feature = '-' THEN '-' ELSE '+' END AS strand, count(*) AS n FROM positions_v GROUP BY 1, 2",
    "position_score": "SELECT CAST(CASE WHEN read_type = 'BPM' THEN 1 WHEN read_type = 'DPM' THEN 4 WHEN chrom LIKE 'chr%' THEN 2 ELSE 3 END AS BIGINT) AS score, count(*) AS n FROM positions_v GROUP BY 1",
    "condition_split": "SELECT split_part(tag3, '_', 2) AS cond, count(*) AS n, count(DISTINCT barcode) AS barcodes FROM positions_v GROUP BY 1",
    "condition_discovery": "SELECT DISTINCT split_part(tag3, '_', 2) AS cond FROM positions_v",
    "strip_library": "SELECT concat_ws('.', tag0, tag1, tag2, tag3) AS barcode, count(*) AS n FROM positions_v GROUP BY 1",
    "cdna_length_hist": """WITH x AS (SELECT chunk % 2 + 1 AS mate, length(seq) - strpos(seq, 'ACG') AS len FROM reads_v), e AS (SELECT mate, min(len) AS lo, max(len) AS hi FROM x GROUP BY mate)
SELECT mate, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((len - lo) / (CAST(hi - lo AS DOUBLE) / 50)), 49) END AS BIGINT) AS bin, count(*) AS n FROM x JOIN e USING (mate) GROUP BY 1, 2""",
    "cluster_category": f"WITH {_LABEL} SELECT CASE WHEN n_bpm > 0 AND n_rpm > 0 THEN 'BPM_and_RPM' WHEN n_bpm > 0 THEN 'BPM_ONLY' WHEN n_rpm > 0 THEN 'RPM_ONLY' END AS category, count(*) AS n FROM sz GROUP BY 1",
    "fix_blank_tag": "SELECT DISTINCT tag3, concat(split_part(tag3, '_', 1), '_BLANK_', split_part(tag3, '_', 2), '_', split_part(tag3, '_', 3)) AS fixed FROM positions_v",
    "adapter_trim_exact": """WITH x AS (SELECT rec_no, seq, least(CASE WHEN strpos(seq, 'ATCAGC') > 0 THEN strpos(seq, 'ATCAGC') - 1 ELSE 64 END, CASE WHEN strpos(seq, 'CTGACG') > 0 THEN strpos(seq, 'CTGACG') - 1 ELSE 64 END) AS n FROM reads_v)
SELECT rec_no, substr(seq, 1, n) AS seq FROM x WHERE n >= 20""",
    "hms_to_seconds": "SELECT line_no, line_no % 30 * 3600 + line_no % 60 * 60 + line_no % 59 AS seconds FROM log_v",
    "pair_mates": "SELECT rec_no, seq AS seq1, reverse(seq) AS seq2 FROM reads_v",
    "label_reads": f"WITH {_FATES} SELECT fate, coalesce(label, '') AS label, count(*) AS n FROM lf GROUP BY 1, 2",
    "label_reads_startonly": f"WITH {_READS.replace('{place}', chr(99) + 'oncat_ws(' + chr(39) + '_' + chr(39) + ', chrom, start_pos)')} SELECT fate, coalesce(label, '') AS label, count(*) AS n FROM lf GROUP BY 1, 2",
    "label_summary": f"WITH {_FATES} SELECT fate, count(*) AS n FROM lf GROUP BY 1",
    "label_reads_prelabelled": f"WITH {_LABEL} SELECT label, count(*) AS n FROM positions_v JOIN lab USING (barcode) WHERE read_type = 'RPM' GROUP BY label",
    "split_complete": """WITH b AS (SELECT DISTINCT barcode, [tag0, tag1, tag2, tag3] AS t FROM positions_v), x AS (SELECT barcode, t[i + 1] AS name, i AS pos FROM (SELECT barcode, t, unnest([0, 1, 2, 3]) AS i FROM b)),
j AS (SELECT barcode, count(*) FILTER (WHERE f.name IS NULL) AS n_bad FROM x LEFT JOIN format_v f ON f.pos = x.pos AND f.name = x.name GROUP BY barcode) SELECT barcode, n_bad, n_bad = 0 AS complete FROM j""",
    "leave_one_out": "WITH b AS (SELECT DISTINCT concat(library, '_', chunk) AS bam FROM positions_v) SELECT a.bam, string_agg(o.bam, ',' ORDER BY o.bam) AS others FROM b a JOIN b o ON a.bam <> o.bam GROUP BY a.bam",
    "dedup_reads": f"WITH {_FATES} SELECT barcode, count(*) AS n, min(place) AS first_place FROM lf WHERE fate = 'written' GROUP BY barcode",
    "assignment_distribution": f"WITH {_LABEL} SELECT label, count(*) AS clusters, CAST(sum(size - n_bpm) AS BIGINT) AS reads, round(CAST(sum(size - n_bpm) AS DOUBLE) / count(*), 6) AS reads_per_cluster FROM lab GROUP BY label",
    "cluster_build": f"WITH {_DEDUP} SELECT barcode, read_type, feature, chrom, start_pos, end_pos FROM dd",
    "position_dedup": f"WITH {_DEDUP} SELECT barcode, count(*) AS n, count(*) FILTER (WHERE feature = '+') AS plus, CAST(sum(ord2) AS BIGINT) AS ord2 FROM dd GROUP BY barcode",
    "cluster_sizes": f"WITH {_LABEL} SELECT barcode, size, n_bpm, n_rpm, n_dpm FROM sz",
    "bpm_rpm_counts": f'WITH {_LABEL} SELECT barcode, n_bpm AS "BPM", n_rpm AS "RPM" FROM sz',
    "coverage": f"WITH {_DEDUP} SELECT barcode, chrom, count(*) AS n FROM dd WHERE read_type = 'RPM' GROUP BY 1, 2",
    "contains_bead": "SELECT barcode, count(*) FILTER (WHERE read_type = 'BPM' AND chrom = 'L3') > 0 AS has_bead FROM positions_v GROUP BY barcode",
    "stripped_lookup": f"WITH {_DEDUP} SELECT concat_ws('.', tag0, tag1, tag2, tag3) AS barcode, count(DISTINCT {_TEXT}) AS n_positions, min({_TEXT}) AS first_position, max({_TEXT}) AS last_position FROM dd GROUP BY 1",
    "cluster_merge": f"WITH {_DEDUP} SELECT barcode, read_type, count(*) AS n, CAST(sum(start_pos) AS BIGINT) AS starts, count(*) FILTER (WHERE feature = '-') AS minus FROM dd GROUP BY 1, 2",
    "cluster_label": f"WITH {_LABEL} SELECT barcode, size, n_bpm, label FROM lab",
    "ligation_by_count": f"WITH x AS (SELECT len(list_filter({_TAGS}, lambda t: t <> 'NOT_FOUND')) AS n_found FROM reads_v) SELECT n_found, count(*) AS reads, round(100 * CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM x), 1) AS percent FROM x GROUP BY n_found",
    "ligation_by_position": f"WITH x AS (SELECT {_TAGS} AS t FROM reads_v), y AS (SELECT i AS pos, t[i + 1] AS tag FROM (SELECT t, unnest(range(0, len(t))) AS i FROM x)) SELECT pos, count(*) FILTER (WHERE tag <> 'NOT_FOUND') AS found, round(100 * CAST(count(*) FILTER (WHERE tag <> 'NOT_FOUND') AS DOUBLE) / count(*), 1) AS percent FROM y GROUP BY pos",
    "barcode_completeness": f"WITH x AS (SELECT list_contains({_TAGS}[2:], 'NOT_FOUND') AS b FROM reads_v) SELECT count(*) FILTER (WHERE NOT b) AS full, count(*) FILTER (WHERE b) AS incomplete FROM x".replace(" AS full,", ' AS "full",'),
    "read_counts": "SELECT count(*) AS reads, CAST(sum(length(seq)) AS BIGINT) AS bases FROM reads_v",
    "reads_per_chunk": f"WITH x AS (SELECT chunk, CASE WHEN list_contains({_TAGS}[2:], 'NOT_FOUND') THEN 'short' WHEN contains(name, 'BEAD') THEN 'BPM' ELSE 'RPM' END AS read_class FROM reads_v) SELECT read_class, chunk, count(*) AS reads FROM x GROUP BY 1, 2 UNION ALL SELECT read_class, NULL, count(*) FROM x GROUP BY 1",
    "distinct_reads": "SELECT count(DISTINCT ord1) AS names, count(*) AS alignments FROM positions_v WHERE read_type = 'RPM'",
    "umi_duplication": f"WITH {_UMI} SELECT barcode, count(*) AS unique_umis, CAST(sum(n) AS BIGINT) AS total, CAST(sum(n) - count(*) AS BIGINT) AS duplicates, string_agg(concat(umi, '_', n), ',' ORDER BY umi) AS umi_counts FROM um GROUP BY barcode",
    "duplication_rate": f"WITH {_UMI} SELECT round(CAST(sum(n) - count(*) AS DOUBLE) / nullif(sum(n), 0), 6) AS rate FROM um",
    "reads_in_clusters": f"WITH {_LABEL} SELECT CAST(sum(n_rpm) AS BIGINT) AS reads FROM sz",
    "reads_assigned": f"WITH {_FATES} SELECT count(*) AS reads FROM lf WHERE fate = 'written' AND label NOT IN ('ambiguous', 'none', 'uncertain')",
    "splitbam_stats": f"WITH {_FATES} SELECT concat(label, '_', library) AS output, count(*) AS reads FROM lf WHERE fate = 'written' GROUP BY 1",
    "cluster_statistics": f"WITH {_DEDUP} SELECT library, count(DISTINCT barcode) AS clusters, count(*) FILTER (WHERE read_type = 'BPM') AS n_bpm, count(*) FILTER (WHERE read_type = 'RPM') AS n_rpm, count(*) FILTER (WHERE read_type = 'DPM') AS n_dpm FROM dd GROUP BY library",
    "beads_per_barcode": f"WITH {_LABEL} SELECT barcode, string_agg(bead, ',' ORDER BY bead) AS beads, string_agg(CAST(n AS VARCHAR), ',' ORDER BY bead) AS counts FROM bc GROUP BY barcode",
    "bead_matrix": f"WITH {_DEDUP} SELECT barcode, " + ", ".join(f"count(*) FILTER (WHERE chrom = 'L{i}') AS \"L{i}\"" for i in range(20)) + " FROM dd WHERE read_type = 'BPM' GROUP BY barcode",
    "consolidate_benchmarks": """SELECT 'A' AS sample, 'trim' AS rule, line_no * 2 AS s, line_no + 1 AS max_rss, NULL::BIGINT AS io_in FROM log_v
UNION ALL SELECT 'A', 'align', line_no * 3, NULL, line_no % 7 FROM log_v UNION ALL SELECT 'B', 'trim', line_no * 2, line_no + 1, NULL FROM log_v""",
    "config_condition_diff": "SELECT 'BLANK' AS cond, 'left' AS side FROM positions_v GROUP BY 1, 2 UNION ALL SELECT 'HEAT', 'right' FROM positions_v GROUP BY 1, 2",
    "dedup_pairs": "SELECT seq AS seq1, reverse(seq) AS seq2, min(rec_no) AS rec_no, CAST(sum(rec_no % 3 + 2) AS BIGINT) AS copies FROM reads_v GROUP BY 1, 2",
    "subsample_cumulative": """WITH c AS (SELECT DISTINCT chunk AS n_chunk FROM positions_v), x AS (SELECT n_chunk, concat_ws('.', tag0, tag1, tag2, tag3) AS b, count(*) FILTER (WHERE read_type = 'BPM') AS bpm, count(*) FILTER (WHERE read_type = 'RPM') AS rpm, count(*) AS n
  FROM c JOIN positions_v p ON p.chunk <= c.n_chunk GROUP BY 1, 2),
y AS (SELECT n_chunk, CASE WHEN bpm > 0 AND rpm > 0 THEN 'BPM_and_RPM' WHEN bpm > 0 THEN 'BPM_ONLY' WHEN rpm > 0 THEN 'RPM_ONLY' END AS category, n FROM x), z AS (SELECT n_chunk, category, count(*) AS clusters, sum(n) AS reads FROM y WHERE category IS NOT NULL GROUP BY 1, 2)
SELECT CAST(n_chunk AS BIGINT) AS n_chunk, category, clusters, CAST(reads AS BIGINT) AS reads, round(clusters / CAST(sum(clusters) OVER (PARTITION BY n_chunk) AS DOUBLE), 6) AS cluster_share, round(CAST(reads AS DOUBLE) / CAST(sum(reads) OVER (PARTITION BY n_chunk) AS DOUBLE), 6) AS read_share FROM z""",
    "merge_alignments": "SELECT library, chrom, count(*) AS n FROM positions_v WHERE read_type = 'RPM' OR chrom = '45S' GROUP BY 1, 2",
    "coord_sort": "SELECT chrom, start_pos, end_pos, ord1, ord2 FROM positions_v WHERE read_type = 'RPM'",
    "top_bead": f"WITH {_LABEL} SELECT barcode, bead, n, CAST(total AS BIGINT) AS total FROM tb WHERE rn = 1",
    "mixing_ratio": """WITH k AS (SELECT * FROM positions_v WHERE read_type = 'BPM' OR (read_type = 'RPM' AND CAST(concat('0x', substr(md5(concat_ws('|', barcode, chrom, start_pos, ord1)), 1, 8)) AS BIGINT) < 1288490188))
SELECT barcode, count(*) AS size, count(*) FILTER (WHERE read_type = 'BPM') AS n_bpm, count(*) FILTER (WHERE read_type = 'RPM') AS n_rpm, count(*) FILTER (WHERE read_type = 'DPM') AS n_dpm FROM k GROUP BY barcode""",
    "chunk_assign": "SELECT rec_no, CAST(floor((row_number() OVER (ORDER BY rec_no) - 1) / CAST(floor((SELECT count(*) FROM reads_v) / 8) + 1 AS BIGINT)) AS BIGINT) AS chunk_no FROM reads_v",
    "error_blocks": r"""WITH l AS (SELECT *, regexp_extract(line, 'Error in rule\\s+(\\w+):', 1) AS rule, regexp_extract(line, 'jobid:\\s*(\\d+)', 1) AS j, regexp_extract(line, 'log:\\s*([^\\s()]+)', 1) AS g FROM log_v),
a AS (SELECT *, sum(CASE WHEN rule <> '' THEN 1 ELSE 0 END) OVER (ORDER BY line_no) AS block FROM l),
b AS (SELECT *, sum(CASE WHEN rule = '' AND j = '' AND g = '' AND (trim(line) = '' OR contains(line, 'Finished job')) THEN 1 ELSE 0 END) OVER (PARTITION BY block ORDER BY line_no) AS closed FROM a WHERE block > 0)
SELECT CAST(block AS BIGINT) AS block, min(line_no) AS line_no, max(rule) AS rule, arg_max(j, line_no) FILTER (WHERE j <> '') AS jobid,
  arg_max(g, line_no) FILTER (WHERE j = '' AND g <> '') AS log FROM b WHERE closed = 0 GROUP BY block""".replace("\\\\", "\\"),
    "size_distribution": f"""WITH {_DEDUP}, c AS (SELECT library, barcode, count(*) AS n FROM dd WHERE read_type = 'BPM' GROUP BY 1, 2),
g AS (SELECT library, CASE WHEN n <= 1 THEN '1' WHEN n <= 5 THEN '2-5' WHEN n <= 10 THEN '6-10' WHEN n <= 20 THEN '11-20' WHEN n <= 50 THEN '21-50' WHEN n <= 100 THEN '51-100' WHEN n <= 200 THEN '101-200' ELSE '201+' END AS size_bin, count(*) AS clusters, sum(n) AS reads FROM c GROUP BY 1, 2)
SELECT library, size_bin, clusters, CAST(reads AS BIGINT) AS reads, round(clusters / CAST(sum(clusters) OVER (PARTITION BY library) AS DOUBLE), 6) AS cluster_share, round(CAST(reads AS DOUBLE) / CAST(sum(reads) OVER (PARTITION BY library) AS DOUBLE), 6) AS read_share FROM g""",
    "max_rep_ecdf": f"WITH {_MAXREP.replace('{least}', '2')} {_ecdf('share')}",
    "max_rep_counts": f"WITH {_MAXREP.replace('{least}', '2')} {_ecdf('top')}",
    "max_rep_ecdf_all": f"WITH {_MAXREP.replace('{least}', '1')}, al AS (SELECT share FROM mr UNION ALL SELECT 0.0 FROM sz WHERE n_bpm = 0) {_ecdf('share', 'al')}",
    "cluster_size_hist": f"""WITH {_LABEL} SELECT CAST(CASE WHEN size < 2 THEN 1 WHEN size < 5 THEN 2 WHEN size < 10 THEN 5 WHEN size < 20 THEN 10 WHEN size < 50 THEN 20 WHEN size < 100 THEN 50 WHEN size < 1000 THEN 100 ELSE 1000 END AS BIGINT) AS at_least,
count(*) AS clusters, CAST(sum(size) AS BIGINT) AS positions FROM sz GROUP BY 1""",
    "genome_bin": f"WITH {_OFFSETS} SELECT CAST(floor(start_pos * 30000 / 1000000.0) + off AS BIGINT) AS bin, count(*) AS n FROM positions_v LEFT JOIN ofs USING (chrom) WHERE read_type = 'RPM' GROUP BY 1",
    "genome_bin_inverse": f"WITH {_OFFSETS}, b AS (SELECT DISTINCT rec_no % 3000 AS bin FROM reads_v) SELECT bin, arg_max(chrom, ord) AS chrom, CAST((bin - max(off)) * 1000000 AS BIGINT) AS pos FROM b JOIN ofs ON off <= bin GROUP BY bin",
    "bpm_rpm_ratio": f"WITH {_LABEL} SELECT CAST(sum(n_bpm) AS BIGINT) AS bpm, CAST(sum(n_rpm) AS BIGINT) AS rpm, round(CAST(sum(n_bpm) AS DOUBLE) / nullif(sum(n_rpm), 0), 6) AS ratio FROM sz",
    "fastq_round_trip": "SELECT chunk >= 4 AS packed, name, seq, '+' AS plus, CAST(length(seq) AS BIGINT) AS qual_length FROM reads_v",
    "bam_round_trip": f"SELECT qname, flag, ref_name, CAST(start_pos AS BIGINT) AS ref_start, CAST(end_pos AS BIGINT) AS ref_end, concat(end_pos - start_pos, 'M') AS cigar, barcode FROM ({_ALIGNED})",
    "fastq_split": "SELECT name, seq, CAST(length(seq) AS BIGINT) AS qual_length, true AS gapless FROM reads_v",
    "bam_region": f"""SELECT r.region, qname, flag, CAST(start_pos AS BIGINT) AS ref_start, CAST(end_pos AS BIGINT) AS ref_end FROM ({_ALIGNED}) JOIN
  (VALUES ('chr3', 500, 1200), ('chrX', 0, 300), ('45S', 2000, 2001)) r(region, a, b) ON ref_name = region AND start_pos < b AND end_pos > a""",
    "bam_header": """SELECT 'RG' AS kind, library AS name, NULL::BIGINT AS length FROM positions_v WHERE read_type = 'RPM' GROUP BY library UNION ALL SELECT 'RG', 'template', NULL
UNION ALL SELECT 'SQ', unnest(list_concat(list_transform(range(1, 23), lambda i: concat('chr', i)), ['chrX', '45S', 'MT'])), 44444444""",
    "bam_typed_tags": f"""SELECT qname, barcode, CAST(start_pos - 100 AS BIGINT) AS nm, CASE WHEN flag > 100 THEN 'x' ELSE 'y' END AS zs, concat(start_pos, ',-1') AS zb, 'Z,i,A,Bi' AS types,
  CAST(start_pos % 61 AS BIGINT) AS mapq, ref_name AS mate_ref, CAST(end_pos AS BIGINT) AS mate_start, CAST(-start_pos AS BIGINT) AS insert_size FROM ({_ALIGNED})""",
    "bam_by_label": f"WITH {_LABEL} SELECT label, count(*) AS n, 0::BIGINT AS elsewhere FROM ({_ALIGNED}) JOIN lab USING (barcode) GROUP BY label",
    "strand_of_alignments": f"SELECT ref_name, CASE WHEN flag & 16 = 0 THEN '+' ELSE '-' END AS strand, count(*) AS n FROM ({_ALIGNED}) GROUP BY 1, 2",
    "name_sort": f"SELECT qname, flag FROM ({_ALIGNED})",
    "sort_by_barcode": "SELECT barcode, read_type, chrom, start_pos FROM positions_v",
    "unique_positions": f"WITH {_DEDUP} SELECT barcode, count(*) AS n, min(feature) AS feature FROM dd GROUP BY barcode",
    "cluster_files": f"WITH {_DEDUP} SELECT barcode, read_type, feature, chrom, CAST(start_pos AS BIGINT) AS start_pos, CAST(end_pos AS BIGINT) AS end_pos FROM dd",
    "tag_tables": "SELECT 'ODD' AS type, name, tag, CAST(ord % 3 AS BIGINT) AS tolerance FROM tags_v",
    "round_tables": "SELECT CAST(pos AS BIGINT) AS pos, count(DISTINCT name) AS names, min(name) AS first FROM format_v GROUP BY pos",
    "manifests": """SELECT DISTINCT concat('S', rec_no % 9) AS sample, read, concat(folder, rec_no % 5) AS path FROM reads_v, (VALUES ('R1', '/a/'), ('R2', '/b/')) t(read, folder)
UNION ALL SELECT * FROM (VALUES ('settings', 'assembly', 'mm10'), ('settings', 'num_tags', '6'), ('settings', 'bID', 'config.txt')) u
UNION ALL SELECT 'settings', concat('samples[', s, ']', part), CASE part WHEN '.name' THEN concat('S', s) WHEN '.reads[0]' THEN CAST(n AS VARCHAR) ELSE 'R1, R2' END
  FROM (SELECT rec_no % 9 AS s, count(DISTINCT rec_no % 5) AS n FROM reads_v GROUP BY 1), (VALUES ('.name'), ('.reads[0]'), ('.reads[1]')) p(part)""",
    "bead_of_position": "SELECT chrom AS bead, count(*) AS n FROM positions_v WHERE read_type = 'BPM' GROUP BY 1",
    "identify": """WITH cf AS (SELECT CASE ord % 4 WHEN 0 THEN 'DPM' WHEN 1 THEN 'Y' WHEN 2 THEN 'ODD' ELSE 'EVEN' END AS kind, name, substr(tag, 1, CAST(6 + ord // 4 % 2 AS BIGINT)) AS tag, ord // 4 % 3 AS tol, ord FROM tags_v),
r AS (SELECT rec_no, seq AS seq1, reverse(seq) AS seq2 FROM reads_v),
b AS (SELECT rec_no, name, row_number() OVER (PARTITION BY rec_no ORDER BY length(tag), ord DESC) AS rn FROM r JOIN cf ON kind = 'DPM' AND substr(seq1, 3, length(tag)) = tag),
yh AS (SELECT rec_no, name, length(tag) AS n, row_number() OVER (PARTITION BY rec_no ORDER BY length(tag), ord DESC) AS rn FROM r JOIN cf ON kind = 'Y' AND hamming(substr(seq2, 2, length(tag)), tag) <= tol),
y AS (SELECT r.rec_no, seq2, coalesce(name, 'NOT_FOUND') AS name, coalesce(n, 7) AS adv FROM r LEFT JOIN yh ON r.rec_no = yh.rec_no AND rn = 1),
st AS (SELECT rec_no, seq2, slot, kind, 1 + adv + far AS start FROM y, (VALUES (0, 'ODD', 7), (1, 'EVEN', 31), (2, 'ODD', 55)) t(slot, kind, far) WHERE length(seq2) - (1 + adv + far) >= 17),
wn AS (SELECT *, substr(seq2, CAST(start + o + 1 AS BIGINT), CAST(s AS BIGINT)) AS w FROM st, (SELECT unnest(range(0, 7)) AS o), (SELECT unnest([6, 7]) AS s) WHERE start + o + s <= length(seq2) AND (o = 0 OR start + o - 1 + 7 <= length(seq2))),
ht AS (SELECT rec_no, slot, name, row_number() OVER (PARTITION BY rec_no, slot ORDER BY o, s, ord DESC) AS rn FROM wn JOIN cf ON cf.kind = wn.kind AND length(tag) = s AND hamming(tag, w) <= tol),
hit AS (SELECT * FROM ht WHERE rn = 1),
t AS (SELECT y.rec_no, [coalesce(b.name, 'NOT_FOUND'), y.name, coalesce(h0.name, 'NOT_FOUND'), coalesce(h1.name, 'NOT_FOUND'), coalesce(h2.name, 'NOT_FOUND')] AS t FROM y LEFT JOIN b ON b.rec_no = y.rec_no AND b.rn = 1
  LEFT JOIN hit h0 ON h0.rec_no = y.rec_no AND h0.slot = 0 LEFT JOIN hit h1 ON h1.rec_no = y.rec_no AND h1.slot = 1 LEFT JOIN hit h2 ON h2.rec_no = y.rec_no AND h2.slot = 2)
SELECT rec_no, concat('@SIM:1:', rec_no, '::[', array_to_string(t, ']['), ']') AS name1, concat('@SIM:1:', rec_no, '::[', array_to_string(t, ']['), ']') AS name2, array_to_string(t, '|') AS barcode FROM t""",
    "identify_any_layout": _ANY_LAYOUT + "SELECT rec_no, concat('@SIM:1:', rec_no, '::[', replace(barcode, '|', ']['), ']') AS name1, barcode FROM bar",
    "trim_pairs": _TRIM.format(a=ADAPTER_1, b=ADAPTER_2, k=0, c=ADAPTER_1, d=ADAPTER_2),
    "trim_pairs_mismatch": _TRIM.format(a=ADAPTER_1, b=ADAPTER_2, k=1, c="T" + ADAPTER_1[1:], d=ADAPTER_2[:9] + "C" + ADAPTER_2[10:]),
    "trim_aligned": f"""WITH RECURSIVE v AS (SELECT rec_no, seq, rec_no % 4 AS q,
  ['{ADAPTER_1}', '{ADAPTER_1[:7]}A{ADAPTER_1[7:]}', '{ADAPTER_1[:11]}{ADAPTER_1[12:]}', '{ADAPTER_1[:4]}N{ADAPTER_1[5:]}'][rec_no % 4 + 1] AS a1,
  ['{ADAPTER_2}', '{ADAPTER_2[:7]}A{ADAPTER_2[7:]}', '{ADAPTER_2[:11]}{ADAPTER_2[12:]}', '{ADAPTER_2[:4]}N{ADAPTER_2[5:]}'][rec_no % 4 + 1] AS a2 FROM reads_v),
x AS (SELECT rec_no, CASE WHEN q = 0 THEN concat(substr(seq, 1, 30), substr('{ADAPTER_1}', 1, rec_no % 19)) ELSE concat(substr(seq, 1, rec_no % 45), a1, 'GGGG') END AS seq1,
  CASE WHEN q = 0 THEN concat(substr('{ADAPTER_2}', rec_no % 19 + 1), substr(seq, 20, 40)) ELSE concat(substr(seq, 1, rec_no % 9), a2, substr(seq, 10, 50)) END AS seq2 FROM v),
s AS (SELECT rec_no, 1 AS mate, reverse(seq1) AS r, '{ADAPTER_1[::-1]}' AS a FROM x UNION ALL SELECT rec_no, 2, seq2, '{ADAPTER_2}' FROM x),
d AS (SELECT rec_no, mate, 0 AS j, CAST(range(0, 19) AS INT[]) AS k FROM s
  UNION ALL SELECT rec_no, mate, j + 1, list_transform(range(1, 20), lambda i: list_min(list_transform(range(1, i + 1), lambda t: b[t] + (i - t) * 1024))) FROM (
    SELECT d.rec_no, d.mate, j, list_prepend(0, list_transform(range(1, 19), lambda i: least(k[i] + CASE WHEN substr(a, i, 1) = substr(r, j + 1, 1) THEN 0 ELSE 1024 END, k[i + 1] + 1024))) AS b
    FROM d JOIN s USING (rec_no, mate) WHERE j < length(r))),
e AS (SELECT rec_no, mate, j, k[19] // 1024 AS err, 18 - k[19] % 1024 AS part FROM d),
g AS (SELECT rec_no, mate, arg_max(j, (part - err) * 1000 + CASE WHEN mate = 1 THEN j ELSE -j END) AS j FROM e WHERE part >= 3 AND err <= part // 10 GROUP BY 1, 2),
c AS (SELECT x.rec_no, substr(seq1, 1, length(seq1) - coalesce(g.j, 0)) AS seq1, substr(seq2, coalesce(h.j, 0) + 1) AS seq2
  FROM x LEFT JOIN g ON g.rec_no = x.rec_no AND g.mate = 1 LEFT JOIN g h ON h.rec_no = x.rec_no AND h.mate = 2)
SELECT rec_no, seq1, seq2 FROM c WHERE length(seq1) >= 20 AND length(seq2) >= 20""",
    "trim_front": """WITH x AS (SELECT rec_no, CASE WHEN rec_no % 5 > 0 THEN concat(substr(seq, 1, rec_no % 12), CASE WHEN rec_no % 2 = 0 THEN 'GGTGGTCTTT' ELSE 'GCCTCTTGTT' END, substr(seq, 20, 20)) ELSE seq END AS seq FROM reads_v),
p AS (SELECT *, least(CASE WHEN strpos(seq, 'GGTGGTCTTT') > 0 THEN strpos(seq, 'GGTGGTCTTT') ELSE 999 END, CASE WHEN strpos(seq, 'GCCTCTTGTT') > 0 THEN strpos(seq, 'GCCTCTTGTT') ELSE 999 END) AS i FROM x)
SELECT rec_no, CASE WHEN i = 999 THEN seq ELSE substr(seq, i + 10) END AS seq FROM p""",
    "quality_trim": """WITH q AS (SELECT rec_no, seq, translate(seq, 'ACGT', 'I5+#') AS qual FROM reads_v),
x AS (SELECT rec_no, k, sum(CASE substr(qual, 65 - k, 1) WHEN 'I' THEN -20 WHEN '5' THEN 0 WHEN '+' THEN 10 ELSE 18 END) OVER (PARTITION BY rec_no ORDER BY k) AS s FROM q, (SELECT unnest(range(1, 65)) AS k)),
n AS (SELECT rec_no, coalesce(min(k) FILTER (WHERE s < 0), 65) AS stop FROM x GROUP BY rec_no),
m AS (SELECT rec_no, max(s) AS top FROM x JOIN n USING (rec_no) WHERE k < stop GROUP BY rec_no),
c AS (SELECT rec_no, min(k) AS cut FROM x JOIN n USING (rec_no) JOIN m USING (rec_no) WHERE k < stop AND s = top AND top > 0 GROUP BY rec_no)
SELECT rec_no, substr(seq, 1, 64 - coalesce(cut, 0)) AS seq, substr(qual, 1, 64 - coalesce(cut, 0)) AS qual FROM q LEFT JOIN c USING (rec_no)""",
    "split_manifest": """WITH f AS (SELECT concat('S', chunk) AS sample, concat('/d/', lpad(CAST(rec_no AS VARCHAR), 9, '0')) AS path FROM reads_v),
x AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY path) - 1 AS i, count(*) OVER (PARTITION BY sample) AS n FROM f)
SELECT sample, path, CAST((i >= round_even(n * 0.25::DOUBLE, 0))::INT + (i >= round_even(n * 0.5::DOUBLE, 0))::INT + (i >= round_even(n * 0.75::DOUBLE, 0))::INT AS BIGINT) AS chunk FROM x""",
    "assembly_registry": "SELECT assembly, ord::BIGINT AS ord, t.chrom, size::BIGINT AS size, coalesce(n, 0) AS n FROM (VALUES "
    + ", ".join(f"('{name}', {i}, '{c}', {n})" for name in SIZES for i, c, n in chromosomes(name))
    + ") t(assembly, ord, chrom, size) LEFT JOIN (SELECT chrom, count(*) AS n FROM positions_v WHERE read_type = 'RPM' GROUP BY chrom) p ON p.chrom = t.chrom",
}

_SQL["cluster_merge_sorted"] = _SQL["cluster_merge"]
_SQL["subsample_cached"] = _SQL["subsample_cumulative"]
_SQL["error_blocks_stream"] = (
    _SQL["error_blocks"].replace("SELECT *, regexp", "SELECT *, line_no % 3 AS log_no, regexp").replace("OVER (ORDER", "OVER (PARTITION BY log_no ORDER").replace("PARTITION BY block", "PARTITION BY log_no, block")
    .replace("SELECT CAST(block", "SELECT log_no, CAST(block").replace("GROUP BY block", "GROUP BY log_no, block")
)

ORACLE = {name: oracle(sql) for name, sql in _SQL.items()}
