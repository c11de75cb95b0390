"""Chunks that are added to what is kept, and lines that come in micro-batches."""

import random
import shutil

import pytest

from beadloom.operators import clusters, qc
from beadloom.plans.adapters import view
from beadloom.plans.queries import QUERIES
from beadloom.sources import chunks
from beadloom.streaming import logs


def test_merge_of_chunks_has_no_exchange(spark, sf_dir, tmp_path):
    p = view(spark, sf_dir, "positions_v")
    for c in range(3):
        chunks.write_clusters(p.filter(f"chunk = {c}"), "kept_chunks", str(tmp_path / "t"), 6)
    merged = chunks.merge_clusters(spark, "kept_chunks")
    by_barcode = merged.groupBy("barcode").count()
    plan = by_barcode._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "kept_chunks" in plan
    assert plan.count("HashAggregate") == plan.count("HashAggregate(keys=[barcode")
    want = clusters.build(p.filter("chunk < 3")).select(merged.columns[:5])
    assert merged.select(want.columns).exceptAll(want).isEmpty() and merged.count() == want.count()
    # a chunk's build takes one shuffle
    plan = clusters.build_chunks(p.repartition(6, "barcode"), "chunk")._jdf.queryExecution().executedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Exchange ") for line in plan.split("\n")) == 1, plan
    files = [x.name for x in (tmp_path / "t" / "chunk=0").glob("*.parquet")]
    assert len(files) <= 6
    spark.sql("DROP TABLE kept_chunks")


def test_curves_read_new_chunks_only(spark, sf_dir, tmp_path):
    p = view(spark, sf_dir, "positions_v").select("barcode", "read_type", "chunk")
    paths = {c: str(tmp_path / f"c{c}") for c in range(3)}
    for c, path in paths.items():
        p.filter(f"chunk = {c}").write.parquet(path)
    opened = []

    def read(s, path):
        opened.append(path)
        return s.read.parquet(path)

    cache = chunks.CurveCache(spark, str(tmp_path / "cache"))
    with pytest.raises(ValueError, match="chunks are"):
        cache.curves()
    assert cache.update({0: paths[0], 1: paths[1]}, read) == [0, 1]
    assert cache.update({0: paths[0], 1: paths[1], 2: paths[2]}, read) == [2] and opened == [paths[0], paths[1], paths[2]]
    got = cache.curves()
    assert all("cache/counts" in f for f in got.inputFiles())
    want = clusters.subsample_curves(p.filter("chunk < 3"), 3)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(got) == rows(want)
    shutil.rmtree(paths[0])  # no old chunk is needed
    assert rows(chunks.CurveCache(spark, str(tmp_path / "cache")).curves()) == rows(want)
    # a chunk that has changed is counted anew
    p.filter("chunk = 3").write.mode("overwrite").parquet(paths[1])
    assert cache.update({1: paths[1]}, read) == [1]
    assert sum(r.reads for r in cache.curves().filter("n_chunk = 2").collect()) != sum(r.reads for r in want.filter("n_chunk = 2").collect())


LINES = ["Error in rule one:", "  jobid: 4", "  log: a/b.log", "", "jobid: 9", "Error in rule two:", "Error in rule three:", "jobid: 1", "jobid: 2", "Finished job 2.", "log: x", "text", "Error in rule four: jobid: 77", "log: c.log", "log: d.log"]


def by_hand(lines):
    out, block, state = [], 0, None
    import re

    for no, line in lines:
        start = re.search(qc.RULE, line)
        if start:
            out += [state] if state else []
            block += 1
            state = [block, no, start.group(1), None, None]
        if state is None:
            continue
        job, log = re.search(qc.JOBID, line), re.search(qc.LOG, line)
        if job:
            state[3] = job.group(1)
        elif log:
            state[4] = log.group(1)
        elif not start and (not line.strip(" ") or qc.FINISHED in line):
            out.append(state)
            state = None
    return [tuple(x) for x in out + ([state] if state else [])]


@pytest.mark.parametrize("pieces", [1, 3, 7])
def test_blocks_in_any_number_of_batches(spark, tmp_path, pieces):
    """Each piece is a run of its own, which goes on from the checkpoint."""
    rng = random.Random(pieces)
    per = {name: [(i * 2 + 1, line) for i, line in enumerate(rng.sample(LINES, len(LINES)) if name else LINES)] for name in range(4)}
    rows = [(name, no, line) for name, x in per.items() for no, line in [*x, (999, None)]]
    cuts = sorted(rng.sample(range(1, 32), pieces - 1))
    schema = "run int, line_no long, line string"
    for a, b in zip([0, *cuts], [*cuts, 1000]):
        part = [r for r in rows if a <= r[1] < b]
        spark.createDataFrame(part, schema).coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))
        found = logs.error_blocks(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "run")
        q = found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
    got = {}
    for r in spark.read.parquet(str(tmp_path / "out")).collect():
        got.setdefault(r.run, []).append((r.block, r.line_no, r.rule, r.jobid, r.log))
    assert {k: sorted(v) for k, v in got.items()} == {k: by_hand(v) for k, v in per.items()}
    whole = qc.error_blocks(spark.createDataFrame([r for r in rows if r[2] is not None], schema), ["run"])
    assert sorted((r.run, r.block, r.line_no, r.rule, r.jobid, r.log) for r in whole.collect()) == sorted((k, *x) for k, v in got.items() for x in v)


def test_late_lines_are_an_error(spark, tmp_path):
    schema = "run int, line_no long, line string"
    for no in (5, 4):
        spark.createDataFrame([(1, no, "x")], schema).write.mode("append").parquet(str(tmp_path / "in"))
        found = logs.error_blocks(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "run")
        q = found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        if no == 5:
            q.awaitTermination()
        else:
            with pytest.raises(Exception, match="comes behind"):
                q.awaitTermination()


def test_distributions_in_ranges(spark, sf_dir):
    for name in ("max_rep_ecdf", "split_manifest"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        assert all("__p" in "".join(lines[i : i + 4]) for i, line in enumerate(lines) if "Exchange SinglePartition" in line), plan
