"""Chunks that arrive one after another give the clusters of the whole."""

from beadloom.operators import clusters
from beadloom.plans.adapters import view
from beadloom.streaming import positions


def test_chunks_as_they_arrive(spark, sf_dir, tmp_path):
    whole = view(spark, sf_dir, "positions_v")
    inbox, table, state = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "state")
    for c in range(2):
        whole.filter(f"chunk % 2 = {c}").coalesce(1).write.mode("append").parquet(inbox)
        stream = positions.distinct_positions(positions.arriving(spark, inbox, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in whole.schema)))
        positions.append_to(stream, table, state).awaitTermination()
    got, want = clusters.label(clusters.build(spark.read.parquet(table))), clusters.label(clusters.build(whole))
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
