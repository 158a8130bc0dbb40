"""Pyramids kept up to date, and a catalogue that follows a stream."""

import numpy as np

from quadrille.operators import chunks, levels
from quadrille.streaming import upsert
from test_chunks import arrays, as_blocks


def nodes(df):
    return {(r.level, r.vol_id, r.cx, r.cy, r.cz): (tuple(r.dims), tuple(np.round(r.data, 12))) for r in df.collect()}


def test_updates_equal_a_full_run(spark, tmp_path):
    side, made = 4, arrays(3)
    old, other = str(tmp_path / "a"), str(tmp_path / "b")
    first = chunks.chunked(as_blocks(spark, made), side)
    assert levels.update(spark, old, first, side) == 1
    assert levels.update(spark, old, first, side) == 1 and levels.versions(spark, old).where("version > 1").count() == 0
    made[0][2, 3, 13] += 5.0
    made[3][6, 19, 0] -= 2.0
    second = chunks.chunked(as_blocks(spark, made), side).where("not (vol_id = 1 and cx = 0)")  # and a chunk goes
    levels.update(spark, old, second, side)
    levels.update(spark, other, second, side)
    assert nodes(levels.stored(spark, old)) == nodes(levels.stored(spark, other))
    wrote = {(r.level, r.vol_id, r.cx, r.cy, r.cz): r.gone for r in levels.versions(spark, old).where("version = 2").collect()}
    assert {k for k in wrote if k[1] == 0} == {(0, 0, 3, 0, 0), (1, 0, 1, 0, 0), (2, 0, 0, 0, 0), (3, 0, 0, 0, 0)}
    assert wrote[0, 1, 0, 0, 0] is True and not any(k[1] == 2 for k in wrote)
    top = nodes(levels.stored(spark, old, 3))
    assert set(top) == {(3, 0, 0, 0, 0), (3, 3, 0, 0, 0)}


def test_upserts(spark, tmp_path):
    """Late rows, several rows of a path in one batch, and a stop between batches."""
    schema = "path string, seq bigint, o0 bigint"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: upsert.follow(spark, str(tmp_path / "in"), schema, str(tmp_path / "cat"), str(tmp_path / "cp")).awaitTermination(120)
    now = lambda: {r.path: (r.seq, r.o0, r.late) for r in upsert.current(spark, str(tmp_path / "cat")).collect()}
    put([("a", 1, 5), ("b", 1, 6), ("a", 3, 8), ("c", None, 1)])
    run()
    assert now() == {"a": (3, 8, 1), "b": (1, 6, 0)}
    put([("a", 2, 7), ("b", 1, 99), ("d", 4, 4)])  # late, and no newer
    run()
    assert now() == {"a": (3, 8, 1), "b": (1, 6, 0), "d": (4, 4, 0)}
    put([("a", 5, 1), ("b", 2, 2)])
    run()
    assert now() == {"a": (5, 1, 2), "b": (2, 2, 1), "d": (4, 4, 0)}
