"""Streams against the same rows in a batch."""

from lumenvox.operators import fusion
from lumenvox.sources import tables
from lumenvox.streaming.fusion import fused_stream, points_stream


def test_fused_stream_equals_the_batch(spark, sf_dir, tmp_path):
    points = tables.points(spark, sf_dir)
    points.repartition(5).write.parquet(f"{tmp_path}/points")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    stream = fused_stream(points_stream(spark, f"{tmp_path}/points", schema, 2), 0.1, 3)
    query = stream.writeStream.outputMode("complete").format("memory").queryName("voxels").trigger(availableNow=True).start()
    query.awaitTermination(120)
    key = lambda df: sorted((r.vx, r.vy, r.vz, r.n, round(r.cx, 9), r.r) for r in df.collect())
    assert key(spark.table("voxels")) == key(fusion.voxel_fuse(points, 0.1, 3))
