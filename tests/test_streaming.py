"""The windowed counts of a stream equal those of the table."""

from __future__ import annotations

from tidewell.streaming.events import event_stream, windowed_counts

DATA = "/root/testdata/sf0.001"


def test_stream_equals_table(spark, tmp_path):
    table = spark.read.parquet(f"{DATA}/events.parquet")
    stream = windowed_counts(event_stream(spark, DATA, table.schema))
    run = stream.writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path)).start()
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    got = sorted(map(tuple, spark.sql("SELECT * FROM counts").collect()))
    assert got == sorted(map(tuple, windowed_counts(table).collect()))
