"""Incremental ingest: files arriving in two rounds, the query restarted from
its checkpoint, give exactly the batch result (no file skipped or repeated)."""

import os


from conftest import write_text
from tablework.operators.augment import augment_delays
from tablework.operators.denorm import denormalise
from tablework.sources import read_feed, schemas
from tablework.streaming import read_stop_event_stream, start_delay_sink, stream_delays


def _dims(spark):
    trips = spark.createDataFrame([(f"T{i}", f"R{i % 3}", "C1", "h", i % 2) for i in range(6)],
                                  "trip_id string, route_id string, service_id string, "
                                  "trip_headsign string, direction_id int")
    routes = spark.createDataFrame([(f"R{i}", f"{i}A", "AG", 3) for i in range(3)],
                                   "route_id string, route_short_name string, agency_id string, route_type int")
    stops = spark.createDataFrame([(f"S{i}", f"stop {i}") for i in range(4)], "stop_id string, stop_name string")
    cal = spark.createDataFrame([("C1", 1, 1, 1, 1, 1, 0, 0)],
                                "service_id string, monday int, tuesday int, wednesday int, "
                                "thursday int, friday int, saturday int, sunday int")
    return trips, routes, stops, cal


def _file(folder, name, rows):
    body = "stop_id,trip_id,stop_sequence,arrival_time\n" + "".join(
        f"S{s},T{t},{q},{h:02d}:00:00\n" for s, t, q, h in rows)
    return write_text(os.path.join(folder, name), body)


def test_two_rounds_equal_batch(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    trips, routes, stops, cal = _dims(spark)
    header = ["stop_id", "trip_id", "stop_sequence", "arrival_time"]
    _file(src, "a.csv", [(i % 4, i % 6, i, 6 + i % 20) for i in range(40)])

    def run():
        stream = read_stop_event_stream(spark, src, "csv", header_columns=header)
        q = start_delay_sink(stream_delays(stream, trips, routes, stops, cal), out, ckpt)
        q.awaitTermination()

    run()
    assert spark.read.parquet(out).count() == 40
    _file(src, "b.csv", [(i % 4, i % 6, i, 25) for i in range(40, 70)] + [(1, 99, 1, 8)])
    run()  # restart: only the new file is processed
    got = spark.read.parquet(out)
    batch = augment_delays(denormalise(read_feed(spark, src, schemas.STOP_TIMES),
                                       trips, routes, stops, cal))
    cols = ["trip_id", "stop_sequence", "stop_id", "p_on_time", "is_disrupted",
            "delay_minutes", "disruption_reason", "monday"]
    assert got.count() == 70  # the orphan stop event (trip T99) is dropped
    assert sorted(map(tuple, got.select(*cols).collect())) == \
        sorted(map(tuple, batch.select(*cols).collect()))


def test_reordered_file_header_fails_loudly(spark, tmp_dir):
    import pytest
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    trips, routes, stops, cal = _dims(spark)
    write_text(f"{src}/a.csv", "trip_id,stop_id,stop_sequence,arrival_time\nT1,S1,1,08:00:00\n")
    stream = read_stop_event_stream(spark, src, "csv",
                                    header_columns=["stop_id", "trip_id", "stop_sequence", "arrival_time"])
    q = start_delay_sink(stream_delays(stream, trips, routes, stops, cal), out, f"{tmp_dir}/ckpt")
    with pytest.raises(Exception):
        q.awaitTermination()
