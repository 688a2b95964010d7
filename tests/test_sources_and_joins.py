"""Hand-made feeds (FIXTURES §C): binding by name, text ids, join rules."""

import pytest
from pyspark.sql import functions as F

from conftest import write_text
from tablework.operators.denorm import denormalise
from tablework.sources import read_feed, read_table, row_gate, schemas, write_table


def test_reordered_header_binds_by_name(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/stop_times.txt",
                   "stop_sequence,stop_id,trip_id,arrival_time,extra_col\n"
                   "3,S1,T1,08:00:00,x\n"
                   "4,S2,T2,25:10:00,y\n")
    df = read_feed(spark, p, schemas.STOP_TIMES)
    assert df.columns == ["trip_id", "arrival_time", "stop_id", "stop_sequence", "extra_col"]  # absent ones left out
    assert "extra_col" in df.columns  # undeclared columns pass through
    rows = {r.trip_id: r for r in df.collect()}
    assert rows["T1"].stop_id == "S1" and rows["T1"].stop_sequence == 3
    assert rows["T2"].arrival_time == "25:10:00" and rows["T2"].stop_sequence == 4


def test_ids_stay_text_and_join_exactly(spark, tmp_dir):
    st = write_text(f"{tmp_dir}/st.txt", "trip_id,stop_id,stop_sequence\n001,s,1\n0500A,s,2\nabc,s,3\n")
    tr = write_text(f"{tmp_dir}/tr.txt", "trip_id,route_id\n001,R\n0500A,R\nabc,R\n1,R\n")
    a = read_feed(spark, st, schemas.STOP_TIMES)
    b = read_feed(spark, tr, schemas.TRIPS)
    assert sorted(r.trip_id for r in a.collect()) == ["001", "0500A", "abc"]
    joined = a.join(b, "trip_id")
    assert sorted(r.trip_id for r in joined.collect()) == ["001", "0500A", "abc"]


def test_bad_numbers_become_null(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/st.txt", "trip_id,stop_sequence,shape_dist_traveled\nT,x,1.5\nT, 7 ,oops\n")
    rows = read_feed(spark, p, schemas.STOP_TIMES).orderBy("shape_dist_traveled").collect()
    assert [r.stop_sequence for r in rows] == [7, None]
    assert [r.shape_dist_traveled for r in rows] == [None, 1.5]


def test_inferred_read_is_an_option(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/r.txt", "route_id,route_type\n001,3\n")
    df = read_feed(spark, p, infer="spark")
    assert df.collect()[0].route_id == 1  # the reference's inference loses the zeros
    row = read_feed(spark, p, infer=True).collect()[0]
    assert (row.route_id, row.route_type) == ("001", 3)
    assert read_feed(spark, p, schemas.ROUTES).collect()[0].route_id == "001"


def test_missing_input_names_the_step(spark, tmp_dir):
    with pytest.raises(FileNotFoundError, match="ingest"):
        read_table(spark, f"{tmp_dir}/nope.parquet", step="ingest")


def test_row_gate(spark):
    df = spark.range(5)
    r = row_gate(df, 3).collect()[0]
    assert (r.n_rows, r.threshold, r.ok) == (5, 3, True)
    assert row_gate(df, 10).collect()[0].ok is False


def test_partitioned_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1)], "k string, p int")
    write_table(df, f"{tmp_dir}/t", partition_by=["p"])
    back = read_table(spark, f"{tmp_dir}/t")
    assert sorted((r.k, r.p) for r in back.collect()) == [("a", 1), ("b", 2), ("c", 1)]


def _feed(spark):
    st = spark.createDataFrame(
        [("T1", "S1", 1, "08:00:00"), ("T1", "S2", 2, "08:10:00"), ("T2", "S1", 1, "09:00:00"),
         ("T9", "S1", 1, "10:00:00"), ("T3", "SX", 1, "11:00:00")],
        "trip_id string, stop_id string, stop_sequence int, arrival_time string")
    trips = spark.createDataFrame(
        [("T1", "R1", "C1"), ("T2", "RX", "C1"), ("T3", "R1", "CX")],
        "trip_id string, route_id string, service_id string")
    routes = spark.createDataFrame([("R1", "1A")], "route_id string, route_short_name string")
    stops = spark.createDataFrame([("S1", "first"), ("S1", "dup"), ("S2", "second")],
                                  "stop_id string, stop_name string")
    cal = spark.createDataFrame([("C1", 1)], "service_id string, monday int")
    return st, trips, routes, stops, cal


def test_denormalise_rules(spark):
    df = denormalise(*_feed(spark))
    assert df.columns[:4] == ["service_id", "stop_id", "route_id", "trip_id"]
    rows = df.collect()
    assert not [r for r in rows if r.trip_id == "T9"]  # orphan stop event dropped
    t2 = [r for r in rows if r.trip_id == "T2"]
    assert len(t2) == 2 and all(r.route_short_name is None for r in t2)  # unknown route kept
    assert {r.stop_name for r in t2} == {"first", "dup"}  # duplicate stop key fans out
    t3 = [r for r in rows if r.trip_id == "T3"]
    assert len(t3) == 1 and t3[0].stop_name is None and t3[0].monday is None
    assert df.count() == 2 + 1 + 2 + 1  # T1: S1 fans out x2 + S2; T2 x2; T3


def test_entry_smoke(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    rows = out.collect()
    assert out.columns == ["route_short_name", "num_stop_events", "num_trips"]
    assert len(rows) == 5 and sum(r.num_stop_events for r in rows) == 6000
    assert set(E.oracle_sql()) <= set(E.queries())


def test_partitioned_write_groups_values_and_splits_a_hot_one(spark, tmp_dir):
    import glob
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(300000).repartition(8).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 5).cast("string"))
            .alias("route"), (F.col("id") * 7).alias("v"))
        counts = {}
        for rb in (False, True):
            write_table(df, f"{tmp_dir}/t{rb}", partition_by=["route"], rebalance=rb)
            counts[rb] = {r: len(glob.glob(f"{tmp_dir}/t{rb}/route={r}/*.parquet"))
                          for r in ["HOT", "0", "1", "2", "3", "4"]}
            assert read_table(spark, f"{tmp_dir}/t{rb}").count() == 300000
        assert all(counts[True][r] < counts[False][r] for r in "01234")
        assert counts[True]["HOT"] >= 2
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_text_partition_keys_keep_their_zeros(spark, tmp_dir):
    df = spark.createDataFrame([("001", 1), ("0500", 2)], "route_id string, n int").select("n", "route_id")
    write_table(df, f"{tmp_dir}/ids", partition_by=["route_id"])
    back = read_table(spark, f"{tmp_dir}/ids", schema=df.schema)
    assert sorted((r.route_id, r.n) for r in back.collect()) == [("001", 1), ("0500", 2)]


def test_checkpoint_folder_is_not_guessed_on_a_cluster():
    from types import SimpleNamespace

    from tablework.session import checkpoint_root
    conf = SimpleNamespace(get=lambda k, d=None: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=sc))


def test_folder_of_files_with_different_header_orders_is_refused(spark, tmp_dir):
    write_text(f"{tmp_dir}/feed/a.csv", "trip_id,stop_id\nT1,S1\n")
    write_text(f"{tmp_dir}/feed/b.csv", "stop_id,trip_id\nS2,T2\n")
    with pytest.raises(Exception):
        read_feed(spark, f"{tmp_dir}/feed", schemas.STOP_TIMES).collect()
    write_text(f"{tmp_dir}/ok/a.csv", "trip_id,stop_id\nT1,S1\n")
    write_text(f"{tmp_dir}/ok/b.csv", "trip_id,stop_id\nT2,S2\n")
    got = sorted((r.trip_id, r.stop_id) for r in read_feed(spark, f"{tmp_dir}/ok", schemas.STOP_TIMES).collect())
    assert got == [("T1", "S1"), ("T2", "S2")]
