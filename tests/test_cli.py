"""The stage commands, end to end on a hand-made feed folder."""

import glob
import os

from conftest import write_text


def _write_feed(folder, skip=()):
    files = {
        "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n" + "".join(
            f"T{t},{h:02d}:10:00,{h:02d}:11:00,S{s},{q}\n"
            for t in range(40) for q, (s, h) in enumerate([(t % 5, 6 + t % 20), ((t + 1) % 5, 25)], 1)),
        "trips": "route_id,trip_id,service_id,trip_headsign,direction_id\n" + "".join(
            f"R{t % 4},T{t},C{t % 3},to {t % 4},{t % 2}\n" for t in range(40)),
        "routes": "route_id,route_short_name,agency_id,route_type\n" + "".join(
            f"R{r},{r}A,AG{r % 2},3\n" for r in range(4)),
        "stops": "stop_id,stop_name\n" + "".join(f"S{s},stop {s}\n" for s in range(5)),
        # service C2 has no calendar row
        "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday\n"
                    "C0,1,1,1,1,1,0,0\nC1,1,1,1,1,1,1,1\n",
    }
    for name, body in files.items():
        if name not in skip:
            write_text(f"{folder}/{name}.txt", body)
    return folder


def test_stage_commands(spark, tmp_dir):
    from tablework.__main__ import main
    feed, out = f"{tmp_dir}/feed", f"{tmp_dir}/out"
    _write_feed(feed)
    r = main(["ingest", "--feed", feed, "--out", f"{out}/schedule", "--min-rows", "50"], spark, 0)
    assert r["gate"].first().n_rows == 80 and r["gate"].first().ok
    assert sum(x.num_stop_events for x in r["volume"].collect()) == 80
    r = main(["augment", "--src", f"{out}/schedule", "--out", f"{out}/delays"], spark, 0)
    assert r["on_time"].first().n_rows == 80
    r = main(["profile", "--src", f"{out}/delays"], spark, 0)
    prof = {x.column: x for x in r["profile"].collect()}
    assert prof["monday"].null_count > 0  # service C2 has no calendar row
    r = main(["features", "--src", f"{out}/delays", "--out", f"{out}/model"], spark, 0)
    rows = {x.split: x["count"] for x in r["rows"].collect()}
    assert sum(rows.values()) < 80  # rows of service C2 are skipped by the assembler
    r = main(["models", "--src", f"{out}/model", "--metrics", f"{out}/metrics", "--train-fraction", "0.9"], spark, 0)
    for name in ("Random Forest", "Gradient Boosted Trees"):
        found = r[f"importance: {name}"].collect()
        assert "is_disrupted" in [x.feature for x in found] and abs(sum(x.importance for x in found) - 1) < 1e-9
    assert [x.model for x in r["comparison"].collect()] == [
        "Linear Regression", "Random Forest", "Gradient Boosted Trees"]
    assert len(glob.glob(f"{out}/metrics/part-*.csv")) == 1
    r = main(["star", "--src", f"{out}/delays", "--out", f"{out}/star", "--threshold", "0"], spark, 0)
    assert r["on_time_share"].first().pct_on_time is not None
    assert os.path.isdir(f"{out}/star/delay_events")


def test_a_missing_file_is_an_error(spark, tmp_dir):
    import pytest
    from tablework.sources import read_feed_folder
    for name in ("calendar", "trips"):
        folder = f"{tmp_dir}/no_{name}"
        _write_feed(folder, skip=(name,))
        with pytest.raises(FileNotFoundError, match=name):
            read_feed_folder(spark, folder)


def test_a_missing_weekday_loses_no_rows(spark, tmp_dir):
    from tablework.operators import augment, features
    from tablework.plans import batch
    from tablework.sources import read_feed_folder
    feed = f"{tmp_dir}/no_sunday"
    _write_feed(feed)
    write_text(f"{feed}/calendar.txt", "service_id,monday,tuesday,wednesday,thursday,friday,saturday\n"
               "C0,1,1,1,1,1,0\nC1,1,1,1,1,1,1\nC2,0,0,0,0,0,1\n")
    delays = augment.augment_delays(batch.write_schedule(read_feed_folder(spark, feed), f"{tmp_dir}/schedule"))
    assert "sunday" not in delays.columns
    train, test, _ = features.model_tables(delays)
    assert train.count() + test.count() == delays.count() == 80


def test_star_sample_fraction(spark, tmp_dir):
    from tablework.plans import batch, standins as SI
    from tablework.operators import star
    from conftest import SF001
    d = SI.delays(spark, SF001)
    s = batch.write_star_tables(d, f"{tmp_dir}/star", fraction=0.25)
    n = s["delay_events"].count()
    assert 0.2 * 6000 < n < 0.3 * 6000
    assert star.orphan_counts(s).first().orphan_events == 0
