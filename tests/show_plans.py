"""Print the formatted physical plans of the headline queries.

    python tests/show_plans.py [sf_dir] > plans.txt

Stage tables are written first (as the batch stages do), so the plans are
those a user gets on the hand-over tables.
"""

from __future__ import annotations

import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv):
    from pyspark.sql import functions as F

    from tablework.operators import augment, groups, profile, shapes
    from tablework.plans import batch, reports, standins
    from tablework.session import build_session, shared_scratch

    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8,
                          checkpoint_if_unset=tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    feed = standins.feed(spark, sf)
    sched = batch.write_schedule(feed, shared_scratch(spark, "schedule"))
    delays = batch.write_delays(spark, sched, shared_scratch(spark, "delays"))
    s = batch.write_star_tables(delays, shared_scratch(spark, "star"))
    shown = {
        "denormalise + group volume (from the feed)": groups.group_volume(
            standins.schedule(spark, sf)),
        "augment": augment.augment_delays(sched),
        "profile (exact)": profile.profile_columns(delays),
        "group stats": groups.group_stats(delays),
        "top-k routes": groups.topk_groups(delays),
        "value shares": groups.value_share(delays, "is_disrupted"),
        "histogram": shapes.histogram(delays, "delay_minutes"),
        "density": shapes.density_curve(delays, "delay_minutes"),
        "routes over threshold (star SQL)": reports.routes_over_threshold(spark, s, 5.0),
        "trip lookup": s["delay_events"].where(F.col("trip_id") == "7"),
    }
    for name, df in shown.items():
        print("=" * 30, name)
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
