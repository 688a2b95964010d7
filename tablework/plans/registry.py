"""Registered checks: one Spark query per operator key and, where SQL can
express it, the same result as DuckDB SQL over the driver's tables.

Every query reads whole tables (no id subsets, no row caps); a limit occurs
only where it is the feature (top-k).  Floating results of sums, means and
transcendental functions are rounded to 6 digits on both sides, since two
engines add in different orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tablework.functions import draws, scalars
from tablework.operators import (augment, denorm, features, groups, linear_state, models, profile,
                                 quantiles, sampling, shapes, star, states)
from tablework.plans import oracle as O
from tablework.plans import reports, standins as SI
from tablework.session import shared_scratch
from tablework.sources import feeds, schemas

KEYS = ["trip_id", "stop_sequence", "stop_id"]
KSQL = ", ".join(KEYS)
ROUND = 6


def rounded(df: DataFrame, digits: int = ROUND) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def r(expr: str, alias: str, digits: int = ROUND) -> str:
    # "+ 0.0" turns DuckDB's -0.0 into 0.0, as Spark's decimal rounding does
    return f"(round({expr}, {digits}) + CAST(0 AS DOUBLE)) AS {alias}"


Q: dict = {}
SQL: dict = {}


def query(name, sql: str | None = None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


W_DELAYS = O.with_ctes(O.DELAYS_CTE)
W_SCHED = O.with_ctes(O.SCHEDULE_CTE)
W_FEED = O.with_ctes(O.FEED_CTES)
W_EV = O.with_ctes(O.EVENTS_DELAY_CTE)

# --------------------------------------------------------------- sources


@query("denormalise", f"{W_SCHED} SELECT * FROM schedule")
def q_denormalise(spark, sf):
    return SI.schedule(spark, sf)


@query("group_volume", f"""{W_SCHED}
SELECT route_short_name, COUNT(*) AS num_stop_events, COUNT(DISTINCT trip_id) AS num_trips
FROM schedule GROUP BY route_short_name""")
def q_group_volume(spark, sf):
    return groups.group_volume(SI.schedule(spark, sf))


@query("csv_typed_scan", f"{W_FEED} SELECT * FROM stop_times")
def q_csv_typed_scan(spark, sf):
    # Written with the header in reverse order: the reader binds by name.
    st = SI.stop_times(spark, sf)
    path = shared_scratch(spark, "stop_times_csv")
    st.select(*reversed(st.columns)).write.option("header", True).csv(path)
    return feeds.read_feed(spark, path, schemas.STOP_TIMES)


@query("csv_inferred_scan", """SELECT CAST(o_orderkey AS INTEGER) AS trip_id,
  CAST(o_custkey AS INTEGER) AS route_id, CAST(o_orderkey % 30 AS INTEGER) AS service_id,
  o_orderpriority AS trip_headsign, CAST(o_orderkey % 2 AS INTEGER) AS direction_id FROM orders""")
def q_csv_inferred_scan(spark, sf):
    # types by the lattice, one pass: numbers without leading zeros become ints
    path = shared_scratch(spark, "trips_csv")
    SI.trips(spark, sf).write.option("header", True).csv(path)
    return feeds.read_feed(spark, path, infer=True)


@query("csv_inferred_ids", """SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS trip_id,
  CAST(o_custkey AS BIGINT) * 10000000000 AS far_id, CAST(o_orderkey AS VARCHAR) || '000000000000000000' AS long_id,
  CAST(o_custkey AS DOUBLE) / 4 AS share, o_orderkey % 2 = 0 AS even,
  CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS mixed,
  CAST(NULL AS VARCHAR) AS nothing FROM orders""")
def q_csv_inferred_ids(spark, sf):
    """Ids with leading zeros, over-long digits and mixed cells stay text."""
    o = SI.table(spark, sf, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    path = shared_scratch(spark, "ids_csv")
    o.select(F.lpad(key.cast("string"), 12, "0").alias("trip_id"), (cust.cast("bigint") * 10000000000).alias("far_id"),
             F.concat(key.cast("string"), F.lit("0" * 18)).alias("long_id"), (cust.cast("double") / 4).alias("share"),
             (key % 2 == 0).alias("even"), F.when(key % 5 == 0, "n/a").otherwise(cust.cast("string")).alias("mixed"),
             F.lit(None).cast("string").alias("nothing")).write.option("header", True).csv(path)
    return feeds.read_feed(spark, path, infer=True)


@query("parquet_scan", """SELECT * EXCLUDE (l_shipdate), epoch_us(l_shipdate) AS ship_micros FROM lineitem""")
def q_parquet_scan(spark, sf):
    # the timestamp as microseconds, so that no engine's text form matters
    li = SI.table(spark, sf, "lineitem")
    return li.select(*[c for c in li.columns if c != "l_shipdate"],
                     F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ship_micros"))


@query("parquet_roundtrip", f"{W_DELAYS} SELECT * FROM delays")
def q_parquet_roundtrip(spark, sf):
    path = shared_scratch(spark, "delays")
    feeds.write_table(SI.delays(spark, sf), path, partition_by=["direction_id"])
    return feeds.read_table(spark, path, step="augment")


@query("stream_delays", f"{W_DELAYS} SELECT * FROM delays")
def q_stream_delays(spark, sf):
    # Stop events land as CSV files, a fourth of them per micro-batch; the
    # stream appends augmented rows; the result equals the batch.
    from tablework.streaming import feed as SF
    st = SI.stop_times(spark, sf)
    src = shared_scratch(spark, "stop_event_files")
    splits = st.rdd.getNumPartitions()
    (st if splits >= 4 else st.repartition(4)).write.option("header", True).csv(src)
    stream = SF.read_stop_event_stream(spark, src, "csv", header_columns=st.columns,
                                       max_files_per_trigger=-(-splits // 4))
    f = SI.feed(spark, sf)
    out = shared_scratch(spark, "streamed_delays")
    q = SF.start_delay_sink(SF.stream_delays(stream, f["trips"], f["routes"], f["stops"],
                                             f["calendar"]), out, out + "_checkpoint")
    q.awaitTermination()
    return feeds.read_table(spark, out, step="stream")


@query("batch_delays", f"{W_DELAYS} SELECT * FROM delays")
def q_batch_delays(spark, sf):
    # The stage hand-overs: feed -> schedule table -> delays table.
    from tablework.plans import batch
    sched = batch.write_schedule(SI.feed(spark, sf), shared_scratch(spark, "schedule"))
    return batch.write_delays(spark, sched, shared_scratch(spark, "delays"))


FACT_SQL = f"""{W_DELAYS},
numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {KSQL} ORDER BY arrival_time NULLS FIRST,
                    delay_minutes NULLS FIRST, is_disrupted NULLS FIRST, disruption_reason NULLS FIRST) AS nth
             FROM delays),
fact AS (SELECT {O.hash_id(*KEYS, 'nth')} AS event_id, trip_id, stop_id, stop_sequence, arrival_time,
                delay_minutes, CAST(is_disrupted AS INTEGER) AS is_disrupted, disruption_reason
         FROM numbered)"""


@query("star_roundtrip", f"{FACT_SQL} SELECT * FROM fact")
def q_star_roundtrip(spark, sf):
    path = shared_scratch(spark, "star")
    paths = feeds.write_star(star.build_star(SI.delays(spark, sf), id_mode="hash"), path)
    return feeds.read_table(spark, paths["delay_events"])


@query("star_published", f"{FACT_SQL} SELECT * FROM fact")
def q_star_published(spark, sf):
    """A star published twice; what is read is the newer one, whole."""
    s, target = star.build_star(SI.delays(spark, sf), id_mode="hash"), shared_scratch(spark, "star")
    feeds.publish_star({name: df.limit(0) for name, df in s.items()}, target)
    feeds.publish_star(s, target)
    return feeds.read_star(spark, target)["delay_events"]


@query("partitioned_ids", """SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, l_linenumber AS stop_sequence,
  lpad(CAST(l_partkey % 7 AS VARCHAR), 3, '0') AS zone FROM lineitem""")
def q_partitioned_ids(spark, sf):
    # ids with leading zeros as partition keys: the written schema keeps them text
    st = SI.stop_times(spark, sf)
    zoned = st.select("trip_id", "stop_sequence",
                      F.lpad((F.col("stop_id").cast("bigint") % 7).cast("string"), 3, "0").alias("zone"))
    path = feeds.write_table(zoned, shared_scratch(spark, "zones"), partition_by=["zone"])
    return feeds.read_table(spark, path, schema=zoned.schema)


@query("row_gate", """SELECT COUNT(*) AS n_rows, CAST(100000 AS BIGINT) AS threshold,
  COUNT(*) >= 100000 AS ok FROM lineitem""")
def q_row_gate(spark, sf):
    """Counted while the table is written."""
    rows, gate = feeds.gated(SI.stop_times(spark, sf), 100_000)
    feeds.write_table(rows, shared_scratch(spark, "stop_times"))
    return gate()


def _bad_feed(spark, sf) -> str:
    """Stop events as CSV with cells that their types refuse."""
    bad = SI.stop_times(spark, sf).withColumns({
        "stop_sequence": F.when(F.col("trip_id").cast("bigint") % 97 == 0, F.concat(F.lit("no. "), F.col("stop_sequence")))
        .when(F.col("trip_id").cast("bigint") % 89 == 0, F.lit("99999999999")).otherwise(F.col("stop_sequence").cast("string")),
        "shape_dist_traveled": F.when(F.col("stop_id").cast("bigint") % 101 == 0, F.lit("1,5 km"))
        .otherwise(F.col("shape_dist_traveled").cast("string"))})
    path = shared_scratch(spark, "bad_stop_times_csv")
    bad.write.option("header", True).csv(path)
    return path


BAD_SQL = """bad AS (SELECT CAST(l_orderkey AS VARCHAR) AS trip_id,
  CASE WHEN l_orderkey % 97 = 0 THEN 'no. ' || l_linenumber WHEN l_orderkey % 89 = 0 THEN '99999999999' END AS seq,
  CASE WHEN l_partkey % 101 = 0 THEN '1,5 km' END AS dist FROM lineitem)"""


@query("csv_rejects", f"""WITH {BAD_SQL}
SELECT 'stop_sequence' AS "column", seq AS raw,
       CASE WHEN seq = '99999999999' THEN 'out of range of int' ELSE 'not int' END AS reason FROM bad WHERE seq IS NOT NULL
UNION ALL SELECT 'shape_dist_traveled', dist, 'not double' FROM bad WHERE dist IS NOT NULL""")
def q_csv_rejects(spark, sf):
    """The cells that the declared types refuse, from the same pass that
    writes the typed rows."""
    df = feeds.read_feed(spark, _bad_feed(spark, sf), schemas.STOP_TIMES, rejects=True)
    return feeds.write_feed(df, shared_scratch(spark, "stop_times"))[1].select("column", "raw", "reason")


@query("csv_rejects_gate", f"""WITH {BAD_SQL}
SELECT COUNT(*) AS n_rows, CAST(50000 AS BIGINT) AS threshold, COUNT(*) >= 50000 AS ok,
       COUNT(seq) AS null_sequences, COUNT(dist) AS null_distances FROM bad""")
def q_csv_rejects_gate(spark, sf):
    df = feeds.read_feed(spark, _bad_feed(spark, sf), schemas.STOP_TIMES, rejects=True)
    table, _, gate = feeds.write_feed(df, shared_scratch(spark, "stop_times"), 50_000)
    nulls = table.agg(F.count_if(F.col("stop_sequence").isNull()).alias("null_sequences"),
                      F.count_if(F.col("shape_dist_traveled").isNull()).alias("null_distances")).first()
    return gate.withColumns({k: F.lit(nulls[k]).cast("bigint") for k in ("null_sequences", "null_distances")})

# ------------------------------------------------------ projections, filters


@query("project", f"""{W_DELAYS} SELECT trip_id, stop_id, delay_minutes AS delay,
  disruption_reason AS reason FROM delays""")
def q_project(spark, sf):
    d = SI.delays(spark, sf)
    return d.select("trip_id", "stop_id", F.col("delay_minutes").alias("delay"),
                    F.col("disruption_reason").alias("reason"))


@query("filter_not_null", f"""{W_DELAYS} SELECT {KSQL}, monday FROM delays
  WHERE monday IS NOT NULL""")
def q_filter_not_null(spark, sf):
    return SI.delays(spark, sf).where(F.col("monday").isNotNull()).select(*KEYS, "monday")


@query("present_columns", None)
def q_present_columns(spark, sf):
    p = features.prepare(SI.delays(spark, sf))
    names = features.present_columns(p, features.CANDIDATE_FEATURES)
    return p.select(*KEYS, *[n for n in names if n not in KEYS])


TIME_SQL = f"""{W_DELAYS},
timed AS (SELECT *, TRY_CAST(split_part(arrival_time, ':', 1) AS INTEGER) AS arrival_hour FROM delays),
timed2 AS (SELECT *, arrival_hour % 24 AS arrival_hour_mod FROM timed),
timed3 AS (SELECT *, CASE WHEN arrival_hour_mod BETWEEN 7 AND 9 OR arrival_hour_mod BETWEEN 16 AND 18
                     THEN 1 ELSE 0 END AS is_peak,
                  monday + tuesday + wednesday + thursday + friday + saturday + sunday AS num_service_days
           FROM timed2)"""


SQL["present_columns"] = (f"{TIME_SQL} SELECT {KSQL}, arrival_hour_mod, is_peak, "
                          "num_service_days, CAST(is_disrupted AS INTEGER) AS is_disrupted FROM timed3 "
                          "WHERE delay_minutes IS NOT NULL")


@query("feed_hour", f"{TIME_SQL} SELECT {KSQL}, arrival_time, arrival_hour, arrival_hour_mod FROM timed3")
def q_feed_hour(spark, sf):
    t = features.add_time_features(SI.delays(spark, sf))
    return t.select(*KEYS, "arrival_time", "arrival_hour", "arrival_hour_mod")


@query("peak_flag", f"{TIME_SQL} SELECT {KSQL}, arrival_hour_mod, is_peak FROM timed3")
def q_peak_flag(spark, sf):
    t = features.add_time_features(SI.delays(spark, sf))
    return t.select(*KEYS, "arrival_hour_mod", "is_peak")


@query("service_days", f"{TIME_SQL} SELECT {KSQL}, service_id, num_service_days FROM timed3")
def q_service_days(spark, sf):
    t = features.add_time_features(SI.delays(spark, sf))
    return t.select(*KEYS, "service_id", "num_service_days")


@query("clip", f"""{W_EV} SELECT event_id, {O.clip('delay_minutes', 10.0, 100.0)} AS clipped
  FROM events_delay""")
def q_clip(spark, sf):
    e = SI.events_delay(spark, sf)
    return e.select("event_id", scalars.clip("delay_minutes", 10.0, 100.0).alias("clipped"))

# ----------------------------------------------------------------- joins


@query("attach_group_attr", f"""{W_DELAYS} SELECT {KSQL}, route_id, p_on_time FROM delays""")
def q_attach_group_attr(spark, sf):
    sched = SI.schedule(spark, sf)
    attrs = denorm.group_attribute_table(
        sched, "route_id", ("p_on_time", draws.uniform_by("route_id", augment.ROUTE_SEED,
                                                          *augment.ON_TIME_P_RANGE)))
    return denorm.attach_group_attr(sched, attrs, "route_id").select(*KEYS, "route_id", "p_on_time")


@query("star_orphans")  # oracle SQL set with the star twins below
def q_star_orphans(spark, sf):
    # parents with holes: odd trips and three of four route types only
    s = _star(spark, sf)
    s["trips"] = s["trips"].where("direction_id = 1")
    s["routes"] = s["routes"].where("route_type <> 0")
    return star.orphan_counts(s)

# ------------------------------------------------------------ aggregates


def _profile_sql(cols, prefix: str | None = None, src: str = "delays"):
    aggs = ", ".join(f"COUNT({c}) AS c_{c}, COUNT(DISTINCT {c}) AS d_{c}" for c in cols)
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", n - c_{c} AS null_count, "
        f"round(CAST(100 AS DOUBLE) * (n - c_{c}) / n, 2) AS null_pct, "
        f"d_{c} + CASE WHEN n - c_{c} > 0 THEN 1 ELSE 0 END AS distinct_count FROM a"
        for c in cols)
    head = f"{prefix}, " if prefix else "WITH "
    return f"{head}a AS (SELECT COUNT(*) AS n, {aggs} FROM {src}) {rows}"


@query("profile_columns", _profile_sql(O.DELAY_COLS, W_DELAYS))
def q_profile_columns(spark, sf):
    return profile.profile_columns(SI.delays(spark, sf))


@query("profile_columns_auto",
       f"SELECT *, TRUE AS distinct_exact FROM ({_profile_sql(O.DELAY_COLS, W_DELAYS)}) p")
def q_profile_columns_auto(spark, sf):
    return profile.profile_columns_auto(SI.delays(spark, sf), exact_columns=O.DELAY_COLS)


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("profile_lineitem", _profile_sql(LINEITEM_COLS, src="lineitem"))
def q_profile_lineitem(spark, sf):
    return profile.profile_columns(SI.table(spark, sf, "lineitem"))


EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
SQL["profile_events"] = _profile_sql(EVENT_COLS, src="events")


@query("profile_events")
def q_profile_events(spark, sf):
    # a raw given table, timestamp and JSON text columns included
    return profile.profile_columns(SI.table(spark, sf, "events"))


@query("profile_columns_approx", f"""SELECT "column", null_count, null_pct, TRUE AS distinct_near
FROM ({_profile_sql(O.DELAY_COLS, W_DELAYS)}) p""")
def q_profile_columns_approx(spark, sf):
    # estimates within four standard errors of the exact counts
    d = SI.delays(spark, sf)
    exact = profile.profile_columns(d).select("column", F.col("distinct_count").alias("exact"))
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= F.lit(0.04) * F.col("exact") + 1
    return (profile.profile_columns(d, approx=True).join(exact, "column")
            .select("column", "null_count", "null_pct", near.alias("distinct_near")))


@query("describe_numeric", f"""{W_DELAYS} SELECT COUNT(delay_minutes) AS count,
  {r('AVG(delay_minutes)', 'mean')}, {r('STDDEV_SAMP(delay_minutes)', 'stddev')},
  MIN(delay_minutes) AS min, MAX(delay_minutes) AS max FROM delays""")
def q_describe_numeric(spark, sf):
    return rounded(profile.describe_numeric(SI.delays(spark, sf), "delay_minutes"))


MOMENTS_SQL = f"""{W_DELAYS},
m AS (SELECT AVG(delay_minutes) AS mu FROM delays),
c AS (SELECT AVG(POWER(delay_minutes - mu, 2)) AS m2, AVG(POWER(delay_minutes - mu, 3)) AS m3,
             AVG(POWER(delay_minutes - mu, 4)) AS m4 FROM delays, m)
SELECT {r('(SELECT AVG(delay_minutes) FROM delays)', 'mean')},
       {r('(SELECT quantile_cont(delay_minutes, 0.5) FROM delays)', 'median')},
       {r('(SELECT STDDEV_SAMP(delay_minutes) FROM delays)', 'stddev')},
       {r('m3 / POWER(m2, 1.5)', 'skewness')}, {r('m4 / (m2 * m2) - 3', 'kurtosis')},
       (SELECT MIN(delay_minutes) FROM delays) AS min, (SELECT MAX(delay_minutes) FROM delays) AS max
FROM c"""


@query("moments", MOMENTS_SQL)
def q_moments(spark, sf):
    return rounded(profile.moments(SI.delay_table(spark, sf, "delay_minutes"), "delay_minutes", median="exact"))


@query("moments_events", MOMENTS_SQL.replace(W_DELAYS, W_EV).replace("delays", "events_delay"))
def q_moments_events(spark, sf):
    return rounded(profile.moments(SI.events_delay(spark, sf), "delay_minutes", median="exact"))


@query("median_exact", f"""{W_DELAYS} SELECT {r('quantile_cont(delay_minutes, 0.5)', 'median')},
  COUNT(delay_minutes) AS n FROM delays""")
def q_median_exact(spark, sf):
    d = SI.delay_table(spark, sf, "delay_minutes")
    med = quantiles.exact_quantiles(d, "delay_minutes", [0.5])[0]
    return rounded(d.agg(F.lit(med).cast("double").alias("median"),
                         F.count("delay_minutes").alias("n")))


@query("profile_merged", f"""SELECT "column", null_count, null_pct, TRUE AS distinct_near
FROM ({_profile_sql(O.DELAY_COLS, W_DELAYS)}) p""")
def q_profile_merged(spark, sf):
    """The profile from the stored states of four batches, against the exact
    counts (within four standard errors); no rows are read for it."""
    d, saved = _with_states(spark, sf)
    exact = profile.profile_columns(d).select("column", F.col("distinct_count").alias("exact"))
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= F.lit(0.04) * F.col("exact") + 1
    return (states.profile_of(saved).join(exact, "column")
            .select("column", "null_count", "null_pct", near.alias("distinct_near")))


@query("quartiles_merged", f"""{W_DELAYS} SELECT {r('quantile_cont(delay_minutes, 0.25)', 'q1')},
  {r('quantile_cont(delay_minutes, 0.5)', 'median')}, {r('quantile_cont(delay_minutes, 0.75)', 'q3')},
  quantile_disc(delay_minutes, 0.9) AS p90, COUNT(delay_minutes) AS n, TRUE AS two_passes FROM delays""")
def q_quartiles_merged(spark, sf):
    """Exact quartiles from merged states: one counting pass, and the reading
    of the few rows in the open ranges."""
    d, saved = _with_states(spark, sf)
    passes: dict = {}
    q1, mid, q3 = quantiles.quantiles_from_states(d, saved, "delay_minutes", [0.25, 0.5, 0.75], stats=passes)
    p90 = quantiles.quantiles_from_states(d, saved, "delay_minutes", [0.9], discrete=True)[0]
    n = states.merged(saved.where("column = 'delay_minutes'")).select("n_numbers").scalar()
    return rounded(spark.range(1).select(
        F.lit(q1).alias("q1"), F.lit(mid).alias("median"), F.lit(q3).alias("q3"), F.lit(p90).alias("p90"), n.alias("n"),
        F.lit(passes["passes"] <= 2).alias("two_passes")))


def _with_states(spark, sf):
    """The delays table and the states that its four batches left."""
    from tablework.plans import batch
    d = batch.write_delays(spark, SI.schedule(spark, sf), shared_scratch(spark, "delays"))
    path = shared_scratch(spark, "states")
    for k in range(4):
        part = d.where(F.pmod(F.xxhash64("trip_id"), F.lit(4)) == k)
        saved = states.append_state(part, path, f"batch-{k}", quantile_columns=["delay_minutes"])
    return d, saved


def _rank_near(df, col: str, value, share: float, error: float):
    """Whether a value's rank lies within ``error`` of a share of the rows."""
    x, n = F.col(col), F.count(col)
    return ((F.count_if(x < value) <= (share + error) * n) & (F.count_if(x <= value) >= (share - error) * n))


@query("median_approx", f"""{W_DELAYS} SELECT COUNT(delay_minutes) AS n, TRUE AS rank_near FROM delays""")
def q_median_approx(spark, sf):
    d = SI.delay_table(spark, sf, "delay_minutes")
    med = profile.moments(d, "delay_minutes", median="approx").select("median").scalar()
    return d.agg(F.count("delay_minutes").alias("n"),
                 _rank_near(d, "delay_minutes", med, 0.5, 1e-4).alias("rank_near"))


@query("quartiles_exact", f"""{W_DELAYS} SELECT {r('quantile_cont(delay_minutes, 0.25)', 'q1')},
  {r('quantile_cont(delay_minutes, 0.75)', 'q3')}, COUNT(delay_minutes) AS n FROM delays""")
def q_quartiles_exact(spark, sf):
    d = SI.delay_table(spark, sf, "delay_minutes")
    q1, q3 = profile.quartiles(d, "delay_minutes", "exact")
    return rounded(d.agg(F.lit(q1).cast("double").alias("q1"), F.lit(q3).cast("double").alias("q3"),
                         F.count("delay_minutes").alias("n")))


@query("quartiles_disc", f"""{W_DELAYS} SELECT quantile_disc(delay_minutes, 0.25) AS q1,
  quantile_disc(delay_minutes, 0.75) AS q3, COUNT(delay_minutes) AS n FROM delays""")
def q_quartiles_disc(spark, sf):
    d = SI.delay_table(spark, sf, "delay_minutes")
    q1, q3 = profile.quartiles(d, "delay_minutes", "exact_disc")
    return d.agg(F.lit(q1).cast("double").alias("q1"), F.lit(q3).cast("double").alias("q3"),
                 F.count("delay_minutes").alias("n"))


@query("quartiles_approx", f"""{W_DELAYS} SELECT COUNT(delay_minutes) AS n, TRUE AS q1_near, TRUE AS q3_near
FROM delays""")
def q_quartiles_approx(spark, sf):
    d = SI.delay_table(spark, sf, "delay_minutes")
    q1, q3 = profile.quartiles(d, "delay_minutes", "approx", 0.01)
    return d.agg(F.count("delay_minutes").alias("n"),
                 _rank_near(d, "delay_minutes", F.lit(q1), 0.25, 0.01).alias("q1_near"),
                 _rank_near(d, "delay_minutes", F.lit(q3), 0.75, 0.01).alias("q3_near"))


@query("quartiles_price", f"""SELECT {r('quantile_cont(l_extendedprice, 0.25)', 'q1')},
  {r('quantile_cont(l_extendedprice, 0.75)', 'q3')}, quantile_disc(l_orderkey, 0.5) AS key_median,
  COUNT(*) AS n FROM lineitem""")
def q_quartiles_price(spark, sf):
    # given columns: a double, and a bigint kept exact
    li = SI.table(spark, sf, "lineitem")
    q1, q3 = profile.quartiles(li, "l_extendedprice", "exact")
    mid = quantiles.exact_quantiles(li, "l_orderkey", [0.5], discrete=True)[0]
    return rounded(li.agg(F.lit(q1).alias("q1"), F.lit(q3).alias("q3"), F.lit(mid).cast("bigint").alias("key_median"),
                          F.count(F.lit(1)).alias("n")))


@query("iqr_outliers", f"""{W_DELAYS},
q AS (SELECT quantile_cont(delay_minutes, 0.25) AS q1, quantile_cont(delay_minutes, 0.75) AS q3 FROM delays),
b AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT {r('q1', 'q1')}, {r('q3', 'q3')}, {r('iqr', 'iqr')}, {r('lower', 'lower')}, {r('upper', 'upper')},
       COUNT_IF(delay_minutes < lower OR delay_minutes > upper) AS n_outliers, COUNT(*) AS n_rows,
       round(CAST(100 AS DOUBLE) * COUNT_IF(delay_minutes < lower OR delay_minutes > upper) / COUNT(*), 2)
         AS outlier_pct
FROM delays, b GROUP BY q1, q3, iqr, lower, upper""")
def q_iqr_outliers(spark, sf):
    return rounded(profile.iqr_outliers(SI.delay_table(spark, sf, "delay_minutes"), "delay_minutes", "exact"))


IQR_EVENTS_SQL = SQL["iqr_outliers"].replace(W_DELAYS, W_EV).replace("delays", "events_delay")


@query("outlier_rows", f"""{W_DELAYS}, q AS (SELECT quantile_cont(delay_minutes, 0.25) AS a, quantile_cont(delay_minutes, 0.75) AS b FROM delays)
SELECT {KSQL}, delay_minutes FROM delays, q WHERE delay_minutes < a - 1.5 * (b - a) OR delay_minutes > b + 1.5 * (b - a)""")
def q_outlier_rows(spark, sf):
    """The rows outside the bounds, as a table."""
    d = SI.delay_table(spark, sf, *KEYS, "delay_minutes")
    bounds = profile.iqr_outliers(d, "delay_minutes").first()
    return profile.outlier_rows(d, "delay_minutes", bounds["lower"], bounds["upper"]).select(*KEYS, "delay_minutes")


@query("iqr_outliers_events", IQR_EVENTS_SQL)
def q_iqr_outliers_events(spark, sf):
    return rounded(profile.iqr_outliers(SI.events_delay(spark, sf), "delay_minutes", "exact"))


@query("group_stats", f"""{W_DELAYS} SELECT route_short_name, COUNT(*) AS num_records,
  {r('AVG(delay_minutes)', 'avg_delay')}, {r('STDDEV_SAMP(delay_minutes)', 'stddev_delay')},
  CAST(SUM(CAST(is_disrupted AS INTEGER)) AS BIGINT) AS num_disrupted
FROM delays GROUP BY route_short_name""")
def q_group_stats(spark, sf):
    return rounded(groups.group_stats(SI.delays(spark, sf)))


@query("group_stats_events", f"""{W_EV} SELECT event_type, COUNT(*) AS num_records,
  {r('AVG(delay_minutes)', 'avg_delay')}, {r('STDDEV_SAMP(delay_minutes)', 'stddev_delay')},
  CAST(SUM(CAST(is_disrupted AS INTEGER)) AS BIGINT) AS num_disrupted
FROM events_delay GROUP BY event_type""")
def q_group_stats_events(spark, sf):
    return rounded(groups.group_stats(SI.events_delay(spark, sf), "event_type"))


@query("topk_groups", f"""{W_DELAYS} SELECT route_short_name, {r('AVG(delay_minutes)', 'avg_delay')},
  COUNT(*) AS n FROM delays GROUP BY route_short_name HAVING COUNT(*) > 100
  ORDER BY AVG(delay_minutes) DESC, route_short_name LIMIT 10""")
def q_topk_groups(spark, sf):
    return rounded(groups.topk_groups(SI.delays(spark, sf), k=10, min_count=100))


@query("topk_routes", f"""{W_DELAYS} SELECT route_id, {r('AVG(delay_minutes)', 'avg_delay')}, COUNT(*) AS n
  FROM delays GROUP BY route_id HAVING COUNT(*) > 40 ORDER BY AVG(delay_minutes) DESC, route_id LIMIT 10""")
def q_topk_routes(spark, sf):
    # some of the groups have too few rows, and more than ten pass
    return rounded(groups.topk_groups(SI.delays(spark, sf), "route_id", k=10, min_count=40))


@query("value_share", f"""{W_DELAYS} SELECT is_disrupted, COUNT(*) AS n,
  {r('CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM delays)', 'share')}
FROM delays GROUP BY is_disrupted""")
def q_value_share(spark, sf):
    return rounded(groups.value_share(SI.delays(spark, sf), "is_disrupted"))


@query("value_share_reason", f"""{W_DELAYS} SELECT disruption_reason, COUNT(*) AS n,
  {r('CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM delays)', 'share')}
FROM delays GROUP BY disruption_reason""")
def q_value_share_reason(spark, sf):
    return rounded(groups.value_share(SI.delays(spark, sf), "disruption_reason"))


@query("value_share_events", f"""{W_EV} SELECT event_type, COUNT(*) AS n,
  {r('CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM events_delay)', 'share')}
FROM events_delay GROUP BY event_type""")
def q_value_share_events(spark, sf):
    return rounded(groups.value_share(SI.events_delay(spark, sf), "event_type"))


@query("on_time_rate", f"""{W_DELAYS},
a AS (SELECT COUNT(*) AS n_rows, COUNT_IF(NOT is_disrupted) AS n_on_time FROM delays)
SELECT n_rows, n_on_time, round(CAST(100 AS DOUBLE) * n_on_time / n_rows, 4) AS pct_on_time,
       CAST(80 AS DOUBLE) AS target_pct,
       abs(round(CAST(100 AS DOUBLE) * n_on_time / n_rows, 4) - 80) <= 5 AS within_tolerance
FROM a""")
def q_on_time_rate(spark, sf):
    return augment.on_time_rate(SI.delays(spark, sf))


@query("distinct_keys", f"{W_DELAYS} SELECT DISTINCT route_id, route_short_name FROM delays")
def q_distinct_keys(spark, sf):
    return groups.distinct_keys(SI.delays(spark, sf), ["route_id", "route_short_name"])

# ------------------------------------------------------------ augmentation

EV_K = ("event_id",)
_S = augment.EVENT_SEED


@query("augment_group_uniform", f"""{W_EV} SELECT event_id, route_id,
  {O.uniform(augment.ROUTE_SEED, *augment.ON_TIME_P_RANGE, 'route_id')} AS p_on_time FROM events_delay""")
def q_augment_group_uniform(spark, sf):
    e = augment.add_group_uniform(SI.events_delay(spark, sf), "route_id")
    return e.select("event_id", "route_id", "p_on_time")


EV_P = f"""{W_EV},
ep AS (SELECT *, {O.uniform(augment.ROUTE_SEED, *augment.ON_TIME_P_RANGE, 'route_id')} AS p_on_time
       FROM events_delay)"""


@query("augment_flag", f"""{EV_P} SELECT event_id, p_on_time,
  {O.u('flag', _S, 'event_id')} > p_on_time AS is_disrupted FROM ep""")
def q_augment_flag(spark, sf):
    e = augment.add_group_uniform(SI.events_delay(spark, sf), "route_id")
    return e.select("event_id", "p_on_time",
                    draws.flag_by("event_id", _S, F.col("p_on_time")).alias("is_disrupted"))


@query("augment_normal", f"""{W_EV} SELECT event_id,
  {r(O.normal(_S + 1, *augment.ON_TIME_NORMAL, 'event_id'), 'z')} FROM events_delay""")
def q_augment_normal(spark, sf):
    e = SI.events_delay(spark, sf)
    return rounded(e.select("event_id", draws.normal_by("event_id", _S + 1,
                                                        *augment.ON_TIME_NORMAL).alias("z")))


@query("augment_exponential", f"""{W_EV} SELECT event_id,
  {r(O.exponential(_S + 3, *augment.DISRUPTED_SHIFT_SCALE, 'event_id'), 'x')} FROM events_delay""")
def q_augment_exponential(spark, sf):
    e = SI.events_delay(spark, sf)
    return rounded(e.select("event_id", draws.exponential_by(
        "event_id", _S + 3, *augment.DISRUPTED_SHIFT_SCALE).alias("x")))


@query("augment_choice", f"""{W_EV} SELECT event_id,
  {O.choice(_S + 4, augment.DISRUPTION_REASONS, 'event_id')} AS reason FROM events_delay""")
def q_augment_choice(spark, sf):
    e = SI.events_delay(spark, sf)
    return e.select("event_id", draws.choice_by("event_id", _S + 4,
                                                augment.DISRUPTION_REASONS).alias("reason"))


@query("augment_delay", f"""{EV_P},
ef AS (SELECT *, {O.u('flag', _S, 'event_id')} > p_on_time AS flag FROM ep)
SELECT event_id, flag AS is_disrupted,
  round(CASE WHEN flag THEN {O.exponential(_S + 3, *augment.DISRUPTED_SHIFT_SCALE, 'event_id')}
        ELSE {O.clip(O.normal(_S + 1, *augment.ON_TIME_NORMAL, 'event_id'), *augment.ON_TIME_CLIP)}
        END, 2) + CAST(0 AS DOUBLE) AS delay_minutes,
  CASE WHEN flag THEN {O.choice(_S + 4, augment.DISRUPTION_REASONS, 'event_id')} END AS disruption_reason
FROM ef""")
def q_augment_delay(spark, sf):
    e = SI.events_delay(spark, sf).drop("is_disrupted", "delay_minutes")
    e = augment.add_delay(augment.add_group_uniform(e, "route_id"), keys=EV_K)
    return e.select("event_id", "is_disrupted", "delay_minutes", "disruption_reason")

# ------------------------------------------------------- sampling, splits


@query("sample_hash", f"""{W_DELAYS} SELECT {KSQL}, delay_minutes FROM delays
  WHERE {O.u('sample', 42, *KEYS)} < {O.d(0.05)}""")
def q_sample_hash(spark, sf):
    return sampling.sample_hash(SI.delays(spark, sf), KEYS, 0.05, 42).select(*KEYS, "delay_minutes")


@query("sample_native", f"""{W_DELAYS} SELECT COUNT(*) AS n_rows, TRUE AS size_near, TRUE AS all_given FROM delays""")
def q_sample_native(spark, sf):
    # size within four standard errors, and every row one of the table's
    d = SI.delays(spark, sf).select(*KEYS, "delay_minutes")
    s = sampling.sample_native(d, 0.05, 42)
    size = s.agg(F.count(F.lit(1)).alias("c")).scalar()
    foreign = s.exceptAll(d).agg(F.count(F.lit(1)).alias("c")).scalar()
    n = F.count(F.lit(1))
    return d.agg(n.alias("n_rows"), (F.abs(size - 0.05 * n) <= 4 * F.sqrt(n * 0.05 * 0.95)).alias("size_near"),
                 (foreign == 0).alias("all_given"))


@query("split_hash", f"""{W_DELAYS} SELECT {KSQL},
  CASE WHEN {O.u('split', 42, *KEYS)} < {O.d(0.8)} THEN 0 ELSE 1 END AS split FROM delays""")
def q_split_hash(spark, sf):
    d = SI.delays(spark, sf)
    return d.select(*KEYS, sampling.split_column(KEYS, (0.8, 0.2), 42).alias("split"))


@query("sample_then_split", f"""{W_DELAYS},
s AS (SELECT *, CASE WHEN {O.u('split', 42, *KEYS)} < {O.d(0.8)} THEN 0 ELSE 1 END AS split
      FROM delays WHERE {O.u('sample', 42, *KEYS)} < {O.d(0.25)})
SELECT split, COUNT(*) AS n, (SELECT COUNT_IF(split = 1) * 1.0 / COUNT(*) BETWEEN 0.17 AND 0.23 FROM s) AS near_a_fifth
FROM s GROUP BY split""")
def q_sample_then_split(spark, sf):
    # one seed for both: the draws are independent all the same
    s = sampling.sample_hash(SI.delays(spark, sf), KEYS, 0.25, 42) \
        .withColumn("split", sampling.split_column(KEYS, (0.8, 0.2), 42))
    counts = s.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    share = s.agg((F.count_if(F.col("split") == 1) / F.count(F.lit(1))).between(0.17, 0.23).alias("b")).scalar()
    return counts.select("split", "n", share.alias("near_a_fifth"))


@query("split_native", f"""{W_DELAYS} SELECT COUNT(*) AS n_rows, TRUE AS size_near, TRUE AS complete,
  TRUE AS disjoint FROM delays""")
def q_split_native(spark, sf):
    # a fifth within four standard errors; together every row once
    d = SI.delays(spark, sf).select(*KEYS)
    train, test = sampling.split_native(d, (0.8, 0.2), 42)

    def size(df):
        return df.agg(F.count(F.lit(1)).alias("c")).scalar()

    n, both = F.count(F.lit(1)), train.unionAll(test)
    return d.agg(n.alias("n_rows"), (F.abs(size(test) - 0.2 * n) <= 4 * F.sqrt(n * 0.2 * 0.8)).alias("size_near"),
                 (size(d.exceptAll(both)) == 0).alias("complete"), (size(both.exceptAll(d)) == 0).alias("disjoint"))

# -------------------------------------------------------------- shapes


HISTOGRAM_SQL = f"""
edges AS (SELECT CAST(k.range AS INTEGER) AS bin, mn, w, mn + k.range * w AS bin_lo, mn + (k.range + 1) * w AS bin_hi
          FROM range(50) k, (SELECT MIN(delay_minutes) AS mn, (MAX(delay_minutes) - MIN(delay_minutes)) / 50.0 AS w FROM src))
SELECT bin, {r('bin_lo', 'bin_lo')}, {r('bin_hi', 'bin_hi')},
       (SELECT COUNT(*) FROM src s WHERE floor((s.delay_minutes - mn) / w) = bin
           OR (bin = 49 AND floor((s.delay_minutes - mn) / w) > 49)) AS n
FROM edges"""


@query("histogram", f"{W_DELAYS}, src AS (SELECT delay_minutes FROM delays), {HISTOGRAM_SQL}")
def q_histogram(spark, sf):
    return rounded(shapes.histogram(SI.delay_table(spark, sf, "delay_minutes"), "delay_minutes", 50))


@query("histogram_events", f"{W_EV}, src AS (SELECT delay_minutes FROM events_delay), {HISTOGRAM_SQL}")
def q_histogram_events(spark, sf):
    return rounded(shapes.histogram(SI.events_delay(spark, sf), "delay_minutes", 50))


@query("density_curve", f"""{W_DELAYS},
s AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, STDDEV_SAMP(delay_minutes) AS sd,
             MIN(delay_minutes) AS mn, MAX(delay_minutes) AS mx FROM delays WHERE delay_minutes IS NOT NULL),
k AS (SELECT n, sd * POWER(n, -0.2) AS h, mn, mx FROM s),
g AS (SELECT k.*, mn - 3.0 * h AS lo, (mx + 3.0 * h - (mn - 3.0 * h)) / 199.0 AS step FROM k),
c AS (SELECT delay_minutes AS x, COUNT(*) AS c FROM delays WHERE delay_minutes IS NOT NULL GROUP BY 1),
p AS (SELECT range AS point FROM range(200))
SELECT point, {r('lo + point * step', 'x')},
  {r(f'SUM(c * exp(-0.5 * POWER((lo + point * step - x) / h, 2))) * {O.d(1 / (2 * 3.141592653589793) ** 0.5)} / (n * h)', 'density')}
FROM p, g, c GROUP BY point, lo, step, n, h""")
def q_density_curve(spark, sf):
    return rounded(shapes.density_curve(SI.delay_table(spark, sf, "delay_minutes"), "delay_minutes", 200, 3.0, grid_bins=None))


@query("density_grid", """SELECT CAST(range AS INTEGER) AS point, TRUE AS near FROM range(200)""")
def q_density_grid(spark, sf):
    # the default path against the exact sum, within the stated error
    e = SI.events_delay(spark, sf)
    exact = shapes.density_curve(e, "delay_minutes", grid_bins=None).select("point", F.col("density").alias("exact"))
    st = e.agg(F.struct(F.stddev("delay_minutes").alias("sd"), F.count("delay_minutes").alias("n"),
                        (F.max("delay_minutes") - F.min("delay_minutes")).alias("span")).alias("s")).scalar()
    h = st["sd"] * F.pow(st["n"].cast("double"), F.lit(-0.2))
    allowed = st["span"] / 4096 / 2 * 0.25 / (h * h)
    return (shapes.density_curve(e, "delay_minutes").join(exact, "point")
            .select("point", (F.abs(F.col("density") - F.col("exact")) <= allowed).alias("near")))

# ----------------------------------------------------- star and reports


def _star(spark, sf):
    """The star, written once and read again."""
    d = SI.delay_table(spark, sf, *dict.fromkeys([*star.ROUTE_COLS, *star.TRIP_COLS, *star.EVENT_COLS]))
    paths = feeds.write_star(star.build_star(d, id_mode="hash"), shared_scratch(spark, "star"))
    return {name: feeds.read_table(spark, path) for name, path in paths.items()}


STAR_SQL = f"""{FACT_SQL},
dim_routes AS (SELECT route_id, min(struct_pack(route_short_name, agency_id, route_type)) AS s
               FROM delays WHERE route_id IS NOT NULL GROUP BY route_id),
dim_trips AS (SELECT trip_id, min(struct_pack(route_id, service_id, trip_headsign, direction_id)) AS s
              FROM delays WHERE trip_id IS NOT NULL GROUP BY trip_id)"""


SQL["star_orphans"] = f"""{STAR_SQL}
SELECT (SELECT COUNT(*) FROM fact e WHERE NOT EXISTS
          (SELECT 1 FROM dim_trips t WHERE t.trip_id = e.trip_id AND t.s.direction_id = 1)) AS orphan_events,
       (SELECT COUNT(*) FROM dim_trips t WHERE t.s.direction_id = 1 AND NOT EXISTS
          (SELECT 1 FROM dim_routes r WHERE r.route_id = t.s.route_id AND r.s.route_type <> 0)) AS orphan_trips"""


@query("dim_routes", f"""{STAR_SQL} SELECT route_id, s.route_short_name AS route_short_name,
  s.agency_id AS agency_id, s.route_type AS route_type FROM dim_routes""")
def q_dim_routes(spark, sf):
    return star.dim_routes(SI.delays(spark, sf))


@query("dim_trips", f"""{STAR_SQL} SELECT trip_id, s.route_id AS route_id, s.service_id AS service_id,
  s.trip_headsign AS trip_headsign, s.direction_id AS direction_id FROM dim_trips""")
def q_dim_trips(spark, sf):
    return star.dim_trips(SI.delays(spark, sf))


@query("fact_events", f"{FACT_SQL} SELECT * FROM fact")
def q_fact_events(spark, sf):
    return star.fact_events(SI.delays(spark, sf), id_mode="hash")


NAMED_SQL = f"""{STAR_SQL},
named AS (SELECT r.s.route_short_name AS route_short_name, e.delay_minutes AS minutes
          FROM dim_routes r, dim_trips t, fact e WHERE t.s.route_id = r.route_id AND e.trip_id = t.trip_id),
means AS (SELECT route_short_name, SUM(minutes) / COUNT(minutes) AS mean, COUNT(*) AS n FROM named GROUP BY ALL)"""


@query("event_ids_unique", f"""{FACT_SQL} SELECT COUNT(*) AS n_events, COUNT(DISTINCT event_id) AS n_ids,
  TRUE AS unique_mode FROM fact""")
def q_event_ids_unique(spark, sf):
    d = SI.delays(spark, sf)
    other = star.fact_events(d, id_mode="unique").agg(
        (F.count(F.lit(1)) == F.count_distinct("event_id")).alias("u")).scalar()
    return star.fact_events(d, id_mode="hash").agg(F.count(F.lit(1)).alias("n_events"),
                                                   F.count_distinct("event_id").alias("n_ids")) \
        .select("n_events", "n_ids", other.alias("unique_mode"))


@query("event_ids_dense", f"""{W_DELAYS}
SELECT ROW_NUMBER() OVER (ORDER BY {", ".join(f"{c} NULLS FIRST" for c in [*KEYS, *[c for c in star.EVENT_COLS if c not in KEYS]])}) AS event_id,
       trip_id, stop_id, stop_sequence, arrival_time, delay_minutes, CAST(is_disrupted AS INTEGER) AS is_disrupted, disruption_reason
FROM delays""")
def q_event_ids_dense(spark, sf):
    """Ids 1 .. n as an autoincrement gives, from the order of the rows."""
    return star.fact_events(SI.delays(spark, sf), id_mode="dense")


@query("param_having", f"""{NAMED_SQL}
SELECT route_short_name, {r('mean', 'avg_delay')}, n FROM means WHERE mean > 3.0
ORDER BY mean DESC, route_short_name LIMIT 2""")
def q_param_having(spark, sf):
    return rounded(reports.routes_over_threshold(spark, _star(spark, sf), threshold=3.0, k=2))


@query("param_having_all", f"""{NAMED_SQL}
SELECT route_short_name, {r('mean', 'avg_delay')}, n FROM means WHERE mean > 4.0""")
def q_param_having_all(spark, sf):
    return rounded(reports.routes_over_threshold(spark, _star(spark, sf), threshold=4.0, k=10))


@query("batch_star_events", f"""{FACT_SQL} SELECT trip_id, stop_id, stop_sequence, arrival_time,
  delay_minutes, is_disrupted, disruption_reason FROM fact""")
def q_batch_star_events(spark, sf):
    # Star written by the batch stage: unique ids, range-clustered and salted
    # fact; ids are checked for uniqueness in tests, the rest against SQL.
    from tablework.plans import batch
    s = batch.write_star_tables(SI.delays(spark, sf), shared_scratch(spark, "star"))
    return s["delay_events"].drop("event_id")


@query("param_having_bucketed", SQL["param_having_all"])
def q_param_having_bucketed(spark, sf):
    # Same report over catalog tables bucketed on trip_id (events and trips
    # co-partitioned: the event-trip join reads them without a shuffle).
    import uuid
    database = f"tw_star_{uuid.uuid4().hex[:10]}"
    names = feeds.write_star_catalog(_star(spark, sf), database, buckets=8)
    s = {k: spark.table(v) for k, v in names.items()}
    out = feeds.write_table(rounded(reports.routes_over_threshold(spark, s, threshold=4.0, k=10)),
                            shared_scratch(spark, "report"))
    feeds.drop_star_catalog(spark, database)
    return feeds.read_table(spark, out)


@query("param_filter", f"""{STAR_SQL}
SELECT e.trip_id, e.stop_id, e.delay_minutes, e.disruption_reason
FROM fact e JOIN dim_trips t ON e.trip_id = t.trip_id
WHERE t.s.route_id = (SELECT min(route_id) FROM dim_routes) AND e.is_disrupted = 1""")
def q_param_filter(spark, sf):
    s = _star(spark, sf)
    route = reports.sample_route(s).first()["route_id"]
    return reports.disrupted_events_for_route(spark, s, route)


@query("param_filter_limited", SQL["param_filter"] + " ORDER BY e.trip_id, e.stop_id, e.delay_minutes LIMIT 10")
def q_param_filter_limited(spark, sf):
    s = _star(spark, sf)
    route = reports.sample_route(s).first()["route_id"]
    return reports.disrupted_events_for_route(spark, s, route, limit=10)


@query("param_injection", f"""{STAR_SQL}
SELECT e.trip_id, e.stop_id, e.delay_minutes, e.disruption_reason
FROM fact e JOIN dim_trips t ON e.trip_id = t.trip_id
WHERE t.s.route_id = 'x'' OR 1=1 --' AND e.is_disrupted = 1""")
def q_param_injection(spark, sf):
    return reports.disrupted_events_for_route(spark, _star(spark, sf), "x' OR 1=1 --")


@query("on_time_share", f"""{FACT_SQL}
SELECT {r('CAST(100 AS DOUBLE) * COUNT_IF(delay_minutes BETWEEN -1.0 AND 5.99) / COUNT(*)', 'pct_on_time')}
FROM fact""")
def q_on_time_share(spark, sf):
    return rounded(reports.on_time_share(spark, _star(spark, sf), -1.0, 5.99))


@query("pruned_lookup", f"{FACT_SQL} SELECT * FROM fact WHERE trip_id = '7'")
def q_pruned_lookup(spark, sf):
    path = shared_scratch(spark, "events_by_trip")
    fact = star.fact_events(SI.delays(spark, sf), id_mode="hash")
    feeds.write_table(star.clustered(fact, ["trip_id", "stop_sequence"]), path)
    return feeds.read_table(spark, path).where(F.col("trip_id") == F.lit("7"))



def _looked_up(spark, sf, column: str, value: str):
    """Rows of one value from the one fact that serves lookups on trip, stop
    and route, and whether at most a quarter of its files hold the value (the
    others are left out by their bounds or Bloom filter; a test counts the
    rows that the scan lets through)."""
    events = star.events_with_route(_star(spark, sf))
    path = star.write_lookup_fact(events, shared_scratch(spark, "lookup"), files=128)
    fact = feeds.read_table(spark, path, schema=events.schema)
    files = fact.groupBy(F.input_file_name().alias("f")).agg(F.count_if(F.col(column) == value).alias("n"))
    few = files.agg((F.count_if(F.col("n") > 0) * 4 <= F.count(F.lit(1))).alias("b")).scalar()
    return star.lookup(fact, column, value).withColumn("few_files", few)


LOOKUP_SQL = f"""{STAR_SQL} SELECT e.*, t.s.route_id AS route_id, TRUE AS few_files
FROM fact e LEFT JOIN dim_trips t ON e.trip_id = t.trip_id"""


@query("pruned_lookup_trip", f"{LOOKUP_SQL} WHERE e.trip_id = '7'")
def q_pruned_lookup_trip(spark, sf):
    return _looked_up(spark, sf, "trip_id", "7")


@query("pruned_lookup_stop", f"{LOOKUP_SQL} WHERE e.stop_id = '77'")
def q_pruned_lookup_stop(spark, sf):
    return _looked_up(spark, sf, "stop_id", "77")


@query("pruned_lookup_route", f"{LOOKUP_SQL} WHERE t.s.route_id = '77'")
def q_pruned_lookup_route(spark, sf):
    return _looked_up(spark, sf, "route_id", "77")

# ------------------------------------------------------ features, models

def index_sql(prefix: str, src: str) -> str:
    """Indexer twin: rank by count desc then value; null/unseen -> #labels."""
    return f"""{prefix},
ri AS (SELECT route_id, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, route_id) - 1 AS route_id_idx
       FROM {src} WHERE route_id IS NOT NULL GROUP BY route_id),
ai AS (SELECT agency_id, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, agency_id) - 1 AS agency_id_idx
       FROM {src} WHERE agency_id IS NOT NULL GROUP BY agency_id),
idx AS (SELECT d.*, CAST(COALESCE(ri.route_id_idx, (SELECT COUNT(*) FROM ri)) AS DOUBLE) AS route_id_idx,
               CAST(COALESCE(ai.agency_id_idx, (SELECT COUNT(*) FROM ai)) AS DOUBLE) AS agency_id_idx
        FROM {src} d LEFT JOIN ri ON d.route_id = ri.route_id LEFT JOIN ai ON d.agency_id = ai.agency_id)"""


INDEX_SQL = index_sql(W_DELAYS, "delays")


@query("index_categories", f"""{INDEX_SQL} SELECT {KSQL}, route_id, route_id_idx, agency_id,
  agency_id_idx FROM idx""")
def q_index_categories(spark, sf):
    d = features.index_categories(SI.delay_table(spark, sf, *KEYS, "route_id", "agency_id"))
    return d.select(*KEYS, "route_id", "route_id_idx", "agency_id", "agency_id_idx")


@query("index_trips", """WITH seen AS (SELECT CAST(l_orderkey AS VARCHAR) AS trip_id FROM lineitem WHERE l_linenumber <= 2),
labels AS (SELECT trip_id, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, trip_id) - 1 AS idx FROM seen GROUP BY trip_id)
SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(COALESCE(idx, (SELECT COUNT(*) FROM labels)) AS DOUBLE) AS trip_id_idx
FROM orders LEFT JOIN labels ON CAST(o_orderkey AS VARCHAR) = trip_id""")
def q_index_trips(spark, sf):
    """A column with one value per trip, fitted on the first stops of each
    trip; trips without any get the last index."""
    first = SI.stop_times(spark, sf).where("stop_sequence <= 2")
    return features.index_categories(SI.trips(spark, sf).select("trip_id"), ["trip_id"], fit_on=first)


PREPARED_SQL = index_sql(f"{TIME_SQL}, prepared AS (SELECT * FROM timed3 WHERE delay_minutes IS NOT NULL)",
                         "prepared")
ASSEMBLE_SQL = PREPARED_SQL + f""",
feat AS (SELECT {KSQL}, CAST(arrival_hour_mod AS DOUBLE) AS f_arrival_hour_mod,
                CAST(is_peak AS DOUBLE) AS f_is_peak, CAST(stop_sequence AS DOUBLE) AS f_stop_sequence,
                CAST(num_service_days AS DOUBLE) AS f_num_service_days, route_id_idx AS f_route_id_idx,
                agency_id_idx AS f_agency_id_idx, CAST(CAST(is_disrupted AS INTEGER) AS DOUBLE) AS f_is_disrupted,
                delay_minutes AS label
         FROM idx WHERE delay_minutes IS NOT NULL AND arrival_hour_mod IS NOT NULL
           AND num_service_days IS NOT NULL AND stop_sequence IS NOT NULL AND is_disrupted IS NOT NULL)"""


@query("assemble_features", f"{ASSEMBLE_SQL} SELECT * FROM feat")
def q_assemble_features(spark, sf):
    from pyspark.ml.functions import vector_to_array
    p = features.prepare(SI.delay_table(spark, sf, *SI.FEATURE_INPUTS))
    p = features.index_categories(p)
    names = features.present_columns(p, features.CANDIDATE_FEATURES)
    a = features.assemble(p, names)
    arr = vector_to_array("features")
    return a.select(*KEYS, *[arr[i].alias(f"f_{n}") for i, n in enumerate(names)],
                    F.col("delay_minutes").alias("label"))


LIN_SQL = f"""{W_DELAYS},
x AS (SELECT {KSQL}, CAST(CAST(is_disrupted AS INTEGER) AS DOUBLE) AS x, delay_minutes AS y
      FROM delays WHERE delay_minutes IS NOT NULL AND is_disrupted IS NOT NULL),
co AS (SELECT regr_intercept(y, x) AS b0, regr_slope(y, x) AS b1 FROM x)"""


def _linear(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    d = SI.delay_table(spark, sf, *KEYS, "is_disrupted", "delay_minutes").where(F.col("delay_minutes").isNotNull() & F.col("is_disrupted").isNotNull())
    d = d.select(*KEYS, F.col("is_disrupted").cast("int").cast("double").alias("x"),
                 F.col("delay_minutes").alias("label"))
    d = VectorAssembler(inputCols=["x"], outputCol="features").transform(d)
    return d, models.fit_linear(d, max_iter=50)


@query("linear_fit", f"""{LIN_SQL} SELECT {r('b0', 'intercept')}, {r('b1', 'slope')},
  {r('(SELECT regr_r2(y, x) FROM x)', 'r2')}, (SELECT COUNT(*) FROM x) AS n FROM co""")
def q_linear_fit(spark, sf):
    d, m = _linear(spark, sf)
    return rounded(d.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(float(m.intercept)).alias("intercept"),
        F.lit(float(m.coefficients[0])).alias("slope"),
        F.lit(float(m.summary.r2)).alias("r2"), "n"))


@query("linear_predict", f"""{LIN_SQL} SELECT {KSQL}, {r('b0 + b1 * x', 'prediction')} FROM x, co""")
def q_linear_predict(spark, sf):
    d, m = _linear(spark, sf)
    return rounded(m.transform(d).select(*KEYS, "prediction"))


@query("regression_metrics", f"""{LIN_SQL},
e AS (SELECT y, y - (b0 + b1 * x) AS err FROM x, co)
SELECT {r('sqrt(AVG(err * err))', 'rmse')}, {r('AVG(abs(err))', 'mae')},
       {r('1 - SUM(err * err) / (VAR_POP(y) * COUNT(*))', 'r2')}, COUNT(*) AS n FROM e""")
def q_regression_metrics(spark, sf):
    d, m = _linear(spark, sf)
    return rounded(models.regression_metrics(m.transform(d)))


FIT_COLS = [f"f_{c}" for c in features.CANDIDATE_FEATURES]
_ONE = ["1", *FIT_COLS]
_CELLS = "[" + ", ".join("[" + ", ".join(f"SUM(CAST({a} AS DOUBLE) * {b})" for b in [*_ONE, "label"]) + "]" for a in _ONE) + "]"


@query("linear_all", f"""WITH RECURSIVE {ASSEMBLE_SQL.strip().removeprefix("WITH ")},
steps AS (SELECT 1 AS k, {_CELLS} AS m FROM feat
  UNION ALL SELECT k + 1, list_transform(range(1, {len(_ONE) + 1}), lambda i: CASE WHEN i = k
      THEN list_transform(m[k], lambda v: v / m[k][k])
      ELSE list_transform(range(1, {len(_ONE) + 2}), lambda j: m[i][j] - m[i][k] * m[k][j] / m[k][k]) END)
  FROM steps WHERE k <= {len(_ONE)})
SELECT unnest([{", ".join(f"'{c}'" for c in ["intercept", *features.CANDIDATE_FEATURES])}]) AS term,
       (round(unnest(list_transform(m, lambda x: x[{len(_ONE) + 1}])), 4) + CAST(0 AS DOUBLE)) AS value, TRUE AS like_mllib
FROM steps WHERE k = {len(_ONE) + 1}""")
def q_linear_all(spark, sf):
    """All seven features, fitted from the merged sums of four batches, next
    to MLlib's fit of the rows."""
    p = features.index_categories(features.prepare(SI.delay_table(spark, sf, *SI.FEATURE_INPUTS)))
    p = p.withColumn("is_peak", F.col("is_peak").cast("double"))
    p = p.select("trip_id", *features.CANDIDATE_FEATURES, "delay_minutes")
    p = feeds.read_table(spark, feeds.write_table(p, shared_scratch(spark, "indexed")))   # four states and a fit pass over it
    parts = [linear_state.linear_state(p.where(F.pmod(F.xxhash64("trip_id"), F.lit(4)) == k),
                                       features.CANDIDATE_FEATURES, "delay_minutes") for k in range(4)]
    union = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    fit = linear_state.solve(union)
    theirs = models.fit_linear(features.assemble(p, features.CANDIDATE_FEATURES).withColumnRenamed("delay_minutes", "label"), tol=1e-12)
    rows = [("intercept", fit["intercept"], float(theirs.intercept))]
    rows += [(c, fit["coefficients"][c], float(b)) for c, b in zip(features.CANDIDATE_FEATURES, theirs.coefficients)]
    table = spark.createDataFrame(rows, "term string, value double, mllib double")
    near = F.abs(F.col("value") - F.col("mllib")) <= 1e-6 * F.greatest(F.lit(1.0), F.abs("mllib"))
    return rounded(table.select("term", "value", near.alias("like_mllib")), 4)


def _tables(spark, sf, **kw):
    """(train, test, names), written once: fits and metrics pass over them
    several times."""
    from tablework.plans import batch
    # with means, the rows are passed over once and written with their draws
    once = kw.get("category_mode") == "mean"
    delays = SI.delays(spark, sf).select(*SI.FEATURE_INPUTS) if once else SI.delay_table(spark, sf, *SI.FEATURE_INPUTS)
    return batch.write_model_tables(spark, delays,
                                    shared_scratch(spark, "model"), tuple(KEYS), **kw)


TEST_SQL = f"""{ASSEMBLE_SQL},
held AS (SELECT label FROM feat WHERE {O.u('split', 42, *KEYS)} >= {O.d(0.8)})"""


#: The published fits: 50 trees of depth 8, 50 rounds of depth 5.
FOREST = {"num_trees": 50, "max_depth": 8}
GBT = {"max_iter": 50, "max_depth": 5}
_FITTED: dict = {}


def _fitted(spark, sf):
    """(train, test, names, comparison, models): the three fits at their full
    parameters on out-of-fold category means, worked out once per session
    and folder for the keys that look at them."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _FITTED:
        train, test, names = _tables(spark, sf, category_mode="mean")
        _FITTED[at] = (train, test, names, *models.compare_models(spark, train, test, forest=FOREST, gbt=GBT, cached=False))
    return _FITTED[at]


def _class_mean_rmse(train, test):
    """RMSE on test of predicting the train mean of each class of the flag,
    the best there is where the label is drawn from the flag alone."""
    from pyspark.ml.functions import vector_to_array
    flag = F.element_at(vector_to_array("features"), -1)
    mean = train.groupBy(flag.alias("flag")).agg(F.avg("label").alias("m"))
    e = F.col("label") - F.col("m")
    return test.withColumn("flag", flag).join(F.broadcast(mean), "flag").agg(F.sqrt(F.avg(e * e)).alias("rmse")).scalar()


def _near(train, test):
    """An error within 2 % of the class means', plus what fifty rounds learn of
    the noise of few rows (640 over the rows trained: 1.6 % at 40,000 rows,
    0.2 % at 400,000); a fit that misses the flag is off by 60 %."""
    return F.col("rmse") <= _class_mean_rmse(train, test) * (1.02 + 640 / max(1, train.count()))


def _scored(model, train, test):
    """Rows scored, and whether the error is near the class means'."""
    m = models.regression_metrics(model.transform(test))
    return m.select("n", _near(train, test).alias("near_class_means"))


@query("linear_no_leak", f"{TEST_SQL} SELECT COUNT(*) AS n, TRUE AS no_signal FROM held")
def q_linear_no_leak(spark, sf):
    # Without is_disrupted (the label is drawn from it) the other features
    # carry no signal: R^2 near 0 is the expected result.
    train, test, _ = _tables(spark, sf, leaky_features=False)
    m = models.regression_metrics(models.fit_linear(train).transform(test))
    return m.select("n", (F.abs("r2") < 0.05).alias("no_signal"))


NEAR_SQL = f"{TEST_SQL} SELECT COUNT(*) AS n, TRUE AS near_class_means FROM held"


@query("forest_fit", NEAR_SQL)
def q_forest_fit(spark, sf):
    train, test, _, _, fitted = _fitted(spark, sf)
    return _scored(fitted["Random Forest"], train, test)


@query("gbt_fit", NEAR_SQL)
def q_gbt_fit(spark, sf):
    train, test, _, _, fitted = _fitted(spark, sf)
    return _scored(fitted["Gradient Boosted Trees"], train, test)


@query("gbt_stopped", f"{TEST_SQL} SELECT COUNT(*) AS n, TRUE AS near_class_means, TRUE AS fewer_rounds FROM held")
def q_gbt_stopped(spark, sf):
    """Boosting that stops on a tenth of the train rows, held out by key."""
    train, test, _ = _tables(spark, sf, category_mode="mean", validation=0.1)
    model = models.fit_gbt(train, **GBT, held_out="held_out")
    return _scored(model, train, test).withColumn("fewer_rounds", F.lit(model.getNumTrees < GBT["max_iter"]))


@query("max_bins", f"""{PREPARED_SQL}
SELECT CAST(COUNT(DISTINCT route_id) + 1 AS INTEGER) AS bins FROM prepared
WHERE {O.u('split', 42, *KEYS)} < {O.d(0.8)}""")
def q_max_bins(spark, sf):
    """Nominal routes: a bin per route of the train split and one for the others."""
    train, _, _ = _tables(spark, sf)
    return spark.range(1).select(F.lit(models.max_bins_for(train)).cast("int").alias("bins"))


MEAN_EXPR = ("(COALESCE(a.s, 0) - CASE WHEN fitted THEN COALESCE(b.s, 0) ELSE 0 END + 20 * p) / "
             "(COALESCE(a.n, 0) - CASE WHEN fitted THEN COALESCE(b.n, 0) ELSE 0 END + 20)")


@query("category_means", f"""{W_DELAYS},
folded AS (SELECT *, CAST(floor({O.u('fold', 42, *KEYS)} * 5) AS INTEGER) AS f, {O.u('split', 42, *KEYS)} < {O.d(0.8)} AS fitted FROM delays),
prior AS (SELECT AVG(delay_minutes) AS p FROM folded WHERE fitted),
sums AS (SELECT route_id, SUM(delay_minutes) AS s, COUNT(delay_minutes) AS n FROM folded WHERE fitted GROUP BY route_id),
parts AS (SELECT route_id, f, SUM(delay_minutes) AS s, COUNT(delay_minutes) AS n FROM folded WHERE fitted GROUP BY route_id, f)
SELECT d.trip_id, d.stop_sequence, d.stop_id, {r(MEAN_EXPR, 'route_id_mean')}
FROM folded d LEFT JOIN sums a ON d.route_id = a.route_id LEFT JOIN parts b ON d.route_id = b.route_id AND d.f = b.f, prior""")
def q_category_means(spark, sf):
    """Out-of-fold means of the routes: train rows without their own fold."""
    from tablework.operators.sampling import split_column
    d = SI.delay_table(spark, sf, *KEYS, "route_id", "delay_minutes").withColumn("split", split_column(KEYS, (0.8, 0.2), 42))
    means = features.fit_means(d.where("split = 0"), KEYS, ["route_id"])
    return rounded(means.transform(d, F.col("split") == 0).select(*KEYS, "route_id_mean"))


@query("pipeline_saved", f"{ASSEMBLE_SQL} SELECT * FROM feat")
def q_pipeline_saved(spark, sf):
    """The fitted pipeline saved, loaded and applied (L2)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    p = features.prepare(SI.delay_table(spark, sf, *SI.FEATURE_INPUTS))
    path = shared_scratch(spark, "feature-pipeline")
    features.feature_stages().fit(p).save(path)
    a = PipelineModel.load(path).transform(p)
    arr = vector_to_array("features")
    return a.select(*KEYS, *[arr[i].alias(f"f_{n}") for i, n in enumerate(features.CANDIDATE_FEATURES)],
                    F.col("delay_minutes").alias("label"))


@query("model_comparison", """SELECT * FROM (VALUES ('Linear Regression', TRUE, TRUE, TRUE), ('Random Forest', TRUE, TRUE, TRUE),
  ('Gradient Boosted Trees', TRUE, TRUE, TRUE)) t(model, near_class_means, mae_below_rmse, timed)""")
def q_model_comparison(spark, sf):
    train, test, _, table, _ = _fitted(spark, sf)
    return table.select("model", _near(train, test).alias("near_class_means"),
                        (F.col("mae") < F.col("rmse")).alias("mae_below_rmse"),
                        ((F.col("train_seconds") > 0) & (F.col("efficiency_score_per_sec") > 0)).alias("timed"))


@query("best_model", "SELECT 'with the flag' AS model, 2 AS n_models")
def q_best_model(spark, sf):
    rows = []
    for name, leaky in (("without the flag", False), ("with the flag", True)):
        train, test, _ = _tables(spark, sf, leaky_features=leaky)
        model, secs = models.timed_fit(models.fit_linear, train)
        rows.append(models.comparison_row(name, models.regression_metrics(model.transform(test)).first(), secs))
    table = models.model_comparison(spark, rows)
    return models.best_model(table).select("model", F.lit(table.count()).cast("int").alias("n_models"))


IMPORTANCE_SQL = "SELECT *, feature = 'is_disrupted' AS is_first FROM (SELECT unnest([" + ", ".join(
    f"'{c.replace('_idx', '_mean')}'" for c in features.CANDIDATE_FEATURES) + """]) AS feature,
  TRUE AS in_range, TRUE AS adds_to_one)"""


def _importance(spark, model, names):
    table = models.feature_importance(spark, model, names)
    total = table.agg(F.sum("importance").alias("s")).scalar()
    most = table.agg(F.max("importance").alias("m")).scalar()
    return table.select("feature", F.col("importance").between(0, 1).alias("in_range"),
                        (F.abs(total - 1) < 1e-9).alias("adds_to_one"), (F.col("importance") == most).alias("is_first"))


@query("feature_importance", IMPORTANCE_SQL)
def q_feature_importance(spark, sf):
    _, _, names, _, fitted = _fitted(spark, sf)
    return _importance(spark, fitted["Random Forest"], names)


@query("feature_importance_gbt", IMPORTANCE_SQL)
def q_feature_importance_gbt(spark, sf):
    _, _, names, _, fitted = _fitted(spark, sf)
    return _importance(spark, fitted["Gradient Boosted Trees"], names)


@query("metrics_csv", "SELECT 'Linear Regression' AS model, TRUE AS beats_mean, TRUE AS timed")
def q_metrics_csv(spark, sf):
    train, test, _ = _tables(spark, sf)
    m, secs = models.timed_fit(models.fit_linear, train)
    row = models.regression_metrics(m.transform(test)).first()
    table = models.model_comparison(spark, [models.comparison_row("Linear Regression", row, secs)])
    path = feeds.write_metrics(table, shared_scratch(spark, "metrics"))
    back = spark.read.option("header", True).schema(schemas.METRICS).csv(path)
    spread = test.agg(F.stddev_pop("label").alias("s")).scalar()
    return back.select("model", (F.col("rmse") < spread).alias("beats_mean"), (F.col("train_seconds") > 0).alias("timed"))


@query("assembler_skipped", f"""{PREPARED_SQL}
SELECT COUNT(*) AS n_rows, COUNT_IF(arrival_hour_mod IS NULL OR is_peak IS NULL OR stop_sequence IS NULL
  OR num_service_days IS NULL OR route_id_idx IS NULL OR agency_id_idx IS NULL OR is_disrupted IS NULL)
  AS n_skipped FROM idx WHERE delay_minutes IS NOT NULL""")
def q_assembler_skipped(spark, sf):
    p = features.index_categories(features.prepare(SI.delay_table(spark, sf, *SI.FEATURE_INPUTS)))
    return features.skipped_rows(p, features.present_columns(p, features.CANDIDATE_FEATURES))


def queries() -> dict:
    return dict(Q)


def oracle_sql() -> dict:
    return dict(SQL)
