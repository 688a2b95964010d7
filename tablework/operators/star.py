"""Star schema outputs.

The reference collects a sample to pandas, deduplicates on the driver and
inserts rows into an embedded database.  Here each table is a DataFrame
written by executors; first-row-per-key is a min-of-struct aggregate (a
defined row, combinable map-side), ids come from executors, and lookups are
served by file layout (Parquet min/max statistics) instead of indexes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.operators.numbering import numbered
from tablework.session import shared_scratch
from tablework.sources import schemas

# The columns of the star tables (schemas.STAR_*).
ROUTE_COLS = schemas.STAR_ROUTES.names
TRIP_COLS = schemas.STAR_TRIPS.names
EVENT_COLS = [c for c in schemas.STAR_EVENTS.names if c != "event_id"]


def first_per_key(df: DataFrame, key: str, cols) -> DataFrame:
    """One row per key - the smallest (by the other columns in order),
    so the result is defined; null keys are dropped like a primary key
    would refuse them."""
    rest = [c for c in cols if c != key and c in df.columns]   # feeds may lack optional columns
    return (df.where(F.col(key).isNotNull()).groupBy(key)
              .agg(F.min(F.struct(*rest)).alias("__r"))
              .select(key, *[F.col(f"__r.{c}").alias(c) for c in rest]))


def dim_routes(df: DataFrame) -> DataFrame:
    """Routes dimension keyed by ``route_id``."""
    return first_per_key(df, "route_id", ROUTE_COLS)


def dim_trips(df: DataFrame) -> DataFrame:
    """Trips dimension keyed by ``trip_id``."""
    return first_per_key(df, "trip_id", TRIP_COLS)


def event_id_hash(keys) -> "F.Column":
    """D3 stable form: a 60-bit id from md5 of the natural key, null being a
    text of its own (same value after recomputation and in a second engine).  By the birthday bound a collision
    becomes likely near 10^9 rows (~0.4 % at 10^8); use ``unique`` at scale."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def fact_events(df: DataFrame, id_mode: str = "unique",
                keys=("trip_id", "stop_sequence", "stop_id"), partitions: int | None = None) -> DataFrame:
    """Delay-event fact with a surrogate ``event_id``.

    ``unique``: ``monotonically_increasing_id`` - unique without a shuffle
    or a single-task row_number; the same under retries only straight after
    a file scan, so write the fact once.  ``hash``: :func:`event_id_hash` of
    ``keys`` and, since the keys may repeat, of the row's number among the
    rows of its key, in the order of the other columns.  ``dense``: 1, 2, ...
    n, as an autoincrement gives, in the order of the columns (``keys``
    first), worked out by ranges.
    """
    if id_mode == "unique":
        eid = F.monotonically_increasing_id()
    elif id_mode == "dense":
        cols = [*keys, *[c for c in EVENT_COLS if c not in keys]]
        df = numbered(df.select(*EVENT_COLS), [F.col(c) for c in cols], "__id", start=1, partitions=partitions)
        eid = F.col("__id")
    elif id_mode != "hash":
        raise ValueError(f"id_mode is 'unique', 'dense' or 'hash', not {id_mode!r}")
    else:
        rest = [F.col(c) for c in EVENT_COLS if c not in keys]
        df = df.withColumn("__nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*rest)))
        eid = event_id_hash([*keys, "__nth"])
    return df.select(eid.alias("event_id"),
                     *[F.col(c).cast("int").alias(c) if c == "is_disrupted" else F.col(c)
                       for c in EVENT_COLS])


def build_star(df: DataFrame, id_mode: str = "unique") -> dict[str, DataFrame]:
    """N1-N3 from the augmented table."""
    return {"routes": dim_routes(df), "trips": dim_trips(df),
            "delay_events": fact_events(df, id_mode)}


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent (declared foreign key check),
    as a left anti join; count it for the check.  No ``distinct`` on the
    parent keys: duplicates cannot change an anti join's result."""
    return child.join(parent.select(key), on=key, how="left_anti")


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """(key, n_rows) of the child keys that have no parent.  Rows are
    counted per key first (combined before the shuffle), so the anti join
    moves one row per key and task however many rows a key has."""
    counts = child.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(parent.select(key), on=key, how="left_anti")


def orphan_counts(star: dict[str, DataFrame]) -> DataFrame:
    """Orphan counts of both foreign keys in one row."""
    def count(child: str, parent: str, key: str, name: str) -> DataFrame:
        return orphan_keys(star[child], star[parent], key).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias(name))

    trips = count("trips", "routes", "route_id", "orphan_trips").select("orphan_trips").scalar()
    return count("delay_events", "trips", "trip_id", "orphan_events").select("orphan_events", trips.alias("orphan_trips"))


def clustered(df: DataFrame, cols, partitions: int | None = None,
              salt_rows: int | None = 256) -> DataFrame:
    """N4 layout: range-partition on ``cols`` and sort inside each partition
    so every Parquet file / row group covers a narrow key range and a lookup
    on ``cols[0]`` is pruned by min/max statistics.  ``salt_rows`` adds a
    hash salt as the last range key so one heavy key can still be split over
    several files."""
    keys = [F.col(c) for c in cols]
    if salt_rows:
        keys.append(F.xxhash64(*[F.col(c) for c in df.columns]) % F.lit(salt_rows))
    out = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return out.sortWithinPartitions(*cols)


#: Columns that the fact is looked up by.
LOOKUP_COLUMNS = ("trip_id", "stop_id", "route_id")
#: Bits of each column's rank in the interleaved key.
RANK_BITS = 10


def interleaved(ranks: list[Column], bits: int = RANK_BITS) -> Column:
    """Morton number: the bits of the ranks in turn, highest first, so rows
    near in all ranks are near in one order."""
    code = F.lit(0).cast("long")
    for i in range(bits):
        for k, rank in enumerate(ranks):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1).cast("long"))
            code = code.bitwiseOR(F.shiftleft(bit, i * len(ranks) + len(ranks) - 1 - k))
    return code


def ranked(df: DataFrame, column: str, bits: int = RANK_BITS) -> tuple[list[tuple], int]:
    """The distinct values of a column in their order get ranks
    0 .. 2^bits - 1 with as many values each: the (first value, rank) of each
    rank that occurs, at most 2^bits, and the number of values."""
    spark = df.sparkSession
    path = shared_scratch(spark, f"values-{column}")
    df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct().write.parquet(path)
    values = spark.read.parquet(path)
    n = values.count()
    at = numbered(values, [F.col("value")], "at")
    rank = F.floor(F.col("at") * (1 << bits) / max(1, n)).alias("rank")
    firsts = at.groupBy(rank).agg(F.min("value").alias("first")).collect()
    return sorted(((r["first"], r["rank"]) for r in firsts), key=lambda x: x[1]), n


def with_ranks(df: DataFrame, starts: dict[str, list[tuple]], names: list[str]) -> DataFrame:
    """df and, as ``names``, the rank of each column's value from the (first
    value, rank) pairs of :func:`ranked`.  The pairs are part of the
    expression and are searched in two steps of about the root of their
    number, so no join moves the rows.  Null has rank 0."""
    def rank(value: Column, pairs: list[tuple]) -> Column:
        if not pairs:
            return F.lit(0).cast("long")
        step = max(1, math.isqrt(len(pairs)))
        firsts = [v for v, _ in pairs]
        blocks = [firsts[k:k + step] for k in range(0, len(firsts), step)]

        def at_most(values: Column) -> Column:
            return F.size(F.filter(values, lambda v: v <= value))

        block = at_most(F.array(*[F.lit(b[0]) for b in blocks])) - 1
        inside = at_most(F.get(F.array(*[F.array(*[F.lit(v) for v in b]) for b in blocks]), block)) - 1
        found = F.get(F.array(*[F.lit(r) for _, r in pairs]), block * step + inside)
        return F.coalesce(F.when(value.isNotNull(), found), F.lit(0)).cast("long")

    return df.withColumns({n: rank(F.col(c), pairs) for n, (c, pairs) in zip(names, starts.items())})


def write_lookup_fact(events: DataFrame, path: str, columns=LOOKUP_COLUMNS, files: int = 512) -> str:
    """One written fact that answers lookups on each of ``columns`` (the
    part that an index per column plays in a row store).

    Every value gets its rank among the column's values and the ranks' bits
    are interleaved.  The highest bits of that number name a cell; the rows
    of a cell make one file (several, by hash, when it holds more than twice
    its share), so with f cells and k columns a file covers about the k-th
    root of f-th part of each column's values, and its Parquet minimum and
    maximum leave it out of most lookups on any of them.  A Parquet Bloom
    filter per column leaves out files whose bounds hold the value but whose
    rows do not.  A value with many rows is spread by the other columns.
    Null is rank 0.

    Each column's values are numbered by ranges; a row finds its ranks among
    the first values of the ranks (a bounded list), and the rows are written
    once with them, for the counts per cell and for the layout.  ``files``: about how many."""
    spark = events.sparkSession
    cells = max(1, math.ceil(math.log2(files)))
    starts, sizes = {}, {}
    for c in columns:
        starts[c], sizes[c] = ranked(events, c)
    names = [f"__rank{i}" for i in range(len(columns))]
    out = with_ranks(events, starts, names)
    joined = out.withColumn("__code", interleaved([F.col(n) for n in names])).drop(*names)
    scratch = shared_scratch(spark, "lookup-codes")
    joined.write.parquet(scratch)
    cell = F.shiftright("__code", max(0, RANK_BITS * len(columns) - cells))
    coded = spark.read.schema(joined.schema).parquet(scratch).withColumn("__cell", cell)
    counts = coded.groupBy("__cell").agg(F.count(F.lit(1)).alias("n")).collect()       # at most 2^cells rows
    share = 2 * max(1, sum(r["n"] for r in counts)) / (1 << cells)
    plan, first = [], 0
    for r in sorted(counts, key=lambda r: r["__cell"]):
        parts = max(1, math.ceil(r["n"] / share))
        plan.append((r["__cell"], first, parts))
        first += parts
    to = spark.createDataFrame(plan, "__cell long, __first int, __parts int")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in events.columns]), F.col("__parts")).cast("int")
    dealt = (coded.join(F.broadcast(to), "__cell").repartitionById(max(1, first), F.col("__first") + salt)
             .sortWithinPartitions("__code", *columns).select(*events.columns))
    writer = dealt.write.mode("overwrite")
    for c, n in sizes.items():
        writer = (writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{c}", str(max(1, min(n, 1_000_000)))))
    writer.parquet(path)
    return path


def events_with_route(star: dict[str, DataFrame]) -> DataFrame:
    """The fact with the route of each event's trip (null without a trip)."""
    trips = star["trips"].select("trip_id", "route_id")
    return star["delay_events"].join(trips, "trip_id", "left")


def lookup(fact: DataFrame, column: str, value) -> DataFrame:
    """The rows of one value; the condition reaches the Parquet scan."""
    return fact.where(F.col(column) == F.lit(value))
