"""Nearest billing: for each movement (container, dispatch time) the last billing
event at or before the dispatch and the first at or after it (an as-of join in
both directions, inclusive on both sides).

Ties on ``date_e`` are broken by a total order (date_e, order_id, service,
client, point from, point to, station from, station to); the whole event is
picked at once, as one struct, so that all columns come from the same event.

Events are first reduced to one row per (container, time): the greatest and the
least of that time's events, combined map-side.

Methods (all return the same rows):

* ``scan`` (default): a parallel prefix scan over chunks of the order (container, time).  Split points are every k-th
  row of a sorted sample of that order, so chunks hold about equally many rows; a container in which no split point
  falls is one chunk, one that holds half of all rows is half of the chunks, and a time that holds more than a chunk is
  a split point several times over: its probes are dealt out over its chunks, its events are reduced to the greatest and the least,
  which stand in each.  Every row finds its chunk by binary search in its container's split points and
  goes straight to the partition of that chunk (``repartitionById``): one exchange, after which each chunk
  is scanned alone.  What earlier / later chunks of a container contribute comes from a table of one row per chunk and
  enters the scan as two sentinel rows.  The plan is the same at every skew; the number of split points is bounded by the
  number of partitions.
* ``window``: one running max / min per container over the union of events and
  keys.  One shuffle, but a container is one window partition.
* ``join``: equi-joins on (container, day) with a conditional arg-max / arg-min
  per key, and a per-day summary's carries for the other days.  Rows = event times x dispatch
  times of one container-day, never of a whole container.

``nearest_billing`` returns one row per distinct key.  ``attach_nearest`` adds
the two blocks to every row of a table (a left as-of join) without a join back:
the rows ride through the same scan as a struct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import day_diff
from ..schemas import AFTER_COLUMNS, BEFORE_COLUMNS, INVOICE_CODES, NEAREST_FIELDS
from ..session import partitions_of
from .movements import movement_keys

# Chunks per partition, so that a partition holds several of them and their sizes even out; rows that
# a chunk should hold at least; sampled rows per chunk.
CHUNKS_PER_PARTITION = 4
CHUNK_ROWS = 1_000_000
SAMPLE_PER_CHUNK = 64

# Tie-break order after date_e and order_id (NULL names compare as '').
_TIE_NAMES = ("service_name", "client_name", "points_from_name", "points_to_name",
              "station_name_from", "station_name_to")
_LOW = "0001-01-01 00:00:00"
_HIGH = "9999-12-31 23:59:59"


def event_struct() -> Column:
    """Orderable struct of an event of one container: the ordering keys, then what the other columns need.

    Each value stands in it once, as events are shuffled and sorted in this form; a name that is NULL is told by its flag.
    """
    keys = [F.col("date_e").alias("date_e"), F.col("order_id").alias("order_id")]
    keys += [F.coalesce(F.col(c), F.lit("")).alias(c) for c in _TIE_NAMES]
    return F.struct(*keys, *[F.col(c).isNotNull().alias(f"has_{c}") for c in _TIE_NAMES], F.col("rub_sum"), F.col("cur_sum"))


def _event_field(picked: str, field: str, container: Column) -> Column:
    """A column of the picked event; its container is the row's own."""
    if field == "container_no":
        return F.when(F.col(picked).isNotNull(), container)
    if field in _TIE_NAMES:
        return F.when(F.col(f"{picked}.has_{field}"), F.col(f"{picked}.{field}"))
    return F.col(f"{picked}.{field}")


def _clean_events(events: DataFrame) -> DataFrame:
    """container_no, t, ev of the events that have both a container and a time."""
    return (events.filter(F.col("container_no").isNotNull() & F.col("date_e").isNotNull())
                  .select("container_no", F.col("date_e").alias("t"), event_struct().alias("ev")))


def _picks(dispatch: Column, container: Column, before: str = "b", after: str = "a") -> list[Column]:
    """The before_* / after_* output columns from the picked structs."""
    cols = []
    for prefix, src in (("before", before), ("after", after)):
        for field in NEAREST_FIELDS:
            if field == "date_diff":
                c = day_diff(dispatch, F.col(f"{src}.date_e"))
            else:
                c = _event_field(src, field, container)
            cols.append(c.alias(f"{prefix}_{field}"))
    return cols


# --- split points -------------------------------------------------------------

@dataclass(frozen=True)
class Splits:
    """Split points by container (sorted, repeated where one time holds several chunks) and the partitions they are for."""

    points: dict[str, tuple]
    partitions: int


def sampled_splits(keys: DataFrame, chunks: int | None = None, partitions: int | None = None, total: int | None = None) -> Splits:
    """Split points of ``keys`` (container_no, t): at most ``chunks`` rows come to the driver.

    ``chunks`` defaults to a few per partition, fewer where they would hold less than ``CHUNK_ROWS`` rows.  The sample's size
    follows the number of chunks, not the table.  Any split points give the same result; only the balance depends on them.
    ``total`` may give the number of rows, or a number not far above it.
    """
    total = keys.count() if total is None else total
    partitions = partitions or partitions_of(keys.sparkSession, total)
    if chunks is None:
        chunks = min(CHUNKS_PER_PARTITION * partitions, total // CHUNK_ROWS)
    if chunks < 2 or not total:
        return Splits({}, partitions)
    known = keys.filter(F.col("container_no").isNotNull() & F.col("t").isNotNull())
    fraction = min(1.0, SAMPLE_PER_CHUNK * chunks / total)
    sample = known if fraction == 1.0 else known.sample(fraction, seed=17)
    # One task sorts the bounded sample.
    numbered = sample.select("container_no", "t", F.row_number().over(Window.orderBy("container_no", "t")).alias("place"),
                             F.count(F.lit(1)).over(Window.partitionBy()).alias("size"))
    picked = numbered.filter(F.col("place") % F.ceil(F.col("size") / chunks) == 0).select("container_no", "t").collect()
    points: dict[str, list] = {}
    for row in picked:
        points.setdefault(row["container_no"], []).append(row["t"])
    return Splits({c: tuple(sorted(ts)) for c, ts in points.items()}, partitions)


def split_points(movements_n: DataFrame, ledger: DataFrame, chunks: int | None = None, partitions: int | None = None) -> Splits:
    """Split points from the base tables (dispatches, ledger lines of the event codes): two narrow columns of each."""
    lines = (ledger.filter(F.col("esu_id").isin(*INVOICE_CODES))
             .select(F.upper("service_details_container_number").alias("container_no"), F.col("date_end").alias("t")))
    keys = movements_n.select("container_no", F.col("dispatch_ts").alias("t")).unionByName(lines)
    # Whole tables are counted from the files' footers.
    return sampled_splits(keys, chunks, partitions, movements_n.count() + ledger.count())


def _with_points(df: DataFrame, splits: Splits, how: str = "left") -> DataFrame:
    """``df`` (container_no, t, ..) plus ``points``, its container's split points (NULL where it has none)."""
    t_type = df.schema["t"].dataType.simpleString()
    if not splits.points:
        return df.withColumn("points", F.lit(None).cast(f"array<{t_type}>"))
    table = df.sparkSession.createDataFrame([(c, list(ts)) for c, ts in sorted(splits.points.items())],
                                            f"container_no string, points array<{t_type}>")
    return df.join(F.broadcast(table), "container_no", how)  # at most one row for each split point


def _points_below(t: Column, splits: Splits, inclusive: bool) -> Column:
    """How many of ``points`` are before ``t`` (or at it): binary search."""
    longest = max((len(ts) for ts in splits.points.values()), default=1)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(longest.bit_length()))])

    def step(low, size):
        point = F.get("points", low + size - 1)
        return F.when(point <= t if inclusive else point < t, low + size).otherwise(low)
    return F.when(F.col("points").isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), step))


def _partition(chunk: Column, partitions: int) -> Column:
    """The partition of a chunk: neighbouring chunks of a container lie in neighbouring partitions."""
    return F.pmod(F.pmod(F.xxhash64("container_no"), F.lit(partitions)) + chunk, F.lit(partitions)).cast("int")


# --- scans ------------------------------------------------------------------
# Probes carry container_no, t and a payload column m (NULL when unused); the
# scans return container_no, dispatch_ts, m, b (before struct), a (after struct).

def _probes(keys: DataFrame) -> DataFrame:
    if "m" not in keys.columns:
        keys = keys.withColumn("m", F.lit(None).cast("int"))
    return keys.select("container_no", F.col("dispatch_ts").alias("t"), "m")


def _rows(ev: DataFrame, probes: DataFrame, *more: str) -> DataFrame:
    """Events and probes in one table: container_no, t, ev, kind (0 event, 1 probe), m, and the columns ``more`` of both."""
    return (ev.select("container_no", "t", "ev", F.lit(0).alias("kind"), F.lit(None).cast(probes.schema["m"].dataType).alias("m"), *more)
            .unionByName(probes.select("container_no", "t", F.lit(None).cast(ev.schema["ev"].dataType).alias("ev"),
                                       F.lit(1).alias("kind"), "m", *more)))


def _prefix(rows: DataFrame, *keys: str, container: str = "container_no") -> DataFrame:
    """Running max / min of ``ev`` per key; equal times are RANGE peers, so an
    event at the dispatch time counts on both sides.

    A probe without a time sorts first ascending (it is a peer only of other such
    probes, so ``b`` is NULL) but last descending, where its frame would hold
    every event: its ``a`` is set to NULL explicitly.
    """
    up = Window.partitionBy(*keys).orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = (Window.partitionBy(*keys).orderBy(F.col("t").desc())
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.select(F.col(container).alias("container_no"), F.col("t").alias("dispatch_ts"), "kind", "m",
                        F.max("ev").over(up).alias("b"),
                        F.when(F.col("t").isNotNull(), F.min("ev").over(down)).alias("a"))
            .filter(F.col("kind") == 1).drop("kind"))


def _window(ev: DataFrame, keys: DataFrame) -> DataFrame:
    # Under a name of its own on both sides of the union, the container's partitioning (of stored buckets) outlives the union.
    rows = _rows(ev, _probes(keys)).withColumnRenamed("container_no", "same_container")
    return _prefix(rows, "same_container", container="same_container")


def _scan(ev: DataFrame, keys: DataFrame, splits: Splits) -> DataFrame:
    """The parallel prefix scan: every chunk is scanned alone, by the partition it lies in."""
    return _prefix(_placed(ev, keys, splits), "part", "container_no", "chunk")


def _placed(ev: DataFrame, keys: DataFrame, splits: Splits) -> DataFrame:
    """Events, probes and what the chunks' edges carry, every row in its chunk's partition."""
    n = splits.partitions
    t = F.col("t")
    below, upto = _points_below(t, splits, False), _points_below(t, splits, True)
    # Chunk k holds the times after split point k - 1 up to point k.  A time that is several points has several chunks.
    events = _with_points(ev, splits).withColumn("chunk", below)
    several = any(len(set(ts)) < len(ts) for ts in splits.points.values())
    if several:
        events = events.withColumn("last", F.greatest(F.col("chunk"), upto - 1))
        least_and_greatest = F.explode(F.array_distinct(F.array("low", "high")))
        tied = (events.filter("last > chunk").groupBy("container_no", "t", "chunk", "last")
                .agg(F.min("ev").alias("low"), F.max("ev").alias("high"))
                .select("container_no", "t", F.explode(F.sequence("chunk", "last")).alias("chunk"), "low", "high")
                .select("container_no", "t", least_and_greatest.alias("ev"), "chunk"))
        events = events.filter("last = chunk").select("container_no", "t", "ev", "chunk").unionByName(tied)
    events = events.select("container_no", "t", "ev", "chunk")
    # Probes without a container or time meet no event; they are dealt out over chunks of their own.
    salt = F.xxhash64("m", F.spark_partition_id())
    spread = F.pmod(salt, F.lit(n)).cast("int")
    tied_chunk = below + F.pmod(salt, F.greatest(F.lit(1), upto - below)).cast("int") if several else below
    chunk = F.when(F.col("container_no").isNull() | t.isNull(), -1 - spread).otherwise(tied_chunk)
    probes = _with_points(_probes(keys), splits).withColumn("chunk", chunk)
    rows = _rows(events, probes, "chunk")
    if splits.points:
        rows = rows.unionByName(_carry_rows(ev, events, splits).withColumn("m", F.lit(None).cast(rows.schema["m"].dataType)))
    return rows.withColumn("part", _partition(F.col("chunk"), n)).repartitionById(n, "part")


def _carry_rows(ev: DataFrame, events: DataFrame, splits: Splits) -> DataFrame:
    """Two sentinel rows for each chunk of a split container: the greatest event of its earlier chunks, before all
    times, and the least of its later chunks, after all times."""
    spark = ev.sparkSession
    names = spark.createDataFrame([(c, len(ts)) for c, ts in sorted(splits.points.items())], "container_no string, n_points int")
    # Every chunk has a row, also one without events.
    chunks = names.select("container_no", F.lit(None).cast(ev.schema["ev"].dataType).alias("ev"),
                          F.explode(F.sequence(F.lit(0), F.col("n_points"))).alias("chunk"))
    # A list of names (at most one for each split point) goes through the events' grouping down to the ledger's scan.
    own = events.filter(F.col("container_no").isin(sorted(splits.points))).select("container_no", "ev", "chunk")
    summary = chunks.unionByName(own).groupBy("container_no", "chunk").agg(F.max("ev").alias("high"), F.min("ev").alias("low"))
    earlier = Window.partitionBy("container_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("container_no").orderBy(F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carries = summary.select("container_no", "chunk", F.max("high").over(earlier).alias("high"), F.min("low").over(later).alias("low"))
    t_type = ev.schema["t"].dataType
    sentinel = F.explode(F.array(F.struct(F.lit(_LOW).cast(t_type).alias("t"), F.col("high").alias("ev")),
                                 F.struct(F.lit(_HIGH).cast(t_type).alias("t"), F.col("low").alias("ev"))))
    return (carries.select("container_no", "chunk", sentinel.alias("s")).filter("s.ev IS NOT NULL")
            .select("container_no", "s.t", "s.ev", F.lit(2).alias("kind"), "chunk"))


# --- join by day --------------------------------------------------------------

def _day(t: Column) -> Column:
    return F.unix_date(F.to_date(t)).cast("long")


def _carries(own: DataFrame, probes: DataFrame) -> DataFrame:
    """container_no, seg, carry_high, carry_low for the days that hold a probe: the greatest event of
    earlier days and the least of later ones.

    As days follow the events' order, these are the greatest event of the last earlier day with events and the least of the next
    later one: the window over one row per container-day picks those days by number, and only their events are moved.
    """
    days = (own.select("container_no", "seg", F.lit(0).alias("kind")).unionByName(probes.select("container_no", "seg", F.lit(1).alias("kind")))
            .groupBy("container_no", "seg").agg(F.min("kind").alias("least"), F.max("kind").alias("has_key")))
    with_events = F.when(F.col("least") == 0, F.col("seg"))
    earlier = Window.partitionBy("container_no").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("container_no").orderBy("seg").rowsBetween(1, Window.unboundedFollowing)
    links = (days.select("container_no", "seg", "has_key", F.max(with_events).over(earlier).alias("seg_high"),
                         F.min(with_events).over(later).alias("seg_low"))
             .filter(F.col("has_key") == 1).drop("has_key"))
    summary = own.groupBy("container_no", "seg").agg(F.max("ev").alias("high"), F.min("ev").alias("low"))
    high = summary.select("container_no", F.col("seg").alias("seg_high"), F.col("high").alias("carry_high"))
    low = summary.select("container_no", F.col("seg").alias("seg_low"), F.col("low").alias("carry_low"))
    side = F.lit(None).cast(own.schema["ev"].dataType)
    both = (links.join(high, ["container_no", "seg_high"]).select("container_no", "seg", "carry_high", side.alias("carry_low"))
            .unionByName(links.join(low, ["container_no", "seg_low"]).select("container_no", "seg", side.alias("carry_high"), "carry_low")))
    return both


def _join(ev: DataFrame, keys: DataFrame) -> DataFrame:
    """Equi-joins on (container, day): the day's own events, and what other days carry in."""
    seg = _day(F.col("t"))
    probes = _probes(keys).select("container_no", F.col("t").alias("dispatch_ts"), seg.alias("seg"))
    # The day's join and its summary take the same columns, so one exchange of the events serves both.
    own = (ev.select("container_no", seg.alias("seg"), "ev")
           .repartition(partitions_of(ev.sparkSession), "container_no", "seg"))
    t = F.col("ev.date_e")
    met = (probes.join(own, ["container_no", "seg"], "left").groupBy("container_no", "seg", "dispatch_ts")
           .agg(F.max(F.when(t <= F.col("dispatch_ts"), F.col("ev"))).alias("b"),
                F.min(F.when(t >= F.col("dispatch_ts"), F.col("ev"))).alias("a")))
    carries = _carries(own, probes.filter("seg IS NOT NULL"))
    carries = carries.groupBy("container_no", "seg").agg(F.max("carry_high").alias("carry_high"), F.min("carry_low").alias("carry_low"))
    return (met.join(carries, ["container_no", "seg"], "left")
            .select("container_no", "dispatch_ts", F.coalesce("b", "carry_high").alias("b"),
                    F.coalesce("a", "carry_low").alias("a")))


_METHODS = ("scan", "window", "join")


def _pick(ev: DataFrame, keys: DataFrame, method: str, splits: Splits | None, chunks: int | None) -> DataFrame:
    if method not in _METHODS:
        raise ValueError(f"method must be one of {sorted(_METHODS)}")
    if method == "window":
        return _window(ev, keys)
    if method == "join":
        return _join(ev, keys)
    if splits is None:
        times = ev.select("container_no", "t").unionByName(keys.select("container_no", F.col("dispatch_ts").alias("t")))
        splits = sampled_splits(times, chunks)
    return _scan(ev, keys, splits)


# --- public -------------------------------------------------------------------

def nearest_billing(events: DataFrame, movements_n: DataFrame, method: str = "scan", splits: Splits | None = None,
                    chunks: int | None = None) -> DataFrame:
    """One row per movement key (container, dispatch_ts) with a billing event on
    at least one side: ``before_*`` and ``after_*`` columns (NULL where a side
    has no event); ``*_date_diff`` = days from dispatch to the event.

    ``scan``: ``splits`` may give the split points (``split_points``, from the base tables); else they are
    sampled from the events and keys, ``chunks`` of them."""
    ev = _clean_events(events)
    picked = _pick(ev, movement_keys(movements_n), method, splits, chunks)
    picked = picked.filter(F.col("b").isNotNull() | F.col("a").isNotNull())
    return picked.select("container_no", "dispatch_ts", *_picks(F.col("dispatch_ts"), F.col("container_no")))


def attach_nearest(events: DataFrame, rows: DataFrame, method: str = "scan", splits: Splits | None = None,
                   chunks: int | None = None) -> DataFrame:
    """Every row of ``rows`` (with ``container_no``, ``dispatch_ts``) plus the
    ``before_*`` / ``after_*`` blocks: a left as-of join, with the same values as
    ``nearest_billing`` joined back on the key.

    The rows ride through the scan as one struct, so there is no join back; a row
    without a container or a dispatch time picks nothing.
    """
    cols = [F.col(f"`{c}`") for c in rows.columns]
    if method == "join":
        near = nearest_billing(events, rows, "join")
        return rows.join(near, ["container_no", "dispatch_ts"], "left").select(*cols, *BEFORE_COLUMNS, *AFTER_COLUMNS)
    probes = rows.select("container_no", "dispatch_ts", F.struct(*cols).alias("m"))
    return _pick(_clean_events(events), probes, method, splits, chunks).select(
        "m.*", *_picks(F.col("m.dispatch_ts"), F.col("m.container_no")))


def nearest_before(events: DataFrame, movements_n: DataFrame, method: str = "scan", splits: Splits | None = None) -> DataFrame:
    """Keys with an event at or before the dispatch: key + ``before_*`` columns."""
    out = nearest_billing(events, movements_n, method, splits)
    return out.filter(F.col("before_date_e").isNotNull()).select("container_no", "dispatch_ts", *BEFORE_COLUMNS)


def nearest_after(events: DataFrame, movements_n: DataFrame, method: str = "scan", splits: Splits | None = None) -> DataFrame:
    """Keys with an event at or after the dispatch: key + ``after_*`` columns."""
    out = nearest_billing(events, movements_n, method, splits)
    return out.filter(F.col("after_date_e").isNotNull()).select("container_no", "dispatch_ts", *AFTER_COLUMNS)
