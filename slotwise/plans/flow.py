"""Day and range flows over a lake of written tables.

Layout under one root in the shared folder::

    landed/dt=…/src=…/        raw lines + rule ids + parsed fields (landing)
    silver/dt=…/              typed, per-dt last-write-wins rows
    silver_dates/dt=…/        (dt, event_date): which event dates each dt holds
    event_index/buckets-N/    (event_id, event_date) by dt, N buckets of event_id: where each event's copies lie
    moved/                    (event_id, event_date, dt) of events whose copies carry different event dates
    gold/campaign_daily/event_date=…/
    gold/pod_fill/event_date=…/

Every write is a dynamic partition overwrite, so re-running a day replaces
exactly what it produced. Gold is never read to rewrite itself: a changed
``dt`` recomputes every event date it touches, and every one it touched before the
change, from *all* silver rows of those dates (found through ``silver_dates``),
after the cross-partition dedup (W3). Copies of one event under different event
dates compete with each other across those dates: the few such events are found in the
event index, kept in ``moved``, and their copies are read along.

The gate of a day takes its figures from observations of the writes themselves, so
it reads nothing back. A gated backfill writes gold to a staging folder and
moves only the dates that pass.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from slotwise.operators import gold, quality, silver
from slotwise.session import configure, scratch_path


@dataclass(frozen=True)
class Lake:
    root: str

    @property
    def landed(self) -> str:
        return f"{self.root}/landed"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def silver_dates(self) -> str:
        return f"{self.root}/silver_dates"

    @property
    def event_index(self) -> str:
        return f"{self.root}/event_index"

    @property
    def moved(self) -> str:
        return f"{self.root}/moved"

    @property
    def campaign_daily(self) -> str:
        return f"{self.root}/gold/campaign_daily"

    @property
    def pod_fill(self) -> str:
        return f"{self.root}/gold/pod_fill"

    @staticmethod
    def fresh(spark: SparkSession, name: str = "lake") -> Lake:
        return Lake(scratch_path(spark, name))


class MartNotBuilt(FileNotFoundError):
    """A gold table has not been written yet."""


def read_table(spark: SparkSession, path: str, what: str = "table") -> DataFrame:
    """Scan a written table (all partitions, discovery keeps the partition column)."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            raise MartNotBuilt(f"{what} not built yet: {path}") from exc
        raise


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written at ``path`` (asked of the file system, without a query)."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except AttributeError:  # a remote session has no JVM handle
        try:
            spark.read.parquet(path).schema
            return True
        except AnalysisException:
            return False
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(conf).exists(folder)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of the sub-folders of a folder; none if it does not exist."""
    if not table_exists(spark, folder):
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def _dates(df: DataFrame, col: str) -> list[str]:
    """Distinct partition values (a handful of dates) as literals for pruning."""
    return sorted(str(r[0]) for r in df.select(col).distinct().collect() if r[0] is not None)


def _in_dates(col: str, values: list[str]):
    return F.col(col).isin([F.lit(v).cast("date") for v in values]) if values else F.lit(False)


# --- silver (G1, K4, K5) ------------------------------------------------------------

#: An event id stands once in a day's file: building a dictionary of them only costs time.
PLAIN_IDS = {"parquet.enable.dictionary#event_id": "false"}


@dataclass
class SilverWrite:
    """What one silver write saw: its arrival days, and the figures of the gate over all its rows."""

    dts: list[str]
    figures: dict[str, int] = field(default_factory=dict)
    found: bool = True  # whether the input had any row


def write_silver(spark: SparkSession, lake: Lake, rows: DataFrame) -> list[str]:
    """Per-dt last-write-wins silver for every ``dt`` present in ``rows``; returns those dts."""
    return observe_silver(spark, lake, rows).dts


def observe_silver(spark: SparkSession, lake: Lake, rows: DataFrame) -> SilverWrite:
    """``write_silver`` with what it observed.

    One job for any number of days (a backfill is one multi-partition write).
    The input's days, the (dt, event_date) pairs written and the gate's figures are
    gathered by observations on that same job — no second pass over the input or silver.
    A day whose rows all dropped out is cleared explicitly: a dynamic overwrite
    only replaces partitions that receive rows. What is observed before the exchange is
    a set, so a map stage re-run after a lost executor cannot change it; the
    counts sit on the write's own stage, whose tasks count once. The event index
    follows, from the days just written.
    """
    configure(spark)
    old, stood = date_pairs(spark, lake), table_exists(spark, lake.silver)
    seen, made = Observation("silver_in"), Observation("silver_out")
    observed = rows.observe(seen, F.collect_set("dt").alias("dts"), F.max(F.lit(True)).alias("found"))
    out = silver.silver(observed, by=("dt", "event_id"))
    out = out.observe(made, F.collect_set(F.struct("dt", "event_date")).alias("pairs"), *quality.silver_figures())
    (
        out.sortWithinPartitions("dt", "event_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**PLAIN_IDS)
        .partitionBy("dt")
        .parquet(lake.silver)
    )
    if not seen.get.get("found"):  # nothing was written but the table's empty folder
        if not stood:
            drop_folder(spark, lake.silver)
        return SilverWrite([], dict.fromkeys(quality.SILVER_FIGURES, 0), found=False)
    dts = sorted(str(d) for d in (seen.get.get("dts") or []) if d is not None)
    pairs = [(p["dt"], p["event_date"]) for p in (made.get.get("pairs") or [])]
    kept = sorted({str(d) for d, _ in pairs})
    for gone in sorted(set(dts) - set(kept)):
        drop_partition(spark, lake.silver, "dt", gone)
        drop_partition(spark, lake.silver_dates, "dt", gone)
        forget_day(spark, lake, gone)
    if pairs:
        dates = spark.createDataFrame(pairs, "dt date, event_date date")  # a few rows per day
        (
            dates.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("dt")
            .parquet(lake.silver_dates)
        )
        if not children(spark, lake.event_index):  # a lake written without one
            kept = sorted({d for d, _ in old} | set(kept))
        index_days(spark, lake, kept)
    return SilverWrite(dts, {k: int(made.get.get(k) or 0) for k in quality.SILVER_FIGURES})


# --- the event index ----------------------------------------------------------------------


def open_index(spark: SparkSession, lake: Lake, buckets: int | None = None) -> tuple[str, int] | None:
    """The session's table over the lake's event index and its buckets; made with ``buckets`` if there is none (else None).

    The number of buckets is part of the folder's name, because Spark keeps a table's
    bucketing in its catalog and not with the files.
    """
    found = [int(name.removeprefix("buckets-")) for name in children(spark, lake.event_index) if name.startswith("buckets-")]
    n = found[0] if found else buckets
    if not n:
        return None
    name = f"event_index_{hashlib.md5(lake.event_index.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} (event_id STRING, event_date DATE, dt DATE) USING parquet"
            f" OPTIONS ({', '.join(f"'{k}' '{v}'" for k, v in PLAIN_IDS.items())}) PARTITIONED BY (dt)"
            f" CLUSTERED BY (event_id) INTO {n} BUCKETS LOCATION '{lake.event_index}/buckets-{n}'"
        )
        if found:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name, n


def index_days(spark: SparkSession, lake: Lake, dts: list[str]) -> None:
    """Replace the index entries of written silver days: each bucket is one task's file per day.

    A new index gets as many buckets as the session has shuffle partitions, so joins by
    event id line up with it without moving it.
    """
    name, n = open_index(spark, lake, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = spark.read.parquet(lake.silver).where(_in_dates("dt", dts)).select("event_id", "event_date", "dt")
    rows.repartition(n, "event_id").write.mode("overwrite").insertInto(name)


def forget_day(spark: SparkSession, lake: Lake, ds: str) -> None:
    """Drop a day's index entries."""
    opened = open_index(spark, lake)
    if opened:
        name, n = opened
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (dt = DATE'{ds}')")
        drop_partition(spark, f"{lake.event_index}/buckets-{n}", "dt", ds)


def read_index(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """``event_id, event_date, dt`` of all silver rows, bucketed by event id."""
    opened = open_index(spark, lake)
    return spark.table(opened[0]) if opened else None


def drop_partition(spark: SparkSession, table: str, col: str, value: str) -> None:
    """Delete one partition folder of a written table."""
    drop_folder(spark, f"{table}/{col}={value}")


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder this package wrote (through the Hadoop file system)."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except AttributeError as exc:  # a remote session has no JVM handle
        raise RuntimeError(f"cannot clear {folder} from this session") from exc
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(conf).delete(path, True)


def bronze_rows(spark: SparkSession, lake: Lake, dts: list[str]) -> DataFrame:
    """S3: valid landed rows of some days (timestamps still text; silver types them)."""
    from slotwise.operators.landing import bronze

    landed = read_table(spark, lake.landed, "landed").where(_in_dates("dt", dts))
    return bronze(landed)


def read_bronze_day(spark: SparkSession, lake: Lake, ds: str) -> DataFrame:
    """S3 for one day: no landed table -> ``FileNotFoundError``; no valid rows ->
    ``ValueError`` (checked with a one-row job)."""
    rows = bronze_rows(spark, lake, [ds])
    if rows.isEmpty():
        raise ValueError(f"no valid landed rows on {ds}")
    return rows


def silver_day_from_landed(spark: SparkSession, lake: Lake, ds: str) -> list[str]:
    """G1 from landing: bronze of ``ds`` -> per-dt silver partition (typed here)."""
    return write_silver(spark, lake, read_bronze_day(spark, lake, ds))


def full_refresh(spark: SparkSession, lake: Lake) -> None:
    """Rebuild both marts from all silver, replacing the whole tables."""
    configure(spark)
    every = read_table(spark, lake.silver, "silver")
    w3 = silver.dedup_window(every, by=("event_id",))
    fine_path = scratch_path(spark, "fine-counts")
    gold.grain_counts(w3, gold.FINE_KEYS).write.parquet(fine_path)
    fine = spark.read.parquet(fine_path)
    files = gold_files(fine)
    write_gold(gold.campaign_daily_from_counts(fine), lake.campaign_daily, "campaign_id", "market", mode="static", files=files)
    write_gold(gold.pod_fill_from_counts(fine), lake.pod_fill, "pod_id", "content_id", mode="static", files=files)
    drop_folder(spark, fine_path)


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Temp views over the written tables, under the catalog names."""
    names = []
    for name, path in (
        ("ad_events_silver", lake.silver),
        ("fct_campaign_daily", lake.campaign_daily),
        ("fct_pod_fill", lake.pod_fill),
    ):
        if table_exists(spark, path):
            spark.read.parquet(path).createOrReplaceTempView(name)
            names.append(name)
    return names


# --- gold (G2, K6, D8) ---------------------------------------------------------------


GOLD_ROWS_PER_FILE = 2_000_000


def date_pairs(spark: SparkSession, lake: Lake) -> set[tuple[str, str]]:
    """(dt, event_date) pairs of written silver: a few rows per day, gathered on the driver."""
    if not table_exists(spark, lake.silver_dates):  # nothing written yet
        return set()
    rows = spark.read.schema("event_date date, dt date").parquet(lake.silver_dates).distinct().collect()
    return {(str(r["dt"]), str(r["event_date"])) for r in rows}


def _ids(spark: SparkSession, lake: Lake, dts: list[str]) -> DataFrame | None:
    """Event ids that written silver holds for some arrival days (from the index); None without any."""
    if not dts or not {d for d, _ in date_pairs(spark, lake)} & set(dts):
        return None
    index = read_index(spark, lake)
    return None if index is None else index.where(_in_dates("dt", dts)).select("event_id")


def moved_copies(index: DataFrame, ids: DataFrame) -> DataFrame:
    """``event_id, event_date, dt`` of all copies of those events among ``ids`` that carry different event dates.

    The index lies in buckets of the event id: the ids are dealt to the buckets, and
    the join and the grouping both run bucket by bucket, so the index itself is never moved.
    Silver holds an event once a day, so an event's copies are at most one per day.
    """
    copies = index.join(ids.distinct(), "event_id", "left_semi")
    each = copies.groupBy("event_id").agg(
        F.min("event_date").alias("lo"), F.max("event_date").alias("hi"), F.collect_set(F.struct("event_date", "dt")).alias("copies")
    )
    return each.where("lo <> hi").selectExpr("event_id", "inline(copies)")


def spread_events(index: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``event_id`` of the events among ``ids`` (None: all of the index) whose copies carry different event dates.

    The earliest and latest date of an event are enough to tell, so this is a hash
    aggregate in place, bucket by bucket: no copy is sorted or collected.
    """
    copies = index if ids is None else index.join(ids.distinct(), "event_id", "left_semi")
    each = copies.groupBy("event_id").agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    return each.where("event_id IS NOT NULL AND lo <> hi").select("event_id")


@dataclass
class Repeats:
    """The events that several silver rows of some days share: ``event_id, lo, hi`` (earliest and latest event date), stored."""

    path: str
    events: int
    repeated: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("event_id string, lo date, hi date").parquet(self.path)


def store_repeats(spark: SparkSession, lake: Lake, dts: list[str]) -> Repeats | None:
    """Find the events that several silver rows of ``dts`` share, in place in the index; None if it lacks one of the days.

    Rows without an id count as one event, as the dedup has it.
    """
    opened = open_index(spark, lake)
    if opened is None or not set(dts) <= {r[0].removeprefix("dt=") for r in spark.sql(f"SHOW PARTITIONS {opened[0]}").collect()}:
        return None
    index = spark.table(opened[0]).where(_in_dates("dt", dts))
    path, seen = scratch_path(spark, "repeats"), Observation("repeats")
    each = index.groupBy("event_id").agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"), F.count(F.lit(1)).alias("n"))
    each = each.observe(seen, F.count(F.lit(1)).alias("events"), F.count_if(F.col("n") > 1).alias("repeated"))
    each.where("n > 1").select("event_id", "lo", "hi").write.parquet(path)
    return Repeats(path, seen.get.get("events") or 0, seen.get.get("repeated") or 0)


#: Up to this share of all events, and this many, repeated events are deduplicated apart from the others: their ids go to every task.
FEW_REPEATS, MOST_REPEATS = 1 / 8, 1_000_000


def last_copies(spark: SparkSession, scope: DataFrame, repeats: Repeats | None) -> DataFrame:
    """W3 over silver rows: the last copy of each event (``dedup_window``).

    Where the index shows that few events have several rows, only those are moved and
    ranked; a row that is alone is its event's last copy and stays where it is read. With
    many, all rows are dealt by event and ranked.
    """
    if repeats is None or repeats.repeated > min(FEW_REPEATS * repeats.events, MOST_REPEATS):
        return silver.dedup_window(scope, by=("event_id",))
    again = F.broadcast(repeats.read(spark).select(F.col("event_id").alias("again")))
    same = F.col("event_id").eqNullSafe(F.col("again"))
    ranked = silver.dedup_window(scope.join(again, same, "left_semi"), by=("event_id",))
    return scope.join(again, same, "left_anti").unionByName(ranked)


def note_moved(spark: SparkSession, lake: Lake, ids: DataFrame | None, repeats: Repeats | None = None) -> list[str]:
    """Find the events among ``ids`` (None: all) whose copies carry different event dates; returns all their dates.

    Reads the event index, not silver, or the ``repeats`` already found in all of it. The few
    events are stored first; only if there are any are their copies looked up. The rows
    found are appended to ``moved``, where repeats do no harm.
    """
    index = read_index(spark, lake)
    path, spread, found = scratch_path(spark, "spread"), Observation("spread"), Observation("moved")
    if repeats:
        events = repeats.read(spark).where("event_id IS NOT NULL AND lo <> hi").select("event_id")
    else:
        events = spread_events(index, ids)
    events.observe(spread, F.count(F.lit(1)).alias("n")).write.parquet(path)
    dates: list[str] = []
    if spread.get.get("n"):
        rows = moved_copies(index, spark.read.schema("event_id string").parquet(path))
        rows.observe(found, F.collect_set("event_date").alias("dates")).write.mode("append").parquet(lake.moved)
        dates = sorted(str(d) for d in (found.get.get("dates") or []))
    elif not table_exists(spark, lake.moved):
        spark.createDataFrame([], "event_id string, event_date date, dt date").write.parquet(lake.moved)
    drop_folder(spark, path)
    return dates


@dataclass
class GoldWrite:
    """What one gold refresh touched, and the gate's figures of the observed day if that was among it."""

    dates: list[str]
    figures: dict[str, int] | None = None


def refresh_gold(spark: SparkSession, lake: Lake, dts: list[str], before: set[tuple[str, str]] | None = None, old_ids: DataFrame | None = None) -> list[str]:
    """Recompute both marts for every event date that ``dts`` touch or touched; returns those dates."""
    return observe_gold(spark, lake, dts, before, old_ids).dates


def observe_gold(
    spark: SparkSession,
    lake: Lake,
    dts: list[str],
    before: set[tuple[str, str]] | None = None,
    old_ids: DataFrame | None = None,
    day: str | None = None,
    target: Lake | None = None,
) -> GoldWrite:
    """``refresh_gold`` with the gate's figures of ``day``, written to ``target``'s gold (default: the lake's).

    ``before`` are the date pairs and ``old_ids`` the event ids of these days
    before they were written anew (none for a first write). Silver of the days
    that hold a touched date is scanned with partition pruning, deduplicated
    across partitions (W3), aggregated once at the union of both grains, and
    rolled up into the two marts. Touched dates that end without rows lose
    their gold partitions.
    """
    configure(spark)
    target = target or lake
    pairs = date_pairs(spark, lake)
    changed = set(dts)
    touched = {e for d, e in pairs | (before or set()) if d in changed}
    ids = _ids(spark, lake, dts)
    if old_ids is not None:
        ids = old_ids if ids is None else ids.union(old_ids)
    repeats, days = None, {d for d, _ in pairs}
    if ids is not None and pairs:
        every_day = changed >= days  # then the index holds no other events
        if every_day:
            repeats = store_repeats(spark, lake, sorted(days))
        touched |= set(note_moved(spark, lake, None if every_day else ids, repeats))
    if not touched:
        return GoldWrite([])
    dates = sorted(touched)
    holders = sorted({d for d, e in pairs if e in touched})
    nothing = dict.fromkeys(quality.GOLD_FIGURES, 0) if day in touched else None
    if not holders:
        for table in (target.campaign_daily, target.pod_fill):
            for gone in dates:
                drop_partition(spark, table, "event_date", gone)
        return GoldWrite(dates, nothing)
    every = read_table(spark, lake.silver, "silver")
    scope = every.where(_in_dates("dt", holders))
    away: list[str] = []
    if table_exists(spark, lake.moved):
        # copies of moved events on other days take part in the dedup, wherever they are
        moved = spark.read.parquet(lake.moved)
        away = [d for d in _dates(moved, "dt") if d not in holders]
        if away:
            rest = every.where(_in_dates("dt", away)).join(moved.select("event_id").distinct(), "event_id", "left_semi")
            scope = scope.unionByName(rest.select(*scope.columns))
    repeats = repeats or store_repeats(spark, lake, [*holders, *away])
    w3 = last_copies(spark, scope, repeats).where(_in_dates("event_date", dates))
    fine_path = scratch_path(spark, "fine-counts")
    gold.grain_counts(w3, gold.FINE_KEYS).write.parquet(fine_path)
    fine = spark.read.parquet(fine_path)
    files = gold_files(fine)
    made = Observation("gold")
    observed = [F.collect_set("event_date").alias("dates"), *(quality.gold_figures(day) if day in touched else [])]
    write_gold(gold.campaign_daily_from_counts(fine), target.campaign_daily, "campaign_id", "market", files=files, observe=(made, observed))
    write_gold(gold.pod_fill_from_counts(fine), target.pod_fill, "pod_id", "content_id", files=files)
    got = made.get
    left = {str(d) for d in (got.get("dates") or [])}
    for gone in sorted(touched - left):
        drop_partition(spark, target.campaign_daily, "event_date", gone)
        drop_partition(spark, target.pod_fill, "event_date", gone)
    drop_folder(spark, fine_path)
    if repeats:
        drop_folder(spark, repeats.path)
    return GoldWrite(dates, {k: int(got.get(k) or 0) for k in nothing} if nothing else None)


def gold_files(fine: DataFrame) -> dict[str, int]:
    """Files of each event date, from its rows at the fine grain: one per ``GOLD_ROWS_PER_FILE``."""
    sizes = fine.groupBy("event_date").count().collect()  # one row per date
    return {str(r["event_date"]): max(1, -(-r["count"] // GOLD_ROWS_PER_FILE)) for r in sizes}


def write_gold(
    mart: DataFrame,
    path: str,
    *order: str,
    mode: str = "dynamic",
    files: dict[str, int] | None = None,
    observe: tuple[Observation, list[Column]] | None = None,
) -> None:
    """Replace the mart's event dates: ``files`` of each date (default one), each in ``order``.

    Rows are dealt by date and a salt over the ordering keys, as wide as the date
    needs, so a day's size sets no single task's load and the number of files does not follow
    the number of shuffle partitions. The sort starts with the partition column, as
    the writer asks for, so the rest of the order survives. ``observe`` sits
    behind the exchange, on the write's own stage, whose tasks count once.
    """
    wide = {d: n for d, n in (files or {}).items() if n > 1}
    salts = F.lit(1)
    if wide:
        known = F.create_map(*[F.lit(x) for d, n in wide.items() for x in (d, n)])
        salts = F.coalesce(F.try_element_at(known, F.col("event_date").cast("string")), F.lit(1))
    dealt = mart.repartition("event_date", F.pmod(F.xxhash64(*order), salts)).sortWithinPartitions("event_date", *order)
    if observe:
        dealt = dealt.observe(observe[0], *observe[1])
    dealt.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("event_date").parquet(path)


# --- flows (G3, G4) ------------------------------------------------------------------


def _stored_ids(spark: SparkSession, lake: Lake, dts: list[str]) -> DataFrame | None:
    """The ids of days about to be rewritten, copied to a table of their own first."""
    held = {d for d, _ in date_pairs(spark, lake)}
    ids = _ids(spark, lake, [d for d in dts if d in held])
    if ids is None:
        return None
    path = scratch_path(spark, "old-ids")
    ids.write.parquet(path)
    return spark.read.schema("event_id string").parquet(path)


def run_day(spark: SparkSession, lake: Lake, rows: DataFrame, ds: str, gate: bool = True) -> list[str]:
    """G3 for one arrival day: silver(dt=ds) -> gold for touched dates -> gate.

    A day without input rows raises ``ValueError`` and changes nothing, a day
    that fails its gate ``GateFailed``."""
    touched, report = run_day_observed(spark, lake, rows, ds)
    if gate:
        quality.enforce(report, ds)
    return touched


def run_day_observed(spark: SparkSession, lake: Lake, rows: DataFrame, ds: str) -> tuple[list[str], DataFrame]:
    """The day flow; returns the touched dates and the day's gate report.

    The report is made of what the two writes observed: no job reads silver for
    it. Only a day whose own event date the run did not touch has its mart
    figures read, from the one gold partition.
    """
    day_rows = rows.where(F.col("dt") == F.lit(ds).cast("date"))
    before, old = date_pairs(spark, lake), _stored_ids(spark, lake, [ds])
    written = observe_silver(spark, lake, day_rows)
    if not written.found:  # a missing delivery must not pass for a day that was run
        raise ValueError(f"no input rows for {ds}")
    made = observe_gold(spark, lake, written.dts, before, old, day=ds)
    figures = made.figures
    if figures is None and table_exists(spark, lake.campaign_daily):
        mart = read_table(spark, lake.campaign_daily, "campaign_daily").where(_in_dates("event_date", [ds]))
        figures = mart.agg(*quality.gold_figures(ds)).first().asDict()
    return made.dates, quality.observed_report(spark, ds, written.figures, figures)


def _in_range(rows: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start:
        rows = rows.where(F.col("dt") >= F.lit(start).cast("date"))
    if end:
        rows = rows.where(F.col("dt") <= F.lit(end).cast("date"))
    return rows


def _written_days(spark: SparkSession, lake: Lake, scoped: DataFrame, start: str | None, end: str | None) -> list[str]:
    """Write silver of a range in one job; the write itself tells whether there was any input."""
    written = observe_silver(spark, lake, scoped)
    if not written.found:
        raise ValueError(f"no input rows from {start} to {end}")
    return written.dts


def run_range(
    spark: SparkSession,
    lake: Lake,
    rows: DataFrame,
    start: str | None = None,
    end: str | None = None,
    chunk_days: int | None = None,
) -> list[str]:
    """Backfill: silver for every arrival day in [start, end], then one gold refresh.

    By default the silver is one multi-day job. ``chunk_days`` splits it into
    jobs of that many consecutive days, which bounds the files each task writes
    (one per day it holds) on very long ranges; the gold refresh still runs once
    over every touched event date.
    """
    scoped = _in_range(rows, start, end)
    if chunk_days and scoped.isEmpty():
        raise ValueError(f"no input rows from {start} to {end}")
    before = date_pairs(spark, lake)
    held = sorted({d for d, _ in before if (not start or d >= start) and (not end or d <= end)})
    old = _stored_ids(spark, lake, held)
    if not chunk_days:
        return refresh_gold(spark, lake, _written_days(spark, lake, scoped, start, end), before, old)
    days = _dates(scoped, "dt")
    written: list[str] = []
    for i in range(0, len(days), chunk_days):
        part = days[i : i + chunk_days]
        written += write_silver(spark, lake, scoped.where(_in_dates("dt", part)))
    return refresh_gold(spark, lake, written, before, old)


def run_range_gated(spark: SparkSession, lake: Lake, rows: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Backfill with a gate per day: gold of a date is published only if the date passes.

    Silver is written for every arrival day in the range. The marts of all touched
    dates go to a staging folder beside the lake's gold; each date is gated on its
    staged rows and its silver, and the partitions of those that pass are moved over the
    old ones. A date that fails keeps the gold it had. Returns a row per touched
    date: ``ds, passed, message``. A run that stops half way has moved whole
    dates only; running it again finishes the rest.
    """
    scoped = _in_range(rows, start, end)
    before = date_pairs(spark, lake)
    old = _stored_ids(spark, lake, sorted({d for d, _ in before if (not start or d >= start) and (not end or d <= end)}))
    dts = _written_days(spark, lake, scoped, start, end)
    stage = Lake(f"{lake.root}/_staging-{uuid.uuid4().hex[:12]}")
    dates = observe_gold(spark, lake, dts, before, old, target=stage).dates
    verdicts = []
    if dates:
        s = read_table(spark, lake.silver, "silver").where(_in_dates("dt", dates))
        mart = read_table(spark, stage.campaign_daily, "campaign_daily") if table_exists(spark, stage.campaign_daily) else None
        if mart is None:  # every touched date ended without rows
            mart = read_table(spark, lake.campaign_daily, "campaign_daily").limit(0)
        report = quality.gate_verdicts(quality.gate_report(s, mart, dates)).collect()  # one row per date
        verdicts = sorted((str(r["ds"]), r["passed"], r["message"]) for r in report)
    for ds, passed, _ in verdicts:
        if passed:
            for staged, table in ((stage.campaign_daily, lake.campaign_daily), (stage.pod_fill, lake.pod_fill)):
                move_partition(spark, staged, table, "event_date", ds)
    drop_folder(spark, stage.root)
    return spark.createDataFrame(verdicts, "ds string, passed boolean, message string").withColumn("ds", F.to_date("ds"))


def move_partition(spark: SparkSession, staged: str, table: str, col: str, value: str) -> None:
    """Put a staged partition folder in the place of a table's; the old one goes only when the new one stands."""
    jvm = spark._jvm
    new, place = (jvm.org.apache.hadoop.fs.Path(f"{root}/{col}={value}") for root in (staged, table))
    aside = jvm.org.apache.hadoop.fs.Path(f"{table}/_old-{uuid.uuid4().hex[:12]}")  # readers skip names with _
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(place.getParent())
    had = fs.exists(place)
    if had and not fs.rename(place, aside):
        raise OSError(f"cannot set {place} aside")
    if not fs.rename(new, place):
        if had:
            fs.rename(aside, place)
        raise OSError(f"cannot move {new} to {place}")
    if had:
        fs.delete(aside, True)


def gate_report(spark: SparkSession, lake: Lake, dts: list[str] | None = None) -> DataFrame:
    """Q1-Q8 over the lake (all days, or the given arrival days)."""
    s = read_table(spark, lake.silver, "silver")
    mart = read_table(spark, lake.campaign_daily, "campaign_daily") if table_exists(spark, lake.campaign_daily) else None
    if dts:
        s = s.where(_in_dates("dt", dts))
        if mart is not None:
            mart = mart.where(_in_dates("event_date", dts))
    return quality.gate_report(s, mart, dts)


def latest_partition(spark: SparkSession, path: str, col: str = "dt") -> DataFrame:
    """The newest partition value of a written table (reads no data columns)."""
    return read_table(spark, path).agg(F.max(col).alias(f"latest_{col}"))


def health(spark: SparkSession, lake: Lake) -> DataFrame:
    """Which gold tables exist."""
    rows = [(name, table_exists(spark, path)) for name, path in (("campaign_daily", lake.campaign_daily), ("pod_fill", lake.pod_fill))]
    return spark.createDataFrame(rows, "table string, available boolean")
