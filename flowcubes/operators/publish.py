"""Publication (P1-P5): validated, stamped, atomically switched tables.

A run writes every table under ``<root>/runs/<run id>/<table>``, checks the
row counts it reads back against the counts it wrote, and only then points
``<root>/_current`` at the new run. Each run that passed has a manifest beside
its tables (table, rows, files, run stamp): vintages are read from there, and a
run whose stamp is older than the published one is refused. Readers resolve the pointer, so no table
is ever empty or half-written from their side. Old runs stay readable until
they are cleaned up by the caller.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from . import ingest, quality

CHUNK_ROWS = 50_000
# Day folders for the published orders: worth it once a day holds gigabytes.
PARTITION_ORDERS_BY_DAY = False
# Cube tables written at the same time (independent jobs over the written orders).
CUBE_WRITERS = 6
MANIFEST = "manifest"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _run_id(run_ts: str) -> str:
    """A folder name of this attempt alone: a rerun of the same stamp never
    writes where readers may look."""
    return f"{run_ts.replace(' ', 'T').replace(':', '').replace('-', '')}-{uuid.uuid4().hex}"


def published_frame(name: str, df: DataFrame, run_ts: str) -> DataFrame:
    """Stamp and project a table to its published schema. The order table
    also keeps the silver columns (``day`` partition key, ``lt_num``, exact
    USD) that cubes are rebuilt from."""
    stamped = ingest.stamp_run(df, run_ts)
    schema = schemas.table_schema(name)
    if name == schemas.ORDERS_TABLE:
        extras = [f for f in schemas.SILVER_EXTRAS.fields if f.name in df.columns]
        schema = schemas.T.StructType(list(schema.fields) + extras)
    return ingest.project(stamped, schema)


def refresh(spark: SparkSession, orders: DataFrame, root: str,
            run_ts: dt.datetime | str | None = None, dry_run: bool = False,
            fmt: str = "parquet", max_gap: int = quality.MAX_DAY_GAP) -> dict[str, int]:
    """The whole run from silver orders.

    The orders are written once under the new (still invisible) run
    directory and all six cubes are rebuilt from that written copy in one pass, so
    lineage is cut there and a lost executor recomputes from files, not from
    the ingest joins. Null and row counts are observed while each table is
    written (one pass, no re-scan); the landed row counts come back from the
    files, and only when every check passes does the pointer switch.
    ``dry_run`` builds and validates without writing."""
    from . import cubes

    run_ts = str(run_ts or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))
    if dry_run:
        tables = {t: cubes.named_cube(orders, t) for t in schemas.CUBE_DIMENSIONS}
        tables[schemas.ORDERS_TABLE] = orders
        tables = {name: published_frame(name, df, run_ts) for name, df in tables.items()}
        health = quality.table_health(tables).collect()
        quality.check_health(health, tables.__getitem__)
        quality.check_day_gaps(tables["daily_total"], max_gap)
        return {r["table"]: int(r["rows"]) for r in health}
    _refuse_older(spark, root, run_ts)
    run_dir = f"{root}/runs/{_run_id(run_ts)}"
    path = f"{run_dir}/{schemas.ORDERS_TABLE}"
    with _shuffles_dropped(spark):
        health = {schemas.ORDERS_TABLE: _write_checked(
            published_frame(schemas.ORDERS_TABLE, orders, run_ts), schemas.ORDERS_TABLE, path, fmt)}
    silver = spark.read.format(fmt).load(path)
    # One shuffle of the written orders makes all six cubes; they are kept
    # beside the tables until each has been written from there.
    staged = f"{run_dir}/_cubes"
    parts = max(1, -(-health[schemas.ORDERS_TABLE]["rows"] // cubes.ORDERS_PER_TASK))
    with _shuffles_dropped(spark):
        busy = cubes.busy_days(silver.groupBy(cubes.DAY).agg(F.count(F.lit(1)).alias("orders")))
        cubes.all_cubes_one_pass(silver, parts=parts, busy=busy).write.option("compression", "zstd").parquet(staged)
    made = spark.read.parquet(staged)
    # The six write jobs are independent; they are submitted together so small
    # stages of one overlap with another.
    with ThreadPoolExecutor(max_workers=CUBE_WRITERS) as pool:
        jobs = {
            name: pool.submit(_write_checked, published_frame(name, cubes.split_cubes(made, name), run_ts),
                              name, f"{run_dir}/{name}", fmt)
            for name in schemas.CUBE_DIMENSIONS
        }
        health.update({name: job.result() for name, job in jobs.items()})
    fs, at = _hadoop_fs(spark, staged)
    fs.delete(at, True)
    # V1 / V2 from the values observed while writing: no second scan.
    quality.check_health([row for name, values in health.items() for row in quality.health_rows(name, values)],
                         lambda name: spark.read.format(fmt).load(f"{run_dir}/{name}"))
    quality.check_day_gaps(spark.read.format(fmt).load(f"{run_dir}/daily_total"), max_gap)
    written = {name: int(values["rows"]) for name, values in health.items()}
    _seal(spark, root, run_dir, run_ts, written, fmt)
    return written


def _landed(spark: SparkSession, run_dir: str, names: list[str], fmt: str) -> DataFrame:
    """``table, rows, files`` read back in one job: the scans select no data
    column, so Parquet answers from row-group metadata."""
    tagged = None
    for name in names:
        one = spark.read.format(fmt).load(f"{run_dir}/{name}").select(
            F.lit(name).alias("table"), F.col("_metadata.file_path").alias("file"))
        tagged = one if tagged is None else tagged.unionByName(one)
    per_file = tagged.groupBy("table", "file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("table").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("files"))


def _seal(spark: SparkSession, root: str, run_dir: str, run_ts: str, written: Mapping[str, int], fmt: str) -> None:
    """V6 on the landed files, then the manifest, then the pointer."""
    landed = {r["table"]: r for r in _landed(spark, run_dir, list(written), fmt).collect()}
    for name, sent in written.items():
        here = landed[name]["rows"] if name in landed else 0
        if here != sent:
            raise quality.PublishError(f"{name}: wrote {sent} rows but {here} landed; not switching")
    rows = [(name, sent, landed[name]["files"] if name in landed else 0) for name, sent in written.items()]
    (spark.createDataFrame(rows, "table string, rows bigint, files bigint").coalesce(1)
     .withColumn("run_ts", F.lit(run_ts).cast("timestamp")).withColumn("run", F.lit(run_dir.rsplit("/", 1)[1]))
     .write.parquet(f"{run_dir}/{MANIFEST}"))
    _set_pointer(spark, root, run_dir)


def vintages(spark: SparkSession, root: str) -> DataFrame:
    """The manifests of every run that passed: ``table, rows, files, run_ts,
    run`` and whether it is the one that readers see."""
    run_dir = current_run(spark, root)
    if run_dir is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return spark.read.parquet(f"{root}/runs/*/{MANIFEST}").withColumn(
        "current", F.col("run") == F.lit(run_dir.rsplit("/", 1)[1]))


def published_freshness(spark: SparkSession, root: str) -> DataFrame:
    """Q23 / V7 of the published run from its manifest; no table is read."""
    now = vintages(spark, root).where("current")
    return now.agg(F.max("run_ts").alias("refreshed_at"), F.count_distinct("run_ts").alias("distinct_vintages"))


def damaged_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Tables of the published run that no longer hold the rows and files that
    its manifest names."""
    run_dir = current_run(spark, root)
    sealed = vintages(spark, root).where("current").select("table", "rows", "files")
    held = _landed(spark, run_dir, [r["table"] for r in sealed.collect()], fmt).select(
        "table", F.col("rows").alias("held_rows"), F.col("files").alias("held_files"))
    return sealed.join(held, "table", "left").where(
        ~(F.col("rows").eqNullSafe(F.col("held_rows")) & F.col("files").eqNullSafe(F.col("held_files"))))


def _refuse_older(spark: SparkSession, root: str, run_ts: str) -> None:
    run_dir = current_run(spark, root)
    fs, manifest = _hadoop_fs(spark, f"{run_dir}/{MANIFEST}") if run_dir else (None, None)
    if run_dir and fs.exists(manifest):
        newer = (spark.read.parquet(f"{run_dir}/{MANIFEST}").where(F.col("run_ts") > F.lit(run_ts).cast("timestamp"))
                 .select(F.col("run_ts").cast("string").alias("ts")).limit(1).collect())
        if newer:
            raise quality.PublishError(f"a run of {newer[0]['ts']} is published; refusing one of {run_ts}")


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a write has shuffled leaves the disks as soon as it is over, not
    when the driver happens to collect its garbage: the next step needs only
    the written files."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def _sorted_by_day(df: DataFrame, fmt: str) -> DataFrame:
    """No extra shuffle: each task sorts its own rows by day, so Parquet row
    groups carry narrow day ranges that day predicates skip."""
    return df.sortWithinPartitions("day") if "day" in df.columns and fmt != "json" else df


def _write_checked(df: DataFrame, name: str, path: str, fmt: str) -> dict[str, int]:
    """Write one table and return its health values (row count and NULL
    counts of the non-nullable columns), observed during the write itself."""
    obs = Observation(f"health_{name}_{uuid.uuid4().hex}")
    writer = _sorted_by_day(df, fmt).observe(obs, *quality.health_aggregates(name, df)).write.mode("errorifexists")
    if name == schemas.ORDERS_TABLE and PARTITION_ORDERS_BY_DAY:
        writer = writer.partitionBy("day")
    if fmt == "parquet":  # every run is kept
        writer = writer.option("compression", "zstd")
        for column in schemas.PER_ORDER if name == schemas.ORDERS_TABLE else ():
            writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.format(fmt).save(path)
    return {k: int(v) for k, v in obs.get.items()}


def _write(df: DataFrame, path: str, fmt: str, partition_by_day: bool = False) -> int:
    """Write and return the row count observed while writing (V6).

    Rows are sorted by ``day`` within each task's file (see
    ``_sorted_by_day``), so day predicates skip row groups through Parquet
    min/max statistics without one directory per day. ``partition_by_day``
    adds day directories, worth it when a day holds gigabytes."""
    df = _sorted_by_day(df, fmt)
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    if partition_by_day and "day" in df.columns:
        writer = writer.partitionBy("day")
    if fmt == "json":
        writer = writer.option("maxRecordsPerFile", CHUNK_ROWS)
    writer.format(fmt).save(path)
    return int(obs.get["rows"])


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _set_pointer(spark: SparkSession, root: str, run_dir: str) -> None:
    """Write ``_current`` beside its place and rename it over the old one in
    one step, so that a reader always finds either pointer whole."""
    fs, final = _hadoop_fs(spark, f"{root}/_current")
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(f"{root}/_current.{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(run_dir.encode("utf-8")))
    out.close()
    options = jvm.org.apache.hadoop.fs.Options
    overwrite = spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 1)
    overwrite[0] = getattr(options, "Rename").OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(tmp), context.makeQualified(final), overwrite)


def current_run(spark: SparkSession, root: str) -> str | None:
    fs, p = _hadoop_fs(spark, f"{root}/_current")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    reader = spark.sparkContext._jvm.java.io.BufferedReader(
        spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    line = reader.readLine()
    reader.close()
    return line


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    run_dir = current_run(spark, root)
    if run_dir is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return spark.read.format(fmt).load(f"{run_dir}/{name}")


def full_refresh(spark: SparkSession, tables: Mapping[str, DataFrame], root: str,
                 run_ts: dt.datetime | str | None = None, dry_run: bool = False,
                 fmt: str = "parquet") -> dict[str, int]:
    """Validate every table, then (unless ``dry_run``) write all of
    them under a new run directory, reconcile, and switch the pointer.

    Unknown table names are fatal here (V5), and so is a table that is left
    out. Returns rows per table."""
    unknown = [n for n in tables if n not in schemas.TABLES]
    if unknown:
        raise quality.PublishError(f"no schema for table(s) {unknown}")
    absent = [n for n in schemas.TABLES if n not in tables]
    if absent:  # a switch would hide them from readers
        raise quality.PublishError(f"table(s) {absent} are not in this run; a run publishes all of {list(schemas.TABLES)}")
    run_ts = str(run_ts or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))
    # Projected first, so a required column that a table lacks is seen as NULL and refused.
    ready = {name: published_frame(name, df, run_ts) for name, df in tables.items()}
    quality.check_day_texts(tables)
    quality.validate(ready)
    if dry_run:
        health = quality.table_health(ready).select("table", "rows").distinct().collect()
        return {r["table"]: int(r["rows"]) for r in health}
    _refuse_older(spark, root, run_ts)
    run_dir = f"{root}/runs/{_run_id(run_ts)}"
    written = {name: _write(df, f"{run_dir}/{name}", fmt) for name, df in ready.items()}
    _seal(spark, root, run_dir, run_ts, written, fmt)
    return written


def write_ndjson(df: DataFrame, path: str) -> int:
    """Newline-delimited JSON in files of at most 50,000 rows."""
    return _write(df, path, "json")


def trim_recent(orders: DataFrame, as_of: str, keep_days: int) -> DataFrame:
    """Orders of the last ``keep_days`` days before ``as_of`` (cubes keep
    all time): a predicate on ``day``, which prunes the day folders of a table
    written with them and row groups elsewhere."""
    as_of_d = F.lit(as_of).cast("date")
    return orders.where((F.col("day") >= F.date_sub(as_of_d, keep_days)) & (F.col("day") < as_of_d))


def rewrite_recent(df: DataFrame, path: str, as_of: str, recent_days: int, fmt: str = "parquet") -> None:
    """P5: history is append-only; the days from ``recent_days`` before
    ``as_of`` up to ``as_of`` are replaced as a whole (late finalizations
    change them): days with rows by dynamic partition overwrite, and days that
    have none any more lose their folder. ``recent_days`` must cover the
    late-finalization tail. Rows after ``as_of`` are refused."""
    spark = df.sparkSession
    first = F.date_sub(F.lit(as_of).cast("date"), recent_days)
    recent = df.where(F.col("day") >= first)
    days = {r["day"].isoformat() for r in recent.select("day").distinct().limit(recent_days + 2).collect()}
    if any(d > as_of for d in days):
        raise quality.PublishError(f"rows after {as_of} in the recent window; refusing to rewrite")
    recent.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").format(fmt).save(path)
    fs, _ = _hadoop_fs(spark, path)
    start = dt.date.fromisoformat(as_of) - dt.timedelta(days=recent_days)
    for i in range(recent_days + 1):
        day = (start + dt.timedelta(days=i)).isoformat()
        if day not in days:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/day={day}"), True)


def split_history(df: DataFrame, as_of: str, recent_days: int) -> tuple[DataFrame, DataFrame]:
    """The two halves a P5 table is made of: (history, recent)."""
    cut = F.date_sub(F.lit(as_of).cast("date"), recent_days)
    return df.where(F.col("day") < cut), df.where(F.col("day") >= cut)


def register_views(spark: SparkSession, root: str, prefix: str = "", fmt: str = "parquet") -> list[str]:
    """Temporary views over the current run's tables (``<prefix><table>``),
    so existing SQL runs unchanged against the published data."""
    names = []
    for name in schemas.TABLES:
        read_table(spark, root, name, fmt).createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names
