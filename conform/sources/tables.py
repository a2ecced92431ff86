"""Table writes: replace-by-batch partitions, published snapshots, clustered serving layout, metrics."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_observed(df: DataFrame, write, name: str = "write", extra: Sequence | None = None) -> dict:
    """Run ``write(df_observed)`` and return metrics gathered during that same job.

    The row count comes from an ``Observation`` on the written rows, so no second scan
    (``count()`` after the write) is needed.
    """
    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    write(df.observe(obs, F.count(F.lit(1)).alias("rows"), *(extra or [])))
    return obs.get


CODEC = "zstd"  # of all tables and stored intermediate rows; about three quarters of Spark's default in bytes
FILE_ROWS = 1_000_000  # of a raw file: a drop in one packed file is read by one task, its rows by several
LOAD_COL = "load"
BATCH, STREAM = "batch", "stream"  # kinds of loads; a load's name starts with its kind
RAW_PARTITIONS = ("utility_id", "batch_date", LOAD_COL)
RAW_TYPES = {"utility_id": T.StringType(), "batch_date": T.DateType(), LOAD_COL: T.StringType()}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the table store, if it is there."""
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, p, _ = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()] if fs.exists(p) else []


def partition_replace(df: DataFrame, path: str, partition_cols: Sequence[str] = ("utility_id", "batch_date"),
                      fmt: str = "parquet", fixed: dict[str, Column] | None = None, together: bool = False) -> dict:
    """Write rows into a partitioned table, replacing only the partitions present in ``df``.

    Dynamic partition overwrite: partitions that ``df`` has rows for are replaced, all others stay. The
    rows are first balanced by partition (AQE merges small and splits large ones), so a partition gets
    files of a sensible size, not one from every task. ``fixed`` gives the values of all partition columns, for rows of a single partition:
    there is nothing to bring together then, so the rows are neither shuffled nor sorted and every task writes files of its
    own rows, of at most ``FILE_ROWS``. ``together`` says that ``df`` is read from files that each hold rows of few partitions: they
    aren't shuffled either, and a task writes a file for each partition it meets. Returns ``{"rows": n}``.
    """
    def _w(d: DataFrame):
        # the values come last: the writer sorts by partition columns unless it sees that they are literals
        (d.withColumns(fixed or {}).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
         .option("maxRecordsPerFile", FILE_ROWS if fixed else 0)
         .partitionBy(*partition_cols).format(fmt).save(path))
    rows = df.drop(*fixed) if fixed else df if together else df.hint("rebalance", *partition_cols)
    return write_observed(rows, _w, "partition_replace")


def footer_counts(spark: SparkSession, path: str, by: Sequence[str] = ("utility_id", "batch_date"), bounds: Sequence[str] = ()) -> DataFrame:
    """Rows a partition (``row_count``), and least and greatest value of the columns ``bounds``, from the files' footers alone.

    Spark's Parquet aggregate push-down reads no column data for this; it needs the newer reader, which a session of
    its own switches on, so the caller's settings stay. ``by`` may hold partition columns only.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    more = [f(c).alias(f"{name}_{c}") for c in bounds for name, f in (("min", F.min), ("max", F.max))]
    return own.read.parquet(path).groupBy(*by).agg(F.count("*").alias("row_count"), *more)


def partition_folder(spark: SparkSession, column: str, value) -> str:
    """The folder name that Spark's writer gives a partition value (it escapes signs such as a colon or a blank)."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.getPartitionPathString(column, str(value))


def read_typed(spark: SparkSession, path: str, types: dict[str, T.DataType]) -> DataFrame:
    """A table of files whose columns have the given types where it has them.

    Spark types partition values by their looks, so a source called 007 would be read as the number 7; such a table is
    opened again with the types stated.
    """
    df = spark.read.parquet(path)
    if all(types.get(f.name, f.dataType) == f.dataType for f in df.schema.fields):
        return df
    return spark.read.schema(T.StructType([T.StructField(f.name, types.get(f.name, f.dataType), True) for f in df.schema.fields])).parquet(path)


def kind_of(load: str) -> str:
    """A load's kind; loads from before there were kinds are batches."""
    return STREAM if load.startswith(f"{STREAM}-") else BATCH


def load_batch(df: DataFrame, path: str, source_id: str, batch_date, load: str, kind: str = BATCH) -> dict:
    """Write one load of one (source, batch) of a raw table; ``df`` holds rows of that source and batch only.

    Raw tables have one layout for batch and streaming: ``utility_id / batch_date / load``. A load of the kind ``batch`` stands for
    the whole drop: it takes the place of all earlier batch loads, and an empty one clears them. Its name holds the time of the
    load, and ``batch_scan`` reads the newest only, so readers never see two; the older ones are removed after the new one
    was written, and what a job that died in between left is removed by the next. A load of the kind ``stream`` is one
    micro-batch: it replaces an earlier attempt of itself and nothing else. The kinds don't touch each other, so a drop
    may be sent again while a stream fills the same batch.
    """
    spark = df.sparkSession
    where = "/".join([path.rstrip("/"), partition_folder(spark, "utility_id", source_id), partition_folder(spark, "batch_date", batch_date)])
    name = f"{BATCH}-{int(time.time() * 1000):015d}-{load}" if kind == BATCH else f"{STREAM}-{load}"
    own = partition_folder(spark, LOAD_COL, name)
    metrics = partition_replace(df, path, RAW_PARTITIONS, fixed={
        "utility_id": F.lit(source_id), "batch_date": F.lit(batch_date).cast("date"), LOAD_COL: F.lit(name)})
    for folder in _folders(spark, where):
        replaced = kind == BATCH and folder != own and kind_of(folder.partition("=")[2]) == BATCH
        if replaced or (folder == own and not metrics["rows"]):
            remove(spark, f"{where}/{folder}")
    return metrics


def superseded(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """(utility_id, batch_date, load) folders of batch loads that a newer one of the same batch has replaced but that are still there.

    From a listing of the folders; as a rule there are none.
    """
    fs, p, jvm = _fs(spark, path)
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    held: dict[tuple[str, str], list[str]] = {}
    for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(p, "utility_id=*/batch_date=*/load=*")) or []:
        parts = [unescape(x.partition("=")[2]) for x in st.getPath().toString().rsplit("/", 3)[1:]]
        if kind_of(parts[2]) == BATCH:
            held.setdefault((parts[0], parts[1]), []).append(parts[2])
    # names from before there were kinds have no time: any timed load is newer
    timed = lambda n: (n.startswith(f"{BATCH}-"), n)
    return [(*k, n) for k, names in held.items() for n in sorted(names, key=timed)[:-1]]


def raw_headers(spark: SparkSession, path: str) -> DataFrame:
    """(utility_id, batch_date, load, column_name) of a raw table: which columns each load has, from its own files' footers.

    A read of the whole table would take one schema for all loads. One footer a load is read, eight at a time; loads
    that a newer drop has replaced are left out.
    """
    fs, p, jvm = _fs(spark, path)
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    old, loads = set(superseded(spark, path)), {}
    for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(p, "utility_id=*/batch_date=*/load=*")) or []:
        folder = st.getPath().toString()
        key = tuple(unescape(x.partition("=")[2]) for x in folder.rsplit("/", 3)[1:])
        if key not in old:
            loads[key] = folder
    if not loads:
        return spark.createDataFrame([], "utility_id string, batch_date date, load string, column_name string")
    with ThreadPoolExecutor(max_workers=min(8, len(loads))) as pool:
        columns = pool.map(lambda folder: spark.read.parquet(folder).columns, loads.values())
        rows = [(u, day, load, c) for (u, day, load), names in zip(loads, columns) for c in names]
    return spark.createDataFrame(rows, "utility_id string, batch_date string, load string, column_name string") \
        .withColumn("batch_date", F.col("batch_date").cast("date"))


def batch_scan(spark: SparkSession, path: str, batch_date=None, run_id: str | None = None,
               source_id: str | None = None) -> DataFrame:
    """Read a raw table limited to one batch / run / source (partition pruning on the folders).

    Of a batch's loads all micro-batches count, but only the newest whole drop, also while it is being replaced. A limit on a
    column that the table lacks is an error, never ignored.
    """
    df = read_typed(spark, path, RAW_TYPES)
    for column, value in (("utility_id", source_id), ("batch_date", batch_date), ("pipeline_run_id", run_id)):
        if value is None:
            continue
        if column not in df.columns:
            raise ValueError(f"{path} has no column {column!r} to limit the scan by")
        df = df.where(F.col(column) == (F.lit(value).cast("date") if column == "batch_date" else F.lit(value)))
    if LOAD_COL in df.columns:
        for utility_id, day, load in superseded(spark, path):
            df = df.where(~((F.col("utility_id") == utility_id) & (F.col("batch_date") == F.lit(day).cast("date")) & (F.col(LOAD_COL) == load)))
    return df


def clustered(df: DataFrame, partition_col: str | None, cluster_cols: str | Sequence[str], n: int | None = None) -> DataFrame:
    """Range-partition and sort by (partition, cluster columns) before writing.

    Each output file then covers a narrow, non-overlapping range and the Parquet row-group min/max
    statistics let a filter on the first cluster column skip most files and row groups. Further cluster columns that
    make rows distinct let the ranges cut through a value that holds many rows (a hot feeder, no feeder at
    all): equal keys can't be parted otherwise.
    """
    cluster = [cluster_cols] if isinstance(cluster_cols, str) else list(cluster_cols)
    cols = [c for c in (partition_col, *cluster) if c]
    df = df.repartitionByRange(n, *cols) if n else df.repartitionByRange(*cols)
    return df.sortWithinPartitions(*cols)


def precompute(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once as a Parquet table in the shared scratch folder and read it back.

    Range partitioning samples its input in a job of its own; over an expensive plan (joins,
    dedup) that would compute it twice. The written copy (below ``spark.checkpoint.dir``) cuts the lineage, so sample and write read stored rows.
    """
    from conform.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, "materialised")
    df.write.mode("errorifexists").parquet(path, compression=CODEC)
    return spark.read.parquet(path)


def clustered_write(df: DataFrame, path: str, partition_col: str | None, cluster_cols: str | Sequence[str],
                    n: int | None = None, mode: str = "overwrite", materialise: bool = False) -> dict:
    if materialise:
        df = precompute(df)

    def _w(d: DataFrame):
        w = d.write.mode(mode).option("compression", CODEC)
        if partition_col:
            w = w.partitionBy(partition_col)
        w.parquet(path)
    # observed above the range exchange: the boundary-sampling job does not pass the observation
    return write_observed(clustered(df, partition_col, cluster_cols, n), _w, "clustered_write")


# --- published snapshots -----------------------------------------------------------------
# A derived table is a folder of immutable versions ``v<millis>-<id>``; a version counts once
# its marker file was written, after the write succeeded. Readers take the newest complete
# version, so a job that dies mid-write leaves the previous state readable, and a table can be
# rebuilt from itself (Spark refuses to overwrite a path it is reading).

MARKER = "_COMPLETE"
KEEP_VERSIONS = 3


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def snapshot_versions(spark: SparkSession, table_path: str) -> list[str]:
    """Names of the complete versions, oldest first."""
    fs, _, jvm = _fs(spark, table_path)
    return sorted(n for n in _folders(spark, table_path)
                  if n.startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{table_path.rstrip('/')}/{n}/{MARKER}")))


def current_snapshot(spark: SparkSession, table_path: str) -> str | None:
    """Path of the newest complete version; None only if nothing was ever written.

    Versions without a complete one among them are an error: taken for "no table", an upsert would publish
    its batch alone and the history would be gone.
    """
    v = snapshot_versions(spark, table_path)
    if not v and any(n.startswith("v") for n in _folders(spark, table_path)):
        raise RuntimeError(f"{table_path} has no complete version (no {MARKER} file); remove the folder to start anew")
    return f"{table_path.rstrip('/')}/{v[-1]}" if v else None


BUCKET = re.compile(r"bucket_of_(\d+)")  # the bucket column of a keyed table (sources/keyed.py)


def without_bucket(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if BUCKET.fullmatch(c)])


def read_table(spark: SparkSession, table_path: str) -> DataFrame | None:
    """The newest version of a published table, or a keyed table's rows; None if nothing was ever written."""
    cur = current_snapshot(spark, table_path)
    if cur:
        return read_typed(spark, cur, RAW_TYPES)
    if any("=" in n for n in _folders(spark, table_path)):
        return without_bucket(read_typed(spark, table_path, RAW_TYPES))
    return None


def publish(df: DataFrame, table_path: str, partition_cols: Sequence[str] = (), view: str | None = None,
            cluster_cols: str | Sequence[str] = (), materialise: bool = False, keep: int = KEEP_VERSIONS,
            bloom: dict[str, int] | None = None) -> dict:
    """Write ``df`` as the new version of a table; optionally (re)point a temp view at it.

    ``cluster_cols`` lays the version out for skipping on the first of them (``clustered``); pass
    ``materialise=True`` when ``df`` is expensive to compute, so the range sampling does not
    compute it a second time. ``bloom`` (column: distinct values expected in a file) stores a Bloom filter of the column in each
    row group, by which a look-up of a value that lies inside the group's range but isn't there skips it. The newest ``keep`` complete versions stay, older ones are removed (readers of
    an older version must have ended by then).
    """
    if cluster_cols and materialise:
        df = precompute(df)
    version = f"{table_path.rstrip('/')}/v{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:6]}"

    def _w(d: DataFrame):
        w = d.write.mode("errorifexists").option("compression", CODEC)
        if partition_cols:
            w = w.partitionBy(*partition_cols)
        for column, values in (bloom or {}).items():
            w = w.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(values))
        w.parquet(version)
    if cluster_cols:   # observed above the range exchange: the boundary-sampling job does not pass the observation
        df = clustered(df, partition_cols[0] if partition_cols else None, cluster_cols)
    metrics = write_observed(df, _w, "publish")
    spark = df.sparkSession
    fs, _, jvm = _fs(spark, version)
    fs.create(jvm.org.apache.hadoop.fs.Path(f"{version}/{MARKER}"), True).close()
    for old in snapshot_versions(spark, table_path)[:-keep]:
        remove(spark, f"{table_path.rstrip('/')}/{old}")
    if view:
        spark.read.parquet(version).createOrReplaceTempView(view)
    return {**metrics, "path": version}
