"""Writers."""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatgrid.operators.encoding import vectors_as_text
from seatgrid.session import PACKED_TABLE, PACKED_TEXT

BUCKET = "bucket"
STAMP = "%Y_%m_%d_%H_%M_%S"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # folder of the rows without an event
PLAIN = (T.NumericType, T.BooleanType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 400
TASK_FILES = 1024  # of a split read whole; Spark keeps something of every file until its task ends


def run_path(base: str, label: str, ts: datetime | None = None) -> str:
    """``<base>/<label>_<UTC stamp>.parquet``."""
    ts = ts or datetime.now(timezone.utc)
    if ts.tzinfo is not None:
        ts = ts.astimezone(timezone.utc)
    return f"{base.rstrip('/')}/{label}_{ts.strftime(STAMP)}.parquet"


def write_parquet_run(df: DataFrame, base: str, label: str, ts: datetime | None = None) -> str:
    """Writes a run and returns its path; an existing run is an error."""
    path = run_path(base, label, ts)
    df.write.mode("errorifexists").options(**PACKED_TABLE).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = False, packed: bool = False) -> None:
    """CSV export, in gzip files if ``packed``. Vectors have no CSV form and go in as text."""
    options = {"header": header, **(PACKED_TEXT if packed else {})}
    vectors_as_text(df).write.mode("errorifexists").options(**options).csv(path)


def _bucket(column: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column.cast("string")), F.lit(buckets)).cast("int")


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder on a mounted file system, else None."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(place).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _plain_folders(rows: DataFrame, column: str) -> bool:
    """Whether folder names need no escapes and every other column has one CSV form."""
    kinds = {field.name: field.dataType for field in rows.schema}
    values = [kind for name, kind in kinds.items() if name != column]
    return (
        len(kinds) == len(rows.columns) and bool(values) and all(isinstance(kind, PLAIN) for kind in values)
        and isinstance(kinds.get(column), T.IntegralType) and re.fullmatch(r"\w+", column, re.ASCII) is not None
    )


def _write_folders(rows: DataFrame, path: str, column: str, max_records_per_file: int) -> None:
    """CSV files with a header in ``column=value`` folders, for rows that lie in order of ``column`` within each partition.

    Spark writes the lines, tasks put them into files. All goes to a hidden folder beside ``path`` that gets its name when every task
    is done; a file gets its name when it is whole, and a repeated task gives its files the same names.
    """
    if os.path.lexists(path):
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] Path file:{path} already exists.")
    run, (parent, name) = uuid.uuid4().hex, os.path.split(path.rstrip("/"))
    stage = f"{parent}/.{name}-{run}"
    columns = [other for other in rows.columns if other != column]
    names = F.to_csv(F.struct(*[F.lit(other).alias(f"c{at}") for at, other in enumerate(columns)]))
    header = f"{rows.sparkSession.range(1).select(names).first()[0]}\n".encode()
    line = F.to_csv(F.struct(*[rows[f"`{other.replace('`', '``')}`"] for other in columns]))
    lines = rows.select(
        F.coalesce(F.col(column).cast("string"), F.lit(NO_VALUE)).alias("value"), F.concat(line, F.lit("\n")).cast("binary").alias("line")
    )

    def write(batches: Iterator) -> Iterator:  # names nothing of this module, so workers need not have it
        import os
        from itertools import pairwise

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        task = TaskContext.get()
        part, attempt = f"part-{task.partitionId():05d}-{run}", task.taskAttemptId()
        value, file, part_no, held, files = None, None, 0, 0, 0

        def close() -> None:
            file.close()
            os.replace(file.name, f"{stage}/{column}={value}/{part}.c{part_no:03d}.csv")

        for batch in batches:
            if not batch.num_rows:
                continue
            packed = batch.column(1).cast(pa.large_binary())
            _, at, data = packed.buffers()
            at, data = np.frombuffer(at, "<i8", len(packed) + 1, 8 * packed.offset).tolist(), memoryview(data)
            runs = pc.run_end_encode(batch.column(0))
            ends = [0, *runs.run_ends.to_pylist()]
            for (first, last), own in zip(pairwise(ends), runs.values.to_pylist()):
                while first < last:
                    if file is None or own != value or 0 < max_records_per_file <= held:
                        if file is not None:
                            close()
                        part_no = part_no + 1 if own == value else 0
                        value, held, files = own, 0, files + 1
                        folder = f"{stage}/{column}={value}"
                        try:
                            os.mkdir(folder)
                        except FileExistsError:
                            pass
                        file = open(f"{folder}/.{part}.c{part_no:03d}-{attempt}", "wb")
                        file.write(header)
                    end = min(last, first + max_records_per_file - held) if max_records_per_file > 0 else last
                    file.write(data[at[first] : at[end]])
                    held, first = held + end - first, end
        if file is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    os.makedirs(stage)
    try:
        lines.mapInArrow(write, "files bigint").agg(F.sum("files")).collect()
        open(f"{stage}/_SUCCESS", "wb").close()
        os.rename(stage, path)
    except BaseException:
        shutil.rmtree(stage, ignore_errors=True)
        raise


def split_by_event(df: DataFrame, path: str, file_format: str = "csv", column: str = "eventId",
                   order_by: Sequence[str] = (), max_records_per_file: int = 5_000_000, buckets: int | None = None,
                   finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """One sub-folder per event, written in a single pass, descending by ``order_by`` within each file.

    With ``buckets`` there are that many folders (``bucket=N``) in place of one per event, for data with more events
    than a file system should have folders; each holds whole events, sorted by event, and ``column`` stays in the files.
    The rebalance gathers an event's rows so that few files result, and lets adaptive execution cut a hot
    event into several tasks; with it off every task writes the events it holds. ``finish`` adds columns row by row behind the
    shuffle and the sort, which then carry only what these are made from.

    On a mounted file system Spark's writer starts a process for every folder and every file, to set permissions. CSV folders of
    whole-number events are therefore written there by the tasks themselves, in the same form; see :func:`_write_folders`.
    """
    if file_format not in ("csv", "parquet"):
        raise ValueError(f"unsupported format {file_format!r}")
    text = vectors_as_text if file_format == "csv" else lambda rows: rows
    rows, folder = text(df), column
    if buckets is not None:
        rows, folder = rows.withColumn(BUCKET, _bucket(F.col(column), buckets)), BUCKET
    rows = rows.hint("rebalance", F.col(folder))
    own = [folder] if folder == column else [folder, column]
    rows = rows.sortWithinPartitions(*own, *[F.col(name).desc_nulls_last() for name in order_by])
    rows = rows if finish is None else text(finish(rows))
    mounted = _mounted(df.sparkSession, path) if file_format == "csv" and _plain_folders(rows, folder) else None
    if mounted is not None:
        _write_folders(rows, mounted, folder, max_records_per_file)
        return
    writer = (
        rows.write.mode("errorifexists").partitionBy(folder).option("maxRecordsPerFile", max_records_per_file)
    )
    writer.option("header", True).csv(path) if file_format == "csv" else writer.parquet(path)


def event_slice(df: DataFrame, event_id: int, column: str = "eventId", buckets: int | None = None) -> DataFrame:
    """One event's rows; on a :func:`split_by_event` result only its folder is read (give the same ``buckets``)."""
    if buckets is not None:
        df = df.filter(F.col(BUCKET) == _bucket(F.lit(event_id).cast("bigint"), buckets))
    return df.filter(F.col(column) == F.lit(event_id))


def _number_folders(spark: SparkSession, path: str, column: str, schema: T.StructType) -> str | None:
    """The plain path of a split whose CSV lines tasks can read by themselves, else None.

    That is one on a mounted file system, of numbers, booleans and times, in which a line of a file is a row.
    """
    kinds = [field.dataType for field in schema if field.name != column]
    if not kinds or any(not isinstance(kind, PLAIN) or isinstance(kind, T.StringType) for kind in kinds):
        return None
    mounted = None if any(mark in name for name in schema.names for mark in "\r\n") else _mounted(spark, path)
    return mounted if mounted is not None and os.path.isdir(mounted) else None


def _read_folders(spark: SparkSession, path: str, column: str, schema: T.StructType) -> DataFrame:
    """The lines of all ``column=value`` folders under their schema, then ``column``.

    One task lists the folders and deals them out by name, the others open the files: the driver counts folders and keeps none.
    """
    with os.scandir(path) as entries:
        many = sum(1 for _ in entries)
    tasks = max(min(many, max(64, 8 * spark.sparkContext.defaultParallelism)), many // TASK_FILES, 1)

    def listed(batches: Iterator) -> Iterator:  # names nothing of this module, so workers need not have it
        import os
        from itertools import batched

        import pyarrow as pa

        for _ in batches:
            with os.scandir(path) as entries:
                for some in batched((entry.name for entry in entries if entry.name.startswith(f"{column}=")), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array([name[len(column) + 1 :] for name in some], pa.string())], names=["value"])

    def opened(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa

        values, lines = [], []

        def taken() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array(lines, pa.string())], names=["value", "line"])
            values.clear()
            lines.clear()
            return batch

        for batch in batches:
            for value in batch.column(0).to_pylist():
                folder = f"{path}/{column}={value}"
                for name in sorted(os.listdir(folder)):
                    if name[0] in "._":
                        continue
                    if not name.endswith(".csv"):
                        raise ValueError(f"no CSV file: {folder}/{name}")
                    with open(f"{folder}/{name}", encoding="utf-8", newline="\n") as file:
                        file.readline()  # the header
                        while some := file.readlines(1 << 20):
                            some = [line for line in (line.removesuffix("\n") for line in some) if line]
                            values += [value] * len(some)
                            lines += some
                            if len(lines) >= 10_000:
                                yield taken()
        yield taken()

    def quoted(name: str) -> str:
        return f"`{name.replace('`', '``')}`"

    others = [field for field in schema if field.name != column]
    folders = spark.range(0, 1, 1, 1).mapInArrow(listed, "value string").repartition(tasks, "value")
    row = F.from_csv("line", ", ".join(f"{quoted(field.name)} {field.dataType.simpleString()}" for field in others))
    rows = folders.mapInArrow(opened, "value string, line string").select("value", row.alias("row"))
    value = F.nullif("value", F.lit(NO_VALUE)).cast(schema[column].dataType)
    return rows.select(*[F.col(f"row.{quoted(field.name)}") for field in others], value.alias(column))


def read_split(spark: SparkSession, path: str, schema, file_format: str = "csv", every_event: bool = False,
               column: str = "eventId") -> DataFrame:
    """A :func:`split_by_event` result under its full declared schema.

    Spark lists the folders here, by default in a task for each; at most ``LISTING_TASKS`` share them. Making partitions of the folders
    takes the driver a time that grows with the square of their number. ``every_event`` is for reading all of them, in time linear in it:
    whole-number events come from the files' paths, so a filter on them opens every file. CSV files are then read in one piece
    each (a hot event has several) through a small buffer, as Spark opens a file it may cut with a copy of all settings. Tasks that
    Spark would give a few small files get ``TASK_FILES`` of them. Spark's driver keeps an entry for every file of a table, so CSV
    files of numbers, booleans and times on a mounted file system are listed and opened by tasks; see :func:`_read_folders`.
    """
    schema = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    by_path = every_event and isinstance({field.name: field.dataType for field in schema}.get(column), T.IntegralType)
    mounted = _number_folders(spark, path, column, schema) if by_path and file_format == "csv" else None
    if mounted is not None:
        return _read_folders(spark, mounted, column, schema)
    reader, before = spark.read, spark.conf.get(LISTING)
    if by_path:
        reader = reader.option("recursiveFileLookup", True)
        if file_format == "csv":
            reader = reader.options(multiLine=True, inputBufferSize=16384)
    reader = reader.schema(T.StructType([field for field in schema if not by_path or field.name != column]))
    spark.conf.set(LISTING, str(min(int(before), LISTING_TASKS)))
    try:
        rows = reader.option("header", True).csv(path) if file_format == "csv" else reader.parquet(path)
    finally:
        spark.conf.set(LISTING, before)
    if not by_path:
        return rows
    value = F.substring_index(F.substring_index(F.col("_metadata.file_path"), f"/{column}=", -1), "/", 1)
    value = F.nullif(value, F.lit(NO_VALUE)).cast(schema[column].dataType)
    rows, conf = rows.withColumn(column, value), spark._jsparkSession.sessionState().conf()
    small = max(1, conf.filesMaxPartitionBytes() // conf.filesOpenCostInBytes()) if conf.filesOpenCostInBytes() else TASK_FILES
    least = max(64, 8 * spark.sparkContext.defaultParallelism)
    return rows.coalesce(max(least, rows.rdd.getNumPartitions() // max(1, TASK_FILES // small)))
