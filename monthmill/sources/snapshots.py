"""Raw CSV scans and snapshot tables: one folder per table, one partition per date."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..functions.dates import month_starts
from ..schemas import SNAPSHOT
from ..session import parquet_options
from .ledger import VERSION, Ledger, Snapshot, publish

#: The text of a CSV line that is no row of its table.
CORRUPT = "_corrupt_record"
EPOCH = date(1970, 1, 1)
#: More than the days of any one write, so that a histogram of days never joins two of them.
DAYS = 4096
#: Bytes of the files that ``gathered`` lets one task read.
GATHERED = 32 << 20
#: Bytes of compressed raw files that one task reads; it sorts their rows, of which two million take some 800 MB.
COMPRESSED_SPLIT = 32 << 20


class MissingSnapshot(LookupError):
    """A table or one of its snapshots does not exist."""


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    keep_rejects: bool = False,
    multi_line: bool | None = False,
) -> DataFrame:
    """CSV with a header, every column as text.

    Types are enforced in silver, so a dirty cell in one month never changes
    a column's type and no pass over the data is spent on inference. With
    ``columns`` the header of every file is checked against them. Quotes in a
    cell are doubled.

    ``keep_rejects`` (needs ``columns``) adds the column ``_corrupt_record``: the text of a line that has more or fewer cells
    than there are columns, NULL for all others; see ``rejects``. ``multi_line`` lets cells have line feeds, and then a file
    is read by one task; None looks for such files first and reads only these so.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if columns:
        fields = [f"`{c}` string" for c in [*columns, *([CORRUPT] if keep_rejects else [])]]
        reader = reader.schema(", ".join(fields)).option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT)
    if multi_line is not None:
        return reader.option("multiLine", multi_line).csv(path)
    whole = _files_with_open_cells(spark, path)
    if not whole:
        return reader.csv(path)
    rest = sorted({_plain(spark, f) for f in spark.read.text(path).inputFiles()} - set(whole))
    found = reader.option("multiLine", True).csv(whole)
    return found.unionByName(reader.option("multiLine", False).csv(rest)) if rest else found


def _files_with_open_cells(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files with a line that ends inside a quoted cell. One pass over the text; of it only names come back."""
    closed = F.regexp_replace("value", r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)', "$1")
    lines = spark.read.text(path).where(F.contains("value", F.lit('"'))).where(closed.rlike('(^|,)"'))
    return sorted(_plain(spark, row[0]) for row in lines.select(F.col("_metadata.file_path")).distinct().collect())


def _plain(spark: SparkSession, uri: str) -> str:
    """The path that a file's URI stands for, in one spelling."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def is_reject() -> Column:
    """Whether no snapshot gets a row of a raw table that was read with ``keep_rejects``."""
    return F.col(CORRUPT).isNotNull() | F.col(SNAPSHOT).try_cast("date").isNull()


def rejects(raw: DataFrame) -> DataFrame:
    """Rows that no snapshot gets: file, reason and the record itself.

    ``cells``: a line with more or fewer cells than the table has columns, as it stands in the file. ``date``: a row without
    a snapshot date, its cells as CSV. ``raw`` comes from ``read_csv`` with ``keep_rejects``.
    """
    cells = F.col(CORRUPT).isNotNull()
    record = F.coalesce(CORRUPT, F.to_csv(F.struct(*(F.col(f"`{c}`") for c in raw.columns if c != CORRUPT)), {"escape": '"'}))
    lost = raw.where(is_reject())
    reason = F.when(cells, "cells").otherwise("date")
    return lost.select(F.input_file_name().alias("file"), reason.alias("reason"), record.alias("record"))


def month_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Month starts from the month of ``start`` up to and including ``end``."""
    bounds = spark.range(1).select(F.lit(date.fromisoformat(start)).alias("a"), F.lit(date.fromisoformat(end)).alias("b"))
    return spine_between(bounds, "a", "b")


def spine_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """The same for the dates in two columns of ``bounds``."""
    return bounds.select(F.explode(month_starts(F.col(first), F.col(last))).alias(SNAPSHOT))


def snapshot_dates(start: str, end: str) -> list[str]:
    """The spine as text, for job arguments and partition filters."""
    day, last, dates = date.fromisoformat(start).replace(day=1), date.fromisoformat(end), []
    while day <= last:
        dates.append(day.isoformat())
        day = date(day.year + day.month // 12, day.month % 12 + 1, 1)
    return dates


def at_snapshots(df: DataFrame, dates: list[str] | None) -> DataFrame:
    """The rows of the given snapshots; on a snapshot table this prunes partitions."""
    if dates is None:
        return df
    return df.where(F.col(SNAPSHOT).isin([date.fromisoformat(d) for d in dates]))


def ingest(raw: DataFrame, dates: list[str] | None = None, keep_rejects: bool = False) -> DataFrame:
    """Bronze rows: the raw columns, with a typed snapshot date, of the given snapshots.

    Rejected lines are left out, or, with ``keep_rejects``, kept without a date.
    """
    day = F.col(SNAPSHOT).try_cast("date")
    if keep_rejects:
        rows = raw.withColumn(SNAPSHOT, F.when(~is_reject(), day)).drop(CORRUPT)
        lost = F.col(SNAPSHOT).isNull()
        return rows if dates is None else rows.where(lost | F.col(SNAPSHOT).isin([date.fromisoformat(d) for d in dates]))
    if CORRUPT in raw.columns:
        raw = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return at_snapshots(raw.withColumn(SNAPSHOT, day), dates).where(F.col(SNAPSHOT).isNotNull())


@dataclass(frozen=True)
class Written:
    """Rows of each snapshot that a write replaced, and their NULLs by column, counted by the write itself."""

    rows: dict[str, int]
    nulls: dict[str, dict[str, int]]

    @property
    def total(self) -> int:
        return sum(self.rows.values())


def write_snapshots(
    df: DataFrame, root: str, dates: list[str] | None = None, rebalance: bool = True, format: str = "parquet"
) -> int:
    """Replace the snapshots found in ``df``, and return the number of rows; see ``publish_snapshots``."""
    return publish_snapshots(df, root, dates, rebalance, format).total


def publish_snapshots(
    df: DataFrame,
    root: str,
    dates: list[str] | None = None,
    rebalance: bool = True,
    format: str = "parquet",
    inputs: dict[str, dict[str, str]] | Callable[[DataFrame], dict[str, dict[str, str]]] | None = None,
    count_nulls: bool = False,
    lookup: str | None = None,
) -> Written:
    """Replace the snapshots found in ``df``, all at once: until the end readers see the old ones, and after a failure too.

    Other snapshots of the table stay. A date of ``dates`` without rows is replaced by an empty snapshot, so that a rerun
    leaves nothing stale. Rows without a date are not written. ``rebalance`` gathers each snapshot into files of even size
    and splits a large snapshot over many tasks; rows that already lie by snapshot do not need it. ``inputs`` (by date, or a
    function that finds them in the rows as written) and, with ``count_nulls``, the NULLs of every column are kept in the ledger. Files are sorted by the column ``lookup`` and have
    Bloom filters on it, so that a read of one of its values opens few row groups.
    """
    spark, columns = df.sparkSession, [c for c in df.columns if c != SNAPSHOT]
    seen, day = Observation(), F.unix_date(SNAPSHOT)
    # A histogram with more bins than there are days keeps an exact count of each day, so one number per day and column is
    # observed while the rows are written.
    per_day = {"": day} | {c: F.when(F.col(f"`{c}`").isNull(), day) for c in columns if count_nulls}
    out = df.where(F.col(SNAPSHOT).isNotNull())
    if rebalance:
        out = out.hint("rebalance", SNAPSHOT)
    options = {"header": True, "escape": '"'} if format == "csv" else parquet_options(columns)
    if lookup:
        out = out.sortWithinPartitions(SNAPSHOT, lookup)
        options[f"parquet.bloom.filter.enabled#{lookup}"] = True
    # Observed behind the shuffle, by the tasks that write: Spark counts each of these once, however often it was tried.
    out = out.observe(seen, *(F.histogram_numeric(v, F.lit(DAYS)).alias(f"days_{i}") for i, v in enumerate(per_day.values())))
    fields = [f for f in df.schema if f.name != SNAPSHOT]
    schema = StructType(fields).json()
    counted: dict[str, dict[str, int]] = {}

    def write(version: str) -> dict[str, Snapshot]:
        out.write.partitionBy(SNAPSHOT).options(**options).format(format).save(f"{root}/{VERSION}={version}")
        found = observed(seen)
        for i, column in enumerate(per_day):
            counted[column] = {}
            # What different tasks counted for a day may come as bins of their own.
            for x, y in found.get(f"days_{i}") or []:
                d = (EPOCH + timedelta(days=int(x))).isoformat()
                counted[column][d] = counted[column].get(d, 0) + int(y)
            if len(counted[column]) >= DAYS:
                raise ValueError(f"{DAYS} snapshots or more in one write")
        rows = counted.pop("")
        made_of = inputs
        if callable(inputs):
            read = spark.read.option("basePath", root).schema(StructType([*fields, df.schema[SNAPSHOT]]))
            made_of = inputs(read.parquet(f"{root}/{VERSION}={version}") if rows else spark.createDataFrame([], df.schema))
        return {
            d: Snapshot(version, schema, rows.get(d, 0), len(rows), {c: n[d] for c, n in counted.items() if d in n}, (made_of or {}).get(d, {}))
            for d in sorted({*(dates or []), *rows})
        }

    written = publish(spark, root, write)
    return Written({d: s.rows for d, s in written.items()}, {d: s.nulls for d, s in written.items()})


def gathered(df: DataFrame, path: str) -> DataFrame:
    """The same rows lying by snapshot, for a write without ``rebalance``: by way of files below ``path`` instead of a shuffle.

    Compressed columns of text take about a third of what a shuffle writes for the same rows. Every task first writes a file for
    each of its snapshots; neighbouring snapshots that are small together are then read by one task, large ones by several.
    """
    spark = df.sparkSession
    df.write.partitionBy(SNAPSHOT).options(**parquet_options(df.columns)).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in store.listStatus(folder) if s.getPath().getName().startswith(f"{SNAPSHOT}=")]
    schema = StructType([*(f for f in df.schema if f.name != SNAPSHOT), df.schema[SNAPSHOT]])
    return _neighbours(spark, path, sorted(f"{path}/{name}" for name in found), schema)


def read_by_snapshot(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    """The same rows as of ``read_snapshots``, lying by snapshot: a task reads the small files of one snapshot, or of neighbouring
    small ones, so that what it writes by snapshot are few files."""
    plain = read_snapshots(spark, root, dates)
    found = Ledger(spark, root).current()
    parts = [f"{root}/{VERSION}={found[d].version}/{SNAPSHOT}={d}" for d in sorted(dates or found) if found[d].rows]
    return _neighbours(spark, root, parts, plain.schema)


def _neighbours(spark: SparkSession, base: str, parts: list[str], schema: StructType) -> DataFrame:
    """The rows of the folders ``parts``, one of each snapshot and in their order, small neighbours read by one task, large ones by several."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    sizes = {part: store.getContentSummary(path(part)).getLength() for part in parts}
    groups: list[list[str]] = []
    taken = GATHERED
    for part in parts:
        if taken + sizes[part] > GATHERED:
            groups.append([])
            taken = 0
        groups[-1].append(part)
        taken += sizes[part]
    reader = spark.read.schema(schema).option("basePath", base)
    # Two tasks at least: Spark takes a union of tables of one partition each for a table of one partition.
    tables = [reader.parquet(*some).coalesce(max(2, -(-sum(sizes[p] for p in some) // GATHERED))) for some in groups]
    rows = reduce(DataFrame.unionAll, tables) if tables else spark.createDataFrame([], schema)
    return rows.select(*(f"`{f.name}`" for f in schema))


def split_finely(df: DataFrame) -> None:
    """Let a task read little of a table whose files are compressed, as its rows take many times as much when they are sorted."""
    conf, key = df.sparkSession.conf, "spark.sql.files.maxPartitionBytes"
    now = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(key))
    if now > COMPRESSED_SPLIT and any(f.endswith((".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")) for f in df.inputFiles()):
        conf.set(key, str(COMPRESSED_SPLIT))


def larger_than(df: DataFrame, most: int, files: list[str] | None = None) -> bool:
    """Whether the files that a table is read from, or ``files`` of them, have more than so many bytes together."""
    total = 0
    for uri in df.inputFiles() if files is None else files:
        file = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.sparkSession._jvm.java.net.URI(uri))
        total += file.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getFileStatus(file).getLen()
        if total > most:
            return True
    return False


def observed(seen: Observation) -> dict:
    """What was observed, once the job has run."""
    try:
        return seen.get
    except Py4JJavaError:
        # Where the optimizer knows that there are no rows, the observation has none either.
        return {}


def snapshots_in(spark: SparkSession, root: str) -> list[str]:
    """The snapshots a table has, empty ones too, by its ledger; none where there is no table."""
    return sorted(Ledger(spark, root).current() or {})


def snapshot_versions(spark: SparkSession, root: str) -> dict[str, str]:
    """Date to version: a snapshot that is written again gets another one."""
    return {d: s.version for d, s in (Ledger(spark, root).current() or {}).items()}


def read_snapshots(
    spark: SparkSession, root: str, dates: list[str] | None = None, format: str = "parquet", columns: list[str] | None = None
) -> DataFrame:
    """A snapshot table, or some of its snapshots; all of ``dates`` must exist.

    Columns come from the ledger, so no file is opened before the scan. One that only some snapshots have is NULL in the
    others; one that changed its type is an error. Of a CSV table ``columns``, if given, are its columns in their order;
    every file's header is checked against them.
    """
    found = Ledger(spark, root).current()
    if found is None:
        raise MissingSnapshot(f"{root} has no ledger of snapshots")
    if missing := set(dates or []) - set(found):
        raise MissingSnapshot(f"{root} has no snapshots {sorted(missing)}")
    wanted = {d: found[d] for d in sorted(dates or found)}
    if columns is None:
        fields = _united(root, wanted).fields
    else:
        fields = [StructField(c, StringType()) for c in columns if c != SNAPSHOT]
    schema = StructType([*fields, StructField(SNAPSHOT, DateType())])
    paths = _folders(root, wanted)
    if not paths:
        return spark.createDataFrame([], schema)
    options = {"header": True, "escape": '"', "enforceSchema": False} if format == "csv" else {}
    rows = spark.read.options(basePath=root, **options).schema(schema).format(format).load(paths)
    return rows.select(*(f"`{f.name}`" for f in schema))


def _united(root: str, snapshots: dict[str, Snapshot]) -> StructType:
    fields: dict[str, StructField] = {}
    for schema in dict.fromkeys(s.schema for s in snapshots.values()):
        for field in StructType.fromJson(json.loads(schema)):
            known = fields.setdefault(field.name, StructField(field.name, field.dataType))
            if known.dataType != field.dataType:
                raise TypeError(f"{root}: {field.name} is {known.dataType.simpleString()} in some snapshots and {field.dataType.simpleString()} in others")
    return StructType(list(fields.values()))


def _folders(root: str, wanted: dict[str, Snapshot]) -> list[str]:
    """A version's folder where all that was written to it is wanted, else the folders of its wanted snapshots."""
    days: dict[str, list[str]] = {}
    for d, s in wanted.items():
        if s.rows:
            days.setdefault(s.version, []).append(d)
    paths = []
    for version, some in days.items():
        folder = f"{root}/{VERSION}={version}"
        paths += [folder] if len(some) == wanted[some[0]].together else [f"{folder}/{SNAPSHOT}={d}" for d in some]
    return paths
