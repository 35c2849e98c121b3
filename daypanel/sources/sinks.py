"""Writers: versioned all-or-nothing tables, sibling tables, run-dated publishing.

A stored table is a folder of Parquet directories, one a version and month, and of small pointer files.  The newest pointer names the
directories that make up the table, its schema, and the progress of streams.  A writer states which pointer its rows were
merged from; if another writer has published since, its publish is refused and nothing is lost.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daypanel.core import DAY, ENTITY

POINTER = "CURRENT-"
STORE_TABLES = ("daily", "sessions", "samples")
WHOLE = "all"
# Pointer entries that note the last merged batch of a stream instead of a part of the table.
MARK = "_stream_"
# Beside the rows of a month: which keys stand in it.
KEYS_OF = "keys"


class PointerMoved(RuntimeError):
    """Another writer published between reading a table and publishing to it; merge again."""


@dataclass(frozen=True)
class Pointer:
    """What is published: ``parts`` and ``keys`` by month (or whole table), progress ``marks`` of streams, and the schema.

    One entry a month: as long as the calendar, not as the data.
    """

    generation: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    keys: dict[str, str] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)
    schema: StructType | None = None

    def text(self) -> str:
        lines = [("part", k, v) for k, v in self.parts.items()] + [("keys", k, v) for k, v in self.keys.items()] + [("mark", k, v) for k, v in self.marks.items()]
        if self.schema is not None:
            lines.append(("schema", "", self.schema.json()))
        return "".join("\t".join(line) + "\n" for line in sorted(lines))


def store_paths(root: str) -> dict[str, str]:
    """Sibling tables of one store."""
    return {name: f"{root.rstrip('/')}/{name}" for name in STORE_TABLES}


def new_version() -> str:
    return f"v={dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> list[str]:
    hadoop, fs = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def generations(spark: SparkSession, table: str) -> list[int]:
    return [int(n.removeprefix(POINTER)) for n in names_in(spark, table) if n.startswith(POINTER)]


def pointer(spark: SparkSession, table: str, generation: int | None = None) -> Pointer:
    """The newest pointer, or that of a generation; an empty one where nothing is published."""
    known = generations(spark, table)
    if not known:
        return Pointer()
    generation = max(known) if generation is None else generation
    text = spark.read.text(f"{table}/{POINTER}{generation:012d}", wholetext=True).first()[0]
    found: dict[str, dict[str, str]] = {"part": {}, "keys": {}, "mark": {}, "schema": {}}
    for kind, name, value in (line.split("\t", 2) for line in text.splitlines()):
        found[kind][name] = value
    schema = StructType.fromJson(json.loads(found["schema"][""])) if found["schema"] else None
    return Pointer(generation, found["part"], found["keys"], found["mark"], schema)


def published(spark: SparkSession, table: str) -> dict[str, str]:
    """Part (a month, or the whole table) to directory, and the marks of streams."""
    now = pointer(spark, table)
    return now.parts | now.marks


def applied_batch(spark: SparkSession, table: str, stream: str) -> int:
    """Number of the last batch a stream merged into the table, -1 if none."""
    return int(pointer(spark, table).marks.get(f"{MARK}{stream}", -1))


def read_parts(spark: SparkSession, table: str, now: Pointer, parts: list[str] | None = None) -> DataFrame | None:
    """The rows that a pointer names, or only the given months of them; none if there are none.

    The pointer knows the schema, so no file is opened to find it; columns younger than a file are null in it.
    """
    chosen = [d for p, d in sorted(now.parts.items()) if parts is None or p in parts]
    if not chosen:
        return None
    return spark.read.schema(now.schema).parquet(*(f"{table}/{d}" for d in chosen))


def read_version(spark: SparkSession, table: str, parts: list[str] | None = None) -> DataFrame | None:
    """The published table, or only the given months of it; none if there is nothing."""
    return read_parts(spark, table, pointer(spark, table), parts)


def read_keys(spark: SparkSession, table: str, now: Pointer) -> DataFrame | None:
    """``entity, key, month`` of all rows with a key that may move between months; none if there are none."""
    if not now.keys:
        return None
    return spark.read.schema(f"{ENTITY} {now.schema[ENTITY].dataType.simpleString()}, key string, at string").parquet(*(f"{table}/{d}" for d in now.keys.values())).withColumnRenamed("at", "month")


def united(old: StructType | None, new: StructType) -> StructType:
    """The schema of both: a column keeps its first type, new columns come last."""
    if old is None:
        return StructType([f for f in new.fields])
    return StructType(list(old.fields) + [f for f in new.fields if f.name not in old.names])


def replace_table(df: DataFrame, table: str, version: str | None = None, key: Column | None = None) -> str:
    """Write a whole new version beside the old one, then publish it.

    Readers keep the old version until the write is complete, and a plan that reads the table may
    be written to it.  A run that dies leaves an unpublished directory and changes nothing.
    """
    spark = df.sparkSession
    version, now = version or new_version(), pointer(df.sparkSession, table)
    write_parts(df, table, version, key)
    parts, keys = list_parts(spark, table, version)
    publish(spark, table, Pointer(now.generation + 1, parts, keys, {}, df.schema))
    return version


def replace_months(
    df: DataFrame, table: str, months: list[str], version: str | None = None, mark: dict[str, str] | None = None,
    base: Pointer | None = None, key: Column | None = None,
) -> str:
    """Replace only the given months, all or nothing; the other months stay as they are.

    ``df`` holds every row these months shall have afterwards, merged from what ``base`` names (the newest pointer by default); if
    another writer has published since, :class:`PointerMoved` is raised.  ``mark`` entries go into the same pointer, so that data
    and progress of a stream are published together; so do the keys of each row for which ``key`` is not null.
    """
    spark = df.sparkSession
    base = pointer(spark, table) if base is None else base
    version = version or new_version()
    schema = united(base.schema, df.schema)
    typed = df.select(*(F.col(f"`{c}`").cast(schema[c].dataType).alias(c) for c in df.columns))
    write_parts(typed, table, version, key)
    parts, keys = list_parts(spark, table, version)
    others = lambda known: {p: d for p, d in known.items() if p not in months}
    publish(spark, table, Pointer(base.generation + 1, others(base.parts) | parts, others(base.keys) | keys, base.marks | (mark or {}), schema))
    return version


def write_parts(df: DataFrame, table: str, version: str, key: Column | None = None) -> None:
    """By month where there is a day; the rebalance splits large months and joins small ones.  Keys go beside, read from what was written."""
    if DAY not in df.columns:
        df.write.mode("overwrite").parquet(f"{table}/{version}")
        return
    month = F.date_format(DAY, "yyyy-MM")
    df.withColumn("month", month).hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(f"{table}/{version}")
    if key is not None and any(n.startswith("month=") for n in names_in(df.sparkSession, f"{table}/{version}")):
        written = df.sparkSession.read.schema(df.schema).parquet(f"{table}/{version}")
        rows = written.select(ENTITY, key.alias("key"), month.alias("at"), month.alias("month")).where(F.col("key").isNotNull())
        rows.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(f"{table}/{version}-{KEYS_OF}")


def list_parts(spark: SparkSession, table: str, version: str) -> tuple[dict[str, str], dict[str, str]]:
    """Directories of rows and of keys by month."""
    months = lambda v, names: {n.split("=", 1)[1]: f"{v}/{n}" for n in names if n.startswith("month=")}
    names, side = names_in(spark, f"{table}/{version}"), f"{version}-{KEYS_OF}"
    # A dated table without rows has neither months nor files and publishes no part.
    parts = months(version, names) or ({WHOLE: version} if any(n.endswith(".parquet") for n in names) else {})
    return parts, months(side, names_in(spark, f"{table}/{side}"))


def publish(spark: SparkSession, table: str, new: Pointer) -> None:
    """Write the pointer beside the others, then give it the name of its generation, which only one writer can do.

    The rename does not overwrite, so of two writers that merged from the same pointer the second is refused.
    """
    fresh, fs = file_system(spark, f"{table}/.{POINTER}{uuid.uuid4().hex}")
    out = fs.create(fresh, False)
    try:
        out.write(bytearray(new.text().encode()))
    finally:
        out.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{POINTER}{new.generation:012d}")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(fresh), fs.makeQualified(target), options)
    except Exception as e:
        fs.delete(fresh, False)
        if fs.exists(target):
            raise PointerMoved(f"{table} has generation {new.generation} already") from e
        raise


def expire(spark: SparkSession, table: str, keep: int = 2, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Remove directories that none of the newest ``keep`` pointers names, and older pointers; the removed names.

    Only what was last changed before ``older_than`` goes: younger directories may belong to a writer that has not published yet.
    """
    known = sorted(generations(spark, table))
    kept = known[-keep:]
    named = {d.split("/")[0] for g in kept for now in [pointer(spark, table, g)] for d in [*now.parts.values(), *now.keys.values()]}
    hadoop, fs = file_system(spark, table)
    limit = (dt.datetime.now(dt.timezone.utc) - older_than).timestamp() * 1000
    gone = []
    for status in fs.listStatus(hadoop) if fs.exists(hadoop) else []:
        name = status.getPath().getName()
        version = status.isDirectory() and re.match(r"v=", name) is not None and name not in named
        old = name.startswith(POINTER) and int(name.removeprefix(POINTER)) not in kept
        left = name.startswith(f".{POINTER}")
        if (version or old or left) and status.getModificationTime() <= limit:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


def write_daily(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Processed daily table as parquet, or CSV with a header."""
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def publish_run(df: DataFrame, root: str, name: str, run_date: dt.date, fmt: str = "parquet") -> str:
    """Write under ``root/run_date=.../name`` on any Hadoop file system."""
    path = f"{root.rstrip('/')}/run_date={run_date:%Y-%m-%d}/{name}"
    write_daily(df, path, fmt)
    return path


def write_report(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """One parquet table per report dataset."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(paths[name])
    return paths
