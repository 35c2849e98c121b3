"""What the text operators share: reading tables, Arrow batches in tasks, tables that cut lineage.

Every operator takes a documents table (``doc_id bigint, text string`` and any further columns, also ones whose
names an operator uses inside) and selects the columns it needs first, so clashing names never meet.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.core import shared_dir

# Rows per Python step inside a task; a bound on memory next to the batch itself.
STEP_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that every executor reaches."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table: later steps read it again instead of computing it, also after lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(columns: list[str], name: str) -> str:
    """A column name beginning with ``name`` that none of the columns has, in either case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_stored(spark: SparkSession, df: DataFrame) -> None:
    """Remove the files of a table made by ``stored`` once nothing reads it any more."""
    hadoop = spark._jsc.hadoopConfiguration()
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(hadoop).delete(path, True)


def utf8(text: str = "text") -> Column:
    """UTF-8 bytes of a text; null is empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def in_batches(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[dict]], schema: str, bytes_each: int = STEP_BYTES) -> DataFrame:
    """``work`` yields column lists for slices of about ``bytes_each`` of each Arrow batch; the output has the given schema."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, bytes_each):
                for out in work(part):
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def kept_rows(df: DataFrame, text: str, keep: Callable[[list[str]], list[bool]], bytes_each: int = STEP_BYTES) -> DataFrame:
    """The rows, all columns as they are, whose text ``keep`` says yes to; texts come as a list, null as an empty one."""
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, bytes_each):
                yield part.filter(pa.array(keep([t or "" for t in part.column(at).to_pylist()]), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def slices(batch: pa.RecordBatch, bytes_each: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``bytes_each``, so that Python objects of one slice at a time exist."""
    if not batch.num_rows:
        return
    step = max(1, int(batch.num_rows * bytes_each / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)
