"""Small helpers that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only where a local session names none, as in tests, a temporary folder is made and set; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="wickframe-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are computed once and survive lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_long(c: str):
    return F.col(c).cast("bigint")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[tuple], list[tuple]]], rows: int = 256) -> DataFrame:
    """``mapInArrow`` over rows: ``make()`` runs once per task and returns the function row -> rows.

    Strings arrive as bytes (UTF-8) where the column was cast to binary. A batch is turned into
    Python values ``rows`` at a time and its results leave at once, so a task holds few texts.
    """
    fields = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = [r for row in zip(*[c.to_pylist() for c in part.columns]) for r in step(row)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), fields)], schema=fields)
        del step
        give_back()

    return df.mapInArrow(run, schema)


def text_groups(batch: pa.RecordBatch, rows: int = 512, characters: int = 4 << 20) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts (null: empty) of parts of a batch with a bounded number of rows and characters (one row at least)."""
    ids, texts, size = [], [], 0
    for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        value = text.as_py() or ""
        if ids and (len(ids) >= rows or size + len(value) > characters):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(value)
        size += len(value)
    if ids:
        yield ids, texts


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(schema))
