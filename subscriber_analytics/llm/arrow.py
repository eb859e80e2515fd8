"""Documents in Arrow batches: bounded blocks of texts in, columns out, and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Texts worked on at once; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
# Rows that Spark hands to Python at once: with long documents its default of 10,000 is too much.
BATCH_ROWS = 1000


def shared_dir(spark: SparkSession, name: str) -> str:
    """New path in the folder that driver and executors share; a temporary one only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.gettempdir()
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, and let local workers find this package where the driver has it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    workers = spark.sparkContext.environment
    paths = [p for p in (workers.get("PYTHONPATH"), str(Path(__file__).resolve().parents[2])) if p]
    workers["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(os.pathsep.join(paths).split(os.pathsep)))


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of df that none of the names would hide, letter case aside."""
    hidden = {name.lower() for name in names}
    return [c for c in df.columns if c.lower() not in hidden]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts together, and the offsets at which each begins; null is an empty text."""
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    body = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def blocks(batch: pa.RecordBatch, text: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``size`` bytes of text, or of one row."""
    _, offsets = flat(batch.column(text).cast(pa.string()))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def add_columns(
    docs: DataFrame, text: str, fields: T.StructType, work: Callable[[pa.Array], dict[str, object]],
) -> DataFrame:
    """docs with the columns that ``work`` derives from the texts of a block; equal names are replaced."""
    prepare(docs.sparkSession)
    kept = without(docs, [f.name for f in fields])
    source = docs.select(*[f"`{c}`" for c in kept], docs[text].alias("__text"))
    schema = T.StructType([docs.schema[c] for c in kept] + list(fields))
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "__text"):
                made = work(part.column("__text").cast(pa.string()))
                new = [pa.array(made[f.name], type=t) for f, t in zip(fields, types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + new, names=[f.name for f in schema])

    return source.mapInArrow(run, schema)
