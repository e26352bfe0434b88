"""What the operators of this package share: selected columns, scratch tables, iteration."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns, under the operator's own names.

    An operator works on these alone, so further columns of the input, whatever their names,
    are neither read nor able to clash.
    """
    quoted = {name: "`" + source.replace("`", "``") + "`" for name, source in wanted.items()}
    return df.select(*(F.col(source).alias(name) for name, source in quoted.items()))


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can read.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="insight-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the scratch folder and read again.

    Cuts the lineage where several branches use the rows, survives lost executors, and takes
    less room than a checkpoint of rows.
    """
    folder = scratch_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_kept: dict[str, tuple[int, object]] = {}


def _forget() -> int:
    """Drops what the worker kept in other stages; the number of this one.

    When a worker starts a stage, the room that earlier stages freed goes back to the system.
    Freed memory would otherwise stay with the worker while later stages add their own.
    """
    task = TaskContext.get()
    stage = -1 if task is None else task.stageId()
    global _stage
    old = [name for name, (of, _) in _kept.items() if of != stage]
    for name in old:
        del _kept[name]
    if old or stage != _stage:
        gc.collect()
        _give_back()
    _stage = stage
    return stage


_stage: int | None = None


def _give_back() -> None:
    """Returns freed pages of the C heap and of Arrow's pool to the system."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass
    pa.default_memory_pool().release_unused()


def kept_in_stage(name: str, make):
    """What a Python worker keeps from task to task, made once, as long as a stage lasts.

    Workers are used again by later stages, in which it would only take room: it goes when a task
    of another stage asks for something to keep, or reads texts by ``text_slices``.
    """
    stage = _forget()
    if name not in _kept:
        _kept[name] = (stage, make())
    return _kept[name][1]


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, upper, upper.lower())


def text_slices(batches, column: int, most: int = 1 << 22):
    """Arrow batches in parts of about ``most`` bytes of a text column, or one larger text, so
    that what a task makes of a batch has a bounded size however long its texts are."""
    _forget()
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(False)
        ends = np.cumsum(sizes, dtype="int64") // most
        starts = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]]) if len(ends) else []
        for begin, end in zip(starts, [*starts[1:], len(ends)], strict=True):
            yield batch.slice(begin, end - begin)
