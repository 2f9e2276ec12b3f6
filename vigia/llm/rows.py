"""Small shared helpers of the operators: null-safe text, fresh column names,
functions of a row in Arrow batches, staged tables."""

from __future__ import annotations

import ctypes
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from ..session import fresh_dir


def text_or_empty(name: str) -> Column:
    """The column as a string, null read as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or the first variant of it that no column of ``df`` has
    (column names compare without case, as Spark's do)."""
    taken = {c.lower() for c in df.columns}
    name, n = wanted, 0
    while name.lower() in taken:
        n += 1
        name = f"{wanted}_{n}"
    return name


def attach(df: DataFrame, in_col: str, out_col: str, out_type: str,
           make: Callable[[], Callable[[list], list | pa.Array]], rows: int = 256, arrow: bool = False,
           keep: bool = True) -> DataFrame:
    """``df`` with ``out_col``, a function of ``in_col``, added in Arrow
    batches of at most ``rows`` rows.  ``make`` runs once per Python task (it
    loads tables or reads a broadcast model) and gives the function of a list
    of values (``arrow``: of an Arrow array).  Each row by itself; all other columns pass through (``in_col``
    only if ``keep``), and a clashing ``out_col`` raises."""
    if free_name(df, out_col) != out_col:
        raise ValueError(f"column {out_col} exists already")
    at = [c.lower() for c in df.columns].index(in_col.lower())
    added = StructType.fromDDL(f"`{out_col}` {out_type}")
    passed = [i for i in range(len(df.columns)) if keep or i != at]
    schema = StructType([*(df.schema.fields[i] for i in passed), *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = _asked
        fn, kind = make(), to_arrow_type(added.fields[0].dataType)
        if asked == _asked and _LASTING:
            _LASTING.clear()
            give_back()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                out = fn(part.column(at) if arrow else part.column(at).to_pylist())
                out = out if isinstance(out, pa.Array) else pa.array(out, type=kind)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in passed), out],
                                                 names=[*(part.schema.names[i] for i in passed), out_col])

    return df.mapInArrow(tidy(run), schema)


try:
    _trim = ctypes.CDLL(None).malloc_trim  # of the GNU C library
except (AttributeError, OSError):
    _trim = None


def give_back() -> None:
    """Return what the task freed to the system: a Python worker lives on and
    would hold it through the tasks of other operators."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def tidy(run: Callable) -> Callable:
    """A task's function of batches that gives its memory back at the end."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()
    return tidied


_LASTING: dict[tuple[str, ...], object] = {}
_asked = 0


def lasting(key: tuple[str, ...], make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by the Python worker from task to task.  It goes
    when a task asks for a key of another file (the key's first part) or works
    without any (:func:`attach`): a worker that goes on to other operators
    doesn't carry the tables and memos of those before."""
    global _asked
    _asked += 1
    if any(k[0] != key[0] for k in _LASTING):
        _LASTING.clear()
    if key not in _LASTING:
        _LASTING[key] = make()
    return _LASTING[key]


def free_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of jobs that are over deleted: Spark does so when
    the driver's JVM collects what refers to them, which may be never in a short
    run.  The events of the last job still refer to them at the first time."""
    for pause in (0.3, 0):
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder of
    ``spark.checkpoint.dir`` and read it back: computed once, lineage cut,
    readable from every executor and after the loss of any."""
    spark = df.sparkSession
    path = fresh_dir(spark, "llm", label)
    df.write.parquet(path)
    free_shuffles(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._vigia_path = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Delete a table written by :func:`stage` that nothing reads any more."""
    path = getattr(df, "_vigia_path", None)
    if path:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration() if hasattr(spark, "_jsc")
                        else spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stage_bytes(df: DataFrame) -> int:
    """Size of a table written by :func:`stage`."""
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._vigia_path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Groups of rows that agree in the first ``keys`` columns (integers), from
    batches that are sorted by them: for each group its columns.  A group may
    span batches; one group at a time is held."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        n = batch.num_rows
        if not n:
            continue
        new = np.zeros(n, dtype=bool)
        for c in columns[:keys]:
            new[1:] |= c[1:] != c[:-1]
        starts = [*np.flatnonzero(new).tolist(), n]
        if held and any(h[0] != c[0] for h, c in zip(held[-1], columns[:keys], strict=False)):
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held = []
        start = 0
        for end in starts:
            part = [c[start:end] for c in columns]
            if end < n:
                if held:
                    part = [np.concatenate(c) for c in zip(*held, part, strict=True)]
                    held = []
                yield part
            else:
                held.append(part)
            start = end
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
