"""What the corpus operators share: readers, safe checkpoints, Arrow mapping."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of the contracts: runs of anything but a blank and the ASCII white space from tab to carriage return.
WORDS = r"[^\x20\x09-\x0D]+"
#: Bytes of rows that go to a worker at once, and the seconds after which it gives back memory.
BATCH_BYTES, TRIM_S = 4 << 20, 0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder all executors share, with its lineage cut.

    The folder is the session's spark.checkpoint.dir. Where none is set, a local
    session (tests on one machine) gets one of its own, and a cluster is refused:
    its executors would not see each other's files. Files of checkpoints that are
    no longer referred to are deleted by Spark if the session asks for it
    (spark.cleaner.referenceTracking.cleanCheckpoints).
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints"))
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps that were checkpointed and are no longer referred to; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def collect_garbage(spark: SparkSession) -> None:
    """Has the executors' JVMs collect their garbage in a task for each core, all at once; they then give the system the heap they do not use."""
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.reflect(F.lit("java.lang.System"), F.lit("gc"))).collect()


def give_back(spark: SparkSession) -> None:
    """``release``, and the same for the executors, whose heaps else stay as large as the stage before made them while the next one's Python workers grow beside them."""
    release(spark)
    # In a local session the driver's JVM is the only one.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        collect_garbage(spark)


class Remembered(dict):
    """What ``ask`` says of short strings, kept in two generations of at most ``most`` each: what was asked for lately stays."""

    def __init__(self, ask: Callable[[str], object], most: int, longest: int):
        super().__init__()
        self.ask, self.most, self.longest, self.old = ask, most, longest, {}

    def __missing__(self, key: str):
        if (found := self.old.get(key)) is None:
            found = self.ask(key)
            if len(key) > self.longest:
                return found
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found

    def learn(self, keys: set[str], answer: Callable[[list[str]], Iterable]) -> None:
        """Asks for many keys at once; the long ones are left to be asked for by themselves."""
        new = [k for k in keys.difference(self) if len(k) <= self.longest]
        if len(self) + len(new) > self.most:
            self.old = dict(self)
            self.clear()
            new = [k for k in keys if len(k) <= self.longest]
        get, unknown = self.old.get, []
        for k in new:
            if (found := get(k)) is None:
                unknown.append(k)
            else:
                self[k] = found
        if unknown:
            self.update(zip(unknown, answer(unknown)))


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; null ids give 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus)), F.lit(0))


def ascii_lower(column: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: The same for Python strings.
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def bounded_batches(spark: SparkSession) -> None:
    """Lets Spark cut what it sends to workers at ``BATCH_BYTES``, unless the session's batches are smaller: executor and worker each hold a batch, and at Spark's 64 MB a task's whole texts are one."""
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: What this worker keeps from task to task.
_kept: dict[tuple, object] = {}


def kept(make: Callable, *args):
    """``make(*args)``, the one model a worker keeps for its next tasks, until a task of an operator without it comes."""
    if (make, args) not in _kept:
        forget()
        _kept[make, args] = make(*args)
    return _kept[make, args]


def forget() -> None:
    if _kept:
        _kept.clear()
        gc.collect()
        trim(0)


_trimmed = [0.0]
_give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)


def trim(after: float = TRIM_S) -> None:
    """Gives the system what Arrow's pool and malloc hold unused, if it was done ``after`` seconds ago or more; workers live through all stages, and else keep each one's peak."""
    if time.monotonic() - _trimmed[0] >= after:
        pa.default_memory_pool().release_unused()
        if _give_back:
            _give_back(0)
        _trimmed[0] = time.monotonic()


def map_arrow(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list] | None]], schema: str, rows: int = 512, keeps: bool = False) -> DataFrame:
    """Maps slices of ``rows`` rows, columns as Python lists, to columns of ``schema``.

    ``make`` runs once in each task and returns the mapping, so that models are
    built once; slices bound what a task holds as Python objects. ``keeps``:
    ``make`` uses a model that is ``kept``.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        f = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = f({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                if out is not None:
                    yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, type=t.type) for v, t in zip((out[t.name] for t in arrow), arrow)], schema=arrow)
                trim()

    parsed = _parse_datatype_string(schema)
    arrow = to_arrow_schema(parsed)
    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, parsed)


def keep_texts(df: DataFrame, make: Callable[[], Callable[[str | None], bool]], rows: int = 512) -> DataFrame:
    """The rows of ``df`` whose text holds what ``make`` returns, with their columns; ``rows`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        good = make()
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for k in range(0, batch.num_rows, rows):
                part = batch.slice(k, rows)
                yield part.filter(pa.array([good(t) for t in part.column(at).to_pylist()], pa.bool_()))
                trim()

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)
