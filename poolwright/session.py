"""Session helpers: durable work folder, runs that own their scratch, and plan cuts."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar, Token

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_dir: tempfile.TemporaryDirectory | None = None


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a temporary folder: on a
    cluster a machine-local path would be lost together with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    global _local_dir
    if _local_dir is None:
        # goes when the process ends
        _local_dir = tempfile.TemporaryDirectory(prefix="poolwright-", ignore_cleanup_errors=True)
    return _local_dir.name


class Run:
    """Scratch of one run: what ``materialize`` writes while the run is entered lies in the run's own folder.

    A run may be entered again and again, also between others; ``drop`` removes its folder and no other's.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.name = f"run-{uuid.uuid4().hex}"
        self.tables = 0
        self._entered: list[Token] = []

    @property
    def folder(self) -> str:
        return f"{work_folder(self.spark)}/{self.name}"

    def __enter__(self) -> Run:
        self._entered.append(_current.set(self))
        return self

    def __exit__(self, *_: object) -> None:
        _current.reset(self._entered.pop())

    def drop(self) -> int:
        """Remove the run's tables; returns their number. DataFrames that read from them can no longer be evaluated."""
        count, self.tables = self.tables, 0
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return count


_current: ContextVar[Run | None] = ContextVar("run", default=None)
_process_run: Run | None = None


def current_run(spark: SparkSession) -> Run:
    """The run that is entered, or else the one of the process."""
    global _process_run
    entered = _current.get()
    if entered is not None:
        return entered
    if _process_run is None or _process_run.spark is not spark:
        _process_run = Run(spark)
    return _process_run


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Run]:
    """A run whose tables go at the end of the block, when its results have been written elsewhere."""
    run = Run(spark)
    try:
        with run:
            yield run
    finally:
        run.drop()


#: Removes the shuffle files of a query when it ends; Spark else keeps them until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning = threading.Lock()
_writers: dict[SparkSession, tuple[int, str]] = {}


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside remove their shuffle files at their end; the session's own setting comes back with the last of several writers."""
    with _cleaning:
        count, before = _writers.get(spark, (0, ""))
        if not count:
            before = spark.conf.get(CLEANUP, "false")
            spark.conf.set(CLEANUP, "true")
        _writers[spark] = (count + 1, before)
    try:
        yield
    finally:
        with _cleaning:
            count, before = _writers.pop(spark)
            if count > 1:
                _writers[spark] = (count - 1, before)
            else:
                spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the current run's folder and return a scan of it.

    Cuts the plan where a long lineage would be re-run by several actions. The
    files survive the loss of executors, and later filters are pushed to them.
    They are scratch: they go with their run. What the plan shuffled goes at once, as nothing reads it again.
    """
    run = current_run(df.sparkSession)
    path = f"{run.folder}/{label}-{uuid.uuid4().hex}"
    run.tables += 1
    with _shuffles_go(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove what ``materialize`` wrote for ``table``, once everything made of it has been written too."""
    spark = table.sparkSession
    run, folders = current_run(spark), {file.rsplit("/", 1)[0] for file in table.inputFiles()}
    if not folders:  # known to be empty
        return
    if len(folders) > 1 or f"/{run.name}/" not in (folder := folders.pop()):
        raise ValueError("not a table of this run")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    run.tables -= 1


def drop_scratch(spark: SparkSession) -> int:
    """Remove what has been written outside of any run of its own; returns the number of tables."""
    return current_run(spark).drop() if _current.get() is None else 0


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Small table held in the plan itself.

    Unlike rows shipped as a distributed collection its size is known to the
    optimizer, so joins with it are broadcast and the other side stays in place.
    """
    fields = T.StructType.fromDDL(schema).fields
    one = spark.range(1)
    if not rows:
        return one.filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, row)]) for row in rows]
    return one.select(F.inline(F.array(*structs)))
