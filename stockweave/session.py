"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, cpus: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Lets a join whose build side fits in every task skip sorting, judged at run time.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session in one process may fall back to a temporary folder: elsewhere that
    folder would exist on one machine only.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if folder:
        return folder
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="stockweave-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


# Of the thread or task that opened them, so that one job does not delete another's tables.
_open_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("open_scopes", default=())


def scratch_path(spark: SparkSession, name: str, scoped: bool = True) -> str:
    """A fresh path below the shared folder; unless ``scoped``, no :func:`scratch_scope` deletes it."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if scoped and _open_scopes.get():
        _open_scopes.get()[-1].append(path)
    return path


def _place(spark: SparkSession, path: str):
    """(file system, path) of the cluster's own libraries, for any kind of path that Spark reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file with ``text``, in place of one that is there."""
    files, place = _place(spark, path)
    stream = files.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if it is not there."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete every scratch path taken inside, at the end.

    For work that ends with a write: DataFrames made inside may read those paths and must not
    be used after it.
    """
    paths: list[str] = []
    token = _open_scopes.set((*_open_scopes.get(), paths))
    try:
        yield
    finally:
        _open_scopes.reset(token)
        for path in paths:
            files, place = _place(spark, path)
            files.delete(place, True)


def materialise(df: DataFrame, name: str = "rows", scoped: bool = True) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Its rows, and every id in them, are fixed from here on whatever tasks are repeated,
    and several readers share one computation, each reading only the columns it needs.
    """
    path = scratch_path(df.sparkSession, name, scoped)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS_PER_TASK = 1_000_000


def spread_by(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df`` partitioned by ``key`` for work on its groups, so that a task sorts about a million of the ``rows``.

    Left to Spark where the session's number of partitions is enough.
    """
    parts = -(-rows // ROWS_PER_TASK)
    return df.repartition(parts, key) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def side_by_side(spark: SparkSession, actions: Sequence[Callable[[], None]], at_once: int = 4) -> None:
    """Run independent writes a few at a time, so that the tasks of one fill the gaps of another.

    The threads take Spark's local properties along. When one write fails, those not yet begun
    are dropped and the jobs of the others are cancelled.
    """
    tag = f"side-by-side-{uuid.uuid4().hex}"

    def tagged(action: Callable[[], None]) -> Callable[[], None]:
        def run() -> None:
            spark.sparkContext.addJobTag(tag)
            try:
                action()
            finally:
                spark.sparkContext.removeJobTag(tag)

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(at_once) as pool:
        begun = [pool.submit(copy_context().run, tagged(action)) for action in actions]
        done, rest = wait(begun, return_when=FIRST_EXCEPTION)
        if rest:
            pool.shutdown(wait=False, cancel_futures=True)
            spark.sparkContext.cancelJobsWithTag(tag)
        for write in done:
            write.result()
