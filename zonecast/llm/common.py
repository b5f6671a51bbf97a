"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.session import scratch_path

#: What ends a word: the six ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]"
#: Bytes of rows that go to a Python worker at once (a longer row goes alone), unless the session has its own limit.
#: By rows alone a batch is ten thousand texts or shingle sets, which the JVM holds in vectors of up to twice
#: their size, and the worker again.
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors once per application, so that
    their Python workers import it (and keep its caches between tasks)."""
    app, home = spark.sparkContext.applicationId, Path(__file__).resolve().parents[1]
    if app in _shipped or not home.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="zonecast-src-")).resolve() / "zonecast.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f.relative_to(home.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


_caches: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What a module keeps in its worker between tasks, until a task of another module begins there."""
    return _caches.setdefault(owner, {})


def make_room(owner: str) -> None:
    """Workers outlive their tasks: drop what other modules keep, and hand back what is free."""
    others = [c for name, c in _caches.items() if name != owner and c]
    for c in others:
        c.clear()
    if others:
        gc.collect()
    hand_back()


def hand_back() -> None:
    """Give the system the memory that the worker's allocators hold free."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def _with_room(run: Callable) -> Callable:
    owner = run.__module__

    def begin(batches):
        make_room(owner)
        yield from run(batches)
        # a worker may wait through stages that need no Python
        hand_back()
    return begin


def _bound_batches(spark: SparkSession) -> None:
    """Batches to Python workers are limited by bytes from now on; a limit that the session has stays."""
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    _bound_batches(df.sparkSession)
    return df.mapInArrow(_with_room(run), schema)


def map_pandas(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    _bound_batches(df.sparkSession)
    return df.mapInPandas(_with_room(run), schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once to the shared scratch folder and return the reread table
    with its path: lineage ends there, so a lost executor re-reads files."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def drop_tables(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete intermediate tables of ``write_table`` that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def words_col(text: str) -> str:
    """SQL for the array of maximal runs of non-space characters (null text: empty array)."""
    return f"filter(split(coalesce({text}, ''), r'{SPACE}+'), w -> w <> '')"


def with_row_ids(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns, in order; extra or clashing columns stay out of the operator."""
    return df.select(*[F.col(f"`{c}`") for c in cols])
