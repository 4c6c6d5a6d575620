"""Session settings the operators read, and where shared results are kept."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Jobs submitted at the same time; each is itself distributed.
PARALLEL_JOBS = 8

BROADCAST_BYTES = "spark.tablewinnow.broadcastBytes"

DEFAULTS = {
    # A join side is broadcast only when it was measured to be below this.
    BROADCAST_BYTES: 64 * 1024 * 1024,
}


_LIMIT: ContextVar[int | None] = ContextVar("broadcast_limit", default=None)


@contextmanager
def broadcast_up_to(size: int) -> Iterator[None]:
    """Plans made inside broadcast only key sets of at most so many bytes, whatever
    the session says."""
    token = _LIMIT.set(size)
    try:
        yield
    finally:
        _LIMIT.reset(token)


def broadcast_limit(spark: SparkSession) -> int:
    own = _LIMIT.get()
    return setting(spark, BROADCAST_BYTES) if own is None else own


def setting(spark: SparkSession, name: str) -> int:
    return int(spark.conf.get(name, str(DEFAULTS[name])))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the one already set, else the one the cluster names
    in ``spark.checkpoint.dir``. Only a local session gets a folder of its own."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.partition("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tablewinnow-")
    context.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def concurrently(*jobs: Callable[[], object]) -> list:
    """Results of independent driver calls whose Spark jobs may run side by side."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(min(len(jobs), PARALLEL_JOBS)) as pool:
        inherit = inheritable_thread_target(SparkSession.active())
        running = [pool.submit(copy_context().run, inherit(job)) for job in jobs]
        return [job.result() for job in running]
