"""What a run of plans took: counts observed while tables are written, seconds, memory."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from .tables import written


def observed(df: DataFrame, name: str, *counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """(df as a table in the shared folder, the counts, taken by the job that writes it)."""
    seen = Observation(f"{name}-counts")
    table, _ = written(df.observe(seen, *counts), name)
    return table, dict(seen.get)


@contextmanager
def timed(seconds: dict[str, float], name: str) -> Iterator[None]:
    """Adds the seconds that a block takes to an entry."""
    began = time.perf_counter()
    try:
        yield
    finally:
        seconds[name] = round(seconds.get(name, 0.0) + time.perf_counter() - began, 6)


def peak_executor_kib(spark: SparkSession) -> int:
    """The most memory that an executor process held so far: resident, where the session tracks it, else heap and off-heap."""
    found = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    peaks = [p.get() for p in (found.apply(i).peakMemoryMetrics() for i in range(found.size())) if p.isDefined()]
    of = lambda m, *names: sum(m.getMetricValue(n) for n in names)
    return max((of(m, "ProcessTreeJVMRSSMemory", "ProcessTreePythonRSSMemory") or of(m, "JVMHeapMemory", "JVMOffHeapMemory") for m in peaks), default=0) // 1024
