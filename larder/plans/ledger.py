"""A ledger of finished steps, and a run of steps along their inputs.

A step is known by the versions of its inputs, the settings of the run and the
code that decides its rows.  If the ledger holds the step under the same key and
what it wrote is still in place, a rerun reads that and writes nothing; so a run
that was lost goes on where it stopped, and a new landing rebuilds only what
depends on it.  Steps whose inputs are there run side by side.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from types import ModuleType

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "step string, key string, version string, location string, rows long, finished_ns long"


@dataclass(frozen=True)
class Entry:
    step: str
    key: str
    version: str  # of the rows: what a step that reads them is keyed by
    location: str  # of the files: maintenance moves these and keeps the rows
    rows: int
    finished_ns: int


def digest(value: object) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


def code_version(modules: Sequence[ModuleType]) -> str:
    """Of the source of the modules that decide what the steps write."""
    return digest([inspect.getsource(m) for m in modules])


class StepLedger:
    """Entries under ``path``, one small JSON file each in a folder of its step.

    Every step has one writer at a time.  A lost driver leaves no half entry: an
    entry counts once its folder is committed, which happens after the step's
    own rows are."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._newest: dict[str, Entry] = {}
        if self._exists(path):
            newest = self.entries().groupBy("step").agg(F.max_by(F.struct("*"), "finished_ns").alias("e"))
            self._newest = {r.step: Entry(**r.e.asDict()) for r in newest.collect()}  # a row per step

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def entries(self) -> DataFrame:
        """Everything recorded, reruns and moves included."""
        return self.spark.read.schema(ENTRY).json(f"{self.path}/*/")

    def newest(self, step: str) -> Entry | None:
        return self._newest.get(step)

    def finished(self, step: str, key: str, location: Callable[[], str | None]) -> Entry | None:
        """The step's entry under this key, if its files are committed and still
        are what ``location()`` names now."""
        e = self._newest.get(step)
        if e is None or e.key != key or location() != e.location or not self._exists(f"{e.location}/_SUCCESS"):
            return None
        return e

    def record(self, step: str, key: str, location: str, rows: int, version: str | None = None) -> Entry:
        e = Entry(step, key, version or uuid.uuid4().hex, location, rows, time.time_ns())
        row = self.spark.createDataFrame([tuple(e.__dict__.values())], ENTRY).coalesce(1)
        row.write.mode("append").json(f"{self.path}/{step}")
        self._newest[step] = e
        return e


def run_steps(spark: SparkSession, inputs: Mapping[str, Sequence[str]], run: Callable[[str], object],
              workers: int = 4) -> list[str]:
    """Call ``run(step)`` for every step once its inputs are done, at most
    ``workers`` at a time, each in a scheduler pool of its own name; returns the
    steps in the order in which they ended.

    Inputs that are no steps count as done.  After a failure no further step
    begins, those that run are awaited, and the first error is raised."""
    left = {s: {i for i in needs if i in inputs} for s, needs in inputs.items()}
    ended: list[str] = []
    failed: BaseException | None = None
    running: dict[Future, str] = {}

    def one(step: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", step)
        try:
            run(step)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=workers) as pool:
        while left or running:
            if failed is None:
                for step in [s for s, needs in left.items() if needs <= set(ended)]:
                    del left[step]
                    running[pool.submit(inheritable_thread_target(spark)(one), step)] = step
            if not running:
                break
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                step = running.pop(done)
                if done.exception() is None:
                    ended.append(step)
                else:
                    failed = failed or done.exception()
    if failed is not None:
        raise failed
    if left:
        raise ValueError(f"steps wait for one another: {sorted(left)}")
    return ended
