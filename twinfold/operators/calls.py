"""Calls to a service whose answers must not be paid for twice.

Requests are rows with a number from 0. They are answered in waves: a wave is a job of as many tasks as calls may run at
a time, a few requests each, and ends with an append to a table. So never more than `parallel` calls run, whatever the
number of cores; a lost executor repeats the requests of its running tasks; a lost driver finds all waves before in the
table. Where the cluster has stage-level scheduling, a resource profile that leaves room for `parallel` tasks takes the
place of waves: one job, a task for each few requests. A task's files are moved to the table as it ends, not with its job.

Answers are rows with keys of their own, so a reader of the table takes one of equal keys. Speculative execution would pay
twice: leave it off (it is by default).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Requests of a task: what a lost one costs at most.
PER_TASK = 4


def percent(done: int, total: int) -> int:
    return done * 100 // total if total else 100


class Tenths:
    """Says progress once for each tenth of the work, and never more than all of it."""

    def __init__(self, what: str, total: int, say: Callable[[str], None] | None):
        self.what, self.total, self.say, self.next = what, total, say, 10

    def reached(self, done: int) -> None:
        now = percent(done, self.total)
        if self.say and now >= self.next:
            self.say(f"{self.what} {done}/{self.total} ({now} %)")
            self.next = now - now % 10 + 10


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)


def answer(requests: DataFrame, n: int, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, path: str, parallel: int = 6, per_task: int = PER_TASK, progress: Tenths | None = None, profile: ResourceProfile | None = None) -> None:
    """Append run()'s rows of n requests (column number, from 0) to the table at path. requests must be a written table,
    best in the order of number, as a wave reads its range of numbers alone."""
    if profile is not None:
        append(requests.repartition(-(-n // per_task)).mapInPandas(run, schema, profile=profile), path)
        if progress:
            progress.reached(n)
        return
    wave = parallel * per_task
    for first in range(0, n, wave):
        part = requests.where((F.col("number") >= first) & (F.col("number") < first + wave))
        tasks = min(parallel, -(-(n - first) // per_task))
        append(part.coalesce(1).repartition(tasks).mapInPandas(run, schema), path)  # few rows, dealt out in turn
        if progress:
            progress.reached(min(n, first + wave))
