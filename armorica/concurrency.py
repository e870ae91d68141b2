"""Independent jobs of one session, submitted together."""

from __future__ import annotations

import logging
from collections.abc import Callable, Hashable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Jobs submitted at the same time, unless a caller says otherwise.
AT_ONCE = 4

Key = TypeVar("Key", bound=Hashable)
Result = TypeVar("Result")


def attempt_together(
    spark: SparkSession, tasks: Mapping[Key, Callable[[], Result]], name: str, at_once: int = AT_ONCE
) -> tuple[dict[Key, Result], dict[Key, Exception]]:
    """Results and errors of the tasks by key; at most ``at_once`` run at a time.

    Each has a job group and a scheduler pool of its own (pools count under the fair
    scheduler only) and the settings of the calling thread. One that fails stops no other.
    """

    def run(key: Key, task: Callable[[], Result]) -> Result:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{name} {key}")
        spark.sparkContext.setJobGroup(f"{name} {key}", f"{name} {key}")
        return task()

    done: dict[Key, Result] = {}
    failed: dict[Key, Exception] = {}
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as threads:
        running = {key: threads.submit(inheritable_thread_target(spark)(run), key, task) for key, task in tasks.items()}
        for key, future in running.items():
            try:
                done[key] = future.result()
            except Exception as error:  # the caller tells it, with those of others
                log.error("%s %s failed: %s", name, key, error)
                failed[key] = error
    return done, failed


def run_together(
    spark: SparkSession, tasks: Mapping[Key, Callable[[], Result]], name: str, at_once: int = AT_ONCE
) -> dict[Key, Result]:
    """Results of the tasks by key; the first error, when all have ended."""
    done, failed = attempt_together(spark, tasks, name, at_once)
    for error in failed.values():
        raise error
    return done
