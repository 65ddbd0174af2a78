"""Stage timers, log sinks and progress gauges on the driver; Spark's own UI and event log hold the rest."""

from __future__ import annotations

import logging
import resource
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

LOG = logging.getLogger("textmill")


def log_to(path: str | None = None, level: int = logging.INFO) -> None:
    """Log to the console and, with a path, to a file of the driver."""
    sinks: list[logging.Handler] = [logging.StreamHandler()] + ([logging.FileHandler(path, encoding="utf-8")] if path else [])
    for sink in sinks:
        sink.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        LOG.addHandler(sink)
    LOG.setLevel(level)


class Stages:
    """Wall seconds of named stages, logged as they end."""

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        began = time.monotonic()
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.monotonic() - began
            LOG.info("%s: %.1f s", name, self.seconds[name])

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.seconds.items()), "stage string, seconds double")


@contextmanager
def gauges(spark: SparkSession, every: float = 30.0) -> Iterator[list[dict]]:
    """While the block runs, every so many seconds: driver memory and the tasks of the active stages. Yields the readings."""
    readings: list[dict] = []
    stop = threading.Event()

    def watch() -> None:
        tracker = spark.sparkContext.statusTracker()
        while not stop.wait(every):
            infos = [x for x in map(tracker.getStageInfo, tracker.getActiveStageIds()) if x]
            readings.append({"rss_mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024, "stages": len(infos), "tasks": sum(x.numTasks for x in infos), "done": sum(x.numCompletedTasks for x in infos)})
            LOG.info("driver %(rss_mb).0f MB, %(done)d of %(tasks)d tasks in %(stages)d stages", readings[-1])

    thread = threading.Thread(target=watch, daemon=True)
    thread.start()
    try:
        yield readings
    finally:
        stop.set()
        thread.join()
