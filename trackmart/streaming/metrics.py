"""Rows that pass the steps of a stream, observed while it runs."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from trackmart.operators.quality import step_metrics
from trackmart.sources.lake import from_messages


def watched(
    df: DataFrame, step: str, conditions: Mapping[str, Column] | None = None
) -> DataFrame:
    """Count the rows of a stream that pass here, and those meeting each condition.

    The counts of a micro-batch come with its progress, see ``StepListener``. A
    sink has to read its micro-batch once, or rows count as often as it does.
    """
    counts = [F.count_if(condition).alias(name) for name, condition in (conditions or {}).items()]
    return df.observe(step, F.count(F.lit(1)).alias("rows"), *counts)


def watched_events(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """JSON-lines files of a folder as a stream of events, watched at two steps: ``lines`` that
    are not blank, and ``events`` among them, with those that name no genre."""
    text = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    lines = watched(text.filter(F.trim("value") != ""), "lines")
    return watched(from_messages(lines), "events", {"without_genre": F.col("genre").isNull()})


class StepListener(StreamingQueryListener):
    """Adds up what ``watched`` steps count, for each run of a query.

    A micro-batch that is done again replaces its own counts.
    """

    def __init__(self) -> None:
        self._counts: dict[str, dict[tuple[int, str], dict[str, int]]] = defaultdict(dict)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for step, row in progress.observedMetrics.items():
            self._counts[str(progress.runId)][progress.batchId, step] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def counts(self, query: StreamingQuery, timeout: float = 60.0) -> dict[str, dict[str, int]]:
        """By step, the counts of a run that has ended, once its last event has arrived."""
        run = str(query.runId)
        if not self._ended[run].wait(timeout):
            raise TimeoutError(f"the end of run {run} was not reported")
        totals: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        for (_, step), counts in self._counts[run].items():
            for name, n in counts.items():
                totals[step][name] += n
        return {step: dict(counts) for step, counts in totals.items()}


def stream_steps(spark: SparkSession, counts: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Rows in, out and removed by the reading of ``watched_events``."""
    def rows(step: str) -> int:
        return counts.get(step, {}).get("rows", 0)

    return step_metrics(spark, {"read_events": (rows("lines"), rows("events"))})
