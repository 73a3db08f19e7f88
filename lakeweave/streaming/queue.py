"""A task queue on Structured Streaming: durable intake, retries as keyed state, transactional batches."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RETRIES = 3
TASKS = "task_id string, event string, at timestamp"


def intake(spark: SparkSession, folder: str, schema: str = TASKS, files_per_batch: int = 100) -> DataFrame:
    """Q1: task events from files as they come; the query's checkpoint remembers which are read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def final_states(events: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Q2: each task's state after its events in order (enqueued, failed, completed, cancelled): up to max_retries failures are
    retried, and what ends a task ends it for good. The first ending event decides."""
    ordered = events.groupBy("task_id").agg(F.sort_array(F.collect_list(F.struct("at", "event"))).alias("es"))
    step = lambda s, e: F.when(
        s["state"].isin("completed", "failed", "cancelled"), s
    ).otherwise(
        F.when(e["event"] == "failed", F.struct(F.when(s["retries"] + 1 > max_retries, "failed").otherwise("pending").alias("state"), (s["retries"] + 1).alias("retries")))
        .when(e["event"].isin("completed", "cancelled"), F.struct(e["event"].alias("state"), s["retries"].alias("retries")))
        .otherwise(s)
    )
    start = F.struct(F.lit("pending").alias("state"), F.lit(0).alias("retries"))
    return ordered.select("task_id", F.aggregate("es", start, step).alias("s")).select("task_id", "s.state", "s.retries")


def retry_states(events: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Q2 on a stream: state and retries of each task, kept between batches. (With a timeout, a query that
    drains what is there would go on for as long as any state can expire, so states aren't forgotten.)"""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key, frames, state: GroupState):
        name, retries = state.get if state.exists else ("pending", 0)
        for event in pd.concat(list(frames)).sort_values(["at", "event"])["event"]:
            if name in ("completed", "failed", "cancelled"):
                break
            if event == "failed":
                retries += 1
                name = "failed" if retries > max_retries else "pending"
            elif event in ("completed", "cancelled"):
                name = event
        state.update((name, retries))
        yield pd.DataFrame({"task_id": [key[0]], "state": [name], "retries": [retries]})

    return events.groupBy("task_id").applyInPandasWithState(step, "task_id string, state string, retries int", "state string, retries int", "update", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"):
    """Process all that is there, batch by batch; ``work`` gets each batch and its id and should write idempotently by id."""
    query = stream.writeStream.outputMode(mode).foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def queue_stats(states: DataFrame) -> DataFrame:
    """Tasks by state, and how many are active."""
    return states.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("state").isin("pending", "running")).alias("active"))


class Tasks:
    """Q5: background work of the driver: each task runs in a thread of its own under a job group, and tells its state and progress."""

    def __init__(self, spark: SparkSession):
        self.spark, self.records, self.lock = spark, {}, threading.Lock()

    def submit(self, name: str, work: Callable, *args) -> None:
        """Start work(report, *args); report(done, total) tells how far it is."""
        record = {"state": "pending", "done": 0, "total": 0, "result": None, "error": None}
        with self.lock:
            if name in self.records:
                raise ValueError(f"there is a task {name} already")
            self.records[name] = record

        def report(done: int, total: int) -> None:
            record.update(done=done, total=total)

        def run() -> None:
            self.spark.sparkContext.setJobGroup(name, name, True)
            record["state"] = "running"
            try:
                record.update(result=work(report, *args), state="completed")
            except Exception as e:  # noqa: BLE001  told by the record
                record.update(error=str(e) or type(e).__name__, state="cancelled" if record["state"] == "cancelled" else "failed")

        record["thread"] = InheritableThread(target=run, daemon=True)
        record["thread"].start()

    def cancel(self, name: str) -> None:
        """Stop a task's running jobs."""
        self.records[name]["state"] = "cancelled"
        self.spark.sparkContext.cancelJobGroup(name)

    def wait(self, name: str, seconds: float | None = None) -> dict:
        self.records[name]["thread"].join(seconds)
        return self.state(name)

    def state(self, name: str) -> dict:
        return {k: v for k, v in self.records[name].items() if k != "thread"}
