"""The quality gate of a stream: good rows go into the lake, bad ones into a quarantine table, and each micro-batch is counted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallow.operators import quality
from tallow.operators.dedupe import keep_last
from tallow.settings import get_logger
from tallow.sources import lake

Listener = Callable[[int, dict[str, int]], None]


def log_counts(batch_id: int, counts: dict[str, int]) -> None:
    broken = {rule: n for rule, n in counts.items() if n and rule not in ("rows", "quarantined")}
    get_logger("gate").info("batch %d: %d rows, %d quarantined %s", batch_id, counts["rows"], counts["quarantined"], broken or "")


def gate_batch(batch: DataFrame, batch_id: int, root: str, quarantine: str, dataset: lake.Dataset = lake.CANDLE_SET, listener: Listener = log_counts) -> None:
    """One micro-batch. Replaying it changes nothing: the lake's upsert is by key, and a batch has its own quarantine folder.

    Rows that break a row rule are quarantined with ``broken``; of good rows of one key the later ingested goes on. The counts
    of the rules are observed while the quarantine is written, not in a pass of their own.
    """
    rules = quality.row_rules(dataset.rules)
    marked = quality.broken_rules(batch.select(dataset.schema.fieldNames()), dataset.rules).persist()
    try:
        seen = Observation()
        observed = marked.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.size("broken") > 0).alias("quarantined"),
            *(F.count_if(F.array_contains("broken", r.name)).alias(r.name) for r in rules),
        )
        observed.filter(F.size("broken") > 0).write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch_id={batch_id}")
        good = marked.filter(F.size("broken") == 0).drop("broken")
        lake.upsert(keep_last(good, key=dataset.key), root, dataset, allow_empty=True)
        listener(batch_id, {k: int(v) for k, v in seen.get.items()})
    finally:
        marked.unpersist()


def gated_stream(rows: DataFrame, root: str, quarantine: str, checkpoint: str, dataset: lake.Dataset = lake.CANDLE_SET, listener: Listener = log_counts, **trigger) -> StreamingQuery:
    """Runs the gate on every micro-batch of a stream of candles or trades."""

    def write(batch: DataFrame, batch_id: int) -> None:
        gate_batch(batch, batch_id, root, quarantine, dataset, listener)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
