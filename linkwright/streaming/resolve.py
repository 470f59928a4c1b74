"""References that arrive as a stream, resolved against a static set of records in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from linkwright.plans.solver import solve
from linkwright.sources.tables import write_lists


def resolve_stream(refs: DataFrame, records: DataFrame, out: str, checkpoint: str, threshold: float = 0.38) -> StreamingQuery:
    """Each batch's matches go to ``out``/batch=<n>; a repeated batch overwrites its own folder, so retries are safe."""

    def batch(df: DataFrame, n: int) -> None:
        write_lists(solve(df, records, threshold), f"{out}/batch={n}", "matched_entity_ids")

    return refs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
