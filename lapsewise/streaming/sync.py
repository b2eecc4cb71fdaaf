"""New snapshot files keep the serving table up to date."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from lapsewise.plans.store import ServingTable


def incremental_sync(
    table: ServingTable,
    source: str,
    schema: StructType,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Process the snapshot files not seen before, then stop; run it on a schedule.

    Each micro-batch reduces to its latest row per entity and is merged into the
    serving table.  State lives in that table and the stream checkpoint, both on
    shared storage, so a lost executor or driver costs a replay of one batch.
    """
    reader = table.spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    # Batch numbers restart with a new checkpoint, so its path is part of the id.
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.merge(f"stream-{stream}-{batch_id}", batch)

    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
