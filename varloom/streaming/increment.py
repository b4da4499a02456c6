"""A streaming front end of the annotation store, an extension: new calls are annotated once, as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from varloom.operators import store


def annotate_stream(calls: DataFrame, deltas: store.DeltaStore, annotate: Callable[[DataFrame], DataFrame], source: str, release: str, checkpoint: str) -> StreamingQuery:
    """Each batch's keys that the store lacks go through annotate (variant_key and columns) and are committed under the batch's id.

    calls: a streaming frame with variant_key. A batch writes its own rows only, and one that is repeated after a failure changes nothing.
    """

    def step(batch: DataFrame, number: int) -> None:
        keys = batch.select("variant_key").where(F.col("variant_key").isNotNull()).distinct()
        now = deltas.current()
        if now is not None and f"{source}_release" in now.columns:
            keys = store.increment(keys, now, f"{source}_release", release)
        if keys.isEmpty():
            return
        deltas.commit(annotate(keys), f"{source}-{release}-{number}", f"{source}_release", release)

    return calls.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
