"""Human gates as tables: a model's proposals count only after approval of their exact content.

The ledger is a folder of JSON lines that Spark appends to and reads; a digest's status is its last event, by one aggregate.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Names of events, and what a digest without one has.
PROPOSAL, APPROVAL, REJECTION, ABSENT = "proposal", "approval", "rejection", "absent"
EVENTS = "event_id string, ts double, event string, digest string, kind string, model string, prompt string, response string, context string, approver string, reason string"
PROPOSALS = "kind string, context string, prompt string, response string, model string, digest string"


def digest(payload: dict) -> str:
    """Equal content has equal digests, whatever the order of its keys."""
    return "sha256:" + hashlib.sha256(json.dumps(payload, sort_keys=True, default=str).encode()).hexdigest()


def _content(kind: str, context: str, response: str) -> str:
    return digest({"kind": kind, "context": json.loads(context), "response": response})


def propose(contexts: DataFrame, model: Callable[[str], str], *, kind: str, render: Callable[[dict], str] | None = None, name: str | None = None) -> DataFrame:
    """Proposals of a model for contexts (one column of JSON, context): kind, context, prompt, response, model, digest.

    The model is called once a row in the tasks that hold them; each run of the plan calls it again, so write what it returns.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            prompts = [render(json.loads(c)) if render else json.dumps(json.loads(c), sort_keys=True) for c in pdf["context"]]
            said = [model(p) for p in prompts]
            yield pd.DataFrame(
                {"kind": kind, "context": pdf["context"], "prompt": prompts, "response": said, "model": name, "digest": [_content(kind, c, r) for c, r in zip(pdf["context"], said, strict=True)]}
            )

    return contexts.select("context").mapInPandas(run, PROPOSALS)


@F.pandas_udf(StringType())
def content_digest(kind: pd.Series, context: pd.Series, response: pd.Series) -> pd.Series:
    """The digest that a proposal's content has now."""
    return pd.Series([_content(k, c, r) for k, c, r in zip(kind, context, response, strict=True)])


def proposed(proposals: DataFrame) -> DataFrame:
    """The events of new proposals; proposing again withdraws an approval."""
    return _stamped(proposals.select("digest", "kind", "model", "prompt", "response", "context"), PROPOSAL)


def decided(proposals: DataFrame, approver: str, *, approve: bool = True, reason: str | None = None) -> DataFrame:
    """The events of one person's decision on proposals; reading a row whose content is not what its digest says raises."""
    if not approver:
        raise ValueError("an approver is required")
    same = content_digest("kind", "context", "response") == F.col("digest")
    rows = proposals.select(F.when(same, F.col("digest")).otherwise(F.raise_error(F.lit("the proposal was changed after it was made"))).alias("digest"), "kind")
    return _stamped(rows, APPROVAL if approve else REJECTION).withColumns({"approver": F.lit(approver), "reason": F.lit(reason).cast("string")})


def _stamped(rows: DataFrame, event: str) -> DataFrame:
    """One time for all events of a call, which orders calls."""
    return rows.withColumns({"event": F.lit(event), "ts": F.unix_micros(F.current_timestamp()) / 1e6, "event_id": F.uuid()})


class Ledger:
    """A folder of events, which is only ever added to."""

    def __init__(self, path: str) -> None:
        self.path = path

    def append(self, events: DataFrame) -> None:
        events.write.mode("append").json(self.path)

    def records(self, spark: SparkSession) -> DataFrame:
        """All events; none before the first."""
        try:
            return spark.read.schema(EVENTS).json(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], EVENTS)


def latest(events: DataFrame, order: Column | None = None) -> DataFrame:
    """digest, status: each digest's last event. Events of one time: an approval goes behind a rejection, a proposal before all."""
    rank = F.when(F.col("event") == REJECTION, 2).when(F.col("event") == APPROVAL, 1).otherwise(0)
    return events.groupBy("digest").agg(F.max_by("event", F.struct("ts", rank) if order is None else order).alias("status"))


def statuses(digests: DataFrame, events: DataFrame) -> DataFrame:
    """digests' rows with status: the last event, or absent."""
    return digests.join(latest(events), "digest", "left").withColumn("status", F.coalesce("status", F.lit(ABSENT)))


def approved_points(proposals: DataFrame, events: DataFrame) -> DataFrame:
    """proposals (points and what propose returns) with counted: points where the last word on the exact content is approval, else 0."""
    now = proposals.withColumn("_now", content_digest("kind", "context", "response"))
    last = latest(events).select(F.col("digest").alias("_now"), "status")
    return now.join(last, "_now", "left").withColumn("counted", F.when(F.col("status") == APPROVAL, F.col("points").cast("double")).otherwise(0.0)).drop("_now", "status")

