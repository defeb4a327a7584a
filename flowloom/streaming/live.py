"""Live jobs: packets to flows with late-data handling, and scoring of a growing file folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from flowloom.operators.cleaning import inference_clean
from flowloom.operators.decisions import verdicts
from flowloom.operators.models import score_binary
from flowloom.operators.packets import flows_in_session_windows
from flowloom.operators.schema import strip_names


def stream_flows(packets: DataFrame, gap_seconds: int, delay: str = "10 minutes") -> DataFrame:
    """Finished flows of a packet stream; packets later than `delay` are dropped.

    State per open flow is one row of sums. A flow is emitted once the watermark
    has passed its end, so flows still open stay in state. Packets of one flow
    are merged before the shuffle, which keeps a busy endpoint pair small.
    """
    packets.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return flows_in_session_windows(packets.withWatermark("ts", delay), gap_seconds)


def stream_verdicts(
    flows: DataFrame,
    model: PipelineModel,
    features: Sequence[str],
    fills: Mapping[str, float],
    threshold: float,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Clean with training parameters, score and judge; the same code serves batch frames."""
    ready = inference_clean(strip_names(flows), features, fills, keep)
    return verdicts(score_binary(ready, model), threshold, keep=keep)


def read_growing_csv(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """Stream of flow CSV files that keep arriving in a folder."""
    reader = spark.readStream.schema(schema).option("header", True)
    return reader.option("maxFilesPerTrigger", files_per_batch).csv(folder)


def run_available(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Process everything that is there now into a Parquet folder, exactly once."""
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
