"""Score claims as files arrive: ``readStream`` -> fitted pipeline -> flag -> sink.

The reference scores one typed-in claim at a time; the batch form is
``operators.score``. This is the same operator on a stream: every transformation
in a fitted feature pipeline and forest is row-local, so the streaming plan has
no state, no shuffle and no watermark. The sink writes with a checkpoint in the
shared folder, so a restarted query resumes without rescoring or losing files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tabulon.operators.score import score_claims


def score_claims_stream(spark: SparkSession, model: PipelineModel, source_dir: str, schema: StructType,
                        actual: str, id_cols: Sequence[str] = (), max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming DataFrame of (ids, Expected_Expenses, Actual_Expenses, Claim_Status)."""
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))
    return score_claims(model, stream, actual, id_cols)


def start_claims_scoring(scored: DataFrame, output_dir: str, checkpoint: str | None = None,
                         trigger_seconds: int | None = None, available_now: bool = False) -> StreamingQuery:
    """Append scored claims to Parquet; exactly-once via the file sink's log.

    The checkpoint lies beside the output (``<output_dir>.checkpoint``) unless one is
    named, so a restart with the same output goes on where the last run stopped.

    ``available_now`` processes everything present at start (in bounded micro-batches)
    and stops — a restartable batch run; otherwise the query keeps running.
    """
    ckpt = checkpoint or f"{output_dir.rstrip('/')}.checkpoint"
    w = (scored.writeStream.format("parquet").outputMode("append")
         .option("path", output_dir).option("checkpointLocation", ckpt))
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
