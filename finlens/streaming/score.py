"""Scoring of typed JSON records, batch and streaming.

The request/response loop of a single-machine service is re-aimed as Spark
jobs: records arrive as JSON text, are validated (S2), scored by the fitted
``PipelineModel`` and converted back from the log target.  The stream version
is stateless: ``readStream`` over a folder of JSON-lines files, the same
transformation, a Parquet sink with a checkpoint (exactly-once per file), and
``availableNow`` so a run drains what is there and stops.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlens.functions.exprs import inverse_target
from finlens.sources.records import parse_records, rejected_records, valid_records


def score(model: PipelineModel, records: DataFrame, fields: dict[str, str], keep=(), col: str = "value",
          aliases: dict[str, str] | None = None, correction: float | None = None,
          out: str = "predicted") -> DataFrame:
    """Validate -> transform -> ``expm1`` (``correction=None`` is the
    serving path without bias correction, F3).  Rejected records are not
    scored; :func:`rejects` gives them with their reasons."""
    ok = valid_records(parse_records(records, col, fields, keep=keep, aliases=aliases))
    return model.transform(ok).withColumn(out, inverse_target("prediction", correction))


def rejects(records: DataFrame, fields: dict[str, str], keep=(), col: str = "value",
            aliases: dict[str, str] | None = None) -> DataFrame:
    """The records that :func:`score` does not score, as received, with the reason."""
    kept = records.withColumn("__raw", F.col(col))
    return (rejected_records(parse_records(kept, col, fields, keep=[*keep, "__raw"], aliases=aliases))
            .select(*keep, F.col("__raw").alias("record"), "reason"))


def score_stream(spark: SparkSession, model: PipelineModel, source_dir: str, sink_dir: str, checkpoint_dir: str,
                 fields: dict[str, str], keep_cols: list[str], aliases: dict[str, str] | None = None,
                 correction: float | None = None, out: str = "predicted", reject_dir: str | None = None) -> DataFrame:
    """Drain ``source_dir`` (JSON lines, one record per line; the key is a
    record field) into a Parquet sink; returns the sink as a batch DataFrame.
    Rejected records go with their reason to a second sink, ``reject_dir``
    (by default the sink's name with ``-rejected``)."""
    src = spark.readStream.schema("value string").text(source_dir)
    scored = score(model, src, fields, col="value", aliases=aliases, correction=correction, out=out)
    q = (scored.select(*keep_cols).writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).outputMode("append").start())
    bad = (rejects(src, fields, aliases=aliases).writeStream.format("parquet")
           .option("path", reject_dir or sink_dir.rstrip("/") + "-rejected")
           .option("checkpointLocation", checkpoint_dir.rstrip("/") + "-rejected").trigger(availableNow=True).outputMode("append").start())
    q.awaitTermination()
    bad.awaitTermination()
    return spark.read.parquet(sink_dir)


def predict_one(spark: SparkSession, model: PipelineModel, record_json: str, fields: dict[str, str],
                model_name: str | None = None, aliases: dict[str, str] | None = None) -> DataFrame:
    """R2 helper: one JSON record through R1 (a one-row DataFrame), tagged with
    the model name."""
    df = spark.createDataFrame([(record_json,)], "value string")
    return score(model, df, fields, aliases=aliases).select("predicted").withColumn("model", F.lit(model_name))
