"""Result tables, fitted pipelines and the report dataset.

All paths live under the shared folder the cluster names in
``spark.checkpoint.dir`` unless the caller passes its own; nothing is written
to a machine-local folder.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from finlens.functions.exprs import slug_str
from finlens.sources.files import write_csv


def write_table(df: DataFrame, path: str, csv: bool = True, parquet: bool = True) -> bool:
    """S3: write a (small) result table as CSV with header and as Parquet.
    An empty table is skipped (returns ``False``), as the surveyed job does."""
    if df.isEmpty():
        return False
    if csv:
        write_csv(df, os.path.join(path, "csv"), single_file=True)
    if parquet:
        df.write.mode("overwrite").parquet(os.path.join(path, "parquet"))
    return True


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """Read a written result table back (Parquet keeps the types)."""
    p = os.path.join(path, "parquet")
    try:
        return spark.read.parquet(p)
    except Exception:  # noqa: BLE001 — no table: the caller falls back
        return None


def model_path(base: str, name: str) -> str:
    return os.path.join(base, f"{slug_str(name)}_model")


def save_model(model: PipelineModel, base: str, name: str) -> str:
    """Persist a fitted pipeline under a name derived from the model name."""
    p = model_path(base, name)
    model.write().overwrite().save(p)
    return p


def load_model(base: str, name: str, required: bool = False) -> PipelineModel | None:
    """Load by name; unknown / missing -> ``None`` (explain path) or an
    error when ``required`` (serving path)."""
    p = model_path(base, name)
    try:
        return PipelineModel.load(p)
    except Exception as e:  # noqa: BLE001
        if required:
            raise FileNotFoundError(f"model {name!r} not found at {p}") from e
        return None


def write_report(path: str, comparison: DataFrame, best: str | None, insights: DataFrame | None) -> dict[str, str]:
    """Three small tables (``comparison``, ``best``, ``insights``) in one
    output folder."""
    spark = comparison.sparkSession
    out = {}
    for name, df in (("comparison", comparison),
                     ("best", spark.createDataFrame([(best,)], "model string")),
                     ("insights", insights)):
        if df is None:
            continue
        p = os.path.join(path, name)
        df.write.mode("overwrite").parquet(p)
        out[name] = p
    return out
