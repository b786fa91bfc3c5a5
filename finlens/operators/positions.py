"""Row numbers without a one-task window.

A range partitioning sorts the rows, each row keeps its number within its partition, and the partitions' row counts
(one row per partition) turn these into global numbers.  Groups may be of any size: a group that holds a third of all
rows lies in as many partitions as it fills, and what is added per group comes by (partition, group), never by group
alone.  The sorted rows are written below the shared checkpoint folder first, so that bounds and numbers stay the same
when a lost executor's work is done again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlens.session import scratch_path

_LOCAL = (1 << 33) - 1  # monotonically_increasing_id: partition in the upper bits, row in the lower 33


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df from a table below the shared checkpoint folder, so that later passes read the same ones."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_rows(df: DataFrame, order: list[Column | str], by: list[str] | None = None, name: str = "position",
                count: str | None = None, ordinal: str | None = None, parts: int | None = None) -> DataFrame:
    """All columns of df and ``name``, the number of the row from 0 in ``order``; within its group if ``by`` names
    columns (nulls are one group).  ``count`` adds the rows of the group (of the table without ``by``), ``ordinal`` the
    number of the group from 0 in the order of ``by``.  Nulls come first.  Rows that are equal in ``by`` and ``order``
    are numbered in no stated order and are sorted in one task, so ``order`` should tell rows apart.  An empty table
    stays empty."""
    by = list(by or [])
    spark = df.sparkSession
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    sort = [F.col(f"`{c}`").asc_nulls_first() for c in by] + [F.col(f"`{c}`").asc_nulls_first() if isinstance(c, str) else c for c in order]
    rows = written(df.repartitionByRange(parts, *sort).sortWithinPartitions(*sort).withColumn("_m", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_p", F.shiftright("_m", 33)).withColumn("_m", F.col("_m").bitwiseAND(F.lit(_LOCAL)))
    here = rows.groupBy("_p", *by).agg(F.count(F.lit(1)).alias("_here"), F.min("_m").alias("_first"))
    if by:
        here = written(here, "numbered-groups")  # one row for each partition and group in it
    before, total = [], 0
    for r in here.groupBy("_p").agg(F.sum("_here").alias("n")).orderBy("_p").collect():  # one row for each partition
        before.append((r["_p"], total))
        total += r["n"]
    start = F.broadcast(spark.createDataFrame(before, "_p long, _before long"))
    if not by:
        out = rows.join(start, "_p").withColumn(name, F.col("_before") + F.col("_m"))
        return (out.withColumn(count, F.lit(total).cast("long")) if count else out).drop("_p", "_m", "_before")
    here = here.join(start, "_p").withColumn("_at", F.col("_before") + F.col("_first"))
    groups = here.groupBy(*by).agg(F.min("_at").alias("_start"), F.sum("_here").alias("_size"))
    if ordinal:
        groups = number_rows(groups, by, name="_ordinal", parts=parts)
    add = here.join(groups.withColumnsRenamed({c: f"_by_{c}" for c in by}),
                    _all([here[c].eqNullSafe(F.col(f"`_by_{c}`")) for c in by]))
    add = add.select(F.col("_p").alias("_q"), *[f"_by_{c}" for c in by], (F.col("_before") - F.col("_start")).alias("_shift"), "_size",
                     *(["_ordinal"] if ordinal else []))
    out = rows.join(add, _all([F.col("_p") == F.col("_q")] + [F.col(f"`{c}`").eqNullSafe(F.col(f"`_by_{c}`")) for c in by]))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_shift") + F.col("_m")).alias(name),
                      *([F.col("_size").alias(count)] if count else []), *([F.col("_ordinal").alias(ordinal)] if ordinal else []))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
