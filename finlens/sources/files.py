"""CSV scan with pandas-style missing tokens and counted cast failures.

The file is read with an explicit all-string schema (no inference pass), each
missing token becomes null, and every column is ``try_cast`` to its target
type.  A value that is neither a missing token nor castable is *counted* per
column (``bad_values``) instead of being silently nulled.  A missing path and a
malformed file are different errors: the first raises ``FileNotFoundError`` when
the DataFrame is created, the second fails the scan (``FAILFAST``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from finlens.functions.exprs import c

# The tokens the pandas CSV reader treats as missing by default.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
             "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_csv_raw(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """All columns of ``schema`` as text, found by the header's names whatever their order; other columns are left
    out, a missing one is an error.  Quotes inside a quoted field are doubled.  ``multi_line``: quoted fields may
    hold line ends (a file is then one task)."""
    reader = (spark.read.option("header", True).option("mode", "FAILFAST").option("nullValue", None).option("emptyValue", "")
              .option("escape", '"').option("multiLine", multi_line).option("enforceSchema", False))
    try:
        header = reader.csv(path).columns
        missing = [f.name for f in schema.fields if f.name not in header]
        if missing:
            raise ValueError(f"{path}: no column {', '.join(missing)} in the header")
        have = StructType([StructField(n, StringType(), True) for n in header])
        return reader.schema(have).csv(path).select(*[c(f.name) for f in schema.fields])
    except AnalysisException as e:  # PATH_NOT_FOUND is raised while the DataFrame is created
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(path) from e
        raise


# The texts that the pandas CSV reader takes for booleans.
TRUE_TOKENS, FALSE_TOKENS = ("True", "TRUE", "true"), ("False", "FALSE", "false")


def infer_types(raw: DataFrame, tokens=NA_TOKENS) -> StructType:
    """The column types that the pandas CSV reader would choose for text columns, from one aggregate.

    A type holds if every value that is no missing token reads as it: boolean, else integer, else floating point, else text.
    Missing values make an integer column floating point and a boolean one text; a column of missing values
    only is floating point, one without rows text."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, x in enumerate(raw.columns):
        col = c(x)
        text, there = F.trim(col), ~_missing(col, tokens)
        number = text.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$") | F.lower(text).rlike(r"^[+-]?inf(inity)?$")
        whole = text.rlike(r"^[+-]?\d+$") & text.try_cast("bigint").isNotNull()
        aggs += [F.count(F.when(there, 1)).alias(f"n{i}"), F.count(F.when(there & text.isin(*TRUE_TOKENS, *FALSE_TOKENS), 1)).alias(f"b{i}"),
                 F.count(F.when(there & whole, 1)).alias(f"i{i}"), F.count(F.when(there & number, 1)).alias(f"f{i}")]
    r = raw.agg(*aggs).first()
    out = StructType()
    for i, x in enumerate(raw.columns):
        n, full = r[f"n{i}"], r[f"n{i}"] == r["rows"]
        if not r["rows"]:
            kind = StringType()
        elif not n:
            kind = DoubleType()
        elif r[f"b{i}"] == n:
            kind = BooleanType() if full else StringType()
        elif r[f"i{i}"] == n:
            kind = LongType() if full else DoubleType()
        else:
            kind = DoubleType() if r[f"f{i}"] == n else StringType()
        out.add(x, kind, True)
    return out


def read_csv_inferred(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV file with a header, its types inferred from all of its rows."""
    try:
        header = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path).columns
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(path) from e
        raise
    raw = read_csv_raw(spark, path, StructType([StructField(n, StringType(), True) for n in header]), multi_line)
    return typed(raw, infer_types(raw))


def _missing(col, tokens) -> F.Column:
    return col.isNull() | F.trim(col).isin(*tokens)


def typed(raw: DataFrame, schema: StructType, tokens=NA_TOKENS) -> DataFrame:
    out = []
    for f in schema.fields:
        col = c(f.name)
        val = F.when(_missing(col, tokens), F.lit(None))
        if isinstance(f.dataType, StringType):
            out.append(val.otherwise(col).alias(f.name))
        else:
            out.append(val.otherwise(F.trim(col).try_cast(f.dataType)).alias(f.name))  # NaN is a missing token
    return raw.select(*out)


def bad_values(raw: DataFrame, schema: StructType, tokens=NA_TOKENS) -> DataFrame:
    """Per column: values that are no missing token yet fail the cast (one pass)."""
    aggs = []
    cols = [f for f in schema.fields if not isinstance(f.dataType, StringType)]
    for i, f in enumerate(cols):
        col = c(f.name)
        bad = ~_missing(col, tokens) & F.trim(col).try_cast(f.dataType).isNull()
        aggs.append(F.count(F.when(bad, 1)).alias(f"b{i}"))
    if not aggs:
        return raw.sparkSession.createDataFrame([], "column string, bad_values long")
    agg = raw.agg(*aggs)
    return agg.select(F.inline(F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"b{i}").alias("bad_values"))
                                         for i, f in enumerate(cols)])))


def read_csv(spark: SparkSession, path: str, schema: StructType, tokens=NA_TOKENS) -> DataFrame:
    return typed(read_csv_raw(spark, path, schema), schema, tokens)


def write_csv(df: DataFrame, path: str, na: str = "NA", single_file: bool = False) -> None:
    """Write with a header; missing values written as ``na``.  ``single_file``
    only for small report tables (it funnels the data through one task)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("nullValue", na).option("escape", '"').csv(path)
