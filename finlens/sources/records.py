"""Typed JSON records with required fields; bad input is rejected with a
reason instead of raising.

Fields are parsed as strings first (so a numeric string is accepted, as a lax
validator would) and cast with ``try_cast``; a string field must be a JSON
string, a number there is a type error.  ``PERMISSIVE`` parsing marks
malformed text, but a missing or null field is not an error for the parser, so
the required-field check is separate.  Output: the typed fields plus ``valid``
and ``reason`` (comma-joined ``malformed`` / ``missing:<f>`` / ``type:<f>``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from finlens.functions.exprs import c

CORRUPT = "_corrupt"


def record_schema(fields: dict[str, str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in fields] + [StructField(CORRUPT, StringType(), True)])


def parse_records(df: DataFrame, col: str, fields: dict[str, str], keep: Sequence[str] = (),
                  required: Sequence[str] | None = None, aliases: dict[str, str] | None = None) -> DataFrame:
    """``fields``: JSON name -> Spark type (``"double"``, ``"string"``).
    ``aliases`` renames JSON names to output column names."""
    required = list(fields) if required is None else list(required)
    aliases = aliases or {}
    p = F.from_json(c(col), record_schema(fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    texts = [n for n, t in fields.items() if t == "string"]
    kind = {n: F.schema_of_variant(F.try_variant_get(F.try_parse_json(c(col)), f'$["{n}"]', "variant")).alias(f"__k{i}")
            for i, n in enumerate(texts)}
    parsed = df.select(*[c(k) for k in keep], p.alias("__r"), *kind.values())
    malformed = F.col("__r").isNull() | F.col(f"__r.{CORRUPT}").isNotNull()
    reasons = [F.when(malformed, F.lit("malformed"))]
    out = {}
    for name, typ in fields.items():
        raw = F.col("__r").getField(name)
        val = raw if typ == "string" else F.trim(raw).try_cast(typ)
        out[aliases.get(name, name)] = val
        if name in required:
            reasons.append(F.when(~malformed & raw.isNull(), F.lit(f"missing:{name}")))
        if typ == "string":
            wrong = ~F.coalesce(F.col(f"__k{texts.index(name)}"), F.lit("VOID")).isin("STRING", "VOID")
            reasons.append(F.when(~malformed & raw.isNotNull() & wrong, F.lit(f"type:{name}")))
        else:
            reasons.append(F.when(~malformed & raw.isNotNull() & val.isNull(), F.lit(f"type:{name}")))
    reason = F.concat_ws(",", *reasons)
    res = parsed.select(*[c(k) for k in keep], *[v.alias(k) for k, v in out.items()], reason.alias("reason"))
    return res.withColumn("valid", F.col("reason") == "").withColumn(
        "reason", F.when(F.col("valid"), F.lit(None)).otherwise(F.col("reason")))


def valid_records(parsed: DataFrame) -> DataFrame:
    return parsed.where("valid").drop("valid", "reason")


def rejected_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("valid"))


def to_records(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = (), col: str = "value",
               aliases: dict[str, str] | None = None) -> DataFrame:
    """Rows -> JSON text (null fields omitted, as a client would send them)."""
    aliases = aliases or {}
    return df.select(*[c(k) for k in keep], F.to_json(F.struct(*[c(f).alias(aliases.get(f, f)) for f in fields]))
                     .alias(col))
