"""What the two text classifiers share: a bounded sample of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAIN = 1 << 30


def bounded_sample(rows: DataFrame, most: int, *key: str) -> DataFrame:
    """About ``most`` rows, never over twice as many, chosen by a hash of the key alone: all rows if there are fewer.  Where one
    key stands on so many rows that twice ``most`` is reached, the first by hash and columns: the same in every run."""
    n = rows.count()
    share = min(GRAIN, -(-GRAIN * most // max(n, 1)))
    chosen = rows.where(F.pmod(F.xxhash64(*key), F.lit(GRAIN)) < share)
    if share == GRAIN or chosen.count() <= 2 * most:
        return chosen
    return chosen.orderBy(F.xxhash64(*key), *rows.columns).limit(2 * most)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus
