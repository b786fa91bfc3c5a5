"""Key-based split, folds, bounded sample and label lookup.

Spark rows have no index, so every assignment is a pure function of the row
key: ``md5(salt|key)`` -> bucket.  The result is independent of partitioning,
survives task retries unchanged, and the same expression runs in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.functions.exprs import c, hash_bucket


def test_flag(key: str, seed: int = 42, test_share: float = 0.2):
    # buckets of a hundredth, or of a millionth where the share is no whole percent
    parts = 100 if abs(test_share * 100 - round(test_share * 100)) < 1e-9 else 1_000_000
    return hash_bucket(key, str(seed), parts) < F.lit(int(round(test_share * parts)))


def train_test_split(df: DataFrame, key: str, seed: int = 42, test_share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Disjoint, complete 80/20 split by key hash."""
    flag = test_flag(key, seed, test_share)
    return df.where(~flag), df.where(flag)


def with_split(df: DataFrame, key: str, seed: int = 42, test_share: float = 0.2, name: str = "is_test") -> DataFrame:
    return df.withColumn(name, test_flag(key, seed, test_share))


def with_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """``fold`` in [0, k) from a second salt of the same hash."""
    return df.withColumn(name, hash_bucket(key, f"fold{seed}", k).cast("int"))


def bounded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Deterministic sample of at most ``n`` rows (top-n by key hash).
    Runs as a per-partition top-n plus one merge of ``n x partitions`` rows."""
    order = F.md5(F.concat(F.lit(f"s{seed}|"), c(key).cast("string")))
    return df.orderBy(order, c(key)).limit(n)


def label_lookup(rows: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Inner equi-join on the unique key."""
    return rows.join(names, key, "inner")
