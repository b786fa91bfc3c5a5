"""Registered queries: one Spark callable + (where expressible) one oracle SQL
text per operator of the inventory.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the given tables (or data Spark derives from them); nothing runs on fixed input
alone.  Column names match the SQL aliases exactly; floats are rounded the same
way on both sides so an order-insensitive value hash can compare them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlens.functions.exprs import round_half_away
from finlens.sources.tables import ACCOUNTS_SQL, accounts, load_table
from finlens.spec import ACCOUNTS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Rounding digits for compared floats (log-scale metrics 4,
# correlations / moments 6, money 2).
D_MONEY = 2
D_STAT = 6
D_LOG = 4
D_PRED = 5

ACC_WITH = f"WITH accounts AS ({ACCOUNTS_SQL})"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def rnd(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({k: round_half_away(F.col(k), d) for k, d in digits.items()})


# Numeric columns of the accounts view that are profiled.
ACC_NUM = ("price", "ebitda", "eps", "pe", "volume", "low52", "high52", "target")
LI_NUM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")

from finlens.plans import queries_profile  # noqa: E402,F401  (registers)
from finlens.plans import queries_charts  # noqa: E402,F401
from finlens.plans import queries_model  # noqa: E402,F401
from finlens.plans import queries_io  # noqa: E402,F401
