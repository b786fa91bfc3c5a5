"""Column roles and run constants.

A :class:`Spec` tells every operator which column is the row key, the target,
the category and the numeric features.  Two presets exist: ``FINANCIALS`` for
the company-ratio CSV layout and ``ACCOUNTS`` for the test view derived from the
``customer`` / ``orders`` tables (see ``finlens.sources.tables.accounts``).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Spec:
    key: str
    target: str
    category: str
    numeric: tuple[str, ...]
    identifiers: tuple[str, ...] = ()
    label: str | None = None  # human readable row name (used in reports)
    price: str | None = None  # must be > 0 after cleaning
    clip_cols: tuple[str, ...] = ()  # negatives clipped to 0 while cleaning
    # derived features: name -> (kind, source, [denominator])
    ratios: tuple[tuple[str, str, str], ...] = ()  # (name, numerator, denominator)
    logs: tuple[tuple[str, str], ...] = ()  # (name, source)
    seed: int = 42
    test_share: float = 0.2
    folds: int = 5
    unit: float = 1e9  # money reporting unit (billions)
    key_columns: tuple[str, ...] = field(default=())  # columns reported by the pair plot

    def with_(self, **kw) -> "Spec":
        return replace(self, **kw)

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + (self.category,)

    @property
    def derived(self) -> tuple[str, ...]:
        return tuple(r[0] for r in self.ratios) + tuple(l[0] for l in self.logs)


# The company-ratio layout of the surveyed job (column names,
# target, ratios, logs, clip list, seed 42, test share 0.2, five folds).
FINANCIALS = Spec(
    key="Symbol",
    target="Market Cap",
    category="Sector",
    numeric=(
        "Price", "Price/Earnings", "Dividend Yield", "Earnings/Share",
        "52 Week Low", "52 Week High", "EBITDA", "Price/Sales", "Price/Book",
    ),
    identifiers=("Symbol", "Name", "SEC Filings"),
    label="Name",
    price="Price",
    clip_cols=("Earnings/Share", "EBITDA", "Price/Earnings"),
    ratios=(
        ("EBITDA_Price_Ratio", "EBITDA", "Price"),
        ("Earnings_Price_Ratio", "Earnings/Share", "Price"),
    ),
    logs=(
        ("Price_log", "Price"),
        ("EBITDA_log", "EBITDA"),
        ("Price/Sales_log", "Price/Sales"),
    ),
    key_columns=("Price", "EBITDA", "Price/Earnings", "Market Cap"),
)

# The same roles on the ``accounts`` view built from the driver's tables.
ACCOUNTS = Spec(
    key="id",
    target="target",
    category="sector",
    numeric=("price", "ebitda", "eps", "pe", "volume", "low52", "high52"),
    identifiers=("id", "name"),
    label="name",
    price="price",
    clip_cols=("eps", "ebitda", "pe"),
    ratios=(
        ("ebitda_price_ratio", "ebitda", "price"),
        ("eps_price_ratio", "eps", "price"),
    ),
    logs=(
        ("price_log", "price"),
        ("ebitda_log", "ebitda"),
        ("volume_log", "volume"),
    ),
    key_columns=("price", "ebitda", "pe", "target"),
)
