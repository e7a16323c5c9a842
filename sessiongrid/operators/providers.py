"""Raw histories of two providers in the library's columns.

Rows of many securities are taken together: the ticker is a column. Where a day comes twice, the last row by an explicit
order stays, since rows of a table have no order of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_ticker
from .nominal import keep_last, restore_nominal

#: Columns of the equity history and what they are called here; those that must be there (fixed values).
EQUITY = {
    "HGDG_TARIH": "date", "HGDG_KAPANIS": "is_adjusted_close", "HGDG_AOF": "is_adjusted_weighted_average", "HGDG_MIN": "is_adjusted_low", "HGDG_MAX": "is_adjusted_high", "HGDG_HACIM": "is_tl_volume", "HG_KAPANIS": "is_raw_close",
    "HG_AOF": "is_raw_weighted_average", "HG_MIN": "is_raw_low", "HG_MAX": "is_raw_high", "HG_HACIM": "is_raw_tl_volume", "PD": "is_market_cap_try", "PD_USD": "is_market_cap_usd", "HAO_PD": "is_free_float_market_cap_try",
    "HAO_PD_USD": "is_free_float_market_cap_usd",
}
EQUITY_REQUIRED = ["HGDG_TARIH", "HGDG_KAPANIS", "HGDG_AOF", "HGDG_MIN", "HGDG_MAX", "HGDG_HACIM", "HG_KAPANIS", "HG_AOF", "HG_MIN", "HG_MAX", "HG_HACIM"]
EQUITY_COLUMNS = [
    "ticker", "date", "is_raw_high", "is_raw_low", "is_raw_close", "is_raw_weighted_average", "is_adjusted_high", "is_adjusted_low", "is_adjusted_close", "is_adjusted_weighted_average", "is_tl_volume", "is_raw_tl_volume",
    "is_market_cap_try", "is_market_cap_usd", "is_free_float_market_cap_try", "is_free_float_market_cap_usd",
]
#: Columns of the quotes: prices and volume are null where they are missing, actions zero (fixed values).
QUOTES = {"Open": "yf_provider_open", "High": "yf_provider_high", "Low": "yf_provider_low", "Close": "yf_provider_close", "Adj Close": "yf_provider_adjusted_close", "Volume": "yf_share_volume"}
ACTIONS = {"Dividends": "yf_dividends", "Stock Splits": "yf_stock_splits", "Capital Gains": "yf_capital_gains"}
NUMBERS = ("double", "float", "int", "bigint", "smallint", "tinyint")


def _named(raw: DataFrame, names: dict[str, str], missing: Column) -> list[Column]:
    return [(F.col(f"`{a}`") if a in raw.columns else missing).cast("double").alias(b) for a, b in names.items()]


def _others(raw: DataFrame, known: set[str], any_type: bool) -> Column:
    """Sum of the absolute values of the columns that nobody knows; what is no number counts as zero."""
    unknown = [c for c, t in raw.dtypes if c not in known and (any_type or t in NUMBERS or t.startswith("decimal"))]
    values = [F.col(f"`{c}`").try_cast("double") for c in unknown]
    total = F.lit(0.0)
    for x in values:
        total = total + F.abs(F.coalesce(F.when(~F.isnan(x), x), F.lit(0.0)))
    return total.alias("yf_other_action_value")


def prepare_raw(raw: DataFrame, ticker: str, index: str = "Date") -> DataFrame:
    """A provider's rows as they are behind their identity: ticker and the local calendar date of the index column."""
    ticker = ticker.strip().upper()
    if not ticker:
        raise ValueError("ticker is required")
    return raw.select(F.lit(ticker).alias("ticker"), F.to_date(F.col(f"`{index}`")).alias("date"), *[F.col(f"`{c}`") for c in raw.columns if c != index])


def equity_history(raw: DataFrame, order: list[str]) -> DataFrame:
    """EQUITY_COLUMNS by ticker and date, the last row of a day by ``order`` (columns of raw); no price is computed with.

    raw: ticker and EQUITY_REQUIRED at least. Columns that it lacks are null.
    """
    if missing := sorted({"ticker", *EQUITY_REQUIRED} - set(raw.columns)):
        raise ValueError(f"columns are missing: {missing}")
    last = keep_last(raw.withColumns({"ticker": normalize_ticker(F.col("ticker")), "HGDG_TARIH": F.to_date("HGDG_TARIH")}), ["ticker", "HGDG_TARIH"], order)
    values = {k: v for k, v in EQUITY.items() if v != "date"}
    return last.select("ticker", F.col("HGDG_TARIH").alias("date"), *_named(last, values, F.lit(None))).select(*EQUITY_COLUMNS)


def quotes(raw: DataFrame) -> DataFrame:
    """The provider's prices, volume and actions by ticker and date, unknown numeric columns added up in
    yf_other_action_value, and nominal prices by the splits that come later.

    raw: ticker, date and columns of the provider.
    """
    known = {"ticker", "date", *QUOTES, *ACTIONS}
    rows = raw.select(normalize_ticker(F.col("ticker")).alias("ticker"), F.to_date("date").alias("date"), *_named(raw, QUOTES, F.lit(None)), *_named(raw, ACTIONS, F.lit(0.0)), _others(raw, known, any_type=False))
    prices = {p: F.col(f"yf_provider_{p}") for p in ("open", "high", "low", "close")}
    return restore_nominal(rows.withColumns(prices), split="yf_stock_splits").drop(*prices)


def auxiliary(raw: DataFrame, order: list[str]) -> DataFrame:
    """Volume and actions alone, the last row of a day by ``order``: prices are left out, so that nothing reads them past the
    verified nominal ones. Unknown columns of any type count as numbers where they are ones."""
    if "date" not in raw.columns:
        raise ValueError("date is missing")
    last = keep_last(raw.withColumns({"ticker": normalize_ticker(F.col("ticker")), "date": F.to_date("date")}), ["ticker", "date"], order)
    known = {"ticker", "date", *QUOTES, *ACTIONS, *order}
    return last.select("ticker", "date", *_named(last, {"Volume": "yf_share_volume"}, F.lit(None)), *_named(last, ACTIONS, F.lit(0.0)), _others(last, known, any_type=True))
