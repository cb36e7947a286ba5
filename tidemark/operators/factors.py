"""The 35 factors (J-01..J-35) as column expressions over pod, risk, fundamental,
analyst and insider columns. ``try_divide`` everywhere: a zero denominator is NULL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.semantics import ratio

# Scaling constants.
ANNUALISE = math.sqrt(252.0)
AMIHUD_SCALE = 1e6
MILLIONS = 1e6  # fundamentals are in millions, market cap in dollars


def _c(x: str) -> Column:
    return F.col(x)


def rsi(gain: Column, loss: Column) -> Column:
    """J-27: 100 - 100/(1 + gain/loss); loss 0 with gain > 0 is 100; both 0 NULL."""
    return (F.when(loss > 0, 100 - F.try_divide(F.lit(100.0), 1 + F.try_divide(gain, loss)))
            .when((loss == 0) & (gain > 0), F.lit(100.0)))


def positive_equity(x: Column) -> Column:
    return F.when(_c("book_equity") > 0, x)


def price_factor_columns() -> dict[str, Column]:
    return {
        "ret_12m_skip1m": ratio(_c("P_21") - _c("P_252"), "P_252"),
        "ret_1m": ratio(_c("close") - _c("P_21"), "P_21"),
        "mom_12m_minus_6m": ratio("close", "P_252") - ratio("close", "P_126"),
        "price_vs_200d_ma": ratio("close", "SMA_200") - 1,
        "ma_50_vs_200": ratio("SMA_50", "SMA_200") - 1,
        "vol_20d": _c("std_r_20") * ANNUALISE,
        "downside_vol_20d": _c("std_r_down_20") * ANNUALISE,
        "vol_ratio_20_60": ratio("std_r_20", "std_r_60"),
        "amihud_illiquidity": _c("amihud_20") * AMIHUD_SCALE,
        "avg_dollar_volume_20d": _c("dv_20"),
        "bid_ask_spread_proxy": ratio(2 * _c("hl"), _c("high") + _c("low")),
        "RSI_14": rsi(_c("avg_gain_14"), _c("avg_loss_14")),
        "MACD_histogram": _c("MACD_hist"),
        "bollinger_bandwidth": _c("BB_width"),
        "distance_52w_high": ratio("close", "high_252") - 1,
    }


# log_market_cap (J-16) is the pod column itself.
RISK_FACTORS = ["beta_1y", "max_drawdown_60d", "VaR_95", "idiosyncratic_vol"]


def fundamental_factor_columns() -> dict[str, Column]:
    return {
        "book_to_market": ratio(_c("book_equity") * MILLIONS, "market_cap"),
        "earnings_yield": ratio("EPS_ttm", "close"),
        "ebitda_to_ev": ratio(_c("EBITDA_ttm") * MILLIONS, _c("market_cap") + _c("net_debt") * MILLIONS),
        "free_cashflow_yield": ratio((_c("operating_cashflow") - _c("capex")) * MILLIONS, "market_cap"),
        "gross_profitability": ratio(_c("revenue_ttm") - _c("COGS_ttm"), "total_assets"),
        "ROE": positive_equity(ratio("net_income_ttm", "book_equity")),
        "sloan_accruals": ratio(_c("net_income_ttm") - _c("operating_cashflow") - _c("CFI_ttm"), "total_assets"),
        "debt_to_equity": positive_equity(ratio("total_debt", "book_equity")),
        "revenue_growth": ratio("revenue_q", "revenue_q_4ago") - 1,
        "earnings_growth": ratio(_c("EPS_q") - _c("EPS_q_4ago"), F.abs("EPS_q_4ago")),
    }


EVENT_FACTORS = ["earnings_surprise", "earnings_revision_30d", "analyst_dispersion", "insider_buy_sell_ratio"]

PRICE_FACTORS = ["ret_12m_skip1m", "ret_1m", "mom_12m_minus_6m", "price_vs_200d_ma", "ma_50_vs_200", "vol_20d",
                 "downside_vol_20d", "vol_ratio_20_60", "amihud_illiquidity", "avg_dollar_volume_20d",
                 "bid_ask_spread_proxy", "RSI_14", "MACD_histogram", "bollinger_bandwidth", "distance_52w_high"]
FUNDAMENTAL_FACTORS = ["book_to_market", "earnings_yield", "ebitda_to_ev", "free_cashflow_yield", "gross_profitability",
                       "ROE", "sloan_accruals", "debt_to_equity", "revenue_growth", "earnings_growth"]
FACTOR_NAMES = (PRICE_FACTORS[:8] + ["beta_1y", "max_drawdown_60d", "VaR_95", "idiosyncratic_vol"]
                + PRICE_FACTORS[8:11] + ["log_market_cap"] + FUNDAMENTAL_FACTORS
                + PRICE_FACTORS[11:] + EVENT_FACTORS)


def price_factors(pod: DataFrame) -> DataFrame:
    return pod.withColumns(price_factor_columns())


def fundamental_factors(df: DataFrame) -> DataFrame:
    return df.withColumns(fundamental_factor_columns())
