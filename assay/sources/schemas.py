"""Schemas of the nested documents and of the tables that may be absent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.scalars import nan_to_null

SIGNAL = (
    "ticker string, signal string, rating string, score double, conviction string, sector string, "
    "quant_score double, qual_score double, "
    "sub_scores struct<quant: double, qual: double, technical: double, news: double, research: double>, "
    "price_target_upside double, sector_rating string, short_interest_adj double, institutional_boost double"
)
TRADES = (
    "trade_id long, entry_trade_id long, date date, signal_trading_day date, ticker string, action string, shares int, "
    "fill_price double, price_at_order double, signal_price double, trigger_price double, trigger_type string, "
    "exit_reason string, exit_type string, fill_time string, realized_return_pct double, realized_alpha_pct double, "
    "spy_return_during_hold double, slippage_vs_signal double, days_held int, position_pct double, "
    "research_score double, prediction_confidence double, predicted_direction string"
)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Columns of the schema in order; absent ones as NULL, NaN as NULL."""
    have = set(df.columns)
    out = []
    for f in T.StructType.fromDDL(ddl).fields:
        c = F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        out.append(c.alias(f.name))
    return df.select(*out)
