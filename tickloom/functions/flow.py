"""Order-flow column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Side spellings that count as buys and as sells.
BUY_SIDES = ["B", "BUY", "BID"]
SELL_SIDES = ["S", "SELL", "ASK", "A"]


def side_sign(side: Column | str) -> Column:
    """+1 for a buy spelling, -1 for a sell spelling, else 0."""
    name = F.upper(side)
    return F.when(name.isin(BUY_SIDES), 1).when(name.isin(SELL_SIDES), -1).otherwise(0)


def vwap(notional: Column | str, size: Column | str) -> Column:
    """Null when nothing traded; the guard also keeps ANSI division from raising."""
    size = F.col(size) if isinstance(size, str) else size
    notional = F.col(notional) if isinstance(notional, str) else notional
    return F.when(size > 0, notional / size)


def ofi_ratio(buy: Column, sell: Column) -> Column:
    sided = buy + sell
    return F.when(sided > 0, (buy - sell) / sided).otherwise(F.lit(0.0))
