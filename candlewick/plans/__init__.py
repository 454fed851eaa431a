from .contracts import CONTRACTS, SILVER_CONTRACTS
from .gold import (
    Gold,
    build_dim_date,
    build_dim_source,
    build_dim_stock,
    build_fact,
    build_gold,
    build_staging,
    check_gold,
)
from .load import Landing, Load, bronze_to_silver, land_payloads
from .mart import (
    anomaly_count,
    gold_mart,
    kpis,
    newest_first,
    price_trend,
    select_rows,
    volatility_spread,
    volume_share,
)

__all__ = [
    "CONTRACTS",
    "SILVER_CONTRACTS",
    "Gold",
    "Landing",
    "Load",
    "anomaly_count",
    "bronze_to_silver",
    "build_dim_date",
    "build_dim_source",
    "build_dim_stock",
    "build_fact",
    "build_gold",
    "build_staging",
    "check_gold",
    "gold_mart",
    "kpis",
    "land_payloads",
    "newest_first",
    "price_trend",
    "select_rows",
    "volatility_spread",
    "volume_share",
]
