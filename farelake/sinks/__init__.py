"""Writers of every layer."""

from farelake.sinks.files import exists, remove
from farelake.sinks.parquet import (
    append_months,
    cleared,
    month_leaf,
    side_by_side,
    spread_by_month,
    staged,
    write_month,
    write_months,
)
from farelake.sinks.warehouse import FileWarehouse, JdbcWarehouse, Warehouse, register_views

__all__ = [
    "FileWarehouse",
    "JdbcWarehouse",
    "Warehouse",
    "append_months",
    "cleared",
    "exists",
    "month_leaf",
    "register_views",
    "remove",
    "side_by_side",
    "spread_by_month",
    "staged",
    "write_month",
    "write_months",
]
