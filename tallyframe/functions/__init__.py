from tallyframe.functions.columns import (
    base_name,
    fold_cells,
    fold_columns,
    full_name,
    incentive,
    month_of,
    run_epoch_ms,
    run_timestamp,
    strip_store,
    to_day,
    to_money,
    to_whole_number,
)

__all__ = [
    "base_name",
    "fold_cells",
    "fold_columns",
    "full_name",
    "incentive",
    "month_of",
    "run_epoch_ms",
    "run_timestamp",
    "strip_store",
    "to_day",
    "to_money",
    "to_whole_number",
]
