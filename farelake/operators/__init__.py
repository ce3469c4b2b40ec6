"""DataFrame-to-DataFrame operators; nothing here reads, writes or runs a job."""

from farelake.operators.clean import clean_trips
from farelake.operators.conform import conform, fitted, to_table
from farelake.operators.evaluate import summarise_gold
from farelake.operators.kpis import merged_kpis, monthly_kpis, monthly_state
from farelake.operators.quality import Rule, counts, default_rules, profile, scored
from farelake.operators.serving import (
    failed_runs,
    latest_run,
    months_of_year,
    negative_kpis,
    null_kpis,
    outlier_months,
    pk_violations,
    recent_months,
    recent_runs,
    reconcile,
    row_counts,
)

__all__ = [
    "Rule",
    "clean_trips",
    "conform",
    "counts",
    "default_rules",
    "failed_runs",
    "fitted",
    "latest_run",
    "merged_kpis",
    "monthly_kpis",
    "monthly_state",
    "months_of_year",
    "negative_kpis",
    "null_kpis",
    "outlier_months",
    "pk_violations",
    "profile",
    "recent_months",
    "recent_runs",
    "reconcile",
    "row_counts",
    "scored",
    "summarise_gold",
    "to_table",
]
