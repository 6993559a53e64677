"""The operators put together into whole runs."""

from barograph.plans.forecast import forecast_verdict, plan_forecast, published_runs
from barograph.plans.gridded import (
    month_to_date_requests,
    plan_requests,
    recorded_ledger,
    report_run,
    run_requests,
)
from barograph.plans.observations import clean_snapshots, tidy_payloads

__all__ = [
    "clean_snapshots",
    "forecast_verdict",
    "month_to_date_requests",
    "plan_forecast",
    "plan_requests",
    "published_runs",
    "recorded_ledger",
    "report_run",
    "run_requests",
    "tidy_payloads",
]
