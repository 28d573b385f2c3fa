"""The dashboard flow as lazy Spark plans: normalise, apply the global filters once, and derive
every view from the filtered orders (one plan per view, all reading the same input)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from delivery_lake.operators import cleaning, kpis
from delivery_lake.schemas import ALERT_MIN_ORDERS, TOPN_MIN_ORDERS, TOPN_ROWS


def filtered_orders(orders: DataFrame, start=None, end=None, states=None, categories=None) -> DataFrame:
    """Dashboard input (Gold wide table, from parquet, CSV or a database), normalised and
    filtered by purchase date range (inclusive), customer states and main categories."""
    df = cleaning.normalize_orders(orders)
    if start is not None and end is not None:
        df = kpis.filter_dates(df, start, end)
    return kpis.filter_categories(kpis.filter_states(df, states), categories)


def dashboard_views(orders: DataFrame, start=None, end=None, states=None, categories=None,
                    dimension: str = "customer_state", sort_col: str = "late_rate", n: int = TOPN_ROWS,
                    min_orders: int = TOPN_MIN_ORDERS, alert_min_orders: int = ALERT_MIN_ORDERS,
                    require_data: bool = False) -> dict[str, DataFrame]:
    """All views of the dashboard: executive KPIs, monthly orders, lateness impact, the ranked
    segment analysis (raw and as a report table) and the alerts. With ``require_data`` an empty
    filter result raises (one ``limit(1)`` job), as the dashboard reports it as an error."""
    df = filtered_orders(orders, start, end, states, categories)
    if require_data:
        kpis.require_rows(df)
    ranked = kpis.top_segments(kpis.segment_analysis(df, dimension), sort_col, n, min_orders)
    return {
        "executive": kpis.executive_kpis(df),
        "monthly": kpis.monthly_orders(df),
        "impact": kpis.lateness_impact(df),
        "analysis": ranked,
        "report": kpis.report_table(ranked),
        "alerts": kpis.alerts(df, alert_min_orders),
        "date_bounds": kpis.date_bounds(df),
    }
