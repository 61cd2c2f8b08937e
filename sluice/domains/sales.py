"""Sales: one clean table and its revenue view."""

from __future__ import annotations

from sluice.sinks.tables import OutputSpec

# The clean sales table.
CLEAN_SALES = OutputSpec(
    "clean_sales",
    """order_id string, customer_id string, product_name string, quantity int,
    unit_price double, total_amount double, order_date date""",
    ("order_date",),
)
REVENUE_VIEW = "sales_revenue_by_order_date"
