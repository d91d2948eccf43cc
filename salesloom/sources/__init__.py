from salesloom.sources.loaders import (
    branch_plans_for,
    client_branches,
    client_cards,
    own_brand_lines,
    shipment_lines,
)
from salesloom.sources.tables import SCHEMAS, Sources, read_plan_month, read_table, write_result

__all__ = [
    "SCHEMAS",
    "Sources",
    "branch_plans_for",
    "client_branches",
    "client_cards",
    "own_brand_lines",
    "read_plan_month",
    "read_table",
    "shipment_lines",
    "write_result",
]
