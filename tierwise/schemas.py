"""Schemas of the bronze, silver and gold tables.

``MONEY`` is decimal(38,9), the width of a warehouse NUMERIC: 29 integer
digits and nine places.  Spark's ``+`` and ``-`` of two such amounts would drop
to eight places; ``functions.metrics.money_plus`` / ``money_minus`` do not.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(38, 9)

S = T.StringType()

# The table and column names of the bronze load schemas and the
# silver models (they are the data contract and must stay as they are).

BRONZE_CONTRACTS = T.StructType([
    T.StructField("contract_id", S, False),   # REQUIRED in the load schema
    T.StructField("contract_name", S),
    T.StructField("client_name", S),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("contract_value", MONEY),
    T.StructField("contract_status", S),
])

BRONZE_CONTRACTS_REQUIRED = ("contract_id",)

BRONZE_BUDGETS = T.StructType([T.StructField(c, S) for c in (
    "id", "contractId", "name", "code", "scope", "plannedStartDate",
    "plannedEndDate", "actualStartDate", "actualEndDate", "originalAmount",
    "actualCost", "createdAt", "updatedAt",
)])

BRONZE_CHANGE_ORDERS = T.StructType([T.StructField(c, S) for c in (
    "id", "number", "name", "scope", "type", "contractId", "estimated",
    "proposed", "submitted", "approved", "committed", "createdAt",
    "updatedAt", "statusChangedAt",
)])

CONTRACTS_SILVER_COLUMNS = [
    "contract_id", "contract_name", "client_name", "start_date", "end_date",
    "contract_value", "contract_status", "processed_at",
]

BUDGETS_SILVER_COLUMNS = [
    "budget_id", "budget_name", "contract_id", "budget_code", "budget_scope",
    "planned_start_date", "planned_end_date", "actual_start_date",
    "actual_end_date", "original_amount", "actual_cost", "created_at",
    "updated_at", "processed_at",
]

CHANGE_ORDERS_SILVER_COLUMNS = [
    "change_order_id", "change_order_number", "change_order_name",
    "change_order_scope", "change_order_type", "contract_id",
    "estimated_amount", "proposed_amount", "submitted_amount",
    "approved_amount", "committed_amount", "created_at", "updated_at",
    "status_changed_at", "processed_at",
]

# The contract status vocabulary the gold models count.
CONTRACT_STATUSES = ("active", "completed", "pending", "cancelled")
