"""Adapters: the driver's TPC-H-style tables -> bronze-shaped frames.

The pipeline's real inputs are three delimited files (contracts, budgets,
change orders).  For tests and benchmarks the same shapes are derived from
``orders``, ``lineitem`` and ``events`` with narrow projections only (no
join, no filter, every input row kept), so the work grows with the tables.
Edge cases the raw tables lack (NULL keys, zero denominators, orphan
details, dirty text for the tolerant casts) are injected as deterministic
value rules; ``tierwise.plans.oracle`` holds the same rules in SQL.

Mapping:

* contracts <- orders: one contract per order.  Orders of every 89th
  customer get a contract id no detail row refers to (clients with
  contracts but no budgets, orphan budgets); every 97th customer has no
  client name (a NULL group); every 101st order no start date; every 50th
  order a zero value and every 103rd a NULL value.
* budgets <- lineitem: one budget line per order line, all text, with
  partial dates, padded dates, dates with junk behind them, ``'N/A'`` amounts,
  junk stamps, stamps with offsets and zones, and some lines without an id.
* change orders <- events: contract id is ``user_id`` (a few hot
  contracts), created dates shifted into the orders' years, some with an
  offset; amounts of 20 digits; some without an id.

:func:`corrected` is the delivery with texts for the missing keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.schemas import MONEY

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _txt(c: Column) -> Column:
    return c.cast("string")


def _dec2(c: Column, precision: int = 18) -> Column:
    return c.cast(f"decimal({precision},2)")


def _zpad(c: Column, width: int) -> Column:
    """``printf('%0<width>d', c)`` without a per-row formatter call: a plain
    cast and ``lpad`` for non-negative values (``lpad`` would cut longer
    values, so those pass through), the formatter only for negatives."""
    s = c.cast("string")
    return (F.when(c < 0, F.format_string(f"%0{width}d", c))
            .when(F.length(s) >= width, s)
            .otherwise(F.lpad(s, width, "0")))


def _ymd(d: Column) -> Column:
    """DATE -> 'yyyy-MM-dd' (a plain cast: no session time zone involved)."""
    return d.cast("string")


def _ts_text(ts: Column, sep: str = " ") -> Column:
    """TIMESTAMP_NTZ -> 'yyyy-MM-dd HH:mm:ss' without the session time zone."""
    t = ts.cast("string")
    return F.concat(F.substring(t, 1, 10), F.lit(sep), F.substring(t, 12, 8))


def bronze_contracts(orders: DataFrame) -> DataFrame:
    """Typed bronze contracts (the load schema types DATE / NUMERIC)."""
    o = F.col("o_orderkey")
    cust = F.col("o_custkey")
    start = F.to_date("o_orderdate")
    priority_digit = F.substring("o_orderpriority", 1, 1).cast("int")
    status = (F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW"), "cancelled")
              .when(F.col("o_orderstatus") == "O", "active")
              .when(F.col("o_orderstatus") == "F", "completed")
              .when(F.col("o_orderstatus") == "P", "pending"))
    return orders.select(
        F.when(cust % 89 == 0, F.concat(F.lit("X"), _txt(o))).otherwise(_txt(o)).alias("contract_id"),
        F.concat(F.lit("Order-"), _txt(o)).alias("contract_name"),
        F.when(cust % 97 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Customer#"), _zpad(cust, 9))).alias("client_name"),
        F.when(o % 101 == 0, F.lit(None).cast("date")).otherwise(start).alias("start_date"),
        F.date_add(start, priority_digit * 30).alias("end_date"),
        F.when(o % 103 == 0, F.lit(None).cast(MONEY))
         .when(o % 50 == 0, F.lit(0).cast(MONEY))
         .otherwise(_dec2(F.col("o_totalprice")).cast(MONEY)).alias("contract_value"),
        status.alias("contract_status"),
    )


#: How updatedAt goes on after the date (offsets, zones, junk).
STAMP_TAILS = ("T17:45:00+05:00", "T17:45+05:00", " 17:45+05", " 17:45:00-8", "T17:45:00Z",
               " 17:45:00 Europe/Paris", " 17:45:00 America/New_York", " 17:45:00 or so", "Tsoon",
               "T17:45:00.250") + 21 * ("T17:45:00",)


def _variant(k: Column, texts: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, texts)), (k + 1).cast("int"))


def bronze_budgets(lineitem: DataFrame) -> DataFrame:
    """All-text bronze budgets, as a delimited file would deliver them."""
    o = F.col("l_orderkey")
    ln = F.col("l_linenumber")
    sd = F.to_date("l_shipdate")
    planned_start = F.date_add(sd, -14)
    price = _dec2(F.col("l_extendedprice"))
    cost = F.round(price * (F.lit(1) - _dec2(F.col("l_discount"), 4))
                   * (F.lit(1) + _dec2(F.col("l_tax"), 4)), 2).cast("decimal(18,2)")
    return lineitem.select(
        F.when(~((o % 211 == 0) & (ln == 1)), F.concat(_txt(o), F.lit("-"), _txt(ln))).alias("id"),
        _txt(o).alias("contractId"),
        F.concat(F.lit("Budget-"), _txt(ln)).alias("name"),
        F.concat(F.lit("BUD"), _zpad(ln, 3)).alias("code"),
        F.when(F.col("l_returnflag") == "R", "variation")
         .when(F.col("l_returnflag") == "A", "provisional")
         .otherwise("budgetAndCost").alias("scope"),
        F.when(o % 13 == 0, F.substring(_ymd(planned_start), 1, 4))
         .when(o % 29 == 0, F.concat(_ymd(planned_start), F.lit(" or so")))
         .when(o % 17 == 0, F.concat(F.lit(" "), _ymd(planned_start), F.lit(" ")))
         .otherwise(_ymd(planned_start)).alias("plannedStartDate"),
        _ymd(F.date_add(sd, 30)).alias("plannedEndDate"),
        _ymd(F.date_add(sd, ln - 3)).alias("actualStartDate"),
        F.when(F.col("l_linestatus") == "O", F.lit(None).cast("string"))
         .otherwise(_ymd(F.date_add(sd, F.col("l_quantity").cast("int")))).alias("actualEndDate"),
        F.when(o % 19 == 0, F.lit("N/A")).otherwise(_txt(price)).alias("originalAmount"),
        _txt(cost).alias("actualCost"),
        F.when(o % 23 == 0, F.lit("unknown"))
         .otherwise(F.concat(F.lit(" "), _ymd(F.date_add(sd, -30)), F.lit(" 08:30:00 "))).alias("createdAt"),
        F.concat(_ymd(F.date_add(sd, 1)), _variant(o % len(STAMP_TAILS), STAMP_TAILS)).alias("updatedAt"),
    )


def bronze_change_orders(events: DataFrame) -> DataFrame:
    """All-text bronze change orders."""
    e = F.col("event_id")
    etype = F.col("event_type")
    amount = _txt(_dec2(F.col("value")))
    created_day = F.date_add(F.to_date("ts"), (-(F.lit(8200) + e % 2200)).cast("int"))
    return events.select(
        F.when(e % 199 != 0, F.concat(F.lit("CO"), _zpad(e, 8))).alias("id"),
        _zpad(e, 8).alias("number"),
        F.concat(F.lit("Change Order "), _txt(e)).alias("name"),
        F.when(e % 2 == 0, "in").otherwise("out").alias("scope"),
        etype.alias("type"),
        _txt(F.col("user_id")).alias("contractId"),
        amount.alias("estimated"),
        F.when(e % 7 == 0, F.concat(F.lit(" "), amount, F.lit(" "))).otherwise(amount).alias("proposed"),
        F.when(e % 11 == 0, F.concat(F.lit("$"), amount)).otherwise(amount).alias("submitted"),
        F.when(etype.isin("error", "view"), F.lit(None).cast("string")).otherwise(amount).alias("approved"),
        F.when((etype == "purchase") & (e % 41 == 0), F.lit("12345678901234567890.123456789"))
         .when(etype == "purchase", amount).alias("committed"),
        F.concat(_ymd(created_day), F.lit(" "), F.substring(_ts_text(F.col("ts")), 12, 8),
                 F.when(e % 37 == 0, "+09:30").otherwise("")).alias("createdAt"),
        _ts_text(F.col("ts")).alias("updatedAt"),
        F.when(e % 9 == 0, F.lit("pending"))
         .otherwise(F.concat(F.lit(" "), _ts_text(F.col("ts"), "T"))).alias("statusChangedAt"),
    )


def corrected(contracts: DataFrame, budgets: DataFrame, change_orders: DataFrame) -> tuple[DataFrame, ...]:
    """The three bronze frames with a text wherever a client or an id is
    missing, as a second, corrected delivery brings them."""
    line = F.concat(F.lit("none-"), "contractId", F.lit("-"), F.regexp_extract("name", r"\d+$", 0))
    number = F.concat(F.lit("none-"), F.col("number").cast("long").cast("string"))
    return (contracts.withColumn("client_name", F.coalesce("client_name", F.lit("(none)"))),
            budgets.withColumn("id", F.coalesce("id", line)),
            change_orders.withColumn("id", F.coalesce("id", number)))


def blank_ids(contracts: DataFrame) -> DataFrame:
    """A delivery in which some contracts lack their (REQUIRED) id."""
    number = F.regexp_extract("contract_name", r"\d+$", 0).cast("long")
    return contracts.withColumn("contract_id", F.when(number % 251 != 0, F.col("contract_id")))


def change_order_load_stamps(events: DataFrame) -> DataFrame:
    """Change orders stamped with their load time (``events.ts``).

    Monitoring needs stamps spread over days; the silver run stamps every
    row with the same instant, so the monitoring tests read this frame.
    """
    return events.select(
        F.concat(F.lit("CO"), _zpad(F.col("event_id"), 8)).alias("change_order_id"),
        _txt(F.col("user_id")).alias("contract_id"),
        F.col("ts").alias("processed_at"),
    )


class Bronze:
    """Lazily derived bronze frames for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def contracts(self) -> DataFrame:
        return bronze_contracts(self.raw("orders"))

    def budgets(self) -> DataFrame:
        return bronze_budgets(self.raw("lineitem"))

    def change_orders(self) -> DataFrame:
        return bronze_change_orders(self.raw("events"))
