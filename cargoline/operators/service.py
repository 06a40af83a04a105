"""Order grain: rollup of lines, join to shipments, service flags and costs.

Two null policies are kept apart, as in the reference's two paths:

* ``order_service``       (dataframe policy): an order without a shipment is
  late, not OTIF and costs 0; missing-group sums are 0; NULL order ids drop;
  duplicate shipments raise.
* ``mart_order_service``  (SQL mart policy): the same order keeps NULL
  on_time / cost, ``in_full AND NULL`` three-valued OTIF, NULL order id kept
  as a group, a duplicate shipment fans out.

A string header value makes the rollup a sort aggregate; over the adapter's lines it
rides on the order that the sort-merge join on the order key leaves, without a sort of
its own (a hash aggregate over ``collect_set`` falls back to sorting after 128 orders a
task and is slower).

Scale: the rollup groups on ``order_id`` and the shipment side is grouped (or
shuffled) on the same key, so the left join is a sort-merge join that reuses
the aggregate's hash partitioning (one exchange per side).  Header values use
``min``/``max`` -- deterministic, unlike ``first``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.functions.columns import MONEY, TOTAL_MONEY, as_double, money, ratio

SHIPMENT_COLUMNS = (
    "order_id", "carrier", "delivery_date", "freight_cost", "handling_cost", "exception_cost", "shipment_weight_kg",
)


def order_rollup(lines: DataFrame, policy: str = "mart") -> DataFrame:
    """O1: one row per order with header values and summed units/revenue."""
    if policy not in ("mart", "frame"):
        raise ValueError(f"unknown policy {policy!r}")
    src = lines if policy == "mart" else lines.filter(F.col("order_id").isNotNull())

    def total(c: str, dtype: T.DataType) -> F.Column:
        s = F.sum(c).cast(dtype)
        return s if policy == "mart" else F.coalesce(s, F.lit(0).cast(dtype))

    return src.groupBy("order_id").agg(
        F.min("customer_id").alias("customer_id"),
        F.min("warehouse").alias("warehouse"),
        F.min(F.col("order_date").cast(T.DateType())).alias("order_date"),
        F.max(F.col("promised_date").cast(T.DateType())).alias("promised_date"),
        total("units_ordered", T.LongType()).alias("units_ordered"),
        total("units_shipped", T.LongType()).alias("units_shipped"),
        total("revenue", TOTAL_MONEY).alias("revenue"),
    )


def _unique_shipments(shipments: DataFrame) -> DataFrame:
    """Shipments grouped by order_id with a one-to-one guard.

    The grouping shuffles on order_id -- the join key -- so the guard costs no
    extra exchange in the join that follows.
    """
    cols = [c for c in SHIPMENT_COLUMNS if c != "order_id"]
    grouped = shipments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_shipments"),
        *[F.min(c).alias(c) for c in cols]
    )
    guard = F.when(
        F.col("_shipments") > 1,
        F.raise_error(F.concat(F.lit("one-to-one join violated: order "), F.col("order_id").cast("string"),
                               F.lit(" has several shipments"))),
    )
    return grouped.filter(guard.isNull()).drop("_shipments")


def frame_rollup(mart_rollup: DataFrame) -> DataFrame:
    """The dataframe-policy rollup derived from the SQL-policy one: drop the
    NULL order id group, missing sums become 0.  Lets both marts share one
    aggregation of the order lines."""
    zero = {"units_ordered": T.LongType(), "units_shipped": T.LongType(), "revenue": TOTAL_MONEY}
    return mart_rollup.filter(F.col("order_id").isNotNull()).select(*[
        F.coalesce(F.col(c), F.lit(0).cast(zero[c])).alias(c) if c in zero else F.col(c) for c in mart_rollup.columns
    ])


def order_service(lines: DataFrame, shipments: DataFrame, validate: bool = True,
                  rollup: DataFrame | None = None) -> DataFrame:
    """O2: order service detail under the dataframe policy.

    ``rollup`` may pass the SQL-policy rollup (``order_rollup(lines)``) that the
    mart also uses, so the lines are aggregated once for both.
    """
    ship = shipments.select(*SHIPMENT_COLUMNS).filter(F.col("order_id").isNotNull())
    ship = _unique_shipments(ship) if validate else ship
    roll = order_rollup(lines, "frame") if rollup is None else frame_rollup(rollup)
    joined = roll.join(ship, "order_id", "left")
    weight = F.col("shipment_weight_kg")
    return joined.select(
        "order_id", "customer_id", "warehouse", "order_date", "promised_date",
        F.col("delivery_date").cast(T.DateType()).alias("delivery_date"),
        "units_ordered", "units_shipped", "revenue",
        "freight_cost", "handling_cost", "exception_cost",
        (F.coalesce("freight_cost", F.lit(0)) + F.coalesce("handling_cost", F.lit(0))
         + F.coalesce("exception_cost", F.lit(0))).cast(MONEY).alias("cost_to_serve"),
        "shipment_weight_kg", "carrier",
        (F.col("units_shipped") >= F.col("units_ordered")).alias("in_full"),
        F.coalesce(F.col("delivery_date") <= F.col("promised_date"), F.lit(False)).alias("on_time"),
        ((F.col("units_shipped") >= F.col("units_ordered"))
         & F.coalesce(F.col("delivery_date") <= F.col("promised_date"), F.lit(False))).alias("otif"),
        F.datediff("delivery_date", "order_date").cast(T.LongType()).alias("lead_time_days"),
        F.greatest(F.col("units_ordered") - F.col("units_shipped"), F.lit(0)).cast(T.LongType()).alias("backorder_units"),
        F.when(weight > 0, as_double("freight_cost") / as_double(weight)).alias("freight_cost_per_kg"),
    )


def mart_order_service(lines: DataFrame, shipments: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """O3: order service mart under the SQL policy (no one-to-one guard)."""
    ship = shipments.select(*SHIPMENT_COLUMNS)
    roll = order_rollup(lines, "mart") if rollup is None else rollup
    # NULL order ids stay a group of their own but match no shipment, as with ``using``.
    joined = roll.join(ship, "order_id", "left")
    in_full = F.col("units_shipped") >= F.col("units_ordered")
    on_time = F.col("delivery_date").cast(T.DateType()) <= F.col("promised_date")
    return joined.select(
        "order_id", "customer_id", "warehouse", "order_date", "promised_date",
        "units_ordered", "units_shipped", "revenue", "carrier",
        F.col("delivery_date").cast(T.DateType()).alias("delivery_date"),
        "freight_cost", "handling_cost", "exception_cost", "shipment_weight_kg",
        in_full.alias("in_full"),
        on_time.alias("on_time"),
        (in_full & on_time).alias("otif"),
        F.datediff(F.col("delivery_date").cast(T.DateType()), "order_date").cast(T.LongType()).alias("lead_time_days"),
        F.greatest(F.col("units_ordered") - F.col("units_shipped"), F.lit(0)).cast(T.LongType()).alias("backorder_units"),
        (F.col("freight_cost") + F.col("handling_cost") + F.col("exception_cost")).cast(MONEY).alias("cost_to_serve"),
        ratio("freight_cost", "shipment_weight_kg").alias("freight_cost_per_kg"),
    )


def service_segments(service: DataFrame) -> DataFrame:
    """Mutually exclusive in-full x on-time segments with their share.

    The share's denominator is a window over the (at most four) grouped rows.
    """
    from pyspark.sql import Window

    counts = service.groupBy("in_full", "on_time").agg(F.count(F.lit(1)).alias("orders"))
    total = F.sum("orders").over(Window.partitionBy())
    return counts.select("in_full", "on_time", "orders", ratio(F.col("orders"), total).alias("share"))


def shipment_weight(lines: DataFrame) -> DataFrame:
    """Shipped weight per order = sum(units_shipped x unit weight), exact decimal."""
    return lines.groupBy("order_id").agg(
        F.sum(F.col("units_shipped") * F.col("unit_weight_kg")).cast(TOTAL_MONEY).alias("shipment_weight_kg")
    )


def delivery_chronology(shipments: DataFrame) -> DataFrame:
    """Delivery timeline per shipment and its consistency flags.

    ``effective_delay_days`` = delivery - promise; a shipment is late when that
    is positive; exception cost is expected only on late shipments and delivery
    may not precede the ship date.
    """
    delay = F.datediff("delivery_date", "promised_date").cast(T.LongType())
    late = delay > 0
    return shipments.select(
        "shipment_id", "order_id", "carrier", "ship_date", "promised_date", "delivery_date",
        F.datediff("delivery_date", "ship_date").cast(T.LongType()).alias("transit_days"),
        delay.alias("effective_delay_days"),
        late.alias("is_late"),
        (F.col("delivery_date") < F.col("ship_date")).alias("delivered_before_ship"),
        ((F.col("exception_cost") > 0) == late).alias("exception_cost_consistent"),
        (F.col("on_time") == ~late).alias("on_time_flag_consistent"),
        money("exception_cost").alias("exception_cost"),
    )
