"""Network, demand, plan and cutting tables derived from the star schema.

Observed supplier-to-customer trade stands in for a supply network: a
supplier is a warehouse site, a customer a store, an order year a demand
scenario. A customer order is a cutting pattern and a brand an item.

Every table is a lazy DataFrame over the parquet files; nothing is read
until an action runs. Joins carry no broadcast hints: AQE turns a join
into a broadcast at run time when the measured side is small, and keeps a
shuffle join (with skew splitting) otherwise.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.schemas import OPEN_WAREHOUSES, SHIPMENTS
from netloom.session import materialize


def _year_id(c: str):
    return F.year(F.col(c)).cast("string")


class Star:
    """Derived tables over ``sf_dir`` (one parquet file per base table). With
    ``scenario`` (a year), trade is that of its orders alone. With ``store_routes``
    the routes are written once, for queries that use them several times."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize_lanes: bool = True, scenario: str | None = None,
                 store_routes: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.materialize_lanes = materialize_lanes
        self.scenario = scenario
        self.store_routes = store_routes
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # ---- network -----------------------------------------------------------

    @cached_property
    def lanes(self) -> DataFrame:
        """One row per line item: location, store, scenario_id, amount, freight."""
        li = self.table("lineitem").select(
            "l_orderkey", "l_suppkey", F.col("l_quantity").alias("amount"), (F.col("l_extendedprice") * F.col("l_tax")).alias("freight")
        )
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if self.scenario is not None:  # a range of dates reaches the scan, a year of them does not
            from_, to = (F.lit(f"{int(self.scenario) + i:04d}-01-01").cast(o.schema["o_orderdate"].dataType) for i in (0, 1))
            o = o.where((F.col("o_orderdate") >= from_) & (F.col("o_orderdate") < to))
        s = self.table("supplier").select("s_suppkey", "s_name")
        c = self.table("customer").select("c_custkey", "c_name")
        # orders get their customer's name before line items meet them, so line items move once less
        o = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_orderkey", F.col("c_name").alias("store"), _year_id("o_orderdate").alias("scenario_id")
        )
        return (
            li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(F.col("s_name").alias("location"), "store", "scenario_id", "amount", "freight")
        )

    @cached_property
    def lane_facts(self) -> DataFrame:
        """Lanes per (location, store, scenario): shipped amount and cheapest freight.

        Routes, demands and shipments are all aggregates of this table. It is
        written once to the checkpoint folder (when ``materialize_lanes``),
        partitioned by scenario, so a query that uses several of them runs
        the line-item join once and a one-scenario slice reads one folder."""
        facts = self.lanes.groupBy("location", "store", "scenario_id").agg(
            F.sum("amount").alias("amount"), F.min("freight").alias("freight")
        )
        if not self.materialize_lanes:
            return facts
        # partitioned by scenario: a one-scenario query reads one folder
        return materialize(facts, "lane_facts", partition_by=["scenario_id"])

    @cached_property
    def warehouses(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.table("supplier").select(
            F.col("s_name").alias("location"),
            (F.lit(1000) + k * 37 % 500).cast("double").alias("fixed_cost"),
            (F.lit(10) + k % 50).cast("double").alias("capacity_cost"),
        )

    @cached_property
    def stores(self) -> DataFrame:
        return self.table("customer").select(F.col("c_name").alias("store"))

    @cached_property
    def routes(self) -> DataFrame:
        # lanes that are not kept are grouped once
        facts = self.lane_facts if self.materialize_lanes else self.lanes
        routes = facts.groupBy("location", "store").agg(F.min("freight").alias("shipping_cost"))
        return materialize(routes.sortWithinPartitions("location", "store"), "routes", compact=True) if self.store_routes else routes

    @cached_property
    def demands(self) -> DataFrame:
        return self.lane_facts.groupBy("store", "scenario_id").agg(F.sum("amount").alias("amount"))

    @cached_property
    def scenarios(self) -> DataFrame:
        totals = self.demands.groupBy(F.col("scenario_id").alias("id")).agg(F.sum("amount").alias("total_demand"))
        o = self.table("orders")
        periods = o.groupBy(_year_id("o_orderdate").alias("id")).agg(
            F.count_distinct(F.month("o_orderdate")).cast("double").alias("periods")
        )
        # written, so that joins see how small it is
        return materialize(totals.join(periods, "id").select("id", "total_demand", "periods"), "scenarios")

    @cached_property
    def map_coordinates(self) -> DataFrame:
        def coords(key: str, name: str) -> list:
            k = F.col(key)
            return [
                F.col(name).alias("location"),
                ((k * 37 % 500).cast("double") / 10 - 120).alias("lon"),
                ((k * 17 % 240).cast("double") / 10 + 25).alias("lat"),
            ]

        return self.table("supplier").select(*coords("s_suppkey", "s_name")).unionByName(
            self.table("customer").select(*coords("c_custkey", "c_name"))
        )

    # ---- plans (stand-ins for solver output) -------------------------------

    @cached_property
    def shipments(self) -> DataFrame:
        return self.lane_facts.select(
            "location", "store", "scenario_id", F.lit(0).alias("iteration"), "amount"
        ).select(*SHIPMENTS.fieldNames())

    @cached_property
    def loads(self) -> DataFrame:
        return self.shipments.groupBy("location", "scenario_id").agg(F.sum("amount").alias("load"))

    @cached_property
    def open_warehouses(self) -> DataFrame:
        """Two-stage plan (scenario 'All'): one supplier in four is closed,
        a few open ones have zero capacity."""
        cap = self.loads.groupBy("location").agg(F.max("load").alias("cap"))
        k = F.col("s_suppkey")
        closed = k % 4 == 0
        return (
            self.table("supplier")
            .join(cap, F.col("s_name") == F.col("location"))
            .select(
                F.col("s_name").alias("location"),
                F.lit("All").alias("scenario_id"),
                F.lit(0).alias("iteration"),
                F.when(closed, 0).otherwise(1).alias("open"),
                F.when(closed | (k % 25 == 1), F.lit(0.0)).otherwise(F.col("cap")).alias("capacity"),
            )
            .select(*OPEN_WAREHOUSES.fieldNames())
        )

    @cached_property
    def scenario_open(self) -> DataFrame:
        """Per-scenario plans: a site is open in a scenario when its load
        there is above 1800."""
        big = F.col("load") > 1800
        return self.loads.select(
            "location",
            "scenario_id",
            F.lit(0).alias("iteration"),
            F.when(big, 1).otherwise(0).alias("open"),
            F.when(big, F.col("load")).otherwise(F.lit(0.0)).alias("capacity"),
        )

    @cached_property
    def objectives(self) -> DataFrame:
        """Per-scenario objective values of the per-scenario plans."""
        capital = (
            self.scenario_open.join(self.warehouses, "location")
            .groupBy("scenario_id")
            .agg(F.sum(F.col("fixed_cost") * F.col("open") + F.col("capacity_cost") * F.col("capacity")).alias("value"))
            .select(F.lit("capital_cost").alias("d_expr"), "scenario_id", "value")
        )
        operating = (
            self.shipments.join(self.routes, ["location", "store"])
            .groupBy("scenario_id")
            .agg(F.sum(F.col("amount") * F.floor("shipping_cost").cast("double")).alias("value"))
            .select(F.lit("operating_cost").alias("d_expr"), "scenario_id", "value")
        )
        return capital.unionByName(operating).select(
            F.lit("warehousing").alias("problem"), "d_expr", "scenario_id", F.lit(0).alias("iteration"), "value"
        )

    @cached_property
    def candidate_sets(self) -> DataFrame:
        s = self.table("supplier")
        groups = s.select(
            F.concat(F.lit("mod"), (F.col("s_suppkey") % 4).cast("string")).alias("set_id"),
            F.col("s_name").alias("location"),
        )
        return groups.unionByName(s.select(F.lit("all").alias("set_id"), F.col("s_name").alias("location")))

    # ---- cutting stock -----------------------------------------------------

    @cached_property
    def _brand_lines(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        p = self.table("part").select("p_partkey", "p_brand", "p_size")
        return li.join(p, F.col("l_partkey") == F.col("p_partkey"))

    @cached_property
    def cut_orders(self) -> DataFrame:
        orders = self._brand_lines.groupBy(F.col("p_brand").alias("item")).agg(
            (F.min("p_size") + 10).alias("width"), F.sum("l_quantity").cast("bigint").alias("amount")
        )
        return materialize(orders, "cut_orders")  # as for scenarios

    @cached_property
    def cut_slices(self) -> DataFrame:
        return self._brand_lines.groupBy(F.col("p_brand").alias("item"), F.col("l_orderkey").alias("pattern")).agg(
            F.sum("l_quantity").cast("bigint").alias("number")
        )

    @cached_property
    def cut_patterns(self) -> DataFrame:
        return self.cut_slices.select(F.col("pattern").alias("id")).distinct().select("id", F.lit(1).alias("cost"))

    @cached_property
    def cut_usages(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("pattern"),
            F.when(F.col("o_orderstatus") == "P", F.lit(0.0))
            .otherwise((F.col("o_orderkey") % 7 + 1).cast("double"))
            .alias("rolls"),
        )

    @cached_property
    def cut_duals(self) -> DataFrame:
        return self.cut_orders.select(
            "item", F.lit(0).alias("iteration"), (F.col("width").cast("double") / 110).alias("price")
        )
