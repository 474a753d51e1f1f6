"""Logical portfolio tables derived from the supplied ones.

Each method is a lazy DataFrame over whole tables; the same derivations in SQL
are in ``sql_tables``. Ids are text with fixed-width parts, money is decimal.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poolwright import GRAIN
from poolwright.functions import codes
from poolwright.functions.exprs import lookup, non_investment_flag, rating_ordinal
from poolwright.session import literal_rows, materialize
from poolwright.workload import literals as L

MONEY = "decimal(20,4)"
RATE = "decimal(9,6)"
VALUE_DATE = L.VALUE_DATE


def pad(column: Column, width: int) -> Column:
    return F.lpad(column.cast("string"), width, "0")


def letter(index: Column) -> Column:
    """Rating letter at ``index`` modulo the scale length."""
    scale = F.array(*[F.lit(x) for x in codes.RATING_SCALE])
    return F.element_at(scale, (index % len(codes.RATING_SCALE) + 1).cast("int"))


def case(pairs: dict, column: Column) -> Column:
    return lookup(pairs, column)


class Tables:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def literal(self, rows: list[tuple], schema: str) -> DataFrame:
        return literal_rows(self.spark, rows, schema)

    # --- dimensions held as literals ---

    @cached_property
    def fx(self) -> DataFrame:
        return self.literal(L.FX, "currency string, fx string").withColumn("fx", F.col("fx").cast("decimal(12,6)"))

    @cached_property
    def bands(self) -> DataFrame:
        return self.literal(L.BANDS, "band_from double, band_to double, short_letter string, long_letter string")

    @cached_property
    def relation(self) -> DataFrame:
        return self.literal(L.LIMIT_RELATION, L.LIMIT_RELATION_SCHEMA)

    # --- facilities at the fine grain: one per order line and supplier ---

    @cached_property
    def lines(self) -> DataFrame:
        return self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity",
            F.col("l_extendedprice").cast(MONEY).alias("price"),
            F.col("l_discount").cast(RATE).alias("disc"),
            F.col("l_tax").cast(RATE).alias("tax"),
            F.to_date("l_shipdate").alias("ship_date"),
        )

    @cached_property
    def facility(self) -> DataFrame:
        """Sums first, on the grain; order and customer attributes are joined afterwards."""
        # prices have two decimals and rates whole percents: cents and percents
        # as longs keep the sums exact without decimal arithmetic per line
        cents = F.round(F.col("l_extendedprice") * 100).cast("long")
        percent = {c: F.round(F.col(c) * 100).cast("long") for c in ("l_discount", "l_tax")}
        lines = self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", (F.col("l_quantity") > 45).alias("large"), F.to_date("l_shipdate").alias("ship_date"),
            cents.alias("cents"), percent["l_discount"].alias("disc"), percent["l_tax"].alias("tax"))

        def money(ticks: Column) -> Column:
            return (ticks.cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(4,4)")).cast(MONEY)

        # dealt by order for the sums and for the join with the orders; the join with the parts comes after it
        sums = lines.repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber", "l_suppkey").agg(
            F.sum("cents").alias("cents"),
            F.sum(F.col("cents") * F.col("disc")).alias("disc_ticks"),
            F.sum(F.col("cents") * F.col("tax")).alias("tax_ticks"),
            F.sum(F.when(F.col("large"), F.floor(F.col("cents") / 800)).otherwise(0)).alias("sold"),
            F.min("l_partkey").alias("p_partkey"),
            F.max("ship_date").alias("ship_date"),
        ).withColumns({
            "reg_ead": money(F.col("cents") * 100),
            "funded_eur": money(F.col("cents") * 100 - F.col("disc_ticks")),
            "available_eur": money(F.col("tax_ticks")).cast("decimal(20,2)").cast(MONEY),
            "reg_capital": money(F.col("disc_ticks")),
            "sold_amount": F.col("sold").cast(MONEY),
        })
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"), "o_orderstatus",
            F.to_date("o_orderdate").alias("signing_date"))
        customer = self.raw("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        nation = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
        part = self.raw("part").select("p_partkey", F.col("p_type").alias("sector"), F.col("p_brand").alias("subsector"))
        customer = customer.join(nation, "c_nationkey")
        j = sums.join(orders.join(customer, "c_custkey"), "l_orderkey").join(part, "p_partkey")
        rating = letter(F.col("c_custkey") + F.col("l_linenumber"))
        return j.select(
            F.col("l_orderkey").cast("string").alias("facility_id"),
            F.col("l_linenumber").cast("string").alias("tranche_id"),
            F.col("l_suppkey").cast("string").alias("branch_id"),
            F.concat(F.lit("G"), pad(F.col("c_custkey") % 40, 2)).alias("group_id"),
            F.when(F.col("c_custkey") % 23 != 0, F.col("n_name")).alias("country"),
            case(L.REGION_CURRENCY, F.col("n_regionkey")).alias("currency"),
            case(L.STATUS_PRODUCT, F.col("o_orderstatus")).alias("financial_product"),
            F.when(F.col("c_mktsegment") == "BUILDING", "Project Finance").otherwise("Corporate Facilities")
            .alias("com_product"),
            "sector", "subsector", "signing_date",
            F.when(F.col("c_custkey") % 29 != 0, F.date_add("ship_date", (365 * F.col("l_linenumber")).cast("int"))).alias("expiry_date"),
            "reg_ead", "funded_eur", "available_eur", "reg_capital", "sold_amount",
            F.try_divide(F.col("reg_capital").cast("double"), F.col("reg_ead").cast("double")).alias("reg_capital_ratio"),
            rating.alias("rating_letter"),
            F.when(F.col("c_custkey") % 5 != 0, letter(F.col("c_custkey"))).alias("group_rating"),
            non_investment_flag(rating_ordinal(rating), rating).alias("non_ig_flag"),
            F.when(F.col("l_suppkey") % 50 == 7, 1).otherwise(0).alias("bei_flag"),
            F.when(F.col("l_suppkey") % 3 == 0, 1).otherwise(0).alias("esg_linked_flag"),
        )

    # --- loans at the dense grain: many contracts and movements each ---

    def _loan_key(self) -> list[Column]:
        return [
            F.col("l_suppkey").cast("string").alias("facility_id"),
            F.col("l_linenumber").cast("string").alias("tranche_id"),
            pad(F.col("l_suppkey") % 10, 4).alias("branch_id"),
        ]

    def _entity(self) -> Column:
        return F.when(F.col("l_suppkey") % 2 == 0, "ES").otherwise("MX")

    def _contract_tail(self) -> Column:
        return F.concat(pad(F.col("l_orderkey"), 12), pad(F.col("l_linenumber"), 2), pad(F.col("l_partkey"), 12))

    def _contract(self) -> Column:
        return F.concat(self._entity(), F.lit("0000"), pad(F.col("l_suppkey") % 10, 4), self._contract_tail())

    def _customer(self, number: Column) -> Column:
        prefix = F.when(number % 2 == 0, codes.ENTITY_CUSTOMER_PREFIX["ES"]).otherwise(codes.ENTITY_CUSTOMER_PREFIX["MX"])
        return F.concat(prefix, pad(number, 9))

    def _golden(self, number: Column) -> Column:
        return F.concat(F.lit("A"), pad(number, 8))

    def _currency(self, number: Column) -> Column:
        return case(L.REGION_CURRENCY, (number % 5).cast("int"))

    @cached_property
    def operations(self) -> DataFrame:
        return self.lines.groupBy("l_suppkey", "l_linenumber").agg(
            F.max("l_returnflag").alias("flag"), F.sum("price").cast(MONEY).alias("total"),
        ).select(
            *self._loan_key(),
            F.when(F.col("l_suppkey") % 2 == 0, L.HOME).otherwise(L.ABROAD).alias("entity_id"),
            self._currency(F.col("l_suppkey")).alias("currency"),
            self._customer(F.col("l_suppkey")).alias("customer_id"),
            (F.col("l_suppkey") % 25).cast("int").alias("_country"),
            F.date_add(F.lit("1994-01-01").cast("date"), (F.col("l_suppkey") % 365).cast("int")).alias("signing_date"),
            F.date_add(F.lit("2002-01-01").cast("date"), (F.col("l_linenumber") * 100).cast("int")).alias("expiry_date"),
            pad(F.col("l_suppkey") % 25, 2).alias("project_country_id"),
            F.when(F.col("l_linenumber") == 1, "Multitranche").when(F.col("l_linenumber") < 5, "Term Loan")
            .otherwise("RCF").alias("financial_product"),
            F.when(F.col("l_suppkey") % 3 == 0, "Project Finance").otherwise("Corporate Facilities").alias("com_product"),
            F.when(F.col("l_suppkey") % 4 == 1, F.concat(F.lit(" "), F.lit(codes.PUBLIC_AGENCY_PURPOSE), F.lit(" ")))
            .otherwise("General").alias("purpose"),
            F.concat(F.lit("P"), pad(F.col("l_suppkey") % 30, 3)).alias("project_id"),
            F.concat(F.lit(" Field "), (F.col("l_suppkey") % 6).cast("string")).alias("project_sector_desc"),
            F.when(F.col("l_suppkey") % 7 == 0, "Bond").otherwise("Loan").alias("security_type"),
            F.when(F.col("l_linenumber") % 2 == 0, "Syndicated").otherwise("Bilateral").alias("syndication_type"),
            F.when(F.col("l_linenumber") % 3 == 0, "Secured").when(
                (F.col("l_linenumber") == 1) & (F.col("l_suppkey") % 2 == 0), "Insured").alias("insured_type"),
        ).drop("_country")

    @cached_property
    def balances(self) -> DataFrame:
        sums = self.lines.groupBy("l_suppkey", "l_linenumber").agg(
            F.sum(F.col("price") * (1 - F.col("disc"))).cast(MONEY).alias("funded_ccy"),
            F.sum(F.when(F.col("l_linestatus") == "O", F.col("price") * F.col("tax")).otherwise(F.lit(0)))
            .cast(MONEY).alias("available_ccy"),
            F.sum(F.when(F.col("l_returnflag") == "A", F.col("price")).otherwise(F.lit(0))).cast(MONEY).alias("commitment"),
        )
        keyed = sums.select(
            *self._loan_key(),
            F.when(F.col("l_suppkey") % 2 == 0, L.HOME).otherwise(L.ABROAD).alias("entity_id"),
            self._currency(F.col("l_suppkey")).alias("currency"),
            "funded_ccy", "available_ccy",
            F.when(F.col("l_suppkey") % 20 == 3, F.lit(0).cast(MONEY)).otherwise(F.col("commitment")).alias("commitment"))
        return keyed.join(self.fx, "currency", "left").withColumn("fx", F.coalesce("fx", F.lit(1).cast("decimal(12,6)"))).withColumns({
            "funded_eur": (F.col("funded_ccy") * F.col("fx")).cast(MONEY),
            "available_eur": (F.col("available_ccy") * F.col("fx")).cast(MONEY),
        }).drop("fx")

    @cached_property
    def branches(self) -> DataFrame:
        part = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
        return self.lines.select("l_suppkey", "l_partkey").join(part, "l_partkey").select(
            pad(F.col("l_suppkey") % 10, 4).alias("branch_id"),
            F.when(F.col("l_suppkey") % 2 == 0, L.HOME).otherwise(L.ABROAD).alias("entity_id"),
            F.col("p_type").alias("entity_product"))

    @cached_property
    def movements(self) -> DataFrame:
        pair = F.concat("l_returnflag", "l_linestatus")
        return self.lines.select(
            *self._loan_key(),
            # some are booked by the other entity and belong to no operation
            F.when((F.col("l_suppkey") + (F.col("l_partkey") % 17 == 3).cast("int")) % 2 == 0, L.HOME).otherwise(L.ABROAD).alias("entity_id"),
            self._currency(F.col("l_suppkey")).alias("currency"),
            F.date_add(F.lit("1994-01-01").cast("date"), (F.col("l_suppkey") % 365).cast("int")).alias("signing_date"),
            F.date_add(F.lit("2002-01-01").cast("date"), (F.col("l_linenumber") * 100).cast("int")).alias("expiry_date"),
            case({k: c for k, (c, _) in L.MOVEMENTS.items()}, pair).alias("movement_class"),
            case({k: t for k, (_, t) in L.MOVEMENTS.items()}, pair).alias("movement_type"),
            F.when(F.col("l_quantity") > 25, "Settled").otherwise("Pending").alias("payment_state"),
            F.col("ship_date").alias("start_date"),
            F.date_add("ship_date", F.col("l_linenumber").cast("int")).alias("end_date"),
            F.col("price").alias("movement_amount"),
            (F.col("price") * (1 - F.col("disc"))).cast(MONEY).alias("base_amount"),
        )

    @cached_property
    def relations(self) -> DataFrame:
        level = F.when(F.col("l_partkey") % 4 == 0, "CONTRACT").otherwise("FACILITY")
        # the ids are built from these numbers, so deduplicate before building them
        keys = self.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct()
        return keys.select(self._contract().alias("contract_id"), *self._loan_key(), level.alias("relation_level"))

    def _capital_lines(self) -> DataFrame:
        """A slice of the lines on purpose: rows without a partner are what the outer joins are for."""
        return self.lines.filter(F.col("l_returnflag") != "N")

    @cached_property
    def econ_capital(self) -> DataFrame:
        missing = F.lit(codes.MISSING_AMOUNT).cast(MONEY)
        return self._capital_lines().select(
            self._contract().alias("contract_id"), self._entity().alias("entity_id"),
            F.when(F.col("l_quantity") == 50, missing).otherwise(F.col("price")).alias("econ_ead"),
            (F.col("price") * F.col("disc") * F.col("tax")).cast(MONEY).alias("econ_loss"),
            (F.col("price") * F.col("tax")).cast(MONEY).alias("econ_capital"),
            F.when(F.col("l_quantity") == 49, F.lit(codes.MISSING_PERCENT).cast(RATE)).otherwise(F.col("disc")).alias("econ_pd"),
        )

    @cached_property
    def reg_capital(self) -> DataFrame:
        missing = F.lit(codes.MISSING_AMOUNT).cast(MONEY)
        return self._capital_lines().select(
            self._contract().alias("contract_id"), self._entity().alias("entity_id"),
            F.when(F.col("l_quantity") == 50, missing).otherwise(F.col("price")).alias("reg_ead"),
            (F.col("price") * F.col("tax")).cast(MONEY).alias("reg_capital"),
            (F.col("price") * F.col("disc") * F.col("disc")).cast(MONEY).alias("reg_loss"),
            F.col("disc").alias("reg_pd"),
            (F.col("tax") * 5).cast(RATE).alias("reg_lgd"),
            (F.col("tax") * 20).cast(RATE).alias("reg_rw"),
        )

    @cached_property
    def provisions(self) -> DataFrame:
        """A slice of the lines on purpose: rows without a partner are what the outer joins are for."""
        return self.lines.filter(F.col("l_linestatus") == "F").select(
            F.concat(F.lit("00"), pad(F.col("l_suppkey") % 10, 4)).alias("branch_code"),
            self._contract_tail().alias("contract_tail"), self._entity().alias("entity_id"),
            F.when(F.col("l_quantity") == 50, F.lit(codes.MISSING_AMOUNT).cast(MONEY)).otherwise(
                (F.col("price") * F.col("disc")).cast(MONEY)).alias("provision_amount"),
            (F.col("l_linenumber") % 3 + 1).cast("int").alias("provision_stage"),
            pad(F.col("l_suppkey"), 9).alias("local_customer_id"),
            (F.col("l_quantity") % 3).cast("int").cast("string").alias("watch_list"),
            self._currency(F.col("l_suppkey")).alias("currency"),
        )

    # --- customers and groups ---

    @cached_property
    def customers(self) -> DataFrame:
        base = self.raw("customer")
        again = base.filter(F.col("c_acctbal") < 0)  # some customers are delivered twice
        return base.unionByName(again).select(
            self._golden(F.col("c_custkey")).alias("golden_customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("activity_id"),
            pad(F.col("c_nationkey"), 2).alias("customer_country"),
        )

    @cached_property
    def links(self) -> DataFrame:
        return self.raw("customer").select(
            self._golden(F.col("c_custkey")).alias("golden_customer_id"),
            self._customer(F.col("c_custkey")).alias("customer_id"))

    @cached_property
    def members(self) -> DataFrame:
        key = F.col("c_custkey")
        first = F.struct(F.lit("CP").alias("hierarchy_level"),
                         case(L.RELATION_TYPES, (F.col("c_nationkey") % 4).cast("int")).alias("relation_type"),
                         F.concat(F.lit("G"), pad(key % 40, 2)).alias("group_id"))
        second = F.struct(F.when(key % 11 == 0, "XX").otherwise("CC").alias("hierarchy_level"),
                          F.lit("B").alias("relation_type"),
                          F.concat(F.lit("G"), pad(key % 37, 2)).alias("group_id"))
        return self.raw("customer").select(
            key, self._customer(key).alias("customer_id"), F.explode(F.array(first, second)).alias("m")).select(
            "customer_id", "m.hierarchy_level", "m.relation_type", "m.group_id",
            F.when(key < 40, "S").otherwise("N").alias("participant_header_type"))

    @cached_property
    def groups(self) -> DataFrame:
        return self.raw("customer").groupBy((F.col("c_custkey") % 40).alias("g")).agg(
            F.min("c_nationkey").alias("n"), F.min("c_name").alias("name")).select(
            F.concat(F.lit("G"), pad(F.col("g"), 2)).alias("group_id"),
            pad(F.col("n"), 2).alias("group_country"),
            F.concat(F.lit("  "), "name").alias("group_name"),
            F.concat("name", F.lit(" holding ")).alias("group_full_name"),
            F.concat(F.lit("T"), (F.col("g") % 3 + 1).cast("string")).alias("tier_id"),
            pad(F.col("g") % 8, 5).alias("segment_id"))

    @cached_property
    def taxonomy_relation(self) -> DataFrame:
        pair = F.explode(F.array(
            F.struct(F.lit(codes.SUBSECTOR_CATALOGUE).alias("to_catalogue"),
                     F.concat(F.lit("U"), F.substring("c_mktsegment", 1, 2)).alias("to_value")),
            F.struct(F.lit(codes.SECTOR_CATALOGUE).alias("to_catalogue"),
                     F.concat(F.lit("K"), F.length("c_mktsegment").cast("string")).alias("to_value"))))
        return self.raw("customer").select("c_mktsegment", pair.alias("p")).select(
            F.lit(codes.ACTIVITY_CATALOGUE).alias("from_catalogue"), F.col("c_mktsegment").alias("from_value"),
            "p.to_catalogue", "p.to_value")

    @cached_property
    def taxonomy_values(self) -> DataFrame:
        return self.taxonomy_relation.filter(F.col("to_value") != "UMA").select(
            F.col("to_catalogue").alias("catalogue"), F.col("to_value").alias("value"),
            F.concat(F.lit("Text of "), "to_value").alias("description"))

    @cached_property
    def countries(self) -> DataFrame:
        return self.raw("nation").select(
            pad(F.col("n_nationkey"), 2).alias("country_id"), F.col("n_name").alias("country_name"))

    @cached_property
    def external_ratings(self) -> DataFrame:
        """A slice of the lines on purpose: rows without a partner are what the outer joins are for."""
        return self.raw("orders").filter(F.col("o_orderstatus") != "P").select(
            self._golden(F.col("o_custkey")).alias("golden_customer_id"),
            case(L.PRIORITY_RATING, F.col("o_orderpriority")).alias("external_rating"))

    @cached_property
    def accredited(self) -> DataFrame:
        return self.raw("orders").select(
            pad(F.col("o_custkey"), 9).alias("participant_id"),
            F.when(F.col("o_custkey") % 2 == 0, L.HOME).otherwise(L.ABROAD).alias("ledger_entity"),
            F.trunc("o_orderdate", "month").alias("rating_date"),
            F.to_date("o_orderdate").alias("register_date"),
            F.when(F.col("o_orderstatus") == "F", "S ").otherwise("N").alias("construction_type"),
            letter(F.col("o_orderkey")).alias("project_rating"),
            F.when(F.col("o_orderkey") % 4 == 0, "Adjusted").alias("capital_adjustment"),
            F.when(F.col("o_orderstatus") == "O", "High").otherwise("Low").alias("project_score"),
            (F.col("o_orderkey") % 100 / 100).cast(RATE).alias("project_lgd"),
            F.col("o_orderkey").alias("row_id"))

    @cached_property
    def customer_ratings(self) -> DataFrame:
        return self.raw("customer").select(
            self._customer(F.col("c_custkey")).alias("customer_id"),
            letter(F.col("c_custkey") * 3).alias("internal_rating"),
            F.substring(letter(F.col("c_custkey") * 3), 1, 2).alias("short_rating"),
            F.date_add(F.lit("1998-01-01").cast("date"), (F.col("c_custkey") % 180).cast("int")).alias("rating_tool_date"))

    @cached_property
    def cost_income(self) -> DataFrame:
        """A ratio per month, business area and office."""
        return self.raw("orders").groupBy(
            F.trunc("o_orderdate", "month").alias("cutoff_date"),
            F.when(F.col("o_custkey") % 2 == 0, codes.COST_INCOME_AREA).otherwise("other").alias("area_id"),
            F.when(F.col("o_custkey") % 3 != 0, f" {codes.HOME_OFFICE} ").otherwise("abroad").alias("office_desc"),
        ).agg((F.count(F.lit(1)) / F.max(F.col("o_custkey"))).alias("ratio"))

    # --- prior_deals, guarantees, marks ---

    @cached_property
    def prior_deals(self) -> DataFrame:
        """A slice of the lines on purpose: rows without a partner are what the outer joins are for."""
        return self.lines.filter(F.col("l_quantity") > 45).select(
            *self._loan_key(), F.col("tax").alias("sold_percent"),
            F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey")).alias("deal_id"),
            F.col("ship_date").alias("deal_date"))

    @cached_property
    def guarantee_assignments(self) -> DataFrame:
        """A slice of the lines on purpose: rows without a partner are what the outer joins are for."""
        return self.lines.filter(F.col("l_returnflag") == "R").select(
            self._contract().alias("contract_id"),
            F.concat(F.lit("GU"), F.col("l_partkey").cast("string")).alias("guarantee_id"),
            self._currency(F.col("l_partkey")).alias("currency"),
            (F.col("price") * F.col("disc")).cast(MONEY).alias("guaranteed_amount"),
            F.col("ship_date").alias("begin_date"),
            F.date_add("ship_date", (F.col("l_quantity") * 30).cast("int")).alias("end_date"),
            F.lit(VALUE_DATE).cast("date").alias("cutoff_date"))

    @cached_property
    def guarantee_board(self) -> DataFrame:
        return self.lines.select(
            F.concat(F.lit("GU"), F.col("l_partkey").cast("string")).alias("guarantee_id"),
            self._customer(F.col("l_suppkey")).alias("customer_id"))

    @cached_property
    def agency_customers(self) -> DataFrame:
        return self.raw("customer").filter(F.col("c_nationkey") == 7).select(
            self._customer(F.col("c_custkey")).alias("customer_id"))

    @cached_property
    def marks(self) -> DataFrame:
        """A slice of the lines on purpose: rows without a partner are what the outer joins are for."""
        return self.lines.filter(F.col("l_returnflag") == "A").select(
            self._contract().alias("contract_id"),
            F.when(F.col("disc") >= F.lit("0.08").cast(RATE), codes.SUSTAINABILITY_MARK).otherwise("OTHR").alias("mark_id"))

    @cached_property
    def entities(self) -> DataFrame:
        """Entity catalogue: named after the supplier nations."""
        return self.raw("supplier").groupBy(
            F.when(F.col("s_suppkey") % 2 == 0, L.HOME).otherwise(L.ABROAD).alias("entity_id")).agg(
            F.concat(F.lit("Entity of "), F.min("s_name")).alias("entity_name"))

    # --- limit sheets ---

    @cached_property
    def sheet_history(self) -> DataFrame:
        """Loaded limit lists over time: one rule row per order."""
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        kind = case(L.HISTORY_TYPES, (key % len(L.HISTORY_TYPES)).cast("int"))
        day = F.to_date("o_orderdate")
        text_date = F.when(key % 4 == 0, F.date_format(day, "dd/MM/yyyy")).when(
            key % 4 == 1, F.concat(F.lit("on "), F.date_format(day, "yyyy.MM.dd"))).when(
            key % 97 == 2, F.lit("no date 12")).otherwise(F.date_format(day, "yyyy-MM-dd"))
        amount = F.when(key % 89 == 5, F.lit("n/a")).otherwise(
            F.translate(F.format_number("o_totalprice", 2), ",.", ".,"))
        return self.raw("orders").withColumn("limit_type", kind).select(
            key.alias("rule_id"),
            F.concat(F.lit("List "), (cust % 7).cast("string")).alias("name_list_desc"),
            day.alias("limit_date"), text_date.alias("limit_date_text"), "limit_type",
            F.when(F.col("limit_type").isin("sts", "sts_group"), "sts_flag")
            .when(F.col("limit_type") == "constant_type", case(L.CONSTANT_NAMES, (cust % 4).cast("int")))
            .otherwise(F.concat("limit_type", F.lit("_id"))).alias("concept1_desc"),
            F.when(F.col("limit_type") == "sts", F.when(cust % 7 < 4, "1").otherwise("0"))
            .when(F.col("limit_type") == "sts_group", "1")
            .when(F.col("limit_type") == "group", F.concat(F.lit("G"), pad(cust % 40, 2)))
            .otherwise("total").alias("concept1_value"),
            F.when(F.col("limit_type") == "sts_group", "group_id").otherwise("-").alias("concept2_desc"),
            F.when(F.col("limit_type") == "sts_group", "total").otherwise("-").alias("concept2_value"),
            amount.alias("limit_value"),
            F.when(key % 3 != 0, "1").otherwise("0").alias("corporate_loan_flag"),
            F.when(key % 5 != 0, "1").otherwise("0").alias("project_finance_flag"),
            F.when(F.col("limit_type").isin(*L.ROW_TYPES), "individual").otherwise("portfolio").alias("limit_scope"),
            F.when(F.col("o_orderstatus") != "P", 1).otherwise(0).alias("active_flag"),
            (key % 10).cast("int").alias("visual_order"),
            F.when(F.col("limit_type") == "sts_group", 1).otherwise(0).alias("complex_limit"),
            F.trunc("o_orderdate", "month").alias("closing_date"),
        )

    @cached_property
    def sheet(self) -> DataFrame:
        """The sheet of one investor; its pool size is a twentieth of the exposure in the data."""
        rows = self.literal(L.SHEET, L.SHEET_SCHEMA)
        size = self.lines.agg((F.floor(F.sum("price").cast("double") / 20000) * 1000).cast("double").alias("size"))
        pool_rule = size.select(
            *[F.lit(v).cast(t).alias(n) if n != "limit_value" else F.col("size").alias(n)
              for (n, t), v in zip(L.SHEET_COLUMNS, L.POOL_SIZE_RULE)])
        # a few dozen rows, read several times: write them once
        return materialize(rows.unionByName(pool_rule), "sheet")
