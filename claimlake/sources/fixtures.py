"""Derive the three raw claim extracts and the two reference maps from the driver tables.

The driver ships TPC-H-style tables; the models expect a wide drug-spending file, a
prescriber summary and a prescriber-by-drug detail, plus a therapeutic-area map and a
state-to-region map. Everything below is a Spark job over the driver tables, so its work
grows with them.

Plan shape (scale notes):
* order lines are joined to orders once per extract on ``orderkey`` (a shuffle both
  sides at scale, the only big-big join);
* ``part`` / ``supplier`` mappings are narrow projections joined on their keys; the
  planner broadcasts them while they are small and shuffles beyond;
* ``nation`` / ``region`` are fixed 25 / 5 row tables and are always broadcast;
* every extract aggregates before it joins the (large) customer table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio
from .tables import DriverTables

# Fixed values of the fixture (FIXTURES.md section 3).
FIXTURE_YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)
SPENDING_FACTOR = Decimal("0.2")
MIN_VISIBLE_BENEFICIARIES = 4
OUTLIER_HIGH_UNITS = 400
OUTLIER_LOW_UNITS = 300
SUPPRESSED_MOD = 7
AREA_BY_NOUN = {"anvil": "Alpha", "bolt": "Alpha", "gear": "Beta", "gizmo": "Beta",
                "plate": "Gamma", "ring": "Delta"}
SPECIALTY_ADJECTIVES = ("cold", "hot")
FOCUS_NOUNS = ("plate",)
FOCUS_ADJECTIVES = ("blue", "red", "new")
UNMAPPED_NATION = 24
DIVISIONS = 9

#: Tasks that a customer's lines are dealt to, by drug.
DEALS = 4

# Wide measure stubs of the spending extract, in file order.
SPENDING_STUBS = ("tot_spndng", "tot_clms", "tot_benes", "tot_dsg_unts", "avg_spnd_per_clm",
                  "avg_spnd_per_bene", "avg_spnd_per_dsg_unt_wghtd", "outlier_flag")


def _brand_of(partkey: Column, name: Column) -> Column:
    """Brand name by part key: none, the generic name itself, or a distinct brand."""
    m = partkey % 3
    return (F.when(m == 0, F.lit(None).cast("string"))
            .when(m == 1, name)
            .otherwise(F.concat(F.lit(" Brand "), name)))


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _order_lines(t: DriverTables) -> DataFrame:
    """Order lines with their customer and ship year (one join on orderkey).

    Both sides are dealt out by order over a number of tasks that grows with the lines: left to the
    planner, a task takes as many lines as fit its advisory size in compressed bytes, and the join's
    sort and the extract's partial aggregate (almost a group a line) hold them all at once.
    """
    n = t.line_tasks()
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus",
        F.year("l_shipdate").cast("int").alias("ship_year")).repartition(n, "l_orderkey")
    orders = t.orders.select(F.col("o_orderkey"), F.col("o_custkey")).repartition(n, "o_orderkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner")


def _manufacturers(t: DriverTables, max_bytes: int = 64 << 20) -> DataFrame:
    """Supplier -> manufacturer name (the supplier's region).

    The planner estimates a join's size as the product of its inputs, so this map would
    never be broadcast on its own; one job checks its size (and key uniqueness) and
    broadcasts it while it is small. A supplier table beyond ``max_bytes`` is joined
    by shuffle instead.
    """
    from ..operators.joins import checked_broadcast
    nation = F.broadcast(t.nation.select("n_nationkey", "n_regionkey"))
    region = F.broadcast(t.region.select("r_regionkey", "r_name"))
    m = (t.supplier.select("s_suppkey", "s_nationkey")
         .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
         .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
         .select("s_suppkey", F.col("r_name").alias("mftr_name")))
    return checked_broadcast(m, ["s_suppkey"], max_bytes, "supplier manufacturers")


def line_base(t: DriverTables) -> DataFrame:
    """Order lines with everything the three extracts need: customer, year, part name,
    generic / brand names and manufacturer. Built once per ingest and written to the
    shared folder; each extract then aggregates that table."""
    p = F.col("p_partkey")
    parts = t.part.select(
        "p_partkey", "p_name",
        F.col("p_name").alias("gnrc_name"),
        _brand_of(p, F.col("p_name")).alias("brnd_name"))
    return (_order_lines(t)
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .join(_manufacturers(t), F.col("l_suppkey") == F.col("s_suppkey"))
            .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_returnflag", "l_linestatus", "ship_year", "o_custkey", "o_orderkey",
                    "p_name", "gnrc_name", "brnd_name", "mftr_name"))


def drug_spending_long(t: DriverTables, base: DataFrame | None = None) -> DataFrame:
    """Per drug x brand x manufacturer x year measures (before pivoting wide)."""
    rows = base if base is not None else line_base(t)
    spend = _money(F.sum(_money(F.col("l_extendedprice"))) * F.lit(SPENDING_FACTOR))
    benes = F.count_distinct("o_custkey")
    units = F.sum("l_quantity")
    agg = rows.groupBy("gnrc_name", "brnd_name", "mftr_name", "ship_year").agg(
        spend.alias("tot_spndng"),
        F.count(F.lit(1)).alias("tot_clms"),
        F.when(benes >= MIN_VISIBLE_BENEFICIARIES, benes).alias("tot_benes"),
        units.alias("tot_dsg_unts"),
        F.when(units > OUTLIER_HIGH_UNITS, F.lit("1"))
        .when(units > OUTLIER_LOW_UNITS, F.lit(" ")).alias("outlier_flag"))
    return agg.select(
        "gnrc_name", "brnd_name", "mftr_name", "ship_year", "tot_spndng", "tot_clms",
        "tot_benes", "tot_dsg_unts",
        ratio("tot_spndng", "tot_clms", 2).alias("avg_spnd_per_clm"),
        ratio("tot_spndng", "tot_benes", 2).alias("avg_spnd_per_bene"),
        ratio("tot_spndng", "tot_dsg_unts", 2).alias("avg_spnd_per_dsg_unt_wghtd"),
        "outlier_flag")


def drug_spending_wide(t: DriverTables, years=FIXTURE_YEARS,
                       base: DataFrame | None = None) -> DataFrame:
    """raw_part_d_spending: one row per drug x brand x manufacturer, measures by year.

    The pivot is a conditional aggregation over explicit years (no extra pass to find
    them; a line shipped in another year fails the job); ``tot_mftr`` counts the manufacturers
    of the drug x brand.
    """
    long = drug_spending_long(t, base).withColumn("ship_year", F.when(
        F.col("ship_year").isin(*years) | F.col("ship_year").isNull(), F.col("ship_year"))
        .otherwise(F.raise_error(F.lit("order line shipped outside the extract's years")).cast("int")))
    # Pivot a numeric code for the string outlier flag, so every pivoted cell has a
    # fixed-width aggregation buffer (hash aggregate, no sort); decode after the pivot.
    flag_code = (F.when(F.col("outlier_flag") == "1", F.lit(2))
                 .when(F.col("outlier_flag") == " ", F.lit(1)))
    cells = []
    for y in years:
        hit = F.col("ship_year") == F.lit(y)
        for stub in SPENDING_STUBS:
            src = flag_code if stub == "outlier_flag" else F.col(stub)
            cells.append(F.max(F.when(hit, src)).alias(f"{stub}_{y}"))
    wide = long.groupBy("gnrc_name", "brnd_name", "mftr_name").agg(*cells)
    wide = wide.withColumns({
        f"outlier_flag_{y}": F.when(F.col(f"outlier_flag_{y}") == 2, F.lit("1"))
        .when(F.col(f"outlier_flag_{y}") == 1, F.lit(" ")) for y in years})
    w = Window.partitionBy("gnrc_name", "brnd_name")
    return wide.select("brnd_name", "gnrc_name", "mftr_name",
                       F.count(F.lit(1)).over(w).cast("int").alias("tot_mftr"),
                       *[f"{s}_{y}" for y in years for s in SPENDING_STUBS])


def _customers(t: DriverTables) -> DataFrame:
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name"))
    return (t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "c_name", "c_mktsegment", "n_name"))


def prescribers(t: DriverTables, base: DataFrame | None = None) -> DataFrame:
    """raw_prescribers: one row per customer with at least one order line.

    Two-level aggregation: lines -> orders -> customers. An order belongs to one customer,
    so "distinct orders" (patients) is the number of order rows and "distinct orders with
    an opioid line" counts orders with one; no Expand of the line data is needed, and the
    line level is reduced to orders before the customer shuffle.
    """
    lines = base if base is not None else _order_lines(t)
    brand = (F.col("l_partkey") % 3) == 2
    price = _money(F.col("l_extendedprice"))
    opioid = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    zero = F.lit(0).cast("decimal(18,2)")
    orders = lines.groupBy("o_custkey", "o_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(brand).alias("nb"),
        F.count_if(~brand).alias("ng"),
        F.sum(price).alias("cost"),
        F.sum(F.when(brand, price).otherwise(zero)).alias("bcost"),
        F.sum(F.when(~brand, price).otherwise(zero)).alias("gcost"),
        F.sum("l_quantity").alias("qty"),
        F.count_if(opioid).alias("nop"),
        F.count_if(F.col("l_returnflag") == "A").alias("nab"),
        F.count_if(F.col("l_linenumber") % 2 == 1).alias("nf"),
        F.count_if(F.col("l_linenumber") % 2 == 0).alias("nm"))
    per = orders.groupBy("o_custkey").agg(
        F.sum("n").alias("claims"),
        F.sum("nb").alias("brnd_tot_clms"),
        F.sum("ng").alias("gnrc_tot_clms"),
        _money(F.sum("cost")).alias("tot_drug_cst"),
        _money(F.sum("bcost")).alias("brnd_tot_drug_cst"),
        _money(F.sum("gcost")).alias("gnrc_tot_drug_cst"),
        F.count(F.lit(1)).alias("tot_benes"),
        ratio(F.sum("qty"), F.lit(30), 2).alias("tot_30day_fills"),
        F.sum("nop").alias("opioid_tot_clms"),
        F.count_if(F.col("nop") > 0).alias("opioid_tot_benes"),
        F.sum("nab").alias("antbtc_tot_clms"),
        ratio(F.sum("qty"), F.sum("n"), 1).alias("bene_avg_age"),
        F.sum("nf").alias("bene_feml_cnt"),
        F.sum("nm").alias("bene_male_cnt"))
    c = _customers(t)
    return per.join(c, per.o_custkey == c.c_custkey).select(
        F.col("c_custkey").cast("string").alias("prscrbr_npi"),
        F.col("c_name").alias("prscrbr_last_org_name"),
        F.lit(None).cast("string").alias("prscrbr_first_name"),
        F.lit(None).cast("string").alias("prscrbr_crdntls"),
        F.lit("I").alias("prscrbr_ent_cd"),
        F.col("c_mktsegment").alias("prscrbr_type"),
        F.col("n_name").alias("prscrbr_state_abrvtn"),
        F.lit(None).cast("string").alias("prscrbr_city"),
        F.col("claims").alias("tot_clms"),
        "tot_benes", "tot_drug_cst", "tot_30day_fills", "brnd_tot_clms", "gnrc_tot_clms",
        "brnd_tot_drug_cst", "gnrc_tot_drug_cst", "opioid_tot_clms", "opioid_tot_benes",
        "antbtc_tot_clms", "bene_avg_age", "bene_feml_cnt", "bene_male_cnt")


def prescriber_drugs(t: DriverTables, base: DataFrame | None = None) -> DataFrame:
    """raw_prescribers_drug: one row per customer x part name x brand.

    The lines are shuffled once, by customer and a deal of the drug, for the aggregate and the join with the customers
    above it: almost every line is a group, so a shuffle of partial results would move as many rows again. A
    customer's lines go to ``DEALS`` tasks, which get a copy of the customer each.
    """
    if base is not None:
        rows = base
    else:
        parts = t.part.select("p_partkey", "p_name",
                              _brand_of(F.col("p_partkey"), F.col("p_name")).alias("brnd_name"))
        rows = _order_lines(t).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    n = t.line_tasks()
    rows = rows.select("o_custkey", "o_orderkey", "l_quantity", _money(F.col("l_extendedprice")).alias("l_extendedprice"),
                       F.pmod(F.hash("p_name", "brnd_name"), F.lit(DEALS)).alias("deal"), "p_name", "brnd_name").repartition(n, "o_custkey", "deal")
    per = rows.groupBy("o_custkey", "deal", "p_name", "brnd_name").agg(
        F.count(F.lit(1)).alias("tot_clms"),
        F.count_distinct("o_orderkey").alias("tot_benes"),
        F.sum("l_quantity").cast("long").alias("tot_day_suply"),
        ratio(F.sum("l_quantity"), F.lit(30), 2).alias("tot_30day_fills"),
        _money(F.sum("l_extendedprice")).alias("tot_drug_cst"))
    c = (_customers(t).withColumn("c_deal", F.explode(F.array(*[F.lit(i) for i in range(DEALS)])))
         .repartition(n, "c_custkey", "c_deal").hint("merge"))
    return per.join(c, (per.o_custkey == c.c_custkey) & (per.deal == c.c_deal)).select(
        F.col("c_custkey").cast("string").alias("prscrbr_npi"),
        F.col("c_name").alias("prscrbr_last_org_name"),
        F.lit(None).cast("string").alias("prscrbr_first_name"),
        F.col("c_mktsegment").alias("prscrbr_type"),
        F.col("n_name").alias("prscrbr_state_abrvtn"),
        F.lit(None).cast("string").alias("prscrbr_city"),
        "brnd_name",
        F.col("p_name").alias("gnrc_name"),
        "tot_clms", "tot_benes", "tot_day_suply", "tot_30day_fills", "tot_drug_cst",
        F.when(F.col("c_custkey") % SUPPRESSED_MOD == 0, F.lit("*")).alias("ge65_sprsn_flag"))


def therapeutic_area_map(t: DriverTables) -> DataFrame:
    """Seed: generic name -> therapeutic area, specialty and focus flags."""
    names = t.part.select("p_name").distinct()
    adj = F.split(F.col("p_name"), " ").getItem(0)
    noun = F.split(F.col("p_name"), " ").getItem(1)
    area = None
    for n, a in AREA_BY_NOUN.items():
        area = F.when(noun == n, F.lit(a)) if area is None else area.when(noun == n, F.lit(a))
    return (names.where(area.isNotNull())
            .select(F.col("p_name").alias("generic_name"),
                    area.alias("therapeutic_area"),
                    adj.isin(*SPECIALTY_ADJECTIVES).alias("is_specialty"),
                    (noun.isin(*FOCUS_NOUNS) | adj.isin(*FOCUS_ADJECTIVES)).alias("is_focus_area")))


def state_region_map(t: DriverTables) -> DataFrame:
    """Seed: state (nation) -> census region and division; one nation left unmapped."""
    return (t.nation.where(F.col("n_nationkey") != UNMAPPED_NATION)
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias("state_abbrev"),
                    F.col("n_name").alias("state_name"),
                    F.col("r_name").alias("census_region"),
                    F.concat(F.lit("Division "), (F.col("n_nationkey") % DIVISIONS).cast("string"))
                    .alias("census_division")))
