"""Load of the whole star schema into database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfwise.operators import facts
from shelfwise.operators.dims import DIMENSIONS, dim_product, dimension, product_members
from shelfwise.operators.keys import with_row_id
from shelfwise.operators.quality import assert_found, assert_unique, row_counts
from shelfwise.plans.workspace import Workspace
from shelfwise.sinks.tables import ensure_database, load_table, overwrite_table
from shelfwise.sources import seeds
from shelfwise.types import TABLES

# The column that facts find a member by, per dimension.
NATURAL_KEYS = {
    "dim_category": "category_name",
    "dim_brand": "brand_name",
    "dim_season": "season_name",
    "dim_markdown": "markdown_percentage",
    "dim_customer_rating": "customer_rating",
    "dim_promotion": "promotion_type",
    "dim_stock_level": "stock_status",
}
OTHER_DIMS = (
    "dim_price_range", "dim_store", "dim_channel", "dim_date", "dim_customer", "dim_product",
)


def load_star(work: Workspace, database: str, fmt: str = "parquet") -> DataFrame:
    """Write raw, dimension, fact and rule tables and return their row counts.

    Raw, dimension and fact tables are replaced, each once its new rows are written, so a second load leaves
    the same rows and a failed one the old ones. Members keep the keys of the load before; new ones are
    numbered after these.
    Facts are built from the dimension tables just written, whose natural keys have to be
    unique. The rule and trend tables get the standard rows when they are created; after that
    they are the caller's to change.
    """
    spark = work.spark
    ensure_database(spark, database)

    def target(name: str) -> str:
        return f"{database}.{name}"

    overwrite_table(work.retail_a, target("retail_a"), fmt)
    overwrite_table(work.retail_b, target("retail_b"), fmt)

    def loaded_before(name: str) -> DataFrame | None:
        return spark.table(target(name)) if spark.catalog.tableExists(target(name)) else None

    for name in (*NATURAL_KEYS, *OTHER_DIMS):
        known = loaded_before(name)
        if name in DIMENSIONS:
            source = dimension(work.members, name, known)
        elif name == "dim_product" and known is not None:
            category, brand = spark.table(target("dim_category")), spark.table(target("dim_brand"))
            source = dim_product(product_members(work.products), category, brand, work.as_of, known)
        else:
            source = work.star_date if name == "dim_date" else getattr(work, name)
        load_table(source, target(name), TABLES[name], fmt)

    dims = {name: spark.table(target(name)) for name in (*NATURAL_KEYS, *OTHER_DIMS)}
    for name, key in NATURAL_KEYS.items():
        assert_unique(dims[name], [key], name)

    a, b = spark.table(target("retail_a")), spark.table(target("retail_b"))
    built = {
        "fact_sales": facts.fact_sales(a, b, dims, work.as_of),
        "fact_inventory": facts.fact_inventory(a, b, dims, work.as_of),
        "fact_markdown_analytics": facts.fact_markdown_analytics(a, dims, work.as_of),
        "fact_customer_feedback": facts.fact_customer_feedback(b, dims, work.as_of),
        "fact_sales_profit": facts.fact_sales_profit(dims["dim_product"], work.as_of),
        "fact_markdown_uplift": facts.fact_markdown_uplift(dims["dim_product"]),
    }
    for name, fact in built.items():
        row_id = TABLES[name].names[0]
        load_table(with_row_id(fact, row_id), target(name), TABLES[name], fmt)
        if "date_key" in TABLES[name].names:
            assert_found(spark.table(target(name)), "date_key", dims["dim_date"], name)

    day = work.as_of.date()
    standard = {
        "banded_rules": seeds.banded_rules(spark, day),
        "priority_rules": seeds.priority_rules(spark),
        "product_trends": seeds.product_trends(spark, day),
    }
    for name, rows in standard.items():
        if not spark.catalog.tableExists(target(name)):
            load_table(rows, target(name), TABLES[name], fmt)

    loaded = ("retail_a", "retail_b", *dims, *built, *standard)
    return row_counts({name: spark.table(target(name)) for name in loaded})
