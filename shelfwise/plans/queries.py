"""The queries a user runs, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import classify
from shelfwise.functions.names import normalize_names
from shelfwise.operators import banded, conform, facts, kpis, priority, quality
from shelfwise.operators.joins import lookup
from shelfwise.operators.keys import with_row_numbers
from shelfwise.plans.workspace import AS_OF, FACTS, Workspace, workspace
from shelfwise.sinks.tables import preview
from shelfwise.sources import seeds
from shelfwise.sources.files import CheckedRows, read_csv_checked

Query = Callable[[SparkSession, str], DataFrame]


# --- priority rules -------------------------------------------------------------


def _priority_input(w: Workspace, own_price: bool) -> DataFrame:
    """All lines under the column names that the rule texts use."""
    df = w.retail_priced.select(
        F.col("product_id").alias("Product_ID"),
        *([F.col("original_price").alias("Our_Price")] if own_price else []),
        F.col("competitor_price").alias("Competitor_Price"),
        F.col("stock_level").alias("Stock_Level"),
        F.col("seasonality_factor").alias("Seasonality_Factor"),
        F.col("customer_ratings").alias("Customer_Ratings"),
        F.col("promotion_type").alias("Promotion_Type"),
    )
    return priority.with_baseline_price(df)


def _marked_down(w: Workspace, own_price: bool) -> DataFrame:
    discounted = priority.apply_priority_rules(
        _priority_input(w, own_price), seeds.priority_rules(w.spark)
    )
    return priority.with_markdown_amounts(discounted)


_PRIORITY_VIEW = (
    "Our_Price", "Competitor_Price", "Stock_Level", "Seasonality_Factor", "Customer_Ratings",
    "Optimal_Discount_Pct", "Final_Marked_Down_Price",
)


def priority_rules_own_price(w: Workspace) -> DataFrame:
    return _marked_down(w, own_price=True).select(*_PRIORITY_VIEW)


def priority_rules_fallback(w: Workspace) -> DataFrame:
    return _marked_down(w, own_price=False).select(*_PRIORITY_VIEW)


def priority_rules_unquoted(w: Workspace) -> DataFrame:
    """The rules with bare words for texts, as they are often typed."""
    bare = F.regexp_replace("condition", r"'(\w+)'", "$1")
    rules = seeds.priority_rules(w.spark).withColumn("condition", bare)
    priced = priority.apply_priority_rules(_priority_input(w, own_price=True), rules)
    return priority.with_markdown_amounts(priced).select(*_PRIORITY_VIEW)


def price_baseline(w: Workspace) -> DataFrame:
    return _priority_input(w, own_price=False).select(
        "Product_ID", "Competitor_Price", "Our_Price"
    )


def markdown_amounts(w: Workspace) -> DataFrame:
    return _marked_down(w, own_price=True).select(
        "Product_ID", "Our_Price", "Optimal_Discount_Pct", "Markdown_Amount",
        "Final_Marked_Down_Price",
    )


# --- sources in one layout --------------------------------------------------------


def conformed_sales(w: Workspace) -> DataFrame:
    return conform.conformed_sales(w.retail_a, w.retail_b)


def conformed_inventory(w: Workspace) -> DataFrame:
    return conform.conformed_inventory(w.retail_a, w.retail_b)


def _headed(df: DataFrame) -> DataFrame:
    """All columns under headings with blanks and capitals, as raw files have them."""
    return df.toDF(*(c.replace("_", " ").title() for c in df.columns))


def normalized_columns(w: Workspace) -> DataFrame:
    return normalize_names(_headed(w.retail_b))


def normalized_columns_a(w: Workspace) -> DataFrame:
    return normalize_names(_headed(w.retail_a))


def renamed_columns(w: Workspace) -> DataFrame:
    """Blanks go from the names, capitals stay."""
    return normalize_names(_headed(w.retail_a), lower=False)


# --- banded rules -----------------------------------------------------------------


def _measured(w: Workspace) -> DataFrame:
    """All lines with their signals; seasons in the upper case that the rules use."""
    df = w.retail_priced.select(
        "product_id", "category", F.upper("season").alias("season"), "original_price",
        "competitor_price", "stock_level", "days_in_stock", "trend_score", "unit_cost",
        F.col("customer_ratings").alias("product_rating"),
        F.col("historical_sales").alias("units_sold"),
    )
    return banded.measured_signals(df)


def _assumed(w: Workspace) -> DataFrame:
    df = w.retail_priced.select(
        "product_id", "category", F.upper("season").alias("season"), "original_price",
        "competitor_price", "stock_level", "historical_sales", "customer_ratings",
    )
    return banded.assumed_signals(df)


def _rules(w: Workspace) -> DataFrame:
    return seeds.banded_rules(w.spark, w.as_of.date())


_SIGNALS = (
    "product_id", "sell_through_rate", "competitor_gap_pct", "days_in_stock", "product_rating",
    "trend_score", "unit_cost",
)


def pricing_signals(w: Workspace) -> DataFrame:
    return _measured(w).select(*_SIGNALS)


def pricing_signals_assumed(w: Workspace) -> DataFrame:
    return _assumed(w).select(*_SIGNALS)


def rules_selected(w: Workspace) -> DataFrame:
    return banded.rule_usage(_measured(w), _rules(w), ["EXPIRY", "SEASONAL", "TRENDING"])


def rules_grouped(w: Workspace) -> DataFrame:
    """One row per rule: its bands as text, in evaluation order, and the rows it prices."""
    usage = banded.rule_usage(_measured(w), _rules(w))

    def number(c: str):
        return F.coalesce(F.col(c).cast("decimal(10,2)").cast("string"), F.lit("-"))

    band = F.concat_ws(
        " ",
        "condition_operator",
        number("condition_min"),
        number("condition_max"),
        F.coalesce("condition_str_value", F.lit("-")),
        number("price_multiplier"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("evaluation_order", band.alias("band"))))
    return usage.groupBy("rule_id", "rule_name").agg(
        F.count("*").alias("bands"),
        F.array_join(F.transform(ordered, lambda b: b["band"]), "; ").alias("conditions"),
        F.sum("priced_rows").alias("priced_rows"),
    )


def _recommended(df: DataFrame, w: Workspace, units: str, names=None) -> DataFrame:
    result, prices = banded.apply_banded_rules(df, _rules(w), names)
    return kpis.pricing_kpis(result, units).select(
        "product_id", "category", "original_price", "recommended_price", "discount_pct_applied",
        "markdown_reason", "raw_recommended_price", "floor_price", "floor_bound", *prices,
    )


def banded_rule_prices(w: Workspace) -> DataFrame:
    result, prices = banded.apply_banded_rules(_measured(w), _rules(w))
    return result.select("product_id", "category", "original_price", *prices)


def banded_rules_subset(w: Workspace) -> DataFrame:
    return _recommended(_measured(w), w, "units_sold", ["SEASONAL", "COMPETITOR"])


def banded_single_rule(w: Workspace) -> DataFrame:
    return _recommended(_measured(w), w, "units_sold", ["EXPIRY"])


def banded_no_rule(w: Workspace) -> DataFrame:
    return _recommended(_measured(w), w, "units_sold", ["NOPE"])


def banded_recommendation(w: Workspace) -> DataFrame:
    return _recommended(_measured(w), w, "units_sold")


def banded_recommendation_assumed(w: Workspace) -> DataFrame:
    return _recommended(_assumed(w), w, "historical_sales")


def banded_rules_joined(w: Workspace) -> DataFrame:
    """The recommendation with bands joined as data."""
    result, prices = banded.apply_banded_rules(_measured(w), _rules(w), joined=True)
    return kpis.pricing_kpis(result, "units_sold").select(
        "product_id", "category", "original_price", "recommended_price", "discount_pct_applied",
        "markdown_reason", "raw_recommended_price", "floor_price", "floor_bound", *prices,
    )


def pricing_kpis(w: Workspace) -> DataFrame:
    result, _ = banded.apply_banded_rules(_measured(w), _rules(w))
    return kpis.pricing_kpis(result, "units_sold").select(
        "product_id", "original_price", "recommended_price", "units_sold",
        "discount_pct_applied", "gross_amount", "net_amount", "discount_amount",
    )


def product_trends(w: Workspace) -> DataFrame:
    """Sales of both sources with the trend known for their product."""
    sales = conform.conformed_sales(w.retail_a, w.retail_b).select(
        "product_id", "original_price"
    )
    trends = seeds.product_trends(w.spark, w.as_of.date()).withColumnRenamed(
        "product_id", "trend_product"
    )
    return lookup(
        sales, F.col("product_id"), trends, "trend_product",
        "trend_id", "trend_type", "trend_score", "trend_direction", "trend_source", "trend_date",
    )


# --- dimensions --------------------------------------------------------------------


def dim_price_range(w: Workspace) -> DataFrame:
    dims = {"dim_price_range": w.dim_price_range}
    sales = facts.by_price_range(conformed_sales(w), "original_price", dims)
    return quality.member_usage(w.dim_price_range, "price_range_key", sales)


def dim_stock_level(w: Workspace) -> DataFrame:
    dims = {"dim_stock_level": w.dim_stock_level}
    sales = facts.by_stock_level(conformed_sales(w), "stock_level", dims)
    return quality.member_usage(w.dim_stock_level, "stock_level_key", sales)


def dim_store(w: Workspace) -> DataFrame:
    sales = conformed_sales(w).select(F.lit(facts.DEFAULT_STORE).alias("store_key"))
    return quality.member_usage(w.dim_store, "store_key", sales)


def dim_channel(w: Workspace) -> DataFrame:
    sales = conformed_sales(w).select(F.lit(facts.DEFAULT_CHANNEL).alias("channel_key"))
    return quality.member_usage(w.dim_channel, "channel_key", sales)


# --- lookups and classes row by row --------------------------------------------------


def price_band_join(w: Workspace) -> DataFrame:
    lines = conformed_inventory(w).select("product_id", "original_price")
    dims = {"dim_price_range": w.dim_price_range}
    return facts.by_price_range(lines, "original_price", dims, "price_segment")


def stock_level_join(w: Workspace) -> DataFrame:
    lines = conformed_inventory(w).select("product_id", "stock_quantity")
    return facts.by_stock_level(lines, "stock_quantity", {"dim_stock_level": w.dim_stock_level})


def markdown_effectiveness(w: Workspace) -> DataFrame:
    before, after_2, after_4 = "historical_sales", "sales_after_m2", "sales_after_m4"
    return w.retail_a.select(
        "product_id", before, after_2, after_4,
        classify.markdown_effectiveness(F.col(before), F.col(after_2), F.col(after_4)).alias(
            "markdown_effectiveness"
        ),
    )


def season_months(w: Workspace) -> DataFrame:
    season = F.col("season")
    return conformed_inventory(w).select(
        "product_id", "season",
        classify.season_month(season, 0).alias("start_month"),
        classify.season_month(season, 1).alias("end_month"),
    )


def discount_type_map(w: Workspace) -> DataFrame:
    return w.retail_a.select(
        "product_id", "promotion_type",
        classify.discount_type(F.col("promotion_type")).alias("discount_type"),
    )


def rating_bands(w: Workspace) -> DataFrame:
    return conformed_sales(w).select(
        "product_id", "customer_ratings",
        classify.rating_category(F.col("customer_ratings")).alias("rating_category"),
    )


def feedback_bands(w: Workspace) -> DataFrame:
    return w.retail_b.select(
        "product_id", "customer_rating",
        classify.feedback_category(F.col("customer_rating")).alias("feedback_category"),
    )


# --- facts ---------------------------------------------------------------------------


def fact_sales_profit(w: Workspace) -> DataFrame:
    return facts.fact_sales_profit(w.dim_product, w.as_of)


def fact_markdown_uplift(w: Workspace) -> DataFrame:
    return facts.fact_markdown_uplift(w.dim_product)


def preview_fact_sales(w: Workspace) -> DataFrame:
    sales = w.fact_sales
    return preview(sales, 20, [F.asc_nulls_first(c) for c in sales.columns])


def fact_dates(w: Workspace) -> DataFrame:
    """Rows of each fact by the month that the calendar has for their day; a day that the calendar
    lacks would show as a row without year and month."""
    counts = None
    for name in FACTS:
        rows = getattr(w, name).groupBy("date_key").agg(F.count("*").alias("n"))
        rows = rows.select(F.lit(name).alias("table_name"), "date_key", "n")
        counts = rows if counts is None else counts.unionAll(rows)
    days = w.star_date.select(F.col("date_key").alias("_day"), "year", "month")
    found = lookup(counts, F.col("date_key"), days, "_day", "year", "month")
    return found.groupBy("table_name", "year", "month").agg(F.sum("n").alias("fact_rows"))


def load_row_counts(w: Workspace) -> DataFrame:
    """Rows of each table of the star. The facts are counted as they are stored, from what their files say
    of themselves: no column is read."""
    tables = {"retail_a": w.retail_a, "retail_b": w.retail_b} | w.dims
    others = ("dim_store", "dim_channel", "dim_date", "dim_customer", "dim_product")
    return quality.row_counts(tables | {name: getattr(w, name) for name in others} | w.stored_facts)


def column_report(w: Workspace) -> DataFrame:
    return quality.column_profile({"retail_a": w.retail_a, "retail_b": w.retail_b})


def fact_sales_numbered(w: Workspace) -> DataFrame:
    """Sales with row ids that are the same on every run."""
    return with_row_numbers(w.fact_sales, "sales_key")


def _checked_csv(w: Workspace) -> CheckedRows:
    fields = [T.StructField(f.name.replace("_", " ").title(), f.dataType) for f in w.retail_b.schema]
    return read_csv_checked(w.spark, w.csv_folder, T.StructType(fields))


def csv_scan(w: Workspace) -> DataFrame:
    """Source b read from CSV files, less the records that don't fit."""
    return _checked_csv(w).rows


def csv_rejects(w: Workspace) -> DataFrame:
    """The records that don't fit, as they stand in the files."""
    return _checked_csv(w).rejects.select("record")


_PLANS: dict[str, Callable[[Workspace], DataFrame]] = {
    "priority_rules_own_price": priority_rules_own_price,
    "priority_rules_fallback": priority_rules_fallback,
    "priority_rules_unquoted": priority_rules_unquoted,
    "price_baseline": price_baseline,
    "markdown_amounts": markdown_amounts,
    "conformed_sales": conformed_sales,
    "conformed_inventory": conformed_inventory,
    "normalized_columns": normalized_columns,
    "normalized_columns_a": normalized_columns_a,
    "renamed_columns": renamed_columns,
    "rules_selected": rules_selected,
    "rules_grouped": rules_grouped,
    "pricing_signals": pricing_signals,
    "pricing_signals_assumed": pricing_signals_assumed,
    "banded_rule_prices": banded_rule_prices,
    "banded_rules_subset": banded_rules_subset,
    "banded_single_rule": banded_single_rule,
    "banded_no_rule": banded_no_rule,
    "banded_recommendation": banded_recommendation,
    "banded_recommendation_assumed": banded_recommendation_assumed,
    "banded_rules_joined": banded_rules_joined,
    "pricing_kpis": pricing_kpis,
    "product_trends": product_trends,
    "dim_category": lambda w: w.dim_category,
    "dim_brand": lambda w: w.dim_brand,
    "dim_season": lambda w: w.dim_season,
    "dim_markdown": lambda w: w.dim_markdown,
    "dim_customer_rating": lambda w: w.dim_customer_rating,
    "dim_promotion": lambda w: w.dim_promotion,
    "dim_date": lambda w: w.dim_date,
    "dim_customer": lambda w: w.dim_customer,
    "dim_product": lambda w: w.dim_product,
    "dim_price_range": dim_price_range,
    "dim_stock_level": dim_stock_level,
    "dim_store": dim_store,
    "dim_channel": dim_channel,
    "price_band_join": price_band_join,
    "stock_level_join": stock_level_join,
    "markdown_effectiveness": markdown_effectiveness,
    "season_months": season_months,
    "discount_type_map": discount_type_map,
    "rating_bands": rating_bands,
    "feedback_bands": feedback_bands,
    "fact_sales": lambda w: w.fact_sales,
    "fact_inventory": lambda w: w.fact_inventory,
    "fact_markdown_analytics": lambda w: w.fact_markdown_analytics,
    "fact_customer_feedback": lambda w: w.fact_customer_feedback,
    "fact_sales_profit": fact_sales_profit,
    "fact_markdown_uplift": fact_markdown_uplift,
    "preview_fact_sales": preview_fact_sales,
    "fact_dates": fact_dates,
    "load_row_counts": load_row_counts,
    "column_report": column_report,
    "fact_sales_numbered": fact_sales_numbered,
    "csv_scan": csv_scan,
    "csv_rejects": csv_rejects,
}


def queries() -> dict[str, Query]:
    def over_folder(plan: Callable[[Workspace], DataFrame]) -> Query:
        return lambda spark, folder: plan(workspace(spark, folder, AS_OF))

    return {name: over_folder(plan) for name, plan in _PLANS.items()}
