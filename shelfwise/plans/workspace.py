"""One data set's inputs, staged lines and staged dimensions within a session."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import dims, facts
from shelfwise.sinks.staging import new_place, stage
from shelfwise.sources import retail, seeds

# Load date of the facts that queries compare: the same input always gives the same facts.
AS_OF = dt.datetime(2025, 6, 30)

FACT_DIMS = (
    "dim_category", "dim_brand", "dim_season", "dim_markdown", "dim_price_range",
    "dim_stock_level", "dim_customer_rating", "dim_promotion",
)
FACTS = ("fact_sales", "fact_inventory", "fact_markdown_analytics", "fact_customer_feedback")


class Workspace:
    """Tables of one input folder.

    The joined lines and the dimensions are staged on first use and shared by
    everything after it: the wide join and each distinct run once per session, and
    facts then only scan the lines and broadcast stored dimensions.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        as_of: dt.datetime | None = None,
        lines: DataFrame | None = None,
    ):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.as_of = as_of or dt.datetime.now().replace(microsecond=0)
        self._lines = lines

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        """Rows of both sources, stored in two parts so that each is read alone."""
        if self._lines is not None:
            return self._lines
        base = retail.retail_base(
            self.table("lineitem"), self.table("part"), self.table("orders")
        )
        return stage(retail.retail_lines(base), "retail_lines", partition_by=["source"])

    @cached_property
    def retail_priced(self) -> DataFrame:
        return retail.retail_priced(self.lines)

    @cached_property
    def retail_a(self) -> DataFrame:
        return retail.retail_a(self.lines)

    @cached_property
    def retail_b(self) -> DataFrame:
        return retail.retail_b(self.lines)

    @cached_property
    def products(self) -> DataFrame:
        return retail.products(self.table("part"))

    @cached_property
    def customers(self) -> DataFrame:
        return retail.customers(
            self.table("customer"), self.table("nation"), self.table("region")
        )

    @cached_property
    def members(self) -> DataFrame:
        """Members of all six dimensions of sales, with their keys: one pass over the lines, one table."""
        return stage(dims.number_all(dims.all_members(self.retail_a, self.retail_b)), "dim_members")

    @cached_property
    def dim_category(self) -> DataFrame:
        return dims.dimension(self.members, "dim_category")

    @cached_property
    def dim_brand(self) -> DataFrame:
        return dims.dimension(self.members, "dim_brand")

    @cached_property
    def dim_season(self) -> DataFrame:
        return dims.dimension(self.members, "dim_season")

    @cached_property
    def dim_markdown(self) -> DataFrame:
        return dims.dimension(self.members, "dim_markdown")

    @cached_property
    def dim_customer_rating(self) -> DataFrame:
        return dims.dimension(self.members, "dim_customer_rating")

    @cached_property
    def dim_promotion(self) -> DataFrame:
        return dims.dimension(self.members, "dim_promotion")

    @cached_property
    def dim_product(self) -> DataFrame:
        members = dims.product_members(self.products)
        return stage(dims.dim_product(members, self.dim_category, self.dim_brand, self.as_of), "dim_product")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.dim_customer(self.customers)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date_of(self.table("orders"), "o_orderdate")

    @cached_property
    def star_date(self) -> DataFrame:
        """Calendar of the star: the days of the orders and all days that facts carry."""
        days = (self.as_of.date(), facts.FLAT_DATE)
        return dims.dim_date_of(self.table("orders"), "o_orderdate", *days)

    @cached_property
    def dim_price_range(self) -> DataFrame:
        return seeds.dim_price_range(self.spark)

    @cached_property
    def dim_stock_level(self) -> DataFrame:
        return seeds.dim_stock_level(self.spark)

    @cached_property
    def dim_store(self) -> DataFrame:
        return seeds.dim_store(self.spark)

    @cached_property
    def dim_channel(self) -> DataFrame:
        return seeds.dim_channel(self.spark)

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        """The dimensions that facts refer to."""
        return {name: getattr(self, name) for name in FACT_DIMS}

    @cached_property
    def fact_sales(self) -> DataFrame:
        return facts.fact_sales(self.retail_a, self.retail_b, self.dims, self.as_of)

    @cached_property
    def fact_inventory(self) -> DataFrame:
        return facts.fact_inventory(self.retail_a, self.retail_b, self.dims, self.as_of)

    @cached_property
    def fact_markdown_analytics(self) -> DataFrame:
        return facts.fact_markdown_analytics(self.retail_a, self.dims, self.as_of)

    @cached_property
    def fact_customer_feedback(self) -> DataFrame:
        return facts.fact_customer_feedback(self.retail_b, self.dims, self.as_of)

    @cached_property
    def stored_facts(self) -> dict[str, DataFrame]:
        """The facts as written tables."""
        return {name: stage(getattr(self, name), name) for name in FACTS}

    @cached_property
    def csv_folder(self) -> str:
        """Source b as CSV files under headings with blanks. The price of every 97th product is no number."""
        b = self.retail_b
        broken = F.substring("product_id", 2, 30).cast("long") % 97 == 0
        text = b.withColumn("original_price", F.when(broken, "n/a").otherwise(F.col("original_price").cast("string")))
        path = new_place(self.spark, "retail_csv")
        text.toDF(*(c.replace("_", " ").title() for c in b.columns)).write.option("header", True).csv(path)
        return path


class RawWorkspace(Workspace):
    """Workspace of a caller's own raw tables, for instance from ``read_csv``.

    ``raw_a`` has four trial markdowns a row, ``raw_b`` one markdown and returns;
    ``products`` has ``dims.PRODUCT_COLUMNS``, ``customers`` customer_number, customer_name,
    state and country. The calendar runs over the default days, ``as_of`` and the flat date.
    """

    def __init__(
        self,
        raw_a: DataFrame,
        raw_b: DataFrame,
        products: DataFrame,
        customers: DataFrame,
        as_of: dt.datetime | None = None,
    ):
        super().__init__(raw_a.sparkSession, "", as_of)
        self.retail_a, self.retail_b = raw_a, raw_b
        self.products, self.customers = products, customers

    @cached_property
    def dim_date(self) -> DataFrame:
        days = (dims.FIRST_DAY, dims.LAST_DAY, self.as_of.date(), facts.FLAT_DATE)
        return dims.dim_date(self.spark, min(days), max(days))

    @cached_property
    def star_date(self) -> DataFrame:
        return self.dim_date


_open: dict[tuple[str, str, dt.datetime | None], tuple[tuple, Workspace]] = {}


def _state(spark: SparkSession, folder: str) -> tuple:
    """Name, size and time of what the folder holds; changes when a table is replaced."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(
        sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)
    )


def workspace(spark: SparkSession, folder: str, as_of: dt.datetime | None = None) -> Workspace:
    """The session's workspace of a folder; staged tables are shared through it.

    Facts carry ``as_of``, by default the time of the first call. Once a table of the
    folder was replaced, the next call starts anew from the tables as they are then.
    """
    key = (spark.conf.get("spark.app.id"), folder.rstrip("/"), as_of)
    state = _state(spark, key[1])
    if key not in _open or _open[key][0] != state:
        _open[key] = (state, Workspace(spark, folder, as_of))
    return _open[key][1]
