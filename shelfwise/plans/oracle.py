"""The queries in SQL for another engine, written apart from the Spark plans.

Dialect: DuckDB. Rounding of DOUBLEs goes through their decimal digits
(``half_up``), as that is how Spark rounds them.
"""

from __future__ import annotations

BASE = """
retail_base AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
    p_type AS category, p_brand AS brand, concat('P', CAST(l_partkey AS VARCHAR)) AS product_id,
    CASE WHEN month(o_orderdate) BETWEEN 3 AND 6 THEN 'Summer'
         WHEN month(o_orderdate) BETWEEN 7 AND 9 THEN 'Monsoon'
         WHEN month(o_orderdate) BETWEEN 10 AND 12 THEN 'Festive' ELSE 'Winter' END AS season,
    CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(10,2)) AS original_price,
    CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_tax AS DECIMAL(4,2)) AS tax,
    CAST(l_quantity AS INT) AS qty, CAST((p_size - 1) * 6 AS INT) AS stock_level,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL
         ELSE CAST(1 + (l_orderkey % 81) * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(3,2)) END AS customer_ratings,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Clearance' WHEN o_orderpriority = '2-HIGH' THEN 'Bulk'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'Loyal'
         WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'Combo Offer'
         WHEN o_orderpriority = '5-LOW' THEN 'Flat Discount' END AS promotion_type,
    CAST(CAST(0.80 AS DECIMAL(4,2)) + month(o_orderdate) * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS seasonality_factor
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
)"""

RETAIL_A = """
retail_a AS (
  SELECT product_id, category, brand, season, original_price,
    CAST(original_price * CAST(80 + (l_orderkey * 3 + l_suppkey) % 41 AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS competitor_price,
    CAST(disc * 100 AS DECIMAL(10,2)) AS markdown_1, CAST(disc * 200 AS DECIMAL(10,2)) AS markdown_2,
    CAST(disc * 300 AS DECIMAL(10,2)) AS markdown_3, CAST(disc * 400 AS DECIMAL(10,2)) AS markdown_4,
    qty AS historical_sales,
    CAST(qty + l_orderkey % 3 - 1 AS INT) AS sales_after_m1, CAST(qty + l_suppkey % 5 - 2 AS INT) AS sales_after_m2,
    CAST(qty + l_linenumber % 4 - 1 AS INT) AS sales_after_m3, CAST(qty + l_partkey % 7 - 3 AS INT) AS sales_after_m4,
    CAST(tax * 100 AS DECIMAL(10,2)) AS optimal_discount, stock_level, customer_ratings, promotion_type, seasonality_factor,
    CAST((l_suppkey % 20) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS return_rate,
    CAST((l_orderkey * 7 + l_linenumber) % 45 AS INT) AS days_in_stock, CAST(l_partkey % 101 AS INT) AS trend_score,
    CAST(original_price * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(12,4)) AS unit_cost
  FROM retail_base WHERE l_partkey % 2 = 0
)"""

PRICED = """
priced_lines AS (
  SELECT product_id, category, season, original_price,
    CAST(original_price * CAST(80 + (l_orderkey * 3 + l_suppkey) % 41 AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS competitor_price,
    qty AS historical_sales, stock_level, customer_ratings, promotion_type, seasonality_factor,
    CAST((l_orderkey * 7 + l_linenumber) % 45 AS INT) AS days_in_stock, CAST(l_partkey % 101 AS INT) AS trend_score,
    CAST(original_price * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(12,4)) AS unit_cost
  FROM retail_base
)"""

RETAIL_B = """
retail_b AS (
  SELECT product_id, category, brand, season, original_price,
    CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE CAST(original_price * (1 - disc) AS DECIMAL(10,2)) END AS current_price,
    CAST(disc * 300 AS DECIMAL(10,2)) AS markdown_percentage, stock_level AS stock_quantity, customer_ratings AS customer_rating,
    CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END AS is_returned,
    CASE WHEN l_returnflag = 'R' THEN CASE l_linenumber % 3 WHEN 0 THEN 'Size Issue' WHEN 1 THEN 'Damaged' ELSE 'Changed Mind' END END AS return_reason
  FROM retail_base WHERE l_partkey % 2 = 1
)"""

SALES = """
sales AS (
  SELECT product_id, category, brand, season, original_price, CAST(NULL AS DECIMAL(10,2)) AS current_price,
    markdown_1 AS markdown_percentage, historical_sales, sales_after_m1 AS sales_after_markdown,
    optimal_discount, stock_level, customer_ratings
  FROM retail_a
  UNION ALL
  SELECT product_id, category, brand, season, original_price, current_price, markdown_percentage,
    0, 1, markdown_percentage, stock_quantity, customer_rating
  FROM retail_b
)"""

INVENTORY = """
inventory AS (
  SELECT product_id, category, brand, season, stock_level AS stock_quantity, original_price FROM retail_a
  UNION ALL
  SELECT product_id, category, brand, season, stock_quantity, original_price FROM retail_b
)"""

DIM_CATEGORY = """
dim_category AS (
  SELECT row_number() OVER (ORDER BY category NULLS FIRST) AS category_key, category AS category_name,
    CAST(NULL AS VARCHAR) AS parent_category, CAST(NULL AS VARCHAR) AS sub_category
  FROM (SELECT category FROM retail_a UNION SELECT category FROM retail_b)
)"""

DIM_BRAND = """
dim_brand AS (
  SELECT row_number() OVER (ORDER BY brand NULLS FIRST) AS brand_key, brand AS brand_name,
    CAST(NULL AS VARCHAR) AS brand_type, CAST(NULL AS VARCHAR) AS country
  FROM (SELECT brand FROM retail_a UNION SELECT brand FROM retail_b)
)"""

DIM_SEASON = """
dim_season AS (
  SELECT row_number() OVER (ORDER BY season NULLS FIRST) AS season_key, season AS season_name,
    CASE lower(season) WHEN 'summer' THEN 3 WHEN 'monsoon' THEN 7 WHEN 'winter' THEN 10 WHEN 'festive' THEN 10 END AS start_month,
    CASE lower(season) WHEN 'summer' THEN 6 WHEN 'monsoon' THEN 9 WHEN 'winter' THEN 2 WHEN 'festive' THEN 12 END AS end_month
  FROM (SELECT season FROM retail_a UNION SELECT season FROM retail_b)
)"""

DIM_MARKDOWN = """
dim_markdown AS (
  SELECT row_number() OVER (ORDER BY pct NULLS FIRST) AS markdown_key, pct AS markdown_percentage,
    CASE WHEN pct <= 10 THEN 'Low Discount' WHEN pct <= 30 THEN 'Medium Discount' ELSE 'High Discount' END AS markdown_type,
    'Dynamic Pricing Strategy' AS markdown_reason,
    CASE WHEN pct <= 10 THEN 'Profit Optimization' WHEN pct <= 30 THEN 'Sales Boost' ELSE 'Inventory Clearance' END AS markdown_strategy
  FROM (
    SELECT markdown_1 AS pct FROM retail_a UNION SELECT markdown_2 FROM retail_a
    UNION SELECT markdown_3 FROM retail_a UNION SELECT markdown_4 FROM retail_a
    UNION SELECT markdown_percentage FROM retail_b)
)"""

DIM_RATING = """
dim_customer_rating AS (
  SELECT row_number() OVER (ORDER BY rating) AS customer_rating_key, rating AS customer_rating,
    CASE WHEN rating <= 2 THEN 'Poor' WHEN rating <= 3 THEN 'Average' WHEN rating <= 4 THEN 'Good' ELSE 'Excellent' END AS rating_category
  FROM (SELECT customer_ratings AS rating FROM retail_a UNION SELECT customer_rating FROM retail_b)
  WHERE rating IS NOT NULL
)"""

DIM_PROMOTION = """
dim_promotion AS (
  SELECT row_number() OVER (ORDER BY promotion_type) AS promotion_key, promotion_type AS promotion_name, promotion_type,
    CASE WHEN lower(promotion_type) LIKE '%discount%' THEN 'Percentage'
         WHEN lower(promotion_type) LIKE '%clearance%' THEN 'Inventory Clearance'
         WHEN lower(promotion_type) LIKE '%combo%' THEN 'Combo Offer' ELSE 'General Promotion' END AS discount_type,
    CAST(NULL AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date
  FROM (SELECT DISTINCT promotion_type FROM retail_a WHERE promotion_type IS NOT NULL)
)"""

DIM_PRICE_RANGE = """
dim_price_range AS (
  SELECT CAST(k AS BIGINT) AS price_range_key, CAST(lo AS DECIMAL(10,2)) AS min_price,
    CAST(hi AS DECIMAL(10,2)) AS max_price, s AS price_segment
  FROM (VALUES (1, 0, 500, 'Budget'), (2, 501, 2000, 'Mid Range'), (3, 2001, 10000, 'Premium')) t(k, lo, hi, s)
)"""

DIM_STOCK_LEVEL = """
dim_stock_level AS (
  SELECT CAST(k AS BIGINT) AS stock_level_key, s AS stock_status, b AS stock_bucket, r AS reorder_flag
  FROM (VALUES (1, 'Low Stock', '0-50', 'Yes'), (2, 'Medium Stock', '51-200', 'No'), (3, 'Overstock', '201+', 'No')) t(k, s, b, r)
)"""

DIM_STORE = """
dim_store AS (
  SELECT CAST(k AS BIGINT) AS store_key, n AS store_name, t AS store_type, c AS city, s AS state, o AS country
  FROM (VALUES (1, 'Online Store', 'E-Commerce', 'Pune', 'Maharashtra', 'India'),
    (2, 'Fashion Retail Store', 'Retail', 'Mumbai', 'Maharashtra', 'India'),
    (3, 'Cosmetics Outlet', 'Retail', 'Bangalore', 'Karnataka', 'India')) v(k, n, t, c, s, o)
)"""

DIM_CHANNEL = """
dim_channel AS (
  SELECT CAST(k AS BIGINT) AS channel_key, n AS channel_name, t AS channel_type, p AS platform
  FROM (VALUES (1, 'Website', 'Online', 'Web'), (2, 'Mobile App', 'Digital', 'Android/iOS'),
    (3, 'Retail Store', 'Offline', 'Physical Store')) v(k, n, t, p)
)"""

DIM_DATE = """
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date, CAST(day(d) AS INT) AS day,
    CAST(month(d) AS INT) AS month, strftime(d, '%B') AS month_name, CAST(quarter(d) AS INT) AS quarter,
    CAST(year(d) AS INT) AS year, CAST(weekofyear(d) AS INT) AS week_of_year, strftime(d, '%A') AS day_of_week,
    CASE WHEN dayofweek(d) + 1 IN (1, 7) THEN 'Yes' ELSE 'No' END AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS d
    FROM (SELECT min(CAST(o_orderdate AS DATE)) AS first, max(CAST(o_orderdate AS DATE)) AS last FROM orders))
)"""

STAR_DATE = """
star_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, year(d) AS year, month(d) AS month FROM (
    SELECT unnest(generate_series(least(min(CAST(o_orderdate AS DATE)), DATE '2025-01-01'),
      greatest(max(CAST(o_orderdate AS DATE)), DATE '2025-06-30'), INTERVAL 1 DAY)) AS d FROM orders)
)"""

DIM_CUSTOMER = """
dim_customer AS (
  SELECT c_custkey AS customer_key, concat('CUST', CAST(c_custkey AS VARCHAR)) AS customer_id, c_name AS customer_name,
    CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS age_group, CAST(NULL AS VARCHAR) AS city,
    n_name AS state, r_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

DIM_PRODUCT = """
dim_product AS (
  SELECT product_key, product_id, product_name, category_key, brand_key, CAST(1 AS BIGINT) AS season_key,
    CAST(CASE WHEN price <= 500 THEN 1 WHEN price <= 2000 THEN 2 ELSE 3 END AS BIGINT) AS price_range_key,
    CAST(NULL AS VARCHAR) AS supplier_name, CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS color,
    CAST(NULL AS VARCHAR) AS size, CAST(NULL AS VARCHAR) AS fabric_material, CAST(NULL AS VARCHAR) AS cosmetic_type,
    CAST(NULL AS VARCHAR) AS skin_type, CAST(NULL AS DATE) AS expiry_date, CAST(NULL AS INT) AS shelf_life_days,
    price AS base_price, CAST(price * CAST(0.60 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS cost_price,
    TIMESTAMP '2025-06-30 00:00:00' AS created_date
  FROM (
    SELECT row_number() OVER (ORDER BY product_id, product_name, category, brand, price) AS product_key, *
    FROM (
      SELECT concat('P', CAST(p_partkey AS VARCHAR)) AS product_id, p_name AS product_name, p_type AS category,
        p_brand AS brand, CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part WHERE p_partkey % 2 = 0
      UNION
      SELECT concat('P', CAST(p_partkey AS VARCHAR)), p_name, p_type, p_brand, CAST(p_retailprice AS DECIMAL(10,2))
        FROM part WHERE p_partkey % 2 = 1)
  ) LEFT JOIN dim_category ON category = category_name LEFT JOIN dim_brand ON brand = brand_name
)"""

STOCK_CASE = """CASE WHEN {q} <= 50 THEN 'Low Stock' WHEN {q} <= 200 THEN 'Medium Stock' ELSE 'Overstock' END"""

STAMP = """CAST(20250630 AS BIGINT) AS date_key, TIMESTAMP '2025-06-30 00:00:00' AS created_timestamp"""

FACT_SALES = f"""
fact_sales AS (
  SELECT CAST(NULL AS BIGINT) AS product_key, category_key, brand_key, season_key, markdown_key, customer_rating_key,
    price_range_key, stock_level_key, CAST(1 AS BIGINT) AS promotion_key, CAST(1 AS BIGINT) AS store_key,
    CAST(1 AS BIGINT) AS channel_key, original_price, COALESCE(current_price, original_price) AS current_price,
    s.markdown_percentage, historical_sales, sales_after_markdown,
    CAST(COALESCE(current_price, original_price) * sales_after_markdown AS DECIMAL(12,2)) AS revenue,
    optimal_discount, {STAMP}
  FROM sales s
  LEFT JOIN dim_category ON category = category_name
  LEFT JOIN dim_brand ON brand = brand_name
  LEFT JOIN dim_season ON season = season_name
  LEFT JOIN dim_customer_rating r ON s.customer_ratings = r.customer_rating
  LEFT JOIN dim_markdown m ON s.markdown_percentage = m.markdown_percentage
  LEFT JOIN dim_price_range ON original_price BETWEEN min_price AND max_price
  LEFT JOIN dim_stock_level ON {STOCK_CASE.format(q='stock_level')} = stock_status
)"""

FACT_INVENTORY = f"""
fact_inventory AS (
  SELECT CAST(NULL AS BIGINT) AS product_key, category_key, brand_key, season_key, stock_level_key,
    CAST(1 AS BIGINT) AS store_key, stock_quantity, {STOCK_CASE.format(q='stock_quantity')} AS stock_status,
    CASE WHEN stock_quantity <= 50 THEN 'Yes' ELSE 'No' END AS reorder_required,
    CAST(stock_quantity * original_price AS DECIMAL(12,2)) AS inventory_value, {STAMP}
  FROM inventory i
  LEFT JOIN dim_category ON category = category_name
  LEFT JOIN dim_brand ON brand = brand_name
  LEFT JOIN dim_season ON season = season_name
  LEFT JOIN dim_stock_level d ON {STOCK_CASE.format(q='stock_quantity')} = d.stock_status
)"""

FACT_MARKDOWN = f"""
fact_markdown_analytics AS (
  SELECT CAST(NULL AS BIGINT) AS product_key, category_key, brand_key, season_key, markdown_key, promotion_key,
    stock_level_key, customer_rating_key, markdown_1, markdown_2, markdown_3, markdown_4, optimal_discount,
    historical_sales, sales_after_m1, sales_after_m2, sales_after_m3, sales_after_m4, seasonality_factor, return_rate,
    CASE WHEN sales_after_m4 > historical_sales THEN 'High Impact'
         WHEN sales_after_m2 > historical_sales THEN 'Moderate Impact' ELSE 'Low Impact' END AS markdown_effectiveness,
    {STAMP}
  FROM retail_a a
  LEFT JOIN dim_category ON category = category_name
  LEFT JOIN dim_brand ON brand = brand_name
  LEFT JOIN dim_season ON season = season_name
  LEFT JOIN dim_markdown ON markdown_1 = markdown_percentage
  LEFT JOIN dim_promotion p ON a.promotion_type = p.promotion_type
  LEFT JOIN dim_stock_level ON {STOCK_CASE.format(q='stock_level')} = stock_status
  LEFT JOIN dim_customer_rating ON customer_ratings = customer_rating
)"""

FACT_FEEDBACK = f"""
fact_customer_feedback AS (
  SELECT CAST(NULL AS BIGINT) AS product_key, category_key, brand_key, customer_rating_key, markdown_key,
    b.customer_rating, is_returned, return_reason,
    CASE WHEN b.customer_rating <= 2 THEN 'Negative Feedback' WHEN b.customer_rating <= 4 THEN 'Neutral Feedback'
         ELSE 'Positive Feedback' END AS feedback_category, {STAMP}
  FROM retail_b b
  LEFT JOIN dim_category ON category = category_name
  LEFT JOIN dim_brand ON brand = brand_name
  LEFT JOIN dim_customer_rating r ON b.customer_rating = r.customer_rating
  LEFT JOIN dim_markdown m ON b.markdown_percentage = m.markdown_percentage
)"""

# --- priority rules

# Conditions and discounts, in the order of their priority.
PRIORITY_CASE = """CASE WHEN stock_level > 100 AND customer_ratings < 3.0 THEN 60 WHEN our > competitor_price THEN 15
    WHEN seasonality_factor < 1.0 THEN 20 WHEN promotion_type = 'Bulk' THEN 10 WHEN customer_ratings < 3.0 THEN 25
    WHEN customer_ratings >= 4.5 THEN 0 WHEN promotion_type = 'Loyal' THEN 5 ELSE 0 END"""


def _priority(our: str) -> str:
    return f"""
discounted AS (SELECT *, CAST({PRIORITY_CASE} AS DECIMAL(8,4)) AS pct FROM (SELECT *, {our} AS our FROM priced_lines)),
marked AS (SELECT *, CAST(our * pct * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS amount FROM discounted)"""


OWN = _priority("original_price")
FALLBACK_PRICE = "CAST(competitor_price * CAST(1.05 AS DECIMAL(3,2)) AS DECIMAL(14,4))"
FALLBACK = _priority(FALLBACK_PRICE)
PRIORITY_VIEW = """SELECT our AS "Our_Price", competitor_price AS "Competitor_Price", stock_level AS "Stock_Level",
  seasonality_factor AS "Seasonality_Factor", customer_ratings AS "Customer_Ratings", pct AS "Optimal_Discount_Pct",
  CAST(our - amount AS DECIMAL(14,2)) AS "Final_Marked_Down_Price" FROM marked"""

# --- banded rules


def half_up(x: str, to: str) -> str:
    """A DOUBLE rounded half up on its decimal digits."""
    return f"CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)) AS {to})"


def _ratio(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0) * 100)"


RATES = f"""{half_up(_ratio('historical_sales', 'stock_level'), 'DECIMAL(14,2)')} AS sell_through_rate,
    {half_up(_ratio('original_price - competitor_price', 'original_price'), 'DECIMAL(14,2)')} AS competitor_gap_pct"""

MEASURED = f"""
signals AS (
  SELECT product_id, category, upper(season) AS season, original_price, historical_sales AS units, unit_cost,
    CAST(days_in_stock AS DOUBLE) AS days_in_stock, customer_ratings AS product_rating, trend_score, {RATES}
  FROM priced_lines
)"""

ASSUMED = f"""
signals AS (
  SELECT product_id, category, upper(season) AS season, original_price, historical_sales AS units,
    CAST(original_price * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(12,4)) AS unit_cost, CAST(15 AS DOUBLE) AS days_in_stock,
    customer_ratings AS product_rating, CAST(50 AS DOUBLE) AS trend_score, {RATES}
  FROM priced_lines
)"""

# Multipliers of the bands.
MULTIPLIERS = {
    "expiry": """CASE WHEN days_in_stock BETWEEN 0 AND 2 THEN 0.40 WHEN days_in_stock BETWEEN 3 AND 7 THEN 0.55
      WHEN days_in_stock BETWEEN 8 AND 14 THEN 0.75 WHEN days_in_stock BETWEEN 15 AND 21 THEN 0.80
      WHEN days_in_stock BETWEEN 22 AND 30 THEN 0.90 ELSE 1.00 END""",
    "sales_velocity": """CASE WHEN sell_through_rate < 20 THEN 0.65 WHEN sell_through_rate BETWEEN 20 AND 40 THEN 0.80
      WHEN sell_through_rate BETWEEN 40 AND 70 THEN 0.90 ELSE 1.00 END""",
    "seasonal": """CASE season WHEN 'SUMMER' THEN 1.05 WHEN 'WINTER' THEN 1.05 WHEN 'OFF' THEN 0.80
      WHEN 'FESTIVAL' THEN 1.08 WHEN 'TRANSITIONAL' THEN 0.93 ELSE 1.00 END""",
    "competitor": """CASE WHEN competitor_gap_pct < -10 THEN 1.05 WHEN competitor_gap_pct BETWEEN -5 AND 5 THEN 1.00
      WHEN competitor_gap_pct BETWEEN 5 AND 15 THEN 0.93 WHEN competitor_gap_pct > 15 THEN 0.82 ELSE 1.00 END""",
    "product_rating": """CASE WHEN product_rating < 3.5 THEN 0.82 WHEN product_rating BETWEEN 3.5 AND 4.4 THEN 0.93
      ELSE 1.00 END""",
    "trending": """CASE WHEN trend_score < 20 THEN 0.80 WHEN trend_score BETWEEN 20 AND 50 THEN 0.90
      WHEN trend_score BETWEEN 50 AND 80 THEN 1.00 WHEN trend_score > 80 THEN 1.10 ELSE 1.00 END""",
}


def _recommended(rules: list[str]) -> str:
    prices = ",\n    ".join(
        f"CAST(original_price * CAST({MULTIPLIERS[r]} AS DECIMAL(3,2)) AS DECIMAL(18,6)) AS price_{r}"
        for r in rules
    )
    raw = f"least({', '.join('price_' + r for r in rules)})" if rules else "CAST(original_price AS DECIMAL(18,6))"
    reason = "CASE " + " ".join(f"WHEN price_{r} = raw THEN '{r.upper()}'" for r in rules) + " ELSE 'FLOOR_GUARDRAIL' END"
    return f"""
priced AS (SELECT *{', ' + prices if rules else ''} FROM signals),
bounded AS (SELECT *, {raw} AS raw, CAST(unit_cost * CAST(1.05 AS DECIMAL(3,2)) AS DECIMAL(18,6)) AS floor_price FROM priced),
recommended AS (
  SELECT *, greatest(raw, floor_price) AS recommended_price, {reason if rules else "'NO_RULE'"} AS markdown_reason FROM bounded
)"""


ALL_RULES = ["expiry", "sales_velocity", "seasonal", "competitor", "product_rating", "trending"]
PCT_APPLIED = half_up(_ratio("original_price - recommended_price", "original_price"), "DECIMAL(18,1)")


def _banded_view(rules: list[str]) -> str:
    prices = "".join(f", price_{r}" for r in rules)
    return f"""SELECT product_id, category, original_price, recommended_price, {PCT_APPLIED} AS discount_pct_applied,
  markdown_reason, raw AS raw_recommended_price, floor_price, floor_price > raw AS floor_bound{prices} FROM recommended"""


# Fixed values, in evaluation order: (rule, id, trigger, place, operator, min, max, text, multiplier, discount)
BANDS = """
bands(rule_name, rule_id, trigger_column, evaluation_order, condition_operator, condition_min, condition_max,
    condition_str_value, price_multiplier, discount_pct) AS (VALUES
  ('EXPIRY', 1, 'days_in_stock', 1, 'BETWEEN', 0, 2, NULL, 0.40, 60),
  ('EXPIRY', 1, 'days_in_stock', 2, 'BETWEEN', 3, 7, NULL, 0.55, 45),
  ('EXPIRY', 1, 'days_in_stock', 3, 'BETWEEN', 8, 14, NULL, 0.75, 25),
  ('EXPIRY', 1, 'days_in_stock', 4, 'BETWEEN', 15, 21, NULL, 0.80, 20),
  ('EXPIRY', 1, 'days_in_stock', 5, 'BETWEEN', 22, 30, NULL, 0.90, 10),
  ('SALES_VELOCITY', 2, 'sell_through_rate', 1, '<', 0, 20, NULL, 0.65, 35),
  ('SALES_VELOCITY', 2, 'sell_through_rate', 2, 'BETWEEN', 20, 40, NULL, 0.80, 20),
  ('SALES_VELOCITY', 2, 'sell_through_rate', 3, 'BETWEEN', 40, 70, NULL, 0.90, 10),
  ('SALES_VELOCITY', 2, 'sell_through_rate', 4, '>', 70, -1, NULL, 1.00, 0),
  ('SEASONAL', 3, 'Season', 1, '=', NULL, NULL, 'FESTIVAL', 1.08, -8),
  ('SEASONAL', 3, 'Season', 2, '=', NULL, NULL, 'OFF', 0.80, 20),
  ('SEASONAL', 3, 'Season', 3, '=', NULL, NULL, 'SUMMER', 1.05, -5),
  ('SEASONAL', 3, 'Season', 4, '=', NULL, NULL, 'TRANSITIONAL', 0.93, 7),
  ('SEASONAL', 3, 'Season', 5, '=', NULL, NULL, 'WINTER', 1.05, -5),
  ('COMPETITOR', 4, 'competitor_gap_pct', 1, '<', -100, -10, NULL, 1.05, -5),
  ('COMPETITOR', 4, 'competitor_gap_pct', 2, 'BETWEEN', -5, 5, NULL, 1.00, 0),
  ('COMPETITOR', 4, 'competitor_gap_pct', 3, 'BETWEEN', 5, 15, NULL, 0.93, 7),
  ('COMPETITOR', 4, 'competitor_gap_pct', 4, '>', 15, -1, NULL, 0.82, 18),
  ('PRODUCT_RATING', 5, 'product_rating', 1, '<', 0, 3.5, NULL, 0.82, 18),
  ('PRODUCT_RATING', 5, 'product_rating', 2, 'BETWEEN', 3.5, 4.4, NULL, 0.93, 7),
  ('PRODUCT_RATING', 5, 'product_rating', 3, '>=', 4.5, -1, NULL, 1.00, 0),
  ('TRENDING', 6, 'trend_score', 1, '<', 0, 20, NULL, 0.80, 20),
  ('TRENDING', 6, 'trend_score', 2, 'BETWEEN', 20, 50, NULL, 0.90, 10),
  ('TRENDING', 6, 'trend_score', 3, 'BETWEEN', 50, 80, NULL, 1.00, 0),
  ('TRENDING', 6, 'trend_score', 4, '>', 80, -1, NULL, 1.10, -10)
),
hits(rule_name, evaluation_order) AS (
  SELECT 'EXPIRY', CASE WHEN days_in_stock BETWEEN 0 AND 2 THEN 1 WHEN days_in_stock BETWEEN 3 AND 7 THEN 2
    WHEN days_in_stock BETWEEN 8 AND 14 THEN 3 WHEN days_in_stock BETWEEN 15 AND 21 THEN 4
    WHEN days_in_stock BETWEEN 22 AND 30 THEN 5 END FROM signals
  UNION ALL SELECT 'SALES_VELOCITY', CASE WHEN sell_through_rate < 20 THEN 1 WHEN sell_through_rate BETWEEN 20 AND 40 THEN 2
    WHEN sell_through_rate BETWEEN 40 AND 70 THEN 3 WHEN sell_through_rate > 70 THEN 4 END FROM signals
  UNION ALL SELECT 'SEASONAL', CASE season WHEN 'FESTIVAL' THEN 1 WHEN 'OFF' THEN 2 WHEN 'SUMMER' THEN 3
    WHEN 'TRANSITIONAL' THEN 4 WHEN 'WINTER' THEN 5 END FROM signals
  UNION ALL SELECT 'COMPETITOR', CASE WHEN competitor_gap_pct < -10 THEN 1 WHEN competitor_gap_pct BETWEEN -5 AND 5 THEN 2
    WHEN competitor_gap_pct BETWEEN 5 AND 15 THEN 3 WHEN competitor_gap_pct > 15 THEN 4 END FROM signals
  UNION ALL SELECT 'PRODUCT_RATING', CASE WHEN product_rating < 3.5 THEN 1 WHEN product_rating BETWEEN 3.5 AND 4.4 THEN 2
    WHEN product_rating >= 4.5 THEN 3 END FROM signals
  UNION ALL SELECT 'TRENDING', CASE WHEN trend_score < 20 THEN 1 WHEN trend_score BETWEEN 20 AND 50 THEN 2
    WHEN trend_score BETWEEN 50 AND 80 THEN 3 WHEN trend_score > 80 THEN 4 END FROM signals
),
usage AS (
  SELECT b.*, (SELECT count(*) FROM hits h WHERE h.rule_name = b.rule_name AND h.evaluation_order = b.evaluation_order) AS priced_rows
  FROM bands b
)"""

TRENDS = """
trends(trend_id, trend_product, trend_type, trend_score, trend_direction, trend_source) AS (VALUES
  (1, 'P101', 'HIGH_TREND', CAST(90 AS DOUBLE), 'UP', 'SOCIAL_MEDIA'),
  (2, 'P102', 'LOW_TREND', CAST(20 AS DOUBLE), 'DOWN', 'SALES_PATTERN'),
  (3, 'P103', 'SEASONAL_TREND', CAST(75 AS DOUBLE), 'UP', 'FESTIVAL'))"""


def _with(select: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


RAW = (BASE, RETAIL_A, RETAIL_B)
DIMS = (
    DIM_CATEGORY, DIM_BRAND, DIM_SEASON, DIM_MARKDOWN, DIM_RATING, DIM_PROMOTION,
    DIM_PRICE_RANGE, DIM_STOCK_LEVEL,
)
STAR = (*RAW, SALES, INVENTORY, *DIMS, FACT_SALES)


def _usage_of(dim: str, key: str, cte: str = "") -> str:
    extra = (cte,) if cte else ()
    return _with(
        f"""SELECT d.*, (SELECT count(*) FROM fact_sales f WHERE f.{key} = d.{key}) AS fact_rows FROM {dim} d""",
        *STAR,
        *extra,
    )


def _profile(table: str, columns: str) -> str:
    """Place, name, type in Spark's words, and number of values of each column."""
    names = columns.split()
    kind = "CASE any_value(typeof({0})) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(any_value(typeof({0}))) END"
    return f"""SELECT '{table}' AS table_name, unnest({list(range(1, len(names) + 1))}) AS position, unnest({names}) AS column_name,
  unnest([{', '.join(kind.format(n) for n in names)}]) AS data_type, unnest([{', '.join(f'count({n})' for n in names)}]) AS value_count
FROM {table}"""


A_COLUMNS = """product_id category brand season original_price stock_level customer_ratings competitor_price markdown_1 markdown_2
  markdown_3 markdown_4 historical_sales sales_after_m1 sales_after_m2 sales_after_m3 sales_after_m4 optimal_discount promotion_type
  seasonality_factor return_rate days_in_stock trend_score unit_cost"""
B_COLUMNS = """product_id category brand season original_price stock_quantity customer_rating current_price markdown_percentage
  is_returned return_reason"""
SALES_ORDER = """product_key, category_key, brand_key, season_key, markdown_key, customer_rating_key, price_range_key, stock_level_key,
  promotion_key, store_key, channel_key, date_key, original_price, current_price, markdown_percentage, historical_sales,
  sales_after_markdown, revenue, optimal_discount, created_timestamp"""
BROKEN = "CAST(substr(product_id, 2) AS BIGINT) % 97 = 0"


def _banded(rules: list[str], signals: str = MEASURED) -> str:
    return _with(_banded_view(rules), BASE, PRICED, signals, _recommended(rules))


_COUNTED = (
    "retail_a", "retail_b", "dim_category", "dim_brand", "dim_season", "dim_markdown", "dim_price_range",
    "dim_stock_level", "dim_customer_rating", "dim_promotion", "dim_store", "dim_channel", "dim_date",
    "dim_customer", "dim_product", "fact_sales", "fact_inventory", "fact_markdown_analytics",
    "fact_customer_feedback",
)


def oracle_sql() -> dict[str, str]:
    return {
        "priority_rules_own_price": _with(PRIORITY_VIEW, BASE, PRICED, OWN),
        "priority_rules_fallback": _with(PRIORITY_VIEW, BASE, PRICED, FALLBACK),
        "priority_rules_unquoted": _with(PRIORITY_VIEW, BASE, PRICED, OWN),
        "price_baseline": _with(
            f'SELECT product_id AS "Product_ID", competitor_price AS "Competitor_Price", {FALLBACK_PRICE} AS "Our_Price" FROM priced_lines',
            BASE, PRICED,
        ),
        "markdown_amounts": _with(
            """SELECT product_id AS "Product_ID", our AS "Our_Price", pct AS "Optimal_Discount_Pct", amount AS "Markdown_Amount",
  CAST(our - amount AS DECIMAL(14,2)) AS "Final_Marked_Down_Price" FROM marked""",
            BASE, PRICED, OWN,
        ),
        "conformed_sales": _with("SELECT * FROM sales", *RAW, SALES),
        "conformed_inventory": _with("SELECT * FROM inventory", *RAW, INVENTORY),
        "normalized_columns": _with("SELECT * FROM retail_b", BASE, RETAIL_B),
        "normalized_columns_a": _with("SELECT * FROM retail_a", BASE, RETAIL_A),
        "renamed_columns": _with(
            """SELECT product_id AS "Product_Id", category AS "Category", brand AS "Brand", season AS "Season",
  original_price AS "Original_Price", competitor_price AS "Competitor_Price", markdown_1 AS "Markdown_1", markdown_2 AS "Markdown_2",
  markdown_3 AS "Markdown_3", markdown_4 AS "Markdown_4", historical_sales AS "Historical_Sales", sales_after_m1 AS "Sales_After_M1",
  sales_after_m2 AS "Sales_After_M2", sales_after_m3 AS "Sales_After_M3", sales_after_m4 AS "Sales_After_M4",
  optimal_discount AS "Optimal_Discount", stock_level AS "Stock_Level", customer_ratings AS "Customer_Ratings",
  promotion_type AS "Promotion_Type", seasonality_factor AS "Seasonality_Factor", return_rate AS "Return_Rate",
  days_in_stock AS "Days_In_Stock", trend_score AS "Trend_Score", unit_cost AS "Unit_Cost" FROM retail_a""",
            BASE, RETAIL_A,
        ),
        "rules_selected": _with(
            """SELECT rule_id, rule_name, trigger_column, condition_operator, CAST(condition_min AS DOUBLE) AS condition_min,
  CAST(condition_max AS DOUBLE) AS condition_max, condition_str_value, CAST(price_multiplier AS DOUBLE) AS price_multiplier,
  CAST(discount_pct AS DOUBLE) AS discount_pct, evaluation_order, priced_rows
FROM usage WHERE rule_name IN ('EXPIRY', 'SEASONAL', 'TRENDING')
ORDER BY rule_id, condition_min NULLS FIRST, condition_max NULLS FIRST, condition_str_value NULLS FIRST""",
            BASE, PRICED, MEASURED, BANDS,
        ),
        "rules_grouped": _with(
            """SELECT rule_id, rule_name, count(*) AS bands,
  string_agg(concat_ws(' ', condition_operator, coalesce(CAST(CAST(condition_min AS DECIMAL(10,2)) AS VARCHAR), '-'),
    coalesce(CAST(CAST(condition_max AS DECIMAL(10,2)) AS VARCHAR), '-'), coalesce(condition_str_value, '-'),
    CAST(CAST(price_multiplier AS DECIMAL(10,2)) AS VARCHAR)), '; ' ORDER BY evaluation_order) AS conditions,
  CAST(sum(priced_rows) AS BIGINT) AS priced_rows
FROM usage GROUP BY rule_id, rule_name""",
            BASE, PRICED, MEASURED, BANDS,
        ),
        "pricing_signals": _with(
            "SELECT product_id, sell_through_rate, competitor_gap_pct, days_in_stock, product_rating, trend_score, unit_cost FROM signals",
            BASE, PRICED, MEASURED,
        ),
        "pricing_signals_assumed": _with(
            "SELECT product_id, sell_through_rate, competitor_gap_pct, days_in_stock, product_rating, trend_score, unit_cost FROM signals",
            BASE, PRICED, ASSUMED,
        ),
        "banded_rule_prices": _with(
            "SELECT product_id, category, original_price, " + ", ".join(f"price_{r}" for r in ALL_RULES) + " FROM recommended",
            BASE, PRICED, MEASURED, _recommended(ALL_RULES),
        ),
        "banded_rules_subset": _banded(["seasonal", "competitor"]),
        "banded_single_rule": _banded(["expiry"]),
        "banded_no_rule": _banded([]),
        "banded_recommendation": _banded(ALL_RULES),
        "banded_recommendation_assumed": _banded(ALL_RULES, ASSUMED),
        "pricing_kpis": _with(
            f"""SELECT product_id, original_price, recommended_price, units AS units_sold, {PCT_APPLIED} AS discount_pct_applied,
  gross_amount, net_amount, CAST(gross_amount - net_amount AS DECIMAL(20,2)) AS discount_amount
FROM (SELECT *, CAST(original_price * units AS DECIMAL(20,2)) AS gross_amount,
  CAST(recommended_price * units AS DECIMAL(20,2)) AS net_amount FROM recommended)""",
            BASE, PRICED, MEASURED, _recommended(ALL_RULES),
        ),
        "product_trends": _with(
            """SELECT product_id, original_price, trend_id, trend_type, trend_score, trend_direction, trend_source,
  CASE WHEN trend_id IS NOT NULL THEN DATE '2025-06-30' END AS trend_date
FROM sales LEFT JOIN trends ON product_id = trend_product""",
            *RAW, SALES, TRENDS,
        ),
        "dim_category": _with("SELECT * FROM dim_category", *RAW, DIM_CATEGORY),
        "dim_brand": _with("SELECT * FROM dim_brand", *RAW, DIM_BRAND),
        "dim_season": _with("SELECT * FROM dim_season", *RAW, DIM_SEASON),
        "dim_markdown": _with("SELECT * FROM dim_markdown", *RAW, DIM_MARKDOWN),
        "dim_customer_rating": _with("SELECT * FROM dim_customer_rating", *RAW, DIM_RATING),
        "dim_promotion": _with("SELECT * FROM dim_promotion", BASE, RETAIL_A, DIM_PROMOTION),
        "dim_date": _with("SELECT * FROM dim_date", DIM_DATE),
        "dim_customer": _with("SELECT * FROM dim_customer", DIM_CUSTOMER),
        "dim_product": _with("SELECT * FROM dim_product", *RAW, DIM_CATEGORY, DIM_BRAND, DIM_PRODUCT),
        "dim_price_range": _usage_of("dim_price_range", "price_range_key"),
        "dim_stock_level": _usage_of("dim_stock_level", "stock_level_key"),
        "dim_store": _usage_of("dim_store", "store_key", DIM_STORE),
        "dim_channel": _usage_of("dim_channel", "channel_key", DIM_CHANNEL),
        "price_band_join": _with(
            """SELECT product_id, original_price, price_range_key, price_segment
FROM inventory LEFT JOIN dim_price_range ON original_price BETWEEN min_price AND max_price""",
            *RAW, INVENTORY, DIM_PRICE_RANGE,
        ),
        "stock_level_join": _with(
            f"""SELECT product_id, stock_quantity, {STOCK_CASE.format(q='stock_quantity')} AS stock_status, stock_level_key
FROM inventory LEFT JOIN dim_stock_level d ON {STOCK_CASE.format(q='stock_quantity')} = d.stock_status""",
            *RAW, INVENTORY, DIM_STOCK_LEVEL,
        ),
        "markdown_effectiveness": _with(
            """SELECT product_id, historical_sales, sales_after_m2, sales_after_m4,
  CASE WHEN sales_after_m4 > historical_sales THEN 'High Impact' WHEN sales_after_m2 > historical_sales THEN 'Moderate Impact'
       ELSE 'Low Impact' END AS markdown_effectiveness FROM retail_a""",
            BASE, RETAIL_A,
        ),
        "season_months": _with(
            """SELECT product_id, season,
  CASE lower(season) WHEN 'summer' THEN 3 WHEN 'monsoon' THEN 7 WHEN 'winter' THEN 10 WHEN 'festive' THEN 10 END AS start_month,
  CASE lower(season) WHEN 'summer' THEN 6 WHEN 'monsoon' THEN 9 WHEN 'winter' THEN 2 WHEN 'festive' THEN 12 END AS end_month
FROM inventory""",
            *RAW, INVENTORY,
        ),
        "discount_type_map": _with(
            """SELECT product_id, promotion_type,
  CASE WHEN lower(promotion_type) LIKE '%discount%' THEN 'Percentage' WHEN lower(promotion_type) LIKE '%clearance%' THEN 'Inventory Clearance'
       WHEN lower(promotion_type) LIKE '%combo%' THEN 'Combo Offer' ELSE 'General Promotion' END AS discount_type FROM retail_a""",
            BASE, RETAIL_A,
        ),
        "rating_bands": _with(
            """SELECT product_id, customer_ratings, CASE WHEN customer_ratings <= 2 THEN 'Poor' WHEN customer_ratings <= 3 THEN 'Average'
  WHEN customer_ratings <= 4 THEN 'Good' ELSE 'Excellent' END AS rating_category FROM sales""",
            *RAW, SALES,
        ),
        "feedback_bands": _with(
            """SELECT product_id, customer_rating, CASE WHEN customer_rating <= 2 THEN 'Negative Feedback'
  WHEN customer_rating <= 4 THEN 'Neutral Feedback' ELSE 'Positive Feedback' END AS feedback_category FROM retail_b""",
            BASE, RETAIL_B,
        ),
        "fact_sales": _with("SELECT * FROM fact_sales", *STAR),
        "fact_inventory": _with("SELECT * FROM fact_inventory", *STAR, FACT_INVENTORY),
        "fact_markdown_analytics": _with("SELECT * FROM fact_markdown_analytics", *STAR, FACT_MARKDOWN),
        "fact_customer_feedback": _with("SELECT * FROM fact_customer_feedback", *STAR, FACT_FEEDBACK),
        "fact_sales_profit": _with(
            """SELECT CAST(20250101 AS BIGINT) AS date_key, CAST(NULL AS BIGINT) AS customer_key, product_key, CAST(1 AS BIGINT) AS store_key,
  CAST(NULL AS BIGINT) AS promotion_key, CAST(1 AS BIGINT) AS markdown_key, CAST(2 AS BIGINT) AS stock_level_key, 1 AS quantity_sold,
  base_price AS original_price, CAST(base_price * CAST(0.10 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS discount_amount,
  CAST(base_price * CAST(0.90 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS selling_price,
  CAST(base_price * CAST(0.90 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS revenue, cost_price,
  CAST(base_price * CAST(0.90 AS DECIMAL(3,2)) - cost_price AS DECIMAL(12,2)) AS profit, 'Online' AS payment_mode,
  TIMESTAMP '2025-06-30 00:00:00' AS created_timestamp FROM dim_product""",
            *RAW, DIM_CATEGORY, DIM_BRAND, DIM_PRODUCT,
        ),
        "fact_markdown_uplift": _with(
            """SELECT CAST(20250101 AS BIGINT) AS date_key, product_key, CAST(1 AS BIGINT) AS markdown_key, CAST(NULL AS BIGINT) AS promotion_key,
  CAST(base_price AS DECIMAL(12,2)) AS before_markdown_sales,
  CAST(base_price * CAST(0.90 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS after_markdown_sales,
  CAST(10 AS DECIMAL(5,2)) AS uplift_percentage, CAST(70 AS DECIMAL(5,2)) AS inventory_clearance_rate FROM dim_product""",
            *RAW, DIM_CATEGORY, DIM_BRAND, DIM_PRODUCT,
        ),
        "preview_fact_sales": _with(
            "SELECT * FROM fact_sales ORDER BY "
            + ", ".join(
                f"{c} NULLS FIRST"
                for c in (
                    "product_key", "category_key", "brand_key", "season_key", "markdown_key", "customer_rating_key",
                    "price_range_key", "stock_level_key", "promotion_key", "store_key", "channel_key", "date_key",
                    "original_price", "current_price", "markdown_percentage", "historical_sales",
                    "sales_after_markdown", "revenue", "optimal_discount", "created_timestamp",
                )
            )
            + " LIMIT 20",
            *STAR,
        ),
        "fact_dates": _with(
            """SELECT table_name, CAST(year AS INT) AS year, CAST(month AS INT) AS month, CAST(sum(n) AS BIGINT) AS fact_rows FROM (
  SELECT 'fact_sales' AS table_name, date_key, count(*) AS n FROM fact_sales GROUP BY date_key
  UNION ALL SELECT 'fact_inventory', date_key, count(*) FROM fact_inventory GROUP BY date_key
  UNION ALL SELECT 'fact_markdown_analytics', date_key, count(*) FROM fact_markdown_analytics GROUP BY date_key
  UNION ALL SELECT 'fact_customer_feedback', date_key, count(*) FROM fact_customer_feedback GROUP BY date_key
) LEFT JOIN star_date USING (date_key) GROUP BY table_name, year, month""",
            *STAR, FACT_INVENTORY, FACT_MARKDOWN, FACT_FEEDBACK, STAR_DATE,
        ),
        "banded_rules_joined": _banded(ALL_RULES),
        "column_report": _with(f"{_profile('retail_a', A_COLUMNS)} UNION ALL {_profile('retail_b', B_COLUMNS)}", *RAW),
        "fact_sales_numbered": _with(
            "SELECT row_number() OVER (ORDER BY "
            + ", ".join(f"{c.strip()} NULLS FIRST" for c in SALES_ORDER.split(","))
            + ") AS sales_key, * FROM fact_sales",
            *STAR,
        ),
        "csv_scan": _with(f"SELECT * FROM retail_b WHERE NOT ({BROKEN})", BASE, RETAIL_B),
        "csv_rejects": _with(
            "SELECT concat_ws(',', "
            + ", ".join("'n/a'" if c == "original_price" else f"coalesce(CAST({c} AS VARCHAR), '')" for c in B_COLUMNS.split())
            + f") AS record FROM retail_b WHERE {BROKEN}",
            BASE, RETAIL_B,
        ),
        "load_row_counts": _with(
            "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED),
            *STAR, DIM_STORE, DIM_CHANNEL, DIM_DATE, DIM_CUSTOMER, DIM_PRODUCT, FACT_INVENTORY, FACT_MARKDOWN, FACT_FEEDBACK,
        ),
    }
