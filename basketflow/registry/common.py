"""What the registered queries share: the input views, the same views in SQL, output forms."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.config import Cutoffs
from basketflow.functions.bands import with_age_group
from basketflow.sources import views

# Cutoffs of the two purchase histories in the test tables.
T_CUTS = Cutoffs(date(2001, 7, 1), date(2001, 7, 15), date(2001, 7, 22))
E_CUTS = Cutoffs(date(2024, 1, 8), date(2024, 1, 15), date(2024, 1, 22))


class Inputs:
    """The retail tables of one data folder; ``t`` are order lines, ``e`` purchase events."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def articles(self) -> DataFrame:
        return views.articles(self.spark, self.sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        return views.customers(self.spark, self.sf_dir)

    @cached_property
    def segments(self) -> DataFrame:
        return with_age_group(self.customers).select("customer_id", "age_group")

    @cached_property
    def t(self) -> DataFrame:
        return views.order_transactions(self.spark, self.sf_dir)

    @cached_property
    def e(self) -> DataFrame:
        return views.event_transactions(self.spark, self.sf_dir)

    @cached_property
    def t_train(self) -> DataFrame:
        return self.t.filter(F.col("t_dat") <= F.lit(T_CUTS.train))

    @cached_property
    def e_train(self) -> DataFrame:
        return self.e.filter(F.col("t_dat") <= F.lit(E_CUTS.train))


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL twin."""

    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def r4(column: str | Column, digits: int = 4) -> Column:
    """Four decimals, because floating sums depend on their order.

    Lifted by 1e-9 first: means of prices are often exact halves of the last digit, which engines
    round differently.
    """
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value + 1e-9, digits)


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: r4(c, digits) for c in columns})


def as_text(column: str) -> Column:
    return F.concat_ws(" ", F.col(column).cast("array<string>"))


def age_case(bands: str) -> str:
    return {
        "group": """CASE WHEN age < 18 THEN 'Under 18' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34'
            WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' WHEN age >= 55 THEN '55+' ELSE 'Unknown' END""",
        "bin": """CASE WHEN age < 20 THEN '<20' WHEN age < 30 THEN '20-29' WHEN age < 40 THEN '30-39'
            WHEN age < 50 THEN '40-49' WHEN age < 60 THEN '50-59' WHEN age >= 60 THEN '60+' ELSE 'Unknown' END""",
    }[bands]


VIEWS = f"""
WITH articles AS (
  SELECT p_partkey AS article_id, p_partkey // 10 AS product_code, p_name AS prod_name,
    p_size AS product_type_no, p_type AS product_type_name,
    CASE p_partkey % 6 WHEN 0 THEN 'Garment Upper body' WHEN 1 THEN 'Garment Lower body' WHEN 2 THEN 'Shoes'
      WHEN 3 THEN 'Accessories' WHEN 4 THEN 'Underwear' END AS product_group_name,
    CASE WHEN p_size % 7 <> 0 THEN p_size END AS colour_group_code,
    split_part(p_name, ' ', 1) AS colour_group_name, p_brand AS department_name, p_type AS index_group_name,
    p_size % 5 AS section_no, 'Section ' || (p_size % 5) AS section_name,
    CASE WHEN p_partkey % 11 <> 0 THEN CAST(1000 * (p_partkey % 4 + 1) + p_size AS INTEGER) END AS garment_group_no,
    'Group ' || (p_partkey % 4) AS garment_group_name,
    CASE WHEN p_partkey % 13 <> 0 THEN p_name || ' ' || p_type END AS detail_desc
  FROM part),
customers AS (
  SELECT c_name AS customer_id,
    CASE WHEN c_custkey % 37 <> 0 THEN CAST(14 + c_custkey % 60 AS INTEGER) END AS age,
    CASE c_custkey % 3 WHEN 1 THEN 1.0::DOUBLE WHEN 2 THEN 0.0::DOUBLE END AS FN,
    CASE WHEN c_custkey % 4 = 0 THEN 1.0::DOUBLE END AS Active,
    CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'PRE-CREATE' WHEN 2 THEN 'LEFT CLUB' ELSE 'ACTIVE' END AS club_member_status,
    CASE c_custkey % 4 WHEN 0 THEN 'NONE' WHEN 1 THEN 'Regularly' WHEN 2 THEN 'Monthly' END AS fashion_news_frequency
  FROM customer),
t AS (
  SELECT CAST(o_orderdate AS DATE) AS t_dat, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS customer_id,
    l_partkey AS article_id, l_extendedprice AS price, CAST(1 + l_suppkey % 2 AS INTEGER) AS sales_channel_id,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE)) AS transaction_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
e AS (
  SELECT CAST(ts AS DATE) AS t_dat, 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS customer_id,
    CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS BIGINT) AS article_id, value AS price,
    CAST(1 + event_id % 2 AS INTEGER) AS sales_channel_id, event_id AS transaction_id
  FROM events WHERE event_type = 'purchase'),
seg AS (SELECT customer_id, {age_case("group")} AS age_group FROM customers)
"""

DEMOGRAPHICS = f"""
demographics AS (
  SELECT c.customer_id, c.age, {age_case("bin")} AS age_bin, c.club_member_status, c.fashion_news_frequency, c.Active,
    coalesce(s.n, 0) AS num_purchases, round(coalesce(s.spent, 0) + 1e-9, 4) AS total_spent, coalesce(s.items, 0) AS unique_items,
    s.last_purchase_date, s.first_purchase_date
  FROM customers c LEFT JOIN (
    SELECT customer_id, count(*) AS n, sum(price) AS spent, count(DISTINCT article_id) AS items,
      max(t_dat) AS last_purchase_date, min(t_dat) AS first_purchase_date
    FROM t GROUP BY 1) s USING (customer_id))
"""

SALES = """
sales AS (
  SELECT article_id, count(*) AS num_transactions, round(sum(price) + 1e-9, 4) AS total_revenue,
    count(DISTINCT customer_id) AS unique_customers, round(avg(price) + 1e-9, 4) AS avg_price, max(t_dat) AS last_purchase_date
  FROM t GROUP BY 1)
"""

DAILY = """
daily AS (
  SELECT t_dat AS date, CAST(year(t_dat) AS INTEGER) AS year, CAST(month(t_dat) AS INTEGER) AS month,
    strftime(t_dat, '%Y-%m') AS year_month, count(*) AS num_transactions, round(sum(price) + 1e-9, 4) AS total_revenue,
    count(DISTINCT customer_id) AS unique_customers, count(DISTINCT article_id) AS unique_products,
    avg(price) AS avg_transaction_value
  FROM t GROUP BY 1)
"""

# The three models on the purchase events, as rows of (model_name, customer_id, article_id, rank).
MODELS = """
e_train AS (SELECT * FROM e WHERE t_dat <= DATE '2024-01-08'),
e_recent AS (SELECT * FROM e_train WHERE t_dat >= DATE '2024-01-01'),
pop AS (
  SELECT article_id, round(sum(exp(-0.5 * date_diff('day', t_dat, DATE '2024-01-08'))), 9) AS popularity_score,
    count(*) AS purchase_count FROM e_recent GROUP BY 1),
pop_list AS (
  SELECT article_id, row_number() OVER (ORDER BY popularity_score DESC, article_id) AS rank FROM pop QUALIFY rank <= 12),
age_list AS (
  SELECT age_group, article_id, count(*) AS segment_purchases,
    CAST(row_number() OVER (PARTITION BY age_group ORDER BY count(*) DESC, article_id) AS INTEGER) AS rank
  FROM e_recent JOIN seg USING (customer_id) WHERE age_group <> 'Unknown' GROUP BY age_group, article_id QUALIFY rank <= 12),
nexts AS (
  SELECT article_id, lead(article_id) OVER (PARTITION BY customer_id ORDER BY t_dat, transaction_id) AS nx FROM e_train),
follow AS (
  SELECT article_id, nx, row_number() OVER (PARTITION BY article_id ORDER BY count(*) DESC, nx) AS rank
  FROM nexts WHERE nx IS NOT NULL GROUP BY article_id, nx QUALIFY rank <= 12),
last_buy AS (
  SELECT customer_id, article_id FROM e_train
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY t_dat DESC, transaction_id DESC) = 1),
base AS (
  SELECT 'popularity' AS model_name, customer_id, article_id, rank FROM customers, pop_list
  UNION ALL SELECT 'age_rules', customer_id, article_id, rank FROM seg JOIN age_list USING (age_group)
  UNION ALL SELECT 'next_item', customer_id, nx, rank FROM last_buy JOIN follow USING (article_id)),
blend_customers AS (
  SELECT customer_id FROM last_buy
  WHERE customer_id IN (SELECT customer_id FROM customers) AND customer_id IN (SELECT customer_id FROM base WHERE model_name = 'age_rules')),
blend AS (
  SELECT 'ensemble' AS model_name, customer_id, article_id,
    row_number() OVER (PARTITION BY customer_id ORDER BY round(sum(w / r), 12) DESC, min(m * 100 + r)) AS rank
  FROM (SELECT model_name, customer_id, article_id, rank AS r, CASE model_name WHEN 'popularity' THEN 1 WHEN 'age_rules' THEN 2 ELSE 3 END AS m,
      CASE model_name WHEN 'popularity' THEN 0.2::DOUBLE WHEN 'age_rules' THEN 0.3::DOUBLE ELSE 0.5::DOUBLE END AS w FROM base)
  WHERE customer_id IN (SELECT customer_id FROM blend_customers) GROUP BY customer_id, article_id QUALIFY rank <= 12),
preds AS (SELECT * FROM base UNION ALL SELECT * FROM blend),
listed AS (
  SELECT model_name, customer_id FROM preds GROUP BY ALL
  UNION SELECT 'next_item', customer_id FROM last_buy
  UNION SELECT 'ensemble', customer_id FROM blend_customers),
lists AS (
  SELECT l.model_name, l.customer_id,
    coalesce(string_agg(CAST(article_id AS VARCHAR), ' ' ORDER BY rank), '') AS predicted_articles, count(article_id) AS n
  FROM listed l LEFT JOIN preds p USING (model_name, customer_id) GROUP BY ALL)
"""


def truth_sql(after: str, until: str) -> str:
    """Truth pairs and the precision of every listed customer that bought something."""
    return f"""
truth AS (
  SELECT customer_id, article_id, count(*) AS copies FROM e
  WHERE t_dat > DATE '{after}' AND t_dat <= DATE '{until}' GROUP BY ALL),
bought AS (SELECT customer_id, CAST(sum(copies) AS BIGINT) AS num_purchases FROM truth GROUP BY 1),
hits AS (
  SELECT model_name, customer_id, rank, row_number() OVER (PARTITION BY model_name, customer_id ORDER BY rank) AS nth
  FROM preds JOIN truth USING (customer_id, article_id)),
sums AS (
  SELECT model_name, customer_id, sum(CASE WHEN rank <= 12 THEN nth / rank END) AS s12, sum(CASE WHEN rank <= 5 THEN nth / rank END) AS s5
  FROM hits GROUP BY model_name, customer_id),
ap AS (
  SELECT l.model_name, l.customer_id, num_purchases, coalesce(s12, 0) / least(num_purchases, 12) AS ap12,
    coalesce(s5, 0) / least(num_purchases, 5) AS ap5
  FROM listed l JOIN bought USING (customer_id) LEFT JOIN sums s ON s.model_name = l.model_name AND s.customer_id = l.customer_id)
"""


def sql(*ctes: str, select: str) -> str:
    return VIEWS + "".join("," + c for c in ctes) + select
