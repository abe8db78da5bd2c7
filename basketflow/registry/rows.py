"""Queries over projections, filters, joins and scalar functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions import bands, dates, encoding, text
from basketflow.functions.sampling import portable_hash
from basketflow.operators import dashboard, features, filters, gold, labels, pairs, recommend, text_index
from basketflow.registry import models
from basketflow.registry.common import MODELS, SALES, T_CUTS, Inputs, as_text, query, r4, sql
from basketflow.session import scratch_path

# The same 40-bit hash in SQL.
def _hash(seed: int, column: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || CAST({column} AS VARCHAR)), 1, 10) AS BIGINT)"


SPAN = 1 << 40


@query(
    "purchase_history",
    sql(select="SELECT t_dat, article_id, price, transaction_id FROM t WHERE customer_id = 'Customer#000000007'"),
)
def purchase_history(x: Inputs) -> DataFrame:
    return filters.purchase_history(x.t, "Customer#000000007")


_MODES = {"none": (None, None), "from": ("2000-03-01", None), "to": (None, "2000-03-01"), "both": ("1999-06-01", "2000-03-01")}


def _mode_sql(mode: str, start: str | None, end: str | None) -> str:
    tests = [f"t_dat >= DATE '{start}'"] * bool(start) + [f"t_dat <= DATE '{end}'"] * bool(end)
    return (
        f"SELECT '{mode}' AS mode, count(*) AS num_rows, min(t_dat) AS first_date, max(t_dat) AS last_date, "
        f"round(CAST(sum(CAST(price AS DECIMAL(20, 4))) AS DOUBLE) + 1e-9, 4) AS revenue FROM t WHERE {' AND '.join(tests) or 'true'}"
    )


@query("date_range_filter", sql(select=" UNION ALL ".join(_mode_sql(m, *b) for m, b in _MODES.items())))
def date_range_filter(x: Inputs) -> DataFrame:
    parts = [
        filters.between_dates(x.t, "t_dat", *bounds).agg(
            F.lit(mode).alias("mode"),
            F.count(F.lit(1)).alias("num_rows"),
            F.min("t_dat").alias("first_date"),
            F.max("t_dat").alias("last_date"),
            # Summed as decimals: the order of a floating sum shows in the fourth decimal of large totals.
            r4(F.sum(F.col("price").cast("decimal(20,4)")).cast("double")).alias("revenue"),
        )
        for mode, bounds in _MODES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "temporal_split",
    sql(
        """
splits AS (
  SELECT 'train' AS split, * FROM t WHERE t_dat <= DATE '2001-07-01'
  UNION ALL SELECT 'val', * FROM t WHERE t_dat > DATE '2001-07-01' AND t_dat <= DATE '2001-07-15'
  UNION ALL SELECT 'test', * FROM t WHERE t_dat <= DATE '2001-07-22')""",
        select="""SELECT split, count(*) AS num_transactions, count(DISTINCT customer_id) AS num_customers,
        count(DISTINCT article_id) AS num_articles, min(t_dat) AS first_date, max(t_dat) AS last_date FROM splits GROUP BY 1""",
    ),
)
def temporal_split(x: Inputs) -> DataFrame:
    return labels.split_summary(x.t, T_CUTS)


@query("age_group", sql(select="SELECT customer_id, age_group FROM seg"))
def age_group(x: Inputs) -> DataFrame:
    return bands.with_age_group(x.customers).select("customer_id", "age_group")


@query(
    "age_bin",
    sql(
        select="""SELECT customer_id, CASE WHEN age < 20 THEN '<20' WHEN age < 30 THEN '20-29' WHEN age < 40 THEN '30-39'
        WHEN age < 50 THEN '40-49' WHEN age < 60 THEN '50-59' WHEN age >= 60 THEN '60+' ELSE 'Unknown' END AS age_bin FROM customers"""
    ),
)
def age_bin(x: Inputs) -> DataFrame:
    return x.customers.select("customer_id", bands.age_bin(F.col("age")).alias("age_bin"))


@query(
    "age_group_eval",
    sql(
        select="""SELECT customer_id, CASE WHEN age >= 0 AND age < 25 THEN '18-24' WHEN age >= 25 AND age < 35 THEN '25-34'
        WHEN age >= 35 AND age < 45 THEN '35-44' WHEN age >= 45 AND age < 55 THEN '45-54' WHEN age >= 55 AND age < 65 THEN '55-64'
        WHEN age >= 65 THEN '65+' END AS age_group FROM customers"""
    ),
)
def age_group_eval(x: Inputs) -> DataFrame:
    return x.customers.select("customer_id", bands.age_group_eval(F.col("age")).alias("age_group"))


@query(
    "optional_filters",
    sql(
        select="""SELECT article_id, product_group_name, department_name FROM articles
        WHERE product_group_name = 'Shoes' AND department_name = 'Brand#3'"""
    ),
)
def optional_filters(x: Inputs) -> DataFrame:
    chosen = {"product_group_name": "Shoes", "colour_group_name": "ALL", "department_name": "Brand#3", "section_name": None}
    return x.articles.filter(filters.equals_unless_all(chosen)).select("article_id", "product_group_name", "department_name")


@query(
    "contains_search",
    sql(select="SELECT article_id, prod_name FROM articles WHERE prod_name LIKE '%ring%' OR detail_desc LIKE '%ring%'"),
)
def contains_search(x: Inputs) -> DataFrame:
    return x.articles.filter(filters.contains_text("ring", "prod_name", "detail_desc")).select("article_id", "prod_name")


_SEARCHES = ("ring", "steel", "OLISHED BR", "Sec", "e", "no such text", "1%", "ss st")


@query(
    "indexed_search",
    sql(
        select=" UNION ALL ".join(
            f"""SELECT '{s}' AS search, article_id, prod_name FROM articles
            WHERE contains(prod_name, '{s}') OR contains(detail_desc, '{s}')"""
            for s in _SEARCHES
        )
    ),
)
def indexed_search(x: Inputs) -> DataFrame:
    """Several searched texts, one of them too short for the index, through one trigram index."""
    path, columns = scratch_path(x.spark, "text-index"), ["prod_name", "detail_desc"]
    text_index.write_index(x.articles, "article_id", columns, path)
    parts = [
        text_index.search_index(x.spark, path, "article_id", s, *columns).select(F.lit(s).alias("search"), "article_id", "prod_name")
        for s in _SEARCHES
    ]
    return reduce(DataFrame.unionByName, parts)


CUSTOMER_CODES = """
customer_codes AS (
  SELECT customer_id, coalesce(age, 0) AS age, CAST(CASE WHEN FN = 0 THEN 0 ELSE 1 END AS INTEGER) AS is_subscribed,
    coalesce(Active, 0.0::DOUBLE) AS is_active, CAST(CASE WHEN club_member_status = 'ACTIVE' THEN 1 ELSE 0 END AS INTEGER) AS is_club_member
  FROM customers)
"""
ARTICLE_CODES = """
article_codes AS (
  SELECT article_id, coalesce(product_type_no, 0) AS product_type,
    CAST(CASE product_group_name WHEN 'Garment Upper body' THEN 1 WHEN 'Garment Lower body' THEN 2 WHEN 'Shoes' THEN 3
      WHEN 'Accessories' THEN 4 ELSE 0 END AS INTEGER) AS product_group_encoded,
    CAST(coalesce(garment_group_no // 1000, 0) AS INTEGER) AS garment_group, coalesce(colour_group_code, 0) AS colour_code
  FROM articles)
"""


@query("customer_encoding", sql(CUSTOMER_CODES, select="SELECT * FROM customer_codes"))
def customer_encoding(x: Inputs) -> DataFrame:
    return encoding.encode_customers(x.customers)


@query("article_encoding", sql(ARTICLE_CODES, select="SELECT * FROM article_codes"))
def article_encoding(x: Inputs) -> DataFrame:
    return encoding.encode_articles(x.articles)


@query(
    "image_path",
    sql(
        select="""SELECT article_id, '/volume/images/' || substr(lpad(CAST(article_id AS VARCHAR), 10, '0'), 1, 3) || '/'
        || lpad(CAST(article_id AS VARCHAR), 10, '0') || '.jpg' AS image_path FROM articles"""
    ),
)
def image_path(x: Inputs) -> DataFrame:
    return x.articles.select("article_id", text.image_path(F.col("article_id"), "/volume").alias("image_path"))


@query(
    "fill_missing",
    sql(
        select="""SELECT customer_id, coalesce(n, 0) AS purchases, round(coalesce(spent, 0) + 1e-9, 4) AS spent
        FROM customers LEFT JOIN (SELECT customer_id, count(*) AS n, sum(price) AS spent FROM t
          WHERE t_dat BETWEEN DATE '2001-06-01' AND DATE '2001-07-01' GROUP BY 1) USING (customer_id)"""
    ),
)
def fill_missing(x: Inputs) -> DataFrame:
    window = filters.between_dates(x.t, "t_dat", "2001-06-01", "2001-07-01")
    bought = window.groupBy("customer_id").agg(F.count(F.lit(1)).alias("purchases"), F.sum("price").alias("spent"))
    joined = x.customers.select("customer_id").join(bought, "customer_id", "left")
    return features.zero_filled(joined, ["purchases", "spent"]).withColumn("spent", r4("spent"))


@query(
    "in_list_lookup",
    sql(select="SELECT article_id, prod_name FROM articles WHERE article_id IN (SELECT article_id FROM e)"),
)
def in_list_lookup(x: Inputs) -> DataFrame:
    return filters.rows_with_ids(x.articles.select("article_id", "prod_name"), x.e, "article_id")


@query(
    "unknown_segment_filter",
    sql(select="SELECT customer_id, age_group FROM seg WHERE age_group IS NOT NULL AND age_group <> 'Unknown'"),
)
def unknown_segment_filter(x: Inputs) -> DataFrame:
    return filters.known_segment(x.segments)


@query(
    "join_left_chain",
    sql(
        select="""SELECT customer_id, coalesce(a.n, 0) AS purchases_7d, coalesce(b.n, 0) AS purchases_30d, coalesce(l.n, 0) AS purchases_lifetime
        FROM customers
        LEFT JOIN (SELECT customer_id, count(*) AS n FROM t WHERE t_dat BETWEEN DATE '2001-06-24' AND DATE '2001-07-01' GROUP BY 1) a USING (customer_id)
        LEFT JOIN (SELECT customer_id, count(*) AS n FROM t WHERE t_dat BETWEEN DATE '2001-06-01' AND DATE '2001-07-01' GROUP BY 1) b USING (customer_id)
        LEFT JOIN (SELECT customer_id, count(*) AS n FROM t WHERE t_dat <= DATE '2001-07-01' GROUP BY 1) l USING (customer_id)"""
    ),
)
def join_left_chain(x: Inputs) -> DataFrame:
    return features.customer_features(x.t_train, x.customers, T_CUTS.train).select(
        "customer_id", "purchases_7d", "purchases_30d", "purchases_lifetime"
    )


@query(
    "join_inner",
    sql(select="SELECT transaction_id, t_dat, article_id, prod_name, department_name FROM t JOIN articles USING (article_id)"),
)
def join_inner(x: Inputs) -> DataFrame:
    return dashboard.transactions_with_articles(x.t, x.articles).select(
        "transaction_id", "t_dat", "article_id", "prod_name", "department_name"
    )


@query(
    "join_left_outer",
    sql(
        SALES,
        select="""SELECT article_id, prod_name, coalesce(num_transactions, 0) AS num_transactions,
        coalesce(total_revenue, 0) AS total_revenue FROM articles LEFT JOIN sales USING (article_id)""",
    ),
)
def join_left_outer(x: Inputs) -> DataFrame:
    sales = gold.article_sales(x.t).select("article_id", "num_transactions", r4("total_revenue").alias("total_revenue"))
    joined = x.articles.select("article_id", "prod_name").join(sales, "article_id", "left")
    return features.zero_filled(joined, ["num_transactions", "total_revenue"])


@query(
    "join_anti",
    sql(
        select="""SELECT customer_id FROM customers WHERE customer_id NOT IN
        (SELECT customer_id FROM t WHERE t_dat > DATE '2001-07-15' AND t_dat <= DATE '2001-07-22')"""
    ),
)
def join_anti(x: Inputs) -> DataFrame:
    return labels.without_purchases(x.customers, labels.truth_pairs(x.t, *T_CUTS.truth_window("val")))


CANDIDATES = f"""
few_customers AS (SELECT customer_id FROM customers WHERE {_hash(42, "customer_id")} < 0.3 * {SPAN}),
few_articles AS (
  SELECT article_id, row_number() OVER (ORDER BY article_id) - 1 AS spot FROM articles WHERE {_hash(43, "article_id")} < 0.3 * {SPAN}),
size AS (SELECT count(*) AS v FROM few_articles),
spots AS (
  SELECT customer_id, ({_hash(42, "customer_id")} % v + CAST(floor(k * v / least(5, v)) AS BIGINT)) % v AS spot
  FROM few_customers, size, range(5) AS r(k) WHERE k < least(5, v)),
candidates AS (SELECT customer_id, article_id FROM spots JOIN few_articles USING (spot))
"""


def _candidates(x: Inputs) -> DataFrame:
    few_customers = pairs.fraction_sample(x.customers, "customer_id", 0.3, 42, portable_hash)
    few_articles = pairs.fraction_sample(x.articles, "article_id", 0.3, 43, portable_hash)
    return pairs.candidate_pairs(few_customers, few_articles, 5, 42, portable_hash)


@query("join_cross_pairs", sql(CANDIDATES, select="SELECT customer_id, article_id FROM candidates"))
def join_cross_pairs(x: Inputs) -> DataFrame:
    """Random pairs of the sampled customers and articles, drawn instead of multiplied out."""
    return _candidates(x)


@query(
    "distinct_pairs",
    sql(
        CANDIDATES,
        """positives AS (SELECT DISTINCT customer_id, article_id FROM e)""",
        select="""SELECT customer_id, article_id, CAST(1 AS INTEGER) AS label FROM positives
        UNION ALL SELECT customer_id, article_id, CAST(0 AS INTEGER) FROM candidates ANTI JOIN positives USING (customer_id, article_id)""",
    ),
)
def distinct_pairs(x: Inputs) -> DataFrame:
    positives = pairs.distinct_pairs(x.e)
    return positives.unionByName(pairs.unbought(_candidates(x), positives).withColumn("label", F.lit(0)))


@query(
    "capped_sample",
    sql(
        """positives AS (SELECT DISTINCT customer_id, article_id FROM t),
share AS (SELECT least(1.0::DOUBLE, 20000::DOUBLE / count(*)) AS f FROM positives)""",
        select=f"""SELECT customer_id, article_id FROM positives, share
        WHERE CAST('0x' || substr(md5('42|' || customer_id || '|' || CAST(article_id AS VARCHAR)), 1, 10) AS BIGINT) < f * {SPAN}::DOUBLE""",
    ),
)
def capped_sample(x: Inputs) -> DataFrame:
    bought = pairs.distinct_pairs(x.t).select("customer_id", "article_id")
    return pairs.capped_sample(bought, ["customer_id", "article_id"], 20_000, 42, portable_hash)


@query("customer_ids", sql(select="SELECT DISTINCT customer_id FROM t"))
def customer_ids(x: Inputs) -> DataFrame:
    return filters.customer_ids(x.t)


@query(
    "join_three_way",
    sql(
        MODELS,
        select="""SELECT customer_id, max(CASE model_name WHEN 'popularity' THEN n END) AS n_popularity,
        max(CASE model_name WHEN 'age_rules' THEN n END) AS n_age_rules, max(CASE model_name WHEN 'next_item' THEN n END) AS n_next_item
        FROM lists WHERE model_name <> 'ensemble' AND customer_id IN (SELECT customer_id FROM blend_customers) GROUP BY 1""",
    ),
)
def join_three_way(x: Inputs) -> DataFrame:
    base = models.base_predictions(x)
    sized = [
        df.select("customer_id", F.size("predicted_articles").cast("long").alias(f"n_{name}")) for name, df in base.items()
    ]
    return reduce(lambda a, b: a.join(b, "customer_id"), sized)


@query(
    "join_segment_filter",
    sql(select="SELECT transaction_id, customer_id, article_id FROM t JOIN seg USING (customer_id) WHERE age_group = '25-34'"),
)
def join_segment_filter(x: Inputs) -> DataFrame:
    rows = x.t.select("transaction_id", "customer_id", "article_id")
    return recommend.segment_rows(rows, x.segments, "age_group", "25-34")


@query(
    "join_dict_lookup",
    sql(
        MODELS,
        select="""SELECT customer_id, age_group, coalesce(predicted_articles, '') AS predicted_articles
        FROM seg LEFT JOIN (SELECT * FROM lists WHERE model_name = 'age_rules') USING (customer_id)""",
    ),
)
def join_dict_lookup(x: Inputs) -> DataFrame:
    kept = recommend.age_rules_predict(x.segments, models.segment_lists(x), keep_empty=True)
    return kept.withColumn("predicted_articles", as_text("predicted_articles"))


@query(
    "date_features",
    sql(
        select="""SELECT transaction_id, CAST(year(t_dat) AS INTEGER) AS year, CAST(month(t_dat) AS INTEGER) AS month,
        CAST(day(t_dat) AS INTEGER) AS day, CAST(dayofweek(t_dat) + 1 AS INTEGER) AS dayofweek, CAST(weekofyear(t_dat) AS INTEGER) AS week,
        strftime(t_dat, '%Y-%m') AS year_month FROM t"""
    ),
)
def date_features(x: Inputs) -> DataFrame:
    rows = x.t.select("transaction_id", "t_dat")
    return dates.with_date_features(rows).drop("t_dat")


@query(
    "seasonality_features",
    sql(
        select="""SELECT transaction_id, CAST(month(t_dat) AS INTEGER) AS month, CAST(quarter(t_dat) AS INTEGER) AS quarter,
        CAST(dayofweek(t_dat) + 1 AS INTEGER) AS dayofweek, CAST(weekofyear(t_dat) AS INTEGER) AS week,
        CASE WHEN month(t_dat) IN (12, 1, 2) THEN 'Winter' WHEN month(t_dat) IN (3, 4, 5) THEN 'Spring'
          WHEN month(t_dat) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
        CAST(CASE WHEN dayofweek(t_dat) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend FROM t"""
    ),
)
def seasonality_features(x: Inputs) -> DataFrame:
    return dates.with_seasonality(x.t.select("transaction_id", "t_dat")).drop("t_dat")
