"""Queries over summary tables, features, profiles and the dashboard."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.operators import bitmaps, dashboard, features, gold, labels, profile, recommend
from basketflow.registry import models
from basketflow.registry.common import (
    DAILY,
    DEMOGRAPHICS,
    E_CUTS,
    MODELS,
    SALES,
    T_CUTS,
    Inputs,
    as_text,
    query,
    rounded,
    sql,
)
from basketflow.sources import schemas
from basketflow.session import materialize

_ARTICLE = ", ".join(gold.ARTICLE_COLUMNS)


@query(
    "product_sales_summary",
    sql(
        SALES,
        select=f"""SELECT s.article_id, {_ARTICLE}, num_transactions, total_revenue, unique_customers, avg_price, last_purchase_date
        FROM sales s LEFT JOIN articles a ON s.article_id = a.article_id""",
    ),
)
def product_sales_summary(x: Inputs) -> DataFrame:
    return rounded(gold.product_sales_summary(x.t, x.articles), "total_revenue", "avg_price")


_CUSTOMER_COLUMNS = """customer_id, age_bin, coalesce(club_member_status, '-') AS club_member_status,
    coalesce(fashion_news_frequency, '-') AS fashion_news_frequency, coalesce(Active, 0) AS Active, num_purchases, total_spent,
    unique_items, coalesce(CAST(last_purchase_date AS VARCHAR), '-') AS last_purchase_date,
    coalesce(CAST(first_purchase_date AS VARCHAR), '-') AS first_purchase_date, coalesce(age, -1) AS age"""


@query("customer_demographics", sql(DEMOGRAPHICS, select=f"SELECT {_CUSTOMER_COLUMNS} FROM demographics"))
def customer_demographics(x: Inputs) -> DataFrame:
    table = rounded(gold.customer_demographics(x.customers, x.t), "total_spent")
    dates = {c: F.col(c).cast("string") for c in ("last_purchase_date", "first_purchase_date")}
    return table.withColumns(dates).fillna("-").fillna({"Active": 0.0, "age": -1})


@query("time_series_daily", sql(DAILY, select="SELECT * REPLACE (round(avg_transaction_value + 1e-9, 4) AS avg_transaction_value) FROM daily"))
def time_series_daily(x: Inputs) -> DataFrame:
    return rounded(gold.time_series_daily(x.t), "total_revenue", "avg_transaction_value")


_ROLL = """SELECT '{name}' AS granularity, min(date) AS date, CAST(sum(num_transactions) AS BIGINT) AS num_transactions,
  round(sum(total_revenue) + 1e-9, 4) AS total_revenue, CAST(sum(unique_customers) AS BIGINT) AS unique_customers_sum,
  CAST(sum(unique_products) AS BIGINT) AS unique_products_sum, round(avg(avg_transaction_value) + 1e-9, 4) AS avg_transaction_value
  FROM daily WHERE date BETWEEN DATE '1996-01-10' AND DATE '2001-06-20' GROUP BY {key}"""
_PERIODS = {"daily": "date", "weekly": "date_trunc('week', date)", "monthly": "date_trunc('month', date)"}


@query("time_series_rollup", sql(DAILY, select=" UNION ALL ".join(_ROLL.format(name=n, key=k) for n, k in _PERIODS.items())))
def time_series_rollup(x: Inputs) -> DataFrame:
    daily = materialize(gold.time_series_daily(x.t), "daily")
    parts = [
        dashboard.time_series_rollup(daily, g, "1996-01-10", "2001-06-20").withColumn("granularity", F.lit(g)) for g in _PERIODS
    ]
    return rounded(reduce(DataFrame.unionByName, parts), "total_revenue", "avg_transaction_value")


@query(
    "time_series_exact",
    sql(
        select="""SELECT min(t_dat) AS date, count(*) AS num_transactions, round(sum(price) + 1e-9, 4) AS total_revenue,
        count(DISTINCT customer_id) AS unique_customers, count(DISTINCT article_id) AS unique_products,
        round(avg(price) + 1e-9, 4) AS avg_transaction_value FROM t GROUP BY date_trunc('week', t_dat)"""
    ),
)
def time_series_exact(x: Inputs) -> DataFrame:
    return rounded(dashboard.time_series_exact(x.t, "weekly"), "total_revenue", "avg_transaction_value")


_EXACT = """SELECT '{name}' AS granularity, min(t_dat) AS date, count(*) AS num_transactions, round(sum(price) + 1e-9, 4) AS total_revenue,
  count(DISTINCT customer_id) AS unique_customers, count(DISTINCT article_id) AS unique_products,
  round(avg(price) + 1e-9, 4) AS avg_transaction_value FROM t
  WHERE t_dat BETWEEN DATE '1996-01-10' AND DATE '2001-06-20' GROUP BY {key}"""
_PURCHASE_PERIODS = {"daily": "t_dat", "weekly": "date_trunc('week', t_dat)", "monthly": "date_trunc('month', t_dat)"}


@query(
    "time_series_from_state",
    sql(select=" UNION ALL ".join(_EXACT.format(name=n, key=k) for n, k in _PURCHASE_PERIODS.items())),
)
def time_series_from_state(x: Inputs) -> DataFrame:
    """The exact figures of three granularities from two daily states, the second with values the first has not."""
    half = F.lit("1999-01-01").cast("date")
    # Numbers, sums and bitmaps of both halves read the purchases: these are joined and written once.
    t = materialize(x.t.select("t_dat", "customer_id", "article_id", "price"), "purchases")
    early, late = t.filter(F.col("t_dat") < half), t.filter(F.col("t_dat") >= half)
    numbers = {name: bitmaps.value_numbers(early, column) for name, column in bitmaps.COUNTED.items()}
    first = bitmaps.daily_state(early, numbers)
    numbers = {name: bitmaps.value_numbers(late, column, numbers[name]) for name, column in bitmaps.COUNTED.items()}
    state = bitmaps.merged([first, bitmaps.daily_state(late, numbers)])
    parts = [bitmaps.time_series(state, g, "1996-01-10", "2001-06-20").withColumn("granularity", F.lit(g)) for g in _PURCHASE_PERIODS]
    return rounded(reduce(DataFrame.unionByName, parts), "total_revenue", "avg_transaction_value")


def _by(column: str, extra: str = "") -> str:
    return sql(
        DEMOGRAPHICS,
        select=f"""SELECT {column}, count(*) AS num_customers, round(avg(total_spent) + 1e-9, 4) AS avg_spent{extra}
        FROM demographics WHERE {column} IS NOT NULL GROUP BY 1""",
    )


@query("demographics_by_age", _by("age_bin", ", round(avg(num_purchases) + 1e-9, 4) AS avg_purchases"))
def demographics_by_age(x: Inputs) -> DataFrame:
    table = gold.customer_demographics(x.customers, x.t)
    return rounded(dashboard.demographics_by(table, "age_bin", with_purchases=True), "avg_spent", "avg_purchases")


@query("demographics_by_club", _by("club_member_status"))
def demographics_by_club(x: Inputs) -> DataFrame:
    return rounded(dashboard.demographics_by(gold.customer_demographics(x.customers, x.t), "club_member_status"), "avg_spent")


@query("demographics_by_news", _by("fashion_news_frequency"))
def demographics_by_news(x: Inputs) -> DataFrame:
    return rounded(
        dashboard.demographics_by(gold.customer_demographics(x.customers, x.t), "fashion_news_frequency"), "avg_spent"
    )


def _window_sql(key: str, other: str, count: str, distinct: str, spend: bool) -> str:
    """Aggregates of the 7 and 30 day windows and all time, straight from the definitions."""
    columns = []
    for days, first in ((7, "2001-06-24"), (30, "2001-06-01")):
        inside = f"FILTER (t_dat >= DATE '{first}')"
        columns.append(f"count(*) {inside} AS {count}_{days}d")
        if spend:
            columns.append(f"round(coalesce(sum(price) {inside}, 0) + 1e-9, 4) AS total_spent_{days}d")
        columns.append(f"count(DISTINCT {other}) {inside} AS {distinct}_{days}d")
        columns.append(f"round(coalesce(avg(price) {inside}, 0) + 1e-9, 4) AS avg_price_{days}d")
    columns += [f"count(*) AS {count}_lifetime", f"count(DISTINCT {other}) AS {distinct}_lifetime"]
    if spend:
        columns.append("round(sum(price) + 1e-9, 4) AS total_spent_lifetime")
    return f"SELECT {key}, {', '.join(columns)}, min(t_dat) AS first_date, max(t_dat) AS last_date FROM t WHERE t_dat <= DATE '2001-07-01' GROUP BY 1"


_CUSTOMER_WINDOWS = _window_sql("customer_id", "article_id", "purchases", "unique_items", True)
_ARTICLE_WINDOWS = _window_sql("article_id", "customer_id", "popularity", "unique_customers", False)
_SPEND = ["total_spent_7d", "avg_price_7d", "total_spent_30d", "avg_price_30d", "total_spent_lifetime"]


@query("windowed_customer_agg", sql(select=_CUSTOMER_WINDOWS))
def windowed_customer_agg(x: Inputs) -> DataFrame:
    out = features.customer_windows(x.t_train, T_CUTS.train).withColumnsRenamed(
        {"first_purchase_date": "first_date", "last_purchase_date": "last_date"}
    )
    return rounded(features.zero_filled(out, _SPEND), *_SPEND)


@query("windowed_article_agg", sql(select=_ARTICLE_WINDOWS))
def windowed_article_agg(x: Inputs) -> DataFrame:
    out = features.article_windows(x.t_train, T_CUTS.train).withColumnsRenamed(
        {"first_sale_date": "first_date", "last_sale_date": "last_date"}
    )
    means = ["avg_price_7d", "avg_price_30d"]
    return rounded(features.zero_filled(out, means), *means)


_C = [
    "purchases_7d",
    "total_spent_7d",
    "unique_items_7d",
    "avg_price_7d",
    "purchases_30d",
    "total_spent_30d",
    "unique_items_30d",
    "avg_price_30d",
    "purchases_lifetime",
    "total_spent_lifetime",
    "unique_items_lifetime",
]
CUSTOMER_FEATURES = f"""
cw AS ({_CUSTOMER_WINDOWS}),
cf AS (
  SELECT customer_id, {", ".join(f"coalesce(cw.{c}, 0) AS {c}" for c in _C)},
    CAST(coalesce(date_diff('day', last_date, DATE '2001-07-01'), 0) AS INTEGER) AS days_since_last_purchase,
    CAST(coalesce(date_diff('day', first_date, DATE '2001-07-01'), 0) AS INTEGER) AS customer_tenure_days
  FROM customers LEFT JOIN cw USING (customer_id))
"""
_FREQUENCY = "round(CASE WHEN customer_tenure_days > 0 THEN purchases_30d / 30.0::DOUBLE ELSE 0 END + 1e-9, 4) AS purchase_frequency_30d"


@query("customer_features", sql(CUSTOMER_FEATURES, select=f"SELECT *, {_FREQUENCY} FROM cf"))
def customer_features(x: Inputs) -> DataFrame:
    table = features.customer_features(x.t_train, x.customers, T_CUTS.train)
    columns = ["customer_id", *_C, "days_since_last_purchase", "customer_tenure_days", "purchase_frequency_30d"]
    return rounded(table.select(*columns), *_SPEND, "purchase_frequency_30d")


RFM = """
rfm_base AS (
  SELECT customer_id, CAST(date_diff('day', max(t_dat), DATE '2001-07-01') AS INTEGER) AS recency_days, count(*) AS frequency,
    round(sum(price) + 1e-9, 4) AS monetary_value FROM t WHERE t_dat <= DATE '2001-07-01' GROUP BY 1),
rfm_tiles AS (
  SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days, customer_id) AS INTEGER) AS recency_score,
    CAST(ntile(5) OVER (ORDER BY frequency DESC, customer_id) AS INTEGER) AS frequency_score,
    CAST(ntile(5) OVER (ORDER BY monetary_value DESC, customer_id) AS INTEGER) AS monetary_score FROM rfm_base),
rfm AS (SELECT *, recency_score || '' || frequency_score || '' || monetary_score AS rfm_score FROM rfm_tiles)
"""


@query("rfm_scores", sql(RFM, select="SELECT * FROM rfm"))
def rfm_scores(x: Inputs) -> DataFrame:
    return rounded(features.rfm_scores(x.t_train, T_CUTS.train), "monetary_value")


_RFM_FILLED = {"recency_days": -1, "frequency": -1, "monetary_value": -1, "recency_score": -1, "frequency_score": -1, "monetary_score": -1}


@query(
    "customer_feature_set",
    sql(
        CUSTOMER_FEATURES,
        RFM,
        select=f"""SELECT cf.*, coalesce(age, -1) AS age, age_group, {_FREQUENCY},
        {", ".join(f"coalesce({c}, -1) AS {c}" for c in _RFM_FILLED)}, coalesce(rfm_score, '-') AS rfm_score
        FROM cf JOIN customers USING (customer_id) JOIN seg USING (customer_id) LEFT JOIN rfm USING (customer_id)""",
    ),
)
def customer_feature_set(x: Inputs) -> DataFrame:
    table = features.customer_feature_set(x.t_train, x.customers, T_CUTS.train)
    filled = table.fillna({**_RFM_FILLED, "age": -1, "rfm_score": "-"})
    return rounded(filled, *_SPEND, "purchase_frequency_30d", "monetary_value")


_A = ["popularity_7d", "unique_customers_7d", "avg_price_7d", "popularity_30d", "unique_customers_30d", "avg_price_30d"]
_A += ["popularity_lifetime", "unique_customers_lifetime"]
_TEXTS = ["product_type_name", "product_group_name", "colour_group_name", "department_name", "index_group_name", "section_name"]


@query(
    "article_features",
    sql(
        f"aw AS ({_ARTICLE_WINDOWS})",
        select=f"""SELECT article_id, {", ".join(_TEXTS)}, {", ".join(f"coalesce(aw.{c}, 0) AS {c}" for c in _A)},
        CAST(coalesce(date_diff('day', last_date, DATE '2001-07-01'), 0) AS INTEGER) AS days_since_last_sale,
        round(CASE WHEN aw.popularity_30d > 0 THEN aw.popularity_7d / aw.popularity_30d ELSE 0 END + 1e-9, 4) AS popularity_trend
        FROM articles LEFT JOIN aw USING (article_id)""",
    ),
)
def article_features(x: Inputs) -> DataFrame:
    table = features.article_feature_set(x.t_train, x.articles, T_CUTS.train)
    return rounded(table, "avg_price_7d", "avg_price_30d", "popularity_trend")


@query(
    "ground_truth_labels",
    sql(
        select="""SELECT customer_id, string_agg(CAST(article_id AS VARCHAR), ' ' ORDER BY article_id) AS actual_articles, count(*) AS num_purchases
        FROM t WHERE t_dat > DATE '2001-07-15' AND t_dat <= DATE '2001-07-22' GROUP BY 1"""
    ),
)
def ground_truth_labels(x: Inputs) -> DataFrame:
    found = labels.ground_truth_labels(labels.truth_pairs(x.t, *T_CUTS.truth_window("val")))
    return found.withColumn("actual_articles", as_text("actual_articles"))


@query(
    "global_profile",
    sql(
        select="""SELECT min(t_dat) AS min_date, max(t_dat) AS max_date, count(DISTINCT customer_id) AS num_customers,
        count(DISTINCT article_id) AS num_articles FROM t"""
    ),
)
def global_profile(x: Inputs) -> DataFrame:
    return profile.global_profile(x.t)


_QUALITY = {
    "articles": schemas.ARTICLES.fieldNames(),
    "customers": schemas.CUSTOMERS.fieldNames(),
    "t": [*schemas.TRANSACTIONS.fieldNames(), "transaction_id"],
}


def _quality_sql() -> str:
    parts = []
    for table, columns in _QUALITY.items():
        parts += [
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS row_count, CAST({len(columns)} AS INTEGER) AS column_count, "
            f"count(*) - count({c}) AS null_count FROM {table}"
            for c in columns
        ]
    return " UNION ALL ".join(parts)


@query("data_quality", sql(select=_quality_sql()))
def data_quality(x: Inputs) -> DataFrame:
    tables = {"articles": x.articles, "customers": x.customers, "t": x.t}
    parts = [profile.data_quality(df).withColumn("table_name", F.lit(n)) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


_STAT_COLUMNS = ["purchases_7d", "purchases_30d", "purchases_lifetime", "total_spent_lifetime", "days_since_last_purchase"]


def _per_feature(template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in _STAT_COLUMNS)


@query(
    "feature_stats",
    sql(
        CUSTOMER_FEATURES,
        select=_per_feature(
            "SELECT '{c}' AS feature, round(avg({c}) + 1e-9, 4) AS mean, round(stddev_samp({c}) + 1e-9, 4) AS std, "
            "round(CAST(min({c}) AS DOUBLE) + 1e-9, 4) AS min, round(CAST(max({c}) AS DOUBLE) + 1e-9, 4) AS max FROM cf"
        ),
    ),
)
def feature_stats(x: Inputs) -> DataFrame:
    table = features.customer_features(x.t_train, x.customers, T_CUTS.train).select("customer_id", *_STAT_COLUMNS)
    return rounded(profile.feature_stats(table), "mean", "std", "min", "max")


@query(
    "feature_summary",
    sql(
        CUSTOMER_FEATURES,
        select=_per_feature(
            "SELECT '{c}' AS feature, count(v) AS count, round(avg(v) + 1e-9, 4) AS mean, round(stddev_samp(v) + 1e-9, 4) AS std, "
            "round(min(v) + 1e-9, 4) AS min, round(max(v) FILTER (i = greatest(1, ceil(0.25 * n))) + 1e-9, 4) AS p25, "
            "round(max(v) FILTER (i = greatest(1, ceil(0.5 * n))) + 1e-9, 4) AS p50, round(max(v) FILTER (i = greatest(1, ceil(0.75 * n))) + 1e-9, 4) AS p75, "
            "round(max(v) + 1e-9, 4) AS max FROM (SELECT CAST({c} AS DOUBLE) AS v, row_number() OVER (ORDER BY {c}) AS i, count(*) OVER () AS n FROM cf)"
        ),
    ),
)
def feature_summary(x: Inputs) -> DataFrame:
    table = features.customer_features(x.t_train, x.customers, T_CUTS.train)
    return rounded(profile.feature_summary(table, _STAT_COLUMNS), "mean", "std", "min", "p25", "p50", "p75", "max")


@query("segment_distribution", sql(select="SELECT age_group, count(*) AS num_customers FROM seg GROUP BY 1"))
def segment_distribution(x: Inputs) -> DataFrame:
    return profile.segment_distribution(x.segments)


@query(
    "feature_histogram",
    sql(
        CUSTOMER_FEATURES,
        """edges AS (SELECT CAST(min(purchases_lifetime) AS DOUBLE) AS lo, (max(purchases_lifetime) - min(purchases_lifetime)) / 50.0::DOUBLE AS w FROM cf),
binned AS (SELECT least(CAST(floor((purchases_lifetime - lo) / w) AS INTEGER), 49) AS bin, count(*) AS n FROM cf, edges GROUP BY 1)""",
        select="""SELECT CAST(b AS INTEGER) AS bin, round(lo + b * w + 1e-9, 4) AS bin_start, round(lo + (b + 1) * w + 1e-9, 4) AS bin_end,
        coalesce(n, 0) AS n FROM range(50) AS r(b) CROSS JOIN edges LEFT JOIN binned ON bin = b""",
    ),
)
def feature_histogram(x: Inputs) -> DataFrame:
    table = features.customer_features(x.t_train, x.customers, T_CUTS.train).select("purchases_lifetime")
    written = materialize(table, "histogram-input")
    return rounded(profile.feature_histogram(written, "purchases_lifetime"), "bin_start", "bin_end")


@query(
    "segment_stats",
    sql(
        MODELS,
        select="SELECT age_group, CAST(sum(segment_purchases) AS BIGINT) AS total_purchases, count(*) AS unique_articles FROM age_list GROUP BY 1",
    ),
)
def segment_stats(x: Inputs) -> DataFrame:
    return recommend.segment_stats(models.segment_lists(x))


@query(
    "segment_uniqueness",
    sql(
        MODELS,
        """spread AS (SELECT article_id, count(*) AS lists FROM age_list GROUP BY 1)""",
        select="""SELECT age_group, count(*) AS num_articles, count(*) FILTER (lists = 1) AS unique_to_segment,
        round(100.0::DOUBLE * count(*) FILTER (lists = 1) / count(*) + 1e-9, 4) AS uniqueness_pct FROM age_list JOIN spread USING (article_id) GROUP BY 1""",
    ),
)
def segment_uniqueness(x: Inputs) -> DataFrame:
    return rounded(recommend.segment_uniqueness(models.segment_lists(x)), "uniqueness_pct")


@query(
    "window_coverage",
    sql(
        select="""SELECT count(*) AS total_customers, count(*) FILTER (hit) AS with_purchases, count(*) FILTER (NOT hit) AS without_purchases,
        round(100.0::DOUBLE * count(*) FILTER (hit) / count(*) + 1e-9, 4) AS purchase_rate_pct
        FROM (SELECT customer_id IN (SELECT customer_id FROM e WHERE t_dat > DATE '2024-01-15' AND t_dat <= DATE '2024-01-22') AS hit FROM customers)"""
    ),
)
def window_coverage(x: Inputs) -> DataFrame:
    buyers = labels.truth_pairs(x.e, *E_CUTS.truth_window("val"))
    return rounded(labels.window_coverage(x.customers, buyers), "purchase_rate_pct")


@query(
    "category_insights",
    sql(
        select="""SELECT coalesce(product_group_name, 'Unknown') AS product_group_name, coalesce(product_type_name, 'Unknown') AS product_type_name,
        count(*) AS num_transactions, round(sum(price) + 1e-9, 4) AS total_revenue, count(DISTINCT customer_id) AS unique_customers,
        round(avg(price) + 1e-9, 4) AS avg_price, max(t_dat) AS last_purchase_date FROM t JOIN articles USING (article_id) GROUP BY 1, 2"""
    ),
)
def category_insights(x: Inputs) -> DataFrame:
    return rounded(gold.category_insights(x.t, x.articles), "total_revenue", "avg_price")


@query(
    "top_categories",
    sql(
        select="""SELECT customer_id, coalesce(product_group_name, '-') AS product_group_name, count(*) AS category_purchases,
        CAST(row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, product_group_name NULLS LAST) AS INTEGER) AS category_rank
        FROM t LEFT JOIN articles USING (article_id) GROUP BY customer_id, articles.product_group_name QUALIFY category_rank <= 3"""
    ),
)
def top_categories(x: Inputs) -> DataFrame:
    return features.top_categories(x.t, x.articles).fillna({"product_group_name": "-"})


@query(
    "popular_items",
    sql(
        select="""SELECT article_id, count(*) AS purchase_count FROM t
        WHERE t_dat >= (SELECT max(t_dat) FROM t) - 7 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12"""
    ),
)
def popular_items(x: Inputs) -> DataFrame:
    return recommend.popular_items(x.t)


@query(
    "popular_items_by_segment",
    sql(
        select="""SELECT article_id, count(*) AS purchase_count FROM t JOIN seg USING (customer_id)
        WHERE age_group = '35-44' AND t_dat >= DATE '2001-06-01' AND t_dat <= DATE '2001-07-01' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12"""
    ),
)
def popular_items_by_segment(x: Inputs) -> DataFrame:
    return recommend.popular_items_by_segment(x.t, x.segments, "age_group", "35-44", 30, T_CUTS.train)


_BEST = "article_id, prod_name, product_type_name, product_group_name, colour_group_name, department_name, num_transactions, total_revenue, unique_customers"


@query(
    "bestsellers",
    sql(SALES, select=f"SELECT {_BEST}, avg_price FROM articles JOIN sales USING (article_id) ORDER BY num_transactions DESC, article_id LIMIT 20"),
)
def bestsellers(x: Inputs) -> DataFrame:
    sales = gold.article_sales(x.t)
    return rounded(dashboard.bestsellers(x.articles, sales), "total_revenue", "avg_price")


@query(
    "bestsellers_filtered",
    sql(
        SALES,
        select=f"""SELECT {_BEST}, avg_price FROM articles JOIN sales USING (article_id)
        WHERE last_purchase_date >= DATE '2001-05-01' AND last_purchase_date <= DATE '2001-07-25' AND product_group_name = 'Shoes'
        ORDER BY num_transactions DESC, article_id LIMIT 100""",
    ),
)
def bestsellers_filtered(x: Inputs) -> DataFrame:
    sales = gold.article_sales(x.t)
    found = dashboard.bestsellers(x.articles, sales, "2001-05-01", "2001-07-25", "Shoes", 100)
    return rounded(found, "total_revenue", "avg_price")


def _with_counts(page: DataFrame, counts: DataFrame) -> DataFrame:
    return page.withColumns({c: counts.select(c).scalar() for c in ("total_count", "total_pages")})


def _paged(columns: str, source: str, order: str, size: int, offset: int) -> str:
    return f"""SELECT {columns}, count(*) OVER () AS total_count, CAST(ceil(count(*) OVER () / {size}) AS BIGINT) AS total_pages
        FROM {source} ORDER BY {order} LIMIT {size} OFFSET {offset}"""


@query(
    "product_explorer",
    sql(
        SALES,
        select=_paged(
            """article_id, prod_name, product_type_name, product_group_name, colour_group_name, department_name,
            coalesce(detail_desc, '-') AS detail_desc, coalesce(num_transactions, 0) AS num_transactions,
            coalesce(total_revenue, 0) AS total_revenue, coalesce(unique_customers, 0) AS unique_customers""",
            """articles LEFT JOIN sales USING (article_id) WHERE (prod_name LIKE '%e%' OR detail_desc LIKE '%e%')
            AND product_group_name = 'Shoes'""",
            "coalesce(num_transactions, 0) DESC, article_id",
            24,
            24,
        ),
    ),
)
def product_explorer(x: Inputs) -> DataFrame:
    page, counts = dashboard.product_explorer(x.articles, gold.article_sales(x.t), search="e", category="Shoes", page=2)
    return rounded(_with_counts(page, counts), "total_revenue").fillna({"detail_desc": "-"})


@query(
    "transaction_lookup",
    sql(
        select=_paged(
            """t_dat, customer_id, article_id, price, sales_channel_id, prod_name, product_group_name, colour_group_name,
            department_name, transaction_id""",
            """t JOIN articles USING (article_id) WHERE customer_id LIKE '%00001%' AND product_group_name = 'Accessories'
            AND t_dat >= DATE '1996-01-01' AND t_dat <= DATE '2001-07-01'""",
            "t_dat DESC, transaction_id",
            20,
            20,
        )
    ),
)
def transaction_lookup(x: Inputs) -> DataFrame:
    page, counts = dashboard.transaction_lookup(
        x.t, x.articles, "00001", "Accessories", "ALL", "1996-01-01", "2001-07-01", page=2, known_articles=True
    )
    return _with_counts(page, counts)


@query(
    "customer_list",
    sql(
        DEMOGRAPHICS,
        select=_paged(
            """customer_id, age_bin, coalesce(club_member_status, '-') AS club_member_status,
            coalesce(fashion_news_frequency, '-') AS fashion_news_frequency, total_spent, num_purchases""",
            "demographics WHERE customer_id LIKE '%01%'",
            "total_spent DESC, customer_id",
            20,
            0,
        ),
    ),
)
def customer_list(x: Inputs) -> DataFrame:
    page, counts = dashboard.customer_list(gold.customer_demographics(x.customers, x.t), "01")
    return rounded(_with_counts(page, counts), "total_spent").fillna("-")


@query(
    "filter_options",
    sql(
        select="""SELECT 'category' AS filter, CAST(1 AS INTEGER) AS position, product_group_name AS value FROM articles WHERE product_group_name IS NOT NULL
        UNION SELECT 'color', 1, colour_group_name FROM articles WHERE colour_group_name IS NOT NULL
        UNION SELECT 'department', 1, department_name FROM articles WHERE department_name IS NOT NULL
        UNION SELECT f, 0, 'ALL' FROM (VALUES ('category'), ('color'), ('department')) AS v(f)"""
    ),
)
def filter_options(x: Inputs) -> DataFrame:
    return dashboard.filter_options(x.articles)
