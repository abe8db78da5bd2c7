"""Queries over recommenders, evaluation, scoring, sequences and the classifier."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.config import PairSampling
from basketflow.functions import encoding
from basketflow.functions.encoding import FEATURES
from basketflow.functions.sampling import portable_hash
from basketflow.operators import contexts, dashboard, evaluate, labels, pairs, recommend, sequences
from basketflow.plans import deployment, evaluation, neural, propensity, scoring
from basketflow.plans.model_registry import ModelRegistry
from basketflow.registry import models
from basketflow.registry.common import E_CUTS, MODELS, Inputs, as_text, query, r4, rounded, sql, truth_sql
from basketflow.registry.rows import ARTICLE_CODES, CUSTOMER_CODES
from basketflow.session import materialize, scratch_path

_VAL = truth_sql("2024-01-15", "2024-01-22")
_TEST = truth_sql("2024-01-22", "2024-01-29")


def _truth(x: Inputs, which: str = "val") -> DataFrame:
    return materialize(labels.truth_pairs(x.e, *E_CUTS.truth_window(which)), "truth")


@query("decayed_popularity", sql(MODELS, select="SELECT article_id, round(popularity_score + 1e-9, 6) AS popularity_score, purchase_count FROM pop"))
def decayed_popularity(x: Inputs) -> DataFrame:
    return models.popularity(x).withColumn("popularity_score", r4("popularity_score", 6))


@query("segment_top_n", sql(MODELS, select="SELECT age_group, article_id, segment_purchases, rank FROM age_list"))
def segment_top_n(x: Inputs) -> DataFrame:
    return models.segment_lists(x)


def _lists_of(name: str) -> str:
    return sql(MODELS, select=f"SELECT customer_id, predicted_articles FROM lists WHERE model_name = '{name}'")


def _text_lists(df: DataFrame) -> DataFrame:
    return df.select("customer_id", as_text("predicted_articles").alias("predicted_articles"))


@query("popularity_predict", _lists_of("popularity"))
def popularity_predict(x: Inputs) -> DataFrame:
    return _text_lists(recommend.popularity_predict(x.customers, models.popularity(x)))


@query("age_rules_predict", _lists_of("age_rules"))
def age_rules_predict(x: Inputs) -> DataFrame:
    return _text_lists(recommend.age_rules_predict(x.segments, models.segment_lists(x)))


@query("next_item_recommend", _lists_of("next_item"))
def next_item_recommend(x: Inputs) -> DataFrame:
    return _text_lists(recommend.next_item_recommend(x.e_train, recommend.transitions(x.e_train)))


@query("ensemble_blend", _lists_of("ensemble"))
def ensemble_blend(x: Inputs) -> DataFrame:
    fitted = models.fitted(x)
    popular = {"popularity": recommend.popular_list(fitted["popularity"])}
    return _text_lists(recommend.ensemble_blend(models.predictions_of(x, fitted), models.WEIGHTS, for_all=popular))


@query(
    "average_precision_at_k",
    sql(MODELS, _VAL, select="SELECT model_name, customer_id, num_purchases, round(ap12 + 1e-9, 6) AS ap FROM ap"),
)
def average_precision_at_k(x: Inputs) -> DataFrame:
    found = evaluate.average_precision_at_k(models.all_predictions(x), _truth(x))
    return found.withColumn("ap", r4("ap", 6))


@query(
    "map_at_k",
    sql(
        MODELS,
        _VAL,
        select="""SELECT round(avg(ap12) + 1e-9, 6) AS map_at_12, round(avg(ap5) + 1e-9, 6) AS map_at_5, count(*) AS num_evaluated
        FROM ap WHERE model_name = 'popularity'""",
    ),
)
def map_at_k(x: Inputs) -> DataFrame:
    """Decayed popularity, fitted on the training purchases and scored on the validation window."""
    predicted = recommend.popularity_predict(x.customers, models.popularity(x))
    found = evaluate.map_at_k(predicted, _truth(x))
    return found.withColumns({c: r4(c, 6) for c in ("map_at_12", "map_at_5")})


_COVERAGE = """
coverage AS (
  SELECT model_name, count(DISTINCT article_id) / (SELECT count(DISTINCT article_id) FROM truth) AS c FROM preds GROUP BY 1),
sizes AS (SELECT model_name, count(*) AS num_customers FROM listed GROUP BY 1),
maps AS (SELECT model_name, avg(ap12) AS m12, avg(ap5) AS m5 FROM ap GROUP BY 1)
"""


@query(
    "eval_report",
    sql(
        MODELS,
        _VAL,
        _COVERAGE,
        select="""SELECT model_name, round(m12 + 1e-9, 6) AS map_at_12, round(m5 + 1e-9, 6) AS map_at_5, round(c + 1e-9, 6) AS catalog_coverage, num_customers
        FROM maps JOIN coverage USING (model_name) JOIN sizes USING (model_name)""",
    ),
)
def eval_report(x: Inputs) -> DataFrame:
    found = evaluate.eval_report(models.all_predictions(x), _truth(x))
    return found.withColumns({c: r4(c, 6) for c in ("map_at_12", "map_at_5", "catalog_coverage")})


@query(
    "model_comparison",
    sql(
        MODELS,
        _VAL,
        _COVERAGE,
        select="""SELECT model_name, round(m12 + 1e-9, 6) AS map, CAST(rank() OVER (ORDER BY m12 DESC) AS INTEGER) AS place,
        rank() OVER (ORDER BY m12 DESC) = 1 AS is_best,
        CASE WHEN model_name = 'ensemble' THEN round(100.0::DOUBLE * (m12 - (SELECT max(m12) FROM maps WHERE model_name <> 'ensemble'))
          / (SELECT max(m12) FROM maps WHERE model_name <> 'ensemble') + 1e-9, 4) ELSE 0 END AS gain_pct FROM maps""",
    ),
)
def model_comparison(x: Inputs) -> DataFrame:
    found = evaluate.model_comparison(models.all_predictions(x), _truth(x), "ensemble")
    return found.withColumns({"map": r4("map", 6), "gain_pct": F.coalesce(r4("gain_pct"), F.lit(0.0))})


def _registered(x: Inputs) -> ModelRegistry:
    """Versions fitted on the purchase events, some with aliases, in a table of their own."""
    tables = {name: {"followers" if name == "next_item" else "ranked": df} for name, df in models.fitted(x).items()}
    aged = ("customer_id", "age_group")
    registry = ModelRegistry(x.spark, scratch_path(x.spark, "models"))
    for top_k in ("5", "8", "12"):
        registry.register("popularity", "popularity", tables["popularity"], params={"top_k": top_k})
    for _ in range(2):
        registry.register("age_rules", "age_rules", tables["age_rules"], aged)
    registry.register("next_item", "next_item", tables["next_item"])
    registry.register("purchase_propensity", "not a list", {})
    registry.register("broken", "not known", {})
    registry.set_alias("popularity", "champion", 3, None)
    registry.set_alias("age_rules", "Champion", 2, None)
    registry.set_alias("next_item", "Champion", 1, None)
    registry.set_alias("purchase_propensity", "Challenger", 1, None)
    registry.set_alias("broken", "Champion", 1, None)
    return registry


def _purchases(x: Inputs) -> dict[str, DataFrame]:
    return {"purchases": x.e_train.select("customer_id", "article_id", "t_dat", "transaction_id")}


@query(
    "model_deployment",
    sql(
        MODELS,
        _VAL,
        """scores AS (
  SELECT v AS version, kind, round(CASE kind WHEN 'age_rules' THEN (SELECT avg(coalesce(ap12, 0)) FROM bought b
      LEFT JOIN (SELECT * FROM ap WHERE model_name = 'age_rules') a USING (customer_id))
    ELSE (SELECT avg(ap12) FROM ap WHERE model_name = kind) END, 9) AS score
  FROM (VALUES (1, 'age_rules'), (2, 'next_item'), (3, 'popularity')) AS t(v, kind)),
best AS (
  SELECT *, max(score) OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM scores),
passing AS (SELECT *, before IS NULL OR score > before AS passed FROM best)""",
        select="""SELECT CAST(version AS INTEGER) AS version, kind, round(score + 1e-9, 6) AS map_at_12, passed,
        CAST(max(CASE WHEN passed THEN version END) OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS INTEGER) AS champion_before,
        CASE WHEN version = max(CASE WHEN passed THEN version END) OVER () THEN 'Champion' ELSE '' END AS aliases FROM passing""",
    ),
)
def model_deployment(x: Inputs) -> DataFrame:
    """Three versions of one model go through the gate one after the other; the table afterwards."""
    fitted, sources = models.fitted(x), _purchases(x)
    registry = ModelRegistry(x.spark, scratch_path(x.spark, "deployments"))
    registry.register("recommender", "age_rules", {"ranked": fitted["age_rules"]}, ("customer_id", "age_group"))
    registry.register("recommender", "next_item", {"followers": fitted["next_item"]})
    registry.register("recommender", "popularity", {"ranked": fitted["popularity"]})
    made = [deployment.deploy(registry, "recommender", v, sources, x.e, x.segments, E_CUTS) for v in (1, 2, 3)]
    decisions = x.spark.createDataFrame(
        [(d.candidate, d.candidate_score, d.moved, d.champion) for d in made],
        "version int, map_at_12 double, passed boolean, champion_before int",
    )
    found = registry.table().join(decisions, "version").withColumn("map_at_12", r4("map_at_12", 6))
    return found.select("version", "kind", "map_at_12", "passed", "champion_before", F.concat_ws(" ", "aliases").alias("aliases"))


@query(
    "deployment_evaluation",
    sql(
        MODELS,
        _TEST,
        """candidates AS (SELECT customer_id, num_purchases FROM bought),
scored AS (
  SELECT c.customer_id, coalesce(any_value(ap12), 0) AS ap12, coalesce(any_value(ap5), 0) AS ap5 FROM candidates c
  LEFT JOIN (SELECT * FROM ap WHERE model_name = 'age_rules') a USING (customer_id) GROUP BY 1),
seen AS (
  SELECT count(DISTINCT article_id) AS n FROM preds WHERE model_name = 'age_rules' AND customer_id IN (SELECT customer_id FROM candidates))""",
        select="""SELECT 'age_rules' AS model_name, '2' AS model_version, 'test' AS dataset, round(avg(ap12) + 1e-9, 6) AS map_at_12,
        round(avg(ap5) + 1e-9, 6) AS map_at_5, round((SELECT n FROM seen) / (SELECT count(DISTINCT article_id) FROM truth) + 1e-9, 6) AS catalog_coverage,
        count(*) AS num_customers FROM scored""",
    ),
)
def deployment_evaluation(x: Inputs) -> DataFrame:
    registry = _registered(x)
    champion = registry.model("age_rules", registry.current("age_rules", "Champion"))
    report = evaluation.deployment_evaluation(champion, x.e, x.segments, E_CUTS, "test")
    return report.withColumns({c: r4(c, 6) for c in ("map_at_12", "map_at_5", "catalog_coverage")})


def _scored(x: Inputs) -> tuple[DataFrame, DataFrame]:
    registered = _registered(x).models(_purchases(x))
    return scoring.batch_scoring(x.segments, registered, "20240108_000000", "2024-01-08 00:00:00")


_SCORED = """
scored AS (
  SELECT s.customer_id, m.model_name, m.model_version, coalesce(l.predicted_articles, '') AS predicted_articles
  FROM seg s CROSS JOIN (VALUES ('popularity', '3'), ('age_rules', '2')) AS m(model_name, model_version)
  LEFT JOIN lists l ON l.customer_id = s.customer_id AND l.model_name = m.model_name
  UNION ALL SELECT customer_id, model_name, '1', predicted_articles FROM lists
  WHERE model_name = 'next_item' AND customer_id IN (SELECT customer_id FROM customers))
"""


@query(
    "batch_scoring",
    sql(
        MODELS,
        _SCORED,
        select="SELECT *, 'Champion' AS model_alias, '20240108_000000' AS batch_id FROM scored",
    ),
)
def batch_scoring(x: Inputs) -> DataFrame:
    predictions, _ = _scored(x)
    return predictions.drop("prediction_timestamp").withColumn("predicted_articles", as_text("predicted_articles"))


@query(
    "batch_scoring_status",
    sql(
        MODELS,
        _SCORED,
        select="""SELECT model_name, 'SUCCESS' AS status, count(*) AS num_predictions FROM scored GROUP BY 1
        UNION ALL VALUES ('purchase_propensity', 'SKIPPED', 0), ('broken', 'FAILED', 0)""",
    ),
)
def batch_scoring_status(x: Inputs) -> DataFrame:
    return _scored(x)[1].select("model_name", "status", "num_predictions")


@query(
    "predictions_by_model",
    sql(MODELS, _SCORED, select="SELECT model_name, model_version, count(*) AS num_predictions FROM scored GROUP BY ALL"),
)
def predictions_by_model(x: Inputs) -> DataFrame:
    return scoring.predictions_by_model(_scored(x)[0])


@query(
    "predictions_union",
    sql(
        MODELS,
        select="""SELECT model_name, customer_id, predicted_articles,
        CASE WHEN model_name = 'age_rules' THEN (SELECT any_value(age_group) FROM seg s WHERE s.customer_id = lists.customer_id) ELSE '-' END AS age_group
        FROM lists WHERE model_name <> 'ensemble'""",
    ),
)
def predictions_union(x: Inputs) -> DataFrame:
    """Only the age rules carry an age group; the other models' rows get none."""
    named = [df.withColumn("model_name", F.lit(n)) for n, df in models.base_predictions(x).items()]
    union = scoring.predictions_union(named)
    return union.withColumn("predicted_articles", as_text("predicted_articles")).fillna({"age_group": "-"})


@query(
    "popular_details",
    sql(
        MODELS,
        """best AS (SELECT * FROM pop ORDER BY popularity_score DESC, article_id LIMIT 50)""",
        select="""SELECT b.article_id, product_type_name, coalesce(product_group_name, '-') AS product_group_name, colour_group_name,
        round(popularity_score + 1e-9, 6) AS popularity_score, purchase_count FROM best b LEFT JOIN articles USING (article_id)""",
    ),
)
def popular_details(x: Inputs) -> DataFrame:
    found = recommend.popular_details(models.popularity(x), x.articles)
    return found.withColumn("popularity_score", r4("popularity_score", 6)).fillna("-")


@query(
    "prediction_enrichment",
    sql(
        MODELS,
        """texts AS (
  SELECT model_name, customer_id, article_id, rank - 1 AS position FROM base
  UNION ALL SELECT model_name, customer_id, 999999999, n FROM lists WHERE model_name = 'next_item' AND n < 12)""",
        select="""SELECT customer_id, model_name, CAST(position AS INTEGER) AS position, CAST(t.article_id AS VARCHAR) AS article_id,
        CASE WHEN a.article_id IS NULL THEN 'Unknown Item (' || t.article_id || ')' ELSE prod_name END AS name,
        CASE WHEN a.article_id IS NULL THEN 'Unknown' ELSE coalesce(product_group_name, '-') END AS category,
        CASE WHEN a.article_id IS NULL THEN '' ELSE coalesce(detail_desc, '-') END AS description,
        '/volume/images/' || substr(lpad(CAST(t.article_id AS VARCHAR), 10, '0'), 1, 3) || '/' || lpad(CAST(t.article_id AS VARCHAR), 10, '0') || '.jpg' AS image_path
        FROM texts t LEFT JOIN articles a ON a.article_id = t.article_id""",
    ),
)
def prediction_enrichment(x: Inputs) -> DataFrame:
    """Lists written in three notations, the last with an id that is no article."""
    base = models.base_predictions(x)
    commas = F.concat(F.lit("["), F.array_join(F.col("predicted_articles").cast("array<string>"), ", "), F.lit("]"))
    quotes = F.concat(F.lit("['"), F.array_join(F.col("predicted_articles").cast("array<string>"), "','"), F.lit("']"))
    spaces = F.concat(as_text("predicted_articles"), F.lit(" 999999999"))
    texts = {"popularity": commas, "age_rules": quotes, "next_item": spaces}
    frames = [
        df.select(
            "customer_id",
            texts[name].alias("predicted_articles"),
            F.lit(name).alias("model_name"),
            F.lit("1").alias("model_version"),
            F.lit("Champion").alias("model_alias"),
            F.lit("2024-01-08 00:00:00").cast("timestamp").alias("prediction_timestamp"),
            F.lit("20240108_000000").alias("batch_id"),
        )
        for name, df in base.items()
    ]
    found = dashboard.prediction_enrichment(reduce(DataFrame.unionByName, frames), x.articles)
    return found.drop("model_version", "model_alias", "prediction_timestamp", "batch_id").fillna("-")


VOCABULARY = "vocabulary AS (SELECT article_id, row_number() OVER (ORDER BY article_id) AS article_index FROM (SELECT DISTINCT article_id FROM t))"


@query("article_vocabulary", sql(VOCABULARY, select="SELECT article_id, article_index FROM vocabulary"))
def article_vocabulary(x: Inputs) -> DataFrame:
    return sequences.article_vocabulary(x.t)


SEQUENCES = """
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY t_dat, transaction_id) AS i,
    count(*) OVER (PARTITION BY customer_id) AS n FROM e)
"""


@query(
    "customer_sequences",
    sql(
        SEQUENCES,
        select="""SELECT customer_id, string_agg(CAST(article_id AS VARCHAR), ' ' ORDER BY i) FILTER (i > n - 10) AS sequence,
        n AS sequence_length FROM ordered WHERE n >= 2 GROUP BY customer_id, n""",
    ),
)
def customer_sequences(x: Inputs) -> DataFrame:
    return sequences.customer_sequences(x.e).withColumn("sequence", as_text("sequence"))


@query(
    "training_sequences",
    sql(
        SEQUENCES,
        select="""SELECT customer_id, string_agg(CAST(article_id AS VARCHAR), ' ' ORDER BY i) FILTER (i > n - 11 AND i < n) AS input_sequence,
        string_agg(CAST(article_id AS VARCHAR), ' ' ORDER BY i) FILTER (i = n) AS target_articles FROM ordered WHERE n >= 11 GROUP BY customer_id""",
    ),
)
def training_sequences(x: Inputs) -> DataFrame:
    found = sequences.training_sequences(x.e)
    return found.withColumns({c: as_text(c) for c in ("input_sequence", "target_articles")})


@query(
    "pad_encode_sequences",
    sql(
        SEQUENCES,
        VOCABULARY,
        select="""SELECT customer_id, repeat('0 ', greatest(0, 10 - n)::INTEGER) ||
        string_agg(CAST(coalesce(article_index, 0) AS VARCHAR), ' ' ORDER BY i) FILTER (i > n - 10) AS encoded
        FROM ordered LEFT JOIN vocabulary USING (article_id) WHERE n >= 2 GROUP BY customer_id, n""",
    ),
)
def pad_encode_sequences(x: Inputs) -> DataFrame:
    """Event purchases encoded with the vocabulary of the order lines."""
    vocabulary = sequences.article_vocabulary(x.t)
    found = sequences.pad_encode_sequences(sequences.customer_sequences(x.e), vocabulary)
    return found.withColumn("encoded", as_text("encoded"))


_HISTORIES = """
histories AS (
  SELECT customer_id, list(article_id ORDER BY back DESC) AS s, any_value(n) AS n FROM (
    SELECT customer_id, article_id, row_number() OVER (PARTITION BY customer_id ORDER BY t_dat DESC, transaction_id DESC) AS back,
      count(*) OVER (PARTITION BY customer_id) AS n FROM e_train)
  WHERE back <= 11 GROUP BY customer_id),
steps AS (SELECT s, unnest(range(1, len(s) + 1)) AS i FROM histories WHERE n >= 2),
examples AS (SELECT *, unnest(range(0, least(i - 1, 10) + 1)) AS o FROM steps),
followers AS (
  SELECT CASE WHEN o > 0 THEN s[i - o : i - 1] ELSE [] END AS ctx, s[i] AS article_id, count(*) AS c FROM examples GROUP BY ALL),
contexts AS (SELECT ctx, sum(c) AS times, count(*) AS kinds FROM followers GROUP BY ctx),
kept AS (SELECT * FROM followers QUALIFY row_number() OVER (PARTITION BY ctx ORDER BY c DESC, article_id) <= 12),
ends AS (SELECT customer_id, s, unnest(range(0, least(len(s), 10) + 1)) AS o FROM histories),
levels AS (
  SELECT customer_id, o, times, kinds, ctx,
    coalesce(product(CAST(kinds AS DOUBLE) / (times + kinds)) OVER (PARTITION BY customer_id ORDER BY o DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS share
  FROM ends JOIN contexts ON ctx = CASE WHEN o > 0 THEN s[len(s) - o + 1 : len(s)] ELSE [] END),
context_scores AS (
  SELECT customer_id, article_id, round(sum(share * c / (times + kinds)), 12) AS score FROM levels JOIN kept USING (ctx) GROUP BY ALL),
context_lists AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, article_id) AS rank FROM context_scores QUALIFY rank <= 12)
"""


@query(
    "sequence_recommend",
    sql(
        MODELS,
        _HISTORIES,
        select="""SELECT customer_id, string_agg(CAST(article_id AS VARCHAR), ' ' ORDER BY rank) AS predicted_articles
        FROM context_lists GROUP BY customer_id""",
    ),
)
def sequence_recommend(x: Inputs) -> DataFrame:
    return _text_lists(contexts.sequence_recommend(x.e_train, contexts.fit(x.e_train)))


@query(
    "article_attribute_lookup",
    sql(
        VOCABULARY,
        select="""SELECT article_index, article_id, product_type_no, coalesce(product_group_name, '-') AS product_group_name,
        coalesce(colour_group_code, -1) AS colour_group_code, section_no, coalesce(garment_group_no, -1) AS garment_group_no
        FROM vocabulary JOIN articles USING (article_id)""",
    ),
)
def article_attribute_lookup(x: Inputs) -> DataFrame:
    found = sequences.article_attribute_lookup(x.articles, sequences.article_vocabulary(x.t))
    flat = found.select("article_index", "attributes.*")
    return flat.fillna({"product_group_name": "-", "colour_group_code": -1, "garment_group_no": -1})


def pairs_sql(prefix: str, where: str) -> str:
    """Training pairs by brute force: the unbought articles of each customer are listed and numbered."""
    return f"""
{prefix}bought AS (SELECT DISTINCT customer_id, article_id FROM e WHERE {where}),
{prefix}wanted AS (
  SELECT customer_id, CAST(round(count(*) * 2.0) AS BIGINT) AS wanted,
    (SELECT count(*) FROM articles) - count(*) FILTER (article_id IN (SELECT article_id FROM articles)) AS free
  FROM {prefix}bought GROUP BY 1),
{prefix}unbought AS (
  SELECT w.customer_id, a.article_id, row_number() OVER (PARTITION BY w.customer_id ORDER BY a.article_id) - 1 AS j
  FROM {prefix}wanted w CROSS JOIN articles a ANTI JOIN {prefix}bought b ON b.customer_id = w.customer_id AND b.article_id = a.article_id),
{prefix}draws AS (
  SELECT customer_id, (CAST('0x' || substr(md5('42|' || customer_id), 1, 10) AS BIGINT) % free
    + CAST(floor(k * free / least(wanted, free)) AS BIGINT)) % free AS j
  FROM (SELECT *, unnest(range(least(wanted, free))) AS k FROM {prefix}wanted)),
{prefix}pairs AS (
  SELECT customer_id, article_id, CAST(1 AS INTEGER) AS label FROM {prefix}bought
  UNION ALL SELECT customer_id, article_id, 0 FROM {prefix}draws JOIN {prefix}unbought USING (customer_id, j)),
{prefix}full AS (
  SELECT * FROM {prefix}pairs JOIN customer_codes USING (customer_id) JOIN article_codes USING (article_id))
"""


_TRAIN_PAIRS = pairs_sql("tr_", "t_dat <= DATE '2024-01-08'")
_VAL_PAIRS = pairs_sql("va_", "t_dat > DATE '2024-01-08' AND t_dat <= DATE '2024-01-15'")


def _pairs(x: Inputs, transactions: DataFrame, sampling: PairSampling = PairSampling()) -> DataFrame:
    customer_codes, article_codes = encoding.encode_customers(x.customers), encoding.encode_articles(x.articles)
    return pairs.training_pairs(transactions, customer_codes, article_codes, sampling, portable_hash)


def _val_pairs(x: Inputs) -> DataFrame:
    """All pairs of the validation window: what is checked is never sampled."""
    return _pairs(x, labels.temporal_split(x.e, E_CUTS)["val"], PairSampling(max_samples=None))


@query("training_pairs", sql(CUSTOMER_CODES, ARTICLE_CODES, _TRAIN_PAIRS, select="SELECT * FROM tr_full"))
def training_pairs(x: Inputs) -> DataFrame:
    return _pairs(x, x.e_train)


_SCALED = ", ".join(
    f"round((v.{c} - s.mean_{c}) / CASE WHEN s.std_{c} > 0 THEN s.std_{c} ELSE 1 END + 1e-9, 4) AS {c}" for c in FEATURES
)
_MOMENTS = ", ".join(f"avg({c}) AS mean_{c}, stddev_pop({c}) AS std_{c}" for c in FEATURES)


@query(
    "standardize",
    sql(
        CUSTOMER_CODES,
        ARTICLE_CODES,
        _TRAIN_PAIRS,
        _VAL_PAIRS,
        f"moments AS (SELECT {_MOMENTS} FROM tr_full)",
        select=f"SELECT customer_id, article_id, label, {_SCALED} FROM va_full v, moments s",
    ),
)
def standardize(x: Inputs) -> DataFrame:
    scaled = pairs.standardize(_pairs(x, x.e_train), _val_pairs(x))
    return rounded(scaled, *FEATURES)


# A coefficient per input, in order, and the intercept: what a fitted model would bring.
_FIXED = dict(zip(FEATURES, [0.25, -0.5, 0.125, 0.375, -0.25, 0.5, -0.125, 0.0625], strict=True))
_INTERCEPT = -0.75
_LINEAR = " + ".join(
    f"{w} * (v.{c} - s.mean_{c}) / CASE WHEN s.std_{c} > 0 THEN s.std_{c} ELSE 1 END" for c, w in _FIXED.items()
)
_CANDIDATES = ", ".join(f"('{name}')" for name in propensity.REGULARIZATION)


@query(
    "purchase_propensity",
    sql(
        CUSTOMER_CODES,
        ARTICLE_CODES,
        _TRAIN_PAIRS,
        _VAL_PAIRS,
        f"moments AS (SELECT {_MOMENTS} FROM tr_full)",
        f"scored AS (SELECT label, 1 / (1 + exp(-({_INTERCEPT} + {_LINEAR}))) AS p FROM va_full v, moments s)",
        select=f"""SELECT 'fixed' AS candidate, count(*) AS num_pairs,
        round(avg(CASE WHEN (p > 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END) + 1e-9, 4) AS accuracy,
        round(avg(-CASE WHEN label = 1 THEN ln(p) ELSE ln(1 - p) END) + 1e-9, 4) AS log_loss FROM scored
        UNION ALL SELECT candidate, (SELECT count(*) FROM scored), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
        FROM (VALUES {_CANDIDATES}) AS c(candidate)""",
    ),
)
def purchase_propensity(x: Inputs) -> DataFrame:
    """Quality of fixed coefficients on all validation pairs, and the pairs every fitted candidate is judged on.

    The figures of fitted candidates depend on the optimiser's steps and are left out here.
    """
    # Every use would join the pairs to their codes again.
    train, val = materialize(_pairs(x, x.e_train), "pairs"), materialize(_val_pairs(x), "val-pairs")
    quality = propensity.quality(propensity.fixed_score(pairs.standardize(train, val), _FIXED, _INTERCEPT))
    fixed = rounded(quality.select(F.lit("fixed").alias("candidate"), "num_pairs", "accuracy", "log_loss"), "accuracy", "log_loss")
    _, report = propensity.train_propensity(train, val)
    missing = F.lit(None).cast("double")
    return fixed.unionByName(report.select("candidate", "num_pairs", missing.alias("accuracy"), missing.alias("log_loss")))


# Weights of a small network (two hidden layers), as a fitted one would bring.
_NETWORK = neural.Layers(
    np.array([0.25, -0.125, 0.0, 0.5, 0.0, -0.25, 0.125, 0.0]),
    [
        np.array([[0.5, -0.25, 0.125], [0.25, 0.5, -0.5], [-0.125, 0.75, 0.25], [0.5, 0.0, 0.375], [0.0, -0.5, 0.25],
                  [0.625, 0.125, -0.25], [-0.75, 0.25, 0.5], [0.125, -0.375, 0.0]]),
        np.array([[0.5, -0.5], [-0.25, 0.75], [0.375, 0.125]]),
        np.array([[0.75], [-0.5]]),
    ],
    [np.array([0.125, -0.25, 0.5]), np.array([0.0, 0.25]), np.array([-0.625])],
)
_NETWORK_EPOCHS = 2


def _network_sql() -> str:
    """The forward pass of ``_NETWORK`` over scaled pairs, layer by layer."""
    def weighted(names: list[str], weights: list[float], offset: float) -> str:
        return " + ".join([f"({offset})", *(f"({w}) * {n}" for n, w in zip(names, weights, strict=True))])

    names, steps, source = list(FEATURES), [], "scaled_pairs"
    carried = f"label, {weighted(names, _NETWORK.linear.tolist(), 0.0)} AS linear_part"
    for layer, (matrix, offset) in enumerate(zip(_NETWORK.matrices, _NETWORK.offsets)):
        last = layer == len(_NETWORK.matrices) - 1
        made = [f"h{layer}_{j}" for j in range(matrix.shape[1])]
        sums = [weighted(names, matrix[:, j].tolist(), offset[j]) for j in range(matrix.shape[1])]
        columns = ", ".join(f"{s if last else f'greatest({s}, 0)'} AS {n}" for s, n in zip(sums, made))
        steps.append(f"layer{layer} AS (SELECT {carried}, {columns} FROM {source})")
        names, source, carried = made, f"layer{layer}", "label, linear_part"
    return ", ".join([*steps, f"scored AS (SELECT label, 1 / (1 + exp(-({names[0]} + linear_part))) AS p FROM {source})"])


_UNROUNDED = ", ".join(f"(v.{c} - s.mean_{c}) / CASE WHEN s.std_{c} > 0 THEN s.std_{c} ELSE 1 END AS {c}" for c in FEATURES)


@query(
    "neural_propensity",
    sql(
        CUSTOMER_CODES,
        ARTICLE_CODES,
        _TRAIN_PAIRS,
        _VAL_PAIRS,
        f"moments AS (SELECT {_MOMENTS} FROM tr_full)",
        f"scaled_pairs AS (SELECT label, {_UNROUNDED} FROM va_full v, moments s)",
        _network_sql(),
        select=f"""SELECT 'fixed' AS step, count(*) AS num_pairs,
        round(avg(CASE WHEN (p > 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END) + 1e-9, 4) AS accuracy,
        round(avg(-CASE WHEN label = 1 THEN ln(p) ELSE ln(1 - p) END) + 1e-9, 4) AS log_loss FROM scored
        UNION ALL SELECT 'epoch ' || e, (SELECT count(*) FROM scored), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
        FROM range({_NETWORK_EPOCHS + 1}) AS t(e)""",
    ),
)
def neural_propensity(x: Inputs) -> DataFrame:
    """Quality of fixed weights on all validation pairs, and the pairs that each fitted epoch is judged on.

    The losses of the fitted epochs depend on the order of floating sums and are left out here.
    """
    train, val = materialize(_pairs(x, x.e_train), "pairs"), materialize(_val_pairs(x), "val-pairs")
    found = neural.forward_quality(pairs.standardize(train, val), _NETWORK)
    fixed = found.select(F.lit("fixed").alias("step"), "num_pairs", r4("accuracy").alias("accuracy"), r4("log_loss").alias("log_loss"))
    _, curve = neural.train_network(train, val, hidden=(16, 8), epochs=_NETWORK_EPOCHS, batches=2)
    missing = F.lit(None).cast("double")
    epoch = F.concat(F.lit("epoch "), F.col("epoch").cast("string")).alias("step")
    return fixed.unionByName(curve.select(epoch, "num_pairs", missing.alias("accuracy"), missing.alias("log_loss")))
