"""Registry of the core queries and, for each that SQL can express, its SQL for the side-by-side check."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.config import DEFAULT
from quern.domain import load
from quern.functions import text as tx
from quern.functions.metrics import ratio
from quern.operators import dedup, quality, scoring, upsert
from quern.operators.timestamps import learned_orders, normalize_timestamps
from quern.oracle import AS_OF, chain, nss
from quern.oracle import ratio as sql_ratio
from quern.plans import cards, marts, staging
from quern.session import materialize, spread, table
from quern.sources import connectors
from quern.streaming import intake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
PACK = load()


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = chain(sql)
        return f

    return add


ORACLE_INTAKE = """WITH f AS (SELECT *, trim(concat_ws(' ', title, body)) = '' AS empty, source_platform = 'news' AND coalesce(relevance_score, 0) <= 1e-9 AS irrelevant FROM raw_documents),
u AS (SELECT doc_uid, min(document_id) AS first FROM f WHERE NOT empty AND NOT irrelevant GROUP BY 1),
l AS (SELECT f.*, first FROM f LEFT JOIN u USING (doc_uid)),
c AS (SELECT lower(content_hash) AS h, min(document_id) AS cfirst FROM l WHERE NOT empty AND NOT irrelevant AND document_id = first GROUP BY 1)
SELECT document_id, CASE WHEN empty THEN 'empty' WHEN irrelevant THEN 'irrelevant' WHEN document_id = first AND (content_hash IS NULL OR document_id = cfirst) THEN 'new' ELSE 'duplicate' END AS outcome FROM l LEFT JOIN c ON lower(content_hash) = h"""


class Models:
    """The staged frames and marts over one folder, each built once on first use; all of them are lazy plans."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = getattr(self, f"_{name}")() if hasattr(type(self), f"_{name}") else table(self.spark, self.dir, name)
        return self._made[name]

    def _stg_documents(self):
        return staging.stg_documents(self.raw_documents)

    def _stg_sentiment(self):
        return staging.stg_sentiment(self.document_sentiment)

    def _stg_aspects(self):
        return staging.stg_aspects(self.document_aspect_sentiment, self.dim_aspect)

    def _stg_runs(self):
        return staging.stg_runs(self.ingestion_runs)

    def _stg_quality(self):
        return staging.stg_quality(self.data_quality_results)

    def _scored(self):
        return staging.scored_documents(self.stg_documents, self.stg_sentiment)

    def _sentiment_daily(self):
        return marts.sentiment_daily(self.scored)

    def _aspect_daily(self):
        return marts.aspect_daily(self.stg_aspects, self.scored)

    def _document_feed(self):
        return marts.document_feed(self.scored, self.stg_aspects)

    def _review_queue(self):
        return marts.review_queue(self.scored, self.stg_aspects)

    def _sentiment_alerts(self):
        return marts.sentiment_alerts(self.aspect_daily)

    def _engine_quality(self):
        return marts.engine_quality(self.scored)

    def _pipeline_health(self):
        return marts.pipeline_health(self.stg_runs, self.stg_quality)


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and instants as microseconds, so that both engines return the same types."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        out.append(F.col(f.name).cast("double").alias(f.name) if kind.startswith("decimal") else (F.unix_micros(f.name).alias(f.name) if kind == "timestamp" else F.col(f.name)))
    return df.select(*out)


def _dbl(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


# --- timestamps -------------------------------------------------------------------------------------------------


@query("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = normalize_timestamps(table(spark, sf_dir, "raw_documents"), table(spark, sf_dir, "source_catalog"))
    return found.filter(F.col("utc_micros").isNotNull()).select("document_id", "utc_micros")


@query("p6_orders")
def p6_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date order that the mixture learns for each source without being told, beside the one that the catalogue states."""
    return learned_orders(spread(table(spark, sf_dir, "raw_documents")), table(spark, sf_dir, "source_catalog"))


@query("p6_status")
def p6_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the texts of each source were read."""
    found = normalize_timestamps(table(spark, sf_dir, "raw_documents"), table(spark, sf_dir, "source_catalog"))
    return found.groupBy("source_name", "format", "status").agg(F.count(F.lit(1)).alias("n_rows"), F.min("posterior").alias("least_posterior"))


# --- staging ----------------------------------------------------------------------------------------------------

_DOC_COLS = ["document_id", "doc_uid", "source_platform", "source_name", "title", "body", "author", "is_synthetic", "is_adversarial", "intended_polarity", "collector", "text_length", "engagement_score", "event_date", "event_week", "event_month", "used_ingested_at_fallback"]


@query("stg_documents", f"SELECT {', '.join(_DOC_COLS)}, epoch_us(event_at) AS event_micros FROM stg_documents")
def stg_documents(spark, d):
    return Models(spark, d).stg_documents.select(*_DOC_COLS, F.unix_micros("event_at").alias("event_micros"))


_SENT_COLS = ["document_id", "effective_label", "human_reviewed", "transformer_score", "emotion_score", "rating_score", "aspect_score", "llm_judge_score", "has_transformer_signal", "has_emotion_signal", "has_rating_signal", "escalated_to_llm", "transformer_entropy", "dominant_emotion", "signal_contributions"]


@query("stg_sentiment", f"SELECT {', '.join(_SENT_COLS)} FROM stg_sentiment")
def stg_sentiment(spark, d):
    return Models(spark, d).stg_sentiment.select(*_SENT_COLS)


@query("stg_aspects", f"SELECT document_id, aspect_code, aspect_label, aspect_group, aspect_description, mentions, aspect_sentiment, {_dbl('aspect_score')}, array_to_string(matched_keywords, ',') AS matched_keywords, window_sample FROM stg_aspects")
def stg_aspects(spark, d):
    return _plain(Models(spark, d).stg_aspects.drop("scored_at").withColumn("matched_keywords", F.array_join("matched_keywords", ",")))


@query("stg_runs", "SELECT run_id, connector, status, is_success, is_skipped, is_failure, duration_micros, fetched_count, inserted_count, duplicate_count, irrelevant_count, duplicate_rate, run_date FROM stg_runs")
def stg_runs(spark, d):
    return Models(spark, d).stg_runs.select("run_id", "connector", "status", "is_success", "is_skipped", "is_failure", "duration_micros", "fetched_count", "inserted_count", "duplicate_count", "irrelevant_count", "duplicate_rate", "run_date")


@query("stg_quality", "SELECT result_id, suite_name, expectation, column_name, success, evaluated_rows, unexpected_count, unexpected_percent, unexpected_sample, dag_run_id, check_date FROM stg_quality")
def stg_quality(spark, d):
    return Models(spark, d).stg_quality.drop("checked_at")


@query("int_scored", f"SELECT document_id, event_date, source_platform, effective_label, {_dbl('sentiment_score', 'confidence')}, is_kpi_eligible, is_positive, is_negative, is_neutral, rating_implied_label, matches_intended_polarity FROM scored")
def int_scored(spark, d):
    return _plain(Models(spark, d).scored.select("document_id", "event_date", "source_platform", "effective_label", "sentiment_score", "confidence", "is_kpi_eligible", "is_positive", "is_negative", "is_neutral", "rating_implied_label", "matches_intended_polarity"))


@query("int_scored_real", f"SELECT document_id, event_date, source_platform, {_dbl('confidence')} FROM scored WHERE NOT is_synthetic")
def int_scored_real(spark, d):
    from dataclasses import replace

    m = Models(spark, d)
    return _plain(staging.scored_documents(m.stg_documents, m.stg_sentiment, replace(DEFAULT, include_synthetic=False)).select("document_id", "event_date", "source_platform", "confidence"))


@query("signal_long", f"SELECT document_id, event_date, source_platform, effective_label, {_dbl('confidence')}, signal_name, signal_score, signal_label FROM signal_long")
def signal_long(spark, d):
    return _plain(staging.signal_contributions(Models(spark, d).scored))


# --- marts and views --------------------------------------------------------------------------------------------


@query("mart_sentiment_daily", "SELECT * FROM sentiment_daily")
def mart_sentiment_daily(spark, d):
    return Models(spark, d).sentiment_daily


@query("mart_sentiment_by_source", "SELECT * FROM by_source")
def mart_sentiment_by_source(spark, d):
    return marts.sentiment_by_source(Models(spark, d).scored)


@query("mart_aspect_daily", "SELECT * FROM aspect_daily")
def mart_aspect_daily(spark, d):
    return Models(spark, d).aspect_daily


@query("mart_aspect_source_matrix", "SELECT * FROM aspect_matrix")
def mart_aspect_source_matrix(spark, d):
    m = Models(spark, d)
    return marts.aspect_source_matrix(m.stg_aspects, m.scored)


_DEC = ("sentiment_score", "confidence", "agreement", "worst_aspect_score")


@query("mart_document_feed", f"SELECT * EXCLUDE (event_at, {', '.join(_DEC)}), epoch_us(event_at) AS event_at, {_dbl(*_DEC)} FROM feed")
def mart_document_feed(spark, d):
    return _plain(Models(spark, d).document_feed)


@query("mart_review_queue", f"SELECT * EXCLUDE (event_at, {', '.join(_DEC)}), epoch_us(event_at) AS event_at, {_dbl(*_DEC)} FROM queue")
def mart_review_queue(spark, d):
    return _plain(Models(spark, d).review_queue)


@query("mart_sentiment_alerts", "SELECT * FROM alert_rows")
def mart_sentiment_alerts(spark, d):
    return Models(spark, d).sentiment_alerts


@query("mart_engine_quality", "SELECT * FROM engine_quality")
def mart_engine_quality(spark, d):
    return Models(spark, d).engine_quality


@query("mart_pipeline_health", "SELECT * FROM pipeline_health")
def mart_pipeline_health(spark, d):
    return Models(spark, d).pipeline_health


@query("view_document_sentiment", f"""SELECT d.document_id, doc_uid, source_platform, source_name, source_type, title, body, url, author, language, rating, published_at, {_dbl('relevance_score')}, coalesce(TRY_CAST(json_extract_string(raw_payload, '$.is_synthetic') AS BOOLEAN), FALSE) AS is_synthetic,
sentiment_label, {_dbl('sentiment_score', 'confidence', 'agreement')}, requires_review, review_reason, reviewed_label, model_version, engine_mode, signals, explanation FROM raw_documents d JOIN document_sentiment s ON s.document_id = d.document_id""")
def view_document_sentiment(spark, d):
    m = Models(spark, d)
    return _plain(marts.documents_with_sentiment(m.raw_documents, m.document_sentiment))


@query("view_review_queue", f"""SELECT d.document_id, source_platform, source_name, url, published_at, coalesce(title, left(body, 160)) AS preview, sentiment_label, {_dbl('sentiment_score', 'confidence', 'agreement')}, review_reason, json_extract_string(explanation, '$.contributions') AS signal_contributions
FROM raw_documents d JOIN document_sentiment s ON s.document_id = d.document_id WHERE requires_review AND reviewed_label IS NULL""")
def view_review_queue(spark, d):
    m = Models(spark, d)
    return _plain(marts.open_reviews(m.raw_documents, m.document_sentiment))


def _on(k: str) -> str:
    return f"count(*) FILTER (WHERE TRY_CAST(json_extract_string(signals, '$.{k}.available') AS BOOLEAN)) AS {k}_available"


@query("view_engine_health", f"""SELECT *, {sql_ratio('review_count * 100', 'documents_scored', 2)} AS review_rate_pct FROM (SELECT CAST(scored_at AS DATE) AS score_date, model_version, engine_mode, count(*) AS documents_scored,
{sql_ratio('sum(CAST(confidence * 10000 AS BIGINT))', 'count(confidence) * 10000', 4)} AS avg_confidence, {sql_ratio('sum(CAST(agreement * 10000 AS BIGINT))', 'count(agreement) * 10000', 4)} AS avg_agreement, count(*) FILTER (WHERE requires_review) AS review_count, {_on('transformer')}, {_on('emotion')}, {_on('rating')}, {_on('aspect')}
FROM document_sentiment GROUP BY 1, 2, 3)""")
def view_engine_health(spark, d):
    return marts.engine_health(Models(spark, d).document_sentiment)


_NOW = f"epoch_us(CAST({AS_OF} AS TIMESTAMPTZ))"


@query("view_ingestion_freshness", f"""SELECT connector, epoch_us(max(finished_at)) AS last_run_micros, {sql_ratio(f"{_NOW} - epoch_us(max(finished_at))", "3600000000", 2)} AS hours_since_last_run, sum(inserted_count) FILTER (WHERE late) AS inserted_7d, sum(duplicate_count) FILTER (WHERE late) AS duplicates_7d,
count(*) FILTER (WHERE late AND status = 'success') AS successes_7d, count(*) FILTER (WHERE late AND status IN ('failed', 'unavailable')) AS failures_7d FROM (SELECT *, started_at >= CAST({AS_OF} - 7 AS TIMESTAMPTZ) AS late FROM ingestion_runs) GROUP BY connector""")
def view_ingestion_freshness(spark, d):
    return marts.ingestion_freshness(Models(spark, d).ingestion_runs)


# --- cards and exports ------------------------------------------------------------------------------------------

_NSS1 = nss("sum(positive_count)", "sum(negative_count)", "sum(document_count)", 1)
_ANSS1 = nss("sum(positive_count)", "sum(negative_count)", "sum(mention_documents)", 1)
_CARD_SQL = {
    "kpis": f"SELECT sum(document_count) AS documents, {_NSS1} AS nss, {sql_ratio('sum(negative_count) * 100', 'sum(document_count)', 1)} AS negative_pct FROM sentiment_daily",
    "review_count": "SELECT count(*) AS open_reviews FROM queue",
    "monthly_trend": f"SELECT CAST(date_trunc('month', event_date) AS DATE) AS month, sum(document_count) AS documents, {_NSS1} AS nss FROM sentiment_daily GROUP BY 1",
    "platform_mix": "SELECT source_platform, sum(positive_count) AS positive, sum(neutral_count) AS neutral, sum(negative_count) AS negative FROM sentiment_daily GROUP BY 1",
    "aspect_ranking": f"SELECT aspect_label, {_ANSS1} AS aspect_nss, sum(mention_documents) AS documents FROM aspect_daily GROUP BY 1",
    "aspect_trend": f"SELECT CAST(date_trunc('month', event_date) AS DATE) AS month, aspect_label, {_ANSS1} AS nss FROM aspect_daily GROUP BY 1, 2 HAVING sum(mention_documents) >= 3",
    "aspect_platform_matrix": f"SELECT *, {sql_ratio('documents * 100', 'sum(documents) OVER (PARTITION BY source_platform)', 2)} AS share_of_voice_pct FROM (SELECT aspect_label, source_platform, sum(mention_documents) AS documents, {nss('sum(positive_count)', 'sum(negative_count)', 'sum(mention_documents)')} AS nss FROM aspect_daily GROUP BY 1, 2)",
    "source_scorecard": f"""SELECT *, round(nss_recent - nss_period, 1) AS delta FROM (SELECT source_platform, source_name, sum(document_count) AS documents, min(event_date) AS first_date, max(event_date) AS last_date, {_NSS1} AS nss_period,
{nss('sum(positive_count) FILTER (WHERE recent)', 'sum(negative_count) FILTER (WHERE recent)', 'sum(document_count) FILTER (WHERE recent)', 1)} AS nss_recent, {sql_ratio('sum(CAST(round(avg_confidence * 10000) AS BIGINT) * document_count)', 'sum(document_count) * 10000', 4)} AS avg_confidence
FROM (SELECT *, event_date > max(event_date) OVER () - 90 AS recent FROM sentiment_daily) GROUP BY 1, 2) WHERE documents >= 2""",
    "alert_list": "SELECT aspect_label, source_platform, nss_7d, nss_baseline, nss_delta, z_score, severity, alert_status FROM alert_rows",
    "review_top": f"SELECT document_id, event_date, source_platform, headline, sentiment_label, {_dbl('confidence')}, reason_text, review_priority FROM queue ORDER BY review_priority DESC NULLS LAST, document_id LIMIT 100",
    "engine_monthly": f"SELECT CAST(date_trunc('month', event_date) AS DATE) AS month, {sql_ratio('sum(rating_matches) * 100', 'sum(rated_documents)', 1)} AS rating_match_pct, {sql_ratio('sum(gold_matches) * 100', 'sum(gold_documents)', 1)} AS gold_match_pct, {sql_ratio('sum(CAST(round(avg_confidence * 10000) AS BIGINT) * documents_scored) * 100', 'sum(documents_scored) * 10000', 1)} AS confidence_pct FROM engine_quality GROUP BY 1",
    "pipeline_top": "SELECT report_date, connector, fetched, inserted, duplicates, round(duplicate_rate * 100, 1) AS duplicate_pct, failures, expectations_failed FROM pipeline_health ORDER BY report_date DESC NULLS LAST, connector LIMIT 200",
    "feed_top": f"SELECT document_id, event_date, source_platform, source_name, sentiment_label, {_dbl('sentiment_score', 'confidence')}, headline, rating, negative_aspects, positive_aspects, url FROM feed ORDER BY event_at DESC NULLS LAST, document_id, sentiment_score, confidence LIMIT 500",
    "quality_trend": f"SELECT check_date, count(*) AS total, count(*) FILTER (WHERE NOT success) AS failed, {sql_ratio('count(*) FILTER (WHERE success) * 100', 'count(*)', 1)} AS passed_pct FROM stg_quality GROUP BY 1",
    "failing_expectations": "SELECT expectation, column_name, count(*) FILTER (WHERE NOT success) AS failed, count(*) AS total FROM stg_quality GROUP BY 1, 2 HAVING count(*) FILTER (WHERE NOT success) > 0 ORDER BY failed DESC, expectation, column_name NULLS LAST LIMIT 20",
}
for _key, (_mart, _card) in cards.CARDS.items():
    query(f"card_{_key}", _CARD_SQL[_key])(lambda spark, d, mart=_mart, card=_card: card(getattr(Models(spark, d), mart)))


@query("card_trend_filtered", f"SELECT CAST(date_trunc('month', event_date) AS DATE) AS month, sum(document_count) AS documents, {_NSS1} AS nss FROM sentiment_daily WHERE event_date >= DATE '2025-01-01' AND event_date <= DATE '2025-06-30' AND source_platform = 'news' GROUP BY 1")
def card_trend_filtered(spark, d):
    import datetime as dt

    return cards.monthly_trend(Models(spark, d).sentiment_daily, cards.Filters(dt.date(2025, 1, 1), dt.date(2025, 6, 30), "news"))


@query("card_connector_freshness", f"""SELECT connector, epoch_us(max(started_at)) AS last_run_micros, epoch_us(max(started_at) FILTER (WHERE is_success)) AS last_success_micros, {sql_ratio(f"{_NOW} - epoch_us(max(started_at))", "3600000000", 1)} AS age_hours FROM stg_runs WHERE started_at >= CAST({AS_OF} - 30 AS TIMESTAMPTZ) GROUP BY 1""")
def card_connector_freshness(spark, d):
    return cards.connector_freshness(Models(spark, d).stg_runs)


@query("card_latest_gate", "SELECT expectation, column_name, success, unexpected_count, unexpected_percent, epoch_us(checked_at) AS checked_micros FROM stg_quality WHERE checked_at = (SELECT max(checked_at) FROM stg_quality)")
def card_latest_gate(spark, d):
    return cards.latest_gate(Models(spark, d).stg_quality)


@query("card_storage")
def card_storage(spark, d):
    return cards.storage_sizes(spark, d, ["raw_documents", "documents", "document_sentiment", "document_aspect_sentiment", "ingestion_runs", "data_quality_results", "dim_aspect"])


@query("export_sources_scoped", f"SELECT source_platform, source_name, sum(document_count) AS documents, sum(positive_count) AS positive_count, sum(neutral_count) AS neutral_count, sum(negative_count) AS negative_count, {_NSS1} AS nss, {sql_ratio('sum(CAST(round(avg_confidence * 10000) AS BIGINT) * document_count)', 'sum(document_count) * 10000', 3)} AS avg_confidence, min(event_date) AS first_date, max(event_date) AS last_date FROM sentiment_daily WHERE event_date >= {AS_OF} - 120 AND source_platform = 'news' AND NOT coalesce(is_synthetic, FALSE) GROUP BY 1, 2")
def export_sources_scoped(spark, d):
    return cards.export_sources(cards.scoped(Models(spark, d).sentiment_daily, 120, "news", False))


@query("intake_counts", "SELECT outcome, count(*) AS n FROM (" + ORACLE_INTAKE + ") GROUP BY 1")
def intake_counts(spark, d):
    """What an intake reports: rows by outcome."""
    return dedup.outcome_counts(dedup.intake_outcomes(table(spark, d, "raw_documents")))


@query("score_payload")
def score_payload(spark, d):
    """The blended signals as JSON, with what the score came from."""
    return scoring.payload(_blended(spark, d))


def _word_classifier():
    """A stand-in for a model: made in each worker, it reads praise and complaint words."""

    def classify(texts: list[str]) -> list[dict[str, float]]:
        out = []
        for t in texts:
            low = t.lower()
            good, bad = sum(low.count(w) for w in ("cepat", "quick", "mantap")), sum(low.count(w) for w in ("lemot", "slow", "error"))
            out.append({"positive": (1 + good) / (2 + good + bad), "negative": (1 + bad) / (2 + good + bad)})
        return out

    return classify


@query("scorer_run")
def scorer_run(spark, d):
    """Every text through a classifier: windows, batches, pooling."""
    docs = spread(table(spark, d, "raw_documents").select("document_id", F.concat_ws(" ", "title", "body").alias("text")))
    return scoring.run_scorer(docs, _word_classifier).select("document_id", "available", "n_chunks", F.col("probabilities")["negative"].alias("negative"), "entropy")


@query("export_documents", f"""SELECT document_id, event_date, f.source_platform, f.source_name, coalesce(nullif(d.title, ''), headline) AS title, coalesce(nullif(d.body, ''), excerpt) AS body, f.url, sentiment_label, {_dbl('sentiment_score', 'confidence')}, dominant_emotion, f.rating, negative_aspects, positive_aspects, requires_review, review_reason, model_version
FROM feed f JOIN raw_documents d USING (document_id)""")
def export_documents(spark, d):
    m = Models(spark, d)
    return cards.export_documents(m.document_feed, m.raw_documents)


@query("export_aspects", f"SELECT aspect_label, aspect_group, sum(mention_documents) AS documents, sum(positive_count) AS positive_count, sum(neutral_count) AS neutral_count, sum(negative_count) AS negative_count, {_ANSS1} AS nss FROM aspect_daily GROUP BY 1, 2")
def export_aspects(spark, d):
    return cards.export_aspects(Models(spark, d).aspect_daily)


@query("export_sources", f"SELECT source_platform, source_name, sum(document_count) AS documents, sum(positive_count) AS positive_count, sum(neutral_count) AS neutral_count, sum(negative_count) AS negative_count, {_NSS1} AS nss, {sql_ratio('sum(CAST(round(avg_confidence * 10000) AS BIGINT) * document_count)', 'sum(document_count) * 10000', 3)} AS avg_confidence, min(event_date) AS first_date, max(event_date) AS last_date FROM sentiment_daily GROUP BY 1, 2")
def export_sources(spark, d):
    return cards.export_sources(Models(spark, d).sentiment_daily)


@query("review_reasons", "SELECT review_reason, count(*) AS n FROM document_sentiment WHERE requires_review GROUP BY 1")
def review_reasons(spark, d):
    return Models(spark, d).document_sentiment.filter("requires_review").groupBy("review_reason").agg(F.count(F.lit(1)).alias("n"))


@query("label_histogram", "SELECT sentiment_label, count(*) AS n FROM document_sentiment GROUP BY 1")
def label_histogram(spark, d):
    return Models(spark, d).document_sentiment.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("n"))


@query("platform_nss_30d", f"SELECT source_platform, count(*) AS n, {nss('sum(is_positive)', 'sum(is_negative)', 'count(*)')} AS nss FROM scored WHERE event_date >= {AS_OF} - 30 GROUP BY 1")
def platform_nss_30d(spark, d):
    from quern.functions.metrics import net_sentiment

    rows = Models(spark, d).scored.filter(F.col("event_date") >= F.date_sub(F.lit(DEFAULT.as_of), 30))
    return rows.groupBy("source_platform").agg(F.count(F.lit(1)).alias("n"), net_sentiment(F.sum("is_positive"), F.sum("is_negative"), F.count(F.lit(1))).alias("nss"))


# --- scoring ----------------------------------------------------------------------------------------------------


@query("unscored_documents", "SELECT d.document_id FROM raw_documents d LEFT JOIN document_sentiment s ON s.document_id = d.document_id AND s.model_version = 'v2' WHERE s.document_id IS NULL AND (coalesce(d.title, '') <> '' OR coalesce(d.body, '') <> '')")
def unscored_documents(spark, d):
    m = Models(spark, d)
    return scoring.unscored(m.raw_documents, m.document_sentiment, "v2").select("document_id")


@query("unscored_backlog", "SELECT count(*) AS n FROM raw_documents d WHERE NOT EXISTS (SELECT 1 FROM document_sentiment s WHERE s.document_id = d.document_id AND s.model_version = 'v2') AND (coalesce(d.title, '') <> '' OR coalesce(d.body, '') <> '')")
def unscored_backlog(spark, d):
    m = Models(spark, d)
    return scoring.unscored(m.raw_documents, m.document_sentiment, "v2").agg(F.count(F.lit(1)).alias("n"))


@query("never_judged", "SELECT DISTINCT d.document_id FROM raw_documents d JOIN document_sentiment s ON s.document_id = d.document_id WHERE requires_review AND reviewed_label IS NULL AND NOT coalesce(TRY_CAST(json_extract_string(signals, '$.llm_judge.available') AS BOOLEAN), FALSE)")
def never_judged(spark, d):
    m = Models(spark, d)
    judged = F.coalesce(F.get_json_object("signals", "$.llm_judge.available").try_cast("boolean"), F.lit(False))
    open_ = m.document_sentiment.filter(F.col("requires_review") & F.col("reviewed_label").isNull() & ~judged).select("document_id").distinct()
    return m.raw_documents.select("document_id").join(open_, "document_id", "left_semi")


@query("aspect_signal", "SELECT document_id, round(sum(CAST(sentiment_score AS DOUBLE) * (1 + 0.15 * least(mentions, 5))) / sum(1 + 0.15 * least(mentions, 5)), 6) AS aspect_signal FROM document_aspect_sentiment GROUP BY 1")
def aspect_signal(spark, d):
    return scoring.aspect_signal(Models(spark, d).document_aspect_sentiment).select("document_id", F.round("aspect_signal", 6).alias("aspect_signal"))


def _blended(spark: SparkSession, d: str) -> DataFrame:
    m = Models(spark, d)
    on = lambda has, c: F.when(F.col(has), F.col(c))
    n_words = F.size(F.regexp_extract_all(F.concat_ws(" ", "title", "body"), F.lit(r"\S+"), F.lit(0)))
    rows = m.scored.select("document_id", "source_platform", n_words.alias("n_words"), F.col("transformer_entropy").alias("entropy"), on("has_transformer_signal", "transformer_score").alias("s_transformer"), on("has_emotion_signal", "emotion_score").alias("s_emotion"), scoring.rating_signal(F.col("rating")).alias("s_rating"))
    aspects = scoring.aspect_signal(m.document_aspect_sentiment).withColumnRenamed("aspect_signal", "s_aspect")
    return scoring.blend(rows.join(aspects, "document_id", "left"))


_SIGNALS = {"transformer": ("0.55e0", "WHEN 'news' THEN 1.05e0"), "emotion": ("0.15e0", "WHEN 'news' THEN 0.6e0 WHEN 'playstore' THEN 1.15e0 WHEN 'appstore' THEN 1.15e0 WHEN 'google_maps' THEN 1.15e0 WHEN 'twitter' THEN 1.2e0 WHEN 'youtube' THEN 1.2e0 WHEN 'reddit' THEN 1.2e0 WHEN 'kaskus' THEN 1.2e0"), "rating": ("0.18e0", "WHEN 'playstore' THEN 1.25e0 WHEN 'appstore' THEN 1.25e0 WHEN 'google_maps' THEN 1.25e0"), "aspect": ("0.12e0", "WHEN '' THEN 1e0")}


def _sum(each: str, names=tuple(_SIGNALS)) -> str:
    return "(" + " + ".join(f"CASE WHEN s_{n} IS NULL THEN 0e0 ELSE {each.format(n=n)} END" for n in names) + ")"


_AGREES = "CASE WHEN n < 2 THEN 0.6e0 ELSE (floor((1e0 - least(sqrt({spread} / n), 1e0)) * 10000e0 + 0.5e0) / 10000e0) END"
_BLENDED = f"""
blend_in AS (SELECT s.document_id, lower(source_platform) AS p, len(regexp_extract_all(concat_ws(' ', title, body), '\\S+')) AS n_words, CAST(transformer_entropy AS DOUBLE) AS entropy,
  CASE WHEN has_transformer_signal THEN CAST(transformer_score AS DOUBLE) END AS s_transformer, CASE WHEN has_emotion_signal THEN CAST(emotion_score AS DOUBLE) END AS s_emotion, CASE WHEN rating BETWEEN 1 AND 5 THEN (rating - 3) / 2e0 END AS s_rating, s_aspect
  FROM scored s LEFT JOIN (SELECT document_id, sum(CAST(sentiment_score AS DOUBLE) * (1 + 0.15e0 * least(mentions, 5))) / sum(1 + 0.15e0 * least(mentions, 5)) AS s_aspect FROM document_aspect_sentiment GROUP BY 1) a USING (document_id)),
blend_w AS (SELECT *, {", ".join(f"CASE p {by} ELSE 1e0 END * {base} AS w_{n}" for n, (base, by) in _SIGNALS.items())}, {" + ".join(f"(s_{n} IS NOT NULL)::INT" for n in _SIGNALS)} AS n FROM blend_in),
blend_t AS (SELECT *, {_sum("w_{n}")} AS total, {_sum("s_{n}")} / nullif(n, 0) AS mean FROM blend_w),
blend_s AS (SELECT *, CASE WHEN n = 0 THEN 0e0 ELSE (floor((greatest(-1e0, least(1e0, {_sum("(floor((s_{n} * w_{n} / total) * 10000e0 + 0.5e0) / 10000e0)")}))) * 10000e0 + 0.5e0) / 10000e0) END AS score, {_AGREES.format(spread=_sum("(s_{n} - mean) * (s_{n} - mean)"))} AS agreement FROM blend_t),
blend_c AS (SELECT *, (floor((0.35e0 * agreement + 0.2e0 * n / 4e0 + 0.2e0 * (least(n_words / 40e0, 1e0) * 0.5e0 + CASE WHEN s_transformer IS NULL THEN 0e0 ELSE greatest(0e0, least(1e0, 1e0 - coalesce(entropy, 1e0))) * 0.5e0 END) + 0.25e0 * least(abs(score) / 0.36e0, 1e0)) * 10000e0 + 0.5e0) / 10000e0) AS confidence,
  CASE WHEN score > 0.12e0 THEN 'positive' WHEN score < -0.12e0 THEN 'negative' ELSE 'neutral' END AS label FROM blend_s),
blended AS (SELECT *, CASE WHEN greatest({", ".join(f"coalesce(s_{n}, 0e0)" for n in _SIGNALS)}) >= 0.35e0 AND least({", ".join(f"coalesce(s_{n}, 0e0)" for n in _SIGNALS)}) <= -0.35e0 THEN 'signal_conflict' WHEN confidence < 0.55e0 THEN 'low_confidence'
  WHEN label <> 'neutral' AND abs(score) < 1.4e0 * 0.12e0 THEN 'borderline_label' WHEN n <= 1 THEN 'insufficient_signals' END AS reason FROM blend_c)"""


@query("ensemble_scores", f"SELECT * FROM (WITH {_BLENDED} SELECT document_id, score AS blended_score, label AS blended_label, agreement AS blended_agreement, confidence AS blended_confidence, reason AS blended_reason, reason IS NOT NULL AS needs_review FROM blended)")
def ensemble_scores(spark, d):
    return _blended(spark, d).select("document_id", "blended_score", "blended_label", "blended_agreement", "blended_confidence", "blended_reason", "needs_review")


_JUDGED = f"""WITH {_BLENDED},
one AS (SELECT * FROM blended WHERE reason IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY confidence, score) = 1),
asked AS (SELECT o.*, left(lower(concat_ws(' ', title, body)), 2500) AS low FROM one o JOIN raw_documents USING (document_id) WHERE reason <> 'insufficient_signals' ORDER BY confidence, document_id LIMIT 300),
told AS (SELECT *, greatest(-1e0, least(1e0, ({" + ".join(f"(length(low) - length(replace(low, '{w}', ''))) / {len(w)}e0" for w in ("cepat", "quick", "mantap"))} - {" - ".join(f"(length(low) - length(replace(low, '{w}', ''))) / {len(w)}e0" for w in ("lemot", "slow", "error"))}) / 3e0)) AS s_judge FROM asked),
again AS (SELECT document_id, confidence, (floor((greatest(-1e0, least(1e0, {_sum("(floor((s_{n} * w_{n} / (total + 0.35e0)) * 10000e0 + 0.5e0) / 10000e0)")} + (floor((s_judge * 0.35e0 / (total + 0.35e0)) * 10000e0 + 0.5e0) / 10000e0)))) * 10000e0 + 0.5e0) / 10000e0) AS score,
  CASE WHEN n < 1 THEN 0.6e0 ELSE (floor((1e0 - least(sqrt(({_sum("(s_{n} - (mean * n + s_judge) / (n + 1)) * (s_{n} - (mean * n + s_judge) / (n + 1))")} + (s_judge - (mean * n + s_judge) / (n + 1)) * (s_judge - (mean * n + s_judge) / (n + 1))) / (n + 1)), 1e0)) * 10000e0 + 0.5e0) / 10000e0) END AS agreement FROM told),
sure AS (SELECT *, (floor((least(1e0, greatest(confidence, 0.9e0 * 0.7e0))) * 10000e0 + 0.5e0) / 10000e0) AS conf FROM again)
SELECT document_id, score, CASE WHEN score > 0.12e0 THEN 'positive' WHEN score < -0.12e0 THEN 'negative' ELSE 'neutral' END AS label, agreement, conf AS confidence, conf < 0.55e0 AS needs_review, CASE WHEN conf < 0.55e0 THEN 'low_confidence_after_llm' END AS review_reason FROM sure"""


@query("judge_arbitration", f"SELECT * FROM ({_JUDGED})")
def judge_arbitration(spark, d):
    """A judge that is a plain function: it answers by counting praise and complaint words."""
    texts = Models(spark, d).raw_documents.select("document_id", F.concat_ws(" ", "title", "body").alias("text"))
    kept = F.struct("blended_confidence", "blended_score", "blended_reason", "blended_signals")
    # A document that was scored twice is asked about once, by its less sure score.
    rows = _blended(spark, d).filter("needs_review").groupBy("document_id").agg(F.min(kept).alias("k")).select("document_id", "k.*").join(texts, "document_id")

    def judge(text: str) -> str:
        low = text.lower()
        score = sum(low.count(w) for w in ("cepat", "quick", "mantap")) - sum(low.count(w) for w in ("lemot", "slow", "error"))
        return '{"label": "%s", "score": %s, "confidence": 0.7}' % ("positive" if score > 0 else "negative" if score < 0 else "neutral", max(-1.0, min(1.0, score / 3)))

    return scoring.arbitrate(rows, judge).drop("reason")


@query("aspect_detect")
def aspect_detect(spark, d):
    return scoring.detect_aspects(spread(table(spark, d, "raw_documents").select("document_id", "title", "body")), PACK["aspects"], PACK["slang"]).withColumn("matched_keywords", F.array_join("matched_keywords", ","))


@query("chunk_pooling")
def chunk_pooling(spark, d):
    """Chunks of every text, a stand-in model's probabilities for each, pooled per document."""
    docs = table(spark, d, "raw_documents").filter(F.col("body").isNotNull())
    rows = docs.select("document_id", F.posexplode(tx.chunks(F.col("body"), 60, 15)).alias("position", "chunk"))
    bad = F.pmod(F.xxhash64("chunk"), F.lit(1000)) / 1000.0
    rows = rows.select("document_id", "position", F.size(F.split("chunk", " ")).alias("n_words"), F.create_map(F.lit("negative"), bad, F.lit("positive"), 1 - bad).alias("probabilities"))
    pooled = scoring.pool_chunks(rows).groupBy("document_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "probability")))).alias("p"))
    return pooled.select("document_id", scoring.normalized_entropy(F.col("p")).alias("entropy"), scoring.valence(F.col("p"), {"negative": -0.8, "positive": 0.8}).alias("valence"))


# --- text functions ---------------------------------------------------------------------------------------------

_BODY = "SELECT document_id, {} FROM raw_documents WHERE body IS NOT NULL"


def _body(spark: SparkSession, d: str, **cols) -> DataFrame:
    return spread(table(spark, d, "raw_documents").select("document_id", "body")).filter(F.col("body").isNotNull()).select("document_id", *[c.alias(k) for k, c in cols.items()])


@query("txt_tokens", _BODY.format("len(regexp_extract_all(lower(body), '[a-z0-9'']+')) AS n_tokens, array_to_string(regexp_extract_all(lower(body), '[a-z0-9'']+'), ' ') AS tokens"))
def txt_tokens(spark, d):
    t = tx.tokens(F.col("body"))
    return _body(spark, d, n_tokens=F.size(t), tokens=F.array_join(t, " "))


@query("txt_emoji", _BODY.format(f"(length(body) - length(translate(body, '{tx.GOOD_EMOJI}', ''))) - (length(body) - length(translate(body, '{tx.BAD_EMOJI}', ''))) AS balance"))
def txt_emoji(spark, d):
    return _body(spark, d, balance=tx.emoji_balance(F.col("body")))


@query("txt_truncate", _BODY.format("CASE WHEN length(body) > 160 THEN rtrim(left(body, 159)) || '…' ELSE body END AS short"))
def txt_truncate(spark, d):
    return _body(spark, d, short=tx.truncate(F.col("body"), 160))


@query("txt_relevance", _BODY.format("(" + " + ".join(f"CAST(contains(lower(body), '{k}') AS INT)" for k in PACK["keywords"]) + f") / {len(PACK['keywords'])}.0::DOUBLE AS relevance, (" + " OR ".join(f"contains(lower(body), '{k}')" for k in PACK["keywords"]) + ") AS relevant"))
def txt_relevance(spark, d):
    return _body(spark, d, relevance=tx.relevance(F.col("body"), PACK["keywords"]), relevant=tx.contains_any(F.col("body"), PACK["keywords"]))


def _overlap(lang: str) -> str:
    return f"len(list_intersect(list_distinct(regexp_extract_all(lower(body), '[a-z0-9'']+')), [{', '.join(repr(w) for w in PACK['markers'][lang])}]))"


@query("txt_language", f"SELECT document_id, CASE WHEN greatest(i, e) = 0 THEN 'unknown' WHEN i >= e THEN 'id' ELSE 'en' END AS language FROM (SELECT document_id, {_overlap('id')} AS i, {_overlap('en')} AS e FROM raw_documents WHERE body IS NOT NULL)")
def txt_language(spark, d):
    return _body(spark, d, language=tx.marker_language(F.col("body"), PACK["markers"]))


@query("txt_content_hash", r"SELECT document_id, sha256(array_to_string(regexp_extract_all(lower(coalesce(title, '')), '[\p{L}\p{N}]+'), ' ') || chr(31) || array_to_string(regexp_extract_all(lower(coalesce(body, '')), '[\p{L}\p{N}]+'), ' ')) AS hash FROM raw_documents")
def txt_content_hash(spark, d):
    return table(spark, d, "raw_documents").select("document_id", tx.content_hash(F.col("title"), F.col("body")).alias("hash"))


_SIM = """WITH t AS (SELECT document_id, regexp_extract_all(lower(body), '[a-z0-9'']+') AS w FROM raw_documents WHERE body IS NOT NULL),
s AS (SELECT document_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM t),
h AS (SELECT document_id, ('0x' || right(md5(x), 16))::UBIGINT AS h FROM s),
b AS (SELECT document_id, i, sum(CASE WHEN (h >> i) & 1 = 1 THEN 1 ELSE -1 END) AS v FROM h, (SELECT unnest(range(0, 64))::INT AS i) GROUP BY 1, 2),
g AS (SELECT document_id, sum(CASE WHEN v > 0 THEN (1::HUGEINT << i) ELSE 0::HUGEINT END) AS u FROM b GROUP BY 1)
SELECT t.document_id, CAST(CASE WHEN coalesce(u, 0) >= 9223372036854775808 THEN u - 18446744073709551616 ELSE coalesce(u, 0) END AS BIGINT) AS simhash FROM t LEFT JOIN g USING (document_id)"""


@query("txt_simhash")
def txt_simhash(spark, d):
    return _body(spark, d, simhash=tx.simhash(F.col("body")))


ORACLE["txt_simhash"] = _SIM


@query("txt_sentences")
def txt_sentences(spark, d):
    s, c = tx.sentences(F.col("body")), tx.clauses(F.col("body"))
    return _body(spark, d, n_sentences=F.size(s), n_clauses=F.size(c), n_chunks=F.size(tx.chunks(F.col("body"))))


@query("txt_normalized")
def txt_normalized(spark, d):
    # Resolved once; both columns start from it.
    rows = _body(spark, d, body=tx.unescaped(F.col("body")))
    return rows.select("document_id", tx.clean_text(F.col("body")).alias("clean"), tx.normalize_tokens(F.col("body"), PACK["slang"]).alias("normalized"))


@query("src_domain", r"SELECT document_id, nullif(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)), '^www\.', ''), '') AS domain FROM raw_documents")
def src_domain(spark, d):
    return table(spark, d, "raw_documents").select("document_id", connectors.url_domain(F.col("url")).alias("domain"))


@query("src_html_text")
def src_html_text(spark, d):
    """Every body wrapped as a page and read back."""
    body = table(spark, d, "raw_documents").filter(F.col("body").isNotNull())
    page = F.concat(F.lit("<html><style>x</style><body><p>"), F.replace(F.col("body"), F.lit("\n"), F.lit("</p><p>")), F.lit("</p><script>y</script></body></html>"))
    return body.select("document_id", connectors.html_text(page).alias("text"))


@query("src_interest_long", "SELECT day, term, interest FROM (SELECT CAST(ts AS DATE) AS day, event_type AS term, count(*) AS interest FROM events GROUP BY 1, 2) WHERE interest <> 0")
def src_interest_long(spark, d):
    """Interest by term: pivoted wide as it would arrive, then made long again."""
    wide = table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).pivot("event_type").agg(F.count(F.lit(1)))
    return connectors.interest_long(wide, "day")


@query("src_month_windows", f"SELECT greatest(m, DATE '2024-09-02') AS first, least(CAST(m + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE), {AS_OF}) AS last FROM (SELECT CAST(unnest(generate_series(DATE '2024-09-01', {AS_OF}, INTERVAL 1 MONTH)) AS DATE) AS m)")
def src_month_windows(spark, d):
    import datetime as dt

    return connectors.month_windows(spark, dt.date(2024, 9, 2), DEFAULT.as_of)


@query("src_window", f"SELECT document_id FROM raw_documents WHERE ingested_at >= CAST({AS_OF} AS TIMESTAMPTZ) - INTERVAL 168 HOUR AND ingested_at < CAST({AS_OF} AS TIMESTAMPTZ)")
def src_window(spark, d):
    return connectors.load_window(table(spark, d, "raw_documents"), DEFAULT.as_of, 168).select("document_id")


@query("src_latest_runs", """SELECT run_id, status, fetched_count, inserted_count, finished_micros FROM (SELECT run_id, status, fetched_count, inserted_count, epoch_us(finished_at) AS finished_micros,
row_number() OVER (PARTITION BY run_id ORDER BY finished_at IS NOT NULL DESC, finished_at DESC, status DESC NULLS LAST, fetched_count DESC NULLS LAST, inserted_count DESC NULLS LAST) AS rn FROM ingestion_runs) WHERE rn = 1""")
def src_latest_runs(spark, d):
    runs = connectors.latest_records(table(spark, d, "ingestion_runs").select("run_id", "status", "fetched_count", "inserted_count", "finished_at"))
    return runs.select("run_id", "status", "fetched_count", "inserted_count", F.unix_micros("finished_at").alias("finished_micros"))


@query("src_occupancy", f"SELECT count(*) AS documents, count(*) FILTER (WHERE ingested_at >= CAST({AS_OF} AS TIMESTAMPTZ) - INTERVAL 12 HOUR) AS fresh FROM raw_documents")
def src_occupancy(spark, d):
    """How many documents there are, and how many came in the last twelve hours."""
    late = F.col("ingested_at") >= F.lit(DEFAULT.as_of).cast("timestamp") - F.make_interval(hours=F.lit(12))
    return table(spark, d, "raw_documents").agg(F.count(F.lit(1)).alias("documents"), F.count(F.when(late, 1)).alias("fresh"))


@query("src_synthetic")
def src_synthetic(spark, d):
    return connectors.synthetic_documents(spark, 2400)


# --- deduplication, upserts, quality, streaming -----------------------------------------------------------------


@query("dedup_uid", "SELECT document_id, doc_uid FROM (SELECT *, row_number() OVER (PARTITION BY doc_uid ORDER BY document_id) AS rn FROM raw_documents) WHERE rn = 1 OR doc_uid IS NULL")
def dedup_uid(spark, d):
    return dedup.keep_first(table(spark, d, "raw_documents").select("document_id", "doc_uid"), ["doc_uid"], "document_id")


@query("dedup_intake", ORACLE_INTAKE)
def dedup_intake(spark, d):
    return dedup.intake_outcomes(table(spark, d, "raw_documents"))


@query("dedup_near_pairs", "WITH v AS (SELECT DISTINCT simhash AS s FROM raw_documents WHERE simhash <> 0) SELECT x.s AS a, y.s AS b, CAST(bit_count(xor(x.s, y.s)) AS INT) AS distance FROM v x JOIN v y ON x.s < y.s AND bit_count(xor(x.s, y.s)) <= 4")
def dedup_near_pairs(spark, d):
    return dedup.simhash_pairs(table(spark, d, "raw_documents"))


@query("dedup_greedy")
def dedup_greedy(spark, d):
    """Greedy keep-first over the different SimHash values in arrival order of their first document."""
    docs = table(spark, d, "raw_documents")
    first = materialize(docs.filter(F.col("simhash") != 0).groupBy("simhash").agg(F.min("document_id").alias("node")), "first")
    p = dedup.simhash_pairs(docs)
    ids = p.join(first.select(F.col("simhash").alias("a"), F.col("node").alias("na")), "a").join(first.select(F.col("simhash").alias("b"), F.col("node").alias("nb")), "b")
    return dedup.greedy_keep(first.select("node"), ids.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")))


@query("upsert_documents", """WITH t AS (SELECT doc_uid, max(document_id) AS document_id, max(rating) AS rating, max(CAST(relevance_score AS DOUBLE)) AS relevance FROM raw_documents WHERE ingested_at < TIMESTAMPTZ '2025-06-01 00:00:00+00' GROUP BY 1),
s AS (SELECT doc_uid, max(document_id) AS document_id, max(rating) AS rating, max(CAST(relevance_score AS DOUBLE)) AS relevance FROM raw_documents WHERE ingested_at >= TIMESTAMPTZ '2025-03-01 00:00:00+00' GROUP BY 1)
SELECT coalesce(t.doc_uid, s.doc_uid) AS doc_uid, coalesce(t.document_id, s.document_id) AS document_id, CASE WHEN s.doc_uid IS NOT NULL THEN s.rating ELSE t.rating END AS rating, CASE WHEN s.doc_uid IS NOT NULL THEN s.relevance ELSE t.relevance END AS relevance FROM t FULL OUTER JOIN s ON t.doc_uid = s.doc_uid""")
def upsert_documents(spark, d):
    """What had arrived by June, and a later delivery that reaches back to March over it: rating and relevance of known rows are refreshed,
    the rest of them stays, new rows are added."""
    rows = table(spark, d, "raw_documents")
    delivery = lambda keep: rows.filter(keep).groupBy("doc_uid").agg(F.max("document_id").alias("document_id"), F.max("rating").alias("rating"), F.max(F.col("relevance_score").cast("double")).alias("relevance"))
    return upsert.merge_rows(delivery(F.col("ingested_at") < F.lit("2025-06-01").cast("timestamp")), delivery(F.col("ingested_at") >= F.lit("2025-03-01").cast("timestamp")), ["doc_uid"], ["rating", "relevance"])


@query("retention", f"SELECT document_id FROM raw_documents WHERE ingested_at IS NULL OR ingested_at >= CAST({AS_OF} - 90 AS TIMESTAMPTZ)")
def retention(spark, d):
    return upsert.retained(table(spark, d, "raw_documents"), "ingested_at", DEFAULT.as_of).select("document_id")


PLATFORMS = ("news", "playstore", "appstore", "reddit", "youtube", "twitter", "kaskus", "google_maps")
SUITE = [
    quality.Expectation("not_null", "doc_uid"), quality.Expectation("unique", "doc_uid"), quality.Expectation("not_null", "source_platform"), quality.Expectation("in_set", "source_platform", PLATFORMS), quality.Expectation("in_set", "language", ("id", "en", "es", "fr")),
    quality.Expectation("between", "rating", low=1, high=5), quality.Expectation("between", "text_length", low=3, high=20_000, mostly=0.99), quality.Expectation("unique_share", "content_hash", low=0.7, high=1.0),
]


def _dq(name: str, column: str, n: str, bad: str, ok: str = "b = 0") -> str:
    return f"SELECT 'expect_{name}' AS expectation, '{column}' AS column_name, n AS evaluated_rows, b AS unexpected_count, {ok} AS success FROM (SELECT {n} AS n, CAST({bad} AS BIGINT) AS b FROM q)"


_IN = "count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({v}))"


@query("dq_suite", "SELECT * FROM (WITH q AS (SELECT *, length(coalesce(title, '') || coalesce(body, '')) AS text_length FROM raw_documents), g AS (SELECT doc_uid, count(*) AS k FROM q WHERE doc_uid IS NOT NULL GROUP BY 1) " + " UNION ALL ".join([
    _dq("not_null", "doc_uid", "count(*)", "count(*) FILTER (WHERE doc_uid IS NULL)"), _dq("unique", "doc_uid", "count(doc_uid)", "(SELECT coalesce(sum(k), 0) FROM g WHERE k > 1)"), _dq("not_null", "source_platform", "count(*)", "count(*) FILTER (WHERE source_platform IS NULL)"),
    _dq("in_set", "source_platform", "count(source_platform)", _IN.format(c="source_platform", v=", ".join(f"'{p}'" for p in PLATFORMS))), _dq("in_set", "language", "count(language)", _IN.format(c="language", v="'id', 'en', 'es', 'fr'")),
    _dq("between", "rating", "count(rating)", "count(*) FILTER (WHERE rating NOT BETWEEN 1 AND 5)"), _dq("between", "text_length", "count(text_length)", "count(*) FILTER (WHERE text_length NOT BETWEEN 3 AND 20000)", "b <= n * (1 - 0.99)"),
    _dq("unique_share", "content_hash", "count(content_hash)", "count(content_hash) - count(DISTINCT content_hash)", "(n - b) / n BETWEEN 0.7 AND 1.0"),
]) + ")")
def dq_suite(spark, d):
    docs = table(spark, d, "raw_documents").withColumn("text_length", F.length(F.concat(F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")))))
    return quality.run_suite(docs, SUITE)


@query("dq_duplicates", "SELECT document_id, aspect_code, count(*) AS n FROM document_aspect_sentiment GROUP BY 1, 2 HAVING count(*) > 1")
def dq_duplicates(spark, d):
    return quality.duplicates(table(spark, d, "document_aspect_sentiment"), ["document_id", "aspect_code"])


@query("dq_orphans", "SELECT document_id, aspect_code FROM document_aspect_sentiment WHERE aspect_code NOT IN (SELECT aspect_code FROM dim_aspect)")
def dq_orphans(spark, d):
    m = Models(spark, d)
    return quality.orphans(m.document_aspect_sentiment, m.dim_aspect, "aspect_code").select("document_id", "aspect_code")


@query("dq_label_mismatches", "SELECT document_id, aspect_code, sentiment_label FROM document_aspect_sentiment WHERE sentiment_label <> CASE WHEN sentiment_score > 0.12 THEN 'positive' WHEN sentiment_score < -0.12 THEN 'negative' ELSE 'neutral' END")
def dq_label_mismatches(spark, d):
    return quality.label_mismatches(table(spark, d, "document_aspect_sentiment"), "sentiment_score", "sentiment_label", DEFAULT.neutral_band).select("document_id", "aspect_code", "sentiment_label")


@query("dq_constant_columns", "SELECT column_name, n_values FROM (SELECT unnest(['suite_name', 'expectation', 'success']) AS column_name, unnest([count(DISTINCT suite_name), count(DISTINCT expectation), count(DISTINCT success)]) AS n_values FROM data_quality_results) WHERE n_values < 2")
def dq_constant_columns(spark, d):
    return quality.constant_columns(table(spark, d, "data_quality_results"), ["suite_name", "expectation", "success"])


@query("dq_reconcile", "SELECT (SELECT sum(document_count) FROM sentiment_daily) AS daily, (SELECT count(*) FROM scored WHERE is_kpi_eligible) AS scored_rows")
def dq_reconcile(spark, d):
    m = Models(spark, d)
    one = m.sentiment_daily.agg(F.sum("document_count").alias("daily"))
    return one.crossJoin(m.scored.filter("is_kpi_eligible").agg(F.count(F.lit(1)).alias("scored_rows")))  # one row each


@query("dq_kpi_floor", "SELECT document_id FROM scored WHERE is_kpi_eligible AND (confidence IS NULL OR confidence < 0.45)")
def dq_kpi_floor(spark, d):
    return Models(spark, d).scored.filter(F.col("is_kpi_eligible") & (F.col("confidence").isNull() | (F.col("confidence") < DEFAULT.min_confidence))).select("document_id")


@query("dq_future_documents", f"SELECT document_id FROM stg_documents WHERE event_at > CAST({AS_OF} AS TIMESTAMPTZ) + INTERVAL 1 DAY")
def dq_future_documents(spark, d):
    return Models(spark, d).stg_documents.filter(F.col("event_at") > F.date_add(F.lit(DEFAULT.as_of), 1).cast("timestamp")).select("document_id")


@query("dq_freshness", f"SELECT epoch_us(max(ingested_at)) AS last_micros, CASE WHEN {_NOW} - epoch_us(max(ingested_at)) > 48 * 3600000000 THEN 'error' WHEN {_NOW} - epoch_us(max(ingested_at)) > 12 * 3600000000 THEN 'warn' ELSE 'ok' END AS state FROM raw_documents")
def dq_freshness(spark, d):
    return quality.freshness(table(spark, d, "raw_documents"), "ingested_at", DEFAULT.as_of).select(F.unix_micros("last").alias("last_micros"), "state")


@query("stream_dedup", "SELECT event_id, user_id, event_type, value FROM events")
def stream_dedup(spark, d):
    """The events as a stream, each event_id once; equal to the batch as ids are unique."""
    stream = intake.deduplicated(intake.read_files(spark, _one_folder(spark, d, "events")), "event_id", "ts")
    return intake.run_available(stream.select("event_id", "user_id", "event_type", "value", "ts"), "dedup").select("event_id", "user_id", "event_type", "value")


@query("stream_daily_counts", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_counts(spark, d):
    """Every day's counts in update mode, the days that the watermark has not closed included."""
    stream = intake.windowed_counts(intake.read_files(spark, _one_folder(spark, d, "events")), "ts", "event_type")
    flat = stream.select(F.col("window.start").alias("day"), "event_type", "n")
    return intake.run_updates(flat, "daily", ["day", "event_type"]).select(F.to_date("day").alias("day"), "event_type", "n")


@lru_cache(maxsize=64)
def _folder_of(app: str, path: str) -> list:
    return []


def _one_folder(spark: SparkSession, d: str, name: str) -> str:
    """A folder that a file stream can watch: streams read folders, and the table may be a single file."""
    made = _folder_of(spark.sparkContext.applicationId, f"{d}/{name}")
    if not made:
        copy = materialize(spark.read.parquet(f"{d}/{name}.parquet"), f"stream-{name}")
        made.append(copy.inputFiles()[0].rsplit("/", 1)[0])
    return made[0]


__all__ = ["ORACLE", "QUERIES", "ratio"]
