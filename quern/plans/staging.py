"""Typed copies of the base tables: names, flags and values taken out of JSON, no aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.config import DEFAULT, Config
from quern.functions.metrics import effective_label, rating_label, ratio, sentiment_label

_ZONED = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", F.trim(c))


def json_text(column: str, path: str) -> Column:
    return F.get_json_object(column, f"$.{path}")


def zoned_instant(text: Column) -> Column:
    """The instant of a text in ISO form that states its zone; null for any other text."""
    return F.when(text.rlike(_ZONED), F.try_to_timestamp(text))


def stg_documents(docs: DataFrame, published: DataFrame | None = None) -> DataFrame:
    """published: (document_id, utc_micros) from normalize_timestamps; without it only zoned ISO texts count as published.

    One select over the source columns: lengths and the emptiness test see the untrimmed texts. A table that carries the `has_text` flag of
    finalize() is filtered by it, so that marts which need no text read none.
    """
    if published is None:
        at = zoned_instant(F.col("published_at"))
    else:
        docs = docs.join(published.select("document_id", F.col("utc_micros").alias("__published")), "document_id", "left")
        at = F.timestamp_micros(F.col("__published"))
    event = F.coalesce(at, F.col("ingested_at"))
    kept = docs.filter("has_text") if "has_text" in docs.columns else docs.filter((F.coalesce("title", F.lit("")) != "") | (F.coalesce("body", F.lit("")) != ""))
    return kept.select(
        "document_id", "doc_uid", F.lower(F.trim("source_platform")).alias("source_platform"), F.lower(F.trim("source_name")).alias("source_name"), "source_type", "external_id", "url",
        blank_to_null(F.col("title")).alias("title"), blank_to_null(F.col("body")).alias("body"), blank_to_null(F.col("author")).alias("author"), "language", "rating",
        at.alias("published"), "ingested_at", "ingestion_run_id", "content_hash", "relevance_score",
        F.coalesce(json_text("raw_payload", "is_synthetic").try_cast("boolean"), F.lit(False)).alias("is_synthetic"),
        F.coalesce(json_text("raw_payload", "is_adversarial").try_cast("boolean"), F.lit(False)).alias("is_adversarial"),
        json_text("raw_payload", "intended_polarity").alias("intended_polarity"), json_text("raw_payload", "collector").alias("collector"),
        F.length(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("body", F.lit("")))).alias("text_length"),
        F.coalesce(*[json_text("engagement", k).try_cast("int") for k in ("score", "likes", "thumbs_up")], F.lit(0)).alias("engagement_score"),
        event.alias("event_at"), F.to_date(event).alias("event_date"), F.to_date(F.date_trunc("week", event)).alias("event_week"), F.to_date(F.date_trunc("month", event)).alias("event_month"),
        at.isNull().alias("used_ingested_at_fallback"),
    )


def stg_sentiment(sentiment: DataFrame) -> DataFrame:
    available = lambda k: F.coalesce(json_text("signals", f"{k}.available").try_cast("boolean"), F.lit(False))
    number = lambda path: json_text("signals", path).try_cast("double")
    return sentiment.select(
        "document_id", "sentiment_label", "reviewed_label", effective_label(F.col("sentiment_label"), F.col("reviewed_label")).alias("effective_label"), F.col("reviewed_label").isNotNull().alias("human_reviewed"),
        "sentiment_score", "confidence", "agreement", "requires_review", "review_reason", "model_version", "engine_mode", "scored_at",
        *[number(f"{k}.score").alias(f"{k}_score") for k in ("transformer", "emotion", "rating", "aspect", "llm_judge")],
        available("transformer").alias("has_transformer_signal"), available("emotion").alias("has_emotion_signal"), available("rating").alias("has_rating_signal"), available("llm_judge").alias("escalated_to_llm"),
        number("transformer.normalized_entropy").alias("transformer_entropy"), json_text("signals", "emotion.dominant_emotion").alias("dominant_emotion"), json_text("explanation", "contributions").alias("signal_contributions"),
    )


def stg_aspects(aspects: DataFrame, dim: DataFrame) -> DataFrame:
    return aspects.join(dim.select("aspect_code", "aspect_label", "aspect_group", "description"), "aspect_code", "left").select(
        "document_id", "aspect_code", "aspect_label", "aspect_group", F.col("description").alias("aspect_description"), "mentions", F.col("sentiment_label").alias("aspect_sentiment"),
        F.col("sentiment_score").alias("aspect_score"), "matched_keywords", json_text("evidence", "window_sample").alias("window_sample"), "scored_at",
    )


def stg_runs(runs: DataFrame) -> DataFrame:
    return runs.select(
        "run_id", "connector", "status", (F.col("status") == "success").alias("is_success"), F.col("status").like("skipped%").alias("is_skipped"), F.col("status").isin("failed", "unavailable").alias("is_failure"),
        "window_start", "started_at", "finished_at", (F.unix_micros("finished_at") - F.unix_micros("started_at")).alias("duration_micros"), "fetched_count", "inserted_count", "duplicate_count", "irrelevant_count",
        ratio(F.col("duplicate_count"), F.col("fetched_count"), 4).alias("duplicate_rate"), "message", F.to_date("started_at").alias("run_date"),
    )


def stg_quality(results: DataFrame) -> DataFrame:
    return results.select(
        "result_id", "suite_name", "expectation", "column_name", "success", "evaluated_rows", json_text("observed", "unexpected_count").try_cast("int").alias("unexpected_count"),
        json_text("observed", "unexpected_percent").try_cast("double").alias("unexpected_percent"), json_text("observed", "partial_unexpected_list").alias("unexpected_sample"), "dag_run_id", "checked_at", F.to_date("checked_at").alias("check_date"),
    )


def scored_documents(documents: DataFrame, sentiment: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row per scored document: the grain that the marts build on."""
    joined = documents.join(sentiment, "document_id")
    if not cfg.include_synthetic:
        joined = joined.filter(~F.col("is_synthetic"))
    one = lambda label: F.when(F.col("effective_label") == label, 1).otherwise(0)
    return joined.withColumns({
        "is_kpi_eligible": F.col("confidence") >= cfg.min_confidence, "is_positive": one("positive"), "is_negative": one("negative"), "is_neutral": one("neutral"),
        "rating_implied_label": rating_label(F.col("rating")),
        "matches_intended_polarity": F.when(F.col("intended_polarity").isNotNull(), F.coalesce(F.col("intended_polarity") == F.col("effective_label"), F.lit(False))),
    })


SIGNALS = ("transformer", "emotion", "rating", "aspect", "llm_judge")


def signal_contributions(scored: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """The signals' scores from wide to long, missing ones left out: one scan, no union."""
    keys = ["document_id", "event_date", "source_platform", "effective_label", "confidence"]
    long = scored.select(*keys, *[F.col(f"{s}_score").alias(s) for s in SIGNALS]).unpivot(keys, list(SIGNALS), "signal_name", "signal_score")
    return long.filter(F.col("signal_score").isNotNull()).withColumn("signal_label", sentiment_label(F.col("signal_score"), cfg.neutral_band))
