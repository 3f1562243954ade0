"""Marts: pure functions from staged frames and a Config to a frame; nothing is run inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.config import DEFAULT, Config
from quern.functions.metrics import count_if, hours_between, net_sentiment, ratio, scaled, sum_if


def avg4(col: str, where: Column | None = None) -> Column:
    """Mean of a decimal(6,4), rounded once to four places."""
    c = scaled(F.col(col))
    if where is not None:
        c = F.when(where, c)
    return ratio(F.sum(c), F.count(c) * 10_000, 4)


def sentiment_daily(scored: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Per day, platform, source and synthetic flag, with sums over the last rolling_rows rows of the series."""
    daily = scored.filter("is_kpi_eligible").groupBy("event_date", "source_platform", "source_name", "is_synthetic").agg(
        F.count(F.lit(1)).alias("document_count"), F.sum("is_positive").alias("positive_count"), F.sum("is_negative").alias("negative_count"), F.sum("is_neutral").alias("neutral_count"),
        avg4("sentiment_score").alias("avg_sentiment_score"), avg4("confidence").alias("avg_confidence"), avg4("agreement").alias("avg_agreement"),
        count_if(F.col("requires_review")).alias("review_count"), F.sum("engagement_score").alias("total_engagement"),
    )
    total = F.col("document_count")
    nss = net_sentiment(F.col("positive_count"), F.col("negative_count"), total)
    # The series of one source: at most one row a day and flag, so the window never holds more than the days there are.
    w = Window.partitionBy("source_platform", "source_name", "is_synthetic").orderBy("event_date").rowsBetween(1 - cfg.rolling_rows, 0)
    return daily.withColumn("net_sentiment_score", nss).withColumns({
        "positive_share": ratio(F.col("positive_count"), total, 4), "negative_share": ratio(F.col("negative_count"), total, 4), "review_share": ratio(F.col("review_count"), total, 4),
        "net_sentiment_score_rolling": ratio(F.sum(F.round(F.col("net_sentiment_score") * 100).cast("bigint")).over(w), F.count("net_sentiment_score").over(w) * 100, 2),
        "document_count_rolling": F.sum("document_count").over(w),
    })


def sentiment_by_source(scored: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Scorecard of the last 90 and 30 days; without rows in the last 30 days its sums are null, not zero."""
    day = F.lit(cfg.as_of)
    late = F.col("event_date") >= F.date_sub(day, 30)
    base = scored.filter(F.col("is_kpi_eligible") & (F.col("event_date") >= F.date_sub(day, 90)))
    out = base.groupBy("source_platform", "source_name", "source_type", "is_synthetic").agg(
        F.count(F.lit(1)).alias("documents_90d"), count_if(late).alias("documents_30d"), F.sum("is_positive").alias("positive_90d"), F.sum("is_negative").alias("negative_90d"),
        sum_if(late, F.col("is_positive")).alias("positive_30d"), sum_if(late, F.col("is_negative")).alias("negative_30d"), avg4("sentiment_score").alias("avg_sentiment_score"),
        avg4("sentiment_score", late).alias("avg_sentiment_score_30d"), avg4("confidence").alias("avg_confidence"), F.sum("engagement_score").alias("total_engagement"), F.max("event_date").alias("last_document_date"),
    )
    out = out.withColumns({"nss_90d": net_sentiment(F.col("positive_90d"), F.col("negative_90d"), F.col("documents_90d")), "nss_30d": net_sentiment(F.col("positive_30d"), F.col("negative_30d"), F.col("documents_30d"))})
    return out.withColumns({"nss_delta_30d_vs_90d": F.round(F.col("nss_30d") - F.col("nss_90d"), 2), "days_since_last_document": F.date_diff(day, "last_document_date")})


def aspect_daily(aspects: DataFrame, scored: DataFrame) -> DataFrame:
    label = F.col("aspect_sentiment")
    facts = scored.filter("is_kpi_eligible").select("document_id", "event_date", "source_platform", "is_synthetic", "engagement_score")
    out = aspects.join(facts, "document_id").groupBy("event_date", "source_platform", "is_synthetic", "aspect_code", "aspect_label", "aspect_group").agg(
        F.count(F.lit(1)).alias("mention_documents"), F.sum("mentions").alias("mention_count"), count_if(label == "positive").alias("positive_count"), count_if(label == "negative").alias("negative_count"),
        count_if(label == "neutral").alias("neutral_count"), avg4("aspect_score").alias("avg_aspect_score"), F.sum("engagement_score").alias("total_engagement"),
    )
    return out.withColumn("aspect_nss", net_sentiment(F.col("positive_count"), F.col("negative_count"), F.col("mention_documents")))


def aspect_source_matrix(aspects: DataFrame, scored: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    label = F.col("aspect_sentiment")
    facts = scored.filter(F.col("is_kpi_eligible") & (F.col("event_date") >= F.date_sub(F.lit(cfg.as_of), 90))).select("document_id", "source_platform")
    agg = aspects.join(facts, "document_id").groupBy("source_platform", "aspect_code", "aspect_label", "aspect_group").agg(
        F.count(F.lit(1)).alias("mention_documents"), count_if(label == "positive").alias("positive_count"), count_if(label == "negative").alias("negative_count"), avg4("aspect_score").alias("avg_aspect_score")
    )
    return agg.withColumns({
        "aspect_nss": net_sentiment(F.col("positive_count"), F.col("negative_count"), F.col("mention_documents")),
        "share_of_voice_pct": ratio(F.col("mention_documents") * 100, F.sum("mention_documents").over(Window.partitionBy("source_platform")), 2),
    })


def aspect_rollup(aspects: DataFrame) -> DataFrame:
    """Per document: its aspects in order, those of either sentiment by score, and the worst. Ties go to the smaller code or label."""
    ordered = lambda label, sign: F.transform(F.array_sort(F.collect_list(F.when((F.col("aspect_sentiment") == label) & F.col("aspect_label").isNotNull(), F.struct((F.col("aspect_score") * sign).alias("s"), F.col("aspect_label").alias("l"))))), lambda x: x["l"])
    out = aspects.groupBy("document_id").agg(
        F.array_join(F.array_sort(F.collect_list("aspect_code")), ",").alias("aspect_codes"), ordered("negative", 1).alias("neg"), ordered("positive", -1).alias("pos"),
        F.min_by("aspect_code", F.struct("aspect_score", "aspect_code")).alias("worst_aspect_code"), F.min("aspect_score").alias("worst_aspect_score"),
    )
    text = lambda c: F.when(F.size(c) > 0, F.array_join(c, ","))
    return out.select("document_id", "aspect_codes", text("neg").alias("negative_aspects"), text("pos").alias("positive_aspects"), "worst_aspect_code", "worst_aspect_score")


def document_feed(scored: DataFrame, aspects: DataFrame) -> DataFrame:
    docs = scored.select(
        "document_id", "event_at", "event_date", "source_platform", "source_name", "source_type", "is_synthetic", "url", F.coalesce("title", F.left("body", F.lit(180))).alias("headline"),
        F.left(F.coalesce("body", F.lit("")), F.lit(1200)).alias("excerpt"), "author", "rating", "engagement_score", F.col("effective_label").alias("sentiment_label"), "sentiment_score", "confidence", "agreement",
        "requires_review", "review_reason", "human_reviewed", "model_version", "transformer_score", "emotion_score", "rating_score", "dominant_emotion", "rating_implied_label", "signal_contributions",
    )
    return docs.join(aspect_rollup(aspects), "document_id", "left")


REASONS = {"signal_conflict": "signals contradict each other", "low_confidence": "model confidence is low", "borderline_label": "score is at the neutral band", "insufficient_signals": "too little evidence", "low_confidence_after_llm": "confidence is low after arbitration"}


def review_queue(scored: DataFrame, aspects: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    worst = aspect_rollup(aspects).select("document_id", "worst_aspect_code", "worst_aspect_score")
    open_ = scored.filter(F.col("requires_review") & F.col("reviewed_label").isNull())
    # Whole units of 1e-6: half of (1 - confidence), a fifth of (1 - agreement), reach up to 100, and the risk aspects.
    units = (10_000 - scaled(F.col("confidence"))) * 50 + (10_000 - scaled(F.col("agreement"))) * 20 + F.least(F.col("engagement_score"), F.lit(100)) * 1_500 + F.when(F.col("worst_aspect_code").isin(*cfg.risk_aspects), 150_000).otherwise(0)
    reason = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv]), F.col("review_reason")), F.lit("needs review"))
    return open_.join(worst, "document_id", "left").select(
        "document_id", "event_at", "event_date", "source_platform", "source_name", "url", F.coalesce("title", F.left("body", F.lit(180))).alias("headline"), F.left(F.coalesce("body", F.lit("")), F.lit(800)).alias("excerpt"),
        "sentiment_label", "sentiment_score", "confidence", "agreement", "review_reason", "engagement_score", "worst_aspect_code", "worst_aspect_score", ratio(units, F.lit(1_000_000), 4).alias("review_priority"), reason.alias("reason_text"),
    )


def sentiment_alerts(daily_aspects: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """The recent days against the baseline before them, per platform and aspect."""
    day = F.lit(cfg.as_of)
    rows = daily_aspects if cfg.include_synthetic else daily_aspects.filter(~F.col("is_synthetic"))
    recent = rows.filter(F.col("event_date") >= F.date_sub(day, cfg.recent_days)).groupBy("source_platform", "aspect_code", "aspect_label", "aspect_group").agg(F.sum("mention_documents").alias("documents_7d"), F.avg("aspect_nss").alias("recent"))
    first, last = cfg.baseline_days
    base = rows.filter(F.col("event_date").between(F.date_sub(day, first), F.date_sub(day, last))).groupBy("source_platform", "aspect_code").agg(
        F.sum("mention_documents").alias("documents_baseline"), F.avg("aspect_nss").alias("base"), F.coalesce(F.stddev_samp("aspect_nss"), F.lit(0.0)).alias("volatility"), F.count(F.lit(1)).alias("baseline_days")
    )
    delta, vol = F.col("recent") - F.col("base"), F.col("volatility")
    z = F.try_divide(delta, F.nullif(vol, F.lit(0.0)))
    status = F.when((F.col("baseline_days") < 7) | (F.col("documents_7d") < 5), "insufficient_data").when(vol == 0, "no_variance").when(z <= -2, "deterioration_significant").when(z <= -1, "deterioration_watch").when(z >= 2, "improvement_significant").otherwise("stable")
    severity = F.when((F.col("documents_7d") >= 20) & (delta <= -15), "high").when((F.col("documents_7d") >= 10) & (delta <= -8), "medium").otherwise("low")
    return recent.join(base, ["source_platform", "aspect_code"]).select(
        "source_platform", "aspect_code", "aspect_label", "aspect_group", "documents_7d", "documents_baseline", F.round("recent", 2).alias("nss_7d"), F.round("base", 2).alias("nss_baseline"), F.round(delta, 2).alias("nss_delta"),
        F.round(vol, 2).alias("nss_volatility"), "baseline_days", F.round(z, 2).alias("z_score"), status.alias("alert_status"), severity.alias("severity"),
    )


def engine_quality(scored: DataFrame) -> DataFrame:
    """Three independent checks a day and model version, in one aggregation: rows without a rating or an intention only miss their counts."""
    rated, gold = F.col("rating_implied_label").isNotNull(), F.col("intended_polarity").isNotNull()
    agg = scored.groupBy("event_date", "model_version").agg(
        F.count(F.lit(1)).alias("documents_scored"), avg4("confidence").alias("avg_confidence"), avg4("agreement").alias("avg_agreement"), count_if(F.col("requires_review")).alias("review_count"),
        count_if(F.col("has_transformer_signal")).alias("transformer_signals"), count_if(F.col("has_emotion_signal")).alias("emotion_signals"), count_if(F.col("has_rating_signal")).alias("rating_signals"), count_if(F.col("escalated_to_llm")).alias("llm_escalations"),
        F.nullif(count_if(rated), F.lit(0)).alias("rated_documents"), count_if(rated & (F.col("rating_implied_label") == F.col("effective_label"))).alias("m"), count_if((F.col("rating_implied_label") == "negative") & (F.col("effective_label") == "positive")).alias("s"),
        F.nullif(count_if(gold), F.lit(0)).alias("gold_documents"), count_if(F.col("matches_intended_polarity")).alias("g"),
    )
    has_r, has_g = F.col("rated_documents").isNotNull(), F.col("gold_documents").isNotNull()
    agg = agg.withColumns({"rating_matches": F.when(has_r, F.col("m")), "severe_disagreements": F.when(has_r, F.col("s")), "gold_matches": F.when(has_g, F.col("g"))}).drop("m", "s", "g")
    return agg.withColumns({
        "review_rate": ratio(F.col("review_count"), F.col("documents_scored"), 4), "transformer_coverage": ratio(F.col("transformer_signals"), F.col("documents_scored"), 4),
        "rating_agreement_rate": ratio(F.col("rating_matches"), F.col("rated_documents"), 4), "gold_agreement_rate": ratio(F.col("gold_matches"), F.col("gold_documents"), 4),
    })


def pipeline_health(runs: DataFrame, quality: DataFrame) -> DataFrame:
    r = runs.groupBy(F.col("run_date").alias("report_date"), "connector").agg(
        F.count(F.lit(1)).alias("runs"), count_if(F.col("is_success")).alias("successes"), count_if(F.col("is_failure")).alias("failures"), count_if(F.col("is_skipped")).alias("skips"),
        F.sum("fetched_count").alias("fetched"), F.sum("inserted_count").alias("inserted"), F.sum("duplicate_count").alias("duplicates"), F.sum("irrelevant_count").alias("irrelevant"),
        ratio(F.sum("duration_micros"), F.count("duration_micros") * 1_000_000, 2).alias("avg_duration_seconds"),
    )
    q = quality.groupBy(F.col("check_date").alias("report_date")).agg(F.count(F.lit(1)).alias("expectations_run"), count_if(F.col("success")).alias("expectations_passed"), count_if(~F.col("success")).alias("expectations_failed"), F.max("evaluated_rows").alias("rows_validated"))
    return r.join(q, "report_date", "left").withColumns({
        "duplicate_rate": ratio(F.col("duplicates"), F.col("fetched"), 4), "yield_rate": ratio(F.col("inserted"), F.col("fetched"), 4), "quality_pass_rate": ratio(F.col("expectations_passed"), F.col("expectations_run"), 4)
    })


def engine_health(sentiment: DataFrame) -> DataFrame:
    """Signal coverage per day, version and mode, from the raw score table."""
    on = lambda k: count_if(F.get_json_object("signals", f"$.{k}.available").try_cast("boolean"))
    out = sentiment.groupBy(F.to_date("scored_at").alias("score_date"), "model_version", "engine_mode").agg(
        F.count(F.lit(1)).alias("documents_scored"), avg4("confidence").alias("avg_confidence"), avg4("agreement").alias("avg_agreement"), count_if(F.col("requires_review")).alias("review_count"),
        on("transformer").alias("transformer_available"), on("emotion").alias("emotion_available"), on("rating").alias("rating_available"), on("aspect").alias("aspect_available"),
    )
    return out.withColumn("review_rate_pct", ratio(F.col("review_count") * 100, F.col("documents_scored"), 2))


def ingestion_freshness(runs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    now = F.lit(cfg.as_of).cast("timestamp")
    late = F.col("started_at") >= F.date_sub(F.lit(cfg.as_of), 7).cast("timestamp")
    return runs.groupBy("connector").agg(
        F.unix_micros(F.max("finished_at")).alias("last_run_micros"), hours_between(now, F.max("finished_at")).alias("hours_since_last_run"), sum_if(late, F.col("inserted_count")).alias("inserted_7d"),
        sum_if(late, F.col("duplicate_count")).alias("duplicates_7d"), count_if(late & (F.col("status") == "success")).alias("successes_7d"), count_if(late & F.col("status").isin("failed", "unavailable")).alias("failures_7d"),
    )


def documents_with_sentiment(docs: DataFrame, sentiment: DataFrame) -> DataFrame:
    """The flat operational view of a document and its score."""
    d = docs.select("document_id", "doc_uid", "source_platform", "source_name", "source_type", "title", "body", "url", "author", "language", "rating", "published_at", "relevance_score", F.coalesce(F.get_json_object("raw_payload", "$.is_synthetic").try_cast("boolean"), F.lit(False)).alias("is_synthetic"))
    s = sentiment.select("document_id", "sentiment_label", "sentiment_score", "confidence", "agreement", "requires_review", "review_reason", "reviewed_label", "model_version", "engine_mode", "signals", "explanation")
    return d.join(s, "document_id")


def open_reviews(docs: DataFrame, sentiment: DataFrame) -> DataFrame:
    s = sentiment.filter(F.col("requires_review") & F.col("reviewed_label").isNull()).select("document_id", "sentiment_label", "sentiment_score", "confidence", "agreement", "review_reason", F.get_json_object("explanation", "$.contributions").alias("signal_contributions"))
    d = docs.select("document_id", "source_platform", "source_name", "url", "published_at", F.coalesce("title", F.left("body", F.lit(160))).alias("preview"))
    return d.join(s, "document_id").orderBy(F.col("confidence").asc_nulls_last(), F.col("published_at").desc_nulls_first())
