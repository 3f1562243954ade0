"""SQL for DuckDB, for the side-by-side check: one WITH chain of models, and a final SELECT for each query."""

from __future__ import annotations

AS_OF = "DATE '2025-08-31'"


def ratio(n: str, d: str, digits: int) -> str:
    """n / d of whole numbers rounded half away from zero, in integer arithmetic."""
    n, d = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)"
    return f"CASE WHEN ({n}) IS NULL OR coalesce({d}, 0) = 0 THEN NULL ELSE CAST(sign({n}) * ((abs({n}) * {2 * 10**digits} + {d}) // (2 * {d})) AS DOUBLE) / {10**digits}.0 END"


def nss(p: str, n: str, t: str, digits: int = 2) -> str:
    return ratio(f"(({p}) - ({n})) * 100", t, digits)


def avg4(c: str, where: str = "TRUE") -> str:
    return ratio(f"sum(CAST({c} * 10000 AS BIGINT)) FILTER (WHERE {where})", f"count({c}) FILTER (WHERE {where}) * 10000", 4)


def flag(path: str) -> str:
    return f"coalesce(TRY_CAST(json_extract_string(signals, '$.{path}.available') AS BOOLEAN), FALSE)"


def num(path: str) -> str:
    return f"TRY_CAST(json_extract_string(signals, '$.{path}') AS DOUBLE)"


_ZONED = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"

MODELS = {
    "stg_documents": f"""
SELECT *, CAST(event_at AS DATE) AS event_date, CAST(date_trunc('week', event_at) AS DATE) AS event_week, CAST(date_trunc('month', event_at) AS DATE) AS event_month, published IS NULL AS used_ingested_at_fallback
FROM (SELECT document_id, doc_uid, lower(trim(source_platform)) AS source_platform, lower(trim(source_name)) AS source_name, source_type, external_id, url, nullif(trim(title), '') AS title, nullif(trim(body), '') AS body, nullif(trim(author), '') AS author,
  language, rating, published, content_hash, relevance_score,
  coalesce(TRY_CAST(json_extract_string(raw_payload, '$.is_synthetic') AS BOOLEAN), FALSE) AS is_synthetic, coalesce(TRY_CAST(json_extract_string(raw_payload, '$.is_adversarial') AS BOOLEAN), FALSE) AS is_adversarial,
  json_extract_string(raw_payload, '$.intended_polarity') AS intended_polarity, json_extract_string(raw_payload, '$.collector') AS collector,
  length(coalesce(title, '') || ' ' || coalesce(body, '')) AS text_length,
  coalesce(TRY_CAST(json_extract_string(engagement, '$.score') AS INT), TRY_CAST(json_extract_string(engagement, '$.likes') AS INT), TRY_CAST(json_extract_string(engagement, '$.thumbs_up') AS INT), 0) AS engagement_score,
  coalesce(published, ingested_at) AS event_at
  FROM (SELECT *, CASE WHEN regexp_matches(published_at, '{_ZONED}') THEN TRY_CAST(published_at AS TIMESTAMPTZ) END AS published FROM raw_documents)
  WHERE coalesce(title, '') <> '' OR coalesce(body, '') <> '')""",
    "stg_sentiment": f"""
SELECT document_id, sentiment_label, reviewed_label, coalesce(reviewed_label, sentiment_label) AS effective_label, reviewed_label IS NOT NULL AS human_reviewed, sentiment_score, confidence, agreement, requires_review, review_reason, model_version, engine_mode, scored_at,
  {num("transformer.score")} AS transformer_score, {num("emotion.score")} AS emotion_score, {num("rating.score")} AS rating_score, {num("aspect.score")} AS aspect_score, {num("llm_judge.score")} AS llm_judge_score,
  {flag("transformer")} AS has_transformer_signal, {flag("emotion")} AS has_emotion_signal, {flag("rating")} AS has_rating_signal, {flag("llm_judge")} AS escalated_to_llm, {num("transformer.normalized_entropy")} AS transformer_entropy,
  json_extract_string(signals, '$.emotion.dominant_emotion') AS dominant_emotion, json_extract_string(explanation, '$.contributions') AS signal_contributions
FROM document_sentiment""",
    "stg_aspects": """
SELECT s.document_id, s.aspect_code, d.aspect_label, d.aspect_group, d.description AS aspect_description, s.mentions, s.sentiment_label AS aspect_sentiment, s.sentiment_score AS aspect_score, s.matched_keywords, json_extract_string(s.evidence, '$.window_sample') AS window_sample
FROM document_aspect_sentiment s LEFT JOIN dim_aspect d ON d.aspect_code = s.aspect_code""",
    "stg_runs": f"""
SELECT run_id, connector, status, status = 'success' AS is_success, status LIKE 'skipped%' AS is_skipped, status IN ('failed', 'unavailable') AS is_failure, started_at, finished_at, epoch_us(finished_at) - epoch_us(started_at) AS duration_micros,
  fetched_count, inserted_count, duplicate_count, irrelevant_count, {ratio("duplicate_count", "fetched_count", 4)} AS duplicate_rate, message, CAST(started_at AS DATE) AS run_date
FROM ingestion_runs""",
    "stg_quality": """
SELECT result_id, suite_name, expectation, column_name, success, evaluated_rows, TRY_CAST(json_extract_string(observed, '$.unexpected_count') AS INT) AS unexpected_count, TRY_CAST(json_extract_string(observed, '$.unexpected_percent') AS DOUBLE) AS unexpected_percent,
  json_extract_string(observed, '$.partial_unexpected_list') AS unexpected_sample, dag_run_id, checked_at, CAST(checked_at AS DATE) AS check_date
FROM data_quality_results""",
    "scored": """
SELECT d.*, s.* EXCLUDE (document_id), s.confidence >= 0.45 AS is_kpi_eligible, CASE WHEN effective_label = 'positive' THEN 1 ELSE 0 END AS is_positive, CASE WHEN effective_label = 'negative' THEN 1 ELSE 0 END AS is_negative, CASE WHEN effective_label = 'neutral' THEN 1 ELSE 0 END AS is_neutral,
  CASE WHEN rating IS NULL THEN NULL WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative' ELSE 'neutral' END AS rating_implied_label,
  CASE WHEN intended_polarity IS NULL THEN NULL WHEN intended_polarity = effective_label THEN TRUE ELSE FALSE END AS matches_intended_polarity
FROM stg_documents d JOIN stg_sentiment s ON s.document_id = d.document_id""",
    "signal_long": """
SELECT document_id, event_date, source_platform, effective_label, confidence, signal_name, signal_score, CASE WHEN signal_score > 0.12 THEN 'positive' WHEN signal_score < -0.12 THEN 'negative' ELSE 'neutral' END AS signal_label
FROM (SELECT document_id, event_date, source_platform, effective_label, confidence, unnest(['transformer', 'emotion', 'rating', 'aspect', 'llm_judge']) AS signal_name, unnest([transformer_score, emotion_score, rating_score, aspect_score, llm_judge_score]) AS signal_score FROM scored)
WHERE signal_score IS NOT NULL""",
    "daily0": f"""
SELECT event_date, source_platform, source_name, is_synthetic, count(*) AS document_count, sum(is_positive) AS positive_count, sum(is_negative) AS negative_count, sum(is_neutral) AS neutral_count,
  {avg4("sentiment_score")} AS avg_sentiment_score, {avg4("confidence")} AS avg_confidence, {avg4("agreement")} AS avg_agreement, count(*) FILTER (WHERE requires_review) AS review_count, sum(engagement_score) AS total_engagement
FROM scored WHERE is_kpi_eligible GROUP BY ALL""",
    "sentiment_daily": f"""
SELECT *, {ratio("positive_count", "document_count", 4)} AS positive_share, {ratio("negative_count", "document_count", 4)} AS negative_share, {ratio("review_count", "document_count", 4)} AS review_share,
  {ratio("sum(CAST(round(net_sentiment_score * 100) AS BIGINT)) OVER w", "count(net_sentiment_score) OVER w * 100", 2)} AS net_sentiment_score_rolling, sum(document_count) OVER w AS document_count_rolling
FROM (SELECT *, {nss("positive_count", "negative_count", "document_count")} AS net_sentiment_score FROM daily0)
WINDOW w AS (PARTITION BY source_platform, source_name, is_synthetic ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "by_source": f"""
SELECT *, {nss("positive_90d", "negative_90d", "documents_90d")} AS nss_90d, {nss("positive_30d", "negative_30d", "documents_30d")} AS nss_30d, round({nss("positive_30d", "negative_30d", "documents_30d")} - {nss("positive_90d", "negative_90d", "documents_90d")}, 2) AS nss_delta_30d_vs_90d, {AS_OF} - last_document_date AS days_since_last_document
FROM (SELECT source_platform, source_name, source_type, is_synthetic, count(*) AS documents_90d, count(*) FILTER (WHERE late) AS documents_30d, sum(is_positive) AS positive_90d, sum(is_negative) AS negative_90d, sum(is_positive) FILTER (WHERE late) AS positive_30d, sum(is_negative) FILTER (WHERE late) AS negative_30d,
  {avg4("sentiment_score")} AS avg_sentiment_score, {avg4("sentiment_score", "late")} AS avg_sentiment_score_30d, {avg4("confidence")} AS avg_confidence, sum(engagement_score) AS total_engagement, max(event_date) AS last_document_date
  FROM (SELECT *, event_date >= {AS_OF} - 30 AS late FROM scored WHERE is_kpi_eligible AND event_date >= {AS_OF} - 90) GROUP BY source_platform, source_name, source_type, is_synthetic)""",
    "aspect_daily": f"""
SELECT *, {nss("positive_count", "negative_count", "mention_documents")} AS aspect_nss FROM (
SELECT event_date, source_platform, is_synthetic, aspect_code, aspect_label, aspect_group, count(*) AS mention_documents, sum(mentions) AS mention_count, count(*) FILTER (WHERE aspect_sentiment = 'positive') AS positive_count, count(*) FILTER (WHERE aspect_sentiment = 'negative') AS negative_count,
  count(*) FILTER (WHERE aspect_sentiment = 'neutral') AS neutral_count, {avg4("a.aspect_score")} AS avg_aspect_score, sum(engagement_score) AS total_engagement
FROM stg_aspects a JOIN (SELECT document_id, event_date, source_platform, is_synthetic, engagement_score FROM scored WHERE is_kpi_eligible) s USING (document_id) GROUP BY ALL)""",
    "aspect_matrix": f"""
SELECT *, {nss("positive_count", "negative_count", "mention_documents")} AS aspect_nss, {ratio("mention_documents * 100", "sum(mention_documents) OVER (PARTITION BY source_platform)", 2)} AS share_of_voice_pct FROM (
SELECT source_platform, aspect_code, aspect_label, aspect_group, count(*) AS mention_documents, count(*) FILTER (WHERE aspect_sentiment = 'positive') AS positive_count, count(*) FILTER (WHERE aspect_sentiment = 'negative') AS negative_count, {avg4("a.aspect_score")} AS avg_aspect_score
FROM stg_aspects a JOIN (SELECT document_id, source_platform FROM scored WHERE is_kpi_eligible AND event_date >= {AS_OF} - 90) s USING (document_id) GROUP BY ALL)""",
    "rollup_aspects": """
SELECT document_id, string_agg(aspect_code, ',' ORDER BY aspect_code) AS aspect_codes, string_agg(aspect_label, ',' ORDER BY aspect_score, aspect_label) FILTER (WHERE aspect_sentiment = 'negative') AS negative_aspects,
  string_agg(aspect_label, ',' ORDER BY aspect_score DESC, aspect_label) FILTER (WHERE aspect_sentiment = 'positive') AS positive_aspects, arg_min(aspect_code, (aspect_score, aspect_code)) AS worst_aspect_code, min(aspect_score) AS worst_aspect_score
FROM stg_aspects GROUP BY document_id""",
    "feed": """
SELECT d.document_id, event_at, event_date, source_platform, source_name, source_type, is_synthetic, url, coalesce(title, left(body, 180)) AS headline, left(coalesce(body, ''), 1200) AS excerpt, author, rating, engagement_score, effective_label AS sentiment_label, sentiment_score, confidence, agreement,
  requires_review, review_reason, human_reviewed, model_version, transformer_score, emotion_score, rating_score, dominant_emotion, rating_implied_label, signal_contributions, aspect_codes, negative_aspects, positive_aspects, worst_aspect_code, worst_aspect_score
FROM scored d LEFT JOIN rollup_aspects a ON a.document_id = d.document_id""",
    "queue": f"""
SELECT d.document_id, event_at, event_date, source_platform, source_name, url, coalesce(title, left(body, 180)) AS headline, left(coalesce(body, ''), 800) AS excerpt, sentiment_label, sentiment_score, confidence, agreement, review_reason, engagement_score, worst_aspect_code, worst_aspect_score,
  {ratio("(10000 - CAST(confidence * 10000 AS BIGINT)) * 50 + (10000 - CAST(agreement * 10000 AS BIGINT)) * 20 + least(engagement_score, 100) * 1500 + CASE WHEN worst_aspect_code IN ('security', 'funds') THEN 150000 ELSE 0 END", "1000000", 4)} AS review_priority,
  CASE review_reason WHEN 'signal_conflict' THEN 'signals contradict each other' WHEN 'low_confidence' THEN 'model confidence is low' WHEN 'borderline_label' THEN 'score is at the neutral band' WHEN 'insufficient_signals' THEN 'too little evidence' WHEN 'low_confidence_after_llm' THEN 'confidence is low after arbitration' ELSE 'needs review' END AS reason_text
FROM scored d LEFT JOIN rollup_aspects a ON a.document_id = d.document_id WHERE requires_review AND reviewed_label IS NULL""",
    "alerts": f"""
SELECT r.*, documents_baseline, base, volatility, baseline_days, recent - base AS delta, CASE WHEN volatility <> 0 THEN (recent - base) / volatility END AS z
FROM (SELECT source_platform, aspect_code, aspect_label, aspect_group, sum(mention_documents) AS documents_7d, avg(aspect_nss) AS recent FROM aspect_daily WHERE event_date >= {AS_OF} - 7 GROUP BY 1, 2, 3, 4) r
JOIN (SELECT source_platform, aspect_code, sum(mention_documents) AS documents_baseline, avg(aspect_nss) AS base, coalesce(stddev_samp(aspect_nss), 0) AS volatility, count(*) AS baseline_days FROM aspect_daily WHERE event_date BETWEEN {AS_OF} - 35 AND {AS_OF} - 8 GROUP BY 1, 2) b
ON r.source_platform = b.source_platform AND r.aspect_code = b.aspect_code""",
    "alert_rows": """
SELECT source_platform, aspect_code, aspect_label, aspect_group, documents_7d, documents_baseline, round(recent, 2) AS nss_7d, round(base, 2) AS nss_baseline, round(delta, 2) AS nss_delta, round(volatility, 2) AS nss_volatility, baseline_days, round(z, 2) AS z_score,
  CASE WHEN baseline_days < 7 OR documents_7d < 5 THEN 'insufficient_data' WHEN volatility = 0 THEN 'no_variance' WHEN z <= -2 THEN 'deterioration_significant' WHEN z <= -1 THEN 'deterioration_watch' WHEN z >= 2 THEN 'improvement_significant' ELSE 'stable' END AS alert_status,
  CASE WHEN documents_7d >= 20 AND delta <= -15 THEN 'high' WHEN documents_7d >= 10 AND delta <= -8 THEN 'medium' ELSE 'low' END AS severity
FROM alerts""",
    "engine_quality": f"""
SELECT c.*, r.rated_documents, r.rating_matches, r.severe_disagreements, g.gold_documents, g.gold_matches, {ratio("review_count", "documents_scored", 4)} AS review_rate, {ratio("transformer_signals", "documents_scored", 4)} AS transformer_coverage, {ratio("rating_matches", "rated_documents", 4)} AS rating_agreement_rate, {ratio("gold_matches", "gold_documents", 4)} AS gold_agreement_rate
FROM (SELECT event_date, model_version, count(*) AS documents_scored, {avg4("confidence")} AS avg_confidence, {avg4("agreement")} AS avg_agreement, count(*) FILTER (WHERE requires_review) AS review_count, count(*) FILTER (WHERE has_transformer_signal) AS transformer_signals, count(*) FILTER (WHERE has_emotion_signal) AS emotion_signals,
  count(*) FILTER (WHERE has_rating_signal) AS rating_signals, count(*) FILTER (WHERE escalated_to_llm) AS llm_escalations FROM scored GROUP BY 1, 2) c
LEFT JOIN (SELECT event_date, model_version, count(*) AS rated_documents, count(*) FILTER (WHERE rating_implied_label = effective_label) AS rating_matches, count(*) FILTER (WHERE rating_implied_label = 'negative' AND effective_label = 'positive') AS severe_disagreements FROM scored WHERE rating_implied_label IS NOT NULL GROUP BY 1, 2) r USING (event_date, model_version)
LEFT JOIN (SELECT event_date, model_version, count(*) AS gold_documents, count(*) FILTER (WHERE matches_intended_polarity) AS gold_matches FROM scored WHERE intended_polarity IS NOT NULL GROUP BY 1, 2) g USING (event_date, model_version)""",
    "pipeline_health": f"""
SELECT r.*, expectations_run, expectations_passed, expectations_failed, rows_validated, {ratio("duplicates", "fetched", 4)} AS duplicate_rate, {ratio("inserted", "fetched", 4)} AS yield_rate, {ratio("expectations_passed", "expectations_run", 4)} AS quality_pass_rate
FROM (SELECT run_date AS report_date, connector, count(*) AS runs, count(*) FILTER (WHERE is_success) AS successes, count(*) FILTER (WHERE is_failure) AS failures, count(*) FILTER (WHERE is_skipped) AS skips, sum(fetched_count) AS fetched, sum(inserted_count) AS inserted, sum(duplicate_count) AS duplicates, sum(irrelevant_count) AS irrelevant,
  {ratio("sum(duration_micros)", "count(duration_micros) * 1000000", 2)} AS avg_duration_seconds FROM stg_runs GROUP BY 1, 2) r
LEFT JOIN (SELECT check_date AS report_date, count(*) AS expectations_run, count(*) FILTER (WHERE success) AS expectations_passed, count(*) FILTER (WHERE NOT success) AS expectations_failed, max(evaluated_rows) AS rows_validated FROM stg_quality GROUP BY 1) q USING (report_date)""",
}


def chain(final: str) -> str:
    """`final` with the models that it needs, in order, as a WITH chain."""
    names = list(MODELS)
    need: set[str] = set()

    def pull(text: str) -> None:
        import re

        for m in names:
            if m not in need and re.search(rf"\b{m}\b", text):
                need.add(m)
                pull(MODELS[m])

    pull(final)
    return ("WITH " + ",\n".join(f"{m} AS ({MODELS[m]})" for m in names if m in need) + "\n" if need else "") + final
