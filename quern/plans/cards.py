"""Report queries over the marts, with optional filters that vanish when unset."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.config import DEFAULT, Config
from quern.functions.metrics import count_if, hours_between, net_sentiment, ratio, scaled


@dataclass(frozen=True)
class Filters:
    start: dt.date | None = None
    end: dt.date | None = None
    platform: str | None = None
    aspect: str | None = None

    def on(self, df: DataFrame, date_col: str = "event_date") -> DataFrame:
        """df under the filters that are set and that it has columns for; values are literals, never spliced into text."""
        for value, column, keep in (
            (self.start, date_col, lambda c, v: c >= v), (self.end, date_col, lambda c, v: c <= v),
            (self.platform, "source_platform", lambda c, v: c == v), (self.aspect, "aspect_label", lambda c, v: c == v),
        ):
            if value is not None and column in df.columns:
                df = df.filter(keep(F.col(column), F.lit(value)))
        return df


def _nss1(total: str = "document_count"):
    return net_sentiment(F.sum("positive_count"), F.sum("negative_count"), F.sum(total), 1)


def kpis(daily: DataFrame, f: Filters = Filters()) -> DataFrame:
    """Documents, net sentiment and negative share in one row."""
    return f.on(daily).agg(F.sum("document_count").alias("documents"), _nss1().alias("nss"), ratio(F.sum("negative_count") * 100, F.sum("document_count"), 1).alias("negative_pct"))


def review_count(queue: DataFrame, f: Filters = Filters()) -> DataFrame:
    return f.on(queue).agg(F.count(F.lit(1)).alias("open_reviews"))


def monthly_trend(daily: DataFrame, f: Filters = Filters()) -> DataFrame:
    return f.on(daily).groupBy(F.to_date(F.date_trunc("month", "event_date")).alias("month")).agg(F.sum("document_count").alias("documents"), _nss1().alias("nss")).orderBy("month")


def platform_mix(daily: DataFrame, f: Filters = Filters()) -> DataFrame:
    return f.on(daily).groupBy("source_platform").agg(F.sum("positive_count").alias("positive"), F.sum("neutral_count").alias("neutral"), F.sum("negative_count").alias("negative")).orderBy((F.col("positive") + F.col("neutral") + F.col("negative")).desc(), "source_platform")


def aspect_ranking(aspects: DataFrame, f: Filters = Filters()) -> DataFrame:
    return f.on(aspects).groupBy("aspect_label").agg(_nss1("mention_documents").alias("aspect_nss"), F.sum("mention_documents").alias("documents")).orderBy(F.col("aspect_nss").asc_nulls_last(), "aspect_label")


def aspect_trend(aspects: DataFrame, f: Filters = Filters(), least: int = 3) -> DataFrame:
    months = f.on(aspects).groupBy(F.to_date(F.date_trunc("month", "event_date")).alias("month"), "aspect_label")
    return months.agg(_nss1("mention_documents").alias("nss"), F.sum("mention_documents").alias("documents")).filter(F.col("documents") >= least).drop("documents")


def aspect_platform_matrix(aspects: DataFrame, f: Filters = Filters()) -> DataFrame:
    agg = f.on(aspects).groupBy("aspect_label", "source_platform").agg(F.sum("mention_documents").alias("documents"), net_sentiment(F.sum("positive_count"), F.sum("negative_count"), F.sum("mention_documents")).alias("nss"))
    return agg.withColumn("share_of_voice_pct", ratio(F.col("documents") * 100, F.sum("documents").over(Window.partitionBy("source_platform")), 2))


def source_scorecard(daily: DataFrame, f: Filters = Filters(), least: int = 2) -> DataFrame:
    """Each source over the period and over its last 90 days; the last date is one joined row, not a window over everything."""
    scoped = f.on(daily)
    rows = scoped.crossJoin(F.broadcast(scoped.agg(F.max("event_date").alias("last"))))
    recent = F.col("event_date") > F.date_sub(F.col("last"), 90)
    only = lambda c: F.sum(F.when(recent, F.col(c)))
    out = rows.groupBy("source_platform", "source_name").agg(
        F.sum("document_count").alias("documents"), F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"), _nss1().alias("nss_period"),
        net_sentiment(only("positive_count"), only("negative_count"), only("document_count"), 1).alias("nss_recent"), ratio(F.sum(F.round(F.col("avg_confidence") * 10_000).cast("bigint") * F.col("document_count")), F.sum("document_count") * 10_000, 4).alias("avg_confidence"),
    )
    return out.filter(F.col("documents") >= least).withColumn("delta", F.round(F.col("nss_recent") - F.col("nss_period"), 1)).orderBy(F.col("delta").asc_nulls_last(), F.col("documents").desc(), "source_name")


_RANK = {"deterioration_significant": 0, "deterioration_watch": 1}


def alert_list(alerts: DataFrame, f: Filters = Filters()) -> DataFrame:
    rank = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in _RANK.items() for x in kv]), F.col("alert_status")), F.lit(2))
    return f.on(alerts).orderBy(rank, F.col("z_score").asc_nulls_last(), "source_platform", "aspect_code").select("aspect_label", "source_platform", "nss_7d", "nss_baseline", "nss_delta", "z_score", "severity", "alert_status")


def review_top(queue: DataFrame, f: Filters = Filters(), k: int = 100) -> DataFrame:
    return f.on(queue).orderBy(F.col("review_priority").desc_nulls_last(), "document_id").limit(k).select("document_id", "event_date", "source_platform", "headline", "sentiment_label", F.col("confidence").cast("double").alias("confidence"), "reason_text", "review_priority")


def engine_monthly(quality: DataFrame, f: Filters = Filters()) -> DataFrame:
    """Volume-weighted monthly rates: sums of matches over sums of documents."""
    pct = lambda a, b: ratio(F.sum(a) * 100, F.sum(b), 1)
    weighted = F.sum(F.round(F.col("avg_confidence") * 10_000).cast("bigint") * F.col("documents_scored"))
    return f.on(quality).groupBy(F.to_date(F.date_trunc("month", "event_date")).alias("month")).agg(pct("rating_matches", "rated_documents").alias("rating_match_pct"), pct("gold_matches", "gold_documents").alias("gold_match_pct"), ratio(weighted * 100, F.sum("documents_scored") * 10_000, 1).alias("confidence_pct"))


def pipeline_top(health: DataFrame, f: Filters = Filters(), k: int = 200) -> DataFrame:
    return f.on(health, "report_date").orderBy(F.col("report_date").desc_nulls_last(), "connector").limit(k).select("report_date", "connector", "fetched", "inserted", "duplicates", F.round(F.col("duplicate_rate") * 100, 1).alias("duplicate_pct"), "failures", "expectations_failed")


def feed_top(feed: DataFrame, f: Filters = Filters(), k: int = 500) -> DataFrame:
    cols = ["document_id", "event_date", "source_platform", "source_name", "sentiment_label", F.col("sentiment_score").cast("double").alias("sentiment_score"), F.col("confidence").cast("double").alias("confidence"), "headline", "rating", "negative_aspects", "positive_aspects", "url"]
    return f.on(feed).orderBy(F.col("event_at").desc_nulls_last(), "document_id", "sentiment_score", "confidence").limit(k).select(*cols)


def quality_trend(quality: DataFrame, f: Filters = Filters()) -> DataFrame:
    return f.on(quality, "check_date").groupBy("check_date").agg(F.count(F.lit(1)).alias("total"), count_if(~F.col("success")).alias("failed"), ratio(count_if(F.col("success")) * 100, F.count(F.lit(1)), 1).alias("passed_pct"))


def failing_expectations(quality: DataFrame, f: Filters = Filters(), k: int = 20) -> DataFrame:
    failed = count_if(~F.col("success"))
    return f.on(quality, "check_date").groupBy("expectation", "column_name").agg(failed.alias("failed"), F.count(F.lit(1)).alias("total")).filter("failed > 0").orderBy(F.col("failed").desc(), "expectation", F.col("column_name").asc_nulls_last()).limit(k)


def connector_freshness(runs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    now = F.lit(cfg.as_of).cast("timestamp")
    late = runs.filter(F.col("started_at") >= F.date_sub(F.lit(cfg.as_of), 30).cast("timestamp"))
    return late.groupBy("connector").agg(F.unix_micros(F.max("started_at")).alias("last_run_micros"), F.unix_micros(F.max(F.when(F.col("is_success"), F.col("started_at")))).alias("last_success_micros"), hours_between(now, F.max("started_at"), 1).alias("age_hours"))


def latest_gate(quality: DataFrame) -> DataFrame:
    """The results of the latest check; the latest time is one joined row."""
    last = quality.agg(F.max("checked_at").alias("checked_at"))
    return quality.join(F.broadcast(last), "checked_at").select("expectation", "column_name", "success", "unexpected_count", "unexpected_percent", F.unix_micros("checked_at").alias("checked_micros"))


def storage_sizes(spark, sf_dir: str, tables: list[str]) -> DataFrame:
    """Bytes and files of each table on its file system, largest first."""
    jvm = spark._jvm
    rows = []
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            s = fs.getContentSummary(path)
            rows.append((t, int(s.getLength()), int(s.getFileCount())))
    return spark.createDataFrame(rows, "table_name string, bytes long, files long").orderBy(F.col("bytes").desc())


CARDS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "kpis": ("sentiment_daily", kpis), "review_count": ("review_queue", review_count), "monthly_trend": ("sentiment_daily", monthly_trend), "platform_mix": ("sentiment_daily", platform_mix), "aspect_ranking": ("aspect_daily", aspect_ranking),
    "aspect_trend": ("aspect_daily", aspect_trend), "aspect_platform_matrix": ("aspect_daily", aspect_platform_matrix), "source_scorecard": ("sentiment_daily", source_scorecard), "alert_list": ("sentiment_alerts", alert_list), "review_top": ("review_queue", review_top),
    "engine_monthly": ("engine_quality", engine_monthly), "pipeline_top": ("pipeline_health", pipeline_top), "feed_top": ("document_feed", feed_top), "quality_trend": ("stg_quality", quality_trend), "failing_expectations": ("stg_quality", failing_expectations),
}


def scoped(df: DataFrame, days: int | None = None, platform: str | None = None, synthetic: bool = True, date_col: str = "event_date", cfg: Config = DEFAULT) -> DataFrame:
    """The rows of the last `days` days, of one platform, and with or without synthetic documents; each is optional."""
    if days:
        df = df.filter(F.col(date_col) >= F.date_sub(F.lit(cfg.as_of), days))
    if platform:
        df = df.filter(F.col("source_platform") == platform)
    return df if synthetic else df.filter(~F.coalesce("is_synthetic", F.lit(False)))


def export_documents(feed: DataFrame, docs: DataFrame) -> DataFrame:
    """The feed with whole texts instead of excerpts."""
    whole = docs.select("document_id", F.col("title").alias("t"), F.col("body").alias("b"))
    text = lambda full, short: F.coalesce(F.when(F.col(full) != "", F.col(full)), F.col(short))
    return feed.join(whole, "document_id").select(
        "document_id", "event_date", "source_platform", "source_name", text("t", "headline").alias("title"), text("b", "excerpt").alias("body"), "url", "sentiment_label", F.col("sentiment_score").cast("double").alias("sentiment_score"), F.col("confidence").cast("double").alias("confidence"),
        "dominant_emotion", "rating", "negative_aspects", "positive_aspects", "requires_review", "review_reason", "model_version",
    )


def export_aspects(aspects: DataFrame) -> DataFrame:
    return aspects.groupBy("aspect_label", "aspect_group").agg(F.sum("mention_documents").alias("documents"), F.sum("positive_count").alias("positive_count"), F.sum("neutral_count").alias("neutral_count"), F.sum("negative_count").alias("negative_count"), _nss1("mention_documents").alias("nss"))


def export_sources(daily: DataFrame) -> DataFrame:
    weighted = F.sum(F.round(F.col("avg_confidence") * 10_000).cast("bigint") * F.col("document_count"))
    return daily.groupBy("source_platform", "source_name").agg(
        F.sum("document_count").alias("documents"), F.sum("positive_count").alias("positive_count"), F.sum("neutral_count").alias("neutral_count"), F.sum("negative_count").alias("negative_count"), _nss1().alias("nss"),
        ratio(weighted, F.sum("document_count") * 10_000, 3).alias("avg_confidence"), F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"),
    )


__all__ = ["CARDS", "Filters", "scaled"]
