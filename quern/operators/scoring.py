"""Scoring: aspects found in text, signals blended into a score with a confidence and a review decision.

Everything is column arithmetic over an array of signals; a model is any function that adds a score column (see `Scorer`).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.metrics import four_places
from quern.functions.text import chunks, clauses, clean_text, keyword_pattern, normalize_tokens

Scorer = Callable[[DataFrame], DataFrame]
#: Texts -> for each a map label -> probability.
Classifier = Callable[[list[str]], list[dict[str, float]]]


@dataclass(frozen=True)
class Weights:
    """Fixed values of the blend."""

    base: dict[str, float] = field(default_factory=lambda: {"transformer": 0.55, "emotion": 0.15, "rating": 0.18, "aspect": 0.12})
    judge: float = 0.35
    confidence: dict[str, float] = field(default_factory=lambda: {"agreement": 0.35, "coverage": 0.20, "evidence": 0.20, "margin": 0.25})
    platforms: dict[str, dict[str, float]] = field(default_factory=lambda: {"news": {"emotion": 0.6, "transformer": 1.05}, "playstore": {"rating": 1.25, "emotion": 1.15}, "appstore": {"rating": 1.25, "emotion": 1.15}, "twitter": {"emotion": 1.2}, "youtube": {"emotion": 1.2}, "reddit": {"emotion": 1.2}, "kaskus": {"emotion": 1.2}, "google_maps": {"rating": 1.25, "emotion": 1.15}})
    band: float = 0.12
    review_below: float = 0.55
    conflict: float = 0.35


def rating_signal(stars: Column) -> Column:
    """1 to 5 stars to -1 to 1; any other value is no signal."""
    return F.when(stars.between(1, 5), (stars - 3) / 2.0)


def aspect_signal(aspects: DataFrame) -> DataFrame:
    """(document_id, aspect_signal): mean of the aspects' scores weighted by 1 + 0.15 * mentions, five mentions at most counted."""
    w = 1 + 0.15 * F.least(F.col("mentions"), F.lit(5))
    return aspects.groupBy("document_id").agg((F.sum(F.col("sentiment_score").cast("double") * w) / F.sum(w)).alias("aspect_signal"))


def combined(signals: Column) -> Column:
    """Mean of the signals' scores by weight, each share rounded to four places, between -1 and 1; 0 without signals. signals: array of (name, score, weight)."""
    total = F.aggregate(signals, F.lit(0.0), lambda a, s: a + s["weight"])
    score = F.aggregate(signals, F.lit(0.0), lambda a, s: a + four_places(s["score"] * s["weight"] / total))
    return F.when(F.size(signals) == 0, 0.0).otherwise(four_places(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score))))


def agreement(signals: Column) -> Column:
    """1 where all signals say the same, 0 where they conflict as much as they can (their standard deviation is 1); 0.6 for fewer than two."""
    n = F.size(signals)
    mean = F.try_divide(F.aggregate(signals, F.lit(0.0), lambda a, s: a + s["score"]), n)
    spread = F.sqrt(F.try_divide(F.aggregate(signals, F.lit(0.0), lambda a, s: a + (s["score"] - mean) * (s["score"] - mean)), n))
    return F.when(n < 2, 0.6).otherwise(four_places(1 - F.least(spread, F.lit(1.0))))


def label_of(score: Column, band: float) -> Column:
    return F.when(score > band, "positive").when(score < -band, "negative").otherwise("neutral")


def blend(docs: DataFrame, w: Weights = Weights()) -> DataFrame:
    """docs: document_id, source_platform, n_words, entropy, and a column s_<signal> for each base signal, null where it isn't available.

    Adds blended_score, blended_label, blended_agreement, blended_confidence, needs_review, blended_reason and blended_signals. An unknown
    entropy counts as 1: a model that doesn't say how sure it is adds no evidence.
    """
    names = list(w.base)

    def weight(name: str) -> Column:
        factor = F.lit(1.0)
        for platform, by in w.platforms.items():
            if name in by:
                factor = F.when(F.lower("source_platform") == platform, F.lit(by[name])).otherwise(factor)
        return factor * w.base[name]

    signals = F.filter(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"s_{n}").cast("double").alias("score"), weight(n).alias("weight")) for n in names]), lambda s: s["score"].isNotNull())
    s = F.col("blended_signals")
    out = docs.withColumn("blended_signals", signals).withColumn("blended_score", combined(s)).withColumn("blended_agreement", agreement(s))
    decisive = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.coalesce("entropy", F.lit(1.0))))
    evidence = F.least(F.col("n_words") / 40.0, F.lit(1.0)) * 0.5 + F.when(F.col("s_transformer").isNotNull(), decisive * 0.5).otherwise(0.0)
    margin = F.least(F.abs("blended_score") / (3 * w.band), F.lit(1.0))
    c = w.confidence
    out = out.withColumn("blended_confidence", four_places(c["agreement"] * F.col("blended_agreement") + c["coverage"] * F.size(s) / float(len(names)) + c["evidence"] * evidence + c["margin"] * margin))
    strong = lambda sign: F.exists(s, lambda x: x["score"] * sign >= w.conflict)
    out = out.withColumn("blended_label", label_of(F.col("blended_score"), w.band))
    reason = (
        F.when(strong(1) & strong(-1), "signal_conflict").when(F.col("blended_confidence") < w.review_below, "low_confidence")
        .when((F.col("blended_label") != "neutral") & (F.abs("blended_score") < 1.4 * w.band), "borderline_label").when(F.size(s) <= 1, "insufficient_signals")
    )
    return out.withColumn("blended_reason", reason).withColumn("needs_review", F.col("blended_reason").isNotNull())


def run_scorer(docs: DataFrame, load: Callable[[], Classifier], text_col: str = "text", size: int = 180, overlap: int = 40, most: int | None = None, batch: int = 16, fail_soft: bool = True) -> DataFrame:
    """(document_id, available, probabilities, entropy, n_chunks): texts cut into overlapping windows of words, classified in batches, pooled per document.

    load: makes the classifier, once in each Python worker; it takes a list of texts and gives a map label -> probability for each. A worker whose
    classifier can't be made, or fails on a batch, marks those documents as not available instead of ending the job (fail_soft).
    most: at most so many windows of a text; all by default. Null and blank texts are classified as one empty window; documents keep their
    windows together in one row, so pooling needs no exchange.
    """
    windows = docs.select("document_id", chunks(F.col(text_col), size, overlap, most).alias("chunks"))
    schema = "document_id long, available boolean, n_chunks int, probabilities map<string,double>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classify, broken = None, False
        for p in batches:
            flat = [(i, k, c) for i, cs in enumerate(p["chunks"]) for k, c in enumerate(list(cs) or [""])]
            pooled: list[dict[str, float]] = [{} for _ in range(len(p))]
            mass, failed = [0.0] * len(p), [broken] * len(p)
            for a in range(0, len(flat), batch):
                part = flat[a : a + batch]
                try:
                    if classify is None and not broken:
                        classify = load()
                    got = [] if broken else classify([c for *_, c in part])
                except Exception:
                    if not fail_soft:
                        raise
                    broken, got = broken or classify is None, []
                if len(got) != len(part):
                    for i, *_ in part:
                        failed[i] = True
                    continue
                for (i, k, c), probabilities in zip(part, got):
                    w = max(1, len(c.split())) ** 0.5 / (1 + 0.12 * k)
                    mass[i] += w
                    for label, x in probabilities.items():
                        pooled[i][label] = pooled[i].get(label, 0.0) + w * x
            out = [None if bad else {label: x / m for label, x in q.items()} for q, m, bad in zip(pooled, mass, failed)]
            yield pd.DataFrame({"document_id": p["document_id"], "available": [not bad for bad in failed], "n_chunks": [max(1, len(c)) for c in p["chunks"]], "probabilities": out})

    return windows.mapInPandas(run, schema).select("document_id", "available", "n_chunks", "probabilities", F.when(F.col("available"), normalized_entropy(F.col("probabilities"))).alias("entropy"))


def engine_mode(signals: Column) -> Column:
    """What a score came from, out of the names of its signals: with a judge, with the model, with rules alone, or none."""
    names = F.transform(signals, lambda s: s["name"])
    return F.when(F.array_contains(names, "llm_judge"), "judged").when(F.array_contains(names, "transformer"), "model").when(F.size(signals) > 0, "rules").otherwise("none")


def payload(blended: DataFrame) -> DataFrame:
    """(document_id, engine_mode, signals): each signal's score and weight as JSON, the shape in which scores are kept; signals that aren't there are marked so."""
    names = list(Weights().base)
    by_name = F.map_from_entries(F.transform("blended_signals", lambda s: F.struct(s["name"], F.struct(four_places(s["score"]).alias("score"), four_places(s["weight"]).alias("weight"), F.lit(True).alias("available")))))
    none = F.struct(F.lit(None).cast("double").alias("score"), F.lit(None).cast("double").alias("weight"), F.lit(False).alias("available"))
    return blended.select("document_id", engine_mode(F.col("blended_signals")).alias("engine_mode"), F.to_json(F.struct(*[F.coalesce(F.try_element_at(by_name, F.lit(n)), none).alias(n) for n in names])).alias("signals"))


def pool_chunks(chunks: DataFrame) -> DataFrame:
    """(document_id, label, probability): chunk probabilities weighted by the root of their words, less with each place further back.

    chunks: document_id, position (from 0), n_words, probabilities map<string,double>.
    """
    w = F.sqrt("n_words") / (1 + 0.12 * F.col("position"))
    rows = chunks.select("document_id", w.alias("w"), F.explode("probabilities").alias("label", "p"))
    return rows.groupBy("document_id", "label").agg((F.sum(F.col("p") * F.col("w")) / F.sum("w")).alias("probability"))


def normalized_entropy(probabilities: Column) -> Column:
    """Entropy of a map of probabilities over that of as many equal ones."""
    values = F.map_values(probabilities)
    return F.aggregate(values, F.lit(0.0), lambda a, p: a - p * F.ln(p + 1e-9)) / F.ln(F.greatest(F.size(values), F.lit(2)).cast("double"))


def valence(probabilities: Column, values: dict[str, float]) -> Column:
    """Sum of each label's value times its probability; unknown labels count zero."""
    lookup = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.aggregate(F.map_entries(probabilities), F.lit(0.0), lambda a, e: a + e["value"] * F.coalesce(F.element_at(lookup, e["key"]), F.lit(0.0)))


def detect_aspects(docs: DataFrame, aspects: dict[str, tuple[str, ...]], slang: dict[str, str] | None = None, most_keywords: int = 12) -> DataFrame:
    """(document_id, aspect_code, mentions, matched_keywords): keywords counted clause by clause in the normalised text.

    aspects: code -> keywords, a domain pack small enough for one expression; it is compiled into the plan, not joined.
    """
    # Cleaned once, outside the lambda, which is interpreted for each clause.
    clean = docs.select("document_id", clean_text(F.concat_ws(". ", "title", "body")).alias("text"))
    norm = clean.select("document_id", F.transform(clauses(F.col("text")), lambda c: normalize_tokens(c, slang or {}, cleaned=True)).alias("clauses"))

    def found(keywords: tuple[str, ...]) -> Column:
        pattern = F.lit(keyword_pattern(keywords))
        return F.flatten(F.transform("clauses", lambda c: F.regexp_extract_all(c, pattern, F.lit(0))))

    hits = F.array(*[F.struct(F.lit(code).alias("aspect_code"), found(k).alias("hits")) for code, k in sorted(aspects.items())])
    rows = norm.select("document_id", F.explode(hits).alias("h")).filter(F.size("h.hits") > 0)
    return rows.select("document_id", "h.aspect_code", F.size("h.hits").alias("mentions"), F.slice(F.array_sort(F.array_distinct("h.hits")), 1, most_keywords).alias("matched_keywords"))


def unscored(docs: DataFrame, sentiment: DataFrame, version: str, k: int | None = None) -> DataFrame:
    """Documents with text and no score of this version, newest first."""
    done = sentiment.filter(F.col("model_version") == version).select("document_id")
    left = docs.filter((F.coalesce("title", F.lit("")) != "") | (F.coalesce("body", F.lit("")) != "")).join(done, "document_id", "left_anti")
    return left if k is None else left.orderBy(F.col("ingested_at").desc_nulls_last(), "document_id").limit(k)


_LABELS = {"positive": 1, "positif": 1, "negative": -1, "negatif": -1, "neutral": 0, "netral": 0}


def parse_verdict(text: str | None) -> dict | None:
    """A judge's reply as {label, score, confidence, reason}, or None: the outermost braces must hold JSON with a known label, and the
    score must not contradict it. A missing or null score is 0.6 times the label's sign, a missing confidence 0.5; both are clamped."""
    if not text or (a := text.find("{")) < 0 or (b := text.rfind("}")) < a:
        return None
    try:
        got = json.loads(text[a : b + 1])
        sign = _LABELS[str(got["label"]).strip().lower()]
        given = got.get("score")
        score = 0.6 * sign if given is None else max(-1.0, min(1.0, float(given)))
        confidence = max(0.0, min(1.0, float(got.get("confidence", 0.5))))
    except (ValueError, KeyError, TypeError, AttributeError):
        return None
    if sign and score * sign < 0:
        return None
    return {"label": {1: "positive", -1: "negative", 0: "neutral"}[sign], "score": score, "confidence": confidence, "reason": str(got.get("reason", "")).strip()[:200]}


def arbitrate(open_docs: DataFrame, complete: Callable[[str], str], budget: int = 300, w: Weights = Weights()) -> DataFrame:
    """Up to `budget` documents put to a judge, one call each, on the driver: the budget is global, so the calls can't be spread.

    open_docs: document_id, text, blended_signals, blended_confidence, blended_reason, document_id unique. Those without enough signals aren't
    asked about, the least sure are asked first. A usable verdict becomes one more signal: score, label and agreement are formed anew over all
    of them, confidence is at least 0.9 of the judge's, and what is still under the threshold stays open as low_confidence_after_llm.
    """
    spark = open_docs.sparkSession
    asked = open_docs.filter(F.col("blended_reason") != "insufficient_signals").orderBy("blended_confidence", "document_id").limit(budget).select("document_id", F.left("text", F.lit(2500)).alias("text")).collect()
    verdicts = [(r.document_id, v["score"], v["confidence"], v["reason"]) for r in asked if (v := parse_verdict(complete(r.text or ""))) is not None]
    given = F.broadcast(spark.createDataFrame(verdicts, "document_id long, __score double, __sure double, reason string"))  # at most `budget` rows
    rows = open_docs.select("document_id", "blended_signals", "blended_confidence").join(given, "document_id")
    judge = F.array(F.struct(F.lit("llm_judge").alias("name"), F.col("__score").alias("score"), F.lit(w.judge).alias("weight")))
    rows = rows.withColumn("signals", F.concat("blended_signals", judge))
    rows = rows.select("document_id", combined(F.col("signals")).alias("score"), agreement(F.col("signals")).alias("agreement"), four_places(F.least(F.lit(1.0), F.greatest("blended_confidence", 0.9 * F.col("__sure")))).alias("confidence"), "reason")
    open_still = F.col("confidence") < w.review_below
    return rows.select("document_id", "score", label_of(F.col("score"), w.band).alias("label"), "agreement", "confidence", open_still.alias("needs_review"), F.when(open_still, "low_confidence_after_llm").alias("review_reason"), "reason")
