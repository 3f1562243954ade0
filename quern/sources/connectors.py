"""Sources: a registry of reader functions, and the reshaping that each kind of feed needs.

A connector is a function (spark, options) -> DataFrame in the document envelope. Network access is left to whoever supplies the raw
frames; what is here is everything after the bytes have arrived, as DataFrame operations.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions.text import content_hash, contains_any, relevance, simhash

Reader = Callable[[SparkSession, dict], DataFrame]
_REGISTRY: dict[str, Reader] = {}


def register(name: str) -> Callable[[Reader], Reader]:
    def add(f: Reader) -> Reader:
        _REGISTRY[name] = f
        return f

    return add


def resolve(names: str | list[str]) -> dict[str, Reader]:
    """Readers by name; `all` stands for every one. Unknown names raise KeyError with the list of known ones."""
    wanted = list(_REGISTRY) if names == "all" or names == ["all"] else ([names] if isinstance(names, str) else names)
    if unknown := [n for n in wanted if n not in _REGISTRY]:
        raise KeyError(f"unknown connectors {unknown}; known: {sorted(_REGISTRY)}")
    return {n: _REGISTRY[n] for n in wanted}


ENVELOPE = ("source_platform", "source_name", "external_id", "title", "body", "url", "author", "rating", "published_at", "engagement", "raw_payload")


def finalize(df: DataFrame, keywords: tuple[str, ...] = (), title_limit: int = 600, body_limit: int = 12_000) -> DataFrame:
    """The envelope plus doc_uid, content_hash, simhash, relevance and has_text. The uid hashes the raw parts with a separator, so that different ids stay different."""
    for c in ENVELOPE:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    text = F.concat_ws(" ", "title", "body")
    return df.withColumns({"title": F.left("title", F.lit(title_limit)), "body": F.left("body", F.lit(body_limit))}).withColumns({
        "doc_uid": F.sha2(F.concat_ws("\u001f", F.coalesce("source_platform", F.lit("")), F.coalesce("source_name", F.lit("")), F.coalesce("external_id", F.lit(""))), 256),
        "content_hash": content_hash(F.col("title"), F.col("body")), "simhash": simhash(text), "relevance_score": relevance(text, keywords), "has_text": F.coalesce(F.col("title") != "", F.lit(False)) | F.coalesce(F.col("body") != "", F.lit(False)),
    })


@register("parquet")
def read_parquet(spark: SparkSession, options: dict) -> DataFrame:
    return spark.read.parquet(options["path"])


@register("json")
def read_json(spark: SparkSession, options: dict) -> DataFrame:
    return spark.read.schema(options["schema"]).json(options["path"])


@register("csv")
def read_csv(spark: SparkSession, options: dict) -> DataFrame:
    return spark.read.schema(options["schema"]).option("header", True).option("multiLine", True).option("escape", '"').csv(options["path"])


def url_domain(url: Column) -> Column:
    """The host in lower case without www; null where there is none."""
    return F.nullif(F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", ""), F.lit(""))


def outlet_allowed(domain: Column, allow: tuple[str, ...], deny: tuple[str, ...], home: str, language: Column) -> Column:
    """Ordered gate on a domain: none is refused, the home suffix passes, then the allow list, then the deny list, then any language but en."""
    ends = lambda names: F.lit(False) if not names else domain.rlike(r"(?:^|\.)(?:" + "|".join(n.replace(".", r"\.") for n in names) + ")$")
    return F.when(domain.isNull(), False).when(domain.endswith(home), True).when(ends(allow), True).when(ends(deny), False).otherwise(language != "en")


def split_headline(title: Column) -> tuple[Column, Column]:
    """'Headline - Outlet' at its last separator: (headline, outlet); no outlet without one."""
    has = title.rlike(r"^.+ - [^-]+$")
    return F.when(has, F.regexp_extract(title, r"^(.+) - [^-]+$", 1)).otherwise(title), F.when(has, F.trim(F.regexp_extract(title, r"^.+ - ([^-]+)$", 1)))


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "nav", "footer", "aside"):
            self.hidden += 1
        elif tag in ("p", "br", "div", "li", "h1", "h2", "h3", "tr"):
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "nav", "footer", "aside") and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def html_text(html: Column) -> Column:
    """Visible text of a page, one block a line. Entities and nesting need a parser, so this is one Arrow-batched Python function."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        def one(x):
            if x is None:
                return None
            p = _Text()
            p.feed(x)
            p.close()
            return "\n".join(t for line in "".join(p.out).split("\n") if (t := " ".join(line.split())))

        return s.map(one)

    return run(html)


def month_windows(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """(first, last) of the calendar months between two dates, newest first."""
    m = F.explode(F.sequence(F.trunc(F.lit(start), "MM"), F.lit(end), F.expr("interval 1 month")))
    one = spark.range(1).select(m.alias("m"))
    return one.select(F.greatest("m", F.lit(start)).alias("first"), F.least(F.last_day("m"), F.lit(end)).alias("last")).orderBy(F.col("first").desc())


def interest_long(wide: DataFrame, time_col: str, flag_col: str | None = None) -> DataFrame:
    """A wide table of search interest, one column a term, as (time, term, interest) without zeros and the partial flag."""
    terms = [c for c in wide.columns if c not in (time_col, flag_col)]
    return wide.unpivot([time_col], terms, "term", "interest").filter(F.coalesce("interest", F.lit(0)) != 0)


def flatten_threads(threads: DataFrame, owner_id: str | None = None, keywords: tuple[str, ...] = ()) -> DataFrame:
    """Threads (thread_id, comment struct<id,author_id,text>, replies array of the same) as one row a comment, each id once, without the owner's own."""
    rows = threads.select("thread_id", F.explode(F.concat(F.array("comment"), F.coalesce("replies", F.array().cast(threads.schema["replies"].dataType)))).alias("c")).select("thread_id", "c.*")
    if owner_id is not None:
        rows = rows.filter(F.coalesce("author_id", F.lit("")) != owner_id)
    if keywords:
        rows = rows.filter(contains_any(F.col("text"), keywords))
    return rows.dropDuplicates(["id"])


def newest_per_app(reviews: DataFrame, app: str, at: str, budget: int) -> DataFrame:
    """The newest reviews of each app up to an equal share of the budget, 50 at least. A rank over one app's rows after a range of its times is cut off would be
    cheaper for huge apps; Spark's rank limit pushes the cut below the shuffle by itself."""
    n = max(1, reviews.select(app).distinct().count())
    rank = F.row_number().over(Window.partitionBy(app).orderBy(F.col(at).desc_nulls_last()))
    return reviews.withColumn("__rank", rank).filter(F.col("__rank") <= max(budget // n, 50)).drop("__rank")


def synthetic_documents(spark: SparkSession, n: int, seed: int = 1, days: int = 180, as_of: dt.date = dt.date(2025, 8, 31), platforms: tuple[str, ...] = ("news", "playstore", "reddit", "twitter")) -> DataFrame:
    """n documents that depend on (id, seed) alone, whatever the partitioning: more recent ones are likelier."""
    u = lambda k: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k)), F.lit(1_000_000)) / 1_000_000.0
    pick = lambda k, options: F.element_at(F.array(*[F.lit(o) for o in options]), (F.floor(u(k) * len(options)) + 1).cast("int"))
    polarity = F.when(u(1) < 0.45, "negative").when(u(1) < 0.8, "positive").otherwise("neutral")
    words = {"positive": ("quick", "helpful", "clear"), "negative": ("slow", "broken", "costly"), "neutral": ("open", "new", "regular")}
    mood = F.when(polarity == "positive", pick(3, words["positive"])).when(polarity == "negative", pick(3, words["negative"])).otherwise(pick(3, words["neutral"]))
    return spark.range(n).select(
        F.col("id").alias("document_id"), pick(2, platforms).alias("source_platform"), F.concat(F.lit("The counter is "), mood, F.lit(" today.")).alias("body"),
        F.date_sub(F.lit(as_of), (F.pow(u(4), F.lit(2.0)) * days).cast("int")).alias("published_on"), F.to_json(F.struct(F.lit(True).alias("is_synthetic"), polarity.alias("intended_polarity"))).alias("raw_payload"),
    )


def search_plan(channels: DataFrame, terms: DataFrame) -> DataFrame:
    """Every channel with every search term; both are short stated lists, so one is broadcast."""
    return channels.crossJoin(F.broadcast(terms))


def with_titles(rows: DataFrame, titles: DataFrame, key: str) -> DataFrame:
    """Titles looked up by key; rows without one keep a null title."""
    return rows.join(titles.groupBy(key).agg(F.max("title").alias("title")), key, "left")


def clamp_window(since: Column, now: Column, days: int = 7, margin_minutes: int = 5) -> Column:
    """The start of a search that reaches back no more than `days`, less a margin for the clocks."""
    return F.greatest(since, now - F.make_interval(days=F.lit(days)) + F.make_interval(mins=F.lit(margin_minutes)))


def parse_instant(value: Column) -> Column:
    """Seconds since the epoch or ISO text as an instant; null for anything else."""
    number = value.try_cast("double")
    return F.when(number.isNotNull(), F.timestamp_micros((number * 1_000_000).cast("bigint"))).otherwise(F.try_to_timestamp(value))


def json_ld_reviews(pages: DataFrame, key: str, json_col: str) -> DataFrame:
    """Reviews in the JSON-LD of pages: (key, author, rating, body, published). Broken JSON gives none."""
    schema = "review array<struct<author:struct<name:string>,reviewRating:struct<ratingValue:string>,reviewBody:string,datePublished:string>>"
    rows = pages.select(key, F.explode(F.from_json(json_col, schema)["review"]).alias("r"))
    return rows.select(key, F.col("r.author.name").alias("author"), F.col("r.reviewRating.ratingValue").try_cast("double").alias("rating"), F.col("r.reviewBody").alias("body"), F.col("r.datePublished").alias("published"))


def load_window(docs: DataFrame, as_of: dt.date, hours: int, column: str = "ingested_at") -> DataFrame:
    """Rows of the last `hours` hours before as_of; the filter reaches the Parquet scan."""
    end = dt.datetime(as_of.year, as_of.month, as_of.day, tzinfo=dt.UTC)
    return docs.filter((F.col(column) >= F.lit(end - dt.timedelta(hours=hours))) & (F.col(column) < F.lit(end)))


def latest_records(runs: DataFrame, key: str = "run_id") -> DataFrame:
    """One row a run: the record that closed last, an open one only where none is closed. Ties go to the greatest row."""
    rest = [c for c in runs.columns if c != key]
    plain = [c for c in rest if c != "finished_at"]
    best = F.max(F.struct(F.col("finished_at").isNotNull().alias("closed"), F.col("finished_at"), *plain)).alias("b")
    return runs.groupBy(key).agg(best).select(key, *[F.col(f"b.{c}").alias(c) for c in rest])
