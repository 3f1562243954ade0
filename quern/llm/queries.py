"""Queries of this package and, where SQL can say the same, their SQL for the side-by-side check."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import boilerplate, forest, langid, leakage, mixing, neardup, pii, textstats, truncation
from quern.operators.timestamps import normalize_timestamps
from quern.session import materialize, spread
from quern.session import table as read_table

#: Where the vocabulary files of public tokenizers lie; a parameter of the deployment.
TOKENIZERS = os.environ.get("QUERN_TOKENIZERS", "/opt/tokenizers")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for operators that work hard on each row."""
    df = read_table(spark, sf_dir, name)
    return spread(df) if name in ("raw_documents", "documents") else df


def _first_published(text: str = "published_at", arrival: str = "ingested_at"):
    """The date a document was first published as far as its own text says so at the front; else the date it arrived."""
    stated = F.try_to_timestamp(F.regexp_extract(F.col(text), r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd"))
    return F.coalesce(F.to_date(stated), F.to_date(F.col(arrival)))


def _published(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """(id, day): the UTC date of publication in any form it was written, or of arrival where it names no instant."""
    read = normalize_timestamps(docs, table(spark, sf_dir, "source_catalog")).select(F.col("document_id").alias("id"), "utc_micros")
    arrived = docs.select(F.col("document_id").alias("id"), "ingested_at")
    days = read.join(arrived, "id").select("id", F.to_date(F.coalesce(F.timestamp_micros("utc_micros"), F.col("ingested_at"))).alias("day"))
    return days.groupBy("id").agg(F.min("day").alias("day"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A case is defined by rows alone, so clusters and dates have no say and aren't computed."""
    docs = table(spark, sf_dir, "raw_documents")
    lines = boilerplate.lines_by_rows(docs, 0.04, 5)
    return boilerplate.find_repeated_lines(docs, lines)


def p1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines repeated over different documents and dates, by source."""
    docs = table(spark, sf_dir, "raw_documents")
    found = boilerplate.repeated_lines(docs, dates=_published(spark, sf_dir, docs))
    return found.groupBy(F.col("source").alias("source_name")).agg(
        F.count(F.lit(1)).alias("repeated_lines"), F.max("n_rows").alias("most_rows"), F.max("n_clusters").alias("most_clusters"), F.max("n_dates").alias("most_dates")
    )


def p1_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "raw_documents")
    lines = boilerplate.repeated_lines(docs, dates=_published(spark, sf_dir, docs))
    return boilerplate.remove_repeated_lines(docs, lines).select("document_id", "body", "removed_lines")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = truncation.truncated_values(table(spark, sf_dir, "raw_documents")).filter("truncated")
    return found.select(F.col("id").alias("document_id"), F.col("field").alias("field_name"))


def p2_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of truncated values per source and field."""
    found = truncation.truncated_values(table(spark, sf_dir, "raw_documents"))
    cut = F.count_if("truncated")
    return found.groupBy(F.col("source").alias("source_name"), F.col("field").alias("field_name")).agg(F.count(F.lit(1)).alias("n_values"), cut.alias("n_truncated"), F.count_if("marked").alias("n_marked"), (cut / F.count(F.lit(1))).alias("share"))


def site_lines(docs: DataFrame) -> DataFrame:
    hashed = materialize(boilerplate.hashed_lines(docs, date_col=_first_published()), "hashed")
    lines = boilerplate.repeated_lines(docs, 0.002, 5, 5, 2, hashed=hashed)
    return boilerplate.lines_over_families(hashed, lines, neardup.families(docs), 5, 0.002)


def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the languages of their bodies. Lines that a site adds (in at least 0.2% of its rows, on 2 dates, and in 5 families of
    edited copies and 0.2% of its families) have no say. Captions and signatures stand in about 1% of a source's rows, so a share of 4% would miss them."""
    docs = table(spark, sf_dir, "raw_documents")
    model = langid.fit(docs)
    lines = site_lines(docs)
    marked = boilerplate.with_line_numbers(docs.select("document_id", "source_name", "language", "body"), lines, "site_lines")
    return langid.document_languages(marked, model, skip_col="site_lines", keep=("language",))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language counts where a whole sentence is surely written in it (confidence 0.9); without one the document's own language does."""
    found = _languages(spark, sf_dir).filter(F.col("n_words") >= 6)
    named = F.array_distinct(F.transform(F.filter("segments", lambda s: (s["language"] != "und") & ~s["site_line"] & s["whole"] & (s["confidence"] >= 0.9)), lambda s: s["language"]))
    spoken = F.when(F.size(named) > 0, named).when(F.col("language") != "und", F.array("language")).otherwise(F.array())
    rows = found.select(F.col("id").alias("document_id"), spoken.alias("spoken"), langid.normal_label(F.col("label_language")).alias("label"))
    right = (F.size("spoken") == 1) & F.col("label").isNotNull() & (F.element_at("spoken", 1) == F.col("label"))
    return rows.filter((F.size("spoken") > 0) & ~right).select("document_id", F.explode("spoken").alias("language"))


def p3_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's language and confidence beside its label."""
    found = _languages(spark, sf_dir)
    return found.select(F.col("id").alias("document_id"), F.col("label_language").alias("label"), "language", "confidence", F.size("segments").alias("n_segments"))


def p3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each segment with its language and confidence, those of lines that the site adds included and marked."""
    found = _languages(spark, sf_dir).select("id", F.explode("segments").alias("s"))
    return found.select(F.col("id").alias("document_id"), F.col("s.segment").alias("segment_no"), F.col("s.language").alias("language"), F.col("s.confidence").alias("confidence"), F.col("s.words").alias("n_words"), F.col("s.site_line").alias("site_line"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.replay(table(spark, sf_dir, "raw_documents"), threshold=0.5, shingle=3, min_words=50)


def _pii_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, str]]:
    docs = table(spark, sf_dir, "raw_documents")
    return docs, pii.name_roles(docs, table(spark, sf_dir, "name_list"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, roles = _pii_inputs(spark, sf_dir)
    return pii.find_pii(docs, roles).select(F.col("id").alias("document_id"), F.col("field").alias("field_name"), "pii_type").distinct()


def p5_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, roles = _pii_inputs(spark, sf_dir)
    return pii.redact_pii(docs, roles)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "raw_documents"), threshold=0.5, shingle=3, min_words=50)
    return found.pairs().select(F.col("id_a").alias("document_id_a"), F.col("id_b").alias("document_id_b"))


def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its group; null where the text is too short to take part."""
    found = neardup.near_duplicate_groups(table(spark, sf_dir, "raw_documents"))
    return found.select(F.col("id").alias("document_id"), "group")


def p7_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its group and the number of different texts that its own is linked to."""
    found = neardup.near_duplicates(table(spark, sf_dir, "raw_documents"))
    return found.groups().select(F.col("id").alias("document_id"), "group", "links")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id").distinct()


def p8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return leakage.without_leaks(docs, leakage.leaked_passages(docs, table(spark, sf_dir, "eval_items"))).select("doc_id", "source", "n_chars")


def _mix(spark: SparkSession, sf_dir: str, share_of_corpus: float | None = None) -> mixing.Mix:
    docs = table(spark, sf_dir, "documents")
    catalog = table(spark, sf_dir, "source_catalog")
    places = catalog.select(F.col("source_name").alias("source"), F.col("source_platform").alias("domain"), F.col("main_language").alias("language"))
    tokens = mixing.counted(docs, f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    total = None if share_of_corpus is None else share_of_corpus * (tokens.agg(F.sum("tokens")).first()[0] or 0)
    return mixing.mix_sources(tokens, table(spark, sf_dir, "mix_targets"), places, total)


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares reached at the largest total at which every source that has documents comes to its target."""
    return _mix(spark, sf_dir).report


def p9_shares_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares reached at a total of the whole corpus, where short sources hand their shortage on."""
    return _mix(spark, sf_dir, 1.0).report


def p9_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir).draw.withColumnRenamed("doc", "doc_id")


def p9_draw_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The draw at a total of the whole corpus: small sources come up to their cap, and what they lack is drawn from their siblings."""
    return _mix(spark, sf_dir, 1.0).draw.withColumnRenamed("doc", "doc_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textstats.text_statistics(table(spark, sf_dir, "documents")).filter(~F.col("text_kind").isin("prose", "empty")).select("doc_id", "text_kind")


def p10_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textstats.text_statistics(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p1_found": p1_found, "p1_lines": p1_lines, "p1_clean": p1_clean, "p2_found": p2_found, "p2_rates": p2_rates, "p3_found": p3_found, "p3_documents": p3_documents, "p3_segments": p3_segments, "p4_found": p4_found, "p5_found": p5_found, "p5_redacted": p5_redacted, "p7_found": p7_found, "p7_groups": p7_groups, "p7_links": p7_links, "p8_found": p8_found, "p8_passages": p8_passages, "p8_clean": p8_clean, "p9_draw": p9_draw, "p9_draw_full": p9_draw_full, "p9_shares": p9_shares, "p9_shares_full": p9_shares_full, "p10_found": p10_found, "p10_statistics": p10_statistics}

_LINES = r"""
lines AS (
  SELECT document_id, coalesce(source_name, '') AS source, pos AS line_no,
         trim(regexp_replace(regexp_replace(lower(line), '\p{Nd}+', '0', 'g'), '[^\p{L}\p{Nd}]+', ' ', 'g')) AS norm
  FROM (SELECT document_id, source_name, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS pos
        FROM raw_documents WHERE body IS NOT NULL))
"""

_SHINGLES = r"""
words AS (SELECT document_id, doc_uid, lower(content_hash) AS h, CAST(ingested_at AS DATE) AS day, regexp_extract_all(lower(body), '[\p{L}\p{N}]+') AS w FROM raw_documents),
long AS (SELECT * FROM words WHERE len(w) >= 50),
sh AS (SELECT DISTINCT document_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM long),
size AS (SELECT document_id, count(*) AS n FROM sh GROUP BY 1),
common AS (SELECT a.document_id AS a, b.document_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.document_id < b.document_id GROUP BY 1, 2),
pairs AS (SELECT a, b FROM common JOIN size x ON a = x.document_id JOIN size y ON b = y.document_id WHERE 2 * c >= x.n + y.n - c)
"""

_RUNS = r"""
doc_words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
item_words AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
doc_runs AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS run FROM doc_words),
item_runs AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS run FROM item_words)
"""

ORACLE: dict[str, str] = {
    "p1_found": f"""
WITH {_LINES},
totals AS (SELECT coalesce(source_name, '') AS source, count(*) AS n FROM raw_documents GROUP BY 1),
often AS (SELECT l.source, norm FROM lines l JOIN totals t ON l.source = t.source WHERE norm <> ''
          GROUP BY l.source, norm, t.n HAVING count(DISTINCT document_id) >= 5 AND count(DISTINCT document_id) >= 0.04 * t.n)
SELECT document_id, CAST(line_no AS BIGINT) AS line_no FROM lines JOIN often USING (source, norm)
""",
    "p4_found": f"""
WITH {_SHINGLES}
SELECT DISTINCT r.document_id FROM words r JOIN words o ON r.doc_uid = o.doc_uid AND o.day < r.day
UNION SELECT r.document_id FROM long r JOIN long o ON r.h = o.h AND o.day < r.day
UNION SELECT r.document_id FROM (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs) p JOIN words r ON r.document_id = a JOIN words o ON o.document_id = b WHERE o.day < r.day
""",
    "p7_found": f"WITH {_SHINGLES} SELECT a AS document_id_a, b AS document_id_b FROM pairs",
    "p8_found": f"""
WITH {_RUNS}
SELECT DISTINCT doc_id, item_id FROM doc_runs JOIN item_runs USING (run)
""",
    "p8_clean": f"""
WITH {_RUNS}
SELECT doc_id, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM doc_runs JOIN item_runs USING (run))
""",
}
