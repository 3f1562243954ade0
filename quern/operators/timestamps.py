"""Timestamps in mixed formats and zones, read as UTC instants by a mixture of formats per source.

Every text is parsed under each reading it admits (day-month or month-day order of all-number dates, epoch units, written
offsets and zone names, the source's own clock). Values vote: for each source, expectation-maximisation fits the shares of
the readings from the values' likelihood under every valid reading; the posteriors then choose one reading, or leave the
value marked as ambiguous. A date order stated for a source enters as a strong Dirichlet prior.

The fit runs over counts per (source, set of readings, arrival fit), which Spark aggregates before any Python sees them:
a group has at most a few hundred such rows however many values the source has.

Defined results: null, blank and unreadable text, relative phrases, dates without a time, and local times that a clock shows
twice or never give utc_micros null with the reason in `status`. A source missing from the catalogue has no clock (zone-less
text is then `no_zone`) and no stated order (the mixture alone decides).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from functools import lru_cache
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import materialize

#: Month names and their usual abbreviations in id, en, es, fr.
MONTHS = {
    "januari": 1, "februari": 2, "maret": 3, "april": 4, "mei": 5, "juni": 6, "juli": 7, "agustus": 8, "september": 9, "oktober": 10, "november": 11, "desember": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "agu": 8, "ags": 8, "agt": 8, "sep": 9, "sept": 9, "okt": 10, "nov": 11, "nop": 11, "des": 12,
    "january": 1, "february": 2, "march": 3, "may": 5, "june": 6, "july": 7, "august": 8, "october": 10, "december": 12, "aug": 8, "oct": 10, "dec": 12,
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
    "ene": 1, "abr": 4, "ago": 8, "dic": 12,
    "janvier": 1, "février": 2, "fevrier": 2, "mars": 3, "avril": 4, "mai": 5, "juin": 6, "juillet": 7, "août": 8, "aout": 8, "septembre": 9, "octobre": 10, "novembre": 11, "décembre": 12, "decembre": 12,
    "janv": 1, "févr": 2, "avr": 4, "juil": 7, "déc": 12,
}

#: Zone names that state one offset, in minutes east of UTC.
ZONES = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wib": 420, "wita": 480, "wit": 540,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
    "cet": 60, "cest": 120, "wet": 0, "west": 60, "bst": 60, "aest": 600, "aedt": 660,
}

_TIME = r"(?P<H>\d{1,2})[:.h](?P<M>\d{2})(?:[:.](?P<S>\d{2})(?:[.,](?P<f>\d{1,9}))?)?(?:\s*(?P<ap>[ap])\.?m\.?)?"
_ZONE = r"(?:\s*(?P<z>[+-]\d{2}:?\d{2}|[+-]\d{2}|[a-z]{1,5}))?"
_DAYNAME = r"(?:[^\W\d_]+\.?,?\s+)?"
#: Reading families: (name, pattern over the lower-cased text). Order matters only for which name a text gets.
FAMILIES = [
    ("iso", re.compile(r"(?P<Y>\d{4})-(?P<m>\d{2})-(?P<d>\d{2})(?:t|\s+)(?P<H>\d{2}):(?P<M>\d{2})(?::(?P<S>\d{2})(?:[.,](?P<f>\d{1,9}))?)?" + _ZONE)),
    ("iso_basic", re.compile(r"(?P<Y>\d{4})(?P<m>\d{2})(?P<d>\d{2})t(?P<H>\d{2})(?P<M>\d{2})(?P<S>\d{2})?(?:[.,](?P<f>\d{1,9}))?" + _ZONE)),
    ("ymd_slash", re.compile(r"(?P<Y>\d{4})[/.](?P<m>\d{1,2})[/.](?P<d>\d{1,2})[,\s]+" + _TIME + _ZONE)),
    ("numeric", re.compile(r"(?P<a>\d{1,2})(?P<s1>[/.-])(?P<b>\d{1,2})(?P=s1)(?P<Y>\d{4}),?\s+(?:à\s+)?" + _TIME + _ZONE)),
    ("day_name_month", re.compile(_DAYNAME + r"(?P<d>\d{1,2})\s+(?:de\s+)?(?P<mon>[^\W\d_]+)\.?\s+(?:de\s+)?(?P<Y>\d{4}),?\s+(?:à\s+|pukul\s+|a\s+las\s+)?" + _TIME + _ZONE)),
    ("month_name_day", re.compile(r"(?P<mon>[^\W\d_]+)\.?\s+(?P<d>\d{1,2}),?\s+(?P<Y>\d{4}),?\s+(?:at\s+)?" + _TIME + _ZONE)),
    ("ctime", re.compile(r"[^\W\d_]+\s+(?P<mon>[^\W\d_]+)\s+(?P<d>\d{1,2})\s+(?P<H>\d{2}):(?P<M>\d{2}):(?P<S>\d{2})" + r"(?:\s+(?P<z>[+-]\d{4}|[a-z]{1,5}))?" + r"\s+(?P<Y>\d{4})")),
]
_EPOCH = re.compile(r"(?P<n>\d{9,19})(?:\.(?P<f>\d{1,9}))?")
_DATE_ONLY = re.compile(r"\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{4}|" + _DAYNAME + r"\d{1,2}\s+(?:de\s+)?[^\W\d_]+\.?\s+(?:de\s+)?\d{4}|[^\W\d_]+\.?\s+\d{1,2},?\s+\d{4}")
_EPOCH0 = dt.datetime(1970, 1, 1)
DAY_US = 86_400_000_000


@lru_cache(maxsize=4096)
def _zone(name: str | None) -> ZoneInfo | None:
    try:
        return ZoneInfo(name) if name else None
    except Exception:
        return None


def _micros(naive: dt.datetime) -> int:
    return (naive - _EPOCH0) // dt.timedelta(microseconds=1)


def _on_clock(naive: dt.datetime, zone: ZoneInfo) -> tuple[int | None, str]:
    """The instant at which the clock shows naive; none where it does so twice or never."""
    early, late = (naive.replace(tzinfo=zone, fold=k).utcoffset() for k in (0, 1))
    if early == late:
        return _micros(naive - early), "ok"
    shown = [k for k in (early, late) if (naive - k).replace(tzinfo=dt.UTC).astimezone(zone).replace(tzinfo=None) == naive]
    return (None, "clock_twice") if len(shown) == 2 else (None, "clock_never")


def _offset(text: str) -> int | None:
    if text[0] in "+-":
        digits = text[1:].replace(":", "")
        minutes = int(digits[:2]) * 60 + int(digits[2:] or 0)
        return None if minutes > 18 * 60 else (-minutes if text[0] == "-" else minutes)
    return ZONES.get(text)


def _one(g: dict, year: int, month: int, day: int, zone: ZoneInfo | None) -> tuple[int | None, str]:
    hour, minute, second = int(g["H"]), int(g["M"]), int(g.get("S") or 0)
    frac = (g.get("f") or "")[:6].ljust(6, "0")
    if g.get("ap"):
        if not 1 <= hour <= 12:
            return None, "unreadable"
        hour = hour % 12 + (12 if g["ap"] == "p" else 0)
    try:
        naive = dt.datetime(year, month, day, hour, minute, second, int(frac))
    except ValueError:
        return None, "unreadable"
    if g.get("z"):
        minutes = _offset(g["z"])
        return (None, "unreadable") if minutes is None else (_micros(naive) - minutes * 60_000_000, "ok")
    return (None, "no_zone") if zone is None else _on_clock(naive, zone)


def readings(text: str | None, zone_name: str | None) -> list[tuple[str, int | None, str]]:
    """Every reading the text admits: (format, UTC microseconds or None, status). Unreadable texts give one reading."""
    if text is None or not (s := text.strip().lower()):
        return [("none", None, "empty")]
    if m := _EPOCH.fullmatch(s):
        n, frac = int(m["n"]), m["f"] or ""
        unit = {9: 6, 10: 6, 11: 6, 12: 3, 13: 3, 14: 3, 15: 0, 16: 0}.get(len(m["n"]), -3)
        value = n * 10**unit if unit >= 0 else n // 1000
        return [(f"epoch_{unit}", value + (int(frac.ljust(9, "0")[:unit]) if unit > 0 and frac else 0), "ok")]
    zone = _zone(zone_name)
    for name, pattern in FAMILIES:
        if not (m := pattern.fullmatch(s)):
            continue
        g = m.groupdict()
        if name != "numeric":
            month = int(g["m"]) if "m" in g else MONTHS.get(g["mon"])
            return [(name, None, "unreadable")] if not month else [(name, *_one(g, int(g["Y"]), month, int(g["d"]), zone))]
        a, b, year = int(g["a"]), int(g["b"]), int(g["Y"])
        out = []
        for order, day, month in (("dmy", a, b), ("mdy", b, a)):
            if 1 <= month <= 12 and 1 <= day <= 31:
                got = _one(g, year, month, day, zone)
                if got[1] != "unreadable":
                    out.append((f"numeric_{order}", *got))
        return out or [("numeric", None, "unreadable")]
    return [("date", None, "no_time")] if _DATE_ONLY.fullmatch(s) else [("none", None, "unreadable")]


def _under_order(found: list[tuple[str, int | None, str]], order: str | None) -> list[tuple[str, int | None, str]]:
    """A lone reading against the order that the source states is no reading of it."""
    if len(found) == 1 and isinstance(order, str) and found[0][0].startswith("numeric_") and found[0][0] != f"numeric_{order}":
        return [(found[0][0], None, "against_order")]
    return found


#: Bins of (arrival - instant) in days: published after arrival, within a day, a week, a year, older.
LAG_EDGES = np.array([-1.0, 1.0, 7.0, 60.0, 400.0]) * DAY_US
UNKNOWN_LAG = len(LAG_EDGES) + 1
#: A text is seldom published after it arrived, whatever a source's values would make of it.
_PLAUSIBLE = np.array([0.02] + [1.0] * UNKNOWN_LAG)


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in batches:
        memo: dict = {}
        got = []
        for key in zip(p["text"], p["zone"], p["date_order"]):
            if key not in memo:
                memo[key] = _under_order(readings(key[0], key[1]), key[2])
            got.append(memo[key])
        arrival = p["arrival"].to_numpy(dtype="float64")
        fmts, micros, statuses, lags = [], [], [], []
        for r, at in zip(got, arrival):
            fmts.append([x[0] for x in r])
            micros.append([x[1] for x in r])
            statuses.append([x[2] for x in r])
            lags.append([UNKNOWN_LAG if x[1] is None or at != at else int(np.searchsorted(LAG_EDGES, at - x[1])) for x in r])
        yield pd.DataFrame({"row_id": p["row_id"], "source": p["source"], "formats": fmts, "micros": micros, "statuses": statuses, "lags": lags})


_PARSED = "row_id long, source string, formats array<string>, micros array<long>, statuses array<string>, lags array<int>"
_FIT = "source string, formats array<string>, lags array<int>, choice int, posterior double"


def fit_source(pdf: pd.DataFrame, prior_weight: float = 1000.0, rounds: int = 60, tolerance: float = 1e-9) -> pd.DataFrame:
    """EM for one source over its counted sets of readings: shares of the formats and a lag profile shared by them.

    pdf: formats, lags (arrays), n, date_order. Returns for each set the reading with the largest posterior and that posterior.
    """
    sets = [(tuple(f), tuple(g), int(n)) for f, g, n in zip(pdf["formats"], pdf["lags"], pdf["n"])]
    names = sorted({f for fs, _, _ in sets for f in fs})
    at = {f: k for k, f in enumerate(names)}
    order = pdf["date_order"].iloc[0]
    alpha = np.ones(len(names))
    if isinstance(order, str) and f"numeric_{order}" in at:
        alpha[at[f"numeric_{order}"]] += prior_weight
    share, lag = alpha / alpha.sum(), np.full(UNKNOWN_LAG + 1, 1.0 / (UNKNOWN_LAG + 1))
    post: list[np.ndarray] = []
    for _ in range(rounds):
        new_share, new_lag, post = alpha.copy(), np.full(UNKNOWN_LAG + 1, 1.0), []
        for fs, gs, n in sets:
            k, j = [at[f] for f in fs], list(gs)
            w = share[k] * lag[j] * _PLAUSIBLE[j]
            w = w / w.sum()
            post.append(w)
            np.add.at(new_share, k, n * w)
            np.add.at(new_lag, j, n * w)
        new_share, new_lag = new_share / new_share.sum(), new_lag / new_lag.sum()
        moved = np.abs(new_share - share).max() + np.abs(new_lag - lag).max()
        share, lag = new_share, new_lag
        if moved < tolerance:
            break
    if isinstance(order, str) and f"numeric_{order}" in at:
        # A stated order decides every value that it can read; the mixture decides the rest.
        stated = at[f"numeric_{order}"]
        post = [np.eye(len(fs))[[at[f] for f in fs].index(stated)] if stated in [at[f] for f in fs] else w for (fs, _, _), w in zip(sets, post)]
    return pd.DataFrame({"source": pdf["source"], "formats": pdf["formats"], "lags": pdf["lags"], "choice": [int(w.argmax()) for w in post], "posterior": [float(w.max()) for w in post]})


def normalize_timestamps(
    docs: DataFrame,
    catalog: DataFrame,
    id_col: str = "document_id",
    text_col: str = "published_at",
    source_col: str = "source_name",
    arrival_col: str = "ingested_at",
    min_posterior: float = 0.95,
) -> DataFrame:
    """One row per input row: document id, source, format, utc_micros, posterior, status.

    status: ok, ambiguous (posterior below min_posterior), empty, unreadable, no_time, no_zone, clock_twice,
    clock_never, against_order (an all-number date that the source's stated order cannot read).
    catalog: source_name, time_zone, date_order; joined by source, so it may hold any number of sources. Where a source is
    listed twice its smallest (time_zone, date_order) counts. Repeated input rows each give a row.
    """
    clocks = catalog.groupBy(F.col("source_name").alias("source")).agg(F.min(F.struct("time_zone", "date_order")).alias("c")).select("source", F.col("c.time_zone").alias("zone"), F.col("c.date_order").alias("date_order"))
    rows = docs.select(F.col(id_col).alias("row_id"), F.coalesce(F.col(source_col), F.lit("")).alias("source"), F.col(text_col).cast("string").alias("text"), F.unix_micros(F.col(arrival_col).cast("timestamp")).alias("arrival"))
    parsed = rows.join(clocks, "source", "left").select("row_id", "source", "text", "zone", "date_order", "arrival").mapInPandas(_parse_batches, _PARSED)
    parsed = materialize(parsed, "readings")  # parsed once: the fit and the choice both read it, without the texts
    contested = F.size("formats") > 1
    counts = parsed.groupBy("source", "formats", "lags").agg(F.count(F.lit(1)).alias("n")).join(clocks.select("source", "date_order"), "source", "left")
    fit = counts.groupBy("source").applyInPandas(lambda pdf: fit_source(pdf), _FIT).filter(contested)
    # Only sets with several readings need the fit; the others have one reading each.
    keyed = parsed.join(fit.select("source", "formats", "lags", "choice", "posterior"), ["source", "formats", "lags"], "left")
    pick = F.coalesce(F.col("choice"), F.lit(0)) + 1
    out = keyed.select(
        F.col("row_id").alias(id_col),
        F.col("source").alias(source_col),
        F.element_at("formats", pick).alias("format"),
        F.element_at("micros", pick).alias("utc_micros"),
        F.coalesce("posterior", F.lit(1.0)).alias("posterior"),
        F.element_at("statuses", pick).alias("status"),
    )
    unsure = (F.col("status") == "ok") & (F.col("posterior") < min_posterior)
    return out.withColumns({"status": F.when(unsure, "ambiguous").otherwise(F.col("status")), "utc_micros": F.when(~unsure, F.col("utc_micros"))})


def learned_orders(docs: DataFrame, catalog: DataFrame, **columns) -> DataFrame:
    """(source_name, stated_order, learned_order, n_dmy, n_mdy) of each source with all-number dates: the order that the mixture finds without being
    told, beside the stated one. The stated order decides where there is one; this shows where it disagrees with the values. Ties learn nothing."""
    blind = catalog.withColumn("date_order", F.lit(None).cast("string"))
    found = normalize_timestamps(docs, blind, **columns)
    source = columns.get("source_col", "source_name")
    votes = found.filter(F.col("utc_micros").isNotNull()).groupBy(F.col(source).alias("source_name")).agg(F.count_if(F.col("format") == "numeric_dmy").alias("n_dmy"), F.count_if(F.col("format") == "numeric_mdy").alias("n_mdy")).filter("n_dmy + n_mdy > 0")
    learned = F.when(F.col("n_dmy") > F.col("n_mdy"), "dmy").when(F.col("n_mdy") > F.col("n_dmy"), "mdy")
    stated = catalog.groupBy("source_name").agg(F.min(F.struct("time_zone", "date_order")).alias("c")).select("source_name", F.col("c.date_order").alias("stated_order"))
    return votes.join(stated, "source_name", "left").select("source_name", "stated_order", learned.alias("learned_order"), "n_dmy", "n_mdy")
