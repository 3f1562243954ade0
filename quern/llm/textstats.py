"""Per-document statistics that tell natural prose from lists, tables and junk.

Layout is measured rather than matched: how well delimiters line up over the lines (the same number of cells, or gaps in the same
text columns), how regularly indentation and bullets recur, and how line lengths correlate from line to line. Word, symbol and
punctuation ratios then separate prose from debris. One Arrow pass over the texts, no shuffle.

Defined results: a null, empty or blank text has zero statistics and kind `empty`; texts of any length are measured whole; repeated
rows each get a row; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent function words of id, en, es, fr.
COMMON_WORDS = frozenset(
    "yang dan di ke dari untuk dengan pada ini itu tidak saya kami kita karena juga sudah belum akan ada bisa hanya sampai sejak agar atau oleh para meski walau sekitar dalam tanpa setelah sementara sebelum banget gak nanti terus "
    "the of and to in a is that for it on was with as be at by this from are or an not but have has had were will would they you my their its after since about because although so when than "
    "de la el los las un una y en que por con para del se su al es no como más pero sin sobre desde hasta porque aunque mientras durante unos según "
    "le les des du et une est pour dans ce qui au aux sur par pas ne plus avec son sa ses ou car bien depuis jusqu avant après selon pendant lors d l a à".split()
)
_WORD = re.compile(r"[^\W_]+")
_BULLET = re.compile(r"\s*(?:[-*•◦‣→»>+–—]|\[[ xX]?\]|\(?\d{1,3}[.)]|\(?[A-Za-z][.)])\s+\S")
_ENDS = tuple(".!?…:;\"”’)👍🙏😡")
_MARKUP = re.compile(r"</?[A-Za-z][^<>]{0,200}>|&[a-z]{2,8};|&#\d+;|\{[^{}]{0,120}\}|\b0x[0-9a-fA-F]+\b|\bfunction\s*\(|\bvar\s|[;{}]\s*$|\\u[0-9a-fA-F]{4}", re.M)
_BROKEN = re.compile("�|[ÃÂ][\u0080-¿Œ-Ÿˆ˜–-™ ]|â[\u0080-¿€™]|ð[\u0080-¿Ÿ]|[\u0080-\u009f]")
_CONSONANTS = re.compile(r"[bcdfghjklmnpqrstvwxz]{5}")
_VOWEL = re.compile(r"[aeiouyàâäáéèêëíîïóôöúùûü]")
DELIMITERS = ("\t", "|", ";", ",")

FIELDS = [
    "n_chars", "n_words", "n_lines", "mean_word_length", "mean_line_words", "symbol_ratio", "digit_ratio", "punctuated_lines", "common_words",
    "distinct_words", "top_word", "implausible_words", "markup_ratio", "broken_ratio", "cell_alignment", "column_alignment", "bullet_lines", "short_lines", "indent_period", "length_autocorrelation",
]


def _cells(lines: list[str]) -> float:
    """Share of lines cut by one delimiter into the same number of short cells."""
    best = 0.0
    for d in DELIMITERS:
        counts = [x.strip().strip(d).count(d) for x in lines]
        mode, n = Counter(counts).most_common(1)[0]
        if mode < 1:
            continue
        held = [x for x, c in zip(lines, counts) if c == mode]
        cells = sum((len(_WORD.findall(c)) for x in held for c in x.split(d)), 0) / (len(held) * (mode + 1))
        if cells <= 3.0:
            best = max(best, n / len(lines))
    return best


def _columns(lines: list[str]) -> float:
    """Share of lines that start a cell, after a gap of two blanks or more, in the text columns where most lines do."""
    starts = [{m.end() for m in re.finditer(r"(?<=\S)\s{2,}(?=\S)", x)} for x in lines]
    usual = {c for c, n in Counter(c for s in starts for c in s).items() if n >= 0.6 * len(lines)}
    return sum(1 for s in starts if usual and usual <= s) / len(lines)


def _period(flags: np.ndarray) -> float:
    """The largest share of agreement of a 0/1 sequence with itself shifted by 1 to 6 lines, if both values occur or all are set."""
    if len(flags) < 4 or not flags.any():
        return 0.0
    return max(float((flags[k:] == flags[:-k]).mean()) for k in range(1, min(7, len(flags) - 1)))


def _autocorrelation(x: np.ndarray) -> float:
    """Lag-one autocorrelation of line lengths as 1 - (mean squared step) / (2 * variance), with a floor on the variance for even lines."""
    if len(x) < 3:
        return 0.0
    return float(1 - (np.diff(x) ** 2).mean() / (2 * max(x.var(), (0.15 * x.mean()) ** 2, 1e-9)))


def _implausible(word: str) -> bool:
    """Too long, letters without a vowel or with five consonants in a row, or letters and digits mixed."""
    n = len(word)
    if n < 4:
        return False
    if n > 24 or (n >= 6 and not word.isalpha() and not word.isdigit()):
        return True
    return word.isascii() and word.isalpha() and (not _VOWEL.search(word) or _CONSONANTS.search(word) is not None)


def measure(text: str | None) -> dict[str, float]:
    if not isinstance(text, str) or not text.strip():
        return dict.fromkeys(FIELDS, 0.0) | {"n_chars": float(len(text or ""))}
    lines = [x for x in text.split("\n") if x.strip()]
    lower = text.lower()
    words = _WORD.findall(lower)
    letters = sum(map(len, words))
    solid = sum(map(len, text.split()))
    counts = Counter(words)
    n = max(1, len(words))
    line_words = np.array([len(_WORD.findall(x)) for x in lines], dtype=float)
    bullets = np.array([bool(_BULLET.match(x)) for x in lines])
    short = np.array([k <= 6 and not x.rstrip().endswith(_ENDS[:3]) for k, x in zip(line_words, lines)])
    indents = np.array([len(x) - len(x.lstrip()) > 0 for x in lines])
    odd = sum(c for w, c in counts.items() if _implausible(w))
    digits = sum(c * len(w) for w, c in counts.items() if w.isdigit())
    # Markup and damage need one of these characters, so most prose is not searched for them.
    markup = sum(len(m.group()) for m in _MARKUP.finditer(text)) if any(x in text for x in ("<", "&", "{", ";", "0x", "\\")) else 0
    broken = len(_BROKEN.findall(text)) if not text.isascii() else 0
    return {
        "n_chars": float(len(text)), "n_words": float(len(words)), "n_lines": float(len(lines)),
        "mean_word_length": letters / n, "mean_line_words": float(line_words.mean()),
        "symbol_ratio": (solid - letters) / max(1, solid), "digit_ratio": digits / max(1, solid),
        "punctuated_lines": sum(x.rstrip().endswith(_ENDS) for x in lines) / len(lines),
        "common_words": sum(c for w, c in counts.items() if w in COMMON_WORDS) / n, "distinct_words": len(counts) / n, "top_word": (counts.most_common(1)[0][1] / n) if words else 0.0,
        "implausible_words": odd / n, "markup_ratio": markup / max(1, len(text)), "broken_ratio": broken / n,
        "cell_alignment": _cells(lines) if len(lines) > 1 else 0.0, "column_alignment": _columns(lines) if len(lines) > 1 else 0.0,
        "bullet_lines": float(bullets.mean()), "short_lines": float(short.mean()),
        "indent_period": max(_period(indents), _period(bullets)), "length_autocorrelation": _autocorrelation(np.array([len(x) for x in lines], dtype=float)),
    }


def kind(s: dict[str, float]) -> str:
    """prose, list, table, junk or empty, decided on the statistics of measure()."""
    if not s["n_words"]:
        return "junk" if s["symbol_ratio"] > 0 else "empty"
    aligned = s["n_lines"] >= 3 and max(s["cell_alignment"], s["column_alignment"]) >= 0.7
    if (s["symbol_ratio"] > 0.55 and not aligned) or s["markup_ratio"] > 0.25 or s["broken_ratio"] > 0.25:
        return "junk"
    # Different words grow like the root of all words in any language; far fewer are a few words over and over.
    if s["n_words"] >= 8 and (s["top_word"] > 0.45 or s["distinct_words"] * s["n_words"] < 1.2 * s["n_words"] ** 0.5):
        return "junk"
    if s["implausible_words"] > 0.4 or (s["implausible_words"] > 0.25 and s["common_words"] < 0.12):
        return "junk"
    if aligned and s["common_words"] < 0.3 and s["n_words"] > s["n_lines"]:
        return "table"
    # Items: most lines short and without an end mark; bullets, a recurring indent or unrelated line lengths strengthen the case.
    regular = s["bullet_lines"] >= 0.6 or s["indent_period"] >= 0.9 or s["length_autocorrelation"] < 0.6
    if s["n_lines"] >= 3 and s["short_lines"] >= 0.7 and s["mean_line_words"] <= 6 and s["common_words"] < 0.45 and (regular or s["short_lines"] >= 0.9):
        return "list"
    if s["digit_ratio"] > 0.5 or (s["n_words"] >= 12 and s["common_words"] < 0.02 and s["punctuated_lines"] == 0 and s["implausible_words"] > 0.1):
        return "junk"
    return "prose"


SCHEMA = "doc long, " + ", ".join(f"{f} double" for f in FIELDS) + ", text_kind string"


def _measure_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in batches:
        rows = [measure(t) for t in p["text"]]
        out = pd.DataFrame(rows, columns=FIELDS) if rows else pd.DataFrame({f: pd.Series(dtype=float) for f in FIELDS})
        out.insert(0, "doc", p["doc"].to_numpy())
        out["text_kind"] = [kind(r) for r in rows]
        yield out


def text_statistics(docs: DataFrame, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the statistics in FIELDS, and text_kind."""
    return docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text_col).alias("text")).mapInPandas(_measure_batches, SCHEMA).withColumnRenamed("doc", "doc_id")
