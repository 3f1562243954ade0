"""Text functions as JVM expressions; only SimHash starts a Python worker."""

from __future__ import annotations

import hashlib
import html
import unicodedata
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Emoji counted as praise and as complaint.
GOOD_EMOJI = "😀😃😄😁😊🙂😍🥰😘👍👌🙏💪🔥✨⭐🌟❤️💚💙🎉🥳😻🤩💯"
BAD_EMOJI = "😞😔😟😕🙁☹️😣😖😫😩😢😭😤😠😡🤬👎💔😑😒🤦🙄😰😨⚠️"
#: Words that open a new clause, id and en.
CONJUNCTIONS = ("tapi", "tetapi", "namun", "sedangkan", "sementara", "padahal", "sehingga", "karena", "meskipun", "meski", "walaupun", "walau", "sayangnya", "selain itu", "cuma", "hanya saja", "soalnya", "but", "however", "although", "because", "while", "whereas")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once: inside a lambda an outer expression would be computed again for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def tokens(text: Column) -> Column:
    """Runs of ASCII letters, digits and apostrophes of the lower-cased text; empty array for null."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9']+"), F.lit(0)), F.array().cast("array<string>"))


def sentences(text: Column) -> Column:
    """Pieces after closing marks and at line breaks, trimmed, blanks left out."""
    parts = F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+|\n+")
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")


def clauses(text: Column, least: int = 3, conjunctions: tuple[str, ...] = CONJUNCTIONS) -> Column:
    """Pieces at commas, semicolons and conjunctions, of at least `least` characters."""
    parts = F.split(F.coalesce(text, F.lit("")), r"(?i)[,;]|\b(?:" + "|".join(conjunctions) + r")\b")
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: F.length(s) >= least)


def emoji_counts(text: Column) -> tuple[Column, Column]:
    """How many code points of praising and of complaining emoji a text has; 0 for null. A variation selector counts in both, as it does in both lists."""
    count = lambda chars: F.coalesce(F.length(text) - F.length(F.translate(text, chars, "")), F.lit(0))
    return count(GOOD_EMOJI), count(BAD_EMOJI)


def emoji_balance(text: Column) -> Column:
    """Praising less complaining emoji."""
    good, bad = emoji_counts(text)
    return good - bad


def unescaped(text: Column) -> Column:
    """All HTML entities resolved and the text in NFKC form. Plain ASCII without an ampersand stays in the JVM and is returned as it is."""

    @F.pandas_udf("string")
    def resolve(s: pd.Series) -> pd.Series:
        return s.map(lambda t: unicodedata.normalize("NFKC", html.unescape(t)) if isinstance(t, str) else None)

    return F.when(text.rlike(r"[&\x{80}-\x{10FFFF}]"), resolve(text)).otherwise(text)


def chunks(text: Column, size: int = 180, overlap: int = 40, most: int | None = None, least_tail: int = 20) -> Column:
    """Windows of `size` words that overlap; a last window of fewer than least_tail words is dropped unless it is the only one."""
    step = size - overlap

    def windows(words: Column) -> Column:
        n = F.size(words)
        starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step)), lambda s: (n > 0) & ((s == 0) | (n - s >= least_tail)))
        if most is not None:
            starts = F.slice(starts, 1, most)
        return F.transform(starts, lambda s: F.array_join(F.slice(words, s + 1, size), " "))

    return bind(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""), windows)


def content_hash(*parts: Column) -> Column:
    """SHA-256 over the parts' words in lower case, parts kept apart by a unit separator."""
    norm = [F.array_join(F.regexp_extract_all(F.lower(F.coalesce(p, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), " ") for p in parts]
    return F.sha2(F.concat_ws("\u001f", *norm), 256)


def simhash(text: Column, width: int = 3) -> Column:
    """64-bit SimHash over runs of `width` tokens; a bit is set where more runs have it than not; 0 without tokens.

    Tokens are a JVM expression. The hashes and the 64 votes of a text are one numpy sum an Arrow row: as higher-order functions they
    would be interpreted, 64 steps for every run.
    """

    @F.pandas_udf("bigint")
    def votes(s: pd.Series) -> pd.Series:
        def one(t) -> int:
            if t is None or len(t) == 0:
                return 0
            runs = [" ".join(t[i : i + width]) for i in range(max(1, len(t) - width + 1))]
            low = b"".join(hashlib.md5(r.encode(), usedforsecurity=False).digest()[8:] for r in runs)
            bits = np.unpackbits(np.frombuffer(low, dtype=np.uint8).reshape(len(runs), 8), axis=1)
            won = np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(runs))
            return int(won.view(">i8")[0])

        return s.map(one)

    return votes(tokens(text))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def marker_language(text: Column, markers: dict[str, tuple[str, ...]]) -> Column:
    """The language most of whose marker words occur (different words counted); ties go to the first listed; `unknown` without any."""
    words = F.array_distinct(tokens(text))
    score = {k: F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in v]))) for k, v in markers.items()}
    best = F.greatest(*score.values()) if len(score) > 1 else next(iter(score.values()))
    return reduce(lambda acc, k: F.when((score[k] == best) & (best > 0), k).otherwise(acc), reversed(list(score)), F.lit("unknown"))


def relevance(text: Column, keywords: tuple[str, ...]) -> Column:
    """Share of keywords that are part of the lower-cased text; 1 without keywords."""
    if not keywords:
        return F.lit(1.0)
    low = F.lower(F.coalesce(text, F.lit("")))
    return reduce(lambda a, b: a + b, [F.contains(low, F.lit(k.lower())).cast("int") for k in keywords]).cast("double") / len(keywords)


def contains_any(text: Column, keywords: tuple[str, ...]) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(k.lower())) for k in keywords], F.lit(False))


def truncate(text: Column, limit: int) -> Column:
    """At most `limit` characters; what is cut ends in an ellipsis."""
    return F.when(F.length(text) > limit, F.concat(F.rtrim(F.left(text, F.lit(limit - 1))), F.lit("…"))).otherwise(text)


#: Parts of a text that carry no opinion, in the order they are taken out.
BOILERPLATE = (
    r"(?i)baca juga\s*:[^\n]*?(?=\.|\n|$)", r"(?i)simak juga\s*:[^\n]*?(?=\.|\n|$)", r"(?i)lihat juga\s*:[^\n]*?(?=\.|\n|$)", r"(?i)artikel ini telah tayang di[^\n]*", r"(?i)copyright\s*©[^\n]*", r"(?i)\(?(?:adv|advertorial|siaran pers)\)?\s*$",
    r"(?i)editor\s*:\s*\w+[^\n]*$", r"(?i)reporter\s*:\s*\w+[^\n]*$", r"(?i)penulis\s*:\s*\w+[^\n]*$", r"(?i)sumber\s*:\s*\w+\s*$",
    r"(?i)read also\s*:[^\n]*", r"(?i)dikirim dari aplikasi [^\n]*", r"(?i)posted from the [^\n]* app[^\n]*", r"(?i)(?:hak cipta )?©\s*\d{4}[^\n]*",
)


def clean_text(text: Column, boilerplate: tuple[str, ...] = BOILERPLATE) -> Column:
    """Entities resolved, then tags, boilerplate and links out; white space collapsed. Entities other than these six need `unescaped` first."""
    t = F.coalesce(text, F.lit(""))
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    for pattern in boilerplate:
        t = F.regexp_replace(t, pattern, " ")
    t = F.regexp_replace(t, r"(?i)\b(?:https?://|www\.)\S+", " ")
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def normalize_tokens(text: Column, slang: dict[str, str], cleaned: bool = False) -> Column:
    """Clean, lower-case, mentions out, letters repeated three times or more once, other marks out, slang replaced token by token."""
    t = F.regexp_replace(F.lower(text if cleaned else clean_text(text)), r"@\w+", " ")
    t = F.regexp_replace(t, r"(\p{L})\1{2,}", "$1")
    t = F.regexp_replace(t, r"[^\p{L}\p{N}\s,']", " ")
    words = F.filter(F.split(F.trim(t), r"\s+"), lambda w: w != "")
    if slang:
        lookup = F.create_map(*[F.lit(x) for kv in slang.items() for x in kv])
        words = F.transform(words, lambda w: F.coalesce(F.element_at(lookup, w), w))
    return F.array_join(words, " ")


def keyword_pattern(keywords: tuple[str, ...]) -> str:
    """Longest first, between non-word characters, Unicode aware."""
    import re

    return r"(?U)(?<!\w)(?:" + "|".join(re.escape(k) for k in sorted(keywords, key=lambda k: (-len(k), k))) + r")(?!\w)"
