"""Values that lost their end at a field limit or in transfer, found with backward character n-grams.

Reading backwards from a position, the last n bytes are its context (n in ORDERS). Every position inside a text either ends something (it stands
before a line break, before a closing mark that closes, or behind one) or goes on, with the next word or within the word. Counts of the three, for
contexts of growing length where shorter ones smooth longer ones, make the backward model; the log-odds of a value's final context say how much
likelier it is that text goes on there than that it ends. Values' own ends are evidence of endings in their column too, for what never stands before
a line break (headlines, captions, short reviews): as many as there are different final WITNESS bytes, less one, so that a value is no witness of
its own end and copies of a cut value count as one. Values at a field limit, marked with dots or broken in a code are no witnesses.

The counts are those of the whole table: every text counts, copies of one once, and every value's end. Only contexts that some value ends with are ever asked
for, so only those are kept. A bit filter of the asked contexts, at most FILTER_LOG bits large in log2, goes to all tasks and keeps most others from being moved; it decides nothing,
for counts are joined to the asked contexts by key. A context is tried at an order only where the filter knows its shorter one, since a value asks for all orders that it is long enough for. Tasks add up what they count before
anything moves; different ends are judged once each, and values take the verdict of their end by a join. Labels of language only say which texts teach a language's letters;
a value's language is read from its own end by naive Bayes over hashed three-byte grams of all texts.

Three things decide on the log-odds:
* At a length where a source's different values pile up over the lengths beside it, the share of values that only the limit explains is the prior.
* Elsewhere expectation-maximisation over the histogram of log-odds finds the share of cut values per language, column and trailing dots (at most a
  half: away from limits the text itself has to speak for a cut).
* Values that end with a whole word although their text goes on are either cuts that happen to fall between words, about as often as letters are followed
  by a gap, or abridged: headlines shortened to a number of whole words, which lost nothing at a limit or in transfer. Where whole words
  at one word count are many times what the cuts within words at that count foretell, they are abridged, not truncated.

What ends inside a broken code (a half escape, entity or tag, a damaged character) is cut: the code shows it, whatever the letters before it.

Defined results: null and blank values are never cut; repeated rows get equal verdicts; an empty table gives no rows; very long values are
judged by their end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.words import mix
from quern.session import broadcast_if_small, materialize

ORDERS = (4, 6, 9, 13, 18, 26)
TAIL_CHARS = 96
WITNESS = 48
SMOOTHING = 4.0
#: The filter has 32 bits for each asked context, but at most two to this power (32 MB); a fuller one lets more pass to the exchange, the counts stay exact.
FILTER_LOG = 28
#: So many bits of the filter are put together in one group, so many bytes of texts are counted at once, and so many contexts are added up at once.
SLICE_LOG, CHUNK_BYTES, PENDING = 20, 1 << 18, 1 << 22
SHORT = 24
LANGUAGES = ("id", "en", "es", "fr")
GRAMS = 1 << 15
#: Longer values are texts, no headlines; it also bounds what is sent to all tasks.
MOST_WORDS = 100
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_CLOSING = np.zeros(256, dtype=bool)
_CLOSING[list(b".!?")] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(b" \t\r\n\0")] = True
_WORD = np.zeros(256, dtype=bool)
_WORD[list(b"abcdefghijklmnopqrstuvwxyz0")] = True
_WORD[128:] = True
_MARK = re.compile(r"[\s]*(?:…|\.{2,})\s*$")
_BROKEN = re.compile(r"(?:�|&(?:a|am|amp|ap|apo|apos|g|gt|l|lt|n|nb|nbs|nbsp|q|qu|quo|quot|#x?[0-9a-fA-F]{0,5})|\\u[0-9a-fA-F]{0,3}|\\x[0-9a-fA-F]?|<[/A-Za-z][^<>]{0,40})$")


def _bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace").replace(b"\0", b" ").translate(_DIGITS)


def split_mark(text: str) -> tuple[str, bool, bool]:
    """(the text before trailing dots, whether there were any, whether it ends inside a broken code)."""
    body = text.rstrip()
    cut = _MARK.sub("", body)
    marked = cut != body
    return (cut.rstrip() if marked else body), marked, bool(_BROKEN.search(cut))


def prefix_sums(data: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Sums of a polynomial hash; the hash of any window is a difference of two of them times a power."""
    out = np.empty(len(data) + 1, dtype=np.uint64)
    out[0] = 0
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= inverse[: len(data)]
    np.cumsum(terms, out=out[1:])
    return out


def window_hashes(sums: np.ndarray, powers: np.ndarray, order: int) -> np.ndarray:
    """Of the last `order` bytes before each position order..n."""
    w = sums[order:] - sums[:-order]
    w *= powers[order - 1 : len(sums) - 1]
    return w


def exact_keys(w: np.ndarray, order: int) -> np.ndarray:
    """64-bit keys of window hashes whose three lowest bits are free; the order is part of the key."""
    return mix(w * np.uint64(0xD6E8FEB86659FD93) + np.uint64(order)) & ~np.uint64(7)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    p, q = np.full(n, _BASE, dtype=np.uint64), np.full(n, _BASE_INVERSE, dtype=np.uint64)
    p[0] = q[0] = 1
    return np.cumprod(p), np.cumprod(q)


def tail_keys(tails: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each tail the keys of its last contexts, one an order, and how many bytes it has."""
    most = ORDERS[-1]
    raw = [t[-most:] for t in tails]
    data = np.frombuffer(b"".join(x.rjust(most, b"\0") for x in raw), dtype=np.uint8).reshape(len(raw), most)
    powers, inverse = _powers(most)
    terms = data.astype(np.uint64) + np.uint64(1)
    out = np.empty((len(raw), len(ORDERS)), dtype=np.uint64)
    for k, n in enumerate(ORDERS):
        out[:, k] = exact_keys((terms[:, most - n :] * inverse[:n]).sum(axis=1, dtype=np.uint64) * powers[n - 1], n)
    return out, np.array([len(x) for x in raw])


def grams(data: np.ndarray) -> np.ndarray:
    """Hash places of the three-byte grams of a run of bytes."""
    d = data.astype(np.uint32)
    return (((d[:-2] * 961 + d[1:-1] * 31 + d[2:]) * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def _outcomes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(0 ends, 1 goes on with another word, 2 within a word) behind each byte, and whether the position counts."""
    nxt, after, before = np.r_[data[1:], np.uint8(0)], np.r_[data[2:], np.uint8(0), np.uint8(0)], np.r_[np.uint8(0), data[:-1]]
    end = (nxt == 10) | (nxt == 13) | (_CLOSING[data] & _SPACE[nxt]) | (_CLOSING[nxt] & (_SPACE[after] | _CLOSING[after]))
    # Runs of dots may trail off or mark a cut, and the end of a value may be one, so they say nothing here.
    dots = ((nxt == 46) & ((after == 46) | (data == 46))) | ((data == 46) & (before == 46))
    what = np.where(end, 0, np.where(_WORD[data] & _WORD[nxt], 2, 1)).astype(np.uint8)
    return what, (data != 0) & (nxt != 0) & ~dots


def _contexts(data: np.ndarray, order: int) -> np.ndarray:
    """The keys of all contexts of one order in a run of values, with what follows in the lowest bits."""
    what, inside = _outcomes(data)
    starts = np.flatnonzero(np.r_[True, data[:-1] == 0])
    depth = (np.arange(len(data), dtype=np.int32) - np.repeat(starts, np.diff(np.r_[starts, len(data)])).astype(np.int32)) + 1
    ok = np.flatnonzero((inside & (depth >= order))[order - 1 :])
    powers, inverse = _powers(len(data) + 1)
    return exact_keys(window_hashes(prefix_sums(data, inverse), powers, order)[ok], order) | what[ok + order - 1]


def count_contexts(blocks: list[np.ndarray], ends: list[list[bytes]], order: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, counts: ends, goes on with a word, within a word, ends of values of each column) of one order.

    blocks: values as runs of bytes, each value closed by a zero byte; ends: final bytes of different values, one list a column. What was
    met once is left out, and so is what was met least often where more than `most` contexts would remain."""
    found = [_contexts(b, order) for b in blocks if len(b) >= order]
    for k, tails in enumerate(ends):
        if tails:
            keys, size = tail_keys(tails)
            found.append(keys[size >= order, ORDERS.index(order)] | np.uint64(3 + k))
    found = np.concatenate([np.empty(0, np.uint64), *found])
    found.sort()
    at = np.flatnonzero(np.r_[len(found) > 0, found[1:] != found[:-1]])
    u, n = found[at], np.diff(np.r_[at, len(found)])
    del found, at
    first = np.flatnonzero(np.r_[len(u) > 0, (u[1:] ^ u[:-1]) > np.uint64(7)])
    if not len(first):
        return np.empty(0, np.uint64), np.empty((0, 3 + len(ends)), np.uint16)
    total = np.add.reduceat(n, first)
    least = 2
    if most is not None:
        while np.count_nonzero(total >= least) > most:
            least += 1
    many = total >= least
    own = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(u)]))
    some = many[own]
    counts = np.zeros((int(many.sum()), 3 + len(ends)), dtype=np.float64)
    counts[(np.cumsum(many) - 1)[own[some]], (u[some] & np.uint64(7)).astype(int)] = n[some]
    counts *= np.minimum(1.0, 60_000 / np.maximum(counts.max(axis=1, keepdims=True), 1))  # proportions are kept
    return u[first[many]] & ~np.uint64(7), np.ceil(counts).astype(np.uint16)


def _finals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ends of values as bytes without trailing dots."""
    for p in batches:
        parts = [split_mark(t) for t in p["tail"]]
        tails = [_bytes(x[0])[-2 * TAIL_CHARS :] for x in parts]
        yield p.assign(tail=tails, letter=[bool(t) and bool(_WORD[t[-1]]) for t in tails], marked=[x[1] for x in parts], broken=[x[2] for x in parts])


def different_ends(finals: DataFrame) -> DataFrame:
    """(field, end, witnesses): the different final bytes that contexts are taken from, and how many different values with them may be witnesses.

    finals: (field, source, tail, witness). A short text that several sources hold was written several times, a long one was copied."""
    seen = F.substring("tail", -WITNESS, WITNESS)
    own = F.when(F.length(seen) < SHORT, F.col("source")).otherwise("")
    rows = finals.select("field", F.substring("tail", -ORDERS[-1], ORDERS[-1]).alias("end"), F.when(F.col("witness"), own).alias("own"), F.when(F.col("witness"), seen).alias("seen"))
    return rows.distinct().groupBy("field", "end").agg(F.count("seen").alias("witnesses"))


def _asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each order that an end is long enough for."""
    for p in batches:
        keys, size = tail_keys([bytes(t) for t in p["end"]])
        for k, n in enumerate(ORDERS):
            long = size >= n
            yield p[long].assign(at=k, key=keys[long, k].view(np.int64))


def _filter_slice(pdf: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(1 << SLICE_LOG, dtype=np.uint8)
    bits[pdf["slot"].to_numpy() & ((1 << SLICE_LOG) - 1)] = 1
    return pd.DataFrame({"slice": [int(pdf["slot"].iloc[0]) >> SLICE_LOG], "bits": [np.packbits(bits, bitorder="little").tobytes()]})


def asked_filter(asked: DataFrame) -> tuple[np.ndarray, int]:
    """(bits by the highest bits of an asked key, log2 of their number). A slice has at most two to SLICE_LOG different bits to put together."""
    log = min(FILTER_LOG, max(SLICE_LOG, (32 * asked.count()).bit_length()))
    slots = asked.select(F.shiftrightunsigned("key", 64 - log).alias("slot")).distinct()
    out = np.zeros(1 << (log - 3), dtype=np.uint8)
    step = 1 << (SLICE_LOG - 3)
    for r in slots.groupBy(F.shiftright("slot", SLICE_LOG).alias("slice")).applyInPandas(_filter_slice, "slice long, bits binary").collect():
        out[r["slice"] * step : (r["slice"] + 1) * step] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out, log


def _chunks(texts: Iterator[bytes]) -> Iterator[tuple[np.ndarray, int, int]]:
    """Texts, each closed by a zero byte, in runs of about CHUNK_BYTES, and which positions of the run count: a longer text comes in pieces with the bytes around them."""
    run, n = [], 0
    for t in texts:
        if len(t) > CHUNK_BYTES:
            for i in range(0, len(t), CHUNK_BYTES):
                lead = min(i, ORDERS[-1])
                piece = t[i - lead : i + CHUNK_BYTES + 2]
                yield np.frombuffer(piece, dtype=np.uint8), lead, min(lead + CHUNK_BYTES, len(piece))
            continue
        run.append(t)
        n += len(t)
        if n >= CHUNK_BYTES:
            yield np.frombuffer(b"".join(run), dtype=np.uint8), 0, n
            run, n = [], 0
    if run:
        yield np.frombuffer(b"".join(run), dtype=np.uint8), 0, n


def asked_contexts(data: np.ndarray, what: np.ndarray, inside: np.ndarray, bits: np.ndarray, log: int, powers: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """The keys of those contexts of all orders that the filter knows, with what follows in the lowest bits."""
    sums = prefix_sums(data, powers[1])
    starts = np.flatnonzero(np.r_[True, data[:-1] == 0])
    depth = np.arange(1, len(data) + 1, dtype=np.int32) - np.repeat(starts, np.diff(np.r_[starts, len(data)])).astype(np.int32)
    at, found = np.flatnonzero(inside), []
    for n in ORDERS:
        at = at[depth[at] >= n]
        keys = exact_keys((sums[at + 1] - sums[at + 1 - n]) * powers[0][at], n)
        slot = keys >> np.uint64(64 - log)
        known = (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0
        at = at[known]  # a longer context is asked for only with all its shorter ones
        found.append(keys[known] | what[at])
    return found


def _counter(shared):
    """(key, n): asked contexts with what follows in the lowest three bits; 3 there marks the grams of a language, 4 the totals."""

    def frames(keys: np.ndarray, n: np.ndarray) -> Iterator[pd.DataFrame]:
        for i in range(0, len(keys), 500_000):
            yield pd.DataFrame({"key": keys[i : i + 500_000].view(np.int64), "n": n[i : i + 500_000]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, log = shared.value
        powers = _powers(2 * CHUNK_BYTES)
        totals, language = np.zeros(4, dtype=np.int64), np.zeros((GRAMS, len(LANGUAGES)), dtype=np.int64)
        pending, n_pending = [], 0
        for p in batches:
            for lab, part in p.groupby("language"):
                for data, lo, hi in _chunks(_bytes(t.rstrip()) + b"\0" for t in part["text"]):
                    what, inside = _outcomes(data)
                    inside[:lo] = inside[hi:] = False
                    word = inside & _WORD[data]
                    totals += [(inside & (what == 0)).sum(), inside.sum(), (word & (what == 1)).sum(), (word & (what != 0)).sum()]
                    if lab in LANGUAGES:
                        language[:, LANGUAGES.index(lab)] += np.bincount(grams(data)[lo:hi], minlength=GRAMS)
                    found = asked_contexts(data, what, inside, bits, log, powers)
                    pending += found
                    n_pending += sum(map(len, found))
                    if n_pending >= PENDING:
                        yield from frames(*np.unique(np.concatenate(pending), return_counts=True))
                        pending, n_pending = [], 0
        if n_pending:
            yield from frames(*np.unique(np.concatenate(pending), return_counts=True))
        g, lang = np.nonzero(language)
        yield from frames((g * 8 + lang) * 8 + 3, language[g, lang])
        yield from frames(np.arange(4) * 8 + 4, totals)

    return run


def count_asked(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """(key, n) of _counter, added up over all texts. texts: (text, language); asked: (key)."""
    shared = texts.sparkSession.sparkContext.broadcast(asked_filter(asked))
    return materialize(texts.mapInPandas(_counter(shared), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "contexts")


@dataclass
class Letters:
    base: float  # how often a position inside a text ends something
    gap: float  # how often the letters of a text are followed by no letter
    languages: np.ndarray  # log-likelihood of each gram, one column a language

    def language(self, tails: list[bytes]) -> list[str]:
        out = []
        for i in range(0, len(tails), 2000):
            part = tails[i : i + 2000]
            size = np.array([len(t) for t in part])
            start = np.cumsum(size) - size
            data = np.frombuffer(b"".join(part) + b"\0\0", dtype=np.uint8)
            score = np.zeros((len(data) - 1, len(LANGUAGES)))
            np.cumsum(self.languages[grams(data)], axis=0, out=score[1:])
            best = (score[start + np.maximum(size - 2, 0)] - score[start]).argmax(axis=1)
            out += [LANGUAGES[k] for k in best]
        return out


def letters(counts: DataFrame) -> Letters:
    """What concerns all orders, from count_asked: a table of GRAMS by languages at most."""
    totals, seen = np.zeros(4), np.ones((GRAMS, len(LANGUAGES)))
    for key, n in counts.filter(F.col("key").bitwiseAND(7).isin(3, 4)).collect():
        if key & 7 == 4:
            totals[key >> 3] = n
        else:
            seen[key >> 6, (key >> 3) & 7] += n
    ended, inner, gaps, followed = totals
    return Letters(float((ended + 1) / (inner + 50)), float((gaps + 1) / (followed + 6)), np.log(seen / seen.sum(axis=0)))


def end_odds(asked: DataFrame, counts: DataFrame, base: float, gap: float) -> DataFrame:
    """(field, end, log_odds, within) for every different end: log-odds that the text goes on, and how likely it then goes on within a word.

    asked: (field, end, witnesses, at, key). Contexts of growing length, where shorter ones smooth longer ones; one witness is the end itself."""
    kind = F.col("key").bitwiseAND(7)
    n = [F.sum(F.when(kind == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(3)]
    inner = counts.filter(kind < 3).groupBy(F.col("key").bitwiseAND(-8).alias("key")).agg(*n)
    own = asked.groupBy("key", "field").agg(F.sum("witnesses").alias("ends"))
    known = materialize(own.join(inner, "key", "left").na.fill(0, ["n0", "n1", "n2"]), "known")
    each = asked.select("field", "end", "at", "key").join(broadcast_if_small(known, known.count(), 96), ["key", "field"])
    orders = F.array_sort(F.collect_list(F.struct("at", F.greatest(F.col("ends") - 1, F.lit(0)).alias("value"), "n0", "n1", "n2")))
    start = F.struct(F.lit(base).alias("end"), F.lit(1 - gap).alias("mid"))

    def longer(o, c):
        end = (c["n0"] + c["value"] + F.lit(SMOOTHING) * o["end"]) / (c["n0"] + c["n1"] + c["n2"] + c["value"] + F.lit(SMOOTHING))
        return F.struct(end.alias("end"), ((c["n2"] + F.lit(SMOOTHING) * o["mid"]) / (c["n1"] + c["n2"] + F.lit(SMOOTHING))).alias("mid"))

    got = each.groupBy("field", "end").agg(orders.alias("orders")).select("field", "end", F.aggregate("orders", start, longer).alias("o"))
    end = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), F.col("o.end")))
    return got.select("field", "end", (F.log1p(-end) - F.log(end) - F.lit(float(np.log((1 - base) / base)))).alias("log_odds"), F.col("o.mid").alias("within"))


def values(docs: DataFrame, id_col: str, columns: tuple[str, ...], source_col: str, language: Column) -> DataFrame:
    """(id, language, source, field, value): the columns' values as rows, blanks left out."""
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns])).alias("v")
    rows = docs.select(F.col(id_col).alias("id"), language.alias("language"), F.coalesce(F.col(source_col), F.lit("")).alias("source"), stacked)
    return rows.select("id", "language", "source", "v.field", "v.value").filter(F.col("value").rlike(r"\S"))


def plain_language(label: Column) -> Column:
    """A coarse language of a label: its first two letters, where they name one."""
    code = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]{2,3})(?:$|[-_])", 1))
    return F.when(code.isin("id", "ind", "in"), "id").when(code.isin("en", "eng"), "en").when(code.isin("es", "spa"), "es").when(code.isin("fr", "fra"), "fr").otherwise("und")


def trails_off(value: Column) -> Column:
    return value.rlike(r"(?:…|\.\.)\s*$")


PILE = ["source", "field", "length", "dotted"]


def limits(lengths: DataFrame, least: int = 5, ratio: float = 8.0, reach: int = 10) -> DataFrame:
    """(*PILE, excess): lengths at which a source's different values, with or without trailing dots, pile up over what the lengths beside them hold;
    excess is the log of how many times that many there are beyond it. lengths: (*PILE, text_hash)."""
    counts = lengths.distinct().groupBy(*PILE).agg(F.count(F.lit(1)).alias("n"))
    # Each length spreads its count over its neighbours; summing that needs no window over a source.
    near = counts.select("source", "field", "dotted", "n", "length", F.explode(F.sequence(F.col("length") - reach, F.col("length") + reach)).alias("at"))
    around = near.groupBy("source", "field", F.col("at").alias("length"), "dotted").agg(
        F.sum(F.when(F.col("at") == F.col("length"), F.col("n")).otherwise(0)).alias("here"), F.sum(F.when(F.col("at") != F.col("length"), F.col("n")).otherwise(0)).alias("beside")
    )
    usual = F.col("beside") / (2 * reach) + 0.25
    return around.filter((F.col("here") >= least) & (F.col("here") >= ratio * usual) & (F.col("length") >= 20)).select(*PILE, F.log((F.col("here") - usual) / usual).alias("excess"))


def different_texts(rows: DataFrame) -> DataFrame:
    """(text, language): every different text once."""
    return rows.groupBy(F.xxhash64("value").alias("h")).agg(F.first("value").alias("text"), F.min("language").alias("language")).select("text", "language")


_FINAL = "id long, field string, source string, length int, dotted boolean, n_words int, tail binary, text_hash long, letter boolean, marked boolean, broken boolean"


def _with_language(shared, schema: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            yield p.assign(language=shared.value.language([bytes(t) for t in p["tail"]]))[schema]

    return run


def _fit_share(pdf: pd.DataFrame, rounds: int = 200) -> pd.DataFrame:
    """EM for the share of cut values of one stratum away from limits, over its histogram of log-odds (bin, n); at most a half."""
    x, n = pdf["bin"].to_numpy(float), pdf["n"].to_numpy(float)
    share = prior = 0.3 if bool(pdf["marked"].iloc[0]) else 0.03
    for _ in range(rounds):
        post = 1 / (1 + np.exp(np.clip(-(x + np.log(share / (1 - share))), -50, 50)))
        new = float(np.clip(((n * post).sum() + 2 * prior) / (n.sum() + 2), 1e-4, 0.5))
        if abs(new - share) < 1e-7:
            break
        share = new
    return pdf[["field", "language", "marked"]].iloc[:1].assign(prior=float(np.log(share / (1 - share))))


def abridged_counts(open_ends: DataFrame, gap: float, least: int = 5, ratio: float = 4.0) -> DataFrame:
    """(field, n_words, abridged): word counts at which values that go on end with a whole word far oftener than cuts would.

    open_ends: (field, n_words, whole). A cut within a word happens 1 - gap of the time, so the cuts within words foretell those between words.
    """
    n = open_ends.groupBy("field", "n_words").agg(F.count_if("whole").alias("whole"), F.count_if(~F.col("whole")).alias("within"))
    foretold = (F.col("within") + 1) * (gap / (1 - gap))
    return n.filter((F.col("whole") >= least) & (F.col("whole") >= ratio * foretold)).select("field", "n_words", F.lit(True).alias("abridged"))


def truncated_values(docs: DataFrame, id_col: str = "document_id", columns: tuple[str, ...] = ("title", "body"), source_col: str = "source_name", language_col: str = "language") -> DataFrame:
    """(id, field, source, language, log_odds, posterior, marked, at_limit, broken, abridged, truncated) for every value that isn't blank."""
    rows = values(docs, id_col, columns, source_col, plain_language(F.col(language_col)))
    short = rows.select("id", "field", "source", F.char_length("value").alias("length"), trails_off(F.col("value")).alias("dotted"), F.size(F.split(F.trim("value"), r"\s+")).alias("n_words"), F.right("value", F.lit(2 * TAIL_CHARS)).alias("tail"), F.xxhash64("value").alias("text_hash"))
    finals = materialize(short.mapInPandas(_finals, _FINAL), "ends")
    piles = materialize(limits(finals.select(*PILE, "text_hash")), "limits")
    finals = finals.drop("text_hash").join(broadcast_if_small(piles, piles.count(), 80), PILE, "left").drop("length", "dotted")
    witness = F.col("excess").isNull() & ~F.col("marked") & ~F.col("broken")
    ends = different_ends(finals.select("field", "source", "tail", witness.alias("witness")))
    asked = materialize(ends.mapInPandas(_asked, "field string, end binary, witnesses long, at int, key long"), "asked")
    counts = count_asked(different_texts(rows), asked)
    model = letters(counts)
    odds = materialize(end_odds(asked, counts, model.base, model.gap), "odds")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    told = finals.drop("tail").withColumn("end", F.lit(None).cast("binary")).withColumn("language", F.lit("")).schema
    judged = finals.withColumn("end", F.substring("tail", -ORDERS[-1], ORDERS[-1])).mapInPandas(_with_language(shared, told.names), told)
    judged = judged.join(broadcast_if_small(odds, odds.count(), 96), ["field", "end"], "left").drop("end")
    judged = materialize(judged.withColumns({"log_odds": F.coalesce("log_odds", F.lit(0.0)), "within": F.coalesce("within", F.lit(1 - model.gap))}), "judged")
    free = F.col("excess").isNull() & ~F.col("broken")
    strata = ["field", "language", "marked"]
    histogram = judged.filter(free).groupBy(*strata, (F.round(F.col("log_odds") * 4) / 4).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    shares = histogram.groupBy(*strata).applyInPandas(lambda pdf: _fit_share(pdf), "field string, language string, marked boolean, prior double")
    scored = judged.join(F.broadcast(shares), strata, "left")  # two columns by four languages by two
    logit = F.col("log_odds") + F.coalesce("excess", "prior", F.lit(0.0))
    scored = scored.withColumn("posterior", F.when(F.col("broken"), F.lit(1.0)).otherwise(1 / (1 + F.exp(-logit)))).withColumn("whole", F.col("letter") & (F.col("within") < 0.5))
    counts = abridged_counts(scored.filter(free & ~F.col("marked") & F.col("letter") & (F.col("posterior") > 0.5)).select("field", "n_words", "whole"), model.gap)
    out = scored.join(F.broadcast(counts.filter(F.col("n_words") <= MOST_WORDS)), ["field", "n_words"], "left")
    abridged = F.coalesce("abridged", F.lit(False)) & free & ~F.col("marked") & F.col("whole")
    return out.select("id", "field", "source", "language", "log_odds", "posterior", "marked", F.col("excess").isNotNull().alias("at_limit"), "broken", abridged.alias("abridged"), ((F.col("posterior") > 0.5) & ~abridged).alias("truncated"))
