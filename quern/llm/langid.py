"""Languages of documents and of the segments in them.

A word is the average of hashed subword embeddings (the word itself and its character n-grams of 3 to 5 letters between
boundary marks); a segment is the average over its words' subwords, and a linear softmax reads the language off it. Embeddings and
softmax are trained together by stochastic gradient descent in numpy on a bounded, hash-ordered sample of labelled rows
(`per_language` documents a language). Confidence is calibrated on held-out segments: logits are scaled by a temperature that
depends on the segment's length, and a segment whose confidence stays under the rejection threshold is `und`.

At prediction time embeddings and softmax collapse into one table of hashed subwords by languages, so a word's share is a short
sum that is remembered per word. The table has BUCKETS rows whatever the data's size; it is all that is sent to the executors.

Defined results: null and blank texts have no segments and language `und` with confidence 0; texts of any length are read whole;
repeated rows get equal results; with too few labelled rows for a language its function words stand in as training segments.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.words import lowest

BUCKETS, DIM = 1 << 15, 16
LANGUAGES = ("id", "en", "es", "fr")

#: Codes and names that labels use for the languages.
LABELS = {
    "id": "id", "ind": "id", "in": "id", "indonesian": "id", "bahasa indonesia": "id", "indonesia": "id",
    "en": "en", "eng": "en", "english": "en", "es": "es", "spa": "es", "spanish": "es", "español": "es", "castellano": "es",
    "fr": "fr", "fra": "fr", "fre": "fr", "french": "fr", "français": "fr",
}

#: Function words, used where labelled rows are missing.
SEEDS = {
    "id": "yang dan di ke dari untuk dengan pada ini itu tidak saya kami karena juga sudah belum akan ada bisa hanya sampai sejak agar atau oleh para",
    "en": "the of and to in is that for it on was with as be at by this from are or not but have has had were will would they you my",
    "es": "de la el los las un una y en que por con para del se su al es no como más pero sin sobre desde hasta porque aunque",
    "fr": "le les des du et une est pour dans ce qui au aux sur par pas ne plus avec son sa ses ou car bien depuis avant",
}

_WORD = re.compile(r"[^\W\d_]+")
_ANY_WORD = re.compile(r"[^\W_]+")
_SEGMENT = re.compile(r"[^\n]+?(?:[.!?…]+(?=[\s\"'”’)\]]|$)|(?=\n)|$)", re.S)


def normal_label(label: Column) -> Column:
    """id, en, es or fr where a label names exactly that language, in any spelling and with any region; else null."""
    base = F.regexp_extract(F.lower(F.trim(label)), r"^([^-_]+)(?:[-_][a-z0-9]{2,4})?$", 1)
    pairs = [x for k, v in LABELS.items() for x in (F.lit(k), F.lit(v))]
    return F.element_at(F.create_map(*pairs), base)


def subwords(word: str) -> list[int]:
    w = f"<{word}>"
    grams = [w] + [w[i : i + n] for n in (3, 4, 5) if n < len(w) for i in range(len(w) - n + 1)]
    return [xxhash.xxh32_intdigest(g) & (BUCKETS - 1) for g in grams]


def segments(text: str) -> list[str]:
    """Sentences and lines, in order."""
    return [s for m in _SEGMENT.finditer(text) if (s := m.group().strip())]


_CLOSED = re.compile(r"(?<![.…])[.!?][^\w.…]*$")
_ADDRESS = re.compile(r"\S*@\S*|\b(?:https?://|www\.)\S+|\S+\s?[(\[]at[)\]]\s?\S+(?:\sdot\s\S+)*")


def evidence(segment: str) -> tuple[list[str], int]:
    """Lower-cased words that speak for a language, and the number of all words. Names, places and days have no say, so capitalised words after the first are left
    out, unless the segment is in capitals or little else is in it; nor have e-mail and web addresses."""
    # Only segments with a mark of an address are searched for one.
    words = _WORD.findall(_ADDRESS.sub(" ", segment) if any(x in segment for x in ("@", "(at", "[at", "://", "www.")) else segment)
    plain = [w for i, w in enumerate(words) if i == 0 or not w[0].isupper()]
    return [w.lower() for w in (plain if len(plain) >= 2 else words)], len(words)


@dataclass
class LanguageModel:
    table: np.ndarray  # (BUCKETS, languages): embeddings times softmax weights
    bias: np.ndarray
    scale: tuple[float, float]  # logits are multiplied by a + b * sqrt(words)
    reject: float
    languages: tuple[str, ...] = LANGUAGES

    def word(self, word: str, memo: dict) -> tuple[np.ndarray, int]:
        got = memo.get(word)
        if got is None:
            if len(memo) > 500_000:
                memo.clear()
            ids = subwords(word)
            got = memo[word] = (self.table[ids].sum(axis=0), len(ids))
        return got

    def raw(self, words: list[str], memo: dict) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for w in words:
            s, k = self.word(w, memo)
            total += s
            n += k
        return total / max(1, n) + self.bias

    def scaled(self, logits: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        z = logits * (self.scale[0] + self.scale[1] * np.sqrt(n_words))[:, None]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _segment_logits(model: LanguageModel, segs: list[list[str]], memo: dict) -> np.ndarray:
    """Logits of many segments at once: words are looked up once each, then summed by segment."""
    index: dict[str, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for s in segs for w in s), dtype=np.int64)
    if not len(ids):
        return np.zeros((len(segs), len(model.languages))) + model.bias
    per = [model.word(w, memo) for w in index]
    sums, counts = np.array([p[0] for p in per]), np.array([p[1] for p in per], dtype=float)
    lengths = np.array([len(s) for s in segs])
    own = np.repeat(np.arange(len(segs)), lengths)
    total = np.stack([np.bincount(own, sums[ids, k], len(segs)) for k in range(sums.shape[1])], axis=1)
    return total / np.maximum(1, np.bincount(own, counts[ids], len(segs)))[:, None] + model.bias


def _sgd(docs: list[np.ndarray], y: np.ndarray, order: np.ndarray, subs: list[np.ndarray], rng: np.random.Generator, epochs: int, rate: float, batch: int) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings and softmax by minibatch descent on the segments in `order`; returns their product and the bias."""
    n_subs = np.array([len(s) for s in subs], dtype=float)
    table = rng.normal(0, 0.1, (BUCKETS, DIM))
    weights, bias = rng.normal(0, 0.1, (DIM, len(LANGUAGES))), np.zeros(len(LANGUAGES))
    share = np.maximum(np.bincount(y[order], minlength=len(LANGUAGES)), 1)
    weight = np.minimum((1 / share)[y] * share.mean(), 5)
    order = order.copy()
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        rng.shuffle(order)
        for a in range(0, len(order), batch):
            part = order[a : a + batch]
            words = np.concatenate([docs[i] for i in part])
            own = np.repeat(np.arange(len(part)), [len(docs[i]) for i in part])
            used, at = np.unique(words, return_inverse=True)
            flat = np.concatenate([subs[w] for w in used])
            bounds = np.cumsum(np.r_[0, [len(subs[w]) for w in used][:-1]])
            vectors = np.add.reduceat(table[flat], bounds, axis=0)
            size = np.bincount(own, n_subs[words], len(part))
            mean = np.zeros((len(part), DIM))
            np.add.at(mean, own, vectors[at])
            mean /= size[:, None]
            z = mean @ weights + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            p *= weight[part][:, None] / len(part)
            back = (p @ weights.T) / size[:, None]
            per_word = np.zeros((len(used), DIM))
            np.add.at(per_word, at, back[own])
            weights -= 4 * step * mean.T @ p
            bias -= step * p.sum(axis=0)
            # A subword's step is scaled up by about the number of subwords that share a segment's gradient.
            np.add.at(table, flat, -60 * step * np.repeat(per_word, [len(subs[w]) for w in used], axis=0))
    return table @ weights, bias


def train(texts: list[str], labels: list[str], seed: int = 1, epochs: int = 4, rate: float = 1.2, batch: int | None = None, target_precision: float = 0.999) -> LanguageModel:
    """Two rounds of SGD over segments: the second leaves out segments that the first reads as another language than their
    document's label says (labels are noisy and documents mixed). Every tenth segment is held out for the calibration."""
    rng = np.random.default_rng(seed)
    segs, y = [], []
    for t, lab in zip(texts, labels):
        for s in segments(t):
            if len(w := evidence(s)[0]) >= 3:
                segs.append(w)
                y.append(LANGUAGES.index(lab))
    for lab, words in SEEDS.items():
        pool = words.split()
        for _ in range(40):
            segs.append([pool[i] for i in rng.integers(0, len(pool), 8)])
            y.append(LANGUAGES.index(lab))
    y = np.array(y)
    vocabulary: dict[str, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in s]) for s in segs]
    subs = [np.array(subwords(w)) for w in vocabulary]
    held = rng.random(len(docs)) < 0.1
    if batch is None:  # small samples need as many steps as large ones
        batch = min(256, max(16, len(docs) // 40))
    table, bias = _sgd(docs, y, np.flatnonzero(~held), subs, rng, epochs, rate, batch)
    first = LanguageModel(table, bias, (1.0, 0.0), 0.5)
    agrees = _segment_logits(first, segs, {}).argmax(axis=1) == y
    table, bias = _sgd(docs, y, np.flatnonzero(~held & agrees), subs, rng, epochs, rate, batch)
    model = LanguageModel(table, bias, (1.0, 0.0), 0.5)
    hold = np.flatnonzero(held & agrees)
    # Whole held-out segments and the first four words of each calibrate long and short segments.
    probe = [segs[i] for i in hold] + [segs[i][:4] for i in hold]
    truth = np.r_[y[hold], y[hold]]
    logits, n = _segment_logits(model, probe, {}), np.array([len(s) for s in probe], dtype=float)
    best = (np.inf, (1.0, 0.0))
    for a in (0.25, 0.5, 1.0, 2.0, 4.0):
        for b in (0.0, 0.1, 0.25, 0.5, 1.0):
            model.scale = (a, b)
            q = model.scaled(logits, n)
            loss = -np.log(0.995 * q[np.arange(len(truth)), truth] + 0.005 / len(LANGUAGES)).mean() if len(truth) else 0.0
            if loss < best[0]:
                best = (loss, (a, b))
    model.scale = best[1]
    if len(truth):
        q = model.scaled(logits, n)
        confidence, right = q.max(axis=1), q.argmax(axis=1) == truth
        for t in np.arange(0.5, 0.96, 0.05):
            if (kept := confidence >= t).any() and right[kept].mean() >= target_precision:
                break
        model.reject = float(t)
    return model


def labelled_sample(docs: DataFrame, text_col: str, label: Column, per_language: int) -> list:
    """About per_language documents of each language (the bound is on the expectation), those of the lowest 64-bit hashes, at any number of rows."""
    rows = docs.select(F.col(text_col).alias("text"), label.alias("label")).filter(F.col("label").isNotNull() & (F.length("text") >= 30))
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    keep = F.lit(False)
    for lab, n in counts.items():
        keep = keep | ((F.col("label") == lab) & lowest(F.xxhash64("text"), F.lit(min(1.0, per_language / n))))
    # Copies of a text come once, so that the bound holds whatever is copied how often.
    return rows.filter(keep).groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.min("label").alias("label")).collect()


def fit(docs: DataFrame, text_col: str = "body", label_col: str = "language", per_language: int = 300) -> LanguageModel:
    sample = labelled_sample(docs, text_col, normal_label(F.col(label_col)), per_language)
    return train([r.text for r in sample], [r.label for r in sample])


def _predict(model: LanguageModel, min_words: int, keep: tuple[str, ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict = {}
        names = np.array(model.languages)
        for p in batches:
            for a in range(0, len(p), 2000):
                part = p.iloc[a : a + 2000]
                own, spans, words, all_words, site = [], [], [], [], []
                for k, (t, skip) in enumerate(zip(part["text"], part["skip"])):
                    if not isinstance(t, str):
                        continue
                    lines = t.split("\n")
                    out = set() if skip is None else set(skip)
                    if len(out) >= sum(1 for x in lines if x.strip()):
                        out = set()  # nothing but such lines: then they are the text
                    at = 0
                    for i, line in enumerate(lines, 1):
                        if line.strip():
                            for s in segments(line):
                                own.append(k)
                                site.append(i in out)
                                spans.append((at, s))
                                speaking, k_words = evidence(s)
                                words.append(speaking)
                                all_words.append(k_words)
                                at += 1
                own = np.array(own, dtype=np.int64)
                n = np.array([len(w) for w in words], dtype=float)
                all_words = np.array(all_words)
                logits = _segment_logits(model, words, memo) if words else np.zeros((0, len(names)))
                prob = model.scaled(logits, n) if words else logits
                best, conf = prob.argmax(axis=1) if words else own, prob.max(axis=1) if words else n
                sure = (conf >= model.reject) & (all_words >= min_words) if words else np.zeros(0, bool)
                # The document: its segments' probabilities, weighted by their words; lines without a say weigh nothing.
                say = np.where(np.array(site, dtype=bool), 0.0, n)
                total = np.stack([np.bincount(own, prob[:, j] * say, len(part)) for j in range(len(names))], axis=1) if words else np.zeros((len(part), len(names)))
                mass = total.sum(axis=1)
                doc_best, doc_conf = total.argmax(axis=1), np.where(mass > 0, total.max(axis=1) / np.maximum(mass, 1e-9), 0.0)
                cuts = np.searchsorted(own, np.arange(len(part) + 1))
                rows = []
                for k in range(len(part)):
                    s, e = cuts[k], cuts[k + 1]
                    last = {e - 1, next((i for i in range(e - 1, s - 1, -1) if not site[i]), e - 1)}  # of all segments, and of those with a say
                    rows.append([{"segment": int(spans[i][0]), "language": str(names[best[i]]) if sure[i] else "und", "confidence": float(conf[i]), "words": int(all_words[i]), "whole": bool(i not in last or _CLOSED.search(spans[i][1])), "site_line": site[i]} for i in range(s, e)])
                doc_lang = [str(names[b]) if m > 0 and c >= min(0.5, model.reject) else "und" for b, c, m in zip(doc_best, doc_conf, mass)]
                size = [len(_ANY_WORD.findall(t)) if isinstance(t, str) else 0 for t in part["text"]]
                kept = {f"label_{c}": part[f"label_{c}"].to_numpy() for c in keep}
                yield pd.DataFrame({"id": part["id"].to_numpy(), "language": doc_lang, "confidence": doc_conf, "n_words": size, "segments": rows, **kept})

    return run


SCHEMA = "id long, language string, confidence double, n_words int, segments array<struct<segment:int,language:string,confidence:double,words:int,whole:boolean,site_line:boolean>>"


def document_languages(docs: DataFrame, model: LanguageModel, id_col: str = "document_id", text_col: str = "body", skip_col: str | None = None, min_words: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, language, confidence, n_words, segments, label_* of the kept columns). skip_col: numbers of lines, from 1, that have no say
    in the document's language.

    segments has every sentence of every line in order with its language (`und` under the rejection threshold or min_words words) and confidence; whole is
    false for a last sentence without a closing mark, which may be cut; site_line is true for sentences of lines without a say.
    """
    skip = F.col(skip_col) if skip_col else F.lit(None).cast("array<int>")
    kept = [F.col(c).cast("string").alias(f"label_{c}") for c in keep]
    schema = SCHEMA + "".join(f", label_{c} string" for c in keep)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), skip.alias("skip"), *kept).mapInPandas(_predict(model, min_words, keep), schema)
