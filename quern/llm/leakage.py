"""Evaluation texts inside a training corpus, found through suffix arrays of the corpus.

The corpus is cut into shards of about SHARD_WORDS words as it streams through a task. Each shard gets a suffix array over its
words (prefix doubling); every suffix of every evaluation text is located by binary search, vectorised over all suffixes, and
its matches are extended to the longest verbatim run. No shuffle of the corpus is needed, no group is formed, and a shard's
memory does not depend on how the rows are skewed. The evaluation texts are the stated query set: they are taken to the
executors in blocks of at most BLOCK_CHARS characters, one pass of the corpus for each block.

Defined results: null and blank texts match nothing; an item of fewer than min_words words can't leak; repeated documents each
match, repeated rows of one id give one row per match; empty tables give no rows; what stands between words (punctuation,
line breaks, letter case) is ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.words import WordHashes, word_hashes
from quern.session import materialize

SHARD_WORDS = 400_000
BLOCK_CHARS = 32 << 20


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of a word sequence in lexicographic order, by prefix doubling."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    order, h = np.argsort(rank, kind="stable"), 1
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[: max(0, n - h)] = rank[h:] + 1 if h < n else 0
        key = rank * np.int64(n + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.r_[0, sorted_key[1:] != sorted_key[:-1]])
        rank, h = new, 2 * h
        if n == 0 or rank[order[-1]] == n - 1 or h >= n:
            return order


def _bound(tokens: np.ndarray, order: np.ndarray, wanted: np.ndarray, upper: bool) -> np.ndarray:
    """For each row of `wanted` (queries, width): how many suffixes are smaller (or, upper, not larger) in their first words."""
    width, n = wanted.shape[1], len(order)
    padded = np.r_[tokens, np.full(width, -1, tokens.dtype)]
    lo, hi, cols = np.zeros(len(wanted), np.int64), np.full(len(wanted), n, np.int64), np.arange(width)
    for _ in range(max(1, n).bit_length()):
        open_ = lo < hi
        mid = (lo + hi) // 2
        got = padded[order[np.minimum(mid, n - 1)][:, None] + cols]
        diff = got != wanted
        first = np.where(diff.any(axis=1), diff.argmax(axis=1), 0)
        at = np.arange(len(wanted))
        a, b = got[at, first], wanted[at, first]
        right = (a < b) | (upper & (a == b))
        lo = np.where(open_ & right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)
    return lo


def shard_matches(docs: list[np.ndarray], items: list[np.ndarray], min_words: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, item, word in the document, word in the item, words) of every longest verbatim run of at least min_words words."""
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    if not len(docs) or not lengths.sum():
        return
    vocabulary, coded = np.unique(np.concatenate(docs), return_inverse=True)
    # A separator (0) follows each document, so no run crosses from one into the next.
    starts = np.cumsum(np.r_[0, lengths[:-1] + 1])
    tokens = np.zeros(int((lengths + 1).sum()), dtype=np.int64)
    tokens[np.arange(len(coded)) + np.repeat(np.arange(len(docs)), lengths)] = coded + 1
    coded_items = []
    for words in items:
        at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
        coded_items.append(np.where(vocabulary[at] == words, at + 1, -2) if len(words) else at)
    queries = [(k, p) for k, c in enumerate(coded_items) for p in range(len(c) - min_words + 1) if (c[p : p + min_words] > 0).all()]
    if not queries:
        return
    order = suffix_array(tokens)
    wanted = np.array([coded_items[k][p : p + min_words] for k, p in queries])
    low, high = _bound(tokens, order, wanted, False), _bound(tokens, order, wanted, True)
    for (k, p), a, b in zip(queries, low, high):
        c = coded_items[k]
        for pos in order[a:b]:
            if p and pos and tokens[pos - 1] == c[p - 1]:
                continue  # part of a run that begins earlier
            most = min(len(c) - p, len(tokens) - pos)
            differ = np.flatnonzero(tokens[pos : pos + most] != c[p : p + most])
            doc = int(np.searchsorted(starts, pos, side="right") - 1)
            yield doc, k, int(pos - starts[doc]), p, int(differ[0] if len(differ) else most)


def _matcher(ids: list, texts: list[str], min_words: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHashes()
        items = [word_hashes(t, memo) for t in texts]
        names: list = []
        docs: list[np.ndarray] = []
        size = 0

        def flush() -> pd.DataFrame:
            rows = [(names[d], ids[k], dp, ip, n) for d, k, dp, ip, n in shard_matches(docs, items, min_words)]
            return pd.DataFrame(rows, columns=["doc", "item", "doc_word", "item_word", "words"])

        for p in batches:
            for name, text in zip(p["doc"], p["text"]):
                if not isinstance(text, str):
                    continue
                names.append(name)
                docs.append(word_hashes(text, memo))
                size += len(docs[-1])
                if size >= SHARD_WORDS:
                    yield flush()
                    names, docs, size = [], [], 0
        if docs:
            yield flush()

    return run


def leaked_passages(docs: DataFrame, items: DataFrame, min_words: int = 12, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, doc_word, item_word, words): every longest verbatim run of at least min_words words, with its places."""
    base = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc"), F.col(doc_text).alias("text"))
    wanted = items.filter(F.col(item_text).isNotNull() & F.col(item_id).isNotNull()).select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text"))
    total = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_CHARS))
    parts = []
    for b in range(blocks):
        rows = wanted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect() if blocks > 1 else wanted.collect()
        found = base.mapInPandas(_matcher([r.item for r in rows], [r.text for r in rows], min_words), "doc long, item long, doc_word long, item_word long, words long")
        parts.append(materialize(found, "leaks") if blocks > 1 else found)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct().select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "doc_word", "item_word", "words")


def without_leaks(docs: DataFrame, passages: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """docs without those that hold a leaked passage; rows of null id stay."""
    return docs.join(passages.select(F.col("doc_id").alias(doc_id)).distinct(), doc_id, "left_anti")
