"""Near-duplicate texts by circulant MinHash, banding and exact Jaccard verification.

Circulant MinHash: one permutation scatters the shingles of a text over D slots, a second one, shifted circularly by k,
gives coordinate k of the signature. All coordinates of a shingle are therefore one contiguous slice of one table, which is
what makes the signature cheap: one row copy per shingle and one minimum per text.

Plan. One Python pass per text writes (id, text_key, band keys) to the shared folder. Texts that agree word for word share
text_key and count as one from there on, so a group of copies of any size is one entry per band. Band keys are joined to
themselves; the join is an equi-join on the key, which adaptive execution splits where a key is hot. Pairs that meet in at
least `hits` bands are verified on the texts themselves by exact Jaccard similarity. No link between different texts is
dropped and no bucket is capped. Similarity is computed from the distinct shingle hashes (32 bits each) that the one pass keeps beside the keys, so
texts are read once and never travel with a pair.

Defined results: null texts and texts of fewer than max(min_words, shingle) words take no part (group null in `groups`);
ties and repeated rows are copies; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.words import WordHashes, mix, shingles, text_key, word_hashes
from quern.session import broadcast_if_small, materialize

SLOTS = 1 << 20


@dataclass(frozen=True)
class Bands:
    """rows coordinates per band, bands of them, and in how many bands a pair has to meet."""

    rows: int
    bands: int
    hits: int

    def recall(self, similarity: float) -> float:
        p = similarity**self.rows
        return 1 - sum(comb(self.bands, k) * p**k * (1 - p) ** (self.bands - k) for k in range(self.hits))


def choose_bands(threshold: float, recall: float = 0.9, hits: int = 2, background: float = 0.1) -> Bands:
    """The narrowest key table whose recall AT the threshold reaches `recall` (more similar pairs are found surer), for the
    longest rows of at most 64 bands: longer rows keep texts of background similarity apart."""
    best = None
    for rows in range(2, 17):
        for bands in range(8, 65, 4):
            b = Bands(rows, bands, hits)
            if b.recall(threshold) >= recall:
                best = b
                break
    if best is None:
        raise ValueError("no banding of at most 64 bands reaches this recall")
    return best


def circulant_table(width: int, seed: int = 1) -> np.ndarray:
    """The second permutation, its first `width` entries repeated at the end so that each shift is a plain slice."""
    p = np.random.default_rng(seed).permutation(SLOTS).astype(np.uint32)
    return np.concatenate([p, p[:width]])


def signatures(hashes: list[np.ndarray], table: np.ndarray, width: int, chunk: int = 8192) -> np.ndarray:
    """(texts, width) circulant MinHash coordinates. Every text has at least one shingle."""
    view = np.lib.stride_tricks.sliding_window_view(table, width)
    out = np.full((len(hashes), width), SLOTS, dtype=np.uint32)
    sizes = np.array([len(h) for h in hashes])
    slots = (np.concatenate(hashes) >> np.uint64(44)).astype(np.int64) if len(hashes) else np.empty(0, np.int64)
    own = np.repeat(np.arange(len(hashes)), sizes)
    for a in range(0, len(slots), chunk):
        part, who = view[slots[a : a + chunk]], own[a : a + chunk]
        starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        for s, e in zip(starts, np.r_[starts[1:], len(who)]):
            np.minimum(out[who[s]], part[s:e].min(axis=0), out=out[who[s]])
    return out


def band_keys(sig: np.ndarray, bands: Bands) -> np.ndarray:
    """(texts, bands) signed 64-bit keys; the band number is part of the key."""
    s = sig.reshape(len(sig), bands.bands, bands.rows).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, bands.bands + 1, dtype=np.uint64), s.shape[:2]).copy()
    for k in range(bands.rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + s[:, :, k])
    return h.view(np.int64)


def sketcher(bands: Bands, shingle: int, min_words: int, keys: Callable[[list[np.ndarray]], np.ndarray] | None = None, keep_shingles: bool = False) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The Python pass: (id, text, ...) -> (id, n_words, text_key, keys, ...), with keep_shingles also the sorted distinct shingle hashes as
    bytes. Short and null texts get null keys."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, table = WordHashes(), None
        for p in batches:
            for a in range(0, len(p), 1000):
                part = p.iloc[a : a + 1000]
                words = [word_hashes(t, memo) if isinstance(t, str) else None for t in part["text"]]
                fit = [k for k, w in enumerate(words) if w is not None and len(w) >= max(min_words, shingle)]
                tkey, kk, ss = [None] * len(part), [None] * len(part), [None] * len(part)
                if fit:
                    sets = [shingles(words[k], shingle) for k in fit]
                    if keys is None:
                        if table is None:
                            table = circulant_table(bands.rows * bands.bands)
                        got = band_keys(signatures(sets, table, bands.rows * bands.bands), bands)
                    else:
                        got = keys(sets)
                    for k, row, own in zip(fit, got, sets):
                        tkey[k], kk[k] = text_key(words[k]), row
                        if keep_shingles:
                            ss[k] = np.unique((own >> np.uint64(32)).astype(np.uint32)).tobytes()
                yield pd.DataFrame({
                    "id": part["id"].to_numpy(),
                    "n_words": [0 if w is None else len(w) for w in words],
                    "text_key": pd.array(tkey, dtype="Int64"),
                    "keys": kk,
                    **({"shingles": ss} if keep_shingles else {}),
                    **{c: part[c].to_numpy() for c in part.columns if c not in ("id", "text")},
                })

    return run


SKETCH = "id long, n_words int, text_key long, keys array<long>"
WITH_SHINGLES = SKETCH + ", shingles binary"


def distinct_texts(sketch: DataFrame) -> DataFrame:
    """(text_key, keys), one row per different text. Copies collapse before they move (map-side combine)."""
    return sketch.filter(F.col("text_key").isNotNull()).groupBy("text_key").agg(F.first("keys").alias("keys"))


def meeting_pairs(texts: DataFrame, hits: int) -> DataFrame:
    """(ta, tb), ta < tb: different texts that share at least `hits` keys. texts: (text_key, keys), text_key unique."""
    # Both sides have one plan, so the exchange below is written once and read twice.
    left = texts.select(F.explode("keys").alias("key"), F.col("text_key").alias("ta"))
    right = texts.select(F.explode("keys").alias("key"), F.col("text_key").alias("tb"))
    met = left.join(right, "key").filter(F.col("ta") < F.col("tb"))
    return met.groupBy("ta", "tb").agg(F.count(F.lit(1)).alias("met")).filter(F.col("met") >= hits).select("ta", "tb")


@F.pandas_udf(T.DoubleType())
def jaccard(a: pd.Series, b: pd.Series) -> pd.Series:
    """Of two sets of shingle hashes in bytes."""
    out = []
    for x, y in zip(a, b):
        p, q = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
        common = len(np.intersect1d(p, q, assume_unique=True))
        out.append(common / max(1, len(p) + len(q) - common))
    return pd.Series(out, dtype=float)


def verified(pairs: DataFrame, sketch: DataFrame, threshold: float) -> DataFrame:
    """(ta, tb, similarity) of the pairs of text keys whose texts are at least `threshold` similar. Only shingles of texts in a pair move."""
    pairs = materialize(pairs, "pairs")
    keys = materialize(pairs.select(F.explode(F.array("ta", "tb")).alias("text_key")).distinct(), "chosen")
    # One row stands for each text; its copies collapse before they move.
    sets = sketch.select("text_key", "shingles").join(broadcast_if_small(keys, keys.count(), 48), "text_key", "left_semi").groupBy("text_key").agg(F.first("shingles").alias("x"))
    a, b = sets.select(F.col("text_key").alias("ta"), F.col("x").alias("xa")), sets.select(F.col("text_key").alias("tb"), F.col("x").alias("xb"))
    return pairs.join(a, "ta").join(b, "tb").select("ta", "tb", jaccard("xa", "xb").alias("similarity")).filter(F.col("similarity") >= threshold)


def verified_ids(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(ta, tb) of the pairs of ids whose texts are at least `threshold` similar. sets: (id, shingles), id unique; only those in pairs move."""
    pairs = materialize(pairs, "pairs")
    ids = materialize(pairs.select(F.explode(F.array("ta", "tb")).alias("id")).distinct(), "chosen")
    some = sets.join(broadcast_if_small(ids, ids.count(), 48), "id", "left_semi")
    a, b = some.select(F.col("id").alias("ta"), F.col("shingles").alias("xa")), some.select(F.col("id").alias("tb"), F.col("shingles").alias("xb"))
    return pairs.join(a, "ta").join(b, "tb").filter(jaccard("xa", "xb") >= threshold).select("ta", "tb")


@dataclass
class NearDuplicates:
    """members: (id, text_key); links: (ta, tb, similarity) between different texts."""

    members: DataFrame
    links: DataFrame

    def pairs(self) -> DataFrame:
        """(id_a, id_b), id_a < id_b, copies expanded: as many rows as there are pairs of documents."""
        m = self.members.filter(F.col("text_key").isNotNull())
        a, b = m.select(F.col("text_key").alias("ta"), F.col("id").alias("ia")), m.select(F.col("text_key").alias("tb"), F.col("id").alias("ib"))
        linked = self.links.select("ta", "tb").join(a, "ta").join(b, "tb").select("ia", "ib")
        copies = a.join(b.withColumnRenamed("tb", "ta"), "ta").filter(F.col("ia") < F.col("ib")).select("ia", "ib")
        return linked.unionByName(copies).filter(F.col("ia") != F.col("ib")).select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b")).distinct()

    def groups(self) -> DataFrame:
        """(id, group, links): one row per document; group is the smallest id that its text is linked to over any number of links,
        links the number of different texts that its text is linked to. Null group: the text took no part."""
        m = self.members
        first = m.filter(F.col("text_key").isNotNull()).groupBy("text_key").agg(F.min("id").alias("first"))
        both = self.links.select(F.col("ta").alias("u"), F.col("tb").alias("v")).unionByName(self.links.select(F.col("tb").alias("u"), F.col("ta").alias("v")))
        degree = both.groupBy("u").agg(F.count(F.lit(1)).alias("links"))
        labels = components(both, first.withColumnRenamed("text_key", "u").withColumnRenamed("first", "label"))
        per_text = labels.join(degree, "u", "left").select(F.col("u").alias("text_key"), F.col("label").alias("group"), F.coalesce("links", F.lit(0)).alias("links"))
        return m.select("id", "text_key").join(per_text, "text_key", "left").select("id", "group", F.coalesce("links", F.lit(0)).alias("links"))


def components(edges: DataFrame, labels: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components by hooking and pointer jumping: (u, label), label the smallest label of the component.

    edges (u, v) hold both directions; labels (u, label) are unique. Where an edge joins two labels, the text that owns the larger one takes
    on the smaller; then every text follows its label's owner. Long chains take a logarithmic number of rounds. State lives in tables of
    the shared folder; only whether a label changed comes to the driver.
    """
    touched = edges.select("u").distinct()
    alone = labels.join(touched, "u", "left_anti")
    edges = materialize(edges, "edges")
    state = materialize(labels.join(touched, "u", "left_semi").select("u", "label", F.col("label").alias("own")), "labels")
    for _ in range(most_rounds):
        at = edges.join(state.select("u", F.col("label").alias("lu")), "u").join(state.select(F.col("u").alias("v"), F.col("label").alias("lv")), "v")
        hook = at.filter(F.col("lv") < F.col("lu")).groupBy(F.col("lu").alias("own")).agg(F.min("lv").alias("less"))
        hooked = materialize(state.join(hook, "own", "left").select("u", "own", F.col("label").alias("old"), F.least("label", F.coalesce("less", "label")).alias("label")), "hooked")
        owner = hooked.select(F.col("own").alias("label"), F.col("label").alias("further"))
        new = materialize(hooked.join(owner, "label", "left").select("u", "own", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        if new.filter(F.col("label") < F.col("old")).limit(1).count() == 0:
            return alone.select("u", "label").unionByName(new.select("u", "label"))
        state = new.drop("old")
    raise RuntimeError("components did not settle")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "document_id",
    text_col: str = "body",
    threshold: float = 0.8,
    shingle: int = 5,
    min_words: int = 5,
    bands: Bands | None = None,
) -> NearDuplicates:
    """Links between different texts of at least `threshold` Jaccard similarity over runs of `shingle` words."""
    bands = bands or choose_bands(threshold)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketch = materialize(texts.mapInPandas(sketcher(bands, shingle, min_words, keep_shingles=True), WITH_SHINGLES), "sketch")
    links = materialize(verified(meeting_pairs(distinct_texts(sketch), bands.hits), sketch, threshold), "links")
    return NearDuplicates(sketch.select("id", "text_key"), links)


#: Bands in which a text is first held against the smallest text of its bucket only.
STAR_BANDS = 8


def near_duplicate_groups(
    docs: DataFrame,
    id_col: str = "document_id",
    text_col: str = "body",
    threshold: float = 0.8,
    shingle: int = 5,
    min_words: int = 5,
    bands: Bands | None = None,
) -> DataFrame:
    """(id, group): the groups of NearDuplicates.groups() without forming every link, for where only the groups are wanted.

    First every text meets the smallest text of its buckets in a few bands, one candidate a bucket; the verified links give first groups.
    After that only texts of different first groups have to meet: buckets that one group fills are passed over, and in the others groups
    are paired before their members. A family of m edited copies costs about m links, not m * m.
    """
    bands = bands or choose_bands(threshold)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketch = materialize(texts.mapInPandas(sketcher(bands, shingle, min_words, keep_shingles=True), WITH_SHINGLES), "sketch")
    reps = materialize(sketch.filter(F.col("text_key").isNotNull()).groupBy("text_key").agg(F.min("id").alias("id")), "reps")
    n_reps = reps.count()
    own = lambda column: sketch.select("id", "text_key", column).join(broadcast_if_small(reps, n_reps, 100), ["id", "text_key"]).select("id", column).dropDuplicates(["id"])
    keys, sets = own("keys"), own("shingles")

    some = keys.select(F.explode(F.slice("keys", 1, STAR_BANDS)).alias("key"), "id")
    heads = some.groupBy("key").agg(F.min("id").alias("ta"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "ta")
    star = some.join(heads, "key").filter(F.col("id") != F.col("ta")).select("ta", F.col("id").alias("tb")).distinct()
    first = materialize(verified_ids(star, sets, threshold), "links")

    nodes = reps.select(F.col("id").alias("u"), F.col("id").alias("label"))
    both = lambda e: e.select(F.col("ta").alias("u"), F.col("tb").alias("v")).unionByName(e.select(F.col("tb").alias("u"), F.col("ta").alias("v")))
    group = materialize(components(both(first), nodes).select(F.col("u").alias("id"), F.col("label").alias("g")), "groups")

    entries = materialize(keys.join(group, "id").select(F.explode("keys").alias("key"), "id", "g"), "entries")
    open_ = entries.groupBy("key").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).filter("lo < hi").select("key")
    live = materialize(entries.join(open_, "key", "left_semi"), "entries")
    present = live.select("key", "g").distinct()
    meet = present.withColumnRenamed("g", "ga").join(present.withColumnRenamed("g", "gb"), "key").filter(F.col("ga") < F.col("gb"))
    a, b = live.select("key", F.col("g").alias("ga"), F.col("id").alias("ta")), live.select("key", F.col("g").alias("gb"), F.col("id").alias("tb"))
    met = meet.join(a, ["key", "ga"]).join(b, ["key", "gb"]).groupBy("ta", "tb").agg(F.count(F.lit(1)).alias("met")).filter(F.col("met") >= bands.hits).select("ta", "tb")
    links = first.unionByName(verified_ids(met, sets, threshold))
    final = components(both(links), nodes).select(F.col("u").alias("rep"), F.col("label").alias("group"))
    per_text = reps.select("text_key", F.col("id").alias("rep")).join(final, "rep").select("text_key", "group")
    return sketch.select("id", "text_key").join(per_text, "text_key", "left").select("id", "group")


#: Edited copies at 0.75 similarity share one of these keys surely enough (0.99), texts that have a fifth of their shingles in common seldom (0.06).
FAMILY_BANDS = Bands(3, 8, 1)


def families(docs: DataFrame, id_col: str = "document_id", text_col: str = "body", min_words: int = 20) -> DataFrame:
    """(id, family), one row per id: a cheap label that edited copies of a text mostly share; null for shorter texts.

    Of its band keys a text takes the one that most different texts have. However many copies a text has, they scatter over no more labels than
    there are bands, plus the few that share no key with the others. Nothing is paired or verified: labels say how many independent
    witnesses there are, they do not say what is a duplicate (near_duplicate_groups does).
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketch = materialize(texts.mapInPandas(sketcher(FAMILY_BANDS, 3, min_words), SKETCH), "sketch")
    keys = distinct_texts(sketch).select("text_key", F.explode("keys").alias("key"))
    many = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    label = keys.join(many, "key").groupBy("text_key").agg(F.max(F.struct("n", "key")).alias("m")).select("text_key", F.col("m.key").alias("label"))
    found = sketch.select("id", "text_key").join(label, "text_key", "left")
    return materialize(found.groupBy("id").agg(F.min(F.coalesce("label", "text_key")).alias("family")), "families")
