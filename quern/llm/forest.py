"""Each new batch checked against all history through a prefix-tree hash forest.

A text has one MinHash signature. Tree t orders the texts by the signature read from coordinate t * STRIDE on, wrapped around (a permutation of its
coordinates), DEPTH coordinates of one byte each; with the tree's number above them they make one 64-bit key, so all trees together are one sorted
run, and texts that share the first d coordinates in a tree are neighbours within one range of it.

`Forest` keeps its runs in a folder: rows (what a batch brought: keys of uid, hash and text, the text's distinct shingle hashes), trees and exact (sorted runs
of keys), each with the bounds of its files. `add` takes a batch through these steps:

1. The batch is sketched, once. Uids, hashes and texts that were seen on an earlier day are found by range search in the exact runs; only texts that
   are new go on, one row for all copies of a text, so that copies never enter the trees twice.
2. Their keys become a new sorted run, cut into files of about FILE_ENTRIES whatever the run's size.
3. The new run's entries look up their ranges in all runs, their own included, by binary search. A task opens only files whose bounds meet its entries: the
   rows read are bounded by the batch's entries times FILE_ENTRIES, however long the history is.
4. Prefixes are widened step by step. A deep prefix in some of the trees comes first, where each entry meets only the earliest text of its range; what is verified there is
   settled, so a family of edited copies that holds a third of all rows costs about one candidate an entry. What is left is widened to the
   prefix that reaches the recall target and meets everything in its ranges; candidates are those met in at least `hits` trees.
5. Candidates are verified by exact Jaccard similarity of the shingle hashes kept in rows (32 bits each); only row files whose bounds hold a candidate are read.

`merge` rewrites the sorted runs as one; `add` does so when there are more than MOST_RUNS. `replay` takes a whole table through a new forest in
batches of whole days.

Defined results: rows without id or day take no part; a row without text, or with fewer than min_words words, can only match by uid; null and blank uids
and hashes match nothing; rows of one day do not match each other; rows that share an id are found together; an empty batch or an empty history gives no rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.neardup import circulant_table, jaccard, signatures, sketcher
from quern.session import broadcast_if_small, materialize, shared_dir

TREES, STRIDE, DEPTH = 64, 4, 6
STAR_TREES, STAR_DEPTH = 16, 5
FILE_ENTRIES = 1 << 19
MOST_RUNS = 8


def recall(similarity: float, depth: int, hits: int) -> float:
    """Chance that texts of this similarity share a prefix of `depth` coordinates in at least `hits` trees."""
    p = similarity**depth
    return 1 - sum(comb(TREES, k) * p**k * (1 - p) ** (TREES - k) for k in range(hits))


def widened_depth(threshold: float, target: float, hits: int) -> int:
    """The longest prefix that reaches the target: prefixes are widened from the full key on."""
    depth = DEPTH
    while depth > 1 and recall(threshold, depth, hits) < target:
        depth -= 1
    return depth


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    return circulant_table(TREES * STRIDE, seed=7)


def full_keys(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, trees) keys: the tree's number, then six coordinates, the first in the highest byte."""
    sig = signatures(sets, _table(), TREES * STRIDE).astype(np.uint64) & np.uint64(0xFF)
    out = np.broadcast_to(np.arange(TREES, dtype=np.uint64), (len(sets), TREES)).copy()
    for d in range(DEPTH):
        out = (out << np.uint64(8)) | sig[:, (np.arange(TREES) * STRIDE + d) % (TREES * STRIDE)]
    return out.view(np.int64)


_ROW = "id long, day int, n_words int, text_key long, uid_key long, uid_check long, hash_key long, hash_check long, keys binary, shingles binary"


def _sketch(shingle: int, min_words: int):
    """One pass over the texts: keys of all trees, as bytes, and the sorted distinct shingle hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in sketcher(None, shingle, min_words, full_keys, keep_shingles=True)(batches):
            p["keys"] = [None if k is None else k.tobytes() for k in p["keys"]]
            yield p[[c.split()[0] for c in _ROW.split(", ")]]

    return run


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in batches:
        if len(p):
            yield pd.DataFrame({"key": np.frombuffer(b"".join(p["keys"]), dtype=np.int64), "id": np.repeat(p["id"].to_numpy(), TREES), "day": np.repeat(p["day"].to_numpy(), TREES)})


def _open(path: str, columns: list[str]) -> pd.DataFrame:
    """One Parquet file of the shared folder, read where the task runs."""
    from pyarrow import fs, parquet

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        system, at = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        system, at = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    with system.open_input_file(at) as f:
        return parquet.ParquetFile(f).read(columns=columns).to_pandas()


def _meetings(lo: np.ndarray, hi: np.ndarray, bounds: pd.DataFrame) -> Iterator[tuple[str, int, int]]:
    """(file, first, last) of the entries, sorted by their ranges [lo, hi], whose ranges meet the file's bounds."""
    for name, a, b in bounds.itertuples(index=False):
        first, last = int(np.searchsorted(hi, a, "left")), int(np.searchsorted(lo, b, "right"))
        if first < last:
            yield name, first, last


def _range_search(bounds: pd.DataFrame, shift: int, star: bool, read, most: int = 500_000):
    """Pairs (ta, tb): tb an entry, ta of an earlier day in its range; with `star` only the earliest of the range. The pairs of one range leave in pieces."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: dict[str, tuple[np.ndarray, ...]] = {}
        for p in batches:
            p = p.sort_values("key", kind="stable")
            key, own, day = p["key"].to_numpy(), p["id"].to_numpy(), p["day"].to_numpy()
            lo = (key >> shift) << shift
            hi = lo | ((1 << shift) - 1)
            for name, first, last in _meetings(lo, hi, bounds):
                if name not in opened:
                    opened.clear()  # entries come sorted, so files follow one another
                    t = _open(name, ["key", "id", "day"])
                    opened[name] = tuple(t[c].to_numpy() for c in ("key", "id", "day"))
                    read.add(len(t))
                keys, ids, days = opened[name]
                a, b = np.searchsorted(keys, lo[first:last], "left"), np.searchsorted(keys, hi[first:last], "right")
                some = np.flatnonzero(b > a)
                if not len(some):
                    continue
                a, b, who, when = a[some], b[some], own[first:last][some], day[first:last][some]
                if star:
                    starts, at = np.unique(a, return_inverse=True)
                    ends = np.zeros(len(starts), dtype=np.int64)
                    ends[at] = b
                    # The ranges are disjoint, but there may be gaps between them: every second piece is a range.
                    cuts = np.column_stack([starts, ends]).ravel()
                    pad = lambda x, top: np.r_[x, top]
                    least = np.minimum.reduceat(pad(days, np.iinfo(days.dtype).max), cuts)[::2]
                    owner = np.repeat(np.arange(len(starts)), ends - starts)
                    inside = np.repeat(starts - np.r_[0, np.cumsum(ends - starts)[:-1]], ends - starts) + np.arange(len(owner))
                    hit = days[inside] == least[owner]
                    best = np.full(len(starts), np.iinfo(np.int64).max)
                    np.minimum.at(best, owner[hit], ids[inside[hit]])
                    earlier = least[at] < when
                    yield pd.DataFrame({"ta": best[at][earlier], "tb": who[earlier]})
                    continue
                n = b - a
                total = np.cumsum(n)
                at = 0
                while at < len(n):
                    to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
                    for s in range(0, int(n[at]) if to == at + 1 else 1, most):  # one range may hold more than `most` by itself
                        m = np.minimum(n[at:to] - s, most) if to == at + 1 else n[at:to]
                        rows = np.repeat(a[at:to] + s - np.r_[0, np.cumsum(m)[:-1]], m) + np.arange(int(m.sum()))
                        mine = np.repeat(np.arange(at, to), m)
                        earlier = days[rows] < when[mine]
                        yield pd.DataFrame({"ta": ids[rows[earlier]], "tb": who[mine[earlier]]})
                    at = to

    return run


def _exact_search(bounds: pd.DataFrame, read):
    """(key, check, day) of the entries that stand in a file, with the day they have there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            p = p.sort_values("key", kind="stable")
            key = p["key"].to_numpy()
            for name, first, last in _meetings(key, key, bounds):
                t = _open(name, ["key", "check", "day"])
                read.add(len(t))
                found = p.iloc[first:last][["key", "check"]].drop_duplicates().merge(t, on=["key", "check"])
                yield found[["key", "check", "day"]]

    return run


class Forest:
    """A forest kept in `path`: rows/RUN, trees/RUN (key, id, day) and exact/RUN (key, check, day), the latter two sorted by key.

    The newest manifest names the live runs; a run counts from the moment a manifest with it appears, so a broken write leaves none.
    `entries_read` counts the stored entries that searches have read.
    """

    def __init__(self, spark: SparkSession, path: str, threshold: float = 0.8, shingle: int = 5, min_words: int = 50, target: float = 0.9, hits: int = 2, file_entries: int = FILE_ENTRIES):
        self.spark, self.path = spark, path.rstrip("/")
        self.threshold, self.shingle, self.min_words, self.target, self.hits, self.file_entries = threshold, shingle, min_words, target, hits, file_entries
        self.depth = widened_depth(threshold, target, hits)
        self.entries_read = spark.sparkContext.accumulator(0)

    def _fs(self, name: str = ""):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest{name and '/' + name}")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def runs(self) -> dict[str, list[str]]:
        """The live runs by kind, from the manifest of the highest number."""
        fs, at = self._fs()
        names = sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []
        names = [n for n in names if n.endswith(".json") and not n.startswith((".", "_"))]
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.path}/manifest/{names[-1]}").collect())) if names else {"rows": [], "trees": [], "exact": []}

    def _set_runs(self, runs: dict[str, list[str]]) -> None:
        """A new manifest appears whole, by a rename, under a higher number; older ones stay readable until then."""
        number = f"{time.time_ns():020d}"
        fs, new = self._fs(f"_{number}.tmp")
        out = fs.create(new, True)
        out.write(bytearray(json.dumps(runs).encode()))
        out.close()
        fs.rename(new, self._fs(f"{number}.json")[1])

    def _write_run(self, kind: str, run: str, df: DataFrame, entries: int) -> DataFrame:
        """A sorted run in files of about file_entries. Equal keys may fill several files, so a hot one is no hot task."""
        files = max(1, -(-entries // self.file_entries))
        by = ["key", df.columns[1]]
        ranged = df.repartitionByRange(files, *by) if files > 1 else df.coalesce(1)
        ranged.sortWithinPartitions(*by).write.parquet(f"{self.path}/{kind}/{run}")
        return self._write_bounds(kind, run, "key")

    def _write_bounds(self, kind: str, run: str, column: str) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.path}/{kind}/{run}")
        found = stored.groupBy(F.input_file_name().alias("file")).agg(F.min(column).alias("lo"), F.max(column).alias("hi")).filter(F.col("lo").isNotNull())
        found.coalesce(1).write.parquet(f"{self.path}/bounds-{kind}/{run}")
        return stored

    def _bounds(self, kind: str, runs: list[str]) -> pd.DataFrame:
        """(file, lo, hi): one row for each file of about file_entries, so a thousandth of a percent of the forest."""
        if not runs:
            return pd.DataFrame({"file": pd.Series(dtype=str), "lo": pd.Series(dtype="int64"), "hi": pd.Series(dtype="int64")})
        rows = self.spark.read.parquet(*[f"{self.path}/bounds-{kind}/{r}" for r in runs]).collect()
        return pd.DataFrame([(r.file, r.lo, r.hi) for r in rows], columns=["file", "lo", "hi"]).sort_values("lo")

    def merge(self) -> None:
        """All sorted runs rewritten as one; rows stay where they are."""
        runs = self.runs()
        new = f"{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
        for kind in ("trees", "exact"):
            if len(runs[kind]) > 1:
                old = self.spark.read.parquet(*[f"{self.path}/{kind}/{r}" for r in runs[kind]])
                self._write_run(kind, new, old, old.count())
                runs[kind] = [new]
        self._set_runs(runs)

    def _similar(self, trees: DataFrame, n: int, runs: dict[str, list[str]]) -> DataFrame:
        """(id,) of the new texts that some text of an earlier day is similar to."""
        bounds = self._bounds("trees", runs["trees"])

        def pairs(entries: DataFrame, depth: int, star: bool) -> DataFrame:
            return entries.mapInPandas(_range_search(bounds, 8 * (DEPTH - depth), star, self.entries_read), "ta long, tb long")

        # The run is sorted by tree, so the other trees' row groups are not even read.
        some = trees.filter(F.col("key") < (STAR_TREES << (8 * DEPTH)))
        deep = pairs(some, max(self.depth, STAR_DEPTH), True).distinct()
        settled = materialize(self._verified(deep, runs["rows"]), "settled")
        n_settled = settled.count()
        left = trees.join(broadcast_if_small(settled.withColumnRenamed("tb", "id"), n_settled, 48), "id", "left_anti").select("key", "id", "day")
        met = pairs(left, self.depth, False).groupBy("ta", "tb").agg(F.count(F.lit(1)).alias("met")).filter(F.col("met") >= self.hits).select("ta", "tb")
        return settled.unionByName(self._verified(met, runs["rows"])).select(F.col("tb").alias("id"))

    def _verified(self, pairs: DataFrame, rows: list[str]) -> DataFrame:
        """(tb,) of the pairs that are similar enough; reads the shingles of row files that hold a candidate."""
        pairs = materialize(pairs, "pairs")
        asked = materialize(pairs.select(F.explode(F.array("ta", "tb")).alias("id")).distinct(), "chosen")
        n = asked.count()
        bounds = self._bounds("rows", rows)
        files = self.spark.createDataFrame(bounds, "file string, lo long, hi long")
        # Candidates are counted against the bounds of every file (a stated set against blocks), the files that hold none are not read.
        held = [r.file for r in files.join(asked, F.col("id").between(F.col("lo"), F.col("hi")), "left_semi").collect()] if len(bounds) > 64 else list(bounds["file"])
        if not held:
            return pairs.select("tb").limit(0)
        # The paths come from the file system, so they are escaped; the reader wants them plain.
        plain = [self.spark._jvm.java.net.URI(f).getPath() if f.startswith("file:") else f for f in held]
        sets = self.spark.read.parquet(*plain).filter(F.col("shingles").isNotNull()).select("id", "shingles").join(broadcast_if_small(asked, n, 48), "id")
        a, b = sets.select(F.col("id").alias("ta"), F.col("shingles").alias("xa")), sets.select(F.col("id").alias("tb"), F.col("shingles").alias("xb"))
        return pairs.join(a, "ta").join(b, "tb").filter(jaccard("xa", "xb") >= self.threshold).select("tb").distinct()

    def _exact_keys(self, rows: DataFrame) -> DataFrame:
        """(id, day, key, check) of what a row may be known by."""

        def known(kind: int, key: str, check: Column) -> Column:
            return F.when(F.col(key).isNotNull(), F.struct(F.xxhash64(F.lit(kind), F.col(key)).alias("key"), check.alias("check")))

        kinds = F.array(known(0, "uid_key", F.col("uid_check")), known(1, "hash_key", F.col("hash_check")), known(2, "text_key", F.col("n_words").cast("long")))
        return rows.select("id", "day", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("k")).select("id", "day", "k.key", "k.check")

    def add(self, batch: DataFrame) -> DataFrame:
        """(id,) of the batch's rows that repeat a row of an earlier day, kept or in the batch itself; the batch is kept. batch: (id, day, uid, hash, text)."""
        runs, run = self.runs(), f"{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
        uid, hash_, plain = F.col("uid"), F.lower("hash"), lambda c: F.trim(c) != ""
        base = batch.filter(F.col("id").isNotNull() & F.col("day").isNotNull()).select(
            "id", "day", "text", F.when(plain(uid), F.xxhash64(uid)).alias("uid_key"), F.when(plain(uid), F.xxhash64(F.lit("uid"), uid)).alias("uid_check"),
            F.when(plain(hash_), F.xxhash64(hash_)).alias("hash_key"), F.when(plain(hash_), F.xxhash64(F.lit("hash"), hash_)).alias("hash_check"),
        )
        sketched = base.mapInPandas(_sketch(self.shingle, self.min_words), _ROW)
        long_text = F.col("n_words") >= self.min_words
        sketched.withColumn("hash_key", F.when(long_text, F.col("hash_key"))).write.parquet(f"{self.path}/rows/{run}")
        rows = self._write_bounds("rows", run, "id")

        # What was known before this batch, and since which day.
        exact = self._exact_keys(rows)
        first = exact.groupBy("key", "check").agg(F.min("day").alias("day"))
        n_rows = rows.count()
        own = self._write_run("exact", run, first, 3 * n_rows)
        before = self._bounds("exact", runs["exact"])
        seen = materialize(own.mapInPandas(_exact_search(before, self.entries_read), "key long, check long, day int"), "seen") if len(before) else own.limit(0)
        since = own.unionByName(seen).groupBy("key", "check").agg(F.min("day").alias("since"))
        repeats = exact.join(since, ["key", "check"]).filter(F.col("since") < F.col("day")).select("id")

        # One row stands for all copies of a text that is new.
        text = (F.xxhash64(F.lit(2), F.col("text_key"))).alias("key")
        reps = rows.filter(F.col("keys").isNotNull()).groupBy("text_key").agg(F.min(F.struct("day", "id")).alias("f"), F.first(text).alias("key")).join(seen.select("key").distinct(), "key", "left_anti").select("text_key", F.col("f.id").alias("id"), F.col("f.day").alias("day"))
        reps = materialize(reps, "texts")
        n = reps.count()
        chosen = rows.select("id", "day", "text_key", "keys").join(broadcast_if_small(reps, n, 100), ["id", "day", "text_key"]).select("id", "day", "keys").dropDuplicates(["id", "keys"])
        trees = self._write_run("trees", run, chosen.mapInPandas(_entries, "key long, id long, day int"), n * TREES)
        live = {"rows": [*runs["rows"], run], "trees": [*runs["trees"], run], "exact": [*runs["exact"], run]}
        similar = self._similar(trees, n, live)
        same_text = rows.select("id", "text_key").join(reps.join(similar, "id", "left_semi").select("text_key"), "text_key", "left_semi").select("id")
        found = materialize(repeats.unionByName(same_text).distinct(), "repeats")
        self._set_runs(live)
        if len(live["trees"]) > MOST_RUNS:
            self.merge()
        return found


def batches_of_days(days: DataFrame, n: int) -> list[tuple[int, int]]:
    """At most n spans (first, last) of whole days with about equal numbers of rows. days: (day,) one row a row; one count a day comes to the driver."""
    counts = sorted((r.day, r["count"]) for r in days.groupBy("day").count().collect())
    total, out, size = sum(c for _, c in counts), [], 0
    for day, c in counts:
        if not out or (size >= total / n * len(out) and len(out) < n):
            out.append((day, day))
        size += c
        out[-1] = (out[-1][0], day)
    return out


def replay(
    docs: DataFrame,
    id_col: str = "document_id",
    uid_col: str = "doc_uid",
    hash_col: str = "content_hash",
    text_col: str = "body",
    arrival_col: str = "ingested_at",
    threshold: float = 0.8,
    shingle: int = 5,
    min_words: int = 50,
    target: float = 0.9,
    hits: int = 2,
    batches: int = 2,
) -> DataFrame:
    """(id,) of the rows that repeat something of an earlier day: same uid, same hash in any letter case, or a similar text.

    The table goes through a new forest in `batches` spans of whole days, as a history is caught up with; any number gives the same rows. With one
    batch a day this is the daily check itself."""
    base = docs.select(
        F.col(id_col).alias("id"), F.floor(F.unix_micros(F.col(arrival_col)) / 86_400_000_000).cast("int").alias("day"), F.col(uid_col).alias("uid"), F.col(hash_col).alias("hash"), F.col(text_col).alias("text"),
    )
    spark = docs.sparkSession
    kept = Forest(spark, f"{shared_dir(spark)}/quern-forest-{uuid.uuid4().hex}", threshold, shingle, min_words, target, hits)
    out = None
    for first, last in batches_of_days(base.filter(F.col("id").isNotNull() & F.col("day").isNotNull()).select("day"), batches):
        found = kept.add(base.filter(F.col("day").between(first, last)))
        out = found if out is None else out.unionByName(found)
    out = base.select("id").limit(0) if out is None else out
    return out.distinct().select(F.col("id").alias(id_col))
