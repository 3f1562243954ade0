"""Deduplication: exact by key, near by SimHash distance, and the greedy keep-first rule."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import materialize


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of least `order` for each combination of keys; rows with a null key all stay.

    An aggregate, not a window: a key that holds a third of all rows is reduced on the map side.
    """
    whole = F.struct(*[F.col(c) for c in df.columns])
    some = reduce_and([F.col(k).isNotNull() for k in keys])
    first = df.filter(some).groupBy(*keys).agg(F.min_by(whole, F.col(order)).alias("__row")).select("__row.*")
    return first.unionByName(df.filter(~some))


def reduce_and(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def block_keys(value: Column, distance: int = 4, blocks: int = 6) -> Column:
    """Keys such that any two 64-bit values within `distance` bits share one.

    The bits are cut into `blocks` blocks; at most `distance` of them differ, so some blocks - distance of them agree. Each choice of
    that many blocks is a key. More blocks give more and longer keys: choose more for more values.
    """
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part = [F.shiftrightunsigned(value, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]
    return F.array(*[F.xxhash64(F.lit(i), *[part[k] for k in pick]) for i, pick in enumerate(combinations(range(blocks), blocks - distance))])


def simhash_pairs(hashes: DataFrame, col: str = "simhash", distance: int = 4, blocks: int = 6) -> DataFrame:
    """(a, b, distance), a < b, over the different non-zero values of `col`; exact. Zero means not computed and pairs with nothing."""
    values = hashes.select(F.col(col).alias("v")).filter(F.col("v").isNotNull() & (F.col("v") != 0)).distinct()
    a = values.select(F.explode(block_keys(F.col("v"), distance, blocks)).alias("key"), F.col("v").alias("a"))
    b = values.select(F.explode(block_keys(F.col("v"), distance, blocks)).alias("key"), F.col("v").alias("b"))
    near = a.join(b, "key").filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
    return near.select("a", "b", F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).cast("int").alias("distance")).distinct()


def greedy_keep(nodes: DataFrame, pairs: DataFrame, most_rounds: int = 1000) -> DataFrame:
    """(node, kept): in ascending order, a node is kept unless a smaller kept node is its neighbour.

    Decided in rounds over the whole graph: a node whose smaller neighbours are all dropped is kept, one with a smaller kept neighbour is
    dropped. Only the number of undecided nodes comes to the driver. pairs: (a, b) with a < b.
    """
    edges = materialize(pairs.select("a", "b"), "edges")
    state = materialize(nodes.select("node", F.lit(None).cast("boolean").alias("kept")), "greedy")
    for _ in range(most_rounds):
        smaller = edges.join(state.select(F.col("node").alias("a"), F.col("kept").alias("ka")), "a").groupBy(F.col("b").alias("node")).agg(F.max(F.coalesce("ka", F.lit(False))).alias("some"), F.max(F.col("ka").isNull()).alias("open"))
        step = state.join(smaller, "node", "left")
        new = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.col("some").isNull(), F.lit(True)).when(F.col("some"), F.lit(False)).when(~F.col("open"), F.lit(True))
        state = materialize(step.select("node", new.alias("kept")), "greedy")
        if state.filter(F.col("kept").isNull()).limit(1).count() == 0:
            return state
    raise RuntimeError("the greedy rule did not settle")


def intake_outcomes(docs: DataFrame, floor: float = 1e-9, scored_platforms: tuple[str, ...] = ("news",)) -> DataFrame:
    """(document_id, outcome), one row a row of docs: empty, irrelevant, duplicate or new. First arrivals win, by uid and then by content hash.

    Texts are looked at once, for whether there are any; only ids and keys are exchanged.
    """
    irrelevant = F.col("source_platform").isin(*scored_platforms) & (F.coalesce(F.col("relevance_score"), F.lit(0)) <= floor)
    why = F.when(F.trim(F.concat_ws(" ", "title", "body")) == "", "empty").when(irrelevant, "irrelevant")
    rows = docs.select("document_id", "doc_uid", F.lower("content_hash").alias("h"), why.alias("why"))
    uid = rows.filter(F.col("why").isNull()).groupBy("doc_uid").agg(F.min("document_id").alias("u"))
    rows = rows.join(uid, "doc_uid", "left")
    first = rows.filter(F.col("why").isNull() & (F.col("document_id") == F.col("u"))).groupBy("h").agg(F.min("document_id").alias("c"))
    new = (F.col("document_id") == F.col("u")) & (F.col("h").isNull() | (F.col("document_id") == F.col("c")))
    return rows.join(first, "h", "left").select("document_id", F.coalesce("why", F.when(F.coalesce(new, F.lit(True)), "new").otherwise("duplicate")).alias("outcome"))


def intake(docs: DataFrame, floor: float = 1e-9, scored_platforms: tuple[str, ...] = ("news",)) -> DataFrame:
    """docs with `outcome`; document_id is unique in docs."""
    return docs.drop("outcome").join(intake_outcomes(docs, floor, scored_platforms), "document_id", "left")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """(outcome, n): what an intake reports."""
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
