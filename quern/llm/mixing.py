"""Sources mixed to target weights by hierarchical budgeting over a domain - language - source tree.

Weights are propagated down the tree. A leaf can give at most its tokens times its cap of repeats; what it can't give goes to its
siblings in proportion to their weights, then to the siblings of its parent, and so on up. Each leaf's share of the budget is then
drawn as a prefix of its documents in seeded order: whole epochs first, then the part of the last epoch that fits.

Prefixes need running sums over a leaf of any size, so they are taken in two steps: documents fall into buckets of their seeded
hash, the running sum over bucket totals is small, and only the documents of one bucket are ordered in one task. The number of
buckets follows the number of documents, so a source that holds a third of all rows is spread like the rest.

Defined results: a target without documents gets nothing and its weight is redistributed; a source without a target is not drawn; null and
blank texts have no tokens and are not drawn; negative or null shares count as zero, null caps as one; repeated rows are separate documents;
an empty corpus gives an empty draw and a report of zeros. Targets are a stated plan of one row a source and are read on the driver.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.session import broadcast_if_small, materialize

DOCS_PER_BUCKET = 20_000


@dataclass
class Node:
    """A node of the tree: a weight among its siblings, and either children or a leaf's capacity in tokens."""

    name: str
    weight: float
    capacity: float = 0.0
    children: list[Node] | None = None

    def most(self) -> float:
        return self.capacity if self.children is None else sum(c.most() for c in self.children)


def fill(budget: float, nodes: list[Node]) -> list[float]:
    """What each sibling takes of a budget: by weight, never more than it can give, shortages going to the others by weight."""
    got, left = [0.0] * len(nodes), budget
    open_ = [i for i, n in enumerate(nodes) if n.weight > 0 and n.most() > 0]
    while open_ and left > 1e-9:
        total = sum(nodes[i].weight for i in open_)
        full = [i for i in open_ if got[i] + left * nodes[i].weight / total >= nodes[i].most() - 1e-9]
        if not full:
            for i in open_:
                got[i] += left * nodes[i].weight / total
            return got
        for i in full:
            left -= nodes[i].most() - got[i]
            got[i] = nodes[i].most()
        open_ = [i for i in open_ if i not in full]
    return got


def allocate(budget: float, root: Node) -> dict[str, float]:
    """Tokens for each leaf by name: a node first fills its children, and what they can't take was never given to it."""
    if root.children is None:
        return {root.name: min(budget, root.capacity)}
    out: dict[str, float] = {}
    for child, share in zip(root.children, fill(min(budget, root.most()), root.children)):
        out |= allocate(share, child)
    return out


def tree(leaves: list[tuple[str, str, str, float, float]]) -> Node:
    """leaves: (domain, language, source, weight, capacity). Weights of inner nodes are the sums of their leaves' weights."""
    root = Node("", 0.0, children=[])
    for domain, language, source, weight, capacity in sorted(leaves):
        at = root
        for key in (domain, f"{domain}/{language}"):
            at.weight += weight
            child = next((c for c in at.children if c.name == key), None)
            if child is None:
                child = Node(key, 0.0, children=[])
                at.children.append(child)
            at = child
        at.weight += weight
        at.children.append(Node(source, weight, capacity))
    return root


def largest_exact_total(leaves: list[tuple[str, str, str, float, float]]) -> float:
    """The largest total at which no leaf that has documents falls short of its share (shares of empty leaves redistributed)."""
    able = [x for x in leaves if x[3] > 0 and x[4] > 0]
    if not able:
        return 0.0
    # Shares scale with the total until a leaf is full, so one trial budget gives every leaf's final share.
    trial = allocate(min(x[4] for x in able) * 1e-3, tree(leaves))
    whole = sum(trial.values())
    return min(x[4] / (trial[x[2]] / whole) for x in able)


def token_counter(vocabulary: str, pattern: str | None = None):
    """A pandas function text -> tokens. vocabulary: path of a .tiktoken rank file or of a tokenizers .json file, readable by every executor."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if vocabulary.endswith(".tiktoken"):
            import tiktoken

            with open(vocabulary, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            split = pattern or r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
            count = lambda texts, e=tiktoken.Encoding("own", pat_str=split, mergeable_ranks=ranks, special_tokens={}): [len(e.encode_ordinary(t)) for t in texts]
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(vocabulary)
            tok.encode_special_tokens = True
            count = lambda texts: [len(x.ids) for x in tok.encode_batch(texts, add_special_tokens=False)]
        for s in batches:
            yield pd.Series(count([t if isinstance(t, str) else "" for t in s]), index=s.index, dtype="int64")

    return run


def counted(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc, source, tokens), written once to the shared folder: the texts are read and tokenised a single time."""
    tokens = F.pandas_udf(token_counter(vocabulary), "long")
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(source_col).alias("source"), tokens(F.col(text_col)).alias("tokens"))
    return materialize(rows.filter((F.col("tokens") > 0) & F.col("source").isNotNull()), "tokens")


@dataclass
class Mix:
    draw: DataFrame  # doc, source, epochs (how often it is taken), tokens (of one taking)
    report: DataFrame  # source, target_share, available_tokens, budget_tokens, drawn_tokens, actual_share, repeats


def mix_sources(tokens: DataFrame, targets: DataFrame, places: DataFrame, total_tokens: float | None = None, seed: int = 1) -> Mix:
    """tokens: from counted(). targets: (source, target_share, max_repeats). places: (source, domain, language) for the tree.

    total_tokens None takes the largest total at which every source that has documents reaches its share. A larger total makes
    short sources give all they may and hands their shortage on. The targets are a list that someone writes: it, and one row of sums for each source
    in it, are held on the driver, about 200 bytes a source. Sources without a target never come there.
    """
    spark = tokens.sparkSession
    available = {r.source: (r.t, r.n) for r in tokens.join(targets.select("source").distinct(), "source", "left_semi").groupBy("source").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    where = {r.source: (r.domain or "", r.language or "") for r in places.select("source", "domain", "language").join(targets.select("source").distinct(), "source", "left_semi").collect()}
    plan: dict[str, tuple[float, int]] = {}
    for r in targets.groupBy("source").agg(F.sum("target_share").cast("double").alias("share"), F.max("max_repeats").alias("cap")).collect():
        plan[r.source] = (max(0.0, r.share or 0.0), max(0, 1 if r.cap is None else r.cap))
    leaves = [(*where.get(s, ("", "")), s, share, float(available.get(s, (0, 0))[0] * cap)) for s, (share, cap) in plan.items()]
    total = largest_exact_total(leaves) if total_tokens is None else float(total_tokens)
    budgets = allocate(total, tree(leaves)) if leaves else {}
    rows = [(s, share, int(cap), int(available.get(s, (0, 0))[0]), float(budgets.get(s, 0.0))) for s, (share, cap) in plan.items()]
    budget = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, available_tokens long, budget_tokens double")
    docs = max(1, sum(n for _, n in available.values()))
    buckets = max(1, -(-docs // DOCS_PER_BUCKET))
    # Whole epochs, and the tokens that the last, partial epoch may take.
    part = budget.withColumns({"whole": F.when(F.col("available_tokens") > 0, F.least(F.floor(F.col("budget_tokens") / F.col("available_tokens")), F.col("max_repeats").cast("long"))).otherwise(0)})
    part = part.withColumn("rest", F.when(F.col("whole") < F.col("max_repeats"), F.col("budget_tokens") - F.col("whole") * F.col("available_tokens")).otherwise(0.0))
    order = F.xxhash64(F.col("source"), F.col("whole"), F.lit(seed), F.col("doc"))
    placed = tokens.join(broadcast_if_small(part.select("source", "whole", "rest"), len(rows), 100), "source").withColumn("order", order).withColumn("bucket", F.floor((F.col("order").cast("double") + 2.0**63) / (2.0**64) * buckets).cast("long"))
    sums = placed.groupBy("source", "bucket").agg(F.sum("tokens").alias("in_bucket"))
    before = sums.withColumn("before", F.coalesce(F.sum("in_bucket").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    running = F.sum("tokens").over(Window.partitionBy("source", "bucket").orderBy("order", "doc").rowsBetween(Window.unboundedPreceding, 0))
    # The document that crosses the budget is taken where that comes closer to it.
    seen = placed.withColumn("running", running).join(before.select("source", "bucket", "before"), ["source", "bucket"]).withColumn("upto", F.col("before") + F.col("running"))
    inside = F.col("upto") - F.col("tokens") / 2.0 <= F.col("rest")
    draw = seen.withColumn("epochs", (F.col("whole") + F.when(inside & (F.col("rest") > 0), 1).otherwise(0)).cast("int")).filter(F.col("epochs") > 0).select("doc", "source", "epochs", "tokens")
    draw = materialize(draw, "draw")
    got = draw.groupBy("source").agg(F.sum(F.col("tokens") * F.col("epochs")).alias("drawn_tokens"), F.max("epochs").alias("repeats"))
    everything = draw.agg(F.sum(F.col("tokens") * F.col("epochs")).alias("all_tokens"))
    report = budget.join(got, "source", "left").crossJoin(everything)  # one row
    report = report.select(
        "source", "target_share", "max_repeats", "available_tokens", "budget_tokens", F.coalesce("drawn_tokens", F.lit(0)).alias("drawn_tokens"),
        F.coalesce(F.col("drawn_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"), F.coalesce("repeats", F.lit(0)).alias("repeats"),
    )
    return Mix(draw, report)
