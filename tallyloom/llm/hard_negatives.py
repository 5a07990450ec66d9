"""Hard negatives of anchors by integer inner product, pruned along a spanning tree of the anchors.

Anchors are dealt into blocks of about BLOCK. A block is spanned by the tree of least Euclidean edges (Prim). For a candidate x and an anchor c with parent p,
score(c, x) lies within score(p, x) +- |c - p| * |x|, and within +- |c| * |x|; where the parent was not scored, its own interval takes the place of its score.
A candidate is scored exactly only where its interval overlaps the window in which it could still change the anchor's result: above the last of the best found so
far and, for negatives, between the two shares of a positive's score. What is pruned cannot be in the result, so results are exact.

Anchors are the query set: every block of them meets every row, in slices of the rows, so work grows with (anchors x rows); the rows that a task returns are bounded by its
anchors. Nothing is broadcast or collected but counts. Tasks hold one block of anchors and stream the rows past it.

Rows with a null id, label or vector, or a null component, take no part. Vectors may differ in length: missing components count as zero, and empty vectors score 0.
Repeated rows count as often as they occur; a row is never matched with an anchor of its own id. Rows that repeat an anchor in every column give one anchor. Scores beyond 64 bits
are held at the limits of a long. An empty table, or one without anchors, gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.shared import prepare, stash

# Anchors that a task holds, with an interval for each of them and each row of a batch.
BLOCK = 4096
# Parts of the rows that one block of anchors meets, each in a task of its own.
SLICES = 24
EXACT = 2.0**53
SLACK = 1e-9
LONG = np.iinfo(np.int64)


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows, filled up with zeros or cut to `width`."""
    lengths = np.diff(column.offsets.to_numpy())
    width = int(lengths.max(initial=0)) if width is None else width
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    row, held = np.repeat(np.arange(len(column)), lengths), at < width
    out[row[held], at[held]] = values[held]
    return out


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(float) ** 2).sum(axis=1))


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order in which the rows join the tree of least edges, and for each in that order the place of its parent (-1: root) and the length of the edge."""
    n, points = len(vectors), vectors.astype(float)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n)
    nearest, reach, place = np.full(n, -1, np.int64), np.full(n, np.inf), np.full(n, -1, np.int64)
    at = 0
    for k in range(n):
        order[k], place[at] = at, k
        parent[k] = place[nearest[at]] if k else -1
        edge[k] = reach[at] if k else 0.0
        away = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        closer = (away < reach) & (place < 0)
        nearest[closer], reach[closer] = at, away[closer]
        reach[at] = np.inf
        left = np.where(place < 0, reach, np.inf)
        at = int(left.argmin()) if np.isfinite(left).any() else int((place < 0).argmax())
    return order, parent, edge


def exact_scores(vectors: np.ndarray, anchor: np.ndarray, safe: bool) -> np.ndarray:
    if safe:
        return (vectors.astype(float, copy=False) @ anchor).astype(np.int64)
    wide = vectors.astype(object) @ anchor.astype(object) if vectors.shape[1] else np.zeros(len(vectors), object)
    return np.array([min(max(int(s), LONG.min), LONG.max) for s in wide], np.int64)


class Best:
    """The first k rows by score and id among those seen, for one window of scores."""

    def __init__(self, k: int, low: int = LONG.min, high: int = LONG.max):
        self.k, self.low, self.high = k, low, high
        self.scores = self.ids = np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """The lowest score that can still get in."""
        return int(self.scores[-1]) if len(self.scores) == self.k else self.low

    def offer(self, scores: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> None:
        fits = (scores >= self.least) & (scores <= self.high)
        if fits.any():
            times = np.minimum(copies[fits], self.k)
            scores = np.concatenate((self.scores, np.repeat(scores[fits], times)))
            ids = np.concatenate((self.ids, np.repeat(ids[fits], times)))
            first = np.lexsort((ids, ~scores))[: self.k]  # ~ turns the order round without overflow
            self.scores, self.ids = scores[first], ids[first]


class Block:
    """A block of anchors in tree order, with the windows each has open."""

    def __init__(self, table: pa.Table, found: int, percents: tuple[int, int] | None):
        table = table.combine_chunks().sort_by("place")
        column = {c: table.column(c).combine_chunks() for c in table.column_names}
        self.vectors = matrix(column["vector"])
        self.width, self.norms = self.vectors.shape[1], norms(self.vectors)
        self.ids, self.labels = column["vec_id"].to_numpy(), column["label"].to_pylist()
        self.place, self.parent, self.edge = column["place"].to_numpy(), column["parent"].to_numpy(), column["edge"].to_numpy()
        self.number, self.block = table.num_rows, column["block"][0].as_py()
        self.negatives = percents is not None
        if percents is None:
            self.best = [[Best(found)] for _ in range(self.number)]
        else:
            low, high = percents
            self.best = [[Best(found, -(-low * p // 100), high * p // 100) for p in scores or []] for scores in column["positive_scores"].to_pylist()]
        self.codes = {label: i for i, label in enumerate(dict.fromkeys(self.labels))}
        self.own = np.array([self.codes[x] for x in self.labels])
        self.scored = self.offered = 0

    def meet(self, batch: pa.RecordBatch) -> None:
        wide = batch.column("vector")
        rows, reach = matrix(wide, self.width), norms(matrix(wide))
        ids, copies = batch.column("vec_id").to_numpy(), batch.column("copies").to_numpy()
        labels = np.array([self.codes.get(x, -1) for x in batch.column("label").to_pylist()])
        safe = float(np.abs(rows).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) * max(1, self.width) < EXACT
        rows = rows.astype(float) if safe else rows
        low, high = np.empty((self.number, len(rows))), np.empty((self.number, len(rows)))
        for k in range(self.number):
            most = self.norms[k] * reach
            lo, hi = -most, most
            if self.parent[k] >= 0:
                step, p = self.edge[k] * reach, self.parent[k]
                lo, hi = np.maximum(lo, low[p] - step), np.minimum(hi, high[p] + step)
            slack = SLACK * (most + 1)
            low[k], high[k] = lo - slack, hi + slack
            open_ = self.best[k]
            if not open_:
                continue
            fits = (labels != self.own[k]) if self.negatives else (labels == self.own[k])
            fits &= ids != self.ids[k]
            self.offered += int(fits.sum())
            at = np.flatnonzero(fits & (high[k] >= min(b.least for b in open_)) & (low[k] <= max(b.high for b in open_)))
            if not len(at):
                continue
            self.scored += len(at)
            scores = exact_scores(rows[at], self.vectors[k], safe)
            low[k, at] = high[k, at] = scores
            if not safe:
                low[k, at] -= slack[at]
                high[k, at] += slack[at]
            for b in open_:
                b.offer(scores, ids[at], copies[at])

    def result(self) -> pa.RecordBatch:
        rows = [(self.block, int(self.place[k]), w, int(i), int(s)) for k in range(self.number) for w, b in enumerate(self.best[k]) for i, s in zip(b.ids, b.scores)]
        rows.append((self.block, -1, self.scored, -1, self.offered))  # how much was scored, of how much
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["block", "place", "window", "vec_id", "score"])


FOUND = "block long, place long, window long, vec_id long, score long"


def planted(anchors: DataFrame, blocks: int) -> DataFrame:
    """Anchors with the block they are in, and their place, parent and edge in its tree."""
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks)))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema]

    def plant(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        order, parent, edge = spanning_tree(matrix(table.column("vector").combine_chunks()))
        table = table.take(pa.array(order))
        for name, values in (("place", np.arange(len(order))), ("parent", parent), ("edge", edge)):
            table = table.append_column(name, pa.array(values))
        return table

    return dealt.groupBy("block").applyInArrow(plant, ", ".join([*fields, "place long, parent long, edge double"]))


def search(anchors: DataFrame, rows: DataFrame, blocks: int, found: int, percents: tuple[int, int] | None) -> DataFrame:
    """The first rows of every open window of every anchor, per slice of the rows; a row of place -1 per task tells how many were scored and offered."""
    parts = blocks * SLICES
    extra = {"positive_scores": "array<long>"} if percents else {}
    names = ["vec_id", "label", "vector", "place", "parent", "edge", "copies", *extra]
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = anchors.withColumn("slice", every(SLICES)).withColumn("copies", F.lit(0).cast("long")).withColumn("kind", F.lit(0))
    right = rows.withColumn("block", every(blocks)).withColumn("slice", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(SLICES))).withColumn("kind", F.lit(1))
    right = right.withColumns({c: F.lit(None).cast(t) for c, t in {"place": "long", "parent": "long", "edge": "double", **extra}.items()})
    shape = lambda df: df.select((F.col("block") * SLICES + F.col("slice")).alias("task"), "kind", "block", *names)
    dealt = shape(left).unionByName(shape(right)).repartition(parts, "task").sortWithinPartitions("task", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, block = None, [], None
        for batch in batches:
            key = batch.column("task").to_numpy() * 2 + batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part, now = batch.slice(a, b - a), int(key[a]) // 2
                if now != task:
                    if block is not None:
                        yield block.result()
                    task, held, block = now, [], None
                if key[a] % 2 == 0:
                    held.append(part)
                elif held or block is not None:
                    block, held = block or Block(pa.Table.from_batches(held), found, percents), []
                    block.meet(part)
        if block is not None:
            yield block.result()

    return dealt.mapInArrow(run, FOUND)


def first(found: DataFrame, k: int) -> DataFrame:
    """The first k of each window, numbered from 1."""
    order = Window.partitionBy("block", "place", "window").orderBy(F.desc("score"), "vec_id")
    return found.filter("place >= 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (vec_id, label, vector of whole numbers).

    Positives are an anchor's first rows of its label; negatives are the first rows of other labels with a score of low to high percent of the positive's.
    """
    prepare(vectors.sparkSession)
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    kept = vectors.withColumn("_anchor", F.coalesce(is_anchor, F.lit(False))).filter(whole).select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("vector").cast("array<long>").alias("vector"), "_anchor")
    # A row that occurs often is kept once, with its number: only the first few copies can be in a result.
    rows = stash(kept.groupBy("vec_id", "label", "vector").agg(F.count("*").alias("copies"), F.max("_anchor").alias("_anchor")))
    anchors = rows.filter("_anchor").select("vec_id", "label", "vector")
    blocks = max(1, -(-anchors.count() // BLOCK))
    rows = rows.select("vec_id", "label", "vector", "copies")
    tree = stash(planted(anchors, blocks))
    good = first(search(tree, rows, blocks, positives, None), positives).select("block", "place", F.col("rank").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    good = stash(good)
    opened = good.groupBy("block", "place").agg(F.transform(F.array_sort(F.collect_list(F.struct("window", "positive_score"))), lambda x: x["positive_score"]).alias("positive_scores"))
    tree = stash(tree.join(opened, ["block", "place"], "left"))
    bad = first(search(tree, rows, blocks, negatives, (low, high)), negatives).withColumn("window", F.col("window") + 1)
    named = tree.select("block", "place", F.col("vec_id").alias("anchor_id"))
    out = bad.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(good, ["block", "place", "window"]).join(named, ["block", "place"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def whole_numbers(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector): components times `scale`, rounded down; vectors with a null or non-finite component become null."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return embeddings.select("vec_id", "label", F.when(finite, F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))).alias("vector"))
