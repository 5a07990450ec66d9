"""Quality scores from a factorisation machine over hashed words, structure statistics and metadata.

Inputs of a document: its words, lower-cased and hashed to 2**WORD_BITS slots with normalised counts; statistics of its structure, each cut to bins;
and its character count as metadata. Pairs of inputs interact through vectors of RANK numbers per input. With the identity
sum(i<j) <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i|^2 x_i^2) / 2 a score takes time linear in the inputs.

The machine is fitted on at most SAMPLE labelled documents, taken by hash of doc_id so that the choice is the same in any run; held-out documents are never among them.
Scoring covers whole texts. Null and empty texts have no words and are scored by the rest. Rows with null labels or ids are not learned from; a document labelled more than once
counts with its lowest label. With no labels of both kinds at all every score is the share of label 1, or 0.5. Repeated rows get equal scores; extra columns pass through. `score` and `classify` replace
columns named like their results, `accepted` returns all columns as they came.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import ragged
from tallyloom.llm.quality_rules import count_batch
from tallyloom.llm.shared import prepare

SAMPLE = 8000
WORD_BITS = 14
RANK = 4
BINS = 12
EPOCHS = 12
RATE = 0.05
DECAY = 1e-4
CUT = 0.3
DIGITS, MARKS, PIPES = (ragged.byte_set(s) for s in (b"0123456789", b".,;:?", b"|"))


def held_out() -> Column:
    """One document in five, by its id alone."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def statistics(column: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """Bin numbers of every text's statistics: one column each."""
    t = ragged.Texts(column)
    n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat, n_upper, n_exclaim = (x.astype(float) for x in count_batch(column))
    per = lambda x, y: x / np.maximum(y, 1)
    marks, digits, pipes = (ragged.sums(s[t.data], t.offsets) for s in (MARKS, DIGITS, PIPES))
    key = t.word_doc * (len(t.vocabulary) + 1) + t.ids
    again = np.zeros(len(key), bool)
    again[1:] = key[1:] == key[:-1]  # a word right behind itself
    kinds = np.bincount(np.unique(key) // (len(t.vocabulary) + 1), minlength=t.count) if len(key) else np.zeros(t.count)
    shares = [per(n_symbols, n_words), per(n_upper, word_chars), per(n_exclaim, n_words), per(pipes, n_words), per(n_dup_lines, n_lines), per(n_repeat, n_words), per(marks, n_words), per(digits, word_chars), per(kinds, n_words), per(ragged.sums(again, t.word_offsets), n_words)]
    scales = [per(word_chars, n_words) / 12, np.log1p(n_words) / 10, np.log1p(per(n_words, n_lines)) / 8, np.log1p(np.maximum(sizes, 0)) / 14]
    # The root spreads small shares over more bins.
    level = np.stack([*(np.sqrt(s) for s in shares), *scales], axis=1)
    return np.clip((level * BINS).astype(np.int64), 0, BINS - 1)


N_STATISTICS = 14
WIDTH = (1 << WORD_BITS) + N_STATISTICS * BINS


@dataclass
class Inputs:
    """Sparse rows: input numbers and values, with the offsets of each row."""

    at: np.ndarray
    value: np.ndarray
    offsets: np.ndarray


def inputs(texts: pa.Array, sizes: pa.Array) -> Inputs:
    t = ragged.Texts(texts, lower=True)
    lengths = pc.fill_null(sizes.cast(pa.int64()), 0).to_numpy().astype(float)
    slot = (ragged.mix(t.hashes) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    key, n = np.unique((t.word_doc << WORD_BITS) | slot, return_counts=True)
    doc = key >> WORD_BITS
    norm = np.sqrt(np.bincount(doc, weights=n.astype(float) ** 2, minlength=t.count))
    bins = statistics(texts, lengths)
    stat_at = (1 << WORD_BITS) + np.arange(N_STATISTICS) * BINS + bins
    at = np.concatenate((key & ((1 << WORD_BITS) - 1), stat_at.ravel()))
    value = np.concatenate((n / norm[doc], np.full(stat_at.size, 0.5)))
    owner = np.concatenate((doc, np.repeat(np.arange(t.count), N_STATISTICS)))
    order = np.argsort(owner, kind="stable")
    return Inputs(at[order], value[order].astype(np.float32), np.searchsorted(owner[order], np.arange(t.count + 1)))


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, x: Inputs) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and the factor sums of each row. Every row has inputs."""
        rows = x.offsets[:-1]
        if not len(rows):
            return np.zeros(0), np.zeros((0, RANK))
        scaled = self.factors[x.at] * x.value[:, None]
        linear = np.add.reduceat(self.weights[x.at] * x.value, rows)
        total = np.add.reduceat(scaled, rows, axis=0)
        squares = np.add.reduceat((scaled**2).sum(axis=1), rows)
        return self.bias + linear + ((total**2).sum(axis=1) - squares) / 2, total

    def score(self, x: Inputs) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x)[0].astype(float), -30, 30)))


def part(x: Inputs, rows: np.ndarray) -> Inputs:
    sizes = np.diff(x.offsets)[rows]
    take = lambda pool: ragged.take_ranges(pool, x.offsets[rows], sizes)
    return Inputs(take(x.at), take(x.value), np.concatenate(([0], np.cumsum(sizes))))


def fit(x: Inputs, labels: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss, minibatches, step sizes per parameter from past gradients."""
    random = np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.5
    machine = Machine(float(np.log(share / (1 - share))) if 0 < share < 1 else (30.0 if share == 1 else -30.0), np.zeros(WIDTH, np.float32), random.normal(0, 0.05, (WIDTH, RANK)).astype(np.float32))
    if not (len(labels) and 0 < share < 1):
        machine.factors[:] = 0
        return machine
    past_w, past_f, past_b = np.full(WIDTH, 1e-2), np.full((WIDTH, RANK), 1e-2), 1e-2
    for _ in range(EPOCHS):
        order = random.permutation(len(labels))
        for start in range(0, len(order), 64):
            rows = order[start : start + 64]
            b = part(x, rows)
            margin, total = machine.margin(b)
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]
            per = np.repeat(error, np.diff(b.offsets)) * b.value
            pull = per[:, None] * (np.repeat(total, np.diff(b.offsets), axis=0) - machine.factors[b.at] * b.value[:, None])
            touched, inverse = np.unique(b.at, return_inverse=True)
            grad_w = np.bincount(inverse, per, len(touched)) / len(rows) + DECAY * machine.weights[touched]
            grad_f = np.stack([np.bincount(inverse, pull[:, k], len(touched)) for k in range(RANK)], axis=1) / len(rows) + DECAY * machine.factors[touched]
            grad_b = error.mean()
            past_w[touched] += grad_w**2
            past_f[touched] += grad_f**2
            past_b += grad_b**2
            machine.weights[touched] -= RATE * 4 * grad_w / np.sqrt(past_w[touched])
            machine.factors[touched] -= RATE * grad_f / np.sqrt(past_f[touched])
            machine.bias -= RATE * grad_b / np.sqrt(past_b)
    return machine


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fit on at most `sample` labelled documents that are not held out. What reaches the driver is bounded by `sample`."""
    known = labels.select("doc_id", "quality").dropna().groupBy("doc_id").agg(F.min("quality").alias("quality")).filter(~held_out())
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumnRenamed("doc_id", "labelled_id")
    rows = docs.select("doc_id", "text", "n_chars").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in ragged.slices(batch):
                x = inputs(piece.column("text"), piece.column("n_chars"))
                bounds = pa.array(x.offsets, pa.int32())
                lists = [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in (x.at.astype(np.int32), x.value.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("quality").cast(pa.int32()), *lists], ["doc_id", "label", "at", "value"])

    table = rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, label int, at array<int>, value array<float>").toArrow().combine_chunks()
    # A fixed order, and one row per id, makes the fit the same whatever the partitions.
    frame = table.select(["doc_id", "label"]).to_pandas().reset_index().sort_values(["doc_id", "label", "index"]).drop_duplicates("doc_id")
    table = table.take(pa.array(frame["index"].to_numpy()))
    flatten = lambda name: table.column(name).combine_chunks().flatten().to_numpy() if len(table) else np.zeros(0)
    sizes = pc.list_value_length(table.column("at")).to_numpy() if len(table) else np.zeros(0, np.int64)
    x = Inputs(flatten("at").astype(np.int64), flatten("value").astype(np.float32), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64))
    return fit(x, frame["label"].to_numpy(float))


def score(docs: DataFrame, machine: Machine, columns: list[str] | None = None) -> DataFrame:
    """The named columns of docs (all unless given) with `score`, from 0 to 1."""
    prepare(docs.sparkSession)
    docs = docs.drop("score")
    columns = docs.columns if columns is None else columns
    needed = list(dict.fromkeys([*columns, "text", "n_chars"]))
    docs = docs.select(*needed)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in ragged.slices(batch):
                found = machine.score(inputs(piece.column("text"), piece.column("n_chars")))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in columns), pa.array(found, pa.float64())], [*columns, "score"])

    return docs.mapInArrow(run, schema)


def accepted(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents that are scored at the cut or above, with the columns they came with, whatever their names."""
    kept = docs.columns
    named = docs.toDF(*(f"_kept_{k}" for k in range(len(kept))))
    inner = [F.col(f"_kept_{kept.index(c)}").alias(c) for c in ("text", "n_chars")]
    scored = score(named.select("*", *inner), train(docs, labels), named.columns)
    return scored.filter(F.col("score") >= cut).drop("score").toDF(*kept)


def classify(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None, cut: float = CUT) -> DataFrame:
    """The named columns with `score` and `predicted` (1 from the cut on)."""
    return score(docs, train(docs, labels), columns).withColumn("predicted", (F.col("score") >= cut).cast("int"))
