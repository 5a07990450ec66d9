"""Token counts under a byte-fallback piece vocabulary, by rank-synchronous merging of ragged arrays.

Texts are cut at word starts and around characters that no longer piece contains; no merge crosses such a cut. The distinct pre-tokens of a batch
are held as one flat symbol array with offsets. In each round every sequence merges its pair of lowest rank, leftmost on ties, all sequences at once.
What is left of a sequence are its tokens; a symbol outside the vocabulary counts its UTF-8 bytes.

Null and empty texts have 0 tokens. Text of any length is taken whole: sequences above LONG symbols are merged one by one with a queue in the
same order, so time stays near linear. Repeated rows are counted one by one; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import ragged
from tallyloom.llm.shared import prepare

LIMIT = 4096
LONG = 200
NONE = np.int64(1 << 62)
SPACE_MARK = "▁"


class Pieces:
    """Merge table of a piece vocabulary: symbol pairs -> merged symbol and its rank (0 is merged first)."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (spec.add_dummy_prefix and spec.escape_whitespaces and model.trainer_spec.byte_fallback):
            raise ValueError("only vocabularies with a space before the text, kept white space and byte fallback are known")
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in normal):
            raise ValueError("a piece goes on after a space")
        order = {s: r for r, s in enumerate(sorted({model.pieces[i].score for i in normal.values()}, reverse=True))}
        self.width = len(model.pieces)
        self.symbol = np.full(0x110000, -1, np.int64)
        found = {}
        for piece, i in normal.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
            for k in range(1, len(piece)):
                left, right = normal.get(piece[:k]), normal.get(piece[k:])
                if left is not None and right is not None:
                    found[left * self.width + right] = (i, order[model.pieces[i].score])
        self.keys = np.array(sorted(found), np.int64)
        self.merged = np.array([found[k][0] for k in self.keys.tolist()], np.int64)
        self.rank = np.array([found[k][1] for k in self.keys.tolist()], np.int64)
        self.pairs = found
        self.blank_run = max(len(p) for p in normal if set(p) == {SPACE_MARK})
        joined = {c for p in normal if len(p) > 1 for c in p}
        self.loner = ragged.byte_set(bytes(b for b in range(128) if chr(b) not in joined and b != 32))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = np.where((left < 0) | (right < 0), -1, left * self.width + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], NONE), self.merged[at]


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def merge_queue(symbols: list[int], table: Pieces) -> list[int]:
    """One sequence merged pair by pair; for sequences too long to rescan in every round."""
    after, before, alive = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1)), [True] * len(symbols)
    queue: list[tuple[int, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        if symbols[i] >= 0 and symbols[j] >= 0 and (hit := table.pairs.get(symbols[i] * table.width + symbols[j])):
            heapq.heappush(queue, (hit[1], i, j, hit[0]))

    for i in range(len(symbols) - 1):
        offer(i, i + 1)
    while queue:
        _, i, j, merged = heapq.heappop(queue)
        if alive[i] and after[i] == j and j < len(symbols) and alive[j] and (hit := table.pairs.get(symbols[i] * table.width + symbols[j])) and hit[0] == merged:
            symbols[i], alive[j], after[i] = merged, False, after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
    return [s for s, a in zip(symbols, alive) if a]


def merge_rounds(symbols: np.ndarray, offsets: np.ndarray, table: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """What is left of every sequence when no pair can be merged: symbols, and the number of the sequence of each."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    rank = np.full(len(symbols), NONE)
    into = np.zeros(len(symbols), np.int64)
    if len(symbols) > 1:
        rank[:-1], into[:-1] = table.look_up(symbols[:-1], symbols[1:])
        rank[:-1][owner[:-1] != owner[1:]] = NONE
    while len(symbols):
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        # The rank above, the position below: the least is the leftmost of the lowest rank.
        least = np.minimum.reduceat(np.where(rank == NONE, NONE, (rank << 32) | np.arange(len(rank))), starts)
        over = least == NONE
        if over.any():
            lengths = np.diff(np.concatenate((starts, [len(symbols)])))
            out = np.repeat(over, lengths)
            done.append((symbols[out], owner[out]))
            shift = np.cumsum(out)
            at = (least[~over] & 0xFFFFFFFF) - shift[least[~over] & 0xFFFFFFFF]
            symbols, owner, rank, into = symbols[~out], owner[~out], rank[~out], into[~out]
        else:
            at = least & 0xFFFFFFFF
        if not len(at):
            break
        symbols[at] = into[at]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        at = at - np.arange(len(at))
        symbols, owner, rank, into = symbols[keep], owner[keep], rank[keep], into[keep]
        for i in (at, at - 1):
            i = i[(i >= 0) & (i + 1 < len(symbols))]
            rank[i], into[i] = table.look_up(symbols[i], symbols[i + 1])
            rank[i[owner[i] != owner[i + 1]]] = NONE
        last = at[at + 1 >= len(symbols)]
        rank[last] = NONE
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])


def tokens_of(pretokens: list[bytes], table: Pieces) -> np.ndarray:
    """Tokens of each pre-token, in which spaces are still spaces."""
    more, bodies = np.zeros(len(pretokens), np.int64), []
    for k, word in enumerate(pretokens):
        blanks = len(word) - len(word.lstrip(b" "))
        if blanks > 3 * table.blank_run:  # the longest piece of blanks is cut off from the left again and again
            more[k] = blanks // table.blank_run - 2
            word = word[more[k] * table.blank_run :]
        bodies.append(word.replace(b" ", SPACE_MARK.encode()))
    points = np.frombuffer(b"".join(bodies).decode().encode("utf-32-le"), np.uint32)
    lengths = np.array([len(b.decode()) for b in bodies], np.int64)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    symbols = table.symbol[points]
    width = np.where(points < 0x80, 1, np.where(points < 0x800, 2, np.where(points < 0x10000, 3, 4)))
    n = more + ragged.sums(np.where(symbols < 0, width, 0), bounds)
    for k in np.flatnonzero(lengths > LONG).tolist():
        n[k] += sum(s >= 0 for s in merge_queue(symbols[bounds[k] : bounds[k + 1]].tolist(), table))
    short = np.flatnonzero(lengths <= LONG)
    left, owner = merge_rounds(ragged.take_ranges(symbols, bounds[short], lengths[short]), np.concatenate(([0], np.cumsum(lengths[short]))), table)
    n[short] += np.bincount(owner[left >= 0], minlength=len(short))
    return n


def count_tokens(column: pa.Array, table: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and tokens of every text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    sizes = pc.binary_length(column).to_numpy().astype(np.int64)
    marked = pc.replace_substring(column, SPACE_MARK, " ")
    none = pa.scalar("", pa.large_string())
    marked = pc.if_else(pc.equal(marked, none), none, pc.binary_join_element_wise(none, marked, pa.scalar(" ", pa.large_string())))
    data, offsets = ragged.flat(marked)
    if not len(data):
        return sizes, np.zeros(len(sizes), np.int64)
    blank, lone = data == 32, table.loner[data]
    start = np.zeros(len(data), bool)
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    start[1:] |= (blank[1:] & ~blank[:-1]) | lone[1:] | lone[:-1]
    starts = np.flatnonzero(start)
    ids, known = ragged.encode(data, np.concatenate((starts, [len(data)])))
    per = tokens_of(known.to_pylist(), table)[ids]
    return sizes, ragged.sums(per, np.searchsorted(starts, offsets))


def token_counts(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document."""
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(model_path)
        for batch in batches:
            for part in ragged.slices(batch):
                sizes, n = count_tokens(part.column("text"), table)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
