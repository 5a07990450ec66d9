"""Byte-level BPE encoding by an index of pair occurrences, and decoding.

Texts are cut into pre-tokens. The distinct new ones of a batch are laid out as one linked list of symbols, with an index from every mergeable
pair to all its positions; they are indexed TOGETHER at a time. Ranks that have positions are applied in ascending order; each merge moves the neighbouring pairs to the lists of their new ranks.
Encoded pre-tokens are kept for the rest of the partition, up to KEPT of them, and dropped together beyond that.

Null text counts as empty: no ids, and decodes to the empty string. Special tokens inside a text become their id, as the library does by default.
Texts of any length are taken whole. Rows are encoded one by one, repeated or not; extra columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyloom.llm import ragged
from tallyloom.llm.shared import prepare

KEPT = 300_000
# Pre-tokens indexed together; so many stay in the processor's cache.
TOGETHER = 2_500
# Fixed: the cut of byte-level vocabularies.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next free one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    return [chr(spare.get(b, b)) for b in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only byte-level BPE without normaliser and added space is known")
        letters = byte_letters()
        as_byte = {c: b for b, c in enumerate(letters)}
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.first = np.array([ids[c] for c in letters])
        # Rank of every pair, and what the pair of each rank becomes.
        self.ranks: dict[int, int] = {}
        self.by_rank: list[tuple[int, int, int]] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[left] << 32 | ids[right]] = rank
            self.by_rank.append((ids[left], ids[right], ids[left + right]))
        self.byte_ranks = np.array([[self.ranks.get(a << 32 | b, -1) for b in self.first.tolist()] for a in self.first.tolist()])
        spelled = {i: bytes(as_byte[c] for c in token) for token, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        lengths = np.array([len(spelled.get(i, b"")) for i in range(max(spelled) + 1)], np.int64)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(len(lengths))), np.uint8)
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no valid UTF-8 become U+FFFD."""
        return ragged.take_ranges(self.bytes, self.starts[ids], self.lengths[ids]).tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_pretokens(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pre-tokens one after the other, and the number of ids of each."""
    if not words:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    # One symbol per byte, and a wall (-1) behind each pre-token.
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
    walls = np.zeros(bounds[-1], bool)
    walls[bounds[1:] - 1] = True
    flat = np.full(bounds[-1], -1, np.int64)
    letters = np.frombuffer(b"".join(words), np.uint8)
    flat[~walls] = v.first[letters]
    # The index: rank of a pair -> the positions of its left symbol, ascending.
    at = np.flatnonzero(~walls[:-1] & ~walls[1:])
    left_of = np.cumsum(~walls) - 1
    rank_at = v.byte_ranks[letters[left_of[at]], letters[left_of[at] + 1]]
    at, rank_at = at[rank_at >= 0], rank_at[rank_at >= 0]
    order = np.argsort(rank_at, kind="stable")
    at, rank_at = at[order], rank_at[order]
    cuts = np.flatnonzero(np.concatenate(([True], rank_at[1:] != rank_at[:-1]))) if len(at) else np.zeros(0, np.int64)
    places = {r: p.tolist() for r, p in zip(rank_at[cuts].tolist(), np.split(at, cuts[1:]))}

    symbols = flat.tolist()
    after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
    rank_of = v.ranks.get
    ranks = list(places)
    heapq.heapify(ranks)
    while ranks:
        rank = heapq.heappop(ranks)
        left, right, merged = v.by_rank[rank]
        positions = places.pop(rank)
        if left == right:  # occurrences can overlap: the left one goes first
            positions.sort()
        for i in positions:
            if symbols[i] != left or symbols[j := after[i]] != right:
                continue  # an earlier merge has taken one of the two
            symbols[i], symbols[j] = merged, -2
            after[i] = k = after[j]
            before[k] = i
            p = before[i]
            # The pairs beside the new symbol move to the lists of their ranks. There is a wall on either side, at -1 too.
            if (s := symbols[p]) >= 0 and (r := rank_of(s << 32 | merged, -1)) >= 0:
                if r in places:
                    places[r].append(p)
                else:
                    places[r] = [p]
                    heapq.heappush(ranks, r)
            if (s := symbols[k]) >= 0 and (r := rank_of(merged << 32 | s, -1)) >= 0:
                if r in places:
                    places[r].append(i)
                else:
                    places[r] = [i]
                    heapq.heappush(ranks, r)
    flat = np.array(symbols, np.int64)
    return flat[flat >= 0].astype(np.uint32), ragged.sums(flat >= 0, bounds)


class Encoder:
    """Encodes batch after batch of a partition; remembers pre-tokens."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.pools, self.counts, self.joined = [], [], None

    def learn(self, seen: set[str]) -> None:
        new = [w for w in seen if w not in self.place]
        if len(self.place) + len(new) > KEPT:
            self.clear()
            new = list(seen)
        if new:
            ordinary = [w for w in new if w not in self.v.special]
            spelled = [w.encode() for w in ordinary]
            found = [encode_pretokens(spelled[k : k + TOGETHER], self.v) for k in range(0, max(1, len(spelled)), TOGETHER)]
            ids, n = (np.concatenate(x) for x in zip(*found))
            for w in new:
                if w in self.v.special:
                    ordinary.append(w)
                    ids, n = np.append(ids, np.uint32(self.v.special[w])), np.append(n, 1)
            self.place.update(zip(ordinary, range(len(self.place), len(self.place) + len(ordinary))))
            self.pools.append(ids.astype(np.uint32))
            self.counts.append(n)
            self.pools, self.counts = [np.concatenate(self.pools)], [np.concatenate(self.counts)]
            self.joined = np.cumsum(self.counts[0]) - self.counts[0]

    def cut(self, text: str) -> list[str]:
        if self.v.split is None or not any(t in text for t in self.v.special):
            return PRETOKEN.findall(text)
        return [w for k, part in enumerate(self.v.split.split(text)) for w in ([part] if k % 2 else PRETOKEN.findall(part))]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        words: list[str] = []
        bounds = [0]
        for text in texts:
            words.extend(self.cut(text or ""))
            bounds.append(len(words))
        self.learn(set(words))
        if not words:
            return [np.zeros(0, np.uint32)] * len(texts)
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        n = self.counts[0][at]
        ids = ragged.take_ranges(self.pools[0], self.joined[at], n)
        ends = np.concatenate(([0], np.cumsum(n)))[bounds]
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]


def encode(docs: DataFrame, path: str, column: str = "text", ids: str = "ids", n_tokens: str = "n_tokens") -> DataFrame:
    """All columns of docs, with the token ids of the text (array of int) and their number put last; columns of the same names are replaced."""
    prepare(docs.sparkSession)
    docs = docs.drop(ids, n_tokens)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{ids}` array<int>, `{n_tokens}` long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path))
        for batch in batches:
            for part in ragged.slices(batch, column):
                found = encoder.encode(part.column(column).to_pylist())
                sizes = np.array([len(x) for x in found], np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(np.concatenate(found).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(sizes)], [*part.schema.names, ids, n_tokens])

    return docs.mapInArrow(run, schema)


def decode(coded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns of coded, with the text that the ids stand for; a null list gives an empty text."""
    prepare(coded.sparkSession)
    coded = coded.drop(into)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema) + f", `{into}` string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            lists = batch.column(ids)
            texts = [v.decode(lists[k].values.to_numpy().astype(np.int64)) if lists[k].is_valid else "" for k in range(len(lists))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, into])

    return coded.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): texts are encoded, the ids decoded, and both hashed in one pass."""
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        encoder = Encoder(v)
        for batch in batches:
            for part in ragged.slices(batch):
                found = encoder.encode(part.column("text").to_pylist())
                of_ids = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in found]
                of_texts = [hashlib.sha256(v.decode(x).encode()).hexdigest() for x in found]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(x) for x in found], pa.int64()), pa.array(of_ids), pa.array(of_texts)], names)

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
