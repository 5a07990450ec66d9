"""Repeated passages by recompression.

Rounds of naming turn the words of a text into symbols. A round first names every run of one symbol, then every pair of neighbours whose first symbol falls
into the left half and whose second falls into the right half of the alphabet of that round. A name is a 64-bit hash of what it
stands for, so all tasks give equal names without exchanging them. Each symbol knows its context: the words that decided its name and borders. Wherever these words occur, the same symbol arises:
the interior of equal passages has equal symbols whatever stands around them.

A window of `size` words is represented by its highest symbol whose context takes at most half of the window, the least hash among equals; the few windows without
one (long runs) by themselves. Equal windows have equal representatives. The windows that share a representative travel together, with a fingerprint each, to
the task of that representative, which finds the smallest doc_id of every window. Windows in one task are told apart by 32 bits of the representative and 64 of another hash. A word is
removed if it lies in a window that also starts in a document with a smaller doc_id, judged on the input.

Windows that several documents of one slice of the input have are settled there: only the smallest document's goes on. So a window that a third of all documents
share reaches its task at most once per slice. Windows that share a representative but differ, such as those around a common phrase, are not settled there. Representatives that more than
HOT_WINDOWS windows have, judged by one document in SAMPLE, are therefore refined by the fingerprint of the window: equal windows still meet, and the group is spread over all buckets. Which
representatives are refined does not change the result, as all tasks refine the same ones. Representatives are packed by bucket, and the number of buckets grows with the input's partitions.

Words are runs of characters other than ASCII white space, unchanged. Null text has no words; documents shorter than a window lose nothing. Repeated rows (the same doc_id and text) lose nothing to each other, and
each row is returned. A row without a doc_id takes part in nothing and stays whole. Other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import ragged
from tallyloom.llm.shared import prepare, stash, with_likely

SIZE = 50
# Buckets of representatives per partition of the input.
BUCKETS = 16
# Windows of one representative that a task may be given, and the share of documents by which they are counted (one in SAMPLE, by hash of doc_id).
HOT_WINDOWS = 200_000
SAMPLE = 16
# Slots of the bitmap of hot representatives (1 MiB), and bytes of a page of it. Slots that fill up only spread more windows.
HOT_SLOTS, PAGE = 1 << 23, 4096
FAR = np.int64(1) << np.int64(40)
# Odd bases of the two range hashes, and their inverses modulo 2**64.
BASES = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
INVERSES = [np.uint64(pow(int(b), -1, 1 << 64)) for b in BASES]


class Ranges:
    """Hash of any range of words of a batch in constant time; equal ranges have equal hashes wherever they lie."""

    def __init__(self, hashes: np.ndarray, which: int):
        n = len(hashes)
        powers = np.concatenate((np.ones(1, np.uint64), np.full(n, BASES[which], np.uint64))).cumprod(dtype=np.uint64)
        self.back = np.concatenate((np.ones(1, np.uint64), np.full(n, INVERSES[which], np.uint64))).cumprod(dtype=np.uint64)
        self.total = np.concatenate((np.zeros(1, np.uint64), (hashes * powers[:n]).cumsum(dtype=np.uint64)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return ragged.mix((self.total[end] - self.total[start]) * self.back[start] + (end - start).astype(np.uint64))


class Level:
    """Symbols of one level in text order: name, document, context [low, high) in words. A context that the text's border cuts off is out of reach."""

    def __init__(self, name: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.name, self.doc, self.low, self.high = name, doc, low, high

    def sides(self) -> tuple[np.ndarray, np.ndarray]:
        """Context start of the symbol before and end of the symbol after each."""
        n = len(self.name)
        alike = self.doc[1:] == self.doc[:-1]
        before, after = np.full(n, -FAR), np.full(n, FAR)
        before[1:][alike] = self.low[:-1][alike]
        after[:-1][alike] = self.high[1:][alike]
        return before, after


def name_runs(s: Level) -> Level:
    """Each maximal run of equal symbols becomes one; to know a run, one must see the symbols beside it."""
    n = len(s.name)
    head = np.concatenate(([True], (s.name[1:] != s.name[:-1]) | (s.doc[1:] != s.doc[:-1])))
    first = np.flatnonzero(head)
    last = np.concatenate((first[1:], [n])) - 1
    length = (last - first + 1).astype(np.uint64)
    name = np.where(length > 1, ragged.mix(s.name[first] ^ ragged.mix(length)), s.name[first])
    before, after = s.sides()
    return Level(name, s.doc[first], before[first], after[last])


def name_pairs(s: Level, turn: int) -> Level:
    """A left symbol before a right one becomes a pair; a left symbol alone depends on what follows it, a right one on what stands before it."""
    right = (ragged.mix(s.name + np.uint64(0x5851F42D4C957F2D * (turn + 1) % (1 << 64))) >> np.uint64(63)) == 1
    joined = np.zeros(len(s.name), bool)
    joined[:-1] = ~right[:-1] & right[1:] & (s.doc[1:] == s.doc[:-1])
    second = np.concatenate(([False], joined[:-1]))
    before, after = s.sides()
    follower = np.minimum(np.arange(len(s.name)) + 1, len(s.name) - 1)
    name = np.where(joined, ragged.mix(s.name * np.uint64(3) + ragged.mix(s.name[follower])), s.name)
    low = np.where(joined | ~right, s.low, before)
    high = np.where(joined, s.high[follower], np.where(right, s.high, after))
    return Level(name[~second], s.doc[~second], low[~second], high[~second])


def representatives(t: ragged.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts (word numbers) of all windows of the batch, and the hash that represents each."""
    at = t.window_starts(size)
    if not len(at):
        return at, np.zeros(0, np.uint64)
    ranges = Ranges(t.hashes, 0)
    # Longer contexts tell more apart, but fewer of them fit a window, so more are needed.
    longest = max(size // 2, 1)
    n, doc = len(t.starts), t.word_doc
    is_window = np.zeros(n, bool)
    is_window[at] = True
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    rank, key = np.full(n, none), np.zeros(n, np.uint64)
    symbols = Level(t.hashes, doc, np.arange(n), np.arange(n) + 1)
    turn = 0
    while True:
        symbols = name_pairs(name_runs(symbols), turn)
        turn += 1
        fits = np.flatnonzero((symbols.low >= 0) & (symbols.high - symbols.low <= longest))
        if not len(fits):
            break
        low, high, owner = symbols.low[fits], symbols.high[fits], symbols.doc[fits]
        of_symbol = ragged.mix(ranges.of(low, high) ^ symbols.name[fits])
        own_rank = (np.uint64(max(0, 15 - turn)) << np.uint64(60)) | (of_symbol >> np.uint64(4))
        # Contexts start at different words, so each step touches a window once at most.
        for back in range(size - int((high - low).min()) + 1):
            start = low - back
            ok = (start >= 0) & (start >= high - size)
            start, mine, r, k = start[ok], owner[ok], own_rank[ok], of_symbol[ok]
            ok = is_window[start] & (doc[start] == mine) & (r < rank[start])
            rank[start[ok]], key[start[ok]] = r[ok], k[ok]
    alone = at[rank[at] == none]
    key[alone] = ranges.of(alone, alone + size)
    return at, key[at]


PACKED = "bucket int, keys binary, docs binary, tags binary, starts binary, counts binary, prints binary"


def tag_of(text: bytes) -> int:
    """Tells rows with one doc_id and different texts apart."""
    return xxhash.xxh32_intdigest(text)


def runs_of(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, key: np.ndarray) -> np.ndarray:
    """First positions of the runs of windows that follow each other in one text and have one key."""
    n = len(start)
    if not n:
        return np.zeros(0, np.int64)
    new = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] != start[:-1] + 1) | (key[1:] != key[:-1])
    head = np.flatnonzero(np.concatenate(([True], new)))
    # A count takes 16 bits; a longer run goes on as another one.
    longer = np.diff(np.concatenate((head, [n]))) > 0xFFFF
    return np.unique(np.concatenate([head, *(np.arange(h, e, 0xFFFF) for h, e in zip(head[longer], np.concatenate((head[1:], [n]))[longer]))]))


def least_docs(key: np.ndarray, print_: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Smallest doc_id of each window's equals."""
    order = np.lexsort((doc, print_, key))
    k, p, d = key[order], print_[order], doc[order]
    first = np.concatenate(([True], (k[1:] != k[:-1]) | (p[1:] != p[:-1]))) if len(k) else np.zeros(0, bool)
    out = np.empty(len(doc), np.int64)
    out[order] = d[first][np.cumsum(first) - 1] if len(k) else d
    return out


def pack(bucket: np.ndarray, key: np.ndarray, doc: np.ndarray, tag: np.ndarray, start: np.ndarray, print_: np.ndarray) -> Iterator[tuple]:
    """One row per bucket: its runs of windows, column by column."""
    heads = runs_of(doc, tag, start, key)
    counts = np.diff(np.concatenate((heads, [len(start)])))
    order = np.argsort(bucket[heads], kind="stable")
    heads, counts = heads[order], counts[order]
    number = bucket[heads]
    cuts = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1], [True]))) if len(heads) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        h, n = heads[a:b], counts[a:b]
        yield (
            int(number[a]), (key[h] >> np.uint64(32)).astype("<u4").tobytes(), doc[h].astype("<i8").tobytes(), tag[h].astype("<u4").tobytes(),
            start[h].astype("<u4").tobytes(), n.astype("<u2").tobytes(), ragged.take_ranges(print_, h, n).astype("<u8").tobytes(),
        )


def window_prints(t: ragged.Texts, at: np.ndarray, size: int) -> np.ndarray:
    """64-bit fingerprint of each window, of another hash than the representatives'."""
    return Ranges(t.hashes, 1).of(at, at + size)


def hot_representatives(docs: DataFrame, size: int) -> np.ndarray:
    """Bitmap of HOT_SLOTS bits that has the slots of all representatives with too many windows for one task; empty if there are none. At most HOT_SLOTS / 8 bytes reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch):
                key, count = np.unique(representatives(ragged.Texts(part.column("text")), size)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(count.astype(np.int64))], ["key", "n"])

    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    counted = sample.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") * SAMPLE > HOT_WINDOWS)
    slot = F.col("key").bitwiseAND(F.lit(HOT_SLOTS - 1)) + 1  # Spark's bitmaps begin with 1
    pages = counted.groupBy(F.bitmap_bucket_number(slot).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    if not pages:
        return np.zeros(0, np.uint8)
    bitmap = np.zeros((HOT_SLOTS // 8 // PAGE, PAGE), np.uint8)
    for row in pages:
        bitmap[row.page - 1] = np.frombuffer(row.bits, np.uint8)
    return bitmap.ravel()


def refined(key: np.ndarray, print_: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The keys, those of hot representatives (and of some others that share their slots) told apart by window."""
    if not len(hot):
        return key
    slot = (key & np.uint64(HOT_SLOTS - 1)).astype(np.int64)
    is_hot = (hot[slot // 8] >> (slot % 8).astype(np.uint8)) & 1 == 1
    return np.where(is_hot, ragged.mix(key ^ ragged.mix(print_)), key)


def packed_windows(docs: DataFrame, size: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """Runs of windows by bucket of their representative. Buckets from `buckets` on hold windows that are known to start in a smaller document."""
    names = [c.split()[0] for c in PACKED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch):
                t = ragged.Texts(part.column("text"))
                at, key = representatives(t, size)
                owner = t.word_doc[at]
                doc = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)[owner]
                tags = np.array([tag_of(t.data[a:b].tobytes()) for a, b in zip(t.offsets[:-1].tolist(), t.offsets[1:].tolist())], np.uint32)
                tag, start = tags[owner], at - t.word_offsets[owner]
                print_ = window_prints(t, at, size)
                key = refined(key, print_, hot)
                later = doc > least_docs(key, print_, doc)
                rows = []
                for kept, bucket in ((~later, key % np.uint64(buckets)), (later, np.uint64(buckets) + doc.astype(np.uint64) % np.uint64(buckets))):
                    rows += pack(bucket[kept].astype(np.int64), *(x[kept] for x in (key, doc, tag, start, print_)))
                columns = zip(*rows) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 0 else pa.binary()) for k, c in enumerate(columns)], names)

    return docs.mapInArrow(run, PACKED)


def repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, tag, start, count): runs of windows of each document that also start in a document with a smaller id."""
    prepare(docs.sparkSession)
    docs = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = BUCKETS * max(1, docs.rdd.getNumPartitions())

    def settle(table: pa.Table) -> pa.Table:
        column = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        doc, tag, start, count = column("docs", "<i8"), column("tags", "<u4"), column("starts", "<u4").astype(np.int64), column("counts", "<u2").astype(np.int64)
        if table.column("bucket")[0].as_py() < buckets:
            run = np.repeat(np.arange(len(count)), count)
            key, prints = column("keys", "<u4")[run], column("prints", "<u8")
            place = start[run] + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
            owner = doc[run]
            later = owner > least_docs(key, prints, owner)
            run, place = run[later], place[later]
            head = runs_of(doc[run], tag[run], place, run)
            doc, tag, start, count = doc[run[head]], tag[run[head]], place[head], np.diff(np.concatenate((head, [len(run)])))
        return pa.table({"doc_id": pa.array(doc), "tag": pa.array(tag.astype(np.int64)), "start": pa.array(start, pa.int32()), "count": pa.array(count, pa.int32())})

    return packed_windows(docs, size, buckets, hot_representatives(docs, size)).groupBy("bucket").applyInArrow(settle, "doc_id long, tag long, start int, count int")


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every document; kept words are joined by one space."""
    hits = stash(repeats(docs, size))
    found = hits.groupBy(F.col("doc_id").alias("hit_id")).agg(F.collect_list(F.struct("tag", "start", "count")).alias("runs"))
    # Texts that lose nothing stay where they are: only those that may have a run are shuffled.
    texts = with_likely(docs.select("doc_id", "text", F.col("doc_id").cast("long").alias("_long_id")), "_long_id", hits, "doc_id", "_likely")
    met = texts.filter("_likely").join(found, F.col("_long_id") == F.col("hit_id"), "left").select("doc_id", "text", "runs")
    held = met.union(texts.filter("not _likely").select("doc_id", "text", F.lit(None).cast(found.schema["runs"].dataType).alias("runs")))
    names = ["doc_id", "n_words", "n_removed", "kept_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch):
                t = ragged.Texts(part.column("text"))
                change = np.zeros(len(t.starts) + 1, np.int64)
                runs = part.column("runs")
                for k in np.flatnonzero(runs.is_valid().to_numpy(zero_copy_only=False)).tolist():
                    tag, start, count = (c.to_numpy() for c in runs[k].values.flatten())
                    mine = tag == tag_of(t.data[t.offsets[k] : t.offsets[k + 1]].tobytes())
                    first = start[mine] + t.word_offsets[k]
                    np.add.at(change, first, 1)
                    np.add.at(change, first + count[mine] - 1 + size, -1)
                gone = np.cumsum(change[:-1]) > 0
                n_removed = ragged.sums(gone, t.word_offsets)
                # Every kept word with one byte behind it, which becomes the space.
                keep = np.flatnonzero(~gone)
                lengths = t.ends[keep] - t.starts[keep] + 1
                pool = ragged.take_ranges(np.append(t.data, np.uint8(32)), t.starts[keep], lengths)
                pool[np.cumsum(lengths) - 1] = 32
                ends = np.concatenate(([0], np.cumsum(lengths)))[np.searchsorted(keep, t.word_offsets)]
                texts = [pool[a : max(a, b - 1)].tobytes().decode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(t.n_words.astype(np.int64)), pa.array(n_removed), pa.array(texts, pa.string())], names)

    return held.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept_text string")
