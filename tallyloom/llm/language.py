"""Language by rank-order profiles.

The n-grams of one to three letters of a text are ranked by how often they occur. A language's profile holds the first PROFILE n-grams of all its learning texts; a document's
profile, its own first PROFILE. The out-of-place distance sums, over the document's n-grams, how far apart the two ranks are, or PROFILE where the language's profile lacks the n-gram. The language
with the least distance is predicted; ties go to the first name. The score is 1 less the distance's share of the greatest distance possible.

Letters are characters of a Unicode letter category, in lower case (a letter whose lower case is several characters stays as it is). Everything else separates words, and a word's n-grams of two and three
characters include one separator at either end. Ties of rank: shorter n-grams first, then by code points.

Counts of all learning texts are summed by Spark. Profiles are sent to the tasks in groups of LANGUAGES languages, at most PROFILE rows for each; with more languages, documents are compared with one group after the other.

Null text, or text without a letter: `und`, score 0. Null languages are not learned; without any learned language every prediction is `und`. Repeated rows get equal results, texts of any length are read whole,
empty tables give empty results, and only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm import ragged
from tallyloom.llm.shared import prepare, stash

PROFILE = 300
# Languages whose profiles a task holds at a time.
LANGUAGES = 500
UNKNOWN = "und"
# Code of the separator of words: below every letter; 0 fills up short n-grams.
GAP = 1
BITS = 21
SEEN = 500_000


class Letters:
    """Code point -> code of its lower-case letter, or GAP; filled as characters are met."""

    def __init__(self):
        self.codes, self.known = np.full(0x110000, GAP, np.int64), np.zeros(0x110000, bool)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        present = np.flatnonzero(np.bincount(points, minlength=1))
        for p in present[~self.known[present]].tolist():
            char = chr(p)
            if char.isalpha():
                low = char.lower()
                self.codes[p] = ord(low) if len(low) == 1 else p
            self.known[p] = True
        return self.codes[points]


def grams(column: pa.Array, letters: Letters, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, n-gram), sorted, with how often each occurs. An n-gram's code is three characters of BITS bits, so codes sort by length and then by code points.

    `of` numbers the documents; several with one number are counted as one.
    """
    column = pc.fill_null(column, "")
    lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(column.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    # Each text begins and ends with a separator; of several in a row the first is kept.
    doc = np.repeat(np.arange(len(column)) if of is None else of, lengths + 2)
    stops = np.cumsum(lengths + 2)
    inside = np.ones(len(doc), bool)
    inside[stops - 1] = inside[stops - lengths - 2] = False
    code = np.full(len(doc), GAP, np.int64)
    code[inside] = letters(points)
    letter = code != GAP
    held = letter.copy()
    held[1:] |= letter[:-1]
    held[stops - lengths - 2] = True
    code, doc, letter, edge = code[held], doc[held], letter[held], np.cumsum(held)[stops - lengths - 2] - 1
    first = np.zeros(len(code) + 1, bool)
    first[edge] = True
    first[-1] = True
    # Characters by number among those that occur, so that a document and an n-gram fit one integer, which sorts fast.
    present = np.flatnonzero(np.bincount(code, minlength=GAP + 1))
    dense = np.zeros(int(present[-1]) + 1 if len(present) else 1, np.int64)
    dense[present] = np.arange(1, len(present) + 1)
    x, base = dense[code], len(present) + 1
    pair = (letter[1:] | letter[:-1]) & ~first[1:-1]
    triple = letter[1:-1] & ~first[1:-2] & ~first[2:-1]
    two = x[:-1] * base + x[1:]
    three = two[:-1] * base + x[2:]
    lead = doc * base**3
    key = np.sort(np.concatenate(((lead + x)[letter], (lead[:-1] + two)[pair], (lead[:-2] + three)[triple])))
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    times, key = np.diff(np.concatenate((at, [len(key)]))), key[at]
    char = np.concatenate(([0], present))
    code = (char[key // base**2 % base] << 2 * BITS) | (char[key // base % base] << BITS) | char[key % base]
    return key // base**3, code, times


def ranked(doc: np.ndarray, code: np.ndarray, times: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first `size` n-grams of each document, with their ranks from 0; takes and gives rows sorted by document."""
    if not len(doc):
        return doc, code, times
    most, n = int(times.max()), len(doc)
    order = np.sort((doc * (most + 1) + most - times) * n + np.arange(n)) % n
    doc, code = doc[order], code[order]
    starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    rank = np.arange(n) - np.repeat(starts, np.diff(np.concatenate((starts, [n]))))
    kept = rank < size
    return doc[kept], code[kept], rank[kept]


def profiles(texts: DataFrame, size: int = PROFILE) -> DataFrame:
    """(lang, gram, rank): the first n-grams of each language over all rows of (text, lang)."""
    prepare(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, names, held, n_held = Letters(), {}, [], 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            lang, code, times = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((code, lang))
            lang, code, times = lang[order], code[order], times[order]
            edge = np.flatnonzero(np.concatenate(([True], (lang[1:] != lang[:-1]) | (code[1:] != code[:-1]))))
            return lang[edge], code[edge], np.add.reduceat(times, edge)

        def emit() -> Iterator[pa.RecordBatch]:
            listed = pa.array(list(names), pa.string())
            for lang, code, times in held:
                yield pa.RecordBatch.from_arrays([listed.take(pa.array(lang)), pa.array(code), pa.array(times)], ["lang", "gram", "n"])

        for batch in batches:
            for part in ragged.slices(batch):
                of = np.array([names.setdefault(x, len(names)) for x in part.column("lang").to_pylist()], np.int64)
                found = grams(part.column("text"), letters, of)
                if len(found[1]):
                    held.append(found)
                    n_held += len(found[1])
                if n_held > SEEN:
                    held = [merged()]
                    n_held = len(held[0][1])
                    if n_held > SEEN // 2:
                        yield from emit()
                        held, n_held = [], 0
        if held:
            held = [merged()]
            yield from emit()

    sums = texts.filter("lang is not null").select("text", "lang").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return sums.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < size).select("lang", "gram", "rank")


class Profiles:
    """Profiles of some languages as one sorted list of n-grams with a row of ranks for each."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.langs, self.size = sorted({r[0] for r in rows}), size
        self.grams = np.unique(np.array([r[1] for r in rows], np.int64))
        self.ranks = np.full((len(self.grams), len(self.langs)), -1, np.int32)
        at = {lang: k for k, lang in enumerate(self.langs)}
        self.ranks[np.searchsorted(self.grams, [r[1] for r in rows]), [at[r[0]] for r in rows]] = [r[2] for r in rows]

    def distances(self, doc: np.ndarray, code: np.ndarray, rank: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Language and distance of the best profile for each of n documents."""
        spot = np.minimum(np.searchsorted(self.grams, code), len(self.grams) - 1)
        known = self.grams[spot] == code
        starts = np.searchsorted(doc, np.arange(n + 1))
        total = np.empty((n, len(self.langs)), np.int64)
        for k in range(len(self.langs)):
            theirs = self.ranks[spot, k]
            total[:, k] = ragged.sums(np.where(known & (theirs >= 0), np.abs(theirs - rank), self.size), starts)
        best = total.argmin(axis=1)
        return best, total[np.arange(n), best]


BEST = "lang_pred string, distance long, most long"


def compared(docs: DataFrame, rows: list[tuple[str, int, int]], size: int) -> DataFrame:
    """docs with the best of these profiles and what docs had before: language, distance, and the greatest distance possible (0: no letter)."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "distance", "most")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept), BEST])
    before = len(kept) < len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, held = Letters(), Profiles(rows, size)
        listed = np.array(held.langs, object)
        for batch in batches:
            for part in ragged.slices(batch):
                n = part.num_rows
                doc, code, rank = ranked(*grams(part.column("text"), letters), size)
                best, distance = held.distances(doc, code, rank, n)
                lang = listed[best]
                if before:
                    old, was = part.column("lang_pred").to_pylist(), part.column("distance").to_numpy()
                    stays = np.array([d < e or (d == e and o < x) for d, e, o, x in zip(was, distance, old, lang)], bool)
                    lang, distance = np.where(stays, np.array(old, object), lang), np.where(stays, was, distance)
                most = np.bincount(doc, minlength=n) * size
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(lang, pa.string()), pa.array(distance), pa.array(most)], [*kept, "lang_pred", "distance", "most"])

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, keys: list[str], learned: DataFrame, size: int = PROFILE, group: int = LANGUAGES) -> DataFrame:
    """The key columns of docs, with lang_pred and score; `learned` has the rows of profiles()."""
    prepare(docs.sparkSession)
    learned = stash(learned)
    found = docs.select(*(F.col(c).alias(f"_key_{c}") for c in keys), "text")
    back = [F.col(f"_key_{c}").alias(c) for c in keys]
    # Languages in groups by hash, each small enough for a task; their number is all that the driver takes of them.
    groups = max(1, -(-learned.select("lang").distinct().count() // group))
    for g in range(groups):
        rows = [tuple(r) for r in learned.filter(F.pmod(F.xxhash64("lang"), F.lit(groups)) == g).select("lang", "gram", "rank").collect()]
        if rows:
            found = compared(found, rows, size) if g == 0 else compared(stash(found), rows, size)
    if "most" not in found.columns:
        return found.select(*back, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    lettered = F.col("most") > 0
    score = F.when(lettered, 1 - F.col("distance") / F.col("most")).otherwise(0.0)
    return found.select(*back, F.when(lettered, F.col("lang_pred")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"))


def held_out() -> Column:
    """Rows whose language is not learned, by the checksum of their id; a null id is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def predicted(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, with profiles from those that are not held out."""
    learned = profiles(docs.filter(~held_out()))
    return identify(docs, ["doc_id"], learned).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
