"""Benchmark passages in documents: item-sized windows, SimHash fingerprints in Hamming blocks, exact weighted similarity. DataFrame functions only.

Words are lower-cased in A-Z; a shingle is five words. A window has as many words as the benchmark item it may match, or is the whole of a shorter document. It reaches
similarity s only if no more than 1 - s of the item's shingles are not in it, so any window that matters holds one of the item's
rarest shingles (`seeds`): only documents with a seed, and windows around one, get a fingerprint. That loses nothing. Fingerprints of 64 bits are cut into
RADIUS + 1 blocks; two fingerprints within RADIUS bits agree in a block, so a join on item and block, over the items whose seeds a window has, finds them all. What it finds is checked by the weighted Jaccard
similarity of the shingles, with the number of occurrences as weight. At similarity 0.8 the distance of two fingerprints is 9.7 bits on average with a deviation of 2.9; RADIUS 20 misses less than 1 in 10,000.

Null texts have no words. Documents and items without an id are left out of the links; `clean` keeps such documents. Items of fewer than five words have no shingle and match nothing. A document shorter than an item is
one window. Rows that share a doc_id are one document. Extra columns are ignored; empty tables give no links.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.shared import likely_in, prepare, stash

WORDS = 5
PERCENT = 80
RADIUS = 20
# Seeds of a benchmark are sent to every task up to this number of rows (16 bytes each); beyond, the join shuffles.
BROADCAST_SEEDS = 1_000_000
# Sums of up to this many bits fit a 16-bit lane.
LANE_LIMIT = 32_767


def words(text: str) -> Column:
    lowered = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(F.coalesce(lowered, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingles(text: str, size: int = WORDS) -> Column:
    """Hashes of all shingles of a text, in order."""

    def of(w: Column) -> Column:
        at = F.when(F.size(w) >= size, F.sequence(F.lit(1), F.size(w) - (size - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(F.slice(w, i, size)))

    # The words are the variable of an outer lambda, so that no rewrite of the plan splits the text once per shingle.
    return F.element_at(F.transform(F.array(words(text)), of), 1)


def _lane_sums(of: str) -> Column:
    """Sixteen longs, each with the counts of four bits in 16-bit lanes."""
    one_bit_in_each = F.lit(0x0001000100010001)
    shifted = lambda h, k: F.call_function("shiftright", h, k).bitwiseAND(one_bit_in_each)
    return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.aggregate(F.col(of), F.lit(0).cast("long"), lambda total, h: total + shifted(h, k)))


def _bit_sums(of: str) -> Column:
    bit = lambda h, b: F.call_function("shiftright", h, b).bitwiseAND(F.lit(1).cast("long"))
    return F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.aggregate(F.col(of), F.lit(0).cast("long"), lambda total, h: total + bit(h, b)))


def with_fingerprint(rows: DataFrame, of: str) -> DataFrame:
    """Adds the SimHash of an array of shingle hashes: a bit is set if more than half of the shingles have it, repeats counted."""
    short = F.size(of) <= LANE_LIMIT
    rows = rows.withColumn("lanes", F.when(short, _lane_sums(of)).otherwise(_bit_sums(of)))
    lane = lambda b: F.call_function("shiftright", F.element_at("lanes", (b % 16 + 1).cast("int")), ((b / 16).cast("int") * 16)).bitwiseAND(F.lit(0xFFFF).cast("long"))
    count = lambda b: F.when(short, lane(b)).otherwise(F.element_at("lanes", (b + 1).cast("int")))
    set_bit = lambda b: F.when(count(b) * 2 > F.size(of), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
    bits = F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda total, b: total.bitwiseOR(set_bit(b)))
    return rows.withColumn("fingerprint", bits).drop("lanes")


def blocks(radius: int) -> Column:
    """Number and value of the radius + 1 blocks of a fingerprint, of nearly equal widths."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    cut = lambda a, b: F.shiftrightunsigned("fingerprint", a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
    return F.explode(F.array(*(F.struct(F.lit(k).alias("block"), cut(a, b).alias("bits")) for k, (a, b) in enumerate(zip(edges, edges[1:])))))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_shingles, m): the shingles of every item that has any."""
    items = benchmark.filter("item_id is not null")
    return items.select("item_id", shingles("text").alias("item_shingles")).withColumn("m", F.size("item_shingles")).filter("m > 0")


def seeds(items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(item_id, seed): the shingle occurrences of each item that the fewest items have, one more than a similar window can lack."""
    each = items.select("item_id", "m", F.posexplode("item_shingles").alias("at", "seed"))
    common = each.groupBy("seed").agg(F.count_distinct("item_id").alias("items")).withColumnRenamed("seed", "common_seed")
    ranked = each.join(common, F.col("seed") == F.col("common_seed")).withColumn("place", F.row_number().over(Window.partitionBy("item_id").orderBy("items", "seed", "at")))
    # A window of n <= m shingles (fewer if the document is shorter) has shared / (m + n - shared) >= p/100 only if shared >= p/100 m, as shared <= n.
    return ranked.filter(F.col("place") <= F.floor(F.col("m") * (100 - percent) / 100 + 1e-9) + 1).select("item_id", "seed").distinct()


def windows(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, m, start, shingles, seen) of every item-sized window with a seed of an item of that size; `seen` are the seeds in it."""
    return windows_around(docs, items, stash(seeds(items, percent)))


def windows_around(docs: DataFrame, items: DataFrame, seed_rows: DataFrame) -> DataFrame:
    few = seed_rows.count() <= BROADCAST_SEEDS
    sided = seed_rows.select("item_id", "seed").withColumnRenamed("item_id", "seed_item")
    texts = docs.filter("doc_id is not null").select("doc_id", "text")
    found = texts.select("doc_id", F.explode(shingles("text")).alias("shingle"))
    if not few:  # most shingles are no seeds and stay out of the shuffle
        found = likely_in(found, "shingle", sided, "seed")
    hits = stash(found.join(F.broadcast(sided) if few else sided, F.col("shingle") == F.col("seed")).select("doc_id", F.col("seed_item").alias("item_id")).distinct())

    # Seeds and size of every item that a document has a seed of, put together per document and size.
    per_item = seed_rows.groupBy("item_id").agg(F.collect_set("seed").alias("item_seeds")).withColumnRenamed("item_id", "seeded_item")
    sizes = items.select("item_id", "m").distinct().withColumnRenamed("item_id", "sized_item")
    wanted = hits.join(per_item, F.col("item_id") == F.col("seeded_item")).join(sizes, F.col("item_id") == F.col("sized_item"))
    wanted = wanted.groupBy("doc_id", "m").agg(F.array_distinct(F.flatten(F.collect_list("item_seeds"))).alias("wanted")).withColumnRenamed("doc_id", "wanted_id")
    hit_ids = stash(hits.select(F.col("doc_id").alias("hit_id")).distinct())
    hit_docs = texts.join(hit_ids, F.col("doc_id") == F.col("hit_id")).select("doc_id", shingles("text").alias("all_shingles"))
    rows = hit_docs.join(wanted, F.col("doc_id") == F.col("wanted_id"))
    places = F.filter(F.sequence(F.lit(0), F.size("all_shingles") - 1), lambda i: F.array_contains(F.col("wanted"), F.element_at("all_shingles", i + 1)))
    last = F.greatest(F.size("all_shingles") - F.col("m"), F.lit(0))
    starts = F.array_distinct(F.flatten(F.transform(places, lambda i: F.sequence(F.least(F.greatest(i - F.col("m") + 1, F.lit(0)), last), F.least(i, last)))))
    rows = rows.select("doc_id", "m", "all_shingles", "wanted", F.explode(starts).alias("start"))
    rows = rows.select("doc_id", "m", "start", F.slice("all_shingles", F.col("start") + 1, F.col("m")).alias("shingles"), "wanted")
    return rows.withColumn("seen", F.array_intersect("shingles", "wanted")).drop("wanted")


def shared(a: str, b: str) -> Column:
    """Weighted size of the intersection of two bags of shingles."""
    times = lambda bag, x: F.size(F.filter(F.col(bag), lambda y: y == x))
    both = F.array_intersect(a, b)
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(plain, F.size(both)).otherwise(F.aggregate(both, F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x)))).cast("long")


def block_pairs(found: DataFrame, items: DataFrame, seed_rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(item_id, m, fingerprint, item_print): fingerprints of windows and the items they share a seed and a Hamming block with.

    Blocks of 64 bits for a radius of 20 are three bits wide, so most unrelated prints agree in one: blocks alone do not prune. A window that may match an item holds one of its seeds, so it is looked up
    among the blocks of the items of its seeds only, and the number of rows follows the seeds that occur, not the number of items.
    """
    sizes = items.select(F.col("item_id").alias("seed_item"), F.col("m").alias("seed_m")).distinct()
    sided = seed_rows.withColumnRenamed("item_id", "of_item").join(sizes, F.col("of_item") == F.col("seed_item")).select("seed", "seed_item", "seed_m")
    # Copies of a passage share fingerprints and seeds, so each is looked up once.
    prints = found.select("m", "fingerprint", F.explode("seen").alias("in_window")).distinct()
    prints = prints.join(sided, (F.col("in_window") == F.col("seed")) & (F.col("m") == F.col("seed_m"))).select(F.col("seed_item").alias("item_id"), "m", "fingerprint").distinct()
    prints = prints.select("item_id", "m", "fingerprint", blocks(radius).alias("b")).select("item_id", "m", "fingerprint", "b.*")
    known = items.select(F.col("item_id").alias("known_item"), F.col("m").alias("item_m"), "fingerprint", blocks(radius).alias("c"))
    known = known.select("known_item", "item_m", F.col("fingerprint").alias("item_print"), F.col("c.block").alias("item_block"), F.col("c.bits").alias("item_bits"))
    alike = (F.col("item_id") == F.col("known_item")) & (F.col("m") == F.col("item_m")) & (F.col("block") == F.col("item_block")) & (F.col("bits") == F.col("item_bits"))
    return prints.join(known, alike).select("item_id", "m", "fingerprint", "item_print")


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, n_windows, start_word, similarity) of every document and benchmark item of which it has a window similar enough; start and similarity are those of the best window."""
    prepare(docs.sparkSession)
    items = stash(with_fingerprint(benchmark_items(benchmark), "item_shingles"))
    seed_rows = stash(seeds(items, percent))
    found = stash(with_fingerprint(windows_around(docs, items, seed_rows), "shingles"))
    near = block_pairs(found, items, seed_rows, radius).filter(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= radius)
    near = near.select("item_id", F.col("m").alias("near_m"), F.col("fingerprint").alias("near_print")).distinct()
    pairs = found.join(near, (F.col("m") == F.col("near_m")) & (F.col("fingerprint") == F.col("near_print")))
    bags = items.select(F.col("item_id").alias("bag_item"), "item_shingles")
    pairs = pairs.join(bags, F.col("item_id") == F.col("bag_item"))
    both = pairs.withColumn("both", shared("shingles", "item_shingles")).withColumn("either", F.size("shingles") + F.size("item_shingles") - F.col("both"))
    similar = both.filter(100 * F.col("both") >= percent * F.col("either")).withColumn("similarity", F.col("both") / F.col("either"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("minus_start")))
    grouped = similar.groupBy("doc_id", "item_id").agg(F.count_distinct("start").alias("n_windows"), best.alias("best"))
    return grouped.select("doc_id", "item_id", "n_windows", (-F.col("best.minus_start")).cast("long").alias("start_word"), F.col("best.similarity").alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """The documents that have no passage of the benchmark."""
    gone = stash(leaks(docs, benchmark, percent, radius).select(F.col("doc_id").alias("gone_id")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
