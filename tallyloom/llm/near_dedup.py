"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

A document is the set of its distinct word shingles. Equal sets are one node from the start. Signatures of BANDS x ROWS hashes are banded; the members of a
bucket are candidates. In a bucket, signatures are compared batch by batch; after each batch a pair goes if, given its matches so far and a uniform prior, the
posterior probability that its similarity reaches the threshold is below MISS. What survives groups nodes into clusters, and in every
cluster the full shingle sets decide which nodes are linked. Both steps search outwards from a node among those not reached yet, so a group of near-alike
texts costs about its size rather than its square, and give out one link per node reached, never all pairs. A bucket or cluster too large for one task is dealt into parts, twice by different hashes, which joins
the bulk of it; only what is then outside its largest component is searched against all its parts. If even that is too much for one task, the members are unlike, as texts with
one header are: the group is split by 35 bands of four hashes, and splits whose members are not joined yet are searched. Nothing is capped.

A pair at the threshold shares no band with probability (1 - 0.8**5)**28 = 1.5e-5, and no band of a split with (1 - 0.8**4)**35 = 1e-8; shingles are compared by 64-bit hashes.

Words are lower-cased in A-Z only. A text shorter than a shingle has its whole word sequence as its one shingle. Null text or text without words has an empty set, is linked with nothing and stays. Rows that share a
doc_id count as one document for the ids reported. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import ragged
from tallyloom.llm.components import components
from tallyloom.llm.shared import likely_in, prepare, stash

BANDS, ROWS = 28, 5
HASHES = BANDS * ROWS
BATCH = 20
MISS = 1e-5
# What one task holds at once: signatures of a bucket, shingles of a cluster.
BUCKET_NODES = 20_000
CLUSTER_SHINGLES = 4_000_000
# Bands that split a team too large for one task: four hashes each, from four different bands of the first kind.
SPLITS = HASHES // 4

_random = np.random.default_rng(20)
FLIPS = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32)
FACTORS = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    t = ragged.Texts(column, lower=True)
    every = ragged.windows(t.hashes, words)
    sets = []
    for a, b in zip(t.word_offsets[:-1].tolist(), t.word_offsets[1:].tolist()):
        if b - a >= words:
            sets.append(np.unique(every[a : b - words + 1]))
        elif b > a:
            sets.append(ragged.windows(t.hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low 16 bits of each least hash."""
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(low), 2048):
        np.minimum(least, (((low[k : k + 2048, None] ^ FLIPS) * FACTORS)).min(axis=0), out=least)
    return (least & 0xFFFF).astype("<u2")


def least_matches(share: float, miss: float = MISS) -> list[int]:
    """For each number of hashes compared, the fewest matches at which a pair stays.

    With a uniform prior, P(similarity >= share | m of h match) = P(Binomial(h + 1, share) <= m).
    """
    found = []
    for h in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(h + 1, m) * share**m * (1 - share) ** (h + 1 - m)
        found.append(m)
    return found


def search(n: int, reaches: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, np.ndarray]]:
    """From each root, the nodes that can be reached; `reaches` says which of the given nodes a node is linked to. Only nodes not reached yet are looked at."""
    rest, stars = np.arange(n), []
    while len(rest) > 1:
        root, rest, pending, reached = int(rest[0]), rest[1:], [int(rest[0])], []
        while pending and len(rest):
            hit = reaches(pending.pop(), rest)
            if hit.any():
                new = rest[hit]
                reached.append(new)
                pending.extend(new.tolist())
                rest = rest[~hit]
        if reached:
            stars.append((root, np.concatenate(reached)))
    return stars


def similar_signatures(signatures: np.ndarray, bounds: list[int]) -> list[tuple[int, np.ndarray]]:
    def reaches(i: int, others: np.ndarray) -> np.ndarray:
        at = np.arange(len(others))
        matches = np.zeros(len(others), np.int64)
        for k, bound in enumerate(bounds):
            cut = slice(k * BATCH, (k + 1) * BATCH)
            matches = matches + (signatures[others[at], cut] == signatures[i, cut]).sum(axis=1)
            stay = matches >= bound
            at, matches = at[stay], matches[stay]
        hit = np.zeros(len(others), bool)
        hit[at] = True
        return hit

    return search(len(signatures), reaches)


def similar_sets(sets: list[np.ndarray], percent: int) -> list[tuple[int, np.ndarray]]:
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(int(flat.max()) + 1, bool)
    pool: dict[str, np.ndarray] = {"of": np.zeros(0, np.int64)}

    def reaches(i: int, others: np.ndarray) -> np.ndarray:
        if len(pool["of"]) != len(others):  # the rest has shrunk
            pool.update(of=others, flat=ragged.take_ranges(flat, starts[others], sizes[others]), bounds=np.concatenate(([0], np.cumsum(sizes[others]))))
        own = flat[starts[i] : starts[i] + sizes[i]]
        mark[own] = True
        both = ragged.sums(mark[pool["flat"]], pool["bounds"])
        mark[own] = False
        return 100 * both >= percent * (sizes[i] + sizes[others] - both)

    return search(len(sets), reaches)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by an integer key, cut so that no group is torn, with the offsets of the groups."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        start = int(np.searchsorted(keys, keys[-1]))
        if last is not None and (start > 0 or keys[0] != last):
            cut = start if start > 0 else 0
            yield _with_groups([*held, batch.slice(0, cut)] if cut else held, key)
            held = []
        elif last is None and start > 0:
            yield _with_groups([batch.slice(0, start)], key)
        held.append(batch.slice(start))
        last = keys[-1]
    if held:
        yield _with_groups(held, key)


def _with_groups(batches: list[pa.RecordBatch], key: str) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    keys = table.column(key).to_numpy()
    return table, np.concatenate((np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))), [len(keys)]))


def searched(rows: DataFrame, payload: str, find: Callable[[list[bytes]], list[tuple[int, np.ndarray]]]) -> DataFrame:
    """Links (a, b) that `find` gives for the payloads of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in whole_groups(batches, "task"):
            ids, held = table.column("node").to_pylist(), table.column(payload)
            links = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                for root, found in find(held.slice(a, b - a).to_pylist()):
                    links += [(ids[a + root], ids[a + k]) for k in found.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["a", "b"])

    return rows.select("task", "node", payload).repartition("task").sortWithinPartitions("task").mapInArrow(run, "a binary, b binary")


def layout(rows: DataFrame, limit: int) -> DataFrame:
    """(large_team, main_label, parts, rest_parts) of the teams in rows (node, team, own, label): the label of most nodes, and the parts of `limit` that the
    team and what lies outside that label fill. Teams of one label are left out, because their nodes are joined already."""
    sizes = rows.groupBy("team", "label").agg(F.count("*").alias("n"), F.sum("own").alias("weight"))
    teams = sizes.groupBy("team").agg(F.max(F.struct("n", "label", "weight")).alias("main"), F.sum("weight").alias("weight"))
    parts, rest = F.ceil(F.col("weight") / limit), F.ceil((F.col("weight") - F.col("main.weight")) / limit)
    found = teams.select(F.col("team").alias("large_team"), F.col("main.label").alias("main_label"), parts.cast("int").alias("parts"), rest.cast("int").alias("rest_parts"))
    return stash(found.filter("rest_parts > 0"))


def part(salt: int, of: str) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(of)).cast("int")


def blocks(rows: DataFrame, payload: str) -> DataFrame:
    """Rows (node, task, payload) in which every node outside its team's main label meets all of the team."""
    every = rows.withColumn("j", part(3, "parts")).withColumn("u", F.explode(F.sequence(F.lit(0), F.col("rest_parts") - 1)))
    outside = rows.filter(F.col("label") != F.col("main_label")).withColumn("u", part(4, "rest_parts")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    both = every.select("node", "team", "j", "u", payload).union(outside.select("node", "team", "j", "u", payload))
    return both.withColumn("task", F.xxhash64("team", "u", "j"))


def split_teams(rows: DataFrame) -> DataFrame:
    """(node, team, own, label, of, total): teams split by SPLITS bands of hashes; those of one label are left out. `of` is the team before."""
    keys = F.array(*(F.xxhash64(F.lit(k), F.concat(*(F.substring("signature", 1 + 2 * h, 2) for h in range(k, HASHES, SPLITS)))) for k in range(SPLITS)))
    split = rows.select("node", F.col("team").alias("of"), "own", "label", F.explode(keys).alias("band")).withColumn("team", F.xxhash64("of", "band")).drop("band")
    mixed = split.groupBy("team").agg(F.sum("own").alias("total"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
    mixed = stash(mixed.select(F.col("team").alias("mixed_team"), "total"))
    return stash(split.join(mixed.hint("merge"), F.col("team") == F.col("mixed_team")).drop("mixed_team"))


def search_groups(rows: DataFrame, payload: str, limit: int, find: Callable[[list[bytes]], list[tuple[int, np.ndarray]]]) -> DataFrame:
    """Links (a, b) within every group of rows (node, team, own, total, signature, payload), enough to join all that are linked; a task holds payloads of about `limit` at most.

    `own` is the weight of a row and `total` that of its team. Teams up to the limit are searched whole. Larger ones are dealt into parts twice. What is
    then outside the largest component meets the whole team, if it fits in one task; if not, the team is split by further bands first, so that members which are
    unlike part company.
    """
    links = searched(rows.filter(F.col("total") <= limit).withColumn("task", F.xxhash64("team")), payload, find)
    large = rows.filter(F.col("total") > limit).withColumn("dealt", F.ceil(F.col("total") / limit).cast("int"))
    if large.isEmpty():
        return links
    large = stash(large)
    rounds = [stash(searched(large.withColumn("task", F.xxhash64("team", F.lit(k), part(k, "dealt"))), payload, find)) for k in (1, 2)]
    bulk = rounds[0].union(rounds[1])
    labels = stash(components(bulk)).withColumnRenamed("node", "labelled")
    large = stash(large.drop("total", "dealt").join(labels, F.col("node") == F.col("labelled"), "left").withColumn("label", F.coalesce("component", "node")).drop("labelled", "component"))
    links = links.union(bulk)
    # Only teams whose rest fills several tasks are split: beside one task the work is in proportion to the team.
    placed = large.join(layout(large, limit), F.col("team") == F.col("large_team"))
    links = links.union(searched(blocks(placed.filter("rest_parts = 1"), payload), payload, find))
    mixed = placed.filter("rest_parts > 1").drop("large_team", "main_label", "parts", "rest_parts")
    if mixed.isEmpty():
        return links
    members = split_teams(mixed)
    payloads = mixed.select(F.col("node").alias("held_node"), F.col("team").alias("held_team"), payload)
    held = members.join(payloads, (F.col("node") == F.col("held_node")) & (F.col("of") == F.col("held_team")))
    small = searched(held.filter(F.col("total") <= limit).withColumn("task", F.xxhash64("team")), payload, find)
    still = layout(members.filter(F.col("total") > limit), limit)
    last = searched(blocks(held.join(still, F.col("team") == F.col("large_team")), payload), payload, find)
    return links.union(small).union(last)


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, node, signature): the node is a 128-bit digest of the shingle set, null if that is empty."""
    docs = docs.select("doc_id", "text")
    names = ["doc_id", "n_shingles", "node", "signature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch):
                sets = shingle_sets(part.column("text"), words)
                nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                signatures = [signature(s).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(map(len, sets), pa.int64()), pa.array(nodes, pa.binary()), pa.array(signatures, pa.binary())], names)

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, node binary, signature binary")


def candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes whose signatures agree well enough; stars, not all pairs."""
    keys = F.array(*(F.xxhash64(F.lit(k), F.substring("signature", 1 + 2 * ROWS * k, 2 * ROWS)) for k in range(BANDS)))
    rows = stash(nodes.select("node", F.explode(keys).alias("bucket")))
    full = stash(rows.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1").withColumnRenamed("bucket", "full_bucket"))
    # Both sides grow with the input: shuffled at every size, so that the plan is the same.
    members = rows.join(full.hint("merge"), F.col("bucket") == F.col("full_bucket")).drop("full_bucket")
    signed = members.join(nodes.select(F.col("node").alias("signed_node"), "signature"), F.col("node") == F.col("signed_node"))
    rows = signed.select("node", F.col("bucket").alias("team"), F.lit(1).cast("long").alias("own"), F.col("members").alias("total"), "signature")
    bounds = least_matches(percent / 100)

    def find(signatures: list[bytes]) -> list[tuple[int, np.ndarray]]:
        return similar_signatures(np.frombuffer(b"".join(signatures), "<u2").reshape(-1, HASHES), bounds)

    return search_groups(rows, "signature", BUCKET_NODES, find)


def verified(docs: DataFrame, sketches: DataFrame, clusters: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that the full shingle sets confirm within every cluster."""
    sized = sketches.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    sized = sized.join(clusters.withColumnRenamed("node", "member"), F.col("node") == F.col("member")).drop("member")
    total = stash(sized.groupBy("component").agg(F.sum("n_shingles").alias("total")).withColumnRenamed("component", "team"))
    wanted = stash(sized.join(total, F.col("component") == F.col("team")).drop("component").withColumnRenamed("n_shingles", "own"))

    # Few documents are in clusters, so the others are kept from the shuffle first.
    ids = stash(wanted.select("first_id").distinct())
    texts = likely_in(docs.select("doc_id", "text"), "doc_id", ids, "first_id").join(ids, F.col("doc_id") == F.col("first_id")).select("text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch):
                found = [s for s in shingle_sets(part.column("text"), words) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())], ["set_node", "shingles"])

    known = texts.mapInArrow(sets, "set_node binary, shingles binary")
    rows = wanted.hint("merge").join(known, F.col("node") == F.col("set_node")).select("node", "team", "own", "total", "signature", "shingles")

    def find(shingles: list[bytes]) -> list[tuple[int, np.ndarray]]:
        return similar_sets([np.frombuffer(x, np.uint64) for x in shingles], percent)

    return search_groups(rows, "shingles", CLUSTER_SHINGLES, find)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document; the component is its smallest doc_id, and that document stays."""
    prepare(docs.sparkSession)
    sketches = stash(sketch(docs, words))
    nodes = stash(sketches.filter("node is not null").groupBy("node").agg(F.first("signature").alias("signature")))
    clusters = stash(components(candidates(nodes, percent)))
    groups = components(verified(docs, sketches, clusters, words, percent)).withColumnRenamed("node", "member")
    labelled = stash(sketches.drop("signature").join(groups, F.col("node") == F.col("member"), "left").select("doc_id", "n_shingles", F.coalesce("component", "node").alias("label")))
    # Written before it is joined, so that the join is between two shuffles and Spark can split the rows of a large group.
    least = stash(labelled.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least_id")).withColumnRenamed("label", "least_label"))
    joined = labelled.join(least, F.col("label") == F.col("least_label"), "left").withColumn("component_id", F.coalesce("least_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that have a near duplicate of smaller doc_id in their group."""
    gone = stash(near_duplicates(docs, words, percent).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
