"""Quality rules whose limits adapt to each language and source.

Counts per document come from whole texts. Every ratio goes into a log-linear quantile sketch per (language, source): counts per
bucket, where a bucket spans a 32nd of its value. Sketches merge by adding counts, so the result does not depend on
partitions or order. The limit of a rule is a fence above the upper quartile of the sketch. Groups of fewer than
`min_rows` documents take the merged sketch of their language, or else of the corpus. Documents are then joined with the limits of their group.

Null or empty text: no words, so the base rules fail it. A null language or source is a group of its own. Repeated rows are judged one by
one. An empty table gives an empty result. Only doc_id, text, lang and source are read; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm import ragged
from tallyloom.llm.shared import prepare, same, stash

COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_upper long, n_exclaim long"
SYMBOLS = ragged.byte_set(b"#*$%&|<>")
UPPER = ragged.byte_set(bytes(range(65, 91)))
# Rule -> (numerator, denominator, slack): thousandths of the denominator; the slack is added to the fence, so that
# a group whose documents are all alike does not lose those that differ a little.
RULES = {
    "symbols": ("n_symbols", "n_words", 100),
    "dup_lines": ("n_dup_lines", "n_lines", 250),
    "repeats": ("n_repeat_words", "n_words", 150),
    "upper": ("n_upper", "word_chars", 150),
    "exclaims": ("n_exclaim", "n_words", 150),
    "word_length": ("word_chars", "n_words", 4000),
}
FENCE = 3
MIN_ROWS = 50
WINDOW = 5


def repeated_words(texts: ragged.Texts, size: int = WINDOW) -> np.ndarray:
    """Words of each text inside a window of `size` words that the text has twice or more."""
    at = texts.window_starts(size)
    if not len(at):
        return np.zeros(texts.count, np.int64)
    doc = texts.word_doc[at]
    key = ragged.mix(ragged.windows(texts.hashes, size)[at] ^ ragged.mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    alike = key[order][1:] == key[order][:-1]
    a, b = at[order[1:][alike]], at[order[:-1][alike]]
    twice = np.zeros(len(texts.starts) + 1, np.int64)
    if all((texts.ids[a + k] == texts.ids[b + k]).all() for k in range(size)) and (texts.word_doc[a] == texts.word_doc[b]).all():
        found = np.unique(np.concatenate((a, b)))
    else:  # two windows share a hash: compare the words themselves
        rows = np.stack([doc, *(texts.ids[at + k] for k in range(size))], axis=1)
        _, group, n = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        found = at[n[group.reshape(-1)] > 1]
    np.add.at(twice, found, 1)
    np.add.at(twice, found + size, -1)
    return ragged.sums(np.cumsum(twice[:-1]) > 0, texts.word_offsets)


def count_batch(column: pa.Array) -> list[np.ndarray]:
    t = ragged.Texts(column)
    lead = (t.data & 0xC0) != 0x80
    ids, doc = t.lines()
    distinct = np.unique(doc * (ids.max() + 1 if len(ids) else 1) + ids)
    n_lines = np.bincount(doc, minlength=t.count)
    kinds = np.bincount(distinct // (ids.max() + 1), minlength=t.count) if len(ids) else np.zeros(t.count, np.int64)
    per_text = [t.n_words, *(ragged.sums(x, t.offsets) for x in (lead & ~t.white, SYMBOLS[t.data])), n_lines, n_lines - kinds, repeated_words(t)]
    return [x.astype(np.int64) for x in (*per_text, ragged.sums(UPPER[t.data], t.offsets), ragged.sums(t.data == 33, t.offsets))]


def text_counts(docs: DataFrame) -> DataFrame:
    """One row per document with its counts, without the text."""
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "lang", "source", "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, source string, {COUNTS}"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch):
                kept = [part.column(c) for c in ("doc_id", "lang", "source")]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x) for x in count_batch(part.column("text")))], names)

    return docs.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def ratio(name: str) -> Column:
    top, below, _ = RULES[name]
    return F.when(F.col(below) > 0, F.expr(f"{top} * 1000 div {below}")).otherwise(F.lit(0).cast("long"))


def sketch(counts: DataFrame) -> DataFrame:
    """Rows (lang, source, rule, bucket, n): the bucket counts of every group."""
    values = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), ratio(r).alias("value")) for r in RULES)))
    cells = counts.filter(~base_failed()).select("lang", "source", values.alias("cell")).select("lang", "source", "cell.*")
    power = "greatest(length(bin(value)) - 6, 0)"
    return cells.withColumn("bucket", F.expr(f"{power} * 32 + shiftright(value, {power})")).groupBy("lang", "source", "rule", "bucket").agg(F.count("*").alias("n"))


def fences(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, rule, rows, fence): the upper limit that the merged sketch of each group gives."""
    merged = buckets.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rule")
    merged = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("rows", F.sum("n").over(group))
    power = "greatest(bucket div 32 - 1, 0)"
    top = F.expr(f"shiftleft(bucket - {power} * 32 + 1, cast({power} as int)) - 1")
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("rows") * q, top))
    found = merged.groupBy(*keys, "rule").agg(F.max("rows").alias("rows"), quartile(1).alias("q1"), quartile(3).alias("q3"))
    slack = F.create_map(*(F.lit(x) for r, (_, _, s) in RULES.items() for x in (r, s)))
    return found.select(*keys, "rule", "rows", (F.col("q3") + FENCE * (F.col("q3") - F.col("q1")) + slack[F.col("rule")]).alias("fence"))


def limits(buckets: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per (lang, source) with a map from rule to limit."""
    own, by_lang, by_all = (fences(buckets, k) for k in (["lang", "source"], ["lang"], []))
    by_lang = by_lang.select(F.col("lang").alias("l_lang"), F.col("rule").alias("l_rule"), F.col("rows").alias("l_rows"), F.col("fence").alias("l_fence"))
    by_all = by_all.select(F.col("rule").alias("a_rule"), F.col("fence").alias("a_fence"))
    joined = own.join(by_lang, same(F.col("lang"), F.col("l_lang")) & (F.col("rule") == F.col("l_rule"))).join(by_all, F.col("rule") == F.col("a_rule"))
    chosen = F.when(F.col("rows") >= min_rows, F.col("fence")).when(F.col("l_rows") >= min_rows, F.col("l_fence")).otherwise(F.col("a_fence"))
    return joined.groupBy(F.col("lang").alias("g_lang"), F.col("source").alias("g_source")).agg(F.map_from_entries(F.collect_list(F.struct("rule", chosen))).alias("limits"))


def judge(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Every document with its counts, `base_failed`, `kept` and the names of the adaptive rules it breaks."""
    counts = stash(text_counts(docs))
    bounds = limits(stash(sketch(counts)), min_rows)
    joined = counts.join(bounds, same(F.col("lang"), F.col("g_lang")) & same(F.col("source"), F.col("g_source")), "left")
    broken = F.array_compact(F.array(*(F.when(ratio(r) > F.col("limits")[r], F.lit(r)) for r in RULES)))
    failed = base_failed()
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & (F.size(broken) == 0)).alias("kept"),
        F.array_join(broken, ",").alias("broken_rules"), "lang", "source", "n_lines", "n_upper", "n_exclaim",
    )
