"""Secrets with corpus-wide ownership, in DataFrame functions only.

Every text is cut by three base patterns and by patterns of other credential shapes. A match starts after the gaps and matches before it, so the pieces
between matches (split) and the matches (extract all) give code point offsets without any Python. The hashes of the matched values are counted over the corpus by
distinct documents (repositories) and distinct sources (owners). A value that more than `max_owners` owners or more than `max_repos` repositories have is a copied example; any other is
specific to its owners and looks live. Spans of the other shapes are added only where they look live; base spans always stay. The value of a private key is what follows its header
line; a header line with nothing behind it says nothing about its owners and always stays.

Null text is empty: no spans. A null source counts as one owner of its own. Repeated rows are reported one by one, and count as one document for ownership if they share the
doc_id. An empty table gives an empty result. Hot values are pre-aggregated by (value, owner, document) and (value, owner) before they meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.shared import prepare, stash

MAX_OWNERS = 2
# A key in use lies in a few files of its project; what more documents have is an example, even if all of them are of one owner.
MAX_REPOS = 10
KEYWORD = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
# Kind -> (pattern, group that holds the value, least characters of the value). For access and hex the runs are maximal, so a least length in the pattern finds what
# a filter behind it would.
BASE = {
    "assign": (KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),
}
# A private key: header line, then as the value a few lines like "DEK-Info: ..." and base64 up to the footer. Where the footer is cut off, the value is base64 up to the end of the
# text, or else up to the first space behind its first line. Line ends may be written as \n, and lines may be quoted. No class has "-" and none is repeated in a group, so the time is linear.
_BREAK = r"""[\x20\x09-\x0D\\nr"'>,]{1,8}"""
_LINES = r"""A-Za-z0-9+/=\x09-\x0D\\"'>,"""
_FIRST = rf"{_BREAK}[A-Za-z0-9+/]{{16}}"
PEM = (
    rf"-----BEGIN [A-Z ]*PRIVATE KEY-----((?:{_BREAK}[A-Z][A-Za-z-]{{1,30}}:\x20?[A-Za-z0-9,-]{{1,80}}){{0,4}}"
    rf"(?:[{_LINES}\x20]+-----END [A-Z ]*PRIVATE KEY-----|{_FIRST}[{_LINES}\x20]*\z|{_FIRST}[{_LINES}]*)|)"
)
# Other shapes, added only if their owners are few.
ADDED = {
    "key": ("(?:gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_(?:live|test)_[A-Za-z0-9]{10,}|AIza[A-Za-z0-9_-]{30,}|eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]+)", 0, 0),
    "pem": (PEM, 1, 0),
}
KINDS = [*BASE, *ADDED]


def pieces(text: Column, kind: str) -> Column:
    """array<struct<at, kind, gap, size, value>>: every match of a kind with its number, the characters between it and the match before, its own, and its value."""
    pattern, group, _ = (BASE | ADDED)[kind]
    whole, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    # Zipped, so that no lambda holds an expression over the text, which would run once per match. There is a gap more than matches.
    zipped = F.arrays_zip(whole, gaps, values)  # fields are named by number
    rows = F.transform(zipped, lambda x, i: F.struct(i.alias("at"), F.lit(kind).alias("kind"), F.length(x["1"]).alias("gap"), F.length(x["0"]).alias("size"), x["2"].alias("value")))
    empty = F.array().cast("array<struct<at:int,kind:string,gap:int,size:int,value:string>>")
    return F.when(text.rlike(pattern), F.filter(rows, lambda x: x["size"].isNotNull())).otherwise(empty)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document, without its text: row, doc_id, owner, and what its matches are measured by. Written, so that a row keeps its number."""
    docs = docs.select("doc_id", F.col("source").alias("owner"), F.coalesce("text", F.lit("")).alias("text"))
    found = F.concat(*(pieces(F.col("text"), k) for k in KINDS))
    return stash(docs.select("doc_id", "owner", found.alias("found")).withColumn("row", F.monotonically_increasing_id()))


def matches(rows: DataFrame) -> DataFrame:
    """(row, doc_id, owner, kind, start, end, value, digest) of every match. Offsets are running sums of a document's gaps and matches, so their cost is in proportion to the matches."""
    each = rows.filter(F.size("found") > 0).select("row", "doc_id", "owner", F.explode("found").alias("m")).select("row", "doc_id", "owner", "m.*")
    before = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("size")).over(before)).withColumn("start", F.col("end") - F.col("size"))
    least = F.create_map(*(F.lit(x) for k in KINDS for x in (k, (BASE | ADDED)[k][2])))
    kept = placed.filter(F.length("value") >= least[F.col("kind")])
    return kept.select("row", "doc_id", "owner", "kind", "start", "end", "value", F.sha2("value", 256).alias("digest"))


def ownership(candidates: DataFrame) -> DataFrame:
    """(digest, n_repos, n_owners) of every candidate value."""
    seen = candidates.groupBy("digest", "owner", "doc_id").agg(F.lit(1).alias("one"))
    by_owner = seen.groupBy("digest", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("digest").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def is_live(max_owners: int, max_repos: int) -> Column:
    return (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)


def values(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """(digest, n_repos, n_owners, live) of every value that a match has: the counts behind the verdicts of `find`."""
    prepare(docs.sparkSession)
    return ownership(matches(scan(docs)).filter("value <> ''").select("doc_id", "owner", "digest")).withColumn("live", is_live(max_owners, max_repos))


def find(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied) of every document."""
    prepare(docs.sparkSession)
    rows = scan(docs)
    candidates = stash(matches(rows))
    known = ownership(candidates).withColumnRenamed("digest", "known_digest")
    judged = candidates.join(known, F.col("digest") == F.col("known_digest"))
    live = is_live(max_owners, max_repos) | (F.col("value") == "")
    base, rank = F.col("kind").isin(*BASE), F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "end", "kind")
    in_order = lambda kept: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(kept, span))), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    spans = judged.groupBy(F.col("row").alias("span_row")).agg(
        *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE),
        in_order(base).alias("base_spans"), in_order(base | live).alias("spans"),
        F.sum((base & live).cast("long")).alias("n_live"), F.sum((base & ~live).cast("long")).alias("n_copied"),
    )
    joined = rows.select("row", "doc_id").join(spans, F.col("row") == F.col("span_row"), "left")
    count = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    text = lambda c: F.coalesce(c, F.lit(""))
    return joined.select("doc_id", *(count(f"n_{k}") for k in BASE), F.sha2(text("base_spans"), 256).alias("base_sha256"), text("spans").alias("spans"), count("n_live"), count("n_copied"))
