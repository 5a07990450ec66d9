"""Recency, frequency and monetary value: measures, quintile scores, segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.exprs import whole_days
from tallyloom.operators.binning import bin_by_cuts, bin_number, inner_probabilities, quantiles, rank_cuts
from tallyloom.session import cut_lineage

# fixed values: segments in order of precedence, each with its lowest and highest r, f and m score
SEGMENT_RULES = (
    ("Best Customers", (4, 5), (4, 5), (4, 5)),
    ("Cannot Lose Customers", (1, 1), (4, 5), (4, 5)),
    ("New Customers", (4, 5), (1, 2), (1, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (3, 5)),
    ("Potential Loyal Customers", (3, 5), (2, 5), (1, 5)),
    ("At Risk Customers", (1, 2), (3, 5), (3, 5)),
    ("Lost Customers", (1, 2), (1, 2), (1, 5)),
)
OTHER_SEGMENT = "Needs Attention"
BINS = 5


def rfm_values(transactions: DataFrame) -> DataFrame:
    """Days since the last purchase, invoices and revenue per known customer.

    The reference day is one day after the latest row of all, guests included. Invoices are made distinct per
    (customer, invoice) first, so no customer's lines, nor the guests', meet in one task. The customer table
    is written once; it gives the reference day and all that follows without a second pass over the lines.
    """
    invoices = transactions.groupBy("customer_id", "invoice").agg(F.max("invoice_date").alias("last"), F.sum("revenue").alias("revenue"))
    customers = cut_lineage(
        invoices.groupBy("customer_id").agg(
            F.max("last").alias("last"), F.count("invoice").alias("frequency"), F.sum("revenue").alias("monetary")
        )
    )
    snapshot = customers.agg(F.max("last") + F.expr("interval 1 day")).scalar()
    known = customers.filter(F.col("customer_id").isNotNull())
    return known.select("customer_id", whole_days("last", snapshot).alias("recency"), "frequency", "monetary")


def rfm_scores(values: DataFrame) -> DataFrame:
    """Quintile scores 1 to 5 and their combined text.

    Recency has few distinct values (days), so one aggregate gives its edges; frequency is ranked with ties
    in customer order and monetary has many values, so the edges of both are selected between sketched brackets. The table is read
    several times, which is why `rfm_values` returns a written one.
    """
    r_edges = values.agg(F.percentile("recency", F.array(*[F.lit(p) for p in inner_probabilities(BINS)]))).scalar()
    r = F.lit(BINS + 1) - bin_number(F.col("recency").cast("double"), [F.try_element_at(r_edges, F.lit(k)) for k in range(1, BINS)])
    f = bin_by_cuts("frequency", "customer_id", rank_cuts(values, "frequency", "customer_id", BINS))
    m_edges = quantiles(values, "monetary", inner_probabilities(BINS))
    m = bin_number(F.col("monetary").cast("double"), [F.lit(e) for e in m_edges])
    scored = values.withColumns({"r_score": r, "f_score": f, "m_score": m})
    return scored.withColumn("rfm_score", F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]))


def segment(r: str = "r_score", f: str = "f_score", m: str = "m_score") -> Column:
    """The first segment whose score ranges all fit."""
    chosen = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, *ranges in SEGMENT_RULES:
        fits = [F.col(c).between(low, high) for c, (low, high) in zip((r, f, m), ranges, strict=True)]
        chosen = chosen.when(fits[0] & fits[1] & fits[2], name)
    return chosen.otherwise(OTHER_SEGMENT)


def rfm_segments(scores: DataFrame) -> DataFrame:
    return scores.withColumn("segment", segment())


def segment_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count(F.lit(1)).alias("count"))


def segment_summary(segments: DataFrame) -> DataFrame:
    """Customers and mean measures per segment, rounded half to even."""

    def mean(c):
        return F.bround((F.sum(c) / F.count(c)).cast("double"), 1)

    return segments.groupBy("segment").agg(
        F.count("customer_id").alias("customers"),
        mean("recency").alias("avg_recency"),
        mean("frequency").alias("avg_frequency"),
        mean("monetary").alias("avg_monetary"),
    )
