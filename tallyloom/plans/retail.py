"""Retail questions: loading, quality, revenue, products, customers, countries, segments, cohorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions.exprs import money, parse_timestamp
from tallyloom.operators import asof as A, binning as B, calendar as C, cohort as H, distinct as D, quality as Q, ranking as R, segments as G, totals as T
from tallyloom.plans.check_tables import check, half_up
from tallyloom.sources.fixtures import HOME_MARKET, Fixtures
from tallyloom.sources.readers import RETAIL_CSV_SCHEMA, RETAIL_FILE, parse_csv_lines, preview, read_csv, scan_csv


def clean(fx: Fixtures):
    return Q.clean_transactions(fx.retail())


def _lines(df):
    """Transaction lines for display: an id with gaps is shown as a double."""
    return df.withColumn("customer_id", F.col("customer_id").cast("double"))


# ---- loading and quality ------------------------------------------------------------------------


def load(fx: Fixtures):
    """Delimited text to the typed table, with the date parsed, the customer id whole and revenue added."""
    rows = parse_csv_lines(fx.retail_lines(), "line", RETAIL_CSV_SCHEMA)
    rows = rows.withColumn("invoice_date", parse_timestamp("invoice_date")).withColumn("customer_id", F.col("customer_id").cast("long"))
    return _lines(Q.with_revenue(rows))


def load_file(fx: Fixtures):
    """The same from a delimited file with a header row of its own names."""
    rows = read_csv(fx.spark, fx.retail_file(), RETAIL_FILE)
    return _lines(Q.with_revenue(rows.withColumn("invoice_date", parse_timestamp("invoice_date"))))


def load_dirty(fx: Fixtures):
    """Accepted records of files with quoted line breaks, short records and text in place of numbers."""
    rows = scan_csv(fx.spark, fx.retail_dirty_file(), RETAIL_FILE).accepted
    return _lines(Q.with_revenue(rows.withColumn("invoice_date", parse_timestamp("invoice_date"))))


def load_rejected(fx: Fixtures):
    """The records of the same files that are no rows, and why."""
    return scan_csv(fx.spark, fx.retail_dirty_file(), RETAIL_FILE).rejected


def schema(fx: Fixtures):
    return Q.schema_profile(fx.retail())


def missing(fx: Fixtures):
    return Q.null_report(fx.retail())


def duplicates(fx: Fixtures):
    return Q.duplicate_count(fx.retail())


def report(fx: Fixtures):
    return Q.quality_report(fx.retail())


def top_values(fx: Fixtures):
    return Q.top_values(fx.retail(), 3)


def with_customer(fx: Fixtures):
    return _lines(Q.present(fx.retail(), "customer_id"))


def with_description(fx: Fixtures):
    return _lines(Q.present(fx.retail(), "description"))


def deduplicated(fx: Fixtures):
    return _lines(Q.drop_duplicates(fx.retail()))


def audit(fx: Fixtures):
    return Q.cancellation_audit(Q.drop_duplicates(fx.retail()))


def violators(fx: Fixtures):
    return _lines(Q.cancellation_violators(Q.drop_duplicates(fx.retail())))


def negative_prices(fx: Fixtures):
    rows = Q.drop_duplicates(fx.retail())
    return _lines(rows.filter((F.col("quantity") > 0) & (F.col("price") < 0)))


def cleaned(fx: Fixtures):
    return _lines(clean(fx))


def head(fx: Fixtures):
    keys = ["invoice_date", "invoice", F.col("description").asc_nulls_last(), "quantity", "price"]
    return _lines(preview(clean(fx), 5, *keys))


def _returns(fx: Fixtures):
    return fx.retail().filter(F.col("quantity") < 0).select("country", "customer_id", F.to_date("invoice_date").alias("return_day"))


def _days(fx: Fixtures):
    return clean(fx).withColumns({"country": F.when(F.col("country") == "Ireland", "EIRE").otherwise(F.col("country")), "day": F.to_date("invoice_date")})


def last_return(fx: Fixtures):
    """Lines sold per country and day, with the country's last day of returns before that day. A country is a key with many lines and many returns."""
    lines = A.as_of(_days(fx).select("country", "day", "quantity"), _returns(fx), "country", "day", "return_day", "before", inclusive=False, out="last_return")
    return lines.groupBy("country", "day", "last_return").agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units"))


def next_purchase(fx: Fixtures):
    """What customers bought on the first day from each of their return days on."""
    found = A.nearest_events(_days(fx), _returns(fx), "after", key="customer_id", day="day", anchor="return_day")
    return found.groupBy("customer_id", "return_day", "day").agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units"))


# ---- revenue and products -----------------------------------------------------------------------


def monthly(fx: Fixtures):
    series = C.with_overall_mean(C.monthly_revenue(clean(fx)))
    return series.withColumns({"revenue": money("revenue"), "mean_revenue": F.round("mean_revenue", 2)}).orderBy("month_end")


def monthly_in_batches(fx: Fixtures):
    """The same from the stored states of two batches, one of which is sent twice."""
    sold, path = clean(fx), fx.scratch("totals")
    odd = F.regexp_replace("invoice", "[^0-9]", "").cast("long") % 2 == 1
    for name, batch in (("odd", sold.filter(odd)), ("even", sold.filter(~odd)), ("odd", sold.filter(odd))):
        T.add_batch(batch, path, name)
    series = C.with_overall_mean(T.current_months(fx.spark, path))
    return series.withColumns({"revenue": money("revenue"), "mean_revenue": F.round("mean_revenue", 2)}).orderBy("month_end")


def products_raw(fx: Fixtures):
    return R.top_products(clean(fx))


def products(fx: Fixtures):
    return R.top_products(Q.exclude_keywords(clean(fx)))


def products_by_quantity(fx: Fixtures):
    return R.top_products(Q.exclude_keywords(clean(fx)), "quantity")


# ---- customers ----------------------------------------------------------------------------------


def _labelled(df):
    return df.withColumn("customer_id", F.col("customer_id").cast("string"))


def customers_by_revenue(fx: Fixtures):
    return _labelled(R.top_customers_by_revenue(clean(fx)))


def customers_by_invoices(fx: Fixtures):
    return _labelled(R.top_customers_by_invoices(clean(fx)))


def _mean_spend(fx: Fixtures, per: str):
    return _labelled(R.top_customers_by_mean(clean(fx), per=per)).withColumn("average_spend", F.round("average_spend", 2))


def customers_by_mean(fx: Fixtures):
    return _mean_spend(fx, "line")


def customers_by_invoice_mean(fx: Fixtures):
    return _mean_spend(fx, "invoice")


def drilldown(place: int):
    def run(fx: Fixtures):
        rows = clean(fx)
        return R.account_drilldown(rows, R.kth_customer(rows, place))

    return run


# ---- countries ----------------------------------------------------------------------------------


def country_tiers(fx: Fixtures):
    return R.country_revenue_tiers(clean(fx))


def countries(fx: Fixtures):
    return R.top_k(R.country_revenue(clean(fx)), "revenue", 10, "country")


def countries_abroad(fx: Fixtures):
    """The home market is taken out after the list is cut, so one row fewer remains."""
    return R.without(countries(fx), "country", HOME_MARKET)


def customers_sketched(fx: Fixtures):
    """Customers per country: counted, and whether the union of monthly sketches is within its stated error."""
    sold = fx.retail().filter(F.col("customer_id").isNotNull() & F.col("country").isNotNull())
    monthly = D.sketches(sold.withColumn("month", F.date_trunc("month", "invoice_date")), ["country", "month"], "customer_id")
    estimated = D.estimate(D.union(monthly, ["country"]), "estimated")
    return R.country_customers(fx.retail()).join(estimated, "country").select("country", "number_of_customers", D.within("estimated", "number_of_customers").alias("within_error"))


def customer_tiers(fx: Fixtures):
    """As written, customers are counted before any cleaning."""
    return R.country_customer_tiers(fx.retail())


def customer_tiers_cleaned(fx: Fixtures):
    return R.country_customer_tiers(clean(fx))


def customer_counts(fx: Fixtures):
    return R.top_k(R.country_customers(fx.retail()), "number_of_customers", 10, "country")


def customer_counts_abroad(fx: Fixtures):
    """The home market is taken out before the list is cut, so ten rows remain."""
    abroad = R.without(R.country_customers(fx.retail()), "country", HOME_MARKET)
    return R.top_k(abroad, "number_of_customers", 10, "country")


def ratio_tiers(fx: Fixtures):
    return R.revenue_per_customer_tiers(clean(fx)).withColumn("avg_revenue_per_customer", F.round("avg_revenue_per_customer", 2))


def ratios(fx: Fixtures):
    top = R.top_revenue_per_customer(clean(fx))
    return top.select("country", F.round("avg_revenue_per_customer", 2)).toDF("country", "avg_revenue_per_customer")


# ---- segments and cohorts -----------------------------------------------------------------------


def rfm_values(fx: Fixtures):
    return G.rfm_values(clean(fx))


def rfm_scores(fx: Fixtures):
    return G.rfm_scores(G.rfm_values(clean(fx))).select("customer_id", "r_score", "f_score", "m_score", "rfm_score")


def _segments(fx: Fixtures):
    return G.rfm_segments(G.rfm_scores(G.rfm_values(clean(fx))))


def rfm_segments(fx: Fixtures):
    return _segments(fx).select("customer_id", "segment")


def segment_counts(fx: Fixtures):
    return G.segment_counts(_segments(fx)).orderBy(F.col("count").desc(), "segment")


def segment_summary(fx: Fixtures):
    return G.segment_summary(_segments(fx)).orderBy(F.col("avg_monetary").desc(), "segment")


def frequency_order(fx: Fixtures):
    """Customers ranked by invoices, ties in customer order."""
    values = G.rfm_values(clean(fx)).select("frequency", "customer_id")
    return B.SortedRows(values, "frequency", "customer_id").with_ordinal("place")


def cohort_counts(fx: Fixtures):
    return H.cohort_counts(clean(fx)).orderBy("cohort_month", "months_elapsed")


def cohort_retention(fx: Fixtures):
    return H.cohort_retention(H.cohort_counts(clean(fx))).orderBy("cohort_month", "months_elapsed")


def cohort_matrix(fx: Fixtures):
    return H.shown_cells(H.cohort_matrix(H.cohort_retention(H.cohort_counts(clean(fx))))).orderBy("cohort_month")


QUERIES = {
    "retail_load": load,
    "retail_load_csv": load_file,
    "retail_load_csv_accepted": load_dirty,
    "retail_last_return": last_return,
    "retail_next_purchase": next_purchase,
    "retail_top_values": top_values,
    "retail_country_customers_sketched": customers_sketched,
    "retail_monthly_revenue_in_batches": monthly_in_batches,
    "retail_load_csv_rejected": load_rejected,
    "retail_info_schema": schema,
    "retail_missing_values": missing,
    "retail_duplicate_count": duplicates,
    "retail_quality_report": report,
    "retail_with_customer": with_customer,
    "retail_with_description": with_description,
    "retail_deduplicated": deduplicated,
    "retail_cancellation_audit": audit,
    "retail_cancellation_violators": violators,
    "retail_negative_prices": negative_prices,
    "retail_cleaned": cleaned,
    "retail_head": head,
    "retail_monthly_revenue": monthly,
    "retail_top_products_raw": products_raw,
    "retail_top_products": products,
    "retail_top_products_by_quantity": products_by_quantity,
    "retail_top_customers_by_revenue": customers_by_revenue,
    "retail_top_customers_by_invoices": customers_by_invoices,
    "retail_top_customers_by_mean": customers_by_mean,
    "retail_top_customers_by_mean_corrected": customers_by_invoice_mean,
    "retail_drilldown_first": drilldown(1),
    "retail_drilldown_second": drilldown(2),
    "retail_country_revenue_tiers": country_tiers,
    "retail_top_countries": countries,
    "retail_top_countries_abroad": countries_abroad,
    "retail_country_customer_tiers": customer_tiers,
    "retail_country_customer_tiers_corrected": customer_tiers_cleaned,
    "retail_top_customer_counts": customer_counts,
    "retail_top_customer_counts_abroad": customer_counts_abroad,
    "retail_revenue_per_customer_tiers": ratio_tiers,
    "retail_top_revenue_per_customer": ratios,
    "retail_rfm_values": rfm_values,
    "retail_rfm_scores": rfm_scores,
    "retail_rfm_segments": rfm_segments,
    "retail_rfm_segment_counts": segment_counts,
    "retail_rfm_segment_summary": segment_summary,
    "retail_frequency_order": frequency_order,
    "retail_cohort_counts": cohort_counts,
    "retail_cohort_retention": cohort_retention,
    "retail_cohort_matrix": cohort_matrix,
}

_TS = "strftime(invoice_date, '%Y-%m-%d %H:%M:%S') AS invoice_date"
_RAW_ROW = f"invoice, description, quantity, {_TS}, CAST(price AS DOUBLE) AS price, CAST(customer_id AS DOUBLE) AS customer_id, country"
_ROW = f"{_RAW_ROW}, CAST(revenue AS DOUBLE) AS revenue"
_COLUMNS = {
    "invoice": "string",
    "description": "string",
    "quantity": "int",
    "invoice_date": "timestamp_ntz",
    "price": "decimal(10,2)",
    "customer_id": "bigint",
    "country": "string",
}
_SCHEMA = " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM retail" for c, t in _COLUMNS.items())
_MISSING = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM retail" for c in _COLUMNS)
_REPEATS = "SELECT (SELECT count(*) FROM retail) - (SELECT count(*) FROM (SELECT DISTINCT * FROM retail) u) AS duplicate_rows"
_TOP_VALUES = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR) NULLS FIRST) AS INTEGER) AS rank, CAST({c} AS VARCHAR) AS value, count(*) AS count
    FROM retail GROUP BY {c} QUALIFY rank <= 3"""
    for c in _COLUMNS
)
_PRODUCT = "regexp_matches(coalesce(description, ''), 'manual|postage|dotcom', 'i')"
_CUSTOMER = "CAST(customer_id AS VARCHAR) AS customer_id"
_TOP_SPENDER = """, spender AS (
    SELECT customer_id FROM retail_clean WHERE customer_id IS NOT NULL GROUP BY 1 ORDER BY sum(revenue) DESC, 1 LIMIT 1 OFFSET {skip})
    , lines AS (SELECT retail_clean.* FROM retail_clean JOIN spender USING (customer_id)
        ORDER BY invoice_date, invoice, description NULLS LAST, quantity, price LIMIT 20)
    SELECT invoice, description, quantity, CAST(price AS DOUBLE) AS price, CAST(revenue AS DOUBLE) AS revenue FROM lines"""


def _mean_spend_check(per: str) -> str:
    return check(
        "retail_clean",
        f"""SELECT CAST(customer_id AS VARCHAR) AS customer_id, {half_up("sum(revenue) * 100", f"{per} * 100", 2)} AS average_spend
        FROM retail_clean WHERE customer_id IS NOT NULL GROUP BY retail_clean.customer_id
        ORDER BY CAST(sum(revenue) AS DOUBLE) / {per} DESC, retail_clean.customer_id LIMIT 10""",
    )


def _tier(value: str, edges: str, labels) -> str:
    arms = " ".join(f"WHEN {value} <= {edges}[{k}] THEN '{label}'" for k, label in enumerate(labels[:-1], 1))
    return f"CASE WHEN {value} IS NULL THEN NULL {arms} ELSE '{labels[-1]}' END"


def _customer_tier_check(table: str) -> str:
    return check(
        table,
        f""", pop AS (SELECT country, count(DISTINCT customer_id) AS n FROM {table} WHERE customer_id IS NOT NULL GROUP BY 1)
        , cut AS (SELECT quantile_cont(CAST(n AS DOUBLE), [0.25, 0.5, 0.75]) AS e FROM pop WHERE n > 1)
        SELECT country, n AS number_of_customers, if(n = 1, 'Very Low', {_tier("n", "e", B.TIER_LABELS[1:])}) AS customer_tier FROM pop, cut""",
    )


_POP = ", pop AS (SELECT country, count(DISTINCT customer_id) AS number_of_customers FROM retail WHERE customer_id IS NOT NULL GROUP BY 1)"
_RATIO = f""", totals AS (
    SELECT country, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(DISTINCT customer_id) AS unique_customers FROM retail_clean GROUP BY 1)
    , rated AS (
        SELECT *, total_revenue / nullif(unique_customers, 0) AS r,
               {half_up("round(total_revenue * 100)", "nullif(unique_customers, 0) * 100", 2)} AS shown FROM totals)"""
def _above(value: str, edges: str) -> str:
    """How many of four edges lie below a value."""
    return "(" + " + ".join(f"CAST({value} > {edges}[{k}] AS INTEGER)" for k in range(1, 5)) + ")"


_RFM = (
    """, bounds AS (SELECT max(invoice_date) + INTERVAL 1 DAY AS ref FROM retail_clean)
    , rfm AS (
        SELECT customer_id, CAST(floor(date_diff('second', max(invoice_date), any_value(ref)) / 86400) AS INTEGER) AS recency,
               count(DISTINCT invoice) AS frequency, sum(revenue) AS monetary
        FROM retail_clean, bounds WHERE customer_id IS NOT NULL GROUP BY 1)
    , ranked AS (SELECT *, CAST(monetary AS DOUBLE) AS m, row_number() OVER (ORDER BY frequency, customer_id) AS place FROM rfm)
    , cuts AS (
        SELECT quantile_cont(CAST(recency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS re, quantile_cont(m, [0.2, 0.4, 0.6, 0.8]) AS me,
               quantile_cont(CAST(place AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS fe
        FROM ranked)
    , scored AS ("""
    + f"SELECT ranked.*, 5 - {_above('recency', 're')} AS r_score, 1 + {_above('place', 'fe')} AS f_score, 1 + {_above('m', 'me')} AS m_score"
    + " FROM ranked, cuts)"
)
# One arm per rule of the table: each score lies in its range.
_ARMS = " ".join(
    f"WHEN {' AND '.join(f'{c} BETWEEN {low} AND {high}' for c, (low, high) in zip(('r_score', 'f_score', 'm_score'), ranges))} THEN '{name}'"
    for name, *ranges in G.SEGMENT_RULES
)
_SEGMENT = _RFM + f", grouped AS (SELECT *, CASE {_ARMS} ELSE '{G.OTHER_SEGMENT}' END AS segment FROM scored)"
_COHORT = """, active AS (SELECT DISTINCT customer_id, date_trunc('month', invoice_date) AS month FROM retail_clean WHERE customer_id IS NOT NULL)
    , born AS (SELECT *, min(month) OVER (PARTITION BY customer_id) AS cohort FROM active)
    , sized AS (SELECT cohort, date_diff('month', cohort, month) AS months_elapsed, count(DISTINCT customer_id) AS customers FROM born GROUP BY ALL)
    , kept AS (
        SELECT sized.*, round(round_even(sized.customers / base.customers, 3) * 100, 1) AS retention_pct
        FROM sized JOIN sized base ON base.cohort = sized.cohort AND base.months_elapsed = 0)"""
_COHORT_MONTH = "strftime(cohort, '%Y-%m-%d') AS cohort_month"


def _half_even_mean(column: str) -> str:
    return f"round_even(CAST(CAST(sum({column}) AS DOUBLE) / count(*) AS DOUBLE), 1)"


ORACLE = {
    "retail_load": check("retail", f"SELECT {_RAW_ROW}, CAST(quantity * price AS DOUBLE) AS revenue FROM retail"),
    "retail_load_csv": check("retail", f"SELECT {_RAW_ROW}, CAST(quantity * price AS DOUBLE) AS revenue FROM retail"),
    "retail_load_csv_accepted": check(
        "retail",
        f""", fine AS (SELECT * REPLACE (CASE WHEN quantity % 3 = 0 THEN replace(description, ' ', chr(10)) ELSE description END AS description)
            FROM retail WHERE quantity % 13 <> 5 AND quantity % 17 <> 3)
        SELECT {_RAW_ROW}, CAST(quantity * price AS DOUBLE) AS revenue FROM fine""",
    ),
    "retail_load_csv_rejected": check(
        "retail",
        """, told AS (SELECT quantity % 13 = 5 AS bad, invoice || ',' || coalesce(description, '') || ',' || quantity AS head,
            strftime(invoice_date, '%Y-%m-%d %H:%M:%S') || ',' || CAST(price AS VARCHAR) || ',' || coalesce(customer_id || '.0', '') || ',' || country AS tail
            FROM retail WHERE quantity % 13 = 5 OR quantity % 17 = 3)
        SELECT if(bad, 'Quantity', 'number of fields') AS reason, if(bad, head || ' pcs,' || tail, head) AS record FROM told""",
    ),
    "retail_last_return": check(
        "retail retail_clean",
        """, sold AS (SELECT CASE country WHEN 'Ireland' THEN 'EIRE' ELSE country END AS country, CAST(invoice_date AS DATE) AS day, quantity FROM retail_clean)
        , back AS (SELECT DISTINCT country, CAST(invoice_date AS DATE) AS return_day FROM retail WHERE quantity < 0)
        SELECT sold.country AS country, strftime(day, '%Y-%m-%d') AS day, strftime(return_day, '%Y-%m-%d') AS last_return, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units
        FROM sold ASOF LEFT JOIN back ON sold.country = back.country AND sold.day > back.return_day GROUP BY ALL""",
    ),
    "retail_next_purchase": check(
        "retail retail_clean",
        """, sold AS (SELECT customer_id, CAST(invoice_date AS DATE) AS day, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units FROM retail_clean WHERE customer_id IS NOT NULL GROUP BY ALL)
        , back AS (SELECT DISTINCT customer_id, CAST(invoice_date AS DATE) AS return_day FROM retail WHERE quantity < 0 AND customer_id IS NOT NULL)
        SELECT back.customer_id AS customer_id, strftime(return_day, '%Y-%m-%d') AS return_day, strftime(day, '%Y-%m-%d') AS day, lines, units
        FROM back ASOF JOIN sold ON sold.customer_id = back.customer_id AND sold.day >= back.return_day""",
    ),
    "retail_info_schema": check("retail", _SCHEMA),
    "retail_missing_values": check("retail", _MISSING),
    "retail_duplicate_count": check("retail", _REPEATS),
    "retail_quality_report": check(
        "retail",
        f""", missing AS ({_MISSING}), repeats AS ({_REPEATS}), negative AS (SELECT * FROM retail WHERE quantity < 0)
        SELECT 'missing ' || column_name AS measure, missing AS value FROM missing
        UNION ALL SELECT 'duplicate rows', duplicate_rows FROM repeats
        UNION ALL SELECT 'negative quantity', count(*) FROM negative
        UNION ALL SELECT 'negative quantity without prefix', count(*) FROM negative WHERE invoice[1] <> 'C'""",
    ),
    "retail_with_customer": check("retail", f"SELECT {_RAW_ROW} FROM retail WHERE customer_id IS NOT NULL"),
    "retail_with_description": check("retail", f"SELECT {_RAW_ROW} FROM retail WHERE description IS NOT NULL"),
    "retail_deduplicated": check("retail", f"SELECT {_RAW_ROW} FROM retail GROUP BY retail.invoice, retail.description, retail.quantity, retail.invoice_date, retail.price, retail.customer_id, retail.country"),
    "retail_cancellation_audit": check(
        "retail",
        """, negative AS (SELECT DISTINCT * FROM retail WHERE quantity < 0)
        SELECT count(*) AS negative_rows, min(invoice)[1] = 'C' AS all_prefixed, count(*) FILTER (invoice[1] <> 'C') AS violators FROM negative""",
    ),
    "retail_cancellation_violators": check(
        "retail", f", negative AS (SELECT DISTINCT * FROM retail WHERE quantity < 0 AND invoice[1] <> 'C') SELECT {_RAW_ROW} FROM negative"
    ),
    "retail_negative_prices": check(
        "retail", f", odd AS (SELECT DISTINCT * FROM retail WHERE quantity > 0 AND price < 0) SELECT {_RAW_ROW} FROM odd"
    ),
    "retail_cleaned": check("retail_clean", f"SELECT {_ROW} FROM retail_clean"),
    "retail_head": check(
        "retail_clean",
        f", top AS (SELECT * FROM retail_clean ORDER BY invoice_date, invoice, description NULLS LAST, quantity, price LIMIT 5) SELECT {_ROW} FROM top",
    ),
    "retail_monthly_revenue": check(
        "retail_clean",
        """, booked AS (SELECT last_day(invoice_date) AS month_end, sum(revenue) AS total FROM retail_clean GROUP BY 1)
        , spine AS (
            SELECT last_day(CAST(d AS DATE)) AS month_end
            FROM (SELECT unnest(generate_series(date_trunc('month', min(month_end)), date_trunc('month', max(month_end)), INTERVAL 1 MONTH)) AS d FROM booked) s)
        , filled AS (SELECT spine.month_end, CAST(coalesce(total, 0) AS DOUBLE) AS revenue FROM spine LEFT JOIN booked USING (month_end))
        SELECT strftime(month_end, '%Y-%m-%d') AS month_end, round(revenue, 2) AS revenue, (SELECT """
        + half_up("sum(CAST(revenue AS DECIMAL(18, 2))) * 100", "count(*) * 100", 2)
        + " FROM filled) AS mean_revenue FROM filled",
    ),
    "retail_country_customers_sketched": check(
        "retail", _POP + " SELECT country, number_of_customers, true AS within_error FROM pop WHERE country IS NOT NULL"
    ),
    "retail_top_values": check("retail", _TOP_VALUES),
    "retail_top_products_raw": check(
        "retail_clean",
        "SELECT description, CAST(sum(revenue) AS DOUBLE) AS revenue FROM retail_clean WHERE description IS NOT NULL GROUP BY 1 ORDER BY sum(retail_clean.revenue) DESC, 1 LIMIT 10",
    ),
    "retail_top_products": check(
        "retail_clean",
        f"""SELECT description, CAST(sum(revenue) AS DOUBLE) AS revenue FROM retail_clean WHERE description IS NOT NULL AND NOT {_PRODUCT}
        GROUP BY 1 ORDER BY sum(retail_clean.revenue) DESC, 1 LIMIT 10""",
    ),
    "retail_top_products_by_quantity": check(
        "retail_clean",
        f"""SELECT description, CAST(sum(quantity) AS BIGINT) AS quantity FROM retail_clean WHERE description IS NOT NULL AND NOT {_PRODUCT}
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    ),
    "retail_top_customers_by_revenue": check(
        "retail_clean",
        f"""SELECT {_CUSTOMER}, CAST(sum(revenue) AS DOUBLE) AS revenue FROM retail_clean WHERE customer_id IS NOT NULL
        GROUP BY retail_clean.customer_id ORDER BY sum(retail_clean.revenue) DESC, retail_clean.customer_id LIMIT 10""",
    ),
    "retail_top_customers_by_invoices": check(
        "retail_clean",
        f"""SELECT {_CUSTOMER}, count(DISTINCT invoice) AS number_of_invoices FROM retail_clean WHERE customer_id IS NOT NULL
        GROUP BY retail_clean.customer_id ORDER BY 2 DESC, retail_clean.customer_id LIMIT 10""",
    ),
    "retail_top_customers_by_mean": _mean_spend_check("count(*)"),
    "retail_top_customers_by_mean_corrected": _mean_spend_check("count(DISTINCT invoice)"),
    "retail_drilldown_first": check("retail_clean", _TOP_SPENDER.format(skip=0)),
    "retail_drilldown_second": check("retail_clean", _TOP_SPENDER.format(skip=1)),
    "retail_country_revenue_tiers": check(
        "retail_clean",
        f""", market AS (SELECT country, CAST(sum(revenue) AS DOUBLE) AS revenue FROM retail_clean GROUP BY 1)
        , cut AS (SELECT quantile_cont(revenue, [0.2, 0.4, 0.6, 0.8]) AS e FROM market)
        SELECT country, revenue, {_tier("revenue", "e", B.TIER_LABELS)} AS revenue_tier FROM market, cut""",
    ),
    "retail_top_countries": check(
        "retail_clean", "SELECT country, CAST(sum(revenue) AS DOUBLE) AS revenue FROM retail_clean GROUP BY 1 ORDER BY sum(retail_clean.revenue) DESC, 1 LIMIT 10"
    ),
    "retail_top_countries_abroad": check(
        "retail_clean",
        f""", top AS (SELECT country, CAST(sum(revenue) AS DOUBLE) AS revenue FROM retail_clean GROUP BY 1 ORDER BY sum(retail_clean.revenue) DESC, 1 LIMIT 10)
        SELECT * FROM top WHERE country <> '{HOME_MARKET}'""",
    ),
    "retail_country_customer_tiers": _customer_tier_check("retail"),
    "retail_country_customer_tiers_corrected": _customer_tier_check("retail_clean"),
    "retail_top_customer_counts": check("retail", _POP + "SELECT * FROM pop ORDER BY 2 DESC, 1 LIMIT 10"),
    "retail_top_customer_counts_abroad": check("retail", _POP + f"SELECT * FROM pop WHERE country <> '{HOME_MARKET}' ORDER BY 2 DESC, 1 LIMIT 10"),
    "retail_revenue_per_customer_tiers": check(
        "retail_clean",
        _RATIO
        + f""", low AS (SELECT min(r) AS least_r FROM rated)
        , cut AS (SELECT quantile_cont(r, [0.25, 0.5, 0.75]) AS e FROM rated, low WHERE r > least_r)
        SELECT country, total_revenue, unique_customers, shown AS avg_revenue_per_customer,
               if(coalesce(r = least_r, false), 'Very Low', {_tier("r", "e", B.TIER_LABELS[1:])}) AS revenue_tier
        FROM rated, low, cut""",
    ),
    "retail_top_revenue_per_customer": check(
        "retail_clean", _RATIO + "SELECT country, shown AS avg_revenue_per_customer FROM rated WHERE r IS NOT NULL ORDER BY r DESC, 1 LIMIT 10"
    ),
    "retail_rfm_values": check("retail_clean", _RFM + "SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary FROM rfm"),
    "retail_rfm_scores": check(
        "retail_clean", _RFM + "SELECT customer_id, r_score, f_score, m_score, r_score || f_score || m_score AS rfm_score FROM scored"
    ),
    "retail_rfm_segments": check("retail_clean", _SEGMENT + "SELECT customer_id, segment FROM grouped"),
    "retail_rfm_segment_counts": check("retail_clean", _SEGMENT + "SELECT segment, count(*) AS count FROM grouped GROUP BY 1"),
    "retail_rfm_segment_summary": check(
        "retail_clean",
        _SEGMENT
        + f"""SELECT segment, count(*) AS customers, {_half_even_mean("recency")} AS avg_recency, {_half_even_mean("frequency")} AS avg_frequency,
               {_half_even_mean("monetary")} AS avg_monetary FROM grouped GROUP BY 1""",
    ),
    "retail_frequency_order": check("retail_clean", _RFM + "SELECT frequency, customer_id, place FROM ranked"),
    "retail_cohort_counts": check("retail_clean", _COHORT + f"SELECT {_COHORT_MONTH}, CAST(months_elapsed AS INTEGER) AS months_elapsed, customers FROM sized"),
    "retail_cohort_retention": check(
        "retail_clean", _COHORT + f"SELECT {_COHORT_MONTH}, CAST(months_elapsed AS INTEGER) AS months_elapsed, customers, retention_pct FROM kept"
    ),
    "retail_cohort_matrix": check(
        "retail_clean",
        _COHORT
        + f""", cells AS (SELECT {_COHORT_MONTH}, months_elapsed, retention_pct FROM kept),
        spine AS (SELECT cohort_month, months_elapsed FROM (SELECT DISTINCT cohort_month FROM cells), (SELECT unnest(range(max(months_elapsed) + 1)) AS months_elapsed FROM cells))
        SELECT cohort_month, CAST(count(*) AS INTEGER) AS months, string_agg(coalesce(CAST(retention_pct AS VARCHAR), '-'), ' ' ORDER BY months_elapsed) AS cells
        FROM spine LEFT JOIN cells USING (cohort_month, months_elapsed) GROUP BY cohort_month""",
    ),
}
# Batches sum up to the same months.
ORACLE["retail_monthly_revenue_in_batches"] = ORACLE["retail_monthly_revenue"]
