"""Profit by dimension and share of ad spend."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions.exprs import month_start
from tallyloom.operators import ranking as R, share as H
from tallyloom.plans.check_tables import check
from tallyloom.sources.fixtures import DIGITAL_CHANNELS, Fixtures


def profit_by_month(fx: Fixtures):
    return R.profit_by(fx.soda(), month_start("sale_date"), "month_start").orderBy("month_start")


def profit_by_region(fx: Fixtures):
    return R.profit_by(fx.soda(), "region", "region").orderBy(F.col("profit").desc(), "region")


def profit_by_product(fx: Fixtures):
    return R.profit_by(fx.soda(), "product", "product").orderBy(F.col("profit").desc(), "product")


def product_extremes(fx: Fixtures):
    return R.extremes(R.profit_by(fx.soda(), "product", "product"), "product")


def profit_by_customer(fx: Fixtures):
    return R.profit_by(fx.soda(), "customer", "customer").orderBy(F.col("profit").desc(), "customer")


def channel_share(fx: Fixtures):
    return H.channel_share_by_year(fx.ad_spend()).orderBy("year", F.col("share_pct").desc(), "channel")


def digital_share(fx: Fixtures):
    return H.digital_share_by_year(fx.ad_spend(), DIGITAL_CHANNELS).orderBy("year", "channel")


QUERIES = {
    "soda_profit_by_month": profit_by_month,
    "soda_profit_by_region": profit_by_region,
    "soda_profit_by_product": profit_by_product,
    "soda_product_extremes": product_extremes,
    "soda_profit_by_customer": profit_by_customer,
    "ad_channel_share": channel_share,
    "ad_digital_share": digital_share,
}


def _profit(dimension: str, name: str) -> str:
    return check("soda", f"SELECT {dimension} AS {name}, CAST(sum(profit) AS DOUBLE) AS profit FROM soda GROUP BY 1")


def _share(channel: str) -> str:
    # Amounts are whole cents, so the share is exact before it is rounded.
    return check(
        "ad_spend",
        f""", spent AS (SELECT year, {channel} AS kind, sum(CAST(spend * 100 AS BIGINT)) AS cents FROM ad_spend GROUP BY ALL)
        , yearly AS (SELECT *, CAST(sum(cents) OVER (PARTITION BY year) AS HUGEINT) AS whole FROM spent)
        SELECT CAST(year AS INTEGER) AS year, kind AS channel, cents / 100.0::DOUBLE AS spend,
               (2 * CAST(cents AS HUGEINT) * 10000 + whole) // (2 * whole) / 100.0::DOUBLE AS share_pct, year > 2022 AS projected
        FROM yearly""",
    )


ORACLE = {
    "soda_profit_by_month": _profit("strftime(sale_date, '%Y-%m-01')", "month_start"),
    "soda_profit_by_region": _profit("region", "region"),
    "soda_profit_by_product": _profit("product", "product"),
    "soda_product_extremes": check(
        "soda",
        """, totals AS (SELECT product, sum(profit) AS p FROM soda GROUP BY 1)
        (SELECT product, CAST(p AS DOUBLE) AS profit, 'most' AS "end" FROM totals ORDER BY p DESC, product LIMIT 10)
        UNION ALL (SELECT product, CAST(p AS DOUBLE), 'least' FROM totals ORDER BY p, product LIMIT 10)""",
    ),
    "soda_profit_by_customer": _profit("customer", "customer"),
    "ad_channel_share": _share("channel"),
    "ad_digital_share": _share(f"if(channel IN {DIGITAL_CHANNELS}, 'digital', 'traditional')"),
}
