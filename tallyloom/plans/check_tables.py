"""The adapted tables of `sources.fixtures`, written for DuckDB as common table expressions."""

from __future__ import annotations

from tallyloom.sources import fixtures as fx


def _rows(rows) -> str:
    def literal(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_TIME = "o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT))"

TABLES = {
    "sales": """
        SELECT CASE WHEN o.o_custkey % 37 <> 5 THEN o.o_custkey END AS customer_id,
               CASE WHEN o.o_orderkey % 53 <> 7 THEN CAST(o.o_orderdate AS DATE) END AS order_date, l.l_partkey AS product_id
        FROM lineitem l, orders o WHERE l.l_orderkey = o.o_orderkey""",
    "menu": "SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_retailprice AS DECIMAL(10, 2)) AS price FROM part",
    "members": """
        SELECT c_custkey AS customer_id, DATE '1998-01-01' + CAST(c_custkey % 365 AS INTEGER) AS join_date
        FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "co_raw": f"""
        SELECT l.l_orderkey AS order_id, o.o_custkey AS customer_id, CASE WHEN l.l_partkey % 41 <> 3 THEN CAST(l.l_partkey % 2 + 1 AS INTEGER) END AS pizza_id,
               CASE l.l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN 'null'
                    WHEN 3 THEN CASE l.l_orderkey % 5 WHEN 0 THEN CAST(l.l_suppkey % 12 + 1 AS VARCHAR)
                        WHEN 1 THEN (l.l_suppkey % 12 + 1) || ', ' || (l.l_partkey % 12 + 1) || ', ' || (l.l_orderkey % 12 + 1)
                        WHEN 2 THEN array_to_string([l.l_partkey * i % 12 + 1 for i in range(1, 11)], ', ')
                        ELSE (l.l_suppkey % 12 + 1) || ', ' || (l.l_partkey % 12 + 1) END END AS exclusions,
               CASE l.l_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'null' WHEN 3 THEN 'NaN'
                    WHEN 4 THEN (l.l_suppkey % 12 + 1) || ', ' || (l.l_orderkey % 12 + 1) END AS extras,
               {_TIME} AS order_time
        FROM lineitem l, orders o WHERE l.l_orderkey = o.o_orderkey""",
    "co": """
        SELECT order_id, customer_id, pizza_id, order_time,
               CASE WHEN exclusions NOT IN ('', 'null', 'NaN') THEN exclusions END AS exclusions,
               CASE WHEN extras NOT IN ('', 'null', 'NaN') THEN extras END AS extras
        FROM co_raw""",
    "ro_raw": f"""
        SELECT o_orderkey AS order_id, CAST(o_orderkey % 8 + 1 AS INTEGER) AS runner_id,
               CASE WHEN o_orderstatus = 'P' THEN 'null'
                    ELSE strftime({_TIME} + to_minutes(CAST(o_orderkey % 50 + 5 AS BIGINT)), '%Y-%m-%d %H:%M:%S') END AS pickup_time,
               CASE WHEN o_orderstatus = 'P' THEN 'null'
                    ELSE (o_orderkey % 20 + 5) || '.' || (o_orderkey % 10) || ['km', ' km', ''][(o_orderkey // 3) % 3 + 1] END AS distance,
               CASE WHEN o_orderstatus = 'P' THEN 'null'
                    ELSE (o_orderkey % 40 + 10) || if(o_orderkey % 6 = 5, '.5', '') || [' minutes', 'mins', ' minute', ''][o_orderkey % 4 + 1] END AS duration,
               CASE WHEN o_orderstatus = 'P'
                    THEN CASE o_orderkey % 2 WHEN 0 THEN 'Restaurant Cancellation' ELSE 'Customer Cancellation' END
                    ELSE CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'null' END END AS cancellation
        FROM orders""",
    "ro_text": """
        SELECT order_id, runner_id,
               nullif(pickup_time, 'null') AS pickup_time,
               regexp_replace(nullif(distance, 'null'), '[^0-9.]', '', 'g') AS distance,
               regexp_replace(nullif(duration, 'null'), '[^0-9]', '', 'g') AS duration,
               CASE WHEN cancellation NOT IN ('', 'null', 'NaN') THEN cancellation END AS cancellation
        FROM ro_raw""",
    "ro": """
        SELECT order_id, runner_id, CAST(pickup_time AS TIMESTAMP) AS pickup_time,
               TRY_CAST(distance AS DECIMAL(10, 2)) AS distance, TRY_CAST(duration AS DECIMAL(10, 2)) AS duration, cancellation
        FROM ro_text""",
    "runners": "SELECT s_suppkey AS runner_id, DATE '2021-01-01' + CAST(s_suppkey % 60 AS INTEGER) AS registration_date FROM supplier",
    "pizza_names": f"SELECT * FROM (VALUES {_rows(fx.PIZZA_NAMES)}) t(pizza_id, pizza_name)",
    "pizza_recipes": f"SELECT * FROM (VALUES {_rows(fx.PIZZA_RECIPES)}) t(pizza_id, toppings)",
    "toppings": f"SELECT * FROM (VALUES {_rows(fx.TOPPINGS)}) t(topping_id, topping_name)",
    "part_menu": "SELECT p_partkey AS pizza_id, p_name || ' #' || p_partkey AS pizza_name FROM part",
    "part_recipes": """
        SELECT p_partkey AS pizza_id,
               (p_partkey % 97) || ', ' || (100 + p_partkey % 89) || ', ' || (200 + p_size) || ', ' || (p_partkey % 7) AS toppings
        FROM part""",
    "supplier_toppings": "SELECT s_suppkey AS topping_id, s_name AS topping_name FROM supplier",
    "ratings": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderkey % 8 + 1 AS INTEGER) AS runner_id, CAST(o_orderkey % 5 + 1 AS INTEGER) AS rating,
               CASE WHEN o_orderkey % 7 <> 0 THEN {_TIME} END AS rating_time
        FROM orders WHERE o_orderstatus <> 'P'""",
    "plans": f"SELECT plan_id, plan_name, CAST(price AS DECIMAL(10, 2)) AS price FROM (VALUES {_rows(fx.PLANS)}) t(plan_id, plan_name, price)",
    "subs": """
        SELECT o_orderkey AS event_id, CASE WHEN o_custkey % 31 <> 4 THEN o_custkey END AS customer_id,
               CASE WHEN o_orderkey % 59 <> 11 THEN CASE WHEN o_custkey % 20 = 3 THEN make_date(year(o_orderdate), if(month(o_orderdate) > 6, 7, 1), 1)
                   ELSE CAST(o_orderdate AS DATE) END END AS start_date,
               CAST(CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 THEN 0
                         ELSE o_orderkey % 4 + 1 END AS INTEGER) AS plan_id
        FROM orders""",
    "retail": f"""
        SELECT CASE l_returnflag WHEN 'R' THEN 'C' ELSE '' END || o_orderkey AS invoice,
               CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN 'POSTAGE' WHEN l_partkey % 101 = 0 THEN 'Manual'
                    WHEN l_partkey % 103 = 0 THEN 'Dotcom Postage' ELSE p_name END AS description,
               CAST(l_quantity AS INTEGER) * CASE WHEN l_returnflag = 'R' OR l_partkey % 211 = 0 THEN -1 ELSE 1 END AS quantity,
               {_TIME} AS invoice_date,
               CAST(CASE WHEN l_partkey % 211 = 0 AND l_returnflag <> 'R' THEN 0 WHEN l_partkey % 503 = 0 THEN -p_retailprice
                         ELSE p_retailprice END AS DECIMAL(10, 2)) AS price,
               CASE WHEN o_custkey % 10 = 0 OR c_nationkey = 7 OR (l_partkey % 211 = 0 AND l_returnflag <> 'R') THEN NULL
                    ELSE o_custkey END AS customer_id,
               CASE WHEN c_nationkey = 4 THEN 'EIRE' WHEN c_nationkey BETWEEN 8 AND 15 THEN '{fx.HOME_MARKET}' ELSE n_name END AS country
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
             JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey,
             generate_series(1, 3) AS copies(copy)
        WHERE (copy = 1 OR o_orderkey % 40 = 0) AND strftime(o_orderdate, '%Y-%m') NOT IN ('1995-03', '1996-11')""",
    "retail_clean": """
        SELECT invoice, description, quantity, invoice_date, price, customer_id,
               CASE country WHEN 'EIRE' THEN 'Ireland' ELSE country END AS country,
               CAST(quantity * price AS DECIMAL(18, 2)) AS revenue
        FROM (SELECT DISTINCT * FROM retail) AS uniq WHERE quantity > 0 AND price > 0""",
    "soda": """
        SELECT CAST(l_shipdate AS DATE) AS sale_date, r_name AS region, p_name AS product, c_name AS customer,
               CAST(l_extendedprice AS DECIMAL(12, 2)) * (CAST(0.05 AS DECIMAL(4, 2)) - CAST(l_discount AS DECIMAL(4, 2))) AS profit
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
             JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "ad_spend": f"""
        SELECT 2012 + o_orderkey % 13 AS year, {_list(fx.AD_CHANNELS)}[o_custkey % 6 + 1] AS channel,
               CAST(o_totalprice AS DECIMAL(12, 2)) AS spend
        FROM orders""",
}

_NEEDS = {"co": ["co_raw"], "ro_text": ["ro_raw"], "ro": ["ro_text"], "retail_clean": ["retail"]}


def _with_needs(names: list[str]) -> list[str]:
    ordered: list[str] = []
    for name in names:
        for n in [*_with_needs(_NEEDS.get(name, [])), name]:
            if n not in ordered:
                ordered.append(n)
    return ordered


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """A non-negative quotient of whole numbers rounded half up, without floating point."""
    unit = 10**digits
    return f"(2 * CAST({numerator} AS HUGEINT) * {unit} + ({denominator})) // (2 * CAST({denominator} AS HUGEINT)) / {unit}.0::DOUBLE"


def check(tables: str, body: str) -> str:
    """A statement over adapted tables. `body` is a SELECT, or `name AS (...), ... SELECT ...` after a leading comma."""
    ctes = ",\n".join(f"{n} AS ({TABLES[n].strip()})" for n in _with_needs(tables.split()))
    return f"WITH RECURSIVE {ctes}\n{body.strip()}"
