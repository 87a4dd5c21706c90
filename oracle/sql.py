"""DuckDB SQL oracle: for each registered query, an independent SQL statement.

Every statement starts with the same WITH prefix, which rebuilds the
order-line fixture and the star from the raw driver tables in plain SQL
(global ``row_number`` for surrogate keys, ``arg_min`` for first rows), so
the comparison checks the Spark operators rather than a shared shortcut.
Money is ROUND(sum, 2) as DOUBLE; ratios divide as DOUBLE, pass through
DECIMAL(38,6) and round.  Only the CTEs a query names are evaluated.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

# The constraints of the warehouse schema, stated here apart from the library's own lists.
# NOT NULL columns (primary keys included), in the order of the schema
NOT_NULL = {
    "dim_date": "date_key full_date day month quarter year day_of_week day_name month_name is_weekend".split(),
    "dim_customer": "customer_key customer_id customer_name segment".split(),
    "dim_geography": "geography_key city state country region".split(),
    "dim_product": "product_key product_id product_name category sub_category".split(),
    "dim_ship_mode": "ship_mode_key ship_mode".split(),
    "fact_orders": ("order_line_key row_id order_id order_date_key ship_date_key ship_mode_key customer_key "
                    "geography_key product_key sales quantity discount profit").split(),
    "dim_product_recommendations": ("recommendation_key product_key recommended_product_key date_key "
                                    "recommendation_type recommendation_score").split(),
}
# PRIMARY KEY and UNIQUE
UNIQUE_KEYS = {
    "dim_date": [["date_key"], ["full_date"]],
    "dim_customer": [["customer_key"], ["customer_id"]],
    "dim_geography": [["geography_key"], ["postal_code", "city", "state"]],
    "dim_product": [["product_key"], ["product_id"]],
    "dim_ship_mode": [["ship_mode_key"], ["ship_mode"]],
    "fact_orders": [["order_line_key"], ["row_id"]],
    "dim_product_recommendations": [["recommendation_key"],
                                    ["product_key", "recommended_product_key", "date_key", "recommendation_type"]],
}
# VARCHAR(n)
MAX_LENGTHS = {
    "dim_date": {"day_name": 10, "month_name": 10},
    "dim_customer": {"customer_id": 20, "customer_name": 100, "segment": 50},
    "dim_geography": {"postal_code": 10, "city": 100, "state": 100, "country": 100, "region": 50},
    "dim_product": {"product_id": 50, "category": 50, "sub_category": 50},
    "dim_ship_mode": {"ship_mode": 50},
    "fact_orders": {"order_id": 20},
    "dim_product_recommendations": {"recommendation_type": 50},
}
# REFERENCES of the fact: column, table, key
FOREIGN_KEYS = [
    ("order_date_key", "dim_date", "date_key"),
    ("ship_date_key", "dim_date", "date_key"),
    ("ship_mode_key", "dim_ship_mode", "ship_mode_key"),
    ("customer_key", "dim_customer", "customer_key"),
    ("geography_key", "dim_geography", "geography_key"),
    ("product_key", "dim_product", "product_key"),
]


def MONEY(x: str) -> str:
    return f"CAST(ROUND({x}, 2) AS DOUBLE)"


def RND(x: str, s: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,6)), {s}) AS DOUBLE)"


def RATIO(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0))"


def PCT(n: str, d: str, s: int = 2) -> str:
    return RND(f"{RATIO(n, d)} * 100", s)


def AVG(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / COUNT({x}))"


def DATEKEY(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


MARGIN = PCT("SUM(profit)", "SUM(sales)")
WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"
NL = "chr(10)"


def CAL(d: str) -> str:
    return (
        f"{DATEKEY(d)} AS date_key, {d} AS full_date, CAST(day({d}) AS INTEGER) AS day, "
        f"CAST(month({d}) AS INTEGER) AS month, CAST(quarter({d}) AS INTEGER) AS quarter, "
        f"CAST(year({d}) AS INTEGER) AS year, CAST(isodow({d}) - 1 AS INTEGER) AS day_of_week, "
        f"dayname({d}) AS day_name, monthname({d}) AS month_name, isodow({d}) >= 6 AS is_weekend"
    )


def FIRST_DIM(src: str, keys: list[str], attrs: list[str], key_col: str, where: str = "TRUE") -> str:
    k = ", ".join(keys)
    a = ", ".join(f"arg_min({x}, row_id) AS {x}" for x in attrs)
    return (
        f"SELECT row_number() OVER (ORDER BY first_row) AS {key_col}, {k}, {', '.join(attrs)} FROM "
        f"(SELECT {k}, {a}, min(row_id) AS first_row FROM {src} WHERE {where} GROUP BY {k})"
    )


CTES = {
    "li": """SELECT *, row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS row_id FROM lineitem""",
    "flat": """SELECT row_id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS order_date,
        CAST(l_shipdate AS DATE) AS ship_date, o_orderpriority AS ship_mode, CAST(c_custkey AS VARCHAR) AS customer_id,
        c_name AS customer_name, c_mktsegment AS segment, 'United States' AS country,
        n_name || ' C' || CAST(c_custkey % 10 AS VARCHAR) AS city, n_name AS state,
        lpad(CAST(n_nationkey * 10 + c_custkey % 10 AS VARCHAR), 5, '0') AS postal_code, r_name AS region,
        CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category, p_brand AS sub_category, p_name AS product_name,
        CAST(l_extendedprice AS DECIMAL(12,4)) AS sales, CAST(l_quantity AS INTEGER) AS quantity,
        CAST(l_discount * 4 AS DECIMAL(5,4)) AS discount,
        CAST(CAST(l_extendedprice AS DECIMAL(12,4)) * (CAST(0.20 AS DECIMAL(5,4)) - CAST(l_discount * 4 AS DECIMAL(5,4))
             + CAST(l_tax AS DECIMAL(5,4)) - CAST(0.004 * n_nationkey AS DECIMAL(5,4))) AS DECIMAL(12,4)) AS profit
        FROM li JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        JOIN part ON l_partkey = p_partkey""",
    "dim_date": f"""SELECT {CAL('d')} FROM (SELECT order_date AS d FROM flat UNION SELECT ship_date FROM flat)
        WHERE d IS NOT NULL""",
    "dim_date_full": f"""SELECT * FROM dim_date UNION ALL
        SELECT {CAL('d')} FROM (SELECT DATE '2026-06-21' AS d) WHERE NOT EXISTS
        (SELECT 1 FROM dim_date WHERE date_key = 20260621)""",
    "dim_customer": FIRST_DIM("flat", ["customer_id"], ["customer_name", "segment"], "customer_key",
                              "customer_id IS NOT NULL"),
    "dim_geography": FIRST_DIM("flat", ["postal_code", "city", "state"], ["country", "region"], "geography_key"),
    "dim_product": FIRST_DIM("flat", ["product_id"], ["product_name", "category", "sub_category"], "product_key",
                             "product_id IS NOT NULL"),
    "dim_ship_mode": """SELECT row_number() OVER (ORDER BY first_row) AS ship_mode_key, ship_mode FROM
        (SELECT ship_mode, min(row_id) AS first_row FROM flat WHERE ship_mode IS NOT NULL GROUP BY ship_mode)""",
    "fact": f"""SELECT row_number() OVER (ORDER BY f.row_id) AS order_line_key, f.row_id, f.order_id,
        {DATEKEY('f.order_date')} AS order_date_key, {DATEKEY('f.ship_date')} AS ship_date_key, s.ship_mode_key,
        c.customer_key, g.geography_key, p.product_key, f.sales, f.quantity, f.discount, f.profit,
        CAST(f.sales * (1 - f.discount) AS DECIMAL(12,4)) AS revenue_after_discount
        FROM flat f JOIN dim_customer c ON f.customer_id = c.customer_id
        JOIN dim_product p ON f.product_id = p.product_id
        JOIN dim_geography g ON f.postal_code IS NOT DISTINCT FROM g.postal_code AND f.city = g.city
             AND f.state = g.state
        JOIN dim_ship_mode s ON f.ship_mode = s.ship_mode""",
    "prod_tot": """SELECT p.product_key, p.product_id, p.product_name, p.category, p.sub_category,
        SUM(f.sales) AS revenue, CAST(SUM(f.quantity) AS BIGINT) AS units_sold, SUM(f.profit) AS profit
        FROM fact f JOIN dim_product p ON f.product_key = p.product_key GROUP BY ALL""",
    "ranking": "SELECT *, row_number() OVER (ORDER BY revenue DESC, product_id) AS revenue_rank FROM prod_tot",
    "pairs": """SELECT CAST(p_partkey AS VARCHAR) AS source_product_id,
        CAST(p_partkey + 7 AS VARCHAR) AS recommended_product_id,
        CASE p_partkey % 3 WHEN 0 THEN 'substitute' WHEN 1 THEN 'cross_sell' ELSE 'upsell' END AS recommendation_type,
        CAST(CAST(p_partkey * 37 % 100 AS DOUBLE) / 100 AS DECIMAL(5,4)) AS recommendation_score,
        'pairs with ' || p_name AS recommendation_reason FROM part""",
    "known": """SELECT * FROM pairs WHERE source_product_id IN (SELECT product_id FROM ranking)
        AND recommended_product_id IN (SELECT product_id FROM ranking)""",
    "resolved": """SELECT s.product_key, r.product_key AS recommended_product_key, 20260621 AS date_key,
        k.recommendation_type, k.recommendation_score, k.recommendation_reason
        FROM known k JOIN dim_product s ON k.source_product_id = s.product_id
        JOIN dim_product r ON k.recommended_product_id = r.product_id""",
    "recs": """SELECT row_number() OVER (ORDER BY product_key, recommended_product_key, date_key, recommendation_type,
        recommendation_score, recommendation_reason) AS recommendation_key, * FROM resolved""",
    "base": f"""SELECT CAST(row_id AS VARCHAR) AS row_id, order_id,
        CASE WHEN row_id % 97 = 0 THEN '13/45/2016' ELSE strftime(order_date, '%-m/%-d/%Y') END AS order_date,
        strftime(ship_date, '%-m/%-d/%Y') AS ship_date,
        CASE WHEN row_id % 7 = 0 THEN ship_mode || ' ' ELSE ship_mode END AS ship_mode,
        CASE WHEN row_id % 7 = 0 THEN '  ' || customer_id || ' ' WHEN row_id % 101 = 0 THEN NULL
             ELSE customer_id END AS customer_id,
        customer_name, segment, country, city, state, postal_code, region,
        CASE WHEN row_id % 7 = 0 THEN ' ' || product_id || '  ' ELSE product_id END AS product_id,
        category, sub_category, product_name, CAST(sales AS VARCHAR) AS sales, CAST(quantity AS VARCHAR) AS quantity,
        CAST(discount AS VARCHAR) AS discount, CAST(profit AS VARCHAR) AS profit FROM flat""",
    "raw": "SELECT * FROM base UNION ALL SELECT * FROM base WHERE CAST(row_id AS BIGINT) % 50 = 0",
    "dedup": "SELECT DISTINCT * FROM raw",
    "parsed": """SELECT * REPLACE (CAST(try_strptime(order_date, '%m/%d/%Y') AS DATE) AS order_date,
        CAST(try_strptime(ship_date, '%m/%d/%Y') AS DATE) AS ship_date) FROM dedup""",
    "kept": """SELECT * FROM parsed WHERE order_date IS NOT NULL AND ship_date IS NOT NULL
        AND customer_id IS NOT NULL AND product_id IS NOT NULL""",
    "cleaned": f"""SELECT CAST(row_id AS BIGINT) AS row_id, {DATEKEY('order_date')} AS order_date_key,
        {DATEKEY('ship_date')} AS ship_date_key, trim(customer_id, {WS}) AS customer_id,
        trim(product_id, {WS}) AS product_id, trim(ship_mode, {WS}) AS ship_mode,
        trim(postal_code, {WS}) AS postal_code FROM kept""",
    "loaded": f"""SELECT CAST(row_id AS BIGINT) AS row_id, order_id, order_date, ship_date,
        trim(ship_mode, {WS}) AS ship_mode, trim(customer_id, {WS}) AS customer_id, trim(product_id, {WS}) AS product_id,
        category, state, region, city, trim(postal_code, {WS}) AS postal_code,
        CAST(sales AS DECIMAL(12,4)) AS sales, CAST(profit AS DECIMAL(12,4)) AS profit FROM kept""",
    "rej": """SELECT COUNT(*) AS distinct_rows,
        COUNT(*) FILTER (WHERE order_date IS NULL) AS null_order_date,
        COUNT(*) FILTER (WHERE ship_date IS NULL) AS null_ship_date,
        COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_customer_id,
        COUNT(*) FILTER (WHERE product_id IS NULL) AS null_product_id,
        COUNT(*) FILTER (WHERE order_date IS NULL OR ship_date IS NULL OR customer_id IS NULL
                         OR product_id IS NULL) AS dropped_rows FROM parsed""",
    # a star with faults of every kind
    "bad_date": "SELECT * REPLACE (CASE WHEN day = 13 THEN NULL ELSE month_name END AS month_name) FROM dim_date_full",
    "bad_customer": """SELECT * REPLACE (CASE WHEN customer_key % 7 = 0 THEN NULL ELSE segment END AS segment,
        CASE WHEN customer_key % 9 = 0 THEN repeat('x', 101) ELSE customer_name END AS customer_name) FROM dim_customer
        UNION ALL SELECT * FROM dim_customer WHERE customer_key % 11 = 0""",
    "bad_product": """SELECT * REPLACE (CASE WHEN product_key % 13 = 0 THEN repeat('y', 51) ELSE category END AS category)
        FROM dim_product WHERE product_key % 17 <> 0""",
    "bad_fact": """SELECT * REPLACE (CASE WHEN row_id % 53 = 0 THEN NULL ELSE order_id END AS order_id,
        CASE WHEN row_id % 101 = 0 THEN -1 ELSE ship_mode_key END AS ship_mode_key,
        CASE WHEN row_id % 103 = 0 THEN NULL ELSE geography_key END AS geography_key) FROM fact
        UNION ALL SELECT * FROM fact WHERE row_id % 1000 = 1""",
    "bad_recs": """SELECT * REPLACE (CASE WHEN recommendation_key % 5 = 0 THEN recommendation_score + 2
        WHEN recommendation_key % 5 = 1 THEN -0.5 ELSE recommendation_score END AS recommendation_score) FROM recs""",
    "b1": "SELECT * FROM flat WHERE order_date < DATE '1995-06-01'",
    "b2": "SELECT * REPLACE (upper(customer_name) AS customer_name) FROM flat WHERE order_date >= DATE '1995-06-01'",
    "c1": FIRST_DIM("b1", ["customer_id"], ["customer_name", "segment"], "customer_key", "customer_id IS NOT NULL"),
    "c2in": """SELECT customer_id, arg_min(customer_name, row_id) AS customer_name, arg_min(segment, row_id) AS segment,
        min(row_id) AS first_row FROM b2 GROUP BY customer_id""",
    "g1": FIRST_DIM("b1", ["postal_code", "city", "state"], ["country", "region"], "geography_key"),
    "p1": FIRST_DIM("b1", ["product_id"], ["product_name", "category", "sub_category"], "product_key",
                    "product_id IS NOT NULL"),
    "s1": """SELECT row_number() OVER (ORDER BY first_row) AS ship_mode_key, ship_mode FROM
        (SELECT ship_mode, min(row_id) AS first_row FROM b1 WHERE ship_mode IS NOT NULL GROUP BY ship_mode)""",
    "f1": """SELECT row_number() OVER (ORDER BY f.row_id) AS order_line_key, f.row_id FROM b1 f
        JOIN c1 ON f.customer_id = c1.customer_id JOIN p1 ON f.product_id = p1.product_id
        JOIN g1 ON f.postal_code IS NOT DISTINCT FROM g1.postal_code AND f.city = g1.city AND f.state = g1.state
        JOIN s1 ON f.ship_mode = s1.ship_mode""",
    "c12": """SELECT c1.customer_key, c1.customer_id,
        CASE WHEN i.first_row IS NOT NULL THEN i.customer_name ELSE c1.customer_name END AS customer_name
        FROM c1 LEFT JOIN c2in i ON c1.customer_id = i.customer_id
        UNION ALL
        SELECT (SELECT COALESCE(MAX(customer_key), 0) FROM c1) + row_number() OVER (ORDER BY first_row),
        customer_id, customer_name FROM c2in WHERE customer_id NOT IN (SELECT customer_id FROM c1)""",
    "p12": """SELECT product_key, product_id FROM p1 UNION ALL
        SELECT (SELECT COALESCE(MAX(product_key), 0) FROM p1) + row_number() OVER (ORDER BY first_row), product_id
        FROM (SELECT product_id, min(row_id) AS first_row FROM b2 GROUP BY product_id)
        WHERE product_id NOT IN (SELECT product_id FROM p1)""",
    "g12": """SELECT geography_key, postal_code, city, state FROM g1 UNION ALL
        SELECT (SELECT COALESCE(MAX(geography_key), 0) FROM g1) + row_number() OVER (ORDER BY first_row),
        postal_code, city, state FROM g2in n WHERE NOT EXISTS (SELECT 1 FROM g1 o
        WHERE o.postal_code IS NOT DISTINCT FROM n.postal_code AND o.city = n.city AND o.state = n.state)""",
    "s12": """SELECT ship_mode_key, ship_mode FROM s1 UNION ALL
        SELECT (SELECT COALESCE(MAX(ship_mode_key), 0) FROM s1) + row_number() OVER (ORDER BY first_row), ship_mode
        FROM (SELECT ship_mode, min(row_id) AS first_row FROM b2 GROUP BY ship_mode)
        WHERE ship_mode NOT IN (SELECT ship_mode FROM s1)""",
    "g2in": """SELECT postal_code, city, state, arg_min(country, row_id) AS country, arg_min(region, row_id) AS region,
        min(row_id) AS first_row FROM b2 GROUP BY postal_code, city, state""",
}
ORDER = list(CTES)


def _deps(sql: str) -> set[str]:
    import re

    words = set(re.findall(r"[a-z_0-9]+", sql))
    return {c for c in CTES if c in words}


def with_prefix(body: str) -> str:
    """``body`` preceded by the CTEs it needs (transitively), each after the CTEs it uses."""
    emitted: list[str] = []

    def visit(c: str, path: tuple[str, ...] = ()) -> None:
        if c in emitted:
            return
        if c in path:
            raise ValueError(f"cyclic CTEs: {path + (c,)}")
        for d in sorted(_deps(CTES[c]) - {c}, key=ORDER.index):
            visit(d, path + (c,))
        emitted.append(c)

    for c in sorted(_deps(body), key=ORDER.index):
        visit(c)
    parts = [f"{c} AS ({CTES[c]})" for c in emitted]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _dollars(x: str) -> str:
    return f"CASE WHEN {x} < 0 THEN '-$' || format('{{:,.2f}}', -({x})) ELSE '$' || format('{{:,.2f}}', {x}) END"


RULE = "repeat('=', 80)"
REPORT_HEADER = (f"{RULE} || chr(10) || 'TOP SELLING PRODUCTS - PRODUCT REPORT' || chr(10) || "
                 f"'Generated: 2026-06-21' || chr(10) || {RULE} || chr(10) || chr(10)")
REPORT_BLOCK = f"""'RANK #' || CAST(revenue_rank AS VARCHAR) || {NL} || repeat('-', 80) || {NL}
    || 'Product ID   : ' || product_id || {NL} || 'Product Name : ' || product_name || {NL}
    || 'Category     : ' || concat_ws(' > ', category, sub_category) || {NL}
    || 'DB Metrics   : Revenue ' || {_dollars(MONEY('revenue'))} || ' | Units Sold ' || CAST(units_sold AS VARCHAR)
    || ' | Profit ' || {_dollars(MONEY('profit'))}
    || ' | Margin ~' || format('{{:,.1f}}', COALESCE({PCT('profit', 'revenue', 1)}, 0.0)) || '%' || {NL} || {NL}
    || 'WEB INTELLIGENCE:' || {NL}
    || CASE WHEN revenue_rank % 2 = 1 THEN '- Brand: ' || sub_category || {NL} || '- Type: ' || category ELSE '' END
    || {NL} || {NL} || 'Sources:' || {NL} || '- none' || {NL} || {NL} || {RULE}"""


CTES["report_text"] = f"""SELECT file_no, {REPORT_HEADER} || string_agg(block, {NL} || {NL} ORDER BY revenue_rank)
    || {NL} || {NL} AS value
    FROM (SELECT revenue_rank, (revenue_rank - 1) // 100 AS file_no, {REPORT_BLOCK} AS block FROM ranking)
    GROUP BY file_no"""
ORDER.append("report_text")


# tables of the star as the oracle names them
STAR_CTE = {
    "dim_date": "dim_date_full", "dim_customer": "dim_customer", "dim_geography": "dim_geography",
    "dim_product": "dim_product", "dim_ship_mode": "dim_ship_mode", "fact_orders": "fact",
    "dim_product_recommendations": "recs",
}
TABLE_ORDER = list(STAR_CTE)


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _audit_not_null(cte: dict[str, str] = STAR_CTE) -> str:
    parts = []
    for t in TABLE_ORDER:
        for c in NOT_NULL[t]:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS item, "
                         f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n FROM {cte[t]}")
    return _union(parts)


def _audit_unique(cte: dict[str, str] = STAR_CTE) -> str:
    parts = []
    for t in TABLE_ORDER:
        for key in UNIQUE_KEYS[t]:
            k = ", ".join(key)
            parts.append(f"SELECT '{t}' AS table_name, '{','.join(key)}' AS item, "
                         f"CAST(COUNT(*) FILTER (WHERE c > 1) AS BIGINT) AS n FROM "
                         f"(SELECT {k}, COUNT(*) AS c FROM {cte[t]} GROUP BY {k})")
    return _union(parts)


def _audit_fk(cte: dict[str, str] = STAR_CTE) -> str:
    checks = [("fact_orders", FOREIGN_KEYS), ("dim_product_recommendations", [
        ("product_key", "dim_product", "product_key"),
        ("recommended_product_key", "dim_product", "product_key"),
        ("date_key", "dim_date", "date_key")])]
    parts = []
    for t, fks in checks:
        for col, dim, key in fks:
            parts.append(f"SELECT '{t}' AS table_name, '{col}->{dim}' AS item, "
                         f"CAST(COUNT(*) FILTER (WHERE f.{col} IS NOT NULL AND d.{key} IS NULL) AS BIGINT) AS n "
                         f"FROM {cte[t]} f LEFT JOIN (SELECT DISTINCT {key} FROM {cte[dim]}) d "
                         f"ON f.{col} = d.{key}")
    return _union(parts)


def _audit_checks(cte: dict[str, str] = STAR_CTE) -> str:
    parts = []
    for t in TABLE_ORDER:
        for c, n in MAX_LENGTHS.get(t, {}).items():
            parts.append(f"SELECT '{t}' AS table_name, 'len({c})<={n}' AS item, "
                         f"CAST(COUNT(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS n FROM {cte[t]}")
        if t == "dim_product_recommendations":
            parts.append(f"SELECT '{t}' AS table_name, 'recommendation_score between 0 and 1' AS item, "
                         "CAST(COUNT(*) FILTER (WHERE recommendation_score < 0 OR recommendation_score > 1) "
                         f"AS BIGINT) AS n FROM {cte[t]}")
    return _union(parts)


def _audit_all(cte: dict[str, str]) -> str:
    """The four audits, with their names, over another set of tables."""
    named = [("not_null", _audit_not_null), ("unique", _audit_unique), ("foreign_key", _audit_fk), ("check", _audit_checks)]
    return _union([f"SELECT '{name}' AS audit, * FROM ({audit(cte)})" for name, audit in named])


def _counts(items: list[tuple[str, str]]) -> str:
    return _union([f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n FROM {cte}" for name, cte in items])


FACT_DOUBLE = """order_line_key, row_id, order_id, order_date_key, ship_date_key, ship_mode_key, customer_key,
    geography_key, product_key, CAST(sales AS DOUBLE) AS sales, quantity, CAST(discount AS DOUBLE) AS discount,
    CAST(profit AS DOUBLE) AS profit, CAST(revenue_after_discount AS DOUBLE) AS revenue_after_discount"""

GQ06 = f"""SELECT p.category, p.sub_category, {RND(AVG('fo.discount') + ' * 100', 2)} AS avg_discount_pct,
    {MONEY('SUM(fo.sales)')} AS total_revenue, {MONEY('SUM(fo.profit)')} AS total_profit,
    {PCT('SUM(fo.profit)', 'SUM(fo.sales)')} AS profit_margin_pct
    FROM fact fo JOIN dim_product p ON fo.product_key = p.product_key GROUP BY p.category, p.sub_category"""

REPORT_COLS = f"""revenue_rank, product_id, product_name, category, sub_category,
    concat_ws(' > ', category, sub_category) AS category_path, {MONEY('revenue')} AS total_revenue, units_sold,
    {MONEY('profit')} AS total_profit, {PCT('profit', 'revenue', 1)} AS profit_margin_pct"""

TIER = ("CASE WHEN discount = 0 THEN 'No Discount' WHEN discount <= 0.20 THEN '{m}' "
        "ELSE 'Heavy (>20%)' END")
TIER_GOLDEN = TIER.format(m="Moderate (1–20%)")
TIER_ASCII = TIER.format(m="Moderate (1-20%)")

V1 = """SELECT fo.order_line_key, fo.order_id, fo.row_id, CAST(fo.sales AS DOUBLE) AS sales, fo.quantity,
    CAST(fo.discount AS DOUBLE) AS discount, CAST(fo.profit AS DOUBLE) AS profit,
    CAST(fo.revenue_after_discount AS DOUBLE) AS revenue_after_discount, dd.full_date AS order_date,
    dd.year AS order_year, dd.quarter AS order_quarter, dd.month AS order_month, dd.month_name AS order_month_name,
    dc.customer_name, dc.segment, dg.city, dg.state, dg.region, dg.country, dp.product_name, dp.category,
    dp.sub_category, ds.ship_mode
    FROM fact fo JOIN dim_date_full dd ON fo.order_date_key = dd.date_key
    JOIN dim_customer dc ON fo.customer_key = dc.customer_key
    JOIN dim_geography dg ON fo.geography_key = dg.geography_key
    JOIN dim_product dp ON fo.product_key = dp.product_key
    JOIN dim_ship_mode ds ON fo.ship_mode_key = ds.ship_mode_key"""

V2_FROM = """FROM fact fo JOIN dim_product p ON fo.product_key = p.product_key
    JOIN dim_customer c ON fo.customer_key = c.customer_key
    JOIN dim_geography g ON fo.geography_key = g.geography_key"""

V3 = """SELECT r.recommendation_key, s.product_id AS source_product_id, s.product_name AS source_product_name,
    t.product_id AS recommended_product_id, t.product_name AS recommended_product_name, r.recommendation_type,
    CAST(r.recommendation_score AS DOUBLE) AS recommendation_score, r.recommendation_reason,
    d.full_date AS recommendation_date
    FROM recs r JOIN dim_product s ON r.product_key = s.product_key
    JOIN dim_product t ON r.recommended_product_key = t.product_key
    JOIN dim_date_full d ON r.date_key = d.date_key"""

MAIN_FROM = """FROM fact fo JOIN dim_date_full dd ON fo.order_date_key = dd.date_key
    JOIN dim_customer dc ON fo.customer_key = dc.customer_key
    JOIN dim_geography dg ON fo.geography_key = dg.geography_key
    JOIN dim_product dp ON fo.product_key = dp.product_key
    JOIN dim_ship_mode ds ON fo.ship_mode_key = ds.ship_mode_key"""

M = {
    "total_revenue": "CAST(SUM(fo.sales) AS DOUBLE)",
    "total_profit": "CAST(SUM(fo.profit) AS DOUBLE)",
    "profit_margin_pct": f"{RATIO('SUM(fo.profit)', 'SUM(fo.sales)')} * 100",
    "total_quantity": "CAST(SUM(fo.quantity) AS BIGINT)",
    "avg_order_value": RATIO("SUM(fo.sales)", "COUNT(DISTINCT fo.order_id)"),
    "revenue_after_discount": "CAST(SUM(fo.revenue_after_discount) AS DOUBLE)",
    "total_discount_impact": "CAST(SUM(fo.sales * fo.discount) AS DOUBLE)",
    "order_count": "CAST(COUNT(DISTINCT fo.order_id) AS BIGINT)",
}
METRIC_KEYS = {
    "total_revenue": "metric_total_revenue", "total_profit": "metric_total_profit",
    "profit_margin_pct": "metric_profit_margin_pct", "total_quantity": "metric_total_quantity",
    "avg_order_value": "metric_avg_order_value", "revenue_after_discount": "metric_net_revenue",
    "total_discount_impact": "metric_discount_impact", "order_count": "metric_order_count",
}


def _ms(*names: str) -> str:
    return ", ".join(f"{M[n]} AS {n}" for n in names)


BODIES: dict[str, str] = {
    # sources and sinks
    "csv_source": "SELECT * FROM raw",
    "csv_awkward_files": """SELECT * REPLACE (customer_name || ' é' AS customer_name,
        CASE WHEN CAST(row_id AS BIGINT) % 11 = 0 THEN product_name || chr(10) || '"x", y' ELSE product_name END AS product_name,
        CASE WHEN CAST(row_id AS BIGINT) % 3 = 2 AND CAST(row_id AS BIGINT) % 13 = 0 THEN NULL ELSE segment END AS segment) FROM raw""",
    "csv_ragged_rows": """SELECT CAST(id % 3 AS INTEGER) AS part, id % 3 <> 1 AS utf8, COUNT(*) AS rows,
        COUNT(*) FILTER (id % 3 = 2 AND id % 13 = 0) AS short_rows, COUNT(*) FILTER (id % 3 = 1 AND id % 17 = 0) AS surplus_rows
        FROM (SELECT CAST(row_id AS BIGINT) AS id FROM raw) GROUP BY ALL""",
    "report_source": """SELECT file_no, i AS line_no, parts[i] AS line
        FROM (SELECT file_no, string_split(value, chr(10)) AS parts FROM report_text) t, range(1, len(parts)) r(i)""",
    "recommendation_source": """SELECT source_product_id, recommended_product_id, recommendation_type,
        CAST(recommendation_score AS DOUBLE) AS recommendation_score, recommendation_reason FROM pairs""",
    "star_sink": _counts([(t, STAR_CTE[t]) for t in TABLE_ORDER]),
    # cleaning
    "clean_dedup_rows": "SELECT * FROM dedup",
    "clean_parse_dates": "SELECT CAST(row_id AS BIGINT) AS row_id, order_date, ship_date FROM parsed",
    "clean_drop_null_keys": """SELECT CAST(row_id AS BIGINT) AS row_id, order_date, ship_date, customer_id, product_id
        FROM kept""",
    "clean_reject_counts": """SELECT (SELECT COUNT(*) FROM raw) AS raw_rows,
        (SELECT COUNT(*) FROM raw) - distinct_rows AS duplicate_rows, null_order_date, null_ship_date,
        null_customer_id, null_product_id, dropped_rows, distinct_rows - dropped_rows AS clean_rows FROM rej""",
    "clean_date_keys": "SELECT row_id, order_date_key, ship_date_key FROM cleaned",
    "clean_normalise_strings": "SELECT row_id, customer_id, product_id, ship_mode, postal_code FROM cleaned",
    # dimensions
    "dim_date_build": "SELECT * FROM dim_date",
    "dim_date_ensure": "SELECT * FROM dim_date_full",
    "dim_customer_build": "SELECT * FROM dim_customer",
    "dim_geography_build": "SELECT * FROM dim_geography",
    "dim_product_build": "SELECT * FROM dim_product",
    "dim_ship_mode_build": "SELECT * FROM dim_ship_mode",
    "assign_surrogate_keys": "SELECT * FROM li",
    "upsert_update": """SELECT c1.customer_key, c1.customer_id,
        CASE WHEN i.first_row IS NOT NULL THEN i.customer_name ELSE c1.customer_name END AS customer_name,
        CASE WHEN i.first_row IS NOT NULL THEN i.segment ELSE c1.segment END AS segment
        FROM c1 LEFT JOIN c2in i ON c1.customer_id = i.customer_id
        UNION ALL
        SELECT (SELECT COALESCE(MAX(customer_key), 0) FROM c1) + row_number() OVER (ORDER BY first_row),
        customer_id, customer_name, segment FROM c2in WHERE customer_id NOT IN (SELECT customer_id FROM c1)""",
    "upsert_ignore": """SELECT * FROM g1
        UNION ALL
        SELECT (SELECT COALESCE(MAX(geography_key), 0) FROM g1) + row_number() OVER (ORDER BY first_row),
        postal_code, city, state, country, region FROM g2in n WHERE NOT EXISTS (SELECT 1 FROM g1 o
        WHERE o.postal_code IS NOT DISTINCT FROM n.postal_code AND o.city = n.city AND o.state = n.state)""",
    "star_incremental_load": f"""SELECT COALESCE(f1.order_line_key,
             (SELECT COUNT(*) FROM f1) + row_number() OVER (PARTITION BY f1.row_id IS NULL ORDER BY f.row_id))
             AS order_line_key,
        f.row_id, c.customer_key, c.customer_name, p.product_key, g.geography_key, s.ship_mode_key, s.ship_mode,
        {DATEKEY('f.order_date')} AS order_date_key
        FROM (SELECT * FROM b1 UNION ALL SELECT * FROM b2) f LEFT JOIN f1 ON f.row_id = f1.row_id
        JOIN c12 c ON f.customer_id = c.customer_id JOIN p12 p ON f.product_id = p.product_id
        JOIN g12 g ON f.postal_code IS NOT DISTINCT FROM g.postal_code AND f.city = g.city AND f.state = g.state
        JOIN s12 s ON f.ship_mode = s.ship_mode""",
    # facts, publish, audits
    "fact_resolve_keys": "SELECT row_id, customer_key, product_key, geography_key, ship_mode_key FROM fact",
    "fact_skipped": """SELECT
        COUNT(*) FILTER (WHERE c.hit IS NULL OR p.hit IS NULL OR g.hit IS NULL OR s.hit IS NULL) AS skipped_rows,
        COUNT(*) FILTER (WHERE c.hit IS NULL) AS missing_customer, COUNT(*) FILTER (WHERE p.hit IS NULL) AS missing_product,
        COUNT(*) FILTER (WHERE g.hit IS NULL) AS missing_geography,
        COUNT(*) FILTER (WHERE s.hit IS NULL) AS missing_ship_mode
        FROM flat f
        LEFT JOIN (SELECT DISTINCT customer_id, 1 AS hit FROM b1) c ON f.customer_id = c.customer_id
        LEFT JOIN (SELECT DISTINCT product_id, 1 AS hit FROM b1) p ON f.product_id = p.product_id
        LEFT JOIN (SELECT DISTINCT postal_code, city, state, 1 AS hit FROM b1) g
             ON f.postal_code IS NOT DISTINCT FROM g.postal_code AND f.city = g.city AND f.state = g.state
        LEFT JOIN (SELECT DISTINCT ship_mode, 1 AS hit FROM b1) s ON f.ship_mode = s.ship_mode""",
    "fact_project": f"SELECT {FACT_DOUBLE} FROM fact",
    "fact_load_idempotent": """SELECT row_number() OVER (ORDER BY row_id) AS order_line_key, row_id, order_id
        FROM fact WHERE order_date_key < 19950601
        UNION ALL
        SELECT (SELECT COUNT(*) FROM fact WHERE order_date_key < 19950601) + row_number() OVER (ORDER BY row_id),
        row_id, order_id FROM fact WHERE order_date_key >= 19950601""",
    "publish_atomic": """SELECT '1 first load' AS step, CAST(1 AS BIGINT) AS versions, COUNT(*) AS fact_rows FROM b1
        UNION ALL SELECT '2 increment', 2, COUNT(*) FROM flat UNION ALL SELECT '3 orphans refused', 2, COUNT(*) FROM flat""",
    "load_summary": _union([
        "SELECT 'dim_date' AS item, COUNT(*) AS n FROM (SELECT order_date FROM loaded UNION SELECT ship_date FROM loaded)",
        "SELECT 'dim_customer' AS item, COUNT(DISTINCT customer_id) AS n FROM loaded",
        "SELECT 'dim_geography' AS item, COUNT(*) AS n FROM (SELECT DISTINCT postal_code, city, state FROM loaded)",
        "SELECT 'dim_product' AS item, COUNT(DISTINCT product_id) AS n FROM loaded",
        "SELECT 'dim_ship_mode' AS item, COUNT(DISTINCT ship_mode) AS n FROM loaded",
        "SELECT 'fact_orders' AS item, COUNT(DISTINCT row_id) AS n FROM loaded",
        "SELECT 'dropped_rows' AS item, dropped_rows AS n FROM rej",
        "SELECT 'duplicate_rows' AS item, (SELECT COUNT(*) FROM raw) - distinct_rows AS n FROM rej",
        # rows of the load without a dimension row: each key is in the same rows, so only a NULL can miss
        """SELECT 'skipped_rows' AS item, COUNT(*) AS n FROM loaded
           WHERE customer_id IS NULL OR product_id IS NULL OR ship_mode IS NULL OR city IS NULL OR state IS NULL""",
    ]),
    "csv_load_category_margin": f"""SELECT category, {MONEY('SUM(sales)')} AS total_revenue, {MONEY('SUM(profit)')} AS total_profit,
        {MARGIN} AS profit_margin_pct FROM loaded GROUP BY category""",
    "csv_load_loss_states": f"""SELECT state, region, {MONEY('SUM(sales)')} AS total_revenue, {MONEY('SUM(profit)')} AS total_profit,
        COUNT(DISTINCT order_id) AS order_count FROM loaded GROUP BY state, region HAVING SUM(profit) < 0""",
    "metric_daily_revenue": """SELECT order_date, CAST(SUM(sales) AS DOUBLE) AS total_revenue FROM flat GROUP BY order_date""",
    "audit_not_null": _audit_not_null(),
    "audit_unique": _audit_unique(),
    "audit_foreign_keys": _audit_fk(),
    "audit_checks": _audit_checks(),
    "audit_faulty_star": _audit_all({**STAR_CTE, "dim_date": "bad_date", "dim_customer": "bad_customer", "dim_product": "bad_product",
                                     "fact_orders": "bad_fact", "dim_product_recommendations": "bad_recs"}),
    # golden queries
    "kpi_total": f"""SELECT {MONEY('SUM(sales)')} AS total_revenue, {MONEY('SUM(profit)')} AS total_profit,
        {MARGIN} AS profit_margin_pct FROM fact""",
    "category_margin": f"""SELECT p.category, {MONEY('SUM(fo.sales)')} AS total_revenue,
        {MONEY('SUM(fo.profit)')} AS total_profit, {PCT('SUM(fo.profit)', 'SUM(fo.sales)')} AS profit_margin_pct
        FROM fact fo JOIN dim_product p ON fo.product_key = p.product_key GROUP BY p.category
        ORDER BY total_revenue DESC""",
    "top_customers": f"""SELECT c.customer_name, c.segment, {MONEY('SUM(fo.profit)')} AS total_profit,
        {MONEY('SUM(fo.sales)')} AS total_revenue, COUNT(DISTINCT fo.order_id) AS number_of_orders
        FROM fact fo JOIN dim_customer c ON fo.customer_key = c.customer_key GROUP BY c.customer_name, c.segment
        ORDER BY total_profit DESC, c.customer_name, c.segment LIMIT 10""",
    "yoy_trend": f"""SELECT year, {MONEY('revenue')} AS total_revenue, {MONEY('profit')} AS total_profit,
        {PCT('revenue - LAG(revenue) OVER (ORDER BY year)', 'LAG(revenue) OVER (ORDER BY year)')}
            AS revenue_yoy_pct_change,
        {PCT('profit - LAG(profit) OVER (ORDER BY year)', 'LAG(profit) OVER (ORDER BY year)')}
            AS profit_yoy_pct_change
        FROM (SELECT d.year, SUM(fo.sales) AS revenue, SUM(fo.profit) AS profit FROM fact fo
              JOIN dim_date_full d ON fo.order_date_key = d.date_key GROUP BY d.year) ORDER BY year""",
    "loss_states": f"""SELECT g.state, g.region, {MONEY('SUM(fo.sales)')} AS total_revenue,
        {MONEY('SUM(fo.profit)')} AS total_profit, COUNT(DISTINCT fo.order_id) AS order_count
        FROM fact fo JOIN dim_geography g ON fo.geography_key = g.geography_key GROUP BY g.state, g.region
        HAVING SUM(fo.profit) < 0 ORDER BY total_profit ASC""",
    "subcategory_discount": GQ06 + " ORDER BY profit_margin_pct ASC",
    "ship_mode_efficiency": f"""SELECT sm.ship_mode, COUNT(*) AS order_line_count,
        COUNT(DISTINCT fo.order_id) AS unique_orders, {RND(AVG('fo.profit'), 2)} AS avg_profit_per_line,
        {RND(AVG('fo.sales'), 2)} AS avg_revenue_per_line,
        {RND(AVG("date_diff('day', order_d.full_date, ship_d.full_date)"), 1)} AS avg_days_to_ship
        FROM fact fo JOIN dim_ship_mode sm ON fo.ship_mode_key = sm.ship_mode_key
        JOIN dim_date_full order_d ON fo.order_date_key = order_d.date_key
        JOIN dim_date_full ship_d ON fo.ship_date_key = ship_d.date_key
        GROUP BY sm.ship_mode ORDER BY avg_profit_per_line DESC""",
    "segment_quarterly": f"""SELECT d.year, d.quarter, c.segment, {MONEY('SUM(fo.sales)')} AS total_revenue,
        {MONEY('SUM(fo.profit)')} AS total_profit, COUNT(DISTINCT fo.order_id) AS order_count
        FROM fact fo JOIN dim_date_full d ON fo.order_date_key = d.date_key
        JOIN dim_customer c ON fo.customer_key = c.customer_key
        GROUP BY d.year, d.quarter, c.segment ORDER BY d.year, d.quarter, c.segment""",
    "top_product_per_category": f"""SELECT category, product_name, total_revenue, total_profit, total_units_sold
        FROM (SELECT *, RANK() OVER (PARTITION BY category ORDER BY total_revenue DESC) AS revenue_rank FROM
              (SELECT p.category, p.product_name, {MONEY('SUM(fo.sales)')} AS total_revenue,
                      {MONEY('SUM(fo.profit)')} AS total_profit, CAST(SUM(fo.quantity) AS BIGINT) AS total_units_sold
               FROM fact fo JOIN dim_product p ON fo.product_key = p.product_key
               GROUP BY p.category, p.product_name))
        WHERE revenue_rank = 1 ORDER BY total_revenue DESC""",
    "discount_tier_matrix": f"""SELECT {TIER_GOLDEN.replace('discount', 'fo.discount')} AS discount_tier,
        c.segment, g.region, COUNT(*) AS order_line_count, {MONEY('SUM(fo.sales)')} AS total_revenue,
        {MONEY('SUM(fo.profit)')} AS total_profit, {PCT('SUM(fo.profit)', 'SUM(fo.sales)')} AS profit_margin_pct
        FROM fact fo JOIN dim_customer c ON fo.customer_key = c.customer_key
        JOIN dim_geography g ON fo.geography_key = g.geography_key
        GROUP BY 1, c.segment, g.region ORDER BY total_profit ASC""",
    # wide views
    "vds_main": V1,
    "vds_discount": f"""SELECT p.category, p.sub_category, CAST(fo.discount AS DOUBLE) AS discount,
        CAST(fo.sales AS DOUBLE) AS sales, CAST(fo.profit AS DOUBLE) AS profit, fo.quantity, c.segment, g.region,
        {TIER_ASCII.replace('discount', 'fo.discount')} AS discount_tier {V2_FROM}""",
    "vds_recommendations": V3,
    # charts
    "chart_revenue_kpi": f"SELECT {_ms('total_revenue')} FROM fact fo",
    "chart_profit_kpi": f"SELECT {_ms('total_profit')} FROM fact fo",
    "chart_annual_trend": f"""SELECT CAST(date_trunc('year', dd.full_date) AS DATE) AS order_date,
        {_ms('total_revenue', 'total_profit')} FROM fact fo JOIN dim_date_full dd ON fo.order_date_key = dd.date_key
        GROUP BY 1""",
    "chart_revenue_by_region": f"""SELECT dg.region, {_ms('total_revenue')} FROM fact fo
        JOIN dim_geography dg ON fo.geography_key = dg.geography_key GROUP BY dg.region""",
    "chart_category": f"""SELECT dp.category, {_ms('total_revenue', 'total_profit')} FROM fact fo
        JOIN dim_product dp ON fo.product_key = dp.product_key GROUP BY dp.category""",
    "chart_top_customers": f"""SELECT dc.customer_name, {_ms('total_profit')} FROM fact fo
        JOIN dim_customer dc ON fo.customer_key = dc.customer_key GROUP BY dc.customer_name
        ORDER BY total_profit DESC NULLS FIRST, dc.customer_name LIMIT 10""",
    "chart_segment_quarter": f"""SELECT CAST(date_trunc('quarter', dd.full_date) AS DATE) AS order_date, dc.segment,
        {_ms('total_revenue')} FROM fact fo JOIN dim_date_full dd ON fo.order_date_key = dd.date_key
        JOIN dim_customer dc ON fo.customer_key = dc.customer_key GROUP BY 1, 2""",
    "chart_ship_mode": f"""SELECT ds.ship_mode, {_ms('order_count', 'total_revenue', 'total_profit', 'avg_order_value')}
        FROM fact fo JOIN dim_ship_mode ds ON fo.ship_mode_key = ds.ship_mode_key GROUP BY ds.ship_mode""",
    "chart_discount_bubble": f"""SELECT p.sub_category, p.category, {RATIO('SUM(fo.discount)', 'COUNT(fo.discount)')}
        AS avg_discount, CAST(SUM(fo.profit) AS DOUBLE) AS sum_profit, CAST(SUM(fo.sales) AS DOUBLE) AS sum_sales
        FROM fact fo JOIN dim_product p ON fo.product_key = p.product_key GROUP BY 1, 2""",
    "chart_tier_segment": f"""SELECT {TIER_ASCII.replace('discount', 'fo.discount')} AS discount_tier, c.segment,
        CAST(SUM(fo.profit) AS DOUBLE) AS total_profit FROM fact fo
        JOIN dim_customer c ON fo.customer_key = c.customer_key GROUP BY 1, 2""",
    "chart_states_region": f"""SELECT dg.state, dg.region, {_ms('total_revenue', 'total_profit', 'order_count')}
        FROM fact fo JOIN dim_geography dg ON fo.geography_key = dg.geography_key GROUP BY dg.state, dg.region
        ORDER BY total_revenue ASC NULLS LAST, dg.state, dg.region LIMIT 50""",
    "chart_subcategory_profit": """SELECT p.sub_category, CAST(SUM(fo.profit) AS DOUBLE) AS profit FROM fact fo
        JOIN dim_product p ON fo.product_key = p.product_key GROUP BY 1""",
    "chart_heavy_damage": f"""SELECT g.region, CAST(SUM(fo.profit) AS DOUBLE) AS total_profit FROM fact fo
        JOIN dim_geography g ON fo.geography_key = g.geography_key
        WHERE {TIER_ASCII.replace('discount', 'fo.discount')} = 'Heavy (>20%)' GROUP BY 1""",
    "chart_profit_by_state": f"""SELECT dg.state, {_ms('total_profit', 'total_revenue', 'order_count')} FROM fact fo
        JOIN dim_geography dg ON fo.geography_key = dg.geography_key GROUP BY dg.state""",
    "chart_subcategory": f"""SELECT dp.sub_category, {_ms('total_revenue', 'total_profit')} FROM fact fo
        JOIN dim_product dp ON fo.product_key = dp.product_key GROUP BY dp.sub_category""",
    "chart_recommendations": V3,
    # reports
    "top_products_report": f"SELECT {REPORT_COLS} FROM ranking WHERE revenue_rank <= 10",
    "discount_destruction": f"""SELECT * EXCLUDE (d, m) FROM (SELECT category, sub_category,
        {RND(AVG('discount') + ' * 100', 2)} AS avg_discount_pct, {MONEY('SUM(sales)')} AS total_revenue,
        {MONEY('SUM(profit)')} AS total_profit, {MARGIN} AS profit_margin_pct,
        CAST(RANK() OVER (ORDER BY SUM(sales) DESC NULLS LAST, category, sub_category) AS BIGINT) AS revenue_rank,
        {AVG('discount')} AS d, {RATIO('SUM(profit)', 'SUM(sales)')} AS m
        FROM flat GROUP BY category, sub_category) WHERE d > 0.2 AND m < 0""",
    "clearance_signature": f"""SELECT revenue_rank, product_id, product_name, category, sub_category,
        {MONEY('revenue')} AS total_revenue, units_sold, {MONEY('profit')} AS total_profit,
        {PCT('profit', 'revenue', 1)} AS profit_margin_pct, {RND('avg_price', 2)} AS avg_price
        FROM (SELECT *, {RATIO('revenue', 'units_sold')} AS avg_price FROM ranking)
        WHERE revenue_rank <= ceil(CAST((SELECT COUNT(*) FROM prod_tot) AS DOUBLE) * 0.1)
          AND profit < 0
          AND CAST(units_sold AS DOUBLE) < (SELECT AVG(CAST(units_sold AS DOUBLE)) FROM prod_tot)
          AND avg_price > (SELECT AVG({RATIO('revenue', 'units_sold')}) FROM prod_tot)""",
    "break_even_products": f"""SELECT product_id, product_name, category, sub_category,
        {MONEY('revenue')} AS total_revenue, units_sold, {MONEY('profit')} AS total_profit,
        {PCT('profit', 'revenue', 2)} AS profit_margin_pct FROM prod_tot
        WHERE revenue > 0 AND abs(CAST(profit AS DOUBLE)) <= 0.005 * CAST(revenue AS DOUBLE)""",
    "loss_making_top_n": f"SELECT {REPORT_COLS} FROM ranking WHERE revenue_rank <= 10 AND profit < 0",
    "top_n_mix": f"""SELECT category, sub_category, COUNT(*) AS product_count, {MONEY('SUM(revenue)')} AS total_revenue,
        {MONEY('SUM(profit)')} AS total_profit, {PCT('SUM(profit)', 'SUM(revenue)')} AS profit_margin_pct
        FROM ranking WHERE revenue_rank <= 10 GROUP BY category, sub_category""",
    # recommendation load
    "report_blocks": f"""SELECT product_id, product_name, concat_ws(' > ', category, sub_category) AS category_raw,
        CASE WHEN revenue_rank % 2 = 1 THEN '- Brand: ' || sub_category || {NL} || '- Type: ' || category
             ELSE '' END AS web_intel FROM ranking""",
    "report_category_levels": "SELECT product_id, NULLIF(category, '') AS category, sub_category FROM ranking",
    "report_missing_notes": """SELECT product_id, product_name,
        product_name || ' office product specifications features review' AS search_phrase
        FROM ranking WHERE revenue_rank % 2 = 0""",
    "recs_known_pairs": """SELECT source_product_id, recommended_product_id, recommendation_type,
        CAST(recommendation_score AS DOUBLE) AS recommendation_score, recommendation_reason FROM known""",
    "recs_missing_products": """SELECT DISTINCT product_id FROM (SELECT source_product_id AS product_id FROM pairs
        UNION ALL SELECT recommended_product_id FROM pairs) WHERE product_id NOT IN (SELECT product_id FROM dim_product)""",
    "recs_resolve_keys": """SELECT product_key, recommended_product_key, CAST(date_key AS INTEGER) AS date_key,
        recommendation_type, CAST(recommendation_score AS DOUBLE) AS recommendation_score, recommendation_reason
        FROM resolved""",
    "recs_load": """SELECT recommendation_key, product_key, recommended_product_key, CAST(date_key AS INTEGER) AS date_key,
        recommendation_type, CAST(recommendation_score AS DOUBLE) AS recommendation_score, recommendation_reason
        FROM recs""",
    "recs_by_type": "SELECT recommendation_type, COUNT(*) AS n FROM recs GROUP BY 1 ORDER BY 1",
    # conventions
    "date_filter": f"""SELECT d.month, {MONEY('SUM(fo.sales)')} AS total_revenue,
        COUNT(DISTINCT fo.order_id) AS order_count FROM fact fo JOIN dim_date_full d ON fo.order_date_key = d.date_key
        WHERE d.year = 1996 GROUP BY d.month ORDER BY d.month""",
    "rank_of_order_lines": """SELECT order_line_key, ship_mode_key, CAST(sales AS DOUBLE) AS sales,
        rank() OVER (PARTITION BY ship_mode_key ORDER BY sales DESC) AS rank,
        dense_rank() OVER (PARTITION BY ship_mode_key ORDER BY sales DESC) AS dense_rank FROM fact""",
    "previous_order_line": """SELECT order_line_key, CAST(sales AS DOUBLE) AS sales,
        CAST(lag(sales) OVER (ORDER BY order_line_key) AS DOUBLE) AS previous_sales FROM fact""",
    "rank_within": f"""SELECT category, sub_category, total_revenue,
        CAST(RANK() OVER w AS BIGINT) AS "rank", CAST(DENSE_RANK() OVER w AS BIGINT) AS "dense_rank",
        CAST(ROW_NUMBER() OVER w AS BIGINT) AS "row_number"
        FROM (SELECT p.category, p.sub_category, {MONEY('SUM(fo.sales)')} AS total_revenue FROM fact fo
              JOIN dim_product p ON fo.product_key = p.product_key GROUP BY 1, 2)
        WINDOW w AS (PARTITION BY category ORDER BY total_revenue DESC, sub_category)""",
    "period_over_period": f"""SELECT segment, year, quarter, {MONEY('revenue')} AS total_revenue,
        {PCT('revenue - LAG(revenue) OVER w', 'LAG(revenue) OVER w')} AS revenue_qoq_pct_change
        FROM (SELECT c.segment, d.year, d.quarter, SUM(fo.sales) AS revenue FROM fact fo
              JOIN dim_date_full d ON fo.order_date_key = d.date_key
              JOIN dim_customer c ON fo.customer_key = c.customer_key GROUP BY 1, 2, 3)
        WINDOW w AS (PARTITION BY segment ORDER BY year, quarter)""",
    "top_n_default": f"""SELECT product_id, product_name, {MONEY('revenue')} AS total_revenue FROM prod_tot
        ORDER BY revenue DESC, product_id LIMIT 20""",
    "default_order": f"""SELECT g.state, {MONEY('SUM(fo.sales)')} AS total_revenue,
        {MONEY('SUM(fo.profit)')} AS total_profit FROM fact fo
        JOIN dim_geography g ON fo.geography_key = g.geography_key GROUP BY g.state
        ORDER BY total_revenue DESC NULLS FIRST, g.state""",
}
for _name, _key in METRIC_KEYS.items():
    BODIES[_key] = f"SELECT {_ms(_name)} FROM fact fo"


# DATE / TIMESTAMP output columns, published as ISO text on both sides
TEXT_DATES = {
    "assign_surrogate_keys": ["l_shipdate"],
    "clean_parse_dates": ["order_date", "ship_date"],
    "clean_drop_null_keys": ["order_date", "ship_date"],
    "dim_date_build": ["full_date"],
    "dim_date_ensure": ["full_date"],
    "vds_main": ["order_date"],
    "vds_recommendations": ["recommendation_date"],
    "chart_recommendations": ["recommendation_date"],
    "chart_annual_trend": ["order_date"],
    "metric_daily_revenue": ["order_date"],
    "chart_segment_quarter": ["order_date"],
}


def _text_dates(key: str, body: str) -> str:
    cols = TEXT_DATES.get(key)
    if not cols:
        return body
    casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({casts}) FROM ({body})"


def oracle_sql() -> dict[str, str]:
    return {k: with_prefix(_text_dates(k, v)) for k, v in BODIES.items()}
