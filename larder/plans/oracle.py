"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL restates the *source* semantics — group-bys over all seven
or twelve attribute columns, the seven-key NULL-never-matches inventory
join, the cross-join grid, the 12-column pair group-by with a distinct
count, the max snapshot as a subquery — so agreement with the Spark plans
(which regroup by ids, add the demand to a grid of zeros, prune pairs first)
checks those rewrites.  One formula is not literal: the mean of the 30-order
average divides a sum of whole numbers once (``_mean_of_shares``).  It reads the raw test tables (``part``, ``orders``,
``lineitem``) and rebuilds the fixture mapping too.

Engine differences handled here: lenient int casts are guarded by a regex
(DuckDB would accept '12.5' and '1e2'); ``round`` goes through the
decimal form of the shortest repr (Spark rounds half-up on that form);
sums are cast to BIGINT; NULL ordering is stated.
"""

from __future__ import annotations

import re

from larder import constants as C
from larder.operators.silver import REJECTED_LINE
from larder.sources.landing import RAW_KEYS, RAW_SCHEMAS

LANDING_DATE, RELANDING_DATE = "2024-01-01", "2024-01-02"


def _lenient(x: str, kind: str = "INTEGER") -> str:
    return f"CASE WHEN regexp_full_match({x}, '\\s*[+-]?[0-9]+\\s*') THEN TRY_CAST(trim({x}) AS {kind}) END"


def _order_id(x: str) -> str:
    return f"CASE WHEN {x} % {C.FIXTURE_LARGE_ID_MOD} = 0 THEN {x} + {C.FIXTURE_LARGE_ID_ADD} ELSE {x} END"


def _round(x: str, k: int) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {k}) AS DOUBLE)"


def _mean_of_shares(x: str, n: int) -> str:
    """``avg(x / n)`` for whole numbers, divided once so that the result does
    not depend on the order in which an engine adds fractions."""
    return f"CAST(sum({x}) AS BIGINT) / (count({x}) * {n})"


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _keyword_rows() -> str:
    rows = []
    for task, (keywords, labels) in {
        "ai_product_theme": (C.THEME_KEYWORDS, C.PRODUCT_THEMES),
        "ai_demand_type": (C.DEMAND_KEYWORDS, C.DEMAND_TYPES),
    }.items():
        for label, words in keywords.items():
            for kw in dict.fromkeys(words.split()):
                rows.append(f"('{task}', '{label}', {labels.index(label)}, '{kw}')")
    return ",\n        ".join(rows)


def _theme_rule(col: str) -> str:
    whens = " ".join(f"WHEN contains(lower({col}), '{needle}') THEN '{label}'" for needle, label in C.THEME_RULES)
    return f"CASE {whens} ELSE '{C.THEME_DEFAULT}' END"


def _demand_rule(col: str) -> str:
    whens = " ".join(
        f"WHEN regexp_matches(lower({col}), '{pattern}') THEN '{label}'" for pattern, label in C.DEMAND_RULES
    )
    return f"CASE {whens} ELSE '{C.DEMAND_DEFAULT}' END"


M = f"greatest({C.FIXTURE_PRODUCT_MODULUS}, (SELECT count(*) FROM part) // {C.FIXTURE_PARTS_PER_MODULUS})"


def _product(key: str) -> str:
    k = f"({key} % {M})"
    return f"({k} * {k} * {k}) // ({M} * {M})"


_MALFORMED = f"CAST(product_id AS BIGINT) % {C.QUERY_MALFORMED_MOD}"

ATTRS = "product_name, aisle, department, ai_product_theme, ai_demand_type"

CTES: dict[str, str] = {
    # ---------------------------------------------------------------- fixture
    "fx_orders": f"""
        SELECT {_order_id('o_orderkey')} AS order_id, o_custkey AS user_id,
               CASE WHEN lead(o_orderkey) OVER w IS NULL THEN 'train' ELSE 'prior' END AS eval_set,
               CAST(row_number() OVER w AS INTEGER) AS order_number,
               o_orderkey % 7 AS order_dow, o_orderkey % 24 AS order_hour_of_day,
               CAST(date_diff('day', lag(o_orderdate) OVER w, o_orderdate) AS DOUBLE) AS days_since_prior_order
        FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    "fx_lines0": f"""
        SELECT {_order_id('l_orderkey')} AS order_id,
               {_product('l_partkey')} AS product_id,
               CAST(row_number() OVER (PARTITION BY l_orderkey
                    ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS INTEGER)
                 AS add_to_cart_order
        FROM lineitem""",
    "fx_lines": """
        SELECT l.order_id, l.product_id, l.add_to_cart_order,
               CAST(CASE WHEN o.order_number > min(o.order_number) OVER (PARTITION BY o.user_id, l.product_id)
                    THEN 1 ELSE 0 END AS INTEGER) AS reordered,
               o.eval_set
        FROM fx_lines0 l JOIN fx_orders o USING (order_id)""",
    "fx_op_prior": "SELECT order_id, product_id, add_to_cart_order, reordered FROM fx_lines WHERE eval_set = 'prior'",
    "fx_op_train": "SELECT order_id, product_id, add_to_cart_order, reordered FROM fx_lines WHERE eval_set = 'train'",
    "fx_pid": f"SELECT DISTINCT {_product('p_partkey')} AS pid FROM part",
    "fx_products": f"""
        SELECT CAST(pid AS VARCHAR) AS product_id,
               {_list(C.FIXTURE_PRODUCT_NAMES)}[pid % {len(C.FIXTURE_PRODUCT_NAMES)} + 1] || ' ' || CAST(pid AS VARCHAR)
                 AS product_name,
               CASE WHEN pid % {C.FIXTURE_BAD_AISLE_MOD} = {C.FIXTURE_BAD_AISLE_REM} THEN '{C.FIXTURE_BAD_AISLE}'
                    ELSE CAST(pid % {C.FIXTURE_AISLE_COUNT} + 1 AS VARCHAR) END AS aisle_id,
               CAST(pid % {len(C.FIXTURE_DEPARTMENTS)} + 1 AS VARCHAR) AS department_id
        FROM fx_pid""",
    "fx_aisles": f"""
        SELECT aisle_id, 'Aisle ' || aisle_id AS aisle
        FROM (SELECT DISTINCT CAST(pid % {C.FIXTURE_AISLE_COUNT} + 1 AS VARCHAR) AS aisle_id FROM fx_pid)""",
    "fx_departments": f"""
        SELECT CAST(d AS VARCHAR) AS department_id, ' ' || upper({_list(C.FIXTURE_DEPARTMENTS)}[d]) AS department
        FROM (SELECT DISTINCT pid % {len(C.FIXTURE_DEPARTMENTS)} + 1 AS d FROM fx_pid)""",
    # ----------------------------------------------------------------- silver
    "dim_aisle": f"""
        SELECT aisle_id, aisle FROM (
          SELECT {_lenient('aisle_id')} AS aisle_id, trim(lower(aisle)) AS aisle,
                 row_number() OVER (PARTITION BY {_lenient('aisle_id')} ORDER BY trim(lower(aisle)) NULLS LAST) AS rn
          FROM fx_aisles) WHERE aisle_id IS NOT NULL AND rn = 1""",
    "dim_department": f"""
        SELECT department_id, department FROM (
          SELECT {_lenient('department_id')} AS department_id, trim(lower(department)) AS department,
                 row_number() OVER (PARTITION BY {_lenient('department_id')}
                                    ORDER BY trim(lower(department)) NULLS LAST) AS rn
          FROM fx_departments) WHERE department_id IS NOT NULL AND rn = 1""",
    "products_clean": f"""
        SELECT {_lenient('product_id', 'BIGINT')} AS product_id, trim(product_name) AS product_name,
               {_lenient('aisle_id')} AS aisle_id, {_lenient('department_id')} AS department_id,
               product_id AS raw_product_id, aisle_id AS raw_aisle_id, department_id AS raw_department_id
        FROM fx_products""",
    "quarantine": f"""
        SELECT *, '{C.QUARANTINE_REASON}' AS quarantine_reason FROM products_clean
        WHERE product_id IS NULL OR aisle_id IS NULL OR department_id IS NULL""",
    "valid_products": """
        SELECT * FROM products_clean
        WHERE product_id IS NOT NULL AND aisle_id IS NOT NULL AND department_id IS NOT NULL""",
    "product_lookup": """
        SELECT p.product_id, p.product_name, p.aisle_id, a.aisle, p.department_id, d.department
        FROM valid_products p
        LEFT JOIN dim_aisle a ON p.aisle_id = a.aisle_id
        LEFT JOIN dim_department d ON p.department_id = d.department_id""",
    "dim_product": """
        SELECT product_id, product_name, aisle_id, aisle, department_id, department, TRUE AS is_current FROM (
          SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_name NULLS LAST,
                 aisle_id NULLS LAST, department_id NULLS LAST, aisle NULLS LAST, department NULLS LAST) AS rn
          FROM product_lookup) WHERE rn = 1""",
    "ruled": f"""
        SELECT *, {_theme_rule('department')} AS fallback_product_theme,
               {_demand_rule('product_name')} AS fallback_demand_type
        FROM dim_product""",
    "sample": f"""
        SELECT product_id, product_name, aisle, department FROM dim_product
        WHERE product_name IS NOT NULL ORDER BY product_id LIMIT {C.QUERY_SAMPLE_SIZE}""",
    "kw": f"""
        SELECT * FROM (VALUES
        {_keyword_rows()}) AS t(task, label, pos, keyword)""",
    "tok": """
        SELECT product_id, t AS token
        FROM (SELECT product_id, unnest(regexp_split_to_array(lower(product_name), '[^a-z]+')) AS t FROM sample)
        WHERE length(t) > 2""",
    "tf": "SELECT product_id, token, count(*) AS tf FROM tok GROUP BY product_id, token",
    "idf": """
        SELECT token, ln((1 + (SELECT count(*) FROM sample)) / (1 + count(*))) + 1 AS idf
        FROM tf GROUP BY token""",
    "doc_norm": """
        SELECT product_id, sqrt(sum(pow(tf * idf, 2))) AS doc_norm
        FROM tf JOIN idf USING (token) GROUP BY product_id""",
    "kw_idf": """
        SELECT k.task, k.label, k.pos, k.keyword, coalesce(i.idf, 1.0) AS kw_idf
        FROM kw k LEFT JOIN idf i ON k.keyword = i.token""",
    "label_norm": "SELECT task, label, sqrt(sum(kw_idf * kw_idf)) AS label_norm FROM kw_idf GROUP BY task, label",
    "scores": f"""
        SELECT t.product_id, k.task, k.label, k.pos,
               {_round('sum(t.tf * k.kw_idf * k.kw_idf) / (any_value(n.doc_norm) * any_value(l.label_norm))',
                       C.LABEL_SCORE_DIGITS)} AS score
        FROM tf t JOIN kw_idf k ON t.token = k.keyword
        JOIN doc_norm n ON t.product_id = n.product_id
        JOIN label_norm l ON k.task = l.task AND k.label = l.label
        GROUP BY t.product_id, k.task, k.label, k.pos""",
    "best": """
        SELECT product_id, task, label FROM (
          SELECT *, row_number() OVER (PARTITION BY product_id, task ORDER BY score DESC, pos) AS rn FROM scores)
        WHERE rn = 1""",
    "model_labels": f"""
        SELECT s.product_id,
               coalesce(max(CASE WHEN b.task = 'ai_product_theme' THEN b.label END), 'other') AS ai_product_theme,
               coalesce(max(CASE WHEN b.task = 'ai_demand_type' THEN b.label END), 'other') AS ai_demand_type,
               '{C.METHOD_MODEL}' AS classification_method
        FROM sample s LEFT JOIN best b ON s.product_id = b.product_id
        GROUP BY s.product_id""",
    # fitted label model: counts of the rule-labelled names
    "nb_named": f"""
        SELECT product_id, product_name, 'ai_product_theme' AS task, fallback_product_theme AS label,
               list_position({_list([*dict.fromkeys([*C.PRODUCT_THEMES, C.THEME_DEFAULT])])}, fallback_product_theme) AS pos
        FROM ruled WHERE product_name IS NOT NULL
        UNION ALL
        SELECT product_id, product_name, 'ai_demand_type', fallback_demand_type,
               list_position({_list([*dict.fromkeys([*C.DEMAND_TYPES, C.DEMAND_DEFAULT])])}, fallback_demand_type)
        FROM ruled WHERE product_name IS NOT NULL""",
    "nb_tok": """
        SELECT product_id, t AS token, count(*) AS n
        FROM (SELECT product_id, unnest(regexp_split_to_array(lower(product_name), '[^a-z]+')) AS t FROM dim_product)
        WHERE length(t) > 2 GROUP BY product_id, t""",
    "nb_words": """
        SELECT task, label, token, sum(n) AS n FROM nb_named JOIN nb_tok USING (product_id) WHERE pos IS NOT NULL
        GROUP BY task, label, token""",
    "nb_labels": """
        SELECT task, label, pos, count(*) AS texts, sum(count(*)) OVER (PARTITION BY task) AS all_texts
        FROM nb_named WHERE pos IS NOT NULL GROUP BY task, label, pos""",
    "nb_sizes": """
        SELECT l.task, l.label, coalesce(w.held, 0) + v.words AS size
        FROM nb_labels l JOIN (SELECT task, count(DISTINCT token) AS words FROM nb_words GROUP BY task) v ON l.task = v.task
        LEFT JOIN (SELECT task, label, sum(n) AS held FROM nb_words GROUP BY task, label) w
          ON l.task = w.task AND l.label = w.label""",
    "nb_known": """
        SELECT t.product_id, v.task, t.token, t.n FROM nb_tok t JOIN (SELECT DISTINCT task, token FROM nb_words) v USING (token)""",
    "nb_scores": f"""
        SELECT d.product_id, l.task, l.label, l.pos,
               {_round("any_value(ln(l.texts / l.all_texts)) + coalesce(sum(k.n * ln((coalesce(w.n, 0) + 1) / z.size)), 0)",
                       C.LABEL_SCORE_DIGITS)} AS score
        FROM dim_product d CROSS JOIN nb_labels l JOIN nb_sizes z ON l.task = z.task AND l.label = z.label
        LEFT JOIN nb_known k ON d.product_id = k.product_id AND k.task = l.task
        LEFT JOIN nb_words w ON w.task = l.task AND w.label = l.label AND w.token = k.token
        WHERE d.product_name IS NOT NULL
        GROUP BY d.product_id, l.task, l.label, l.pos""",
    "nb_best": """
        SELECT product_id, task, label FROM (
          SELECT *, row_number() OVER (PARTITION BY product_id, task ORDER BY score DESC, pos) AS rn FROM nb_scores)
        WHERE rn = 1""",
    "dim_product_ai": f"""
        SELECT p.product_id, p.product_name, p.aisle_id, p.aisle, p.department_id, p.department,
               coalesce(m.ai_product_theme, p.fallback_product_theme) AS ai_product_theme,
               coalesce(m.ai_demand_type, p.fallback_demand_type) AS ai_demand_type,
               coalesce(m.classification_method, '{C.METHOD_RULES}') AS classification_method,
               p.is_current
        FROM ruled p LEFT JOIN model_labels m ON p.product_id = m.product_id""",
    "op_all": """
        SELECT *, 'prior' AS eval_set_source FROM fx_op_prior
        UNION ALL BY NAME
        SELECT *, 'train' AS eval_set_source FROM fx_op_train""",
    "joined_orders": """
        SELECT op.order_id, op.product_id, op.add_to_cart_order, op.reordered, op.eval_set_source,
               o.user_id, o.eval_set, o.order_number, o.order_dow, o.order_hour_of_day, o.days_since_prior_order
        FROM op_all op JOIN fx_orders o ON op.order_id = o.order_id""",
    "typed_lines": """
        SELECT TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(user_id AS BIGINT) AS user_id,
               TRY_CAST(product_id AS BIGINT) AS product_id,
               TRY_CAST(add_to_cart_order AS INTEGER) AS add_to_cart_order,
               TRY_CAST(reordered AS INTEGER) AS reordered, eval_set, eval_set_source,
               TRY_CAST(order_number AS INTEGER) AS order_number, TRY_CAST(order_dow AS INTEGER) AS order_dow,
               TRY_CAST(order_hour_of_day AS INTEGER) AS order_hour_of_day,
               TRY_CAST(days_since_prior_order AS DOUBLE) AS days_since_prior_order
        FROM joined_orders""",
    "deduped": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY
                 eval_set_source NULLS LAST, add_to_cart_order NULLS LAST, reordered NULLS LAST,
                 user_id NULLS LAST, order_number NULLS LAST, eval_set NULLS LAST, order_dow NULLS LAST,
                 order_hour_of_day NULLS LAST, days_since_prior_order NULLS LAST) AS rn
          FROM typed_lines) WHERE rn = 1""",
    "raw_text_lines": f"""
        SELECT CASE WHEN order_id % {C.FIXTURE_BAD_LINE_MOD} = 1 THEN 'order ' || CAST(order_id AS VARCHAR)
                    ELSE CAST(order_id AS VARCHAR) END AS order_id,
               CASE WHEN order_id % {C.FIXTURE_BAD_LINE_MOD} = 2 THEN CAST(product_id AS VARCHAR) || '.5'
                    WHEN order_id % {C.FIXTURE_BAD_LINE_MOD} = 3 THEN NULL
                    ELSE CAST(product_id AS VARCHAR) END AS product_id,
               add_to_cart_order, reordered, eval_set_source FROM op_all""",
    "typed_text_lines": f"""
        SELECT {_lenient('order_id', 'BIGINT')} AS order_key, {_lenient('product_id', 'BIGINT')} AS product_key, *
        FROM raw_text_lines""",
    "fact": """
        SELECT l.order_id, l.user_id, l.product_id, p.product_name, p.aisle_id, p.aisle, p.department_id,
               p.department, p.ai_product_theme, p.ai_demand_type, p.classification_method,
               l.add_to_cart_order, l.reordered, l.eval_set, l.eval_set_source, l.order_number, l.order_dow,
               l.order_hour_of_day, l.days_since_prior_order
        FROM deduped l LEFT JOIN dim_product_ai p ON l.product_id = p.product_id""",
    # ------------------------------------------------------------------- gold
    "demand_base": f"""
        SELECT order_number, product_id, {ATTRS},
               count(*) AS units_sold, CAST(sum(reordered) AS BIGINT) AS reordered_units,
               count(DISTINCT user_id) AS unique_customers, avg(add_to_cart_order) AS avg_cart_position
        FROM fact WHERE product_id IS NOT NULL
        GROUP BY order_number, product_id, {ATTRS}""",
    "demand": f"""
        SELECT order_number, product_id, {ATTRS}, units_sold, reordered_units, unique_customers,
               avg_cart_position,
               CAST(sum(units_sold) OVER w7 AS BIGINT) AS units_sold_7_orders,
               CAST(sum(units_sold) OVER w30 AS BIGINT) AS units_sold_30_orders,
               CAST(sum(units_sold) OVER w30 AS BIGINT) / 30 AS avg_units_per_order_window_30,
               CASE WHEN units_sold > 0 THEN reordered_units / units_sold ELSE 0 END AS reorder_rate
        FROM demand_base
        WINDOW w7 AS (PARTITION BY product_id ORDER BY order_number NULLS FIRST
                      ROWS BETWEEN {C.SHORT_WINDOW} PRECEDING AND CURRENT ROW),
               w30 AS (PARTITION BY product_id ORDER BY order_number NULLS FIRST
                       ROWS BETWEEN {C.LONG_WINDOW} PRECEDING AND CURRENT ROW)""",
    "reorder": f"""
        SELECT product_id, {ATTRS}, count(*) AS total_units_ordered,
               CAST(sum(reordered) AS BIGINT) AS total_reordered_units,
               count(DISTINCT user_id) AS unique_customers, avg(add_to_cart_order) AS avg_cart_position,
               CASE WHEN count(*) > 0 THEN CAST(sum(reordered) AS BIGINT) / count(*) ELSE 0 END AS reorder_rate
        FROM fact WHERE product_id IS NOT NULL
        GROUP BY product_id, {ATTRS}""",
    "inv_demand": f"""
        SELECT order_number, product_id, {ATTRS}, count(*) AS units_sold,
               CAST(sum(reordered) AS BIGINT) AS reordered_units
        FROM fact WHERE product_id IS NOT NULL GROUP BY order_number, product_id, {ATTRS}""",
    "inv_products": f"""
        SELECT product_id, {ATTRS} FROM (
          SELECT product_id, {ATTRS}, row_number() OVER (PARTITION BY product_id) AS rn
          FROM fact WHERE product_id IS NOT NULL) WHERE rn = 1""",
    "inv_numbers": "SELECT DISTINCT order_number FROM fact WHERE order_number IS NOT NULL",
    "inv_base": """
        SELECT n.order_number, p.*, coalesce(d.units_sold, 0) AS units_sold,
               coalesce(d.reordered_units, 0) AS reordered_units
        FROM inv_products p CROSS JOIN inv_numbers n
        LEFT JOIN inv_demand d
          ON d.order_number = n.order_number AND d.product_id = p.product_id
         AND d.product_name = p.product_name AND d.aisle = p.aisle AND d.department = p.department
         AND d.ai_product_theme = p.ai_product_theme AND d.ai_demand_type = p.ai_demand_type""",
    "inventory": f"""
        SELECT order_number AS inventory_snapshot_number, product_id, {ATTRS}, units_sold, reordered_units,
               {C.INITIAL_INVENTORY} AS initial_inventory_qty, restock_qty,
               CAST(sum(units_sold) OVER w AS BIGINT) AS cumulative_units_sold,
               CAST(sum(restock_qty) OVER w AS BIGINT) AS cumulative_restock_qty,
               greatest({C.INITIAL_INVENTORY} + CAST(sum(restock_qty) OVER w AS BIGINT)
                        - CAST(sum(units_sold) OVER w AS BIGINT), 0) AS ending_inventory_qty,
               {C.REORDER_POINT} AS reorder_point
        FROM (SELECT *, CASE WHEN order_number % {C.RESTOCK_EVERY} = 0 THEN {C.RESTOCK_QTY} ELSE 0 END AS restock_qty
              FROM inv_base)
        WINDOW w AS (PARTITION BY product_id ORDER BY order_number
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "latest_inventory": """
        SELECT * FROM inventory
        WHERE inventory_snapshot_number = (SELECT max(inventory_snapshot_number) FROM inventory)""",
    "demand_summary": f"""
        SELECT product_id, max(product_name) AS product_name, max(aisle) AS aisle, max(department) AS department,
               max(ai_product_theme) AS ai_product_theme, max(ai_demand_type) AS ai_demand_type,
               {_mean_of_shares('units_sold_30_orders', C.LONG_WINDOW)} AS avg_units_per_order_window_30,
               avg(reorder_rate) AS avg_reorder_rate
        FROM demand GROUP BY product_id""",
    "stock_joined": """
        SELECT i.inventory_snapshot_number, i.product_id,
               coalesce(d.product_name, i.product_name) AS product_name, coalesce(d.aisle, i.aisle) AS aisle,
               coalesce(d.department, i.department) AS department,
               coalesce(d.ai_product_theme, i.ai_product_theme) AS ai_product_theme,
               coalesce(d.ai_demand_type, i.ai_demand_type) AS ai_demand_type,
               i.ending_inventory_qty, i.reorder_point, d.avg_units_per_order_window_30, d.avg_reorder_rate
        FROM latest_inventory i LEFT JOIN demand_summary d ON i.product_id = d.product_id""",
    "stockout0": """
        SELECT *, CASE WHEN avg_units_per_order_window_30 > 0
                       THEN ending_inventory_qty / avg_units_per_order_window_30 END AS days_of_stock_proxy
        FROM stock_joined""",
    "stockout1": """
        SELECT *, CASE WHEN ending_inventory_qty = 0 AND avg_units_per_order_window_30 > 0 THEN 'STOCKOUT'
                       WHEN days_of_stock_proxy <= 3 THEN 'CRITICAL' WHEN days_of_stock_proxy <= 7 THEN 'HIGH'
                       WHEN days_of_stock_proxy <= 14 THEN 'MEDIUM' ELSE 'OK' END AS stockout_risk_tier
        FROM stockout0""",
    "stockout": """
        SELECT *, CAST(CASE stockout_risk_tier WHEN 'STOCKOUT' THEN 100 WHEN 'CRITICAL' THEN 80 WHEN 'HIGH' THEN 60
                       WHEN 'MEDIUM' THEN 40 ELSE 10 END AS INTEGER) AS priority_score
        FROM stockout1""",
    "overstock0": f"""
        SELECT * EXCLUDE (reorder_point),
               CASE WHEN avg_units_per_order_window_30 > 0
                    THEN ending_inventory_qty / avg_units_per_order_window_30
                    ELSE {C.NO_DEMAND_PROXY} END AS days_of_stock_proxy
        FROM stock_joined""",
    "overstock": """
        SELECT * FROM (
          SELECT *, CASE WHEN days_of_stock_proxy >= 120 THEN 'SEVERE_OVERSTOCK'
                         WHEN days_of_stock_proxy >= 90 THEN 'HIGH_OVERSTOCK'
                         WHEN days_of_stock_proxy >= 60 THEN 'MODERATE_OVERSTOCK' ELSE 'NORMAL' END AS overstock_tier,
                 ending_inventory_qty AS estimated_capital_exposure_units
          FROM overstock0) WHERE overstock_tier <> 'NORMAL'""",
    "basket_base": """
        SELECT order_id, product_id, product_name, department, aisle, ai_product_theme, ai_demand_type FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id, product_id) AS rn
          FROM fact WHERE product_id IS NOT NULL) WHERE rn = 1""",
    "pairs": f"""
        SELECT a.product_id AS product_id_a, a.product_name AS product_name_a, a.department AS department_a,
               a.aisle AS aisle_a, a.ai_product_theme AS ai_product_theme_a, a.ai_demand_type AS ai_demand_type_a,
               b.product_id AS product_id_b, b.product_name AS product_name_b, b.department AS department_b,
               b.aisle AS aisle_b, b.ai_product_theme AS ai_product_theme_b, b.ai_demand_type AS ai_demand_type_b,
               count(DISTINCT a.order_id) AS co_purchase_count
        FROM basket_base a JOIN basket_base b ON a.order_id = b.order_id AND a.product_id < b.product_id
        GROUP BY ALL HAVING count(DISTINCT a.order_id) >= {C.MIN_CO_PURCHASE}""",
}

# classify_labels scores every product with a name: the CTEs above with ``named`` in place of the sample.
NAMED_CTES: dict[str, str] = {
    "named" if name == "sample" else name: re.sub(r"\bsample\b", "named", sql) for name, sql in CTES.items()
} | {
    "named": """
        SELECT product_id, product_name, aisle, department FROM dim_product
        WHERE product_name IS NOT NULL""",
}

_FACT_ALL = "SELECT * FROM fact"

FINAL: dict[str, str] = {
    # sources ---------------------------------------------------------------
    "bronze_products": "SELECT * FROM fx_products",
    "landing_latest_partition": "SELECT * FROM fx_products",
    "landing_merge": f"""
        SELECT product_id, CASE WHEN {_MALFORMED} = {C.QUERY_LONG_REM} THEN '{C.QUERY_RENAMED}' || product_id ELSE product_name END AS product_name,
               aisle_id, department_id,
               CASE WHEN {_MALFORMED} = {C.QUERY_LONG_REM} THEN '{RELANDING_DATE}' ELSE '{LANDING_DATE}' END AS ingestion_date
        FROM fx_products
        UNION ALL SELECT NULL, '{C.QUERY_KEYLESS_NAME}', '1', '1', '{RELANDING_DATE}'""",
    "raw_row_counts": """
        SELECT 'orders' AS entity, count(*) AS row_count FROM fx_orders
        UNION ALL SELECT 'order_products_prior', count(*) FROM fx_op_prior
        UNION ALL SELECT 'order_products_train', count(*) FROM fx_op_train
        UNION ALL SELECT 'products', count(*) FROM fx_products
        UNION ALL SELECT 'aisles', count(*) FROM fx_aisles
        UNION ALL SELECT 'departments', count(*) FROM fx_departments""",
    "landing_report": "",  # filled below from raw_row_counts
    "bronze_counts": "",  # filled below
    # silver ----------------------------------------------------------------
    "products_clean": "SELECT * FROM products_clean",
    "quarantine_products": "SELECT * FROM quarantine",
    "dim_aisle": "SELECT * FROM dim_aisle",
    "dim_department": "SELECT * FROM dim_department",
    "join_left_lookup": "SELECT * FROM product_lookup",
    "dim_product": "SELECT * FROM dim_product",
    "rule_product_theme": "SELECT product_id, department, fallback_product_theme FROM ruled",
    "rule_demand_type": "SELECT product_id, product_name, fallback_demand_type FROM ruled",
    "topk_sample_products": "SELECT * FROM sample",
    "classify_labels": "SELECT * FROM model_labels",
    "classify_labels_fitted": """
        SELECT d.product_id,
               coalesce(max(CASE WHEN b.task = 'ai_product_theme' THEN b.label END), 'other') AS ai_product_theme,
               coalesce(max(CASE WHEN b.task = 'ai_demand_type' THEN b.label END), 'other') AS ai_demand_type
        FROM dim_product d LEFT JOIN nb_best b ON d.product_id = b.product_id GROUP BY d.product_id""",
    "quarantine_csv_rows": f"""
        SELECT 'products' AS entity, '{LANDING_DATE}' AS ingestion_date, 'field_count' AS reason,
               CASE WHEN {_MALFORMED} = {C.QUERY_LONG_REM}
                    THEN concat_ws(',', product_id, product_name, aisle_id, department_id, 'more')
                    ELSE concat_ws(',', product_id, product_name) END AS raw_line
        FROM fx_products WHERE {_MALFORMED} IN ({C.QUERY_LONG_REM}, {C.QUERY_SHORT_REM})
        UNION ALL
        SELECT 'products', '{RELANDING_DATE}', 'header', concat_ws(',', product_id, product_name, aisle_id, department_id)
        FROM fx_products WHERE {_MALFORMED} = {C.QUERY_OTHER_HEADER_REM}
        UNION ALL
        SELECT 'products', '{RELANDING_DATE}', 'header', '{C.QUERY_OTHER_HEADER}'
        WHERE (SELECT count(*) FROM fx_products WHERE {_MALFORMED} = {C.QUERY_OTHER_HEADER_REM}) > 0""",
    "csv_line_accounting": f"""
        SELECT 'products' AS entity, '{LANDING_DATE}' AS ingestion_date, count(*) AS n_lines,
               count(*) FILTER (WHERE {_MALFORMED} NOT IN ({C.QUERY_LONG_REM}, {C.QUERY_SHORT_REM})) AS n_valid,
               count(*) FILTER (WHERE {_MALFORMED} IN ({C.QUERY_LONG_REM}, {C.QUERY_SHORT_REM})) AS n_rejected
        FROM fx_products
        UNION ALL
        SELECT 'products', '{RELANDING_DATE}', count(*) + 1, 0, count(*) + 1
        FROM fx_products WHERE {_MALFORMED} = {C.QUERY_OTHER_HEADER_REM}""",
    "bronze_products_valid": f"""
        SELECT * FROM fx_products WHERE {_MALFORMED} NOT IN ({C.QUERY_LONG_REM}, {C.QUERY_SHORT_REM})""",
    "raw_preview": "",  # filled below
    "safe_overwrite": "SELECT * FROM reorder",
    "classify_overlay": """
        SELECT product_id, ai_product_theme, ai_demand_type, classification_method FROM dim_product_ai""",
    "dim_product_ai": "SELECT * FROM dim_product_ai",
    "count_by_classification_method": """
        SELECT classification_method, count(*) AS "count" FROM dim_product_ai GROUP BY classification_method""",
    "union_prior_train": "SELECT * FROM op_all",
    "join_inner_orders": """
        SELECT order_id, product_id, user_id, order_number, eval_set, eval_set_source FROM joined_orders""",
    "dedup_order_product": """
        SELECT order_id, product_id, user_id, add_to_cart_order, reordered, eval_set_source FROM deduped""",
    "fact_order_products": _FACT_ALL,
    "quarantine_order_lines": f"""
        SELECT order_id AS raw_order_id, product_id AS raw_product_id, add_to_cart_order, reordered, eval_set_source,
               '{REJECTED_LINE}' AS quarantine_reason FROM typed_text_lines
        WHERE order_key IS NULL OR (product_key IS NULL AND product_id IS NOT NULL)""",
    "count_fact_by_classification_method": """
        SELECT classification_method, count(*) AS line_count FROM fact GROUP BY classification_method""",
    "filter_not_null": """
        SELECT order_id, product_id, order_number FROM fact
        WHERE product_id IS NOT NULL AND order_number IS NOT NULL""",
    "agg_count_by_department": "SELECT department, count(*) AS line_count FROM fact GROUP BY department",
    "agg_sum_reordered": """
        SELECT product_id, CAST(sum(reordered) AS BIGINT) AS reordered_units
        FROM fact WHERE product_id IS NOT NULL GROUP BY product_id""",
    "agg_distinct_customers": """
        SELECT product_id, count(DISTINCT user_id) AS unique_customers, count(*) AS units
        FROM fact WHERE product_id IS NOT NULL GROUP BY product_id""",
    "agg_avg_cart_position": """
        SELECT product_id, avg(add_to_cart_order) AS avg_cart_position
        FROM fact WHERE product_id IS NOT NULL GROUP BY product_id""",
    "distinct_order_numbers": "SELECT order_number FROM inv_numbers",
    # gold ------------------------------------------------------------------
    "daily_product_demand": "SELECT * FROM demand",
    "window_sum_7": "SELECT order_number, product_id, units_sold, units_sold_7_orders FROM demand",
    "window_sum_30": """
        SELECT order_number, product_id, units_sold, units_sold_30_orders, avg_units_per_order_window_30
        FROM demand""",
    "reorder_metrics": "SELECT * FROM reorder",
    "reorder_rate": "SELECT product_id, total_units_ordered, total_reordered_units, reorder_rate FROM reorder",
    "fact_inventory_snapshots": "SELECT * FROM inventory",
    "join_cross_grid": "SELECT inventory_snapshot_number, product_id FROM inventory",
    "join_composite_left": """
        SELECT inventory_snapshot_number, product_id, units_sold, reordered_units FROM inventory""",
    "window_cumulative_stock": """
        SELECT inventory_snapshot_number, product_id, cumulative_units_sold, cumulative_restock_qty,
               ending_inventory_qty FROM inventory""",
    "latest_snapshot": "SELECT inventory_snapshot_number, product_id, ending_inventory_qty FROM latest_inventory",
    "latest_demand": "SELECT * FROM demand_summary",
    "join_stock_demand": "SELECT product_id, ending_inventory_qty, avg_units_per_order_window_30 FROM stock_joined",
    "stockout_risk": "SELECT * FROM stockout",
    "overstock_alerts": "SELECT * FROM overstock",
    "project_basket_sides": """
        SELECT order_id, product_id AS product_id_a, product_name AS product_name_a, department AS department_a,
               aisle AS aisle_a, ai_product_theme AS ai_product_theme_a, ai_demand_type AS ai_demand_type_a
        FROM basket_base""",
    "join_self_pairs": "SELECT product_id_a, product_id_b, co_purchase_count FROM pairs",
    "basket_affinity": "SELECT * FROM pairs",
    "write_read_roundtrip": "SELECT * FROM reorder",
    "compact_table": "SELECT * FROM demand",
    "cluster_table": "SELECT * FROM demand",
    # dashboard ---------------------------------------------------------------
    "dash_01_total_records": "SELECT count(*) AS total_order_product_records FROM fact",
    "dash_02_high_risk_count": """
        SELECT count(*) AS high_risk_stockout_products FROM stockout
        WHERE stockout_risk_tier IN ('STOCKOUT', 'CRITICAL', 'HIGH')""",
    "dash_03_overstock_units": """
        SELECT CAST(sum(estimated_capital_exposure_units) AS BIGINT) AS total_overstock_exposure_units
        FROM overstock""",
    "dash_04_departments": """
        SELECT department, CAST(sum(units_sold) AS BIGINT) AS total_units_sold FROM demand
        GROUP BY department""",
    "dash_05_top_reordered": f"""
        SELECT product_name, department, aisle, total_units_ordered, total_reordered_units,
               {_round('reorder_rate', 4)} AS reorder_rate
        FROM reorder WHERE total_units_ordered >= 100
        ORDER BY {_round('reorder_rate', 4)} DESC, product_id LIMIT 25""",
    "dash_06_theme": f"""
        SELECT coalesce(ai_product_theme, 'unclassified') AS ai_product_theme,
               CAST(sum(total_units_ordered) AS BIGINT) AS total_units_ordered,
               CAST(sum(total_reordered_units) AS BIGINT) AS total_reordered_units,
               {_round('CAST(sum(total_reordered_units) AS BIGINT) / CAST(sum(total_units_ordered) AS BIGINT)', 4)}
                 AS reorder_rate
        FROM reorder GROUP BY coalesce(ai_product_theme, 'unclassified')""",
    "dash_07_demand_type": f"""
        SELECT coalesce(ai_demand_type, 'unclassified') AS ai_demand_type,
               CAST(sum(total_units_ordered) AS BIGINT) AS total_units_ordered,
               CAST(sum(total_reordered_units) AS BIGINT) AS total_reordered_units,
               {_round('CAST(sum(total_reordered_units) AS BIGINT) / CAST(sum(total_units_ordered) AS BIGINT)', 4)}
                 AS reorder_rate
        FROM reorder GROUP BY coalesce(ai_demand_type, 'unclassified')""",
    "dash_08_stockout_tiers": f"""
        SELECT stockout_risk_tier, count(*) AS product_count,
               {_round('avg(days_of_stock_proxy)', 2)} AS avg_days_of_stock
        FROM stockout GROUP BY stockout_risk_tier""",
    "dash_09_priority": f"""
        SELECT product_name, department, aisle, ai_product_theme, ai_demand_type, ending_inventory_qty,
               {_round('avg_units_per_order_window_30', 2)} AS avg_units_per_order_window_30,
               {_round('days_of_stock_proxy', 2)} AS days_of_stock_proxy, stockout_risk_tier, priority_score
        FROM stockout WHERE stockout_risk_tier IN ('STOCKOUT', 'CRITICAL', 'HIGH')
        ORDER BY priority_score DESC, {_round('days_of_stock_proxy', 2)} ASC NULLS FIRST, product_id LIMIT 50""",
    "dash_10_overstock_tiers": """
        SELECT overstock_tier, count(*) AS product_count,
               CAST(sum(estimated_capital_exposure_units) AS BIGINT) AS exposure_units
        FROM overstock GROUP BY overstock_tier""",
    "dash_11_top_pairs": """
        SELECT product_name_a, product_name_b, department_a, department_b, ai_product_theme_a,
               ai_product_theme_b, co_purchase_count
        FROM pairs ORDER BY co_purchase_count DESC, product_id_a, product_id_b LIMIT 50""",
}

FINAL["landing_report"] = f"""
    SELECT entity, file_name, CASE WHEN entity = '{C.QUERY_MISSING_ENTITY}' THEN 'skipped' ELSE 'uploaded' END AS status,
           CASE WHEN entity <> '{C.QUERY_MISSING_ENTITY}' THEN row_count END AS row_count FROM (
      SELECT c.entity, f.file_name, c.row_count FROM ({FINAL['raw_row_counts']}) c
      JOIN (VALUES {", ".join(f"('{e}', '{C.RAW_FILE_NAMES[e]}')" for e in C.RAW_ENTITIES)}) AS f(entity, file_name)
        ON c.entity = f.entity)"""
def _preview(entity: str, cte: str) -> str:
    order = ", ".join(f"CAST({k} AS BIGINT)" for k in RAW_KEYS[entity])
    fields = " || '|' || ".join(f"'{c}=' || trim(coalesce(CAST({c} AS VARCHAR), ''))" for c in RAW_SCHEMAS[entity])
    return f"""
    SELECT '{entity}' AS entity, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS place, {fields} AS fields
    FROM {cte} QUALIFY place <= {C.QUERY_PREVIEW_ROWS}"""


FINAL["raw_preview"] = "\nUNION ALL ".join(_preview(e, cte) for e, cte in zip(C.RAW_ENTITIES, (
    "fx_orders", "fx_op_prior", "fx_op_train", "fx_products", "fx_aisles", "fx_departments"), strict=True))
FINAL["landing_totals"] = f"SELECT {len(C.RAW_ENTITIES) - 1} AS uploaded, 1 AS skipped"
FINAL["raw_file_inventory"] = f"""
    SELECT entity, '{LANDING_DATE}' AS ingestion_date, {C.QUERY_LANDING_FILES} AS n_files, row_count
    FROM ({FINAL['raw_row_counts']})"""
FINAL["stream_bronze_counts"] = FINAL["raw_row_counts"]
FINAL["bronze_counts"] = f"""
    SELECT 'bronze_' || entity AS table_name, row_count FROM ({FINAL['raw_row_counts']})"""
_VALIDATION_SOURCES = [
    ("grocery_bronze.bronze_orders", "fx_orders"),
    ("grocery_bronze.bronze_order_products_prior", "fx_op_prior"),
    ("grocery_bronze.bronze_order_products_train", "fx_op_train"),
    ("grocery_bronze.bronze_products", "fx_products"),
    ("grocery_bronze.bronze_aisles", "fx_aisles"),
    ("grocery_bronze.bronze_departments", "fx_departments"),
    ("grocery_silver.dim_product", "dim_product"),
    ("grocery_silver.dim_product_ai", "dim_product_ai"),
    ("grocery_silver.dim_aisle", "dim_aisle"),
    ("grocery_silver.dim_department", "dim_department"),
    ("grocery_silver.fact_order_products", "fact"),
    ("grocery_silver.fact_inventory_snapshots", "inventory"),
    ("grocery_silver.quarantine_malformed_products", "quarantine"),
    ("grocery_gold.daily_product_demand", "demand"),
    ("grocery_gold.reorder_metrics", "reorder"),
    ("grocery_gold.stockout_risk", "stockout"),
    ("grocery_gold.overstock_alerts", "overstock"),
    ("grocery_gold.basket_affinity", "pairs"),
]
FINAL["final_validation"] = "\nUNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) AS row_count, 'OK' AS status FROM {cte}"
    for table, cte in _VALIDATION_SOURCES
) + f"""
UNION ALL SELECT '{C.QUERY_ABSENT_TABLE}', NULL, 'ERROR: missing'
UNION ALL SELECT '{C.QUERY_UNREADABLE_TABLE}', NULL, 'ERROR: unreadable'"""


def _deps(sql: str, ctes: dict[str, str]) -> list[str]:
    return [name for name in ctes if re.search(rf"\b{name}\b", sql)]


def with_ctes(final: str, ctes: dict[str, str] = CTES) -> str:
    """Prefix ``final`` with the CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str, stack: tuple[str, ...] = ()) -> None:
        if name in order:
            return
        for dep in _deps(ctes[name], ctes):
            if dep != name and dep not in stack:
                visit(dep, stack + (name,))
        order.append(name)

    for name in _deps(final, ctes):
        visit(name)
    if not order:
        return final.strip()
    body = ",\n".join(f"{n} AS ({ctes[n].strip()})" for n in order)
    return f"WITH {body}\n{final.strip()}"


def oracle_queries() -> dict[str, str]:
    return {name: with_ctes(sql, NAMED_CTES if name == "classify_labels" else CTES) for name, sql in FINAL.items()}
