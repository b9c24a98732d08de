"""The bindings of ``bindings.py`` written as plain SQL (DuckDB dialect).

``oracle_sql()`` in ``__spark_entry__`` prefixes each check query with the
views it needs, so the oracle reads the same shared tables independently of
the Spark code.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "b_trades": """
SELECT CAST(o.o_orderkey AS VARCHAR) AS trade_id,
       last_day(CAST(o.o_orderdate AS DATE)) AS trade_date,
       CASE WHEN o.o_orderstatus <> 'P' THEN CAST(o.o_custkey AS VARCHAR) END AS counterparty_code,
       CASE o.o_orderstatus WHEN 'F' THEN c.c_name
                            WHEN 'O' THEN translate(c.c_name, '#', ' ')
                            WHEN 'P' THEN upper(c.c_name) || ' LTD' END AS booked_name,
       o.o_orderpriority AS source_system,
       CASE WHEN o.o_orderkey % 4 = 0 THEN 'IM' ELSE 'VM' END AS margin_type,
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS exposure_amount,
       CASE WHEN CAST(o.o_totalprice AS DECIMAL(18,2)) > 100000
            THEN CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) - 100000 AS DECIMAL(18,2)) END AS call_amount,
       CASE o.o_orderstatus WHEN 'F' THEN 'MATCHED_ORIGINAL' WHEN 'O' THEN 'MATCHED_RESOLVED'
                            WHEN 'P' THEN 'UNMATCHED' END AS resolution_status
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "b_counterparty": """
SELECT CAST(c.c_custkey AS VARCHAR) AS counterparty_code, c.c_name AS canonical_name,
       n.n_name AS ultimate_parent, r.r_name AS regulatory_regime,
       CAST(500000 AS DECIMAL(18,2)) AS threshold_amount,
       concat_ws(' ', c.c_name, translate(c.c_name, '#', ' '), c.c_mktsegment) AS entity_search_field
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "b_counterparty_legal": """
SELECT CAST(c_custkey AS VARCHAR) AS counterparty_code, c_name AS counterparty_legal_name,
       CAST(500000 AS DECIMAL(18,2)) AS threshold_principal
FROM customer""",
    "b_date": """
SELECT trade_date, monthname(trade_date) AS month_name, CAST(month(trade_date) AS INTEGER) AS month_number,
       'Q' || CAST(quarter(trade_date) AS VARCHAR) || '-' || CAST(year(trade_date) AS VARCHAR) AS quarter_name,
       CAST(year(trade_date) AS INTEGER) AS year_number
FROM (SELECT last_day(CAST(m AS DATE)) AS trade_date
      FROM generate_series(DATE '1994-08-01', DATE '2001-03-01', INTERVAL 1 MONTH) g(m))""",
    "b_variants": """
SELECT CAST(c_custkey AS VARCHAR) || '-C' AS variant_id, CAST(c_custkey AS VARCHAR) AS counterparty_code,
       c_name AS variant_name, 'S1' AS source_system, 'Canonical' AS variant_type, TRUE AS is_canonical,
       c_name AS canonical_name, 'NONE' AS risk_impact FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR) || '-S', CAST(c_custkey AS VARCHAR), translate(c_name, '#', ' '),
       'S2', 'Punctuation', FALSE, c_name, 'HIGH' FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR) || '-U', CAST(c_custkey AS VARCHAR), upper(c_name),
       'S3', 'Uppercase', FALSE, c_name, 'MEDIUM' FROM customer""",
    "b_margin": """
SELECT event_id, agreement_id, counterparty_code, as_of_date, status,
       price AS base_total_exposure, CAST(price * 2 AS DECIMAL(18,2)) AS itm_exposure,
       CAST(-price AS DECIMAL(18,2)) AS otm_exposure, call AS base_call_amount, agreed AS agreed_amount,
       CAST(200000 AS DECIMAL(18,2)) AS threshold_principal,
       CASE WHEN call <> agreed THEN CAST(call - agreed AS DECIMAL(18,2)) END AS dispute_amount,
       COALESCE(call <> agreed, FALSE) AS is_disputed
FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN CAST(call - 1000 AS DECIMAL(18,2)) ELSE call END AS agreed
      FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS event_id,
                   'AGR-' || CAST(o_custkey AS VARCHAR) AS agreement_id,
                   CAST(o_custkey AS VARCHAR) AS counterparty_code,
                   CAST(o_orderdate AS DATE) AS as_of_date, o_orderstatus AS status,
                   CAST(o_totalprice AS DECIMAL(18,2)) AS price,
                   CASE WHEN CAST(o_totalprice AS DECIMAL(18,2)) > 200000
                        THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 200000 AS DECIMAL(18,2)) END AS call
            FROM orders))""",
    "b_known": """
SELECT CAST(o_custkey AS VARCHAR) AS counterparty_code,
       make_date(year(CAST(o_orderdate AS DATE)), 12, 31) AS as_of_date,
       CAST(o_totalprice AS DECIMAL(18,2)) AS base_total_exposure
FROM orders WHERE o_orderstatus <> 'P'""",
    "b_hidden": """
SELECT CAST(o_orderkey AS VARCHAR) AS anomaly_id,
       CAST(o_custkey AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN '-S' ELSE '-U' END AS variant_id,
       CAST(o_custkey AS VARCHAR) AS counterparty_code,
       make_date(year(CAST(o_orderdate AS DATE)), 12, 31) AS as_of_date,
       CAST(o_totalprice AS DECIMAL(18,2)) AS base_total_exposure,
       o_orderpriority AS source_system
FROM orders WHERE o_orderstatus = 'P'""",
    "b_legal": """
SELECT 'LEI-C' || CAST(c.c_custkey AS VARCHAR) AS lei_code, 'LEI-N' || CAST(n.n_nationkey AS VARCHAR) AS ultimate_parent_lei,
       n.n_name AS ultimate_parent_name, c.c_name AS legal_entity_name,
       CAST(c.c_custkey AS VARCHAR) AS counterparty_code, 'Bank' AS entity_type, FALSE AS is_ultimate_parent
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
UNION ALL
SELECT 'LEI-N' || CAST(n.n_nationkey AS VARCHAR), 'LEI-N' || CAST(n.n_nationkey AS VARCHAR), n.n_name, n.n_name,
       CAST(c.c_custkey AS VARCHAR), 'Holding Company', TRUE
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "b_legal_listed": """
SELECT * FROM b_legal
UNION ALL SELECT * FROM b_legal WHERE CAST(counterparty_code AS BIGINT) % 3 = 0
UNION ALL SELECT 'LEI-X' || counterparty_code, ultimate_parent_lei, 'BRANCH HOLDING', legal_entity_name || ' BRANCH',
                 counterparty_code, entity_type, is_ultimate_parent
FROM b_legal WHERE NOT is_ultimate_parent AND CAST(counterparty_code AS BIGINT) % 5 = 0""",
    "b_own": """
SELECT counterparty_code, arg_min(ultimate_parent_name, lei_code) AS ultimate_parent_name,
       arg_min(legal_entity_name, lei_code) AS legal_entity_name
FROM b_legal_listed WHERE NOT is_ultimate_parent GROUP BY 1""",
    "b_owners": """
SELECT 'S' || s_suppkey AS child, 'S' || greatest(s_suppkey - 1, 0) AS parent, 1.0 AS share FROM supplier
UNION ALL SELECT 'C' || c_custkey, 'C' || (c_custkey - 1) // 2, 0.6 FROM customer WHERE c_custkey > 0
UNION ALL SELECT 'C0', 'S' || max(s_suppkey), 0.9 FROM supplier
UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, 0.3 FROM customer, range(2) WHERE c_custkey % 4 = 1
UNION ALL SELECT 'N' || n_nationkey, 'N' || (n_nationkey + 5) % 25, 0.5 FROM nation
UNION ALL SELECT 'P' || p_partkey, CASE WHEN p_partkey % 50 <> 0 THEN 'N' || p_size % 25 END, 0.2 FROM part""",
    "b_closure": """
SELECT e.entity, CASE WHEN l.node IS NULL THEN 'ROOT' WHEN f.root IS NOT NULL THEN 'OWNED'
                      WHEN r.node IS NOT NULL THEN 'CYCLE' ELSE 'UNDER_CYCLE' END AS status,
       CASE WHEN l.node IS NULL THEN e.entity ELSE f.root END AS ultimate_parent,
       CASE WHEN l.node IS NULL THEN 0 ELSE f.depth END AS depth, coalesce(l.parents, 0) AS parents,
       CASE WHEN l.node IS NOT NULL AND f.root IS NULL THEN coalesce(r.cycle_id, u.cycle_id) END AS cycle_id
FROM (SELECT child AS entity FROM b_owners UNION SELECT parent FROM b_owners WHERE parent IS NOT NULL) e
LEFT JOIN b_links l ON l.node = e.entity
LEFT JOIN (SELECT w.node, w.top AS root, w.depth FROM b_walk w LEFT JOIN b_links x ON x.node = w.top WHERE x.node IS NULL) f
       ON f.node = e.entity
LEFT JOIN b_rings r ON r.node = e.entity
LEFT JOIN (SELECT w.node, min(r.cycle_id) AS cycle_id FROM b_walk w JOIN b_rings r ON r.node = w.top GROUP BY 1) u ON u.node = e.entity""",
    "b_links": """
SELECT child AS node, arg_min(parent, (-share, parent)) AS up, count(DISTINCT parent) AS parents
FROM b_owners WHERE parent IS NOT NULL AND child <> parent GROUP BY 1""",
    "b_walk": """
SELECT node, up AS top, CAST(1 AS BIGINT) AS depth, [node, up] AS met FROM b_links
UNION ALL
SELECT w.node, l.up, w.depth + 1, list_append(w.met, l.up) FROM b_walk w JOIN b_links l ON l.node = w.top
WHERE NOT list_contains(w.met[:-2], w.top)""",
    "b_rings": """
SELECT node, list_min(met) AS cycle_id FROM b_walk WHERE top = node""",
    "b_entity_amounts": """
SELECT 'C' || o_custkey AS entity, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders
UNION ALL SELECT 'S' || l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem
UNION ALL SELECT 'P' || p_partkey, CAST(p_retailprice AS DECIMAL(18,2)) FROM part""",
    "b_rule_versions": """
SELECT CAST(o_custkey AS VARCHAR) AS counterparty_code, CAST(o_orderdate AS DATE) AS valid_from,
       CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + 400 END AS valid_to, 'RULE-' || o_orderkey % 7 AS rule
FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "b_dated": """
SELECT CAST(o_orderkey AS VARCHAR) AS trade_id, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS counterparty_code,
       CAST(o_orderdate AS DATE) AS booked_on, CAST(o_totalprice AS DECIMAL(18,2)) AS exposure_amount
FROM orders""",
    "b_sales_reported": """
SELECT order_id, line_id, CASE WHEN order_id % 211 = 0 THEN CAST(amount + 0.01 AS DECIMAL(18,2))
                               WHEN NOT (order_id % 401 = 0 AND line_id = 1) THEN amount END AS amount
FROM b_sales_b WHERE order_id % 307 <> 0""",
    "b_column_edges": """
SELECT DISTINCT p.p_brand AS product_id, 'col_' || p.p_partkey AS column_name, u.p_brand AS upstream_product,
       'col_' || u.p_partkey AS upstream_column,
       CASE WHEN p.p_size % 5 = 0 THEN 'hash' WHEN p.p_size % 7 = 0 THEN 'sum' WHEN u.p_partkey * 2 = p.p_partkey THEN 'identity'
            ELSE 'rename' END AS transform
FROM part p JOIN part u ON u.p_partkey IN (p.p_partkey // 2, p.p_partkey // 3)""",
    "b_limits": """
SELECT CAST(c_custkey AS VARCHAR) AS counterparty_code, 'A' AS facility_id,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 50 AS DECIMAL(18,2)) AS limit_amount FROM customer WHERE c_acctbal > 0
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), 'B', CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 25 AS DECIMAL(18,2))
FROM customer WHERE c_acctbal > 0""",
    "b_orders_nation": """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
       n.n_nationkey, n.n_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "b_fx": """
SELECT DISTINCT n_name AS currency, last_day(CAST(o_orderdate AS DATE)) AS business_date,
       CAST(CAST(n_nationkey + 100 AS DECIMAL(10,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,4)) AS rate
FROM b_orders_nation WHERE n_nationkey < 20""",
    "b_buffer": """
SELECT CAST(o_orderkey AS VARCHAR) AS position_id, last_day(CAST(o_orderdate AS DATE)) AS business_date,
       n_name AS currency, o_orderpriority AS asset_code, 'SRC' AS source_system,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount
FROM b_orders_nation""",
    "b_pledged": """
SELECT CAST(o_orderkey AS VARCHAR) AS position_id, last_day(CAST(o_orderdate AS DATE)) AS business_date,
       n_name AS currency, o_orderpriority AS asset_code, 'SRC' AS source_system,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount
FROM b_orders_nation WHERE o_orderstatus = 'P'""",
    "b_paths": """
SELECT CAST(l_suppkey AS VARCHAR) AS netting_set, CAST(l_orderkey AS VARCHAR) AS trade_id,
       CASE l_linestatus WHEN 'F' THEN 'base' WHEN 'O' THEN 'stressed' END AS scenario,
       l_orderkey % 100 AS path_id,
       CAST(year(CAST(l_shipdate AS DATE)) - 1994 AS DOUBLE) AS time_y,
       CAST(CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2))
                 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS value
FROM lineitem""",
    "b_quotes": """
SELECT p_brand AS curve_id, t.tenor_y,
       CAST(50.0 AS DOUBLE) + t.tenor_y * 10 + CAST(split_part(p_brand, '#', 2) AS INTEGER) AS spread_bp
FROM (SELECT DISTINCT p_brand FROM part WHERE CAST(split_part(p_brand, '#', 2) AS INTEGER) % 10 <> 5) b,
     (SELECT CAST(UNNEST([1, 3, 5, 10]) AS DOUBLE) AS tenor_y) t""",
    "b_sens": """
SELECT CAST(l.l_orderkey AS VARCHAR) AS trade_id, l.l_linenumber AS line_id,
       CAST(l.l_suppkey AS VARCHAR) AS counterparty_code, p.p_brand AS curve_id,
       CAST(p.p_size AS DOUBLE) AS tenor_y,
       CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS cs01
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "b_issuer_names": """
SELECT p_partkey, translate(reverse(CAST(p_partkey AS VARCHAR)), '0123456789', 'ABCDEFGHIJ') AS word, upper(p_name) AS name,
       upper(p_type) AS kind, p_size % 4 AS f, ['LLC', 'BANK NA', 'HOLDINGS PLC', '& CO'][p_size % 4 + 1] AS form,
       ['LIMITED LIABILITY COMPANY', 'BANK NATIONAL ASSOCIATION', 'HOLDINGS PUBLIC LIMITED COMPANY', 'AND COMPANY'][p_size % 4 + 1]
         AS long_form
FROM part""",
    "b_issuers": """
SELECT CAST(p_partkey AS VARCHAR) AS counterparty_code, concat_ws(' ', word, name, kind, form) AS variant_name, TRUE AS is_canonical
FROM b_issuer_names
UNION ALL SELECT CAST(p_partkey AS VARCHAR), lower(concat_ws(' ', word, name, kind, form)), FALSE FROM b_issuer_names""",
    "b_bookings": """
SELECT CAST(p_partkey AS VARCHAR) AS booking_id,
       CASE p_partkey % 7 WHEN 0 THEN concat_ws(' ', word, name) WHEN 1 THEN concat_ws(' ', word, name, kind, 'LONDON')
            WHEN 2 THEN concat_ws(' ', word, name, kind, long_form) WHEN 3 THEN concat_ws(' ', kind, name, word)
            WHEN 4 THEN concat_ws(' ', name, kind)
            WHEN 5 THEN concat(word[:3], name[:1], split_part(name, ' ', 2)[:1], kind[:1], CASE f WHEN 3 THEN '_CO' WHEN 1 THEN 'B' ELSE '' END)
            ELSE concat_ws('-', word, replace(name, ' ', '_'), kind, form) END AS booked_name
FROM b_issuer_names""",
    "b_cashflows": """
SELECT CAST(l.l_orderkey AS VARCHAR) AS trade_id, p.p_brand AS curve_id,
       CAST(l.l_linenumber AS DOUBLE) AS time_y, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "b_loads": """
SELECT event_type AS product_id, CAST(ts AS TIMESTAMP) AS load_time, event_id AS load_id FROM events""",
    "b_loads_listed": """
SELECT nullif(product_id, 'error') AS product_id, load_time, load_id FROM b_loads""",
    "b_tags": """
SELECT 'warehouse' AS table_catalog, 'core' AS table_schema, 'parts' AS table_name,
       'col_' || CAST(p_partkey AS VARCHAR) AS column_name, 'source_aliases' AS tag_name,
       p_type || ':c' || CAST(p_partkey AS VARCHAR) || ',app2:x_' || CAST(p_partkey % 50 AS VARCHAR) AS tag_value
FROM part""",
    "b_registry": """
SELECT s_name AS consumer_id,
       CASE WHEN s_suppkey % 2 = 0 THEN 'dashboard' ELSE 'pipeline' END AS consumer_type,
       'owner_' || CAST(s_nationkey AS VARCHAR) AS consumer_owner, 'bi' AS consumer_platform,
       'product_' || CAST(s_nationkey % 5 AS VARCHAR) AS producer_product, '1.0.0' AS producer_version,
       DATE '2023-01-01' AS registered_date,
       CASE WHEN s_suppkey % 11 <> 0
            THEN CAST(DATE '2024-01-01' + CAST((s_suppkey * 7) % 730 AS INTEGER) AS DATE) END AS last_validated_date,
       s_acctbal > 5000 AS business_critical
FROM supplier""",
    "b_positions": """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS position_id,
       CAST(l_suppkey AS VARCHAR) AS agreement_id, CAST(l_shipdate AS DATE) AS as_of_date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS market_value, CAST(l_discount AS DECIMAL(4,2)) AS haircut
FROM lineitem""",
    "b_query_log": """
SELECT event_id AS query_id, 'k' || CAST(user_id AS VARCHAR) AS consumer_id,
       CASE event_type WHEN 'error' THEN 'app_a' WHEN 'signup' THEN 'app_b' ELSE 'warehouse' END AS table_catalog,
       't_' || event_type AS table_name, CAST(ts AS TIMESTAMP) AS read_time
FROM events""",
    "b_sales_a": """
SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders""",
    "b_sales_b": """
SELECT l_orderkey AS order_id, l_linenumber AS line_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
FROM lineitem""",
}

# views that other views read
_DEPENDS = {"b_fx": ["b_orders_nation"], "b_buffer": ["b_orders_nation"],
            "b_pledged": ["b_orders_nation"], "b_legal_listed": ["b_legal"], "b_own": ["b_legal", "b_legal_listed"],
            "b_sales_reported": ["b_sales_b"], "b_issuers": ["b_issuer_names"], "b_bookings": ["b_issuer_names"], "b_loads_listed": ["b_loads"], "b_links": ["b_owners"], "b_walk": ["b_owners", "b_links"],
            "b_rings": ["b_owners", "b_links", "b_walk"], "b_closure": ["b_owners", "b_links", "b_walk", "b_rings"]}


def with_views(names: list[str], body: str) -> str:
    """``WITH`` the named binding views (and what they read), then ``body``."""
    order: list[str] = []
    for n in names:
        for dep in _DEPENDS.get(n, []):
            if dep not in order:
                order.append(dep)
        if n not in order:
            order.append(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)
    body = body.strip()
    if not order:
        return body
    if "b_walk" in order:
        ctes = "RECURSIVE " + ctes
    if body[:14].upper() == "WITH RECURSIVE" and body[14:15].isspace():
        return f"WITH RECURSIVE {ctes.removeprefix('RECURSIVE ')},\n{body[15:]}"
    if body[:4].upper() == "WITH" and body[4:5].isspace():
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
