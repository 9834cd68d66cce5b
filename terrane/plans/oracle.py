"""The catalogue's queries as DuckDB SQL over the same tables, written independently of Spark."""

from __future__ import annotations

_PRODUCT = "replace(p_name, ' ', '') || '_' || lower(p_type) || '_' || p_partkey"
_HASH = (
    "sha256(concat_ws('|', coalesce(customer_id::VARCHAR, ''), coalesce(status, ''),"
    " coalesce(priority, ''), coalesce(effective_start_date::VARCHAR, '')))"
)
_NORM = "regexp_replace(lower({}), '[^a-z0-9]', '', 'g')"


def _cents(amount: str) -> str:
    return f"round(({amount})::DECIMAL(18,4), 2)::DOUBLE"


def _sum(amount: str) -> str:
    return f"round(sum(({amount})::DECIMAL(18,4)), 2)::DOUBLE"


def _snapshot(name: str, condition: str) -> str:
    return f"""
{name} AS (
  SELECT o_custkey AS customer_id, o_orderstatus AS status, o_orderpriority AS priority,
         o_orderdate AS effective_start_date
  FROM orders WHERE {condition}
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC,
                             o_orderstatus DESC, o_orderpriority DESC) = 1)"""


def _links(name: str, facts: str, key: str, min_len: int) -> str:
    return f"""
{name} AS (
  SELECT k AS {key}, anime_id
  FROM (SELECT DISTINCT {key} AS k FROM {facts} WHERE {key} IS NOT NULL) f
  JOIN titles ON contains({_NORM.format('k')}, {_NORM.format('title')})
             AND length({_NORM.format('title')}) >= {min_len}
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY {_NORM.format('title')} DESC, anime_id) = 1)"""


_VERSIONED = "customer_id, status, priority, effective_start_date, effective_end_date, is_current"


def _scd2(name: str, dim: str, incoming: str, as_of: str, missing_end: str) -> str:
    """Dimension ``dim`` after snapshot ``incoming``, with one SELECT per kind of resulting row."""
    changed = "(o.status IS DISTINCT FROM n.status OR o.priority IS DISTINCT FROM n.priority)"
    start = (
        f"CASE WHEN n.effective_start_date > o.effective_start_date THEN n.effective_start_date"
        f" ELSE TIMESTAMP '{as_of}' END"
    )
    pair = f"{dim} o JOIN {incoming} n ON o.is_current AND o.customer_id = n.customer_id"
    return f"""
{name} AS (
  SELECT {_VERSIONED} FROM {dim} WHERE NOT is_current
  UNION ALL
  SELECT o.* FROM {pair} WHERE NOT {changed}
  UNION ALL
  SELECT o.customer_id, o.status, o.priority, o.effective_start_date, {start}, false FROM {pair} WHERE {changed}
  UNION ALL
  SELECT n.customer_id, n.status, n.priority, {start}, NULL, true FROM {pair} WHERE {changed}
  UNION ALL
  SELECT n.customer_id, n.status, n.priority, n.effective_start_date, NULL, true FROM {incoming} n
  WHERE n.customer_id NOT IN (SELECT customer_id FROM {dim} WHERE is_current)
  UNION ALL
  SELECT o.customer_id, o.status, o.priority, o.effective_start_date, {missing_end}
  FROM {dim} o WHERE o.is_current AND o.customer_id NOT IN (SELECT customer_id FROM {incoming}))"""


_BASE = ",".join([
    f"""
sales AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id, o_orderdate AS event_ts,
         l_shipdate AS ingestion_ts, o_custkey::VARCHAR AS customer_id, {_PRODUCT} AS product_id,
         l_quantity::INTEGER AS quantity_purchased, l_extendedprice / l_quantity AS unit_price_at_sale
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE l_linestatus = 'F')""",
    f"""
deliveries AS (
  SELECT l_orderkey || '-' || l_linenumber AS delivery_id, o_orderdate AS event_ts,
         l_shipdate AS ingestion_ts, l_suppkey::VARCHAR AS supplier_id, {_PRODUCT} AS product_id,
         l_quantity::INTEGER AS quantity_delivered,
         l_extendedprice * (1 - l_discount) / l_quantity AS unit_cost
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE l_linestatus = 'O')""",
    """
sales1 AS (
  SELECT * FROM sales QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingestion_ts DESC,
    event_ts DESC, customer_id DESC, product_id DESC, quantity_purchased DESC, unit_price_at_sale DESC) = 1)""",
    """
deliveries1 AS (
  SELECT * FROM deliveries QUALIFY row_number() OVER (PARTITION BY delivery_id ORDER BY ingestion_ts DESC,
    event_ts DESC, supplier_id DESC, product_id DESC, quantity_delivered DESC, unit_cost DESC) = 1)""",
    """
screen_events AS (
  SELECT event_id::VARCHAR AS id, event_type, ts, user_id::VARCHAR AS customer_id, value,
         replace(p_name, ' ', '') || '_hall_' || p_partkey AS screening_id, ceil(value / 25)::INTEGER AS units
  FROM events JOIN part ON json_extract_string(props, '$.k')::BIGINT = p_partkey)""",
    "\nbookings AS (SELECT * FROM screen_events WHERE event_type = 'purchase')",
    """
titles AS (
  SELECT title, 'name-' || min(p_partkey) AS anime_id, min(p_type) AS genre, max(p_brand) AS season
  FROM (SELECT *, p_name AS title FROM part) GROUP BY title
  UNION ALL
  SELECT title, 'noun-' || min(p_partkey), min(p_type), max(p_brand)
  FROM (SELECT *, split_part(p_name, ' ', 2) AS title FROM part) GROUP BY title)""",
    f"\nproducts AS (SELECT {_PRODUCT} AS product_id FROM part)",
    _links("links", "products", "product_id", 1),
    _links("halls", "bookings", "screening_id", 3),
    _links("halls5", "bookings", "screening_id", 5),
    f"""
clean_sales AS (
  SELECT transaction_id, event_ts AS transaction_ts, customer_id, product_id, quantity_purchased,
         {_cents('unit_price_at_sale * quantity_purchased')} AS total_price, anime_id AS linked_anime_id
  FROM sales1 LEFT JOIN links USING (product_id))""",
    f"""
clean_bookings AS (
  SELECT id AS booking_id, ts AS booking_ts, customer_id, screening_id, units AS quantity_purchased,
         {_cents('value * units')} AS total_price, anime_id AS linked_anime_id
  FROM bookings LEFT JOIN halls USING (screening_id))""",
    """
ledger AS (
  SELECT product_id, event_ts AS movement_ts, quantity_delivered::BIGINT AS quantity_change,
         'DELIVERY' AS movement_type, delivery_id AS movement_id FROM deliveries1
  UNION ALL
  SELECT product_id, event_ts, -quantity_purchased::BIGINT, 'SALE', transaction_id FROM sales1)""",
    """
supplier_of AS (
  SELECT product_id, supplier_id FROM deliveries1
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ingestion_ts DESC, delivery_id DESC) = 1)""",
    """
inventory AS (
  SELECT product_id, anime_id AS linked_anime_id, current_quantity, last_update_ts, supplier_id
  FROM (SELECT product_id, sum(quantity_change)::BIGINT AS current_quantity,
               max(movement_ts) AS last_update_ts FROM ledger GROUP BY 1)
  LEFT JOIN supplier_of USING (product_id) LEFT JOIN links USING (product_id))""",
    f"""
concession_summary AS (
  SELECT screening_id, sum(units)::BIGINT AS total_quantity_purchased, {_sum('value * units')} AS total_revenue
  FROM screen_events WHERE event_type = 'click' GROUP BY 1)""",
    """
fact_sales AS (
  SELECT transaction_id AS sale_id, customer_id, s.product_id, transaction_ts::DATE AS calendar_date,
         quantity_purchased AS quantity, total_price AS revenue, current_quantity AS inventory_level_at_sale
  FROM clean_sales s LEFT JOIN inventory i ON s.product_id = i.product_id)""",
    """
fact_screenings AS (
  SELECT booking_id, b.screening_id, linked_anime_id AS anime_id, booking_ts::DATE AS calendar_date,
         total_price AS ticket_revenue, total_revenue AS concession_revenue
  FROM clean_bookings b LEFT JOIN concession_summary c ON b.screening_id = c.screening_id)""",
    f"""
screening_totals AS (
  SELECT screening_id, anime_id, count(*) AS bookings, {_sum('ticket_revenue')} AS ticket_revenue,
         max(concession_revenue) AS concession_revenue
  FROM fact_screenings GROUP BY 1, 2)""",
    f"""
screening_features AS (
  SELECT anime_id, {_sum('ticket_revenue')} AS sales_from_tickets,
         {_sum('ticket_revenue')} / sum(bookings) AS avg_views,
         {_sum('concession_revenue')} AS sales_from_concessions
  FROM screening_totals GROUP BY 1)""",
    f"""
sales_by_name AS (
  SELECT title AS name, {_sum('revenue')} AS sales_from_pos
  FROM fact_sales JOIN links USING (product_id) JOIN titles USING (anime_id) GROUP BY 1)""",
    """
activity AS (
  SELECT coalesce(p.customer_id, t.customer_id) AS customer_id, coalesce(product_count, 0) AS product_count,
         coalesce(ticket_count, 0) AS ticket_count
  FROM (SELECT o_custkey::VARCHAR AS customer_id, count(*) AS product_count FROM orders GROUP BY 1) p
  FULL JOIN (SELECT user_id::VARCHAR AS customer_id, count(*) AS ticket_count FROM events
        WHERE event_type = 'purchase' GROUP BY 1) t
  ON p.customer_id = t.customer_id)""",
    """
segmented AS (
  SELECT c_custkey::VARCHAR AS customer_id, c_name AS name,
         CASE WHEN p < 9 AND t < 12 THEN 'Low Spender'
              WHEN p BETWEEN 9 AND 11 AND t < 12 THEN 'Moderate - Products'
              WHEN p < 9 AND t BETWEEN 12 AND 15 THEN 'Moderate - Tickets'
              WHEN p BETWEEN 9 AND 11 AND t BETWEEN 12 AND 15 THEN 'Moderate - Both'
              WHEN p >= 12 AND t < 12 THEN 'Heavy - Products'
              WHEN p < 9 AND t >= 16 THEN 'Heavy - Tickets'
              WHEN p >= 12 AND t >= 16 THEN 'Top Customer'
              ELSE 'Low Spender' END AS segment,
         'c' || c_custkey || '@example.com' AS email
  FROM (SELECT customer.*, coalesce(product_count, 0) AS p, coalesce(ticket_count, 0) AS t
        FROM customer LEFT JOIN activity ON c_custkey::VARCHAR = customer_id))""",
    """
ranked_titles AS (
  SELECT anime_id, title, coalesce(pos, 0.0)::DOUBLE AS pos, coalesce(tickets, 0.0)::DOUBLE AS tickets,
         coalesce(attendance, 0)::BIGINT AS total_attendance
  FROM titles
  LEFT JOIN (SELECT linked_anime_id AS a, """ + _sum("total_price") + """ AS pos FROM clean_sales GROUP BY 1) x
    ON anime_id = x.a
  LEFT JOIN (SELECT linked_anime_id AS a, """ + _sum("total_price") + """ AS tickets,
             sum(quantity_purchased) AS attendance FROM clean_bookings GROUP BY 1) y ON anime_id = y.a)""",
    """
customer_orders AS (
  SELECT c_custkey AS customer_id, c_name, c_acctbal, o_orderkey, o_orderstatus
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey)""",
    """
versions AS (
  SELECT o_custkey AS customer_id, o_orderstatus AS status, o_orderpriority AS priority,
         o_orderdate AS effective_start_date, o_orderkey AS order_id FROM orders)""",
    _snapshot("state1996", "o_orderdate < TIMESTAMP '1996-01-01'"),
    _snapshot("state1997", "o_orderdate < TIMESTAMP '1997-01-01'"),
    _snapshot("state1998", "o_orderdate < TIMESTAMP '1998-01-01'"),
    _snapshot("state1999", "o_orderdate < TIMESTAMP '1999-01-01'"),
    _snapshot("year1998", "o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'"),
    _snapshot("latest", "true"),
    "\nopen1996 AS (SELECT *, NULL::TIMESTAMP AS effective_end_date, true AS is_current FROM state1996)",
    "\nopen1998 AS (SELECT *, NULL::TIMESTAMP AS effective_end_date, true AS is_current FROM state1998)",
    _scd2("dimension", "open1996", "state1997", "1997-01-01", "o.effective_end_date, true"),
    _scd2("kept1999", "dimension", "year1998", "1999-01-01", "o.effective_end_date, true"),
    _scd2("closed1999", "dimension", "year1998", "1999-01-01", "TIMESTAMP '1999-01-01', false"),
    """
meeting AS (
  SELECT n.*, o.customer_id IS NOT NULL AS known, o.status AS old_status, o.priority AS old_priority,
         o.effective_start_date AS old_start,
         n.status IS DISTINCT FROM o.status OR n.priority IS DISTINCT FROM o.priority AS changed
  FROM latest n LEFT JOIN open1998 o ON n.customer_id = o.customer_id),
changes AS (
  SELECT customer_id, status, priority, effective_start_date, NULL::TIMESTAMP AS effective_end_date,
         true AS is_current, 'add' AS scd_action
  FROM meeting WHERE NOT known OR (changed AND effective_start_date > old_start)
  UNION ALL
  SELECT customer_id, old_status, old_priority, old_start, effective_start_date, false, 'close'
  FROM meeting WHERE known AND changed AND effective_start_date > old_start
  UNION ALL
  SELECT customer_id, status, priority, effective_start_date, NULL, false, 'late'
  FROM meeting WHERE known AND changed AND effective_start_date <= old_start)""",
    f"\nhashed_dimension AS (SELECT *, {_HASH} AS record_hash FROM dimension)",
    f"\nhashed1996 AS (SELECT *, {_HASH} AS record_hash FROM open1996)",
])


def _q(select: str) -> str:
    return f"WITH {_BASE}\n{select.strip()}"


_CUSTOMER_CHECKS = """
SELECT 'rows' AS "check", '*' AS "column", count(*) AS violations FROM customer_orders
UNION ALL SELECT 'not_null', 'customer_id', count(*) FROM customer_orders WHERE customer_id IS NULL
UNION ALL SELECT 'not_null', 'o_orderkey', count(*) FROM customer_orders WHERE o_orderkey IS NULL
"""

SQL = {
    "clean_sales": _q("SELECT * FROM clean_sales"),
    "line_total": _q(f"""
        SELECT transaction_id, event_ts AS transaction_ts, product_id, quantity_purchased,
               {_cents('unit_price_at_sale * quantity_purchased')} AS total_price FROM sales"""),
    "current_rows": _q(f"SELECT {_VERSIONED} FROM dimension WHERE is_current"),
    "dropna_subset": _q("SELECT * FROM customer_orders WHERE customer_id IS NOT NULL AND o_orderkey IS NOT NULL"),
    "join_left": _q("SELECT * FROM customer_orders"),
    "join_full": """
        SELECT coalesce(user_id, o_custkey) AS customer_id, n_events, n_orders
        FROM (SELECT user_id, count(*) AS n_events FROM events GROUP BY 1)
        FULL JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON user_id = o_custkey""",
    "new_rows_only": _q("""
        SELECT * FROM sales s WHERE NOT EXISTS (
          SELECT 1 FROM sales k WHERE k.transaction_id = s.transaction_id
            AND k.ingestion_ts < TIMESTAMP '1998-01-01')"""),
    "new_rows_by_bits": _q("""
        SELECT * FROM sales s WHERE NOT EXISTS (
          SELECT 1 FROM sales k WHERE k.transaction_id = s.transaction_id
            AND k.ingestion_ts < TIMESTAMP '1998-01-01')"""),
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "distinct_keys": _q(f"""
        SELECT DISTINCT product_id, {_NORM.format('product_id')} AS normalized_id,
               string_split(product_id, '_')[2] AS category, string_split(product_id, '_')[8] AS absent
        FROM sales"""),
    "dedupe_latest": _q("SELECT * FROM sales1"),
    "latest_by_key": _q("""
        SELECT product_id, transaction_id, unit_price_at_sale, ingestion_ts AS last_price_update FROM sales1
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ingestion_ts DESC, transaction_id DESC) = 1"""),
    "link_entities": _q("SELECT product_id, anime_id FROM links"),
    "link_min_len": _q("SELECT screening_id, anime_id FROM halls5"),
    "link_docs": f"""
        SELECT d.doc_id, b.item_id FROM documents d
        JOIN benchmark b ON contains({_NORM.format('d.text')}, {_NORM.format('b.text')})
                        AND length({_NORM.format('b.text')}) >= 1
        QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY {_NORM.format('b.text')} DESC, b.item_id) = 1""",
    "clean_bookings": _q("SELECT * FROM clean_bookings"),
    "product_master": _q("""
        SELECT product_id, supplier_id, unit_cost AS current_unit_cost, unit_price_at_sale AS current_unit_price,
               last_cost_update, last_price_update, string_split(product_id, '_')[2] AS category,
               anime_id AS linked_anime_id
        FROM (SELECT product_id, supplier_id, unit_cost, ingestion_ts AS last_cost_update FROM deliveries1
              QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ingestion_ts DESC, delivery_id DESC) = 1)
        FULL JOIN (SELECT product_id, unit_price_at_sale, ingestion_ts AS last_price_update FROM sales1
              QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ingestion_ts DESC, transaction_id DESC) = 1)
          USING (product_id)
        LEFT JOIN links USING (product_id)"""),
    "customer_master": """
        SELECT registration_id, lower(trim(customer_id)) AS customer_id, name, email
        FROM (SELECT o_orderkey::VARCHAR AS registration_id, '  ' || upper(c_name) || ' ' AS customer_id,
                     c_name AS name, 'c' || o_custkey || '.' || lower(o_orderstatus) || '@example.com' AS email
              FROM orders JOIN customer ON o_custkey = c_custkey)
        QUALIFY row_number() OVER (PARTITION BY lower(trim(customer_id)) ORDER BY registration_id DESC) = 1""",
    "movement_ledger": _q("SELECT * FROM ledger"),
    "inventory_position": _q("SELECT * FROM inventory"),
    "revenue_summary": _q("SELECT * FROM concession_summary"),
    "scd2_changed": _q("""
        SELECT n.customer_id, o.customer_id IS NULL AS is_new,
               n.status IS DISTINCT FROM o.status OR n.priority IS DISTINCT FROM o.priority AS is_changed
        FROM state1999 n LEFT JOIN state1997 o ON n.customer_id = o.customer_id"""),
    "scd2_apply": _q("SELECT * FROM changes"),
    "scd2_merge": _q(f"""
        SELECT {_VERSIONED} FROM open1998 o WHERE NOT EXISTS (
          SELECT 1 FROM changes c WHERE c.scd_action <> 'late' AND c.customer_id = o.customer_id
            AND c.effective_start_date = o.effective_start_date)
        UNION ALL SELECT {_VERSIONED} FROM changes WHERE scd_action <> 'late'"""),
    "scd2_full_outer": _q(f"SELECT {_VERSIONED} FROM kept1999"),
    "scd2_close_missing": _q(f"SELECT {_VERSIONED} FROM closed1999"),
    "scd2_history": _q("""
        SELECT customer_id, status, priority, effective_start_date,
               lead(effective_start_date) OVER w AS effective_end_date, lead(1) OVER w IS NULL AS is_current
        FROM (SELECT *, lag((status, priority)) OVER (PARTITION BY customer_id ORDER BY effective_start_date) AS before
              FROM (SELECT customer_id, effective_start_date, status, priority FROM versions
                    QUALIFY row_number() OVER (PARTITION BY customer_id, effective_start_date ORDER BY status DESC, priority DESC) = 1))
        WHERE before IS NULL OR before IS DISTINCT FROM (status, priority)
        WINDOW w AS (PARTITION BY customer_id ORDER BY effective_start_date)"""),
    "row_hash": _q(f"SELECT order_id, {_HASH} AS record_hash FROM versions"),
    "hash_diff_append": _q(f"""
        SELECT * FROM (SELECT *, {_HASH} AS record_hash FROM versions) n WHERE NOT EXISTS (
          SELECT 1 FROM (SELECT *, {_HASH} AS record_hash FROM versions) k
          WHERE k.effective_start_date < TIMESTAMP '1998-01-01' AND k.customer_id = n.customer_id
            AND k.record_hash = n.record_hash AND k.effective_start_date = n.effective_start_date)"""),
    "closure_updates": _q("""
        SELECT d.* FROM hashed_dimension d WHERE NOT d.is_current AND EXISTS (
          SELECT 1 FROM hashed1996 t WHERE t.is_current AND t.customer_id = d.customer_id
            AND t.record_hash = d.record_hash AND t.effective_start_date = d.effective_start_date)"""),
    "hash_diff_refresh": _q("""
        SELECT * FROM hashed_dimension
        UNION ALL
        SELECT t.customer_id, t.status, t.priority, t.effective_start_date, t.effective_end_date, t.is_current,
               t.record_hash
        FROM hashed1996 t WHERE NOT EXISTS (
          SELECT 1 FROM hashed_dimension d WHERE t.customer_id = d.customer_id
            AND t.record_hash = d.record_hash AND t.effective_start_date = d.effective_start_date)"""),
    "replace_by_key": _q("""
        SELECT * FROM state1997 WHERE customer_id NOT IN (SELECT customer_id FROM year1998)
        UNION ALL SELECT * FROM year1998"""),
    "fact_sales": _q("SELECT * FROM fact_sales"),
    "level_at_sale": _q("""
        SELECT movement_id AS transaction_id, product_id, level FROM (
          SELECT *, sum(quantity_change) OVER (PARTITION BY product_id
            ORDER BY movement_ts, movement_type, movement_id ROWS UNBOUNDED PRECEDING)::BIGINT AS level FROM ledger)
        WHERE movement_type = 'SALE'"""),
    "fact_screenings": _q("SELECT * FROM fact_screenings"),
    "screening_refresh": _q("SELECT * FROM fact_screenings"),
    "screening_refresh_parts": _q("SELECT * FROM fact_screenings"),
    "screening_totals": _q("SELECT * FROM screening_totals"),
    "screening_features": _q("SELECT * FROM screening_features"),
    "activity_counts": _q("SELECT * FROM activity"),
    "customer_segmentation": _q("SELECT * FROM segmented"),
    "segment_summary": _q("""
        SELECT segment, count(*) AS customer_count,
               CASE segment WHEN 'Low Spender' THEN 'Buys few or no products or tickets'
                 WHEN 'Moderate - Products' THEN 'Buys 2–3 products, few tickets'
                 WHEN 'Moderate - Tickets' THEN 'Buys 2–3 tickets, few products'
                 WHEN 'Moderate - Both' THEN 'Buys 2–3 of both tickets and products'
                 WHEN 'Heavy - Products' THEN 'Buys >3 products, few tickets'
                 WHEN 'Heavy - Tickets' THEN 'Buys >3 tickets, few products'
                 WHEN 'Top Customer' THEN 'Buys more than 3 in both products and tickets'
                 ELSE 'Uncategorized' END AS description
        FROM segmented GROUP BY 1"""),
    "top_entities": _q("""
        SELECT anime_id, title, pos AS total_sales, total_attendance FROM ranked_titles
        ORDER BY total_sales DESC, anime_id LIMIT 5"""),
    "top_entities_total": _q(f"""
        SELECT anime_id, title, {_cents('pos + tickets')} AS total_sales, total_attendance FROM ranked_titles
        ORDER BY total_sales DESC, anime_id LIMIT 5"""),
    "inventory_status": _q("""
        SELECT product_id, current_quantity AS stock_level, last_update_ts::DATE AS last_update,
               CASE WHEN current_quantity < 30 THEN 'Low Stock – Reorder Needed'
                    WHEN current_quantity < 51 THEN 'Low Stock – Monitor' ELSE 'Stock OK' END AS status
        FROM inventory"""),
    "sales_by_dim_name": _q("SELECT * FROM sales_by_name"),
    "ml_features": _q(f"""
        SELECT t.anime_id, title,
               {_cents('coalesce(sales_from_tickets, 0) + coalesce(sales_from_concessions, 0) + coalesce(sales_from_pos, 0)')}
                 AS historical_sales,
               coalesce(avg_views, 0.0)::DOUBLE AS avg_views, season, genre
        FROM titles t LEFT JOIN screening_features f ON t.anime_id = f.anime_id
        LEFT JOIN sales_by_name ON title = name"""),
    "gate_nulls": _q(_CUSTOMER_CHECKS + """
        UNION ALL SELECT 'not_null', 'c_acctbal', count(*) FROM customer_orders
          WHERE c_acctbal IS NULL OR isnan(c_acctbal)"""),
    "dq_report": _q(_CUSTOMER_CHECKS + """
        UNION ALL SELECT 'not_null', 'c_name', count(*) FROM customer_orders WHERE c_name IS NULL
        UNION ALL SELECT 'positive', 'c_acctbal', count(*) FROM customer_orders WHERE c_acctbal <= 0
        UNION ALL SELECT 'unique', 'customer_id', count(*) FROM (
          SELECT customer_id FROM customer_orders GROUP BY 1 HAVING count(*) > 1)"""),
    "quarantine": _q("""
        SELECT *, concat_ws('; ', CASE WHEN o_orderkey IS NULL THEN 'has an order' END,
                 CASE WHEN c_acctbal IS NULL OR c_acctbal <= 0 THEN 'positive balance' END,
                 CASE WHEN o_orderstatus IS NULL OR o_orderstatus = 'P' THEN 'not pending' END) AS failed_rules
        FROM customer_orders
        WHERE o_orderkey IS NULL OR c_acctbal IS NULL OR c_acctbal <= 0 OR o_orderstatus IS NULL
           OR o_orderstatus = 'P'"""),
    "json_ingest": """
        SELECT event_id::VARCHAR AS booking_id, ts AS event_ts, ts AS ingestion_ts, user_id::VARCHAR AS customer_id,
               event_type AS screening_id, NULL::INTEGER AS quantity_purchased, value AS unit_price_at_sale
        FROM events""",
    "json_rejects": "SELECT text AS value FROM conversations",
    "late_events": _q("""
        SELECT *, coalesce(event_ts < high_water - INTERVAL 365 DAY, false) AS is_late FROM (
          SELECT delivery_id, supplier_id, event_ts, ingestion_ts,
                 max(event_ts) OVER (PARTITION BY supplier_id ORDER BY ingestion_ts, event_ts, delivery_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high_water
          FROM deliveries1)"""),
}
