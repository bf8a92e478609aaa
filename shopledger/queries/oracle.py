"""The SQL twin of every registered query, for DuckDB over the same tables.

Written straight from the meaning of each report (LAG over single orders, joins
per source, self-joins), not from the way the operators compute it.
"""

from __future__ import annotations

from shopledger.queries.adapters import FAMILIES, HISTORY_END, LATE_MONTHS, ORDER_SHIFT_DAYS
from shopledger.queries.registry import TABLE_KEYS

SHAPED = {
    "shop_customers": """
        SELECT c_custkey AS customer_id,
               split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               replace(c_name, '#', '') || '@example.com' AS email,
               n_name AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "dirty_customers": """
        SELECT CASE WHEN c_custkey % 13 <> 5 THEN c_custkey END AS customer_id,
               '  ' || split_part(c_name, '#', 1) || ' ' AS first_name,
               ' ' || split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_custkey % 7 = 3 THEN 'NoAtSign.example.com'
                    WHEN c_custkey % 11 = 4 THEN 'C' || c_custkey || '@nodot'
                    ELSE ' C' || c_custkey || '@Example.COM ' END AS email,
               '(' || substr(lpad(c_custkey::varchar, 9, '0'), 1, 3) || ') '
                   || substr(lpad(c_custkey::varchar, 9, '0'), 4, 6) AS phone,
               ' ' || c_custkey || ' Main St ' AS address,
               n_name AS city, c_mktsegment AS state, c_nationkey AS zip_code,
               n_name AS country
        FROM (SELECT * FROM customer UNION ALL
              SELECT * FROM customer WHERE c_custkey % 17 = 1)
        JOIN nation ON c_nationkey = n_nationkey""",
    "cleaned_customers": r"""
        SELECT DISTINCT customer_id, trim(first_name) AS first_name,
               trim(last_name) AS last_name, lower(trim(email)) AS email,
               regexp_replace(phone, '[^0-9]', '', 'g') AS phone, trim(address) AS address,
               city, state, zip_code::varchar AS zip_code, country
        FROM dirty_customers
        WHERE customer_id IS NOT NULL
          AND regexp_matches(email, '^[^@]+@[^@]+\.[^@]+$')""",
    "shop_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate::date AS order_date,
               o_orderstatus AS status, o_totalprice::decimal(10,2) AS total_amount
        FROM orders""",
    "shifted_orders": f"""
        SELECT order_id, customer_id, (order_date + {ORDER_SHIFT_DAYS})::date AS order_date,
               status, total_amount
        FROM shop_orders""",
    "dirty_orders": """
        SELECT CASE WHEN order_id % 19 <> 2 THEN order_id END AS order_id, customer_id,
               order_date, status,
               CASE WHEN order_id % 23 = 3 THEN -1.0 ELSE total_amount::double END AS total_amount
        FROM shop_orders""",
    "cleaned_orders": """
        SELECT DISTINCT o.order_id, o.customer_id, o.order_date, o.status,
               o.total_amount::decimal(10,2) AS total_amount
        FROM dirty_orders o JOIN cleaned_customers c ON o.customer_id = c.customer_id
        WHERE o.order_id IS NOT NULL AND o.total_amount > 0
          AND o.order_date <= DATE '2000-12-31'""",
    "sales": """
        SELECT l_orderkey AS order_id, customer_id, order_date, l_partkey AS product_id,
               l_quantity::int AS quantity, l_extendedprice::decimal(10,2) AS unit_price,
               (l_quantity::int * l_extendedprice::decimal(10,2))::decimal(21,2) AS sales_amount,
               year(order_date)::int AS order_year, month(order_date)::int AS order_month
        FROM lineitem
        JOIN shop_orders ON l_orderkey = order_id
        JOIN part ON l_partkey = p_partkey""",
    "history": f"""
        SELECT * REPLACE ((sales_amount + 7.25)::decimal(21,2) AS sales_amount)
        FROM sales WHERE order_date < DATE '{HISTORY_END}'""",
    "stored_text": """
        SELECT CASE WHEN order_id % 31 = 5 THEN 'C' || customer_id
                    WHEN order_id % 37 <> 6 THEN customer_id::varchar END AS customer_id,
               CASE WHEN order_id % 29 = 4 THEN replace(sales_amount::varchar, '.', ',')
                    ELSE sales_amount::varchar END AS sales_amount,
               strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date,
               quantity::bigint * CASE WHEN order_id % 41 = 7 THEN 2000000000 ELSE 1 END AS quantity
        FROM history""",
    "all_sales": f"""
        SELECT * FROM sales WHERE order_date >= DATE '{HISTORY_END}'
        UNION ALL SELECT * FROM history""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS name, p_type AS category FROM part""",
    "logins": """
        SELECT user_id AS customer_id, ts::date AS login_date, props AS ip_address
        FROM events""",
    "keyed_events": """
        SELECT *, json_extract_string(props, '$.k')::int AS k FROM events""",
    "interactions": """
        SELECT user_id AS "CustomerID", event_id % 5 AS "CampaignID",
               (event_type = 'view')::int AS "Opens", (event_type = 'click')::int AS "Clicks",
               event_id * 10 + step AS "InteractionID", ts AS "Timestamp",
               CASE (event_id // 3 + step) % 4 WHEN 0 THEN 'Email' WHEN 1 THEN 'Web'
                    WHEN 2 THEN 'App' ELSE 'SMS' END AS "Channel",
               CASE (event_id + step) % 3 WHEN 0 THEN 'Opened' WHEN 1 THEN 'Clicked'
                    ELSE 'Ignored' END AS "Action"
        FROM keyed_events, (VALUES (0), (1), (2)) AS steps(step)
        WHERE event_type <> 'signup' AND k % 10 <> 9 AND step <= k % 10 % 3""",
    "tickets": """
        SELECT user_id AS "CustomerID", event_id AS "TicketID", ts AS "Timestamp",
               CASE k % 3 WHEN 0 THEN 'Open' WHEN 1 THEN 'Resolved' ELSE 'Pending' END AS "Status",
               '{"Status":"' || "Status" || '"}' AS "Issue"
        FROM keyed_events""",
    "named_interactions": """
        SELECT * REPLACE ("CustomerID"::varchar AS "CustomerID") FROM interactions""",
    "named_orders": """
        SELECT * REPLACE (customer_id::varchar AS customer_id) FROM shifted_orders""",
    "named_tickets": """
        SELECT * REPLACE (CASE WHEN "CustomerID" % 9 = 4 THEN 'C' || "CustomerID"
                               ELSE "CustomerID"::varchar END AS "CustomerID") FROM tickets""",
    "spending": """
        SELECT customer_id, sum(total_amount)::decimal(20,2) AS total_spent,
               count(order_id) AS total_orders, max(order_date) AS last_purchase_date
        FROM shop_orders WHERE order_date >= DATE '2001-08-01' - 365
        GROUP BY customer_id""",
    "ranked": """
        SELECT c.*, total_spent, total_orders, last_purchase_date,
               rank() OVER (PARTITION BY country ORDER BY total_spent DESC)::int AS spending_rank
        FROM spending JOIN shop_customers c USING (customer_id)
        WHERE country LIKE 'NATION_1%'""",
}


def _with(names: str, query: str) -> str:
    """``query`` after the shaped tables it needs, given in dependency order."""
    ctes = ",\n".join(f"{name} AS ({SHAPED[name]})" for name in names.split())
    return f"WITH {ctes}\n{query}"


def _churn(orders: str, as_of: str) -> str:
    return f"""
        SELECT customer_id, count(order_id) AS total_orders, max(order_date) AS last_order_date,
               date_diff('day', max(order_date), DATE '{as_of}')::int AS days_since_last_purchase,
               avg(date_diff('day', previous, order_date)) AS avg_order_gap
        FROM (SELECT *, lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date)
                        AS previous FROM {orders})
        GROUP BY customer_id
        HAVING date_diff('day', max(order_date), DATE '{as_of}')
               > 2 * avg(date_diff('day', previous, order_date))"""


_HIGH_RISK = """
        SELECT customer_id FROM
          (SELECT customer_id FROM logins WHERE login_date >= DATE '2024-01-31' - 30
           GROUP BY customer_id HAVING count(DISTINCT ip_address) > 3 OR count(*) > 10)
        JOIN
          (SELECT customer_id FROM shifted_orders WHERE order_date >= DATE '2024-01-31' - 30
           GROUP BY customer_id HAVING sum(total_amount) > 5000 OR count(order_id) > 5)
        USING (customer_id)"""

_PROFILE = """
        SELECT customer_id, {columns}
        FROM (SELECT "CustomerID" AS customer_id,
                     count(*) FILTER ("Channel" = 'Email' AND "Action" = 'Opened') AS emails_opened,
                     count(*) FILTER ("Channel" = 'Email' AND "Action" = 'Clicked')
                         AS emails_clicked,
                     count(*) FILTER ("Channel" IN ('Web', 'App') AND "Action" = 'Clicked')
                         AS ad_clicks,
                     count(*) FILTER ("Channel" IN ('Web', 'App') AND "Action" = 'Opened')
                         AS ad_views
              FROM interactions WHERE "Timestamp" >= DATE '2024-04-09' - 90 GROUP BY 1) e
        FULL JOIN (SELECT customer_id, count(order_id) AS purchases,
                          sum(total_amount)::decimal(20,2) AS total_spent
                   FROM shifted_orders WHERE order_date >= DATE '2024-04-09' - 90
                   GROUP BY 1) p USING (customer_id)
        FULL JOIN (SELECT "CustomerID" AS customer_id, count("TicketID") AS total_ticket,
                          count(*) FILTER ("Status" = 'Open') AS open_ticket,
                          count(*) FILTER ("Status" = 'Resolved') AS resolved_ticket
                   FROM tickets WHERE "Timestamp" >= DATE '2024-04-09' - 90
                   GROUP BY 1) s USING (customer_id)"""

_PROFILE_TABLES = "shop_orders shifted_orders keyed_events interactions tickets"
_MEASURES = [
    "emails_opened", "emails_clicked", "ad_clicks", "ad_views", "purchases", "total_spent",
    "total_ticket", "open_ticket", "resolved_ticket",
]

_TOP_5 = """(SELECT customer_id FROM sales GROUP BY customer_id
             ORDER BY sum(sales_amount) DESC, customer_id LIMIT 5)"""


def _growth(current: str, previous: str) -> str:
    """Growth in percent by whole numbers: hundredths of cents, halves away from zero."""
    change = f"(10000 * (({current} - {previous}) * 100)::hugeint)"
    base = f"({previous} * 100)::hugeint"
    return (
        f"CASE WHEN {base} <> 0 THEN (sign({change}) * sign({base})"
        f" * ((2 * abs({change}) + abs({base})) // (2 * abs({base}))))::double / 100 END"
    )


def _yoy(product: str, products: str, top: int) -> str:
    return f"""
        , top AS (SELECT customer_id FROM sales GROUP BY customer_id
                  ORDER BY sum(sales_amount) DESC, customer_id LIMIT {top}),
        dim AS ({products}),
        monthly AS (
            SELECT customer_id, dim.product_id, name AS product_name, category,
                   year(order_date)::int AS sales_year, month(order_date)::int AS sales_month,
                   sum(sales_amount)::decimal(38,2) AS monthly_sales
            FROM sales JOIN top USING (customer_id) JOIN dim ON {product} = dim.product_id
            GROUP BY ALL),
        compared AS (
            SELECT *, lag(monthly_sales) OVER (PARTITION BY customer_id, product_id, sales_month
                                               ORDER BY sales_year) AS prev_year_sales
            FROM monthly)
        SELECT *, {_growth("monthly_sales", "prev_year_sales")} AS yoy_growth_percent
        FROM compared"""


def _quality_row(name: str, key: str) -> str:
    return f"""
        SELECT '{name}' AS table_name, '{key}' AS key_column, count(*) AS row_count,
               count(*) FILTER ({key} IS NULL) AS null_keys,
               count(*) > 0 AND count(*) FILTER ({key} IS NULL) = 0 AS passed
        FROM {name}"""


def _sums(output: str, query: str, key: str, amount: str | None) -> str:
    amount = f"sum({amount})" if amount else "NULL"
    return f"""
        SELECT '{output}' AS output, count(*) AS row_count,
               sum({key})::decimal(38,0) AS key_sum, {amount}::decimal(38,2) AS amount_sum
        FROM ({query})"""


_BEST = """SELECT customer_id FROM all_sales GROUP BY customer_id
           ORDER BY sum(sales_amount) DESC, customer_id LIMIT 5"""

# The seven reports over current and stored sales, as far as their sums need them.
_REPORTS = [
    (
        "peak_sales_months",
        """SELECT strftime(order_date, '%Y-%m') AS year_month, sum(sales_amount) AS amount
           FROM all_sales GROUP BY 1""",
        "length(year_month)",
        "amount",
    ),
    (
        "top_customers",
        f"""SELECT customer_id, order_year, order_month, product_id, count(*) AS lines,
                   sum(sales_amount) AS amount
            FROM all_sales WHERE customer_id IN ({_BEST}) GROUP BY ALL""",
        "product_id * lines",
        "amount",
    ),
    (
        "customer_purchase_trend",
        """SELECT customer_id, order_year, order_month, count(DISTINCT order_id) AS orders,
                  sum(sales_amount) AS amount
           FROM all_sales GROUP BY ALL""",
        "customer_id * orders",
        "amount",
    ),
    (
        "retention_rate_pct",
        """SELECT now.order_year, count(DISTINCT before.customer_id) AS retained
           FROM all_sales now LEFT JOIN (SELECT DISTINCT customer_id, order_year FROM all_sales)
             before ON now.customer_id = before.customer_id
                   AND now.order_year = before.order_year + 1
           GROUP BY 1""",
        "retained",
        None,
    ),
    (
        "month_over_month_growth_pct",
        """SELECT product_id, order_year, order_month, sum(quantity) AS quantity,
                  sum(sales_amount) AS amount
           FROM all_sales GROUP BY ALL""",
        "product_id * quantity",
        "amount",
    ),
    (
        "yoy_comparison",
        f"""SELECT customer_id, product_id, order_year, order_month, sum(sales_amount) AS amount
            FROM all_sales WHERE customer_id IN ({_BEST}) GROUP BY ALL""",
        "product_id * order_month",
        "amount",
    ),
    (
        "customer_segmented",
        f"""SELECT customer_id, count(order_id) AS lines, sum(sales_amount) AS amount
            FROM sales WHERE order_date >= DATE '{HISTORY_END}' GROUP BY 1""",
        "customer_id * lines",
        "amount",
    ),
]

_PER_ORDER = ["customer_purchase_trend", "customer_segmented"]

_PUBLISHED = [
    ("customers", "SELECT * FROM cleaned_customers", "customer_id", None),
    ("orders", "SELECT * FROM cleaned_orders", "order_id", "total_amount"),
    (
        "order_items",
        "SELECT l_orderkey, l_extendedprice::decimal(10,2) AS price FROM lineitem",
        "l_orderkey",
        "price",
    ),
    ("products", "SELECT * FROM part", "p_partkey", None),
    ("loginhistory", "SELECT * FROM logins", "customer_id", None),
    ("usage_history", "SELECT * FROM events", "user_id", None),
    ("customersupport", "SELECT * FROM tickets", '"TicketID"', None),
    ("enterprisecampaigns", "SELECT * FROM events", "user_id", None),
    ("historical_customer_sales", "SELECT * FROM history", "order_id", "sales_amount"),
]

_RANKED_2024 = """
        SELECT 1 FROM (
            SELECT rank() OVER (PARTITION BY country ORDER BY spent DESC) AS place
            FROM (SELECT customer_id, sum(total_amount) AS spent FROM shifted_orders
                  WHERE order_date >= DATE '2024-01-31' - 365 GROUP BY 1)
            JOIN shop_customers USING (customer_id)
            WHERE country LIKE 'NATION_1%')
        WHERE place <= 10"""


def _run_row(job: str, query: str) -> str:
    return f"""
        SELECT '{job}' AS job_name, 'SUCCESS' AS status, count(*) AS record_count
        FROM ({query})"""


ORACLE: dict[str, str] = {
    "top_customers_by_country": _with(
        "shop_customers shop_orders spending ranked",
        """SELECT country, customer_id, first_name || ' ' || last_name AS full_name, email,
                  total_spent, total_orders, last_purchase_date, spending_rank
           FROM ranked WHERE spending_rank <= 10""",
    ),
    "top_customers_by_month_folders": _with(
        "shop_customers shop_orders spending ranked",
        """SELECT country, customer_id, first_name || ' ' || last_name AS full_name, email,
                  total_spent, total_orders, last_purchase_date, spending_rank
           FROM ranked WHERE spending_rank <= 10""",
    ),
    "customer_ranks": _with(
        "shop_customers shop_orders",
        """SELECT country, customer_id, total_spent,
                  rank() OVER (PARTITION BY country ORDER BY total_spent DESC)::int
                      AS spending_rank
           FROM (SELECT customer_id, sum(total_amount)::decimal(20,2) AS total_spent
                 FROM shop_orders WHERE order_date >= DATE '2001-08-01' - 3650 GROUP BY 1)
           JOIN shop_customers USING (customer_id)""",
    ),
    "top_customers_all_columns": _with(
        "shop_customers shop_orders spending ranked",
        "SELECT * FROM ranked WHERE spending_rank <= 10",
    ),
    "churn_risk": _with("shop_orders", _churn("shop_orders", "2001-08-02")),
    "high_risk_customers": _with("shop_orders shifted_orders logins", _HIGH_RISK),
    "clean_customers": _with(
        "dirty_customers cleaned_customers", "SELECT * FROM cleaned_customers"
    ),
    "clean_orders": _with(
        "dirty_customers cleaned_customers shop_orders dirty_orders cleaned_orders",
        "SELECT * FROM cleaned_orders",
    ),
    "campaign_interactions": _with("keyed_events interactions", "SELECT * FROM interactions"),
    "support_tickets": _with("keyed_events tickets", "SELECT * FROM tickets"),
    "omni_channel_engagement": _with(
        _PROFILE_TABLES,
        _PROFILE.format(columns=", ".join(f"coalesce({m}, 0) AS {m}" for m in _MEASURES)),
    ),
    "omni_channel_engagement_nulls": _with(
        _PROFILE_TABLES, _PROFILE.format(columns=", ".join(_MEASURES))
    ),
    "omni_channel_engagement_text_ids": _with(
        _PROFILE_TABLES + " named_interactions named_orders named_tickets",
        _PROFILE.replace("FROM interactions", "FROM named_interactions")
        .replace("FROM shifted_orders", "FROM named_orders")
        .replace("FROM tickets", "FROM named_tickets")
        .format(columns=", ".join(f"coalesce({m}, 0) AS {m}" for m in _MEASURES)),
    ),
    "sales_fact": _with("shop_orders sales", "SELECT * FROM sales"),
    "sales_by_order": _with(
        "shop_orders sales",
        """SELECT order_id, customer_id, order_year, order_month, max(order_date) AS order_date,
                  sum(quantity)::bigint AS quantity,
                  sum(sales_amount)::decimal(21,2) AS sales_amount,
                  count(*) AS lines, count(sales_amount) AS amounts
           FROM sales GROUP BY order_id, customer_id, order_year, order_month""",
    ),
    "sales_with_history": _with(
        "shop_orders sales history all_sales", "SELECT * FROM all_sales"
    ),
    "rejected_values": _with(
        "shop_orders sales history",
        """SELECT 'customer_id' AS column_name,
                  count(*) FILTER (order_id % 31 = 5) AS rejected FROM history
           UNION ALL
           SELECT 'order_date', 0
           UNION ALL
           SELECT 'quantity', count(*) FILTER (order_id % 41 = 7 AND quantity > 1) FROM history
           UNION ALL
           SELECT 'sales_amount', count(*) FILTER (order_id % 29 = 4) FROM history""",
    ),
    "peak_sales_months": _with(
        "shop_orders sales",
        """SELECT strftime(order_date, '%Y-%m') AS year_month,
                  sum(sales_amount)::decimal(31,2) AS monthly_product_sales
           FROM sales GROUP BY 1""",
    ),
    "top_customer_monthly_products": _with(
        "shop_orders sales products",
        f"""SELECT customer_id, strftime(order_date, '%Y-%m') AS year_month, product_id,
                   count(product_id) AS product_count, name AS product_name, category,
                   sum(sales_amount) AS monthly_sales
            FROM sales JOIN products USING (product_id)
            WHERE customer_id IN {_TOP_5} GROUP BY ALL""",
    ),
    "customer_purchase_trend": _with(
        "shop_orders sales",
        f""", monthly AS (
                SELECT customer_id, order_year, order_month,
                       count(DISTINCT order_id) AS orders_per_month,
                       sum(sales_amount)::decimal(31,2) AS monthly_spent,
                       sum(sales_amount)::double / count(sales_amount)::double AS avg_order_value
                FROM sales GROUP BY ALL),
            grown AS (
                SELECT *, lag(monthly_spent) OVER (PARTITION BY customer_id
                                                   ORDER BY order_year, order_month)
                          AS previous_month_spent
                FROM monthly)
            SELECT *, {_growth("monthly_spent", "previous_month_spent")} AS spending_growth_pct
            FROM grown""",
    ),
    "retention_rate": _with(
        "shop_orders sales",
        """, active AS (SELECT DISTINCT customer_id, order_year FROM sales)
           SELECT now.order_year AS current_year,
                  count(DISTINCT now.customer_id) AS total_customers_current_year,
                  count(DISTINCT before.customer_id) AS retained_customers,
                  round(100.0::double * count(DISTINCT before.customer_id)
                        / count(DISTINCT now.customer_id), 2) AS retention_rate_pct
           FROM active now LEFT JOIN active before
             ON now.customer_id = before.customer_id AND now.order_year = before.order_year + 1
           GROUP BY now.order_year""",
    ),
    "product_mom_growth": _with(
        "shop_orders sales products",
        f""", monthly AS (
                SELECT order_year, order_month, product_id,
                       sum(quantity)::bigint AS total_quantity_sold,
                       sum(sales_amount)::decimal(31,2) AS total_sales_amount
                FROM sales GROUP BY ALL),
            grown AS (
                SELECT *, lag(total_sales_amount) OVER (PARTITION BY product_id
                                                        ORDER BY order_year, order_month)
                          AS previous_month_sales
                FROM monthly)
            SELECT grown.*, name AS product_name, category,
                   {_growth("total_sales_amount", "previous_month_sales")}
                       AS month_over_month_growth_pct
            FROM grown JOIN products USING (product_id)""",
    ),
    "yoy_comparison": _with(
        "shop_orders sales", _yoy("sales.product_id", SHAPED["products"], 5)
    ),
    "yoy_comparison_by_family": _with(
        "shop_orders sales",
        _yoy(
            f"sales.product_id % {FAMILIES}",
            f"""SELECT p_partkey % {FAMILIES} AS product_id, min(p_name) AS name,
                       min(p_type) AS category FROM part GROUP BY 1""",
            50,
        ),
    ),
    "customer_segments": _with(
        "shop_orders sales",
        """SELECT customer_id, count(order_id) AS purchase_count,
                  sum(sales_amount)::decimal(31,2) AS total_spent,
                  max(order_date) AS last_order_date,
                  CASE WHEN count(order_id) >= 10 AND sum(sales_amount) >= 1000
                       THEN 'High-Value Customer'
                       WHEN count(order_id) >= 5 AND sum(sales_amount) >= 500
                       THEN 'Regular Customer'
                       ELSE 'Occasional Buyer' END AS customer_segment
           FROM sales GROUP BY customer_id""",
    ),
    "data_quality_report": _with(
        "dirty_customers shop_orders dirty_orders",
        "\nUNION ALL\n".join(
            _quality_row(name, key)
            for name, key in [
                *TABLE_KEYS.items(),
                ("dirty_customers", "customer_id"),
                ("dirty_orders", "order_id"),
            ]
        ),
    ),
    "quarantined_values": _with(
        "shop_orders sales history stored_text",
        """SELECT customer_id, sales_amount, order_date, quantity, f.* FROM (
               SELECT *, unnest([
                   CASE WHEN customer_id LIKE 'C%' THEN {'column_name': 'customer_id',
                        'value': customer_id, 'reason': 'not a bigint'} END,
                   CASE WHEN sales_amount LIKE '%,%' THEN {'column_name': 'sales_amount',
                        'value': sales_amount, 'reason': 'not a decimal(21,2)'} END,
                   CASE WHEN quantity > 2147483647 THEN {'column_name': 'quantity',
                        'value': quantity::varchar, 'reason': 'out of the range of int'} END
               ]) AS f FROM stored_text)
           WHERE f IS NOT NULL""",
    ),
    "publish_after_failure": _with(
        "shop_orders",
        "\nUNION ALL\n".join(
            f"SELECT '{step}' AS step, * FROM ("
            + _sums("orders", f"SELECT * FROM shop_orders WHERE {kept}", "order_id", "total_amount")
            + ")"
            for step, kept in [
                ("first", "true"),
                ("failed", "true"),
                ("next", f"order_date >= DATE '{HISTORY_END}'"),
            ]
        ),
    ),
    "csv_round_trip": _with(
        "shop_orders", "SELECT columns(*)::varchar FROM shop_orders"
    ),
    "csv_malformed_lines": _with(
        "shop_orders",
        """SELECT concat_ws(',', CASE WHEN order_id % 97 = 3 THEN 'no number'
                                    ELSE order_id::varchar END,
                            CASE WHEN order_id % 89 <> 4 THEN customer_id::varchar END,
                            total_amount::varchar,
                            CASE WHEN order_id % 83 = 5 THEN 'spare' END) AS line
           FROM shop_orders
           WHERE order_id % 97 = 3 OR (order_id % 89 = 4) <> (order_id % 83 = 5)
              OR (order_id % 89 = 4 AND order_id % 83 = 5)""",
    ),
    "publish_passthrough": _with(
        "dirty_customers cleaned_customers shop_orders dirty_orders cleaned_orders "
        "sales history logins keyed_events tickets",
        "\nUNION ALL\n".join(_sums(*item) for item in _PUBLISHED),
    ),
    "sales_reports": _with(
        "shop_orders sales history all_sales",
        "\nUNION ALL\n".join(_sums(*item) for item in _REPORTS),
    ),
    "sales_months": _with(
        "shop_orders sales history all_sales",
        "\nUNION ALL\n".join(
            [
                *(_sums(*item) for item in _REPORTS if item[0] not in _PER_ORDER),
                f"""SELECT 'refreshed', count(DISTINCT date_trunc('month', order_date)), NULL, NULL
                    FROM sales WHERE order_date >= DATE '{LATE_MONTHS}'""",
            ]
        ),
    ),
    "audit_log": _with(
        "shop_customers shop_orders shifted_orders logins keyed_events interactions tickets",
        "\nUNION ALL\n".join(
            [
                _run_row("churn_risk", _churn("shifted_orders", "2024-01-31")),
                _run_row("high_risk_customers", _HIGH_RISK),
                _run_row("top_customers_by_country", _RANKED_2024),
                _run_row(
                    "omni_channel_engagement", _PROFILE.format(columns=", ".join(_MEASURES))
                ),
            ]
        ),
    ),
}

# The same reports over current and stored sales.
_BOTH = _with("sales history all_sales", "")
for _report in ("customer_purchase_trend", "product_mom_growth", "yoy_comparison"):
    _start, _end = ORACLE[_report].split(SHAPED["sales"])
    ORACLE[f"{_report}_all_sales"] = (
        _start
        + _BOTH.removeprefix("WITH sales AS (").rstrip().removesuffix(")")
        + _end.replace("FROM sales", "FROM all_sales").replace("sales.product_id", "all_sales.product_id")
    )
