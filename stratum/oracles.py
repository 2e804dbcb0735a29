"""DuckDB SQL equivalents of the registered queries (correctness oracle).

The derived views of ``stratum.sources.fixtures`` are restated here as CTEs
over the pre-registered input tables; every query's SQL includes the views
it needs. Audit timestamps are never part of a compared result.
"""

from __future__ import annotations

# CTE bodies, in dependency order
_VIEWS: dict[str, str] = {
    "transactions_cleansed": """
        SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                         CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS transaction_id,
               strftime(l_shipdate, '%Y%m%d') AS date_key,
               o_custkey AS customer_id, l_partkey AS product_id, l_suppkey AS store_id,
               l_quantity AS quantity, l_extendedprice AS unit_price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "transactions_hot": """
        SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                         CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS transaction_id,
               strftime(l_shipdate, '%Y%m%d') AS date_key,
               CASE WHEN l_orderkey % 3 = 0 THEN CAST(1 AS BIGINT) ELSE o_custkey END AS customer_id,
               CASE WHEN l_orderkey % 3 = 0 THEN CAST(1 AS BIGINT) ELSE l_partkey END AS product_id,
               l_suppkey AS store_id, l_quantity AS quantity, l_extendedprice AS unit_price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "products_conformed": """
        SELECT CASE WHEN p_size <= 45 THEN p_partkey ELSE -p_partkey END AS product_id, p_retailprice AS standard_cost FROM part""",
    "customers_conformed": """
        SELECT c_custkey AS customer_id,
               split_part(c_name, '#', 1) AS first_name,
               CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name,
               CASE WHEN c_custkey % 333 = 1 THEN NULL
                    WHEN c_custkey % 200 = 0 THEN 'bad-' || CAST(c_custkey AS VARCHAR)
                    ELSE 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
               c_mktsegment AS segment,
               CASE WHEN r_name = 'AMERICA' THEN 'NA' WHEN r_name = 'ASIA' THEN 'APAC'
                    WHEN r_name IN ('AFRICA', 'EUROPE', 'MIDDLE EAST') THEN 'EMEA' END AS region,
               c_acctbal > 0 AS is_active
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "customers_spoiled": """
        SELECT customer_id, first_name, last_name,
               CASE WHEN customer_id % 20 = 0 THEN 'c' || CAST(customer_id AS VARCHAR) || '@@example'
                    ELSE email END AS email,
               segment,
               CASE WHEN customer_id % 100 = 0 THEN 'MARS' ELSE region END AS region,
               is_active
        FROM customers_conformed""",
    "customers_dirty": """
        SELECT * FROM customers_spoiled
        UNION ALL SELECT * FROM customers_spoiled WHERE customer_id < 10
        UNION ALL SELECT CAST(NULL AS BIGINT) AS customer_id, first_name, last_name, email, segment, region,
                         is_active
                  FROM customers_spoiled WHERE customer_id = 1""",
    "sales_fact": """
        SELECT t.transaction_id, t.date_key, t.customer_id, t.product_id, t.store_id, t.quantity, t.unit_price,
               round(t.quantity * t.unit_price, 2) AS total_sales_amount,
               round((t.unit_price - p.standard_cost) * t.quantity, 2) AS margin_amount
        FROM transactions_cleansed t
        LEFT JOIN (SELECT customer_id FROM customers_conformed) c ON t.customer_id = c.customer_id
        LEFT JOIN products_conformed p ON t.product_id = p.product_id""",
    "sales_fact_fanned": """
        SELECT t.transaction_id, t.date_key, t.customer_id, t.product_id, t.store_id, t.quantity, t.unit_price,
               round(t.quantity * t.unit_price, 2) AS total_sales_amount,
               round((t.unit_price - p.standard_cost) * t.quantity, 2) AS margin_amount
        FROM transactions_cleansed t
        LEFT JOIN (SELECT customer_id FROM customers_dirty) c ON t.customer_id = c.customer_id
        LEFT JOIN products_conformed p ON t.product_id = p.product_id""",
    "sales_fact_hot": """
        SELECT t.transaction_id, t.date_key, t.customer_id, t.product_id, t.store_id, t.quantity, t.unit_price,
               round(t.quantity * t.unit_price, 2) AS total_sales_amount,
               round((t.unit_price - p.standard_cost) * t.quantity, 2) AS margin_amount
        FROM transactions_hot t
        LEFT JOIN (SELECT customer_id FROM customers_dirty) c ON t.customer_id = c.customer_id
        LEFT JOIN products_conformed p ON t.product_id = p.product_id""",
    "events_bronze": """
        SELECT CAST(event_id AS VARCHAR) AS id, event_type AS name,
               CASE WHEN event_id % 101 = 0 THEN '12x'
                    ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS updated_at, props AS extra
        FROM events
        UNION ALL
        SELECT CAST(event_id AS VARCHAR), event_type,
               CASE WHEN event_id % 101 = 0 THEN '12x'
                    ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), props
        FROM events WHERE event_id % 10 = 0
        UNION ALL
        SELECT CAST(event_id AS VARCHAR), event_type,
               CAST(CAST(value AS DECIMAL(18,2)) + 1 AS VARCHAR),
               strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%f'), props
        FROM events WHERE event_id % 7 = 0""",
    "events_batch_1": """
        SELECT * FROM events_bronze WHERE updated_at < '2024-01-16 00:00:00.000000'""",
    "events_batch_2": """
        SELECT * FROM events_bronze WHERE updated_at >= '2024-01-16 00:00:00.000000'""",
    "orders_initial": """
        SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-07-01 00:00:00'""",
    "orders_changes": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE 'P' END AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'""",
}

_DEPENDS = {
    "customers_spoiled": ["customers_conformed"],
    "customers_dirty": ["customers_spoiled"],
    "sales_fact": ["transactions_cleansed", "customers_conformed", "products_conformed"],
    "sales_fact_fanned": ["transactions_cleansed", "customers_dirty", "products_conformed"],
    "sales_fact_hot": ["transactions_hot", "customers_dirty", "products_conformed"],
    "events_batch_1": ["events_bronze"],
    "events_batch_2": ["events_bronze"],
}


def with_views(body: str, *views: str) -> str:
    """Prefix ``body`` with the CTEs it needs (and theirs), in order."""
    need: set[str] = set()

    def add(v: str) -> None:
        for d in _DEPENDS.get(v, []):
            add(d)
        need.add(v)

    for v in views:
        add(v)
    ctes = [f"{name} AS ({sql}\n)" for name, sql in _VIEWS.items() if name in need]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def contract_sql(source: str, rules: list[tuple], suite: str, asset: str) -> str:
    """Oracle for a contract result: ``rules`` are
    ``(index, type, column, mostly, kind, arg)`` with kind in
    ``not_null | unique | regex | in_set``."""
    parts = []
    for idx, etype, col, mostly, kind, arg in rules:
        head = f"SELECT {idx} AS expectation_index, '{etype}' AS expectation_type, '{col}' AS column_name, " \
               f"CAST({mostly} AS DOUBLE) AS mostly, "
        if kind == "unique":
            parts.append(
                head + f"CAST(coalesce(sum(n), 0) AS BIGINT) AS element_count, "
                f"CAST(coalesce(sum(n) FILTER (WHERE {col} IS NULL), 0) AS BIGINT) AS missing_count, "
                f"CAST(coalesce(sum(n) FILTER (WHERE {col} IS NOT NULL AND n > 1), 0) AS BIGINT) "
                f"AS unexpected_count FROM (SELECT {col}, count(*) AS n FROM {source} GROUP BY {col})"
            )
            continue
        if kind == "table":
            parts.append(head + f"CAST(1 AS BIGINT) AS element_count, CAST(0 AS BIGINT) AS missing_count, "
                         f"CAST(CASE WHEN {arg} THEN 0 ELSE 1 END AS BIGINT) AS unexpected_count FROM {source}")
            continue
        if kind == "compound":
            cols = ", ".join(arg)
            none = " AND ".join(f"{c} IS NULL" for c in arg)
            parts.append(head + f"CAST(sum(n) AS BIGINT) AS element_count, CAST(coalesce(sum(n) FILTER (WHERE {none}), 0) AS BIGINT) AS missing_count, "
                         f"CAST(coalesce(sum(n) FILTER (WHERE NOT ({none}) AND n > 1), 0) AS BIGINT) AS unexpected_count "
                         f"FROM (SELECT {cols}, count(*) AS n FROM {source} GROUP BY {cols})")
            continue
        if kind == "bad":
            bad = f"{col} IS NOT NULL AND {arg}"
        elif kind == "not_null":
            bad = f"{col} IS NULL"
        elif kind == "regex":
            bad = f"{col} IS NOT NULL AND NOT regexp_matches({col}, '{arg}')"
        else:
            values = ", ".join(f"'{v}'" for v in arg)
            bad = f"{col} IS NOT NULL AND {col} NOT IN ({values})"
        parts.append(
            head + f"count(*) AS element_count, count_if({col} IS NULL) AS missing_count, "
            f"count_if({bad}) AS unexpected_count FROM {source}"
        )
    union = "\nUNION ALL\n".join(parts)
    return f"""
SELECT '{asset}' AS asset, '{suite}' AS suite, expectation_index, expectation_type, column_name, mostly,
       element_count, missing_count, unexpected_count,
       CASE WHEN d > 0 THEN CAST(unexpected_count AS DOUBLE) / d * 100 END AS unexpected_percent,
       CASE WHEN d = 0 THEN true ELSE CAST(d - unexpected_count AS DOUBLE) / d >= mostly END AS success
FROM (SELECT *, CASE WHEN expectation_type = 'expect_column_values_to_not_be_null' THEN element_count
                     ELSE element_count - missing_count END AS d
      FROM ({union}))"""
