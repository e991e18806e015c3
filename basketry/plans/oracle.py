"""DuckDB SQL equal to each catalog query, over the same test tables.

The adapters of ``fixtures`` are repeated here as CTEs. Type and rounding
pins so both engines agree: money sums rounded to cents; averages of money
taken as an exact decimal sum divided by the count; integer sums cast to
BIGINT; month starts cast to DATE.
"""

from __future__ import annotations

ADAPTERS = {
    "purchases": """
        SELECT CAST(l_orderkey AS VARCHAR) AS purchase_id, CAST(o_custkey AS VARCHAR) AS client_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INT) AS quantity,
               l_extendedprice AS price, o_orderdate AS "timestamp"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
               p_retailprice AS price, CAST(p_size AS BIGINT) AS available_stock,
               '2024-01-01T00:00:00+00:00' AS updated_at
        FROM part""",
    "clients": """
        SELECT CAST(c_custkey AS VARCHAR) AS client_id, 'Customer' AS first_name, c_name AS last_name,
               'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email, CAST(NULL AS VARCHAR) AS phone,
               n_name AS address, TIMESTAMP '2020-01-01 00:00:00' AS registration_date, 'active' AS status
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_name AS name,
               's' || CAST(s_suppkey AS VARCHAR) || '@example.com' AS contact_email,
               CAST(NULL AS VARCHAR) AS contact_phone, CAST(s_suppkey % 6 AS DECIMAL(3,2)) AS rating,
               TIMESTAMP '2020-01-01 00:00:00' AS joined_date
        FROM supplier""",
    "purchases_rt": """
        SELECT CAST(event_id AS VARCHAR) AS purchase_id, CAST(user_id AS VARCHAR) AS client_id,
               props->>'$.k' AS product_id, CAST(1 + event_id % 5 AS INT) AS quantity, value AS price, ts
        FROM events WHERE event_type = 'purchase'""",
    "products_rt": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
               p_retailprice AS price, CASE WHEN p_size >= 10 THEN p_brand END AS description,
               CAST(p_partkey % 10 AS VARCHAR) AS seller_id
        FROM part""",
    "sellers_rt": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_name AS name,
               's' || CAST(s_suppkey AS VARCHAR) || '@example.com' AS email,
               CAST(NULL AS VARCHAR) AS phone, n_name AS address
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
}


ADAPTERS["listed_products"] = ADAPTERS["products"] + " WHERE p_brand <> 'Brand#25'"


def with_adapters(names: str, body: str, extra: str = "") -> str:
    """``WITH <adapters...>[, extra] <body>``."""
    ctes = [f"{n} AS ({ADAPTERS[n]})" for n in names.split()]
    if extra:
        ctes.append(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + body


SQL: dict[str, str] = {}


def oracle(name: str, names: str, body: str, extra: str = "") -> None:
    SQL[name] = with_adapters(names, body, extra)
