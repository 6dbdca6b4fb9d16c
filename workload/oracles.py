"""For each query, the same answer in SQL over the given tables."""

from __future__ import annotations

CUSTOMERS = """
customers AS (
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
         lower(c_name) || '@example.com' AS customer_email, c_mktsegment AS audit_id,
         TIMESTAMP '1995-01-01' + to_days(CAST(c_nationkey * 90 AS INTEGER)) AS _ingested_at
  FROM customer)"""

TRANSACTIONS = """
lines AS (
  SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS qtty,
         max(CAST(l_extendedprice AS DECIMAL(18,2))) AS price
  FROM lineitem GROUP BY l_orderkey),
transactions AS (
  SELECT 'T' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS transaction_id,
         'C' || CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(o_orderdate AS DATE) AS transaction_date,
         CAST(o_totalprice AS DECIMAL(18,2)) AS transaction_amount,
         CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'P' THEN 'pending'
                            WHEN 'O' THEN 'rejected' END AS transaction_status,
         CASE WHEN o_orderkey % 2 = 0 THEN 'buy' ELSE 'sell' END AS transaction_type,
         qtty, price, o_orderdate AS _ingested_at, o_orderpriority AS audit_id
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey)"""

VERSIONS = """
versions AS (
  SELECT 'T' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS transaction_id,
         'C' || CAST(l_suppkey AS VARCHAR) AS customer_id,
         CAST(l_shipdate AS DATE) AS transaction_date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS transaction_amount,
         CASE l_returnflag WHEN 'A' THEN 'approved' WHEN 'R' THEN 'rejected'
                           ELSE 'pending' END AS transaction_status,
         CASE WHEN l_linestatus = 'F' THEN 'buy' ELSE 'sell' END AS transaction_type,
         CAST(l_quantity AS DECIMAL(18,2)) AS qtty,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         l_shipdate AS _ingested_at, l_returnflag AS audit_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
           l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS place
  FROM lineitem),
newest AS (SELECT * FROM versions WHERE place = 1)"""

MESSAGES = """
messages AS (
  SELECT *, 'entity=' || entity || '/user=' || CAST(user_id AS VARCHAR) || '/events.csv'
            AS source_path
  FROM (SELECT CAST(event_id AS VARCHAR) AS message_id, ts AS publish_time, user_id, event_type,
               props, '[' || props || ']' AS data,
               CASE WHEN event_type IN ('signup', 'error') THEN 'customers'
                    ELSE 'transactions' END AS entity
        FROM events) AS e)"""

_SUMS = """
  count(*) AS total,
  count(*) FILTER (transaction_status = 'approved') AS total_approved,
  count(*) FILTER (transaction_status = 'pending') AS total_pending,
  count(*) FILTER (transaction_status = 'rejected') AS total_rejected,
  CAST(sum(transaction_amount) AS DOUBLE) AS amount_total,
  CAST(sum(CASE WHEN transaction_status = 'approved' THEN transaction_amount ELSE 0 END)
       AS DOUBLE) AS amount_approved,
  CAST(sum(CASE WHEN transaction_status = 'pending' THEN transaction_amount ELSE 0 END)
       AS DOUBLE) AS amount_pending,
  CAST(sum(CASE WHEN transaction_status = 'rejected' THEN transaction_amount ELSE 0 END)
       AS DOUBLE) AS amount_rejected"""

_BUYS = """
later AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY transaction_date NULLS FIRST,
                                 transaction_id NULLS FIRST) AS place
    FROM transactions) AS numbered
  WHERE place > 1 AND transaction_status = 'approved' AND transaction_type = 'buy'),
buys AS (
  SELECT transaction_date, transaction_id, qtty, price, qtty * price AS total_cost,
    CAST(sum(qtty * price) OVER so_far AS DOUBLE)
      / nullif(CAST(sum(qtty) OVER so_far AS DOUBLE), 0) AS running_avg_price
  FROM later
  WINDOW so_far AS (ORDER BY transaction_date NULLS FIRST, transaction_id NULLS FIRST))"""

_DAILY = """
days AS (
  SELECT transaction_date, CAST(sum(qtty) AS DOUBLE) AS buy_qtty,
    CAST(sum(total_cost) AS DOUBLE) / nullif(CAST(sum(qtty) AS DOUBLE), 0) AS daily_avg_price,
    max(running_avg_price) AS highest
  FROM buys GROUP BY transaction_date),
daily AS (
  SELECT transaction_date, buy_qtty, daily_avg_price,
    last_value(highest IGNORE NULLS) OVER (ORDER BY transaction_date NULLS FIRST)
      AS running_avg_price,
    row_number() OVER (ORDER BY transaction_date DESC NULLS LAST) AS ranking
  FROM days)"""


def _with(*parts: str, body: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body


def _named(source: str) -> str:
    """An enriched relation, as the gold job builds it."""
    return f"""
    SELECT t.transaction_id, t.customer_id, c.customer_name, c.customer_email,
           t.transaction_date, t.transaction_amount, t.transaction_status, t.transaction_type,
           t.qtty, t.price, t._ingested_at, t.audit_id AS audit_id_transactions,
           c.audit_id AS audit_id_customers
    FROM {source} AS t LEFT JOIN customers AS c ON c.customer_id = t.customer_id"""


def _merged(target: str, source: str, key: str, columns: list[str]) -> str:
    """The target after the upsert, as a full join that prefers strictly newer versions."""
    take = f"(t.{key} IS NULL OR s._ingested_at > t._ingested_at)"
    picked = ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in columns)
    return f"SELECT {picked} FROM {target} AS t FULL JOIN {source} AS s ON s.{key} = t.{key}"


_MONEY = ("transaction_amount", "qtty", "price")


def _as_double(columns: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _MONEY else c for c in columns)


_TX = ["transaction_id", "customer_id", "transaction_date", "transaction_amount",
       "transaction_status", "transaction_type", "qtty", "price"]
_GOLD = ["transaction_id", "customer_id", "customer_name", "transaction_date",
         "transaction_amount", "transaction_status", "transaction_type", "qtty", "price",
         "_ingested_at", "audit_id_transactions", "audit_id_customers"]

_INCREMENT = """
SELECT message_id, entity, source_path, 'audit-' || message_id AS audit_id,
       'events.csv' AS source_file, publish_time, data
FROM messages
WHERE entity = 'customers' AND publish_time > (
  SELECT coalesce(max(publish_time), TIMESTAMP '1970-01-01')
  FROM messages
  WHERE entity = 'customers' AND publish_time <= TIMESTAMP '2024-01-20 12:00:00'
    AND publish_time >= TIMESTAMP '{now}' - INTERVAL 7 DAY)"""

_PAGES = """
SELECT page_id, url, CAST(length(html) AS INTEGER) AS characters, md5(html) AS html_md5
FROM pages"""

_SILVER = _with(TRANSACTIONS, body=f"SELECT {_as_double(_TX)} FROM transactions")

ORACLES: dict[str, str] = {
    "monthly_ttm": _with(TRANSACTIONS, f"""
monthly AS (
  SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, {_SUMS},
    CAST(count(*) FILTER (transaction_status = 'rejected') AS DOUBLE) / count(*)
      AS rate_rejected_total,
    CAST(sum(CASE WHEN transaction_status = 'rejected' THEN transaction_amount ELSE 0 END)
         AS DOUBLE) / nullif(CAST(sum(transaction_amount) AS DOUBLE), 0) AS rate_rejected_amount
  FROM transactions GROUP BY 1),
ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY month DESC NULLS LAST) AS latest FROM monthly)""",
                         body="SELECT * EXCLUDE (latest) FROM ranked WHERE latest <= 12"),

    "customers_last_quarter": _with(CUSTOMERS, TRANSACTIONS, f"gold AS ({_named('transactions')})",
                                    body=f"""
SELECT customer_name, {_SUMS}
FROM gold
WHERE date_trunc('quarter', transaction_date) =
  (SELECT max(date_trunc('quarter', transaction_date)) FROM gold)
GROUP BY customer_name"""),

    "first_transactions": _with(TRANSACTIONS, body="""
SELECT customer_id, transaction_date, transaction_id,
       transaction_status = 'approved' AND transaction_type = 'buy' AS is_buy
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY transaction_date NULLS FIRST, transaction_id NULLS FIRST) AS place
      FROM transactions) AS numbered
WHERE place = 1"""),

    "later_buys": _with(TRANSACTIONS, _BUYS, body="""
SELECT transaction_date, transaction_id, CAST(qtty AS DOUBLE) AS qtty,
       CAST(price AS DOUBLE) AS price, count(*) AS copies
FROM buys GROUP BY ALL"""),

    "running_avg_price": _with(TRANSACTIONS, _BUYS, body="""
SELECT transaction_date, transaction_id, CAST(qtty AS DOUBLE) AS qtty,
       CAST(total_cost AS DOUBLE) AS total_cost, running_avg_price
FROM buys"""),

    "daily_avg_price": _with(TRANSACTIONS, _BUYS, _DAILY, body="SELECT * FROM daily"),

    "current_avg_price": _with(TRANSACTIONS, _BUYS, _DAILY,
                               body="SELECT * FROM daily WHERE ranking = 1"),

    "normalize_ids": """
SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS customer_id,
       'C' || CAST(c_custkey AS VARCHAR) AS normalized,
       'C' || CAST(c_custkey AS VARCHAR) AS normalized_in_sql,
       c_name IS NULL OR try_cast(substr(c_name, 2) AS BIGINT) IS NOT NULL AS name_would_do
FROM customer""",

    "safe_casts": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CAST(l_shipdate AS DATE) AS day,
       CAST(NULL AS DATE) AS year_only,
       try_cast(strftime(l_shipdate, '%Y-%m-') || '31' AS DATE) AS day_31,
       CAST(NULL AS DATE) AS flag_as_day,
       l_extendedprice AS number,
       CAST(NULL AS DOUBLE) AS suffixed,
       CAST(NULL AS DOUBLE) AS decimal_comma,
       date_trunc('day', l_shipdate) + INTERVAL '12 hours 30 minutes 123456 microseconds'
         AS instant,
       CAST(NULL AS TIMESTAMP) AS year_as_instant,
       CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag
FROM lineitem""",

    "extract_records": _with(MESSAGES, body="""
SELECT message_id, entity, source_path, props ->> '$.k' AS k, CAST(NULL AS VARCHAR) AS missing
FROM messages WHERE entity = 'transactions'"""),

    "extract_foreign_records": _with(MESSAGES, body="""
SELECT message_id, CAST(NULL AS VARCHAR) AS "outer", event_type AS kind FROM messages"""),

    "clean_records": _with(TRANSACTIONS, body=f"""
SELECT {_as_double(_TX)}, audit_id, transaction_id AS message_id FROM transactions"""),

    "latest_per_path": _with(MESSAGES, body="""
SELECT source_path, message_id, data, publish_time AS ingested_at
FROM (SELECT *, row_number() OVER (PARTITION BY source_path
                                   ORDER BY publish_time DESC, message_id DESC) AS place
      FROM messages WHERE entity = 'customers') AS m
WHERE place = 1"""),

    "incremental_events": _with(MESSAGES, body=_INCREMENT.format(now="2024-01-21 00:00:00")),
    "incremental_after_idle": _with(MESSAGES, body=_INCREMENT.format(now="2024-03-01 00:00:00")),

    "gold_enrich": _with(CUSTOMERS, TRANSACTIONS, f"gold AS ({_named('transactions')})", body=f"""
SELECT {_as_double([*_GOLD[:3], "customer_email", *_GOLD[3:]])} FROM gold"""),

    "gold_increment": _with(
        CUSTOMERS, TRANSACTIONS, f"gold AS ({_named('transactions')})", body="""
SELECT transaction_id, customer_id, customer_name, transaction_date, audit_id_transactions,
       audit_id_customers
FROM gold
WHERE _ingested_at > (
  SELECT coalesce(max(_ingested_at), TIMESTAMP '1970-01-01') FROM gold
  WHERE _ingested_at <= TIMESTAMP '1998-07-01'
    AND _ingested_at >= TIMESTAMP '1998-07-01' - INTERVAL 7 DAY)"""),

    "upsert_customers": _with(CUSTOMERS, """
changes AS (
  SELECT * FROM (
    SELECT 'C' || CAST(o_custkey AS VARCHAR) AS customer_id, o_orderpriority AS customer_name,
           'order' || CAST(o_orderkey AS VARCHAR) AS customer_email,
           o_orderdate AS _ingested_at,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)
             AS place
    FROM orders) AS o
  WHERE place = 1)""", body=_merged(
        "customers", "changes", "customer_id",
        ["customer_id", "customer_name", "customer_email", "_ingested_at"])),

    "upsert_transactions": _with(
        TRANSACTIONS, VERSIONS,
        "merged AS ("
        + _merged("transactions", "newest", "transaction_id", [*_TX, "_ingested_at"]) + ")",
        body=f"SELECT {_as_double([*_TX, '_ingested_at'])} FROM merged"),

    "upsert_gold": _with(
        CUSTOMERS, TRANSACTIONS, VERSIONS,
        f"target AS ({_named('transactions')})", f"source AS ({_named('newest')})",
        f"merged AS ({_merged('target', 'source', 'transaction_id', _GOLD)})",
        body=f"SELECT {_as_double(_GOLD)} FROM merged"),

    "consolidate": _with(TRANSACTIONS, body=f"""
SELECT {_as_double(_TX)} FROM transactions WHERE qtty IS NOT NULL
ORDER BY transaction_status, customer_id, transaction_id"""),

    "ingest_report": """
SELECT o_orderpriority AS audit_id, 'transactions' AS entity,
       'entity=transactions/' || o_orderpriority || '.csv' AS source_path, count(*) AS records
FROM orders GROUP BY o_orderpriority""",

    "discover_fields": _with(TRANSACTIONS, body="\nUNION ALL\n".join(
        f"SELECT 'transactions' AS entity, '{f}' AS field, count({f}) AS records "
        f"FROM transactions" for f in _TX)),

    "audit_trace": _with(CUSTOMERS, TRANSACTIONS, f"gold AS ({_named('transactions')})", body="""
SELECT audit_id, 'landing_events' AS layer, count(*) AS rows FROM transactions GROUP BY 1
UNION ALL
SELECT audit_id, 'silver_customers', count(*) FROM customers GROUP BY 1
UNION ALL
SELECT audit_id, 'silver_transactions', count(*) FROM transactions GROUP BY 1
UNION ALL
SELECT audit_id_transactions, 'gold_transactions', count(*) FROM gold
WHERE audit_id_transactions IS NOT NULL GROUP BY 1
UNION ALL
SELECT audit_id_customers, 'gold_transactions_by_customer', count(*) FROM gold
WHERE audit_id_customers IS NOT NULL GROUP BY 1"""),

    "late_events": _with(MESSAGES, body="""
SELECT message_id, 'audit-' || message_id AS audit_id, entity, source_path, publish_time
FROM messages
WHERE entity = 'customers' AND event_type = 'error' AND publish_time <= (
  SELECT max(publish_time) FROM messages
  WHERE entity = 'customers' AND publish_time <= TIMESTAMP '2024-01-20 12:00:00')"""),

    "land_files": _with(TRANSACTIONS, body="""
SELECT 'transactions' AS entity, transaction_id, customer_id,
       CAST(transaction_date AS VARCHAR) AS transaction_date,
       CAST(transaction_amount AS VARCHAR) AS transaction_amount,
       CAST(NULL AS VARCHAR) AS customer_name, CAST(NULL AS VARCHAR) AS customer_email,
       'entity=transactions/year=2026/month=03/day=25/' AS folder
FROM transactions
UNION ALL
SELECT 'customers', NULL, 'C' || lpad(CAST(c_custkey AS VARCHAR), 6, '0'), NULL, NULL,
       c_name, lower(c_name) || '@example.com',
       'entity=customers/year=2026/month=03/day=25/'
FROM customer"""),

    "land_quoted_text": _PAGES,
    "land_large_files": _PAGES,

    "ingest_rejects": """
SELECT 'entity=' || o_orderstatus AS folder, 'unknown entity' AS error,
       count(DISTINCT date_trunc('month', o_orderdate)) AS files,
       count(DISTINCT date_trunc('month', o_orderdate)) AS reports
FROM orders GROUP BY o_orderstatus""",

    "quarantine": """
SELECT DISTINCT c_mktsegment AS segment, CAST(c_nationkey AS INTEGER) AS nation,
       'UnicodeDecodeError' AS error, CAST(1 AS INTEGER) AS attempts
FROM customer""",

    "retry_quarantine": """
SELECT DISTINCT c_mktsegment AS segment, CAST(c_nationkey AS INTEGER) AS nation,
       'UnicodeDecodeError' AS error, CAST(3 AS INTEGER) AS attempts
FROM customer""",

    "medallion_run": _with(
        CUSTOMERS, TRANSACTIONS, f"gold AS ({_named('transactions')})", body=f"""
SELECT {_as_double(["transaction_id", "customer_id", "customer_name", "customer_email", *_TX[2:]])}
FROM gold"""),

    "rebuild": _SILVER,

    "refresh_gold_full": _with(
        CUSTOMERS, TRANSACTIONS, f"gold AS ({_named('transactions')})", body="""
SELECT transaction_id, customer_id, CAST(NULL AS VARCHAR) AS name_before, customer_name
FROM gold"""),

    "gold_table_scan": _with(
        CUSTOMERS, TRANSACTIONS, f"gold AS ({_named('transactions')})", body="""
SELECT transaction_id, customer_id, customer_name,
       CAST(transaction_amount AS DOUBLE) AS transaction_amount,
       CAST(date_trunc('quarter', _ingested_at) AS DATE) AS _ingested_date
FROM gold WHERE transaction_status = 'approved' AND transaction_type = 'buy'"""),
}


def _thousandths(query: str, columns: list[str]) -> str:
    cut = ", ".join(f"CAST(floor({c} * 1000 + 0.123456789) AS BIGINT) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({cut}) FROM ({ORACLES[query]}) AS answer"


_AMOUNTS = ["amount_total", "amount_approved", "amount_pending", "amount_rejected"]
ORACLES |= {
    "gold_views": _thousandths(
        "monthly_ttm", [*_AMOUNTS, "rate_rejected_total", "rate_rejected_amount"]),
    "gold_view_last_quarter": _thousandths("customers_last_quarter", _AMOUNTS),
    "gold_view_daily": _thousandths(
        "daily_avg_price", ["buy_qtty", "daily_avg_price", "running_avg_price"]),
    "merge_customers": ORACLES["upsert_customers"],
    "extract_odd_payloads": """
SELECT doc_id AS message, foreign_ AS "foreign", CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS text_md5
FROM documents, (VALUES (TRUE), (FALSE)) AS kinds(foreign_)
UNION ALL
SELECT doc_id, foreign_, NULL, NULL
FROM documents, (VALUES (TRUE), (FALSE)) AS kinds(foreign_)""",
    "land_audit": """
SELECT 'customers' AS entity, CAST(count(*) AS BIGINT) AS records,
       CAST(count(*) AS BIGINT) AS "rows", TRUE AS well_formed FROM customer
UNION ALL
SELECT 'transactions', CAST(count(*) AS BIGINT), CAST(count(*) AS BIGINT), TRUE FROM orders""",
}

_QUARTERLY = TRANSACTIONS.replace(
    "o_orderdate AS _ingested_at",
    "CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS _ingested_at")
_QUARTERLY_VERSIONS = VERSIONS.replace(
    "l_shipdate AS _ingested_at",
    "CAST(date_trunc('quarter', l_shipdate) AS TIMESTAMP) AS _ingested_at").replace(
    "ORDER BY l_shipdate DESC", "ORDER BY date_trunc('quarter', l_shipdate) DESC")
_SUPPLIERS = """
SELECT CASE WHEN s_suppkey % 2 = 1 THEN 'X' || CAST(s_suppkey AS VARCHAR) END,
       'C' || CAST(s_suppkey AS VARCHAR), NULL, CAST(s_acctbal AS DOUBLE), 'pending', 'buy', 1.0, NULL,
       TIMESTAMP '1997-01-01'
FROM supplier"""
_LATE = "audit_id = '1-URGENT' AND transaction_date < DATE '1998-06-01'"
_YEARS = "year(transaction_date) <> 1996"

ORACLES |= {
    "merge_transactions": _with(
        _QUARTERLY, _QUARTERLY_VERSIONS,
        "merged AS ("
        + _merged("transactions", "newest", "transaction_id", [*_TX, "_ingested_at"]) + ")",
        body=f"SELECT {_as_double([*_TX, '_ingested_at'])} FROM merged UNION ALL {_SUPPLIERS}"),
    "merge_gold": _with(
        CUSTOMERS, _QUARTERLY, _QUARTERLY_VERSIONS,
        f"target AS ({_named('transactions')})", f"source AS ({_named('newest')})",
        f"merged AS ({_merged('target', 'source', 'transaction_id', _GOLD)})",
        body=f"SELECT {_as_double(_GOLD)} FROM merged"),
    "merge_after_cut_off": _with(CUSTOMERS, body=f"""
SELECT 'before' AS seen, customer_id, customer_name, customer_email FROM customers
UNION ALL SELECT 'during', customer_id, customer_name, customer_email FROM customers
UNION ALL SELECT 'after', customer_id, customer_name, customer_email
FROM ({ORACLES['upsert_customers']}) AS merged"""),
    # of the second file, what is of June or later lies above the mark of May and is promoted
    "late_gold_rows": _with(TRANSACTIONS, body=f"""
SELECT transaction_id, customer_id, transaction_date, audit_id FROM transactions WHERE {_LATE}"""),
    "promote_late_rows": ORACLES["medallion_run"],
    "discover_schema": """
SELECT entity, field, type, count(*) AS records,
       CAST(make_timestamp(CAST(min(doc_id) * 1000000 AS BIGINT)) AS TIMESTAMP) AS first_seen,
       'file-' || CAST(min(doc_id) AS VARCHAR) AS first_file
FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'customers' ELSE 'transactions' END AS entity,
             lang, source FROM documents) AS d,
     (VALUES ('number', 'BIGINT'), ('text', 'STRING'), ('fraction', 'DECIMAL'),
             ('nested', 'OBJECT<a: BIGINT, b: STRING>'), ('list', 'ARRAY<BIGINT>'),
             ('flag', 'BOOLEAN'), ('mixed', 'VARIANT')) AS f(field, type)
WHERE NOT (field = 'text' AND lang IS NULL)
GROUP BY entity, field, type""",
    "rebuild_from": _with(TRANSACTIONS, body=f"""
SELECT {_as_double(_TX)} FROM transactions WHERE {_YEARS}"""),
    "catalog_views": f"""
SELECT month, total, total_approved, total_pending, total_rejected
FROM ({ORACLES['monthly_ttm']}) AS answer""",
}
