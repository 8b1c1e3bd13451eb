"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

_LINES = """
lines AS (
  SELECT o.o_custkey AS customer_id, CAST(s.s_nationkey AS BIGINT) AS store_id,
         p.p_name AS product_name, CAST(o.o_orderdate AS DATE) AS sales_date,
         l.l_suppkey AS sales_person_id, CAST(p.p_retailprice AS DECIMAL(12,2)) AS price,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS total_cost,
         o.o_orderpriority AS payment_mode,
         CASE WHEN l.l_returnflag <> 'N' THEN l.l_returnflag END AS return_flag,
         l.l_returnflag AS raw_flag, r.r_name AS region
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
dim_customer AS (
  SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
         n_name AS address, CAST(c_nationkey AS VARCHAR) AS pincode,
         CAST(c_custkey AS VARCHAR) AS phone_number
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
dim_store AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS store_address,
         CAST(n_regionkey AS VARCHAR) AS store_pincode,
         'manager of ' || n_name AS store_manager_name
  FROM nation
),
dim_team AS (
  SELECT s_suppkey AS id, s_name AS sales_person_first_name,
         CAST(s_nationkey AS VARCHAR) AS sales_person_last_name, s_nationkey AS manager_id,
         CASE WHEN s_acctbal < 0 THEN 'Y' ELSE 'N' END AS is_manager,
         'street ' || CAST(s_suppkey AS VARCHAR) AS sales_person_address,
         CAST(s_nationkey AS VARCHAR) AS sales_person_pincode,
         CAST(NULL AS DATE) AS sales_person_joining_date
  FROM supplier
)
"""

_ENRICHED = (
    _LINES
    + """,
enriched AS (
  SELECT f.customer_id, f.store_id, f.sales_date, f.sales_person_id, f.total_cost,
         c.first_name, c.last_name, c.address, c.pincode, c.phone_number,
         s.store_address, s.store_manager_name, t.manager_id, t.is_manager,
         t.sales_person_joining_date, t.sales_person_first_name, t.sales_person_last_name,
         t.sales_person_address, t.sales_person_pincode,
         SUBSTR(CAST(f.sales_date AS VARCHAR), 1, 7) AS month
  FROM lines f
  JOIN dim_customer c ON f.customer_id = c.customer_id
  JOIN dim_store s ON f.store_id = s.id
  JOIN dim_team t ON f.sales_person_id = t.id
)
"""
)

_TOTALS = (
    _ENRICHED
    + """,
totals AS (
  SELECT store_id, sales_person_id,
         sales_person_first_name || ' ' || sales_person_last_name AS full_name,
         month AS sales_month, CAST(SUM(total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM enriched
  GROUP BY 1, 2, 3, 4
),
ranked AS (
  SELECT totals.*, RANK() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC NULLS LAST) AS rnk
  FROM totals
)
"""
)

_CONTRACT = "customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost"
_KEYS = "f.customer_id, f.store_id, f.sales_date, f.sales_person_id, f.total_cost"

_CUSTOMER_MART = f"""WITH {_ENRICHED}
SELECT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
       month AS sales_date_month, CAST(SUM(total_cost) AS DECIMAL(18,2)) AS total_sales
FROM enriched GROUP BY 1, 2, 3, 4, 5"""

_SALES_MART = f"""WITH {_TOTALS}
SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
       CAST(CASE WHEN rnk = 1 THEN total_sales * 0.01 ELSE 0 END AS DECIMAL(18,4)) AS incentive
FROM ranked"""

_BOTH_MARTS = f"""WITH {_TOTALS}
SELECT 'sales' AS mart, store_id, sales_person_id AS person_id, full_name, sales_month AS month, total_sales,
       CAST(CASE WHEN rnk = 1 THEN total_sales * 0.01 ELSE 0 END AS DECIMAL(18,4)) AS incentive
FROM ranked
UNION ALL
SELECT 'customer', CAST(NULL AS BIGINT), customer_id, first_name || ' ' || last_name, month,
       CAST(SUM(total_cost) AS DECIMAL(18,2)), CAST(NULL AS DECIMAL(18,4))
FROM enriched GROUP BY customer_id, first_name, last_name, month"""

_HARD = (
    _LINES
    + """,
hard AS (
  SELECT CASE WHEN customer_id % 10 <> 0 THEN customer_id END AS customer_id, store_id, sales_date,
         CASE WHEN sales_person_id % 7 <> 0 THEN sales_person_id END AS sales_person_id,
         CASE WHEN DAY(sales_date) > 3 THEN CAST(100 AS DECIMAL(12,2)) END AS total_cost
  FROM lines
),
matched AS (
  SELECT h.*, c.first_name || ' ' || c.last_name AS customer_name, c.address, c.phone_number,
         t.sales_person_first_name || ' ' || t.sales_person_last_name AS seller_name,
         SUBSTR(CAST(h.sales_date AS VARCHAR), 1, 7) AS month
  FROM hard h
  JOIN dim_customer c ON h.customer_id = c.customer_id AND c.last_name <> 'BUILDING'
  JOIN dim_store s ON h.store_id = s.id AND s.store_pincode <> '1'
  JOIN dim_team t ON h.sales_person_id = t.id AND t.is_manager = 'N'
),
hard_ranked AS (
  SELECT *, RANK() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC NULLS LAST) AS rnk
  FROM (SELECT store_id, sales_person_id, seller_name AS full_name, month AS sales_month,
               CAST(SUM(total_cost) AS DECIMAL(18,2)) AS total_sales
        FROM matched GROUP BY 1, 2, 3, 4)
)
"""
)

_SALES_BASE = f"""WITH {_ENRICHED}
SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name, manager_id,
       is_manager, sales_person_address, sales_person_pincode, sales_date, total_cost,
       month AS sales_month
FROM enriched"""

_EVENTS = """
events_of AS (
  SELECT 'cust_' || CAST(o_custkey AS VARCHAR) AS file_name, o_orderdate AS event_time,
         o_orderkey AS event_id, CASE WHEN o_orderstatus = 'O' THEN 'A' ELSE 'I' END AS status
  FROM orders
),
latest AS (
  SELECT file_name, status FROM (
    SELECT file_name, status,
           ROW_NUMBER() OVER (PARTITION BY file_name ORDER BY event_time DESC, event_id DESC) AS n
    FROM events_of) WHERE n = 1
),
landed AS (SELECT 'cust_' || CAST(c_custkey AS VARCHAR) AS file_name FROM customer)
"""


def _metric(column: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, COUNT(*) AS n_rows, "
        f"COUNT(*) - COUNT({column}) AS n_nulls FROM lines"
    )


def oracle_sql() -> dict[str, str]:
    return {
        "csv_scan_conform": f"""WITH {_LINES}
SELECT {_CONTRACT}, CAST(NULL AS VARCHAR) AS additional_column FROM lines""",
        "file_contract_check": f"""WITH {_LINES},
counted AS (SELECT r_name AS region, (SELECT COUNT(*) FROM lines WHERE lines.region = r_name) AS n FROM region)
SELECT REPLACE(region, ' ', '_') AS feed,
       CASE WHEN region = 'EUROPE' THEN 'error' ELSE 'ok' END AS verdict,
       CASE WHEN region = 'EUROPE' THEN 'missing columns: store_id' END AS reason,
       CASE WHEN region = 'EUROPE' THEN 'store_id' ELSE '' END AS missing_columns,
       CASE WHEN region IN ('AMERICA', 'EUROPE') THEN 'payment_mode'
            WHEN region = 'MIDDLE EAST' THEN 'payment_mode,return_flag' ELSE '' END AS extra_columns,
       CASE WHEN region = 'EUROPE' THEN 0 ELSE n END AS n_rows
FROM counted
UNION ALL
SELECT 'CUSTOMERS', 'error', 'not a csv file', '', '', 0
FROM (SELECT COUNT(*) AS n FROM customer) WHERE n > 0""",
        "extra_columns_fold": f"""WITH {_LINES}
SELECT {_KEYS}, CONCAT_WS(',', payment_mode, return_flag) AS folded,
       CONCAT_WS(',', return_flag) AS folded_one, CAST(NULL AS VARCHAR) AS folded_none
FROM lines f""",
        "union_files": f"""WITH {_LINES}
SELECT {_CONTRACT},
       CASE WHEN region = 'AMERICA' THEN CONCAT_WS(',', payment_mode)
            WHEN region = 'MIDDLE EAST' THEN CONCAT_WS(',', payment_mode, return_flag)
       END AS additional_column
FROM lines WHERE region <> 'EUROPE'""",
        "quarantine_rows": f"""WITH {_LINES}
SELECT 'bad value: ' || CONCAT_WS(',', CASE WHEN payment_mode = '3-MEDIUM' THEN 'sales_date' END,
                                  CASE WHEN raw_flag = 'R' THEN 'sales_person_id' END,
                                  CASE WHEN payment_mode IN ('1-URGENT', '2-HIGH') THEN 'quantity' END) AS reason,
       CAST(customer_id AS VARCHAR) AS customer_id, CAST(store_id AS VARCHAR) AS store_id,
       product_name,
       CAST(sales_date AS VARCHAR) || CASE WHEN payment_mode = '3-MEDIUM' THEN 'T99:99' ELSE '' END AS sales_date,
       CASE WHEN raw_flag = 'R' THEN '[' || CAST(sales_person_id AS VARCHAR) || ']'
            ELSE CAST(sales_person_id AS VARCHAR) END AS sales_person_id,
       CAST(price AS VARCHAR) AS price,
       CASE WHEN payment_mode = '1-URGENT' THEN CAST(quantity AS VARCHAR) || ' pcs'
            WHEN payment_mode = '2-HIGH' THEN CAST(quantity AS VARCHAR) || '.000000001'
            ELSE CAST(quantity AS VARCHAR) END AS quantity,
       CAST(total_cost AS VARCHAR) AS total_cost
FROM lines WHERE raw_flag = 'R' OR payment_mode IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
        "stream_ingest": f"""WITH {_LINES}
SELECT {_CONTRACT}, payment_mode AS additional_column FROM lines""",
        "batch_marts": _BOTH_MARTS,
        "stream_marts": _BOTH_MARTS,
        "customer_mart_partial": f"""WITH {_HARD}
SELECT customer_id, customer_name AS full_name, address, phone_number, month AS sales_date_month,
       CAST(SUM(total_cost) AS DECIMAL(18,2)) AS total_sales
FROM matched GROUP BY 1, 2, 3, 4, 5""",
        "sales_mart_partial": f"""WITH {_HARD}
SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
       CAST(CASE WHEN rnk = 1 THEN total_sales * 0.01 ELSE 0 END AS DECIMAL(18,4)) AS incentive
FROM hard_ranked""",
        "sales_rank_partial": f"WITH {_HARD} SELECT * FROM hard_ranked",
        "dim_product_scan": """SELECT p_partkey AS id, p_name AS name,
       CAST(p_retailprice AS DECIMAL(12,2)) AS current_price FROM part""",
        "join_customer": f"""WITH {_LINES}
SELECT {_KEYS}, c.first_name, c.last_name, c.address, c.pincode, c.phone_number
FROM lines f JOIN dim_customer c ON f.customer_id = c.customer_id""",
        "join_store": f"""WITH {_LINES}
SELECT {_KEYS}, s.store_address, s.store_manager_name
FROM lines f JOIN dim_store s ON f.store_id = s.id""",
        "join_sales_team": f"""WITH {_LINES}
SELECT {_KEYS}, t.manager_id, t.is_manager, t.sales_person_joining_date,
       t.sales_person_first_name, t.sales_person_last_name, t.sales_person_address,
       t.sales_person_pincode
FROM lines f JOIN dim_team t ON f.sales_person_id = t.id""",
        "enrich_star": f"WITH {_ENRICHED} SELECT * EXCLUDE (month) FROM enriched",
        "unmatched_keys": f"""WITH {_LINES},
tagged AS (
  SELECT {_KEYS},
         CASE WHEN NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = f.customer_id
                               AND c.last_name <> 'BUILDING') THEN 'unknown customer_id'
              WHEN NOT EXISTS (SELECT 1 FROM dim_store s WHERE s.id = f.store_id
                               AND s.store_pincode <> '1') THEN 'unknown store_id'
              WHEN NOT EXISTS (SELECT 1 FROM dim_team t WHERE t.id = f.sales_person_id
                               AND t.is_manager = 'N') THEN 'unknown sales_person_id'
         END AS reason
  FROM lines f)
SELECT * FROM tagged WHERE reason IS NOT NULL""",
        "customer_mart_base": f"""WITH {_ENRICHED}
SELECT customer_id, first_name, last_name, address, pincode, phone_number, sales_date, total_cost
FROM enriched""",
        "sales_mart_base": _SALES_BASE,
        "month_bucket": f"""WITH {_LINES}
SELECT SUBSTR(CAST(sales_date AS VARCHAR), 1, 7) AS month_of_date,
       SUBSTR(CAST(sales_date AS VARCHAR), 1, 7) AS month_by_text,
       SUBSTR(CAST(sales_date AS VARCHAR), 1, 7) AS month_of_timestamp,
       COUNT(*) AS n_rows, MIN(sales_date) AS first_day
FROM lines GROUP BY 1, 2, 3""",
        "full_name": f"""WITH {_LINES}
SELECT customer_id, first_name || ' ' || NULLIF(last_name, 'BUILDING') AS full_name FROM dim_customer""",
        "customer_mart": _CUSTOMER_MART,
        "customer_mart_window": _CUSTOMER_MART,
        "sales_person_month_total": f"WITH {_TOTALS} SELECT * FROM totals",
        "sales_rank": f"WITH {_TOTALS} SELECT * FROM ranked",
        "sales_mart": _SALES_MART,
        "database_marts": _SALES_MART,
        "run_stamps": """SELECT user_id, event_type, strftime(MIN(ts), '%Y-%m-%d %H:%M:%S') AS run_timestamp,
       CAST(floor(epoch_ms(MIN(ts)) / 1000) AS BIGINT) * 1000 AS run_epoch_ms
FROM events GROUP BY 1, 2""",
        "empty_feed": f"""WITH {_LINES}
SELECT {_CONTRACT}, payment_mode AS additional_column FROM lines""",
        "top_seller": f"""WITH {_TOTALS}
SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
       CAST(total_sales * 0.01 AS DECIMAL(18,4)) AS incentive
FROM ranked WHERE rnk = 1""",
        "distinct_rows": f"""WITH {_LINES}
SELECT DISTINCT customer_id, store_id, SUBSTR(CAST(sales_date AS VARCHAR), 1, 7) AS sales_month
FROM lines""",
        "load_metrics": f"WITH {_LINES}\n"
        + "\nUNION ALL ".join(_metric(c.strip()) for c in f"{_CONTRACT}, payment_mode, return_flag".split(",")),
        "object_paths": """WITH named AS (
  SELECT 'in/' || c_mktsegment || '/cust ' || c_custkey || '.csv' AS object_key, c_custkey FROM customer)
SELECT CASE WHEN c_custkey % 2 = 0 THEN 's3a://shop/' ELSE 'file:///' END || object_key AS path, object_key,
       'cust ' || c_custkey || '.csv' AS file_name FROM named""",
        "ledger_events": """WITH files AS (
  SELECT 'cust_' || CAST(o_custkey AS VARCHAR) AS file_name, MIN(o_orderdate) AS begin_time,
         MAX(o_orderdate) AS end_time
  FROM orders GROUP BY 1)
SELECT file_name, 'landing/' || file_name AS file_location, begin_time AS event_time,
       CAST(2000 AS BIGINT) AS event_id, 'A' AS status, CAST(1000 AS BIGINT) AS run_epoch_ms FROM files
UNION ALL
SELECT file_name, 'landing/' || file_name, end_time, CAST(2001 AS BIGINT), 'I', CAST(1000 AS BIGINT) FROM files""",
        "ledger_latest": f"""WITH {_EVENTS}
SELECT l.file_name, l.status, MIN(e.event_time) AS created_date,
       MAX(CASE WHEN e.status = 'I' THEN e.event_time END) AS updated_date
FROM latest l JOIN events_of e ON l.file_name = e.file_name
GROUP BY l.file_name, l.status""",
        "ledger_active_landed": f"""WITH {_EVENTS}
SELECT DISTINCT file_name FROM landed
WHERE file_name IN (SELECT file_name FROM latest WHERE status = 'A')""",
        "ledger_pending": f"""WITH {_EVENTS}
SELECT file_name FROM landed
WHERE file_name NOT IN (SELECT file_name FROM latest WHERE status = 'I')""",
        "parquet_roundtrip": _SALES_BASE,
        "partitioned_mart_roundtrip": _SALES_BASE,
        "snapshot_latest": _SALES_MART,
        "partitioned_snapshot": _SALES_BASE,
        "customer_mart_roundtrip": _CUSTOMER_MART,
        "jdbc_roundtrip": _SALES_MART,
    }
