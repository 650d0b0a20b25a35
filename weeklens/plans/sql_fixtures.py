"""DuckDB SQL for the fixture mapping, shared by the oracle queries.

These strings are the brute-force reference: plain joins and group-bys over
the driver's tables, written independently of the DataFrame code."""

TX_PART = """tx AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey AS product_id,
         o.o_orderdate AS purchase_date, date_trunc('week', o.o_orderdate) AS week
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

TX_BRAND = """tx AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
         CAST(regexp_extract(p.p_brand, '(\\d+)', 1) AS BIGINT) AS product_id,
         o.o_orderdate AS purchase_date, date_trunc('week', o.o_orderdate) AS week
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

CUST = """cust AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS customer_type,
         CAST(n_regionkey AS INTEGER) AS region_id, CAST(c_nationkey AS INTEGER) AS zone_id,
         CAST(c_acctbal AS DOUBLE) AS Y, c_acctbal * -0.5 + c_nationkey AS X,
         CAST(c_custkey % 6 + 1 AS INTEGER) AS num_deliver_per_week,
         CAST(1 AS INTEGER) AS num_visit_per_week
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

PROD_PART = """prod AS (
  SELECT p_partkey AS product_id, p_brand AS brand, 'GOODS' AS category, p_type AS sub_category,
         CASE WHEN p_retailprice < 925 THEN 'LOW' WHEN p_retailprice < 950 THEN 'MEDIUM'
              WHEN p_retailprice < 975 THEN 'HIGH' ELSE 'PREMIUM' END AS segment,
         split_part(p_name, ' ', 2) AS package, CAST(p_size AS DOUBLE) AS size
  FROM part)"""

PROD_BRAND = """prod AS (
  SELECT DISTINCT CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT) AS product_id,
         p_brand AS brand, 'GOODS' AS category
  FROM part)"""

def grid_cte(name: str = "grid", tx: str = "tx") -> str:
    """The dense brand-grain grid over the transactions CTE ``tx`` (constant
    columns num_visit_per_week and category dropped)."""
    return f"""{name} AS (
  SELECT c.customer_id, p.product_id, w.week,
         CAST(coalesce(b.comprado, 0) AS INTEGER) AS comprado,
         cu.customer_type, cu.region_id, cu.zone_id, cu.Y, cu.X, cu.num_deliver_per_week,
         pr.brand
  FROM (SELECT DISTINCT customer_id FROM {tx}) c
  CROSS JOIN (SELECT DISTINCT product_id FROM {tx}) p
  CROSS JOIN (SELECT unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS week FROM {tx}) w
  LEFT JOIN (SELECT customer_id, product_id, week,
                    max(CASE WHEN order_id IS NOT NULL THEN 1 ELSE 0 END) AS comprado
             FROM {tx} GROUP BY 1, 2, 3) b
         ON b.customer_id = c.customer_id AND b.product_id = p.product_id AND b.week = w.week
  LEFT JOIN cust cu ON cu.customer_id = c.customer_id
  LEFT JOIN prod pr ON pr.product_id = p.product_id)"""


GRID_BRAND = grid_cte()

# History / new windows of the incremental scenario, relative to the last week.
TX_WINDOWS = """last AS (SELECT max(week) AS lw FROM tx),
tx_hist AS (SELECT tx.* FROM tx, last WHERE week <= lw - INTERVAL 21 DAY),
tx_new AS (SELECT tx.* FROM tx, last WHERE week >= lw - INTERVAL 35 DAY)"""


def drift_sql(ref: str, new: str, numeric, categorical, min_samples: int = 30) -> str:
    """Brute-force KS and chi-square rows (statistic rounded to 6 places)."""
    parts = []
    sides = [(ref, 0), (new, 1)]
    if numeric:
        u = " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value, {k} AS side FROM {t} "
            f"WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))"
            for c in numeric for t, k in sides)
        parts.append(f"""SELECT column_name, 'kolmogorov_smirnov' AS test,
       round(max(abs(c1 / n1t - c2 / n2t)), 6) AS statistic,
       CAST(max(n1t) AS BIGINT) AS ref_samples, CAST(max(n2t) AS BIGINT) AS new_samples,
       CAST(NULL AS BIGINT) AS categories
FROM (SELECT column_name, value,
             sum(n1) OVER (PARTITION BY column_name ORDER BY value) AS c1,
             sum(n2) OVER (PARTITION BY column_name ORDER BY value) AS c2,
             sum(n1) OVER (PARTITION BY column_name) AS n1t,
             sum(n2) OVER (PARTITION BY column_name) AS n2t
      FROM (SELECT column_name, value, sum(1 - side) AS n1, sum(side) AS n2
            FROM ({u}) u GROUP BY 1, 2) h) c
GROUP BY column_name
HAVING max(n1t) >= {min_samples} AND max(n2t) >= {min_samples}""")
    if categorical:
        u = " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, {k} AS side FROM {t} "
            f"WHERE {c} IS NOT NULL" for c in categorical for t, k in sides)
        parts.append(f"""SELECT column_name, 'chi_square' AS test,
       round(sum(
         power(abs(n1 - e1) - CASE WHEN k = 2 THEN least(0.5, abs(n1 - e1)) ELSE 0 END, 2) / e1 +
         power(abs(n2 - e2) - CASE WHEN k = 2 THEN least(0.5, abs(n2 - e2)) ELSE 0 END, 2) / e2), 6)
         AS statistic,
       CAST(max(n1t) AS BIGINT) AS ref_samples, CAST(max(n2t) AS BIGINT) AS new_samples,
       CAST(max(k) AS BIGINT) AS categories
FROM (SELECT *, (n1 + n2) * n1t / (n1t + n2t) AS e1, (n1 + n2) * n2t / (n1t + n2t) AS e2
      FROM (SELECT column_name, value, n1, n2,
                   sum(n1) OVER (PARTITION BY column_name) AS n1t,
                   sum(n2) OVER (PARTITION BY column_name) AS n2t,
                   count(*) OVER (PARTITION BY column_name) AS k
            FROM (SELECT column_name, value, CAST(sum(1 - side) AS DOUBLE) AS n1,
                         CAST(sum(side) AS DOUBLE) AS n2
                  FROM ({u}) u GROUP BY 1, 2) h) x) c
GROUP BY column_name
HAVING max(n1t) >= {min_samples} AND max(n2t) >= {min_samples} AND max(k) > 1""")
    return "\nUNION ALL\n".join(parts)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
