"""Independent SQL for the registered queries, over the same tables."""

from __future__ import annotations

from ordermill.sources.sample import QUARTER_RATES, RATE_COLUMNS

SALES = """
sales AS (
  SELECT
    o_orderkey AS sales_order_key,
    'ORD-' || CAST(o_orderkey AS VARCHAR) AS order_id,
    CAST(o_orderdate AS DATE) AS order_dt,
    c_name AS customer_name,
    p_brand || '/' || p_name || '/' || p_type
      || CASE WHEN p_partkey % 50 = 0 THEN '' ELSE '/' || CAST(p_size AS VARCHAR) END
      AS mobile_key,
    CASE n_regionkey WHEN 1 THEN 'US' WHEN 2 THEN 'IN' WHEN 4 THEN 'IN' ELSE 'FR' END
      AS country,
    CASE n_regionkey WHEN 1 THEN 'NA' WHEN 2 THEN 'APAC' WHEN 4 THEN 'APAC' ELSE 'EU' END
      AS region,
    o_orderkey % 4 + 1 AS order_quantity,
    CAST(o_orderkey % 900 + 100 AS DECIMAL(38,0)) AS unit_price,
    CAST((o_orderkey % 900 + 100) * (o_orderkey % 4 + 1) AS DECIMAL(38,0)) AS order_value,
    CASE WHEN o_orderkey % 5 <> 0
      THEN 'PROMO' || CAST(o_orderkey % 7 AS VARCHAR) END AS promotion_code,
    CAST(o_totalprice AS DECIMAL(10,2)) AS final_order_amount,
    CAST(o_orderkey % 1000 AS DECIMAL(10,2)) AS tax_amount,
    CASE WHEN o_orderstatus = 'F' THEN 'Paid' ELSE 'Pending' END AS payment_status,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'Shipped' ELSE 'Delivered' END AS shipping_status,
    o_orderpriority AS payment_method,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS payment_provider,
    'PH-' || CAST(o_custkey AS VARCHAR) || '-' || CAST(o_orderkey % 2 AS VARCHAR)
      AS contact_no,
    n_name || '-' || CAST(c_custkey AS VARCHAR) AS shipping_address,
    o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) AS _metadata_last_modified
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON p_partkey = o_orderkey % (SELECT COUNT(*) FROM part)
)"""


def _rate(position: int) -> str:
    cases = " ".join(f"WHEN {q} THEN {row[position]}" for q, row in QUARTER_RATES.items())
    return f"CAST(CASE quarter(rate_dt) {cases} END AS DECIMAL(10,7)) AS {RATE_COLUMNS[position]}"


RATES = f"""
rates AS (
  SELECT rate_dt, {", ".join(_rate(i) for i in range(len(RATE_COLUMNS)))}
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_dt FROM orders)
  WHERE day(rate_dt) <> 13
)"""

PAID = """
paid AS (
  SELECT * FROM sales WHERE payment_status = 'Paid' AND shipping_status = 'Delivered'
)"""


def _latest(source: str) -> str:
    return f"""
ranked AS (
  SELECT *, RANK() OVER (
    PARTITION BY country, order_dt ORDER BY _metadata_last_modified DESC NULLS LAST
  ) AS order_rank
  FROM {source}
),
latest AS (SELECT * FROM ranked WHERE order_rank = 1)"""


def _usd(amount: str, rate: str) -> str:
    """Exact quotient in units of 1e-8, rounded half up, as a decimal."""
    cents = f"CAST({amount} * 100 AS HUGEINT)"
    units = f"CAST({rate} * 10000000 AS HUGEINT)"
    quotient = f"(({cents} * 20000000000000 + {units}) // (2 * {units}))"
    return (
        f"CAST(CAST({quotient} AS DECIMAL(23,0)) * CAST(0.00000001 AS DECIMAL(9,8))"
        " AS DECIMAL(23,8))"
    )


def _curate(us_rate: str) -> str:
    rate = f"CASE country WHEN 'IN' THEN usd2inr WHEN 'US' THEN {us_rate} ELSE usd2eu END"
    return f"""
priced AS (
  SELECT latest.*, CAST({rate} AS DECIMAL(15,7)) AS exchange_rate,
    CASE country WHEN 'IN' THEN usd2inr WHEN 'US' THEN usd2usd ELSE usd2eu END AS divisor
  FROM latest LEFT JOIN rates ON order_dt = rate_dt
),
curated AS (
  SELECT sales_order_key, order_id, order_dt, customer_name, mobile_key, country, region,
    order_quantity,
    CASE country WHEN 'IN' THEN 'INR' WHEN 'US' THEN 'USD' ELSE 'EUR' END AS local_currency,
    unit_price AS local_unit_price, promotion_code,
    final_order_amount AS local_total_order_amt, tax_amount AS local_tax_amt, exchange_rate,
    {_usd("final_order_amount", "divisor")} AS us_total_order_amt,
    {_usd("tax_amount", "divisor")} AS usd_tax_amt,
    payment_status, shipping_status, payment_method, payment_provider, contact_no,
    shipping_address
  FROM priced
)"""


CURATED = f"{SALES},{RATES},{PAID},{_latest('paid')},{_curate('usd2usd')}"

# France takes the orders of the USA and tags them as its own.
CURATED_PARITY = f"""{SALES},{RATES},{PAID},
tagged AS (
  SELECT * FROM paid WHERE country IN ('IN', 'US')
  UNION ALL
  SELECT * REPLACE ('FR' AS country, 'EU' AS region) FROM paid WHERE country = 'US'
),{_latest('tagged')},{_curate('usd2inr')}"""

NATURAL_KEYS = {
    "product": ("mobile_key", "brand", "model", "color", "memory"),
    "promo_code": ("promotion_code", "country", "region"),
    "customer": ("customer_name", "contact_no", "shipping_address", "country", "region"),
    "payment": ("payment_method", "payment_provider", "country", "region"),
    "date": ("order_dt",),
}


def _members(name: str, orders: str) -> str:
    """Distinct members of a dimension."""
    if name == "product":
        parts = ", ".join(
            f"string_split(mobile_key, '/')[{i}] AS {part}"
            for i, part in enumerate(NATURAL_KEYS["product"][1:], 1)
        )
        return f"SELECT DISTINCT mobile_key, {parts} FROM {orders}"
    if name == "promo_code":
        code = "COALESCE(promotion_code, 'NA') AS promotion_code"
        return f"SELECT DISTINCT {code}, country, region FROM {orders}"
    if name == "date":
        return f"""SELECT CAST(day AS DATE) AS order_dt, first_dt FROM (
          SELECT first_dt, unnest(generate_series(
            CAST(first_dt AS TIMESTAMP), CAST(last_dt AS TIMESTAMP), INTERVAL 1 DAY)) AS day
          FROM (SELECT MIN(order_dt) AS first_dt, MAX(order_dt) AS last_dt FROM {orders}))"""
    return f"SELECT DISTINCT {', '.join(NATURAL_KEYS[name])} FROM {orders}"


def _order(columns: tuple[str, ...] | list[str]) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in columns)


def _number(columns: tuple[str, ...] | list[str]) -> str:
    return f"row_number() OVER (ORDER BY {_order(columns)})"


def _dim(name: str, orders: str = "curated") -> str:
    """SELECT of a sequence-keyed dimension."""
    key, columns = f"{name}_id_pk", NATURAL_KEYS[name]
    listed = ", ".join(columns)
    return f"""SELECT {_number(columns)} AS {key}, {listed}, 'Y' AS isActive
      FROM ({_members(name, orders)})"""


def _date_dim(counter: str, orders: str = "curated") -> str:
    return f"""SELECT {_number(("order_dt",))} AS date_id_pk, order_dt,
      CAST(year(order_dt) AS INTEGER) AS order_year,
      CAST(month(order_dt) AS INTEGER) AS order_month,
      CAST(quarter(order_dt) AS INTEGER) AS order_quarter,
      CAST(day(order_dt) AS INTEGER) AS order_day,
      CAST(isodow(order_dt) - 1 AS INTEGER) AS order_dayofweek,
      dayname(order_dt) AS order_dayname,
      CAST(day(order_dt) AS INTEGER) AS order_dayofmonth,
      CASE WHEN isodow(order_dt) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS order_weekday,
      CAST({counter} AS BIGINT) AS day_counter
    FROM ({_members("date", orders)})"""


RUNNING = "datediff('day', first_dt, order_dt) + 1"
RESTARTING = "dayofyear(order_dt) - dayofyear(first_dt) + 1"


def _region_dim(stamp: str) -> str:
    return f"""SELECT 'REG_' || right(region, 2) || '_' || country || '_{stamp}' AS region_id_pk,
      country, region, 'Y' AS isActive
    FROM (SELECT DISTINCT country, region FROM curated)"""


def _loaded_twice(name: str, first: str = "sales_order_key % 2 = 0") -> str:
    """Members of some orders first, then the others."""
    if name == "region":
        return f"WITH {CURATED} {_region_dim('20260123')}"
    if name == "date":
        return f"""WITH {CURATED},
        half AS (SELECT * FROM curated WHERE order_dt < DATE '1995-07-01'),
        seed AS ({_date_dim(RUNNING, "half")}),
        every_day AS ({_date_dim(RUNNING, "curated")}),
        added AS (SELECT * FROM every_day WHERE order_dt NOT IN (SELECT order_dt FROM seed))
        SELECT * FROM seed
        UNION ALL
        SELECT * REPLACE ({_number(("order_dt",))} + (SELECT COUNT(*) FROM seed) AS date_id_pk)
        FROM added"""
    key, columns = f"{name}_id_pk", NATURAL_KEYS[name]
    listed = ", ".join(columns)
    return f"""WITH {CURATED},
    half AS (SELECT * FROM curated WHERE {first}),
    seed AS ({_members(name, "half")}),
    added AS ({_members(name, "curated")} EXCEPT {_members(name, "half")})
    SELECT {_number(columns)} AS {key}, {listed}, 'Y' AS isActive FROM seed
    UNION ALL
    SELECT {_number(columns)} + (SELECT COUNT(*) FROM seed), {listed}, 'Y' FROM added"""


FOREIGN_KEYS = (
    "date_id_fk",
    "region_id_fk",
    "customer_id_fk",
    "payment_id_fk",
    "product_id_fk",
    "promo_code_id_fk",
)
MEASURES = (
    "order_quantity",
    "local_total_order_amt",
    "local_tax_amt",
    "exchange_rate",
    "us_total_order_amt",
    "usd_tax_amt",
)

DIMS = f"""
date_dim AS ({_date_dim(RUNNING)}),
region_dim AS ({_region_dim("20260123")}),
product_dim AS ({_dim("product")}),
promo_code_dim AS ({_dim("promo_code")}),
customer_dim AS ({_dim("customer")}),
payment_dim AS ({_dim("payment")})"""


def _fact_rows(parity: bool = False) -> str:
    """CTE fact_rows: fact rows without their key."""
    if parity:
        customer = "c.customer_name = o.customer_name"
        provider = "y.payment_provider = o.payment_provider"
    else:
        customer = """c.customer_name IS NOT DISTINCT FROM o.customer_name
      AND c.contact_no IS NOT DISTINCT FROM o.contact_no
      AND c.shipping_address IS NOT DISTINCT FROM o.shipping_address"""
        provider = "y.payment_provider IS NOT DISTINCT FROM o.payment_provider"
    return f"""
fact_rows AS (
  SELECT o.country, o.sales_order_key, o.order_id AS order_code,
    d.date_id_pk AS date_id_fk, r.region_id_pk AS region_id_fk,
    c.customer_id_pk AS customer_id_fk, y.payment_id_pk AS payment_id_fk,
    p.product_id_pk AS product_id_fk, m.promo_code_id_pk AS promo_code_id_fk,
    {", ".join(f"o.{c}" for c in MEASURES)}
  FROM (SELECT DISTINCT * FROM curated) o
  JOIN date_dim d ON d.order_dt = o.order_dt
  JOIN region_dim r ON r.country = o.country AND r.region = o.region
  JOIN customer_dim c ON c.country = o.country AND c.region = o.region AND {customer}
  JOIN payment_dim y ON y.country = o.country AND y.region = o.region
    AND y.payment_method = o.payment_method AND {provider}
  JOIN product_dim p ON p.mobile_key = o.mobile_key
  JOIN promo_code_dim m ON m.country = o.country AND m.region = o.region
    AND m.promotion_code = COALESCE(o.promotion_code, 'NA')
)"""


FACT_ORDER = ("country", "sales_order_key", *FOREIGN_KEYS)
FACT_COLUMNS = ", ".join(("order_code", *FOREIGN_KEYS, *MEASURES))


def _fact(parity: bool = False) -> str:
    return f"""WITH {CURATED},{DIMS},{_fact_rows(parity)}
    SELECT {_number(FACT_ORDER)} AS order_id_pk, {FACT_COLUMNS} FROM fact_rows"""


LATEST_COLUMNS = "country, sales_order_key, order_dt, _metadata_last_modified"

# Landing files: what the planted faults and oddities turn into.
FAULTS = """concat_ws(',',
      CASE WHEN sales_order_key % 97 = 0 THEN 'order_quantity' END,
      CASE WHEN sales_order_key % 103 = 0 THEN 'final_order_amount' END,
      CASE WHEN sales_order_key % 101 = 0 THEN 'order_dt' END)"""


def _landed(country: str | None = None) -> str:
    chosen = f"WHERE country = '{country}'" if country else ""
    return f"""landed AS (
      SELECT * REPLACE (customer_name || ', "client"' AS customer_name), {FAULTS} AS bad_fields,
        sales_order_key % 11 = 0 AS half_price, sales_order_key % 4 = 0 AS cents
      FROM sales {chosen}
    )"""


def _accepted(country: str, extra: str = "", whole_tax: bool = False) -> str:
    tax = "CASE WHEN cents THEN {} ELSE 0 END".format("1" if whole_tax else "0.50")
    return f"""WITH {SALES}, {_landed(country)}
    SELECT order_id, customer_name, mobile_key, order_quantity,
      CAST(unit_price + CASE WHEN half_price THEN 1 ELSE 0 END AS DECIMAL(38,0)) AS unit_price,
      order_value, promotion_code, final_order_amount,
      CAST(tax_amount + {tax} AS DECIMAL(10,2)) AS tax_amount, order_dt,
      payment_status, shipping_status, payment_method, payment_provider, contact_no,
      shipping_address{extra}
    FROM landed WHERE bad_fields = ''"""


def _rejected(country: str) -> str:
    return f"""WITH {SALES}, {_landed(country)}
    SELECT bad_fields, order_id, customer_name, mobile_key,
      CASE WHEN sales_order_key % 97 = 0 THEN 'abc'
        ELSE CAST(order_quantity AS VARCHAR) END AS order_quantity,
      CAST(unit_price AS VARCHAR) || CASE WHEN half_price THEN '.50' ELSE '' END AS unit_price,
      CAST(order_value AS VARCHAR) AS order_value, promotion_code,
      CASE WHEN sales_order_key % 103 = 0 THEN '123456789012.00'
        ELSE CAST(final_order_amount AS VARCHAR) END AS final_order_amount,
      CAST(CAST(tax_amount + CASE WHEN cents THEN 0.50 ELSE 0 END AS DECIMAL(10,2)) AS VARCHAR)
        AS tax_amount,
      CASE WHEN sales_order_key % 101 = 0 THEN strftime(order_dt, '%d/%m/%Y')
        ELSE CAST(order_dt AS VARCHAR) END AS order_dt,
      payment_status, shipping_status, payment_method, payment_provider, contact_no,
      shipping_address
    FROM landed WHERE bad_fields <> ''"""


LANDING_DATE = "CAST(date_trunc('year', order_dt) AS DATE)"
FORMATS = "CASE country WHEN 'IN' THEN 'csv' WHEN 'US' THEN 'parquet' ELSE 'json' END"


def _warehouse_counts() -> str:
    rows = []
    for country in ("IN", "US", "FR"):
        for what, test in (("source", "="), ("rejects", "<>")):
            rows.append(
                f"SELECT '{country} {what}' AS what, COUNT(*) AS rows FROM flagged"
                f" WHERE country = '{country}' AND bad_fields {test} ''"
            )
    rows.append("SELECT 'exchange rates', COUNT(*) FROM rates")
    empty = (
        *(f"{country} audit wrong" for country in ("IN", "US", "FR")),
        "orphans",
        "facts beyond curated",
        "curated beyond facts",
        "repeated fact keys",
        "late loads",
        *(
            f"repeated {name}_dim"
            for name in ("date", "region", "product", "promo_code", "customer", "payment")
        ),
    )
    rows += [f"SELECT '{what}', 0" for what in empty]
    union = " UNION ALL ".join(rows)
    return f"WITH {SALES},{RATES}, flagged AS (SELECT country, {FAULTS} AS bad_fields FROM sales) {union}"


# Every accepted order ends up in the fact: of each drop of files, all orders of a day are latest.
def _dropped(only: str = "") -> str:
    return f"""WITH {SALES},{RATES},{_landed()},
latest AS (
  SELECT * REPLACE (
    CAST(tax_amount + CASE WHEN cents THEN 0.50 ELSE 0 END AS DECIMAL(10,2)) AS tax_amount)
  FROM landed
  WHERE bad_fields = '' AND payment_status = 'Paid' AND shipping_status = 'Delivered'
  {only}
),{_curate('usd2usd')}
SELECT order_id AS order_code, order_dt, country, region, customer_name, contact_no,
  shipping_address, payment_method, payment_provider, mobile_key,
  COALESCE(promotion_code, 'NA') AS promotion_code, {", ".join(MEASURES)}
FROM curated"""


# The files of a drop have one time, so the later drop that has a day has its orders.
LATER_DROP = """QUALIFY sales_order_key % 2
    = MAX(sales_order_key % 2) OVER (PARTITION BY country, order_dt)"""

ORPHANS = " UNION ALL ".join(
    f"""SELECT '{name}_dim' AS dimension, CAST({name}_id_fk AS VARCHAR) AS key_value,
      COUNT(*) AS fact_rows FROM fact_rows WHERE {name}_id_fk % {every} = 0 GROUP BY ALL"""
    for name, every in (("payment", 7), ("product", 10), ("customer", 100))
)

RECONCILED = f"""WITH {CURATED}, expected AS (
  SELECT sales_order_key % 97 AS load_id, COUNT(*) AS expected_rows,
    COUNT(*) FILTER (WHERE sales_order_key % 970 = 0) AS lost,
    COUNT(*) FILTER (WHERE sales_order_key % 776 = 8 AND sales_order_key % 970 <> 0) AS doubled,
    COUNT(*) FILTER (WHERE sales_order_key % 873 = 20 AND sales_order_key % 970 <> 0) AS changed
  FROM curated WHERE order_dt IS NOT NULL GROUP BY 1
)
SELECT load_id, expected_rows, expected_rows - lost + doubled AS found_rows,
  CASE WHEN doubled < lost THEN 'lost' WHEN doubled > lost THEN 'doubled' ELSE 'changed' END
    AS verdict
FROM expected WHERE lost + doubled + changed > 0"""


def _moving(position: int) -> str:
    """A rate in units of 1e-7, moved by the day, with the planted jumps and stale days."""
    units = f"CAST({RATE_COLUMNS[position]} * 10000000 AS BIGINT)"
    moved = f"{units} + (dayofyear(rate_dt) * 37 % 41 - 20) * ({units} // 20000)"
    planted = {
        3: f"{moved} + CASE WHEN dayofyear(rate_dt) % 97 = 0 THEN 3000000 ELSE 0 END",
        5: f"CASE WHEN dayofyear(rate_dt) BETWEEN 40 AND 50 THEN 1185000000 ELSE {moved} END",
    }
    return f"{planted.get(position, moved)} AS {RATE_COLUMNS[position]}"


RATE_OUTLIERS = f"""WITH {RATES}, moving AS (
  SELECT rate_dt, CAST(usd2usd * 10000000 AS BIGINT) AS usd2usd,
    {", ".join(_moving(i) for i in range(1, len(RATE_COLUMNS)))}
  FROM rates
),
planted AS (
  SELECT * REPLACE (
    CASE WHEN dayofyear(rate_dt) % 113 = 0 THEN usd2can ELSE usd2eu END AS usd2eu,
    CASE WHEN dayofyear(rate_dt) % 113 = 0 THEN usd2eu ELSE usd2can END AS usd2can)
  FROM moving
),
listed AS (UNPIVOT planted ON {", ".join(RATE_COLUMNS)} INTO NAME currency VALUE u),
seen AS (
  SELECT *, COUNT(*) OVER before AS n, MEDIAN(u) OVER before AS m, MAD(u) OVER before AS spread,
    ROW_NUMBER() OVER (PARTITION BY currency ORDER BY rate_dt) AS place
  FROM listed
  WINDOW before AS (PARTITION BY currency ORDER BY rate_dt ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
),
unmoved AS (
  SELECT a.currency, a.rate_dt FROM seen AS a JOIN seen AS b
    ON a.currency = b.currency AND b.place BETWEEN a.place - 4 AND a.place
  GROUP BY ALL HAVING COUNT(*) = 5 AND MIN(b.u) = MAX(b.u)
),
jumps AS (
  SELECT currency, rate_dt,
    EXISTS (FROM listed AS o WHERE o.rate_dt = s.rate_dt AND ABS(o.u - s.m) * 50 <= s.m) AS fits
  FROM seen AS s
  WHERE (n >= 10 AND ABS(u - m) > 8 * spread AND ABS(u - m) * 50 > m)
    OR (currency = 'usd2usd' AND u <> 10000000)
)
SELECT s.rate_dt, s.currency,
  CAST(CAST(u AS DECIMAL(18,0)) * CAST(0.0000001 AS DECIMAL(8,7)) AS DECIMAL(10,7)) AS rate,
  CAST(CAST(2 * m AS DECIMAL(18,0)) * CAST(0.00000005 AS DECIMAL(9,8)) AS DECIMAL(18,8)) AS median,
  CASE WHEN fits THEN 'swapped' WHEN j.currency IS NOT NULL THEN 'jump' ELSE 'stale' END AS kind
FROM seen AS s
LEFT JOIN jumps AS j ON s.currency = j.currency AND s.rate_dt = j.rate_dt
LEFT JOIN unmoved AS v ON s.currency = v.currency AND s.rate_dt = v.rate_dt
WHERE j.currency IS NOT NULL OR (v.currency IS NOT NULL AND s.currency <> 'usd2usd')"""

# Only orders that have dollars, or should have them, can be wrong.
WRONG_DOLLARS = f"""WITH {CURATED}
SELECT country, sales_order_key,
  CASE WHEN sales_order_key % 103 <> 0 THEN exchange_rate END AS exchange_rate,
  exchange_rate AS expected_exchange_rate,
  CAST(us_total_order_amt + CASE WHEN sales_order_key % 101 = 0 THEN 0.00000001 ELSE 0 END
    AS DECIMAL(23,8)) AS us_total_order_amt,
  us_total_order_amt AS expected_us_total_order_amt
FROM curated
WHERE us_total_order_amt IS NOT NULL
  AND (sales_order_key % 101 = 0 OR sales_order_key % 103 = 0)"""

SQL: dict[str, str] = {
    "curated_usd_orders": f"WITH {CURATED} SELECT * FROM curated",
    "curated_usd_orders_parity": f"WITH {CURATED_PARITY} SELECT * FROM curated",
    "paid_delivered_filter": f"""WITH {SALES},{PAID}
    SELECT country, sales_order_key, order_dt, payment_status, shipping_status FROM paid""",
    "fx_full_outer_join": f"""WITH {SALES},{RATES},{PAID}
    SELECT country, sales_order_key, order_dt, rate_dt, usd2eu, usd2inr
    FROM paid FULL OUTER JOIN rates ON order_dt = rate_dt""",
    "latest_file_per_day_rank": f"""WITH {SALES},{PAID},{_latest("paid")}
    SELECT {LATEST_COLUMNS}, order_rank FROM ranked""",
    "latest_file_per_day_selfjoin": f"""WITH {SALES},{PAID},{_latest("paid")},
    survivors AS (SELECT country AS c, sales_order_key AS k FROM latest)
    SELECT {LATEST_COLUMNS} FROM survivors JOIN paid ON c = country AND k = sales_order_key""",
    "latest_file_per_day_maxjoin": f"""WITH {SALES},{PAID},{_latest("paid")}
    SELECT {LATEST_COLUMNS} FROM latest""",
    "curated_union_distinct": f"""WITH {CURATED}
    SELECT * FROM curated WHERE country = 'IN'
    UNION SELECT * FROM curated WHERE country = 'IN'
    UNION SELECT * FROM curated WHERE country = 'US'
    UNION SELECT * FROM curated WHERE country = 'FR'""",
    "region_dim": f"WITH {CURATED} {_region_dim('20260123')}",
    "region_dim_parity": f"WITH {CURATED} {_region_dim('2026123')}",
    "product_dim": f"WITH {CURATED} {_dim('product')}",
    "promo_code_dim": f"WITH {CURATED} {_dim('promo_code')}",
    "customer_dim": f"WITH {CURATED} {_dim('customer')}",
    "payment_dim": f"WITH {CURATED} {_dim('payment')}",
    "payment_dim_parity": f"""WITH {CURATED}, once AS ({_dim("payment")})
    SELECT * FROM once
    UNION ALL
    SELECT {_number(NATURAL_KEYS["payment"])} + (SELECT COUNT(*) FROM once),
      payment_method, payment_provider, country, region, isActive
    FROM once WHERE payment_provider IS NULL""",
    "date_dim": f"WITH {CURATED} {_date_dim(RUNNING)}",
    "date_dim_parity": f"WITH {CURATED} {_date_dim(RESTARTING)}",
    "dim_key_counts": f"""WITH {CURATED}
    SELECT country, region, payment_method, payment_provider, COUNT(*) AS orders
    FROM curated GROUP BY ALL""",
    "dim_incremental_load": _loaded_twice("customer"),
    "dim_incremental_load_nulls": _loaded_twice("payment"),
    "region_dim_incremental": _loaded_twice("region"),
    "product_dim_incremental": _loaded_twice("product"),
    "promo_code_dim_incremental": _loaded_twice(
        "promo_code", "country = 'IN' AND promotion_code > 'PROMO3'"
    ),
    "date_dim_incremental": _loaded_twice("date"),
    "sales_fact": _fact(),
    "sales_fact_parity": _fact(parity=True),
    "fact_incremental_append": f"""WITH {CURATED},{DIMS},{_fact_rows()}
    SELECT {_number(FACT_ORDER)} AS order_id_pk, {FACT_COLUMNS}
    FROM fact_rows WHERE sales_order_key % 2 = 0
    UNION ALL
    SELECT {_number(FACT_ORDER)}
        + (SELECT COUNT(*) FROM fact_rows WHERE sales_order_key % 2 = 0), {FACT_COLUMNS}
    FROM fact_rows WHERE sales_order_key % 2 = 1""",
    "surrogate_keys": f"""WITH {SALES}
    SELECT {_number(("payment_provider", "customer_name", "sales_order_key"))} + 1000 AS row_key,
      payment_provider, customer_name, sales_order_key
    FROM sales""",
    "order_date_bounds": f"""WITH {SALES}
    SELECT MIN(order_dt) AS first_dt, MAX(order_dt) AS last_dt, COUNT(*) AS orders FROM sales""",
    "customer_sample": """SELECT c_custkey, c_name, c_mktsegment FROM customer
    ORDER BY c_custkey LIMIT 10""",
    "csv_ingest": _accepted("IN"),
    "parquet_ingest": _accepted("US"),
    "parquet_ingest_parity": _accepted("US", whole_tax=True),
    "json_ingest": _accepted("FR"),
    "csv_multiline_ingest": f"""SELECT * EXCLUDE (sales_order_key) REPLACE (
      CASE WHEN sales_order_key % 13 = 0 THEN 'Line one' || chr(10) || chr(10) || customer_name
        ELSE customer_name END AS customer_name,
      CASE WHEN sales_order_key % 7 = 0
        THEN shipping_address || chr(10) || 'Old "Town"' || chr(10) || 'End, north'
        ELSE shipping_address END AS shipping_address)
    FROM ({_accepted("IN", ", sales_order_key")})""",
    "json_lines_ingest": _accepted("FR"),
    "csv_split_multiline": f"""WITH own AS (SELECT * EXCLUDE (sales_order_key) REPLACE (
      CASE WHEN sales_order_key % 3 = 0 THEN 'Line one' || chr(10) || chr(10) || customer_name
        ELSE customer_name END AS customer_name,
      CASE WHEN sales_order_key % 5 = 0 THEN mobile_key || ' 6" wide' ELSE mobile_key END
        AS mobile_key)
    FROM ({_accepted("IN", ", sales_order_key")}))
    SELECT *, unnest(['split', 'whole']) AS reading FROM own""",
    "parquet_mixed_types": _accepted("US"),
    "damaged_file_ingest": " UNION ALL ".join(
        f"""SELECT '{country}' AS country, COUNT(*) + 1 AS rows, true AS "unique", 1 AS set_aside,
      0 AS again, 1 AS repaired, 0 AS last
    FROM ({_accepted(country)})"""
        for country in ("IN", "US", "FR")
    ),
    "json_documents_ingest": f"""SELECT *, NULL::VARCHAR AS raw_record FROM ({_accepted("FR")})
    UNION ALL BY NAME
    SELECT 'left over ' || o_orderkey AS raw_record
    FROM (WITH {SALES} SELECT sales_order_key AS o_orderkey FROM sales
      WHERE country = 'FR' AND sales_order_key % 11 = 0)""",
    "csv_rejects": _rejected("IN"),
    "json_rejects": _rejected("FR"),
    "json_null_tokens": f"""WITH {SALES}
    SELECT order_id, payment_provider, promotion_code,
      CASE WHEN sales_order_key % 3 <> 0 THEN shipping_address END AS shipping_address
    FROM sales WHERE country = 'FR'""",
    "file_lineage": f"""WITH {SALES}
    SELECT country, {LANDING_DATE} AS date, COUNT(*) AS rows, true AS dense,
      true AS consecutive, COUNT(*) AS with_time
    FROM sales GROUP BY ALL""",
    "landing_inventory": f"""WITH {SALES}
    SELECT DISTINCT 'source=' || country || '/format=' || {FORMATS}
      || '/date=' || CAST({LANDING_DATE} AS VARCHAR) AS partition_dir, true AS has_data
    FROM sales""",
    "landing_date_pruning": f"""WITH {SALES}
    SELECT {LANDING_DATE} AS date, order_id, customer_name || ', "client"' AS customer_name
    FROM sales WHERE country = 'IN' AND year(order_dt) BETWEEN 1996 AND 1998""",
    "incremental_file_load": _accepted(
        "IN", ", CAST(sales_order_key % 2 AS INTEGER) AS batch"
    ),
    "exchange_rate_load": f"WITH {RATES} SELECT * FROM rates",
    "append_by_name": f"""WITH {SALES}, days AS ({_date_dim(RUNNING, "sales")})
    SELECT * REPLACE (CASE WHEN order_year >= 1998 THEN day_counter END AS day_counter)
    FROM days""",
    "dim_pk_duplicates": f"""WITH {CURATED}, members AS ({_dim("customer")})
    SELECT customer_id_pk, COUNT(*) AS rows FROM (
      SELECT * FROM members
      UNION ALL SELECT * FROM members WHERE customer_id_pk % 50 = 0
    ) GROUP BY customer_id_pk HAVING COUNT(*) > 1""",
    "fact_fk_orphans": f"WITH {CURATED},{DIMS},{_fact_rows()} {ORPHANS}",
    "missing_rate_audit": f"""WITH {CURATED}
    SELECT country, COUNT(*) AS orders,
      COUNT(*) FILTER (WHERE us_total_order_amt IS NULL) AS without_rate
    FROM curated GROUP BY country""",
    "layer_reconciliation": RECONCILED,
    "rate_outliers": RATE_OUTLIERS,
    "wrong_dollars": WRONG_DOLLARS,
    "warehouse_rerun": _warehouse_counts(),
    "warehouse_recovery": _dropped(),
    "fact_replaced_days": _dropped(LATER_DROP),
}
