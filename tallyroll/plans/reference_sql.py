"""SQL for the queries of ``plans.catalogue``, written as joins over the whole tables.

Every metric is summed straight from the enriched lines, not from rollups, so the SQL checks
the rollups too.
"""

from __future__ import annotations

from tallyroll.plans.metrics import METRICS

PRODUCTS = """
products AS (
  SELECT p_partkey AS id, p_type AS category, p_retailprice AS price,
         CAST(floor(p_retailprice) AS BIGINT) AS votes, p_size / 10.0 AS rate, p_name AS title, p_brand AS brand
  FROM part
)"""

USERS = """
users AS (
  SELECT c_custkey AS id, n_name AS city, c_name || '@example.com' AS email,
         split_part(c_name, '#', 1) AS firstname, split_part(c_name, '#', 2) AS lastname
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

WEEKLY_PRODUCTS = """
weekly_products AS (
  SELECT s.iso_year, s.iso_week, p.* REPLACE (
           round(p.price + s.iso_week / 100.0, 2) AS price)
  FROM (SELECT DISTINCT isoyear(l_shipdate) AS iso_year, week(l_shipdate) AS iso_week, l_partkey FROM lineitem) s
  JOIN products p ON p.id = s.l_partkey
)"""

WEEKLY_USERS = """
weekly_users AS (
  SELECT s.iso_year, s.iso_week, u.*
  FROM (SELECT DISTINCT isoyear(l_shipdate) AS iso_year, week(l_shipdate) AS iso_week, o_custkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey) s
  JOIN users u ON u.id = s.o_custkey
)"""


def _lines(buyer: str, where: str = "TRUE") -> str:
    return f"""
lines AS (
  SELECT CAST(o_orderdate AS DATE) AS run_date, {buyer} AS buyer, l_partkey AS product,
         CAST(l_quantity AS BIGINT) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE {where}
)"""


_ATTRIBUTES = "p.category, p.price, p.votes, p.rate, u.city, u.email, u.firstname, u.lastname"


def _wide(buyer: str = "o_custkey", where: str = "TRUE") -> str:
    return f"""WITH {PRODUCTS}, {USERS}, {_lines(buyer, where)},
wide AS (
  SELECT l.*, {_ATTRIBUTES}
  FROM lines l LEFT JOIN products p ON p.id = l.product LEFT JOIN users u ON u.id = l.buyer
)"""


def _wide_weekly() -> str:
    week = "iso_year = isoyear(l.run_date) AND {0}.iso_week = week(l.run_date)"
    return f"""WITH {PRODUCTS}, {USERS}, {WEEKLY_PRODUCTS}, {WEEKLY_USERS}, {_lines("o_custkey")},
wide AS (
  SELECT l.*, {_ATTRIBUTES}
  FROM lines l
  LEFT JOIN weekly_products p ON p.id = l.product AND p.{week.format("p")}
  LEFT JOIN weekly_users u ON u.id = l.buyer AND u.{week.format("u")}
)"""


# Prices and rates are taken from their doubles to six places, whatever unit the engine counts in.
_PRICE, _RATE = "CAST(price AS DECIMAL(18,6))", "CAST(rate AS DECIMAL(18,6))"
_PRICE_MICROS, _RATE_MICROS = (f"CAST({x} * 1000000 AS BIGINT)" for x in (_PRICE, _RATE))
REVENUE = f"CAST(sum({_PRICE} * quantity) AS DOUBLE)"
REVENUE_CENTS = f"CAST(round(sum({_PRICE} * quantity), 2) AS DOUBLE)"
UNITS = "CAST(sum(quantity) AS BIGINT)"
LINES = "count(product)"
MEAN_PRICE = f"CAST((2 * sum({_PRICE_MICROS}) + count(price) * 10000) // nullif(2 * count(price) * 10000, 0) AS DOUBLE) / 100"
MEAN_RATING = (
    f"CAST((2 * sum({_RATE_MICROS} * votes) + sum(votes) * 100000) // nullif(2 * sum(votes) * 100000, 0) AS DOUBLE) / 10"
)

_BUYER = (("User_ID", "buyer"), ("firstname", "firstname"), ("lastname", "lastname"), ("email", "email"))

# Names and result columns of the metrics.
# Metric: output keys with their source column, measure, output column, whether only the top row counts.
_METRICS = [
    ("revenue_by_category", (("category", "category"),), REVENUE, "total_revenue_byCat", False),
    ("revenue_by_users_id", _BUYER, REVENUE, "total_revenue_byUser", False),
    ("total_day_revenue", (), REVENUE_CENTS, "total_day_revenue", False),
    ("total_quantity_per_prod", (("Product_ID", "product"), ("category", "category")), UNITS, "quantity_per_productID", False),
    ("avg_ordval_per_user", _BUYER, MEAN_PRICE, "avg_ordval_per_UserID", False),
    ("avg_rat_per_cat", (("category", "category"),), MEAN_RATING, "Weighted_avg_rating_per_category", False),
    ("total_revenue_per_city", (("city", "city"),), REVENUE_CENTS, "Total_revenue_city", False),
    ("num_of_prod_sold", (("product_ID", "product"),), LINES, "Num_prod_sold", False),
    ("rev_prod_cat", (("category", "category"), ("product_ID", "product")), REVENUE, "revenue_prod_byCat", False),
    ("top_user_rev", (("user_ID", "buyer"), *_BUYER[1:]), REVENUE, "Top_user_revenue", True),
    ("top_prod_rev", (("product_ID", "product"), ("category", "category")), REVENUE, "Top_product_revenue", True),
    ("ord_bycity", (("city", "city"),), UNITS, "Orders_by_city", False),
]


def _order(keys: tuple[tuple[str, str], ...], output: str) -> str:
    return ", ".join([f"{output} DESC NULLS LAST", *[f"{name} ASC NULLS FIRST" for name, _ in keys]])


def _metric(with_wide: str, keys, measure: str, output: str, top: bool, dated: bool) -> str:
    days = ["run_date"] if dated else []
    columns = [*days, *[f"{source} AS {name}" for name, source in keys], f"{measure} AS {output}"]
    grouping = [*days, *[source for _, source in keys]]
    group = f" GROUP BY {', '.join(grouping)}" if grouping else ""
    sql = f"SELECT {', '.join(columns)} FROM wide{group}"
    if top and dated:
        sql = (
            f"SELECT * FROM ({sql}) t QUALIFY row_number() OVER "
            f"(PARTITION BY run_date ORDER BY {_order(keys, output)}) = 1"
        )
    elif top:
        sql = f"SELECT * FROM ({sql}) t ORDER BY {_order(keys, output)} LIMIT 1"
    return f"{with_wide} {sql}"


def _all_metrics(with_wide: str, day: str) -> str:
    """All twelve metrics, per day or for one: metric, day, keys as one text, value."""
    dated, found = day == "run_date", []
    for name, (_, keys, measure, output, top) in zip(METRICS, _METRICS, strict=True):
        key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k, _ in keys) or "''"
        rows = _metric("", keys, measure, output, top, dated)
        found.append(f"SELECT '{name}' AS metric, {day} AS run_date, {key} AS key, CAST({output} AS DOUBLE) AS value FROM ({rows}) t")
    return f"{with_wide} " + " UNION ALL ".join(found)


def _positions(name: str, rows: str) -> str:
    """Rows of a daily metric keyed by day and position."""
    _, keys, _, output, _ = next(m for m in _METRICS if m[0] == name)
    day = "strftime(run_date, '%Y-%m-%d')"
    fields = ", ".join([*[k for k, _ in keys], output])
    return (
        f"SELECT {day} || '_' || row_number() OVER (PARTITION BY run_date ORDER BY {_order(keys, output)}) AS date_id, "
        f"{day} AS static_date, {fields} FROM {rows}"
    )


def _daily_quantities(where: str) -> str:
    return (
        f"(SELECT run_date, product AS Product_ID, category, {UNITS} AS quantity_per_productID "
        f"FROM wide WHERE {where} GROUP BY run_date, product, category) d"
    )


def _rerun(key_sql) -> str:
    wide = _wide().replace("CAST(l_quantity AS BIGINT) AS quantity", "CAST(l_quantity AS BIGINT) AS quantity, l_returnflag AS flag")
    stored, rerun = key_sql(_daily_quantities("flag <> 'R'")), key_sql(_daily_quantities("TRUE"))
    return (
        f"{wide}, stored AS ({stored}), new_rows AS ({rerun}) "
        "SELECT * FROM stored UNION ALL SELECT new_rows.* FROM new_rows "
        "LEFT JOIN stored AS existing ON existing.date_id = new_rows.date_id WHERE existing.date_id IS NULL"
    )


def _hashed(rows: str) -> str:
    fields = ["Product_ID", "category", "quantity_per_productID"]
    text = " || '|' || ".join(
        f"coalesce(length(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields
    )
    day = "strftime(run_date, '%Y-%m-%d')"
    return f"SELECT {day} || '_' || sha256({text}) AS date_id, {day} AS static_date, {', '.join(fields)} FROM {rows}"


_ENRICHED = (
    'SELECT {day}category, price, votes AS "count", rate, buyer AS User_ID, product AS product_ID, quantity, '
    "city, email, firstname, lastname FROM wide"
)

_FLAT_USERS = """SELECT CAST(0 AS BIGINT) AS __V, n_name AS city, CAST(n_nationkey AS VARCHAR) AS lat,
  CAST(n_regionkey AS VARCHAR) AS "long", c_custkey AS number, c_mktsegment AS street,
  CAST(c_nationkey AS VARCHAR) AS zipcode, c_name || '@example.com' AS email, c_custkey AS User_ID,
  split_part(c_name, '#', 1) AS firstname, split_part(c_name, '#', 2) AS lastname,
  sha256(c_name) AS password, c_nationkey || '-' || c_custkey AS phone, c_name AS username
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

_FLAT_PRODUCT = (
    'category, brand AS description, id AS Product_ID, brand || \'/\' || title AS image, price, votes AS "count", rate, title'
)

_CART_LINES = """SELECT CAST(0 AS BIGINT) AS __V, strftime(o_orderdate, '%Y-%m-%d') AS date, {buyer} AS User_ID,
  l_partkey AS product_ID, CAST(l_quantity AS BIGINT) AS quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""


def reference_sql() -> dict[str, str]:
    found = {
        "flatten_users": _FLAT_USERS,
        "flatten_products": f"WITH {PRODUCTS} SELECT {_FLAT_PRODUCT} FROM products",
        "cart_lines": _CART_LINES.format(buyer="o_orderkey"),
        "cart_lines_owner": _CART_LINES.format(buyer="o_custkey"),
        "enrich_left": f"{_wide()} {_ENRICHED.format(day='')}",
        "enrich_cart_id": f"{_wide('o_orderkey')} {_ENRICHED.format(day='')}",
        "enrich_by_week": f"{_wide_weekly()} {_ENRICHED.format(day='run_date, ')}",
        "iso_week_partition": """SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS day,
  CAST(isoyear(o_orderdate) AS BIGINT) AS iso_year, CAST(week(o_orderdate) AS BIGINT) AS iso_week,
  'week_' || isoyear(o_orderdate) || '_' || week(o_orderdate) AS week_folder FROM orders""",
        "monday_refresh": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date, isodow(o_orderdate) = 1 AS due,
  TRUE AS due_if_forced FROM orders""",
        "date_stamped_carts": """SELECT o_orderkey AS id, '2025-04-14' AS date, count(l_orderkey) AS n_products
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
        "date_id_rows": f"""{_wide()} {_positions("rev_prod_cat", f'''(SELECT run_date, category, product AS product_ID,
  {REVENUE} AS revenue_prod_byCat FROM wide GROUP BY run_date, category, product) d''')}""",
        "warehouse_rerun": _rerun(lambda rows: _positions("total_quantity_per_prod", rows)),
        "warehouse_rerun_hash": _rerun(_hashed),
        "landing_roundtrip": """SELECT CAST(o_orderdate AS DATE) AS run_date, o_custkey AS User_ID,
  l_partkey AS product_ID, CAST(l_quantity AS BIGINT) AS quantity, o_orderkey AS cart_id
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
        "weekly_landing_roundtrip": f"""WITH {PRODUCTS}, {WEEKLY_PRODUCTS}
SELECT CAST(iso_year AS BIGINT) AS iso_year, CAST(iso_week AS BIGINT) AS iso_week, {_FLAT_PRODUCT} FROM weekly_products""",
        "json_roundtrip": _FLAT_USERS,
        "json_arrays_users": _FLAT_USERS,
        "json_arrays_products": f"WITH {PRODUCTS} SELECT {_FLAT_PRODUCT} FROM products",
        "json_arrays_carts": _CART_LINES.format(buyer="o_orderkey"),
        "raw_quarantine": """WITH carts AS (
  SELECT o_orderkey AS id, count(l_orderkey) AS n_products, o_orderkey // 500 AS file FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
)
SELECT id, n_products, 'read' AS state FROM carts WHERE file % 7 <> 3 AND (id % 97 <> 0 OR n_products = 0)
UNION ALL SELECT id, NULL, 'a field of another type' FROM carts WHERE file % 7 <> 3 AND id % 97 = 0 AND n_products > 0
UNION ALL SELECT DISTINCT file, CAST(NULL AS BIGINT), 'not one JSON document or array' FROM carts WHERE file % 7 = 3""",
        "csv_roundtrip": """SELECT * REPLACE (CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey,
  CAST(l_suppkey AS INTEGER) AS l_suppkey, CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem""",
        "table_of_path": """SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
    }
    fine = _wide().replace("p_retailprice AS price", "p_retailprice + p_size / 1000000.0 AS price")
    found["m01_fine_prices"] = _metric(fine, *_METRICS[0][1:], dated=False)
    # Whole numbers of 1e-22, from the decimal text of each price.
    found["any_prices"] = f"""WITH {PRODUCTS}, priced AS (
  SELECT id, category, CASE id % 4 WHEN 0 THEN price / 3.0::DOUBLE WHEN 1 THEN price * 1e-7::DOUBLE WHEN 2 THEN price * 1e5::DOUBLE ELSE price END AS price FROM products
),
units AS (SELECT id, category, CAST(replace(CAST(CAST(CAST(price AS VARCHAR) AS DECIMAL(38,22)) AS VARCHAR), '.', '') AS HUGEINT) AS u FROM priced), {_lines("o_custkey")},
wide AS (SELECT l.*, u.category, u.u FROM lines l JOIN units u ON u.id = l.product)
SELECT 'revenue_by_category' AS metric, category AS key, CAST(CAST(sum(u * quantity) AS VARCHAR) || 'e-22' AS DOUBLE) AS value FROM wide GROUP BY category
UNION ALL SELECT 'total_day_revenue', NULL, CAST((2 * sum(u * quantity) + 100000000000000000000) // 200000000000000000000 AS DOUBLE) / 100 FROM wide
UNION ALL SELECT 'avg_ordval_per_user', CAST(buyer AS VARCHAR), CAST((2 * sum(u) + count(*) * 100000000000000000000) // (2 * count(*) * 100000000000000000000) AS DOUBLE) / 100
FROM wide GROUP BY buyer"""
    by_month = ("CAST(o_orderdate AS DATE) AS run_date", "CAST(date_trunc('month', o_orderdate) AS DATE) AS run_date")
    found["warehouse_load"] = found["warehouse_rerun"].replace(*by_month)
    found["warehouse_daily_roundtrip"] = found["warehouse_rerun"]
    found["warehouse_keyed_load"] = found["warehouse_rerun_hash"]
    days = "SELECT DISTINCT date_trunc('month', o_orderdate) AS m, p_type FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey"
    found["table_of_published"] = f"""SELECT 'revenue_by_category' AS table_name, count(*) AS n_rows FROM ({days}) d
UNION ALL SELECT 'total_day_revenue', count(DISTINCT m) FROM ({days}) d"""
    sold = """SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, p_type, p_name, l_partkey
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey"""
    counts = {"rev_prod_cat": "count(DISTINCT (d, p_type, l_partkey))", "revenue_by_category": "count(DISTINCT (d, p_type))"}
    every = [f"SELECT '{name}' AS table_name, {n} AS n FROM ({sold}) s" for name, n in counts.items()]
    every.append("SELECT 'total_day_revenue', count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders")
    found["published_contents"] = f"SELECT table_name, n AS rows_written, n AS rows_found, true AS same FROM ({' UNION ALL '.join(every)}) t"
    for number, (name, *spec) in enumerate(_METRICS, start=1):
        label = f"m{number:02d}"
        found[f"{label}_{name}"] = _metric(_wide(), *spec, dated=False)
        found[f"{label}_by_day"] = _metric(_wide(), *spec, dated=True)
        if any(source in ("buyer", "city") for _, source in spec[0]):
            found[f"{label}_by_cart_id"] = _metric(_wide("o_orderkey"), *spec, dated=False)
        found[f"{label}_by_day_weekly"] = _metric(_wide_weekly(), *spec, dated=True)
    found["enrich_by_validity"] = found["enrich_by_week"]
    for label in ("m02", "m06", "m09"):
        found[f"{label}_by_day_validity"] = found[f"{label}_by_day_weekly"]
    found["validity_intervals"] = f"""WITH {PRODUCTS}, {USERS}, {WEEKLY_PRODUCTS}, {WEEKLY_USERS},
numbered AS (
  SELECT id, city, email, firstname, lastname,
    (date_diff('day', DATE '1970-01-05', CAST(date_trunc('week', make_date(iso_year, 1, 4)) AS DATE)) // 7) + iso_week - 1 AS n
  FROM weekly_users
),
placed AS (SELECT *, n - row_number() OVER (PARTITION BY id ORDER BY n) AS run FROM numbered)
SELECT min(n) AS valid_from, max(n) AS valid_to, id AS User_ID, city, email, firstname, lastname FROM placed GROUP BY run, id, city, email, firstname, lastname"""
    found["publish_roundtrip"] = found["m09_by_day"]
    found["history_roundtrip"] = _all_metrics(_wide_weekly(), "run_date")
    found["history_changes"] = found["history_roundtrip"]
    found["day_roundtrip"] = _all_metrics(_wide("o_orderkey"), "DATE '2025-04-14'")
    found["published_range"] = f"SELECT * FROM ({found['m09_by_day']}) t WHERE run_date BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'"
    return found
