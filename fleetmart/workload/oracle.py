"""The queries again as plain SQL, to check the Spark results against.

Ratios of decimals are computed in integers (cents, metres), since the SQL
engine divides decimals as floating point.
"""

from __future__ import annotations

STAMP = "TIMESTAMP '1995-01-01 00:00:00'"
FIRST_LOAD_END, DAILY_START, RECENT = "1999-01-01", "1998-01-01", "2001-01-01"


def phone(prefix: str, i: str) -> str:
    digits = f"CAST({i} AS VARCHAR)"
    return f"'{prefix}' || lpad({digits}, greatest(7, length({digits}))::INT, '0')"


LINES = """lines AS (
  SELECT l_orderkey, min(l_suppkey) AS driver_id, max(l_quantity) AS quantity, max(l_shipdate) AS shipped
  FROM lineitem GROUP BY l_orderkey)"""

RIDES = LINES + """, rides AS (
  SELECT o_orderkey AS order_id, 'order_ext_' || o_orderkey AS external_order_id, o_custkey AS customer_id, driver_id,
    o_custkey % 25 AS pickup_location_id, o_orderkey % 25 AS dropoff_location_id,
    CAST(substr(o_orderpriority, 1, 1) AS INT) AS tariff_id,
    CAST(o_totalprice AS DECIMAL(10,2)) AS price, CAST(quantity AS DECIMAL(7,3)) AS distance_km,
    o_orderdate AS created_at, CASE WHEN o_orderstatus = 'F' THEN shipped END AS delivered_at,
    ascii(lower(o_orderstatus)) AS current_status
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey),
full_rides AS (SELECT * REPLACE (coalesce(distance_km, 0)::DECIMAL(7,3) AS distance_km) FROM rides)"""

CUSTOMERS = f"""customers AS (
  SELECT c_custkey AS customer_id, 'cust_ext_' || c_custkey AS external_id, c_name AS name,
    {phone('+7999', 'c_custkey')} AS phone, 'user_' || c_custkey || '@example.com' AS email,
    {STAMP} AS created_at
  FROM customer)"""

DRIVERS = f"""drivers AS (
  SELECT s_suppkey AS driver_id, 'drv_ext_' || s_suppkey AS external_id, s_name AS name,
    {phone('+7911', 's_suppkey')} AS phone, 'CAR ' || s_suppkey AS vehicle_number,
    {STAMP} AS created_at
  FROM supplier)"""

LOCATIONS = """locations AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS address, 55 + n_nationkey / 8.0 AS lat, 37 + n_regionkey / 4.0 AS lon
  FROM nation)"""

TARIFFS = f"""tariffs AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS tariff_id, substr(o_orderpriority, 3) AS name,
    CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) * 100 AS base_price, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) * 5 AS per_km,
    {STAMP} AS created_at
  FROM orders)"""

STATUSES = """statuses AS (SELECT DISTINCT ascii(lower(o_orderstatus)) AS status_id, lower(o_orderstatus) AS name FROM orders)"""

DELIVERIES = LINES + """, deliveries AS (
  SELECT o_orderkey, o_orderdate, o_orderstatus, 'order_ext_' || o_orderkey AS external_order_id,
    'cust_ext_' || o_custkey AS customer_external_id, 'drv_ext_' || driver_id AS driver_external_id,
    'NATION_' || (o_custkey % 25) AS pickup_address, 'NATION_' || (o_orderkey % 25) AS dropoff_address,
    substr(o_orderpriority, 3) AS tariff_name, CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS price,
    CAST(CAST(coalesce(quantity, 0) AS DECIMAL(7,3)) AS VARCHAR) AS distance_km,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at,
    CASE WHEN o_orderstatus = 'F' THEN strftime(shipped, '%Y-%m-%dT%H:%M:%S') END AS delivered_at
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey)"""


def half_up(numerator: str, denominator: str) -> str:
    """Nearest integer of a ratio of non-negative integers, halves upward."""
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def minutes(start: str, end: str) -> str:
    return f"CAST(round((epoch_us({end}) - epoch_us({start})) / 60000000.0) AS INT)"


CENTS = "CAST(sum(price) * 100 AS HUGEINT)"
METRES = "CAST(sum(distance_km) * 1000 AS HUGEINT)"


def drivers_mart(rides: str) -> str:
    per_km = half_up(f"{CENTS} * 1000", METRES)
    return f"""SELECT d.driver_id, d.name AS driver_name, d.vehicle_number, count(o.order_id) AS total_rides,
  CAST(sum(price) AS DOUBLE) AS total_revenue,
  CAST({half_up(CENTS, 'count(price)')} AS DOUBLE) / 100 AS avg_order_value,
  CAST(sum(distance_km) AS DOUBLE) AS total_distance_km,
  CASE WHEN sum(distance_km) > 0 THEN CAST({per_km} AS DOUBLE) / 100 ELSE 0.0::DOUBLE END AS revenue_per_km
FROM {rides} o JOIN drivers d ON o.driver_id = d.driver_id GROUP BY ALL"""


def customers_mart(rides: str, customers: str = "customers") -> str:
    return f"""SELECT c.customer_id, c.name AS customer_name, c.email, count(o.order_id) AS total_rides,
  CAST(coalesce(sum(price), 0) AS DOUBLE) AS total_spent,
  CASE WHEN count(price) > 0 THEN CAST({half_up(CENTS, 'count(price)')} AS DOUBLE) / 100 ELSE 0.0::DOUBLE END AS avg_bill,
  CAST(coalesce(sum(distance_km), 0) AS DOUBLE) AS total_distance,
  min(o.created_at) AS first_ride_at, max(o.created_at) AS last_ride_at,
  CAST(extract('day' FROM max(o.created_at) - min(o.created_at)) AS INT) AS customer_lifetime_days
FROM {customers} c LEFT JOIN {rides} o ON c.customer_id = o.customer_id GROUP BY c.customer_id, c.name, c.email"""


def sla_mart(rides: str, statuses: str, tariffs: str = "tariffs") -> str:
    return f"""SELECT o.order_id, o.external_order_id, t.name AS tariff_name, s.name AS final_status,
  o.created_at AS order_created_at, o.delivered_at AS order_delivered_at,
  {minutes('o.created_at', 'o.delivered_at')} AS total_duration_minutes,
  CAST(price AS DOUBLE) AS price, CAST(distance_km AS DOUBLE) AS distance_km
FROM {rides} o JOIN {statuses} s ON o.current_status = s.status_id JOIN {tariffs} t ON o.tariff_id = t.tariff_id"""


ORACLES: dict[str, str] = {
    "driver_efficiency": f"WITH {RIDES}, {DRIVERS} {drivers_mart('full_rides')}",
    "customer_analytics": f"WITH {RIDES}, {CUSTOMERS} {customers_mart('full_rides')}",
    "customer_analytics_recent": f"""WITH {RIDES}, {CUSTOMERS},
recent AS (SELECT * FROM full_rides WHERE created_at >= '{RECENT}') {customers_mart('recent')}""",
    "orders_sla": f"""WITH {RIDES}, {STATUSES}, {TARIFFS},
some_statuses AS (SELECT * FROM statuses WHERE name <> 'p') {sla_mart('full_rides', 'some_statuses')}""",
    "replace_mart": f"""WITH {RIDES}, {DRIVERS},
done AS (SELECT * FROM full_rides WHERE delivered_at IS NOT NULL) {drivers_mart('done')}""",
    "sql_query": f"WITH {RIDES} SELECT driver_id, count(*) AS rides FROM rides WHERE price > 300000 GROUP BY driver_id",
    "daily_slice": f"""WITH {RIDES}, {DRIVERS},
day AS (SELECT * FROM full_rides WHERE created_at >= '{FIRST_LOAD_END}') {drivers_mart('day')}""",
}

# -- cleaning ----------------------------------------------------------------

LINE_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
)
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
DATE = r"^\d{4}-\d{2}-\d{2}"


def stripped(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def by_priority(*choices: str) -> str:
    whens = " ".join(f"WHEN '{n}' THEN {c}" for n, c in enumerate(choices, 1))
    return f"CASE substr(o_orderpriority, 1, 1) {whens} END"


PRICE3 = "CAST(CAST(o_totalprice AS DECIMAL(12,3)) AS VARCHAR)"
OTHER_TIME = by_priority(
    "'10:00'",
    "strftime(o_orderdate, '%Y') || '-02-30'",
    "strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00'",
    "strftime(o_orderdate, '%d.%m.%Y')",
    "NULL",
)

ORACLES |= {
    "dedup_keep_first": f"""SELECT * EXCLUDE (nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS nth FROM lineitem) WHERE nth = 1""",
    "coerce_numeric": f"""WITH raw AS (SELECT o_orderkey, {by_priority(PRICE3, PRICE3 + " || 'd'", "'nan'", "'-' || " + PRICE3 + " || '5'", PRICE3 + " || 'e1'")} AS x FROM orders)
SELECT o_orderkey, CAST(CASE WHEN regexp_matches(x, '{NUMBER}') THEN try_cast(x AS DECIMAL(12,2)) END AS DOUBLE) AS price FROM raw""",
    "coerce_timestamp": f"""SELECT o_orderkey, {by_priority(
        "o_orderdate + INTERVAL 37230250 MILLISECONDS", "o_orderdate + INTERVAL 37230 SECONDS", "o_orderdate",
        "o_orderdate + INTERVAL 37230 SECONDS - INTERVAL 3 HOURS", "NULL")} AS placed,
  CASE WHEN regexp_matches({OTHER_TIME}, '{DATE}') THEN try_cast({OTHER_TIME} AS TIMESTAMP) END AS other FROM orders""",
    "strip_case": f"SELECT doc_id, upper(source) AS source, lower(lang) AS lang, {stripped('text')} AS body FROM documents",
    "na_tokens": f"SELECT o_orderkey, {by_priority('NULL', repr('NA'), 'o_orderstatus', 'NULL', 'NULL')} AS value FROM orders",
    "clean_order_lines": f"""WITH raw AS (
  SELECT *, CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN ' order_ext_' || l_orderkey ELSE 'order_ext_' || l_orderkey END AS k FROM lineitem),
first_raw AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY {LINE_ORDER}, l_linenumber) AS nth FROM raw),
kept AS (
  SELECT *, trim(k) AS external_order_id,
    row_number() OVER (PARTITION BY trim(k) ORDER BY {LINE_ORDER}, l_linenumber) AS again
  FROM first_raw WHERE nth = 1 AND k IS NOT NULL AND l_linenumber NOT IN (1, 3))
SELECT external_order_id, CAST(l_partkey AS VARCHAR) AS customer_external_id, CAST(l_suppkey AS VARCHAR) AS driver_external_id,
  l_linestatus AS pickup_address, l_returnflag AS dropoff_address, 'standard' AS tariff_name,
  CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
  CASE WHEN l_linenumber <> 2 THEN CAST(CAST(l_quantity AS DECIMAL(7,3)) AS DOUBLE) END AS distance_km,
  l_shipdate AS created_at, CAST(NULL AS TIMESTAMP) AS delivered_at,
  CASE l_linenumber WHEN 5 THEN 5 ELSE 6 END AS current_status, CASE l_linenumber WHEN 4 THEN 'delivered_at unreadable' ELSE '' END AS violations
FROM kept WHERE again = 1""",
}

CLEAN = {
    "customers": f"WITH {CUSTOMERS} SELECT external_id, name, phone, email, created_at FROM customers",
    "drivers": f"WITH {DRIVERS} SELECT external_id, name, phone, vehicle_number, created_at FROM drivers",
    "locations": f"WITH {LOCATIONS} SELECT address, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM locations",
    "tariffs": f"WITH {TARIFFS} SELECT name, base_price, per_km, created_at FROM tariffs",
    "statuses": f"WITH {STATUSES} SELECT name FROM statuses",
}
for entity, sql in CLEAN.items():
    ORACLES |= {f"clean_{entity}": sql, f"ingest_{entity}": sql, f"export_{entity}": sql}

# -- quality -----------------------------------------------------------------

ORACLES |= {
    "require_not_null": f"""WITH {RIDES} SELECT order_id, driver_id, delivered_at FROM rides
WHERE driver_id IS NOT NULL AND delivered_at IS NOT NULL""",
    "not_null_violations": f"""WITH {RIDES} SELECT order_id, 'distance_km is null' AS rule FROM rides WHERE distance_km IS NULL""",
    "check_violations": f"""WITH {RIDES} SELECT order_id, 'price_sign' AS rule FROM rides WHERE price - 200000 < 0
UNION ALL SELECT order_id, 'distance_km_sign' FROM rides WHERE distance_km - 25 < 0""",
    "unique_violations": """SELECT l_orderkey || '-' || l_linenumber AS external_order_id, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "fk_orphans": """SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders
WHERE o_orderpriority NOT LIKE '1%' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
    "decimal_rounding": """SELECT l_orderkey, l_linenumber, CAST(sum((
  CAST(round(l_extendedprice * 100) AS HUGEINT) * CAST(round(l_discount * 100) AS HUGEINT) + 50) // 100) AS DOUBLE) / 100 AS discount
FROM lineitem GROUP BY l_orderkey, l_linenumber""",
}

# -- keys and merge ----------------------------------------------------------

ORDER_COLUMNS = """order_id, external_order_id, customer_id, driver_id, pickup_location_id, dropoff_location_id, tariff_id,
  CAST(price AS DOUBLE) AS price, CAST(distance_km AS DOUBLE) AS distance_km, created_at, delivered_at, current_status"""


def inserted(stored: str, batch: str, columns: str, key: str, identity: str, order: str) -> str:
    """Stored rows, then the first row of each new key under the next ids."""
    return f"""stored AS ({stored}), batch AS ({batch}),
firsts AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS nth FROM batch),
fresh AS (SELECT * FROM firsts WHERE nth = 1 AND {key} NOT IN (SELECT {key} FROM stored))
SELECT {identity}, {columns} FROM stored
UNION ALL
SELECT (SELECT coalesce(max({identity}), 0) FROM stored) + row_number() OVER (ORDER BY {order}), {columns} FROM fresh"""


def upserted(delivered_at: str, current_status: str) -> str:
    return f"""WITH {RIDES},
stored AS (SELECT * FROM full_rides WHERE created_at < '{FIRST_LOAD_END}'),
batch AS (SELECT * FROM full_rides WHERE created_at >= '{DAILY_START}'),
result AS (
  SELECT s.* REPLACE (
    CASE WHEN b.order_id IS NULL THEN s.driver_id END AS driver_id,
    CASE WHEN b.order_id IS NULL THEN s.price ELSE b.price + 1 END AS price,
    CASE WHEN b.order_id IS NULL THEN s.distance_km ELSE b.distance_km + 1 END AS distance_km,
    CASE WHEN b.order_id IS NULL THEN s.delivered_at ELSE {delivered_at} END AS delivered_at,
    CASE WHEN b.order_id IS NULL THEN s.current_status ELSE {current_status} END AS current_status)
  FROM stored s LEFT JOIN batch b ON s.external_order_id = b.external_order_id
  UNION ALL
  SELECT (SELECT max(order_id) FROM stored) + row_number() OVER (ORDER BY order_id), external_order_id, customer_id + 1, NULL,
    pickup_location_id + 1, dropoff_location_id + 1, tariff_id + 1, price + 1, distance_km + 1,
    created_at + INTERVAL 1 HOUR, {delivered_at}, {current_status}
  FROM batch b WHERE external_order_id NOT IN (SELECT external_order_id FROM stored))
SELECT {ORDER_COLUMNS} FROM result"""


ORACLES |= {
    "resolve_keys": f"""WITH {DELIVERIES}, {TARIFFS}
SELECT external_order_id, c_custkey AS customer_id, s_suppkey AS driver_id, CAST(p.n_nationkey AS BIGINT) AS pickup_location_id,
  CAST(q.n_nationkey AS BIGINT) AS dropoff_location_id, tariff_id
FROM deliveries LEFT JOIN customer ON customer_external_id = 'cust_ext_' || c_custkey
LEFT JOIN supplier ON driver_external_id = 'drv_ext_' || s_suppkey AND s_acctbal >= 0
LEFT JOIN nation p ON pickup_address = p.n_name LEFT JOIN nation q ON dropoff_address = q.n_name
LEFT JOIN tariffs t ON tariff_name = t.name""",
    "insert_customers": f"""WITH {CUSTOMERS}, {inserted(
        "SELECT * FROM customers WHERE customer_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)",
        f"SELECT 'cust_ext_' || o_custkey AS external_id, 'by order ' || o_orderkey AS name, NULL::VARCHAR AS phone, NULL::VARCHAR AS email, {STAMP} AS created_at, o_orderkey FROM orders",
        "external_id, name, phone, email, created_at", "external_id", "customer_id", "o_orderkey")}""",
    "insert_drivers": f"""WITH {LINES}, {DRIVERS}, {inserted(
        "SELECT * FROM drivers WHERE driver_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)",
        f"SELECT 'drv_ext_' || driver_id AS external_id, 'by order ' || l_orderkey AS name, NULL::VARCHAR AS phone, 'NEW ' || driver_id AS vehicle_number, {STAMP} AS created_at, l_orderkey FROM lines",
        "external_id, name, phone, vehicle_number, created_at", "external_id", "driver_id", "l_orderkey")}""",
    "insert_locations": f"""WITH {LOCATIONS}, {inserted(
        "SELECT location_id, address, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM locations WHERE address < 'NATION_2'",
        "SELECT 'NATION_' || (o_custkey % 25) AS address, NULL::DOUBLE AS lat, NULL::DOUBLE AS lon, o_orderkey FROM orders",
        "address, lat, lon", "address", "location_id", "o_orderkey")}""",
    "insert_tariffs": f"""WITH {TARIFFS}, {inserted(
        "SELECT * FROM tariffs WHERE name IN ('HIGH', 'LOW')",
        f"SELECT substr(o_orderpriority, 3) AS name, 300.0::DOUBLE AS base_price, 0.0::DOUBLE AS per_km, {STAMP} AS created_at, o_orderkey FROM orders",
        "name, base_price, per_km, created_at", "name", "tariff_id", "o_orderkey")}""",
    "insert_statuses": f"""WITH {STATUSES}, {inserted(
        "SELECT * FROM statuses WHERE name = 'f'", "SELECT lower(o_orderstatus) AS name, o_orderkey FROM orders",
        "name", "name", "status_id", "o_orderkey")}""",
    "number_rows": "SELECT o_orderkey, o_orderdate, 1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id FROM orders",
    "upsert_orders": upserted("b.created_at + INTERVAL 2 HOURS", "b.current_status + 1"),
    "upsert_missing_columns": upserted("CAST(NULL AS TIMESTAMP)", "1"),
    "restart_identity": f"""WITH {CUSTOMERS} SELECT row_number() OVER (ORDER BY external_id) AS customer_id, external_id FROM customers""",
}

# -- deletes, events, export -------------------------------------------------

# Notes of the event log.
NOTE_CREATED, NOTE_DONE, NOTE_CANCELLED = "Заказ зарегистрирован в системе", "Заказ успешно выполнен", "Заказ отменен"
CODE = "CASE o_orderstatus WHEN 'F' THEN 5 WHEN 'O' THEN 6 ELSE 3 END"
EVENTS = LINES + f""", log AS (
  SELECT o_orderkey AS order_id, 0 AS turn, 1 AS status_id, o_orderdate AS event_time, '{NOTE_CREATED}' AS note
  FROM orders
  UNION ALL
  SELECT o_orderkey, 1, {CODE}, coalesce(CASE WHEN o_orderstatus = 'F' THEN shipped END, o_orderdate + INTERVAL 5 MINUTES),
    CASE {CODE} WHEN 5 THEN '{NOTE_DONE}' ELSE '{NOTE_CANCELLED}' END
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey WHERE {CODE} IN (5, 6))"""

ORACLES |= {
    "delete_restrict": """SELECT c_custkey AS customer_id FROM customer
WHERE c_acctbal >= 0 OR c_custkey IN (SELECT o_custkey FROM orders)""",
    "blocked_parents": f"""SELECT c_custkey AS customer_id FROM customer WHERE c_acctbal < 0
AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= '{RECENT}')""",
    "delete_set_null": f"""WITH {RIDES} SELECT order_id, CASE WHEN s_suppkey IS NULL THEN driver_id END AS driver_id, CAST(price AS DOUBLE) AS price
FROM rides LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) ON driver_id = s_suppkey""",
    "delete_cascade": f"""WITH {EVENTS} SELECT order_id, status_id, event_time, note FROM log
WHERE order_id IN (SELECT o_orderkey FROM orders JOIN lines ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F')""",
    "order_events": f"""WITH {EVENTS} SELECT row_number() OVER (ORDER BY turn, order_id) AS event_id, order_id, status_id, event_time, note FROM log""",
    "export_order_file": f"""WITH {RIDES}, {TARIFFS}
SELECT external_order_id, 'cust_ext_' || c_custkey AS customer_external_id, 'drv_ext_' || s_suppkey AS driver_external_id,
  p.n_name AS pickup_address, q.n_name AS dropoff_address, t.name AS tariff_name, CAST(price AS DOUBLE) AS price,
  CAST(distance_km AS DOUBLE) AS distance_km, r.created_at, delivered_at, current_status
FROM full_rides r JOIN customer ON customer_id = c_custkey LEFT JOIN supplier ON driver_id = s_suppkey
JOIN nation p ON pickup_location_id = p.n_nationkey JOIN nation q ON dropoff_location_id = q.n_nationkey
JOIN tariffs t ON r.tariff_id = t.tariff_id""",
}

# -- generator ---------------------------------------------------------------

SPAN = 2**32


def named(expression: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for the expression."""
    return f"list_transform([{expression}], lambda {name}: {body})[1]"


def draw(salt: int, seed: int = 1) -> str:
    """The generator's integer draw for row ``i``."""
    start = (seed * 64 + salt) * 2654435761 % SPAN
    inner = (start ^ start >> 16) * 73244475 % SPAN
    turn = f"(xor(h, h >> 16) * 73244475) % {SPAN}"
    h = named(f"(i + {start}) % {SPAN}", "h", turn)
    h = named(f"xor({h}, ((i >> 32) * 2654435761 + {inner}) % {SPAN})", "h", turn)
    return named(h, "h", "xor(h, h >> 16)")


def below(salt: int, n: int) -> str:
    return f"((h{salt} * {n}) >> 32)"


def rounded(salt: int, width: int) -> str:
    return f"((h{salt} * {width} + {SPAN // 2}) >> 32)"


def drawn(table: str, key: str, *salts: int, stride: int = 1) -> str:
    """Rows numbered from one, with the draws they need as h<salt>."""
    draws = ", ".join(f"{draw(s)} AS h{s}" for s in salts)
    return f"rows AS (SELECT i, {draws} FROM (SELECT CAST({key} AS BIGINT) * {stride} + 1 AS i FROM {table}))"


def moment(start: str, salt: int, seconds: int, extra: int = 0) -> str:
    span = f"h{salt} * {seconds}"
    us = f"(({span}) >> 32) * 1000000 + ((({span}) % {SPAN} * 1000000) >> 32) + {extra}"
    return f"make_timestamp(epoch_us({start}) + {us})"


# Letters of plates.
LETTERS = "['А','В','Е','К','М','Н','О','Р','С','Т','У','Х']"
PLATE = (
    f"{LETTERS}[i % 12 + 1] || lpad(CAST((i * 7) % 1000 AS VARCHAR), 3, '0') || "
    f"{LETTERS}[(i // 12) % 12 + 1] || {LETTERS}[(i // 144) % 12 + 1] || '66' || "
    "CASE WHEN i > 216000 THEN '-' || ((i - 1) // 216000) ELSE '' END"
)
YEAR_START, ORDER_START = "TIMESTAMP '2026-01-01'", "TIMESTAMP '2026-02-01'"
DAY = 86_400

# Names of statuses and tariffs.
STATUS_ROWS = """statuses(status_id, name) AS (VALUES (1, 'Создан'), (2, 'Водитель назначен'), (3, 'Машина подъехала'), (4, 'В пути'),
  (5, 'Завершен'), (6, 'Отменен'))"""
TARIFF_ROWS = "tariffs(tariff_id, name) AS (VALUES (1, 'Эконом'), (2, 'Комфорт'), (3, 'Бизнес'), (4, 'Минивэн'), (5, 'Доставка'))"

FAR_NUMBERS, FAR_ORDERS = 70_001, 3_000_017


def gen_orders(stride: int = 1) -> str:
    return f"""{drawn('orders', 'o_orderkey', 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, stride=stride)}, placed AS (
  SELECT *, CAST(CASE WHEN h5 * 100 < {85 * SPAN} THEN 5 WHEN h5 * 100 < {95 * SPAN} THEN 6 ELSE 1 + {below(6, 4)} END AS INT) AS current_status,
    {moment(ORDER_START, 10, 45 * DAY)} AS created_at FROM rows), made AS (
  SELECT i AS order_id, 'order_ext_' || i AS external_order_id, 1 + {below(11, 10_000)} AS customer_id,
    CASE WHEN h7 * 100 >= {10 * SPAN} THEN 1 + {below(8, 2_000)} END AS driver_id,
    1 + {below(12, 5_000)} AS pickup_location_id, 1 + {below(13, 5_000)} AS dropoff_location_id,
    CAST(1 + {below(14, 5)} AS INT) AS tariff_id, CAST(15000 + {rounded(15, 235_000)} AS DOUBLE) / 100 AS price,
    CAST(1000 + {rounded(16, 59_000)} AS DOUBLE) / 1000 AS distance_km, created_at,
    CASE WHEN current_status = 5 THEN {moment('created_at', 9, 3_000, 600_000_000)} END AS delivered_at, current_status
  FROM placed)"""


def gen_customers(stride: int = 1) -> str:
    return f"""WITH {drawn('customer', 'c_custkey', 3, stride=stride)} SELECT i AS customer_id, 'cust_ext_' || i AS external_id, 'Клиент ' || i AS name,
  {phone('+7999', 'i')} AS phone, 'user_' || i || '@example.com' AS email, {moment(YEAR_START, 3, 45 * DAY)} AS created_at FROM rows"""


def gen_drivers(stride: int = 1) -> str:
    return f"""WITH {drawn('customer', 'c_custkey', 4, stride=stride)} SELECT i AS driver_id, 'drv_ext_' || i AS external_id, 'Водитель ' || i AS name,
  {phone('+7911', 'i')} AS phone, {PLATE} AS vehicle_number, {moment(YEAR_START, 4, 30 * DAY)} AS created_at FROM rows"""


ORACLES |= {
    "gen_locations": f"""WITH {drawn('part', 'p_partkey', 1, 2)} SELECT i AS location_id, 'ул. Генерации, д. ' || i AS address,
  CAST(55500000 + {rounded(1, 400_000)} AS DOUBLE) / 1000000 AS lat, CAST(37300000 + {rounded(2, 600_000)} AS DOUBLE) / 1000000 AS lon FROM rows""",
    "gen_customers": gen_customers(),
    "gen_customers_far": gen_customers(FAR_NUMBERS),
    "gen_drivers": gen_drivers(),
    "gen_drivers_far": gen_drivers(FAR_NUMBERS),
    "gen_orders": f"WITH {gen_orders()} SELECT * FROM made",
    "gen_orders_far": f"WITH {gen_orders(FAR_ORDERS)} SELECT * FROM made",
    "gen_orders_sla": f"""WITH {gen_orders()},
{STATUS_ROWS},
{TARIFF_ROWS},
sla AS ({sla_mart('made', 'statuses')})
SELECT tariff_name, final_status, count(*) AS orders, CAST(sum(total_duration_minutes) AS BIGINT) AS minutes,
  CAST(sum(CAST(price AS DECIMAL(10,2))) AS DOUBLE) AS revenue FROM sla GROUP BY tariff_name, final_status""",
}

# -- files and pipelines -----------------------------------------------------

# Texts that stand for a missing value.
NA_TEXTS = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)

# Ids as a load gives them: by file order, from one.
LOADED = f"""loaded_customers AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS customer_id, c_custkey, c_name AS name, 'user_' || c_custkey || '@example.com' AS email
  FROM customer),
loaded_drivers AS (
  SELECT row_number() OVER (ORDER BY s_suppkey) AS driver_id, s_suppkey, s_name AS name, 'CAR ' || s_suppkey AS vehicle_number
  FROM supplier),
loaded_tariffs AS (SELECT row_number() OVER (ORDER BY tariff_id) AS tariff_id, name FROM tariffs),
loaded_statuses(status_id, name) AS (VALUES (1, 'f'), (2, 'o'), (3, 'p'))"""


def loaded_orders(numbering: str, price: str, distance: str = "r.distance_km", driver: str = "ld.driver_id") -> str:
    return f"""loaded AS (
  SELECT {numbering} AS order_id, r.external_order_id, c.customer_id, {driver} AS driver_id, lt.tariff_id, {price} AS price, {distance} AS distance_km,
    r.created_at, r.delivered_at, CASE chr(r.current_status) WHEN 'f' THEN 1 WHEN 'o' THEN 2 ELSE 3 END AS current_status
  FROM full_rides r JOIN loaded_customers c ON r.customer_id = c.c_custkey LEFT JOIN loaded_drivers ld ON r.driver_id = ld.s_suppkey
  JOIN tariffs t ON r.tariff_id = t.tariff_id JOIN loaded_tariffs lt ON t.name = lt.name)"""


ORACLES |= {
    "ingest_orders": f"""WITH {DELIVERIES} SELECT external_order_id, customer_external_id, driver_external_id,
  '"A, B" ' || pickup_address AS pickup_address, dropoff_address, CASE WHEN tariff_name <> 'LOW' THEN tariff_name END AS tariff_name,
  price, distance_km, created_at, delivered_at, '1' AS current_status FROM deliveries""",
    "csv_texts": f"""SELECT doc_id, CASE WHEN text NOT IN ({NA_TEXTS}) THEN text END AS text, false AS _overflow FROM documents""",
    "daily_layers": f"""SELECT o_orderkey AS order_id, CAST(CAST(o_totalprice AS DECIMAL(10,2)) + CASE WHEN o_orderdate >= '{FIRST_LOAD_END}' THEN 1 ELSE 0 END AS DOUBLE) AS price,
  o_orderdate AS created_at, CASE WHEN o_orderdate >= '{FIRST_LOAD_END}' THEN '1999_01_01' ELSE '1998_12_31' END AS ds FROM orders""",
    "run_full": f"""WITH {RIDES}, {TARIFFS}, {LOADED}, {loaded_orders("row_number() OVER (ORDER BY r.order_id)", "r.price")}
{customers_mart('loaded', 'loaded_customers')}""",
    "run_full_drivers": f"""WITH {RIDES}, {DRIVERS}, {TARIFFS}, {LOADED}, {loaded_orders("row_number() OVER (ORDER BY r.order_id)", "r.price")}
{drivers_mart('loaded').replace('JOIN drivers', 'JOIN loaded_drivers')}""",
    "run_full_sla": f"""WITH {RIDES}, {TARIFFS}, {LOADED}, {loaded_orders("row_number() OVER (ORDER BY r.order_id)", "r.price")}
{sla_mart('loaded', 'loaded_statuses', 'loaded_tariffs')}""",
}

# The increment: new orders after the stored ones, re-delivered ones changed.
IN_DAY = f"r.created_at >= '{DAILY_START}'"
DAILY = f"""WITH {RIDES}, {DRIVERS}, {TARIFFS}, {LOADED}, {loaded_orders(
    f"row_number() OVER (ORDER BY r.created_at >= '{FIRST_LOAD_END}', r.order_id)",
    f"r.price + CASE WHEN {IN_DAY} THEN 1 ELSE 0 END",
    f"r.distance_km + CASE WHEN {IN_DAY} THEN 2 ELSE 0 END",
    f"CASE WHEN {IN_DAY} AND r.order_id % 4 = 0 THEN (SELECT driver_id FROM loaded_drivers WHERE s_suppkey = 3) ELSE ld.driver_id END")}"""
ORACLES |= {
    "run_daily": f"{DAILY} {sla_mart('loaded', 'loaded_statuses', 'loaded_tariffs')}",
    "run_daily_drivers": f"{DAILY} {drivers_mart('loaded').replace('JOIN drivers', 'JOIN loaded_drivers')}",
    "run_daily_customers": f"{DAILY} {customers_mart('loaded', 'loaded_customers')}",
}

# Values that the cleaners turn into NULL.
ORACLES |= {
    "clean_customers": CLEAN["customers"].replace("created_at FROM customers", "CASE WHEN customer_id % 3 <> 0 THEN created_at END AS created_at FROM customers"),
    "clean_locations": f"""WITH {LOCATIONS} SELECT address, CASE WHEN location_id % 3 <> 0 THEN CAST(lat AS DOUBLE) END AS lat, CAST(lon AS DOUBLE) AS lon FROM locations""",
    "clean_tariffs": f"""WITH {TARIFFS} SELECT name, CASE WHEN tariff_id <> 2 THEN base_price END AS base_price, per_km,
  CASE WHEN tariff_id <> 3 THEN created_at END AS created_at FROM tariffs""",
    "daily_columns": f"""SELECT o_orderkey AS order_id, CASE WHEN o_orderdate >= '{FIRST_LOAD_END}' THEN o_orderdate END AS placed_at FROM orders""",
    "csv_malformed": f"""SELECT doc_id, CASE WHEN doc_id % 3 <> 1 AND text NOT IN ({NA_TEXTS}) THEN text END AS text,
  doc_id % 3 = 2 AS _overflow, CASE WHEN doc_id % 3 = 1 THEN NULL ELSE length(text) END AS chars FROM lined""",
    "append_orders": f"""WITH {RIDES}, {TARIFFS}, {LOADED}, {loaded_orders(
        "row_number() OVER (ORDER BY r.order_id % 2, r.order_id)", "r.price")}
SELECT order_id, external_order_id, CAST(price AS DOUBLE) AS price, true AS files_stayed FROM loaded""",
    "rejects_twice": f"""SELECT 'order_ext_' || o_orderkey AS external_order_id, 'customer_id is null' AS violations FROM orders WHERE o_custkey % 2 = 0""",
}
ORACLES["csv_malformed"] = (
    "WITH lined AS (SELECT doc_id, replace(replace(text, chr(10), ' '), chr(13), ' ') AS text FROM documents) " + ORACLES["csv_malformed"]
)

# Events and deletes on stored tables; gates of a delivered file.
ORACLES |= {
    "append_events": """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS event_id, o_orderkey AS order_id,
  CASE o_orderstatus WHEN 'F' THEN 2 ELSE 1 END AS status_id, o_orderdate AS event_time, 'placed' AS note FROM orders""",
    "stored_delete_orders": f"""SELECT o_orderkey AS order_id, what FROM orders, (VALUES ('order'), ('event')) t(what) WHERE o_orderdate < '{RECENT}'""",
    "stored_delete_drivers": f"""WITH {RIDES} SELECT order_id, CASE WHEN s_suppkey IS NULL THEN driver_id END AS driver_id
FROM rides LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) ON driver_id = s_suppkey""",
    "stored_delete_customers": "SELECT c_custkey AS customer_id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
    "input_gates": """SELECT * FROM (VALUES ('missing', 'FileNotFoundError'), ('empty', 'QualityError'), ('incomplete', 'QualityError')) t("case", outcome)
UNION ALL SELECT c, count(*) || CASE c WHEN 'unknown' THEN ' tip' ELSE '' END FROM orders, (VALUES ('complete'), ('bom'), ('unknown')) t(c) GROUP BY c""",
}

# The same deletes where no table is small enough to be sent.
ORACLES |= {f"{name}_far": ORACLES[name] for name in ("stored_delete_orders", "stored_delete_drivers", "stored_delete_customers")}

# What readers see of changes that were stopped, of runs delivered again, and of versions that were cleaned up.
ORACLES |= {
    "stopped_changes": """SELECT o_orderkey AS id, what, 2 AS stopped FROM orders, (VALUES ('orders'), ('order_events')) t(what)
UNION ALL SELECT c_custkey, 'customers', 2 FROM customer""",
    "append_events_once": f"""WITH placed AS (
  SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS event_id, o_orderkey AS order_id,
    CASE o_orderstatus WHEN 'F' THEN 2 ELSE 1 END AS status_id, o_orderdate AS event_time FROM orders
), again AS (
  SELECT *, (SELECT count(*) FROM orders) + row_number() OVER (ORDER BY event_time >= '{FIRST_LOAD_END}', event_time, order_id) AS new_id FROM placed
)
SELECT event_id, order_id, status_id, event_time, 'placed' AS note FROM placed
UNION ALL SELECT new_id, order_id, status_id, event_time, 'seen' FROM again""",
    "read_through_clean_up": f"""WITH {RIDES} SELECT order_id, price::DOUBLE AS price, 'then' AS seen FROM full_rides
UNION ALL SELECT order_id, price::DOUBLE, 'now' FROM full_rides WHERE order_id % 2 <> 0""",
}

# A small day through the key index: what is stored then, and how many of its buckets hold keys of the day.
BUCKET = "('0x' || substr(md5({}), 1, 8))::BIGINT % 64"
ORACLES["indexed_upsert"] = f"""WITH stored AS (
  SELECT 'order_ext_' || o_orderkey AS external_order_id, o_totalprice::DOUBLE AS price, o_orderkey % 500 = 3 AS again FROM orders
), new AS (
  SELECT 'new_' || external_order_id AS external_order_id, price FROM stored WHERE again
), asked AS (
  SELECT {BUCKET.format("external_order_id")} AS bucket FROM (SELECT external_order_id FROM new UNION ALL SELECT external_order_id FROM stored WHERE again)
), numbers AS (
  SELECT (SELECT count(DISTINCT bucket) FROM asked WHERE bucket IN (SELECT {BUCKET.format("external_order_id")} FROM stored))::INTEGER AS buckets_read,
    (SELECT count(*) FROM stored WHERE again) AS keys_found
)
SELECT external_order_id, price + CASE WHEN again THEN 1 ELSE 0 END AS price, buckets_read, keys_found FROM stored, numbers
UNION ALL SELECT external_order_id, price, buckets_read, keys_found FROM new, numbers"""

# Keys resolved where no dimension is small enough to be sent; default times; columns too many; a round trip.
ORACLES |= {
    "resolve_keys_far": ORACLES["resolve_keys"],
    "insert_without_times": """SELECT row_number() OVER (ORDER BY first) AS customer_id, 'cust_ext_' || o_custkey AS external_id, true AS recent
FROM (SELECT o_custkey, min(o_orderkey) AS first FROM orders GROUP BY o_custkey)""",
    "unknown_columns": """SELECT row_number() OVER (ORDER BY c_custkey) AS customer_id, 'cust_ext_' || c_custkey AS external_id, c_custkey % 3 AS tip, true AS refused
FROM customer""",
    "round_trip": """SELECT 'orders' AS name, count(*) AS n, true AS same FROM orders UNION ALL SELECT 'customers', count(*), true FROM customer
UNION ALL SELECT 'drivers', count(*), true FROM supplier UNION ALL SELECT 'locations', count(*), true FROM part
UNION ALL SELECT name, n, true FROM (VALUES ('tariffs', 5), ('order_statuses', 6)) t(name, n)""",
}
