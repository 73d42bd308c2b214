"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each text runs on DuckDB over the supplied tables registered as views of the
same names.  The derived views come in as a ``WITH`` clause; the logic on top
is written directly in SQL, row-level and without the rewrites the Spark plans
use (no eager aggregation, no telescoping, no semi joins).
"""

from __future__ import annotations

from loomstar.plans.fixtures import oracle_cte
from loomstar.plans.queries import ONE_COUNTRY

ORACLE: dict[str, str] = {}

# Lines with their exact amount, one row per line and listed product; the questions
# about stores and dates look facts up for each line instead of joining the star.
_LINES = """, lines AS (
  SELECT f.date_key, f.store_code, f.product_quantity AS pieces,
         CAST(f.product_quantity AS DECIMAL(12,2)) * CAST(q.product_price AS DECIMAL(12,2)) AS amount
  FROM fact f, product q WHERE q.product_code = f.product_code)
"""
_MONEY = "CAST(ROUND(SUM(amount), 2) AS DOUBLE)"

ORACLE["stores_per_country"] = oracle_cte("fact", "store") + """
SELECT country_code, CAST(COUNT(*) AS BIGINT) AS num_stores
FROM (SELECT DISTINCT country_code, store_code FROM store WHERE store_code IN (SELECT store_code FROM fact)) u
GROUP BY country_code
"""

ORACLE["stores_per_locality_top7"] = oracle_cte("fact", "store") + """
SELECT locality, num_stores FROM (
  SELECT locality, CAST(COUNT(*) AS BIGINT) AS num_stores,
         ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, locality ASC NULLS LAST) AS place
  FROM (SELECT DISTINCT locality, store_code FROM store WHERE EXISTS
        (SELECT 1 FROM fact WHERE fact.store_code = store.store_code)) u
  GROUP BY locality) ranked
WHERE place <= 7
"""

ORACLE["sales_total"] = oracle_cte("fact", "product") + _LINES + f"""
SELECT {_MONEY} AS total_sales FROM lines
"""

ORACLE["sales_by_month_top6"] = oracle_cte("fact", "date_dim", "product") + _LINES + f""",
per_day AS (SELECT date_key, SUM(amount) AS amount FROM lines GROUP BY date_key),
per_month AS (SELECT month, {_MONEY} AS total_sales FROM date_dim, per_day WHERE per_day.date_key = date_dim.date_key GROUP BY month)
SELECT total_sales, month FROM per_month AS a
WHERE (SELECT COUNT(*) FROM per_month AS b WHERE b.total_sales > a.total_sales OR (b.total_sales = a.total_sales AND b.month < a.month)) < 6
"""

ORACLE["online_vs_offline"] = oracle_cte("fact", "store", "product") + _LINES + """,
placed AS (SELECT pieces, unnest((SELECT list(CASE WHEN store_type = 'Web Portal' THEN 'Online' ELSE 'Offline' END)
                                  FROM store WHERE store.store_code = lines.store_code)) AS location FROM lines)
SELECT location, CAST(COUNT(*) AS BIGINT) AS total_sales, CAST(SUM(pieces) AS BIGINT) AS total_products_sold
FROM placed GROUP BY location
"""

ORACLE["sales_share_by_type"] = oracle_cte("fact", "store", "product") + _LINES + """,
per_code AS (SELECT store_code, SUM(amount) AS amount FROM lines GROUP BY store_code),
whole AS (SELECT store_code, amount, SUM(amount) OVER () AS everything FROM per_code)
SELECT store_type, CAST(ROUND(SUM(amount), 2) AS DOUBLE) AS total_sales,
       ROUND(CAST(SUM(amount) AS DOUBLE) * 100 / CAST(MAX(everything) AS DOUBLE), 2) AS percentage_total
FROM store NATURAL JOIN whole
GROUP BY store_type
"""

ORACLE["sales_by_year_month_top10"] = oracle_cte("fact", "store", "product", "date_dim") + _LINES + f""",
listed AS (SELECT store_code, COUNT(*) AS times FROM store GROUP BY store_code),
per_day AS (SELECT date_key, SUM(amount * times) AS amount FROM lines NATURAL JOIN listed GROUP BY date_key),
per_month AS (SELECT year, month, {_MONEY} AS total_sales FROM per_day NATURAL JOIN date_dim GROUP BY year, month)
SELECT total_sales, year, month FROM per_month
QUALIFY ROW_NUMBER() OVER (ORDER BY total_sales DESC, year, month) <= 10
"""

ORACLE["staff_by_country"] = oracle_cte("store") + """
SELECT CAST(SUM(staff_numbers) AS BIGINT) AS total_staff_numbers, country_code
FROM store
GROUP BY country_code
ORDER BY total_staff_numbers DESC NULLS FIRST, country_code
"""

ORACLE["sales_by_type_one_country"] = oracle_cte("fact", "store", "product") + _LINES + f""",
local AS (SELECT store_code, store_type FROM store WHERE country_code = '{ONE_COUNTRY}'),
per_type AS (SELECT store_type, {_MONEY} AS total_sales FROM local NATURAL JOIN lines GROUP BY store_type)
SELECT total_sales, store_type, '{ONE_COUNTRY}' AS country_code FROM per_type
QUALIFY ROW_NUMBER() OVER (ORDER BY total_sales ASC NULLS LAST, store_type ASC NULLS LAST) <= 10
"""

# The next time of a row: the following one in the year's ordered list of times.
_NEXT = """, listed AS (
  SELECT year, list(struct_pack(datetime, date_key) ORDER BY datetime ASC NULLS LAST, date_key) AS days FROM date_dim GROUP BY year),
placed AS (SELECT year, days, unnest(range(1, len(days) + 1)) AS i FROM listed),
gaps AS (SELECT days[i].date_key AS date_key, year, days[i].datetime AS datetime, days[i + 1].datetime AS next_datetime FROM placed)
"""
_MEAN = """CAST(SUM(epoch_us(next_datetime) - epoch_us(datetime)) AS DOUBLE)
       / NULLIF(COUNT(epoch_us(next_datetime) - epoch_us(datetime)), 0) / 1e6"""

ORACLE["next_event_gap"] = oracle_cte("date_dim") + _NEXT + """
SELECT date_key, year, datetime, next_datetime, epoch_us(next_datetime) - epoch_us(datetime) AS gap_us FROM gaps
"""

ORACLE["avg_gap_by_year"] = oracle_cte("date_dim") + _NEXT + f"""
SELECT year, {_MEAN} AS actual_time_taken FROM gaps GROUP BY year
"""

ORACLE["avg_gap_telescoped"] = ORACLE["avg_gap_by_year"]

ORACLE["avg_gap_by_year_top5"] = oracle_cte("date_dim") + _NEXT + f""",
means AS (SELECT year, {_MEAN} AS actual_time_taken FROM gaps GROUP BY year)
SELECT year, actual_time_taken FROM means
QUALIFY ROW_NUMBER() OVER (ORDER BY actual_time_taken DESC NULLS FIRST, year) <= 5
"""


# --- cleaning operators ---------------------------------------------------------
# Small SQL text helpers: each returns a DuckDB expression for one column.

_JUNK = r"[A-Z0-9]{10}\n?"
_TOKENS = ", ".join("'" + t.replace("'", "''") + "'" for t in (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"))
_DATE_FORMATS = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d", "%Y-%m", "%Y%m%d",
                 "%Y.%m.%d", "%Y/%m/%d", "%m/%d/%Y", "%d/%m/%Y", "%m-%d-%Y", "%d-%m-%Y", "%Y %B %d", "%Y %b %d", "%B %Y %d", "%b %Y %d",
                 "%B %d %Y", "%b %d %Y", "%d %B %Y", "%d %b %Y", "%B %Y", "%b %Y", "%Y", "%B %d, %Y", "%b %d, %Y", "%d-%b-%Y",
                 "%Y-%m-%d %H:%M:%S.%g", "%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%dT%H:%M", "%a %d %b %Y", "%m.%d.%Y", "%d.%m.%Y")


def _junk(c: str) -> str:
    return f"CASE WHEN regexp_full_match(CAST({c} AS VARCHAR), '{_JUNK}') THEN NULL ELSE {c} END"


def _mixed_date(c: str) -> str:
    plain = f"regexp_replace(replace(trim({c}), 'Sept ', 'Sep '), '([0-9])(st|nd|rd|th) ', '\\1 ')"
    t = "COALESCE(" + ", ".join(f"CAST(try_strptime({plain}, '{f}') AS TIMESTAMP)" for f in _DATE_FORMATS) + ")"
    return f"CASE WHEN year({t}) BETWEEN 1677 AND 2262 THEN CAST({t} AS DATE) END"


def _weight_kg(c: str) -> str:
    t = f"replace(replace({c}, ' ', ''), 'x', '*')"
    unit = f"NULLIF(regexp_extract({t}, '([a-zA-Z]+)', 1), '')"
    num = f"NULLIF(regexp_extract({t}, '([0-9]+\\.[0-9]+|[0-9]+\\*[0-9]+|[0-9]+)', 1), '')"
    factor = (f"CASE {unit} WHEN 'g' THEN CAST(0.001 AS DOUBLE) WHEN 'ml' THEN CAST(0.001 AS DOUBLE) "
              f"WHEN 'oz' THEN CAST(0.028349523125 AS DOUBLE) WHEN 'kg' THEN CAST(1 AS DOUBLE) END")
    return f"({factor}) * ({_multipack(num)})"


def _multipack(num: str) -> str:
    return (f"CASE WHEN strpos({num}, '*') > 0 THEN CAST(split_part({num}, '*', 1) AS DOUBLE) "
            f"* CAST(split_part({num}, '*', 2) AS DOUBLE) ELSE CAST({num} AS DOUBLE) END")


def _na(c: str) -> str:
    return f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END AS {c}"


ORACLE["na_tokens_to_null"] = oracle_cte("dirty_products") + f"""
SELECT product_code, {_na('product_name')}, {_na('product_price')}, {_na('weight')},
       {_na('removed')}, {_na('date_added')}
FROM dirty_products
"""

_URL = r"^(s3|http|https)://([-a-zA-Z]+)\.?[a-zA-Z0-9.-]*/(.+)"
ORACLE["url_parts"] = f"""
SELECT page_id, url,
       NULLIF(regexp_extract(url, '{_URL}', 1), '') AS scheme,
       NULLIF(regexp_extract(url, '{_URL}', 2), '') AS bucket,
       NULLIF(regexp_extract(url, '{_URL}', 3), '') AS path
FROM pages
"""

ORACLE["reindex_columns"] = oracle_cte("dirty_stores") + """
SELECT index, store_code, store_type, staff_numbers, address, longitude, latitude,
       CAST(NULL AS VARCHAR) AS locality, CAST(NULL AS VARCHAR) AS country_code,
       continent, opening_date
FROM dirty_stores
"""

ORACLE["drop_index_column"] = oracle_cte("dirty_users") + """
SELECT first_name, last_name, date_of_birth, address, country_code FROM dirty_users
"""

ORACLE["dropna_subset"] = oracle_cte("dirty_users") + """
SELECT * FROM dirty_users WHERE address IS NOT NULL
"""

ORACLE["dropna_any"] = oracle_cte("dirty_cards") + """
SELECT * FROM dirty_cards
WHERE card_number IS NOT NULL AND expiry_date IS NOT NULL AND date_payment_confirmed IS NOT NULL
"""

ORACLE["null_unknown_codes"] = oracle_cte("dirty_users") + f"""
SELECT {_junk('index')} AS index, {_junk('first_name')} AS first_name,
       {_junk('last_name')} AS last_name, {_junk('date_of_birth')} AS date_of_birth,
       {_junk('address')} AS address, {_junk('country_code')} AS country_code
FROM dirty_users
"""

ORACLE["null_literal"] = oracle_cte("dirty_dates") + """
SELECT date_key, NULLIF(year, 'NULL') AS year, NULLIF(month, 'NULL') AS month,
       NULLIF(day, 'NULL') AS day, NULLIF(timestamp, 'NULL') AS timestamp,
       NULLIF(time_period, 'NULL') AS time_period
FROM dirty_dates
"""

ORACLE["parse_mixed_dates"] = oracle_cte("dirty_users") + f"""
SELECT index, first_name, last_name, CAST(dob AS VARCHAR) AS date_of_birth, address, country_code
FROM (SELECT *, {_mixed_date('date_of_birth')} AS dob FROM dirty_users) t
WHERE dob IS NOT NULL
"""

ORACLE["clean_address"] = oracle_cte("dirty_users") + """
SELECT index, first_name, last_name, date_of_birth, replace(address, chr(10), ', ') AS address, country_code
FROM dirty_users WHERE address IS NOT NULL
"""

ORACLE["strip_currency"] = oracle_cte("dirty_products") + """
SELECT product_code, replace(product_price, '£', '') AS product_price FROM dirty_products
"""

ORACLE["strip_question_marks"] = oracle_cte("dirty_cards") + """
SELECT date_payment_confirmed, regexp_replace(card_number, '[?]+', '', 'g') AS card_number FROM dirty_cards
"""

ORACLE["digits_only_staff"] = oracle_cte("dirty_stores") + """
SELECT index, regexp_replace(staff_numbers, '[A-Za-z]+', '', 'g') AS staff_numbers FROM dirty_stores
"""

ORACLE["fix_continent"] = oracle_cte("dirty_stores") + """
SELECT index, regexp_replace(continent, '^[a-z]+', '') AS continent FROM dirty_stores
"""

ORACLE["weights_to_kg"] = oracle_cte("dirty_products") + f"""
SELECT product_code, {_weight_kg('weight')} AS weight FROM dirty_products WHERE weight IS NOT NULL
"""

_NUM = ("NULLIF(regexp_extract(replace(replace(weight, ' ', ''), 'x', '*'), "
        "'([0-9]+\\.[0-9]+|[0-9]+\\*[0-9]+|[0-9]+)', 1), '')")
ORACLE["multipack_weight"] = oracle_cte("dirty_products") + f"""
SELECT product_code, weight, {_multipack(_NUM)} AS amount FROM dirty_products
"""

ORACLE["removed_flag"] = oracle_cte("dirty_products") + """
SELECT product_code, COALESCE(removed = 'Removed', false) AS removed FROM dirty_products
"""

# Lower bounds of the weight classes in kilograms.
_BOUNDS = "(VALUES (CAST('-Infinity' AS DOUBLE), 'Light'), (2.0, 'Mid_Sized'), (40.0, 'Heavy'), (140.0, 'Truck_Required')) AS c(least, name)"
_WEIGHT_CLASS = f"(SELECT arg_max(name, least) FROM {_BOUNDS} WHERE least <= weight)"
ORACLE["weight_class"] = oracle_cte("product") + f"""
SELECT product_code, weight, {_WEIGHT_CLASS} AS weight_class FROM product
"""


def _nul(c: str) -> str:
    return f"CASE WHEN regexp_full_match(CAST({c} AS VARCHAR), '{_JUNK}') OR {c} = 'NULL' THEN NULL ELSE {c} END AS {c}"


_DATES_CLEAN = f"""
dates_clean AS (
  SELECT date_key, year, month, day, time_period,
         strptime(year || '-' || month || '-' || day || ' ' || timestamp, '%Y-%m-%d %H:%M:%S') AS datetime
  FROM (SELECT {_junk('date_key')} AS date_key, {_nul('year')}, {_nul('month')}, {_nul('day')},
               {_nul('timestamp')}, {_nul('time_period')} FROM dirty_dates) j
  WHERE date_key IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL
    AND timestamp IS NOT NULL AND time_period IS NOT NULL
)"""
ORACLE["build_datetime"] = oracle_cte("dirty_dates") + "," + _DATES_CLEAN + """
SELECT * FROM dates_clean
"""

ORACLE["dedupe_exact"] = oracle_cte("repeated_fact") + """
SELECT date_key, store_code, product_code, product_quantity FROM repeated_fact
GROUP BY date_key, store_code, product_code, product_quantity
"""

_USERS_CLEAN = f"""
users_clean AS (
  SELECT first_name, last_name, dob AS date_of_birth, replace(address, chr(10), ', ') AS address,
         CASE WHEN country_code = 'GGB' THEN 'GB' ELSE country_code END AS country_code
  FROM (SELECT {_junk('first_name')} AS first_name, {_junk('last_name')} AS last_name, dob,
               {_junk('address')} AS address, {_junk('country_code')} AS country_code
        FROM (SELECT *, {_mixed_date('date_of_birth')} AS dob FROM dirty_users) p
        WHERE dob IS NOT NULL) j
  WHERE address IS NOT NULL
)"""
ORACLE["clean_users"] = oracle_cte("dirty_users") + "," + _USERS_CLEAN + """
SELECT first_name, last_name, CAST(date_of_birth AS VARCHAR) AS date_of_birth, address, country_code
FROM users_clean
"""


def _hdr(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '{_JUNK}') OR {c} = '{c}' THEN NULL ELSE {c} END AS {c}"


_CARDS_CLEAN = f"""
cards_clean AS (
  SELECT regexp_replace(card_number, '[?]+', '', 'g') AS card_number, expiry_date, date_payment_confirmed
  FROM (SELECT {_hdr('card_number')}, {_hdr('expiry_date')}, {_hdr('date_payment_confirmed')}
        FROM dirty_cards) h
  WHERE card_number IS NOT NULL AND expiry_date IS NOT NULL AND date_payment_confirmed IS NOT NULL
)"""
ORACLE["clean_cards"] = oracle_cte("dirty_cards") + "," + _CARDS_CLEAN + """
SELECT * FROM cards_clean
"""

_WEB = "store_type = 'Web Portal'"
_STORES_CLEAN = f"""
stores_clean AS (
  SELECT store_code, store_type,
         regexp_replace(staff_numbers, '[A-Za-z]+', '', 'g') AS staff_numbers,
         CASE WHEN {_WEB} THEN 'N/A' ELSE address END AS address,
         CASE WHEN {_WEB} THEN NULL ELSE longitude END AS longitude,
         CASE WHEN {_WEB} THEN NULL ELSE latitude END AS latitude,
         locality, country_code,
         regexp_replace(CASE WHEN {_WEB} THEN 'N/A' ELSE continent END, '^[a-z]+', '') AS continent,
         opening_date
  FROM (SELECT store_code, store_type, staff_numbers, replace(address, chr(10), ', ') AS address,
               longitude, latitude, locality, country_code, continent,
               {_mixed_date('opening_date')} AS opening_date
        FROM (SELECT {_junk('store_code')} AS store_code, {_junk('store_type')} AS store_type,
                     {_junk('staff_numbers')} AS staff_numbers, {_junk('address')} AS address,
                     {_junk('longitude')} AS longitude, {_junk('latitude')} AS latitude,
                     CAST(NULL AS VARCHAR) AS locality, CAST(NULL AS VARCHAR) AS country_code,
                     {_junk('continent')} AS continent, {_junk('opening_date')} AS opening_date
              FROM dirty_stores) j
        WHERE address IS NOT NULL) a
  WHERE opening_date IS NOT NULL
)"""
ORACLE["clean_stores"] = oracle_cte("dirty_stores") + "," + _STORES_CLEAN + """
SELECT * REPLACE (CAST(opening_date AS VARCHAR) AS opening_date) FROM stores_clean
"""

_PRODUCTS_CLEAN = f"""
products_clean AS (
  SELECT product_name, replace(product_price, '£', '') AS product_price,
         round_even(weight, 3) AS weight, category, EAN, date_added, uuid,
         COALESCE(removed = 'Removed', false) AS removed, product_code
  FROM (SELECT product_name, product_price, {_weight_kg('weight')} AS weight, category, EAN,
               {_mixed_date('date_added')} AS date_added, uuid, removed, product_code
        FROM (SELECT {_junk('product_name')} AS product_name, {_junk('product_price')} AS product_price,
                     {_junk('weight')} AS weight, CAST(NULL AS VARCHAR) AS category,
                     CAST(NULL AS VARCHAR) AS EAN, {_junk('date_added')} AS date_added,
                     CAST(NULL AS VARCHAR) AS uuid, {_junk('removed')} AS removed,
                     {_junk('product_code')} AS product_code
              FROM dirty_products) j
        WHERE weight IS NOT NULL) w
  WHERE date_added IS NOT NULL
)"""
ORACLE["clean_products"] = oracle_cte("dirty_products") + "," + _PRODUCTS_CLEAN + """
SELECT * REPLACE (CAST(date_added AS VARCHAR) AS date_added) FROM products_clean
"""

ORACLE["clean_orders"] = oracle_cte("dirty_orders") + """
SELECT date_key, store_code, product_code, product_quantity FROM dirty_orders
"""

# --- conformance and constraints --------------------------------------------------

ORACLE["conform_fact"] = oracle_cte("dirty_orders") + """
SELECT date_key, CAST(store_code AS VARCHAR) AS store_code, CAST(product_code AS VARCHAR) AS product_code,
       CAST(product_quantity AS SMALLINT) AS product_quantity
FROM dirty_orders
"""

ORACLE["conform_users"] = oracle_cte("etl_users") + """
SELECT first_name, last_name, date_of_birth, replace(address, chr(10), ', ') AS address,
       replace(country_code, 'GGB', 'GB') AS country_code, join_date[-4:] || '-10-02' AS join_date, lower(user_uuid) AS user_uuid
FROM etl_users
"""

ORACLE["conform_orders_keys"] = oracle_cte("etl_orders") + """
SELECT date_uuid, user_uuid, card_number, store_code, product_code, CAST(product_quantity AS SMALLINT) AS product_quantity FROM etl_orders
"""

ORACLE["conform_full_stores"] = oracle_cte("etl_stores") + """
SELECT store_code, store_type, CAST(staff_numbers AS SMALLINT) AS staff_numbers,
       if(store_type = 'Web Portal', 'N/A', address) AS address, CAST(if(store_type = 'Web Portal', NULL, longitude) AS FLOAT) AS longitude,
       CAST(if(store_type = 'Web Portal', NULL, latitude) AS FLOAT) AS latitude, locality, country_code,
       if(store_type = 'Web Portal', 'N/A', continent) AS continent, opening_date
FROM etl_stores
"""

ORACLE["conform_full_products"] = oracle_cte("etl_products") + f"""
SELECT product_name, CAST(replace(product_price, '£', '') AS DOUBLE) AS product_price, CAST(weight AS FLOAT) AS weight, category, EAN,
       date_added, uuid, removed <> 'Removed' AS still_available, product_code, {_WEIGHT_CLASS} AS weight_class
FROM (SELECT * REPLACE (CAST(replace(weight, 'kg', '') AS DOUBLE) AS weight) FROM etl_products) p
"""

ORACLE["conform_stores"] = oracle_cte("dirty_stores") + "," + _STORES_CLEAN + """
SELECT store_code, store_type, CAST(staff_numbers AS SMALLINT) AS staff_numbers, address,
       CAST(longitude AS FLOAT) AS longitude, CAST(latitude AS FLOAT) AS latitude,
       locality, country_code, continent, CAST(opening_date AS VARCHAR) AS opening_date
FROM stores_clean
"""

ORACLE["conform_products"] = oracle_cte("dirty_products") + "," + _PRODUCTS_CLEAN + f"""
SELECT product_name, CAST(CAST(product_price AS DECIMAL(12,2)) AS DOUBLE) AS product_price,
       CAST(weight AS FLOAT) AS weight, category, EAN, CAST(date_added AS VARCHAR) AS date_added,
       uuid, NOT removed AS still_available, CAST(product_code AS VARCHAR) AS product_code,
       {_WEIGHT_CLASS} AS weight_class
FROM products_clean
"""

ORACLE["conform_dates"] = oracle_cte("etl_dates") + """
SELECT date_uuid, year, month, day, time_period,
       make_timestamp(CAST(year AS BIGINT), CAST(month AS BIGINT), CAST(day AS BIGINT), 10, 11, 12.0) AS datetime
FROM etl_dates
"""

ORACLE["conform_cards"] = oracle_cte("dirty_cards") + "," + _CARDS_CLEAN + """
SELECT card_number, expiry_date, CAST(CAST(date_payment_confirmed AS DATE) AS VARCHAR) AS date_payment_confirmed
FROM cards_clean
"""

_UUID = r"[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}"
ORACLE["conform_violations"] = oracle_cte("bad_uuid") + f"""
SELECT 'bad_uuid' AS "table", 'user_uuid' AS "column", 'uuid' AS rule, CAST(id AS VARCHAR) AS key, user_uuid AS value
FROM bad_uuid WHERE user_uuid IS NOT NULL AND NOT regexp_full_match(
  CASE WHEN user_uuid[1] = '{{' AND user_uuid[-1] = '}}' THEN user_uuid[2:-2] ELSE user_uuid END, '{_UUID}')
UNION ALL
SELECT 'bad_uuid', 'small_text', 'int2', CAST(id AS VARCHAR), small_text
FROM bad_uuid WHERE small_text IS NOT NULL AND TRY_CAST(small_text AS SMALLINT) IS NULL
UNION ALL
SELECT 'bad_uuid', 'country_code', 'varchar(2)', CAST(id AS VARCHAR), country_code
FROM bad_uuid WHERE length(country_code) > 2
"""

ORACLE["pk_violations"] = oracle_cte("dirty_orders") + """
SELECT date_key, level_0, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM dirty_orders
GROUP BY date_key, level_0
HAVING COUNT(*) > 1 OR date_key IS NULL OR level_0 IS NULL
"""

ORACLE["fk_violations"] = oracle_cte("dangling_fact", "store") + """
SELECT f.* FROM dangling_fact f
WHERE f.store_code IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM store s WHERE s.store_code = f.store_code)
"""

ORACLE["preview_limit"] = oracle_cte("dirty_products") + "," + _PRODUCTS_CLEAN + """
SELECT * REPLACE (CAST(date_added AS VARCHAR) AS date_added) FROM products_clean
QUALIFY ROW_NUMBER() OVER (ORDER BY product_code) <= (SELECT COUNT(*) // 2 FROM part)
"""


# --- sources ---------------------------------------------------------------------

ORACLE["scan_table"] = "SELECT * FROM customer"

ORACLE["scan_csv_products"] = oracle_cte("dirty_products") + f"""
SELECT CAST(product_code AS VARCHAR) AS _c0, CAST(product_code AS VARCHAR) AS product_code,
       {_na('product_name')}, {_na('product_price')}, {_na('weight')}, {_na('removed')}, {_na('date_added')}
FROM dirty_products
"""

ORACLE["scan_columnar_json"] = oracle_cte("dirty_dates") + """
SELECT * FROM dirty_dates
"""

ORACLE["missing_document_ids"] = """
SELECT CAST(id AS BIGINT) AS id
FROM (SELECT unnest(range(0, (SELECT COUNT(*) FROM supplier))) AS id) r
WHERE id % 7 = 3 OR id NOT IN (SELECT s_suppkey FROM supplier)
"""

ORACLE["json_flatten_props"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events
"""

ORACLE["drop_repeated_headers"] = oracle_cte("dirty_cards") + """
SELECT * FROM dirty_cards
WHERE NOT COALESCE(card_number = 'card_number' AND expiry_date = 'expiry_date'
                   AND date_payment_confirmed = 'date_payment_confirmed', false)
"""

ORACLE["union_pages"] = oracle_cte("dirty_cards") + """
SELECT card_number, expiry_date,
       CASE WHEN date_payment_confirmed < '1995-01-01' THEN NULL ELSE date_payment_confirmed END AS date_payment_confirmed
FROM dirty_cards
"""


# --- end-to-end: keys of the loaded star ------------------------------------------

_KEY_COLUMNS = [("card_number", "dim_card_details", "etl_cards"), ("date_uuid", "dim_date_times", "etl_dates"),
                ("product_code", "dim_products", "etl_products"), ("store_code", "dim_store_details", "etl_stores"),
                ("user_uuid", "dim_users_table", "etl_users")]
ORACLE["etl_key_report"] = oracle_cte(*(v for _, _, v in _KEY_COLUMNS), "etl_orders") + " UNION ALL ".join(
    part for column, dim, source in _KEY_COLUMNS for part in (f"""
SELECT 'primary_key' AS "check", '{dim}' AS "table", '{column}' AS "column", key, CAST(n AS BIGINT) AS n_rows
FROM (SELECT lower({column}) AS lowered, {'lower(' + column + ')' if 'uuid' in column else column} AS key, COUNT(*) AS n
      FROM {source} GROUP BY ALL) k WHERE n > 1 OR key IS NULL
""", f"""
SELECT 'foreign_key', 'orders_table', '{column}', {column}, COUNT(*) FROM etl_orders
WHERE lower({column}) NOT IN (SELECT lower({column}) FROM {source} WHERE {column} IS NOT NULL) GROUP BY {column}
"""))


ORACLE["unparsed_dates"] = oracle_cte("dirty_users") + f"""
SELECT 'date_of_birth' AS "column", date_of_birth AS value, COUNT(*) AS n_rows
FROM dirty_users
WHERE date_of_birth IS NOT NULL AND ({_mixed_date('date_of_birth')}) IS NULL
GROUP BY date_of_birth
"""

ORACLE["scan_csv_several_headers"] = oracle_cte("dirty_cards") + """
SELECT card_number, expiry_date, CASE WHEN ascii(right(card_number, 1)) % 3 < 2 THEN date_payment_confirmed END AS date_payment_confirmed
FROM dirty_cards WHERE card_number IS NOT NULL
"""

ORACLE["broken_documents"] = oracle_cte("dirty_stores") + """
, texts AS (
  SELECT index, concat('{"index":', index, CASE WHEN store_code IS NULL THEN '' ELSE concat(',"store_code":"', store_code, '"') END, '}') AS j
  FROM dirty_stores),
bad AS (
  SELECT CASE WHEN index % 5 = 0 THEN 'not JSON' WHEN index % 7 = 0 THEN 'not an object' ELSE 'a value does not fit the schema' END AS reason,
         CASE WHEN index % 5 = 0 THEN j[1:9] WHEN index % 7 = 0 THEN '[' || j || ']' ELSE '{"index":"x' || index || '"}' END AS text
  FROM texts WHERE index % 5 = 0 OR index % 7 = 0 OR index % 11 = 0)
SELECT reason, COUNT(*) AS n_documents, MIN(text) AS first_text FROM bad GROUP BY reason
"""

ORACLE["load_by_content_type"] = """
SELECT CAST(n_nationkey AS VARCHAR) AS k, n_name AS name, 'csv' AS source FROM nation
UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, 'json' FROM customer
"""

ORACLE["create_only_table"] = """
SELECT n_nationkey, n_name, n_regionkey, true AS created, false AS created_again FROM nation
"""

ORACLE["list_tables"] = """
SELECT 'region' AS table_name, COUNT(*) AS n_rows FROM region UNION ALL SELECT 'nation', COUNT(*) FROM nation
UNION ALL SELECT 'supplier', COUNT(*) FROM supplier
"""
