"""The SQL each query is compared with, for DuckDB on the same tables.

Labels are found here by joining texts with a rule table and taking the smallest ordinal,
trips by a range join, running balances by one window: other ways to the same results.
"""

from checks.fixtures import LATER, NUMBERED, TEXTS
from checks.ladder import LADDER, PREFIXES

LABELS = ("merchant_name", "category", "sub_category", "channel")
MAPPING_CATEGORIES = (
    "Shopping", "Groceries", "Meals", "Transport", "Utilities", "Entertainment", "Income", "Transfer", "Medical", "Fees",
)

ORACLE: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(value) for value in values)


_ACCOUNT = """
    'acct_' || {c} % 5 AS account_name,
    CASE WHEN {c} % 5 < 2 THEN 'checking' ELSE 'credit_card' END AS account_type,
    CASE WHEN {c} % 5 < 2 THEN 'keep' WHEN {c} % 5 = 2 THEN 'flip' ELSE 'force' END AS sign_rule
"""

_ROWS = f"""
texts AS (
  SELECT *, [{_list(TEXTS)}][o_orderkey % {len(TEXTS)} + 1] AS base,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price
  FROM orders),
rows AS (
  SELECT 'cust_' || o_custkey || '.csv' AS file, o_orderkey + 100 AS pos, o_custkey, o_orderstatus,
    CASE WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderkey % 107 = 0 THEN 'not a date'
         ELSE [strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%Y/%m/%d'), strftime(o_orderdate, '%m/%d/%Y'),
               strftime(o_orderdate, '%-m/%-d/%Y'), strftime(o_orderdate, '%m-%d-%Y')][o_orderkey % 5 + 1]
    END AS date_text,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN base IN ({_list(NUMBERED)}) THEN base || ' ' || o_custkey
         ELSE base END AS description,
    CASE WHEN o_orderkey % 109 = 0 THEN NULL WHEN o_orderkey % 113 = 0 THEN 'PENDING'
         WHEN o_orderkey % 127 = 0 THEN '$' || price
         WHEN o_orderkey % 7 <= 3 THEN '-' || price WHEN o_orderkey % 7 = 4 THEN '(' || price || ')'
         WHEN o_orderkey % 7 = 5 THEN ' ' || price || ' ' ELSE price END AS amount_text,
    {_ACCOUNT.format(c="o_custkey")}
  FROM texts),
parsed AS (
  SELECT *,
    TRY_CAST(replace(replace(replace(amount_text, '(', ''), ')', ''), ' ', '') AS DECIMAL(18,2)) AS parsed,
    CAST(coalesce(try_strptime(date_text, '%Y-%m-%d'), try_strptime(date_text, '%Y/%m/%d'),
      try_strptime(date_text, '%m/%d/%Y'), try_strptime(date_text, '%m-%d-%Y')) AS DATE) AS day,
    md5(concat_ws('_', date_text, description, amount_text)) AS transaction_id
  FROM rows),
signed AS (
  SELECT *, CASE sign_rule WHEN 'keep' THEN parsed WHEN 'flip' THEN -parsed
      ELSE abs(parsed) * (CASE WHEN regexp_matches(coalesce(description, ''), 'payment|thank you', 'i') THEN 1 ELSE -1 END)
    END AS amount
  FROM parsed),
raw AS (
  SELECT transaction_id, account_name, account_type, day AS transaction_date, description AS raw_description, amount,
    CASE WHEN amount < 0 THEN 'Expense' ELSE 'Income' END AS direction, o_orderstatus, file, pos
  FROM signed WHERE date_text IS NOT NULL AND parsed IS NOT NULL)
"""

_PREFIX_HIT = " ".join(
    f"WHEN starts_with(upper(d), {_text(prefix)}) THEN substr(d, {len(prefix) + 1})"
    for prefix in PREFIXES
)

_LEDGER = f"""
rules(axis, ordinal, label, pattern) AS (VALUES {LADDER}),
described AS (SELECT DISTINCT description AS d FROM rows),
hits AS (
  SELECT d, axis, arg_min(label, ordinal) AS label
  FROM described JOIN rules ON d ILIKE pattern GROUP BY d, axis),
labels AS (
  SELECT d,
    coalesce(CASE {_PREFIX_HIT} END, max(label) FILTER (axis = 'merchant_name'), 'UNKNOWN') AS merchant_name,
    coalesce(max(label) FILTER (axis = 'category'), 'UNCLASSIFIED') AS category,
    coalesce(max(label) FILTER (axis = 'sub_category'), 'UNCLASSIFIED') AS sub_category,
    coalesce(max(label) FILTER (axis = 'channel'), 'pos') AS channel
  FROM described LEFT JOIN hits USING (d) GROUP BY d),
swept AS (
  SELECT transaction_id, transaction_date, account_name, raw_description, merchant_name, category, sub_category,
    amount, direction, channel, o_orderstatus
  FROM raw JOIN labels ON raw_description IS NOT DISTINCT FROM d),
ledger AS (SELECT * EXCLUDE (o_orderstatus) FROM swept)
"""

_MAPPING = """
mapping AS (
  SELECT 'CORNER SHOP ' || c_custkey AS raw_description, 'Corner Shop ' || c_custkey AS merchant,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Gadgets' ELSE 'Groceries' END AS category,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'Convenience' END AS sub_category,
    CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'pos' END AS channel, c_custkey * 10 AS seq FROM customer
  UNION ALL
  SELECT 'HILLTOP FLATS RENTAL ' || c_custkey, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'Hilltop Flats' END,
    'Transfer', 'Rent Payment', 'ach', c_custkey * 10 + 1 FROM customer
  UNION ALL
  SELECT 'WIRE TO FRIEND ' || c_custkey, 'Zelle', CASE WHEN c_mktsegment = 'BUILDING' THEN 'Cash' ELSE 'Transfer' END,
    'Person to Person Payment', 'p2p', c_custkey * 10 + 2 FROM customer
  UNION ALL
  SELECT 'SWEETGREEN ELM AVE', 'Never used', 'Meals', 'Salad', 'pos', c_custkey * 10 + 3 FROM customer
  UNION ALL
  SELECT 'CORNER SHOP ' || c_custkey, 'Corner Shop No. ' || c_custkey, 'Shopping', 'Corner', 'online',
    c_custkey * 10 + 4 FROM customer WHERE c_mktsegment = 'AUTOMOBILE'),
newest AS (SELECT * FROM mapping QUALIFY row_number() OVER (PARTITION BY raw_description ORDER BY seq DESC) = 1),
labelled AS (
  SELECT transaction_id, transaction_date, account_name, l.raw_description,
    CASE WHEN hit THEN coalesce(merchant, 'UNKNOWN') ELSE merchant_name END AS merchant_name,
    CASE WHEN hit THEN coalesce(m.category, 'UNCLASSIFIED') ELSE l.category END AS category,
    CASE WHEN hit THEN coalesce(m.sub_category, 'UNCLASSIFIED') ELSE l.sub_category END AS sub_category,
    amount, direction,
    CASE WHEN hit THEN coalesce(m.channel, 'pos') ELSE l.channel END AS channel
  FROM (SELECT ledger.*, merchant_name = 'UNKNOWN' AND ledger.raw_description IN (SELECT raw_description FROM newest)
          IS TRUE AS hit FROM ledger) l
  LEFT JOIN newest m ON l.raw_description = m.raw_description)
"""


def _trips(name: str, table: str, key: str, label: str) -> str:
    return f"""
{name} AS (
  SELECT 'TRIP-' || {key} AS trip_id, start_date, CAST(start_date + CAST(10 + {key} * 5 % 120 AS INTEGER) AS DATE) AS end_date,
    CASE WHEN {key} % 2 = 0 THEN 'Business' ELSE 'Personal' END AS trip_type, {label} AS destination,
    CASE WHEN {key} % 4 <> 0 THEN 'note ' || {label} END AS notes
  FROM (SELECT *, CAST(DATE '1995-02-01' + CAST({key} * 61 % 2400 AS INTEGER) AS DATE) AS start_date FROM {table}))
"""


_TRIPS = _trips("trips", "nation", "n_nationkey", "n_name")

_CASH = """
pending AS (SELECT * FROM orders WHERE o_orderstatus = 'P'),
cash AS (
  SELECT CAST(o_orderdate AS DATE) AS tx_date, -CAST(o_totalprice AS DECIMAL(18,2)) AS cash_amount,
    CASE WHEN o_orderkey % 3 <> 0 THEN 'Shared flat loan' END AS override_category,
    o_orderkey % 4 <> 0 AS is_loan, 'entry ' || o_orderkey || '/' || copy AS notes
  FROM (SELECT *, 1 AS copy FROM pending
        UNION ALL SELECT *, 2 FROM pending WHERE o_orderpriority = '1-URGENT'))
"""

_TRAVELLED = """
travelled AS (
  SELECT l.*, t.trip_id, coalesce(t.trip_type, 'Personal/Local') AS travel_context, t.destination AS trip_location,
    t.trip_id IS NOT NULL AS is_travel_expense
  FROM labelled l LEFT JOIN trips t ON l.transaction_date >= t.start_date AND l.transaction_date <= t.end_date
    AND l.sub_category <> 'Person to Person Payment' AND l.category IN ('Travel', 'Transport', 'Meals', 'Cash'))
"""

_MASTER = """
overlaid AS (
  SELECT transaction_date AS tx_date, raw_description AS merchant_string, CAST(amount AS DOUBLE) AS amount,
    coalesce(override_category, category, 'Unclassified') AS final_category, travel_context, trip_location,
    coalesce(is_loan, false) AS is_account_receivable, notes, is_loan
  FROM travelled LEFT JOIN cash ON transaction_date = tx_date AND amount = cash_amount),
master AS (SELECT * EXCLUDE (notes, is_loan) FROM overlaid)
"""

_STATEMENTS = f"""
styled AS (SELECT *, c_custkey % 6 AS style, 'cust_' || c_custkey || '.csv' AS file FROM customer),
cells AS (
  SELECT file, pos + later AS pos, pos % 89 = 0 AS wide, style, date_text, description, amount_text
  FROM (SELECT *, o_custkey % 6 AS style FROM rows)
  JOIN (SELECT 0 AS later, ['O', 'F', 'P'] AS statuses UNION ALL SELECT {LATER}, ['F']) ON o_orderstatus IN statuses),
heads AS (
  SELECT file, style, c_name, CASE style
      WHEN 0 THEN ['Date', 'Description', 'Amount', 'Running Bal.']
      WHEN 1 THEN ['Transaction Date', 'Post Date', 'Description', 'Category', 'Amount (USD)', 'Memo']
      WHEN 2 THEN ['date', 'memo', 'amt']
      WHEN 3 THEN ['Trans. Date', 'Payee', 'Charge', 'Updated']
      WHEN 4 THEN ['Date', 'Description', 'Deposits', 'Withdrawals']
      ELSE ['When', 'What', 'How much'] END AS names,
    CASE style WHEN 2 THEN 3 ELSE 0 END AS line_no FROM styled)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


R = _with(_ROWS)
L = _with(_ROWS, _LEDGER)
M = _with(_ROWS, _LEDGER, _MAPPING)
T = _with(_ROWS, _LEDGER, _MAPPING, _TRIPS, _TRAVELLED)
A = _with(_ROWS, _LEDGER, _MAPPING, _TRIPS, _CASH, _TRAVELLED, _MASTER)
S = _with(_ROWS, _STATEMENTS)

_LEDGER_COLUMNS = "* REPLACE (CAST(amount AS DOUBLE) AS amount)"


def _sum(value: str = "amount", where: str = "") -> str:
    chosen = f" FILTER ({where})" if where else ""
    return f"CAST(coalesce(sum({value}){chosen}, 0) AS DOUBLE)"


# Statement files

ORACLE["statement_cells"] = S + """
SELECT file, pos, CASE style WHEN 1 THEN 6 WHEN 2 THEN 3 WHEN 3 THEN 5 ELSE 4 END + (CASE WHEN wide THEN 3 ELSE 0 END) AS n_cells,
  date_text AS c0, CASE style WHEN 1 THEN date_text ELSE description END AS c1,
  CASE style WHEN 1 THEN description ELSE amount_text END AS c2,
  CASE style WHEN 1 THEN 'x' WHEN 2 THEN CASE WHEN wide THEN '7' END WHEN 3 THEN 'z' WHEN 4 THEN NULL ELSE '1.00' END AS c3
FROM cells
UNION ALL SELECT file, line_no, len(names), names[1], names[2], names[3], names[4] FROM heads
UNION ALL SELECT file, 0, 2, 'Description:', c_name, NULL, NULL FROM heads WHERE style = 2
UNION ALL SELECT file, 1, 2, 'Printed:', '11/30/2021', NULL, NULL FROM heads WHERE style = 2
UNION ALL SELECT file, 2, 4, NULL, NULL, NULL, NULL FROM heads WHERE style = 2
"""

ORACLE["header_discovery"] = S + """
SELECT file, CAST(CASE WHEN style < 5 THEN line_no END AS BIGINT) AS header_line,
  CASE WHEN style < 5 THEN array_to_string(names, '|') END AS header FROM heads
"""

ORACLE["column_mapping"] = S + """
SELECT file, CASE WHEN style < 5 THEN 0 END AS date_ix,
  CASE style WHEN 1 THEN 2 WHEN 5 THEN NULL ELSE 1 END AS desc_ix,
  CASE style WHEN 1 THEN 4 WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE 2 END AS amt_ix,
  CASE style WHEN 4 THEN 'amount column not mapped'
    WHEN 5 THEN 'no header row with a date and a description column' END AS reject_reason
FROM heads
"""

ORACLE["rejected_files"] = S + """
SELECT file, CASE style WHEN 4 THEN 'amount column not mapped'
  ELSE 'no header row with a date and a description column' END AS reason FROM heads WHERE style >= 4
"""

ORACLE["wide_rows"] = S + """
SELECT file, pos, 'more cells than the header' AS reason FROM cells WHERE wide AND style < 4
"""

ORACLE["statement_rows"] = S + """
SELECT file, pos, date_text, description, amount_text FROM cells WHERE NOT wide AND style < 4
"""

ORACLE["ingest_statements"] = R + """
SELECT DISTINCT transaction_id, first(account_name ORDER BY file, pos) OVER w AS account_name,
  first(account_type ORDER BY file, pos) OVER w AS account_type, transaction_date, raw_description,
  CAST(first(amount ORDER BY file, pos) OVER w AS DOUBLE) AS amount,
  first(direction ORDER BY file, pos) OVER w AS direction
FROM raw WHERE pos % 89 <> 0 AND CAST(regexp_extract(file, '[0-9]+') AS BIGINT) % 6 < 4
WINDOW w AS (PARTITION BY transaction_id)
"""

ORACLE["ingest_statements_shuffled"] = ORACLE["ingest_statements"]
ORACLE["trips_sidecar"] = _with(_trips("trips", "customer", "c_custkey", "c_name")) + "SELECT * FROM trips"

ORACLE["cash_sidecar"] = _with(_CASH) + """
SELECT tx_date, CAST(cash_amount AS DOUBLE) AS amount, override_category, is_loan, notes FROM cash
"""

# Row-level parsing

ORACLE["parsed_amounts"] = R + """
SELECT pos, CAST(parsed AS DOUBLE) AS amount,
  CAST(CASE WHEN amount_text[1] = '(' THEN -parsed ELSE parsed END AS DOUBLE) AS amount_paren_negative FROM parsed
"""

ORACLE["parsed_dates"] = R + "SELECT pos, day FROM parsed"

ORACLE["signed_amounts"] = R + """
SELECT pos, CAST(amount AS DOUBLE) AS amount, CASE WHEN amount < 0 THEN 'Expense' ELSE 'Income' END AS direction
FROM signed
"""

ORACLE["content_keys"] = R + """
SELECT pos, transaction_id, md5(concat_ws('_', account_name, date_text, description, amount_text))
  AS account_scoped_id FROM parsed
"""

ORACLE["valid_rows"] = R + """
SELECT pos, date_text, amount_text FROM rows
WHERE date_text IS NOT NULL AND regexp_full_match(amount_text, '[() ]*-?[0-9.]+[() ]*')
"""

ORACLE["attached_accounts"] = f"""
WITH customers AS (SELECT 'cust_' || c_custkey || '.csv' AS file, {_ACCOUNT.format(c="c_custkey")} FROM customer)
SELECT file, o_orderkey + 100 AS pos, account_name, account_type,
  CASE account_type WHEN 'checking' THEN 'keep' ELSE 'force' END AS sign_rule
FROM orders JOIN customers ON file = 'cust_' || o_custkey || '.csv'
"""

ORACLE["raw_transactions"] = R + f"SELECT {_LEDGER_COLUMNS[:-1]}) FROM (SELECT * EXCLUDE (o_orderstatus, file, pos) FROM raw)"

# Labels

ORACLE["classified_ledger"] = L + f"SELECT {_LEDGER_COLUMNS} FROM ledger"
for _axis in LABELS:
    ORACLE[f"{_axis}_axis"] = L + f"SELECT transaction_id, raw_description, {_axis} FROM ledger"

ORACLE["prefix_strip"] = R + f"""
SELECT pos, description, CASE {_PREFIX_HIT} END AS merchant FROM (SELECT pos, description, description AS d FROM rows)
"""
ORACLE["unknown_rows"] = L + """
SELECT transaction_id, raw_description, CAST(amount AS DOUBLE) AS amount FROM ledger WHERE merchant_name = 'UNKNOWN'
"""
ORACLE["unknown_descriptions"] = L + """
SELECT raw_description FROM ledger WHERE merchant_name = 'UNKNOWN' GROUP BY raw_description
"""
ORACLE["mapped_labels"] = M + f"SELECT {_LEDGER_COLUMNS} FROM labelled"
ORACLE["mapped_labels_shuffled"] = ORACLE["mapped_labels"]
ORACLE["latest_mapping"] = _with(_MAPPING.split(",\nlabelled AS")[0]) + "SELECT * FROM newest"

_USABLE = f"""merchant IS NOT NULL AND sub_category IS NOT NULL AND channel IS NOT NULL
  AND category IN ({_list(MAPPING_CATEGORIES)})"""
_MAPPING_ONLY = _with(_MAPPING.split(",\nnewest AS")[0])
ORACLE["mapping_usable"] = _MAPPING_ONLY + f"SELECT * FROM mapping WHERE {_USABLE}"
ORACLE["mapping_rejects"] = _MAPPING_ONLY + f"""
SELECT raw_description, seq, CASE WHEN merchant IS NULL THEN 'missing merchant'
  WHEN sub_category IS NULL THEN 'missing sub_category' WHEN channel IS NULL THEN 'missing channel'
  ELSE 'category not allowed' END AS reject_reason
FROM mapping WHERE NOT ({_USABLE})
"""

_RULE_DIM = """
merchant_map AS (
  SELECT 'SHOP ' || c_custkey AS pattern, 'keyword' AS match_type, c_nationkey AS entity_id,
    CAST(1 + c_custkey % 2 AS INTEGER) AS priority FROM customer
  UNION ALL SELECT '^CORNER SHOP [0-9]*' || r_regionkey || '$', 'regex', r_regionkey + 1, 2 FROM region
  UNION ALL SELECT 'FLATS RENTAL ' || r_regionkey, 'keyword', r_regionkey + 100000000, 1 FROM region
  UNION ALL SELECT substr(r_name, 1, 2), 'keyword', r_regionkey + 2, 3 FROM region)
"""
ORACLE["entity_match"] = _with(_ROWS, _LEDGER, _RULE_DIM) + """
SELECT raw_description, entity_id, s_name AS clean_name, 'nation ' || s_nationkey AS primary_category
FROM (
  SELECT raw_description, CAST(entity_id AS INTEGER) AS entity_id
  FROM (SELECT DISTINCT raw_description FROM ledger WHERE merchant_name = 'UNKNOWN')
  JOIN merchant_map ON CASE match_type WHEN 'regex' THEN regexp_matches(raw_description, pattern)
    ELSE contains(raw_description, pattern) END
  QUALIFY row_number() OVER (PARTITION BY raw_description ORDER BY priority, length(pattern) DESC, pattern) = 1)
JOIN supplier ON entity_id = s_suppkey
"""
ORACLE["entity_match_by_join"] = ORACLE["entity_match"]
ORACLE["orphan_rules"] = _with(_RULE_DIM) + """
SELECT pattern, match_type, entity_id, priority FROM merchant_map
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = entity_id)
"""


def _audit(batch: str, payload: str, key: str, fields: str) -> str:
    return f"""
, payload AS ({payload}),
digits AS (SELECT CAST(greatest(0, ceil(log(greatest(count(*), 1) / 100.0) / log(16))) AS INTEGER) AS n FROM payload),
chunked AS (SELECT *, substr(md5(coalesce({key}, '')), 1, n) AS chunk FROM payload, digits)
SELECT chunk, '{{"batch_id":"{batch}","record_count":' || count(*) || ',"transmitted_data":[' ||
  string_agg(CAST(json_object({fields}) AS VARCHAR), ',' ORDER BY {key} NULLS FIRST) || ']}}' AS value
FROM chunked GROUP BY chunk
"""


ORACLE["audit_of_rows"] = L + _audit(
    "batch-1",
    "SELECT transaction_id, raw_description, CAST(amount AS DOUBLE) AS amt FROM ledger WHERE merchant_name = 'UNKNOWN'",
    "transaction_id",
    "'tx_id', transaction_id, 'desc', raw_description, 'amt', amt",
)
ORACLE["audit_of_texts"] = L + _audit(
    "batch-2",
    "SELECT DISTINCT raw_description AS text FROM ledger WHERE merchant_name = 'UNKNOWN'",
    "text",
    "'desc', text",
)

# Trip and cash context

_TRAVELLED_ALL = f"SELECT {_LEDGER_COLUMNS} FROM travelled"
ORACLE["ledger_with_trips"] = T + _TRAVELLED_ALL
ORACLE["ledger_with_trips_shuffled"] = T + _TRAVELLED_ALL
ORACLE["ledger_with_first_trip"] = T + f"""
SELECT {_LEDGER_COLUMNS} FROM (
  SELECT travelled.* FROM travelled LEFT JOIN trips USING (trip_id)
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY start_date, trip_id) = 1)
"""
ORACLE["master_ledger"] = A + "SELECT * FROM master"
ORACLE["master_ledger_shuffled"] = ORACLE["master_ledger"]
ORACLE["travel_rows"] = T + """
SELECT transaction_date, raw_description, CAST(amount AS DOUBLE) AS amount, travel_context, trip_location
FROM travelled WHERE travel_context <> 'Personal/Local'
"""
ORACLE["business_expenses"] = A + """
SELECT tx_date, merchant_string, amount, final_category, travel_context, trip_location FROM master
WHERE travel_context = 'Business' AND final_category NOT IN ('Transfer', 'Income')
"""
_BURN = f"""
SELECT strftime(transaction_date, '%Y-%m') AS monthly_period,
  {_sum("abs(amount)", "category IN ('Subscriptions', 'Fees') OR (category = 'Transfer' AND sub_category = 'Rent Payment')")}
    AS fixed_overhead,
  {_sum("abs(amount)", "category IN ('Meals', 'Groceries', 'Shopping', 'Transport', 'Travel', 'Medical')")}
    AS variable_lifestyle,
  {_sum("abs(amount)", "category NOT IN ('Transfer', 'Income') OR sub_category = 'Rent Payment'")}
    AS total_operational_spend
FROM travelled GROUP BY 1
"""
ORACLE["monthly_burn"] = T + _BURN
ORACLE["latest_burn_months"] = T + _BURN + "ORDER BY 1 DESC NULLS LAST LIMIT 6"
ORACLE["cash_match"] = A + """
SELECT transaction_id, transaction_date, CAST(amount AS DOUBLE) AS amount, override_category, is_loan, notes AS cash_notes
FROM labelled LEFT JOIN cash ON transaction_date = tx_date AND amount = cash_amount
"""
ORACLE["loan_tracking"] = A + """
SELECT tx_date, raw_description AS merchant_string, CAST(amount AS DOUBLE) AS amount,
  coalesce(override_category, category, 'Unclassified') AS final_category, is_loan AS is_account_receivable, notes
FROM labelled JOIN cash ON transaction_date = tx_date AND amount = cash_amount WHERE is_loan
"""

# Reports

ORACLE["ledger_status"] = L + f"SELECT category, count(*) AS n, {_sum()} AS total FROM ledger GROUP BY category"
ORACLE["tax_summary"] = M + """
SELECT category, count(*) AS total_count,
  CAST(sum(abs(amount) * (CASE direction WHEN 'Expense' THEN -1 ELSE 1 END)) AS DOUBLE) AS net_amount
FROM labelled GROUP BY category
"""
ORACLE["tax_export"] = M + """
SELECT transaction_date AS "Date", account_name AS "Account/Card", merchant_name AS "Clean Merchant",
  category AS "Tax Category", CAST(amount AS DOUBLE) AS "Amount", direction AS "Direction",
  raw_description AS "Raw Statement Line" FROM labelled
"""


def _history(source: str, term: str) -> str:
    return f"""
SELECT strftime(transaction_date, '%Y-%m') AS month, count(*) AS transactions, {_sum("abs(amount)")} AS total_spent
FROM {source} WHERE upper(merchant_name) LIKE upper('%{term}%') OR upper(raw_description) LIKE upper('%{term}%') GROUP BY 1
"""


ORACLE["merchant_history"] = M + _history("labelled", "Shop")
ORACLE["merchant_history_wildcard"] = L + _history("ledger", "amzn%us")
ORACLE["category_direction"] = M + f"""
SELECT category, direction, count(*) AS n, {_sum()} AS net FROM labelled GROUP BY ALL
"""
_PIVOTED = ", ".join(
    f"CAST(sum(amount) FILTER (strftime(transaction_date, '%Y-%m') = '1996-{m:02d}') AS DOUBLE) AS \"1996-{m:02d}\""
    for m in range(2, 8)
)
ORACLE["monthly_pivot"] = M + f"""
SELECT category, {_PIVOTED} FROM labelled
WHERE transaction_date >= DATE '1996-02-01' AND transaction_date < DATE '1996-08-01' GROUP BY category
"""
ORACLE["high_spenders"] = M + """
SELECT merchant_name, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_spent FROM labelled
WHERE direction = 'Expense' GROUP BY merchant_name HAVING sum(amount) < -500 ORDER BY sum(amount), merchant_name LIMIT 10
"""
_ACCOUNT_CATEGORY = f"SELECT account_name, category, {_sum()} AS amount FROM labelled"
ORACLE["account_category"] = M + _ACCOUNT_CATEGORY + " GROUP BY ALL"
ORACLE["account_groceries"] = M + _ACCOUNT_CATEGORY + " WHERE category = 'Groceries' GROUP BY ALL"


def _resample(label: str, step: str, nth: str, where: str = "") -> str:
    return f"""
, spending AS (SELECT {label} AS period, amount FROM labelled
    WHERE direction = 'Expense' AND transaction_date IS NOT NULL {where}),
spine AS (SELECT {nth} AS period FROM (
    SELECT unnest(generate_series(CAST(date_trunc('{step}', min(period)) AS TIMESTAMP), max(period), INTERVAL 1 {step})) AS t
    FROM spending))
SELECT period, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total FROM spine LEFT JOIN spending USING (period)
GROUP BY period
"""


_MONTH_END = ("last_day(transaction_date)", "month", "last_day(CAST(t AS DATE))")
ORACLE["monthly_resample"] = M + _resample(*_MONTH_END)
ORACLE["weekly_resample"] = M + _resample(
    "CAST(date_trunc('week', transaction_date) + INTERVAL 6 DAY AS DATE)",
    "week",
    "CAST(t + INTERVAL 6 DAY AS DATE)",
)
ORACLE["sparse_resample"] = M + _resample(*_MONTH_END, "AND category = 'Cash' AND sub_category = 'Person to Person Payment'")
ORACLE["category_channel"] = M + f"""
SELECT category, channel, {_sum()} AS total_spent, count(*) AS txn_count FROM labelled GROUP BY ALL
"""
_SPLIT = ", ".join(
    f"{_sum('amount', f'channel = {_text(channel)}')} AS {name}"
    for channel, name in (
        ("pos", "spent_direct"),
        ("instacart", "spent_via_instacart"),
        ("doordash", "spent_via_doordash"),
        ("uber_eats", "spent_via_uber_eats"),
    )
)
ORACLE["platform_analysis"] = L + f"""
SELECT category, {_SPLIT}, {_sum()} AS total_category_burn FROM ledger WHERE direction = 'Expense' GROUP BY category
"""
ORACLE["row_count"] = L + "SELECT count(*) AS n FROM ledger"


def _balance(source: str, where: str = "") -> str:
    return f"""
SELECT account_name, transaction_date, transaction_id, merchant_name, CAST(amount AS DOUBLE) AS amount,
  CAST(sum(amount) OVER (PARTITION BY account_name ORDER BY transaction_date NULLS LAST, transaction_id
    ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_balance
FROM {source} {where}
"""


ORACLE["running_balance"] = L + _balance("ledger")
ORACLE["running_balance_of_account"] = M + _balance("labelled", "WHERE account_name = 'acct_1'")
ORACLE["last_transactions"] = M + f"""
SELECT {_LEDGER_COLUMNS} FROM labelled ORDER BY transaction_date DESC NULLS LAST, transaction_id DESC LIMIT 6
"""
ORACLE["description_search"] = L + f"""
SELECT {_LEDGER_COLUMNS} FROM ledger WHERE raw_description ILIKE '%prime%member%'
"""
ORACLE["rows_for_merchant"] = L + f"SELECT {_LEDGER_COLUMNS} FROM ledger WHERE merchant_name = 'Amazon'"
ORACLE["net_of_transfers"] = M + f"SELECT {_LEDGER_COLUMNS} FROM labelled WHERE category <> 'Transfer'"
ORACLE["latest_months"] = L + """
SELECT DISTINCT strftime(transaction_date, '%Y-%m') AS month FROM ledger WHERE transaction_date IS NOT NULL
ORDER BY 1 DESC LIMIT 2
"""
ORACLE["compare_months"] = M + f"""
, months AS (SELECT DISTINCT strftime(transaction_date, '%Y-%m') AS m FROM labelled WHERE transaction_date IS NOT NULL
  ORDER BY 1 DESC LIMIT 2),
pair AS (SELECT min(m) AS last_month, max(m) AS current_month FROM months)
SELECT category, {_sum("abs(amount)", "strftime(transaction_date, '%Y-%m') = last_month")} AS last_total,
  {_sum("abs(amount)", "strftime(transaction_date, '%Y-%m') = current_month")} AS current_total,
  last_month, current_month
FROM labelled, pair
WHERE direction = 'Expense' AND strftime(transaction_date, '%Y-%m') IN (last_month, current_month)
GROUP BY category, last_month, current_month
"""

# Keeping tables

ORACLE["insert_if_absent"] = R + """
SELECT transaction_id, account_name, CASE o_orderstatus WHEN 'O' THEN 'stored' ELSE account_type END AS account_type,
  transaction_date, raw_description, CAST(amount AS DOUBLE) AS amount, direction FROM raw
"""
ORACLE["upsert_labels"] = L + """
SELECT transaction_id, transaction_date, account_name, raw_description, merchant_name,
  CASE o_orderstatus WHEN 'O' THEN 'old' ELSE category END AS category, sub_category,
  CAST(CASE o_orderstatus WHEN 'F' THEN amount ELSE amount * 2 END AS DOUBLE) AS amount, direction,
  CASE o_orderstatus WHEN 'O' THEN 'old' ELSE channel END AS channel FROM swept
"""
ORACLE["upsert_by_key"] = """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN upper(c_name) ELSE c_name END AS c_name,
  c_mktsegment, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 2 ELSE 0 END AS seq FROM customer
"""
ORACLE["replaced_table"] = ORACLE["cash_sidecar"]
ORACLE["stored_ledger"] = L + """
SELECT * EXCLUDE (o_orderstatus) REPLACE (CAST(amount AS DOUBLE) AS amount, upper(channel) AS channel) FROM swept
WHERE o_orderstatus IN ('F', 'O') AND account_name <> 'acct_3'
"""
ORACLE["delete_account"] = L + f"SELECT {_LEDGER_COLUMNS} FROM ledger WHERE account_name <> 'acct_1'"
ORACLE["delete_accounts"] = L + f"SELECT {_LEDGER_COLUMNS} FROM ledger WHERE account_name NOT IN ('acct_1', 'acct_4')"
ORACLE["delete_account_window"] = L + f"""
SELECT {_LEDGER_COLUMNS} FROM ledger WHERE NOT (account_name = 'acct_3'
  AND coalesce(transaction_date BETWEEN DATE '1996-01-15' AND DATE '1998-01-20', false))
"""
ORACLE["stored_raw_transactions"] = R + """
SELECT * EXCLUDE (o_orderstatus, file, pos) REPLACE (CAST(amount AS DOUBLE) AS amount) FROM raw
WHERE account_name <> 'acct_1' AND NOT (account_name = 'acct_3'
  AND coalesce(transaction_date BETWEEN DATE '1996-01-15' AND DATE '1998-01-20', false))
"""
ORACLE["stored_window"] = L + f"""
SELECT {_LEDGER_COLUMNS} FROM ledger WHERE transaction_date BETWEEN DATE '1997-03-10' AND DATE '1997-11-05'
"""
ORACLE["truncated_tables"] = """
SELECT 'customer' AS source, count(*) AS n_before, CAST(0 AS BIGINT) AS n_after, CAST(2 AS BIGINT) AS turn FROM customer
UNION ALL SELECT 'orders', count(*), 0, 1 FROM orders
"""
ORACLE["upsert_trips"] = _with(_TRIPS) + """
SELECT trip_id, start_date, end_date, trip_type,
  CASE WHEN CAST(substr(trip_id, 6) AS BIGINT) % 3 <> 0 THEN upper(destination) ELSE destination END AS destination, notes
FROM trips
"""
ORACLE["cash_rejects"] = """
SELECT 'entry ' || o_orderkey AS notes,
  CASE WHEN o_orderkey % 5 = 0 THEN 'unrecognized date' WHEN o_orderkey % 7 = 0 THEN 'amount is not a number'
    ELSE 'loan flag is not true or false' END AS reason
FROM orders WHERE o_orderstatus = 'P' AND (o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0)
"""
ORACLE["file_preview"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey
FROM customer ORDER BY customer.c_custkey LIMIT 5
"""
ORACLE["ingest_from_files"] = ORACLE["ingest_statements"]
_OWNED = "CAST(regexp_extract(file, '[0-9]+') AS BIGINT) % 4 <> 3"
_REASON = """CASE WHEN wide THEN 'more cells than the header' WHEN date_text IS NULL THEN 'no date'
  WHEN amount_text IS NULL THEN 'no amount' WHEN parsed IS NULL THEN 'amount is not a number' END"""
ORACLE["rejected_input"] = S + f"""
, judged AS (
  SELECT file, 'file' AS kind, CASE WHEN style = 5 THEN 'no header row with a date and a description column'
    WHEN style = 4 THEN 'amount column not mapped' ELSE 'no account for the file' END AS reason
  FROM heads WHERE style >= 4 OR NOT ({_OWNED})
  UNION ALL SELECT file, 'row', reason FROM (
    SELECT file, {_REASON} AS reason FROM (
      SELECT *, TRY_CAST(replace(replace(replace(amount_text, '(', ''), ')', ''), ' ', '') AS DECIMAL(18,2)) AS parsed FROM cells)
    WHERE style < 4 AND {_OWNED}) WHERE reason IS NOT NULL)
SELECT file, kind, reason, count(*) AS n FROM judged GROUP BY ALL
"""
