"""DuckDB SQL for every registered query, over the driver's tables.

Fixed values: column lists, metric names and metric definitions are those of the outputs to match.
"""

from __future__ import annotations

FIRST, LAST = "1996-01-01", "1997-06-30"
COMPANY = "Supplier#000000001"
RUN_TS = "2026-07-11T02:00:00.000Z"
LOGICAL_DATE = "1995-02-19"
RUN_DATE = "2001-08-01"
EARLIER_TS = "2026-07-10T02:00:00.000Z"
DAY = f"coalesce(date_received::DATE, DATE '{RUN_TS[:10]}')"
MISSING = 3
SEARCH, TOP = "Blue bolt, urgent GERMANY", 50

LINES = """
lines AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS copy
    FROM lineitem)
  WHERE copy = 1)"""

_SHAPE = """
SELECT
  CASE WHEN l_partkey % 79 <> 0 THEN p_type END AS product,
  p_name AS complaint_what_happened,
  l_shipdate AS date_sent_to_company,
  CASE WHEN l_partkey % 83 <> 0 THEN o_orderpriority END AS issue,
  CASE WHEN p_size % 10 <> 0 THEN p_brand END AS sub_product,
  CAST(o_custkey % 1000 AS VARCHAR) AS zip_code,
  CASE WHEN l_quantity % 3 = 0 THEN c_mktsegment END AS tags,
  l_discount >= 0.05::DOUBLE AS has_narrative,
  l_orderkey * 8 + l_linenumber AS complaint_id,
  CASE WHEN l_tax <= 0.06::DOUBLE THEN CASE WHEN l_linestatus = 'F' THEN 'Yes' ELSE 'No' END END AS timely,
  CASE WHEN l_orderkey % 97 <> 0 THEN o_orderstatus END AS company_response,
  l_returnflag AS submitted_via,
  CASE WHEN l_suppkey % 41 <> 0 THEN s_name END AS company,
  CASE WHEN l_orderkey % 101 <> 0 THEN o_orderdate END AS date_received,
  CASE WHEN o_custkey % 89 <> 0 THEN n_name END AS state,
  o_orderpriority AS company_public_response,
  CASE WHEN l_quantity % 5 <> 0 THEN c_mktsegment END AS sub_issue,
  l_shipdate AS extracted_at
FROM {source}
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN part ON l_partkey = p_partkey"""

CHAIN = """
keys AS (SELECT complaint_id AS id, complaint_id // 4800 AS page FROM shaped),
bounds AS (
  SELECT page, min(id) AS lo, max(id) AS hi, count(*) AS n,
    lag(min(id)) OVER w AS lo1, lag(max(id)) OVER w AS hi1, lag(max(id), 2) OVER w AS hi2, lag(count(*)) OVER w AS n1
  FROM keys GROUP BY page WINDOW w AS (ORDER BY page)),
landed AS (
  SELECT CASE WHEN page % 11 = 4 THEN hi2 ELSE hi1 END AS asked, CASE WHEN page % 11 = 4 THEN lo1 ELSE lo END AS lo, hi,
    CASE WHEN page % 11 = 4 THEN n + n1 ELSE n END AS n, page % 5 = 1 AS twice
  FROM bounds WHERE page % 7 <> 3),
chained AS (SELECT *, max(hi) OVER (ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM landed),
held AS (SELECT DISTINCT id FROM keys, landed WHERE id BETWEEN lo AND hi)"""

BM25 = r"""
texts AS (
  SELECT complaint_id, company, unnest(regexp_extract_all(
    lower(concat_ws(' ', complaint_what_happened, issue, state, tags)), '[\p{L}\p{N}]+')) AS term
  FROM shaped),
lengths AS (SELECT complaint_id, company, count(*) AS length FROM texts GROUP BY ALL),
corpus AS (SELECT count(*) AS n, sum(length) / count(*) AS mean FROM lengths),
tf AS (SELECT complaint_id, term, count(*) AS tf FROM texts WHERE term IN ('blue', 'bolt', 'urgent', 'germany') GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
ranked AS (
  SELECT complaint_id, company, round(sum(
    ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
      / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / mean))), 9) AS score
  FROM tf JOIN df USING (term) JOIN lengths USING (complaint_id), corpus GROUP BY ALL)"""

SHAPED = LINES + ",\nshaped AS (" + _SHAPE.format(source="lines") + ")"
VERSIONS = "versions AS (" + _SHAPE.format(source="lineitem") + ")"

STAGED = """
stg AS (
  SELECT complaint_id, product, sub_product, issue, sub_issue, company, state, zip_code, submitted_via,
    date_received::DATE AS date_received, date_sent_to_company::DATE AS date_sent_to_company,
    company_response, company_public_response, timely, has_narrative, complaint_what_happened, tags,
    extracted_at AS dbt_extracted_at
  FROM shaped)"""

METRICS = """
met AS (
  SELECT *,
    datediff('day', date_received, date_sent_to_company) AS days_to_response,
    CASE WHEN timely = 'Yes' THEN true WHEN timely = 'No' THEN false END AS is_timely_response,
    extract(year FROM date_received) AS complaint_year,
    extract(month FROM date_received) AS complaint_month,
    date_trunc('month', date_received)::DATE AS complaint_month_date
  FROM stg)"""

FACT = """
fct AS (
  SELECT complaint_id, product, sub_product, issue, sub_issue, company, state, zip_code, submitted_via,
    company_response, company_public_response, date_received, date_sent_to_company, complaint_year,
    complaint_month, complaint_month_date, days_to_response, is_timely_response, has_narrative,
    complaint_what_happened, tags
  FROM met)"""

FLAGS = """
    count_if(is_timely_response)::BIGINT AS timely_responses,
    round(100.0 * count_if(is_timely_response) / count(*), 2) AS pct_timely,
    count_if(has_narrative)::BIGINT AS complaints_with_narrative,
    round(100.0 * count_if(has_narrative) / count(*), 2) AS pct_with_narrative"""
DAYS = """
    round(avg(days_to_response), 2) AS avg_days_to_response,
    median(days_to_response) AS median_days_to_response"""
EXTREMES = """
    min(days_to_response) AS min_days_to_response,
    max(days_to_response) AS max_days_to_response"""
DATES = """
    min(date_received) AS first_complaint_date,
    max(date_received) AS last_complaint_date"""


def _mode(column: str, name: str) -> str:
    return f"mode() WITHIN GROUP (ORDER BY {column}) AS {name}"


def _distinct(column: str, name: str) -> str:
    return f"count(DISTINCT {column}) AS {name}"


C, P, S = (
    _distinct("company", "unique_companies"),
    _distinct("product", "unique_products"),
    _distinct("state", "unique_states"),
)


def _grouped(name: str, keys: str, measures: list[str], key: str) -> str:
    columns = ",\n    ".join([keys, *[m.strip() for m in measures]])
    return f"\n{name} AS (\n  SELECT {columns}\n  FROM met WHERE {key} IS NOT NULL GROUP BY {keys})"


MONTHLY = _grouped(
    "monthly",
    "complaint_month_date",
    ["extract(year FROM complaint_month_date) AS year", "extract(month FROM complaint_month_date) AS month",
     "count(*) AS total_complaints", C, P, S, FLAGS, DAYS],
    "complaint_month_date",
)
COMPANIES = _grouped(
    "companies",
    "company",
    ["count(*) AS total_complaints", "count_if(is_timely_response)::BIGINT AS timely_responses",
     "count_if(has_narrative)::BIGINT AS complaints_with_narrative",
     "round(count_if(is_timely_response) / count(*) * 100.0, 2) AS pct_timely",
     "round(100.0 * count_if(has_narrative) / count(*), 2) AS pct_with_narrative", DAYS, EXTREMES, DATES],
    "company",
)
STATES = _grouped(
    "states",
    "state",
    ["count(*) AS total_complaints", C, P, _distinct("issue", "unique_issues"),
     _distinct("zip_code", "unique_zip_codes"), FLAGS, DAYS, EXTREMES, DATES,
     _mode("issue", "most_common_issue"), _mode("product", "most_common_product"),
     _mode("submitted_via", "most_common_submission_method"), _mode("company", "most_complained_company")],
    "state",
)
RESPONSES = _grouped(
    "responses",
    "company_response",
    ["count(*) AS total_complaints", C, P, S, FLAGS, DAYS, EXTREMES, DATES,
     _mode("product", "most_common_product"), _mode("issue", "most_common_issue"),
     _mode("company", "most_complained_company")],
    "company_response",
)
PRODUCT_STATS = _grouped(
    "product_stats",
    "product, sub_product",
    ["count(*) AS total_complaints", C, S, FLAGS, DAYS, DATES,
     _mode("issue", "most_common_issue"), _mode("company", "most_complained_company")],
    "product",
)
ISSUE_STATS = _grouped(
    "issue_stats",
    "issue, sub_issue",
    ["count(*) AS total_complaints", C, P, S, FLAGS, DAYS, DATES,
     _mode("product", "most_common_product"), _mode("company", "most_complained_company")],
    "issue",
)


def _totals(name: str, stats: str, parent: str, child: str, distinct: list[str], modes: list[str]) -> str:
    """Parent rows from child rows; the average of two-decimal values is summed as DECIMAL."""
    return f"""
{name} AS (
  SELECT {parent}, NULL::VARCHAR AS {child},
    sum(total_complaints)::BIGINT AS total_complaints,
    {", ".join(f"count(DISTINCT {c}) AS {c}" for c in distinct)},
    sum(timely_responses)::BIGINT AS timely_responses,
    round(100.0 * sum(timely_responses) / sum(total_complaints), 2) AS pct_timely,
    sum(complaints_with_narrative)::BIGINT AS complaints_with_narrative,
    round(100.0 * sum(complaints_with_narrative) / sum(total_complaints), 2) AS pct_with_narrative,
    round(sum(avg_days_to_response::DECIMAL(18,2))::DOUBLE / count(avg_days_to_response), 2) AS avg_days_to_response,
    round(avg(median_days_to_response), 2) AS median_days_to_response,
    min(first_complaint_date) AS first_complaint_date,
    max(last_complaint_date) AS last_complaint_date,
    {", ".join(_mode(c, c) for c in modes)}
  FROM {stats} GROUP BY {parent}),
{name.removesuffix("_totals")}s AS (SELECT * FROM {stats} UNION ALL SELECT * FROM {name})"""


PRODUCTS = PRODUCT_STATS + "," + _totals(
    "product_totals", "product_stats", "product", "sub_product",
    ["unique_companies", "unique_states"], ["most_common_issue", "most_complained_company"],
)
ISSUES = ISSUE_STATS + "," + _totals(
    "issue_totals", "issue_stats", "issue", "sub_issue",
    ["unique_companies", "unique_products", "unique_states"], ["most_common_product", "most_complained_company"],
)
COVERAGE = """
coverage AS (
  SELECT count(*) AS total_complaints, count(DISTINCT company) AS total_companies,
    count(DISTINCT product) AS total_products, count(DISTINCT state) AS total_states,
    min(date_received) AS first_complaint_date, max(date_received) AS last_complaint_date,
    round(100.0 * count_if(is_timely_response) / count(*), 2) AS pct_timely,
    round(100.0 * count_if(has_narrative) / count(*), 2) AS pct_with_narrative
  FROM met)"""

_BASE = [SHAPED, STAGED, METRICS]


def _sql(body: str, *parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body


def on_shape(body: str) -> str:
    return _sql(body, SHAPED)


def on_metrics(body: str, *parts: str) -> str:
    return _sql(body, *_BASE, *parts)


def between(table: str, part: str) -> str:
    """A mart of the complaints of some months alone."""
    months = f"date_trunc('month', date_received) BETWEEN date_trunc('month', DATE '{FIRST}') AND date_trunc('month', DATE '{LAST}')"
    return _sql(f"SELECT * FROM {table}", SHAPED, STAGED, METRICS.replace("FROM stg)", f"FROM stg WHERE {months})"), part)


BRONZE_COLUMNS = (
    "product, complaint_what_happened, date_sent_to_company, issue, sub_product, zip_code, tags, has_narrative, "
    "complaint_id, timely, company_response, submitted_via, company, date_received, state, "
    "company_public_response, sub_issue, extracted_at"
)
_UTC = "strftime({c}, '%Y-%m-%dT%H:%M:%S.000Z')"
TEXT_COLUMNS = (
    "product, complaint_what_happened, " + _UTC.format(c="date_sent_to_company") + " AS date_sent_to_company, issue, "
    "sub_product, zip_code, tags, has_narrative::VARCHAR AS has_narrative, complaint_id::VARCHAR AS complaint_id, "
    "timely, company_response, submitted_via, company, " + _UTC.format(c="date_received") + " AS date_received, "
    "state, company_public_response, sub_issue, {extracted} AS extracted_at"
)
LOADED = BRONZE_COLUMNS.replace("extracted_at", f"TIMESTAMP '{RUN_TS[:-1]}' AS extracted_at")

UPSERTED = """
newest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY complaint_id
      ORDER BY submitted_via DESC, extracted_at DESC NULLS LAST, product DESC NULLS LAST,
        complaint_what_happened DESC NULLS LAST, date_sent_to_company DESC NULLS LAST, issue DESC NULLS LAST,
        sub_product DESC NULLS LAST, zip_code DESC NULLS LAST, tags DESC NULLS LAST,
        has_narrative DESC NULLS LAST, timely DESC NULLS LAST, company_response DESC NULLS LAST,
        company DESC NULLS LAST, date_received DESC NULLS LAST, state DESC NULLS LAST,
        company_public_response DESC NULLS LAST, sub_issue DESC NULLS LAST) AS copy
    FROM versions)
  WHERE copy = 1)"""

_TOP = "ORDER BY total_complaints DESC"
_COUNT_PCT = "pct_timely, pct_with_narrative, avg_days_to_response"
_DASH = {
    "dash_monthly": ("monthly", MONTHLY, "complaint_month_date, total_complaints, unique_companies, unique_products, "
                     f"unique_states, {_COUNT_PCT}"),
    "dash_companies": ("companies", COMPANIES, f"company, total_complaints, {_COUNT_PCT}, median_days_to_response, "
                       "first_complaint_date, last_complaint_date"),
    "dash_states": ("states", STATES, "state, total_complaints, unique_companies, unique_products, unique_issues, "
                    f"{_COUNT_PCT}, most_common_product, most_common_issue, most_complained_company"),
    "dash_products": ("products", PRODUCTS, "product, sub_product, total_complaints, unique_companies, unique_states, "
                      f"{_COUNT_PCT}, most_common_issue, most_complained_company"),
    "dash_issues": ("issues", ISSUES, "issue, sub_issue, total_complaints, unique_companies, unique_products, "
                    f"unique_states, {_COUNT_PCT}, most_common_product, most_complained_company"),
    "dash_responses": ("responses", RESPONSES, "company_response, total_complaints, unique_companies, "
                       f"unique_products, unique_states, {_COUNT_PCT}, most_common_product, most_common_issue, "
                       "most_complained_company"),
}
_MIX = f"""
mix AS (
  SELECT product, sub_product, total_complaints, pct_timely FROM products WHERE sub_product IS NOT NULL
  {_TOP}, product, sub_product LIMIT 80)"""


def _all_columns(table: str, part: str) -> str:
    return on_metrics(f"SELECT * FROM {table}", part)


def _failures(model: str, source: str, column: str, unique: bool = True) -> list[str]:
    rows = [
        f"SELECT '{model}' AS model, '{column}' AS column_name, 'not_null' AS test, count(*) AS failures "
        f"FROM {source} WHERE {column} IS NULL"
    ]
    if unique:
        rows.append(
            f"SELECT '{model}', '{column}', 'unique', count(*) FROM (SELECT {column} FROM {source} "
            f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
        )
    return rows


def oracle_sql() -> dict[str, str]:
    not_null = {
        "not_null_company": ("company", "met"),
        "not_null_month": ("complaint_month_date", "met"),
        "not_null_issue": ("issue", "met"),
        "not_null_product": ("product", "met"),
        "not_null_response": ("company_response", "met"),
        "not_null_state": ("state", "met"),
    }
    frames = [MONTHLY, COMPANIES, STATES, PRODUCTS, ISSUES, RESPONSES, COVERAGE]
    frame_names = ["monthly", "companies", "states", "products", "issues", "responses", "coverage"]
    report = [
        *_failures("complaints", "shaped", "complaint_id"),
        *_failures("stg_complaints", "stg", "complaint_id"),
        *_failures("fct_complaints", "fct", "complaint_id"),
        *_failures("agg_complaints_by_month", "monthly", "complaint_month_date"),
        *_failures("dim_companies", "companies", "company"),
        *_failures("dim_issues", "issues", "issue", unique=False),
        *_failures("dim_products", "products", "product", unique=False),
        *_failures("dim_response_types", "responses", "company_response"),
        *_failures("dim_states", "states", "state"),
    ]
    broken = [
        *_failures("complaints", "versions", "complaint_id"),
        *_failures("stg_complaints", "versions", "complaint_id"),
        *_failures("fct_complaints", "fct", "complaint_id"),
        *_failures("agg_complaints_by_month", "undated", "complaint_month_date"),
        *_failures("dim_companies", "twice", "company"),
        *_failures("dim_issues", "issues", "issue", unique=False),
        *_failures("dim_products", "products", "product", unique=False),
        *_failures("dim_response_types", "responses", "company_response"),
        "SELECT 'dim_states', 'state', 'not_null', 1",
        "SELECT 'dim_states', 'state', 'unique', 1",
    ]
    return {
        # sources, sinks, table lifecycle
        "flatten_pages": on_shape(f"SELECT {TEXT_COLUMNS.format(extracted='NULL::VARCHAR')} FROM shaped"),
        "filter_received_range": on_shape(
            f"SELECT {BRONZE_COLUMNS} FROM shaped WHERE date_received::DATE BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"
        ),
        "filter_company": on_shape(f"SELECT {BRONZE_COLUMNS} FROM shaped WHERE company = '{COMPANY}'"),
        "sort_created": on_shape(
            "SELECT complaint_id, date_received, company, product FROM shaped ORDER BY date_received DESC NULLS LAST, complaint_id"
        ),
        "chunk_records": on_shape("SELECT count(*) AS records, true AS a_day_exceeds_it, true AS within_chunk_size FROM shaped"),
        "reconcile_counts": on_shape(
            "SELECT 'whole' AS fetch, count(*) AS expected, count(*) AS actual, true AS is_complete FROM shaped "
            f"UNION ALL SELECT 'short', count(*) + {MISSING}, count(*), false FROM shaped"
        ),
        "sort_relevance": _sql("SELECT complaint_id, company, round(score, 6) AS score FROM ranked", SHAPED, BM25),
        "top_relevant": _sql(
            f"SELECT complaint_id, round(score, 6) AS score FROM ranked ORDER BY ranked.score DESC, complaint_id LIMIT {TOP}", SHAPED, BM25
        ),
        "chain_findings": _sql(
            "SELECT '20260711T020000000Z' AS fetch, * FROM ("
            "SELECT 'doubled' AS finding, lo::VARCHAR AS after, hi::VARCHAR AS before, 1 AS pages, n AS records FROM chained WHERE twice "
            "UNION ALL SELECT 'gap', reached::VARCHAR, asked::VARCHAR, NULL, NULL FROM chained WHERE asked > coalesce(reached, -1) "
            "UNION ALL SELECT 'overlap', lo::VARCHAR, least(reached, hi)::VARCHAR, 1, NULL FROM chained WHERE lo <= reached)",
            SHAPED,
            CHAIN,
        ),
        "reconcile_chain": _sql(
            "SELECT '20260711T020000000Z' AS fetch, (SELECT count(*) FROM keys) AS expected, "
            "sum(CASE WHEN twice THEN 2 * n ELSE n END)::BIGINT AS records, (SELECT count(*) FROM held) AS different_records, "
            "count(*) + count(*) FILTER (twice) AS pages, count(*) FILTER (twice) AS doubled_pages, "
            "count(*) FILTER (asked > coalesce(reached, -1)) AS gaps, count(*) FILTER (lo <= reached) AS overlaps, "
            "false AS is_closed, count(*) FILTER (asked > coalesce(reached, -1)) = 0 "
            "AND (SELECT count(*) FROM keys) = (SELECT count(*) FROM held) AS is_complete FROM chained",
            SHAPED,
            CHAIN,
        ),
        "run_correction": on_shape(
            f"SELECT {LOADED} FROM shaped WHERE date_received::DATE = DATE '{LOGICAL_DATE}' - 1"
        ),
        "staging_view": _sql(f"SELECT * REPLACE (TIMESTAMP '{RUN_TS[:-1]}' AS dbt_extracted_at) FROM stg", SHAPED, STAGED),
        "metric_view": on_metrics(f"SELECT * REPLACE (TIMESTAMP '{RUN_TS[:-1]}' AS dbt_extracted_at) FROM met"),
        "listed_months": on_metrics(
            "SELECT *, row_number() OVER (ORDER BY complaint_month_date DESC) AS position FROM monthly", MONTHLY
        ),
        "listed_states": on_metrics(
            "SELECT *, row_number() OVER (ORDER BY total_complaints DESC, state) AS position FROM states", STATES
        ),
        "listed_products": on_metrics(
            "SELECT *, row_number() OVER (ORDER BY product, sub_product NULLS FIRST, total_complaints DESC) AS position FROM products",
            PRODUCTS,
        ),
        "stamp_extracted_at": on_shape(f"SELECT complaint_id::VARCHAR AS complaint_id, '{RUN_TS}' AS extracted_at FROM shaped"),
        "write_raw_jsonl": on_shape(
            f"SELECT complaint_id::VARCHAR AS complaint_id, sub_product, {DAY} AS process_date, "
            "sub_product IS NULL AS null_is_written FROM shaped"
        ),
        "raw_path": on_shape(f"SELECT {DAY} AS process_date, count(*) AS records FROM shaped GROUP BY 1"),
        "read_raw_jsonl": on_shape(f"SELECT {TEXT_COLUMNS.format(extracted=chr(39) + RUN_TS + chr(39))} FROM shaped"),
        "write_bronze": on_shape(
            f"SELECT {DAY} AS process_date, count(*) AS records, "
            "count_if(has_narrative)::BIGINT AS narratives FROM shaped GROUP BY 1"
        ),
        "find_company": on_shape(
            f"SELECT {BRONZE_COLUMNS} FROM shaped WHERE company = '{COMPANY}' "
            f"AND date_received::DATE BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"
        ),
        "scan_bronze": on_shape(
            f"SELECT {LOADED} FROM shaped WHERE date_received::DATE BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"
        ),
        "create_if_absent": on_shape("SELECT count(*) AS n_rows, 18 AS n_columns, true AS table_exists FROM shaped"),
        "upsert_by_key": _sql(f"SELECT {BRONZE_COLUMNS} FROM newest", VERSIONS, UPSERTED),
        "upsert_merge_on_read": _sql(f"SELECT {BRONZE_COLUMNS} FROM newest", VERSIONS, UPSERTED),
        "load_summary": on_shape(
            "SELECT count(*) AS records_processed, count(*) AS total_records_in_table, 'success' AS status FROM shaped"
        ),
        "materialize": _all_columns("companies", COMPANIES),
        "schema_for_layer": _all_columns("monthly", MONTHLY),
        "source_table": on_shape(f"SELECT {LOADED} FROM shaped"),
        "process_date": (
            "SELECT o_orderdate::DATE AS logical_date, (o_orderdate::DATE - INTERVAL 1 DAY)::DATE AS process_date, "
            "count(*) AS runs FROM orders GROUP BY 1, 2"
        ),
        "run_daily": on_metrics(
            f"SELECT 'records_processed' AS part, count_if(coalesce(date_received, DATE '{LOGICAL_DATE}' - 1) = DATE '{LOGICAL_DATE}' - 1)::BIGINT AS n FROM met "
            "UNION ALL SELECT 'total_records_in_table', count(*) FROM met "
            "UNION ALL SELECT 'expected', count(*) FROM met UNION ALL SELECT 'actual', count(*) FROM met "
            "UNION ALL SELECT concat_ws('.', model, column_name, test), failures FROM (" + " UNION ALL ".join(report) + ")",
            FACT, MONTHLY, COMPANIES, ISSUES, PRODUCTS, RESPONSES, STATES,
        ),
        "run_backfill": on_shape(
            "SELECT count(*) AS records_processed, count(*) AS total_records_in_table, 'success' AS status FROM shaped"
        ),
        "read_marts": on_metrics(
            " UNION ALL ".join(f"SELECT '{name}' AS frame, count(*) AS n_rows FROM {name}" for name in frame_names),
            *frames,
        ),
        "resume_backfill": on_shape(
            "SELECT 1 AS call, 'success' AS status, count(*) AS records_processed, count(*) AS total_records_in_table FROM shaped "
            f"WHERE coalesce(date_received::DATE, DATE '{FIRST}') BETWEEN DATE '{FIRST}' AND DATE '{LAST}' "
            f"UNION ALL SELECT 2, 'success', count_if({DAY} NOT BETWEEN DATE '{FIRST}' + 1 AND DATE '{LAST}'), count(*) FROM shaped"
        ),
        "states_between": between("states", STATES),
        "products_between": between("products", PRODUCTS),
        "marts_after_change": _all_columns("states", STATES),
        "read_marts_as_of": on_metrics(f"SELECT {_DASH['dash_companies'][2]} FROM companies", COMPANIES),
        # projections and predicates
        "normalize_schema": on_shape(f"SELECT {BRONZE_COLUMNS} FROM shaped"),
        "stg_complaints": _sql("SELECT * FROM stg", SHAPED, STAGED),
        "int_complaint_metrics": on_metrics("SELECT * FROM met"),
        "fct_complaints": on_metrics("SELECT * FROM fct", FACT),
        **{
            key: on_metrics(f"SELECT complaint_id, {column} FROM {source} WHERE {column} IS NOT NULL")
            for key, (column, source) in not_null.items()
        },
        "is_rollup_row": on_metrics("SELECT * FROM products WHERE sub_product IS NULL", PRODUCTS),
        "is_leaf_row": on_metrics("SELECT * FROM products WHERE sub_product IS NOT NULL", PRODUCTS),
        # marts
        "agg_complaints_by_month": _all_columns("monthly", MONTHLY),
        "dim_companies": _all_columns("companies", COMPANIES),
        "dim_states": _all_columns("states", STATES),
        "dim_response_types": _all_columns("responses", RESPONSES),
        "product_stats": _all_columns("product_stats", PRODUCTS),
        "product_totals": _all_columns("product_totals", PRODUCTS),
        "dim_products": _all_columns("products", PRODUCTS),
        "issue_stats": _all_columns("issue_stats", ISSUES),
        "issue_totals": _all_columns("issue_totals", ISSUES),
        "dim_issues": _all_columns("issues", ISSUES),
        # serving
        **{key: on_metrics(f"SELECT {columns} FROM {table}", part) for key, (table, part, columns) in _DASH.items()},
        "dash_coverage": _all_columns("coverage", COVERAGE),
        "monthly_trend": on_metrics("SELECT complaint_month_date, total_complaints, pct_timely FROM monthly", MONTHLY),
        "top_companies": on_metrics(
            "SELECT company, total_complaints, pct_timely, pct_with_narrative, avg_days_to_response, "
            f"first_complaint_date, last_complaint_date FROM companies {_TOP}, company LIMIT 15",
            COMPANIES,
        ),
        "top_products": on_metrics(
            "SELECT product, total_complaints, avg_days_to_response FROM products WHERE sub_product IS NULL "
            f"{_TOP}, product, avg_days_to_response NULLS FIRST LIMIT 15",
            PRODUCTS,
        ),
        "top_issues": on_metrics(
            "SELECT issue, total_complaints, unique_companies, unique_products, pct_timely, pct_with_narrative, "
            "avg_days_to_response, most_common_product, most_complained_company FROM issues WHERE sub_issue IS NULL "
            f"{_TOP}, issue, unique_companies, unique_products LIMIT 15",
            ISSUES,
        ),
        "product_mix": on_metrics("SELECT * FROM mix", PRODUCTS, _MIX),
        "product_mix_parent": on_metrics(
            "SELECT product, sum(total_complaints)::BIGINT AS total_complaints, "
            "sum(total_complaints * pct_timely::DECIMAL(18,2))::DOUBLE / sum(total_complaints) AS pct_timely "
            "FROM mix GROUP BY product",
            PRODUCTS,
            _MIX,
        ),
        "top_states": on_metrics(
            "SELECT state, total_complaints, unique_companies, unique_products, unique_issues, pct_timely, "
            "avg_days_to_response, most_common_product, most_common_issue, most_complained_company "
            f"FROM states {_TOP}, state LIMIT 15",
            STATES,
        ),
        "response_outcomes": on_metrics(
            f"SELECT {_DASH['dash_responses'][2]} FROM responses ORDER BY total_complaints, company_response", RESPONSES
        ),
        "kpi_header": on_metrics(
            "SELECT format('{:,}', total_complaints) AS complaints, format('{:,}', total_companies) AS companies, "
            "format('{:,}', total_products) AS products, coalesce(printf('%.1f%%', pct_timely), '-') AS timely, "
            "coalesce(printf('%.1f%%', pct_with_narrative), '-') AS narratives FROM coverage",
            COVERAGE,
        ),
        # incremental loads
        "incremental_upsert": on_shape(f"SELECT {LOADED} FROM shaped"),
        "refresh_recent": on_shape(
            f"SELECT * REPLACE (CASE WHEN date_received::DATE >= DATE '{RUN_DATE}' - 90 THEN 'refreshed' ELSE tags END AS tags) "
            f"FROM (SELECT {BRONZE_COLUMNS} FROM shaped)"
        ),
        "lookback_window": on_shape(
            f"SELECT {BRONZE_COLUMNS} FROM shaped WHERE date_received::DATE >= DATE '{RUN_DATE}' - 90"
        ),
        # checks
        "dq_unique": "SELECT l_orderkey * 8 + l_linenumber AS complaint_id, count(*) AS n FROM lineitem "
        "GROUP BY 1 HAVING count(*) > 1",
        "dq_not_null": on_shape(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) AS failures FROM shaped WHERE {c} IS NULL"
                for c in ["complaint_id", "sub_product", "sub_issue", "timely", "tags"]
            )
        ),
        "dq_table_exists": on_metrics(
            "SELECT n_rows, table_exists FROM (SELECT count(*) AS n_rows FROM companies), (VALUES (true), (false)) t(table_exists)",
            COMPANIES,
        ),
        "dq_required_columns": on_shape(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count({c}) AS rows_with_value, true AS is_present FROM shaped"
                for c in ["complaint_id", "company", "product", "date_received"]
            )
            + " UNION ALL SELECT 'issue', 0, false"
        ),
        "dq_has_rows": on_shape(
            "SELECT 'all' AS part, count(*) > 0 AS has_rows FROM shaped UNION ALL SELECT 'none', false"
        ),
        "dq_key_unique_ratio": _sql(
            "SELECT count(DISTINCT complaint_id) AS unique_count, count(*) AS total_count, "
            "count(DISTINCT complaint_id) = count(*) AS is_unique FROM versions",
            VERSIONS,
        ),
        "dq_sample_required": on_shape(
            "SELECT count(*) AS rows_checked, count_if(company IS NULL)::BIGINT AS missing_company, "
            "count_if(product IS NULL)::BIGINT AS missing_product, count_if(issue IS NULL)::BIGINT AS missing_issue, "
            "count_if(date_received IS NULL)::BIGINT AS missing_date_received FROM shaped WHERE complaint_id IS NOT NULL"
        ),
        "dq_valid_ratio": on_shape(
            "SELECT count(timely) AS valid_rows, count(*) AS total_rows, count(timely) / count(*) AS valid_ratio, "
            "count(timely) / count(*) >= 0.9 AS passed FROM shaped"
        ),
        "dq_report": _sql(
            " UNION ALL ".join(broken), SHAPED, STAGED, METRICS, FACT, MONTHLY, ISSUES, COMPANIES, PRODUCTS, RESPONSES, VERSIONS,
            "twice AS (SELECT * FROM companies UNION ALL SELECT * FROM companies)",
            "undated AS (SELECT * FROM monthly UNION ALL BY NAME SELECT NULL::DATE AS complaint_month_date)",
        ),
    }
