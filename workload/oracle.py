"""The same results in plain SQL, written without looking at how the operators work."""

from __future__ import annotations

# Snapshots as text, from line items and parts.
_WIDE = """
m AS (
  SELECT l_partkey AS k, CAST(year(l_shipdate) AS INT) AS y, count(*) AS n,
         count(*) FILTER (WHERE l_returnflag = 'A') AS a,
         count(*) FILTER (WHERE l_returnflag = 'N') AS b,
         count(*) FILTER (WHERE l_returnflag = 'R') AS c,
         count(*) FILTER (WHERE l_linestatus = 'F') AS f
  FROM lineitem GROUP BY l_partkey, year(l_shipdate)
),
wide AS (
  SELECT m.k, m.y,
    CASE WHEN m.k % 101 = 0 THEN '   '
         WHEN m.k % 7 = 0 THEN concat('  ', p.p_name, ' ', CAST(m.k AS VARCHAR), ' ')
         ELSE concat(p.p_name, ' ', CAST(m.k AS VARCHAR)) END AS entity,
    CASE WHEN m.k % 10 = 0 THEN NULL
         WHEN m.k % 10 = 1 THEN concat('OWID_', CAST(m.k AS VARCHAR))
         WHEN m.k % 10 = 2 THEN concat('X', CAST(m.k AS VARCHAR), 'longcode')
         WHEN m.k % 10 = 3 THEN concat(' C', lpad(CAST(m.k AS VARCHAR), 7, '0'), ' ')
         ELSE concat('C', lpad(CAST(m.k AS VARCHAR), 7, '0')) END AS code,
    CASE WHEN m.k % 211 = 0 THEN '1900' WHEN m.k % 223 = 0 THEN 'n/a'
         ELSE CAST(m.y AS VARCHAR) END AS year,
    CASE WHEN (m.k + m.y) % 11 = 0 THEN NULL
         WHEN (m.k + m.y) % 13 = 0 THEN 'abc'
         WHEN (m.k + m.y) % 37 = 0 THEN CAST(CAST(floor(100 * f / n) AS INT) + 200 AS VARCHAR)
         ELSE CAST(CAST(floor(100 * f / n) AS INT) AS VARCHAR) END AS ind_f,
    CAST(CAST(floor(100 * a / n) AS INT) AS VARCHAR) AS ind_a,
    CASE WHEN (m.k * 3 + m.y) % 17 = 0 THEN NULL
         ELSE CAST(CAST(floor(100 * b / n) AS INT) AS VARCHAR) END AS ind_b,
    CAST(CAST(floor(100 * c / n) AS INT) AS VARCHAR) AS ind_c
  FROM m JOIN part p ON p.p_partkey = m.k
),
prior_wide AS (
  SELECT k, y, entity, code, year,
    CASE WHEN (k * 7 + y) % 19 = 0 AND TRY_CAST(ind_f AS INT) IS NOT NULL
         THEN CAST((TRY_CAST(ind_f AS INT) + 50) % 101 AS VARCHAR) ELSE ind_f END AS ind_f,
    ind_a, ind_b, ind_c
  FROM wide WHERE k % 29 <> 0
)"""


def _standardised(source: str, target: str) -> str:
    return f"""
{target} AS (
  SELECT w.k, w.y, trim(w.entity) AS region_name,
    CASE WHEN trim(w.code) IN ('', 'nan', 'None') THEN NULL ELSE trim(w.code) END AS iso_code,
    TRY_CAST(w.year AS INT) AS year, i.indicator_code, i.place,
    TRY_CAST(CASE i.indicator_code WHEN 'F' THEN ind_f WHEN 'A' THEN ind_a WHEN 'B' THEN ind_b
             ELSE ind_c END AS DOUBLE) AS value,
    coalesce(CASE WHEN trim(w.code) IN ('', 'nan', 'None') THEN NULL ELSE trim(w.code) END,
             replace(lower(trim(w.entity)), ' ', '_')) AS region_key
  FROM {source} w CROSS JOIN (VALUES ('F', 1), ('A', 2), ('B', 3), ('C', 4)) i(indicator_code, place)
)"""


_TYPE = """CASE WHEN iso_code IS NULL THEN 'unknown' WHEN starts_with(iso_code, 'OWID_') THEN 'aggregate'
       WHEN length(iso_code) = 8 THEN 'country' ELSE 'other' END"""

_CHECKED = f"""
checked AS (
  SELECT *, {_TYPE} AS region_type,
    concat_ws('|', CASE WHEN year IS NULL OR year < 1980 OR year > 2027 THEN 'invalid_year' END,
                   CASE WHEN region_name = '' THEN 'missing_region' END,
                   CASE WHEN value < 0 OR value > 100 THEN 'value_out_of_range' END) AS reject_reason
  FROM long
)"""

_DESCRIBED = """
indicators(indicator_code, indicator_name, indicator_category, indicator_unit) AS (
  VALUES ('F', 'Finished lines', 'share', '%'), ('A', 'Lines flagged A', 'share', '%'),
         ('B', 'Lines flagged N', 'share', '%'), ('C', 'Lines flagged R', 'share', '%')
)"""

_REVISIONS = """
pairs AS (
  SELECT n.region_key, n.year, n.indicator_code, o.value AS old_value, n.value AS new_value
  FROM long n JOIN prior_long o
    ON n.region_key IS NOT DISTINCT FROM o.region_key AND n.year IS NOT DISTINCT FROM o.year
   AND n.indicator_code IS NOT DISTINCT FROM o.indicator_code
  WHERE n.value IS NOT NULL AND o.value IS NOT NULL
),
sides AS (
  SELECT region_key, year, indicator_code,
    count(*) FILTER (WHERE is_new) AS new_rows, count(*) FILTER (WHERE NOT is_new) AS old_rows
  FROM (SELECT region_key, year, indicator_code, TRUE AS is_new FROM long WHERE value IS NOT NULL
        UNION ALL SELECT region_key, year, indicator_code, FALSE FROM prior_long
        WHERE value IS NOT NULL)
  GROUP BY region_key, year, indicator_code
),
revised AS (
  SELECT p.region_key, p.year, p.indicator_code,
    CASE WHEN count(DISTINCT p.old_value) = 1 THEN min(p.old_value) END AS old_value,
    CASE WHEN count(DISTINCT p.new_value) = 1 THEN min(p.new_value) END AS new_value,
    max(s.old_rows) AS old_rows, max(s.new_rows) AS new_rows
  FROM pairs p JOIN sides s ON s.region_key IS NOT DISTINCT FROM p.region_key
    AND s.year IS NOT DISTINCT FROM p.year AND s.indicator_code = p.indicator_code
  GROUP BY p.region_key, p.year, p.indicator_code
  HAVING count(*) FILTER (WHERE p.old_value <> p.new_value) > 0
),
listed AS (
  SELECT v.region_key, v.year, v.indicator_code, v.value,
    count(*) FILTER (WHERE NOT v.is_new) AS old_rows, count(*) FILTER (WHERE v.is_new) AS new_rows
  FROM (SELECT region_key, year, indicator_code, value, TRUE AS is_new FROM long
        UNION ALL SELECT region_key, year, indicator_code, value, FALSE FROM prior_long) v
  JOIN revised r ON r.region_key IS NOT DISTINCT FROM v.region_key
    AND r.year IS NOT DISTINCT FROM v.year AND r.indicator_code = v.indicator_code
  WHERE v.value IS NOT NULL AND (r.old_value IS NULL OR r.new_value IS NULL)
  GROUP BY 1, 2, 3, 4
)"""

_STAGED = """
staged AS (
  SELECT c.region_key, c.region_name, c.iso_code, c.region_type, c.year, c.indicator_code,
    CAST(CAST(c.value AS DECIMAL(8,2)) AS DOUBLE) AS value, c.value IS NULL AS is_missing,
    r.indicator_code IS NOT NULL AS is_revised,
    c.value IS NULL OR r.indicator_code IS NOT NULL AS is_estimated, c.k, c.y, c.place
  FROM checked c LEFT JOIN revised r
    ON c.region_key = r.region_key AND c.year = r.year AND c.indicator_code = r.indicator_code
  WHERE c.reject_reason = ''
),
regions AS (
  SELECT region_key, region_name, iso_code, region_type FROM (
    SELECT *, row_number() OVER (PARTITION BY region_key ORDER BY place, k, y) AS nth FROM staged
  ) WHERE nth = 1
),
star AS (
  SELECT s.region_key, r.region_name, r.iso_code, r.region_type, s.year, s.indicator_code,
    s.value, s.is_missing, s.is_revised, s.is_estimated
  FROM staged s JOIN regions r ON s.region_key = r.region_key WHERE s.value IS NOT NULL
)"""

_REPORTS = """
latest AS (SELECT max(year) AS y FROM star WHERE indicator_code = 'F'),
trends AS (
  SELECT region_name, iso_code, CASE region_type WHEN 'country' THEN 'Country'
      WHEN 'aggregate' THEN 'Regional aggregate' ELSE 'Other' END AS region_type_label,
    year, value AS coverage_pct, is_estimated
  FROM star WHERE indicator_code = 'F'
),
comparison AS (
  SELECT region_key, region_name, iso_code, year, value AS coverage_pct,
    CASE WHEN value >= 80 THEN 'At or above WHO target' WHEN value >= 50 THEN 'Moderate coverage'
         ELSE 'Low coverage' END AS coverage_band
  FROM star WHERE indicator_code = 'F' AND region_type = 'country'
    AND year = (SELECT y FROM latest)
),
below AS (
  SELECT region_key, region_name, iso_code, year, coverage_pct,
    CAST(80 - coverage_pct AS DOUBLE) AS gap_to_target_pct
  FROM comparison WHERE coverage_pct < 80
)"""

_LONG = _standardised("wide", "long")
_PRIOR_LONG = _standardised("prior_wide", "prior_long")

# How much of the chain a statement needs.
_UP_TO_LONG = [_WIDE, _LONG]
_UP_TO_CHECKED = [*_UP_TO_LONG, _CHECKED]
_UP_TO_REVISED = [*_UP_TO_LONG, _PRIOR_LONG, _REVISIONS]
_UP_TO_STAR = [*_UP_TO_CHECKED, _PRIOR_LONG, _REVISIONS, _STAGED]
_UP_TO_REPORTS = [*_UP_TO_STAR, _REPORTS]


def _with(steps: list[str], select: str) -> str:
    return f"WITH {','.join(steps)}\n{select.strip()}"


_CHOSEN = "'C0000004', 'C0000005', 'C0000008', 'C0000009', 'C0000015'"

_TABLE_COUNTS = """
  SELECT 'stg_health_indicators' AS table_name, count(*) AS n FROM staged
  UNION ALL SELECT 'stg_regions', count(*) FROM regions
  UNION ALL SELECT 'stg_rejected_rows', count(*) FROM checked WHERE reject_reason <> ''
  UNION ALL SELECT 'stg_data_revisions', count(*) FROM revised
  UNION ALL SELECT 'stg_revision_values', count(*) FROM listed"""


def _check(check: str, table: str, column: str, failures: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name,"
        f" CAST(({failures}) AS BIGINT) AS failures"
    )


def _not_null(table: str, column: str, relation: str, expr: str) -> str:
    return _check("not_null", table, column, f"SELECT count(*) FROM {relation} WHERE {expr} IS NULL")


def _unique(table: str, column: str, relation: str, expr: str, kind: str = "unique") -> str:
    repeated = f"SELECT {expr} FROM {relation} GROUP BY {expr} HAVING count(*) > 1"
    return _check(kind, table, column, f"SELECT count(*) FROM ({repeated})")


def _orphans(table: str, column: str, relation: str, expr: str, parent: str, to: str) -> str:
    missing = f"{expr} IS NOT NULL AND {expr} NOT IN (SELECT {to} FROM {parent})"
    return _check("relationships", table, column, f"SELECT count(*) FROM {relation} WHERE {missing}")


def _outside(table: str, relation: str) -> str:
    return _check(
        "accepted_range", table, "value", f"SELECT count(*) FROM {relation} WHERE value < 0 OR value > 100"
    )


_FACT = "fact_health_indicator"
_DIMS = """
dates AS (SELECT DISTINCT year, year * 10000 + 101 AS date_id FROM staged),
kinds AS (SELECT DISTINCT indicator_code FROM staged),
facts AS (SELECT region_key, year * 10000 + 101 AS date_id, indicator_code, value FROM star)"""
_STANDARD = [
    _not_null("stg_health_indicators", "region_key", "staged", "region_key"),
    _not_null("stg_health_indicators", "year", "staged", "year"),
    _not_null("stg_health_indicators", "indicator_code", "staged", "indicator_code"),
    _unique(
        "stg_health_indicators",
        "region_key,year,indicator_code",
        "staged",
        "region_key, year, indicator_code",
        "unique_combination",
    ),
    _not_null("stg_regions", "region_key", "regions", "region_key"),
    _unique("stg_regions", "region_key", "regions", "region_key"),
    _not_null("dim_region", "region_key", "regions", "region_key"),
    _unique("dim_region", "region_key", "regions", "region_key"),
    _not_null("dim_date", "date_id", "dates", "date_id"),
    _unique("dim_date", "date_id", "dates", "date_id"),
    _not_null("dim_date", "year", "dates", "year"),
    _not_null("dim_indicator", "indicator_code", "kinds", "indicator_code"),
    _unique("dim_indicator", "indicator_code", "kinds", "indicator_code"),
    _not_null(_FACT, "region_id", "facts", "region_key"),
    _not_null(_FACT, "date_id", "facts", "date_id"),
    _not_null(_FACT, "indicator_id", "facts", "indicator_code"),
    _orphans(_FACT, "region_id", "facts", "region_key", "regions", "region_key"),
    _orphans(_FACT, "date_id", "facts", "date_id", "dates", "date_id"),
    _orphans(_FACT, "indicator_id", "facts", "indicator_code", "kinds", "indicator_code"),
    _unique(
        _FACT,
        "region_id,date_id,indicator_id",
        "facts",
        "region_key, date_id, indicator_code",
        "unique_combination",
    ),
    _outside(_FACT, "facts"),
]
_CHECKS = "\nUNION ALL ".join(
    [
        *_STANDARD,
        _orphans("orders", "o_custkey", "orders", "o_custkey", "customer", "c_custkey"),
        _orphans("lineitem", "l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        _outside("events", "events"),
    ]
)

_BOTH_LANDED = """
SELECT '2024-01-15' AS snapshot_date, k, y, entity AS region_name, code AS iso_code, year, ind_f,
  ind_a, ind_b, ind_c FROM wide
UNION ALL SELECT '2024-01-08', k, y, entity, code, year, ind_f, ind_a, ind_b, ind_c FROM prior_wide"""

_STAGE_ROWS = """
SELECT s.region_key, s.region_name, s.iso_code, s.region_type, s.year, s.indicator_code,
  i.indicator_name, i.indicator_category, i.indicator_unit, s.value, s.is_missing, s.is_revised,
  s.is_estimated FROM staged s JOIN indicators i USING (indicator_code)"""

_HISTORY = """
known AS (
  SELECT region_key, year, indicator_code, arg_max(value, k * 10000 + y) AS value, day FROM (
    SELECT *, DATE '2024-01-08' AS day FROM prior_long UNION ALL SELECT *, DATE '2024-01-15' FROM long
    UNION ALL SELECT *, DATE '2024-01-22' FROM prior_long
  ) WHERE region_key IS NOT NULL AND year IS NOT NULL AND value IS NOT NULL
  GROUP BY region_key, year, indicator_code, day
),
wide_days AS (
  SELECT region_key, year, indicator_code, max(value) FILTER (WHERE day = DATE '2024-01-08') AS a,
    max(value) FILTER (WHERE day = DATE '2024-01-15') AS b, max(value) FILTER (WHERE day = DATE '2024-01-22') AS c
  FROM known GROUP BY region_key, year, indicator_code
),
intervals AS (
  SELECT region_key, year, indicator_code, a AS value, DATE '2024-01-08' AS valid_from,
    CASE WHEN a IS NOT DISTINCT FROM b AND b IS NOT DISTINCT FROM c THEN NULL
         WHEN a IS NOT DISTINCT FROM b THEN DATE '2024-01-22' ELSE DATE '2024-01-15' END AS valid_to
  FROM wide_days WHERE a IS NOT NULL
  UNION ALL SELECT region_key, year, indicator_code, b, DATE '2024-01-15',
    CASE WHEN b IS NOT DISTINCT FROM c THEN NULL ELSE DATE '2024-01-22' END
  FROM wide_days WHERE b IS NOT NULL AND a IS DISTINCT FROM b
  UNION ALL SELECT region_key, year, indicator_code, c, DATE '2024-01-22', NULL
  FROM wide_days WHERE c IS NOT NULL AND b IS DISTINCT FROM c
)"""

_ALIASED = """
SELECT l.k, l.y, l.region_name,
  coalesce(l.iso_code, CASE WHEN p.p_partkey % 20 = 10
    THEN concat('C', lpad(CAST(p.p_partkey AS VARCHAR), 7, '0')) END) AS iso_code
FROM long l LEFT JOIN part p ON l.region_name = concat(p.p_name, ' ', CAST(p.p_partkey AS VARCHAR))
WHERE l.indicator_code = 'F'"""

_STATEMENTS: dict[str, str] = {
    # Sources and sinks
    "read_wide_roundtrip": _with(
        [_WIDE],
        """
SELECT CAST(k AS VARCHAR) AS k, CAST(y AS VARCHAR) AS y, entity AS region_name, code AS iso_code,
  nullif(year, 'n/a') AS year, ind_f, ind_a, ind_b, ind_c FROM wide""",
    ),
    "read_wide_malformed": _with(
        [_WIDE],
        """
SELECT CAST(k AS VARCHAR) AS k, CAST(y AS VARCHAR) AS y, entity AS region_name, code AS iso_code,
  nullif(year, 'n/a') AS year, ind_f, ind_a, ind_b, ind_c, NULL AS line FROM wide WHERE k % 50 <> 0
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  concat(k, ',', y, ',~', entity, ',x~,', code, ',', year, ',', ind_f, ',', ind_a, ',', ind_b, ',', ind_c)
FROM wide WHERE k % 50 = 0""",
    ),
    "land_snapshot_idempotent": _with([_WIDE], _BOTH_LANDED),
    "stream_ingest": _with([_WIDE], _BOTH_LANDED.replace("year, ind_f", "nullif(year, 'n/a') AS year, ind_f")),
    "land_second_file": _with(
        [_WIDE],
        """
SELECT k, y, entity AS region_name, code AS iso_code, nullif(year, 'n/a') AS year,
  ind_f, ind_a, ind_b, ind_c FROM prior_wide""",
    ),
    "land_corrected_file": _with(
        [*_UP_TO_STAR, _DESCRIBED],
        """
SELECT s.region_key, s.region_name, s.iso_code, s.region_type, s.year, s.indicator_code,
  i.indicator_name, i.indicator_category, i.indicator_unit, s.value, s.is_missing,
  FALSE AS is_revised, s.is_missing AS is_estimated FROM staged s JOIN indicators i USING (indicator_code)""",
    ),
    "expire_replaced_runs": _with(
        _UP_TO_STAR,
        """
SELECT 'stg_health_indicators' AS table_name, count(*) AS row_count, 1 AS run_folders FROM staged
UNION ALL SELECT 'stg_regions', count(*), 1 FROM regions
UNION ALL SELECT 'stg_rejected_rows', count(*), 1 FROM checked WHERE reject_reason <> ''
UNION ALL SELECT 'stg_data_revisions', 0, 1
UNION ALL SELECT 'stg_revision_values', 0, 1""",
    ),
    "refresh_late_file": _with([*_UP_TO_STAR, _DESCRIBED], _STAGE_ROWS),
    "stage_append": _with(
        _UP_TO_STAR,
        """
SELECT region_key, region_key AS region_id, CAST(year * 10000 + 101 AS INT) AS date_id,
  indicator_code AS indicator_id, value, is_missing, FALSE AS is_revised, FALSE AS is_estimated
FROM star""",
    ),
    "published_rejects": _with(
        _UP_TO_CHECKED,
        """
SELECT k * 10000 + y AS source_row, region_name, iso_code, year, indicator_code, value,
  reject_reason, CAST(NULL AS VARCHAR) AS raw_line FROM checked WHERE reject_reason <> ''""",
    ),
    "published_revisions": _with(
        _UP_TO_REVISED, "SELECT *, '2024-01-08' AS prior_snapshot FROM revised"
    ),
    "published_revision_values": _with(_UP_TO_REVISED, "SELECT * FROM listed"),
    "catalog_trends": _with(
        _UP_TO_REPORTS,
        """
SELECT * RENAME (coverage_pct AS dtp3_coverage_pct) FROM trends
ORDER BY region_name NULLS LAST, year NULLS LAST""",
    ),
    "catalog_comparison": _with(
        _UP_TO_REPORTS,
        """
SELECT region_name, iso_code, year, coverage_pct AS dtp3_coverage_pct, coverage_band
FROM comparison ORDER BY coverage_pct DESC, region_key""",
    ),
    "catalog_below_threshold": _with(
        _UP_TO_REPORTS,
        """
SELECT region_name, iso_code, year, coverage_pct AS dtp3_coverage_pct, gap_to_target_pct
FROM below ORDER BY coverage_pct, region_key""",
    ),
    "source_row_counts": """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS snapshot_date, event_type AS file,
  count(*) AS row_count FROM events GROUP BY 1, 2""",
    "pending_snapshots": """
SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS snapshot_date, event_type AS file
FROM events e WHERE NOT EXISTS (
  SELECT 1 FROM events l WHERE day(l.ts) <= 15 AND l.event_type = e.event_type
    AND CAST(l.ts AS DATE) = CAST(e.ts AS DATE))""",
    "prior_snapshot": """
SELECT CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS prior_snapshot FROM events
WHERE CAST(ts AS DATE) < DATE '2024-01-15'""",
    "stage_indicators": _with([*_UP_TO_STAR, _DESCRIBED], _STAGE_ROWS),
    "load_audit": _with(
        _UP_TO_STAR,
        f"""
SELECT table_name, 'row_count' AS check_name, 'passed' AS check_result,
  concat('{{"rows_loaded":', n, '}}') AS details FROM ({_TABLE_COUNTS})
UNION ALL SELECT 'pipeline', 'pipeline_run', 'passed',
  concat('{{"tables_loaded":', count(*), ',"total_rows":', CAST(sum(n) AS BIGINT), '}}')
  FROM ({_TABLE_COUNTS})""",
    ),
    "view_row_counts": _with(
        _UP_TO_REPORTS,
        """
SELECT view_name, row_count, CASE WHEN row_count > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM (
  SELECT 'trends' AS view_name, count(*) AS row_count FROM trends
  UNION ALL SELECT 'comparison', count(*) FROM comparison
  UNION ALL SELECT 'below_threshold', count(*) FROM below)""",
    ),
    # Projections, filters and scalar functions
    "unpivot_indicators": _with(
        [_WIDE],
        """
SELECT k, y, 'ind_f' AS indicator_source_col, ind_f AS value FROM wide
UNION ALL SELECT k, y, 'ind_a', ind_a FROM wide
UNION ALL SELECT k, y, 'ind_b', ind_b FROM wide
UNION ALL SELECT k, y, 'ind_c', ind_c FROM wide""",
    ),
    "coerce_numeric": _with(
        [_WIDE],
        """
SELECT k, y, TRY_CAST(year AS INT) AS year, TRY_CAST(ind_f AS DOUBLE) AS ind_f,
  TRY_CAST(ind_a AS DOUBLE) AS ind_a, TRY_CAST(ind_b AS DOUBLE) AS ind_b,
  TRY_CAST(ind_c AS DOUBLE) AS ind_c FROM wide""",
    ),
    "indicator_metadata": _with(
        [_WIDE, _DESCRIBED],
        """
SELECT w.k, w.y, i.*, CASE i.indicator_code WHEN 'F' THEN ind_f WHEN 'A' THEN ind_a
  WHEN 'B' THEN ind_b ELSE ind_c END AS value FROM wide w CROSS JOIN indicators i""",
    ),
    "standardise_regions": _with(
        _UP_TO_LONG,
        f"""
SELECT k, y, region_key, region_name, iso_code, {_TYPE} AS region_type FROM long
WHERE indicator_code = 'F'""",
    ),
    "alias_fill": _with(_UP_TO_LONG, _ALIASED),
    "alias_file": _with(_UP_TO_LONG, _ALIASED),
    "region_type_counts": _with(
        _UP_TO_LONG,
        f"""
SELECT {_TYPE} AS region_type, count(*) AS wide_rows FROM long WHERE indicator_code = 'F'
GROUP BY 1""",
    ),
    "region_key_slug": _with(
        [_WIDE], "SELECT k, y, replace(lower(trim(entity)), ' ', '_') AS region_key FROM wide"
    ),
    "validate_rejects": _with(
        _UP_TO_CHECKED,
        """
SELECT k, y, region_name, iso_code, year, indicator_code, value, reject_reason
FROM checked WHERE reject_reason <> ''""",
    ),
    "validate_clean": _with(
        _UP_TO_CHECKED,
        """
SELECT k, y, region_key, year, indicator_code, value FROM checked WHERE reject_reason = ''""",
    ),
    "quality_flags": _with(
        _UP_TO_STAR,
        "SELECT k, y, indicator_code, is_missing, is_revised, is_estimated FROM staged",
    ),
    "coerce_bool": """
SELECT event_id, TRY_CAST(CASE event_id % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False'
  ELSE 'weird' END AS BOOLEAN) AS flag FROM events""",
    # Revisions
    "detect_revisions": _with(
        _UP_TO_REVISED, "SELECT *, '2024-01-08' AS prior_snapshot FROM revised"
    ),
    "revision_values": _with(_UP_TO_REVISED, "SELECT * FROM listed"),
    "order_revisions": """
SELECT o_orderkey, o_totalprice + 1 AS old_value, o_totalprice AS new_value,
  CAST(1 AS BIGINT) AS old_rows, CAST(1 AS BIGINT) AS new_rows
FROM orders WHERE o_orderkey % 19 = 0 AND o_orderdate < TIMESTAMP '2001-01-01'""",
    # Dimensions and fact
    "regions_first_seen": _with(_UP_TO_STAR, "SELECT * FROM regions"),
    "dim_region": _with(
        _UP_TO_STAR,
        """
SELECT *, CASE region_type WHEN 'country' THEN 'Country'
  WHEN 'aggregate' THEN 'Regional aggregate' ELSE 'Other' END AS region_type_label FROM regions""",
    ),
    "dim_date": _with(
        _UP_TO_CHECKED,
        """
SELECT DISTINCT CAST(year * 10000 + 101 AS INT) AS date_id, concat(year, '-01-01') AS date_day,
  1 AS day, 1 AS month, year, 1 AS quarter, 'Yearly' AS reporting_frequency
FROM checked WHERE reject_reason = ''""",
    ),
    "dim_indicator": _with(
        [*_UP_TO_CHECKED, _DESCRIBED],
        """
SELECT i.* FROM indicators i
WHERE i.indicator_code IN (SELECT indicator_code FROM checked WHERE reject_reason = '')""",
    ),
    "fact_indicator": _with(
        _UP_TO_STAR,
        """
SELECT region_key, region_key AS region_id, CAST(year * 10000 + 101 AS INT) AS date_id,
  indicator_code AS indicator_id, value, is_missing, is_revised, is_estimated FROM star""",
    ),
    "star_lookup": _with(
        [*_UP_TO_REPORTS, _DESCRIBED],
        """
SELECT s.region_key AS region_id, s.region_name, CASE s.region_type WHEN 'country' THEN 'Country'
    WHEN 'aggregate' THEN 'Regional aggregate' ELSE 'Other' END AS region_type_label,
  s.year, i.indicator_name, s.value FROM star s JOIN indicators i USING (indicator_code)""",
    ),
    # Reports
    "vaccination_trends": _with(
        _UP_TO_REPORTS, "SELECT * FROM trends ORDER BY region_name NULLS LAST, year NULLS LAST"
    ),
    "regional_comparison": _with(
        _UP_TO_REPORTS, "SELECT * FROM comparison ORDER BY coverage_pct DESC, region_key"
    ),
    "below_threshold": _with(
        _UP_TO_REPORTS, "SELECT * FROM below ORDER BY coverage_pct, region_key"
    ),
    "comparison_other_indicator": _with(
        _UP_TO_STAR,
        """
SELECT region_key, region_name, iso_code, year, value AS coverage_pct,
  CASE WHEN value >= 80 THEN 'At or above WHO target' WHEN value >= 50 THEN 'Moderate coverage'
       ELSE 'Low coverage' END AS coverage_band
FROM star WHERE indicator_code = 'A' AND region_type = 'country'
  AND year = (SELECT max(year) FROM star WHERE indicator_code = 'A')""",
    ),
    "comparison_low_band": _with(
        _UP_TO_REPORTS, "SELECT * FROM comparison WHERE coverage_band = 'Low coverage'"
    ),
    "trends_selected": _with(
        _UP_TO_REPORTS,
        f"""
SELECT * FROM trends
WHERE region_name IN (SELECT region_name FROM regions WHERE region_key IN ({_CHOSEN}))""",
    ),
    "recent_for_region": _with(
        [*_UP_TO_REPORTS, _DESCRIBED],
        """
SELECT t.region_name, t.year, 'Finished lines' AS indicator_name, t.coverage_pct AS value
FROM trends t WHERE t.region_name = (SELECT region_name FROM regions WHERE region_key = 'C0000004')
ORDER BY t.year DESC LIMIT 10""",
    ),
    "series_by_region": _with(
        _UP_TO_REPORTS,
        "SELECT region_name, year, coverage_pct FROM trends ORDER BY region_name, year",
    ),
    "region_list": _with(
        _UP_TO_REPORTS, "SELECT DISTINCT region_name FROM trends ORDER BY region_name"
    ),
    "value_history": _with([*_UP_TO_STAR, _HISTORY], """
SELECT region_key, year, indicator_code, value, CAST(valid_from AS VARCHAR) AS valid_from,
  CAST(valid_to AS VARCHAR) AS valid_to FROM intervals"""),
    "value_as_of": _with([*_UP_TO_STAR, _HISTORY], """
SELECT region_key, year, indicator_code, value FROM known WHERE day = DATE '2024-01-15'"""),
    "region_names_locale": _with(
        _UP_TO_STAR,
        """
SELECT region_type_label, first(x ORDER BY x COLLATE en) AS first_name, last(x ORDER BY x COLLATE en) AS last_name
FROM (
  SELECT region_type_label, CASE WHEN length(region_name) % 3 = 0
    THEN array_to_string(list_transform(string_split(lower(a), ' '), lambda w: upper(w[1]) || w[2:]), ' ')
    ELSE a END AS x
  FROM (
    SELECT CASE region_type WHEN 'country' THEN 'Country' WHEN 'aggregate' THEN 'Regional aggregate' ELSE 'Other' END
        AS region_type_label, region_name,
      CASE WHEN length(region_name) % 2 = 0 THEN translate(region_name, 'aeou', 'áéöü') ELSE region_name END AS a
    FROM regions
  )
) GROUP BY region_type_label""",
    ),
    "top_regions": _with(
        _UP_TO_REPORTS,
        """
SELECT region_key, region_name, coverage_pct,
  CASE WHEN coverage_pct < 80 THEN 'below' ELSE 'at_or_above' END AS target_marker
FROM comparison ORDER BY coverage_pct DESC, region_key LIMIT 30""",
    ),
    "bottom_regions": _with(
        _UP_TO_REPORTS, "SELECT * FROM below ORDER BY coverage_pct, region_key LIMIT 30"
    ),
    "latest_year": _with(_UP_TO_REPORTS, "SELECT y AS latest_year FROM latest"),
    "count_below_threshold": _with(
        _UP_TO_REPORTS,
        """
SELECT (SELECT y FROM latest) AS latest_year, (SELECT count(*) FROM below) AS countries_below""",
    ),
    "headline_metrics": _with(
        _UP_TO_REPORTS,
        """
SELECT (SELECT count(*) FROM comparison) AS countries_tracked,
  (SELECT count(*) FROM below) AS countries_below, (SELECT max(year) FROM trends) AS latest_year""",
    ),
    # Quality
    "quality_stats": _with(
        _UP_TO_REPORTS,
        """
SELECT (SELECT count(*) FROM staged) AS indicator_rows,
  (SELECT count(*) FROM staged WHERE value IS NULL) AS null_values,
  (SELECT count(*) FROM regions) AS region_count,
  (SELECT count(*) FROM regions WHERE region_type = 'country') AS country_count,
  (SELECT count(*) FROM checked WHERE reject_reason <> '') AS rejected_rows,
  (SELECT count(*) FROM pairs WHERE old_value <> new_value) AS revisions_detected,
  (SELECT y FROM latest) AS latest_main_year,
  (SELECT count(*) FROM below) AS countries_below_target""",
    ),
    "reject_summary": _with(
        _UP_TO_CHECKED,
        """
SELECT reason, count(*) AS rejected_rows FROM (
  SELECT unnest(string_split(reject_reason, '|')) AS reason FROM checked WHERE reject_reason <> '')
GROUP BY reason""",
    ),
    "dq_checks": _with([*_UP_TO_STAR, _DIMS], _CHECKS),
    "dq_checks_added": _with([*_UP_TO_STAR, _DIMS], "\nUNION ALL ".join(_STANDARD)),
    "dq_duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
}


def statements() -> dict[str, str]:
    return dict(_STATEMENTS)
