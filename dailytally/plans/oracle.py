"""Plain-SQL twins of the registered queries, for DuckDB over the driver's
views (``orders``, ``customer``, ``nation``, ``events``).

Each statement recomputes its answer the direct way (GROUP BY, IN-subquery,
window ``row_number``), independent of the Spark plan, so a match checks
the Spark operators, not a transcription of them.
"""

from __future__ import annotations

# Scenario parameters, as SQL literals (see dailytally.plans.scenarios).
MARK = "TIMESTAMP '2024-04-01 00:00:00'"
SPLIT = "TIMESTAMP '2024-02-15 00:00:00'"
EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"
RUN_TS = "TIMESTAMP '2024-04-07 12:00:00'"
BF_LO = "TIMESTAMP '2024-01-10 00:00:00'"
BF_HI = "TIMESTAMP '2024-01-18 00:00:00'"  # end day + 1, exclusive

RORDERS = """rorders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         concat('rest_', lpad(CAST(o_custkey % 5 AS VARCHAR), 4, '0')) AS restaurant_id,
         CAST(o_custkey AS VARCHAR) AS user_id,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'cancelled' ELSE 'placed' END AS status,
         CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
         CASE n_nationkey % 6 WHEN 0 THEN 'IN' WHEN 1 THEN 'US' WHEN 2 THEN 'UK'
                              WHEN 3 THEN 'AE' WHEN 4 THEN 'SG' ELSE 'AU' END AS country,
         created_at,
         CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 7 = 0
              THEN created_at + to_days(CAST(1 + o_orderkey % 5 AS INT)) + to_hours(CAST(o_orderkey % 24 AS INT))
              ELSE created_at END AS updated_at
  FROM (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, n_nationkey,
           TIMESTAMP '2024-01-01 00:00:00'
             + to_days(CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 91 AS INT))
             + to_seconds((o_orderkey * 7919) % 86400)
             + to_microseconds(o_orderkey % 1000) AS created_at
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  ) AS base
)"""

V1 = f"""v1 AS (
  SELECT order_id, restaurant_id, user_id,
         CASE WHEN updated_at > {SPLIT} THEN 'placed' ELSE status END AS status,
         amount, country, created_at,
         CASE WHEN updated_at > {SPLIT} THEN created_at ELSE updated_at END AS updated_at
  FROM rorders WHERE created_at <= {SPLIT}
)"""

COLS = "order_id, restaurant_id, user_id, status, amount, country, created_at, updated_at"
KEYS = "restaurant_id, date, country"


def metrics_of(rel: str, where: str = "") -> str:
    """Daily metrics of a relation (plain GROUP BY with FILTER)."""
    w = f"WHERE {where}" if where else ""
    return f"""SELECT restaurant_id, CAST(created_at AS DATE) AS date, country,
         count(*) AS total_orders,
         count(*) FILTER (WHERE status = 'completed') AS completed_orders,
         count(*) FILTER (WHERE status = 'cancelled') AS cancelled_orders,
         CAST(COALESCE(sum(amount) FILTER (WHERE status = 'completed'), 0) AS DECIMAL(22,2)) AS gross_revenue
  FROM {rel} {w}
  GROUP BY restaurant_id, CAST(created_at AS DATE), country"""


def keys_of(rel: str, where: str = "") -> str:
    w = f"WHERE {where}" if where else ""
    return f"SELECT DISTINCT restaurant_id, CAST(created_at AS DATE) AS date, country FROM {rel} {w}"


def recompute_sql(rel: str, keys_rel: str) -> str:
    """Metrics of ``rel`` restricted to the groups of ``keys_rel`` (IN form)."""
    return metrics_of(
        rel,
        f"(restaurant_id, CAST(created_at AS DATE), country) IN (SELECT restaurant_id, date, country FROM {keys_rel})",
    )


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = with_(RORDERS)
TWO = with_(
    RORDERS,
    V1,
    f"m1 AS ({metrics_of('v1')})",
    f"changed AS (SELECT * FROM rorders WHERE updated_at > (SELECT max(updated_at) FROM v1))",
    f"k2 AS ({keys_of('changed')})",
    f"new AS ({recompute_sql('rorders', 'k2')})",
    f"merged AS (SELECT * FROM m1 WHERE ({KEYS}) NOT IN (SELECT {KEYS} FROM new) UNION ALL SELECT * FROM new)",
)

UPSERT_COUNTS = """SELECT count(*) FILTER (WHERE t.restaurant_id IS NULL) AS inserted,
       count(*) FILTER (WHERE t.restaurant_id IS NOT NULL AND NOT ({same})) AS modified,
       count(*) FILTER (WHERE t.restaurant_id IS NOT NULL AND ({same})) AS unchanged,
       count(*) FILTER (WHERE t.restaurant_id IS NULL OR NOT ({same})) AS upserted
FROM new n LEFT JOIN m1 t USING (restaurant_id, date, country)""".format(
    same=" AND ".join(
        f"n.{c} IS NOT DISTINCT FROM t.{c}"
        for c in ("total_orders", "completed_orders", "cancelled_orders", "gross_revenue")
    )
)

DEFECTS = f"""d AS (
  SELECT order_id, restaurant_id, CASE WHEN CAST(order_id AS BIGINT) % 130 <> 0 THEN user_id END AS user_id,
         CASE WHEN CAST(order_id AS BIGINT) % 110 = 0 THEN 'refunded' ELSE status END AS status,
         CASE WHEN CAST(order_id AS BIGINT) % 50 = 0 THEN -amount ELSE amount END AS amount,
         CASE WHEN CAST(order_id AS BIGINT) % 70 = 0 THEN substring(country, 1, 1) ELSE country END AS country,
         created_at, updated_at
  FROM rorders
), dr AS (
  SELECT *, CASE
      WHEN order_id IS NULL OR restaurant_id IS NULL OR user_id IS NULL OR status IS NULL OR amount IS NULL
           OR country IS NULL OR created_at IS NULL OR updated_at IS NULL THEN 'missing_field'
      WHEN status NOT IN ('placed', 'completed', 'cancelled') THEN 'bad_status'
      WHEN amount < 0 THEN 'negative_amount'
      WHEN length(country) <> 2 THEN 'bad_country'
    END AS reject_reason
  FROM d
)"""

STATE_V1 = f"""pk AS (SELECT 'daily_metrics_' || lower(country) AS pipeline_id, restaurant_id,
                   CAST(created_at AS DATE) AS date, country, updated_at FROM v1),
state AS (
  SELECT pipeline_id, max(updated_at) AS last_watermark, {RUN_TS} AS last_run_at,
         count(*) AS rows_processed, count(DISTINCT (restaurant_id, date, country)) AS groups_affected
  FROM pk GROUP BY pipeline_id
)"""


LATE = "created_at <= {s} AND updated_at > {s}".format(s=SPLIT)

LATE_DEFECTS = f"""v2b AS (
  SELECT order_id, restaurant_id, user_id, status,
         CAST(CASE WHEN {LATE} AND CAST(order_id AS BIGINT) % 2 = 0 THEN -amount ELSE amount END AS DECIMAL(12,2)) AS amount,
         country, created_at, updated_at
  FROM rorders
)"""

# Orders as JSON lines, some of them broken; what can be read of a broken line is kept.
_K = "CAST(order_id AS BIGINT)"
RAW = f"""j AS (
  SELECT *, concat('{{"order_id":"', order_id, '","restaurant_id":"', restaurant_id, '",',
         CASE WHEN {_K} % 77 <> 0 THEN concat('"user_id":"', user_id, '",') ELSE '' END,
         '"status":"', status, '","amount":', CASE WHEN {_K} % 90 = 0 THEN '"n/a"' ELSE CAST(amount AS VARCHAR) END,
         ',"country":"', country, '","created_at":"', strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f'), '","updated_at":"',
         CASE WHEN {_K} % 101 = 0 THEN 'soon' ELSE strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%f') END, '"}}') AS line
  FROM rorders
), raw AS (
  SELECT order_id, restaurant_id, CASE WHEN {_K} % 77 <> 0 THEN user_id END AS user_id, status,
         CASE WHEN {_K} % 90 <> 0 THEN amount END AS amount, country, created_at,
         CASE WHEN {_K} % 101 <> 0 THEN updated_at END AS updated_at,
         CASE WHEN {_K} % 90 = 0 OR {_K} % 101 = 0 THEN line END AS raw_line
  FROM j WHERE {_K} % 60 <> 0
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, line[1:50] FROM j WHERE {_K} % 60 = 0
)"""

METRIC_DEFECTS = f"""good AS ({metrics_of('rorders')}),
m AS (
  SELECT restaurant_id, date, CASE WHEN day(date) = 19 THEN substring(country, 1, 1) ELSE country END AS country,
         CASE WHEN day(date) = 13 THEN -total_orders ELSE total_orders END AS total_orders,
         CASE WHEN day(date) = 23 THEN total_orders + 1 ELSE completed_orders END AS completed_orders, cancelled_orders,
         CAST(CASE WHEN day(date) = 17 THEN -gross_revenue - 1 ELSE gross_revenue END AS DECIMAL(22,2)) AS gross_revenue
  FROM good
)"""

# All groups of the days that the changes after v1 touch.
TOUCHED_DAYS = with_(
    RORDERS,
    V1,
    "days AS (SELECT DISTINCT CAST(created_at AS DATE) AS d FROM rorders WHERE updated_at > (SELECT max(updated_at) FROM v1))",
) + metrics_of("rorders", "CAST(created_at AS DATE) IN (SELECT d FROM days)")


def _late_before_after(extra: str) -> str:
    cond = LATE + (f" AND {extra}" if extra else "")
    return with_(
        RORDERS,
        V1,
        f"lk AS ({keys_of('rorders', cond)})",
        f"b AS ({recompute_sql('v1', 'lk')})",
        f"a AS ({recompute_sql('rorders', 'lk')})",
    ) + f"""SELECT b.restaurant_id, b.date, b.country,
       b.total_orders AS before_total_orders, b.completed_orders AS before_completed_orders,
       b.cancelled_orders AS before_cancelled_orders, b.gross_revenue AS before_gross_revenue,
       a.total_orders AS after_total_orders, a.completed_orders AS after_completed_orders,
       a.cancelled_orders AS after_cancelled_orders, a.gross_revenue AS after_gross_revenue
FROM b JOIN a USING (restaurant_id, date, country)"""


ORACLE: dict[str, str] = {
    "scan_orders": BASE + f"SELECT {COLS} FROM rorders",
    "extract_incremental": BASE + f"SELECT {COLS} FROM rorders WHERE updated_at > {MARK}",
    "extract_incremental_batch": BASE
    + f"SELECT {COLS} FROM rorders WHERE updated_at > {SPLIT} ORDER BY updated_at, order_id LIMIT 100",
    "extract_batch_tie_safe": with_(
        RORDERS,
        "r AS (SELECT *, CAST(CAST(updated_at AS DATE) AS TIMESTAMP) AS change_day FROM rorders)",
        f"page AS (SELECT change_day FROM r WHERE change_day > {EPOCH} ORDER BY change_day, order_id LIMIT 100)",
    )
    + f"SELECT {COLS} FROM r WHERE change_day > {EPOCH} AND change_day <= (SELECT max(change_day) FROM page)",
    "extract_backfill": BASE + f"SELECT {COLS} FROM rorders WHERE created_at >= {BF_LO} AND created_at < {BF_HI}",
    "extract_full": BASE + f"SELECT {COLS} FROM rorders WHERE updated_at > {EPOCH}",
    "extract_after_hwm": with_(RORDERS, V1)
    + f"SELECT {COLS} FROM rorders WHERE updated_at > (SELECT max(updated_at) FROM v1)",
    "batch_stats": BASE
    + f"SELECT max(updated_at) AS max_updated_at, count(*) AS row_count FROM rorders WHERE updated_at > {MARK}",
    "batch_ledger": with_(
        RORDERS,
        f"r AS (SELECT *, row_number() OVER (ORDER BY updated_at, order_id) - 1 AS seq FROM rorders WHERE updated_at > {EPOCH})",
        """pk AS (SELECT CAST(seq // 100 AS BIGINT) AS batch_no, restaurant_id, CAST(created_at AS DATE) AS date,
                    country, count(*) AS n, max(updated_at) AS mx
             FROM r GROUP BY 1, 2, 3, 4)""",
    )
    + """SELECT batch_no, CAST(sum(n) AS BIGINT) AS batch_rows, max(mx) AS max_updated_at, count(*) AS batch_groups
FROM pk GROUP BY batch_no""",
    "order_group_keys": BASE
    + "SELECT order_id, restaurant_id, CAST(created_at AS DATE) AS date, country FROM rorders",
    "normalize_orders": BASE
    + """SELECT order_id, restaurant_id, user_id, status, amount,
       upper(CASE WHEN CAST(order_id AS BIGINT) % 11 = 0 THEN lower(country) ELSE country END) AS country,
       created_at, updated_at FROM rorders""",
    "orders_valid": with_(RORDERS, DEFECTS) + f"SELECT {COLS} FROM dr WHERE reject_reason IS NULL",
    "orders_rejects": with_(RORDERS, DEFECTS) + f"SELECT {COLS}, reject_reason FROM dr WHERE reject_reason IS NOT NULL",
    "affected_groups": BASE + keys_of("rorders", f"updated_at > {MARK}"),
    "recompute_affected": with_(RORDERS, f"k AS ({keys_of('rorders', f'updated_at > {MARK}')})")
    + recompute_sql("rorders", "k"),
    "recompute_affected_wide": with_(RORDERS, f"k AS ({keys_of('rorders', f'updated_at > {MARK}')})")
    + recompute_sql("rorders", "k"),
    "recompute_backfill": BASE + metrics_of("rorders", f"created_at >= {BF_LO} AND created_at < {BF_HI}"),
    "recompute_given_groups": with_(
        RORDERS,
        """k AS (SELECT unnest(['rest_0000', 'rest_0001', 'rest_0002', 'rest_0003', 'rest_0004', 'rest_0009']) AS restaurant_id,
                  CAST(unnest(['2024-01-15', '2024-02-01', '2024-02-29', '2024-03-10', '2024-03-31', '2024-01-15']) AS DATE) AS date,
                  unnest(['IN', 'US', 'UK', 'AE', 'SG', 'AU']) AS country)""",
    )
    + recompute_sql("rorders", "k"),
    "daily_metrics_full": BASE + metrics_of("rorders"),
    "metrics_contract": with_(RORDERS, METRIC_DEFECTS)
    + r"""SELECT count(*) AS metric_rows,
       count(*) FILTER (WHERE total_orders < 0 OR completed_orders < 0 OR cancelled_orders < 0) AS negative_counts,
       count(*) FILTER (WHERE gross_revenue < 0) AS negative_revenue,
       count(*) FILTER (WHERE NOT regexp_full_match(strftime(date, '%Y-%m-%d'), '\d{4}-\d{2}-\d{2}')) AS bad_dates,
       count(*) FILTER (WHERE length(country) <> 2) AS bad_countries
FROM m""",
    "metrics_consistency": with_(RORDERS, METRIC_DEFECTS)
    + "SELECT *, total_orders >= completed_orders + cancelled_orders AS is_consistent FROM m",
    "metrics_documents": with_(RORDERS, f"m AS ({metrics_of('rorders')})")
    + f"""SELECT restaurant_id, strftime(date, '%Y-%m-%d') AS date, country, total_orders, completed_orders,
       cancelled_orders, CAST(gross_revenue AS DOUBLE) AS gross_revenue, {RUN_TS} AS last_updated_at FROM m""",
    "metrics_key_uniqueness": TWO
    + """SELECT CAST(sum(n) AS BIGINT) AS metric_rows, count(*) AS distinct_keys,
       count(*) FILTER (WHERE n > 1) AS duplicated_keys
FROM (SELECT restaurant_id, date, country, sum(CASE WHEN day(date) = 7 THEN 2 ELSE 1 END) AS n
      FROM merged GROUP BY restaurant_id, date, country) AS per_key""",
    "metric_lookup": with_(RORDERS, f"m AS ({metrics_of('rorders')})")
    + "SELECT * FROM m WHERE restaurant_id = 'rest_0001' AND date = DATE '2024-01-15' AND country = 'IN'",
    "extract_ordered": BASE
    + f"SELECT {COLS}, row_number() OVER (ORDER BY updated_at, order_id) - 1 AS change_seq FROM rorders WHERE updated_at > {SPLIT}",
    "job_crash_replay": BASE + metrics_of("rorders"),
    "stream_stateful": BASE + metrics_of("rorders", f"NOT (CAST(order_id AS BIGINT) % 17 = 0 AND updated_at > {SPLIT})"),
    "stream_compacted": BASE + metrics_of("rorders", f"NOT (CAST(order_id AS BIGINT) % 17 = 0 AND updated_at > {SPLIT})"),
    "snapshot_diff": with_(RORDERS, V1, f"""v2 AS (SELECT {COLS} FROM rorders WHERE CAST(order_id AS BIGINT) % 97 <> 0)""")
    + f"""SELECT CASE WHEN order_id IN (SELECT order_id FROM v1) THEN 'changed' ELSE 'inserted' END AS change, {COLS}
          FROM (SELECT {COLS} FROM v2 EXCEPT SELECT {COLS} FROM v1)
          UNION ALL SELECT 'deleted' AS change, {COLS} FROM v1 WHERE order_id NOT IN (SELECT order_id FROM v2)""",
    "profile_from_sketches": BASE
    + """SELECT count(*) AS total_orders, count(DISTINCT restaurant_id) AS restaurants, min(created_at) AS min_created_at, max(created_at) AS max_created_at
         FROM rorders WHERE created_at >= DATE '2024-01-10' AND created_at < DATE '2024-01-18'
         UNION ALL SELECT count(*), count(DISTINCT restaurant_id), min(created_at), max(created_at) FROM rorders""",
    "orders_profile": BASE
    + """SELECT count(*) AS total_orders, count(DISTINCT restaurant_id) AS restaurants,
       min(created_at) AS min_created_at, max(created_at) AS max_created_at FROM rorders""",
    "upsert_metrics": TWO + "SELECT * FROM merged",
    "upsert_counts": TWO + UPSERT_COUNTS,
    "insert_if_absent": with_(RORDERS, V1)
    + f"""SELECT {COLS} FROM v1
UNION ALL
SELECT {COLS} FROM rorders WHERE order_id NOT IN (SELECT order_id FROM v1)""",
    "apply_changes": with_(
        RORDERS,
        V1,
        f"""u AS (SELECT {COLS}, 0 AS src FROM v1
             UNION ALL SELECT {COLS}, 1 AS src FROM rorders WHERE updated_at > {SPLIT})""",
    )
    + f"""SELECT {COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, src DESC) AS rn FROM u
) AS ranked WHERE rn = 1""",
    # After run 2 the table equals a plain GROUP BY of the current source.
    "incremental_two_runs": BASE + metrics_of("rorders"),
    # The job, run twice and written to tables, equals the GROUP BY as well.
    "job_two_runs": with_(RORDERS, f"m AS ({metrics_of('rorders')})") + f"SELECT *, {RUN_TS} AS last_updated_at FROM m",
    "job_two_runs_paged": BASE + metrics_of("rorders"),
    "job_full": BASE + metrics_of("rorders"),
    "job_backfill": with_(
        RORDERS,
        V1,
        f"m1 AS ({metrics_of('v1')})",
        f"bf AS ({metrics_of('rorders', f'created_at >= {BF_LO} AND created_at < {BF_HI}')})",
    )
    + f"SELECT * FROM m1 WHERE date < {BF_LO} OR date >= {BF_HI} UNION ALL SELECT * FROM bf",
    "quarantine_two_runs": with_(RORDERS, LATE_DEFECTS) + metrics_of("v2b", "amount >= 0"),
    "quarantine_rejects": with_(RORDERS, LATE_DEFECTS)
    + f"SELECT {COLS}, 'negative_amount' AS reject_reason FROM v2b WHERE amount < 0",
    "raw_metrics": BASE + metrics_of("rorders", f"{_K} % 60 <> 0 AND {_K} % 90 <> 0 AND {_K} % 77 <> 0 AND {_K} % 101 <> 0"),
    "raw_rejects": with_(RORDERS, RAW)
    + f"""SELECT {COLS}, raw_line, CASE WHEN raw_line IS NOT NULL THEN 'unparsed' ELSE 'missing_field' END AS reject_reason
FROM raw WHERE raw_line IS NOT NULL OR user_id IS NULL""",
    "dry_run_paged_preview": TOUCHED_DAYS,
    "late_update_corrects_day": _late_before_after(""),
    "late_cancellation": _late_before_after("status = 'cancelled'"),
    "backfill_then_upsert": with_(
        RORDERS,
        V1,
        f"m1 AS ({metrics_of('v1')})",
        f"bf AS ({metrics_of('rorders', f'created_at >= {BF_LO} AND created_at < {BF_HI}')})",
    )
    + f"SELECT * FROM m1 WHERE ({KEYS}) NOT IN (SELECT {KEYS} FROM bf) UNION ALL SELECT * FROM bf",
    # Applying run 2 twice equals the plain GROUP BY as well.
    "rerun_identity": BASE + metrics_of("rorders"),
    "dry_run_preview": TOUCHED_DAYS,
    "run_summary": TWO
    + f"""SELECT 'incremental' AS mode, false AS dry_run, CAST(1 AS BIGINT) AS batches,
       (SELECT count(*) FROM changed) AS total_rows,
       (SELECT count(*) FROM k2) AS total_groups,
       (SELECT upserted FROM ({UPSERT_COUNTS}) AS c) AS total_upserts,
       CAST(0 AS BIGINT) AS invalid_metrics, CAST(0 AS BIGINT) AS inconsistent_metrics""",
    "hwm_get": with_(RORDERS, V1, STATE_V1)
    + f"""SELECT ids.pipeline_id, COALESCE(s.last_watermark, {EPOCH}) AS last_watermark
FROM (SELECT DISTINCT 'daily_metrics_' || lower(country) AS pipeline_id FROM rorders
      UNION SELECT 'daily_metrics_etl') AS ids
LEFT JOIN state s USING (pipeline_id)""",
    "hwm_save": with_(
        RORDERS,
        V1,
        STATE_V1,
        """ch AS (SELECT 'daily_metrics_' || lower(r.country) AS pipeline_id, r.restaurant_id,
                   CAST(r.created_at AS DATE) AS date, r.country, r.updated_at
            FROM rorders r JOIN state s ON 'daily_metrics_' || lower(r.country) = s.pipeline_id
            WHERE r.updated_at > s.last_watermark)""",
        f"""upd AS (SELECT pipeline_id, max(updated_at) AS last_watermark, {RUN_TS} AS last_run_at,
                    count(*) AS rows_processed, count(DISTINCT (restaurant_id, date, country)) AS groups_affected
             FROM ch GROUP BY pipeline_id)""",
    )
    + """SELECT * FROM state WHERE pipeline_id NOT IN (SELECT pipeline_id FROM upd)
UNION ALL SELECT * FROM upd""",
    "hwm_reset": with_(
        RORDERS,
        V1,
        STATE_V1,
        """ids AS (SELECT pipeline_id FROM state WHERE pipeline_id = 'daily_metrics_in'
             UNION SELECT 'daily_metrics_etl')""",
    )
    + f"""SELECT * FROM state WHERE pipeline_id NOT IN (SELECT pipeline_id FROM ids)
UNION ALL
SELECT s.pipeline_id, {EPOCH} AS last_watermark, {RUN_TS} AS last_run_at, s.rows_processed, s.groups_affected
FROM state s WHERE s.pipeline_id IN (SELECT pipeline_id FROM ids)
UNION ALL
SELECT i.pipeline_id, {EPOCH}, {RUN_TS}, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
FROM ids i WHERE i.pipeline_id NOT IN (SELECT pipeline_id FROM state)""",
    "ceil_millis": "SELECT event_id, ts, ts + to_microseconds((1000 - epoch_us(ts) % 1000) % 1000) AS ceil_ts FROM events",
    # Orders whose last version broke a rule are gone; lower-case countries count.
    "stream_foreachbatch": BASE + metrics_of("rorders", f"NOT (CAST(order_id AS BIGINT) % 17 = 0 AND updated_at > {SPLIT})"),
}
# The bucketed forms give what the plain ones give.
ORACLE |= {f"{name}_bucketed": ORACLE[name] for name in ("apply_changes", "insert_if_absent")}
