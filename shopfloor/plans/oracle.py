"""The registered queries as independent SQL, for cross-checking the results.

Written the plain way, with one window per line or machine: right on small data, and
unlike the plans they check.
"""

from __future__ import annotations

from shopfloor.plans.queries import TABLES


def rounded(expression: str, digits: int) -> str:
    return f"round(({expression}) + sign({expression}) * 1e-9, {digits})"


QUALITY = """
    SELECT user_id AS machine_id, user_id % 5 AS line_id,
           CAST(ts AS DATE) AS production_date,
           CASE WHEN abs(value - 50.0) <= 30.0 THEN 1 ELSE 0 END AS in_spec
    FROM events WHERE event_type <> 'error'
"""
QUALITY_DAILY = f"""
    SELECT machine_id, line_id, production_date,
           count(*) AS units_measured,
           CAST(sum(in_spec) AS BIGINT) AS units_in_spec,
           {rounded("CAST(sum(in_spec) AS DOUBLE) / count(*)", 4)} AS quality_rate
    FROM ({QUALITY}) GROUP BY machine_id, line_id, production_date
"""
DOWNTIME_DAILY = f"""
    SELECT user_id AS machine_id, user_id % 5 AS line_id,
           CAST(ts AS DATE) AS production_date,
           CAST(sum(CAST(value / 100 AS DECIMAL(28, 6))) AS DOUBLE) AS downtime_hours
    FROM events WHERE event_type = 'error' GROUP BY 1, 2, 3
"""
DAYS_BEFORE_FILL = f"""
    SELECT q.*, d.downtime_hours
    FROM ({QUALITY_DAILY}) q LEFT JOIN ({DOWNTIME_DAILY}) d
      USING (machine_id, line_id, production_date)
"""
MACHINE_DAYS = f"""
    SELECT machine_id, line_id, production_date, units_measured, units_in_spec,
           quality_rate, coalesce(downtime_hours, 0.0) AS downtime_hours,
           CAST(24 AS DOUBLE) AS planned_hours,
           {rounded("(24 - coalesce(downtime_hours, 0.0)) / 24", 4)} AS availability
    FROM ({DAYS_BEFORE_FILL})
"""
LINE_OEE = f"""
    SELECT line_id, production_date,
           {rounded("avg(availability)", 4)} AS availability,
           {rounded("avg(quality_rate)", 4)} AS quality_rate,
           CAST(1 AS DOUBLE) AS performance_assumed,
           {rounded("avg(availability) * avg(quality_rate)", 4)} AS oee
    FROM ({MACHINE_DAYS}) GROUP BY line_id, production_date
"""
SUBGROUPS = """
    SELECT line_id, CAST(place // 5 AS BIGINT) AS subgroup_index,
           min(ts) AS subgroup_start_ts, avg(value) AS xbar,
           max(value) - min(value) AS r
    FROM (SELECT event_type AS line_id, ts, value,
                 row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS place
          FROM events)
    GROUP BY 1, 2 HAVING count(*) = 5
"""
LIMITS = f"""
    SELECT line_id, count(*) AS n_subgroups, avg(xbar) AS xbar_bar, avg(r) AS r_bar,
           avg(xbar) + 0.577 * avg(r) AS ucl_xbar, avg(xbar) - 0.577 * avg(r) AS lcl_xbar,
           2.114 * avg(r) AS ucl_r, 0.0 * avg(r) AS lcl_r
    FROM ({SUBGROUPS}) GROUP BY line_id
"""
CHART = f"""
    SELECT line_id, subgroup_index, subgroup_start_ts,
           {rounded("xbar", 4)} AS xbar, {rounded("r", 4)} AS "range",
           {rounded("ucl_xbar", 4)} AS ucl_xbar, {rounded("lcl_xbar", 4)} AS lcl_xbar,
           {rounded("xbar_bar", 4)} AS centerline_xbar,
           CAST(xbar > ucl_xbar OR xbar < lcl_xbar AS INTEGER) AS out_of_control
    FROM ({SUBGROUPS}) JOIN ({LIMITS}) USING (line_id)
"""
CAPABILITY = f"""
    SELECT line_id, n_subgroups, {rounded("xbar_bar", 4)} AS xbar_bar,
           {rounded("r_bar", 4)} AS r_bar, {rounded("r_bar / 2.326", 4)} AS sigma_hat,
           {rounded("least((80 - xbar_bar), (xbar_bar - 20)) / (3 * r_bar / 2.326)", 3)} AS cpk,
           out_of_control_subgroups,
           {rounded("CAST(out_of_control_subgroups AS DOUBLE) / n_subgroups", 4)}
               AS out_of_control_pct
    FROM ({LIMITS}) JOIN (
        SELECT line_id, CAST(sum(out_of_control) AS BIGINT) AS out_of_control_subgroups
        FROM ({CHART}) GROUP BY line_id) USING (line_id)
"""
BY_REASON = f"""
    SELECT o_orderpriority AS reason, count(*) AS event_count,
           {rounded("CAST(sum(CAST(o_totalprice AS DECIMAL(28, 6))) AS DOUBLE)", 2)} AS total_downtime_hours
    FROM orders GROUP BY 1
"""
PARETO = f"""
    SELECT reason, event_count, total_downtime_hours,
           {rounded("total_downtime_hours / sum(total_downtime_hours) OVER ()", 4)}
               AS pct_of_total_downtime
    FROM ({BY_REASON})
"""
AHEAD = "PARTITION BY user_id ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL 6 HOURS FOLLOWING"
LABELLED = f"""
    SELECT event_id, user_id, ts, value,
           max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER ({AHEAD}) AS label
    FROM events
"""
SCORED = f"SELECT label, value / 500 AS score FROM ({LABELLED})"
IS_TEST = (
    "CAST(CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 25"
    " AS INTEGER)"
)
CONFUSION = f"""
    SELECT count(*) FILTER (label = 1 AND score > 0.1) AS tp,
           count(*) FILTER (label = 0 AND score > 0.1) AS fp,
           count(*) FILTER (label = 1 AND score <= 0.1) AS fn,
           count(*) FILTER (label = 0 AND score <= 0.1) AS tn
    FROM ({SCORED})
"""
HARD = f"""
    SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS p, CAST(tp AS DOUBLE) / (tp + fn) AS rc,
           2.0 * CAST(tp AS DOUBLE) / (2 * tp + fp + fn) AS f
    FROM ({CONFUSION})
"""
# Rank-sum form of the area under the curve, with mean ranks for ties.
AUC = f"""
    SELECT sum(label) AS p, count(*) - sum(label) AS n,
           (sum(CASE WHEN label = 1 THEN mean_rank ELSE 0 END)
              - CAST(sum(label) AS DOUBLE) * (sum(label) + 1) / 2)
           / (CAST(sum(label) AS DOUBLE) * (count(*) - sum(label))) AS auc
    FROM (SELECT label, rank() OVER (ORDER BY score)
                 + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mean_rank
          FROM ({SCORED}))
"""


def _long(pairs: dict[str, tuple[str, str]], source_digits: int = 4) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric, {rounded(expression, source_digits)} AS value"
        f" FROM ({source})"
        for name, (expression, source) in pairs.items()
    )


METRICS = _long(
    {
        "precision": ("p", HARD),
        "recall": ("rc", HARD),
        "f1_score": ("f", HARD),
        "roc_auc": ("auc", AUC),
    }
)


def _null_counts(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS failures FROM ({source})"
        for c in columns
    )


def _check(name: str, failing_rows: str) -> str:
    return f"""
        SELECT '{name}' AS check_name, count(*) AS failures,
               count(*) <> 0 AS should_warn, count(*) <> 0 AS should_error
        FROM ({failing_rows})
    """


CONFORMED = f"""
    SELECT CAST(machine_id AS VARCHAR) AS machine_id, CAST(line_id AS VARCHAR) AS line_id,
           production_date, CAST(units_measured AS INTEGER) AS units_measured,
           CAST(units_in_spec AS INTEGER) AS units_in_spec,
           CAST(quality_rate AS DECIMAL(6,4)) AS quality_rate,
           CAST({rounded("downtime_hours", 2)} AS DECIMAL(6,2)) AS downtime_hours,
           CAST(planned_hours AS DECIMAL(6,2)) AS planned_hours,
           CAST(availability AS DECIMAL(6,4)) AS availability
    FROM ({MACHINE_DAYS})
"""
CONFORMED_COLUMNS = (
    "machine_id line_id production_date units_measured units_in_spec quality_rate "
    "downtime_hours planned_hours availability"
).split()


def _conform_violations() -> str:
    rules = [
        f"SELECT 'not_null_{c}' AS rule, count(*) - count({c}) AS failures FROM ({CONFORMED})"
        for c in CONFORMED_COLUMNS
    ]
    rules += [
        f"SELECT 'max_length_{c}', count(*) FILTER (length({c}) > 8) FROM ({CONFORMED})"
        for c in ("machine_id", "line_id")
    ]
    rules.append(
        f"""SELECT 'primary_key_machine_id_production_date', count(*)
            FROM (SELECT machine_id, production_date FROM ({CONFORMED})
                  GROUP BY 1, 2 HAVING count(*) > 1)"""
    )
    return " UNION ALL ".join(rules)


# Which delivery brings an event for the first time, and which bring it at all.
DELIVERED = """
    SELECT *, CAST(ts AS DATE) AS day, 3 AS delivery FROM events WHERE event_id % 97 = 0
    UNION ALL
    SELECT *, CAST(ts AS DATE), 1 FROM events
    WHERE event_id % 97 <> 0 AND CAST(ts AS DATE) <= DATE '2024-01-15'
    UNION ALL
    SELECT *, CAST(ts AS DATE), 2 FROM events
    WHERE event_id % 97 <> 0 AND (CAST(ts AS DATE) > DATE '2024-01-15' OR event_id % 7 = 0)
"""


def _in_time(kind: str) -> str:
    """The rows that a daily stream counts: those of days that the watermark, one hour behind the
    latest row, had not closed when they came, and has closed in the end."""
    return f"""
        SELECT * FROM (
            SELECT *, CAST(ts AS DATE) AS day, CAST(ts AS DATE) + INTERVAL 1 DAY AS closes,
                   CAST(ts AS DATE) <= DATE '2024-01-15' AND event_id % 13 <> 0 AS in_first,
                   max(ts) OVER () - INTERVAL 1 HOUR AS last_mark,
                   max(CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-15' AND event_id % 13 <> 0
                            THEN ts END) OVER () - INTERVAL 1 HOUR AS first_mark
            FROM events WHERE {kind})
        WHERE closes <= last_mark AND (in_first OR closes > first_mark)
    """


STOP_REASONS = f"""
    SELECT 'reason ' || (user_id % 3) AS reason, count(*) AS event_count,
           {rounded("CAST(sum(CAST(value / 100 AS DECIMAL(28, 6))) AS DOUBLE)", 2)} AS total_downtime_hours
    FROM events WHERE event_type = 'error' GROUP BY 1
"""
GATED = {
    "orders": [
        ("not_null_orders_o_orderkey", "SELECT 1 FROM orders WHERE o_orderkey IS NULL"),
        ("not_null_orders_o_totalprice", "SELECT 1 FROM orders WHERE o_totalprice IS NULL"),
        (
            "unique_orders_o_orderkey",
            "SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1",
        ),
    ],
    "lineitem": [
        ("not_null_lineitem_l_orderkey", "SELECT 1 FROM lineitem WHERE l_orderkey IS NULL"),
        (
            "unique_lineitem_l_orderkey_l_linenumber",
            "SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
        ),
    ],
    "days": [
        ("not_null_days_machine_id", f"SELECT 1 FROM ({DAYS_BEFORE_FILL}) WHERE machine_id IS NULL"),
        (
            "not_null_days_downtime_hours",
            f"SELECT 1 FROM ({DAYS_BEFORE_FILL}) WHERE downtime_hours IS NULL",
        ),
    ],
}


def _gated() -> str:
    each = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, count(*) AS failures"
        f" FROM ({failing})"
        for table, tests in GATED.items()
        for check, failing in tests
    )
    return f"""
        SELECT *, sum(failures) OVER (PARTITION BY table_name) = 0 AS published FROM ({each})
    """


STOPS = """
    SELECT 'M' || user_id AS machine_id, 'L' || (user_id % 5) AS line_id,
           ts AS downtime_start_ts, value / 100 AS downtime_hours,
           'Equipment Failure' AS reason
    FROM events WHERE event_type = 'error'
"""

ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLES
)

ORACLE: dict[str, str] = {
    "csv_scan": STOPS,
    "csv_inferred": STOPS,
    "staged_downtime": STOPS,
    "streaming_silver": f"""
        SELECT DISTINCT *, CAST(downtime_start_ts AS DATE) AS downtime_date FROM ({STOPS})
    """,
    "dedup_by_arrival": "SELECT event_id, value FROM events",
    "served_chart": f"""
        SELECT CAST(line_id AS VARCHAR) AS line_id, subgroup_start_ts,
               CAST(CAST(xbar AS DECIMAL(8,4)) AS VARCHAR) AS xbar,
               CAST(CAST("range" AS DECIMAL(8,4)) AS VARCHAR) AS range_val,
               CAST(CAST(ucl_xbar AS DECIMAL(8,4)) AS VARCHAR) AS ucl_xbar,
               CAST(CAST(lcl_xbar AS DECIMAL(8,4)) AS VARCHAR) AS lcl_xbar,
               CAST(CAST(centerline_xbar AS DECIMAL(8,4)) AS VARCHAR) AS centerline_xbar,
               out_of_control = 1 AS out_of_control
        FROM ({CHART})
    """,
    "served_capability": f"""
        SELECT CAST(line_id AS VARCHAR) AS line_id, CAST(n_subgroups AS INTEGER) AS n_subgroups,
               CAST(CAST(cpk AS DECIMAL(6,3)) AS VARCHAR) AS cpk,
               CAST(out_of_control_subgroups AS INTEGER) AS out_of_control_subgroups,
               CAST(CAST(out_of_control_pct AS DECIMAL(6,4)) AS VARCHAR) AS out_of_control_pct
        FROM ({CAPABILITY})
    """,
    "silver_typed": """
        SELECT event_id, user_id, ts AS reading_ts, CAST(ts AS DATE) AS reading_date
        FROM events
    """,
    "silver_dedup": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
               l_extendedprice
        FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) = 1
    """,
    "scan_pruned": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate
        FROM lineitem
    """,
    "partitioned_scan": """
        SELECT event_id, value, CAST(ts AS DATE) AS reading_date FROM events
    """,
    "spec_flag": """
        SELECT event_id, value,
               CASE WHEN abs(value - 50.0) <= 30.0 THEN 1 ELSE 0 END AS in_spec
        FROM events
    """,
    "quality_daily": QUALITY_DAILY,
    "downtime_daily": DOWNTIME_DAILY,
    "machine_daily_oee": MACHINE_DAYS,
    "line_summary": f"""
        SELECT line_id, {rounded("avg(availability)", 4)} AS avg_availability,
               {rounded("avg(quality_rate)", 4)} AS avg_quality_rate
        FROM ({MACHINE_DAYS}) GROUP BY line_id ORDER BY line_id
    """,
    "line_oee": LINE_OEE,
    "line_oee_with_rate": f"""
        SELECT line_id, production_date, {rounded("a", 4)} AS availability,
               {rounded("q", 4)} AS quality_rate, {rounded("p", 4)} AS performance,
               {rounded("a * q * p", 4)} AS oee
        FROM (SELECT line_id, production_date, avg(availability) AS a,
                     avg(quality_rate) AS q,
                     coalesce(CAST(sum(units_measured) AS DOUBLE)
                              / nullif(sum(planned_hours - downtime_hours)
                                       * (max(r_regionkey) * CAST(0.02 AS DOUBLE)), 0),
                              1.0) AS p
              FROM ({MACHINE_DAYS}) LEFT JOIN region ON r_regionkey = line_id
              GROUP BY line_id, production_date)
    """,
    "spc_subgroups": f"""
        SELECT line_id, subgroup_index, subgroup_start_ts, {rounded("xbar", 6)} AS xbar,
               {rounded("r", 6)} AS "range"
        FROM ({SUBGROUPS})
    """,
    "spc_limits": f"""
        SELECT line_id, n_subgroups, {rounded("xbar_bar", 6)} AS xbar_bar,
               {rounded("r_bar", 6)} AS r_bar, {rounded("ucl_xbar", 6)} AS ucl_xbar,
               {rounded("lcl_xbar", 6)} AS lcl_xbar, {rounded("ucl_r", 6)} AS ucl_r,
               {rounded("lcl_r", 6)} AS lcl_r
        FROM ({LIMITS})
    """,
    "spc_control_chart": f"SELECT * EXCLUDE (subgroup_index) FROM ({CHART})",
    "spc_range_chart": f"""
        SELECT line_id, subgroup_start_ts, {rounded("r", 4)} AS "range",
               {rounded("ucl_r", 4)} AS ucl_r, {rounded("lcl_r", 4)} AS lcl_r,
               {rounded("r_bar", 4)} AS centerline_r,
               CAST(r > ucl_r OR r < lcl_r AS INTEGER) AS out_of_control
        FROM ({SUBGROUPS}) JOIN ({LIMITS}) USING (line_id)
    """,
    "spc_capability": CAPABILITY,
    "spc_first_n": f"SELECT * FROM ({CHART}) WHERE subgroup_index < 80",
    "capability_ranked": f"""
        SELECT line_id, cpk, n_subgroups FROM ({CAPABILITY}) ORDER BY cpk, line_id
    """,
    "capability_grade": f"""
        SELECT line_id, cpk,
               CASE WHEN cpk < 1.0 THEN 'bad' WHEN cpk < 1.33 THEN 'marginal'
                    WHEN cpk IS NOT NULL THEN 'acceptable' END AS grade
        FROM ({CAPABILITY})
    """,
    "downtime_pareto": f"{PARETO} ORDER BY total_downtime_hours DESC, reason",
    "downtime_pareto_cumulative": f"""
        SELECT *, {rounded('''100 * sum(pct_of_total_downtime) OVER (
                 ORDER BY total_downtime_hours DESC, reason
                 ROWS UNBOUNDED PRECEDING)''', 2)} AS cumulative_pct
        FROM ({PARETO}) ORDER BY total_downtime_hours DESC, reason
    """,
    "failure_horizon_label": f"SELECT event_id, user_id, ts, label FROM ({LABELLED})",
    "next_failure": f"""
        SELECT event_id, user_id, ts, next_failure_ts,
               {rounded("CAST(epoch_us(next_failure_ts) - epoch_us(ts) AS DOUBLE) / 3.6e9", 6)}
                   AS hours_to_failure
        FROM (SELECT event_id, user_id, ts,
                     min(CASE WHEN event_type = 'error' THEN ts END) OVER ({AHEAD})
                         AS next_failure_ts
              FROM events)
        WHERE next_failure_ts IS NOT NULL
    """,
    "next_failure_left": f"""
        SELECT event_id, user_id, ts, next_failure_ts,
               {rounded("CAST(epoch_us(next_failure_ts) - epoch_us(ts) AS DOUBLE) / 3.6e9", 6)}
                   AS hours_to_failure
        FROM (SELECT event_id, user_id, ts,
                     min(CASE WHEN event_type = 'error' THEN ts END) OVER ({AHEAD})
                         AS next_failure_ts
              FROM events)
    """,
    # The first two hold for every fitted forest.
    "rf_scores": f"""
        SELECT event_id, label, true AS score_in_range, true AS prediction_agrees
        FROM ({LABELLED}) WHERE {IS_TEST} = 1
    """,
    "rf_importance": """
        SELECT unnest(['value', 'hour_of_day', 'vibration']) AS feature, true AS is_share,
               CAST(1 AS DOUBLE) AS total
    """,
    # What a useless or wrongly walked forest breaks.
    "forest_walk": f"""
        SELECT event_id, label, true AS loads_alike, true AS walks_alike, true AS predicts_alike
        FROM ({LABELLED})
    """,
    "forest_quality": f"""
        SELECT CAST(sum(label) AS BIGINT) AS n_positive,
               CAST(count(*) - sum(label) AS BIGINT) AS n_negative,
               true AS ranks_failures_first, true AS scores_failures_higher,
               true AS tells_rows_apart
        FROM ({LABELLED}) WHERE {IS_TEST} = 1
    """,
    "forest_importance": """
        SELECT unnest(['value', 'hour_of_day', 'vibration']) AS feature, true AS agrees,
               unnest([false, false, true]) AS leads
    """,
    "forest_audit": """
        SELECT range AS tree, true AS is_binary, true AS is_connected, true AS is_grown,
               true AS leaves_are_large
        FROM range(200)
    """,
    "run_records": f"""
        SELECT 'failure-1' AS run_name, 'metric' AS kind, metric AS name,
               CAST(2 AS BIGINT) AS n_runs, value AS metric, CAST(NULL AS VARCHAR) AS param
        FROM ({METRICS})
        UNION ALL
        SELECT 'failure-1', 'param', unnest(['trees', 'max_depth', 'class_weights']), 2,
               CAST(NULL AS DOUBLE), unnest(['200', '8', 'balanced'])
    """,
    "scan_dates": """
        SELECT event_id, value, CAST(ts AS DATE) AS reading_date FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'
    """,
    "label_positive_rate": f"""
        SELECT count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive,
               {rounded("avg(label)", 6)} AS positive_rate
        FROM ({LABELLED})
    """,
    "hash_split": f"SELECT event_id, user_id, {IS_TEST} AS is_test FROM events",
    "stratified_split": f"""
        SELECT event_id, label,
               CAST(row_number() OVER (PARTITION BY label
                        ORDER BY md5(CAST(event_id AS VARCHAR)), event_id)
                    <= round(count(*) OVER (PARTITION BY label) * 0.25) AS INTEGER)
                   AS is_test
        FROM ({LABELLED})
    """,
    "split_balance": f"""
        SELECT {IS_TEST} AS is_test, count(*) AS n_rows,
               CAST(sum(label) AS BIGINT) AS n_positive,
               {rounded("avg(label)", 6)} AS positive_rate
        FROM ({LABELLED}) GROUP BY 1
    """,
    "class_weights": f"""
        SELECT label, count(*) AS n_rows,
               {rounded("sum(count(*)) OVER () / (CAST(count(*) OVER () AS DOUBLE) * count(*))", 6)}
                   AS weight
        FROM ({LABELLED}) GROUP BY label
    """,
    "classification_metrics": f"""
        SELECT tp, fp, fn, tn, {rounded("p", 6)} AS precision, {rounded("rc", 6)} AS recall,
               {rounded("f", 6)} AS f1_score
        FROM ({HARD})
    """,
    "roc_auc": f"""
        SELECT CAST(p AS BIGINT) AS n_positive, CAST(n AS BIGINT) AS n_negative,
               {rounded("auc", 6)} AS roc_auc
        FROM ({AUC})
    """,
    "metrics_long": METRICS,
    "check_not_null": _null_counts(
        ["machine_id", "production_date", "quality_rate", "downtime_hours"],
        DAYS_BEFORE_FILL,
    ),
    "check_unique": """
        SELECT l_orderkey, count(*) AS n_records FROM lineitem
        WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1
    """,
    "check_summary": " UNION ALL ".join(
        [
            _check(
                "not_null_lineitem_l_orderkey",
                "SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NULL",
            ),
            _check(
                "not_null_lineitem_l_returnflag",
                "SELECT l_returnflag FROM lineitem WHERE l_returnflag IS NULL",
            ),
            _check(
                "unique_lineitem_l_partkey",
                "SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) > 1",
            ),
            _check(
                "unique_lineitem_l_orderkey_l_linenumber",
                "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2"
                " HAVING count(*) > 1",
            ),
        ]
    ),
    "pk_violations": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_records, 'duplicate' AS violation
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
    "staged_projection": f"""
        SELECT CAST(machine_id AS VARCHAR) AS machine_id,
               CAST(line_id AS VARCHAR) AS line_id, production_date,
               CAST(units_measured AS INTEGER) AS units_measured,
               CAST(units_in_spec AS INTEGER) AS units_in_spec, quality_rate,
               downtime_hours, planned_hours, availability
        FROM ({MACHINE_DAYS})
    """,
    "conform_schema": f"""
        SELECT * REPLACE (
            CAST(quality_rate AS VARCHAR) AS quality_rate,
            CAST(downtime_hours AS VARCHAR) AS downtime_hours,
            CAST(planned_hours AS VARCHAR) AS planned_hours,
            CAST(availability AS VARCHAR) AS availability)
        FROM ({CONFORMED})
    """,
    "conform_violations": _conform_violations(),
    "incremental_machine_days": MACHINE_DAYS,
    "incremental_line_oee": LINE_OEE,
    "bucketed_machine_days": MACHINE_DAYS,
    "incremental_pareto": f"""
        SELECT reason, event_count, total_downtime_hours,
               {rounded("total_downtime_hours / sum(total_downtime_hours) OVER ()", 4)}
                   AS pct_of_total_downtime
        FROM ({STOP_REASONS})
    """,
    "delivery_manifest": f"""
        SELECT CASE WHEN event_type = 'error' THEN 'downtime_events'
                    ELSE 'quality_measurements' END AS table_name,
               day, delivery, count(*) AS n_rows
        FROM ({DELIVERED}) GROUP BY 1, 2, 3
    """,
    "published_versions": "SELECT event_id, value, event_id % 2 = 0 AS in_first FROM events",
    "published_layer": f"""
        SELECT CAST(machine_id AS VARCHAR) AS machine_id, CAST(line_id AS VARCHAR) AS line_id,
               production_date,
               row_number() OVER (ORDER BY production_date, CAST(machine_id AS VARCHAR),
                                           CAST(line_id AS VARCHAR)) - 1 AS place,
               count(*) OVER () AS row_count
        FROM ({MACHINE_DAYS})
    """,
    "gate_blocks": _gated(),
    "spc_stream_chart": f"SELECT * FROM ({CHART})",
    "streaming_silver_late": f"""
        SELECT DISTINCT *, CAST(downtime_start_ts AS DATE) AS downtime_date FROM ({STOPS})
    """,
    "streaming_rejects": f"""
        SELECT machine_id, line_id, 'about 2024-01-20' AS text FROM ({STOPS})
        WHERE CAST(downtime_start_ts AS DATE) = DATE '2024-01-20'
    """,
    "streaming_quality_daily": f"""
        SELECT user_id AS machine_id, user_id % 5 AS line_id, day AS production_date,
               count(*) AS units_measured,
               CAST(sum(CASE WHEN abs(value - 50.0) <= 30.0 THEN 1 ELSE 0 END) AS BIGINT)
                   AS units_in_spec
        FROM ({_in_time("event_type <> 'error'")}) GROUP BY 1, 2, 3
    """,
    "streaming_downtime_daily": f"""
        SELECT user_id AS machine_id, user_id % 5 AS line_id, day AS production_date,
               CAST(sum(CAST(value / 100 AS DECIMAL(28, 6))) AS DOUBLE) AS downtime_hours
        FROM ({_in_time("event_type = 'error'")}) GROUP BY 1, 2, 3
    """,
    "row_count_audit": ROW_COUNTS,
    "row_counts_from_footers": ROW_COUNTS,
}

# The same results are due whatever the number of pieces.
for _name in (
    "spc_subgroups", "next_failure", "next_failure_left", "stratified_split", "roc_auc"
):
    ORACLE[f"{_name}_in_pieces"] = ORACLE[_name]
