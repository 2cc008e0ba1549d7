"""Equivalent SQL for the checked queries, written for DuckDB over the same tables."""

from __future__ import annotations

from cohortlake import fixtures, schema
from cohortlake.operators.gates import QUALITY_CRITERIA, SYSTEM_CRITERIA, Criterion
from cohortlake.plans import cases
from cohortlake.plans.queries import DELAY_LATENESS_MS, NOW_MS

_F = schema.FEATURES
_COLUMNS = fixtures.student_columns()


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _list(names, template: str = "{0}", glue: str = ", ") -> str:
    return glue.join(template.format(name) for name in names)


STUDENTS = (
    "students AS (SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in _COLUMNS.items()) + " FROM orders)"
)


def _pass_rate(term: str) -> str:
    units = f"curricular_units_{term}_sem"
    return (
        f"CASE WHEN {units}_enrolled > 0 THEN cast({units}_approved AS double) / {units}_enrolled "
        f"ELSE cast(0 AS double) END AS pass_rate_{term}_sem"
    )


_LABEL = "CASE target WHEN 'Dropout' THEN 0 WHEN 'Enrolled' THEN 1 WHEN 'Graduate' THEN 2 ELSE -1 END"
_NAME = "CASE label WHEN 0 THEN 'Dropout' WHEN 1 THEN 'Enrolled' WHEN 2 THEN 'Graduate' END"
_DERIVED = (
    f"{_pass_rate('1st')}, {_pass_rate('2nd')}, "
    "curricular_units_2nd_sem_grade - curricular_units_1st_sem_grade AS grade_delta, "
    "cast(tuition_fees_up_to_date + scholarship_holder - debtor AS double) AS financial_stability_index, "
    f"{_LABEL} AS label"
)
ENRICHED = f"enriched AS (SELECT *, {_DERIVED} FROM students)"
_PERSISTED = _list(schema.PERSISTED)


def _in_train(key: str) -> str:
    return f"cast('0x' || substr(md5(cast({key} AS varchar)), 1, 8) AS bigint) % 100 < 80"


_TRAIN = _in_train("event_seq")
LABELLED = f"labelled AS (SELECT *, {_TRAIN} AS is_train FROM enriched WHERE label >= 0)"
WEIGHTS = (
    "weights AS (SELECT label, count(*) AS rows, "
    "cast(sum(count(*)) OVER () AS double) / (3 * count(*)) AS weight "
    "FROM labelled WHERE is_train GROUP BY label)"
)

# Scaled features: ranges from training rows, a constant column becomes the middle.
RANGES = (
    "ranges AS (SELECT "
    + _list(_F, "cast(min({0}) AS double) AS lo_{0}, cast(max({0}) AS double) AS hi_{0}")
    + " FROM labelled WHERE is_train)"
)
SCALED = (
    "scaled AS (SELECT l.*EXCLUDE ("
    + _list(_F)
    + "), "
    + _list(_F, "CASE WHEN hi_{0} = lo_{0} THEN cast(0.5 AS double) ELSE (l.{0} - lo_{0}) / (hi_{0} - lo_{0}) END AS {0}")
    + " FROM labelled l, ranges)"
)

# Gaussian Bayes over the scaled training rows.
SPREAD = (
    "spread AS (SELECT 1e-9::double * greatest("
    + _list(_F, "var_pop({0})")
    + ") AS eps FROM scaled WHERE is_train)"
)
CLASSES = (
    "classes AS (SELECT label AS c, ln(count(*)) AS prior, "
    + _list(_F, "avg({0}) AS mu_{0}, var_pop({0}) + any_value(eps) AS sg_{0}")
    + " FROM scaled, spread WHERE is_train GROUP BY label)"
)
_DENSITY = "-0.5::double * ln(2 * pi() * sg_{0}) - 0.5::double * (s.{0} - mu_{0}) * (s.{0} - mu_{0}) / sg_{0}"
SCORES = (
    "scores AS (SELECT s.event_seq, s.label, s.is_train, c.c, prior + ("
    + _list(_F, _DENSITY, " + ").replace(" + -", " - ")
    + ") AS score FROM scaled s, classes c)"
)
PREDICTED = (
    "predicted AS (SELECT event_seq, label, is_train, cast(arg_max(c, score) AS double) AS prediction "
    "FROM scores GROUP BY ALL)"
)
_BAYES = (STUDENTS, ENRICHED, LABELLED, RANGES, SCALED, SPREAD, CLASSES, SCORES, PREDICTED)


def _metrics(source: str) -> tuple[str, ...]:
    """CTEs ``m``: the four metrics of rows (label, prediction) in ``source``."""
    return (
        f"cells AS (SELECT label, cast(prediction AS int) AS prediction, count(*) AS n FROM {source} GROUP BY 1, 2)",
        "perclass AS (SELECT k, "
        "coalesce(sum(n) FILTER (label = k), 0) AS sup, "
        "coalesce(sum(n) FILTER (prediction = k), 0) AS prd, "
        "coalesce(sum(n) FILTER (label = k AND prediction = k), 0) AS tp, sum(n) AS total "
        "FROM cells, range(0, 3) r(k) GROUP BY k)",
        "m AS (SELECT round(cast(sum(tp) AS double) / any_value(total), 4) AS accuracy, "
        "round(sum(CASE WHEN prd > 0 THEN sup / total * (tp / prd) ELSE 0 END), 4) AS precision, "
        "round(sum(CASE WHEN sup > 0 THEN sup / total * (tp / sup) ELSE 0 END), 4) AS recall, "
        "round(sum(CASE WHEN tp > 0 THEN sup / total * (2 * tp / (sup + prd)) ELSE 0 END), 4) AS f1_score "
        "FROM perclass)",
    )


def _criteria(criteria: tuple[Criterion, ...]) -> str:
    def text(value):
        return "NULL" if value is None else f"'{value}'"

    rows = ", ".join(
        f"({i}, {text(c.metric)}, {text(c.label)}, {text(c.operator)}, "
        f"cast({'NULL' if c.target is None else c.target} AS double), {text(c.unit)})"
        for i, c in enumerate(criteria)
    )
    return f"criteria(ordinal, metric, label, operator, target, unit) AS (VALUES {rows})"


GATED = (
    "judged AS (SELECT *, CASE operator WHEN '>' THEN value > target WHEN '>=' THEN value >= target "
    "WHEN '<' THEN value < target WHEN '<=' THEN value <= target END AS passed "
    "FROM criteria LEFT JOIN measured USING (metric))",
    "gated AS (SELECT ordinal, metric, label, round(value, 4) AS value, unit, "
    "coalesce(operator, '') AS operator, target, passed, "
    "CASE WHEN target IS NULL THEN 'Reference only' ELSE 'Target ' || operator || ' ' || "
    "printf('%g', target) || CASE WHEN unit = '' THEN '' ELSE ' ' || unit END END AS target_text, "
    "CASE WHEN value IS NULL THEN 'Data unavailable' WHEN passed IS NULL THEN '[INFO]' "
    "WHEN passed THEN '[PASS]' ELSE '[FAIL]' END AS status FROM judged)",
)
_QUALITY = (
    *_BAYES,
    "testset AS (SELECT * FROM predicted WHERE NOT is_train)",
    *_metrics("testset"),
    "measured AS (UNPIVOT m ON accuracy, precision, recall, f1_score INTO NAME metric VALUE value)",
    _criteria(QUALITY_CRITERIA),
    *GATED,
)

# Simulated sends, one per event.
SENDS = (
    f"sends AS (SELECT event_id, cast({fixtures.TARGET_RATE} AS bigint) AS target_rate, "
    f"cast({fixtures.SCALE_FACTOR} AS bigint) AS scale_factor, {fixtures.SEND_OK} AS ok, "
    f"epoch_us(ts) AS ts_us, {fixtures.SEND_US} AS send_us, {fixtures.QUEUE_US} AS queue_us FROM events)"
)
MODES = (
    "modes AS (SELECT 0 AS mode, queue_us + send_us AS v FROM sends "
    "UNION ALL SELECT 1, send_us FROM sends WHERE ok)"
)
_TOP = "({0} | ((1::bigint << greatest(length(bin({0})) - 11, 0)::int) - 1))"
RUNS = (
    "runs AS (SELECT target_rate, scale_factor, count(*) FILTER (ok) AS total_sent, "
    "count(*) FILTER (NOT ok) AS total_errors, (max(ts_us) - min(ts_us)) / 1e6::double AS total_time_s "
    "FROM sends GROUP BY ALL)"
)
_RATE = "CASE WHEN total_time_s > 0 THEN total_sent / total_time_s ELSE 0 END"
REPORTS = (
    SENDS,
    RUNS,
    f"tops AS (SELECT target_rate, scale_factor, {_TOP.format('(queue_us + send_us)')} AS top FROM sends)",
    "quantiles AS (SELECT target_rate, scale_factor, quantile_disc(top, 0.5) AS p50, "
    "quantile_disc(top, 0.99) AS p99 FROM tops GROUP BY ALL)",
    "reports AS (SELECT 'producer_spark_rate' || target_rate || '_scale' || scale_factor || '_' || "
    "(1700000000 + target_rate + scale_factor) || '.json' AS file_name, "
    "1700000000 + target_rate + scale_factor AS reported_at, target_rate, scale_factor, total_sent, "
    f"total_errors, total_time_s, {_RATE} AS avg_rate, p50, p99 "
    "FROM runs JOIN quantiles USING (target_rate, scale_factor))",
)

# Messages by case number: which are kept, and which lose their optional fields.
_CASE = f"event_seq % {cases.CASES}"
_BAD = f"({_CASE}) IN ({_list(cases.REJECTED)})"
_STAMP = f"{cases.START_MS} + event_seq"
_RECORD = (
    _list(schema.REQUIRED)
    + f", CASE WHEN {_CASE} = {cases.NO_OPTIONALS} THEN '' ELSE '0_' || event_seq END AS event_id, "
    + f"CASE WHEN {_CASE} = {cases.NO_OPTIONALS} THEN 0 ELSE {_STAMP} END AS event_ts_ms"
)
RECEIVED = f"received AS (SELECT {_RECORD} FROM students WHERE NOT ({_BAD}))"


def _spoiled() -> str:
    k = "event_seq"
    special = {
        "admission_grade": f"CASE WHEN {k} % 13 = 0 THEN 0 ELSE admission_grade END",
        "age_at_enrollment": f"CASE WHEN {k} % 17 = 0 THEN 0 ELSE age_at_enrollment END",
        "curricular_units_1st_sem_grade": f"CASE WHEN {k} % 23 = 0 THEN cast(12.5 AS double) ELSE curricular_units_1st_sem_grade END",
        "marital_status": f"CASE WHEN {k} % 29 = 0 THEN 0 ELSE marital_status END",
        "gdp": f"CASE WHEN {k} % 37 = 0 THEN 0 ELSE gdp END",
        "inflation_rate": "cast(0 AS double)",
        "target": f"CASE WHEN {k} % 31 = 0 THEN 'null' ELSE target END",
    }
    return ", ".join(f"{special.get(name, name)} AS {name}" for name in schema.REQUIRED)


def _stream_counts() -> str:
    runs = []
    for run, condition in ((1, "event_seq % 2 = 0"), (2, "event_seq % 2 = 1"), (3, "false")):
        runs.append(
            f"SELECT {run} AS run, count(*) FILTER ({condition}) AS received, "
            f"count(*) FILTER ({condition} AND NOT ({_BAD})) AS kept, "
            f"count(*) FILTER (NOT ({_BAD})) AS stored FROM students"
        )
    return " UNION ALL ".join(runs)


def _scales(scales=(1, 5, 10)) -> str:
    return " UNION ALL ".join(
        f"SELECT {n} AS scale_factor, label, {n} * count(*) AS rows FROM enriched GROUP BY label"
        for n in scales
    )


_OUTLIERS = (
    "outliers AS (SELECT event_seq, age_at_enrollment, "
    "CASE WHEN event_seq % 23 = 0 THEN -1 ELSE curricular_units_1st_sem_grade END AS g1, "
    "CASE WHEN event_seq % 29 = 0 THEN NULL ELSE curricular_units_2nd_sem_grade END AS g2 FROM students)"
)
_ALL_MODELS = ("Random Forest", "Logistic Regression", "Decision Tree", "Naive Bayes")


def _model_facts(*names: str) -> str:
    """Facts that hold of any sound model; the rows counted are those of the key-hash split."""
    models = ", ".join(f"('{name}')" for name in names)
    return _with(STUDENTS, ENRICHED, LABELLED) + (
        "SELECT model, count(*) AS test_rows, count(*) AS with_class, true AS recall_is_accuracy, "
        f"true AS beats_majority, true AS in_range FROM labelled, (VALUES {models}) t(model) "
        "WHERE NOT is_train GROUP BY model"
    )


# Keys by rule: every 7th row has none, every 11th an empty one; such rows go by their whole text.
_ODD_KEY = (
    "CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN o_orderkey || '|' "
    "ELSE cast(o_orderkey AS varchar) END"
)
_ROUNDED_FEATURES = _list(_F, "round({0}, 4) AS {0}")

ORACLES: dict[str, str] = {
    "csv_roundtrip": _with(STUDENTS)
    + "SELECT *, CASE event_seq % 5 WHEN 0 THEN '  padded ' WHEN 1 THEN 'two' || chr(10) || 'lines' "
    "WHEN 2 THEN 'p;q,r' WHEN 3 THEN 'say \"so\"' ELSE 'plain' END AS note FROM students",
    "rf_metrics": _model_facts("Random Forest"),
    "lr_metrics": _model_facts("Logistic Regression"),
    "dt_metrics": _model_facts("Decision Tree"),
    "model_comparison": _model_facts(*_ALL_MODELS),
    "feature_importance": f"SELECT {len(_F)}::bigint AS features, {len(_F)}::bigint AS listed_features, "
    "true AS sum_is_one, 0::bigint AS negative, 20::bigint AS top_rows",
    "scored_all": _with(STUDENTS, ENRICHED)
    + "SELECT label, count(*) AS rows, count(*) AS with_class FROM enriched WHERE label >= 0 GROUP BY label",
    "training_document": f"SELECT 'spark' AS impl, 'orders' AS parquet_source, '{','.join(_ALL_MODELS)}' AS models, "
    "20::bigint AS features, true AS falling",
    "split_missing_keys": f"SELECT o_orderkey, CASE WHEN {_in_train(_ODD_KEY)} THEN 'train' ELSE 'test' END AS part "
    "FROM orders",
    "file_sequence": "SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) - 1 AS seq FROM orders",
    "latency_percentiles_wide": "SELECT user_id % 3 AS part, count(*) AS samples, "
    "quantile_disc(1152921504606846976 + event_id * 7919, 0.5) AS p50, "
    "quantile_disc(1152921504606846976 + event_id * 7919, 0.99) AS p99 FROM events GROUP BY 1",
    "stream_rejects": _with(STUDENTS)
    + f"SELECT cast(event_seq AS varchar) AS key, count(*) FILTER (NOT ({_BAD})) OVER () AS kept "
    f"FROM students QUALIFY {_BAD}",
    "lenient_csv": _with(STUDENTS) + f"SELECT {_spoiled()} FROM students",
    "message_roundtrip": _with(STUDENTS)
    + f"SELECT cast(event_seq AS varchar) AS key, {_list(schema.REQUIRED)}, "
    f"'0_' || event_seq AS event_id, {_STAMP} AS event_ts_ms FROM students",
    "batched_parquet": "SELECT count(*) AS total_rows, 0::bigint AS files_over_limit FROM orders",
    "scan_labelled": _with(STUDENTS, ENRICHED) + f"SELECT {_PERSISTED} FROM enriched WHERE label >= 0",
    "run_reports": _with(*REPORTS)
    + "SELECT * REPLACE (round(total_time_s, 4) AS total_time_s, round(avg_rate, 4) AS avg_rate) FROM reports",
    "dashboard_export": _with(*_BAYES)
    + f"SELECT {_list([c for c in schema.DASHBOARD_COLUMNS if c not in ('prediction', 'label')], 'e.{0}')}, "
    "p.prediction, e.label FROM enriched e JOIN predicted p USING (event_seq)",
    "pass_rates": _with(STUDENTS, ENRICHED)
    + "SELECT event_seq, pass_rate_1st_sem, pass_rate_2nd_sem FROM enriched",
    "derived_features": _with(STUDENTS, ENRICHED)
    + "SELECT event_seq, grade_delta, financial_stability_index FROM enriched",
    "label_encode": _with(STUDENTS, ENRICHED) + "SELECT event_seq, target, label FROM enriched",
    "label_decode": _with(STUDENTS, ENRICHED)
    + f"SELECT event_seq, label, {_NAME} AS label_name FROM enriched",
    "enriched_records": _with(STUDENTS, ENRICHED) + f"SELECT {_PERSISTED} FROM enriched",
    "replicate_stamp": "SELECT i AS iteration, o_orderkey AS seq, i || '_' || o_orderkey AS event_id, "
    f"{cases.START_MS} + (o_orderkey * 2000) // 1000 AS event_ts_ms FROM orders, range(0, 3) r(i)",
    "pace_schedule": "SELECT o_orderkey AS seq, 0::bigint AS offset_us_0, "
    "o_orderkey * (1000000 // 7) AS offset_us_7, o_orderkey * (1000000 // 500) AS offset_us_500, "
    "o_orderkey * (1000000 // 1000) AS offset_us_1000 FROM orders",
    "sequence": "SELECT o_orderkey, o_orderstatus, "
    "row_number() OVER (ORDER BY o_orderstatus, o_orderkey) - 1 AS seq FROM orders",
    "scale_counts": _with(STUDENTS, ENRICHED) + _scales(),
    "strict_json": _with(STUDENTS, RECEIVED) + "SELECT * FROM received",
    "strict_json_rejects": _with(STUDENTS)
    + f"SELECT cast(event_seq AS varchar) AS key FROM students WHERE {_BAD}",
    "valid_records": _with(STUDENTS, _OUTLIERS)
    + "SELECT event_seq, age_at_enrollment FROM outliers "
    "WHERE age_at_enrollment BETWEEN 17 AND 70 AND g1 >= 0 AND g2 >= 0",
    "validity_report": _with(STUDENTS, _OUTLIERS)
    + "SELECT 'age_in_range' AS rule, count(*) FILTER (age_at_enrollment NOT BETWEEN 17 AND 70) AS failed_rows, "
    "count(*) AS total_rows FROM outliers "
    "UNION ALL SELECT 'grade_1st_sem', count(*) FILTER (g1 < 0), count(*) FROM outliers "
    "UNION ALL SELECT 'grade_2nd_sem', count(*) FILTER (g2 IS NULL OR g2 < 0), count(*) FROM outliers",
    "invalid_features": _with(STUDENTS, ENRICHED)
    + "SELECT event_seq, label FROM enriched WHERE event_seq % 17 <> 0 AND event_seq % 19 <> 0",
    "split_members": f"SELECT o_orderkey AS event_seq, {_in_train('o_orderkey')} AS is_train FROM orders",
    "split_sizes": f"SELECT CASE WHEN {_in_train('o_orderkey')} THEN 'train' ELSE 'test' END AS part, "
    "count(*) AS rows FROM orders GROUP BY 1",
    "label_distribution": _with(STUDENTS, ENRICHED)
    + "SELECT label, count(*) AS rows FROM enriched GROUP BY label",
    "class_weights": _with(STUDENTS, ENRICHED, LABELLED, WEIGHTS)
    + f"SELECT label, rows, round(weight, 4) AS weight, {_NAME} AS label_name FROM weights",
    "class_weights_applied": _with(STUDENTS, ENRICHED, LABELLED, WEIGHTS)
    + "SELECT event_seq, e.label, round(coalesce(weight, 1), 4) AS class_weight "
    "FROM enriched e LEFT JOIN weights USING (label)",
    "e2e_latency": _with(STUDENTS)
    + f"SELECT count(*) AS stamped_rows, round(avg({NOW_MS} - event_ts_ms) / 1000, 4) AS e2e_latency_s "
    "FROM students WHERE event_ts_ms > 0",
    "latency_percentiles": _with(SENDS, MODES)
    + "SELECT mode, count(*) AS samples, quantile_disc(v, 0.5) AS p50, quantile_disc(v, 0.99) AS p99 "
    "FROM modes GROUP BY mode",
    "latency_histogram": _with(
        SENDS, MODES, f"tops AS (SELECT mode, {_TOP.format('v')} AS bucket_top, count(*) AS rows FROM modes GROUP BY ALL)"
    )
    + "SELECT mode, bucket_top, rows, cast(sum(rows) OVER w AS bigint) AS rows_up_to, "
    "cast(sum(rows) OVER (PARTITION BY mode) AS bigint) AS total_rows, "
    "cast(sum(rows) OVER w AS double) / cast(sum(rows) OVER (PARTITION BY mode) AS double) AS share_up_to "
    "FROM tops WINDOW w AS (PARTITION BY mode ORDER BY bucket_top)",
    "run_summary": _with(SENDS, RUNS)
    + "SELECT target_rate, scale_factor, total_sent, total_errors, "
    f"round(total_time_s, 4) AS total_time_s, round({_RATE}, 4) AS avg_rate FROM runs",
    "latest_per_key": "SELECT user_id, event_id, hour, event_type, value FROM ("
    "SELECT *, epoch_us(ts) // 3600000000 AS hour FROM events) "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY hour DESC, event_id) = 1",
    "throughput_report": _with(*REPORTS)
    + "SELECT target_rate, CASE target_rate WHEN 0 THEN 'Burst Mode' ELSE target_rate || ' rec/s' END AS rate_label, "
    "round(avg_rate, 4) AS avg_rate, cast(trunc(avg_rate) AS int) AS shown_rate, "
    "trunc(avg_rate) = max(trunc(avg_rate)) OVER () AS is_max FROM ("
    "SELECT * FROM reports QUALIFY row_number() OVER "
    "(PARTITION BY target_rate ORDER BY reported_at DESC, file_name) = 1)",
    "minmax_scaled": _with(STUDENTS, ENRICHED, LABELLED, RANGES, SCALED)
    + f"SELECT event_seq, {_ROUNDED_FEATURES} FROM scaled",
    "classification_metrics": _with(
        STUDENTS,
        ENRICHED,
        "guessed AS (SELECT label, CASE WHEN pass_rate_1st_sem < 0.4 THEN 0 "
        "WHEN pass_rate_2nd_sem < 0.8 THEN 1 ELSE 2 END AS prediction FROM enriched WHERE label >= 0)",
        *_metrics("guessed"),
    )
    + "SELECT * FROM m",
    "nb_predictions": _with(*_BAYES) + "SELECT event_seq, label, prediction FROM predicted",
    "nb_metrics": _with(
        *_BAYES, "testset AS (SELECT * FROM predicted WHERE NOT is_train)", *_metrics("testset")
    )
    + "SELECT 'Naive Bayes' AS model, * FROM m",
    "metric_gate": _with(*_QUALITY) + "SELECT * FROM gated",
    "gate_verdict": _with(*_QUALITY)
    + "SELECT count(passed) AS judged, count(*) FILTER (passed) AS passed, "
    "coalesce(bool_and(passed), true) AS meets_all FROM gated",
    "system_gate": _with(
        *REPORTS,
        STUDENTS,
        "newest AS (SELECT * FROM reports ORDER BY reported_at DESC, file_name LIMIT 1)",
        "measured AS (SELECT 'throughput' AS metric, avg_rate AS value FROM newest "
        "UNION ALL SELECT 'p50_latency_ms', p50 / 1000 FROM newest "
        f"UNION ALL SELECT 'e2e_latency_s', avg({NOW_MS} - event_ts_ms) / 1000 FROM students WHERE event_ts_ms > 0)",
        _criteria(SYSTEM_CRITERIA),
        *GATED,
    )
    + "SELECT * FROM gated",
    "stream_ingest": _with(
        STUDENTS, RECEIVED, f"enriched AS (SELECT *, {_DERIVED} FROM received)"
    )
    + f"SELECT {_PERSISTED} FROM enriched",
    "stream_resume": _with(STUDENTS) + _stream_counts(),
    # After each run the counts of all runs so far.
    "stream_counts": _with(STUDENTS, f"runs AS ({_stream_counts()})")
    + "SELECT run, (sum(received) OVER (ORDER BY run))::bigint AS received, "
    "(sum(kept) OVER (ORDER BY run))::bigint AS kept, 0::bigint AS missing FROM runs",
    # Messages without an id cannot be told apart, so those that were sent again are there twice.
    "stream_once": _with(
        STUDENTS,
        f"received AS (SELECT {_RECORD}, event_seq AS sent_as FROM students WHERE NOT ({_BAD}))",
        "stored AS (SELECT * FROM received UNION ALL SELECT * FROM received WHERE event_id = '' AND sent_as % 3 = 0)",
        f"enriched AS (SELECT *, {_DERIVED} FROM stored)",
    )
    + f"SELECT {_PERSISTED}, event_id FROM enriched",
    "replay_delivery": _with(STUDENTS)
    + "SELECT i AS iteration, event_seq, i || '_' || event_seq AS event_id, target, admission_grade "
    "FROM students, (SELECT unnest([0::bigint, 1::bigint]) AS i)",
    "stream_delay": "WITH rows AS (SELECT event_id, epoch_us(ts) // 1000 AS t, event_id % 977 AS delay, "
    "event_id % 5 > 0 AND event_id % 3 > 0 AS early FROM events), "
    "judged AS (SELECT *, t // 86400000 * 86400000 AS w, NOT early AND t // 86400000 * 86400000 + 86400000 "
    f"+ {DELAY_LATENESS_MS} <= (SELECT max(t) FROM rows WHERE early) AS late FROM rows) "
    "SELECT w AS window_start_ms, count(*) FILTER (NOT late) AS stamped_rows, "
    "round(cast(sum(delay) FILTER (NOT late) AS double) / count(*) FILTER (NOT late) / 1000, 4) AS mean_delay_s, "
    "count(*) FILTER (late) AS late_rows FROM judged GROUP BY w",
}
# The same tables, reached on another way.
ORACLES["stream_histogram"] = ORACLES["latency_histogram"]
ORACLES["compacted_ingest"] = ORACLES["stream_ingest"]
ORACLES["stream_latest"] = ORACLES["latest_per_key"]
