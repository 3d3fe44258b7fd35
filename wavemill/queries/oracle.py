"""The registered queries in another engine's SQL, written independently of the DataFrame code.

Ranks are windows here where the jobs use aggregates, medians and distinct
counts are the engine's own. Shared relations are CTEs; a statement carries
those it uses.
"""

from __future__ import annotations

import re

from .. import config
from ..sources import adapter
from . import model


def _values(rows, columns: str) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        return str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


def _title(expr: str) -> str:
    return f"array_to_string([upper(left(w, 1)) || substr(w, 2) FOR w IN str_split(lower(trim({expr})), ' ')], ' ')"


def _status(c: str) -> str:
    names = ", ".join(f"'{config.STATUS_LABELS[i]}'" for i in range(1, 6))
    return f"coalesce(([{names}])[{c}], 'Missing')"


_SIZE_BAND = ("CASE WHEN hh_size > 9 THEN '10+' WHEN hh_size > 6 THEN '7-9' WHEN hh_size > 3 THEN '4-6' "
              "WHEN hh_size IS NOT NULL THEN '1-3' ELSE 'Unknown' END")
_DECADE = "10 * ((head_age - 15) // 10)"
_AGE_BAND = (f"CASE WHEN head_age BETWEEN 65 AND 100 THEN '65+' WHEN head_age BETWEEN 15 AND 64 "
             f"THEN ({_DECADE} + 15) || '-' || ({_DECADE} + 24) ELSE 'Unknown' END")
_GEO = "md5(lower(trim(district) || '|' || trim(village)))"
_DAY = "CAST(replace(left(CAST(submitted_at AS VARCHAR), 10), '-', '') AS INTEGER)"
_SUBMISSION = ("survey_cycle, cycle_order, submission_key, household_id, submitted_at, interview_status, "
               "consent, interview_duration_sec, district, subcounty, parish, village, gps_lat")
_SOURCES = {"baseline": "baseline", "year1": "year2", "year2": "year2"}


def _export_columns() -> list[tuple[str, str]]:
    """(export header, expression over subs) whose distinct values and NULLs equal the text column's."""
    raw = {"household_id": "household_id_raw", "household_id_confirm": "household_confirm_raw"}
    own = [(headers[0], raw.get(name, name)) for name, _, headers in config.VARIABLE_SPEC]
    return own + [(n, e.replace("o_orderkey", "source_row")) for n, e in model.EXTRA_COLUMNS.items()]


def _row_hash() -> str:
    parts = ", ".join(f"CASE WHEN {e} IS NULL THEN '-' ELSE length({e}) || ':' || {e} END"
                      for _, e in adapter.hashed_columns())
    return f"md5(array_to_string([{parts}], ','))"


def _cells() -> str:
    """(survey_cycle, variable, value) of every export cell, from one scan."""
    pairs = ", ".join(f"{{'variable': '{header}', 'value': CAST(({expr}) AS VARCHAR)}}"
                      for header, expr in _export_columns())
    return f"SELECT survey_cycle, unnest([{pairs}], recursive := true) FROM subs"


_PROFILE = ("SELECT survey_cycle, variable, round(count(*) FILTER (WHERE value IS NULL) / count(*), 4) AS null_rate, "
            "count(DISTINCT value) AS n_distinct, count(value) = 0 AS all_null FROM cells GROUP BY survey_cycle, variable")


def _decoded(alias: str, field: str, code: str) -> str:
    return (f"(SELECT min(l.label) FROM lists l WHERE l.survey_cycle = {alias}.survey_cycle "
            f"AND l.field = '{field}' AND l.code = CAST({alias}.{code} AS VARCHAR))")


def _labels(alias: str) -> str:
    out = []
    for field, code, name, default in config.DECODED_FIELDS:
        d = _decoded(alias, field, code)
        out.append(f"coalesce({d}, '{default}') AS {name}" if default else f"{d} AS {name}")
    return ", ".join(out)


_SPEC_ROWS = [(n, d, config.VARIABLE_NOTES.get(n)) for n, d, _ in config.VARIABLE_SPEC]
_CANDIDATES = [(n, i, c) for n, _, names in config.VARIABLE_SPEC for i, c in enumerate(names)]
_KEY = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"
_SUFFIX = "'^(.+?)_?([0-9]+)$'"
_INCOMES = "+".join(f"coalesce({p}, 0)" for p in config.INCOME_PARTS)
_CODES = "('baseline'), ('year1'), ('year2')"
# Relations that a statement reaches several times over.
_SHARED = {"subs", "profile", "collected", "kept", "fact", "lists"}


def _ctes() -> dict[str, str]:
    c: dict[str, str] = {}
    c["base"] = adapter.ansi_select()
    c["subs"] = ("SELECT *, upper(regexp_replace(household_id_raw, '\\s+', '', 'g')) AS household_id, "
                 "upper(regexp_replace(household_confirm_raw, '\\s+', '', 'g')) AS household_id_confirm, "
                 "epoch_us(ended_at - started_at) / 60e6 AS interview_minutes, "
                 f"{_row_hash()} AS row_hash FROM base")
    c["early"] = ("SELECT *, CASE WHEN submission_key IS NULL THEN 'empty_row' WHEN household_id IS NULL "
                  "THEN 'missing_household_id' WHEN row_number() OVER (PARTITION BY survey_cycle, submission_key "
                  "ORDER BY source_row) > 1 THEN 'duplicate_submission_key' END AS early_reason FROM subs")
    c["flagged"] = ("SELECT *, coalesce(interview_status = 1, FALSE) AS is_completed, "
                    "coalesce(interview_status = 1, FALSE) AND coalesce(consent = 1, FALSE) AS is_consented "
                    "FROM early WHERE early_reason IS NULL")
    c["ranked"] = ("SELECT *, count(*) OVER (PARTITION BY survey_cycle, household_id) AS household_submissions, "
                   "row_number() OVER (PARTITION BY survey_cycle, household_id ORDER BY submitted_at DESC NULLS LAST, "
                   "is_consented DESC, is_completed DESC, submission_key) AS place FROM flagged")
    c["kept"] = "SELECT * FROM ranked WHERE place = 1"
    c["alls"] = (f"SELECT {_SUBMISSION}, TRUE AS is_kept, CAST(NULL AS VARCHAR) AS reject_reason FROM kept "
                 f"UNION ALL SELECT {_SUBMISSION}, FALSE, 'superseded_duplicate' FROM ranked WHERE place > 1 "
                 f"UNION ALL SELECT {_SUBMISSION}, FALSE, early_reason FROM early WHERE early_reason <> 'empty_row'")
    c["cycles"] = _values([(x.code, x.order, x.label, x.export, x.form, x.choice_source) for x in config.CYCLES],
                          "survey_cycle, cycle_order, cycle_label, source_file, form_file, choice_list_cycle")
    c["regions"] = ("SELECT n_name AS district, 'R' || r_regionkey AS region_code, r_name AS region_name, "
                    "'Sub ' || (n_nationkey % 3) AS sub_region FROM nation JOIN region ON n_regionkey = r_regionkey "
                    "WHERE n_nationkey < 24")
    c["span"] = "SELECT date_trunc('day', min(submitted_at)) AS lo, date_trunc('day', max(submitted_at)) AS hi FROM alls"
    c["calendar"] = (
        "SELECT CAST(date_part('year', d) * 10000 + date_part('month', d) * 100 + date_part('day', d) AS INTEGER) "
        "AS date_key, d AS date, CAST(date_part('year', d) AS INTEGER) AS year, "
        "CAST(ceil(date_part('month', d) / 3) AS INTEGER) AS quarter, CAST(date_part('month', d) AS INTEGER) AS month, "
        "strftime(d, '%B') AS month_name, left(CAST(d AS VARCHAR), 7) AS year_month, "
        "CAST(date_part('week', d) AS INTEGER) AS iso_week, CAST((dayofweek(d) + 6) % 7 + 1 AS INTEGER) AS day_of_week, "
        "strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend "
        "FROM (SELECT CAST(unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM span)")
    c["places"] = f"SELECT {_GEO} AS geo_key, * FROM kept"
    c["history"] = "SELECT geo_key, survey_cycle, district, subcounty, parish, cluster, village FROM places GROUP BY ALL"
    latest = ", ".join(
        f"last({_title(n)} ORDER BY cycle_order, submitted_at, submission_key) FILTER (WHERE {n} IS NOT NULL) AS {n}"
        for n in ("district", "subcounty", "parish", "cluster", "village"))
    c["geo0"] = (f"SELECT geo_key, {latest}, len(list_distinct(list(survey_cycle))) AS cycles_seen, "
                 f"len(list_distinct(list(lower(parish)))) AS parish_spellings_seen FROM places GROUP BY geo_key")
    c["geography"] = ("SELECT g.geo_key, r.region_code, r.region_name, r.sub_region, g.district, g.subcounty, g.parish, "
                      "g.cluster, g.village, g.cycles_seen, g.parish_spellings_seen FROM geo0 g "
                      "LEFT JOIN regions r ON lower(r.district) = lower(g.district)")
    c["panels"] = ("SELECT household_id, list(survey_cycle ORDER BY cycle_order) AS seen, min(cycle_order) AS first_seen, "
                   "first(wealth_quartile ORDER BY cycle_order) FILTER (WHERE wealth_quartile IS NOT NULL) AS quartile, "
                   "first(head_sex ORDER BY cycle_order) FILTER (WHERE head_sex IS NOT NULL) AS sex, "
                   "max(cohort) AS cohort, list_distinct(list(district)) AS districts FROM kept GROUP BY household_id")
    c["households"] = (
        "SELECT household_id, first_seen AS first_cycle_order, CAST(len(seen) AS BIGINT) AS n_cycles, "
        "array_to_string(seen, ' + ') AS cycle_pattern, len(seen) = 3 AS in_balanced_panel, "
        "list_contains(seen, 'baseline') AS has_baseline, quartile AS first_wealth_quartile, "
        "ifnull(cohort, '2021') AS cohort, sex AS head_sex_first_seen, len(districts) > 1 AS moved_district FROM panels")
    c["choices"] = (_values(adapter.CHOICES, "survey_cycle, field, code, label")
                    + " UNION ALL SELECT s, 'district', CAST(n_nationkey + 1 AS VARCHAR), n_name FROM nation, "
                      "(VALUES ('baseline'), ('year2')) AS x(s)")
    c["label_map"] = _values(adapter.LABEL_MAP, "field, raw_label, conformed_label")
    clean = "trim(regexp_replace({0}, '[\\[\\]]', '', 'g'))"
    c["conformed"] = (f"SELECT c.survey_cycle, c.field, c.code, coalesce(m.conformed_label, {clean.format('c.label')}) "
                      f"AS label FROM choices c LEFT JOIN label_map m ON m.field = c.field "
                      f"AND m.raw_label = {clean.format('c.label')}")
    c["lists"] = ("SELECT s.survey_cycle, c.field, c.code, c.label FROM conformed c JOIN ("
                  + _values(list(_SOURCES.items()), "survey_cycle, choice_cycle")
                  + ") s ON s.choice_cycle = c.survey_cycle")
    not_in_fact = {"household_id", "household_id_confirm", "district_code", "district", "subcounty", "parish", "cluster",
                   "village", "cohort", "interview_duration_sec"}
    carried = ", ".join(n for n, _, _ in config.VARIABLE_SPEC if n not in not_in_fact)
    c["fact"] = (
        f"SELECT household_id, survey_cycle, cycle_order, geo_key, {_DAY} AS date_key, household_submissions, row_hash, "
        f"is_completed, is_consented, {carried}, {_status('interview_status')} AS interview_status_label, "
        f"interview_minutes AS wall_clock_minutes, interview_duration_sec / CAST(60 AS DOUBLE) AS interview_duration_min, "
        f"{_SIZE_BAND} AS hh_size_band, {_AGE_BAND} AS head_age_band, "
        f"hhip_usd_day < {config.ULTRA_POOR_USD_DAY} AS is_ultra_poor, "
        f"NOT hhip_usd_day < {config.TARGET_USD_DAY} AS meets_target, "
        f"CASE WHEN hh_size <> 0 THEN hhip_usd_day / hh_size END AS hhip_usd_day_per_capita, {_labels('p')} FROM places p")
    c["ops0"] = (
        f"SELECT survey_cycle, cycle_order, {_DAY} AS date_key, CAST(submitted_at AS DATE) AS submission_date, "
        f"ifnull({_title('district')}, 'Missing') AS district, {_status('interview_status')} AS interview_status_label, "
        "is_kept, ifnull(reject_reason, '') AS why, interview_duration_sec AS sec, "
        "NOT (district || subcounty || parish || village) IS NOT NULL AS unplaced FROM alls")
    c["ops"] = (
        "SELECT survey_cycle, cycle_order, date_key, submission_date, district, interview_status_label, "
        "count(*) AS submissions_raw, CAST(count_if(is_kept) AS BIGINT) AS submissions_deduplicated, "
        "CAST(count_if(why LIKE 'superseded%') AS BIGINT) AS submissions_superseded, "
        "CAST(count_if(NOT is_kept AND why NOT LIKE 'superseded%') AS BIGINT) AS submissions_rejected, "
        "CAST(count_if(unplaced) AS BIGINT) AS submissions_missing_location, "
        "sum(sec) / CAST(60 AS DOUBLE) AS interview_minutes_sum, count(sec) AS interview_minutes_n "
        "FROM ops0 GROUP BY 1, 2, 3, 4, 5, 6")
    # Straight from the submissions, not from the daily table.
    c["opc1"] = (
        "SELECT survey_cycle, cycle_order, count(*) AS raw, CAST(count_if(is_kept) AS BIGINT) AS kept, "
        "CAST(count_if(why LIKE 'superseded%') AS BIGINT) AS superseded, "
        "CAST(count_if(NOT is_kept AND why NOT LIKE 'superseded%') AS BIGINT) AS rejected, "
        "CAST(count_if(unplaced) AS BIGINT) AS unplaced, avg(sec) / 60 AS mean_minutes FROM ops0 GROUP BY 1, 2")
    c["opc2"] = ("SELECT survey_cycle, count(*) AS households, CAST(count_if(household_submissions > 1) AS BIGINT) AS doubled, "
                 "quantile_cont(interview_duration_sec, 0.5) / 60 AS middle FROM kept GROUP BY 1")
    c["opc3"] = ("SELECT survey_cycle, count_if(gps_lat IS NULL) / count(*) AS rate FROM alls "
                 "WHERE survey_cycle = 'baseline' GROUP BY 1")
    c["opc"] = (
        "SELECT survey_cycle, cycle_order, raw AS submissions_raw, kept AS submissions_deduplicated, "
        "superseded AS submissions_superseded, rejected AS submissions_rejected, 1 - kept / raw AS dedup_reduction_rate, "
        "doubled AS households_with_duplicates, doubled / households AS duplicate_household_rate, "
        "unplaced / raw AS missing_location_rate, rate AS missing_gps_rate, round(mean_minutes, 9) AS avg_interview_minutes, "
        "round(middle, 9) AS median_interview_minutes FROM opc1 NATURAL JOIN opc2 LEFT JOIN opc3 USING (survey_cycle)")
    c["summary0"] = (
        "SELECT f.survey_cycle, f.cycle_order, g.region_name, g.district, t.year_month, f.is_completed AS done, "
        "f.is_consented AS agreed, CASE WHEN f.is_consented THEN f.hhip_usd_day END AS hhip "
        "FROM calendar t, geography g, fact f WHERE f.geo_key = g.geo_key AND f.date_key = t.date_key")
    c["summary"] = (
        "SELECT survey_cycle, cycle_order, region_name, district, year_month, count(*) AS households_attempted, "
        "CAST(count_if(done) AS BIGINT) AS households_completed, CAST(count_if(agreed) AS BIGINT) AS households_consented, "
        "count_if(done) / count(*) AS completion_rate, "
        "CASE WHEN count_if(done) > 0 THEN count_if(agreed) / count_if(done) END AS consent_rate, "
        "round(quantile_cont(hhip, 0.5), 9) AS median_hhip_usd_day, "
        f"CASE WHEN count(hhip) > 0 THEN count_if(hhip >= {config.TARGET_USD_DAY}) / count(hhip) END "
        "AS share_meeting_target FROM summary0 GROUP BY 1, 2, 3, 4, 5")
    # Straight from the rows behind the summary.
    c["program0"] = ("SELECT survey_cycle, cycle_order, count(*) AS households_attempted, "
                     "CAST(count_if(done) AS BIGINT) AS households_completed, "
                     "CAST(count_if(agreed) AS BIGINT) AS households_consented FROM summary0 GROUP BY 1, 2")
    c["program1"] = ("SELECT *, households_completed / households_attempted AS completion_rate, "
                     "households_consented / households_completed AS consent_rate FROM program0")
    c["agreed"] = (
        "SELECT survey_cycle, cycle_order, geography.district, unnest(['Head of household age', 'Head of household sex', "
        "'Household size', 'Respondent']) AS dimension, unnest([head_age_band, head_sex_label, hh_size_band, "
        "respondent_label]) AS category FROM fact, geography WHERE fact.geo_key = geography.geo_key AND is_consented")
    c["demographics"] = ("SELECT survey_cycle, cycle_order, district, dimension, category, count(*) AS households "
                         "FROM agreed GROUP BY 1, 2, 3, 4, 5")
    c["coverage"] = "SELECT n_cycles, cycle_pattern, count(household_id) AS households FROM households GROUP BY 1, 2"
    c["panel"] = (
        "SELECT survey_cycle, cycle_order, geography.district, count(*) AS households, "
        "round(quantile_cont(hhip_usd_day, 0.5), 9) AS median_hhip_usd_day, "
        f"count_if(hhip_usd_day >= {config.TARGET_USD_DAY}) / nullif(count(hhip_usd_day), 0) AS share_meeting_target, "
        f"count_if(hhip_usd_day < {config.ULTRA_POOR_USD_DAY}) / nullif(count(hhip_usd_day), 0) AS share_ultra_poor "
        "FROM fact, geography WHERE fact.geo_key = geography.geo_key AND is_consented AND household_id IN "
        "(SELECT household_id FROM panels WHERE len(seen) = 3) GROUP BY 1, 2, 3")
    c["bronze"] = "SELECT * FROM subs UNION ALL SELECT * FROM subs WHERE source_row % 7 = 0"
    c["cells"] = _cells()
    c["profile"] = _PROFILE
    c["collected"] = "SELECT * FROM profile WHERE NOT all_null"
    c["form_fields"] = ("SELECT s AS survey_cycle, f.* FROM (VALUES " + _CODES + ") AS x(s), ("
                        + _values(model.FORM_FIELDS, "field, section, label, n_choices") + ") AS f")
    system = ", ".join(f"'{x}'" for x in config.SYSTEM_COLUMNS)
    classified = (
        "SELECT p.*, CASE WHEN p.variable IN (" + system + ") THEN 'system' "
        "WHEN f.n_choices > 0 THEN 'select_question' WHEN f.field IS NOT NULL THEN 'question' "
        "WHEN b.n_choices > 0 THEN 'select_multiple_option' WHEN b.field IS NOT NULL THEN 'repeat_instance' "
        "WHEN regexp_matches(p.variable, '\\((USD|Ugx|UGX)|USD_|Ugx|PPI Score|^Quartile$|/Day', 'i') "
        "THEN 'derived_metric' ELSE 'unclassified' END AS kind, f.field AS own_field, f.section AS own_section, "
        "f.label AS own_label, b.field AS base_field, b.section AS base_section, b.label AS base_label "
        "FROM {0} p LEFT JOIN form_fields f ON f.survey_cycle = p.survey_cycle AND f.field = p.variable "
        "LEFT JOIN form_fields b ON b.survey_cycle = p.survey_cycle AND b.field = "
        f"nullif(regexp_extract(p.variable, {_SUFFIX}, 1), '')")
    c["classified"] = classified.format("collected")
    c["classified_all"] = classified.format("profile")
    by_base = "kind IN ('select_multiple_option', 'repeat_instance')"
    c["variables"] = (
        f"SELECT survey_cycle, variable, kind, CASE WHEN {by_base} THEN base_field ELSE own_field END AS form_field, "
        f"CASE WHEN {by_base} THEN base_section ELSE own_section END AS section, "
        f"CASE WHEN {by_base} THEN base_label ELSE own_label END AS label, null_rate, n_distinct, all_null "
        "FROM classified")
    c["presence"] = ("SELECT variable, bool_or(survey_cycle = 'baseline') AS in_baseline, "
                     "bool_or(survey_cycle = 'year1') AS in_year1, bool_or(survey_cycle = 'year2') AS in_year2 "
                     "FROM collected GROUP BY variable")
    spelled = ("CASE survey_cycle WHEN 'year1' THEN upper(variable) WHEN 'baseline' THEN replace(variable, ' ', '') "
               "ELSE variable END")
    c["headers"] = (f"SELECT survey_cycle, {spelled} AS header, 1 AS position FROM collected UNION ALL "
                    f"SELECT survey_cycle, '_' || {spelled}, length(variable) % 3 FROM collected")
    c["spec"] = _values(_SPEC_ROWS, "canonical_name, dtype, notes")
    c["candidates"] = _values(_CANDIDATES, "canonical_name, pos, candidate")
    c["hits"] = (f"SELECT c.canonical_name, h.survey_cycle, h.header, c.candidate = h.header AS exact, "
                 f"row_number() OVER (PARTITION BY c.canonical_name, h.survey_cycle "
                 f"ORDER BY c.candidate = h.header DESC, c.pos, h.position, h.header) AS place FROM candidates c JOIN headers h "
                 f"ON {_KEY.format('c.candidate')} = {_KEY.format('h.header')}")
    c["resolved"] = ("SELECT s.canonical_name, x.s AS survey_cycle, coalesce(h.header, '') AS source, "
                     "CASE WHEN h.header IS NULL THEN 'missing' WHEN h.exact THEN 'exact' ELSE 'fuzzy' END AS \"match\" "
                     "FROM spec s CROSS JOIN (VALUES " + _CODES + ") AS x(s) LEFT JOIN hits h "
                     "ON h.canonical_name = s.canonical_name AND h.survey_cycle = x.s AND h.place = 1")
    c["part_choices"] = (
        "SELECT CAST(p_partkey % 3 AS INTEGER) AS cycle_order, CASE p_partkey % 3 WHEN 0 THEN 'baseline' "
        "WHEN 1 THEN 'year1' ELSE 'year2' END AS survey_cycle, p_brand AS field, CAST(p_size AS VARCHAR) AS code, "
        "raw_label, " + clean.format("raw_label") + " AS label, p_partkey AS position FROM (SELECT *, "
        "CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN '[' || p_name || '] ' "
        "WHEN 2 THEN replace(p_name, ' ', '-') ELSE p_name END AS raw_label FROM part)")
    c["spelled"] = f"SELECT *, {_KEY.format('label')} AS key FROM part_choices"
    c["automatic"] = (
        "SELECT DISTINCT field, label AS raw_label, conformed_label FROM (SELECT field, label, "
        "first_value(label) OVER (PARTITION BY field, key ORDER BY cycle_order DESC, position DESC) AS conformed_label "
        "FROM spelled) WHERE label <> conformed_label")
    c["confirmed"] = _values([("Brand#1", "red widget", "Widget (red)"), ("Brand#2", "SMALL RING", "Ring, small")],
                             "field, raw_label, conformed_label")
    c["conform"] = ("SELECT * FROM confirmed UNION ALL SELECT a.* FROM automatic a ANTI JOIN confirmed c "
                    "ON c.field = a.field AND c.raw_label = a.raw_label")
    c["finals"] = ("SELECT p.*, coalesce(c.conformed_label, p.label) AS final FROM part_choices p LEFT JOIN conform c "
                   "ON c.field = p.field AND c.raw_label = p.label")
    c["checks"] = _checks()
    c["dq"] = ('SELECT "check", severity, CAST(failed AS BIGINT) AS failed, CAST(total AS BIGINT) AS total, detail, '
               "round(100 * failed / nullif(total, 0), 2) AS fail_pct, failed = 0 AS passed FROM checks")
    return c


# check -> (severity, relation, which rows count, which of them fail)
_MODEL_CHECKS = {
    "household_id_format": ("warn", "fact", None,
                            f"NOT regexp_full_match(household_id, '{config.HOUSEHOLD_ID_LAYOUT[1:-1]}')"),
    "hh_size_in_range": ("warn", "fact", None, "ifnull(hh_size, 0) < 1 OR hh_size > 30"),
    "hhip_not_null": ("error", "fact", "is_consented", "hhip_usd_day IS NULL"),
    "hhip_plausible_range": ("warn", "fact", None, "NOT hhip_usd_day BETWEEN 0 AND 50"),
    "hhip_daily_reconciles_with_annual": (
        "warn", "fact", "hhip_usd_year IS NOT NULL",
        "abs(hhip_usd_year - 365 * hhip_usd_day) > CAST(0.01 AS DOUBLE) * greatest(1, hhip_usd_year)"),
    "income_components_le_total_income": (
        "warn", "fact", None, f"hh_income_usd_year * CAST(1.01 AS DOUBLE) + 1 < {_INCOMES}"),
    "village_maps_to_one_parish_within_cycle": (
        "warn", "(SELECT count(DISTINCT lower(parish)) AS n FROM history GROUP BY survey_cycle, geo_key)", None, "n >= 2"),
    "villages_with_parish_spelling_change_across_cycles": ("info", "geography", None, "parish_spellings_seen >= 2"),
    "fact_rows_without_geography": (
        "error", "fact", None, "geo_key IS NULL OR geo_key NOT IN (SELECT geo_key FROM geography WHERE geo_key IS NOT NULL)"),
    "interview_duration_plausible_10min_6h": (
        "warn", "fact", "is_completed", "NOT interview_duration_min BETWEEN 10 AND 360"),
    "wall_clock_start_to_end_over_6h": ("info", "fact", None, "wall_clock_minutes / 60 > 6"),
    "head_age_plausible_15_100": ("warn", "fact", "is_consented", "ifnull(head_age, 0) < 15 OR head_age > 100"),
    "completed_interview_has_consent_answer": ("warn", "fact", "is_completed", "consent IS NULL"),
    "fact_dates_covered_by_dim_time": ("error", "fact", None, "date_key NOT IN (SELECT date_key FROM calendar)"),
    "geography_has_region": ("error", "geography", None, "region_code IS NULL"),
    "household_id_needed_normalisation": ("info", "kept", None, "household_id != household_id_raw"),
    "submitted_after_started": ("warn", "kept", None, "started_at - submitted_at > INTERVAL 24 HOUR"),
    "district_code_decodes_to_preloaded_label": (
        "warn", "(SELECT survey_cycle, district_code, district FROM kept GROUP BY ALL) AS t", None,
        f"lower(t.district) != ifnull(lower({_decoded('t', 'district', 'district_code')}), '?')"),
    "households_changed_district": ("info", "households", None, "moved_district"),
    "baseline_households_missing_a_follow_up_cycle": ("info", "households", "has_baseline", "n_cycles < 3"),
}


def _checks() -> str:
    def n(cond):
        return f"count(CASE WHEN {cond} THEN 1 END)"

    out = ["SELECT 'grain_unique_household_cycle' AS \"check\", 'error' AS severity, ifnull(sum(n - 1), 0) AS failed, "
           "ifnull(sum(n), 0) AS total, '' AS detail FROM (SELECT count(*) AS n FROM fact GROUP BY household_id, survey_cycle)"]
    for name, (severity, relation, scope, failing) in _MODEL_CHECKS.items():
        where = f" WHERE {scope}" if scope else ""
        out.append(f"SELECT '{name}', '{severity}', {n(failing)}, count(*), '' FROM {relation}{where}")

    def per_cycle(name, severity, failed, total, source, detail="''"):
        return (f"SELECT survey_cycle || ': {name}', '{severity}', {failed}, {total}, {detail} "
                f"FROM {source} GROUP BY survey_cycle")

    # Year 1 writes its codes with a trailing '.0'.
    every = ", ".join(f"({expr})" for _, expr in _export_columns())
    formats = " ".join(f"WHEN '{c.code}' THEN '{' / '.join(c.formats)}'" for c in config.CYCLES)
    code = "CASE WHEN survey_cycle = 'year1' THEN district_code || '.0' ELSE CAST(district_code AS VARCHAR) END"
    repeated = ("(SELECT survey_cycle, variable AS header FROM collected UNION ALL SELECT survey_cycle, "
                "variable || '.1' FROM collected WHERE variable LIKE '%(Ugx)')")
    out += [
        per_cycle("identical rows in export (same row hash)", "info",
                  f"count(*) - count(DISTINCT ({every}))", "count(*)", "bronze"),
        per_cycle("hhid_2 equals hhid_2_again", "warn",
                  n("ifnull(household_id_raw, '') != ifnull(household_confirm_raw, '')"), "count(*)", "bronze"),
        per_cycle("SubmissionDate parses with known formats", "error", "0", "count(*)", "bronze",
                  f"CASE survey_cycle {formats} END"),
        per_cycle("district code maps to one label", "warn", n("labels > 1"), n("labels > 0"),
                  f"(SELECT survey_cycle, {code} AS code, count(DISTINCT district) AS labels, "
                  f"arg_min(district, source_row) AS label FROM subs WHERE district_code IS NOT NULL GROUP BY ALL)",
                  "string_agg(code || '=' || coalesce(label, ''), '; ' ORDER BY code)"),
        per_cycle("duplicate headers in export (numbered suffix)", "info", n("header LIKE '%.1'"), "count(*)", repeated,
                  "array_to_string((list_sort(list(header) FILTER (WHERE header LIKE '%.1'))), ', ')"),
    ]
    return " UNION ALL ".join(out)


def _queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["parse_timestamps"] = (
        "SELECT source_row, CASE WHEN source_row % 10 <> 0 THEN started_at WHEN survey_cycle = 'year2' "
        "THEN TIMESTAMP '2020-06-30 10:00:00' END AS parsed FROM subs")
    k = "CAST(o_orderkey AS DOUBLE)"
    q["cast_numeric"] = (f"SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN {k} WHEN 1 THEN {k} "
                         f"WHEN 2 THEN {k} + CAST(0.5 AS DOUBLE) WHEN 5 THEN {k} WHEN 7 THEN -{k} * 10 END AS number "
                         "FROM orders")
    q["cast_integral"] = ("SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN o_orderkey WHEN 1 THEN o_orderkey "
                          "WHEN 5 THEN o_orderkey WHEN 7 THEN -o_orderkey * 10 END AS number FROM orders")
    q["normalize_household_id"] = "SELECT source_row, household_id FROM subs"
    off = ("cohort", "gps_lat", "gps_lon", "cluster")
    names = [f"CASE WHEN survey_cycle <> 'year1' THEN {n} END AS {n}" if n in off
             else "trim(district) AS district" if n == "district" else n
             for n, _, _ in config.VARIABLE_SPEC]
    q["harmonize_contract"] = (f"SELECT survey_cycle, cycle_order, source_row, interview_minutes, {', '.join(names)} FROM "
                               "(SELECT * FROM subs)")
    q["geo_key"] = f"SELECT source_row, {_GEO} AS geo_key FROM subs"
    title = _title("'  ' || p_type || '  o''' || p_name || '-' || lower(p_brand) || ' '")
    q["title_case"] = f"SELECT p_partkey, {title} AS title FROM part"
    q["status_labels"] = f"SELECT source_row, {_status('interview_status')} AS interview_status_label FROM subs"
    q["demographic_bands"] = (f"SELECT source_row, {_SIZE_BAND} AS hh_size_band, {_AGE_BAND} AS head_age_band FROM subs")
    q["label_keys"] = "SELECT position, label, key AS label_key FROM spelled"
    q["quarantine_reasons"] = (
        "SELECT survey_cycle, source_row, is_completed, is_consented, household_submissions, "
        "CASE WHEN place > 1 THEN 'superseded_duplicate' END AS reject_reason FROM ranked UNION ALL "
        "SELECT survey_cycle, source_row, NULL, NULL, NULL, early_reason FROM early WHERE early_reason IS NOT NULL")
    q["incremental_silver"] = q["quarantine_reasons"]  # however the rows arrive
    q["duplicate_keys"] = (
        "SELECT survey_cycle, source_row, submission_key FROM (SELECT *, row_number() OVER (PARTITION BY survey_cycle, "
        "submission_key ORDER BY source_row) AS n FROM subs WHERE submission_key IS NOT NULL) WHERE n > 1")
    q["dedupe_latest"] = ("SELECT survey_cycle, source_row, household_id, submission_key, submitted_at, is_completed, "
                          "is_consented, household_submissions FROM kept")
    q["household_submissions"] = "SELECT survey_cycle, household_id, household_submissions FROM kept"
    q["all_submissions"] = "SELECT * FROM alls"
    q["row_reconciliation"] = (
        "SELECT s.survey_cycle, s.bronze_rows, k.kept_rows, s.bronze_rows - k.kept_rows AS quarantined_rows, "
        "CAST(0 AS BIGINT) AS unaccounted FROM (SELECT survey_cycle, count(*) AS bronze_rows FROM subs GROUP BY 1) s "
        "JOIN (SELECT survey_cycle, count(*) AS kept_rows FROM kept GROUP BY 1) k USING (survey_cycle)")
    q["operations_reconciliation"] = (
        "SELECT survey_cycle, count(*) AS bronze_rows, CAST(count_if(submission_key IS NULL) AS BIGINT) AS empty_rows, "
        "CAST(count_if(submission_key IS NOT NULL) AS BIGINT) AS reported, CAST(0 AS BIGINT) AS unaccounted "
        "FROM subs GROUP BY survey_cycle")
    q["quarantine_summary"] = (
        "SELECT survey_cycle, reject_reason, count(*) AS \"rows\" FROM (SELECT survey_cycle, early_reason AS reject_reason "
        "FROM early WHERE early_reason IS NOT NULL UNION ALL SELECT survey_cycle, 'superseded_duplicate' FROM ranked "
        "WHERE place > 1) GROUP BY ALL")
    overlap = ("SELECT '{0}' AS id_form, count(*) AS in_all_cycles FROM (SELECT {1} FROM subs WHERE {1} IS NOT NULL "
               "GROUP BY 1 HAVING count(DISTINCT survey_cycle) = 3)")
    q["panel_overlap"] = (overlap.format("raw", "household_id_raw") + " UNION ALL "
                          + overlap.format("normalised", "household_id"))
    q["profile_ids"] = (
        "SELECT survey_cycle, count(*) AS \"rows\", count(*) FILTER (WHERE household_id_raw IS NULL) AS null_ids, "
        "count(DISTINCT household_id_raw) AS unique_ids, count(*) FILTER (WHERE n > 1) AS rows_with_repeated_id, "
        "count(*) FILTER (WHERE nth > 1) AS surplus_rows FROM (SELECT *, count(*) OVER (PARTITION BY survey_cycle, "
        "household_id_raw) AS n, row_number() OVER (PARTITION BY survey_cycle, household_id_raw ORDER BY source_row) AS nth "
        "FROM subs) GROUP BY survey_cycle")
    seeded = " UNION ALL ".join(
        f"SELECT DISTINCT survey_cycle, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM subs WHERE {c} IS NOT NULL"
        for c in ("household_id_raw", "district", "district_code"))
    q["sample_values"] = (
        "SELECT survey_cycle, \"column\", CAST(nth AS INTEGER) AS nth, value FROM (SELECT *, row_number() OVER (PARTITION BY "
        f"survey_cycle, \"column\" ORDER BY md5('1|' || value), value) AS nth FROM ({seeded})) WHERE nth <= 3")
    q["district_crosstab"] = (
        "SELECT district_code, upper(trim(district)) AS district, count(*) AS n FROM subs "
        "WHERE district_code IS NOT NULL AND district IS NOT NULL GROUP BY ALL")
    q["dim_survey_cycle"] = (
        "SELECT c.*, CAST(year(min(s.submitted_at)) AS INTEGER) AS survey_year, CAST(min(s.submitted_at) AS DATE) "
        "AS fieldwork_start, CAST(max(s.submitted_at) AS DATE) AS fieldwork_end FROM cycles c LEFT JOIN "
        "(SELECT survey_cycle, submitted_at FROM alls) s USING (survey_cycle) GROUP BY ALL")
    q["dim_time"] = "SELECT * FROM calendar"
    q["geography_name_history"] = "SELECT * FROM history"
    q["dim_geography"] = "SELECT * FROM geography"
    q["dim_household"] = "SELECT * FROM households"
    q["choice_conformed"] = (
        "SELECT p.survey_cycle, p.field, p.code, p.raw_label, coalesce(c.conformed_label, p.label) AS label "
        "FROM part_choices p LEFT JOIN conform c ON c.field = p.field AND c.raw_label = p.label")
    q["choice_decode"] = f"SELECT s.source_row, {_labels('s')} FROM subs s"
    q["sql_functions"] = (
        f"SELECT s.source_row, {_title('s.district')} AS district, md5(lower(trim(s.district)) || '|' || "
        f"lower(trim(s.village))) AS geo_key, {_labels('s')} FROM subs s")
    q["fct_survey_submissions"] = "SELECT * FROM fact"
    q["rpt_field_operations"] = "SELECT * FROM ops"
    q["rpt_field_operations_cycle"] = "SELECT * FROM opc"
    q["rpt_program_summary"] = "SELECT * FROM summary"
    q["rpt_program_cycle"] = (
        "SELECT *, completion_rate - first_value(completion_rate) OVER (ORDER BY cycle_order) "
        "AS completion_rate_change_vs_baseline, consent_rate - first_value(consent_rate) OVER (ORDER BY cycle_order) "
        "AS consent_rate_change_vs_baseline FROM program1")
    q["rpt_program_demographics"] = "SELECT * FROM demographics"
    q["rpt_cohort_coverage"] = "SELECT * FROM coverage"
    q["rpt_panel_poverty"] = "SELECT * FROM panel"
    q["income_median"] = (
        "SELECT survey_cycle, interview_status, round(median(hh_income_usd_year), 9) AS median_income FROM subs "
        "WHERE hh_income_usd_year IS NOT NULL GROUP BY survey_cycle, interview_status")
    q["filtered_field_ops"] = (
        "SELECT * FROM ops WHERE survey_cycle IN ('baseline', 'year2') AND (district IN "
        "('Nation_1', 'Nation_2', 'Nation_20') OR district = 'Missing')")
    q["daily_submissions"] = (
        "SELECT survey_cycle, submission_date, district, CAST(sum(submissions_raw) AS BIGINT) AS submissions_raw "
        "FROM ops GROUP BY ALL")
    q["ops_headline"] = (
        "SELECT CAST(sum(submissions_raw) AS BIGINT) AS submissions_raw, CAST(sum(submissions_deduplicated) AS BIGINT) "
        "AS submissions_deduplicated, CAST(sum(submissions_superseded) AS BIGINT) AS submissions_superseded, "
        "sum(submissions_missing_location) / sum(submissions_raw) AS missing_location_rate, "
        "round(sum(interview_minutes_sum) / sum(interview_minutes_n), 9) AS avg_interview_minutes FROM ops")
    q["program_headline"] = (
        "SELECT CAST(sum(households_attempted) AS BIGINT) AS households_attempted, CAST(sum(households_completed) AS BIGINT) "
        "AS households_completed, CAST(sum(households_consented) AS BIGINT) AS households_consented, "
        "sum(households_completed) / sum(households_attempted) AS completion_rate, "
        "sum(households_consented) / sum(households_completed) AS consent_rate FROM summary")
    q["status_share"] = (
        "SELECT survey_cycle, interview_status_label, CAST(n AS BIGINT) AS submissions_raw, "
        "n / sum(n) OVER (PARTITION BY survey_cycle) AS share FROM (SELECT survey_cycle, interview_status_label, "
        "sum(submissions_raw) AS n FROM ops GROUP BY ALL)")
    q["demographic_share"] = (
        "SELECT survey_cycle, dimension, category, CAST(n AS BIGINT) AS households, "
        "n / sum(n) OVER (PARTITION BY survey_cycle, dimension) AS share FROM (SELECT survey_cycle, dimension, category, "
        "sum(households) AS n FROM demographics GROUP BY ALL)")
    q["dedup_stages"] = ("SELECT survey_cycle, 'Raw' AS stage, submissions_raw AS submissions FROM opc UNION ALL "
                         "SELECT survey_cycle, 'Deduplicated', submissions_deduplicated FROM opc")
    q["rates_long"] = (
        "SELECT * FROM (SELECT survey_cycle, 'Duplicate household rate' AS metric, duplicate_household_rate AS rate FROM opc "
        "UNION ALL SELECT survey_cycle, 'Missing location rate', missing_location_rate FROM opc "
        "UNION ALL SELECT survey_cycle, 'Missing GPS rate', missing_gps_rate FROM opc) WHERE rate IS NOT NULL")
    q["rate_pivot"] = (
        "SELECT district, survey_cycle, year_month, round(avg(completion_rate), 3) AS completion_rate, "
        "round(avg(consent_rate), 3) AS consent_rate FROM summary GROUP BY ALL")
    rates = ", ".join(
        f"round(avg(CASE WHEN survey_cycle || ' ' || year_month = '{p}' THEN {r} END), 3) AS \"{p}_{r}\""
        for p in adapter.PERIODS for r in ("completion_rate", "consent_rate"))
    q["rate_pivot_wide"] = f"SELECT district, {rates} FROM summary GROUP BY district"
    q["coverage_labels"] = (
        "SELECT n_cycles, replace(replace(replace(cycle_pattern, 'baseline', 'Baseline'), 'year1', 'Year 1'), 'year2', "
        "'Year 2') AS cycle_pattern, households FROM coverage")
    q["households_by_cycles_seen"] = ("SELECT n_cycles, CAST(sum(households) AS BIGINT) AS households FROM coverage "
                                      "GROUP BY n_cycles")
    q["panel_size"] = ("SELECT coalesce(CAST(sum(households) AS BIGINT), 0) AS panel_households FROM panel "
                       "WHERE cycle_order = (SELECT min(cycle_order) FROM panel)")
    q["district_choices"] = "SELECT DISTINCT district FROM geography ORDER BY 1"
    q["recent_runs"] = ("SELECT event_id, event_type, ts AS logged_at FROM events ORDER BY ts DESC, event_id, event_type LIMIT 20")
    q["dq_results"] = "SELECT * FROM dq"
    q["dq_counters"] = (
        "SELECT count(*) AS checks, count(*) FILTER (WHERE severity = 'warn' AND NOT passed) AS warnings_failing, "
        "count(*) FILTER (WHERE severity = 'error' AND NOT passed) AS errors_failing FROM dq")
    q["dq_unmatched"] = ("SELECT count(*) FILTER (WHERE g.geo_key IS NULL) AS failed, count(*) AS total "
                         "FROM fact f LEFT JOIN geography g USING (geo_key)")
    q["cycle_counts"] = (
        "SELECT survey_cycle, submissions_raw, submissions_deduplicated, submissions_superseded, submissions_rejected, "
        "round(duplicate_household_rate, 4) AS duplicate_household_rate FROM opc")
    q["column_profile"] = "SELECT * FROM profile"
    q["classify_columns"] = "SELECT survey_cycle, variable, kind, form_field, section, label FROM variables"
    q["columns_by_kind"] = (
        "SELECT survey_cycle, kind, count(*) AS columns, CAST(sum(CAST(all_null AS INTEGER)) AS BIGINT) AS all_null "
        "FROM classified_all GROUP BY survey_cycle, kind")
    q["variable_presence"] = "SELECT * FROM presence"
    q["shared_columns"] = ("SELECT count(*) FILTER (WHERE in_baseline AND in_year1 AND in_year2) AS shared_by_all "
                           "FROM presence")
    drift = ("SELECT '{0}' AS from_cycle, '{1}' AS to_cycle, count(*) FILTER (WHERE in_{1} AND NOT in_{0}) AS added, "
             "count(*) FILTER (WHERE in_{0} AND NOT in_{1}) AS removed, count(*) FILTER (WHERE in_{0} AND in_{1}) AS kept "
             "FROM presence")
    q["schema_drift"] = drift.format("baseline", "year1") + " UNION ALL " + drift.format("year1", "year2")
    q["resolve_variables"] = "SELECT * FROM resolved"
    q["silver_variable_catalog"] = (
        "SELECT s.canonical_name, s.dtype, s.notes, r.survey_cycle, nullif(r.source, '') AS source_column, v.kind, "
        "v.section, v.label, v.null_rate, r.source <> '' AS available FROM spec s JOIN resolved r USING (canonical_name) "
        "LEFT JOIN variables v ON v.survey_cycle = r.survey_cycle AND v.variable = nullif(r.source, '')")
    q["label_conform_auto"] = "SELECT * FROM automatic"
    q["label_conform"] = "SELECT * FROM conform"
    first = ", ".join(f"arg_min(final, position) FILTER (WHERE survey_cycle = '{c}') AS {c}"
                      for c in ("baseline", "year1", "year2"))
    q["label_review"] = (f"SELECT field, code, {first} FROM finals GROUP BY field, code HAVING count(DISTINCT final) > 1")
    q["labels_per_code"] = (
        "SELECT p.position, p.field, p.code, p.label, n.n_labels FROM part_choices p JOIN (SELECT field, code, "
        "count(DISTINCT label) AS n_labels FROM part_choices GROUP BY 1, 2) n USING (field, code)")
    q["form_fields"] = (
        "SELECT 'form_' || (p_partkey // 100) AS form, CAST(p_partkey % 100 AS INTEGER) AS position, "
        "'field_' || p_partkey AS field, 'Section ' || (p_partkey // 10) AS section, "
        "p_name || ' ' || p_type || ' & more' AS label, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END AS n_choices FROM part")
    q["form_choices"] = (
        "SELECT 'form_' || (p_partkey // 100) AS form, 'field_' || p_partkey AS field, CAST(p_size AS VARCHAR) AS code, "
        "p_brand AS label FROM part WHERE p_partkey % 3 <> 0")
    return q


def statements() -> dict[str, str]:
    """One self-contained statement per registered query."""
    ctes = _ctes()

    def used(sql: str) -> set[str]:
        words = set(re.findall(r"[a-z_0-9]+", sql))
        return words & ctes.keys()

    needs: dict[str, set[str]] = {}
    for name, sql in ctes.items():  # each CTE only refers to earlier ones
        direct = (used(sql) & needs.keys()) - {name}
        needs[name] = direct.union(*[needs[d] for d in direct]) if direct else set()

    out = {}
    for name, sql in _queries().items():
        direct = used(sql)
        every = direct.union(*[needs[d] for d in direct]) if direct else set()
        chain = ", ".join(f"{n} AS {'MATERIALIZED ' * (n in _SHARED)}({ctes[n]})" for n in ctes if n in every)
        out[name] = f"WITH {chain} {sql}" if chain else sql
    return out
