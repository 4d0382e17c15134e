"""The adapter views as common table expressions of the oracle's SQL."""

from __future__ import annotations

import re

DAY = "CAST({0} AT TIME ZONE 'UTC' AT TIME ZONE 'America/Chicago' AS DATE)"

VIEWS: dict[str, str] = {
    "patient": """SELECT c_custkey AS patient_id, c_name AS full_name, DATE '1925-01-01' + CAST(c_custkey * 7919 % 24000 AS INT) AS birth_date,
        CASE WHEN c_custkey % 9 = 0 THEN DATE '1996-01-01' + CAST(c_custkey * 31 % 2000 AS INT) END AS death_date, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
        n_name AS state, lpad(CAST(c_custkey * 37 % 90000 + 10000 AS VARCHAR), 5, '0') AS zip, c_mktsegment AS payer, CAST(c_acctbal AS DECIMAL(14,2)) AS income
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "encounter": """SELECT o_orderkey AS encounter_id, o_custkey AS patient_id, o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS started_at,
        o_orderdate + to_seconds(o_orderkey * 7919 % 86400) + to_hours(CAST(o_orderkey * 31 % 240 AS INT)) AS stopped_at,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'inpatient' WHEN o_orderpriority = '3-MEDIUM' THEN 'emergency' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'ambulatory'
          WHEN o_orderkey % 10 = 0 THEN 'hospice' ELSE 'wellness' END AS encounter_class,
        CASE WHEN o_orderkey % 11 <> 0 THEN 'reason ' || (o_orderkey % 12) END AS reason, o_orderkey % 30 AS organization_id,
        CAST(o_totalprice AS DECIMAL(14,2)) AS total_cost, CAST(o_totalprice * 0.8::DOUBLE AS DECIMAL(14,2)) AS payer_paid FROM orders""",
    "condition": """SELECT o_custkey AS patient_id, l_orderkey AS encounter_id, 'C' || (l_partkey % 40) AS code, CAST(l_shipdate AS DATE) AS onset_date,
        CASE WHEN l_returnflag = 'A' THEN CAST(l_shipdate AS DATE) + CAST(l_quantity * 10 AS INT) END AS resolved_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'""",
    "procedure": """SELECT o_custkey AS patient_id, l_orderkey AS encounter_id, 'P' || (l_partkey % 40) AS code, CAST(l_shipdate AS DATE) AS done_on FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "medication": """SELECT o_custkey AS patient_id, CASE WHEN l_partkey % 50 = 0 THEN 'string of ' || p_name || 's' ELSE p_name END AS description, CAST(l_shipdate AS DATE) AS started_on,
        CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) END AS stopped_on FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "observation": """SELECT event_id AS observation_id, user_id AS patient_id, CASE event_type WHEN 'view' THEN 'systolic' WHEN 'click' THEN 'diastolic' WHEN 'purchase' THEN 'hba1c' WHEN 'signup' THEN 'bmi' ELSE 'other' END AS code,
        ts AS observed_at, value FROM events""",
    "note": "SELECT doc_id AS note_id, text AS note_text FROM documents",
    "own_name": """SELECT patient_id, full_name AS family, state AS place, array_to_string(list_transform(string_split(lower(b.n_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS born_in, zip, upper(left(c_mktsegment, 1)) || lower(c_mktsegment[2:]) AS given,
        lpad(CAST(patient_id % 900 + 100 AS VARCHAR), 3, '0') || '-' || lpad(CAST(patient_id * 31 % 90 + 10 AS VARCHAR), 2, '0') || '-' || lpad(CAST(patient_id * 7919 % 9000 + 1000 AS VARCHAR), 4, '0') AS ssn,
        'S' || lpad(CAST(patient_id * 97 % 100000000 AS VARCHAR), 8, '0') AS license, 'X' || lpad(CAST(patient_id * 89 % 10000000 AS VARCHAR), 7, '0') || 'X' AS passport, birth_date, death_date
        FROM patient JOIN customer ON c_custkey = patient_id JOIN nation b ON b.n_nationkey = c_custkey * 7 % 25""",
    "seen_day": "SELECT DISTINCT patient_id, " + DAY.format("started_at") + " AS day FROM encounter",
    "chart": """SELECT note_id, patient_id, given || ' ' || family || ' of ' || place || ' (' || zip || '), born ' || coalesce(strftime(birth_date, '%B %-d, %Y'), 'unknown') || ' in ' || born_in || '. The re' || given || ' stays. ' || left(text, half)
        || chr(10) || family || ', ssn ' || ssn || ', seen ' || coalesce(strftime(first_visit, '%Y-%m-%d'), 'unknown') || ' and ' || coalesce(strftime(last_visit, '%-m/%-d/%Y'), 'unknown') || '; ' || given || ' is a ' || (note_id % 120) || ' year-old.' || chr(10)
        || substr(text, half + 1) || ' License ' || license || ', passport ' || passport || ', last on ' || coalesce(strftime(last_visit, '%-d %B %Y'), 'unknown') || ', died ' || coalesce(strftime(death_date, '%m/%d/%Y'), 'unknown') || ', not on 1/1/1900.' AS note_text
        FROM (SELECT doc_id AS note_id, doc_id % (SELECT max(patient_id) FROM patient) + 1 AS patient_id, coalesce(text, '') AS text, length(coalesce(text, '')) // 2 AS half FROM documents) JOIN own_name USING (patient_id)
        LEFT JOIN (SELECT patient_id, min(day) AS first_visit, max(day) AS last_visit FROM seen_day GROUP BY ALL) USING (patient_id)""",
    "private": """SELECT DISTINCT * FROM (SELECT patient_id, unnest([{'category': 'name', 'needle': given}, {'category': 'name', 'needle': family}, {'category': 'geography', 'needle': place}, {'category': 'geography', 'needle': born_in}, {'category': 'zip', 'needle': zip},
        {'category': 'ssn', 'needle': ssn}, {'category': 'license', 'needle': license}, {'category': 'other_id', 'needle': passport}], recursive := true) FROM own_name) UNION ALL SELECT DISTINCT patient_id, 'date', unnest([strftime(day, '%Y-%m-%d'), strftime(day, '%-m/%-d/%Y'), strftime(day, '%m/%d/%Y'),
        strftime(day, '%B %-d, %Y'), strftime(day, '%B %d, %Y'), strftime(day, '%-d %B %Y')]) FROM (SELECT * FROM seen_day UNION SELECT patient_id, birth_date FROM own_name UNION SELECT patient_id, death_date FROM own_name WHERE death_date IS NOT NULL)""",
    "measure_code": "SELECT * FROM (VALUES ('lab_done','C1'),('lab_done','C2'),('pressure_controlled','C3'),('pressure_controlled','C4'),('drug_taken','C5'),('drug_taken','C6')) AS m(measure, code)",
    "data_end": "SELECT " + DAY.format("max(started_at)") + " AS last_day FROM encounter",
    # hospital stays
    "eligible": f"SELECT *, {DAY.format('started_at')} AS start_day, {DAY.format('stopped_at')} AS stop_day FROM encounter WHERE encounter_class = 'inpatient'",
    "opening": """SELECT patient_id, encounter_id, started_at, row_number() OVER (PARTITION BY patient_id ORDER BY started_at, encounter_id) AS stay_no FROM eligible e
        WHERE NOT EXISTS (FROM eligible w WHERE w.patient_id = e.patient_id AND (w.started_at, w.encounter_id) < (e.started_at, e.encounter_id) AND w.stop_day >= e.start_day)""",
    "numbered": """SELECT e.*, (SELECT count(*) FROM opening o WHERE o.patient_id = e.patient_id AND (o.started_at, o.encounter_id) <= (e.started_at, e.encounter_id)) AS stay_no FROM eligible e""",
    "stay": """SELECT n.patient_id, n.stay_no, any_value(o.encounter_id) AS first_encounter_id, count(*) AS encounters_in_stay, any_value(o.started_at) AS admitted_at, max(n.stopped_at) AS discharged_at, min(n.start_day) AS admit_day,
        max(n.stop_day) AS discharge_day, max(n.reason) FILTER (WHERE n.encounter_id = o.encounter_id) AS admit_reason, count(c.encounter_id) > 0 AS cancer_treatment
        FROM numbered n JOIN opening o USING (patient_id, stay_no) LEFT JOIN (SELECT DISTINCT encounter_id FROM procedure WHERE code = 'P1') c ON c.encounter_id = n.encounter_id GROUP BY n.patient_id, n.stay_no""",
    "staged": """SELECT *, admit_reason IN ('reason 3','reason 7') IS TRUE OR cancer_treatment OR (EXISTS (FROM procedure p WHERE p.patient_id = stay.patient_id AND p.code IN ('P2','P3') AND p.done_on BETWEEN admit_day - 1 AND discharge_day)
        AND NOT EXISTS (FROM procedure p WHERE p.patient_id = stay.patient_id AND p.code = 'P4' AND p.done_on BETWEEN admit_day - 1 AND discharge_day)) AS is_planned FROM stay""",
    "returned": """SELECT patient_id, stay_no, days_to_unplanned_return FROM (SELECT s.patient_id, s.stay_no, (SELECT min(u.admit_day) FROM staged u WHERE u.patient_id = s.patient_id AND u.stay_no > s.stay_no AND NOT u.is_planned) - s.discharge_day AS days_to_unplanned_return
        FROM staged s) WHERE days_to_unplanned_return BETWEEN 1 AND 30""",
    "stay_cost": "SELECT s.patient_id, s.stay_no, CAST(sum(e.total_cost) AS DECIMAL(24,2)) AS stay_cost FROM stay s JOIN eligible e ON e.patient_id = s.patient_id AND e.start_day BETWEEN s.admit_day AND s.discharge_day GROUP BY ALL",
    "excluded_stay": f"""SELECT s.*, EXISTS (FROM patient p WHERE p.patient_id = s.patient_id AND p.death_date <= s.discharge_day) AS excl_died, (SELECT last_day FROM data_end) - s.discharge_day < 30 AS excl_short_followup,
        EXISTS (FROM encounter h WHERE h.patient_id = s.patient_id AND h.encounter_class = 'hospice' AND {DAY.format('h.started_at')} IN (s.discharge_day, s.discharge_day + 1)) AS excl_hospice FROM staged s""",
    "returns": """SELECT f.*, (SELECT min(n.admit_day) FROM stay n WHERE n.patient_id = f.patient_id AND n.stay_no > f.stay_no) - f.discharge_day AS days_to_next, days_to_unplanned_return, days_to_unplanned_return IS NOT NULL AS readmitted,
        NOT (excl_died OR excl_short_followup OR excl_hospice OR cancer_treatment) AS is_index_stay, (SELECT any_value(organization_id) FROM encounter e WHERE e.encounter_id = f.first_encounter_id) AS organization_id,
        payer, f.discharge_day - f.admit_day AS length_of_stay, stay_cost FROM excluded_stay f LEFT JOIN returned USING (patient_id, stay_no) JOIN stay_cost USING (patient_id, stay_no) JOIN patient USING (patient_id)""",
}


def _needs(sql: str, own: str = "") -> set[str]:
    return {name for name in VIEWS if name != own and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql)}


def with_views(sql: str) -> str:
    """``sql`` after the views that it and they name, in the order of VIEWS."""
    wanted, todo = set(), _needs(sql)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo |= _needs(VIEWS[name], name)
    if not wanted:
        return sql
    heads = ", ".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in VIEWS if n in wanted)  # each computed once
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {heads}, {body[15:]}"
    return f"WITH {heads}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {heads} {body}"
