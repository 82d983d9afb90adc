"""The DuckDB twin of every derived table, and a composer that builds one WITH chain.

Each view is written in the plainest SQL that states its meaning; a query names the views it
reads and `with_views` puts exactly those, in order, in front of it.
"""

from __future__ import annotations

import re

HASH32 = "('0x' || substr(md5({0}), 1, 8))::BIGINT"


def hash32(text: str) -> str:
    return HASH32.format(text)


def exact_mean(value: str, digits: int = 6) -> str:
    """The mean as integer arithmetic over trillionths, rounded half up."""
    step = 10 ** (12 - digits)
    total, n = f"sum(round(({value}) * 1e12)::HUGEINT)::HUGEINT", f"(count({value})::HUGEINT * {step})"
    twice = f"(2 * {total} + {n})"
    down = f"({twice} - (({twice} % (2 * {n})) + 2 * {n}) % (2 * {n})) // (2 * {n})"
    return f"CASE WHEN count({value}) > 0 THEN ({down})::DOUBLE / {float(10**digits)!r}::DOUBLE END"


VIEWS: dict[str, str] = {}


def with_views(body: str, views: dict[str, str] | None = None) -> str:
    """Prefix `body` with the views it reads, directly or through other views."""
    views = VIEWS if views is None else views
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text):
            if name in views and name not in order:
                visit(views[name])
                if name not in order:
                    order.append(name)

    visit(body)
    if not order:
        return body
    chain = ",\n".join(f"{name} AS (\n{views[name].strip()}\n)" for name in order)
    return f"WITH {chain}\n{body.strip()}"


_SEC = "((epoch_us(ts) // 1000000 - 1704067200) // 10)"
_AT = "(TIMESTAMP '2024-01-01 00:00:00' + to_seconds({0}))"
_PRINTED = "strftime(" + _AT + ", '%Y-%m-%d %H:%M:%S')"
_FIXED3 = "((({0}) // 1000)::VARCHAR || '.' || lpad((({0}) % 1000)::VARCHAR, 3, '0'))"


def at(seconds: str) -> str:
    return _AT.format(seconds)


def printed(seconds: str) -> str:
    return _PRINTED.format(seconds)


def fixed3(milli: str) -> str:
    return _FIXED3.format(milli)


VIEWS["fx_events"] = f"""
SELECT event_id, user_id, event_type, value, {_SEC} AS sec,
       800 + (round(value * 100)::BIGINT // 10) AS milli
FROM events"""

VIEWS["fx_users"] = "SELECT DISTINCT user_id FROM events"

VIEWS["fx_stays_raw"] = f"""
SELECT user_id::VARCHAR AS subject_id, (user_id * 10)::VARCHAR AS hadm_id,
       (user_id * 10 + k)::VARCHAR AS stay_id,
       CASE WHEN user_id % 2 = 0 THEN 'MICU' ELSE 'SICU' END AS first_careunit,
       CASE WHEN user_id % 3 = 0 THEN 'MICU' ELSE 'SICU' END AS last_careunit,
       {printed("b")} AS intime, {printed("b + n")} AS outtime,
       {fixed3("(n * 10) // 864")} AS los
FROM (SELECT user_id, k, k * 129600 + (user_id % 5) * 3600 AS b,
             CASE WHEN user_id % 17 = 0 AND k = 1 THEN 0
                  WHEN user_id % 7 = 0 AND k = 0 THEN 129600 ELSE 108000 END AS n
      FROM fx_users, (SELECT unnest([0, 1]) AS k))"""

VIEWS["fx_labs_raw"] = f"""
SELECT event_id::VARCHAR AS labevent_id, user_id::VARCHAR AS subject_id,
       CASE WHEN event_id % 53 <> 0 THEN (user_id * 10)::VARCHAR END AS hadm_id,
       CASE event_type WHEN 'purchase' THEN '50912' WHEN 'signup' THEN '51081' ELSE '50971' END AS itemid,
       CASE WHEN event_id % 101 = 0 THEN 'not a time' ELSE {printed("sec")} END AS charttime,
       CASE WHEN event_id % 97 = 0 THEN 'PENDING' WHEN event_id % 89 = 0 THEN NULL
            WHEN event_id % 83 = 0 THEN '25.000' ELSE {fixed3("milli")} END AS valuenum,
       CASE WHEN event_id % 41 = 0 THEN 'umol/L' ELSE 'mg/dL' END AS valueuom
FROM fx_events WHERE event_type IN ('purchase', 'signup', 'error')"""

VIEWS["fx_outputs_raw"] = f"""
SELECT user_id::VARCHAR AS subject_id, (user_id * 10)::VARCHAR AS hadm_id,
       (user_id * 10 + CASE WHEN sec < 129600 THEN 0 ELSE 1 END)::VARCHAR AS stay_id,
       {printed("sec")} AS charttime,
       CASE WHEN event_id % 29 = 0 THEN '227488' WHEN event_type = 'view' THEN '226559'
            ELSE '226560' END AS itemid,
       CASE WHEN event_id % 79 = 0 THEN '-5' WHEN event_id % 73 = 0 THEN '12000'
            ELSE round(value)::BIGINT::VARCHAR END AS value,
       'mL' AS valueuom
FROM fx_events WHERE event_type IN ('view', 'click')"""

VIEWS["fx_admissions_raw"] = f"""
SELECT user_id::VARCHAR AS subject_id,
       CASE WHEN user_id % 31 <> 0 THEN (user_id * 10)::VARCHAR END AS hadm_id,
       {printed("(user_id % 5) * 3600")} AS admittime,
       CASE WHEN user_id % 43 <> 0 THEN
         CASE WHEN user_id % 23 = 0 THEN {printed("(user_id % 5) * 3600")}
              ELSE {printed("(user_id % 5) * 3600 + 388800")} END END AS dischtime
FROM fx_users"""


def _catalogue(first: int) -> str:
    return f"""
SELECT p_partkey + {first} AS itemid,
       CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 50 = 1 THEN 'Creatinine Clearance'
            WHEN p_partkey % 50 = 2 THEN 'Urine Volume' WHEN p_partkey % 50 = 3 THEN 'Avoided Meals'
            ELSE p_name END AS label,
       CASE WHEN p_partkey % 50 = 4 THEN 'Urine' ELSE p_brand END AS category
FROM part"""


VIEWS["fx_d_labitems"] = f"""
SELECT DISTINCT itemid::BIGINT AS itemid,
       CASE itemid WHEN '50912' THEN 'Creatinine' WHEN '51081' THEN 'CREATININE, Serum'
            ELSE 'Potassium' END AS label, 'Chemistry' AS category
FROM fx_labs_raw
UNION ALL {_catalogue(600000)}"""

VIEWS["fx_d_items"] = f"""
SELECT DISTINCT itemid::BIGINT AS itemid,
       CASE itemid WHEN '226559' THEN 'Foley' WHEN '226560' THEN 'Void'
            ELSE 'GU Irrigant Volume In' END AS label, 'Output' AS category
FROM fx_outputs_raw
UNION ALL {_catalogue(700000)}"""

VIEWS["fx_people_raw"] = """
SELECT CASE WHEN user_id % 47 <> 0 THEN user_id::VARCHAR END AS subject_id,
       CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender
FROM fx_users"""

VIEWS["fx_patients_raw"] = """
SELECT c_custkey AS patientunitstayid, 'P' || c_custkey AS uniquepid, c_nationkey::BIGINT AS hospitalid,
       'R' || (c_nationkey % 5) AS region, c_mktsegment AS unittype,
       CASE WHEN c_custkey % 59 <> 0 THEN ((c_custkey * 13) % 130)::INTEGER END AS age,
       CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
       'E' || (c_custkey % 4) AS ethnicity, (25 + (c_custkey * 7) % 240)::DOUBLE AS admissionweight,
       'DX' || (c_custkey % 9) AS apacheadmissiondx
FROM customer WHERE c_custkey IN (SELECT user_id FROM fx_users)"""

VIEWS["fx_lab"] = """
SELECT event_id, CASE WHEN user_id % 40 BETWEEN 1 AND 4 THEN user_id - user_id % 40 + 1 ELSE user_id END AS patientunitstayid,
       CASE WHEN event_id % 67 = 0 THEN NULL WHEN event_type = 'purchase' THEN ' Creatinine '
            WHEN event_type = 'signup' THEN 'CREATININE' ELSE 'sodium' END AS labname,
       (sec // 60)::INTEGER AS labresultoffset,
       CASE WHEN event_id % 83 = 0 THEN 25.0::DOUBLE ELSE milli::DOUBLE / 1000.0::DOUBLE END AS labresult
FROM fx_events WHERE event_type IN ('purchase', 'signup', 'error')"""

VIEWS["fx_intake"] = """
SELECT event_id, CASE WHEN user_id % 40 BETWEEN 1 AND 4 THEN user_id - user_id % 40 + 1 ELSE user_id END AS patientunitstayid,
       (sec // 60)::INTEGER AS intakeoutputoffset,
       CASE WHEN event_id % 79 = 0 THEN -5.0::DOUBLE WHEN event_id % 73 = 0 THEN 12000.0::DOUBLE
            ELSE round(value) END AS cellvaluenumeric
FROM fx_events WHERE event_type IN ('view', 'click')"""

VIEWS["fx_scores"] = f"""
SELECT event_id AS id, user_id, a::DOUBLE / 1000.0::DOUBLE AS prob, CASE WHEN d < a THEN 1 ELSE 0 END AS label
FROM (SELECT event_id, user_id, {hash32("'p' || event_id")} % 1001 AS a,
             {hash32("'y' || event_id")} % 1000 AS d FROM events)"""

VIEWS["fx_live"] = f"""
SELECT event_id + copy * 1000000000 AS arrival, user_id AS subject_id, user_id * 10 AS hadm_id,
       user_id * 10 + CASE WHEN sec < 129600 THEN 0 ELSE 1 END AS stay_id,
       {printed("sec")} AS charttime,
       CASE WHEN event_type IN ('purchase', 'signup') THEN 'creatinine'
            WHEN event_type IN ('view', 'click') THEN 'urine' ELSE 'heart_rate' END AS event_type,
       CASE WHEN event_id % 61 = 0 THEN NULL
            WHEN event_type IN ('purchase', 'signup') THEN milli::DOUBLE / 1000.0::DOUBLE
            ELSE round(value) END AS value,
       CASE WHEN event_type IN ('purchase', 'signup') THEN 'mg/dL'
            WHEN event_type IN ('view', 'click') THEN 'mL' ELSE 'bpm' END AS uom
FROM fx_events, (SELECT unnest([0, 1]) AS copy) WHERE copy = 0 OR event_id % 37 = 0"""
