"""The same queries in SQL for DuckDB, written apart from the DataFrame forms: they share no code and no plan."""

from __future__ import annotations


def _digits(body: str) -> str:
    """The Luhn check digit of 14 digits, position by position."""
    terms = []
    for i in range(1, 15):
        d = f"CAST(substr({body}, {i}, 1) AS INTEGER)"
        terms.append(d if i % 2 else f"((2 * {d}) // 10 + (2 * {d}) % 10)")
    return f"CAST((10 - ({' + '.join(terms)}) % 10) % 10 AS VARCHAR)"


PADDED = "lpad(CAST({} AS VARCHAR), {}, '0')"
AS_OF = 1706659200

BASE = f"""
e0 AS (SELECT event_id AS seq, user_id AS u, event_type, CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS ev, CASE WHEN event_id % 61 = 0 THEN event_id % 4 END AS wrong FROM events),
e1 AS (SELECT seq, u, CASE WHEN wrong IN (0, 3) THEN NULL WHEN wrong = 1 THEN 946684799 ELSE ev END AS ev, wrong,
  CASE WHEN wrong = 2 THEN NULL ELSE ev END + CASE WHEN seq % 20 = 3 THEN 3600 WHEN seq % 20 = 5 THEN 3601 WHEN seq % 20 = 7 THEN 10800 ELSE 2 END AS ing,
  CASE WHEN event_type IN ('signup', 'click') THEN 'Start' WHEN event_type = 'purchase' THEN 'Stop' WHEN event_type = 'view' THEN 'Interim-Update' ELSE 'Accounting-On' END AS status,
  'SESS_' || u || '_' || CAST(seq // 300 AS VARCHAR) AS sess,
  CASE WHEN seq % 211 = 0 THEN '' WHEN seq % 97 = 0 THEN '090abc' WHEN seq % 101 = 0 THEN '+999' || {PADDED.format("u", 8)} WHEN seq % 103 = 0 THEN '+3110' || {PADDED.format("u", 7)} ELSE '+3165' || {PADDED.format("u", 7)} END AS msisdn,
  '452010' || {PADDED.format("CASE WHEN seq % 50 = 0 THEN u + 100000 WHEN seq % 37 = 0 THEN (u + 1) % 100 ELSE u END", 9)} AS imsi,
  {PADDED.format("CASE WHEN seq % 41 = 0 THEN 999999 ELSE u % 40 END", 6)} || '00' || {PADDED.format("(u * 7919 + CASE WHEN seq % 43 = 0 THEN 1 ELSE 0 END) % 1000000", 6)} AS body FROM e0),
rec AS (SELECT *, body || CASE WHEN seq % 53 = 0 THEN CAST((CAST(d AS INTEGER) + 1) % 10 AS VARCHAR) ELSE d END AS imei FROM (SELECT *, {_digits("body")} AS d FROM e1)),
country(cc, cname) AS (VALUES ('31', 'Netherlands'), ('351', 'Portugal'), ('420', 'Czechia'), ('52', 'Mexico'), ('7', 'Kazakhstan')),
prefix(cc, p) AS (SELECT '31', CAST(60 + i AS VARCHAR) FROM range(1, 10) AS r(i) UNION ALL VALUES ('351', '91'), ('420', '601'), ('420', '777'), ('7', '70')),
num AS (SELECT DISTINCT msisdn FROM rec),
num1 AS (SELECT msisdn, CASE WHEN regexp_full_match(msisdn, '\\+[0-9]{{10,15}}') THEN substr(msisdn, 2) END AS n FROM num),
num2 AS (SELECT msisdn, n, (SELECT cc FROM country WHERE starts_with(n, cc) ORDER BY length(cc) LIMIT 1) AS cc FROM num1),
num3 AS (SELECT msisdn, n, cc, substr(n, length(cc) + 1) AS rest FROM num2),
num4 AS (SELECT *, (SELECT p FROM prefix WHERE prefix.cc = num3.cc AND starts_with(num3.rest, p) ORDER BY length(p) LIMIT 1) AS p FROM num3),
plan AS (SELECT msisdn, cc, rest, p, CASE WHEN n IS NULL THEN 'INVALID_FORMAT' WHEN cc IS NULL THEN 'UNKNOWN_COUNTRY' WHEN length(rest) < 7 THEN 'INVALID_FORMAT' WHEN p IS NULL THEN 'UNKNOWN_OPERATOR' END AS plan_error FROM num4),
tac AS (SELECT {PADDED.format("p_partkey", 6)} AS tac_code, p_brand AS manufacturer, p_name AS model, p_type AS device_type FROM part),
sub AS (SELECT '452010' || {PADDED.format("c_custkey", 9)} AS imsi, '+3165' || {PADDED.format("c_custkey", 7)} AS msisdn FROM customer),
val AS (SELECT rec.*, CASE
  WHEN rec.msisdn = '' OR wrong = 3 THEN 'ERR_MISSING_FIELD'
  WHEN NOT regexp_full_match(rec.msisdn, '\\+[1-9][0-9]{{1,14}}') OR plan.plan_error IS NOT NULL THEN 'ERR_INVALID_MSISDN'
  WHEN rec.imsi NOT IN (SELECT imsi FROM sub) THEN 'ERR_IMSI_NOT_IN_HLR'
  WHEN substr(imei, 15, 1) <> d THEN 'ERR_IMEI_LUHN_FAIL'
  WHEN substr(imei, 1, 6) NOT IN (SELECT tac_code FROM tac) THEN 'ERR_IMEI_TAC_UNKNOWN'
  WHEN status NOT IN ('Start', 'Stop', 'Interim-Update') THEN 'ERR_INVALID_STATUS'
  WHEN wrong <= 2 THEN 'ERR_INVALID_TIMESTAMP'
  WHEN ing - ev > 3600 THEN 'ERR_LATE_ARRIVAL' END AS error FROM rec JOIN plan ON rec.msisdn = plan.msisdn),
ok AS (SELECT * FROM val WHERE error IS NULL)
"""
TTL = """
tn AS (SELECT *, row_number() OVER (PARTITION BY sess, status ORDER BY ev, seq) AS rn FROM ok),
tr AS (SELECT seq, sess, status, rn, ev AS last, false AS dup FROM tn WHERE rn = 1
  UNION ALL SELECT tn.seq, tn.sess, tn.status, tn.rn, CASE WHEN tn.ev - tr.last > 3600 THEN tn.ev ELSE tr.last END, tn.ev - tr.last <= 3600 FROM tr JOIN tn ON tn.sess = tr.sess AND tn.status = tr.status AND tn.rn = tr.rn + 1),
one AS (SELECT ok.* FROM ok JOIN tr ON ok.seq = tr.seq WHERE NOT tr.dup)
"""
CONFLICTS = """
ca AS (SELECT *, status <> 'Start' AND (imsi <> first_value(imsi) OVER s OR msisdn <> first_value(msisdn) OVER s) AS is_a FROM one WINDOW s AS (PARTITION BY sess ORDER BY ev, seq)),
bn AS (SELECT *, row_number() OVER (PARTITION BY imsi ORDER BY ev, seq) AS rn FROM ca),
br AS (SELECT seq, imsi, rn, CASE WHEN NOT is_a AND status = 'Start' THEN sess END AS slot, false AS is_b FROM bn WHERE rn = 1
  UNION ALL SELECT bn.seq, bn.imsi, bn.rn, CASE WHEN bn.is_a THEN br.slot WHEN bn.status = 'Start' THEN coalesce(br.slot, bn.sess) WHEN bn.status = 'Stop' AND br.slot = bn.sess THEN NULL ELSE br.slot END,
    NOT bn.is_a AND bn.status = 'Start' AND br.slot IS NOT NULL AND br.slot <> bn.sess FROM br JOIN bn ON bn.imsi = br.imsi AND bn.rn = br.rn + 1),
cb AS (SELECT ca.*, br.is_b FROM ca JOIN br ON ca.seq = br.seq),
cc AS (SELECT *, lag(imsi) OVER n AS previous_imsi, lag(imei) OVER n AS previous_imei FROM cb WHERE NOT is_a AND NOT is_b WINDOW n AS (PARTITION BY msisdn ORDER BY ev, seq)),
cm AS (SELECT cb.*, cc.previous_imsi, cc.previous_imei, coalesce(cc.previous_imsi <> cb.imsi, false) AS is_c, coalesce(cc.previous_imei <> cb.imei, false) AS is_d FROM cb LEFT JOIN cc ON cb.seq = cc.seq)
"""
HISTORY = f"""
sim AS (SELECT '+3165' || {PADDED.format("c_custkey", 7)} AS msisdn, '452010' || {PADDED.format("c_custkey", 9)} AS imsi, 1700000000 + c_custkey AS "at" FROM customer
  UNION ALL SELECT '+3165' || {PADDED.format("c_custkey", 7)}, '452010' || {PADDED.format("(c_custkey + 1) % 100", 9)}, 1704000000 + c_custkey * 1000 FROM customer WHERE c_custkey % 5 = 0),
dev0 AS (SELECT '+3165' || {PADDED.format("c_custkey", 7)} AS msisdn, {PADDED.format("c_custkey % 40", 6)} || '00' || {PADDED.format("(c_custkey * 7919) % 1000000", 6)} AS body, 1700000000 + c_custkey AS "at" FROM customer
  UNION ALL SELECT '+3165' || {PADDED.format("c_custkey", 7)}, {PADDED.format("c_custkey % 40", 6)} || '00' || {PADDED.format("(c_custkey * 7919 + 1) % 1000000", 6)}, 1704000000 + c_custkey * 1000 FROM customer WHERE c_custkey % 4 = 0),
dev AS (SELECT msisdn, body || {_digits("body")} AS imei, "at" FROM dev0),
siml AS (SELECT * FROM (SELECT msisdn, imsi AS latest, lag(imsi) OVER w AS previous, "at", row_number() OVER (PARTITION BY msisdn ORDER BY "at" DESC, imsi DESC) AS r, count(*) OVER (PARTITION BY msisdn) AS n FROM sim WINDOW w AS (PARTITION BY msisdn ORDER BY "at", imsi)) WHERE r = 1 AND n >= 2),
devl AS (SELECT * FROM (SELECT msisdn, imei AS latest, lag(imei) OVER w AS previous, "at", row_number() OVER (PARTITION BY msisdn ORDER BY "at" DESC, imei DESC) AS r, count(*) OVER (PARTITION BY msisdn) AS n FROM dev WINDOW w AS (PARTITION BY msisdn ORDER BY "at", imei)) WHERE r = 1 AND n >= 2),
swaps AS (SELECT cm.msisdn, previous AS old_imsi, latest AS new_imsi, CAST(NULL AS VARCHAR) AS old_imei, CAST(NULL AS VARCHAR) AS new_imei, 'SIM_SWAP' AS swap_type, ev AS detected_at, "at" AS confirmed_at, 'RADIUS_CONFLICT_C' AS source FROM cm JOIN siml ON cm.msisdn = siml.msisdn AND cm.imsi = siml.latest WHERE is_c
  UNION ALL SELECT cm.msisdn, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), previous, latest, 'DEVICE_SWAP', ev, "at", 'RADIUS_CONFLICT_D' FROM cm JOIN devl ON cm.msisdn = devl.msisdn AND cm.imei = devl.latest WHERE is_d)
"""
REQUESTS = f"""
ask AS (SELECT c_custkey AS request_id, CASE WHEN c_custkey % 29 = 0 THEN '12345' ELSE ' +3165' || {PADDED.format("c_custkey", 7)} END AS phone_number, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_custkey % 40 AS INTEGER) END AS max_age FROM customer),
ask1 AS (SELECT *, trim(phone_number) AS phone, CASE WHEN NOT regexp_full_match(trim(phone_number), '\\+[1-9][0-9]{{6,14}}') OR coalesce(max_age < 0, false) THEN 'INVALID_ARGUMENT' END AS request_error FROM ask)
"""
SESSIONS = f"""
st AS (SELECT * FROM one WHERE status = 'Start' AND ev >= {AS_OF} - 86400),
act AS (SELECT st.* FROM st WHERE NOT EXISTS (SELECT 1 FROM one x WHERE x.status = 'Stop' AND x.msisdn = st.msisdn AND x.sess = st.sess AND x.ev >= st.ev))
"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(p.strip() for p in parts) + "\n"


CHAIN = _with(BASE, TTL, CONFLICTS)
SWAP_CHAIN = _with(BASE, TTL, CONFLICTS, HISTORY)
SERVE = _with(BASE, TTL, CONFLICTS, HISTORY, REQUESTS)


def _rate(n: str, total: str) -> str:
    return f"CAST(CASE WHEN {total} > 0 THEN round(CAST({n} AS DECIMAL(28, 4)) * 100 / {total}, 2) ELSE 0 END AS DECIMAL(20, 2))"


def _swap_query(kind: str) -> str:
    return SERVE + f"""
, own AS (SELECT a.request_id, max(s.confirmed_at) AS latest FROM ask1 a JOIN swaps s ON a.phone = s.msisdn AND s.swap_type = '{kind}' AND s.confirmed_at >= {AS_OF} - a.max_age * 86400 WHERE a.request_error IS NULL GROUP BY a.request_id)
SELECT a.request_id, a.phone, a.max_age, a.request_error"""


REPEATED = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sess, status ORDER BY ev, seq) AS r FROM cm WHERE NOT is_a AND NOT is_b) WHERE r > 1"
HISTORY_ORDERS = "h AS (SELECT o_custkey, o_orderkey, epoch(o_orderdate)::BIGINT AS \"at\" FROM orders)"

QUERIES = {
    "val_first_error": _with(BASE) + "SELECT seq, coalesce(error, 'OK') AS error_code FROM val",
    "val_error_counts": _with(BASE) + "SELECT coalesce(error, 'OK') AS error_code, count(*) AS n FROM val GROUP BY 1",
    "e164_plan": _with(BASE) + "SELECT msisdn, plan_error IS NULL AS plan_valid, plan_error, CASE WHEN plan_error IS NULL THEN cc END AS country_code, CASE WHEN plan_error IS NULL THEN rest END AS subscriber_number, CASE WHEN plan_error IS NULL THEN 'Operator_' || p END AS operator FROM plan",
    "late_split": _with(BASE) + "SELECT seq, ing - ev AS delay, 'Delayed ' || (ing - ev) || 's (threshold=3600s), event_timestamp=' || ev || ', ingest_timestamp=' || ing AS details FROM val WHERE error = 'ERR_LATE_ARRIVAL'",
    "late_buckets": _with(BASE) + "SELECT CASE WHEN ing - ev - 3600 <= 300 THEN '0-5m' WHEN ing - ev - 3600 <= 900 THEN '5-15m' ELSE '>15m' END AS bucket, count(*) AS n FROM val WHERE error = 'ERR_LATE_ARRIVAL' GROUP BY 1",
    "dedup_ttl": _with(BASE, TTL) + "SELECT seq, dup AS is_duplicate FROM tr",
    "dedup_long_term": _with(BASE) + "SELECT seq, sess, status FROM (SELECT *, row_number() OVER (PARTITION BY sess, status ORDER BY ev, seq) AS r FROM ok) WHERE r = 1",
    "dup_log": _with(BASE) + "SELECT sess AS session_id, ev AS detected_at, 'LATE_DUPLICATE_LONG_TERM' AS reason FROM (SELECT *, row_number() OVER (PARTITION BY sess, status ORDER BY ev, seq) AS r FROM ok) WHERE r > 1",
    "conflict_a": CHAIN + "SELECT seq, sess, imsi, msisdn FROM cm WHERE is_a",
    "conflict_b": CHAIN + "SELECT seq, sess, imsi FROM cm WHERE is_b",
    "conflict_c": CHAIN + "SELECT seq, msisdn, previous_imsi, imsi FROM cm WHERE is_c",
    "conflict_d": CHAIN + "SELECT seq, msisdn, previous_imei, imei FROM cm WHERE is_d",
    "conflict_log_rows": CHAIN + "SELECT sess AS session_id, CASE WHEN is_a THEN 'A' ELSE 'B' END AS conflict_type, CASE WHEN is_a THEN 'Session ' || sess || ': IMSI/MSISDN thay đổi sau Start' ELSE 'IMSI ' || imsi || ': 2+ Start chưa Stop' END AS details, CASE WHEN is_a THEN 'CONFLICT_A' ELSE 'CONFLICT_B' END AS error_code FROM cm WHERE is_a OR is_b",
    "identity_history": f"WITH {HISTORY_ORDERS} SELECT o_custkey, o_orderkey, \"at\", lead(\"at\") OVER w AS unassigned_at, row_number() OVER (PARTITION BY o_custkey ORDER BY \"at\" DESC, o_orderkey DESC) = 1 AS is_current, CASE WHEN row_number() OVER w = 1 THEN 'initial_activation' ELSE 'customer_request' END AS swap_reason, count(*) OVER (PARTITION BY o_custkey) - 1 AS swap_count, CASE WHEN count(*) OVER (PARTITION BY o_custkey) > 1 THEN max(\"at\") OVER (PARTITION BY o_custkey) END AS latest_swap_at FROM h WINDOW w AS (PARTITION BY o_custkey ORDER BY \"at\", o_orderkey)",
    "msisdn_history": f"WITH {HISTORY_ORDERS}, x AS (SELECT o_custkey, o_orderkey, \"at\", lag(\"at\") OVER (PARTITION BY o_custkey ORDER BY \"at\" DESC, o_orderkey DESC) AS unassigned_at, row_number() OVER (PARTITION BY o_custkey ORDER BY \"at\" DESC, o_orderkey DESC) = 1 AS is_current FROM h), y AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY \"at\" DESC, o_orderkey DESC) AS position FROM x WHERE \"at\" >= 820454400) SELECT o_custkey, o_orderkey, \"at\", unassigned_at, is_current, CAST(position AS INTEGER) AS position, count(*) OVER (PARTITION BY o_custkey) AS total FROM y WHERE position <= 20",
    "latest_profile": f"WITH {HISTORY_ORDERS} SELECT o_custkey, o_orderkey, \"at\" FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY \"at\" DESC, o_orderkey DESC) AS r FROM h) WHERE r = 1",
    "swap_verified": SWAP_CHAIN + "SELECT * FROM swaps",
    "sim_swap_check": _swap_query("SIM_SWAP") + ", CASE WHEN a.request_error IS NULL THEN own.latest IS NOT NULL END AS swapped FROM ask1 a LEFT JOIN own ON a.request_id = own.request_id",
    "sim_swap_retrieve_date": _swap_query("SIM_SWAP") + ", own.latest AS latest_change FROM ask1 a LEFT JOIN own ON a.request_id = own.request_id",
    "device_swap_check": _swap_query("DEVICE_SWAP") + ", CASE WHEN a.request_error IS NULL THEN own.latest IS NOT NULL END AS swapped FROM ask1 a LEFT JOIN own ON a.request_id = own.request_id",
    "device_swap_retrieve_date": _swap_query("DEVICE_SWAP") + ", own.latest AS latest_change FROM ask1 a LEFT JOIN own ON a.request_id = own.request_id",
    "active_sessions": _with(BASE, TTL, SESSIONS) + "SELECT seq, msisdn, sess, ev FROM act",
    "number_verify": _with(BASE, TTL, SESSIONS, REQUESTS) + "SELECT request_id, phone, request_error, CASE WHEN request_error IS NULL THEN phone IN (SELECT msisdn FROM act) END AS verified FROM ask1",
    "rpt_imei": CHAIN + f"SELECT luhn_fail, tac_unknown, total, {_rate('total', 'stored')} AS rate FROM (SELECT count(*) FILTER (WHERE error = 'ERR_IMEI_LUHN_FAIL') AS luhn_fail, count(*) FILTER (WHERE error = 'ERR_IMEI_TAC_UNKNOWN') AS tac_unknown, count(*) AS total FROM val WHERE error LIKE 'ERR_IMEI%'), (SELECT count(DISTINCT (sess, status)) AS stored FROM cm WHERE NOT is_a AND NOT is_b)",
    "rpt_duplicates_hourly": CHAIN + f"SELECT CAST((ing % 86400) // 3600 AS INTEGER) AS hour, count(*) AS n FROM ({REPEATED}) GROUP BY 1",
    "chain_duplicates": CHAIN + f"SELECT sess AS session_id, ing AS detected_at, 'LATE_DUPLICATE_LONG_TERM' AS reason FROM ({REPEATED})",
    "e164_totals": _with(BASE) + "SELECT count(*) AS total, count(*) FILTER (WHERE plan_error IS NULL) AS valid_count, count(*) FILTER (WHERE plan_error IS NOT NULL) AS invalid_count FROM rec JOIN plan ON rec.msisdn = plan.msisdn",
    "history_batch": f"WITH {HISTORY_ORDERS}, i AS (SELECT o_custkey, o_orderkey, \"at\", lead(\"at\") OVER w AS unassigned_at, row_number() OVER (PARTITION BY o_custkey ORDER BY \"at\" DESC, o_orderkey DESC) = 1 AS is_current, CASE WHEN row_number() OVER w = 1 THEN 'initial_activation' ELSE 'customer_request' END AS swap_reason, count(*) OVER (PARTITION BY o_custkey) - 1 AS swap_count, CASE WHEN count(*) OVER (PARTITION BY o_custkey) > 1 THEN max(\"at\") OVER (PARTITION BY o_custkey) END AS latest_swap_at FROM h WINDOW w AS (PARTITION BY o_custkey ORDER BY \"at\", o_orderkey)) SELECT k AS o_custkey, o_orderkey, \"at\", unassigned_at, is_current, swap_reason, swap_count, latest_swap_at, i.o_custkey IS NOT NULL AS found FROM (SELECT CASE WHEN c_custkey % 11 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS k FROM customer) LEFT JOIN i ON k = i.o_custkey",
    "history_batch_totals": "SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n) FILTER (WHERE found) AS BIGINT) AS found, CAST(sum(n) FILTER (WHERE NOT found) AS BIGINT) AS not_found FROM (SELECT CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 1 END AS n, c_custkey % 11 <> 0 AND c_custkey IN (SELECT o_custkey FROM orders) AS found FROM customer)",
    "subscriber_batch": SWAP_CHAIN + f""", q AS (SELECT c_custkey AS request_id, CASE c_custkey % 3 WHEN 0 THEN 'imsi' WHEN 1 THEN 'msisdn' ELSE 'email' END AS type, CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS who FROM customer),
q1 AS (SELECT request_id, type, CASE WHEN type = 'imsi' THEN '452010' || {PADDED.format("who", 9)} ELSE '+3165' || {PADDED.format("who", 7)} END AS value FROM q)
SELECT q1.*, p.msisdn IS NOT NULL AS found, p.msisdn, p.imsi, p."at" AS assigned_at FROM q1 LEFT JOIN LATERAL (SELECT * FROM sim WHERE (q1.type = 'imsi' AND sim.imsi = q1.value) OR (q1.type = 'msisdn' AND sim.msisdn = q1.value) ORDER BY "at" DESC LIMIT 1) p ON true""",
    "subscriber_totals": """WITH q AS (SELECT CASE c_custkey % 3 WHEN 0 THEN 'imsi' WHEN 1 THEN 'msisdn' ELSE 'email' END AS type, c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN 2 ELSE 1 END AS n FROM customer),
f AS (SELECT n, CASE type WHEN 'email' THEN false WHEN 'msisdn' THEN k % 7 <> 0 ELSE k % 7 <> 0 END AS found FROM q)
SELECT CAST(sum(n) AS BIGINT) AS total, CAST(coalesce(sum(n) FILTER (WHERE found), 0) AS BIGINT) AS found, CAST(coalesce(sum(n) FILTER (WHERE NOT found), 0) AS BIGINT) AS not_found FROM f""",
    "order_page_deep": "SELECT o_orderkey, o_custkey, epoch(o_orderdate)::BIGINT AS \"at\", (SELECT count(*) FROM orders) AS total FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50 OFFSET (SELECT count(*) // 2 FROM orders)",
    "dedup_seen": _with(BASE) + "SELECT seq, r > 1 OR (sess, status) IN (SELECT (sess, status) FROM ok WHERE seq % 2 = 0) AS is_duplicate FROM (SELECT *, row_number() OVER (PARTITION BY sess, status ORDER BY ev, seq) AS r FROM ok WHERE seq % 2 = 1)",
    "rpt_batch_counts": CHAIN + ", k AS (SELECT ing - ing % 86400 AS day, unnest(['kept', CASE WHEN NOT is_a AND NOT is_b THEN 'clean' END, CASE WHEN is_a THEN 'type_a' END, CASE WHEN is_b AND NOT is_a THEN 'type_b' END, CASE WHEN is_c THEN 'swaps_c' END, CASE WHEN is_d THEN 'swaps_d' END]) AS name FROM cm) SELECT day, name, count(*) AS n FROM k WHERE name IS NOT NULL GROUP BY ALL",
    "rpt_conflict": CHAIN + f"SELECT type_a, type_b, type_c, total, {_rate('total', 'stored')} AS rate FROM (SELECT count(*) FILTER (WHERE is_a) AS type_a, count(*) FILTER (WHERE is_b AND NOT is_a) AS type_b, 0::BIGINT AS type_c, count(*) FILTER (WHERE is_a OR is_b) AS total, count(DISTINCT (sess, status)) FILTER (WHERE NOT is_a AND NOT is_b) AS stored FROM cm)",
    "rpt_late": CHAIN + f"SELECT total, {_rate('total', 'stored')} AS rate FROM (SELECT count(*) AS total FROM val WHERE error = 'ERR_LATE_ARRIVAL'), (SELECT count(DISTINCT (sess, status)) AS stored FROM cm WHERE NOT is_a AND NOT is_b)",
    "rpt_missing_top5": _with(BASE) + "SELECT CASE WHEN msisdn = '' THEN 'msisdn is required' ELSE 'event_timestamp is required' END AS details, count(*) AS n FROM val WHERE error = 'ERR_MISSING_FIELD' GROUP BY 1",
    "tac_page": _with(BASE) + "SELECT tac_code, manufacturer, device_type, (SELECT count(*) FROM tac WHERE lower(manufacturer) = 'brand#12') AS total, CAST(ceil((SELECT count(*) FROM tac WHERE lower(manufacturer) = 'brand#12') / 10.0) AS BIGINT) AS pages FROM tac WHERE lower(manufacturer) = 'brand#12' ORDER BY tac_code LIMIT 10 OFFSET 10",
    "tac_batch_lookup": _with(BASE) + "SELECT k.tac_code, t.manufacturer, t.device_type, t.tac_code IS NOT NULL AS found FROM (SELECT DISTINCT substr(imei, 1, 6) AS tac_code FROM rec) k LEFT JOIN tac t ON k.tac_code = t.tac_code",
    "tac_lookup_totals": _with(BASE) + "SELECT count(*) AS total, count(*) FILTER (WHERE t.tac_code IS NOT NULL) AS found, count(*) FILTER (WHERE t.tac_code IS NULL) AS not_found FROM rec LEFT JOIN tac t ON substr(rec.imei, 1, 6) = t.tac_code",
    "clean_projection": CHAIN + "SELECT seq, status AS acct_status_type, sess AS acct_session_id, CAST(seq % 3600 AS INTEGER) AS acct_session_time, ev AS event_timestamp, ing AS ingest_timestamp, msisdn, imsi, imei, CASE WHEN seq % 10 <> 0 THEN '10.100.' || ((u // 256) % 256) || '.' || (u % 256) END AS framed_ip, false AS late_arrival FROM cm WHERE NOT is_a AND NOT is_b",
    "clean_json": CHAIN + "SELECT seq, msisdn AS message_key, sess AS acct_session_id, imei FROM cm WHERE NOT is_a AND NOT is_b",
    "pipeline_counts": CHAIN + ", v AS (SELECT count(*) AS total, count(*) FILTER (WHERE error IS NULL OR error = 'ERR_LATE_ARRIVAL') AS valid, count(*) FILTER (WHERE error IS NOT NULL AND error <> 'ERR_LATE_ARRIVAL') AS invalid, count(*) FILTER (WHERE error = 'ERR_LATE_ARRIVAL') AS late FROM val), m AS (SELECT count(*) AS deduplicated, count(*) FILTER (WHERE NOT is_a AND NOT is_b) AS clean, count(*) FILTER (WHERE is_a OR is_b) AS conflict_ab, count(*) FILTER (WHERE is_c) AS conflict_c, count(*) FILTER (WHERE is_d) AS conflict_d FROM cm) SELECT 'total' AS stage, total AS n FROM v UNION ALL SELECT 'valid', valid FROM v UNION ALL SELECT 'invalid', invalid FROM v UNION ALL SELECT 'late', late FROM v UNION ALL SELECT 'deduplicated', deduplicated FROM m UNION ALL SELECT 'clean', clean FROM m UNION ALL SELECT 'conflict_ab', conflict_ab FROM m UNION ALL SELECT 'conflict_c', conflict_c FROM m UNION ALL SELECT 'conflict_d', conflict_d FROM m",
    "gen_sessions": f"SELECT o_orderkey AS session, epoch(o_orderdate)::BIGINT AS start_at, epoch(o_orderdate)::BIGINT + 60 + o_orderkey % 3600 AS stop_at, '+3165' || {PADDED.format('o_custkey', 7)} AS msisdn, '452010' || {PADDED.format('o_custkey', 9)} AS imsi FROM orders",
}
QUERIES["sim_swap_served"] = _swap_query("SIM_SWAP") + ", CASE WHEN a.request_error IS NULL THEN own.latest IS NOT NULL END AS swapped, own.latest AS latest_change FROM ask1 a LEFT JOIN own ON a.request_id = own.request_id"
QUERIES["number_verify_served"] = QUERIES["number_verify"]
QUERIES["csv_chain_counts"] = QUERIES["pipeline_counts"]
