"""The named queries restated in DuckDB SQL, written independently of the engine."""

from __future__ import annotations

from loglathe.contracts import (
    CEF_ACTION_WORDS, CEF_KEYS, CEF_SEVERITY_WORDS, DISPLAY_COLUMNS, GEO_RANGES,
    JSON_ACTION_WORDS, JSON_KEYS, JSON_SEVERITY_WORDS, KNOWN_BAD_IPS, NORMALIZED_EVENT_COLUMNS,
    UNKNOWN_ACTION_WORDS,
)
from loglathe.fixtures import ASSUMED_YEAR, CLOCK, LOG_LINES_SQL, RUN

_EVENT = ", ".join(NORMALIZED_EVENT_COLUMNS)
_OUTCOME = f"detected_format, status, error_reason, {_EVENT}"
_RAW = "event_id, raw_text, source_name, source_format_hint, ingested_at"


def _words(expr: str, table: dict[str, list[str]], default: str = "unknown") -> str:
    cases = " ".join(
        f"WHEN lower(trim({expr})) IN ({', '.join(repr(w) for w in words)}) THEN '{value}'"
        for value, words in table.items())
    return f"CASE {cases} ELSE '{default}' END"


def _protocol(expr: str) -> str:
    return (f"CASE WHEN upper(trim({expr})) IN ('TCP', 'UDP', 'ICMP') "
            f"THEN upper(trim({expr})) ELSE 'UNKNOWN' END")


def _fmt(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


def _iso(text: str) -> str:
    """ISO text to UTC text; the cast to TIMESTAMP would ignore the offset."""
    whole = f"replace({text}, 'Z', '+00:00')"
    return f"""CASE WHEN regexp_matches({whole}, '[+-]\\d\\d:\\d\\d$')
        THEN {_fmt(f"make_timestamp(epoch_us(try_cast({whole} AS TIMESTAMPTZ)))")}
        ELSE {_fmt(f"try_cast({whole} AS TIMESTAMP)")} END"""


def _ist(column: str) -> str:
    return (f"coalesce(strftime(try_strptime({column}, '%Y-%m-%dT%H:%M:%SZ') "
            f"+ INTERVAL 330 MINUTE, '%d %b %Y, %I:%M:%S %p IST'), {column})")


def _epoch(number: str) -> str:
    seconds = f"floor(CASE WHEN {number} > 10000000000 THEN {number} / 1000 ELSE {number} END)"
    return _fmt(f"make_timestamp(CAST({seconds} AS BIGINT) * 1000000)")


_RAW_CTE = f"""
log_lines AS ({LOG_LINES_SQL}),
lines AS (SELECT seq, source_name, trim(raw_text) AS raw_text FROM log_lines
  WHERE trim(raw_text) <> ''),
raw AS (SELECT sha256('{RUN}' || chr(31) ||
      sha256(source_name || chr(31) || seq || chr(31) || raw_text)) AS event_id,
    raw_text, source_name, CAST(NULL AS VARCHAR) AS source_format_hint,
    '{CLOCK}' AS ingested_at, seq FROM lines),
det AS (SELECT *, CASE
    WHEN starts_with(raw_text, '{{') AND json_valid(raw_text) THEN 'json'
    WHEN starts_with(raw_text, 'CEF:') THEN 'cef'
    WHEN regexp_matches(raw_text, '^[A-Z][a-z]{{2}}\\s+\\d{{1,2}}\\s+\\d{{2}}:\\d{{2}}:\\d{{2}}\\s+\\S+')
      OR regexp_matches(raw_text, '^<\\d{{1,3}}>\\d+\\s+\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}')
      THEN 'syslog'
    ELSE 'unknown' END AS fmt FROM raw)"""

_IP = r"(\d+\.\d+\.\d+\.\d+)"
_FIELDS = ("event_id, fmt, ts, src_ip, dst_ip, src_port, dst_port, action, protocol, "
           "device_vendor, severity, error_reason")

_SYSLOG_CTE = rf"""
sys1 AS (SELECT event_id, fmt, regexp_extract(raw_text,
    '^([A-Z][a-z]{{2}})\s+(\d{{1,2}})\s+(\d{{2}}:\d{{2}}:\d{{2}})\s+(\S+)\s+(.+)$',
    ['mon', 'day', 'tm', 'host', 'msg']) AS h FROM det WHERE fmt = 'syslog'),
sys2 AS (SELECT *, h.msg AS msg,
    regexp_extract(h.msg, '^%([A-Z0-9]+)-(\d+)-(\d+):\s*(.+)$', ['v', 'sev', 'id', 'body']) AS t,
    try_strptime('{ASSUMED_YEAR} ' || h.mon || ' ' || h.day || ' ' || h.tm, '%Y %b %d %H:%M:%S')
      AS stamp FROM sys1),
sys3 AS (SELECT *, CASE WHEN t.body = '' THEN msg ELSE t.body END AS body FROM sys2),
sys4 AS (SELECT *,
    regexp_extract(body, 'Deny\s+(\w+)\s+src\s+\S+:{_IP}/(\d+)\s+dst\s+\S+:{_IP}/(\d+)',
      ['proto', 'sip', 'sp', 'dip', 'dp'], 'i') AS d,
    regexp_extract(body, 'Built\s+\w+\s+(\w+)\s+connection.*?outside:{_IP}/(\d+).*?inside:{_IP}/(\d+)',
      ['proto', 'sip', 'sp', 'dip', 'dp'], 'i') AS b,
    regexp_extract(body, 'Group\s+<([^>]+)>\s+User\s+<([^>]+)>\s+IP\s+<{_IP}>\s+(.+)$',
      ['g', 'u', 'sip', 'st'], 'i') AS v FROM sys3),
sys5 AS (SELECT *, CASE WHEN d.sip <> '' THEN d WHEN b.sip <> '' THEN b END AS f,
    d.sip <> '' AS is_deny, b.sip <> '' AS is_built, v.sip <> '' AS is_vpn FROM sys4),
n_syslog AS (SELECT event_id, fmt, {_fmt('stamp')} AS ts,
    CASE WHEN f IS NOT NULL THEN f.sip WHEN is_vpn THEN v.sip END AS src_ip,
    f.dip AS dst_ip, try_cast(f.sp AS BIGINT) AS src_port, try_cast(f.dp AS BIGINT) AS dst_port,
    CASE WHEN is_deny THEN 'deny' WHEN is_built THEN 'allow'
      WHEN lower(v.st) LIKE '%established%' THEN 'allow' ELSE 'unknown' END AS action,
    {_protocol("coalesce(f.proto, '')")} AS protocol,
    CASE WHEN starts_with(msg, '%ASA-') THEN 'Cisco' END AS device_vendor,
    CASE WHEN t.sev = '' THEN 'unknown' WHEN try_cast(t.sev AS INT) <= 2 THEN 'critical'
      WHEN try_cast(t.sev AS INT) = 3 THEN 'high' WHEN try_cast(t.sev AS INT) = 4 THEN 'medium'
      WHEN try_cast(t.sev AS INT) <= 6 THEN 'low' ELSE 'unknown' END AS severity,
    CASE WHEN msg = '' THEN 'header' WHEN stamp IS NULL THEN 'timestamp'
      WHEN NOT is_deny AND NOT is_built AND NOT is_vpn THEN 'body' END AS error_reason
  FROM sys5)"""

_CEF_CTE = rf"""
cef1 AS (SELECT event_id, fmt, raw_text, string_split(substr(raw_text, 5), '|') AS p
  FROM det WHERE fmt = 'cef'),
cef2 AS (SELECT *, CASE WHEN len(p) >= 8 THEN array_to_string(p[8:], '|') END AS ext FROM cef1),
cef3 AS (SELECT event_id, unnest(string_split(
    regexp_replace(ext, '(^|\s)([a-zA-Z][a-zA-Z0-9_.]*)=', chr(2) || '\2' || chr(3), 'g'), chr(2)))
    AS kv, generate_subscripts(string_split(
    regexp_replace(ext, '(^|\s)([a-zA-Z][a-zA-Z0-9_.]*)=', chr(2) || '\2' || chr(3), 'g'), chr(2)), 1)
    AS i FROM cef2),
cef4 AS (SELECT event_id, lower(split_part(kv, chr(3), 1)) AS k,
    arg_max(trim(split_part(kv, chr(3), 2)), i) AS v FROM cef3 WHERE i > 1 GROUP BY 1, 2),
cef5 AS (SELECT event_id, {", ".join(
    "coalesce(" + ", ".join(f"max(nullif(v, '')) FILTER (k = '{a}')" for a in aliases) + f") AS c_{f}"
    for f, aliases in CEF_KEYS.items())} FROM cef4 GROUP BY 1),
cef6 AS (SELECT c.*, {", ".join(f"c_{f}" for f in CEF_KEYS)}, trim(p[7]) AS sev,
    try_cast(trim(p[7]) AS BIGINT) AS lvl FROM cef2 c LEFT JOIN cef5 USING (event_id)),
n_cef AS (SELECT event_id, fmt, coalesce(
    CASE WHEN regexp_matches(c_timestamp, '^\d+$') THEN {_epoch("TRY_CAST(c_timestamp AS DOUBLE)")}
      ELSE {_iso("c_timestamp")} END, '{CLOCK}') AS ts,
    c_src_ip AS src_ip, c_dst_ip AS dst_ip, try_cast(c_src_port AS BIGINT) AS src_port,
    try_cast(c_dst_port AS BIGINT) AS dst_port,
    {_words("coalesce(c_action, '')", CEF_ACTION_WORDS)} AS action,
    {_protocol("coalesce(c_protocol, '')")} AS protocol, nullif(trim(p[2]), '') AS device_vendor,
    CASE WHEN lvl IS NULL THEN {_words("sev", CEF_SEVERITY_WORDS)}
      WHEN lvl BETWEEN 0 AND 3 THEN 'low' WHEN lvl BETWEEN 4 AND 6 THEN 'medium'
      WHEN lvl BETWEEN 7 AND 8 THEN 'high' WHEN lvl BETWEEN 9 AND 10 THEN 'critical'
      ELSE 'unknown' END AS severity,
    CASE WHEN len(p) < 8 THEN 'header' END AS error_reason FROM cef6)"""


def _json_first(field: str) -> str:
    hits = ", ".join(f"max(e) FILTER (k = '{a}')" for a in JSON_KEYS[field])
    return f"coalesce({hits}) AS j_{field}"


def _json_string(field: str) -> str:
    return f"CASE WHEN j_{field}.t = 'VARCHAR' THEN j_{field}.s ELSE '' END"


def _json_port(field: str) -> str:
    return (f"CASE WHEN j_{field}.t IN ('UBIGINT', 'BIGINT', 'VARCHAR') "
            f"THEN try_cast(j_{field}.s AS BIGINT) END")


_JSON_CTE = rf"""
js1 AS (SELECT event_id, raw_text, unnest(json_keys(raw_text)) AS key,
    generate_subscripts(json_keys(raw_text), 1) AS i FROM det WHERE fmt = 'json'),
js2 AS (SELECT event_id, lower(key) AS k, i,
    json_extract(raw_text, '$."' || key || '"') AS v FROM js1),
js3 AS (SELECT event_id, k, arg_max(CASE WHEN json_type(v) <> 'NULL' THEN
    {{'t': json_type(v), 's': v ->> '$'}} END, i) AS e FROM js2 GROUP BY 1, 2),
js4 AS (SELECT event_id, {", ".join(_json_first(f) for f in JSON_KEYS)} FROM js3 GROUP BY 1),
n_json AS (SELECT d.event_id, d.fmt, coalesce(
    CASE WHEN j_timestamp.t IN ('UBIGINT', 'BIGINT', 'DOUBLE')
        THEN {_epoch("TRY_CAST(j_timestamp.s AS DOUBLE)")}
      WHEN j_timestamp.t = 'VARCHAR' THEN
        {_iso("j_timestamp.s")} END, '{CLOCK}') AS ts,
    j_src_ip.s AS src_ip, j_dst_ip.s AS dst_ip, {_json_port("src_port")} AS src_port,
    {_json_port("dst_port")} AS dst_port,
    {_words(_json_string("action"), JSON_ACTION_WORDS)} AS action,
    {_protocol(_json_string("protocol"))} AS protocol, j_device_vendor.s AS device_vendor,
    {_words(_json_string("severity"), JSON_SEVERITY_WORDS)} AS severity,
    CAST(NULL AS VARCHAR) AS error_reason
  FROM det d LEFT JOIN js4 USING (event_id) WHERE d.fmt = 'json')"""

_TOKENS_CTE = r"""
unk AS (SELECT *, list_filter(string_split_regex(replace(replace(raw_text, '|', ' '), '=', ' '), '\s+'),
    lambda x: x <> '') AS tokens FROM det WHERE fmt = 'unknown'),
leafs AS (SELECT *, len(tokens) || ' ' ||
    CASE WHEN regexp_matches(tokens[1], '\d') THEN '<*>' ELSE tokens[1] END AS leaf FROM unk),
toks AS (SELECT event_id, seq, leaf, unnest(tokens) AS tok,
    generate_subscripts(tokens, 1) AS pos FROM leafs),
runs AS (SELECT *, min(tok) OVER w <> max(tok) OVER w AS wild,
    min(tok) OVER (PARTITION BY leaf, pos) <> max(tok) OVER (PARTITION BY leaf, pos) AS wild_final
  FROM toks WINDOW w AS (PARTITION BY leaf, pos ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

# Leaders among the masked lines of a leaf, walked one after the other.
_SIGNATURES_CTE = r"""
sigs AS (SELECT leaf, list_transform(tokens, lambda t: CASE WHEN regexp_matches(t, '\d') THEN '<*>' ELSE t END)
    AS sig, count(*) AS n_lines FROM leafs GROUP BY 1, 2),
ordered AS (SELECT *, row_number() OVER (PARTITION BY leaf
    ORDER BY n_lines DESC, array_to_string(sig, chr(31))) AS k FROM sigs),
walk AS (SELECT leaf, k, [sig] AS leaders, true AS leads FROM ordered WHERE k = 1
  UNION ALL
  SELECT o.leaf, o.k, CASE WHEN hit THEN leaders ELSE list_append(leaders, o.sig) END, NOT hit
  FROM (SELECT o.*, w.leaders, len(list_filter(w.leaders, lambda l: len(list_filter(list_zip(l, o.sig),
          lambda p: p[1] = p[2] AND p[1] <> '<*>')) / len(o.sig) >= 0.4)) > 0 AS hit
        FROM walk w JOIN ordered o ON o.leaf = w.leaf AND o.k = w.k + 1) o),
owners AS (SELECT o.leaf, o.k, o.sig, o.n_lines, l.k AS leader
  FROM ordered o JOIN walk w ON o.leaf = w.leaf AND w.leads AND w.k <= o.k
  JOIN ordered l ON l.leaf = w.leaf AND l.k = w.k
  WHERE l.k = o.k OR len(list_filter(list_zip(l.sig, o.sig),
    lambda p: p[1] = p[2] AND p[1] <> '<*>')) / len(o.sig) >= 0.4
  QUALIFY row_number() OVER (PARTITION BY o.leaf, o.k ORDER BY len(list_filter(list_zip(l.sig, o.sig),
    lambda p: p[1] = p[2] AND p[1] <> '<*>')) DESC,
    len(list_filter(l.sig, lambda t: t = '<*>')) DESC, l.k) = 1),
agreed AS (SELECT leaf, leader, pos, CASE WHEN min(tok) = max(tok) THEN min(tok) ELSE '<*>' END AS tok
  FROM (SELECT leaf, leader, unnest(sig) AS tok, generate_subscripts(sig, 1) AS pos FROM owners) GROUP BY ALL),
shapes AS (SELECT leaf, leader, list(tok ORDER BY pos) AS template FROM agreed GROUP BY ALL),
shaped AS (SELECT f.*, template FROM leafs f JOIN owners o ON o.leaf = f.leaf
    AND o.sig = list_transform(f.tokens, lambda t: CASE WHEN regexp_matches(t, '\d') THEN '<*>' ELSE t END)
  JOIN shapes s ON s.leaf = o.leaf AND s.leader = o.leader)"""


def _classified(source: str) -> str:
    """Field guesses from ``source(event_id, i, tok)``, as a chain of CTEs ending in ``cl``."""
    ip = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
    return rf"""
k1 AS (SELECT event_id, i, tok, lag(tok) OVER (PARTITION BY event_id ORDER BY i) AS prev, CASE
    WHEN regexp_matches(tok, '^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}Z?$') THEN 'time'
    WHEN regexp_matches(tok, '^{ip}:\d{{1,5}}$') THEN 'endpoint'
    WHEN regexp_matches(tok, '^{ip}$') THEN 'address'
    WHEN regexp_matches(tok, '^\d{{1,5}}$') THEN 'port' ELSE 'word' END AS kind FROM {source}),
k2 AS (SELECT *, CASE WHEN kind IN ('endpoint', 'address') THEN
    row_number() OVER (PARTITION BY event_id, kind IN ('endpoint', 'address') ORDER BY i) END AS rnk,
    split_part(tok, ':', 1) AS addr,
    CASE WHEN kind = 'endpoint' THEN TRY_CAST(split_part(tok, ':', 2) AS BIGINT)
      WHEN kind = 'port' THEN TRY_CAST(tok AS BIGINT) END AS num FROM k1),
k3 AS (SELECT event_id, max(addr) FILTER (rnk = 1) AS src_ip, max(addr) FILTER (rnk = 2) AS dst_ip,
    max(i) FILTER (rnk = 1) AS si, max(i) FILTER (rnk = 2) AS di,
    arg_max(tok, i) FILTER (kind = 'time') AS stamp FROM k2 GROUP BY 1),
k4 AS (SELECT k2.event_id,
    arg_min(num, i) FILTER (num <= 65535 AND ((kind = 'endpoint' AND i = si) OR
      (kind = 'port' AND regexp_matches(prev, '^{ip}$') AND prev = src_ip AND i > si))) AS src_port,
    arg_min(num, i) FILTER (num <= 65535 AND ((kind = 'endpoint' AND i = di) OR
      (kind = 'port' AND regexp_matches(prev, '^{ip}$') AND prev = dst_ip AND i > di))) AS dst_port,
    arg_min({_words("tok", UNKNOWN_ACTION_WORDS)}, i) FILTER (kind = 'word' AND
      {_words("tok", UNKNOWN_ACTION_WORDS)} <> 'unknown') AS action
  FROM k2 JOIN k3 USING (event_id) GROUP BY 1),
cl AS (SELECT leafs.event_id, leafs.seq, leafs.fmt,
    CASE WHEN stamp LIKE '%Z' THEN stamp ELSE stamp || 'Z' END AS stamp,
    src_ip, dst_ip, src_port, dst_port, coalesce(action, 'unknown') AS action
  FROM leafs LEFT JOIN k3 USING (event_id) LEFT JOIN k4 USING (event_id))"""


def _unknown_cte(wild: str) -> str:
    return f"""{_TOKENS_CTE},
vals AS (SELECT event_id, pos AS i, tok FROM runs WHERE {wild}),
{_classified("vals")},
n_unknown AS (SELECT event_id, fmt, coalesce(stamp, '{CLOCK}') AS ts, src_ip, dst_ip, src_port,
    dst_port, action, 'UNKNOWN' AS protocol, CAST(NULL AS VARCHAR) AS device_vendor,
    'unknown' AS severity, CAST(NULL AS VARCHAR) AS error_reason FROM cl)"""


def _unknown_signatures() -> str:
    """``n_unknown`` with the values at the wildcards of a line's signature template."""
    whole = _unknown_cte("wild")
    start = whole.index("vals AS (")
    end = whole.index("\n", start)
    spread = ("spread AS (SELECT event_id, unnest(tokens) AS tok, unnest(template) AS shape, "
              "generate_subscripts(tokens, 1) AS i FROM shaped),")
    vals = f"{spread}\nvals AS (SELECT event_id, i, tok FROM spread WHERE shape = '<*>'),"
    return whole[:start] + _SIGNATURES_CTE.strip() + ",\n" + vals + whole[end:]


def _outcome_cte(parsed: str) -> str:
    """``outcome`` from a relation with the columns of ``_FIELDS``."""
    ok = "error_reason IS NULL"

    def event(expr: str, name: str) -> str:
        return f"CASE WHEN {ok} THEN {expr} END AS {name}"

    return f"""
outcome AS (SELECT event_id AS raw_event_id, fmt AS detected_format,
    CASE WHEN {ok} THEN 'normalized' ELSE 'parse_error' END AS status, error_reason,
    {event("sha256(event_id || 'n')", "normalized_id")}, {event("ts", "timestamp")},
    {event("src_ip", "src_ip")}, {event("dst_ip", "dst_ip")}, {event("src_port", "src_port")},
    {event("dst_port", "dst_port")}, {event("action", "action")},
    {event("protocol", "protocol")}, {event("device_vendor", "device_vendor")},
    {event("severity", "severity")}, fmt AS source_format,
    {event("CASE WHEN fmt = 'unknown' THEN 'low' ELSE 'high' END", "parser_confidence")},
    {event(f"'{CLOCK}'", "normalized_at")} FROM {parsed})"""


_ALL = f"""WITH {_RAW_CTE}, {_SYSLOG_CTE}, {_CEF_CTE}, {_JSON_CTE}, {_unknown_cte("wild")},
parsed AS (SELECT {_FIELDS} FROM n_syslog UNION ALL SELECT {_FIELDS} FROM n_cef
  UNION ALL SELECT {_FIELDS} FROM n_json UNION ALL SELECT {_FIELDS} FROM n_unknown),
{_outcome_cte("parsed")},
events_out AS (SELECT * FROM outcome WHERE status = 'normalized')"""

_KNOWN = f"""WITH {_RAW_CTE}, {_SYSLOG_CTE}, {_CEF_CTE}, {_JSON_CTE},
parsed AS (SELECT {_FIELDS} FROM n_syslog UNION ALL SELECT {_FIELDS} FROM n_cef
  UNION ALL SELECT {_FIELDS} FROM n_json), {_outcome_cte("parsed")}"""


def _one_format(cte: str, relation: str) -> str:
    return f"WITH {_RAW_CTE}, {cte}, {_outcome_cte(relation)} SELECT {_OUTCOME} FROM outcome"


_GEO_VALUES = ", ".join(
    f"({i}, '{cidr}', '{country}')" for i, (cidr, country) in enumerate(GEO_RANGES, start=1))


def _ip_number(expr: str) -> str:
    part = [f"CAST(split_part({expr}, '.', {i}) AS BIGINT)" for i in (1, 2, 3, 4)]
    return f"({part[0]} * 16777216 + {part[1]} * 65536 + {part[2]} * 256 + {part[3]})"


def _geo_cte(order: str = "ord") -> str:
    return f"""
geo0(ord, cidr, country) AS (VALUES {_GEO_VALUES}),
geo AS (SELECT CAST(ord AS BIGINT) AS ord, cidr, country,
    CAST(split_part(cidr, '/', 2) AS BIGINT) AS prefix_len,
    {_ip_number("split_part(cidr, '/', 1)")} // (1 << (32 - CAST(split_part(cidr, '/', 2) AS INT)))
      AS net FROM geo0),
ips AS (SELECT DISTINCT src_ip FROM events_out WHERE src_ip IS NOT NULL),
placed AS (SELECT src_ip, arg_min(ord, {order}) AS ord, arg_min(country, {order}) AS src_country
  FROM ips JOIN geo ON {_ip_number("src_ip")} // (1 << (32 - CAST(prefix_len AS INT))) = net
  GROUP BY 1)"""


_BAD = f"coalesce(trim(src_ip) IN ({', '.join(repr(ip) for ip in KNOWN_BAD_IPS)}), false)"

ORACLES: dict[str, str] = {
    # sources and sinks
    "log_scan": f"""WITH {_RAW_CTE} SELECT source_name,
        row_number() OVER (PARTITION BY source_name ORDER BY seq) AS line_no,
        row_number() OVER (ORDER BY source_name, seq) AS seq, raw_text FROM lines""",
    "clean_lines": f"WITH {_RAW_CTE} SELECT seq, source_name, raw_text FROM lines",
    "raw_events": f"WITH {_RAW_CTE} SELECT {_RAW} FROM raw",
    "normalized_events": f"{_ALL} SELECT {_EVENT} FROM events_out",
    "raw_by_id": f"""WITH {_RAW_CTE} SELECT {_RAW} FROM raw
        WHERE event_id = (SELECT min(event_id) FROM raw)""",
    "geo_ranges": f"""{_ALL}, {_geo_cte()} SELECT ord, cidr, country, prefix_len,
        (SELECT count(*) FROM events_out JOIN placed USING (src_ip) WHERE placed.ord = geo.ord)
        AS n_events FROM geo""",
    # detection and routing
    "detect_json": f"""WITH {_RAW_CTE} SELECT seq, raw_text FROM raw
        WHERE starts_with(raw_text, '{{') AND json_valid(raw_text)""",
    "detect_cef": f"WITH {_RAW_CTE} SELECT seq, raw_text FROM raw WHERE starts_with(raw_text, 'CEF:')",
    "detect_syslog": f"WITH {_RAW_CTE} SELECT seq, raw_text FROM det WHERE fmt = 'syslog'",
    "detect_format": f"WITH {_RAW_CTE} SELECT seq, fmt AS detected_format FROM det",
    "normalize_all": f"{_ALL} SELECT {_OUTCOME} FROM outcome",
    "parse_errors": f"""{_KNOWN} SELECT raw_event_id, source_name, detected_format, status,
        error_reason FROM outcome JOIN raw ON raw.event_id = raw_event_id
        WHERE status = 'parse_error'""",
    "quarantine": f"""{_ALL} SELECT raw_event_id, source_name, detected_format, status,
        error_reason FROM outcome JOIN raw ON raw.event_id = raw_event_id
        WHERE status = 'parse_error'""",
    # normalisation per format
    "normalize_syslog": _one_format(_SYSLOG_CTE, "n_syslog"),
    "normalize_json": _one_format(_JSON_CTE, "n_json"),
    "normalize_cef": _one_format(_CEF_CTE, "n_cef"),
    "normalize_unknown": _one_format(_unknown_cte("wild"), "n_unknown"),
    "normalize_unknown_two_pass": _one_format(_unknown_cte("wild_final"), "n_unknown"),
    "normalize_unknown_sequential": _one_format(_unknown_cte("wild"), "n_unknown"),
    "normalize_unknown_signatures": _one_format(_unknown_signatures(), "n_unknown").replace(
        "WITH", "WITH RECURSIVE", 1),
    # template mining
    "mine_templates_signatures": f"""WITH RECURSIVE {_RAW_CTE}, {_TOKENS_CTE}, {_SIGNATURES_CTE}
        SELECT seq, leaf, array_to_string(template, ' ') AS template FROM shaped""",
    "template_table_signatures": f"""WITH RECURSIVE {_RAW_CTE}, {_TOKENS_CTE}, {_SIGNATURES_CTE}
        SELECT o.leaf AS leaf_key, array_to_string(any_value(template), ' ') AS template,
          count(*) AS n_signatures, CAST(sum(n_lines) AS BIGINT) AS n_lines
        FROM owners o JOIN shapes s ON s.leaf = o.leaf AND s.leader = o.leader
        GROUP BY o.leaf, o.leader""",
    "tokenize_unknown": f"""WITH {_RAW_CTE}, {_TOKENS_CTE} SELECT seq, len(tokens) AS n_tokens,
        array_to_string(tokens, ' ') AS token_text FROM leafs""",
    "mine_templates": f"""WITH {_RAW_CTE}, {_TOKENS_CTE} SELECT seq, leaf,
        string_agg(CASE WHEN wild THEN '<*>' ELSE tok END, ' ' ORDER BY pos) AS template
        FROM runs GROUP BY 1, 2""",
    "mine_templates_sequential": f"""WITH {_RAW_CTE}, {_TOKENS_CTE} SELECT seq, leaf,
        string_agg(CASE WHEN wild THEN '<*>' ELSE tok END, ' ' ORDER BY pos) AS template
        FROM runs GROUP BY 1, 2""",
    "template_table_text": r"""WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS parts
          FROM documents),
        txt AS (SELECT doc_id * 2147483648 + generate_subscripts(parts, 1) - 1 AS seq,
          regexp_replace(replace(replace(unnest(parts), '|', ' '), '=', ' '),
            '[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+',
            ' ', 'g') AS spaced, trim(unnest(parts), chr(32) || chr(9) || chr(13)) AS line FROM docs),
        split AS (SELECT seq, list_filter(string_split(spaced, ' '), lambda x: x <> '') AS tokens
          FROM txt WHERE line <> ''),
        leafs AS (SELECT seq, tokens, CASE WHEN len(tokens) = 0 THEN '0' ELSE len(tokens) || ' ' ||
          CASE WHEN regexp_matches(tokens[1], '[0-9]') THEN '<*>' ELSE tokens[1] END END AS leaf
          FROM split),
        toks AS (SELECT leaf, unnest(tokens) AS tok, generate_subscripts(tokens, 1) AS pos
          FROM leafs),
        lastly AS (SELECT leaf, pos, CASE WHEN min(tok) <> max(tok) THEN '<*>' ELSE min(tok) END
          AS tok FROM toks GROUP BY 1, 2),
        whole AS (SELECT leaf, string_agg(tok, ' ' ORDER BY pos) AS template FROM lastly GROUP BY 1)
        SELECT leaf AS leaf_key, sha256(coalesce(template, '')) AS template_hash,
          count(*) AS n_lines FROM leafs LEFT JOIN whole USING (leaf) GROUP BY 1, 2""",
    "template_values": f"""WITH {_RAW_CTE}, {_TOKENS_CTE} SELECT seq,
        coalesce(string_agg(tok, ' ' ORDER BY pos) FILTER (wild), '') AS value_text
        FROM runs GROUP BY 1""",
    "classify_tokens": f"""WITH {_RAW_CTE}, {_TOKENS_CTE},
        vals AS (SELECT event_id, pos AS i, tok FROM toks), {_classified("vals")}
        SELECT seq, stamp AS timestamp, src_ip, dst_ip, src_port, dst_port, action FROM cl""",
    "template_table": f"""WITH {_RAW_CTE}, {_TOKENS_CTE},
        lastly AS (SELECT leaf, pos, CASE WHEN min(tok) <> max(tok) THEN '<*>' ELSE min(tok) END
          AS tok, count(*) AS n FROM toks GROUP BY 1, 2)
        SELECT leaf AS leaf_key, CAST(1 AS BIGINT) AS template_id,
        string_agg(tok, ' ' ORDER BY pos) AS template, max(n) AS n_lines FROM lastly GROUP BY 1""",
    # joins and enrichment
    "linked_raw": f"""{_ALL} SELECT normalized_id, {_RAW} FROM events_out
        LEFT JOIN raw ON raw_event_id = event_id""",
    "geo_country": f"""{_ALL}, {_geo_cte()} SELECT normalized_id, src_ip, src_country
        FROM events_out LEFT JOIN placed USING (src_ip)""",
    "geo_country_longest_prefix": f"""{_ALL}, {_geo_cte("-prefix_len")}
        SELECT normalized_id, src_ip, src_country
        FROM events_out LEFT JOIN placed USING (src_ip)""",
    "known_bad": f"{_ALL} SELECT normalized_id, src_ip, {_BAD} AS src_flagged_bad FROM events_out",
    "lossless_audit": f"""{_ALL} SELECT event_id, source_name, raw_text FROM raw
        WHERE event_id NOT IN (SELECT raw_event_id FROM events_out)""",
    "traceability_audit": f"""{_ALL} SELECT
        (SELECT count(*) FROM raw) AS n_raw, (SELECT count(*) FROM events_out) AS n_normalized,
        (SELECT count(*) FROM outcome WHERE status = 'parse_error') AS n_quarantined,
        (SELECT count(*) FROM raw WHERE event_id NOT IN (SELECT raw_event_id FROM outcome)) AS n_lost,
        (SELECT count(*) FROM outcome WHERE raw_event_id NOT IN (SELECT event_id FROM raw))
          AS n_orphans,
        (SELECT count(*) FROM det JOIN outcome ON event_id = raw_event_id
          WHERE fmt <> source_format) AS n_wrong_format""",
    "vocabulary_audit": f"""{_ALL} SELECT
        count(*) FILTER (source_format IS NULL OR source_format NOT IN
            ('syslog', 'json', 'cef', 'unknown')) AS n_bad_source_format,
        count(*) FILTER (action IS NULL OR action NOT IN
            ('allow', 'deny', 'alert', 'drop', 'unknown')) AS n_bad_action,
        count(*) FILTER (severity IS NULL OR severity NOT IN
            ('low', 'medium', 'high', 'critical', 'unknown')) AS n_bad_severity,
        count(*) FILTER (protocol IS NULL OR protocol NOT IN
            ('TCP', 'UDP', 'ICMP', 'UNKNOWN')) AS n_bad_protocol,
        count(*) FILTER (parser_confidence IS NULL OR parser_confidence NOT IN
            ('high', 'low')) AS n_bad_parser_confidence FROM events_out""",
    "duplicate_ids": f"""{_ALL} SELECT normalized_id, count(*) AS n FROM events_out
        GROUP BY 1 HAVING count(*) > 1""",
    # reads
    "all_events": f"{_ALL} SELECT {_EVENT} FROM events_out ORDER BY normalized_at DESC, normalized_id",
    "filter_events": f"""{_ALL} SELECT {_EVENT} FROM events_out
        WHERE source_format = 'json' AND action = 'deny'
        ORDER BY normalized_at DESC, normalized_id""",
    "filter_by_ip": f"""{_ALL} SELECT {_EVENT} FROM events_out
        WHERE src_ip = '10.1.1.20' OR dst_ip = '10.1.1.20'
        ORDER BY normalized_at DESC, normalized_id""",
    "headline": f"""{_ALL} SELECT count(*) AS n_events, count(DISTINCT source_format) AS n_formats
        FROM events_out WHERE action = 'deny'""",
    "parser_path": f"""{_ALL} SELECT count(*) FILTER (parser_confidence <> 'low') AS n_known_format,
        count(*) FILTER (parser_confidence = 'low') AS n_fallback FROM events_out""",
    "run_summary": f"""{_ALL} SELECT detected_format, status, count(*) AS n_lines FROM outcome
        GROUP BY 1, 2 ORDER BY 1, 2""",
    "run_totals": f"""{_ALL} SELECT count(*) AS n_lines,
        count(*) FILTER (status = 'normalized') AS n_normalized,
        count(*) FILTER (status = 'parse_error') AS n_parse_errors FROM outcome""",
    "lines_per_source": f"""WITH {_RAW_CTE} SELECT source_name, count(*) AS n_lines,
        CAST(0 AS BIGINT) AS is_total FROM lines GROUP BY 1
        UNION ALL SELECT NULL, count(*), 1 FROM lines""",
    "enriched_events": f"""{_ALL}, {_geo_cte()}, shown AS (
        SELECT * REPLACE ({_ist("timestamp")} AS timestamp, {_ist("normalized_at")} AS normalized_at),
        src_country, {_BAD} AS src_flagged_bad FROM events_out LEFT JOIN placed USING (src_ip))
        SELECT {", ".join(DISPLAY_COLUMNS)} FROM shown""",
    "event_detail": f"""{_ALL} SELECT event_id, raw_text, source_name, source_format_hint,
        {_ist("ingested_at")} AS ingested_at, {", ".join(
            f"{_ist(c)} AS {c}" if c in ("timestamp", "normalized_at") else c
            for c in NORMALIZED_EVENT_COLUMNS)}
        FROM events_out JOIN raw ON event_id = raw_event_id
        WHERE normalized_id = (SELECT min(normalized_id) FROM events_out)""",
    "raw_by_text": f"""WITH {_RAW_CTE} SELECT event_id, raw_text, source_name FROM raw
        WHERE raw_text = 'CEF:0|Kestrel|cut short'""",
    "ist_display": f"""{_ALL} SELECT normalized_id, timestamp, {_ist("timestamp")} AS timestamp_ist
        FROM events_out""",
    # streaming
    "linked_raw_reingested": f"""{_ALL}, ingests AS (SELECT unnest(['one', 'two']) AS run),
        again AS (SELECT raw.*, sha256(run || chr(31) || sha256(
            source_name || chr(31) || raw.seq || chr(31) || raw_text)) AS own_id FROM raw, ingests)
        SELECT sha256(own_id || 'n') AS normalized_id, own_id AS event_id, raw_text, source_name,
            source_format_hint, ingested_at
        FROM again JOIN events_out ON raw_event_id = event_id""",
    "stream_after_batch": f"""{_ALL} SELECT raw_text, source_format
        FROM events_out JOIN raw ON event_id = raw_event_id""",
    "tail_new_lines": f"WITH {_RAW_CTE} SELECT raw_text FROM lines",
    "stream_unknown_events": f"""{_ALL} SELECT raw_text, {", ".join(
            c for c in NORMALIZED_EVENT_COLUMNS if c not in ("normalized_id", "raw_event_id"))}
        FROM events_out JOIN raw ON event_id = raw_event_id WHERE source_format = 'unknown'""",
    "stream_events": f"""{_ALL} SELECT raw_text, {", ".join(
            c for c in NORMALIZED_EVENT_COLUMNS if c not in ("normalized_id", "raw_event_id"))}
        FROM events_out JOIN raw ON event_id = raw_event_id""",
}

_RUN_OF = "CASE seq % 3 WHEN 0 THEN 'mon' WHEN 1 THEN 'tue' ELSE 'wed' END"
_DAY_OF = ("CASE {0} % 3 WHEN 0 THEN '2024-02-05T08:00:00Z' WHEN 1 THEN '2024-02-06T08:00:00Z' "
           "ELSE '2024-02-07T08:00:00Z' END")
# Templates are mined per run, so only columns that they do not decide are compared.
_THREE_RUNS = _ALL.replace(f"sha256('{RUN}' ||", f"sha256({_RUN_OF} ||")
_DAY_ROWS = f"""{_THREE_RUNS}, dayed AS (
  SELECT normalized_id, {_DAY_OF.format("raw.seq")} AS normalized_at, source_format,
         CASE WHEN source_format <> 'unknown' THEN src_ip END AS src_ip
  FROM events_out JOIN raw ON event_id = raw_event_id)"""
ORACLES["compacted_events"] = f"{_DAY_ROWS} SELECT * FROM dayed"
ORACLES["events_page"] = f"""{_DAY_ROWS},
  last_seen AS (SELECT normalized_id AS id FROM dayed WHERE normalized_at = '2024-02-06T08:00:00Z'
    ORDER BY normalized_id DESC LIMIT 1 OFFSET 100)
  SELECT dayed.* FROM dayed, last_seen
  WHERE normalized_at < '2024-02-06T08:00:00Z'
     OR normalized_at = '2024-02-06T08:00:00Z' AND normalized_id > id
  ORDER BY normalized_at DESC, normalized_id LIMIT 250"""
ORACLES["traceability_audit_incremental"] = ORACLES["traceability_audit"]
