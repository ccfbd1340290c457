"""DuckDB statements for the registered queries, written from the contracts and not from the operators."""

from __future__ import annotations

from beaconry.plans.derive import NOW_MS, RATE, SETTINGS, cte

S = SETTINGS
V = S.vendor
R = "[REDACTED]"

STATEMENTS: dict[str, str] = {}

# White space, the masks and verbs of statement texts, and below the value patterns.
SPACES = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def trim_(x: str) -> str:
    return rf"regexp_replace({x}, '^{SPACES}+|{SPACES}+$', '', 'g')"


def unit(x: str) -> str:
    return f"(('0x' || substr(md5({x}), 1, 8))::UBIGINT / 4294967296.0)"


def normalized(x: str) -> str:
    out = f"coalesce({x}, '')"
    for pattern, to in [
        (r"/\*[\s\S]*?\*/", " "), (r"--[^\n]*", " "), (r"''(?:''''|[^''])*''", "?"),
        (r"\$[a-zA-Z0-9_]*\$[\s\S]*?\$[a-zA-Z0-9_]*\$", "?"), (r"\b\d+(?:\.\d+)?\b", "?"), (SPACES + "+", " "),
    ]:
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    return trim_(out)


def hashed(x: str) -> str:
    h = (
        f"list_reduce(list_prepend(0::HUGEINT, list_transform(string_split({x}, ''), lambda c: ord(c)::HUGEINT)), "
        "lambda h, c: (h * 31 + c) % 4294967296)"
    )
    return f"CASE WHEN {x} = '' THEN '0' ELSE lower(to_base((SELECT CASE WHEN h >= 2147483648 THEN 4294967296 - h ELSE h END FROM (SELECT {h} AS h))::BIGINT, 36)) END"


def verb(x: str) -> str:
    first = f"upper(split_part(regexp_replace({trim_(x)}, '{SPACES}+', ' ', 'g'), ' ', 1))"
    return f"CASE WHEN {first} IN ('SELECT','INSERT','UPDATE','DELETE','BEGIN','COMMIT','ROLLBACK') THEN {first} ELSE 'OTHER' END"


# --- text scrubbing -------------------------------------------------------------------------------

CARD = r"(^|[^0-9-])((?:[0-9][ -]?){12,18}[0-9])($|[^0-9-])"
OCTET = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
G = "[0-9A-Fa-f]{1,4}"
PATTERNS = {
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "ipv4": rf"\b(?:{OCTET}\.){{3}}{OCTET}\b",
}
IPV6_FULL = rf"\b(?:{G}:){{7}}{G}\b"
IPV6_SHORT = [
    rf"(^|[^:.\w])((?:{G}:){{1,7}}:(?:{G})?(?::{G}){{0,6}})($|[^:.\w])",
    rf"(^|[^:.\w])(::(?:{G}:){{0,6}}{G})($|[^:.\w])",
]
LUHN = (
    "list_filter({c}, lambda m: list_sum(list_transform(range(1, length(regexp_replace(m, '[ -]', '', 'g')) + 1), lambda i: "
    "CASE WHEN (length(regexp_replace(m, '[ -]', '', 'g')) - i) % 2 = 1 THEN "
    "(2 * substr(regexp_replace(m, '[ -]', '', 'g'), i, 1)::INT) // 10 + (2 * substr(regexp_replace(m, '[ -]', '', 'g'), i, 1)::INT) % 10 "
    "ELSE substr(regexp_replace(m, '[ -]', '', 'g'), i, 1)::INT END)) % 10 = 0)"
)


def rest(x: str, opted_in: bool) -> str:
    names = ["ssn"] if opted_in else list(PATTERNS)
    for n in names:
        x = f"regexp_replace({x}, '{PATTERNS[n]}', '{R}', 'g')"
    if not opted_in:
        x = f"regexp_replace({x}, '{IPV6_FULL}', '{R}', 'g')"
        for p in IPV6_SHORT:
            for _ in range(2):
                x = rf"regexp_replace({x}, '{p}', '\1{R}\3', 'g')"
    return x


def scrub_ctes(source: str, keys: str, text: str, opted_in: bool = False) -> str:
    """CTEs ending in ``scrubbed(keys, text, out, <hits>)``.

    RE2 has no look-around: candidates come with their delimiters, in two passes, and each valid one
    is replaced between delimiters, twice since neighbours share one.
    """
    one = rf"regexp_replace(t, '(^|[^0-9-])' || m || '($|[^0-9-])', '\1{R}\2', 'g')"
    two = rf"regexp_replace({one}, '(^|[^0-9-])' || m || '($|[^0-9-])', '\1{R}\2', 'g')"
    return f"""
      s0 AS (SELECT {keys}, {text} AS text, length({text}) + length(regexp_replace({text}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) > 16384 AS over FROM {source}),
      s1 AS (SELECT *, regexp_extract_all(text, '{CARD}', 2) AS l1, regexp_replace(text, '{CARD}', '\\1X\\3', 'g') AS t1 FROM s0),
      s2 AS (SELECT *, list_concat(l1, regexp_extract_all(t1, '{CARD}', 2)) AS cands FROM s1),
      s3 AS (SELECT *, {LUHN.format(c='cands')} AS cards FROM s2),
      s4 AS (SELECT *, CASE WHEN len(cards) = 0 THEN text ELSE list_reduce(list_prepend(text, list_distinct(cards)), lambda t, m: {two}) END AS t2 FROM s3),
      scrubbed AS (SELECT *, CASE WHEN over THEN text ELSE {rest('t2', opted_in)} END AS out FROM s4)"""


def plain_scrub(x: str) -> str:
    """For derived text without card numbers."""
    return rest(x, False)


# --- requests -------------------------------------------------------------------------------------

CTX = f"""{cte('request_starts', 'rs')},
  ctx0 AS (SELECT *, string_split(coalesce(h_traceparent, ''), '-') AS p FROM rs),
  ctx1 AS (SELECT *,
     coalesce(h_trace_id, CASE WHEN len(p) >= 4 AND length(p[2]) = 32 THEN p[2] END, md5(request_key)) AS trace_id,
     substr(md5('span:' || request_key), 1, 16) AS span_id,
     coalesce(h_parent, CASE WHEN len(p) >= 4 AND length(p[3]) = 16 THEN p[3] END, '') AS parent_span_id
     FROM ctx0),
  ctx AS (SELECT *, coalesce(h_request_id, h_x_request_id, trace_id) AS request_id,
     coalesce(CASE WHEN len(p) >= 4 AND regexp_full_match(p[4], '[0-9a-fA-F]{{2}}') THEN p[4][2] IN ('1','3','5','7','9','b','d','f','B','D','F') END,
              {unit('trace_id')} < {RATE}) AS sampled,
     CASE WHEN coalesce(url, '') = '' THEN '/' ELSE split_part(url, '?', 1) END AS path,
     coalesce(h_host, hostname, 'unknown') AS host
     FROM ctx1)"""

HTTP = f"""{CTX}, {cte('request_ends', 're')},
  http AS (SELECT c.request_key, upper(method) AS method, host, path, status_code, greatest(ended_ms - started_ms, 0) AS duration_ms,
     started_ms, trace_id, span_id, parent_span_id, request_id, c.user_id
     FROM ctx c JOIN re USING (request_key) WHERE sampled)"""

SCOPES = f"""{cte('scope_base', 'sb')},
  ms AS (SELECT scope_key, forked, kind, ref, region,
     CASE WHEN forked THEN 'u-' || u END AS user_id, CASE WHEN forked THEN 'u' || u || '@example.com' END AS user_email,
     CASE WHEN forked AND severe THEN 'fatal' ELSE 'warning' END AS level,
     CASE WHEN forked AND printed THEN 'fp,' || kind END AS fingerprint FROM sb)"""

SDK = f"sdk.name={S.sdk_name};sdk.version={S.sdk_version}"

# Scope metadata in key order, split where the SDK tags and the user sort in between.
SCOPE_HEAD = "CASE WHEN forked THEN 'context.app={\"v\":\"1\"};extra.api_token=" + R + ";extra.order=' || {order} || ';' ELSE '' END"
SCOPE_TAIL = "CASE WHEN forked THEN 'tag.feature=' || kind || ';tag.region=' || region || ';tag.tier=paid;userEmail=' || user_email || ';userId=' || ms.user_id ELSE 'tag.region=' || region || ';tag.tier=free' END"

STATEMENTS["resolve_trace_context"] = f"WITH {CTX} SELECT request_key, trace_id, request_id, span_id, parent_span_id, sampled FROM ctx"

_own = f"'{V}-trace_id=' || trace_id || ',{V}-request_id=' || request_id || ',{V}-span_id=' || span_id"
STATEMENTS["audit_propagation"] = f"""WITH {CTX} SELECT request_key,
  '00-' || CASE WHEN length(trace_id) = 32 THEN trace_id ELSE md5(request_key) END || '-' || span_id || CASE WHEN sampled THEN '-01' ELSE '-00' END AS expected_traceparent,
  CASE WHEN h_baggage IS NULL THEN '' ELSE 'team=a,k=' || request_key || ',' END || {_own} AS expected_baggage,
  {_own} AS expected_vendor_baggage, trace_id AS expected_trace_id, request_id AS expected_request_id,
  CAST(request_key AS BIGINT) % 5 = 0 AS mismatch FROM ctx"""

_hdr = f"""coalesce(array_to_string(list_filter([
  CASE WHEN h_authorization IS NOT NULL THEN 'authorization: {R}' END, CASE WHEN h_baggage IS NOT NULL THEN 'baggage: ' || h_baggage END,
  CASE WHEN h_host IS NOT NULL THEN 'host: ' || h_host END, CASE WHEN h_traceparent IS NOT NULL THEN 'traceparent: ' || h_traceparent END,
  CASE WHEN h_parent IS NOT NULL THEN 'x-{V}-parent-span-id: ' || h_parent END, CASE WHEN h_request_id IS NOT NULL THEN 'x-{V}-request-id: ' || h_request_id END,
  CASE WHEN h_trace_id IS NOT NULL THEN 'x-{V}-trace-id: ' || h_trace_id END, CASE WHEN h_x_request_id IS NOT NULL THEN 'x-request-id: ' || h_x_request_id END],
  lambda x: x IS NOT NULL), chr(10)), '')"""
STATEMENTS["headers_to_string"] = f"WITH {CTX} SELECT request_key, {_hdr} AS request_headers FROM ctx"

STATEMENTS["build_http_rows"] = f"""WITH {HTTP}, {SCOPES} SELECT h.request_key, 'inbound' AS direction, h.method, h.host, h.path, h.status_code, h.duration_ms,
  h.started_ms AS timestamp, h.trace_id, h.span_id, h.parent_span_id, h.request_id, '{S.environment}' AS environment, '{S.release}' AS release, '{S.service}' AS service,
  coalesce(ms.user_id, h.user_id) AS user_id, {_hdr} AS request_headers,
  {SCOPE_HEAD.replace('{order}', 'ref')} || '{SDK};' || {SCOPE_TAIL} AS metadata
  FROM http h JOIN ms ON ms.scope_key = h.request_key JOIN ctx c ON c.request_key = h.request_key"""

SERVER = f"""SELECT trace_id, span_id, parent_span_id, '{S.component}.request' AS operation, method || ' ' || path AS description,
  CASE WHEN status_code >= 500 THEN 'error' ELSE 'ok' END AS status, duration_ms, started_ms AS start_time_millis, started_ms + duration_ms AS end_time_millis,
  '{S.service}' AS service, '{S.environment}' AS environment, '{S.release}' AS release,
  'component={S.component};method=' || method || ';statusCode=' || status_code AS tags, '{{"host":"' || host || '","path":"' || path || '"}}' AS data FROM http"""
STATEMENTS["build_server_spans"] = f"WITH {HTTP} {SERVER}"

STATEMENTS["url_parts"] = r"""SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)) AS host, regexp_extract(url, '^https?://[^/?#:]*:([0-9]+)', 1) AS port,
  CASE WHEN regexp_replace(url, '^https?://[^/?#]*', '') = '' THEN '/' ELSE split_part(regexp_replace(url, '^https?://[^/?#]*', ''), '?', 1) END AS path FROM pages"""

STATEMENTS["route_stats"] = f"""WITH {HTTP},
  r AS (SELECT *, array_to_string(list_transform(string_split(path, '/'), lambda s, i: CASE WHEN i > 1 AND regexp_full_match(s, '[0-9]+') THEN ':id' ELSE s END), '/') AS route FROM http)
  SELECT '{S.service}' AS service, method, route, count(*) AS requests, count(*) FILTER (status_code >= 500) AS errors,
  round(count(*) FILTER (status_code >= 500) / count(*), 4) AS error_rate, round(quantile_cont(duration_ms, 0.5), 4) AS p50_ms,
  round(quantile_cont(duration_ms, 0.95), 4) AS p95_ms, round(quantile_cont(duration_ms, 0.99), 4) AS p99_ms, max(duration_ms) AS max_ms FROM r GROUP BY ALL"""

# --- SQL text -------------------------------------------------------------------------------------

STATEMENTS["fingerprint_sql"] = f"""WITH {cte('raw_queries', 'q')}, n AS (SELECT sql, {normalized('sql')} AS n FROM q)
  SELECT md5(sql) AS sql_md5, n AS normalized_query, {hashed('n')} AS query_hash, {verb('sql')} AS query_type FROM n"""

DBROWS = f"""{CTX}, {cte('raw_queries', 'q')},
  db AS (SELECT {normalized('sql')} AS normalized_query, {verb('sql')} AS query_type, ended_ms - q.started_ms AS duration_ms, q.started_ms AS timestamp_millis,
    status, substr(error, 1, 500) AS error_message, coalesce("database", '') AS database_name, database_type, ctx.trace_id, ctx.span_id, coalesce("rows", -1) AS rows_affected
    FROM q LEFT JOIN ctx USING (request_key) WHERE NOT orm_owned)"""
STATEMENTS["build_db_rows"] = f"""WITH {DBROWS} SELECT normalized_query, {hashed('normalized_query')} AS query_hash, query_type, duration_ms, timestamp_millis, status,
  md5(error_message) AS error_md5, database_name, database_type, '{S.service}' AS service, '{S.environment}' AS environment, trace_id, span_id, rows_affected FROM db"""
STATEMENTS["query_fingerprint_stats"] = f"""WITH {DBROWS}, g AS (SELECT normalized_query, query_type, database_type, count(*) AS calls, count(*) FILTER (status = 'error') AS errors,
  round(quantile_cont(duration_ms, 0.5), 4) AS p50_ms, round(quantile_cont(duration_ms, 0.95), 4) AS p95_ms, max(duration_ms) AS max_ms, sum(duration_ms)::BIGINT AS total_ms,
  sum(greatest(rows_affected, 0))::BIGINT AS rows_affected, min(timestamp_millis) AS first_seen, max(timestamp_millis) AS last_seen FROM db GROUP BY 1, 2, 3)
  SELECT {hashed('normalized_query')} AS query_hash, * FROM g"""
STATEMENTS["merge_daily_statements"] = f"""SELECT query_hash, normalized_query, query_type, database_type, calls, errors, rows_affected, max_ms, total_ms, first_seen, last_seen, true AS p95_close
  FROM ({STATEMENTS["query_fingerprint_stats"]})"""
STATEMENTS["rows_affected"] = """WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 <> 0 THEN o_custkey % 2 END AS row_count,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 3 END AS affected, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 5 END AS length FROM orders)
  SELECT o_orderkey, coalesce(row_count, -1)::BIGINT AS postgresql, coalesce(affected, length, -1)::BIGINT AS mysql, coalesce(affected, length, -1)::BIGINT AS sqlite FROM c"""
STATEMENTS["stream_fingerprint_stats"] = f"""WITH {DBROWS}, g AS (SELECT (timestamp_millis // 604800000) * 604800000 AS window_ms, normalized_query, query_type, database_type,
  count(*) AS calls, count(*) FILTER (status = 'error') AS errors, max(duration_ms) AS max_ms, sum(duration_ms)::BIGINT AS total_ms FROM db GROUP BY 1, 2, 3, 4)
  SELECT window_ms, {hashed('normalized_query')} AS query_hash, database_type, calls, errors, max_ms, total_ms FROM g"""

# --- privacy --------------------------------------------------------------------------------------

_seq = {"ssn": "t2"}
_seq["email"] = f"regexp_replace({_seq['ssn']}, '{PATTERNS['ssn']}', '{R}', 'g')"
_seq["ipv4"] = f"regexp_replace({_seq['email']}, '{PATTERNS['email']}', '{R}', 'g')"
_seq["ipv6"] = f"regexp_replace({_seq['ipv4']}, '{PATTERNS['ipv4']}', '{R}', 'g')"
_hits = {n: f"CASE WHEN over THEN 0 ELSE len(regexp_extract_all({_seq[n]}, '{PATTERNS[n]}')) END" for n in PATTERNS}
_hits["ipv6"] = f"CASE WHEN over THEN 0 ELSE len(regexp_extract_all({_seq['ipv6']}, '{IPV6_FULL}')) END"
STATEMENTS["scrub_corpus_documents"] = f"""WITH {scrub_ctes('documents', 'doc_id', 'text')} SELECT doc_id, md5(out) AS text_md5, out <> text AS changed,
  (CASE WHEN over THEN 0 ELSE len(cards) END)::INT AS card_hits, {', '.join(f'({v})::INT AS {k}_hits' for k, v in _hits.items())} FROM scrubbed"""
STATEMENTS["stream_scrubbed_documents"] = f"WITH {scrub_ctes('documents', 'doc_id', 'text')} SELECT doc_id, md5(out) AS text_md5 FROM scrubbed"
STATEMENTS["scrub_text_conversations"] = f"WITH {scrub_ctes('conversations', 'conv_id, turn', 'text')} SELECT conv_id, turn, md5(out) AS text_md5 FROM scrubbed"
STATEMENTS["scrub_text_pages_opted_in"] = f"WITH {scrub_ctes('pages', 'page_id', 'html', True)} SELECT page_id, md5(out) AS html_md5 FROM scrubbed"

STATEMENTS["redact_keys"] = f"""SELECT event_id, '{R}' AS password, '{R}' AS api_key, event_type, '{R}' AS jwt, event_type AS note, '{R}' AS cvv, event_type AS kind,
  'Credit-Card={R};accessToken=' || event_id || ';myInternalRef={R};tokens=' || event_type || ';user.token={R};username=' || event_id AS bag FROM events"""
STATEMENTS["redact_keys_json"] = f"""WITH {cte('envelopes', 'e')} SELECT envelope_id, CASE path WHEN '/ingest/v1/logs' THEN replace(payload, '"password":"p"', '"password":"{R}"')
  WHEN '/ingest/v1/errors' THEN regexp_replace(replace(payload, '"token":"t"', '"token":"{R}"'), '"exceptionClass":"E"', '"exceptionClass":"{R}"')
  WHEN '/ingest/v1/sessions/start' THEN regexp_replace(payload, '"sessionId":"[^"]*"', '"sessionId":"{R}"') WHEN '/ingest/v1/sessions/end' THEN regexp_replace(payload, '"sessionId":"[^"]*"', '"sessionId":"{R}"')
  WHEN '/elsewhere' THEN '{{"x":"{R}"}}' ELSE payload END AS payload FROM e"""

_mail = "'u' || user_id || '@example.com'"
_said = f"'mail {R} ip ' || CASE WHEN user_id % 300 < 256 THEN '{R}' ELSE '10.0.0.' || (user_id % 300) END || ' peer {R} ssn {R}'"
STATEMENTS["scrub_values"] = f"""SELECT event_id, {_said} AS message, {_mail} AS user_email, '4111111111111111 ' || event_type AS release,
  'extra.note=' || {_said} || ';plain=' || event_type || ';sdk.version=1.2.3.4;userId=' || {_mail} AS metadata,
  ' at 10.0.0.1 ' || {_mail} AS frame, '{R}' AS crumb, 'to={R};url=' || {_mail} AS crumb_data FROM events"""

_err = cte("request_errors", "er")
_clean = f"'failed for {R} from {R}'"
STATEMENTS["scrub_payload"] = f"""WITH {CTX}, {_err} SELECT er.request_key, {_clean} AS message, 's-' || er.request_key AS session_id, trace_id, coalesce(replace(error_stack, chr(10), '|'), '') AS stack,
  'db.password={R};httpMethod=' || method || ';httpPath=' || path || ';note=' || {_clean} || ';{SDK};service={S.service}' AS metadata FROM er JOIN ctx USING (request_key)"""
STATEMENTS["scrub_payload_json"] = f"""WITH {_err} SELECT request_key, '{{"message":"' || {_clean} || '","sessionId":"' || request_key || '","metadata":{{"password":"{R}","note":"' || {_clean} || '","userEmail":"' || error_message
  || '"}},"stackTrace":["' || error_message || '"],"notes":["' || {_clean} || '","card {R}"]}}' AS payload FROM er"""

# --- predicates -----------------------------------------------------------------------------------

STATEMENTS["sample_traces"] = f"WITH {cte('request_starts', 'rs')} SELECT request_key FROM rs WHERE {unit('md5(user_id)')} < 0.3"
STATEMENTS["sample_errors"] = f"""WITH {_err} SELECT request_key FROM er WHERE {unit("'error:' || request_key")} < 0.4"""
STATEMENTS["min_level"] = f"WITH {cte('raw_logs', 'l')} SELECT seq, level FROM l WHERE level IN ('warn', 'error', 'fatal')"
STATEMENTS["non_persistable"] = f"WITH {cte('envelopes', 'e')} SELECT envelope_id, path LIKE '/ingest/v1/sessions/%' AS non_persistable FROM e"
STATEMENTS["classify_failure"] = f"""WITH {cte('delivery_attempts', 'a')} SELECT http_status, CASE WHEN http_status = 200 THEN NULL WHEN http_status = 400 THEN 'permanent' ELSE 'retryable' END AS failure, count(*) AS n FROM a GROUP BY 1, 2"""
STATEMENTS["drop_expired"] = f"WITH {cte('envelopes', 'e')} SELECT envelope_id, ts FROM e WHERE ts >= {NOW_MS} - 20 * 86400000::BIGINT"
STATEMENTS["before_send"] = f"""WITH {cte('envelopes', 'e')} SELECT envelope_id, path, CASE WHEN path = '/elsewhere' THEN payload ELSE replace(payload, 'GET', 'HEAD') END AS payload FROM e WHERE path NOT LIKE '/ingest/v1/sessions/%'"""

# --- outbound -------------------------------------------------------------------------------------

_CALLS = """CL,
  cv AS (SELECT *, call_key || ':' || at_ms AS ck,
     CASE l_host WHEN 0 THEN 'ingest.example.com' WHEN 1 THEN 'svc.internal' WHEN 2 THEN 'api.example.com' WHEN 3 THEN '' WHEN 4 THEN '10.0.0.1' ELSE '1.2.3.4' END AS host,
     CASE l_host WHEN 1 THEN '8080' WHEN 4 THEN '9000' WHEN 5 THEN '9000' ELSE '' END AS port,
     CASE WHEN coalesce(path, '') = '' THEN '/' ELSE split_part(path, '?', 1) END AS cpath, upper(coalesce(method, 'GET')) AS cmethod
     FROM (SELECT *, CASE origin WHEN 'http://Ingest.Example.com' THEN 0 WHEN 'http://svc.internal:8080' THEN 1 WHEN 'https://api.example.com:443' THEN 2 WHEN '10.0.0.1:9000/x' THEN 4 WHEN 'http://1.2.3.4:9000' THEN 5 ELSE 3 END AS l_host FROM cl)),
  heard AS (
     SELECT call_key, at_ms, seq, 'create' AS kind, at_ms AS started_ms, coalesce(trace_id, md5('call:' || ck)) AS trace_id, CASE WHEN trace_id IS NULL THEN '' ELSE parent_span_id END AS parent_span_id,
       CASE WHEN trace_id IS NULL THEN md5('call:' || ck) ELSE request_id END AS request_id, substr(md5('call:' || ck), 1, 16) AS span_id, cmethod AS method, host, port, cpath AS path, NULL::INT AS status_code
       FROM cv WHERE coalesce(sampled, true) AND host <> 'ingest.example.com'
     UNION ALL SELECT call_key, at_ms + took_ms, seq + 1, outcome, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, status_code FROM cv WHERE outcome IS NOT NULL AND host <> 'ingest.example.com'),
  done AS (SELECT *, lead({'kind': kind, 'at_ms': at_ms, 'status_code': status_code}) OVER (PARTITION BY call_key ORDER BY at_ms, seq) AS f FROM heard),
  paired AS (SELECT c.call_key, c.started_ms, c.trace_id, c.parent_span_id, c.request_id, c.span_id, c.method, c.host, c.port, c.path, c.f.at_ms AS ended_ms,
     CASE WHEN c.f.kind = 'error' THEN 0 ELSE coalesce(c.f.status_code, 0) END AS status_code,
     CASE WHEN c.f.kind = 'error' OR c.f.status_code >= 500 THEN 'error' ELSE 'ok' END AS status
     FROM done c WHERE c.kind = 'create' AND c.f.kind <> 'create')"""
CALLS = _CALLS.replace("CL,", cte("call_lines", "cl") + ",", 1)
STATEMENTS["pair_outbound_calls"] = f"WITH {CALLS} SELECT * FROM paired"
STATEMENTS["build_outbound_rows"] = f"""WITH {CALLS} SELECT call_key, 'outbound' AS direction, method, CASE WHEN host = '' THEN 'unknown' ELSE host END AS host, path, status_code, ended_ms - started_ms AS duration_ms,
  started_ms AS timestamp, trace_id, span_id, parent_span_id, request_id, '{S.environment}' AS environment, '{S.release}' AS release, '{S.service}' AS service, '' AS request_headers, '{SDK}' AS metadata FROM paired"""
STATEMENTS["build_client_spans"] = f"""WITH {CALLS} SELECT trace_id, span_id, parent_span_id, 'http.client' AS operation, method || ' ' || host || path AS description, status, ended_ms - started_ms AS duration_ms,
  started_ms AS start_time_millis, ended_ms AS end_time_millis, '{S.service}' AS service, '{S.environment}' AS environment, '{S.release}' AS release,
  'component=undici;http.host=' || host || ';method=' || method || ';statusCode=' || status_code AS tags, '{{"host":"' || host || '","port":"' || port || '","path":"' || path || '"}}' AS data FROM paired"""
STATEMENTS["stream_paired_calls"] = f"""WITH {_CALLS.replace("CL,", cte("single_calls", "cl") + ",", 1)}
  SELECT call_key, status_code, status, host, port, path, method, trace_id, request_id, started_ms, ended_ms FROM paired"""
STATEMENTS["stream_reused_calls"] = f"""WITH {CALLS} SELECT * FROM paired
  WHERE ended_ms - started_ms <= 3600000 AND ended_ms < (SELECT max(at_ms) FROM heard) - 3600000"""
STATEMENTS["propagated_headers"] = f"""WITH {cte('call_lines', 'cl')}, c AS (SELECT *, md5('call:' || call_key || ':' || at_ms) AS g, seq % 20 = 0 AS carried FROM cl),
  x AS (SELECT *, coalesce(trace_id, g) AS t, CASE WHEN trace_id IS NULL THEN g ELSE request_id END AS r, substr(g, 1, 16) AS s FROM c)
  SELECT call_key, seq, at_ms, CASE WHEN NOT carried THEN '00-' || t || '-' || s || CASE WHEN coalesce(sampled, true) THEN '-01' ELSE '-00' END END AS add_traceparent,
  '{V}-trace_id=' || t || ',{V}-request_id=' || r || ',{V}-span_id=' || s AS add_baggage, t AS add_trace_id, CASE WHEN NOT carried THEN r END AS add_request_id FROM x"""
STATEMENTS["exclude_ingest_host"] = f"""WITH {CALLS}, u AS (SELECT lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)) AS host FROM pages)
  SELECT host, count(*) AS n FROM cv WHERE host <> 'ingest.example.com' GROUP BY 1 UNION ALL SELECT host, count(*) FROM u WHERE host <> 'm.therou.example.com' GROUP BY 1"""

# --- errors and scopes ----------------------------------------------------------------------------

ERRORS = f"""{CTX}, {_err},
  errs AS (SELECT er.request_key, seq, coalesce(error_name, 'Error') AS exception_class, error_message AS message, coalesce(replace(error_stack, chr(10), '|'), '') AS stack_trace,
    trace_id, span_id, parent_span_id, request_id, method, path FROM er JOIN ctx USING (request_key))"""
_id = f"'{S.environment}' AS environment, '{S.release}' AS release, '{S.sdk_name}' AS sdk_name, '{S.sdk_version}' AS sdk_version, '{S.platform}' AS platform"
STATEMENTS["build_error_rows"] = f"""WITH {ERRORS} SELECT request_key, exception_class, message, stack_trace, 'error' AS level, {_id}, trace_id, span_id, parent_span_id, request_id,
  'httpMethod=' || method || ';httpPath=' || path || ';{SDK};service={S.service}' AS metadata FROM errs"""
STATEMENTS["build_error_rows_in_sessions"] = f"""WITH {ERRORS} SELECT request_key, seq, exception_class, trace_id,
  CASE WHEN request_key::BIGINT % 3 <> 0 THEN 's-' || request_key END AS session_id FROM errs"""
STATEMENTS["stamp_breadcrumbs"] = f"""WITH {cte('session_events', 'se')} SELECT seq, CASE WHEN seq % 3 = 0 THEN '2020-01-01T00:00:00.000Z'
  ELSE strftime(make_timestamp(at_ms * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END AS timestamp FROM se"""
STATEMENTS["build_message_rows"] = f"""SELECT conv_id || '-' || turn AS scope_key, 'Message' AS exception_class, md5(text) AS message, 0 AS stack_trace, CASE WHEN role = 'user' THEN 'warning' ELSE 'info' END AS level, {_id},
  '{SDK};service={S.service}' AS metadata FROM conversations"""
STATEMENTS["build_manual_rows"] = f"""WITH {_err} SELECT request_key AS scope_key, coalesce(error_name, 'Error') AS exception_class, error_message AS message, CASE WHEN error_stack IS NULL THEN 0 ELSE 2 END AS stack_trace,
  CASE WHEN seq % 6 = 0 THEN 'fatal' ELSE 'error' END AS level, {_id}, 'k=' || request_key || ';{SDK};service=over' AS metadata, 's' || request_key AS session_id FROM er"""
STATEMENTS["merge_scopes"] = f"""WITH {SCOPES} SELECT scope_key, user_id, user_email, level, fingerprint, CASE WHEN forked THEN 'feature=' || kind || ';region=' || region || ';tier=paid' ELSE 'region=' || region || ';tier=free' END AS tags,
  CASE WHEN forked THEN 'api_token=secret;order=' || ref ELSE '' END AS extras, CASE WHEN forked THEN '{{"app":{{"v":"1"}}}}' END AS contexts, CASE WHEN forked THEN 'a' || ref || ',a' || ref || ',b' || ref ELSE 'a' || ref END AS crumbs FROM ms"""
STATEMENTS["merge_scopes_deduped"] = f"WITH {SCOPES} SELECT scope_key, CASE WHEN forked THEN 'a' || ref || ',b' || ref ELSE 'a' || ref END AS crumbs FROM ms"
STATEMENTS["apply_scope"] = f"""WITH {ERRORS}, {SCOPES} SELECT request_key AS scope_key,
  {SCOPE_HEAD.replace("' || {order} || ';'", R + ";'")} || 'httpMethod=' || method || ';httpPath=' || path || ';{SDK};service={S.service};' || {SCOPE_TAIL} AS metadata,
  ms.level, ms.fingerprint, ms.user_id, CASE WHEN forked THEN 3 ELSE 1 END AS crumbs FROM errs JOIN ms ON ms.scope_key = request_key"""
STATEMENTS["group_errors"] = f"""WITH {ERRORS}, {SCOPES}, g AS (SELECT coalesce(replace(ms.fingerprint, ',', chr(31)), exception_class || chr(31) || trim(regexp_replace(message, '[0-9]+', '?', 'g'), ' ')) AS group_key, ms.user_id, seq FROM errs JOIN ms ON ms.scope_key = request_key)
  SELECT group_key, count(*) AS count, count(DISTINCT user_id) AS users, count(DISTINCT seq % 5) AS releases, min(seq) * 1000 AS first_seen, max(seq) * 1000 AS last_seen FROM g GROUP BY 1"""
_last = lambda op: f"SELECT scope_key, arg_max(struct_pack(seq := seq, value := value, u := user_ref, f := print_ref), seq) AS x FROM o WHERE op = '{op}' GROUP BY 1"
_bag = lambda op, v, extra="": (
    f"SELECT scope_key, string_agg(name || '=' || v, ';' ORDER BY name) AS s FROM (SELECT scope_key, name, arg_max({v}, seq) FILTER (true) AS v, max(seq) AS q FROM "
    f"(SELECT scope_key, name, seq, coalesce({v}, chr(1)) AS {v} FROM o WHERE op = '{op}') GROUP BY 1, 2) JOIN cleared USING (scope_key) WHERE q > c AND v <> chr(1) GROUP BY 1"
)
STATEMENTS["apply_scope_ops"] = f"""WITH {cte('scope_ops', 'o')}, cleared AS (SELECT scope_key, coalesce(max(seq) FILTER (op = 'clear'), -1) AS c FROM o GROUP BY 1),
  us AS ({_last('set_user')}), lv AS ({_last('set_level')}), fp AS ({_last('set_fingerprint')}), tg AS ({_bag('set_tag', 'value')}), ex AS ({_bag('set_extra', 'value')}), cx AS ({_bag('set_context', 'context_ref')}),
  cr AS (SELECT scope_key, string_agg(value, ',' ORDER BY seq) AS s FROM (SELECT scope_key, value, seq, row_number() OVER (PARTITION BY scope_key ORDER BY seq DESC) AS n FROM o JOIN cleared USING (scope_key) WHERE op = 'add_breadcrumb' AND seq > c) WHERE n <= 50 GROUP BY 1)
  SELECT scope_key, CASE WHEN us.x.seq > c THEN us.x.u END AS user_id, CASE WHEN lv.x.seq > c THEN lv.x.value END AS level, CASE WHEN fp.x.seq > c THEN nullif(fp.x.f, '') END AS fingerprint,
  coalesce(tg.s, '') AS tags, coalesce(ex.s, '') AS extras, coalesce(cx.s, '') AS contexts, coalesce(cr.s, '') AS crumbs
  FROM cleared LEFT JOIN us USING (scope_key) LEFT JOIN lv USING (scope_key) LEFT JOIN fp USING (scope_key) LEFT JOIN tg USING (scope_key) LEFT JOIN ex USING (scope_key) LEFT JOIN cx USING (scope_key) LEFT JOIN cr USING (scope_key)"""
STATEMENTS["overlay_maps"] = """SELECT p_partkey AS part, CASE p_partkey % 3 WHEN 0 THEN 'k0=over' || p_partkey || ';only=' || p_partkey
  ELSE 'k0=' || p_partkey || ';k' || (p_partkey % 3) || '=over' || p_partkey || ';only=' || p_partkey END AS m FROM part"""
STATEMENTS["attach_breadcrumbs"] = """WITH c AS (SELECT user_id, event_id, event_type || event_id AS m, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE event_type <> 'error'),
  e AS (SELECT x.user_id, x.event_id, (SELECT count(*) FROM c WHERE c.user_id = x.user_id AND c.event_id < x.event_id) AS k FROM events x WHERE event_type = 'error')
  SELECT e.event_id AS error_id, CASE WHEN e.k = 0 THEN NULL ELSE least(e.k, 50) END::INT AS n, md5(string_agg(c.m, ',' ORDER BY c.n)) AS crumbs_md5
  FROM e LEFT JOIN c ON c.user_id = e.user_id AND c.n <= e.k AND c.n > e.k - 50 GROUP BY e.event_id, e.k"""
STATEMENTS["request_breadcrumbs"] = f"""WITH {CTX} SELECT request_key AS scope_key, 'http' AS type, 'http.server' AS category, upper(method) || ' ' || path AS message, 'info' AS level,
  'host=' || host || ';method=' || upper(method) || ';path=' || path || ';requestId=' || request_id AS data, strftime(make_timestamp(started_ms * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS timestamp, started_ms FROM ctx"""

# --- logs, releases, sessions ---------------------------------------------------------------------

LOGS = f"""{CTX}, {cte('raw_logs', 'rl')},
  l0 AS (SELECT rl.*, ctx.trace_id, ctx.span_id, ctx.request_id,
    CASE WHEN NOT has_error OR arg_kind NOT IN ('error', 'object') THEN false WHEN arg_kind = 'object' AND error_key = 'error' AND m_err IS NOT NULL THEN false ELSE true END AS has FROM rl JOIN ctx USING (request_key) WHERE arg_kind IS NOT NULL),
  l1 AS (SELECT *, coalesce(nullif(CASE WHEN arg_kind IN ('error', 'object') THEN coalesce(message, '') ELSE coalesce(arg_text, '') END, ''), CASE WHEN has THEN error_message END, '') AS said,
    has AND level IN ('error', 'fatal') AS promoted FROM l0),
  logs AS (SELECT level AS source_level, CASE WHEN level = 'trace' THEN 'debug' ELSE level END AS level, {plain_scrub('said')} AS message, trace_id, span_id, request_id, request_key, seq, promoted,
    coalesce(error_name, 'Error') AS error_type, {plain_scrub('error_message')} AS error_text, error_stack, arg_kind, m_err, m_note FROM l1)"""
_log_meta = f"""array_to_string(list_filter([
  CASE WHEN arg_kind = 'object' AND m_err IS NOT NULL THEN 'err=' || m_err END,
  CASE WHEN promoted THEN 'error.message=' || error_text END,
  CASE WHEN promoted AND error_stack IS NOT NULL THEN 'error.stackTrace=["TypeError: boom"," at h ({R}:' || request_key || ')"]' END,
  CASE WHEN promoted THEN 'error.type=' || error_type END,
  CASE WHEN arg_kind = 'object' THEN 'note=' || {plain_scrub('m_note')} END,
  'sdk.name={S.sdk_name}', CASE WHEN arg_kind = 'object' THEN 'sdk.version=over' ELSE 'sdk.version={S.sdk_version}' END,
  CASE WHEN arg_kind = 'object' THEN 'user_email=kept@example.com' END], lambda x: x IS NOT NULL), ';')"""
STATEMENTS["build_log_rows"] = f"""WITH {LOGS} SELECT level, message, '{S.service}' AS service, '{S.environment}' AS environment, '{S.release}' AS release, trace_id, span_id, request_id, {_log_meta} AS metadata FROM logs WHERE source_level <> 'trace'"""

_rel = " ".join(
    f"WHEN {trim_(f'coalesce({c}, {chr(39)*2})')} <> '' THEN {trim_(c)}" for c in ["explicit", *[f"env{i}" for i in range(1, 8)]]
)
STATEMENTS["resolve_releases"] = f"""WITH {cte('deployments', 'd')} SELECT deployment, CASE {_rel} WHEN NOT auto_detect THEN '' WHEN trim(coalesce(git_describe, '')) <> '' THEN trim(git_describe)
  WHEN git_sha IS NOT NULL THEN trim(git_sha) || CASE WHEN trim(coalesce(git_status, '')) <> '' THEN '-dirty' ELSE '' END ELSE version END AS release FROM d"""
STATEMENTS["register_releases"] = f"""WITH {cte('registrations', 'r')} SELECT DISTINCT rtrim(host, '/') AS host, api_key, release AS version, CASE WHEN coalesce(environment, '') = '' THEN 'production' ELSE environment END AS environment,
  '{S.sdk_name}/{S.sdk_version}' AS author, 'Registered automatically at runtime' AS message FROM r WHERE api_key <> '' AND release <> ''"""

SESSIONS = f"""{cte('session_events', 'se')},
  st AS (SELECT session_id, min(seq) AS s FROM se WHERE kind = 'start' GROUP BY 1),
  en AS (SELECT se.session_id, min(seq) AS e FROM se JOIN st USING (session_id) WHERE kind = 'end' AND seq > s GROUP BY 1),
  mx AS (SELECT se.session_id, max(CASE kind WHEN 'error' THEN 1 WHEN 'abnormal' THEN 2 WHEN 'crash' THEN 3 ELSE 0 END) AS r FROM se JOIN st USING (session_id) LEFT JOIN en USING (session_id) WHERE seq > s AND (e IS NULL OR seq < e) GROUP BY 1),
  fold AS (SELECT x.session_id, a.release, a.environment, a.user_id, a.platform, a.at_ms AS started_ms, b.at_ms AS ended_ms, greatest(b.at_ms - a.at_ms, 0) AS duration_ms,
    coalesce(b.final_status, CASE coalesce(r, 0) WHEN 0 THEN 'ok' WHEN 1 THEN 'errored' WHEN 2 THEN 'abnormal' ELSE 'crashed' END) AS status, b.seq IS NOT NULL AS ended
    FROM (SELECT session_id, s, e, r FROM st LEFT JOIN en USING (session_id) LEFT JOIN mx USING (session_id)) x JOIN se a ON a.seq = s LEFT JOIN se b ON b.seq = e)"""
STATEMENTS["fold_sessions"] = f"""WITH {SESSIONS} SELECT session_id, release, environment, user_id, platform, started_ms, ended_ms, CASE WHEN ended THEN duration_ms END AS duration_ms, status, ended FROM fold"""
STATEMENTS["stream_compacted_sessions"] = STATEMENTS["close_sessions"] = STATEMENTS["fold_sessions"]
STATEMENTS["stream_sessions"] = f"""WITH {SESSIONS} SELECT session_id, release, environment, user_id, started_ms, ended_ms, CASE WHEN ended THEN duration_ms END AS duration_ms, status, ended FROM fold"""
STATEMENTS["session_start_rows"] = f"WITH {SESSIONS} SELECT session_id, release, environment, user_id, '{S.sdk_name}' AS sdk_name, '{S.sdk_version}' AS sdk_version, platform FROM fold WHERE release <> ''"
STATEMENTS["session_end_rows"] = f"WITH {SESSIONS} SELECT session_id, duration_ms, status FROM fold WHERE release <> '' AND ended"
STATEMENTS["crash_free_rates"] = f"""WITH {SESSIONS}, x AS (SELECT *, ended AND status = 'crashed' AS crashed FROM fold WHERE release <> '')
  SELECT release, environment, count(*) AS sessions, count(*) FILTER (crashed) AS crashed_sessions, count(DISTINCT user_id) AS users, count(DISTINCT user_id) FILTER (crashed) AS crashed_users,
  round(1 - count(*) FILTER (crashed) / count(*), 6) AS crash_free_sessions, CASE WHEN count(DISTINCT user_id) > 0 THEN round(1 - count(DISTINCT user_id) FILTER (crashed) / count(DISTINCT user_id), 6) END AS crash_free_users
  FROM x GROUP BY ROLLUP (release, environment)"""
STATEMENTS["merge_daily_sessions"] = f"""WITH {SESSIONS}, x AS (SELECT *, ended AND status = 'crashed' AS crashed FROM fold WHERE release <> '')
  SELECT release, environment, count(*) AS sessions, count(*) FILTER (crashed) AS crashed_sessions, round(1 - count(*) FILTER (crashed) / count(*), 6) AS crash_free_sessions, true AS users_close
  FROM x GROUP BY 1, 2"""
STATEMENTS["crash_free_rates_by_day"] = f"""WITH {SESSIONS}, x AS (SELECT *, ended AND status = 'crashed' AS crashed, strftime(make_timestamp(started_ms * 1000), '%Y-%m-%d') AS day FROM fold WHERE release <> '')
  SELECT release, day, count(*) AS sessions, count(*) FILTER (crashed) AS crashed_sessions, count(DISTINCT user_id) AS users, count(DISTINCT user_id) FILTER (crashed) AS crashed_users,
  round(1 - count(*) FILTER (crashed) / count(*), 6) AS crash_free_sessions, CASE WHEN count(DISTINCT user_id) > 0 THEN round(1 - count(DISTINCT user_id) FILTER (crashed) / count(DISTINCT user_id), 6) END AS crash_free_users
  FROM x GROUP BY ALL"""
STATEMENTS["reconcile_sessions"] = f"""WITH {SESSIONS}, w AS (SELECT session_id, max(CASE WHEN kind = 'crash' THEN 3 ELSE 1 END) AS r FROM se WHERE kind IN ('error', 'crash') GROUP BY 1)
  SELECT session_id, duration_ms, CASE greatest(CASE status WHEN 'ok' THEN 0 WHEN 'errored' THEN 1 WHEN 'abnormal' THEN 2 ELSE 3 END, coalesce(r, 0)) WHEN 0 THEN 'ok' WHEN 1 THEN 'errored' WHEN 2 THEN 'abnormal' ELSE 'crashed' END AS status
  FROM fold LEFT JOIN w USING (session_id) WHERE release <> '' AND ended"""

# --- envelopes ------------------------------------------------------------------------------------

ENV = cte("envelopes", "e")
STATEMENTS["parse_envelopes"] = f"""WITH {ENV}, w AS (SELECT *, '{{"path":"' || path || '","payload":' || payload || ',"ts":' || ts || '}}' AS whole, CASE WHEN seq % 31 = 0 THEN 1 WHEN seq % 37 = 0 THEN 2 WHEN seq % 41 = 0 THEN 3 ELSE 0 END AS bad FROM e WHERE seq % 43 <> 0)
  SELECT file_name, CASE WHEN bad = 0 THEN path END AS path, CASE WHEN bad = 0 THEN payload END AS payload, CASE WHEN bad = 0 THEN ts END AS ts,
  CASE bad WHEN 1 THEN 10 WHEN 2 THEN strlen(regexp_replace(whole, '"path":"[^"]*"', '"path":5', 'g')) WHEN 3 THEN strlen(whole) - length(ts::VARCHAR) + 6 ELSE strlen(whole) END AS size, bad = 0 AS accepted FROM w"""
STATEMENTS["read_envelopes"] = STATEMENTS["parse_envelopes"].replace("bad = 0 AS accepted", "CASE bad WHEN 1 THEN 'json' WHEN 2 THEN 'path' WHEN 3 THEN 'ts' END AS reason")
STATEMENTS["read_envelopes_since"] = f"SELECT file_name, path, ts FROM ({STATEMENTS['parse_envelopes']}) WHERE accepted AND file_name >= '{NOW_MS - 5 * 86_400_000}'"
STATEMENTS["write_envelopes"] = f"""WITH {ENV} SELECT path, CASE path WHEN '/ingest/v1/logs' THEN replace(payload, '"password":"p"', '"password":"{R}"') WHEN '/ingest/v1/errors' THEN replace(payload, '"token":"t"', '"token":"{R}"')
  WHEN '/ingest/v1/sessions/start' THEN regexp_replace(payload, '"sessionId":"[^"]*"', '"sessionId":"{R}"') WHEN '/ingest/v1/sessions/end' THEN regexp_replace(payload, '"sessionId":"[^"]*"', '"sessionId":"{R}"') ELSE payload END AS payload, ts FROM e"""
STATEMENTS["drain_stream"] = STATEMENTS["write_envelopes"] + """ WHERE seq % 31 <> 0 AND seq % 37 <> 0 AND seq % 41 <> 0 AND seq % 43 <> 0
  AND path NOT LIKE '/ingest/v1/sessions/%' AND strlen(payload) % 3 = 2"""
STATEMENTS["route_envelopes"] = f"WITH {ENV} SELECT envelope_id, CASE WHEN path = '/elsewhere' THEN 'unknown' ELSE path END AS route FROM e"
_req = f"""WITH {ENV}, x AS (SELECT envelope_id, CASE WHEN path = '/ingest/v1/http-requests' THEN unnest(json_extract(payload, '$.requests[*]')) END AS r FROM e WHERE path = '/ingest/v1/http-requests')
  SELECT KEYS r->>'method' AS method, r->>'path' AS path, (r->>'statusCode')::INT AS status_code, r->>'traceId' AS trace_id FROM x"""
STATEMENTS["build_envelopes"] = f"""WITH {HTTP} SELECT request_key, 'inbound' AS direction, method, path, status_code, strftime(make_timestamp(started_ms * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS timestamp,
  trace_id, parent_span_id, user_id, '{SDK}' AS metadata FROM http"""
STATEMENTS["flatten_requests"] = _req.replace("KEYS", "envelope_id,")
STATEMENTS["flatten_others"] = f"""WITH {ENV}
  SELECT envelope_id, 'spans' AS kind, r->>'traceId' AS v0, r->>'durationMs' AS v1 FROM (SELECT envelope_id, unnest(json_extract(payload, '$.spans[*]')) AS r FROM e WHERE path = '/ingest/v1/spans')
  UNION ALL SELECT envelope_id, 'db_queries', r->>'normalizedQuery', r->>'durationMs' FROM (SELECT envelope_id, unnest(json_extract(payload, '$.queries[*]')) AS r FROM e WHERE path = '/ingest/v1/db')
  UNION ALL SELECT envelope_id, 'errors', payload->>'exceptionClass', payload->>'message' FROM e WHERE path = '/ingest/v1/errors'
  UNION ALL SELECT envelope_id, 'releases', payload->>'version', payload->>'environment' FROM e WHERE path = '/ingest/v1/releases'
  UNION ALL SELECT envelope_id, 'session_starts', payload->>'sessionId', payload->>'release' FROM e WHERE path = '/ingest/v1/sessions/start'
  UNION ALL SELECT envelope_id, 'session_ends', payload->>'sessionId', payload->>'durationMs' FROM e WHERE path = '/ingest/v1/sessions/end'
  UNION ALL SELECT envelope_id, 'logs', payload->>'message', 'n=x;password=p' FROM e WHERE path = '/ingest/v1/logs'"""
STATEMENTS["write_tables"] = f"""SELECT kind, v0, CASE WHEN kind <> 'logs' THEN v1 END AS v1 FROM ({STATEMENTS["flatten_others"]})
  UNION ALL SELECT 'http_requests', method, trace_id FROM ({STATEMENTS["flatten_requests"]})
  UNION ALL SELECT 'rejected', path, reason FROM (WITH {ENV} SELECT path, CASE WHEN path = '/elsewhere' THEN 'path'
    WHEN path = '/ingest/v1/http-requests' AND json_extract(payload, '$.requests') IS NULL OR path = '/ingest/v1/spans' AND json_extract(payload, '$.spans') IS NULL
      OR path = '/ingest/v1/db' AND json_extract(payload, '$.queries') IS NULL THEN 'rows' END AS reason FROM e) WHERE reason IS NOT NULL"""
STATEMENTS["write_live_tables"] = STATEMENTS["write_live_tables_once"] = STATEMENTS["write_tables"]
STATEMENTS["pack_batches"] = f"""WITH {ENV}, n AS (SELECT *, row_number() OVER (PARTITION BY spool, path ORDER BY seq) - 1 AS k FROM e),
  m AS (SELECT spool, path, k // 7 AS batch, k, CASE path WHEN '/ingest/v1/http-requests' THEN 'requests' WHEN '/ingest/v1/spans' THEN 'spans' ELSE 'queries' END AS field,
    regexp_extract(payload, '^.."?(?:requests|spans|queries)":\\[(.*)\\].$', 1) AS body FROM n WHERE path IN ('/ingest/v1/http-requests', '/ingest/v1/spans', '/ingest/v1/db')),
  g AS (SELECT spool, path, batch, field, count(*) AS envelopes, coalesce(string_agg(body, ',' ORDER BY k) FILTER (body <> ''), '') AS body FROM m GROUP BY ALL)
  SELECT spool AS queue_key, path, batch, envelopes, CASE WHEN body = '' THEN 0 ELSE length(body) - length(replace(body, '}}', '')) END::INT AS rows, md5('{{"' || field || '":[' || body || ']}}') AS payload_md5 FROM g WHERE path <> '/ingest/v1/db' OR body <> ''
  UNION ALL SELECT spool, path, seq, 1, 1, md5(payload) FROM n WHERE path NOT IN ('/ingest/v1/http-requests', '/ingest/v1/spans', '/ingest/v1/db')"""
STATEMENTS["pack_db_batches"] = f"""WITH {cte('raw_queries', 'q')}, r AS (SELECT coalesce("database", 'none') AS queue_key, (started_ms // 86400000) * 86400000 AS window_ms, started_ms AS t, md5(sql) AS s, ended_ms - started_ms AS d FROM q),
  n AS (SELECT *, (row_number() OVER (PARTITION BY queue_key, window_ms ORDER BY t, s, d) - 1) AS k FROM r)
  SELECT queue_key, window_ms, k // 3 AS flush, count(*) AS rows, '/ingest/v1/db' AS path,
  md5('{{"queries":[' || string_agg('{{"normalizedQuery":"' || s || '","durationMs":' || d || ',"timestampMillis":' || t || '}}', ',' ORDER BY k) || ']}}') AS payload_md5 FROM n GROUP BY 1, 2, 3"""
STATEMENTS["cap_queue"] = f"WITH {ENV} SELECT envelope_id, spool, path FROM e QUALIFY row_number() OVER (PARTITION BY spool, path ORDER BY seq DESC) <= 100"
DROPS = "SELECT spool, path, count(*) AS seen, least(count(*), 100) AS queued, greatest(count(*) - 100, 0) AS dropped FROM e GROUP BY 1, 2"
STATEMENTS["queue_drops"] = f"WITH {ENV} {DROPS}"
STATEMENTS["cap_entries"] = f"WITH {ENV} SELECT spool, file_name FROM e QUALIFY row_number() OVER (PARTITION BY spool ORDER BY file_name DESC) <= 150"
_suffix = "sum(strlen(payload)) OVER (PARTITION BY spool ORDER BY file_name DESC ROWS UNBOUNDED PRECEDING)"
STATEMENTS["cap_bytes"] = f"WITH {ENV} SELECT spool, file_name FROM e QUALIFY {_suffix} <= 20000"
STATEMENTS["compact_spool"] = f"""WITH {ENV}, y AS (SELECT * FROM e WHERE ts >= {NOW_MS} - 864000000::BIGINT QUALIFY row_number() OVER (PARTITION BY spool ORDER BY file_name DESC) <= 120)
  SELECT spool, file_name FROM y QUALIFY {_suffix} <= 6000"""
STATEMENTS |= {"stream_batches": STATEMENTS["pack_batches"], "keep_spool": STATEMENTS["compact_spool"], "keep_newest": STATEMENTS["cap_queue"]}

# --- delivery -------------------------------------------------------------------------------------

ATT = cte("delivery_attempts", "a")
STATEMENTS["plan_retries"] = f"""WITH {ATT}, w AS (SELECT *, CASE WHEN http_status NOT IN (429, 503) OR http_status IS NULL THEN 0 WHEN trim(retry_after) = '2' THEN 2000 WHEN retry_after = '999' THEN 300000
    WHEN retry_after LIKE 'Tue,%' THEN least(greatest(epoch_ms(strptime(substr(retry_after, 6, 20), '%d %b %Y %H:%M:%S')) - at_ms, 0), 300000)
    WHEN retry_after LIKE '2000-%' THEN least(greatest(epoch_ms(strptime(retry_after, '%Y-%m-%dT%H:%M:%SZ')) - at_ms, 0), 300000) ELSE 0 END AS asked,
    least(8000, 500 * (1 << attempt))::BIGINT AS base FROM a)
  SELECT envelope_id, attempt, http_status, at_ms, CASE WHEN http_status IN (200, 400) OR attempt >= 3 THEN NULL WHEN asked > 0 THEN asked
    ELSE base + floor({unit("envelope_id || ':' || attempt")} * (base / 4.0))::BIGINT END AS wait_ms FROM w"""
LAST = f"""{ATT}, la AS (SELECT envelope_id, path, attempt, http_status, saturated FROM a QUALIFY row_number() OVER (PARTITION BY envelope_id ORDER BY attempt DESC, at_ms DESC, coalesce(http_status, -1) DESC) = 1),
  settled AS (SELECT *, CASE WHEN http_status = 200 AND NOT saturated THEN 'delivered' WHEN path <> '/ingest/v1/sessions/end' AND (saturated OR http_status IS DISTINCT FROM 400) THEN 'spooled' ELSE 'dropped' END AS outcome FROM la)"""
STATEMENTS["settle"] = f"WITH {LAST} SELECT envelope_id, path, attempt, http_status, outcome FROM settled"
STATEMENTS["replay_remaining"] = f"WITH {ENV}, {LAST} SELECT envelope_id, path FROM e WHERE envelope_id NOT IN (SELECT envelope_id FROM la WHERE http_status IN (200, 400))"
STATEMENTS["delivery_stats"] = f"""WITH {ENV}, {LAST}, dr AS ({DROPS})
  SELECT ((SELECT sum(dropped) FROM dr) + (SELECT count(*) FROM settled WHERE outcome = 'dropped' AND saturated))::BIGINT AS dropped, (SELECT sum(queued) FROM dr)::BIGINT AS queued, (SELECT count(*) FROM settled WHERE outcome = 'spooled') AS persisted"""

# --- correlation ----------------------------------------------------------------------------------

STATEMENTS["trace_db_time"] = f"""WITH {DBROWS}, {cte('request_ends', 're')}, http AS (SELECT trace_id, span_id FROM ctx JOIN re USING (request_key) WHERE sampled)
  SELECT h.trace_id, h.span_id, count(d.status) AS db_calls, coalesce(sum(d.duration_ms), 0)::BIGINT AS db_ms FROM http h LEFT JOIN db d ON d.trace_id = h.trace_id AND d.span_id = h.span_id GROUP BY 1, 2"""
STATEMENTS["trace_logs"] = f"""WITH {LOGS}, {cte('request_ends', 're')}, http AS (SELECT request_key, trace_id, request_id FROM ctx JOIN re USING (request_key) WHERE sampled)
  SELECT h.request_key, count(l.level) AS log_lines, count(*) FILTER (l.level IN ('error', 'fatal')) AS error_lines, count(*) FILTER (l.level = 'warn') AS warn_lines
  FROM http h LEFT JOIN (SELECT * FROM logs WHERE source_level NOT IN ('trace', 'debug')) l ON l.trace_id = h.trace_id AND l.request_id = h.request_id GROUP BY 1"""
STATEMENTS["link_log_errors"] = f"""WITH {LOGS}, k AS (SELECT ctx.trace_id, coalesce(error_name, 'Error') AS error_type, {plain_scrub('error_message')} AS error_message, count(*) AS n, min(seq) AS first_id
    FROM rl JOIN ctx USING (request_key) WHERE arg_kind = 'error' AND has_error GROUP BY 1, 2, 3)
  SELECT l.trace_id, l.error_type, l.error_text AS error_message, coalesce(k.n, 0) AS matching_errors, k.first_id AS first_error_id FROM logs l LEFT JOIN k ON k.trace_id = l.trace_id AND k.error_type = l.error_type AND k.error_message = l.error_text WHERE promoted"""
STATEMENTS["span_parents"] = f"""WITH {HTTP}, spans AS (SELECT trace_id, span_id, parent_span_id, '{S.component}.request' AS operation, started_ms FROM http
    UNION ALL SELECT trace_id, substr(md5('c' || request_key), 1, 16), span_id, 'http.client', started_ms FROM ctx)
  SELECT s.trace_id, s.span_id, CASE WHEN s.parent_span_id = '' THEN 'root' WHEN p.span_id IS NULL THEN 'orphan' ELSE 'child' END AS role, p.operation AS parent_operation, p.started_ms AS parent_start_millis
  FROM spans s LEFT JOIN spans p ON p.trace_id = s.trace_id AND p.span_id = nullif(s.parent_span_id, '')"""
STATEMENTS["failed_requests"] = f"WITH {HTTP}, {_err} SELECT request_key, status_code FROM http h WHERE request_id IN (SELECT request_id FROM er JOIN ctx USING (request_key))"
STATEMENTS["clean_requests"] = f"WITH {HTTP}, {_err} SELECT request_key, status_code FROM http h WHERE request_id NOT IN (SELECT request_id FROM er JOIN ctx USING (request_key))"
STATEMENTS["stream_http_rows"] = f"WITH {HTTP} SELECT request_key, method, host, path, status_code, duration_ms, trace_id, span_id FROM http"


def statements() -> dict[str, str]:
    return dict(STATEMENTS)
