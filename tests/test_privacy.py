"""Key redaction and value scrubbing."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from beaconry.functions import privacy
from beaconry.functions.privacy import REDACTED as R
from beaconry.operators import redact
from beaconry.settings import Settings
from beaconry.sources import envelopes

S = Settings(vendor="acme")
LONG = "x" * 20_000 + " jane@example.com"

TEXTS = [
    ("billed to 4111111111111111 today", False, f"billed to {R} today"),
    ("the buyer typed 4111 1111 1111 1111 twice", False, f"the buyer typed {R} twice"),
    ("4111-1111-1111-1111", False, R),
    ("parcel no. 4111111111111112 left", False, "parcel no. 4111111111111112 left"),
    ("batch 1234567890123456 sorted", False, "batch 1234567890123456 sorted"),
    ("4111111111111111", True, R),
    ("form field holds 123-45-6789, signed", False, f"form field holds {R}, signed"),
    ("plain digits 123456789 stay", False, "plain digits 123456789 stay"),
    ("123-45-6789", True, R),
    ("invite sent (jane.doe@example.com) twice", False, f"invite sent ({R}) twice"),
    ("invite sent (jane.doe@example.com) twice", True, "invite sent (jane.doe@example.com) twice"),
    ("hop 192.168.1.42 took 3 ms", False, f"hop {R} took 3 ms"),
    ("hop 192.168.1.42 took 3 ms", True, "hop 192.168.1.42 took 3 ms"),
    ("firmware 999.999.0.1 flashed", False, "firmware 999.999.0.1 flashed"),
    ("route via 2001:db8::1 added", False, f"route via {R} added"),
    ("peer 1:2:3:4:5:6:7:8 and ::1 x", False, f"peer {R} and {R} x"),
    (LONG, False, LONG),
    ("é192.168.1.1 x", False, f"é{R} x"),
    ("4111111111111111,4111111111111111 5500-0000-0000-0004", False, f"{R},{R} {R}"),
    ("", False, ""),
    (None, False, None),
]


@pytest.mark.parametrize("opted_in", [False, True])
def test_texts(spark, opted_in):
    cases = [c for c in TEXTS if c[1] is opted_in]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string").orderBy("i")
    got = [r.t for r in redact.scrub_text(df, ["t"], opted_in).orderBy("i").collect()]
    assert got == [c[2] for c in cases]


def test_scan_limit_counts_utf16_units(spark):
    inside, over = "😀" * 8184 + " a@example.com", "😀" * 8190 + " a@example.com"
    df = spark.createDataFrame([(inside,), (over,)], "t string")
    got = [r.t for r in redact.scrub_text(df, ["t"]).collect()]
    assert sorted(len(t) for t in got) == sorted([len(inside) - 13 + len(R), len(over)])


def _random_text(rng):
    parts = ["4111 1111 1111 1111", "4111111111111112", "123-45-6789", "a.b@c.de", "10.0.0.1", "::1", "fe80::1%x", "é", "-", " ", "7", "x", "@", ".", ":"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))


# The value patterns.
def _model(text):
    def card(m):
        digits = [int(d) for d in re.sub("[ -]", "", m[0])][::-1]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))
        return R if total % 10 == 0 else m[0]

    text = re.sub(r"(?<![\d-])(?:\d[ -]?){12,18}\d(?![\d-])", card, text, flags=re.A)
    text = re.sub(r"\b\d{3}-\d{2}-\d{4}\b", R, text, flags=re.A)
    text = re.sub(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", R, text, flags=re.A)
    octet = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
    text = re.sub(rf"\b(?:{octet}\.){{3}}{octet}\b", R, text, flags=re.A)
    g = "[0-9A-Fa-f]{1,4}"
    six = rf"\b(?:{g}:){{7}}{g}\b|(?<![:.\w])(?:{g}:){{1,7}}:(?:{g})?(?::{g}){{0,6}}(?![:.\w])|(?<![:.\w])::(?:{g}:){{0,6}}{g}(?![:.\w])"
    return re.sub(six, R, text, flags=re.A)


def test_random_texts_match_model_and_are_stable(spark):
    rng = random.Random(7)
    texts = [_random_text(rng) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    once = redact.scrub_text(df, ["t"])
    got = {r.i: r.t for r in once.collect()}
    assert got == {i: _model(t) for i, t in enumerate(texts)}
    assert {r.i: r.t for r in redact.scrub_text(once, ["t"]).collect()} == {i: _model(t) for i, t in got.items()}


def test_corpus_counts(spark):
    df = spark.createDataFrame([(1, "a@b.cd 4111111111111111, 10.0.0.1 10.0.0.2"), (2, "clean"), (3, LONG)], "i int, t string")
    rows = {r.i: r for r in redact.scrub_corpus(df, "t").collect()}
    assert (rows[1].changed, rows[1].email_hits, rows[1].card_hits, rows[1].ipv4_hits, rows[1].ssn_hits) == (True, 1, 1, 2, 0)
    assert not rows[2].changed and not rows[3].changed and rows[3].t == LONG


SENSITIVE = [
    "authorization", "proxy-authorization", "Cookie", "set-cookie", "x-api-key", "x-auth-token", "x-access-token", "x-acme-key",
    "token", "api_key", "apiKey", "password", "db.password", "passwd", "secret", "sessionId", "session_id", "csrf", "bearer",
    "jwt", "pwd", "credit-card", "creditCard", "card_number", "cvv", "ssn", "user.token", "my-token", "req.authorization",
]
HARMLESS = ["username", "accessToken", "my-authorization", "tokens", "passwords", "x-acme-keys", "cardnumbers", "password\n"]


def test_sensitive_keys(spark):
    df = spark.createDataFrame([(k,) for k in SENSITIVE + HARMLESS], "k string")
    hits = {r.k for r in df.where(privacy.sensitive_key(F.col("k"), "acme")).collect()}
    assert hits == set(SENSITIVE)
    assert {k for k in SENSITIVE + HARMLESS if privacy.is_sensitive_name(k, "acme")} == set(SENSITIVE)


def test_extra_patterns(spark):
    df = spark.createDataFrame([("my.INTERNAL.ref",), ("a+b",), ("aab",), ("X9",), ("x9",)], "k string")
    hits = {r.k for r in df.where(privacy.sensitive_key(F.col("k"), "acme", ["internal", "a+b", re.compile("^X[0-9]$")])).collect()}
    assert hits == {"my.INTERNAL.ref", "a+b", "X9"}


def test_redact_keys_nested(spark):
    df = spark.sql(
        "SELECT 'p' AS password, 7 AS cvv, named_struct('jwt', 1, 'note', 'n', 'list', array(named_struct('token', 't', 'k', 'v'))) AS body, "
        "map('secret', map('a', 'b'), 'fine', map('pwd', 'x', 'c', 'd')) AS deep, CAST(NULL AS STRING) AS token"
    )
    row = redact.redact_keys(df, settings=S).first()
    assert (row.password, row.cvv, row.token) == (R, R, None)
    assert row.body.asDict(True) == {"jwt": R, "note": "n", "list": [{"token": R, "k": "v"}]}
    assert row.deep == {"secret": R, "fine": json.dumps({"pwd": R, "c": "d"}, separators=(",", ":"))}


def test_headers(spark):
    df = spark.sql("SELECT map('host', array('h'), 'authorization', array('Bearer S'), 'cookie', array('c'), 'x-trace-id', array('a', 'b'), 'empty', NULL) AS h")
    got = df.select(redact.headers_to_string(F.col("h"), [], S).alias("s")).first().s
    assert got == f"authorization: {R}\ncookie: {R}\nempty: \nhost: h\nx-trace-id: a,b"


PAYLOAD = {
    "message": "order by jane@example.com at 203.0.113.9, paid 4111111111111111, holder 123-45-6789",
    "release": "10.0.0.1", "sessionId": "s-1", "userEmail": "e@example.com",
    "metadata": {"note": "mail a@b.cd", "userId": "a@b.cd", "db.password": "a@b.cd", "path": "a@b.cd"},
    "stackTrace": ["at /srv/192.168.0.1/x.js"],
    "breadcrumbs": [{"message": "m a@b.cd", "data": {"to": "a@b.cd", "url": "a@b.cd"}}],
}
CLEAN = {
    "message": f"order by {R} at {R}, paid {R}, holder {R}",
    "release": "10.0.0.1", "sessionId": "s-1", "userEmail": "e@example.com",
    "metadata": {"note": f"mail {R}", "userId": "a@b.cd", "db.password": R, "path": "a@b.cd"},
    "stackTrace": ["at /srv/192.168.0.1/x.js"],
    "breadcrumbs": [{"message": f"m {R}", "data": {"to": R, "url": "a@b.cd"}}],
}


def test_payload_typed_and_json_agree(spark):
    df = spark.createDataFrame([(json.dumps(PAYLOAD),)], "payload string")
    as_json = json.loads(redact.scrub_payload_json(df, settings=S).first().payload)
    assert as_json == CLEAN
    ddl = (
        "message string, release string, sessionId string, userEmail string, metadata map<string,string>, stackTrace array<string>, "
        "breadcrumbs array<struct<message:string,data:map<string,string>>>"
    )
    typed = df.select(F.from_json("payload", ddl).alias("p")).select("p.*")
    typed = typed.withColumnsRenamed({"sessionId": "session_id", "userEmail": "user_email", "stackTrace": "stack_trace"})
    row = redact.scrub_payload(typed, settings=S).first().asDict(True)
    assert {privacy.camel(k): v for k, v in row.items()} == CLEAN


def test_payload_opted_in(spark):
    df = spark.createDataFrame([(json.dumps(PAYLOAD),)], "payload string")
    got = json.loads(redact.scrub_payload_json(df, send_default_pii=True, settings=S).first().payload)
    assert got["message"] == f"order by jane@example.com at 203.0.113.9, paid {R}, holder {R}"


def test_nested_session_id_is_not_restored(spark):
    df = spark.createDataFrame([('{"sessionId":5,"a":{"sessionId":"x"}}',), ("{ not json",), (None,)], "payload string")
    got = [r.payload for r in redact.scrub_payload_json(df, settings=S).collect()]
    assert got == [f'{{"sessionId":"{R}","a":{{"sessionId":"{R}"}}}}', "{ not json", None]


def test_depth_limit(spark):
    deep = "a@b.cd"
    for _ in range(13):
        deep = {"k": deep}
    shallow = "a@b.cd"
    for _ in range(12):
        shallow = {"k": shallow}
    df = spark.createDataFrame([(json.dumps(deep),), (json.dumps(shallow),)], "payload string")
    got = [r.payload for r in redact.scrub_payload_json(df, settings=S).collect()]
    assert "a@b.cd" in got[0] and R in got[1]


def test_sensitive_keys_are_seen_in_json_text(spark):
    """The quick look agrees with the walk: what it lets pass, the walk would not change."""
    rng = random.Random(9)
    names = ["a", "token", "api_key", "my.secret", "notoken", "tokens", "x", ":", ",", "Cookie", "é", 'q"uote', "back\\slash", "pass\tword", "user.pwd", ":.password"]

    def made(depth):
        kind = rng.randint(0, 5)
        if depth == 0 or kind < 2:
            return rng.choice([1, 1.5, None, True, "v", "token", '":"', 'say "password": x', "\\", "a\nb", "[", ":"])
        if kind == 2:
            return [made(depth - 1) for _ in range(rng.randint(0, 3))]
        return {rng.choice(names): made(depth - 1) for _ in range(rng.randint(0, 3))}

    texts = [json.dumps(made(4), ensure_ascii=rng.random() < 0.5, separators=(",", ":")) for _ in range(400)]
    texts += ["{ cut", "", '{"pass\\u0077ord":1}', '{"n" : {"token"\n: 1}}', "[" * 3000 + "]" * 3000, '{"s":"' + "\\n" * 50_000 + '"}', '{"s":"' + "\\n" * 50_000 + '","jwt":1}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    walk = privacy.json_cleaner("acme", scrub=False, withhold=True)
    rows = df.select("t", privacy.may_hold_sensitive_keys(F.col("t"), "acme").alias("may"), walk(F.col("t")).alias("out")).collect()
    assert all(r.may or json.loads(r.t) == json.loads(r.out) for r in rows)
    exact = [r for r in rows[:400] if not any(n in r.t for n in ('q\\"', "back", "pass\\t"))]
    assert all(r.may == (r.t != r.out) for r in exact if r.t.isascii()) and sum(r.may for r in exact) > 30 and sum(not r.may for r in exact) > 30
    assert [(r.may, r.out[:12]) for r in rows[400:]] == [
        (True, '"[REDACTED]"'), (True, '"[REDACTED]"'), (True, '{"password":'), (True, '{"n":{"token'), (True, "[[[[[[[[[[[["), (False, '{"s":"\\n\\n\\n'), (True, '{"s":"\\n\\n\\n'),
    ]


def test_envelopes_that_cannot_be_walked_are_withheld(spark, tmp_path):
    deep = "[" * 100_000 + "]" * 100_000
    rows = [("/a", '{"password":"p"', 1), ("/a", deep, 2), ("/a", None, 3), ("/a", '{"x": 1.50}', 4), ("/a", '{"x": {"jwt": [1]}}', 5)]
    envelopes.write_envelopes(spark.createDataFrame(rows, "path string, payload string, ts bigint"), str(tmp_path / "out"))
    got = {r.ts: r.payload for r in envelopes.read_spool(spark, str(tmp_path / "out")).collect()}
    assert got == {1: '"[REDACTED]"', 2: '"[REDACTED]"', 3: None, 4: '{"x": 1.50}', 5: '{"x":{"jwt":"[REDACTED]"}}'}
