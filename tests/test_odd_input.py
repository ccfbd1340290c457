"""Inputs that must neither kill an executor nor a job."""

import json

from pyspark.sql import functions as F

from beaconry.functions.privacy import json_cleaner
from beaconry.functions.sqltext import normalized_sql
from beaconry.operators.sampling import before_send


def test_unclosed_quotes(spark):
    pairs = "''" * 100_000
    texts = ["INSERT '" + pairs + "x", "INSERT '" + pairs + "x'", "a 'b''c", "a 'b''c'' d", "a 'b' 'c", "'", "''", "'''", "a 'b''c''d e"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(normalized_sql(F.col("t"))).collect()]
    # A closed text is one mask. An unclosed one ends at the first of its last doubled quote, the other quote stays.
    assert got == ["INSERT ?'x", "INSERT ?", "a ?'c", "a ?' d", "a ? 'c", "'", "?", "?'", "a ?'d e"]


def test_odd_json(spark):
    deep = "[" * 100_000 + '"mail to someone@example.org"' + "]" * 100_000
    texts = ['{"a":"\\ud800 call","password":"x"}', deep, "{", '{"b":["\\udfff",{"token":1}]}', None]
    out = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(json_cleaner("acme")(F.col("t"))).collect()]
    assert json.loads(out[0])["a"] == "\ud800 call" and json.loads(out[0])["password"] != "x"
    assert "someone@example.org" not in out[1] and out[1].startswith("[[[") and out[2] == "{" and out[4] is None
    assert json.loads(out[3])["b"][0] == "\udfff"


def test_wrongly_typed_hooks(spark):
    df = spark.createDataFrame([(i, {"k": "v"}) for i in range(4)], "n long, m map<string,string>")

    def hook(row):
        if row["n"] == 0:
            return {"n": "text", "m": {}}
        if row["n"] == 1:
            return "not a row"
        row["m"] = [("k", "changed")]
        if row["n"] == 2:
            raise ValueError
        return row

    rows = {r.n: r.m for r in before_send(df, hook).collect()}
    assert rows == {0: {"k": "v"}, 1: {"k": "v"}, 2: {"k": "v"}, 3: {"k": "changed"}}
