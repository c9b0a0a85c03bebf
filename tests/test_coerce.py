"""Values and what each coercion makes of them."""

import datetime as dt
import json

import pytest

from helpers import lines_df, lists
from recordsieve.functions import coerce as to
from recordsieve.functions import text
from recordsieve.operators.project import coerce
from recordsieve.plans.clean import clean
from recordsieve.specs import COMMENTS, SUBMISSIONS


def apply(spark, sql, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.selectExpr("i", f"{sql('v')} AS out").orderBy("i").collect()]


CASES = [
    (to.to_bigint, {
        "4": 4, " 4 ": 4, "1e3": 1000, "4.0": 4, "-7": -7, "+7": 7, "9223372036854775807": 2**63 - 1,
        "9007199254740993": 2**53 + 1, "0x1f": None, "1d": None, "1f": None, "nan": None, "inf": None,
        "1e400": None, "99999999999999999999": None, "1.5": None, "": None, "x": None, None: None,
        "true": 1, "false": 0, "[1]": None,
    }),
    (to.to_double, {
        "0.97": 0.97, "1": 1.0, ".5": 0.5, "5.": 5.0, "-1e-3": -0.001, "1d": None, "NaN": None, '"NaN"': None,
        "": None, None: None, "1_000": None,
    }),
    (to.to_boolean, {
        "true": True, "false": False, "1": True, "0": False, "1.0": True, "0.0": False,
        "2": None, "yes": None, "True": None, "": None, None: None,
    }),
    (to.to_json_text, {
        None: "null", "": "null", "0": "null", "0.0": "null", "false": "null", "[]": "null", "{}": "null",
        '{"a":1}': '{"a":1}', "[0]": "[0]", "true": "true", "12": "12", 'a "b"': '"a \\"b\\""',
    }),
    (text.flatten_text, {"a\r\nb": "a  b", "a\nb\rc": "a b c", "a  b": "a  b", None: "", "": ""}),
    (lambda c: text.flatten_text(c, "None"), {None: "None", "": ""}),
    (text.strip, {"　 a b\x1f\n": "a b", "​a": "​a", "  ": "", None: None}),
    (text.base_name, {
        "file:/d.x/RC_2020-01.zst": "RC_2020-01", "a.tar.zst": "a.tar", "plain": "plain", "/x/.hidden": ".hidden",
        "a.": "a", "..zst": "..zst", "a..zst": "a.",
    }),
]


@pytest.mark.parametrize("sql, cases", CASES)
def test_values(spark, sql, cases):
    assert dict(zip(cases, apply(spark, sql, list(cases)))) == cases


def test_timestamps(spark):
    at = dt.datetime(2020, 9, 13, 12, 26, 40)
    cases = {
        "1600000000": at, "1600000000.0": at, "1600000000.25": at.replace(microsecond=250000), "1.6e9": at,
        "0": dt.datetime(1970, 1, 1), "abc": None, "": None, "true": None, "16000000000000": None, None: None,
    }
    got = apply(spark, lambda c: f"CAST({to.to_timestamp(c)} AS TIMESTAMP_NTZ)", list(cases))
    assert dict(zip(cases, got)) == cases


def test_every_comment_column(spark):
    record = {
        "id": "c1", "subreddit": "robotics", "author": "Ann", "body": "x\r\ny", "created_utc": "1600000000",
        "stickied": True, "score": 12, "likes": None, "gildings": {"gid_1": 1, "s": "é"}, "awarders": [],
        "mod_reports": [["a", 1]], "associated_award": {"k": 1}, "gilded": "x", "extra": 5,
    }
    kept = clean(lines_df(spark, [json.dumps(record)]), COMMENTS, *lists(spark)).kept
    assert tuple(kept.columns) == COMMENTS.names
    row = kept.first().asDict()
    assert row["id"] == "c1" and row["parent_id"] is None and row["body"] == "x  y"
    assert row["stickied"] is True and row["likes"] is None
    assert row["score"] == 12 and row["gilded"] is None and row["ups"] is None
    assert json.loads(row["gildings"]) == record["gildings"] and row["awarders"] == "null"
    assert json.loads(row["mod_reports"]) == [["a", 1]] and row["associated_award"] == '{"k":1}'
    assert row["distinguished"] == "none" and row["permalink"] == "" and row["collapsed_reason"] == ""
    types = dict(kept.dtypes)
    groups = {"raw": "string", "text": "string", "enum": "string", "json": "string"}
    assert all(types[name] == groups.get(group, group) for name, group in COMMENTS.columns)


def test_coerce_flat_table(spark):
    names = COMMENTS.names
    df = spark.createDataFrame([("1",) * len(names)], ", ".join(f"{n} string" for n in names))
    row = coerce(df, COMMENTS).first()
    assert tuple(row.asDict()) == names
    assert row["score"] == 1 and row["saved"] is True and row["body"] == "1" and row["gildings"] == "1"


def test_null_text_parity(spark):
    line = '{"subreddit":"robotics","author":"Ann"}'
    kept = clean(lines_df(spark, [line]), SUBMISSIONS, *lists(spark), null_text="None").kept
    row = kept.first()
    assert row["title"] == "None" and row["url"] == "" and row["distinguished"] == "none"


def test_audit_shows_unreadable_values(spark):
    lines = [json.dumps({"subreddit": "robotics", "author": "A", "score": s, "locked": b}) for s, b in
             [(1, True), ("x", "yes"), (None, None), (2.5, 0)]]
    audit = clean(lines_df(spark, lines), COMMENTS, *lists(spark)).audit
    got = {r.col: (r.nulls_before, r.nulls_after) for r in audit.collect()}
    assert got["score"] == (1, 3) and got["locked"] == (1, 2)
    assert got["body"] == (4, 0) and got["gildings"] == (4, 0) and got["ups"] == (4, 4)
    assert len(got) == 49 - 5
