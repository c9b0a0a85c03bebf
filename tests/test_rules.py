"""Edge lines and the verdict each must get."""

import json

import pytest

from helpers import lines_df, lists
from recordsieve.operators import stats
from recordsieve.operators.cascade import judge
from recordsieve.plans.clean import clean
from recordsieve.specs import COMMENTS, SPECS, SUBMISSIONS

BASE = {"id": "a", "subreddit": "Robotics", "author": "Ann"}


def rec(**changes):
    merged = {**BASE, **changes}
    return json.dumps({k: v for k, v in merged.items() if v is not ...})


BAD = [
    "", "   ", " \t　", '{"id":1} x', '{"id":1}{"id":2}', "{'id':1}", '{"id":1,}', "[1]", "1", "null",
    '"text"', "true", '{"id":1}}', '{"id":1}]}', '{"id":1},{"id":2}', '{"id":1},"x":{"id":2}',
    '[{"id":1}]', "{id:1}", '{"id":01}', '{"id":"a\tb"}', '{"id":1', "{", "}", '﻿{"id":1}', None,
]

BOTH = [
    (rec(), None),
    ("  " + rec() + "\r", None),
    (rec(subreddit="ROBOTICS"), None),
    (rec(subreddit=...), "not_interest_subreddit"),
    (rec(subreddit=None), "not_interest_subreddit"),
    (rec(subreddit="cooking"), "not_interest_subreddit"),
    (rec(subreddit="cooking", author="HelperBot_"), "not_interest_subreddit"),
    (rec(author="HelperBot_"), "bots"),
    (rec(author="[deleted]"), "bots"),
    (rec(author="[Deleted]"), "bots"),
    (rec(author=...), None),
    (rec(author=None), None),
    (rec(banned_by=False), "banned"),
    (rec(banned_by=""), "banned"),
    (rec(banned_by=None), None),
    (rec(body='}{"id":1}', title="],"), None),
    (rec(nested={"quarantine": True, "over_18": 1, "controversiality": 1}), None),
]

ONLY_COMMENTS = [
    (rec(collapsed_because_crowd_control=v), r)
    for v, r in [
        (False, None), (None, None), (0, None), ("", None), ([], None), ({}, None), (0.0, None),
        (True, "crowd_control"), ("x", "crowd_control"), (2, "crowd_control"), ([0], "crowd_control"),
        ("false", "crowd_control"), ("0", "crowd_control"), ("[]", "crowd_control"), ("{}", "crowd_control"),
    ]
] + [
    (rec(controversiality=v), r)
    for v, r in [
        (1, "controversial"), (1.0, "controversial"), (True, "controversial"),
        (0, None), ("1", None), ("true", None), (2, None), (None, None), ([1], None),
    ]
] + [
    (rec(comment_type=""), "non_text"),
    (rec(removed_by="x"), "removed"),
    (rec(removed_by_category="x"), "removed"),
    (rec(removed_by="x", controversiality=1, banned_by="y"), "banned"),
    (rec(quarantine=True, over_18=True), None),
]

ONLY_SUBMISSIONS = [
    (rec(quarantine=True), "quarantine"),
    (rec(quarantine="true"), None),
    (rec(quarantine=1), "quarantine"),
    (rec(over_18=True), "over_18"),
    (rec(over_18=False), None),
    (rec(over_18="1"), None),
    (rec(over_18=True, quarantine=True), "quarantine"),
    (rec(removed_by="x"), "removed"),
    (rec(removed_by_category="x"), "removed_category"),
    (rec(removed_by="x", removed_by_category="y"), "removed"),
    (rec(controversiality=1, comment_type="x"), None),
]


@pytest.mark.parametrize(
    "spec, cases",
    [(COMMENTS, BOTH + ONLY_COMMENTS), (SUBMISSIONS, BOTH + ONLY_SUBMISSIONS)],
    ids=["comments", "submissions"],
)
def test_reasons(spark, spec, cases):
    cases = [(line, "bad_lines") for line in BAD] + cases
    judged = judge(lines_df(spark, [line for line, _ in cases]), spec, *lists(spark))
    got = dict(judged.select("i", "reason").collect())
    wrong = {line: got[i] for i, (line, want) in enumerate(cases) if got[i] != want}
    assert wrong == {}
    assert len(got) == len(cases) == judged.count()


def test_repeated_key_last_wins(spark):
    line = '{"subreddit":"x","author":"Ann","subreddit":"robotics","over_18":true,"over_18":false}'
    judged = judge(lines_df(spark, [line]), SUBMISSIONS, *lists(spark))
    assert judged.first()["reason"] is None


def test_missing_key_is_empty_group(spark):
    judged = judge(lines_df(spark, [rec(subreddit=...), "", rec()]), COMMENTS, *lists(spark))
    assert [r.subreddit for r in judged.orderBy("i").collect()] == ["", None, "robotics"]


def test_conservation(spark):
    lines = BAD + [line for line, _ in BOTH + ONLY_COMMENTS]
    result = clean(lines_df(spark, lines), COMMENTS, *lists(spark))
    total = stats.totals(result.cells, ()).first()
    reasons = dict(stats.by_reason(result.cells, COMMENTS.reasons, ()).collect())
    groups = stats.by_group(result.cells, ()).collect()
    assert total.n_read == len(lines) == total.n_written + sum(reasons.values())
    assert total.n_filtered == sum(reasons.values()) and total.n_filtered_legacy == 0
    assert sum(g.n_all for g in groups) == total.n_read - reasons["bad_lines"]
    assert sum(g.n_topic for g in groups) == total.n_read - reasons["bad_lines"] - reasons["not_interest_subreddit"]
    assert sum(g.n_kept for g in groups) == total.n_written == result.kept.count()


def test_specs():
    assert len(COMMENTS.columns) == 49 and len(SUBMISSIONS.columns) == 46
    for spec in SPECS.values():
        assert len(set(spec.names)) == len(spec.names)
        assert {r.reason for r in spec.rules} <= set(spec.reasons)
