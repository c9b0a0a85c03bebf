"""CSV, Parquet and report files."""

import glob

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import lines_df, lists, sorted_rows
from recordsieve.operators import stats
from recordsieve.plans.clean import clean
from recordsieve.sinks.tables import write_csv, write_parquet, write_report
from recordsieve.sources.files import read_csv
from recordsieve.specs import COMMENTS

NASTY = ['a,b', 'say "hi"', "line\nbreak", "cr\rhere", "both\r\n", " lead", "trail ", "back\\slash", '\\"', "'", "#x", "", None, "é😀"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(NASTY)], "id string, v string")
    write_csv(df, str(tmp_path / "out"), by=())
    got = dict(map(tuple, read_csv(spark, str(tmp_path / "out")).collect()))
    assert got == {str(i): v or None for i, v in enumerate(NASTY)}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0"), max_size=20), min_size=1, max_size=8))
def test_csv_any_text(spark, tmp_path_factory, values):
    path = str(tmp_path_factory.mktemp("csv") / "out")
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, v string")
    write_csv(df.coalesce(1), path, by=())
    got = dict(map(tuple, read_csv(spark, path, "id string, v string").collect()))
    assert got == {str(i): v or None for i, v in enumerate(values)}


def test_csv_text_form(spark, tmp_path):
    df = spark.sql(
        "SELECT 'c' AS kind, 'f' AS base_name, true AS b, CAST(NULL AS BOOLEAN) AS n, 5L AS i, '' AS e,"
        " timestamp_seconds(1600000000) AS t, timestamp_seconds(1600000000.25D) AS u"
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        write_csv(df, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    (part,) = glob.glob(str(tmp_path / "out/kind=c/base_name=f/*.csv"))
    assert open(part).read() == (
        "b,n,i,e,t,u\nTrue,,5,,2020-09-13 12:26:40+00:00,2020-09-13 12:26:40.250000+00:00\n"
    )


def test_rerun_replaces_own_partition_only(spark, tmp_path):
    path = str(tmp_path / "out")
    table = lambda *rows: spark.createDataFrame(rows, "kind string, base_name string, v int")
    write_parquet(table(("c", "2020", 1), ("c", "2021", 2)), path)
    write_parquet(table(("c", "2021", 3)), path)
    got = spark.read.schema("v int, kind string, base_name string").parquet(path)
    assert sorted_rows(got) == [(1, "c", "2020"), (3, "c", "2021")]


def test_report(spark, tmp_path):
    make = '{{"subreddit":"{}","author":"{}"}}'.format
    lines = [make("Robotics", "a"), make("robotics", "HelperBot_"), make("z", "a"), make("z", "b"), make("z", "c"), make("y", "a"), "", "{"]
    cells = clean(lines_df(spark, lines), COMMENTS, *lists(spark)).cells
    cells = cells.selectExpr("'comments' AS kind", "'RC_1' AS base_name", "*")
    write_report(stats.report_lines(cells, COMMENTS.reasons), str(tmp_path / "report"))
    parts = sorted(glob.glob(str(tmp_path / "report/kind=comments/base_name=RC_1/*.txt")))
    assert "".join(open(p).read() for p in parts).splitlines() == [
        "Total lines read: 8",
        "Total lines processed: 1",
        "Total lines kept for analysis: 1",
        "Total lines filtered out: 0",
        "Lines filtered out due to not interest subreddit: 4",
        "Lines filtered out due to bad lines: 2",
        "Lines filtered out due to bots: 1",
        "Lines filtered out due to banned: 0",
        "Lines filtered out due to crowd control: 0",
        "Lines filtered out due to non text: 0",
        "Lines filtered out due to controversial: 0",
        "Lines filtered out due to removed: 0",
        "",
        "Subreddit counts (including filtered lines):",
        "z: 3",
        "robotics: 2",
        "y: 1",
        "",
        "Subreddit counts (lines kept for analysis):",
        "robotics: 2",
    ]
