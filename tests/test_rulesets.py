"""Rulesets as text: what they say, what they find, and where they are wrong."""

import pytest

from farelake.operators.rulesets import TRIP_RULESET, Rule, parse_ruleset, ruleset_eval


def test_a_ruleset_is_read_in_order():
    text = 'Rules = [ RowCount > 0, IsComplete "a b", # comment, "x"\n ColumnValues "c" >= -1.5, ColumnValues "d" between 1 and 6 ]'
    assert parse_ruleset(text) == [
        Rule("RowCount", None, ">", ("0",)), Rule("IsComplete", "a b"), Rule("ColumnValues", "c", ">=", ("-1.5",)),
        Rule("ColumnValues", "d", "between", ("1", "6")),
    ]
    assert len(parse_ruleset(TRIP_RULESET)) == 6


@pytest.mark.parametrize("text, place, message", [
    ("", "line 1, column 1", "expected Rules, found the end"),
    ("Rules = []", "line 1, column 10", "expected RowCount or IsComplete or ColumnValues, found ]"),
    ("Rules = [\n  RowCount 0\n]", "line 2, column 12", "expected >"),
    ('Rules = [\n  IsComplete fare\n]', "line 2, column 14", "a column name in double quotes, found fare"),
    ('Rules = [ColumnValues "c" >= "d"]', "line 1, column 30", "expected a number, found d"),
    ('Rules = [ColumnValues "c" between 1, 2]', "line 1, column 36", "expected and, found ,"),
    ("Rules = [RowCount > 0] x", "line 1, column 24", "expected the end, found x"),
    ("Rules = [RowCount > 0,\n;]", "line 2, column 1", "unexpected character ';'"),
    ('Rules = ["RowCount" > 0]', "line 1, column 10", "found RowCount"),
])
def test_faults_name_their_place(text, place, message):
    with pytest.raises(ValueError) as e:
        parse_ruleset(text)
    assert str(e.value).startswith(place + ": ") and message in str(e.value)


def test_rules_are_counted_in_one_aggregate(spark):
    df = spark.createDataFrame([(1, 2.0), (None, -1.0), (7, None)], "c int, d double")
    text = 'Rules = [RowCount > 3, RowCount != 0, IsComplete "c", ColumnValues "c" between 1 and 6, ColumnValues "d" >= 0, ColumnValues "d" < 2.5]'
    got = ruleset_eval(df, text)
    assert [tuple(r) for r in got.collect()] == [
        ("RowCount > 3", 1, "Failed"), ("RowCount != 0", 0, "Passed"), ("IsComplete c", 1, "Failed"),
        ("ColumnValues c between 1 and 6", 2, "Failed"), ("ColumnValues d >= 0", 2, "Failed"), ("ColumnValues d < 2.5", 1, "Failed"),
    ]
    assert got._jdf.queryExecution().executedPlan().toString().count("ExistingRDD") + got._jdf.queryExecution().executedPlan().toString().count("LocalTableScan") <= 2
    with pytest.raises(Exception, match="missing"):
        ruleset_eval(df, 'Rules = [IsComplete "missing"]').collect()
