from decimal import Decimal

import pytest

from tagweave.operators.merge import collect_values, merge_tags, pivot_wide, union_long


def _frame(spark, rows, vtype):
    return spark.createDataFrame(rows, f"uid string, tag_value {vtype}")


def test_multi_value_sorted_and_only_null(spark):
    gender = _frame(spark, [("4", "M"), ("4", "F"), ("2", None), ("5", "F"), ("5", "F")], "string")
    wide = {r.uid: r.tag_gender for r in merge_tags([("TAG_GENDER", gender)]).collect()}
    assert wide == {"4": "F,M", "2": "", "5": "F,F"}


def test_mixed_types_render_before_union(spark):
    age = _frame(spark, [("1", 35)], "bigint")
    amount = _frame(spark, [("1", Decimal("9.5"))], "decimal(16,2)")
    gender = _frame(spark, [("1", "M"), ("2", "F")], "string")
    row = {r.uid: r for r in merge_tags([("TAG_AGE", age), ("TAG_AMOUNT", amount), ("TAG_GENDER", gender)]).collect()}
    assert (row["1"].tag_age, row["1"].tag_amount, row["1"].tag_gender) == ("35", "9.50", "M")
    assert (row["2"].tag_age, row["2"].tag_amount) == ("", "")


def test_preaggregated_equals_single_shuffle(spark):
    a = _frame(spark, [(str(i % 7), f"v{i % 3}") for i in range(100)], "string")
    b = _frame(spark, [(str(i), str(i * 2)) for i in range(10)], "string")
    long = union_long([("A", a), ("B", b)])
    x = pivot_wide(long, ["A", "B"], True)
    y = pivot_wide(long, ["A", "B"], False)
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_map_form_equals_pivot(spark):
    a = _frame(spark, [(str(i % 7), f"v{i % 3}") for i in range(100)] + [("9", None)], "string")
    b = _frame(spark, [(str(i), str(i * 2)) for i in range(10)], "string")
    frames = [("A", a), ("B", b)]
    x = merge_tags(frames, method="pivot")
    y = merge_tags(frames, method="map")
    assert x.columns == y.columns == ["uid", "a", "b"]
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_collect_values_keeps_duplicates(spark):
    long = union_long([("T", _frame(spark, [("1", "b"), ("1", "a"), ("1", "b")], "string"))])
    assert collect_values(long, ["uid"]).first().tag_value == "a,b,b"


def test_lowercase_collision_rejected(spark):
    a = _frame(spark, [("1", "x")], "string")
    with pytest.raises(ValueError):
        merge_tags([("Tag_A", a), ("TAG_A", a)])


def test_uid_tag_code_rejected(spark):
    a = _frame(spark, [("1", "x")], "string")
    with pytest.raises(ValueError, match="reserved"):
        merge_tags([("UID", a)])
