import pytest

from wareflow.functions.spec import (fill_header, parse_column, parse_columns, referenced_names,
                                     resolve, split_pairs, to_spark_sql)


def test_markers():
    assert parse_column("'_pay_date") == parse_column("'_pay_date")
    c = parse_column("'_pay_date")
    assert (c.name, c.is_string, c.hidden) == ("pay_date", True, True)
    c = parse_column("_copon_discount_amount")
    assert (c.name, c.is_string, c.hidden) == ("copon_discount_amount", False, True)
    c = parse_column("quantity")
    assert (c.name, c.is_string, c.hidden) == ("quantity", False, False)
    assert parse_column("'barcode").marker == "'barcode"


def test_case_collision_rejected():
    with pytest.raises(ValueError):
        parse_columns(["a", "'A"])


def test_rewrite_outside_literals():
    assert to_spark_sql(":a || :b") == "`a`  OR  `b`"
    assert to_spark_sql(":x && :y") == "`x`  AND  `y`"
    # colons and operators inside string literals stay as written
    assert to_spark_sql(":t == 'a:b || c'") == "`t` == 'a:b || c'"
    assert referenced_names(":is_a || :b > 1") >= {"is_a", "b"}


def test_resolve_and_header():
    assert resolve("/wh", "model.d_orders") == "/wh/model.db/d_orders"
    assert resolve("/wh/", "4ml.cls1.d_orders") == "/wh/4ml.db/cls1/d_orders"
    assert fill_header(["a", "", None, " ", "e"]) == ["a", "NA_2", "NA_3", "NA_4", "e"]
    assert split_pairs([[":p_date", 1], [":code", 3]]) == (["p_date", "code"], [1, 3])
