from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetgauge.functions import accuracy as acc
from fleetgauge.functions import text
from fleetgauge.functions.time import AsOf, day_age, days_after_is_now, elapsed_days, months_before, previous_month

AS_OF = AsOf(dt.date(2024, 3, 1), dt.time(8, 0))


@pytest.mark.parametrize(
    ("expression", "expected"),
    [
        (text.last_paren_code, ["C", "B", "", "", "new\nline", "", "b"]),
        (text.greedy_paren_code, ["B) (C", "B", "", "", "new\nline", "", "a)(b"]),
        (text.first_paren_code, ["B", "B", "", "", "new\nline", "", "a"]),
    ],
)
def test_codes_in_parentheses(column, expression, expected):
    values = ["A (B) (C)", "A (B) C", "none", None, "x (new\nline)", "()", "(a)(b)"]
    assert column(values, "string", expression("x")) == expected


def test_path_keeps_empty_levels(spark):
    df = spark.createDataFrame([("a", None, "c"), (None, None, None)], "um string, dum string, code_moa string")
    assert [r[0] for r in df.select(text.org_path(("um", "dum", "code_moa"))).collect()] == ["a//c", "//"]
    assert text.empty_path(("um", "dum", "code_moa")) == "//"


def test_blank_is_never_null(column):
    assert column([None, "", "  ", " a "], "string", text.is_blank("x")) == [True, True, True, False]


def test_trim_removes_spaces_only(column):
    assert column([" ab ", "\tab"], "string", text.norm_key("x")) == ["AB", "\tAB"]


def test_split_part_out_of_range(column):
    assert column(["a-b", "a", None], "string", text.key_part("x", "-", 2)) == ["b", "", None]


def test_generic_accounts_are_case_sensitive(column):
    values = ["x-OP1", "AUTREx", "a-G", "a-PR", "CSP", "x-op1", "abc", None]
    got = column(values, "string", text.account_or_excluded("x"))
    assert got == ["Exclu"] * 5 + ["X-OP1", "ABC", None]


def test_unknown_network_counts_as_connected(column):
    assert column(["Hors RLE", "RLE", None], "string", text.is_connected("x")) == [False, True, True]


def test_personal_accounts_have_six_or_eight_letters(column):
    values = ["abcdef", "abcdefg", "abcdefgh", None]
    assert column(values, "string", text.is_personal_account("x")) == [True, False, True, False]


def test_list_with_a_null_is_null(column):
    assert column([["a", "b"], ["a", None], None, []], "array<string>", text.joined_list("x")) == ["a/b", None, None, ""]


def test_replace_first_leaves_later_matches(column):
    values = ["Microsoft® X Microsoft Y", "none", None, "a.b.c"]
    assert column(values, "string", text.replace_first("x", "Microsoft.? ")) == ["X Microsoft Y", "none", None, "a.b.c"]


def test_cleaning_keeps_accented_letters(column):
    got = column(["Microsoft® Windows 10 Entreprise, édition 2016"], "string", text.clean_os_name("x"))
    assert got == [" Windows 10 Enterprise édition "]


def test_parts_of_a_short_name_are_null(column):
    assert column(["Windows 10 Pro N", "Windows 10"], "string", text.os_part("x", 1)) == ["Windows", None]
    assert column(["Windows 10 Pro", "a b c d e"], "string", text.os_part("x", 4)) == ["", "e"]


def test_extended_support(column):
    values = ["AF126CAE-171C-4329-B1AB-D70F55CA7EEA", "0110AA20-8307-4A4A-A91C-A8EB790714FF", "other", None]
    assert column(values, "string", text.extended_support_suffix("x")) == [" ESU Year 1", " ESU Year 2", None, None]


def test_compliance_element_first_match_wins(column):
    values = ["CI Poste WSUS", "SCCM x", "Réseau", "reseau", None]
    assert column(values, "string", text.compliance_element("x")) == ["Poste", "SCCM", "Réseau", "reseau", None]


def test_default_label(column):
    assert column(["", None, "a"], "string", text.default_label("x")) == ["inconnu", "inconnu", "a"]


def test_day_age_ignores_the_time(column):
    values = [dt.datetime(2024, 2, 29, 23, 59), dt.datetime(2024, 3, 1, 23, 0), dt.datetime(2024, 3, 2), None]
    assert column(values, "timestamp_ntz", day_age("x", AS_OF)) == [1, 0, -1, None]


def test_elapsed_days_truncate_toward_zero(column):
    values = [dt.datetime(2024, 2, 29, 9), dt.datetime(2024, 2, 29, 8), dt.datetime(2024, 3, 1, 20), dt.datetime(2024, 3, 3, 9)]
    assert column(values, "timestamp_ntz", elapsed_days("x", AS_OF)) == [0, 1, 0, -2]


def test_milestone_holds_on_two_calendar_days(column):
    start = [dt.date(2024, 1, 5) + dt.timedelta(days=i) for i in range(4)]
    # 2024-01-05 + 56 days is 2024-03-01
    assert column(start, "date", days_after_is_now("x", 56, AS_OF)) == [True, True, False, False]
    assert column([dt.date(2024, 1, 4)], "date", days_after_is_now("x", 56, AS_OF)) == [False]


def test_months_are_clamped(column):
    assert months_before(dt.date(2024, 3, 31), 1) == dt.date(2024, 2, 29)
    assert months_before(dt.date(2024, 1, 15), 2) == dt.date(2023, 11, 15)
    assert months_before(dt.date(2024, 2, 29), 12) == dt.date(2023, 2, 28)
    assert months_before(dt.date(2024, 12, 31), 1) == dt.date(2024, 11, 30)
    assert column([dt.date(2024, 3, 31), dt.date(2024, 1, 1)], "date", previous_month("x")) == [dt.date(2024, 2, 1), dt.date(2023, 12, 1)]


def test_as_of():
    assert AS_OF.previous_month == dt.date(2024, 2, 1)
    assert AS_OF.yesterday.day == dt.date(2024, 2, 29)
    assert AsOf(dt.date(2024, 1, 10)).previous_month == dt.date(2023, 12, 1)


@pytest.fixture
def code(spark):
    def evaluate(pairs, expression, kind="string"):
        df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], f"i int, a {kind}, b {kind}")
        return [r.y for r in df.select("i", expression(F.col("a"), F.col("b")).alias("y")).orderBy("i").collect()]

    return evaluate


def test_text_code(code):
    assert code([(" Dell", "DELL "), ("Dell", "HP"), (None, "HP"), ("HP", " "), (None, None)], acc.text_code) == [1, 2, 3, 3, 3]


def test_list_code(code):
    pairs = [("AA/BB", "BB"), ("AA/BB", "CC"), (None, "CC"), ("AA", ""), ("AA", "%")]
    assert code(pairs, acc.list_code) == [1, 2, 3, 3, 2]


def test_virtual_code_reads_null_as_false(code):
    pairs = [(True, True), (True, False), (None, False), (None, None), (None, True), (True, None)]
    assert code(pairs, acc.virtual_code, "boolean") == [1, 2, 1, 1, 2, 2]


def test_os_code_accepts_vendor_and_spelling(code):
    pairs = [
        ("Windows 10 Entreprise", "MICROSOFT WINDOWS 10 ENTERPRISE"),
        ("Windows 10 Enterprise", "Microsoft Windows 10 Entreprise"),
        ("linux", " LINUX"),
        ("Windows 10", "Windows 11"),
        ("", "x"),
    ]
    assert code(pairs, acc.os_code) == [1, 1, 1, 2, 3]


def test_user_code(code):
    pairs = [("Exclu", None), ("A", "Exclu"), (None, "A"), ("A", ""), ("A", "A"), ("A", "B")]
    assert code(pairs, acc.user_code) == [4, 4, 3, 3, 1, 2]


def test_entity_code_compares_blanks(code):
    assert code([("", ""), (None, ""), ("a", "b")], acc.entity_code) == [1, 3, 2]


def test_responsible_code(spark):
    rows = [(True, "a", "a"), (False, "a", "a"), (False, "a", "b"), (False, "", "a"), (False, None, "a"), (False, "a", " ")]
    df = spark.createDataFrame(rows, "p boolean, o string, r string")
    got = [x[0] for x in df.select(acc.responsible_code(F.col("p"), F.col("o"), F.col("r"))).collect()]
    assert got == [4, 1, 2, 3, 3, 3]


def test_seen_status(column):
    status = acc.seen_status(F.col("x"), day_age("x", AS_OF))
    values = [None, dt.date(2024, 2, 23), dt.date(2024, 2, 22), dt.date(2024, 3, 5)]
    assert column(values, "date", status) == ["jamais vu", "vu", "pas vu", "vu"]
