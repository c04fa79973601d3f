import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import business as B
from ledgerloom.functions import scalars as S


def one(spark, column, **values):
    ddl = {str: "string", int: "long", float: "double", dt.date: "date", Decimal: "decimal(18,4)"}
    pairs = [(n, v if not isinstance(v, tuple) else v[0], ddl[type(v)] if not isinstance(v, tuple) else v[1])
             for n, v in values.items()]
    schema = ", ".join(f"{n} {t}" for n, _, t in pairs)
    df = spark.createDataFrame([tuple(v for _, v, _ in pairs)], schema)
    return df.select(column.alias("r")).first()["r"]


def test_safe_divide(spark):
    assert one(spark, S.safe_divide("a", "b"), a=1.0, b=4.0) == 0.25
    assert one(spark, S.safe_divide("a", "b"), a=1.0, b=0.0) is None
    assert one(spark, S.safe_divide("a", "b"), a=(None, "double"), b=2.0) is None
    assert one(spark, S.safe_divide("a", "b"), a=Decimal("1.5000"), b=3) == 0.5


def test_tiny_converted_amounts_add_up(spark):
    tiny = spark.range(10_000).select(F.lit(0.00003).alias("usd"))
    assert tiny.agg(F.sum(S.converted("usd")).cast("double")).first()[0] == 0.3


@pytest.mark.parametrize("value, expected", [(0.5, 1), (1.5, 2), (2.5, 3), (-2.5, -3), (2.4, 2)])
def test_float_to_integer_rounds_half_away_from_zero(spark, value, expected):
    assert one(spark, S.to_long("x"), x=value) == expected


def test_text_to_integer(spark):
    assert one(spark, S.text_to_long("x"), x="12.5") == 13
    assert one(spark, S.text_to_long("x"), x="n/a") is None


@pytest.mark.parametrize("text, expected", [
    ('{"k": 7}', "7"), ('{"k": "7"}', "7"), ('{"k": true}', "true"), ('{"k": "[x"}', "[x"), ('{"k": ""}', ""),
    ('{"k": [1, 2]}', None), ('{"k": {"a": 1}}', None), ('{"k": null}', None), ('{"j": 1}', None), ("not json", None),
    ("", None), ('{"k": "ARRAY"}', "ARRAY"),
])
def test_json_value_returns_scalars_only(spark, text, expected):
    rows = S.with_json(spark.createDataFrame([(text,)], "x string"), "x").select(S.json_value("x", "$.k")).collect()
    assert [r[0] for r in rows] == [expected]


@pytest.mark.parametrize("text, expected", [
    ("CL-1234567890123", 1234567890123), ("OP2000123.1", 200012), ("OP 123456", 123456), ("X-12345", None),
    ("none", None), ("12345678901234", 1234567890123),
])
def test_clean_order_id(spark, text, expected):
    assert one(spark, S.clean_order_id("x"), x=text) == expected


def test_country_pattern_is_a_character_class(spark):
    from ledgerloom import rules as R

    for text, hit in (("MX-1", True), ("X-1", True), ("|-9", True), ("Z-1", False), ("CL-", False)):
        assert one(spark, F.col("x").rlike(R.LOAD_COUNTRY_ID_REGEX), x=text) is hit


def test_dates(spark):
    d = dt.date(2024, 3, 31)
    assert one(spark, S.month_start("d"), d=d) == dt.date(2024, 3, 1)
    assert one(spark, S.year_month("d"), d=d) == 202403
    assert one(spark, S.first_of("y", "m"), y=2024, m=2) == dt.date(2024, 2, 1)
    assert one(spark, S.months_since("a", "b"), a=dt.date(2024, 3, 1), b=dt.date(2024, 1, 31)) == 2
    assert one(spark, S.months_since("a", "b"), a=dt.date(2023, 12, 31), b=dt.date(2024, 1, 1)) == -1
    assert S.first_full_month(dt.date(2024, 1, 1)) == dt.date(2024, 1, 1)
    assert S.first_full_month(dt.date(2024, 12, 2)) == dt.date(2025, 1, 1)


def test_local_month_differs_from_utc_month(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2025-01-01 02:00:00' AS t, TIMESTAMP '2025-02-01 02:00:00Z' AS i")
    got = df.select(
        S.year_month(S.local_datetime("t", "America/Santiago")), S.year_month(S.local_datetime("i", "America/Santiago"))
    ).first()
    assert tuple(got) == (202412, 202501)


def test_predicates_follow_three_valued_logic(spark):
    df = spark.createDataFrame([("pilot test",), ("Deal",), ("",), (None,)], "x string")

    def kept(condition):
        return [r["x"] for r in df.filter(condition).collect()]

    assert kept(S.not_like_any("x", ["%test%"])) == ["Deal", ""]
    assert kept(S.not_like_any_or_null("x", ["%test%"])) == ["Deal", "", None]
    assert kept(S.not_in_or_null("x", ["Deal"])) == ["pilot test", "", None]
    assert kept(S.not_in_list("x", ["Deal"])) == ["pilot test", ""]
    assert kept(S.not_in_list("x", [])) == ["pilot test", "Deal", ""]
    assert kept(S.in_list("x", [])) == []
    assert kept(S.is_blank("x")) == ["", None]


def test_normalise_and_split(spark):
    assert one(spark, S.normalize_id("x"), x="7.123-k") == "7123K"
    assert one(spark, S.strip_chars("x", "/-."), x="7/1-2.3") == "7123"
    assert one(spark, S.before("x", "."), x="A,B.C") == "A,B"
    assert one(spark, S.before("x", "."), x="AB") == "AB"


def test_tax_and_arpu(spark):
    assert one(spark, B.net_of_tax("v", "c"), v=Decimal("100.0001"), c="BRL") == Decimal("88.00008800")
    assert one(spark, B.net_of_tax("v", "c"), v=Decimal("100.0001"), c="CLP") == Decimal("100.00010000")
    assert one(spark, B.net_of_tax("v", "c"), v=100.0, c="BRL") == pytest.approx(88.0)
    assert one(spark, B.arpu("v", "q"), v=10.0, q=0.0) is None


@pytest.mark.parametrize("stream, product, merged, split, explicit", [
    ("EB", "S.C", "S.C", "S.C", "S.C"),
    ("EB", "S.C cargas", "S.C", "S.C cargas", "S.C cargas"),
    ("EB", "", "EB-XX-1", "EB-XX-1", "EB-XX-1"),
    ("EB", None, "EB-XX-1", "EB-XX-1", "EB-XX-1"),
    ("EB", "OTHER", "EB-XX-1", "EB-XX-1", None),
    ("CB", "OTHER", "OTHER", "OTHER", "OTHER"),
    ("FS", "OTHER", None, None, None),
])
def test_product_bucket(spark, stream, product, merged, split, explicit):
    got = [one(spark, B.product_bucket("s", "p", v), s=stream, p=(product, "string"))
           for v in ("merged", "split", "explicit")]
    assert got == [merged, split, explicit]


@pytest.mark.parametrize("country, transaction, expected", [
    ("CL", "X-1", "CL"), ("MX", "OP2000001", "OTRO"), (None, "OP2000001", "CL"), ("", "CL-1", "CL"),
    (None, "OP1000001", "OTRO"), (None, None, "OTRO"),
])
def test_corrected_country(spark, country, transaction, expected):
    column = B.corrected_country("c", "t")
    assert one(spark, column, c=(country, "string"), t=(transaction, "string")) == expected


def test_ledger_labels(spark):
    assert one(spark, B.bonus_transaction_id("x"), x="OP2000,1.7") == "OP2000"
    assert one(spark, B.bonus_transaction_id("x"), x="CL-1.7") == "CL-1.7"
    assert one(spark, B.reloaded_flag("x"), x="Extra BONUS") == "SI"
    assert one(spark, B.reloaded_flag("x"), x="CL-1") == "NO"
    internal = B.yes_no(B.is_internal("x", "acme", ["points house"]))
    assert [one(spark, internal, x=(v, "string")) for v in ("ACME one", "Points House", "The acme", None)] == [
        "SI", "SI", "NO", "NO"]
    assert one(spark, B.document_status(F.col("f")), f=0) == "Provisionado"
    assert one(spark, B.document_status(F.col("f")), f=(None, "long")) == "Facturado"
