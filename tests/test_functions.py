from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from usagelens.functions import naming, numeric, temporal, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_datediff_counts_boundaries(spark):
    a, b = temporal.at("2024-01-01 00:00:00.9"), temporal.at("2024-01-01 00:00:02.1")
    assert one(spark, temporal.datediff_boundary("second", a, b)) == 2
    assert one(spark, temporal.datediff_boundary("second", b, a)) == -2
    c, d = temporal.at("2024-01-31 23:59:59"), temporal.at("2024-02-01 00:00:00")
    for unit in ("minute", "hour", "day", "month"):
        assert one(spark, temporal.datediff_boundary(unit, c, d)) == 1
    assert one(spark, temporal.datediff_boundary("year", c, d)) == 0
    before = temporal.at("1969-12-31 23:59:59.5")
    assert one(spark, temporal.datediff_boundary("second", before, temporal.at("1970-01-01 00:00:00"))) == 1


def test_truncation_keeps_zone_less_type(spark):
    df = spark.range(1).select(temporal.trunc_ts("hour", temporal.at("2024-05-05 10:59:59")).alias("t"))
    assert df.schema["t"].dataType.simpleString() == "timestamp_ntz"
    assert df.first()[0] == datetime(2024, 5, 5, 10)


def test_round_half_up_reads_decimals(spark):
    assert one(spark, numeric.round_half_up(F.lit(1.005), 2)) == 1.01
    assert one(spark, numeric.round_half_up(F.lit(2.675), 2)) == 2.68
    assert one(spark, numeric.round_half_up(F.lit(-0.125), 2)) == -0.13


def test_ratio_and_percentage_of_zero_are_null(spark):
    assert one(spark, numeric.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, numeric.percentage(F.lit(1), F.lit(3))) == 33.33


def test_to_whole_rounds(spark):
    assert one(spark, numeric.to_whole(F.lit(3.7))) == 4


def test_warehouse_domain_wildcards(spark):
    cases = {
        "FIN_WH": "FINANCE", "FINANCE_WH": "FINANCE", "FIN": "OTHER", "fin_wh": "OTHER",
        "MGMT_WH": "MANAGEMENT", "TRANSFORM_WH": "DATA_ENG", "SAL_WH": "OTHER", None: "OTHER",
    }
    for name, domain in cases.items():
        assert one(spark, naming.domain_from_warehouse(F.lit(name).cast("string"))) == domain
    assert one(spark, naming.domain_from_warehouse(F.lit("SAL_WH"), extended=True)) == "SALES"


def test_database_domain(spark):
    cases = {"FINANCE_DB": "FINANCE", "MARKETING_DB": "MARKETING", "MKTX": "MARKETING", "TRANSFORM_DB": "OTHER", "HR_DB": "OTHER"}
    for name, domain in cases.items():
        assert one(spark, naming.domain_from_database(F.lit(name))) == domain
    assert one(spark, naming.domain_from_database(F.lit("HR_DB"), extended=True)) == "HR"


def test_environment_defaults_to_dev(spark):
    cases = {"FIN_WH_PROD": "PROD", "XUATX": "UAT", "FIN_WH": "DEV", "A_DEV": "DEV", "PROD_UAT": "PROD"}
    for name, env in cases.items():
        assert one(spark, naming.environment_from_name(F.lit(name))) == env
    assert one(spark, naming.environment_from_name(F.lit(None).cast("string"))) == "DEV"


def test_regexp_first_is_null_without_match(spark):
    pattern = r"EXECUTE\s+TASK\s+([\w.]+)"
    assert one(spark, text.regexp_first(F.lit("x execute  task A.b-c"), pattern)) == "A.b"
    assert one(spark, text.regexp_first(F.lit("SELECT 1"), pattern)) is None


def test_mask_email(spark):
    assert one(spark, text.mask_email(F.lit("john@x.com"), [])) == "j***@x.com"
    assert one(spark, text.mask_email(F.lit("john@x.com"), ["PAYROLL_PII"])) == "john@x.com"
    assert one(spark, text.mask_email(F.lit(None).cast("string"), [])) is None


def test_user_names(spark):
    assert one(spark, text.user_names(F.lit(" ann, Bob ,, c"))) == ["ANN", "BOB", "C"]


def test_name_part_and_key(spark):
    assert one(spark, text.name_part(F.lit("A.B.C"), 3)) == "C"
    assert one(spark, text.name_part(F.lit("A.B"), 3)) == ""
    key = text.surrogate_key(F.lit("W"), temporal.at("2024-01-01 00:00:00"))
    assert one(spark, key) == one(spark, F.md5(F.lit("W2024-01-01 00:00:00.000")))


def test_variant_path_rounds_decimals(spark):
    value = text.parse_json(F.lit('{"m": {"amount": 12.345}}'))
    assert one(spark, text.variant_path(value, "m:amount", "decimal(10,2)")) == Decimal("12.35")


def test_constant_rows_escape(spark):
    got = one(spark, text.constant_rows(["a", "b"], [("it's \\ ok", 3)]))
    assert [tuple(r) for r in got] == [("it's \\ ok", 3)]
