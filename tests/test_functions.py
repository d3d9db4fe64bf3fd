"""Column expressions on tiny literal frames, edge rows included."""

from pyspark.sql import functions as F

from strata.functions.casts import flag, null_if_equal, safe_cast, safe_to_date
from strata.functions.derive import bucketize, guarded_rate, minutes_between, pct, row_hash, safe_ratio
from strata.functions.text import digits_and_plus, leading_number, proper_case, split_labelled, split_route


def test_split_labelled_and_route(spark):
    df = spark.createDataFrame([("MARWAR JN - MJ", "Delhi to Mumbai"), ("HALT 12", "nowhere"), (None, None)],
                               "s string, r string")
    name, code = split_labelled("s")
    origin, dest = split_route("r")
    rows = df.select(name.alias("n"), code.alias("c"), origin.alias("o"), dest.alias("d")).collect()
    assert [tuple(r) for r in rows] == [("MARWAR JN", "MJ", "Delhi", "Mumbai"), ("", "", "", ""),
                                         (None, None, None, None)]


def test_leading_number_modes(spark):
    df = spark.createDataFrame([("25 kms",), ("1,234 kms",), ("25.7 kms",), ("n/a",), (None,)], "d string")
    first = [r[0] for r in df.select(leading_number("d")).collect()]
    full = [r[0] for r in df.select(leading_number("d", "full")).collect()]
    assert first == [25.0, 1.0, 25.0, None, None]
    assert full == [25.0, 1234.0, 25.7, None, None]


def test_safe_casts_do_not_raise_under_ansi(spark):
    df = spark.createDataFrame([("12", "2023-01-05"), ("", "EMERGENCY"), ("x1", None)], "a string, d string")
    rows = df.select(safe_cast("a", "int"), safe_cast("a", "double"), safe_to_date("d")).collect()
    assert rows[0][0] == 12 and rows[0][1] == 12.0 and str(rows[0][2]) == "2023-01-05"
    assert rows[1][0] is None and rows[1][1] is None and rows[1][2] is None
    assert rows[2][0] is None


def test_null_sentinel_and_flag(spark):
    df = spark.createDataFrame([("Source", 1), ("10:05", None), (None, 3)], "a string, n int")
    rows = df.select(null_if_equal("a", "Source"), flag(F.col("n") > 2)).collect()
    assert [tuple(r) for r in rows] == [(None, False), ("10:05", False), (None, True)]


def test_text_helpers(spark):
    df = spark.createDataFrame([("  o'neil mc-donald ", "+1 (555) 010-2000")], "n string, p string")
    r = df.select(proper_case("n"), digits_and_plus("p")).first()
    assert r[0] == "O'neil Mc-donald"
    assert r[1] == "+15550102000"


def test_row_hash_is_unambiguous(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a|b", "c", None), ("a", "b|c", None),
                                ("a", "b", None)], "x string, y string, z string")
    hashes = [r[0] for r in df.select(row_hash(["x", "y", "z"])).collect()]
    assert len(set(hashes[:4])) == 4          # nulls and delimiters cannot collide
    assert hashes[1] == hashes[4]             # equal rows hash equal
    assert all(len(h) == 64 for h in hashes)


def test_bucketize_null_label(spark):
    df = spark.createDataFrame([(17,), (18,), (39,), (40,), (59,), (60,), (None,)], "age int")
    bounds = [(18, "Pediatric"), (40, "Young Adult"), (60, "Middle Aged")]
    plain = [r[0] for r in df.select(bucketize("age", bounds, "Senior")).collect()]
    labelled = [r[0] for r in df.select(bucketize("age", bounds, "Senior", null_label="Unknown")).collect()]
    assert plain == ["Pediatric", "Young Adult", "Young Adult", "Middle Aged", "Middle Aged", "Senior", "Senior"]
    assert labelled[-1] == "Unknown"


def test_duration_speed_ratio_pct(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (timestamp_ntz'2024-01-01 10:00:00.5', timestamp_ntz'2024-01-01 10:30:00.5', 5.0),
        (timestamp_ntz'2024-01-01 10:00:00', timestamp_ntz'2024-01-01 10:00:00', 2.0),
        (timestamp_ntz'2024-01-01 10:00:00', timestamp_ntz'2024-01-01 09:50:00', 0.0) AS t(a, b, d)""")
    dur = minutes_between("a", "b")
    rows = df.select(dur, guarded_rate("d", dur), safe_ratio(F.col("d"), F.lit(0)), pct(F.lit(1), F.lit(3))).collect()
    assert [r[0] for r in rows] == [30.0, 0.0, -10.0]
    assert [r[1] for r in rows] == [10.0, None, None]
    assert all(r[2] is None for r in rows)
    assert rows[0][3] == 33.33


def test_roles_by_keyword_and_dtype(spark):
    from strata.operators.clean import RoleRule, resolve_roles, role_transform
    from strata.plans.patients_roles import ROLE_RULES

    df = spark.createDataFrame(
        [(" alice ", "EMERGENCY", "2023-01-05", " o+ ", "12", "1,5")],
        "`Name` string, `Admission Type` string, `Date of Admission` string, `Blood Type` string, "
        "`Age` string, `_Name_audit` string")
    roles = resolve_roles(df, ROLE_RULES)
    assert roles.all("date") == ("Date of Admission",)            # "Admission Type" is not a date
    assert roles.one("int") == "Age" and "_Name_audit" not in roles.all("proper")
    out = role_transform(df.withColumn("Name", F.trim("Name")), roles, ["proper", "upper", "date", "int"]).first()
    assert out["Name"] == "Alice" and out["Admission Type"] == "EMERGENCY" and str(out["Date of Admission"]) == "2023-01-05"
    assert out["Age"] == 12
    clash = resolve_roles(df, [RoleRule("a", ("type",)), RoleRule("b", ("blood",))])
    assert clash.ambiguous == ("Blood Type",)
