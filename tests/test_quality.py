"""Rule engine, quarantine split, reconciliation, null profiles, layer report."""

from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.quality import Rule


def _frame(spark):
    return spark.createDataFrame(
        [(1, 10.0, "Y"), (2, -1.0, "N"), (None, 5.0, "X"), (4, None, None), (5, 600.0, "Y")],
        "vendor int, fare double, flag string")


def _rules():
    c = F.col
    return [Rule("NULL_vendor", "completeness", c("vendor").isNull()),
            Rule("NEGATIVE_fare", "range", c("fare") < 0),
            Rule("EXTREME_fare", "range", c("fare") > 500),
            Rule("INVALID_flag", "domain", ~c("flag").isin("Y", "N") & c("flag").isNotNull()),
            Rule("NEVER", "range", c("fare") > 10000)]


def test_run_rules_matches_per_rule_filters(spark):
    df = _frame(spark)
    got = {r.rule_name: (r.category, r.failed_rows, r.fail_pct, r.status)
           for r in quality.run_rules(df, _rules()).collect()}
    for rule in _rules():
        expected = df.filter(rule.bad).count()
        assert got[rule.name][1] == expected
        assert got[rule.name][3] == ("PASS" if expected == 0 else "FAIL")
    assert got["NULL_vendor"][2] == 20.0


def test_run_rules_is_one_aggregate(spark):
    plan = quality.run_rules(_frame(spark), _rules())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_score_and_categories(spark):
    res = quality.run_rules(_frame(spark), _rules())
    s = quality.dq_score(res).first()
    assert (s.rules_evaluated, s.rules_passed, s.rules_failed, s.dq_score) == (5, 1, 4, 20.0)
    cats = {r.category: (r.failed_rules, r.total_failed_rows) for r in quality.dq_by_category(res).collect()}
    assert cats == {"completeness": (1, 1), "range": (2, 2), "domain": (1, 1)}


def test_quarantine_split_keeps_every_row_with_nulls(spark):
    df = _frame(spark)
    conds = [F.col("fare") < 0, F.col("fare") > 500]
    clean, bad = quality.quarantine_split(df, conds)
    assert clean.count() + bad.count() == df.count()          # the null fare row is not lost
    assert sorted(r.vendor for r in bad.collect()) == [2, 5]
    r = quality.reconcile(df, conds).first()
    assert (r.input_rows, r.clean_rows, r.quarantine_rows, r.balanced) == (5, 3, 2, True)
    out = quality.reconcile_outputs(df, clean, bad).first()
    assert out.balanced and out.input_rows == 5


def test_quarantine_reason_lists_fired_rules(spark):
    rules = [Rule("NEGATIVE_fare", "range", F.col("fare") < 0), Rule("NO_VENDOR", "x", F.col("vendor").isNull())]
    q = quality.quarantine_reason(_frame(spark), rules).orderBy("fare").collect()
    assert [(r._failed_rules, r._quarantine_reason) for r in q] == [
        (["NEGATIVE_fare"], "DQ_CRITICAL_FAILURE"), (["NO_VENDOR"], "DQ_CRITICAL_FAILURE")]


def test_null_profiles(spark):
    df = _frame(spark)
    prof = {r.column_name: (r.null_count, r.total_rows, r.null_pct) for r in quality.null_profile(df).collect()}
    assert prof == {"vendor": (1, 5, 20.0), "fare": (1, 5, 20.0), "flag": (1, 5, 20.0)}
    wide = quality.null_profile_wide(df).first().asDict()
    assert wide == {"vendor": 1, "fare": 1, "flag": 1}


def test_layer_report_missing_table_and_retention(spark):
    df = _frame(spark)
    rep = {(r.layer, r.table_name): (r.row_count, r.status, r.retention_pct, r.removed_rows) for r in quality.layer_report(
        [("bronze", "t", df), ("silver", "t", df.filter("fare > 0")), ("gold", "missing", None)],
        baseline=("bronze", "t")).collect()}
    assert rep[("bronze", "t")] == (5, "OK", 100.0, 0)
    assert rep[("silver", "t")] == (3, "OK", 60.0, 2)
    assert rep[("gold", "missing")] == (None, "N/A", None, None)
