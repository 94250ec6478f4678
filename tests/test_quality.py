import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import quality

RULES = {"valid_amount": "amount > 0"}


@pytest.fixture
def amounts(spark):
    return spark.createDataFrame([(10,), (0,), (-5,), (None,)], "amount int")


def test_warn_keeps_all_and_counts(amounts):
    seen = Observation()
    assert quality.expect(amounts, RULES, "warn", seen).collect().__len__() == 4
    assert seen.get == {"rows": 4, "valid_amount": 3, "violating_rows": 3}


def test_drop_removes_false_and_null(amounts):
    seen = Observation()
    kept = quality.expect(amounts, RULES, "drop", seen).collect()
    assert [r["amount"] for r in kept] == [10]
    assert seen.get["valid_amount"] == 3


def test_fail_writes_nothing(amounts, new_path, spark):
    path = new_path()
    with pytest.raises(Exception, match="expectation valid_amount failed"):
        quality.expect(amounts, RULES, "fail").write.parquet(path)
    from tidemark.storage.versioned import Files

    assert not Files(spark).exists(f"{path}/_SUCCESS")
    good = amounts.filter("amount > 0")
    assert quality.expect(good, RULES, "fail").count() == 1


def test_rules_are_counted_independently(amounts):
    rules = {**RULES, "known": "amount IS NOT NULL", "small": "amount < 5"}
    got = {r["rule"]: r["violations"] for r in quality.rule_metrics(amounts, rules).collect()}
    assert got == {"valid_amount": 3, "known": 1, "small": 2}


def test_split_and_quarantine(amounts, new_path, spark):
    rules = {**RULES, "known": "amount IS NOT NULL"}
    good, bad = quality.split(amounts, rules)
    assert good.count() == 1
    assert {r["amount"]: r["failed_rules"] for r in bad.collect()} == {
        0: "valid_amount",
        -5: "valid_amount",
        None: "valid_amount,known",
    }
    path = new_path()
    quality.write_quarantined(amounts, rules, path)
    assert spark.read.parquet(f"{path}/is_bad=true").count() == 3


def test_violation_rate(amounts):
    row = quality.violation_rate(quality.rule_metrics(amounts, RULES)).first()
    assert (row["rate"], row["alert"]) == (0.75, True)


@pytest.mark.parametrize(
    "expr",
    [
        "sum(amount) > 0",
        "row_number() OVER (ORDER BY amount) > 1",
        "rand() > 0.5",
        "amount > (SELECT 1)",
        "amount IN (SELECT 1)",
        "explode(array(true))",
        "amount + 1",
        "nonsense > 0",
        "current_user_function(amount)",
        "py_rule(amount)",
    ],
)
def test_rules_must_be_plain_row_expressions(amounts, spark, expr):
    spark.udf.register("py_rule", lambda x: x == 1, "boolean")
    with pytest.raises(quality.RuleError):
        quality.validate_rule(amounts, expr)


def test_ordinary_rules_pass(amounts):
    for expr in ("amount > 0", "amount IS NOT NULL AND abs(amount) < 5", "coalesce(amount, 0) IN (1, 2)"):
        quality.validate_rule(amounts, expr)


def test_rules_on_an_aggregated_frame(amounts):
    totals = amounts.groupBy().agg(F.sum("amount").alias("total"))
    quality.validate_rule(totals, "total > 0")


def test_require_rows(amounts):
    assert quality.require_rows(amounts, "none") is amounts
    with pytest.raises(ValueError, match="no source rows"):
        quality.require_rows(amounts.filter(F.lit(False)), "no source rows")


def test_unknown_action(amounts):
    with pytest.raises(ValueError, match="action"):
        quality.expect(amounts, RULES, "shout")
