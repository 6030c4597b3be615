"""Work is done once: casts of a validation, rows of a page directory, drops of a walk and of hash trees."""

import re
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from ledgerline.contracts import FUNDING_FIELDS
from ledgerline.functions.digests import LIMBS, limb_sums, limbs, row_digest, with_limbs, word_sums, words
from ledgerline.functions.money import SHARE, WHOLE, per_unit_sql, percent_sql
from ledgerline.operators import measures, pages
from ledgerline.operators.measures import funding_measures
from ledgerline.operators.validation import ERRORS, picked, quarantine, reason_counts, tag
from ledgerline.plans.ledger import DUE, IDENTITY, due_funding, silver
from ledgerline.session import QUERY_CONF
from ledgerline.sources.adapter import payout_drops


@pytest.fixture(scope="module")
def lineitem_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    n = F.col("id")
    rows = spark.range(1200).select(
        n.alias("l_orderkey"), F.when(n % 4 == 0, 97).otherwise(n % 96 + 1).alias("l_partkey"), (n % 9).alias("l_suppkey"), (n % 7).cast("int").alias("l_linenumber"),
        (n % 50 + 1).cast("double").alias("l_quantity"), (n * 1.25 + 900).alias("l_extendedprice"), F.lit(0.04).alias("l_discount"),
        F.lit(0.02).alias("l_tax"), F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.date_add(F.lit("1998-06-01").cast("date"), (n % 30).cast("int")).cast("timestamp").alias("l_shipdate"),
    )
    rows.write.parquet(f"{folder}/lineitem.parquet")
    return folder


def payouts(spark):
    rows = [(f"P{i}", "R", "V", "2026-10-01", "INR", amount, None, "2026-10-01T01:00:00Z", "2026-10-01") for i, amount in enumerate(["1.00", "1.005", "x", None])]
    return spark.createDataFrame(rows, "payout_id string, record_id string, vendor_id string, event_date string, currency string, amount string, reversal_of string, updated_at string, batch_date string")


def test_no_reason_is_evaluated_again_by_a_filter(spark):
    tagged = tag(payouts(spark), "payouts")
    rejected = quarantine(picked(tagged, False), "payouts")
    assert rejected.count() == 3 and picked(tagged, True).columns == tagged.columns
    assert [r["payout_id"] for r in picked(tagged, True).collect()] == ["P0"]
    assert {r["reason"]: r["rows"] for r in reason_counts(tagged).collect()} == {"invalid_amount": 2, "invalid_money_precision_or_range_amount": 3}
    for frame in (rejected, picked(tagged, True), reason_counts(tagged)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and ("concat_ws" in line or "amount" in line)]
    assert ERRORS in rejected.columns


def test_whole_cents_round_like_decimals(spark):
    amounts = ["0.00", "0.01", "-0.01", "0.03", "-0.05", "10.00", "123456.78", "-99999.99", SHARE, "100000000.01", "-100000000.01", WHOLE, "10000000000000000.01", "-99999999999999999.99", None]
    cases = [(a, b, q) for a in amounts for b in amounts for q in (1, 2, 3, 7, 8, 200, 100_000, -3)]
    df = spark.createDataFrame(cases, "a string, b string, quantity int").selectExpr("cast(a as decimal(20,2)) a", "cast(b as decimal(20,2)) b", "quantity")
    plain = "case when b = 0 then 0 else round(a / b * 100, 2) end"
    both = df.selectExpr("*", f"{per_unit_sql('a')} u", f"{percent_sql('a', 'b')} p", "round(a / quantity, 2) u0", f"{plain} p0")
    rows = both.collect()
    assert len(rows) == len(cases)
    for r in rows:
        assert (r["u"], r["p"]) == (r["u0"], r["p0"])
        if r["a"] is not None:
            assert r["u"] == (r["a"] / r["quantity"]).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_pages_compute_their_rows_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(0, 500, 1, 4).select(F.col("id").cast("string").alias("record_id")).mapInPandas(counted, "record_id string")
    pages.write_pages(df, f"{scratch}/p", rows_per_range=100)
    assert seen.value == 500
    assert pages.page_at(spark, f"{scratch}/p", 10, 50).count() == 50


def test_a_walk_and_a_comparison_read_what_was_written(spark, lineitem_dir):
    queries = __spark_entry__.queries()
    walk = queries["quarantine_walk"](spark, lineitem_dir)
    assert not any("lineitem" in f for f in walk.inputFiles())
    changes = queries["source_changed_rows"](spark, lineitem_dir)
    assert any("/payouts/" in f for f in changes.inputFiles())
    assert "net_payable" not in changes._jdf.queryExecution().optimizedPlan().toString()  # no ledger is derived again
    assert {(r["source"], r["change"]) for r in changes.select("source", "change").distinct().collect()} >= {("funding", "removed"), ("payouts", "added")}


def test_settings_of_the_ledger_queries_are_taken_back(spark, lineitem_dir):
    before = {key: spark.conf.get(key) for key in QUERY_CONF}
    __spark_entry__._prepare(spark)
    assert {key: spark.conf.get(key) for key in QUERY_CONF} == QUERY_CONF
    __spark_entry__._prepare(spark, ledger=False)
    after = {key: spark.conf.get(key) for key in QUERY_CONF}
    assert after != QUERY_CONF and (before == QUERY_CONF or after == before)


def plan_of(df):
    """The optimized plan with all its columns."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        return df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def funding(spark, rows):
    """Funding drops of usual values, but for the fields that each row names."""
    usual = dict(
        record_id="F1", vendor_id="V1", order_id="O1", event_date="2026-10-01", updated_at="2026-10-01T01:00:00Z", currency="INR", quantity="3",
        unit_price="99.99", discount_rate="0.10", return_rate="0.05", commission_rate="0.12", tax_rate="0.18", withholding_rate="0.01",
        logistics_per_unit="15", marketing_rate="0.02", rebate_rate="0.03", penalty="5", adjustment="-2.50",
    )
    schema = ", ".join(f"{c} string" for c in (*FUNDING_FIELDS, "batch_date", "source_file"))
    return spark.createDataFrame([(*(dict(usual, **r)[c] for c in FUNDING_FIELDS), "2026-10-01", "raw/f.csv") for r in rows], schema)


ODD = [
    {}, {"quantity": "7", "unit_price": "0.05"}, {"unit_price": "0"}, {"adjustment": "-9999999.99"}, {"adjustment": "10000000000.01"}, {"penalty": None},
    {"unit_price": "1000000000", "quantity": "10"}, {"unit_price": "1000000000", "quantity": "11"}, {"unit_price": "-4.35"}, {"unit_price": "12.345"},
    {"tax_rate": "1.5"}, {"tax_rate": None}, {"discount_rate": "1", "return_rate": "0.333333"}, {"quantity": "-2"}, {"quantity": "x"}, {"discount_rate": "-0.1"},
    {"unit_price": "999999999999999999.99", "quantity": "100000"}, {"logistics_per_unit": "99999999999", "adjustment": None},
]


def test_measures_in_whole_cents_are_those_in_decimals(spark, monkeypatch):
    """Rows of usual size have no wide decimal until the last projection, and the same measures as by the decimal formulas."""
    drops = funding(spark, [dict(r, record_id=f"F{i}") for i, r in enumerate(ODD)])
    made = funding_measures(drops)
    assert "_net_payable__whole" in plan_of(made)
    monkeypatch.setattr(measures, "WITHIN", "false")
    plain = funding_measures(drops)
    assert made.dtypes == plain.dtypes
    assert sorted(made.collect(), key=str) == sorted(plain.collect(), key=str)


def test_digests_make_each_text_once(spark):
    df = spark.createDataFrame([(1, "a", "1.50"), (None, None, None), (2, "", "-0.01")], "n int, t string, m string").withColumn("m", F.col("m").cast("decimal(20,2)"))
    made, direct = with_limbs(df, ["n", "t", "m"]), df.select("*", *limbs(row_digest(["n", "t", "m"])))
    assert made.columns == direct.columns and made.collect() == direct.collect()
    assert len(re.findall(r"cast\(m#\d+ as string\)", plan_of(made))) == 1


def test_due_funding_shuffles_its_columns_only(spark):
    rows = [dict(r, record_id=f"F{i}") for i, r in enumerate(ODD)]
    rows += [dict(record_id="F0", quantity=q, updated_at="2026-10-01T02:00:00Z") for q in ("4", "5", "0")]  # a tie, and no quantity
    tagged = tag(funding(spark, rows), "funding")
    due = due_funding(tagged, (*DUE, *IDENTITY))
    whole = funding_measures(silver(tagged, "funding")).select(*DUE, *IDENTITY)
    assert due.dtypes == whole.dtypes and sorted(due.collect(), key=str) == sorted(whole.collect(), key=str)
    plan = plan_of(due)
    aggregate = next(line for line in plan.splitlines() if "Aggregate" in line)
    assert "net_payable" in aggregate and "penalty" not in aggregate


def test_payouts_are_exploded_from_a_column(spark):
    """A generator may be interpreted, so it holds no expression to evaluate."""
    drops = payout_drops(due_funding(tag(funding(spark, [{"record_id": "F1-1"}]), "funding")))
    plan = plan_of(drops)
    assert not [line for line in plan.splitlines() if "Generate" in line and "CASE" in line]


def test_measures_are_made_in_two_projections(spark):
    """The depth of the formulas adds no projection that copies the row."""
    plan = plan_of(funding_measures(funding(spark, [{}])))
    assert sum(line.lstrip(" :+-").startswith("Project") for line in plan.splitlines()) <= 5
    assert len([line for line in plan.splitlines() if "AS _net_payable__whole" in line]) == 1


def test_sums_of_words_are_those_of_limbs(spark):
    """Whatever the quarters' signs, and without a row too; nothing is a decimal before the sums are put together."""
    df = spark.createDataFrame([(i, str(i * 7919)) for i in range(500)] + [(None, None)] * 3, "n int, t string")
    digest = row_digest(["n", "t"])
    sums = lambda rows: rows.agg(*word_sums(words(digest))).first()
    assert sums(df) == df.select(*limbs(digest)).agg(*limb_sums()).first()
    assert all(value is None for value in sums(df.limit(0)))
    signs = df.select(*[word.alias(name) for name, word in words(digest).items()])
    assert {kind for _, kind in signs.dtypes} == {"bigint"} and signs.filter(f"{LIMBS[0]} < 0").count() > 0 < signs.filter(f"{LIMBS[0]} > 0").count()
