"""Pages of datasets with ties, nulls and equal rows: by cursor, and through the page directory."""

import random
import re

import pytest

from ledgerline.operators import pages
from ledgerline.operators.reader import page_after


def tied(spark, n=60):
    rnd = random.Random(n)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["x", None]), rnd.choice(["OK", "BAD", None]), rnd.choice([1, None])) for _ in range(n)]
    return spark.createDataFrame(rows, "record_id string, vendor_id string, status string, n int"), rows


def quarantine(spark):
    rows = [("funding", f"reason{i % 3}", None if i % 4 else "f", f"raw {i % 9}") for i in range(40)]
    return spark.createDataFrame(rows, "source_type string, quality_errors string, source_file string, raw_record string"), rows


def walk(df, size, **filters):
    found, after = [], None
    while page := page_after(df, after, size=size, **filters).collect():
        found += [tuple(r)[:-1] for r in page]
        after = page[-1]["cursor"]
    return found


def key(row):
    return tuple((x is not None, str(x)) for x in row)


@pytest.mark.parametrize("make", [tied, quarantine])
def test_a_walk_returns_every_row_once(spark, make):
    df, rows = make(spark)
    by_seven = walk(df, 7)
    assert sorted(by_seven, key=key) == sorted(rows, key=key)
    assert walk(df, 100) == by_seven  # one order at any size


def test_a_walk_with_a_filter_and_nulls_first(spark):
    df, rows = tied(spark)
    assert sorted(walk(df, 5, status="BAD"), key=key) == sorted((r for r in rows if r[2] == "BAD"), key=key)
    order = [key(r[:3]) for r in walk(df, 9)]
    assert order == sorted(order)


@pytest.mark.parametrize("make", [tied, quarantine])
def test_the_directory_finds_the_same_pages(spark, scratch, make):
    df, _ = make(spark)
    path = f"{scratch}/pages"
    pages.write_pages(df, path, rows_per_range=9)
    whole = walk(df, 100)
    found = [[tuple(r) for r in pages.page_at(spark, path, n, 7).collect()] for n in range(1, 11)]
    assert [r for page in found for r in page] == whole and found[-1] == []
    bounds = {r["page"]: r["rows"] for r in pages.page_bounds(spark, path, 7).collect()}
    assert bounds == {n + 1: len(page) for n, page in enumerate(found) if page}
    if make is tied:
        part = [tuple(r) for n in range(1, 9) for r in pages.page_at(spark, path, n, 4, status="OK").collect()]
        assert part == [r for r in whole if r[2] == "OK"]


def test_a_page_reads_its_ranges_only(spark, scratch):
    path = f"{scratch}/pages"
    pages.write_pages(spark.range(1000).selectExpr("cast(id AS string) AS record_id"), path, rows_per_range=50)
    page = pages.page_at(spark, path, 30, 10)
    assert page.count() == 10 and pages.directory(spark, path).count() >= 20
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[[^]]*{pages.RANGE}#\d+ = \d+", plan)  # one range folder of 20 or more


def test_bounds_and_empty_frames(spark, scratch):
    df, _ = tied(spark)
    for wrong in ((0, 5), (1, 0)):
        with pytest.raises(ValueError):
            pages.page_at(spark, scratch, *wrong)
    with pytest.raises(ValueError):
        pages.write_pages(df, scratch, rows_per_range=0)
    assert walk(df.limit(0), 5) == []
