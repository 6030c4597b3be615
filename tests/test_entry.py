"""Driver contract: entry smoke, registered queries and their oracles line up."""

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert "status" in df.columns and df.count() > 0


def test_every_query_has_an_oracle():
    import oracle_sql
    from ledgerline.plans.queries import QUERIES

    assert set(QUERIES) == set(oracle_sql.queries())
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_small_queries_match_schema(spark):
    qs = entry.queries()
    for name in ("status_distribution", "quality_metrics", "current_snapshot"):
        df = qs[name](spark, "/root/testdata/sf0.001")
        assert df.count() > 0, name


def test_entry_without_the_training_data_operators(tmp_path):
    """queries() and oracle_sql() work where the subpackage, its tests and perhaps the pipeline are gone."""
    import os
    import shutil
    import subprocess
    import sys

    top = os.path.dirname(os.path.abspath(entry.__file__))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') for q in e.queries()))"
    for case, gone in {"pipeline stays": (), "all gone": ("corpus_pipeline.py",)}.items():
        copy = tmp_path / case.replace(" ", "-")
        shutil.copytree(os.path.join(top, "ledgerline"), copy / "ledgerline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        for name in {"__spark_entry__.py", "oracle_sql.py", "corpus_pipeline.py"} - set(gone):
            if os.path.exists(os.path.join(top, name)):
                shutil.copy(os.path.join(top, name), copy / name)
        (copy / "ledgerline" / "llm" / "__pycache__").mkdir(parents=True)  # what a deletion may leave behind
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
        from ledgerline.plans.queries import QUERIES

        assert done.returncode == 0, done.stderr
        assert done.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), "False"]
