"""Every catalogue query against its SQL twin, those without one for rows and a stable schema."""

import pytest
from oracle import differences

from strataforge import queries as Q


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, sf, name):
    df = Q.QUERIES[name](spark, sf)
    if name in Q.SQL:
        assert differences(df, Q.SQL[name], sf) == []
    else:
        assert df.count() > 0


def test_results_do_not_depend_on_partitions(spark, sf):
    def rows(name):
        return sorted(map(repr, Q.QUERIES[name](spark, sf).collect()))

    names = ("hash_search_topk", "rank_topn", "greedy_dedup", "chunk_plan_full", "bfs_depth", "upsert_last_wins")
    before = {n: rows(n) for n in names}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert {n: rows(n) for n in names} == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
    assert set(Q.SQL) <= set(__spark_entry__.queries())


def test_everything_else_stands_without_the_optional_subpackage(tmp_path):
    """A copy of the repository without it imports, and offers the other queries."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/strataforge", tmp_path / "strataforge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'hash_search_topk' in q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
