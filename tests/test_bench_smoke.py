"""bench.py's headline list is registered and its timing path runs."""

import bench
from loadsmith.registry import queries


def test_headline_queries_are_registered():
    assert set(bench.HEADLINE) <= set(queries())


def test_run_once(spark):
    assert bench.run_once(spark, queries()["emp_load"], "/root/testdata/sf0.001") > 0
