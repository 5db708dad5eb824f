"""Scratch tables and their removal."""

import os

import pytest

from loadsmith.scratch import materialize, scratch_path, scratch_removed
from loadsmith.session import ensure_checkpoint_dir


def folders(spark):
    return set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")))


def test_folders_of_a_block_go(spark, scratch):
    before = folders(spark)
    kept = materialize(spark.range(3), "outside")
    with scratch_removed(spark):
        rows = materialize(spark.range(5), "one")
        with scratch_removed(spark):
            materialize(spark.range(7), "inner")
        assert len(folders(spark) - before) == 2
        scratch_path(spark, "never written")
        rows.write.parquet(f"{scratch}/out")
    with pytest.raises(KeyboardInterrupt), scratch_removed(spark):
        materialize(spark.range(5), "failed")
        raise KeyboardInterrupt
    assert len(folders(spark) - before) == 1 and kept.count() == 3
    assert spark.read.parquet(f"{scratch}/out").count() == 5
    materialize(spark.range(1), "after")
    assert len(folders(spark) - before) == 2
