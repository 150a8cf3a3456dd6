import os

import pytest

from tessera.operators import matrix
from tessera.plans.views import ratings
from tessera.session import checkpoint_dir, scratch, shared_table
from tests.conftest import SF_SMALL


def folder(spark):
    return checkpoint_dir(spark).removeprefix("file:")


def tables(spark):
    return set(os.listdir(folder(spark)))


def test_scratch_deletes_the_tables_made_inside(spark):
    before = shared_table(spark.range(5), "kept")
    had = tables(spark)
    with scratch(spark):
        inner = shared_table(spark.range(7), "gone")
        with scratch(spark):
            shared_table(spark.range(1), "sooner")
            assert len(tables(spark) - had) == 2
        assert len(tables(spark) - had) == 1 and inner.count() == 7
    assert tables(spark) == had and before.count() == 5


def test_tables_go_after_an_error_too(spark):
    had = tables(spark)
    with pytest.raises(ZeroDivisionError), scratch(spark):
        shared_table(spark.range(3), "gone")
        raise ZeroDivisionError
    assert tables(spark) == had
    shared_table(spark.range(3), "kept")                     # no block is open any more
    assert len(tables(spark) - had) == 1


def test_an_operators_helper_tables_go_once_its_result_is_written(spark, tmp_path):
    had, want = tables(spark), matrix.cosine_similarity(ratings(spark, SF_SMALL)).count()
    left = tables(spark) - had
    assert left                                              # without a block they stay
    with scratch(spark):
        matrix.cosine_similarity(ratings(spark, SF_SMALL)).write.parquet(f"{tmp_path}/sim")
        assert tables(spark) - had > left
    assert tables(spark) == had | left
    assert spark.read.parquet(f"{tmp_path}/sim").count() == want > 0
