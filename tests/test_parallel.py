import pytest
from pyspark.sql import functions as F

from tierlake.plans.parallel import side_by_side


def test_results_come_back_by_name(spark):
    steps = {str(n): lambda n=n: spark.range(n).agg(F.sum("id")).first()[0] for n in (2, 5, 10)}
    assert side_by_side(spark, steps) == {"2": 1, "5": 10, "10": 45}
    assert side_by_side(spark, {}) == {}


def test_an_error_is_raised_after_the_others_have_finished(spark):
    done = []

    def fail():
        raise ValueError("stopped")

    with pytest.raises(ValueError, match="stopped"):
        side_by_side(spark, {"bad": fail, "good": lambda: done.append(spark.range(3).count())})
    assert done == [3]
