import math

import pytest
from pyspark.sql import functions as F

from corpuscle.functions import vectors as V


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [
        ([1.0, 2.0, 3.0], [1.0, 2.0, 3.0]), ([1.0, 0.0, 0.0], [0.0, 1.0, 0.0]), ([0.0, 0.0], [1.0, 1.0]),
        ([3.0, 4.0], [3.0, 4.0, 12.0]), ([], [1.0]),
    ]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a array<float>, b array<float>")


def test_cosine_forms(pairs):
    a, b = F.col("a"), F.col("b")
    rows = pairs.orderBy("i").select(V.cosine(a, b), V.cosine_strict(a, b), V.dot(a, b)).collect()
    assert rows[0] == pytest.approx((1.0, 1.0, 14.0), abs=1e-9)
    assert tuple(rows[1]) == (0, 0, 0) and tuple(rows[2]) == (0, 0, 0)
    assert rows[3] == pytest.approx((25 / (5 * 13), 0.0, 25.0), abs=1e-9)
    assert tuple(rows[4]) == (0, 0, 0)


def test_normalize_add_subtract_distance(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    a, z = F.col("a"), F.col("z")
    unit, zero, plus, minus, near, dim = df.select(
        V.l2_normalize(a), V.l2_normalize(z), V.add(a, a), V.subtract(z, a), V.euclidean_score(a, z), V.dimension(a)
    ).first()
    assert unit == pytest.approx([0.6, 0.8]) and zero == [0, 0] and plus == [6, 8] and minus == [-3, -4]
    assert near == pytest.approx(1 / 26) and dim == 2


def test_fixed_point(spark):
    value = spark.sql("select 1.0000005d v").select(V.fixed_point(F.col("v"))).first()[0]
    assert math.isclose(value, 1.000001, abs_tol=1e-12)
