import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.functions import numeric

EDGES = [0.0, 0.125, 0.375, 1.005, 1.115, 2.25, 2.35, 2.45, 0.5, 1.5, 2.5, 99.995, 45.48119058750195]
EDGES += [5e-324, 1e-9, 0.045, 0.05, 0.15, 0.25, 1234567.125, -0.125, -2.5, -0.001, -0.0, 12.0]


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(7)
    drawn = [rng.uniform(-1000, 1000) for _ in range(400)]
    drawn += [rng.randrange(100_000) / 1000 for _ in range(800)]
    return spark.createDataFrame([(x,) for x in EDGES + drawn], "x double").cache()


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_fixed_text_equals_c_formatting(numbers, digits):
    for row in numbers.select("x", numeric.fixed_text(F.col("x"), digits).alias("t")).collect():
        assert row["t"] == f"{row['x']:.{digits}f}"


@pytest.mark.parametrize("digits", [1, 2])
def test_round_exact_equals_python(numbers, digits):
    for row in numbers.select("x", numeric.round_exact(F.col("x"), digits).alias("r")).collect():
        assert row["r"] == round(row["x"], digits)


def test_round_scaled_equals_numpy(numbers):
    for row in numbers.select("x", numeric.round_scaled(F.col("x"), 1).alias("r")).collect():
        assert row["r"] == np.round(row["x"], 1)


def test_truncate_cuts_toward_zero(numbers):
    for row in numbers.select("x", numeric.truncate2(F.col("x")).alias("r")).collect():
        assert row["r"] == int(row["x"] * 100) / 100


def test_missing_values_stay_missing(spark):
    df = spark.sql("SELECT cast(null AS double) AS x")
    row = df.select(
        numeric.fixed_text(F.col("x"), 2),
        numeric.round_exact(F.col("x"), 1),
        numeric.truncate2(F.col("x")),
    ).first()
    assert list(row) == [None, None, None]


def test_truncate_of_nan_is_missing(spark):
    row = spark.sql("SELECT double('NaN') AS x").select(numeric.truncate2(F.col("x"))).first()
    assert row[0] is None


def test_snap_removes_summation_noise(spark):
    row = spark.sql("SELECT 0.1D + 0.2D AS x").select(numeric.snap(F.col("x"))).first()
    assert row[0] == 0.3 and not math.isclose(0.1 + 0.2, 0.3, rel_tol=0)


def test_large_and_infinite_numbers_have_a_text(spark):
    numbers = [2.0**53, -(2.0**53) - 2, 9.1e16, 1e17, 2.0**62, 1e18, -1e300, math.inf, -math.inf, math.nan]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    for digits in (0, 1, 2):
        for row in df.select("x", numeric.fixed_text(F.col("x"), digits).alias("t")).collect():
            want = f"{row['x']:.{digits}f}"
            if abs(row["x"]) == 1e300:  # in its shortest digits
                want = "-1" + "0" * 300 + ("." + "0" * digits if digits else "")
            assert row["t"] == want
    rounded = df.where("x < 1e30 and x > -1e30").select("x", numeric.round_exact(F.col("x"), 1).alias("r"))
    assert all(r["x"] == r["r"] for r in rounded.collect())
