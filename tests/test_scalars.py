import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortlake.functions import histogram, scalars


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_lenient_int(spark):
    cells = ["7", " 8 ", "2.7", "-2.7", "x", "", None, "99999999999", "NaN", "10d", "1e2"]
    assert column(spark, cells, "string", scalars.lenient_int) == [7, 8, 2, -2, 0, 0, 0, 0, 0, 0, 100]


def test_lenient_double(spark):
    cells = ["7.5", " 8 ", "x", None, "1e3", "2.5f", "inf"]
    assert column(spark, cells, "string", scalars.lenient_double) == [
        7.5, 8.0, 0.0, 0.0, 1000.0, 0.0, float("inf"),
    ]


def test_lenient_string(spark):
    assert column(spark, ["a", None, ""], "string", scalars.lenient_string) == ["a", "null", ""]


def test_safe_ratio(spark):
    rows = spark.createDataFrame([(3, 4), (3, 0), (3, -1)], "a int, b int")
    ratios = rows.select(scalars.safe_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r["r"] for r in ratios] == [0.75, 0.0, 0.0]


def test_labels(spark):
    codes = {"Dropout": 0, "Enrolled": 1, "Graduate": 2}
    encoded = column(
        spark, ["Dropout", "Graduate", "graduate", "", None], "string",
        lambda c: scalars.encode_label(c, codes),
    )
    assert encoded == [0, 2, -1, -1, -1]
    decoded = column(spark, [1, -1, 2], "int", lambda c: scalars.decode_label(c, codes))
    assert decoded == ["Enrolled", None, "Graduate"]


def test_trunc_int(spark):
    values = [2.9, -2.9, 1e12, -1e12, float("nan"), float("inf")]
    assert column(spark, values, "double", scalars.trunc_int) == [
        2, -2, scalars.INT_MAX, scalars.INT_MIN, 0, scalars.INT_MAX,
    ]


def test_rate_label_and_pace(spark):
    assert column(spark, [0, 500], "bigint", scalars.rate_label) == ["Burst Mode", "500 rec/s"]
    assert column(spark, [0, 3], "bigint", lambda c: scalars.pace_offset_us(c, 3)) == [0, 999_999]
    assert column(spark, [5], "bigint", lambda c: scalars.pace_offset_us(c, 0)) == [0]


def test_file_timestamp(spark):
    names = ["producer_x_rate1_scale1_1700.json", "producer_x_last.json", "producer_x_17.txt"]
    assert column(spark, names, "string", scalars.file_timestamp) == [1700, None, None]


def test_short_number_follows_the_usual_general_format(spark):
    values = [500.0, 0.8, 0.77, 100.0, 500000.0, 1e6, 1.5e10, 0.00001, 1.05, 123456.7, 0.0]
    assert column(spark, values, "double", scalars.short_number) == [f"{v:g}" for v in values]


@pytest.mark.parametrize(
    "operator,expected", [(">", False), (">=", True), ("<", False), ("<=", True)]
)
def test_compare(spark, operator, expected):
    row = spark.range(1).select(
        scalars.compare(F.lit(1.0), F.lit(operator), F.lit(1.0)).alias("a"),
        scalars.compare(F.lit(None).cast("double"), F.lit(operator), F.lit(1.0)).alias("b"),
    )
    assert tuple(row.first()) == (expected, None)


def test_compare_rejects_other_operators(spark):
    with pytest.raises(PySparkException, match="unsupported operator"):
        spark.range(1).select(scalars.compare(F.lit(1.0), F.lit("!="), F.col("id"))).collect()


def test_buckets(spark):
    values = [0, 1, 2047, 2048, 2049, 4095, 4096, 4099, 10**6, 2**53 - 1, 2**62 + 5, 2**63 - 1]

    def bounds(v):
        shift = max(v.bit_length() - 11, 0)
        low = v >> shift << shift
        return low, low + (1 << shift) - 1

    tops = column(spark, values, "bigint", histogram.bucket_top)
    lows = column(spark, values, "bigint", histogram.bucket_low)
    assert list(zip(lows, tops)) == [bounds(v) for v in values]
