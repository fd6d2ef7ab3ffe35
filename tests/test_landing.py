"""CSV landing: quoted records, row width; money text decided on its digits."""
from pyspark.sql import functions as F

from retailq.functions.parse import money_cents, money_valid, positive_int_valid, strict_timestamp
from retailq.sources.landing import read_csv_strings, rectangular_violations


def test_quoted_records(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text('id,message,at\n1,"line one\nline two",a\n2,"he said ""great"", yes",b\n3,"ends in \\",c\n4,plain,d\n',
                    encoding="utf-8")
    df = read_csv_strings(spark, str(path))
    assert [(r.id, r.message, r.at) for r in df.orderBy("id").collect()] == [
        ("1", "line one\nline two", "a"), ("2", 'he said "great", yes', "b"), ("3", "ends in \\", "c"), ("4", "plain", "d")]
    assert rectangular_violations(df, "reviews").first().n == 0
    path.write_text("id,message,at\n1,a\n2,b,c,d\n3,e,f\n", encoding="utf-8")
    assert rectangular_violations(read_csv_strings(spark, str(path)), "reviews").first().n == 2


def test_money_digits(spark):
    cases = {"1.000000001": None, "10.0000000001": None, "1.00000000001": None, "1.005": None, "12.3": 1230, "1.500": 150,
             " 7 ": 700, "1e2": 10000, "1.25e1": 1250, "125e-2": 125, "125e-3": None, "1250e-3": 125, "+3.10": 310, "0": 0,
             "0e99": 0, "12345678901234567.89": 1234567890123456789, "92233720368547758.07": 2**63 - 1,
             "92233720368547758.08": None, "1e30": None, "1e999999999999": None, "12\n": 1200, "abc": None, "": None, ".5": 50}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, v long")
    got = {r.t: (r.c, r.ok) for r in rows.select("t", money_cents(F.col("t")).alias("c"), money_valid(F.col("t")).alias("ok")).collect()}
    assert got == {k: (v, v is not None) for k, v in cases.items()}
    signed = rows.select(money_cents(F.lit("-1.5"), True).alias("n"), money_cents(F.lit("-1.5")).alias("none")).first()
    assert (signed.n, signed.none) == (-150, None)


def test_final_newline_is_refused(spark):
    row = spark.range(1).select(strict_timestamp(F.lit("2018-01-01 00:00:00\n")).alias("t"),
                                positive_int_valid(F.lit("12\n")).alias("i")).first()
    assert row.t is None and row.i is False
