import pytest
from pyspark.sql import functions as F

from kinweave.functions import text


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(column(F.col("v"))).collect()]


def test_normalize(spark):
    got = one(spark, text.normalize_text, "Ｃａｆé & Fils — Paris\t", "N/A", "NULL", "NaN", "", None, "STRAẞE ß", "कृष्ण")
    assert got == ["café and fils paris", "n a", "null", "nan", "", "", "strasse ss", "कृष्ण"]
    assert one(spark, text.normalize_text, *got) == [x or "" for x in got]


def test_fold(spark):
    assert one(spark, lambda c: text.fold_diacritics(text.normalize_text(c)), "Café Ñandú") == ["cafe nandu"]


def test_legal_names(spark):
    legal = lambda c: text.legal_name(text.normalize_text(c))
    names = ("Acme Private Limited", "Limited", "Acme Company of Inc", "")
    assert one(spark, legal, *names) == ["acme pvt ltd", "ltd", "acme co of inc", ""]
    assert one(spark, lambda c: text.core_name(legal(c)), *names) == ["acme", "ltd", "acme co of", ""]
    assert one(spark, lambda c: text.acronym(legal(c)), "The Bank of New York Limited", "3 Wise Men") == ["bny", "wm"]


def test_numbers(spark):
    numbers = lambda c: text.number_tokens(text.normalize_text(c))
    assert one(spark, numbers, "Unit ００７, ١٢, 003", "0 00", "none") == [["12", "3", "7"], ["0"], []]


def test_alternate_view(spark):
    r = one(spark, lambda c: text.alternate_view(text.normalize_text(c)), "12B Main Street Apartment 007 12")[0]
    assert (r.text, r.numbers, r.without_numbers) == ("12 b main st apt 007 12", ["12", "7", "12"], "b main st apt")


def test_scripts(spark):
    assert one(spark, text.scripts, "abc где 漢字", "123") == [["CYRILLIC", "HAN", "LATIN"], []]
    assert one(spark, text.nonlatin, "abc", "abγ", "12") == [False, True, False]


def test_romanize_texts(spark):
    assert text.romanize_texts(spark, ["कृष्ण"]) == {"कृष्ण": "krsna"}


def test_ids(spark):
    df = spark.createDataFrame([("S2-7",), ("S3-0",)], "i string")
    got = df.select(text.encode_target(F.col("i")).alias("c")).select("c", text.decode_target(F.col("c")).alias("b")).collect()
    assert [tuple(r) for r in got] == [(2 * 10**12 + 7, "S2-7"), (3 * 10**12, "S3-0")]
    for bad in ("S1-1", "S2-01", "S2-1000000000000", "x"):
        with pytest.raises(Exception, match="not a target id"):
            spark.createDataFrame([(bad,)], "i string").select(text.encode_target(F.col("i"))).collect()
