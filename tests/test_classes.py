"""Class numbers and names: one pass over all columns, and filters on stored numbers."""

from duologue.operators import voice
from duologue.sources import clips

CLASSES = [("gender", 0, "Male"), ("gender", 1, "Female"), ("gender", 5, "Male"), ("state", 0, "Goa"), ("state", 7, "3")]


def classes(spark):
    return spark.createDataFrame(CLASSES, "column_name string, code int, name string")


def test_all_columns_in_one_pass(spark):
    rows = [(0, 0, "0", "x"), (1, 7, "9", "y"), (5, None, None, "z"), (9, 1, "", None)]
    df = spark.createDataFrame(rows, "gender int, state long, area string, names string")
    got = [tuple(r) for r in voice.decode_classes(df, classes(spark)).collect()]
    assert got == [("Male", "Goa", "0", "x"), ("Female", "3", "9", "y"), ("Male", None, None, "z"), ("9", "1", "", None)]
    assert [tuple(r) for r in voice.decode_classes(df, classes(spark).where("false")).collect()][0] == ("0", "0", "0", "x")


def test_names_turn_into_numbers(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([(i, i % 8, i % 9) for i in range(100)], "id long, gender int, state long").coalesce(1).write.parquet(path)
    raw = spark.read.parquet(path)
    decoded = voice.decode_classes(raw, classes(spark))
    for column, name in [("gender", "Male"), ("gender", "Female"), ("gender", "6"), ("gender", "1"), ("gender", "nobody"), ("state", "3"), ("state", "7"), ("state", "Goa")]:
        found = clips.named_filter(raw, classes(spark), column, name)
        want = {r.id for r in decoded.where(decoded[column] == name).collect()}
        assert {r.id for r in found.collect()} == want, (column, name)
    assert clips.named_filter(raw, classes(spark), None, "x").count() == 100
    plan = clips.named_filter(raw, classes(spark), "gender", "Male")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gender, [0,5])]" in plan


def test_text_codes(spark):
    raw = spark.createDataFrame([("0",), ("Male",), ("5",), (None,)], "gender string")
    assert sorted(r.gender for r in clips.named_filter(raw, classes(spark), "gender", "Male").collect()) == ["0", "5", "Male"]
