import random
import re

from pyspark.sql import functions as F

from duologue.functions.text import BLANK_CHARACTERS, squeeze


def test_squeeze_is_one_space_for_every_run_of_blanks(spark):
    draw = random.Random(1)
    pieces = [*BLANK_CHARACTERS, " ", " ", " ", "a", "é", "~", "!", "\x7f", "​", "ह", "😀"]
    texts = ["".join(draw.choices(pieces, k=draw.randint(0, 30))) for _ in range(3000)] + ["", " ", "a b", "  a", "b  ", *BLANK_CHARACTERS]
    blank = f"[{re.escape(BLANK_CHARACTERS)}]+"
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.s for r in df.select("i", squeeze(F.col("t")).alias("s")).collect()}
    assert got == {i: re.sub(blank, " ", t).strip(" ") for i, t in enumerate(texts)}
