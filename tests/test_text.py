import pytest
from pyspark.sql import functions as F

from talkloom.functions import text
from talkloom.functions.numbers import cardinal, ordinal, spoken, year


def one(spark, expr, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} {'double' if isinstance(v, float) else 'int' if isinstance(v, int) else 'string'}" for i, v in enumerate(values)))
    return df.select(expr.alias("x")).first().x


def test_numbers():
    assert spoken("Seat 34C, boarding at 10:30, flight KL 1234, about 2.5 hours, 50%") == "Seat thirty-four C, boarding at ten thirty, flight KL one two three four, about two point five hours, fifty percent"
    assert spoken("gate B12 at 9:05 pm, $5.20, 1,200 and 22nd") == "gate B twelve at nine oh five p m, five dollars twenty, one thousand two hundred and twenty-second"
    assert [cardinal(n) for n in (0, 13, 100, 101, 21_000, 999_999)] == ["zero", "thirteen", "one hundred", "one hundred one", "twenty-one thousand", "nine hundred ninety-nine thousand nine hundred ninety-nine"]
    assert [ordinal(n) for n in (1, 12, 20, 101)] == ["first", "twelfth", "twentieth", "one hundred first"]
    assert [year(n) for n in (1999, 2000, 2005, 2010, 1900)] == ["nineteen ninety-nine", "two thousand", "two thousand five", "twenty ten", "nineteen hundred"]
    assert spoken(None) is None and spoken("") == "" and spoken("1000000") == "one zero zero zero zero zero zero"


def test_forms(spark):
    c = F.col("c0")
    assert one(spark, text.crew_form(c), " I'll CHECK, now!  ok ") == "i'll check now ok"
    assert one(spark, text.letters_only(c), "Don't  STOP-3!") == "don'tstop3"
    assert one(spark, text.n_words(c), "a 12 b3 c -- ") == 3
    assert one(spark, text.relabelled(c), "A: Hi There\nB: OK, Fine!\nno colon\nX: y") == "passenger: Hi There\ncrew: ok fine\nno colon\nX: y"
    assert one(spark, text.user_message(c, F.lit("")), "a: x  \n\n  \nb: y") == "a: x\nb: y" + text.TAIL
    assert one(spark, text.tagged(c), " hi ") == "<system> hi <system>" and one(spark, text.tagged(c), "<system> hi <system>") == "<system> hi <system>"
    assert one(spark, text.embedded_json(c), 'x <think>{"a"}</think> {"b": {"c": 1}} y') == '{"b": {"c": 1}}'
    assert one(spark, text.embedded_json(c), "none") is None
    assert one(spark, text.reason_form(c), "min 0.71 [a, b] 12") == "min # [..] #"
    assert [one(spark, text.prompt_level(c), r) for r in (0.5, 0.51, 0.66, 0.81, 0.96, 1.0)] == [0, 1, 2, 3, 4, 5]
    assert [one(spark, text.small_number(c), n) for n in (0, 20, 45, 99, 100)] == ["zero", "twenty", "forty-five", "ninety-nine", None]
    assert one(spark, text.shouts(c), "NO MORE TEAS") and not one(spark, text.shouts(c), "NO TEA")
    assert one(spark, text.sounds_like_crew(c), "I can offer you tea") and not one(spark, text.sounds_like_crew(c), "is there anything you can do")
    with pytest.raises(ValueError):
        text.filled("{{a}} {{b}}", {"a": F.lit(1)})


def test_nulls(spark):
    df = spark.sql("select cast(null as string) c0, cast(null as double) r")
    got = df.select(text.n_words(F.col("c0")), text.crew_form(F.col("c0")), text.shouts(F.col("c0")), text.sounds_like_crew(F.col("c0")), F.size(text.tokens(F.col("c0")))).first()
    assert tuple(got) == (0, None, False, False, 0)
