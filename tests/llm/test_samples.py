"""Samples that models are fitted on, where one text has most of the rows."""

from pyspark.sql import functions as F

from breathline.llm import langid, maincontent


def test_copies_leave_room_for_other_texts(spark):
    hot = spark.range(30_000).select(F.lit("the one text that is copied").alias("text"), F.lit("en").alias("lang"))
    rest = spark.range(600).select(F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    few = spark.createDataFrame([("un seul texte", "fr")] * 50 + [("un autre", "fr")], "text string, lang string")
    got = langid.sample(hot.unionByName(rest).unionByName(few), "text", "lang", 50)
    assert len(got) == len(set(got)) and [g for g, _ in got].count("en") == 50
    assert [t for g, t in got if g == "fr"] == ["un autre", "un seul texte"]


def test_copies_of_a_page_do_not_move_the_text_model(spark):
    page = "<html><body><article><p>{0} words of an article, long enough to read, number {0}.</p></article><nav><a href='/'>Home {0}</a></nav></body></html>"
    pages = [page.format(i) for i in range(12)]
    copied = spark.createDataFrame([(p,) for p in pages + [pages[0].replace("words", "x")] * 400], "html string")
    once = spark.createDataFrame([(p,) for p in pages + [pages[0].replace("words", "x")]], "html string")
    weights = [maincontent.fit_text_model(df) for df in (copied, once)]
    assert abs(weights[0] - weights[1]).max() < 1e-9 and abs(weights[1]).max() > 0
