from pyspark.sql import functions as F

from docsift.functions import text as T


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_text_cases(spark):
    assert one(spark, T.clean_text("x"), "a\nb .c  .d") == "ab.c .d"
    assert one(spark, T.clean_text("x"), "") == ""
    assert one(spark, T.clean_text("x"), "\n\n\n") == ""
    assert one(spark, T.clean_text("x"), None) is None
    assert one(spark, T.clean_text("x", newline="space"), "a\nb") == "a b"


def test_tokens_and_counts(spark):
    assert one(spark, T.token_count("x"), "a b  c\td") == 4
    assert one(spark, T.token_count("x"), "   ") == 0
    assert one(spark, T.terms("x"), "Héllo, WÖRLD ça 3.14") == ["héllo", "wörld", "ça", "3", "14"]


def test_sentences_lose_no_character(spark):
    txt = "First one. Second?! third without stop\nand more... end"
    s = one(spark, T.sentences("x"), txt)
    assert "".join(s) == txt
    assert s[0] == "First one."


def test_paragraphs_drop_blank(spark):
    assert one(spark, T.paragraphs("x"), "a\n\n\nb\n \nc\n") == ["a", "b", "c"]


def test_truncate(spark):
    assert one(spark, T.truncate_tokens("x", 2), "a  b c") == "a b"


def test_article_cases(spark):
    assert one(spark, T.article("x"), "<html><p>no container</p></html>") is None
    assert one(spark, T.article("x"), None) is None
    assert one(spark, T.article("x"), "<article>   </article>") is None
    assert one(spark, T.article("x"), "<article> <p>a<b>b</article><article>2</article>") == "<p>a<b>b"


def test_container_parser_nested(spark):
    from docsift.sources.web import container_udf
    html = ('<div class="x"><div itemprop="articleBody"><div>inner</div><p>t</p></div>'
            '<div>after</div></div>')
    df = spark.createDataFrame([(html,), ("<p>none</p>",), (None,)], "html string")
    got = [r[0] for r in df.select(container_udf("div", itemprop="articleBody")("html")).collect()]
    assert got == ['<div itemprop="articleBody"><div>inner</div><p>t</p></div>', None, None]


def test_strip_tags(spark):
    assert one(spark, T.strip_tags("x"), "<p>a <b>b</b></p><script>var x=1;</script>c") == "a b c"
