import pytest
from pyspark.sql import functions as F

from corpuslm.functions import text as tx
from tests import brute


def one(spark, value, expression):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, tokens",
    [
        (" Hi  all,\n\nIé read. ", ["", "hi", "", "all,", "", "ié", "read."]),
        ("   ", []),
        ("", [""]),
        (None, [""]),
        ("a\x0bb\tc\fd\re", ["a", "b", "c", "d", "e"]),
        ("end \t\n", ["end"]),
        ("no break", ["no break"]),
    ],
)
def test_ws_tokens(spark, text, tokens):
    assert one(spark, text, tx.ws_tokens) == tokens
    if text is not None:
        assert brute.ws_tokens(text) == tokens


@pytest.mark.parametrize(
    "text, tokens",
    [
        (" Hi  all,\n\nIé read. ", ["hi", "all", "i", "read"]),
        ("...", []),
        ("", []),
        (None, []),
        ("snake_case x2-y", ["snake_case", "x2", "y"]),
    ],
)
def test_word_tokens(spark, text, tokens):
    assert one(spark, text, tx.word_tokens) == tokens


def test_tokenizers_agree_with_spark_ml(spark, documents):
    from pyspark.ml.feature import RegexTokenizer, Tokenizer

    df = Tokenizer(inputCol="text", outputCol="a").transform(documents)
    df = RegexTokenizer(inputCol="text", outputCol="b", pattern="\\W").transform(df)
    same = (F.col("a") == tx.ws_tokens(F.col("text"))) & (F.col("b") == tx.word_tokens(F.col("text")))
    assert df.where(~same).count() == 0


def test_collapse_keeps_the_ends(spark):
    assert one(spark, "  a \n\t b  ", tx.collapse_ws) == " a b "


@pytest.mark.parametrize(
    "document, body",
    [('{"article":{"body":"hi"}}', "hi"), ('{"x":1}', ""), ("bad", ""), (None, ""), ('{"article":{"body":""}}', "")],
)
def test_json_text(spark, document, body):
    assert one(spark, document, tx.json_text) == body


def test_html_text(spark):
    html = "<html><script>var a = '<b>';</script><STYLE>p{}</STYLE><p>One\n two</p><!-- no --></html>"
    assert one(spark, html, tx.html_text) == " One two "


@pytest.mark.parametrize(
    "url, host",
    [
        ("https://www.a.example/x?y#z", "www.a.example"),
        ("http://user:pw@b.example:8080/", "b.example"),
        ("no url", ""),
        ("http://c.example", "c.example"),
    ],
)
def test_host(spark, url, host):
    assert one(spark, url, tx.host) == host


def test_post_key(spark):
    df = spark.createDataFrame([(None, "d1"), ("a", None), ("a", "d")], "a string, c string")
    keys = [r[0] for r in df.select(tx.post_key(F.col("a"), F.col("c"))).collect()]
    assert keys == ["_d1", "a_", "a_d"]


@pytest.mark.parametrize("html, want", [
    ("<html><head><title>no</title></head><body>a<!-- <b>no</b> -->b</body></html>", " a b "),
    ("<header>kept</header><p>x</p>", " kept x "),
    ("1 &lt;b&gt; 2 &amp;lt; &amp;amp; &nbsp; &copy;", "1 <b> 2 &lt; &amp; ©"),
    ("&#233;&#xE9;&#x1F600; &#0; &#55296; &#1114112; &#12 &#; &# x", "éé😀 &#0; &#55296; &#1114112; &#12 &#; &# x"),
    ("<script>if (a<b) {}</script>s<style>p{}</style>t<SCRIPT src=x>\n</SCRIPT >u", " s t u"),
    ("&middot;&unknown;&quot;", '·&unknown;"'),
    ("", ""),
    (None, None),
])
def test_html_body_text(spark, html, want):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(tx.html_text(F.col("html"))).first()[0] == want
