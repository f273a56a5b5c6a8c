import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lexcurate.functions import lexicons as L
from lexcurate.functions import scores as S
from lexcurate.functions import text as T
from lexcurate.functions.replies import parsed_reply
from lexcurate.functions.urls import netloc, site
from lexcurate.operators import filters


def values(spark, column, inputs, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(inputs)], f"k int, x {kind}")
    return [r[0] for r in rows.orderBy("k").select(column(F.col("x"))).collect()]


def test_site(spark):
    urls = ["http://u:p@WWW.Example.com:80/x", "//cdn.x/y", "example.com/x", None, "", "https://www.www.a.b", "HTTPS://A.b?q=//c", "http:///p", "http://a.b#x"]
    assert values(spark, site, urls) == ["example.com", "cdn.x", None, None, None, "www.a.b", "a.b", None, "a.b"]


def test_netloc(spark):
    assert values(spark, netloc, ["http://u:p@H.com:80/x", "//cdn.x/y", "example.com/x", None]) == ["u:p@H.com:80", "cdn.x", "", None]


TEXTS = ["", " a B\n", "\t x ", "İΣΑΣ", "a  b", "one\x1ctwo", None, "\U0001f600 x"]


def test_strip_hash_words_like_python(spark):
    assert values(spark, T.strip, TEXTS) == [None if t is None else t.strip() for t in TEXTS]
    assert values(spark, T.text_hash, TEXTS) == [None if t is None else hashlib.md5(t.strip().lower().encode()).hexdigest() for t in TEXTS]
    assert values(spark, T.word_count, TEXTS) == [None if t is None else len(t.split()) for t in TEXTS]
    assert values(spark, T.is_blank, ["", None, "  \n", "x"]) == [True, True, True, False]


def test_truncated(spark):
    assert values(spark, lambda x: T.truncated(x, 5), ["abcde", "abcdef", "ab cdef", "ab  cdef", "ab\ncdef", None]) == ["abcde", "abcde...", "ab...", "ab ...", "ab\ncd...", None]


def test_sizes_and_bars(spark):
    assert values(spark, T.byte_size, [0.0, 1023.0, 1024.0, 1536.0, 3.0 * 1024**2, 5.0 * 1024**4], "double") == ["0.0 B", "1023.0 B", "1.0 KB", "1.5 KB", "3.0 MB", "5.0 TB"]
    assert values(spark, T.bar, [0.0, 3.9, 10.0], "double") == ["", "█", "█████"]
    assert values(spark, lambda x: T.ceil_div(x, 1000), [0, 1, 1000, 1001], "long") == [0, 1, 1, 2]


REPLIES = {
    '{"score":4}': 4, '{"score":4.7}': 4, '{"score":"4"}': 4, '{"score":"4.7"}': None, '{"score":true}': 1, '{"score":null}': None, '{"score":6}': None, '{"score":-1}': None,
    '{"score":-0.5}': 0, '{"score":1e0}': 1, "[1]": None, "bad": None, "": None, '```json\n{"score":2}\n```': 2, '```\n{"score":2}': None, '{"reasoning":"x"}': None, '{"score":{"a":1}}': None, '{"score":1e300}': None,
}


@pytest.mark.parametrize("reply", list(REPLIES) + [None])
def test_replies(spark, reply):
    r = values(spark, parsed_reply, [reply])[0]
    assert r["score"] == REPLIES.get(reply)
    assert (r["error"] is None) == (REPLIES.get(reply) is not None)


def test_reasonings(spark):
    got = values(spark, parsed_reply, ['{"score":1}', '{"score":1,"reasoning":null}', '{"score":1,"reasoning":"a"}', '{"score":1,"reasoning":true}', '{"score":1,"reasoning":3}'])
    assert [r["reasoning"] for r in got] == ["", "None", "a", "True", "3"]


CITED = ["Roe v. Wade", "§501", "§ 12", "Section ٤", "article in", "grid. x", "éid. x", "no. 5", "No. 5", "ct. app.", "ct.app.", "42 u.s.c.", "12 F.2d 3", "pub.l.no.", "Id. at 3", "x\x1cv.\x1cA", "", "ıd. x", "ſection 5", "42 U.ſ.C.", "ARTİCLE X", "ARTICLE IX", "7 L.Ed. 2", "C.F.R.§7", "Stat.  8", "9 S.Ct. 1"]


def test_citations_like_python(spark):
    patterns = [re.compile(p, re.I if i else 0) for p, i, _ in L.CITATIONS]
    want = [any(p.search(t) for p in patterns) for t in CITED]
    assert values(spark, filters.has_citation, CITED) == want
    assert values(spark, filters.has_citation, ["x" * 8000 + " §501"]) == [False]


def test_windows(spark):
    far = "a" * 990 + "privacy policy" + "b" * 2000
    assert values(spark, filters.has_boilerplate, [far, "x" * 1500 + "Op-Ed", "court reporter", "plain", None]) == [False, True, True, False, None]
    assert values(spark, filters.keyword_count, ["writing", "plaintiff plaintiff", "x" * 4995 + "venue", "x" * 4996 + "venue", None]) == [1, 1, 1, 0, None]
    assert values(spark, filters.is_news_url, ["https://service.com/", "http://a/NEWS/x", "", None, "http://a/"]) == [True, True, False, False, False]


def test_reasons(spark):
    good = "The plaintiff and the defendant cite 42 U.S.C. " + "x" * 500
    rows = [("a" * 499, None, "too_short"), (None, None, "too_short"), ("a" * 50001, None, "too_long"), (good, "http://x/blog/", "news_url"), ("We use cookies " + good, None, "boilerplate"),
            ("z" * 500, None, "keywords"), ("plaintiff defendant " + "z" * 500, None, "citation"), (good, None, "pass")]
    df = spark.createDataFrame(rows, "text string, url string, want string")
    assert all(r["want"] == r["got"] for r in df.withColumn("got", filters.reject_reason(F.col("text"), F.col("url"))).collect())
    assert filters.funnel(df).agg(F.sum("documents")).first()[0] == len(rows)
    assert filters.funnel(df.limit(0)).count() == 0


def test_scores(spark):
    logits = [[0.0, 0.0, 0.0, 0.0, 50.0, 50.0], [1.0] * 6, [1000.0, *[0.0] * 5]]
    assert values(spark, S.expected_score, logits, "array<double>") == pytest.approx([4.5, 2.5, 0.0])
    assert values(spark, S.argmax_class, logits, "array<double>") == [4, 0, 0]
    assert sum(values(spark, S.softmax, logits[:1], "array<double>")[0]) == pytest.approx(1)
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0], [9.0, 9.0]], [1, 1, 0]), ([[1.0, 2.0]], [0])], "v array<array<double>>, m array<int>")
    assert [r[0] for r in df.select(S.masked_mean(F.col("v"), F.col("m"))).collect()] == [[2.0, 3.0], [0.0, 0.0]]
    assert values(spark, lambda x: S.linear_head(x, [[1, 0], [0, 2]], [0.5, 0]), [[3.0, 4.0]], "array<double>") == [[3.5, 8.0]]
