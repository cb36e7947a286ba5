import math

import pytest
from pyspark.sql import functions as F

from tidemark.llm import url_lm


def judge(spark, urls):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    return {r.page_id: r for r in url_lm.judge_urls(df, url_lm.CONTRACT_RULES).collect()}


def test_rules_and_parts(spark):
    urls = [
        "http://a.com/x", "https://EXAMPLE.com/en/1", "http://www.example.com/en/1?q", "http://x.net/es/", "http://x.net/fr/a",
        "http://x.net/de/", "http://notcom/x", "http://a.com", "http://a.com:80/x", None, "no-scheme.com/x", "",
        "http://a.com/en/#f?x", "x://y://z.com/q", "http://b.example.com/en/", "http://wwwexample.com/en/",
    ]
    got = judge(spark, urls)
    want = {
        0: ("a.com", "/x", "com/", "allow"), 1: ("example.com", "/en/1", "example.com/en/", "block"),
        2: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), 3: ("x.net", "/es/", "net/es/", "block"),
        4: ("x.net", "/fr/a", "net/fr/", "block"), 5: ("x.net", "/de/", None, None), 6: ("notcom", "/x", None, None),
        7: ("a.com", "", None, None), 8: ("a.com:80", "/x", None, None), 9: ("", "", None, None), 10: ("", "", None, None),
        11: ("", "", None, None), 12: ("a.com", "/en/", "com/", "allow"), 13: ("y:", "//z.com/q", None, None),
        14: ("b.example.com", "/en/", "example.com/en/", "block"), 15: ("wwwexample.com", "/en/", "com/", "allow"),
    }
    for i, (host, path, rule, verdict) in want.items():
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), urls[i]
        assert r.verdict == verdict or (verdict is None and r.verdict in ("allow", "block"))
    assert got[9].score == got[10].score == 0.0


def test_model_equals_plain_witten_bell():
    order, kept = 2, {}
    urls = [(b"abab", 1), (b"abba", 0), (b"aab", 1), (b"bb", 0), (b"abab", 1)]
    for u, y in urls:
        s = url_lm.START * order + u + url_lm.END
        for i in range(order, len(s)):
            for o in range(order + 1):
                cell = kept.setdefault(s[i - o:i], {}).setdefault(s[i], [0, 0])
                cell[0 if y else 1] += 1
    model = url_lm.RatioModel({c: {k: tuple(v) for k, v in d.items()} for c, d in kept.items()}, order)

    def prob(ctx, c, k):
        low = prob(ctx[1:], c, k) if ctx else 1 / 256
        seen = kept.get(ctx)
        if seen is None:
            return low
        n, t = sum(v[k] for v in seen.values()), sum(v[k] > 0 for v in seen.values())
        return (seen.get(c, [0, 0])[k] + t * low) / (n + t) if n else low

    for u in (b"abab", b"bbb", b"zz", b"a"):
        s = url_lm.START * order + u + url_lm.END
        want = sum(math.log(prob(s[i - order:i], s[i], 0) / prob(s[i - order:i], s[i], 1)) for i in range(order, len(s))) / (len(u) + 1)
        assert model.score(u) == pytest.approx(want)


def test_contexts_are_bounded_and_unseen_kinds_separate(spark):
    good = [(f"news.com/story-{i}", 1) for i in range(300)]
    bad = [(f"casino.net/win-{i}", 0) for i in range(300)]
    df = spark.createDataFrame(good + bad, "rest string, label int")
    assert len(url_lm.fit(df, 3, 50).table) <= 4 * 50
    model = spark.sparkContext.broadcast(url_lm.fit(df, 4, 2000))
    t = url_lm.calibrate(df, model)
    assert model.value.score(b"news.com/story-9999") > t > model.value.score(b"casino.net/win-9999")


def test_empty_repeated_and_long(spark):
    assert judge(spark, []) == {}
    long = "http://a.org/" + "x" * 200_000
    got = judge(spark, [long, long, "http://a.com/"])
    assert got[0].verdict == got[1].verdict and got[0].score == got[1].score
    one_kind = spark.createDataFrame([("a.com/", 1)], "rest string, label int").select("rest", F.col("label"))
    assert url_lm.calibrate(one_kind, spark.sparkContext.broadcast(url_lm.fit(one_kind, 2, 10))) == 0.0
