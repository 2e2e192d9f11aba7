import math

import pytest

from revline.llm import urlfilter

URLS = [None, "", "no scheme", "http://", "https://A.Example.NET/EN/x", "https://a.example.net/en/x?q#f",
        "http://net/", "http://x.net", "http://internet/", "http://sub.example.com/de/1#a://b",
        "http://example.com/de", "http://example.com/den/", "ftp://É.org/fr/a", "x://y.org/fr/?://z",
        "http://casino-bets.example.com/en/4", "http://the.example.com/en/4",
        "http://example.net:80/en/", "http://a.org/fr/" + "y" * 20_000, "http://a.org/fr/",
        "http://multi.example.com/\nen/"] * 2


def _brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    path = rest[:min((rest.index(c) for c in "?#" if c in rest), default=len(rest))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in urlfilter.RULES:
        domain, _, tail = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + tail):
            fits.append((len(rule), rule, verdict))
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


@pytest.fixture(scope="module")
def model(spark):
    return urlfilter.train(urlfilter.seed_table(spark))


def test_judgements_match_brute_force(spark, model):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)],
                               "page_id long, url string, host string")
    weights, bias, hasher = model.model.coefficients, model.model.intercept, model.hasher()
    rows = urlfilter.judge_urls(df, model).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path, rule, verdict = _brute(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        grams = {m + v[i:i + n] for m, v in (("h", f"^{host}$"), ("p", f"^{path}$"))
                 for n in (3, 4) for i in range(max(1, len(v) - n + 1))}
        z = bias + sum(weights[i] for i in {hasher.indexOf(g) for g in grams})
        assert math.isclose(r.score, 1 / (1 + math.exp(-z)), abs_tol=1e-9)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))


def test_model_separates_unseen_urls(spark, model):
    unseen = {"http://lucky-casino.example.com/en/1": "block", "http://pills-4u.example.com/fr/2": "block",
              "http://adult-fun.example.com/en/9": "block", "http://thinthe.example.com/en/2": "allow",
              "https://blog.station.example.com/es/44": "allow", "https://garden.example.com/en/8": "allow"}
    df = spark.createDataFrame(list(enumerate(unseen)), "page_id long, url string")
    rows = urlfilter.judge_urls(df, model).collect()
    assert {list(unseen)[r.page_id]: r.verdict for r in rows} == unseen


def test_empty_table_and_plan(spark, model):
    df = spark.createDataFrame([], "page_id long, url string")
    out = urlfilter.judge_urls(df, model)
    assert out.collect() == []
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
