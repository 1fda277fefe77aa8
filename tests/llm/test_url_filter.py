import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tripmart.llm import url_filter as U


def judged(spark, urls, **kw):
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(urls)], "page_id int, url string, host string, html string")
    return {r.page_id: r for r in U.filter_urls(pages, **kw).collect()}


def test_parts_and_longest_rule(spark):
    urls = ["https://WWW.Example.com/en/1?x=1#y", "http://blog.example.com/en/2", "https://m.www.example.com/en/", "https://a.com/x",
            "https://a.com", "https://b.net/es/9", "https://b.net/eso", "ftp://notexample.com/en/1", "x://example.net?q=/es/",
            None, "", "no scheme/es/", "http://a://b.net/fr/#z", "https://net/fr/", "https://ÀB.net/Fr/"]
    r = judged(spark, urls)
    assert (r[0].host, r[0].path, r[0].rule, r[0].verdict) == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert (r[1].rule, r[1].verdict) == ("example.com/en/", "block")
    assert r[2].rule == "www.example.com/en/" and r[3].rule == "com/"
    assert (r[4].path, r[4].rule) == ("", None)  # no path: even "/" does not fit
    assert (r[5].rule, r[5].verdict) == ("net/es/", "block") and r[6].rule is None
    assert r[7].rule == "com/"  # notexample.com is not below example.com
    assert (r[8].host, r[8].path) == ("example.net", "")
    for k in (9, 10, 11):
        assert (r[k].host, r[k].path, r[k].rule) == ("", "", None) and r[k].verdict in ("allow", "block")
    assert (r[12].host, r[12].path) == ("a:", "//b.net/fr/")
    assert r[13].rule == "net/fr/" and r[14].host == "Àb.net"


def test_split_is_the_same_in_python(spark):
    urls = [u for u, _ in U.LABELLED] + ["a://B?c", "a://b#c/d", "x", "://", "https://a/b?c#d", "a://b/c#d?e"]
    r = judged(spark, urls)
    assert [U.split_url(u) for u in urls] == [(r[i].host, r[i].path) for i in range(len(urls))]


def test_model_on_held_out_urls():
    fresh = [("http://www.free-casino.example.org/de/9", 1), ("https://cheap-pills.example.net/en/4", 1),
             ("https://m.ads-track.example.net/en/1", 1), ("https://spam-farm.example.org/x", 1),
             ("https://www.ththin.example.org/de/5502", 0), ("http://school.example.net/en/maths", 0),
             ("https://blog.tiontion.example.net/en/77", 0), ("https://m.garden.example.org/de/12", 0)]
    model = U.train()
    right = sum((model.score(*U.split_url(u)) >= 0.5) == bool(y) for u, y in fresh)
    assert right >= 7


def test_no_rules_no_rows_and_no_labels(spark):
    assert judged(spark, []) == {}
    r = judged(spark, ["https://a.com/x"], rules=[], model=U.train([]))
    assert r[0].rule is None and r[0].score == 0.5


def names(url):
    """Labels of a URL's host without its suffix and the common first ones."""
    return set(U.split_url(url)[0].split(".")[:-1]) - {"www", "m", "blog", "example", "co"}


def test_no_labelled_host_is_of_the_given_pages(spark):
    known = set().union(*(names(u) for u, _ in U.LABELLED))
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        hosts = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").select(U.host(F.col("url")).alias("h")).distinct()
        assert not known & set().union(*(names(f"http://{r.h}/") for r in hosts.collect()))


def test_model_on_hosts_that_the_table_does_not_hold():
    fresh = [("https://casino-jackpot.example.net/de/9", 1), ("http://www.free-spins.example.org/en/4", 1),
             ("https://poker-room.example.net/en/1", 1), ("https://m.cheap-tablets.example.org/x", 1),
             ("https://adclicks.example.net/en/31", 1), ("http://spam-mails.example.org/fr/8", 1),
             ("https://adult-dating.example.net/en/2", 1), ("https://payday-cash.example.org/es/6", 1),
             ("http://school.example.net/en/maths", 0), ("https://m.garden.example.org/de/12", 0),
             ("https://www.orchestra.example.org/fr/4", 0), ("https://geology.example.net/en/1", 0),
             ("https://blog.mountains.example.org/en/31", 0), ("https://thinking.example.net/es/6", 0),
             ("http://www.villages.example.org/fr/8", 0), ("https://chemistry.example.net/en/2", 0)]
    known = set().union(*(names(u) for u, _ in U.LABELLED))
    assert not known & set().union(*(names(u) for u, _ in fresh))
    model = U.train()
    assert sum((model.score(*U.split_url(u)) >= 0.5) == bool(y) for u, y in fresh) >= 14


def slow_train(labelled, sizes, buckets, ridge, steps, rate):
    """Gradient steps one URL and one bucket at a time."""
    feats = []
    for u, _ in labelled:
        host, path = U.split_url(u)
        feats.append({zlib.crc32(f"{k}^{t}$"[:1].encode() + f"^{t}$"[i:i + n].encode()) % buckets
                      for k, t in (("h", host), ("p", path)) if t for n in sizes for i in range(len(t) + 3 - n)})
    w, b = {}, 0.0
    for _ in range(steps):
        errors = []
        for f, (_, y) in zip(feats, labelled):
            z = b + sum(w.get(g, 0.0) for g in f) / max(len(f), 1) ** 0.5
            errors.append((1 / (1 + np.exp(-z)) - y) / len(labelled))
        grad = {g: ridge * v / len(labelled) for g, v in w.items()}
        for f, e in zip(feats, errors):
            for g in f:
                grad[g] = grad.get(g, 0.0) + e / len(f) ** 0.5
        for g, v in grad.items():
            w[g] = w.get(g, 0.0) - rate * v
        b -= rate * sum(errors)
    return w, b


def test_training_and_scores_equal_plain_loops():
    labelled = U.LABELLED[::9] + [("no scheme", 1), ("http://x", 0), ("https://É.org/ß", 1)]
    w, b = slow_train(labelled, (2, 3), 512, 0.01, 25, 4.0)
    model = U.train(labelled, (2, 3), 512, 0.01, 25, 4.0)
    assert np.isclose(model.bias, b)
    assert all(np.isclose(model.weights[g], w.get(g, 0.0)) for g in range(512))
    for u, _ in labelled:
        found = U.grams(*U.split_url(u), (2, 3), 512)
        z = b + sum(w[g] for g in found) / max(len(found), 1) ** 0.5
        assert np.isclose(model.score(*U.split_url(u)), 1 / (1 + np.exp(-z)))


def test_rules_equal_a_slow_matcher(spark):
    rng = random.Random(4)
    hosts = ["com", "a.com", "b.a.com", "ba.com", "net", "x.net", "com.net", "", "A.Com", "org"]
    paths = ["", "/", "/en", "/en/", "/en/1", "/es/x", "/e", "//en/"]
    rules = [("allow", "com/"), ("block", "a.com/en/"), ("allow", "b.a.com/en/"), ("block", "net/"), ("allow", "x.net/e"),
             ("block", "x.net/es"), ("block", "org/en")]
    urls = [f"{rng.choice(['http', 'x'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/en/', '#/en/'])}" for _ in range(300)]
    found = judged(spark, urls, rules=rules)
    for k, u in enumerate(urls):
        host, path = U.split_url(u)
        fits = [(len(r), -i, r, a) for i, (a, r) in enumerate(rules)
                if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.partition("/")[2])]
        want = max(fits) if fits else None
        assert found[k].rule == (want and want[2]), u
        assert want is None or found[k].verdict == want[3]


def test_steps_are_those_of_the_validation_split():
    """Of the steps tried, the default does best on hosts left out by their hash; there it finds most unwanted URLs
    whose path tells, and blocks few others."""
    fit, left = U.validation_split(U.LABELLED)
    assert not {U.split_url(u)[0] for u, _ in fit} & {U.split_url(u)[0] for u, _ in left} and len(left) > 80
    y = np.array([label for _, label in left], float)

    def scores(steps):
        model = U.train(fit, steps=steps)
        return np.array([model.score(*U.split_url(u)) for u, _ in left])

    def loss(p):
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    losses = {steps: loss(scores(steps)) for steps in (100, 400, 1600, 6400)}
    assert min(losses, key=losses.get) == U.STEPS
    p = scores(U.STEPS)
    assert (p[y == 1] >= 0.5).mean() >= 0.5 and (p[y == 0] >= 0.5).mean() <= 0.06
