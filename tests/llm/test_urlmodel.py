import math
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerproof.llm import urlmodel
from ledgerproof.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
URLS = [
    None,
    "",
    "no scheme.org/",
    "http://A.Example.ORG/es/1?q=/en/",
    "https://example.org/en/12#x",
    "https://example.org/en/2",
    "ftp://org/",
    "http://xorg/",
    "http://a.org",
    "http://a.org?x=/",
    "http://b.com/fr/1",
    "http://b.com/de/1",
    "http://b.com/es/1",
    "http://",
    "://x.org/y",
    "a://b://c.org/d",
    "http://ümlaut.com/fr/é?é",
]


def parts_by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest[: min([i for c in "/?#" if (i := rest.find(c)) >= 0] or [len(rest)])]
    rest = rest[len(host) :]
    path = rest[: min([i for c in "?#" if (i := rest.find(c)) >= 0] or [len(rest)])]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_by_hand(host, path):
    fits = []
    for rule, verdict in urlmodel.RULES:
        domain, _, tail = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + tail):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def test_rules_by_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id int, url string, host string, rule string")
    got = urlmodel.judge(pages).orderBy("page_id").collect()
    for url, r in zip(URLS, got, strict=True):
        host, path = parts_by_hand(url)
        rule, verdict = rule_by_hand(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
        if not url:
            assert r.lm_score == 0


def test_empty(spark):
    assert urlmodel.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def scores_by_hand(train, urls):
    """The two models with dictionaries for counts, so without any shared slot."""
    pairs, contexts = {}, {}
    for url, verdict in train:
        data = b"\0" * urlmodel.ORDER + url.lower().encode()
        for i in range(urlmodel.ORDER, len(data)):
            for k in range(urlmodel.ORDER + 1):
                c = (verdict, data[i - k : i])
                contexts[c] = contexts.get(c, 0) + 1
                pairs[c, data[i]] = pairs.get((c, data[i]), 0) + 1
    out = []
    for url in urls:
        data, total = b"\0" * urlmodel.ORDER + url.lower().encode(), 0.0
        for i in range(urlmodel.ORDER, len(data)):
            for verdict, sign in (("allow", 1), ("block", -1)):
                p = 1 / 256
                for k in range(urlmodel.ORDER + 1):
                    c = (verdict, data[i - k : i])
                    p = (pairs.get((c, data[i]), 0) + urlmodel.PRIOR * p) / (contexts.get(c, 0) + urlmodel.PRIOR)
                total += sign * math.log(p)
        out.append(total / max(1, len(data) - urlmodel.ORDER))
    return out


def test_scores_by_brute_force(spark):
    rng = random.Random(3)
    word = lambda s: "".join(rng.choices(s, k=rng.randint(3, 9)))
    train = [(f"http://{word('abcde')}.org/{word('xyz')}", "allow") for _ in range(40)]
    train += [(f"http://{word('qrstu')}.net/{word('789')}", "block") for _ in range(40)]
    models = urlmodel.train(spark.createDataFrame(train, "url string, verdict string").repartition(3))
    urls = [u for u, _ in train[::7]] + ["", "http://abc.org/zz", "é"]
    wanted = scores_by_hand(train, urls)
    # A shared slot now and then moves a score.
    assert np.quantile(np.abs(models.scores(urls) - wanted), 0.8) < 1e-3
    scored = spark.createDataFrame([(v, s) for (_, v), s in zip(train, scores_by_hand(train, [u for u, _ in train]), strict=True)], "verdict string, lm_score double")
    cut = urlmodel.best_cut(scored)
    assert scored.where((F.col("lm_score") >= cut) == (F.col("verdict") == "allow")).count() == len(train)


def test_model_tells_held_out_rules_apart(spark):
    got = QUERIES["op8_markov_url_filter"](spark, SF).where("rule IS NOT NULL")
    right = got.where((F.col("lm_score") >= F.col("lm_cut")) == (F.col("verdict") == "allow")).count()
    assert right >= 0.9 * got.count()


def test_every_count_is_exact_beyond_any_fixed_table(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=60))
    train = [(f"http://{word()}.{'org' if i % 2 else 'net'}/", ("block", "allow")[i % 2]) for i in range(6000)]
    models = urlmodel.train(spark.createDataFrame(train, "url string, verdict string").repartition(3))
    windows = {url.encode()[i : i + 5] for url, _ in train for i in range(len(url) - 4)}
    assert len(windows) > 1 << 18
    urls = [u for u, _ in train[::301]] + ["", None, "é", "http://unseen.example/"]
    wanted = scores_by_hand(train, [u or "" for u in urls])
    assert np.abs(models.scores(urls) - wanted).max() < 1e-9


def test_counts_beyond_32_bits(spark):
    """Partial counts of 3e9 of one byte in each class, of which the slot table's int32 would have made negatives."""
    many, a, b = 3_000_000_000, ord("a"), ord("b")
    parts = [(a, many, many), (a, many, 0), (b, 5, many)]  # order 0: the number is the byte
    models = urlmodel.summed(spark.createDataFrame(parts, "gram long, n0 long, n1 long"))
    p = {}
    for c, counts in enumerate(({a: 2 * many, b: 5}, {a: many, b: many})):
        for byte in (a, b, ord("z")):
            q = (counts.get(byte, 0) + urlmodel.PRIOR / 256) / (sum(counts.values()) + urlmodel.PRIOR)
            p[c, byte] = q  # no longer context has been seen, so every order above keeps it
    wanted = [math.log(p[1, x]) - math.log(p[0, x]) for x in (a, b, ord("z"))]
    assert np.abs(models.scores(["a", "b", "z"]) - wanted).max() < 1e-9
