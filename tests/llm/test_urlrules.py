import itertools
import re

import pytest
from pyspark.sql import functions as F

from clientlens.llm import urlrules as U
from clientlens.llm.shared import table

SF = "/root/testdata/sf0.01"


def parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate({i: i + 32 for i in range(65, 91)}), m[2]) if m else ("", "")


def rule_of(host, path):
    fit = [r for r, _ in U.RULES for h, p in [r.split("/", 1)]
           if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fit, key=len, default=None)


URLS = ["https://a.net/x", "http://example.net/en/1", "http://www.Example.NET/en/", "http://example.net/en", "http://net", "http://net/",
        "http://internet/", "https://b.example.com/de/1?x=1", "https://example.com/DE/1", "http://c.org/fr/", "http://org/fr/x#y", None, "",
        "no scheme", "://h.net/p", "http://u.net?x=http://v.org/fr/", "http://É.net/a", "http://a..net//", "ftp://x.net#f", "http://x.org/fr/\nz",
        "http://" + "a" * 50_000 + ".org/fr/" + "b/" * 5_000, "a://b://c.net/"]


def test_host_path_and_rule(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    got = df.select("url", U.host_of(F.col("url")).alias("h"), U.path_of(F.col("url")).alias("p")) \
        .withColumn("r", U.given_rule(F.col("h"), F.col("p"))).collect()
    for r in got:
        assert (r.h, r.p) == parts(r.url)
        assert r.r == rule_of(*parts(r.url))


def brute(rows, labelled, support, confidence):
    """Frequent label rules by enumeration, redundancy removed, best match."""
    n, rules = len(labelled), {}
    sets = {frozenset(c) for t, _ in labelled for k in range(1, len(t) + 1) for c in itertools.combinations(sorted(t), k)}
    for s in sets:
        hit = [y for t, y in labelled if s <= set(t)]
        for y in set(hit):
            if hit.count(y) >= support * n and hit.count(y) / len(hit) >= confidence:
                rules[(s, y)] = (hit.count(y) / len(hit), hit.count(y) / n)
    kept = {k: v for k, v in rules.items() if not any((k[0] - {x}, k[1]) in rules and rules[(k[0] - {x}, k[1])][0] >= v[0] for x in k[0])}
    out = {}
    for key, t in rows.items():
        fire = [(c, s, len(need), y) for (need, y), (c, s) in kept.items() if need <= set(t) and not (len(need) == 1 and min(need).startswith("h:"))]
        out[key] = max(fire)[3] if fire else None
    return kept, out


def test_mining_and_matching_equal_enumeration(spark):
    src = table(spark, SF, "pages").select("page_id", "url").withColumn("html", F.lit("x")).withColumn("URL_RULE2", F.lit(1))
    tok = {r.url: list(r.t) for r in src.select("url", U.tokens(F.col("url"), U.host_of(F.col("url")), U.path_of(F.col("url"))).alias("t")).collect()}
    learn = [(tok[u], dict(U.RULES)[r]) for u in (x.url for x in src.collect()) if (r := rule_of(*parts(u)))]
    kept, want = brute(tok, learn, 0.02, 0.8)
    df = spark.createDataFrame(learn, "tokens array<string>, label string")
    mined = U.mine(df, support=0.02, confidence=0.8).collect()
    assert {(frozenset(r.needs), r.label) for r in mined} == set(kept)
    got = U.judge(src, support=0.02, confidence=0.8).collect()
    assert len(got) == src.count() and {r.URL_RULE2 for r in got} == {1}
    for r in got:
        given = rule_of(*parts(r.url))
        assert r.url_rule == given
        assert r.url_verdict == (dict(U.RULES)[given] if given else want[r.url] or "allow")


def test_odd_rows_and_empty_tables(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0]), (None, URLS[1])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("url_mined", F.lit("old")).withColumn("token", F.lit("t"))
    got = U.judge(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.url_verdict in ("allow", "block") and (r.url_host, r.url_path) == parts(r.url)
    assert U.judge(df.limit(0)).collect() == []
    none = U.judge(spark.createDataFrame([(1, "http://x.com/a"), (2, None)], "page_id long, url string")).collect()
    assert [r.url_verdict for r in none] == ["allow", "allow"]


def test_a_rule_needs_all_its_tokens(spark):
    urls = spark.createDataFrame([("u1", ["a", "b"]), ("u2", ["a"]), ("u3", ["a", "b", "c"]), ("u4", [])], "url string, tokens array<string>")
    rules = spark.createDataFrame([(1, ["a", "b"], "block", 0.9, 0.1), (2, ["c"], "allow", 0.95, 0.1), (3, ["zz"], "block", 1.0, 0.5),
                                   (4, ["b"], "allow", 0.9, 0.1)],
                                  "rule_id long, needs array<string>, label string, confidence double, support double")
    assert {r.url: r.label for r in U.match(urls, rules).collect()} == {"u1": "block", "u3": "allow"}


@pytest.mark.parametrize("confidence", [0.5, 0.95])
def test_labels_of_the_caller(spark, confidence):
    labelled = spark.createDataFrame([(f"http://good{i % 3}.org/a", "allow") for i in range(30)]
                                     + [(f"http://spam.org/b/{i}", "block") for i in range(30)], "url string, label string")
    pages = spark.createDataFrame([(1, "http://spam.org/z"), (2, "http://good1.org/z")], "page_id long, url string")
    got = {r.page_id: r.url_verdict for r in U.judge(pages, labelled=labelled, confidence=confidence).collect()}
    assert got == {1: "block", 2: "allow"}


def test_columns_of_any_name_stay(spark):
    extra = ["d_url", "d_label", "__url", "__label", "__needs", "label", "tokens", "token", "needs", "rule_id", "confidence"]
    schema = "page_id long, url string, " + ", ".join(f"`{c}` string" for c in extra)
    df = spark.createDataFrame([(i, u, *extra) for i, u in enumerate(URLS)], schema)
    got = U.judge(df)
    assert got.columns == [*df.columns, "url_host", "url_path", "url_rule", "url_verdict", "url_mined"]
    assert all(tuple(r)[2:2 + len(extra)] == tuple(extra) for r in got.collect()) and got.count() == len(URLS)


def test_a_host_label_alone_decides_only_with_labels_of_the_caller(spark):
    df = spark.createDataFrame([("h:com", "block")] * 9 + [("p:en", "allow")] * 9, "t string, label string") \
        .select(F.array("t").alias("tokens"), "label")
    assert {tuple(r.needs) for r in U.mine(df).collect()} == {("h:com",), ("p:en",)}
    assert {tuple(r.needs) for r in U.mine(df, host_alone=False).collect()} == {("p:en",)}
