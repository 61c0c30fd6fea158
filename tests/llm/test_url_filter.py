from pyspark.sql import functions as F

from pulsegrid.llm import url_filter

URLS = [
    (1, "http://A.Example.ORG/en/x?q", "a.example.org", "/en/x", "org/", "allow"),
    (2, "https://example.org/es/1#t", "example.org", "/es/1", "example.org/es/", "block"),
    (3, "https://m.example.org/en/17", "m.example.org", "/en/17", "example.org/en/1", "block"),
    (4, "https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    (5, "https://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
    (6, "https://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
    (7, "https://bad.net/p", "bad.net", "/p", None, "block"),
    (8, "https://good.net/p", "good.net", "/p", None, "allow"),
    (9, None, "", "", None, "allow"),
    (10, "no scheme", "", "", None, "allow"),
    (11, "a://b://c/d", "b:", "//c/d", None, "allow"),
    (12, "://", "", "", None, "allow"),
    (13, "https://x.com?/de/", "x.com", "", None, "allow"),
]


def listed(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "key string")


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(i, u, "old") for i, u, *_ in URLS], "page_id long, url string, rule string")
    got = url_filter.judge_urls(pages, listed(spark, ["bad.net/p", None, "bad.net/p"])).orderBy("page_id").collect()
    want = [(i, h, p, r, "block" if (h, p) == ("", "") else v) for i, _, h, p, r, v in URLS]
    assert [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got] == want
    shared = url_filter.judge_urls(pages, listed(spark, ["bad.net/p", ""]), max_bits=10).orderBy("page_id").collect()
    assert [(r.page_id, r.verdict) for r in shared] == [(r.page_id, r.verdict) for r in got]


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 11 == 0).alias("is"))
    hashed = keys.select("*", *url_filter.key_hashes(F.col("key")))
    levels = url_filter.build_cascade(hashed, hashed.filter("is"))
    assert len(levels) >= 2
    assert url_filter.in_cascade(hashed, levels).filter("listed <> is").count() == 0


def test_long_urls_repeated_pages_and_many_shares(spark):
    keys = [f"h{k % 7}.net/{'p' * (k * 97 % 5000)}{k}" for k in range(600)]
    rows = [(k % 550, f"https://{key}?q#f") for k, key in enumerate(keys)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    some = set(keys[::9])
    for more in ({}, {"max_bits": 300}):
        got = url_filter.judge_urls(pages, listed(spark, some), **more).collect()
        assert len(got) == len(rows)
        assert all((r.verdict == "block") == (r.host + r.path in some) for r in got)


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(pages, listed(spark, ["a"])).count() == 0
    one = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert url_filter.judge_urls(one, listed(spark, [])).first().verdict == "allow"


def test_a_short_list_of_many_keys_keeps_to_its_bits(spark, monkeypatch):
    sizes, plain = [], url_filter._level
    monkeypatch.setattr(url_filter, "_level", lambda keys, level, bits: (sizes.append(bits), plain(keys, level, bits))[1])
    pages = spark.range(200_000).select("id", F.concat(F.lit("http://h/"), "id").alias("url"))
    some = spark.range(200).select(F.concat(F.lit("h/"), F.col("id") * 977).alias("key"))
    got = url_filter.judge_urls(pages, some, max_bits=40_000).filter("verdict = 'block'").select("id").collect()
    assert sorted(r.id for r in got) == [977 * k for k in range(200)]
    # the list alone would be one share, whose second level takes 25,000 bits or so
    assert url_filter.n_shares(200, 200_000, 40_000) == 4 and len(sizes) >= 8 and max(sizes) <= 40_000
    assert sum(sizes[1::2]) > 10_000
