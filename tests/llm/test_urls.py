"""Rules against plain Python, models against exact counts, verdicts on unseen URLs."""

import re

import numpy as np

from tachyline.llm import urls
from tachyline.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, host string, score string"


def plain(url: str | None) -> tuple[str, str, str | None, str | None]:
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.fullmatch(r"([^/?#]*)([^?#]*)[\s\S]*", rest).groups()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fitting = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fitting, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


EDGES = [
    None, "", "no scheme", "http://", "HTTP://EXAMPLE.org/en/1?x", "https://a.example.ORG/en/2#t", "http://example.org", "http://notexample.org/es/", "x://com/fr/", "http://a.com/fr",
    "http://b.com/de/1#/fr/", "http://É.com/fr/ü?q", "http://c.net/" + "a" * 50_000, "a://b://c.org/", "http://d.com?x=/de/", "http://org/\n/x", "://org/",
]


def test_edges(spark):
    rows = [(i, u, "h", "s") for i, u in enumerate(EDGES)] + [(None, EDGES[4], "", ""), (4, EDGES[4], "", "")]
    got = urls.judge(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()
    assert len(got) == len(rows)
    for row in got:
        host, path, rule, verdict = plain(EDGES[4 if row["page_id"] is None else row["page_id"]])
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == verdict if rule else row["verdict"] in ("allow", "block")
    assert [r["verdict"] for r in got if r["page_id"] in (0, 1)] == ["allow", "allow"]


def test_no_training_urls(spark):
    some = spark.createDataFrame([(1, "http://x.net/a", "", ""), (2, "http://x.org/", "", "")], SCHEMA)
    assert {r["verdict"] for r in urls.judge(some, URL_RULES).collect()} == {"allow"}
    assert urls.judge(some.limit(0), URL_RULES).count() == 0


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    url = {r["page_id"]: r["url"] for r in pages.collect()}
    got = urls.judge(pages, URL_RULES).collect()
    assert len(got) == len(url)
    for row in got:
        host, path, rule, verdict = plain(url[row["page_id"]])
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule) and (not rule or row["verdict"] == verdict)
    assert {r["verdict"] for r in got if not r["rule"]} == {"allow", "block"}


def test_models_equal_exact_counts():
    known = ["http://a.org/x", "http://b.org/y?z=1", "é", ""]
    tables = urls.Grams(known).counts().astype(np.float32)
    grams = urls.Grams(["http://a.org/y", "q"])
    context, gram = {}, {}
    for url in known:
        data = b"\x02" * urls.ORDER + url.encode() + b"\x03"
        for at in range(urls.ORDER, len(data)):
            for order in range(urls.ORDER + 1):
                c = (order, data[at - order : at])
                context[c] = context.get(c, 0) + 1
                gram[c, data[at]] = gram.get((c, data[at]), 0) + 1
    for url, value in zip(["http://a.org/y", "q"], grams.log_likelihood(tables), strict=True):
        data, total = b"\x02" * urls.ORDER + url.encode() + b"\x03", 0.0
        for at in range(urls.ORDER, len(data)):
            chance = 1 / 256
            for order in range(urls.ORDER + 1):
                c = (order, data[at - order : at])
                chance = (gram.get((c, data[at]), 0) + urls.PULL * chance) / (context.get(c, 0) + urls.PULL)
            total += np.log(chance)
        assert np.isclose(value, total / (len(url.encode()) + 1))


def test_unseen_urls_are_told_apart(spark):
    """Rejected URLs of a kind that no rule names are recognised by their letters."""
    rng = np.random.default_rng(2)

    def word(signs):
        return "".join(rng.choice(list(signs), 8))

    rows = [(i, f"http://{word('abcde')}.com/fr/{word('abcde')}", "", "") for i in range(300)]
    rows += [(1000 + i, f"http://{word('vwxyz')}.com/de/{word('vwxyz')}", "", "") for i in range(300)]
    rows += [(2000 + i, f"http://{word('abcde')}.net/it/{word('abcde')}", "", "") for i in range(50)]
    rows += [(3000 + i, f"http://{word('vwxyz')}.net/it/{word('vwxyz')}", "", "") for i in range(50)]
    got = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()}
    assert all(got[2000 + i] == "allow" and got[3000 + i] == "block" for i in range(50))


def test_counts_are_exact_beyond_the_former_table(spark):
    """More different n-grams than 2**20: each count is that of its own n-gram."""
    rng = np.random.default_rng(3)
    known = ["http://" + bytes(rng.integers(97, 123, 60).astype(np.uint8)).decode() + ".com/" for _ in range(12_000)]
    rows = [(url, i % 2, i // 2 % 2) for i, url in enumerate(known)]
    table = urls.count_table(spark.createDataFrame(rows, "url string, half int, label int"))
    assert table.count() > 1 << 20
    want = {}
    for url, half, label in rows:
        data = b"\x02" * 5 + url.encode() + b"\x03"
        for at in range(5, len(data)):
            name = int.from_bytes(data[at - 5 : at + 1], "big") | 11 << 48
            want.setdefault(name, [0, 0, 0, 0])[half * 2 + label] += 1
    got = {r[0]: list(r[1:]) for r in table.where(f"name >= {11 << 48}").collect()}
    assert got == want
