"""WARC archives, the URL filter and top-k against plain Python."""

import base64
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from insight.llm import topk, urls, warc

PAGES = "page_id long, url string, html string, refers_to long"


def pages():
    odd = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\né"
    rows = [
        (5, "http://a.org/", odd),
        (3, "http://a.org/\r\nX: y", odd),
        (9, None, None),
        (7, "http://b.org/", ""),
        (8, "http://c.org/", "<p>ñ 漢</p>"),
        (None, "http://d.org/", "<p>ñ 漢</p>"),
        (2, "http://e.org/", "z" * 5000),
        (2, "http://e.org/", "z" * 5000),
        (11, "http://e.org/", "z" * 5000),
    ]
    return [(*r, 1) for r in rows]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_archives_round_trip(spark, tmp_path, compression):
    df = spark.createDataFrame(pages(), PAGES)
    folder = str(tmp_path / "warc")
    warc.write_archives(df, folder, compression=compression, archive_bytes=3000)
    records = warc.read_archives(spark, folder, payloads=True)
    got = warc.resolve_revisits(records).collect()
    first = {}
    for page, _, html, _ in pages():
        if page is not None:
            first[digest(html)] = min(first.get(digest(html), page), page)
    assert len(got) == len(pages())
    texts = {p: h or "" for p, _, h, _ in pages()}
    for r in got:
        text = texts[r.page_id]
        revisit = r.page_id is not None and first[digest(text)] != r.page_id
        assert r.record_type == ("revisit" if revisit else "response")
        assert r.refers_to == (first[digest(text)] if revisit else None)
        assert (r.payload_bytes, r.payload_digest) == (len(text.encode()), digest(text))
        assert r.payload is None if revisit else bytes(r.payload).decode() == text
    assert {r.url for r in got if r.page_id == 3} == {"http://a.org/%0D%0AX: y"}
    assert {r.url for r in got if r.page_id == 9} == {None}


def test_small_payloads_are_not_revisits(spark, tmp_path):
    df = spark.createDataFrame(pages(), PAGES)
    warc.write_archives(df, str(tmp_path / "w"), least=5000)
    kinds = {r.page_id: r.record_type for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert {p for p, k in kinds.items() if k == "revisit"} == {11}


def test_no_pages_no_records(spark, tmp_path):
    df = spark.createDataFrame([], PAGES)
    warc.write_archives(df, str(tmp_path / "w"))
    assert warc.resolve_revisits(warc.read_archives(spark, str(tmp_path / "w"))).count() == 0


def test_a_wrong_digest_is_an_error(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(pages(), PAGES), str(tmp_path / "w"), compression="none")
    for file in (tmp_path / "w").glob("part-*"):
        file.write_bytes(file.read_bytes().replace(b"zzzz", b"zzzy"))
    for crc in (tmp_path / "w").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="not its digest"):
        warc.read_archives(spark, str(tmp_path / "w")).count()


# ---------------------------------------------------------------- urls

URLS = [
    None,
    "",
    "no scheme/net/",
    "http://NET",
    "http://net/",
    "https://A.Example.NET/en/x?y#z",
    "https://example.net/en",
    "https://badexample.com/de/1",
    "https://x.example.com/de/1",
    "ftp://É.org/fr/é/1#a?b",
    "http://h.org?q=/fr/",
    "http://h.org#/fr/",
    "http://a://b/c",
    "://x.org/fr/",
]
RULES = {"net/": True, "example.net/en/": False, "example.com/de/": True, "org/fr/": False}


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [
        r
        for r in RULES
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
        and path.startswith("/" + r.split("/", 1)[1])
    ]
    return max(fits, key=len, default=None)


def differ(a, n, b, m, z=1.96):
    p = (a + b) / (n + m)
    return abs(a / n - b / m) > z * math.sqrt(p * (1 - p) * (1 / n + 1 / m)) + 1e-12


def plain_runs(pairs):
    """The run of each pair (hit, of): neighbours in order of their share, as long as they are alike."""
    run, last, runs = 0, None, {}
    for pair in sorted(set(pairs), key=lambda p: (p[0] / p[1], p[1])):
        run += last is not None and differ(*pair, *last)
        runs[pair] = run
        last = pair
    whole = {r: [sum(p[k] for p in pairs if runs[p] == r) for k in (0, 1)] for r in runs.values()}
    return {p: (r, p if differ(*p, *whole[r]) else None) for p, r in runs.items()}


def plain_branches(children, bad, support):
    """The branch of each segment that stays; ``children``: its urls, each with what goes on."""
    kept = {s: m for s, m in children.items() if len(m) >= support}
    counts = {}
    for s, members in kept.items():
        told = [bad[i] for i, _ in members if bad[i] is not None]
        counts[s] = ((sum(len(rest) > 0 for _, rest in members), len(members)), (sum(told), len(told)))
    judged = [s for s in kept if counts[s][1][1]]
    deep = plain_runs([counts[s][0] for s in judged])
    groups: dict = {}
    for s in judged:
        groups.setdefault(deep[counts[s][0]], []).append(s)
    branch = {s: s for s in kept}
    for names in groups.values():
        like = plain_runs([counts[s][1] for s in names])
        for s in names:
            branch[s] = min(t for t in names if like[counts[t][1]] == like[counts[s][1]])
    return branch


def plain_templates(parts, bad, support=5):
    """Each url's template and its segment at the first wildcard, to the last segment of each."""
    found = [None] * len(parts)

    def go(node, members, wild):
        children: dict = {}
        for i, rest in members:
            if rest:
                children.setdefault(rest[0], []).append((i, rest[1:]))
            else:
                found[i] = node, wild.get(i)
        branch = plain_branches(children, bad, support)
        below: dict = {}
        for s, inner in children.items():
            below.setdefault(branch.get(s, "*"), []).extend(inner)
            if s not in branch:
                wild = {**{i: s for i, _ in inner}, **wild}
        for name, inner in below.items():
            go(f"{node}/{name}", inner, wild)

    hosts: dict = {}
    for i, (host, path) in enumerate(parts):
        hosts.setdefault(host, []).append((i, [s for s in path.split("/") if s]))
    for members in hosts.values():
        go("", members, {})
    return found


def check_urls(rows, values, labels=None):
    parts = [plain_parts(u) for u in values]
    rules = [plain_rule(*p) for p in parts]
    own = [None if r is None else RULES[r] for r in rules]
    bad = [(labels or {}).get(u, o) for u, o in zip(values, own, strict=True)]
    found = plain_templates(parts, bad)
    urls_of: dict = {}
    for (host, _), (node, wild), b in zip(parts, found, bad, strict=True):
        urls_of.setdefault((host, node), []).append((wild, b))
    purity = {}
    for node, members in urls_of.items():
        told: dict = {}
        for wild, b in members:
            if b is not None:
                told.setdefault(wild, []).append(b)
        known = sum(map(len, told.values()))
        if any(w is not None for w, _ in members) and 2 * known < len(members):
            purity[node] = (sum(sum(x) / len(x) for x in told.values()) + 1) / (len(told) + 2)
        else:
            purity[node] = (sum(map(sum, told.values())) + 1) / (known + 2)
    assert len(rows) == len(values)
    blocked = 0
    for r in rows:
        (host, path), rule = parts[r.page_id], rules[r.page_id]
        node = found[r.page_id][0]
        learned = purity[host, node] >= 0.9
        blocked += learned and rule is None
        want = own[r.page_id] if rule is not None else learned
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if "template" in r:
            assert r.template == host + node, values[r.page_id]
        assert r.verdict == ("block" if want else "allow"), values[r.page_id]
    return blocked


def test_odd_urls(spark):
    df = spark.createDataFrame([(i, u, "n", 1) for i, u in enumerate(URLS)], "page_id long, url string, node string, n int")
    check_urls(urls.filter_urls(df, RULES).collect(), URLS)
    assert urls.filter_urls(df.where("page_id = 99"), RULES).count() == 0


def test_templates_with_labels(spark):
    rng = random.Random(2)
    values = [
        f"http://h{rng.randrange(2)}.io/{rng.choice(['a', 'b', 'c', 'd'])}/{rng.randrange(10**6)}"
        f"/{rng.choice(['x', 'y', 'z/w', ''])}"
        for _ in range(600)
    ]
    values += [f"http://h0.net/{i}" for i in range(20)] + values[:5]
    labels = {u: u.split("/")[3] in "ab" or "z/w" in u for u in set(values[:400])}
    df = spark.createDataFrame(list(enumerate(values)), "page_id long, url string")
    given = spark.createDataFrame(list(labels.items()), "url string, bad boolean")
    rows = urls.filter_urls(df, RULES, labels=given).collect()
    assert check_urls(rows, values, labels) > 50


def test_sections_of_a_small_share_stay_apart(spark):
    sections = ["de", *(f"s{k}" for k in range(29))]
    values = [f"http://a.example.com/{s}/{i}" for s in sections for i in range(20)]
    df = spark.createDataFrame(list(enumerate(values)), "page_id long, url string")
    rows = urls.filter_urls(df, RULES).collect()
    assert {(r.path.split("/")[1], r.verdict) for r in rows} == {
        (s, "block" if s == "de" else "allow") for s in sections
    }
    assert {r.template for r in rows} == {f"a.example.com/{s}/*" for s in sections}


def test_a_small_branch_does_not_decide_a_wildcard(spark):
    values = [f"http://b.org/{i}/p{i}-{k}" for i in range(300) for k in range(4)]
    few = {u: True for u in values[:12]}
    many = {u: True for u in values[: 4 * 30 : 4]}
    df = spark.createDataFrame(list(enumerate(values)), "page_id long, url string")
    for labels, want in ((few, "allow"), (many, "block")):
        given = spark.createDataFrame(list(labels.items()), "url string, bad boolean")
        rows = urls.filter_urls(df, {}, labels=given).collect()
        assert {(r.template, r.verdict) for r in rows} == {("b.org/*/*", want)}


def test_paths_are_told_apart_at_any_depth(spark):
    values = [f"http://h.io/a/b/c/d/e/f/{kind}/{i}" for kind in ("bad", "good") for i in range(100)]
    values += ["http://h.io/" + "x/" * 300 + "end"] * 20
    labels = {u: "bad" in u for u in values[::2]}
    df = spark.createDataFrame(list(enumerate(values)), "page_id long, url string")
    given = spark.createDataFrame(list(labels.items()), "url string, bad boolean")
    rows = urls.filter_urls(df, RULES, labels=given).collect()
    assert check_urls(rows, values, labels) == 100
    assert {r.template for r in rows} == {
        "h.io/a/b/c/d/e/f/bad/*", "h.io/a/b/c/d/e/f/good/*", "h.io/" + "x/" * 300 + "end"
    }


def test_a_node_with_many_siblings(spark):
    """100,000 segments that stay below one node are a few rows of counts when they are ordered."""
    df = spark.range(100_000 * 5, numPartitions=8).selectExpr(
        "'h.io' AS host", "concat('/s', id DIV 5, '/', id) AS path", "id DIV 5 < 60000 AS bad"
    )
    paths, levels = urls.template_tree(df)
    assert levels[0].groupBy("branch").count().collect() and levels[0].count() == 100_000
    assert {(r.branch, r["count"]) for r in levels[0].groupBy("branch").count().collect()} == {
        ("s0", 60_000), ("s60000", 40_000)
    }
    assert paths.groupBy("node").agg(F.sum("n")).count() == 2


def test_templates_recover_hidden_verdicts(spark):
    rng = random.Random(8)
    values = [f"http://{h}.{rng.choice(['net', 'org/fr', 'example.com/de', 'example.net/en'])}/{s}/{i}"
              for h in "abc" for s in ("x", "y") for i in range(400)]
    df = spark.createDataFrame(list(enumerate(values)), "page_id long, url string")
    [told] = urls.recovery(df, RULES).collect()
    assert told.hidden > 1000 and told.bad > 400
    assert told.recall >= 0.9 and told.precision >= 0.9
    [none] = urls.recovery(df.where("page_id < 0"), RULES).collect()
    assert (none.hidden, none.recall, none.precision) == (0, None, None)


def test_like_siblings_merge_and_small_steps_do_not_add_up(spark):
    values = [f"http://c.org/{s:02d}/{i}" for s in range(41) for i in range(40)]
    labels = {u: i % 40 < i // 40 for i, u in enumerate(values)}
    df = spark.createDataFrame([("c.org", u[12:], b) for u, b in labels.items()], "host string, path string, bad boolean")
    branch = {r.segment: r.branch for r in urls.template_tree(df)[1][0].collect()}
    assert len(branch) == 41
    assert branch["00"] != branch["40"] and branch["10"] != branch["30"]
    same = df.withColumn("bad", F.lit(True))
    assert {r.branch for r in urls.template_tree(same)[1][0].collect()} == {"00"}


def test_url_query_on_the_smallest_tables(spark):
    from insight.llm.queries import op6_urls

    folder = "/root/testdata/sf0.001"
    values = [r.url for r in spark.read.parquet(f"{folder}/pages.parquet").orderBy("page_id").collect()]
    rows = op6_urls(spark, folder).collect()
    assert sorted(r.page_id for r in rows) == list(range(len(values)))
    check_urls(rows, values)


# ---------------------------------------------------------------- top-k


def plain_top(candidates, queries, k):
    out = []
    for q, x in {q: x for q, x in queries}.items():
        scores = [(-int(np.dot(x, y)), v) for v, y in candidates if v != q and len(y) == len(x)]
        out += [(q, rank, v, -s) for rank, (s, v) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("high, block", [(3, 7), (1000, 64), (10**7, 4096)])
def test_top_k_against_all_pairs(spark, high, block):
    rng = np.random.default_rng(high)
    rows = [(i, rng.integers(-high, high, 6).tolist()) for i in range(150)]
    rows += [(200, [0] * 6), (201, [1, 2]), (202, [3, -4]), (10, rows[3][1]), (300, []), (301, [])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    asked = [r for r in rows[:-4] if r[0] % 20 == 0 or r[0] > 190]
    queries = spark.createDataFrame(asked, df.schema)
    got = topk.top_k(df, queries, 10, block=block, query_block=5).collect()
    assert sorted(tuple(r) for r in got) == plain_top(rows, asked, 10)


def test_stops_early_and_stays_exact():
    rng = np.random.default_rng(0)
    vectors = rng.integers(-50, 50, (5000, 4))
    vectors[:10] *= 40
    lists = topk.SortedLists(np.arange(5000), vectors)
    rows, scores = lists.top(vectors[0], 3, 0)
    best = sorted(((-int(vectors[0] @ v), i) for i, v in enumerate(vectors) if i))[:3]
    assert list(zip((-scores).tolist(), rows.tolist(), strict=True)) == best


def test_vectors_that_take_no_part(spark):
    rows = [
        (1, [1.0, -0.5]),
        (2, None),
        (3, [1.0, None]),
        (4, [float("nan"), 1.0]),
        (5, [float("-inf"), 1.0]),
        (None, [1.0, 1.0]),
        (6, [0.0009, -0.0001]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.vector for r in topk.integer_vectors(df, "vec_id", "embedding", 1024).collect()}
    assert got == {1: [1024, -512], 6: [0, -1]}
    none = topk.integer_vectors(df.where("vec_id = 2"), "vec_id", "embedding", 1024)
    assert topk.top_k(none, none).count() == 0
