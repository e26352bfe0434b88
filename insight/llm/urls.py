"""URL filter: rules by host and path, and a tree of path templates learned per host.

Level by level, as deep as a node has enough urls, the segments with enough of them below a node of
a host's tree stay, all others become a wildcard, and siblings whose counts do not differ by a test of
two proportions are merged. Siblings with equal counts are one row before they are put in order.
A template is rejected if enough of its labelled urls are bad, after smoothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from insight.llm.shared import columns, lower_ascii, written

WILDCARD = "*"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(_after(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rule_of(host: Column, path: Column, rules: dict[str, bool]) -> tuple[Column, Column]:
    """The longest rule that fits, else null, and whether it blocks.

    A rule is a host and a path, as in ``example.net/en/``; it fits its host and all subdomains
    where the path starts with the rule's. Of rules of one length, the first by name wins.
    """
    rule, blocks = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for text in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule = F.when(fits, text).otherwise(rule)
        blocks = F.when(fits, rules[text]).otherwise(blocks)
    return rule, blocks


def _differ(bad_a: Column, n_a: Column, bad_b: Column, n_b: Column, z: float) -> Column:
    """Whether two shares differ, by the z-test of two proportions."""
    pooled = (bad_a + bad_b) / (n_a + n_b)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n_a + 1 / n_b))
    return F.abs(bad_a / n_a - bad_b / n_b) > z * spread + 1e-12


def _runs(rows: DataFrame, within: list[str], hit: str, of: str, run: str, z: float) -> DataFrame:
    """``rows`` with ``run``: the siblings in order of ``hit`` / ``of``, a new run where neighbours
    differ. What differs from its run as a whole is its own run, so that small steps do not add up.

    Only the distinct pairs of counts are put in order: siblings with one pair cannot differ. A node
    of N urls has at most about (3 N) ^ (2 / 3) / 2 of them, a million at a thousand million urls,
    however many segments it has.
    """
    pairs = rows.groupBy(*within, hit, of).agg(F.sum("_same").alias("_same"))
    order = Window.partitionBy(*within).orderBy(F.col(hit) / F.col(of), of)
    whole = Window.partitionBy(*within, run)
    last, n = F.lag(hit).over(order), F.lag(of).over(order)
    breaks = F.when(_differ(F.col(hit), F.col(of), last, n, z), 1).otherwise(0)
    numbered = pairs.withColumn("_breaks", breaks).withColumn(run, F.sum("_breaks").over(order))
    hits, all_of = (F.sum(F.col(c) * F.col("_same")).over(whole) for c in (hit, of))
    apart = _differ(F.col(hit), F.col(of), hits, all_of, z)
    alone = F.when(apart, F.struct(hit, of)).alias("alone")
    named = numbered.withColumn(run, F.struct(run, alone)).drop("_breaks", "_same")
    return rows.join(named, [*within, hit, of])


def _constants(rows: DataFrame, support: int, z: float) -> DataFrame:
    """``host, node, segment, branch``: the segments that stay below each node, and the name of
    the branch they belong to: the first of the siblings that they do not differ from."""
    by, counts = ["host", "node"], ["inner", "n", "bad", "labelled"]
    kept = written(
        rows.groupBy(*by, F.col("rest")[0].alias("segment"))
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.size("rest") > 1, F.col("n")).otherwise(0)).alias("inner"),
            F.sum("labelled").alias("labelled"),
            F.sum("bad").alias("bad"),
        )
        .where(F.col("n") >= support)
    )
    judged = kept.where(F.col("labelled") > 0)
    alike = judged.groupBy(*by, *counts).agg(
        F.min("segment").alias("first"), F.count("*").alias("_same")
    )
    deep = _runs(written(alike), by, "inner", "n", "deep", z)
    like = written(_runs(written(deep), [*by, "deep"], "bad", "labelled", "like", z))
    first = like.groupBy(*by, "deep", "like").agg(F.min("first").alias("branch"))
    branches = written(like.join(first, [*by, "deep", "like"]).select(*by, *counts, "branch"))
    return (
        judged.join(branches, [*by, *counts])
        .select(*by, "segment", "branch")
        .unionByName(kept.where("labelled = 0").select(*by, "segment", F.col("segment").alias("branch")))
    )


def _descend(rows: DataFrame, constants: DataFrame) -> DataFrame:
    """``rows`` one level down: ``node`` gets its branch or a wildcard. ``wild`` is the segment at
    the first wildcard."""
    step = rows.withColumn("segment", F.col("rest")[0]).join(
        constants, ["host", "node", "segment"], "left"
    )
    below = F.concat("node", F.lit("/"), F.coalesce("branch", F.lit(WILDCARD)))
    return step.withColumns(
        {
            "node": below,
            "wild": F.coalesce("wild", F.when(F.col("branch").isNull(), F.col("segment"))),
            "rest": F.slice("rest", 2, F.size("rest")),
        }
    ).drop("segment", "branch")


def template_tree(
    urls: DataFrame,
    *,
    support: int = 5,
    z: float = 1.96,
) -> tuple[DataFrame, list[DataFrame]]:
    """``host, path, node, wild, n, labelled, bad`` of each distinct path, and the constant segments
    of each level. ``node`` is its template, ``wild`` its segment at the template's first wildcard;
    of its ``n`` rows in ``urls`` (host, path and nullable boolean ``bad``) so many are labelled, bad.

    A segment stays if it has at least ``support`` urls, whatever its share of its node's. A node is
    open as long as ``support`` urls go on below it; a level works on the paths of open nodes only,
    and below a closed one all segments are wildcards. So no depth is fixed: levels end where no
    node is open. A path that alone goes on below its node is finished at once. A path without
    segments has the host as its template.
    """
    rows = (
        urls.groupBy("host", "path")
        .agg(
            F.count("*").alias("n"),
            F.count("bad").alias("labelled"),
            F.count_if("bad").alias("bad"),
        )
        .withColumns(
            {
                "rest": F.filter(F.split("path", "/"), lambda s: s != ""),
                "node": F.lit(""),
                "wild": F.lit(None).cast("string"),
            }
        )
    )
    rows, done, levels = written(rows), [], []
    while True:
        going = rows.where(F.size("rest") > 0)
        below = going.groupBy("host", "node").agg(
            F.sum("n").alias("urls"), F.min("rest").alias("one"), F.max("rest").alias("other")
        )
        alone = F.col("one") == F.col("other")
        state = F.when(F.col("urls") < support, "few").when(alone, "alone").otherwise("open")
        states = written(below.select("host", "node", state.alias("state")))
        seen = written(rows.join(states, ["host", "node"], "left"))
        stays, ends = F.col("state") == "alone", F.size("rest") == 0
        rest = F.transform("rest", lambda s: F.when(stays, s).otherwise(F.lit(WILDCARD)))
        wild = F.when((F.col("state") == "few") & ~ends, F.get("rest", F.lit(0)))
        tail = F.when(ends, "").otherwise(F.concat(F.lit("/"), F.array_join(rest, "/")))
        done.append(
            seen.where(ends | (F.col("state") != "open"))
            .withColumns({"node": F.concat("node", tail), "wild": F.coalesce("wild", wild)})
            .drop("rest", "state")
        )
        rows = seen.where(~ends & (F.col("state") == "open")).drop("state")
        if rows.isEmpty():
            break
        levels.append(written(_constants(rows, support, z)))
        rows = written(_descend(rows, levels[-1]))
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole, levels


def filter_urls(
    pages: DataFrame,
    rules: dict[str, bool],
    key: str = "page_id",
    url: str = "url",
    *,
    purity: float = 0.9,
    prior: float = 1.0,
    labels: DataFrame | None = None,
    **tree,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of every row.

    ``rules`` maps a host and path to whether it blocks. The longest rule that fits decides; for
    other urls the template does: it blocks if (bad + prior) / (labelled + 2 prior) is at least
    ``purity``, so a template without labelled urls allows. Where a template has a wildcard and
    less than half of its urls are labelled, the segments at its first wildcard are counted so, each
    once: as bad by the share of its own labelled urls. So no small branch decides. Urls count as labelled by the rule
    that decides them, or, where ``labels`` (``url`` and boolean ``bad``, one row for each url)
    has them, by that. A null url, or one without ``://``, has an empty host and path. Repeated
    rows count and are judged each.
    """
    base = columns(pages, page_id=key, url=url)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    base = base.withColumns({"host": host, "path": path})
    rule, blocks = rule_of(F.col("host"), F.col("path"), rules)
    judged = base.withColumns({"rule": rule, "blocks": blocks})
    if labels is None:
        judged = judged.withColumn("bad", F.col("blocks"))
    else:
        given = labels.select("url", F.col("bad").alias("given"))
        judged = judged.join(given, "url", "left").withColumn(
            "bad", F.coalesce("given", "blocks")
        ).drop("given")
    judged = written(judged.drop("url"))
    tree_rows, _ = template_tree(judged, **tree)
    paths = written(tree_rows)
    branches = paths.groupBy("host", "node", "wild").agg(
        F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")
    )
    known, seen = F.sum("labelled"), F.count_if(F.col("labelled") > 0)
    each = F.coalesce(F.sum(F.col("bad") / F.nullif("labelled", F.lit(0))), F.lit(0.0))
    by_branch = (F.count("wild") > 0) & (known * 2 < F.sum("n"))
    share = F.when(by_branch, (each + prior) / (seen + 2 * prior)).otherwise(
        (F.sum("bad") + prior) / (known + 2 * prior)
    )
    rejected = written(
        branches.groupBy("host", "node")
        .agg(share.alias("purity"))
        .where(F.col("purity") >= purity)
        .select("host", "node", "purity")
    )
    known_paths = written(
        paths.join(rejected, ["host", "node"], "left").select("host", "path", "node", "purity")
    )
    verdict = F.coalesce("blocks", F.col("purity").isNotNull())
    return judged.join(known_paths, ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.when(verdict, "block").otherwise("allow").alias("verdict"),
        F.concat("host", "node").alias("template"),
        "purity",
    )


def recovery(
    pages: DataFrame, rules: dict[str, bool], key: str = "page_id", url: str = "url", **options
) -> DataFrame:
    """How well templates find again what rules decide: ``hidden, bad, found, wrong, recall,
    precision`` in one row.

    Of the urls that a rule decides, half, by a hash of the url, keep its verdict as their label; the
    others are judged by their templates alone. ``recall`` is found / bad, ``precision``
    found / (found + wrong); null where there are none. ``options`` are those of ``filter_urls``.
    """
    base = columns(pages, page_id=key, url=url)
    _, blocks = rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)
    decided = written(
        base.withColumns({"blocks": blocks, "hidden": F.pmod(F.xxhash64("url"), F.lit(2)) == 1})
    )
    shown = decided.where(F.col("blocks").isNotNull() & ~F.col("hidden"))
    labels = shown.select("url", F.col("blocks").alias("bad")).distinct()
    judged = filter_urls(decided, {}, "page_id", "url", labels=labels, **options)
    told = decided.where(F.col("blocks").isNotNull() & F.col("hidden")).join(
        judged.select("page_id", "verdict"), "page_id"
    )
    blocked = F.col("verdict") == "block"
    counts = told.agg(
        F.count("*").alias("hidden"),
        F.count_if("blocks").alias("bad"),
        F.count_if(blocked & F.col("blocks")).alias("found"),
        F.count_if(blocked & ~F.col("blocks")).alias("wrong"),
    )
    return counts.withColumns(
        {
            "recall": F.try_divide("found", "bad"),
            "precision": F.try_divide("found", F.col("found") + F.col("wrong")),
        }
    )
