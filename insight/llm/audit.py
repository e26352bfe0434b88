"""Audit of how sources diverge within a language, with skybands of terms.

Term counts of each group, a source within a language, and of the language are smoothed to
integer probabilities. A term's divergence in a group grows with its count in the group and falls
with its count in the language. So a term that ``k`` others dominate, with at least its group
count, at most its language count, and an earlier name, is never among the group's first ``k``.
Partitions retain only their skybands, the terms that fewer than ``k`` dominate; skybands are
merged, and only what is left is ranked exactly.

Pairs of sources are compared over all terms, in blocks of sources and terms.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from insight.llm.shared import columns, text_slices, written

#: ASCII letters and all characters beyond ASCII, which in UTF-8 are bytes above 127.
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
#: Bytes of a text that are split into terms at once.
_BLOCK = 1 << 22
#: Different terms of a task after which it sends on what it has counted.
_HELD = 400_000
SCALE = 1_000_000_000
_GROUP = ["lang", "source"]
_COUNTS = "lang string, source string, term string, n long, docs long"


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text with A-Z lowered, block by block; a block ends where a term ends."""
    data = text.encode().lower()
    begin = 0
    while begin < len(data):
        end = begin + _BLOCK
        if more := _TERM.match(data, end):
            end = more.end()
        yield _TERM.findall(data, begin, end)
        begin = end


def _counted(batches):
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def sent():
        columns_: list[list] = [[], [], [], [], []]
        for (lang, source), (times, docs) in counts.items():
            size = len(times)
            for column, values in zip(
                columns_,
                ([lang] * size, [source] * size, times.keys(), times.values(), map(docs.get, times)),
                strict=True,
            ):
                column.extend(values)
        counts.clear()
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        arrays = [pa.array(c, kind) for c, kind in zip(columns_, kinds, strict=True)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])

    for batch in text_slices(batches, 2):
        for lang, source, text in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True
        ):
            times, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            for terms in terms_of(text.as_py()):
                times.update(terms)
                seen.update(terms)
            docs.update(seen)
        if sum(len(times) for times, _ in counts.values()) >= _HELD:
            yield sent()
    if counts:
        yield sent()


def smoothed(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kinds)), exact for any long: digits are divided out
    in two steps that stay below 2**63."""
    high, low = F.lit(100_000), F.lit(10_000)
    first = (n + 1) * high
    whole = F.greatest(total + kinds, F.lit(1).cast("long"))
    rest = (first % whole) * low
    div = lambda a, b: F.call_function("div", a, b)
    return 1 + div(first, whole) * low + div(rest, whole)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def _runs(batch: pa.RecordBatch, keys: int) -> list[int]:
    """Where rows begin whose first ``keys`` columns differ from the row before, and the end."""
    n = batch.num_rows
    new = np.ones(n, bool)
    if n > 1:
        same = [
            pc.equal(column.slice(1), column.slice(0, n - 1)).to_numpy(False)
            for column in batch.columns[:keys]
        ]
        new[1:] = ~np.logical_and.reduce(same)
    return [*np.flatnonzero(new).tolist(), n]


class _Band:
    """Counts of the terms of one group that are held, in order of their names."""

    def __init__(self, k: int):
        self.k = k
        self.n = self.total = np.empty(0, "int64")
        self.cuts = self.bars = np.empty(0, "int64")
        self.planned = 0

    def _plan(self) -> None:
        """For some totals: the k-th highest count among the held terms of at most that total."""
        self.planned = len(self.n)
        order = np.argsort(self.total, kind="stable")
        ends = np.unique(np.linspace(self.k, len(order), 32).astype(int))
        self.cuts = self.total[order[ends - 1]]
        n = self.n[order]
        self.bars = np.array([np.partition(n[:e], e - self.k)[e - self.k] for e in ends])

    def passed(self, n: np.ndarray, total: np.ndarray) -> np.ndarray:
        """False only where ``k`` held terms dominate."""
        if len(self.n) >= self.k and len(self.n) > 1.2 * self.planned:
            self._plan()
        if not self.planned:
            return np.ones(len(n), bool)
        at = np.searchsorted(self.cuts, total, "right") - 1
        return (at < 0) | (n > self.bars[at])

    def hold(self, n: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Which of these, the next in order of names, fewer than ``k`` terms dominate."""
        a, b = n[:, None], total[:, None]
        dominating = ((self.n >= a) & (self.total <= b)).sum(1)
        dominating += np.tril((n >= a) & (total <= b), -1).sum(1)
        keep = dominating < self.k
        self.n, self.total = np.append(self.n, n[keep]), np.append(self.total, total[keep])
        return keep


def skyband(keys: int, k: int, block: int = 512):
    """A function for sorted partitions: of rows of ``keys`` columns, then ``term, n, total``, in
    order of all but the last two, those that fewer than ``k`` others of their key dominate.

    Names come in order, so all that may dominate a row has passed. Only the skyband so far is
    held: what a dropped row dominates, ``k`` rows that are held dominate too.
    """

    def run(batches):
        current, band = None, _Band(k)
        for batch in batches:
            n = batch.column(keys + 1).to_numpy()
            total = batch.column(keys + 2).to_numpy()
            stays = np.zeros(len(n), bool)
            bounds = _runs(batch, keys)
            for begin, end in zip(bounds, bounds[1:], strict=False):
                key = [batch.column(i)[begin].as_py() for i in range(keys)]
                if key != current:
                    current, band = key, _Band(k)
                while begin < end:
                    # Short steps at first, until there is something to be dominated by.
                    step = min(end, begin + (block if len(band.n) < k else 16 * block))
                    rows = begin + np.flatnonzero(band.passed(n[begin:step], total[begin:step]))
                    for i in range(0, len(rows), block):
                        part = rows[i : i + block]
                        stays[part] = band.hold(n[part], total[part])
                    begin = step
            yield batch.filter(pa.array(stays))

    return run


def _first_terms(terms: DataFrame, groups: DataFrame, k: int, merges: tuple[int, ...]) -> DataFrame:
    """``lang, source, item, value, rank``: each group's ``k`` terms of the highest divergence."""
    rows = terms.select(*_GROUP, "term", "n", "total")
    schema = "lang string, source string, term string, n long, total long"
    band = rows.sortWithinPartitions(*_GROUP, "term").mapInArrow(skyband(2, k), schema)
    for parts in merges:
        dealt = band.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(parts)))
        order = [*_GROUP, "part", "term", "n", "total"]
        band = (
            dealt.repartition(*_GROUP, "part")
            .select(*order)
            .sortWithinPartitions(*order[:4])
            .mapInArrow(skyband(3, k), schema.replace("term", "part long, term"))
            .drop("part")
        )
    p = smoothed(F.col("n"), F.col("size"), F.col("kinds"))
    q = smoothed(F.col("total"), F.col("lang_size"), F.col("kinds"))
    ranked = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "item")
    return (
        band.join(groups, _GROUP)
        .withColumns({"p": p, "q": q})
        .where(F.col("p") > F.col("q"))
        .select(*_GROUP, F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
    )


class _Block:
    """Divergences between the members of one key: (lang, low, high, salt).

    A member has the probability of an absent term where a term has no entry for it. Only terms
    that are seen here are summed, each less what two absences give; the first salt adds that
    for all terms of the language.
    """

    def __init__(self, key: list, members: list[tuple], tile: int):
        self.key, self.members, self.tile = key, members, tile
        self.names = pa.array([m[1] for m in members], pa.string())
        self.absent = np.array([m[2] for m in members], "int64")
        self.sums = np.zeros((len(members),) * 2, "int64")
        self.dense = np.empty((0, len(members)), "int64")
        self.used = self.seen = 0
        self.last: str | None = None

    def add(self, terms: pa.Array, sources: pa.Array, p: np.ndarray) -> None:
        """Entries in order of their terms, which may go on with the last term so far."""
        new = np.ones(len(p), bool)
        new[0] = terms[0].as_py() != self.last
        new[1:] = pc.not_equal(terms.slice(1), terms.slice(0, len(p) - 1)).to_numpy(False)
        self.last = terms[len(p) - 1].as_py()
        at = pc.index_in(sources, self.names).to_numpy()
        number = np.cumsum(new)
        if not len(self.dense):
            self.dense = np.tile(self.absent, (self.tile, 1))
        begin = done = 0
        while begin < len(p):
            if self.used == self.tile and number[begin] > done:
                self.score()
            end = int(np.searchsorted(number, done + self.tile - self.used, "right"))
            self.dense[self.used + number[begin:end] - done - 1, at[begin:end]] = p[begin:end]
            self.used += int(number[end - 1]) - done
            done, begin = int(number[end - 1]), end
        self.seen += done

    def score(self) -> None:
        known = self.dense[: self.used]
        for i in range(len(self.members)):
            apart = known[:, i : i + 1] - known
            self.sums[i] += (apart * apart // known).sum(0)
        self.dense[:] = self.absent
        self.used = 0

    def rows(self):
        """lang, source, other source and value."""
        if self.used:
            self.score()
        lang, low, high, salt = self.key
        for i, (block, source, p, kinds) in enumerate(self.members):
            for j, (other_block, other, q, _) in enumerate(self.members):
                if source != other and (low == high or block != other_block):
                    times = (kinds if salt == 0 else 0) - self.seen
                    yield lang, source, other, int(self.sums[i, j]) + (p - q) ** 2 // q * times


def _compare(batches, tile: int):
    """Of each key its members come first, with a null term, and then its terms in order."""
    key, members, block, out = None, [], None, []

    def close():
        if key is not None:
            out.extend((block or _Block(key, members, tile)).rows())

    for batch in batches:
        bounds = _runs(batch, 4)
        for begin, end in zip(bounds, bounds[1:], strict=False):
            part = batch.slice(begin, end - begin)
            name = [part.column(i)[0].as_py() for i in range(4)]
            if name != key:
                close()
                key, members, block = name, [], None
            heads = part.column(4).null_count
            told = part.slice(0, heads)
            members += zip(*(told.column(i).to_pylist() for i in (5, 6, 7, 8)), strict=True)
            if heads < part.num_rows:
                block = block or _Block(key, members, tile)
                rest = part.slice(heads)
                block.add(rest.column(4), rest.column(6), rest.column(7).to_numpy())
        if len(out) >= 1 << 16:
            yield _pairs_batch(out)
            out.clear()
    close()
    yield _pairs_batch(out)


def _pairs_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    arrays = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=[*_GROUP, "item", "value"])


def _pairs(
    terms: DataFrame, groups: DataFrame, together: int, salts: int, tile: int
) -> DataFrame:
    """``lang, source, item, value, rank``: for each group all other sources of its language."""
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    blocks = -(-most // together)
    block = F.pmod(F.xxhash64("source"), F.lit(max(blocks, 1))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(max(blocks - 1, 0)))).alias("other")

    def dealt(rows: DataFrame, term: Column, salt: Column, p: Column) -> DataFrame:
        """Each row to all pairs of blocks that its source's is in."""
        return rows.withColumn("block", block).select("*", other).select(
            "lang",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            salt.alias("salt"),
            term.alias("term"),
            "block",
            "source",
            p.alias("p"),
            "kinds",
        )

    size, kinds = F.col("size"), F.col("kinds")
    members = dealt(
        groups,
        F.lit(None).cast("string"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))),
        smoothed(F.lit(0).cast("long"), size, kinds),
    )
    present = dealt(
        terms.join(groups, _GROUP),
        F.col("term"),
        F.pmod(F.xxhash64("term"), F.lit(salts)).cast("int"),
        smoothed(F.col("n"), size, kinds),
    )
    key = ["lang", "low", "high", "salt"]
    found = (
        members.unionByName(present)
        .repartition(*key)
        .sortWithinPartitions(*key, F.asc_nulls_first("term"), "source")
        .mapInArrow(lambda batches: _compare(batches, tile), "lang string, source string, item string, value long")
    )
    ranked = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "item")
    return (
        found.groupBy(*_GROUP, "item")
        .agg(F.sum("value").alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
    )


def divergence_audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    *,
    least: int = 3,
    first: int = 200,
    merges: tuple[int, ...] = (16, 1),
    together: int = 256,
    salts: int = 32,
    tile: int = 2048,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source differs from the others of its
    language (part ``pair``, every other source) and which terms set it apart (part ``term``, the
    ``first`` terms more probable in it than in its language).

    A language keeps the terms that are in at least ``least`` of its rows. Probabilities are
    ``SCALE``-ths and divergences whole numbers, exact while a count is below 9e13. Null text,
    language or source count as empty ones. A group without terms has all counts 0; a language
    without kept terms has pairs of value 0 and no terms. Equal values are in order of the item's
    UTF-8. Repeated rows count each; an empty table gives no rows. The rows of part ``pair`` are
    as many as there are pairs of sources; ``together`` sources are compared with as many in one
    block.
    """
    rows = columns(docs, lang=lang, source=source, text=text).select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text"))
    )
    # Tasks have counted before this shuffle, so a term has one row for each group and some 10 MB
    # of text; both sums are made where it brought the rows.
    everywhere = Window.partitionBy("lang", "term")
    counts = (
        rows.mapInArrow(_counted, _COUNTS)
        .repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    terms = written(
        counts.withColumns(
            {"total": F.sum("n").over(everywhere), "docs": F.sum("docs").over(everywhere)}
        )
        .where(F.col("docs") >= least)
        .drop("docs")
    )
    sizes = terms.groupBy(*_GROUP).agg(F.sum("n").alias("size"))
    langs = (
        terms.groupBy("lang", "term").agg(F.max("total").alias("total"))
        .groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("total").alias("lang_size"))
    )
    groups = written(
        rows.select(*_GROUP).distinct()
        .join(sizes, _GROUP, "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["size", "kinds", "lang_size"])
    )
    pairs = _pairs(terms, groups, together, salts, tile).withColumn("part", F.lit("pair"))
    best = _first_terms(terms, groups, first, merges).withColumn("part", F.lit("term"))
    return pairs.unionByName(best).select("lang", "source", "part", "item", "value", "rank")
