"""Removal of repeated passages by prefix-partitioned suffix trees over words.

A passage repeats if a window of its words occurs elsewhere. Every window has an anchor, the seed of
a few of its words with the smallest hash, so equal windows have equal anchors. Suffixes that share
an anchor are one partition. A partition too large for a task is split by a prefix of twice as many
words around the anchor, step by step, at last by the whole window. Each partition sorts its suffixes
into a suffix array with the lengths of common prefixes; the intervals of these are the internal
nodes of its suffix tree. Nodes as deep as the window are the repeats.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insight.llm.shared import columns, text_slices, written

_KEY = ("doc_id", "mark")
_PART = "name long, high long, low long, at long, words binary, first long, last long"
_FOUND = "places array<long>, firsts array<long>"
_MASK = (1 << 64) - 1
_REMEMBERED = 150_000
#: Longer words are hashed each time.
_LONG = 100
#: Bytes of slices at which a batch of partitions ends.
_BATCH_BYTES = 1 << 23


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= _LONG:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = h
        return h


def words_of(text: str | None) -> list[bytes]:
    """Runs of other characters than ASCII white space."""
    return (text or "").encode().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def anchors(words: list[bytes], window: int, seed: int, hashes: dict) -> tuple[np.ndarray, np.ndarray]:
    """For each window, where its anchor begins, and the hash of the anchor's ``seed`` words.

    The anchor is the leftmost of the window's seeds with the smallest hash.
    """
    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, "int64"), np.empty(0, "uint64")
    word = np.fromiter(map(hashes.__getitem__, words), "uint64", len(words))
    total = np.zeros(len(words) - seed + 1, "uint64")
    for i in range(seed):
        total = _mixed(total + word[i : i + len(total)])
    # The minimum over spans of doubling length; of equal ones the left stays.
    best, span, want = np.arange(len(total)), 1, window - seed + 1
    while span < want:
        step = min(span, want - span)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(total[right] < total[left], right, left)
        span += step
    best = best[:n]
    return best, total[best]


def _anchored(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """``doc_id, mark, anchor``: the distinct anchors of each document."""

    def find(batches):
        hashes = _WordHashes()
        for batch in text_slices(batches, 2):
            ids, marks, out = [], [], []
            for doc, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = np.unique(anchors(words_of(text), window, seed, hashes)[1])
                ids.append(np.full(len(found), doc, "int64"))
                marks.append(np.full(len(found), mark, "int64"))
                out.append(found.view("int64"))
            arrays = [np.concatenate(x) if x else np.empty(0, "int64") for x in (ids, marks, out)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a) for a in arrays], names=[*_KEY, "anchor"]
            )

    return rows.mapInArrow(find, "doc_id long, mark long, anchor long")


def _digest(value: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(value)
    return (d >> 64) - (1 << 63), (d & _MASK) - (1 << 63)


def _slices(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """The words of all windows that share one occurrence of a wanted anchor, as one slice.

    ``doc_id, mark, start, anchor, high, low, words``: ``high`` and ``low`` name the words.
    """

    def cut(batches):
        hashes = _WordHashes()
        for batch in text_slices(batches, 2):
            out: list[tuple] = []
            for doc, mark, text, wanted in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                words = words_of(text)
                at, anchor = anchors(words, window, seed, hashes)
                begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                ends = np.r_[begins[1:], len(at)]
                chosen = np.isin(anchor[begins].view("int64"), np.array(wanted, "int64"))
                for begin, end in zip(begins[chosen].tolist(), ends[chosen].tolist(), strict=True):
                    piece = b" ".join(words[begin : end + window - 1])
                    name = int(anchor[begin : begin + 1].view("int64")[0])
                    out.append((doc, mark, begin, name, *_digest(piece), piece))
            cols = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.binary())],
                names=[*_KEY, "start", "anchor", "high", "low", "words"],
            )

    return rows.mapInArrow(
        cut,
        "doc_id long, mark long, start long, anchor long, high long, low long, words binary",
    )


class SuffixTree:
    """The suffixes of slices of words that are at least ``least`` words long, as a tree.

    ``owner`` and ``inner`` tell for each such suffix its slice and where in it it begins,
    ``order`` sorts them, ``lcp`` has the common words of neighbours in that order. A slice ends with
    a mark of its own, so no common prefix goes beyond it.
    """

    def __init__(self, slices: list[bytes], least: int):
        split = [s.split() for s in slices]
        sizes = np.array([len(w) for w in split], "int64")
        numbers: dict[bytes, int] = {}
        flat: list[int] = []
        for i, words in enumerate(split):
            flat += [numbers.setdefault(w, len(numbers)) for w in words]
            flat.append(-1 - i)
        rank = np.array(flat, "int64") + len(slices)
        # Ranks by the first 1, 2, 4, ... words, until all differ.
        ranks, depth = [rank.astype("int32")], 1
        while depth <= sizes.max(initial=0):
            key = rank * (int(rank.max()) + 2)
            key[: len(key) - depth] += rank[depth:] + 1
            distinct, rank = np.unique(key, return_inverse=True)
            ranks.append(rank.astype("int32"))
            depth *= 2
            if len(distinct) == len(rank):
                break
        begins = np.cumsum(sizes + 1) - sizes - 1
        self.counts = np.maximum(sizes - least + 1, 0)
        self.owner = np.repeat(np.arange(len(slices)), self.counts)
        self.inner = np.arange(len(self.owner)) - np.repeat(
            np.cumsum(self.counts) - self.counts, self.counts
        )
        at = begins[self.owner] + self.inner if len(slices) else self.inner
        self.order = np.argsort(ranks[-1][at])
        left, right = at[self.order][:-1], at[self.order][1:]
        self.lcp = np.zeros(len(left), "int64")
        for level in range(len(ranks) - 1, -1, -1):
            same = ranks[level][left + self.lcp] == ranks[level][right + self.lcp]
            self.lcp += same.astype("int64") << level

    def nodes(self, least: int) -> list[tuple[int, int, int, bool]]:
        """Internal nodes at least ``least`` words deep, below first: the range of their leaves in
        ``order``, their depth, and whether no other such node is above.

        The words of a node are a repeat that no next word prolongs at all its places; it is a
        maximal one if the words before differ too.
        """
        out, open_nodes = [], []
        for i, common in enumerate([*self.lcp.tolist(), 0]):
            begin = i
            while open_nodes and open_nodes[-1][1] > common:
                begin, depth = open_nodes.pop()
                out.append((begin, i + 1, depth, not open_nodes and common < least))
            if common >= least and (not open_nodes or open_nodes[-1][1] < common):
                open_nodes.append((begin, common))
        return out


def first_holders(slices: list[bytes], docs: np.ndarray, window: int) -> list[np.ndarray]:
    """For each window of each slice, the smallest of the ``docs`` whose slice has it: the smallest
    below the uppermost node of the tree that is as deep as the window."""
    if not slices:
        return []
    tree = SuffixTree(slices, window)
    smallest = docs[tree.owner].astype("int64")
    tops = np.array([(b, e) for b, e, _, top in tree.nodes(window) if top], "int64").reshape(-1, 2)
    if len(tops):
        ordered = np.append(smallest[tree.order], 0)
        least = np.minimum.reduceat(ordered, tops.ravel())[::2]
        sizes = tops[:, 1] - tops[:, 0]
        inside = np.arange(sizes.sum()) + np.repeat(tops[:, 0] - np.cumsum(sizes) + sizes, sizes)
        smallest[tree.order[inside]] = np.repeat(least, sizes)
    return np.split(smallest, np.cumsum(tree.counts)[:-1])


def _subtrees(parted: DataFrame, window: int, batch_slices: int) -> DataFrame:
    """``high, low, places, firsts``: the windows of a slice that others hold too, and the smallest
    document that does, if it is smaller than the slice's largest.

    Rows of one partition are together and in order; whole partitions are taken up to a batch of
    ``batch_slices`` or ``_BATCH_BYTES``.
    """

    def build(batches):
        def done(held):
            held = pa.Table.from_batches(held)
            docs = held["first"].to_numpy()
            firsts = first_holders([w.as_py() for w in held["words"]], docs, window)
            last, at = held["last"].to_numpy(), held["at"].to_numpy()
            out = []
            for i, found in enumerate(firsts):
                places = np.flatnonzero(found < last[i])
                if len(places):
                    out.append((i, places + at[i], found[places]))
            chosen, places, found = zip(*out, strict=True) if out else ((),) * 3
            rows = pa.array(chosen, pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    held["high"].take(rows).combine_chunks(),
                    held["low"].take(rows).combine_chunks(),
                    pa.array(places, pa.list_(pa.int64())),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=["high", "low", "places", "firsts"],
            )

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in text_slices(batches, 3):
            if not batch.num_rows:
                continue
            sizes = np.cumsum(pc.binary_length(batch.column(3)).to_numpy(), dtype="int64")
            names = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
            at = 0
            for start in starts.tolist():
                new = not held or held[-1].column(0)[-1].as_py() != names[start] or start > at
                if start > at:
                    held.append(batch.slice(at, start - at))
                    size += int(sizes[start - 1] - (sizes[at - 1] if at else 0))
                    at = start
                if new and held and (sum(b.num_rows for b in held) >= batch_slices or size >= _BATCH_BYTES):
                    yield done(held)
                    held, size = [], 0
            held.append(batch.slice(at))
            size += int(sizes[-1] - (sizes[at - 1] if at else 0))
        if held:
            yield done(held)

    return parted.select("name", "high", "low", "words", "at", "first", "last").mapInArrow(
        build, f"high long, low long, {_FOUND}"
    )


def prefix_lengths(window: int, seed: int) -> list[int]:
    """Twice the seed, and so on, as far as every window has a prefix of that length around its
    anchor that begins at the anchor, ends with the anchor, or has it in the middle."""
    out, k = [], 2 * seed
    while k < window and (k - seed) // 2 <= window - k + 1 and k - seed <= window - k + (k - seed) // 2 + 1:
        out.append(k)
        k *= 2
    return out


def prefix_parts(at: int, n: int, window: int, seed: int, k: int) -> list[tuple[int, int, int]]:
    """The ``n`` windows of a slice with its anchor at ``at``, parted by where a prefix of ``k``
    words lies around the anchor: ``(begin, end, start of the prefix)``.

    It depends on the place of the anchor in a window alone, so equal windows have equal prefixes.
    """
    middle = at - (k - seed) // 2
    cuts = [0, min(n, max(0, at - (k - seed) + 1)), min(n, max(0, at - (window - k))), n]
    cuts[1] = min(cuts[1], cuts[2])
    parts = zip(cuts, cuts[1:], (at - (k - seed), middle, at), strict=False)
    return [(b, e, start) for b, e, start in parts if b < e]


def _lengthened(rows: DataFrame, window: int, seed: int, k: int) -> DataFrame:
    """Partitions split by prefixes of ``k`` words: a slice gives up to three, of fewer windows."""

    def split(batches):
        hashes = _WordHashes()
        for batch in text_slices(batches, 4):
            out: list[tuple] = []
            for _, high, low, at, piece, first, last in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                words = piece.split()
                n = len(words) - window + 1
                anchor = int(anchors(words, window, seed, hashes)[0][0])
                for begin, end, start in prefix_parts(anchor, n, window, seed, k):
                    # With where the anchor is in it, since that tells the three apart.
                    prefix = b"%d " % (anchor - start) + b" ".join(words[start : start + k])
                    part = b" ".join(words[begin : end + window - 1])
                    out.append((_digest(prefix)[0], high, low, at + begin, part, first, last))
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.binary() if i == 4 else pa.int64() for i in range(7)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(cols, kinds, strict=True)],
                names=batch.schema.names,
            )

    return rows.mapInArrow(split, _PART)


def _whole_prefixes(rows: DataFrame, window: int) -> DataFrame:
    """The same as ``_subtrees`` where the prefix is the whole window: a partition is one node, so
    the smallest holder is an aggregate."""

    def windows(batches):
        for batch in text_slices(batches, 4):
            out = []
            for _, high, low, at, piece, first, last in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                words = piece.split()
                for i in range(len(words) - window + 1):
                    name = _digest(b" ".join(words[i : i + window]))
                    out.append((high, low, at + i, first, last, *name))
            cols = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols],
                names=["high", "low", "at", "first", "last", "x", "y"],
            )

    named = written(
        rows.mapInArrow(
            windows, "high long, low long, at long, first long, last long, x long, y long"
        )
    )
    smallest = written(named.groupBy("x", "y").agg(F.min("first").alias("smallest")))
    return (
        named.join(smallest, ["x", "y"])
        .where("smallest < last")
        .groupBy("high", "low")
        .agg(F.collect_list(F.struct("at", "smallest")).alias("all"))
        .select(
            "high", "low", F.col("all.at").alias("places"), F.col("all.smallest").alias("firsts")
        )
    )


def _holders(rows: DataFrame, window: int, seed: int, most: int, batch_slices: int) -> DataFrame:
    """``high, low, places, firsts`` of all slices, prefix by prefix."""
    found = []
    for k in [*prefix_lengths(window, seed), window]:
        large = written(
            rows.groupBy("name")
            .agg(F.count("*").alias("n"), F.sum(F.length("words")).alias("size"))
            .where((F.col("n") > most) | (F.col("size") > _BATCH_BYTES))
            .select("name")
        )
        fits = rows.join(large, "name", "left_anti")
        parted = fits.repartition("name").sortWithinPartitions("name")
        found.append(written(_subtrees(parted, window, batch_slices)))
        if large.isEmpty():
            break
        rest = rows.join(large, "name", "left_semi").select(*rows.columns)
        if k == window:
            found.append(written(_whole_prefixes(rest, window)))
        else:
            rows = written(_lengthened(rest, window, seed, k))
    return reduce(DataFrame.unionByName, found)


def repeated_windows(
    rows: DataFrame, *, window: int, seed: int, most: int, batch_slices: int = 8192
) -> DataFrame:
    """``doc_id, mark, starts``: the windows of each document that also start in one with a
    smaller ``doc_id``. ``rows``: ``doc_id, mark, text``, where ``mark`` tells texts apart."""
    found = written(_anchored(rows, window, seed))
    recurring = written(
        found.groupBy("anchor")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high")
        .select("anchor")
    )
    wanted = (
        found.join(recurring, "anchor")
        .groupBy(*_KEY)
        .agg(F.collect_set("anchor").alias("wanted"))
    )
    slices = written(
        _slices(rows.join(wanted, list(_KEY)).select(*_KEY, "text", "wanted"), window, seed)
    )
    distinct = written(
        slices.groupBy(F.col("anchor").alias("name"), "high", "low", "words")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .select("name", "high", "low", F.lit(0).cast("long").alias("at"), "words", "first", "last")
    )
    holders = _holders(distinct, window, seed, most, batch_slices)
    smaller = F.filter(
        F.arrays_zip("places", "firsts"), lambda x: x["firsts"] < F.col("doc_id")
    )
    hit = F.transform(smaller, lambda x: F.col("start") + x["places"])
    return (
        slices.select(*_KEY, "start", "high", "low")
        .join(holders, ["high", "low"])
        .select(*_KEY, hit.alias("starts"))
        .where(F.size("starts") > 0)
        .groupBy(*_KEY)
        .agg(F.flatten(F.collect_list("starts")).alias("starts"))
    )


def remove_repeated_passages(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    keep: tuple[str, ...] = (),
    *,
    window: int = 50,
    seed: int = 8,
    most: int = 1024,
) -> DataFrame:
    """``doc_id``, ``keep``, ``n_words``, ``n_removed``, ``text`` without the repeated words, and
    ``spans``, the removed word ranges as ``[begin, end)``.

    A word goes if a window of ``window`` consecutive words of its document covers it whose words
    also start in a document with a smaller key; windows are judged on the input. Words are apart
    by ASCII white space and otherwise as they are. The text that stays is the input's own if no
    word goes, else the words left, joined by one space. A null or empty text has no words and
    stays. Rows without key lose nothing and make no other row lose anything; rows with one key
    do not repeat each other. A partition holds at most ``most`` slices of its prefix, and of these
    8 MB; larger ones are split by longer prefixes, up to the whole window, where one is one node.
    """
    base = columns(docs, doc_id=key, text=text, **{f"_{c}": c for c in keep}).withColumn(
        "doc_id", F.col("doc_id").cast("long")
    )
    base = base.withColumn("mark", F.xxhash64("text"))
    rows = base.where("doc_id IS NOT NULL AND text IS NOT NULL").select(*_KEY, "text")
    hits = repeated_windows(rows.dropDuplicates(list(_KEY)), window=window, seed=seed, most=most)
    joined = base.join(hits, list(_KEY), "left").select(*base.columns, "starts")
    names = [c for c in base.columns if c not in ("text", "mark")]
    at, text_at = [base.columns.index(c) for c in names], base.columns.index("text")
    starts_at = len(base.columns)

    def remove(batches):
        for batch in batches:
            out: list[tuple] = []
            for value, starts in zip(
                batch.column(text_at), batch.column(starts_at), strict=True
            ):
                value, words = value.as_py(), words_of(value.as_py())
                spans: list[list[int]] = []
                if starts.is_valid:
                    for s in np.unique(starts.values.to_numpy()).tolist():
                        if spans and s <= spans[-1][1]:
                            spans[-1][1] = s + window
                        else:
                            spans.append([s, s + window])
                gone = sum(e - b for b, e in spans)
                if gone:
                    stay, before = [], 0
                    for b, e in spans:
                        stay += words[before:b]
                        before = e
                    value = b" ".join(stay + words[before:]).decode()
                out.append((len(words), gone, value, spans))
            n, gone, texts, spans = zip(*out, strict=True) if out else ((),) * 4
            arrays = [
                *(batch.column(i) for i in at),
                pa.array(n, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array(texts, pa.string()),
                pa.array(spans, pa.list_(pa.list_(pa.int64()))),
            ]
            yield pa.RecordBatch.from_arrays(
                arrays, names=[*names, "n_words", "n_removed", "text", "spans"]
            )

    fields = ", ".join(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in names)
    out = joined.mapInArrow(
        remove, f"{fields}, n_words long, n_removed long, text string, spans array<array<long>>"
    )
    return out.select(
        "doc_id",
        *(F.col(f"`_{c}`").alias(c) for c in keep),
        "n_words",
        "n_removed",
        "text",
        "spans",
    )
