"""Line and passage deduplication against brute force."""

import hashlib
import random

import numpy as np
import pytest

from insight.llm import lines, substrings


def brute_passages(rows, window):
    first: dict = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if doc is not None:
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            if doc is not None and first[tuple(words[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), left))
    return out


def passages(rng, n, vocabulary, window):
    shared = [[f"p{rng.randrange(vocabulary)}" for _ in range(window * k)] for k in (1, 2, 3)]
    rows = []
    for i in range(n):
        words = [f"v{rng.randrange(vocabulary)}" for _ in range(rng.randrange(0, 4 * window))]
        for s in shared:
            if rng.random() < 0.4:
                at = rng.randrange(len(words) + 1)
                words[at:at] = s[rng.choice([0, 0, 1, window // 2]) :]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    return rows + [(n, None), (n + 1, ""), (n + 2, rows[3][1]), (n + 3, "x " * 6 * window)]


def compare(df, rows, window):
    got = sorted(
        (r.doc_id, r.n_words, r.n_removed, " ".join((r.text or "").split())) for r in df.collect()
    )
    want = sorted((d, n, g, b.decode()) for d, n, g, b in brute_passages(rows, window))
    assert got == want


@pytest.mark.parametrize("vocabulary, most", [(1000, 4096), (3, 4096), (1000, 2), (3, 2)])
def test_passages_against_all_windows(spark, vocabulary, most):
    rows = passages(random.Random(vocabulary), 60, vocabulary, 10)
    rows.append((70, "x " * 40))
    docs = spark.createDataFrame([(d, t, "m", 5) for d, t in rows], "doc_id long, text string, mark string, starts int")
    got = substrings.remove_repeated_passages(docs, window=10, seed=4, most=most)
    compare(got, rows, 10)
    for r in got.collect():
        assert r.n_removed == sum(e - b for b, e in r.spans)


def test_passages_without_key_repeats_and_nothing(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(2, text), (2, text), (None, text), (5, text), (5, "short"), (6, text + " tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.remove_repeated_passages(docs, window=10, seed=4).collect()
    seen = sorted(((r.doc_id or 0), r.n_removed, r.text) for r in got)
    assert seen == [(0, 0, text), (2, 0, text), (2, 0, text), (5, 0, "short"), (5, 30, ""), (6, 30, "tail")]
    none = substrings.remove_repeated_passages(docs.where("doc_id = 9"))
    assert none.count() == 0


def test_passage_query_on_the_smallest_tables(spark):
    from insight.llm.queries import op8_substrings

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = {d: (n, g, hashlib.sha256(b).hexdigest()) for d, n, g, b in brute_passages(rows, 50)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op8_substrings(spark, folder).collect()}
    assert got == want
    assert sum(g for _, g, _ in want.values()) > 0


def test_anchor_is_in_its_window_and_of_its_content():
    rng = random.Random(4)
    words = [b"%d" % rng.randrange(4) for _ in range(400)]
    hashes = substrings._WordHashes()
    at, names = substrings.anchors(words, 12, 4, hashes)
    seen: dict = {}
    for i, (a, name) in enumerate(zip(at.tolist(), names.tolist(), strict=True)):
        assert i <= a <= i + 8
        assert seen.setdefault(tuple(words[i : i + 12]), (a - i, name)) == (a - i, name)


def test_first_holders_of_slices():
    rng = random.Random(6)
    slices = [b" ".join(b"%d" % rng.randrange(2) for _ in range(rng.randrange(5, 30))) for _ in range(40)]
    docs = np.array([rng.randrange(1000) for _ in slices])
    first: dict = {}
    for s, d in zip(slices, docs, strict=True):
        w = s.split()
        for i in range(len(w) - 5):
            first[tuple(w[i : i + 6])] = min(first.get(tuple(w[i : i + 6]), 10**9), int(d))
    for s, got in zip(slices, substrings.first_holders(slices, docs, 6), strict=True):
        w = s.split()
        assert got.tolist() == [first[tuple(w[i : i + 6])] for i in range(len(w) - 5)]


def brute_repeats(slices, least):
    """Sequences of at least ``least`` words in several places that no next word prolongs at all
    of them: their places, and whether they are maximal. Nothing is before or after a slice."""
    places: dict = {}
    for s, text in enumerate(slices):
        words = text.split()
        for b in range(len(words)):
            for e in range(b + least, len(words) + 1):
                places.setdefault(tuple(words[b:e]), []).append((s, b))
    out = {}
    for words, at in places.items():
        after = {(slices[s].split()[b + len(words) :] or [(s, b)])[0] for s, b in at}
        before = {slices[s].split()[b - 1] if b else (s, b) for s, b in at}
        if len(at) > 1 and len(after) > 1:
            out[words] = (sorted(at), len(before) > 1)
    return out


@pytest.mark.parametrize("vocabulary, least", [(2, 4), (2, 7), (3, 1), (50, 3)])
def test_deep_nodes_are_the_repeats_of_brute_force(vocabulary, least):
    rng = random.Random(vocabulary + least)
    shared = [b"%d" % rng.randrange(vocabulary) for _ in range(20)]
    slices = [b""]
    for _ in range(30):
        words = [b"%d" % rng.randrange(vocabulary) for _ in range(rng.randrange(0, 25))]
        slices.append(b" ".join(words + shared[rng.randrange(20) :]))
    tree = substrings.SuffixTree(slices, least)
    found, covered = {}, []
    for begin, end, depth, top in tree.nodes(least):
        leaves = tree.order[begin:end]
        at = sorted(zip(tree.owner[leaves].tolist(), tree.inner[leaves].tolist(), strict=True))
        words = tuple(slices[at[0][0]].split()[at[0][1] : at[0][1] + depth])
        before = {slices[s].split()[b - 1] if b else (s, b) for s, b in at}
        assert words not in found
        found[words] = (at, len(before) > 1)
        covered += leaves.tolist() if top else []
    assert found == brute_repeats(slices, least) and any(m for _, m in found.values())
    assert len(covered) == len(set(covered)) == len({x for at, _ in found.values() for x in at})


@pytest.mark.parametrize("window, seed", [(50, 8), (10, 4), (10, 2), (33, 3)])
def test_longer_prefixes_are_of_the_window_and_equal_for_equal_windows(window, seed):
    assert substrings.prefix_lengths(50, 8) == [16, 32]
    for k in substrings.prefix_lengths(window, seed):
        where: dict = {}
        for at in range(window - seed + 1):
            for n in range(1, window - seed + 2):
                parts = substrings.prefix_parts(at, n, window, seed, k)
                seen = [s for b, e, _ in parts for s in range(b, e)]
                if n <= at + 1:  # all windows begin at the anchor or before
                    assert seen == list(range(n))
                    for b, e, start in parts:
                        for s in range(b, e):
                            assert s <= start and start + k <= s + window
                            assert where.setdefault(at - s, at - start) == at - start


def test_partitions_beyond_a_bound_are_split_step_by_step(spark, monkeypatch):
    """A passage between words that differ: one hot anchor, and what is split by 8 and by 10 words."""
    used = []
    longer, whole = substrings._lengthened, substrings._whole_prefixes
    monkeypatch.setattr(substrings, "_lengthened", lambda *a: used.append(a[-1]) or longer(*a))
    monkeypatch.setattr(substrings, "_whole_prefixes", lambda *a: used.append(a[-1]) or whole(*a))
    shared = [f"p{i}" for i in range(11)]
    rows = [
        (i, " ".join([*(f"a{i}x{k}" for k in range(9)), *shared[i % 3 :], *(f"b{i}y{k}" for k in range(9))]))
        for i in range(90)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    compare(substrings.remove_repeated_passages(docs, window=10, seed=4, most=20), rows, 10)
    assert used == [8, 10]
    used.clear()
    compare(substrings.remove_repeated_passages(docs, window=10, seed=4, most=100), rows, 10)
    assert used == []


def test_long_words_and_words_with_nul_bytes():
    plain = b" ".join(b"w%d" % i for i in range(60))
    slices = [b"x" * 1_000_000 + b" " + plain] + [plain] * 8000
    got = substrings.first_holders(slices, np.arange(len(slices)), 50)
    assert got[0].tolist() == [0] * 12 and got[8000].tolist() == [0] * 11
    assert [f.tolist() for f in substrings.first_holders([b"a b", b"a b\x00"], np.array([1, 2]), 2)] == [[1], [2]]


@pytest.mark.parametrize("most_bytes", [1, 400, 1 << 25])
def test_partitions_are_bounded_by_bytes(spark, monkeypatch, most_bytes):
    monkeypatch.setattr(substrings, "_BATCH_BYTES", most_bytes)
    rows = passages(random.Random(9), 40, 500, 10)
    rows += [(90 + i, " ".join(["y" * 50_000, *(f"p{k}" for k in range(30)), "\x00z"[i:]])) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    compare(substrings.remove_repeated_passages(docs, window=10, seed=4), rows, 10)


# ---------------------------------------------------------------- lines


def brute_lines(rows, depth=3, least=3, constant=0.7):
    """What stays of each document, by sets of documents."""
    kinds: dict = {}
    for doc, text in rows:
        if doc is None or text is None:
            continue
        for tokens in lines.masked_lines(text):
            if tokens:
                kinds.setdefault(tuple(tokens), set()).add(doc)
    stable: dict = {}
    leaf = lambda t: (len(t), t[:depth])
    for t, docs in kinds.items():
        for i, token in enumerate(t):
            stable.setdefault((leaf(t), i, token), set()).update(docs)
    groups: dict = {}
    for t in kinds:
        stays = tuple((i, x) for i, x in enumerate(t) if len(stable[leaf(t), i, x]) >= least)
        if len(stays) >= constant * len(t):
            groups.setdefault((leaf(t), stays), []).append(t)
    first = {t: min(d) for t, d in kinds.items() if len(d) >= least}
    for members in groups.values():
        docs = set().union(*(kinds[t] for t in members))
        if len(docs) >= least:
            first |= {t: min(first.get(t, min(docs)), min(docs)) for t in members}
    out = []
    for doc, text in rows:
        if doc is None or text is None:
            out.append((doc, text, 0 if text is None else text.count("\n") + 1, 0))
            continue
        parts = text.split("\n")
        stay = [
            line
            for line, t in zip(parts, lines.masked_lines(text), strict=True)
            if not t or first.get(tuple(t), doc) == doc
        ]
        out.append((doc, "\n".join(stay), len(parts), len(parts) - len(stay)))
    return out


def logs(rng, n):
    rows = []
    for i in range(n):
        mine = []
        for _ in range(rng.randrange(0, 8)):
            mine.append(
                rng.choice(
                    [
                        f"page {rng.randrange(99)} of {rng.randrange(99)}",
                        f"posted by user {rng.choice('abcdefghijklmnop')}x{rng.choice('qrstuv')} on this site today",
                        "All rights reserved.",
                        "",
                        "  \t",
                        " ".join(rng.choice(["the", "of", "sun", "sea", "é"]) for _ in range(9)),
                        f"only here {i} " + "x" * i,
                    ]
                )
            )
        rows.append((i, "\n".join(mine)))
    return rows + [(n, None), (n + 1, ""), (n + 2, "\n\n"), (None, "All rights reserved.\nx")]


def test_lines_against_brute_force(spark):
    rows = logs(random.Random(8), 80)
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, leaf int, n_lines int")
    got = lines.drop_recurring_lines(docs, keep=("leaf",)).collect()
    want = brute_lines(rows)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got), key=str) == sorted(want, key=str)
    assert sum(w[3] for w in want) > 100
    assert {r.leaf for r in got} == {1}


def test_lines_of_repeated_rows_and_nothing(spark):
    rows = [(1, "same line\nown one"), (1, "same line\nown one"), (2, "same line"), (3, "same line\nc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text, r.n_removed) for r in lines.drop_recurring_lines(docs).collect())
    assert got == [(1, rows[0][1], 0), (1, rows[0][1], 0), (2, "", 1), (3, "c", 1)]
    assert lines.drop_recurring_lines(docs.where("doc_id = 9")).count() == 0


def test_a_document_counts_once_for_a_template(spark):
    table = "\n".join(f"row of table {c}x with one value" for c in "abcdefghijklmnopqrstuvwxyz")
    rows = [(1, table), (2, "row of table other with one value")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in lines.drop_recurring_lines(docs).collect()} == {1: 0, 2: 0}
    third = docs.union(spark.createDataFrame([(3, "row of table third with one value")], docs.schema))
    assert {r.doc_id: r.n_removed for r in lines.drop_recurring_lines(third).collect()} == {1: 0, 2: 1, 3: 1}


@pytest.mark.parametrize("least", [2, 3, 5])
def test_lines_against_sets_of_documents(spark, least):
    rng = random.Random(least)
    rows = []
    for i in range(60):
        form = "abcdefgh"[i % 8]
        mine = [f"{form} b c {rng.choice('xyzuvw')} {rng.choice('pq')} e f" for _ in range(rng.randrange(9))]
        rows.append((i, "\n".join(mine + [f"{rng.choice('abc')}{i % 31} k l {rng.choice('xyzuvw')} m n o"] * (i % 2))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in lines.drop_recurring_lines(docs, least=least).collect()}
    assert got == {d: gone for d, _, _, gone in brute_lines(rows, least=least)}
    assert sum(got.values()) > 50


def test_line_query_on_the_smallest_tables(spark):
    from insight.llm.queries import op10_lines

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = {d: (n, g, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, g in brute_lines(rows)}
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in op10_lines(spark, folder).collect()}
    assert got == want
