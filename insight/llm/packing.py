"""Best-fit packing of token sequences, certified by lower bounds and repacked across gaps.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens. Full pieces are
sequences of their own; the others are packed partition by partition, best fit decreasing. Dual
feasible functions give a lower bound of the sequences that a partition needs. A partition that
uses no more is certified; the sequences with room of the others exchange their documents, which
are dealt anew to fewer partitions and packed again, until a round saves no sequence.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insight.llm.shared import columns, kept_in_stage, text_slices, written

#: Encoded words of a generation; a Python worker remembers two, about 200 bytes for each word.
_REMEMBERED = 250_000


class _Words(dict):
    """Ids of white-space separated words, as bytes of little-endian 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends: np.ndarray | None = None
        self.old: dict[bytes, bytes] = {}
        self._plain = None
        self._habits: tuple[bool, bool] | None = None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, word: bytes) -> bytes:
        if (known := self.old.get(word)) is not None:
            self[word] = known
            return known
        lowers, parts = self.habits()
        lower = word.lower()
        if lowers and word != lower and word.isascii():
            ids = self[lower]
        elif parts and len(word) > 1 and word[-1:] in (b".", b",") and word.decode()[-2].isalpha():
            ids = self[word[:-1]] + self[word[-1:]]
        else:
            ids = self._ids(word.decode())
        self[word] = ids
        return ids

    def habits(self) -> tuple[bool, bool]:
        """Whether the tokenizer lowers A-Z itself, and whether it parts letters from a last ``.``
        or ``,``, each tried on words with every letter. Where it does not, words are encoded as
        they are."""
        if self._habits is None:
            letters = "abcdefghijklmnopqrstuvwxyz"
            small = [a + b for a in letters for b in letters]
            lowers = self._ids(" ".join(small)) == self._ids(" ".join(w.title() for w in small))
            lowers &= self._ids(" ".join(small)) == self._ids(" ".join(small).upper())
            words = [*letters, *small, *(w.upper() for w in small)]
            parts = all(
                self._ids(" ".join(w + end for w in words))
                == self._ids(" ".join(f"{w} {end}" for w in words))
                for end in ".,"
            )
            self._habits = lowers, parts
        return self._habits

    def _ids(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(found, "<u4").tobytes()

    def learn(self, words: set[bytes]) -> None:
        """Encode new words of letters only in one call. Each is one pre-token, whose last token
        alone has the word-end mark; if the ends don't add up, they are left for later."""
        old = self.old
        lowers, parts = self.habits()
        cores = {w.lower() if lowers and w.isascii() else w for w in words if w not in old}
        if parts:
            cores = {w.rstrip(b".,") for w in cores}
        new, other = [], []
        for w in cores:
            if w not in self and w not in old:
                (new if (t := w.decode()).isalpha() else other).append(t)
        # the tokenizer would get each of the others alone, by __missing__, so they go in one call
        found = self.tokenizer.encode_batch_fast(other, add_special_tokens=False) if other else []
        for t, encoding in zip(other, found, strict=True):
            self[t.encode()] = np.array(encoding.ids, "<u4").tobytes()
        if not new:
            return
        if self.ends is None:
            marks = [t.endswith(self.mark) for t in self._vocabulary()]
            self.ends = np.array(marks)
        plain = [t for t in new if t.isascii() and t.islower()]
        self._encode_words(plain, self.plain())
        self._encode_words([t for t in new if not (t.isascii() and t.islower())], self.tokenizer)

    def plain(self):
        """The model without normaliser and pattern, for words of a-z that need neither.

        Used only if it gives the tokenizer's own ids for a text of such words.
        """
        if self._plain is None:
            from tokenizers import Tokenizer, pre_tokenizers

            lean = Tokenizer(self.tokenizer.model)
            lean.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            letters = [chr(i) for i in range(ord("a"), ord("z") + 1)]
            probe = " ".join([*letters, *(a + b + c for a in letters for b in letters for c in "aens")])
            one, two = (
                t.encode(probe, add_special_tokens=False).ids for t in (lean, self.tokenizer)
            )
            self._plain = lean if one == two else self.tokenizer
        return self._plain

    def _encode_words(self, new: list[str], tokenizer) -> None:
        if not new:
            return
        [found] = tokenizer.encode_batch_fast([" ".join(new)], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        at = np.flatnonzero(self.ends[ids]) + 1
        if len(at) == len(new):
            raw, begins = ids.tobytes(), [0, *(4 * at).tolist()]
            for word, i, j in zip(new, begins, begins[1:], strict=False):
                self[word.encode()] = raw[i:j]

    def _vocabulary(self) -> list[str]:
        n = self.tokenizer.get_vocab_size(with_added_tokens=True)
        return [self.tokenizer.id_to_token(i) or "" for i in range(n)]

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, as the tokenizer encodes the whole text.

        It drops white space and merges nothing across it, so words can be encoded one by one,
        except where the string of an added token, which it looks for first, may be in the text.
        Arrow splits and numbers the words of the batch, each distinct one is looked up once, and
        numpy gathers their ids.
        """
        if len(self) >= _REMEMBERED:  # words still in use move on from the old generation
            self.old = dict(self)
            self.clear()
        texts = texts.cast(pa.large_string()).fill_null("")
        lists = pc.ascii_split_whitespace(texts)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        numbered = pc.dictionary_encode(lists.flatten())
        words = numbered.dictionary.cast(pa.large_binary())
        data = b"" if words.buffers()[2] is None else words.buffers()[2].to_pybytes()
        at = np.frombuffer(words.buffers()[1], "<i8")[words.offset : words.offset + len(words) + 1]
        known = [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        if self.mark:
            self.learn({w for w in known if w not in self})
        found = [self[w] for w in known]
        sizes = np.array([len(b) >> 2 for b in found], "int64")
        flat = np.frombuffer(b"".join(found), "<u4")
        which = numbered.indices.to_numpy(zero_copy_only=False).astype("int64")
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        starts = (np.cumsum(sizes) - sizes)[which] - (ends - lengths)
        ids = flat[np.repeat(starts, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        special = np.zeros(len(texts), bool)
        for s in self.special:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        return [
            np.frombuffer(self._ids(texts[i].as_py()), "<u4") if special[i] else ids[a:b]
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))
        ]


def tokenize_pieces(
    docs: DataFrame,
    vocabulary: str,
    text: str = "text",
    key: str = "doc_id",
    *,
    capacity: int = 2048,
    separator: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    A document is its ids and then ``separator``; only one of more than ``capacity`` tokens is
    cut, into full pieces and a rest. A null or empty text is the separator alone. ``vocabulary``
    is the path of a tokenizer file on every executor; it must split at white space. Whether it lowers
    letters and parts ``.`` and ``,`` from them is tried, not assumed.
    """
    rows = columns(docs, doc_id=key, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))

    def cut(batches):
        words = kept_in_stage(f"words {vocabulary}", lambda: _Words(vocabulary))
        for batch in text_slices(batches, 1):
            out: dict[str, list] = {
                c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
            }
            encoded = words.encode_all(batch.column(1))
            for doc, found in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids = np.append(found, np.uint32(separator))
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    out["doc_id"].append(doc)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(len(part))
                    out["ids_crc32"].append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        out["ids"].append(part.astype("int32"))
            kinds = {"piece": pa.int32(), "ids": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_pydict(
                {
                    c: pa.array(v, kinds.get(c, pa.int64()))
                    for c, v in out.items()
                    if with_ids or c != "ids"
                }
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(cut, schema + ", ids array<int>" * with_ids)


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size. The largest goes first, each into the fullest bin that fits.

    Open bins are kept by their room; a number whose bits tell which rooms occur finds the
    smallest room that is large enough.
    """
    bins, offsets = np.zeros(len(sizes), "int64"), np.zeros(len(sizes), "int64")
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = used = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen, used = capacity, used, used + 1
        bins[i], offsets[i] = chosen, capacity - room
        if room > size:
            open_bins[room - size].append(chosen)
            rooms |= 1 << (room - size)
    return bins, offsets


def lower_bound(
    sizes: np.ndarray, counts: np.ndarray | None = None, *, capacity: int
) -> int:
    """A number of bins that no packing goes below, for ``sizes``, each ``counts`` times.

    The largest bound of three families of dual feasible functions, each over its parameters:
    the identity (total size); sizes above ``capacity - k`` count whole, those below ``k`` not at
    all; and sizes rounded down to multiples of ``capacity / (k + 1)``, in k-ths.
    """
    weights = np.ones(len(sizes)) if counts is None else counts
    counts = np.bincount(sizes, weights=weights, minlength=capacity + 1).astype("int64")
    size = np.arange(capacity + 1)
    above = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])
    totals = np.concatenate([[0], np.cumsum(counts * size)])
    best = -(-int(totals[-1]) // capacity)
    for k in range(1, capacity // 2 + 1):
        whole = int(above[capacity - k + 1])
        rest = int(totals[capacity - k + 1] - totals[k])
        best = max(best, whole + -(-rest // capacity))
    for k in range(1, 33):
        scaled = size * (k + 1)
        exact = scaled % capacity == 0
        value = np.where(exact, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (capacity * k)))
    return best


def _pack_partition(capacity: int):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "item"], ascending=[False, True])
        sizes = frame["length"].to_numpy()
        bins, offsets = best_fit_decreasing(sizes, capacity)
        filled = np.bincount(bins, weights=sizes)
        return pd.DataFrame(
            {
                "item": frame["item"].to_numpy(),
                "length": sizes,
                "part": frame["part"].to_numpy(),
                "bin": bins,
                "offset": offsets,
                "room": (capacity - filled[bins]).astype("int64"),
                "used": int(bins.max()) + 1,
                "bound": lower_bound(sizes, capacity=capacity),
            }
        )

    return pack


def pack(pieces: DataFrame, *, capacity: int = 2048, items: int = 50_000) -> DataFrame:
    """``pieces`` with ``sequence_id``, ``offset``, its place, gapless from 0, and ``gap``: how many
    sequences its partition used above its lower bound, so 0 where it is certified.

    Takes what ``tokenize_pieces`` gives, or any rows with a ``length`` from 1 to ``capacity``.
    A partition packs about ``items`` pieces, dealt by a hash, and tells the sequences it used
    and its lower bound. A round whose partitions together use no more than the bound of all
    their pieces is certified as a whole and ends the packing. Else each partition, certified or
    not, gives up what could still be better: one that uses more than its bound all sequences
    with room, and, if the partitions' bounds add up to more than that of the whole, the others
    too. The pieces in these are dealt to as many partitions as they need and packed again.
    A round that needs as many sequences as were given up is undone and ends the packing, so each
    other round saves at least one; a single partition that took all ends it too. No pieces give
    no rows.
    """
    numbered = written(pieces.withColumn("item", F.monotonically_increasing_id()))
    placed = numbered.where(F.col("length") >= capacity).select(
        "item",
        (F.col("item") * 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(0).cast("long").alias("gap"),
    )
    left = numbered.where(F.col("length") < capacity).select("item", "length")
    schema = "item long, length long, part long, bin long, offset long, room long, used long, bound long"
    given_up, given = None, 0  # rows with their places in the round before, and their sequences
    turn = before = 0
    while n := left.count():
        parts = max(1, -(-n // items))
        dealt = left.withColumn(
            "part", F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(parts)).cast("long")
        )
        packed = written(dealt.groupBy("part").applyInPandas(_pack_partition(capacity), schema))
        told = packed.groupBy("part").agg(F.max("used").alias("used"), F.max("bound").alias("bound"))
        used, bounds = told.agg(F.sum("used"), F.sum("bound")).first()
        if given_up is not None and used >= given:
            placed = placed.unionByName(given_up)
            break
        sizes = left.groupBy("length").count().collect()  # at most one row for each length
        whole = lower_bound(*(np.array(x) for x in zip(*sizes, strict=True)), capacity=capacity)
        last = parts == 1 or used <= whole
        open_gap = F.lit(bounds > whole) | (F.col("used") > F.col("bound"))
        marked = packed.withColumn("again", F.lit(not last) & (F.col("room") > 0) & open_gap)
        number = F.lit(before) + F.col("part") * (items * 8) + F.col("bin")
        gap = F.lit(0).cast("long") if used <= whole else F.col("used") - F.col("bound")
        places = ["item", (number * 2 + 1).alias("sequence_id"), "offset", gap.alias("gap")]
        placed = placed.unionByName(marked.where(~F.col("again")).select(places))
        if last:
            break
        again = marked.where("again")
        given_up = again.select(places)
        given = again.where("offset = 0").count()  # one piece of each sequence lies at 0
        left = again.select("item", "length")
        before += parts * items * 8
        turn += 1
    return numbered.join(placed, "item").drop("item")


def pack_documents(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id",
                   *, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset, gap``.

    Repeated rows are packed each. A null ``doc_id`` is kept.
    """
    pieces = tokenize_pieces(docs, vocabulary, text, key, capacity=capacity, with_ids=with_ids)
    return pack(pieces, capacity=capacity)
