"""Byte-level BPE over texts of any length, and back to bytes.

Long texts are cut into overlapping chunks that are pre-tokenised in parallel. Two neighbours
are stitched where both see a pre-token begin in their overlap: matches look only forward, so
from there on both agree with a pass over the whole text. The pieces between the stitches are
then encoded. Where an overlap has no common boundary, the piece simply runs on to the next one.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from insight.llm.shared import columns, text_slices

#: Characters past its end that a match may depend on: the longest literal of the pattern, and one.
_MARGIN = 4
#: Encoded pre-tokens that one Python worker remembers.
_REMEMBERED = 200_000
#: Parts of a text that are sent on in one batch.
_TOGETHER = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """The merge ranks of a vocabulary file: a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def boundaries(text: str, pattern, start: int = 0) -> list[int]:
    """Where pre-tokens begin, from ``start`` on."""
    return [m.start() for m in pattern.finditer(text, start)]


class _Encoder(dict):
    """Ids of pre-tokens as little-endian 32-bit integers, remembered up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.coding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )

    def __missing__(self, token: str) -> bytes:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[token] = ids = np.array(self.coding._encode_single_piece(token), "<u4").tobytes()
        return ids

    def encode(self, text: str, length: int) -> np.ndarray:
        """Ids of the pre-tokens that begin before ``length``."""
        if len(text) == length:
            return self.coding.encode_to_numpy(text, disallowed_special=())
        found: list[bytes] = []
        for m in self.pattern.finditer(text):
            if m.start() >= length:
                break
            found.append(self[m.group()])
        return np.frombuffer(b"".join(found), "<u4")


def _shared_encoder(spark: SparkSession, ranks: dict[bytes, int], pattern: str):
    """A function for tasks that builds the encoder once in each worker."""
    sent = spark.sparkContext.broadcast(ranks)
    made: list[_Encoder] = []

    def encoder() -> _Encoder:
        if not made:
            made.append(_Encoder(sent.value, pattern))
        return made[0]

    return encoder


def _cuts(groups: dict[int, tuple[list[int], list[int]]], chunk: int) -> list[int]:
    """Offsets where neighbouring chunks agree; 0 is always one.

    ``groups``: for each chunk, its boundaries in its first and in its last overlap, both as
    offsets in the text. The last list holds only those that are certain, the first those that
    the chunk sees without knowing what stands before it.
    """
    cuts = [0]
    for number in sorted(groups)[1:]:
        common = set(groups[number][0]).intersection(groups[number - 1][1])
        if common:
            cuts.append(min(common))
    return cuts


def _sliced(rows: DataFrame, spans) -> DataFrame:
    """``row, piece, start, part, n`` for each (start, length, end of the part) that ``spans``
    gives for a text, in one pass over it. ``rows``: ``row, text`` and what ``spans`` takes."""

    def cut(batches):
        for batch in text_slices(batches, 1):
            for i in range(batch.num_rows):
                row, text, *more = (c[i].as_py() for c in batch.columns)
                places = list(spans(text, *more))
                for at in range(0, len(places), _TOGETHER):
                    some = places[at : at + _TOGETHER]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "row": pa.array([row] * len(some), pa.string()),
                            "piece": pa.array(range(at, at + len(some)), pa.int32()),
                            "start": pa.array([s for s, _, _ in some], pa.int64()),
                            "part": pa.array([text[s:e] for s, _, e in some], pa.string()),
                            "n": pa.array([n for _, n, _ in some], pa.int64()),
                        }
                    )

    return rows.mapInArrow(cut, "row string, piece int, start long, part string, n long")


def _stitches(long: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``row`` and the offsets ``cuts`` of its pieces, for texts longer than a chunk."""

    def spans(text):
        return ((s, chunk, s + chunk + overlap) for s in range(0, len(text), chunk))

    chunks = _sliced(long.select("row", "text"), spans).select(
        "row", F.col("piece").alias("number"), "start", "part"
    )

    def pretokenise(batches):
        compiled = regex.compile(pattern)
        for batch in batches:
            rows, numbers, starts, parts = (c.to_pylist() for c in batch.columns)
            head, tail = [], []
            for start, part in zip(starts, parts, strict=True):
                at = boundaries(part, compiled)
                sure = len(part) - _MARGIN
                head.append([start + b for b in at if b <= overlap])
                tail.append([start + b for b in at if chunk <= b <= sure])
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.array(rows, pa.string()),
                    "number": pa.array(numbers, pa.int32()),
                    "head": pa.array(head, pa.list_(pa.int64())),
                    "tail": pa.array(tail, pa.list_(pa.int64())),
                }
            )

    seen = chunks.repartition("row", "number").mapInArrow(
        pretokenise, "row string, number int, head array<long>, tail array<long>"
    )
    # One list for each text: its size is bounded by the text, which is itself one row.
    lists = seen.groupBy("row").agg(F.collect_list(F.struct("number", "head", "tail")).alias("seen"))

    def stitch(batches):
        for batch in batches:
            rows, seen_of = (c.to_pylist() for c in batch.columns)
            cuts = [
                _cuts({s["number"]: (s["head"], s["tail"]) for s in seen}, chunk)
                for seen in seen_of
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.array(rows, pa.string()),
                    "cuts": pa.array(cuts, pa.list_(pa.int64())),
                }
            )

    return lists.mapInArrow(stitch, "row string, cuts array<long>")


def _encoded(pieces: DataFrame, encoder) -> DataFrame:
    """The first two columns, and ``ids`` of ``part``'s pre-tokens that begin before ``n``."""
    first, second = pieces.schema[:2]

    def encode(batches):
        for batch in text_slices(batches, 2):
            coder = encoder()
            out = [
                coder.encode(p.as_py(), n)
                for p, n in zip(batch.column(2), batch.column(3).to_pylist(), strict=True)
            ]
            ends = np.cumsum([0, *map(len, out)]).astype("int32")
            values = np.concatenate([np.empty(0, "<u4"), *out]).view("<i4")
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), ids],
                names=[first.name, second.name, "ids"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in (first, second))
    return pieces.select(first.name, second.name, "part", "n").mapInArrow(
        encode, f"{kinds}, ids array<int>"
    )


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    key: str = "doc_id",
    *,
    chunk: int = 16_384,
    overlap: int = 512,
) -> DataFrame:
    """``key`` and ``ids`` (array<int>) of every row, as one pass over its whole text gives.

    ``ranks`` is a whole vocabulary, whose size does not depend on the input. Texts of up to
    ``chunk`` characters are encoded where they are read. Longer ones are cut into chunks of
    ``chunk + overlap`` characters, which are dealt to all tasks; their task holds one such text
    at a time. A match of ``pattern`` may depend on at most four characters past its end, as those
    of the usual patterns do; one that looks further may be cut. A null or empty text has no
    ids; null keys are kept. Repeated rows are repeated in the result.
    """
    if not 0 < 2 * _MARGIN < overlap <= chunk:
        raise ValueError("overlap must be larger than the margin and at most a chunk")
    rows = columns(docs, key=key, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    encoder = _shared_encoder(docs.sparkSession, ranks, pattern)
    short = rows.where(F.length("text") <= chunk).select(
        "key", F.lit(0).alias("piece"), F.col("text").alias("part"), F.length("text").alias("n")
    )
    whole = _encoded(short, encoder).select("key", "ids")

    long = rows.where(F.length("text") > chunk).withColumn(
        "row", F.concat_ws(":", F.col("key").cast("string"), F.xxhash64("text").cast("string"))
    )
    distinct = long.select("row", "text").dropDuplicates(["row"])
    cuts = _stitches(distinct, pattern, chunk, overlap)

    def spans(text, begins):
        ends = [*begins[1:], len(text)]
        return ((b, e - b, e + _MARGIN) for b, e in zip(begins, ends, strict=True))

    pieces = _sliced(distinct.join(cuts, "row").select("row", "text", "cuts"), spans).repartition(
        "row", "piece"
    )
    joined = (
        _encoded(pieces, encoder)
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("pieces"))
        .select("row", F.flatten("pieces.ids").alias("ids"))
    )
    copies = long.groupBy("row", "key").agg(F.count("*").alias("copies"))
    stitched = (
        joined.join(copies, "row")
        .select("key", "ids", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
        .select("key", "ids")
    )
    return whole.unionByName(stitched).withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """``encoded`` with ``bytes`` (binary), the tokens' raw bytes one after another, and
    ``id_bytes`` (binary), the ids as little-endian unsigned 32-bit integers.

    Null ids stay null. An id outside the vocabulary is an error.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(ranks)
    names = [c for c in encoded.columns if c not in ("bytes", "id_bytes")]
    chosen = encoded.select(*(F.col(f"`{c}`") for c in names))
    at = names.index(ids)

    def tokens_to_bytes(batches):
        table = [b""] * (max(sent.value.values(), default=-1) + 1)
        for token, rank in sent.value.items():
            table[rank] = token
        for batch in batches:
            raw, packed = [], []
            for value in batch.column(at):
                numbers = value.values
                packed.append(
                    None if numbers is None else numbers.to_numpy().astype("<u4").tobytes()
                )
                raw.append(
                    None
                    if numbers is None
                    else b"".join(map(table.__getitem__, numbers.to_numpy().tolist()))
                )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(raw, pa.binary()), pa.array(packed, pa.binary())],
                names=[*names, "bytes", "id_bytes"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema)
    return chosen.mapInArrow(tokens_to_bytes, f"{fields}, bytes binary, id_bytes binary")
