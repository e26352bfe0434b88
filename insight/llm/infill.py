"""Fill-in-the-middle texts, cut where one match of the whole text says.

A text is a run of units: white space and the word after it, and at its end perhaps white space
alone. One full match of the repeated unit by the ``regex`` library keeps where every repetition
ended, so the number of units and both cuts are read off the match, without another pass.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.llm.shared import columns

SENTINELS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: The unit's alternatives exclude each other by their first characters after white space, so
#: nothing is ever given back, and the match keeps no states to return to.
UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")
_CUT = "n long, form string, prefix_chars long, middle_chars long"


def unit_ends(text: str) -> list[int]:
    """Where each unit of a text ends, in code points; the last is the text's length."""
    return UNITS.fullmatch(text).ends(1)


def draws(key: int | None, seed: int) -> list[int]:
    """Four numbers below 2**32 that depend on the seed and the key alone."""
    name = f"{seed}:{'' if key is None else key}"
    digest = hashlib.sha256(name.encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def cut(
    text: str, key: int | None, *, seed: int, rate: int, spm_rate: int, sentinels: tuple[str, ...]
) -> tuple[int, str, int | None, int | None]:
    """Number of units, form, and the lengths of prefix and middle, null if the form is plain."""
    ends = unit_ends(text)
    n = len(ends)
    one, two, whether, which = draws(key, seed)
    if not text or whether % 100 >= rate or any(s in text for s in sentinels):
        return n, PLAIN, None, None
    low, high = sorted((one % (n + 1), two % (n + 1)))
    begin, end = (ends[i - 1] if i else 0 for i in (low, high))
    return n, SPM if which % 100 < spm_rate else PSM, begin, end - begin


def _check(sentinels: tuple[str, ...]) -> None:
    """Sentinels that can be found again wherever the text around them was cut: none begins as
    another, or itself, ends."""
    if len(sentinels) != 3 or len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    for a in sentinels:
        for b in sentinels:
            if any(a.endswith(b[:i]) for i in range(1, len(b))) or (a != b and a in b):
                raise ValueError(f"sentinel {b!r} could be found across the end of {a!r}")


def fill_in_middle(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    *,
    seed: int = 42,
    rate: int = 50,
    spm_rate: int = 80,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    ``rate`` percent of the documents are cut, of these ``spm_rate`` percent with the suffix
    first; all draws come from ``seed`` and the key, so a task that runs again draws the same. A
    null text counts as empty; an empty text, or one that holds a sentinel, stays plain. Rows with
    one key have the same draws, and rows without key those of an empty one. Repeated rows are
    repeated. The whole text is matched at once: a task holds the ends of one text's units besides
    its batch, about 50 bytes for each unit.
    """
    _check(sentinels)
    rows = columns(docs, doc_id=key, text=text).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )

    @F.arrow_udf(_CUT)
    def cuts(texts: pa.Array, keys: pa.Array) -> pa.Array:
        found = [
            cut(t.as_py(), k.as_py(), seed=seed, rate=rate, spm_rate=spm_rate, sentinels=sentinels)
            for t, k in zip(texts, keys, strict=True)
        ]
        n, form, prefix, middle = zip(*found, strict=True) if found else ((),) * 4
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(form, pa.string()),
             pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())],
            names=["n", "form", "prefix_chars", "middle_chars"],
        )

    first, second, third = map(F.lit, sentinels)
    begin = F.col("prefix_chars").cast("int")
    end = (F.col("prefix_chars") + F.col("middle_chars")).cast("int")
    prefix = F.substring("text", F.lit(1), begin)
    middle = F.substring("text", begin + 1, F.col("middle_chars").cast("int"))
    suffix = F.substring("text", end + 1, F.length("text"))
    output = (
        F.when(F.col("form") == PSM, F.concat(first, prefix, second, suffix, third, middle))
        .when(F.col("form") == SPM, F.concat(second, suffix, first, prefix, third, middle))
        .otherwise(F.col("text"))
    )
    return (
        rows.withColumn("cut", cuts("text", "doc_id"))
        .select("doc_id", "text", "cut.*")
        .select("doc_id", "n", "form", "prefix_chars", "middle_chars", output.alias("output"))
    )


def restore(
    output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS
) -> Column:
    """The text that a filled-in ``output`` was made of, from it and its form alone."""
    _check(sentinels)
    first, second, third = sentinels
    head = F.substring_index(output, third, 1)
    middle = F.substring_index(output, third, -1)

    def parts(outer: str, inner: str) -> tuple[Column, Column]:
        """What stands after each of two sentinels, of which ``outer`` begins the text."""
        left = F.substring_index(head, inner, 1)
        return F.substring(left, F.lit(len(outer) + 1), F.length(left)), F.substring_index(head, inner, -1)

    prefix, suffix = parts(first, second)
    spm_suffix, spm_prefix = parts(second, first)
    return (
        F.when(form == PSM, F.concat(prefix, middle, suffix))
        .when(form == SPM, F.concat(spm_prefix, middle, spm_suffix))
        .otherwise(output)
    )
