"""Fill-in-the-middle transformation of texts.

A text is cut into units (a word with the white space before it; white space
at the end is a unit of its own). Two cuts, drawn from a hash of the id, part
the units into prefix, middle and suffix, which are written in an order and
with marks that let a model learn to fill the middle in.

Units have no index, so a text's bytes are taken in blocks of ``block`` bytes,
and two Fenwick trees over the blocks hold their counts of unit ends and of
code points. A binary-lifting descent finds the block of a cut with the counts
before it, and the cut itself is looked for in that block alone. Counts are
made in windows, so a very long text needs its own bytes, its output and a
window.

Defined results: null text is empty; an empty text, a text that holds a mark,
and a share of the others stay plain (no lengths, output equals the text); a
null id hashes like an empty one; every input row gives one row, repeated rows
included; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.llm.common import _SPACE, let, string_buffers, table

BLOCK = 4096
WINDOW_BLOCKS = 1024
FLUSH_BYTES = 1 << 22
PLAIN, PSM, SPM = "plain", "psm", "spm"


class Marks(NamedTuple):
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def fenwick(counts: np.ndarray) -> list[int]:
    """Entry i (from 1) holds the sum of the counts (i - lowest bit of i, i]."""
    upto = np.concatenate([[0], np.cumsum(counts)])
    i = np.arange(len(upto))
    return (upto - upto[i - (i & -i)]).tolist()


def descend(units: list[int], points: list[int], wanted: int) -> tuple[int, int, int]:
    """The block that holds unit end number ``wanted`` (from 1), and the unit
    ends and code points of all blocks before it."""
    at = u = p = 0
    step = 1 << (len(units).bit_length() - 1)
    while step:
        to = at + step
        if to < len(units) and u + units[to] < wanted:
            at, u, p = to, u + units[to], p + points[to]
        step >>= 1
    return at, u, p


class Units:
    """Unit ends and code points of one text (UTF-8 bytes)."""

    def __init__(self, raw: np.ndarray, block: int = BLOCK):
        self.raw, self.block = raw, block
        ends, firsts = [], []
        span = block * WINDOW_BLOCKS
        for a in range(0, len(raw), span):
            e, f = self._marks(a, min(a + span, len(raw)))
            at = np.arange(0, len(e), block)
            ends.append(np.add.reduceat(e, at, dtype=np.int64))
            firsts.append(np.add.reduceat(f, at, dtype=np.int64))
        none = np.zeros(0, np.int64)
        ends, firsts = (np.concatenate(x) if x else none for x in (ends, firsts))
        self.n = int(ends.sum())
        self.units, self.points = fenwick(ends), fenwick(firsts)

    def _marks(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether each byte ends a unit, and whether it begins a code point."""
        own = self.raw[a:b]
        space = _SPACE[self.raw[a : b + 1]]
        ends = np.ones(len(own), bool)
        k = len(space) - 1  # the text's last byte ends a unit in any case
        ends[:k] = ~space[:k] & space[1:]
        return ends, (own & 0xC0) != 0x80

    def cut(self, wanted: int) -> tuple[int, int]:
        """Bytes and code points of the first ``wanted`` units."""
        if wanted == 0:
            return 0, 0
        block, u, p = descend(self.units, self.points, wanted)
        a = block * self.block
        ends, firsts = self._marks(a, min(a + self.block, len(self.raw)))
        size = int(np.flatnonzero(ends)[wanted - u - 1]) + 1
        return a + size, p + int(firsts[:size].sum())


def transform(raw: np.ndarray, digest: str, fim_percent: int, spm_percent: int, marks: tuple[bytes, bytes, bytes], block: int):
    """n, form, code points of prefix and middle (None: plain) and the output
    as a list of byte pieces. ``digest`` is 32 hexadecimal digits."""
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    own = Units(raw, block)
    text = memoryview(raw)
    whole = bytes(text)
    if not whole or any(m in whole for m in marks) or h[2] % 100 >= fim_percent:
        return own.n, PLAIN, None, None, [whole]
    low, high = sorted((h[0] % (own.n + 1), h[1] % (own.n + 1)))
    (a, p), (b, q) = own.cut(low), own.cut(high)
    prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
    to_prefix, to_suffix, to_middle = marks
    if h[3] % 100 < spm_percent:
        return own.n, SPM, p, q - p, [to_suffix, suffix, to_prefix, prefix, to_middle, middle]
    return own.n, PSM, p, q - p, [to_prefix, prefix, to_suffix, suffix, to_middle, middle]


def fill_in_middle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 42,
    fim_percent: int = 50,
    spm_percent: int = 80,
    marks: Marks = Marks(),
    block: int = BLOCK,
) -> DataFrame:
    """``id_col``, n (units), form, prefix_chars, middle_chars and output of
    every row."""
    if block < 1 or not all(marks) or len(set(marks)) < 3:
        raise ValueError("block must be positive and the marks three different texts")
    as_bytes = tuple(m.encode() for m in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = string_buffers(b.column("text"))
            digests = b.column("digest").to_pylist()
            rows, begin, held = [], 0, 0
            for i in range(b.num_rows):
                n, form, p, q, pieces = transform(
                    raw[offs[i] : offs[i + 1]], digests[i], fim_percent, spm_percent, as_bytes, block
                )
                rows.append((n, form, p, q, b"".join(pieces)))
                held += len(rows[-1][4])
                if held > FLUSH_BYTES or i == b.num_rows - 1:
                    cols = list(zip(*rows))
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [b.column("id").slice(begin, len(rows))]
                        + [pa.array(c, t) for c, t in zip(cols, kinds)]
                        + [pa.array(cols[4], pa.large_binary()).view(pa.large_string())],
                        names=["id", "n", "form", "prefix_chars", "middle_chars", "output"],
                    )
                    rows, begin, held = [], i + 1, 0

    number = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), number), 256), 1, 32)
    own = df.select(F.col(id_col).alias("id"), digest.alias("digest"), F.col(text_col).alias("text"))
    schema = f"id {own.schema['id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"
    return own.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text of an output. A text that holds a mark is plain, and no mark
    begins inside another, so an output's marks are its own."""
    if any(a != b and (a.startswith(b[k:]) or b in a) for a in marks for b in marks for k in range(1, len(b))):
        raise ValueError("marks must not overlap")
    pattern = "|".join(re.escape(m) for m in marks)

    def rebuilt(parts: Column) -> Column:
        psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
        spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
        return F.when(form == PSM, psm).otherwise(spm)

    return F.when(form == PLAIN, output).otherwise(let(F.split(output, pattern, -1), rebuilt))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {"op11_fill_middle": op11_fill_middle}
ORACLES: dict[str, str] = {}
