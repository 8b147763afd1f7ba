"""Fill-in-middle form of texts by block rotation in place.

A text is cut into units (runs of ASCII letters, or single other characters).  Two cuts
drawn from the document's key leave a prefix, a middle and a suffix.  Sentinels go into a
bytearray at the cuts, and neighbouring blocks change places by three reversals: each
block, then both together.  Undoing the rotation and taking the sentinels out gives the
text back exactly, from the output and its form alone.

Cases: a null text counts as empty; an empty text, one that holds a sentinel, and the
drawn share stay plain.  A null key draws like an empty one.  Repeated rows give equal
rows.  Texts of any length are taken whole; reversals swap bounded pieces.  Other columns
pass through, except those with the names of new columns, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.spans import byte_table, slices, text_bytes

_LETTER = byte_table(bytes(b for b in range(128) if chr(b).isalpha()))
#: Bytes swapped at once when a block is reversed.
SWAP = 1 << 16


@dataclass(frozen=True)
class Middles:
    """What decides cuts and forms: seed of the draws, shares in percent, the three sentinels."""

    seed: str = "1"
    plain: int = 10
    spm: int = 20
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def marks(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


def reverse(block: np.ndarray) -> None:
    """Reverse bytes in place, a bounded piece from either end at a time."""
    lo, hi = 0, len(block)
    while hi - lo > 1:
        n = min(SWAP, (hi - lo) // 2)
        left = block[lo : lo + n].copy()
        block[lo : lo + n] = block[hi - n : hi][::-1]
        block[hi - n : hi] = left[::-1]
        lo, hi = lo + n, hi - n


def rotate(block: np.ndarray, cut: int) -> None:
    """Let block[:cut] and block[cut:] change places, by three reversals."""
    reverse(block[:cut])
    reverse(block[cut:])
    reverse(block)


def arrange(raw: bytes, first: int, second: int, form: str, marks: tuple[bytes, bytes, bytes]) -> bytes:
    """The output for cuts at two byte offsets."""
    if form == "plain":
        return raw
    prefix, suffix, middle = marks
    out = bytearray(raw)
    out[second:second] = suffix
    out[first:first] = middle
    out[0:0] = prefix
    view = np.frombuffer(out, np.uint8)
    at_suffix = len(prefix) + second + len(middle)
    if form == "psm":
        start = len(prefix) + first
        rotate(view[start:], at_suffix - start)
    else:
        rotate(view, at_suffix)
    del view
    return bytes(out)


def rearrange(output: bytes, form: str, marks: tuple[bytes, bytes, bytes]) -> bytes:
    """The text of an output: the rotation undone, the sentinels taken out."""
    if form == "plain":
        return output
    prefix, suffix, middle = marks
    out = bytearray(output)
    view = np.frombuffer(out, np.uint8)
    if form == "psm":
        at_middle = output.index(suffix)
        moved = output.index(middle, at_middle + len(suffix)) - at_middle
        rotate(view[at_middle:], moved)
    else:
        moved = output.index(prefix)
        at_middle = output.index(middle, moved) - moved
        rotate(view, moved)
    del view
    at_suffix = len(out) - moved
    del out[at_suffix : at_suffix + len(suffix)]
    del out[at_middle : at_middle + len(middle)]
    del out[: len(prefix)]
    return bytes(out)


def _starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where units start, and each row's first unit (one past the last row too)."""
    letter = _LETTER[data]
    start = (data & 0xC0) != 0x80
    joined = letter.copy()
    joined[1:] &= letter[:-1]
    joined[:1] = False
    joined[offsets[:-1][offsets[:-1] < len(data)]] = False
    start &= ~joined
    at = np.flatnonzero(start)
    return at, np.searchsorted(at, offsets)


def _with_draws(df: DataFrame, key: str, seed: str) -> DataFrame:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return df.withColumns({f"__h{i}": F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)})


def to_middles(df: DataFrame, column: str = "text", key: str = "doc_id", how: Middles = Middles()) -> DataFrame:
    """Add n (units), form (plain, psm, spm), prefix_chars, middle_chars and output."""
    fields = [
        T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()),
    ]
    new = [f.name for f in fields]
    kept = [c for c in df.columns if c not in new]
    source = "__text"
    marks = how.marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = [np.asarray(batch.column(f"__h{i}")) for i in range(4)]
            data, offsets = text_bytes(batch.column(source))
            for lo, hi in slices(offsets):
                at = offsets[lo : hi + 1] - offsets[lo]
                part = data[offsets[lo] : offsets[hi]]
                starts, firsts = _starts(part, at)
                columns: list[list] = [[], [], [], [], []]
                for r in range(hi - lo):
                    begin, end = int(at[r]), int(at[r + 1])
                    n = int(firsts[r + 1] - firsts[r])
                    own = part[begin:end]
                    raw = own.tobytes()
                    h1, h2, h3, h4 = (int(d[lo + r]) for d in draws)
                    if not raw or any(m in raw for m in marks) or h3 % 100 >= 100 - how.plain:
                        row = (n, "plain", None, None, raw)
                    else:
                        form = "spm" if h4 % 100 < how.spm else "psm"
                        cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
                        first, second = (int(starts[firsts[r] + c]) - begin if c < n else end - begin for c in cuts)
                        chars = [int(np.count_nonzero((x & 0xC0) != 0x80)) for x in (own[:first], own[first:second])]
                        row = (n, form, *chars, arrange(raw, first, second, form, marks))
                    for values, value in zip(columns, row, strict=True):
                        values.append(value)
                arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())]
                arrays.append(pa.array(columns[4], pa.binary()).cast(pa.string()))
                piece = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([piece.column(c) for c in kept] + arrays, names=kept + new)

    drawn = _with_draws(df.select(*kept, F.col(column).alias(source)), key, how.seed)
    return drawn.mapInArrow(run, T.StructType([df.schema[c] for c in kept] + fields))


def from_middles(df: DataFrame, column: str = "output", form: str = "form", how: Middles = Middles()) -> DataFrame:
    """Replace the column of outputs by `restored`, their texts; null outputs give null."""
    kept = [c for c in df.columns if c not in (column, "restored")]
    marks = how.marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_bytes(batch.column(column))
            for lo, hi in slices(offsets):
                piece = batch.slice(lo, hi - lo)
                forms = piece.column(form).to_pylist()
                outputs = piece.column(column).cast(pa.binary()).to_pylist()
                texts = [None if o is None else rearrange(o, f, marks) for o, f in zip(outputs, forms, strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column(c) for c in kept] + [pa.array(texts, pa.binary()).cast(pa.string())], names=[*kept, "restored"])

    return df.mapInArrow(run, T.StructType([df.schema[c] for c in kept] + [T.StructField("restored", T.StringType())]))


def middles_query(docs: DataFrame) -> DataFrame:
    """Digests of every document's output and of the text rebuilt from it."""
    made = to_middles(docs.select("doc_id", "text"))
    made = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), "output")
    return from_middles(made).withColumn("restored_sha256", F.sha2("restored", 256)).drop("restored")
