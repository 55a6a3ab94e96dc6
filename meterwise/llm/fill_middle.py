"""Fill-in-the-middle: documents cut into prefix, middle and suffix, and put in another order.

A batch of texts is one run of bytes. One scan finds the ends of all units; the units that
a document's hash names are its cuts. What lies between two cuts moves as one piece, so
every byte's way to its place in the output is a shift that changes at cuts only: the
changes are written into a difference array, their cumulative sum is the shift of every
byte, and one scatter builds all outputs of the batch. The way back finds the markers in
the outputs, builds the same shifts, and gathers.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwise.llm.common import as_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The markers of the parts, and the names of the forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"])
# Of 100 documents, those that are transformed, and of 100 of these, those in SPM order.
RATE, SPM_RATE = 50, 80
SEED = 42

# Bytes of texts that are worked on at once; a longer text is a run of its own. What a worker
# holds is some fifteen times this, and an executor has a worker per core and step.
RUN = 1 << 18

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

COLUMNS = (
    "doc_id BIGINT, n BIGINT, form STRING, prefix_chars BIGINT, middle_chars BIGINT, output BINARY"
)


class Recipe(NamedTuple):
    """How documents are transformed; hashes decide, so a document is always cut alike."""

    seed: int = SEED
    rate: int = RATE
    spm_rate: int = SPM_RATE


def draws(ids: list[int | None], seed: int) -> np.ndarray:
    """Four unsigned 32-bit numbers per id: the first digits of a SHA-256."""
    digests = [
        hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids
    ]
    return np.frombuffer(b"".join(digests), ">u4").astype(np.int64).reshape(-1, 4)


def unit_ends(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the units of all texts end, in order: a unit is a word with the blanks before
    it, or the blanks at the end of a text. `starts` has the end of the last text too."""
    blank = BLANK[data]
    ends = np.empty(len(data), bool)
    ends[:-1] = ~blank[:-1] & blank[1:]
    ends[starts[1:][starts[1:] > starts[:-1]] - 1] = True
    return np.flatnonzero(ends) + 1


def found(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Where a marker starts."""
    if len(data) < MARK:
        return np.empty(0, np.int64)
    a, b, c = mark
    return np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c))


def holding(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which texts contain a marker."""
    at = np.concatenate([found(data, m) for m in (PREFIX, SUFFIX, MIDDLE)])
    text = np.searchsorted(starts, at, "right") - 1
    # Two neighbours may make up a marker that neither holds.
    text = text[at + MARK <= starts[text + 1]]
    held = np.zeros(len(starts) - 1, bool)
    held[text] = True
    return held


def shifts(size: int, at: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The shift of every byte: from each place in `at` on, the `value` beside it. Places
    do not go down; of equal ones the last counts. Offsets in an Arrow array of bytes have
    32 bits, and so have shifts; what a sum carries beyond them comes back."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, at, np.diff(value, prepend=0).astype(np.int32))
    return np.cumsum(change[:size], dtype=np.int32, out=change[:size])


def moved_by(shift: np.ndarray) -> np.ndarray:
    """Where every byte goes, or comes from; in place."""
    shift += np.arange(len(shift), dtype=np.int32)
    return shift


def layout(lengths: np.ndarray, form: np.ndarray) -> np.ndarray:
    """Where prefix, middle and suffix begin in the output of each document, and its size:
    `lengths` has their sizes, one row per document."""
    prefix, middle, suffix = lengths.T
    spm, plain = form == SPM, form == PLAIN
    at_prefix = np.where(plain, 0, np.where(spm, 2 * MARK + suffix, MARK))
    at_suffix = np.where(plain, prefix + middle, np.where(spm, MARK, 2 * MARK + prefix))
    at_middle = np.where(plain, prefix, 3 * MARK + prefix + suffix)
    size = prefix + middle + suffix + np.where(plain, 0, 3 * MARK)
    return np.stack([at_prefix, at_middle, at_suffix, size], axis=1)


def displacement(cuts: np.ndarray, places: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Per byte of the texts, how far it goes: `cuts` has the begin of the three parts of
    each text, `places` where they begin in its output, `starts` where the output begins."""
    return shifts(size, cuts.ravel(), (starts[:, None] + places - cuts).ravel())


def transformed(data: np.ndarray, starts: np.ndarray, ids: list, recipe: Recipe) -> tuple:
    """(n, form, code points of prefix and middle, outputs, where they begin)."""
    ends = unit_ends(data, starts)
    first = np.searchsorted(ends, starts, "right")
    n = np.diff(first)
    h = draws(ids, recipe.seed)
    plain = (n == 0) | (h[:, 2] % 100 >= recipe.rate) | holding(data, starts)
    form = np.where(plain, PLAIN, np.where(h[:, 3] % 100 < recipe.spm_rate, SPM, PSM))
    units = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    units[plain] = 0
    # The byte where so many units of a text end.
    ends = np.concatenate([[0], ends])
    where = np.where(units > 0, ends[first[:-1, None] + units], starts[:-1, None])
    bounds = np.column_stack([starts[:-1], where, starts[1:]])
    lengths = np.diff(bounds, axis=1)
    places = layout(lengths, form)
    out_starts = np.concatenate([[0], np.cumsum(places[:, 3])])
    shift = displacement(bounds[:, :3], places[:, :3], out_starts[:-1], len(data))
    output = np.empty(out_starts[-1], np.uint8)
    output[moved_by(shift)] = data
    moved = form != PLAIN
    for part, mark in enumerate((PREFIX, MIDDLE, SUFFIX)):
        at = out_starts[:-1][moved] + places[moved, part] - MARK
        for k in range(MARK):
            output[at + k] = mark[k]
    # Code points: bytes that do not continue one.
    points = np.zeros(len(data) + 1, np.int32)
    np.cumsum((data & 0xC0) != 0x80, dtype=np.int32, out=points[1:])
    chars = np.diff(points[bounds].astype(np.int64), axis=1)[:, :2]
    return n, form, chars, output, out_starts


def restored(data: np.ndarray, starts: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts, where they begin) from outputs and their forms alone."""
    moved = np.flatnonzero(form != PLAIN)
    bounds = np.zeros((len(form), 3), np.int64)
    for part, mark in enumerate((PREFIX, MIDDLE, SUFFIX)):
        at = found(data, mark)
        # Texts with markers of their own stay plain: each other output has one of a kind.
        text = np.searchsorted(starts, at, "right") - 1
        whole = (form[text] != PLAIN) & (at + MARK <= starts[text + 1])
        bounds[moved, part] = at[whole] + MARK
    p, m, s = bounds.T
    end = starts[1:]
    spm, plain = form == SPM, form == PLAIN
    lengths = np.stack([
        np.where(plain, 0, np.where(spm, m, s) - MARK - p),
        np.where(plain, 0, end - m),
        np.where(plain, end - starts[:-1], np.where(spm, p, m) - MARK - s),
    ], axis=1)
    # A plain text is all suffix.
    begin = np.where(plain[:, None], starts[:-1, None], bounds)
    text_starts = np.concatenate([[0], np.cumsum(lengths.sum(axis=1))])
    places = np.cumsum(lengths, axis=1) - lengths
    back = shifts(
        text_starts[-1], (text_starts[:-1, None] + places).ravel(),
        (begin - text_starts[:-1, None] - places).ravel(),
    )
    return data[moved_by(back)], text_starts


def runs(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, starts) of runs of texts without nulls."""
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.empty(0, np.uint8) if held is None else np.frombuffer(held, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + RUN, "right")) - 1
        high = min(max(high, low + 1), len(texts))
        starts = offsets[low : high + 1].astype(np.int64)
        yield low, high, data[starts[0] : starts[-1]], starts - starts[0]
        low = high


def as_array(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, buffers)


def fill_in_middle(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """COLUMNS of every row of `docs` (doc_id, text): the units of the text, the form it
    got, the code points of prefix and middle (null where plain), and the output in UTF-8.

    A null text is empty; an empty text, and one that holds a marker, stays as it is. Null
    and repeated ids keep a row each; a null id draws as an id of no digits. Other columns
    are ignored, an empty table gives an empty one. A text is never cut in a code point.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for low, high, data, starts in runs(batch.column("text")):
                here = ids.slice(low, high - low)
                n, form, chars, output, at = transformed(data, starts, here.to_pylist(), recipe)
                plain = form == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [here, pa.array(n), pa.array(FORMS[form].tolist()),
                     pa.array(chars[:, 0], mask=plain), pa.array(chars[:, 1], mask=plain),
                     as_array(output, at)],
                    [c.split()[0] for c in COLUMNS.split(", ")],
                )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), as_bytes().alias("text"))
    return source.mapInArrow(run, COLUMNS)


def restore(outputs: DataFrame) -> DataFrame:
    """`outputs` (form, output, any other columns but `restored`) with `restored`, the text
    in UTF-8, from form and output alone."""
    names = outputs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            form = np.array([FORMS.tolist().index(f) for f in batch.column("form").to_pylist()], int)
            for low, high, data, starts in runs(batch.column("output")):
                texts = as_array(*restored(data, starts, form[low:high]))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(low, high - low) for c in names), texts],
                    [*names, "restored"],
                )

    schema = T.StructType([*outputs.schema.fields, T.StructField("restored", T.BinaryType())])
    return outputs.mapInArrow(run, schema)
