"""Fill-in-the-middle transformation: texts are cut in three and put together in another order, reversibly.

All texts of an Arrow batch lie in one byte array. One scan finds the ends of
their tokens and so the cuts. The places where the shift from input to output
changes (the start of each text, its two cuts) form a difference array; its
running sum is the shift of every byte, and one scatter writes the outputs.
The way back finds the marks of an output, builds the same shifts and gathers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchback.llm.common import fresh_name, short_batches

#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Share of texts that are transformed, and of those the share in the order suffix, prefix, middle; in percent.
RATE, SPM = 50, 80
SEED = 42
#: Bytes of texts cut together; a longer text is a batch of its own, and shifts are summed over windows of as many.
BATCH_BYTES = 1 << 22
CUT = "n long, prefix_chars long, middle_chars long, output binary"

_MARK = len(PREFIX)


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers a document; a null doc_id is hashed as no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def form_of(text: Column, doc_id: Column, rate: int = RATE, spm: int = SPM, seed: int = SEED) -> Column:
    """``plain``, ``spm`` or ``psm``; empty texts and those that hold a mark stay plain."""
    text = F.coalesce(text, F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | text.contains(mark.decode())
    _, _, h3, h4 = draws(doc_id, seed)
    return F.when((text == "") | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm, "spm").otherwise("psm")


def _is_white(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _move(source: np.ndarray, out: np.ndarray, at: np.ndarray, shift: np.ndarray, scatter: bool) -> None:
    """Copies every byte by the shift that holds from the last place in ``at`` on, which starts at 0; places may repeat.

    ``scatter``: ``source[i]`` goes to ``out[i + shift]``; otherwise ``out[i]`` comes from ``source[i + shift]``.
    """
    n = len(source) if scatter else len(out)
    step = np.diff(shift, prepend=0)
    total = 0
    for start in range(0, n, BATCH_BYTES):
        stop = min(n, start + BATCH_BYTES)
        first, last = np.searchsorted(at, (start, stop))
        change = np.zeros(stop - start, np.int64)
        np.add.at(change, at[first:last] - start, step[first:last])
        change[0] += total
        place = np.cumsum(change)
        total = int(place[-1])
        place += np.arange(start, stop)
        if scatter:
            out[place] = source[start:stop]
        else:
            out[start:stop] = source[place]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and where each text starts, with the end of the last."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer(b"".join(texts), np.uint8), bounds


def _put(out: np.ndarray, at: np.ndarray, mark: bytes) -> None:
    for j, sign in enumerate(mark):
        out[at + j] = sign


def cut_batch(texts: list[bytes], forms: list[str], h1: list[int], h2: list[int]) -> list[tuple]:
    """The columns of CUT for each text."""
    data, bounds = _joined(texts)
    start, stop = bounds[:-1], bounds[1:]
    white = _is_white(data)
    ends = ~white
    ends[:-1] &= white[1:]
    full = stop[stop > start]
    ends[full - 1] |= ~white[full - 1]  # a run of signs ends with its text
    ends = np.flatnonzero(ends) + 1
    low, high = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "right")
    trailing = np.zeros(len(texts), np.int64)
    trailing[stop > start] = white[full - 1]
    n = high - low + trailing

    def place(units: np.ndarray) -> np.ndarray:
        """Where so many units of a text end."""
        known = np.append(ends, 0)[np.minimum(low + units - 1, len(ends))]
        return np.where(units == 0, start, np.where(units > high - low, stop, known))

    moved = np.array([f != "plain" for f in forms], bool)
    spm = np.array([f == "spm" for f in forms], bool)
    a, b = (np.array(h, np.int64) % (n + 1) for h in (h1, h2))
    first, second = place(np.minimum(a, b)), place(np.maximum(a, b))

    out_bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(stop - start + np.where(moved, 3 * _MARK, 0), out=out_bounds[1:])
    out = np.empty(int(out_bounds[-1]), np.uint8)
    begin, tail = out_bounds[:-1], stop - second
    to_prefix = begin + np.where(spm, 2 * _MARK + tail, np.where(moved, _MARK, 0))
    to_suffix = begin + np.where(spm, _MARK, 2 * _MARK + first - start)
    to_middle = out_bounds[1:] - (second - first)
    shifts = np.stack([
        to_prefix - start, np.where(moved, to_middle - first, to_prefix - start), np.where(moved, to_suffix - second, to_prefix - start)
    ], 1).ravel()
    _move(data, out, np.stack([start, first, second], 1).ravel(), shifts, scatter=True)
    for mark, to in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        _put(out, to[moved] - _MARK, mark)

    def chars(x: int, y: int) -> int:
        return int(np.count_nonzero((data[x:y] & 0xC0) != 0x80))

    view = out.tobytes()
    return [
        (int(n[i]), chars(start[i], first[i]) if moved[i] else None, chars(first[i], second[i]) if moved[i] else None,
         view[out_bounds[i] : out_bounds[i + 1]])
        for i in range(len(texts))
    ]


def restore_batch(outputs: list[bytes], forms: list[str]) -> list[bytes]:
    """The texts behind ``outputs``: marks are found, and the inverse gather puts the parts back."""
    data, bounds = _joined(outputs)
    begin, finish = bounds[:-1], bounds[1:]
    moved = np.array([f != "plain" for f in forms], bool)
    spm = np.array([f == "spm" for f in forms], bool)
    # a text holds no mark itself, and none can begin in a text and end in a mark
    at = {m: np.array([o.find(m) if f != "plain" else 0 for o, f in zip(outputs, forms)], np.int64) + begin for m in (PREFIX, SUFFIX, MIDDLE)}
    from_prefix = np.where(moved, at[PREFIX] + _MARK, begin)
    from_suffix, from_middle = at[SUFFIX] + _MARK, at[MIDDLE] + _MARK
    prefix = np.where(moved, np.where(spm, at[MIDDLE], at[SUFFIX]) - from_prefix, finish - begin)
    middle = np.where(moved, finish - from_middle, 0)
    sizes = finish - begin - np.where(moved, 3 * _MARK, 0)
    text_bounds = np.zeros(len(outputs) + 1, np.int64)
    np.cumsum(sizes, out=text_bounds[1:])
    start = text_bounds[:-1]
    first = start + prefix
    second = first + middle
    shifts = np.stack([from_prefix - start, np.where(moved, from_middle - first, from_prefix - start), np.where(moved, from_suffix - second, from_prefix - start)], 1)
    out = np.empty(int(text_bounds[-1]), np.uint8)
    _move(data, out, np.stack([start, first, second], 1).ravel(), shifts.ravel(), scatter=False)
    view = out.tobytes()
    return [view[text_bounds[i] : text_bounds[i + 1]] for i in range(len(outputs))]


def _in_turns(texts: list[bytes], run) -> list:
    """``run(start, stop)`` over stretches of at most BATCH_BYTES, or of one longer text."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > BATCH_BYTES:
            out += run(start, i)
            start, size = i, 0
        size += len(t)
    return out + (run(start, len(texts)) if texts else [])


def _cut(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in CUT.split(", ")]
    for batch in batches:
        texts, forms, h1, h2 = (list(c) for c in batch)
        rows = _in_turns(texts, lambda i, j: cut_batch(texts[i:j], forms[i:j], h1[i:j], h2[i:j]))
        made = pd.DataFrame(rows, columns=names)
        yield made.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})


def _restore(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for outputs, forms in batches:
        outputs, forms = list(outputs), list(forms)
        yield pd.Series(_in_turns(outputs, lambda i, j: restore_batch(outputs[i:j], forms[i:j])), dtype=object)


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm: int = SPM, seed: int = SEED, out: str = "fim") -> DataFrame:
    """Every row of ``docs`` with a struct ``fim``: form, n (tokens), prefix_chars, middle_chars, output.

    A token is white space with the signs after it, or white space that ends
    the text; cuts lie after tokens. Null texts are empty and stay plain, as do
    texts that hold a mark; their numbers of characters are null. Rows that
    repeat a doc_id draw the same numbers. A column named as ``out`` is
    replaced, all others stay. Texts of any length a row can hold are cut
    whole, their shifts summed in windows; no shuffle.
    """
    made = fresh_name(docs, "made")
    text = F.coalesce("text", F.lit(""))
    form = form_of(F.col("text"), F.col("doc_id"), rate, spm, seed)
    h1, h2, _, _ = draws(F.col("doc_id"), seed)
    cut = short_batches(docs).withColumn(made, F.pandas_udf(_cut, CUT)(text.cast("binary"), form, h1, h2))
    parts = [F.col(f"`{made}`.{c}").alias(c) for c in ("n", "prefix_chars", "middle_chars")]
    struct = F.struct(form.alias("form"), *parts, F.col(f"`{made}`.output").cast("string").alias("output"))
    return cut.withColumn(out, struct).drop(made)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` of that form was made of."""
    return F.pandas_udf(_restore, "binary")(output.cast("binary"), form).cast("string")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
