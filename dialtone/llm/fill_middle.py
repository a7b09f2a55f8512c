"""Fill-in-middle transformation by block rotation inside a byte buffer.

A text is cut between two of its lines into prefix, middle and suffix. The cuts
are found by one scan for line feeds. The sentinels are inserted into a
bytearray of the text, and the segments change places there by rotations, each
of three reversals, so that no second copy of a text is built:

* ``psm``: ``<P>prefix<S>suffix<M>middle``, a rotation of the last two segments;
* ``spm``: ``<S>suffix<P>prefix<M>middle``, a rotation of the suffix to the front;
* ``plain``: the text as it is.

Restoring finds the sentinels, rotates back and takes them out: the bytes are
those of the text again. Cuts and form follow from a digest of the row's id
alone, so a task that runs twice writes the same.

Defined cases: a null text is empty; an empty text and a text that contains a
sentinel are ``plain``; rows with a null id are cut by the digest of an empty
id; rows that share an id and a text are equal; texts of any length are taken
whole; an empty table gives an empty result. Other columns are passed on; the
one struct that is added has a name of the caller's choice, and takes the place
of a column with that name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtone.llm.bytescan import utf8

#: Bytes that a reversal holds aside at once.
STRIP = 1 << 16

RESULT = "n bigint, form string, prefix_chars bigint, middle_chars bigint, text string"
_RESULT = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                     ("middle_chars", pa.int64()), ("text", pa.string())])


@dataclass(frozen=True)
class Marks:
    """The sentinels before prefix, suffix and middle. None may be a part of another."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        all_marks = (self.prefix, self.suffix, self.middle)
        if any(not a or (i != j and a in b) for i, a in enumerate(all_marks) for j, b in enumerate(all_marks)):
            raise ValueError("the sentinels must be three texts of which none holds another")
        if any(a.endswith(b[:k]) for a in all_marks for b in all_marks for k in range(1, len(b)) if (a, k) != (b, len(b))):
            raise ValueError("no sentinel may end with the beginning of one")

    def raw(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


def _reverse(view: np.ndarray, start: int, end: int) -> None:
    """Reverse ``view[start:end]`` in place, strip by strip from both ends."""
    while end - start > 1:
        k = min(STRIP, (end - start) // 2)
        head = view[start:start + k][::-1].copy()
        view[start:start + k] = view[end - k:end][::-1]
        view[end - k:end] = head
        start, end = start + k, end - k


def rotate(buffer: bytearray, start: int, mid: int, end: int) -> None:
    """Let the blocks ``[start, mid)`` and ``[mid, end)`` of ``buffer`` change places, in place."""
    view = np.frombuffer(buffer, dtype=np.uint8)
    _reverse(view, start, mid)
    _reverse(view, mid, end)
    _reverse(view, start, end)


def rearrange(buffer: bytearray, first: int, second: int, form: str, marks: Marks = Marks()) -> None:
    """Bring the text in ``buffer``, cut at the bytes ``first`` <= ``second``, into ``form``."""
    if form == "plain":
        return
    p, s, m = marks.raw()
    buffer[second:second] = s
    buffer[first:first] = m
    buffer[:0] = p
    at_middle = len(p) + first
    at_suffix = at_middle + len(m) + second - first
    rotate(buffer, at_middle if form == "psm" else 0, at_suffix, len(buffer))


def restore(buffer: bytearray, form: str, marks: Marks = Marks()) -> None:
    """Bring a text that :func:`rearrange` has brought into ``form`` back."""
    if form == "plain":
        return
    p, s, m = marks.raw()
    at_suffix = buffer.find(s)
    block = buffer.find(m if form == "psm" else p)  # what the suffix was rotated before
    if at_suffix < 0 or block < at_suffix:
        raise ValueError(f"the text is not in the form {form}")
    rotate(buffer, at_suffix, block, len(buffer))
    for mark in (s, m, p):  # from the last to the first
        at = buffer.rfind(mark)
        del buffer[at:at + len(mark)]


def _points(raw: np.ndarray) -> int:
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def _transform(fim_percent: int, spm_percent: int, marks: Marks):
    @F.arrow_udf(returnType=RESULT)
    def run(text: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        data, at = utf8(text)
        draws = np.stack([np.asarray(h) for h in (h1, h2, h3, h4)])
        counts, forms, prefixes, middles, texts = [], [], [], [], []
        for r in range(len(at) - 1):
            raw = data[at[r]:at[r + 1]]
            buffer = bytearray(raw)
            ends = np.flatnonzero(raw == 10) + 1  # where each unit ends
            if len(raw) and (not len(ends) or ends[-1] < len(raw)):
                ends = np.append(ends, len(raw))
            n = len(ends)
            counts.append(n)
            if not len(raw) or any(buffer.find(x) >= 0 for x in marks.raw()) or draws[2, r] % 100 >= fim_percent:
                form, first, second = "plain", 0, 0
                prefixes.append(None)
                middles.append(None)
            else:
                form = "spm" if draws[3, r] % 100 < spm_percent else "psm"
                a, b = sorted((int(draws[0, r]) % (n + 1), int(draws[1, r]) % (n + 1)))
                first, second = (int(ends[k - 1]) if k else 0 for k in (a, b))
                prefixes.append(_points(raw[:first]))
                middles.append(_points(raw[first:second]))
            rearrange(buffer, first, second, form, marks)
            forms.append(form)
            texts.append(bytes(buffer))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()),
             pa.array(middles, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())], fields=list(_RESULT))

    return run


def draws(id_: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the digest of ``seed:id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "fim", seed: int = 7,
                fim_percent: int = 100, spm_percent: int = 50, marks: Marks = Marks()) -> DataFrame:
    """``docs`` with a struct ``name``: n (lines), form, prefix_chars, middle_chars (null if plain), text.

    ``fim_percent`` of the rows are transformed, ``spm_percent`` of these with the suffix in front.
    """
    run = _transform(fim_percent, spm_percent, marks)
    done = run(F.coalesce(F.col(text_col), F.lit("")), *draws(F.col(id_col), seed))
    return docs.withColumn(name, done)


def restored(text: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that ``text`` was before it was brought into ``form``."""

    @F.arrow_udf(returnType="string")
    def run(texts: pa.Array, forms: pa.Array) -> pa.Array:
        data, at = utf8(texts)
        out = []
        for r, form in enumerate(forms.to_pylist()):
            buffer = bytearray(data[at[r]:at[r + 1]])
            restore(buffer, form, marks)
            out.append(bytes(buffer))
        return pa.array(out, pa.binary()).cast(pa.string())

    return run(text, form)
