"""Secret scans: fixed patterns, and strings that a tokenizer's vocabulary can't shorten.

Random strings need many tokens for their characters; words and code need few.
Runs of base64-like characters whose characters-per-token ratio under a byte
BPE vocabulary is low are reported as ``random``, after known digests (hex of
usual digest lengths) and identifiers (words joined by ``_ - . /``, UUIDs,
numbers, hosts, paths) are excluded. What base spans leave of a run is tested as
a whole, then by its parts between ``/ = .``, then by theirs between ``_ -``, so
that words joined to a random string don't hide it. Strings and parts of fewer
than ``min_run`` characters are not tested. Words of one case are identifiers only where the
vocabulary shortens them.

Defined cases: a null text is empty; an empty text has no spans; a null id is
returned as it is; repeated rows are scanned each; an empty table gives an empty
result. Texts are scanned whole. Other columns are ignored, whatever their names. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtone.llm.bytescan import points_before, runs, utf8
from dialtone.llm.common import pieces

# The base patterns.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    rb"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "random")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
TOKEN_PATTERN = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

HEX = np.zeros(256, dtype=bool)
HEX[[*b"0123456789abcdef"]] = True
OPAQUE = np.zeros(256, dtype=bool)
OPAQUE[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."]] = True

_DIGEST = re.compile(rb"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_UUID = re.compile(rb"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z")
#: Words (one case, or a capital first) and numbers joined by separators.
_NAMES = re.compile(rb"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)(?:[._/=+-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+))*\Z")
_ONE_CASE = re.compile(rb"[a-z]{16,}|[A-Z]{16,}")
_PART, _SMALL_PART = re.compile(rb"[^/=.]+"), re.compile(rb"[^/=._-]+")
_CAMEL = re.compile(rb"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}(?![a-z]))+[0-9]{0,4}\Z")


def _encoding(vocabulary: bytes):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
    return tiktoken.Encoding("own", pat_str=TOKEN_PATTERN, mergeable_ranks=ranks, special_tokens={})


def excluded(run: bytes, dense) -> bool:
    """Known digests and identifiers; ``dense`` tells strings that the vocabulary doesn't shorten."""
    if (len(run) in DIGEST_LENGTHS and _DIGEST.match(run)) or _UUID.match(run):
        return True
    return bool(_NAMES.match(run) or _CAMEL.match(run)) and not any(map(dense, _ONE_CASE.findall(run)))


def _pieces_outside(a: int, b: int, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The stretches of (a, b) that none of the ordered ``spans`` touches."""
    for s, e in spans:
        if s < b and e > a:
            if a < s:
                yield a, s
            a = max(a, e)
    if a < b:
        yield a, b


def _spans(text: bytes, hexes: list, opaque: list, ratio: float, encoding) -> list[tuple]:
    """(kind, start, end) in bytes; base spans by kind, random ones that touch no base span."""
    found = [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(2, a, b) for a, b in hexes]
    base = sorted((s, e) for _, s, e in found)

    def dense(run: bytes) -> bool:
        return len(run) < ratio * len(encoding.encode_ordinary(run.decode()))

    def random(a: int, b: int) -> tuple | None:
        run = text[a:b].strip(b".=-_/+")
        if len(run) < 16 or excluded(run, dense) or not dense(run):
            return None
        a += text[a:b].index(run)
        return 3, a, a + len(run)

    for start, end in opaque:
        for a, b in _pieces_outside(start, end, base) if base else ((start, end),):
            if b - a < 16:
                continue
            whole = random(a, b)
            if whole:
                found.append(whole)
            else:
                for m in _PART.finditer(text[a:b]):
                    part = random(a + m.start(), a + m.end())
                    small = [part] if part else [random(a + m.start() + x.start(), a + m.start() + x.end())
                                                 for x in _SMALL_PART.finditer(m[0])]
                    found += [x for x in small if x]
    return sorted(found, key=lambda x: (x[1], x[0], x[2]))


def scan_secrets(docs: DataFrame, vocabulary: str, max_ratio: float = 1.9, min_run: int = 16,
                 min_hex: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) of every row, ordered by start, then kind.

    ``vocabulary`` names a file of tiktoken ranks on the driver; its bytes (a
    fixed vocabulary, under a few MB) go to the executors with the task.
    """
    with open(vocabulary, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())
    name = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shipped.value)
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, offsets = utf8(piece.column(1))
                raw = data.tobytes()
                hexes = _by_row(*runs(HEX[data], offsets), min_hex, offsets)
                opaque = _by_row(*runs(OPAQUE[data], offsets), min_run, offsets)
                spans = []
                for i in range(len(offsets) - 1):
                    at, to = int(offsets[i]), int(offsets[i + 1])
                    own = _spans(raw[at:to], hexes.get(i, ()), opaque.get(i, ()), max_ratio, encoding)
                    if own:
                        edges = np.unique([x for _, s, e in own for x in (s, e)]) + at
                        points = dict(zip((edges - at).tolist(),
                                          points_before(data, edges, at).tolist()))
                        own = [{"kind": KINDS[k], "start": points[s], "end": points[e]}
                               for k, s, e in own]
                    spans.append(own)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(spans, type=_SPANS)], names=["id", "spans"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(scan, f"id {name}, spans array<struct<kind: string, start: bigint, end: bigint>>")
            .withColumnRenamed("id", id_col))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _by_row(starts: np.ndarray, ends: np.ndarray, least: int, offsets: np.ndarray) -> dict:
    """Row -> [(start, end)] in its own bytes, of the runs that are long enough."""
    keep = ends - starts >= least
    starts, ends = starts[keep], ends[keep]
    rows = np.searchsorted(offsets, starts, side="right") - 1
    out: dict[int, list] = {}
    for r, s, e in zip(rows.tolist(), (starts - offsets[rows]).tolist(), (ends - offsets[rows]).tolist()):
        out.setdefault(r, []).append((s, e))
    return out
