"""Document fingerprints by locally consistent parsing.

A text's UTF-8 bytes are parsed into phrases level by level.  Runs of one symbol
collapse first, so that neighbours differ; deterministic coin tossing (Cole and
Vishkin) then reduces each symbol to a label below 8 from its few predecessors, and
the local maxima of the labels begin phrases.  A phrase is named by a hash of its
symbols, and the names are the symbols of the next level.  A phrase's borders depend
only on a bounded neighbourhood, so equal substrings have equal phrases inside,
wherever they stand.

The fingerprint has ``BINS`` one-permutation MinHash bins for each of levels 2 to 4
(phrases of about 7, 17 and 40 bytes); the likeness of two fingerprints is the share
of equal bins among those that are filled in either.

At scale: parsing is vectorised over many texts, about a megabyte at a time.  The
edited text of a document needs the next document: texts are dealt out by ranges of
the id and streamed in order, so each is shuffled once, and only the rows at the edges
of partitions meet in a second, small step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage

#: MinHash bins of levels 2, 3 and 4; each is four hexadecimal digits, ``ffff`` if empty.
BINS = (16, 24, 24)
_EMPTY = 0xFFFF
_PIECE = 1 << 20
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = x + _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _coin_table(n: int) -> np.ndarray:
    """One round of coin tossing for all pairs (symbol, predecessor) below ``n``: twice the
    lowest differing bit plus the symbol's bit there; equal pairs give the symbol's low bit."""
    a, b = np.meshgrid(np.arange(n), np.arange(n), indexing="ij")
    low = (a ^ b) & -(a ^ b)
    pos = np.where(low > 0, np.log2(np.maximum(low, 1)).astype(int), 0)
    return (2 * pos + (a >> pos & 1)).astype(np.uint8).ravel()


_BYTES, _COIN = _coin_table(256), _coin_table(128)
_NAMES = _mix(np.arange(256, dtype=np.uint64))
_POWERS = _mix(np.arange(64, dtype=np.uint64)) | np.uint64(1)


def _shifted(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each symbol's predecessor; a text's first symbol has its complement."""
    prev = np.empty_like(x)
    prev[1:] = x[:-1]
    prev[starts] = ~x[starts]
    return prev


def _labels(sym: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Labels below 8 whose neighbours differ (but perhaps the first two of a text)."""
    prev = _shifted(sym, starts)
    if sym.dtype == np.uint8:
        lab = _BYTES[sym.astype(np.uint16) << np.uint16(8) | prev]
    else:
        x = sym ^ prev
        pos = np.bitwise_count((x & -x) - np.uint64(1)).astype(np.uint64)
        pos &= np.uint64(63)
        lab = (pos.astype(np.uint8) << np.uint8(1)) | (sym >> pos & np.uint64(1)).astype(np.uint8)
    for _ in range(2 if sym.dtype == np.uint8 else 3):
        before = np.empty_like(lab)
        before[1:] = lab[:-1]
        before[starts] = 127 - lab[starts]
        lab = _COIN[lab.astype(np.uint16) << np.uint16(7) | before]
    return lab


def level_up(sym: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the phrases of texts (``starts``: index of each text's first symbol; no
    text is empty), the texts' first phrases, and the index of each phrase's first symbol."""
    n = len(sym)
    keep = np.empty(n, bool)
    keep[0] = True
    np.not_equal(sym[1:], sym[:-1], out=keep[1:])
    keep[starts] = True
    at = np.flatnonzero(keep).astype(np.int32)
    one, first = sym[at], np.searchsorted(at, starts)
    lab = _labels(one, first)
    m = len(one)
    begin = np.zeros(m, bool)
    if m > 2:
        begin[1:-1] = (lab[1:-1] > lab[:-2]) & (lab[1:-1] >= lab[2:])
    begin[first] = True
    inner = first[1:] - 1  # a text's last symbol never compares with the next text's first
    begin[inner] = np.isin(inner, first)
    heads = np.flatnonzero(begin)
    size = np.empty_like(heads)
    np.subtract(heads[1:], heads[:-1], out=size[:-1])
    size[-1] = m - heads[-1]
    offset = (np.arange(m, dtype=np.int32) - np.repeat(heads.astype(np.int32), size)) & np.int32(63)
    value = _NAMES[one] if one.dtype == np.uint8 else _mix(one)
    if m < n:
        runs = np.empty_like(at)
        np.subtract(at[1:], at[:-1], out=runs[:-1])
        runs[-1] = n - at[-1]
        longer = np.flatnonzero(runs > 1)
        value[longer] = _mix(value[longer] + runs[longer].astype(np.uint64))
    names = _mix(np.add.reduceat(value * _POWERS[offset], heads) + size.astype(np.uint64))
    return names, np.searchsorted(heads, first), at[heads]


def _sketch(texts: list[bytes], out: np.ndarray) -> None:
    """MinHash bins of non-empty texts into the rows of ``out``."""
    sym = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]).astype(np.int64)
    at, column = starts, 0
    for level in range(1, 5):
        sym, at, _ = level_up(sym, at)
        if level == 1:
            continue
        bins = BINS[level - 2]
        row = np.repeat(np.arange(len(texts)), np.diff(at, append=len(sym)))
        h = _mix(sym ^ np.uint64(level))
        least = np.full(len(texts) * bins, np.iinfo(np.int64).max, np.int64)
        np.minimum.at(least, row * bins + (h % np.uint64(bins)).astype(np.int64), (h >> np.uint64(8)).astype(np.int64))
        value = np.where(least == np.iinfo(np.int64).max, _EMPTY, least % _EMPTY)
        out[:, column:column + bins] = value.reshape(len(texts), bins)
        column += bins


def sketches(texts: list[bytes]) -> np.ndarray:
    """A row of bins (uint16) for each text; an empty text has empty bins only."""
    out = np.full((len(texts), sum(BINS)), _EMPTY, np.uint16)
    group: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if not t:
            continue
        group.append(i)
        size += len(t)
        if size >= _PIECE:
            _fill(texts, group, out)
            group, size = [], 0
    if group:
        _fill(texts, group, out)
    return out


def _fill(texts: list[bytes], group: list[int], out: np.ndarray) -> None:
    part = np.empty((len(group), sum(BINS)), np.uint16)
    _sketch([texts[i] for i in group], part)
    out[group] = part


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins among those filled in either (rows of bins); 1 if none is filled."""
    filled = (a != _EMPTY) | (b != _EMPTY)
    n = filled.sum(axis=1)
    return np.where(n == 0, 1.0, ((a == b) & filled).sum(axis=1) / np.maximum(n, 1))


def _hex(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows.astype(">u2")]


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)``, one row per row of ``df``; null counts as the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = _hex(sketches([(t or "").encode() for t in batch.column(1).to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_COLUMNS = [c.split()[0] for c in _RESULT.split(", ")]


def _compared(ids: list, texts: list[str], nexts: list[str]) -> list[pa.Array]:
    changed = [edited(t, n).encode() for t, n in zip(texts, nexts)]
    rows = sketches([t.encode() for t in texts])
    other = sketches(changed)
    follow = sketches([nexts[-1].encode()])
    return _columns(ids, texts, changed, rows, other, np.concatenate([rows[1:], follow]))


def _columns(ids, texts, changed, rows, other, follow) -> list[pa.Array]:
    return [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(c).hexdigest() for c in changed], pa.string()),
            pa.array(_hex(rows), pa.string()), pa.array(_hex(other), pa.string()),
            pa.array(likeness(rows, other)), pa.array(likeness(rows, follow))]


def edit_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (see ``edited``), where the next
    document is the next row by falling id (ties: by a hash of the text, then the text;
    rows without an id last) and follows the last row comes the first.

    ``n_chars`` counts code points, ``edited_sha256`` is over UTF-8; ``near_edited`` and
    ``near_next`` are the likeness of the fingerprint to the edited text's and to the next
    document's.  Null texts count as empty; two empty texts are alike (1).  One row alone
    follows itself.  An empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    dealt = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    blank = {c: None for c in _COLUMNS}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Finished rows, and at the edges of the partition its first text (kind 1) and its
        last row, which still needs its successor (kind 2)."""
        def edge(kind, part, doc, text):
            row = {"kind": kind, "part": part, "edge_id": doc, "edge_text": text, **blank}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("edge_id", pa.int64()), ("edge_text", pa.string()),
                            ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
        held: list[tuple] = []
        size, part = 0, None

        def done(to_go):
            ids, texts = [x[0] for x in to_go], [x[1] for x in to_go]
            cols = _compared(ids[:-1], texts[:-1], texts[1:])
            n = len(ids) - 1
            own = [pa.array([0] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
            return pa.RecordBatch.from_arrays(own + cols, schema=schema)

        for batch in batches:
            for doc, text, p in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                text = text.as_py()
                if part is None:
                    part = p.as_py()
                    yield edge(1, part, doc, text)
                held.append((doc, text))
                size += len(text)
                if size >= _PIECE and len(held) > 1:
                    yield done(held)
                    held, size = held[-1:], len(held[-1][1])
        if held:
            if len(held) > 1:
                yield done(held)
            yield edge(2, part, *held[-1])

    found = cut_lineage(dealt.mapInArrow(run, "kind int, part int, edge_id long, edge_text string, " + _RESULT))
    # one row a partition from here on
    firsts = found.filter("kind = 1").select("part", F.col("edge_text").alias("next_text"))
    parts = firsts.select("part")
    order = Window.orderBy("part")
    after = parts.select(F.col("part"), F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy())).alias("next_part"))
    lasts = found.filter("kind = 2").select("part", "edge_id", "edge_text").join(after, "part")
    pairs = lasts.join(firsts.withColumnRenamed("part", "next_part"), "next_part").select("edge_id", "edge_text", "next_text")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, following in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_arrays(_compared([doc], [text], [following]), _COLUMNS)

    return found.filter("kind = 0").select(*_COLUMNS).unionByName(pairs.mapInArrow(finish, _RESULT))
