"""SentencePiece encoding and decoding by a max-plus parallel scan.

A segmentation of a text into vocabulary pieces is scored by the sum of the pieces'
scores; the best one is found by dynamic programming in the max-plus semiring.  A
character that no piece has is written as its UTF-8 byte pieces at the price of an
unknown character.

*Parallel scan.*  A text of more than ``chunk`` characters is split into chunks.  The
state at a chunk's border is how many characters of the next chunk belong to a piece
that began before it (0 to K-1, K the longest piece).  Each chunk yields the transfer
matrix of best scores from its entry state to its exit state; matrices are combined
associatively, ``FAN`` neighbours at a time, up a tree; the best border states are
handed down the tree again; then every chunk is segmented for itself between its two
border states.  Chunks of one text are rows of their own throughout.

*Ties.*  Of the segmentations of best score the one is taken whose last piece is the
shortest, then whose last but one is, and so on.  A transfer matrix carries, beside the
scores, the order of the entry states by this rule for every exit state; the order is
combined with the scores, so a text's ids do not depend on where it is cut.  Scores are
rounded to multiples of 2**-20, so that their sums are exact (up to 2**33) in any order.

*Inside a chunk* no piece crosses a border between two characters that are neighbours
in no piece (such as the one before a space), so the chunk falls into short stretches,
whose best segmentations are remembered.  Only the first and last stretch meet border
states.

The vocabulary file's scores are taken as they are; a file whose type is BPE holds merge
ranks, and the result is then the segmentation of best total rank, not the merge order's.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, release, with_small

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 16_384
FAN = 64
_UNKNOWN = -10.0  # below the lowest score, for each unknown character
_SPACE = "▁"
_NO = float("-inf")
_GRAIN = 2.0 ** 20
_REMEMBER = 100_000


@dataclass
class Vocabulary:
    """``pieces``: text with plain spaces -> (id, score); ``bytes_at``: id of byte 0;
    ``text``: id -> the bytes it stands for; ``longest``: characters of the longest piece."""

    pieces: dict[str, tuple[int, float]]
    bytes_at: list[int]
    text: list[bytes]
    longest: int
    unknown: float
    _cut: re.Pattern | None = field(default=None, repr=False)
    _memo: dict = field(default_factory=dict, repr=False)
    _older: dict = field(default_factory=dict, repr=False)
    _score_of_id: np.ndarray | None = field(default=None, repr=False)
    _trie: dict = field(default_factory=dict, repr=False)  # beginnings of pieces: None, or (score, id as int32 bytes)

    def __getstate__(self):
        return {**self.__dict__, "_memo": {}, "_older": {}}

    @property
    def scores(self) -> np.ndarray:
        """Score by id; the bytes of an unknown character cost its price with the first byte
        (UTF-8's continuation bytes are free)."""
        out = np.zeros(len(self.text))
        for i, score in self.pieces.values():
            out[i] = score
        for byte, i in enumerate(self.bytes_at):
            out[i] = 0.0 if 0x80 <= byte < 0xC0 else self.unknown
        return out

    # ---- stretches ----

    def byte_ids(self, char: str) -> list[int]:
        return [self.bytes_at[b] for b in char.encode()]

    def steps(self, s: str, i: int, end: int) -> list[tuple[int, float, list[int]]]:
        """Pieces that begin at ``i``: (length, score, ids); a piece may end up to ``end``."""
        out = []
        for k in range(1, min(self.longest, end - i) + 1):
            found = self.pieces.get(s[i:i + k])
            if found is not None:
                out.append((k, found[1], [found[0]]))
        if not out or out[0][0] != 1:
            out.insert(0, (1, self.unknown, self.byte_ids(s[i])))
        return out

    def forward(self, s: str, entry: list[float], end: int) -> tuple[list[float], list]:
        """Best scores of reaching each position of ``s[:end]`` and of up to ``longest - 1``
        characters of look-ahead; ``entry[i]`` is the score of beginning at ``i``, one place only.
        Ties go to the shorter last piece, which comes later."""
        best = [_NO] * (len(s) + 1)
        best[:min(len(entry), len(s) + 1)] = entry[:len(s) + 1]
        back: list = [None] * (len(s) + 1)
        for i in range(end):
            here = best[i]
            if here == _NO:
                continue
            for k, score, ids in self.steps(s, i, len(s)):
                v = here + score
                if v >= best[i + k]:
                    best[i + k], back[i + k] = v, (k, ids)
        return best, back

    def segment(self, s: str) -> tuple[float, bytes]:
        """Score and ids (as int32 bytes) of the best segmentation of a text."""
        n, get = len(s), self._trie.get
        best, back = [0.0] + [_NO] * n, [None] * (n + 1)
        for i in range(n):
            here = best[i]
            step = get(s[i:i + 1], False)
            if not step:  # no piece has just this character
                v = here + self.unknown
                if v >= best[i + 1]:
                    best[i + 1], back[i + 1] = v, (1, np.array(self.byte_ids(s[i]), np.int32).tobytes())
                if step is False:
                    continue
            j = i
            while True:
                j += 1
                if step:
                    v = here + step[0]
                    if v >= best[j]:  # ties: the shorter last piece, which comes later
                        best[j], back[j] = v, (j - i, step[1])
                if j == n:
                    break
                step = get(s[i:j + 1], False)
                if step is False:
                    break
        ids = []
        while n:
            k, own = back[n]
            ids.append(own)
            n -= k
        return best[-1], b"".join(ids[::-1])

    def remembered(self, s: str) -> bytes:
        """Ids of a stretch that is not in the memory; short ones go there, in two generations."""
        got = self._older.get(s)
        if got is None:
            got = self.segment(s)[1]
        if len(s) <= 32:
            if len(self._memo) >= _REMEMBER:
                self._older, self._memo = self._memo, {}
            self._memo[s] = got
        return got

    def total(self, s: str) -> float:
        """Best score of a text that begins and ends at free borders."""
        ids = self.encode(s)
        return float(self._score_of_id[ids].sum())

    def stretches(self, s: str) -> list[str]:
        return self._cut.findall(s)

    def encode(self, s: str) -> np.ndarray:
        """Ids of a text that begins and ends at free borders."""
        get, rest = self._memo.get, self.remembered
        return np.frombuffer(b"".join([get(w) or rest(w) for w in self.stretches(s)]), np.int32)

    def decode(self, ids) -> bytes:
        text = self.text
        return b"".join([text[i] for i in ids])

    def part_text(self, part: int, ids) -> str:
        """The text of a part: without the leading space if it is the first."""
        raw = self.decode(ids).decode("utf-8", "replace")
        return raw[1:] if part == 0 else raw

    def check(self, part: int, ids: np.ndarray) -> tuple[int, int]:
        """Characters and checksum of the text that ids decode to."""
        raw = self.decode(ids.tolist())
        raw = raw[1:] if part == 0 else raw
        try:
            return len(raw.decode()), zlib.crc32(raw)
        except UnicodeDecodeError:
            text = self.part_text(part, ids.tolist())
            return len(text), zlib.crc32(text.encode())

    # ---- chunks ----

    def transfer(self, s: str, size: int) -> np.ndarray:
        """``m[0, i, j]``: best score from entry state ``i`` to exit state ``j`` of the chunk
        ``s[:size]``; ``m[1, i, j]``: place of ``i`` among the entry states of ``j`` by the tie rule.
        ``s`` goes on for up to ``longest - 1`` characters of look-ahead."""
        k = self.longest
        m = np.full((2, k, k), _NO)
        ends = np.cumsum([len(w) for w in self.stretches(s)])
        free = [0, *ends[ends <= size].tolist()]
        head = next((e for e in free if e >= min(k - 1, size)), None)  # beyond every entry state
        entries = range(min(k, size + 1))
        if head is None:  # no free border inside: one pass from each entry to every exit
            passes = [self.forward(s, [_NO] * i + [0.0], size) for i in entries]
            for i, (best, _) in enumerate(passes):
                m[0, i] = _exits(best, size, k)
            m[1] = np.stack([_order([back for _, back in passes], size + j, k) for j in range(k)], axis=1)
            return m
        tail = max(e for e in free if e >= head)
        middle = self.total(s[head:tail])
        out = _exits(self.forward(s[tail:], [0.0], size - tail)[0], size - tail, k) + middle
        passes = [self.forward(s[:head], [_NO] * i + [0.0], head) for i in entries]
        for i, (best, _) in enumerate(passes):
            m[0, i] = best[head] + out
        m[1] = _order([back for _, back in passes], head, k)[:, None]
        return m


def _exits(best: list[float], size: int, k: int) -> np.ndarray:
    """Scores of the ``k`` exit states of a pass over ``size`` characters."""
    return np.array([best[size + j] if size + j < len(best) else _NO for j in range(k)])


def _order(passes: list[list], at: int, k: int) -> np.ndarray:
    """Places of ``k`` entry states by the tie rule, given the ``back`` of the pass from each:
    the first difference from ``at`` leftwards decides, and the border further right wins.  A
    piece that reaches over the chunk's beginning is longer than any other."""
    def borders(i: int) -> list[float]:
        if i >= len(passes) or at >= len(passes[i]):
            return [np.inf]
        back, p, out = passes[i], at, []
        while back[p] is not None:
            p -= back[p][0]
            out.append(-p)
        return [*out, np.inf]

    place = np.empty(k)
    place[sorted(range(k), key=borders)] = np.arange(k)
    return place


def _free_borders(pieces: dict[str, tuple[int, float]]) -> re.Pattern:
    """A pattern whose matches are the stretches between borders that no piece crosses:
    before a space that follows another character, on both sides of white space that no
    piece has, and between a letter or digit and another character, unless one of them
    is a character that some piece joins across.  Where pieces have a space behind another
    character, nothing is cut."""
    pairs = {(a, b) for p in pieces for a, b in zip(p, p[1:]) if b == " " or a != " "}
    if any(a != " " and b == " " for a, b in pairs):
        return re.compile(r"(?s).+")
    pairs = {(a, b) for a, b in pairs if a != " "}
    mixed = [sorted(pair, key=str.isalnum) for pair in pairs if pair[0].isalnum() != pair[1].isalnum()]
    glue = sorted({word if not word.isalpha() else other for other, word in mixed})
    known = set("".join(pieces))
    alone = "".join(re.escape(c) for c in "\n\t\r\f\v" if c not in known)
    joined = "".join(map(re.escape, glue))
    word, other = rf"[^\W_{joined}]+", rf"(?:[^\w {alone}{joined}]" + ("" if "_" in glue else "|_") + ")+"
    run = f"(?:{word}|{other})"
    if joined:
        more = f"(?:[{joined}]+{run}?)"
        word, other = f"(?:{run}{more}*|{more}+)", ""
    body = f"(?:{word}|{other})" if other else word
    return re.compile(rf"(?s) *{body}| +" + (f"|[{alone}]" if alone else ""))


@lru_cache(maxsize=4)
def vocabulary(path: str = MODEL) -> Vocabulary:
    """Pieces and scores of a SentencePiece model file with byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: dict[str, tuple[int, float]] = {}
    bytes_at, text = [-1] * 256, []
    for i in range(sp.get_piece_size()):
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            bytes_at[int(name[3:5], 16)] = i
            text.append(bytes([int(name[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            text.append(b"")
        else:
            plain = name.replace(_SPACE, " ")
            pieces[plain] = (i, round(sp.get_score(i) * _GRAIN) / _GRAIN)
            text.append(plain.encode())
    if min(bytes_at) < 0:
        raise ValueError("the vocabulary has no byte pieces")
    vocab = Vocabulary(pieces, bytes_at, text, max(map(len, pieces)), min(s for _, s in pieces.values()) + _UNKNOWN)
    vocab._cut = _free_borders(pieces)
    vocab._score_of_id = vocab.scores
    for piece, (i, score) in pieces.items():
        for k in range(1, len(piece)):
            vocab._trie.setdefault(piece[:k], None)
        vocab._trie[piece] = (score, np.array([i], np.int32).tobytes())
    return vocab


def _through(scores: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``best[..., j]``: the middle state (axis -2) of best score, ties by its place before exit ``j``."""
    return np.where(scores == scores.max(axis=-2, keepdims=True), places, np.inf).argmin(axis=-2)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices with the order of their entry states: what
    follows the middle state decides, then what precedes it."""
    k = a.shape[1]
    scores = a[0][:, :, None] + b[0][None, :, :]
    middle = _through(scores, b[1])
    entry, leave = np.ogrid[:k, :k]
    order = b[1][middle, leave] * k + a[1][entry, middle]
    return np.stack([scores.max(axis=1), order.argsort(axis=0, kind="stable").argsort(axis=0).astype(float)])


def _packed(m: np.ndarray) -> bytes:
    """A transfer matrix as bytes: scores, then places in two bytes each."""
    return m[0].tobytes() + m[1].astype(np.int16).tobytes()


def _unpacked(raw: bytes, k: int) -> np.ndarray:
    return np.stack([np.frombuffer(raw, np.float64, k * k), np.frombuffer(raw, np.int16, k * k, 8 * k * k)]).reshape(2, k, k)


def border_states(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """Best states at the borders of consecutive chunks: entry, the inner ones, exit."""
    score = np.full(matrices[0].shape[1], _NO)
    score[entry] = 0.0
    came = []
    for m in matrices:
        step = score[:, None] + m[0]
        came.append(_through(step, m[1]))
        score = step.max(axis=0)
    states = [leave]
    for c in reversed(came):
        states.append(int(c[states[-1]]))
    return states[::-1]


# ---- encoding ----------------------------------------------------------------

def _with_prefix(text):
    """SentencePiece's leading space, for texts that are not empty."""
    return F.when(text == "", text).otherwise(F.concat(F.lit(" "), text))


def _chunks(texts: DataFrame, chunk: int, look: int) -> DataFrame:
    """``(key, part, size, piece)``: the chunks of ``(key, text)``, each with its look-ahead;
    the last chunk takes the rest."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                key, text = key.as_py(), text.as_py()
                last = len(text) // chunk - 1
                for at in range(0, last + 1, 64):
                    parts = range(at, min(at + 64, last + 1))
                    sizes = [chunk if i < last else len(text) - i * chunk for i in parts]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(parts)), pa.array(list(parts), pa.int32()), pa.array(sizes, pa.int32()),
                         pa.array([text[i * chunk: i * chunk + n + look] for i, n in zip(parts, sizes)])], ["key", "part", "size", "piece"])

    return texts.select("key", "text").mapInArrow(cut, "key string, part int, size int, piece string")


def _giant_states(chunks: DataFrame, path: str, k: int) -> DataFrame:
    """``(key, part, enter, leave)``: best border states of the chunks of giant texts."""
    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for key, part, size, s in zip(*(c.to_pylist() for c in batch.columns)):
                m = _packed(vocab.transfer(s, size))
                yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([part], pa.int32()), pa.array([m], pa.binary())], ["key", "at", "m"])
        release()

    shape = "key string, at int, m binary"
    levels = [cut_lineage(chunks.select("key", "part", "size", "piece").mapInArrow(transfers, shape))]
    most = levels[0].agg(F.max("at")).first()[0]
    if most is None:
        return chunks.sparkSession.createDataFrame([], "key string, part int, enter int, leave int")

    def product(table: pa.Table) -> pa.Table:  # at most FAN rows
        rows = table.sort_by("at").to_pylist()
        m = _unpacked(rows[0]["m"], k)
        for r in rows[1:]:
            m = combine(m, _unpacked(r["m"], k))
        return pa.table({"key": [rows[0]["key"]], "at": pa.array([rows[0]["at"] // FAN], pa.int32()), "m": pa.array([_packed(m)], pa.binary())})

    while most >= FAN:
        levels.append(cut_lineage(levels[-1].groupBy("key", F.floor(F.col("at") / FAN).alias("up")).applyInArrow(product, shape)))
        most //= FAN

    def hand_down(table: pa.Table) -> pa.Table:  # at most FAN rows
        rows = table.sort_by("at").to_pylist()
        states = border_states([_unpacked(r["m"], k) for r in rows], rows[0]["enter"], rows[0]["leave"])
        return pa.table({"key": [r["key"] for r in rows], "at": pa.array([r["at"] for r in rows], pa.int32()),
                         "enter": pa.array(states[:-1], pa.int32()), "leave": pa.array(states[1:], pa.int32())})

    # the top of the tree: a text begins and ends at state 0
    known = levels[-1].select("key").distinct().select("key", F.lit(0).alias("up"), F.lit(0).alias("enter"), F.lit(0).alias("leave"))
    for level in reversed(levels):
        rows = level.withColumn("up", F.floor(F.col("at") / FAN).cast("int"))
        known = (rows.join(known, ["key", "up"]).groupBy("key", "up")
                 .applyInArrow(hand_down, "key string, at int, enter int, leave int").withColumnRenamed("at", "up"))
        known = cut_lineage(known)
    return known.withColumnRenamed("up", "part")


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL, chunk: int = CHUNK,
           verify: bool = False) -> DataFrame:
    """``(doc_id, part, ids)``: the ids of every text, the parts of a text in order; with
    ``verify`` also ``decoded_chars`` and ``decoded_crc32`` (UTF-8) of the text that the ids of
    a part decode to, worked out where the ids are.

    One row for a text of fewer than ``2 * chunk`` characters, else one for each chunk
    (a giant text's ids never sit in one row).  The ids of all parts together are the same
    for every ``chunk``.  A null or empty text has
    one part without ids; repeated rows repeat.  Rows without an id keep the null.
    """
    vocab = vocabulary(path)
    look = vocab.longest - 1
    if chunk <= look:
        raise ValueError("a chunk must be longer than the longest piece")
    text = _with_prefix(F.coalesce(F.col(text_col), F.lit("")))
    rows = df.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    giant = F.char_length("text") >= 2 * chunk

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            yield from _listed(v, batch, verify)
        release()

    shape = "part int, ids array<int>" + (", decoded_chars int, decoded_crc32 long" if verify else "")
    small = rows.filter(~giant).mapInArrow(whole, f"doc_id {dict(rows.dtypes)['doc_id']}, {shape}")

    # giant texts are known by their content: equal ones are encoded once
    large = cut_lineage(rows.filter(giant).withColumn("key", F.sha2("text", 256)))
    # one text a key: duplicates are dropped by key before the texts are cut
    distinct = large.groupBy("key").agg(F.first("text").alias("text"))
    chunks = cut_lineage(_chunks(distinct, chunk, look))
    states = _giant_states(chunks, path, vocab.longest)
    placed = with_small(chunks, states, ["key", "part"]).select("key", "part", "size", "enter", "leave", "piece")

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for key, part, size, enter, leave, s in zip(*(c.to_pylist() for c in batch.columns)):
                ids = v.encode(s[enter:size + leave])
                cols = [pa.array([key]), pa.array([part], pa.int32()), pa.array([ids], pa.list_(pa.int32()))]
                if verify:
                    chars, crc = v.check(part, ids)
                    cols += [pa.array([chars], pa.int32()), pa.array([crc], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["key", *names])
        release()

    names = [c.split()[0] for c in shape.split(", ")]
    encoded = placed.mapInArrow(between, f"key string, {shape}")
    return small.unionByName(with_small(encoded, large.select("key", "doc_id"), ["key"]).select("doc_id", *names))


def _listed(v: Vocabulary, batch: pa.RecordBatch, verify: bool) -> Iterator[pa.RecordBatch]:
    """Encoded rows ``(id, text)``, in record batches of about a million ids."""
    ids, checks, begin, total = [], [], 0, 0
    for i, text in enumerate(batch.column(1)):
        ids.append(v.encode(text.as_py()))
        if verify:
            checks.append(v.check(0, ids[-1]))
        total += len(ids[-1])
        if total >= 1 << 20 or i == batch.num_rows - 1:
            n = len(ids)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
            cols = [batch.column(0).slice(begin, n), pa.array([0] * n, pa.int32()), values]
            names = ["doc_id", "part", "ids"]
            if verify:
                cols += [pa.array([c for c, _ in checks], pa.int32()), pa.array([c for _, c in checks], pa.int64())]
                names += ["decoded_chars", "decoded_crc32"]
            yield pa.RecordBatch.from_arrays(cols, names)
            ids, checks, begin, total = [], [], i + 1, 0


# ---- decoding ----------------------------------------------------------------

def decode_column(part: Column, ids: Column, path: str = MODEL) -> Column:
    """The text of an encoded part.  Byte pieces become their bytes and the leading space of a
    text's first part (0) goes.  Parts are cut between pieces, and a piece is never less than
    a character, so each is text by itself; null ids count as none."""
    @F.pandas_udf("string")
    def run(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        v = vocabulary(path)
        for parts, lists in series:
            out = []
            for p, own in zip(parts, lists):
                out.append(v.part_text(p, own.tolist() if own is not None else ()))
            yield pd.Series(out, dtype=object)

    return run(part, ids)


def decode(df: DataFrame, path: str = MODEL, id_col: str = "doc_id", part_col: str = "part", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, part, text)`` of encoded parts, see ``decode_column``."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(part_col).alias("part"), F.col(ids_col).alias("ids"))
    return rows.select("doc_id", "part", decode_column(F.col("part"), F.col("ids"), path).alias("text"))
