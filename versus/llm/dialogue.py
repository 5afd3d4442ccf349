"""Conversation structure repair: cheapest edits by Four-Russians block tables.

A conversation is repaired by edits until its role initials read ``(s?(ua)+)?``.  Keep costs 0,
Rerole (to user or assistant) 1, Delete 2, Insert (an empty user or assistant row) 5; a truncated
row that stays costs 5 more; blank and duplicate rows must go.  Among the cheapest edit sequences
the one whose initials are least in ASCII order is taken.

*Tables.*  A row is one of nine symbols (role s, u, a or other, whole or truncated; must go).  The
cost to finish from each of the four states (nothing yet, after s, after u, after a), less
its least, takes few different vectors, so a step is a look-up ``vector, symbol -> vector,
offset``.  ``tables`` composes it for every block of ``BLOCK`` symbols.  A pass looks the
blocks up from the last row to the first and keeps the vector at each border.  The trace goes against
the pass: each block is expanded back from its border vector, and as every vector says
exactly what finishing costs, the least letter that stays cheapest is known at once and ties need
no search.

*Scale.*  Rows are range-partitioned by conversation, turn and content, so a conversation of any
length is cut into pieces of bounded size.  All but the first and last conversation of a
partition are whole and are solved as the sorted rows stream by.  The others (two a partition
at most) take the same tables piece by piece: matrices state -> state, combined over the pieces
of a conversation, give the vector at each piece's end; every piece is traced from each state, and
the chain of states picks the traces.  Only the hash over a repaired conversation is
sequential by nature; it streams its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CRC_TABLE_SQL, crc_sql, cut_lineage, release

BLOCK = 4
FAR = 1 << 40
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = 4
#: Symbols: role class (s, u, a, other), the same truncated, must go, no row.
GONE, PAD, SYMBOLS = 8, 9, 10
#: The next role a state asks for, as the state after it.
_NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
_ACCEPT = (0, FAR, FAR, 0)
# white space of the contract, and its complement
SPACE = " \t\n\x0b\x0c\r"
_LETTERS = str.maketrans({"U": "I", "A": "I", "P": "R", "Q": "R", ".": None})


def _keep(symbol: int, state: int) -> int | None:
    """The state after a kept row, or none if it may not stand there."""
    role = symbol % 4
    if symbol >= GONE:
        return None
    if role == 0:
        return AFTER_S if state == START else None
    if role == 1:
        return AFTER_U if state != AFTER_U else None
    return AFTER_A if role == 2 and state == AFTER_U else None


def _moves(symbol: int, state: int) -> list[tuple[int, str, str, int]]:
    """(cost, audit letter, code, next state) of all that can be done with a row."""
    out = [(2, "D", "D", state)]
    if symbol < GONE:
        extra = 5 if symbol >= 4 else 0
        kept = _keep(symbol, state)
        if kept is not None:
            out.append((extra, "K", "K", kept))
        to = _NEXT[state]
        out.append((extra + 1, "R", "P" if to == AFTER_U else "Q", to))
    return out


def _with_inserts(costs: list[int]) -> list[int]:
    for _ in range(STATES):
        costs = [min(c, 5 + costs[_NEXT[q]]) for q, c in enumerate(costs)]
    return [min(c, FAR) for c in costs]


def _step(after: tuple[int, ...], symbol: int) -> list[int]:
    """Cost to finish before a row, from that after it."""
    if symbol == PAD:
        return list(after)
    return _with_inserts([min(c + after[to] for c, _, _, to in _moves(symbol, q)) for q in range(STATES)])


def _normal(costs) -> tuple[tuple[int, ...], int]:
    low = min(costs)
    return tuple(FAR if c >= FAR // 2 else c - low for c in costs), low


@dataclass(frozen=True)
class Tables:
    ids: dict            # normalised vector -> number
    vectors: list        # number -> normalised vector
    step: np.ndarray     # [vector, symbol] -> vector
    block: np.ndarray    # [vector, block code] -> vector
    offset: np.ndarray   # [vector, block code] -> cost taken out
    first: np.ndarray    # [vector, symbol] -> cost taken out
    act: list            # [vector after the row][symbol][state] -> (codes, next state)


def _decide(after: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
    """The least edits of a row, inserts before it included, that finish at least cost."""
    if symbol == PAD:
        return ".", state
    before, codes = _step(after, symbol), ""
    while True:
        found = [(c + after[to], letter, code, to, False) for c, letter, code, to in _moves(symbol, state)]
        to = _NEXT[state]
        found.append((5 + before[to], "I", "U" if to == AFTER_U else "A", to, True))
        _, _, code, state, insert = min(found)
        codes += code
        if not insert:
            return codes, state


@lru_cache(maxsize=1)
def tables() -> Tables:
    """Every reachable vector, its single steps, and the steps of every block of ``BLOCK`` symbols."""
    units = [tuple(0 if q == j else FAR for q in range(STATES)) for j in range(STATES)]
    ids, vectors = {}, []
    for v in [_normal(_with_inserts(list(_ACCEPT)))[0], *units]:
        if v not in ids:
            ids[v] = len(vectors)
            vectors.append(v)
    to, off = [], []
    while len(to) < len(vectors):
        row = [_normal(_step(vectors[len(to)], s)) for s in range(SYMBOLS)]
        for v, _ in row:
            if v not in ids:
                ids[v] = len(vectors)
                vectors.append(v)
        to.append([ids[v] for v, _ in row])
        off.append([low for _, low in row])
    step, first = np.array(to, dtype=np.int32), np.array(off, dtype=np.int64)
    block, offset = step, first
    for _ in range(BLOCK - 1):
        # one more symbol to the left of every block so far
        offset = (offset[:, None, :] + first[block].transpose(0, 2, 1)).reshape(len(vectors), -1)
        block = step[block].transpose(0, 2, 1).reshape(len(vectors), -1)
    act = [[[_decide(v, s, q) for q in range(STATES)] for s in range(SYMBOLS)] for v in vectors]
    return Tables(ids, vectors, step, block, offset, first, act)


def _codes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    padded = np.full(-(-len(symbols) // BLOCK) * BLOCK, PAD, dtype=np.int64)
    padded[:len(symbols)] = symbols
    return padded, padded.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))


def _pass(codes: np.ndarray, vector: int) -> tuple[list[int], int, int]:
    """Look-ups from the last block to the first: the vector right of each block, that at the start, and
    the cost taken out."""
    t, borders, cost = tables(), [0] * len(codes), 0
    for k in range(len(codes) - 1, -1, -1):
        borders[k] = vector
        cost += int(t.offset[vector, codes[k]])
        vector = int(t.block[vector, codes[k]])
    return borders, vector, cost


def matrix(symbols: np.ndarray) -> np.ndarray:
    """Least cost through a piece from each state (row) to each state (column)."""
    t, (_, codes) = tables(), _codes(symbols)
    out = np.full((STATES, STATES), FAR, dtype=np.int64)
    for j in range(STATES):
        unit = t.ids[tuple(0 if q == j else FAR for q in range(STATES))]
        _, vector, cost = _pass(codes, unit)
        out[:, j] = [c + cost if c < FAR else FAR for c in t.vectors[vector]]
    return out


def through(m: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Cost to finish before a piece, from that after it."""
    return np.minimum((m + after[None, :]).min(axis=1), FAR)


def end_costs() -> np.ndarray:
    return np.array(_with_inserts(list(_ACCEPT)), dtype=np.int64)


def trace(symbols: np.ndarray, after: np.ndarray, states: tuple[int, ...] = (START,)) -> list[tuple[str, int]]:
    """For each entry state the edit codes of a piece and the state it leaves in; ``after`` is the
    cost to finish behind it.  Codes: U, A insert, P, Q rerole (to user, to assistant), K, D, and
    a point for no row."""
    t, (padded, codes) = tables(), _codes(symbols)
    borders, _, _ = _pass(codes, t.ids[_normal(after)[0]])
    rows = []  # decisions of the rows, by state
    for k in range(len(codes)):
        part = padded[k * BLOCK:(k + 1) * BLOCK]
        vectors = [borders[k]]
        for s in part[:0:-1]:
            vectors.append(int(t.step[vectors[-1], s]))
        rows += [t.act[v][s] for v, s in zip(reversed(vectors), part.tolist())]
    out = []
    for q in states:
        parts = []
        for act in rows[:len(symbols)]:
            code, q = act[q]
            parts.append(code)
        out.append(("".join(parts), q))
    return out


def closing(state: int) -> str:
    """Inserts behind the last row."""
    return {START: "", AFTER_S: "UA", AFTER_U: "A", AFTER_A: ""}[state]


def audit_of(codes: str) -> str:
    return codes.translate(_LETTERS)


def row_codes(codes: str) -> list[str]:
    """The edits of each row: inserts before it and its own; those behind the last row are its."""
    out, at = [], 0
    for i, c in enumerate(codes):
        if c not in "UA":
            out.append(codes[at:i + 1])
            at = i + 1
    if at < len(codes):
        out[-1] += codes[at:]
    return out


def repaired(codes: str, role: str, text: str) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the rows that one row's edits leave."""
    made = {"U": ("I", "user", ""), "A": ("I", "assistant", ""), "P": ("R", "user", text), "Q": ("R", "assistant", text), "K": ("K", role, text)}
    return [made[c] for c in codes if c in made]


def _turn_gaps(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else min(high - low + 1 - distinct, (1 << 63) - 1)


def _facts(turns: list, initials: list, symbols: list) -> dict:
    """Turns and role order of consecutive rows; symbol PAD: no row."""
    turns = [t for t, s in zip(turns, symbols) if s != PAD and t is not None]
    initials = [r for r, s in zip(initials, symbols) if s != PAD]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return {"low": min(turns, default=None), "high": max(turns, default=None), "distinct": len(set(turns)), "illegal": illegal,
            "first": initials[0] if initials else None, "last": initials[-1] if initials else None}


def _marked(rows: list) -> tuple[list, dict]:
    """Rows with repeats of role and text marked, and the number of each fault."""
    seen, out = set(), []
    faults = {"blank": 0, "duplicate": 0, "truncated": 0}
    for pos, turn, role, text, symbol in rows:
        if symbol == GONE:
            faults["blank"] += 1
        elif symbol != PAD:
            if (role, text) in seen:
                symbol = GONE
                faults["duplicate"] += 1
            else:
                seen.add((role, text))
                faults["truncated"] += symbol >= 4
        out.append((pos, turn, role, text, symbol))
    return out, faults


def _solved(rows: list) -> tuple[dict, str]:
    """Facts and edit codes of a whole conversation."""
    rows, faults = _marked(rows)
    symbols = np.array([r[4] for r in rows], dtype=np.int64)
    (codes, state), = trace(symbols, end_costs())
    codes += closing(state)
    _, vector, cost = _pass(_codes(symbols)[1], tables().ids[_normal(end_costs())[0]])
    facts = _facts([r[1] for r in rows], [r[2][:1] for r in rows], symbols.tolist())
    return {**faults, "gaps": _turn_gaps(facts["low"], facts["high"], facts["distinct"]), "illegal": facts["illegal"],
            "cost": cost + tables().vectors[vector][START], "audit": audit_of(codes)}, codes


_DEALT = ("conv_id", "bin", "pos", "turn", "role", "text", "symbol")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, int, list, bool]]:
    """(conversation, bin, rows, whether it may go on in another partition) of a sorted partition."""
    first, held = True, None
    for batch in batches:
        for conv, b, *row in zip(*[batch.column(c).to_pylist() for c in _DEALT]):
            if held is not None and held[0] == conv:
                held[2].append(row)
                continue
            if held is not None:
                yield *held, first
                first = False
            held = (conv, b, [row])
    if held is not None:
        yield *held, True


def _hashed(lines: Iterator[str]) -> str:
    digest = hashlib.sha256()
    for i, line in enumerate(lines):
        digest.update(("\n" + line if i else line).encode("utf-8", "surrogatepass"))
    return digest.hexdigest()


_KINDS = {"int": T.IntegerType(), "long": T.LongType(), "string": T.StringType(), "binary": T.BinaryType(), "boolean": T.BooleanType(),
          "array<long>": T.ArrayType(T.LongType()), "array<string>": T.ArrayType(T.StringType()), "array<int>": T.ArrayType(T.IntegerType())}
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def symbol_of(role: Column, text: Column, present: Column) -> Column:
    """The symbol of a row whose duplicates are not known yet; blank rows must go."""
    end = F.rtrim(text, F.lit(SPACE))
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in (("s", 0), ("u", 1), ("a", 2)) for x in p]), F.substring(role, 1, 1)), F.lit(3))
    whole = F.substring(end, -1, 1).isin(".", "!", "?")
    return F.when(~present, PAD).when(end == "", GONE).when(whole, kind).otherwise(kind + 4)


class Repair:
    """Repaired conversations of ``df``: ``conversations`` (a row each), ``rows`` (what remains, in order).

    Rows are taken by turn (nulls first), ties by the first 32 characters of the role, the first
    64 of the text and a checksum of both.  Null roles and texts count as one space, a null
    conversation is one of its own; roles other than s.., u.. and a.. (an empty one too) must be
    reroled or go.  ``present`` (a Boolean column of ``df``) false: the row only names its
    conversation.  Rows of equal role and text after the first are duplicates.  Texts may be of
    any length; further columns are not read.  No rows, no conversations.
    """

    def __init__(self, df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 present: str | None = None, bins: int | None = None):
        role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
        rows = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                         (F.col(present) if present else F.lit(True)).alias("here"))
        rows = rows.withColumn("symbol", symbol_of(F.col("role"), F.col("text"), F.col("here")).cast("int")).drop("here")
        # bounded keys, as samples of them go through the driver; a seeded number last spreads equal rows
        ties = [F.substring("role", 1, 32), F.substring("text", 1, 64), F.xxhash64("role", "text")]
        by = [F.col("conv_id"), F.col("turn"), *ties]
        dealt = rows.repartitionByRange(bins, *by, F.rand(13)) if bins else rows.repartitionByRange(*by, F.rand(13))
        dealt = dealt.sortWithinPartitions(*by, "role", "text").withColumns({"bin": F.spark_partition_id(), "pos": F.monotonically_increasing_id()})
        self.dealt = cut_lineage(dealt.select(*_DEALT))
        self.id_type = self.dealt.schema["conv_id"].dataType
        self._solve()

    def _schema(self, *fields: tuple[str, str]) -> T.StructType:
        out = T.StructType([T.StructField("conv_id", self.id_type)])
        for name, kind in fields:
            out = out.add(name, _KINDS[kind])
        return out

    def _solve(self) -> None:
        schema = self._schema(*[(c, "long") for c in _COUNTS], ("audit", "string"), ("repaired_sha256", "string"), ("open", "boolean"))
        arrow = _arrow(schema)

        def whole(batches):
            def found():
                for conv, _, rows, may_go_on in _pieces(batches):
                    if may_go_on:
                        yield (conv, *[None] * (len(_COUNTS) + 2), True)
                    else:
                        facts, codes = _solved(rows)
                        lines = (f"{role}:{text}" for r, c in zip(rows, row_codes(codes)) for _, role, text in repaired(c, r[2], r[3]))
                        yield (conv, *[facts[c] for c in _COUNTS], facts["audit"], _hashed(lines), False)
            yield from _batches(found(), arrow)
            release()

        solved = cut_lineage(self.dealt.mapInArrow(whole, schema))
        # two a partition at most
        cut = solved.filter("open").select(F.col("conv_id").alias("cut_id")).distinct()
        rows = self.dealt.join(F.broadcast(cut), F.col("conv_id").eqNullSafe(F.col("cut_id"))).drop("cut_id")
        edits = self._cut_edits(rows)
        self.cut_rows = rows.join(edits, F.col("pos") == F.col("epos")).drop("epos")
        hashes = self.cut_rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(self._hash_stream(), self._schema(("repaired_sha256", "string")))
        hashes = hashes.withColumnRenamed("conv_id", "hid")
        pieced = self._totals.join(hashes, F.col("conv_id").eqNullSafe(F.col("hid"))).drop("hid")
        names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]
        self.conversations = solved.filter("NOT open").select(*names).unionByName(pieced.select(*names))

    def _hash_stream(self):
        arrow = _arrow(self._schema(("repaired_sha256", "string")))

        def hashes(batches):
            def found():
                conv, digest, empty = None, None, True
                for batch in batches:
                    for c, role, text, codes in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "role", "text", "codes")]):
                        if digest is None or c != conv:
                            if digest is not None:
                                yield conv, digest.hexdigest()
                            conv, digest, empty = c, hashlib.sha256(), True
                        for _, r, t in repaired(codes, role, text):
                            digest.update(f"{r}:{t}".encode() if empty else f"\n{r}:{t}".encode())
                            empty = False
                if digest is not None:
                    yield conv, digest.hexdigest()
            yield from _batches(found(), arrow)
        return hashes

    def _cut_edits(self, rows: DataFrame) -> DataFrame:
        """Edit codes by position of the conversations that cross partitions; sets their totals."""
        rows = rows.withColumn("digest", F.sha2("text", 256))
        twice = rows.filter((F.col("symbol") != GONE) & (F.col("symbol") != PAD)).groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("first_pos"), F.count("*").alias("m"))
        twice = twice.filter("m > 1").select(F.col("conv_id").alias("tid"), F.col("role").alias("trole"), F.col("digest").alias("tdigest"), "first_pos")
        same = [F.col("conv_id").eqNullSafe(F.col("tid")), F.col("role") == F.col("trole"), F.col("digest") == F.col("tdigest")]
        # narrow rows: the texts have done their part
        narrow = rows.select("conv_id", "bin", "pos", "turn", "role", "symbol", "digest").join(twice, same, "left")
        dup = (F.col("symbol") < GONE) & (F.col("pos") > F.col("first_pos"))
        narrow = narrow.select("conv_id", "bin", "pos", "turn", F.substring("role", 1, 1).alias("initial"),
                               F.when(dup, GONE).otherwise(F.col("symbol")).alias("symbol"), (F.col("symbol") == GONE).alias("blank"), F.coalesce(dup, F.lit(False)).alias("dup"))
        facts = [("bin", "int"), ("start", "long"), ("symbols", "binary"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"),
                 ("low", "long"), ("high", "long"), ("distinct", "long"), ("first", "string"), ("last", "string"), ("through", "array<long>")]
        schema = self._schema(*facts)
        arrow = _arrow(schema)

        def piece(table: pa.Table) -> pa.Table:
            table = table.sort_by("pos")
            col = {c: table.column(c).to_pylist() for c in table.column_names}
            symbols = np.array(col["symbol"], dtype=np.uint8)
            got = _facts(col["turn"], col["initial"], col["symbol"])
            truncated = int(((symbols >= 4) & (symbols < GONE)).sum())
            row = (col["conv_id"][0], col["bin"][0], col["pos"][0], symbols.tobytes(), sum(col["blank"]), sum(col["dup"]), truncated, got["illegal"],
                   got["low"], got["high"], got["distinct"], got["first"], got["last"], matrix(symbols).ravel().tolist())
            return pa.Table.from_batches(_batches(iter([row]), arrow), schema=arrow)

        pieces = cut_lineage(narrow.groupBy("conv_id", "bin").applyInArrow(piece, schema))

        ends = self._schema(("bin", "int"), ("after", "array<long>"), ("cost", "long"))
        ends_arrow = _arrow(ends)

        def chain(table: pa.Table) -> pa.Table:
            table = table.sort_by([("bin", "descending")])
            after, out = end_costs(), []
            for conv, b, m in zip(*[table.column(c).to_pylist() for c in ("conv_id", "bin", "through")]):
                before = through(np.array(m, dtype=np.int64).reshape(STATES, STATES), after)
                out.append((conv, b, after.tolist(), int(before[START])))
                after = before
            return pa.Table.from_batches(_batches(iter(out), ends_arrow), schema=ends_arrow)

        # a row a piece: partitions bound the pieces of a conversation
        after = pieces.select("conv_id", "bin", "through").groupBy("conv_id").applyInArrow(chain, ends)
        after = after.withColumnsRenamed({"conv_id": "aid", "bin": "abin"})
        joined = pieces.drop("through").join(after, F.col("conv_id").eqNullSafe(F.col("aid")) & (F.col("bin") == F.col("abin"))).drop("aid", "abin", "through")
        traced_fields = [f for f in facts if f[0] not in ("symbols", "through")] + [("cost", "long"), ("codes", "array<string>"), ("leaves", "array<int>")]
        traced = self._schema(*traced_fields)
        traced_arrow = _arrow(traced)

        def traces(batches):
            def found():
                for batch in batches:
                    for r in batch.to_pylist():
                        got = trace(np.frombuffer(r["symbols"], dtype=np.uint8), np.array(r["after"], dtype=np.int64), tuple(range(STATES)))
                        yield (r["conv_id"], *[r[f] for f, _ in traced_fields[:-2]], [c for c, _ in got], [q for _, q in got])
            yield from _batches(found(), traced_arrow, 16)

        candidates = joined.mapInArrow(traces, traced)
        result = self._schema(("bin", "int"), ("start", "long"), ("codes", "string"), *[(c, "long") for c in _COUNTS], ("audit", "string"))
        result_arrow = _arrow(result)

        def choose(table: pa.Table) -> pa.Table:
            rows = table.sort_by("bin").to_pylist()
            state, parts = START, []
            for r in rows:
                parts.append(r["codes"][state])
                state = r["leaves"][state]
            parts[-1] += closing(state)
            total = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal", "distinct")}
            initial, turn = None, None
            for r in rows:
                if r["first"] is not None:
                    total["illegal"] += initial is not None and initial + r["first"] not in ("su", "ua", "au")
                    initial = r["last"]
                if r["low"] is not None:
                    total["distinct"] -= turn == r["low"]
                    turn = r["high"]
            low = min((r["low"] for r in rows if r["low"] is not None), default=None)
            total["gaps"], total["cost"] = _turn_gaps(low, turn, total["distinct"]), rows[0]["cost"]
            out = [(r["conv_id"], r["bin"], r["start"], p, *([total[c] for c in _COUNTS] if not i else [None] * len(_COUNTS)),
                    audit_of("".join(parts)) if not i else None) for i, (r, p) in enumerate(zip(rows, parts))]
            return pa.Table.from_batches(_batches(iter(out), result_arrow), schema=result_arrow)

        chosen = cut_lineage(candidates.groupBy("conv_id").applyInArrow(choose, result))
        self._totals = chosen.filter("audit IS NOT NULL").select("conv_id", *_COUNTS, "audit")
        # positions inside a piece follow one another
        each = F.posexplode(F.regexp_extract_all("codes", F.lit("[UA]*[PQKD.](?:[UA]+$)?"), F.lit(0))).alias("i", "code")
        return chosen.select("start", each).select((F.col("start") + F.col("i")).alias("epos"), F.col("code").alias("codes"))

    @property
    def rows(self) -> DataFrame:
        """``(conv_id, pos, part, edit, role, text)``: what remains, in the order of ``pos, part``."""
        fields = [("pos", "long"), ("part", "int"), ("edit", "string"), ("role", "string"), ("text", "string")]
        schema = self._schema(*fields)
        arrow = _arrow(schema)

        def parts(conv, row, codes):
            for i, (edit, role, text) in enumerate(repaired(codes, row[2], row[3])):
                yield conv, row[0], i, edit, role, text

        def whole(batches):
            yield from _batches((x for conv, _, rows, may_go_on in _pieces(batches) if not may_go_on
                                 for r, c in zip(rows, row_codes(_solved(rows)[1])) for x in parts(conv, r, c)), arrow)

        def cut(batches):
            yield from _batches((x for batch in batches for conv, *row, codes in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "pos", "turn", "role", "text", "codes")])
                                 for x in parts(conv, row, codes)), arrow)

        return self.dealt.mapInArrow(whole, schema).unionByName(self.cut_rows.mapInArrow(cut, schema))


def damage(df: DataFrame) -> DataFrame:
    """The damage of ``op13`` by ``crc32(conv_id:turn) % 20``: 0 drops a row (``here`` is false), 1 empties its
    text, 2 removes its ``.!?``, 3 repeats it, 4 sets role user."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1])) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(part[3], ".!?", "")).otherwise(part[3])
    out = df.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(part[2]).alias("role"), text.alias("text"), (kind != 0).alias("here"),
                    F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return out.drop("copy")


_SPACES = r"\x20\x09-\x0D"


def _least(*moves: str) -> str:
    return f"list_min([{', '.join(moves)}])"


def _move(state: str, cost: str, letter: str, line: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}}"


def _oracle() -> str:
    """DuckDB SQL of ``op13``: the states of every conversation row by row, each with its least (cost, edits, text)."""
    far = "{'c': 1000000, 'a': '', 't': ''}"
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"

    def inserts(start: str, s: str, u: str, a: str) -> tuple[str, str]:
        add = lambda x, line: _move(x, "5", "I", line)
        u1, a1 = _least(u, *[add(x, user) for x in (start, s, a)]), _least(a, add(u, assistant))
        return _least(u, *[add(x, user) for x in (start, s, a)], add(f"({a1})", user)), _least(a, add(u, assistant), add(f"({u1})", assistant))

    u2, a2 = inserts("d.z", "d.s", "d.u", "d.a")
    stay = "CASE WHEN r.bad THEN 1000000 WHEN r.cut THEN 5 ELSE 0 END"
    keep = lambda x, role: _move(x, f"{stay} + CASE WHEN r.i0 = '{role}' THEN 0 ELSE 1000000 END", "K", "chr(10) || r.role || ':' || r.text")
    change = lambda x, line: _move(x, f"{stay} + 1", "R", f"{line} || r.text")
    drop = lambda x: _move(x, "2", "D")
    return f"""
WITH RECURSIVE {CRC_TABLE_SQL},
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations, crc_table),
m AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, substr(role, 1, 1) AS i0, NOT regexp_matches(text, '[^{_SPACES}]') AS blank,
  regexp_extract(text, '([^{_SPACES}])[{_SPACES}]*$', 1) NOT IN ('.', '!', '?') AS unfinished FROM m),
q AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lead(i0) OVER (PARTITION BY conv_id ORDER BY i) AS i1 FROM o),
r AS (SELECT *, blank OR again AS bad, unfinished AND NOT blank AND NOT again AS cut, count(*) OVER (PARTITION BY conv_id) AS rows_ FROM q),
counts AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, CAST(sum(CAST(blank AS INT)) AS BIGINT) AS blank, CAST(sum(CAST(again AS INT)) AS BIGINT) AS duplicate,
  CAST(sum(CAST(cut AS INT)) AS BIGINT) AS truncated, CAST(sum(CASE WHEN i1 IS NOT NULL AND i0 || i1 NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END) AS BIGINT) AS illegal, max(rows_) AS rows_ FROM r GROUP BY conv_id),
dp AS (SELECT conv_id, 0 AS i, {{'c': 0, 'a': '', 't': ''}} AS z, {far} AS s, {far} AS u, {far} AS a FROM counts
  UNION ALL SELECT conv_id, i, {drop("z")}, {_least(drop("s"), keep("z", "s"))},
    {_least(drop("u"), *[keep(x, "u") for x in ("z", "s", "a")], *[change(x, user) for x in ("z", "s", "a")])}, {_least(drop("a"), keep("u", "a"), change("u", assistant))}
  FROM (SELECT d.conv_id, r.i, d.z, d.s, {u2} AS u, {a2} AS a, struct_pack(bad := r.bad, cut := r.cut, i0 := r.i0, role := r.role, text := r.text) AS r
        FROM dp d JOIN r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i + 1)),
best AS (SELECT d.conv_id, {_least("d.z", a2)} AS b FROM dp d JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id AND c.rows_ = d.i)
SELECT x.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(substr(b.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) x LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM x.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM x.conv_id
"""


ORACLE = _oracle()
