"""Conversation structure repair by Four-Russians block tables.

The cheapest edits that give a conversation the role order ``(s?(ua)+)?`` are a shortest path through
four states (nothing yet, after system, user, assistant) and one symbol a turn. What the turns from a
place on still cost from each state is a vector; less its minimum only sixteen vectors exist, so the
vector before every block of ``BLOCK`` symbols is precomputed for every vector behind it. A
conversation is read from its end, block by block, by lookup; then each block is expanded backward
from the vector at its end, which gives the cost of every choice, and walked forward taking the least
letter among the cheapest.

Turns are sorted by ranges of (conversation, turn) and cut into chunks of bounded rows and characters.
A conversation that lies in one chunk is repaired there. Longer ones, and those that a range border
cuts, go on as chunks: each is reduced to its symbols, the vectors behind the chunks are found on these
alone, and repeated turns are looked for by digest, so no task holds a whole conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import BATCH_ROWS, SPACES, give_back_memory, stage

# Symbols of a precomputed block, and turns and characters of a chunk.
BLOCK = 4
CHUNK_TURNS = 4096
CHUNK_CHARS = 4_000_000
# Rows of results handed back at a time.
FLUSH = 2048

# Costs of the edits, ends of a finished sentence, and legal neighbours.
DELETE, INSERT, REROLE, UNFINISHED = 3, 2, 2, 1
ENDS = (".", "!", "?")
LEGAL = {"su", "ua", "au"}
# State after a kept turn by role initial (system, user, assistant, other), and after an added one.
KEPT = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
ADDED = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
INITIALS = {"s": 0, "u": 1, "a": 2}
SYMBOLS = 9
NEVER = 1 << 40
# Faults of a turn.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Costs when turns may also be inserted first; a third insert would only go round."""
    return tuple(min(costs[s], costs[ADDED[s]] + INSERT, costs[ADDED[ADDED[s]]] + 2 * INSERT, NEVER) for s in range(4))


# Cost behind the last turn: nothing at all or an assistant's turn may end a conversation.
END = _with_inserts([0, NEVER, NEVER, 0])


def symbol(initial: str, fault: int) -> int:
    """Zero for a turn that has to go, else one for each role initial and whether it is unfinished."""
    if fault in (BLANK, DUPLICATE):
        return 0
    return 1 + 2 * INITIALS.get(initial, 3) + (fault == TRUNCATED)


def _before(costs: tuple[int, ...], sym: int) -> tuple[int, ...]:
    """Costs from each state before a turn, from those behind it."""
    out = []
    for s in range(4):
        best = costs[s] + DELETE
        if sym:
            kind, late = divmod(sym - 1, 2)
            kept = KEPT[s][kind]
            best = min(best, costs[ADDED[s]] + REROLE + late * UNFINISHED)
            if kept is not None:
                best = min(best, costs[kept] + late * UNFINISHED)
        out.append(min(best, NEVER))
    return _with_inserts(out)


def _normal(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    low = min(costs)
    return tuple(c if c == NEVER else c - low for c in costs), low


class Tables:
    """Normalised vectors, and the vector and added cost before every symbol and every block."""

    def __init__(self, block: int = BLOCK):
        self.block, self.vectors, steps = block, [END], []
        known = {END: 0}
        for vector in self.vectors:  # grows while it is read
            row = []
            for sym in range(SYMBOLS):
                found, low = _normal(_before(vector, sym))
                if found not in known:
                    known[found] = len(self.vectors)
                    self.vectors.append(found)
                row.append((known[found], low))
            steps.append(row)
        self.steps = steps
        one = np.array(steps)
        then, cost = np.arange(len(steps))[:, None], np.zeros((len(steps), 1), np.int64)
        for _ in range(block):  # a symbol in front of all blocks so far
            width = SYMBOLS * then.shape[1]
            cost = (cost[:, None, :] + one[then, :, 1].transpose(0, 2, 1)).reshape(-1, width)
            then = one[then, :, 0].transpose(0, 2, 1).reshape(-1, width)
        self.then, self.cost = then.tolist(), cost.tolist()
        self.weights = SYMBOLS ** np.arange(block - 1, -1, -1)

    def behind_blocks(self, symbols: bytes, last: int) -> tuple[list[int], int, int]:
        """Vectors behind every block from the left, the vector in front of all symbols, and its cost.

        Blocks are laid from the right end; the symbols left over in front are single steps, whose
        vectors are listed first.
        """
        n, behind, at, total = len(symbols), [], last, 0
        rest = n % self.block
        codes = np.frombuffer(symbols, np.uint8)[rest:].reshape(-1, self.block) @ self.weights
        for code in codes[::-1].tolist():
            behind.append(at)
            total += self.cost[at][code]
            at = self.then[at][code]
        for sym in symbols[:rest][::-1]:
            behind.append(at)
            at, low = self.steps[at][sym]
            total += low
        return behind[::-1], at, total

    def trace(self, symbols: bytes, state: int, last: int) -> tuple[str, int]:
        """Least letters among the cheapest edits from ``state`` on, and the state they end in."""
        rest, letters = len(symbols) % self.block, []
        behind = self.behind_blocks(symbols, last)[0]
        for k, at in enumerate(behind):
            start = k if k < rest else rest + (k - rest) * self.block
            part = symbols[start:start + (1 if k < rest else self.block)]
            inner = [at]
            for sym in part[:0:-1]:
                inner.append(self.steps[inner[-1]][sym][0])
            for sym, vector in zip(part, reversed(inner)):
                found, low = self.steps[vector][sym]
                after, here = self.vectors[vector], [c + low for c in self.vectors[found]]
                kind, late = divmod(sym - 1, 2)
                while True:
                    kept = KEPT[state][kind] if sym else None
                    if after[state] + DELETE == here[state]:
                        letters.append("D")
                    elif here[ADDED[state]] + INSERT == here[state]:
                        letters.append("I")
                        state = ADDED[state]
                        continue
                    elif kept is not None and after[kept] + late * UNFINISHED == here[state]:
                        letters.append("K")
                        state = kept
                    else:
                        letters.append("R")
                        state = ADDED[state]
                    break
        return "".join(letters), state


@lru_cache(maxsize=4)
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


def initial(role: str | None) -> str:
    return " " if role is None else role[:1]


def fault(text: str | None) -> int:
    """Whether a turn is blank or unfinished by itself."""
    seen = (text or "").rstrip(SPACES)
    return BLANK if not seen else SOUND if seen.endswith(ENDS) else TRUNCATED


class Conversation:
    """One conversation read chunk by chunk: its counts, edits and repaired turns."""

    def __init__(self, block: int):
        self.tables, self.state, self.place = tables(block), 0, 0
        self.low = self.high = self.turn = self.before = None
        self.distinct = self.illegal = self.cost = 0
        self.count, self.letters, self.hash = [0] * 4, [], hashlib.sha256()

    def add(self, order: list, roles: list, texts: list, faults: bytes, last: int) -> list[tuple]:
        """Repaired turns of a chunk as (place, edit, role, text), given the vector behind it."""
        for turn in order:
            if turn is not None:
                self.distinct += turn != self.turn
                self.turn = self.high = turn
                self.low = turn if self.low is None else self.low
        first = [initial(r) for r in roles]
        for here in first:
            self.illegal += self.before is not None and self.before + here not in LEGAL
            self.before = here
        for kind in range(4):
            self.count[kind] += faults.count(kind)
        letters, end = self.tables.trace(bytes(map(symbol, first, faults)), self.state, last)
        rows, k = [], 0
        for letter in letters:
            if letter == "I":
                rows.append(self._turn(letter, None, ""))
                continue
            if letter != "D":
                self.cost += UNFINISHED * (faults[k] == TRUNCATED)
                rows.append(self._turn(letter, roles[k], texts[k]))
            k += 1
        self._note(letters)
        assert self.state == end
        return rows

    def _note(self, letters: str) -> None:
        self.letters.append(letters)
        self.cost += DELETE * letters.count("D") + INSERT * letters.count("I") + REROLE * letters.count("R")

    def _turn(self, letter: str, role: str | None, text: str | None) -> tuple:
        self.state = KEPT[self.state][INITIALS[initial(role)]] if letter == "K" else ADDED[self.state]
        role = (" " if role is None else role) if letter == "K" else ROLE[self.state]
        text = " " if text is None else text
        self.hash.update(f"{chr(10) * (self.place > 0)}{role}:{text}".encode())
        self.place += 1
        return self.place - 1, letter, role, text

    def close(self) -> list[tuple]:
        """Turns to insert behind the last one."""
        missing = "I" * ((2 if self.state == 1 else 1) if self.state in (1, 2) else 0)
        rows = [self._turn(letter, None, "") for letter in missing]
        self._note(missing)
        return rows

    def report(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (gaps, *self.count[1:], self.illegal, self.cost, "".join(self.letters), self.hash.hexdigest())


REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
TURNS = "place long, edit string, role string, text string"
PARTS = "chunk long, orders array<bigint>, roles array<string>, texts array<string>, faults binary, digests array<binary>"


def _emit(out: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)


def _flushed(out: pa.Schema, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of bounded rows and characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) if isinstance(v, (str, bytes)) else sum(map(len, filter(None, v))) if isinstance(v, list) and v and isinstance(v[0], (str, bytes)) else 8 for v in row if v is not None)
        if len(held) >= FLUSH or size >= CHUNK_CHARS:
            yield _emit(out, held)
            held, size = [], 0
    if held:
        yield _emit(out, held)
    give_back_memory()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _chunks(rows: Iterator[tuple], turns: int, chars: int) -> Iterator[tuple]:
    """(key, orders, roles, texts, whole) of consecutive rows; whole: all of a conversation for certain."""
    key, begun, first, fresh = None, False, True, True
    orders, roles, texts, size = [], [], [], 0
    for own, order, role, text, present in rows:
        if begun and own != key:
            yield key, orders, roles, texts, fresh and not first
            first, fresh = False, True
            orders, roles, texts, size = [], [], [], 0
        elif len(orders) >= turns or size >= chars:
            yield key, orders, roles, texts, False
            fresh = False
            orders, roles, texts, size = [], [], [], 0
        key, begun = own, True
        if present:
            orders.append(order)
            roles.append(role)
            texts.append(text)
            size += len(text or "") + len(role or "")
    if begun:
        yield key, orders, roles, texts, False


def _own_faults(roles: list, texts: list) -> bytearray:
    """Faults of the turns of a chunk, by what this chunk tells."""
    seen, out = set(), bytearray()
    for pair in zip(roles, texts):
        kind = fault(pair[1])
        if kind != BLANK:
            known = (" " if pair[0] is None else pair[0], " " if pair[1] is None else pair[1])
            kind = DUPLICATE if known in seen else kind
            seen.add(known)
        out.append(kind)
    return out


def _digest(key, role: str | None, text: str | None) -> bytes:
    parts = ["-" if key is None else f"+{key}", " " if role is None else role, " " if text is None else text]
    return hashlib.blake2b("".join(f"{len(p)}:{p}" for p in parts).encode(), digest_size=16).digest()


def repair(
    rows: DataFrame, turns: bool = False, present: Column | None = None, key: str = "conv_id", order: str = "turn",
    role: str = "role", text: str = "text", block: int = BLOCK, chunk_turns: int = CHUNK_TURNS, chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """Structure faults and cheapest repair of every conversation, or with ``turns`` its repaired turns.

    One row for each value of ``key`` (null is one): ``gaps`` (turn numbers missing between the
    smallest and the largest), ``blank``, ``duplicate`` and ``truncated`` turns (the first of these
    faults counts), ``illegal`` neighbours, ``cost``, ``audit`` (letters Keep, Rerole, Delete, Insert) and
    ``repaired_sha256``. With ``turns`` one row for each turn left: ``place`` from 0, ``edit``, ``role``
    and ``text``.

    Turns are taken by ``order``, null first; those of one number by role and then a hash of the
    text, so repeated rows are neighbours. Null roles and texts are one space. Rows where ``present`` is
    not true only name their conversation, which then has an empty repair. An empty table gives no rows.
    Other columns are not read. Rerole and Insert give ``user`` and ``assistant``; a kept role needs
    only the initial. The audit and the hash of one conversation are one value each; its turns pass
    the last task as a stream.
    """
    spark = rows.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    kind = dict(rows.dtypes)[key]
    result = f"`{key}` {kind}, {TURNS if turns else REPORT}"
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    named = rows.select(
        F.col(key).alias("key"), F.when(here, F.col(order).cast("long")).alias("order"),
        F.when(here, F.col(role)).alias("role"), F.when(here, F.col(text)).alias("text"), here.alias("present"),
        F.monotonically_increasing_id().alias("line"),
    )
    by = [F.col("key").asc_nulls_first(), F.col("order").asc_nulls_first(), F.col("role").asc_nulls_first(), F.xxhash64("text"), F.col("line")]
    ranged = named.repartitionByRange(*by).sortWithinPartitions(*by).drop("line")
    width = len(TURNS.split(",")) if turns else len(REPORT.split(","))

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    def results(own, talk: Conversation, repaired: list[tuple], closed: bool) -> Iterator[tuple]:
        if turns:
            yield from ((own, *row) for row in repaired)
        elif closed:
            yield own, *talk.report()

    first_out = to_arrow_schema(StructType.fromDDL(f"whole boolean, {result}, {PARTS}"))

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def run() -> Iterator[tuple]:
            number = TaskContext.get().partitionId() << 33
            for own, orders, roles, texts, whole in _chunks(_rows(batches), chunk_turns, chunk_chars):
                faults = _own_faults(roles, texts)
                if whole:
                    talk = Conversation(block)
                    repaired = talk.add(orders, roles, texts, bytes(faults), 0)
                    for row in results(own, talk, repaired + talk.close(), True):
                        yield True, *row, *(None,) * 6
                else:
                    marks = [_digest(own, r, t) if f not in (BLANK, DUPLICATE) else None for r, t, f in zip(roles, texts, faults)]
                    yield False, own, *(None,) * width, number, orders, roles, texts, bytes(faults), marks
                    number += 1

        yield from _flushed(first_out, run())

    table = stage(ranged.mapInArrow(chunked, f"whole boolean, {result}, {PARTS}"), "turns")
    whole = table.where("whole").select(key, *[f.name for f in first_out][2:2 + width])
    cut = table.where("not whole").select(F.col(key).alias("key"), *[p.split()[0] for p in PARTS.split(", ")])

    # Turns that an earlier chunk holds already.
    marks = cut.select("chunk", F.posexplode("digests").alias("at", "digest")).where("digest is not null")
    place = F.struct("chunk", "at")
    firsts = marks.groupBy("digest").agg(F.min(place).alias("first"))
    late = marks.join(firsts, "digest").where(place > F.col("first")).groupBy("chunk").agg(F.sort_array(F.collect_list("at")).alias("late"))

    def marked(faults: bytes, late: list[int] | None) -> bytes:
        faults = bytearray(faults)
        for at in late or ():
            faults[at] = DUPLICATE
        return bytes(faults)

    known = cut.join(late, "chunk", "left")
    narrow = known.select("key", "chunk", F.transform("roles", lambda r: F.substring(F.coalesce(r, F.lit(" ")), 1, 1)).alias("first"), "faults", "late")
    behind_out = to_arrow_schema(StructType.fromDDL("chunk long, late array<int>, behind int"))

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run() -> Iterator[tuple]:
            held, at, started = None, 0, False
            for own, chunk, first, faults, late in _rows(batches):
                if not started or own != held:
                    held, at, started = own, 0, True
                yield chunk, late, at
                at = tables(block).behind_blocks(bytes(map(symbol, first, marked(faults, late))), at)[1]

        yield from _flushed(behind_out, run())

    behind = stage(
        narrow.repartition("key").sortWithinPartitions("key", F.desc("chunk")).mapInArrow(backward, "chunk long, late array<int>, behind int"),
        "behind",
    )
    last_out = to_arrow_schema(StructType.fromDDL(result))

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run() -> Iterator[tuple]:
            held, talk = None, None
            for own, _, orders, roles, texts, faults, late, at in _rows(batches):
                if talk is None or own != held:
                    if talk is not None:
                        yield from results(held, talk, talk.close(), True)
                    held, talk = own, Conversation(block)
                repaired = talk.add(orders, roles, texts, marked(faults, late), at)
                yield from results(held, talk, repaired, False)
            if talk is not None:
                yield from results(held, talk, talk.close(), True)

        yield from _flushed(last_out, run())

    chained = cut.drop("digests").join(behind, "chunk").select("key", "chunk", "orders", "roles", "texts", "faults", "late", "behind")
    joined = chained.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(forward, result)
    return whole.unionByName(joined)
