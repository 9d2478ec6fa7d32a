"""Packing tokenized documents into fixed-length sequences, certified by lower bounds.

Documents are cut into pieces of at most one sequence. Full pieces are sequences by themselves;
the others are dealt into partitions of bounded size and packed by best-fit decreasing. Dual
feasible functions bound from below the number of sequences that the pieces of a partition need.
A partition that meets its bound keeps its sequences but for its emptiest one; a partition with a
gap keeps its full sequences only. What is not kept goes to the next round, where pieces of
different partitions meet anew.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import map_batches, stage
from surveyloom.llm.tokens import word_coder

# Pieces packed together in one task.
PARTITION_PIECES = 4096
# Rounds of exchange; pieces that are open after the last one keep their places.
ROUNDS = 4


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of every document: ``key``, ``piece``, ``start``, ``length``, ``ids`` (binary).

    A document is its text's ids and then ``end_id``; a null or empty text is ``end_id`` alone.
    ``ids`` holds little-endian unsigned 32-bit numbers. Repeated rows are documents of their own.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    import pyarrow as pa

    source = docs.select(key, text)
    kind = source.schema[0].dataType
    key_type, last = to_arrow_type(kind), end_id.to_bytes(4, "little")

    def work(columns: list[list]) -> list:
        coder = word_coder(vocabulary)
        keys, piece, start, length, ids = [], [], [], [], []
        for owner, data in zip(columns[0], columns[1]):
            data = coder.encode(data or "").tobytes() + last
            for k, at in enumerate(range(0, len(data), 4 * capacity)):
                part = data[at:at + 4 * capacity]
                keys.append(owner)
                piece.append(k)
                start.append(at // 4)
                length.append(len(part) // 4)
                ids.append(part)
        return [pa.array(keys, key_type), piece, start, length, ids]

    return map_batches(
        source, work, f"`{key}` {kind.simpleString()}, piece int, start long, length long, ids binary", text
    )


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Most sequences that any of the dual feasible functions proves necessary.

    Two families are tried: for every e up to half the capacity, lengths over capacity - e count
    whole and lengths under e not at all; for k up to 20, lengths are rounded down to k-ths of a
    sequence where (k + 1) times the length is no multiple of the capacity.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)
    tokens = count * np.arange(capacity + 1)
    below, summed = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(tokens)])
    e = np.arange(0, capacity // 2 + 1)
    whole = below[capacity + 1] - below[capacity - e + 1]
    middle = summed[capacity - e + 1] - summed[e]
    best = int((whole + -(-middle // capacity)).max())
    size = np.arange(capacity + 1)
    for k in range(1, 21):
        # Values in units of 1 / (k * capacity).
        value = np.where((k + 1) * size % capacity == 0, size * k, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every length (given in decreasing order), and how full each bin gets."""
    bins, offsets, fill = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if some bin has r tokens of room
    for k, length in enumerate(lengths.tolist()):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(fill)
            fill.append(0)
        bins[k], offsets[k] = at, fill[at]
        fill[at] += length
        room -= length
        if room:
            by_room.setdefault(room, []).append(at)
            rooms |= 1 << room
    return bins, offsets, np.array(fill, np.int64)


def _fitter(capacity: int, turn: int, keep_all: bool, alone: bool):
    """Packer of one partition in round ``turn``; ``alone``: no other partition to exchange with."""

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "_row"], ascending=[False, True], ignore_index=True)
        lengths = frame["length"].to_numpy()
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        bound, kept = lower_bound(lengths, capacity), fill == capacity
        if len(fill) == bound:
            kept |= np.arange(len(fill)) != fill.argmin()
        if keep_all or alone and len(fill) == bound:
            kept[:] = True
        first = (turn << 52) + (int(frame["_part"].iloc[0]) << 20)
        return frame.drop(columns="_part").assign(
            sequence_id=(first + bins) * 2 + 1, offset=offsets, part_sequences=len(fill), part_bound=bound, kept=kept[bins],
        )

    return fit


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, key: str = "doc_id", text: str = "text",
    derive: dict[str, Column] | None = None, keep_ids: bool = False, partition_pieces: int = PARTITION_PIECES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Place of every piece: ``key``, ``piece``, ``start``, ``length``, ``sequence_id``, ``offset``.

    ``derive`` adds columns computed from ``ids``; ``keep_ids`` keeps ``ids`` themselves. Further
    columns ``part_sequences`` and ``part_bound`` show how many sequences the piece's partition
    used and how many it needs at least. An empty table gives no rows. Pieces and not documents are
    dealt out, by a row number written with them, so neither a very long document nor many rows of
    one key make a large partition; retried tasks read the same numbers.
    """
    pieces = token_pieces(docs, vocabulary, capacity, end_id, key, text).withColumns(derive or {})
    pieces = stage(
        pieces.drop(*([] if keep_ids else ["ids"])).withColumn("_row", F.monotonically_increasing_id()), "pieces"
    )
    own = [c for c in pieces.columns if c != "_row"]
    done = pieces.where(F.col("length") == capacity).select(
        *own, (F.col("_row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(1).cast("long").alias("part_sequences"), F.lit(1).cast("long").alias("part_bound"),
    )
    left = pieces.where(F.col("length") < capacity)
    count = left.count()
    result = "sequence_id long, offset long, part_sequences long, part_bound long, kept boolean"

    for turn in range(rounds):
        if not count:
            break
        parts = math.ceil(count / partition_pieces)

        dealt = left.withColumn("_part", F.pmod(F.xxhash64(F.col("_row"), F.lit(turn)), F.lit(parts)))
        names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema)
        fit = _fitter(capacity, turn, keep_all=turn == rounds - 1, alone=parts == 1)
        packed = stage(dealt.groupBy("_part").applyInPandas(fit, f"{names}, {result}"), "packed")
        done = done.unionByName(packed.where("kept").drop("_row", "kept"))
        left = packed.where("not kept").select(*own, "_row")
        count = left.count()
    return done
