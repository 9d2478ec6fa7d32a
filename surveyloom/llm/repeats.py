"""Substring deduplication over prefix-partitioned suffix groups.

Every run of ``window`` words starts a suffix. Suffixes are split into memory-sized groups by a
prefix of one or more words: prefixes that a sample shows to be overfull are made a word longer,
again and again. A group holds whole subtrees of the suffix tree, cut at the depth of the window;
its suffixes are sorted by the hash of their window, and each node with several documents below is
a repeat. All its windows outside the smallest document go; adjoining ones make the maximal repeat.

Suffixes that repeat inside one slice of the input are settled there, and only those of the slice's
smallest document are sent on, so a passage found everywhere costs one record a slice.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import CACHES, map_batches, stage

# Words of a window, and suffixes aimed at in a group.
WINDOW = 13
GROUP_SUFFIXES = 600_000
# Documents that show which prefixes are overfull (expected number), and their longest prefix.
SAMPLE_DOCUMENTS = 2_000
LONGEST_PREFIX = 4
# Removal lists up to this many bytes are sent to all tasks; longer ones are joined by a shuffle.
BROADCAST_BYTES = 24 << 20
# Distinct words whose hash a Python worker remembers during a task; beyond that it starts afresh.
REMEMBERED = 150_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()
CACHES.append(_hashes)


def _odd(count: int, seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{seed}:{k}") | 1 for k in range(count)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _grams(words: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on (as many as there are positions for it)."""
    count = max(0, len(words) - length + 1)
    total = np.zeros(count, np.uint64)
    for k, factor in enumerate(_odd(length, seed)):
        total += _mixed(words[k:k + count] + factor) * factor
    return _mixed(total)


def split_words(text: str | None) -> list[bytes]:
    """Words of a text: longest runs without ASCII white space."""
    return (text or "").encode().split()


def _hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and the number of words of each."""
    parts = [split_words(t) for t in texts]
    counts = np.array([len(p) for p in parts], np.int64)
    words = np.fromiter((h for p in parts for h in map(_hashes.__getitem__, p)), np.uint64, int(counts.sum()))
    return words, counts


def _starts(counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place in the row of words, text and word number of every window that lies in one text."""
    per = np.maximum(0, counts - window + 1)
    owner = np.repeat(np.arange(len(counts)), per)
    position = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    return np.repeat(np.cumsum(counts) - counts, per) + position, owner, position


def _prefix(words: np.ndarray, at: np.ndarray, overfull: list[np.ndarray]) -> np.ndarray:
    """Hash of the shortest prefix of each suffix that is not overfull."""
    found = _grams(words, 1, 1)[at]
    open_ = np.arange(len(at))
    for length in range(2, LONGEST_PREFIX + 1):
        previous = overfull[length - 2]
        if not len(previous):
            break
        slot = np.minimum(np.searchsorted(previous, found[open_]), len(previous) - 1)
        open_ = open_[previous[slot] == found[open_]]
        if not len(open_):
            break
        found[open_] = _grams(words, length, length)[at[open_]]
    return found


def overfull_prefixes(docs: DataFrame, text: str, groups: int, window: int, documents: int, count: int) -> list[np.ndarray]:
    """Sorted hashes of the prefixes of 1, 2, ... words that hold over a quarter of a group's share.

    At most 4 * ``groups`` of each length can, which bounds what is collected.
    """
    draw = F.pmod(F.xxhash64(text), F.lit(1 << 40))
    drawn = docs.where(draw < F.lit(int((1 << 40) * min(1.0, documents / max(1, count)))))

    def work(columns: list[list]) -> list:
        words, counts = _hashed(columns[0])
        at = _starts(counts, window)[0]
        out = [], [], []
        for length in range(1, LONGEST_PREFIX):
            gram, n = np.unique(_grams(words, length, length)[at], return_counts=True) if len(at) else (at, at)
            for own, part in zip(out, (np.full(len(gram), length), gram.astype(np.int64), n)):
                own.append(part)
        return [np.concatenate(o) for o in out]

    counted = map_batches(drawn.select(text), work, "length int, gram long, n long", text)
    counted = stage(counted.groupBy("length", "gram").agg(F.sum("n").alias("n")), "prefixes")
    total = counted.where("length = 1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = counted.where(F.col("n") > total / (4 * groups)).collect()
    return [
        np.sort(np.array([r["gram"] for r in rows if r["length"] == length], np.int64).astype(np.uint64))
        for length in range(1, LONGEST_PREFIX)
    ]


def _pack(*parts: np.ndarray) -> bytes:
    return b"".join(np.int64(len(p)).tobytes() + np.ascontiguousarray(p).tobytes() for p in parts)


def _unpack(data: bytes, *kinds: type) -> Iterator[np.ndarray]:
    at = 0
    for kind in kinds:
        n = int(np.frombuffer(data, np.int64, 1, at)[0])
        yield np.frombuffer(data, kind, n, at + 8)
        at += 8 + n * np.dtype(kind).itemsize


def _settle(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a smaller document has the same window, in sorted order of windows, and that order."""
    order = np.argsort(hashes, kind="stable")
    ordered, own = hashes[order], docs[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    least = np.repeat(np.minimum.reduceat(own, first), np.diff(np.append(first, len(own))))
    return own > least, order


def repeated_words(docs: DataFrame, key: str, text: str, window: int = WINDOW, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """Columns ``row`` and ``cuts``: word intervals to remove (pairs of 32-bit numbers) per row.

    ``docs`` has columns ``row`` (consecutive inside a partition), ``key`` (long) and ``text``.
    """
    size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    groups = max(16, math.ceil(size[1] / 6 / group_suffixes))
    overfull = overfull_prefixes(docs, text, groups, window, SAMPLE_DOCUMENTS, size[0])

    def suffixes(columns: list[list]) -> list | None:
        rows, keys, texts = columns
        words, counts = _hashed(texts)
        at, owner, position = _starts(counts, window)
        if not len(at):
            return None
        ids = np.array([0 if k is None else k for k in keys], np.int64)
        named = np.array([k is not None for k in keys])[owner]
        at, owner, position = at[named], owner[named], position[named]
        if not len(at):
            return None
        hashes = _grams(words, window, 99)[at]
        gone, order = _settle(hashes, ids[owner])
        local = np.zeros(len(at), bool)
        local[order] = gone
        group = (_prefix(words, at, overfull) % np.uint64(groups)).astype(np.int64)
        by_group = np.argsort(group.astype(np.uint16) if groups < 1 << 16 else group, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], np.diff(group[by_group]) != 0, [True]]))
        found, blobs = [], []
        for a, b in zip(edges[:-1], edges[1:]):
            own = by_group[a:b]
            sent, done = own[~local[own]], own[local[own]]
            texts_here, n = np.unique(owner[sent], return_counts=True)
            found.append(int(group[own[0]]))
            blobs.append(_pack(
                texts_here.astype(np.uint32), ids[texts_here], n.astype(np.uint32), position[sent].astype(np.uint32),
                hashes[sent], owner[done].astype(np.uint32), position[done].astype(np.uint32),
            ))
        return [[rows[0]] * len(found), found, blobs]

    sent = map_batches(docs.select("row", key, text), suffixes, "slice long, part int, blob binary", text)

    def subtrees(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [list(_unpack(b, np.uint32, np.int64, np.uint32, np.uint32, np.uint64, np.uint32, np.uint32)) for b in frame["blob"]]
        texts = np.concatenate([np.repeat(p[0], p[2]) for p in parts])
        ids = np.concatenate([np.repeat(p[1], p[2]) for p in parts])
        position, hashes = np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts])
        origin = np.repeat(np.arange(len(parts)), [len(p[3]) for p in parts])
        gone = np.zeros(len(hashes), bool)
        if len(hashes):
            late, order = _settle(hashes, ids)
            gone[order] = late
        out = []
        for k, p in enumerate(parts):
            mine = np.flatnonzero(gone & (origin == k)) if len(parts) < 8 else None
            if mine is None:
                lo, hi = np.searchsorted(origin, [k, k + 1])
                mine = lo + np.flatnonzero(gone[lo:hi])
            out.append(_pack(np.concatenate([texts[mine], p[5]]), np.concatenate([position[mine], p[6]])))
        result = pd.DataFrame({"slice": frame["slice"], "blob": out})
        return result[result["blob"].str.len() > 16]

    answers = sent.groupBy("part").applyInPandas(subtrees, "slice long, blob binary")

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        pairs = [list(_unpack(b, np.uint32, np.uint32)) for b in frame["blob"]]
        code = np.unique(np.concatenate([(t.astype(np.uint64) << np.uint64(32)) + p for t, p in pairs]))
        owner, start = (code >> np.uint64(32)).astype(np.int64), (code & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # A run of windows whose words touch makes one interval.
        new = np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(start) > window)])
        at = np.flatnonzero(new)
        cuts = np.stack([start[at], start[np.append(at[1:], len(start)) - 1] + window], 1).astype(np.uint32)
        edges = np.flatnonzero(np.concatenate([[True], np.diff(owner[at]) != 0, [True]]))
        base = int(frame["slice"].iloc[0])
        return pd.DataFrame({
            "row": [base + int(owner[at[a]]) for a in edges[:-1]],
            "cuts": [cuts[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])],
        })

    return stage(answers.groupBy("slice").applyInPandas(gather, "row long, cuts binary"), "cuts")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with columns ``n_words``, ``n_removed`` and ``kept`` added (or put in the place of such).

    ``kept`` is the words left over, joined by single spaces. A word goes if a window of ``window``
    words that covers it also starts in a document with a smaller key; windows are judged on the
    input. Repeats inside one document and between rows of equal keys stay. Null and empty texts
    have no words. Rows with a null key keep all words and are earlier than none. Windows are
    compared by a 64-bit hash inside groups that are split by another hash of their first words.
    """
    docs = docs.drop("n_words", "n_removed", "kept")
    own, found = f"_row_{uuid.uuid4().hex}", f"_cuts_{uuid.uuid4().hex}"
    numbered = docs.withColumn(own, F.monotonically_increasing_id())
    source = numbered.select(F.col(own).alias("row"), F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    cuts = repeated_words(source, "key", "text", window)
    held = cuts.agg(F.coalesce(F.sum(F.length("cuts") + 16), F.lit(0))).first()[0]
    cuts = cuts.select(F.col("row").alias(own), F.col("cuts").alias(found))
    joined = numbered.join(F.broadcast(cuts) if held <= BROADCAST_BYTES else cuts, own, "left").drop(own)

    from pyspark.sql.pandas.types import to_arrow_schema

    kept_types = [f.type for f in to_arrow_schema(docs.schema)]
    at = docs.columns.index(text)

    def work(columns: list[list]) -> list:
        n_words, n_removed, kept = [], [], []
        for value, cut in zip(columns[at], columns[-1]):
            words = split_words(value)
            n_words.append(len(words))
            if cut:
                left, end = [], 0
                for a, b in np.frombuffer(cut, np.uint32).reshape(-1, 2).tolist():
                    left += words[end:a]
                    end = b
                words = left + words[end:]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode())
        return [*(pa.array(c, t) for c, t in zip(columns, kept_types)), n_words, n_removed, kept]

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(joined, work, f"{kinds}, n_words long, n_removed long, kept string", text)
