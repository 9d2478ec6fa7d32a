"""Language-model scores by a small causal self-attention model over subword ids.

The model predicts the next subword as a mixture of four distributions: three that the whole
training corpus is counted for (subword, subword after one, subword after two) and one that points
back at the subwords of the window with the attention weights. Masked attention over the window
gives the state that sets the mixture's weights. Embeddings, attention and mixture are trained in
numpy, on every window of all training documents, by one trainer for every slice of the documents;
their weights are averaged. No count is left out: every slice sends its own subwords and contexts, with
their counts, by one shuffle, and is answered with the sums. Texts are scored in overlapping windows: every window sees the last subwords of the one
before it and scores only its own, so each subword is scored once.

A second, exact reference score counts whole words over all training documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from surveyloom.llm.common import map_batches, release, stage, unstage
from surveyloom.llm.repeats import _hashes, _pack, _unpack
from surveyloom.llm.tokens import word_coder

# Subwords that a window scores, and that it sees at most.
STEP, WINDOW = 16, 32
# Width of the embeddings, and rows that subwords share by their id.
WIDTH, ROWS = 8, 4096
# Subwords aimed at in a slice.
SLICE_SUBWORDS = 1_000_000
BATCH, LEARNING_RATE = 64, 0.02
# Characters or bytes of ids in a slice, also where subwords are counted, and entries aimed at in a part.
SLICE, COUNT_SLICE = 4_000_000, 8_000_000
PART = 4_000_000
EXPERTS = 4
LIMIT = 1 << 16
# Windows scored at a time: their attention weights stay in the processor's cache.
SCORED = 256
# Attention scores up to this size need no largest one taken off before their exponential.
STEEP = 20
# What every kept count gives up to the shorter context.
DISCOUNT = 0.75


# ---------------------------------------------------------------- whole-word reference


def word_scores(docs: DataFrame, text: str) -> tuple[DataFrame, int]:
    """Per ``row``: words, words seen in training, sum of log10(count + 0.5); and distinct training words.

    ``docs`` has ``row`` (consecutive inside a partition), ``trained`` (boolean) and ``text``. Every
    slice sends its distinct words once, with their training count and the documents that use them;
    so a common word costs a part one record a slice. Words are compared by a 64-bit hash.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    parts = max(8, math.ceil(size / 60 / PART * 8))

    def gather(columns: list[list]) -> list | None:
        rows, trained, texts = columns
        split = [(t or "").encode().lower().split() for t in texts]
        counts = np.array([len(s) for s in split], np.int64)
        words = np.fromiter((h for s in split for h in map(_hashes.__getitem__, s)), np.uint64, int(counts.sum()))
        if not len(words):
            return None
        owner = np.repeat(np.arange(len(split)), counts)
        distinct, code = np.unique(words, return_inverse=True)
        pair, times = np.unique(code * len(split) + owner, return_counts=True)
        word, doc = pair // len(split), pair % len(split)
        learnt = np.bincount(word, times * np.array(trained, np.int64)[doc], len(distinct)).astype(np.uint32)
        part = (distinct >> np.uint64(20)) % np.uint64(parts)
        found, blobs = [], []
        edges = np.searchsorted(word, np.arange(len(distinct) + 1))
        by = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[by], np.arange(parts + 1, dtype=np.uint64))
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            own = by[cuts[p]:cuts[p + 1]]
            uses = edges[own + 1] - edges[own]
            at = np.repeat(edges[own] - np.cumsum(uses) + uses, uses) + np.arange(uses.sum())
            found.append(p)
            blobs.append(_pack(distinct[own], learnt[own], uses.astype(np.uint32), doc[at].astype(np.uint32), times[at].astype(np.uint32)))
        return [[rows[0]] * len(found), found, blobs]

    def resolve(frame: pd.DataFrame) -> pd.DataFrame:
        slices = [list(_unpack(b, np.uint64, np.uint32, np.uint32, np.uint32, np.uint32)) for b in frame["blob"]]
        known, code = np.unique(np.concatenate([s[0] for s in slices]), return_inverse=True)
        counts = np.bincount(code, np.concatenate([s[1] for s in slices]), len(known))
        value, out, at = np.log10(counts + 0.5), [], 0
        for words, _, uses, doc, times in slices:
            own = np.repeat(code[at:at + len(words)], uses)
            at += len(words)
            docs_here, index = np.unique(doc, return_inverse=True)
            out.append(_pack(
                docs_here, np.bincount(index, times * value[own]), np.bincount(index, times * (counts[own] > 0)),
            ))
        distinct = [int((counts > 0).sum())] + [0] * (len(out) - 1)
        return pd.DataFrame({"slice": frame["slice"], "distinct": distinct, "blob": out})

    sent = map_batches(docs.select("row", "trained", text), gather, "slice long, part int, blob binary", text, SLICE)
    resolved = stage(sent.groupBy("part").applyInPandas(resolve, "slice long, distinct long, blob binary"), "words")
    distinct = resolved.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]

    def collect(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [list(_unpack(b, np.uint32, np.float64, np.float64)) for b in frame["blob"]]
        docs_here, index = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return pd.DataFrame({
            "row": int(frame["slice"].iloc[0]) + docs_here.astype(np.int64),
            "logs": np.bincount(index, np.concatenate([p[1] for p in parts])),
            "known": np.bincount(index, np.concatenate([p[2] for p in parts])).astype(np.int64),
        })

    release(docs.sparkSession)
    logs = stage(resolved.groupBy("slice").applyInPandas(collect, "row long, logs double, known long"), "logs")
    unstage(resolved)
    del sent, resolved
    release(docs.sparkSession)
    return logs, distinct


# ---------------------------------------------------------------- subword counts


def subwords(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``row``, ``key``, ``trained``, ``n`` and ``n_tokens`` (subwords and words, with the end) and ``ids`` (16-bit numbers)."""
    kind = docs.schema["key"].dataType
    key_type = to_arrow_type(kind)

    def work(columns: list[list]) -> list:
        coder, (rows, keys, trained, texts) = word_coder(vocabulary), columns
        ids = [coder.encode(t or "").astype(np.uint16).tobytes() for t in texts]
        words = [len((t or "").encode().split()) + 1 for t in texts]
        return [rows, pa.array(keys, key_type), trained, [len(i) // 2 + 1 for i in ids], words, ids]

    schema = f"row long, key {kind.simpleString()}, trained boolean, n long, n_tokens long, ids binary"
    return map_batches(docs.select("row", "key", "trained", "text"), work, schema, "text")


def _lines(ids: list[bytes], start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All documents in a row, each between its start and end id, and the length of each."""
    first, last = np.uint16(start).tobytes(), np.uint16(end).tobytes()
    line = np.frombuffer(b"".join([first + i + last for i in ids]), np.uint16)
    return line, np.array([len(i) // 2 + 2 for i in ids], np.int64)


def _targets(line: np.ndarray, lengths: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places to be predicted, their document, and the two subwords before (the start id fills in)."""
    real = np.ones(len(line), bool)
    begin = np.cumsum(lengths) - lengths
    real[begin] = False
    at = np.flatnonzero(real)
    before = line[at - 1].astype(np.int64)
    second = np.where(before == start, start, line[np.maximum(at - 2, 0)].astype(np.int64))
    return at, np.repeat(np.arange(len(lengths)), lengths - 1), before, second


def _squeeze(*parts: np.ndarray, level: int = 1) -> bytes:
    """Arrays as one compressed value, the same byte of all their numbers together."""
    planes = [np.ascontiguousarray(p.view(np.uint8).reshape(-1, p.itemsize).T).ravel() for p in map(np.ascontiguousarray, parts)]
    raw = _pack(*planes)
    return np.int64(len(raw)).tobytes() + pa.Codec("zstd", level).compress(raw, asbytes=True)


def _expand(data: bytes, *kinds: type) -> Iterator[np.ndarray]:
    raw = pa.Codec("zstd").decompress(memoryview(data)[8:], int(np.frombuffer(data, np.int64, 1)[0]), asbytes=True)
    for kind, planes in zip(kinds, _unpack(raw, *[np.uint8] * len(kinds))):
        yield np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).ravel().view(kind)


def _distinct(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys (below 2**bits) and the place of each key among them."""
    low = len(keys).bit_length()
    if bits + low > 63:
        return np.unique(keys, return_inverse=True)
    ordered = np.sort(keys << low | np.arange(len(keys)))  # key and place sort as one number
    at = ordered & ((1 << low) - 1)
    ordered >>= low
    first = np.ones(len(keys), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(keys), np.int64)
    place[at] = np.cumsum(first) - 1
    return ordered[first], place


def _part(keys: np.ndarray, order: int, parts: int) -> np.ndarray:
    """Part of each key: whole contexts are together."""
    return (keys >> 16 if order else keys) * 0x9E3779B1 % 0x7FFFFFFF % parts


def count_table(tokens: DataFrame, order: int, start: int, end: int, parts: int) -> DataFrame:
    """Counts of every subword after ``order`` others over all training documents, by parts.

    A part holds whole contexts (single subwords for order 0); per ``part`` ``keys`` (context and
    subword, 48 bits) and ``counts``.
    """

    def gather(columns: list[list]) -> list | None:
        line, lengths = _lines(columns[0], start, end)
        at, _, before, second = _targets(line, lengths, start)
        if order:
            context = (second << 16 | before) if order == 2 else before
            keys, counts = np.unique(context << 16 | line[at].astype(np.int64), return_counts=True)
        else:
            keys = np.flatnonzero(counts := np.bincount(line[at]))
            counts = counts[keys]
        part = _part(keys, order, parts)
        by = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[by], np.arange(parts + 1))
        found = [p for p in range(parts) if edges[p] < edges[p + 1]]
        picks = [by[edges[p]:edges[p + 1]] for p in found]
        return [found, [_pack(keys[i], counts[i].astype(np.uint32)) for i in picks]]

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        slices = [list(_unpack(b, np.int64, np.uint32)) for b in frame["blob"]]
        keys, code = np.unique(np.concatenate([s[0] for s in slices]), return_inverse=True)
        counts = np.bincount(code, np.concatenate([s[1] for s in slices])).astype(np.int64)
        return pd.DataFrame({"part": frame["part"].iloc[:1].tolist(), "keys": [keys.tobytes()], "counts": [counts.tobytes()]})

    sent = map_batches(tokens.where("trained").select("ids"), gather, "part int, blob binary", "ids", COUNT_SLICE)
    counted = stage(sent.groupBy("part").applyInPandas(merge, "part int, keys binary, counts binary"), "counts")
    del sent
    release(tokens.sparkSession)
    return counted


def slices(tokens: DataFrame, start: int, end: int, size: int) -> DataFrame:
    """Documents dealt out by their row: ``slice``, ``line`` of subwords and ``about`` (rows, trained, lengths)."""
    def gather(columns: list[list]) -> list:
        rows, trained, ids = columns
        line, lengths = _lines(ids, start, end)
        return [rows[:1], [_squeeze(line, level=3)], [_squeeze(np.array(rows, np.int64), np.array(trained, bool), lengths)]]

    dealt = tokens.select("row", "trained", "ids").repartition(max(8, math.ceil(size / SLICE_SUBWORDS)), "row")
    return stage(map_batches(dealt, gather, "slice long, line binary, about binary", "ids", SLICE), "slices")


def _read(line: bytes, about: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return *_expand(line, np.uint16), *_expand(about, np.int64, bool, np.int64)


def _needed(line: np.ndarray, lengths: np.ndarray, order: int, start: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every order up to ``order`` the sorted distinct keys of a slice, and the key of each of its targets."""
    at, _, before, second = _targets(line, lengths, start)
    target = line[at].astype(np.int64)
    pairs, place = _distinct(before << 16 | target, 32)
    if order == 1:
        return [(pairs, place)]
    # The context of a triple is the pair before it; that of the first targets lies between two pairs.
    outer = start << 16 | start
    rank = np.empty(len(at), np.int64)
    rank[1:] = 2 * place[:-1] + 1
    rank[before == start] = 2 * np.searchsorted(pairs, outer)
    ranks, own = _distinct(rank << 16 | target, (2 * len(pairs) + 1).bit_length() + 16)
    context = ranks >> 17
    context = np.where(ranks >> 16 & 1, pairs[np.minimum(context, len(pairs) - 1)], outer)
    return [(pairs, place), (context << 16 | ranks & 65535, own)]


def _by_part(keys: np.ndarray, order: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the sorted keys part by part, and the part of each."""
    part = _part(keys, order, parts)
    by = np.argsort(part.astype(np.uint16) if parts <= LIMIT else part, kind="stable")
    return by, part[by]


def _heads(contexts: np.ndarray) -> np.ndarray:
    """Whether a context differs from the one before it."""
    first = np.ones(len(contexts), bool)
    first[1:] = contexts[1:] != contexts[:-1]
    return first


def answers(sliced: DataFrame, table: DataFrame | None, order: int, start: int, parts: int) -> DataFrame:
    """For the keys of every slice, by part: count, and for each of their contexts total and subwords seen after it.

    Counts are summed over the training documents of all slices, or taken from a ``count_table``.
    """
    def ask(columns: list[list]) -> list:
        out = [], [], []
        for name, line, about in zip(*columns):
            line, _, trained, lengths = _read(line, about)
            keys, place = _needed(line, lengths, order, start)[-1]
            learnt = np.bincount(place[np.repeat(trained, lengths - 1)], minlength=len(keys)).astype(np.uint32)
            by, part = _by_part(keys, order, parts)
            keys, learnt = keys[by], learnt[by]
            edges = np.searchsorted(part, np.arange(parts + 1))
            for k in np.flatnonzero(np.diff(edges)).tolist():
                own = slice(edges[k], edges[k + 1])
                steps = np.diff(keys[own], prepend=0)  # sorted: small numbers
                for column, value in zip(out, (name, k, _squeeze(steps, learnt[own]))):
                    column.append(value)
        return list(out)

    def total(asked: pd.DataFrame, known: pd.DataFrame | None = None) -> pd.DataFrame:
        sent = [tuple(_expand(b, np.int64, np.uint32)) for b in asked["keys"]]
        wanted, learnt = [np.cumsum(steps) for steps, _ in sent], [n for _, n in sent]
        sizes = [len(w) for w in wanted]
        if known is not None:
            learnt = [np.zeros(sum(sizes), np.int64), *(np.frombuffer(b, np.int64) for b in known["counts"])]
            wanted += [np.frombuffer(b, np.int64) for b in known["keys"]]
        if not sizes:
            return pd.DataFrame({"slice": [], "order": [], "part": [], "blob": []})
        keys, code = np.unique(np.concatenate(wanted), return_inverse=True)
        counts = np.bincount(code, np.concatenate(learnt), len(keys)).astype(np.uint32)
        first = _heads(keys >> 16)
        heads, context = np.flatnonzero(first), np.cumsum(first) - 1
        totals = np.add.reduceat(counts, heads, dtype=np.uint32)
        kinds = np.add.reduceat(counts > 0, heads, dtype=np.uint32)
        blobs = []
        for at in np.split(code[:sum(sizes)], np.cumsum(sizes)[:-1]):
            own = context[at]
            own = own[_heads(own)]
            blobs.append(_squeeze(counts[at], totals[own], kinds[own]))
        return pd.DataFrame({"slice": asked["slice"], "order": order, "part": asked["part"], "blob": blobs})

    asked = map_batches(sliced, ask, "slice long, part int, keys binary", "line", 1).groupBy("part")
    schema = "slice long, order int, part int, blob binary"
    if table is not None:
        return stage(asked.cogroup(table.groupBy("part")).applyInPandas(total, schema), "answers")
    return stage(asked.applyInPandas(lambda frame: total(frame), schema), "answers")


class Counts:
    """The three counted distributions, each falling back on the shorter context, for the keys of one slice.

    ``pairs`` and ``triples`` hold sorted keys and for each of them its count, the total of its
    context, and how many subwords follow that context; ``places`` the pair and triple of each target.
    """

    def __init__(self, single: np.ndarray, pairs: tuple, triples: tuple, places: tuple):
        self.single, self.pairs, self.triples, self.places = single, pairs, triples, places

    @classmethod
    def of(cls, single: np.ndarray, line: np.ndarray, lengths: np.ndarray, found: pd.DataFrame, start: int, parts: dict) -> Counts:
        """From the answers to a slice."""
        orders, needed = [], _needed(line, lengths, 2, start)
        for order, (keys, _) in enumerate(needed, 1):
            own = found[found["order"] == order].sort_values("part")["blob"]
            counts, *contexts = (np.concatenate(v) for v in zip(*(_expand(b, *[np.uint32] * 3) for b in own)))
            by, _ = _by_part(keys, order, parts[order])
            context = np.cumsum(_heads(keys[by] >> 16)) - 1
            values = np.empty((3, len(keys)), np.float32)
            values[:, by] = counts, contexts[0][context], contexts[1][context]
            orders.append((keys, *values))
        return cls(single, *orders, tuple(place for _, place in needed))

    def shares(self, line: np.ndarray, lengths: np.ndarray, counted: bool = False) -> np.ndarray:
        """Probabilities of the subword at every place of the line (n x 3) and how much the longer contexts know (n x 2).

        ``counted``: the targets are in the counts themselves and are taken out, each for itself.
        """
        real = np.ones(len(line), bool)
        real[np.cumsum(lengths) - lengths] = False
        out = np.empty((len(self.places[0]), 5), np.float32)
        out[:, 0] = self.single[line[real]]
        for k, ((_, count, total, kinds), place) in enumerate(zip((self.pairs, self.triples), self.places)):
            if counted:
                total, kinds, count = np.maximum(total - 1, 0), kinds - (count == 1), np.maximum(count - 1, 0)
            rest = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), np.float32(1))
            rest, known = rest[place], (np.maximum(count - DISCOUNT, 0) / np.maximum(total, 1))[place]
            out[:, k + 1] = known + rest * out[:, k]
            out[:, k + 3] = 1 - rest
        table = np.zeros((len(line), 5), np.float32)
        table[real] = out
        return table


# ---------------------------------------------------------------- attention model


def new_weights() -> dict[str, np.ndarray]:
    draw = np.random.default_rng(20)
    weights = {name: draw.normal(0, 0.1, (ROWS, WIDTH)).astype(np.float32) for name in ("query", "key", "value")}
    weights["place"] = np.zeros(WINDOW, np.float32)
    weights["mix"] = draw.normal(0, 0.01, (2 * WIDTH + 3, EXPERTS)).astype(np.float32)
    weights["mix"][-3:] = (0, 1, 0, 0), (0, 0, 2, 0), (-2, 0, 0, -3)  # the longer a context known, the better
    return weights


# Key j may be seen by query i of a window: all of the step before, and up to the query itself.
SEEN = np.arange(WINDOW)[None, :] <= np.arange(STEP)[:, None] + WINDOW - STEP
# Distance of key j behind query i.
BEHIND = np.maximum(0, np.arange(STEP)[:, None] + WINDOW - STEP - np.arange(WINDOW)[None, :])


def _attention(w: dict, seen: np.ndarray, q: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Weights of the keys (b, STEP, WINDOW), not yet divided by their sums; next to none for what may not be seen."""
    a = q @ k.transpose(0, 2, 1)
    a *= np.float32(WIDTH**-0.5)
    steep = max(a.max(), -a.min()) + np.abs(w["place"]).max() > STEEP
    a += np.where(SEEN, w["place"][BEHIND], np.float32(-60.0))
    none = seen < 0
    early = np.flatnonzero(none.any(1))
    a[early] -= np.where(none[early], np.float32(60.0), np.float32(0.0))[:, None, :]
    if steep:
        a -= a.max(2, keepdims=True)
    return np.exp(a, out=a)


def forward(w: dict, seen: np.ndarray, target: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Probability of every target: ``seen`` is (b, WINDOW) ids (-1: none), ``target`` (b, STEP)."""
    rows = np.maximum(seen, 0) % ROWS
    q, k, v = w["query"].take(rows[:, -STEP:], 0), w["key"].take(rows, 0), w["value"].take(rows, 0)
    a = _attention(w, seen, q, k)
    a /= np.einsum("bij->bi", a)[..., None]
    same = seen[:, None, :] == target[:, :, None]
    copied = np.einsum("bij->bi", a * same)
    x = np.concatenate([(a @ v).reshape(-1, WIDTH), q.reshape(-1, WIDTH), shares[:, 3:], np.ones((len(shares), 1), np.float32)], 1)
    mix = w["mix"].T @ x.T
    mix -= mix.max(0)
    np.exp(mix, out=mix)
    mix /= mix.sum(0)
    each = np.concatenate([shares[:, :3].T, copied.reshape(1, -1)])
    return (mix * each).sum(0).reshape(target.shape), (rows, q, k, v, a, same, x, mix, each)


def predict(w: dict, seen: np.ndarray, target: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """What ``forward`` returns first, in fewer passes over the attention weights."""
    rows = np.maximum(seen, 0) % ROWS
    q = w["query"].take(rows[:, -STEP:], 0)
    v = np.concatenate([w["value"], np.ones((ROWS, 1), np.float32)], 1).take(rows, 0)
    a = _attention(w, seen, q, w["key"].take(rows, 0))
    state = (a @ v).reshape(-1, WIDTH + 1)  # the last column sums the weights
    state, total = state[:, :-1] / state[:, -1:], state[:, -1]
    same = np.flatnonzero(seen[:, None, :] == target[:, :, None])
    copied = np.bincount(same // WINDOW, a.ravel()[same], target.size) / total
    x = np.concatenate([state, q.reshape(-1, WIDTH), shares[:, 3:], np.ones((len(shares), 1), np.float32)], 1)
    mix = np.exp(w["mix"].T @ x.T)
    each = np.concatenate([shares[:, :3].T, copied.reshape(1, -1)])
    return ((mix * each).sum(0) / mix.sum(0)).reshape(target.shape)


def backward(w: dict, p: np.ndarray, real: np.ndarray, kept: tuple) -> dict[str, np.ndarray]:
    """Gradient of the mean of -log p over the real targets."""
    rows, q, k, v, a, same, x, mix, each = kept
    weight = (real / max(1, real.sum())).astype(np.float32).ravel()
    inverse = weight / np.maximum(p.ravel(), 1e-12)
    d_gate = mix * (weight - each * inverse)
    d_x = (d_gate.T @ w["mix"][:2 * WIDTH].T).reshape(*q.shape[:2], 2 * WIDTH)
    d_state, d_q = np.ascontiguousarray(d_x[..., :WIDTH]), d_x[..., WIDTH:]
    d_score = d_state @ v.transpose(0, 2, 1)
    d_score -= same * (mix[3] * inverse).reshape(*q.shape[:2], 1)
    d_score -= np.einsum("bij,bij->bi", a, d_score)[..., None]
    d_score *= a
    scale = np.float32(WIDTH**-0.5)
    at = rows[..., None].astype(np.intp) * WIDTH + np.arange(WIDTH)

    def gathered(name: str, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(ROWS * WIDTH, w[name].dtype)
        np.add.at(out, at.ravel(), values.ravel())
        return out.reshape(ROWS, WIDTH)

    return {
        "query": gathered("query", at[:, -STEP:], d_score @ k * scale + d_q),
        "key": gathered("key", at, d_score.transpose(0, 2, 1) @ q * scale),
        "value": gathered("value", at, a.transpose(0, 2, 1) @ d_state),
        "place": np.bincount(BEHIND.ravel(), d_score.sum(0).ravel(), WINDOW).astype(np.float32),
        "mix": x.T @ d_gate.T,
    }


def windows(line: np.ndarray, lengths: np.ndarray, pick: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids seen (n, WINDOW; -1: none), places of the targets (n, STEP; -1: none), documents, window numbers.

    ``pick``: whether a document's windows are wanted.
    """
    count = -(-(lengths - 1) // STEP)
    # Every document is an empty step and its steps; a window sees a step and the one before it.
    steps = np.cumsum(count + 1) - count - 1
    real = np.ones(len(line), bool)
    real[np.cumsum(lengths) - 1] = False  # the end is seen by nothing
    at = np.flatnonzero(real)
    to = at + np.repeat(STEP * (steps + 1) - np.cumsum(lengths) + lengths, lengths - 1)
    ids, goal = np.full((2, (int(count.sum()) + len(count)) * STEP), -1, np.int32)
    ids[to], goal[to] = line[at], at + 1
    owner = np.repeat(np.arange(len(lengths)), count if pick is None else np.where(pick, count, 0))
    per = np.bincount(owner, minlength=len(lengths))
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    first = steps[owner] + turn
    ids, goal = ids.reshape(-1, STEP), goal.reshape(-1, STEP)
    return np.concatenate([ids[first], ids[first + 1]], 1), goal[first + 1], owner, turn


def _mix(row: np.ndarray, turn: np.ndarray) -> np.ndarray:
    mixed = (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (turn.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def training_windows(line: np.ndarray, rows: np.ndarray, trained: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids seen and places of the targets of all windows of a slice's training documents, in the order of a hash."""
    seen, goal, owner, turn = windows(line, lengths, trained)
    order = np.argsort(_mix(rows[owner], turn), kind="stable")
    return seen[order], goal[order]


def train(sliced: DataFrame, found: DataFrame, single, start: int, parts: dict) -> dict[str, np.ndarray]:
    """Weights averaged over trainers, one for each slice, each of which starts alike and sees its windows once."""
    shape = {n: x.shape for n, x in new_weights().items()}
    block_size = 1 << 11

    def learn(here: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        line, rows, trained, lengths = _read(here["line"].iloc[0], here["about"].iloc[0])
        places, goal = training_windows(line, rows, trained, lengths)
        if not len(places):
            return pd.DataFrame({"block": [], "weight": [], "part": []})
        shares = Counts.of(single.value, line, lengths, answered, start, parts).shares(line, lengths, counted=True)
        flat = np.concatenate([x.ravel() for x in new_weights().values()])
        w, at = {}, 0
        for n, s in shape.items():
            w[n] = flat[at:at + math.prod(s)].reshape(s)
            at += math.prod(s)
        first, second = np.zeros_like(flat), np.zeros_like(flat)
        for step, k in enumerate(range(0, len(places), BATCH), 1):
            seen, wanted = places[k:k + BATCH], goal[k:k + BATCH]
            target = np.where(wanted >= 0, line[wanted].astype(np.int32), -1)
            p, kept = forward(w, seen, target, shares.take(wanted.ravel(), 0))
            grads = backward(w, p, target >= 0, kept)
            grad = np.concatenate([grads[n].ravel() for n in shape])
            # Adam's decaying means, kept as sums: ``first`` is ten times the mean, ``second`` a hundred times.
            first *= np.float32(0.9)
            first += grad
            second *= np.float32(0.99)
            grad *= grad
            second += grad
            scale = math.sqrt(0.01 / (1 - 0.99**step))
            np.sqrt(second, out=grad)
            grad += np.float32(1e-8 / scale)
            np.divide(first, grad, out=grad)
            grad *= np.float32(LEARNING_RATE * 0.1 / (1 - 0.9**step) / scale)
            flat -= grad
        cuts = range(0, len(flat), block_size)
        return pd.DataFrame({"block": range(len(cuts)), "weight": len(places), "part": [flat[at:at + block_size].tobytes() for at in cuts]})

    def average(frame: pd.DataFrame) -> pd.DataFrame:
        blocks = np.array([np.frombuffer(p, np.float32) for p in frame["part"]], np.float64)
        mean = np.average(blocks, 0, frame["weight"]).astype(np.float32)
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "part": [mean.tobytes()]})

    learnt = sliced.groupBy("slice").cogroup(found.groupBy("slice")).applyInPandas(learn, "block int, weight long, part binary")
    rows = learnt.groupBy("block").applyInPandas(average, "block int, part binary").collect()
    if not rows:
        return new_weights()
    flat, out, at = np.frombuffer(b"".join(r["part"] for r in sorted(rows, key=lambda r: r["block"])), np.float32), {}, 0
    for n, s in shape.items():
        out[n] = flat[at:at + math.prod(s)].reshape(s).copy()
        at += math.prod(s)
    return out


def log_probabilities(line: np.ndarray, lengths: np.ndarray, w: dict, model: Counts) -> np.ndarray:
    """log10 probability of every document of a line of subwords, window by window."""
    seen, goal, owner, _ = windows(line, lengths)
    shares = model.shares(line, lengths)
    total = np.zeros(len(lengths))
    for k in range(0, len(seen), SCORED):
        places = goal[k:k + SCORED]
        target = np.where(places >= 0, line[places].astype(np.int32), -1)
        p = predict(w, seen[k:k + SCORED], target, shares.take(places.ravel(), 0))
        logs = np.where(target >= 0, np.log10(np.maximum(p, 1e-30)), 0.0).sum(1)
        total += np.bincount(owner[k:k + SCORED], logs, len(lengths))
    return total


def score(
    docs: DataFrame, held_out: Column, vocabulary: str, key: str = "doc_id", text: str = "text",
    start: int = 49406, end: int = 49407,
) -> DataFrame:
    """Columns ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    The model and the word counts learn from the rows that are not held out, all of them. Null texts
    are empty; an empty text is scored by its end alone. Repeated rows are documents of their own.
    Rows where ``held_out`` is null are learnt from. An empty table gives no rows. ``vocabulary``
    must have fewer than 65536 ids.
    """
    source = docs.select(
        F.col(key).alias("key"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("trained", ~F.col("held_out"))
    logs, distinct = word_scores(source, "text")
    tokens = stage(subwords(source, vocabulary), "subwords")
    zero = F.lit(0).cast("long")
    seen = tokens.where("trained").agg(
        F.coalesce(F.sum("n"), zero).alias("n"), F.coalesce(F.sum("n_tokens"), zero).alias("n_tokens"), F.count("*").alias("docs")
    ).first()

    parts = {order: max(8, math.ceil(seen["n"] / by / PART)) for order, by in ((0, 8), (1, 2), (2, 1))}
    single = np.full(LIMIT, 0.5)
    for row in count_table(tokens, 0, start, end, parts[0]).select("keys", "counts").collect():  # at most the vocabulary
        single[np.frombuffer(row["keys"], np.int64) & (LIMIT - 1)] += np.frombuffer(row["counts"], np.int64)
    single[start] = 0
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((single / single.sum()).astype(np.float32))
    sliced = slices(tokens, start, end, tokens.agg(F.coalesce(F.sum("n"), zero)).first()[0])
    documents = stage(tokens.drop("ids"), "documents")
    unstage(tokens)
    release(spark)
    found = None
    for order in (1, 2):
        own = answers(sliced, None, order, start, parts[order])
        found = found.union(own) if found is not None else own
        release(spark)
    weights = train(sliced, found, shared, start, parts)
    release(spark)

    def work(here: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        line, rows, _, lengths = _read(here["line"].iloc[0], here["about"].iloc[0])
        model = Counts.of(shared.value, line, lengths, answered, start, parts)
        return pd.DataFrame({"row": rows, "score": log_probabilities(line, lengths, weights, model)})

    scored = sliced.groupBy("slice").cogroup(found.groupBy("slice")).applyInPandas(work, "row long, score double")
    ends = int(seen["docs"] > 0)
    size = math.log10(seen["n_tokens"] + 0.5 * (distinct + ends + 1))
    base = F.coalesce("logs", F.lit(0.0)) + math.log10(seen["docs"] + 0.5) - F.col("n_tokens") * size
    return documents.join(logs, "row", "left").join(stage(scored, "scores"), "row").select(
        F.col("key").alias(key), (~F.col("trained")).alias("held_out"), "n_tokens",
        (F.coalesce("known", zero) + ends).alias("n_known"), F.lit(seen["n_tokens"]).cast("long").alias("train_tokens"),
        base.alias("base_score"), "score",
    )
