"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds spans.

The field tags every piece of a text, words of plain letters included, as begin, inside or outside of a
secret from its shape, the neighbouring pieces and features of the whole file. A text is one sequence
and is decoded exactly by Viterbi: many blocks of a slice of texts at once, each from every tag that may
stand before it, then joined in order. The field learns from the spans of the fixed patterns in a sample
of documents whose bound is a parameter.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from surveyloom.llm.common import CACHES, map_batches

# The kinds of the base patterns in their order, and the least length of each.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Kind of the spans that the field adds.
ADDED = "model"

# Documents the field learns from (expected number), and the tiles taken of each sort.
SAMPLE_DOCUMENTS = 20_000
SEQUENCES = 6_000
STEPS, RATE, PENALTY = 150, 0.1, 1e-3

BEGIN, INSIDE, OUTSIDE = range(3)
MARK = re.compile(r"[0-9=_+/]")
# A piece is a run of letters and digits or another single character; white space parts words only.
PIECE = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\v\f\r]")
TOKEN = re.compile(r"[A-Za-z0-9]+|[ \t\n\v\f\r]+|[^A-Za-z0-9]")
# The field learns from tiles of this many pieces, longer only so as not to cut a span, and at most ``LONGEST``.
TILE, LONGEST = 32, 64
# Pieces of a block that is decoded beside the others, and the score of what cannot be.
BLOCK, NEVER = 256, -1e12


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by start and then kind as listed."""
    found, lower = [], text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def sequences(text: str) -> list[list[tuple[int, int]]]:
    """The bounds of all pieces of a text, as its one sequence; none of a text without pieces."""
    pieces = [m.span() for m in PIECE.finditer(text)]
    return [pieces] if pieces else []


def shape(piece: str) -> str:
    """Kinds of characters, mixture and rough length of a piece."""
    if not piece.isalnum():
        return piece if piece.isascii() else "other"
    digit, lower, upper = (any(map(t, piece)) for t in (str.isdigit, str.islower, str.isupper))
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(piece, piece[1:]))
    return f"{'9' * digit}{'a' * lower}{'A' * upper}:{min(5, int(math.log2(len(piece))))}:{min(3, turns)}"


def own_features(piece: str) -> tuple[str, ...]:
    """Features of a piece that depend on nothing but itself, its shape first."""
    own, word = [f"s {shape(piece)}"], piece.lower()
    if len(word) >= 8 and set(word) <= set("0123456789abcdef"):
        own.append(f"hex {min(4, len(word) // 8)}")
    if piece[:4] == "AKIA":
        own.append("akia")
    return tuple(own)


def features(text: str, run: list[tuple[int, int]], file: list[str], start: int = 0, stop: int | None = None) -> list[list[str]]:
    """Names of the features that hold for the pieces ``start`` to ``stop`` of a text's sequence."""
    stop = len(run) if stop is None else stop
    near = range(max(0, start - 4), min(len(run), stop + 1))
    words = {k: text[slice(*run[k])] for k in near}
    owns = {k: own_features(w) for k, w in words.items()}
    named = {k: [w for w in KEYWORDS if w in words[k].lower()] for k in near}
    out = []
    for k in range(start, stop):
        own = ["bias", *owns[k], *file]
        own.append("p" + owns[k - 1][0][1:] if k else "p start")
        own.append("n" + owns[k + 1][0][1:] if k + 1 < len(run) else "n end")
        before = {w for j in range(max(0, k - 4), k) for w in named[j]}
        own += [f"k {w}" for w in KEYWORDS if w in before]
        out.append(own)
    return out


def file_features(text: str, marks: int) -> list[str]:
    """How dense the pieces with digits or signs are in the file, and whether it looks like settings or code."""
    density = int(math.log2(1 + 1000 * marks / (len(text) + 1)))
    return [f"file marks {min(6, density)}", f"file code {('{' in text) + ('=' in text)}"]


def tags_of(run: list[tuple[int, int]], spans: list[tuple[str, int, int]]) -> list[int]:
    tags, last, ended = [], None, 0
    for a, b in run:
        while ended < len(spans) and spans[ended][2] <= a:
            ended += 1
        inside = None
        for k in range(ended, len(spans)):
            if spans[k][1] >= b:
                break
            if spans[k][2] > a:
                inside = spans[k][1:]
                break
        tags.append(OUTSIDE if inside is None else INSIDE if inside == last else BEGIN)
        last = inside
    return tags


def tiles(tags: list[int]) -> list[tuple[int, int]]:
    """Bounds of a sequence's tiles; a span is not cut, unless it is longer than a tile may be."""
    out, start = [], 0
    while start < len(tags):
        stop = min(start + TILE, len(tags))
        while stop < len(tags) and tags[stop] == INSIDE:
            stop += 1
        out.append((start, stop))
        start = stop
    return out


# Features of pieces met in a task: the row of its tables that a token has, or -1 for white space.
TOKENS: dict[str, int] = {}
KINDS_OF: dict[tuple, int] = {}
CACHES += [TOKENS, KINDS_OF]
REMEMBERED = 200_000


def kind_of(token: str) -> int:
    """Number of the features that a token has by itself; tokens of equal features share it."""
    found = TOKENS.get(token)
    if found is None:
        if token[0] in " \t\n\v\f\r":
            found = -1
        else:
            named = tuple(w in token.lower() for w in KEYWORDS)
            found = KINDS_OF.setdefault((own_features(token), named, bool(MARK.search(token))), len(KINDS_OF))
        if len(TOKENS) < REMEMBERED and len(token) <= 64:
            TOKENS[token] = found
    return found


class Field:
    """Weights of a linear-chain conditional random field over begin, inside and outside."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.names, self.emit, self.move = names, emit, move

    def scores(self, feats: list[list[str]]) -> np.ndarray:
        names, emit = self.names, self.emit
        return np.array([emit[[names[f] for f in own if f in names]].sum(0) for own in feats])

    def decode(self, feats: list[list[str]]) -> list[int]:
        """The most likely tags (Viterbi); inside cannot follow outside or start a run."""
        emit, best, back = self.scores(feats), None, []
        for row in emit:
            if best is None:
                best = row + np.array([0.0, -np.inf, 0.0])
            else:
                ways = best[:, None] + self.move
                back.append(ways.argmax(0))
                best = ways.max(0) + row
        tags = [int(best.argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]

    def weight(self, name: str) -> np.ndarray:
        return self.emit[self.names[name]] if name in self.names else np.zeros(3)

    def texts_scores(self, kinds: np.ndarray, first: np.ndarray, files: list[np.ndarray]) -> np.ndarray:
        """What ``scores`` gives for whole texts in a row: kinds of all pieces, and whether each starts a text."""
        table = list(KINDS_OF)
        own = np.array([self.weight("bias") + sum(self.weight(f) for f in k[0]) for k in table])
        before = np.array([self.weight("p" + k[0][0][1:]) for k in table])
        behind = np.array([self.weight("n" + k[0][0][1:]) for k in table])
        last, text = np.append(first[1:], True), np.cumsum(first) - 1
        emit = own[kinds] + np.array(files)[text]
        emit[1:] += before[kinds[:-1]] * ~first[1:, None]
        emit[first] += self.weight("p start")
        emit[:-1] += behind[kinds[1:]] * ~last[:-1, None]
        emit[last] += self.weight("n end")
        named = np.array([k[1] for k in table])
        at = np.flatnonzero(named.any(1)[kinds])
        if len(at):
            near = np.zeros((len(kinds) + 4, len(KEYWORDS)), bool)
            text = np.concatenate([text, np.full(4, -1)])
            for step in range(1, 5):
                same = at[text[at + step] == text[at]]
                near[same + step] |= named[kinds[same]]
            hit = np.flatnonzero(near.any(1))
            emit[hit] += near[hit] @ np.array([self.weight(f"k {w}") for w in KEYWORDS])
        return emit

    def decode_texts(self, emit: np.ndarray, first: np.ndarray) -> np.ndarray:
        """What ``decode`` gives for every text of a row of texts, whose first pieces are marked."""
        n, blocks = len(emit), -(-len(emit) // BLOCK)
        padded = np.zeros((blocks * BLOCK, 3))
        padded[:n] = emit
        starts = np.ones(blocks * BLOCK, bool)
        starts[:n] = first
        padded, starts = padded.reshape(blocks, BLOCK, 3), starts.reshape(blocks, BLOCK)
        # best[c][s, b]: the best score of block b so far that ends in tag c, if tag s stands before the block.
        best = [np.where(np.arange(3)[:, None] == c, 0.0, NEVER) + np.zeros((3, blocks)) for c in range(3)]
        back = np.empty((BLOCK, 3, 3, blocks), np.int8)
        for t in range(BLOCK):
            fresh, new = starts[:, t], []
            for c in range(3):
                opening = NEVER if c == INSIDE else 0.0
                ways = [best[p] + np.where(fresh, opening, self.move[p, c]) for p in range(3)]
                way = (ways[1] > ways[0]).astype(np.int8)
                top = np.maximum(ways[0], ways[1])
                later = ways[2] > top
                way[later] = 2
                back[t, c] = way
                new.append(np.maximum(top, ways[2]) + padded[:, t, c])
            best = new
        whole = np.stack(best).transpose(2, 1, 0)
        ahead, before = np.zeros(3), np.empty((blocks, 3), np.int8)
        for b in range(blocks):
            ways = ahead[:, None] + whole[b]
            before[b] = ways.argmax(0)
            ahead = ways.max(0)
            ahead -= ahead.max()
        ends, tag = np.empty(blocks, np.int8), int(ahead.argmax())
        for b in range(blocks - 1, -1, -1):
            ends[b], tag = tag, before[b, tag]
        every = np.arange(blocks)
        source, tags = before[every, ends], np.empty((blocks, BLOCK), np.int8)
        for t in range(BLOCK - 1, -1, -1):
            tags[:, t] = ends
            ends = back[t, ends, source, every]
        return tags.reshape(-1)[:n]

    def find(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """Bounds of the spans that the field finds in every text, all of it decoded."""
        kinds, bounds, counts = [], [], []
        for text in texts:
            tokens = TOKEN.findall(text)
            kind = np.fromiter(map(kind_of, tokens), np.int32, len(tokens))
            ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
            piece = np.flatnonzero(kind >= 0)
            kinds.append(kind[piece])
            bounds.append(np.stack([ends[piece - 1] * (piece > 0), ends[piece]], 1))
            counts.append(len(piece))
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not sum(counts):
            return out
        marked = np.array([k[2] for k in KINDS_OF])
        files = [
            sum(map(self.weight, file_features(text, int(marked[kind].sum()))))
            for text, kind in zip(texts, kinds) if len(kind)
        ]
        kinds, counts = np.concatenate(kinds), np.array(counts)
        first = np.zeros(len(kinds), bool)
        first[(np.cumsum(counts) - counts)[counts > 0]] = True
        tags = self.decode_texts(self.texts_scores(kinds, first, files), first)
        bounds, owner = np.concatenate(bounds), np.repeat(np.arange(len(texts)), counts)
        for k in np.flatnonzero(tags != OUTSIDE).tolist():
            found, (a, b) = out[owner[k]], bounds[k].tolist()
            if tags[k] == BEGIN:
                found.append((a, b))
            else:
                found[-1] = (found[-1][0], b)
        return out


def fit(examples: list[tuple[list[list[str]], list[int]]]) -> Field:
    """Maximum-likelihood weights by full-batch Adam steps."""
    examples = [(f, t) for f, t in examples if len(f) <= LONGEST] or [([["bias"]], [OUTSIDE])]
    names: dict[str, int] = {}
    for feats, _ in examples:
        for own in feats:
            for f in own:
                names.setdefault(f, len(names))
    # Longest first, so that at every place the sequences that reach it are the first ones. Tags lead, as the
    # sums over them are then sums of long rows.
    examples.sort(key=lambda e: -len(e[0]))
    n, longest = len(examples), len(examples[0][0])
    width = max(len(own) for feats, _ in examples for own in feats)
    lengths = np.array([len(f) for f, _ in examples])
    alive = [int((lengths > t).sum()) for t in range(longest)]
    at = np.cumsum(alive) - alive
    # Pieces are laid out place by place: those of place t are at[t] to at[t] + alive[t].
    ids, tags = np.full((sum(alive), width), len(names)), np.empty(sum(alive), np.int64)
    for i, (feats, own_tags) in enumerate(examples):
        for k, own in enumerate(feats):
            ids[at[k] + i, :len(own)] = [names[f] for f in own]
            tags[at[k] + i] = own_tags[k]
    barred = np.zeros((3, 3))
    barred[OUTSIDE, INSIDE] = -1e9
    start = np.array([0.0, -1e9, 0.0])
    weights = np.zeros((len(names) + 1) * 3 + 9)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    hot = np.eye(3)[:, tags]
    seen = np.zeros((3, 3))
    for t in range(1, longest):
        m = alive[t]
        seen += hot[:, at[t - 1]:at[t - 1] + m] @ hot[:, at[t]:at[t] + m].T
    columns = np.ascontiguousarray(ids.T)

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)

    for step in range(1, STEPS + 1):
        emit_w, move = weights[:-9].reshape(-1, 3), weights[-9:].reshape(3, 3) + barred
        emit = sum(emit_w.T[:, column] for column in columns)
        place = lambda x, t, m: x[:, at[t]:at[t] + m]
        ahead, behind = np.empty_like(emit), np.zeros_like(emit)
        place(ahead, 0, n)[:] = place(emit, 0, n) + start[:, None]
        total = np.empty(n)
        for t in range(1, longest):
            m = alive[t]
            place(ahead, t, m)[:] = log_sum(place(ahead, t - 1, m)[:, None] + move[:, :, None], 0) + place(emit, t, m)
        for t in range(longest):
            m, after = alive[t], alive[t + 1] if t + 1 < longest else 0
            total[after:m] = log_sum(place(ahead, t, m)[:, after:], 0)
        both = np.zeros((3, 3))
        for t in range(longest - 2, -1, -1):
            m = alive[t + 1]
            later = move[:, :, None] + (place(emit, t + 1, m) + place(behind, t + 1, m))[None]
            place(behind, t, m)[:] = log_sum(later, 1)
            both += np.exp(place(ahead, t, m)[:, None] + later - total[:m]).sum(2)
        single = ahead + behind
        for t in range(longest):
            place(single, t, alive[t])[:] -= total[:alive[t]]
        error = np.exp(single) - hot
        slope = np.zeros((len(names) + 1, 3))
        for column in columns:
            for tag in range(3):
                slope[:, tag] += np.bincount(column, error[tag], len(names) + 1)
        slope[-1] = 0
        grad = np.concatenate([slope.ravel(), (both - seen).ravel()]) / n + PENALTY * weights
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Field(names, weights[:-9].reshape(-1, 3)[:-1].copy(), weights[-9:].reshape(3, 3) + barred)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", documents: int = SAMPLE_DOCUMENTS, sequences_each: int = SEQUENCES) -> Field:
    """Fit the field on documents drawn by a hash of key and text, expected ``documents`` of them.

    At most ``sequences_each`` tiles with base spans and as many without are used.
    """
    count = docs.count()
    draw = F.pmod(F.xxhash64(key, text, F.lit("crf")), F.lit(1 << 40))
    drawn = docs.where(F.col(text).isNotNull()).where(draw < F.lit(int((1 << 40) * min(1.0, documents / max(1, count)))))

    def work(columns: list[list]) -> list:
        out, labelled = [], []
        for value in columns[0]:
            spans, own, flags = base_spans(value), [], []
            for run in sequences(value):
                tags = tags_of(run, spans)
                marks = [bool(MARK.search(value, a, b)) for a, b in run]
                file, cuts = file_features(value, sum(marks)), tiles(tags)
                # Of the tiles without signs and digits one is enough, as all are alike.
                plain = zlib.crc32(value.encode("utf-8", "replace")) % len(cuts)
                for k, (a, b) in enumerate(cuts):
                    if b - a <= LONGEST and (k == plain or any(marks[a:b])):
                        own.append([f"{t}\x1e" + "\x1f".join(f) for t, f in zip(tags[a:b], features(value, run, file, a, b))])
                        flags.append(any(t != OUTSIDE for t in tags[a:b]))
            out += own
            labelled += flags
        return [out, labelled]

    found = map_batches(drawn.select(text), work, "run array<string>, labelled boolean", text)
    order = F.xxhash64("run")
    rows = [
        r["run"] for flag in (True, False)
        for r in found.where(F.col("labelled") == flag).orderBy(order, "run").limit(sequences_each).collect()
    ]
    return fit([
        ([piece[2:].split("\x1f") for piece in run], [int(piece[0]) for piece in run]) for run in rows
    ])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", field: Field | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``key``, ``text``, those of ``keep`` and ``spans``: array of (kind, start, end) by start, then kind.

    Bounds are code points, the end exclusive. Spans of the fixed patterns all stay; the field adds
    the spans of kind ``model`` that overlap none of them. Null or empty texts have no spans, a null
    text stays null. Repeated rows are scanned one by one; an empty table gives no rows.
    """
    field = field or train(docs, key, text)
    source = docs.select(key, text, *keep)
    types = [f.type for f in to_arrow_schema(source.schema)]

    def work(columns: list[list]) -> list:
        texts, found = [value or "" for value in columns[1]], []
        for value, more in zip(texts, field.find(texts)):
            spans = base_spans(value)
            spans += [(ADDED, a, b) for a, b in more if not any(a < e and b > s for _, s, e in spans)]
            spans.sort(key=lambda s: (s[1], (*KINDS, ADDED).index(s[0])))
            found.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
        return [*(pa.array(c, t) for c, t in zip(columns, types)), found]

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return map_batches(source, work, f"{kinds}, spans array<struct<kind:string,start:int,end:int>>", text)


def masked(found: DataFrame, text: str = "text") -> DataFrame:
    """What ``scan`` returned, with every span of the text replaced by a mark and ``spans`` dropped."""
    at = found.columns.index(text)
    types = [f.type for f in to_arrow_schema(found.drop("spans").schema)]

    def work(columns: list[list]) -> list:
        spans = columns.pop()
        columns[at] = [redact(t, s) for t, s in zip(columns[at], spans)]
        return [pa.array(c, t) for c, t in zip(columns, types)]

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.drop("spans").schema)
    return map_batches(found.select(*found.drop("spans").columns, "spans"), work, kinds, text)


def redact(text: str | None, spans: list) -> str | None:
    """The text with every span, merged where they overlap, replaced by a mark."""
    if not text or not spans:
        return text
    out, end = [], 0
    for s in sorted(spans, key=lambda s: s["start"]):
        if s["start"] >= end:
            out += [text[end:s["start"]], "[SECRET]"]
        end = max(end, s["end"])
    return "".join([*out, text[end:]])

