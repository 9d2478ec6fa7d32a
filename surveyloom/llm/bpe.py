"""BPE encoding and decoding as bounded-lookahead streaming transducers.

A text is cut into pre-tokens by the vocabulary's pattern, block by block. Inside a pre-token the
encoder keeps, for every position, the last token of the encoding of the prefix that ends there.
Two tokens may follow each other exactly if encoding their concatenation gives them back, and the
encoding of a prefix is the only chain of such pairs. A later position extends a chain that ends
at most one longest token back, so the merge list's sufficient lookahead is the length of its
longest token: tokens shared by all chains that end within this lookahead can no longer change and
are emitted, and the bytes before them are dropped.
"""

from __future__ import annotations

import codecs
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from surveyloom.llm.common import map_batches

# Pre-token pattern of the byte-level vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same over the characters of PLAIN, for the standard library's faster matcher.
LETTER, DIGIT = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾"
SIMPLE_PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{DIGIT}]+| ?[^\t-\r \x85\xa0{LETTER}{DIGIT}]+"
    r"|[\t-\r \x85\xa0]+(?![^\t-\r \x85\xa0])|[\t-\r \x85\xa0]+"
)
PLAIN = r"[\t-\r\x20-\xff]*"
# Characters of a text that are cut into pre-tokens at a time.
BLOCK_CHARS = 1 << 16
# Pre-tokens whose encoding a Python worker remembers; beyond that it starts afresh.
REMEMBERED = 450_000
# Later than any merge.
NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in a byte-level vocabulary file."""
    printable = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    others = (b for b in range(256) if b not in printable)
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class _Pieces(dict):
    """Ids of the strings between lone spaces, each with the space before it."""

    def __init__(self, coder: StreamingBpe):
        self.coder = coder

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", self.coder.encode_piece(" " + piece)).tobytes()
        if len(piece) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


class StreamingBpe:
    """Encoder and decoder over one vocabulary file with a BPE merge list."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet, model = byte_alphabet(), spec["model"]
        self.bytes_of = {i: bytes(alphabet[c] for c in token) for token, i in model["vocab"].items()}
        self.id_of = {token: i for i, token in self.bytes_of.items()}
        vocab, self.merges = model["vocab"], {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.made_from: dict[int, tuple[int, tuple[int, int]]] = {}
        for pair, (rank, made) in self.merges.items():
            self.made_from.setdefault(made, (rank, pair))
        self.left_edge = {i: self.spine(i, 0) for i in vocab.values()}
        self.right_edge = {i: self.spine(i, 1) for i in vocab.values()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        self.lookahead = max(map(len, self.id_of))
        self.pattern = regex.compile(PATTERN)
        self.simple, self.plain = re.compile(SIMPLE_PATTERN), re.compile(PLAIN).fullmatch
        self.cut, self.wide_space = regex.compile(r" (?=\S)"), regex.compile(r" \s| $")
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.remembered: dict[str, list[int]] = {}
        self.pieces = _Pieces(self)
        self.follows: dict[int, bool] = {}

    def merged(self, ids: list[int]) -> list[int]:
        """Plain application of the merge list to a short id list, lowest rank first."""
        while len(ids) > 1:
            rank, at = min((self.merges.get(p, (NEVER,))[0], k) for k, p in enumerate(zip(ids, ids[1:])))
            if rank == NEVER:
                break
            ids = ids[:at] + [self.merges[ids[at], ids[at + 1]][1]] + ids[at + 2:]
        return ids

    def spine(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """Tokens at one edge (0 left, 1 right) while ``token`` is built: (token, rank made, rank used)."""
        found, used = [], NEVER
        while token in self.made_from:
            made, parts = self.made_from[token]
            found.append((token, made, used))
            token, used = parts[side], made
        return [*found, (token, -1, used)]

    def whole(self, token: int) -> bool:
        data = self.bytes_of[token]
        return self.merged([self.id_of[data[k:k + 1]] for k in range(len(data))]) == [token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether encoding the two tokens' joined bytes gives the two tokens; left -1: the start.

        It does unless, at the rank of some merge, both its parts lie at the common edge. Of two
        merges of one rank the left one comes first.
        """
        found = self.follows.get((left << 32) + right)
        if found is None:
            if left < 0:
                found = self.whole(right)
            else:
                merges, edge, found = self.merges, self.left_edge[right], True
                for x, x_made, x_used in self.right_edge[left]:
                    for y, y_made, y_used in edge:
                        if x_made < y_used and y_made < x_used and (x, y) in merges:
                            rank = merges[x, y][0]
                            if x_made < rank < x_used and y_made < rank <= y_used:
                                found = False
            if len(self.follows) >= REMEMBERED:
                self.follows.clear()
            self.follows[(left << 32) + right] = found
        return found

    def stream(self, data: bytes) -> Iterator[int]:
        """Token ids of one pre-token, each emitted once no further byte can change it."""
        ahead, tokens, follows = self.lookahead, self.id_of, self.follows
        base, last, lengths = 0, [-1], [0]  # of positions base, base + 1, ...
        for end in range(1, len(data) + 1):
            for start in range(end - 1, max(base, end - ahead) - 1, -1):
                token = tokens.get(data[start:end])
                if token is not None:
                    left = last[start - base]
                    ok = follows.get((left << 32) + token)
                    if ok if ok is not None else self.may_follow(left, token):
                        last.append(token)
                        lengths.append(end - start)
                        break
            else:
                raise ValueError("a byte of the text is not in the vocabulary")
            if end - base >= 4 * ahead and (end - base) % ahead == 0:
                shared = None
                for at in range(end - ahead + 1, end + 1):
                    chain = set()
                    while at > base:
                        chain.add(at)
                        at -= lengths[at - base]
                    shared = chain if shared is None else shared & chain
                    if not shared:
                        break
                if shared:
                    stable = max(shared)
                    yield from self._chain(last, lengths, base, stable)
                    last, lengths, base = last[stable - base:], lengths[stable - base:], stable
        yield from self._chain(last, lengths, base, len(data))

    @staticmethod
    def _chain(last: list[int], lengths: list[int], base: int, end: int) -> list[int]:
        found = []
        while end > base:
            found.append(last[end - base])
            end -= lengths[end - base]
        return found[::-1]

    def blocks(self, text: str) -> Iterator[str]:
        """Blocks of bounded length; each but the first starts with a lone space before a non-space."""
        start = 0
        while start < len(text):
            cut = self.cut.search(text, start + BLOCK_CHARS)
            stop = cut.start() if cut else len(text)
            yield text[start:stop]
            start = stop

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of a short text, pre-token by pre-token; short pre-tokens are remembered."""
        known, out = self.remembered, []
        for word in (self.simple if self.plain(piece) else self.pattern).findall(piece):
            ids = known.get(word)
            if ids is None:
                ids = list(self.stream(word.encode()))
                if len(word) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = ids
            out += ids
        return out

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids of the text's blocks as 32-bit numbers; strings of special tokens become their ids.

        No pre-token crosses the place before a lone space that a non-space follows, so where all
        spaces are such the block is cut at them and the pieces' ids are remembered as well.
        """
        parts = self.special_at.split(text) if self.special_at and "<" in text else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield array("i", [self.special[part]]).tobytes()
                continue
            for block in self.blocks(part):
                if self.wide_space.search(block):
                    yield array("i", self.encode_piece(block)).tobytes()
                else:
                    first, *pieces = block.split(" ")
                    yield b"".join([array("i", self.encode_piece(first)).tobytes(), *map(self.pieces.__getitem__, pieces)])

    def decoder(self) -> codecs.IncrementalDecoder:
        """Byte-to-text state machine: holds the bytes of an unfinished character."""
        return codecs.getincrementaldecoder("utf-8")("replace")

    def decode(self, blocks: Iterable[bytes]) -> Iterator[str]:
        machine, data = self.decoder(), self.bytes_of.__getitem__
        for block in blocks:
            yield machine.decode(b"".join(map(data, np.frombuffer(block, np.int32).tolist())))
        yield machine.decode(b"", final=True)


@lru_cache(maxsize=2)
def load(path: str) -> StreamingBpe:
    return StreamingBpe(path)


def encode_decode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns ``key``, ``ids`` (array of int) and ``decoded`` (the text of these ids) per document.

    A null or empty text gives no ids and an empty text. Rows with equal keys are encoded one by
    one. Other columns, whatever their names, are not read. ``vocabulary`` is the path of a
    byte-level vocabulary file that every executor has. No rows move between tasks.
    """
    def work(columns: list[list]) -> list:
        bpe = load(vocabulary)
        keys, texts = columns
        ids, ends, decoded = [], [0], []
        for value in texts:
            own = list(bpe.encode(value or ""))
            decoded.append("".join(bpe.decode(own)))
            ids += own
            ends.append(ends[-1] + sum(map(len, own)) // 4)
        flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
        return [pa.array(keys, key_type), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), decoded]

    source = docs.select(key, text)
    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(source.schema[0].dataType)
    kind = source.schema[0].dataType.simpleString()
    return map_batches(source, work, f"`{key}` {kind}, ids array<int>, decoded string", text)
