"""Toxicity by a weighted finite-state grammar over clauses.

A lexical transducer turns the words of a clause into symbols (insult, threat, target, negation,
reported speech, quotation mark, other). Composed with it, a negation, a reported-speech and a
target transducer rewrite the symbols in one pass, and the last machine emits one class for a
clause that holds an insult or a threat: which of both, and whether it is aimed, negated or
reported. The weights of the classes and of the insult terms are learnt from labelled rows; what an
insult looks like is learnt as words and word beginnings, the other roles are short fixed lists.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import map_batches, stage

# Expected number of labelled rows that the grammar is fitted on.
SAMPLE_ROWS = 12_000
# A term is taken as an insult with this many toxic texts of different content and this precision.
SUPPORT, PRECISION = 5, 0.8
TERMS = 2_000
PREFIXES = (4, 5, 6, 7)
# Words after a negation that it reaches.
SCOPE = 3

THREATS = "kill hurt destroy burn die punch beat töten umbringen schlagen tuer frapper détruire matar golpear destruir".split()
TARGETS = (
    "you your yours u they them he she him her we us everyone du dich dir ihr euch sie tu toi te vous elle "
    "tú ti usted ustedes ellos ellas él"
).split()
NEGATIONS = "not no never nor neither without isn't aren't don't nicht kein keine keinen nie pas jamais ni nunca jamás tampoco".split()
REPORTS = (
    "said says say wrote writes quoted quote called calls claims claimed reported reportedly sagte sagt schrieb "
    "nannte dit écrit appelle dijo dice escribió llamó"
).split()
FIXED = {w: r for r, words in (("T", THREATS), ("P", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) for w in words}

CLAUSE_END = re.compile(r"[.!?;:\n]")
TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)?|[\"“”„«»]")
CLASSES = [f"{kind}{aim}{neg}{rep}" for kind in "IT" for aim in "-p" for neg in "-n" for rep in "-r"]


def negation(state: int, symbol: str) -> tuple[int, str]:
    """State: words that the last negation still reaches."""
    if symbol == "N":
        return SCOPE, symbol
    return max(0, state - 1), symbol + "n" if state and symbol[0] in "IT" else symbol


def reported(state: int, symbol: str) -> tuple[int, str]:
    """State: 1 after a verb of speech, 2 inside quotation marks."""
    if symbol == "Q":
        return 0 if state == 2 else 2, symbol
    if symbol == "R" and state != 2:
        return 1, symbol
    return state, symbol + "r" if state and symbol[0] in "IT" else symbol


def aimed(state: int, symbol: str) -> tuple[int, str]:
    """State: whether the clause has named a target so far."""
    return 1 if symbol == "P" else state, symbol + "p" if state and symbol[0] in "IT" else symbol


MACHINES = (negation, reported, aimed)


class Grammar:
    """The composed transducers with the insult terms and the class weights."""

    def __init__(self, terms: dict[str, float], weights: list[float] | None = None):
        import ahocorasick

        self.terms, self.weights = terms, weights
        self.finder = ahocorasick.Automaton()
        for term, strength in terms.items():
            self.finder.add_word(term.rstrip("$"), (term.rstrip("$"), term.endswith("$"), strength))
        for word in THREATS:
            if word not in terms:
                self.finder.add_word(word, (word, True, 0.0))
        self.finder.make_automaton()
        self.longest = max(map(len, [*terms, *THREATS]))

    def symbol(self, word: str) -> tuple[str, float]:
        strength = self.terms.get(word + "$")
        if strength is None:
            for n in PREFIXES:
                if len(word) >= n and word[:n] in self.terms:
                    strength = self.terms[word[:n]]
        if strength is not None:
            return "I", strength
        return ("Q" if len(word) == 1 and word in "\"“”„«»" else FIXED.get(word, "W")), 0.0

    def clause(self, words: list[str]) -> tuple[str, float] | None:
        """Class of a clause and the summed strength of its insults; None without a match."""
        states, found, strength = [0] * len(MACHINES), [], 0.0
        for word in words:
            symbol, own = self.symbol(word)
            for k, machine in enumerate(MACHINES):
                states[k], symbol = machine(states[k], symbol)
            if symbol[0] in "IT":
                found.append(symbol)
                strength += own
        if not found:
            return None
        kind = "I" if any(s[0] == "I" for s in found) else "T"
        own = [s for s in found if s[0] == kind]
        target = states[2] or any("p" in s for s in own)
        flags = all("n" in s for s in own), all("r" in s for s in own)
        return kind + "-p"[bool(target)] + "-n"[flags[0]] + "-r"[flags[1]], strength

    def clauses(self, text: str) -> list[tuple[str, float]]:
        """Matched clauses of a lower-case text; clauses without any term are not tokenized."""
        found, end = [], 0
        for last, (term, whole, _) in self.finder.iter(text):
            first = last - len(term) + 1
            if first < end or first and text[first - 1].isalpha():
                continue
            if whole and text[last + 1:last + 2].isalpha():
                continue
            start = max((text.rfind(c, end, first) for c in ".!?;:\n"), default=-1) + 1 or end
            stop = CLAUSE_END.search(text, last)
            stop = stop.start() if stop else len(text)
            matched = self.clause(TOKEN.findall(text[start:stop]))
            if matched:
                found.append(matched)
            end = stop
        return found

    def features(self, text: str | None) -> list[float]:
        """Counts of each class (logarithmic), strongest and mean clause, and the bias."""
        text = (text or "").lower()
        found = self.clauses(text)
        count = Counter(c for c, _ in found)
        strength = [s for _, s in found]
        return [
            *(math.log1p(count[c]) for c in CLASSES), float(bool(found)), min(20.0, max(strength, default=0.0)),
            min(20.0, sum(strength) / len(strength)) if strength else 0.0, 1.0,
        ]

    def score(self, text: str | None) -> float:
        value = float(np.dot(self.features(text), self.weights))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))


@lru_cache(maxsize=4)
def _grammar(terms: tuple, weights: tuple | None) -> Grammar:
    return Grammar(dict(terms), list(weights) if weights else None)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Penalised maximum-likelihood weights by Newton steps; the last column is the bias."""
    weights, ridge = np.zeros(x.shape[1]), penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * len(y), x.T @ (p - y) + ridge @ weights * len(y))
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W\d_]+", text.lower())


def _keys(words: list[str]) -> list[int]:
    """Four minimum hashes over the five-word shingles (signed), equal for most near copies."""
    shingles = {" ".join(words[k:k + 5]) for k in range(max(1, len(words) - 4))}
    hashes = np.array([xxhash.xxh64_intdigest(s) for s in shingles], np.uint64)
    return [int((hashes * np.uint64(odd)).min().astype(np.int64)) for odd in (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = SAMPLE_ROWS) -> Grammar:
    """Fit terms and weights on an expected ``rows`` labelled documents drawn by a hash of the key.

    Near copies count once, so a term needs support from texts of different content. Rows with a
    null key or label are left out.
    """
    labels = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(key, label)
    count = labels.count()
    draw = F.pmod(F.xxhash64(key, F.lit("toxic")), F.lit(1 << 40))
    drawn = labels.where(draw < F.lit(int((1 << 40) * min(1.0, rows / max(1, count)))))
    sample = docs.select(key, text).join(F.broadcast(drawn), key)  # bounded by ``rows``
    sample = stage(sample.select(F.coalesce(text, F.lit("")).alias("text"), F.col(label).cast("int").alias("label")), "labelled")

    keyed = map_batches(
        sample, lambda c: [c[0], c[1], *map(list, zip(*(_keys(_words(t)) for t in c[0])))],
        "text string, label int, k0 long, k1 long, k2 long, k3 long", "text",
    )
    for k in range(4):
        keyed = keyed.dropDuplicates([f"k{k}"])

    def terms_of(columns: list[list]) -> list:
        seen: dict[str, list[int]] = {}
        for value, toxic in zip(*columns):
            own = set()
            for word in set(_words(value)):
                own.add(word + "$")
                own.update(word[:n] for n in PREFIXES if len(word) >= n)
            for term in own:
                seen.setdefault(term, [0, 0])[toxic] += 1
        return [list(seen), [v[1] for v in seen.values()], [v[0] for v in seen.values()]]

    keyed = stage(keyed.select("text", "label"), "labelled")
    counts = map_batches(keyed, terms_of, "term string, a long, b long", "text", 1_000_000).groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    found = counts.where((F.col("a") >= SUPPORT) & (F.col("a") >= PRECISION * (F.col("a") + F.col("b")))).orderBy(
        F.desc("a"), F.length("term"), "term"
    ).limit(TERMS).collect()
    terms: dict[str, float] = {}
    for term, a, b in sorted(map(tuple, found), key=lambda r: (len(r[0].rstrip("$")), r[0])):
        word = term.rstrip("$")
        if not any(word[:n] in terms for n in PREFIXES if n <= len(word)):
            terms[term] = math.log((a + 0.5) / (b + 0.5))

    grammar = _grammar(tuple(terms.items()), None)
    packed = grammar.terms

    def rows_of(columns: list[list]) -> list:
        own = _grammar(tuple(packed.items()), None)
        return [[own.features(v) for v in columns[0]], columns[1]]

    x = map_batches(keyed, rows_of, "x array<double>, y int", "text").collect()
    if x:
        weights = _logistic(np.array([r["x"] for r in x]), np.array([float(r["y"]) for r in x]))
    else:
        weights = np.zeros(len(CLASSES) + 4)
    return Grammar(terms, weights.tolist())


def score(docs: DataFrame, grammar: Grammar, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``key``, those of ``keep`` and ``score`` (0 to 1) per row, repeated rows included.

    Null and empty texts match nothing and get the score of a text without matches. Whole texts are
    searched. An empty table gives no rows. Nothing is shuffled.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    terms, weights = tuple(grammar.terms.items()), tuple(grammar.weights)
    names = [key, *keep]
    source = docs.select(*names, F.col(text).alias("_scored"))
    types = [f.type for f in to_arrow_schema(source.schema)][:-1]

    def work(columns: list[list]) -> list:
        own = _grammar(terms, weights)
        return [*(pa.array(c, t) for c, t in zip(columns, types)), [own.score(v) for v in columns[-1]]]

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return map_batches(source, work, f"{kinds}, score double", "_scored")
