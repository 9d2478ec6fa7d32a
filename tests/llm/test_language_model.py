"""What the language model counts and learns from, by brute force."""

import inspect
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F

from surveyloom import session
from surveyloom.llm import attention_lm

START, END = 900, 901


def test_every_slice_gets_every_count(spark, monkeypatch):
    monkeypatch.setattr(attention_lm, "SLICE_SUBWORDS", 100)
    assert "entries" not in inspect.signature(attention_lm.score).parameters
    draw = random.Random(4)
    docs = [(k, k % 4 != 1, [int(draw.paretovariate(0.4)) % 60 for _ in range(draw.randrange(0, 90))]) for k in range(60)]
    tokens = spark.createDataFrame([(k, t, bytearray(np.array(ids, np.uint16).tobytes())) for k, t, ids in docs], "row long, trained boolean, ids binary")
    sliced = attention_lm.slices(tokens, START, END, 2000)
    parts = {1: 3, 2: 5}
    found = [
        attention_lm.answers(sliced, attention_lm.count_table(tokens.select("trained", "ids"), o, START, END, parts[o]), o, START, parts[o]).toPandas()
        for o in (1, 2)
    ]
    counts, totals, kinds = (defaultdict(Counter) for _ in range(3))
    for order in (1, 2):
        for _, trained, ids in docs:
            line = [START, START, *ids, END]
            for k in range(2, len(line)):
                if trained:
                    counts[order][*line[k - order:k], line[k]] += 1
        for key, n in counts[order].items():
            totals[order][key[:-1]] += n
            kinds[order][key[:-1]] += 1
    rare = 0
    for row in sliced.toPandas().itertuples():
        line, _, _, lengths = attention_lm._read(row.line, row.about)
        own = [f[f["slice"] == row.slice] for f in found]
        single = np.ones(attention_lm.LIMIT, np.float32)
        model = attention_lm.Counts.of(single, line, lengths, pd.concat(own), START, parts)
        for order, (keys, *values) in ((1, model.pairs), (2, model.triples)):
            for key, *got in zip(keys.tolist(), *values):
                name = tuple(key >> 16 * k & 65535 for k in range(order, -1, -1))
                assert got == [counts[order][name], totals[order][name[:-1]], kinds[order][name[:-1]]]
                rare += got[0] == 1
    assert rare > 100


def test_every_window_is_learnt_from():
    lengths = np.array([50, 3, 200, 17])
    line = np.arange(lengths.sum(), dtype=np.uint16)
    trained = np.array([True, False, True, True])
    _, goal = attention_lm.training_windows(line, np.arange(4), trained, lengths)
    starts = np.cumsum(lengths) - lengths
    want = [k for s, n, on in zip(starts, lengths, trained) if on for k in range(s + 1, s + n)]
    assert sorted(goal[goal >= 0].tolist()) == want


def test_slices_are_answered_by_one_shuffle_of_their_own_counts(spark, monkeypatch):
    monkeypatch.setattr(attention_lm, "SLICE_SUBWORDS", 100)
    draw = random.Random(5)
    docs = [(k, k % 3 != 1, [draw.choice((1, 2, 3, START)) for _ in range(draw.randrange(0, 40))]) for k in range(40)]
    tokens = spark.createDataFrame([(k, t, bytearray(np.array(ids, np.uint16).tobytes())) for k, t, ids in docs], "row long, trained boolean, ids binary")
    sliced = attention_lm.slices(tokens, START, END, 800)
    for order in (1, 2):
        table = attention_lm.count_table(tokens.select("trained", "ids"), order, START, END, 3)
        want, got = (
            sorted((r["slice"], r["part"], bytes(r["blob"])) for r in attention_lm.answers(sliced, t, order, START, 3).collect()) for t in (table, None)
        )
        assert want and got == want


def test_tables_go_once_they_are_used(spark):
    folder = session.staged_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    docs = spark.createDataFrame([(k, f"some words {k % 7} of a text") for k in range(30)], "doc_id long, text string")
    scored = attention_lm.score(docs, F.col("doc_id") % 5 == 1, public_tokenizers.path("word_bpe_49k.json"))
    left = Counter(name.partition("-")[0] for name in set(os.listdir(folder)) - before)
    assert left == {"documents": 1, "logs": 1, "slices": 1, "answers": 2, "counts": 1, "scores": 1}
    assert scored.count() == 30
