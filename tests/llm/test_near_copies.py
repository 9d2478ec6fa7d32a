"""The pipeline's near-copy stage against brute force over fingerprints."""

import random
from itertools import combinations

import pytest

import corpus_pipeline
from surveyloom.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fresh(draw: random.Random, count: int) -> list[str]:
    return [f"w{draw.randrange(100_000)}" for _ in range(count)]


def planted() -> list[str | None]:
    """Texts with one to eight words changed, a large group, a shared passage, short and empty texts."""
    draw, texts = random.Random(11), []
    for edits in (1, 2, 3, 4, 5, 6, 8) * 3:
        words = fresh(draw, 240)
        near = list(words)
        for at in draw.sample(range(240), edits):
            near[at] = f"new{draw.random()}"
        texts += [" ".join(words), " ".join(near)]
    words = fresh(draw, 400)
    texts += [" ".join([*words[:k], "x", *words[k + 1:]]) for k in range(60)]
    passage = fresh(draw, 100)
    texts += [" ".join(passage + fresh(draw, 20 + k % 30)) for k in range(30)]
    return [*texts, None, "", " \n", "one two", "One  TWO", "one two three"]


def brute(texts: list[str | None], distance: int = 3) -> list[int]:
    """Smallest place that links of fingerprints connect to each text."""
    prints = [simhash.fingerprint(t) for t in texts]
    root = list(range(len(texts)))

    def find(k: int) -> int:
        return k if root[k] == k else find(root[k])

    for i, j in combinations(range(len(texts)), 2):
        if ((prints[i] ^ prints[j]) & ((1 << 64) - 1)).bit_count() <= distance:
            low, high = sorted((find(i), find(j)))
            root[high] = low
    return [find(k) for k in range(len(texts))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, t, "en", "web", None) for k, t in enumerate(planted())], SCHEMA)


def test_stage_keeps_one_of_each_group(spark, docs):
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(k, planted()[k], "en", "web", None) for k in sorted(set(brute(planted())))]


@pytest.mark.parametrize(("distance", "crowded"), [(0, 256), (1, 2), (2, 256)])
def test_smaller_distances(docs, distance, crowded):
    kept = simhash.one_of_each(docs, crowded=crowded, distance=distance)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(brute(planted(), distance)))
    assert simhash.near_duplicates(docs, crowded=crowded, distance=distance).select("component_id").distinct().count() == kept.count()


def test_longer_distances_are_refused(docs):
    with pytest.raises(ValueError):
        simhash.near_duplicates(docs, distance=4)


def test_stage_keeps_one_of_each_group_of_repeated_and_missing_ids(spark):
    draw = random.Random(3)
    a, b, c, d = (" ".join(fresh(draw, 240)) for _ in range(4))
    rows = [(1, a), (2, a.upper()), (1, b), (3, b), (4, c), (None, c), (None, d), (None, d), (None, d + " ")]
    table = spark.createDataFrame([(k, t, "en", "web", None) for k, t in rows], SCHEMA)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, table, "").collect()]
    assert sorted(r for r in kept if r[0] is not None) == sorted([(1, a), (1, b), (4, c)])
    assert len(kept) == 4 and [r[1].strip() for r in kept if r[0] is None] == [d]


def test_extra_columns_stay(spark):
    table = spark.createDataFrame([(1, "a b c", 7, 8, 9), (2, "a b  c", 7, 8, 9)], "doc_id long, text string, fp int, row int, group int")
    assert [tuple(r) for r in simhash.one_of_each(table).collect()] == [(1, "a b c", 7, 8, 9)]
    assert simhash.one_of_each(table.limit(0)).count() == 0
