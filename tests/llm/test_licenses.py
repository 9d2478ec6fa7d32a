"""License scans against a search word by word."""

import random
import re

import pytest

from surveyloom.llm import licenses, queries

SCHEMA = "doc_id long, text string, n_words int, matches string, places string"
HEADER = licenses.TEMPLATES[0][1]
PLACES = ["Released under the MIT License.", "apache-license, VERSION 2", "CC BY-NC 4.0", "under the mit licensed", "under the\tMIT  license"]


def texts():
    draw = random.Random(4)
    common = "under the mit license apache version 2 cc by nc of and software é Ñu 4 0 any".split()
    out = [None, "", " \n-\x7f", *PLACES, " ".join(PLACES * 3), "the " * 200_000 + "mit license under the mit license", "x" * 3_000_000]
    out += [" ".join(draw.choices(common, k=draw.randrange(400))) for _ in range(60)]
    return out


def brute(text):
    """Words, and the starts of each phrase."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        line = phrase.split()
        found += [(k, label) for k in range(len(words) - len(line) + 1) if words[k:k + len(line)] == line]
    starts, labels = [k for k, _ in found], sorted({label for _, label in found})
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(labels)


def test_base_of_the_query_equals_brute_force(spark, tmp_path):
    rows = [(k if k else None, t, 1, "m", "p") for k, t in enumerate(texts())] + [(3, texts()[3], 1, "m", "p")] * 2
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_licenses(spark, str(tmp_path)).collect()
    want = [(d, *brute(t)) for d, t, *_ in rows]
    assert sorted([tuple(r)[:6] for r in got], key=repr) == sorted(want, key=repr)
    for row in got:
        own = set(filter(None, row["labels"].split(",")))
        assert set(filter(None, row["base_labels"].split(","))) <= own and row["labels"] == ",".join(sorted(own))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(own) and (row["n_base"] == 0 or row["score"] == 1)


@pytest.fixture(scope="module")
def index():
    made = licenses.Index(licenses.PHRASES, licenses.TEMPLATES)
    return made.weigh(1000, {made.vocabulary[w]: 900 for w in "the of and to in this is under by a or for".split()})


def labels(index, text):
    return {(m[0], m[4]): m for m in index.look_up(index.hits(text)[1])}


def test_templates_allow_edits_and_need_key_phrases(index):
    draw, line = random.Random(1), HEADER.split()
    for _ in range(40):
        around = " ".join(draw.choices("prose with words of the file and this software".split(), k=draw.randrange(30)))
        edited = list(line)
        for at in draw.sample(range(8, len(line) - 5), 2):
            edited[at] = "changed"
        edited.insert(12, "more")
        found = labels(index, f"{around} {' '.join(edited).title()} {around}")
        assert ("mit", False) in found and found["mit", False][3] < 1
    assert not labels(index, " ".join(line[::2]))
    assert not labels(index, " ".join(random.Random(2).sample(line, len(line))))
    without = HEADER.replace("hereby granted", "given").replace("deal in", "use")
    assert ("mit", False) not in labels(index, without)


def test_every_template_finds_itself_at_its_place(index):
    for label, line, _ in licenses.TEMPLATES:
        found = [m for m in index.look_up(index.hits(f"some words before {line} and after")[1]) if m[0] == label]
        assert any(m[1] == 3 and m[2] == 3 + len(licenses.words(line)) and m[3] == pytest.approx(1) for m in found), line


def test_one_version_is_not_another(index):
    found = labels(index, "This work is licensed under the GNU General Public License, version 3.")
    assert {label for label, _ in found} == {"gpl-3"}


def test_many_places_and_empty_table(spark, index):
    found = index.look_up(index.hits("released under the mit license " * 20_000)[1])
    assert sum(m[4] for m in found) == sum(not m[4] for m in found) == 20_000
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        licenses.Index([("--", "none")], [])
