"""Manifest against a tree built node by node, over groups of one leaf up to more than a block."""

import hashlib
import random
import re
import zlib
from itertools import groupby

import duckdb
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g int, rank long, node string, path string, claim string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """Root, and for each leaf its siblings (before, after) level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            run = nodes[at[i] // 8 * 8:at[i] // 8 * 8 + 8]
            path.append(("".join(run[:at[i] % 8]), "".join(run[at[i] % 8 + 1:])))
            at[i] //= 8
        nodes = [sha("".join(nodes[k:k + 8])) for k in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    made = [(d, t, g, s, n, sha("".join(map(encoded, (d, s, g, n, t))))) for d, t, g, s, n in rows]
    made.sort(key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, r[5]))
    groups = [list(own) for _, own in groupby(made, key=lambda r: r[2])]
    trees = [tree([r[5] for r in own]) for own in groups]
    root, tops = tree([t[0] for t in trees])
    out = []
    for own, (subroot, paths), top in zip(groups, trees, tops):
        for (d, t, g, s, n, leaf), path in zip(own, paths):
            path, text = path + top, t
            if d is not None and t is not None and zlib.crc32(str(d).encode()) % 3 == 0:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), t)
            folded = sha("".join(map(encoded, (d, s, g, n, text))))
            for before, after in path:
                folded = sha(before + folded + after)
            out.append((d, leaf, subroot, root, sha("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(out, key=repr)


def rows():
    draw = random.Random(2)
    sizes = {"en": 4200, "de": 513, "é": 512, "z": 65, "": 64, "fr": 9, "one": 1, None: 8}
    out = []
    for lang, size in sizes.items():
        for _ in range(size):
            text = draw.choice(["Some Text", "plain", "É Ü 日本", "", None]) and f"{draw.choice(['A', 'b'])} {draw.random()}"
            out.append((draw.randrange(100_000), text, lang, draw.choice(["web", None]), draw.choice([7, None])))
    out += [(None, "No Id", "en", None, None)] * 3 + [(5, "Twice", "de", "s", 1)] * 20 + [(6, "Long " * 400_000, "fr", "s", 1)]
    return out


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("manifest")
    table = spark.createDataFrame([(*r, 1, 2, "n", "p", "c") for r in rows()], SCHEMA).repartition(7)
    table.write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_query_equals_brute_force(spark, folder):
    got = queries.op11_merkle(spark, folder).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows())


def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet' WHERE doc_id IS NOT NULL")
    want = con.sql(queries.SQL["op11_merkle"]).select(", ".join(COLUMNS)).fetchall()
    assert sorted(want, key=repr) == brute([r for r in rows() if r[0] is not None])


def test_proofs_are_emitted_without_python(spark, folder):
    from tests.conftest import plan

    assert "Python" not in plan(queries.op11_merkle(spark, folder))


def test_empty_table_and_one_row(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert merkle.manifest(docs.limit(0), [F.col("text")]).count() == 0
    one = merkle.manifest(docs.where("lang = 'one'"), [F.col("text")]).collect()
    assert len(one) == 1 and one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] and one[0]["path"] == []
