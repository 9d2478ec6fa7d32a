"""Registered queries of the operators, each over its whole table, and SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm import (
    attention_lm, bpe, forest, licenses, merkle, packing, repeats, secret_scan, sharding, simhash, topk, toxicity, turns,
)
from surveyloom.llm.common import crc_fold, read

QUERIES, SQL = {}, {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the group of near-duplicates it belongs to."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every vector at cosine 0.93 inside its label, and the group it belongs to."""
    return forest.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of one fold in four are never seen."""
    docs, held_out = read(spark, sf_dir, "documents"), crc_fold("doc_id", 4) == 2
    grammar = toxicity.train(docs, read(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, grammar).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of nearly equal bytes over all documents."""
    placed = sharding.shard(read(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _joined(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector with all others."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


@query
def op6_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of every document by the attention model and by whole-word counts."""
    return attention_lm.score(
        read(spark, sf_dir, "documents"), crc_fold("doc_id", 5) == 1, public_tokenizers.path("word_bpe_49k.json")
    )


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document, by fixed patterns and the trained field."""
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in secret_scan.KINDS
    ]
    base = F.filter("spans", lambda s: s["kind"] != secret_scan.ADDED)
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )


@query
def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document without the 13-word windows that smaller documents hold."""
    left = repeats.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document's pieces in sequences of at most 4096 tokens."""
    return packing.pack(
        read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1,
        derive={"ids_crc32": F.crc32("ids")},
    )


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to."""
    coded = bpe.encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether the proof holds with every third one tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claim = F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    found = merkle.manifest(
        read(spark, sf_dir, "documents"), [F.col(c) for c in LEAF],
        claim=F.when(tampered, merkle.leaf(*[F.col(c) for c in LEAF[:-1]], claim)),
    )
    folded = found.withColumn("folded_root", merkle.fold(F.coalesce("claim", "leaf"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    found = licenses.scan(read(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    labels = lambda matches: F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with planted faults, chosen by crc32 of ``conv_id:turn``; ``present`` is false where one is dropped."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.pmod(F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")), F.lit(20))
    text = F.when(code == 1, F.lit("")).when(code == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    copies = F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        "conv_id", "turn", F.when(code == 4, F.lit("user")).otherwise(blank("role")).alias("role"), text.alias("text"),
        (code != 0).alias("present"), F.explode(copies).alias("copy"),
    ).drop("copy")


@query
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after planted damage."""
    return turns.repair(damaged(read(spark, sf_dir, "conversations")), present=F.col("present"))


SQL["op2_forest"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), usable AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id) AS n_links,
  (SELECT min(b) FROM reach WHERE reach.a = v.vec_id) AS component_id,
  v.vec_id = (SELECT min(b) FROM reach WHERE reach.a = v.vec_id) AS kept
FROM v
"""

SQL["op5_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS z FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.z, c.z), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

SQL["op8_substrings"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS passage
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)
), firsts AS (
  SELECT passage, min(doc_id) AS first FROM windows GROUP BY passage
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN firsts USING (passage) WHERE first < doc_id
), lost AS (
  SELECT doc_id, list(i) AS cut FROM gone GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(len(cut), 0) AS n_removed,
  sha256(array_to_string(list_filter(words, lambda x, i: NOT list_contains(coalesce(cut, []), i)), ' ')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id)
"""


def _crc32(text: str) -> str:
    """SQL of the unsigned crc32 of an ASCII text."""
    step = "xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)"
    one = f"list_reduce(range(8), lambda x, i: {step}, xor(c, b))"
    codes = f"list_transform(string_split({text}, ''), lambda z: ord(z)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: {one}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _manifest_sql() -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(field, (*LEAF[:-1], text)))})"

    tampered = f"{_crc32('doc_id::VARCHAR')} % 3 = 0"
    return merkle.sql(leaf("text"), f"CASE WHEN {tampered} THEN {leaf(f'translate(text, {UPPER!r}, {LOWER!r})')} ELSE {leaf('text')} END")


def _repair_sql() -> str:
    """The cheapest path forward, turn by turn: for each state the least (cost, letters, turns written)."""
    def after(s: str, cost: str, letter: str, written: str = "") -> str:
        o = f"w.{s}.o || CASE WHEN w.{s}.o = '' THEN '' ELSE chr(10) END || {written}" if written else f"w.{s}.o"
        return f"CASE WHEN w.{s} IS NOT NULL THEN {{'c': w.{s}.c + {cost}, 'a': w.{s}.a || '{letter}', 'o': {o}}} END"

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    def keep(s: str, initial: str) -> str:
        return f"CASE WHEN must = 0 AND i = '{initial}' THEN {after(s, 'late', 'K', 'role || chr(58) || text')} END"

    def rerole(s: str, role: str) -> str:
        return f"CASE WHEN must = 0 THEN {after(s, '2 + late', 'R', f'{chr(39)}{role}:{chr(39)} || text')} END"

    def insert(s: str, role: str) -> str:
        return after(s, "2", "I", f"'{role}:'")

    base = {
        "s0": least(after("s0", "3", "D")), "s1": least(after("s1", "3", "D"), keep("s0", "s")),
        "s2": least(after("s2", "3", "D"), *(f(s, r) for s in ("s0", "s1", "s3") for f, r in ((keep, "u"), (rerole, "user")))),
        "s3": least(after("s3", "3", "D"), keep("s2", "a"), rerole("s2", "assistant")),
    }
    first = "{'c': 0::BIGINT, 'a': '', 'o': ''}"
    none = f"CASE WHEN false THEN {first} END"
    spaces = "' ' || " + " || ".join(f"chr({k})" for k in range(9, 14))
    # Inserts behind a turn: a user's turn after any state, then an assistant's.
    user = f"SELECT * REPLACE ({least('w.s2', *(insert(s, 'user') for s in ('s0', 's1', 's3')))} AS s2) FROM"
    assistant = f"SELECT * REPLACE ({least('w.s3', insert('s2', 'assistant'))} AS s3) FROM"
    return rf"""
WITH RECURSIVE turns AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS n, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS code
  FROM conversations
), damaged AS (
  SELECT n, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM turns WHERE code <> 0
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY turn NULLS FIRST, role, text, copy) AS k,
    left(role, 1) AS i, rtrim(text, {spaces}) AS seen
  FROM damaged
), faults AS (
  SELECT *, CASE WHEN seen = '' THEN 1 WHEN row_number() OVER (PARTITION BY n, role, text ORDER BY k) > 1 THEN 2
      WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(i) OVER (PARTITION BY n ORDER BY k) AS before
  FROM ordered
), marked AS (
  SELECT n, k, role, text, i, (fault IN (1, 2))::INT AS must, (fault = 3)::INT AS late FROM faults
), walk AS (
  SELECT DISTINCT n, 0::BIGINT AS k, {first} AS s0, {none} AS s1, {{'c': 2::BIGINT, 'a': 'I', 'o': 'user:'}} AS s2,
    {{'c': 4::BIGINT, 'a': 'II', 'o': 'user:' || chr(10) || 'assistant:'}} AS s3 FROM turns
  UNION ALL
  {assistant} ({user} (
    SELECT w.n, m.k, {", ".join(f"{sql} AS {name}" for name, sql in base.items())} FROM walk w JOIN marked m ON m.n = w.n AND m.k = w.k + 1
  ) w) w
), last AS (
  SELECT n, list_min([arg_max(s0, k), arg_max(s3, k)]) AS best FROM walk GROUP BY n
), counts AS (
  SELECT n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY n
)
SELECT DISTINCT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(best.o) AS repaired_sha256
FROM turns JOIN last USING (n) LEFT JOIN counts USING (n)
"""


SQL["op11_merkle"] = _manifest_sql()
SQL["op13_conversations"] = _repair_sql()
