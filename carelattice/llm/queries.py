"""Registered queries of the pipeline operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from carelattice.llm import decontamination, html_layout, license_vote, merkle, neardup, ngram_trie, piece_lattice, rule_ledger, sharding, speculative_bpe, training_order, va_file, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_warc",
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS n, sha256(h) AS digest FROM p),
g AS (SELECT digest, min(page_id) AS first, count(*) AS c FROM q WHERE n >= 100 GROUP BY digest)
SELECT q.page_id, q.n::BIGINT AS payload_bytes, q.digest AS payload_digest,
       CASE WHEN g.c > 1 AND q.page_id IS DISTINCT FROM g.first AND g.first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.c > 1 AND q.page_id IS DISTINCT FROM g.first THEN g.first END AS refers_to
FROM q LEFT JOIN g ON q.digest = g.digest AND q.n >= 100
""",
)
def op1_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op2_sharding")
def op2_sharding(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return sharding.shuffle_into_shards(docs, shards=40, seed=17).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op3_decontamination")
def op3_decontamination(spark, sf_dir):
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op4_minhash_tensor",
    r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(r.b) AS component_id, n.doc_id = min(r.b) AS kept FROM n JOIN reach r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
""",
)
def op4_minhash_tensor(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_html_layout")
def op5_html_layout(spark, sf_dir):
    shown = html_layout.extract(table(spark, sf_dir, "pages").select("page_id", "html"))
    lines = F.when(F.col("text") == "", F.lit(0)).otherwise(F.size(F.split("text", "\n")))
    return shown.select("page_id", "text", F.length("text").cast("long").alias("n_chars"), lines.cast("long").alias("n_lines"))


@query("op6_training_order")
def op6_training_order(spark, sf_dir):
    order = training_order.materialise(table(spark, sf_dir, "documents"))
    return training_order.read(spark, order, ids=False)


@query("op7_sentencepiece")
def op7_sentencepiece(spark, sf_dir):
    coded = piece_lattice.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), piece_lattice.public_pieces())
    return coded.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "round_trip")


@query("op8_license_scan")
def op8_license_scan(spark, sf_dir):
    return license_vote.scan(table(spark, sf_dir, "documents"))


@query(
    "op9_quality_rules",
    r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^ \t-\r]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS l FROM d),
win AS (SELECT rid, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
hit AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + k)::BIGINT AS n FROM hit, (SELECT unnest(range(0, 8)) AS k) GROUP BY rid),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN rep USING (rid)),
b AS (SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT + 4 * (100 * n_symbols > 20 * word_chars)::BIGINT
             + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 20 * n_words)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_bits & 3) <> 0 AS base_failed, (failed_bits & 63) = 0 AS kept,
       n_lines, failed_bits FROM b
""",
)
def op9_quality_rules(spark, sf_dir):
    book = rule_ledger.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rule_ledger.passes(rule_ledger.BASE)).alias("base_failed"), rule_ledger.passes(rule_ledger.CURRENT).alias("kept"), "n_lines", "failed_bits",
    )


@query("op10_ngram_lm")
def op10_ngram_lm(spark, sf_dir):
    return ngram_trie.fit_and_score(table(spark, sf_dir, "documents"), order=3, keep=1)


def _cluster_sql(k: int = 40, rounds: int = 5) -> str:
    far = "list_sum(list_transform(list_zip(v.v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    sql = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS n, v AS c FROM v QUALIFY n < {k})"""
    for r in range(rounds + 1):
        sql += f""",
a{r} AS MATERIALIZED (SELECT rid, arg_min(n, (d, n)) AS n, min(d) AS d FROM (SELECT v.rid, c.n, {far} AS d FROM v, c{r} c) GROUP BY rid)"""
        if r < rounds:
            sql += f""",
m{r} AS (SELECT n, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS guess, sum(x)::BIGINT AS s, count(*) AS q
  FROM (SELECT a.n, unnest(range(1, 65)) AS i, unnest(v.v) AS x FROM a{r} a JOIN v USING (rid)) GROUP BY n, i),
c{r + 1} AS MATERIALIZED (SELECT c.n, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN (
  SELECT n, list(guess + CASE WHEN guess * q > s THEN -1 WHEN (guess + 1) * q <= s THEN 1 ELSE 0 END ORDER BY i) AS c FROM m{r} GROUP BY n) m USING (n))"""
    return sql + f"""
SELECT v.vec_id, a.n::INT AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.n))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256 FROM v JOIN a{rounds} a USING (rid) JOIN c{rounds} c ON c.n = a.n
"""


@query("op11_va_file", _cluster_sql())
def op11_va_file(spark, sf_dir):
    return va_file.report(va_file.cluster(table(spark, sf_dir, "embeddings")))


def _merkle_sql(levels: int = 8) -> str:
    """Trees of up to 16 ** levels rows a source, level by level."""
    field = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = (
        "xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)), lambda a, b: "
        "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"
    )
    sql = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '-') AS tree, sha256({head} || {field.format("text")}) AS leaf,
  CASE WHEN coalesce({crc} % 5 = 0, FALSE) THEN sha256({head} || {field.format(low)}) END AS changed FROM documents),
a0 AS (SELECT rid, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS i, leaf AS h FROM d),
b0 AS (SELECT rid, doc_id, tree, i, leaf, '' AS proof, coalesce(changed, leaf) AS f FROM d JOIN a0 USING (rid, tree))"""

    def level(t: str, k: int) -> str:
        """Nodes a of the next level, rows b with their proof and folded digest; a tree of one node goes on unchanged."""
        return f""",
{t}n{k} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {t}{k}),
{t}{k + 1} AS (SELECT tree, i // 16 AS i, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {t}n{k} GROUP BY 1, i // 16),
b{t}{k + 1} AS (SELECT b.rid, b.doc_id, b.tree, b.own, b.i // 16 AS i, b.leaf, b.sub,
  b.proof || CASE WHEN max(x.n) = 1 THEN '' ELSE coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i <> b.i), '') END AS proof,
  CASE WHEN max(x.n) = 1 THEN b.f ELSE sha256(string_agg(CASE WHEN x.i = b.i THEN b.f ELSE x.h END, '' ORDER BY x.i)) END AS f
  FROM b{t}{k} b JOIN {t}n{k} x ON x.tree = b.tree AND x.i // 16 = b.i // 16 GROUP BY b.rid, b.doc_id, b.tree, b.own, b.i, b.leaf, b.sub, b.proof, b.f)"""

    sql = sql.replace("b0 AS (SELECT rid, doc_id, tree, i,", "ba0 AS (SELECT rid, doc_id, tree, tree AS own, '' AS sub, i,")
    sql += "".join(level("a", k) for k in range(levels))
    sql += f""",
t0 AS (SELECT '' AS tree, tree AS own, row_number() OVER (ORDER BY tree) - 1 AS i, h FROM a{levels}),
bt0 AS (SELECT b.rid, b.doc_id, t.tree, t.own, t.h AS sub, t.i, b.leaf, b.proof, b.f FROM ba{levels} b JOIN t0 t ON t.own = b.tree)"""
    sql += "".join(level("t", k) for k in range(levels))
    return sql + f"""
SELECT doc_id, leaf, sub AS subroot, r.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = r.h AS verified FROM bt{levels}, t{levels} r
"""


@query("op12_merkle_manifest", _merkle_sql())
def op12_merkle_manifest(spark, sf_dir):
    return merkle.audit(table(spark, sf_dir, "documents"))


@query("op13_speculative_bpe")
def op13_speculative_bpe(spark, sf_dir):
    bpe = speculative_bpe.public_bpe()
    coded = speculative_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), bpe, packed=True, keep=["doc_id"])
    back = speculative_bpe.decode(coded, bpe, text="decoded")
    n = F.shiftright(F.octet_length("token_ids"), 2).cast("long")
    return back.select("doc_id", n.alias("n_tokens"), F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
