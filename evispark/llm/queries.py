"""The subpackage's queries over the synthetic tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from evispark.llm import embeddings, jaccard, licenses, manifest, packing, piece_codec, quality, resampling, sharding, substring, suffixes, topk, toxicity


TOP_K_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p
QUALIFY rank <= 5"""

NEAR_SQL = """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
WHERE list_inner_product(a.e, b.e) >= 0.93 * sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id, least(e.vec_id, coalesce(m, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN least ON least.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""

WORDS_SQL = "list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

JACCARD_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS_SQL.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s), t AS (SELECT doc_id, unnest(s) AS t FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, least(n.doc_id, coalesce(m, n.doc_id)) AS component_id FROM n LEFT JOIN least ON least.a = n.doc_id"""

_COVERED = """w AS (SELECT doc_id, {words} AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - {width} + 2)) AS i, w FROM w WHERE len(w) >= {width}),
g AS (SELECT doc_id, i, array_to_string(w[i:i + {width} - 1], ' ') AS g FROM p),
r AS ({repeated}),
x AS (SELECT DISTINCT doc_id, i + unnest(range({width})) AS i FROM r),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
k AS (SELECT doc_id, count(*) AS n, count(x.i) AS gone, string_agg(word, ' ' ORDER BY words.i) FILTER (x.i IS NULL) AS kept FROM words LEFT JOIN x USING (doc_id, i) GROUP BY doc_id)"""

SUBSTRING_SQL = f"""WITH {_COVERED.format(words=WORDS_SQL.format(text="coalesce(text, '')"), width=35, repeated="SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY g) > 1")}
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents LEFT JOIN k USING (doc_id)"""

SUFFIX_SQL = f"""WITH {_COVERED.format(words=WORDS_SQL.format(text="coalesce(text, '')"), width=50, repeated="SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1")}
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(gone, 0) AS n_removed, coalesce(kept, '') AS text FROM documents LEFT JOIN k USING (doc_id)"""


#: A table of one list: the CRC-32 of each byte.
CRC_TABLE_SQL = """tab AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n::BIGINT], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""
_HEX = "strpos('0123456789ABCDEF', substr(hex({x}), 2 * i + {at}, 1)) - 1"
#: The unsigned CRC-32 of the UTF-8 bytes of {x}, beside CRC_TABLE_SQL.
CRC_SQL = f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, octet_length(encode({{x}}))), lambda i: (({_HEX.format(x='{x}', at=1)}) * 16 + {_HEX.format(x='{x}', at=2)})::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"

_RUNS_SQL = """{name}w AS (SELECT {id} AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM {table}),
{name}f AS (SELECT id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM {name}w),
{name}c AS (SELECT id, f, count(*) AS n FROM {name}f GROUP BY ALL)"""

IMPORTANCE_SQL = f"""WITH {CRC_TABLE_SQL}, {_RUNS_SQL.format(name='d', id='doc_id', table='documents')}, {_RUNS_SQL.format(name='b', id='item_id', table='benchmark')},
x AS (SELECT f, {CRC_SQL.format(x='f')} % 10000 AS k FROM (SELECT DISTINCT f FROM (SELECT f FROM dc UNION ALL SELECT f FROM bc)), tab),
s AS (SELECT k, sum(n) AS s FROM dc JOIN x USING (f) GROUP BY k), t AS (SELECT k, sum(n) AS t FROM bc JOIN x USING (f) GROUP BY k),
n AS (SELECT CAST((SELECT coalesce(sum(s), 0) FROM s) AS DOUBLE) AS s_all, CAST((SELECT coalesce(sum(t), 0) FROM t) AS DOUBLE) AS t_all),
g AS (SELECT k, floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + 10000) / ((coalesce(s, 0) + 1) * (t_all + 10000)))) AS g FROM (SELECT DISTINCT k FROM x) LEFT JOIN s USING (k) LEFT JOIN t USING (k), n),
w AS (SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(g * n) / sum(n)) AS BIGINT) AS weight FROM dc JOIN x USING (f) JOIN g USING (k) GROUP BY id),
h AS (SELECT doc_id, list_reduce(list_concat([0::BIGINT], list_transform(range(1, 9), lambda i: (strpos('0123456789abcdef', substr(sha256('7:' || doc_id), i, 1)) - 1)::BIGINT)), lambda a, b: a * 16 + b) AS h FROM documents),
a AS (SELECT dw.id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score
FROM dw JOIN h ON h.doc_id = dw.id LEFT JOIN w ON w.id = dw.id),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM a WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN r <= 25 * (SELECT count(*) FROM r) // 100 THEN r END AS rank FROM a LEFT JOIN r USING (doc_id)"""

#: Levels of runs of 16 that the SQL writes out: enough for 16 million rows of a source.
SQL_LEVELS = 6


def _levels(name: str, tree: str) -> str:
    """Levels name0, name1, ... of a tree's nodes (tree, i, d); a tree of one node stays as it is."""
    up = "CASE WHEN n = 1 THEN 0 ELSE i // 16 END"
    step = "{name}{above} AS (SELECT {tree}, {up} AS i, CASE WHEN max(n) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM (SELECT *, count(*) OVER (PARTITION BY {tree}) AS n FROM {name}{k}) GROUP BY {tree}, {up})"
    return ",\n".join(step.format(name=name, above=k + 1, k=k, tree=tree, up=up) for k in range(SQL_LEVELS))


def _siblings(name: str, k: int, node: str, tree: str) -> str:
    """Of the node i // 16 ** k the others of its run at level k: those before it and those after it."""
    at = f"{node} // {16**k}"
    run = f"SELECT string_agg(d, '' ORDER BY i) FROM {name}{k} s WHERE {tree} AND s.i // 16 = {at} // 16"
    return f"coalesce(({run} AND s.i < {at}), '') AS b{name}{k}, coalesce(({run} AND s.i > {at}), '') AS a{name}{k}"


def merkle_sql() -> str:
    fields = lambda text: " || ".join(f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", text))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [(name, k) for name in ("s", "t") for k in range(SQL_LEVELS)]
    proof = " || ".join(f"b{name}{k} || a{name}{k}" for name, k in steps)
    fold = "claimed"
    folds = []
    for name, k in steps:  # where a node has no others the tree has ended, but for a last run of one
        folds.append(f"f{name}{k} AS (SELECT * EXCLUDE (claimed), CASE WHEN n{name} > {16**k} THEN sha256(b{name}{k} || claimed || a{name}{k}) ELSE claimed END AS claimed FROM {fold if fold != 'claimed' else 'p'})")
        fold = f"f{name}{k}"
    own = ", ".join([_siblings("s", k, "r.i", "s.source IS NOT DISTINCT FROM r.source") for k in range(SQL_LEVELS)])
    top = ", ".join([_siblings("t", k, "u.i", "true") for k in range(SQL_LEVELS)])
    return f"""WITH {CRC_TABLE_SQL},
l AS (SELECT doc_id, source, sha256({fields('text')}) AS leaf, sha256({fields(f"CASE WHEN coalesce({CRC_SQL.format(x='CAST(doc_id AS VARCHAR)')} % 5 = 0, false) THEN {lower} ELSE text END")}) AS claimed FROM documents, tab),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS ns FROM l),
s0 AS (SELECT source, i, leaf AS d FROM r),
{_levels('s', 'source')},
t0 AS (SELECT 0 AS one, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, d, source FROM s{SQL_LEVELS}),
{_levels('t', 'one')},
u AS (SELECT u.source, u.d, {top}, (SELECT count(*) FROM t0) AS nt FROM t0 u),
q AS (SELECT r.*, {own} FROM r),
p AS (SELECT q.*, u.d AS subroot, nt, {', '.join(f'b{x}, a{x}' for x in (f't{k}' for k in range(SQL_LEVELS)))} FROM q JOIN u ON q.source IS NOT DISTINCT FROM u.source),
{', '.join(folds)}
SELECT doc_id, leaf, subroot, (SELECT d FROM t{SQL_LEVELS}) AS root, sha256({proof}) AS proof_sha256, claimed AS folded_root, claimed = (SELECT d FROM t{SQL_LEVELS}) AS verified FROM {fold}"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_table(spark))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeat_digests(table(spark, sf_dir, "documents"), 35)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.codec_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the words of the remaining texts joined by one space."""
    left = suffixes.remove_later_copies(table(spark, sf_dir, "documents"), 50)
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return left.withColumn("text", F.array_join(words, " "))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = resampling.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), seed=7, percent=25, least_words=20)
    return scores.select("doc_id", "n_features", "weight", "score", "rank")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id's CRC-32 is divisible by 5 claim a text with A-Z in lower case."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claims = {"text": F.when(F.coalesce(crc % 5 == 0, F.lit(False)), lower).otherwise(F.col("text"))}
    rows = manifest.verified(manifest.manifest(table(spark, sf_dir, "documents"), claims=claims))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", "verified")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sharded(table(spark, sf_dir, "documents"), 8, "rows")
    crc = F.crc32(F.coalesce("doc.text", F.lit("")).cast("binary"))
    return rows.select("doc.doc_id", "size", crc.alias("text_crc32"), "law", "shard", "slot", "grown_shard")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ngram_jaccard_join, op2_embedding_near_dedup, op3_quality_classifier, op4_exact_top_k, op5_license_scan, op6_substring_dedup, op7_sentencepiece, op8_suffix_array_dedup, op9_best_fit_packing, op10_toxicity, op11_importance_resampling, op12_merkle_manifest, op13_sharding)}


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_top_k": TOP_K_SQL, "op5_license_scan": licenses.scan_sql(), "op1_ngram_jaccard_join": JACCARD_SQL, "op2_embedding_near_dedup": NEAR_SQL, "op6_substring_dedup": SUBSTRING_SQL, "op8_suffix_array_dedup": SUFFIX_SQL, "op11_importance_resampling": IMPORTANCE_SQL, "op12_merkle_manifest": merkle_sql()}
