"""Registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from lumenvox.llm.embedding_dedup import embedding_duplicates
from lumenvox.llm.exact_dedup import exact_groups
from lumenvox.llm.license_scan import license_digests
from lumenvox.llm.merkle import manifest_digests
from lumenvox.llm.mixing import mix
from lumenvox.llm.packing import packed_documents
from lumenvox.llm.quality import judged
from lumenvox.llm.secret_scan import secret_digests
from lumenvox.llm.simhash import hex_digits, near_duplicates
from lumenvox.llm.suffix_dedup import remove_repeats
from lumenvox.llm.token_files import token_file_digests
from lumenvox.llm.toxicity import toxicity
from lumenvox.llm.toxicity import train as train_toxicity
from lumenvox.llm.vector_codes import code_digests


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(_table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
n AS (SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT a AS id, a AS reach FROM p UNION SELECT r.id, p.b FROM r JOIN p ON r.reach = p.a),
c AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id),
k AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT v.vec_id, coalesce(k.n_links, 0)::BIGINT AS n_links, coalesce(c.component_id, v.vec_id) AS component_id, coalesce(c.component_id, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN k ON k.a = v.vec_id LEFT JOIN c ON c.id = v.vec_id
"""


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits("f0").alias("fingerprint"), "component_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity(docs, train_toxicity(docs, _table(spark, sf_dir, "labels")))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM w),
r AS (SELECT doc_id, i, max(i + 50) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM m WHERE first < doc_id),
g AS (SELECT doc_id, i, sum(CASE WHEN upto IS NULL OR i > upto THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
s AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM s),
t AS (SELECT d.doc_id, string_agg(substr(d.h, 2 * k.z + 1, 2 * (k.a - k.z)), '' ORDER BY k.a) || substr(any_value(d.h), 2 * max(k.b) + 1) AS kept, sum(k.b - k.a) AS n_removed, count(*) AS n_spans
      FROM k JOIN d ON d.doc_id = k.doc_id GROUP BY d.doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(t.n_removed, 0)::BIGINT AS n_removed, coalesce(t.n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(t.kept, d.h))) AS kept_sha256
FROM d LEFT JOIN t ON t.doc_id = d.doc_id
"""


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _op5_round(r: int) -> str:
    """A round of filling: the running sum by hash of what fits the gap, up to the first that does not."""
    return f"""
c{r} AS (SELECT d.source, d.hash, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.hash RANGE UNBOUNDED PRECEDING) AS upto, p.gap{r - 1} AS gap
         FROM d JOIN p{r - 1} p ON d.source IS NOT DISTINCT FROM p.source
         WHERE {f"d.hash >= p.from{r - 1} AND d.size <= p.gap{r - 1} AND " if r > 1 else ""}p.gap{r - 1} >= 1),
e{r} AS (SELECT source, min(hash) FILTER (WHERE upto > gap) AS t, coalesce(max(upto) FILTER (WHERE upto <= gap), 0) AS u FROM c{r} GROUP BY source),
p{r} AS (SELECT p.*, CASE WHEN p.gap{r - 1} >= 1 THEN coalesce(e.t, 1152921504606846976) ELSE {f"p.from{r - 1}" if r > 1 else "0"} END AS from{r},
                CASE WHEN e.t IS NOT NULL THEN p.gap{r - 1} - e.u ELSE 0 END AS gap{r}
         FROM p{r - 1} p LEFT JOIN e{r} e ON p.source IS NOT DISTINCT FROM e.source)"""


OP5_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ' ' || coalesce(text, '')), 1, 15))::BIGINT AS hash FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
r AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio FROM w),
l AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS left_size, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS left_weight
      FROM r WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT min(ratio) AS ratio, arg_min(left_size, ratio) AS left_size, arg_min(left_weight, ratio) AS left_weight FROM l WHERE cap * left_weight > left_size * weight),
t AS (SELECT l.source, l.source_size, CASE WHEN l.ratio >= o.ratio AND l.cap * l.left_weight > l.left_size * l.weight THEN o.left_size * l.weight / o.left_weight ELSE l.cap END AS target FROM l, o),
p0 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
              target - (CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END) * source_size AS gap0 FROM t),
{",".join(_op5_round(r) for r in (1, 2, 3))}
SELECT d.doc_id, d.size, p.source_size, p.target,
       d.size * (p.whole + CASE WHEN d.hash < from1 OR (d.size <= gap1 AND d.hash >= from1 AND d.hash < from2) OR (d.size <= gap2 AND d.hash >= from2 AND d.hash < from3) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM d JOIN p3 p ON d.source IS NOT DISTINCT FROM p.source
"""


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = judged(docs, _table(spark, sf_dir, "labels"))
    return found.select("row.doc_id", "row.lang", "n_words", "perplexity", "compared", "threshold", "kept")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keeps_space=True, end_id=2)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


OP8_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return token_file_digests(_table(spark, sf_dir, "documents"), path, keeps_space=False, end_id=2, vocabulary=49408)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_digests(_table(spark, sf_dir, "embeddings"))


def _op11_round(r: int) -> str:
    """Codes ``a<r>`` by the codebooks ``c<r>``, and the codebooks of the next round."""
    return f"""
a{r} AS MATERIALIZED (SELECT vec_id, label, p, any_value(x) AS x, arg_min(e, d * 64 + e) AS e, min(d) AS d
        FROM (SELECT vec_id, label, v.p, x, e, list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v JOIN c{r} c ON c.p = v.p)
        GROUP BY vec_id, label, p),
m{r} AS (SELECT p, e, list(CASE WHEN s < 0 AND s % n <> 0 THEN s // n - 1 ELSE s // n END ORDER BY j) AS y
        FROM (SELECT p, e, j, sum(x[j])::HUGEINT AS s, count(*) AS n FROM a{r}, range(1, 257) t(j) WHERE j <= len(x) GROUP BY p, e, j) GROUP BY p, e),
c{r + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.y, c.y) AS y FROM c{r} c LEFT JOIN m{r} m ON m.p = c.p AND m.e = c.e)"""


OP11_SQL = f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT vec_id, label, p, x[p * len(x) // 16 + 1 : (p + 1) * len(x) // 16] AS x FROM k, range(16) t(p)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT 64),
c0 AS MATERIALIZED (SELECT v.p, f.e, v.x AS y FROM f JOIN v ON v.vec_id = f.vec_id),
{",".join(_op11_round(r) for r in range(3))},
h AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2),
o AS (SELECT vec_id, label, lower(string_agg(printf('%02x', e), '' ORDER BY p)) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id, label)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM o, h
"""


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digests(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_digests(_table(spark, sf_dir, "documents"))


def _op13_levels(name: str, levels: int) -> str:
    """Levels of the trees over the nodes ``<name>0`` (grp, idx, size, hash), with each node's siblings before and after it."""
    run = "PARTITION BY grp, idx // 16 ORDER BY idx ROWS BETWEEN"
    return ",\n".join(
        f"""{name}{k}s AS MATERIALIZED (SELECT grp, idx, size, coalesce(string_agg(hash, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                  coalesce(string_agg(hash, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k}),
{name}{k + 1} AS MATERIALIZED (SELECT grp, idx // 16 AS idx, any_value((size + 15) // 16) AS size,
                  CASE WHEN any_value(size) > 1 THEN sha256(string_agg(hash, '' ORDER BY idx)) ELSE any_value(hash) END AS hash FROM {name}{k} GROUP BY grp, idx // 16)"""
        for k in range(levels)
    )


def _op13_way(rows: str, name: str, levels: int) -> str:
    """``rows`` (grp, idx, fold, proof) with the fold and the proof carried up over the levels of ``name``."""
    for k in range(levels):
        rows = f"""SELECT w.* EXCLUDE (fold, proof), CASE WHEN s.size > 1 THEN sha256(s.l || w.fold || s.r) ELSE w.fold END AS fold, w.proof || s.l || s.r AS proof
FROM ({rows}) w JOIN {name}{k}s s ON s.grp = w.grp AND s.idx = w.idx // {16**k}"""
    return rows


def _op13_leaf(text: str) -> str:
    fields = [f"coalesce(octet_length(encode({c}))::VARCHAR || ':' || {c}, '-')" for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)]
    return f"sha256({' || '.join(fields)})"


OP13_SQL = f"""
WITH c AS (SELECT *, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda b: [ord(b)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
                  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS crc FROM documents),
d AS MATERIALIZED (SELECT doc_id, source, {_op13_leaf("text")} AS leaf,
                  CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN {_op13_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other FROM c),
e AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
                  count(*) OVER (PARTITION BY source) AS size FROM d),
n0 AS (SELECT grp, idx, size, leaf AS hash FROM e),
{_op13_levels("n", 6)},
t0 AS MATERIALIZED (SELECT 0 AS grp, grp AS idx, count(*) OVER () AS size, hash FROM n6),
{_op13_levels("t", 4)},
w AS ({_op13_way("SELECT grp, idx, doc_id, leaf, coalesce(other, leaf) AS fold, '' AS proof FROM e", "n", 6)}),
v AS (SELECT * FROM ({_op13_way("SELECT 0 AS grp, w.grp AS idx, doc_id, leaf, n6.hash AS subroot, fold, proof FROM w JOIN n6 ON n6.grp = w.grp", "t", 4)}))
SELECT doc_id, leaf, subroot, t4.hash AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = t4.hash AS verified FROM v, t4
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_embedding_dedup": op1_embedding_dedup,
        "op2_simhash": op2_simhash,
        "op3_toxicity": op3_toxicity,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_mixing": op5_mixing,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_secret_scan": op9_secret_scan,
        "op10_token_files": op10_token_files,
        "op11_vector_codes": op11_vector_codes,
        "op12_license_scan": op12_license_scan,
        "op13_merkle_manifest": op13_merkle_manifest,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_embedding_dedup": OP1_SQL, "op4_suffix_dedup": OP4_SQL, "op5_mixing": OP5_SQL, "op8_exact_dedup": OP8_SQL, "op11_vector_codes": OP11_SQL, "op13_merkle_manifest": OP13_SQL}
