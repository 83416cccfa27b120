"""The registered queries of the operators: each applied to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline

from .collocations import collocations
from .divergence_rules import judged_documents
from .dual_tree_search import best_documents
from .grid_order_join import similar_vectors
from .jaccard_join import jaccard_components
from .language_codes import fit_languages, held_out, predict_languages
from .link_trust import judged
from .retrieval_packing import pack_documents
from .ring_shards import ring_shards
from .suffix_dedup import remove_repeats
from .tables import new_path
from .temperature_mix import mixed_sources
from .token_files import round_trip
from .tokens import BYTE_LEVEL, WORD_LEVEL
from .warc_store import read_captures, write_archive

LLM_QUERIES: dict = {}
LLM_ORACLES: dict[str, str] = {}


def _register(f):
    LLM_QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_register
def op1_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.95)


@_register
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = round_trip(_table(spark, sf_dir, "documents"), BYTE_LEVEL, end_id=0)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_register
def op3_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_documents(_table(spark, sf_dir, "documents"))


@_register
def op4_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixed_sources(docs, budget_share=1.0, evenness=0.97, repeats=4.0).drop("text")


@_register
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, length=100).drop("kept")


@_register
def op6_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ring_shards(_table(spark, sf_dir, "documents"), shards=8)
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return out.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@_register
def op7_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(_table(spark, sf_dir, "pages"), threshold=2.0)


@_register
def op8_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = predict_languages(docs.select("doc_id", "text", held_out().alias("held_out")), fit_languages(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@_register
def op9_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(_table(spark, sf_dir, "documents"), WORD_LEVEL, end_id=2, window=4096)
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


LLM_ORACLES["op10_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)
"""


@_register
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(_table(spark, sf_dir, "documents"), k=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


LLM_ORACLES["op11_collocations"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
i AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)),
f AS (SELECT lang, w[i:i + k - 1] AS g, count(*) AS f FROM i GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT * FROM f WHERE len(g) > 1),
k AS (SELECT lang, g, f, unnest(range(1, len(g))) AS k FROM c),
s AS (SELECT k.lang, k.g, k.f AS a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * k.f // (x.f + y.f))::BIGINT AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.g = k.g[1:k] JOIN f y ON y.lang = k.lang AND y.g = k.g[k + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
o AS (SELECT lang, f, len(g) AS long, g, unnest(range(1, len(g))) AS i FROM c),
u AS (SELECT lang, f, long, g, i, unnest(range(i + 1, long + 1)) AS j FROM o),
m AS (SELECT lang, g[i:j] AS g, max(f) AS f FROM u WHERE j - i + 1 < long GROUP BY ALL),
r AS (SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM b LEFT JOIN m ON m.lang = b.lang AND m.g = b.g
      WHERE m.f IS NULL OR 100 * m.f < 80 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM r JOIN t USING (lang) QUALIFY rank <= 2000
"""


@_register
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"), least=30, percent=80, top=2000)


LLM_ORACLES["op12_dual_tree_search"] = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM c GROUP BY 1),
a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM d),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM c, a GROUP BY term, docs),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // length))))::BIGINT AS score
      FROM q JOIN c USING (term) JOIN w USING (term) JOIN d USING (doc_id), a GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


@_register
def op12_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


LLM_ORACLES["op13_warc_store"] = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS h, max(page_id) OVER (PARTITION BY b) AS last FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM d
"""


@_register
def op13_warc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_archive(_table(spark, sf_dir, "pages"), path)
    return read_captures(spark, path).drop("url")


@_register
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
