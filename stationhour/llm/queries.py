"""Registered queries of the operators: thin, over whole tables, with their SQL where SQL can express them."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationhour.llm import (compression_quality, decontamination, embedding_whitening, html_text, jaccard_join, language_id, merkle, packing,
                             quality_rules, sharding, simhash)
from stationhour.llm.substring_dedup import remove_repeated_words
from stationhour.llm.suffix_dedup import remove_repeated_bytes
from stationhour.session import write_shared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"), shards=24)
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", sharding.record_bytes(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                      F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), size=1024)


@query("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
m AS (SELECT k, min(doc_id) AS least FROM g GROUP BY k HAVING min(doc_id) < max(doc_id)),
c AS (SELECT doc_id, list(DISTINCT i + j) AS gone
      FROM (SELECT doc_id, i, unnest(range(0, 13)) AS j FROM g JOIN m USING (k) WHERE doc_id > least) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
              lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_words(table(spark, sf_dir, "documents").select("doc_id", "text"), length=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query("op5_quality_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_suffix_dedup", r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 100)) AS k FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d)),
m AS (SELECT k, min(doc_id) AS least FROM g GROUP BY k HAVING min(doc_id) < max(doc_id)),
f AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM g JOIN m USING (k) WHERE doc_id > least),
r AS (SELECT doc_id, i, sum(CASE WHEN i <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM f),
s AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM r GROUP BY doc_id, run),
t AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM s),
p AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
             string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS kept FROM t JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN p USING (doc_id)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), length=50)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), trusted)


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    # rows of both tables: documents have a column for their language and a source, pages a markup attribute and an address
    nothing = F.lit(None).cast("string")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), "text", F.col("lang").alias("declared"), nothing.alias("suffix"),
        F.col("source").alias("host"))
    pages = table(spark, sf_dir, "pages")
    evidence = dict(zip(("declared", "suffix", "host"), language_id.page_evidence(F.col("html"), F.col("url")), strict=True))
    texts = write_shared(html_text.extract(pages.select("page_id", "html", *[c.alias(x) for x, c in evidence.items()])), "page_texts")
    pages = texts.select(F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), "text", *evidence)
    out = language_id.identify(docs.unionByName(pages), declared=F.col("declared"), suffix=F.col("suffix"), host=F.col("host"))
    return out.select("doc_id", F.col("declared").alias("declared_lang"), "predicted_lang", "confidence", F.col("accepted").alias("kept"), "page_id")


@query("op10_html_extraction")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op6_jaccard_join", r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, k FROM (
        SELECT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS reached FROM n UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, coalesce(min(reached), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY d.doc_id
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), size=5, percent=80)


# crc32 of the decimal doc_id, bit by bit
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
         lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda z, _: xor(z >> 1, 3988292384 * (z & 1)))), 4294967295)"""


@query("op11_merkle_manifest", f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, source, n_chars, text,
         {_CRC32} % 3 = 0 AS changed
  FROM documents),
e AS (SELECT doc_id, lang, pos, changed, text,
             coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM d),
leaf AS (SELECT doc_id, lang, pos, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                sha256(head || coalesce(CASE WHEN changed THEN strlen(low) || ':' || low ELSE strlen(text) || ':' || text END, '-')) AS shown FROM e),
up AS (SELECT 0 AS level, lang, pos, leaf AS node, count(*) OVER (PARTITION BY lang) AS n FROM leaf
       UNION ALL
       SELECT level + 1, lang, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (n + 7) // 8 FROM up WHERE n > 1 GROUP BY level, lang, n, pos // 8),
subs AS (SELECT lang, node AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS level, pos, subroot AS node, n FROM subs
        UNION ALL
        SELECT level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY level, n, pos // 8),
pairs AS (
  SELECT l.doc_id, u.level, string_agg(u.node, '' ORDER BY u.pos) FILTER (u.pos < l.pos // (8 ** u.level)::BIGINT) AS a,
         string_agg(u.node, '' ORDER BY u.pos) FILTER (u.pos > l.pos // (8 ** u.level)::BIGINT) AS b
  FROM leaf l JOIN up u ON u.lang IS NOT DISTINCT FROM l.lang AND u.n > 1 AND u.pos // 8 = l.pos // (8 ** (u.level + 1))::BIGINT GROUP BY l.doc_id, u.level
  UNION ALL
  SELECT l.doc_id, s.height + u.level, string_agg(u.node, '' ORDER BY u.pos) FILTER (u.pos < s.pos // (8 ** u.level)::BIGINT),
         string_agg(u.node, '' ORDER BY u.pos) FILTER (u.pos > s.pos // (8 ** u.level)::BIGINT)
  FROM leaf l JOIN subs s ON s.lang IS NOT DISTINCT FROM l.lang JOIN top u ON u.n > 1 AND u.pos // 8 = s.pos // (8 ** (u.level + 1))::BIGINT
  GROUP BY l.doc_id, s.height, u.level),
path AS (SELECT doc_id, list([coalesce(a, ''), coalesce(b, '')] ORDER BY level) AS p FROM pairs GROUP BY doc_id),
fold AS (SELECT l.doc_id, 0 AS i, l.shown AS node, p FROM leaf l LEFT JOIN path USING (doc_id)
         UNION ALL SELECT doc_id, i + 1, sha256(p[i + 1][1] || node || p[i + 1][2]), p FROM fold WHERE i < len(p)),
whole AS (SELECT node AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(flatten(f.p), ''), '')) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM leaf JOIN subs s ON s.lang IS NOT DISTINCT FROM leaf.lang JOIN fold f USING (doc_id) CROSS JOIN whole
WHERE f.i = coalesce(len(f.p), 0)
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    low = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(changed, merkle.leaf_digest([low if f == "text" else F.col(f) for f in fields]))
    tree = merkle.manifest(table(spark, sf_dir, "documents"), fields, group="lang", key="doc_id", carry={"tampered": tampered})
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return tree.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
                       (folded == F.col("root")).alias("verified"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embedding_whitening.whiten(table(spark, sf_dir, "embeddings"), count=16, scale=64.0, shift=1_000_000)
    return out.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


@query("op13_simhash_near_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, bits=2)
