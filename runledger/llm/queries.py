"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.plans.tables import table

from . import collocations, extraction, langid, line_dedup, mixing, negatives, ngram_join, packing, preference, quality, search, sharding, warc
from .common import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SHARD_BYTES = 1 << 20


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_KEY = "CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)"


@register("op2_sharding", f"""
WITH d AS (SELECT doc_id, {_KEY} AS h, CAST(coalesce(strlen(text), 0) AS BIGINT) AS bytes FROM documents),
lv AS (SELECT CAST(unnest(range(0, 61)) AS BIGINT) AS bits),
b AS (SELECT bits, h >> (60 - bits) AS q, CAST(sum(bytes) AS BIGINT) AS shard_bytes FROM d, lv GROUP BY ALL),
f AS (SELECT d.doc_id, d.bytes, d.h, min(b.bits) AS shard_bits FROM d, b
      WHERE b.q = d.h >> (60 - b.bits) AND b.shard_bytes <= {SHARD_BYTES} GROUP BY ALL)
SELECT f.doc_id, f.bytes, f.shard_bits, b.shard_bytes,
       CASE WHEN f.shard_bits = 0 THEN '' ELSE lpad(bin(f.h >> (60 - f.shard_bits)), CAST(f.shard_bits AS INTEGER), '0') END AS shard_id
FROM f JOIN b ON b.bits = f.shard_bits AND b.q = f.h >> (60 - f.shard_bits)""")
def op2_sharding(spark, sf_dir):
    """Every document's shard under a byte limit, with the shard's size."""
    rows, directory = sharding.shard(table(spark, sf_dir, "documents"), SHARD_BYTES)
    return rows.join(directory.select("shard_id", "shard_bytes"), "shard_id")


@register("op9_preference", """
WITH t AS (SELECT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS c, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT pair_id, turn, role, text, bool_or(c) AS c, bool_or(NOT c) AS r FROM t GROUP BY ALL),
p AS (SELECT pair_id, min(CASE WHEN c <> r THEN turn END) AS cut FROM o GROUP BY pair_id HAVING bool_or(c) AND bool_or(r)),
x AS (SELECT o.*, p.cut FROM o JOIN p USING (pair_id)),
s AS (SELECT *, 'prompt' AS part FROM x WHERE cut IS NULL OR turn < cut
      UNION ALL SELECT *, 'chosen' FROM x WHERE turn >= cut AND c
      UNION ALL SELECT *, 'rejected' FROM x WHERE turn >= cut AND r)
SELECT pair_id, part, turn, role,
       '<|im_start|>' || replace(coalesce(role, 'user'), '<|', '< |') || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS text,
       part <> 'prompt' AND coalesce(role = 'assistant', false) AS trained
FROM s""")
def op9_preference(spark, sf_dir):
    """Conversations 2k (chosen) and 2k+1 (rejected) as one preference pair, turn by turn."""
    t = table(spark, sf_dir, "conversations")
    return preference.preference_pairs(t.select(
        F.expr("conv_id div 2").alias("pair_id"),
        F.when(F.col("conv_id") % 2 == 0, "chosen").otherwise("rejected").alias("side"), "turn", "role", "text"))


@register("op10_mixing", rf"""
WITH d AS (SELECT doc_id, source, {_KEY} AS k, coalesce(CAST(doc_id AS VARCHAR), '') AS ident,
                  CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS w
      FROM d GROUP BY source),
r AS (SELECT *, 2.0::DOUBLE * source_size AS ceiling, 2.0::DOUBLE * source_size / w AS ratio,
             1.5::DOUBLE * sum(source_size) OVER () AS total FROM s),
c AS (SELECT *, total - coalesce(sum(ceiling) OVER (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             >= ratio * sum(w) OVER (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped FROM r),
t AS (SELECT *, CASE WHEN capped THEN ceiling ELSE w * ((total - coalesce(sum(ceiling) FILTER (capped) OVER (), 0))
             / sum(w) FILTER (NOT capped) OVER ()) END AS target FROM c),
e AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget,
             CASE WHEN source_size > 0 THEN CAST(floor(floor(target + 0.5) / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
g AS (SELECT d.source, k, ident, size, count(*) AS m FROM d GROUP BY ALL),
u AS (SELECT *, CAST(sum(size * m) OVER (PARTITION BY source ORDER BY k, ident, size) - size * m AS BIGINT) AS before FROM g),
x AS (SELECT u.*, e.source_size, e.target, e.epochs, e.budget - e.epochs * e.source_size AS rest FROM u JOIN e ON u.source IS NOT DISTINCT FROM e.source)
SELECT d.doc_id, d.size, x.source_size, x.target,
       x.epochs * d.size + CASE WHEN x.before + d.size * x.m <= x.rest THEN d.size
                                WHEN x.before < x.rest THEN (x.rest - x.before) // x.m ELSE 0 END AS taken
FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.k = x.k AND d.ident = x.ident AND d.size = x.size""")
def op10_mixing(spark, sf_dir):
    """Every document's words in the weighted mix."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@register("op1_topk", """
WITH ok AS (SELECT vec_id, max([CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
            GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([coalesce(z[1], 0) * coalesce(z[2], 0) FOR z IN list_zip(q.v, c.v)]) AS BIGINT) AS score
      FROM ok q, ok c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op1_topk(spark, sf_dir):
    """The 5 highest integer inner products of every 50th vector with all others."""
    e = table(spark, sf_dir, "embeddings")
    return search.top_k(e, e.where(F.col("vec_id") % 50 == 0), 5)


@register("op5_packing")
def op5_packing(spark, sf_dir):
    """Every document's token pieces with their places in sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op7_line_dedup")
def op7_line_dedup(spark, sf_dir):
    """Every document's text without the lines that repeat, exactly or nearly, across the corpus."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), "text")


@register("op8_ngram_jaccard", r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS t
      FROM (SELECT doc_id, w, CAST(unnest(range(1, greatest(len(w) - 3, 2))) AS BIGINT) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.i >= 75 * (x.n + y.n - p.i)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY ALL""")
def op8_ngram_jaccard(spark, sf_dir):
    """Every document's number of 5-word shingles and its component of near duplicates."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@register("op3_langid")
def op3_langid(spark, sf_dir):
    """The predicted language of every document, learned from those whose crc32 mod 3 is not 1."""
    d = table(spark, sf_dir, "documents")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    vocab = langid.vocabulary()
    langs, probs = langid.train(d.where(~held), vocab)
    return langid.predict(d, langs, probs, vocab).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@register("op4_quality")
def op4_quality(spark, sf_dir):
    """Every document's base counts and the verdict of base rules and line labels."""
    d = table(spark, sf_dir, "documents")
    return quality.judge(d, quality.train(d, table(spark, sf_dir, "labels")))


@register("op6_extraction")
def op6_extraction(spark, sf_dir):
    """The main text of every page."""
    p = table(spark, sf_dir, "pages")
    return extraction.extract(p, extraction.train(p)).select("page_id", "url", "text", "n_chars")


@register("op11_negatives", """
WITH ok AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
q AS (SELECT *, row_number() OVER () AS akey FROM (SELECT DISTINCT * FROM ok WHERE vec_id % 100 = 0)),
s AS (SELECT q.akey, q.vec_id AS anchor_id, c.vec_id AS id, q.label = c.label AS same,
             CAST(list_sum([coalesce(z[1], 0) * coalesce(z[2], 0) FOR z IN list_zip(q.v, c.v)]) AS BIGINT) AS score
      FROM q, ok c WHERE c.vec_id <> q.vec_id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY akey ORDER BY score DESC, id) AS place FROM s WHERE same) WHERE place <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.akey, p.place ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
             s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
      FROM p JOIN s USING (akey) WHERE NOT s.same AND 80 * CAST(p.score AS HUGEINT) <= 100 * CAST(s.score AS HUGEINT) AND s.score <= p.score)
SELECT * FROM n WHERE rank <= 5""")
def op11_negatives(spark, sf_dir):
    """For every 100th vector and its 5 nearest of the same label, the 5 hardest rows of other labels."""
    e = table(spark, sf_dir, "embeddings")
    e = e.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(e, e.where(F.col("vec_id") % 100 == 0))


@register("op12_collocations", r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda w: w <> '') AS w FROM t),
g AS (SELECT lang, m, w[i:i + m - 1] AS g FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS m))),
f AS (SELECT lang, m, g, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE m > 1 AND f >= 10),
longer AS (SELECT lang, g, max(f) AS most FROM (SELECT lang, g[1:2] AS g, f FROM c WHERE m = 3 UNION ALL SELECT lang, g[2:3], f FROM c WHERE m = 3) GROUP BY ALL),
k AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, g) WHERE m = 3 OR most IS NULL OR 100 * most < 50 * f),
cuts AS (SELECT k.*, unnest(range(1, m)) AS cut FROM k),
s AS (SELECT x.lang, x.g, x.f AS a, x.cut, l.f AS l, r.f AS r, CAST((1000000::HUGEINT * x.f * x.f) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
      FROM cuts x JOIN f l ON l.lang = x.lang AND l.g = x.g[1:x.cut] JOIN f r ON r.lang = x.lang AND r.g = x.g[x.cut + 1:x.m]),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS o FROM s) WHERE o = 1),
o AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM b),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT z.lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= 2000""")
def op12_collocations(spark, sf_dir):
    """The 2000 strongest phrases of 2 or 3 words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register("op13_warc", r"""
WITH d AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS largest FROM d),
b AS (SELECT *, array_to_string([lpad(bin(CAST('0x' || substr(hex, 2 * i - 1, 2) AS INTEGER)), 8, '0') FOR i IN range(1, 21)], '') AS bits FROM h)
SELECT page_id, payload_bytes,
       array_to_string(['ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST('0b' || substr(bits, 5 * i + 1, 5) AS INTEGER) + 1] FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to FROM b""")
def op13_warc(spark, sf_dir):
    """Every page written to WARC archives and read back, equal payloads stored once."""
    path = f"{Scratch(spark, 'warc').root}/archives"
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    got = warc.read_archives(spark, path).where("record_type IN ('response', 'revisit')")
    return got.select(warc.page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      warc.page_id("refers_to").alias("refers_to"))
