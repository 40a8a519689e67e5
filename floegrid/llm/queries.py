"""Registered queries of the training-data operators, each over its whole table.

A query applies its operator with production parameters and returns the digest columns; `oracle` is DuckDB SQL
for the same rows where SQL can say it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from floegrid.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}
VOCABULARY = "byte_bpe_50k.json"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        REGISTRY[name] = (fn, oracle)
        return fn
    return register


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`kept_text`: what is left of each text, null where it was null."""
    from pyspark.sql import functions as F

    from floegrid.llm.suffix_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.when(F.col("text").isNotNull(), F.col("kept_text")).alias("kept_text"))


@query("op4_bpe")
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floegrid.llm.bpe import encode_documents
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, vocabulary_path(), ids=False).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def id_crc(modulus: int):
    """crc32 of doc_id as text, modulo; null for a null id."""
    from pyspark.sql import functions as F
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@query("op5_language_mixture")
def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without doc_id is held out: whether it may be learned from is unknown."""
    from pyspark.sql import functions as F

    from floegrid.llm.language import learn_languages, predict_languages
    docs = table(spark, sf_dir, "documents")
    model = learn_languages(docs.where(id_crc(4) != 2))
    held = F.coalesce(id_crc(4) == 2, F.lit(True)).alias("held_out")
    return predict_languages(docs.select("doc_id", held, "text"), model).select("doc_id", "held_out", "lang_pred", "score")


@query("op6_winnowing")
def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from floegrid.llm.decontaminate import find_benchmark, is_contaminated
    found = find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                        is_contaminated().alias("contaminated"))


@query("op7_minhash_odd_sketch")
def op7_minhash_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from floegrid.llm.near_dup import assign
    return assign(table(spark, sf_dir, "documents"), size=2, percent=80).select(
        F.col("_id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query("op8_quality_machine")
def op8_quality_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without doc_id is held out: whether it may be learned from is unknown."""
    from pyspark.sql import functions as F

    from floegrid.llm.quality import fit_quality, score_quality
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(id_crc(5) != 0)
    held = F.coalesce(id_crc(5) == 0, F.lit(True)).alias("held_out")
    return score_quality(docs.withColumn("held_out", held), fit_quality(docs, labels)).select(
        "doc_id", "held_out", "score", "predicted")


@query("op1_licences")
def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from floegrid.llm.licences import scan_licences
    found = scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.array_join(F.transform("finds", lambda f: F.concat_ws(":", f["family"], f["paragraph"], f["first"], f["end"])), ",")
    return found.select("doc_id", "n_paragraphs", "licences", "n_licence", "n_unknown", spans.alias("found"))


SPACE_CLASS = r"[ \t\n\x0B\f\r]"


@query("op2_host_rules", fr"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{SPACE_CLASS}+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: length(regexp_replace(x, '{SPACE_CLASS}', '', 'g')) > 0) AS lines FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS k
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) > 8)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY rid),
r AS (SELECT w.rid, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '{SPACE_CLASS}', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov ON w.rid = cov.rid),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM r),
h AS (SELECT source, count(*) AS host_docs, CAST(sum(CAST(base_failed AS INT)) AS BIGINT) AS host_failed FROM b GROUP BY source),
p AS (SELECT sum(host_failed) / sum(host_docs) AS m, sum(host_docs * (host_failed / host_docs) * (host_failed / host_docs)) AS sq,
             sum(host_docs) AS n, count(*) AS k FROM h),
s AS (SELECT m, least(greatest(m * (1 - m) / greatest(sq / n - m * m - m * (1 - m) * k / n, 1e-4) - 1, 2.0), 1e4) AS s FROM p),
v AS (SELECT source, host_docs, host_failed, (host_failed + m * s) / (host_docs + s) <= 0.8 AS host_kept FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept,
       host_docs, host_failed
FROM b LEFT JOIN v ON b.source IS NOT DISTINCT FROM v.source""")
def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floegrid.llm.rules import judge
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host_docs", "host_failed")


@query("op9_perspectives", r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place,
             coalesce(role, 'unknown') AS name, coalesce(text, '') AS text FROM t),
people AS (SELECT DISTINCT conv_id, name AS speaker FROM p WHERE name <> 'system'),
x AS (SELECT p.conv_id, speaker, place, place // 256 AS block, name = speaker AS own,
             CASE WHEN name = 'system' THEN '<|system|>' || chr(10) WHEN name = speaker THEN '<|assistant|>' || chr(10)
                  ELSE '<|user name=' || name || '|>' || chr(10) END AS head, text || '<|end|>' || chr(10) AS body
      FROM p JOIN people ON p.conv_id = people.conv_id),
o AS (SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker ORDER BY place
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_at FROM x)
SELECT conv_id, speaker, CAST(block AS BIGINT) AS block, count(*) AS n_turns, CAST(min(start_at) AS BIGINT) AS start_char,
       string_agg(head || body, '' ORDER BY place) AS rendered,
       coalesce(string_agg(CAST(start_at + length(head) AS VARCHAR) || '-' || CAST(start_at + length(head) + length(body) AS VARCHAR), ','
                ORDER BY place) FILTER (WHERE own), '') AS masks,
       CAST(coalesce(sum(length(body)) FILTER (WHERE own), 0) AS BIGINT) AS n_masked
FROM o GROUP BY conv_id, speaker, block""")
def op9_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floegrid.llm.chat import perspectives
    return perspectives(table(spark, sf_dir, "conversations")).drop("dialogue")


def _url_sql() -> str:
    """The URL filter in DuckDB, with the same whole-number weights."""
    from floegrid.llm.urls import BUCKETS, RULES, SIZES, train
    bias, weights = train()
    parts = []
    for points, salt in (("hp", 11), ("pp", 29)):
        for n in SIZES:
            h = str(salt + n)
            for k in range(n):
                h = f"(({h} * 1009 + {points}[i + {k + 1}]) % 1000003)"
            parts.append(f"coalesce(list_sum(list_transform(range(0, greatest(len({points}) - {n - 1}, 0)), lambda i: w[1 + {h} % {BUCKETS}])), 0)")
    rules = sorted(RULES, key=lambda r: -len(r[0]) - len(r[1]))

    def cases(value) -> str:
        return "CASE " + " ".join(f"WHEN (host = '{r[0]}' OR ends_with(host, '.{r[0]}')) AND starts_with(path, '{r[1]}') THEN '{value(r)}'"
                                  for r in rules) + " END"
    unit = "unicode(substr({0}, i, 1))"
    return f"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
b AS (SELECT page_id, rest, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw FROM a),
c AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path FROM b),
d AS (SELECT *, list_transform(range(1, length(host) + 1), lambda i: {unit.format('host')}) AS hp,
             list_transform(range(1, length(path) + 1), lambda i: {unit.format('path')}) AS pp FROM c),
e AS (SELECT d.*, {' + '.join(parts)} + {bias} AS score FROM d, (SELECT {weights}::BIGINT[] AS w))
SELECT page_id, host, path, {cases(lambda r: r[0] + r[1])} AS rule,
       coalesce({cases(lambda r: r[2])}, CASE WHEN score > 0 THEN 'block' ELSE 'allow' END) AS verdict FROM e"""


@query("op10_urls", _url_sql())
def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floegrid.llm.urls import filter_urls
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_vertical_join", fr"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array({LOWER_SQL}, '{SPACE_CLASS}+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS k FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON r.k = e.a)
SELECT id AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(k) AS component_id
FROM r LEFT JOIN n ON id = n.doc_id GROUP BY id, n""")
def op11_vertical_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from floegrid.llm.ngram_join import assign
    return assign(table(spark, sf_dir, "documents"), size=4, percent=85).select(
        F.col("_id").alias("doc_id"), "n_shingles", "component_id")


@query("op13_collocations", fr"""
WITH p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w
           FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER_SQL}, '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents)),
w1 AS (SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM p) GROUP BY ALL),
w2 AS (SELECT lang, x, y, count(*) AS f FROM (SELECT lang, w[i] AS x, w[i + 1] AS y FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM p))
       GROUP BY ALL),
w3 AS (SELECT lang, x, y, z, count(*) AS f
       FROM (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM p)) GROUP BY ALL),
t AS (SELECT w3.*, a.f AS f1, b.f AS f23, c.f AS f12, d.f AS f3
      FROM w3 JOIN w1 a ON a.lang = w3.lang AND a.x = w3.x JOIN w2 b ON b.lang = w3.lang AND b.x = w3.y AND b.y = w3.z
      JOIN w2 c ON c.lang = w3.lang AND c.x = w3.x AND c.y = w3.y JOIN w1 d ON d.lang = w3.lang AND d.x = w3.z WHERE w3.f >= 10),
u AS (SELECT *, 1000000::HUGEINT * f * f // (f1::HUGEINT * f23) AS s1, 1000000::HUGEINT * f * f // (f12::HUGEINT * f3) AS s2 FROM t),
g AS (SELECT lang, x, y, max(f) AS longer FROM (SELECT lang, x, y, f FROM t UNION ALL SELECT lang, y, z, f FROM t) GROUP BY ALL),
c AS (SELECT w2.lang, w2.x || ' ' || w2.y AS phrase, w2.f AS a, k.f AS l, m.f AS r, 1000000::HUGEINT * w2.f * w2.f // (k.f::HUGEINT * m.f) AS score
      FROM w2 JOIN w1 k ON k.lang = w2.lang AND k.x = w2.x JOIN w1 m ON m.lang = w2.lang AND m.x = w2.y
      LEFT JOIN g ON g.lang = w2.lang AND g.x = w2.x AND g.y = w2.y WHERE w2.f >= 10 AND (longer IS NULL OR 100 * longer < 50 * w2.f)
      UNION ALL
      SELECT lang, x || ' ' || y || ' ' || z, f, CASE WHEN s1 <= s2 THEN f1 ELSE f12 END, CASE WHEN s1 <= s2 THEN f23 ELSE f3 END, least(s1, s2)
      FROM u),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM c)
SELECT o.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM o JOIN (SELECT lang, sum(f) AS n FROM w1 GROUP BY lang) s ON s.lang = o.lang WHERE rank <= 2000""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floegrid.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))


@query("op12_hard_negatives", """
WITH e AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid AS arid, a.vec_id AS anchor_id, b.rid, b.vec_id, a.label = b.label AS same,
             CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM e a, e b WHERE a.vec_id % 50 = 0 AND a.rid <> b.rid),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id, rid) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.arid, p.rid ORDER BY s.score DESC, s.vec_id, s.rid) AS rank
      FROM p JOIN s ON s.arid = p.arid AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from floegrid.llm.hard_negatives import mine
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, shifted)
