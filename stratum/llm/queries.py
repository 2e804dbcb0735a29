"""The registered queries of the operators, with their DuckDB SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import (
    bpe, filter_audit, mixing, mtree, quality, ring, secrets, substring_dedup, suffix_dedup, token_groups, toxicity, url_rules, whitening)
from stratum.llm.text import LOWER, UPPER
from stratum.session import checkpoint_root
from stratum.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SPACE_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]+"


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


_OP1_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
p AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""


@register("op1_topk_mtree", _OP1_SQL)
def op1_topk_mtree(spark: SparkSession, base: str) -> DataFrame:
    return mtree.top_k(read_table(spark, base, "embeddings"))


_OP2_SQL = f"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE_RE}'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, ws FROM w WHERE len(ws) >= 20),
h AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS h FROM s),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS rn FROM h),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE rn > 1),
k AS (SELECT doc_id, list(p) AS ps FROM g GROUP BY doc_id),
e AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
t AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.p) AS kept FROM e LEFT JOIN g ON e.doc_id = g.doc_id AND e.p = g.p
      WHERE g.p IS NULL GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)"""


@register("op2_substring_dedup", _OP2_SQL)
def op2_substring_dedup(spark: SparkSession, base: str) -> DataFrame:
    return substring_dedup.dedup(read_table(spark, base, "documents")).drop("kept_text")


#: Fixed values of the query: (verdict, host, path).
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
_OP3_SQL = f"""
WITH u AS (SELECT row_number() OVER () AS rn, page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(v, h, p) AS (VALUES {_RULE_ROWS}),
m AS (SELECT rn, max_by(h || p, length(h || p) * 1000 + length(h)) AS rule, max_by(v, length(h || p) * 1000 + length(h)) AS v
      FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rn)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN m USING (rn)"""


@register("op3_url_filters", _OP3_SQL)
def op3_url_filters(spark: SparkSession, base: str) -> DataFrame:
    rules = spark.createDataFrame([(h, p, v) for v, h, p in URL_RULES], "host string, path string, verdict string")
    return url_rules.apply_url_rules(read_table(spark, base, "pages"), rules)


@register("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, base: str) -> DataFrame:
    return secrets.scan(read_table(spark, base, "documents"))


@register("op5_toxicity")
def op5_toxicity(spark: SparkSession, base: str) -> DataFrame:
    checkpoint_root(spark)
    docs = read_table(spark, base, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, base, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


_OP6_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '{SPACE_RE}'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS h FROM
      (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS c FROM w UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.a)
SELECT w.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN r ON r.a = w.doc_id GROUP BY w.doc_id"""


@register("op6_ngram_jaccard", _OP6_SQL)
def op6_ngram_jaccard(spark: SparkSession, base: str) -> DataFrame:
    return token_groups.join_components(read_table(spark, base, "documents"))


_MEASURES_SQL = f"""
w AS (SELECT rn, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM
      (SELECT rn, list_filter(regexp_split_to_array(t, '{SPACE_RE}'), lambda x: x <> '') AS ws FROM d)),
g AS (SELECT rn, i, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY rn ORDER BY i)),
f AS (SELECT rn, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY rn, word, w2, w3) > 1 AS rep FROM g),
c AS (SELECT rn, i, rep OR coalesce(lag(rep, 1) OVER o, false) OR coalesce(lag(rep, 2) OVER o, false) AS cov
      FROM f WINDOW o AS (PARTITION BY rn ORDER BY i)),
rw AS (SELECT rn, count(*) FILTER (WHERE cov) AS n_repeat_words FROM c GROUP BY rn),
ln AS (SELECT rn, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD_RE}')) AS ls FROM d),
m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '{SPACE_RE}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(list_filter(ws, lambda x: list_contains([{", ".join(f"'{w}'" for w in quality.STOP_WORDS)}],
        translate(x, '{UPPER}', '{LOWER}')))) AS BIGINT) AS n_stop_words
  FROM (SELECT *, list_filter(regexp_split_to_array(t, '{SPACE_RE}'), lambda x: x <> '') AS ws FROM d) d
  JOIN ln USING (rn) LEFT JOIN rw USING (rn)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)"""
_OP7_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents), {_MEASURES_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {" AND ".join(r.sql() for r in quality.RULES)} AS kept FROM b"""


@register("op7_quality_rules", _OP7_SQL)
def op7_quality_rules(spark: SparkSession, base: str) -> DataFrame:
    docs = read_table(spark, base, "documents").select("doc_id", "text")
    return quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept")


def tokenizer_path() -> str:
    """The public vocabulary the query encodes with; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register("op8_bpe_round_trip")
def op8_bpe_round_trip(spark: SparkSession, base: str) -> DataFrame:
    return bpe.encode_digests(read_table(spark, base, "documents"), tokenizer_path())


@register("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, base: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(read_table(spark, base, "documents")).drop("kept")


_OP10_SQL = f"""
WITH z AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD_RE}')), 0) AS BIGINT) AS size FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) - 1 AS copy FROM z),
d AS (SELECT *, CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || size || ':' || copy), 1, 13) AS BIGINT) AS draw FROM n),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS cap,
    [5, 2, 1][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM s),
l AS (SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * (max(level) OVER ())) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
c AS (SELECT d.doc_id, size, source_size, target, whole, target - whole * source_size AS extra,
    sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id NULLS FIRST, size, copy ROWS UNBOUNDED PRECEDING) AS cum
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
    CAST(size * (whole + CASE WHEN 2 * cum - size <= 2 * extra THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c"""


@register("op10_source_mix", _OP10_SQL)
def op10_source_mix(spark: SparkSession, base: str) -> DataFrame:
    return mixing.mix(read_table(spark, base, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: The SQL replays every order step by step; nothing of it uses coalition values.
_OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT rn, list_filter(regexp_split_to_array(t, '{SPACE_RE}'), lambda x: x <> '') AS ws FROM d),
first AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
    100 * (length(t) - length(translate(t, '{UPPER}', ''))) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(d.doc_id > least, false)] AS fails, coalesce(good, false) AS good, coalesce(lab.toxic, false) AS toxic
  FROM d JOIN w USING (rn) JOIN first USING (t) LEFT JOIN lab ON lab.doc_id = d.doc_id),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY ALL),
i(i) AS (SELECT unnest(range(1, 6))),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a, i b, i c, i d, i e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT part, o, step, o[step] AS k, n, good, toxic, fails, len(list_filter(o[1:step - 1], lambda x: fails[x])) > 0 AS gone
  FROM g, o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, o, step, k,
    coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails[k]), 0) AS kept, coalesce(sum(n) FILTER (WHERE NOT gone AND fails[k]), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE gone AND fails[k]), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE fails[k] AND len(list_filter(fails, lambda x: x)) = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE NOT gone AND fails[k]), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails[k]), 0) AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, array_to_string(list_transform(o, lambda x: 'ABCDE'[x]), '') AS filter_order, CAST(step AS INTEGER) AS step,
    CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
    CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM r"""


@register("op11_filter_audit", _OP11_SQL)
def op11_filter_audit(spark: SparkSession, base: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, base, "documents"), read_table(spark, base, "labels"))


def _crc_entry(byte: int) -> int:
    for _ in range(8):
        byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
    return byte


#: A CRC by its table (a text of 256 hex numbers), the walk from every cell by distances on the ring, and the placing cell by cell.
_CRC_HEX = "".join(f"{_crc_entry(b):08x}" for b in range(256))
_RING_POS = "CAST('0x' || substr(md5({0}), 1, 13) AS BIGINT)"
_OP12_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, strlen(coalesce(text, '')) + {ring.OVERHEAD} AS size, xor(4294967295, list_reduce(list_prepend(4294967295,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda c, b: xor(c >> 8, CAST('0x' || substr('{_CRC_HEX}', 8 * (xor(c, b) & 255) + 1, 8) AS BIGINT)))) AS text_crc32 FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, size, text_crc32) - 1 AS copy FROM d),
p AS (SELECT *, {_RING_POS.format(f"concat_ws(':', '{ring.SEED}', coalesce(CAST(doc_id AS VARCHAR), 'null'), size, text_crc32, copy)")} AS pos FROM n),
k AS MATERIALIZED (SELECT *, pos // {(1 << 52) // ring.CELLS} AS cell FROM p),
z AS (SELECT cell, CAST(sum(size) AS BIGINT) AS bytes FROM k GROUP BY cell),
v AS (SELECT s, {_RING_POS.format(f"concat_ws(':', '{ring.SEED}', 'node', s, x)")} AS pos FROM
      (SELECT unnest(range({ring.SHARDS})) AS s), (SELECT unnest(range({ring.VIRTUAL_NODES})) AS x)),
a AS (SELECT cell, s, min((v.pos - cell * {(1 << 52) // ring.CELLS} + {1 << 52}) % {1 << 52}) AS ahead FROM z, v GROUP BY cell, s),
w AS (SELECT cell, list(s ORDER BY ahead, s) AS walk FROM a GROUP BY cell),
q AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY bytes DESC, cell) AS i, ceil(CAST(sum(bytes) OVER () AS DOUBLE) * {1.0 + ring.SLACK!r}::DOUBLE / {ring.SHARDS}) AS bound FROM z JOIN w USING (cell)),
f AS (SELECT 0::BIGINT AS i, list_transform(range({ring.SHARDS}), lambda x: 0::BIGINT) AS loads, -1::BIGINT AS shard, -1::BIGINT AS cell
  UNION ALL
  SELECT i, list_transform(loads, lambda x, j: CASE WHEN j - 1 = chosen THEN x + bytes ELSE x END), chosen, cell FROM (
    SELECT q.i, loads, bytes, q.cell, coalesce(list_filter(walk, lambda s: loads[s + 1] + bytes <= bound)[1], list_position(loads, list_min(loads)) - 1) AS chosen
    FROM f JOIN q ON q.i = f.i + 1))
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, '{ring.LAW}' AS law, CAST(shard AS INTEGER) AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY cell, pos, doc_id NULLS FIRST, size, text_crc32, copy) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM k JOIN f USING (cell)"""


@register("op12_ring_shards", _OP12_SQL)
def op12_ring_shards(spark: SparkSession, base: str) -> DataFrame:
    return ring.assign(read_table(spark, base, "documents"))


@register("op13_whitening")
def op13_whitening(spark: SparkSession, base: str) -> DataFrame:
    return whitening.whiten(read_table(spark, base, "embeddings"))
