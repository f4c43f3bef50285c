"""Registered queries of this subpackage: each operator over its whole table, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.llm import alignment, bpe, collocations, exact_dedup, language, lm_scoring, near_dedup, neighbours, packing, quality, secrets, sharding, token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 512


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    scored = lm_scoring.score_documents(_table(spark, folder, "documents"))
    return scored.withColumn("log_score", F.round("log_score", 4))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, folder, "documents"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    table = token_counts.prefix_table(_table(spark, folder, "documents"), BYTE_BPE, ["doc_id"])
    return table.select("doc_id", "n_bytes", "n_tokens", token_counts.over_budget(TOKEN_LIMIT).alias("over_limit"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_table(spark, folder, "documents"), WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(_table(spark, folder, "documents"))


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(_table(spark, folder, "documents"), BYTE_BPE)


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, folder, "documents"), ["doc_id"])
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, ("assign", "access", "hex")), F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.quality(_table(spark, folder, "documents"), ["doc_id"])
    return scored.withColumns({"posterior": F.round("posterior", 6), "score": F.round("score", 6)})


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, folder, "documents")).drop("row_no")


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_documents(_table(spark, folder, "documents"), BYTE_BPE, PIECE_BPE)


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def op13_language(spark: SparkSession, folder: str) -> DataFrame:
    found = language.identify(_table(spark, folder, "documents"))
    return found.withColumn("score", F.round("score", 4))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_lm_scoring, op2_exact_dedup, op3_token_counts, op4_packing, op5_near_dedup, op6_bpe, op7_secrets,
              op8_neighbours, op9_quality, op10_sharding, op11_alignment, op12_collocations, op13_language)
}

_WORDS = r"""
words AS (
  SELECT rid, doc_id, i, lower_words[i] AS w FROM (
    SELECT rid, doc_id, lower_words, unnest(generate_series(1, len(lower_words))) AS i FROM (
      SELECT rid, doc_id, string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '[\x20\x09-\x0D]+') AS lower_words
      FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)))
  WHERE lower_words[i] <> '')
"""

_SECRETS = (
    ("assign", 1, r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
     r"""[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", 2, "AKIA[A-Z0-9]+", 0, 16),
    ("hex", 3, "[0-9a-f]+", 0, 32),
)
_SECRET_CELLS = " UNION ALL ".join(
    f"""SELECT rid, {order} AS rank, '{kind}' AS kind, {least} AS least, unnest(generate_series(1, len(gaps))) AS i, unnest(gaps) AS gap,
    unnest(list_concat(hits, [''])) AS hit, unnest(list_concat(parts, [''])) AS part
    FROM (SELECT rid, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS hits,
      regexp_extract_all(text, '{pattern}', {group}) AS parts FROM docs WHERE regexp_matches(text, '{pattern}'))"""
    for kind, order, pattern, group, least in _SECRETS
)

ORACLES: dict[str, str] = {
    "op1_lm_scoring": f"""
WITH {_WORDS},
pairs AS (SELECT a.rid, a.w AS v, b.w AS w, count(*) AS own FROM words a JOIN words b ON a.rid = b.rid AND b.i = a.i + 1 GROUP BY ALL),
own1 AS (SELECT rid, w, count(*) AS own FROM words GROUP BY ALL),
all1 AS (SELECT w, sum(own) AS c FROM own1 GROUP BY w),
all2 AS (SELECT v, w, sum(own) AS c FROM pairs GROUP BY v, w),
sizes AS (SELECT rid, count(*) AS n FROM words GROUP BY rid),
whole AS (SELECT sum(n) AS n FROM sizes),
terms AS (
  SELECT p.rid, p.own, all2.c - p.own AS c2, a.c - x.own AS cv, b.c - y.own AS cw, false AS opening
  FROM pairs p JOIN all2 USING (v, w) JOIN all1 a ON a.w = p.v JOIN own1 x ON x.rid = p.rid AND x.w = p.v
  JOIN all1 b ON b.w = p.w JOIN own1 y ON y.rid = p.rid AND y.w = p.w
  UNION ALL
  SELECT f.rid, 1, 0, 0, b.c - y.own, true FROM words f JOIN all1 b ON b.w = f.w JOIN own1 y ON y.rid = f.rid AND y.w = f.w
  WHERE f.i = 1),
scored AS (
  SELECT t.rid, sum(CASE WHEN c2 > 0 THEN own ELSE 0 END) AS found, sum(CASE WHEN c2 > 0 THEN 0 ELSE own END) AS backed,
    sum(own * CASE WHEN c2 > 0 THEN ln(c2) - ln(greatest(cv, 1))
      ELSE (CASE WHEN opening THEN 0 ELSE ln(0.4) END) + (CASE WHEN cw > 0 THEN ln(cw) ELSE ln(0.4) END)
        - ln(greatest(whole.n - s.n, 1)) END) AS score
  FROM terms t JOIN sizes s USING (rid) CROSS JOIN whole GROUP BY t.rid)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_words, CAST(coalesce(found, 0) AS BIGINT) AS n_found,
  CAST(coalesce(backed, 0) AS BIGINT) AS n_backed, round(coalesce(score, 0.0), 4) AS log_score
FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) d LEFT JOIN sizes s USING (rid) LEFT JOIN scored USING (rid)
""",
    "op2_exact_dedup": r"""
WITH bodies AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body, length(coalesce(text, '')) AS points FROM documents),
ranked AS (
  SELECT doc_id, body, first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY body) AS group_size FROM bodies)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM ranked
""",
    "op5_near_dedup": f"""
WITH RECURSIVE {_WORDS},
sizes AS (SELECT doc_id, count(*) AS m FROM words GROUP BY doc_id),
shingles AS (
  SELECT DISTINCT a.doc_id, a.w || ' ' || b.w || ' ' || c.w AS s FROM words a
  JOIN words b ON b.rid = a.rid AND b.i = a.i + 1 JOIN words c ON c.rid = a.rid AND c.i = a.i + 2
  UNION
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) FROM words JOIN sizes USING (doc_id) WHERE m < 3 GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN counted x ON x.doc_id = a.doc_id JOIN counted y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(reach.b) AS component_id, d.doc_id = min(reach.b) AS kept
FROM documents d JOIN reach ON reach.a = d.doc_id LEFT JOIN counted c ON c.doc_id = d.doc_id GROUP BY d.doc_id, n
""",
    "op7_secrets": f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
cells AS ({_SECRET_CELLS}),
placed AS (
  SELECT rid, rank, kind, length(hit) AS hit, length(part) >= least AS ok,
    sum(length(gap) + length(hit)) OVER (PARTITION BY rid, rank ORDER BY i ROWS UNBOUNDED PRECEDING) AS till FROM cells),
spans AS (
  SELECT rid, count(*) FILTER (rank = 1) AS n_assign, count(*) FILTER (rank = 2) AS n_access, count(*) FILTER (rank = 3) AS n_hex,
    string_agg(kind || ':' || CAST(till - hit AS BIGINT) || ':' || CAST(till AS BIGINT), ',' ORDER BY till - hit, rank) AS spans
  FROM placed WHERE ok AND hit > 0 GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN spans USING (rid)
""",
    "op12_collocations": r"""
WITH pieces AS (
  SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)),
split AS (SELECT row_number() OVER () AS piece_id, lang, string_split_regex(piece, '[\x20\x09]+') AS w FROM pieces),
flat AS (SELECT piece_id, lang, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM split),
words AS (
  SELECT lang, a, lead(a) OVER piece AS b, lead(a, 2) OVER piece AS c FROM flat WHERE a <> ''
  WINDOW piece AS (PARTITION BY piece_id ORDER BY i)),
grams AS (
  SELECT lang, 1 AS size, [a] AS p FROM words
  UNION ALL SELECT lang, 2, [a, b] FROM words WHERE b IS NOT NULL
  UNION ALL SELECT lang, 3, [a, b, c] FROM words WHERE c IS NOT NULL),
f AS (SELECT lang, size, p, count(*) AS c FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(c) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, p, c AS a FROM f WHERE size > 1 AND c >= 10),
cuts AS (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM candidates),
parts AS (
  SELECT x.lang, x.size, x.p, x.a, x.k, l.c AS l, r.c AS r, (1000000::HUGEINT * x.a * x.a) // (l.c::HUGEINT * r.c) AS score
  FROM cuts x JOIN f l ON l.lang = x.lang AND l.p = x.p[1:k] JOIN f r ON r.lang = x.lang AND r.p = x.p[k + 1:]),
lowest AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, unnest([p[1:2], p[2:3]]) AS p, a FROM candidates WHERE size = 3),
covered AS (SELECT c.lang, c.p FROM candidates c JOIN inner_parts d ON d.lang = c.lang AND d.p = c.p AND 100 * d.a >= 50 * c.a GROUP BY ALL),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank
  FROM lowest WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.lang = lowest.lang AND c.p = lowest.p))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
}
