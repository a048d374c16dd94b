"""The registered queries of this subpackage, one per operator, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.llm import blocks, decontaminate, fingerprints, hosts, jaccard, language, mixing, negatives, packing, phrases, toxicity, turns, wavelet
from parcelmart.llm.common import small_batches, table
from parcelmart.shared import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
EXPECTED: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(build)
    def query(spark: SparkSession, folder: str) -> DataFrame:
        small_batches(spark)
        return build(spark, folder)

    QUERIES[build.__name__] = query
    return query


@_query
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    result = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return result.drop("spans")


@_query
def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


@_query
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_id(table(spark, folder, "documents")).drop("shares")


@_query
def op4_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.substring_removal(table(spark, folder, "documents"))


@_query
def op6_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, folder, "documents"))


@_query
def op5_html(spark: SparkSession, folder: str) -> DataFrame:
    return blocks.extract(table(spark, folder, "pages"))


# The rules the query is given.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


@_query
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return hosts.url_verdicts(pages, hosts.symbol_heavy(F.col("html")), URL_RULES).drop("mean", "lower")


@_query
def op8_wavelet(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    wavelet.write_shards(table(spark, folder, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return wavelet.document_digests(wavelet.read_shards(spark, path))


@_query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.toxicity(docs, docs, table(spark, folder, "labels"), spans=False)


@_query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


@_query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings").withColumn("label", label))


@_query
def op12_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.language_model_scores(table(spark, folder, "documents"))


@_query
def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return turns.repair(turns.damaged(rows), rows)


_WORDS = (
    "coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
)

EXPECTED["op1_decontaminate"] = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT *, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)
),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT k FROM grams),
spots AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, sizes WHERE len(w) >= k)
),
hits AS (SELECT doc_id, i, k, item_id FROM spots JOIN grams USING (k, g)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hits))
  GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

EXPECTED["op4_phrases"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
),
spots AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)
),
again AS (SELECT g FROM spots GROUP BY g HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM spots WHERE g IN (SELECT g FROM again)
),
lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE [w[i] for i in generate_series(1, len(w)) if NOT list_contains(ps, i)] END, ' '))
       AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id)
"""

_HOST_FIT = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
_FITS = " ".join(
    f"WHEN {_HOST_FIT.format(*(lambda h: (h[0], '/' + h[1]))(rule.split('/', 1)))} THEN '{{{i}}}'"
    for i, (rule, _) in sorted(enumerate(URL_RULES), key=lambda r: -len(r[1][0]))
)
_DOUBLE = ", ".join(f"'{x}'" for x in hosts.DOUBLE_SUFFIXES)


def _level(name: str, groups: str, key: str) -> str:
    """One beta-binomial level over ``groups`` (n, bad, prior): the posterior's a and b."""
    return f"""
{name}_k AS (
  SELECT 1 / least(greatest(coalesce((sum(n * (bad / n - prior) ** 2) - sum(prior * (1 - prior)))
         / nullif(sum((n - 1) * prior * (1 - prior)), 0), 0.5), 0.01), 0.9) - 1 AS k FROM {groups}
),
{name} AS (SELECT {key}, n, bad, bad + prior * k AS a, n - bad + (1 - prior) * k AS b FROM {groups}, {name}_k)"""


EXPECTED["op7_url_filter"] = f"""
WITH r AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
         regexp_replace(html, '<[^>]*>', ' ', 'g') AS shown FROM pages
),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         CAST(length(shown) - length(translate(shown, '!#$%&*', '')) > 0.03 * length(shown) AS INT) AS bad FROM r
),
h AS (
  SELECT host, CAST(count(*) AS DOUBLE) AS n, sum(bad) AS bad, string_split(host, '.') AS s,
         CASE WHEN array_to_string(string_split(host, '.')[-2:], '.') IN ({_DOUBLE}) THEN 2 ELSE 1 END AS k
  FROM p WHERE bad IS NOT NULL GROUP BY host
),
hosts AS (SELECT host, n, bad, array_to_string(s[-k:], '.') AS suffix, array_to_string(s[-(k + 1):], '.') AS domain FROM h),
gs AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM hosts) AS prior FROM hosts GROUP BY suffix
),{_level("ps", "gs", "suffix")},
gd AS (
  SELECT domain, sum(hosts.n) AS n, sum(hosts.bad) AS bad, any_value(a / (a + b)) AS prior
  FROM hosts JOIN ps USING (suffix) GROUP BY suffix, domain
),{_level("pd", "gd", "domain")},
gh AS (SELECT host, hosts.n, hosts.bad, a / (a + b) AS prior FROM hosts JOIN pd USING (domain)),{_level("ph", "gh", "host")},
known AS (SELECT host, a / (a + b) - {hosts.Z} * sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) > {hosts.BLOCK_ABOVE} AS blocked FROM ph)
SELECT page_id, host, path, CASE {_FITS.format(*[rule for rule, _ in URL_RULES])} END AS rule,
       coalesce(CASE {_FITS.format(*[decision for _, decision in URL_RULES])} END,
                CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN known USING (host)
"""

EXPECTED["op11_hard_negatives"] = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM r AS a JOIN r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
),
near AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM scored JOIN near USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

# A state of the recursion over a conversation's rows is one text, nine digits of cost and then the audit, so that the least
# text is the cheapest repair and among those the least audit.
_BYTES = "flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')), '')])"
_CHECKSUM = (
    f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || CAST({_BYTES} AS BIGINT[]), "
    "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"
)


def _edit(state: str, cost: int | str, letter: str) -> str:
    return f"lpad(CAST(CAST(left({state}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({state}, 10) || '{letter}'"


def _unless_gone(condition: str, edited: str) -> str:
    return f"CASE WHEN NOT gone AND {condition} THEN {edited} END"


_CUT = "CAST(cut AS BIGINT)"
_STAY = f"2 + {_CUT}"

EXPECTED["op13_conversations"] = f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CHECKSUM} % 20 AS draw FROM conversations
),
hurt AS (
  SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE draw WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw
),
placed AS (
  SELECT conv_id, turn, role, text, rtrim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS shown,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(concat(length(role), ':', role, text))) AS i
  FROM hurt
),
first_seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM placed),
rows_of AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS kind, shown = '' AS blank, shown <> '' AND seen AS again,
         shown <> '' AND NOT seen AND right(shown, 1) NOT IN ('.', '!', '?') AS cut, shown = '' OR seen AS gone,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM first_seen
),
ids AS (SELECT DISTINCT conv_id FROM conversations),
path AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000000' AS s0, CAST(NULL AS VARCHAR) AS ss, CAST(NULL AS VARCHAR) AS su, CAST(NULL AS VARCHAR) AS sa FROM ids
  UNION ALL
  SELECT conv_id, i, {_edit("s0", 3, "D")},
         least({_edit("ss", 3, "D")}, {_unless_gone("kind = 's'", _edit("s0", _CUT, "K"))}),
         least({_edit("u1", 3, "D")},
               {", ".join(_unless_gone("kind = 'u'", _edit(x, _CUT, "K")) for x in ("s0", "ss", "a1"))},
               {", ".join(_unless_gone("true", _edit(x, _STAY, "R")) for x in ("s0", "ss", "a1"))}),
         least({_edit("a1", 3, "D")}, {_unless_gone("kind = 'a'", _edit("u1", _CUT, "K"))}, {_unless_gone("true", _edit("u1", _STAY, "R"))})
  FROM (
    SELECT f.*, s0, ss, u1, least(sa, {_edit("u1", 2, "I")}) AS a1
    FROM (SELECT *, least(su, {_edit("s0", 2, "I")}, {_edit("ss", 2, "I")}, {_edit("sa", 2, "I")}) AS u1 FROM path) AS p
    JOIN rows_of AS f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
  )
),
ended AS (
  SELECT conv_id, arg_max(least(s0, a1), i) AS best
  FROM (SELECT *, least(sa, {_edit("u1", 2, "I")}) AS a1
        FROM (SELECT *, least(su, {_edit("s0", 2, "I")}, {_edit("ss", 2, "I")}, {_edit("sa", 2, "I")}) AS u1 FROM path))
  GROUP BY conv_id
),
repairs AS (SELECT conv_id, CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10) AS audit FROM ended),
play AS (
  SELECT conv_id, audit, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS i, '' AS state, CAST([] AS VARCHAR[]) AS lines FROM repairs
  UNION ALL
  SELECT p.conv_id, audit, k + 1, p.i + CAST(op <> 'I' AS BIGINT),
         CASE op WHEN 'D' THEN state WHEN 'K' THEN kind ELSE need[1] END,
         CASE op WHEN 'D' THEN lines WHEN 'I' THEN list_append(lines, concat(need, ':'))
                 WHEN 'K' THEN list_append(lines, concat(role, ':', text)) ELSE list_append(lines, concat(need, ':', text)) END
  FROM (SELECT *, substr(audit, k + 1, 1) AS op, CASE state WHEN 'u' THEN 'assistant' ELSE 'user' END AS need FROM play WHERE k < length(audit)) AS p
  LEFT JOIN rows_of AS f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
),
played AS (SELECT conv_id, sha256(array_to_string(arg_max(lines, k), chr(10))) AS repaired_sha256 FROM play GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND concat(before, kind) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_of GROUP BY conv_id
)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, cost, audit, repaired_sha256
FROM ids
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
JOIN repairs ON repairs.conv_id IS NOT DISTINCT FROM ids.conv_id
JOIN played ON played.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
