"""One query per operator over whole tables, and SQL counterparts where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm.bpe import token_digest
from loomset.llm.decontaminate import contamination_digest
from loomset.llm.fill_middle import fill_middle_digest
from loomset.llm.fingerprints import fingerprint_digest
from loomset.llm.mixing import mix
from loomset.llm.near_dedup import near_duplicates
from loomset.llm.pii import pii_digest
from loomset.llm.quality import quality_scores
from loomset.llm.secrets import secrets_digest
from loomset.llm.suffix_dedup import dedup_digest
from loomset.llm.token_counts import rollup_history
from loomset.llm.warc import archive_round_trip
from loomset.llm.whitening import whitening_rows

# Target weights of the mixing query and the last pipeline stage; values that are not listed weigh 1.
WEIGHTS = {"domain": {"d0": 5, "d1": 3, "d2": 2}, "lang": {"en": 3}, "source": {}}
SHARE = 0.6
MAX_EPOCHS = 2
SEED = 11


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain_of(source: Column) -> Column:
    """Sources in three domains by their number; sources without one in a fourth."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})", 1).try_cast("int")
    return F.coalesce(F.concat(F.lit("d"), (number % 3).cast("string")), F.lit("other"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_history(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digest(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_digest(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs, domain_of(F.col("source")), WEIGHTS, SHARE, MAX_EPOCHS, SEED)
    return mixed.select("doc_id", "domain", "lang", "source", "n_tokens", "epochs")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_digest(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_rows(table(spark, sf_dir, "embeddings"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle_digest(table(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_pii, op3_minhash_dedup, op4_substring_dedup, op5_quality,
        op6_simhash, op7_mixing, op8_secrets, op9_decontamination, op10_arc_to_warc,
        op11_whitening, op12_fill_middle, op13_bpe,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP3 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')) END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), links AS (
  SELECT x, y FROM e UNION SELECT y, x FROM e
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
), c AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

_OP9 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, size, w[i:i + size - 1] AS gram
  FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT size FROM grams
), windows AS (
  SELECT doc_id, size, i, w[i:i + size - 1] AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), hits AS (
  SELECT doc_id, item_id, i, windows.size FROM windows JOIN grams ON windows.size = grams.size AND windows.gram = grams.gram
), places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _level(depth: int) -> str:
    """One level of the budget tree as SQL: nodes with what they can give, and their share of the parent's budget."""
    levels = ["domain", "lang", "source"]
    keys, above = levels[:depth], levels[: depth - 1]
    weight = " ".join(f"WHEN '{v}' THEN {w}" for v, w in WEIGHTS[keys[-1]].items())
    weight = f"CASE {keys[-1]} {weight} ELSE 1 END" if weight else "1"
    source = f"JOIN given{depth - 1} g USING ({', '.join(above)})" if above else "CROSS JOIN total g"
    parent = f"PARTITION BY {', '.join(above)}" if above else ""
    window = f"{parent} ORDER BY ratio, {keys[-1]}"
    return f"""
nodes{depth} AS (
  SELECT {', '.join('a.' + k for k in keys)}, a.able, a.weight, a.able / a.weight AS ratio, g.given AS budget
  FROM (SELECT {', '.join(keys)}, sum(able)::BIGINT AS able, any_value({weight})::BIGINT AS weight FROM leaves GROUP BY ALL) a {source}
), shares{depth} AS (
  SELECT *, (budget - coalesce(sum(able) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER ({window} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM nodes{depth}
), firsts{depth} AS (
  SELECT *, min(CASE WHEN level < ratio THEN ratio END) OVER ({parent}) AS r,
    min(CASE WHEN level < ratio THEN {{'r': ratio, 'level': level}} END) OVER ({parent}) AS f FROM shares{depth}
), given{depth} AS (
  SELECT {', '.join(keys)}, able, greatest(CASE WHEN r IS NULL OR ratio < r THEN able ELSE least(able, floor(f.level * weight)) END, 0)::BIGINT AS given
  FROM firsts{depth}
)"""


_OP7 = rf"""
WITH tokens AS (
  SELECT doc_id, coalesce('d' || (TRY_CAST(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})', 1), '') AS INT) % 3), 'other') AS domain,
    lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
  FROM documents
), total AS (
  SELECT floor({SHARE}::DOUBLE * sum(n_tokens)::DOUBLE)::BIGINT AS given FROM tokens
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply, (sum(n_tokens) * {MAX_EPOCHS})::BIGINT AS able FROM tokens WHERE n_tokens > 0 GROUP BY ALL
),{_level(1)},{_level(2)},{_level(3)},
plans AS (
  SELECT domain, lang, source, given // supply AS whole, given % supply AS rest FROM given3 JOIN leaves USING (domain, lang, source)
), keyed AS (
  SELECT t.*, p.whole, p.rest, md5('{SEED}' || ':' || p.whole || ':' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM tokens t JOIN plans p USING (domain, lang, source) WHERE n_tokens > 0
), placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM keyed
)
SELECT doc_id, domain, lang, source, n_tokens, (whole + (upto <= rest)::INT)::BIGINT AS epochs FROM placed WHERE whole + (upto <= rest)::INT > 0
"""

_OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), g AS (
  SELECT doc_id, text, u, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS r FROM d
), c AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
      WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM g
), p AS (
  SELECT doc_id, n, form, text, coalesce(array_to_string(u[1:a], ''), '') AS x, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || x || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || x || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

ORACLES = {"op3_minhash_dedup": _OP3, "op7_mixing": _OP7, "op9_decontamination": _OP9, "op12_fill_middle": _OP12}
