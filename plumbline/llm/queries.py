"""The operators as queries over the given tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import pii, toxicity
from plumbline.llm.embedding_dedup import near_vectors
from plumbline.llm.exact_dedup import exact_duplicates
from plumbline.llm.filter_audit import audit
from plumbline.llm.language_id import fit, held_out, identify
from plumbline.llm.line_dedup import without_repeated_lines
from plumbline.llm.mixing import Level, by_choice, selection
from plumbline.llm.near_dedup import near_duplicates
from plumbline.llm.packing import pack
from plumbline.llm.resampling import resampled
from plumbline.llm.sharding import shard
from plumbline.llm.substring_dedup import without_repeats


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(documents(spark, sf_dir), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir)).drop("_k", "_l")


def mixture() -> list[Level]:
    """Domains by the number of the source, then languages, then sources, all alike, with fixed weights."""
    number = F.try_to_number(F.nullif(F.regexp_extract("source", "([0-9]+)$", 1), F.lit("")), F.lit("999999999"))
    domain = F.concat(F.lit("domain"), (number.cast("int") % 4).cast("string"))
    return [
        Level("domain", domain, by_choice("domain", {"domain0": 4, "domain1": 3, "domain2": 2})),
        Level("lang", F.col("lang"), by_choice("lang", {"en": 5, "de": 2, "fr": 2})),
        Level("source", F.col("source"), F.lit(1.0)),
    ]


MIX_FRACTION = 0.8


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection(documents(spark, sf_dir), mixture(), fraction=MIX_FRACTION)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    network = fit(docs, ~held_out())
    return identify(docs, network, ["doc_id", held_out().alias("held_out")], "doc_id long, held_out boolean")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_spans(documents(spark, sf_dir)))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), toxicity.learning_part())
    carried = ["doc_id", toxicity.held_out().alias("held_out")]
    return toxicity.score(docs, model, carried, "doc_id long, held_out boolean")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).drop("intervals", "kept")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("_k", "_l")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_lines(documents(spark, sf_dir)).drop("kept")


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("n_words")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_mixing": op3_mixing,
    "op4_language_id": op4_language_id,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_pii": op6_pii,
    "op7_toxicity": op7_toxicity,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_sharding": op9_sharding,
    "op10_near_dedup": op10_near_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_line_dedup": op12_line_dedup,
    "op13_resampling": op13_resampling,
}

_EXACT = """
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256
FROM d
"""

_REPEATS = """
WITH d AS (SELECT doc_id, coalesce(string_split_regex(trim(coalesce(text, ''), E' \\t\\n\\x0B\\f\\r'), '[\\x20\\x09-\\x0D]+'), []) AS raw FROM documents),
w AS (SELECT doc_id, list_filter(raw, lambda x: x <> '') AS words FROM d),
s AS (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS p FROM w WHERE len(words) >= 35),
h AS (SELECT doc_id, p, array_to_string(words[p:p + 34], ' ') AS body FROM s),
r AS (SELECT doc_id, p, count(*) OVER (PARTITION BY body) AS n FROM h),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS gone FROM r WHERE n > 1),
l AS (SELECT doc_id, list(gone) AS gone FROM g GROUP BY doc_id),
k AS (SELECT doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
  CASE WHEN gone IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(gone, i)) END AS kept
  FROM w LEFT JOIN l USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""



def _division(name: str, path: list[str], weight: str, given: str) -> str:
    """One level of budgets: ``name`` from the leaves, and the budgets ``given`` above (a number, or a table)."""
    parent = ", ".join(path[:-1])
    over = f"PARTITION BY {parent}" if parent else ""
    budget = f"JOIN {given} USING ({parent})" if parent else f"CROSS JOIN {given}"
    keys, last = ", ".join(path), path[-1]
    return f"""
{name}_c AS (SELECT * FROM (SELECT {keys}, sum(capacity) AS capacity, max({weight}) AS w FROM leaf GROUP BY {keys}) {budget}),
{name}_f AS (SELECT *, capacity / w * sum(w) OVER ({over} ORDER BY capacity / w, {last} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
  + coalesce(sum(capacity) OVER ({over} ORDER BY capacity / w, {last} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= budget AS whole
  FROM {name}_c),
{name} AS (SELECT {keys}, CASE WHEN whole THEN capacity ELSE (budget - coalesce(sum(CASE WHEN whole THEN capacity END) OVER ({over}), 0)) * w
  / sum(CASE WHEN NOT whole THEN w END) OVER ({over}) END AS budget FROM {name}_f)"""


_MIXED = f"""
WITH t AS (SELECT doc_id, coalesce('domain' || (CAST(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS INT) % 4), '(none)') AS domain,
  coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS DOUBLE) AS tokens, CAST(3 * sum(tokens) AS DOUBLE) AS capacity,
  CASE domain WHEN 'domain0' THEN 4.0::DOUBLE WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END AS wd,
  CASE lang WHEN 'en' THEN 5.0::DOUBLE WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS wl, 1.0::DOUBLE AS ws FROM t GROUP BY ALL),
total AS (SELECT sum(tokens) * {MIX_FRACTION}::DOUBLE AS budget FROM leaf),
{_division("b1", ["domain"], "wd", "total")},
{_division("b2", ["domain", "lang"], "wl", "b1")},
{_division("b3", ["domain", "lang", "source"], "ws", "b2")},
plan AS (SELECT domain, lang, source, CAST(tokens AS BIGINT) AS whole, CAST(floor(budget + 1e-6) AS BIGINT) AS budget
  FROM leaf JOIN b3 USING (domain, lang, source) WHERE tokens > 0),
r AS (SELECT t.*, budget // whole AS passes, budget % whole AS rest FROM t JOIN plan USING (domain, lang, source)),
o AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('7:' || (passes + 1) || ':' || doc_id), doc_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM r),
n AS (SELECT *, passes + CASE WHEN used <= rest AND used - tokens < rest THEN 1 ELSE 0 END AS times FROM o)
SELECT doc_id, domain, lang, source, tokens, CAST(unnest(range(1, times + 1)) AS INT) AS epoch FROM n
"""

_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id, vec_id AS reached FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.reached = l.a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, min(reached) AS component_id, vec_id = min(reached) AS kept
FROM r LEFT JOIN n USING (vec_id) GROUP BY vec_id, n_links
"""

_AUDIT = """
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
  list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
f AS (SELECT doc_id, part, [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
  100 * len(regexp_extract_all(body, '[A-Z]')) > 10 * length(body), regexp_matches(body, '[#$%&*|]'),
  doc_id > min(doc_id) OVER (PARTITION BY body)] AS fails FROM w),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
  FROM f LEFT JOIN labels USING (doc_id) GROUP BY part, fails),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT c1.x || c2.x || c3.x || c4.x || c5.x AS filter_order FROM c c1, c c2, c c3, c c4, c c5
  WHERE len(list_distinct([c1.x, c2.x, c3.x, c4.x, c5.x])) = 5),
s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
x AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter, n, good, toxic,
  fails[strpos('ABCDE', substr(filter_order, step, 1))] AS fail, len(list_filter(fails, lambda b: b)) = 1 AS single,
  len(list_filter(range(1, step), lambda i: fails[strpos('ABCDE', substr(filter_order, i, 1))])) > 0 AS gone FROM m, s),
r AS (SELECT part, filter_order, step, letter, coalesce(sum(n) FILTER (NOT fail AND NOT gone), 0) AS kept,
  coalesce(sum(n) FILTER (fail AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (fail AND gone), 0) AS redundant,
  coalesce(sum(n) FILTER (fail AND single), 0) AS unique_fails, coalesce(sum(good) FILTER (fail AND NOT gone), 0) AS good_lost,
  coalesce(sum(toxic) FILTER (fail AND NOT gone), 0) AS toxic_lost FROM x GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r
"""

_LINES = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS p FROM d),
k AS (SELECT *, translate(trim(line, E' \\t\\n\\x0B\\f\\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id <> keeper) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY doc_id
"""

ORACLES = {
    "op11_filter_audit": _AUDIT,
    "op12_line_dedup": _LINES,
    "op3_mixing": _MIXED,
    "op2_exact_dedup": _EXACT,
    "op5_embedding_dedup": _VECTORS,
    "op8_substring_dedup": _REPEATS,
}
