"""The registered queries of the training-data operators: each applies its operator, with
production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import alignment, ann, decontaminate, filter_audit, licenses, packing, quality, simhash, suffix_dedup, token_counts, token_store, toxicity, url_rules
from ledgerline.session import ensure_checkpoint_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: (verdict, host, path)
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_quality_cotraining(table):
    """Quality of every document by two co-trained views."""
    return quality.score_quality(table("documents"), table("labels"))


@query
def op2_url_rules(table):
    """Verdict of the URL rules on every page."""
    pages = table("pages")
    rules = pages.sparkSession.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_rules.judge_urls(pages, rules)


@query
def op3_token_counts(table):
    """Tokens of every document."""
    return token_counts.token_counts(table("documents"), VOCABULARY, limit=512)


@query
def op4_decontamination(table):
    """Benchmark windows in every document."""
    found = decontaminate.contamination(table("documents"), table("benchmark"))
    return (found.withColumn("items_sha256", F.sha2(F.array_join("items", ",").cast("binary"), 256))
            .select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))


@query
def op5_simhash_near_dedup(table):
    """Near-duplicate class of every document."""
    return (simhash.near_duplicates(table("documents"))
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


@query
def op6_nearest_neighbours(table):
    """Ten nearest vectors of every hundredth."""
    return ann.nearest(table("embeddings"), every=100, k=10)


@query
def op7_suffix_array_dedup(table):
    """What repeated passages leave of every document."""
    return (suffix_dedup.remove_repeats(table("documents"))
            .select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))


@query
def op8_license_scan(table):
    """Licence notices and expressions of every document."""
    return licenses.license_scan(table("documents"))


@query
def op9_packing(table):
    """Every document's tokens in sequences of 1024."""
    return packing.pack_documents(table("documents"), VOCABULARY)


@query
def op10_toxicity(table):
    """Toxicity of every document."""
    return toxicity.score_toxicity(table("documents"), table("labels"))


@query
def op11_tokenizer_alignment(table):
    """Links between two tokenizers' ids in every document."""
    return alignment.align_tokenizers(table("documents"), VOCABULARY, PIECES)[0]


@query
def op12_filter_audit(table):
    """Removals of five filters under all their orders."""
    return filter_audit.filter_audit(table("documents"), table("labels"))


@query
def op13_token_store(table):
    """Every document's ids, written to binary files and read back."""
    docs = table("documents")
    stored = token_store.read_tokens(docs.sparkSession, token_store.write_tokens(docs, VOCABULARY, end_id=2))
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


ORACLE["op2_url_rules"] = """
WITH parts AS (
  SELECT page_id, url, strpos(url, '://') AS mark, substr(url, strpos(url, '://') + 3) AS rest FROM pages),
split AS (
  SELECT page_id,
    CASE WHEN coalesce(mark, 0) = 0 THEN ''
         ELSE translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
    CASE WHEN coalesce(mark, 0) = 0 THEN ''
         ELSE regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) END AS path
  FROM parts),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule,
       coalesce(arg_max(verdict, length(h || p)), 'allow') AS verdict
FROM split LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id, host, path
"""

_WORDS = (r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
ORACLE["op4_decontamination"] = f"""
WITH item AS (SELECT item_id, {_WORDS.format(text="text")} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS gram
  FROM item, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(s) WHERE len(w) > 0),
doc AS (SELECT doc_id, coalesce({_WORDS.format(text="text")}, []) AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM win),
hits AS (
  SELECT d.doc_id, d.s, d.size, win.item_id
  FROM (SELECT doc_id, s, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS gram
        FROM doc, sizes, unnest(range(1, len(w) - size + 2)) AS u(s) WHERE len(w) >= size) d
  JOIN win ON win.size = d.size AND win.gram = d.gram),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM hits, unnest(range(s, s + size)) AS u(pos) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op12_filter_audit"] = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
cut AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
firsts AS (SELECT text, min(doc_id) AS least FROM texts GROUP BY text),
judged AS (
  SELECT part,
         list_filter([CASE WHEN len(words) < 200 THEN 'A' END,
                      CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
                      CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' END,
                      CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
                      CASE WHEN cut.doc_id > least THEN 'E' END], lambda f : f IS NOT NULL) AS names,
         coalesce(cut.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
         coalesce(cut.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic
  FROM cut JOIN firsts USING (text)),
groups AS (SELECT part, names, count(*) AS docs, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
           FROM judged GROUP BY part, names),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
           FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, step::INTEGER AS step, substr(filter_order, step::INTEGER, 1) AS f FROM orders, range(1, 6) AS r(step)),
ended AS (SELECT filter_order, groups.*, list_min(list_transform(names, lambda f : strpos(filter_order, f))) AS gone
          FROM groups, orders),
counted AS (
  SELECT part, filter_order, step, any_value(f) AS f,
         sum(docs) FILTER (WHERE gone IS NULL OR gone > step) AS kept, sum(docs) FILTER (WHERE gone = step) AS removed,
         sum(docs) FILTER (WHERE gone < step AND list_contains(names, f)) AS redundant,
         sum(docs) FILTER (WHERE names = [f]) AS unique_fails,
         sum(good) FILTER (WHERE gone = step) AS good_lost, sum(toxic) FILTER (WHERE gone = step) AS toxic_lost
  FROM ended JOIN steps USING (filter_order) GROUP BY part, filter_order, step)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM counted
"""
