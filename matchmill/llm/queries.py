"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.llm import bpe, decontaminate, edit_embedding, embedding_pq, html_wrapper, lexical_search, line_dedup, pii, prefix_trie, quality, simhash, toxicity, url_filter
from matchmill.llm.shipping import ship_code
from matchmill.plans.queries.common import Query
from matchmill.session import cut_lineage

#: The rules of the URL query; others are asked where none of them fits.
URL_RULES = [
    url_filter.Rule("allow", "org"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]
URL_GLOBS = [
    url_filter.Glob("block", "*.ads.*/**"),
    url_filter.Glob("block", "*.spam*/**"),
    url_filter.Glob("block", "*casino*/**"),
    url_filter.Glob("block", "*/**/wp-login.php**"),
    url_filter.Glob("block", "*/**.exe"),
]

#: The key is the caller's secret; this one only makes the query's result the same each time.
PII_KEY = "matchmill example key"

#: Toxicity's chain: whether a text is poor is scored first and known to the model of the next. A fifth of the labels
#: (as for the quality classifier) is kept from training.
TOXIC_CATEGORIES = {"poor": "1 - quality", "toxic": "toxic"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(spark: SparkSession) -> bpe.Vocabulary:
    return bpe.Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary(spark)))


def _url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, URL_GLOBS)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)
    kinds = F.array_join(F.array_sort(F.array_distinct(F.col("found.kind"))), ",")
    return found.select("doc_id", "text", "n_found", kinds.alias("kinds"), F.col("found.pseudonym").alias("pseudonyms"))


def _line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bitmaps = line_dedup.keep_bitmaps(docs, min_docs=10, min_chars=1, keep_first=False)
    kept = line_dedup.apply_bitmaps(docs.select("doc_id", "text"), bitmaps)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def _simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, index=simhash.EXACT_64)
    return found.select("doc_id", F.lower(F.lpad(F.hex("w0"), 16, "0")).alias("fingerprint"), "component_id")


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id")))
    chain = toxicity.train(docs, labels, TOXIC_CATEGORIES)
    return toxicity.score(docs, chain)


def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_wrapper.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def _edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edit_embedding.compare_neighbours(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
        "bands_edited",
    )


def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.col("items").cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def _rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and conv_ids, each conversation beginning with the first turns of that of its hundred."""
    turns = cut_lineage(prefix_trie.numbered_turns(conversations), "turns")
    counts = cut_lineage(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "counts")
    shared = counts.select(
        "conv_id", (F.crc32(F.col("conv_id").cast("string")) % 6).alias("h"), (F.col("conv_id") - F.col("conv_id") % 100).alias("base")
    )
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    shared = shared.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    shared = cut_lineage(shared.select("conv_id", "h", "base", "taken"), "shared")
    # At most a hundred conversations share a base, and each takes five of its turns at most.
    heads = turns.where("pos < 5").withColumnRenamed("conv_id", "base").join(shared, "base").where("pos < h")
    own = turns.join(shared, "conv_id").where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "pos", "id", "chars"]
    return heads.select(columns).union(own.select(columns)), counts.select("conv_id")


def _prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(*_rebuilt(table(spark, sf_dir, "conversations")))


def _lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "query_id")
    ranked = lexical_search.rank_documents(table(spark, sf_dir, "documents"), items, k=50)
    return ranked.withColumnRenamed("query_id", "item_id")


def _embedding_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_pq.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

URL_SQL = rf"""
WITH split_url AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split_url),
rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fitting AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT p.page_id, host, path, rule,
       coalesce(verdict, CASE
         WHEN regexp_matches('.' || host || path, '^[^/]*\.ads\.[^/]*/') THEN 'block'
         WHEN regexp_matches('.' || host || path, '^[^/]*\.spam[^/]*/') THEN 'block'
         WHEN regexp_matches('.' || host || path, '^[^/]*casino[^/]*/') THEN 'block'
         WHEN regexp_matches('.' || host || path, '(?s)^[^/]*/.*/wp-login\.php') THEN 'block'
         WHEN regexp_matches('.' || host || path, '(?s)^[^/]*/.*\.exe$') THEN 'block'
         ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN fitting f USING (page_id)
"""

_BLANK_SQL = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_SQL = f"""
WITH split_text AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each_line AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split_text),
keyed AS (SELECT doc_id, line, pos, translate(trim(line, {_BLANK_SQL}), '{_UPPER}', '{_LOWER}') AS line_key FROM each_line),
frequent AS (SELECT line_key FROM keyed WHERE line_key <> '' GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.line_key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.line_key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.line_key = f.line_key
GROUP BY doc_id
"""

_WORDS_SQL = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

WINDOW_SQL = f"""
WITH item_words AS (SELECT item_id, {_WORDS_SQL} AS words FROM benchmark),
sized AS (SELECT item_id, words, least(10, len(words)) AS size FROM item_words WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i + 1 : i + size], ' ') AS gram
  FROM (SELECT item_id, words, size, unnest(range(len(words) - size + 1)) AS i FROM sized)),
doc_words AS (SELECT doc_id, {_WORDS_SQL} AS words FROM documents),
places AS (
  SELECT doc_id, size, i, array_to_string(words[i + 1 : i + size], ' ') AS gram
  FROM (SELECT doc_id, words, size, unnest(range(len(words) - size + 1)) AS i
        FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
found AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, gram)),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN hit_items m ON d.doc_id = m.doc_id
"""

_TERMS_SQL = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH_SQL = f"""
WITH doc_terms AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS_SQL} AS terms FROM documents),
sized AS (SELECT row, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM doc_terms WHERE len(terms) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sized),
item_terms AS (SELECT DISTINCT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark),
postings AS (
  SELECT row, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, unnest(terms) AS term FROM sized)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, corpus GROUP BY term),
normal AS (SELECT row, doc_id, 50 + ((50 * n * docs) // total) AS m FROM sized, corpus),
scored AS (
  SELECT item_id, doc_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM item_terms JOIN postings USING (term) JOIN weights USING (term) JOIN normal USING (row)
  GROUP BY item_id, doc_id, row),
placed AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 50
"""

LINK_SQL = """
WITH RECURSIVE doubles AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
valid AS (
  SELECT vec_id, v FROM doubles
  WHERE v IS NOT NULL AND list_bool_and(list_transform(v, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(v, lambda x: x <> 0))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a),
least AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
counted AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, component_id = vec_id AS kept
FROM least LEFT JOIN counted USING (vec_id)
"""

TRIE_SQL = """
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
numbered AS (
  SELECT conv_id, turn_id, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, turn_id) - 1 AS pos
  FROM (SELECT conv_id, turn, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS turn_id,
               length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL)),
counts AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base,
         list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))) AS bytes
  FROM numbered GROUP BY conv_id),
hashed AS (
  SELECT conv_id, n, base, xor(list_reduce(bytes, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 6 AS h
  FROM counts, crc_table),
shared AS (
  SELECT c.conv_id, c.h, c.base, least(c.h, coalesce(b.n, 0)) AS taken FROM hashed c LEFT JOIN hashed b ON b.conv_id = c.base),
rebuilt AS (
  SELECT s.conv_id, pos + 1 AS depth, turn_id, chars FROM shared s JOIN numbered ON numbered.conv_id = base AND pos < h
  UNION ALL SELECT s.conv_id, pos - h + taken + 1, turn_id, chars FROM shared s JOIN numbered ON numbered.conv_id = s.conv_id AND pos >= h),
paths AS (
  SELECT conv_id, depth, chars, string_agg(turn_id, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM counts),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM paths GROUP BY path, depth),
children AS (SELECT left(path, length(path) - 64) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
told AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
sums AS (
  SELECT p.path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * t.chars) AS BIGINT) AS saved_tokens
  FROM told t JOIN paths p ON p.conv_id = t.conv_id AND p.depth <= t.depth GROUP BY p.path),
lasts AS (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id),
ends AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM lasts GROUP BY path)
SELECT t.conv_id, CAST(t.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM told t JOIN sums USING (path) LEFT JOIN ends USING (path)
     LEFT JOIN nodes u ON t.depth > 0 AND u.path = left(t.path, length(t.path) - 64)
"""

QUERIES: dict[str, Query] = {
    "op1_byte_bpe": Query(_byte_bpe),
    "op2_url_filter": Query(_url_filter, URL_SQL),
    "op3_pii": Query(_pii),
    "op4_line_dedup": Query(_line_dedup, LINE_SQL),
    "op5_simhash": Query(_simhash),
    "op6_toxicity": Query(_toxicity),
    "op7_html": Query(_html),
    "op8_edit_fingerprint": Query(_edit_fingerprint),
    "op9_decontaminate": Query(_decontaminate, WINDOW_SQL),
    "op10_quality": Query(_quality),
    "op11_prefix_trie": Query(_prefix_trie, TRIE_SQL),
    "op12_lexical_search": Query(_lexical_search, SEARCH_SQL),
    "op13_embedding_pq": Query(_embedding_pq, LINK_SQL),
}
