"""Queries of the corpus operators over the driver tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontaminate, exact_dedup, lexical, line_dedup, ngram_join, packing, quality, secrets, sharding, substring_dedup, token_files, url_filter
from .common import shared_path, stored, table

SHARDS = [f"shard-{i:03d}" for i in range(128)]
#: Keys of pages of less HTML than this are listed, as thin.
THIN = 1_500


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("n_bytes"))
    return sharding.assign_shards(docs, "doc_id", SHARDS)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    host, path = url_filter.split_url(F.col("url"))
    listed = pages.filter(F.length("html") < THIN).select(F.concat(host, path).alias("key"))
    return url_filter.judge_urls(pages.select("page_id", "url"), listed).select("page_id", "host", "path", "rule", "verdict")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = stored(quality.document_statistics(docs))
    model = quality.fit_quality(measured, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    scored = quality.score_quality(measured, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    n_removed = F.col("n_bytes") - F.octet_length("kept")
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secrets.BASE_RULES]

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    n = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base]
    return found.select("doc_id", *n, F.sha2(said(of(*base)), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(stored(packing.pieces(table(spark, sf_dir, "documents"))))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(decontaminate.find_overlaps(docs, table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark)
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_file())
    # small rows are stored, so that decoding runs here, with small Arrow batches, and once
    return stored(token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sharding, op2_url_filter, op3_line_dedup, op4_ngram_join, op5_quality, op6_substring_dedup, op7_secrets, op8_exact_dedup, op9_packing, op10_decontamination, op11_lexical_search, op12_token_files, op13_collocations)}


#: The owner of each slot as two hexadecimal digits, slot after slot.
_OWNERS = "".join(f"{k:02x}" for k in sharding.lookup_table(SHARDS))

OP1_SQL = f"""
WITH placed AS (
  SELECT doc_id, coalesce(strlen(text), 0)::INTEGER AS n_bytes, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT % {sharding.TABLE_SIZE})::INTEGER AS slot FROM documents
)
SELECT doc_id, n_bytes, slot, 'shard-' || lpad((('0x' || substr('{_OWNERS}', 2 * slot + 1, 2))::INTEGER)::VARCHAR, 3, '0') AS shard FROM placed
"""

_RULES_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)

OP2_SQL = f"""
WITH parts AS (
  SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END, '') AS rest, length(html) < {THIN} AS thin FROM pages
), split AS (
  SELECT page_id, thin, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(v, h, p) AS (VALUES {_RULES_SQL}
), listed AS (SELECT DISTINCT host || path AS key FROM split WHERE thin
), fit AS (
  SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS rule_verdict
  FROM split LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL
)
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN host || path IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict FROM fit
"""

OP3_SQL = """
WITH lines AS (
  SELECT doc_id, n, line, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS n FROM documents)
), keyed AS (SELECT doc_id, n, line, w, array_to_string(w, ' ') AS said FROM lines WHERE len(w) > 0
), firsts AS (SELECT said, any_value(w) AS w, min((doc_id, n)) AS place, count(*) AS c FROM keyed GROUP BY said
), cut AS (
  SELECT said, place, len(w) AS k, p, md5(array_to_string(w[1 : p - 1] || w[p + 1 :], ' ')) AS rest
  FROM (SELECT said, place, w, unnest(range(1, len(w) + 1)) AS p FROM firsts WHERE len(w) >= 7)
), substituted AS (
  SELECT said FROM (SELECT said, place, min(place) OVER (PARTITION BY p, k, rest) AS least FROM cut WHERE k >= 8) WHERE place > least
), inserted AS (
  SELECT c.said AS longer, c.place AS longer_at, f.said AS shorter, f.place AS shorter_at FROM cut c JOIN firsts f ON c.rest = md5(f.said) WHERE c.k >= 8
), near AS (
  SELECT said FROM substituted UNION SELECT longer FROM inserted WHERE shorter_at < longer_at UNION SELECT shorter FROM inserted WHERE longer_at < shorter_at
), gone AS (
  SELECT doc_id, n FROM keyed k JOIN firsts f USING (said) WHERE (k.doc_id, k.n) <> f.place OR k.said IN (SELECT said FROM near)
)
SELECT l.doc_id, count(*) FILTER (len(w) > 0) AS n_lines, count(g.n) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY l.n) FILTER (g.n IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.n = g.n GROUP BY l.doc_id
"""

OP4_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes a ON x = a.doc_id JOIN sizes b ON y = b.doc_id WHERE 100 * c >= 80 * (a.n + b.n - c)
), near AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, n.y FROM reach r JOIN near n ON r.other = n.x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY ALL
"""

OP6_SQL = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (SELECT doc_id, unnest(range(0, greatest(len(h) // 2 - 199, 0))) AS i, unnest(list_transform(range(0, greatest(len(h) // 2 - 199, 0)), lambda i: md5_number(substr(h, 2 * i + 1, 400)))) AS k FROM b
), again AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1
), hit AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200, true)::INTEGER AS new FROM w SEMI JOIN again USING (k)
), runs AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit) GROUP BY doc_id, run
), gaps AS (SELECT doc_id, a, coalesce(lag(z) OVER s, 0) AS from_, lead(a) OVER s IS NULL AS last, z FROM runs WINDOW s AS (PARTITION BY doc_id ORDER BY a)
), cut AS (SELECT doc_id, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed, string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)) || CASE WHEN last THEN substr(h, 2 * z + 1) ELSE '' END, '' ORDER BY a) AS kept FROM gaps JOIN b USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM b LEFT JOIN cut USING (doc_id)
"""


def _secret_sql(rank: int, rule: secrets.Rule) -> str:
    """(doc_id, kind, rank, a, z) of one rule's matches: code points, by the lengths of matches and of what lies between."""
    pattern = rule.pattern.replace("'", "''")
    found = f"SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS v, string_split_regex(t, '{pattern}') AS gap FROM texts"
    at = "list_sum(list_transform(gap[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0)"
    return f"SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, ({at})::BIGINT AS a, ({at} + length(m[i]))::BIGINT AS z FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM ({found})) WHERE length(v[i]) >= {rule.least}"


_BASE_KINDS = ", ".join(f"'{r.kind}'" for r in secrets.BASE_RULES)

OP7_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), spans AS ({" UNION ALL ".join(_secret_sql(k, r) for k, r in enumerate(secrets.BASE_RULES + secrets.MORE_RULES))}
), said AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE_RULES)},
         string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) FILTER (kind IN ({_BASE_KINDS})) AS base, string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) AS every
  FROM spans GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE_RULES)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans FROM texts LEFT JOIN said USING (doc_id)
"""

OP8_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

OP10_SQL = """
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM item_windows
), doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)
), found AS (SELECT doc_id, d.n, i, item_id FROM doc_windows d JOIN item_windows USING (win)
), hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS said FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(said, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


OP11_SQL = """
WITH doc_terms AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents WHERE text IS NOT NULL
), item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
), whole AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM doc_terms WHERE len(w) > 0
), tfs AS (SELECT doc_id, len(w)::BIGINT AS n, term, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS term FROM doc_terms) GROUP BY ALL
), weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tfs, whole GROUP BY term, n_docs
), impacts AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)) AS impact FROM tfs, whole
), scores AS (SELECT item_id, doc_id, sum(weight * impact)::BIGINT AS score FROM item_terms JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

OP13_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), phrases AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS sizes(k) WHERE len(w) >= k) GROUP BY ALL HAVING count(*) >= 100
), split AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE k >= 2
), cuts AS (
  SELECT c.lang, c.phrase, cut_at, a, n, l.f AS l, r.f AS r, ((1000 * a::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut_at FROM split) c
  JOIN phrases l ON l.lang = c.lang AND l.phrase = array_to_string(w[1 : cut_at], ' ') JOIN phrases r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut_at + 1 :], ' ') JOIN totals t ON t.lang = c.lang
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1
), inside AS (
  SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM split)) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_sharding": OP1_SQL, "op2_url_filter": OP2_SQL, "op3_line_dedup": OP3_SQL, "op4_ngram_join": OP4_SQL, "op6_substring_dedup": OP6_SQL, "op7_secrets": OP7_SQL, "op8_exact_dedup": OP8_SQL, "op10_decontamination": OP10_SQL, "op11_lexical_search": OP11_SQL, "op13_collocations": OP13_SQL}
