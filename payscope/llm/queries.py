"""One query per operator, over its whole table, and DuckDB statements where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from payscope.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return add


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_token_files")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.token_files import read_token_files, write_token_files

    files = write_token_files(
        table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), blanks=False, end_id=1,
        n_ids=49_408,
    )
    return read_token_files(spark, files)


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256,
  CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""


@register("op7_exact_dedup", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents")).drop("chain")


@register("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


OP5_SQL = r"""
WITH cut AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'i', item_id, text FROM benchmark
), split AS (
  SELECT kind, id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM cut
), windows AS (
  SELECT DISTINCT id AS item_id, least(len(w), 13) AS m,
    array_to_string(w[i : i + 12], ' ') AS phrase
  FROM split, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS r(i) WHERE kind = 'i' AND len(w) > 0
), sizes AS (SELECT DISTINCT m FROM windows),
spots AS (
  SELECT id AS doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS phrase
  FROM split, sizes, unnest(range(1, len(w) - m + 2)) AS r(i) WHERE kind = 'd'
), found AS (SELECT doc_id, item_id, i, m FROM spots JOIN windows USING (m, phrase)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + m)) AS r(p) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM split LEFT JOIN hits ON id = hits.doc_id LEFT JOIN items ON id = items.doc_id WHERE kind = 'd'"""


@register("op5_decontaminate", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.decontaminate import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP4_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM split, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(p.n) AS nx, any_value(q.n) AS ny, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS MATERIALIZED (
  SELECT x, y, common = nx AND nx = ny AS same FROM pairs WHERE 5 * common >= 4 * (nx + ny - common)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT d.doc_id, min(r.y) AS class_id,
  (SELECT count(*) FROM links WHERE links.x = d.doc_id) AS n_links,
  (SELECT count(*) FROM links WHERE links.x = d.doc_id AND same) + 1 AS copies
FROM documents d JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id"""


@register("op4_near_join", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.near_join import near_join

    return near_join(table(spark, sf_dir, "documents"))


@register("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.quality import classify

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = classify(docs, table(spark, sf_dir, "labels"))
    return found.selectExpr(
        "doc_id", "lang", "exp(__log_perplexity) AS perplexity", "exp(__threshold) AS threshold",
        "__trusted AS trusted", "__rejected AS rejected",
    )


OP8_SQL = r"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i : i + 34], ' ')) AS s
  FROM split, unnest(range(1, len(w) - 33)) AS r(i) WHERE len(w) >= 35
), again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS gone
  FROM windows JOIN again USING (s), unnest(range(i, i + 35)) AS r(p) GROUP BY doc_id
), kept AS (
  SELECT split.doc_id, len(w) AS n, coalesce(len(gone), 0) AS n_removed,
    list_filter(w, lambda x, i: gone IS NULL OR NOT list_contains(gone, i)) AS left_over
  FROM split LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n AS n_words, n_removed, sha256(array_to_string(left_over, ' ')) AS kept_sha256 FROM kept"""


@register("op8_substring_dedup", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.substring_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents"))


@register("op6_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.suffix_dedup import suffix_dedup

    return suffix_dedup(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH split AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, source, i, l[i] AS line, trim(l[i]) AS bare FROM split, unnest(range(1, len(l) + 1)) AS r(i)
), boilerplate AS (
  SELECT bare FROM lines WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= 10
), marked AS (
  SELECT lines.*, boilerplate.bare IS NOT NULL AS gone FROM lines LEFT JOIN boilerplate USING (bare)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
FROM marked GROUP BY doc_id"""


@register("op3_line_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.line_dedup import line_dedup

    return line_dedup(table(spark, sf_dir, "documents"))


@register("op2_surrogates")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.surrogates import replace_entities

    return replace_entities(table(spark, sf_dir, "documents"), key="a key of your own")


OP11_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS l,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i : i + 2]) AS k
  FROM split, unnest(range(1, len(w) - 1)) AS r(i) WHERE len(w) >= 3
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM windows, unnest(range(i, i + 3)) AS r(p) WHERE k > 1 GROUP BY doc_id
), lined AS (SELECT * EXCLUDE (l), list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM split),
measured AS (
  SELECT doc_id, t, w, l, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM lined LEFT JOIN repeats USING (doc_id)
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 12 * n_words AND 10 * n_symbols <= n_words
  AND 10 * n_dup_lines <= 3 * len(l)
  AND 10 * len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) >= 7 * n_words
  AND 10 * len(list_filter(w, lambda x: suffix(x, '!'))) <= 3 * n_words
  AND 2 * length(regexp_replace(t, '[^A-Z]', '', 'g')) <= length(regexp_replace(t, '[^A-Za-z]', '', 'g'))
  AND 10 * len(list_filter(l, lambda x: suffix(x, '...') OR suffix(x, '…'))) <= 3 * len(l)
  AND 10 * len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]'))) <= 9 * len(l) AS kept
FROM based"""


@register("op11_rule_cascade", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.rule_cascade import cascade

    return cascade(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "failed_rule")


OP13_SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), pieces AS (
  SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts)
), counts AS MATERIALIZED (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f
  FROM pieces, unnest(range(1, 5)) AS s(m), unnest(range(1, len(w) - m + 2)) AS r(i)
  WHERE len(w) >= m GROUP BY ALL
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS MATERIALIZED (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND f >= 30
), cuts AS (
  SELECT c.lang, c.m, c.phrase, c.a, k, l.f AS l, r.f AS r,
    CAST(2000000 * CAST(c.a AS HUGEINT) // (l.f + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN counts l ON l.lang = c.lang AND l.m = k AND l.phrase = array_to_string(w[1 : k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.m = c.m - k AND r.phrase = array_to_string(w[k + 1 : ], ' ')
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(a) AS cover
  FROM candidates, unnest(range(2, m)) AS q(s), unnest(range(1, m - s + 2)) AS r(i) WHERE m > 2 GROUP BY ALL
), ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
    s.phrase, a, l, r, score
  FROM scored s LEFT JOIN inside USING (lang, phrase) WHERE cover IS NULL OR 100 * cover < 80 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


@register("op13_collocations", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH split AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
), words AS (
  SELECT kind, id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM split
), totals AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM words WHERE kind = 'd' AND len(w) > 0),
asked AS MATERIALIZED (SELECT DISTINCT id AS item_id, unnest(w) AS term FROM words WHERE kind = 'i'),
postings AS MATERIALIZED (
  SELECT id AS doc_id, term, n, count(*) AS tf
  FROM (SELECT id, len(w) AS n, unnest(w) AS term FROM words WHERE kind = 'd')
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM postings, totals GROUP BY term, nn
), parts AS (
  SELECT doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))) AS part
  FROM postings JOIN weights USING (term), totals
), scores AS (
  SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM asked JOIN parts USING (term) GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10"""


@register("op12_lexical_search", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.llm.lexical_search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
