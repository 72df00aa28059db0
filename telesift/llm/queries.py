"""The registered query of each operator, over its whole table and with production settings, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telesift.llm import (
    conversation_repair, decontamination, license_scan, lm_scoring, nearest_vectors, ngram_join, packing, quality_classifier, quality_rules,
    ranked_search, sharding, token_output, toxicity,
)
from telesift.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# The checksum's table is worked out by its rule, and texts are read byte by byte; order and cuts are the operator's law.
_SHARDING_SQL = """
WITH steps AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc
), read AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, string_split(hex(encode(coalesce(text, ''))), '') AS digits FROM documents
), summed AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, size - 7),
      lambda i: (instr('0123456789ABCDEF', digits[2 * i - 1]) - 1) * 16 + instr('0123456789ABCDEF', digits[2 * i]) - 1)),
    lambda c, b: xor(c // 256, crc[xor(c % 256, b) + 1]))) AS text_crc32
  FROM read, steps
), placed AS (
  SELECT *, row_number() OVER w - 1 AS row_no, sum(size) OVER w - size AS before, sum(size) OVER () AS total
  FROM summed WINDOW w AS (ORDER BY doc_id NULLS FIRST, size, text_crc32)
), cut AS (
  SELECT *, CAST(((2 * before + size) * 24) // (2 * total) AS INTEGER) AS shard FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
  row_no - min(row_no) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""


@query("op7_sharding", _SHARDING_SQL)
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 contiguous shards of near equal bytes, in ascending doc_id order."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
    )
    return sharding.assign(docs, order_by=["doc_id", "size", "text_crc32"], size="size", shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


_RULES = quality_rules.LineRules()
_SHORT = f"^{quality_rules.SPACE}*{quality_rules.WORD}+({quality_rules.SPACE}+{quality_rules.WORD}+){{0,{_RULES.short_line_words - 2}}}{quality_rules.SPACE}*$"
_count = lambda text, pattern: f"len(regexp_extract_all({text}, {_sql_text(pattern)}))"
_has = lambda text, pattern: f"regexp_matches({text}, {_sql_text(pattern)})"

_QUALITY_RULES_SQL = f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), windows AS (
  SELECT rid, unnest(range(1, len(words) - 6)) AS pos,
    unnest(list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' '))) AS win
  FROM base WHERE len(words) >= 8
), twice AS (
  SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, win) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT rid, sum(reach) AS n_repeat_words
  FROM (SELECT rid, least(8, coalesce(lead(pos) OVER (PARTITION BY rid ORDER BY pos) - pos, 8)) AS reach FROM twice)
  GROUP BY rid
), judged AS (
  SELECT rid, line, pos, CASE
      WHEN {_count("line", quality_rules.SEPARATORS)} >= {_RULES.min_separators}
        AND {_count("line", quality_rules.SEPARATORS)} >= {_count("line", quality_rules.WORD + "+")} * {_RULES.min_separator_share} THEN 'navigation'
      WHEN {_has("line", quality_rules.WORD)}
        AND {_count("line", quality_rules.NOISE)} >= {_count("line", quality_rules.WORD + "+")} * {_RULES.max_noise_share}
        THEN 'punctuation'
      WHEN {_has("line", _SHORT)} AND NOT {_has("line", quality_rules.LINE_END)} THEN 'navigation'
      WHEN {_has("lower(line)", quality_rules.BOILERPLATE)}
        AND {_count("line", quality_rules.WORD + "+")} <= {_RULES.phrase_line_words} THEN 'boilerplate'
      ELSE '' END AS rule
  FROM (SELECT rid, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM base)
), by_text AS (
  SELECT rid, count(*) FILTER ({_has("line", quality_rules.WORD)}) AS n_lines,
    count(*) FILTER ({_has("line", quality_rules.WORD)})
      - count(DISTINCT line) FILTER ({_has("line", quality_rules.WORD)}) AS n_dup_lines,
    count(*) FILTER (rule = 'punctuation') AS n_punctuation_lines,
    count(*) FILTER (rule = 'navigation') AS n_navigation_lines,
    count(*) FILTER (rule = 'boilerplate') AS n_boilerplate_lines,
    coalesce(sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) FILTER (rule = ''), 0) AS left_chars
  FROM judged GROUP BY rid
), counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST({_count("t", quality_rules.SYMBOLS)} AS BIGINT) AS n_symbols,
    n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    n_lines, n_punctuation_lines, n_navigation_lines, n_boilerplate_lines, left_chars
  FROM base JOIN by_text USING (rid) LEFT JOIN repeats USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words AS base_failed,
  NOT (n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words)
    AND CASE WHEN word_chars = 0 THEN 0.0 ELSE 1 - left_chars / word_chars END <= {_RULES.max_lost} AS kept,
  n_lines, n_punctuation_lines, n_navigation_lines, n_boilerplate_lines
FROM counted
"""


@query("op10_quality_rules", _QUALITY_RULES_SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the verdict of line-first cleaning, per document."""
    judged = quality_rules.line_first(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_punctuation_lines", "n_navigation_lines", "n_boilerplate_lines",
    )


@query("op5_token_output")
def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts written as binary ids in doc_id order, and what the files hold of each."""
    folder = scratch_path(spark, "token-output")
    token_output.write(table(spark, sf_dir, "documents"), folder, key="doc_id", text="text", end_id=1)
    return token_output.read_digests(spark, folder).withColumnRenamed("key", "doc_id")


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token pieces in sequences of 4096."""
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), end_id=1))


def _folded(spark: SparkSession, sf_dir: str, held_out: int) -> tuple[DataFrame, DataFrame]:
    """Documents with `held_out`, and the labels of the others."""
    fold = quality_classifier.in_fold(F.col("doc_id"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold == held_out).alias("held_out"))
    return docs, table(spark, sf_dir, "labels").filter(fold != held_out)


@query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from labels outside the held-out fifth."""
    docs, labels = _folded(spark, sf_dir, 0)
    return quality_classifier.classify(docs, labels, carry=("held_out",))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learned from labels outside the held-out fifth."""
    docs, labels = _folded(spark, sf_dir, 0)
    return toxicity.score(docs, labels, carry=("held_out",))


_LICENSE_SQL = f"""
WITH files AS (
  SELECT row_number() OVER () AS rid, doc_id, source || '/' || lang || '/' || doc_id AS path, text FROM documents
), template_words AS (
  SELECT * FROM (VALUES {", ".join(f"('{a}', {b}, '{c}', {d})" for a, b, c, d in license_scan.template_words())}) AS t(name, template, word, n)
), held AS (
  SELECT DISTINCT rid, unnest(string_split_regex(lower(text), '{license_scan.NOT_WORD}')) AS word FROM files
), idf AS (
  SELECT word, ln(((SELECT count(*) FROM files) + 1) / (coalesce(n, 0) + 1)) + 1 AS idf
  FROM (SELECT DISTINCT word FROM template_words) LEFT JOIN (SELECT word, count(*) AS n FROM held GROUP BY word) USING (word)
), template_norm AS (
  SELECT template, sqrt(sum(n * idf * n * idf)) AS norm FROM template_words JOIN idf USING (word) GROUP BY template
), templates AS (
  SELECT name, template, word, n * idf / norm AS x FROM template_words JOIN idf USING (word) JOIN template_norm USING (template)
), segments AS (
  SELECT rid, unnest(segs) AS segment, unnest(range(1, len(segs) + 1)) AS pos FROM (
    SELECT rid, string_split_regex(regexp_replace(text, '([.!?])[ \\t]+', '\\1' || chr(10), 'g'), chr(10)) AS segs FROM files)
), terms AS (
  SELECT rid, pos, word, count(*) AS tf FROM (
    SELECT rid, pos, unnest(string_split_regex(lower(segment), '{license_scan.NOT_WORD}')) AS word FROM segments)
  WHERE word <> '' GROUP BY rid, pos, word
), weighed AS (
  SELECT rid, pos, word, tf, tf * coalesce(idf, (SELECT avg(idf) FROM idf)) AS weight FROM terms LEFT JOIN idf USING (word)
), normed AS (
  SELECT rid, pos, sqrt(sum(weight * weight)) AS norm, sum(tf) AS length FROM weighed GROUP BY rid, pos
), cosines AS (
  SELECT rid, pos, length, name, template, round(sum(weight / norm * x), 6) AS cosine
  FROM weighed JOIN templates USING (word) JOIN normed USING (rid, pos) GROUP BY rid, pos, length, norm, name, template
), best AS (
  SELECT rid, pos, length, cosine, name FROM cosines WHERE cosine >= {license_scan.MIN_COSINE}
  QUALIFY row_number() OVER (PARTITION BY rid, pos ORDER BY cosine DESC, name) = 1
), noticed AS (
  SELECT rid, first(name ORDER BY cosine DESC, pos) AS own_license, max(cosine) AS own_cosine, count(*) AS n_notices, sum(length) AS length
  FROM best GROUP BY rid
), own AS (
  SELECT files.rid, doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir, own_license, own_cosine,
    coalesce(n_notices, 0) AS n_notices,
    coalesce(length >= {license_scan.NOTICE_SHARE} * len(list_filter(string_split_regex(lower(text), '{license_scan.NOT_WORD}'), lambda w: w <> '')), false) AS is_license_file
  FROM files LEFT JOIN noticed USING (rid)
), given AS (
  SELECT dir AS above, first(own_license ORDER BY own_cosine DESC, path) AS name FROM own WHERE is_license_file GROUP BY dir
), nearest AS (
  SELECT dir, first(above ORDER BY length(above) DESC) AS above, first(name ORDER BY length(above) DESC) AS name
  FROM (SELECT DISTINCT dir FROM own) JOIN given ON dir = above OR starts_with(dir, above || '/') OR above = '' GROUP BY dir
)
SELECT doc_id, path, own_license, own_cosine, n_notices, is_license_file, coalesce(own_license, name) AS license,
  CASE WHEN own_license IS NOT NULL THEN 'own' ELSE above END AS license_from
FROM own LEFT JOIN nearest USING (dir)
"""


@query("op1_license_scan", _LICENSE_SQL)
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, each a file in a folder of its source and language."""
    files = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text"
    )
    return license_scan.scan(files, carry=("doc_id", "path"))


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with each benchmark item found and verified in it."""
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# All pairs of documents that share a shingle, counted; components by what links reach.
_NGRAM_SQL = """
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents
), sets AS (
  SELECT rid, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles FROM split
), texts AS (
  SELECT min(rid) AS node, shingles, len(shingles) AS n FROM (SELECT rid, list_sort(shingles) AS shingles FROM sets) WHERE len(shingles) > 0 GROUP BY shingles
), held AS (
  SELECT node, n, unnest(shingles) AS shingle FROM texts
), links AS (
  SELECT a.node AS a, b.node AS b FROM held a JOIN held b ON a.shingle = b.shingle AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(node, other) AS (
  SELECT node, node FROM texts UNION SELECT reached.node, both_ways.b FROM reached JOIN both_ways ON reached.other = both_ways.a
), members AS (
  SELECT rid, doc_id, len(sets.shingles) AS n_shingles, node FROM sets LEFT JOIN texts ON list_sort(sets.shingles) = texts.shingles
), least AS (
  SELECT node, min(doc_id) AS doc_id FROM members GROUP BY node
), components AS (
  SELECT reached.node, min(least.doc_id) AS component_id FROM reached JOIN least ON reached.other = least.node GROUP BY reached.node
)
SELECT members.doc_id, CAST(n_shingles AS BIGINT) AS n_shingles, coalesce(component_id, members.doc_id) AS component_id,
  coalesce(least.doc_id, members.doc_id) AS class_id
FROM members LEFT JOIN components USING (node) LEFT JOIN least USING (node)
"""


@query("op9_ngram_join", _NGRAM_SQL)
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest doc_id that links of 75 % or more lead to."""
    return ngram_join.link(table(spark, sf_dir, "documents"))


@query("op4_lm_scoring")
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's probability, learned from the texts outside the held-out fifth."""
    fold = quality_classifier.in_fold(F.col("doc_id"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold == 1).alias("held_out"))
    return lm_scoring.score(docs, ~F.col("held_out"), carry=("doc_id", "held_out"))


#: Vectors that take part, and all distances of the queries to them.
_NEAREST_SQL = f"""
WITH taking AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    sqrt(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])))) AS score
  FROM taking q JOIN taking c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= {nearest_vectors.K}
"""


@query("op11_nearest_vectors", _NEAREST_SQL)
def op11_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of all other vectors, for every hundredth vec_id."""
    return nearest_vectors.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


_RANKED_SQL = f"""
WITH terms AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)
), held AS (
  SELECT rid, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), sized AS (
  SELECT rid, CAST(sum(tf) AS BIGINT) AS words FROM held GROUP BY rid
), whole AS (
  SELECT count(*) AS texts, CAST(sum(words) AS BIGINT) AS total FROM sized
), weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * texts + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM held, whole GROUP BY term, texts
), asked AS (
  SELECT DISTINCT item_id, text FROM benchmark
), asked_terms AS (
  SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM asked
), scored AS (
  SELECT item_id, asked_terms.text, rid, doc_id,
    CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * words * texts) // total)))) AS BIGINT) AS score
  FROM asked_terms JOIN held USING (term) JOIN weighed USING (term) JOIN sized USING (rid), whole GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {ranked_search.K}
"""


@query("op12_ranked_search", _RANKED_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty documents of highest score for each benchmark item."""
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cost, edits and digest of the repair of every conversation, after damage by a rule."""
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    repaired = conversation_repair.repair(damaged, gone=F.col("gone"))
    return repaired.conversations.withColumnRenamed("sha256", "repaired_sha256")
