"""The registered queries of this folder: thin digests of the operators, and SQL where it can say the same."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (bpe, conversation, decontaminate, jaccard, katz, licenses, line_dedup, periodic, quality_model, quality_rules,
               secrets, simhash, url_filter)
from .common import table, tune

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Entries of the URL filter.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Least chance of the highest grade that keeps a document.
LEAST_TAIL = 0.4


# SQL: a text with A-Z in lower case; words of digits, letters and everything beyond ASCII; blanks.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK, _NOT_BLANK = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def _words_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_BLANK}+'), lambda x: x <> '')"


def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII text, a bit at a time; DuckDB has no function for it."""
    byte = "list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({text}) + 1), "
            f"lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))), lambda c, b: {byte}), 4294967295)")


def query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = call
        if sql is not None:
            ORACLES[name] = sql
        return call
    return register


def grade() -> Column:
    """0 for toxic rows, 1 for poor ones, 2 for the rest."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)


@query("op1_secrets")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    # a second parameter of the lambda, a default too, would be the place in the array
    counts = [F.size(F.expr(f"filter(base, x -> x.kind = {k})")).cast("bigint").alias(f"n_{name}")
              for k, name in enumerate(secrets.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
                        secrets.span_text(F.array_sort(F.concat("base", "added"))).alias("spans"))


@query("op2_url_filter", r"""
    WITH parts AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
    ruled AS (
        SELECT page_id, host, path, CASE
            WHEN concat('.', host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN concat('.', host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN concat('.', host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN concat('.', host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM split)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op3_licenses")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    spans = F.transform("found", lambda x: F.concat_ws(":", x["license"], x["variant"].cast("string"),
                                                       x["first"].cast("string"), (x["first"] + x["words"]).cast("string")))
    return found.select("doc_id", "n_words", F.size("found").cast("bigint").alias("n_found"),
                        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["license"]))), ",").alias("licenses"),
                        F.array_join(spans, ",").alias("spans"))


@query("op4_decontaminate", rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_LETTER_WORD}') AS w FROM documents),
    b AS (SELECT item_id, w, least(13, len(w)) AS k FROM (
        SELECT item_id, regexp_extract_all({_LOWER}, '{_LETTER_WORD}') AS w FROM benchmark) t WHERE len(w) > 0),
    grams AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
              FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM b) t),
    windows AS (SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM (
        SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM b) s) t),
    hits AS (SELECT doc_id, i, k, item_id FROM windows JOIN grams USING (k, g)),
    words AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) t GROUP BY 1),
    items AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (
        SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) t GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
           sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judged(decontaminate.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated")


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_quality_rules", rf"""
    WITH d AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, COALESCE(source, '') AS host, COALESCE(text, '') AS text,
                      list_filter(regexp_split_to_array(COALESCE(text, ''), '{_BLANK}+'), lambda x: x <> '') AS w FROM documents),
    windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (
        SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d) t),
    often AS (SELECT r, i FROM windows QUALIFY COUNT(*) OVER (PARTITION BY r, g) > 1),
    repeats AS (SELECT r, COUNT(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM often) t GROUP BY 1),
    lines AS (SELECT r, doc_id, host, list_filter(regexp_split_to_array({_LOWER}, '{_BLANK}+'), lambda x: x <> '') AS l FROM (
        SELECT r, doc_id, host, unnest(string_split(text, chr(10))) AS text FROM d) t),
    normal AS (SELECT r, doc_id, host, array_to_string(l, ' ') AS line, len(l) AS n FROM lines WHERE len(l) > 0),
    common AS (SELECT host, line FROM normal GROUP BY host, line
               HAVING COUNT(DISTINCT COALESCE(CAST(doc_id AS VARCHAR), '')) > {quality_rules.MAX_DOCUMENTS}),
    removed AS (SELECT r, SUM(n) AS n FROM normal JOIN common USING (host, line) GROUP BY 1),
    base AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
                    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_NOT_BLANK}')) AS l,
                    COALESCE(repeats.n, 0) AS n_repeat_words, len(w) - COALESCE(removed.n, 0) AS n_left
             FROM d LEFT JOIN repeats USING (r) LEFT JOIN removed USING (r))
    SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, n_repeat_words,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
               AND n_left >= {quality_rules.LEAST_WORDS} AND n_left >= {quality_rules.LEAST_SHARE} * n_words AS kept,
           CAST(n_left AS BIGINT) AS n_left
    FROM base""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "n_left")


@query("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_dropped", "n_dropped_lines", F.sha2("text", 256).alias("text_sha256"))


@query("op8_quality_model")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train_quality(docs, table(spark, sf_dir, "labels"), grade(), 3)
    return quality_model.grade_documents(docs, model, least_tail=LEAST_TAIL)


@query("op9_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), with_ids=False)


@query("op10_katz")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(table(spark, sf_dir, "documents"))


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one in ten documents repeats what follows some word, by a checksum of its id."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    split = docs.select("doc_id", "text", h.alias("h")).withColumn("w", words)
    placed = split.withColumn("a", F.expr("(h div 10) % size(w)")).withColumn("p", F.expr("1 + (size(w) - a) div (3 + (h div 10) % 8)"))
    # both are null where nothing changes, also for texts without words
    again = F.expr("array_join(transform(w, (x, i) -> IF(i < a, x, get(w, int(a + (i - a) % p)))), ' ')")
    return placed.select("doc_id", F.when(F.col("p").isNotNull(), again).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs", rf"""
    WITH split AS (SELECT doc_id, COALESCE(CAST(doc_id AS VARCHAR), '') AS id, {_words_sql("COALESCE(text, '')")} AS w FROM documents),
    hashed AS (SELECT doc_id, w, len(w) AS n, {_crc32_sql("id")} AS h FROM split),
    placed AS (SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM hashed),
    d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM placed),
    words AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM d),
    same AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM words x JOIN words y USING (doc_id, word) WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    stretches AS (SELECT doc_id, q, MIN(i) AS start, COUNT(*) AS m FROM (
        SELECT *, i - ROW_NUMBER() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same) t GROUP BY doc_id, q, island),
    runs AS (SELECT doc_id, start, m + q AS length, MIN(q) AS period FROM stretches WHERE m >= 3 * q AND m + q >= 6 GROUP BY 1, 2, 3),
    told AS (SELECT doc_id, COUNT(*) AS n_runs, string_agg(concat_ws(',', start, length, period) || chr(10), '' ORDER BY start, period) AS listed
             FROM runs GROUP BY 1),
    best AS (SELECT * FROM runs QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
    SELECT d.doc_id, COALESCE(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
           sha256(COALESCE(listed, '')) AS runs_sha256, sha256(COALESCE(t, '')) AS collapsed_sha256
    FROM d LEFT JOIN told USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_periods(table(spark, sf_dir, "documents")))
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, x: F.when(
        x["length"] * b["period"] > b["length"] * x["period"], x).otherwise(b))
    told = F.array_join(F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(told, F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with planted faults, by a checksum of (conv_id, turn): one in twenty turns each is dropped, emptied, cut off,
    repeated or given to the user."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", cell("role").alias("role"), cell("text").alias("text"),
                        (F.crc32(F.concat(cell("conv_id"), F.lit(":"), cell("turn")).cast("binary")) % 20).alias("x"))
    text = F.when(F.col("x") == 1, "").when(F.col("x") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("x") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("x") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("x <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies)).drop("col")


#: SQL: best edits of the turns from the i-th on, by place in the grammar (0 begin, 1 after s, 2 user next, 3 assistant next).
@query("op12_conversation_repair", rf"""
    WITH RECURSIVE cells AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
                   concat(COALESCE(CAST(conv_id AS VARCHAR), ' '), ':', COALESCE(CAST(turn AS VARCHAR), ' ')) AS id FROM conversations),
    hashed AS (SELECT *, {_crc32_sql("id")} % 20 AS x FROM cells),
    hurt AS (SELECT conv_id, turn, CASE WHEN x = 4 THEN 'user' ELSE role END AS role,
                    CASE x WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                    unnest(range(CASE WHEN x = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE x <> 0),
    placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                      left(role, 1) AS c FROM hurt),
    judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '{_NOT_BLANK}') THEN 'blank'
                          WHEN ROW_NUMBER() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                          WHEN NOT regexp_matches(text, '[.!?]{_BLANK}*\z') THEN 'truncated' ELSE '' END AS fault,
                      lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
    counts AS (SELECT conv_id, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT_IF(fault = 'blank') AS blank,
                      COUNT_IF(fault = 'duplicate') AS duplicate, COUNT_IF(fault = 'truncated') AS truncated,
                      COUNT_IF(before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal, COUNT(*) AS n
               FROM judged GROUP BY 1),
    inserts(place, ins, lines, mid) AS (VALUES
        (0, '', []::VARCHAR[], 0), (0, 'I', ['user:'], 3), (0, 'II', ['user:', 'assistant:'], 2),
        (1, '', [], 1), (1, 'I', ['user:'], 3), (1, 'II', ['user:', 'assistant:'], 2),
        (2, '', [], 2), (2, 'I', ['user:'], 3), (3, '', [], 3), (3, 'I', ['assistant:'], 2)),
    letters(mid, letter, leave) AS (VALUES (0, '', 0), (1, '', 1), (2, '', 2), (3, '', 3),
        (0, 's', 1), (0, 'u', 3), (1, 'u', 3), (2, 'u', 3), (3, 'a', 2)),
    edits AS (SELECT * FROM inserts JOIN letters USING (mid)),
    rest AS (
        SELECT conv_id, n AS i, place, {{'cost': 3 * len(ins), 'audit': ins, 'lines': lines}} AS best
        FROM counts, (SELECT place, ins, lines FROM inserts WHERE mid IN (0, 2) QUALIFY ROW_NUMBER() OVER (PARTITION BY place ORDER BY len(ins)) = 1) t
        UNION ALL
        SELECT conv_id, i, place, MIN({{'cost': cost, 'audit': audit, 'lines': lines}}) FROM (
            SELECT j.conv_id, j.i - 1 AS i, e.place,
                   3 * len(ins) + best.cost + CASE WHEN letter = '' THEN 4 ELSE
                       CASE WHEN letter = c THEN 0 ELSE 3 END + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END END AS cost,
                   ins || CASE letter WHEN '' THEN 'D' WHEN c THEN 'K' ELSE 'R' END || best.audit AS audit,
                   list_concat(e.lines, CASE WHEN letter = '' THEN [] ELSE
                       [CASE letter WHEN c THEN role WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text] END, best.lines) AS lines
            FROM rest JOIN judged j ON j.conv_id IS NOT DISTINCT FROM rest.conv_id AND j.i = rest.i JOIN edits e ON e.leave = rest.place
            WHERE letter = '' OR fault NOT IN ('blank', 'duplicate') AND (letter = c OR letter <> 's')) t GROUP BY 1, 2, 3)
    SELECT ids.conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
           COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, CAST(COALESCE(best.cost, 0) AS BIGINT) AS cost,
           COALESCE(best.audit, '') AS audit, sha256(COALESCE(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) ids
    LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
    LEFT JOIN rest ON rest.conv_id IS NOT DISTINCT FROM ids.conv_id AND rest.i = 0 AND place = 0""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversation.repair_conversations(damaged(turns), turns)


@query("op13_jaccard_join", rf"""
    WITH RECURSIVE d AS (SELECT doc_id, {_words_sql(f"COALESCE({_LOWER}, '')")} AS w FROM documents),
    sets AS (SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
               ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
        FROM d WHERE len(w) > 0) t),
    sizes AS (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY 1),
    common AS (SELECT a.doc_id AS u, b.doc_id AS v, COUNT(*) AS n FROM sets a JOIN sets b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT u, v FROM common c JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v WHERE 100 * c.n >= 90 * (a.n + b.n - c.n)),
    reach(u, v) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v),
    least AS (SELECT u, MIN(v) AS component_id FROM reach GROUP BY 1)
    SELECT doc_id, COALESCE(n, 0) AS n_shingles, component_id FROM d LEFT JOIN sizes USING (doc_id) JOIN least ON u = doc_id""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents"))
