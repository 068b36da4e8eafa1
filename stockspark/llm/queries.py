"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockspark.llm import (
    contamination, fingerprints, grace, language, licences, mixing, neardup, pii, repeats, secrets, squares, toxicity, tries,
)
from stockspark.llm.common import fold_of, table


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    spans = F.array_sort(F.concat("__base", "__added"))
    return found.select(
        "doc_id",
        *[pii.number_of("__base", k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
        F.sha2(pii.text_of(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
        pii.text_of(spans).alias("spans"),
        F.size("__added").cast("long").alias("n_added"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.scan(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(language.training_rows(docs))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.size("__licences").cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct("__licences.licence")), ",").alias("licences"),
        F.coalesce(F.array_max("__licences.dice"), F.lit(0.0)).alias("dice"),
        F.array_join(F.transform("__licences", lambda x: F.concat_ws(":", x["licence"], x["s"].cast("string"), x["e"].cast("string"))), ",").alias("spans"),
    )


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove(table(spark, sf_dir, "documents").select("doc_id", "text"), digest_only=True)
    return found.withColumnRenamed("kept", "kept_sha256")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.find(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return found.select(
        "doc_id", "source", "lang", F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"),
        F.col("__weight").alias("weight"), F.col("__probability").alias("probability"), F.col("__sampled").alias("sampled"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sample = toxicity.labelled(docs, table(spark, sf_dir, "labels"), lambda doc_id: fold_of(doc_id, 4) != 2)
    found = toxicity.rate(docs, toxicity.learn(sample))
    return found.select(
        "doc_id", (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "n_random",
        F.sha2(secrets.spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(F.concat("base", "random")).alias("spans"),
    )


def op11_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", squares.planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = squares.find(docs, digest_only=True)
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = found.withColumn("best", F.array_max(order))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(squares.lines(F.col("runs")).cast("binary"), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.trie(*tries.rebuilt(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_personal_data": op1_personal_data,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_licence_scan": op4_licence_scan,
    "op5_repeated_passages": op5_repeated_passages,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_source_mixing": op8_source_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_secret_scan": op10_secret_scan,
    "op11_exact_duplicates": op11_exact_duplicates,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_trie": op13_conversation_trie,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DUCK_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {DUCK_WORDS} AS words FROM documents),
i AS (SELECT item_id, {DUCK_WORDS} AS words FROM benchmark),
w AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS size, array_to_string(words[p + 1 : p + least(10, len(words))], ' ') AS body
  FROM i, unnest(range(greatest(len(words) - 9, least(len(words), 1)))) AS u(p)
),
z AS (SELECT DISTINCT size FROM w),
o AS (
  SELECT doc_id, p, size, item_id
  FROM (SELECT doc_id, p, z.size, array_to_string(words[p + 1 : p + z.size], ' ') AS body
        FROM d, z, unnest(range(greatest(len(words) - z.size + 1, 0))) AS u(p)) AS c
  JOIN w USING (size, body)
),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM o) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP11_SQL = """
WITH n AS (SELECT doc_id, coalesce(text, '') AS body, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS plain FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(plain) AS text_sha256
FROM n WINDOW best AS (PARTITION BY plain ORDER BY length(body) DESC, doc_id)
"""

# The checksum of a number in decimal: eight shifts for each byte, marked by -1 in the list.
OP13_SQL = """
WITH turns AS (
  SELECT conv_id, list({'mark': md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))),
                        'chars': length(coalesce(text, ''))} ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
heads AS (
  SELECT conv_id, own, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END)) % 6 AS h
  FROM turns
),
convs AS (
  SELECT c.conv_id, list_concat(coalesce(b.own, [])[1 : c.h], c.own[c.h + 1 :]) AS path
  FROM heads AS c LEFT JOIN turns AS b ON b.conv_id = c.base
),
prefixes AS (
  SELECT conv_id, d AS depth, len(path) AS size, array_to_string(list_transform(path[1 : d], lambda t: t.mark), '') AS key,
         coalesce(path[d].chars, 0) AS chars, array_to_string(list_transform(path[1 : d - 1], lambda t: t.mark), '') AS parent
  FROM convs, unnest(range(len(path) + 1)) AS u(d)
),
nodes AS (
  SELECT depth, key, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = size), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, key
),
kids AS (SELECT depth - 1 AS depth, parent AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, key)),
below AS (
  SELECT p.depth, p.key, CAST(sum((u.n_convs - 1) * u.chars) AS BIGINT) AS saved_tokens,
         CAST(sum(CAST(u.n_children = 0 AS BIGINT)) AS BIGINT) AS n_leaves
  FROM counted AS u JOIN prefixes AS p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.depth, p.key
)
SELECT v.conv_id, v.depth, above.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM counted AS v JOIN below USING (depth, key) LEFT JOIN nodes AS above ON above.depth = v.depth - 1 AND above.key = v.parent
"""

SQL: dict[str, str] = {"op2_decontamination": OP2_SQL, "op11_exact_duplicates": OP11_SQL, "op13_conversation_trie": OP13_SQL}
