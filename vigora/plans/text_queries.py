"""Documents as a corpus: cleaning, search, duplicates, audits, comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigora.functions import text as tx
from vigora.operators import quality, search
from vigora.plans.catalog import query
from vigora.sources.readers import table

CLEAN = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
TOKENS = "regexp_extract_all(lower(text), '[a-z0-9]+')"


@query("doc_lookup", "SELECT doc_id, lang, source, text FROM documents WHERE doc_id = 42")
def doc_lookup(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("doc_id = 42").select("doc_id", "lang", "source", "text")


@query("doc_list_by_type", "SELECT doc_id, lang, n_chars FROM documents WHERE source = 'src3'")
def doc_list_by_type(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("source = 'src3'").select("doc_id", "lang", "n_chars").orderBy("doc_id")


@query("export_text", "SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN text ELSE coalesce(nullif(role, ''), text) END AS text FROM conversations")
def export_text(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("role") == "assistant", F.col("text")).otherwise(tx.first_given("role", "text")).alias("text"))


@query("text_clean_hash", f"SELECT doc_id, sha256({CLEAN}) AS text_sha256, length({CLEAN}) AS n FROM documents")
def text_clean_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.text_hash(tx.clean("text")).alias("text_sha256"), F.length(tx.clean("text")).cast("bigint").alias("n"))


@query("term_counts", f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS}) AS term FROM documents) GROUP BY doc_id, term")
def term_counts(spark, sf_dir):
    return search.term_counts(table(spark, sf_dir, "documents"), "doc_id", F.col("text"))


@query("token_estimate", f"SELECT doc_id, len({TOKENS}) AS token_count, greatest(1, length(text) // 4) AS token_estimate FROM documents")
def token_estimate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(tx.tokens("text")).cast("bigint").alias("token_count"), F.greatest(F.lit(1), F.floor(F.length("text") / 4)).cast("bigint").alias("token_estimate"))


def lexical_sql(words: list[str], phrase: str, k: int) -> str:
    tf = " + ".join(f"len(list_filter(t, lambda x: x = '{w}'))" for w in dict.fromkeys(words))
    bonus = " + ".join(f"(CASE WHEN contains(lower(source), '{w}') THEN 4 ELSE 0 END) + (CASE WHEN contains(CAST(doc_id AS VARCHAR), '{w}') THEN 2 ELSE 0 END)" for w in words)
    return f"""WITH s AS (SELECT doc_id, {tf} + {bonus} + (CASE WHEN contains(lower({CLEAN}), '{phrase}') THEN {max(6, 3 * len(words))} ELSE 0 END) + (CASE WHEN contains(lower(source), '{phrase}') THEN 8 ELSE 0 END) AS score FROM (SELECT *, {TOKENS} AS t FROM documents))
 SELECT doc_id, score::BIGINT AS score FROM s WHERE score > 0 ORDER BY score DESC, length(CAST(doc_id AS VARCHAR)), doc_id LIMIT {k}"""


@query("lexical_topk", lexical_sql(["the", "of", "src1"], "the of src1", 25))
def lexical_topk(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    score = search.lexical_score("the of src1", F.col("text"), F.col("source"), F.col("doc_id"))
    return search.top_k(docs, score, "doc_id", 25, F.length(F.col("doc_id").cast("string"))).select("doc_id", F.col("score").cast("bigint").alias("score"))


@query("snippet_window", f"""WITH c AS (SELECT doc_id, {CLEAN} AS t FROM documents), h AS (SELECT *, least(nullif(strpos(lower(t), 'from'), 0), nullif(strpos(lower(t), 'with'), 0)) AS hit FROM c),
 s AS (SELECT *, greatest(1, hit - 86) AS st FROM h)
 SELECT doc_id, CASE WHEN hit IS NULL THEN substr(t, 1, 260) ELSE (CASE WHEN st > 1 THEN '...' ELSE '' END) || trim(substr(t, st, 260)) || (CASE WHEN st + 259 < length(t) THEN '...' ELSE '' END) END AS snippet FROM s""")
def snippet_window(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.snippet("text", ["from", "with"]).alias("snippet"))


def chunk_sql(most: int, overlap: int) -> str:
    """Windows one after the other: the last blank of a window, from its reversed text, ends it where it lies past the middle."""
    end = f"CASE WHEN s + {most} >= length(t) THEN length(t) WHEN strpos(reverse(substr(t, s + 1, {most})), ' ') BETWEEN 1 AND {most} - {most // 2} - 1 THEN s + {most} - strpos(reverse(substr(t, s + 1, {most})), ' ') + 1 ELSE s + {most} END"
    return f"""WITH RECURSIVE c AS (SELECT doc_id, {CLEAN} AS t FROM documents), w(doc_id, t, i, s, e) AS (
  SELECT doc_id, t, 1, 0, {end} FROM (SELECT doc_id, t, 0 AS s FROM c WHERE t <> '')
  UNION ALL SELECT doc_id, t, i, s, {end} FROM (SELECT doc_id, t, i + 1 AS i, greatest(s + 1, e - {overlap}) AS s FROM w WHERE e < length(t)))
 SELECT doc_id || '#chunk-' || lpad(CAST(i AS VARCHAR), 4, '0') AS chunk_id, doc_id, i::INTEGER AS chunk_index, trim(substr(t, s + 1, e - s)) AS text, greatest(1, length(trim(substr(t, s + 1, e - s))) // 4)::INTEGER AS token_estimate FROM w"""


@query("chunk_text", chunk_sql(900, 120))
def chunk_text(spark, sf_dir):
    return search.chunked(table(spark, sf_dir, "documents"), "doc_id", "text", 900, 120)


@query("exact_duplicates", "SELECT sha256(text) AS h, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_duplicates(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(tx.text_hash("text").alias("h")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("quality_audit", r"""WITH p AS (SELECT doc_id, text, list_filter(list_transform(regexp_split_to_array(text, '\n+'), lambda x: trim(x)), lambda x: length(x) > 0) AS ps FROM documents),
 m AS (SELECT doc_id, len(ps)::INTEGER AS n_paragraphs, coalesce(list_max(list_transform(ps, lambda x: length(x))), 0)::INTEGER AS longest, len(list_filter(ps, lambda x: length(x) > 2000))::INTEGER AS n_long, len(regexp_extract_all(text, '[a-z]{3,}[A-Z][a-z]{2,}'))::INTEGER AS n_joined FROM p)
 SELECT *, n_long > 0 OR n_joined > 0 OR n_paragraphs = 0 AS flagged FROM m""")
def quality_audit(spark, sf_dir):
    return quality.audit(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("quality_totals", "SELECT source, lang, count(*) AS n FROM documents GROUP BY ROLLUP (source, lang)")
def quality_totals(spark, sf_dir):
    return quality.totals(table(spark, sf_dir, "documents"), "source", "lang")


@query("corpus_diff", """WITH b AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE doc_id % 10 <> 1), r AS (SELECT doc_id, sha256(CASE WHEN doc_id % 7 = 0 THEN text || ' amended' ELSE text END) AS h FROM documents WHERE doc_id % 10 <> 2)
 SELECT coalesce(b.doc_id, r.doc_id) AS doc_id, CASE WHEN b.h IS NULL THEN 'added' WHEN r.h IS NULL THEN 'removed' WHEN b.h = r.h THEN 'unchanged' ELSE 'modified' END AS status FROM b FULL JOIN r ON b.doc_id = r.doc_id""")
def corpus_diff(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    review = docs.where("doc_id % 10 <> 2").withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" amended"))).otherwise(F.col("text")))
    return quality.corpus_diff(docs.where("doc_id % 10 <> 1"), review, "doc_id", "text")


@query("clause_extract", r"""SELECT doc_id, array_to_string(list_transform(list_filter(string_split_regex(regexp_replace(text, '([.;])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: regexp_matches(x, '(?i)with|from')), lambda x: substr(trim(x), 1, 400))[1:5], '|') AS found FROM documents""")
def clause_extract(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(tx.clauses("text", ["with", "from"]), "|").alias("found"))


@query("best_candidate", "SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY length(text) DESC, doc_id) AS n FROM documents) WHERE n = 1")
def best_candidate(spark, sf_dir):
    return search.best_of(table(spark, sf_dir, "documents"), "source", F.desc(F.length("text")), F.col("doc_id")).select("source", "doc_id")


@query("resumable_scan", "SELECT doc_id FROM documents WHERE trim(coalesce(text, '')) <> '' AND doc_id NOT IN (SELECT doc_id FROM labels)")
def resumable_scan(spark, sf_dir):
    return search.remaining(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id")


@query("matched_vectors", "SELECT e.vec_id, d.n_chars FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id")
def matched_vectors(spark, sf_dir):
    docs, vectors = table(spark, sf_dir, "documents"), table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id")
    both = docs.select("doc_id", "n_chars").join(vectors.select("doc_id"), "doc_id", "left_semi")
    return search.matched(both, vectors.join(docs.select("doc_id"), "doc_id", "left_semi").select("doc_id"), "doc_id").select(F.col("doc_id").alias("vec_id"), "n_chars")


@query("search_records", f"SELECT doc_id, len({TOKENS}) AS token_count, len(list_distinct({TOKENS})) AS n_terms FROM documents")
def search_records(spark, sf_dir):
    made = search.records(table(spark, sf_dir, "documents"), "doc_id", F.col("text"))
    return made.select("doc_id", F.col("token_count").cast("bigint").alias("token_count"), F.size("term_counts").cast("bigint").alias("n_terms"))


@query("unified_diff")
def unified_diff(spark, sf_dir):
    from pyspark.sql import Window

    turns = table(spark, sf_dir, "conversations").withColumn("before", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    return turns.where("before IS NOT NULL").select("conv_id", "turn", tx.unified_diff()(F.col("before"), F.col("text")).alias("d")).select("conv_id", "turn", "d.*")


@query("label_quality", "SELECT d.source, count(*) AS n, sum(l.quality)::BIGINT AS good, sum(l.toxic)::BIGINT AS toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source")
def label_quality(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").groupBy("source").agg(F.count("*").alias("n"), F.sum("quality").alias("good"), F.sum("toxic").alias("toxic"))


@query("set_ops", "(SELECT n, 'both' AS side FROM (SELECT c_nationkey AS n FROM customer INTERSECT SELECT s_nationkey FROM supplier)) UNION ALL (SELECT n, 'customer' FROM (SELECT c_nationkey AS n FROM customer EXCEPT SELECT s_nationkey FROM supplier))")
def set_ops(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n"))
    return c.intersect(s).withColumn("side", F.lit("both")).unionByName(c.subtract(s).withColumn("side", F.lit("customer")))
