"""Retrieval and chat over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.operators import chat, neighbours, postings
from gondola.operators import vectors as op
from gondola.plans.inputs import r
from gondola.plans.registry import query

_COS = "round(CAST(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS DECIMAL(20,15)), 9)"


def _vectors(t):
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").alias("family"))


def _dense_sql(where: str, k: int, floor: float) -> str:
    return f"""SELECT query, id, CAST(score AS DOUBLE) AS score FROM (
  SELECT a.vec_id AS query, b.vec_id AS id, {_COS} AS score, row_number() OVER (PARTITION BY a.vec_id ORDER BY {_COS} DESC, b.vec_id) AS k
  FROM embeddings a, embeddings b WHERE {where} AND {_COS} >= {floor}) WHERE k <= {k}"""


@query("d72_dense_top_k", _dense_sql("b.label <> 3", 5, 0.1))
def dense_top_k(t):
    v = _vectors(t)
    return op.dense_top_k(v.filter("family <> 3"), v.withColumnRenamed("id", "query"), 5, 0.1)


@query("d101_similar_outside_family", _dense_sql("a.label <> b.label", 3, -1.0))
def similar_outside_family(t):
    v = _vectors(t)
    return op.dense_top_k(v, v.withColumnRenamed("id", "query"), 3, family=True)


@query("d72_indexed_top_k")
def indexed_top_k(t):
    """Every vector whose id 50 divides, against all vectors; as many probes as find 95 % of a sample's neighbours."""
    v = _vectors(t).drop("family")
    index = neighbours.build(v)
    return neighbours.search(index, v.filter("id % 50 = 0").withColumnRenamed("id", "query"), 10, neighbours.probes_for(index, 10))


@query("d101_certain_outside_family", _dense_sql("a.label <> b.label", 3, -1.0))
def certain_outside_family(t):
    v = _vectors(t)
    return neighbours.search(neighbours.build(v), v.withColumnRenamed("id", "query"), 3, 8, certain=True)


_TOK = "regexp_extract_all(lower(strip_accents(text)), '[\\p{L}\\p{N}_]+')"
def _bm25_sql(drop: float) -> str:
    return f"""q0 AS (SELECT item_id AS query, unnest({_TOK}) AS term FROM benchmark), q1 AS (SELECT query, term, count(*) AS qtf FROM q0 GROUP BY 1, 2),
dd AS (SELECT doc_id AS id, {_TOK} AS tk FROM documents), st AS (SELECT count(*) AS n, avg(len(tk)) AS mean FROM dd),
pt AS (SELECT id, len(tk) AS size, unnest(tk) AS term FROM dd), po AS (SELECT term, id, size, count(*) AS tf FROM pt WHERE term IN (SELECT term FROM q1) GROUP BY 1, 2, 3),
df AS (SELECT term, count(*) AS df FROM po GROUP BY 1),
qw AS (SELECT query, term, {r('qtf * ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))', 9)} AS w FROM q1 JOIN df USING (term), st),
qk AS (SELECT *, count(*) OVER (PARTITION BY query) AS m, row_number() OVER (PARTITION BY query ORDER BY w, term) AS k FROM qw),
sc AS (SELECT query, id, {r('sum(w * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * size / mean))))', 6)} AS score
       FROM po JOIN qk USING (term), st WHERE k > floor(m * {drop}) GROUP BY 1, 2),
bm AS (SELECT query, id, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS k FROM sc) WHERE k <= 10)"""


_BM25 = _bm25_sql(0.2)


def _bm25(t, k):
    docs = t.documents.select(F.col("doc_id").alias("id"), "text")
    return op.bm25_top_k(docs, t.benchmark.select(F.col("item_id").alias("query"), "text"), k, drop_ratio=0.2)


@query("d97_bm25_top_k", f"WITH {_BM25} SELECT * FROM bm")
def bm25_top_k(t):
    return _bm25(t, 10)


@query("d97_impact_blocks", f"WITH {_bm25_sql(0.0)} SELECT * FROM bm")
def impact_blocks(t):
    docs = t.documents.select(F.col("doc_id").alias("id"), "text")
    return postings.bm25_top_k(docs, t.benchmark.select(F.col("item_id").alias("query"), "text"), 10)


@query("d98_hybrid_top_k", f"""
WITH {_BM25}, de AS ({_dense_sql('a.vec_id IN (SELECT item_id FROM benchmark) AND b.vec_id IN (SELECT doc_id FROM documents)', 10, -1.0)}),
mx AS (SELECT query, id, {r('coalesce(bm.score, 0) * 0.2::DOUBLE + coalesce(de.score, 0) * 0.8::DOUBLE', 6)} AS score FROM bm FULL JOIN de USING (query, id))
SELECT query, id, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS k FROM mx) WHERE k <= 5""")
def hybrid_top_k(t):
    v = _vectors(t).drop("family")
    corpus = v.join(t.documents.select(F.col("doc_id").alias("id")), "id", "left_semi")
    asked = v.withColumnRenamed("id", "query").join(t.benchmark.select(F.col("item_id").alias("query")), "query", "left_semi")
    return op.fuse(_bm25(t, 10), op.dense_top_k(corpus, asked, 10), 5)


@query("d99_embedding_delta", """
WITH x AS (SELECT DISTINCT trim(text) AS text FROM documents WHERE trim(text) <> '')
SELECT text FROM x WHERE md5(text) NOT IN (SELECT md5(trim(text)) FROM documents WHERE doc_id % 3 = 0 AND doc_id % 5 <> 0)""")
def embedding_delta(t):
    done = t.documents.filter("doc_id % 3 = 0").select(
        "text", F.when(F.col("doc_id") % 5 == 0, "model-b").otherwise("model-a").alias("model"))
    return op.embedding_delta(t.documents.select("text"), done, "model-a")


@query("d100_attach_vectors", """
WITH p AS (SELECT doc_id AS id, text, length(text) <= 3000 AS small FROM documents WHERE doc_id % 30 > 9),
v AS (SELECT md5(trim(text)) AS k, first(embedding ORDER BY vec_id) AS embedding FROM documents JOIN embeddings ON vec_id = doc_id GROUP BY 1)
SELECT id, small AS ready, CASE WHEN small THEN round(CAST(embedding[1] AS DOUBLE), 6) END AS first FROM p LEFT JOIN v ON k = md5(trim(text)) WHERE NOT small OR k IS NOT NULL""")
def attach_vectors(t):
    products = t.documents.select(
        F.col("doc_id").alias("id"), "text", F.length("text").alias("letters"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("updated_on"))
    vectors = t.documents.join(t.embeddings, F.col("doc_id") == F.col("vec_id")).groupBy(op.text_key(F.col("text")).alias("k")).agg(
        F.min_by("text", "vec_id").alias("text"), F.min_by("embedding", "vec_id").alias("vector"))
    ready, large = op.attach_vectors(products, vectors.drop("k"), F.lit("2024-01-10").cast("date"), F.col("letters") <= 3000)
    out = ready.select("id", F.lit(True).alias("ready"), F.round(F.col("vector")[0].cast("double"), 6).alias("first"))
    return out.unionByName(large.select("id", F.lit(False).alias("ready"), F.lit(None).cast("double").alias("first")))


@query("d102_representative_phrase", f"""
WITH w AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS w FROM conversations),
c AS (SELECT conv_id, turn, w, count(*) AS n FROM w WHERE length(w) >= 2 AND w NOT IN ({', '.join(f"'{x}'" for x in op.STOP_WORDS)}) GROUP BY 1, 2, 3),
s AS (SELECT a.conv_id, a.turn, sum(a.n * b.n) AS score FROM c a JOIN c b ON a.conv_id = b.conv_id AND a.w = b.w AND a.turn <> b.turn GROUP BY 1, 2),
x AS (SELECT conv_id, turn, text, CAST(coalesce(score, 0) AS BIGINT) AS score FROM conversations LEFT JOIN s USING (conv_id, turn))
SELECT conv_id, turn, text, score FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, turn) AS k FROM x) WHERE k = 1""")
def representative_phrase(t):
    return op.representative_phrase(t.conversations, "conv_id", "turn", "text")


# --- chat ----------------------------------------------------------------------------------------

# A payload of the stand-in: an assistant turn is the response, the two turns before it the request.
# Turns meet on (conversation, turn number), so a long conversation is not gathered anywhere.
_PAYLOAD = """pay AS (
  SELECT a.conv_id * 1000 + a.turn AS request_id, CASE WHEN a.turn % 5 = 4 THEN 500 ELSE 200 END AS status_code, DATE '2024-01-01' + CAST(a.conv_id % 28 AS INTEGER) AS chat_date,
         p1.role AS r1, p1.text AS t1, p2.role AS r2, p2.text AS t2, a.text AS answer
  FROM conversations a JOIN conversations p1 ON p1.conv_id = a.conv_id AND p1.turn = a.turn - 1 LEFT JOIN conversations p2 ON p2.conv_id = a.conv_id AND p2.turn = a.turn - 2
  WHERE a.role = 'assistant')"""


def _payloads(t):
    c = t.conversations
    answer = c.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("answer"))
    before = [c.select("conv_id", (F.col("turn") + i).alias("turn"), F.struct("role", F.col("text").alias("content")).alias(f"m{i}")) for i in (1, 2)]
    rows = answer.join(before[0], ["conv_id", "turn"]).join(before[1], ["conv_id", "turn"], "left")
    return rows.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("conv_id") % 28).cast("int")).alias("chat_date"),
        F.when(F.col("turn") % 5 == 4, 500).otherwise(200).alias("status_code"),
        F.to_json(F.struct(F.array_compact(F.array("m2", "m1")).alias("messages"))).alias("request"),
        F.to_json(F.array(F.struct("answer"))).alias("response"))


_PAIRS = f"""{_PAYLOAD}, pairs AS (SELECT request_id, chat_date, CASE WHEN r1 = 'user' THEN t1 ELSE t2 END AS question, answer FROM pay
  WHERE status_code = 200 AND (r1 = 'user' OR r2 = 'user') AND NOT contains(answer, 'keiten') AND NOT contains(coalesce(t1, '') || coalesce(t2, ''), 'whou'))"""


def _qa(t):
    return chat.question_answers(_payloads(t), denied_request="whou", denied_response="keiten")


@query("d103_question_answers", f"WITH {_PAIRS} SELECT * FROM pairs")
def question_answers(t):
    return _qa(t)


@query("d104_fresh_questions", f"""
WITH {_PAIRS}, o AS (SELECT *, row_number() OVER (PARTITION BY question ORDER BY chat_date DESC, request_id DESC, answer) AS k FROM pairs)
SELECT request_id, chat_date, question, answer FROM o WHERE k = 1 AND chat_date > DATE '2024-01-08' AND answer NOT IN (SELECT text FROM conversations WHERE conv_id % 4 = 0)""")
def fresh_questions(t):
    rejected = t.conversations.filter("conv_id % 4 = 0").select(F.col("text").alias("answer"))
    return chat.fresh_questions(_qa(t), rejected, F.lit("2024-01-08").cast("date"))


_ESC = "replace(replace(replace(replace({c}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(9), '\\t')"


def _part(role: str, text: str) -> str:
    return f"""'{{"role":"' || {role} || '","parts":[{{"text":"' || {_ESC.format(c=text)} || '"}}]}}'"""


_LINES = f"""{_PAYLOAD}, ln AS (SELECT request_id, '{{"contents":[' || concat_ws(',',
    CASE WHEN r2 <> 'system' THEN {_part("CASE WHEN r2 = 'assistant' THEN 'model' ELSE r2 END", "t2")} END,
    CASE WHEN r1 <> 'system' THEN {_part("r1", "t1")} END, {_part("'model'", "answer")}) || ']}}' AS line
  FROM pay WHERE trim(answer) <> '' AND r1 = 'user' AND (r2 IS NULL OR r2 <> 'user'))"""


@query("d105_tuning_lines", f"""
WITH {_LINES}, h AS (SELECT request_id FROM ln ORDER BY md5('7:' || request_id), request_id LIMIT 25)
SELECT request_id, line, CASE WHEN request_id IN (FROM h) THEN 'validation' ELSE 'training' END AS part FROM ln""")
def tuning_lines(t):
    return chat.split_holdout(chat.tuning_lines(_payloads(t)), "request_id", 25, "7")


@query("d106_topics", f"""
WITH {_PAIRS}, z AS (SELECT request_id, answer, CASE WHEN request_id % 2 = 0 THEN substr(question, 1, 5) || ' > ' || question ELSE question END AS question FROM pairs)
SELECT request_id, CASE WHEN contains(question, '> ') THEN trim(split_part(question, '>', 1)) ELSE 'no_tag' END AS topic, contains(lower(answer), 'die') AS is_default FROM z""")
def topics(t):
    tagged = F.when(F.col("request_id") % 2 == 0, F.concat(F.substring("question", 1, 5), F.lit(" > "), F.col("question"))).otherwise(F.col("question"))
    return chat.topics(_qa(t).withColumn("question", tagged), "DIE").select("request_id", "topic", "is_default")


@query("d107_merge_payloads", f"""
WITH {_PAYLOAD}, st AS (SELECT * FROM pay WHERE request_id % 3 = 0)
SELECT request_id, status_code, 'stored' AS origin FROM st UNION ALL
SELECT request_id, status_code, 'file' FROM pay WHERE (request_id % 2 = 0 OR request_id % 3 <> 0) AND request_id NOT IN (SELECT request_id FROM st)""")
def merge_payloads(t):
    p = _payloads(t)
    stored = p.filter("request_id % 3 = 0").withColumn("origin", F.lit("stored"))
    files = p.filter("request_id % 2 = 0 OR request_id % 3 <> 0").withColumn("origin", F.lit("file"))
    out = chat.merge_payloads(stored, files.unionByName(files), ["request_id", "request", "response", "chat_date"])
    return out.select("request_id", "status_code", "origin")
