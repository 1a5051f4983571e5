"""Text measures, conversations and vector similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelyard.functions.text import ari_grade
from modelyard.operators.conversations import evaluate_responses, evaluation_means, exchanges, histories
from modelyard.operators.features import class_centers, cosine_to, hashed_term_weights, term_weights
from modelyard.queries import query, rounded, table

EXCHANGES = """x AS (SELECT a.conv_id, a.turn, a.text AS prompt, b.text AS response
    FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
    WHERE a.role = 'user' AND b.role = 'assistant')"""
ARI = """ari AS (SELECT id, text,
    len(list_filter(regexp_split_to_array(text, '[ \\t\\r\\n]+'), lambda w: regexp_matches(w, '[\\p{L}\\p{N}]'))) AS words,
    length(regexp_replace(text, '[ \\t\\r\\n]+', '', 'g')) AS chars,
    greatest(1, len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda s:
      len(list_filter(regexp_split_to_array(s, '[ \\t\\r\\n]+'), lambda w: regexp_matches(w, '[\\p{L}\\p{N}]'))) >= 3))) AS sentences
    FROM texts),
  graded AS (SELECT id, CASE WHEN words > 0 THEN 4.71::DOUBLE * chars / words + 0.5::DOUBLE * words / sentences - 21.43::DOUBLE END AS grade FROM ari)"""
ROUGE = """tok AS (SELECT conv_id, turn, 'r' AS side, regexp_extract_all(lower(response), '[a-z0-9]+') AS t FROM x
             UNION ALL SELECT conv_id, turn, 't', regexp_extract_all(lower(prompt), '[a-z0-9]+') FROM x),
    bg AS (SELECT conv_id, turn, side, concat(t[u.i], ' ', t[u.i + 1]) AS g, count(*) AS n
           FROM tok, unnest(range(1, len(t))) AS u(i) GROUP BY ALL),
    hits AS (SELECT r.conv_id, r.turn, sum(least(r.n, t.n)) AS n FROM bg r JOIN bg t
             ON t.conv_id = r.conv_id AND t.turn = r.turn AND t.g = r.g AND t.side = 't' WHERE r.side = 'r' GROUP BY 1, 2),
    size AS (SELECT conv_id, turn, sum(n) AS n FROM bg GROUP BY 1, 2),
    rouge AS (SELECT x.conv_id, x.turn, coalesce(2 * hits.n / size.n, 0) AS rouge2
              FROM x LEFT JOIN size USING (conv_id, turn) LEFT JOIN hits USING (conv_id, turn))"""


@query(
    "conversation_histories",
    "Q1",
    """SELECT conv_id, turn // 64 AS segment,
              string_agg(concat(turn, '|', role, '|', text), chr(10) ORDER BY turn) AS history, count(*)::INTEGER AS n_turns
       FROM conversations GROUP BY 1, 2""",
)
def conversation_histories(spark, folder):
    lines = F.transform(
        "history", lambda m: F.concat_ws("|", m["turn"].cast("string"), m["role"], m["content"])
    )
    return histories(table(spark, folder, "conversations")).withColumn("history", F.array_join(lines, "\n"))


@query("exchanges", "Q1 J4", f"WITH {EXCHANGES} SELECT * FROM x")
def exchanges_(spark, folder):
    return exchanges(table(spark, folder, "conversations"))


@query(
    "prompt_starts",
    "F5",
    "SELECT conv_id, turn, substring(text, 1, 50) AS shown, text FROM conversations WHERE role = 'user'",
)
def prompt_starts(spark, folder):
    prompts = table(spark, folder, "conversations").filter("role = 'user'")
    return prompts.select("conv_id", "turn", F.substring("text", 1, 50).alias("shown"), "text")


@query("rouge2_scores", "X1", f"WITH {EXCHANGES}, {ROUGE} SELECT conv_id, turn, round(rouge2, 6) AS rouge2 FROM rouge")
def rouge2_scores(spark, folder):
    scored = evaluate_responses(exchanges(table(spark, folder, "conversations")), "response", "prompt")
    return rounded(scored.select("conv_id", "turn", "rouge2"))


@query(
    "reading_grades",
    "X2",
    f"WITH texts AS (SELECT doc_id AS id, text FROM documents), {ARI} SELECT id AS doc_id, grade AS ari_grade FROM graded",
)
def reading_grades(spark, folder):
    return table(spark, folder, "documents").select("doc_id", ari_grade(F.col("text")).alias("ari_grade"))


@query(
    "toxicity_rate",
    "X3 A22",
    "SELECT lang, count(*) AS n, round(avg(toxic), 6) AS toxic_mean FROM documents JOIN labels USING (doc_id) GROUP BY lang",
)
def toxicity_rate(spark, folder):
    labelled = table(spark, folder, "documents").select("doc_id", "lang").join(table(spark, folder, "labels"), "doc_id")
    return rounded(evaluation_means(labelled, ["lang"], ["toxic"]))


@query(
    "evaluation_means",
    "A22 X1 X2 X4",
    f"""WITH {EXCHANGES}, {ROUGE}, texts AS (SELECT conv_id * 1000000 + turn AS id, response AS text FROM x), {ARI}
        SELECT conv_id, count(*) AS n, round(avg(rouge2), 6) AS rouge2_mean, round(avg(grade), 6) AS ari_grade_mean
        FROM rouge JOIN graded ON id = conv_id * 1000000 + turn GROUP BY conv_id""",
)
def evaluation_means_(spark, folder):
    scored = evaluate_responses(exchanges(table(spark, folder, "conversations")), "response", "prompt")
    means = evaluation_means(scored, ["conv_id"], ["rouge2", "ari_grade"])
    return means.select(
        "conv_id", "n", F.round("rouge2_mean", 6).alias("rouge2_mean"), F.round("ari_grade_mean", 6).alias("ari_grade_mean")
    )


@query(
    "cosine_to_class_center",
    "X5",
    """WITH d AS (SELECT vec_id, label, u.i, embedding[u.i]::DOUBLE AS x FROM embeddings, unnest(range(1, 65)) AS u(i)),
            c AS (SELECT label, i, avg(x) AS c FROM d GROUP BY 1, 2)
       SELECT vec_id, label, round(sum(x * c) / (sqrt(sum(x * x)) * sqrt(sum(c * c))), 6) AS cosine
       FROM d JOIN c USING (label, i) GROUP BY vec_id, label""",
)
def cosine_to_class_center(spark, folder):
    vectors = table(spark, folder, "embeddings")
    centers = class_centers(vectors, "embedding", "label")
    return rounded(cosine_to(vectors, "embedding", centers, "label").select("vec_id", "label", "cosine"))


@query(
    "document_term_weights",
    "X5",
    """WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents),
            c AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY 1, 2),
            f AS (SELECT term, count(*) AS found FROM c GROUP BY 1),
            w AS (SELECT doc_id, term, n * (ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + found)) + 1) AS weight FROM c JOIN f USING (term))
       SELECT doc_id, term, round(weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""",
)
def document_term_weights(spark, folder):
    return rounded(term_weights(table(spark, folder, "documents"), "doc_id", "text"))


@query("hashed_term_weights", "X5")
def hashed_term_weights_(spark, folder):
    return hashed_term_weights(table(spark, folder, "documents"), "text").select("doc_id", "tfidf")
