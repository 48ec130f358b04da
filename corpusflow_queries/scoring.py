"""ROUGE and BERTScore."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.text import leading_sentences
from corpusflow.operators import rouge as R
from corpusflow.operators.bert_score import bert_score
from corpusflow_queries import inputs as I
from corpusflow_queries.registry import query


def _tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z0-9]+')"


def _grams(x: str, n: int) -> str:
    tokens = _tokens(x)
    if n == 1:
        return tokens
    return f"list_transform(range(1, len({tokens})), lambda i: array_to_string(list_slice({tokens}, i, i + 1), ' '))"


def _scores_sql(hits: str, n_pred: str, n_ref: str) -> str:
    p = f"CASE WHEN {n_pred} > 0 THEN {hits} / {n_pred}::DOUBLE ELSE 0.0 END"
    r = f"CASE WHEN {n_ref} > 0 THEN {hits} / {n_ref}::DOUBLE ELSE 0.0 END"
    return f"""{p} AS p, {r} AS r, CASE WHEN {hits} > 0
        THEN 2 * ({p}) * ({r}) / (({p}) + ({r})) ELSE 0.0 END AS f"""


def _rouge_n_sql(source: str, keys: str, n: int) -> str:
    """Per pair: overlap of grams counted on each side."""
    return f"""
    SELECT {keys}, {_scores_sql("hits", "n_pred", "n_ref")} FROM (
      SELECT {keys}, coalesce(sum(least(cp, cr)), 0) AS hits, coalesce(sum(cp), 0) AS n_pred,
             coalesce(sum(cr), 0) AS n_ref
      FROM (SELECT {keys}, g, sum(ip) AS cp, sum(ir) AS cr FROM (
              SELECT {keys}, unnest({_grams("prediction", n)}) AS g, 1 AS ip, 0 AS ir FROM ({source})
              UNION ALL
              SELECT {keys}, unnest({_grams("reference", n)}), 0, 1 FROM ({source})
              UNION ALL SELECT {keys}, NULL, 0, 0 FROM ({source}))
            GROUP BY {keys}, g)
      GROUP BY {keys})"""


def _rounded(metric: str, part: str) -> Column:
    return F.round(f"{metric}.{part}", 6).alias(part)


def _per_pair(scored: DataFrame, metric: str) -> DataFrame:
    parts = [_rounded(metric, p) for p in ("precision", "recall", "f1")]
    return scored.select("conv_id", "turn", *parts)


def _per_pair_sql(inner: str) -> str:
    return f"""SELECT conv_id, turn, round(p, 6) AS precision, round(r, 6) AS recall,
        round(f, 6) AS f1 FROM ({inner})"""


@query("rouge_1", _per_pair_sql(_rouge_n_sql(I.PAIRS, "conv_id, turn", 1)))
def rouge_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_pair(R.rouge_n(I.pairs(spark, sf_dir), n=1), "rouge1")


@query("rouge_2", _per_pair_sql(_rouge_n_sql(I.PAIRS, "conv_id, turn", 2)))
def rouge_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_pair(R.rouge_n(I.pairs(spark, sf_dir), n=2), "rouge2")


# One row of the common-subsequence table per step; the running maximum closes the row.
_ROUGE_L_SQL = f"""
WITH RECURSIVE t AS (SELECT conv_id, turn, {_tokens("prediction")} AS a,
                            {_tokens("reference")} AS b FROM ({I.PAIRS})),
dp AS (
  SELECT conv_id, turn, a, b, 0 AS i, list_transform(range(len(b) + 1), lambda x: 0::BIGINT) AS cells
  FROM t
  UNION ALL
  SELECT conv_id, turn, a, b, i + 1,
         list_transform(cand, lambda x, k: list_max(list_slice(cand, 1, k)))
  FROM (SELECT *, list_transform(cells, lambda x, k: CASE WHEN k > 1 AND b[k - 1] = a[i + 1]
               THEN cells[k - 1] + 1 ELSE x END) AS cand
        FROM dp WHERE i < len(a))
)
SELECT conv_id, turn, {_scores_sql("cells[-1]", "len(a)", "len(b)")} FROM dp WHERE i = len(a)
"""


@query("rouge_l", _per_pair_sql(_ROUGE_L_SQL))
def rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_pair(R.rouge_l(I.pairs(spark, sf_dir)), "rougeL")


# The same table for every two lines, walked back from its end; then per pair the tokens of
# the reference that any walk meets, as far as the prediction holds them.
_ROUGE_LSUM_SQL = f"""
WITH RECURSIVE texts AS ({I.PAIRS}),
ref_lines AS (SELECT conv_id, turn, unnest(l) AS line, unnest(range(len(l))) AS ref_no
              FROM (SELECT *, string_split(reference, chr(10)) AS l FROM texts)),
cand_lines AS (SELECT conv_id, turn, unnest(l) AS line, unnest(range(len(l))) AS cand_no
               FROM (SELECT *, string_split(prediction, chr(10)) AS l FROM texts)),
two AS (SELECT conv_id, turn, ref_no, cand_no, {_tokens("x.line")} AS a, {_tokens("y.line")} AS b
        FROM ref_lines x JOIN cand_lines y USING (conv_id, turn)),
dp AS (
  SELECT conv_id, turn, ref_no, cand_no, a, b, 0 AS i,
         [list_transform(range(len(b) + 1), lambda x: 0::BIGINT)] AS rows FROM two
  UNION ALL
  SELECT conv_id, turn, ref_no, cand_no, a, b, i + 1,
         list_append(rows, list_transform(cand, lambda x, k: list_max(list_slice(cand, 1, k))))
  FROM (SELECT *, list_transform(rows[-1], lambda x, k: CASE WHEN k > 1 AND b[k - 1] = a[i + 1]
               THEN rows[-1][k - 1] + 1 ELSE x END) AS cand FROM dp WHERE i < len(a))
),
walk AS (
  SELECT conv_id, turn, ref_no, cand_no, a, b, rows, len(a) AS i, len(b) AS j, NULL::BIGINT AS met
  FROM dp WHERE i = len(a)
  UNION ALL
  SELECT conv_id, turn, ref_no, cand_no, a, b, rows,
         CASE WHEN a[i] = b[j] OR rows[i + 1][j] <= rows[i][j + 1] THEN i - 1 ELSE i END,
         CASE WHEN a[i] = b[j] OR rows[i + 1][j] > rows[i][j + 1] THEN j - 1 ELSE j END,
         CASE WHEN a[i] = b[j] THEN i END
  FROM walk WHERE i > 0 AND j > 0
),
covered AS (SELECT conv_id, turn, token, count(*) AS n FROM (
              SELECT DISTINCT conv_id, turn, ref_no, met, a[met] AS token
              FROM walk WHERE met IS NOT NULL)
            GROUP BY ALL),
held AS (SELECT conv_id, turn, token, count(*) AS n FROM (
           SELECT conv_id, turn, unnest({_tokens("prediction")}) AS token FROM texts)
         GROUP BY ALL),
found AS (SELECT conv_id, turn, sum(least(c.n, h.n)) AS hits
          FROM covered c JOIN held h USING (conv_id, turn, token) GROUP BY ALL)
SELECT conv_id, turn, {_scores_sql("hits", "n_pred", "n_ref")} FROM (
  SELECT conv_id, turn, coalesce(hits, 0) AS hits, len({_tokens("prediction")}) AS n_pred,
         len({_tokens("reference")}) AS n_ref
  FROM texts LEFT JOIN found USING (conv_id, turn))
"""


@query("rouge_lsum", _per_pair_sql(_ROUGE_LSUM_SQL))
def rouge_lsum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_pair(R.rouge_lsum(I.pairs(spark, sf_dir)), "rougeLsum")


@query(
    "rouge_corpus",
    f"""SELECT a.n_pairs, a.rouge1, b.rouge2 FROM
        (SELECT count(*) AS n_pairs, round(avg(f), 6) AS rouge1
         FROM ({_rouge_n_sql(I.PAIRS, "conv_id, turn", 1)})) a,
        (SELECT round(avg(f), 6) AS rouge2
         FROM ({_rouge_n_sql(I.PAIRS, "conv_id, turn", 2)})) b""",
)
def rouge_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ("rouge1", "rouge2")
    means = R.rouge_corpus(R.rouge(I.pairs(spark, sf_dir), metrics=metrics), metrics)
    return means.select("n_pairs", *[F.round(m, 6).alias(m) for m in metrics])


# The four metrics as a corpus score, each the mean of its pairs.
_ALL_METRICS = {
    "rouge1": _rouge_n_sql(I.PAIRS, "conv_id, turn", 1),
    "rouge2": _rouge_n_sql(I.PAIRS, "conv_id, turn", 2),
    "rougeL": _ROUGE_L_SQL,
    "rougeLsum": _ROUGE_LSUM_SQL,
}


@query(
    "rouge_corpus_all",
    " UNION ALL ".join(
        f"SELECT '{m}' AS metric, count(*) AS n_pairs, round(avg(f), 6) AS f1 FROM ({sql})"
        for m, sql in _ALL_METRICS.items()
    ),
)
def rouge_corpus_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = R.rouge_corpus(R.rouge(I.pairs(spark, sf_dir)))
    long = means.unpivot(["n_pairs"], list(R.METRICS), "metric", "f1")
    return long.select("metric", "n_pairs", F.round("f1", 6).alias("f1"))


_RESAMPLES = 200
# The draw of a pair in a resample: eight hexadecimal digits of a digest, against the edges.
_DRAW = f"""
SELECT conv_id, turn, r, len(list_filter({R.poisson_edges()}::BIGINT[], lambda e: e <= u)) AS times FROM (
  SELECT conv_id, turn, r, ('0x' || substr(md5('0' || chr(31) || (r // 4)::VARCHAR || chr(31)
         || conv_id::VARCHAR || chr(31) || turn::VARCHAR), 8 * (r % 4)::INT + 1, 8))::BIGINT AS u
  FROM ({I.PAIRS}), (SELECT unnest(range({_RESAMPLES})) AS r))
"""


def _bootstrap_sql(metric: str) -> str:
    return f"""
    SELECT '{metric}' AS metric, round(quantile_cont(f1, 0.025), 6) AS low,
           round(quantile_cont(f1, 0.5), 6) AS mid, round(quantile_cont(f1, 0.975), 6) AS high
    FROM (SELECT d.r, sum(times * f) / sum(times) AS f1
          FROM ({_DRAW}) d JOIN ({_ALL_METRICS[metric]}) s USING (conv_id, turn) GROUP BY d.r)"""


@query("rouge_bootstrap", " UNION ALL ".join(map(_bootstrap_sql, ("rouge1", "rouge2"))))
def rouge_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ("rouge1", "rouge2")
    scored = R.rouge(I.pairs(spark, sf_dir), metrics=metrics)
    drawn = R.rouge_bootstrap(scored, ["conv_id", "turn"], metrics, resamples=_RESAMPLES)
    return drawn.select("metric", *[F.round(c, 6).alias(c) for c in ("low", "mid", "high")])


def _run_sql(n: int) -> str:
    return f"""SELECT 'first_{n}' AS run, conv_id, turn, reference,
        {I.sql_leading("prediction", n)} AS prediction FROM ({I.PAIRS})"""


_RUNS = f"{_run_sql(1)} UNION ALL {_run_sql(3)}"


@query(
    "compare_runs",
    f"""SELECT a.run, a.n_pairs, a.rouge1, b.rouge2 FROM
        (SELECT run, count(*) AS n_pairs, round(avg(f), 6) AS rouge1
         FROM ({_rouge_n_sql(_RUNS, "run, conv_id, turn", 1)}) GROUP BY run) a JOIN
        (SELECT run, round(avg(f), 6) AS rouge2
         FROM ({_rouge_n_sql(_RUNS, "run, conv_id, turn", 2)}) GROUP BY run) b USING (run)""",
)
def compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first sentence against the first three sentences of each answer."""
    pairs = I.pairs(spark, sf_dir)
    runs = {
        f"first_{n}": pairs.withColumn("prediction", leading_sentences("prediction", n))
        for n in (1, 3)
    }
    metrics = ("rouge1", "rouge2")
    table = R.compare_runs(runs, metrics=metrics)
    return table.select("run", "n_pairs", *[F.round(m, 6).alias(m) for m in metrics])


_VECTORS = """SELECT vec_id // 20 AS pair_id, vec_id % 20 < 10 AS is_pred, vec_id % 10 AS pos,
 embedding::DOUBLE[] AS vec FROM embeddings"""


@query(
    "bert_score",
    f"""WITH v AS ({_VECTORS}), best AS (
          SELECT x.pair_id, x.is_pred, x.pos, max(list_cosine_similarity(x.vec, y.vec)) AS best
          FROM v x JOIN v y ON y.pair_id = x.pair_id AND y.is_pred <> x.is_pred
          GROUP BY x.pair_id, x.is_pred, x.pos),
        m AS (SELECT pair_id, avg(best) FILTER (is_pred) AS p,
                     avg(best) FILTER (NOT is_pred) AS r FROM best GROUP BY pair_id)
        SELECT pair_id, round(p, 6) AS precision, round(r, 6) AS recall,
               round(2 * p * r / (p + r), 6) AS f1 FROM m""",
)
def bert_score_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 20 vectors as pairs: the first half is the prediction."""
    vec_id = F.col("vec_id")
    tokens = I.table(spark, sf_dir, "embeddings").select(
        F.floor(vec_id / 20).alias("pair_id"),
        F.when(vec_id % 20 < 10, "pred").otherwise("ref").alias("side"),
        (vec_id % 10).alias("pos"),
        F.col("embedding").alias("vec"),
    )
    scores = bert_score(tokens)
    return scores.select(
        "pair_id", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    )
