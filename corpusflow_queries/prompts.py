"""Training and inference prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import prompts as P
from corpusflow.operators.columns import add_constant
from corpusflow.operators.snippets import with_clean_article
from corpusflow_queries import inputs as I
from corpusflow_queries.registry import query


def _sql(*parts: str) -> str:
    """Concatenate SQL expressions; a part in backquotes is a literal."""
    quoted = [
        "'" + p[1:-1].replace("'", "''") + "'" if p.startswith("`") else p for p in parts
    ]
    return "(" + " || ".join(quoted) + ")"


_MODEL_INPUT = _sql(
    f"`<s>[INS] {P.GOLD_PROMPT}\nARTICLE:\n`", "c.article_clean",
    "`\nPlain Language Summary:[INST]\n`", "c.summary", "`</s>`",
)


@query(
    "model_input",
    f"SELECT c.doc_id, {_MODEL_INPUT} AS model_input FROM ({I.CLEAN}) c",
)
def model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = I.articles(spark, sf_dir).withColumn("summary", I.first_long_sentence("article"))
    clean = add_constant(with_clean_article(docs), "prompt", P.GOLD_PROMPT)
    return clean.select(
        "doc_id", P.model_input("prompt", "article_clean", "summary").alias("model_input")
    )


_BLOCK = _sql("`Input:\n`", "context", "`\n\n`")
_INSTRUCTION = _sql(
    f"`{P.INTRO}\n\n### Instruction:\n`", "p.reference", "`\n\n`",
    f"CASE WHEN context <> '' THEN {_BLOCK} ELSE '' END",
    "`### Response:\n`", "p.prediction", "`\n\n### End`",
)


@query(
    "instruction_prompt",
    f"""SELECT p.conv_id, p.turn, {_INSTRUCTION} AS text
        FROM ({I.PAIRS}) p LEFT JOIN ({I.CONTEXTS}) c ON c.conv_id = p.conv_id""",
)
def instruction_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.pairs(spark, sf_dir).join(I.contexts(spark, sf_dir), "conv_id", "left")
    text = P.instruction_prompt("reference", "prediction", "context")
    return rows.select("conv_id", "turn", text.alias("text"))


_SUMMARY = _sql(
    f"`\n### Instruction:\n{P.SUMMARY_INSTRUCTION}\n\nInput:\n`", "reference",
    "`\n\n### Response:\n`", "prediction", "`\n\n### End`",
)


@query("summary_prompt", f"SELECT conv_id, turn, {_SUMMARY} AS text FROM ({I.PAIRS})")
def summary_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = P.summary_prompt("reference", "prediction")
    return I.pairs(spark, sf_dir).select("conv_id", "turn", text.alias("text"))


_TAGGED = _sql(
    f"`<<SYS>>{P.CHAT_SYSTEM}<</SYS>>\n[INST]User: {P.CHAT_INSTRUCTION}\n\n<article>\n`",
    "reference", "`\n</article>[/INST]`",
)
_PLAIN = _sql(
    f"`{P.CHAT_SYSTEM}\n[INST]User: {P.CHAT_INSTRUCTION}\n#ARTICLE:\n`",
    "reference", "`\n[/INST]`",
)
_BATCH = _sql(
    f"`{P.BATCH_SYSTEM}\n[INST]User: {P.BATCH_INSTRUCTION}\n        #ARTICLE:\n        `",
    "reference", "`\n        [/INST]`",
)
_ANSWER = _sql("`\n`", "prediction")


@query(
    "chat_prompts",
    f"""SELECT conv_id, turn, {_TAGGED} || {_ANSWER} AS tagged, {_PLAIN} || {_ANSWER} AS plain,
        {_BATCH} || {_ANSWER} AS training FROM ({I.PAIRS})""",
)
def chat_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.pairs(spark, sf_dir).select(
        "conv_id",
        "turn",
        P.system_tag_chat_prompt("reference", "prediction").alias("tagged"),
        P.plain_chat_prompt("reference", "prediction").alias("plain"),
        P.training_prompt("reference", "prediction").alias("training"),
    )


_ASK_SUMMARY = _sql(
    f"`\n### Instruction:\n{P.SUMMARY_INSTRUCTION}\n\nInput:\n`", "reference",
    "`\n\n### Response: `",
)
_ASK = _sql(f"`{P.INTRO}\n### Instruction:\n`", "reference", "`\n\n### Response: `")


@query(
    "inference_prompts",
    f"""SELECT doc_id, {_TAGGED} AS tagged, {_PLAIN} AS plain, {_BATCH} AS batch,
        {_ASK_SUMMARY} AS summary, {_ASK} AS instruction
        FROM (SELECT doc_id, text AS reference FROM documents)""",
)
def inference_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.documents(spark, sf_dir).select(
        "doc_id",
        P.system_tag_inference_prompt("text").alias("tagged"),
        P.plain_inference_prompt("text").alias("plain"),
        P.inference_prompt("text").alias("batch"),
        P.summary_inference_prompt("text").alias("summary"),
        P.instruction_inference_prompt("text").alias("instruction"),
    )


_RAW = "CASE WHEN turn % 3 = 0 THEN text ELSE text || '[/INST] ' || text || '[/INST]' END"


@query(
    "extract_response",
    f"""SELECT conv_id, turn, CASE WHEN instr(raw, '[/INST]') > 0
        THEN substr(raw, instr(raw, '[/INST]') + 7) END AS response
        FROM (SELECT conv_id, turn, {_RAW} AS raw FROM conversations)""",
)
def extract_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two turns in three hold the marker twice, the rest not at all."""
    raw = I.table(spark, sf_dir, "conversations").withColumn("raw", F.expr(_RAW))
    return raw.select("conv_id", "turn", P.extract_response("raw").alias("response"))
