import pytest
from pyspark.sql import functions as F

from corpusflow.functions import prompts as P


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [("ART", "SUM", "CTX"), ("ART", "SUM", ""), ("ART", "SUM", None), (None, "SUM", "CTX"),
         ("ART", None, "CTX")],
        "a string, s string, c string",
    )


def out(rows, prompt):
    return [r.v for r in rows.select(prompt.alias("v")).collect()]


def test_instruction_prompt(rows):
    intro = (
        "Below is an instruction that describes a task. Write a response that "
        "appropriately completes the request."
    )
    with_input = (
        f"{intro}\n\n### Instruction:\nART\n\nInput:\nCTX\n\n### Response:\nSUM\n\n### End"
    )
    without = f"{intro}\n\n### Instruction:\nART\n\n### Response:\nSUM\n\n### End"
    found = out(rows, P.instruction_prompt("a", "s", "c"))
    assert found == [with_input, without, without, None, None]
    assert out(rows, P.instruction_inference_prompt("a"))[0] == (
        f"{intro}\n### Instruction:\nART\n\n### Response: "
    )


def test_summary_prompt(rows):
    head = (
        "\n### Instruction:\nWrite a plain language summary for the article provided\n\n"
        "Input:\nART\n\n### Response:"
    )
    found = out(rows, P.summary_prompt("a", "s"))
    assert found == [f"{head}\nSUM\n\n### End"] * 3 + [None, None]
    assert out(rows, P.summary_inference_prompt("a"))[0] == f"{head} "


def test_chat_prompts(rows):
    system = (
        "You create laymen summaries of highly technical articles created by the biomedical "
        "industry"
    )
    ask = "[INST]User: Create a plain language summary for this scientific article"
    tagged = f"<<SYS>>{system}<</SYS>>\n{ask}\n\n<article>\nART\n</article>[/INST]"
    plain = f"{system}\n{ask}\n#ARTICLE:\nART\n[/INST]"
    assert out(rows, P.system_tag_chat_prompt("a", "s"))[0] == f"{tagged}\nSUM"
    assert out(rows, P.plain_chat_prompt("a", "s"))[0] == f"{plain}\nSUM"
    assert out(rows, P.system_tag_inference_prompt("a"))[0] == tagged
    assert out(rows, P.plain_inference_prompt("a"))[0] == plain
    assert out(rows, P.plain_chat_prompt("a", "s"))[3:] == [None, None]


def test_batch_prompt_keeps_its_indent(rows):
    prompt = P.inference_prompt("a", F.lit("SYS"), F.lit("DO"))
    text = "SYS\n[INST]User: DO\n        #ARTICLE:\n        ART\n        [/INST]"
    assert out(rows, prompt)[0] == text
    assert out(rows, P.training_prompt("a", "s", F.lit("SYS"), F.lit("DO")))[0] == f"{text}\nSUM"
    assert out(rows, P.inference_prompt("a", F.lit("S"), F.lit("D"), indent=""))[0] == (
        "S\n[INST]User: D\n#ARTICLE:\nART\n[/INST]"
    )


def test_model_input(rows):
    expected = "<s>[INS] CTX\nARTICLE:\nART\nPlain Language Summary:[INST]\nSUM</s>"
    assert out(rows, P.model_input("c", "a", "s"))[0] == expected
    assert out(rows, P.model_input("c", "a", "s"))[2:] == [None] * 3


def test_extract_response(spark):
    df = spark.createDataFrame([("x[/INST] y[/INST]z",), ("none",), (None,)], "t string")
    found = [r.v for r in df.select(P.extract_response("t").alias("v")).collect()]
    assert found == [" y[/INST]z", None, None]
    strict = P.extract_response("t", strict=True)
    assert df.where("t is null").select(strict.alias("v")).first().v is None
    with pytest.raises(Exception, match="not found"):
        df.select(strict).collect()
