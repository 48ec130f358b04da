"""Training and inference prompts as native string expressions.

One null rule throughout: a null field gives a null prompt, never the word ``None``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prompt texts a model is trained on. They must match to the character.
GOLD_PROMPT = "Create a Plain Language Summary of the following article:"
INTRO = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request."
)
INSTRUCTION_KEY = "### Instruction:"
INPUT_KEY = "Input:"
RESPONSE_KEY = "### Response:"
END_KEY = "### End"
SUMMARY_INSTRUCTION = "Write a plain language summary for the article provided"
CHAT_SYSTEM = (
    "You create laymen summaries of highly technical articles "
    "created by the biomedical industry"
)
CHAT_INSTRUCTION = "Create a plain language summary for this scientific article"
BATCH_SYSTEM = (
    "You create laymen summaries of highly technical articles created by the biomedical "
    "industry. Your summary should cover most the following topics: Introduction or problem "
    "statement, experimental methods, results of experiments, discussions, recommended future "
    "work. The summary should have a max length of 600 tokens and should only use the "
    "information provided and no prior knowledge. Your output should be a summary with NO "
    "headers and NO bullet points, just a long text"
)
BATCH_INSTRUCTION = "Create a plain language summary for this scientific article provided"
BATCH_INDENT = " " * 8  # models saw the last three lines indented by this much
RESPONSE_MARKER = "[/INST]"


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _join(*parts: Column | str) -> Column:
    """Concatenate literals (plain strings) and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def model_input(
    prompt: Column | str, article: Column | str, summary: Column | str, eos_token: str = "</s>"
) -> Column:
    return _join(
        "<s>[INS] ", _c(prompt), "\nARTICLE:\n", _c(article),
        "\nPlain Language Summary:[INST]\n", _c(summary), eos_token,
    )


def instruction_prompt(
    instruction: Column | str, response: Column | str, context: Column | str
) -> Column:
    """Instruction blocks; the input block appears only for a non-empty context."""
    block = F.when(_c(context) != "", _join(f"{INPUT_KEY}\n", _c(context), "\n\n"))
    return _join(
        f"{INTRO}\n\n{INSTRUCTION_KEY}\n", _c(instruction), "\n\n",
        F.coalesce(block, F.lit("")),
        f"{RESPONSE_KEY}\n", _c(response), f"\n\n{END_KEY}",
    )


def summary_prompt(article: Column | str, summary: Column | str) -> Column:
    return _join(
        f"\n{INSTRUCTION_KEY}\n{SUMMARY_INSTRUCTION}\n\n{INPUT_KEY}\n", _c(article),
        f"\n\n{RESPONSE_KEY}\n", _c(summary), f"\n\n{END_KEY}",
    )


def system_tag_chat_prompt(
    article: Column | str, summary: Column | str, system: str = CHAT_SYSTEM
) -> Column:
    return _join(system_tag_inference_prompt(article, system), "\n", _c(summary))


def plain_chat_prompt(
    article: Column | str, summary: Column | str, system: str = CHAT_SYSTEM
) -> Column:
    return _join(plain_inference_prompt(article, system), "\n", _c(summary))


def training_prompt(
    article: Column | str,
    summary: Column | str,
    system: Column | None = None,
    instruction: Column | None = None,
) -> Column:
    return _join(inference_prompt(article, system, instruction), "\n", _c(summary))


def inference_prompt(
    article: Column | str,
    system: Column | None = None,
    instruction: Column | None = None,
    indent: str = BATCH_INDENT,
) -> Column:
    """The batched-prediction prompt; system text and instruction may differ per row."""
    system = F.lit(BATCH_SYSTEM) if system is None else system
    instruction = F.lit(BATCH_INSTRUCTION) if instruction is None else instruction
    return _join(
        system, "\n[INST]User: ", instruction,
        f"\n{indent}#ARTICLE:\n{indent}", _c(article), f"\n{indent}{RESPONSE_MARKER}",
    )


def system_tag_inference_prompt(article: Column | str, system: str = CHAT_SYSTEM) -> Column:
    return _join(
        f"<<SYS>>{system}<</SYS>>\n[INST]User: {CHAT_INSTRUCTION}\n\n<article>\n",
        _c(article), f"\n</article>{RESPONSE_MARKER}",
    )


def plain_inference_prompt(article: Column | str, system: str = CHAT_SYSTEM) -> Column:
    return _join(
        f"{system}\n[INST]User: {CHAT_INSTRUCTION}\n#ARTICLE:\n",
        _c(article), f"\n{RESPONSE_MARKER}",
    )


def summary_inference_prompt(article: Column | str) -> Column:
    return _join(
        f"\n{INSTRUCTION_KEY}\n{SUMMARY_INSTRUCTION}\n\n{INPUT_KEY}\n", _c(article),
        f"\n\n{RESPONSE_KEY} ",
    )


def instruction_inference_prompt(instruction: Column | str) -> Column:
    return _join(f"{INTRO}\n{INSTRUCTION_KEY}\n", _c(instruction), f"\n\n{RESPONSE_KEY} ")


def extract_response(
    c: Column | str, marker: str = RESPONSE_MARKER, strict: bool = False
) -> Column:
    """Text after the first marker, unstripped. Without a marker: null, or an error if strict."""
    text = _c(c)
    at = F.instr(text, marker)
    found = F.substr(text, at + F.lit(len(marker)))
    if not strict:
        return F.when(at > 0, found)
    return F.when(text.isNull() | (at > 0), found).otherwise(
        F.raise_error(F.lit(f"response marker {marker} not found"))
    )
