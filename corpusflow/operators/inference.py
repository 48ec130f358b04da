"""Batched generation over a table of prompts."""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Prompts and job parameters in, the sequences for each prompt out.
Generator = Callable[[Sequence[str], Mapping[str, Any]], list[list[str]]]


def generate_batches(
    df: DataFrame,
    load: Callable[[], Generator],
    params: Mapping[str, Any],
    prompt_col: str = "prompt",
    keep: Sequence[str] = (),
    output_col: str = "sequences",
) -> DataFrame:
    """Run a generator over the prompts in runs of ``params["batch_size"]``.

    ``load`` runs in the worker processes, so a model is not shipped with the plan. A process
    keeps the generator for the tasks of the job that it works on later, until another job's
    takes its place. Parameters hold for the whole job. Each row keeps its ``keep`` columns and
    gets an array with its ``num_return_sequences`` texts. Prompts that are null get a null array
    and no place in a run; runs go on over the batches in which rows reach the process, so only a
    task's last run is short.
    """
    size = int(params.get("batch_size", 1))
    n = int(params.get("num_return_sequences", 1))
    settings = dict(params)
    kept = list(keep)
    job = uuid.uuid4().hex

    def answered(rows: pd.DataFrame, generator: Generator) -> pd.DataFrame:
        answers: list[list[str] | None] = [None] * len(rows)
        prompts = rows[prompt_col].tolist()
        asked = [i for i, prompt in enumerate(prompts) if prompt is not None]
        for start in range(0, len(asked), size):
            places = asked[start : start + size]
            texts = generator([prompts[i] for i in places], settings)
            if len(texts) != len(places) or any(len(t) != n for t in texts):
                raise ValueError(f"the generator must give {n} sequences for each prompt")
            for place, sequences in zip(places, texts):
                answers[place] = list(sequences)
        out = rows[kept].copy()
        out[output_col] = pd.Series(answers, out.index, dtype=object)
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            generator = _held(job, load)
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            asked = rows[prompt_col].notna().to_numpy().nonzero()[0]
            full = len(asked) // size * size
            cut = asked[full] if full < len(asked) else len(rows)
            rest = rows.iloc[cut:].reset_index(drop=True)
            if cut:
                yield answered(rows.iloc[:cut].reset_index(drop=True), generator)
        if rest is not None and len(rest):
            yield answered(rest, _held(job, load))

    fields = [df.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField(output_col, T.ArrayType(T.StringType()))])
    columns = list(dict.fromkeys([*kept, prompt_col]))
    return df.select(*columns).mapInPandas(run, schema)


def _held(job: str, load: Callable[[], Generator]) -> Generator:
    """The job's generator in this process.

    Functions reach a worker anew with every task, so what outlives a task is kept by the
    interpreter itself. One generator at a time: models are large.
    """
    place = sys.__dict__.setdefault("_corpusflow_generator", {})
    if job not in place:
        place.clear()
        place[job] = load()
    return place[job]


def expand_sequences(
    df: DataFrame, sequences: str = "sequences", text: str = "prediction"
) -> DataFrame:
    """One row per generated sequence with its number; the link to the row is kept.

    A row without sequences (it had no prompt) stays as one row, number and text null.
    """
    others = [c for c in df.columns if c != sequences]
    return df.select(*others, F.posexplode_outer(sequences).alias("seq_no", text))


def extractive_generator(
    sentences: int = 3, start: str = "#ARTICLE:\n", end: str = "[/INST]"
) -> Generator:
    """A deterministic stand-in for a model: sequence ``i`` is the first ``sentences + i``
    sentences of the article between the two markers of a prompt.
    """
    breaks = re.compile(r"(?<=[.!?])\s+")

    def generate(prompts: Sequence[str], params: Mapping[str, Any]) -> list[list[str]]:
        n = int(params.get("num_return_sequences", 1))
        answers = []
        for prompt in prompts:
            article = prompt.partition(start)[2].rpartition(end)[0].strip()
            pieces = [p for p in breaks.split(article) if p]
            answers.append([" ".join(pieces[: sentences + i]) for i in range(n)])
        return answers

    return generate


def echo_with(answer: Generator) -> Generator:
    """Put each prompt before its answer, as causal models return them."""

    def generate(prompts: Sequence[str], params: Mapping[str, Any]) -> list[list[str]]:
        answers = answer(prompts, params)
        return [[prompt + text for text in texts] for prompt, texts in zip(prompts, answers)]

    return generate
