import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusflow.operators import inference as I
from corpusflow.plans import modeling
from corpusflow.sinks.tables import save_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SENTENCES = "First one. Second one! Third one? Fourth."


@pytest.fixture
def requests(spark):
    rows = [(i, f"Doc {i}. {SENTENCES}") for i in range(57)] + [(57, None), (58, "")]
    return spark.createDataFrame(rows, "i int, text string").repartition(3)


def load():
    return I.echo_with(I.extractive_generator(2))


def test_batch_size_does_not_change_answers(requests):
    answers = [
        sorted(
            modeling.predict(requests, load, "text", ["i"], {"batch_size": size}).collect(),
            key=repr,
        )
        for size in (1, 64)
    ]
    assert answers[0] == answers[1]
    by_id = {r.i: r for r in answers[0]}
    assert by_id[4].predicted_summary == "Doc 4. First one."
    assert by_id[58].predicted_summary == ""
    assert by_id[57].seq_no is None and by_id[57].predicted_summary is None  # no prompt


def test_batches_and_parameters_reach_the_generator(requests):
    def loaded():
        def generate(prompts, params):
            assert len(prompts) <= 4
            return [[f"[/INST]{params['temperature']}|{len(prompts)}"] for _ in prompts]

        return generate

    params = {"batch_size": 4, "temperature": 0.25}
    found = modeling.predict(requests, loaded, "text", ["i"], params)
    told = found.where("i <> 57").collect()
    assert {r.predicted_summary.split("|")[0] for r in told} == {"0.25"}


@pytest.fixture
def tiny_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "5")
    yield
    spark.conf.set(key, before)


def test_only_the_last_run_of_a_task_is_short(spark, tiny_batches):
    """Runs of 7 over batches of 5 rows, some without a prompt."""

    def counted():
        return lambda prompts, params: [[str(len(prompts))] for _ in prompts]

    df = spark.range(0, 100, 1, 2).selectExpr("id", "if(id % 10 = 3, null, string(id)) AS prompt")
    made = I.generate_batches(df, counted, {"batch_size": 7}, keep=["id"])
    answers = made.withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r.id for r in answers) == list(range(100))
    for task in (0, 1):
        runs = [r.sequences[0] for r in answers if r.task == task and r.sequences]
        assert runs == ["7"] * 42 + ["3"] * 3  # 45 prompts in order
    assert all((r.sequences is None) == (r.id % 10 == 3) for r in answers)


def test_a_worker_loads_once_a_job(spark, tmp_path):
    def counting():
        import os
        import uuid as u

        (tmp_path / f"{os.getpid()}-{u.uuid4().hex}").touch()
        return lambda prompts, params: [["x"] for _ in prompts]

    df = spark.range(0, 64, 1, 64).select(F.col("id").cast("string").alias("prompt"))
    assert I.generate_batches(df, counting, {"batch_size": 4}).count() == 64
    I.generate_batches(df, counting, {"batch_size": 4}).collect()
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    per_worker = {w: loads.count(w) for w in loads}
    assert len(loads) < 40  # 64 tasks a job
    assert max(per_worker.values()) <= 2  # one a job


def test_sequences_keep_their_row(requests):
    found = modeling.predict(
        requests.where("i < 2"), load, "text", ["i"], {"num_return_sequences": 3}
    ).collect()
    assert sorted((r.i, r.seq_no) for r in found) == [(i, s) for i in (0, 1) for s in range(3)]
    assert {len(r.predicted_summary.split(". ")) > r.seq_no for r in found} == {True}


def test_wrong_number_of_sequences(requests):
    def loaded():
        return lambda prompts, params: [["one"] for _ in prompts]

    with pytest.raises(Exception, match="2 sequences"):
        modeling.predict(requests, loaded, "text", ["i"], {"num_return_sequences": 2}).collect()


def test_missing_marker(requests):
    def loaded():
        return lambda prompts, params: [["no marker"] for _ in prompts]

    some = requests.where("i < 3")
    assert {r.predicted_summary for r in modeling.predict(some, loaded, "text").collect()} == {None}
    with pytest.raises(Exception, match="not found"):
        modeling.predict(some, loaded, "text", strict=True).collect()


def test_training_sets(spark, schema, tmp_path):
    rows = spark.createDataFrame(
        [("A", "S"), (None, "S"), ("A", None)], "gpt_summary string, summary string"
    )
    save_table(rows, f"{schema}.train_gpt_summary")
    texts = modeling.training_texts(spark, schema)
    assert set(texts) == {"train"}
    [row] = texts["train"].collect()
    assert row.text.endswith("\n        #ARTICLE:\n        A\n        [/INST]\nS")
    paths = modeling.export_training_sets(texts, str(tmp_path))
    assert spark.read.parquet(paths["train"]).collect() == [row]


def test_sampled_inputs(spark, schema):
    for name in ("train", "validation", "test"):
        save_table(spark.range(500).select(F.lit("x").alias("model_input"), "id"), f"{schema}.{name}")
    found = modeling.sampled_inputs(spark, schema)
    assert {n: df.columns for n, df in found.items()} == dict.fromkeys(found, ["model_input"])
    assert all(20 < df.count() < 90 for df in found.values())
