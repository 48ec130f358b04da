import io
import json
import zipfile
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.errors import KeyViolation
from corpusflow.plans import stages
from corpusflow.sinks import files, tables
from corpusflow.sources.files import _listed, _unpacked, read_archives, read_json_docs
from corpusflow.sources.tables import read_splits, read_tables

TS = datetime(2024, 5, 1, 12)


def rows(spark, name, *columns):
    return sorted(spark.table(name).select(*columns).collect(), key=repr)


def test_save_modes(spark, schema):
    name = f"{schema}.t"
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.save(df, name, ts=TS)
    tables.save(df, name, ts=TS)
    assert rows(spark, name, "k") == [(1,), (1,)]
    tables.save(df, name, mode="overwrite", partition_by="v", ts=TS)
    assert rows(spark, name, "k", "processing_ts") == [(1, TS)]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["v"]
    with pytest.raises(ValueError):
        tables.save(df, name, fmt="VOLUME")
    with pytest.raises(ValueError):
        tables.save(df, name, mode="upsert")


def test_processing_ts_is_one_moment(spark):
    stamped = tables.with_processing_ts(spark.range(100))
    assert stamped.select("processing_ts").distinct().count() == 1
    assert dict(stamped.dtypes)["processing_ts"] == "timestamp"


def test_save_makes_the_schema(spark):
    tables.save(spark.range(3), "made_on_the_way.t")
    assert tables.table_exists(spark, "made_on_the_way.t")


def test_overwrite_may_read_its_own_table(spark, schema):
    name = f"{schema}.t"
    tables.save_table(spark.range(5), name)
    for _ in range(2):
        tables.replace_table(spark.table(name).selectExpr("id + 1 AS id"), name)
    assert rows(spark, name, "id") == [(i,) for i in range(2, 7)]
    left_over = [t.name for t in spark.catalog.listTables(schema)]
    assert left_over == ["t"]


def test_failed_replacement_changes_nothing(spark, schema):
    name = f"{schema}.t"
    tables.save_table(spark.range(5), name)
    with pytest.raises(Exception, match="boom"):
        tables.replace_table(
            spark.table(name).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), name
        )
    assert spark.table(name).count() == 5
    assert [t.name for t in spark.catalog.listTables(schema)] == ["t"]


def test_append_after_replacement(spark, schema):
    name = f"{schema}.t"
    df = spark.range(4).selectExpr("id", "id % 2 AS p")
    tables.replace_table(df, name, partition_by="p")
    tables.replace_table(df, name, partition_by="p")
    tables.save_table(df, name, partition_by="p")
    assert spark.table(name).count() == 8


def test_upsert_creates_then_merges(spark, schema):
    name = f"{schema}.t"
    config = tables.UpsertConfig(["k"], ["processing_ts"])
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    second = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    later = datetime(2024, 6, 1)
    tables.save(first, name, mode="upsert", upsert_config=config, ts=TS)
    tables.save(second, name, mode="upsert", upsert_config=config, ts=later)
    assert rows(spark, name, "k", "v", "processing_ts") == [
        (1, "a", TS),
        (2, "B", TS),
        (3, "c", later),
    ]


def test_keyed_table(spark, schema):
    name = f"{schema}.t"
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.write_keyed_table(good, name, "k")
    tables.write_keyed_table(
        spark.createDataFrame([(2, None), (3, "c")], "k int, v string"), name, ["k"], "merge"
    )
    expected = [(1, "a"), (2, None), (3, "c")]
    assert rows(spark, name, "k", "v") == expected
    for bad in ([(1, "a"), (1, "b")], [(None, "a")], [(9, "x"), (9, "x")]):
        frame = spark.createDataFrame(bad, "k int, v string")
        with pytest.raises(KeyViolation):
            tables.write_keyed_table(frame, name, "k")
    with pytest.raises(KeyViolation):
        fresh = spark.createDataFrame([(9, "x"), (9, "x")], "k int, v string")
        tables.write_keyed_table(fresh, name, "k", "merge")
    assert rows(spark, name, "k", "v") == expected
    with pytest.raises(ValueError):
        tables.write_keyed_table(good, name, "k", "append")
    with pytest.raises(ValueError):
        tables.write_keyed_table(good, name, ())


def test_merge_schema(spark, schema):
    name = f"{schema}.t"
    tables.save_table(spark.createDataFrame([(1,)], "a int"), name)
    wider = spark.createDataFrame([(2, "x")], "a int, b string")
    tables.save_table(wider, name, merge_schema=True)
    assert rows(spark, name, "a", "b") == [(1, None), (2, "x")]


def files_of(spark, name, where="true"):
    spark.catalog.refreshTable(name)
    found = spark.table(name).where(where).select("_metadata.file_path").distinct().collect()
    return {r[0] for r in found}


def test_merge_schema_keeps_files_and_what_is_noted(spark, schema):
    name = f"{schema}.t"
    first = spark.createDataFrame([(1, "x"), (2, "y")], "a int, p string")
    tables.save_table(first, name, partition_by="p")
    spark.sql(f"COMMENT ON TABLE {name} IS 'it''s mine'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('steward' = 'me')")
    before = files_of(spark, name)
    wider = spark.createDataFrame([("x", 7, 3, [1.5])], "P string, b int, a long, c array<double>")
    tables.save_table(wider, name, merge_schema=True)
    tables.save_table(first.limit(1), name, merge_schema=True)
    assert before < files_of(spark, name)
    assert spark.table(name).columns == ["a", "b", "c", "p"]
    assert rows(spark, name, "a", "b", "c", "p") == [
        (1, None, None, "x"), (1, None, None, "x"), (2, None, None, "y"), (3, 7, [1.5], "x")
    ]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["p"]
    assert tables._details(spark, name)["Comment"] == "it's mine"
    assert tables._properties(spark, name)["steward"] == "me"


def keyed_parts(spark, name, n=40):
    df = spark.range(n).selectExpr("id AS k", "concat('v', id) AS v", "concat('p', id % 4) AS p")
    tables.write_keyed_table(df, name, "k", partition_by="p")
    return df


def test_keyed_merge_rewrites_touched_partitions_only(spark, schema):
    """Partitions are no keys: one row changes and stays in its partition."""
    name = f"{schema}.t"
    keyed_parts(spark, name)
    others = files_of(spark, name, "p <> 'p3'")
    tables.write_keyed_table(spark.createDataFrame([(7, "new", "p3")], "k long, v string, p string"), name, "k", "merge")
    assert files_of(spark, name, "p <> 'p3'") == others
    assert spark.table(name).where("k = 7").collect() == [(7, "new", "p3")]
    assert spark.table(name).count() == 40


def test_keyed_merge_moves_rows_between_partitions(spark, schema):
    name = f"{schema}.t"
    keyed_parts(spark, name)
    quiet = files_of(spark, name, "p IN ('p0', 'p2')")
    moved = spark.table(name).where("p = 'p1'").selectExpr("k", "v", "'p3' AS p")
    fresh = spark.createDataFrame([(100, "n", None)], "k long, v string, p string")
    tables.write_keyed_table(moved.unionByName(fresh), name, "k", "merge")
    assert files_of(spark, name, "p IN ('p0', 'p2')") == quiet
    counts = {r.p: r["count"] for r in spark.table(name).groupBy("p").count().collect()}
    assert counts == {"p0": 10, "p2": 10, "p3": 20, None: 1}  # nothing is left of p1
    assert spark.table(name).select("k").distinct().count() == 41
    back = spark.createDataFrame([(100, "n", "p0")], "k long, v string, p string")
    tables.write_keyed_table(back, name, "k", "merge")
    assert spark.table(name).where("p IS NULL").count() == 0


def test_merge_with_several_partition_columns_is_exact(spark, schema):
    name = f"{schema}.t"
    df = spark.range(80).selectExpr("id AS k", "0 AS v", "id % 2 AS p", "if(id % 4 < 2, null, id % 4) AS q")
    tables.save_table(df, name, partition_by=["p", "q"])
    before = files_of(spark, name)
    source = spark.createDataFrame([(2, 9, 0, 2), (1, 9, 1, None)], "k long, v int, p long, q long")
    tables.upsert_table(source, name, tables.UpsertConfig(["k"]))
    touched = "(p = 0 AND q = 2) OR (p = 1 AND q IS NULL)"
    kept = files_of(spark, name, f"NOT coalesce({touched}, false)")
    assert kept and kept <= before
    assert spark.table(name).where("v = 9").count() == 2
    assert spark.table(name).count() == 80


def test_failed_merge_changes_nothing(spark, schema):
    name = f"{schema}.t"
    keyed_parts(spark, name)
    before = files_of(spark, name)
    bad = spark.createDataFrame([(1, "x", "p1"), (1, "y", "p2")], "k long, v string, p string")
    with pytest.raises(KeyViolation):
        tables.write_keyed_table(bad, name, "k", "merge")
    with pytest.raises(Exception, match="several source rows"):
        tables.upsert_table(bad, name, tables.UpsertConfig(["k"]))
    assert files_of(spark, name) == before


def test_unchecked_rows_take_the_key_note_away(spark, schema):
    name = f"{schema}.t"
    df = keyed_parts(spark, name)
    assert tables._properties(spark, name)[tables._KEYS] == "k"
    one = spark.createDataFrame([(900, "x", "p1")], "k long, v string, p string")
    tables.write_keyed_table(one, name, "k", "merge")
    assert tables._properties(spark, name)[tables._KEYS] == "k"
    tables.save_table(df.limit(1), name, partition_by="p")
    assert tables._KEYS not in tables._properties(spark, name)
    with pytest.raises(KeyViolation):  # found in the table, not in the new rows
        tables.write_keyed_table(one, name, "k", "merge")


def test_compaction_leaves_good_partitions_alone(spark, schema):
    name = f"{schema}.t"
    df = spark.range(300).selectExpr("id", "id % 3 AS p")
    tables.save_table(df.repartition(1), name, partition_by="p")
    tables.save_table(df.where("p = 1").repartition(8), name, partition_by="p")
    spark.sql(f"COMMENT ON TABLE {name} IS 'kept'")
    before = files_of(spark, name, "p <> 1")
    assert {r.p: (r.n_files, r.n_small) for r in tables.file_sizes(spark, name).collect()} == {
        0: (1, 1), 1: (9, 9), 2: (1, 1)
    }
    tables.compact_table(spark, name)
    assert files_of(spark, name, "p <> 1") == before
    assert len(files_of(spark, name, "p = 1")) == 1
    assert tables._details(spark, name)["Comment"] == "kept"
    again = files_of(spark, name)
    tables.compact_table(spark, name)
    assert files_of(spark, name) == again
    assert spark.table(name).count() == 400


def test_compaction_keeps_comment_and_properties(spark, schema):
    name = f"{schema}.t"
    spark.sql(f"CREATE TABLE {name} (id bigint COMMENT 'the id') USING parquet COMMENT 'c' TBLPROPERTIES ('a.b' = '1')")
    spark.range(10).repartition(4).write.insertInto(name)
    tables.compact_table(spark, name)
    assert len(files_of(spark, name)) == 1
    details = tables._details(spark, name)
    assert details["Comment"] == "c" and tables._properties(spark, name)["a.b"] == "1"
    assert spark.catalog.listColumns(name)[0].description == "the id"


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_optimized_save_writes_once(spark, schema, mode, monkeypatch):
    name = f"{schema}.t"
    rewritten = []
    monkeypatch.setattr(tables, "compact_table", lambda *a: rewritten.append(a))
    tables.save(spark.range(100).repartition(12), name, mode=mode, optimize=True, ts=TS)
    assert len(files_of(spark, name)) == 1 and not rewritten
    tables.save(spark.range(100).repartition(12), name, mode="append", optimize=True, ts=TS)
    assert len(rewritten) == 1


@pytest.mark.parametrize("target", [None, 2])
def test_compaction(spark, schema, target):
    name = f"{schema}.t"
    tables.save_table(spark.range(1000).repartition(20), name)
    tables.compact_table(spark, name, target)
    assert len(spark.table(name).inputFiles()) <= (target or 8)
    assert spark.table(name).count() == 1000


def test_compaction_keeps_partitions(spark, schema):
    name = f"{schema}.t"
    df = spark.range(100).selectExpr("id", "id % 3 AS p").repartition(10)
    tables.save_table(df, name, partition_by="p")
    tables.compact_table(spark, name)
    assert len(spark.table(name).inputFiles()) == 3
    assert spark.table(name).where("p = 1").count() == 33


def test_read_tables(spark, schema):
    tables.save_table(spark.range(3), f"{schema}.train")
    assert set(read_tables(spark, schema, missing="skip")) == {"train"}
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        read_tables(spark, schema)
    with pytest.raises(ValueError):
        read_tables(spark, schema, missing="ignore")


def test_read_splits(spark, tmp_path):
    for name in ("train", "test"):
        spark.range(2).write.json(str(tmp_path / name))
    splits = read_splits(spark, str(tmp_path), ("train", "test"), "json")
    assert {k: v.count() for k, v in splits.items()} == {"train": 2, "test": 2}


def test_json_docs(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps({"id": i, "text": f"a\nb{i}"}, indent=2))
    found = read_json_docs(spark, str(tmp_path), "id long, text string")
    assert sorted(found.collect()) == [(i, f"a\nb{i}") for i in range(3)]


def test_archives(spark, tmp_path):
    for name in ("a.zip", "b.zip"):
        with zipfile.ZipFile(tmp_path / name, "w") as archive:
            archive.writestr("folder/", "")
            archive.writestr("folder/x.txt", f"x of {name}")
            archive.writestr("y.bin", bytes(range(256)) * 10)
    (tmp_path / "notes.txt").write_text("ignored")
    found = read_archives(spark, str(tmp_path)).collect()
    assert {(r.archive.rsplit("/", 1)[-1], r.member) for r in found} == {
        (a, m) for a in ("a.zip", "b.zip") for m in ("folder/x.txt", "y.bin")
    }
    assert {bytes(r.content) for r in found if r.member == "folder/x.txt"} == {
        b"x of a.zip",
        b"x of b.zip",
    }
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.zip", "b.zip", "notes.txt"]


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA])
def test_archive_methods(spark, tmp_path, method):
    texts = {f"d/{i}ü.txt": bytes(range(256)) * i for i in range(5)}
    with zipfile.ZipFile(tmp_path / "a.zip", "w", method) as archive:
        archive.comment = b"about"
        for name, content in texts.items():
            archive.writestr(name, content)
    found = read_archives(spark, str(tmp_path)).collect()
    assert {r.member: bytes(r.content) for r in found} == texts


def test_one_large_archive_is_unpacked_by_several_tasks(spark, tmp_path):
    import random

    r = random.Random(1)
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for i in range(40):
            archive.writestr(f"{i}.bin", r.randbytes(30_000))
    keys = ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")
    before = {k: spark.conf.get(f"spark.sql.adaptive.{k}") for k in keys}
    for k in keys:
        spark.conf.set(f"spark.sql.adaptive.{k}", "100000")
    try:
        found = read_archives(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(f"spark.sql.adaptive.{k}", v)
    assert len(found) == 40 and len({row.task for row in found}) >= 4


def test_members_are_handed_on_in_small_batches():
    contents = [bytes([i]) * 500_000 for i in range(40)]
    packed = []
    for i, content in enumerate(contents):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            archive.writestr("x.bin", content)
        packed.append(buffer.getvalue())
    batch = pa.record_batch({"path": [f"{i}.zip" for i in range(40)], "content": packed})
    listed = list(_listed(iter([batch])))
    unpacked = list(_unpacked(iter(listed)))
    assert [c for made in unpacked for c in made.column("content").to_pylist()] == contents
    assert max(made.nbytes for made in listed + unpacked) < 6_000_000


def test_damaged_member_raises(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("x.txt", b"some content")
    data = (tmp_path / "a.zip").read_bytes().replace(b"some content", b"sone content")
    (tmp_path / "a.zip").write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        read_archives(spark, str(tmp_path)).collect()


def test_broken_archive_raises(spark, tmp_path):
    (tmp_path / "bad.zip").write_bytes(io.BytesIO(b"not a zip").getvalue())
    with pytest.raises(Exception, match="not a zip file"):
        read_archives(spark, str(tmp_path)).collect()


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("t", "p")], "articles string, predicted_summary string")
    files.export_training_text(df, ["articles"], str(tmp_path / "text"), "json")
    files.write_predictions(df, str(tmp_path / "predictions"))
    assert spark.read.json(str(tmp_path / "text")).columns == ["articles"]
    assert spark.read.json(str(tmp_path / "predictions")).collect() == [("t", "p")]


def test_pipeline_stops_at_the_first_failure_and_releases_its_cache(spark, schema):
    layer = stages.Layer(schema)
    held = []

    def transform(scope):
        held.append(scope.cache(spark.range(3)))
        bad = held[0].select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
        return [
            stages.TableOutput("one", held[0]),
            stages.TableOutput("two", bad),
            stages.TableOutput("three", held[0]),
        ]

    with pytest.raises(Exception, match="boom"):
        stages.run_pipeline(transform, layer, ts=TS)
    assert [t.name for t in spark.catalog.listTables(schema)] == ["one"]
    assert not held[0].is_cached


def test_pipeline_passes_partitions_and_keys(spark, schema):
    layer = stages.Layer(schema, keyed=True)
    df = spark.range(4).selectExpr("id", "id % 2 AS p")
    output = stages.TableOutput("t", df, partition_by="p", primary_keys="id")
    assert stages.run_pipeline(lambda _: [output], layer, optimize=True) == [f"{schema}.t"]
    assert spark.table(f"{schema}.t").where("p = 0").count() == 2


def test_feature_stage(spark, schema):
    sentence = "One two three four five six seven eight nine."
    docs = spark.createDataFrame(
        [(f"{sentence} Short.", "S"), ("Short.", "T")], "article string, summary string"
    )
    gold = {o.table_name: o.df for o in stages.bronze_to_gold({"train": docs})}
    with stages.cache_scope() as scope:
        outputs = stages.gold_to_feature_store(gold, eos_token="</s>", scope=scope)
        assert [o.table_name for o in outputs] == ["train_snippets", "train"]
        assert outputs[0].df.count() == 3
        [row] = outputs[1].df.collect()
        ids = {r.doc_id for r in outputs[0].df.collect()}
    assert row.doc_id in ids and len(ids) == 2
    assert row.model_input == (
        "<s>[INS] Create a Plain Language Summary of the following article:\nARTICLE:\n"
        f"{sentence}\nPlain Language Summary:[INST]\nS</s>"
    )


def test_upsert_rewrites_only_touched_partitions(spark, schema):
    name = f"{schema}.t"
    first = spark.createDataFrame(
        [(1, "a", 0), (2, "b", 1), (3, "c", None), (4, "d", 2)], "k int, v string, p int"
    )
    second = spark.createDataFrame([(2, "B", 1), (9, "n", None), (5, "e", 3)], "k int, v string, p int")
    config = tables.UpsertConfig(["p", "k"])
    tables.save_table(first, name, partition_by="p")

    def files_of(p):
        return {f for f in spark.table(name).inputFiles() if f"p={p}/" in f}

    before = {p: files_of(p) for p in (0, 1, 2)}
    tables.upsert_table(second, name, config)
    spark.catalog.refreshTable(name)
    assert rows(spark, name, "k", "v", "p") == sorted(
        [(1, "a", 0), (2, "B", 1), (3, "c", None), (9, "n", None), (4, "d", 2), (5, "e", 3)],
        key=repr,
    )
    assert files_of(0) == before[0] and files_of(2) == before[2] and files_of(1) != before[1]
    tables.compact_table(spark, name)
    tables.upsert_table(second.withColumn("v", F.lit("z")), name, config)
    assert spark.table(name).where("v = 'z'").count() == 3  # the null partition never matches
    assert spark.table(name).count() == 7


def test_broken_json_is_an_error(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"id": 1, "text": "a"}')
    (tmp_path / "bad.json").write_text('{"id": 2, "te')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_docs(spark, str(tmp_path), "id int, text string").collect()
    kept = read_json_docs(spark, str(tmp_path), "id int, text string", mode="DROPMALFORMED")
    assert [tuple(r) for r in kept.where("id is not null").collect()] == [(1, "a")]


def test_upsert_reads_only_the_partitions_of_the_source(spark, schema, monkeypatch):
    name = f"{schema}.parted"
    rows = [(i, i % 4 if i % 5 else None, "old") for i in range(40)]
    tables.save_table(spark.createDataFrame(rows, "k int, p int, v string"), name, partition_by="p")
    plans = []

    def watched(target, *rest):
        plans.append(target._jdf.queryExecution().executedPlan().toString())
        return upsert(target, *rest)

    upsert = tables.upsert
    monkeypatch.setattr(tables, "upsert", watched)
    source = spark.createDataFrame([(1, 1, "new"), (5, None, "new"), (99, 1, "new")], "k int, p int, v string")
    tables.upsert_table(source, name, tables.UpsertConfig(["k", "p"], null_safe=True))
    assert "PartitionFilters: [(" in plans[0] and "PartitionFilters: []" not in plans[0]
    found = {(r.k, r.p): r.v for r in spark.table(name).collect()}
    expected = {(k, p): v for k, p, v in rows} | {(1, 1): "new", (5, None): "new", (99, 1): "new"}
    assert found == expected
