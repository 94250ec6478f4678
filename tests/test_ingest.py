import pytest
from pyspark.sql import types as T

from tidemark.sources import files as fs
from tidemark.sources import ingest
from tidemark.storage.versioned import Files, VersionedTable


def put(spark, path, text):
    Files(spark).create_text(path, text)


def test_each_file_once_also_in_sub_folders(spark, new_path):
    folder = new_path("landing")
    put(spark, f"{folder}/one.csv", "id,name\n1,a\n2,b\n")
    target = VersionedTable(spark, new_path())
    job = ingest.FileIngest(spark, folder, target, new_path("bookmark"))
    job.refresh()
    assert target.read().count() == 2
    put(spark, f"{folder}/new_batch/two.csv", "id,name\n3,c\n")
    job.refresh()
    assert target.read().count() == 3
    job.refresh()
    assert len(target.history()) == 2
    history = ingest.refresh_history(spark, target).collect()
    assert [(r["files"], r["rows"]) for r in history] == [(1, 1), (1, 2)]


def test_pinned_schema_and_rescued_fields(spark, new_path):
    folder, bookmark = new_path("landing"), new_path("bookmark")
    put(spark, f"{folder}/1.csv", "id,zip,price\n1,01234,2.5\n")
    target = VersionedTable(spark, new_path())
    job = ingest.FileIngest(spark, folder, target, bookmark, hints={"zip": "string"})
    job.refresh()
    assert job.schema().simpleString() == "struct<id:int,zip:string,price:double>"
    # Another column order, an unknown column, a text where a number belongs.
    put(spark, f"{folder}/2.csv", "price,id,colour\nmuch,2,red\n3.5,3,\n")
    job.refresh()
    got = {r["id"]: (r["zip"], r["price"], r["_rescued_data"]) for r in target.read().collect()}
    assert got == {
        1: ("01234", 2.5, None),
        2: (None, None, '{"price":"much","colour":"red"}'),
        3: (None, 3.5, None),
    }


def test_new_columns_mode_extends_the_schema(spark, new_path):
    folder = new_path("landing")
    put(spark, f"{folder}/1.csv", "id\n1\n")
    target = VersionedTable(spark, new_path())
    job = ingest.FileIngest(spark, folder, target, new_path("b"), evolution="addNewColumns")
    job.refresh()
    put(spark, f"{folder}/2.csv", "id,score\n2,7\n")
    job.refresh()
    assert {r["id"]: r["score"] for r in target.read().collect()} == {1: None, 2: 7}
    assert job.schema()["score"].dataType == T.IntegerType()


def test_two_folders_into_one_table(spark, new_path):
    target, jobs = VersionedTable(spark, new_path()), []
    for name in ("a", "b"):
        folder = new_path(name)
        put(spark, f"{folder}/1.csv", f"id,name\n1,{name}\n")
        jobs.append(ingest.FileIngest(spark, folder, target, new_path("bookmark")))
    for job in [*jobs, *jobs]:
        job.refresh()
    assert sorted(r["name"] for r in target.read().collect()) == ["a", "b"]


def test_new_bookmark_on_an_old_table_delivers_again(spark, new_path):
    folder, target = new_path("landing"), VersionedTable(spark, new_path())
    put(spark, f"{folder}/1.csv", "id\n1\n")
    ingest.FileIngest(spark, folder, target, new_path("one")).refresh()
    ingest.FileIngest(spark, folder, target, new_path("two")).refresh()
    assert target.read().count() == 2


def test_last_batch_replayed_after_a_crash(spark, new_path):
    """The rows are committed, the stream's own commit is lost: the batch comes again."""
    folder, bookmark = new_path("landing"), new_path("bookmark")
    put(spark, f"{folder}/1.csv", "id\n1\n")
    target = VersionedTable(spark, new_path())
    job = ingest.FileIngest(spark, folder, target, bookmark)
    job.refresh()
    files = Files(spark)
    fs_, path = files._at(f"{bookmark}/commits/0")
    assert fs_.delete(path, False)
    put(spark, f"{folder}/2.csv", "id\n2\n")
    job.refresh()
    assert sorted(r["id"] for r in target.read().collect()) == [1, 2]


def test_surplus_fields_are_rescued(spark, new_path):
    folder, target = new_path("landing"), VersionedTable(spark, new_path())
    put(spark, f"{folder}/1.csv", 'id,name\n1,a\n2,b,c,d\n3\n4,"x,y"\n5,"x,y",z\n')
    ingest.FileIngest(spark, folder, target, new_path("b")).refresh()
    got = {r["id"]: (r["name"], r["_rescued_data"]) for r in target.read().collect()}
    assert got == {
        1: ("a", None),
        2: ("b", '{"_corrupt_record":"2,b,c,d"}'),
        3: (None, None),
        4: ("x,y", None),
        5: ("x,y", '{"_corrupt_record":"5,\\"x,y\\",z"}'),
    }


def test_reader_options(spark, new_path):
    folder, target = new_path("landing"), VersionedTable(spark, new_path())
    put(spark, f"{folder}/1.csv", "id;said;at\n1;'two\nlines; one field';03.02.2024 10:00\n2;x;04.02.2024 11:30\n")
    options = {"sep": ";", "quote": "'", "multiLine": True, "timestampFormat": "dd.MM.yyyy HH:mm"}
    ingest.FileIngest(spark, folder, target, new_path("b"), options=options).refresh()
    got = {r["id"]: (r["said"], str(r["at"]), r["_rescued_data"]) for r in target.read().collect()}
    assert got == {
        1: ("two\nlines; one field", "2024-02-03 10:00:00", None),
        2: ("x", "2024-02-04 11:30:00", None),
    }


def test_files_without_header(spark, new_path):
    folder, target = new_path("landing"), VersionedTable(spark, new_path())
    put(spark, f"{folder}/1.csv", "1,a\n2,b\n")
    ingest.FileIngest(spark, folder, target, new_path("b"), options={"header": False}).refresh()
    assert sorted(tuple(r)[:2] for r in target.read().collect()) == [(1, "a"), (2, "b")]


def test_types_merge_by_name_over_headers(spark, new_path):
    folder, target = new_path("landing"), VersionedTable(spark, new_path())
    put(spark, f"{folder}/1.csv", "id,amount\n1,2\n")
    put(spark, f"{folder}/2.csv", "id,name,amount\n2,n,2.5\n")
    job = ingest.FileIngest(spark, folder, target, new_path("b"))
    job.refresh()
    assert {f.name: f.dataType.simpleString() for f in job.schema()} == {"id": "int", "amount": "double", "name": "string"}


def test_json_files(spark, new_path):
    folder = new_path("landing")
    put(spark, f"{folder}/1.json", '{"id": 1, "tag": "a"}\n{"id": 2, "tag": "b"}\n')
    target = VersionedTable(spark, new_path())
    job = ingest.FileIngest(spark, folder, target, new_path("b"), format="json")
    job.refresh()
    put(spark, f"{folder}/2.json", '{"id": "x", "tag": "c", "more": {"deep": 1}}\n')
    job.refresh()
    last = target.read().filter("tag = 'c'").first()
    assert last["id"] is None
    assert last["_rescued_data"] == '{"id":"x","more":"{\\"deep\\":\\"1\\"}"}'


def test_parquet_files(spark, new_path):
    folder = new_path("landing")
    spark.range(3).write.parquet(f"{folder}/a")
    target = VersionedTable(spark, new_path())
    ingest.FileIngest(spark, folder, target, new_path("b"), format="parquet", glob="*.parquet").refresh()
    assert target.read().count() == 3


def test_replayed_batch_is_recognised(spark, new_path):
    folder = new_path("landing")
    put(spark, f"{folder}/1.csv", "id\n1\n")
    target = VersionedTable(spark, new_path())
    job = ingest.FileIngest(spark, folder, target, new_path("b"))
    listing = spark.createDataFrame([(f"{folder}/1.csv",)], "path string")
    job._one_batch(listing, 0)
    job._one_batch(listing, 0)
    assert target.read().count() == 1


def test_copy_into_loads_each_file_once(spark, new_path):
    folder = new_path("landing")
    put(spark, f"{folder}/1.csv", "id\n1\n")
    put(spark, f"{folder}/2.csv", "id\n2\n")
    target = VersionedTable(spark, new_path())
    assert ingest.copy_into(spark, target, folder, schema="id int", max_files=1) == 2
    assert ingest.copy_into(spark, target, folder, schema="id int") == 0
    put(spark, f"{folder}/3.csv", "id\n3\n")
    assert ingest.copy_into(spark, target, folder, schema="id int") == 1
    assert sorted(r["id"] for r in target.read().collect()) == [1, 2, 3]


def test_copy_into_after_a_crash_between_commits(spark, new_path, monkeypatch):
    """The files are in the ledger, their rows are not in the table: the next run loads them."""
    folder = new_path("landing")
    put(spark, f"{folder}/1.csv", "id\n1\n")
    target = VersionedTable(spark, new_path())
    monkeypatch.setattr(ingest.fs, "read_files", lambda *_, **__: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.copy_into(spark, target, folder, schema="id int")
    monkeypatch.undo()
    put(spark, f"{folder}/2.csv", "id\n2\n")
    assert ingest.copy_into(spark, target, folder, schema="id int") == 1
    assert ingest.copy_into(spark, target, folder, schema="id int") == 0
    assert sorted(r["id"] for r in target.read().collect()) == [1, 2]


def test_table_stream_takes_new_files_only(spark, new_path):
    source, target, bookmark = new_path("s"), new_path("t"), new_path("b")
    schema = spark.range(1).schema
    for n in (2, 3):
        spark.range(n).write.mode("append").parquet(source)
        ingest.ingest_table(spark, source, schema, target, bookmark)
    assert spark.read.parquet(target).count() == 5


def test_export_keeps_microseconds(spark, new_path):
    path = new_path()
    df = spark.sql("SELECT 1 AS id, timestamp_ntz '2024-01-01 00:00:00.123456' AS t, 'a,\"b' AS s")
    fs.export_csv(df, path)
    assert fs.read_files(spark, path, schema=df.schema).collect() == df.collect()


def test_inference_is_pinned(spark, new_path):
    folder, pinned_at = new_path("f"), new_path("schema")
    put(spark, f"{folder}/1.csv", "id,v\n1,2\n")
    first = fs.infer_and_pin_schema(spark, folder, pinned_at)
    put(spark, f"{folder}/2.csv", "id,v\n1,text\n")
    assert fs.infer_and_pin_schema(spark, folder, pinned_at) == first


def test_append_rows_matches_by_name(spark):
    target = spark.createDataFrame([(1, "a")], "id long, name string")
    out = fs.append_rows(target, [("b", 2)], "name string, id int")
    assert [tuple(r) for r in out.collect()] == [(1, "a"), (2, "b")]
    assert out.schema["id"].dataType == T.LongType()


def test_declared_schema(spark):
    schema = T.StructType(
        [
            T.StructField("id", T.LongType(), False, {"comment": "the key"}),
            T.StructField("v", T.DecimalType(12, 2)),
        ]
    )
    good = spark.createDataFrame([(1, 2.5)], "id int, v double")
    out = fs.require_columns(good, schema)
    assert out.schema["v"].dataType == T.DecimalType(12, 2)
    assert out.schema["id"].metadata == {"comment": "the key"}
    bad = spark.createDataFrame([(None, 2.5)], "id int, v double")
    with pytest.raises(Exception, match="NULL in NOT NULL column id"):
        fs.require_columns(bad, schema).collect()


def test_schema_drift_and_formats(spark):
    a = spark.createDataFrame([(1, 2)], "id int, extra int")
    b = spark.createDataFrame([(1,)], "id int")
    assert fs.schema_drift(a, b) == ["extra"]
    with pytest.raises(ValueError, match="format"):
        fs.read_files(spark, "x", "xml")
    with pytest.raises(ValueError, match="evolution"):
        ingest.FileIngest(spark, "x", None, "y", evolution="guess")
