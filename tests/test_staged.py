import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.sources import staged
from millrace.sources.staged import current_manifest, export_staged, read_staged


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "table")


def rows(spark, low, high):
    return spark.range(low, high, 1, 4).select("id", F.col("id").cast("string").alias("name"), F.array("id").alias("list"))


def ids(spark, target):
    return sorted(r.id for r in read_staged(spark, target).collect())


def files(target):
    return sorted(f for _, _, names in os.walk(f"{target}/staged") for f in names)


def test_exports_replace_and_append(spark, target):
    assert export_staged(rows(spark, 0, 100), target) == 100
    assert export_staged(rows(spark, 100, 120), target, overwrite=False) == 120
    assert ids(spark, target) == list(range(120)) and read_staged(spark, target).first().name == str(read_staged(spark, target).first().id)
    assert export_staged(rows(spark, 5, 8), f"file:{target}") == 3 and ids(spark, target) == [5, 6, 7]
    assert [current_manifest(target).version, current_manifest(target).rows] == [3, 3]
    assert export_staged(rows(spark, 0, 0), target) == 0 and ids(spark, target) == []
    assert read_staged(spark, target).schema.names == ["id", "name", "list"]


def test_a_table_that_was_never_exported(spark, target):
    with pytest.raises(Exception, match="nothing was exported"):
        read_staged(spark, target).collect()
    assert current_manifest(target).version == 0


def test_other_columns_are_not_appended(spark, target):
    export_staged(rows(spark, 0, 3), target)
    with pytest.raises(Exception, match="another schema"):
        export_staged(spark.range(3), target, overwrite=False)
    assert ids(spark, target) == [0, 1, 2]


def test_a_task_that_fails_leaves_the_table_as_it_was(spark, target):
    export_staged(rows(spark, 0, 10), target)
    before = files(target)
    broken = rows(spark, 0, 1000).withColumn("name", F.when(F.col("id") == 999, F.raise_error(F.lit("broken row"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="broken row"):
        export_staged(broken, target)
    assert ids(spark, target) == list(range(10)) and current_manifest(target).version == 1
    named = {os.path.basename(f["name"]) for f in current_manifest(target).files}
    assert named == set(before) and named <= set(files(target))


def failing_once(folder, rows):
    """The rows, but the first attempt to read the last one fails after most were written."""

    def each(batches):
        for batch in batches:
            yield batch
        mark = f"{folder}/failed"
        if batch.num_rows and not os.path.exists(mark):
            open(mark, "w").close()
            raise RuntimeError("lost")

    return rows.coalesce(1).mapInArrow(each, rows.schema)


def test_a_task_that_runs_twice_counts_once(tmp_path):
    """In a session of its own, as only a master that allows it runs a failed task again."""
    import subprocess
    import sys

    script = f"""
import sys
sys.path[:0] = {[os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]!r}
from test_staged import export_staged, failing_once, files, ids, rows
from millrace.session import build_session
from millrace.sources.staged import current_manifest
spark = build_session("retry", "local[2,3]", {{"spark.ui.enabled": "false", "spark.checkpoint.dir": {str(tmp_path)!r}}})
target = {str(tmp_path / 'table')!r}
count = export_staged(failing_once({str(tmp_path)!r}, rows(spark, 0, 500)), target)
print("RESULT", count, ids(spark, target) == list(range(500)), len(files(target)), len(current_manifest(target).files))
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=240)
    assert "RESULT 500 True 1 1" in done.stdout, done.stderr[-2000:]
    assert os.path.exists(tmp_path / "failed")


def test_a_commit_that_fails_leaves_the_table_as_it_was(spark, target):
    export_staged(rows(spark, 0, 10), target)
    writer = staged.StagedWriter(target, rows(spark, 0, 1).schema, True)
    message = writer.write(iter(read_staged(spark, target).toArrow().to_batches()))
    assert message.rows == 10 and len(files(target)) > len(current_manifest(target).files)
    export_staged(rows(spark, 20, 22), target)
    with pytest.raises(RuntimeError, match="meanwhile"):
        writer.commit([message, None])
    writer.abort([message, None])
    assert ids(spark, target) == [20, 21] and current_manifest(target).version == 2
    assert not any(writer.export in folder for folder, _, names in os.walk(target) if names)


def test_a_rename_that_fails_leaves_the_table_as_it_was(spark, target, monkeypatch):
    export_staged(rows(spark, 0, 10), target)
    writer = staged.StagedWriter(target, rows(spark, 0, 1).schema, True)
    store, folder = staged.located(target)

    class Broken:
        def __getattr__(self, name):
            return getattr(store, name)

        def move(self, *_):
            raise OSError("no space")

    monkeypatch.setattr(staged, "located", lambda path: (Broken(), folder))
    with pytest.raises(OSError, match="no space"):
        writer.commit([staged.StagedFile("staged/x/y.parquet", 1, 1)])
    monkeypatch.undo()
    assert ids(spark, target) == list(range(10))


def test_files_are_read_together_by_size(spark, target, monkeypatch):
    export_staged(rows(spark, 0, 100), target)
    reader = staged.StagedReader(target, rows(spark, 0, 1).schema)
    assert [len(p.names) for p in reader.partitions()] == [4]
    monkeypatch.setattr(staged, "SPLIT", 1)
    assert [len(p.names) for p in reader.partitions()] == [1, 1, 1, 1]
    assert json.loads(current_manifest(target).schema)["type"] == "struct"
