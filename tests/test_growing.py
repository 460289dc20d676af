import os

import pytest

from millrace.sources import growing
from millrace.streaming.ingest import tail_lines


@pytest.fixture
def tail(spark, tmp_path):
    """Appends text to files, runs the query until it has caught up, and returns what is in the target."""
    (tmp_path / "logs").mkdir()

    def run(texts=(), **options):
        for name, text in texts:
            with open(tmp_path / "logs" / name, "ab") as file:
                file.write(text)
        target = str(tmp_path / "out")
        query = tail_lines(spark, str(tmp_path / "logs"), target, str(tmp_path / "checkpoint"), once=True, **options)
        query.awaitTermination()
        files = [f for f in os.listdir(target) if f.endswith(".txt")] if os.path.isdir(target) else []
        return sorted(r.value for r in spark.read.text(target).collect()) if files else []

    run.folder = tmp_path / "logs"
    return run


def test_finished_lines_come_once_across_restarts(tail):
    assert tail([("a.txt", b"one\ntwo\nthr")]) == ["one", "two"]
    assert tail() == ["one", "two"]
    assert tail([("a.txt", b"ee\n\r\n"), ("b.txt", b""), ("c.txt", b"no end")]) == ["", "one", "three", "two"]
    assert tail([("c.txt", "é\n".encode() + b"\xff\n")]) == ["", "no endé", "one", "three", "two", "�"]


def test_renamed_files_are_followed_and_new_ones_begin(tail):
    assert tail([("a.txt", b"1\n2\nthe th")]) == ["1", "2"]
    os.rename(tail.folder / "a.txt", tail.folder / "a.txt.1")
    assert tail([("a.txt.1", b"ird\n"), ("a.txt", b"new\n")]) == ["1", "2", "new", "the third"]
    os.rename(tail.folder / "a.txt.1", tail.folder / "a.txt.2")
    os.rename(tail.folder / "a.txt", tail.folder / "a.txt.1")
    assert tail([("a.txt", b"newest\n")]) == ["1", "2", "new", "newest", "the third"]
    os.remove(tail.folder / "a.txt.2")
    assert tail([("a.txt.1", b"end\n")]) == ["1", "2", "end", "new", "newest", "the third"]


def test_a_file_that_was_cut_or_replaced_is_read_anew(tail):
    assert tail([("a.txt", b"a long first line\nsecond\n")]) == ["a long first line", "second"]
    (tail.folder / "a.txt").write_bytes(b"x\n")
    assert tail() == ["a long first line", "second", "x"]
    (tail.folder / "a.txt").write_bytes(b"another beginning, and longer than before\n")
    assert tail() == ["a long first line", "another beginning, and longer than before", "second", "x"]


def test_only_what_matches_and_what_comes_after(tail):
    (tail.folder / "old.log").write_bytes(b"before\nhal")
    (tail.folder / "other.tmp").write_bytes(b"other\n")
    assert tail(pattern="*.log", from_end=True) == []
    assert tail([("old.log", b"f\nafter\n"), ("new.log", b"first\n")], pattern="*.log", from_end=True) == ["after", "first", "half"]


def test_tasks_share_a_file_without_loss(tmp_path):
    text = b"".join(b"%d" % i * (i % 7) + b"\n" for i in range(2000))
    (tmp_path / "f").write_bytes(b"skipped\n" + text + b"open")
    whole = len(text) + 8
    assert growing.end_of_last_line(str(tmp_path / "f"), whole + 4) == whole
    for split in (1, 3, 100, 4096, 10**6):
        found = []
        for begin in range(8, whole, split):
            for batch in growing.lines_of(str(tmp_path / "f"), 8, begin, min(begin + split, whole)):
                found += zip(batch["byte"].to_pylist(), batch["value"].to_pylist())
        starts = [8 + sum(len(x) + 1 for x in text.split(b"\n")[:i]) for i in (0, 1, 1999)]
        assert [v for _, v in found] == text.decode().split("\n")[:-1] and [found[i][0] for i in (0, 1, 1999)] == starts


def test_the_end_is_found_over_long_lines(tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "CHUNK", 4)
    (tmp_path / "f").write_bytes(b"ab\n" + b"x" * 50)
    assert [growing.end_of_last_line(str(tmp_path / "f"), n) for n in (0, 2, 3, 53)] == [0, 0, 3, 3]


def test_lines_gone_before_they_were_read_end_the_query(tmp_path):
    (tmp_path / "f").write_bytes(b"line\n")
    reader = growing.GrowingFileReader({"path": f"file://{tmp_path}"})
    end = reader.latestOffset()
    (span,) = reader.partitions(reader.initialOffset(), end)
    os.remove(tmp_path / "f")
    with pytest.raises(FileNotFoundError):
        reader.partitions({"files": {}}, end)
    with pytest.raises(FileNotFoundError):
        reader.read(span)
