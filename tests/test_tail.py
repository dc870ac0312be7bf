"""A growing log: appended, half, rotated, copied and cut, read in pieces."""

import os
import shutil

import pytest

from watchmill.sources import tail
from watchmill.streaming import jobs


class Job:
    """A query over one log that is resumed whenever it is asked for what is new."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, folder, options
        self.log, self.out = f"{folder}/conn.log", f"{folder}/out"
        self.seen = 0

    def append(self, text, end=""):
        with open(self.log, "a", encoding="utf-8") as file:
            file.write(text + end)

    def lines(self, *values):
        self.append("".join(f"{v}\n" for v in values))

    def all(self):
        stream = tail.tail(self.spark, self.log, **self.options)
        jobs.run(stream, jobs.table_sink(self.out), f"{self.folder}/checkpoint").awaitTermination()
        if not os.path.isdir(self.out):
            return []
        return sorted(r.value for r in self.spark.read.parquet(self.out).collect())


@pytest.fixture
def job(spark, tmp_path):
    return lambda **options: Job(spark, str(tmp_path), **options)


def test_appended_half_and_rotated_lines(job):
    j = job()
    assert j.all() == []
    j.lines(*"abcde")
    assert j.all() == list("abcde")
    j.lines(*"fghi")
    j.append("j1")
    assert j.all() == list("abcdefghi")
    j.append("j2\nk\n")
    os.rename(j.log, j.log + ".1")
    j.lines("l", "m")
    assert j.all() == sorted([*"abcdefghi", "j1j2", *"klm"])
    with open(j.log + ".1", "a") as late:  # the writer still had the old one open
        late.write("n\n")
    os.rename(j.log + ".1", j.log + ".2")
    os.rename(j.log, j.log + ".1")
    j.lines("o")
    shutil.copy(j.log + ".2", j.log + ".2.gz")
    assert j.all() == sorted([*"abcdefghi", "j1j2", *"klmno"])
    os.remove(j.log + ".2")  # all of it was read
    j.lines("p")
    assert j.all() == sorted([*"abcdefghi", "j1j2", *"klmnop"])


def test_copied_and_cut(job):
    j = job(identity="line")
    j.lines("1 a", "2 b")
    assert j.all() == ["1 a", "2 b"]
    j.lines("3 c")
    shutil.copy(j.log, j.log + ".1")
    os.truncate(j.log, 0)
    j.lines("4 d")
    assert j.all() == ["1 a", "2 b", "3 c", "4 d"]


def test_cut_to_nothing(job):
    j = job()
    j.lines(*"abc")
    assert j.all() == list("abc")
    os.truncate(j.log, 0)
    j.lines("a", "z")  # the same first line, but shorter than what was read
    assert j.all() == sorted("abcaz")


def test_from_the_end(job):
    j = job(**{"from": "end"})
    j.lines(*"abc")
    assert j.all() == []
    j.lines(*"de")
    assert j.all() == list("de")


def test_a_file_that_went_unread_is_an_error(job):
    j = job()
    j.lines("a")
    reader = tail.LogTailReader({"path": j.log})
    start, end = reader.initialOffset(), reader.latestOffset()
    piece = reader.partitions(start, end)[0]
    os.remove(j.log)
    with pytest.raises(FileNotFoundError):
        list(reader.read(piece))
    with pytest.raises(FileNotFoundError):
        reader.partitions(start, end)


def values(reader, pieces):
    return [[v for batch in reader.read(p) for v in batch.column("value").to_pylist()] for p in pieces]


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_pieces_share_no_line(tmp_path, size):
    log = tmp_path / "a.log"
    lines = ["", "x", "yy" * 9, "ü", "", "z" * 40, "end"]
    log.write_bytes("".join(f"{v}\r\n" for v in lines).encode() + b"half")
    reader = tail.LogTailReader({"path": str(log), "taskBytes": str(size)})
    pieces = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert sum(values(reader, pieces), []) == lines
    positions = [p for piece in pieces for batch in reader.read(piece) for p in batch.column("position").to_pylist()]
    data = log.read_bytes()
    assert [data[p:].split(b"\r\n")[0].decode() for p in positions] == lines


def test_batches_of_bounded_size(tmp_path):
    log = tmp_path / "a.log"
    lines = ["a" * n for n in (3, 50, 1, 1, 9, 200, 2)]
    log.write_text("".join(f"{v}\n" for v in lines))
    reader = tail.LogTailReader({"path": str(log), "batchBytes": "20"})
    at, found, steps = reader.initialOffset(), [], 0
    while (end := reader.latestOffset()) != at:
        found += sum(values(reader, reader.partitions(at, end)), [])
        at, steps = end, steps + 1
    assert found == lines and steps > 3


def test_lines_that_are_no_text(tmp_path):
    log = tmp_path / "a.log"
    log.write_bytes(b"\xff\xfe\n" + b"x" * (3 << 20) + b"\nlast\n")
    reader = tail.LogTailReader({"path": str(log)})
    got = sum(values(reader, reader.partitions({}, reader.latestOffset())), [])
    assert got == ["��", "x" * (3 << 20), "last"]
