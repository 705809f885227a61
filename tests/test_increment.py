"""Reading what is new by a cursor column, run after run."""

import datetime as dt
import random

import pytest

from changelake.plans.config import Destination
from changelake.plans.increment import read_increment
from changelake.plans.progress_store import ProgressStore
from changelake.sinks import folders

NOW = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)


@pytest.fixture
def reader(spark, tmp_path):
    destination, store = Destination(base_path=f"{tmp_path}/out"), ProgressStore(f"{tmp_path}/state")

    def read(rows, fail=False):
        df = spark.createDataFrame(rows, "id bigint, part string, at int")
        if fail:
            monkey = folders.touch
            folders.touch = lambda spark, path: (_ for _ in ()).throw(InterruptedError()) if path.endswith("_COMMITTED") else monkey(spark, path)
        try:
            return read_increment(spark, df, "t", "at", ["id", "part"], destination, "t", store, NOW)
        finally:
            if fail:
                folders.touch = monkey

    def loaded():
        return sorted((r.id, r.part or "", r.at) for r in destination.read(spark, "t").collect())

    return read, loaded


def test_two_runs_equal_one(reader):
    """Ties at the border are neither lost nor doubled, also where ids have nulls."""
    read, loaded = reader
    first = [(1, "a", 1), (2, None, 5), (3, "a", 5), (2, "b", 5)]
    more = [*first, (4, None, 5), (2, "c", 5), (5, "a", 9), (6, "a", None)]
    assert read(first) == (4, 0)
    assert read(first) == (0, 0)
    assert read(more) == (3, 0)
    assert read(more) == (0, 0)
    assert loaded() == sorted((i, p or "", a) for i, p, a in more if a is not None)


def test_late_rows_are_counted(reader):
    read, loaded = reader
    read([(i, None, i) for i in range(10)])
    late = [(i, None, i) for i in range(12)] + [(100 + i, None, i) for i in range(3)]
    assert read(late) == (2, 3)
    assert read([*late, (50, None, 10)]) == (0, 4)
    assert len(loaded()) == 12


def test_a_run_that_died_is_repeated(reader):
    read, loaded = reader
    rows = [(i, "x", i // 3) for i in range(10)]
    read(rows[:5])
    with pytest.raises(InterruptedError):
        read(rows[:8], fail=True)
    assert read(rows) == (5, 0)
    assert loaded() == rows


def test_empty_table(reader):
    read, loaded = reader
    assert read([]) == (0, 0)
    assert read([(1, None, None)]) == (0, 0)
    assert read([(1, None, 3)]) == (1, 0)
    assert read([]) == (0, 0) and loaded() == [(1, "", 3)]


def test_many_runs(reader):
    read, loaded = reader
    rnd, rows, cursor = random.Random(3), [], 0
    for _ in range(4):
        cursor += rnd.randrange(2)
        rows += [(len(rows) + k, "x", cursor + rnd.randrange(2)) for k in range(rnd.randrange(1, 6))]
        cursor = max(r[2] for r in rows)
        rows = [r for r in rows]
        read(rows)
    kept = loaded()
    assert len(kept) == len(set(kept)) and set(kept) <= set(rows)
