"""Chunked snapshot beside a live log: window keys are dropped, a stopped run goes on, nothing is lost."""

import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import cdc as C
from rivulet.operators import snapshot as S

CFG = C.TableConfig("t", "id", {"v": "string"}, ts_col=None)
LOG = "op string, ts_ms long, partition int, offset long, id long, v string, position long"


class Live:
    """A table in memory that a writer changes at every look at it."""

    def __init__(self, spark, seed, keys=40):
        self.spark, self.rng = spark, random.Random(seed)
        self.keys, self.log = keys, []
        self.table = {k: "old" for k in range(0, keys, 2)}
        self.fail = None

    def write(self, n):
        for _ in range(n):
            k, p = self.rng.randrange(self.keys), len(self.log) + 1
            if k in self.table and self.rng.random() < 0.4:
                del self.table[k]
                self.log.append(("d", p, 0, p, k, None, p))
            else:
                self.log.append(("u" if k in self.table else "c", p, 0, p, k, f"v{p}", p))
                self.table[k] = f"v{p}"

    def position(self):
        self.write(3)
        return len(self.log)

    def rows(self, low, high):
        self.write(3)  # the read sees writes that come after the low position
        if self.fail == low:
            self.fail = None
            raise ConnectionError("source is gone")
        rows = [(k, v) for k, v in self.table.items() if low <= k < high]
        self.write(3)
        return self.spark.createDataFrame(rows, "id long, v string")

    def changes(self, after, upto):
        return self.all().filter((F.col("position") > after) & (F.col("position") <= upto))

    def all(self):
        return self.spark.createDataFrame(self.log, LOG)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_snapshot_and_log_equal_the_table(spark, tmp_dir, seed):
    live = Live(spark, seed)
    ranges = list(S.key_ranges(0, 39, 15))
    assert [r[1:] for r in ranges] == [(0, 15), (15, 30), (30, 40)]
    live.fail = 15
    with pytest.raises(ConnectionError):
        S.snapshot_ranges(spark, live, CFG, tmp_dir, ranges)
    live.write(5)                                              # the source goes on while the run is down
    assert S.snapshot_ranges(spark, live, CFG, tmp_dir, ranges, limit=1) == 1   # the first range is not read again
    assert S.snapshot_ranges(spark, live, CFG, tmp_dir, ranges) == 1
    assert S.snapshot_ranges(spark, live, CFG, tmp_dir, ranges) == 0
    live.write(4)
    both = S.chunk_changes(spark, tmp_dir, CFG).unionByName(live.all())
    state = {r.id: r.v for r in C.collapse(both, CFG, S.ORDER).filter("op <> 'd'").collect()}
    assert state == live.table


def test_an_empty_range_is_done_too(spark, tmp_dir):
    live = Live(spark, 4)
    live.table = {}
    live.write = lambda n: None
    live.log = [("d", 1, 0, 1, 99, None, 1)]
    assert S.snapshot_ranges(spark, live, CFG, tmp_dir, S.key_ranges(0, 5, 3)) == 2
    assert S.snapshot_ranges(spark, live, CFG, tmp_dir, S.key_ranges(0, 5, 3)) == 0
    assert S.chunk_changes(spark, tmp_dir, CFG).count() == 0
