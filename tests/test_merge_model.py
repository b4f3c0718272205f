"""MERGE and collapse against a plain-Python model on random change sets (incl. NULL ops and deletes)."""

import random
from decimal import Decimal

from rivulet.operators import cdc as C

CH = ("op string, ts_ms long, partition int, offset long, order_id long, customer_id long, "
      "amount decimal(12,2), status string, ts timestamp")
TARGET = "order_id long, customer_id long, amount decimal(12,2), status string, ts timestamp"


def model(target_rows, change_rows):
    state = {r[0]: r for r in target_rows}
    last = {}
    for r in change_rows:
        k = r[4]
        if k not in last or (r[1], r[2], r[3]) > (last[k][1], last[k][2], last[k][3]):
            last[k] = r
    for k, r in last.items():
        op = r[0]
        row = (k, r[5], r[6], r[7], None)
        if k in state:
            if op == "d":
                del state[k]
            else:                       # 'c', 'r', 'u' and NULL update a matched row
                state[k] = row
        elif op is not None and op != "d":
            state[k] = row
    return sorted(state.values())


def test_merge_matches_model(spark):
    rnd = random.Random(11)
    for trial in range(6):
        target = [(k, rnd.randrange(5), Decimal(f"{rnd.randrange(1000)}.00"), f"t{k}", None)
                  for k in rnd.sample(range(30), 12)]
        changes = []
        for i in range(60):
            op = rnd.choice(["c", "r", "u", "d", None])
            changes.append((op, rnd.randrange(5), rnd.randrange(3), i, rnd.randrange(30),
                            None if op == "d" else rnd.randrange(5),
                            None if op == "d" else Decimal(f"{rnd.randrange(1000)}.00"),
                            None if op == "d" else f"s{i}", None))
        t = spark.createDataFrame(target, TARGET)
        ch = spark.createDataFrame(changes, CH)
        got = sorted(tuple(r) for r in C.apply_changes(t, ch, C.ORDERS).collect())
        assert got == model(target, changes), f"trial {trial}"
        # the full-outer-join form (guard off, soft delete off) agrees with the anti-join form
        fo = C.merge(t.withColumn("ts_ms", t.order_id * 0 - 1), C.collapse(ch, C.ORDERS), C.ORDERS, guard=True)
        assert sorted((r["order_id"], r["status"]) for r in fo.collect()) == sorted((r[0], r[3]) for r in got)
