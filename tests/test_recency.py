"""The kept list of newest customers against sorting everything."""

import random

from patronage.operators import recency as R
from patronage.sources.layout import TABLES

SERVED = TABLES["serving", "customers"].schema
SLOTS, KEEP, ASKED = 3, 6, 3


def rows_of(spark, customers):
    fields = SERVED.fieldNames()
    return spark.createDataFrame([tuple({"customer_id": c, "last_order_ts": ts, "order_count": 1}.get(f) for f in fields) for c, ts in customers.items()], SERVED)


def newest(customers, n):
    return sorted(sorted(customers, key=lambda c: (customers[c] or 0, c), reverse=True)[:n])


def test_index_equals_sorting_after_updates_deletes_and_returns(spark):
    draw = random.Random(4)
    customers, refilled = {}, 0
    index = spark.createDataFrame([], R.index_schema(SERVED))
    state = []
    for step in range(14):
        touched = set()
        for _ in range(draw.choice([1, 4, 12])):
            c = f"c{draw.randrange(40)}"
            touched.add(c)
            if step > 3 and draw.random() < (0.9 if step % 4 == 0 else 0.4):
                customers.pop(c, None)
            else:
                customers[c] = draw.choice([None, 0, draw.randrange(1, 30), 100 + step])
        if step == 9:  # the newest go, so that lists run short
            gone = newest(customers, 9)
            touched |= set(gone)
            customers = {c: t for c, t in customers.items() if c not in gone}
        keys = spark.createDataFrame([(c,) for c in touched], "customer_id string")
        current = rows_of(spark, customers) if customers else spark.createDataFrame([], SERVED)
        merged = R.merge_recent(index, keys, current.join(keys, "customer_id", "left_semi").select(*SERVED.fieldNames()), SLOTS, KEEP)
        short = R.short_slots(merged, ASKED)
        refilled += bool(short)
        done = [(r.slot, r.entries, r.floor) for r in (R.refill(merged, current, short, SLOTS, KEEP) if short else merged).collect()]
        assert all(len(entries) <= KEEP for _, entries, _ in done)
        state = [s for s in state if s[0] not in {d[0] for d in done}] + done
        index = spark.createDataFrame(state, R.index_schema(SERVED))
        assert [r.customer_id for r in R.recent_from_index(index, ASKED).collect()] == newest(customers, ASKED)
    assert refilled and any(s[2] is not None for s in state)


def test_an_empty_index_lists_nobody(spark):
    assert R.recent_from_index(spark.createDataFrame([], R.index_schema(SERVED)), 5).count() == 0
