"""Small random panels and bag comparison."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.spec import PanelSpec

PAIRS = (("Cume_Res_Pos", "Outbrk_Res_Pos"), ("Cume_Staff_Death", "Outbrk_Staff_Death"))
SPEC = PanelSpec(pairs=PAIRS)
METRICS = [c for p in PAIRS for c in p]
LABELS = ["State", "ctp_id", "Facility", "County", "State_Facility_Type", "CTP_Facility_Type",
          "CMS_ID", "Outbrk_Status", "Res_Census"]
COLUMNS = [*LABELS, "Date", *METRICS, "_ord"]
# Thursdays, one Wednesday among them
DATES = [20201203, 20201210, 20201217, 20201223, 20201231, 20210107, 20210114, 20210121, 20210128]
JUNK = ["<11", "No Data", "Redacted (1-4 cases)", "4 *", "3.7", "Data Pending", "nan", "12d"]


def random_rows(seed: int, *, states=4, entities=6, most=3, junk=0.08, statuses=None, nulls=0.15,
                thin=0.3) -> list[dict]:
    rng = random.Random(seed)
    statuses = statuses or ["OPEN", "CLOSED", "CLOSED", "Closed", "", None]
    rows = []
    for s in range(states):
        dates = [d for d in DATES if rng.random() > 0.2] or DATES[:1]
        for e in range(entities):
            for d in dates:
                if rng.random() < thin:
                    continue
                for _ in range(rng.randint(1, most)):
                    row = {"State": f"S{s}", "ctp_id": f"E{s}{e}", "Facility": f"HOME {e // 2}",
                           "County": rng.choice(["", "EAST", "EAST", "WEST"]),
                           "State_Facility_Type": rng.choice(["", "NH", "ALF", "NH", "RCFE"]),
                           "CTP_Facility_Type": "Nursing Home",
                           "CMS_ID": rng.choice([None, "C1", "C2", " "]),
                           "Outbrk_Status": rng.choice(statuses), "Res_Census": str(rng.randint(1, 9)),
                           "Date": d}
                    for c in METRICS:
                        x = rng.random()
                        row[c] = (None if x < nulls else rng.choice(JUNK) if x < nulls + junk
                                  else str(rng.randint(0, 30)))
                    rows.append(row)
                    if rng.random() < 0.15:
                        rows.append(dict(row))
    rng.shuffle(rows)
    for i, r in enumerate(rows):
        r["_ord"] = i
    return rows


def frame(spark, rows, columns=None):
    columns = columns or list(rows[0])
    kinds = {"Date": T.IntegerType(), "_ord": T.LongType()}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in columns])
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema).repartition(4)


def bag_of(df, columns) -> Counter:
    picked = df.select(*[F.col(f"`{c}`") for c in columns])
    return Counter(tuple(None if v is None else str(v) for v in r) for r in picked.collect())


def bag(rows, columns) -> Counter:
    return Counter(tuple(None if r.get(c) is None else str(r.get(c)) for c in columns) for r in rows)


def same(df, rows, columns) -> None:
    got, want = bag_of(df, columns), bag(rows, columns)
    assert got == want, (sum(got.values()), sum(want.values()),
                         list((got - want).items())[:3], list((want - got).items())[:3])
