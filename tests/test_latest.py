"""Latest values as a stream against a loop, over restarts, with locations that fall silent."""

import datetime as dt
import random

from hazardflow.plans.catalog import _drain
from hazardflow.sources import messages
from hazardflow.streaming import landing, latest

SCHEMA = "measurement string, location_id string, field string, value double, time timestamp_ntz"
BASE = dt.datetime(2024, 5, 1)
HOUR = dt.timedelta(hours=1)


def made():
    """Four files of two hours each; locations 0 to 5 stop one after the other, 6 comes back."""
    r = random.Random(8)
    out = []
    for part in range(4):
        rows = []
        for loc in range(8):
            if (loc < 6 and part > loc % 4) or (loc == 6 and part in (1, 2)):
                continue
            fields = ["latitude", "longitude", "alert_level_num", "other"][: 2 if loc == 7 and part < 3 else 4]
            for f in fields:
                for _ in range(3):
                    time = BASE + 2 * part * HOUR + dt.timedelta(seconds=r.randrange(6000))
                    rows.append(("flood", f"L{loc}", f, float(r.randrange(50)), time))
                    if r.random() < 0.3:
                        rows.append(("flood", f"L{loc}", f, float(r.randrange(50)), time))
        rows.append(("fire", "L0", "latitude", 1.0, BASE + 9 * HOUR))
        rows.append(("flood", "L5", "latitude", None, BASE + 9 * HOUR))
        out.append(rows)
    return out


def expected(parts, silence=HOUR, lateness=0.5 * HOUR):
    """All keys' newest points so far; those silent at the watermark are forgotten after each part."""
    held = {}
    for rows in parts:
        rows = [x for x in rows if x[0] == "flood" and x[2] in latest.MAP_FIELDS and x[3] is not None]
        for _, loc, f, v, t in rows:
            fields = held.setdefault(loc, {})
            fields[f] = max(fields.get(f, (t, v)), (t, v))
        mark = max(t for *_, t in rows) - lateness
        held = {k: x for k, x in held.items() if max(t for t, _ in x.values()) + silence >= mark}
    return {k: tuple(x[f][1] for f in latest.MAP_FIELDS) for k, x in held.items() if len(x) == 3}


def test_map_at_every_moment_over_restarts(spark, tmp_path):
    parts, sizes = made(), []
    for n, rows in enumerate(parts, 1):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = messages.message_stream(spark, "parquet", {"path": f"{tmp_path}/in"}, schema=spark.read.parquet(f"{tmp_path}/in").schema)
        changes = latest.alert_map_stream(source, "1 hour", "30 minutes", "flood")
        _drain(landing.upsert_parquet(changes, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
        now = latest.map_now(spark.read.parquet(f"{tmp_path}/out"), ["location_id"])
        got = {r["location_id"]: (r["latitude"], r["longitude"], r["alert_level_num"]) for r in now.collect()}
        assert got == expected(parts[:n]), n
        sizes.append(len(got))
    assert min(sizes) < max(sizes)
    told = spark.read.parquet(f"{tmp_path}/out").where("gone").select("location_id").distinct().count()
    assert told >= 5
