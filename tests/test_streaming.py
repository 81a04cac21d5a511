import os

from tests.xes_samples import HEADER, attr, event, iso, trace, write_log
from warband.streaming import ingest_stream


def _log(prefix, n_traces, n_events):
    from datetime import datetime
    b = datetime(2023, 1, 1)
    ts = [trace(f"{prefix}{t}", [attr("string", "match_id", f"{prefix}m{t}"), attr("string", "player_id", "p")],
                [event("Queue Villager", iso(b, i), index=i, win="1") for i in range(n_events)])
          for t in range(n_traces)]
    return HEADER + "".join(ts) + "</log>\n"


def test_incremental_ingest_exactly_once(spark, scratch):
    src, out, ck = (os.path.join(scratch, d) for d in ("in", "bronze", "ck"))
    write_log(src, "a.xes", _log("a", 3, 5))
    write_log(src, "skip.txt", "<trace>ignored</trace>")
    ingest_stream(spark, src, out, ck).awaitTermination(120)
    assert spark.read.parquet(out).count() == 15
    write_log(src, "b.xes", _log("b", 2, 4))
    ingest_stream(spark, src, out, ck).awaitTermination(120)
    df = spark.read.parquet(out)
    assert df.count() == 23 and df.select("event_id").distinct().count() == 23
