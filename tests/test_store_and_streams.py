"""Result stores compute nothing twice; streams of connections and reviews agree with tables, also after a restart and with repeated batches."""

import random
from collections import Counter

from pyspark.sql import functions as F

from quillstone.sources import store
from quillstone.streaming import connections as C
from quillstone.streaming import events as E


def test_results_are_computed_once(spark, tmp_path):
    path, seen = str(tmp_path / "store"), []

    def compute(rows):
        found = rows.collect()
        seen.append(sorted(r["id"] for r in found))
        return rows.select("id", F.length(F.coalesce("text", F.lit(""))).cast("int").alias("n"))

    def run(rows):
        frame = spark.createDataFrame(rows, "id long, text string").withColumn("content_hash", F.lit("x")).withColumn("version", F.lit(9)).drop("content_hash", "version")
        out = store.cached(frame, path, "id LONG, n INT", ["id"], ["text"], compute).collect()
        return {r["id"]: (r["n"], r["version"]) for r in out}

    rows = [(1, "a"), (2, "bb"), (3, None), (4, "")]
    assert run(rows) == {1: (1, 1), 2: (2, 1), 3: (0, 1), 4: (0, 1)} and seen == [[1, 2, 3, 4]]
    assert run(rows) == {1: (1, 1), 2: (2, 1), 3: (0, 1), 4: (0, 1)} and len(seen) == 1
    # A changed text, null for empty, and a new row.
    assert run([(1, "a"), (2, "bbb"), (3, ""), (5, "zz")]) == {1: (1, 1), 2: (3, 2), 3: (0, 2), 5: (2, 2)} and seen[1:] == [[2, 3, 5]]
    # A version without its marker was never written.
    (tmp_path / "store/v=9").mkdir()
    (tmp_path / "store/v=9/part-0.parquet").write_text("half")
    assert run(rows[:1]) == {1: (1, 1)} and len(seen) == 2
    assert run([(1, "new")])[1] == (3, 10)
    assert store.read_store(spark, str(tmp_path / "none"), "id LONG, n INT", ["id"]).count() == 0


def test_many_versions_become_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "MOST_VERSIONS", 2)
    path = str(tmp_path / "s")
    for k in range(4):
        out = store.cached(spark.createDataFrame([(i, f"{k} {i % (k + 1)}") for i in range(3)], "id long, text string"), path, "id LONG, t STRING", ["id"], ["text"], lambda r: r.select("id", F.upper("text").alias("t")))
        assert {r["id"]: r["t"] for r in out.collect()} == {i: f"{k} {i % (k + 1)}" for i in range(3)}


def changes_of(rows, idle, now):
    """(video, connection, delta, time) by a plain loop."""
    out = Counter()
    for v, c in {r[:2] for r in rows}:
        last = None
        for kind, at in sorted((r[2:] for r in rows if r[:2] == (v, c)), key=lambda x: x[1]):
            if last is not None and at - last > idle:
                out[v, c, -1, last + idle] += 1
                last = None
            if kind == "disconnect":
                if last is not None:
                    out[v, c, -1, at] += 1
                last = None
            else:
                if last is None:
                    out[v, c, 1, at] += 1
                last = at
        if last is not None and now - last > idle:
            out[v, c, -1, last + idle] += 1
    return out


def test_connections_stream_and_table(spark, tmp_path):
    rng = random.Random(7)
    rows, at = [], 0
    for _ in range(120):
        at += rng.choice([1, 3, 9])
        rows.append((rng.choice("ab"), rng.choice("xyz"), rng.choice(["message", "message", "connect", "disconnect"]), at))
    rows.append(("z", "end", "message", at + 1000))
    make = lambda some: spark.createDataFrame(some, "video_id string, connection_id string, kind string, s long").select("video_id", "connection_id", "kind", F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("ts"))
    schema = "video_id STRING, connection_id STRING, kind STRING, ts TIMESTAMP"

    def drain(out):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        E.run_available(C.connection_changes(stream, "30 seconds", "0 seconds"), C.write_once(out), str(tmp_path / "check"), "append")

    for k, part in enumerate((rows[:50], rows[50:90], rows[90:])):
        make(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if k != 1:
            drain(str(tmp_path / "out"))  # each call is a restart from the checkpoint
    got = spark.read.parquet(str(tmp_path / "out"))
    # A batch that is repeated replaces what it wrote.
    last = max(r["batch"] for r in got.select("batch").distinct().collect())
    again = spark.createDataFrame(spark.read.parquet(str(tmp_path / f"out/batch={last}")).collect(), C._CHANGES)
    C.write_once(str(tmp_path / "out"))(again, last)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = changes_of(rows, 30, at + 1000)
    assert Counter((r["video_id"], r["connection_id"], r["delta"], r["s"]) for r in got.withColumn("s", F.unix_seconds("at") - 1_700_000_000).collect()) == want
    assert {r["video_id"]: r["open"] for r in C.open_connections(spark, str(tmp_path / "out")).collect()} == {"z": 1}
    table = spark.createDataFrame(rows, "video_id string, connection_id string, kind string, s long").withColumn("n", F.monotonically_increasing_id())
    counts = C.connection_counts(table, F.lit(at + 1000), F.lit(30), ["s", "n"]).collect()
    assert {r["video_id"]: (r["opened"], r["closed"]) for r in counts} == {v: (sum(n for k, n in want.items() if k[0] == v and k[2] == 1), sum(n for k, n in want.items() if k[0] == v and k[2] == -1)) for v in "abz"}
    spans = Counter((r["video_id"], r["connection_id"], r["opened_at"], r["closed_at"]) for r in C.sessions(table, F.lit(30), ["s", "n"]).collect())
    starts = Counter((v, c, t) for (v, c, delta, t), n in changes_of(rows, 30, 10**6).items() if delta == 1 for _ in range(n))
    ends = Counter((v, c, t) for (v, c, delta, t), n in changes_of(rows, 30, 10**6).items() if delta == -1 for _ in range(n))
    assert Counter(k[:3] for k in spans.elements()) == starts and Counter((*k[:2], k[3]) for k in spans.elements()) == ends


def test_reviews_advance_once(spark, tmp_path):
    out = str(tmp_path / "advanced")
    handle = C.advance_completed(out)
    batch = lambda rows: spark.createDataFrame(rows, "video_id string, total long, decided long, pending long")
    batches = [batch([("a", 2, 2, 0), ("b", 2, 1, 1), ("e", 0, 0, 0)]), batch([("b", 2, 2, 0), ("a", 3, 3, 0)]), batch([("c", 1, 0, 1)]), batch([("c", 1, 1, 0)])]
    read = lambda: sorted(tuple(r) for r in spark.read.schema("video_id STRING, stage STRING, batch INT").parquet(out).collect())
    for k in (0, 1, 1, 0, 2, 3, 3):  # batches are repeated after a failure
        handle(batches[k], k)
    assert read() == [("a", "question_generation", 0), ("b", "question_generation", 1), ("c", "question_generation", 3)]
