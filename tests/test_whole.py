"""Queries that were cut once, on the pairs and rows that the cut lost."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from quillstone.plans import joins, registry, stores


def test_bit_similarity_meets_across_blocks(spark, tmp_path):
    rng = random.Random(4)
    vectors = [[rng.choice([-1.0, 1.0]) for _ in range(64)] for _ in range(40)]
    for i in range(40):
        copy = list(vectors[i])
        for at in rng.sample(range(64), i % 12):  # 0 to 11 differing bits, 9 at most are similar
            copy[at] = -copy[at]
        vectors.append(copy)
    spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    differ = lambda a, b: sum(x != y for x, y in zip(vectors[a], vectors[b], strict=True))
    want = [(a, b) for a in range(80) for b in range(a + 1, 80) if 1 - differ(a, b) / 64 > 0.85]
    got = registry.QUERIES["j22_bit_similarity_all"](spark, str(tmp_path)).collect()
    assert sorted((r["a"], r["b"]) for r in got) == want
    assert any(a // 25 != b // 25 for a, b in want)


def test_bit_similarity_compares_cells_in_many_tasks(spark, monkeypatch):
    rng = random.Random(6)
    # Many values, and a crowd that has all but the last band in common.
    made = [rng.getrandbits(64) for _ in range(150)] + [rng.getrandbits(12) << 52 | 5 for _ in range(150)]
    made += [b ^ sum(1 << at for at in rng.sample(range(64), rng.randrange(13))) for b in made] + [0, 2**64 - 1, 2**63, 2**63 - 1]
    signed = sorted({b - 2**64 if b >= 2**63 else b for b in made})
    own = spark.createDataFrame([(b,) for b in signed], "bits long")
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 9}
    for cell in (joins._J22_CELL, 20):
        monkeypatch.setattr(joins, "_J22_CELL", cell)
        got = joins._similar_signatures(own).collect()
        assert len(got) == len(want) and {(r["x"], r["y"]) for r in got} == want
    monkeypatch.setattr(joins, "_J22_WORK", 10_000), monkeypatch.setattr(joins, "_J22_EACH", 0)
    met = joins._met(own)
    # The pairs of the crowd lie in one value of a band, and are spread over tasks.
    assert met.rdd.getNumPartitions() > 50 and met.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count") * 5 < F.sum("count")).first()[0]


def test_file_size_of_every_document(spark, tmp_path):
    sizes = [0, 1, 1023, 1024, 1280, 1536, 1792, 2304, 1024**2 - 1, 5 * 1024**2 // 4, 7 * 1024**2 // 4, 5 * 1024**3 // 4, *range(2000, 4000)]
    spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    units = [(1024**3, "GB"), (1024**2, "MB"), (1024, "KB"), (1, "B")]
    want = [next(f"{n / u:.1f} {name}" for u, name in units if n >= u or u == 1) for n in sizes]
    got = registry.QUERIES["f13_file_size"](spark, str(tmp_path)).collect()
    assert [r["size"] for r in sorted(got, key=lambda r: r["doc_id"])] == want


def test_checkpoints_are_files_of_their_own_in_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "DOCUMENTS", 30)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("user_id", 1000 + F.col("event_id") % 100)
    events.write.parquet(f"{tmp_path}/events.parquet")
    path = Path(stores._written_checkpoints(spark, str(tmp_path)).removeprefix("file:"))
    assert len(list(path.glob("folder=*"))) == 10
    assert [len(f.read_text().splitlines()) for f in path.glob("folder=*/part-*")] == [1] * 100
    got = registry.QUERIES["s05_checkpoint_scan"](spark, str(tmp_path)).collect()
    assert len(got) == 100 and {r["video_id"] for r in got if not r["broken"]} == {v for v in range(1000, 1100) if v % 11}
    assert {r["video_id"] for r in registry.QUERIES["s08_result_glob"](spark, str(tmp_path)).collect()} == {v for v in range(1000, 1100) if v % 11}
