"""A log of deltas gives the table that plain upserts give, and writes each batch's rows only."""

import random

import pytest
from pyspark.sql import functions as F

from duologue.plans.registry import DeltaLog
from duologue.streaming import streams

SCHEMA = "k bigint, name string, n bigint, total decimal(28,3)"


def test_runs_in_force():
    log = DeltaLog("f", SCHEMA, ("k",), fanout=3)
    for batches in range(60):
        covered = []
        for level, run in log.live(batches):
            covered += range(run * 3**level, (run + 1) * 3**level)
        assert covered == list(range(batches))
        assert len(log.live(batches)) <= 2 * 4
        gone = set(log.superseded(batches))
        for later in range(batches, 60):
            assert not gone & {log.path(*r) for r in log.live(later)}
    # every run of a higher level is written by the batch that fills it
    made = {r for n in range(60) for r in log.merged_by(n)} | {(0, n) for n in range(60)}
    assert all(r in made for n in range(60) for r in log.live(n))


@pytest.mark.parametrize("fanout", [2, 4])
def test_equals_plain_upserts(spark, tmp_path, fanout):
    rng = random.Random(fanout)
    log = DeltaLog(str(tmp_path / "log"), SCHEMA, ("k",), ("total",), fanout)
    assert log.read(spark).count() == 0 and log.batches(spark) == 0
    table = {}
    for number in range(6):
        rows = {k: (rng.choice(["a", "b", None]), rng.choice([1, None]), rng.randint(0, 9)) for k in rng.sample([None, *range(9)], rng.randint(0, 5))}
        delta = spark.createDataFrame([(k, *v) for k, v in rows.items()], "k bigint, name string, n bigint, total int").withColumn("total", F.col("total").cast("decimal(28,3)"))
        for _ in range(rng.choice([1, 2])):  # the same batch again changes nothing
            log.write(delta, number)
        for k, (name, n, total) in rows.items():
            table[k] = (name, n, total + (table[k][2] if k in table else 0))
        assert {r.k: (r.name, r.n, r.total) for r in log.read(spark).collect()} == table
        assert spark.read.parquet(log.path(0, number)).count() == len(rows)
    assert log.batches(spark) == 6
    assert {r.k for r in log.read(spark, 3).collect()} <= set(table)


TURNS = "conv_id long, pos long, last boolean"


def test_batches_read_their_buckets_only(spark, tmp_path, monkeypatch):
    """Open conversations lie in buckets; a batch opens the files of its own, and closed ones are gone."""
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [
        [(c, 0, False) for c in range(40)],
        [(7, 1, False), (8, 1, True)],
        [(7, 2, True), (8, 2, False), (9, 1, False)],
        [(7, 3, False), (9, 2, True)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, TURNS).coalesce(1).write.mode("append").parquet(source)
    seen, opened = [], []
    monkeypatch.setattr(streams.quality, "validate_turns", lambda turns, minimum: turns)
    plain = streams.open_turns

    def spying(*args):
        kept = plain(*args)
        opened.append((len(args[4]), len({f.rsplit("/", 1)[0] for f in kept.inputFiles()})))
        return kept

    monkeypatch.setattr(streams, "open_turns", spying)
    stream = spark.readStream.schema(TURNS).option("maxFilesPerTrigger", 1).parquet(source)
    streams.validate(stream, folder, closes="last", buckets=16).awaitTermination()
    for number in range(len(batches)):
        rows = spark.read.parquet(f"{folder}/issues/batch={number}").collect()
        seen.append({c: sorted(r.pos for r in rows if r.conv_id == c) for c in {r.conv_id for r in rows}})
    assert seen[1] == {7: [0, 1], 8: [0, 1]}
    assert seen[2] == {7: [0, 1, 2], 8: [2], 9: [0, 1]}  # 8 was closed: its old turns are not read again
    assert seen[3] == {7: [3], 9: [0, 1, 2]}
    assert opened[0][1] == 0 and all(folders <= buckets <= 3 for buckets, folders in opened[1:])
    left = {r.conv_id for r in plain(spark, folder, len(batches), TURNS).collect()}
    assert left == set(range(40)) - {9}
