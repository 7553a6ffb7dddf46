"""The change feed as a stream gives the state of the whole feed, whatever the batches."""

import random

from citelake.operators import changes
from citelake.streaming.replay import FEED, ReplayState, start


def test_batches_in_any_order(spark, tmp_path):
    rng = random.Random(1)
    feed = [(rng.randrange(20), k := 25_000_000 + rng.randrange(12), f"f{k}", rng.random() < 0.3) for _ in range(120)]
    by_file = {}
    for r in feed:
        by_file.setdefault(r[1], []).append(r)
    files = list(by_file.values())
    rng.shuffle(files)
    state = ReplayState(spark, str(tmp_path / "state"))
    for n, rows in enumerate([*files[:6], files[0], *files[6:]]):  # one file comes twice
        spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if n % 4 == 3:
            start(spark, str(tmp_path / "in"), state, str(tmp_path / "cp")).awaitTermination()
    start(spark, str(tmp_path / "in"), state, str(tmp_path / "cp")).awaitTermination()
    want = changes.current_state(spark.createDataFrame(feed, FEED))
    key = lambda df: sorted((r["pmid"], r["source_file"]) for r in df.collect())
    assert key(state.current()) == key(want)


def test_held_back_until_the_gap_is_filled(spark, tmp_path):
    state = ReplayState(spark, str(tmp_path / "s"))
    registry = spark.createDataFrame([(25000001, 1), (25000002, 1), (25000003, 1)], "file_order_key bigint, expected_rows int")
    row = lambda p, k: spark.createDataFrame([(p, k, f"f{k}", False)], FEED)
    shown = lambda: sorted((r["pmid"], r["file_order_key"]) for r in state.current().collect())
    state.apply(row(1, 25000001), 0, registry)
    state.apply(row(1, 25000003), 1, registry)
    assert shown() == [(1, 25000001)]
    state.apply(row(1, 25000003), 1, registry)  # the batch again after a failure
    state.apply(row(2, 25000002), 2, registry)
    assert shown() == [(1, 25000003), (2, 25000002)] and state.part("held").count() == 0


def test_old_copies_go_and_state_stays(spark, tmp_path):
    """Batches touch a few buckets each; copies that no kept version names are removed, untouched ones stay readable."""
    state = ReplayState(spark, str(tmp_path / "s"), buckets=4)
    row = lambda p, k: spark.createDataFrame([(p, k, f"f{k}", False)], FEED)
    for i in range(9):
        state.apply(row(i % 5, 25000001 + i), i)
    assert sorted((r["pmid"], r["file_order_key"]) for r in state.current().collect()) == [(i % 5, 25000001 + i) for i in (5, 6, 7, 8, 4)][:3] + [(3, 25000009), (4, 25000005)]
    named = {(b, v) for b, v in state.manifest()["at"].items()}
    copies = {(b.name[7:], int(v.name[2:])) for v in (tmp_path / "s").glob("v=*") for b in v.glob("last/bucket=*")}
    assert named <= copies and len(copies) < 9
    state.apply(row(7, 25000020), 8)  # the last batch again, with other rows
    assert {r["pmid"] for r in state.current().collect()} == {0, 1, 2, 3, 4, 7}
