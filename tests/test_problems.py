"""The general data problems: hand-made cases, nulls, ties, repeats, empty tables, and small random tables against brute force."""

import json
import random
from datetime import datetime, timedelta

import pytest
from citelake.operators import changes, diff, increments, nested, orphans
from pyspark.sql import functions as F


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=repr)


# ---- nested records


def payload(**parts):
    return json.dumps({"MedlineCitation": {"Article": {"AuthorList": {"Author": parts.get("authors")}, "Abstract": {"AbstractText": parts.get("text")}}, "MeshHeadingList": {"MeshHeading": parts.get("mesh")}}, "PubmedData": {"ReferenceList": {"Reference": [{"AuthorList": {"Author": [{"LastName": "Cited"}]}}]}}})


def test_nested_shapes(spark):
    person = {"LastName": "A", "AffiliationInfo": [{"Affiliation": "x"}, None, {"Affiliation": "y"}], "Affiliation": "z"}
    data = [
        (1, payload(authors=[person, {"CollectiveName": "G"}, None, "plain"], text=["one", {"value": "two", "Label": "L"}, {"value": "three"}], mesh={"Descriptor": {"UI": "D", "value": "d"}, "Qualifier": [{"UI": "Q1"}, {"value": "n"}]})),
        (1, payload(authors=[person, {"CollectiveName": "G"}, None, "plain"], text=["one", {"value": "two", "Label": "L"}, {"value": "three"}], mesh={"Descriptor": {"UI": "D", "value": "d"}, "Qualifier": [{"UI": "Q1"}, {"value": "n"}]})),
        (2, payload(authors={"LastName": "B", "AffiliationInfo": {"Affiliation": "w"}}, text="bare", mesh=[])),
        (3, payload(text="")), (4, "{broken"), (5, None), (6, ""), (7, "[]"), (8, "{}"), (9, '{"MedlineCitation": "text"}'), (10, "[" * 100000),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in data], "record_id bigint, payload string, state string")
    got = rows(nested.children(df))
    assert got == sorted([
        (1, "author", 0, 1, ""), (1, "author", 0, 2, ""), (1, "author", 0, 4, ""), (1, "author_affiliation", 1, 1, ""), (1, "author_affiliation", 1, 3, ""), (1, "author_affiliation", 1, 4, ""),
        (1, "abstract_text", 0, 0, ""), (1, "abstract_text", 0, 1, ""), (1, "abstract_text", 0, 2, ""), (1, "mesh_qualifier", 1, 1, "Q1"), (1, "mesh_qualifier", 1, 2, ""),
        (2, "author", 0, 1, ""), (2, "author_affiliation", 1, 1, ""), (2, "abstract_text", 0, 0, ""),
    ], key=repr)
    t = nested.tables(df)
    assert rows(t["reject"]) == [(10,), (4,), (5,), (6,), (7,)]
    assert rows(t["author_collective"], "record_id", "child_pos", "collective_name") == [(1, 2, "G")]
    assert rows(t["affiliation_text"], "record_id", "child_pos", "affiliation") == [(1, 4, "z")]
    assert rows(t["section_labelled"], "record_id", "child_pos", "label", "text") == [(1, 1, "L", "two")]
    assert rows(t["section_text"], "record_id", "child_pos", "text") == [(1, 0, "one"), (2, 0, "bare")]
    assert all(nested.tables(df.limit(0))[n].count() == 0 for n in ("reject", "author_person"))


def test_nested_shapes_without_a_rule(spark):
    authors = [{"LastName": "A", "AffiliationInfo": [{"Identifier": "i"}, ["x"]]}, [{"LastName": "B"}]]
    one = payload(authors=authors, text=[{"Label": "METHODS", "value": None}, ["y"]], mesh=["plain", {"Qualifier": [["q"]]}, ["z"]])
    df = spark.createDataFrame([(1, one)], "record_id bigint, payload string")
    assert rows(nested.children(df)) == sorted([
        (1, "author", 0, 1, ""), (1, "author", 0, 2, ""), (1, "author_affiliation", 1, 1, ""), (1, "author_affiliation", 1, 2, ""), (1, "mesh_qualifier", 2, 1, ""),
        (1, "abstract_text", 0, 0, ""), (1, "abstract_text", 0, 1, ""),
    ], key=repr)
    t = nested.tables(df)
    assert rows(t["heading_text"]) == [(1, 0, 1, "plain")]
    assert rows(t["other"], "sort", "parent_pos", "child_pos", "content") == sorted([
        ("author", 0, 2, '[{"LastName": "B"}]'), ("affiliation", 1, 1, '{"Identifier": "i"}'), ("affiliation", 1, 2, '["x"]'), ("heading", 0, 3, '["z"]'), ("qualifier", 2, 1, '["q"]'),
        ("section", 0, 0, '{"Label": "METHODS", "value": null}'), ("section", 0, 1, '["y"]'),
    ], key=repr)


def test_states_come_from_below():
    info = {"Affiliation": "x"}
    cases = [
        (None, "absent"), ("x", "text"), (3, "text"), ([], "empty"), ([None], "empty"), (["a", None, "b"], "many:text"), (["a", info], "mixed"), ([info, info], "many:info"), (info, "info"),
        ({"LastName": "A", "AffiliationInfo": [info, None]}, "person_info"), ({"LastName": "A", "AffiliationInfo": [info, "x"]}, "person"), ({"LastName": "A", "Affiliation": ["x"]}, "person_bare"),
        ({"LastName": {}, "CollectiveName": "G"}, "collective"), ({"value": {"i": "x"}, "Label": "L"}, "object"), ({"value": "x", "Label": None}, "valued"), ({"value": "x", "Label": "L"}, "labelled"), ({}, "object"),
    ]
    assert [(x, nested.state(x)) for x, _ in cases] == cases


# ---- increments

T0 = datetime(2025, 1, 1)


def at(h):
    return None if h is None else T0 + timedelta(hours=h)


REG = "file_name string, published_md5 string, downloaded_at timestamp, processed_at timestamp"
LOG = "attempt_id bigint, file_name string, started_at timestamp, finished_at timestamp, status string, loaded_md5 string"


def reg(spark, *data):
    return spark.createDataFrame([(n, m, at(d), at(p)) for n, m, d, p in data], REG)


def attempts(spark, *data):
    return spark.createDataFrame([(i, n, at(s), at(f), st, m) for i, n, s, f, st, m in data], LOG)


def test_pending_rules(spark):
    r = reg(
        spark, ("never", "aa", 1, None), ("never", "aa", 1, None), ("no-time", "aa", None, None), ("same", "0x00AA", 9, 2), ("moved", "ab", 1, 2), ("unknown-late", None, 3, 2), ("unknown-early", None, 1, 2),
        ("no-log-late", "aa", 3, 2), ("no-log-early", "aa", 1, 2), ("junk", "xyz", 3, 2), ("tie", "bb", 1, 2), ("failed-later", "aa", 1, 2), ("null-log", "aa", 3, 2), (None, "aa", 3, None),
    )
    log = attempts(
        spark, (1, "same", 0, 1, "ok", "A-A"), (2, "moved", 0, 1, "ok", "aa"), (3, "unknown-late", 0, 1, "ok", "aa"), (4, "unknown-early", 0, 1, "ok", "aa"), (5, "junk", 0, 1, "ok", "aa"),
        (6, "tie", 0, 1, "ok", "aa"), (7, "tie", 0, 1, "ok", "bb"), (8, "failed-later", 0, 1, "ok", "aa"), (9, "failed-later", 2, 3, "failed", "cc"), (9, "failed-later", 2, 3, "failed", "cc"),
        (10, "null-log", 0, 1, "ok", None), (11, "moved", 2, None, None, "ab"),
    )
    got = rows(increments.pending(r, increments.processed_ledger(log)), "file_name", "reason")
    assert got == [
        ("junk", "newer_download"), ("moved", "version_changed"), ("never", "never_processed"), ("never", "never_processed"), ("no-log-late", "newer_download"), ("null-log", "newer_download"),
        ("unknown-late", "newer_download"),
    ]
    empty = increments.processed_ledger(log.limit(0))
    assert rows(increments.pending(r.where("file_name = 'moved'"), empty), "file_name") == [] and increments.pending(r.limit(0), empty).count() == 0


def test_rereading_from_the_oldest_open_attempt(spark):
    """An attempt open at the last run finishes later: reading from the mark finds it, and nothing twice."""
    first = attempts(spark, (1, "a", 0, 1, "ok", "01"), (2, "slow", 2, None, None, "02"), (3, "b", 3, 4, "ok", "03"))
    last, mark = increments.low_water_mark(first)
    assert (last, mark) == (at(4), at(2))
    ledger = increments.processed_ledger(first)
    later = attempts(spark, (1, "a", 0, 1, "ok", "01"), (2, "slow", 2, 6, "ok", "02"), (3, "b", 3, 4, "ok", "03"), (4, "a", 5, 7, "ok", "04"))
    whole = rows(increments.processed_ledger(later))
    assert rows(increments.processed_ledger(later, ledger, mark)) == whole
    assert [r[0] for r in whole] == ["a", "b", "slow"] and whole[0][3] == "4"
    assert increments.low_water_mark(first.limit(0)) == (None, None)


@pytest.mark.parametrize("seed", range(4))
def test_second_run_gives_the_whole_log(spark, seed):
    """Ledger and mark of any earlier moment and what is read again from the mark make the ledger of the whole log."""
    rng = random.Random(seed)
    log = []
    for i in range(60):
        start = rng.randrange(40)
        end = rng.choice([None, start + rng.randrange(15)])
        log.append((i, rng.choice("abcdefgh"), start, end, rng.choice(["ok", "failed"]) if end is not None else None, f"{i:x}"))
    df = attempts(spark, *log, *log[:5])
    whole = rows(increments.processed_ledger(df))
    for moment in (0, 17, 30, 60):
        then = increments.as_of(df, at(moment))
        _, mark = increments.low_water_mark(then)
        assert rows(increments.processed_ledger(df, increments.processed_ledger(then), mark)) == whole


def test_runs_survive_failures(spark, tmp_path):
    """A run that fails before its commit is given the same records again; after it, only what is new since."""
    runs = increments.Runs(spark, str(tmp_path / "runs"))
    r = reg(spark, ("a", "01", 1, None), ("b", "02", 1, None), ("slow", "03", 1, None))
    none = spark.createDataFrame([], LOG)
    assert rows(runs.begin(r, none).due, "file_name") == [("a",), ("b",), ("slow",)]
    assert rows(runs.begin(r, none).due, "file_name") == [("a",), ("b",), ("slow",)]
    log = attempts(spark, (1, "a", 2, 3, "ok", "01"), (2, "b", 2, 3, "failed", "02"), (3, "slow", 2, None, None, "03"))
    runs.commit(log)
    (tmp_path / "runs/v=99999999999999999999").mkdir()  # a commit that was cut short
    r2 = reg(spark, ("a", "01", 1, 3), ("b", "02", 1, None), ("slow", "03", 1, None))
    assert rows(runs.begin(r2, log).due, "file_name") == [("b",), ("slow",)]
    log2 = log.union(attempts(spark, (3, "slow", 2, 8, "ok", "03"), (4, "b", 6, 7, "ok", "02")))
    r3 = reg(spark, ("a", "0f", 9, 3), ("b", "02", 1, 7), ("slow", "03", 1, 8))
    assert rows(runs.begin(r3, log2).due, "file_name", "reason") == [("a", "version_changed")]
    runs.commit(log2)
    assert rows(runs.begin(r3, log2).ledger) == rows(increments.processed_ledger(log2))


# ---- change replay

FEED = "pmid bigint, file_order_key bigint, source_file string"


def feed(spark, *data):
    return spark.createDataFrame(list(data), FEED)


def test_replay_order_ties_and_repeats(spark):
    up = feed(spark, (1, 5, "e"), (1, 3, "c"), (1, 5, "e"), (2, 4, "d"), (3, 4, "d"), (4, 6, "f"), (4, 6, "g"), (None, 1, "x"), (5, None, "x"))
    de = feed(spark, (2, 4, "d"), (2, 4, "d"), (3, 3, "c"), (9, 9, "z"), (1, None, "x"))
    assert rows(changes.replay(up, de), "pmid", "source_file") == [(1, "e"), (3, "d"), (4, "g")]
    assert changes.replay(up.limit(0), de).count() == 0 and changes.replay(up, de.limit(0)).count() == 4


def test_gaps_and_incomplete_transactions_hold_state_back(spark):
    up = feed(spark, (1, 25000001, "a"), (1, 25000002, "b"), (1, 25000004, "d"), (2, 26000001, "e"))
    de = up.limit(0)
    registry = lambda *r: spark.createDataFrame(list(r), "file_order_key bigint, expected_rows int")
    full = [(25000001, 1), (25000002, 1), (25000003, None), (25000004, 1), (26000001, 1)]
    assert rows(changes.replay(up, de, registry(*full)), "pmid", "source_file") == [(1, "b")]
    seen = up.union(feed(spark, (7, 25000003, "c")))
    assert rows(changes.replay(seen, de, registry(*full)), "pmid", "source_file") == [(1, "d"), (2, "e"), (7, "c")]
    short = [(k, 2 if k == 25000002 else n) for k, n in full]
    assert rows(changes.replay(seen, de, registry(*short)), "pmid", "source_file") == [(1, "a")]


def test_empty_transactions_hold_nothing_back(spark):
    up = feed(spark, (1, 25000001, "a"), (1, 25000003, "c"))
    registry = lambda n: spark.createDataFrame([(25000001, 1), (25000002, n), (25000003, 1)], "file_order_key bigint, expected_rows int")
    assert rows(changes.replay(up, up.limit(0), registry(0)), "pmid", "source_file") == [(1, "c")]
    assert rows(changes.replay(up, up.limit(0), registry(None)), "pmid", "source_file") == [(1, "a")]


def test_transactions_the_registry_does_not_know_hold_state_back(spark):
    up = feed(spark, (1, 25000001, "a"), (1, 25000002, "b"), (2, 25000003, "c"))
    registry = spark.createDataFrame([(25000001, 1), (25000003, 1), (None, 1)], "file_order_key bigint, expected_rows int")
    assert rows(changes.replay(up, up.limit(0), registry), "pmid", "source_file") == [(1, "a")]


def test_no_watermark_is_sought_without_a_registry(spark):
    """Nothing could be held back, so no job runs before the state is asked for; with a registry the gap holds."""
    up = feed(spark, (1, 25000001, "a"), (1, 25000003, "c"), (2, 25000001, "a"))
    registry = spark.createDataFrame([(25000001, 2), (25000002, 1), (25000003, 1)], "file_order_key bigint, expected_rows int")
    sc = spark.sparkContext

    def replayed(group, *registry):
        sc.setJobGroup(group, group)
        try:
            state = changes.replay(up, up.limit(0), *registry)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        sc._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        return len(sc.statusTracker().getJobIdsForGroup(group)), rows(state, "pmid", "source_file")

    jobs, state = replayed("with a registry", registry)
    assert jobs and state == [(1, "a"), (2, "a")]
    assert replayed("without a registry") == (0, [(1, "c"), (2, "a")])


def test_replay_against_brute_force(spark):
    rng = random.Random(3)
    up = [(rng.randrange(40), rng.randrange(30), None) for _ in range(300)]
    up = [(p, k, f"f{k}") for p, k, _ in up]
    de = [(rng.randrange(50), k := rng.randrange(30), f"f{k}") for _ in range(60)]
    want = []
    for p in {r[0] for r in up}:
        k = max(r[1] for r in up if r[0] == p)
        if not any(d[0] == p and d[1] >= k for d in de):
            want.append((p, f"f{k}"))
    assert rows(changes.replay(feed(spark, *up), feed(spark, *de)), "pmid", "source_file") == sorted(want, key=repr)


# ---- orphans


def test_orphans_against_brute_force(spark):
    rng = random.Random(5)
    shape = lambda: rng.choice(["{:07d}", "{:08d}", "{}", "{:07d}R", "{} ", "x{}"]).format(rng.choice([rng.randrange(60), 1020 + rng.randrange(10), 10**17 + rng.randrange(3)]))
    parents = [shape() for _ in range(150)] + [None, ""]
    refs = [(i, shape()) for i in range(400)] + [(900, None), (901, ""), (902, "é"), (903, "9" * 30), (903, "9" * 30)]
    p = spark.createDataFrame([(k, 1) for k in parents], "k string, run_start int")
    r = spark.createDataFrame([(i, k) for i, k in refs], "i int, k string")
    got = rows(orphans.orphans(r, p, "k", "k"))
    assert got == sorted(((i, k) for i, k in refs if k is not None and k not in parents), key=repr)
    assert orphans.orphans(r, p.limit(0), "k", "k").count() == len([1 for _, k in refs if k is not None])
    assert orphans.orphans(r.limit(0), p, "k", "k").count() == 0


def test_runs_and_release_year(spark):
    p = spark.createDataFrame([("01",), ("02",), ("02",), ("04",), (None,), ("5",)], "k string")
    assert rows(orphans.runs(p, "k"), "__class", "run_start", "run_end") == [("1", 5, 5), ("2", 1, 2), ("2", 4, 4)]
    df = spark.createDataFrame([("pubmed25n0001.xml.gz",), ("odd",), (None,)], "f string")
    assert [r[0] for r in df.select(orphans.release_year(F.col("f"))).collect()] == [25, None, None]


def test_other_columns_with_working_names_are_kept(spark):
    r = spark.createDataFrame([("1", 5, 6, 7)], "k string, run_start int, run_end int, side int")
    p = spark.createDataFrame([("2", 5)], "k string, run_end int")
    assert rows(orphans.orphans(r, p, "k", "k")) == [("1", 5, 6, 7)]
    g = reg(spark, ("a", "01", 1, None)).selectExpr("*", "1 as version", "2 as known", "3 as done_name")
    got = increments.pending(g, increments.processed_ledger(spark.createDataFrame([], LOG)))
    assert rows(got, "file_name", "version", "known", "done_name", "reason") == [("a", 1, 2, 3, "never_processed")]
    a = spark.createDataFrame([(1, "x", "p")], "k1 int, k0 string, bucket string")
    b = spark.createDataFrame([(1, "y", "q")], "k1 int, k0 string, bucket string")
    assert rows(diff.differences(a, b, ["k1"], ["k0", "bucket"])) == [(1, "bucket", "p", "q"), (1, "k0", "x", "y")]


# ---- differences

COPY = "pmid bigint, source_file string, title string, n int"


def test_differences_by_hand(spark):
    a = spark.createDataFrame([(1, "f", "x", 1), (1, "f", "x", 1), (2, "f", None, 1), (3, "f", "x", None), (4, "f", "x", 1), (None, None, "x", 1), (6, "f", "x", 1), (6, "f", "y", 1), (7, "f", "", 1)], COPY)
    b = spark.createDataFrame([(1, "f", "x", 1), (2, "f", "x", 1), (3, "f", "x", None), (5, "f", "x", 1), (None, None, "y", 1), (6, "f", "x", 1), (7, "f", None, 2)], COPY)
    got = rows(diff.differences(a, b, ["pmid", "source_file"], ["title", "n"], "a", "b"))
    assert [r[3:] for r in got if r[:2] == (7, "f")] == [("1", "2"), ("", None)] and [r[3:] for r in got if r[0] in (2, 4, 6)] == [(None, "x"), (None, None), ("x", "x")]
    assert [r[:3] for r in got] == sorted([(2, "f", "title"), (4, "f", "a"), (5, "f", "b"), (None, None, "title"), (6, "f", "title"), (7, "f", "n"), (7, "f", "title")], key=repr)
    none = a.limit(0)
    assert len(rows(diff.differences(a, none, ["pmid", "source_file"], ["title"]))) == 7
    assert rows(diff.differences(none, none, ["pmid", "source_file"], ["title"])) == []


def test_differences_against_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    some = lambda n: [(rng.choice([None, *range(12)]), rng.choice(["f", "g", None]), rng.choice(["x", "y", None, ""]), rng.choice([1, None])) for _ in range(n)]
    x, y = some(40), some(40)
    want = set()
    for k in {r[:2] for r in x + y}:
        here, there = [r[2:] for r in x if r[:2] == k], [r[2:] for r in y if r[:2] == k]
        if not here or not there:
            want.add((*k, "a" if here else "b"))
            continue
        want |= {(*k, f) for i, f in enumerate(("title", "n")) if len({r[i] for r in here + there}) > 1}
    a, b = spark.createDataFrame(x, COPY), spark.createDataFrame(y, COPY)
    got = rows(diff.differences(a, b, ["pmid", "source_file"], ["title", "n"], "a", "b", keys_per_bucket=5))
    assert {r[:3] for r in got} == want and len(got) == len(want)
    monkeypatch.setattr(diff, "CHUNK", 3)  # profiles of a key from several pieces
    assert rows(diff.differences(a.coalesce(1), b.coalesce(1), ["pmid", "source_file"], ["title", "n"], "a", "b", keys_per_bucket=5)) == got
