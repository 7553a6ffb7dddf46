"""From release files to tables, exports and the command line."""

import gzip
import json
import io
import shutil
from pathlib import Path

import pytest
from conftest import ABSTRACT, citation, release

from citelake import cli, loading
from citelake.operators.versions import latest
from citelake.sinks import exports
from citelake.sources import download, xml
from citelake.status import readiness, summarize
from citelake.store import Store, local_files, merge_download


@pytest.fixture
def store(spark, data_dir):
    return Store(spark, str(data_dir / "store"))


@pytest.fixture
def loaded(store, data_dir):
    assert loading.load_files(store, local_files(store, str(data_dir))) == (2, [])
    assert loading.load_journals(store, str(data_dir / "J_Entrez.txt")) == 2
    return store


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def docs_of(paths):
    out = {}
    for p in map(Path, paths):
        with gzip.open(p, "rt", encoding="utf-8") if p.suffix == ".gz" else open(p, encoding="utf-8") as f:
            out |= {d["id"]: d for d in map(json.loads, f)}
    return out


def test_record_fields(data_dir):
    got = list(xml.read((data_dir / "baseline/pubmed30n0001.xml.gz").read_bytes()))
    assert [(w, r["pmid"]) for w, _, r in got] == [("article", 11), ("article", 12), ("article", 13)]
    r = got[0][2]
    assert [(s["label"], s["text"]) for s in r["sections"]] == [("BACKGROUND", "First part."), ("RESULTS", "Second part.")]
    assert r["ids"] == [{"id_type": t, "id_value": v} for t, v in (("doi", "10.1/a"), ("pmc", "PMC1"), ("pii", "X"))]
    assert [(a["position"], a["kind"], a["name"], a["orcid"], a["affiliations"]) for a in r["authors"]] == [
        (1, "author", "Ada Doe", "0000-0001-0000-000X", ["Lab One.", "Lab Two."]), (2, "collective", "The Group", None, []),
    ]
    assert str(r["date_revised"]) == "2021-05-02" and str(r["events"][0]["date"]) == "2019-10-01"
    assert (got[2][2]["pub_year"], got[2][2]["medline_date"]) == (None, "1998 Spring")


def test_season_bad_records_books_and_deletions():
    body = citation(1, date="<Year>1994</Year><Season>Sep-Dec</Season>") + citation(2, title="") + citation("x") + "<PubmedBookArticle/>"
    body += "<DeleteCitation><PMID> 5 </PMID><PMID>²</PMID><PMID>5</PMID></DeleteCitation>"
    got = list(xml.read(f"<PubmedArticleSet>{body}</PubmedArticleSet>".encode()))
    assert [w for w, _, _ in got] == ["article", "failed", "failed", "book", "deleted", "deleted"]
    assert got[0][2]["pub_month"] == "Sep-Dec"


def test_history_latest_and_tombstone(loaded):
    t = loaded.tables()
    assert rows(t["article"], "pmid", "source_file", "pmid_version") == [
        (11, "pubmed30n0001.xml.gz", 1), (11, "pubmed30n0002.xml.gz", 2), (12, "pubmed30n0001.xml.gz", 1), (13, "pubmed30n0001.xml.gz", 1),
    ]
    assert rows(latest(t["article"], t["deleted_pmid"]), "pmid", "article_title") == [(11, "New title."), (13, "Third.")]
    assert rows(t["author_affiliation"], "position", "affiliation") == [(1, "Lab One."), (1, "Lab Two.")]
    assert rows(t["mesh_qualifier"], "pmid", "descriptor_ui", "qualifier_ui")[0] == (11, "D1", "Q1")
    assert rows(loaded.registry(), "file_name", "kind", "n_articles", "n_deletions", "n_failed") == [
        ("pubmed30n0001.xml.gz", "baseline", 3, 0, 0), ("pubmed30n0002.xml.gz", "update", 1, 1, 0),
    ]


def test_reload_replaces_and_nothing_is_due(loaded, data_dir):
    files = local_files(loaded, str(data_dir))
    assert loading.load_files(loaded, files) == (0, [])
    before = rows(loaded.table("article_id"), "pmid", "source_file", "id_value")
    release(data_dir / "baseline", "pubmed30n0001.xml.gz", citation(11, title="Other."))
    assert loading.load_files(loaded, files, force=True) == (2, [])
    assert loaded.table("article").count() == 2  # the file's old rows, also in tables where it has none now, are gone
    assert rows(loaded.table("article_id"), "pmid", "source_file", "id_value") != before
    assert loaded.table("abstract_text").count() == 1
    assert loaded.vacuum() and loaded.table("article").count() == 2


def test_last_record_of_a_pmid_counts(spark, data_dir):
    release(data_dir / "updatefiles", "pubmed30n0003.xml.gz", citation(21, title="First.", abstract=ABSTRACT) + citation(21, title="Last."))
    store = Store(spark, str(data_dir / "s2"))
    loading.load_files(store, [(str(data_dir / "updatefiles/pubmed30n0003.xml.gz"), "update")])
    assert rows(store.table("article"), "article_title") == [("Last.",)] and store.table("abstract_text").count() == 0


def test_broken_file_is_left_out_and_stays_due(loaded, data_dir):
    path = release(data_dir / "updatefiles", "pubmed30n0004.xml.gz", citation(31) * 20)
    path.write_bytes(path.read_bytes()[:-200])
    (data_dir / "updatefiles/notes.xml.gz").write_text("x")
    files = local_files(loaded, str(data_dir))
    assert len(files) == 3
    assert loading.load_files(loaded, files) == (0, ["pubmed30n0004.xml.gz"])
    assert loaded.table("article").where("pmid = 31").count() == 0
    assert loading.load_files(loaded, files) == (0, ["pubmed30n0004.xml.gz"])


def test_one_file(store, data_dir):
    path = str(data_dir / "baseline/pubmed30n0001.xml.gz")
    assert loading.load_file(store, path, "baseline") == 3 and loading.load_file(store, path, "baseline") == 3
    (data_dir / "baseline/pubmed30n0009.xml.gz").write_text("<broken")
    for bad in ("pubmed30n0009.xml.gz", "notes.xml.gz"):
        with pytest.raises(ValueError):
            loading.load_file(store, str(data_dir / "baseline" / bad), "baseline")


def test_journals(loaded, data_dir):
    assert rows(loaded.table("journal"), "nlm_catalog_id", "title", "abbreviation_iso") == [("100001", "Journal: One", "J. One"), ("200002", "Two", None)]
    assert rows(loaded.table("journal_issn"), "nlm_catalog_id", "issn", "issn_type") == [("100001", "1111-2222", "Print"), ("100001", "3333-4444", "Electronic")]
    (data_dir / "empty.txt").write_text("nothing\n")
    assert loading.load_journals(loaded, str(data_dir / "empty.txt")) == 0 and loaded.table("journal").count() == 2


def test_json_export(loaded, data_dir):
    out = data_dir / "json"
    out.mkdir()
    (out / "pubmed_metadata_9.ndjson").write_text('{"id": "PMID:404"}\n')
    (out / "other.txt").write_text("kept")
    docs = docs_of(exports.export_json(loaded.tables(), out))
    assert set(docs) == {"PMID:11", "PMID:13"}
    assert docs["PMID:11"] == {
        "id": "PMID:11", "identifiers": ["PMID:11", "PMCID:PMC2", "doi:10.1/a"], "journal_name": "Journal: One", "journal_abbrev": "J. One", "article_title": "New title.",
        "volume": "5", "issue": "", "pub_year": "2020", "pub_month": "Mar", "pub_day": "06", "pub_date": "2020 Mar 6", "abstract": "Revised.",
    }
    third = docs["PMID:13"]
    assert (third["identifiers"], third["pub_year"], third["pub_month"], third["pub_day"], third["pub_date"], third["journal_name"]) == (["PMID:13"], "1998", "Spring", "", "1998 Spring", "")
    assert None not in third.values() and (out / "other.txt").exists() and not (out / "pubmed_metadata_9.ndjson").exists()
    paths = exports.export_json(loaded.tables(), out, shards=1, gzip_output=False)
    assert [Path(p).name for p in paths] == ["pubmed_metadata_0.ndjson"] == [p.name for p in out.glob("*.ndjson")] and len(list(out.glob("*.ndjson*"))) == 1
    with pytest.raises(ValueError):
        exports.export_json(loaded.tables(), out, shards=0)


def test_unicode_is_not_escaped(spark, data_dir):
    release(data_dir / "updatefiles", "pubmed30n0005.xml.gz", citation(41, title="Größe μ"))
    store = Store(spark, str(data_dir / "s3"))
    loading.load_files(store, local_files(store, str(data_dir)))
    paths = exports.export_json(store.tables(), data_dir / "j3", gzip_output=False)
    assert "Größe μ" in "".join(Path(p).read_text(encoding="utf-8") for p in paths)


def test_parquet_export(loaded, data_dir, spark):
    out = data_dir / "pq"
    (out / "gone.parquet").mkdir(parents=True)
    assert len(exports.export_parquet(loaded.tables(), out)) == 15 and not (out / "gone.parquet").exists()
    assert spark.read.parquet(str(out / "article.parquet")).count() == 2 and spark.read.parquet(str(out / "author.parquet")).count() == 0
    exports.export_parquet(loaded.tables(), out, latest_only=False)
    assert spark.read.parquet(str(out / "article.parquet")).count() == 4 and spark.read.parquet(str(out / "author.parquet")).count() == 2


def test_manifest(spark, tmp_path):
    exports.write_manifest(spark.createDataFrame([(5,), (10,), (5,), (2,)], "pmid bigint"), tmp_path / "m.txt.gz")
    assert gzip.open(tmp_path / "m.txt.gz", "rt").read() == "2\n5\n10\n"
    (tmp_path / "p.txt").write_text("7\n\n 8 \n")
    assert rows(exports.read_manifest(spark, tmp_path / "p.txt"), "pmid") == [(7,), (8,)]


def test_status(store, loaded):
    s = summarize(loaded)
    want = {"known_files": 2, "downloaded_files": 2, "baseline_files": 1, "update_files": 1, "baseline_years": [30], "loaded_files": 2, "pending_files": 0, "skipped_records": 0, "article_versions": 4, "latest_documents": 2, "journals": 2}
    assert {k: s[k] for k in want} == want and len(s) == 14 and s["journals_refreshed"] is not None
    assert readiness(loaded) == (None, [])
    assert readiness(Store(store.spark, store.root + "-none"))[0]


def test_download_decisions():
    d = download.decide
    assert d(False, None, "a", False) == download.Decision("a", True, False, True)
    assert d(True, "a", "a", True) == download.Decision("a", False, False, False)
    assert d(True, "a", "a", False) == download.Decision("a", False, False, True)
    assert d(True, "a", "b", True) == download.Decision("b", True, True, True)
    assert d(True, "a", None, True) == download.Decision("a", False, False, False)
    assert d(True, None, None, True) == download.Decision(None, False, False, False)
    assert d(True, None, "a", True) == download.Decision("a", True, False, True)


def test_sync_discards_a_file_corrupt_twice(tmp_path):
    good = "5d41402abc4b2a76b9719d911017c592"  # of hello
    sent = {"b": ["hello"], "a": ["bad", "hello"], "c": ["bad", "bad"]}

    def fetch(name, path):
        path.write_text(sent[name].pop(0))

    got = download.sync_kind(["c", "b", "a"], "baseline", tmp_path, {}, lambda n: f"MD5({n})= {good}", fetch)
    assert [(s.file_name, s.changed) for s in got] == [("b", True), ("a", True)] and not (tmp_path / "c").exists()
    got = download.sync_kind(["b", "a"], "baseline", tmp_path, {"b": good}, lambda n: "error page", fetch, limit=1)
    assert got == [download.Synced("b", "baseline", good, False)]


def test_command_line(spark, data_dir, capsys):
    mirror = data_dir / "mirror"
    for f in ("baseline", "updatefiles"):
        shutil.move(data_dir / f, mirror / f)
        for p in (mirror / f).iterdir():
            (mirror / f / f"{p.name}.md5").write_text(download.file_md5(p))
    base = ["--data-dir", str(data_dir)]
    assert cli.main([*base, "load"]) == 1
    assert cli.main([*base, "export", "--format", "json", "--out", str(data_dir / "x")]) == 1
    assert cli.main([*base, "update", "--mirror", str(mirror)]) == 0
    assert cli.main([*base, "download", "--mirror", str(mirror)]) == 0
    assert "2 file(s), 0 new or changed" in capsys.readouterr().out
    out = data_dir / "out"
    assert cli.main([*base, "export", "--format", "json", "--out", str(out), "--latest"]) == 0
    assert "no effect" in capsys.readouterr().out
    assert cli.main([*base, "validate", str(out), "--manifest", str(data_dir / "m.gz"), "--out", str(data_dir / "r.json"), "--fail-on-warn", "--offline"]) == 0
    assert (data_dir / "m.gz").exists() and json.loads((data_dir / "r.json").read_text())["status"] == "pass"
    assert cli.main([*base, "status"]) == 0
    assert '"latest_documents": 2' in capsys.readouterr().out
    assert cli.main([*base, "validate", str(out), "--no-online"]) == 0 and json.loads((out / "validation_report.json").read_text())["inputs"]["online"] is False
    assert cli.main([*base, "sql", "select 'titles', count(*) from latest_article join journal using (nlm_catalog_id)"]) == 0
    assert "titles" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main([*base, "export", "--format", "json", "--out", "x", "--shards", "0"])


def test_groups_are_committed_as_they_are_done(store, data_dir, monkeypatch):
    """A run that dies in its second group keeps the first; the next run takes what is left."""
    for i in range(3, 9):
        release(data_dir / "updatefiles", f"pubmed30n{i:04d}.xml.gz", citation(100 + i))
    files, scan = local_files(store, str(data_dir)), xml.scan
    calls = []

    def dying(content):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return scan(content)

    monkeypatch.setattr(xml, "scan", dying)
    with pytest.raises(RuntimeError):
        loading.load_files(store, files, group=1)  # as many as there are cores
    first = store.registry().where("load_id is not null").count()
    assert 0 < first < 8 and store.table("article").select("source_file").distinct().count() == first
    assert loading.load_files(store, files) == (8 - first, [])
    assert store.table("article").where("pmid > 100").count() == 6


def test_two_writers_lose_nothing(store):
    new = lambda name: store.spark.createDataFrame([(name, "update", None, True)], "file_name string, kind string, published_md5 string, changed boolean").selectExpr("*", "timestamp '2026-01-01' as at")
    once = []

    def slow(registry):
        if not once:  # another writer commits while this one builds
            once.append(1)
            store.merge_registry(lambda r: merge_download(r, new("pubmed30n0001.xml.gz")))
        return merge_download(registry, new("pubmed30n0002.xml.gz"))

    store.merge_registry(slow)
    assert rows(store.registry(), "file_name") == [("pubmed30n0001.xml.gz",), ("pubmed30n0002.xml.gz",)]
    for i in range(3, 8):
        store.merge_registry(lambda r, i=i: merge_download(r, new(f"pubmed30n000{i}.xml.gz")))
    assert store.registry().count() == 7 and len([n for n in store.files.names(f"{store.root}/_source_file") if n.startswith("data-")]) == store.KEEP


def test_vacuum_spares_a_running_load(loaded):
    load_id = loaded.begin()
    loaded.append("article", loaded.table("article"), load_id)
    assert loaded.vacuum() == [] and loaded.vacuum(hours=0) == [f"article/load_id={load_id}"]
    assert loaded.table("article").count() == 4


def test_web_listing_and_fetch(tmp_path):
    pages = {
        "u/": b'<a href="../">up</a><a href="pubmed30n0002.xml.gz">x</a><a href="pubmed30n0002.xml.gz.md5">x</a><a href="pubmed30n0010.xml.gz">x</a><a href="README.txt">x</a>',
        "u/pubmed30n0010.xml.gz": b"hello", "u/pubmed30n0010.xml.gz.md5": b"MD5(x)= 5d41402abc4b2a76b9719d911017c592",
    }
    web = download.Web("u/", lambda url, timeout: io.BytesIO(pages[url]))
    assert web.listing() == ["pubmed30n0010.xml.gz", "pubmed30n0002.xml.gz"]
    got = download.sync_kind(web.listing(), "update", tmp_path, {}, web.sidecar, web.fetch, limit=1)
    assert [(s.file_name, s.changed) for s in got] == [("pubmed30n0010.xml.gz", True)] and [p.name for p in tmp_path.iterdir()] == ["pubmed30n0010.xml.gz"]


def test_views(loaded):
    assert "latest_article" in loaded.views()
    assert loaded.spark.sql("select count(*) from latest_article").first()[0] == 2


def test_small_files_share_tasks_and_commits(spark, tmp_path):
    """Many small files are read by no more tasks than there are cores, and with ``least`` committed together."""
    for i in range(1, 301):
        release(tmp_path / "updatefiles", f"pubmed30n{i:04d}.xml.gz", citation(i) + citation(i, title="Last.") * (i % 2))
    staged, commits = [], []
    for name, sizes in (("a", {"group": 300}), ("b", {"group": 100}), ("c", {"group": 100, "least": 1 << 20})):
        store = Store(spark, str(tmp_path / name))
        assert loading.load_files(store, local_files(store, str(tmp_path)), keep_staging=True, **sizes) == (300, [])
        assert store.table("article").count() == 300 and store.table("article").where("article_title = 'Last.'").count() == 150
        staged.append([len([n for n in store.files.names(f"{tmp_path}/{name}/_staging/{i}") if n.startswith("part-")]) for i in store.files.names(f"{tmp_path}/{name}/_staging")])
        commits.append(len([n for n in store.files.names(f"{tmp_path}/{name}/_source_file") if n.startswith("commit-")]))
    assert commits == [1, 3, 1] and all(n <= spark.sparkContext.defaultParallelism for s in staged for n in s)


def test_a_tree_gives_what_the_stream_gives(data_dir, monkeypatch):
    path = data_dir / "baseline/pubmed30n0001.xml.gz"
    whole = path.read_bytes() if path.exists() else b""
    plain = gzip.decompress(whole).replace(b"</PubmedArticleSet>", b"<DeleteCitation><PMID>7</PMID></DeleteCitation><PubmedBookArticle/></PubmedArticleSet>")
    contents = [whole, plain, whole[:-200], plain[:-40], b""]
    trees = [list(xml.read(c)) for c in contents]
    monkeypatch.setattr(xml, "TREE", 0)
    assert trees == [list(xml.read(c)) for c in contents] and [t[-1][0] for t in trees] == ["article", "book", "broken", "broken", "broken"]


def test_names_of_a_folder(spark, store, tmp_path):
    (tmp_path / "names/b").mkdir(parents=True)
    for n in ("a 1.txt", ".hidden", "é"):
        (tmp_path / "names" / n).write_text("x")
    assert store.files.names(f"{tmp_path}/names") == ["a 1.txt", "b", "é"] == [n for n, _, _ in store.files.list(f"{tmp_path}/names")]
    assert store.files.names(f"{tmp_path}/names/b") == store.files.names(f"{tmp_path}/absent") == []
