"""Checks of an export folder, end to end."""

import gzip
import json

import pytest
from citelake.operators.documents import FIELDS
from citelake.sinks import exports
from citelake.validate import checks, report, run_validation
from citelake.validate.fields import compare, groups
from citelake.validate.report import format_summary


def doc(pmid, **over):
    d = dict.fromkeys(FIELDS, "x") | {"id": f"PMID:{pmid}", "identifiers": [f"PMID:{pmid}", "doi:10.1/a"], "pub_month": "Mar", "pub_year": "2020", "pub_day": "6", "pub_date": "2020 Mar 6"}
    return d | over


def put(folder, docs, name="pubmed_metadata_0.ndjson"):
    folder.mkdir(exist_ok=True)
    lines = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return folder


def tables(spark, current, deleted=()):
    a = spark.createDataFrame([(p, "f", 1, None) for p in current], "pmid bigint, source_file string, file_order_key bigint, loaded_at timestamp")
    d = spark.createDataFrame([(p, "f", 1) for p in deleted], "pmid bigint, source_file string, file_order_key bigint")
    return {"article": a, "deleted_pmid": d}


def status(report):
    return {c["name"]: (c["status"], c["code"], c["count"]) for c in report["checks_run"]}


def test_clean_export(spark, tmp_path):
    put(tmp_path / "e", [doc(1), "", doc(2)])
    served = {p: doc(p) for p in (1, 2)}
    r = run_validation(spark, tmp_path / "e", tables(spark, [1, 2], [3]), total=lambda: 2, fetch=lambda ps: {p: served[p] for p in ps if p in served}, manifest_out=tmp_path / "m.gz")
    assert r["status"] == "pass" and r["errors"] == r["warnings"] == [] and len(r["checks_run"]) == 21
    assert gzip.open(tmp_path / "m.gz", "rt").read() == "1\n2\n"
    s = r["checks"]["structure"]
    assert s["records_total"] == 2 and s["records_per_shard"] == {"pubmed_metadata_0.ndjson": 2}
    assert s["identifier_prefixes"]["doi"] == {"records": 2, "pct": 100.0}
    assert r["checks"]["deletions"]["confirmed_deleted"] == [3]
    assert {c["name"] for c in r["checks_run"] if c["status"] == "skip"} == {"vs-previous", "pmid-set-diff"}
    assert "STRUCTURE" in format_summary(r) and "values_differ: 0" in format_summary(r)


def test_structure_findings(spark, tmp_path):
    short = doc(5)
    del short["issue"], short["volume"]
    put(tmp_path / "e", ["{broken", "[1]", "3", doc(1), doc(1), doc(2, pub_month="Dec-1999 Jan"), doc(3, extra="y"), doc(4, volume=None), short, doc(0, id="X:1"), doc(6, pub_month="Spring-Fall")])
    r = run_validation(spark, tmp_path / "e", manifest_out=tmp_path / "m.gz")
    got = status(r)
    assert got["json-parse"] == ("fail", "malformed_json", 3) and got["record-fields"] == ("fail", "missing_fields", 2)
    assert got["no-nulls"] == ("fail", "null_values", 1) and got["id-format"] == ("fail", "invalid_ids", 1) and got["pmid-unique"] == ("fail", "duplicate_pmids", 1)
    assert got["no-extra-fields"] == ("warn", "extra_fields", 1) and got["month-format"] == ("warn", "invalid_months", 1)
    assert r["status"] == "fail" and not (tmp_path / "m.gz").exists() and r["checks"]["structure"]["duplicate_pmids"] == [1]
    assert r["checks"]["structure"]["records_total"] == 8


def test_no_shards_and_truncated_shard(spark, tmp_path):
    (tmp_path / "e").mkdir()
    r = run_validation(spark, tmp_path / "e")
    assert [e["code"] for e in r["errors"]] == ["no_shards", "no_records"]
    put(tmp_path / "e", [doc(1)])
    whole = gzip.compress("\n".join(json.dumps(doc(i)) for i in range(500)).encode())
    (tmp_path / "e/pubmed_metadata_1.ndjson.gz").write_bytes(whole[: len(whole) // 2])
    r = run_validation(spark, tmp_path / "e")
    assert [e["code"] for e in r["errors"]] == ["unreadable_shard"] and r["checks"]["structure"]["records_total"] == 1


def test_coverage_deletions_and_drops(spark, tmp_path):
    put(tmp_path / "e", [doc(p) for p in range(1, 11)])
    exports.write_manifest(spark.createDataFrame([(p,) for p in range(1, 14)], "pmid bigint"), tmp_path / "old.gz")
    (tmp_path / "old.json").write_text(json.dumps({"checks": {"coverage": {"pct_of_entrez": 1.0, "exported_count": 13}}}))
    kw = {"previous_manifest": tmp_path / "old.gz", "previous_report": tmp_path / "old.json"}
    r = run_validation(spark, tmp_path / "e", tables(spark, [*range(1, 12), 14], [10, 12]), total=lambda: 20, **kw)
    got = status(r)
    assert got["vs-entrez"][:2] == ("warn", "coverage_out_of_band") and got["vs-database"] == ("fail", "export_shortfall", 1) and got["vs-previous"][:2] == ("warn", "coverage_drift")
    assert got["pmid-set-diff"] == ("fail", "unexplained_drops", 2) and r["checks"]["drops_since_previous"]["explained_by_deletion"] == [12]
    assert got["deleted-absent"] == ("fail", "deleted_pmid_exported", 1) and r["checks"]["deletions"]["present_in_export"] == [10]
    r = run_validation(spark, tmp_path / "e", None, **kw)
    assert status(r)["pmid-set-diff"] == ("warn", "drops_unattributed", 3)
    r = run_validation(spark, tmp_path / "e", tables(spark, []), **kw)
    assert status(r)["vs-database"][0] == "n/a" and status(r)["deleted-gone"][0] == "n/a"


def test_revived_pmid_is_no_deletion(spark, tmp_path):
    put(tmp_path / "e", [doc(1)])
    t = tables(spark, [1], [1])
    t["article"] = t["article"].selectExpr("pmid", "source_file", "file_order_key + 1 as file_order_key", "loaded_at")
    assert status(run_validation(spark, tmp_path / "e", t))["deleted-absent"][0] == "n/a"


def test_field_findings_and_outage(spark, tmp_path):
    put(tmp_path / "e", [doc(1, volume="5", abstract="same words here"), doc(2, issue="", pub_date="1998 September 03"), doc(3)])
    live = {1: doc(1, volume="6", abstract="quite another text"), 2: doc(2, identifiers=["PMID:2", "DOI:10.1/A"], pub_date="1998 Sep 3", journal_name="y")}
    r = run_validation(spark, tmp_path / "e", fetch=lambda ps: {p: live[p] for p in ps if p in live}, total=lambda: 3)
    f, got = r["checks"]["field_validation"], status(r)
    assert (f["sampled"], f["checked"], f["core_comparisons"], f["core_mismatches"]) == (3, 2, 14, 3) and f["missing_from_api"] == [3]
    assert list(f["mismatches_by_field"].items()) == [("abstract", 1), ("issue", 1), ("volume", 1)]
    assert f["mismatches_by_kind"] == {"low_similarity": 1, "exported_blank": 1, "entrez_blank": 0, "values_differ": 1}
    detail = next(c["detail"] for c in r["checks_run"] if c["name"] == "core-fields")
    assert detail["examples"]["values_differ"] == {"pmid": 1, "field": "volume", "exported": "5", "entrez": "6"} and "volume: 1" in format_summary(r)
    assert got["sample-fetched"] == ("fail", "sampled_pmid_absent", 1) and got["core-fields"][:2] == ("fail", "field_mismatch_rate") and got["abstract"] == ("warn", None, 0)
    assert got["journal-soft"] == ("warn", "journal_mismatches", 1) and got["identifiers-soft"][0] == "pass"

    def down(_):
        raise OSError("down")

    r = run_validation(spark, tmp_path / "e", fetch=down, total=lambda: down(0))
    assert {w["code"] for w in r["warnings"]} == {"field_check_unreachable", "entrez_unreachable"}


def test_sample_is_the_same_for_any_partitioning(spark, tmp_path):
    from citelake.validate.structure import find_shards, lines, sample_lines

    put(tmp_path / "e", [doc(p) for p in range(100)])
    put(tmp_path / "e", [doc(p) for p in range(100, 130)], "b.ndjson")
    facts = lines(spark, find_shards(spark, tmp_path / "e"))
    pick = lambda df: sorted(r["pmid"] for r in sample_lines(df, 7, 3).collect())
    assert len(pick(facts)) == 14 and pick(facts) == pick(facts.repartition(9))


def test_report_follows_from_the_outcomes():
    def outcome(name, status, code=None, count=0):
        return checks.Outcome(name, "s", "e", status, "why", code, count, None, {})

    r = report.as_dict([outcome("a", "fail", "no_shards", 2), outcome("b", "warn"), outcome("c", "skip")], {})
    assert r["status"] == "fail" and [(e["code"], e["count"]) for e in r["errors"]] == [("no_shards", 2)] and r["warnings"] == [] and r["skipped_checks"] == ["s.c (why)"]
    assert report.overall([outcome("b", "warn")]) == "pass" and report.overall([outcome("b", "warn", "extra_fields")]) == "warn"
    assert groups([]) == {"by_field": {}, "by_kind": dict.fromkeys(("low_similarity", "exported_blank", "entrez_blank", "values_differ"), 0), "examples": {}}
    codes = {c.code for x in checks.CHECKS for c in x.cases if c.code}
    assert codes == set(checks.MEANING) and len(checks.CHECKS) == 21 and all(x.cases for x in checks.CHECKS)


def test_many_names_are_all_counted(spark, tmp_path):
    put(tmp_path / "e", [doc(i, identifiers=[f"PMID:{i}", f"p{i}:x", "none"], **{f"more{i}": "y"}) for i in range(40)])
    s = run_validation(spark, tmp_path / "e")["checks"]["structure"]
    assert len(s["extra_fields"]) == 40 and len(s["identifier_prefixes"]) == 41 and s["identifier_prefixes"]["PMID"] == {"records": 40, "pct": 100.0}


def test_compare_empty_sides(spark):
    from citelake.validate.fields import _DOC

    none = spark.createDataFrame([], _DOC)
    assert compare(none, none, 0.9).count() == 0
    with pytest.raises(ValueError):
        exports.write_ndjson(none, "/tmp/x", shards=0)
