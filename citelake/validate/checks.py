"""What an export is expected to be.

A check is a list of cases over the facts of a run; the first case that holds is its outcome.  Facts come from the gathering modules, and
nothing here reads data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from types import SimpleNamespace as Facts
from typing import NamedTuple

# States of a check, worst first, and those without a verdict.
FAIL, WARN, PASS, SKIP, NA = "fail", "warn", "pass", "skip", "n/a"
#: Share of the database's records an export may lack, relative change of coverage, share of compared values that may differ.
SHORTFALL, DRIFT, MISMATCHES = 0.01, 0.10, 0.20

# Codes of findings, with what they mean.
MEANING = {
    "no_shards": "The folder holds no shard.", "no_records": "The export holds no record.", "unreadable_shard": "Shards that break off or can't be opened.",
    "malformed_json": "Lines that are no JSON object.", "missing_fields": "Fields that records lack.", "null_values": "Records with a null value.",
    "invalid_ids": "Records whose id isn't PMID and digits.", "duplicate_pmids": "Pmids of more than one record.", "extra_fields": "Fields that no document has.",
    "invalid_months": "Months outside the closed set.", "coverage_out_of_band": "The export's share of the service's records is out of its band.",
    "entrez_unreachable": "The service's total couldn't be had.", "export_shortfall": "The export lacks current versions of the database.",
    "export_db_mismatch": "The export and the database count differently.", "coverage_drift": "Coverage moved since the previous report.",
    "field_check_unreachable": "The sampled records couldn't be had from the service.", "sampled_pmid_absent": "Exported records the service doesn't have.",
    "field_mismatch_rate": "Too many compared values differ from the service's.", "field_mismatches": "Some compared values differ from the service's.",
    "journal_mismatches": "Journal names or dates differ from the service's.", "identifier_mismatches": "Identifiers differ from the service's.",
    "deleted_pmid_exported": "Deleted pmids are in the export.", "deleted_pmid_still_live": "The service still has deleted pmids.",
    "deletion_check_unreachable": "Deletions couldn't be confirmed with the service.", "unexplained_drops": "Pmids vanished without a deletion.",
    "drops_unattributed": "Pmids vanished, and there is no database to tell why.",
}


class Case(NamedTuple):
    status: str
    holds: Callable[[Facts], object]
    observed: Callable[[Facts], str] | str
    code: str | None = None
    count: Callable[[Facts], int] = lambda f: 1


class Check(NamedTuple):
    name: str
    section: str
    expectation: str  # may name facts in braces
    see: str
    cases: tuple[Case, ...]


class Outcome(NamedTuple):
    """A check's result; one without a code is for display only and never a finding."""

    name: str
    section: str
    expectation: str
    status: str
    observed: str
    code: str | None
    count: int
    see: str | None
    detail: dict


def always(_: Facts) -> bool:
    return True


def _fine(text: Callable[[Facts], str] | str) -> Case:
    return Case(PASS, always, text)


def _counted(name: str, code: str, expectation: str, bad: str = FAIL) -> Check:
    """A check that a structure count is zero."""
    n = lambda f: f.counts[code]
    return Check(name, "structure", expectation, f"checks.structure.{code}", (
        Case(NA, lambda f: f.counts is None, "no shard was read"), Case(bad, n, lambda f: f"{n(f):,} found", code, n), _fine("none found"),
    ))


def _compared(name: str, expectation: str, see: str, *cases: Case) -> Check:
    """A check of the sampled records against the service."""
    return Check(name, "field accuracy", expectation, see, (
        Case(SKIP, lambda f: not f.fetching, "offline"), Case(NA, lambda f: not f.sampled, "no record was sampled"),
        Case(WARN, lambda f: f.fetch_error, lambda f: f"unreachable: {f.fetch_error}", "field_check_unreachable", lambda f: f.sampled), *cases,
    ))


_FIELDS, _DELETIONS, _DROPS = "checks.field_validation", "checks.deletions", "checks.drops_since_previous"
_NO_DATABASE = Case(SKIP, lambda f: f.current is None, "no database available")
_NO_DELETION = Case(NA, lambda f: not f.picked, "no deletion stands")

CHECKS = (
    Check("shards-found", "structure", "the folder holds shards", "inputs.shards", (
        Case(FAIL, lambda f: not f.shards, "0 shard(s)", "no_shards"), _fine(lambda f: f"{len(f.shards)} shard(s)"),
    )),
    Check("records-present", "structure", "the export holds records", "checks.structure", (
        Case(FAIL, lambda f: not f.exported, "0 record(s)", "no_records"), _fine(lambda f: f"{f.exported:,} record(s)"),
    )),
    Check("shard-readable", "structure", "every shard can be read to its end", "checks.structure.unreadable_shard", (
        Case(FAIL, lambda f: f.unreadable, lambda f: f"{len(f.unreadable):,} found", "unreadable_shard", lambda f: len(f.unreadable)), _fine("none found"),
    )),
    _counted("json-parse", "malformed_json", "every line is a JSON object"),
    _counted("record-fields", "missing_fields", "every record has all fields"),
    _counted("no-nulls", "null_values", "no value is null"),
    _counted("id-format", "invalid_ids", "every id is PMID and digits"),
    _counted("pmid-unique", "duplicate_pmids", "every pmid occurs once"),
    _counted("no-extra-fields", "extra_fields", "no record has other fields", WARN),
    _counted("month-format", "invalid_months", "every month is of the closed set", WARN),
    Check("vs-entrez", "coverage", "between {low:.0%} and {high:.0%} of the service's records", "checks.coverage", (
        Case(SKIP, lambda f: not f.counting, "offline"),
        Case(WARN, lambda f: f.total_error, lambda f: f"unreachable: {f.total_error}", "entrez_unreachable"),
        Case(WARN, lambda f: f.share is not None and not f.low <= f.share <= f.high, lambda f: f"{f.exported:,} of {f.total:,} ({f.share:.3%})", "coverage_out_of_band"),
        _fine(lambda f: f"{f.exported:,} of {f.total:,}" + (f" ({f.share:.3%})" if f.total else "")),
    )),
    Check("vs-database", "coverage", "as many records as the database has current versions", "checks.coverage", (
        _NO_DATABASE, Case(NA, lambda f: f.current == 0, "the database has no current versions"),
        Case(FAIL, lambda f: f.exported < (1 - SHORTFALL) * f.current, lambda f: f"{f.exported:,} of {f.current:,}", "export_shortfall", lambda f: f.current - f.exported),
        Case(WARN, lambda f: f.exported != f.current, lambda f: f"{f.exported:,} of {f.current:,}", "export_db_mismatch", lambda f: abs(f.current - f.exported)),
        _fine(lambda f: f"{f.exported:,} of {f.current:,}"),
    )),
    Check("vs-previous", "coverage", f"coverage within {DRIFT:.0%} of the previous report's", "checks.coverage.previous", (
        Case(SKIP, lambda f: not f.has_previous, "no previous report"), Case(NA, lambda f: not (f.share and f.share_then), "no comparable figure"),
        Case(WARN, lambda f: abs(f.share / f.share_then - 1) > DRIFT, lambda f: f"{f.share_then:.3%} then, {f.share:.3%} now", "coverage_drift"),
        _fine(lambda f: f"{f.share_then:.3%} then, {f.share:.3%} now"),
    )),
    _compared("sample-fetched", "the service has every sampled record", f"{_FIELDS}.missing_from_api", Case(
        FAIL, lambda f: f.absent, lambda f: f"{f.checked:,} of {f.sampled:,} returned", "sampled_pmid_absent", lambda f: f.absent), _fine(lambda f: f"{f.checked:,} of {f.sampled:,} returned")),
    _compared("core-fields", f"at most {MISMATCHES:.0%} of compared values differ", f"{_FIELDS}.mismatches",
        Case(FAIL, lambda f: f.rate > MISMATCHES, lambda f: f"{f.wrong:,} of {f.compared:,} differ ({f.rate:.2%})", "field_mismatch_rate", lambda f: f.wrong),
        Case(WARN, lambda f: f.wrong, lambda f: f"{f.wrong:,} of {f.compared:,} differ ({f.rate:.2%})", "field_mismatches", lambda f: f.wrong),
        _fine(lambda f: f"0 of {f.compared:,} differ")),
    _compared("abstract", "abstracts are at least {threshold:.0%} alike", f"{_FIELDS}.abstract_similarity",
        Case(NA, lambda f: f.alike is None, "no sampled record has an abstract on either side"),
        Case(WARN, lambda f: f.alike < f.threshold, lambda f: f"lowest {f.alike:.3f}, mean {f.alike_mean:.3f}", None, lambda f: 0),  # core-fields counts these
        _fine(lambda f: f"lowest {f.alike:.3f}, mean {f.alike_mean:.3f}")),
    _compared("journal-soft", "journal names and dates agree (advisory)", f"{_FIELDS}.soft_mismatches", Case(
        WARN, lambda f: f.soft, lambda f: f"{f.soft:,} differ", "journal_mismatches", lambda f: f.soft), _fine("0 differ")),
    _compared("identifiers-soft", "identifiers agree (advisory)", f"{_FIELDS}.identifier_mismatches", Case(
        WARN, lambda f: f.ids, lambda f: f"{f.ids:,} differ", "identifier_mismatches", lambda f: f.ids), _fine("0 differ")),
    Check("deleted-absent", "deletions", "deleted pmids aren't in the export", f"{_DELETIONS}.present_in_export", (
        _NO_DATABASE, _NO_DELETION, Case(FAIL, lambda f: f.present, lambda f: f"{len(f.present):,} of {len(f.picked):,} exported", "deleted_pmid_exported", lambda f: len(f.present)),
        _fine(lambda f: f"0 of {len(f.picked):,} exported"),
    )),
    Check("deleted-gone", "deletions", "the service doesn't have them either", f"{_DELETIONS}.still_live", (
        _NO_DATABASE, _NO_DELETION, Case(SKIP, lambda f: not f.fetching, "offline"),
        Case(WARN, lambda f: f.gone_error, lambda f: f"unreachable: {f.gone_error}", "deletion_check_unreachable", lambda f: len(f.picked)),
        Case(WARN, lambda f: f.still_live, lambda f: f"{len(f.still_live):,} of {len(f.picked):,} still there", "deleted_pmid_still_live", lambda f: len(f.still_live)),
        _fine(lambda f: f"{len(f.picked):,} of {len(f.picked):,} gone"),
    )),
    Check("pmid-set-diff", "drops since previous", "no pmid vanished without a deletion", f"{_DROPS}.unexplained", (
        Case(SKIP, lambda f: f.dropped is None, "no previous manifest"),
        Case(FAIL, lambda f: f.unexplained and f.current is not None, lambda f: _drops(f), "unexplained_drops", lambda f: f.unexplained),
        Case(WARN, lambda f: f.unexplained, lambda f: _drops(f), "drops_unattributed", lambda f: f.unexplained), _fine(lambda f: _drops(f)),
    )),
)


def _drops(f: Facts) -> str:
    return f"{f.dropped:,} dropped ({f.dropped - f.unexplained:,} by deletion), {f.added:,} added"


def evaluate(facts: Facts, details: dict[str, dict] | None = None) -> list[Outcome]:
    """The outcome of every check, in order; ``details`` by check are shown with it."""

    def outcomes() -> Iterator[Outcome]:
        for c in CHECKS:
            case = next(x for x in c.cases if x.holds(facts))
            seen = case.observed if isinstance(case.observed, str) else case.observed(facts)
            finding = case.status in (FAIL, WARN)
            yield Outcome(
                c.name, c.section, c.expectation.format_map(vars(facts)), case.status, seen, case.code if finding else None, case.count(facts) if finding else 0,
                c.see if finding else None, (details or {}).get(c.name, {}),
            )

    return list(outcomes())
