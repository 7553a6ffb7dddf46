"""The live service by stubbed transports, and the log helpers."""

import io
import json
import urllib.error

import pytest
from conftest import ABSTRACT, citation
from citelake import progress
from citelake.sources import live


def test_documents_and_total(spark):
    asked = []

    def get(endpoint, params):
        asked.append((endpoint, params.get("id")))
        if endpoint == "einfo.fcgi":
            return json.dumps({"einforesult": {"dbinfo": [{"count": "41"}]}}).encode()
        records = [citation(p, date="<MedlineDate>1998 Dec-1999 Jan</MedlineDate>" if p == 2 else "<Year>2020</Year><Month>03</Month><Day>06</Day>", abstract=ABSTRACT, ids=[("pmc", "PMC1"), ("pii", "x")]) for p in map(int, params["id"].split(",")) if p != 3]
        return f"<PubmedArticleSet>{''.join(records)}</PubmedArticleSet>".encode()

    docs = live.documents(spark, get, list(range(1, 24)))
    assert live.total(get) == 41 and len(docs) == 22 and 3 not in docs and [e for e, _ in asked] == ["efetch.fcgi", "efetch.fcgi", "einfo.fcgi"]
    assert docs[1] == {
        "id": "PMID:1", "identifiers": ["PMID:1", "PMCID:PMC1"], "journal_name": "", "journal_abbrev": "", "article_title": "A title.", "volume": "5", "issue": "",
        "pub_year": "2020", "pub_month": "Mar", "pub_day": "06", "pub_date": "2020 Mar 6", "abstract": "First part. Second part.",
    }
    assert (docs[2]["pub_year"], docs[2]["pub_month"], docs[2]["pub_date"]) == ("1998", "Dec-1999 Jan", "1998 Dec-1999 Jan")


def test_transport_retries_and_paces():
    slept, urls, answers = [], [], []
    error = lambda code: urllib.error.HTTPError("u", code, "m", {}, None)

    def open_url(url, timeout):
        urls.append(url)
        x = answers.pop(0)
        if isinstance(x, Exception):
            raise x
        return io.BytesIO(x)

    t = live.Transport("key", open_url=open_url, clock=lambda: 0.0, sleep=slept.append)
    answers[:] = [error(503), OSError("reset"), b"ok"]
    assert t("einfo.fcgi", {"db": "x"}) == b"ok" and "api_key=key" in urls[0]
    assert [s for s in slept if s >= 1] == [1, 2] and 0.1 in slept
    answers[:] = [error(400), b"never"]
    with pytest.raises(RuntimeError, match="400 after 1"):
        t("efetch.fcgi", {})
    answers[:] = [error(429)] * 3
    with pytest.raises(RuntimeError, match="429 after 3"):
        t("efetch.fcgi", {})


def test_log_helpers(caplog):
    assert [progress.duration(s) for s in (5, 187, 7500)] == ["5s", "3m 07s", "2h 05m"]
    assert [progress.remaining(10, d, n) for d, n in ((5, 5), (0, 5), (5, 0))] == ["10s", "?", "done"]
    assert progress.peak_gib() > 0 and progress.current_gib() > 0
    caplog.set_level("INFO")
    with progress.Heartbeat("e", lambda: [5], 0.01) as h:
        h._stop.wait(0.2)
    assert "1 file(s)" in caplog.text
