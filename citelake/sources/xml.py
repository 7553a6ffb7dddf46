"""Citation XML files to nested records and flat tables.

A gzip file can't be split, so a task reads one file at a time; of all but small files elements are dropped once they are read, so memory doesn't
grow with the file.  Inline markup in titles and abstracts is flattened to its text and white space is collapsed; dates are
kept verbatim.
"""

from __future__ import annotations

import datetime
import gzip
import io
import re
import xml.etree.ElementTree as ET
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import parse_file_name
from ..schemas import VERSIONED, conform

_RECORD = """
pmid bigint, pmid_version int, article_title string, nlm_catalog_id string, issn_linking string, volume string, issue string, pub_year string,
pub_month string, pub_day string, medline_date string, date_completed date, date_revised date,
sections array<struct<label: string, nlm_category: string, text: string>>,
authors array<struct<position: int, kind: string, name: string, orcid: string, valid: boolean, affiliations: array<string>>>,
headings array<struct<descriptor_ui: string, descriptor_name: string, major_topic: boolean,
  qualifiers: array<struct<qualifier_ui: string, qualifier_name: string, major_topic: boolean>>>>,
types array<string>, grants array<struct<grant_id: string, acronym: string, agency: string, country: string>>,
ids array<struct<id_type: string, id_value: string>>, events array<struct<pub_status: string, date: date>>
"""
#: ``what`` is article, deleted, failed (a record that can't be used), book (counted only), superseded (``rec_idx`` is of a record whose pmid
#: comes again later in the file) or broken (the file can't be read to its end).
SCANNED = f"source_file string, file_order_key bigint, rec_idx bigint, what string, message string, {_RECORD}"

BATCH = 500
#: Bytes of XML that are read as one tree, which is faster than record by record and takes some six times as much memory.
TREE = 16 << 20
# English month abbreviations of partial dates.
_MONTH = {m: i for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}


def _flat(el: ET.Element | None) -> str | None:
    """An element's whole text, white space collapsed; None if it is absent or blank."""
    if el is None:
        return None
    return " ".join(("".join(el.itertext()) if len(el) else el.text or "").split()) or None


def _all(el: ET.Element, *path: str) -> list[ET.Element]:
    """The elements at a path, as ``findall`` gives them; a step at a time, as paths are much slower."""
    found = el.findall(path[0])
    for tag in path[1:]:
        found = found[0].findall(tag) if len(found) == 1 else [y for x in found for y in x.findall(tag)]
    return found


def _first(el: ET.Element, *path: str) -> ET.Element | None:
    return next(iter(_all(el, *path)), None)


def _date(el: ET.Element | None) -> datetime.date | None:
    """Year, month and day; a missing month or day is the first.  None if absent or no date."""
    if el is None:
        return None
    year, month, day = (((el.findtext(t) or "").strip()) for t in ("Year", "Month", "Day"))
    try:
        m = int(month) if month.isdigit() else _MONTH.get(month[:3].lower(), 1)
        return datetime.date(int(year), m, int(day or 1))
    except ValueError:
        return None


def _yes(el: ET.Element, name: str) -> bool:
    return el.get(name) == "Y"


def raw_pubdate(el: ET.Element) -> tuple:
    """(year, month or season, day, free text), verbatim; an empty month falls to the season."""
    d = _first(el, "MedlineCitation", "Article", "Journal", "JournalIssue", "PubDate")
    if d is None:
        return None, None, None, None
    return d.findtext("Year"), d.findtext("Month") or d.findtext("Season"), d.findtext("Day"), d.findtext("MedlineDate")


def own_ids(el: ET.Element) -> list[dict]:
    """The record's own identifiers: those directly under its list, never those of its references; not the pmid again."""
    found = [(x.get("IdType"), (x.text or "").strip()) for x in _all(el, "PubmedData", "ArticleIdList", "ArticleId")]
    return [{"id_type": t, "id_value": v} for t, v in found if t not in (None, "pubmed") and v]


def _authors(el: ET.Element) -> list[dict]:
    out = []
    for position, a in enumerate(_all(el, "MedlineCitation", "Article", "AuthorList", "Author"), 1):
        group = _flat(a.find("CollectiveName"))
        if group:
            out.append({"position": position, "kind": "collective", "name": group, "orcid": None, "valid": None, "affiliations": []})
            continue
        name = " ".join(p for p in (_flat(a.find("ForeName")) or _flat(a.find("Initials")), _flat(a.find("LastName")), _flat(a.find("Suffix"))) if p)
        orcid = next((_flat(i) for i in a.findall("Identifier") if i.get("Source") == "ORCID"), None)
        m = re.search(r"(\d{4})-?(\d{4})-?(\d{4})-?(\d{3}[\dX])", orcid) if orcid else None
        places = [p for p in map(_flat, _all(a, "AffiliationInfo", "Affiliation")) if p]
        out.append({"position": position, "kind": "author", "name": name or None, "orcid": "-".join(m.groups()) if m else None, "valid": _yes(a, "ValidYN"), "affiliations": places})
    return out


def _headings(el: ET.Element) -> list[dict]:
    out = []
    for h in _all(el, "MedlineCitation", "MeshHeadingList", "MeshHeading"):
        d = h.find("DescriptorName")
        if d is None:
            continue
        below = [{"qualifier_ui": q.get("UI"), "qualifier_name": _flat(q), "major_topic": _yes(q, "MajorTopicYN")} for q in h.findall("QualifierName")]
        out.append({"descriptor_ui": d.get("UI"), "descriptor_name": _flat(d), "major_topic": _yes(d, "MajorTopicYN"), "qualifiers": below})
    return out


def record(el: ET.Element) -> dict:
    """One citation; ValueError if it has no pmid, no title or no journal identifier."""
    cite = el.find("MedlineCitation")
    pmid_el = cite.find("PMID") if cite is not None else None
    if pmid_el is None:
        raise ValueError("no PMID")
    pmid, version = int(pmid_el.text or ""), pmid_el.get("Version")
    article, journal = cite.find("Article"), cite.find("MedlineJournalInfo")
    title = _flat(article.find("ArticleTitle")) if article is not None else None
    if title is None:
        raise ValueError(f"{pmid}: no title")
    if journal is None or not _flat(journal.find("NlmUniqueID")):
        raise ValueError(f"{pmid}: no journal")
    year, month, day, free = raw_pubdate(el)
    issue = lambda tag: _flat(_first(article, "Journal", "JournalIssue", tag))
    texts = [
        {"label": t.get("Label"), "nlm_category": t.get("NlmCategory"), "text": _flat(t)} for t in _all(article, "Abstract", "AbstractText")
    ]
    return {
        "pmid": pmid, "pmid_version": int(version) if version else None, "article_title": title, "nlm_catalog_id": _flat(journal.find("NlmUniqueID")),
        "issn_linking": _flat(journal.find("ISSNLinking")), "volume": issue("Volume"), "issue": issue("Issue"),
        "pub_year": year, "pub_month": month, "pub_day": day, "medline_date": free, "date_completed": _date(cite.find("DateCompleted")),
        "date_revised": _date(cite.find("DateRevised")), "sections": [t for t in texts if t["text"]], "authors": _authors(el), "headings": _headings(el),
        "types": [t.get("UI") for t in _all(article, "PublicationTypeList", "PublicationType") if t.get("UI")],
        "grants": [
            {"grant_id": _flat(g.find("GrantID")), "acronym": _flat(g.find("Acronym")), "agency": _flat(g.find("Agency")), "country": _flat(g.find("Country"))}
            for g in _all(article, "GrantList", "Grant")
        ],
        "ids": own_ids(el),
        "events": [{"pub_status": p.get("PubStatus"), "date": _date(p)} for p in _all(el, "PubmedData", "History", "PubMedPubDate")],
    }


def _child(el: ET.Element) -> Iterator[tuple[str, str | None, dict]]:
    """What an element right below the root gives."""
    if el.tag == "PubmedArticle":
        try:
            yield "article", None, record(el)
        except (ValueError, KeyError) as e:
            yield "failed", str(e), {}
    elif el.tag == "PubmedBookArticle":
        yield "book", None, {}
    elif el.tag == "DeleteCitation":
        for p in el.findall("PMID"):
            digits = (p.text or "").strip()
            if re.fullmatch("[0-9]+", digits):
                yield "deleted", None, {"pmid": int(digits)}


def _stream(content: bytes) -> io.BufferedIOBase:
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


#: Why a file can't be read to its end.
_BROKEN = (ET.ParseError, OSError, EOFError, zlib.error, UnicodeDecodeError)


def _tree(content: bytes) -> ET.Element | None:
    """The tree of a small file; None if it is larger, or breaks off."""
    if len(content) > TREE:
        return None
    try:
        text = _stream(content).read(TREE + 1)
        return ET.fromstring(text) if len(text) <= TREE else None
    except _BROKEN:
        return None


def read(content: bytes) -> Iterator[tuple[str, str | None, dict]]:
    """(what, message, fields) of each record in file order; a file that breaks off ends with ``broken``."""
    if (tree := _tree(content)) is not None:
        for el in tree:
            yield from _child(el)
        return
    depth, root = 0, None
    try:
        for event, el in ET.iterparse(_stream(content), events=("start", "end")):
            if event == "start":
                root = el if depth == 0 else root
                depth += 1
                continue
            depth -= 1
            if depth != 1:
                continue
            yield from _child(el)
            root.clear()
    except _BROKEN as e:
        yield "broken", f"{type(e).__name__}: {e}", {}


def scan(files: DataFrame) -> DataFrame:
    """Records of the files (path, content), as Spark's ``binaryFile`` gives them, by the schema ``SCANNED``; names that aren't
    release files are ignored."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(SCANNED))
    names = target.names

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []  # of several files, if they are small
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                file = path.as_py().rsplit("/", 1)[-1]
                try:
                    key = parse_file_name(file)[2]
                except ValueError:
                    continue
                seen: dict[int, int] = {}
                for i, (what, message, fields) in enumerate(read(content.as_py())):
                    head = {"source_file": file, "file_order_key": key, "message": message}
                    rows.append(head | {"rec_idx": i, "what": what} | fields)
                    if what == "article":
                        if fields["pmid"] in seen:
                            rows.append(head | {"rec_idx": seen[fields["pmid"]], "what": "superseded"})
                        seen[fields["pmid"]] = i
                    if len(rows) >= BATCH:
                        yield pa.RecordBatch.from_pylist(rows, target)
                        rows = []
        yield pa.RecordBatch.from_pylist(rows, target)

    assert names[0] == "source_file"
    return files.select("path", "content").mapInArrow(parse, SCANNED)


def counts(scanned: DataFrame) -> DataFrame:
    """Per file: articles after the last record of each pmid is kept, deletions with their repeats, failed and book records, and
    the message of a broken file."""
    what = F.col("what")
    return scanned.groupBy("source_file").agg(
        (F.count_if(what == "article") - F.count_if(what == "superseded")).cast("int").alias("n_articles"),
        F.count_if(what == "deleted").cast("int").alias("n_deletions"), F.count_if(what == "failed").cast("int").alias("n_failed"),
        F.count_if(what == "book").cast("int").alias("n_book_records"), F.count_if(what == "superseded").alias("n_superseded"), F.max(F.when(what == "broken", F.col("message"))).alias("broken"),
    )


def tables(scanned: DataFrame, loaded_at: Column | None = None, few: bool = False) -> dict[str, DataFrame]:
    """The versioned tables of scanned records.

    Of several records of one pmid in a file the last counts, with its children only: the task that read the file has noted the others, so
    with ``few`` of them, whose numbers can be broadcast, this takes no shuffle of records.
    """
    at = F.current_timestamp() if loaded_at is None else loaded_at
    old = scanned.where("what = 'superseded'").select("source_file", "rec_idx")
    last = scanned.where("what = 'article'").join(F.broadcast(old) if few else old, ["source_file", "rec_idx"], "left_anti").withColumn("loaded_at", at)

    def children(array: str, *cols: str) -> DataFrame:
        return last.select("pmid", "source_file", F.explode(array).alias("x")).select("pmid", "source_file", *cols)

    who = children("authors", "x.*")
    topics = children("headings", "x.*")
    sections = last.select("pmid", "source_file", F.posexplode("sections").alias("seq", "x")).select("pmid", "source_file", "seq", "x.*")
    out = {
        "article": last, "abstract_text": sections, "author": who,
        "author_affiliation": who.select("pmid", "source_file", "position", F.explode("affiliations").alias("affiliation")),
        "mesh_heading": topics,
        "mesh_qualifier": topics.select("pmid", "source_file", "descriptor_ui", F.explode("qualifiers").alias("q")).select("pmid", "source_file", "descriptor_ui", "q.*"),
        "publication_type": children("types", "x").withColumnRenamed("x", "type_ui"), "grant_": children("grants", "x.*"),
        "article_id": children("ids", "x.*"), "history": children("events", "x.*"), "deleted_pmid": scanned.where("what = 'deleted'"),
    }
    return {t: conform(out[t], t) for t in VERSIONED}
