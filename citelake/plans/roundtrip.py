"""The sources over whole tables: tables are written in the formats the sources read, loaded by the loader, and counted."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import groupby, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import loading
from ..files import Files
from ..session import read_table, scratch
from ..sinks import exports
from ..sources import journals
from ..store import Store, local_files


def _text(c: Column | str) -> Column:
    """Escaped for XML; NULL gives nothing."""
    c = F.col(c) if isinstance(c, str) else c
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return F.coalesce(c, F.lit(""))


def _el(name: str, inner: Column, *attributes: Column, where: Column | None = None) -> Column:
    """An element; nothing where the condition doesn't hold."""
    whole = F.concat(F.lit(f"<{name}"), *attributes, F.lit(">"), inner, F.lit(f"</{name}>"))
    return whole if where is None else F.when(where, whole).otherwise("")


def _at(name: str, c: str) -> Column:
    return F.when(F.col(c).isNotNull(), F.concat(F.lit(f' {name}="'), _text(c), F.lit('"'))).otherwise("")


def _value(name: str, c: str) -> Column:
    return _el(name, _text(c), where=F.col(c).isNotNull())


def _day(name: str, c: str) -> Column:
    parts = [_el(n, F.date_format(c, f)) for n, f in (("Year", "yyyy"), ("Month", "MM"), ("Day", "dd"))]
    return _el(name, F.concat(*parts), where=F.col(c).isNotNull())


#: Records in one written file; a source file with more is written as several, whose numbers are a million apart.
RECORDS, PIECES = 5_000, 2_000
#: Bytes of release files that are at least loaded together.
LOADED = 64 << 20

#: What no text can hold, as its ``<`` are escaped.
CUT = "<>"

# What a row is a part of; a deletion stands for itself.
_ARTICLE, _SECTION, _AUTHOR, _PLACE, _TOPIC, _DELETED = range(6)


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    """(pmid, source_file, part, place, at, x): the texts of every article (before, between and after its lists, with ``CUT`` where these go), of their
    children (a person's without its end, as affiliations come before it) and of the deletions."""
    t = lambda n: read_table(spark, sf, n)
    date = F.concat(*[_value(n, c) for n, c in (("Year", "pub_year"), ("Month", "pub_month"), ("Day", "pub_day"), ("MedlineDate", "medline_date"))])
    issue = _el("Journal", _el("JournalIssue", F.concat(_value("Volume", "volume"), _value("Issue", "issue"), _el("PubDate", date))))
    version = F.concat(F.lit(' Version="'), F.coalesce(F.col("pmid_version"), F.lit(1)).cast("string"), F.lit('"'))
    dates = F.concat(_day("DateCompleted", "date_completed"), _day("DateRevised", "date_revised"))
    before = F.concat(F.lit("<PubmedArticle><MedlineCitation>"), _el("PMID", F.col("pmid").cast("string"), version), dates, F.lit("<Article>"), issue, _value("ArticleTitle", "article_title"))
    kinds = F.lit('<PublicationTypeList><PublicationType UI="D016428">x</PublicationType></PublicationTypeList></Article>')
    between = F.concat(kinds, _el("MedlineJournalInfo", F.concat(_value("NlmUniqueID", "nlm_catalog_id"), _value("ISSNLinking", "issn_linking"))))
    number = _el("ArticleIdList", _el("ArticleId", _text("issn_linking"), F.lit(' IdType="doi"'), where=F.col("issn_linking").isNotNull()))
    after = F.concat(F.lit("</MedlineCitation>"), _el("PubmedData", F.concat(_el("History", _day("PubMedPubDate", "date_revised")), number)), F.lit("</PubmedArticle>"))
    valid = F.when(F.col("valid"), ' ValidYN="Y">').otherwise(' ValidYN="N">')
    orcid = _el("Identifier", _text("orcid"), F.lit(' Source="ORCID"'), where=F.col("orcid").isNotNull())
    group, person = _el("Author", _value("CollectiveName", "name")), F.concat(F.lit("<Author"), valid, _value("LastName", "name"), orcid)
    collective = F.col("kind") == "collective"
    major = F.when(F.col("major_topic"), ' MajorTopicYN="Y"').otherwise(' MajorTopicYN="N"')
    qualifier = _el("QualifierName", _text("qualifier_name"), _at("UI", "qualifier_ui"), major)
    heading = _el("MeshHeading", F.concat(_el("DescriptorName", F.lit("topic"), _at("UI", "descriptor_ui")), qualifier))
    section = _el("AbstractText", _text("text"), _at("Label", "label"), _at("NlmCategory", "nlm_category"))
    gone = _el("DeleteCitation", _el("PMID", F.col("pmid").cast("string")))

    def rows(table: str, part: int, place: Column, x: Column, at: Column | None = None) -> DataFrame:
        at = F.lit(None) if at is None else at
        return t(table).select("pmid", "source_file", F.lit(part).alias("part"), place.cast("int").alias("place"), at.cast("timestamp").alias("at"), x.alias("x"))

    return reduce(DataFrame.unionByName, [
        rows("article", _ARTICLE, F.lit(0), F.concat(before, F.lit(CUT), between, F.lit(CUT), after), F.col("loaded_at")), rows("abstract_text", _SECTION, F.col("seq"), section),
        rows("author", _AUTHOR, F.col("position"), F.when(collective, group).otherwise(person)),
        rows("author_affiliation", _PLACE, F.col("position"), _el("AffiliationInfo", _value("Affiliation", "affiliation"))),
        rows("mesh_qualifier", _TOPIC, F.lit(0), heading), rows("deleted_pmid", _DELETED, F.lit(0), gone),
    ])


def _people(authors: list[tuple], places: dict[int, list[bytes]]) -> Iterator[bytes]:
    """Authors by position; of the repeated ones of a position the first that can has the affiliations."""
    for position, x in authors:
        yield x
        if not x.endswith(b"</Author>"):
            if position is not None:
                yield from places.pop(position, ())
            yield b"</Author>"


def _record(parts: list[list[tuple]]) -> bytes:
    """The records and deletions of one pmid; children without an article give nothing."""
    out = []
    if parts[_ARTICLE]:
        places: dict[int, list[bytes]] = {}
        for position, x in parts[_PLACE]:
            places.setdefault(position, []).append(x)
        sections, topics = (b"".join([x for _, x in parts[p]]) for p in (_SECTION, _TOPIC))
        people = b"".join(_people(parts[_AUTHOR], places))
        for _, x in parts[_ARTICLE]:
            if x:  # without a pmid there is none
                before, between, after = x.split(CUT.encode())
                out += [before, b"<Abstract>", sections, b"</Abstract><AuthorList>", people, b"</AuthorList>", between, b"<MeshHeadingList>", topics, b"</MeshHeadingList>", after]
    return b"".join(out + [x for _, x in parts[_DELETED]])


def _values(column: pa.Array) -> list:
    """The column's values, as ``to_pylist`` gives them; that makes an object of each value first."""
    if not len(column) or column.null_count:
        return column.to_pylist()
    if pa.types.is_string(column.type):
        d = column.dictionary_encode()
        return np.array(d.dictionary.to_pylist(), object)[d.indices.to_numpy()].tolist()
    if pa.types.is_binary(column.type):
        _, at, data = column.buffers()
        at = np.frombuffer(at, np.int32)[column.offset :][: len(column) + 1].tolist()
        data = data.to_pybytes() if data else b""
        return [data[i:j] for i, j in pairwise(at)]
    return column.to_numpy().tolist() if pa.types.is_integer(column.type) else column.to_pylist()


def _writer(target: str):
    """Writes sorted rows (file, pmid, part, place, x) as one release file each in the folder; gives (file_name, of).  ``file`` is the file's name, with
    ``/`` and the source file's where that is another.

    A file gets its name when it is whole, so a task that is run again only replaces it.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs

        fs, base = pyarrow.fs.FileSystem.from_uri(target)
        names: list[tuple[str, str]] = []
        rows = (r for b in batches for r in zip(*map(_values, b.columns), strict=True))
        for file, own in groupby(rows, key=itemgetter(0)):
            name, _, of = file.partition("/")
            out = None
            for pmid, records in groupby(own, key=itemgetter(1)):
                parts: list[list[tuple]] = [[] for _ in range(6)]
                for _, _, part, place, x in records:
                    parts[part].append((place, x))
                if out is None and (parts[_ARTICLE] or parts[_DELETED]):
                    half = f"{base}/.{uuid.uuid4().hex}"
                    raw = fs.open_output_stream(half, compression=None)
                    out = gzip.GzipFile(fileobj=raw, mode="wb", filename="", compresslevel=1, mtime=0)
                    out.write(b"<PubmedArticleSet>")
                if out is not None and pmid is not None:
                    out.write(_record(parts))
            if out is not None:
                out.write(b"</PubmedArticleSet>\n")
                out.close()
                raw.close()
                fs.move(half, f"{base}/{name}")
                names.append((name, of or name))
        yield pa.RecordBatch.from_arrays([pa.array([n[i] for n in names], pa.string()) for i in (0, 1)], ["file_name", "of"])

    return write


def release(spark: SparkSession, sf: str, records: int = RECORDS) -> tuple[str, DataFrame]:
    """A data folder of release files with the articles (every loaded row), their children and the deletions: its path, and (file_name, of), the
    written files and the source file of each.  All rows of a pmid in a source file are in one file.

    The texts of a file meet in one shuffle, sorted as they stand in it, and go from there into the file.
    """
    keys = reduce(DataFrame.unionByName, [read_table(spark, sf, n).select("source_file") for n in ("article", "deleted_pmid")])
    pieces = F.least(F.lit(1) + F.floor(F.count("*") / records), F.lit(PIECES))
    stem, digits = (F.regexp_extract("source_file", r"\A(pubmed\d\dn)(\d+)", i) for i in (1, 2))
    large = keys.groupBy("source_file").agg(pieces.alias("pieces")).where("pieces > 1").withColumns({"stem": stem, "digits": digits.cast("bigint")})
    every = _parts(spark, sf).where("source_file is not null").join(F.broadcast(large), "source_file", "left")  # of ``records`` rows at least each, so few
    piece = F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64("pmid"), F.col("pieces"))).otherwise(0)
    name = F.concat("stem", (F.col("piece") * 1_000_000 + F.col("digits")).cast("string"), F.lit(".xml.gz"))
    file = F.when(F.col("piece") == 0, F.col("source_file")).otherwise(F.concat(name, F.lit("/"), "source_file"))
    rows = every.withColumn("piece", piece).select(file.alias("file"), "pmid", "part", "place", "at", F.coalesce("x", F.lit("")).alias("x")).repartition("file")
    rows = rows.withColumn("key", F.xxhash64("file")).sortWithinPartitions("key", "file", "pmid", "part", "place", "at", "x")
    folder = scratch(spark)
    fs = Files(spark, folder)
    fs.mkdirs(f"{folder}/updatefiles")
    rows = rows.select("file", "pmid", "part", "place", F.col("x").cast("binary").alias("x"))
    target = fs.uri(f"{folder}/updatefiles")
    target = target.removeprefix("file:") if not target.startswith("file://") else target
    rows.mapInArrow(_writer(target), "file_name string, of string").write.parquet(f"{folder}/names")
    return folder, spark.read.parquet(f"{folder}/names")


#: Loaded tables with the columns whose characters are counted.
COUNTED = {
    "article": ("article_title", "volume", "issue", "pub_year", "pub_month", "pub_day", "medline_date", "issn_linking", "nlm_catalog_id"), "abstract_text": ("text", "label", "nlm_category"),
    "author": ("name", "orcid"), "author_affiliation": ("affiliation",), "mesh_heading": ("descriptor_ui",), "mesh_qualifier": ("qualifier_ui", "qualifier_name"), "publication_type": ("type_ui",),
    "article_id": ("id_value",), "history": (), "deleted_pmid": (),
}


def q36_load_round_trip(spark: SparkSession, sf: str, records: int = RECORDS) -> DataFrame:
    """Every table of citations written as release files, loaded, and counted per table and file: rows and characters; the registry's counts beside them."""
    folder, names = release(spark, sf, records)
    store = Store(spark, f"{folder}/store")
    loading.load_files(store, local_files(store, folder), group=1_000, least=LOADED)
    chars = lambda cols: reduce(lambda x, y: x + y, [F.coalesce(F.length(c), F.lit(0)) for c in cols], F.lit(0)).cast("bigint")
    row = lambda t, n, x: [F.lit(t).alias("table_name"), "source_file", n.cast("bigint").alias("n"), x.cast("bigint").alias("n_chars")]
    out = [store.table(t).select(*row(t, F.lit(1), chars(cols))) for t, cols in COUNTED.items()]
    counts = {"registry articles": "n_articles", "registry deletions": "n_deletions", "registry failed": "n_failed"}
    files = store.registry().withColumnRenamed("file_name", "source_file")
    out += [files.select(*row(k, F.col(c), F.lit(0))) for k, c in counts.items()]
    pieces = names.where("file_name <> of").withColumnRenamed("file_name", "source_file")
    found = reduce(DataFrame.unionByName, out).join(F.broadcast(pieces), "source_file", "left")  # few files are pieces of another
    return found.groupBy("table_name", F.coalesce("of", "source_file").alias("source_file")).agg(F.sum("n").alias("n"), F.sum("n_chars").alias("n_chars"))


def q39_journals(spark: SparkSession, sf: str) -> DataFrame:
    """Journals written as the overview text and read back."""
    j, at = read_table(spark, sf, "journal"), scratch(spark)
    line = lambda key, c: F.concat(F.lit(f"{key}: "), F.coalesce(F.col(c), F.lit("")), F.lit("\n"))
    block = F.concat(F.lit(journals.RULE + "\n"), line("JournalTitle", "title"), line("MedAbbr", "abbreviation_medline"), line("IsoAbbr", "abbreviation_iso"), line("NlmId", "nlm_catalog_id"))
    j.select(block.alias("value")).write.text(f"{at}/overview")
    return journals.read(spark, f"{at}/overview")["journal"].select("nlm_catalog_id", "title", "abbreviation_medline", "abbreviation_iso")


def q40_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The list of pmids written in order and read back, with its lines counted."""
    at = f"{scratch(spark)}/pmids.txt.gz"
    exports.write_manifest(read_table(spark, sf, "article").select("pmid"), at)
    n = spark.read.text(at).count()
    return exports.read_manifest(spark, at).withColumn("n_lines", F.lit(n).cast("bigint"))


QUERIES = {f.__name__: f for f in (q36_load_round_trip, q39_journals, q40_manifest)}


def _flat(x: str) -> str:
    """Text as the loader keeps it: white space collapsed, NULL if nothing is left."""
    spaces = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160) || " + " || ".join(f"chr({c})" for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
    return rf"nullif(trim(regexp_replace({x}, '[\s\p{{Z}}\x0B]+', ' ', 'g'), {spaces}), '')"


def _chars(*parts: str) -> str:
    return "cast(sum(" + " + ".join(f"coalesce(length({p}), 0)" for p in parts or ("''",)) + ") as bigint)"


def _children(table: str, condition: str, *parts: str, name: str | None = None) -> str:
    return f"select '{name or table}' as table_name, source_file, count(*) as n, {_chars(*parts)} as n_chars from {table} x where exists (from kept k where k.pmid = x.pmid and k.source_file = x.source_file) and {condition} group by source_file"


_FLAT = [_flat(c) for c in ("article_title", "volume", "issue")]
ORACLE = {
    "q36_load_round_trip": f"""
with usable as (select * from article where {_flat("article_title")} is not null and {_flat("nlm_catalog_id")} is not null),
kept as (select unnest(arg_max(a, loaded_at)) from usable a group by pmid, source_file),
named as (select *, row_number() over (partition by pmid, source_file, position) as rn from author)
"""
    + "\nunion all ".join([
        f"select 'article' as table_name, source_file, count(*) as n, {_chars(*_FLAT, 'pub_year', 'pub_month', 'pub_day', 'medline_date', _flat('issn_linking'), _flat('nlm_catalog_id'))} as n_chars from kept group by source_file",
        _children("abstract_text", f"{_flat('text')} is not null", _flat("text"), "label", "nlm_category"),
        _children("author", "true", _flat("name"), "case when kind <> 'collective' then orcid end"),
        _children("author_affiliation", f"{_flat('affiliation')} is not null and exists (from author a where a.pmid = x.pmid and a.source_file = x.source_file and a.position = x.position and a.kind <> 'collective')", _flat("affiliation")),
        _children("mesh_qualifier", "true", "descriptor_ui", name="mesh_heading"), _children("mesh_qualifier", "true", "qualifier_ui", _flat("qualifier_name")),
        "select 'publication_type', source_file, count(*), count(*) * 7 from kept group by source_file",
        "select 'article_id', source_file, count(*), cast(sum(length(trim(issn_linking))) as bigint) from kept where trim(issn_linking) <> '' group by source_file",
        "select 'history', source_file, count(*), 0 from kept where date_revised is not null group by source_file",
        "select 'deleted_pmid', source_file, count(*), 0 from deleted_pmid where pmid is not null group by source_file",
        "select 'registry articles', f, (select count(*) from kept where source_file = f), 0 from (select source_file as f from article union select source_file from deleted_pmid)",
        "select 'registry deletions', f, (select count(*) from deleted_pmid where source_file = f and pmid is not null), 0 from (select source_file as f from article union select source_file from deleted_pmid)",
        "select 'registry failed', f, (select count(*) from article where source_file = f) - (select count(*) from usable where source_file = f), 0 from (select source_file as f from article union select source_file from deleted_pmid)",
    ]),
    "q40_manifest": "select distinct pmid, (select count(distinct pmid) from article) as n_lines from article",
    "q39_journals": f"select nlm_catalog_id, {_flat('title')} as title, {_flat('abbreviation_medline')} as abbreviation_medline, {_flat('abbreviation_iso')} as abbreviation_iso from journal where {_flat('nlm_catalog_id')} is not null",
}
