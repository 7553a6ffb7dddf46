"""A query per operator of the engine over the test tables, with its SQL.

The tables hold no identifiers of other kinds and no headings, so those operators run on the nearest columns: journal and
description identifiers stand for identifier types.  The SQL takes other ways than the operators where there are any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import status, store
from ..functions import dates, ids, text
from ..operators import documents, versions
from ..session import read_table, scratch
from ..sinks import exports
from ..validate import checks, fields, structure
from ..validate import run as validation

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


# ---- SQL fragments

#: White space as a set of characters for trim, and as a class for patterns.
_SPACES = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || " + " || ".join(f"chr({c})" for c in (0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
_WS = r"[\s\p{Z}\x0B]"


def _strip(x: str) -> str:
    return f"trim({x}, {_SPACES})"


def _collapse(x: str) -> str:
    return _strip(f"regexp_replace({x}, '{_WS}+', ' ', 'g')")


#: Current versions: the row of the highest place in the order, unless a tombstone stands at or after it.
_LATEST = """
top as (select unnest(arg_max(a, (file_order_key, source_file, loaded_at))) from article a group by pmid),
la as (from top where not exists (from deleted_pmid d where d.pmid = top.pmid and d.file_order_key >= top.file_order_key))
"""


def _month(x: str) -> str:
    """A month by the calendar: its number as a date of 2000, or its first three letters read as a date."""
    s = _strip(x)
    return (
        f"coalesce(case when regexp_full_match({s}, '[0-9]+') then coalesce(strftime(make_date(2000, nullif(greatest(least(try_cast({s} as hugeint), 13), 0) % 13, 0)::int, 1), '%b'), '') "
        f"when regexp_full_match({s}, '\\p{{L}}{{3,}}') then coalesce(strftime(try_strptime(left({s}, 3), '%b'), '%b'), {s}) else {s} end, '')"
    )


#: The steps of a publication date, one table after the other: free text, its year and what follows, the month of both, the day, the rendered date.
_DATES = f"""
d1 as (select *, coalesce({_strip("medline_date")}, '') as free, ltrim(coalesce(medline_date, ''), {_SPACES}) as f from {{source}}),
d2 as (select *, case when regexp_full_match(left(f, 4), '[0-9]{{4}}') then left(f, 4) else '' end as free_year from d1),
d3 as (select *, case when free_year <> '' and ltrim(f[5:], {_SPACES}) <> f[5:] then split_part(ltrim(f[5:], {_SPACES}), chr(10), 1) else '' end as after_year from d2),
d4 as (select *, case when pub_year <> '' then pub_year else free_year end as year, {_month("pub_month")} as own_month, {_month("after_year")} as free_month, coalesce({_strip("pub_day")}, '') as day from d3),
dated as (
  select *, case when own_month <> '' then own_month else free_month end as month,
    case when free <> '' then free else array_to_string(list_filter([coalesce({_strip("pub_year")}, ''), own_month, case when own_month = '' then '' when regexp_full_match(day, '[0-9]+') then coalesce(nullif(ltrim(day, '0'), ''), '0') else day end], lambda x: x <> ''), ' ') end as pub_date
  from d4)
"""


def _dated(source: str) -> str:
    return _DATES.replace("{source}", source)


# ---- versions


@query(f"with {_LATEST} select pmid, source_file, file_order_key, article_title from la")
def q01_latest_article(spark, sf):
    """Newest version that isn't deleted."""
    la = versions.latest(_t(spark, sf, "article"), _t(spark, sf, "deleted_pmid"))
    return la.select("pmid", "source_file", "file_order_key", "article_title")


@query("select pmid, max(file_order_key) as del_order from deleted_pmid group by pmid")
def q02_last_delete(spark, sf):
    """Last tombstone of each pmid."""
    return versions.last_delete(_t(spark, sf, "deleted_pmid"))


# ---- ordered concatenation and sets

_ABS = "select pmid, source_file, string_agg(text, ' ' order by seq, text) as abstract from abstract_text a {where} group by pmid, source_file"


@query(_ABS.format(where=""))
def q03_abstracts(spark, sf):
    """Sections joined in order, per version."""
    return documents.abstracts(_t(spark, sf, "abstract_text"))


@query(f"with {_LATEST} " + _ABS.format(where="where exists (select 1 from la where la.pmid = a.pmid and la.source_file = a.source_file)"))
def q05_latest_abstracts(spark, sf):
    """The same for current versions only: semi join before the aggregate."""
    la = versions.latest(_t(spark, sf, "article"), _t(spark, sf, "deleted_pmid"))
    return documents.abstracts(versions.of_versions(_t(spark, sf, "abstract_text"), la))


def _ids(spark, sf):
    """Identifier rows: the two journal numbers of an article under the exported types' names, and one that isn't exported."""
    a = _t(spark, sf, "article")
    pairs = F.array(
        F.struct(F.lit("doi").alias("id_type"), F.col("issn_linking").alias("id_value")),
        F.struct(F.lit("pmc").alias("id_type"), F.col("nlm_catalog_id").alias("id_value")),
        F.struct(F.lit("pii").alias("id_type"), F.col("volume").alias("id_value")),
    )
    return a.select("pmid", "source_file", F.inline(pairs))


@query("""
with i as (
  select pmid, source_file, 'doi:' || issn_linking as c from article union all select pmid, source_file, 'PMCID:' || nlm_catalog_id from article)
select pmid, source_file, 'PMID:' || pmid || coalesce('|' || string_agg(distinct c, '|' order by c), '') as identifiers
from i group by pmid, source_file
""")
def q04_identifiers(spark, sf):
    """Set of prefixed identifiers, the pmid first."""
    c = documents.identifiers(_ids(spark, sf))
    every = F.concat(F.array(ids.curie("PMID", F.col("pmid"))), "curies")
    return c.select("pmid", "source_file", F.array_join(every, "|").alias("identifiers"))


# ---- anti and semi joins


@query(f"with {_LATEST} select distinct pmid from deleted_pmid except select pmid from la")
def q06_standing_deletions(spark, sf):
    """Deleted pmids without a current version, the pool of the deletion checks."""
    la = versions.latest(_t(spark, sf, "article"), _t(spark, sf, "deleted_pmid"))
    return validation.standing_deletions(_t(spark, sf, "deleted_pmid"), la)


@query(f"with {_LATEST}, p as (select distinct pmid from deleted_pmid except select pmid from la) select pmid from p order by md5('7:' || pmid), pmid limit 10")
def q06_deletion_sample(spark, sf):
    """Ten of them by seed, as the check of deletions takes."""
    la = versions.latest(_t(spark, sf, "article"), _t(spark, sf, "deleted_pmid"))
    return validation.deletion_sample(_t(spark, sf, "deleted_pmid"), la, 10, 7)


@query(f"""with {_LATEST}
select count(*) as n_authors, count(distinct name) as n_names from author a
where exists (select 1 from la where la.pmid = a.pmid and la.source_file = a.source_file)""")
def q07_latest_children(spark, sf):
    """Child rows of current versions (as the Parquet export keeps them)."""
    la = versions.latest(_t(spark, sf, "article"), _t(spark, sf, "deleted_pmid"))
    return versions.of_versions(_t(spark, sf, "author"), la).agg(F.count("*").alias("n_authors"), F.count_distinct("name").alias("n_names"))


# ---- dimension join, defaults


@query("""
select pmid, source_file, coalesce(j.title, '') as journal_name, coalesce(j.abbreviation_iso, j.abbreviation_medline, '') as journal_abbrev,
       coalesce(volume, '') as volume, coalesce(issue, '') as issue
from article a left join journal j on a.nlm_catalog_id = j.nlm_catalog_id""")
def q08_journal_names(spark, sf):
    """Journal dimension with preference chain; an empty preferred value doesn't fall through."""
    j = _t(spark, sf, "journal").select("nlm_catalog_id", "title", "abbreviation_iso", "abbreviation_medline")
    a = _t(spark, sf, "article").join(j, "nlm_catalog_id", "left")
    abbrev = F.coalesce("abbreviation_iso", "abbreviation_medline", F.lit(""))
    empty = [text.or_empty(F.col(c)).alias(c) for c in ("volume", "issue")]
    return a.select("pmid", "source_file", text.or_empty(F.col("title")).alias("journal_name"), abbrev.alias("journal_abbrev"), *empty)


# ---- composite keys


@query("""
select a.pmid, a.source_file, coalesce(n.n_authors, 0) as n_authors, coalesce(m.n_qualifiers, 0) as n_qualifiers
from (select distinct pmid, source_file from article) a
left join (select pmid, source_file, count(*) as n_authors from author group by 1, 2) n on a.pmid = n.pmid and a.source_file = n.source_file
left join (select pmid, source_file, count(*) as n_qualifiers from mesh_qualifier group by 1, 2) m on a.pmid = m.pmid and a.source_file = m.source_file
""")
def q09_version_counts(spark, sf):
    """Two aggregates joined back on the version key."""
    key = list(versions.VERSION)
    base = _t(spark, sf, "article").select(*key).distinct()
    n = _t(spark, sf, "author").groupBy(*key).agg(F.count("*").alias("n_authors"))
    m = _t(spark, sf, "mesh_qualifier").groupBy(*key).agg(F.count("*").alias("n_qualifiers"))
    out = base.join(n, key, "left").join(m, key, "left")
    return out.select(*key, *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_authors", "n_qualifiers")])


# ---- registry aggregates (A4-A9 P8 P9 P11 status)

_NEEDS = "downloaded_at is not null and (processed_at is null or downloaded_at > processed_at)"


@query(f"""
select count(*) as known_files, count(downloaded_at) as downloaded_files, count(downloaded_at) filter (where kind = 'baseline') as baseline_files,
  count(downloaded_at) filter (where kind = 'update') as update_files, max(downloaded_at) as last_download, count(processed_at) as loaded_files, count(*) filter (where {_NEEDS}) as pending_files,
  max(processed_at) as last_load, cast(coalesce(sum(n_failed), 0) + coalesce(sum(n_book_records), 0) as bigint) as skipped_records from source_file""")
def q10_registry_summary(spark, sf):
    """Filtered counts, latest times and null-safe sums of the registry, as the status shows them."""
    return status.registry_summary(_t(spark, sf, "source_file")).drop("baseline_years")


@query("select array_to_string(list_sort(list(distinct year_yy) filter (where kind = 'baseline' and downloaded_at is not null)), '|') as years from source_file")
def q11_baseline_years(spark, sf):
    """Sorted distinct years under a filter."""
    return status.registry_summary(_t(spark, sf, "source_file")).select(F.array_join(F.col("baseline_years").cast("array<string>"), "|").alias("years"))


@query(f"with {_LATEST} select 'article_versions' as name, count(*) as n from article union all select 'latest_documents', count(*) from la union all select 'journals', count(*) from journal")
def q12_table_counts(spark, sf):
    """Versions, current versions and journals, as the status shows them."""
    return status.table_counts(_t(spark, sf, "article"), _t(spark, sf, "deleted_pmid"), _t(spark, sf, "journal"))


@query("select distinct lang, source from documents")
def q13_distinct(spark, sf):
    return _t(spark, sf, "documents").select("lang", "source").distinct()


@query(f"select file_name from source_file where {_NEEDS}")
def q21_needs_load(spark, sf):
    """Files downloaded after they were last processed."""
    return _t(spark, sf, "source_file").where(store.needs_load()).select("file_name")


@query(f"""
select file_name from (select distinct file_name from load_log union select 'pubmed99n0001.xml.gz')
where file_name not in (select file_name from source_file where file_name is not null) or file_name in (select file_name from source_file where {_NEEDS})""")
def q22_pending_files(spark, sf):
    """Listed files that are due by the registry; an unregistered file is."""
    listed = _t(spark, sf, "load_log").select("file_name").union(spark.createDataFrame([("pubmed99n0001.xml.gz",)], "file_name string")).distinct()
    return store.due(listed, _t(spark, sf, "source_file"))


@query("""
select coalesce(s.file_name, l.file_name) as file_name, kind, coalesce(l.md5, published_md5) as published_md5, coalesce(s.file_order_key, 99000000 + l.number) as file_order_key,
  case when l.file_name is null or (s.file_name is not null and not l.changed) then downloaded_at else timestamp '2026-01-01' end as downloaded_at, processed_at
from source_file s full join (
  select file_name, md5(file_name) as md5, attempt % 2 = 0 as changed, 0 as number from (select file_name, max(attempt_id) as attempt from load_log group by file_name) union all select 'pubmed99n0001.xml.gz', md5('pubmed99n0001.xml.gz'), false, 1) l
on s.file_name = l.file_name""")
def q22_registry_after_download(spark, sf):
    """The registry after a download of what the log lists and one new file: checksums are taken over, times of changed files only."""
    log = _t(spark, sf, "load_log").groupBy("file_name").agg((F.max("attempt_id") % 2 == 0).alias("changed"))
    fresh = log.union(spark.createDataFrame([("pubmed99n0001.xml.gz", False)], "file_name string, changed boolean"))
    registry = _t(spark, sf, "source_file")
    at = F.lit("2026-01-01").cast(dict(registry.dtypes)["downloaded_at"])
    new = fresh.select("file_name", F.lit(None).cast("string").alias("kind"), F.md5("file_name").alias("published_md5"), "changed", at.alias("at"))
    return store.merge_download(registry, new).select("file_name", "kind", "published_md5", "file_order_key", "downloaded_at", "processed_at")


# ---- keep last, keep first


@query("""
select pmid, source_file, article_title, loaded_at from (
  select *, row_number() over (partition by source_file, pmid order by loaded_at desc) as rn from article) where rn = 1""")
def q14_keep_last(spark, sf):
    """The last load of each version."""
    last = versions.keep_last(_t(spark, sf, "article"), ["source_file", "pmid"], "loaded_at")
    return last.select("pmid", "source_file", "article_title", "loaded_at")


@query("select pmid, min(doc_id) as doc_id from documents where pmid is not null group by pmid")
def q15_keep_first(spark, sf):
    """The first document of each pmid."""
    return versions.keep_first(_t(spark, sf, "documents").where("pmid is not null"), ["pmid"], "doc_id").select("pmid", "doc_id")


# ---- dates


@query(f"select pub_month as raw, {_month('pub_month')} as month, count(*) as n from article group by 1, 2")
def q16_month(spark, sf):
    return _t(spark, sf, "article").groupBy(F.col("pub_month").alias("raw"), dates.month(F.col("pub_month")).alias("month")).agg(F.count("*").alias("n"))


@query(f"with {_dated('article')} select distinct pmid, source_file, year, month from dated")
def q17_year_and_month(spark, sf):
    """Year and month with the free-text date as fallback."""
    y, m = dates.pub_year(F.col("pub_year"), F.col("medline_date")), dates.pub_month(F.col("pub_month"), F.col("medline_date"))
    return _t(spark, sf, "article").select("pmid", "source_file", y.alias("year"), m.alias("month")).distinct()


@query(f"with {_dated('article')} select pub_year, pub_month, pub_day, medline_date, pub_date, count(*) as n from dated group by all")
def q18_pub_date(spark, sf):
    parts = [F.col(c) for c in ("pub_year", "pub_month", "pub_day", "medline_date")]
    return _t(spark, sf, "article").groupBy(*parts, dates.pub_date(*parts).alias("pub_date")).agg(F.count("*").alias("n"))


@query(f"""with {_dated('article')}, w as (select distinct pub_date, string_split(pub_date, ' ') as w from dated)
select pub_date, array_to_string(list_concat([w[1]], case when len(w) > 1 then [{_month('w[2]')}] else [] end,
  case when len(w) > 2 then [case when regexp_full_match({_strip('w[3]')}, '[0-9]+') then coalesce(nullif(ltrim({_strip('w[3]')}, '0'), ''), '0') else {_strip('w[3]')} end] else [] end, w[4:]), ' ') as comparable from w""")
def q18_comparable_date(spark, sf):
    """Rendered dates as the field check compares them."""
    d = _t(spark, sf, "article").select(dates.pub_date(*[F.col(c) for c in ("pub_year", "pub_month", "pub_day", "medline_date")]).alias("pub_date")).distinct()
    return d.select("pub_date", dates.comparable_date(F.col("pub_date")).alias("comparable"))


@query(f"select doc_id, length({_strip('text')}) as n_stripped, length({_collapse('text')}) as n_collapsed from documents")
def q19_whitespace(spark, sf):
    """Strip and collapse white space."""
    size = lambda c: F.length(c).cast("bigint")
    return _t(spark, sf, "documents").select("doc_id", size(text.strip(F.col("text"))).alias("n_stripped"), size(text.collapse(F.col("text"))).alias("n_collapsed"))


@query(r"""select file_name, try_cast(nullif(regexp_extract(file_name, '^pubmed(\d{2})n(\d+)\.xml\.gz$', 1), '') as bigint) * 1000000
  + try_cast(nullif(regexp_extract(file_name, '^pubmed(\d{2})n(\d+)\.xml\.gz$', 2), '') as bigint) as order_key from source_file""")
def q20_order_key(spark, sf):
    """Order key from the file name."""
    return _t(spark, sf, "source_file").select("file_name", ids.order_key(F.col("file_name")).alias("order_key"))


# ---- set differences

_MIRRORED = "select distinct pmid from article_mirror"


@query(f"""with {_LATEST}, gone as ({_MIRRORED} except select pmid from la)
select pmid, 'added' as change from (select pmid from la except {_MIRRORED})
union all select pmid, case when pmid in (select pmid from deleted_pmid) then 'explained' else 'unexplained' end from gone""")
def q23_set_drift(spark, sf):
    """Pmids of one set but not of the other, both ways; a dropped one is explained by a deletion that stands."""
    deleted = _t(spark, sf, "deleted_pmid")
    now = versions.latest(_t(spark, sf, "article"), deleted).select("pmid")
    return validation.set_changes(now, _t(spark, sf, "article_mirror").select("pmid").distinct(), deleted, now)


@query(f"with {_LATEST} select pmid, 'added' as change from (select pmid from la except {_MIRRORED}) union all select pmid, 'unexplained' from ({_MIRRORED} except select pmid from la)")
def q24_drift_without_database(spark, sf):
    """The same where no database can tell of deletions."""
    now = versions.latest(_t(spark, sf, "article"), _t(spark, sf, "deleted_pmid")).select("pmid")
    return validation.set_changes(now, _t(spark, sf, "article_mirror").select("pmid").distinct())


@query("""
with a as (select pmid, source_file, list_sort(list(distinct lower(name))) as names from author where name is not null group by 1, 2),
     r as (select pmid, source_file, list_sort(list(distinct lower(name))) as names from author where name is not null and valid group by 1, 2)
select a.pmid, a.source_file, a.names = r.names as same from a join r on a.pmid = r.pmid and a.source_file = r.source_file""")
def q25_set_equality(spark, sf):
    """Case-folded set equality of all and of the valid author names of a version."""
    key = list(versions.VERSION)
    named = _t(spark, sf, "author").where("name is not null")
    folded = lambda df, out: df.groupBy(*key).agg(text.folded_set(F.collect_set("name")).alias(out))
    both = folded(named, "x").join(folded(named.where("valid"), "y"), key)
    return both.select(*key, (F.col("x") == F.col("y")).alias("same"))


@query("""
(select pmid, source_file, article_title, volume, issue, pub_year from article except all select pmid, source_file, article_title, volume, issue, pub_year from article_mirror)
""")
def q25_except_all(spark, sf):
    """Multiset difference of two copies."""
    cols = ["pmid", "source_file", "article_title", "volume", "issue", "pub_year"]
    return _t(spark, sf, "article").select(*cols).exceptAll(_t(spark, sf, "article_mirror").select(*cols))


# ---- JSON and structure


def _exported(spark, sf, docs: DataFrame) -> list[str]:
    """Shards of documents written by the export's own sink."""
    at = scratch(spark)
    exports.write_ndjson(docs, at, gzip_output=False)
    return structure.find_shards(spark, at)


def _documents(spark, sf) -> DataFrame:
    t = lambda n: _t(spark, sf, n)
    return documents.documents(t("article"), t("deleted_pmid"), t("journal"), t("abstract_text"), _ids(spark, sf))


def _versions_as_documents(spark, sf) -> DataFrame:
    """A document per row of article, with what lies in it: volume is absent where null, and issue null."""
    a = _t(spark, sf, "article")
    cols = {f: F.lit("") for f in documents.FIELDS} | {"id": ids.curie("PMID", F.col("pmid")), "identifiers": F.array(ids.curie("PMID", F.col("pmid")), ids.curie("ISSN", text.or_empty(F.col("issn_linking"))))}
    months = dates.pub_month(F.col("pub_month"), F.col("medline_date"))
    return a.select(*[c.alias(f) for f, c in (cols | {"pub_month": months, "issue": F.col("issue"), "article_title": text.or_empty(F.col("article_title"))}).items()], F.lit("x").alias("extra"))


@query("""select 'prefix' as sort, 'PMID' as name, count(*) as n from article union all select 'prefix', 'ISSN', count(*) from article union all select 'extra', 'extra', count(*) from article""")
def q26_names_in_lines(spark, sf):
    """Records per missing field, extra field and prefix of identifiers of exported lines."""
    return structure.named(structure.lines(spark, _exported(spark, sf, _versions_as_documents(spark, sf))))


@query("select pmid, count(*) as n from article group by pmid having count(*) > 1")
def q27_duplicates(spark, sf):
    """Pmids on several lines."""
    return structure.duplicates(structure.lines(spark, _exported(spark, sf, _versions_as_documents(spark, sf))))


_ONE = "|".join(dates.MONTHS + dates.SEASONS)


@query(f"""with {_dated('article')}
select source_file, count(*) as n, count(*) filter (where pmid is null or pmid < 0) as bad_ids, count(*) filter (where month <> '' and not regexp_full_match(month, '({_ONE})(-({_ONE}))?')) as bad_months
from dated group by source_file""")
def q28_shape_checks(spark, sf):
    """Per file: identifiers and months outside their closed form."""
    m = dates.pub_month(F.col("pub_month"), F.col("medline_date"))
    return _t(spark, sf, "article").groupBy("source_file").agg(
        F.count("*").alias("n"), F.count_if(~ids.curie("PMID", F.col("pmid")).rlike(r"\APMID:[0-9]+\z")).alias("bad_ids"), F.count_if(~m.rlike(dates.VALID_MONTH)).alias("bad_months")
    )


_COMPARED = ("article_title", "volume", "issue", "pub_year")


@query(
    f"with {_LATEST}, e as (select * from la), o as (select pmid, source_file, {', '.join(f'min({f}) as {f}' for f in _COMPARED)} from article_mirror group by all), x as ("
    + " union all ".join(
        f"select '{f}' as field, coalesce({_collapse('e.' + f)}, '') as a, coalesce({_collapse('o.' + f)}, '') as b from e join o on e.pmid = o.pmid and e.source_file = o.source_file" for f in _COMPARED
    )
    + ") select field, case when a = '' then 'exported_blank' when b = '' then 'entrez_blank' else 'values_differ' end as kind, count(*) as n from x where a <> b group by all"
)
def q29_mismatch_kinds(spark, sf):
    """Differences of current versions from the other copy by field and kind, as the field check counts them."""
    return fields.tally(_against_mirror(spark, sf)).select("field", "kind", "n")


@query(
    f"with {_LATEST}, o as (select pmid, source_file, {', '.join(f'min({f}) as {f}' for f in _COMPARED)} from article_mirror group by all), e as (select la.* from la), "
    f"p as (select {', '.join(f'coalesce({_collapse(s + chr(46) + f)}, {chr(39) * 2}) as {s}_{f}' for f in _COMPARED for s in 'eo')} from e join o on e.pmid = o.pmid and e.source_file = o.source_file) "
    + " union all ".join(f"select 'core' as tier, '{f}' as field, count(*) as n, count(*) filter (where e_{f} <> o_{f}) as wrong from p" for f in _COMPARED)
    + "".join(f" union all select '{tier}', '{f}', count(*), 0 from p" for tier, f in (*(("core", f) for f in ("pub_month", "pub_day")), *(("soft", f) for f in fields.SOFT), ("identifiers", "identifiers")))
    + " union all select 'absent', '', (select count(*) from e) - count(*), 0 from p"
)
def q29_comparisons(spark, sf):
    """Comparisons and differences by tier and field, from which the mismatch rate follows; records the other side lacks are absent."""
    per = _against_mirror(spark, sf).groupBy("tier", "field")
    return per.agg(F.count("*").alias("n"), F.count_if("differs").alias("wrong"))


def _against_mirror(spark, sf) -> DataFrame:
    """The field check's comparison of current versions with the other copy's rows of the same version."""
    la = versions.latest(_t(spark, sf, "article"), _t(spark, sf, "deleted_pmid"))
    other = _t(spark, sf, "article_mirror").groupBy(*versions.VERSION).agg(*[F.min(f).alias(f) for f in _COMPARED])
    blank = {f: F.array().cast("array<string>") if f == "identifiers" else F.lit("") for f in documents.FIELDS}
    docs = lambda df: df.select("pmid", *[(F.col(f) if f in _COMPARED else c).alias(f) for f, c in blank.items()])
    same = other.join(la.select(*versions.VERSION), list(versions.VERSION), "left_semi")
    return fields.compare(docs(la), docs(same), 0.9)


# ---- the document


@query(f"""with {_LATEST}, {_dated('la')},
abs as ({_ABS.format(where="where exists (select 1 from la where la.pmid = a.pmid and la.source_file = a.source_file)")})
select 'PMID:' || d.pmid as id, array_to_string(list_concat(['PMID:' || d.pmid], list_sort(list_distinct(list_filter(['doi:' || issn_linking, 'PMCID:' || d.nlm_catalog_id], lambda x: x is not null)))), '|') as identifiers,
  coalesce(j.title, '') as journal_name, coalesce(j.abbreviation_iso, j.abbreviation_medline, '') as journal_abbrev, coalesce(article_title, '') as article_title, coalesce(volume, '') as volume,
  coalesce(issue, '') as issue, year as pub_year, month as pub_month, coalesce(pub_day, '') as pub_day, pub_date, coalesce(abstract, '') as abstract
from dated d left join journal j on d.nlm_catalog_id = j.nlm_catalog_id left join abs on d.pmid = abs.pmid and d.source_file = abs.source_file""")
def q30_documents(spark, sf):
    """The twelve-field document of every current version."""
    return _documents(spark, sf).withColumn("identifiers", F.array_join("identifiers", "|"))


@query("select distinct 'PMID:' || pmid as id from article")
def q31_curie(spark, sf):
    return _t(spark, sf, "article").select(ids.curie("PMID", F.col("pmid")).alias("id")).distinct()


@query(r"""select attempt_id, lower(nullif(regexp_extract('MD5 (x) = ' || loaded_md5, '\b([0-9a-fA-F]{32})\b', 1), '')) as checksum, md5(file_name) as digest
from load_log group by all""")
def q32_checksums(spark, sf):
    """Checksum token of a line of text, and digests."""
    line = F.concat(F.lit("MD5 (x) = "), "loaded_md5")
    return _t(spark, sf, "load_log").select("attempt_id", ids.checksum(line).alias("checksum"), F.md5("file_name").alias("digest")).distinct()


@query("""select kind, file_name, file_order_key from (
  select *, row_number() over (partition by kind order by file_order_key desc) as rn from source_file) where rn <= 3""")
def q33_newest_files(spark, sf):
    """Newest three files of each kind (the download limit)."""
    top = versions.newest(_t(spark, sf, "source_file"), ["kind"], [F.desc("file_order_key")], 3)
    return top.select("kind", "file_name", "file_order_key")


# ---- samples and similarity


@query("select source as shard, doc_id as pmid from (select *, row_number() over (partition by source order by md5('0:' || doc_id), doc_id) as rn from documents) where rn <= 5")
def q34_shard_sample(spark, sf):
    """Five documents of each source by a seeded digest: same size as a reservoir, the same members for any partitioning."""
    return structure.sample_lines(_t(spark, sf, "documents").select(F.col("source").alias("shard"), F.col("doc_id").alias("pmid")), 5, 0)


@query()
def q35_title_similarity(spark, sf):
    """Matching-block ratio of titles that differ between the copies (the pandas function the field check uses); SQL has no such function."""
    key = list(versions.VERSION)
    a = _t(spark, sf, "article").select(*key, "article_title").distinct()
    m = _t(spark, sf, "article_mirror").select(*key, F.col("article_title").alias("other")).distinct()
    both = a.join(m, key).where(~F.col("article_title").eqNullSafe(F.col("other")))
    return both.select(*key, F.round(fields.similarity("article_title", "other"), 3).alias("ratio"))


# ---- sinks and structure


@query(ORACLE["q30_documents"])
def q37_ndjson_round_trip(spark, sf):
    """Documents written as gzipped NDJSON shards and read back."""
    docs, at = q30_documents(spark, sf), scratch(spark)
    return spark.read.schema(docs.schema).json(exports.write_ndjson(docs, at))


_EXPORTED = ("article", "abstract_text", "author", "author_affiliation", "mesh_qualifier")


@query(f"with {_LATEST} " + " union all ".join(
    f"select '{t}' as table_name, count(*) as n, count(distinct pmid) as n_pmids from {t} x where exists (from la where la.pmid = x.pmid and la.source_file = x.source_file" + (" and la.loaded_at is not distinct from x.loaded_at" if t == "article" else "") + ")" for t in _EXPORTED
) + " union all select 'deleted_pmid', count(*), count(distinct pmid) from deleted_pmid union all select 'journal', count(*), null from journal")
def q37_parquet_round_trip(spark, sf):
    """Tables written as Parquet with children of current versions only, and read back."""
    at = scratch(spark)
    exports.export_parquet({t: _t(spark, sf, t) for t in (*_EXPORTED, "deleted_pmid", "journal")}, at)
    out = None
    for t in (*_EXPORTED, "deleted_pmid", "journal"):
        df = spark.read.parquet(f"{at}/{t}.parquet")
        pmids = F.count_distinct("pmid") if "pmid" in df.columns else F.lit(None).cast("bigint")
        part = df.agg(F.lit(t).alias("table_name"), F.count("*").alias("n"), pmids.alias("n_pmids"))
        out = part if out is None else out.unionByName(part)
    return out


_BAD = f"(select count(*) from dated where month <> '' and not regexp_full_match(month, '({_ONE})(-({_ONE}))?'))"


@query(f"""with {_dated('article')},
c as (select * from (values ('shards-found', 0), ('records-present', 0), ('shard-readable', 0), ('json-parse', 0), ('record-fields', 0),
  ('no-nulls', (select count(*) from article where issue is null)), ('id-format', 0), ('pmid-unique', (select count(*) from (select pmid from article group by pmid having count(*) > 1))),
  ('no-extra-fields', (select count(*) from article)), ('month-format', {_BAD})) as t(name, count))
select name, case when count = 0 then 'pass' when name in ('no-extra-fields', 'month-format') then 'warn' else 'fail' end as status, count from c""")
def q38_structure_checks(spark, sf):
    """The checks of structure over exported lines with known faults: nulls, repeated pmids, an extra field, months outside the set."""
    shards = _exported(spark, sf, _versions_as_documents(spark, sf))
    found = structure.scan(spark, shards, 15, 0)
    facts = structure.structure_facts(shards, found)
    vars(facts).update(counting=False, fetching=False, current=None, has_previous=False, dropped=None, low=0, high=1, threshold=0.9)
    found.facts.unpersist()
    rows = [(o.name, o.status, o.count) for o in checks.evaluate(facts) if o.section == "structure"]
    return spark.createDataFrame(rows, "name string, status string, count bigint")
