"""Queries of the general data problems (names pN_...), with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes, diff, increments, nested, orphans
from ..session import read_table


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Children of every readable payload: the supertype view over the subtype tables the automaton routes them to."""
    return nested.children(read_table(spark, sf, "raw_record"))


def p2_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes per subtype table the payloads are routed to, repeated payloads counted as they come."""
    rows = nested.nodes(read_table(spark, sf, "raw_record"), [])
    return rows.groupBy("subtype").agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("n_records"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Files due now, as the second of two runs: the first stands at the middle of the log's time and leaves its ledger and its mark, the second rereads
    the log from the oldest attempt that was open then."""
    registry, log = read_table(spark, sf, "source_file"), read_table(spark, sf, "load_log")
    middle = log.agg(F.timestamp_micros(((F.unix_micros(F.min("finished_at").cast("timestamp")) + F.unix_micros(F.max("finished_at").cast("timestamp"))) / 2).cast("bigint")).alias("t"))
    middle = middle.select(F.col("t").cast(dict(log.dtypes)["finished_at"])).first()[0]
    then = increments.as_of(log, middle)
    _, mark = increments.low_water_mark(then)
    due = increments.take(registry, log, increments.processed_ledger(then), mark).due
    return due.select("file_name").distinct()


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Current state of the article feed; every file seen is a whole transaction, so nothing is held back and no watermark sought."""
    state = changes.replay(read_table(spark, sf, "article"), read_table(spark, sf, "deleted_pmid"))
    return state.select("pmid", "source_file")


def p5_committed(spark: SparkSession, sf: str) -> DataFrame:
    """State up to the contiguous watermark: a file the registry counts more articles in than came, or that never came, holds back what follows it."""
    registry = read_table(spark, sf, "source_file").select("file_order_key", F.col("n_articles").alias("expected_rows"))
    state = changes.replay(read_table(spark, sf, "article"), read_table(spark, sf, "deleted_pmid"), registry)
    return state.select("pmid", "source_file", "file_order_key")


def p5_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions and watermark of each stream."""
    feed = changes.changes(read_table(spark, sf, "article"), read_table(spark, sf, "deleted_pmid"))
    registry = read_table(spark, sf, "source_file").select("file_order_key", F.col("n_articles").alias("expected_rows"))
    txns = changes.transactions(feed, registry)
    per = txns.groupBy("stream").agg(F.count("*").alias("n"), F.count_if("complete").alias("n_complete"))
    return per.join(changes.watermarks(txns), "stream")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """References to journals that don't exist, of both referring tables, with the release year."""
    refs = (
        read_table(spark, sf, "article")
        .select(F.lit("article").alias("table_name"), F.col("pmid").alias("row_id"), "source_file", "nlm_catalog_id")
        .unionByName(
            read_table(spark, sf, "documents").select(
                F.lit("documents").alias("table_name"), F.col("doc_id").alias("row_id"), F.col("source").alias("source_file"), "nlm_catalog_id"
            )
        )
    )
    lost = orphans.orphans(refs, read_table(spark, sf, "journal"), "nlm_catalog_id", "nlm_catalog_id")
    year = orphans.release_year(F.col("source_file")).alias("period")
    return lost.select("table_name", "row_id", "source_file", year).distinct()


def p6_report(spark: SparkSession, sf: str) -> DataFrame:
    """Orphan references per table and release year."""
    return p6_found(spark, sf).groupBy("table_name", "period").agg(F.count("*").alias("n_orphans"))


FIELDS = ("article_title", "volume", "issue", "pub_year")


def p7_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Rows on one side only and differing cells of article and its mirror, with both values."""
    return diff.differences(
        read_table(spark, sf, "article"), read_table(spark, sf, "article_mirror"), ("pmid", "source_file"), FIELDS,
        "only_in_article", "only_in_mirror",
    )


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Rows on one side only and differing fields between article and its mirror."""
    return p7_cells(spark, sf).select("pmid", "source_file", "difference")


QUERIES = {f.__name__: f for f in (p2_found, p2_variants, p4_found, p5_found, p5_committed, p5_transactions, p6_found, p6_report, p7_found, p7_cells)}

_P6 = """
select 'article' as table_name, pmid as row_id, source_file, try_cast(nullif(regexp_extract(source_file, '^[^0-9]*([0-9]{2})n', 1), '') as integer) as period
from article where nlm_catalog_id is not null and nlm_catalog_id not in (select nlm_catalog_id from journal where nlm_catalog_id is not null)
union
select 'documents', doc_id, source, try_cast(nullif(regexp_extract(source, '^[^0-9]*([0-9]{2})n', 1), '') as integer)
from documents where nlm_catalog_id is not null and nlm_catalog_id not in (select nlm_catalog_id from journal where nlm_catalog_id is not null)
"""



def _list(x: str) -> str:
    """A JSON list's members; one bare member as a list of one; nothing for null and empty text."""
    return f"""case when json_type({x}) = 'ARRAY' then json_extract({x}, '$[*]') when {x} is null or json_type({x}) = 'NULL' or {x}::varchar = '""' then []::json[] else [{x}] end"""


#: A payload that is a JSON object; json_type isn't asked of anything else, where it would raise.
_READABLE = "coalesce(case when json_valid(payload) then json_type(payload) = 'OBJECT' end, false)"


def _p2_lists(source: str) -> str:
    """Members of each list of the citation, as a chain of common tables."""
    return f"""
recs as (select record_id, payload::json as j from {source} r where {_READABLE}),
lists as (
  select record_id, {_list("json_extract(j, '$.MedlineCitation.Article.AuthorList.Author')")} as au,
    {_list("json_extract(j, '$.MedlineCitation.MeshHeadingList.MeshHeading')")} as me, {_list("json_extract(j, '$.MedlineCitation.Article.Abstract.AbstractText')")} as se from recs),
au as (select record_id, unnest(au) as x, unnest(range(1, len(au) + 1)) as pos from lists),
me as (select record_id, unnest(me) as x, unnest(range(1, len(me) + 1)) as pos from lists),
se as (select record_id, unnest(se) as x, unnest(range(0, len(se))) as pos from lists),
af as (select record_id, pos, list_concat({_list("json_extract(x, '$.AffiliationInfo')")}, {_list("json_extract(x, '$.Affiliation')")}) as l from au where json_type(x) = 'OBJECT'),
qu as (select record_id, pos, {_list("json_extract(x, '$.Qualifier')")} as l from me where json_type(x) = 'OBJECT'),
afx as (select record_id, pos, unnest(l) as x, unnest(range(1, len(l) + 1)) as place from af),
qux as (select record_id, pos, unnest(l) as x, unnest(range(1, len(l) + 1)) as place from qu)"""


_P2 = f"""
with {_p2_lists("(select distinct record_id, payload from raw_record)")}
select record_id, 'author' as child_table, cast(0 as integer) as parent_pos, cast(pos as integer) as child_pos, '' as qualifier_ui from au where json_type(x) <> 'NULL'
union select record_id, 'author_affiliation', cast(pos as integer), cast(place as integer), '' from afx where json_type(x) <> 'NULL'
union select record_id, 'mesh_qualifier', cast(pos as integer), cast(place as integer), coalesce(json_extract_string(x, '$.UI'), '') from qux where json_type(x) <> 'NULL'
union select record_id, 'abstract_text', 0, cast(pos as integer), '' from se where json_type(x) <> 'NULL'
"""


def _scalar(x: str) -> str:
    return f"coalesce(json_type({x}) not in ('OBJECT', 'ARRAY', 'NULL'), false)"


def _member(name: str) -> str:
    return _scalar(f"json_extract(x, '$.{name}')")


_P2_VARIANTS = f"""
with {_p2_lists("raw_record")},
s as (
  select record_id, case when {_scalar("x")} then 'author_text' when json_type(x) = 'ARRAY' then 'other' when {_member("CollectiveName")} then 'author_collective' else 'author_person' end as subtype
  from au where json_type(x) <> 'NULL'
  union all select record_id, case when {_scalar("x")} then 'affiliation_text' when {_member("Affiliation")} then 'affiliation_info' else 'other' end from afx where json_type(x) <> 'NULL'
  union all select record_id, case when {_scalar("x")} then 'heading_text' when json_type(x) = 'ARRAY' then 'other' else 'heading_object' end from me where json_type(x) <> 'NULL'
  union all select record_id, case when {_scalar("x")} then 'qualifier_text' when json_type(x) = 'ARRAY' then 'other' else 'qualifier_object' end from qux where json_type(x) <> 'NULL'
  union all select record_id, case when {_scalar("x")} then 'section_text' when {_member("value")} and {_member("Label")} then 'section_labelled' when {_member("value")} then 'section_plain' else 'other' end
  from se where json_type(x) <> 'NULL'
  union all select record_id, 'reject' from raw_record where not {_READABLE})
select subtype, count(*) as n, count(distinct record_id) as n_records from s group by subtype
"""

_SAME = "x.pmid is not distinct from y.pmid and x.source_file is not distinct from y.source_file"
_P7 = "\nunion all\n".join(
    [
        f"select x.pmid, x.source_file, '{f}' as difference, min(x.{f}) as left_value, min(y.{f}) as right_value from article x join article_mirror y on {_SAME} "
        f"group by all having bool_or(x.{f} is distinct from y.{f})"
        for f in FIELDS
    ]
    + [
        f"select distinct x.pmid, x.source_file, '{what}', null::varchar, null::varchar from {left} x where not exists (select 1 from {right} y where {_SAME})"
        for what, left, right in (("only_in_article", "article", "article_mirror"), ("only_in_mirror", "article_mirror", "article"))
    ]
)

_P5 = """
with feed as (
  select pmid, file_order_key as k, source_file, false as gone from article where pmid is not null and file_order_key is not null
  union select pmid, file_order_key, source_file, true from deleted_pmid where pmid is not null and file_order_key is not null),
got as (select k, count(*) as n from feed group by k),
t as (
  select k, k // 1000000 as stream, coalesce(n, 0) >= coalesce(e, 1) as done
  from (select file_order_key as k, max(n_articles) as e from source_file group by 1) s left join got using (k)
  union all select k, k // 1000000, false from got where k not in (select file_order_key from source_file)),
ordered as (select stream, k, lag(k) over (partition by stream order by k) as before from t),
held as (
  select stream, min(k) as k from (select stream, k from t where not done union all select stream, before + 1 from ordered where k - before > 1) group by stream)
"""

ORACLE = {
    "p2_found": _P2,
    "p2_variants": _P2_VARIANTS,
    "p4_found": r"""
with ok as (
  select file_name, lower(regexp_replace(loaded_md5, '[\s:\-]', '', 'g')) as b,
         row_number() over (partition by file_name order by finished_at desc nulls last, attempt_id desc) as rn
  from load_log where status = 'ok'),
reg as (select *, lower(regexp_replace(published_md5, '[\s:\-]', '', 'g')) as a from source_file),
pairs as (
  select r.file_name, downloaded_at, processed_at,
         ltrim(case when regexp_full_match(a, '(0x)?[0-9a-f]+') then regexp_replace(a, '^0x', '') end, '0') as a,
         ltrim(case when regexp_full_match(b, '(0x)?[0-9a-f]+') then regexp_replace(b, '^0x', '') end, '0') as b
  from reg r left join ok on r.file_name = ok.file_name and rn = 1)
select distinct file_name from pairs
where downloaded_at is not null
  and (processed_at is null or (a is not null and b is not null and a <> b) or ((a is null or b is null) and downloaded_at > processed_at))
""",
    "p5_found": """
with newest as (
  select pmid, source_file, file_order_key, row_number() over (partition by pmid order by file_order_key desc, source_file desc) as rn
  from article where pmid is not null and file_order_key is not null),
gone as (select pmid, max(file_order_key) as k from deleted_pmid group by pmid)
select n.pmid, n.source_file from newest n left join gone g on n.pmid = g.pmid
where rn = 1 and (g.k is null or g.k < n.file_order_key)
""",
    "p5_committed": f"""{_P5},
shown as (select * from feed where k < coalesce((select k from held order by stream limit 1), 999999999999))
select pmid, arg_max(source_file, (k, gone, source_file)) as source_file, max(k) as file_order_key from shown group by pmid having not arg_max(gone, (k, gone, source_file))""",
    "p5_transactions": f"""{_P5}
select stream, count(*) as n, count(*) filter (where done) as n_complete, least(max(t.k), coalesce(min(held.k) - 1, max(t.k))) as watermark
from t left join held using (stream) group by stream""",
    "p6_found": _P6,
    "p6_report": f"select table_name, period, count(*) as n_orphans from ({_P6}) group by table_name, period",
    "p7_found": "select distinct pmid, source_file, difference from (" + _P7 + ")",
    "p7_cells": _P7,
}
