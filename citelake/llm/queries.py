"""Queries of the text and name problems (names pN_...)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table
from . import leaks, names, packing, spans, unify


def _spellings(spark: SparkSession, sf: str) -> DataFrame:
    authors = read_table(spark, sf, "author").where("kind = 'author'").select(F.lit("name").alias("field"), F.col("name").alias("value"))
    places = read_table(spark, sf, "author_affiliation").select(F.lit("affiliation").alias("field"), F.col("affiliation").alias("value"))
    return authors.unionByName(places)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of spellings of one person, and of one department of one institution."""
    return names.pairs(names.entities(_spellings(spark, sf)))


def p1_entities(spark: SparkSession, sf: str) -> DataFrame:
    """The same as classes: each spelling that has another with its entity's lowest spelling and their number."""
    return names.entities(_spellings(spark, sf))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Values of the three fields that aren't in their consistent form."""
    out = []
    for table, field in (("article", "medline_date"), ("article", "article_title"), ("abstract_text", "text")):
        seq = F.col("seq").cast("int") if table == "abstract_text" else F.lit(-1)
        df = read_table(spark, sf, table).select("pmid", "source_file", seq.alias("seq"), F.col(field).alias("value"))
        odd = unify.not_plain(df, "value")
        out.append(odd.select(F.lit(table).alias("table_name"), F.lit(field).alias("field"), "pmid", "source_file", "seq"))
    return reduce(DataFrame.unionByName, out).distinct()


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    """Every document, or part of a long one, with its container of 2,048 tokens."""
    return packing.containers(packing.count_tokens(read_table(spark, sf, "documents")))


def p8_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts and size of each document packed into containers of 4,000 characters, and how many of its containers hold more than that."""
    sizes = read_table(spark, sf, "documents").select("doc_id", F.length("text").cast("bigint").alias("n_tokens"))
    pieces = packing.containers(sizes, 4000)
    filled = pieces.groupBy("container").agg(F.sum("n_tokens").alias("filled")).where("filled > 4000").select("container", F.lit(1).alias("over"))
    per = pieces.join(filled, "container", "left").groupBy("doc_id")
    return per.agg(F.count("*").alias("n_parts"), F.sum("n_tokens").alias("size"), F.count("over").alias("n_overfull"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold 13 or more consecutive words of an evaluation item."""
    found = leaks.leaks(read_table(spark, sf, "documents"), read_table(spark, sf, "eval_item"))
    return found.select("doc_id", "item_id").distinct()


def p9_scrubbed(spark: SparkSession, sf: str) -> DataFrame:
    """Characters of each leaked document before and after its spans are removed."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    found = leaks.leaks(docs, read_table(spark, sf, "eval_item"))
    clean = leaks.scrub(docs, found).select("doc_id", F.length("text").cast("bigint").alias("n_after"))
    before = docs.select("doc_id", F.length("text").cast("bigint").alias("n_before"))
    return before.join(clean, "doc_id").where("n_before <> n_after")


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of documents with a common substring of 300 characters or more."""
    return spans.pairs(read_table(spark, sf, "documents"))


def p10_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """How much of each document is shared with others."""
    return spans.coverage(read_table(spark, sf, "documents"))


def p10_links(spark: SparkSession, sf: str) -> DataFrame:
    """Each document with its class of exact copies and the number of other texts it shares a span with."""
    return spans.links(read_table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_entities, p3_found, p8_containers, p8_parts, p9_found, p9_scrubbed, p10_found, p10_coverage, p10_links)}

# Code points of Greek and Cyrillic letters drawn as Latin ones, by themselves and not from the operator's table.
_ALIKE = (
    r"\x{391}\x{392}\x{395}-\x{397}\x{399}\x{39A}\x{39C}\x{39D}\x{39F}\x{3A1}\x{3A4}\x{3A5}\x{3A7}\x{3BD}\x{3BF}\x{3F2}\x{3F3}"
    r"\x{405}\x{406}\x{408}\x{410}\x{412}\x{415}\x{41A}\x{41C}-\x{41E}\x{420}-\x{423}\x{425}\x{430}\x{435}\x{43E}\x{440}\x{441}\x{443}\x{445}"
    r"\x{455}\x{456}\x{458}\x{4BB}\x{501}\x{51B}\x{51D}"
)
#: Spaces, invisible characters, hyphens, full-width and ligature forms, the micro sign; a look-alike next to a Latin letter or digit in its word.
_ODD = (
    r"[\x{A0}\x{AD}\x{B5}\x{1680}\x{2000}-\x{200F}\x{2010}\x{2011}\x{2028}-\x{202F}\x{205F}-\x{2064}\x{2212}\x{3000}\x{FB00}-\x{FB06}\x{FE00}-\x{FE0F}\x{FEFF}\x{FF01}-\x{FF5E}]"
    r"|\p{Latin}[0-9]*[" + _ALIKE + r"]|[" + _ALIKE + r"][0-9]*\p{Latin}"
)


def _not_plain(c: str) -> str:
    return f"{c} is not null and (regexp_matches({c}, '{_ODD}') or nfc_normalize({c}) <> {c})"


#: Word windows of documents (dg) and of items (ig).
_P9 = r"""d as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from documents where text is not null),
     i as (select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from eval_item where text is not null),
     dg as (select doc_id, k, array_to_string(w[k : k + 12], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 11)) as k from d)),
     ig as (select item_id, array_to_string(w[k : k + 12], ' ') as g from (select item_id, w, unnest(range(1, len(w) - 11)) as k from i))"""

ORACLE: dict[str, str] = {
    "p3_found": "\nunion\n".join(
        f"select '{t}' as table_name, '{c}' as field, pmid, source_file, cast({seq} as integer) as seq from {t} where " + _not_plain(c)
        for t, c, seq in (("article", "medline_date", "-1"), ("article", "article_title", "-1"), ("abstract_text", "text", "seq"))
    ),
    "p8_parts": """
select doc_id, cast(ceil(length(text) / 4000) as bigint) as n_parts, length(text) as size, cast(0 as bigint) as n_overfull from documents where length(text) > 0""",
    "p9_found": f"with {_P9} select distinct doc_id, item_id from dg join ig using (g)",
    "p9_scrubbed": rf"""with {_P9},
hit as (select distinct doc_id, item_id, k from dg join ig using (g)),
run as (select *, sum(case when before is null or k > before + 13 then 1 else 0 end) over (partition by doc_id, item_id order by k) as r from (select *, lag(k) over (partition by doc_id, item_id order by k) as before from hit)),
span as (select distinct doc_id, min(k) as first_word, max(k) + 12 as last_word from run group by doc_id, item_id, r),
word as (
  select doc_id, i, length(w) as n, length(s) as gap from (
    select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as w, unnest(s[1 : len(w)]) as s from (
      select doc_id, regexp_extract_all(text, '[\p{{L}}\p{{N}}]+') as w, regexp_split_to_array(text, '[\p{{L}}\p{{N}}]+') as s from documents where doc_id in (select doc_id from span)))),
place as (select doc_id, i, sum(gap + n) over (partition by doc_id order by i) as ends, n from word),
cut as (select s.doc_id, a.ends - a.n as starts, b.ends as upto from span s join place a on s.doc_id = a.doc_id and s.first_word = a.i join place b on s.doc_id = b.doc_id and s.last_word = b.i),
step as (select *, coalesce(max(upto) over (partition by doc_id order by starts, upto rows between unbounded preceding and 1 preceding), 0) as reach from (select distinct * from cut)),
less as (select doc_id, sum(upto - greatest(starts, reach)) - count(*) as n from step where upto > reach group by doc_id)
select d.doc_id, length(d.text) as n_before, cast(length(d.text) - l.n as bigint) as n_after from documents d join less l on d.doc_id = l.doc_id where l.n <> 0""",
    "p10_found": """
with w as (select doc_id, text, unnest(range(1, length(text) - 298)) as k from documents where length(text) >= 300),
     h as (select distinct doc_id, md5(substring(text, k, 300)) as g from w),
     s as (select g from h group by g having count(*) > 1)
select distinct a.doc_id as doc_a, b.doc_id as doc_b from h a join s using (g) join h b on a.g = b.g and a.doc_id < b.doc_id""",
    "p10_links": """
with t as (select min(doc_id) as class_id, any_value(text) as text, md5(text) as digest from documents where length(text) >= 300 group by md5(text)),
     w as (select class_id, text, unnest(range(1, length(text) - 298)) as k from t),
     h as (select distinct class_id, md5(substring(text, k, 300)) as g from w),
     s as (select g from h group by g having count(*) > 1),
     l as (select class_id, count(distinct o) as n from (select a.class_id, b.class_id as o from h a join s using (g) join h b on a.g = b.g and a.class_id <> b.class_id) group by class_id)
select d.doc_id, t.class_id, coalesce(l.n, 0) as n_links from documents d join t on md5(d.text) = t.digest left join l on l.class_id = t.class_id where length(d.text) >= 300""",
    "p10_coverage": """
with w as (select doc_id, text, unnest(range(1, length(text) - 298)) as k from documents where length(text) >= 300),
     h as (select doc_id, k, md5(substring(text, k, 300)) as g from w),
     s as (select g from h group by g having count(distinct doc_id) > 1),
     p as (select doc_id, k, lag(k) over (partition by doc_id order by k) as before from h join s using (g)),
     c as (select doc_id, sum(case when before is null or k - before > 300 then 300 else k - before end) as n, count(*) filter (where before is null or k - before > 300) as spans from p group by doc_id)
select d.doc_id, length(text) as n_chars, cast(coalesce(c.n, 0) as bigint) as shared_chars, coalesce(c.spans, 0) as n_spans
from documents d left join c on d.doc_id = c.doc_id where length(text) >= 300""",
}
