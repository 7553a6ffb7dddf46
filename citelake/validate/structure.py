"""Structure of an export: each line is parsed once into narrow facts, every count is an aggregate over them, and the few lines that are
shown as examples or sampled are read again."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from types import SimpleNamespace

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import Files
from ..functions.dates import VALID_MONTH
from ..operators.documents import FIELDS
from ..operators.versions import newest
from .report import EXAMPLES

#: Codes whose counts are lines, and those whose counts are of fields.
LINES = ("malformed_json", "null_values", "invalid_ids", "invalid_months")


def find_shards(spark: SparkSession, export_dir: str) -> list[str]:
    """Paths of all ``.ndjson`` and ``.ndjson.gz`` files of the folder, by name."""
    files = Files(spark, export_dir)
    return [files.uri(f"{export_dir}/{name}") for name in files.names(export_dir) if name.endswith((".ndjson", ".ndjson.gz"))]


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def unreadable(spark: SparkSession, shards: list[str]) -> dict[str, str]:
    """Shards that can't be read to their end, by name, with the reason; a task reads each once.

    Spark itself would fail the whole job at a truncated shard, or with ``ignoreCorruptFiles`` drop rows silently.
    """
    if not shards:
        return {}

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            why = []
            for path in batch.column(0).to_pylist():
                try:
                    system, at = fs.FileSystem.from_uri(path)
                    with system.open_input_stream(at, compression="gzip" if path.endswith(".gz") else None) as f:
                        while f.read(1 << 20):
                            pass
                    why.append(None)
                except (OSError, EOFError, ValueError) as e:
                    why.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(why, pa.string())], ["path", "why"])

    paths = spark.createDataFrame([(p,) for p in shards], "path string").repartition(len(shards))
    bad = paths.mapInArrow(probe, "path string, why string").where("why is not null").collect()
    return {_name(r["path"]): r["why"] for r in bad}


def _raw(spark: SparkSession, shards: list[str]) -> DataFrame:
    lines = spark.read.text(shards).select("value", F.col("_metadata.file_name").alias("shard"))
    return lines.where(F.trim("value") != "")


def _members() -> Column:
    """A line's members as text by name, NULL if it is no JSON object; the line's only parse."""
    members = F.from_json("value", "map<string,string>", {"allowSingleQuotes": "false"})
    return F.when(F.rtrim("value").endswith("}"), members)


def _list(text: Column) -> Column:
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def _pmid(members: Column) -> Column:
    return F.regexp_extract(members["id"], r"\APMID:([0-9]+)\z", 1).try_cast("bigint")


def lines(spark: SparkSession, shards: list[str]) -> DataFrame:
    """The facts of each line that isn't blank: shard, valid (a JSON object), missing and extra fields, those that are null, pmid, bad_month, and the
    prefixes of its identifiers."""
    m, names = F.col("m"), F.array(*[F.lit(f) for f in FIELDS])
    keys = F.map_keys(m)
    colon = F.filter(_list(m["identifiers"]), lambda x: F.instr(x, ":") > 0)
    facts = {
        "missing": F.array_except(names, keys), "extra": F.array_except(keys, names), "nulls": F.filter(keys, lambda k: m[k].isNull()), "pmid": _pmid(m),
        "bad_month": ~F.coalesce(m["pub_month"], F.lit("")).rlike(VALID_MONTH), "prefixes": F.array_distinct(F.transform(colon, lambda x: F.substring_index(x, ":", 1))),
    }
    parsed = _raw(spark, shards).select("shard", _members().alias("m"))
    return parsed.select("shard", m.isNotNull().alias("valid"), *[F.when(m.isNotNull(), c).alias(n) for n, c in facts.items()])


def documents(spark: SparkSession, shards: list[str], pmids: DataFrame) -> DataFrame:
    """The documents of some pmids of a shard each (shard, pmid), by a second read."""
    wanted = F.broadcast(pmids.select(F.col("shard").alias("s"), F.col("pmid").alias("p")))
    id_only = F.create_map(F.lit("id"), F.get_json_object("value", "$.id"))  # most lines are of no interest beyond it
    lines = _raw(spark, shards).withColumn("pmid", _pmid(id_only)).join(wanted, (F.col("shard") == F.col("s")) & (F.col("pmid") == F.col("p")))
    doc = [(_list(F.col("m")[f]) if f == "identifiers" else F.col("m")[f]).alias(f) for f in FIELDS]
    return lines.select("pmid", _members().alias("m")).where("m is not null").select("pmid", *doc).dropDuplicates(["pmid"])


def sample_lines(facts: DataFrame, size: int, seed: int) -> DataFrame:
    """``size`` records of each shard, by a hash of seed and id: the same for the same export, whatever the partitioning."""
    ok = facts.where("pmid is not null").select("shard", "pmid").withColumn("h", F.md5(F.concat_ws(":", F.lit(seed), "pmid")))
    return newest(ok, ["shard"], [F.asc("h"), F.asc("pmid")], size).drop("h")


@dataclass
class Structure:
    """What the scan found: counts by code (None if nothing could be read), the section of the report, sampled documents, and all pmids."""

    unreadable: dict[str, str]
    records: int = 0
    counts: dict[str, int] | None = None
    shown: dict = field(default_factory=dict)
    sample: list[dict] = field(default_factory=list)
    pmids: DataFrame | None = None
    facts: DataFrame | None = None


def duplicates(facts: DataFrame) -> DataFrame:
    """(pmid, n) of pmids on several lines."""
    return facts.where("pmid is not null").groupBy("pmid").agg(F.count("*").alias("n")).where("n > 1")


def per_shard(facts: DataFrame) -> DataFrame:
    """(shard, records, and the number of lines of each code of ``LINES``)."""
    bad = {"malformed_json": ~F.col("valid"), "null_values": F.size("nulls") > 0, "invalid_ids": F.col("valid") & F.col("pmid").isNull(), "invalid_months": F.col("bad_month")}
    return facts.groupBy("shard").agg(F.count_if("valid").alias("records"), *[F.count_if(bad[c]).alias(c) for c in LINES])


def named(facts: DataFrame) -> DataFrame:
    """(sort, name, n): records per missing field, extra field and prefix of identifiers."""
    tag = lambda sort, c: F.transform(c, lambda x: F.struct(F.lit(sort).alias("sort"), x.alias("name")))
    every = F.concat(tag("missing", F.col("missing")), tag("extra", F.col("extra")), tag("prefix", F.col("prefixes")))
    return facts.where("valid").select(F.explode(every).alias("x")).groupBy("x.sort", "x.name").agg(F.count("*").alias("n"))


def scan(spark: SparkSession, shards: list[str], sample_size: int, seed: int) -> Structure:
    """All counts and examples; ``facts`` stay persisted for the checks that follow."""
    found = Structure(unreadable(spark, shards), pmids=spark.createDataFrame([], "pmid bigint"))
    good = [p for p in shards if _name(p) not in found.unreadable]
    found.shown = {"unreadable_shard": found.unreadable, "records_total": 0, "records_per_shard": {}, "identifier_prefixes": {}}
    if not good:
        return found
    facts = found.facts = lines(spark, good).persist(StorageLevel.MEMORY_AND_DISK)
    shard_rows = per_shard(facts).collect()
    total = found.records = sum(r["records"] for r in shard_rows)
    by_name: dict[str, dict[str, int]] = {"missing": {}, "extra": {}, "prefix": {}}
    for r in sorted(named(facts).collect(), key=lambda r: (-r["n"], r["name"])):
        by_name[r["sort"]][r["name"]] = r["n"]
    again = duplicates(facts)
    found.counts = {c: sum(r[c] for r in shard_rows) for c in LINES} | {
        "missing_fields": sum(by_name["missing"].values()), "extra_fields": sum(by_name["extra"].values()), "duplicate_pmids": again.count(),
    }

    def some(df: DataFrame, *cols: str) -> list:
        rows = df.select(*cols).orderBy(*cols).limit(EXAMPLES).collect()
        return [r[0] if len(cols) == 1 else r.asDict() for r in rows]

    whole = _raw(spark, good).select("shard", "value", _members().alias("m"))  # read again for examples only
    ask = {
        "malformed_json": lambda: some(whole.where("m is null"), "shard", "value"), "invalid_months": lambda: some(facts.where("bad_month"), "shard", "pmid"),
        "null_values": lambda: some(facts.where("size(nulls) > 0"), "shard", "pmid", "nulls"), "duplicate_pmids": lambda: some(again, "pmid"),
        "invalid_ids": lambda: some(whole.where(F.col("m").isNotNull() & _pmid(F.col("m")).isNull()).select(F.col("m")["id"].alias("id")), "id"),
    }
    found.shown |= {c: f() if found.counts[c] else [] for c, f in ask.items()} | {
        "missing_fields": by_name["missing"], "extra_fields": by_name["extra"], "records_total": total, "records_per_shard": {r["shard"]: r["records"] for r in shard_rows if r["records"]},
        "identifier_prefixes": {k: {"records": n, "pct": round(100 * n / total, 2) if total else 0.0} for k, n in by_name["prefix"].items()},
    }
    chosen = sample_lines(facts, sample_size, seed)
    found.sample = [r.asDict() for r in documents(spark, good, chosen).collect()]
    found.pmids = facts.where("pmid is not null").select("pmid").distinct()
    return found


def structure_facts(shards: list[str], found: Structure) -> SimpleNamespace:
    """The facts the checks of structure ask for."""
    return SimpleNamespace(shards=shards, unreadable=found.unreadable, exported=found.records, counts=found.counts)
