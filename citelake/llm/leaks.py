"""Held-out test passages inside corpus texts.

The test items' word n-grams go to every executor as one hash table - in blocks of items of bounded size, one after the other, with a scan of the
corpus each - and every document's word windows are looked up in it.  A window is first looked up by its first
and last word, then the hit is verified against the whole n-gram.  The corpus is never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch

#: Words of items in one block; with their n-grams about 200 bytes each, so a block stays below 100 MB.
BLOCK_WORDS = 500_000

_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Runs of letters and digits, in lower case."""
    if text.isascii():
        return _WORD.findall(text.lower())
    return [w.lower() for w in _WORD.findall(text)]


def blocks(items: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple]]:
    """The items in blocks of at most ``block_words`` words (or one item), as (id, words), one at a time."""
    block, size = [], 0
    for row in items.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("i is not null and t is not null").toLocalIterator():
        w = words(row["t"])
        if block and size + len(w) > block_words:
            yield block
            block, size = [], 0
        block.append((row["i"], w))
        size += len(w)
    if block:
        yield block


def _table(block: list[tuple], n: int) -> dict:
    """(first word, last word) -> {n-gram -> items that hold it}."""
    table: dict = {}
    for item, w in block:
        for i in range(len(w) - n + 1):
            gram = tuple(w[i : i + n])
            held = table.setdefault((gram[0], gram[-1]), {}).setdefault(gram, [])
            if item not in held:
                held.append(item)
    return table


def _spans(text: str, table: dict, n: int) -> dict:
    """item -> merged [first word, word after the last] runs of the document that stand in the item."""
    w = words(text)
    out: dict = {}
    for i, ends in enumerate(zip(w, w[n - 1 :], strict=False)):
        if ends in table and (items := table[ends].get(tuple(w[i : i + n]))):
            for item in items:
                runs = out.setdefault(item, [])
                if runs and runs[-1][1] >= i:
                    runs[-1][1] = i + n
                else:
                    runs.append([i, i + n])
    return out


def leaks(
    docs: DataFrame, items: DataFrame, n: int = 13, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
    item_text: str = "text", block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, item_id, start, end): the spans of each document, as offsets in code points, that hold ``n`` or more consecutive
    words of an item.

    Overlapping and touching runs are merged per item.  Null texts and ids, and texts or items of fewer than ``n`` words, give no row;
    repeated documents or items give their rows again, an item id that comes twice counts once per text.  Without items the
    result is empty.  Items of more than one block are scanned for at once, and a block's table is gone before the next is sent.
    """
    schema = f"doc_id {dict(docs.dtypes)[doc_id]}, item_id {dict(items.dtypes)[item_id]}, start int, end int"
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text")).where("doc_id is not null and text is not null")
    target = _arrow_schema(spark, schema)

    def found(table) -> DataFrame:
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grams = table.value
            for batch in batches:
                rows: list[tuple] = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if len(text) < 2 * n - 1:
                        continue
                    spans = _spans(text, grams, n)
                    if spans:
                        at = [m.span() for m in _WORD.finditer(text)]
                        rows += [(doc, item, at[a][0], at[b - 1][1]) for item, runs in spans.items() for a, b in runs]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["doc_id", "item_id", "start", "end"]).cast(target)

        return source.mapInArrow(scan, schema)

    folder, left = None, blocks(items, item_id, item_text, block_words)
    block = next(left, None)
    while block is not None:
        table = spark.sparkContext.broadcast(_table(block, n))
        block = next(left, None)
        if block is None and folder is None:
            return found(table)
        folder = folder or scratch(spark)
        found(table).write.mode("append").parquet(folder)
        table.destroy()
    return spark.createDataFrame([], schema) if folder is None else spark.read.schema(schema).parquet(folder)


def _arrow_schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def scrub(docs: DataFrame, spans: DataFrame, mode: str = "span", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The corpus without its leaked spans (``mode='span'``) or without the documents that have any (``mode='document'``).

    ``spans`` is what ``leaks`` returns.  A span is replaced by one space.  Documents without a span, null ids and null texts
    stay as they are; all other columns are kept.
    """
    if mode not in ("span", "document"):
        raise ValueError(f"mode must be span or document: {mode}")
    if mode == "document":
        gone = spans.select(F.col("doc_id").alias("__gone")).distinct()
        return docs.join(gone, F.col(doc_id) == F.col("__gone"), "left_anti")
    cuts = spans.groupBy(F.col("doc_id").alias("__doc")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("__cuts"))
    joined = docs.join(cuts, F.col(doc_id) == F.col("__doc"), "left")

    def keep(acc, cut):
        at = F.greatest(acc["at"], cut["start"])
        piece = F.substring(F.col(text), acc["at"] + 1, at - acc["at"])
        more = F.when(cut["end"] > acc["at"], F.concat(acc["out"], piece, F.lit(" "))).otherwise(acc["out"])
        return F.struct(more.alias("out"), F.greatest(acc["at"], cut["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate("__cuts", start, keep, lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    fixed = F.when(F.col("__cuts").isNull(), F.col(text)).otherwise(done)
    return joined.withColumn(text, fixed).drop("__doc", "__cuts")
