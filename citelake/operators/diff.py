"""Differences between two copies of a keyed table, cell by cell.

Each task first reduces what it reads to a profile per key - per field the lowest and highest value and whether a null occurs - so repeats and
hot keys shrink before the only shuffle.  Both sides are then cogrouped by hash bucket of the key as Arrow tables; profiles of
a key are put together, keys are aligned by sorted search and the fields compared through null-aware masks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys of one side that a bucket is to hold on average.
KEYS_PER_BUCKET = 100_000
#: Rows a task reduces at a time before the shuffle.
CHUNK = 200_000


def _combine(t: pa.Table, n_keys: int, n_fields: int) -> pa.Table:
    """One profile per key of a table of profiles."""
    keys = ["bucket", *(f"k{i}" for i in range(n_keys))]
    aggs = [(f"{c}{i}", f) for i in range(n_fields) for c, f in (("lo", "min"), ("hi", "max"), ("nul", "max"))]
    out = t.group_by(keys).aggregate(aggs)
    return out.rename_columns([*keys, *(c for c, _ in aggs)] if out.column_names[0] == "bucket" else [*(c for c, _ in aggs), *keys])


def _profile(df: DataFrame, keys: Sequence[str], fields: Sequence[str], buckets: int) -> DataFrame:
    """Profiles by key, at least one a key and task: bucket, keys k0.., and of each field lo, hi and nul."""
    ids = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    values = [x for i, f in enumerate(fields) for x in (F.col(f"`{f}`").alias(f"lo{i}"), F.col(f"`{f}`").alias(f"hi{i}"), F.isnull(f"`{f}`").alias(f"nul{i}"))]
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int").alias("bucket")
    rows = df.select(bucket, *ids, *values)
    n_keys, n_fields = len(keys), len(fields)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= CHUNK:
                yield from _combine(pa.Table.from_batches(held), n_keys, n_fields).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from _combine(pa.Table.from_batches(held), n_keys, n_fields).combine_chunks().to_batches()

    return rows.mapInArrow(reduce, rows.schema)


def _ranks(left: pa.ChunkedArray, right: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, int]:
    """Dense codes of two columns over their common sorted values; null is code 0."""
    both = pa.chunked_array(left.chunks + right.chunks, type=left.type)
    values = pc.unique(both.drop_null())
    values = values.take(pc.array_sort_indices(values)) if len(values) else values
    code = pc.fill_null(pc.add(pc.index_in(both, value_set=values), 1), 0).to_numpy().astype(np.int64)
    return code[: len(left)], code[len(left) :], len(values) + 1


def _align(left: pa.Table, right: pa.Table, n_keys: int) -> tuple[np.ndarray, np.ndarray]:
    """For each left row the right row of the same key or -1, and the reverse, by sorted search over key codes."""
    a = np.zeros(left.num_rows, np.int64)
    b = np.zeros(right.num_rows, np.int64)
    for i in range(n_keys):
        x, y, n = _ranks(left[f"k{i}"], right[f"k{i}"])
        # codes stay dense, so the combined code stays below rows x distinct values and can't overflow
        _, dense = np.unique(np.concatenate([a * n + x, b * n + y]), return_inverse=True)
        a, b = dense[: len(a)], dense[len(a) :]

    def search(want: np.ndarray, have: np.ndarray) -> np.ndarray:
        if not len(have):
            return np.full(len(want), -1)
        order = np.argsort(have, kind="stable")
        at = np.minimum(np.searchsorted(have[order], want), len(have) - 1)
        return np.where(have[order][at] == want, order[at], -1)

    return search(a, b), search(b, a)


def _differs(a: pa.Table, b: pa.Table, i: int) -> np.ndarray:
    """Mask of aligned rows whose values of field ``i`` aren't one and the same, null counting as a value."""

    def mask(x) -> np.ndarray:
        return pc.fill_null(x, False).to_numpy(zero_copy_only=False) if isinstance(x, pa.Array) else pc.fill_null(x, False).to_numpy()

    lo_a, hi_a, lo_b, hi_b = a[f"lo{i}"], a[f"hi{i}"], b[f"lo{i}"], b[f"hi{i}"]
    unequal = [mask(pc.not_equal(x, y)) for x, y in ((lo_a, lo_b), (lo_a, hi_a), (lo_b, hi_b))]
    null_a, null_b = mask(pc.is_null(lo_a)), mask(pc.is_null(lo_b))
    mixed = [mask(a[f"nul{i}"]) & ~null_a, mask(b[f"nul{i}"]) & ~null_b]
    return np.logical_or.reduce([*unequal, null_a ^ null_b, *mixed])


def differences(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    left_only: str = "only_in_left",
    right_only: str = "only_in_right",
    keys_per_bucket: int = KEYS_PER_BUCKET,
) -> DataFrame:
    """(keys..., difference, left_value, right_value): one row per key on one side only, and one masked cell per field whose values differ.

    Values are compared exactly as stored; null differs from a value and equals null, in keys too.  Repeats count once; where a
    side holds several values of a field under one key, the field differs unless all values of both sides are the same one, and the cell
    shows the lowest.  Values are given as text, null for null and for a missing row.  Other columns are ignored.  An empty side makes every
    key of the other one-sided; two empty sides give no row.
    """
    rows = max(left.count(), right.count())
    buckets = max(1, -(-rows // keys_per_bucket), left.sparkSession.sparkContext.defaultParallelism)
    a, b = _profile(left, keys, fields, buckets), _profile(right, keys, fields, buckets)
    n, names = len(keys), list(fields)
    types = {f.name: f.dataType for f in left.schema.fields}
    text = ", difference string, left_value string, right_value string"
    schema = ", ".join(f"k{i} {types[k].simpleString()}" for i, k in enumerate(keys)) + text

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        x, y = _combine(x, n, len(names)), _combine(y, n, len(names))
        to_right, to_left = _align(x, y, n)
        hit = np.flatnonzero(to_right >= 0)
        xs, ys = x.take(pa.array(hit)), y.take(pa.array(to_right[hit]))
        out = []

        def emit(table: pa.Table, at: np.ndarray, what: str, cells: tuple | None = None) -> None:
            at = pa.array(at, pa.int64())
            part = table.select([f"k{i}" for i in range(n)]).take(at)
            none = pa.nulls(len(at), pa.string())
            values = [c.take(at).cast(pa.string()) for c in cells] if cells else [none, none]
            for name, column in zip(("difference", "left_value", "right_value"), (pa.array([what] * len(at), pa.string()), *values), strict=True):
                part = part.append_column(name, column)
            out.append(part)

        emit(x, np.flatnonzero(to_right < 0), left_only)
        emit(y, np.flatnonzero(to_left < 0), right_only)
        for i, f in enumerate(names):
            emit(xs, np.flatnonzero(_differs(xs, ys, i)), f, (xs[f"lo{i}"], ys[f"lo{i}"]))
        return pa.concat_tables(out)

    found = a.groupBy("bucket").cogroup(b.groupBy("bucket")).applyInArrow(compare, schema)
    return found.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "difference", "left_value", "right_value")
