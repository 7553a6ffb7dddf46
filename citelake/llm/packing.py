"""Filling containers of a fixed number of tokens.

Sizes are counted with a public tokenizer.  Documents are dealt by hash into shards of bounded size - no key, source or size
decides the shard - and each shard is packed by itself: Martello and Toth's dominance criterion first fixes small sets that are
provably as good as any other choice for one of their documents, then what remains is packed best fit, largest first.
A document above the capacity is cut into full containers and a rest, which is packed like any other.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the byte-level vocabulary splits text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Documents in one shard, on average; with five to a container the last, half-empty ones are below 0.1 per cent.
SHARD = 20_000


def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens) of every row; null and empty texts have 0 tokens, special tokens in a text are ordinary text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(tokenizer)
        for batch in batches:
            sizes = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"])

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(count, f"doc_id {kind}, n_tokens bigint")


def reduce_instance(sizes: list[int], capacity: int) -> tuple[list[list[int]], list[int]]:
    """(fixed, rest): containers, as lists of places in ``sizes``, that some optimal packing has, and the places left over.

    A set of items dominates another if the other's items can be dealt to its items so that none gets more than its own size; then
    an optimal packing may use the first.  For each item j, largest first, with room r beside it and k the largest other item that
    fits there:

    * nothing fits: {j} dominates every set with j;
    * k = r, or no two items fit together: {j, k} does;
    * two items fit together but not three, and no two are larger in sum than k: {j, k} does;
    * so again, and with b the largest item beside k, the smaller of any two that fit together is at most b: {j, k, b} does.

    Otherwise j is left over.  Sizes are positive and at most ``capacity``.
    """
    ids = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
    vals = [sizes[i] for i in ids]
    fixed: list[list[int]] = []
    p = len(vals) - 1
    while p >= 0:
        chosen = _dominating(vals, p, capacity - vals[p])
        if chosen is None:
            p -= 1
            continue
        at = sorted([p, *chosen], reverse=True)
        fixed.append([ids[x] for x in at])
        for x in at:
            del vals[x], ids[x]
        p -= 1 + sum(x < p for x in chosen)
    return fixed, ids


def _dominating(vals: list[int], p: int, room: int) -> list[int] | None:
    """Places of the items beside that at ``p`` in a set that dominates all others with it; None if there is no proof."""

    def at(i: int) -> int:  # the place of the i-th smallest other item
        return i if i < p else i + 1

    def size(i: int) -> int:
        return vals[at(i)]

    def fitting(most: int) -> int:
        n = bisect_right(vals, most)
        return n - (p < n)

    fits = fitting(room)
    if fits == 0:
        return []
    k = fits - 1
    if size(k) == room or fits == 1 or size(0) + size(1) > room:
        return [at(k)]
    if fits >= 3 and size(0) + size(1) + size(2) <= room:
        return None
    lo, up, best = 0, k, 0
    while lo < up and best <= size(k):
        s = size(lo) + size(up)
        if s <= room:
            best, lo = max(best, s), lo + 1
        else:
            up -= 1
    if best <= size(k):
        return [at(k)]
    b = min(fitting(room - size(k)), k) - 1
    lo, up = 0, fits - 2  # the last place whose item fits together with the next one
    while lo < up:
        mid = (lo + up + 1) // 2
        lo, up = (mid, up) if size(mid) + size(mid + 1) <= room else (lo, mid - 1)
    return [at(k), at(b)] if b >= 0 and size(b) >= size(lo) else None


def best_fit(sizes: list[int], places: list[int], capacity: int) -> list[list[int]]:
    """Containers of the items at ``places``: largest first, each into the open container it fills best."""
    bins: list[list[int]] = []
    free: list[tuple[int, int]] = []  # (room, container), sorted
    for i in sorted(places, key=lambda i: (-sizes[i], i)):
        at = bisect_left(free, (sizes[i], -1))
        if at == len(free):
            bins.append([i])
            room, b = capacity, len(bins) - 1
        else:
            room, b = free.pop(at)
            bins[b].append(i)
        if room > sizes[i]:
            insort(free, (room - sizes[i], b))
    return bins


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    fixed, rest = reduce_instance(sizes, capacity)
    return fixed + best_fit(sizes, rest, capacity)


def containers(sized: DataFrame, capacity: int = 2048, doc_id: str = "doc_id", size: str = "n_tokens", shard: int = SHARD) -> DataFrame:
    """(container, doc_id, part, n_tokens): the pieces of every document and the container each is in.

    ``part`` is 0 for a whole document; a document above the capacity has parts of exactly the capacity and one rest.  A
    container never holds more than ``capacity`` tokens.  Rows with a null id or null, zero or negative size are left out; repeated rows are
    items of their own.  Container names are ``shard-number`` and the same for the same rows in whatever order they come.
    """
    if capacity < 1:
        raise ValueError(f"capacity must be positive: {capacity}")
    kind = dict(sized.dtypes)[doc_id]
    items = cut(sized.select(F.col(doc_id).alias("doc_id"), F.col(size).cast("bigint").alias("n_tokens")).where("doc_id is not null and n_tokens > 0"))
    shards = max(1, -(-items.count() // shard))  # of the written sizes, so tokens are counted once
    # equal rows count first and then get numbers, so a row that repeats without end spreads over all shards
    copies = items.groupBy("doc_id", "n_tokens").agg(F.count("*").alias("n"))
    copies = copies.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("copy"))
    # full containers of long documents need no packing
    full_parts = F.when(F.col("n_tokens") > capacity, F.floor(F.col("n_tokens") / capacity)).otherwise(F.lit(0))
    cut_up = copies.withColumns({"full": full_parts, "salt": F.pmod(F.xxhash64("doc_id", "n_tokens", "copy"), F.lit(shards))})
    full = cut_up.where("full > 0").select("doc_id", "copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("full"))).alias("part"))
    name = F.concat_ws("-", F.lit("full"), "doc_id", F.nullif("copy", F.lit(0)), "part").alias("container")
    full = full.select(name, "doc_id", "part", F.lit(capacity).cast("bigint").alias("n_tokens"))
    rest = cut_up.select(
        F.col("salt").cast("bigint").alias("shard"), "doc_id", F.when(F.col("full") > 0, F.col("full") + 1).otherwise(F.lit(0)).cast("bigint").alias("part"),
        (F.col("n_tokens") - F.col("full") * capacity).alias("n_tokens"),
    ).where("n_tokens > 0")

    def fill(t: pa.Table) -> pa.Table:
        t = t.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("part", "ascending")])
        name = t.column("shard")[0].as_py()
        label = [""] * t.num_rows
        for b, places in enumerate(pack(t.column("n_tokens").to_pylist(), capacity)):
            for i in places:
                label[i] = f"{name}-{b}"
        return pa.table([pa.array(label), *(t.column(c) for c in ("doc_id", "part", "n_tokens"))], names=["container", "doc_id", "part", "n_tokens"])

    packed = rest.groupBy("shard").applyInArrow(fill, f"container string, doc_id {kind}, part bigint, n_tokens bigint")
    return packed.unionByName(full)
