"""Spans of at least ``min_len`` characters that stand word for word in more than one record.

Windows are hashed only where a position modulo a period lies in a difference cover, so that any two places that share
``min_len`` characters share an aligned anchor within one period of their start.  Anchors travel as packed
arrays to the partition of their hash, where equal ones meet; each candidate is extended and checked on the texts.

Places of an anchor that many places share (a standing phrase) aren't paired: the windows of full length around
them are hashed, so that only places with a real match meet and a phrase shorter than ``min_len`` meets nothing.  A task that
finds such an anchor sends a few of its places to meet and the others on their own way, so none gathers in one task.
Exact copies are put together first and only one of each class is searched.  Texts are scanned three times: for digests, for anchors, and for
those that hold a candidate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, scratch

#: Places that may share an anchor and still be paired on it; larger groups meet again by full windows.
PAIRED = 32
#: Anchors that meet in one task's group, on average (about 200 bytes each while they are compared).
PER_PART = 250_000
#: Anchors a task gathers before it packs them, so that packed rows stay long however many groups there are.
PACK = 1_000_000
#: Characters hashed at once.
CHUNK = 1_000_000
#: Up to so many ids or places (about 40 bytes each) go to every executor; beyond it the texts are shuffled to them.
BROADCAST_ROWS = 1_000_000
#: Ids in one block of a group's pairs.
SIDE = 1_000

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def singer_cover(q: int) -> tuple[int, list[int]]:
    """(v, D): for a prime q a set of q + 1 residues whose differences give every residue modulo v = q*q + q + 1.

    The powers of a primitive element of GF(q^3) that lie in a plane, by Singer's theorem.
    """
    v, order = q * q + q + 1, q**3 - 1
    for code in range(q**3):
        a, b, c = code % q, code // q % q, code // q**2  # x^3 = a + b x + c x^2
        x, at, plane = (1, 0, 0), 0, []
        while True:
            if x[2] == 0 and at < v:
                plane.append(at)
            x0, x1, x2 = x
            x, at = ((a * x2) % q, (x0 + b * x2) % q, (x1 + c * x2) % q), at + 1
            if x == (1, 0, 0) or at > order:
                break
        if at == order and len({(i - j) % v for i in plane for j in plane}) == v:
            return v, plane
    raise ValueError(f"not a prime: {q}")


def cover_for(min_len: int) -> tuple[int, list[int], int]:
    """(period, residues, window) for matches of ``min_len`` characters; the window is at least a third of it."""
    primes = [q for q in range(2, 200) if all(q % p for p in range(2, q)) and q * q + q + 1 <= 0.65 * min_len]
    if not primes:
        raise ValueError(f"min_len must be at least 11: {min_len}")
    period, residues = singer_cover(primes[-1])
    return period, residues, min_len - period + 1


class Roller:
    """Hashes of all windows of one length over an array of code points, modulo 2**64."""

    def __init__(self, base: int) -> None:
        self.base, self.powers, self.inverse = base | 1, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            with np.errstate(over="ignore"):
                one = np.concatenate([[np.uint64(1)], np.full(n - 1, self.base, np.uint64)])
                back = np.concatenate([[np.uint64(1)], np.full(n - 1, pow(self.base, -1, 1 << 64), np.uint64)])
                self.powers, self.inverse = np.multiply.accumulate(one), np.multiply.accumulate(back)

    def __call__(self, codes: np.ndarray, width: int) -> np.ndarray:
        n = len(codes)
        if n < width:
            return np.empty(0, np.uint64)
        self._grow(n)
        with np.errstate(over="ignore"):
            x = (codes.astype(np.uint64) + np.uint64(self.base & 0xFFFF)) * np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(x * self.powers[:n], dtype=np.uint64)])
            h = (sums[width:] - sums[:-width]) * self.inverse[: n - width + 1]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            return h ^ (h >> np.uint64(32))


def _pieces(ids: list, texts: list, overlap: int, chunk: int) -> Iterator[list[tuple]]:
    """Groups of (id, offset, text piece) of about ``chunk`` characters; a longer text comes in overlapping pieces."""
    group, size = [], 0
    for i, t in zip(ids, texts, strict=True):
        for at in range(0, max(1, len(t) - overlap + 1), chunk):
            piece = t[at : at + chunk + overlap - 1]
            if group and size + len(piece) > chunk:
                yield group
                group, size = [], 0
            group.append((i, at, piece))
            size += len(piece)
    if group:
        yield group


def _windows(group: list[tuple], width: int, roller: Roller):
    """(hash, index into the group, position in the text) of every window of the pieces, as arrays."""
    lens = np.array([len(p) for _, _, p in group])
    codes = np.frombuffer("".join(p for _, _, p in group).encode("utf-32-le", "surrogatepass"), np.uint32)
    h = roller(codes, width)
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
    which = np.repeat(np.arange(len(group)), lens)[: len(h)]
    inside = np.arange(len(h)) - starts[which]
    fits = inside + width <= lens[which]
    offsets = np.array([o for _, o, _ in group])
    return h, which, inside + offsets[which], fits, codes


_PACKED = "part int, crowd boolean, ids binary, which binary, pos binary, hash binary, check binary"


def _rows(part: np.ndarray, crowd: bool, doc, pos, h, check) -> Iterator[tuple]:
    """One row per target partition with its anchors (document, position, hash, second hash or none) as packed arrays."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for at in np.split(order, cuts) if len(order) else []:
        docs, local = np.unique(doc[at], return_inverse=True)
        arrays = (docs, local.astype(np.uint32), pos[at].astype(np.uint32), h[at], check[at] if len(check) else check)
        yield (int(part[at[0]]), crowd, *(x.tobytes() for x in arrays))


def _pack(parts: int, gathered: list[tuple], most: int) -> pa.RecordBatch:
    """The anchors packed by partition.  Of a hash with more than ``most`` places here only so many and the last go to meet, of two documents
    if it stands in several, so that they are a crowd there too; the others go where the number of their document says."""
    doc, pos, h, check = (np.concatenate(x) for x in zip(*gathered, strict=True)) if gathered else (np.empty(0, np.int64),) * 4
    rows: list[tuple] = []
    if len(h):
        over = np.zeros(len(h), bool)
        ranked = np.sort(h)
        heavy = np.unique(ranked[most:][ranked[most:] == ranked[: len(h) - most]]) if most < len(h) else ranked[:0]
        if len(heavy):
            many = np.flatnonzero(np.isin(h, heavy))
            order = many[np.lexsort((doc[many], h[many]))]
            new = h[order][1:] != h[order][:-1]
            first = np.flatnonzero(np.concatenate([[True], new]))
            rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
            over[order[(rank >= most) & np.concatenate([~new, [False]])]] = True
        keep, second = ~over, check if len(check) else None
        rows += _rows((h[keep] % np.uint64(parts)).astype(np.int32), False, doc[keep], pos[keep], h[keep], check[keep] if second is not None else check)
        rows += _rows((doc[over] % parts).astype(np.int32), True, doc[over], pos[over], h[over], check[over] if second is not None else check)
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
    names = ("part", "crowd", "ids", "which", "pos", "hash", "check")
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], list(names))


def _packed(parts: int, found: Iterator[tuple], most: int, pack: int) -> Iterator[pa.RecordBatch]:
    """Packs of at least ``pack`` anchors, and what is left."""
    gathered, n = [], 0
    for f in found:
        gathered.append(f)
        n += len(f[0])
        if n >= pack:
            yield _pack(parts, gathered, most)
            gathered, n = [], 0
    yield _pack(parts, gathered, most)


def _unpack(t: pa.Table):
    docs, pos, h, check = ([np.empty(0, k)] for k in (np.int64, np.int64, np.uint64, np.uint64))
    for ids, which, p, x, c in zip(*(t[k].to_pylist() for k in ("ids", "which", "pos", "hash", "check")), strict=True):
        docs.append(np.frombuffer(ids, np.int64)[np.frombuffer(which, np.uint32)])
        pos.append(np.frombuffer(p, np.uint32).astype(np.int64))
        h.append(np.frombuffer(x, np.uint64))
        check.append(np.frombuffer(c, np.uint64))
    return np.concatenate(docs), np.concatenate(pos), np.concatenate(h), np.concatenate(check)


def _anchors(docs: DataFrame, min_len: int, parts: int, paired: int, pack: int, chunk: int) -> DataFrame:
    period, residues, width = cover_for(min_len)
    none = np.empty(0, np.uint64)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        roller, cover = Roller(_BASES[0]), np.zeros(period, bool)
        cover[residues] = True
        for batch in batches:
            for group in _pieces(batch.column(0).to_pylist(), batch.column(1).to_pylist(), width, chunk):
                h, which, pos, fits, _ = _windows(group, width, roller)
                at = np.flatnonzero(fits & cover[pos % period])
                yield np.array([i for i, _, _ in group], np.int64)[which[at]], pos[at], h[at], none

    return docs.select("id", "text").mapInArrow(lambda batches: _packed(parts, found(batches), paired, pack), _PACKED)


_MET = "hot boolean, a bigint, pos_a bigint, b bigint, pos_b bigint"


def _meet(anchors: DataFrame, min_len: int, parts: int, paired: int) -> DataFrame:
    """Candidates (a, pos_a, b, pos_b), one per diagonal and window's length; hot rows: the places (a, pos_a) of
    anchors that too many share."""
    width = cover_for(min_len)[2]

    def meet(t: pa.Table) -> pa.Table:
        known, apart, _, _ = _unpack(t.filter(t["crowd"]))
        doc, pos, h, _ = _unpack(t.filter(pc.invert(t["crowd"])))
        order = np.lexsort((pos, doc, h))
        doc, pos, h = doc[order], pos[order], h[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])[: len(h)])
        size = np.diff(np.append(first, len(h)))
        several = doc[first] != doc[first + size - 1]  # sorted by doc: the first and last differ
        many = several & (size > paired)
        crowd = np.repeat(many, size)
        hot_doc, hot_pos = np.append(doc[crowd], known), np.append(pos[crowd], apart)
        keep = np.repeat(several & (size <= paired), size)
        doc, pos, h = doc[keep], pos[keep], h[keep]
        found = []
        for k in range(1, paired):
            if len(h) <= k:
                break
            at = np.flatnonzero((h[k:] == h[:-k]) & (doc[k:] != doc[:-k]))
            if not len(at) and not (h[k:] == h[:-k]).any():
                break
            found.append(np.stack([doc[at], pos[at], doc[at + k], pos[at + k]]))
        a, pa_, b, pb = np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)
        # places within one window's length on one diagonal belong to one match
        key = np.stack([a, b, pa_ - pb, pa_ // width, pa_])
        order = np.lexsort(key[::-1])
        key = key[:, order]
        new = np.concatenate([[True], (key[:4, 1:] != key[:4, :-1]).any(axis=0)])[: key.shape[1]]
        pick = order[new]
        n, m = len(pick), len(hot_doc)
        more = [pa.array(hot_doc), pa.array(hot_pos), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())]
        cols = [pa.chunked_array([pa.array(x[pick]), y]) for x, y in zip((a, pa_, b, pb), more, strict=True)]
        return pa.table([pa.array(np.arange(n + m) >= n), *cols], names=["hot", "a", "pos_a", "b", "pos_b"])

    return anchors.repartition(parts, "part").groupBy("part").applyInArrow(meet, _MET)


def _full_windows(docs: DataFrame, min_len: int, parts: int, chunk: int) -> DataFrame:
    """Windows of full length that start within a period before one of the places ``at`` of a text."""
    period = cover_for(min_len)[0]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        rollers = [Roller(b) for b in _BASES]
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            at = [np.array(x, np.int64) for x in batch.column(2).to_pylist()]
            for group in _pieces(list(range(len(texts))), texts, min_len, chunk):
                full, which, pos, fits, codes = _windows(group, min_len, rollers[0])
                edge, base = np.zeros(len(codes) + 1, np.int64), 0
                for k, offset, piece in group:
                    lo = np.maximum(at[k] - offset - period + 1, 0)
                    hi = np.minimum(at[k] - offset + 1, len(piece))
                    here = hi > lo
                    np.add.at(edge, base + lo[here], 1)
                    np.add.at(edge, base + hi[here], -1)
                    base += len(piece)
                near = np.flatnonzero((np.cumsum(edge)[: len(full)] > 0) & fits)
                own = ids[np.array([k for k, _, _ in group], np.int64)]
                yield own[which[near]], pos[near], full[near], rollers[1](codes, min_len)[near]

    return docs.select("id", "text", "at").mapInArrow(lambda batches: _packed(parts, found(batches), 1 << 62, PACK), _PACKED)


_GROUPS = "sig binary, side int, members array<bigint>, doc bigint, pos bigint"


def _meet_full(windows: DataFrame, parts: int) -> DataFrame:
    """Groups of documents that share a full window, as sides of up to ``SIDE`` members, and the places (doc, pos) of such windows."""

    def meet(t: pa.Table) -> pa.Table:
        import hashlib

        doc, pos, h, check = _unpack(t)
        order = np.lexsort((doc, check, h))
        doc, pos, h, check = doc[order], pos[order], h[order], check[order]
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (check[1:] != check[:-1])])[: len(h)])
        ends = np.append(first[1:], len(h))
        several = doc[first] != doc[ends - 1]
        seen, rows, places = set(), [], []
        for s, e in zip(first[several], ends[several], strict=True):
            ids = np.unique(doc[s:e])
            places.append(np.arange(s, e))
            sig = hashlib.md5(ids.tobytes()).digest()
            if sig not in seen:
                seen.add(sig)
                rows += [(sig, k // SIDE, ids[k : k + SIDE].tolist()) for k in range(0, len(ids), SIDE)]
        at = np.concatenate(places) if places else np.empty(0, np.int64)
        n, m = len(rows), len(at)
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
        kinds = [pa.binary(), pa.int32(), pa.list_(pa.int64())]
        out = [pa.chunked_array([pa.array(c, k), pa.nulls(m, k)]) for c, k in zip(cols, kinds, strict=True)]
        out += [pa.chunked_array([pa.nulls(n, pa.int64()), pa.array(x[at])]) for x in (doc, pos)]
        return pa.table(out, names=["sig", "side", "members", "doc", "pos"])

    return windows.repartition(parts, "part").groupBy("part").applyInArrow(meet, _GROUPS)


def _extend(a: pa.Array, b: pa.Array, at_a: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far two texts agree to the left and right of given places."""
    left, right = [], []
    for x, y, i, j in zip(a.to_pylist(), b.to_pylist(), at_a.tolist(), at_b.tolist(), strict=True):
        n = min(i, j)
        u, w = x[i - n : i][::-1], y[j - n : j][::-1]
        left.append(_common(u, w))
        right.append(_common(x[i:], y[j:]))
    return np.array(left, np.int64), np.array(right, np.int64)


def _common(u: str, w: str) -> int:
    """Length of the common prefix, by bisection."""
    lo, hi = 0, min(len(u), len(w))
    if u[:hi] == w[:hi]:
        return hi
    while lo < hi - 1:
        mid = (lo + hi) // 2
        if u[lo:mid] == w[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def _verified(cands: DataFrame, docs: DataFrame, min_len: int) -> DataFrame:
    """(a, b, start_a, start_b, n): candidates whose agreement around the anchor has ``min_len`` characters or more.

    Only the surroundings of an anchor are looked at: enough to hold every match of ``min_len`` through it and to reach the next anchor
    of a longer one, so the intervals of a match's anchors add up to the whole match.
    """
    period, _, width = cover_for(min_len)
    before, after = min_len, min_len + width
    points = cands.select(F.col("a").alias("id"), F.col("pos_a").alias("pos")).unionByName(
        cands.select(F.col("b").alias("id"), F.col("pos_b").alias("pos"))
    ).distinct()
    wanted = points.groupBy("id").agg(F.collect_set("pos").alias("at"))
    texts = docs.join(wanted, "id").select("id", F.explode("at").alias("pos"), "text")
    start = F.greatest(F.col("pos") - before, F.lit(0))
    seg = texts.select("id", "pos", F.expr(f"substring(text, int(greatest(pos - {before}, 0)) + 1, int(pos - greatest(pos - {before}, 0)) + {after})").alias("seg"), (F.col("pos") - start).alias("at"))
    left = seg.select(F.col("id").alias("a"), F.col("pos").alias("pos_a"), F.col("seg").alias("seg_a"), F.col("at").alias("at_a"))
    right = seg.select(F.col("id").alias("b"), F.col("pos").alias("pos_b"), F.col("seg").alias("seg_b"), F.col("at").alias("at_b"))
    both = cands.join(left, ["a", "pos_a"]).join(right, ["b", "pos_b"])
    cols = ["a", "pos_a", "b", "pos_b", "seg_a", "seg_b", "at_a", "at_b"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            num = {k: t.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in cols if not k.startswith("seg")}
            lo, hi = _extend(t.column("seg_a"), t.column("seg_b"), num["at_a"], num["at_b"])
            ok = lo + hi >= min_len
            out = [num["a"], num["b"], num["pos_a"] - lo, num["pos_b"] - lo, lo + hi]
            yield pa.RecordBatch.from_arrays([pa.array(x[ok]) for x in out], ["a", "b", "start_a", "start_b", "n"])

    return both.select(*cols).mapInArrow(check, "a bigint, b bigint, start_a bigint, start_b bigint, n bigint")


def small(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if its bound of rows is within ``BROADCAST_ROWS``."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _digests(docs: DataFrame) -> DataFrame:
    """(id, digest, n_chars, single): of each id a text's digest, its longest text's length and whether it has but one text."""
    d = docs.select("id", F.unhex(F.md5("text")).alias("digest"), F.length("text").cast("bigint").alias("n"))
    one = d.groupBy("id").agg(F.min("digest").alias("digest"), F.max("digest").alias("other"), F.max("n").alias("n_chars"))
    return one.select("id", "digest", "n_chars", (F.col("digest") == F.col("other")).alias("single"))


def _classes(digests: DataFrame) -> DataFrame:
    """(id, rep): ids of one text that have an exact copy, with the lowest id of the copies.  An id with several texts is never of a class: it
    is searched with all of them and meets the class like any other."""
    d = digests.where("single").select("id", "digest")
    reps = d.groupBy("digest").agg(F.min("id").alias("rep"), F.max("id").alias("top")).where("top > rep")
    return d.join(reps.select("digest", "rep"), "digest").select("id", "rep")


def shared(
    docs: DataFrame, min_len: int = 300, doc_id: str = "doc_id", text: str = "text", paired: int = PAIRED, pack: int = PACK, chunk: int = CHUNK
) -> dict[str, DataFrame]:
    """``matches`` (a, b, start_a, start_b, n) between class representatives, ``groups`` (a, b) and ``places`` (doc, pos) from hot anchors,
    ``copies`` (id, rep), and ``sizes`` (id, n_chars).

    Null ids and texts shorter than ``min_len`` have no matches.  Repeated rows count once; different texts under one id count as
    parts of one record.  Texts are compared as stored, by code point.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    base = base.where(F.col("id").isNotNull() & (F.length("text") >= min_len))
    digests = cut(_digests(base))
    copies = cut(_classes(digests))
    extra = copies.where("id <> rep").select("id")
    searched = base.join(small(extra, copies.count()), "id", "left_anti")
    chars = digests.agg(F.sum("n_chars")).first()[0] or 0
    period, residues, _ = cover_for(min_len)
    parts = max(2 * spark.sparkContext.defaultParallelism, 1 + int(chars * len(residues) / period / PER_PART))
    met = cut(_meet(_anchors(searched, min_len, parts, paired, pack, chunk), min_len, parts, paired))
    width = cover_for(min_len)[2]
    diagonal, bucket = F.col("pos_a") - F.col("pos_b"), F.floor(F.col("pos_a") / width)
    cands = met.where("not hot").groupBy("a", "b", diagonal.alias("diagonal"), bucket.alias("bucket")).agg(F.min("pos_a").alias("pos_a"))
    cands = cut(cands.select("a", "b", "pos_a", (F.col("pos_a") - F.col("diagonal")).alias("pos_b")))
    places = cut(met.where("hot").groupBy(F.col("a").alias("id")).agg(F.collect_set("pos_a").alias("at")))
    # the texts that are looked at again, read from the corpus once
    ids = places.select("id").unionByName(cands.select(F.col("a").alias("id"))).unionByName(cands.select(F.col("b").alias("id"))).distinct()
    folder = scratch(spark)
    searched.join(small(ids, places.count() + 2 * cands.count()), "id", "left_semi").write.mode("overwrite").parquet(folder)
    texts = spark.read.schema(searched.schema).parquet(folder)
    groups = cut(_meet_full(_full_windows(texts.join(places, "id"), min_len, parts, chunk), parts))
    sides = groups.where("sig is not null").groupBy("sig", "side").agg(F.first("members").alias("members"))
    left = sides.select("sig", F.col("side").alias("i"), F.explode("members").alias("a"))
    pairs = left.join(sides, "sig").where("side >= i").select("a", F.explode("members").alias("b")).where("a < b").distinct()
    return {
        "matches": _verified(cands, texts, min_len), "groups": pairs, "places": groups.where("doc is not null").select("doc", "pos").distinct(),
        "copies": copies, "sizes": digests.select("id", "n_chars"),
    }


def pairs(docs: DataFrame, min_len: int = 300, **columns) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: every two documents with a common substring of ``min_len`` characters or more."""
    s = shared(docs, min_len, **columns)
    reps = s["matches"].select("a", "b").unionByName(s["groups"]).distinct()
    copies = s["copies"]
    for side in ("a", "b"):
        of = copies.select(F.col("rep").alias(side), F.col("id").alias(f"{side}_copy"))
        reps = reps.join(of, side, "left").withColumn(side, F.coalesce(f"{side}_copy", side)).drop(f"{side}_copy")
    twins = copies.alias("x").join(copies.alias("y"), (F.col("x.rep") == F.col("y.rep")) & (F.col("x.id") < F.col("y.id")))
    both = reps.where("a <> b").unionByName(twins.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))
    return both.select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b")).distinct()


def coverage(docs: DataFrame, min_len: int = 300, **columns) -> DataFrame:
    """(doc_id, n_chars, shared_chars, n_spans): how much of each document stands in another, in matches of ``min_len`` or more.

    Documents without any shared span have 0; documents shorter than ``min_len`` aren't listed.
    """
    s = shared(docs, min_len, **columns)
    m = s["matches"]
    spans = m.select(F.col("a").alias("doc"), F.col("start_a").alias("s"), (F.col("start_a") + F.col("n")).alias("e")).unionByName(
        m.select(F.col("b").alias("doc"), F.col("start_b").alias("s"), (F.col("start_b") + F.col("n")).alias("e"))
    ).unionByName(s["places"].select("doc", F.col("pos").alias("s"), (F.col("pos") + min_len).alias("e"))).distinct()
    w = Window.partitionBy("doc").orderBy("s", "e")
    reach = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    step = spans.withColumn("reach", F.coalesce(reach, F.lit(-1)))
    step = step.withColumns({"gain": F.greatest(F.col("e") - F.greatest("s", "reach"), F.lit(0)), "new": (F.col("s") > F.col("reach")).cast("int")})
    per = step.groupBy("doc").agg(F.sum("gain").alias("shared_chars"), F.sum("new").alias("n_spans"))
    sizes = s["sizes"]
    copies = s["copies"].select(F.col("id").alias("copy_id"), "rep")
    out = sizes.join(copies, F.col("id") == F.col("copy_id"), "left").join(per, F.col("doc") == F.col("id"), "left")
    whole = F.col("rep").isNotNull()
    return out.select(
        F.col("id").alias("doc_id"), "n_chars",
        F.when(whole, F.col("n_chars")).otherwise(F.coalesce("shared_chars", F.lit(0))).alias("shared_chars"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
    )


def links(docs: DataFrame, min_len: int = 300, **columns) -> DataFrame:
    """(doc_id, class_id, n_links): every document of ``min_len`` characters or more with the lowest id of its exact copies and the number of
    other texts it shares a span with, a class of copies counting once."""
    s = shared(docs, min_len, **columns)
    reps = s["matches"].select("a", "b").unionByName(s["groups"]).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = reps.unionByName(reps.select(F.col("b").alias("a"), F.col("a").alias("b")))
    n = both.groupBy(F.col("a").alias("class_id")).agg(F.count("*").alias("n_links"))
    out = s["sizes"].select("id").join(s["copies"], "id", "left").select(F.col("id").alias("doc_id"), F.coalesce("rep", "id").alias("class_id"))
    return out.join(n, "class_id", "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
