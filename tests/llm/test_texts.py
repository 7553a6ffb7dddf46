"""Consistent text form, leaks, packing and shared spans against brute force."""

import random
import re
import unicodedata

import pytest
from citelake.llm import leaks, packing, spans, unify
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

T = unify.transducer()


@pytest.mark.parametrize("odd,plain", [
    ("ＡＢ１％．", "AB1%."), ("Mörz é", "Mörz é"), ("a b c　d e", "a b c d e"), ("fi­n​d﻿⁠s", "finds"), ("ﬁlm eﬀect", "film effect"),
    ("раtient Аpr", "patient Apr"), ("tοtal ΜEB1", "total MEB1"), ("43 µg", "43 μg"), ("A‑B", "A-B"), ("Å", "Å"), ("λoγo​ς", "λογος"), ("По​рядок", "Порядок"), ("Поpядок", "Порядок"), ("АТР level", "ATP level"),
])
def test_unified(odd, plain):
    assert T.run(odd) == plain and T.run(plain) == plain


@pytest.mark.parametrize("text", ["", "plain ASCII\ttext\n", "5 ± 2", "Sørmalö Dvořvoér Ñ Ç Å", "TNF-α, β and κ", "1.5 μg per day", "Περι νόσου", "Порядок лечения в а", "x² €"])
def test_plain_text_is_left_alone(text):
    assert T.run(text) == text


#: Full-width letters, look-alikes, composed letters, marks of several classes, invisible characters, spaces, conjoining and half-width syllables.
HARD = "aoAE \uff21\uff45\u0430\u043e\u0435\u0456\u03bf\u03bd\u03b1\u0439\u0451\u00e9\u1ed9\u0301\u0302\u0323\u0327\u0345\u200b\u200d\u00ad\ufe0f\u00a0\u3000\u1100\u1161\u11a8\uffa1\uffc2\uff8a\uff9e\u212b\u2163\ufb00\U0002f800"


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=40) | st.text(HARD, max_size=12))
def test_one_pass_is_enough(text):
    once = T.run(text)
    assert T.run(once) == once and unicodedata.normalize("NFC", once) == once


@settings(max_examples=500, deadline=None)
@given(st.text(HARD, max_size=10))
def test_equal_texts_come_to_one_form(text):
    """However its accents are written and ordered, and whatever invisible characters stand between."""
    want = T.run(text)
    assert T.run(unicodedata.normalize("NFD", text)) == want == T.run(unicodedata.normalize("NFC", text))
    assert T.run("".join(c + "\u200b" for c in text)) == want


def test_every_rule_holds_in_a_text():
    for seq, plain in T.table.items():
        assert T.run(T.run(seq)) == T.run(seq) and (len(seq) > 1 or T.run(seq) != seq or not plain)


def test_look_alikes_of_other_scripts():
    assert T.run("\u13aaTP") == "ATP" and T.run("\u0585ne") == "one" and T.run("\ua4d0one") == "Bone" and T.run("do\u0261") == "dog" and T.run("Type \u2163") == "Type IV"


def test_long_words_take_linear_time():
    assert T.run("x" * 200_000 + " \u00e9 " + "y" * 200_000 + "\u200b") == "x" * 200_000 + " \u00e9 " + "y" * 200_000


def test_rule_conflicts_are_found():
    with pytest.raises(ValueError, match="two forms"):
        unify.compile_rules(iter([("a", "x", "1"), ("b", "x", "2")]))
    with pytest.raises(ValueError, match="isn't plain"):
        unify.compile_rules(iter([("a", "x", "y"), ("b", "y", "z")]))


def test_accents_agree_with_the_standard_form():
    for c in map(chr, range(0xC0, 0x250)):
        d = unicodedata.normalize("NFD", c)
        assert T.run(d) == unicodedata.normalize("NFC", d) or not d[0].isalpha()


@pytest.mark.parametrize("odd,plain", [
    ("\u00f4\u0323", "\u1ed9"), ("o\u0302\u0323", "\u1ed9"), ("o\u0323\u0302", "\u1ed9"), ("\u1ecd\u0302", "\u1ed9"), ("\u1ed9", "\u1ed9"), ("Vi\u00ea\u0323t", "Vi\u1ec7t"),
    ("\U0002f800", "\u4e3d"), ("\U0002fa1d", "\U0002a600"), ("e\u200d\u0301", "\u00e9"), ("\uff45\u0301", "\u00e9"),
])
def test_marks_in_any_order(odd, plain):
    assert T.run(odd) == plain == T.run(plain)


def test_not_plain_rows(spark):
    df = spark.createDataFrame([(1, "a b", "k"), (1, "a b", "k"), (2, "a b", None), (3, None, "k"), (4, "", "k"), (5, "α", "k"), (6, "x" * 100_000 + "​", "k")], "id int, t string, other string")
    got = sorted((r["id"], r["plain"][:5]) for r in unify.not_plain(df, "t").collect())
    assert got == [(1, "a b"), (1, "a b"), (6, "xxxxx")]
    assert [r[0] for r in df.orderBy("id").select(unify.plain_form(F.col("t"))).collect()][2:6] == ["a b", None, "", "α"]
    assert unify.not_plain(df.limit(0), "t").count() == 0


# ---- leaks


def brute_leaks(docs, items, n):
    word = re.compile(r"[^\W_]+")
    grams = {}
    for i, t in items:
        w = [x.lower() for x in word.findall(t or "")]
        for k in range(len(w) - n + 1):
            grams.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = set()
    for d, t in docs:
        w = [x.lower() for x in word.findall(t or "")]
        for k in range(len(w) - n + 1):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + n]), ())}
    return out


@pytest.mark.parametrize("block", [leaks.BLOCK_WORDS, 7])
def test_leaks_against_brute_force(spark, block):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice(["ab ", "B-", "é\n", "c_", "4. "]) for _ in range(n))
    docs = [(i, text(rng.randrange(60))) for i in range(80)] + [(90, None), (91, ""), (None, text(40)), (92, "x " * 50_000)]
    items = [(i, text(rng.randrange(14))) for i in range(25)] + [(50, None), (51, ""), (52, "AB b c"), (52, "AB b c")]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    found = leaks.leaks(d.withColumn("item_id", F.lit(1)), i, 4, block_words=block)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == brute_leaks([x for x in docs if x[0] is not None], items, 4)
    assert leaks.leaks(d, i.limit(0), 4).count() == 0 and leaks.leaks(d.limit(0), i, 4).count() == 0


def test_scrub(spark):
    d = spark.createDataFrame([(1, "keep One two, THREE four. end", "x"), (2, "one two three", "y"), (3, None, "z"), (None, "one two three four", "n")], "doc_id bigint, text string, start string")
    i = spark.createDataFrame([(7, "one two three four")], "item_id int, text string")
    found = leaks.leaks(d, i, 3)
    assert sorted((r["doc_id"], r["start"], r["end"]) for r in found.collect()) == [(1, 5, 24), (2, 0, 13)]
    assert sorted((r["doc_id"] or 0, r["text"], r["start"]) for r in leaks.scrub(d, found).collect()) == [(0, "one two three four", "n"), (1, "keep  . end", "x"), (2, " ", "y"), (3, None, "z")]
    assert sorted(r["doc_id"] or 0 for r in leaks.scrub(d, found, "document").collect()) == [0, 3]
    with pytest.raises(ValueError):
        leaks.scrub(d, found, "word")


# ---- packing


def optimum(sizes, capacity):
    best = [len(sizes)]

    def place(left, bins):
        if len(bins) >= best[0]:
            return
        if not left:
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + left[0] <= capacity and bins[b] not in bins[:b]:
                place(left[1:], [*bins[:b], bins[b] + left[0], *bins[b + 1 :]])
        place(left[1:], [*bins, left[0]])

    place(sorted(sizes, reverse=True), [])
    return best[0]


@settings(max_examples=300, deadline=None)
@given(st.integers(4, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=8))))
def test_reduction_keeps_an_optimal_packing(case):
    capacity, sizes = case
    fixed, rest = packing.reduce_instance(sizes, capacity)
    assert sorted([i for b in fixed for i in b] + rest) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= capacity for b in fixed)
    assert len(fixed) + optimum([sizes[i] for i in rest], capacity) == optimum(sizes, capacity)
    bins = packing.pack(sizes, capacity)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= capacity for b in bins)


def test_containers(spark):
    rng = random.Random(8)
    sizes = [(i, rng.choice([rng.randrange(1, 30), rng.randrange(1, 260)])) for i in range(3000)] + [(9000, 0), (9001, None), (None, 5), (9002, -1), (9003, 100), (9003, 100), (9004, 300), (9005, 250), (9005, 250)]
    df = spark.createDataFrame([(i, n, "c") for i, n in sizes], "doc_id bigint, n_tokens bigint, container string")
    got = packing.containers(df, 100, shard=500).collect()
    per, by = {}, {}
    for r in got:
        per[r["container"]] = per.get(r["container"], 0) + r["n_tokens"]
        by.setdefault(r["doc_id"], []).append((r["part"], r["n_tokens"]))
    assert max(per.values()) <= 100
    want = {i: n for i, n in sizes if i is not None and n and n > 0}
    assert {i: sum(n for _, n in v) for i, v in by.items()} == want | {9003: 200, 9005: 500}
    assert all(len(by[i]) == 1 for i, n in want.items() if n <= 100 and i != 9003)
    assert sorted(by[9005]) == [(1, 100), (1, 100), (2, 100), (2, 100), (3, 50), (3, 50)]
    assert sorted(by[9004]) == [(1, 100), (2, 100), (3, 100)]
    assert all(n > 0 for n in per.values()) and len(per) <= 1.01 * sum(per.values()) / 100 + 6
    again = packing.containers(df.repartition(7), 100, shard=500).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert packing.containers(df.limit(0), 100).count() == 0
    with pytest.raises(ValueError):
        packing.containers(df, 0)


def test_token_counts(spark):
    enc = packing.encoding(packing.TOKENIZER)
    texts = ["Two words.", "", None, "<|endoftext|>", "Größe μ", "word " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in packing.count_tokens(df).collect()}
    assert got == {i: len(enc.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}
    assert enc.decode(enc.encode_ordinary("Größe μ <|endoftext|>")) == "Größe μ <|endoftext|>" and got[3] > 1


# ---- shared spans


@pytest.mark.parametrize("q", [2, 3, 5, 7, 13])
def test_difference_cover(q):
    v, cover = spans.singer_cover(q)
    assert v == q * q + q + 1 and len(cover) == q + 1 and {(a - b) % v for a in cover for b in cover} == set(range(v))


def test_cover_needs_room():
    period, _, window = spans.cover_for(300)
    assert period + window == 301 and window > 100
    with pytest.raises(ValueError):
        spans.cover_for(5)


def corpus(rng):
    """Texts over few letters, with shared passages around the limit, copies, a phrase in every text and periodic texts."""
    text = lambda n: "".join(rng.choice("abcdeé𝄞 ") for _ in range(n))
    phrase, docs = text(28), []
    for i in range(60):
        docs.append((i, text(rng.randrange(120)) + (phrase if rng.random() < 0.7 else "") + text(rng.randrange(120))))
    for i in range(60, 100):
        a, b = docs[rng.randrange(60)][1], docs[rng.randrange(60)][1]
        s, n = rng.randrange(max(1, len(a) - 10)), rng.choice([35, 39, 40, 41, 60, 120])
        docs.append((i, b[: rng.randrange(len(b) + 1)] + a[s : s + n] + text(rng.randrange(50))))
    docs += [(100 + k, docs[3][1]) for k in range(4)] + [(110, "ab" * 200), (111, "ba" * 100), (112, "x" * 39), (113, "x" * 40), (114, "x" * 900)]
    return docs + [(200, None), (201, ""), (None, docs[0][1]), docs[5]]


def brute_spans(docs, n):
    seen, pairs = {}, set()
    for i, t in docs:
        if i is not None and t:
            for k in range(len(t) - n + 1):
                seen.setdefault(t[k : k + n], set()).add(i)
    for s in seen.values():
        pairs |= {(a, b) for a in s for b in s if a < b}
    cover = {}
    for i, t in docs:
        if i is None or not t or len(t) < n:
            continue
        mark = bytearray(len(t))
        for k in range(len(t) - n + 1):
            if len(seen[t[k : k + n]]) > 1:
                mark[k : k + n] = b"\1" * n
        cover[i] = sum(mark)
    return pairs, cover


@pytest.mark.parametrize("paired,pack,seed", [(spans.PAIRED, spans.PACK, 1), (2, 50, 1), (4, 300, 2), (2, spans.PACK, 3)])
def test_shared_spans_against_brute_force(spark, paired, pack, seed, monkeypatch):
    monkeypatch.setattr(spans, "SIDE", 3)
    size = {"paired": paired, "pack": pack, "chunk": 150}  # texts come in overlapping pieces, anchors in small packs
    docs = corpus(random.Random(seed))
    pairs, cover = brute_spans(docs, 40)
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, a int")
    assert {tuple(r) for r in spans.pairs(df, 40, **size).collect()} == pairs
    assert {r["doc_id"]: r["shared_chars"] for r in spans.coverage(df, 40, **size).collect()} == cover


def brute_links(docs, pairs, n):
    """Lowest id of equal texts, and other texts (ids of one text and none before) that share a span."""
    by = {}
    for i, t in docs:
        if i is not None and t and len(t) >= n:
            by.setdefault(i, set()).add(t)
    first = {}
    for i in sorted(by):
        if len(by[i]) == 1:
            first.setdefault(next(iter(by[i])), i)
    rep = {i: first.get(next(iter(t)), i) if len(t) == 1 else i for i, t in by.items()}
    both = {(rep[a], rep[b]) for a, b in pairs if rep[a] != rep[b]}
    both |= {(b, a) for a, b in both}
    return {(i, r, sum(a == r for a, _ in both)) for i, r in rep.items()}


@pytest.mark.parametrize("pack", [40, spans.PACK])
def test_one_phrase_in_every_document(spark, pack):
    """A short phrase links nothing, a long one links all; ids with several texts, one of them a copy, lose no link."""
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    short, long = text(25), text(60)
    docs = [(i, text(30) + short + text(30)) for i in range(90)]
    docs += [(100 + i, text(20) + short + text(20) + long) for i in range(45)]
    own = text(70)
    docs += [(300, docs[0][1]), (300, own), (301, docs[0][1]), (302, "x" + own[5:60] + "y"), (303, own), (304, docs[0][1]), (304, docs[1][1])]
    pairs, _ = brute_spans(docs, 40)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    assert {tuple(r) for r in spans.pairs(df, 40, paired=4, pack=pack).collect()} == pairs
    assert {tuple(r) for r in spans.links(df, 40, paired=4, pack=pack).collect()} == brute_links(docs, pairs, 40)


def test_shared_spans_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert spans.pairs(df).count() == 0 and spans.coverage(df).count() == 0
