"""Spellings of persons and of departments that name the same one.

Spellings are first put together by what they say - words and initials, or topic, kind, places and country - and only these forms are
compared.  Forms are indexed by the suffixes of their tokens; a suffix that many share is refined by the other field, then by
the whole token, and what many still share is compared in parts of bounded size, so no pair is dropped.  Pairs are compared token by token by the
ratio of their longest common subsequence.  Certain links make components; a form that says less - no middle initial, only an initial, an
ambiguous short name - joins a component only if exactly one fits.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Letters of a token's suffix by which forms meet at first; a shorter token counts whole.
SUFFIX = 5
#: Forms that share a suffix and are compared pairwise; a more common suffix is refined first.
BLOCK = 16
#: Forms on one side of a comparison in one task, on average, where refined blocks are still large.
PART = 512

# Given names and the short forms in use for them.
SHORT_FORMS = """
abigail abby gail; alexander alex sasha xander al; alexandra alex sasha; andrew andy drew; anthony tony; barbara barb babs; benjamin ben benny;
catherine cathy kate cate; charles charlie chuck; christine chris tina; christopher chris kit; daniel dan danny; david dave; deborah deb debbie debby;
donald don; dorothy dot dottie dolly; edward ed eddie ted ned; elizabeth liz beth betty eliza lizzie; emily em; eugene gene; frances fran;
francis frank; frederick fred freddy; gregory greg; henry harry hank; jacob jake; james jim jimmy jamie; jennifer jen jenny; john jack johnny; jonathan jon;
joseph joe joey; judith judy; katherine kathy kate katie kat; kenneth ken; lawrence larry; leonard len lenny; margaret peggy maggie meg peg;
matthew matt; michael mike mick; nathaniel nate; nicholas nick nicky; pamela pam; patricia pat patty tricia trish; patrick pat paddy; peter pete;
philip phil; rebecca becky becca; richard rick dick rich ricky; robert bob rob bobby robbie; ronald ron; samuel sam sammy; samantha sam; sandra sandy;
stephen steve; steven steve; susan sue susie; theodore ted teddy theo; thomas tom tommy; timothy tim; victoria vicky vic tori; viktor vic; victor vic;
walter walt; wilhelmina mina; william bill will billy willy; zachary zach
"""
# Titles and degrees written with names.
TITLES = frozenset("dr prof professor mr mrs ms miss sir md phd msc bsc mph dds do rn dphil mbbs frcp jr sr".split())
# Words of departments and of kinds of institutions, with their abbreviations.
UNIT_WORDS = frozenset("department dept dep unit division div section".split())
KIND_WORDS = {
    "university": "university", "univ": "university", "institute": "institute", "inst": "institute", "technology": "technology",
    "technol": "technology", "tech": "technology", "medical": "medical", "med": "medical", "school": "school", "sch": "school", "general": "general",
    "gen": "general", "hospital": "hospital", "hosp": "hospital", "research": "research", "res": "research", "centre": "centre",
    "center": "centre", "ctr": "centre", "college": "college", "coll": "college", "academy": "academy", "acad": "academy",
    "faculty": "faculty", "fac": "faculty", "clinic": "clinic", "laboratory": "laboratory", "lab": "laboratory",
}
#: Kind words that show an institution by themselves.
HEADS = frozenset("university institute school hospital centre college academy clinic".split())
SMALL = frozenset("of the and for at in".split())

_FORMS: dict[str, frozenset] = {}
for _line in SHORT_FORMS.replace("\n", " ").split(";"):
    _formal, *_short = _line.split()
    for _s in _short:
        _FORMS[_s] = _FORMS.get(_s, frozenset()) | {_formal}
#: Given names that have a short form or are one.
_NAMES = frozenset(_FORMS).union(*_FORMS.values())


def plain(text: str) -> str:
    """Lower case without accents."""
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & masks.get(c, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over both lengths."""
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def near(a: str, b: str) -> bool:
    """One slip apart: the ratio is at least that of one letter added, dropped, changed or swapped."""
    m = max(len(a), len(b))
    return abs(len(a) - len(b)) <= 1 and m >= 3 and ratio(a, b) >= 2 * (m - 1) / (len(a) + len(b))


# ---- persons: (words, initials); a spelling has two words, or one word and initials


def person(name: str):
    """Words and initials of a name, the family name first where a comma says so; None without any word.

    Two or three capitals beside a word that isn't all capitals are initials (``Fokogimli DJ``), as is a degree that would leave
    nothing but a family name.
    """
    mixed = not name.isupper()
    parts = []
    for raw in name.split(","):
        tokens = []
        for t in re.findall(r"[^\W\d_]+", re.sub(r"['’\-]", "", raw.strip())) if raw.isascii() else _letters(raw):
            joined = mixed and 2 <= len(t) <= 3 and t.isupper()
            tokens.append((plain(t), joined))
        parts.append(tokens)
    kept = [[(t, joined) for t, joined in p if t not in TITLES] for p in parts]
    if sum(len(p) for p in kept) < 2:  # only a family name is left
        kept = [[(t, joined) for t, joined in p if t not in TITLES or joined] for p in parts]
    split = [[c for t, joined in p for c in (t if joined else [t])] for p in kept]
    split = [p for p in split if p]
    if len(split) > 1:
        family, rest = split[0], [t for p in split[1:] for t in p]
        words = ["".join(t for t in family if len(t) > 1), *[t for t in rest if len(t) > 1]]
        initials = [t for t in rest if len(t) == 1] + [t for t in family if len(t) == 1]
    else:
        tokens = split[0] if split else []
        words, initials = [t for t in tokens if len(t) > 1], [t for t in tokens if len(t) == 1]
    words = [w for w in words if w]
    if not words:
        return None
    if len(words) > 2:
        words = [words[0], "".join(words[1:])]
    return tuple(sorted(words)), tuple(initials)


def _letters(raw: str) -> list[str]:
    return re.findall(r"[^\W\d_]+", re.sub(r"['’\-]", "", unicodedata.normalize("NFC", raw)))


def formal(word: str) -> frozenset:
    return _FORMS.get(word, frozenset((word,)))


NO, SURE, NO_MIDDLE, SHORT, SHORT_SLIP, INITIAL, INITIAL_SLIP = range(7)
#: Links that only join a component to the one that fits, in the order they are settled; of each step the second kind counts where there is
#: none of the first.
STEPS = ((NO_MIDDLE, NO_MIDDLE), (SHORT, SHORT_SLIP), (INITIAL, INITIAL_SLIP))


def same_person(a, b) -> int:
    """How two parsed names agree: NO; SURE; NO_MIDDLE, one lacks the middle initial; SHORT, one has an ambiguous short form, SHORT_SLIP, a
    short form and a slip in the other word; INITIAL, one has only an initial, INITIAL_SLIP, and a slip in the family name."""
    (wa, ia), (wb, ib) = a, b
    if len(wa) > len(wb):
        return same_person(b, a)
    if len(wa) == 1 and len(wb) == 1:
        return SURE if wa == wb and ia == ib and ia else NO
    if len(wa) == 1:
        if not ia:
            return NO
        for family, given in ((wb[1], wb[0]), (wb[0], wb[1])):
            firsts = {given[0]} | {f[0] for f in formal(given)}
            if ia[0] in firsts and (family == wa[0] or near(family, wa[0])) and not (len(ia) > 1 and ib and ia[1] != ib[0]):
                return INITIAL if family == wa[0] else INITIAL_SLIP
        return NO
    middle = NO if ia and ib and ia[0] != ib[0] else SURE if bool(ia) == bool(ib) else NO_MIDDLE
    if middle == NO:
        return NO
    for x, y, u, v in ((wa[0], wb[0], wa[1], wb[1]), (wa[0], wb[1], wa[1], wb[0])):
        if x == y and u == v:
            return middle
        for p, q, r, s in ((x, y, u, v), (u, v, x, y)):
            fp, fq = formal(p), formal(q)
            if p != q and fp & fq and (r == s or near(r, s)):
                return SHORT_SLIP if r != s else middle if len(fp) == len(fq) == 1 else SHORT
            if r == s and near(p, q) and not (p in _FORMS and q in _FORMS):
                return middle
    return NO


def slips(text: str) -> dict[str, None]:
    """The text and the text without any one of its letters: two texts that are ``near`` have one of these in common."""
    return dict.fromkeys([text, *(text[:i] + text[i + 1 :] for i in range(len(text)))])


@lru_cache(100_000)
def suffixes(token: str) -> tuple[str, ...]:
    """The suffixes of a token and of the token without any one of its letters: two tokens that are ``near`` have one in common."""
    return tuple(dict.fromkeys(d[-SUFFIX:] for d in slips(token)))


def _whole(token: str, suffix: str) -> list[str]:
    """The slips of a token that end in a suffix."""
    return [d for d in slips(token) if d[-SUFFIX:] == suffix]


# Keys are level, sort, index value and refinement, parted by tabs.  Level 0 is the suffix alone, 1 the suffix refined by the other field, 2 the
# whole token so refined.


def _beside(p, other: str | None) -> list[tuple[str, str]]:
    """(sort, refinement) by the other token of a name: = the token, ~ a formal name of it, < an initial it may have."""
    if other is None:
        return [("<", p[1][0])]
    forms = sorted(formal(other))
    known = forms if other in _NAMES else []
    return [("=", other), *(("~", f) for f in known), *(("<", c) for c in sorted({other[0], *(f[0] for f in forms)}))]


def _tokens(p) -> list[tuple[str, str | None]]:
    words = p[0]
    return [(words[0], None)] if len(words) == 1 else [words, words[::-1]]


def person_keys(p, key: str = "") -> Iterator[str]:
    """Keys of a parsed name below a key: with none those of level 0, with one of level 0 those of level 1, and so on.

    Any two names that ``same_person`` accepts have a key of each level in common: one token is near, and the other equal, of
    one formal name, or met by its initial.
    """
    level, sort, value, by = (key or "\t\t\t").split("\t")
    for token, other in _tokens(p):
        if level == "":
            yield from (f"0\t\t{s}\t" for s in suffixes(token))
        elif level == "0" and value in suffixes(token):
            yield from (f"1\t{k}\t{value}\t{b}" for k, b in _beside(p, other))
        elif level == "1" and value in suffixes(token) and (sort, by) in _beside(p, other):
            yield from (f"2\t{sort}\t{d}\t{by}" for d in _whole(token, value))


# ---- departments of institutions: (topic, kind, places, country)


@lru_cache(200_000)
def _kind_word(t: str) -> str:
    """The kind a word stands for, with a slip at most; '' for any other word."""
    if t in KIND_WORDS:
        return KIND_WORDS[t]
    return next((v for k, v in KIND_WORDS.items() if len(k) > 5 and len(t) > 5 and near(t, k)), "")


@lru_cache(200_000)
def _is_unit(t: str) -> bool:
    return len(t) > 7 and near(t, "department")


def department(text: str):
    """Topic, kind of institution, place names and country of an affiliation; None if it has no topic or no place."""
    segments = [re.findall(r"[^\W_]+", s.replace("&", " and ")) for s in re.split(r"[,;]", plain(text))]
    segments = [[t for t in s if not t.isdigit()] for s in segments]
    segments = [s for s in segments if s]

    topic = kind = None
    places: list[str] = []
    rest = []
    for s in segments:
        unit = any(t in UNIT_WORDS or _is_unit(t) for t in s)
        kinds = {_kind_word(t) for t in s} - {""}
        if unit and topic is None:
            topic = " ".join(t for t in s if t not in UNIT_WORDS and (t == "and" or t not in SMALL) and not _is_unit(t))
        elif kinds & HEADS and kind is None:
            kind = " ".join(sorted(kinds))
            places += ["".join(t for t in s if not _kind_word(t) and t not in SMALL)]
        else:
            rest.append(" ".join(s))
    if topic is None and rest:
        topic = rest.pop(0)
    country = ""
    for r in rest:
        if places and (r == places[0] or near(r, places[0])):
            places.append(r)
        elif r is rest[-1]:
            country = r
        else:
            places.append(r)
    places = [p for p in dict.fromkeys(places) if p]
    return (topic, kind or "", tuple(places), country) if topic and places else None


def abbreviates(a: str, b: str) -> bool:
    """Word for word equal or one a shortening of the other: same first letter, letters in order (``publ hlth``, ``public health``)."""
    u, w = a.split(), b.split()

    def short(x: str, y: str) -> bool:
        x, y = sorted((x, y), key=len)
        return x == y or (len(x) >= 2 and x[0] == y[0] and lcs(x, y) == len(x))

    return len(u) == len(w) and all(map(short, u, w))


def same_department(a, b) -> int:
    """SURE if topic, kind and place agree with at most one slip among topic and place, and the countries don't contradict; else NO."""
    (ta, ka, pa_, ca), (tb, kb, pb, cb) = a, b
    if ka != kb:
        return NO
    if ca and cb and ca != cb and not near(ca, cb):
        return NO
    topic = 0 if ta == tb or abbreviates(ta, tb) else 1 if near(ta, tb) else 9
    if topic == 9:
        return NO
    place = 0 if set(pa_) & set(pb) else 1 if any(near(x, y) for x in pa_ for y in pb) else 9
    return SURE if topic + place <= 1 else NO


def department_keys(d, key: str = "") -> Iterator[str]:
    """Keys of a parsed department below a key, as ``person_keys``: by a place, refined by the kind and the topic.

    = the first letters of the topic's words, which abbreviations keep; ~ a suffix of the topic, then the place with the whole topic.
    """
    topic, kind, places, _ = d
    letters = "".join(w[0] for w in topic.split())
    level, sort, value, by = (key or "\t\t\t").split("\t")
    for place in places:
        if level == "":
            yield from (f"0\t\t{s}\t" for s in suffixes(place))
        elif level == "0" and value in suffixes(place):
            yield f"1\t=\t{value}\t{kind}|{letters}"
            yield from (f"1\t~\t{value}\t{kind}|{s}" for s in suffixes(topic)) if value == place[-SUFFIX:] else ()
        elif level == "1" and sort == "=" and value in suffixes(place) and by == f"{kind}|{letters}":
            yield from (f"2\t=\t{x}\t{by}" for x in _whole(place, value))
        elif level == "1" and sort == "~" and value == place[-SUFFIX:]:
            yield from (f"2\t~\t{place}\t{kind}|{x}" for x in _whole(topic, by.removeprefix(kind + "|")))


def says(p) -> int:
    """How much a parsed name says: words and initials count, a short form of several names counts less."""
    words, initials = p
    return 10 * len(words) + len(initials) - 5 * any(len(formal(w)) > 1 for w in words)


def _write_person(p) -> str:
    return "\t".join(["".join(p[1]), *p[0]])


def _read_person(form: str):
    initials, *words = form.split("\t")
    return tuple(words), tuple(initials)


def _write_department(d) -> str:
    topic, kind, places, country = d
    return "\t".join([topic, kind, country, *sorted(places)])


def _read_department(form: str):
    topic, kind, country, *places = form.split("\t")
    return topic, kind, tuple(places), country


@dataclass(frozen=True)
class Field:
    """How values of a field are read, written as a form, indexed, compared and weighed."""

    parse: Callable
    write: Callable
    read: Callable
    keys: Callable
    same: Callable
    says: Callable


FIELDS = {
    "name": Field(lambda v: (p := person(v)) and (p if len(p[0]) > 1 or p[1] else None), _write_person, _read_person, person_keys, same_person, says),
    "affiliation": Field(department, _write_department, _read_department, department_keys, same_department, lambda d: 0),
}
#: A form in a table starts with its field's first letter.
_BY_LETTER = {k[0]: f for k, f in FIELDS.items()}


@lru_cache(200_000)
def _read(form: str):
    return _BY_LETTER[form[0]].read(form[1:])


# ---- forms, blocks and links


def _table(rows: list[tuple], *columns: tuple[str, pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, columns, strict=True)], [n for n, _ in columns])


def forms(values: DataFrame) -> DataFrame:
    """(field, value, form) of the distinct values (field, value) that say enough to be compared."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for f, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                p = FIELDS[f].parse(v)
                if p is not None:
                    rows.append((f, v, f[0] + FIELDS[f].write(p)))
            yield _table(rows, ("field", pa.string()), ("value", pa.string()), ("form", pa.string()))

    return values.select("field", "value").mapInArrow(parse, "field string, value string, form string")


_ROWS = (("block", pa.string()), ("form", pa.string()))


def _finer(rows: DataFrame) -> DataFrame:
    """(block, form) of the next level: each form's keys below its block (NULL: none yet)."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block, form in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                below = _BY_LETTER[form[0]].keys(_read(form), block[1:] if block else "")
                out += [(form[0] + k, form) for k in dict.fromkeys(below)]
                if len(out) > 20_000:
                    yield _table(out, *_ROWS)
                    out = []
            yield _table(out, *_ROWS)

    return rows.select("block", "form").mapInArrow(index, "block string, form string")


def _numbered(rows: DataFrame) -> DataFrame:
    """With a number for each block, by which rows are counted, joined and sorted; two blocks of one number are refined or read together, no more."""
    return rows.withColumn("number", F.xxhash64("block"))


def _blocks(spelt: DataFrame, block: int, part: int) -> DataFrame:
    """(block, side, form): what is to be compared.  A key that up to ``block`` forms share is a block; a more common one is refined, and where
    that is at its end, its forms are dealt to parts and every two parts make a block with two sides."""
    rows = cut(_numbered(_finer(spelt.select(F.lit(None).cast("string").alias("block"), "form").distinct())))
    done = []
    for _ in range(2):
        shared = rows.groupBy("number").agg(F.count("*").alias("n")).where("n > 1")  # a form alone has no partner here
        rows = cut(rows.join(shared, "number"))
        done.append(rows.where(F.col("n") <= block).select("block", F.lit(0).alias("side"), "form"))
        rows = cut(_numbered(_finer(rows.where(F.col("n") > block))))
    parts = rows.groupBy("number").agg(F.count("*").alias("n")).where("n > 1").select("number", F.ceil(F.col("n") / part).cast("int").alias("parts"))
    dealt = rows.join(parts, "number").withColumn("side", F.pmod(F.xxhash64("form"), F.col("parts")).cast("int"))
    across, one_word = F.split("block", "\t")[1] == "<", F.size(F.split("form", "\t")) == 2
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    pair = dealt.withColumn("with", F.explode(F.when(across & ~one_word, F.array("side")).otherwise(every)))
    low, high = (F.when(across, F.col("with")).otherwise(f("side", "with")) for f in (F.least, F.greatest))
    named = F.concat_ws("\t", "block", low, high).alias("block")
    return done[0].unionByName(done[1]).unionByName(pair.select(named, "side", "form"))


def _compare(blocks: DataFrame) -> DataFrame:
    """(a, b, how) of the pairs that agree, ``a`` the one that says less; blocks are read as sorted runs, so a task holds one
    block at a time."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs():
            last, held = None, {}
            for batch in batches:
                for n, b, s, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if n != last:
                        yield from held.items()
                        last, held = n, {}
                    held.setdefault(b, []).append((s, v))
            yield from held.items()

        out: list[tuple] = []
        for name, held in runs():
            if len(held) < 2:
                continue
            field = _BY_LETTER[name[0]]
            read = [(s, f, _read(f)) for s, f in held]
            _, sort, _, _, *sides = name.split("\t")
            i, j = map(int, sides or (0, 0))
            if sort == "<":  # one word and initials against two words
                met = product([x for x in read if len(x[2][0]) == 1], [x for x in read if len(x[2][0]) > 1])
                met = ((x, y) for x, y in met if i == j or x[0] != y[0])
            elif i != j:
                met = product([x for x in read if x[0] == i], [x for x in read if x[0] == j])
            else:
                met = combinations(read, 2)
            for (_, a, p), (_, b, q) in met:
                how = field.same(p, q)
                if how:
                    out.append((a, b, how) if (field.says(p), a) < (field.says(q), b) else (b, a, how))
                    if len(out) > 10_000:
                        yield _table(out, *_LINKS)
                        out = []
        yield _table(out, *_LINKS)

    ordered = _numbered(blocks).select("number", "block", "side", "form").repartition(_tasks(blocks), "number").sortWithinPartitions("number")
    return ordered.mapInArrow(links, "a string, b string, how int").distinct()


_LINKS = (("a", pa.string()), ("b", pa.string()), ("how", pa.int32()))


def _tasks(df: DataFrame) -> int:
    """Partitions for steps that take more time than their size tells: by cores, or the session's shuffle partitions if these are more."""
    spark = df.sparkSession
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _signature(edges: DataFrame) -> tuple:
    """Number of edges and two order-free digests of them: equal exactly when a round changed nothing, but for a chance of 2**-128."""
    h = [F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64(F.lit(7), "v", "u").cast("decimal(38,0)"))]
    return tuple(edges.agg(F.count("*"), *h).first())


def components(links: DataFrame) -> DataFrame:
    """(value, root) of the components of links (a, b): each value's lowest one, by alternating large and small stars.

    Every round is written to the checkpoint folder; rounds grow with the logarithm of a component's diameter.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while (now := _signature(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = cut(small.unionByName(small_low.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("u").alias("value"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("value"), F.col("v").alias("root")).distinct())


def _attach(roots: DataFrame, weak: DataFrame) -> DataFrame:
    """(root, to): components that say less and the only one each fits; with several it stays alone.

    ``weak`` (x, y, slip): form x, that says less, fits form y.  Fits with a slip count where there is none without.
    """
    rx = roots.select(F.col("value").alias("x"), F.col("root").alias("root_x"))
    ry = roots.select(F.col("value").alias("y"), F.col("root").alias("root_y"))
    w = weak.join(rx, "x").join(ry, "y").where("root_x <> root_y")
    clean = F.when(~F.col("slip"), F.col("root_y"))
    least, most = (F.coalesce(f(clean), f("root_y")) for f in (F.min, F.max))
    one = w.groupBy("root_x").agg(least.alias("to"), most.alias("other")).where("to = other")
    one = cut(one.select(F.col("root_x").alias("root"), "to"))
    chained = one.join(one.select(F.col("root").alias("next")), F.col("to") == F.col("next"), "left_semi")
    if chained.isEmpty():
        return one
    linked = components(one.select(F.col("root").alias("a"), F.col("to").alias("b")))
    return linked.where("value <> root").select(F.col("value").alias("root"), F.col("root").alias("to"))


def entities(values: DataFrame, block: int = BLOCK, part: int = PART) -> DataFrame:
    """(field, value, root, n): values (field, value) that have another spelling, with the lowest spelling of their entity and the number of
    its spellings.  ``field`` is 'name' (persons) or 'affiliation'."""
    distinct = values.where("value is not null and trim(value) <> ''").distinct()
    spelt = cut(forms(distinct.repartition(_tasks(distinct))))
    links = cut(_compare(_blocks(spelt, block, part)))
    # numbers for the linked forms: what follows then hashes and moves no strings
    nodes = links.select(F.col("a").alias("form")).unionByName(links.select(F.col("b").alias("form"))).distinct()
    nodes = cut(nodes.withColumn("id", F.monotonically_increasing_id()))
    for side in "ab":
        links = links.withColumnRenamed(side, "form").join(nodes, "form").drop("form").withColumnRenamed("id", side)
    links = cut(links)
    sure = components(links.where(F.col("how") == SURE).select("a", "b")).withColumnRenamed("value", "id")
    roots = cut(nodes.join(sure, "id", "left").select(F.col("id").alias("value"), F.coalesce("root", "id").alias("root")))
    for step in STEPS:
        weak = links.where(F.col("how").isin(*step)).select(F.col("a").alias("x"), F.col("b").alias("y"), (F.col("how") != step[0]).alias("slip"))
        roots = cut(roots.join(_attach(roots, weak), "root", "left").select("value", F.coalesce("to", "root").alias("root")))
    of = roots.join(nodes, F.col("value") == F.col("id")).select("form", F.col("root").cast("string").alias("of"))
    placed = spelt.join(of, "form", "left").select("field", "value", F.coalesce("of", "form").alias("of"))
    several = placed.groupBy("of").agg(F.min("value").alias("root"), F.count("*").alias("n")).where("n > 1")
    return placed.join(several, "of").select("field", "value", "root", "n")


def variants(df: DataFrame, column: str, field: str, block: int = BLOCK, part: int = PART) -> DataFrame:
    """(value, root): the distinct spellings of ``column`` that have at least one other spelling, with their entity's lowest one.

    ``field`` is 'name' (persons) or 'affiliation'.  Null, blank and unparsable values (no word, or one without initials; no topic or place) have no
    variants; repeated rows count once; other columns are ignored.  Members of one family, different middle initials, and different countries
    or kinds of institution aren't linked.
    """
    return entities(df.select(F.lit(field).alias("field"), F.col(column).alias("value")), block, part).select("value", "root")


def pairs(roots: DataFrame) -> DataFrame:
    """(spelling_a, spelling_b), spelling_a < spelling_b by code point, of each component of ``variants`` or ``entities`` (then with the field)."""
    field = [c for c in ("field",) if c in roots.columns]
    a = roots.select(*field, "root", F.col("value").alias("spelling_a"))
    b = roots.select(*field, "root", F.col("value").alias("spelling_b"))
    return a.join(b, [*field, "root"]).where("spelling_a < spelling_b").select(*field, "spelling_a", "spelling_b")
