"""Name variants: pair rules by hand, and whole small tables."""

import random

import pytest
from citelake.llm import names as N


def same(a, b):
    return N.same_person(N.person(a), N.person(b))


@pytest.mark.parametrize("a,b,how", [
    ("Ada Lovelocke", "Lovelocke, Ada", N.SURE), ("Ada Lovelocke", "LOVELOCKE Ada", N.SURE), ("Ada Lovelocke", "Dr Ada Lovelocke, MD", N.SURE), ("Ada Lóvelocke", "ada lovelocke", N.SURE),
    ("Ada Lovelocke", "Ada Lovlocke", N.SURE), ("Ada Lovelocke", "Ada Lvoelocke", N.SURE), ("Robert Lovelocke", "Bob Lovelocke", N.SURE), ("Ada M Lovelocke", "Ada Lovelocke  M", N.SURE),
    ("Ada M Lovelocke", "Ada Lovelocke", N.NO_MIDDLE), ("Ada Lovelocke", "A. Lovelocke", N.INITIAL), ("Ada M Lovelocke", "Lovelocke AM", N.INITIAL), ("Edward Lovelocke", "Ted Lovelocke", N.SHORT),
    ("Robert Lovelocke", "Bob Lovelokce", N.SHORT_SLIP), ("Bob Lovelocke", "Bob Lovelokce", N.SURE), ("Ada Lovelocke", "A. Lovelokce", N.INITIAL_SLIP), ("Ada M Lovelocke", "Ada K Lovelocke", N.NO), ("Ada Lovelocke", "Bea Lovelocke", N.NO), ("Ada M Lovelocke", "A. K. Lovelocke", N.NO),
    ("Ada Lovelocke", "Adda Lovlocke", N.NO), ("Ada Lovelocke", "B. Lovelocke", N.NO), ("Viktor Lovelocke", "Victoria Lovelocke", N.NO),
])
def test_persons(a, b, how):
    assert same(a, b) == how == same(b, a)


def test_odd_names():
    assert N.person("") is None and N.person(" . ,") is None and N.person("42") is None
    assert N.person("Fokogimli MD") == (("fokogimli",), ("m", "d")) and N.person("Ada Fokogimli MD") == (("ada", "fokogimli"), ())
    assert N.person("Mary Ann van Dale")[0] == ("annvandale", "mary")
    assert N.lcs("abcde", "ace") == 3 and N.lcs("", "a") == 0 and N.ratio("", "") == 1.0 and N.near("abc", "abd") and not N.near("ab", "ac")


def dept(a, b):
    return N.same_department(N.department(a), N.department(b)) == N.SURE


BASE = "Department of Hearing and Balance, Bavis Institute of Technology, Bavis, Norland."


@pytest.mark.parametrize("other,yes", [
    ("DEPARTMENT OF HEARING AND BALANCE, BAVIS INSTITUTE OF TECHNOLOGY", True), ("Technology Institute of Bavis, Dept of Hearing & Balance, Bavis 12345.", True), ("Dep. Hear. and Bal., Bavis Inst. Technol., Norland", True),
    ("Hearing and Balance Unit; Bavsi Institute of Technology; Bavis", True), ("Department of Haering and Balance,Bavis Institute of Technology", True), ("Department of Hearing and Balance, Bavis Medical School, Bavis, Norland.", False),
    ("Department of Sleep Research, Bavis Institute of Technology, Bavis, Norland.", False), ("Department of Hearing and Balance, Lomas Institute of Technology, Lomas, Norland.", False),
    ("Department of Hearing and Balance, Bavis Institute of Technology, Bavis, Velland.", False),
])
def test_departments(other, yes):
    assert dept(BASE, other) == yes == dept(other, BASE)
    assert N.department("") is None and N.department("Norland") is None


def run(spark, values, field, block=N.BLOCK, part=N.PART):
    df = spark.createDataFrame([(v, 1) for v in values], "v string, root int")
    return {tuple(r) for r in N.pairs(N.variants(df, "v", field, block, part)).collect()}


def test_families_initials_and_ambiguity(spark):
    one = ["Ada M Lovelocke", "Lovelocke, Ada M.", "Ada Lovelocke", "A. Lovelocke", "Ada M Lovelokce"]
    two = ["Bruno Lovelocke", "Benno Lovelocke", "B. Lovelocke"]  # which B. is unknown
    got = run(spark, [*one, *two, *one, None, "", "  ", "?!", "Solo"], "name")
    assert got == {(a, b) for a in one for b in one if a < b}
    assert run(spark, [], "name") == set() and run(spark, [None, ""], "affiliation") == set()


def test_short_forms_join_the_only_fit(spark):
    got = run(spark, ["Edward Kunvimod", "Ted Kunvimod", "E. Kunvimod", "Edward Tolsuder", "Theodore Tolsuder", "Ted Tolsuder"], "name")
    assert got == {("E. Kunvimod", "Edward Kunvimod"), ("E. Kunvimod", "Ted Kunvimod"), ("Edward Kunvimod", "Ted Kunvimod")}


def found(spark, values, field, block, part=N.PART):
    df = spark.createDataFrame([(field, v) for v in values], "field string, value string")
    links = N._compare(N._blocks(N.forms(df), block, part))
    return {tuple(sorted(r[:2])): r["how"] for r in links.collect()}


def all_pairs(values, field):
    """Every two forms compared."""
    f = N.FIELDS[field]
    written = {field[0] + f.write(p): p for v in values if (p := f.parse(v))}
    rows = sorted(written.items())
    return {(a, b): h for i, (a, p) in enumerate(rows) for b, q in rows[i + 1:] if (h := f.same(p, q))}


def form(field, value):
    return field[0] + N.FIELDS[field].write(N.FIELDS[field].parse(value))


SIZES = [(3, 2), (3, N.PART), (N.BLOCK, N.PART)]


@pytest.mark.parametrize("block,part", SIZES)
def test_two_hundred_spellings_of_one_family(spark, block, part):
    """Slips in given and family names, initials and short forms among many given names: the links that comparing every two forms gives."""
    rng = random.Random(4)
    syllables = "ba ve ko lu mi ra so te".split()
    given = {"".join(rng.choice(syllables) for _ in range(rng.choice([1, 2, 3]))).title() for _ in range(60)} | {"Robert", "Bob", "Edward", "Ted", "Juan", "Jaun", "Ida", "Ada", "Lena", "Lana"}
    values = {f"{g} Wongari" for g in given} | {f"Wongari, {g} {rng.choice('KLM')}" for g in given}
    for g in sorted(given):
        i = rng.randrange(len(g))
        values |= {f"{g[:i]}{g[i + 1:]} Wongari", f"{g} Wongai", f"{g[0]}. Wongari", f"{g[0]} Wnogari"}
    expected = all_pairs(values, "name")
    assert len({v for v in values}) > 200 and tuple(sorted((form("name", "Juan Wongari"), form("name", "Jaun Wongari")))) in expected
    assert found(spark, values, "name", block, part) == expected


@pytest.mark.parametrize("block,part", SIZES)
def test_short_tokens_and_initials_in_large_blocks(spark, block, part):
    """Links of every kind, whatever the size of their blocks."""
    values = {"Anna Lee", "Ana Lee", "Lee, Anna", "A Lee", "John B Smith", "Smith JB", "J. Smith", "John B Smiht", "Smith J", "Ingrid Norman", "Ingrid Nomran", "Nomran I",
              "Robert Norman", "Bob Nomran", "B. Norman", "Bob Norman", "R Nomran", "Ed Li", "Edward Li", "Ted Li", "Edward Lii", "Ana Ana", "Anna Ana", "Yara Abcdefgh", "Yara Bcdefgha", "Yaar Abcdefgh"}
    values |= {f"{a}{b}{a} Lee" for a in "Bacodefi" for b in "klmrstvwx"} | {f"J{c}hn Smith" for c in "abcdefghijklmn"} | {f"{c}{d}vi Smith" for c in "BCDFG" for d in "aeiouy" for _ in "x"}
    expected = all_pairs(values, "name")
    some = [("Ana Lee", "Anna Lee"), ("John B Smith", "Smith JB"), ("Ingrid Nomran", "Ingrid Norman"), ("Bob Nomran", "Robert Norman")]
    assert {tuple(sorted(form("name", v) for v in pair)) for pair in some} <= set(expected)
    assert found(spark, values, "name", block, part) == expected


def test_topics_in_large_blocks(spark):
    """Departments of one place: abbreviated topics and topics with a slip meet in split blocks."""
    topics = ["Health Science", "Hea Sci", "Heatlh Science", "Heart Care", "Heat Research", "Hearing and Balance", "Hear and Bal", "Hearing and Balanec", "Heavy Metals", "Headache"]
    values = {f"Department of {t}, Bavistown Institute of Technology, {c}" for t in topics for c in ("Norland", "Velland")}
    expected = all_pairs(values, "affiliation")
    for size in SIZES:
        assert expected and found(spark, values, "affiliation", *size) == expected


@pytest.mark.parametrize("block,part", SIZES)
def test_departments_of_short_places(spark, block, part):
    """Slips in the middle of short places and topics abbreviated at both ends, whatever the size of the blocks."""
    values = {f"Department of {t}, University of {p}, {p}" for p in ("Paris", "Pais", "Oxford", "Oxofrd", "Oxfords") for t in ("Health Science", "Hlth Sci", "Heatlh Science", "Surgery", "Sugrery", "Srg")}
    values |= {f"Department of Surgery, {p} Medical School, Norland" for p in ("Paris", "Pairs", "Praise")}
    expected = all_pairs(values, "affiliation")
    paris, hlth = "Department of Surgery, University of Paris, Paris", "Department of Hlth Sci, University of Paris, Paris"
    for a, b in ((paris, paris.replace("Paris", "Pais")), (hlth, hlth.replace("Hlth Sci", "Health Science"))):
        assert tuple(sorted((form("affiliation", a), form("affiliation", b)))) in expected
    assert found(spark, values, "affiliation", block, part) == expected


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(60)] + [("x", "y"), ("y", "x"), ("z", "z")], "a string, b string")
    got = {r["value"]: r["root"] for r in N.components(links).collect()}
    assert set(got) == {f"{i:03d}" for i in range(61)} | {"x", "y"} and {got[f"{i:03d}"] for i in range(61)} == {"000"} and got["y"] == "x"
    assert N.components(links.limit(0)).count() == 0


def invented(rng, n_families, n_departments):
    """(spelling, entity) of persons and departments made up of syllables: reordered, in capitals, with titles, accents, initials, short forms and slips; several
    persons share each family name."""
    syllables = [c + v for c in "bdfgklmnprstvz" for v in "aeiou"]
    word = lambda n: "".join(rng.choice(syllables) for _ in range(n)).title()
    accents = str.maketrans("aeou", "áèöû")

    def slip(w):
        i = rng.randrange(1, len(w) - 1)
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + rng.choice("aeirst") + w[i:], w[:i] + rng.choice("bcdgkm") + w[i + 1 :]])

    people, places = [], []
    short = [line.split() for line in N.SHORT_FORMS.replace("\n", " ").split(";")]
    for f in range(n_families):
        family, initials = word(rng.choice([3, 4])), set()
        for _ in range(3):
            formal, *nick = rng.choice(short) if rng.random() < 0.3 else [word(3).lower()]
            given = formal.title()
            if given[0] in initials:
                continue  # two of one family with one initial can't be told apart by it
            initials.add(given[0])
            forms = [f"{given} {family}", f"{family}, {given}", f"{family.upper()} {given}", f"Dr {given} {family}", f"{given} {family}, MD", f"{given} {slip(family)}", f"{slip(given)} {family}",
                     f"{given[0]}. {family}", f"{family} {given[0]}", f"{given} {family}".translate(accents), *(f"{x.title()} {family}" for x in nick[:1])]
            people += [(x, (f, given)) for x in rng.sample(forms, 5)]
    kinds = [("University", "Univ."), ("Medical School", "Med Sch"), ("Institute of Technology", "Inst. of Technol.")]
    for d in range(n_departments):
        place, country = word(4), word(3) + "land"
        for topic in (f"{word(4)} {word(3)}", f"{word(3)} and {word(4)}"):
            kind, abbreviated = rng.choice(kinds)
            forms = [f"Department of {topic}, {place} {kind}, {place}, {country}.", f"Dept. of {topic}; {place} {abbreviated}, {country}", f"{place} {kind}, Department of {topic}, {place}", f"DEPARTMENT OF {topic.upper()}, {place.upper()} {kind.upper()}",
                     f"Department of {slip(topic)}, {place} {kind}, {country}", f"Dep of {topic}, {slip(place)} {abbreviated}", f"Unit of {topic.replace(' and ', ' & ')}, {place} {kind}, 12345 {place}"]
            places += [(x, (d, topic)) for x in rng.sample(forms, 4)]
    return people, places


def test_recall_and_precision_on_invented_spellings(spark):
    rng = random.Random(11)
    people, places = invented(rng, 120, 60)
    values = [("name", v) for v, _ in people] + [("affiliation", v) for v, _ in places]
    got = {(r["field"], r["spelling_a"], r["spelling_b"]) for r in N.pairs(N.entities(spark.createDataFrame(values, "field string, value string"))).collect()}
    for field, rows in (("name", people), ("affiliation", places)):
        entity = {}
        for v, e in rows:
            entity.setdefault(v, set()).add(e)
        true = {(field, a, b) for a in entity for b in entity if a < b and entity[a] & entity[b]}
        mine = {p for p in got if p[0] == field}
        recall, precision = len(true & mine) / len(true), len(true & mine) / len(mine)
        print(field, len(true), "pairs, recall", round(recall, 3), "precision", round(precision, 3))
        assert recall > 0.95 and precision > 0.99
