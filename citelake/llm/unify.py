"""One consistent form for text that looks the same but differs in characters.

Text is read by grapheme clusters: a character with the marks and invisible characters after it.  A table of rules - widths, ligatures,
spaces, invisible characters, accents, look-alike letters - is compiled from the Unicode character database and checked for conflicts;
a cluster's characters are mapped and put in canonical order, and the longest sequence with a composed form is written as that, in one
pass.  Look-alike letters depend on their word: it is held back until it ends and then settled in the script of its distinctive
letters.  ASCII text never enters Python.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters that can't be told from a Latin one, as 'Latin look-alike' pairs, by the name of their script.
LOOK_ALIKES = {
    "GREEK": "AΑ BΒ EΕ ZΖ HΗ IΙ KΚ MΜ NΝ OΟ PΡ TΤ YΥ XΧ oο vν cϲ jϳ",
    "CYRILLIC": "AА BВ EЕ KК MМ HН OО PР CС TТ XХ IІ JЈ SЅ YУ aа eе oо pр cс yу xх iі jј sѕ hһ dԁ qԛ wԝ",
    "ARMENIAN": "oօ hհ nո uս gց qզ UՍ OՕ",
    "CHEROKEE": "DᎠ RᎡ TᎢ AᎪ JᎫ EᎬ WᎳ MᎷ HᎻ ZᏃ RᏒ SᏚ VᏙ LᏞ CᏟ PᏢ KᏦ BᏴ",
    "LISU": "Bꓐ Pꓑ Dꓓ Tꓔ Gꓖ Kꓗ Jꓙ Cꓚ Zꓜ Fꓝ Mꓟ Nꓠ Lꓡ Sꓢ Rꓣ Vꓦ Hꓧ Wꓪ Xꓫ Yꓬ Aꓮ Eꓰ Iꓲ Oꓳ Uꓴ",
}
# Letters of the Latin script drawn as another one; hyphens drawn as the ASCII one; marks without width that aren't of the category Cf.
LATIN = {"ɡ": "g"}
HYPHENS = "‐‑−﹣"
INVISIBLE = "͏ᅟᅠ឴឵ㅤﾠ" + "".join(map(chr, range(0xFE00, 0xFE10)))
#: Clusters, words and sets of characters whose form is remembered.
MEMORY = 100_000


def _every() -> Iterator[str]:
    """Characters beyond ASCII in the planes that have any."""
    for cp in (*range(0x80, 0x40000), *range(0xE0000, 0xE1000)):
        if unicodedata.category(c := chr(cp)) not in ("Cn", "Co", "Cs"):
            yield c


def _rules() -> Iterator[tuple[str, str, str]]:
    """(kind, sequence, plain form), from the Unicode character database; an accent's sequence is in canonical order."""
    for c in _every():
        category, form = unicodedata.category(c), unicodedata.decomposition(c)
        letters = unicodedata.normalize("NFKC", c)
        if category in ("Zs", "Zl", "Zp") or c == "\x85":
            yield "space", c, " "
        elif category == "Cf" or c in INVISIBLE:
            yield "invisible", c, ""
        elif c in HYPHENS:
            yield "hyphen", c, "-"
        elif c in LATIN:
            yield "letter", c, LATIN[c]
        elif form.startswith(("<wide>", "<narrow>")) or 0x1D400 <= ord(c) <= 0x1D7FF or ord(c) == 0xB5:
            yield "width", c, letters
        elif form.startswith("<compat>") and (category == "Nl" or "\ufb00" <= c <= "\ufb06") and letters.isascii():
            yield "ligature", c, letters  # joined letters and Roman numerals
        elif form and form[0] != "<":
            whole, parts = unicodedata.normalize("NFC", c), unicodedata.normalize("NFD", c)
            if whole == c:
                yield "accent", parts, c
            elif len(whole) == 1:
                yield "singleton", c, whole


def compile_rules(rules: Iterator[tuple[str, str, str]]) -> dict[str, str]:
    """Sequence -> plain form.

    Conflicts raise ValueError: one sequence with two plain forms, or a plain form that a rule would change again (then
    one pass wouldn't do).
    """
    flat: dict[str, str] = {}
    for kind, seq, plain in rules:
        if flat.setdefault(seq, plain) != plain:
            raise ValueError(f"two forms for {seq!r} ({kind}): {flat[seq]!r} and {plain!r}")
    for seq, plain in flat.items():
        if any(c in flat for c in plain) or plain in flat:
            raise ValueError(f"the form of {seq!r} isn't plain: {plain!r}")
    return flat


def _extends(c: str, mapped: str) -> bool:
    """A character that belongs to the cluster before it: a mark, a vowel or final of a Hangul syllable, or one without any form."""
    first = unicodedata.normalize("NFD", mapped)[:1]
    return not first or unicodedata.category(first)[0] == "M" or "\u1160" <= first <= "\u11ff"


def _ranges(chars: list[str]) -> str:
    """Characters as the inside of a regular expression's class."""
    out: list[list[int]] = []
    for cp in sorted(map(ord, chars)):
        if out and out[-1][1] == cp - 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in out)


class Transducer:
    """Compiled rules and the look-alike letters; ``run`` gives a text's plain form."""

    def __init__(self, rules: Iterator[tuple[str, str, str]] | None = None) -> None:
        self.table = compile_rules(_rules() if rules is None else rules)
        extending = _ranges([c for c in _every() if _extends(c, self.table.get(c, c))])
        self.cluster = re.compile(f"[^{extending}][{extending}]*|[{extending}]+")
        # a part is what may belong to one word: a character beyond ASCII with the letters and digits around it
        self.part = re.compile(f"(?<![A-Za-z0-9])[A-Za-z0-9]*+(?:[\x00-\x7f](?=[{extending}]))?[^\x00-\x7f](?:[A-Za-z0-9]|[^\x00-\x7f]|[\x00-\x7f](?=[{extending}]))*")
        pairs = {s[0] + s[1]: re.findall(r"(\w)(\w)", p) for s, p in LOOK_ALIKES.items()}
        self.scripts = {"LA": "LATIN"} | {s[0] + s[1]: s for s in LOOK_ALIKES}
        self.to_latin = {s: {alike: c for c, alike in p} for s, p in pairs.items()}
        self.from_latin = {s: {v: k for k, v in m.items()} for s, m in self.to_latin.items()}
        self.known: dict[str, str] = {}  # script of a letter, '' for any other character
        self.forms: dict[str, str] = {}
        self.alones: dict[frozenset, frozenset] = {}
        self.parts: dict[tuple, str] = {}

    def script(self, c: str) -> str:
        s = self.known.get(c)
        if s is None:
            name = unicodedata.name(c, "") if c.isalpha() else ""
            s = self.known[c] = next((k for k, v in self.scripts.items() if name.startswith(v)), "")
        return s

    def settle(self, text: str, alone: frozenset[str]) -> str:
        """A word, its accents apart, with its look-alike letters in the script of its distinctive ones.

        ``alone``: scripts without any distinctive letter in the whole text; a word of nothing but look-alikes of such a script is
        Latin, but a single Greek letter is a symbol.
        """
        for s in {self.script(c) for c in text} - {"", "LA"}:
            like = self.to_latin[s]
            own = [c for c in text if self.script(c) == s]
            distinctive = any(c not in like for c in own)
            latin = [c for c in text if self.script(c) == "LA"]
            if not latin:
                if not distinctive and s in alone and {self.script(c) for c in text} - {""} == {s} and (s != "GR" or len(own) > 1):
                    text = "".join(like.get(c, c) for c in text)
            elif distinctive and all(c in self.from_latin[s] for c in latin):
                if any(c in like for c in own) or len(own) > len(latin):
                    text = "".join(self.from_latin[s].get(c, c) for c in text)
            else:
                text = "".join(like.get(c, c) for c in text)
        return text

    def form(self, cluster: str) -> str:
        """A cluster by the rules, in canonical order, accents apart."""
        got = self.forms.get(cluster)
        if got is None:
            if len(self.forms) >= MEMORY:
                self.forms.clear()
            got = self.forms[cluster] = unicodedata.normalize("NFD", "".join(self.table.get(c, c) if not c.isascii() else c for c in cluster))
        return got

    def compose(self, cluster: str) -> str:
        """The longest sequence with a composed form as that; marks that don't compose stay."""
        whole = self.table.get(cluster)
        return unicodedata.normalize("NFC", cluster) if whole is None else whole

    def run(self, text: str) -> str:
        """The plain form; ASCII text comes back as it is."""
        if text.isascii():
            return text
        alone = self.alone(frozenset(c for c in set(text) if c > "\x7f"))
        return self.part.sub(lambda m: self.memory(alone, m[0]), text)

    def alone(self, chars: frozenset[str]) -> frozenset[str]:
        """Scripts without any distinctive letter among the characters beyond ASCII of a text."""
        got = self.alones.get(chars)
        if got is None:
            if len(self.alones) >= MEMORY:
                self.alones.clear()
            letters = {x for c in chars for x in self.form(c)}
            got = frozenset(s for s, like in self.to_latin.items() if not any(self.script(c) == s and c not in like for c in letters))
            self.alones[chars] = got
        return got

    def memory(self, alone: frozenset[str], part: str) -> str:
        """The form of a part; short ones are remembered, as words come again."""
        if len(part) > 40:
            return self._part(part, alone)
        got = self.parts.get((alone, part))
        if got is None:
            if len(self.parts) >= MEMORY:
                self.parts.clear()
            got = self.parts[alone, part] = self._part(part, alone)
        return got

    def _part(self, part: str, alone: frozenset[str]) -> str:
        out: list[str] = []
        word: list[str] = []

        def settled() -> None:
            if word:
                text = self.settle("".join(word), alone)
                out.extend(map(self.compose, self.cluster.findall(text)) if not text.isascii() else [text])
                word.clear()

        for cluster in self.cluster.findall(part):
            piece = self.form(cluster) if not cluster.isascii() else cluster
            if piece and not (piece[0].isalnum() or unicodedata.combining(piece[0])):
                settled()
                out.append(self.compose(piece))
            else:
                word.append(piece)
        settled()
        return "".join(out)


_BUILT: list[Transducer] = []


def transducer() -> Transducer:
    """The transducer of all rules, compiled once on the driver and sent along with the tasks."""
    if not _BUILT:
        _BUILT.append(Transducer())
    return _BUILT[0]


def _udf(t: Transducer):
    def plain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(t.run, na_action="ignore")

    plain.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(plain, "string")


def plain_form(column: Column, t: Transducer | None = None) -> Column:
    """The column's consistent form.  NULL stays NULL, empty stays empty, ASCII values stay in the JVM."""
    odd = column.rlike(r"[^\x00-\x7F]")
    return F.coalesce(_udf(t or transducer())(F.when(odd, column)), column)


def not_plain(df: DataFrame, text: str) -> DataFrame:
    """Rows whose ``text`` isn't in its consistent form, with that form in the column ``plain``, in place of one of that name; all other columns kept.

    Null, empty and ASCII texts are plain.  Repeated rows stay repeated.
    """
    odd = df.where(F.col(text).rlike(r"[^\x00-\x7F]"))
    return odd.withColumn("plain", _udf(transducer())(F.col(text))).where(F.col(text) != F.col("plain"))
