"""Text that was read or stored under a wrong character encoding.

For every pair of encodings the garbled form of each character is computed beforehand and all forms are matched by
one automaton. Forms of several characters are proof by themselves; forms of one character only in a place where
that character cannot stand. Matched spans are replaced, everything else is left as it is.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

#: fixed values: encodings that UTF-8 is taken for, and single-byte encodings that are taken for one another
WIDE = ("cp1252", "latin-1", "iso8859-15", "cp1250", "iso8859-2", "cp1251", "mac_roman", "cp437", "cp850", "cp866", "koi8-r", "cp1253", "cp1254", "cp1257")
NARROW = (
    ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1252", "mac_roman"), ("cp1252", "cp1251"), ("cp1252", "cp1250"), ("cp1252", "koi8-r"),
    ("mac_roman", "cp1252"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("cp850", "latin-1"), ("mac_roman", "latin-1"),
)
LOST = "�"
VOWELS = frozenset("aeiouyäöüáéíóúàèìòùâêîôûãõAEIOUYÄÖÜÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÃÕ")
#: signs that stand between letters or beside them in ordinary text
ORDINARY = frozenset("'’‘-–—·.,:;/&+*=_()[]\"“”„…\xa0\xad")

#: fixed values: words by which a line shows its language, none of them in two lists
TONGUES = {
    "en": "the of and to in for was with is on it this are at from which you your our have his their not by".split(),
    "es": "el los del y las con una por su lo según también más".split(),
    "fr": "le les des du et un une au aux dans par pour sur avec est pas ne il sa ses été la l d déjà".split(),
    "de": "der die den dem und von mit ist nicht ein eine für im sich auch zu das".split(),
    "pt": "os da dos em no na um uma não ao mais foi ou pela pelo o".split(),
}
#: fixed values: letters beyond ASCII of the five languages, and which of them write the letters that other languages lack
FIVE = frozenset("àâäáãçèéêëíîïñóôöõùúûüÿœæßÀÂÄÁÃÇÈÉÊËÍÎÏÑÓÔÖÕÙÚÛÜŸŒÆẞ")
WRITE = {"ñ": "es", "ã": "pt", "õ": "pt", "à": "fr pt", "â": "fr pt", "ê": "fr pt", "ö": "de", "ü": "de es", "ä": "de"} | dict.fromkeys("èëîïùûÿœæ", "fr")
TONGUE = {w: tongue for tongue, words in TONGUES.items() for w in words}
#: fixed values: letters of Central European and Baltic languages and Turkish beyond Latin-1, by which equal readings are told apart
CENTRAL = frozenset("ąćęłńśźżčďěňřšťůžľĺŕőűășțşţđğıāēģīķļņūėįų")
LETTERS = re.compile(r"[^\W\d_]+")
LINE_END, PARAGRAPH_END = re.compile(r"[ \t\r]*(?:\n|\Z)"), re.compile(r"[ \t\r]*(?:\n[^\S\n]*(?:\n|\Z)|\Z)")


def _byte(value: int, encoding: str) -> str:
    """The character of a byte; a control character where the encoding has none."""
    try:
        return bytes([value]).decode(encoding)
    except UnicodeDecodeError:
        return chr(value)


@lru_cache(maxsize=1)
def originals() -> list[str]:
    """Characters of Western European text beyond ASCII, and of text garbled once: Latin-1 with its controls and what cp1252 adds."""
    extra = [_byte(b, "cp1252") for b in range(0x80, 0xA0)]
    return sorted({chr(c) for c in range(0x80, 0x100)} | {c for c in extra if ord(c) > 0xFF})


def beyond() -> list[str]:
    """Characters of three and four UTF-8 bytes that texts of any language hold: punctuation, currencies, letterlike signs, arrows,
    mathematics, boxes, shapes, ligatures, the byte order mark and pictures. Their forms are looked for in full, so they are proof."""
    ranges = ((0x2000, 0x206F), (0x20A0, 0x20BF), (0x2100, 0x22FF), (0x2500, 0x27BF), (0xFB00, 0xFB06), (0xFEFF, 0xFEFF), (0xFFFD, 0xFFFD), (0x1F300, 0x1FAFF))
    return [chr(c) for first, last in ranges for c in range(first, last + 1)]


@lru_cache(maxsize=1)
def _western() -> frozenset[str]:
    return frozenset(originals()) | frozenset(beyond())


@lru_cache(maxsize=1)
def continuations() -> dict[str, dict[str, int]]:
    """By encoding, the characters that its readers see for the second and later bytes of UTF-8, with the bytes."""
    return {encoding: {_byte(b, encoding): b for b in range(0x80, 0xC0)} for encoding in WIDE}


@lru_cache(maxsize=1)
def tables():
    """The automaton. Its values are a form, its kind and its ways. Kind 0: one character; ways are (original, pair of encodings). Kind 1: what UTF-8 of
    one character, of Western text or a sign, looks like; ways are (original, encoding). Kind 2: the first two characters of what UTF-8 of any
    other character looks like; ways are (first two bytes, encoding), and the rest is read with :func:`continuations`."""
    import ahocorasick

    western = sorted(_western())
    wide: dict[str, list[tuple[str, str]]] = {}
    other: dict[str, list[tuple[bytes, str]]] = {}
    for encoding in WIDE:
        for c in western:
            form = "".join(_byte(b, encoding) for b in c.encode("utf-8"))
            if form != c and not form.isascii():
                wide.setdefault(form, []).append((c, encoding))
        for lead in range(0xC2, 0xF5):
            for then in range(0x80, 0xC0):
                if _byte(lead, encoding).isspace():
                    continue  # a hard space before a letter is one
                other.setdefault(_byte(lead, encoding) + _byte(then, encoding), []).append((bytes([lead, then]), encoding))
    narrow: dict[str, list[tuple[str, str]]] = {}
    for source, read in NARROW:
        for c in originals():
            try:
                form = _byte(c.encode(source)[0], read)
            except UnicodeEncodeError:
                continue
            if form != c and not form.isascii() and (c.isalpha() or c in "’“”–—…•§€£©°º\xa0"):
                narrow.setdefault(form, []).append((c, f"{source}>{read}"))
    automaton = ahocorasick.Automaton()
    for form in {*narrow, *wide, *other}:
        automaton.add_word(form, (form, narrow.get(form), wide.get(form), other.get(form)))
    automaton.make_automaton()
    return automaton


@lru_cache(maxsize=100_000)
def _writing(c: str) -> str:
    """The script of a letter, by its name; the signs of Chinese, Japanese and Korean text count as theirs; ``""`` for other characters."""
    name = (unicodedata.name(c, "") if c else "").replace("-", " ").split(" ")[0]
    if name in ("CJK", "HIRAGANA", "KATAKANA", "IDEOGRAPHIC", "FULLWIDTH", "BOPOMOFO", "HANGUL"):
        return "HAN"
    return name if c.isalpha() else ""


def _script(c: str) -> str:
    if not c or not c.isalpha():
        return ""
    if c < "ɐ":
        return "latin"
    return "cyrillic" if "Ѐ" <= c <= "ԯ" else "greek" if "Ͱ" <= c <= "Ͽ" else "other"


def _low(c: str) -> bool:
    return _script(c) == "latin" and c.islower()


def _letter(c: str) -> bool:
    return _script(c) == "latin"


def _foreign(text: str, i: int, c: str, seen: str) -> bool:
    """Whether ``seen``, a letter that none of the five languages has, stands in a word of one that has ``c``."""
    left, right = text[i - 1 : i] if i else "", text[i + 1 : i + 2]
    if c == "ñ" and _low(left) and right and right in VOWELS:
        return True  # Polish has no ń before a vowel
    if (c == "ã" and right and right in "oe") or (c == "õ" and text[i + 1 : i + 3] == "es"):
        return _low(left)
    start = i
    while start and _letter(text[start - 1]):
        start -= 1
    # a capital may begin a name from elsewhere
    if not text[start].islower() or not (_low(left) or _low(right) or c == "à"):
        return False
    return _spoken(_line(text, i), WRITE.get(c, "es fr pt")) > 0


def _spoken(text: str, tongues: str) -> int:
    """Words of ``text`` that show one of ``tongues`` less those that show another language."""
    return sum((1 if TONGUE[w] in tongues else -1) for w in LETTERS.findall(text.lower()) if w in TONGUE)


def _hard_space(text: str, i: int, seen: str) -> bool:
    """Whether ``seen`` at ``i`` stands between two words, where a hard space was."""
    left, right = text[i - 1 : i] if i else "", text[i + 1 : i + 2]
    if not left or not right:
        return False
    if seen in "†═":
        return (left.isalnum() or left in ",.;:") and right.isalnum()
    if seen not in "áÿÊ":
        return False
    if right.isupper() or right.isdigit():
        if _low(left) and right.isdigit():
            # a note's number may follow a word that ends in á
            return seen == "Ê" or _spoken(_line(text, i), "es pt") < 0
        if left.isupper():
            return seen != "Ê" and right.isupper()
        return _low(left) or left.isdigit() or left in ",.;:>©§|"
    if left.isdigit():
        return _low(right) or right in "€£$%"
    if _low(left) and seen == "Ê":
        return True
    if not (_letter(left) and _low(right)):
        return False
    # between small letters: a run of words of which one is known
    start, stop = i, i + 1
    while start and _letter(text[start - 1]):
        start -= 1
    while stop < len(text) and _letter(text[stop]):
        stop += 1
    parts = text[start:stop].lower().split(seen.lower())
    known = [len(w) > 1 and w in TONGUE for w in parts]
    return all(parts) and ((len(parts) > 2 and any(known)) or all(known))


def _ellipsis(text: str, i: int, seen: str) -> bool:
    """Whether ``seen`` at ``i`` stands alone where no word can end a line, or where no letter can follow."""
    left, right = text[i - 1 : i] if i else "", text[i + 1 : i + 2]
    if left and left in "[(" and right and right in "])":
        return True
    if right.isalnum():
        return False
    if left.isalnum():
        return seen in "ÖÉ┘" and _low(left)
    if left and not left.isspace() or not text[text.rfind("\n", 0, i) + 1 : i].strip():
        return False
    if not LINE_END.match(text, i + 1):
        return False
    if seen in "Ö┘" or PARAGRAPH_END.match(text, i + 1):
        return True
    # French and Portuguese lines may break after the word
    return (_spoken(_line(text, i), "fr pt") or _spoken(text, "fr pt")) < 0


def _line(text: str, i: int) -> str:
    stop = text.find("\n", i)
    return text[text.rfind("\n", 0, i) + 1 : stop if stop >= 0 else len(text)]


def _narrow(text: str, i: int, c: str, seen: str) -> bool:
    """Whether ``seen`` at ``i`` cannot stand there and ``c`` can."""
    left, right = text[i - 1 : i] if i else "", text[i + 1 : i + 2]
    if 0x80 <= ord(seen) <= 0x9F:
        return _letter(left) or _letter(right)
    if c.isalpha() and c not in "ºª":
        if c.islower():
            inside = (_low(left) or _low(right)) and not (left.isalpha() and left.isupper())
        else:
            inside = (left.isalpha() and left.isupper()) or (right.isalpha() and right.isupper())
        script = _script(seen)
        if script in ("greek", "cyrillic"):
            return (_letter(left) or _letter(right)) and _script(left) != script and _script(right) != script
        if script == "latin":
            if seen.isupper() and c.islower():
                return _low(left) and left.isascii() and (_low(right) or not right.isalpha()) and text[i - 2 : i - 1].isalpha()
            if seen == "ß":
                return c.islower() and ((_low(left) and left not in VOWELS and _low(right)) or (not left.isalnum() and _low(right) and right.isascii()))
            if seen == "õ":
                return c.islower() and _low(left) and _low(right) and right != "e"
            if seen in "þð":
                return inside
            if seen.islower() and c.isupper():
                return left.isupper() and right.isupper() and left.isascii() and right.isascii()
            return seen.islower() and seen not in FIVE and c in FIVE and _foreign(text, i, c, seen)
        if seen in ORDINARY:
            return False
        category = unicodedata.category(seen)
        if category == "So" and "─" <= seen <= "▟":
            if seen in "│║":
                return _low(left) and _low(right)
            return inside and (_letter(left) or _letter(right)) and (not left or left.isspace() or _letter(left) or not left.isalnum()) and bool(right) and not ("─" <= right <= "▟")
        return _low(left) and _low(right) if c.islower() else left.isupper() and right.isupper()
    if c == "’":
        return seen == "Æ" and _letter(left) and _low(right) and (text[i - 2 : i - 1].isalpha() or not right == "t")
    if c == "—":
        return seen == "ù" and left.isspace() and right.isspace()
    if c == "–":
        return seen == "û" and ((left.isdigit() and right.isdigit()) or (left.isspace() and right.isspace()))
    if c == "•":
        return seen == "ò" and right == " " and (not left or left == "\n")
    if c == "§":
        return seen == "º" and ((right == " " and text[i + 2 : i + 3].isdigit() and (not left or left in " (\nº")) or right == "º")
    if c in "€£":
        return seen in "Çú" and right.isdigit() and not left.isalnum()
    if c == "©":
        return seen == "⌐" or (seen == "®" and bool(re.match(r" (?:19|20)\d\d\b", text[i + 1 : i + 7])) and (not left or left.isspace()))
    if c == "°":
        return seen == "░" and _letter(left)
    if c == "º":
        return seen == "║" and left in ".nN" and left != ""
    if c == "\xa0":
        return _hard_space(text, i, seen)
    return c == "…" and seen in "àÖÉ┘" and _ellipsis(text, i, seen)


QUOTED = re.compile(r"(?<!\w)ô(?=\w)[^ôö\n]{2,}(?<=\w)ö(?!\w)")


def _foreign_spans(text: str, begun: list[tuple[int, bytes, str]]) -> list[tuple[int, int, str]]:
    """Spans of UTF-8 of other scripts and of Latin letters beyond Latin-1: (start, stop, original). One encoding is taken, that which
    explains most of the text.

    A letter of another script is proof where a second of the script follows it directly; single ones count in lines with such proof. A Latin letter
    counts beside a Latin letter or another form.
    """
    western = _western()
    found: dict[str, list[tuple[int, int, str]]] = {}
    for start, data, encoding in begun:
        stop, rest = start + 2, continuations()[encoding]
        for _ in range((data[0] >= 0xE0) + (data[0] >= 0xF0)):
            byte = rest.get(text[stop : stop + 1])
            data, stop = data + bytes([byte or 0]), stop + 1
        try:
            c = data.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if _writing(c) or c in western:
            found.setdefault(encoding, []).append((start, stop, c))
    best: list[tuple[int, int, str]] = []
    weight = lambda spans: (sum(e - s for s, e, _ in spans), sum(c in western or c.lower() in CENTRAL for _, _, c in spans))
    for spans in found.values():
        spans.sort()
        spans = [s for k, s in enumerate(spans) if not k or s[0] >= spans[k - 1][1]]
        starts, stops = {s: c for s, _, c in spans}, {e: c for _, e, c in spans}
        boxed = lambda s, e: all("─" <= c <= "▟" for c in text[s:e])
        pair = lambda s, e, c: _writing(starts.get(e, "")) == _writing(c) or _writing(stops.get(s, "")) == _writing(c)
        line = lambda s: text.rfind("\n", 0, s)
        proven = {(_writing(c), line(s)) for s, e, c in spans if _writing(c) != "LATIN" and not boxed(s, e) and pair(s, e, c)}
        near = lambda s, e: (_letter(text[s - 1 : s] if s else "") or s in stops, _letter(text[e : e + 1]) or e in starts)
        inside = any(_writing(c) == "LATIN" and c not in western and all(near(s, e)) for s, e, c in spans)
        kept = []
        for s, e, c in spans:
            left, right = text[s - 1 : s] if s else "", text[e : e + 1]
            # a stretch of letters of the script that is seen which goes beyond the forms is a word
            word = any(_script(x) not in ("", "latin") and ((_script(left) == _script(x) and s not in stops) or (_script(right) == _script(x) and e not in starts)) for x in text[s:e])
            if c in western:
                kept.append((s, e, c))
            elif _writing(c) == "LATIN":
                case = (not left.isupper() or _letter(right) or e in starts) if c.islower() else not (left.isalpha() and left.islower()) and (not left.isupper() or right.isupper())
                if (any(near(s, e)) if inside or not boxed(s, s + 1) else all(near(s, e))) and case and not word:
                    kept.append((s, e, c))
            elif (_writing(c), line(s)) in proven and not word:
                kept.append((s, e, c))
        if weight(kept) > weight(best):
            best = kept
    return [span for span in best if span[2] not in western]


def _spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, str, str]], list[tuple[int, str, str]]]:
    """Wide spans (start, stop, original); strong and possible narrow places (start, original, pair)."""
    longest: dict[int, tuple[int, list]] = {}
    singles: list[tuple[int, str, list]] = []
    begun: list[tuple[int, bytes, str]] = []
    for end, (form, narrow, wide, other) in tables().iter(text):
        start = end + 1 - len(form)
        if narrow:
            singles.append((start, form, narrow))
        if wide and (start not in longest or longest[start][0] < end + 1):
            longest[start] = (end + 1, wide)
        if other:
            begun += [(start, data, encoding) for data, encoding in other]
    found, at = [], 0
    for start in sorted(longest):
        stop, ways = longest[start]
        if start >= at:
            found.append((start, stop, ways))
            at = stop
    # a form of several encodings is read in the one that explains most of the text's forms
    votes = Counter(e for _, _, ways in found for e in {e for _, e in ways})
    chosen = [(start, stop, max(ways, key=lambda w: votes[w[1]])[0]) for start, stop, ways in found]
    starts, stops = {s for s, _, _ in chosen}, {e for _, e, _ in chosen}
    wide = [s for s in chosen if _wide(text, *s, starts, stops)]
    foreign = _foreign_spans(text, begun) if begun else []
    if foreign:
        # where the two disagree, the reading of a whole word wins over that of a sign
        taken = {i for s, e, _ in foreign for i in range(s, e)}
        wide = sorted([*foreign, *(w for w in wide if taken.isdisjoint(range(w[0], w[1])))])
    covered = {i for s, e, _ in wide for i in range(s, e)}
    strong, possible = [], []
    for start, form, ways in singles:
        if start not in covered:
            for c, pair in ways:
                (strong if _narrow(text, start, c, form) else possible).append((start, c, pair))
    if "ô" in text and "ö" in text:
        for m in QUOTED.finditer(text):
            strong += [(m.start(), "“", "cp1252>cp850"), (m.end() - 1, "”", "cp1252>cp850")]
    return wide, strong, possible


def _wide(text: str, start: int, stop: int, original: str, starts: set[int], stops: set[int]) -> bool:
    left, right = text[start - 1 : start] if start else "", text[stop : stop + 1]
    form = text[start:stop]
    if any(_script(c) == "cyrillic" for c in form):
        # a stretch of Cyrillic that goes beyond garbled forms is a word
        if (_script(left) == "cyrillic" and start not in stops) or (_script(right) == "cyrillic" and stop not in starts):
            return False
        return True
    if form[0] == "Ã" and form[1:] in ("\xa0", "\xad"):
        # capitals before a hard space or a soft hyphen
        return not (left.isalpha() and left.isupper())
    if len(form) == 2 and form[0] in "ÂÃÄÅÎÐ" and form[1] in "\xa0\xad" and left.isupper():
        return False
    return True


def is_garbled(text: str | None) -> bool:
    """Whether some sequence of the text comes from a wrong encoding, restorable or not."""
    if not text or text.isascii():
        return False
    if LOST in text:
        return True
    wide, strong, _ = _spans(text)
    return bool(wide or strong)


def restored(text: str | None) -> str | None:
    """The text with its garbled spans replaced by what was written, as far as it can be told.

    Forms of several characters are undone for text garbled repeatedly; of the
    single-byte pairs the one with most proof in the text is undone first, in lines that have proof of it; until nothing is
    left or a text comes again. Characters already lost stay as they are.
    """
    if not text or text.isascii():
        return text
    seen: set[str] = set()
    while text not in seen:
        seen.add(text)
        wide, strong, possible = _spans(text)
        if wide:
            out, at = [], 0
            for start, stop, original in wide:
                out += [text[at:start], original]
                at = stop
            text = "".join(out) + text[at:]
            continue
        if strong:
            pair = max(sorted(Counter(p for _, _, p in strong).items()), key=lambda x: x[1])[0]
            line = lambda i: text.count("\n", 0, i)
            lines = {line(i) for i, _, p in strong if p == pair}
            put = {i: c for i, c, p in possible if p == pair and line(i) in lines} | {i: c for i, c, p in strong if p == pair}
            text = "".join(put.get(i, c) for i, c in enumerate(text))
            continue
        break
    return text


@F.pandas_udf(BooleanType())
def garbled_udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([is_garbled(t) for t in batch], dtype=bool)


@F.pandas_udf(StringType())
def restored_udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([restored(t) for t in batch], dtype=object)


def _beyond_ascii(text: Column) -> Column:
    return F.length(text) < F.octet_length(text)


def garbled_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` with at least one garbled sequence. Null, empty and ASCII texts have none and never leave the JVM."""
    return docs.filter(_beyond_ascii(F.col(text))).filter(garbled_udf.asNondeterministic()(text))  # stays where it is in the plan


def restored_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The garbled rows with ``restored`` and ``complete``: whether nothing garbled is left in it."""
    fixed = garbled_documents(docs, text).withColumn("restored", restored_udf(text))
    return fixed.withColumn("complete", ~garbled_udf("restored"))
