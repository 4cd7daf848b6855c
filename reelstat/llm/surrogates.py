"""Personal data replaced by surrogates.

Detected entities get keyed replacements of their own type: the same length and kinds of characters,
valid checksums, and for names the same gender and script. One entity gets the same surrogate
wherever it occurs and however it is written, so references still agree; a check over all entities
keeps surrogates apart from each other and from every original.

1. Each text's entities are found; their distinct (type, value) pairs form a distributed table.
2. A surrogate follows from the key, the pair and a number of the attempt. Pairs whose surrogate
   another pair has, or whose surrogate is an original, go on to their next attempt until none is left.
3. Texts are rewritten. A first attempt follows from the pair alone; only texts that hold a pair with
   a later attempt are joined with it.

Defined results: a null or empty text stays as it is and has no entity; rows with a null id are
rewritten like others; equal rows get equal results; an empty table gives an empty one; where matches
overlap the first, then the longer one counts; of an assignment (``token = "..."``) the value alone is
replaced, as the type that it has as a whole or else as a secret; columns other than id and text are passed through
untouched by ``anonymize`` and not read by ``surrogates``.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import map_arrow
from reelstat.session import written

#: Rounds that may settle nothing before a job gives up. Forms get longer with the attempts, so only a
#: type whose values are used up altogether comes to that.
IDLE = 64

_WORD = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
#: Titles and the gender they tell, in several languages; fixed values.
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Signor", "г-н", "господин", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Doña", "Signora", "г-жа", "госпожа", "κυρία"],
    "n": ["Dr", "Prof", "Professor"],
}
#: Common given names that start a name without a title; fixed values.
GIVEN = {
    "m": "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Paul Peter Hans Karl Stefan Wolfgang Jürgen Pierre Jean Michel François Louis Carlos José Juan Luis Miguel Antonio Иван Сергей Алексей Дмитрий Γιώργος Νίκος".split(),
    "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Anna Emma Julia Petra Sabine Ursula Monika Marie Claire Sophie Camille Isabelle Carmen María Lucía Elena Ana Анна Мария Ольга Елена Μαρία Ελένη".split(),
}
#: Labels and closings that a name follows; fixed values.
LABELS = [
    "Name", "Full name", "Contact", "Author", "Signed", "Attn", "Applicant", "Patient", "Kontakt",
    "Ansprechpartner", "Ansprechpartnerin", "Unterzeichnet", "Nom", "Auteur", "Signé", "Nombre",
    "Contacto", "Autor", "Firmado",
]
CLOSINGS = [
    "Regards", "Kind regards", "Best regards", "Sincerely", "Yours sincerely", "Best wishes",
    "Mit freundlichen Grüßen", "Viele Grüße", "Cordialement", "Bien à vous", "Saludos",
    "Un saludo", "Atentamente",
]
#: Words before a date of birth; fixed values.
BORN = [
    "born", "born on", "date of birth", "dob", "geboren", "geboren am", "geb.", "geburtsdatum", "né le",
    "née le", "date de naissance", "nacido el", "nacida el", "fecha de nacimiento",
]
#: Syllables that surrogate names are made of, by script, and endings of given names by gender.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi wa za zo".split(),
    "cyrillic": "ба бе бо ва ве во да де до за зо ка ко ла ле ли ло ма ме ми мо на не ни но па пе по ра ре ри ро са се си со та те ти то".split(),
    "greek": "βα βε βο γα γε γο δα δε δο ζα ζο κα κε κο λα λε λι λο μα με μι μο να νε νι νο πα πε πο ρα ρε ρι ρο σα σε σι σο τα τε τι το".split(),
}
ENDINGS = {
    "latin": {"m": ["n", "r", "s", "l"], "f": ["a", "ia", "ine", "elle"], "n": ["n", "l"], "s": ["n", "r", "nd", "ck"]},
    "cyrillic": {"m": ["н", "р", "й"], "f": ["а", "ия"], "n": ["н"], "s": ["нов", "рин", "ко"]},
    "greek": {"m": ["ς", "ρος"], "f": ["α", "ια"], "n": ["ς"], "s": ["ίδης", "άκης"]},
}

PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "secret": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\bgh[pousr]_[A-Za-z0-9]{20,}|\bsk-[A-Za-z0-9_-]{16,}"
              r"|\bxox[abprs]-[A-Za-z0-9-]{10,}|\bAIza[A-Za-z0-9_-]{30,}"
              r"|\beyJ[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]{4,}){1,2}",
    "keyed": r"(?P<word>(?:(?<![A-Za-z])(?i:(?:api|auth|access|client|private|secret|signing)[_-]?)?"
             r"(?i:token|key|secret|passw(?:or)?d|passphrase|pwd)|(?<=[a-z])(?:Token|Key|Secret|Password)))"
             r"[\"']?\s{0,3}(?P<sign>=>|:=|[=:](?!=))\s{0,3}"
             r"(?:\"(?P<double>[^\"\s]{4,})\"|'(?P<single>[^'\s]{4,})'"
             r"|(?P<bare>[^\s\"'`,;&<>()\[\]{}]{3,}[^\s\"'`,;&<>()\[\]{}.!?:]))",
    "long": r"(?<![\w+/=-])(?=[0-9a-fA-F]*\d)(?=\d*[a-fA-F])[0-9a-fA-F]{32,}(?![\w+/])"
            r"|(?<![\w+/=.:%&?#@-])[A-Za-z0-9+/_-]{40,}={0,2}(?![\w+/])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)",
    "ipv6": r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:]|\.\d)",
    "dob": r"(?i:\b(?:" + "|".join(re.escape(x) for x in sorted(BORN, key=len, reverse=True))
           + r"))\s{0,2}:?\s{1,2}(?P<date>\d{1,2}(?P<mark>[./-])\d{1,2}(?P=mark)(?:19|20)\d\d|(?:19|20)\d\d-\d\d-\d\d)(?!\d)",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)"
             r"|(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?[1-9]|0[1-9])"
             r"(?:(?: \d\d){4}(?! ?\d)|(?:\.\d\d){4}(?!\.?\d)|(?:-\d\d){4}(?!-?\d))"
             r"|(?<![\w+])0\d{2,4}[ /-]\d{6,8}(?![\d-])"
             r"|(?<![\w+])\+\d{8,14}(?!\d)",
    "name": r"\b(?P<title>" + "|".join(x for v in TITLES.values() for x in v) + r")\b\.?\s(?P<titled>"
            + _WORD + r"(?:\s" + _WORD + r")?)|\b(?P<given>" + "|".join(x for v in GIVEN.values() for x in v)
            + r")\s(?P<family>" + _WORD + r")\b|(?:\b(?:" + "|".join(LABELS) + r")\s?:[ \t]?|\b(?:"
            + "|".join(CLOSINGS) + r"),?\s{1,3})(?P<labelled>" + _WORD + r"(?:[ \t]" + _WORD + r"){1,2})",
}
_FIRST = {k: r"(?=[\d(+])" for k in ("ip", "card", "ssn", "phone")}
_DIGIT, _IBAN, _LETTERS = re.compile(r"\d"), re.compile(r"[A-Z]{2}\d\d"), re.compile(r"[^\W\d_]+")
_SECRETS = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xox", "AIza", "eyJ")
_KEYS = ("token", "key", "secret", "passw", "passphrase", "pwd")
_HEX = re.compile(r"[0-9a-fA-F]{32,}")
_PAIRS = re.compile(r"(?:[ .-]\d\d){4}$")
_NAME_WORDS = frozenset(x for v in [*TITLES.values(), *GIVEN.values()] for x in v) | {"г", "н", "жа"}
_NAME_WORDS |= {x.split()[-1] for x in LABELS + CLOSINGS}
_BORN = re.compile("|".join(re.escape(x) for x in BORN), re.IGNORECASE)


_COMPILED: dict[tuple[str, ...], re.Pattern] = {}


def _pattern(kinds: tuple[str, ...]) -> re.Pattern:
    if kinds not in _COMPILED:
        parts = (f"(?P<{k}>{_FIRST.get(k, '')}(?:{PATTERNS[k]}))" for k in kinds)
        _COMPILED[kinds] = re.compile("|".join(parts))
    return _COMPILED[kinds]


def _possible(text: str) -> tuple[str, ...]:
    """The types that a text can hold at all, by marks that are quickly looked for."""
    digit = _DIGIT.search(text) is not None
    lowered = text.lower() if "=" in text or ":" in text else ""
    marks = {
        "email": "@" in text, "secret": any(x in text for x in _SECRETS),
        "keyed": any(x in lowered for x in _KEYS),
        "long": digit and max(map(len, text.split()), default=0) >= 32,
        "ipv6": "::" in text or text.count(":") >= 7,
        "iban": digit and _IBAN.search(text) is not None,
        "dob": digit and _BORN.search(text) is not None,
        "ip": digit, "card": digit, "ssn": digit, "phone": digit,
        "name": not _NAME_WORDS.isdisjoint(_LETTERS.findall(text)),
    }
    return tuple(k for k in PATTERNS if marks[k])


_GENDER = {x: k for k, v in TITLES.items() for x in v}
_GIVEN = {x: k for k, v in GIVEN.items() for x in v}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def script_of(word: str) -> str:
    for c in word:
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
        if "Ͱ" <= c <= "Ͽ":
            return "greek"
    return "latin"


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Entities in order: start, end, type and value. Values do not depend on how they are written."""
    out = []
    at = 0
    kinds = _possible(text)
    if not kinds:
        return out
    pattern = _pattern(kinds)
    while match := pattern.search(text, at):
        start, end = match.start(), match.end()
        kind = next(k for k in kinds if match[k] is not None)
        at = end
        found = match[0]
        digits = re.sub(r"\D", "", found)
        if kind == "email":
            out.append((start, end, kind, found.lower()))
        elif kind == "keyed":
            if span := _assigned(match):
                value = text[span[0] : span[1]]
                inner = find(value)
                whole = len(inner) == 1 and inner[0][:2] == (0, len(value))
                out.append((*span, *(inner[0][2:] if whole else ("secret", value))))
                at = span[1]
            else:
                at = start + 1
        elif kind == "long":
            if _random(found):
                out.append((start, end, "secret", found))
        elif kind == "ipv6":
            if value := _ipv6(found):
                out.append((start, end, kind, value))
            else:
                at = start + 1
        elif kind == "dob":
            out.append((*match.span("date"), kind, match["date"]))
        elif kind == "secret" or kind == "ip":
            out.append((start, end, kind, found))
        elif kind == "iban":
            if mod97(found.replace(" ", "")) == 1:
                out.append((start, end, kind, found.replace(" ", "")))
            else:
                at = start + 2
        elif kind == "card":
            if luhn(digits):
                out.append((start, end, kind, digits))
            elif match := re.compile(PATTERNS["phone"]).match(text, start):
                at = match.end()
                out.append((start, at, "phone", _national(match[0])))
            else:
                at = end
        elif kind == "ssn":
            out.append((start, end, kind, digits))
        elif kind == "phone":
            if 8 <= len(digits) <= 15:
                out.append((start, end, kind, _national(found)))
        else:
            out += _names(match)
            at = out[-1][1] if out and out[-1][1] > start else start + 1
    return out


def _national(found: str) -> str:
    """A number without its country code, of ten digits at most; one in pairs without its first 0."""
    digits = re.sub(r"\D", "", found)
    return digits[-9:] if _PAIRS.search(found) else digits[-10:]


def _assigned(match: re.Match) -> tuple[int, int] | None:
    """Where the value of an assignment stands, if it looks like a secret. Words that also name other
    things (key, token) and values without quotes need more marks than passwords do."""
    group = next(k for k in ("double", "single", "bare") if match[k] is not None)
    value = match[group]
    digit, letter = any(map(str.isdigit, value)), any(map(str.isalpha, value))
    if not digit and not letter:
        return None
    open_colon = group == "bare" and match["sign"] == ":"
    if match["word"].lower().endswith(("key", "token")):
        good = digit and len(value) >= 6 or len(value) >= 16
        good = good and (not open_colon or digit and letter)
    else:
        good = not open_colon or not value.isalpha()
    return match.span(group) if good else None


def _random(found: str) -> bool:
    """Whether a long string is hexadecimal or changes between kinds of characters as base64 does."""
    if _HEX.fullmatch(found):
        return True
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "" for c in found]
    changes = sum(a != b and bool(a and b) for a, b in zip(kinds, kinds[1:]))
    return {"d", "u", "l"} <= {*kinds} and 4 * changes >= len(found)


def _ipv6(found: str) -> str | None:
    """The address with all its digits; one of a single group is not taken."""
    if sum(map(bool, found.split(":"))) < 2 or not _DIGIT.search(found):
        return None
    try:
        return ipaddress.IPv6Address(found).exploded
    except ValueError:
        return None


def _names(match: re.Match) -> Iterator[tuple[int, int, str, str]]:
    """The given and the family name, each an entity of its own, so that both forms agree."""
    out = []
    if match["given"] is not None:
        if not match["family"][0].isupper():
            return out
        words = [(match.start("given"), match["given"]), (match.start("family"), match["family"])]
        gender = _GIVEN[match["given"]]
    elif match["labelled"] is not None:
        words = [(match.start("labelled") + x.start(), x[0]) for x in re.finditer(_WORD, match["labelled"])]
        capital = [x for x in words if x[1][0].isupper()]
        if len(capital) < 2 or words[: len(capital)] != capital:
            return out
        words, gender = capital, _GIVEN.get(capital[0][1], "n")
    else:
        words = [(match.start("titled") + x.start(), x[0]) for x in re.finditer(_WORD, match["titled"])]
        words = [words[0]] + [x for x in words[1:] if x[1][0].isupper()]
        if not words[0][1][0].isupper():
            return out
        gender = _GENDER[match["title"]]
    for k, (start, word) in enumerate(words):
        kind = f"given_{gender}" if k < len(words) - 1 else "family"
        out.append((start, start + len(word), kind, word.casefold()))
    return out


def _bits(key: bytes, kind: str, value: str, attempt: int, size: int) -> int:
    found, block = b"", 0
    while len(found) < size:
        message = f"{kind}\0{value}\0{attempt}\0{block}".encode()
        found += hmac.new(key, message, hashlib.sha256).digest()
        block += 1
    return int.from_bytes(found[:size], "big")


class Draw:
    """Choices that follow from a key and an entity."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.rest = _bits(key, kind, value, attempt, 16 + 2 * len(value))

    def of(self, n: int) -> int:
        self.rest, found = divmod(self.rest, n)
        return found

    def like(self, text: str, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
        """Characters of the same kinds."""
        out = []
        for c in text:
            if c.isdigit():
                out.append("0123456789"[self.of(10)])
            elif c.isascii() and c.isalpha():
                letter = letters[self.of(len(letters))]
                out.append(letter.upper() if c.isupper() else letter)
            elif c.isalpha():
                out.append(letters[self.of(len(letters))])
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The replacement of an entity's value, of the same type and form."""
    draw = Draw(key, kind, value, attempt)
    if kind == "email":
        local, _, domain = value.partition("@")
        *labels, top = domain.split(".")
        # A domain has the same surrogate in all addresses.
        other = Draw(key, "domain", domain, 0)
        new = draw.like(local) + draw.like("a0" * (attempt // 4))
        return f"{new}@{'.'.join([*map(other.like, labels), top])}"
    if kind == "ip":
        return _address(value, draw, attempt)
    if kind == "dob":
        return _date(value, draw)
    if kind == "ipv6":
        groups = []
        for k, group in enumerate(value.split(":")):
            # Groups of 0 stay, and so does the first digit, which tells the kind of address.
            size = 4 if attempt >= 4 else len(group.lstrip("0"))
            kept = group.lstrip("0")[:1] if k == 0 else ""
            new = kept + "".join("123456789abcdef"[draw.of(15)] for _ in range(size - len(kept)))
            open_group = int(group, 16) or attempt >= 16 and k >= 4
            groups.append(new[:4].rjust(4, "0") if open_group else "0000")
        return ":".join(groups)
    if kind == "card":
        body = value[0] + draw.like(value[1:-1])
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "iban":
        body = draw.like(value[4:])
        return f"{value[:2]}{98 - mod97(value[:2] + '00' + body):02d}{body}"
    if kind == "ssn":
        return f"9{draw.like(value[1:])}"
    if kind == "secret":
        prefix = re.match(r"(?:AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-|AIza|eyJ)?", value)[0]
        prefix = prefix if len(value) >= len(prefix) + 8 else ""
        # Short values have few others of their form; later attempts are longer.
        rest = value[len(prefix):] + "a0" * (attempt // 4)
        return prefix + (draw.like(rest, "abcdef") if _HEX.fullmatch(value) else draw.like(rest))
    if kind == "phone":
        # No number begins with 0 where the original does not.
        first = value[:1] if value[:1] == "0" else "123456789"[draw.of(9)]
        return first + draw.like(value[1:])
    script = script_of(value)
    part = "s" if kind == "family" else kind[-1]
    syllables, endings = SYLLABLES[script], ENDINGS[script][part]
    word = "".join(syllables[draw.of(len(syllables))] for _ in range(3 if part == "s" else 2))
    # More names where the shorter ones are taken.
    word += "".join(syllables[draw.of(len(syllables))] for _ in range(attempt // 4))
    return word + endings[draw.of(len(endings))]


#: Private, local and shared ranges, by their first numbers; fixed values.
_RANGES = [(10,), (127,), (169, 254), (192, 168), *((172, k) for k in range(16, 32)), *((100, k) for k in range(64, 128))]


def _range_of(numbers: tuple[int, ...]) -> tuple[int, ...] | None:
    return next((x for x in _RANGES if numbers[: len(x)] == x), None)


def _address(value: str, draw: Draw, attempt: int) -> str:
    """An address of the same kind: one of a private range stays in it, in the widest one if it is
    nearly used up, and others lie in none."""
    own = _range_of(tuple(map(int, value.split("."))))
    if own is None:
        while True:
            numbers = tuple(1 + draw.of(223 if k == 0 else 254) for k in range(4))
            if _range_of(numbers) is None:
                return ".".join(map(str, numbers))
            draw = Draw(b"again", "ip", f"{numbers}", attempt)
    if attempt >= 16:
        own = (10,)
    return ".".join(map(str, [*own, *(1 + draw.of(254) for _ in range(4 - len(own)))]))


def _date(value: str, draw: Draw) -> str:
    """A date in the same form. Days are no later than the 12th, so it is one in either order."""
    parts = [f"{1930 + draw.of(80)}" if len(x) == 4 else f"{1 + draw.of(9 if len(x) == 1 else 12):0{len(x)}d}" for x in re.findall(r"\d+", value)]
    marks = re.findall(r"\D", value)
    return parts[0] + marks[0] + parts[1] + marks[1] + parts[2]


def written_as(found: str, kind: str, value: str, other: str) -> str:
    """A surrogate in the form in which the original stood: separators, prefix, case."""
    if kind in ("card", "ssn", "iban", "phone"):
        out, k = [], len(other)
        for c in reversed(found):
            if c.isalnum() and k:
                k -= 1
                out.append(other[k])
            else:
                out.append(c)
        return "".join(reversed(out))
    if kind == "email":
        same = [b.upper() if a.isupper() else b for a, b in zip(found, other)]
        return "".join(same) + other[len(found):]
    if kind == "ipv6":
        if "::" in found:
            new = ipaddress.IPv6Address(other).compressed
        else:
            pairs = zip(found.split(":"), other.split(":"))
            new = ":".join(b if len(a) == 4 else b.lstrip("0") or "0" for a, b in pairs)
        return new.upper() if found.upper() == found and found.lower() != found else new
    if kind == "family" or kind.startswith("given"):
        return other.upper() if found.isupper() and len(found) > 1 else other[:1].upper() + other[1:]
    return other


def rewrite(text: str, key: bytes, later: dict[tuple[str, str], int]) -> tuple[str, int]:
    """The text with all entities replaced, and their number."""
    out, at, n = [], 0, 0
    for start, end, kind, value in find(text):
        other = surrogate(key, kind, value, later.get((kind, value), 0))
        out += [text[at:start], written_as(text[start:end], kind, value, other)]
        at, n = end, n + 1
    return "".join([*out, text[at:]]), n


def entities(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, kind, value, times): the distinct entities of each text."""

    def rows(batch: pa.RecordBatch) -> dict:
        ids, kinds, values = [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            for kind, value in sorted({x[2:] for x in find(text or "")}):
                ids.append(i)
                kinds.append(kind)
                values.append(value)
        if not ids:
            return []
        return {
            "id": batch.column(0).take(pa.array(ids)), "kind": pa.array(kinds), "value": pa.array(values),
        }

    kind = docs.schema[id_column].dataType.simpleString()
    slim = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_arrow(slim, rows, f"id {kind}, kind string, value string")


def assign(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, attempt, other) for the distinct (kind, value): every surrogate is of one entity
    only and is no original of its type."""

    def rows(batch: pa.RecordBatch) -> dict:
        kinds, values, attempts = (batch.column(k).to_pylist() for k in range(3))
        return {
            "kind": batch.column(0), "value": batch.column(1), "attempt": batch.column(2),
            "other": pa.array([surrogate(key, *x) for x in zip(kinds, values, attempts)]),
        }

    schema = "kind string, value string, attempt int, other string"
    originals = written(found.select("kind", "value").distinct(), "pii-entities")
    settled = None  # a union of what each round has written
    trying = originals.withColumn("attempt", F.lit(0))
    idle = 0
    while idle < IDLE:
        now = written(map_arrow(trying.select("kind", "value", "attempt"), rows, schema), "pii-trials")
        taken = originals.select("kind", F.col("value").alias("other"))
        free = now.join(taken, ["kind", "other"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", "other"), ["kind", "other"], "left_anti")
        # Of several with the same surrogate the smallest keeps it.
        first = free.groupBy("kind", "other").agg(F.min("value").alias("value"))
        good = free.join(first, ["kind", "other", "value"]).select("kind", "value", "attempt", "other")
        good = written(good, "pii-settled")
        settled = good if settled is None else settled.unionAll(good)
        idle = idle + 1 if good.isEmpty() else 0
        trying = now.join(good.select("kind", "value"), ["kind", "value"], "left_anti").select(
            "kind", "value", (F.col("attempt") + 1).alias("attempt")
        )
        trying = written(trying, "pii-open")
        if trying.isEmpty():
            return settled
    raise ValueError("all values of a type are in use")


def anonymize(
    docs: DataFrame, key: bytes, id_column: str = "doc_id", text_column: str = "text",
    added: str = "n_entities",
) -> DataFrame:
    """The rows with their entities replaced and counted in ``added`` (replaced if it is there)."""
    found = written(entities(docs, id_column, text_column), "pii-found")
    later = assign(found, key).filter("attempt > 0")
    # As many as a text has entities.
    by_doc = found.filter("id IS NOT NULL").join(later, ["kind", "value"]).groupBy("id").agg(
        F.collect_set(F.struct("kind", "value", "attempt")).alias("later")
    )
    kept = docs.drop(added)
    names = kept.columns
    inner = kept.toDF(*[f"_{i}" for i in range(len(names))])
    joined = inner.join(by_doc, inner[f"_{names.index(id_column)}"] == by_doc["id"], "left").drop("id")
    at = names.index(text_column)

    def rows(batch: pa.RecordBatch) -> dict:
        texts, counts = [], []
        for text, known in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
            tries = {(x["kind"], x["value"]): x["attempt"] for x in known or []}
            new, n = rewrite(text, key, tries) if text else (text, 0)
            texts.append(new)
            counts.append(n)
        columns = {f"_{i}": batch.column(i) for i in range(len(names))}
        return columns | {
            f"_{at}": pa.array(texts, pa.string()), "n": pa.array(counts, pa.int64()),
        }

    schema = ", ".join(f"`_{i}` {f.dataType.simpleString()}" for i, f in enumerate(kept.schema))
    return map_arrow(joined, rows, f"{schema}, n long").toDF(*names, added)
