"""Operator 1, PII surrogates: keyed, type-consistent replacements with global collision checks.

Entities: e-mail addresses, telephone numbers, IPv4 and IPv6 addresses, payment cards, US social security numbers,
IBANs, vendor tokens, web tokens, private keys and assigned secrets, and titled person names. Numbers without a layout of their own
(nine digits, national telephone numbers) count behind a word that names them; names without a title only where the text has them with one. An entity's normal form (an address in
lower case, a number's digits, a name without its title's case) is what corefers: every mention of one normal form in
the corpus gets one surrogate, rendered in that mention's own layout. Surrogates come from HMAC-SHA256 of
key, kind, normal form and attempt, so they need the key to be undone or linked, and keep

* layout: punctuation, spacing, letter case, hexadecimal or alphanumeric alphabet, length (addresses, names, tokens and
  secrets get longer by one character or syllable for every eight attempts that clash);
* validity: Luhn digits of cards, check digits of IBANs, octet ranges, IPv6 addresses of the range for documentation, never-issued social security areas,
  reserved mail domains;
* gender and script of names, both read from the title and the given name.

Distinct entities of the whole corpus are checked as they are written: no two share a surrogate, and none equals an
entity that really occurs; for names the family name is what must differ, since it may stand alone. Of clashing entities
the least keeps its surrogate, the others try again. A round reads settled forms but rewrites only what it retries. Later
attempts draw from ever wider spaces (numbers too, after ``FINITE`` attempts: only then do they outgrow their layout), so
rounds end even where all forms of a kind are taken.

Within a text, a person named in full behind a title corefers with the same full name without one, with another title of
no other gender, and with the title and family name alone where only one full name of that gender fits: "Mrs Jane Roe",
"Dr Jane Roe", "Jane Roe" and "Mrs Roe" get one surrogate, of which short mentions show the family name. Between texts, equal normal forms corefer.

The key is ``key``, or the setting ``spark.quarrystone.pii.key``; without either the operator refuses to run. The query
and the pipeline draw a random key for the application where none is set: surrogates then agree within it, and can't be traced back or reproduced.

A run of digits or capitals may hold more than the number it starts with: a card is looked for among its groups (Luhn
digit and issuer's length first), a telephone number or IBAN that isn't valid as matched at its earlier ends and later starts.

Null texts stay null and empty ones empty. Overlapping mentions: the leftmost wins, then the kind listed first.
All other columns pass through whatever their names (one called n_entities is replaced); an empty table gives no row; rows that repeat or share a doc_id are each rewritten by their own text.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import ipaddress
import re
import secrets
import warnings
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrystone.llm import staging

KEY_SETTING = "spark.quarrystone.pii.key"
#: Attempts of one length, and attempts after which numbers may outgrow their layout.
SAME_WIDTH = 8
FINITE = 48
MENTION = "begin int, end int, kind string, norm string"
MENTIONS = f"row_key string, mentions array<struct<{', '.join(x.split()[0] + ':' + x.split()[1] for x in MENTION.split(', ')) }>>"

# Name parts by script and gender (f, m; n where a title says nothing).
GIVEN = {
    "latin": {"f": "Anna Clara Elena Emma Greta Ines Julia Laura Lucia Maria Nora Paula Rosa Sofia Vera", "m": "Adrian Bruno Carlos David Emil Felix Hugo Jonas Leon Lucas Marco Oscar Pablo Simon Victor"},
    "cyrillic": {"f": "Анна Вера Дарья Елена Ирина Мария Нина Ольга София Юлия", "m": "Антон Борис Виктор Иван Максим Олег Павел Роман Сергей Юрий"},
    "greek": {"f": "Άννα Ελένη Ιωάννα Κατερίνα Μαρία Νίκη Σοφία", "m": "Ανδρέας Γιώργος Δημήτρης Κώστας Νίκος Πέτρος Στέφανος"},
}
SYLLABLES = {
    "latin": "ba be bo da del dor fa fen gar hal jo kel ker la len lo mar men mir na nor pa per ra ren ros sa sel sor ta tel tor va ven wil zan",
    "cyrillic": "бе во га гор да ди до за ка ки ко ла ле ли ма ми мо на не но па пе ро са се со та ти то ша",
    "greek": "βα γα γε δα δι θε κα κο λα λε μα μι να νι πα πε ρα ρο σα σι τα το φα χα",
}
ENDINGS = {"latin": {"f": "", "m": "", "n": ""}, "cyrillic": {"f": "ова", "m": "ов", "n": "енко"}, "greek": {"f": "ίδου", "m": "ίδης", "n": "άκη"}}
# Titles that name a gender.
TITLES = {
    "f": "Mrs Ms Miss Frau Mme Madame Mlle Señora Señorita Sra Srta Doña señora señorita doña Госпожа госпожа Г-жа г-жа Κυρία κυρία MRS MME FRAU",
    "m": "Mr Mister Herr Herrn Monsieur Señor Sr Don señor don Господин господин Г-н г-н Κύριος κύριος MR HERR",
    "n": "Dr Prof Professor PROF",
}
_GENDER = {t: g for g, names in TITLES.items() for t in names.split()}
_NAMED = {n.lower(): g for by in GIVEN.values() for g, names in by.items() for n in names.split()}
#: Letters and digits of alphabets whose words stand apart.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏͰ-ӿ"
_WORD = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))*(?!\w)"

#: Patterns in order of precedence, each with the characters a text must hold for it to be tried.
PATTERNS = [
    ("email", "@", re.compile(rf"(?<![\w.+-])[{_LETTER}0-9][\w.+-]*@[{_LETTER}0-9-]+(?:\.[{_LETTER}0-9-]+)*\.[{_LETTER}]{{2,}}")),
    ("secret", None, re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----([A-Za-z0-9+/=\s]{16,})-----END ")),
    ("token", None, re.compile(r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]{8,}){2})(?![A-Za-z0-9])")),
    ("secret", "=:", re.compile(r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s*[=:]\s*[\"']?((?=[^\s\"']*\d)[^\s\"',;]{7,}[A-Za-z0-9])")),
    ("iban", None, re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("card", None, re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,}(?![\w-])")),
    ("phone", None, re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])|(?<![\w.])\+\d{1,3}(?:[ .-]?\(?\d{2,5}\)?){2,5}(?![\w-])")),
    ("phone", None, re.compile(r"(?i)\b(?:tel|telefon|telephone|phone|mobile|fax)\b\.?\s?:?\s?(0\d{1,4}[ /-]\d{5,8})(?![\w-])")),
    ("ssn", "-", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("ssn", None, re.compile(r"(?i)\b(?:ssn|social security(?: number| no\.?)?)\s?[:#]?\s?(\d{9})(?![\w-])")),
    ("ip6", ":", re.compile(r"(?<![\w:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:]|\.\d)")),
    ("ip", ".", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)")),
    ("name", None, re.compile(rf"\b(?:{'|'.join(sorted(_GENDER, key=len, reverse=True))})\b\.? +({_WORD}(?: +{_WORD}){{0,2}})")),
]
_DIGIT = re.compile(r"\d")
_GROUP = re.compile(r"\d+")
_GAP = re.compile(r"(?<![ .-])[ .-]")
_PLAIN_CARD = re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])")
# Lengths that issuers give to numbers with these first digits.
_ISSUED = re.compile(r"4(?:\d{12}|\d{15})|(?:5[1-5]|222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720)\d+|3[47]\d{13}|3[0689]\d{12}|35\d{14}|(?:6|50|5[6-8])\d{11,18}")
_TITLED = re.compile(rf"\b(?:{'|'.join(sorted(_GENDER, key=len, reverse=True))})\b")


def luhn(digits: str) -> int:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _normal(kind: str, surface: str, match: re.Match) -> str | None:
    """The normal form, or None where the surface isn't of its kind after all."""
    if kind == "email":
        return surface.lower()
    if kind == "ip":
        parts = surface.split(".")
        return ".".join(str(int(p)) for p in parts) if all(int(p) < 256 for p in parts) else None
    if kind == "ip6":
        try:
            address = ipaddress.IPv6Address(surface)
        except ValueError:
            return None
        # Names that are joined by two colons may read as short addresses.
        groups = [g for g in surface.split(":") if g]
        sure = _DIGIT.search(surface) and (len(groups) > 2 or len(groups[0]) == 4 and _DIGIT.search(groups[0]))
        return address.compressed if sure else None
    if kind in ("card", "phone", "ssn"):
        digits = "".join(_DIGIT.findall(surface))
        if kind == "card":
            return digits if len(digits) <= 19 and (luhn(digits) == 0 or len(digits) == 16 and digits[0] in "23456") else None
        if kind == "phone":
            if not 8 <= len(digits) <= 15:
                return None
            return digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
        return digits
    if kind == "iban":
        plain = surface.replace(" ", "")
        return plain if 15 <= len(plain) <= 34 and iban_rest(plain) == 1 else None
    if kind == "name":
        title = _TITLED.match(match.group()).group()
        words = []
        for w in surface.split():
            if not w[0].isupper() or _script(w.lower()) != _script(surface.lower()):
                break
            words.append(w)
        # A title in capitals may be an abbreviation, unless the name is in capitals too.
        if not words or (title.isupper() and not words[0].isupper()):
            return None
        gender = _GENDER[title]
        if gender == "n" and len(words) > 1:
            gender = _NAMED.get(words[0].lower(), "n")
        return f"{gender}|{len(words)}|{' '.join(words).lower()}"
    return surface


def _card_rank(digits: str, sizes: list[int], first: bool, whole: bool) -> int | None:
    """How sure it is that groups of digits are a card number (0: most), None where they aren't."""
    laid_out = len(sizes) == 1 or sizes in ([4, 6, 5], [4, 6, 4]) or (len(sizes) > 3 and set(sizes[:-1]) == {4} and sizes[-1] <= 4)
    if luhn(digits) == 0:
        issued = _ISSUED.fullmatch(digits) and (digits[0] not in "25" or len(digits) == 16 or re.match("50|5[6-8]", digits))
        return 0 if laid_out and issued else 1 if whole or (first and laid_out) else None
    if len(digits) == 16 and (laid_out or whole):
        return 2 if digits[0] in "3456" else 3 if digits[0] == "2" and first else None
    return None


def _cards(text: str, begin: int, end: int) -> Iterator[tuple[int, int, str]]:
    """Card numbers among the groups of a run of digits, which may hold other numbers too."""
    groups = [g.span() for g in _GROUP.finditer(text, begin, end)]
    found = []
    for i in range(len(groups)):
        digits, sizes = "", []
        for j in range(i, len(groups)):
            digits += text[slice(*groups[j])]
            sizes.append(groups[j][1] - groups[j][0])
            if len(digits) > 19:
                break
            if len(digits) >= 13 and (rank := _card_rank(digits, sizes, i == 0, len(sizes) == len(groups))) is not None:
                found.append((rank, i, -j, digits))
    owner = [0] * len(groups)
    for _, i, j, digits in sorted(found):
        if not any(owner[i : 1 - j]):
            owner[i : 1 - j] = [1] * (1 - j - i)
            yield groups[i][0], groups[-j][1], digits
    # What is left, in any layout.
    i = 0
    while i < len(groups):
        j = i
        while j < len(groups) and not owner[j]:
            j += 1
        for m in _PLAIN_CARD.finditer(text, groups[i][0], groups[j - 1][1]) if j > i else ():
            if (norm := _normal("card", m.group(), m)) is not None:
                yield *m.span(), norm
        i = j + 1


def _shorter(kind: str, pattern: re.Pattern, text: str, begin: int, end: int) -> tuple[int, str] | None:
    """End and normal form of the longest valid number that ends at a gap inside a match."""
    stops = [g.start() for g in _GAP.finditer(text, begin, end)][::-1]
    # Rather not into another number.
    inner = pattern.search(text, begin + 1)
    limit = inner.start() if inner else end
    for stop in [s for s in stops if s <= limit] + [s for s in stops if s > limit]:
        m = pattern.fullmatch(text, begin, stop)
        if m and (norm := _normal(kind, m.group(), m)) is not None:
            return stop, norm
    return None


def _found(kind: str, pattern: re.Pattern, text: str) -> Iterator[tuple[int, int, str]]:
    """(begin, end, normal form) of a kind's mentions."""
    at = 0
    while m := pattern.search(text, at):
        group = m.lastindex or 0
        begin, at = m.start(group), m.end()
        if kind == "card":
            yield from _cards(text, begin, at)
            continue
        surface = m.group(group)
        norm = _normal(kind, surface, m)
        if norm is not None:
            length = _name_length(surface, int(norm.split("|")[1])) if kind == "name" else len(surface)
            yield begin, begin + length, norm
        elif kind in ("iban", "phone"):
            # A neighbouring number or word may have been taken along, or an entity may start later.
            if cut := _shorter(kind, pattern, text, begin, at):
                at = cut[0]
                yield begin, *cut
            else:
                at = begin + 1


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, normal form) of disjoint mentions in code points, in order."""
    if not text:
        return []
    digits, titled = _DIGIT.search(text), _TITLED.search(text)
    found = []
    for rank, (kind, needs, pattern) in enumerate(PATTERNS):
        if (needs and not any(c in text for c in needs)) or (not digits and kind not in ("email", "name", "secret")) or (kind == "name" and not titled):
            continue
        found += [(begin, rank, end, kind, norm) for begin, end, norm in _found(kind, pattern, text)]
    out = _disjoint((begin, end, kind, norm) for begin, _, end, kind, norm in sorted(found))
    return _coreferent(text, out) if any(m[2] == "name" for m in out) else out


def _disjoint(found: Iterable[tuple]) -> list[tuple]:
    """Of ordered mentions, those that don't begin inside one before."""
    out, last = [], 0
    for m in found:
        if m[0] >= last:
            out.append(m)
            last = m[1]
    return out


def _coreferent(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """The mentions with one normal form for each person of a text, and full names that stand without a title."""
    genders: dict[str, set[str]] = {}
    for _, _, kind, norm in found:
        if kind == "name":
            gender, words, name = norm.split("|")
            if words != "1":
                genders.setdefault(name, set()).add(gender)
    if not genders:
        return found
    # Titles without a gender join the one gender that a name has; a name of both stays apart.
    told = {name: (next(iter(g - {"n"})) if len(g - {"n"}) == 1 else "n") for name, g in genders.items()}
    full = {name: f"{told[name]}|{len(name.split())}|{name}" for name in genders}
    families: dict[str, list[str]] = {}
    for name in genders:
        families.setdefault(name.split()[-1], []).append(name)

    def person(norm: str) -> str:
        gender, words, name = norm.split("|")
        if words != "1":
            return full[name] if gender in ("n", told[name]) or len(genders[name] - {"n"}) == 1 else norm
        fits = [n for n in families.get(name, []) if gender == "n" or gender in genders[n] or genders[n] == {"n"}]
        return full[fits[0]] if len(fits) == 1 else norm

    out = [(b, e, kind, person(norm) if kind == "name" else norm) for b, e, kind, norm in found]
    written = {tuple(text[b:e].split()) for b, e, kind, norm in out if kind == "name" and len(text[b:e].split()) > 1}
    untitled = []
    bare = re.compile("|".join(rf"(?<!\w){r'[ ]+'.join(map(re.escape, w))}(?!\w)" for w in sorted(written, key=lambda w: (-len(w), w))))
    starts = [m[0] for m in out]
    for m in bare.finditer(text):
        begin, end = m.span()
        at = bisect.bisect_right(starts, begin)
        free = (not at or out[at - 1][1] <= begin) and (at == len(starts) or starts[at] >= end)
        if free:
            untitled.append((begin, end, "name", full[" ".join(m.group().split()).lower()]))
    return sorted(out + untitled)


def _name_length(surface: str, words: int) -> int:
    return [m.end() for m in re.finditer(r"\S+", surface)][words - 1]


class _Stream:
    """Keyed pseudorandom choices."""

    def __init__(self, key: str, kind: str, norm: str, attempt: int):
        self.seed = f"{kind}\0{norm}\0{attempt}".encode()
        self.key, self.block, self.pool = key.encode(), 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < 64:
            raw = hmac.new(self.key, self.seed + self.block.to_bytes(4, "little"), hashlib.sha256).digest()
            self.pool, self.left, self.block = int.from_bytes(raw, "little"), 256, self.block + 1
        got = self.pool & ((1 << 48) - 1)
        self.pool >>= 48
        self.left -= 48
        return got % n

    def like(self, c: str, hexadecimal: bool = False) -> str:
        if c.isascii() and c.isdigit():
            return str(self.below(10))
        if hexadecimal and c in "abcdef":
            return "abcdef"[self.below(6)]
        if hexadecimal and c in "ABCDEF":
            return "ABCDEF"[self.below(6)]
        if "a" <= c <= "z":
            return chr(97 + self.below(26))
        if "A" <= c <= "Z":
            return chr(65 + self.below(26))
        return c


def surrogate(key: str, kind: str, norm: str, attempt: int = 0) -> str:
    """The normal form of the replacement."""
    s = _Stream(key, kind, norm, attempt)
    # Later attempts widen the space: the own one may be full of real and given forms.
    wider = attempt // SAME_WIDTH
    more = "".join(str(s.below(10)) for _ in range(max(0, attempt - FINITE + SAME_WIDTH) // SAME_WIDTH))
    if kind == "email":
        local, domain = norm.rsplit("@", 1)
        host = _Stream(key, "domain", domain, 0)
        name = "".join(host.like("a") for _ in range(8))
        return "".join(s.like(c if c.isascii() else "a") for c in local + "a" * wider) + f"@{name}.example.{('com', 'net', 'org')[host.below(3)]}"
    if kind == "ip":
        first = 1 + s.below(222)
        return ".".join([*map(str, (first + (first >= 127), s.below(256), s.below(256), 1 + s.below(254))), *more])
    if kind == "ip6":
        # Of the range that is reserved for documentation.
        return ipaddress.IPv6Address("2001:db8:" + ":".join(f"{1 + s.below(65535):x}" for _ in range(6))).compressed
    if kind == "card":
        body = norm[0] + "".join(str(s.below(10)) for _ in norm[2:]) + more
        valid = luhn(norm) == 0
        check = next(str(d) for d in range(10) if luhn(f"{body}{d}") == 0)
        return body + (check if valid else str((int(check) + 1 + s.below(9)) % 10))
    if kind == "phone":
        # Ten digits: an area and an exchange, neither of which starts with 0 or 1. Else the country stays, at first.
        leads = (0, 3) if len(norm) == 10 else (2,)
        keep = 0 if len(norm) == 10 or wider else 2
        return norm[:keep] + "".join(str(2 + s.below(8) if k in leads else s.below(10)) for k in range(keep, len(norm))) + more
    if kind == "ssn":
        return f"9{s.below(100):02d}{1 + s.below(99):02d}{1 + s.below(9999):04d}{more}"
    if kind == "iban":
        body = "".join(s.like(c) for c in norm[4:]) + more
        return f"{norm[:2]}{98 - iban_rest(norm[:2] + '00' + body):02d}{body}"
    if kind == "token":
        head = re.match(r"AKIA|gh._|sk-|xox.-|AIza|eyJ", norm).end()
        return norm[:head] + "".join(s.like(c) for c in norm[head:] + "a" * wider)
    if kind == "name":
        gender, words, name = norm.split("|")
        script = _script(name)
        chosen = GIVEN[script].get(gender) or " ".join(GIVEN[script].values())
        given = [chosen.split()[s.below(len(chosen.split()))] for _ in range(int(words) - 1)]
        syllables = SYLLABLES[script].split()
        family = "".join(syllables[s.below(len(syllables))] for _ in range(2 + s.below(3) + wider)) + ENDINGS[script][gender]
        return f"{gender}|{words}|{' '.join([*given, family]).lower()}"
    hexadecimal = re.fullmatch(r"[0-9a-fA-F]+", norm) is not None
    return "".join(s.like(c, hexadecimal) for c in norm + "a" * wider)


def _script(name: str) -> str:
    """The script of a name's first word."""
    for c in name.split()[0]:
        if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
            return "greek"
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
    return "latin"


def render(kind: str, surface: str, new: str) -> str:
    """The replacement in the mention's layout."""
    if kind in ("card", "phone", "ssn", "iban"):
        slots = [i for i, c in enumerate(surface) if c.isalnum()]
        out = list(surface)
        for i, c in zip(slots[max(0, len(slots) - len(new)) :], new):
            out[i] = c
        return "".join(out) + new[len(slots) :]
    if kind == "name":
        words = new.split("|")[2].split()[-len(surface.split()) :]
        upper = surface.isupper() and len(surface) > 1
        gaps = re.findall(r"\s+", surface)
        shaped = [w.upper() if upper else w[0].upper() + w[1:] for w in words]
        return "".join(a + b for a, b in zip(shaped, [*gaps, ""]))
    if kind in ("email", "ip6") and surface.isupper():
        return new.upper()
    return new


def mentions(documents: DataFrame) -> DataFrame:
    """(row_key, mentions): one row per distinct text that holds an entity; row_key is its SHA-256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("norm", pa.string())]))
        for batch in batches:
            keys, found = [], []
            for text in batch.column(0):
                text = text.as_py()
                if got := detect(text):
                    keys.append(hashlib.sha256(text.encode()).hexdigest())
                    found.append([dict(zip(("begin", "end", "kind", "norm"), m)) for m in got])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(found, kind)], ["row_key", "mentions"])

    return documents.select("text").mapInArrow(run, MENTIONS).dropDuplicates(["row_key"])


def _written(form: str):
    """What of a normal form must be found nowhere else: of a name, the last word."""
    return F.when(F.col("kind") == "name", F.substring_index(F.substring_index(form, "|", -1), " ", -1)).otherwise(F.col(form))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, new) for distinct ``entities(kind, norm)``, free of collisions as written."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [surrogate(key, k, n, a) for k, n, a in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], ["kind", "norm", "attempt", "new"])

    shape = "kind string, norm string, attempt int, new string"
    named = staging.staged(entities.select("kind", "norm"), "entities")
    taken = named.select("kind", _written("norm").alias("written"))
    open_, settled = named.withColumn("attempt", F.lit(0)), None
    while True:
        tried = staging.staged(open_.mapInArrow(make, shape).withColumn("written", _written("new")), "tried")
        if settled is not None and tried.isEmpty():
            return settled.select("kind", "norm", "new")
        first = tried.groupBy("kind", "written").agg(F.min("norm").alias("first"))
        # Forms that are real or settled, of those tried now: the few retried are the side that can be broadcast.
        met = taken.join(tried.select("kind", "written"), ["kind", "written"], "left_semi").distinct()
        judged = tried.join(first, ["kind", "written"]).join(met.withColumn("met", F.lit(True)), ["kind", "written"], "left")
        judged = staging.staged(judged.withColumn("clash", F.col("met").isNotNull() | (F.col("norm") != F.col("first"))), "judged")
        won = judged.filter("NOT clash")
        settled = won if settled is None else settled.union(won)
        taken = taken.union(won.select("kind", "written"))
        open_ = judged.filter("clash").select("kind", "norm", (F.col("attempt") + 1).alias("attempt"))


_DRAWN: list[str] = []


def configured_key(spark: SparkSession) -> str | None:
    return spark.conf.get(KEY_SETTING, None) or None


def application_key(spark: SparkSession) -> str:
    """The configured key, or a random one that this application keeps."""
    if key := configured_key(spark):
        return key
    if not _DRAWN:
        warnings.warn(f"{KEY_SETTING} isn't set: surrogates use a random key and can't be reproduced", stacklevel=2)
        _DRAWN.append(secrets.token_hex(32))
    return _DRAWN[0]


def replace_pii(documents: DataFrame, key: str | None = None) -> DataFrame:
    """All columns of ``documents`` with ``text`` rewritten, and n_entities."""
    key = key or configured_key(documents.sparkSession)
    if not key:
        raise ValueError(f"surrogates need a key: pass one or set {KEY_SETTING}")
    found = staging.staged(mentions(documents), "mentions")
    each = found.select("row_key", F.inline("mentions"))
    new = surrogates(each.select("kind", "norm").distinct(), key)
    kept = documents.drop("n_entities")
    steps, own, theirs = staging.fresh([*kept.columns, "n_entities"], "plan", "row_key", "plan_key")
    # A text's own mentions: bounded by its length.
    plan = each.join(new, ["kind", "norm"]).groupBy(F.col("row_key").alias(theirs)).agg(F.sort_array(F.collect_list(F.struct("begin", "end", "kind", "new"))).alias(steps))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: i for i, name in enumerate(batch.schema.names)}
            texts, counts = [], []
            for text, plan in zip(batch.column(at["text"]), batch.column(at[steps])):
                text, plan = text.as_py(), plan.as_py() or []
                out, last = [], 0
                for s in plan:
                    out += [text[last : s["begin"]], render(s["kind"], text[s["begin"] : s["end"]], s["new"])]
                    last = s["end"]
                texts.append("".join([*out, text[last:]]) if plan else text)
                counts.append(len(plan))
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(i) for n, i in at.items() if n != steps]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], [*(n for n in at if n != steps), "n_entities"])

    # Staged, so that the join is of plain exchanges and the copies of one text can be split.
    plan = staging.staged(plan, "plans")
    joined = kept.withColumn(own, F.sha2("text", 256)).join(plan, F.col(own) == F.col(theirs), "left").drop(own, theirs)
    return joined.mapInArrow(write, T.StructType([*kept.schema.fields, T.StructField("n_entities", T.LongType())]))


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole corpus with personal data and secrets replaced."""
    return replace_pii(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), application_key(spark))
