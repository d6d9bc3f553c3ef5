"""Finding personal data in a text, and keyed stand-ins of the same type and format.

An entity is a kind and a normal form: two mentions with the same normal form are the same
entity however they are written. ``stand_in`` makes a normal form for a replacement from a
key, the entity and an attempt number; ``rendered`` writes it the way a mention was written.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_right
from dataclasses import dataclass
from ipaddress import AddressValueError, IPv6Address
from math import prod

# Titles by gender, and common given names by script and gender.
TITLES = {
    "m": "Mr Herr Monsieur Señor Sr Mister г-н".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Mlle Señora Sra г-жа".split(),
    "": "Dr Prof Professor".split(),
}
GIVEN = {
    ("latin", "m"): (
        "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Mark Paul Steven "
        "Andrew Kevin Brian George Edward Peter Klaus Jürgen Wolfgang Dieter Günther Pierre Jacques François "
        "Philippe Carlos José Miguel Javier Pablo Diego Christopher Anthony Donald Joshua Kenneth Timothy Jason "
        "Jeffrey Ryan Jacob Gary Nicholas Stephen Jonathan Scott Benjamin Samuel Gregory Patrick Frank Raymond Jack "
        "Dennis Henry Walter Oliver Lukas Felix Antoine Louis Luis Fernando"
    ).split(),
    ("latin", "f"): (
        "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Emily Michelle "
        "Amanda Melissa Deborah Laura Rebecca Sharon Ursula Claudia Sabine Brigitte Sophie Camille Isabelle "
        "Françoise Monique Lucía María Carmen Dolores Pilar Julia Olivia Alice Emma Grace Dorothy Ashley Kimberly "
        "Donna Carol Stephanie Cynthia Kathleen Amy Angela Shirley Brenda Pamela Nicole Samantha Katherine Christine "
        "Rachel Carolyn Janet Victoria Diane Joyce Sophia Martha Gloria Chloé Charlotte Hannah Lena"
    ).split(),
    ("cyrillic", "m"): "Иван Дмитрий Сергей Алексей Николай Михаил Андрей Владимир Павел Юрий".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Екатерина Ирина Светлана Юлия".split(),
}
#: consonants and vowels that made-up names of a script are built of
SOUNDS = {
    "latin": ("b c d f g h k l m n p r s t v w z br cl gr st tr".split(), "a e i o u ai ea".split()),
    "cyrillic": ("б в г д ж з к л м н п р с т в х".split(), "а е и о у я".split()),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ τ φ χ".split(), "α ε η ι ο υ ω".split()),
}
#: words after which a name is given; whom the words are about must be told where they also introduce things
CUES = "name is|Name:|Contact:|Author:|Sincerely,|Regards,|Signed,".split("|")
PERSONS = "man|woman|boy|girl|person|someone|somebody|guy|lady|friend|colleague|neighbour|neighbor|brother|sister|son|daughter".split("|")
# Capitalised words that follow a given name, or an introduction, in names of things, places and days.
ORDINARY = frozenset(
    "Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September "
    "October November December Spring Summer Autumn Winter Christmas Easter "
    "The A An And Or But Of In On At To For From With By As Is Was Are Were Has Had Have Will Would Can Could Then When "
    "He She It They We You I His Her Its Their Our Your This That These Those There Here Not No Yes If So "
    "Sir Madam All Everyone Customer Reader Team Friends Colleagues New Old Great Big Little Blue Red Green Black Golden Royal "
    "Street Road Avenue Lane Drive Square Park Garden Gardens Station Airport Bridge Tower House Hall Castle Palace Church "
    "Cathedral Abbey Chapel School College University Institute Academy Hospital Clinic Hotel Theatre Theater Museum Library "
    "Stadium Centre Center City Town Village County State Province Island Islands Lake River Creek Falls Bay Beach Harbour "
    "Harbor Cape Coast Mountain Mount Hill Hills Valley Forest Canyon Desert Point Peak Line Cross Period Award Prize Cup "
    "Company Corporation Inc Ltd Bank Group Foundation Press Records Day Week Act Law Case Effect Theorem Syndrome Disease".split()
)
#: capital letters that stand for names; each is replaced by one of its own line
INITIALS = [
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
    "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЭЮЯ",
    "ЪЫЬ",
    "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
]
#: signs that a secret without letters and digits is made of: none ends a quoted word
SIGNS = "!#$%&*+-./:<=>?@^_~"
#: the attempt of entities whose format has too few values to draw from
CLOSED = -1
_GENDER = {name: gender for (_, gender), names in GIVEN.items() for name in names}
_TITLE = {title: gender for gender, titles in TITLES.items() for title in titles}

_NUMERIC = re.compile(
    r"""
    (?P<iban>\b[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){3,7}(?:[ ]?[A-Z0-9]{1,3})?\b)
  | (?P<ipv6>(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}
        |[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?!\w|:\w))
  | (?P<ipv4>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))
  | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
  | (?P<phone>
        (?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,5}(?!\w)
      | (?<!\w)(?:1[ .-])?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\w)
      | (?<![\w.-])(?:1[.-])?\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]|\.\d))
  | (?P<card>(?<![\w.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w))
    """,
    re.VERBOSE | re.ASCII,
)
_SECRET = re.compile(
    r"""(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|private[_-]?key)\b["']?\s*[:=]\s*)"""
    r"""(?P<a>"[^"\s]{6,}"|'[^'\s]{6,}'|(?=[^\s"',;|]{0,200}[0-9])[^\s"',;|]{6,})"""
    r"""|\b(?P<b>AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}"""
    r"""|(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{32,128})\b"""
)
_SECRET_WORDS = ("token", "secret", "passw", "key", "akia", "ghp_", "gho_", "sk-")
_DOMAIN = re.compile(r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])")
#: characters of the part before an @, and how many there may be
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_LONGEST_LOCAL = 64
# without U+03A2, which is no letter
_CAPITAL = "A-ZÀ-ÖØ-ÞΑ-ΡΣ-ΩА-Я"
_NAME = rf"[{_CAPITAL}][\w'’-]+"
_ITEM = rf"(?:[{_CAPITAL}]\.|{_NAME})"
_CAPITALS = re.compile(rf"(?<![\w'-])([^\W\d_][\w'-]*)(\.?) ({_ITEM}(?: {_ITEM}){{0,3}})")
_CUE = re.compile(
    rf"(?:(?:{'|'.join(map(re.escape, CUES))}|\b(?:{'|'.join(PERSONS)})\s+(?:named|called))\s+"
    rf"({_NAME}(?: [{_CAPITAL}]\.){{0,2}} {_NAME})(?![\w'’-])"
    rf"|\bDear ({_NAME}(?: [{_CAPITAL}]\.){{0,2}} {_NAME})(?=\s?[,:!\n]))"
)
_WORD = re.compile(r"[^\W\d_](?:[\w'’-]*\w)?")
_CARD_CUE = re.compile(r"(?i:\b(?:card|visa|mastercard|amex|credit|debit)\b[^\n]{0,32})\Z")
_DIGIT = re.compile(r"[0-9]")


@dataclass(frozen=True)
class Mention:
    """A stretch of a text that names an entity."""

    start: int
    end: int
    kind: str
    normal: str


def script_of(word: str) -> str:
    first = next((c for c in word if c.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= first <= "ӿ" else "greek" if "Ͱ" <= first <= "Ͽ" else "latin"


def _luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def _normal(kind: str, text: str) -> str:
    if kind == "email":
        return text.lower()
    if kind == "phone":
        digits = re.sub(r"\D", "", text)
        return digits if text.startswith("+") or len(digits) != 10 else "1" + digits
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "ipv6":
        try:
            return IPv6Address(text).packed.hex(":", 2)  # its own long form mixes notations
        except AddressValueError:
            return ""
    if kind == "secret" and re.fullmatch(r"[0-9A-Fa-f]+", text):
        return text.lower()
    return text


def _emails(text: str) -> list[Mention]:
    """Addresses, found from their @ outwards."""
    found = []
    at = text.find("@")
    while at >= 0:
        start = at
        while start > max(0, at - _LONGEST_LOCAL) and text[start - 1] in _LOCAL:
            start -= 1
        while start < at and not text[start].isalnum():
            start += 1
        domain = _DOMAIN.match(text, at)
        if start < at and domain:
            found.append(Mention(start, domain.end(), "email", text[start : domain.end()].lower()))
        at = text.find("@", at + 1)
    return found


def _person(items: list[tuple[int, str]], gender: str) -> list[Mention]:
    """The parts of a name: given names and initials, the last word the surname; a word alone is a surname."""
    cut = [(start, word if word.endswith(".") else re.sub("['’](?:s)?$", "", word)) for start, word in items]
    words = [i for i, (_, word) in enumerate(cut) if not word.endswith(".")]
    gender = _GENDER.get(cut[words[0]][1], gender) if len(words) > 1 else gender
    found = []
    for i, (start, word) in enumerate(cut):
        if word.endswith("."):
            kind, word = "initial", word[:-1]
        else:
            kind = "surname" if i == words[-1] else "given_" + _GENDER.get(word, gender or "m")
        found.append(Mention(start, start + len(word), kind, word.lower()))
    return found


def _name_items(items: list[tuple[int, str]], titled: bool) -> list[tuple[int, str]]:
    """The leading items that make up a name: up to three words, none an ordinary one, initials before the last."""
    taken, words = [], 0
    for start, word in items:
        initial = word.endswith(".")
        if word in ORDINARY or words == 3 or (initial and words >= 2):
            break
        # a third word goes with a known given name, in front of two others
        if not initial and words == 2 and next(w for _, w in taken if not w.endswith(".")) not in _GENDER:
            break
        taken.append((start, word))
        words += not initial
    while taken and taken[-1][1].endswith("."):
        taken.pop()
    return taken if words >= (1 if titled else 2) else []


def _named(text: str) -> list[Mention]:
    """Given names, initials and surnames, each an entity of its own, told by a title or a given name."""
    found, at = [], 0
    while match := _CAPITALS.search(text, at):
        at = match.start(3)
        first, dot, rest = match.groups()
        titled = first in _TITLE
        if not titled and (dot or first not in _GENDER):
            continue
        items = [(at + m.start(), m.group()) for m in re.finditer(r"\S+", rest)]
        items = _name_items(items if titled else [(match.start(1), first), *items], titled)
        if items:
            found += _person(items, _TITLE.get(first, ""))
            at = found[-1].end
    return found


def _introduced(text: str) -> list[Mention]:
    """A name after words that introduce one; the ending tells an unknown given name's gender."""
    found = []
    for match in _CUE.finditer(text):
        group = match.lastindex
        items = [(match.start(group) + m.start(), m.group()) for m in re.finditer(r"\S+", match.group(group))]
        first, last = items[0][1], items[-1][1]
        if first not in _TITLE and not (group == 2 and (first in ORDINARY or last in ORDINARY)):
            found += _person(items, "f" if first[-1] in "aа" else "m")
    return found


def _repeated(text: str, found: list[Mention]) -> list[Mention]:
    """Further places where a name stands that the text told to be one: whole capitalised words outside other entities."""
    names: dict[str, str] = {}
    for m in found:
        if m.kind == "surname" or m.kind.startswith("given_"):
            names.setdefault(m.normal, m.kind)
    starts, more = [m.start for m in found], []
    for match in _WORD.finditer(text) if names else ():
        word = re.sub("['’]s$", "", match.group())
        if word[0].isupper() and word.lower() in names:
            start, end = match.start(), match.start() + len(word)
            place = bisect_right(starts, start)
            if (not place or found[place - 1].end <= start) and (place == len(found) or end <= starts[place]):
                more.append(Mention(start, end, names[word.lower()], word.lower()))
    return more


def _is_number(text: str, kind: str, match: re.Match, normal: str) -> bool:
    """Whether digits of an entity's shape are one, as far as check digits and the words before them tell.

    Digits in one run are a card only if their check digit is right or a word for a card stands before
    them; digits in a card's groups are one as they are.
    """
    if kind == "iban":
        return int("".join(str(int(c, 36)) for c in normal[4:] + normal[:4])) % 97 == 1
    if kind == "ipv6":
        return normal != "" and _DIGIT.search(match.group()) is not None
    if kind == "card" and match.group().isdigit():
        return _luhn(normal) or _CARD_CUE.search(text, max(0, match.start() - 40), match.start()) is not None
    return True


def mentions(text: str) -> list[Mention]:
    """The entities named in a text, in order and without overlaps.

    A person is told once, by a title, a given name or an introduction; the parts of the name are then
    found wherever they stand in the text.
    """
    found = []
    low = text.lower()
    if any(w in low for w in _SECRET_WORDS) or _DIGIT.search(text):
        for match in _SECRET.finditer(text):
            group = "a" if match.group("a") else "b"
            start, end = match.span(group)
            if text[start] in "\"'":
                start, end = start + 1, end - 1
            found.append(Mention(start, end, "secret", _normal("secret", text[start:end])))
    if _DIGIT.search(text):
        for match in _NUMERIC.finditer(text):
            kind, normal = match.lastgroup, _normal(match.lastgroup, match.group())
            if _is_number(text, kind, match, normal):
                found.append(Mention(*match.span(), kind, normal))
    found += _emails(text)
    found += _named(text)
    if any(cue in text for cue in (*CUES, "named", "called", "Dear ")):
        found += _introduced(text)
    found.sort(key=lambda m: (m.start, -m.end))
    kept: list[Mention] = []
    for mention in found:
        if not kept or mention.start >= kept[-1].end:
            kept.append(mention)
    return sorted(kept + _repeated(text, kept), key=lambda m: m.start)


class _Draw:
    """Numbers that follow from a key and a message."""

    def __init__(self, key: bytes, message: str):
        self.key, self.message, self.block, self.pool = key, message.encode("utf-8", "surrogatepass"), 0, b""

    def below(self, limit: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.new(self.key, self.message + b"|%d" % self.block, hashlib.sha256).digest()
            self.block += 1
        taken, self.pool = self.pool[:4], self.pool[4:]
        return int.from_bytes(taken, "big") % limit

    def of(self, choices):
        return choices[self.below(len(choices))]


def _changes(c: str) -> bool:
    return c.isdigit() or c.isupper() or c.isalpha()


def _longer(text: str, attempt: int) -> str:
    """With another character for every eight attempts, of which there are several: a format of few values does not run out."""
    return text + next(filter(_changes, reversed(text)), text[-1]) * (attempt // 8)


def _same_classes(draw: _Draw, text: str) -> str:
    """A digit for a digit, a letter for a letter; hex digits stay hex. Signs are kept, unless there is nothing else."""
    if text and not any(map(_changes, text)):
        return "".join(draw.of(SIGNS) for _ in text)
    is_hex = re.fullmatch(r"[0-9]*[a-f][0-9a-f]*", text) is not None and any(c.isdigit() for c in text)
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    if is_hex:
        return "".join(draw.of(digits + "abcdef") for _ in text)
    classes = ((str.isdigit, digits), (str.isupper, upper), (str.isalpha, lower))
    return "".join(next((draw.of(made) for test, made in classes if test(c)), c) for c in text)


def _name(draw: _Draw, script: str, ending: str, attempt: int) -> str:
    consonants, vowels = SOUNDS[script]
    # later attempts are longer, so that names never run out
    made = "".join(draw.of(consonants) + draw.of(vowels) for _ in range(2 + attempt // 3))
    return made + (draw.of(vowels[:2]) if ending == "f" else draw.of(consonants[:16]))


def _ipv4(draw: _Draw) -> str:
    public = [n for n in range(1, 224) if n not in (10, 127, 172, 192)]
    return ".".join(map(str, [draw.of(public), *(draw.below(256) for _ in range(3))]))


def _private_bits(normal: str) -> int:
    """The free bits of an address in a private network or on the own machine; 0 for public ones."""
    a, b, *_ = map(int, normal.split("."))
    return 24 if a in (10, 127) else 16 if (a, b) == (192, 168) else 20 if a == 172 and 16 <= b < 32 else 0


def _next_in_pool(number: int, bits: int, key: bytes) -> int:
    """The number after this one on a circle of all numbers of an even count of bits, in keyed order.

    The order is a permutation in four Feistel rounds, so that different numbers stay different however many of them occur.
    """
    half = bits // 2
    mask = (1 << half) - 1

    def mixed(value: int, turn: int) -> int:
        return int.from_bytes(hmac.new(key, b"%d|%d|%d" % (bits, turn, value), hashlib.sha256).digest()[: max(4, -(-half // 8))], "big") & mask

    left, right = number >> half, number & mask
    for turn in reversed(range(4)):
        left, right = right ^ mixed(left, turn), left
    place = ((left << half | right) + 1) & ((1 << bits) - 1)
    left, right = place >> half, place & mask
    for turn in range(4):
        left, right = right, left ^ mixed(right, turn)
    return left << half | right


def pool(kind: str, normal: str) -> tuple[str, int] | None:
    """The format of an entity, and how many values attempts draw from; None where these are more for later attempts, or beyond number."""
    if kind == "phone":
        return f"{normal[:_country(normal)]} {len(normal)}", 10 ** (len(normal) - _country(normal))
    if kind == "ssn":
        return "", 665 * 99 * 9999
    if kind == "ipv4" and not _private_bits(normal):
        return "", 220 << 24
    if kind == "ipv6":
        digits = [len(group.lstrip("0")) for group in normal.split(":")]
        return " ".join(map(str, digits)), prod(15 << 4 * (n - 1) for n in digits if n)
    return None


def _next_of_format(kind: str, normal: str, key: bytes) -> str:
    """The next one of all values of a format, on a circle in keyed order; the only one of its format stays itself."""
    if kind in ("phone", "ssn"):
        fixed = normal[: _country(normal)] if kind == "phone" else ""
        free = len(normal) - len(fixed)
        return fixed + f"{_next_below(int(normal[len(fixed) :]), 10**free, key):0{free}d}"
    if kind == "ipv4":
        while True:
            number = _next_below(int.from_bytes(map(int, normal.split(".")), "big"), 1 << 32, key)
            normal = ".".join(map(str, number.to_bytes(4, "big")))
            if not _private_bits(normal):
                return normal
    # groups as numbers: a first digit of 15, the others of 16
    groups = [group.lstrip("0") for group in normal.split(":")]
    least = [16 ** (len(g) - 1) if g else 0 for g in groups]
    number = 0
    for group, low in zip(groups, least):
        number = number * (15 * low or 1) + (int(group or "0", 16) - low)
    number, made = _next_below(number, prod(15 * low or 1 for low in least), key), []
    for low in reversed(least):
        number, rest = divmod(number, 15 * low or 1)
        made.append(f"{rest + low:04x}")
    return ":".join(reversed(made))


def _next_below(number: int, limit: int, key: bytes) -> int:
    """The next number below a limit on the circle of all numbers of as many bits."""
    bits = max(2, (limit - 1).bit_length() + 1 & ~1)
    while True:
        number = _next_in_pool(number, bits, key)
        if number < limit:
            return number


def _country(phone: str) -> int:
    """How many digits of a number are taken for its country's code."""
    return 1 if phone[0] == "1" else 2


def _private(normal: str, key: bytes) -> str:
    """The address of the same private network that stands for this one."""
    bits = _private_bits(normal)
    number = int.from_bytes(map(int, normal.split(".")), "big")
    free = number & ((1 << bits) - 1)
    return ".".join(map(str, (number - free + _next_in_pool(free, bits, key)).to_bytes(4, "big")))


def _ipv6(draw: _Draw, normal: str) -> str:
    """An address whose groups are as long as the given one's without leading zeros; zero stays zero."""
    made = []
    for group in normal.split(":"):
        digits = group.lstrip("0")
        number = "".join(draw.of("0123456789abcdef" if i else "123456789abcdef") for i in range(len(digits)))
        made.append(number.rjust(4, "0"))
    return ":".join(made)


def _ipv6_written(mention: str, made: str) -> str:
    """The address written the way the mention is: its double colon, its leading zeros."""
    before, colons, after = mention.partition("::")
    groups, tail = made.split(":"), after.split(":") if after else []
    written = [g[-len(own) :] for own, g in zip(before.split(":"), groups)]
    ending = [g[-len(own) :] for own, g in zip(tail, groups[8 - len(tail) :])]
    return ":".join(written) + colons + ":".join(ending)


def _card(draw: _Draw, normal: str) -> str:
    body = normal[0] + "".join(str(draw.below(10)) for _ in normal[2:])
    right = next(c for c in "0123456789" if _luhn(body + c))
    if _luhn(normal):
        return body + right
    return body + draw.of([c for c in "0123456789" if c != right])


def _iban(draw: _Draw, normal: str) -> str:
    body = _same_classes(draw, normal[4:])
    number = int("".join(str(int(c, 36)) for c in body + normal[:2] + "00"))
    return f"{normal[:2]}{98 - number % 97:02d}{body}"


def stand_in(kind: str, normal: str, key: bytes, attempt: int = 0) -> str:
    """The normal form that replaces an entity: same key, entity and attempt, same result.

    Attempt ``CLOSED``, for formats that have a ``pool``, takes the next value of the whole format instead of drawing one.
    """
    if attempt == CLOSED:
        return _next_of_format(kind, normal, key)
    draw = _Draw(key, f"{kind}|{attempt}|{normal}")
    if kind == "email":
        local, _, domain = normal.partition("@")
        *labels, _, last = domain.split(".")
        # within the domains reserved for examples, which belong to nobody
        reserved = ["example", last if last in ("com", "net", "org") else "com"]
        return f"{_same_classes(draw, _longer(local, attempt))}@" + ".".join([_same_classes(draw, x) for x in labels] + reserved)
    if kind == "ipv4":
        return _private(normal, key) if _private_bits(normal) else _ipv4(draw)
    if kind == "card":
        return _card(draw, normal)
    if kind == "iban":
        return _iban(draw, normal)
    if kind == "phone":
        country = _country(normal)
        return normal[:country] + "".join(str(draw.below(10)) for _ in normal[country:])
    if kind == "ssn":
        return f"{1 + draw.below(665):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "ipv6":
        return _ipv6(draw, normal)
    if kind == "initial":
        return _turned(next(line for line in INITIALS if normal.upper() in line), normal, key)
    if kind in ("surname", "given_m", "given_f"):
        script = script_of(normal)
        gender = kind.removeprefix("given_") if kind != "surname" else ""
        names = GIVEN.get((script, gender), [])
        if normal in [n.lower() for n in names]:
            return _turned(names, normal, key)
        return _name(draw, script, gender, attempt)
    return _same_classes(draw, _longer(normal, attempt))


def _turned(names: list[str] | str, normal: str, key: bytes) -> str:
    """The next name on a circle in keyed order: different names stay different, none stays itself."""
    circle = sorted((hmac.new(key, n.lower().encode(), hashlib.sha256).digest(), n.lower()) for n in names)
    place = [n for _, n in circle].index(normal)
    return circle[(place + 1) % len(circle)][1]


def listed(kind: str, normal: str) -> bool:
    """Whether the stand-in comes from a closed pool, where a circle keeps entities apart."""
    if kind == "ipv4":
        return _private_bits(normal) > 0
    return kind == "initial" or kind.startswith("given_") and normal in {n.lower() for n in GIVEN.get((script_of(normal), kind[-1]), [])}


def rendered(mention: str, kind: str, made: str) -> str:
    """A stand-in in the format of a mention: its separators, its letter case."""
    if kind in ("phone", "card", "ssn"):
        digits = list(made)[-sum(c.isdigit() for c in mention) :]
        return "".join(digits.pop(0) if c.isdigit() else c for c in mention)
    if kind == "iban":
        letters = list(made)
        return "".join(c if c == " " else letters.pop(0) for c in mention)
    if kind == "ipv6":
        made = _ipv6_written(mention, made)
    if kind in ("email", "secret", "ipv6") and mention.upper() == mention:
        return made.upper()
    if kind in ("surname", "given_m", "given_f", "initial"):
        return made.upper() if mention.isupper() and len(mention) > 1 else made[0].upper() + made[1:]
    if kind == "email" and mention[0].isupper():
        return made[0].upper() + made[1:]
    return made
