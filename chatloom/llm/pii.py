"""Personal information in free text (p3): found by patterns, confirmed by checksums, weighed by context.

Patterns propose spans. Checksums (Luhn, mod 97, mod 23, mod 11, mod 11-2, 7-3-1 weights) confirm
identity numbers; proposals without a checksum of their own need a telling format or a context word,
and words like "build" or "ticket" before a number speak against it. Names are pairs from a lexicon
of given and family names that is fitted to the display names of the authors.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.plans.lineage import Cuts

KINDS = ("email", "phone", "id_number", "address", "person_name")
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "person_name": "[NAME]"}
HELD = 200_000  #: a task hands on its counts of words and pairs when it holds so many
MOST_PAIRS = 3_000_000  #: different pairs that may be names; more (some 500 MB on the driver) are refused with an error
PAIR_SHARE = 0.05  #: a part of a name stands in pairs at least so often when capitalised; "Week I" across sentences is rarer

# --- checksums ----------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        n = int(ch) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return len(digits) > 1 and total % 10 == 0


def mod97_iban(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def mod97_nir(digits: str) -> bool:
    return len(digits) == 15 and 97 - int(digits[:13]) % 97 == int(digits[13:])


def mod23_dni(text: str) -> bool:
    number = text[:-1].upper()
    if number[0] in "XYZ":
        number = str("XYZ".index(number[0])) + number[1:]
    return number.isdigit() and "TRWAGMYFPDXBNJZSQVHLCKE"[int(number) % 23] == text[-1].upper()


def mod11_cpf(digits: str) -> bool:
    if len(digits) != 11 or len(set(digits)) == 1:
        return False
    for n in (9, 10):
        rest = sum(int(digits[i]) * (n + 1 - i) for i in range(n)) * 10 % 11 % 10
        if rest != int(digits[n]):
            return False
    return True


def mod11_2_resident(text: str) -> bool:
    if not ("1800" <= text[6:10] <= "2199" and "01" <= text[10:12] <= "12" and "01" <= text[12:14] <= "31"):
        return False
    weights = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2)
    return "10X98765432"[sum(int(a) * b for a, b in zip(text, weights)) % 11] == text[17].upper()


def weights_731(text: str) -> bool:
    total = sum(int(c, 36) * (7, 3, 1)[k % 3] for k, c in enumerate(text[:-1]))
    return text[-1].isdigit() and total % 10 == int(text[-1])


# --- patterns -----------------------------------------------------------------------------------

_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?"
_EMAIL = re.compile(
    rf"(?<![\w.+\-/@])(?P<local>\w[\w.+\-]*)(?:[@＠](?P<host>{_LABEL}(?:\.{_LABEL})*\.[A-Za-z]{{2,}})(?![\w@])"
    rf"|\s?(?:\(at\)|\[at\]|\{{at\}}|<at>)\s?(?P<h2>{_LABEL}(?:\s?(?:\(dot\)|\[dot\]|\{{dot\}}|<dot>|\.)\s?{_LABEL})*\s?(?:\(dot\)|\[dot\]|\{{dot\}}|<dot>|\.)\s?[A-Za-z]{{2,}})\b"
    rf"| (?:at) (?P<h3>{_LABEL}(?: dot {_LABEL})* dot [A-Za-z]{{2,}})\b)",
    re.I,
)
_LOGIN_BEFORE = re.compile(r"(?:\b(?:ssh|scp|sftp|rsync|mosh|clone|remote add \w+|push|pull|fetch)\s+(?:-\S+\s+)*|://)$", re.I)

_DIGITS = re.compile(r"(?<![\w@/#.\-+(])(?:\+\s?)?\(?\d[\d \t ().\-]{5,22}\d(?![\w@]|[.\-/:]\d)")
# Shapes of national phone numbers, blanks for white space.
_PHONE_SHAPES = re.compile(
    r"\+\d{1,3}[ .\-]?(?:\(?\d{1,5}\)?[ .\-]?){1,6}\d+"  # with a country code
    r"|00[1-9]\d{0,2}[ .\-](?:\(?\d{1,5}\)?[ .\-]?){1,6}\d+"
    r"|(?:1[ .\-])?(?:\(\d{3}\) ?|\d{3}[.\-])\d{3}[ .\-]\d{4}|1[ .]\d{3}[ .]\d{3}[ .]\d{4}|\d{3} \d{3} \d{4}|1?[2-9]\d{9}"  # North America
    r"|\d{3}[.\-]\d{4}"  # a local number
    r"|0\d{4} \d{6}|0\d{3} \d{3} \d{4}|0\d{4} \d{3} \d{3}|07\d{9}"  # United Kingdom
    r"|0[1-9](?:[ .\-]?\d{2}){4}"  # France
    r"|[6789]\d{2}(?:[ .\-]?\d{3}){2}|[6789]\d{2}(?:[ .\-]\d{2}){3}"  # Spain
    r"|\(0\d{2,4}\) ?\d{3,8}(?:[ \-]?\d{1,5})?|0\d{2,4}[ /\-]\d{3,8}(?:[ \-]?\d{1,5})?|01[567]\d{8,9}"  # Germany
    r"|8 ?\(?\d{3}\)? ?\d{3}[ \-]?\d{2}[ \-]?\d{2}|8 ?\(\d{3}\) ?\d{3}[ \-]\d{4}|8[ \-]\d{3}[ \-]\d{3}[ \-]\d{2}[ \-]\d{2}"  # Russia
    r"|1\d{2}[ \-]?\d{4}[ \-]?\d{4}"  # China
    r"|\(\d{2}\) ?9?\d{4}[ \-]?\d{4}|\d{2} ?9\d{4}[ \-]?\d{4}"  # Brazil
)
_PHONE_WORDS = re.compile(
    r"phone|call|text|\btel\b|mobile|mobil|cell|whatsapp|\bfax\b|number is|reach|dial|ring|answers at|numéro est|appel|téléphone|portable|número es|teléfono|llam|móvil"
    r"|telefone|telemóvel|celular|lig(?:ue|a)|nummer|ruf|telefon|handy|erreichbar|номер|звони|телефон|моб|тел\.|电话|手机|拨打|致电|\bor\b|\boder\b|\bvia\b",
    re.I,
)
_ID_WORDS = re.compile(
    r"\bID\b|\bid\b|identity|identit|passport|passeport|pasaporte|passaporte|паспорт\w*|\w*ausweis\w*|documento|\bdni\b|\bnie\b|\bcpf\b|\bssn\b|social security|national insurance"
    r"|\bnino\b|sécurité sociale|formulaire|carte|\bcard\b|tarjeta|\bcart[ãa]o\b|kreditkarte|bankkarte|карт[аеоуы]\w*|信用卡|银行卡|证件|身份证|护照|licence number|driver|steuer|tax",
    re.I,
)
# Words that make the number after them no phone or identity number.
_NOT_BEFORE = re.compile(
    r"(?:\b(?:build|ticket|order|rfc|sha|commit|room|line|uid|gid|ping|port|version|issue|pr|error|pkg|rev|revision|job|run|row|page|step|epoch|isbn|issn|doi|hash|checksum|bug|case|task|pid|seed|offset|bytes?)"
    r"(?: (?:no\.?|number|nr\.?|id))?[ #:=]*|\bGH-|#|\b0x|\bv)$",
    re.I,
)
_DATE = re.compile(r"(?:19|20)\d{2}[.\-/ ]\d{1,2}[.\-/ ]\d{1,2}(?:[ T]\d.*)?$|\d{1,2}[.\-/]\d{1,2}[.\-/](?:19|20)\d{2}$|\d{1,3}(?:\.\d{1,3}){3}$")

_A = r"(?<![A-Za-z0-9\-])"
_Z = r"(?![A-Za-z0-9])"
# Identity numbers: pattern, checksum or None, score of the bare pattern. A right checksum adds 2, the
# nearest word that speaks of identity 2, one that speaks of telephones takes 2; 2 is needed.
_IDS = (
    (re.compile(rf"{_A}[12] \d{{2}} \d{{2}} (?:\d{{2}}|2[ABab]) \d{{3}} \d{{3}} \d{{2}}{_Z}"), lambda t: mod97_nir(re.sub(r"2[Aa]", "19", re.sub(r"2[Bb]", "18", t))), 2),
    (re.compile(rf"{_A}[12]\d{{14}}{_Z}"), mod97_nir, 0),
    (re.compile(rf"{_A}\d{{6}}(?:18|19|20|21)\d{{2}}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\d{{3}}[\dXx]{_Z}"), mod11_2_resident, 2),
    (re.compile(rf"{_A}(?:\d{{8}}|[XYZxyz][ \-]?\d{{7}})[ \-]?[A-HJ-NP-TV-Za-hj-np-tv-z]{_Z}"), mod23_dni, 1),
    (re.compile(rf"{_A}\d{{3}}\.\d{{3}}\.\d{{3}}-\d{{2}}{_Z}"), mod11_cpf, 2),
    (re.compile(rf"{_A}\d{{11}}{_Z}"), mod11_cpf, 0),
    (re.compile(rf"{_A}[A-Z]{{2}} ?\d{{2}} ?\d{{2}} ?\d{{2}} ?[A-D]{_Z}"), None, 2),
    (re.compile(rf"{_A}\d{{3}}([ \-])\d{{2}}\1\d{{4}}{_Z}"), None, 2),
    (re.compile(rf"{_A}[CFGHJ-NPRTV-Z][0-9CFGHJ-NPRTV-Z]{{7,8}}\d{_Z}"), weights_731, 0),
    (re.compile(rf"{_A}(?:\d{{4}}|\d{{2}} \d{{2}}) ?№ ?\d{{6}}{_Z}"), None, 2),
    (re.compile(rf"{_A}(?:\d{{4}}|\d{{2}} \d{{2}}) \d{{6}}{_Z}"), None, 0),
    (re.compile(rf"{_A}[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?{_Z}"), mod97_iban, 0),
    (re.compile(rf"{_A}\d{{4}}(?:[ \-]?\d{{4}}){{3}}{_Z}"), luhn, -1),
    (re.compile(rf"{_A}[A-Z]{{1,2}}\d{{6,8}}{_Z}"), None, 0),
)


def _leaning(before: str) -> int:
    """2 if the nearest telling word before a number speaks of identity, -2 if of telephones, 0 without one."""
    told = [max((m.end() for m in words.finditer(before)), default=-1) for words in (_ID_WORDS, _PHONE_WORDS)]
    return 0 if told == [-1, -1] else 2 if told[0] >= told[1] else -2


_UP = r"A-ZÀ-ÖØ-ÞŒ"
_CAP = rf"[{_UP}][\w'’\-]*"
_TOWN = rf"{_CAP}(?:[ \-](?:{_CAP}|(?:sur|sous|am|an|der|de|do|da|del|la|le|les|las|los|en|im|upon|on)(?=[ \-])))*"
_EN_STREET = r"(?:Street|St\.?|Road|Rd\.?|Row|Close|Drive|Dr\.?|Avenue|Ave\.?|Lane|Ln\.?|Court|Ct\.?|Place|Pl\.?|Square|Sq\.?|Way|Terrace|Crescent|Hill|Gardens|Grove|Walk|Mews|Boulevard|Blvd\.?|Parkway|Highway|Alley|Green|Park|Rise|View|Yard)"
_EN_NAME = rf"(?:{_CAP} ){{1,4}}{_EN_STREET}\b"
_FLAT = r"(?:Flat|Apartment|Apt\.?|Unit|Suite|Room|Floor)"
_DE_PREFIX = r"(?:(?:Am|An der|An den|Auf dem|Auf der|Im|In der|In den|Zum|Zur|Unter den|Unter der|Vor dem|Hinter dem|Bei der|Beim|Hinter der|Alter?|Alte[rs]?|Neue[rs]?|Große|Kleine|Obere|Untere) )"
_ADDRESSES = (
    # flat and number before the street, or the number after it; then the town or a postcode
    re.compile(rf"\b(?:{_FLAT} ?\d+\w?,? )?\d{{1,5}}[A-Za-z]?,? {_EN_NAME}(?:,? {_FLAT} ?#?\d+\w?)?(?:(?:, | in ){_TOWN}(?:,? (?:[A-Z]{{2}} )?\d{{5}})?)?"),
    re.compile(rf"\b(?:{_FLAT} ?\d+\w?,? )?{_EN_NAME} \d{{1,5}}[A-Za-z]?(?:,? {_FLAT} ?#?\d+\w?)?(?:,? {_TOWN}(?: \d{{5}})?)"),
    # German: street, number, postcode, town
    re.compile(rf"(?:\b{_DE_PREFIX})?\b(?:{_CAP} ){{0,2}}?{_CAP} \d{{1,4}} ?[a-z]?\b(?:,| in|,? in) (?:D-)?\d{{5}} {_TOWN}"),
    # French: number, way, town
    re.compile(rf"\b\d{{1,4}},? ?(?:(?:bis|ter|quater),? )?(?:rue|avenue|av\.|boulevard|bd|place|quai|impasse|allée|allées|chemin|route|cours|square|passage|sentier|villa|faubourg|cité|esplanade|promenade|voie|ruelle) [^,\n\d]{{2,60}}?, (?:\d{{5}} )?{_TOWN}", re.I),
    # Spanish and Portuguese: way, number, door, postcode, town
    re.compile(rf"\b(?:Calle|C/|Plaza|Pza\.?|Paseo|P\.º|Avenida|Avda\.?|Av\.|Camino|Carretera|Ronda|Travesía|Callejón|Cuesta|Glorieta|Rambla|Vía|Pasaje) [^,\n\d]{{2,60}}?,? (?:n\.? ?[º°o]\.? ?)?\d{{1,4}}\w?(?:, [^,\n]{{1,20}})??, (?:\d{{5}} )?{_TOWN}", re.I),
    re.compile(rf"\b(?:Rua|R\.|Travessa|Tv\.|Alameda|Avenida|Av\.|Praça|Largo|Estrada|Rodovia|Beco|Ladeira|Viela|Via|Quadra) [^,\n\d]{{2,60}}?(?:,| n[º°o]\.?)? ?\d{{1,5}}\w?(?:, (?:Apto?\.?|Bloco|Casa|Sala|Andar)[^,\n]{{0,20}})?(?:,| -| –) (?:\d{{5}}-?\d{{3}} )?{_TOWN}", re.I),
    # Russian: parts with their abbreviations, in either order
    re.compile(r"(?<!\w)(?:\d{6}, ?)?(?:г(?:\.|ород) ?[А-ЯЁ][\w\-]+(?: [А-ЯЁ][\w\-]+)?, ?)?(?:ул(?:\.|ица)|пр(?:-т|\.|оспект)|пер(?:\.|еулок)|пл(?:\.|ощадь)|б(?:-р|ульвар)|наб(?:\.|ережная)|ш(?:\.|оссе)|проезд|аллея) ?[^,\n]{2,40}, ?(?:д(?:\.|ом) ?)?\d{1,4}\w?(?:, ?(?:корп|стр|к)\.? ?\d+)?(?:, ?(?:кв(?:\.|артира) ?)\d+)?(?:, ?г(?:\.|ород) ?[А-ЯЁ][\w\-]+)?", re.I),
    # Chinese: city, street, number, unit, room
    re.compile(r"(?:[一-鿿]{2,8}?省)?(?:(?:(?<![一-鿿])|(?<=[到在是于址往至：]))[一-鿿]{2,7}?市)(?:[一-鿿]{1,6}?[区县])?[一-鿿]{1,12}?(?:路|街|巷|道|大道|胡同|弄)\d{1,5}号(?:\d+(?:号楼|栋|幢|座))?(?:\d+单元)?(?:\d+室)?"),
)
_ADDRESS_HINT = re.compile(rf"\d[^\n]*,|,[^\n]*\d|号|\d\w? (?:in|-|–) |\d[A-Za-z]? [^\n\d]*{_EN_STREET}\b")

# --- names --------------------------------------------------------------------------------------

_TOKEN = re.compile(r"[^\W\d_]+(?:[\-'’][^\W\d_]+)*")
_DECORATION = re.compile(r"\[[^\]]*\]|\([^)]*\)|\|.*|_\w+$|[^\w\s.,'’\-]")
# Titles before names.
TITLES = frozenset("dr prof professor mr mrs ms miss mx sir herr frau mme mlle m sr sra srta dra doña don dona senhor senhora д-р г-н г-жа проф phd md".split())
_HAN_NAME = re.compile("^[一-鿿]{2,4}$")


def fold(word: str) -> str:
    """Case and accents folded."""
    text = word.casefold()
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@dataclass
class Names:
    """Folded given and family names; Chinese names by surname and given part."""

    given: frozenset[str]
    family: frozenset[str]
    han_family: frozenset[str]
    han_given: frozenset[str]


def _core(edges: set[tuple[str, str]]) -> set[tuple[str, str]]:
    """Edges left when every given name has two family names and every family name two given ones."""
    while True:
        left, right = defaultdict(set), defaultdict(set)
        for a, b in edges:
            left[a].add(b)
            right[b].add(a)
        kept = {(a, b) for a, b in edges if len(left[a]) > 1 and len(right[b]) > 1}
        if len(kept) == len(edges):
            return kept
        edges = kept


_LOW = "a-zß-öø-ÿа-яё"  #: no word that begins with one of these is in title case
_PAIR = re.compile(rf"(?<![\w@.\-])(?=([^\W\d_{_LOW}][^\W\d_]*(?:-[^\W\d_]+)?) ([^\W\d_{_LOW}][^\W\d_]*(?:-[^\W\d_]+)?)(?![\w@]))")
_LOCAL = re.compile(r"(?<![\w.+\-])([A-Za-z]{3,})[.\-]([A-Za-z]{3,})(?=[@＠]| ?[(\[{]at| AT )")
_LONE_HAN = re.compile(r"(?<= )[\u4e00-\u9fff]{2,4}(?= )")


@dataclass
class Evidence:
    """What texts and display names say of names, as counts and sets that can be united."""

    pairs: Counter[tuple[str, str]] = field(default_factory=Counter)  #: of texts: capitalised words, parts of mail logins
    shown: Counter[str] = field(default_factory=Counter)  #: words of texts as written
    named: set[tuple[str, str]] = field(default_factory=set)  #: of display names: given, family
    han: set[tuple[str, str]] = field(default_factory=set)  #: Chinese names: surname, given part

    def read(self, text: str | None) -> None:
        if not text:
            return
        self.shown.update(_TOKEN.findall(text))
        self.pairs.update(_PAIR.findall(text))
        for m in _LOCAL.finditer(text):
            self.pairs[m[1].title(), m[2].title()] += 1
        if not text.isascii():
            for m in _LONE_HAN.finditer(text):
                self.han.add((m[0][0], m[0][1:]))

    def name(self, text: str | None) -> None:
        if not text or any(c.isdigit() for c in text):
            return
        if "@" in text:
            self.named |= {(m[1].lower(), m[2].lower()) for m in _LOCAL.finditer(text)}
            return
        bare = _DECORATION.sub(" ", text).strip()
        if _HAN_NAME.match(bare.split()[-1] if bare.split() else ""):
            name = bare.split()[-1]
            self.han.add((name[0], name[1:]))
            return
        swapped = "," in bare
        words = [w for w in _TOKEN.findall(bare) if fold(w) not in TITLES and len(w) > 1]
        if swapped and len(words) >= 2:
            words = words[1:] + words[:1]
        if len(words) == 2 or len(words) == 3:
            self.named |= {(fold(w), fold(words[-1])) for w in words[:-1]}

    def __len__(self) -> int:
        return len(self.pairs) + len(self.shown) + len(self.named) + len(self.han)

    def rows(self) -> list[tuple[str, str, str, int, int]]:
        """(kind, a, b, times in lower case, other times); words and pairs are folded."""
        shown: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for word, n in self.shown.items():
            shown[fold(word)][word[:1].isupper()] += n
        pairs: Counter[tuple[str, str]] = Counter()
        for (a, b), n in self.pairs.items():
            if a.istitle() and b.istitle() and len(a) > 1 and len(b) > 1:
                pairs[fold(a), fold(b)] += n
        out = [("word", w, "", low, high) for w, (low, high) in shown.items()] + [("pair", a, b, 0, n) for (a, b), n in pairs.items()]
        return out + [(kind, a, b, 0, 0) for kind, some in (("named", self.named), ("han", self.han)) for a, b in some]


def _usual(pairs: list[tuple[str, str, int, int, int]]) -> set[tuple[str, str]]:
    """Of (a, b, times, times a is capitalised, times b is) the pairs whose words both stand in pairs
    on their side as often as parts of names do."""
    first: Counter[str] = Counter()
    second: Counter[str] = Counter()
    for a, b, n, _, _ in pairs:
        first[a] += n
        second[b] += n
    return {(a, b) for a, b, _, shown_a, shown_b in pairs if first[a] >= PAIR_SHARE * shown_a and second[b] >= PAIR_SHARE * shown_b}


def _lexicon(edges: set[tuple[str, str]], han: set[tuple[str, str]]) -> Names:
    """Words that combine freely with each other, as given and family names do and nicknames, places
    and headings don't. A word is a given name if it stands before more different words than after,
    else a family name."""
    edges = {(a, b) for a, b in edges if a != b and a not in TITLES and b not in TITLES}
    before, after = defaultdict(set), defaultdict(set)
    for a, b in edges:
        before[a].add(b)
        after[b].add(a)
    is_given = {w for w in before if len(before[w]) > len(after.get(w, ()))}
    given, family = _grown({(a, b) for a, b in edges if a in is_given and b not in is_given})
    han_family, han_given = _grown(han)
    return Names(frozenset(given), frozenset(family), frozenset(han_family), frozenset(han_given))


def fit_names(display_names: Iterable[str | None], texts: Iterable[str | None] = ()) -> Names:
    """The lexicon from words of display names, mail logins and capitalised pairs in texts."""
    told = Evidence()
    for text in texts:
        told.read(text)
    for text in display_names:
        told.name(text)
    rows = told.rows()
    shown = {a: (low, high) for kind, a, _, low, high in rows if kind == "word"}
    common = {w for w, (low, high) in shown.items() if low > high}
    times = lambda w: shown.get(w, (0, 0))[1]
    pairs = [(a, b, n, times(a), times(b)) for kind, a, b, _, n in rows if kind == "pair" and a not in common and b not in common]
    return _lexicon(_usual(pairs) | told.named, told.han)


def _grown(edges: set[tuple[str, str]], rounds: int = 2) -> tuple[set[str], set[str]]:
    """Both sides of the core of freely combining words, and the words that combine with one of it."""
    core = _core(edges)
    left, right = {a for a, _ in core}, {b for _, b in core}
    for _ in range(rounds):
        left, right = left | {a for a, b in edges if b in right}, right | {b for a, b in edges if a in left}
    return left, right


def _gap(text: str, a: int, b: int) -> str:
    """What lies between two tokens: blank, initial, comma or other."""
    between = text[a:b]
    if not between.strip(" \t "):
        return "blank" if between else "other"
    if re.fullmatch(r"[ \t ]+(?:[^\W\d_]\.[ \t ]*)+", between):
        return "initial"
    if re.fullmatch(r" ?,[ \t ]+", between):
        return "comma"
    return "other"


def find_names(text: str, names: Names) -> list[tuple[int, int]]:
    """Spans of a given with a family name, in any order and case, titles left out."""
    out: list[tuple[int, int]] = []
    if not text.isascii() and names.han_given:
        for m in re.finditer("[一-鿿]+", text):
            run, k = m.group(), 0
            while k < len(run) - 1:
                if run[k] in names.han_family:
                    for size in (3, 2, 1):
                        if run[k + 1 : k + 1 + size] in names.han_given and len(run) >= k + 1 + size:
                            whole = k == 0 and k + 1 + size == len(run)
                            if size > 1 or whole:
                                out.append((m.start() + k, m.start() + k + 1 + size))
                                k += size
                            break
                k += 1
    tokens = [(m.start(), m.end(), fold(m.group())) for m in _TOKEN.finditer(text)]
    if not any(w in names.family for _, _, w in tokens):
        return out
    # Letters followed by a full stop are initials, not tokens of a name.
    tokens = [t for t in tokens if not (t[1] - t[0] == 1 and text[t[1] : t[1] + 1] == ".")]
    joined = lambda i: text[tokens[i][0] - 1 : tokens[i][0]] in ("@", "_", "/", ".", "=", "+") and tokens[i][0] > 0 and text[tokens[i][0] - 1] != "="
    glued = lambda i: text[tokens[i][1] : tokens[i][1] + 1] in ("@", "/", "+") and tokens[i][1] < len(text)
    i, n = 0, len(tokens)
    while i < n:
        _, end, word = tokens[i]
        if word in names.given and not joined(i):
            j = i
            while j + 1 < n and tokens[j + 1][2] in names.given and tokens[j + 1][2] not in names.family and _gap(text, tokens[j][1], tokens[j + 1][0]) in ("blank", "initial"):
                j += 1
            if j + 1 < n and tokens[j + 1][2] in names.family and _gap(text, tokens[j][1], tokens[j + 1][0]) in ("blank", "initial") and not glued(j + 1):
                out.append((tokens[i][0], tokens[j + 1][1]))
                i = j + 2
                continue
        if word in names.family and not joined(i) and i + 1 < n and tokens[i + 1][2] in names.given and _gap(text, end, tokens[i + 1][0]) in ("blank", "comma") and not glued(i + 1):
            nxt = i + 2 < n and tokens[i + 2][2] in names.family and _gap(text, tokens[i + 1][1], tokens[i + 2][0]) in ("blank", "initial")
            if not nxt:  # else the given name belongs to the family name after it
                last = i + 1
                while last + 1 < n and tokens[last + 1][2] in names.given and _gap(text, tokens[last][1], tokens[last + 1][0]) == "blank":
                    last += 1
                out.append((tokens[i][0], tokens[last][1]))
                i = last + 1
                continue
        i += 1
    return out


# --- all kinds ----------------------------------------------------------------------------------

_AT_HINT = re.compile(r"[@＠]|[(\[{<]at[)\]}>]| at ", re.I)


def find(text: str | None, names: Names) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of personal information, in order, without overlaps."""
    if not text:
        return []
    taken: list[tuple[int, int, str]] = []

    def free(a: int, b: int) -> bool:
        return all(b <= s or e <= a for s, e, _ in taken)

    if _AT_HINT.search(text):
        for m in _EMAIL.finditer(text):
            end = m.end()
            host = m.group("host")
            if host and (text[end : end + 1] == ":" and text[end + 1 : end + 2].strip() or _LOGIN_BEFORE.search(text[max(0, m.start() - 40) : m.start()])):
                continue
            taken.append((m.start(), end, "email"))
    if any(c.isdigit() for c in text):
        if _ADDRESS_HINT.search(text):
            for pattern in _ADDRESSES:
                for m in pattern.finditer(text):
                    if free(m.start(), m.end()):
                        taken.append((m.start(), m.end(), "address"))
        for pattern, checksum, score in _IDS:
            for m in pattern.finditer(text):
                a, b = m.span()
                if not free(a, b):
                    continue
                before = text[max(0, a - 60) : a]
                if _NOT_BEFORE.search(before):
                    continue
                if checksum is not None and checksum(re.sub(r"[ .\-]", "", m.group())):
                    score_here = score + 2
                else:
                    score_here = score
                if score_here + _leaning(before) >= 2:
                    taken.append((a, b, "id_number"))
        for m in _DIGITS.finditer(text):
            a, b = m.span()
            shown = re.sub(r"[\t ]", " ", m.group())
            if not free(a, b) or _DATE.match(shown):
                continue
            digits = sum(c.isdigit() for c in shown)
            before, after = text[max(0, a - 45) : a], text[b : b + 30]
            if not 7 <= digits <= 15 or _NOT_BEFORE.search(before):
                continue
            shaped = _PHONE_SHAPES.fullmatch(shown) is not None
            told = _PHONE_WORDS.search(before) is not None or _PHONE_WORDS.search(after) is not None
            marked = shown[0] in "+(" or shown.startswith("00") and digits > 10 or bool(re.search(r"\d[.\- ]\d{3}[.\- ]\d{4}$", shown))
            if shaped and (told or marked) or told and marked:
                if _leaning(before) > 0 and not marked:
                    continue
                taken.append((a, b, "phone"))
    for a, b in find_names(text, names):
        if free(a, b):
            taken.append((a, b, "person_name"))
    return sorted(taken)


def redact(text: str | None, names: Names) -> str | None:
    """The text with a typed placeholder for each item; the rest stays as it is."""
    if not text or not (found := find(text, names)):
        return text
    out, at = [], 0
    for a, b, kind in found:
        out += [text[at:a], PLACEHOLDERS[kind]]
        at = b
    return "".join(out) + text[at:]


def fit_lexicon(columns: list[tuple[DataFrame, str]], texts: tuple[DataFrame, str] | None = None) -> Names:
    """The lexicon from display-name columns and a text column, as fit_names() makes it of all their
    different values.

    All rows and whole texts are read; equal ones count once. Counts and pairs are united by tasks, and
    which pairs may be names is found by joins; the driver gets these, MOST_PAIRS at most, as the lexicon is one
    model that every worker holds. Empty tables give an empty lexicon.
    """

    def gather(batches):
        import pyarrow as pa

        def handed(told):
            rows = told.rows()
            for k in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 20_000]), (*[pa.string()] * 3, pa.int64(), pa.int64()))], names=["kind", "a", "b", "low", "high"])

        told = Evidence()
        for batch in batches:
            for is_name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (told.name if is_name else told.read)(text)
            if len(told) > HELD:
                yield from handed(told)
                told = Evidence()
        yield from handed(told)

    values = None
    for is_name, (df, column) in [*((True, c) for c in columns), *([(False, texts)] if texts is not None else [])]:
        part = df.select(F.lit(is_name).alias("is_name"), F.col(column).alias("v")).where(F.col("v").isNotNull())
        values = part if values is None else values.unionByName(part)
    cuts = Cuts(values.sparkSession, "names")
    parts = values.distinct().mapInArrow(gather, "kind string, a string, b string, low bigint, high bigint")
    counts, place = cuts.cut(parts.groupBy("kind", "a", "b").agg(F.sum("low").alias("low"), F.sum("high").alias("high")))
    pairs = counts.where(F.col("kind") == "pair").select("kind", "a", "b", F.col("high").alias("n"))
    for side in ("a", "b"):
        words = counts.where(F.col("kind") == "word").select(F.col("a").alias("w"), F.col("low").alias(f"low_{side}"), F.col("high").alias(f"shown_{side}"))
        pairs = pairs.join(words, F.col(side) == F.col("w"), "left").drop("w").fillna(0, [f"low_{side}", f"shown_{side}"]).where(F.col(f"low_{side}") <= F.col(f"shown_{side}"))
    # Of the pairs of texts those are kept whose words both stand in pairs often enough, as in _usual().
    pairs, pairs_at = cuts.cut(pairs)
    usual = pairs
    for side in ("a", "b"):
        often = pairs.groupBy(F.col(side).alias("w")).agg(F.sum("n").alias("paired"))
        usual = usual.join(often, F.col(side) == F.col("w")).where(F.col("paired") >= PAIR_SHARE * F.col(f"shown_{side}")).drop("w", "paired")
    rest = counts.where(F.col("kind").isin("named", "han")).select("kind", "a", "b")
    found = usual.select("kind", "a", "b").unionByName(rest).limit(MOST_PAIRS + 1).toArrow()
    if found.num_rows > MOST_PAIRS:
        raise ValueError(f"more than {MOST_PAIRS} pairs of words that may be names")
    cuts.drop(place, pairs_at)
    sets: dict[str, set[tuple[str, str]]] = defaultdict(set)
    for kind, first, second in zip(*(found.column(k).to_pylist() for k in range(3))):
        sets[kind].add((first, second))
    return _lexicon(sets["pair"] | sets["named"], sets["han"])


def items(df: DataFrame, row: str, fields: tuple[str, ...], names: Names) -> DataFrame:
    """One row per item: `row`, `field`, `pii_kind`, `start_pos`, `end_pos` (code points, end exclusive).

    Null and empty texts have no items. Whole texts are read, whatever their length. Other columns are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast(names)

    def run(batches):
        import pyarrow as pa

        lexicon = shared.value
        short: dict[str, list[tuple[int, int, str]]] = {}  # display names and short lines recur
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: tuple[list, ...] = ([], [], [], [], [])
            for k, field in enumerate(fields):
                for i, text in zip(ids, batch.column(1 + k).to_pylist()):
                    if not text:
                        continue
                    if len(text) <= 64:
                        if (found := short.get(text)) is None:
                            if len(short) > 100_000:
                                short.clear()
                            found = short[text] = find(text, lexicon)
                    else:
                        found = find(text, lexicon)
                    for a, b, kind in found:
                        for column, value in zip(out, (i, field, kind, a, b)):
                            column.append(value)
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=[row, "field", "pii_kind", "start_pos", "end_pos"])

    schema = f"`{row}` bigint, field string, pii_kind string, start_pos bigint, end_pos bigint"
    return df.select(F.col(row).cast("bigint").alias(row), *[F.col(f).cast("string").alias(f"f{k}") for k, f in enumerate(fields)]).mapInArrow(run, schema)


def redacted(df: DataFrame, fields: tuple[str, ...], names: Names) -> DataFrame:
    """`df` with the fields replaced by their redacted texts; all other columns stay."""
    shared = df.sparkSession.sparkContext.broadcast(names)
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("string")
    def clean(column):
        import pyarrow as pa

        return pa.array([redact(t, shared.value) for t in column.to_pylist()], pa.string())

    return df.withColumns({f: clean(F.col(f)) for f in fields})
