"""Personal information in free text by a skip-chain conditional random field.

Patterns propose candidate spans of each kind, generously.  The tokens of the
candidates of a document are the nodes of a conditional random field with the
labels O, B-kind and I-kind; every other token can only be O.  Node potentials
weigh a candidate's form and the classes of the words around it.  Chain edges
join the tokens of a span and the spans that follow one another within a line.
Skip edges join equal and similar tokens of distant candidates, so that a
mention that says too little alone is settled by one that says more.  Loopy
message passing alternates exact passes over the chains with messages over the
skip edges.

All weights, those of nodes, chain edges and skip edges, are learned together
by the likelihood of whole documents that a rule-based generator writes and
labels (``letters``); no sentence of it comes from a corpus.  Given names known
from a table of authors are a feature, looked up in a bitmap of fixed size that
holds all of them; a name that is not in it is proposed after a word that
announces a person, and wherever the same name stands again.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.session import spread

KINDS = ("email", "phone", "id_number", "address", "name")
LABELS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
KIND_OF = np.array([0, *[1 + i // 2 for i in range(2 * len(KINDS))]])
ROUNDS = 4
LONGEST_CHAIN = 512
LONGEST_GAP = 24
NAME_BITS = 23
BATCH = 400

# Words of streets, numbers and persons in several languages.
STREET_EN = ("street", "st", "road", "rd", "lane", "ln", "avenue", "ave", "boulevard", "blvd", "close", "parade", "drive", "dr", "court", "ct", "way", "terrace", "place", "square", "crescent", "grove", "row", "walk", "hill", "gardens")
STREET_DE = ("straße", "strasse", "str", "weg", "gasse", "allee", "platz", "ring", "ufer", "damm")
STREET_FR = ("rue", "avenue", "boulevard", "place", "allée", "chemin", "impasse", "quai", "route", "cours")
STREET_ES = ("calle", "avenida", "avda", "plaza", "paseo", "camino", "carrera", "rua", "travessa", "praça", "c/")
PARTICLES = ("van der", "van den", "van de", "van", "von der", "von", "zu", "de la", "de los", "de", "del", "della", "di", "da", "dos", "du", "le", "la", "den", "ter", "al", "el", "bin", "ben")
CLASSES = {
    "id": "mrn ssn dni nie nif cpf nhs nino bsn iin passport passeport pasaporte passaporte reisepass pass insurance insured identity id card carte ausweis personalausweis security social record patient patients health medicare versicherungsnummer krankenversicherung sozialversicherungsnummer identidad seguridad sécurité assuré licence holder citizen resident national",
    "phone": "tel tél telephone téléphone phone telefon teléfono telefone fax mobile mobil móvil celular cell handy portable call calls called calling ring rang dial text reach reached contact voicemail pager hotline landline switchboard desk anrufen appeler llamar ligar home office after hours line ext",
    "other": "contract catalogue catalog cat batch lot accession issn isbn doi pmid trial nct strain grant version article protocol order invoice pp p pages vol volume kit ref reference model serial registration enrolled part item sku ticket barcode clone build firmware asset tracking parcel sample samples isolate plasmid chemical cas",
    "title": "dr prof professor mr mrs ms miss herr frau sr sra señor señora m mme mlle monsieur madame sir dame pd dott nurse sister",
    "person": "patient patientin paciente husband wife mother father daughter son brother sister-in-law aunt uncle niece nephew neighbour widow guardian carer spouse partner parent relative contact contacto kontakt signed by from to attention attn proband owner author thanks self with of according thank page dear an an: cc regards sincerely witness witnessed interviewer technician clerk physician surgeon midwife porter caller sender recipient colleague named called firma firmado unterschrift signé assinado",
    "join": "and und et y e & or",
    "eponym": "index score test staging protocol syndrome disease method sign scale classification criteria procedure model equation stain consortium investigators group party institute university pathway trial variant street road lane college hospital museum bridge prize medal valley bay beach river park island company limited ltd inc gmbh foundation library press airport station street",
    "prep": "in at for on the a as was is were near de la el le das der die den in into since until than more",
}
CLASS_OF = {word: name for name, words in reversed(CLASSES.items()) for word in words.split()}
#: Words that stand between what says what a number is and the number.
TRANSPARENT = frozenset("no nr number num numero número nummer numéro nº is was of".split())
PERSON_WORDS = frozenset(CLASSES["person"].split()) | frozenset(CLASSES["title"].split()) | frozenset(CLASSES["join"].split())

_AT = r"(?:@|＠|\s?[\[({<]\s?(?:at|AT|a)\s?[\])}>]\s?|\s(?:at|AT)\s(?=[\w-]+\s(?:dot|DOT)\s))"
_DOT = r"(?:\.|\s?[\[({<]\s?(?:dot|DOT)\s?[\])}>]\s?|\s(?:dot|DOT)\s)"
_EMAIL = re.compile(rf"(?<![\w.+%-])\w[\w.+%'-]*{_AT}\w[\w-]*(?:{_DOT}\w[\w-]*)+")
_NUMBER = re.compile(
    r"(?<![\w.‑+/@-])(?!10\.\d{4})(?:"
    r"(?:\+\d{1,3}[ \xa0-]?(?:\(\d{1,4}\)[ \xa0]?)?|\(\d{2,5}\)[ \xa0-]?)?\d(?:\.(?=\d)|[\d‑/ \xa0-]){4,20}(?<=\d)[A-Z]?"
    r"|[A-Z]{1,2}-?\d[\d-]{4,11}(?<=\d)[A-Z]?|[A-Z]\d{2}[A-Z]\d{2}[A-Z]\d{2})(?![\w@])"
)
_DIGITS = re.compile(r"\d")
_SHAPED = re.compile(r"[A-Za-z]|\d")
_WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")

_CAP = r"[^\W\d_a-zß-ÿ][\w'’]*"
_UNIT = r"(?:(?:Flat|Unit|Apt\.?|Apartment|Suite|FLAT|UNIT|APT\.?)\s\w+(?:,\s|/|\s))?"
_EN_STREET = "|".join(s.capitalize() + "|" + s.upper() for s in STREET_EN)
_ADDRESS = re.compile(
    rf"(?<![\w.,/-])(?:"
    rf"{_UNIT}\d{{1,5}}[a-zA-Z]?\s(?:[NSEW]\.\s)?(?:{_CAP}\s){{1,4}}(?:{_EN_STREET})\b(?:(?:(?<=\sSt)|(?<=\sAve)|(?<=\sAVE)|(?<=\sST))\.|\.(?=[.,]|\s[a-z]))?(?:,\s(?:Apt|Flat|Unit|Suite|APT|FLAT|UNIT)\.?\s\w+)?"
    rf"|\d{{1,5}}(?:\s(?:bis|ter))?,?\s(?:{'|'.join(STREET_FR)})\s(?:(?:de|du|des|la|le|les|l')\s?)*(?:{_CAP})(?:\s{_CAP}){{0,3}}"
    rf"|(?:{'|'.join(s.capitalize() for s in STREET_ES if s[-1].isalpha())}|C/)\s(?:(?:de|del|la|las|los|da|do|das|dos)\s)*{_CAP}(?:\s{_CAP}){{0,3}},?\s\d{{1,5}}(?:,\s\d+º\s?\w{{1,3}})?"
    rf"|{_CAP}(?:{'|'.join(STREET_DE)})\.?\s\d{{1,5}}(?:\s?[a-z])?\b"
    rf"|{_CAP}\s(?:Straße|Strasse|Str\.|Weg|Platz|Allee)\s\d{{1,5}}(?:\s?[a-z])?\b"
    rf"|(?:P\.\s?O\.\s?|PO\s|Post Office\s)(?:Box|BOX)\s\d{{1,6}}|(?:Postfach|Apartado(?:\sde\sCorreos)?|Boîte [Pp]ostale|B\.?P\.?|Caixa Postal)\s\d{{1,6}}"
    rf")"
)
_NEXT_WORD = re.compile(r"^[ \xa0]([^\W_]+)")
_PART = "|".join(PARTICLES)
_NAME_TAIL = re.compile(
    rf"(?P<middle>[\s ]+[^\W\d_]\.)?(?P<particle>[\s ]+(?:{_PART}))?[\s ]+(?P<surname>(?:[^\W\d_]['’])?[^\W\d_]{{2,}}(?:-[^\W\d_]{{2,}})*)(?![\w@])", re.IGNORECASE
)
_NAME_HEAD = re.compile(rf"(?<![\w@.'’-])(?P<surname>(?:(?:{_PART})\s)?(?:[^\W\d_]['’])?[^\W\d_]{{2,}}(?:-[^\W\d_]{{2,}})*),[\s ]+$", re.IGNORECASE)
_WORD_BEFORE = re.compile(r"([^\W_]+(?:['’-][^\W_]+)*)[^\S\n]+$")
_MIDDLE_AFTER = re.compile(r"[\s ]+[^\W\d_a-zß-ÿ]\.(?=[\s,;:)]|$)(?![\s ]+[^\W\d_a-zß-ÿ][^\W\d_]+)")
_NINES = re.compile("9+")
_MARK = re.compile(r"[,:;(|.]\s*$|^\s*$|\n\s*$")
_COMMA = re.compile(r"([^\W\d_]{2,}), $")
_EPONYM = frozenset(CLASSES["eponym"].split())
_JOINING = frozenset(("and", "und", "et", "y", "e"))
_DISGUISED = re.compile(r"[\[({<]\s?(?:at|AT|a)\s?[\])}>]|\s(?:at|AT)\s[\w-]+\s(?:dot|DOT)\s")
_PAIR = re.compile(
    r"[ \xa0](?P<name>[^\W\d_a-z\u00df-\u00ff][^\W\d_]+(?:-[^\W\d_]+)?(?:[ \xa0][^\W\d_a-z\u00df-\u00ff]\.)?(?:[ \xa0](?:" + _PART + r"))?[ \xa0](?:[^\W\d_]['\u2019])?[^\W\d_a-z\u00df-\u00ff][^\W\d_]+(?:-[^\W\d_]+)*)(?![\w@])"
)
# Words that announce a person whose name may be in no list.
ANNOUNCING = frozenset(
    "dr prof professor mr mrs ms miss herr frau sr sra mme mlle monsieur madame señor señora nurse sister pd dott med ing dear signed attn attention regards sincerely firmado signé assinado "
    "husband wife mother father daughter son brother neighbour guardian patient patientin paciente witness".split()
)
# These do so only before words in title case.
ANNOUNCING_TITLE_CASE = frozenset("thank thanks by from named called".split())
_WORD_FAST = re.compile(r"[^\W\d_]{2,}")
_TOKEN = re.compile(r"[^\W\d_]+(?:['\u2019-][^\W\d_]+)*|\d+|\S")
_LIST_GAP = re.compile(r"^\s*(?:[,;/|&]|and|und|et|y|e)?\s*(?:and|und|et|y|e)?\s*$")
_MAIL_PART = re.compile(r"@|\uff20|[\[({<]| at | AT ")


class Names:
    """Known given names as a bitmap of ``2 ** NAME_BITS`` bits, two for each name: all of a table's names, in a size that does not grow."""

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = np.zeros(1 << (NAME_BITS - 3), dtype=np.uint8) if bits is None else bits
        self.memo: dict[str, bool] = {}

    @staticmethod
    def places(name: str) -> tuple[int, int]:
        h = xxhash.xxh64_intdigest(name)
        return h & ((1 << NAME_BITS) - 1), (h >> 32) & ((1 << NAME_BITS) - 1)

    @classmethod
    def of(cls, names: Iterable[str]) -> "Names":
        out = cls()
        for name in names:
            for at in cls.places(name.lower()):
                out.bits[at >> 3] |= 1 << (at & 7)
        return out

    def __contains__(self, name: str) -> bool:
        known = self.memo.get(name)
        if known is None:
            if len(self.memo) > 500_000:
                self.memo.clear()
            known = self.memo[name] = all(int(self.bits[at >> 3]) >> (at & 7) & 1 for at in self.places(name))
        return known

    def __reduce__(self):
        return Names, (self.bits,)


@dataclass
class Candidate:
    kind: str
    start: int
    end: int
    text: str
    features: list[str] = field(default_factory=list)


def number_shape(text: str) -> str:
    """The form of a number: its digits and letters alike, runs by length."""
    return _SHAPED.sub(lambda m: "9" if m[0].isdigit() else "A", text.replace("\xa0", " ").replace("\u2011", "-"))


def _case(word: str) -> str:
    return "upper" if word.isupper() else "title" if word[:1].isupper() else "lower"


def _context(text: str, start: int, end: int, skipped: frozenset[str] = frozenset()) -> list[str]:
    """The classes of the words and marks around a span, within its line."""
    before = text[max(0, start - 60) : start].rpartition("\n")[2]
    after = text[end : end + 24].partition("\n")[0]
    words = _WORD.findall(before.lower())[-6:]
    left = [CLASS_OF.get(w, "word") for w in words if w not in skipped][-4:]
    right = _NEXT_WORD.findall(after.lower())
    last = left[-1] if left else "none"
    mark = before.rstrip()[-1:]
    out = [f"left={last}", f"mark={mark if mark and not mark.isalnum() else '-'}", f"after={after.strip()[:1] if after.strip()[:1] and not after.strip()[:1].isalnum() else '-'}"]
    out += [f"near={c}" for c in set(left[-3:]) - {"word", "prep"}]
    if right:
        out.append(f"right={CLASS_OF.get(right[0], 'word')}")
        if right[0] in _EPONYM:
            out.append("right-eponym")
    if not left:
        out.append("line-start")
    return out


def _numbers(text: str) -> list[Candidate]:
    out = []
    for m in _NUMBER.finditer(text):
        value, start = m[0], m.start()
        digits = len(_DIGITS.findall(value))
        if not 7 <= digits <= 15 and not (digits >= 5 and value[0].isalpha()):
            continue
        form = number_shape(value)
        runs = [len(r) for r in _NINES.findall(form)]
        facts = [
            f"form={form}",
            f"runs={'-'.join(map(str, runs))}",
            f"digits={digits}",
            *(["plus"] if value[0] == "+" or value.startswith("00") else []),
            *(["zero"] if value[0] == "0" else []),
            *(["bracket"] if "(" in value else []),
            *(["letters"] if "A" in form else []),
            *(["one-run"] if len(runs) == 1 else []),
            *_context(text, start, start + len(value), TRANSPARENT),
            "number",
        ]
        for kind in ("phone", "id_number"):
            if kind == "id_number" or ("A" not in form and digits >= 9):
                out.append(Candidate(kind, start, start + len(value), value, facts))
    return out


def _name(text: str, start: int, end: int, form: str, surname: str, first: str, names: Names) -> Candidate:
    context = _context(text, start, end)
    cases = f"{_case(first)}-{_case(surname)}"
    known = "given" if first.lower() in names else "unknown"
    facts = ["name", form, f"case={cases}", f"{known}|{form}", *context, f"{known}|{context[0]}"]
    if surname.lower() in CLASS_OF:
        facts.append(f"surname={CLASS_OF[surname.lower()]}")
    if cases == "lower-lower":
        before = _WORD.findall(text[max(0, start - 30) : start].rpartition("\n")[2].lower())[-1:]
        mark = _MARK.search(text[max(0, start - 3) : start])
        comma = _COMMA.search(text[max(0, start - 30) : start])
        listed = bool(comma) and comma[1].islower()
        facts += [f"lower|{c}" for c in context]
        facts += [f"lower|{'listed' if listed else 'mark' if mark else 'word'}", f"lower|short={len(surname) < 5}", f"lower|particle={' '.join(text[start:end].split()[1:-1]) if form == 'given-surname' else ''}"]
        facts += ["lower|person"] if before and before[0] in PERSON_WORDS else []
    return Candidate("name", start, end, text[start:end], facts)


def _names(text: str, names: Names, words: set[str], taken: list[tuple[int, int]]) -> list[Candidate]:
    out: list[Candidate] = []
    spans: set[tuple[int, int]] = set()

    def add(start: int, end: int, form: str, surname: str, first: str) -> None:
        if (start, end) not in spans:
            spans.add((start, end))
            out.append(_name(text, start, end, form, surname, first, names))

    known = [w for w in words if w.lower() in names and (w.islower() or w.isupper() or w[1:].islower())]
    found = re.finditer("(?:" + "|".join(map(re.escape, known)) + r")(?![\w@])", text) if known else ()
    for m in found:
        word, at = m[0], m.start()
        if at and (text[at - 1].isalnum() or text[at - 1] in "_@.+'\u2019-" and (text[at - 1] != "-" or text[max(0, at - 2)].isalnum())):
            continue
        if text[m.end() : m.end() + 1] in ("'", "\u2019", "-") and text[m.end() + 1 : m.end() + 2].isalpha():
            continue
        case = _case(word)
        tail = _NAME_TAIL.match(text, m.end())
        followed = bool(tail) and (_case(tail["surname"]) == case or (case == "title" and _case(tail["surname"]) == "upper")) and "\n" not in tail[0] and tail["surname"].lower() not in PARTICLES
        if followed and tail["surname"].lower() not in names and tail["surname"].lower() not in _JOINING:
            add(at, tail.end(), "given-surname", tail["surname"], word)
        head = _NAME_HEAD.search(text, max(0, at - 50), at)
        if head and "\n" not in head[0] and not (followed and case != "lower"):
            surname = head["surname"].split()[-1]
            before = _WORD_BEFORE.search(text, max(0, head.start() - 30), head.start())
            if before and before[1].lower() in names and _case(before[1]) == case:  # that surname has its given name already
                continue
            if _case(surname) in (case, "upper") and surname.lower() not in names:
                after = _MIDDLE_AFTER.match(text, m.end())
                add(head.start(), after.end() if after else m.end(), "surname-given", surname, word)
    # Names of no known given name: after what announces a person, and wherever they stand again.
    for m in _PAIR.finditer(text):
        before = text[max(0, m.start() - 16) : m.start()].replace("\xa0", " ").rpartition("\n")[2].rpartition(" ")[2].strip("(*|\"“")
        word = before.rstrip(".,:").lower()
        if word not in ANNOUNCING and word not in ANNOUNCING_TITLE_CASE:
            continue
        whole, at = m["name"], m.start("name")
        parts = whole.split()
        upper = parts[0].isupper()
        # Initials behind a surname look like titles, and initials like a second name.
        if (before.rstrip(".,:").isupper() and len(word) < 4) or (word in ANNOUNCING_TITLE_CASE and upper) or (not upper and parts[-1].isupper() and len(parts[-1]) < 4):
            continue
        if parts[0].lower() in names or parts[0].lower() in PARTICLES or CLASS_OF.get(parts[-1].lower()) in ("eponym", "title"):
            continue
        if any(a <= at < b for a, b in taken) or any(a <= at < b for a, b in spans):
            continue
        at = text.find(whole)
        while at >= 0:
            end = at + len(whole)
            if not (at and text[at - 1].isalnum()) and not text[end : end + 1].isalnum():
                add(at, end, "pair", parts[-1], parts[0])
            at = text.find(whole, end)
    return out


def candidates(text: str, names: Names) -> list[Candidate]:
    """All proposals of a text, by place."""
    out: list[Candidate] = []
    if "@" in text or "\uff20" in text or _DISGUISED.search(text):
        for m in _EMAIL.finditer(text):
            out.append(Candidate("email", m.start(), m.end(), m[0], ["email", *(["disguised"] if "@" not in m[0] else [])]))
    out += _numbers(text)
    places = [Candidate("address", m.start(), m.end(), m[0], ["address", *_context(text, m.start(), m.end())]) for m in _ADDRESS.finditer(text)]
    out += places
    out += _names(text, names, set(_WORD_FAST.findall(text)), [(c.start, c.end) for c in places])
    return sorted(out, key=lambda c: (c.start, c.end, c.kind))


# -- The field ----------------------------------------------------------------------------------


@dataclass
class Field:
    """The fields of several texts behind one another: nodes, chains, chain edges and skip edges."""

    allowed: np.ndarray  # (nodes, LABELS)
    ends: np.ndarray  # (nodes, LABELS): whether a span with this label may end here
    flat: np.ndarray  # features of all nodes, and whose they are, by node
    owner: np.ndarray
    chains: list[np.ndarray]  # nodes of each chain in order
    gaps: np.ndarray  # class of the edge from the node before, within its chain
    skips: np.ndarray  # (edges, 3): two nodes and whether their tokens are equal (0) or similar (1)
    spans: list[list[tuple[Candidate, int, int]]]  # of each text, candidates with their first and last node


def _keys(c: Candidate, tokens: list[str]) -> list[tuple[int, str, int]]:
    """``(token, key, type)``: what joins a token to others of its document."""
    out = []
    if c.kind in ("phone", "id_number"):
        return [(0, "".join(x for x in c.text.lower() if x.isalnum()), 0)]
    if c.kind == "email":
        out.append((0, c.text.lower(), 0))
        tokens = _WORD_FAST.findall(_MAIL_PART.split(c.text)[0])
        return out + [(0, t.lower()[:6], 1) for t in tokens if len(t) > 5]
    for i, t in enumerate(tokens):
        if len(t) > 2 and t[0].isalpha():
            out.append((i, t.lower(), 0))
            if len(t) > 5:
                out.append((i, t.lower()[:6], 1))
    return out


def build(texts: list[tuple[str, list[Candidate]]], index: dict[str, int], grow: bool = False) -> Field:
    """The field of texts with their candidates; features are looked up in ``index``, or added to it."""
    allowed, ends, flat, owner, chains, gaps, skips, spans = [], [], [], [], [], [], [], []
    count = 0
    for text, found in texts:
        placed: list[tuple[Candidate, int, int]] = []
        last: dict[tuple[str, int], tuple[int, Candidate]] = {}
        at = 0
        before_end = None  # where the token before ended
        while at < len(found):
            # Candidates that overlap share their tokens.
            stop, to = found[at].end, at + 1
            while to < len(found) and found[to].start < stop:
                stop = max(stop, found[to].end)
                to += 1
            group = found[at:to]
            at = to
            begin = group[0].start
            bounds = sorted({p for c in group for p in (c.start, c.end)})
            tokens = [(a + m.start(), a + m.end(), m[0]) for a, b in zip(bounds, bounds[1:]) for m in _TOKEN.finditer(text[a:b])]
            starts = [t[0] for t in tokens]
            first = count
            for _ in tokens:
                row = np.zeros(LABELS, dtype=bool)
                row[0] = True
                allowed.append(row)
                ends.append(np.ones(LABELS, dtype=bool))
                ends[-1][1:] = False
            gap = "" if before_end is None else text[before_end:begin]
            if before_end is None or "\n" in gap or len(gap) > LONGEST_GAP or len(chains[-1]) > LONGEST_CHAIN:
                chains.append([])
                gaps.append(0)
            else:
                gaps.append(1 if _LIST_GAP.match(gap) else 2)
            gaps += [0] * (len(tokens) - 1)
            chains[-1] += range(first, first + len(tokens))
            before_end = tokens[-1][1]
            for c in group:
                a, b = first + bisect_left(starts, c.start), first + bisect_left(starts, c.end) - 1
                label = 1 + 2 * KINDS.index(c.kind)
                allowed[a][label] = True
                for i in range(a + 1, b + 1):
                    allowed[i][label + 1] = True
                ends[b][label + (a != b)] = True
                placed.append((c, a, b))
                if len(placed) < 2 or placed[-2][0].features is not c.features:  # the two readings of a number share theirs
                    for f in c.features:
                        number = index.setdefault(f, len(index)) if grow else index.get(f, -1)
                        if number >= 0:
                            flat.append(number)
                            owner.append(a)
                for i, key, kind in _keys(c, [t[2] for t in tokens[a - first : b - first + 1]]):
                    other = last.get((key, kind))
                    if other and other[1].end <= c.start:
                        skips.append((other[0], a + i, kind))
                    last[(key, kind)] = (a + i, c)
            count += len(tokens)
        spans.append(placed)
    shape = (count, LABELS)
    order = np.argsort(np.array(owner, dtype=np.int64), kind="stable")
    return Field(
        np.array(allowed, dtype=bool).reshape(shape), np.array(ends, dtype=bool).reshape(shape), np.array(flat, dtype=np.int64)[order], np.array(owner, dtype=np.int64)[order],
        [np.array(c) for c in chains], np.array(gaps, dtype=np.int64), np.unique(np.array(skips, dtype=np.int64).reshape(-1, 3), axis=0), spans,
    )


_BEGINS = np.ones(LABELS)  # labels that may stand after the end of a span
_BEGINS[2::2] = 0
_B, _I = np.arange(1, LABELS, 2), np.arange(2, LABELS, 2)


@dataclass
class Model:
    """Weights of features by label, of chain edges by class, and of skip edges by type."""

    index: dict[str, int]
    nodes: np.ndarray
    chain: np.ndarray  # (3, LABELS, LABELS)
    skip: np.ndarray  # (2, kinds + 1, kinds + 1)

    def without_skips(self) -> "Model":
        return Model(self.index, self.nodes, self.chain, self.skip * 0)


def _by_class(gaps: np.ndarray) -> list[tuple[int, np.ndarray]]:
    return [(g, np.flatnonzero(gaps == g)) for g in range(3)]


def _ahead(messages: np.ndarray, ends: np.ndarray, classes: list[tuple[int, np.ndarray]], chain: np.ndarray) -> np.ndarray:
    """From the left ends of chain edges to their right ends: a span ends where it may, or goes on."""
    out = np.zeros_like(messages)
    for g, at in classes:
        if len(at):
            out[at] = (messages[at] * ends[at]) @ (chain[g] * _BEGINS)
            if g == 0:
                on = messages[at]
                out[at, 2::2] = on[:, 1::2] * chain[0][_B, _I] + on[:, 2::2] * chain[0][_I, _I]
    return out


def _back(messages: np.ndarray, ends: np.ndarray, classes: list[tuple[int, np.ndarray]], chain: np.ndarray) -> np.ndarray:
    out = np.zeros_like(messages)
    for g, at in classes:
        if len(at):
            out[at] = ((messages[at] * _BEGINS) @ chain[g].T) * ends[at]
            if g == 0:
                on = messages[at][:, 2::2]
                out[at, 1::2] += on * chain[0][_B, _I]
                out[at, 2::2] += on * chain[0][_I, _I]
    return out


def believe(field_: Field, model: Model, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Beliefs of all nodes by loopy message passing, and the expected counts of label pairs over chain and skip edges."""
    n = len(field_.allowed)
    pairs, agree = np.zeros_like(model.chain), np.zeros_like(model.skip)
    if not n:
        return np.zeros((0, LABELS)), pairs, agree
    theta = np.zeros((n, LABELS))
    if len(field_.flat):
        begins = np.flatnonzero(np.diff(field_.owner, prepend=-1))
        theta[field_.owner[begins]] = np.add.reduceat(model.nodes[field_.flat], begins, axis=0)
    theta = np.where(field_.allowed, theta, -np.inf)
    own = np.exp(theta - theta.max(axis=1, keepdims=True))
    chain, wide = np.exp(model.chain), np.exp(model.skip)[:, KIND_OF][:, :, KIND_OF]
    ends = field_.ends.astype(np.float64)
    order = sorted(field_.chains, key=len, reverse=True)
    longest = len(order[0])
    grid = np.full((len(order), longest), -1, dtype=np.int64)
    last = np.ones(n, dtype=bool)  # a chain's last node: a span must end there
    for row, nodes in enumerate(order):
        grid[row, : len(nodes)] = nodes
        last[nodes[:-1]] = False
    steps = []
    for t in range(1, longest):
        alive = int((grid[:, t] >= 0).sum())
        left, right = grid[:alive, t - 1], grid[:alive, t]
        steps.append((left, right, ends[left], _by_class(field_.gaps[right])))
    a, b, kind = field_.skips.T if len(field_.skips) else (np.zeros(0, dtype=np.int64),) * 3
    types = [(k, np.flatnonzero(kind == k)) for k in (0, 1)]
    sent = np.full((2, len(a), LABELS), 1.0 / LABELS)  # to the second node, to the first
    for step in range(rounds + 1 if len(a) else 1):
        potential = own
        if len(a):
            incoming = np.zeros((n, LABELS))
            np.add.at(incoming, b, np.log(sent[0]))
            np.add.at(incoming, a, np.log(sent[1]))
            potential = own * np.exp(incoming - incoming.max(axis=1, keepdims=True))
        potential = np.where(last[:, None], potential * ends, potential)
        forward, backward = np.ones((n, LABELS)), np.ones((n, LABELS))
        for left, right, may_end, classes in steps:
            m = _ahead(forward[left] * potential[left], may_end, classes, chain)
            forward[right] = m / m.sum(axis=1, keepdims=True)
        for left, right, may_end, classes in reversed(steps):
            m = _back(backward[right] * potential[right], may_end, classes, chain)
            backward[left] = m / m.sum(axis=1, keepdims=True)
        belief = forward * backward * potential
        belief /= belief.sum(axis=1, keepdims=True)
        if step == rounds or not len(a):
            break
        new = np.empty_like(sent)
        for k, at in types:
            new[0, at] = (belief[a[at]] / sent[1, at]) @ wide[k]
            new[1, at] = (belief[b[at]] / sent[0, at]) @ wide[k].T
        sent = 0.5 * sent + 0.5 * new / new.sum(axis=2, keepdims=True)
    # Expected counts: of all edges of a class at once, each divided by its own sum.
    if steps:
        left, right = (np.concatenate([s[i] for s in steps]) for i in (0, 1))
        f, r = forward[left] * potential[left], backward[right] * potential[right]
        whole = (_ahead(f, ends[left], _by_class(field_.gaps[right]), chain) * r).sum(axis=1, keepdims=True)
        for g, at in _by_class(field_.gaps[right]):
            over = (f[at] * ends[left[at]] / whole[at]).T @ (r[at] * _BEGINS)
            pairs[g] = over * chain[g]
            if g == 0:
                on = r[np.ix_(at, _I)] / whole[at]
                pairs[0][_B, _I] += (f[np.ix_(at, _B)] * on).sum(axis=0) * chain[0][_B, _I]
                pairs[0][_I, _I] += (f[np.ix_(at, _I)] * on).sum(axis=0) * chain[0][_I, _I]
    fold = np.eye(len(KINDS) + 1)[KIND_OF]
    for k, at in types:
        if len(at):
            x, y = belief[a[at]] / sent[1, at], belief[b[at]] / sent[0, at]
            whole = ((x @ wide[k]) * y).sum(axis=1, keepdims=True)
            agree[k] = fold.T @ (((x / whole).T @ y) * wide[k]) @ fold
    return belief, pairs, agree


def decide(field_: Field, belief: np.ndarray) -> list[list[Candidate]]:
    """Of each text the candidates likelier than not, none overlapping, by place."""
    out = []
    for placed in field_.spans:
        scored = []
        for i, (c, a, b) in enumerate(placed):
            label = 1 + 2 * KINDS.index(c.kind)
            p = min(belief[a, label], *(belief[j, label + 1] for j in range(a + 1, b + 1))) if b > a else belief[a, label]
            if p > 0.5:
                scored.append((-p, i, c))
        starts: list[int] = []
        chosen: list[Candidate] = []
        for _, _, c in sorted(scored, key=lambda x: x[:2]):
            at = bisect_left(starts, c.start)
            # Those chosen do not overlap: only the two beside it can.
            if (at < len(chosen) and chosen[at].start < c.end) or (at and chosen[at - 1].end > c.start):
                continue
            starts.insert(at, c.start)
            chosen.insert(at, c)
        out.append(chosen)
    return out


def personal_of(texts: list[str | None], model: Model, names: Names) -> list[list[Candidate]]:
    """The personal information of each text, none overlapping; null has none."""
    proposed = [(t, candidates(t, names)) if t else ("", []) for t in texts]
    field_ = build(proposed, model.index)
    return decide(field_, believe(field_, model)[0])


def personal(text: str, model: Model, names: Names) -> list[Candidate]:
    return personal_of([text], model, names)[0]


def redact(text: str, found: list[Candidate]) -> str:
    """The text with each span replaced by its kind in square brackets; all else stays as it is."""
    out, at = [], 0
    for c in found:
        out += [text[at : c.start], f"[{c.kind.upper()}]"]
        at = c.end
    return "".join([*out, text[at:]])


# -- Fitting ------------------------------------------------------------------------------------

# What the generator writes: letters, notes and lists of offices, homes and workshops.  Braces name a slot.
# N, P, I, E, A are a person's name, phone, identity number, mailbox and address; U is a name whose given name is in no
# list; small letters are things that are no personal information.
SENTENCES = (
    # who, with what announces a person
    "Dear {N}, your parcel is ready.", "Yours truly, {N}", "Kind regards, {N}", "Regards {N}", "Minutes were kept by {N}.", "Our driver {N} will pass by at noon.", "Mrs {N} asked for a window seat.",
    "Mr. {N} returned both keys.", "Dr. {N} is on leave until Monday.", "Prof. {N} chairs the panel.", "Herr {N} hat abgesagt.", "Frau {N} wartet im Flur.", "Mme {N} a pris la clé.", "Sra. {N} pagó en caja.", "Sr. {N} não veio.",
    "Her daughter, {N}, collected the bag.", "The son {N} drove home.", "His wife {N} waited outside.", "My neighbour {N} has a spare key.", "Guests: {N}, {N} and {N}.", "Tickets for {N} and {N} are at the till.", "Seats went to {N}, {N}, {N} et {N}.",
    "{N} wrote this on the train.", "{N} sang first.", "We met {N} at the fair.", "Ask {N} about the lamp.", "In June, {N} came.", "On Monday, {N} slept.", "Room 12, {N}: a toast", "Our patient, {N}, slept.", "my uncle, {N}, sings", "the widow, {N}, knits", "a patient, {N}, ate", "give it to {N} please", "hand this to {N}", "he spoke to {N} twice", "the carer, {N}, stayed", "The new patient, {N} ({I}), ate.", "the piano of {N} was sold", "a portrait of {N} hangs there", "The prize went to {N} last year.", "I saw {N} again.", "Later {N} left.", "It was {N} who called.", "; {N} ;", "- {N}", "* {N} (chair)", "| {N} | {p} | yes |",
    "Cc {N}", "Attn: {N}", "Contact {N} for keys.", "Emergency: {N} {P}", "Patient {N} was moved upstairs.", "Nurse {N} wrote the chart.", "Signed by {N}", "Witness: {N}.", "todo: ask {N} about rent", "memo from {N}", "thanks to {N} for the cake", "owner: {N}",
    "Paid by {N}, {A}.", "Leave it with {N} please.", "Photo of {N} in May.", "According to {N} the boiler is fine.", "The guest {N}, of {A}, left early.",
    # names that no list holds
    "Dr. {U} is on leave until Monday.", "Mr. {U} returned both keys.", "Dear {U}, your parcel is ready.", "Signed {U}", "Frau {U} wartet im Flur.", "Her husband {U} drove home.", "Nurse {U} wrote the chart.", "Attention {U}", "Mrs. {U} and Mr. {U} agreed.",
    "Later {U} left.", "We met {U} at the fair.", "I saw {U} again.", "The prize went to {U} last year.", "{U} sang first.", "Ask {U} about the lamp.",
    # phones
    "Call {P} after six.", "Phone: {P}", "Tel. {P}", "mobile {P}", "Fax {P}", "Dial {P} for the desk.", "You can reach us on {P}.", "Text {P} if late.", "My number is {P}, evenings only.", "Rufen Sie {P} an.", "Llame al {P}.", "Appelez le {P}.", "Ligue {P}.", "{P}", "| {p} | {P} |", "The line {P} was busy.", "{N}, {P}", "{N} ({P})", "On Sundays {P} works too.", "The plumber ({P}) came.",
    # identity numbers
    "{L} {I}", "{L}: {I}", "Bring {L} {I} to the counter.", "His {L} {I} had expired.", "Mit {L} {I} gemeldet.", "Con {L} {I} firmado.", "The resident ({I}) moved out.", "The tenant ({L} {I}) paid.", "{N}, {L} {I}", "Form 7 lists {I}.", "The holder of {I} may vote.", "Member {I} renewed.", "| {I} | {p} |",
    "{L} {I}, reachable at {P}", "Papers: {L} {I}; line {P}", "{A}, to be rung at {P}", "{N} texted us, {P}, on Friday", "At {A} ask for {N}", "{P} is {N}", "{I} is {N}", "{N}, {I}, {A}", "{N} has {L} {I}", "Keys for {A}: {P}", "The flat, {A}, is {N}'s.", "{N} lives with {N} at {A}.", "sent back from {A} on Friday", "{N}, {I}, well", "{N} ({I})", "Cousin of {N}, {I}, absent",
    # mail and addresses
    "Write to {E}.", "<{E}>", "{N} <{E}>", "Mail: {E}", "My mailbox {E} is full.", "We moved to {A}.", "They live at {A} now.", "It stands at {A} today.", "Deliver to {A}, {p}.", "Home: {A}", "The house at {A} is sold.", "{A}", "Wir wohnen {A}.", "Vive en {A}.", "Il habite {A}.", "Post goes to {A}.", "| {N} | {A} | {P} |", "{N}, {A}, {P}, {E}",
    # what is none
    "Invoice {b7} is due.", "Order no. {b8} was shipped.", "Batch {b8} tasted sour.", "Lot {b8} came late.", "Part {k} fits model {k}.", "Catalogue no. {k} is out of print.", "Contract no. {b7} ends in June.", "Our contract {b7} covers it.", "Tender NCT{b8} closed.", "Accession {x} was logged.", "ISSN {b4}-{b4}.", "ISBN {isbn}", "Serial {b8} broke.",
    "Volumes {b4}-{b4} are missing.", "Built {y}-{y}.", "from {y} to {y}", "pp. {b3}-{b3}", "boxes {b3}-{b3} to {b3}-{b3}", "Firmware {b4}-{b4} is old.", "Grant {x} pays for it.", "Registration {b8} and ticket {b7}.", "Scores were {b3} {b3} {b3}.", "Reference {b8}.", "Sample {k} leaked.", "Ship no. {b7} sank.", "It weighs {b7} grams.", "Trial {x} began.", "Strain {x} grew.", "Code {k} opens the shed.", "DOI 10.{b4}/{b7}", "Barcode {b8}{b4}.", "version {b4}-{b4}", "under contract {b7}", "kit {k}, lot {b8}", "about {b8} grains", "{b8}",
    "The {s} method needs two pans.", "A {s} bridge spans the creek.", "The {g} {s} prize was shared.", "{g} {s} Street is closed.", "Take the {g} {s} bridge.", "the {G} {S} hospital", "the {s}, {g} test", "{S} {c} and {S} {c} painted it.", "{S} {c}, {S} {c}. The garden.", "Read {S} {c} ({y}).", "We crossed {p} at dusk.", "Maps by {p} Press.", "From {p} we sailed on.", "by {p} railway", "Cheese from {p} Valley.", "a letter from {p}",
    "habló de forma {g} sobre pan", "es cosa {g} que sobra", "de manera {g} la tarde", "una voz {g} de noche", "la noche {g} el mar", "con agua {g} la sopa", "it was {g} as glass", "a {g} sort of wood", "some {g} bread, please", "the {g} page is torn", "muy {g} todo", "in {g} letters above", "the word, {g} again", "for wine, {g} or dry", "os dias {g} do verão", "uma luz {g} na rua",
    "quedó {g} la mesa", "dejó {g} la puerta", "canta {g} la banda", "vino {g} la lluvia", "pintó {g} los muros", "sale {g} el agua", "era {g} del todo", "un tono {g} de mar", "mostró {g} la salida", "lee {g} la carta", "puso {g} la sal", "fica {g} da casa", "resta {g} la sera", "so {g} wie Glas", "ein {g} Ton", "une page {g} de garde", "the sky was {g} blue", "two {g} cups left", "plain {g} soup today", "a day as {g} as any", "very {g} water runs", "her {g} voice rose", "it tastes {g} enough",
    "{S}-{b3} is a bolt.", "Lines {x} and {x}.", "{G}{b3} runs.",
    # what alone may be both
    "A note from {U}.", "Painted by {U}.", "A call from {U}.", "Painted by {p} Studio.", "A note from {p}.",
)
# Lines of which another one of the text says what they hold.
BARE = ("See {X}.", "{X} again.", "Then {X} was read out.", "It says {X}.", "({X})", "Not {X}, surely.", "{X} came up twice.")
_IDENTITY = ("MRN", "SSN", "DNI", "NIE", "passport", "passport no.", "passport number", "Reisepass", "insurance no.", "insurance number", "NHS number", "national identity card", "identity card", "ID", "ID card", "social security number", "social security no.", "health card", "patient no.", "patient record", "record number", "Personalausweis", "pasaporte", "licence holder", "Versicherungsnummer")


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _fill(form: str, rng: random.Random) -> str:
    """A number of a form: 9 a digit, A a capital."""
    return "".join(rng.choice("0123456789") if c == "9" else rng.choice("ABCDEFGHJKLMNPRSTVWXYZ") if c == "A" else c for c in form)


# Forms of phone and identity numbers of several countries; 9 is a digit, A a letter.
PHONES = (
    "+1 (999) 999-9999", "+1 999 999 9999", "+1\xa0999\xa0999\xa09999", "+1-999-999-9999", "+1 999-999-9999", "19999999999", "+19999999999", "(999) 999 9999", "(999) 999-9999", "999-999-9999", "999.999.9999", "999‑999‑9999", "999 999-9999",
    "+44 20 9999 9999", "+44(0)20-9999-9999", "020 9999 9999", "01 99 99 99 99", "+33 1 99 99 99 99", "030/99999-999", "030 99999999", "+49 30 99999 999", "0049 30 99999999", "+34 999 99 99 99", "+351 999 999 999", "+86 139 9999 9999", "09999 999999", "+49 999 9999999",
)
IDS = ("999-99-9999", "999 99 9999", "999-99-999", "99999999", "9999999", "999999-9999", "999 999 9999", "A-999-9999", "A99999999", "AA9999999", "99999999A", "A99A99A99", "A999999999", "A9999999A", "AA999999A", "99 999999 A 999", "999.999.999-99", "9999-9999-9999")


def _surname(rng: random.Random) -> str:
    parts = ("Bra", "Kle", "Dro", "Sti", "Fe", "Zo", "Mar", "Pe", "Lu", "Gri", "Tol", "Ves", "Hal", "Nor")
    ends = ("son", "vik", "ska", "mar", "ert", "wick", "lund", "ova", "etto", "kov", "n", "ll")
    out = "".join(rng.choice(parts) for _ in range(rng.choice((1, 2)))).capitalize() + rng.choice(ends)
    return out if rng.random() > 0.1 else rng.choice((f"O'{out}", f"{out}-Ray"))


_GIVEN = ("Anna", "Robert", "Clara", "Igor", "Priya", "Chen", "Laura", "Omar", "Vera", "Peter", "Nina", "David")
_ODD = ("Zeb", "Torvald", "Quim", "Isolde", "Bronagh", "Ekene", "Yusra", "Lazar", "Odalys", "Piet")


def _person(rng: random.Random, given: str) -> dict[str, str]:
    surname = _surname(rng)
    if rng.random() < 0.2:
        surname = rng.choice(("van der ", "von ", "de ", "della ")) + surname
    forms = (f"{given} {surname}", f"{given} {surname}", f"{given} {rng.choice('ABCDEF')}. {surname}", f"{surname}, {given}", f"{surname.upper()}, {given}")
    name = rng.choice(forms)
    name = rng.choice((name, name, name, name, name, name.upper(), name.lower()))
    plain = surname.split()[-1].replace("'", "").lower()
    local = rng.choice((f"{given}.{plain}", f"{given[0]}{plain}", f"{plain}{_digits(rng, 2)}", f"{given}+s{_digits(rng, 1)}")).lower()
    number = _digits(rng, 2).lstrip("0") or "7"
    road = _surname(rng)
    return {
        "N": name, "P": _fill(rng.choice(PHONES), rng), "I": _fill(rng.choice(IDS), rng),
        "E": rng.choice((f"{local}@lab.example.org", f"{local} [at] post [dot] example [dot] net", f"{local} (at) ward.test")),
        "A": rng.choice((f"{number} {road} Street", f"Flat {number[0]}, {number} Old {road} Road", f"{road}weg {number}", f"Calle {road} {number}", f"Calle del {road} Alto, {number}, 2º B", f"Avenida {road} {number}", f"{number}, rue du {road}", f"P.O. Box {number}00", f"{number} {road} Ave., Apt 4B", f"{road}straße {number}", f"Postfach {number}2")),
    }


def _thing(name: str, rng: random.Random) -> str:
    if name[0] == "b":
        return str(rng.randint(0, 9)) + _digits(rng, int(name[1]) - 1)
    return {
        "k": lambda: _fill(rng.choice(("A-999-9999", "AA-999-9999", "A999-999", "AA99-9999")), rng), "x": lambda: _fill(rng.choice(("AA9999999", "A999999", "AA99999", "AAA999999")), rng),
        "isbn": lambda: _fill("999-9-999-99999-9", rng), "y": lambda: str(rng.randint(1900, 2024)), "s": lambda: _surname(rng), "S": lambda: _surname(rng), "G": lambda: rng.choice(_GIVEN), "g": lambda: rng.choice(_GIVEN).lower() if rng.random() < 0.8 else rng.choice(_GIVEN),
        "c": lambda: _fill(rng.choice(("A", "AA")), rng), "L": lambda: rng.choice(_IDENTITY), "p": lambda: rng.choice(("Harbour Point", "Santa Rosalia", "Old Mill", "North Ferry", "Kings Cross", "Puerto Alto", "Grand Pier")),
    }[name]()


_SLOTS = {"N": "name", "U": "name", "P": "phone", "I": "id_number", "E": "email", "A": "address"}


def _announced(sentence: str) -> bool:
    """Whether a name that no list holds is announced where it stands first in a sentence."""
    before = sentence.partition("{U}")[0].rstrip(" ").rstrip(".,:").rpartition(" ")[2]
    return before.lower() in ANNOUNCING or before.lower() in ANNOUNCING_TITLE_CASE


def letters(count: int, seed: int = 17) -> list[tuple[str, set[tuple[int, int, str]]]]:
    """Labelled texts of one to five lines.

    Within a text persons and things come again: a number or name that one line
    announces stands in others without what announces it.
    """
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        people = [_person(rng, rng.choice(_GIVEN)) for _ in range(2)]
        strangers = [f"{rng.choice(_ODD)} {_surname(rng)}" for _ in range(2)]
        things: dict[str, str] = {}
        announced: dict[str, str] = {}  # what stood in a line that says what it is, and its slot
        text, gold = "", set()
        for line in range(rng.randint(1, 5)):
            picked, again = rng.choice(SENTENCES), None
            unknown = "{U}" in picked and not _announced(picked)
            known = [x for x in announced.items() if not unknown or x[1] == "U"]
            if known and (unknown or rng.random() < 0.3):
                value, slot = rng.choice(known)
                picked, again = (picked if unknown else rng.choice(BARE).replace("{X}", f"{{{slot}}}")), value
            elif unknown:
                picked = rng.choice(("Dr. {U} is here.", "Signed {U}", "Dear {U}, thank you."))
            if line:
                text += "\n" if rng.random() < 0.6 else " " if text[-1] in ".!?" else ". "
            for j, part in enumerate(re.split(r"\{(\w+)\}", picked)):
                if j % 2 == 0:
                    value = part
                elif again:
                    value = again
                elif part == "U":
                    value = rng.choice(strangers)
                elif part in _SLOTS:
                    value = rng.choice(people)[part] if rng.random() < 0.6 else _person(rng, rng.choice(_GIVEN))[part]
                else:
                    value = things.setdefault(part, _thing(part, rng)) if rng.random() < 0.5 else _thing(part, rng)
                if j % 2 and part in (*_SLOTS, "b7", "b8", "k", "x") and len(picked) > 12:
                    announced[value] = part
                if j % 2 and part in _SLOTS:
                    gold.add((len(text), len(text) + len(value), _SLOTS[part]))
                text += value
        out.append((text, gold))
    return out


def _gold_labels(field_: Field, gold: list[set[tuple[int, int, str]]]) -> np.ndarray:
    labels = np.zeros(len(field_.allowed), dtype=np.int64)
    for placed, wanted in zip(field_.spans, gold):
        for c, a, b in placed:
            if (c.start, c.end, c.kind) in wanted:
                labels[a] = 1 + 2 * KINDS.index(c.kind)
                labels[a + 1 : b + 1] = 2 + 2 * KINDS.index(c.kind)
    return labels


@cache
def fit_model(texts: int = 1_200, rounds: int = 55, rate: float = 0.4, decay: float = 1e-3) -> Model:
    """All weights by ascent of the likelihood of the generator's texts, the expected counts taken from message passing."""
    written = letters(texts)
    names = Names.of(_GIVEN)
    index: dict[str, int] = {}
    field_ = build([(t, candidates(t, names)) for t, _ in written], index, grow=True)
    gold = _gold_labels(field_, [g for _, g in written])
    model = Model(index, np.zeros((len(index), LABELS)), np.zeros((3, LABELS, LABELS)), np.zeros((2, len(KINDS) + 1, len(KINDS) + 1)))
    one = np.eye(LABELS)[gold]
    pairs = np.zeros_like(model.chain)
    for chain in field_.chains:
        np.add.at(pairs, (field_.gaps[chain[1:]], gold[chain[:-1]], gold[chain[1:]]), 1)
    agree = np.zeros_like(model.skip)
    if len(field_.skips):
        a, b, kind = field_.skips.T
        np.add.at(agree, (kind, KIND_OF[gold[a]], KIND_OF[gold[b]]), 1)
    order = np.argsort(field_.flat, kind="stable")
    by_feature, begins = field_.owner[order], np.flatnonzero(np.diff(field_.flat[order], prepend=-1))  # every feature has a node
    weights = [model.nodes, model.chain, model.skip]
    squares = [np.full_like(w, 1e-3) for w in weights]
    speed = [np.zeros_like(w) for w in weights]
    for _ in range(rounds):
        belief, expected, agreed = believe(field_, model, rounds=1)
        nodes = np.add.reduceat((one - belief)[by_feature], begins, axis=0)
        for w, g, q, v in zip(weights, (nodes, pairs - expected, agree - agreed), squares, speed):
            g = g / len(written) * 100 - decay * 100 * w
            q *= 0.95
            q += 0.05 * g * g
            v *= 0.8
            v += 0.2 * rate * g / np.sqrt(q + 1e-6)
            w += v
    return model


# -- Over a table -------------------------------------------------------------------------------


def given_names(authors: DataFrame, column: str) -> Names:
    """All first words of full names in an array column, in lower case, as a bitmap of fixed size; each task hands on one, and there are at most 8."""
    first = authors.select(F.explode(column).alias("author")).select(F.lower(F.regexp_extract("author", r"^([\p{L}][\p{L}'’-]+)\s+\p{L}", 1)).alias("given"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Names()
        for batch in batches:
            out.bits |= Names.of(batch.column(0).to_pylist()).bits
        yield pa.RecordBatch.from_arrays([pa.array([out.bits.tobytes()], pa.binary())], names=["bits"])

    rows = first.filter(F.length("given") >= 2).distinct().coalesce(8).mapInArrow(fold, "bits binary").collect()
    return Names(reduce(np.bitwise_or, (np.frombuffer(bytes(r.bits), dtype=np.uint8) for r in rows), Names().bits))


def _over(documents: DataFrame, names: Names, key: str, text: str, schema: str, give) -> DataFrame:
    """Batches of ``(key, text)`` with their findings, as ``give`` makes rows of them; no shuffle."""
    shared = documents.sparkSession.sparkContext.broadcast((fit_model(), names))  # weights of a fixed number of features and a bitmap of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                bodies = part.column(1).to_pylist()
                yield give(part.column(0), bodies, personal_of(bodies, model, known))

    return documents.mapInArrow(run, schema)


def find_personal(documents: DataFrame, names: Names, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, start, end, kind, pii)``: every span of personal information, ``pii`` exactly as it stands.

    Null and empty texts have none.  Repeated rows repeat their spans; other
    columns are dropped; an empty table gives an empty result.  No shuffle.
    """
    rows = spread(documents.select(key, text), key).filter(F.length(text) > 0)
    kind = documents.schema[key].dataType.simpleString()

    def give(keys: pa.Array, bodies: list, found: list[list[Candidate]]) -> pa.RecordBatch:
        flat = [c for spans in found for c in spans]
        owner = [row for row, spans in enumerate(found) for _ in spans]
        places = [pa.array([getattr(c, x) for c in flat], t) for x, t in (("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("text", pa.string()))]
        return pa.RecordBatch.from_arrays([keys.take(pa.array(owner, pa.int32())), *places], names=[key, "start", "end", "kind", "pii"])

    return _over(rows, names, key, text, f"`{key}` {kind}, start int, end int, kind string, pii string", give)


def redact_texts(documents: DataFrame, names: Names, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text)``: every row's text with its personal information replaced by typed placeholders; null stays null."""
    rows = spread(documents.select(key, text), key)
    kind = documents.schema[key].dataType.simpleString()

    def give(keys: pa.Array, bodies: list, found: list[list[Candidate]]) -> pa.RecordBatch:
        out = [None if t is None else redact(t, spans) for t, spans in zip(bodies, found)]
        return pa.RecordBatch.from_arrays([keys, pa.array(out, pa.string())], names=[key, "text"])

    return _over(rows, names, key, text, f"`{key}` {kind}, text string", give)
