"""Personal data inside dictated text: found, typed, and replaced.

Numbers are found by shape, validated (length, grouping, check digit of tax
numbers, cues in front of them that name something else), and replaced by a
pseudonym of the same format: a keyed Feistel permutation of their digits, so
equal values stay linked across documents whatever their separators. Dates are
permuted within the days of a fixed range. Names, addresses and e-mails have no
closed format; they get a typed placeholder. Each text is handled whole and
alone: one scan, no shuffle.

Names are found by structure: capital words in a row, initials, surnames before a
comma; titles, labels, kinship and verbs in front, other data behind. A list of
usual given names is one feature among these: it fixes where a name begins and
lets names without capitals and without a cue be found.

Defined results
---------------
* null or empty text: no spans, the text as it is.
* overlapping finds: e-mail before address before number before name.
* repeated rows (same id and text): one result; equal ids with different texts: each.
* very long texts are scanned whole.
"""

from __future__ import annotations

import hmac
import re
from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordal.llm.lexicon import GIVEN_NAMES, NICKNAMES, SENTENCE_OPENERS, bare
from cordal.session import ship

TYPES = ("PERSON", "EMAIL_ADDRESS", "PHONE_NUMBER", "ID_NUMBER", "STREET_ADDRESS")
SCHEMA = (
    "id bigint, texto string, texto_seguro string,"
    " datos array<struct<inicio:int,fin:int,tipo_entidad:string,seudonimo:string>>"
)

_EMAIL = re.compile(
    r"(?i)[a-z0-9][a-z0-9._+-]*(?:[ ]?@[ ]?|[ ]?\[at\][ ]?|[ ]?\((?:arroba|at)\)[ ]?|[ ]+arroba[ ]+)"
    r"[a-z0-9-]+(?:(?:\.|[ ]+punto[ ]+)[a-z0-9-]+)+"
)

_AT = re.compile(r"(?i)@|\[at\]|\((?:arroba|at)\)|[ ]arroba[ ]")  # every e-mail has one of these

_UP = "A-ZÁÉÍÓÚÑÜ"
_LOW = "a-záéíóúñü"
_STREET = rf"(?:(?:[Dd]el?|DEL?|[Ll]as?|LAS?|[Ll]os|LOS)[ ])*[{_UP}][{_UP}{_LOW}'’.]+(?:[ ](?:(?:[Dd]el?|DEL?|[Ll]as?|LAS?|[Ll]os|LOS)[ ])*[{_UP}][{_UP}{_LOW}'’]+){{0,3}}"
_FLAT = r"(?:,?[ ](?:[Pp]iso|PISO)[ ]\d{1,2}(?:,?[ ](?:[Dd]e?pto\.?|DE?PTO\.?)[ ]\w{1,2}\b)?|,?[ ]\d{1,2}°(?:[ ]?[A-Z]\b)?)?"
_ADDRESS = [  # what every match holds, and the pattern
    (("calle", "av", "bv", "bulevar", "boulevard", "pje", "pasaje", "diagonal"), re.compile(rf"(?i:\b(?:calle|avenida|av\.|avda\.|bv\.|bulevar|boulevard|pje\.|pasaje|diagonal))[ ]{_STREET}[ ](?:(?i:al|n[°º]|nro\.?)[ ]?)?\d+{_FLAT}")),
    (("b°", "bº", "barrio"), re.compile(rf"(?i:\bB[°º]|\bbarrio)[ ]{_STREET}[ ](?i:Mz\.?|manzana)[ ]\w+[ ](?i:casa|lote)[ ]\w+")),
    (("ruta",), re.compile(r"(?i)\bruta[ ](?:provincial|nacional)[ ]\d+[ ]km[ ]\d+(?:[.,]\d+)?")),
]
_PLAIN_ADDRESS = re.compile(rf"{_STREET}[ ](?:(?i:al|n[°º])[ ]?)?\d+{_FLAT}")
_ADDRESS_CUE = re.compile(r"(?i)(?:\bvive[ ]en|\bdomicilio[^:\n]{0,20}:|\bubicable:|\bmudanza[ ]a|\bavisar[ ]en|\bdesde|\bdirecci[oó]n[^:\n]{0,20}:)\s+")

_ADDRESS_WORDS = ("vive", "domicilio", "ubicable", "mudanza", "avisar", "desde", "direcci")  # one of them is in every cue

_DIGIT = r"(?:[ ]?[()./-]?[ ]?\d)"
_EXTENSION = r"[ ]+(?i:int|interno|ext)\.?[ ]*\d+"
_NUMBER = re.compile(rf"[+(]?\d(?:{_DIGIT}{{5,}}\)?(?:{_EXTENSION})?|{_DIGIT}{{3,4}}\)?{_EXTENSION})")  # six digits and more
_NOT_PERSONAL = re.compile(
    r"(?i)(?:\bn[°ºro.]*|\bestudio|\bprotocolo|\blote|\bdisco|\bserie|\binterna|\bescala(?:[ ]\w+)?|\bturno|\bbox|\bequipo(?:[ ]\w+)?"
    r"|\bfactor|\b[ií]ndice(?:[ ](?:de[ ])?\w+)?|\bsonda[ ]de|\bgrabado[ ]el|\bgradiente|\bpico[ ]de)[ :]*[A-Z]?-?$"
)
_ID_CUE = re.compile(r"(?i)(?:\bd\.?n\.?i\.?|\bdoc(?:umento|\.)?|\bcui[lt]|\bl\.?[ce]\.?|\bcargado[ ]como|\bverificada[ ]con|\bc[eé]dula)[ :#nN°º.]*$")
_PHONE_CUE = re.compile(
    r"(?i)(?:\btel(?:[eé]fono|\.)?|\bcel(?:ular|\.)?|\bcontacto|\bavisar[ ]al|\batiende[ ]el|\blaboral|\bparticular|\bconfirmado|\bmensaje[ ]al"
    r"|\bwhatsapp|\bllamar[ ]al|\binterno)[ :]*$"
)
_ID_SHAPE = re.compile(r"\d{1,2}([. -])\d{3}\1\d{3}|\d{7,8}")
_TAX_SHAPE = re.compile(r"(?:20|2[3-7]|3[034])([ .-]?)\d{8}\1\d")
_DATE = re.compile(r"\b(\d{1,2})([/-])(\d{1,2})\2(\d{4})\b")


_WORD = rf"[{_UP}](?:[{_LOW}]{{2,}}|[{_UP}]{{2,}})(?:-[{_UP}](?:[{_LOW}]+|[{_UP}]+))?(?![{_UP}{_LOW}\d])"
_OF = r"(?:(?:de|del|de[ ]la|de[ ]los|DE|DEL|DE[ ]LA)[ ])?"
_INITIALS = rf"(?:[{_UP}]\.[ ]?){{1,2}}"
#: Two or more capital words and initials in a row on one line, with particles and commas between them.
_NEXT = rf"(?:,[ ]|[ ]{_OF})(?:{_WORD}|[{_UP}]\.)"
_RUN = re.compile(rf"(?<![{_UP}{_LOW}.@+\d])(?:{_INITIALS}{_OF}{_WORD}(?:{_NEXT})*|{_WORD}(?:{_NEXT})+)")
_PIECE = re.compile(rf"{_WORD}|[{_UP}]\.")

#: Given names of the list, as they are compared (lower case, without accents).
_GIVEN = frozenset(bare(n) for n in [*GIVEN_NAMES, *(s for v in NICKNAMES.values() for s in v.split() if len(s) > 3 and s.isascii())])
_OPENERS = frozenset(bare(w) for w in SENTENCE_OPENERS)
#: Nouns whose capital followers name a place, a house or a thing, not a person.
_THINGS = frozenset(
    "policlinico sanatorio clinica centro instituto maternidad laboratorio unidad sala consultas hospital escala indice sonda"
    " fundacion servicio regla signo barrio plaza avenida calle ruta pasaje obra equipo reactivo protocolo serie turno"
    " provincia ciudad municipio universidad escuela facultad catedra hogar residencia puesto dispensario".split()
)
#: What stands in front of a name. Titles and labels are never followed by a verb.
_TITLES = frozenset(
    "dr dra sr sra srta lic prof ing enf téc tec obst don doña doctor doctora señor señora señorita licenciado licenciada profesor profesora".split()
)
_LABEL = re.compile(
    r"(?i)(?:\bnombre(?:[ ]y[ ]apellido)?(?:[ ]de)?|\bapellido(?:[ ]y[ ]nombre)?|\bfirma(?:d[oa])?(?:[ ]por)?|\bm[eé]dic[oa](?:[ ]\w+)?|\bsolicitante|\btitular"
    r"|\bresponsable|\bpaciente|\boperadora?|\binform[oó]|\brealiz[oó]|\bacompañante|\bcontacto|\bfamiliar|\btutora?|\batte)\s*[:(]\s*$|\ba[ ]nombre[ ]de[ ]$"
)
_CUE = re.compile(
    r"(?i)(?:\b(?:hij[oa]|herman[oa]|espos[oa]|c[oó]nyuge|madre|padre|mam[aá]|pap[aá]|t[ií][oa]|abuel[oa]|niet[oa]|sobrin[oa]|prim[oa]|pareja|marido|mujer"
    r"|novi[oa]|cuñad[oa]|suegr[oa]|yerno|nuera|vecin[oa]|amig[oa]|cuidadora?|chofer|remisero|enfermer[oa]|t[eé]cnic[oa]|m[eé]dic[oa]|paciente)[,:]?"
    r"|\b(?:corresponde|pertenece|avisa[r]?|avisado|entrega(?:do)?|llama[r]?|derivad[oa])[ ]a|\bcasa[ ]de|\bpedido[ ]de|\b[a-zñ]+[aií]d[oa][ ]por|\bcopia[ ](?:para|a)"
    r"|#[ ]?\(|\b[a-zñ]+ad[oa][ ]con|\bhabl[oó][ ]con|\bseg[uú]n(?:[ ][a-zñ]+)?|\bretira|\bacompaña|\bsu)[ ]\(?$|#[ ]?\($"
)
#: Verbs of what people do, behind a name.
_ACTS = re.compile(r"[ ](?:autoriza|espera|firma|retira|refiere|solicita|concurre|acude|informa|pide|llega|consulta|vive|dice|viene|vino|trae|trajo|indica)n?\b")
_NOT_NAMED = re.compile(
    r"(?i)\b(?:signo|regla|escala|[ií]ndice|maniobra|m[eé]todo|f[oó]rmula|criterios?|ley|s[ií]ndrome|enfermedad|prueba|test|servicio|barrio|calle|ciudad"
    r"|localidad|provincia|hospital|cl[ií]nica|sanatorio|policl[ií]nico|centro|instituto|fundaci[oó]n|escuela|universidad|equipo|sonda|v[aá]lvula)[ ](?:de[ ]la[ ]|del?[ ]|n[°º][ ])?$"
)
_LOWER_NAME = re.compile(rf"([{_LOW}]{{3,}})((?:[ ](?:(?:de|del|de la)[ ])?[{_LOW}]{{4,}}|[ ][{_LOW}]\.){{1,3}})(?![{_UP}{_LOW}])")

#: Words after which a span of lower-case words is no surname.
_LOWER_STOP = {
    "autoriza", "espera", "desde", "para", "presentado", "vienen", "figura", "tolera", "firma", "vive", "retira", "conforme",
    "teléfono", "telefono", "resultado", "sobre", "como", "documento", "este", "esta", "queda", "solicita", "refiere", "acude",
    "concurre", "informa", "indica", "pide", "llega", "trae", "consulta", "presenta", "tiene", "dice", "acompaña", "entrega",
    "quien", "donde", "cuando", "porque", "hasta", "hacia", "entre", "según", "durante", "mediante", "pero", "también", "misma",
    "mismo", "debe", "puede", "será", "está", "fue", "años", "con", "por", "que", "los", "las", "una", "del", "sin", "muy",
}


_LOWER_GIVEN = frozenset(x for n in GIVEN_NAMES for x in (n.lower(), bare(n))) | frozenset(n for n in _GIVEN)
_LOWER_WORD = re.compile(rf"[{_LOW}]{{3,}}")
#: A title (group 1), or a label or "a nombre de", in front of a word.
_CUED = re.compile(
    rf"(?i)(?:\b({'|'.join(sorted(_TITLES, key=len, reverse=True))})\.?[ ]|\ba[ ]nombre[ ]de[ ]|\b(?:paciente|firma|nombre|m[eé]dic[oa]|solicitante|titular):[ ]*)(?=[^\W\d_]{{3}})"
)
#: The word of every cue as it stands between blanks: with a point, a colon or an opening mark.
_CUE_TOKENS = frozenset(
    mark + word + end
    for mark in ("", "(", "-", '"', "«", "“", "'", "/")
    for word, ends in [*((t, ("", ".")) for t in _TITLES), ("nombre", ("", ":")), *((w, (":",)) for w in ("paciente", "firma", "medico", "medica", "médico", "médica", "solicitante", "titular"))]
    for end in ends
)
_GLUED_LABEL = re.compile(r":[^\W\d_]|[^\s\w(\"«“'/-](?:dr|sr|lic|prof)")  # a cue without a blank before or behind it
_ONE_WORD = re.compile(rf"{_WORD}(?!{_NEXT})")


def _titled(before: str) -> bool:
    """Whether a text ends with a title and a blank."""
    if before[-1:] != " ":
        return False
    words = before[-16:].split()
    return bool(words) and words[-1].lower().strip("(.") in _TITLES


class _Token:
    """A capital word or initial of a run."""

    __slots__ = ("a", "b", "given", "initial", "key", "upper")

    def __init__(self, a: int, b: int, word: str):
        self.a, self.b, self.key = a, b, bare(word)
        self.initial = word[-1] == "."
        self.given, self.upper = self.key in _GIVEN, word.isupper()


def _surnames(tokens: list[_Token], at: int, most: int = 2) -> int:
    """How many tokens from ``at`` on may be surnames."""
    n = 0
    while n < most and at + n < len(tokens):
        t = tokens[at + n]
        if t.initial or t.given or t.key in _OPENERS:
            break
        n += 1
    return n


def _name_in(tokens: list[_Token], before: str, after: str) -> tuple[int, int] | None:
    """The span of the first name that a row of capital words without comma holds."""
    cued = _titled(before) or _LABEL.search(before) or _CUE.search(before)
    while tokens and not tokens[0].given and not tokens[0].initial and tokens[0].key in _OPENERS:
        if tokens[0].key in _THINGS:
            return None
        cued = cued or tokens[0].key in _CAPITAL_CUES
        tokens = tokens[1:]
    if not tokens:
        return None
    if tokens[0].initial:
        n = 2 if len(tokens) > 1 and tokens[1].initial else 1
        m = _surnames(tokens, n)
        return (tokens[0].a, tokens[n + m - 1].b) if m else None
    g = next((i for i, t in enumerate(tokens) if t.given), None)
    middle = next((i for i, t in enumerate(tokens) if t.initial), None)
    if g is None and middle == 1 and (m := _surnames(tokens, 2)) and not _NOT_NAMED.search(before):
        return tokens[0].a, tokens[m + 1].b  # "Xxxx Y. Zzzz", whatever the first word is
    if g is not None:
        n = g + 1
        if n < len(tokens) and (tokens[n].given and tokens[n].upper == tokens[g].upper or tokens[n].initial):
            n += 1
        ahead = [t for t in tokens[max(0, g - 2) : g] if t.upper and t.key not in _OPENERS]
        if ahead and (ahead[-1] is tokens[g - 1]) and not (tokens[g].upper and _surnames(tokens, n) and not cued):
            return ahead[0].a, tokens[n - 1].b
        m = _surnames(tokens, n)
        if tokens[g].upper:
            m = next((i for i in range(m) if not tokens[n + i].upper), m)
        if m:
            return tokens[g].a, tokens[n + m - 1].b
        if g and cued and g <= 2 and not any(t.key in _OPENERS for t in tokens[:g]):
            return tokens[0].a, tokens[g].b
        return None
    m = _surnames(tokens, 0, 4)
    if tokens[0].key in _THINGS or _NOT_NAMED.search(before) or re.match(r"[ ]\d", after) and m == len(tokens):
        return None
    if m >= 2 and (cued or "#" in after or not tokens[0].upper or not tokens[m - 1].upper) and m == len(tokens):
        return tokens[0].a, tokens[m - 1].b
    if m >= 2 and cued:
        return tokens[0].a, tokens[m - 1].b
    return None


#: Sentence openers behind which a name follows at once.
_CAPITAL_CUES = frozenset("paciente firma retira acompaña acompana avisar contacto copia firmado solicita solicitante informa".split())


def _people(text: str) -> Iterator[tuple[int, int]]:
    """Spans of names in a text whose other data are masked by ``#``."""
    for run in _RUN.finditer(text):
        a, b = run.span()
        parts, end = [], a
        for m in _PIECE.finditer(text, a, b):
            token = _Token(*m.span(), m.group())
            if not parts or text[end : token.a].startswith(","):
                parts.append([])
            parts[-1].append(token)
            end = token.b
        i = 0
        while i < len(parts):
            first, start = parts[i], parts[i][0].a
            before = text[max(0, start - 40) : start].rpartition("\n")[2]
            if i + 1 < len(parts) and (found := _comma_name(first, parts[i + 1], before, text)):
                yield found
                i += 2
                continue
            after = text[first[-1].b : first[-1].b + 3]
            while first and (found := _name_in(first, before, after)):
                yield found
                first, before = [t for t in first if t.a >= found[1]], ""
            i += 1


def _comma_name(left: list[_Token], right: list[_Token], before: str, text: str) -> tuple[int, int] | None:
    """The span of ``surnames, given names``; a number behind makes the right part a street."""
    cued = False
    while len(left) > 1 and left[0].key in _OPENERS:
        cued = cued or left[0].key in _CAPITAL_CUES
        left = left[1:]
    own = left[-2:] if len(left) > 1 and left[-2].upper == left[-1].upper else left[-1:]
    if any(t.given or t.initial or t.key in _OPENERS for t in own) or len(own) < len(left) and not own[0].upper:
        return None
    n = 1
    if len(right) > 1 and (right[1].given or right[1].initial):
        n = 2
    if right[0].initial or right[0].upper != own[0].upper:
        return None
    if not right[0].given:
        cued = cued or _titled(before) or _LABEL.search(before) or _CUE.search(before)
        street = re.match(r"(?:[ ][^\W\d_]+){0,2}[ ]?\d", text[right[-1].b : right[-1].b + 30])
        behind = text[right[n - 1].b : right[n - 1].b + 3]
        cued = cued or "#" in behind or _ACTS.match(text, right[n - 1].b)
        longer = len(right) > n and right[n].key not in _OPENERS
        if not cued or len(own) < len(left) or street or longer or right[0].key in _OPENERS or right[0].key in _THINGS:
            return None
    return own[0].a, right[n - 1].b


def _cued_people(text: str) -> Iterator[tuple[int, int]]:
    """One capital word behind a title, and names typed without capitals: behind a
    title or label, or with a listed given name."""
    starts, low = set(), text.lower()
    if not _CUE_TOKENS.isdisjoint(low.split()) or _GLUED_LABEL.search(low):
        for m in _CUED.finditer(text):
            at = m.end()
            if text[at].islower():
                starts.add(at)
            elif m.group(1) and (one := _ONE_WORD.match(text, at)):
                token = _Token(*one.span(), one.group())
                if not token.given and token.key not in _OPENERS:
                    yield one.span()
    for word in _LOWER_GIVEN.intersection(_LOWER_WORD.findall(text)):
        at = text.find(word)
        while at >= 0:
            starts.add(at)
            at = text.find(word, at + 1)
    end = 0
    for a in sorted(starts):
        m = _LOWER_NAME.match(text, a)
        if not m or a < end or a and (text[a - 1].isalnum() or text[a - 1] in ".@+-"):
            continue
        if m.group(1) in _LOWER_STOP:
            continue
        words = m.group().split(" ")
        n, surnames = 1, 0
        if n < len(words) and (words[n] in _LOWER_GIVEN or words[n][-1] == "."):
            n += 1
        while n < len(words) and surnames < 2:
            if words[n] in ("de", "del", "la"):
                n += 1
                continue
            if words[n] in _LOWER_STOP or words[n][-1] == ".":
                break
            n, surnames = n + 1, surnames + 1
        while words[n - 1] in ("de", "del", "la"):
            n -= 1
        if surnames:
            end = a + len(" ".join(words[:n]))
            yield a, end


def _feistel(digits: str, key: bytes, tweak: str) -> str:
    """A keyed permutation of the decimal strings of this length (ten rounds)."""
    if len(digits) < 2:
        return digits
    half = len(digits) // 2
    a, b = digits[:half], digits[half:]
    for n in range(10):
        seed = hmac.digest(key, f"{tweak}|{len(digits)}|{n}|{b}".encode(), "sha256")
        c = (int(a) + int.from_bytes(seed[:12], "big")) % 10 ** len(a)
        a, b = b, str(c).zfill(len(a))
    return a + b


def unfeistel(digits: str, key: bytes, tweak: str) -> str:
    """The inverse of the permutation, for holders of the key."""
    if len(digits) < 2:
        return digits
    half = len(digits) // 2
    sizes = [half, len(digits) - half]
    a, b = digits[: sizes[0]], digits[sizes[0] :]
    for n in reversed(range(10)):
        left = sizes[0] if n % 2 == 0 else sizes[1]
        seed = hmac.digest(key, f"{tweak}|{len(digits)}|{n}|{a}".encode(), "sha256")
        c = (int(b) - int.from_bytes(seed[:12], "big")) % 10**left
        a, b = str(c).zfill(left), a
    return a + b


def _tax_check(digits: str) -> int:
    weights = (5, 4, 3, 2, 7, 6, 5, 4, 3, 2)
    rest = 11 - sum(int(d) * w for d, w in zip(digits, weights)) % 11
    return {11: 0, 10: 9}.get(rest, rest)


def pseudonym(text: str, kind: str, key: bytes) -> str:
    """A stand-in of the same format: the digits permuted, everything else kept."""
    digits = re.sub(r"\D", "", text)
    if kind == "ID_NUMBER" and _TAX_SHAPE.fullmatch(text) and len(digits) == 11:
        # the inner number is the person's id and stays linked to its plain form
        inner = _feistel(digits[2:10], key, "ID_NUMBER")
        new = digits[:2] + inner + str(_tax_check(digits[:2] + inner))
    elif kind == "PHONE_NUMBER":
        tail = min(7, len(digits))  # country and area codes are no personal data
        cut = re.search(r"(?i)[ ]*(?:int|interno|ext)\.?[ ]*(\d+)$", text)
        own = len(digits) - (len(cut.group(1)) if cut else 0)
        tail = min(tail, own)
        new = digits[: own - tail] + _feistel(digits[own - tail : own], key, kind) + digits[own:]
    else:
        new = _feistel(digits, key, kind)
    it = iter(new)
    return "".join(next(it) if c.isdigit() else c for c in text)


_FIRST_DAY, _DAYS = date(1900, 1, 1), 73_049  # 1900-01-01 to 2099-12-31


def date_pseudonym(text: str, key: bytes) -> str:
    """``dd/mm/yyyy`` moved to another day of the range by a keyed permutation."""
    m = _DATE.fullmatch(text)
    try:
        day = (date(int(m[4]), int(m[3]), int(m[1])) - _FIRST_DAY).days
    except (TypeError, ValueError):
        return text
    if not 0 <= day < _DAYS:
        return text
    while True:  # cycle walking keeps the permutation within the range
        day = int(_feistel(str(day).zfill(5), key, "DATE"))
        if day < _DAYS:
            new = _FIRST_DAY + timedelta(days=day)
            return f"{new.day:02d}{m[2]}{new.month:02d}{m[2]}{new.year:04d}"


def _dates_moved(text: str, key: bytes) -> str:
    """Every date of a text without other data under ``date_pseudonym``."""
    return _DATE.sub(lambda m: date_pseudonym(m[0], key), text)


def _numbers(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _NUMBER.finditer(text):
        a, b = m.span()
        whole = text[a:b]
        if whole[0] == "(" and whole.find(")") in (-1, len(whole) - 1):
            a, whole = a + 1, whole[1:].rstrip(")")
            b = a + len(whole)
        elif whole[-1] == ")" and "(" not in whole:
            b, whole = b - 1, whole[:-1]
        before = text[max(0, a - 40) : a]
        count = sum(c.isdigit() for c in whole)
        if count < 6 or (a and (text[a - 1].isalnum() or text[a - 1] in "@_+")) or (b < len(text) and text[b].isalpha()):
            continue
        if b < len(text) and text[b] in "@_" or _DATE.fullmatch(whole):
            continue
        line = before.rpartition("\n")[2].lstrip("(")
        cue = line.rstrip(" (")
        if _ID_CUE.search(line):
            if _ID_SHAPE.fullmatch(whole) or _TAX_SHAPE.fullmatch(whole):
                yield a, b, "ID_NUMBER"
            continue
        if _PHONE_CUE.search(line) and 6 <= count <= 15:
            yield a, b, "PHONE_NUMBER"
            continue
        if _NOT_PERSONAL.search(line) or _NOT_PERSONAL.search(cue) or whole.startswith("0800"):
            continue
        if _TAX_SHAPE.fullmatch(whole) or _ID_SHAPE.fullmatch(whole) and count == 8:
            yield a, b, "ID_NUMBER"
        elif count >= 10 or (count == 7 and re.fullmatch(r"\d{3}-\d{4}", whole)):
            yield a, b, "PHONE_NUMBER"


def find(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, type) of the personal data, in order, not overlapping."""
    taken: list[tuple[int, int, str]] = []

    def free(a: int, b: int) -> bool:
        return all(b <= x or a >= y for x, y, _ in taken)

    def take(a: int, b: int, kind: str) -> None:
        if a < b and free(a, b):
            taken.append((a, b, kind))

    if _AT.search(text):
        for m in _EMAIL.finditer(text):
            take(*m.span(), "EMAIL_ADDRESS")
    low = text.lower()
    for heads, pattern in _ADDRESS:
        if any(h in low for h in heads):
            for m in pattern.finditer(text):
                take(*m.span(), "STREET_ADDRESS")
    if any(word in low for word in _ADDRESS_WORDS):
        for m in _ADDRESS_CUE.finditer(text):
            if found := _PLAIN_ADDRESS.match(text, m.end()):
                take(*found.span(), "STREET_ADDRESS")
    for a, b, kind in _numbers(text):
        take(a, b, kind)
    rest = text
    if taken:
        cut, end = [], 0
        for x, y, _ in sorted(taken):
            cut += [text[end:x], "#" * (y - x)]
            end = y
        rest = "".join(cut) + text[end:]
    for x, y in _people(rest):
        take(x, y, "PERSON")
    for x, y in _cued_people(rest):
        take(x, y, "PERSON")
    for x, y, kind in list(taken):  # "… en la casa de NAME, STREET 12"
        if kind == "PERSON" and text[y : y + 2] == ", ":
            if found := _PLAIN_ADDRESS.match(text, y + 2):
                take(*found.span(), "STREET_ADDRESS")
    return sorted(taken)


def protect(text: str, key: bytes) -> tuple[str, list[tuple[int, int, str, str]]]:
    """The text with every datum replaced, and the spans with their stand-ins.

    Valid dates outside the spans are moved too; they are no type of their own.
    """
    data, parts, end = [], [], 0
    for a, b, kind in find(text):
        numeric = kind in ("PHONE_NUMBER", "ID_NUMBER")
        new = pseudonym(text[a:b], kind, key) if numeric else f"[{kind}]"
        data.append((a, b, kind, new))
        parts += [_dates_moved(text[end:a], key), new]
        end = b
    return "".join(parts) + _dates_moved(text[end:], key), data


def protected_texts(df: DataFrame, id_col: str, text_col: str, key: bytes) -> DataFrame:
    """id, texto, texto_seguro and datos (spans with stand-ins) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            safe, ends, flat = [], [0], []
            for text in batch.column("texto").to_pylist():
                new, data = protect(text, key)
                safe.append(new)
                flat += data
                ends.append(len(flat))
            columns = zip(*flat) if flat else ((), (), (), ())
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.string())
            names = ("inicio", "fin", "tipo_entidad", "seudonimo")
            spans = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("texto"), pa.array(safe, pa.string()), lists], ["id", "texto", "texto_seguro", "datos"]
            )

    ship(df.sparkSession)
    rows = df.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("texto")
    )
    return rows.mapInArrow(run, SCHEMA)
