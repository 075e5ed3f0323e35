"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts the score.

Base kinds (email, ip, card, phone) are found as fixed by their patterns; a match that fails its test
is dropped and not retried.  Further kinds are proposed by pattern and kept by score: the score starts
at a prior of the kind, a passed checksum raises it, and words of the kind's list within ``BEFORE``
code points before the span or ``AFTER`` behind it raise it too.  Spans below ``LEAST`` are left out.

* iban: country letters, two check digits, 11 to 30 more; mod-97 must give 1.  The end is the one of the
  country's fixed length; in a country without one, each end at a boundary is tried, the farthest first
* ssn: 3-2-4 digits, no zero group; kept only with a context word nearby
* mac: six colon- or hyphen-separated hex pairs
* secret: private-key blocks, up to their END line or, without one, as far as their headers and lines of base64 go;
  tokens with a known beginning; tokens of three parts whose first is JSON in base64; runs of 20 characters or more,
  of any length, with letters and digits whose entropy is that of random ones, where a context word such as ``token`` or
  ``password`` is nearby; and 8 characters or more with letters and digits that are assigned to such a name

Context words are those of English, German, French and Spanish.

Every pattern runs in time linear in the text: runs are matched from where they can begin, with
possessive repeats, and the left side of an email is cut at the previous ``@``.

Defined results: null text is empty; offsets are code points, ends exclusive; an empty table gives an
empty result; repeated rows give repeated results.  The text itself never leaves its partition.
"""

from __future__ import annotations

import base64
import binascii
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tamarack.llm.common import ship

#: Kinds in the order of the result.
BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("iban", "ssn", "mac", "secret")
KINDS = BASE_KINDS + EXTRA_KINDS

#: Characters of an email's left side.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]){11,30}+))")
#: Characters of an IBAN by country.
IBAN_LENGTHS = {c: int(x[0]) for x in map(str.split, (
    "15 NO", "16 BE", "18 DK FI FK FO GL NL SD", "19 MK SI", "20 AT BA EE KZ LT LU MN XK", "21 CH HR LI LV", "22 BG BH CR DE GB GE IE ME RS VA",
    "23 AE GI IL IQ OM SO TL", "24 AD CZ ES MD PK RO SA SE SK TN VG", "25 LY PT ST", "26 IS TR", "27 BI DJ FR GR IT MC MR SM", "28 AL AZ BY CY DO GT HN HU LB NI PL SV",
    "29 BR EG PS QA UA", "30 JO KW MU YE", "31 MT SC", "32 LC", "33 RU")) for c in x[1:]}
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_MAC = re.compile(r"(?<![0-9A-Fa-f:-])[0-9A-Fa-f]{2}(?:([:-])[0-9A-Fa-f]{2})(?:\1[0-9A-Fa-f]{2}){4}(?![0-9A-Fa-f:-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/.-])[A-Za-z0-9_+/.-]{20,}+={0,2}")
_BLOCK = re.compile(r"-----(BEGIN|END) [A-Z ]{0,40}PRIVATE KEY-----")
#: A line end or blanks, then a header or base64; what a block without an END line is made of.
_BODY = re.compile(r"(?:(?:[\x20\t\r\n]|\\n)++(?:[A-Z][A-Za-z-]{2,30}:\x20[^\n]{0,200}+|[A-Za-z0-9+/]{20,}+={0,2}|[A-Za-z0-9+/]+={1,2}))*")
#: Names whose value is a secret.
NAMES = ("password", "passwd", "pwd", "passwort", "kennwort", "contraseña", "contrasena", "clave", "mot de passe", "secret", "token", "api[_-]?key", "access[_-]?key", "secret[_-]?key", "private[_-]?key")
_NAMED = re.compile(rf"(?i)(?<![^\W\d_])(?:{'|'.join(NAMES)})[\"']?[\x20\t]{{0,3}}[=:][\x20\t]{{0,3}}[\"']?(?P<value>[^\s\"'`,;<>]{{8,}}+)")
#: How tokens of well-known services begin, and the least entropy, in bits a character, of random hex
#: digits and of other random characters of that length.
BEGINNINGS = ("AKIA", "ASIA", "AIza", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "sk-", "sk_live_", "npm_")
HEX_BITS, OTHER_BITS = 2.8, 3.4
#: Words near a span that speak for its kind, the kind's prior, and what a checksum adds.
CONTEXT: dict[str, tuple[str, ...]] = {
    "email": ("mail", "email", "contact", "write", "kontakt", "correo", "courriel", "contacto"),
    "ip": ("ip", "host", "server", "address", "adresse", "dirección", "serveur", "servidor"),
    "card": ("card", "visa", "credit", "payment", "karte", "kreditkarte", "carte", "tarjeta", "zahlung", "pago"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "handy", "téléphone", "portable", "teléfono", "móvil"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte", "banque", "banco"),
    "ssn": ("ssn", "social", "security", "sozialversicherung", "sozialversicherungsnummer", "versicherungsnummer", "sécurité", "sociale", "seguridad", "seguro"),
    "mac": ("mac", "device", "ethernet", "gerät", "appareil", "dispositivo"),
    "secret": (
        "token", "secret", "password", "passwd", "pwd", "key", "apikey", "api", "auth", "bearer", "credential", "credentials",
        "passwort", "kennwort", "schlüssel", "geheimnis", "zugangsdaten", "clé", "jeton", "passe", "identifiants",
        "contraseña", "contrasena", "clave", "secreto", "credencial", "credenciales"),
}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.4, "ssn": 0.3, "mac": 0.6, "secret": 0.1}
CHECKSUM, NEARBY, BEFORE, AFTER, LEAST = 0.4, 0.3, 50, 25, 0.6
#: What a secret's form adds: a block, a known beginning or a readable header is enough by itself.
FORM = 0.6


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if k % 2 == 0 else (2 * v if v < 5 else 2 * v - 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # where the next span may begin
    at = text.find("@")
    while at >= 0:
        run = text[free:at]
        left = len(run) - len(run.rstrip(LOCAL))
        m = _DOMAIN.match(text, at + 1) if left else None
        if m:
            yield at - left, m.end()
        free = m.end() if m else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    for m in _IBAN.finditer(text):
        if m.start() < free:
            continue
        ends, size = [], 4
        for at in range(m.start(1), m.end(1)):
            size += text[at] != " "
            # a boundary: no ASCII letter or digit follows
            if text[at] != " " and size >= 15 and not (text[at + 1 : at + 2].isascii() and text[at + 1 : at + 2].isalnum()):
                ends.append((size, at + 1))
        fixed = IBAN_LENGTHS.get(text[m.start() : m.start() + 2])
        for size, end in reversed(ends):
            if fixed in (None, size) and mod97(text[m.start() : end]):
                free = end
                yield m.start(), end
                break


def entropy(run: str) -> float:
    """Bits a character."""
    return -sum(n / len(run) * math.log2(n / len(run)) for n in Counter(run).values())


_HEX, _WORDS = re.compile("[0-9a-fA-F]+").fullmatch, re.compile(r"[^\W\d_]+").findall


def _header(run: str) -> bool:
    """Whether the first of three parts is JSON in base64."""
    parts = run.split(".")
    try:
        return len(parts) == 3 and base64.urlsafe_b64decode(parts[0] + "=" * (-len(parts[0]) % 4))[:2] == b'{"'
    except (binascii.Error, ValueError):
        return False


def _blocks(text: str) -> Iterator[tuple[int, int]]:
    """Private-key blocks."""
    begin = None
    for m in _BLOCK.finditer(text):
        if begin is not None:
            yield begin.start(), m.end() if m[1] == "END" else _BODY.match(text, begin.end()).end()
        begin = m if m[1] == "BEGIN" else None
    if begin is not None:
        yield begin.start(), _BODY.match(text, begin.end()).end()


def _mixed(run: str) -> bool:
    return any(map(str.isdigit, run)) and any(map(str.isalpha, run))


def _secrets(text: str) -> Iterator[tuple[int, int, float]]:
    """Start, end and what form and entropy add to the score; spans don't overlap."""
    found = [(s, e, FORM) for s, e in _blocks(text)] if "PRIVATE KEY" in text else []
    blocks, at = [*found, (len(text), len(text), 0.0)], 0
    for m in _SECRET.finditer(text):
        while blocks[at][1] <= m.start():
            at += 1
            if at == len(blocks):
                break
        if at < len(blocks) and blocks[at][0] < m.end():
            continue
        run = m[0].rstrip("./-_+")
        if len(run) < 20:
            continue
        if run.startswith(BEGINNINGS) or _header(run):
            found.append((m.start(), m.start() + len(run), FORM))
        elif _mixed(run) and entropy(run) >= (HEX_BITS if _HEX(run) else OTHER_BITS):
            found.append((m.start(), m.start() + len(run), CHECKSUM))
    found.sort()
    named = [(m.start("value"), m.start("value") + len(m["value"].rstrip(".:!?)]}"))) for m in _NAMED.finditer(text) if _mixed(m["value"])]
    at = 0
    for s, e in named:
        while at < len(found) and found[at][1] <= s:
            at += 1
        # a run that is known already, or too short without what ends the sentence
        if e - s >= 8 and not (at < len(found) and found[at][0] < e and _likely(text, *found[at])):
            yield s, e, CHECKSUM
    yield from found


def _likely(text: str, start: int, end: int, added: float) -> bool:
    return _score("secret", text, start, end, added) >= LEAST


def _near(kind: str, text: str, start: int, end: int) -> bool:
    around = (text[max(0, start - BEFORE) : start] + " " + text[end : end + AFTER]).lower()
    return any(w in CONTEXT[kind] for w in _WORDS(around))


def _score(kind: str, text: str, start: int, end: int, added: float = 0.0) -> float:
    return round(min(1.0, PRIOR[kind] + added + NEARBY * _near(kind, text, start, end)), 2)


def find(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by kind in the order of ``KINDS``, then by start."""
    out = []
    add = lambda kind, spans, added=0.0: out.extend((kind, s, e, _score(kind, text, s, e, added)) for s, e in spans)
    if "@" in text:
        add("email", emails(text))
    add("ip", _ips(text))
    add("card", _cards(text), CHECKSUM)
    if "+" in text:
        add("phone", _phones(text))
    more = [("iban", s, e, _score("iban", text, s, e, CHECKSUM)) for s, e in _ibans(text)]
    more += [("ssn", *m.span(), _score("ssn", text, *m.span())) for m in _SSN.finditer(text)]
    more += [("mac", *m.span(), _score("mac", text, *m.span())) for m in _MAC.finditer(text)]
    more += sorted(("secret", s, e, _score("secret", text, s, e, added)) for s, e, added in _secrets(text))
    return out + [x for x in more if x[3] >= LEAST]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: its id and ``spans``, ``array<struct<kind,start,end,score>>``."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [[dict(zip(("kind", "start", "end", "score"), x)) for x in find(t or "")] for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "spans": found})

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInPandas(run, f"doc_id {kind}, spans array<struct<kind:string,start:int,end:int,score:double>>")
