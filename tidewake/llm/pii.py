"""Personal data: regular expressions propose, checksums confirm, nearby words adjust.

Four base kinds have fixed patterns and are always reported: email, ip, card and
phone. The method adds iban (as long as its country's are, confirmed by mod-97),
secret (a key of any length near a word such as token or password) and ssn (three
dashed groups), each with a score from its kind, its checksum and the words around it:
words of the kind's RAISING raise it, whole words of its LOWERING lower it; those of
MIN_SCORE or more are reported. The same score of a base span, which stays in any
case, goes into the document's risk. Base patterns are searched in the same order as one leftmost
non-overlapping pass would find them, but from the runs they must begin at, so long
runs of digits or letters cost no more than their length.

Defined results: a null text counts as empty and has no spans; texts, and keys in
them, of any length are searched whole; repeated rows each get a row, and so do rows
without a doc_id; an empty table gives an empty table. Other columns never matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .shared import small_batches
from .text import Texts, byte_set, slices

#: Base kinds in their order, then the method's.
KINDS = ("email", "ip", "card", "phone", "iban", "secret", "ssn")
BASE_KINDS = KINDS[:4]
MIN_SCORE = 0.5
#: Characters on either side in which context words count.
REACH = 40

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?= ?[A-Z0-9])")
#: Runs of base64 letters, of either alphabet, joined by dots, with padding.
SECRET = re.compile(r"(?<![A-Za-z0-9_+/.-])[A-Za-z0-9_+/-]+(?:\.[A-Za-z0-9_+/-]+)*={0,2}")
LEAST_KEY, LEAST_PIECE = 20, 12
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
#: Letters and digits of an IBAN by country: fixed values of the public registry.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22,
    "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
#: Score before context, and what in the text around raises it.
RAISING = {
    "email": (0.8, ("mail", "contact", "@")),
    "ip": (0.5, ("ip", "address", "host", "server")),
    "card": (0.7, ("card", "visa", "credit", "payment")),
    "phone": (0.6, ("phone", "tel", "call", "mobile")),
    "iban": (0.7, ("iban", "bank", "account", "konto")),
    "secret": (0.2, ("token", "secret", "password", "passwd", "api_key", "apikey", "key")),
    "ssn": (0.3, ("ssn", "social", "security")),
}
#: Words around that lower it.
LOWERING = {
    "email": {"example", "noreply"},
    "ip": {"version", "release", "section", "chapter"},
    "card": {"isbn", "tracking", "serial", "example"},
    "phone": {"isbn", "serial", "example"},
    "iban": {"serial", "example"},
    "secret": {"checksum", "digest", "commit", "revision", "example"},
    "ssn": {"serial", "part", "model", "example"},
}
RAISE, LOWER = 0.4, 0.3
WORD = re.compile("[a-z]+")

DIGIT, AT = byte_set((0x30, 0x39)), byte_set((0x40, 0x40))
RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, risk double"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with a local part and a dotted domain; a local part begins after the match before."""
    end, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        hit = DOMAIN.match(text, at + 1) if begin < at else None
        if hit:
            end = hit.end()
            yield begin, end
        at = text.find("@", max(at + 1, end))


def small(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) < 4 and int(number or 0) <= 255


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(a, b, "email") for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(map(small, m[0].split("."))):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 10 <= len(digits_of(m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return out


@cache
def iban_of(length: int) -> re.Pattern:
    return re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (length - 4))


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Where a country and two digits stand: as many letters and digits as the country's numbers have, confirmed."""
    end = 0
    for m in IBAN.finditer(text):
        if m.start() < end:
            continue
        whole = iban_of(IBAN_LENGTH[m[1]]).match(text, m.start()) if m[1] in IBAN_LENGTH else None
        if whole and mod97(whole[0].replace(" ", "")):
            end = whole.end()
            yield whole.span()


def is_key(run: str) -> bool:
    """Long enough, with a piece of some length that has both letters and digits."""
    if len(run) < LEAST_KEY:
        return False
    return any(len(p) >= LEAST_PIECE and not p.isdigit() and any("0" <= c <= "9" for c in p) and any(c.isalpha() for c in p) for p in re.split("[+/.=]+", run))


def added_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(a, b, "iban") for a, b in ibans(text)]
    out += [(m.start(), m.end(), "secret") for m in SECRET.finditer(text) if is_key(m[0])]
    out += [(m.start(), m.end(), "ssn") for m in SSN.finditer(text)]
    return [s for s in out if score(text, *s) >= MIN_SCORE]


def score(text: str, start: int, end: int, kind: str) -> float:
    least, words = RAISING[kind]
    near = f"{text[max(0, start - REACH) : start]} {text[end : end + REACH]}".lower()
    raised = least + RAISE * any(w in near for w in words)
    return min(1.0, max(0.0, raised - LOWER * (not LOWERING[kind].isdisjoint(WORD.findall(near)))))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


NOTHING = (0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "", 0, 0.0)


def examine(text: str) -> tuple:
    base = base_spans(text)
    added = added_spans(text)
    safe = 1.0
    for s in base + added:
        safe *= 1 - min(0.99, score(text, *s))
    counts = [sum(kind == k for _, _, kind in base) for k in BASE_KINDS]
    return (*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + added), len(added), 1 - safe)


def find_personal_data(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """RESULT for each row; spans in code points, end exclusive. Texts without @ and digits hold nothing."""
    small_batches(spark)
    names = [x.split()[0] for x in RESULT.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = Texts(part.column("text"))
                may = (texts.per_document(AT[texts.data]) > 0) | (texts.per_document(DIGIT[texts.data]) >= 1)
                rows = [examine(part.column("text")[k].as_py()) if yes else NOTHING for k, yes in enumerate(may.tolist())]
                yield pa.record_batch([part.column("doc_id"), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))], names)

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
