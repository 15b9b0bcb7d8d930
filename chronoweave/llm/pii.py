"""Personal data in texts: expressions propose spans, checksums confirm them, context scores them.

Every expression is written so that a text is read in time linear in its length: runs are
entered at their start only, or are found from the one character that they need.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import annotate, added

#: Kinds in the order in which spans are listed; the first four are always reported.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
BASE = KINDS[:4]
#: Score of a confirmed span before its context counts.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.35, "local_phone": 0.35}
#: Spans of further kinds are reported from this score on.
LEAST_SCORE = 0.6
#: Characters read on either side for context, and what a context word adds or takes.
REACH, GAIN, LOSS = 48, 0.25, 0.25

# Context words by kind, and words that speak against personal data.
CONTEXT = {
    "email": "mail email e-mail contact courriel correo kontakt",
    "ip": "ip address server host adresse dirección client login",
    "card": "card credit visa mastercard amex payment carte karte tarjeta cc",
    "phone": "phone tel telephone call mobile fax telefon téléphone teléfono cell whatsapp",
    "iban": "iban account bank konto compte cuenta bic swift transfer",
    "ssn": "ssn social security",
    "local_phone": "phone tel telephone call mobile fax telefon téléphone teléfono cell whatsapp",
}
AGAINST = "isbn issn version order invoice sku serial build release ticket"
# Length of an IBAN by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18,
    "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26,
    "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28,
    "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "TR": 26,
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,27}")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
_WORDS = {k: frozenset(v.split()) for k, v in CONTEXT.items()}
_AGAINST = frozenset(AGAINST.split())
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


class Span(NamedTuple):
    """A find: kind, code points [start, end), score of 0 to 1."""

    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(code: str) -> bool:
    """Whether the check digits of an IBAN without spaces are right."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        places = [i for i in range(*m.span()) if text[i] != " "]
        length = IBAN_LENGTH.get(text[m.start() : m.start() + 2], 99)
        if length <= len(places):
            end = places[length - 1] + 1
            if not text[end : end + 1].isalnum() and mod97("".join(text[i] for i in places[:length])):
                yield m.start(), end


_FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": emails,
    "ip": addresses,
    "card": cards,
    "phone": phones,
    "iban": ibans,
    "ssn": lambda text: (m.span() for m in _SSN.finditer(text)),
    "local_phone": lambda text: (m.span() for m in _LOCAL_PHONE.finditer(text)),
}


def scored(text: str, kind: str, start: int, end: int) -> float:
    """The prior of a confirmed span, adjusted by the words nearby."""
    near = text[max(0, start - REACH) : start] + " " + text[end : end + REACH]
    words = set(map(str.lower, _WORD.findall(near)))
    score = PRIOR[kind] + GAIN * bool(words & _WORDS[kind]) - LOSS * bool(words & _AGAINST)
    return round(min(1.0, max(0.0, score)), 4)


def find_spans(text: str) -> list[Span]:
    """Spans by kind as in KINDS, then by start; those of further kinds overlap no base span."""
    found: list[Span] = []
    if "@" in text:
        found = [Span("email", s, e, scored(text, "email", s, e)) for s, e in emails(text)]
    if not _DIGIT.search(text):
        return found
    for kind in KINDS[1:]:
        # Spans of one kind never overlap; those of the kinds before are looked up by their place.
        taken = [] if kind in BASE else merged(found)
        starts = [s for s, _ in taken]
        for s, e in _FINDERS[kind](text):
            if kind not in BASE:
                at = bisect_left(starts, e) - 1
                if at >= 0 and taken[at][1] > s:
                    continue
            score = scored(text, kind, s, e)
            if kind in BASE or score >= LEAST_SCORE:
                found.append(Span(kind, s, e, score))
    return found


def merged(spans: list[Span]) -> list[tuple[int, int]]:
    """The ranges that spans cover, in order and apart."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s.start, s.end) for s in spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span, overlapping ones together, replaced by its kind in brackets."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


FIELDS = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
    "scores array<double>, redacted string"
)


def find_personal_data(docs: DataFrame, keep: list[str] | None = None, text: str = "text", with_text: bool = True) -> DataFrame:
    """Columns `keep` of docs and, last, a struct of the personal data in each whole text.

    Its fields: counts of the base kinds, the digest of the base spans, `spans` (kind:start:end in
    code points, by kind, then start, comma-joined), their scores, and with `with_text` the
    redacted text. Null and empty texts have no spans, and null stays null when redacted. Repeated
    rows each have their result, an empty table gives an empty one, other columns may have any
    names.
    """

    def make() -> Callable:
        def work(texts: pa.Array) -> list[pa.Array]:
            counts, sums, lists, scores, clean = [[] for _ in BASE], [], [], [], []
            for value in texts:
                content = value.as_py()
                spans = find_spans(content or "")
                for n, kind in zip(counts, BASE):
                    n.append(sum(s.kind == kind for s in spans))
                base = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans if s.kind in BASE)
                sums.append(hashlib.sha256(base.encode()).hexdigest())
                lists.append(",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans))
                scores.append([s.score for s in spans])
                clean.append(redact(content, spans) if with_text and spans else content if with_text else None)
            return [
                *[pa.array(n, pa.int64()) for n in counts],
                pa.array(sums, pa.string()),
                pa.array(lists, pa.string()),
                pa.array(scores, pa.list_(pa.float64())),
                pa.array(clean, pa.string()),
            ]

        return work

    return annotate(docs, FIELDS, make, [text], keep)


def redacted_documents(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """docs with personal data in `text` replaced by its kind; `length`, if there, is counted anew."""
    found = find_personal_data(docs, text=text)

    def column(name: str) -> Column:
        if name == text:
            return added(found, "redacted").alias(name)
        if name == length:
            changed = added(found, "spans") != ""
            new = F.char_length(added(found, "redacted")).cast(docs.schema[name].dataType)
            return F.when(changed, new).otherwise(found[f"`{name}`"]).alias(name)
        return found["`" + name.replace("`", "``") + "`"]

    return found.select(*[column(c) for c in docs.columns])
