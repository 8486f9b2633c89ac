"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textarrays import slices, text_bytes

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
SPAN = "struct<start:int,order:int,end:int,kind:string,score:double,base:boolean>"
CONTEXT_CHARS = 48
LEAST_SCORE = 0.5

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
_WRITTEN_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+ ?[\[(]at[\])] ?[A-Za-z0-9-]+(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]+)+"
)
#: Words that make a kind likelier when they stand close to a candidate.
CONTEXT = {
    "card": ("card", "visa", "credit", "debit", "carte", "karte", "tarjeta", "cvv"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "anruf", "llam", "appel"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security", "tax"),
    "email": ("mail", "contact", "write"),
}
_NEAR = {kind: re.compile("|".join(words)) for kind, words in CONTEXT.items()}
_NONDIGIT = re.compile(r"[^0-9]")
_MEMBER = np.zeros(256, bool)
_MEMBER[list(b"0123456789@")] = True


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn checksum."""
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        total += sum(divmod(2 * int(d), 10))
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether a bank account code passes the mod-97 check."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def account_codes(text: str) -> Iterator[tuple[int, int]]:
    """Places of bank account codes that pass their check; words after a code may look like its last groups."""
    at = 0
    while m := _IBAN.search(text, at):
        code, at = m.group(), m.start() + 2
        while code:
            if mod97(code.replace(" ", "")):
                at = m.start() + len(code)
                yield m.start(), at
                break
            code = code.rpartition(" ")[0]
            if not _IBAN.fullmatch(code):
                break


def _context(text: str, start: int, end: int, kind: str) -> float:
    around = text[max(0, start - CONTEXT_CHARS) : start].lower() + " " + text[end : end + CONTEXT_CHARS].lower()
    return 0.3 if kind in _NEAR and _NEAR[kind].search(around) else 0.0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of kind, end) of the plain patterns, leftmost and without overlap per kind.

    An address is found from its ``@``: the local part is the run of allowed
    characters before it, so a long run is read once.
    """
    spans = []
    at, done = text.find("@"), 0
    while at >= 0:
        left = _LOCAL.search(text, _run_start(text, done, at), at).start()
        domain = _DOMAIN.match(text, at + 1) if left < at else None
        if domain:
            spans.append((left, 0, domain.end()))
            done = domain.end()
        at = text.find("@", max(done, at + 1))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in _DIGITS.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NONDIGIT.sub("", m.group())) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


_ALLOWED = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _run_start(text: str, low: int, at: int) -> int:
    """Where the run of allowed characters that ends at ``at`` begins, not before ``low``."""
    while at > low and text[at - 1] in _ALLOWED:
        at -= 1
    return at


def _cards_inside(text: str, start: int, end: int):
    """Card numbers within a chain of digit groups that is no card number as a whole."""
    groups = [(start + m.start(), start + m.end()) for m in re.finditer("[0-9]+", text[start:end])]
    i = 0
    while i < len(groups):
        digits, found = "", None
        for j in range(i, min(i + 19, len(groups))):
            digits += text[groups[j][0] : groups[j][1]]
            if len(digits) > 19:
                break
            if len(digits) >= 13 and luhn(digits):
                found = j
                break
        if found is None:
            i += 1
        else:
            yield groups[i][0], groups[found][1]
            i = found + 1


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
    """Further candidates with a score of at least :data:`LEAST_SCORE`: (start, order, end, score).

    A score starts from how telling the pattern is, rises with a checksum and
    with words of its kind nearby, and a candidate must not touch a base span.
    """
    found = []
    for start, end in account_codes(text):
        found.append((start, "iban", end, 0.6 + _context(text, start, end, "iban")))
    for m in _SSN.finditer(text):
        found.append((m.start(), "ssn", m.end(), 0.3 + _context(text, m.start(), m.end(), "ssn")))
    for m in _LOCAL_PHONE.finditer(text):
        found.append((m.start(), "phone", m.end(), 0.3 + _context(text, m.start(), m.end(), "phone")))
    for m in _WRITTEN_EMAIL.finditer(text):
        found.append((m.start(), "email", m.end(), 0.5 + _context(text, m.start(), m.end(), "email")))
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 13:
            for start, end in _cards_inside(text, m.start(), m.end()):
                size = end - start - text.count(" ", start, end) - text.count("-", start, end)
                score = (0.6 if size >= 15 else 0.3) + _context(text, start, end, "card")
                found.append((start, "card", end, score))
    taken = [(a, b) for a, _, b in base]
    kept = []
    for start, kind, end, score in sorted(found, key=lambda x: (x[0], KINDS.index(x[1]))):
        if score >= LEAST_SCORE and not any(a < end and start < b for a, b in taken):
            taken.append((start, end))
            kept.append((start, KINDS.index(kind), end, score))
    return kept


def spans_of(texts: pa.Array) -> pa.Array:
    """Spans of each text; texts without a digit, ``@`` or written address are passed over at once."""
    out = []
    for low, high in slices(texts):
        part = texts.slice(low, high - low)
        data, offsets = text_bytes(part)
        seen = np.concatenate([[0], np.cumsum(_MEMBER[data])])
        some = seen[offsets[1:]] > seen[offsets[:-1]]
        written = pc.match_substring_regex(part.fill_null(""), r"[\[(]at[\])]").to_numpy(zero_copy_only=False)
        for i in range(len(part)):
            if not (some[i] or written[i]):
                out.append([])
                continue
            text = part[i].as_py()
            base = base_spans(text)
            rows = [(s, k, e, 1.0, True) for s, k, e in base]
            rows += [(s, k, e, score, False) for s, k, e, score in added_spans(text, base)]
            out.append([
                {"start": s, "order": k, "end": e, "kind": KINDS[k], "score": score, "base": own}
                for s, k, e, score, own in sorted(rows)
            ])
    kind = pa.struct([
        ("start", pa.int32()), ("order", pa.int32()), ("end", pa.int32()), ("kind", pa.string()),
        ("score", pa.float64()), ("base", pa.bool_()),
    ])
    return pa.array(out, pa.list_(kind))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with ``spans``: structs (start, order, end, kind, score, base), in code points, end exclusive.

    Spans are sorted by start and then by the order of :data:`KINDS`.  ``base``
    marks the matches of the plain patterns, which always stay; the others come
    from wider patterns that a checksum or the words around them confirm.  Null
    or empty text has no spans.  A column named spans is replaced; all other
    columns and equal rows are kept.
    """
    find = F.arrow_udf(spans_of, f"array<{SPAN}>")
    return docs.withColumn("spans", find(F.col("text")))
