"""PII (operator 6): anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs before digits, digits, login schemes and identifier cues.
A deterministic local parser expands each anchor to the left or right and validates the result. Expansion never
backtracks over what an earlier match of its kind took, so the work is linear in the text.

Base kinds (fixed grammar, leftmost, non-overlapping per kind, failing candidates dropped without retry): email, ip,
card, phone. Added kinds: ``intl_email`` (letters beyond ASCII), ``login`` (user and password in a URL), ``secret``
(value after a cue such as ``password=``), ``account`` (IBAN with check digits, social security or account number
after a cue). An added span that touches a base span is left out, except a login, which widens the email in it.

Null text counts as empty: no spans. Offsets are code points, end exclusive. Repeated rows give repeated results.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from giniflow.llm.common import release

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("intl_email", "login", "secret", "account")
KINDS = BASE_KINDS + ADDED_KINDS

Span = tuple[str, int, int]

# Cues, each also met with a capital and in capitals.
SECRET_CUES = ("password", "passwd", "passphrase", "secret", "token", "api_key", "apikey", "api-key", "access_key")
ACCOUNT_CUES = ("iban", "ssn", "social security", "account", "acct", "konto", "compte", "cuenta")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "postgres://", "mysql://", "redis://", "amqp://")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE_RUN = re.compile(r"[ ().0-9-]*")
_INTL_LOCAL = re.compile(r"[\w.%+-]")
_INTL_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)+")
_LOGIN = re.compile(r"([^\s/?#:@\"'<>]+):([^\s/?#@\"'<>]+)@[A-Za-z0-9.-]+")
_SECRET = re.compile(r"[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?([A-Za-z0-9_\-+/.~]{8,})")
_IBAN = re.compile(r"[ \t:#.=]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
_SSN = re.compile(r"[ \t:#.=]{0,4}([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"(?: ?(?:no|nr|number|num)\.?)?[ \t:#.=]{1,4}([0-9](?:[ -]?[0-9]){7,19})(?![0-9])", re.I)


@cache
def automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    a.add_word("@", ("at", 1))
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
        a.add_word("+" + d, ("plus", 2))
    for name, cues in (("secret", SECRET_CUES), ("account", ACCOUNT_CUES), ("scheme", SCHEMES)):
        for cue in cues:
            for form in {cue, cue.capitalize(), cue.upper()}:
                a.add_word(form, (name, len(form)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def iban_ok(value: str) -> bool:
    if not 15 <= len(value) <= 34:
        return False
    rest = 0
    for c in value[4:] + value[:4]:
        rest = (rest * (10 if c.isdigit() else 100) + (int(c) if c.isdigit() else ord(c) - 55)) % 97
    return rest == 1


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Expand an at-sign: local characters to the left, not before ``floor``; at least two labels to the right."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    m = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end()) if m else None


def ip_at(text: str, at: int) -> tuple[int, bool]:
    """From the start of a digit run: the end of four dotted runs and whether all are at most 255; without four, the
    end of the first run."""
    first = end = _DIGITS.match(text, at).end()
    parts = [text[at:end]]
    while len(parts) < 4:
        m = _DIGITS.match(text, end + 1) if text[end:end + 1] == "." else None
        if not m:
            return first, False
        parts.append(m.group())
        end = m.end()
    return end, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def phone_at(text: str, at: int) -> tuple[int, bool]:
    """From a plus sign before a digit: the end after the last digit of the run, and whether 8 to 15 digits stand in
    it; ``at`` itself if the run holds no further digit."""
    end = _PHONE_RUN.match(text, at + 2).end()
    while end > at + 3 and not "0" <= text[end - 1] <= "9":
        end -= 1
    if end <= at + 3:
        return at, False
    n = sum("0" <= c <= "9" for c in text[at:end])
    return end, 8 <= n <= 15


def account_after(text: str, at: int) -> tuple[int, int] | None:
    m = _IBAN.match(text, at)
    if m:
        value = m.group(1)
        for end in range(len(value), 14, -1):  # the longest prefix whose check digits hold
            if value[end - 1] != " " and iban_ok(value[:end].replace(" ", "")):
                return m.start(1), m.start(1) + end
    m = _SSN.match(text, at)
    if m:
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            return m.start(1), m.end(3)
        return None
    m = _ACCOUNT.match(text, at)
    return m.span(1) if m else None


def find_spans(text: str | None) -> list[Span]:
    """All spans: base kinds as listed, then added kinds, each by start."""
    if not text:
        return []
    base: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    past = dict.fromkeys(KINDS, 0)
    for last, (anchor, size) in automaton().iter(text):
        at = last - size + 1
        if anchor == "digit":
            if at >= past["ip"]:
                past["ip"], ok = ip_at(text, at)
                if ok:
                    base["ip"].append((at, past["ip"]))
            if at >= past["card"]:
                m = _CARD.match(text, at)
                past["card"] = m.end() if m else at + 1
                if m:
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        base["card"].append(m.span())
        elif anchor == "plus":
            if at >= past["phone"]:
                end, ok = phone_at(text, at)
                past["phone"] = max(end, past["phone"])
                if ok:
                    base["phone"].append((at, end))
        elif anchor == "at":
            span = email_at(text, at, past["email"])
            if span:
                base["email"].append(span)
                past["email"] = span[1]
            start = at
            while start > past["intl_email"] and _INTL_LOCAL.match(text[start - 1]):
                start -= 1
            m = _INTL_DOMAIN.match(text, at + 1) if start < at else None
            if m and not text[start:m.end()].isascii():
                base["intl_email"].append((start, m.end()))
                past["intl_email"] = m.end()
        elif last + 1 >= past[kind := "login" if anchor == "scheme" else anchor]:
            if anchor == "scheme":
                m = _LOGIN.match(text, last + 1)
                span = m.span() if m else None
            elif anchor == "secret":
                m = _SECRET.match(text, last + 1)
                span = m.span(1) if m and any(c.isdigit() for c in m.group(1)) else None
            else:
                span = account_after(text, last + 1)
            if span:
                base[kind].append(span)
                past[kind] = span[1]
    taken = sorted(s for k in BASE_KINDS for s in base[k])
    starts, ends = [s[0] for s in taken], list(accumulate((s[1] for s in taken), max))
    out = [(k, *s) for k in BASE_KINDS for s in base[k]]
    for k in ADDED_KINDS:
        for a, b in base[k]:
            before = bisect_left(starts, b)
            if k == "login" or not before or ends[before - 1] <= a:
                out.append((k, a, b))
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def pii_spans(text: Column) -> Column:
    """Array of (kind, start, end) of each whole text."""

    @F.arrow_udf("array<struct<kind string, start long, end long>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for batch in batches:
            found = [find_spans(t.as_py()) for t in batch]
            flat = [s for spans in found for s in spans]
            offsets = [0]
            for spans in found:
                offsets.append(offsets[-1] + len(spans))
            values = pa.StructArray.from_arrays([pa.array([s[i] for s in flat], f.type) for i, f in enumerate(_SPAN)],
                                                fields=list(_SPAN))
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    return run(text)


def redacted(text: str | None) -> str | None:
    """Spans replaced by ``<KIND>``; of overlapping spans the one that starts first (the longer one of these) counts
    and the rest of the others goes with it."""
    if not text:
        return text
    out, past = [], 0
    for start, end, kind in sorted(((a, b, k) for k, a, b in find_spans(text)), key=lambda s: (s[0], -s[1])):
        if start >= past:
            out += [text[past:start], f"<{kind.upper()}>"]
        past = max(past, end)
    return "".join([*out, text[past:]])


def redact(text: Column) -> Column:
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for batch in batches:
            yield pa.array([redacted(t.as_py()) for t in batch], pa.string())

    return run(text)


def pii_report(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, the count of each base kind, the digest of the base spans, and all spans as text."""
    found = docs.select(F.col(id_col).alias("doc_id"), pii_spans(F.col(text_col)).alias("found"))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(joined(F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))), 256).alias("base_sha256"),
                        joined(F.col("found")).alias("spans"))
