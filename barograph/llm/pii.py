"""Personal data by anchor expansion.

An Aho-Corasick automaton finds at-signs, schemes, digits in sequence, dotted
digits, plus signs and identifier cues in one pass. Around each anchor a small
deterministic parser settles the borders and validates what it has found.

Kinds with fixed rules: email, ip, card, phone; per kind leftmost and without
overlap, and what fails its validation is dropped. Kinds the method adds:
``login`` (an address with credentials, scheme://user:secret@host), ``secret``
(the value after a cue such as ``token =``) and ``account`` (an identifier
after a cue such as ``IBAN``, checked where it has a check sum).

Defined results: a null text counts as empty and has no spans. Texts are read
whole. Repeated rows get the same spans; other columns are ignored.
"""

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import functions as F

from barograph.llm.common import map_rows, over_batches, slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "secret", "account")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key")
ACCOUNT_CUES = ("iban", "account", "acct", "ssn", "passport")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
DIGITS = "0123456789"

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
FOUR_PARTS = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
DIGIT_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CREDENTIALS = re.compile(r"[A-Za-z0-9._%~!$&*+,;=-]+:[^\s/@]+@[A-Za-z0-9.-]+")
SECRET_VALUE = re.compile(r"[\"']?\s{0,4}[:=]\s{0,4}[\"']?([A-Za-z0-9_+/=.-]{8,})")
ACCOUNT_VALUE = re.compile(
    r"(?:\s{0,2}(?:number|no\.?|nr\.?|id|#))?\s{0,2}[:=#]?\s{0,4}([A-Za-z]{0,4}[0-9](?:[ -]?[A-Za-z0-9]){5,33})"
)
NOT_DIGITS = re.compile(r"[^0-9]")


@lru_cache(maxsize=1)
def anchors():
    """The automaton; every pattern tells its kind and its length."""
    import ahocorasick

    found = ahocorasick.Automaton()
    patterns = {"@": "email", "://": "login"}
    for one in DIGITS:
        patterns[f"+{one}"] = "phone"
        patterns[f".{one}"] = "ip"
        for two in DIGITS:
            for gap in ("", " ", "-"):
                patterns[one + gap + two] = "card"
    for kind, cues in (("secret", SECRET_CUES), ("account", ACCOUNT_CUES)):
        for cue in cues:
            for written in (cue, cue.upper(), cue.capitalize()):
                patterns[written] = kind
    for pattern, kind in patterns.items():
        found.add_word(pattern, (kind, len(pattern)))
    found.make_automaton()
    return found


def luhn(digits):
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if at % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def iban(value):
    """Whether a text without gaps has the form and the check sum of an IBAN."""
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def expand_left(text, at, least, allowed):
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def spans_of(text):
    """Sorted ``(kind number, start, end)`` of a text; code points, end exclusive."""
    found, done = [], dict.fromkeys(KINDS, 0)

    def take(kind, start, end, valid=True):
        done[kind] = end
        if valid:
            found.append((KINDS.index(kind), start, end))

    for last, (kind, length) in anchors().iter(text):
        at = last - length + 1
        if at < done[kind] and kind != "ip":
            continue
        if kind == "email":
            start = expand_left(text, at, done[kind], LOCAL)
            match = DOMAIN.match(text, at + 1) if start < at else None
            if match:
                take(kind, start, match.end())
        elif kind == "ip":
            start = expand_left(text, at, done[kind], DIGITS) if at >= done[kind] else at
            match = FOUR_PARTS.match(text, start) if start < at else None
            if match:
                parts = match[0].split(".")
                take(kind, start, match.end(), all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in parts))
        elif kind == "card":
            match = DIGIT_RUN.match(text, at)
            digits = NOT_DIGITS.sub("", match[0])
            take(kind, at, match.end(), 13 <= len(digits) <= 19 and luhn(digits))
        elif kind == "phone":
            match = DIALLED.match(text, at)
            if match:
                take(kind, at, match.end(), 9 <= len(NOT_DIGITS.sub("", match[0])) <= 15)
        elif kind == "login":
            start = expand_left(text, at, done[kind], SCHEME)
            match = CREDENTIALS.match(text, last + 1) if start < at else None
            if match:
                take(kind, start, match.end())
        elif kind == "secret":
            match = SECRET_VALUE.match(text, last + 1)
            if match:
                take(kind, match.start(1), match.end(1))
        else:
            match = ACCOUNT_VALUE.match(text, last + 1)
            if match:
                value = re.sub(r"[ -]", "", match[1])
                plain = sum(c in DIGITS for c in value) >= 6
                take(kind, match.start(1), match.end(1), iban(value) or plain)
    return sorted(found)


def written(spans):
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def find_pii(docs):
    """Counts, the digest of the fixed kinds and all spans of every row."""

    def make():
        def step(rows):
            spans = [spans_of(t or "") for t in rows["text"]]
            out = {"doc_id": rows["doc_id"], "spans": [written(s) for s in spans]}
            for number, kind in enumerate(BASE_KINDS):
                out[f"n_{kind}"] = [sum(k == number for k, _, _ in s) for s in spans]
            out["base_sha256"] = [
                hashlib.sha256(
                    written([x for x in s if x[0] < len(BASE_KINDS)]).encode()
                ).hexdigest()
                for s in spans
            ]
            return out

        return step

    return over_batches(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string",
        make,
    )


def masked(text):
    """The text with every span replaced by its kind; overlapping spans become one."""
    parts, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans_of(text)):
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if parts else text


def mask_texts(docs):
    """The rows of ``docs``, with all of their columns, and masked texts; a null text stays null."""

    place = docs.columns.index("text")

    def mask(batches):
        for batch in batches:
            for rows in slices(batch):
                texts = [None if t is None else masked(t) for t in rows.column(place).to_pylist()]
                columns = rows.columns
                columns[place] = pa.array(texts, type=batch.schema.field(place).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_rows(docs, mask)
