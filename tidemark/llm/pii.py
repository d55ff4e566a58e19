"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and cues of identifiers and credentials. At each
anchor a small deterministic parser expands to the left and right, and validates what it has found.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from string import ascii_letters, digits

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.work import in_batches, text_slices, texts_by_id

#: Kinds in the order of results; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "account", "url", "secret")
BASE_KINDS = KINDS[:4]
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "ssh://", "sftp://")
#: Words that announce the number of an account or document; each also counts capitalised and in capitals.
CUES = ("iban", "account", "acct", "routing", "passport", "ssn", "kontonummer", "cuenta", "compte")

#: Words that announce a credential; each also counts capitalised and in capitals, alone or as the end of a name.
SECRET_CUES = ("token", "key", "secret", "password", "passwd", "pwd", "passphrase", "credential", "credentials", "bearer")
#: Least characters of a credential, and of one behind a word for passwords.
LEAST_SECRET, LEAST_PASSWORD = 16, 8

_LOCAL = frozenset(ascii_letters + digits + "._%+-")
_WORD = frozenset(ascii_letters + digits + "_")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_ACCOUNT = re.compile(r"(?:\x20?(?:no\.?|nr\.?|number|num\.?))?\x20?[:=#]?\x20?([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}|[A-Z]{0,2}[0-9](?:[\x20-]?[0-9]){5,33})(?![A-Za-z0-9])")
_URL = re.compile(r"(?:[^\s/@<>\"]{1,200}@)?(?:[A-Za-z0-9-]+\.)+[A-Za-z0-9-]+(?::[0-9]{1,5})?(?:/[^\s<>\"]*)?")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}")

# an assignment with its value in quotes or bare, or the scheme word of an authorisation header
_ASSIGNED = re.compile(r"[\"']?[\x20\t]{0,4}(?:[:=]|=>|:=)[\x20\t]{0,4}(?:([\"'`])([^\s\"'`]{8,4096})\1|([A-Za-z0-9+/_.~-]{8,4096}={0,2})(?![A-Za-z0-9+/_.~-]))")
_BEARER = re.compile(r"\x20(([A-Za-z0-9+/_.~-]{8,4096}={0,2}))(?![A-Za-z0-9+/_.~-])")

SCHEMA = """doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_account long,
n_url long, n_secret long"""


def luhn(number: str) -> bool:
    """The check sum of card numbers holds."""
    total = sum(map(int, number[-1::-2]))
    total += sum(2 * d - 9 * (d > 4) for d in map(int, number[-2::-2]))
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _iban_holds(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _secret_at(text: str, cue: str, end: int) -> tuple[int, int] | None:
    """The span of a credential announced by a cue that ends at ``end``: long enough, of letters and digits mixed."""
    found = (_BEARER if cue == "bearer" else _ASSIGNED).match(text, end) or (_ASSIGNED.match(text, end) if cue == "bearer" else None)
    if found is None:
        return None
    group = 2 if found[2] is not None else 3
    value = found[group]
    least = LEAST_PASSWORD if cue.startswith(("pass", "pwd")) else LEAST_SECRET
    mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and len(set(value)) >= min(6, least)
    return found.span(group) if len(value) >= least and mixed else None


@functools.lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for anchor in ("@", "+", *digits):
        found.add_word(anchor, (anchor if anchor in "@+" else "0", 1))
    for scheme in SCHEMES:
        found.add_word(scheme, ("url", len(scheme)))
        found.add_word(scheme.upper(), ("url", len(scheme)))
    for cue in CUES:
        for form in {cue, cue.capitalize(), cue.upper()}:
            found.add_word(form, ("cue", len(cue)))
    for cue in SECRET_CUES:
        for form in {cue, cue.capitalize(), cue.upper()}:
            found.add_word(form, (f"secret {cue}", len(cue)))
    found.make_automaton()
    return found


def find_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, each kind leftmost first and free of overlaps; offsets in code points, end exclusive."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    free = dict.fromkeys(KINDS, 0)  # by kind, where the next span may begin
    card_free = ip_free = 0
    for last, (kind, length) in _anchors().iter(text):
        if kind == "0":
            if last >= card_free:
                card_free = last + 1
                if found := _CARD.match(text, last):
                    card_free = found.end()
                    number = _NOT_DIGITS.sub("", found[0])
                    if 13 <= len(number) <= 19 and luhn(number):
                        spans["card"].append(found.span())
            if last >= ip_free:
                if found := _IP.match(text, last):
                    ip_free = found.end()
                    if all(map(_small, found.groups())):
                        spans["ip"].append(found.span())
                else:
                    ip_free = _DIGITS.match(text, last).end()
        elif kind == "@":
            if (found := _DOMAIN.match(text, last + 1)) and last >= free["email"]:
                start = last
                while start > free["email"] and text[start - 1] in _LOCAL:
                    start -= 1
                if start < last:
                    free["email"] = found.end()
                    spans["email"].append((start, found.end()))
        elif kind == "+":
            if last >= free["phone"] and (found := _PHONE.match(text, last)):
                free["phone"] = found.end()
                if 9 <= len(_NOT_DIGITS.sub("", found[0])) <= 15:
                    spans["phone"].append(found.span())
        elif kind == "url":
            start = last + 1 - length
            if start >= free["url"] and (found := _URL.match(text, last + 1)):
                end = found.start() + len(found[0].rstrip(".,;:!?)'"))
                free["url"] = end
                spans["url"].append((start, end))
        elif kind.startswith("secret"):
            start = last + 1 - length
            inside = start > 0 and text[start].islower() and text[start - 1].isalpha()  # as in monkey, not in apiKey
            if start >= free["secret"] and not inside and (span := _secret_at(text, kind[7:], last + 1)):
                free["secret"] = span[1]
                spans["secret"].append(span)
        else:
            start = last + 1 - length
            if start >= free["account"] and not (start and text[start - 1] in _WORD) and (found := _ACCOUNT.match(text, last + 1)):
                value = re.sub(r"[\x20-]", "", found[1])
                holds = _iban_holds(value) if _IBAN.fullmatch(value) else value[0].isdigit() and sum(c.isdigit() for c in value) >= 6
                if holds:
                    free["account"] = found.end()
                    spans["account"].append(found.span(1))
    return spans


def _joined(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def personal_data(documents: DataFrame) -> DataFrame:
    """Spans of personal data in each whole text of ``documents`` (``doc_id``, ``text``).

    ``spans`` lists all as ``kind:start:end``, by kind and start; ``base_sha256`` is the digest of those of the base
    kinds email, ip, card and phone, which the further kinds (account, url, secret) never change. A null text counts as
    empty and has none. Repeated rows are searched each for itself; an empty table gives an empty result; other
    columns are unread.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_account", "n_url", "n_secret"]
        for batch in batches:
            for part in text_slices(batch):
                rows = []
                for text in part.column("text").to_pylist():
                    found = find_spans(text)
                    base = hashlib.sha256(_joined(found, BASE_KINDS).encode()).hexdigest()
                    n = [len(found[k]) for k in KINDS]
                    rows.append((*n[:4], base, _joined(found, KINDS), *n[4:]))
                kinds = [pa.string() if "base" in c or c == "spans" else pa.int64() for c in names]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *names])

    return in_batches(texts_by_id(documents), search, SCHEMA)


def redacted(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first one counts."""
    out, place = [], 0
    for start, end, kind in sorted((a, b, k) for k, found in spans.items() for a, b in found):
        if start >= place:
            out += [text[place:start], f"<{kind}>"]
            place = end
    return "".join([*out, text[place:]])
