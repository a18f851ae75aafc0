"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over a text finds anchors: at-signs, schemes (``://``), plus signs, digits and
cue words. At each anchor a small deterministic parser expands to the left and right and validates what it found:

* ``email``, ``ip``, ``card``, ``phone``: exactly the leftmost non-overlapping matches of the patterns below; an address
  part over 255, a card of other than 16 to 19 digits or a wrong check digit, a number of other than 8 to 15 digits
  is dropped.
* ``account``: the identifier after a cue word (``token``, ``password``, ``passport``, ...), with a digit and 6 or more
  characters; the user part of ``scheme://user:password@host``.
* ``iban``: two letters, two check digits and 11 to 30 more, with a right remainder.

A parser never starts inside what its kind has read already, so time is linear in the text. Offsets are code points,
the end exclusive.

Defined cases: a null text is an empty one (and stays null when redacted); repeated rows give repeated rows; an empty
table gives no rows. Extra columns are not read by ``scan_pii`` and kept by ``redact_pii``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from spendguard.llm.common import fresh_name

#: Kinds in the order in which they are listed; the first four are the base ones.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "iban")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SCHEME = re.compile(r"(?:https?|ftp|ssh|smtp|imap|postgres|mysql|redis|amqp|mongodb)$", re.IGNORECASE)
_USER = re.compile(r"[^\s/?#@:]+(?::[^\s/?#@]*)?(?=@[A-Za-z0-9])")
_AFTER_CUE = re.compile(r"""(?:[ \t_-]?(?:key|id|no|number|nr))?\.?[ \t]{0,3}[:=#]?[ \t]{0,3}["']?([A-Za-z0-9][A-Za-z0-9_+/.-]{4,}[A-Za-z0-9])""")
_IBAN = re.compile(r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")

_CUES = "token password passwd secret apikey api_key api-key passport account username user_id userid ssn".split()


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign in ("@", "+", "://", *"0123456789"):
        found.add_word(sign, (sign, len(sign)))
    for cue in _CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


_ANCHORS: list[ahocorasick.Automaton] = []  # one for each worker, made on first use


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _wordy(c: str) -> bool:
    return c.isalnum() or c == "_"


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans ``(kind, start, end)``, by kind as listed, then by start."""
    if not _ANCHORS:
        _ANCHORS.append(_automaton())
    out: list[tuple[str, int, int]] = []
    done = dict.fromkeys(KINDS, 0)
    for last, (sign, width) in _ANCHORS[0].iter(text):
        at = last - width + 1
        if sign.isdigit():
            if at >= done["ip"] and (at == done["ip"] or not _ascii_digit(text[at - 1 : at])):
                if m := _IP.match(text, at):
                    done["ip"] = m.end()
                    if all(map(_octet, m.group().split("."))):
                        out.append(("ip", at, m.end()))
            if at >= done["card"] and (m := _CARD.match(text, at)):
                done["card"] = m.end()
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", at, m.end()))
            start = at - 2
            if start >= done["iban"] and text[start:at].isupper() and not _wordy(text[start - 1 : start] or " "):
                if (m := _IBAN.match(text, start)) and (end := _iban_end(m.group(1))):
                    done["iban"] = start + end
                    out.append(("iban", start, start + end))
        elif sign == "@":
            start = at
            while start > done["email"] and _LOCAL.match(text[start - 1]):
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                done["email"] = m.end()
                out.append(("email", start, m.end()))
        elif sign == "+":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                done["phone"] = m.end()
                if 8 <= sum(map(_ascii_digit, m.group())) <= 15:
                    out.append(("phone", at, m.end()))
        elif sign == "://":
            if at >= done["account"] and _SCHEME.search(text[max(0, at - 8) : at]) and (m := _USER.match(text, last + 1)):
                done["account"] = m.end()
                out.append(("account", m.start(), m.end()))
        elif at >= done["account"] and not _wordy(text[at - 1 : at] or " ") and (m := _AFTER_CUE.match(text, last + 1)):
            if any(map(_ascii_digit, m.group(1))) and not _wordy(text[m.end() : m.end() + 1] or " "):
                done["account"] = m.end()
                out.append(("account", m.start(1), m.end()))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


def _ascii_digit(c: str) -> bool:
    return "0" <= c <= "9"


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def _iban_end(found: str) -> int:
    """The longest start of ``found`` that is a valid account number; 0 if none is."""
    for end in range(len(found), 14, -1):
        if found[end - 1] != " " and _remainder(found[:end].replace(" ", "")) == 1:
            return end
    return 0


def _remainder(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_pii(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``n_email, n_ip, n_card, n_phone, base_sha256, spans``."""

    @pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                spans = find(t or "")
                base = [s for s in spans if s[0] in BASE_KINDS]
                counts = [sum(k == kind for k, _, _ in base) for kind in BASE_KINDS]
                rows.append((*counts, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(spans)))
            names = [*(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"]
            yield pd.DataFrame(rows, columns=names)

    return docs.select(F.col(id_).alias("doc_id"), found(F.col(text)).alias("_f")).select("doc_id", "_f.*")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, overlapping ones as one, replaced by its kind in brackets."""
    parts, at, end = [], 0, 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            parts += [text[at:a], f"[{kind.upper()}]"]
        end = max(end, b)
        at = end
    return "".join([*parts, text[at:]])


def redact_pii(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """All rows and columns, with personal data in ``text`` replaced; ``length``, if there, follows changed texts."""

    @pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else masked(t, find(t)) for t in texts], dtype=object)

    new = fresh_name(docs, "clean")
    fresh = docs.withColumn(new, clean(F.col(text)))
    put = {text: F.col(new)}
    if length in docs.columns:
        same = F.col(text).eqNullSafe(F.col(new))
        put[length] = F.when(same, F.col(length)).otherwise(F.length(new).cast(docs.schema[length].dataType))
    return fresh.select(*[put.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
