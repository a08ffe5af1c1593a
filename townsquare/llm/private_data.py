"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors: at-signs, plus signs, digits, schemes, prefixes of
keys and identifier cues, in any case of their letters. Local parsers walk from an anchor to the boundaries of an address, number
or account and validate it. Every parser moves over a character a bounded number of times,
so whole texts of any length are read in linear time.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townsquare.llm.common import as_text, map_rows, small_batches

#: Order of the kinds in the outputs; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "url", "iban", "secret", "account", "ssn")
BASE = KINDS[:4]
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "ssh://", "www.")
SECRET_CUES = ("token", "password", "passwd", "secret", *(f"{a}{b}key" for a in ("api", "access", "secret") for b in ("", "_", "-", " ")))
ACCOUNT_CUES = ("iban", "account", "ssn", "passport", "routing")
#: Fixed prefixes of access keys, with the characters that follow.
KEY_PREFIXES = {"AKIA": 16, "ASIA": 16, "ghp_": 36}
#: The length of an IBAN by country.
IBAN_LENGTHS = {
    item[:2]: int(item[2:])
    for item in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18"
        " FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21"
        " LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27"
        " ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
    ).split()
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+")
_URL = re.compile(r"[^\s<>\"'`{}|\\^]+")
_SECRET = re.compile(r"[\"']?\s{0,3}(=|:|is\s)\s{0,3}([\"']?)([A-Za-z0-9_\-+/=.!@#$%^&*]{8,})")
_BEARER = re.compile(r"\s{1,3}([A-Za-z0-9_\-+/=.~]{16,})")
_KEY = re.compile(r"[A-Za-z0-9]+")
_MIXED = re.compile(r"[a-z][A-Z]")
_SSN = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z]|-[0-9])")
_CUE_END = re.compile(r"(?:\s{0,3}(?:number|no\.?|#|:|=|is)){0,3}\s{0,3}", re.IGNORECASE)
# A further group belongs to an account only if it holds a digit.
_ACCOUNT = re.compile(r"[A-Z]{0,2}[0-9][A-Z0-9]*(?:[ -](?=[A-Z]*[0-9])[A-Z0-9]+)*")
_LOWER = {k: k + 32 for k in range(65, 91)}


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    anchors = {"@": "at", "+": "plus"} | {str(d): "digit" for d in range(10)}
    anchors |= {"bearer": "bearer"} | {prefix.lower(): "key" for prefix in KEY_PREFIXES}
    for kind, words in (("scheme", SCHEMES), ("secret", SECRET_CUES), ("account", ACCOUNT_CUES)):
        anchors |= dict.fromkeys(words, kind)
    for word, kind in anchors.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    value = value.replace(" ", "")
    if len(value) != IBAN_LENGTHS.get(value[:2]):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _email(text: str, at: int, last: int) -> tuple[int, int] | None:
    """From an at-sign: the local part back to ``last``, then the domain."""
    start = at
    while start > last and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    domain = _DOMAIN.match(text, at + 1)
    return (start, domain.end()) if domain else None


def _dotted(text: str, run: re.Match) -> tuple[int, int, bool] | None:
    """Four runs of digits joined by single dots, from the first run: start, end, valid."""
    parts = [run]
    while len(parts) < 4:
        end = parts[-1].end()
        following = _DIGITS.match(text, end + 1) if text[end : end + 1] == "." else None
        if following is None:
            return None
        parts.append(following)
    return run.start(), parts[-1].end(), all(_at_most_255(p.group()) for p in parts)


def _at_most_255(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _phone(text: str, plus: int) -> tuple[int, int, bool] | None:
    found = _PHONE.match(text, plus)
    if not found:
        return None
    body = found.group().rstrip(" ().-")
    if len(body) < 4:
        return None
    digits = sum(c.isdigit() for c in body)
    return plus, plus + len(body), 9 <= digits <= 15


def _iban(text: str, start: int) -> tuple[int, int] | None:
    """From a country code: as many letters and digits as the country has, single spaces between."""
    wanted = IBAN_LENGTHS.get(text[start : start + 2])
    if wanted is None or (start and text[start - 1].isalnum()):
        return None
    at, taken = start, []
    while len(taken) < wanted:
        at += text[at : at + 1] == " " and bool(taken)
        c = text[at : at + 1]
        if not (c.isascii() and (c.isdigit() or c.isupper())):
            return None
        taken.append(c)
        at += 1
    if text[at : at + 1].isalnum() or not iban_valid("".join(taken)):
        return None
    return start, at


def _secret(text: str, at: int) -> tuple[int, int, bool] | None:
    """The value behind a cue: start, end, and whether it looks like a secret.

    It has a digit or, after an equals sign or colon, is quoted or mixes cases within a word.
    """
    found = _SECRET.match(text, at)
    if not found:
        return None
    sign, quote, value = found.groups()
    value = value.rstrip(".!")
    wanted = any(c.isdigit() for c in value) or (sign in "=:" and bool(quote or _MIXED.search(value)))
    return found.start(3), found.start(3) + len(value), wanted and len(value) >= 8


def find(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """All spans as (kind number, start, end), in order of kind and start.

    A base kind's spans are its leftmost matches that do not overlap; a match that fails
    validation is dropped and the search goes on behind it.
    """
    spans: list[tuple[int, int, int]] = []
    email_end = ip_from = card_end = phone_end = url_end = iban_end = secret_end = account_end = 0
    low = text.lower()
    for end, (kind, length) in automaton.iter(low if len(low) == len(text) else text.translate(_LOWER)):
        start = end + 1 - length
        if kind == "digit":
            if start >= ip_from:
                run = _DIGITS.match(text, start)
                dotted = _dotted(text, run)
                if dotted:
                    ip_from = dotted[1]
                    if dotted[2]:
                        spans.append((1, *dotted[:2]))
                else:
                    ip_from = run.end()
            if start >= card_end:
                chain = _CHAIN.match(text, start)
                card_end = chain.end()
                digits = chain.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    spans.append((2, start, card_end))
            before = text[start - 1 : start]
            if start - 2 >= iban_end and before.isupper():
                iban = _iban(text, start - 2)
                if iban:
                    iban_end = iban[1]
                    spans.append((5, *iban))
            elif text[start + 3 : start + 4] == "-" and not before.isalnum() and before != "-":
                ssn = _SSN.match(text, start)
                if ssn:
                    spans.append((8, *ssn.span()))
        elif kind == "at":
            if start >= email_end:
                email = _email(text, start, email_end)
                if email:
                    email_end = email[1]
                    spans.append((0, *email))
        elif kind == "plus":
            if start >= phone_end:
                phone = _phone(text, start)
                if phone:
                    phone_end = phone[1]
                    if phone[2]:
                        spans.append((3, *phone[:2]))
        elif kind == "scheme":
            if start >= url_end and not (start and text[start - 1].isalnum()):
                url = _URL.match(text, end + 1)
                if url:
                    url_end = end + 1 + len(url.group().rstrip(".,;:!?)]"))
                    if url_end > end + 1:
                        spans.append((4, start, url_end))
        elif kind == "secret":
            if start >= secret_end:
                secret = _secret(text, end + 1)
                if secret:
                    secret_end = secret[1]
                    if secret[2]:
                        spans.append((6, *secret[:2]))
        elif kind == "bearer":
            bearer = _BEARER.match(text, end + 1)
            if bearer and start >= secret_end and any(c.isdigit() for c in bearer.group(1)):
                secret_end = bearer.end(1)
                spans.append((6, bearer.start(1), secret_end))
        elif kind == "key":
            rest = KEY_PREFIXES.get(text[start : end + 1])
            if rest and start >= secret_end and not (start and text[start - 1].isalnum()):
                value = _KEY.match(text, end + 1)
                if value and len(value.group()) == rest:
                    secret_end = value.end()
                    spans.append((6, start, secret_end))
        elif start >= account_end and not (start and text[start - 1].isalnum()):
            there = _CUE_END.match(text, end + 1).end()
            account = _ACCOUNT.match(text, there)
            iban = _iban(text, there)
            if iban:
                # The digits of the number anchor its own span.
                account_end = iban[1]
            elif account and not _SSN.match(text, there) and sum(c.isdigit() for c in account.group()) >= 6:
                account_end = account.end()
                spans.append((7, *account.span()))
    return sorted(spans)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


_FOUND: list = []


def spans_of(text: str | None) -> list[tuple[int, int, int]]:
    if not _FOUND:
        _FOUND.append(_automaton())
    return find(text, _FOUND[0]) if text else []


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, a count per base kind, base_sha256 and all spans.

    A null or empty text has no spans; spans count code points, ends excluded. Rows are
    independent: repeated or null ids, ties, an empty table and extra columns are harmless.
    """

    def run(ids, texts):
        found = [spans_of(t) for t in texts]
        base = [[s for s in spans if s[0] < len(BASE)] for spans in found]
        out = {"doc_id": pa.array(ids, pa.int64())}
        for k, kind in enumerate(BASE):
            out[f"n_{kind}"] = pa.array([sum(s[0] == k for s in spans) for spans in base], pa.int64())
        out["base_sha256"] = [hashlib.sha256(listed(spans).encode()).hexdigest() for spans in base]
        return out | {"spans": [listed(spans) for spans in found]}

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    counts = ", ".join(f"n_{kind} bigint" for kind in BASE)
    return map_rows(slim, ["doc_id", "text"], run, f"doc_id bigint, {counts}, base_sha256 string, spans string")


def masked(text: str | None) -> str | None:
    """The text with every span, joined where they overlap, replaced by its kind's name."""
    spans = sorted(((a, b, k) for k, a, b in spans_of(text)))
    if not spans:
        return text
    joined: list[list[int]] = []
    for a, b, k in spans:
        if joined and a < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b, k])
    out, last = [], 0
    for a, b, k in joined:
        out += [text[last:a], f"[{KINDS[k].upper()}]"]
        last = b
    return "".join([*out, text[last:]])


@F.pandas_udf(T.StringType())
def _mask(texts: pd.Series) -> pd.Series:
    return pd.Series([masked(t) for t in texts], dtype=object)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked; ``n_chars``, where present, follows the new text.

    Null texts stay null, empty ones empty. Rows are independent: ids may be null, tied or
    repeated, an empty table stays empty, and all other columns, whatever their names, are kept.
    """
    small_batches(docs.sparkSession)
    out = docs.withColumn("text", _mask(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
