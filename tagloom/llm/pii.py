"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text: at-signs, digits, plus signs before digits, schemes and words
that announce an identifier. Local parsers expand each anchor to its boundaries and validate what they found. Every
parser looks only around its anchor and never behind the end of the last span of its kind, so a text takes linear time.

Null and empty texts have no spans. Positions are code points, ends exclusive. Rows are independent of each other, so
repeated rows get equal answers, and further columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
ADDRESS = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
URL_REST = re.compile(r"[^\s<>\"'`|]+")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}")
CUES = ("iban", "account", "acct", "konto", "compte", "cuenta")
AFTER_CUE = re.compile(r"(?:[ ]?(?:no|nr|number|numero)\b)?[.:#= ]{0,4}([A-Z]{0,2}[0-9](?:[ -]?[A-Z0-9]){5,33})(?![A-Za-z0-9])")


@lru_cache(1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", "@")
    found.add_word("://", ":")
    for d in "0123456789":
        found.add_word(d, "0")
        found.add_word("+" + d, "+")
    for w in ("www.", "WWW."):
        found.add_word(w, "w")
    for cue in CUES:
        for form in (cue, cue.capitalize(), cue.upper()):
            found.add_word(form, "#" + cue)
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def iban(text: str) -> bool:
    """The check digits of an international account number."""
    x = text.replace(" ", "")
    return 15 <= len(x) <= 34 and int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def find(text: str | None) -> list[tuple[int, int, str]]:
    """Spans as (start, end, kind), in order of start, then kind."""
    if not text:
        return []
    spans: list[tuple[int, int, str]] = []
    last = dict.fromkeys(KINDS, 0)
    run = 0
    for end, what in _anchors().iter(text):
        at = end + 1
        if what == "0":
            if end < run:
                continue
            run = DIGITS.match(text, end).end()
            if end >= last["ip"] and text[run : run + 1] == "." and (m := ADDRESS.match(text, end)):
                last["ip"] = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                    spans.append((end, m.end(), "ip"))
            if end >= last["card"] and (m := CARD.match(text, end)):
                last["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    spans.append((end, m.end(), "card"))
        elif what == "@":
            start = end
            while start > last["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < end and (m := DOMAIN.match(text, at)):
                last["email"] = m.end()
                spans.append((start, m.end(), "email"))
        elif what == "+":
            if end - 1 >= last["phone"] and (m := PHONE.match(text, end - 1)):
                last["phone"] = m.end()
                if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    spans.append((m.start(), m.end(), "phone"))
        elif what in ":w":
            start = end - 2 if what == ":" else end - 3
            while what == ":" and start > last["url"] and text[start - 1] in SCHEME:
                start -= 1
            if start >= last["url"] and text[start].isalpha() and (m := URL_REST.match(text, at)):
                stop = at + len(m[0].rstrip(".,;:!?)]}"))
                last["url"] = m.end()
                if stop > at:
                    spans.append((start, stop, "url"))
        elif at >= last["account"] and (m := AFTER_CUE.match(text, at)):
            begin, stop = m.span(1)
            full = IBAN.match(text, begin)
            if full and iban(full[0]):
                stop = full.end()
            last["account"] = stop
            spans.append((begin, stop, "account"))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (s[0], order[s[2]]))


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def find_personal_data(documents: DataFrame) -> DataFrame:
    """doc_id and spans, an array of (start, end, kind) in order of start, then kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"start": a, "end": b, "kind": k} for a, b, k in find(t.as_py())] for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "spans": pa.array(found, _SPAN)})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, spans array<struct<start:bigint,end:bigint,kind:string>>")


def digest(documents: DataFrame) -> DataFrame:
    found = find_personal_data(documents)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(number, BASE), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))
