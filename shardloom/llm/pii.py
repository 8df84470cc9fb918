"""Personal data: patterns propose spans, checksums confirm, context adjusts.

Kinds with a fixed contract (``email``, ``ip``, ``card``, ``phone``) are kept
whenever pattern and validator agree; their score still tells how sure the
find is.  Further kinds need more than a pattern: ``iban`` the mod-97 check
(of the country's length, whatever words follow),
``card_short`` (13 to 15 digits) the Luhn check and a card word nearby,
``national_id`` (ddd-dd-dddd) an identity word nearby.  A span's score starts
from its kind and validator and rises with whole context words within
``CONTEXT`` characters.

Rows are independent: one pass, no shuffle.  Offsets are code points, end
exclusive, in the whole text.

Edge cases: null and empty texts have no spans; overlapping spans of different
kinds are all reported and merged when redacting; extra columns are kept, one
with the name of the output (in any case) is replaced.  Scanning is linear in the
length of a text, whatever it holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.llm.common import add_columns, columns_but, python_ready, small_batches

#: The kinds and patterns of the contract.
BASE_KINDS = ("email", "ip", "card", "phone")
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

ADDED_KINDS = ("iban", "card_short", "national_id")
KINDS = BASE_KINDS + ADDED_KINDS
CONTEXT = 48
THRESHOLD = 0.5
#: kind -> (score of a validated span, context words that raise it)
PRIOR = {
    "email": (0.9, ("mail", "email", "contact", "write", "@")),
    "ip": (0.6, ("ip", "host", "server", "address", "login")),
    "card": (0.8, ("card", "visa", "mastercard", "credit", "payment", "karte", "carte", "tarjeta")),
    "phone": (0.7, ("phone", "telephone", "tel", "call", "fax", "mobile")),
    "iban": (0.8, ("iban", "bank", "account", "konto", "compte", "cuenta")),
    "card_short": (0.3, ("card", "visa", "amex", "credit", "payment", "karte", "carte", "tarjeta")),
    "national_id": (0.3, ("ssn", "social", "security", "passport", "identity")),
}
CONTEXT_GAIN = 0.3

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType(), False),
        T.StructField("start", T.IntegerType(), False),
        T.StructField("end", T.IntegerType(), False),
        T.StructField("score", T.DoubleType(), False),
    ]
)

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_email, _card, _phone = (re.compile(p) for p in (EMAIL, CARD, PHONE))
#: What IP finds, in linear time: a leftmost match starts where a run of digits does, and takes whole runs.
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_cue = re.compile(r"[^\W\d_]+|@")
_iban = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Length of the account numbers of each country (ISO 13616).
IBAN_LENGTH = {
    k: n
    for n, ks in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
        31: "MT SC", 32: "LC",
    }.items()
    for k in ks.split()
}
_national = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 mod 97-10 over the account number with its head moved back."""
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of EMAIL.  A match holds one '@', and
    starts where the run of local characters before it starts, so looking
    around each '@' finds what a scan from the left would."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _email.match(text, start) if start < at else None
        if m:
            yield m.span()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers that pass mod-97.  A proposal runs on across blanks, so it
    may hold the words after the number: it is cut at the group that ends at the
    country's length, or, in a country without one, at the longest run of groups
    that passes.  After a rejected head the scan goes on right behind it."""
    m = _iban.search(text)
    while m:
        start, size, ends = m.start(), 0, []
        for group in m.group().split(" "):
            size += len(group)
            ends.append((size, start + size + len(ends)))
        least = IBAN_LENGTH.get(text[start : start + 2])
        tried = [e for e in reversed(ends) if e[0] >= 15] if least is None else [e for e in ends if e[0] == least] + ends[-1:]
        end = next((e for _, e in tried if mod97(text[start:e].replace(" ", ""))), None)
        if end is not None:
            yield start, end
        m = _iban.search(text, start + 4 if end is None else end)


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start."""
    if not text:
        return []
    found = [("email", a, b) for a, b in _emails(text)]
    for m in _ip.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            found.append(("ip", *m.span()))
    short = []
    for m in _card.finditer(text):
        n = m.end() - m.start()
        if not 13 <= n <= 37:  # 19 digits and a blank before each but the first
            continue
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            (found if len(digits) >= 16 else short).append(("card" if len(digits) >= 16 else "card_short", *m.span()))
    if "+" in text:
        for m in _phone.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                found.append(("phone", *m.span()))
    found += [("iban", a, b) for a, b in _ibans(text)]
    found += short
    found += [("national_id", *m.span()) for m in _national.finditer(text)]
    scored = []
    for kind, start, end in found:
        prior, cues = PRIOR[kind]
        near = set(_cue.findall((text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]).lower()))
        score = min(1.0, prior + CONTEXT_GAIN * (not near.isdisjoint(cues)))
        if kind in BASE_KINDS or score >= THRESHOLD:
            scored.append((kind, start, end, score))
    return scored


def find_pii(docs: DataFrame, *, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` plus ``out``: array of (kind, start, end, score)."""
    python_ready(docs.sparkSession)
    kept = docs.select(*columns_but(docs, [out]))
    at = kept.columns.index(text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        names = ("kind", "start", "end", "score")
        for batch in batches:
            for part in small_batches(batch, at):
                spans = [[dict(zip(names, s, strict=True)) for s in find_spans(t)] for t in part.column(at).to_pylist()]
                yield part.columns, [pa.array(spans, kind)]

    return add_columns(kept, [T.StructField(out, T.ArrayType(SPAN, False))], run)


def redact(found: DataFrame, *, text: str = "text", spans: str = "spans") -> DataFrame:
    """Replace each span by [KIND]; a span that starts inside an earlier one is dropped with it."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], F.upper(s["kind"]).alias("kind"))))
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def step(acc, s):
        piece = F.concat(acc["text"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]"))
        after = F.struct(piece.alias("text"), s["end"].alias("at"))
        inside = F.struct(acc["text"].alias("text"), F.greatest(acc["at"], s["end"]).alias("at"))
        return F.when(s["start"] >= acc["at"], after).otherwise(inside)

    end = F.aggregate(ordered, start, step)
    cut = F.concat(end["text"], F.substring(F.col(text), end["at"] + 1, F.length(text)))
    return found.withColumn(text, F.when(F.size(spans) > 0, cut).otherwise(F.col(text)))


def of_kind(spans, kind: str) -> F.Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def joined(spans, kinds=KINDS) -> F.Column:
    """kind:start:end of the spans of these kinds, by kind as listed, then start, comma-joined."""
    of = F.concat(*(of_kind(spans, k) for k in kinds))
    return F.concat_ws(",", F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
