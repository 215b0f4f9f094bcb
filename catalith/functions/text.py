"""Text columns: lexicons, signatures, languages, counts, chunks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes and characters of a head, terms that a hit list shows, shares of letters that name a language.
HEAD_BYTES, HEAD_CHARS, SHOWN, HANGUL_SHARE, LATIN_SHARE = 8192, 4000, 20, 0.3, 0.5
#: Blanks before a document's first sign, and where a JSON document names its type.
LEAD, RESOURCE = r"^[\ufeff\s]+", r'"resourceType"\s*:\s*"([A-Za-z]+)"'
#: Resource types whose name marks a clinical JSON document.
RESOURCES = ("Patient", "Encounter", "Observation", "ImagingStudy", "DiagnosticReport", "Condition", "Procedure", "MedicationRequest", "Bundle", "DocumentReference", "ServiceRequest", "Specimen")


def lexicon_hits(text: Column, lexicon: list[str]) -> Column:
    """The distinct terms of lexicon that text has, by name. ASCII terms stand between characters that are no letters, digits
    or _, in any case; one scan takes the longest at each place and goes on behind it, so a term within another's place is no
    hit. Other terms count anywhere. Null text: none."""
    given = F.coalesce(text, F.lit(""))
    plain = sorted({t.lower() for t in lexicon if t and t.isascii()}, key=lambda t: (-len(t), t))
    other = sorted({t for t in lexicon if t and not t.isascii()})
    none = F.array().cast("array<string>")
    scan = rf"(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(map(re.escape, plain))})(?![\p{{L}}\p{{N}}_])"
    found = F.regexp_extract_all(F.lower(given), F.lit(scan), F.lit(0)) if plain else none
    anywhere = F.filter(F.array(*[F.when(given.contains(t), F.lit(t)) for t in other]), lambda t: t.isNotNull()) if other else none
    return F.array_sort(F.array_distinct(F.concat(found, anywhere)))


def hit_count(hits: Column) -> Column:
    return F.size(hits)


def shown_hits(hits: Column) -> Column:
    """The list is cut, the count is not."""
    return F.slice(hits, 1, SHOWN)


def scan_text(name: Column, head: Column) -> Column:
    """File name and head on a line each; blank ones are left out."""
    return F.concat_ws("\n", F.nullif(F.trim(name), F.lit("")), F.when(F.trim(head) != "", head))


def head_of(text: Column, chars: int = HEAD_CHARS) -> Column:
    return F.substring(text, 1, chars)


def decoded_head(head: Column) -> Column:
    """Bytes as text without those that are no UTF-8, as where a head ends within a character. A replacement character that stands
    in the bytes themselves becomes a question mark, so that it isn't taken for such a byte."""
    return F.replace(F.make_valid_utf8(F.replace(head.cast("string"), F.lit("\ufffd"), F.lit("?"))), F.lit("\ufffd"), F.lit(""))


def signature(content: Column) -> Column:
    """dicom, hl7v2 or fhir by the bytes at the beginning; null if none fits. content: binary."""
    head = F.substring(content, 1, HEAD_BYTES)
    decoded = F.regexp_replace(decoded_head(head), LEAD, "")
    kind = F.regexp_extract(decoded, RESOURCE, 1)
    return F.when((F.length(head) >= 132) & (F.substring(head, 129, 4) == F.lit(b"DICM")), "dicom").when(decoded.startswith("MSH|"), "hl7v2").when(kind.isin(*RESOURCES), "fhir")


def signature_of_text(text: Column) -> Column:
    """The same for content that is text already."""
    decoded = F.regexp_replace(F.substring(text, 1, HEAD_BYTES), LEAD, "")
    kind = F.regexp_extract(decoded, RESOURCE, 1)
    return F.when(F.substring(text, 129, 4) == "DICM", "dicom").when(decoded.startswith("MSH|"), "hl7v2").when(kind.isin(*RESOURCES), "fhir")


def hangul(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[가-힣]"))


def latin(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[A-Za-z]"))


def language(hangul_n: Column, latin_n: Column) -> Column:
    """Of Hangul and Latin letters together: ko from 30 % Hangul, else en from 50 % Latin, else unknown; unknown without any."""
    both = hangul_n + latin_n
    return F.when(both <= 0, "unknown").when(hangul_n >= HANGUL_SHARE * both, "ko").when(latin_n >= LATIN_SHARE * both, "en").otherwise("unknown")


def sentences(text: Column) -> Column:
    """Parts between runs of . ! ? or line ends that aren't blank."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[.!?]+|\n+"), lambda s: F.trim(s) != ""))


def tokens(text: Column) -> Column:
    """Runs of characters other than white space; a tokenizer's count may take its place."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+"))


def chunks(text: Column, width: int, overlap: int = 0) -> Column:
    """Pieces of width characters, each overlap characters into the one before; none of an empty text."""
    step = width - overlap
    n = F.length(F.coalesce(text, F.lit("")))
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(text, i + 1, F.lit(width)))


def guarded(text: Column, value: Column, least: int = 15) -> Column:
    """value, but null where the trimmed text has under least characters: thin content gets no summary."""
    return F.when(F.length(F.trim(F.coalesce(text, F.lit("")))) >= least, value)
