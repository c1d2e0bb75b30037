"""Text functions as column expressions: no Python on the scan of a corpus.

A document is a header line, a blank line and a body.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Thresholds of valid text; callers may pass their own, and so may a session's settings.
MIN_LENGTH, MIN_PRINTABLE = 100, 0.85
SETTINGS = {"min_length": ("spark.docquarry.minLength", int), "min_printable": ("spark.docquarry.minPrintable", float)}

#: First bytes of binary files and their names, in order of precedence.
MAGIC = [
    (b"PK", "ZIP archive"),
    (b"Rar!", "RAR archive"),
    (b"7z\xbc\xaf", "7-Zip archive"),
    (b"MZ", "DOS/Windows EXE"),
    (b"\x7fELF", "Linux ELF binary"),
    (b"RIFF", "AVI/WAV container"),
    (b"CWS", "Compressed SWF (Flash)"),
    (b"FWS", "Uncompressed SWF (Flash)"),
    (b"OggS", "Ogg container"),
    (b"fLaC", "FLAC audio"),
    (b"ID3", "MP3 with ID3 tag"),
    (b"\xff\xfb", "MP3 audio"),
    (b"GIF87a", "GIF image"),
    (b"GIF89a", "GIF image"),
    (b"\x89PNG", "PNG image"),
    (b"\xff\xd8\xff", "JPEG image"),
    (b"BM", "BMP image"),
    (b"%PDF", "PDF document"),
    (b"\xd0\xcf\x11\xe0", "MS Office (old)"),
    (b"PK\x03\x04", "MS Office (new)/EPUB"),
]

#: Fixed value: archive URLs, a 14-digit time and the original URL.
ARCHIVE_URL = r"^https?://web\.archive\.org/web/(\d{14})/(.+)$"


def content_body(content: Column) -> Column:
    """What follows the first blank line; the whole text if there is none."""
    at = F.instr(content, "\n\n")
    return F.when(at > 0, F.substring(content, at + 2, F.length(content))).otherwise(content)


def url_header(content: Column) -> Column:
    """What comes before the first blank line; empty if there is none."""
    at = F.instr(content, "\n\n")
    return F.when(at > 0, F.substring(content, F.lit(1), at - 1)).otherwise("")


def binary_type(body: Column) -> Column:
    """The name of the binary format that a body starts like, or null.

    A text never starts with bytes that are no UTF-8, so those formats can't match.
    """
    out = F.lit(None).cast("string")
    for magic, name in reversed(MAGIC):
        if max(magic) < 128:
            out = F.when(F.startswith(body, F.lit(magic.decode())), name).otherwise(out)
    return out


def printable_ratio(body: Column) -> Column:
    """Characters that print, or are blanks and line ends, over all; null for an empty text."""
    printed = F.length(F.regexp_replace(body, r"[\p{C}\p{Z}&&[^ \n\r\t]]", ""))
    return F.when(F.length(body) > 0, printed / F.length(body))


def _percent(ratio: Column) -> Column:
    """A ratio in per cent with one digit; a tie goes to the even digit.

    The exact value of the double is rounded, as printf does, and not its shortest decimal form, which may be a tie
    where the double is none.  So the fraction is a whole number of 2^-57: 0.05, the smallest tie, and all above it are.
    """

    def rounded(percent: Column) -> Column:
        whole = F.floor(percent)
        tenths = ((percent - whole) * float(1 << 57)).cast("long") * 10
        digit, rest = F.shiftright(tenths, 57), tenths.bitwiseAND(F.lit((1 << 57) - 1))
        up = (rest > 1 << 56) | ((rest == 1 << 56) & (digit % 2 == 1))
        out = whole * 10 + digit + up.cast("long")
        return F.concat(F.floor(out / 10).cast("string"), F.lit("."), (out % 10).cast("string"), F.lit("%"))

    return F.transform(F.array(ratio * 100), rounded)[0]


def reason(content: Column, *, flight: bool = False, min_length: int = MIN_LENGTH, min_printable: float = MIN_PRINTABLE) -> Column:
    """Why a text is rejected, null if it is valid: by the sync of documents, or by preflight.

    The body is a lambda's variable: each check uses it, and a filter on the
    reason copies the whole expression, which would outgrow generated code if
    the body stood in it as often.
    """

    def checks(body: Column) -> Column:
        length, kind, ratio = F.length(body).cast("string"), binary_type(body), printable_ratio(body)
        if flight:
            short, binary, tail = F.concat(F.lit("body too short ("), length, F.lit(f" chars, need {min_length})")), "binary content (", f", need {min_printable:.0%})"
        else:
            short, binary, tail = F.concat(F.lit("content too short ("), length, F.lit(" chars)")), "binary content detected (", ")"
        out = F.when(F.coalesce(F.length(content), F.lit(0)) == 0, "empty content")
        if flight:
            out = out.when(F.length(body) == 0, "no body after header")
        return (
            out.when(F.length(body) < min_length, short)
            .when(kind.isNotNull(), F.concat(F.lit(binary), kind, F.lit(")")))
            .when(F.instr(content, "\0") > 0, "contains null bytes")
            .when(ratio < min_printable, F.concat(F.lit("low printable ratio ("), _percent(ratio), F.lit(tail)))
        )

    return F.transform(F.array(content_body(content)), checks)[0]


def with_reason(df: DataFrame, content: str = "content", to: str = "reason", **how) -> DataFrame:
    """``df`` with the ``reason`` of its contents; thresholds that ``how`` doesn't give are the session's."""
    return df.withColumn(to, reason(F.col(content), **thresholds(df.sparkSession) | how))


def thresholds(spark: SparkSession) -> dict:
    """The thresholds that the session's settings give."""
    found = {name: (spark.conf.get(key, None), kind) for name, (key, kind) in SETTINGS.items()}
    return {name: kind(value) for name, (value, kind) in found.items() if value is not None}


def archive_time(url: Column) -> Column:
    """The 14-digit time of an archive URL, or null."""
    found = F.regexp_extract(url, ARCHIVE_URL, 1)
    return F.when(found != "", found)


def archive_target(url: Column) -> Column:
    """The original URL of an archive URL, or null."""
    found = F.regexp_extract(url, ARCHIVE_URL, 2)
    return F.when(found != "", found)


def file_name(url: Column) -> Column:
    """A file's name for a URL: no scheme, no unsafe characters, 200 characters and ``.md`` at most."""
    name = F.regexp_replace(F.regexp_replace(url, "^https?://", ""), r"[/:?&=\\]", "_")
    name = F.regexp_replace(F.regexp_replace(name, "_+", "_"), "^_|_$", "")
    return F.concat(F.substring(name, 1, 200), F.lit(".md"))


def custom_id(result_id: Column, category_id: Column) -> Column:
    return F.concat(F.lit("r"), result_id.cast("string"), F.lit("_c"), category_id.cast("string"))


CUSTOM_ID = r"^r(\d+)_c(\d+)$"


def custom_id_parts(custom: Column) -> tuple[Column, Column]:
    """The result and category of a custom id; null if it is none."""
    first, second = (F.regexp_extract(custom, CUSTOM_ID, k).try_cast("long") for k in (1, 2))
    return first, second


def reasoning_before_json(text: Column) -> Column:
    """What comes before the last ``{``, stripped; empty if there is none."""
    last = F.instr(F.reverse(text), "{")
    head = F.substring(text, F.lit(1), F.length(text) - last)
    return F.when(F.instr(text, "{") == 0, "").otherwise(strip(head))


#: What counts as white space at the ends of a text, beyond Java's ``\s``.
SPACE = r"\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def strip(text: Column) -> Column:
    """Without white space at its ends.  The lookbehind keeps the second pattern linear."""
    return F.regexp_replace(F.regexp_replace(text, f"^[{SPACE}]+", ""), f"(?<![{SPACE}])[{SPACE}]+$", "")


def universal_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def literal_count(low: Column, term: str) -> Column:
    """How often a term occurs in a lower-case text, without overlaps."""
    return ((F.length(low) - F.length(F.replace(low, F.lit(term), F.lit("")))) / len(term)).cast("int")


def terms_of_prompt(prompt: str) -> list[str]:
    """Quoted terms of a category's prompt, of any length, lower-case, for the rule backend."""
    return sorted({t.lower() for t in re.findall(r'"([^"\n]+)"', prompt or "")})
