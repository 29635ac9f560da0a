"""Message masking and identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Masking rules in the order in which they apply. (?U) gives \d, \w and
#: \b their Unicode meaning.
MASKS = (
    (r"(?U)0x[0-9a-fA-F]+", "<HEX>"),
    (r"(?U)\b(?:\d{1,3}\.){3}\d{1,3}\b", "<IP>"),
    (r"(?U)\bR\d{2}-M\d-N\d+(?:-[A-Za-z]+)?(?::J\d+-U\d+)?\b", "<NODE>"),
    (r"(?U)\b[0-9a-fA-F]{8,}\b", "<HEX>"),
    (r"(?U)(?:/[\w.\-]+){2,}/?", "<PATH>"),
    (r"(?U)\b\d+(?:\.\d+)?\b", "<NUM>"),
)
#: White space as headers and messages see it, Unicode's and the separators U+001C to U+001F.
BLANK_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
BLANKS = f"[{BLANK_CHARS}]+"
#: Those of texts that are ASCII, a pattern that costs a fraction of the other.
ASCII_BLANKS = "[" + "".join(c for c in BLANK_CHARS if c < "\x80") + "]+"


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def is_plain(text: Column) -> Column:
    """Whether text is ASCII, whole, without NUL and with no blanks but spaces. A search for each of the
    characters takes a third of a pattern's time."""
    out = F.is_valid_utf8(text) & is_ascii(text)
    for char in "\0\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f":
        out &= ~F.contains(text, F.lit(char))
    return out


def split_blanks(text: Column, limit: int, plain: Column | None = None) -> Column:
    """text split at BLANKS; most lines are plain with single spaces and need no pattern. plain: is_plain, where it is known."""
    plain = is_plain(text) if plain is None else plain
    ascii_split = F.when(~F.contains(text, F.lit("  ")) & plain, F.split(text, " ", limit)).otherwise(F.split(text, ASCII_BLANKS, limit))
    return F.when(plain | is_ascii(text), ascii_split).otherwise(F.split(text, BLANKS, limit))


def strip(text: Column, plain: Column | None = None) -> Column:
    """text without BLANKS at its ends; plain: is_plain, where it is known, for which spaces are all there is to strip."""
    whole = F.btrim(text, F.lit(BLANK_CHARS))
    return whole if plain is None else F.when(plain, F.trim(text)).otherwise(whole)


#: ASCII texts without any of these need two of the masks, in ASCII's meaning, and keep their white space. No mask brings
#: one of them in.
_RARE = ("0x", ".", "-M", "/", "  ")
_PLAIN_MASKS = tuple((pattern.removeprefix("(?U)"), mask) for pattern, mask in (MASKS[3], MASKS[5]))


def mask_message(message: Column, plain: Column | None = None) -> Column:
    """The template of a message: variable parts masked, white space collapsed. plain: is_plain, where it is known."""
    plain = is_plain(message) if plain is None else plain
    for part in _RARE:
        plain &= ~F.contains(message, F.lit(part))
    short = message
    for pattern, mask in _PLAIN_MASKS:
        short = F.regexp_replace(short, pattern, mask)
    # Masks are ASCII, so the masked message is where the message is.
    blanks = F.when(is_ascii(message), F.lit(ASCII_BLANKS)).otherwise(F.lit(BLANKS))
    for pattern, mask in MASKS:
        message = F.regexp_replace(message, pattern, mask)
    return F.trim(F.when(plain, short).otherwise(F.regexp_replace(message, blanks, F.lit(" "))))


def template_id(template: Column) -> Column:
    """First 16 hex digits of the template's SHA-1."""
    return F.substring(F.sha1(template), 1, 16)


def escape_nul(text: Column) -> Column:
    """NUL as the four characters that name it, for stores that can't hold it."""
    return F.replace(text, F.lit("\x00"), F.lit("\\x00"))


def detector_label(detector: Column, variant: Column) -> Column:
    """Name of a detector, with its variant where it has one."""
    return F.when(variant == "-", detector).otherwise(F.concat(detector, F.lit(" ("), variant, F.lit(")")))


def percent(share: Column) -> Column:
    # Exact halves go to the even digit.
    return F.format_string("%.1f%%", F.bround(share * 100, 1))


def page_offset(index: Column, page: int, total: int = 0) -> Column:
    """Start of the page that holds index; 0 for what lies outside. total 0: unknown."""
    valid = index.isNotNull() & ~F.isnan(index.cast("double")) & (index >= 0)
    if total:
        valid &= index < total
    return F.when(valid, (F.floor(index / page) * page).cast("long")).otherwise(F.lit(0).cast("long"))
