"""Text expressions on Columns: strip, clean, decode and mask.

Everything here stays inside the JVM.  The whitespace and word-character rules
are those of Unicode text handling, not Java's ASCII defaults, so each pattern
spells its character classes out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerworks.functions.columns import as_column, bind

# The code points that count as whitespace when stripping.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The code points that end a line; CR LF together end one.
LINE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

# Whitespace that can stand inside a line.
INLINE_SPACE = "".join(c for c in WHITESPACE if c not in LINE_BREAKS)

# The labels put in place of masked text.
EMAIL_LABEL = "[REDACTED_EMAIL]"
PHONE_LABEL = "[REDACTED_PHONE]"

_WORD = "\\p{L}\\p{N}_"

# An address can only start where a run of its characters starts, or where the
# previous match ended.  Saying so, with possessive runs, keeps the scan linear
# on megabyte-long unbroken lines.
_EMAIL = f"(?:\\G|(?<![{_WORD}.+-]))[{_WORD}.+-]++@[{_WORD}-]++\\.[{_WORD}.-]++"

# The character before the number is captured and put back: a look-behind goes
# wrong after supplementary characters.
_PHONE = (
    f"(\\A|[^{_WORD}])0\\p{{Nd}}{{1,4}}-?\\p{{Nd}}{{1,4}}-?\\p{{Nd}}{{3,4}}(?![{_WORD}])"
)


def _when_holds(parts: Sequence[str], change: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Apply a pattern only to texts that hold one of some substrings.

    A substring test costs a small part of a pass of the pattern.
    """

    def changed(text: Column) -> Column:
        present = reduce(or_, (F.contains(text, F.lit(part)) for part in parts))
        return F.when(present, change(text)).otherwise(text)

    return changed


def strip(text: Column | str) -> Column:
    """Remove whitespace, in the Unicode sense, from both ends."""
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def decode_utf8(content: Column | str) -> Column:
    """Bytes to text; byte sequences that are not UTF-8 become U+FFFD."""
    return F.make_valid_utf8(as_column(content).cast("string"))


def normalize_line_breaks(text: Column | str) -> Column:
    """Make every line end a line feed."""
    others = [c for c in LINE_BREAKS if c != "\n"]
    pattern = f"\\r\\n|[{''.join(others)}]"
    normalize = _when_holds(others, lambda text: F.regexp_replace(text, pattern, "\n"))
    return bind(as_column(text), normalize)


# Looking back from the first blank finds where a run starts, so that a long run
# is not scanned again from each of its blanks.
_drop_blanks = _when_holds(
    [" \n", "\t\n"],
    lambda text: F.regexp_replace(text, "[ \\t](?<![ \\t]{2})[ \\t]*+\\n", "\n"),
)
_join_blank_lines = _when_holds(
    ["\n\n\n"], lambda text: F.regexp_replace(text, "\\n{3,}", "\n\n")
)
_mask_emails = _when_holds(["@"], lambda text: F.regexp_replace(text, _EMAIL, EMAIL_LABEL))
_mask_phones = _when_holds(
    ["0"], lambda text: F.regexp_replace(text, _PHONE, f"$1{PHONE_LABEL}")
)


def clean_text(text: Column | str) -> Column:
    """Drop NULs and blanks before line ends, keep one blank line at most, strip.

    Null gives the empty string.
    """
    text = F.replace(F.coalesce(as_column(text), F.lit("")), F.lit("\x00"), F.lit(""))
    return strip(bind(bind(text, _drop_blanks), _join_blank_lines))


def redact_pii(text: Column | str) -> Column:
    """Mask e-mail addresses, then telephone numbers; null stays null.

    Neither spans lines, so only lines with an '@' or a '0' meet the patterns,
    which are far dearer than cutting the text into lines.
    """
    lines = F.split(as_column(text), "\n")
    masked = F.transform(lines, lambda line: bind(bind(line, _mask_emails), _mask_phones))
    return F.array_join(masked, "\n")
