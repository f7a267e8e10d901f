"""Text expressions: answers, templates, lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# The answer heading and the leak phrases of the record format.
RESULT_STRICT = r"#\s*Prediction\s+Result\s*#\s*[\r\n]+\s*([01])"
RESULT_LOOSE = r"#\s*Prediction\s+Result\s*#\s*([01])"
LEAK = r"is [01]"
# Every character that counts as white space at the ends of a text.
SPACES = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove all white space at both ends (``trim`` removes blanks only)."""
    return F.btrim(c, F.lit(SPACES))


def is_leak(c: Column, pattern: str = LEAK) -> Column:
    """True for a missing, blank or label-revealing text."""
    return F.coalesce((strip(c) == "") | F.lower(c).rlike(pattern), F.lit(True))


def answer_label(c: Column, strict: bool = True) -> Column:
    """First 0/1 after the result heading, 0 when there is none.

    The strict form needs a line break after the heading.
    """
    pattern = "(?i)" + (RESULT_STRICT if strict else RESULT_LOOSE)
    digit = F.regexp_extract(c, pattern, 1)
    return F.when(digit == "1", F.lit(1)).otherwise(F.lit(0))


def truncate_answer(c: Column, strict: bool = True) -> Column:
    """Text up to the first result and the white space after it; stripped text if none."""
    pattern = "(?is)^(.*?" + (RESULT_STRICT if strict else RESULT_LOOSE) + r"[ \t\r\n]*)"
    head = F.regexp_extract(c, pattern, 1)
    return F.when(head == "", strip(c)).otherwise(head)


def fill(template: str, slots: Mapping[str, Column]) -> Column:
    """Replace ``{name}`` slots by columns; text inside a column is not filled again."""
    parts: list[Column] = []
    rest = template
    while rest:
        found = [(rest.find("{%s}" % name), name) for name in slots if "{%s}" % name in rest]
        if not found:
            parts.append(F.lit(rest))
            break
        at, name = min(found)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(slots[name])
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts) if parts else F.lit("")


def split_trim(c: Column, sep: str = ";") -> Column:
    """Array of stripped items."""
    return F.transform(F.split(c, "\\Q" + sep + "\\E"), strip)


def zip_lists(a: Column, b: Column, sep: str = ";") -> Column:
    """Pairs of two joined lists, cut to the shorter one."""
    xs, ys = split_trim(a, sep), split_trim(b, sep)
    n = F.least(F.size(xs), F.size(ys))
    return F.zip_with(
        F.slice(xs, F.lit(1), n),
        F.slice(ys, F.lit(1), n),
        lambda x, y: F.struct(x.alias("a"), y.alias("b")),
    )


def words(c: Column) -> Column:
    """Tokens separated by white space."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def keep_last_words(c: Column, n: int) -> Column:
    """The text from its ``n``-th last token on, as it stands; a shorter text is left as it is."""
    parts = F.regexp_extract_all(c, F.lit(r"\S+\s*"), F.lit(0))
    return F.when(F.size(parts) > n, F.array_join(F.slice(parts, -n, n), "")).otherwise(c)
