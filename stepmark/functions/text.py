"""Text stripping and tokenizing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marks of a good and a bad step, and the image placeholder.
GOOD = "<+>"
BAD = "<->"
IMAGE = "<image>"

# Fixed value: what counts as white space when a text is stripped.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The marks stay whole; else a run of ASCII word characters or one other visible character.
# (\w is ASCII here, and far faster than the same class written out.)
TOKEN_PATTERN = r"(<\+>|<->|<image>|\w+|[^\w \t\r\n])"


def trim_text(text: Column) -> Column:
    """Strip white space of every kind from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def tokenize_text(text: Column, pattern: str = TOKEN_PATTERN) -> Column:
    """Tokens of a text in order, as an array of strings."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
