"""Token counts without a vocabulary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any script, as a part of a character class that Java, RE2 and Python read alike.
SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
#: A token is a longest run of letters or digits, or any other single character that is not white space.
TOKEN = rf"[\p{{L}}\p{{N}}]+|[^{SPACE}\p{{L}}\p{{N}}]"


def n_tokens(text: Column) -> Column:
    """Number of tokens of a whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("bigint")


def plain_source(source: Column) -> Column:
    """A source name in lower case without white space around it."""
    return F.lower(F.regexp_replace(source, rf"^[{SPACE}]+|[{SPACE}]+$", ""))
