"""ASCII letters to lower case, with no other character touched."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_ascii(text: Column) -> Column:
    """A-Z become a-z. In pure ASCII ``lower`` does just that, and is much faster."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
