"""Row fingerprints that keep nulls and field boundaries apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def fingerprint(cols: Sequence[str], algorithm: str = "sha1") -> Column:
    """Hex digest over the text of ``cols``.

    Each field is written as its length and its text, a null as ``-``, so
    ("ab", "c") differs from ("a", "bc") and a moved null changes the digest.
    Cast doubles to a decimal first: their text form is not portable.
    """
    if not cols:
        raise ValueError("cols must not be empty")
    parts = []
    for name in cols:
        text = F.col(name).cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        )
    joined = F.concat_ws("|", *parts)
    if algorithm == "sha1":
        return F.sha1(joined)
    if algorithm == "sha256":
        return F.sha2(joined, 256)
    raise ValueError(f"algorithm must be sha1 or sha256, got {algorithm!r}")
