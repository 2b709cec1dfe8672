"""URL columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def defragment(url: Column) -> Column:
    """Drop the fragment of a URL.

    A URL that carried a ``#`` is also put together again the way Python's ``urldefrag`` does it: the scheme comes out
    in lower case and an empty query loses its ``?``. A URL without ``#`` passes unchanged.
    """
    base = F.substring_index(url, "#", 1)
    scheme = F.regexp_extract(base, _SCHEME, 0)
    rest = F.regexp_replace(base, _SCHEME, "")
    rebuilt = F.concat(F.lower(scheme), F.regexp_replace(rest, r"\?$", ""))
    return F.when(F.contains(url, F.lit("#")), rebuilt).otherwise(url)
