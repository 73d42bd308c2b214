"""Source locator parsing (S-05, Q-16) as a column operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: locator pattern.  The bucket class has no digits, so
# ``my-bucket2`` yields ``my-bucket`` (compatible behaviour).
URL_PATTERN = r"^(s3|http|https)://([-a-zA-Z]+)\.?[a-zA-Z0-9.-]*/(.+)"
# Corrected variant: digits, dots and underscores allowed in the bucket.
URL_PATTERN_FIXED = r"^(s3|http|https)://([-a-zA-Z0-9_]+)\.?[a-zA-Z0-9.-]*/(.+)"


def url_parts(c: str | Column, compatible: bool = True) -> list[Column]:
    """scheme, bucket and path of a locator; NULLs when it does not match."""
    col = F.col(c) if isinstance(c, str) else c
    pattern = URL_PATTERN if compatible else URL_PATTERN_FIXED
    return [F.nullif(F.regexp_extract(col, pattern, i), F.lit("")).alias(name)
            for i, name in ((1, "scheme"), (2, "bucket"), (3, "path"))]
