"""Storage addressing (S8): one root URI, one function for every dataset path.

Spark reads any Hadoop URI (``s3a://``, ``abfss://``, ``hdfs://``, ``file:``);
there is no bucket logic here, only joining.
"""

from __future__ import annotations


def table_path(root: str, *parts: str) -> str:
    """``table_path("s3a://bucket/lake", "raw", "Match")`` -> ``s3a://bucket/lake/raw/Match``."""
    clean = [p.strip("/") for p in parts if p]
    return "/".join([root.rstrip("/")] + clean)
