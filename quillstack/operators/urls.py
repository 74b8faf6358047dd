"""Crawl lists: which URLs of a site belong to the archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: navigation, index, sort and search URLs of a mirrored site.
REJECTED_URL = (
    r"^.*\/(([\/a-z\d]+(\?Navigate|\?OpenDocument&Click))"
    r"|(Contents|By%20Diary%20Date|By%20Category|.*ResortAscending|.*\$searchForm|\(\$All\))).*"
)


def filter_urls(
    urls: DataFrame, domains: Sequence[str], parent_path: str, rejected: str = REJECTED_URL
) -> DataFrame:
    """URLs of the given domains (and their subdomains) at or below a path, without rejected ones."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/:?#]+)", 1))
    path = F.regexp_extract("url", r"^[A-Za-z]+://[^/?#]+([^?#]*)", 1)
    allowed = F.lit(False)
    for domain in domains:
        allowed = allowed | (host == domain) | host.endswith(f".{domain}")
    return urls.where(allowed & path.startswith(parent_path) & ~F.col("url").rlike(rejected))
