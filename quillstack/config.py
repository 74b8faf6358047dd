"""Settings of the two phases, as frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass


def _slash(url: str) -> str:
    return url if url.endswith("/") else url + "/"


@dataclass(frozen=True)
class ArchiveConfig:
    """Settings of the archive build.

    root_dir            directory that relative listing links start from
    keep_blank_names    keep blank names left by trimming (``"a, ,b"``)
    include_orphans     count authors and categories of unlisted pages too
    strict              fail on rejected documents, dangling links, missing media and path collisions
    responses_per_part  listing positions per stored part of a page's responses
    """

    root_dir: str = ""
    keep_blank_names: bool = False
    include_orphans: bool = False
    strict: bool = False
    responses_per_part: int = 200


@dataclass(frozen=True)
class FeedConfig:
    """Settings of the feed build; the URLs get their trailing slash here.

    pub_date is the text of the channel's publication date; unset, it is the
    date of the newest post, so that a rebuilt feed stays the same. Stored times carry no
    zone; the "gmt" dates equal them unless time_zone names the zone they were written in.
    Items are written in parts of at most max_part_bytes, as importers take long files badly.
    """

    title: str = "Logbook"
    site_id: int = 1
    base_network_url: str = "https://network.example.org/"
    base_url: str = "https://network.example.org/logbook/"
    base_source_media_url: str = "https://media.example.org/"
    pub_date: str | None = None
    time_zone: str | None = None
    generator: str = "quillstack"
    max_part_bytes: int = 64 << 20

    def __post_init__(self) -> None:
        for name in ("base_network_url", "base_url", "base_source_media_url"):
            object.__setattr__(self, name, _slash(getattr(self, name)))

    @property
    def base_media_url(self) -> str:
        return f"{self.base_url}wp-content/uploads/sites/{self.site_id}/"
