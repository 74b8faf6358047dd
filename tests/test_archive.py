"""A small logbook on disk, run through both phases from its files."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quillstack.config import ArchiveConfig, FeedConfig
from quillstack.operators import listing
from quillstack.operators.extract import decode_documents
from quillstack.operators.urls import filter_urls
from quillstack.plans.archive import ArchivePlan
from quillstack.plans.feed import FeedPlan
from quillstack.sources import archive as store
from quillstack.sources import versions
from quillstack.sources import files
from quillstack.sources.workspace import Workspace

LISTING = "By Author?OpenView&Start={}&Count=5000"
GIF = b"GIF89a-picture"


def page(number, title, authors, categories, date, time, body):
    return (
        '<html><body><form><div align="center"><b><font size="4">Logbook Entry</font></b></div>'
        f'<table width="100%" border="1"><tr><td width="1%" bgcolor="#EFEFEF"><font size="2">Page</font><b>{number}</b><br>'
        f'<font size="2">Created</font><br><i>Mon {time}</i></td><td><font size="2">Title</font><font size="2">{title}</font>'
        f'<font size="2">Author</font><font size="2">{authors}</font><font size="2">Category</font>'
        f'<font size="2">{categories}</font><font size="2">Date</font><font size="2">{date}</font>'
        f"<table><tr><td>nested</td></tr></table></td></tr></table>{body}</form></body></html>"
    )


def entry(href, title, number):
    return f'<tr><td><a target="NotesView" href="{href}">{title}</a></td><td><font size="2">{number}</font></td></tr>'


def response(href, title):
    return f'<tr><td><a href="{href}" target="NotesView">---------- Respond: {title}</a></td></tr>'


# Newest first, as listings are.
LISTINGS = [
    response("v/0?OpenDocument", "Re: lost")
    + entry("v/3?OpenDocument", "Third &amp; last", 3)
    + response("v/31?OpenDocument", "Re: third")
    + response("v/32?OpenDocument", "Re: third again")
    + response("v/33?OpenDocument", "Re: anonymous")
    + entry("v/2%20b?OpenDocument", "Second", 2),
    entry("v/1?OpenDocument", "First", 1)
    + entry("v/copy?OpenDocument", "First", 7)
    + response("v/71?OpenDocument", "Re: first")
    + entry("v/clash?OpenDocument", "Clash", 3)
    + entry("v/3?OpenDocument", "Third &amp; last", 3)
    + response("v/34?OpenDocument", "Re: third, seen late")
    + entry("v/bare?OpenDocument", "Bare", "8"),
]
FIRST = ("First", "Ann, Bob", "Cat", "01/02/2015", "09:00 AM")
DOCUMENTS = {
    "v/0?OpenDocument": page(0, "Re: lost", "Ann", "Cat", "01/01/2015", "09:00 AM", "lost"),
    "v/1?OpenDocument": page(1, *FIRST, '<p>one</p><a href="2%20b?OpenDocument">see</a>'),
    "v/copy?OpenDocument": page(7, "First", "Bob,Ann,", "Cat", "01/02/2015", "09:00 AM", "copy"),
    "v/71?OpenDocument": page(71, "Re: first", "Bob", "Cat", "01/03/2015", "09:00 AM", "reply to the copy"),
    "v/2 b?OpenDocument": page(
        2, "Second", "Z%C3%B6e", "Dog, , Cat", "01/04/2015", "01:30 PM",
        '<a class="x" href="1?OpenDocument">late href</a><a href="copy?OpenDocument">copy</a>'
        '<a href="31?OpenDocument">reply</a><a href="gone?OpenDocument">gone</a><a href="#top">top</a>'
        '<a href="3/$FILE/a%20b.TXT">file</a><img src="3/pic?OpenElement&amp;FieldElemFormat=gif">'
        '<a href="bare?OpenDocument">bare</a>',
    ),
    "v/3?OpenDocument": page(
        "955.5", "Third &amp; last", "Ann", "Cat", "01/05/2015", "09:00 AM",
        '<img src="3/$FILE/a%20b.TXT"><a href="3/$FILE/lost.txt">lost</a>',
    ),
    "v/31?OpenDocument": page(31, "Re: third", "Bob, Ann", "Cat", "01/06/2015", "09:00 AM", '<a href="1?OpenDocument">1</a>'),
    "v/32?OpenDocument": page(32, "Re: third again", "Cid", "Owl", "01/06/2015", "10:00 AM", '<img src="3/pic2.gif">'),
    "v/33?OpenDocument": page(33, "Re: anonymous", "", "Cat", "01/06/2015", "11:00 AM", "no name"),
    "v/34?OpenDocument": page(34, "Re: third, seen late", "Bob", "Cat", "01/06/2015", "12:00 PM", "late"),
    "v/clash?OpenDocument": page(2, "Clash", "Ann", "Cat", "01/07/2015", "09:00 AM", "clash"),
    "v/bare?OpenDocument": page(8, "Bare", "", "Cat", "01/08/2015", "09:00 AM", "nobody wrote this"),
    "v/orphan?OpenDocument": page(99, "Orphan", "Eve", "Elk", "01/09/2015", "09:00 AM", "orphan"),
    "v/orphanx?OpenDocument": page(98, "Orphan", "Eve", "Elk", "01/09/2015", "09:00 AM", "orphan again"),
    "w/unlisted?OpenDocument": page(97, *FIRST, "one more copy"),
    "w/index?OpenDocument": "<html><body>an index, no entry</body></html>",
    "w/blob?OpenDocument": b"\x00\x01binary",
    "w/date?OpenDocument": page(5, "Bad date", "Ann", "Cat", "31/31/2015", "09:00 AM", "x"),
}
MEDIA = {
    "v/3/$FILE/a b.TXT": b"plain text",
    "v/3/pic?OpenElement&FieldElemFormat=gif": GIF,
    "v/3/pic2.gif": GIF,
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("logbook")
    for i, items in enumerate(LISTINGS):
        (root / LISTING.format(1 + 5000 * i)).write_text(f'<html><a href="x">nav</a><table>{items}</table></html>')
    for name, content in {**DOCUMENTS, **MEDIA}.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(root)


def make_plan(spark, folder, **config):
    documents = files.in_archive(files.scan_documents(spark, folder), folder, "/lb")
    return ArchivePlan(
        spark,
        files.scan_contents(spark, folder, "By Author?OpenView&Start=*&Count=5000*"),
        decode_documents(documents),
        files.in_archive(files.scan_media(spark, folder), folder, "/lb"),
        ArchiveConfig(root_dir="/lb", **config),
    )


@pytest.fixture(scope="module")
def plan(spark, folder):
    return make_plan(spark, folder)


@pytest.fixture(scope="module")
def feed(plan):
    return FeedPlan.of(plan, FeedConfig(base_url="https://example.org/log", site_id=5))


def column(df, name):
    return sorted(r[name] for r in df.select(name).collect())


def path(name):
    return f"/lb/v/{name}?OpenDocument"


def test_listings_and_threads(plan):
    orphans = listing.orphan_responses(plan.threaded)
    assert column(orphans, "href") == ["v/0?OpenDocument"]
    parents = {r["path"]: r["parent_title"] for r in plan.responses.collect()}
    assert parents[path("31")] == "Third & last" and parents[path("71")] == "First"
    # Seen under the entry's second listing, added to the one entry.
    assert parents[path("34")] == "Third & last"
    entries = {(r["title"], r["page_number"]): r["n_sightings"] for r in plan.entries.collect()}
    assert entries[("Third & last", 3)] == 2 and entries[("First", 7)] == 1


def test_rejects_have_reasons(plan):
    assert {r["path"]: r["reject_reason"] for r in plan.rejected.collect()} == {
        "/lb/w/index?OpenDocument": "no centred heading",
        "/lb/w/blob?OpenDocument": "binary file",
        "/lb/w/date?OpenDocument": "bad creation time",
    }


def test_canonical_pages_and_order(plan):
    rows = plan.ordered.orderBy("page_order").collect()
    assert [r["path"] for r in rows] == [
        path("bare"), path("clash"), path("copy"), path("2 b"), path("3"), path("orphan"),
    ]
    assert [r["n_copies"] for r in rows] == [1, 1, 2, 1, 1, 2]
    assert column(plan.unlisted, "path") == [path("orphan"), path("orphanx"), "/lb/w/unlisted?OpenDocument"]


def test_path_map_leads_every_path_to_its_page(plan):
    keys = {r["path"]: r["page_key"] for r in plan.path_map.collect()}
    assert keys[path("1")] == keys[path("copy")] == keys["/lb/w/unlisted?OpenDocument"] == keys[path("71")]
    assert keys[path("31")] == keys[path("3")] and keys[path("orphan")] == keys[path("orphanx")]
    assert path("0") not in keys and "/lb/w/index?OpenDocument" not in keys


def test_duplicates_and_dangling_links(plan):
    rows = {(r["kind"], r["path"], r["original_path"]) for r in plan.duplicates.collect()}
    assert ("page", path("1"), path("copy")) in rows
    assert ("page", "/lb/w/unlisted?OpenDocument", path("copy")) in rows
    assert ("page", path("orphanx"), path("orphan")) in rows
    # One file shown as an image and as an attachment; two names with one content.
    assert ("image", "/lb/v/3/$FILE/a b.TXT", "/lb/v/3/$FILE/a b.TXT") in rows
    assert ("image", "/lb/v/3/pic2.gif", "/lb/v/3/pic?OpenElement&FieldElemFormat=gif") in rows
    assert column(plan.dangling, "ref_path") == [path("gone")]
    assert column(plan.unresolved_media, "ref_path") == ["/lb/v/3/$FILE/lost.txt"]


def test_manifest(plan):
    names = {r["src_path"]: r["archive_name"] for r in plan.manifest.collect()}
    assert len(names) == 2
    assert names["/lb/v/3/$FILE/a b.TXT"].endswith(".txt")
    assert names["/lb/v/3/pic?OpenElement&FieldElemFormat=gif"].endswith(".gif")


def test_dimensions_leave_orphans_out(spark, folder, plan):
    # The copy that became the page names its authors in the other order; Cid only replied.
    assert column(plan.authors, "name") == ["Ann", "Bob", "Cid", "Zöe"]
    assert column(plan.categories, "name") == ["Cat", "Dog", "Owl"]
    assert "Eve" in column(make_plan(spark, folder, include_orphans=True).authors, "name")


def test_post_ids_keep_claimed_numbers(plan, feed):
    ids = {r["path"]: r["post_id"] for r in feed.pages.join(feed.ids, "page_key").collect()}
    # "2" is claimed by the first page in order; the other page of that number and "955.5" follow.
    assert ids == {
        path("bare"): 8, path("clash"): 2, path("copy"): 7, path("2 b"): 100, path("3"): 101, path("orphan"): 99,
    }


def test_posts_and_their_bodies(feed):
    posts = {r["title"]: r for r in feed.posts.collect()}
    assert sorted(posts) == ["Clash", "First", "Orphan", "Second", "Third & last"]
    body = posts["Second"]["content"]
    assert '<a href="https://example.org/log/?p=7">copy</a>' in body
    assert '<a href="https://example.org/log/?p=101">reply</a>' in body
    assert '<a href="https://example.org/log/?p=8">bare</a>' in body
    assert 'class="x" href="https' not in body and "#top" not in body
    uploads = "https://example.org/log/wp-content/uploads/sites/5/2015/01/"
    assert f'<a href="{uploads}' in body and f'<img src="{uploads}' in body and '.txt">file' in body
    assert posts["Second"]["creator"] == "ze" and posts["First"]["creator"] == "bob"
    assert posts["Second"]["post_date"] == "2015-01-04 13:30:00"
    assert '<a href="3/$FILE/lost.txt">lost</a>' in posts["Third & last"]["content"]


def test_comments(feed):
    rows = feed.comments.orderBy("comment_id").collect()
    # The copy's own response counts, as the copy became the page; the nameless one does not.
    assert [r["path"] for r in rows] == [path("71"), path("31"), path("32"), path("34")]
    assert [r["post_id"] for r in rows] == [7, 101, 101, 101]
    assert rows[1]["content"] == (
        '[Authors: Bob, Ann]\n\n<a href="https://example.org/log/?p=7">1</a>'
    )
    authors = {r["display_name"]: r["author_id"] for r in feed.authors.collect()}
    assert authors == {"Ann": 1, "Bob": 2, "Cid": 3, "Zöe": 4}
    assert [r["user_id"] for r in rows] == [2, 2, 3, 2]


def test_items_belong_to_the_first_post(feed):
    rows = feed.items.orderBy("post_id").collect()
    assert [(r["kind"], r["post_parent"], r["post_id"]) for r in rows] == [
        ("attachment", 100, 102), ("image", 100, 103), ("image", 101, 104),
    ]
    assert rows[0]["attached_file"].startswith("2015/01/") and rows[0]["creator"] == "ze"


def test_terms_and_post_terms(feed):
    terms = {(r["taxonomy"], r["name"]): (r["term_id"], r["slug"]) for r in feed.terms.collect()}
    assert terms[("ssl_alp_coauthor", "Zöe")] == (4, "ssl-alp-coauthor-ze")
    assert terms[("category", "Cat")] == (5, "cat") and terms[("category", "Owl")] == (7, "owl")
    second = feed.post_terms.where("post_id = 100")
    assert sorted(column(second, "name")) == ["Cat", "Dog", "Zöe"]


def test_summaries(plan, feed):
    run = plan.summary.first().asDict()
    assert (run["pages"], run["distinct_pages"], run["orphans"]) == (7, 6, 2)
    assert (run["listing_files"], run["listed_pages"], run["responses"], run["unlisted_documents"]) == (2, 6, 5, 3)
    counts = feed.summary.first().asDict()
    assert (counts["posts"], counts["comments"], counts["media_items"]) == (5, 4, 3)
    # Second links to three pages; Third's reply adds a link, counted again for three comments.
    assert (counts["urls_distinct"], counts["urls_raw"]) == (5, 8)
    assert feed.skipped_targets.count() == 1


def test_channel(feed):
    row = feed.channel.first()
    assert (row["link"], row["n_posts"]) == ("https://example.org/log/", 5)
    assert row["pub_date"] == "Fri, 09 Jan 2015 09:00:00 +0000"


def rows_of(df):
    columns = sorted(df.columns)
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("size", [1, 200])
def test_stored_archive_gives_the_same_feed(spark, folder, feed, tmp_path, size):
    """Also with every response of a page in a stored row of its own."""
    stored = str(tmp_path / "stored")
    plan = make_plan(spark, folder, responses_per_part=size)
    plan.write(stored)
    pages = store.scan_archive(spark, stored)
    assert pages.where("_part = ''").count() == 6
    assert pages.count() == (10 if size == 1 else 6)
    loaded = FeedPlan.load(spark, stored, feed.config)
    for name in ("ids", "terms", "comments", "items", "post_terms", "summary", "channel"):
        assert rows_of(getattr(loaded, name)) == rows_of(getattr(feed, name)), name
    posts = lambda f: f.posts.select("post_id", "title", "content", "creator", "post_date", "guid")
    assert rows_of(posts(loaded)) == rows_of(posts(feed))


def test_feed_parts_are_written(spark, feed, tmp_path):
    feed.write(str(tmp_path / "feed"))
    written = versions.current(spark, str(tmp_path / "feed"))
    items = spark.read.format("xml").option("rowTag", "item").load(f"{written}/item")
    assert items.count() == 8
    comments = spark.read.format("xml").option("rowTag", "comment").load(f"{written}/comment")
    assert comments.count() == 4


def test_an_archive_is_replaced_as_a_whole(spark, folder, tmp_path, monkeypatch):
    """A write that fails between two tables leaves the old archive, the next one leaves nothing of it."""
    stored = str(tmp_path / "stored")
    with pytest.raises(FileNotFoundError):
        store.scan_archive(spark, stored)
    plan = make_plan(spark, folder)
    plan.write(stored)
    first, before = versions.current(spark, stored), rows_of(store.scan_archive(spark, stored))
    assert (tmp_path / "stored" / first.rsplit("/", 1)[1] / "problems" / "dangling").is_dir()

    def broken(*_):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(store, "write_names", broken)
        with pytest.raises(OSError, match="disk full"):
            plan.write(stored)
    assert versions.current(spark, stored) == first and rows_of(store.scan_archive(spark, stored)) == before
    nothing = plan.archived.limit(0)
    store.write_archive(stored, nothing, plan.authors, plan.categories, plan.manifest, {})
    second = versions.current(spark, stored)
    assert second != first and not (tmp_path / "stored" / second.rsplit("/", 1)[1] / "problems").exists()
    store.write_archive(stored, nothing, plan.authors, plan.categories, plan.manifest, {})
    kept = {p.name for p in (tmp_path / "stored").iterdir() if p.name.startswith("version-")}
    assert kept == {v.rsplit("/", 1)[1] for v in (second, versions.current(spark, stored))}


def test_a_damaged_row_costs_one_page(spark, folder, plan, tmp_path):
    stored = tmp_path / "stored"
    plan.write(str(stored))
    whole = store.scan_archive(spark, str(stored)).count()
    for part in (stored / versions.current(spark, str(stored)).rsplit("/", 1)[1] / "pages").glob("part-*"):
        text = part.read_text()
        if "<title>Second</title>" in text:
            part.write_text(text.replace("<title>Second</title>", "<title>Second</titel>"))
            (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    rows = store.scan_archive(spark, str(stored))
    assert rows.count() == whole - 1 and "Second" not in column(rows, "title")
    (lost,) = store.damaged_rows(spark, str(stored)).collect()
    assert "Second" in lost["record"] and "/pages/part-" in lost["file"]
    with pytest.raises(Exception, match="(?i)malformed"):
        store.scan_archive(spark, str(stored), strict=True).collect()


def jobs_of(spark, work):
    """How many jobs some work starts."""
    tracker, group = spark.sparkContext.statusTracker(), "counted"
    spark.sparkContext.setJobGroup(group, group)
    try:
        before = len(tracker.getJobIdsForGroup(group))
        work()
        return len(tracker.getJobIdsForGroup(group)) - before
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_counts_are_observed_as_tables_are_written(spark, plan, feed):
    assert plan.summary.count() == feed.summary.count() == 1
    for made in (plan, feed):
        made.__dict__.pop("summary")
        assert jobs_of(spark, lambda made=made: made.summary) == 0
    plan.collisions
    assert jobs_of(spark, plan.verify) == 0


def test_bodies_stay_where_they_are(spark, folder):
    """After their one write, no exchange carries bodies."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        made = FeedPlan.of(make_plan(spark, folder), FeedConfig())
        for table in (made.posts, made.comments):
            plan_text = table._jdf.queryExecution().executedPlan().toString()
            assert "content" in plan_text
            for line in plan_text.split("\n"):
                assert not ("Exchange" in line and ("content" in line or "html" in line))
            tree = table._jdf.queryExecution().executedPlan()
            assert not _exchanged(tree) & {"content", "html"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def _exchanged(node):
    """Names of the columns that a plan's exchanges carry."""
    name, out = node.nodeName(), set()
    if name.startswith("AdaptiveSparkPlan"):
        return _exchanged(node.inputPlan())
    if "Exchange" in name:
        fields = node.output()
        out = {fields.apply(i).name() for i in range(fields.size())}
    for i in range(node.children().size()):
        out |= _exchanged(node.children().apply(i))
    return out


def test_no_counts_of_nothing(spark):
    none = spark.createDataFrame([], "path string, html string")
    listings = spark.createDataFrame([], "contents_file string, html string")
    media = spark.createDataFrame([], "path string, content binary")
    plan = ArchivePlan(spark, listings, none, media)
    assert set(plan.summary.first().asDict().values()) == {0}
    assert set(FeedPlan.of(plan, FeedConfig()).summary.first().asDict().values()) == {0}


def test_strict_mode_fails(spark, folder, tmp_path):
    plan = make_plan(spark, folder, strict=True)
    with pytest.raises(ValueError, match="rejected documents"):
        plan.write(str(tmp_path / "strict"))


def test_path_collisions(spark):
    entries = spark.createDataFrame([("/a", "e1"), ("/b", "e2")], "path string, entry_key string")
    responses = spark.createDataFrame(
        [("/a", "e2"), ("/r", "e1"), ("/s", "e1"), ("/s", "e2")], "path string, entry_key string"
    )
    found = listing.path_collisions(entries, responses).orderBy("path").collect()
    assert [(r["path"], r["is_page"], r["several_parents"]) for r in found] == [("/a", True, False), ("/s", False, True)]


def test_filter_urls(spark):
    kept = "http://lab.example.org/nb/log.nsf/abc?OpenDocument"
    dropped = [
        "http://lab.example.org/nb/log.nsf/abc?Navigate&To=Prev",
        "http://lab.example.org/nb/log.nsf/abc?OpenDocument&Click=9",
        "http://lab.example.org/nb/log.nsf/Contents?OpenView",
        "http://lab.example.org/nb/log.nsf/By%20Category?OpenView",
        "http://lab.example.org/nb/log.nsf/By%20Author?OpenView&ResortAscending=1",
        "http://lab.example.org/nb/log.nsf/($All)?OpenView",
        "http://lab.example.org/nb/log.nsf/x?$searchForm",
        "http://other.example.com/nb/log.nsf/abc?OpenDocument",
        "http://badexample.org/nb/log.nsf/abc?OpenDocument",
        "http://lab.example.org/elsewhere/abc?OpenDocument",
    ]
    urls = spark.createDataFrame([(u,) for u in [kept, *dropped]], "url string")
    assert column(filter_urls(urls, ("example.org",), "/nb/"), "url") == [kept]


def test_results_hold_under_repartitioning(spark, folder, plan):
    other = make_plan(spark, folder)
    other.listings = other.listings.repartition(3)
    other.source_documents = other.source_documents.repartition(7)
    for name in ("ordered", "path_map", "merged", "manifest"):
        assert rows_of(getattr(other, name)) == rows_of(getattr(plan, name)), name


def test_unread_listings_and_media_are_rejected(spark, folder, plan, monkeypatch):
    before = {(r["path"], r["reject_reason"]) for r in plan.rejected.collect()}
    media = make_plan(spark, folder)
    media.media_files = media.media_files.withColumn("file_hash", F.lit(None).cast("string"))
    found = {(r["path"], r["reject_reason"]) for r in media.rejected.collect()}
    assert before <= found and {r for _, r in found - before} == {"unreadable media file"}
    monkeypatch.setattr(files, "MAX_TEXT_BYTES", 0)
    strict = make_plan(spark, folder, strict=True)
    assert "unreadable contents listing" in {r["reject_reason"] for r in strict.rejected.collect()}
    with pytest.raises(ValueError, match="rejected documents"):
        strict.verify()


def test_the_media_set_is_stored_once(spark, folder, plan, tmp_path):
    """The archive holds exactly the manifest's files, each with its contents, also when streamed."""
    stored = tmp_path / "stored"
    plan.write(str(stored), copy_media=True)
    names = {r["archive_name"]: r["file_hash"] for r in plan.manifest.collect()}
    written = next(p for p in stored.iterdir() if p.name.startswith("version-")) / "files"
    got = {p.name: hashlib.md5(p.read_bytes()).hexdigest() for p in written.iterdir()}
    assert got == names and len(names) == len(set(names.values())) > 1


def test_kept_tables_are_compressed_by_codec(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    ws.keep(spark.range(5).withColumn("text", F.lit("body")), "rows")
    assert list(tmp_path.rglob("*.zstd.parquet"))
