"""DuckDB SQL giving the same results from the source tables alone.

The SQL never sees HTML: it states what each logbook table must hold, straight from
`documents`, so it checks rendering, extraction and every later step independently.
"""

from __future__ import annotations

ESC = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
NAME = "case when {0} = 3 then 'Jörg K. 3' else 'Author ' || {0} end"
FOLDER = "/lb/nb.nsf/By Author"
BASE = "https://network.example.org/logbook/"
UPLOADS = BASE + "wp-content/uploads/sites/22/"
MEDIA = "https://media.example.org/"
STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
RFC = "strftime({0}, '%a, %d %b %Y %H:%M:%S ')"
SET = "array_to_string([md5(x) for x in list_sort(list_distinct({0}))], ',')"


def _slug(text: str) -> str:
    out = f"regexp_replace({text}, '<[^>]*?>', '', 'g')"
    out = f"regexp_replace({out}, '%([a-fA-F0-9][a-fA-F0-9])', '---\\1---', 'g')"
    out = f"trim({out}, '%')"
    out = f"lower(regexp_replace({out}, '---([a-fA-F0-9][a-fA-F0-9])---', '%\\1', 'g'))"
    out = f"replace(regexp_replace({out}, '&[^\\n]+?;', '', 'g'), '.', '-')"
    out = f"regexp_replace({out}, '[^%a-z0-9 _-]', '', 'g')"
    return f"regexp_replace(regexp_replace({out}, '\\s+', '-', 'g'), '-+', '-', 'g')"


def _clean(name: str) -> str:
    out = f"regexp_replace({name}, '[?\\[\\]/\\\\=<>:;,''\"&$#*()|~`!{{}}%+]', '', 'g')"
    out = f"regexp_replace({out}, '[\\r\\n\\t -]+', '-', 'g')"
    return f"regexp_replace(regexp_replace({out}, '^[._-]+', ''), '[._-]+$', '')"


def _body(page: str, note: str, image: str, top: str = "") -> str:
    return f"""('<p>' || {ESC.format("text")} || '</p>'
        || case when doc_id % 6 = 1 then '<a class="x" href="' else '<a href="' end || {page} || '">see also</a>'
        || '<p><a href="' || {note} || '">file</a></p>' || '<img border="0" src="' || {image} || '">'
        || '{top}' || '<a href="http://example.org/x">elsewhere</a>')"""


PAGE_HREF = "case when doc_id % 4 = 1 then '' else '../By%20Author/' end || link_to || '?OpenDocument'"
NOTE_HREF = "case when lost then doc_id || '/$FILE/lost.txt' else note_of || '/$FILE/note%20' || note_of || '.TXT' end"
IMAGE_HREF = """case when note_image then note_of || '/$FILE/note%20' || note_of || '.TXT'
    else image_of || '/Body/0.1A?OpenElement&FieldElemFormat=gif' end"""
RAW_IMAGE = IMAGE_HREF.replace("&Field", "&amp;Field")
RAW_BODY = _body(PAGE_HREF, NOTE_HREF, RAW_IMAGE, '<a href="#top">top</a>')
CLEAN_BODY = _body(PAGE_HREF, NOTE_HREF, RAW_IMAGE)

ONE, TWO = NAME.format("(rep % 17)"), NAME.format("(rep % 5)")

# Named steps, in order; DuckDB drops those a query does not use.
STEPS = {
    "nn": "select count(*) as n from documents",
    "d": "select *, ('0x' || left(md5(text), 7))::bigint as rep from documents",
    "e": f"""
        select doc_id, rep, text, lang, n, doc_id % 4 >= 2 as is_response,
          regexp_extract(text, '^[^\\n]*') as title,
          case when rep % 41 = 0 then []::varchar[] when rep % 11 = 0 or doc_id % 2 = 0 then [{ONE}, {TWO}]
               else [{TWO}, {ONE}] end as authors,
          case when rep % 3 = 0 then ['Cat ' || (rep % 7), 'Misc & more'] else ['Cat ' || (rep % 7)] end as categories,
          timestamp '2015-01-01 00:00:00' + to_minutes((rep % 5000000) * 37) as created,
          case when doc_id % 8 = 4 then doc_id - 4 else doc_id end as list_no,
          case when doc_id % 50 = 0 then doc_id || '.5' when doc_id % 8 = 4 then (doc_id - 4)::varchar
               else doc_id::varchar end as page_no,
          doc_id % 20 <> 9 and not (doc_id < 16 and doc_id % 4 < 2) as is_listed,
          doc_id >= 16 and (doc_id - doc_id % 4 + 1) % 20 <> 9 and doc_id % 12 in (1, 2, 3) as is_twice,
          case when doc_id % 20 = 5 then 'missing' || doc_id when doc_id % 3 = 0 then '17'
               else ((doc_id * 7 + 1) % n)::varchar end as link_to,
          (doc_id * 3) % n as note_of,
          case when doc_id % 3 = 0 then 0 else (doc_id * 5) % n end as image_of,
          doc_id % 25 = 24 as lost, doc_id % 30 = 7 as note_image,
          '{FOLDER}/' || doc_id || '?OpenDocument' as path
        from d, nn""",
    "k": f"""
        select *, md5(md5(title) || '|' || {SET.format("authors")} || '|' || {SET.format("categories")} || '|'
          || {STAMP.format("created")}) as page_key,
          '{FOLDER}/' || link_to || '?OpenDocument' as page_ref,
          '{FOLDER}/' || case when lost then doc_id || '/$FILE/lost.txt'
             else note_of || '/$FILE/note ' || note_of || '.TXT' end as note_ref,
          '{FOLDER}/' || case when note_image then note_of || '/$FILE/note ' || note_of || '.TXT'
             else image_of || '/Body/0.1A?OpenElement&FieldElemFormat=gif' end as image_ref
        from e""",
    "lr0": """
        select 'L' || ((doc_id // 4) % 4) || '-' || lpad((doc_id // 4096)::varchar, 6, '0') as contents_file, *
        from e where is_listed and not (is_twice and doc_id % 12 = 2)
        union all select 'M0-' || lpad((doc_id // 4096)::varchar, 6, '0'), * from e where is_listed and is_twice""",
    "lr": """
        select contents_file, row_number() over (partition by contents_file order by doc_id) - 1 as pos, doc_id, path,
          case when is_response then '---------- Respond: ' || title else title end as title, is_response,
          'By%20Author/' || doc_id || '?OpenDocument' as href,
          case when not is_response then list_no end as page_number
        from lr0""",
    "th0": """
        select *, max(case when not is_response then pos end) over
          (partition by contents_file order by pos rows between unbounded preceding and current row) as page_pos from lr""",
    "th": """
        select t.*, p.title as page_title, p.page_number as page_no,
          md5(md5(p.title) || '|' || p.page_number) as entry_key
        from th0 t left join lr p on p.contents_file = t.contents_file and p.pos = t.page_pos""",
    "ent": """
        select entry_key, title, page_number, href, path, doc_id, contents_file as first_file, pos as first_pos, n_sightings
        from (select *, count(*) over (partition by entry_key) as n_sightings,
                row_number() over (partition by entry_key order by contents_file, pos) as r
              from th where not is_response) where r = 1""",
    "rs": """
        select entry_key, page_title as parent_title, page_no as parent_number, href, path, doc_id,
          contents_file as first_file, pos as first_pos
        from (select *, row_number() over (partition by entry_key, href order by contents_file, pos) as r
              from th where is_response and entry_key is not null) where r = 1""",
    "res": "select ent.*, k.page_key from ent join k using (doc_id)",
    "cn": """
        select page_key, path, doc_id, entry_key, first_file, first_pos, n_copies from
          (select *, count(*) over (partition by page_key) as n_copies,
             row_number() over (partition by page_key order by first_file desc, first_pos desc) as r from res)
        where r = 1""",
    "unl": "select * from k where doc_id not in (select doc_id from lr)",
    "orph": """
        select page_key, min(path) as path, count(*) as n_copies from unl
        where page_key not in (select page_key from cn) group by 1""",
    "ord": """
        select *, row_number() over
          (order by is_orphan, first_file desc nulls last, first_pos desc nulls last, path) as page_order
        from (select page_key, path, n_copies, first_file, first_pos, false as is_orphan from cn
              union all select page_key, path, n_copies, null, null, true from orph)""",
    "par": """
        select rs.*, res.page_key, rs.entry_key in (select entry_key from cn) as kept from rs join res using (entry_key)""",
    "pmap": """
        select path, arg_min(page_key, prio) as page_key from
          (select path, page_key, 0 as prio from unl union all select path, page_key, 1 from res
           union all select path, page_key, 2 from par) group by 1""",
    "own": """
        select path, page_key, page_order, is_orphan, 0 as role, null::varchar as first_file, null::bigint as first_pos from ord
        union all select p.path, p.page_key, o.page_order, o.is_orphan, 1, p.first_file, p.first_pos
        from par p join ord o using (page_key) where p.kept""",
    "ok": "select own.*, k.* exclude (path, page_key) from own join k using (path)",
    "files": f"""
        select '{FOLDER}/' || doc_id || '/$FILE/note ' || doc_id || '.TXT' as ref_path, md5(text) as file_hash,
          octet_length(encode(text)) as n_bytes, text = '' as is_empty, 'text/plain' as mime from e
        union all select '{FOLDER}/' || doc_id || '/Body/0.1A?OpenElement&FieldElemFormat=gif',
          md5('GIF89a' || lang || (rep % 97)), octet_length(encode('GIF89a' || lang || (rep % 97))), false, 'image/gif' from e""",
    "plk": f"""
        select ok.path as page_path, 0 as pos, {PAGE_HREF} as href, page_ref as ref_path, md5(page_ref) as ref_key,
          pmap.page_key as target_key, ok.page_key, page_order, role, first_file, first_pos
        from ok left join pmap on pmap.path = page_ref""",
    "mlk0": f"""
        select *, 1 as pos, 'attachment' as kind, note_ref as ref_path, {NOTE_HREF} as href from ok
        union all select *, 2, 'image', image_ref, {IMAGE_HREF} from ok""",
    "mlk": "select mlk0.*, files.file_hash from mlk0 left join files using (ref_path)",
    "mpl": """
        select page_key, 'page' as kind, ref_key, ref_path, target_key, page_path as owner_path, role = 1 as from_response, n_refs
        from (select *, count(*) over (partition by page_key, ref_key) as n_refs, row_number() over
                (partition by page_key, ref_key order by role, first_file nulls first, first_pos nulls first, pos desc) as r
              from plk where target_key is not null) where r = 1""",
    "mm": """
        select page_key, page_order, kind, case kind when 'attachment' then 0 else 1 end as kind_rank, file_hash,
          ref_path as src_path, path as owner_path, created, role = 1 as from_response, n_refs
        from (select *, count(*) over (partition by page_key, kind, file_hash) as n_refs, row_number() over
                (partition by page_key, kind, file_hash order by role, first_file nulls first, first_pos nulls first, pos desc) as r
              from mlk where file_hash is not null) where r = 1""",
    "man": """
        select file_hash, src_path, created, page_key as first_page_key, kind as first_kind, n_refs,
          file_hash || case when src_path like '%gif' then '.gif' else '.txt' end as archive_name
        from (select * exclude (n_refs), count(*) over (partition by file_hash) as n_refs,
                row_number() over (partition by file_hash order by page_order, kind_rank) as r from mm) where r = 1""",
    "note_file": f"select ref_path as note_ref, file_hash as note_hash from files where mime = 'text/plain'",
    "image_file": "select ref_path as image_ref, file_hash as image_hash from files",
    "bodies": f"""
        select *, {_body("md5(page_ref)", f"coalesce(note_hash, {NOTE_HREF})", "image_hash")} as keyed
        from ok left join note_file using (note_ref) left join image_file using (image_ref)""",
    "names": """
        select distinct 0 as kind, unnest(authors) as name from ok where not is_orphan
        union all select distinct 1, unnest(categories) from ok where not is_orphan""",
    "terms": f"""
        select row_number() over (order by kind, name) as term_id,
          case kind when 0 then 'ssl_alp_coauthor' else 'category' end as taxonomy,
          case kind when 0 then 'ssl-alp-coauthor-' else '' end || {_slug("name")} as slug, '' as parent, name
        from names""",
    "pages": "select * from bodies where role = 0",
    "number": """
        select page_key, page_order, case when regexp_full_match(page_no, '[0-9]+') then page_no::bigint end as number
        from pages""",
    "claim": """
        select page_key, page_order, case when number is not null and
          row_number() over (partition by number order by page_order) = 1 then number end as number from number""",
    "ids": """
        select page_key, coalesce(number, (select coalesce(max(number), 0) from claim)
            + row_number() over (partition by number is null order by page_order)) as post_id,
          number is not null as claimed from claim""",
    "media_url": f"""
        select file_hash, '{UPLOADS}' || strftime(created, '%Y/%m/') || archive_name as url from man""",
    "final": f"""
        select b.*, {_body(
            f"case when doc_id % 6 <> 1 and target_id is not null then '{BASE}?p=' || target_id else md5(page_ref) end",
            f"coalesce(nu.url, note_hash, {NOTE_HREF})", "iu.url")} as content,
          {_body(
            f"case when doc_id % 6 <> 1 and target_id is not null then '{BASE}?p=' || target_id else md5(page_ref) end",
            f"coalesce(note_hash, {NOTE_HREF})", "image_hash")} as linked,
          {_body("md5(page_ref)", f"coalesce(nu.url, note_hash, {NOTE_HREF})", "iu.url")} as illustrated
        from bodies b left join (select path as page_ref, post_id as target_id from pmap join ids using (page_key)) using (page_ref)
          left join media_url nu on nu.file_hash = note_hash left join media_url iu on iu.file_hash = image_hash""",
    "post": f"""
        select page_key, page_order, title, '' as link, {_slug("authors[1]")} as creator, '{BASE}?p=' || post_id as guid,
          content, post_id, {_slug("title")} as post_name, 0::bigint as post_parent, 'post' as post_type, created,
          {RFC.format("created")} as pub_date, '' as description, '' as excerpt, {STAMP.format("created")} as post_date,
          {STAMP.format("created")} as post_date_gmt, 'open' as comment_status, 'closed' as ping_status,
          'publish' as status, 0 as menu_order, '' as post_password, 0 as is_sticky
        from final join ids using (page_key) where role = 0 and len(authors) > 0""",
    "cm": f"""
        select row_number() over (order by f.page_order, f.first_file, f.first_pos, f.path) as comment_id,
          ids.post_id, f.page_key, f.path, f.authors, f.created, f.content
        from final f join ids using (page_key) join (select page_key from post) using (page_key)
        where f.role = 1 and len(f.authors) > 0""",
    "item0": f"""
        select kind, file_hash, page_order, kind_rank, post_id as post_parent, creator from
          (select mm.*, post.post_id, post.creator, row_number() over (partition by kind, file_hash order by mm.page_order) as r
           from mm join post using (page_key)) where r = 1""",
    "item": f"""
        select i.page_order, i.kind, i.kind_rank, i.file_hash, archive_name as title,
          '{BASE}' || {_slug("archive_name")} as link, i.creator, '{MEDIA}' || archive_name as guid, '' as content,
          (select max(post_id) from ids) + row_number() over (order by i.page_order, i.kind_rank, i.file_hash) as post_id,
          {_slug("archive_name")} as post_name, i.post_parent, 'attachment' as post_type,
          '{MEDIA}' || archive_name as attachment_url, strftime(created, '%Y/%m/') || archive_name as attached_file,
          {RFC.format("created")} as pub_date, '' as description, '' as excerpt, {STAMP.format("created")} as post_date,
          {STAMP.format("created")} as post_date_gmt, 'closed' as comment_status, 'closed' as ping_status,
          'inherit' as status, 0 as menu_order, '' as post_password, 0 as is_sticky
        from item0 i join man using (file_hash)""",
    "skips": "select mpl.page_key, ref_key, target_key from mpl join pages p on p.page_key = target_key where len(p.authors) = 0",
    "feed_counts": """
        select (select count(*) from post) as posts, (select count(*) from cm) as comments,
          (select count(*) from item) as media_items, (select count(*) from item where kind = 'image') as images,
          (select count(*) from item where kind = 'attachment') as attachments,
          (select sum(u.n * (1 + coalesce(c.n, 0)))::bigint from
             (select page_key, count(*) as n from mpl join post using (page_key) group by 1) u
             left join (select page_key, count(*) as n from cm group by 1) c using (page_key)) as urls_raw,
          (select count(*) from mpl join post using (page_key)) as urls_distinct,
          (select count(*) from names where kind = 0) as authors, (select count(*) from names where kind = 1) as categories""",
}

LISTING = "select contents_file, pos, title, href, page_number"
FINALS = {
    "scan_documents": "select page_id, url, length(html) as n_chars, md5(html) as html_md5 from pages",
    "extract_links": r"""
        with tags as (select page_id, regexp_extract_all(regexp_replace(html,
            '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'), '(?is)<(?:a|img)\b[^>]*>') as t from pages),
        rows as (select page_id, unnest(t) as tag, unnest(range(len(t))) as pos from tags)
        select page_id, pos, lower(regexp_extract(tag, '^<(\w+)', 1)) as element,
          replace(regexp_extract(tag, '\s(?:href|src)="([^"]*)"', 1), '&amp;', '&') as href
        from rows where regexp_matches(tag, '\s(?:href|src)="')""",
    "decode_urls": "select doc_id, text as decoded, text || '%zz+%2' as decoded_broken from documents",
    "normalise_paths": r"""
        with p as (select page_id, regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) as p from pages),
        q as (select page_id, rtrim(p, '/') as p from p)
        select q.page_id, q.p as plain, q.p || '/b' as dotted, '/y' as above_root, '..' || q.p as relative,
          case when p.p like '%/' then regexp_replace(q.p, '[^/]*$', '') || 'c d' else '/c d' end as sibling
        from q join p using (page_id)""",
    "filter_urls": r"""
        with b as (select page_id, url, regexp_extract(url, '^([a-z]+://[^/]+/[a-z]+/\d+)', 1) as base from pages),
        c as (select page_id, url from b union all select page_id, base || unnest(['?OpenDocument', '?Navigate&to=Next',
            '?OpenDocument&Click=1', '/By%20Category?OpenView', '/By%20Author?OpenView&ResortAscending=2',
            '/By%20Author?OpenView']) from b)
        select page_id, url from c
        where regexp_matches(url, '^[a-z]+://([^/]+\.)?(example\.com|example\.org)/en/')
          and not regexp_matches(url, '\?Navigate|\?OpenDocument&Click|/By%20Category|/[^?]*.*ResortAscending')""",
    "slugs": f"""
        select 'document' as kind, doc_id as id, {_slug("text")} as slug from documents
        union all select 'page', page_id, {_slug("html")} from pages""",
    "decode_text": "select doc_id, text as from_utf8, text as from_latin from documents",
    "parse_created": f"""
        select event_id, {STAMP.format("date_trunc('minute', ts)")} as padded, {STAMP.format("date_trunc('minute', ts)")} as short,
          epoch(date_trunc('minute', ts))::bigint as epoch, null::varchar as odd from events""",
    "thread_pages": """
        with t as (select *, max(case when role = 'user' then turn end) over (partition by conv_id order by turn
            rows between unbounded preceding and current row) as parent_turn from conversations)
        select t.conv_id, t.turn, t.role, t.parent_turn, md5(p.text) as parent_md5
        from t left join conversations p on p.conv_id = t.conv_id and p.turn = t.parent_turn""",
    "scan_contents": "select pos, title, href, page_number from lr",
    "listing_links": f"{LISTING} from lr",
    "thread_listing": f"""{LISTING}, is_response, case when is_response then page_title end as parent_title,
        case when is_response then page_no end as parent_number from th""",
    "orphan_responses": "select contents_file, pos, title, href from th where is_response and page_pos is null",
    "contents_index": "select title, page_number, href, path, first_file, first_pos, n_sightings from ent",
    "entry_responses": "select parent_title, parent_number, href, path, first_file, first_pos from rs",
    "unlisted_documents": "select path from unl",
    "path_collisions": """
        select md5(text) as path, bool_or(not is_response) as is_page,
          count(distinct case when is_response then doc_id end) > 1 as several_parents,
          count(*) filter (is_response) as n_responses
        from e group by 1 having n_responses > 0 and (is_page or several_parents)""",
    "validate_pages": """
        select path, case doc_id % 6 when 1 then 'other heading' when 2 then 'no centred heading' when 3 then 'empty heading'
          when 4 then 'no metadata table' when 5 then 'missing metadata field' end as reject_reason from e
        union all select 'web/' || page_id, 'no centred heading' from pages
        union all select 'bin/' || doc_id, 'binary file' from e""",
    "rejected": """
        select path, 'binary file' as reject_reason from e where doc_id % 7 <> 3 and doc_id % 13 = 4
        union all select path, 'missing document' from (select path, doc_id from ent union select path, doc_id from rs)
        where doc_id % 7 = 3""",
    "page_metadata": f"""
        select path, title, page_no, array_to_string(authors, '|') as authors, array_to_string(categories, '|') as categories,
          {STAMP.format("created")} as created, null::varchar as reject_reason from e""",
    "document_files": f"""
        select title, page_no, array_to_string(authors, '|') as authors, array_to_string(categories, '|') as categories,
          {STAMP.format("created")} as created, null::varchar as reject_reason, {RAW_BODY} as content from e""",
    "media_files": """
        select md5(coalesce(text, '') || chr(10)) as file_hash, octet_length(encode(coalesce(text, ''))) + 1 as n_bytes,
          'text/plain' as mime from documents""",
    "page_body": f"select path, {RAW_BODY} as content from e",
    "clean_body": f"select path, {CLEAN_BODY} as content from e",
    "split_names": """
        select doc_id, array_to_string(authors, '|') as names,
          len(authors) + case when rep % 41 <> 0 and rep % 11 = 0 then 1 else 0 end as n_with_blank from e""",
    "classify_links": f"""
        select path as page_path, 0 as pos, 'page' as kind, {PAGE_HREF} as href from e
        union all select path, 1, 'attachment', {NOTE_HREF} from e
        union all select path, 2, 'image', {IMAGE_HREF} from e
        union all select path, 3, 'other', 'http://example.org/x' from e""",
    "link_keys": "select path as page_path, 0 as pos, page_ref as ref_path, md5(page_ref) as ref_hash from k",
    "page_key": "select path, page_key from k",
    "clean_filenames": f"""
        select '{FOLDER}/' || doc_id || '/$FILE/note ' || doc_id || '.TXT' as path,
          'note-' || doc_id || '.TXT' as name, '.txt' as extension from e
        union all select '{FOLDER}/' || doc_id || '/Body/0.1A?OpenElement&FieldElemFormat=gif', '0.1A.gif', '.gif' from e
        union all select '/lb/' || title || ' [v1].PDF',
          {_clean("regexp_extract('/lb/' || title || ' [v1].PDF', '[^/]*$')")}, '.pdf' from e""",
    "media_hash": "select ref_path as path, file_hash, n_bytes from files",
    "media_type": "select ref_path as path, case when is_empty then 'inode/x-empty' else mime end as mime from files",
    "canonical_pages": "select page_key, path, n_copies from cn",
    "orphan_pages": "select page_key, path, n_copies from orph",
    "all_pages": "select page_key, path, is_orphan, n_copies from ord",
    "page_order": "select page_key, path, is_orphan, page_order from ord",
    "page_path_map": "select path, page_key from pmap",
    "duplicate_report": """
        select 'page' as kind, c.path, ord.path as original_path, c.page_key
        from (select path, page_key from res union all select path, page_key from unl) c join ord using (page_key)
        where c.path <> ord.path
        union all select mm.kind, mm.src_path, man.src_path, mm.page_key from mm join man using (file_hash)
        where mm.page_key <> first_page_key or mm.kind <> first_kind""",
    "resolve_links": "select page_path, pos, ref_path, ref_key, target_key from plk where target_key is not null",
    "dangling_links": "select page_path, pos, href, ref_path from plk where target_key is null",
    "resolve_media": "select path as page_path, pos, kind, ref_path, file_hash from mlk",
    "unresolved_media": "select path as page_path, pos, kind, ref_path from mlk where file_hash is null",
    "merged_links": """
        select page_key, kind, ref_key, ref_path, owner_path, from_response, n_refs from mpl
        union all select page_key, kind, file_hash, src_path, owner_path, from_response, n_refs from mm""",
    "page_media": "select page_key, kind, kind_rank, file_hash, src_path from mm",
    "media_manifest": f"""
        select file_hash, src_path, archive_name, {STAMP.format("created")} as created, n_refs from man""",
    "keyed_body": "select path, keyed as content from bodies",
    "archive_pages": """
        select page_key, (select count(*) from mm where mm.page_key = p.page_key and kind = 'attachment') as n_attachments,
          (select count(*) from mm where mm.page_key = p.page_key and kind = 'image') as n_images,
          (select count(*) from mpl where mpl.page_key = p.page_key) as n_urls,
          (select count(*) from own where own.page_key = p.page_key and role = 1) as n_responses,
          epoch(created)::bigint as created, length(keyed) as n_chars from pages p""",
    "scan_archive": f"""
        select page_key, page_order, is_orphan, title, page_no, array_to_string(authors, '|') as authors,
          array_to_string(categories, '|') as categories, {STAMP.format("created")} as created, keyed as content,
          (select count(*) from mm where mm.page_key = p.page_key)
            + (select count(*) from mpl where mpl.page_key = p.page_key) as n_links,
          (select count(*) from own where own.page_key = p.page_key and role = 1) as n_responses from pages p""",
    "run_summary": """
        select (select count(distinct contents_file) from lr) as listing_files, (select count(*) from ent) as listed_pages,
          (select count(*) from rs) as responses, (select count(*) from unl) as unlisted_documents,
          (select count(*) from cn) + (select coalesce(sum(n_copies), 0)::bigint from orph) as pages,
          (select count(*) from ord) as distinct_pages, (select coalesce(sum(n_copies), 0)::bigint from orph) as orphans,
          (select count(*) from mm) as media_items, (select count(*) from mm where kind = 'image') as images,
          (select count(*) from mm where kind = 'attachment') as attachments, (select count(*) from man) as media_files,
          (select count(*) from mpl) as internal_urls, (select count(*) from plk where target_key is null) as dangling_links,
          (select count(*) from names where kind = 0) as authors, (select count(*) from names where kind = 1) as categories,
          0::bigint as rejected""",
    "author_dim": f"""
        select term_id as author_id, {_slug("name")} as login, '' as email, name as display_name, '' as first_name,
          '' as last_name from terms where taxonomy = 'ssl_alp_coauthor'""",
    "category_dim": "select term_id, slug as nicename, parent, name from terms where taxonomy = 'category'",
    "terms": "select * from terms",
    "post_ids": "select page_key, post_id, claimed from ids",
    "posts": "select * exclude (created) from post",
    "post_terms": f"""
        with u as (select post_id, unnest(authors) as name, unnest(range(len(authors))) as pos, true as is_author
                   from pages join ids using (page_key) where len(authors) > 0
                   union all select post_id, unnest(categories), unnest(range(len(categories))), false
                   from pages join ids using (page_key) where len(authors) > 0)
        select post_id, case when is_author then 'ssl_alp_coauthor' else 'category' end as domain, pos,
          case when is_author then 'ssl-alp-coauthor-' else '' end || {_slug("name")} as nicename, name from u""",
    "comments": f"""
        select comment_id, post_id, path, authors[1] as author, '' as author_email, '' as author_url, '' as author_ip,
          {STAMP.format("created")} as comment_date, {STAMP.format("created")} as comment_date_gmt,
          case when len(authors) > 1 then '[Authors: ' || array_to_string(authors, ', ') || ']' || chr(10) || chr(10) else '' end
            || content as content,
          1 as approved, '' as comment_type, 0::bigint as comment_parent, term_id as user_id
        from cm join terms on terms.name = authors[1] and taxonomy = 'ssl_alp_coauthor'""",
    "comment_bodies": "select path, content from cm",
    "rewrite_links": "select page_key, linked as content from final where role = 0",
    "rewrite_media": "select page_key, illustrated as content from final where role = 0",
    "attachment_items": "select * from item",
    "channel": f"""
        select 'Derived logbook' as title, '{BASE}' as link, 'Logbook' as description,
          strftime(max(created), '%a, %d %b %Y %H:%M:%S +0000') as pub_date, 'en-GB' as language, '1.2' as wxr_version,
          'https://network.example.org/' as base_site_url, '{BASE}' as base_blog_url, 'quillstack' as generator,
          count(*) as n_posts from post""",
    "feed_items": """
        select page_order, 0 as item_rank, null::varchar as file_hash, title, link, pub_date, creator, guid, content, post_id,
          post_name, post_parent, post_type, status, null::varchar as attachment_url, null::varchar as attached_file from post
        union all select page_order, kind_rank + 1, file_hash, title, link, pub_date, creator, guid, content, post_id,
          post_name, post_parent, post_type, status, attachment_url, attached_file from item""",
    "skipped_targets": "select * from skips",
    "feed_summary": "select * from feed_counts",
    "feed_from_archive": "select * from feed_counts",
    "write_feed": """
        select post_id, title, creator, guid, post_type, content, page_order from post
        union all select post_id, title, creator, guid, post_type, content, page_order from item""",
}
# These read the source tables only; "pages" is there the given table, not a step.
PLAIN = {
    "scan_documents", "extract_links", "decode_urls", "normalise_paths", "filter_urls", "slugs", "decode_text",
    "parse_created", "thread_pages",
}


def oracles() -> dict[str, str]:
    out = {}
    for key, final in FINALS.items():
        if key in PLAIN:
            out[key] = final.strip()
            continue
        steps = [n for n in STEPS if not (key == "validate_pages" and n not in ("nn", "d", "e"))]
        chain = ",\n".join(f"{name} as ({STEPS[name].strip()})" for name in steps)
        joiner = ",\n" + final.strip()[5:] if final.strip().startswith("with ") else "\n" + final.strip()
        out[key] = f"with {chain}{joiner}"
    return out
