"""Text, path and byte rules as Column expressions (no Python runs per row)."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that file names lose.
FILENAME_DROPPED = "?[]/\\=<>:;,'\"&$#*()|~`!{}%+\x00"

# Control characters that do not belong in text.
CONTROL_CHARACTERS = "".join(chr(c) for c in (*range(0x01, 0x08), 0x0B, *range(0x0E, 0x20), 0x7F))

# Media types by their bytes at an offset, as hex digits; a dot is any digit.
SIGNATURES = (
    (0, "89504E470D0A1A0A", "image/png"),
    (0, "474946383761", "image/gif"),
    (0, "474946383961", "image/gif"),
    (0, "FFD8FF", "image/jpeg"),
    (0, "49492A00", "image/tiff"),
    (0, "4D4D002A", "image/tiff"),
    (0, "424D........00000000", "image/x-ms-bmp"),
    (0, "00000100", "image/vnd.microsoft.icon"),
    (0, "38425053", "image/vnd.adobe.photoshop"),
    (0, "52494646........57454250", "image/webp"),
    (0, "52494646........57415645", "audio/x-wav"),
    (0, "52494646........41564920", "video/x-msvideo"),
    (0, "494433", "audio/mpeg"),
    (0, "664C6143", "audio/flac"),
    (0, "4F676753", "application/ogg"),
    (0, "1A45DFA3", "video/x-matroska"),
    (4, "66747970", "video/mp4"),
    (4, "6674797071742020", "video/quicktime"),
    (4, "667479704D344120", "audio/x-m4a"),
    (4, "6674797061766966", "image/avif"),
    (4, "6674797068656963", "image/heic"),
    (0, "255044462D", "application/pdf"),
    (0, "25215053", "application/postscript"),
    (0, "7B5C727466", "text/rtf"),
    (0, "D0CF11E0A1B11AE1", "application/x-ole-storage"),
    (0, "504B0304", "application/zip"),
    (0, "504B0506", "application/zip"),
    (0, "1F8B", "application/gzip"),
    (0, "425A68", "application/x-bzip2"),
    (0, "FD377A585A00", "application/x-xz"),
    (0, "28B52FFD", "application/zstd"),
    (0, "377ABCAF271C", "application/x-7z-compressed"),
    (0, "526172211A07", "application/x-rar"),
    (257, "7573746172", "application/x-tar"),
    (0, "53514C69746520666F726D6174203300", "application/vnd.sqlite3"),
    (0, "7F454C46", "application/x-elf"),
)
# What the first entries of a zip archive say it is.
ZIP_MARKS = (
    ("word/", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
    ("xl/", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
    ("ppt/", "application/vnd.openxmlformats-officedocument.presentationml.presentation"),
    ("META-INF/", "application/java-archive"),
)
# One-byte charsets by the names pages declare; their characters come from the codecs.
CHARSETS = {
    **{f"iso-8859-{n}": f"iso8859_{n}" for n in (2, 3, 4, 5, 6, 7, 8, 9, 10, 13, 14, 15, 16)},
    **{f"windows-{n}": f"cp{n}" for n in (1250, 1251, 1252, 1253, 1254, 1255, 1256, 1257, 1258)},
    "koi8-r": "koi8_r", "koi8-u": "koi8_u", "ibm866": "cp866", "macintosh": "mac_roman", "windows-874": "cp874",
}
# Other names of the same charsets.
CHARSET_NAMES = {
    "iso-8859-1": "windows-1252", "latin1": "windows-1252", "us-ascii": "windows-1252", "ascii": "windows-1252",
    "latin2": "iso-8859-2", "latin5": "iso-8859-9", "latin9": "iso-8859-15", "x-mac-roman": "macintosh", "cp866": "ibm866",
    **{f"iso8859-{n}": f"iso-8859-{n}" for n in (2, 3, 4, 5, 6, 7, 8, 9, 10, 13, 14, 15, 16)},
    **{f"cp{n}": f"windows-{n}" for n in (1250, 1251, 1252, 1253, 1254, 1255, 1256, 1257, 1258)},
}
#: Where a page declares its charset: in a meta tag among its first KiB.
DECLARED = r"""(?is)<meta\b[^>]*?\bcharset\s*=\s*["']?\s*([A-Za-z0-9_:.-]+)"""
BYTE_ORDER_MARK = r"^(?:EFBBBF|FFFE|FEFF)"

# Named character references of the HTML standard.
NAMED_ENTITIES = {f"&{name}": value for name, value in html5.items() if name.endswith(";")}
REFERENCE = r"&(?:[A-Za-z][A-Za-z0-9]*|#\d+|#[xX][0-9A-Fa-f]+);"


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"<[^>]*>", "")


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _named_references() -> Column:
    """The named references as maps by their first letter, so that a lookup searches one letter's names."""
    groups: dict[str, list[str]] = {}
    for name, value in NAMED_ENTITIES.items():
        groups.setdefault(name[1], []).append(f"{name}\x02{value}")
    return F.create_map(*[
        part
        for letter, pairs in sorted(groups.items())
        for part in (F.lit(letter), F.str_to_map(F.lit("\x01".join(pairs)), F.lit("\x01"), F.lit("\x02")))
    ])


def interleave(gaps: Column, parts: Column) -> Column:
    """The text of n + 1 gaps with n parts between them."""
    ended = F.concat(parts, F.array(F.lit("")))
    return F.array_join(F.zip_with(gaps, ended, lambda gap, part: F.concat(gap, part)), "")


def dense(size: Column, sparse: Column, kind: str = "string") -> Column:
    """An array of `size` values from structs (pos, value), each pos once; NULL where no struct has the place."""
    item = f"struct<pos:int,rest:int,value:{kind}>"
    given = F.transform(sparse, lambda x: F.struct(x["pos"], F.lit(0), x["value"]).cast(item))
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    slots = F.transform(places, lambda i: F.struct(i, F.lit(1), F.lit(None)).cast(item))
    # A place's value sorts before its empty slot, which then goes.
    first = lambda a: F.filter(a, lambda x, i: (i == 0) | (F.get(a, i - 1)["pos"] != x["pos"]))
    return F.transform(let(F.array_sort(F.concat(given, slots)), first), lambda x: x["value"])


def html_unescape(text: Column) -> Column:
    """Resolve named and numeric character references, each once; numbers may be of any length."""

    def char(code: Column) -> Column:
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
        return F.when(valid, F.decode(utf32, "UTF-32")).otherwise(F.lit("\ufffd"))

    def number(ref: Column) -> Column:
        decimal = F.regexp_extract(ref, r"^&#(\d+);", 1).try_cast("bigint")
        return F.coalesce(decimal, F.conv(F.regexp_extract(ref, r"^&#[xX](.+);", 1), 16, 10).try_cast("bigint"))

    def resolve(ref: Column) -> Column:
        common = F.when(ref == "&amp;", "&").when(ref == "&lt;", "<").when(ref == "&gt;", ">").when(ref == "&quot;", '"')
        named = F.try_element_at(F.try_element_at(_named_references(), F.substring(ref, 2, 1)), ref)
        return common.when(ref.startswith("&#"), char(number(ref))).otherwise(F.coalesce(named, ref))

    def replace_refs(value: Column) -> Column:
        refs = F.regexp_extract_all(value, F.lit(REFERENCE), F.lit(0))
        return interleave(F.split(value, REFERENCE, -1), F.transform(refs, resolve))

    return let(text, lambda v: F.when(F.contains(v, F.lit("&")), replace_refs(v)).otherwise(v))


def read_integer(text: Column) -> Column:
    """A whole number between any white space, no-break spaces included; NULL for all else."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "").try_cast("bigint")


def percent_decode(text: Column) -> Column:
    """Percent-decoding that leaves ``+`` and malformed escapes alone."""
    guarded = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    decoded = F.try_url_decode(F.replace(guarded, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(text, F.lit("%")), F.coalesce(decoded, text)).otherwise(text)


def normalise_path(path: Column) -> Column:
    """POSIX normalisation of ``.``, ``..`` and repeated slashes."""
    absolute = path.startswith("/")
    root = F.when(path.rlike(r"^//(?!/)"), "//").when(absolute, "/").otherwise("")

    def step(acc: Column, part: Column) -> Column:
        up = F.coalesce((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1)) != ".."), F.lit(False))
        return (
            F.when(part.isin("", "."), acc)
            .when(part != "..", F.array_append(acc, part))
            .when(up, F.slice(acc, F.lit(1), F.size(acc) - 1))
            .when(absolute, acc)
            .otherwise(F.array_append(acc, part))
        )

    parts = F.aggregate(F.split(path, "/"), F.expr("cast(array() as array<string>)"), step)
    folded = F.concat(root, F.array_join(parts, "/"))
    folded = F.when(folded == "", ".").otherwise(folded)
    # Most paths have no empty, "." or ".." part; only the others pay for the fold.
    return F.when(path.rlike(r"//|(?:^|/)\.\.?(?:/|$)|/$|^$"), folded).otherwise(path)


def dirname(path: Column) -> Column:
    """Directory part; empty for a bare name, ``/`` for a name in the root."""
    head = F.left(path, F.length(path) - F.length(F.substring_index(path, "/", -1)))
    trimmed = F.regexp_replace(head, "/+$", "")
    return F.when(trimmed == "", head).otherwise(trimmed)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def join_path(directory: Column, path: Column) -> Column:
    return (
        F.when(path.startswith("/"), path)
        .when(directory == "", path)
        .when(directory.endswith("/"), F.concat(directory, path))
        .otherwise(F.concat(directory, F.lit("/"), path))
    )


def resolve_in(folder: Column, href: Column) -> Column:
    """Archive path of a link found in a folder: decoded, joined and normalised."""
    return let(let(percent_decode(href), lambda decoded: join_path(folder, decoded)), normalise_path)


def resolve_path(page_path: Column, href: Column) -> Column:
    """Archive path of a link found on a page."""
    return resolve_in(dirname(page_path), href)


def listed_path(root_dir: str, href: Column) -> Column:
    """Archive path of a link found in a contents listing."""
    return resolve_in(F.lit(root_dir), href)


def slug(text: Column) -> Column:
    """Title slug: markup, entities and all but ``[%a-z0-9_-]`` dropped, spaces dashed."""
    out = F.regexp_replace(text, r"<[^>]*?>", "")
    out = F.regexp_replace(out, r"%([a-fA-F0-9][a-fA-F0-9])", "---$1---")
    out = F.regexp_replace(out, r"^%+|%+$", "")
    out = F.regexp_replace(out, r"---([a-fA-F0-9][a-fA-F0-9])---", "%$1")
    out = F.regexp_replace(F.lower(out), r"&[^\n]+?;", "")
    out = F.regexp_replace(F.replace(out, F.lit("."), F.lit("-")), r"[^%a-z0-9 _-]", "")
    return F.regexp_replace(out, r"[ -]+", "-")


def split_names(text: Column, keep_blank: bool = False) -> Column:
    """Comma-separated names, trimmed; empty ones go, blank ones only on request."""
    tokens = F.filter(F.split(text, ","), lambda x: x != "")
    names = F.transform(tokens, lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return names if keep_blank else F.filter(names, lambda x: x != "")


def clean_filename(path: Column) -> Column:
    """File name of a media path, freed of view markers and awkward characters."""
    name = basename(path)
    ext = F.regexp_extract(name, r"(?U)FieldElemFormat=(\w+)", 1)
    name = F.replace(name, F.lit("OpenElement"), F.lit(""))
    name = F.replace(name, F.concat(F.lit("FieldElemFormat="), ext), F.lit(""))
    name = F.concat(name, F.when(ext != "", F.concat(F.lit("."), ext)).otherwise(""))
    name = F.translate(name, FILENAME_DROPPED, "")
    name = F.regexp_replace(name, r"[\r\n\t -]+", "-")
    return F.regexp_replace(name, r"^[._-]+|[._-]+$", "")


def extension(name: Column) -> Column:
    """Extension with its dot, lower-cased; leading dots start no extension."""
    return F.lower(F.regexp_extract(name, r"[^.][^/]*?(\.[^./]*)$", 1))


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=[^.])\.[^./]*$", "")


def _one_byte(latin1: Column, codec: str) -> Column:
    """Text of a one-byte charset, given its bytes as ISO-8859-1."""
    high = bytes(range(0x80, 0x100))
    return F.translate(latin1, high.decode("latin-1"), high.decode(codec, errors="replace"))


def _utf16(content: Column, little: bool) -> Column:
    """Text of UTF-16 after its byte-order mark; halves of pairs that stand alone become U+FFFD."""
    any_, high, low = "[0-9A-F]{2}", "D[89AB]", "D[C-F]"
    first, second, bad = (f"{any_}{high} ", f"{any_}{low} ", "FDFF ") if little else (f"{high}{any_} ", f"{low}{any_} ", "FFFD ")
    units = F.regexp_replace(F.hex(F.substring(content, 3, 2**31 - 1)), r"([0-9A-F]{4})|[0-9A-F]{2}$", "$1 ")
    units = F.regexp_replace(units, f"{first}(?!{second})", bad)
    units = F.regexp_replace(units, f"(?<!{first}){second}", bad)
    return F.decode(F.unhex(F.replace(units, F.lit(" "), F.lit(""))), "UTF-16LE" if little else "UTF-16BE")


def declared_charset(content: Column) -> Column:
    """The charset a page's first KiB declares, in lower case and by its usual name; empty without one."""
    head = F.decode(F.substring(content, 1, 1024), "ISO-8859-1")
    name = F.lower(F.regexp_extract(head, DECLARED, 1))
    aliases = F.create_map(*[F.lit(x) for pair in CHARSET_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(aliases, name), name)


def decode_bytes(content: Column) -> Column:
    """Text of raw bytes: by a byte-order mark, by the charset the page declares, as UTF-8, else as windows-1252."""
    mark = F.hex(F.substring(content, 1, 3))
    latin1, utf8 = F.decode(content, "ISO-8859-1"), content.cast("string")

    def by_name(name: Column) -> Column:
        out = F.when(mark == "EFBBBF", F.regexp_replace(F.make_valid_utf8(utf8), "^\\ufeff", ""))
        out = out.when(mark.startswith("FFFE"), _utf16(content, True)).when(mark.startswith("FEFF"), _utf16(content, False))
        for charset, codec in CHARSETS.items():
            out = out.when(name == charset, _one_byte(latin1, codec))
        return out.when(F.is_valid_utf8(utf8), utf8).otherwise(_one_byte(latin1, "cp1252"))

    return F.when(content.isNotNull(), let(declared_charset(content), by_name))


def is_binary(content: Column) -> Column:
    """Binary test on the first KiB: a zero byte, or no valid UTF-8 and many control bytes; a byte-order mark says text."""
    head = F.substring(content, 1, 1024)
    as_latin = F.decode(head, "ISO-8859-1")
    printable = F.length(F.translate(as_latin, CONTROL_CHARACTERS, ""))
    garbled = ~F.is_valid_utf8(head.cast("string")) & (printable < F.length(as_latin) * 0.7)
    marked = F.hex(F.substring(content, 1, 3)).rlike(BYTE_ORDER_MARK)
    return F.coalesce(~marked & (F.contains(head, F.lit(b"\x00")) | garbled), F.lit(False))


def media_type(content: Column) -> Column:
    """Media type by a file's first bytes (4 KiB are enough); the signature with most digits wins.

    Zip archives are told apart by their first entries, texts by their markup.
    """
    head = F.substring(content, 1, 4096)
    text = F.decode(head, "ISO-8859-1")
    out = F.when(F.length(content) == 0, "inode/x-empty")
    # A container that names its type in its first entry, uncompressed.
    stored = F.regexp_extract(text, r"^PK\x03\x04(?s:.{26})mimetype([A-Za-z0-9.+-]+/[A-Za-z0-9.+-]+?)(?=PK|[^A-Za-z0-9.+-]|$)", 1)
    out = out.when(stored != "", stored)
    is_zip = F.hex(F.substring(content, 1, 4)) == "504B0304"
    for mark, mime in ZIP_MARKS:
        out = out.when(is_zip & F.contains(text, F.lit(mark)), mime)
    for offset, digits, mime in sorted(SIGNATURES, key=lambda x: -len(x[1].replace(".", ""))):
        found = F.hex(F.substring(content, offset + 1, len(digits) // 2))
        out = out.when(found.rlike(f"^{digits}$") if "." in digits else found == digits, mime)
    markup = F.regexp_replace(text, r"^(?:\xEF\xBB\xBF)?\s+", "")
    out = out.when(is_binary(content), "application/octet-stream")
    return (
        out.when(markup.rlike(r"(?is)^(?:<\?xml[^>]*>\s*)?(?:<!--.*?-->\s*)*(?:<!doctype svg[^>]*>\s*)?<svg\b"), "image/svg+xml")
        .when(markup.rlike(r"(?i)^<\?xml\b"), "text/xml")
        .when(markup.rlike(r"(?i)^(?:<!doctype html|<html\b)"), "text/html")
        .otherwise("text/plain")
    )
