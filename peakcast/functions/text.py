"""String helpers as column expressions: stripping, slugs, URLs, page text."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named character references come from the standard table, the old ones without a semicolon included. Those of one first
# letter (from A on) stand in one text, as a name between U+0001 and U+0002 and then its characters: a search in it needs no
# map in the plan.
_NAMES = ["\u0001" + "".join(f"{k}\u0002{v}\u0001" for k, v in sorted(html5.items()) if k[0] == chr(c)) for c in range(ord("A"), ord("z") + 1)]
# Numbers 128 to 159 mean the characters of the Windows code page.
_WINDOWS = bytes(range(128, 160)).decode("cp1252", "replace")


# Fixed value: the characters Python's ``str.strip()`` removes (``str.isspace``).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
                 "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def pystrip(c: Column) -> Column:
    """Strip leading/trailing whitespace like Python ``str.strip()`` (a character trim, no regex)."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def pystrip_edges(c: Column) -> Column:
    """``pystrip`` of a plain column, which is read several times: a text whose first and last characters are printable
    ASCII (as nearly all are) stays as it is, at a fraction of a trim's cost, which looks up each character in the list."""
    last = F.substring(c, -1, 1)
    bare = (c >= "!") & (c < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(bare, c).otherwise(pystrip(c))


def slug(c: Column) -> Column:
    """Non-alphanumeric runs become ``_``; leading/trailing ``_`` removed."""
    return F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")


def _code_point(n: Column) -> Column:
    """The character of a code point (U+FFFD where there is none)."""
    return (F.when(n.between(128, 159), F.substring(F.lit(_WINDOWS), n.cast("int") - 127, F.lit(1)))
            .when((n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit("\ufffd"))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))


def _named(ref: Column) -> Column:
    """The characters of a named reference (null if the name is unknown)."""
    names = F.get(F.array(*[F.lit(n) for n in _NAMES]), F.ascii(ref) - ord("A"))
    after = F.substring_index(F.substring(names, F.position(F.concat(F.lit("\u0001"), ref, F.lit("\u0002")), names), F.length(names)), "\u0001", 2)
    return F.when(names.contains(F.concat(F.lit("\u0001"), ref, F.lit("\u0002"))), F.substring_index(after, "\u0002", -1))


def decode_entities(c: Column) -> Column:
    """Character references decoded in one pass (``&amp;lt;`` stays ``&lt;``): decimal, hexadecimal and the
    standard names; numbers and the old names may lack the semicolon. Anything else that begins with ``&`` is text."""

    def cut(x: Column) -> Column:  # each step's value is a field, so the next ones read it as often as they like
        ref = F.regexp_extract(x, r"^(?:#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]*);?", 0)
        return F.struct(x.alias("x"), ref.alias("ref"))

    def number(p: Column) -> Column:
        digits = F.rtrim(F.substring(p["ref"], 2, 9), F.lit(";"))
        n = F.when(p["ref"].startswith("#"), F.when(F.lower(digits).startswith("x"), F.conv(F.substring(digits, 2, 8), 16, 10)).otherwise(digits))
        return F.struct(p["x"].alias("x"), p["ref"].alias("ref"), n.cast("long").alias("n"))

    def one(p: Column, i: Column) -> Column:
        x, ref = p["x"], p["ref"]
        char = F.when((i == 0) | (ref == ""), F.lit(None)).when(p["n"].isNotNull(), _code_point(p["n"]))
        for name in ("amp", "lt", "gt", "quot", "nbsp"):  # the usual ones need no look at the table
            char = char.when(ref == f"{name};", F.lit(html5[f"{name};"]))
        return F.struct(x.alias("x"), F.length(ref).alias("skip"), char.otherwise(_named(ref)).alias("char"))

    def put(p: Column, i: Column) -> Column:
        return (F.when(i == 0, p["x"]).when(p["char"].isNull(), F.concat(F.lit("&"), p["x"]))
                .otherwise(F.concat(p["char"], F.substring(p["x"], p["skip"] + 1, F.length(p["x"])))))

    pieces = F.transform(F.transform(F.transform(F.split(c, "&", -1), cut), number), one)
    return F.when(c.contains("&"), F.array_join(F.transform(pieces, put), "")).otherwise(c)


def without_tags(fragment: Column) -> Column:
    """Text nodes of a fragment, blanks next to tags removed, references as they stand."""
    return F.when(fragment.contains("<"), F.regexp_replace(fragment, r"\s*<[^>]*>\s*", "")).otherwise(fragment)


def visible_text(fragment: Column) -> Column:
    """Text of an HTML fragment: tags removed, each text node stripped, joined with nothing.

    The tag strip and the entity decoding only run on text that has a ``<`` / ``&``.
    """
    return pystrip(decode_entities(without_tags(fragment)))


def visible_texts(fragments: Column) -> Column:
    """``visible_text`` of each of an array of fragments (none of them null), references decoded in one go."""
    joined = F.array_join(F.transform(fragments, without_tags), "\u0001")
    return F.transform(F.split(decode_entities(joined), "\u0001", -1), pystrip)


def node_text(fragment: Column, sep: str = " ") -> Column:
    """Text nodes of a fragment, each stripped, empty ones dropped, joined with ``sep``; entities decoded."""
    parts = F.split(F.regexp_replace(fragment, r"<[^>]*>", "\u0001"), "\u0001")
    kept = F.filter(F.transform(parts, lambda x: pystrip(decode_entities(x))), lambda x: x != "")
    return (F.when(fragment.contains("<"), F.array_join(kept, sep)).when(fragment.contains("&"), pystrip(decode_entities(fragment)))
            .otherwise(pystrip(fragment)))


# Parts of a page that are no markup and no visible text.
HIDDEN_RE = r"(?is)<!--.*?(?:-->|\z)|<(script|style)(?=[\s/>]).*?(?:</\1\s*>|\z)"


def without_hidden(html: Column) -> Column:
    """A page without comments, scripts and style sheets (an unclosed one lasts to the end)."""
    return F.when(html.rlike(r"(?i)<(?:!--|script|style)"), F.regexp_replace(html, HIDDEN_RE, "")).otherwise(html)


def element_body(rest: Column) -> Column:
    """What a ``div`` holds, of the text after its opening tag: up to the place where as many divs are closed as
    opened (to the end if that never happens). The text is cut before each div tag and folded with a running depth."""
    # The blank put before the text makes a first piece that is no tag, so what the others begin with tells them apart.
    pieces = F.split(F.concat(F.lit(" "), rest), r"(?i)(?=</?div[\s/>])", -1)
    state = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("taken"))

    def step(s: Column, x: Column) -> Column:
        depth = s["depth"] + F.when(x.startswith("</d") | x.startswith("</D"), -1).when(x.startswith("<d") | x.startswith("<D"), 1).otherwise(0)
        return F.when(s["depth"] == 0, s).otherwise(
            F.struct(depth.alias("depth"), (s["taken"] + F.when(depth > 0, 1).otherwise(0)).alias("taken")))

    taken = F.aggregate(pieces, state, step, lambda s: s["taken"])
    body = F.array_join(F.slice(pieces, 1, taken), "")
    return F.substring(body, F.lit(2), F.length(rest))


# What an element holds if the divs in it hold no further ones.
FLAT_BODY_RE = r"(?is)\A((?:[^<]++|<(?!/?div[\s/>])|<div[\s/>](?:[^<]++|<(?!/?div[\s/>]))*+</div[\s/>])*+)</div[\s/>]"


def row_body(rest: Column) -> Column:
    """``element_body`` of a row: one match where its cells hold no divs, the fold for others."""
    flat = F.regexp_extract(rest, FLAT_BODY_RE, 1)
    return F.coalesce(F.nullif(flat, F.lit("")), element_body(rest))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in the text of an opening tag, in double quotes, in single quotes or bare, its references
    as they stand ('' if absent)."""
    return unquoted(quoted_attribute(tag, name))


def quoted_attribute(tag: Column, name: str) -> Column:
    """``attribute`` with the quotes around it."""
    value = F.regexp_extract(tag, rf"""(?i)(?:^|[\s"']){name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.when(tag.contains(name), value).otherwise("")


def unquoted(value: Column) -> Column:
    """An attribute's value without its quotes; a bare one has none."""
    return F.when(F.substring(value, 1, 1).isin('"', "'"), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def url_query_param(url: Column, name: str) -> Column:
    """First non-blank value of a query parameter, percent-decoded; '' when absent (never null for a non-null url).

    Cut by pattern, so that a URL with blanks or other characters that strict parsers reject still has its values; a
    value that is no valid percent-encoding stays as it is."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    value = F.regexp_extract(F.concat(F.lit("&"), query), f"&{name}=([^&]+)", 1)
    return F.coalesce(F.try_url_decode(value), value, F.lit(""))


def url_has_required_query(url: Column) -> Column:
    """True iff both list_hnd and season_hnd are present and all digits."""
    return (url_query_param(url, "list_hnd").rlike("^[0-9]+$")
            & url_query_param(url, "season_hnd").rlike("^[0-9]+$"))


def gender_from_url(url: Column) -> Column:
    return (F.when(url.contains("_m_"), "Men")
            .when(url.contains("_f_") | url.contains("_w_"), "Women")
            .otherwise("Unknown"))


def team_and_gender_from_title(title: Column) -> tuple[Column, Column]:
    """Split a page title at the first `` Men's`` / `` Women's``.

    Without that word the ``Track & Field...`` tail is removed and the gender is Unknown;
    a missing title gives (Unknown Team, Unknown).
    """
    m = F.regexp_extract(title, r"^(.*?)\s+(Men's|Women's)\b", 2)
    head = F.regexp_extract(title, r"^(.*?)\s+(Men's|Women's)\b", 1)
    tail_cut = pystrip(F.regexp_replace(title, r"\s*Track\s*&\s*Field.*$", ""))
    team = (F.when(title.isNull(), "Unknown Team")
            .when(m != "", pystrip(head)).otherwise(tail_cut))
    gender = (F.when(title.isNull(), "Unknown")
              .when(m.startswith("Men"), "Men").when(m != "", "Women").otherwise("Unknown"))
    return team, gender


# Fixed value: the division pattern, searched case-insensitively in the page text.
DIVISION_PATTERN = r"(?i)(NCAA\s*Division\s*(I{1,3})|NCAA\s*D[123]|NAIA|NJCAA)"


# What a mention (upper case) must hold for each label, first match wins.
DIVISION_LABELS = ((r"NCAA.*DIVISION\s*III", "NCAA Division III"), (r"NCAA.*DIVISION\s*II", "NCAA Division II"),
                   (r"NCAA.*DIVISION\s*I", "NCAA Division I"), ("NCAA D1", "NCAA Division I"), ("NCAA D2", "NCAA Division II"),
                   ("NCAA D3", "NCAA Division III"), ("NAIA", "NAIA"), ("NJCAA", "NJCAA"))


def division_from_text(text: Column) -> Column:
    """First division mention normalised by DIVISION_LABELS, else the title-cased match, else Unknown."""
    return division_label(division_mention(text))


def division_mention(text: Column) -> Column:
    """First division mention of a text, upper case ('' if there is none)."""
    found = F.upper(F.regexp_extract(text, DIVISION_PATTERN, 0))
    return pystrip(F.replace(found, F.lit("  "), F.lit(" ")))


def division_label(found: Column) -> Column:
    """A mention's label. It reads the mention many times, so a whole page's belongs in a column of its own."""
    label = F.when(found == "", "Unknown")
    for pattern, name in DIVISION_LABELS:
        label = label.when(found.rlike("(?s)" + pattern), name)
    return label.otherwise(F.initcap(found))
