"""Raw page markup to text, by regular expressions and array functions.

A page is one row, so everything here stays inside the row: no explode, no
shuffle. Patterns avoid look-around and back references on purpose; they then
run in linear-time engines as well and can be checked against one.
"""

from __future__ import annotations

from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.strings import _col, collapse_ws, interleave, let, nonblank
from newsloom.functions.tables import fixed_table

HIDDEN = (
    r"(?is)<(?:!--.*?--"
    r"|script(?:\s[^>]*)?>.*?</script\s*"
    r"|style(?:\s[^>]*)?>.*?</style\s*"
    r"|noscript(?:\s[^>]*)?>.*?</noscript\s*)>"
)
TAG = r"</?[A-Za-z!][^>]*>"
# Some names may stand without their semicolon; the longer ones are tried first.
BARE_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
ENTITY = rf"&(#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;|{BARE_NAMES})"
BLOCK_START = r"(?i)<(?:p|li|div|h[1-6]|td|section|article|main|blockquote|pre|ul|ol|table|nav|footer|header|aside)(?:\s[^>]*)?>"
ANCHOR = r"(?is)<a(?:\s[^>]*)?>.*?</a\s*>"

# Extensions that are never an article page.
AUDIO_EXTENSIONS = ("mp3", "m4a", "aac", "ogg", "wav")
BINARY_EXTENSIONS = (*AUDIO_EXTENSIONS, "zip", "pdf")

MIN_ARTICLE_WORDS = 40


# Numbers 128 to 159 are read as Windows-1252, as page parsers do; five of them are free there.
LOW_NUMBERS = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)]


def _codepoint_to_text(cp: Column) -> Column:
    valid = cp.between(1, 0xD7FF) | cp.between(0xE000, 0x10FFFF)
    low = F.element_at(F.array(*[F.lit(c) for c in LOW_NUMBERS]), (cp - 127).cast("int"))
    return (
        F.when(cp.between(128, 159), low)
        .when(valid, F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32"))
        .otherwise(F.lit("\ufffd"))
    )


@cache
def _named_entities() -> dict[str, str]:
    """Name, with its semicolon if it has one, to text."""
    return dict(sorted(html5.items()))


def decode_entities(c: Column | str) -> Column:
    """Named and numeric references to characters, each decoded exactly once.

    Names are those of HTML 5. Numbers that are no character, however long,
    become the replacement character; unknown names stay as they are.
    """
    named = fixed_table(_named_entities())

    def one(ref: Column) -> Column:
        digits = F.regexp_extract(ref, "^#([0-9]+);?$", 1)
        hexits = F.regexp_extract(ref, "^#[xX]([0-9A-Fa-f]+);?$", 1)
        return (
            F.when(digits != "", let(digits.try_cast("long"), _codepoint_to_text))
            .when(hexits != "", let(F.conv(hexits, 16, 10).try_cast("long"), _codepoint_to_text))
            .otherwise(F.coalesce(named(ref), F.concat(F.lit("&"), ref)))
        )

    def whole(text: Column) -> Column:
        decoded = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), 1), one)
        return F.when(F.contains(text, F.lit("&")), interleave(F.split(text, ENTITY, -1), decoded)).otherwise(text)

    return let(_col(c), whole)


def drop_hidden(c: Column | str) -> Column:
    """Remove comments and the bodies of script, style and noscript."""
    return F.regexp_replace(_col(c), HIDDEN, " ")


def tags_to_space(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), TAG, " ")


def html_to_text(c: Column | str) -> Column:
    """Visible text of a fragment; tag boundaries become blanks."""

    def untagged(text: Column) -> Column:
        # most text has no markup at all, and looking for one character is cheap
        return F.when(F.contains(text, F.lit("<")), tags_to_space(drop_hidden(text))).otherwise(text)

    return decode_entities(let(_col(c), untagged))


def container(c: Column | str) -> Column:
    """Inner markup of the first article element, else of main, else the page."""

    def pick(visible: Column) -> Column:
        inner = [
            F.nullif(F.regexp_extract(visible, rf"(?is)<{name}(?:\s[^>]*)?>(.*?)</{name}\s*>", 1), F.lit(""))
            for name in ("article", "main")
        ]
        return F.coalesce(*inner, visible)

    return let(drop_hidden(c), pick)


def _after_first(pieces: Column) -> Column:
    return F.filter(pieces, lambda _, i: i > 0)


def paragraphs(c: Column | str) -> Column:
    """Texts of the paragraph elements of markup without hidden parts."""
    bodies = _after_first(F.split(_col(c), r"(?i)<p(?:\s[^>]*)?>", -1))
    closed = F.transform(bodies, lambda x: F.substring_index(F.regexp_replace(x, r"(?i)</p\s*>", "</p>"), "</p>", 1))
    texts = F.transform(closed, lambda x: collapse_ws(decode_entities(tags_to_space(x))))
    return F.filter(texts, lambda x: x != "")


def paragraph_text(c: Column | str, sep: str = " ") -> Column:
    return F.array_join(paragraphs(c), sep)


def main_blocks(c: Column | str, min_chars: int = 25, max_link_share: float = 0.33) -> Column:
    """Text blocks that read like content and are not mostly links.

    In a page with an article or main element these are all of its blocks,
    however short; elsewhere a block must be long enough and hold punctuation.
    """

    def measure(x: Column) -> Column:
        text = collapse_ws(decode_entities(tags_to_space(x)))
        unlinked = collapse_ws(decode_entities(tags_to_space(F.regexp_replace(x, ANCHOR, " "))))
        return F.struct(text.alias("text"), F.length(unlinked).alias("plain"))

    def reads_well(b: Column) -> Column:
        return (b["text"] != "") & (b["plain"] >= F.length(b["text"]) * F.lit(1.0 - max_link_share))

    def long_enough(b: Column) -> Column:
        return (F.length(b["text"]) >= min_chars) & b["text"].rlike(r"[.,;:!?]")

    def blocks(visible: Column, inner: Column) -> Column:
        marked = inner != visible
        bodies = _after_first(F.split(F.when(marked, F.concat(F.lit("<p>"), inner)).otherwise(visible), BLOCK_START, -1))
        kept = F.filter(F.transform(bodies, measure), lambda b: reads_well(b) & (marked | long_enough(b)))
        return F.transform(kept, lambda b: b["text"])

    return let(drop_hidden(c), lambda visible: let(container(visible), lambda inner: blocks(visible, inner)))


def main_text(c: Column | str, min_chars: int = 25, max_link_share: float = 0.33) -> Column:
    return F.array_join(main_blocks(c, min_chars, max_link_share), " ")


def word_count(c: Column | str) -> Column:
    return F.size(F.filter(F.split(collapse_ws(c), " ", -1), lambda w: w != ""))


def min_words_gate(candidate: Column | str, fallback: Column | str, words: int = MIN_ARTICLE_WORDS) -> Column:
    """The candidate when it has more than ``words`` words, else the fallback."""
    return F.when(word_count(candidate) > words, _col(candidate)).otherwise(_col(fallback))


def _has_extension(url: Column, extensions: tuple[str, ...]) -> Column:
    return F.lower(url).rlike(r"\.(" + "|".join(extensions) + r")$")


def is_page_url(url: Column | str) -> Column:
    """False for blank links and links to audio, archives or documents."""
    u = _col(url)
    return nonblank(u) & ~_has_extension(u, BINARY_EXTENSIONS)


def best_link(links: Column | str, link: Column | str, entry_id: Column | str) -> Column:
    """Pick the link of a feed entry that most likely leads to a page.

    Order: a usable HTML alternate; the entry's own link or id unless audio;
    any other link that is not audio; whatever the entry has.
    """
    usable = F.filter(_col(links), lambda l: nonblank(l["href"]))

    def is_alternate(l: Column) -> Column:
        rel = F.lower(F.coalesce(l["rel"], F.lit("")))
        kind = F.lower(F.coalesce(l["type"], F.lit("")))
        return rel.isin("", "alternate") & ((kind == "") | F.startswith(kind, F.lit("text/html")))

    own = F.coalesce(F.nullif(_col(link), F.lit("")), F.nullif(_col(entry_id), F.lit("")), F.lit(""))
    alternate = F.get(F.filter(usable, is_alternate), F.lit(0))["href"]
    silent = F.get(F.filter(usable, lambda l: ~_has_extension(l["href"], AUDIO_EXTENSIONS)), F.lit(0))["href"]
    return F.coalesce(
        alternate,
        F.when(nonblank(own) & ~_has_extension(own, AUDIO_EXTENSIONS), own),
        silent,
        own,
    )


def resolve_url(base: Column | str, link: Column | str) -> Column:
    """Root-relative links get the scheme and host of the page they stand on."""
    b, l = _col(base), _col(link)
    origin = F.concat(F.try_parse_url(b, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(b, F.lit("HOST")))
    scheme = F.concat(F.try_parse_url(b, F.lit("PROTOCOL")), F.lit(":"))
    return (
        F.when(F.startswith(l, F.lit("//")), F.coalesce(F.concat(scheme, l), l))
        .when(F.startswith(l, F.lit("/")), F.coalesce(F.concat(origin, l), l))
        .otherwise(l)
    )

