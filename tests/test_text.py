import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from newsloom.functions import cleaning as cl
from newsloom.functions import dates as dt
from newsloom.functions import markup as mk
from newsloom.functions import strings as st


def one(spark, column, *values):
    """Values of a column expression over single-column rows named t."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(column.alias("x")).collect()]


def test_blank_and_trim(spark):
    assert one(spark, st.nonblank("t"), None, "", " \t\u00a0", " a ") == [False, False, False, True]
    assert one(spark, st.strip("t"), "\t a b \n\u2003", None) == ["a b", None]
    assert one(spark, st.collapse_ws("t"), " a\r\n\tb  c ", None) == ["a b c", ""]
    assert one(spark, st.blank_to_empty("t"), None, " \n", " a ") == ["", "", " a "]


def test_first_nonblank_and_raw_text(spark):
    df = spark.createDataFrame(
        [("body", "T", "S"), (" ", "T", None), (None, None, "S"), ("", None, None)],
        "full_text string, title string, summary string",
    )
    assert [r[0] for r in df.select(st.raw_text()).collect()] == ["body", "T", "S", ""]
    picked = df.select(st.first_nonblank("full_text", "title", default="-").alias("x")).collect()
    assert [r.x for r in picked] == ["body", "T", "-", "-"]


def test_entities_decode_once(spark):
    got = one(spark, mk.decode_entities("t"), "a &amp;lt; b", "&eacute;&#233;&#xE9;", "&bogus; & x", "&#0;", "&#128512;", None)
    assert got == ["a &lt; b", "ééé", "&bogus; & x", "\ufffd", "😀", None]
    got = one(spark, mk.decode_entities("t"), "a &#146;b&#x80;", "&check;&lbrace;", "&nbsp x &copy2 &#65", "&#99999999999999999999; &#x110000;", "&&& &;")
    assert got == ["a ’b€", "✓{", "\u00a0 x ©2 A", "\ufffd \ufffd", "&&& &;"]


def test_html_to_text_drops_hidden_parts(spark):
    html = "<p>a<b>b</b></p><script>var s='<p>no</p>'</script><style>p{}</style><!-- no --><noscript>no</noscript>c &lt; d"
    text = one(spark, st.collapse_ws(mk.html_to_text("t")), html)[0]
    assert text == "a b c < d"


def test_paragraphs_container_gate(spark):
    page = ("<nav><p>menu</p></nav><ARTICLE class='x'><p>First <i>one</i>.<p class=a>Second.</p> tail "
            "<p> </p></article><main><p>not this</p></main>")
    assert one(spark, mk.paragraph_text(mk.container("t")), page) == ["First one . Second."]
    assert one(spark, mk.paragraph_text("t", "\n"), "<p>a</p><p>b</p>", "no paragraphs") == ["a\nb", ""]
    assert one(spark, mk.container("t"), "<main>m</main>", "plain") == ["m", "plain"]
    gate = mk.min_words_gate("t", F.lit("fallback"), 3)
    assert one(spark, gate, "one two three", "one two three four") == ["fallback", "one two three four"]


def test_main_text_skips_link_lists(spark):
    links = "<ul><li><a href='/a'>A long link label, with comma</a></li></ul>"
    text = "<div>This block has real sentences, and it is long enough.</div><p>Kort nieuws</p>"
    assert one(spark, mk.main_text("t"), links + text) == ["This block has real sentences, and it is long enough."]
    # inside of an article short blocks are text like any other
    page = f"{links}<article>lead {links}{text}</article><p>Outside of it, with a long sentence.</p>"
    assert one(spark, mk.main_text("t"), page) == ["lead This block has real sentences, and it is long enough. Kort nieuws"]


@pytest.mark.parametrize(
    "links,link,entry_id,want",
    [
        ([("https://a/x", "alternate", "text/html")], "https://a/y", None, "https://a/x"),
        ([("https://a/x", None, None)], None, None, "https://a/x"),
        ([("https://a/e.mp3", "enclosure", "audio/mpeg")], "https://a/y", None, "https://a/y"),
        ([("https://a/e.mp3", "enclosure", "audio/mpeg")], None, "https://a/id", "https://a/id"),
        ([("https://a/e.mp3", "enclosure", "audio/mpeg"), ("https://a/z", "related", "text/html")], "https://a/y.MP3", None, "https://a/z"),
        ([], "https://a/y.mp3", None, "https://a/y.mp3"),
        (None, None, None, ""),
    ],
)
def test_best_link(spark, links, link, entry_id, want):
    df = spark.createDataFrame(
        [(links, link, entry_id)], "links array<struct<href:string,rel:string,type:string>>, link string, id string"
    )
    assert df.select(mk.best_link("links", "link", "id")).first()[0] == want


def test_urls(spark):
    assert one(spark, mk.is_page_url("t"), "https://a/b", "https://a/b.PDF", "", None) == [True, False, False, False]
    got = one(spark, mk.resolve_url(F.lit("https://a.example/x/y?z"), "t"), "/p", "https://b/p", "//c/p", None)
    assert got == ["https://a.example/p", "https://b/p", "https://c/p", None]
    assert one(spark, mk.resolve_url(F.lit("not a url"), "t"), "/p") == ["/p"]


def test_published_layouts(spark):
    shown = F.date_format(dt.published_ts("t"), "yyyy-MM-dd HH:mm:ss")
    got = one(
        spark, shown,
        "Tue, 21 Oct 2025 12:48:37 GMT", "Tue, 21 Oct 2025 12:48:37 +0200", "Tue, 21 Oct 2025 12:48:37",
        "2025-10-21T14:13:47.786257Z", "October 3, 2024", "21-10-2025", "21-10-2025 10:11", "junk", "", None,
    )
    assert got == [
        "2025-10-21 12:48:37", "2025-10-21 10:48:37", "2025-10-21 12:48:37", "2025-10-21 14:13:47",
        "2024-10-03 00:00:00", "2025-10-21 00:00:00", "2025-10-21 10:11:00", None, None, None,
    ]


def test_compose_published(spark):
    df = spark.createDataFrame([("05-02-2025", "09:30"), ("25-02-2025", ""), ("x", "y")], "d string, t string")
    got = [r[0] for r in df.select(dt.compose_published("d", "t")).collect()]
    assert got == ["Wed, 05 Feb 2025 09:30:00", "Tue, 25 Feb 2025 00:00:00", None]


def test_stable_characters_really_are_stable():
    import re

    unstable = re.compile(re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: "\\U%08X" % int(m.group(1), 16), cl.UNSTABLE))
    for cp in range(sys.maxunicode + 1):
        char = chr(cp)
        if not unstable.match(char) and not 0xD800 <= cp <= 0xDFFF:
            assert unicodedata.normalize("NFKC", char) == char
            assert unicodedata.combining(char) == 0


def test_nfkc(spark):
    values = ["ﬁne", "cafe\u0301", "plain", "a\u00a0b…", None, "“quoted” – €5"]
    want = [None if v is None else unicodedata.normalize("NFKC", v) for v in values]
    assert one(spark, cl.nfkc("t"), *values) == want


def test_clean_text_steps(spark):
    assert one(spark, cl.strip_number_header("t"), " #202 - Kop", "12: x", "a 1 - b") == ["Kop", "x", "a 1 - b"]
    text = "#12 - <b>Café</b>&nbsp;De&#8217;s, 3×4 @naam ÀÉÿ"
    assert one(spark, cl.clean_text("t"), text, None, " ") == ["café de s 3×4 naam àéÿ", "", ""]
    df = spark.createDataFrame([(text,)], "t string")
    assert cl.with_clean(df, "t").first()["clean"] == "café de s 3×4 naam àéÿ"
    assert one(spark, cl.clean_text_geo("t"), "<i>Den Haag</i>, ﬁn") == [" Den Haag , fin"]


def test_tag_split(spark):
    costs = cl.word_costs("de het cyber aanval data lek hello".split())
    got = one(spark, cl.split_tags("t", costs), "#HelloWorld2go @datalek en #cyberaanval #x", "no tag", None)
    assert got == ["Hello World 2 go data lek en cyber aanval x", "no tag", None]
    clean = cl.clean_text("t", tag_costs=costs)
    assert one(spark, clean, "Over #Datalek!") == ["over data lek"]


def test_segment_is_cheapest():
    """Against all ways of cutting the run into known words."""
    costs = cl.word_costs(["a", "ab", "b", "abc", "c", "bc", "cab"])

    def all_cuts(run):
        if not run:
            yield []
        for i in range(1, len(run) + 1):
            if run[:i] in costs:
                for rest in all_cuts(run[i:]):
                    yield [run[:i], *rest]

    for run in ("abc", "abcab", "cabbage"[:4], "bcabc"):
        best = min(sum(costs[w] for w in cut) for cut in all_cuts(run))
        assert sum(costs[w] for w in cl.segment(run, costs, 3)) == pytest.approx(best)
    assert cl.segment("zzabzz", costs, 3) in (["zz", "ab", "zz"], ["zzabzz"])
    assert "".join(cl.segment("Qwerty", costs, 3)) == "Qwerty"


def test_tokens(spark):
    assert one(spark, cl.ws_tokens("t"), "a  bb c", "") == [["a", "bb", "c"], []]
    assert one(spark, cl.word_tokens("t"), "Één a bé_1 x! 23") == [["één", "bé_1", "23"]]
    clean = "één a 3×44 twee"
    assert one(spark, cl.clean_word_tokens("t"), clean) == one(spark, cl.word_tokens("t"), clean)
    assert one(spark, cl.drop_stopwords(cl.ws_tokens("t"), cl.stopwords()), "de markt en de markt") == [["markt", "markt"]]


def test_stopword_list_is_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert cl.stopwords() == list(StopWordsRemover.loadDefaultStopWords("dutch"))


def test_fixed_table_of_any_keys(spark):
    from newsloom.functions.tables import fixed_table

    entries = {f"key {i} \u00e9\x01\"": i * 0.1 for i in range(3000)} | {"": -1.5, "\n": 7.0}
    look_up = fixed_table(entries, "double")
    keys = [*entries, "absent", "KEY 1", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r[0] for r in df.select(look_up(F.col("k"))).collect()] == [entries.get(k) for k in keys]
    empty = fixed_table({}, "string")
    assert df.select(empty(F.col("k")).alias("v")).where("v is not null").count() == 0


def test_every_named_reference(spark):
    from html.entities import html5

    names = sorted(n for n in html5 if n.endswith(";"))
    df = spark.createDataFrame([("&" + n, html5[n]) for n in names], "ref string, text string")
    assert df.where(~mk.decode_entities("ref").eqNullSafe(F.col("text"))).count() == 0
