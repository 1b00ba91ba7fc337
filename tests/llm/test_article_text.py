"""Main text of pages: what an article says stays, however much of it other pages of the host say too."""

import html as entities
import re
from html.parser import HTMLParser

import pytest

from panelwright.llm import pages

KIND = "page_id long, url string, html string"


def texts(spark, *listed, host="site.example"):
    rows = [(k, f"http://{host}/{k}", page) for k, page in enumerate(listed)]
    return [r.text for r in pages.extract(spark.createDataFrame(rows, KIND)).orderBy("page_id").collect()]


def page(*paragraphs, before="", after=""):
    return f"<html><body>{before}<article>{''.join(f'<p>{p}</p>' for p in paragraphs)}</article>{after}</body></html>"


COMMON = [f"A longer paragraph number {k} that was published before and is quoted here word for word, with a date." for k in range(3)]


def test_common_paragraphs_of_two_pages_stay(spark):
    got = texts(spark, page(*COMMON, "Own words of the first page."), page(*COMMON, "Own words of the second page."))
    assert got == ["\n".join([*COMMON, "Own words of the first page."]), "\n".join([*COMMON, "Own words of the second page."])]


@pytest.mark.parametrize("own", [1, 5, 40, 2000])
def test_one_character_more_or_less_changes_nothing(spark, own):
    """Copies, updated articles, series with one preface: no share of common text switches the whole page."""
    listed = [[*COMMON[:2], f"Part {k} " + "x" * own, COMMON[2]] for k in range(6)]
    assert texts(spark, *[page(*p) for p in listed]) == ["\n".join(p) for p in listed]


def test_republished_pages_stay_whole(spark):
    listed = [[f"Story {k % 3}, told at length in this one paragraph.", *COMMON] for k in range(9)]
    assert texts(spark, *[page(*p) for p in listed]) == ["\n".join(p) for p in listed]


def test_short_lines_at_the_edges_of_many_pages_go(spark):
    listed = [["Printed from our site", f"First words {k}.", "Read on below", f"Last words {k}.", "Share this page"] for k in range(6)]
    wanted = [f"First words {k}.\nRead on below\nLast words {k}." for k in range(6)]
    assert texts(spark, *[page(*p) for p in listed]) == wanted


def test_marked_parts_go_wherever_they_stand(spark):
    ad = "<div class='advert'>Buy this now, it is much cheaper than anywhere else in the whole of the town today.</div>"
    listed = [f"<article><p>First {k}.</p>{ad}<p>Second {k}.</p><section class='comments'><p>nice {k}</p></section></article>" for k in range(4)]
    assert texts(spark, *listed) == [f"First {k}.\nSecond {k}." for k in range(4)]


def test_long_and_deep_pages_are_read_whole(spark):
    long = page(*[f"Paragraph {k} of a very long page." for k in range(20_000)])
    deep = "<article>" + "<div>" * 140 + "<p>Down here.</p>" + "</div>" * 140 + "</article>"
    deeper = "<article>" + "<div>" * 5000 + "<p>Further down.</p>" + "</div>" * 5000 + "</article>"
    got = texts(spark, long, deep, deeper)
    assert got[0] == "\n".join(f"Paragraph {k} of a very long page." for k in range(20_000))
    assert got[1:] == ["Down here.", "Further down."]


class Plain(HTMLParser):
    """The text of the article element by blocks, for pages written like those of the test tables."""

    BLOCKS = set("p div h1 h2 h3 h4 h5 h6 ul ol li article blockquote table tr td th section pre figure dl dt dd br header main".split())
    GONE = set("script style nav footer aside form title noscript template button select textarea".split())
    MARKS = re.compile(r"\b(ad|ads|comments?|cookie|sidebar|newsletter|share|related|promo|footer|banner|nav|menu)\b")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.blocks = [], [""]

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCKS:
            self.blocks.append("")
        if tag not in ("br", "img", "meta", "link", "input", "hr", "wbr"):
            self.stack.append((tag, tag in self.GONE or any(self.MARKS.search(v or "") for k, v in attrs if k in ("class", "id"))))

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.blocks.append("")
        if any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if any(t == "article" for t, _ in self.stack) and not any(gone for _, gone in self.stack):
            self.blocks[-1] += data

    def text(self):
        return "\n".join(x for x in (" ".join(b.split()) for b in self.blocks) if x)


def test_against_an_independent_reader_on_given_pages(spark):
    """All pages of the smallest table: the same words in the same order as a plain reader of their article elements."""
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in pages.extract(table).collect()}
    alike = 0
    for row in table.collect():
        plain = Plain()
        plain.feed(row.html or "")
        plain.close()
        alike += entities.unescape(plain.text()).split() == entities.unescape(got[row.page_id]).split()
    assert alike >= 0.98 * len(got), (alike, len(got))
