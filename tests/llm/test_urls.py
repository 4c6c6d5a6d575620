"""Links in odd pages, and hosts that are trusted as much as distrusted."""

import random
import re
import time

from tablewinnow.llm import urls

SLOW = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def test_blanks_take_time_linear_in_their_number(spark):
    pages = [(i, "http://a.example/", "href=" + " " * 200_000 + "x") for i in range(4)]
    pages.append((9, "http://b.example/", 'href = " ' + "\n" * 50_000 + "//a.example/x"))
    docs = spark.createDataFrame(pages, "page_id long, url string, html string")
    urls.judge_urls(docs.limit(1)).collect()
    start = time.monotonic()
    assert len(urls.judge_urls(docs).collect()) == 5
    assert time.monotonic() - start < 60


def test_the_same_links_as_a_plain_pattern(spark):
    draw = random.Random(1)
    parts = ["href", "HREF", "=", " ", "\n", '"', "'", "http:", "https:", "//", "a.b", "/", "x", "?", "<", ">"]
    texts = ["".join(draw.choices(parts, k=12)) for _ in range(3000)]
    texts += [f'<a href{a}={b}{q}{c}{s}//host.example{e}' for a in ("", " ") for b in ("", "\t ")
              for q in ("", '"', "'") for c in ("", " ") for s in ("", "http:", "HTTPS:") for e in ("", "/x", '"')]
    frame = spark.createDataFrame([(t,) for t in texts], "html string")
    found = frame.select(urls.F.regexp_extract_all("html", urls.F.lit(urls.LINK), urls.F.lit(1)))
    assert [r[0] for r in found.collect()] == [re.findall(SLOW, t, re.ASCII) for t in texts]


def test_equal_trust_and_distrust_is_allowed(spark):
    """A host linked to from a trusted one that links to a blocked one, both alike."""
    rules = (("allow", "good.example/"), ("block", "bad.example/"))
    link = '<a href="http://{}/">'
    pages = [
        (1, "http://good.example/", link.format("mid.test")),
        (2, "http://mid.test/", link.format("bad.example")),
        (3, "http://bad.example/", ""),
    ]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string")
    for parts in (1, 2, 3):
        judged = {r.host: r for r in urls.judge_urls(docs.repartition(parts), rules).collect()}
        assert abs(judged["mid.test"].trust - judged["mid.test"].distrust) < 1e-12
        assert judged["mid.test"].verdict == "allow"
