"""Page operators: archives by round trip, url rules by brute force, main text on made pages."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from peakledger.llm import htmltext, urlfilter, warc

PAGES = "page_id long, url string, html string, digest string, host string"


def pages(spark):
    body = "<p>" + "word " * 50 + "</p>"
    rows = [(1, "http://a.example/1", body), (2, "http://a.example/2", body), (0, "http://b.example/", body + "x"), (5, None, None), (6, "u\r\nv", ""), (7, "x", "short"), (8, "y", "short"),
            (9, "http://long.example", "".join(random.Random(4).choices("abcdefgh \u00e9<>", k=300_000))), (9, "http://long.example", "again, with the same id"), (None, "n", "no id")]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def test_archive_round_trip(spark):
    got = {(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], bytes(r["payload"]) if r["payload"] is not None else None)
           for r in warc.round_trip(pages(spark)).collect()}
    want = set()
    for page, _, html, *_ in pages(spark).collect():
        raw = (html or "").encode()
        again = page == 2
        want.add((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 1 if again else None, None if again else raw))
    assert got == want
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


def test_ids_of_any_text_come_back(spark):
    ids = ["None", "a\r\nContent-Length: 3", "", " x ", "100%41", "\u00e9\u4f60", None]
    body = "<p>" + "word " * 50 + "</p>"
    got = warc.round_trip(spark.createDataFrame([(k, "u", body) for k in ids], "page_id string, url string, html string")).collect()
    assert sorted((str(r["page_id"]), r["page_id"] is None) for r in got) == sorted((str(k), k is None) for k in ids)
    assert {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {""} and sum(r["record_type"] == "revisit" for r in got) == 5


def test_small_ranges_and_false_magic(spark, tmp_path):
    """Members that hold the gzip magic in their data, read in ranges smaller than a member."""
    noise = random.Random(1)
    raw = [warc.record_bytes("response", "u", str(k), p, len(p), hashlib.sha256(p).hexdigest(), None)
           for k, p in enumerate([noise.randbytes(700) + warc.MAGIC + noise.randbytes(900) + warc.MAGIC * 3 + noise.randbytes(50) for _ in range(40)])]
    stored = b"".join(warc.member(r, 0) for r in raw)  # level 0 leaves the magic as it is
    assert stored.count(warc.MAGIC) >= 200
    (tmp_path / "part-0").write_bytes(stored)
    assert gzip.decompress(stored) == b"".join(raw)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("500", "1300", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            assert sorted(int(r["page_id"]) for r in warc.read(spark, str(tmp_path)).collect()) == list(range(40))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_long_members_end_in_zero():
    assert warc.member(b"x" * 20_000_000)[-1] == 0 and gzip.decompress(warc.member(b"x" * 20_000_000)) == b"x" * 20_000_000


def brute_rule(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [((len(h + p), len(h), h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


@pytest.mark.parametrize("seed", range(3))
def test_url_rules_by_brute_force(spark, seed):
    pick = random.Random(seed)
    hosts = ["org", "example.org", "a.example.org", "com", "x.com", "badorg", "org.com", "", "EXAMPLE.ORG", "a.b.com"]
    paths = ["", "/", "/e", "/es", "/es/", "/es/a", "/es/ab/c", "/en/1", "/en/12", "/fr/", "/de/\u00e9", "/de/", "/fr/\U0010ffffx"]
    urls = [pick.choice(["http://", "https://", "x", "//", "a://b://"]) + pick.choice(hosts) + pick.choice(paths) + pick.choice(["", "?q=/es/", "#/a://", "?a#b"]) for _ in range(400)]
    rules = [(pick.choice(["allow", "block"]), h, p) for h in ["org", "example.org", "com", "a.b.com", "x.com", ""] for p in pick.sample(paths, 5)]
    table = spark.createDataFrame([(k, u, "x", "y", "z") for k, u in enumerate([*urls, None, "", urls[0]])], "page_id long, url string, host string, path string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(table, urlfilter.rule_table(spark, rules), spread=3).collect()}
    assert got == {k: brute_rule(u, rules) for k, u in enumerate([*urls, None, "", urls[0]])}
    assert urlfilter.judge(table.limit(0), urlfilter.rule_table(spark, rules)).count() == 0


MENU = "<nav><ul><li><a href='/a'>Home page</a></li><li><a href='/b'>All our articles</a></li></ul></nav>"
ARTICLE = "<h1>A &amp; B</h1><p>First   paragraph with <b>several</b> good\n words in it.<p>Second one, with <a href='x'>a link</a> inside of it.</p>"
PAGE = f"<html><head><title>T</title><script>var x='<p>';</script></head><body>{MENU}<div class=\"ad\">Buy this now please.</div><article>{ARTICLE}</article><footer>&copy; someone</footer></body></html>"
TEXT = "A & B\nFirst paragraph with several good words in it.\nSecond one, with a link inside of it."


def test_main_text_of_labelled_and_other_pages(spark):
    other = PAGE.replace("<article>", '<div class="content">').replace("</article>", '<div id="comments"><p>Nice text, I like it a lot, more of this!</p></div></div>')
    form = PAGE.replace("<p>Second", "<form><label>Your mail</label><input></form><aside>See also these other things</aside><!-- <p>not shown</p> --><p>Second")
    rows = [(1, "a", PAGE), (2, "b", other), (3, "c", form), (4, None, None), (5, "e", ""), (6, "f", "<script>only code</script>"), (7, "g", "plain text, no tags < at all"), (None, "h", PAGE), (1, "a", PAGE)]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)
    costs = htmltext.learn(table)
    assert costs["li"] > costs["p"] and costs["nav"] > 1
    got = {r["page_id"]: r["text"] for r in htmltext.extract(table, costs).collect()}
    assert got == {1: TEXT, 2: TEXT, 3: TEXT, 4: "", 5: "", 6: "", 7: "plain text, no tags < at all", None: TEXT}
    assert htmltext.extract(table, costs).count() == len(rows)
    assert htmltext.learn(table.limit(0)) == {} and htmltext.main_text(PAGE, {}) == TEXT
    assert htmltext.extract(table.limit(0), {}).count() == 0


def test_unclosed_and_cut_pages():
    assert htmltext.main_text("<p>One two three<p>four five <b>six", {}) == "One two three\nfour five six"
    assert htmltext.main_text("<p>some words here &eacute;&#233; &unknown; &am", {}) == "some words here \u00e9\u00e9 &unknown; &am"
    assert len(htmltext.main_text("<p>" + "word " * 100_000, {}).split()) == 100_000


WORDS = " ".join(f"word{k}" for k in range(200))


@pytest.mark.parametrize("page", ['<div class="site has-sidebar"><article><p>{}</p></article></div>', '<form id="aspnetForm"><article><p>{}</p></article></form>',
                                  '<div class="post comments-open"><p>{}</p></div>', '<div id="social-policy"><p>{}</p></div>',
                                  '<nav>one two</nav><div class="share-page"><h1>Head</h1><p>{}</p></div><footer>three</footer>'])
def test_wrappers_do_not_take_the_article_with_them(page):
    text = htmltext.main_text(f"<html><body>{page.format(WORDS)}</body></html>", {})
    assert WORDS in text and "one two" not in text and "three" not in text


def test_comments_go_though_they_are_longer():
    text = htmltext.main_text(f"<article><p>{WORDS}</p></article><div class='comments'><p>{'no ' * 900}</p></div>", {})
    assert text == WORDS


@pytest.mark.parametrize("page", ["<a " * 350_000, '<a "' * 250_000 + ">", "<a '" * 250_001 + ">", "<" * 1_000_000, "<!--" * 250_000, "<a \"\" '' " * 80_000 + ">", "<script>" * 100_000, "<p><!x " * 150_000])
def test_a_megabyte_of_broken_tags_is_read_once(page):
    import time
    begun = time.process_time()
    htmltext.main_text(page, {})
    assert time.process_time() - begun < 5


@pytest.mark.parametrize("seed", range(20))
def test_best_run_is_the_largest_of_all_runs(seed):
    import random
    pick = random.Random(seed)
    scores = [pick.choice([0.0, 1.0, 3.0, -0.5, -2.0, -7.0]) for _ in range(pick.randrange(40))]
    begin, end = htmltext.best_run(scores)
    sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    assert sum(scores[begin:end]) == max([0.0, *sums]) and begin <= end


def test_random_pages_give_their_best_run():
    """Pages of plain blocks: what is written is the text of the tokens whose sum is the largest of all runs."""
    import random
    for seed in range(60):
        pick = random.Random(seed)
        page = "".join(pick.choice(["<p>", "</p>", "<div>", "</div>", "one two three ", "four ", "<span>", "</span>", "<li>"]) for _ in range(pick.randrange(1, 25)))
        costs = {t: pick.choice([0.02, 1.5, 4.0]) for t in ("p", "/p", "div", "/div", "li")}
        found = list(htmltext.tokens(page))
        scores = [htmltext.score(t, costs) for t in found]
        best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0)
        got = htmltext.main_text(page, costs)
        assert (got == "") == (best <= 0)
        begin, end = htmltext.best_run(scores)
        assert abs(sum(scores[begin:end]) - max(best, 0)) < 1e-9
        assert got.split() == " ".join(t[2] for t in found[begin:end] if t[0] == "text").split() or "<span>" in page
