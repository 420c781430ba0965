"""Spelling variants, token alignment and main text against plain versions and on odd input."""

import random
import re
from html import unescape

import brute
import pyarrow.parquet as pq
import pytest
from newsloom.llm import alignment, variants, wrappers
from newsloom.llm.queries import all_queries, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
TEXTS = "doc_id bigint, text string"
PAGES = "page_id bigint, url string, html string"


@pytest.fixture(scope="module")
def rows():
    table = pq.read_table(f"{SF_DIR}/documents.parquet")
    return list(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True))


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Spelling variants


def test_variants_equal_all_pairs(spark, rows):
    found = all_queries()["op11_spelling_variants"](spark, SF_DIR)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect())) == brute.spelling_variants(rows)


def dense_words(seed):
    """Many words of few letters, so that near words, runs of one letter and chains of forms abound."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(7, 11))) for _ in range(300)]
    words += ["x" * n for n in (59, 60, 61)] + ["ab" * 200, "ab" * 199 + "a", "ab" * 100 + "c" + "ab" * 100]
    words += ["Ünïcödé", "Ünïcöde", "ünïcödé"] + ["chainsa"] * 300 + ["chainsab"] * 20 + ["chainsabc"] * 2
    return [(i, " ".join(rng.sample(words, len(words)))) for i in range(3)] + [(None, "nulls nullify"), (7, None), (7, "")]


@pytest.mark.parametrize("hot", [20_000, 30, 1])
def test_variants_of_dense_words_and_cut_buckets(spark, hot):
    rows = dense_words(4)
    found = variants.group(spark.createDataFrame(rows, TEXTS), hot_bucket=hot)
    expected = brute.spelling_variants(rows)
    assert sorted(map(tuple, found.collect())) == expected
    assert any(root not in (word, form) for word, form, root, *_ in expected if form)


def test_variants_without_words_and_with_clashing_columns(spark):
    assert variants.group(spark.createDataFrame([], TEXTS)).collect() == []
    assert variants.group(spark.createDataFrame([(1, None), (None, "short")], TEXTS)).collect() == []
    docs = spark.createDataFrame([(i, "several several repeated words") for i in (1, 1, None)], TEXTS)
    clashing = docs.selectExpr("*", "1 AS word", "2 AS n", "3 AS rank", "4 AS `key`", "5 AS _run")
    assert tuples(variants.group(clashing)) == tuples(variants.group(docs)) != []


def test_every_near_pair_shares_one_window():
    rng = random.Random(1)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.choice([7, 8, 15, 33, 70])))
        at = rng.randrange(len(word))
        other = rng.choice([word[:at] + word[at + 1 :], word[:at] + "d" + word[at:], word[:at] + "d" + word[at + 1 :]])
        assert {k for k, *_ in variants.filings(word)} & {k for k, *_ in variants.filings(other)}


# Token alignment


def test_alignment_equals_all_tokens(spark, rows):
    found = all_queries()["op12_token_alignment"](spark, SF_DIR)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert tuples(found.select(names)) == sorted(brute.alignments(rows, *brute.token_bytes(*PATHS)), key=repr)


def odd_texts():
    rng = random.Random(6)
    parts = "abcdeé ßİı's't 12½\n\t\x0b\x1c\x85\xa0  　 _-!日本語🙂é<|endoftext|><s>̀‍\x00\n\n  "
    texts = [None, "", " ", "\n", "x▁y", "▁", " \n lead", "\nx", "<unk>", "日本" * 300, "u" * 3000, "a\r\nb", "ü  x"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.choice([1, 9, 200]))) for _ in range(300)]
    return [(i // 2 if i % 7 else None, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_alignment_of_odd_texts_and_of_a_joined_table(spark, limit):
    rows = odd_texts()
    docs = spark.createDataFrame(rows, TEXTS).selectExpr("*", "1 AS n_a", "2 AS pair", "3 AS block", "4 AS n")
    found = alignment.align(docs, *PATHS, broadcast_bytes=limit)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert tuples(found.select(names)) == sorted(brute.alignments(rows, *brute.token_bytes(*PATHS)), key=repr)


def test_alignment_of_an_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], TEXTS), *PATHS).collect() == []
    assert alignment.align(spark.createDataFrame([], TEXTS), *PATHS, broadcast_bytes=-1).collect() == []


# Main text


def test_main_text_of_given_pages(spark):
    pages = pq.read_table(f"{SF_DIR}/pages.parquet").to_pylist()
    found = {r["page_id"]: r for r in all_queries()["op13_main_text"](spark, SF_DIR).collect()}
    assert len(found) == len(pages)
    for page in pages:
        article = re.search("<article>(.*?)</article>", page["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        row = found[page["page_id"]]
        assert row["text"] == "\n".join(filter(None, blocks)) and row["n_chars"] == len(row["text"]) and row["url"] == page["url"]


def site(n, seed=0):
    """Pages of one layout without a single telling name but for what varies: the main text is a plain ``div``."""
    rng = random.Random(seed)
    words = lambda k: " ".join(rng.choice("river stone cloud bread winter lamp story".split()) + str(rng.randrange(999)) for _ in range(k))
    for i in range(n):
        title, body, teaser = words(5), [words(40) for _ in range(rng.randint(1, 6))], words(4)
        optional = "<div class='x1'><p>We use your data to make this site better. Accept</p></div>" if i % 2 else ""
        html = (
            f"<html><head><title>{title}</title></head><body>{optional}<div class=top><p>The Daily Stone</p><p>News for all</p></div>"
            f"<div><ul><li><a href=/{i}>{words(2)}</a><li><a href=/b>{words(2)}</a></ul></div>"
            f"<div class='c{i}'><h1>{title}</h1>" + "".join(f"<p>{b}" for b in body) + "<form>Your mail <input></form>"
            f"<div class=quote><p>Send this to a friend</p></div><section id=comments><p>{words(9)}</p></section></div>"
            f"<div class=end><p>All rights reserved</p><p>Imprint</p></div><div class=ad-slot>{teaser}</div></body></html>"
        )
        yield i, f"http://stone.example/{i}", html, "\n".join([title, *body])


def test_constant_nodes_are_template_and_varying_ones_content(spark):
    pages = list(site(12))
    found = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame([p[:3] for p in pages], PAGES)).collect()}
    assert [found[i] for i, *_ in pages] == [text for *_, text in pages]


def test_copies_of_a_page_show_no_template(spark):
    i, url, html, text = next(site(1))
    other = html.replace("Send this", "Please send this")
    rows = [(k, url, html if k % 9 else other) for k in range(40)]
    found = wrappers.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert len(found) == 40 and all(r["text"].startswith(text) for r in found)


def test_odd_pages(spark):
    article = "<article><h1>A&amp;B</h1><p>one<br>two &lt;x&gt; <i>th</i>ree<script>if (a<b) '</p>'</script><ul><li>x<li>y</ul>"
    rows = [
        (1, "http://a.example/", None), (2, None, ""), (3, "no scheme", "plain &eacute; text"), (3, "no scheme", "plain &eacute; text"),
        (4, "http://b.example/", f"<body><nav>menu</nav>{article}<aside>side</aside><p>four</p></article><footer>end</footer>"),
        (5, "http://c.example/", "<p>cut <b>off</b> he<a href='x"), (6, "http://d.example/", "<!-- <p>not</p> --><p>is &#x41;<!-- open"),
        (7, "http://e.example/", "<nav><a href=/>only a menu</a></nav>"), (None, "http://f.example/", "<div>" * 5000 + "deep" + "</div>" * 5000),
        (8, "http://g.example/", "<main>" + "<p>many</p><div>boxes</div>" * 3000 + "</main>"), (9, "HTTP://G.example", "<a <b <p>a < b</p>"),
    ]
    pages = spark.createDataFrame(rows, PAGES)
    found = wrappers.extract(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.count() == len(rows)
    texts = {r["page_id"]: r["text"] for r in found.collect()}
    assert texts[1] == texts[2] == texts[7] == "" and texts[3] == "plain é text" and texts[5] == "cut off he" and texts[6] == "is A"
    assert texts[4] == "A&B\none two <x> three\nx\ny\nfour" and texts[None] == "deep"
    assert texts[8] == "\n".join(["many", "boxes"] * 3000) and texts[9].endswith("a < b")
    clashing = pages.selectExpr("*", "1 AS grp", "2 AS _host", "3 AS text", "4 AS wrapper", "5 AS tree")
    assert tuples(wrappers.extract(clashing)) == tuples(found)
    assert wrappers.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_a_page_takes_time_in_proportion():
    for html in ("<a " * 100_000, "<p>x" * 50_000, "<div><p>y</div>" * 20_000, "<" * 200_000, "<b><p>" * 20_000, "&amp" * 100_000):
        page = wrappers.Page(html)
        wrappers.main_text(page, None)
        assert len(page.nodes()) <= wrappers.MAX_NODES


def test_tree_matching_keeps_ancestors_and_order():
    tree = lambda html: wrappers.packed(wrappers.Page(html).root)
    a = tree("<div class=a>1</div><ul><li>2</ul><div class=b><nav>3</nav>4</div>")
    b = tree("<ul><li>9</ul><div class=a>8</div><div class=b>7<nav>6</nav></div>")
    labels = sorted(x[wrappers.LABEL] for x, _ in wrappers.matched(a, b))
    assert all(x[wrappers.LABEL] == y[wrappers.LABEL] for x, y in wrappers.matched(a, b))
    assert labels.count("div.b") == 1 and labels.count("div.a") + labels.count("ul") == 1 and "body" in labels
