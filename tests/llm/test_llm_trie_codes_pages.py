"""The conversation trie, vector codes and page text against brute force and on odd rows."""

import hashlib
import html
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from gistlet.llm import hosttext, prefixtrie, vectorcodes

EXTRA = ("h", "conv", "pos", "k", "at", "d", "p", "w", "id", "label2", "v", "n", "row", "begin", "text2", "of")


def clashing(df):
    return df.select("*", *[F.lit("clash").alias(c) for c in EXTRA if c not in df.columns])


# ------------------------------------------------------------------ trie

def trie_by_hand(rows):
    """Every prefix of every rebuilt conversation in a dictionary."""
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own.setdefault(c, []).append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest(), (r, x)))
    own = {c: [e[3] for e in sorted(turns, key=lambda e: e[:3])] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        skip = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(math.fmod(c, 100)), [])[:skip] + turns[skip:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, sums, out = {}, {}, set()
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        below = [sums[x] for x in kids.get(node, [])]
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        sums[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
        ended = ",".join(str(c) for c in sorted(members[node]) if len(built[c]) == len(node))
        out.add((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                 len(kids.get(node, [])), *sums[node], hashlib.sha256(ended.encode()).hexdigest()))
    return out


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def both(df):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r) for r in prefixtrie.conversation_trie(df).collect()]
    assert len(got) == len(set(got))
    assert set(got) == trie_by_hand(rows)
    return got


def test_trie_of_odd_conversations(spark):
    rng = random.Random(3)
    rows = []
    for c in range(-120, 230):
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None, "é"])))
    rows += [(100, t, "user", f"x{t % 3}") for t in range(150)]         # more turns than one block folds
    rows += [(9_000_000_000, t, "u", "y") for t in range(64)] + [(9_000_000_001, t, "u", "y") for t in range(64)]
    rows += [(None, 1, "user", "of no conversation"), (7, 3, "user", "twice"), (7, 3, "user", "twice")]
    rows += [(12, 1, "u", "long " * 20_000)]
    both(clashing(conversations(spark, rows)).repartition(4))


def test_trie_of_the_table(spark):
    both(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"))


def test_trie_without_turns(spark):
    assert prefixtrie.conversation_trie(conversations(spark, [])).collect() == []
    # only conversations whose turns all fall away: the root alone
    gone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    got = both(conversations(spark, [(gone, 0, "u", "x")]))
    assert [r[:7] for r in got] == [(gone, 0, None, 1, 0, 1, 0)]


def test_many_copies_are_one_sequence(spark):
    rows = [(c, t, "u", f"turn {t}") for c in range(0, 60_000, 100) for t in range(3)]
    got = both(conversations(spark, rows))
    assert max(r[3] for r in got) == 600


# ------------------------------------------------------------------ codes

def codes_by_hand(rows):
    kept = sorted(((i, lab, v) for i, lab, v in rows if v and all(x is not None and math.isfinite(x) for x in v)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    x = np.array([[math.floor(1024 * c) for c in v] for _, _, v in kept], np.int64)
    books, out = [], []
    for part in np.split(x, 4, axis=1):
        book = part[:256].copy()
        for step in range(5):
            gap = ((part[:, None, :] - book[None]) ** 2).sum(2)
            near = gap.argmin(1)
            for e in range(len(book)):
                if step < 4 and (near == e).any():
                    book[e] = part[near == e].sum(0) // (near == e).sum()
        books.append(book)
        out.append((near, gap.min(1)))
    sha = hashlib.sha256(",".join(str(z) for b in books for z in b.ravel().tolist()).encode()).hexdigest()
    error = sum(e for _, e in out)
    by_label = {}
    for (_, lab, _), e in zip(kept, error, strict=True):
        by_label[lab] = by_label.get(lab, 0) + int(e)
    return sorted(((i, "".join(f"{near[n]:02x}" for near, _ in out), int(error[n]), by_label[lab], sha)
                   for n, (i, lab, _) in enumerate(kept)), key=str)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")


def code_rows(df, **how):
    return sorted((tuple(r) for r in vectorcodes.vector_codes(df, **how).collect()), key=str)


def test_codes_of_odd_vectors(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([0, 1, None]), [rng.choice([0.0, 0.1, -0.25, 0.5]) for _ in range(8)]) for i in range(600)]
    rows += [(5, 1, [0.1] * 8), (None, 2, [0.2] * 8)] + [(1000 + i, 3, [0.75] * 8) for i in range(400)]      # ties and copies
    bad = [(1, 1, None), (2, 1, [0.1, None] + [0.0] * 6), (3, 1, [float("nan")] * 8), (4, 1, [float("inf")] * 8), (6, 1, []),
           (700, 1, [0.5] * 4)]
    df = clashing(vectors(spark, rows + bad)).repartition(3)
    want = codes_by_hand([(r.vec_id, r.label, r.embedding) for r in vectors(spark, rows).collect()])
    assert code_rows(df) == want
    assert code_rows(df, labels=0) == want


def test_codes_of_the_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    assert code_rows(df) == codes_by_hand([(r.vec_id, r.label, r.embedding) for r in df.collect()])


def test_codes_of_few_vectors(spark):
    assert code_rows(vectors(spark, [])) == []
    assert [r[:3] for r in code_rows(vectors(spark, [(2, None, [1.0] * 4), (1, 0, [0.5] * 4)]))] == [(1, "00000000", 0), (2, "01010101", 0)]


@pytest.mark.parametrize("size", [1, 2, 33, 700])
@pytest.mark.parametrize("spread", [3, 1000, 1 << 26])
def test_both_trees_find_the_nearest(size, spread):
    rng = np.random.default_rng(size + spread)
    x = rng.integers(-spread, spread, (size, 5)) // rng.integers(1, 4) * 2
    book = vectorcodes.Codebook(rng.integers(-spread, spread, (min(size, 40), 5)))
    gap = ((x[:, None, :] - book.entries[None]) ** 2).sum(2)
    x = x[(order := vectorcodes.tree_order(x, vectorcodes.LEAF))]
    near, least = book.codes(x)
    assert (near == gap.argmin(1)[order]).all() and (least == gap.min(1)[order]).all()
    n, s = book.tallies(x)
    assert (n == np.bincount(near, minlength=len(n))).all()
    assert all((s[e] == x[near == e].sum(0)).all() for e in range(len(n)))


def test_clusters_are_assigned_whole():
    x = np.repeat(np.array([[0, 0], [1000, 1000]]), 200, axis=0) + np.random.default_rng(0).integers(0, 5, (400, 2))
    book = vectorcodes.Codebook(np.array([[0, 0], [1000, 1000]]))
    x = x[vectorcodes.tree_order(x, vectorcodes.LEAF)]
    whole, leaves = vectorcodes.dual(vectorcodes.Tree(x, vectorcodes.LEAF), book.tree, book.names)
    assert not leaves and sorted((b - a, e) for a, b, e in whole) == [(200, 0), (200, 1)]


def test_a_component_beyond_64_bits_raises(spark):
    with pytest.raises(Exception, match="too large"):
        code_rows(vectors(spark, [(1, 0, [1e30] * 4)]))


# ------------------------------------------------------------------ pages

def page_rows(df, **how):
    return sorted(tuple(r) for r in hosttext.main_text(df, **how).select("page_id", "url", "text", "n_chars").collect())


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def article_by_hand(text):
    inside = re.search(r"<article>(.*?)</article>", text, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", inside))).split())


def test_text_of_the_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    want = sorted((r.page_id, r.url, article_by_hand(r.html), len(article_by_hand(r.html))) for r in df.collect())
    assert page_rows(df) == want
    assert page_rows(df, held=0) == want


SOUP = ("<body><div>Home</div><div>News</div><div>About our paper</div><div>{}</div><div>{}</div>"
        "<div>Read more stories like this one every day</div></body>")


def test_repeats_of_a_host_go(spark):
    rows = [(i, f"http://a.org/{i}", SOUP.format(f"Story {i} of the day", f"It went on and on {i} times")) for i in range(3)]
    rows += [(9, "http://b.org/9", SOUP.format("Another host", "keeps all of it"))]
    rows += [(8, "http://A.org/8", rows[0][2]), (7, "http://b.org/7", None), (6, None, "plain &amp; simple"), (5, "no host", "")]
    df = clashing(pages(spark, rows + [rows[0]])).repartition(3)
    for held in (0, 100):
        got = {r[0]: r[2] for r in page_rows(df, held=held)}
        assert got[0] == got[8] == "Story 0 of the day It went on and on 0 times"
        assert got[1] == "Story 1 of the day It went on and on 1 times"
        assert got[9] == "Home News About our paper Another host keeps all of it Read more stories like this one every day"
        assert (got[7], got[6], got[5]) == ("", "plain & simple", "")
        assert len(page_rows(df, held=held)) == len(rows) + 1
    assert page_rows(pages(spark, [])) == []


def test_copied_articles_stay_and_mirrors_do_not_erase_each_other(spark):
    body = "<nav><a>Menu of many words here</a></nav><article><p>Same words in both of the articles.</article><footer>Bye {}</footer>"
    plain = "<div>Only text of a page that is mirrored.</div>"
    rows = [(1, "http://a.org/1", body.format(1)), (2, "http://a.org/2", body.format(2)), (3, "http://a.org/3", plain),
            (4, "http://a.org/4", plain)]
    got = [r[2] for r in page_rows(pages(spark, rows))]
    assert got == ["Same words in both of the articles."] * 2 + ["Only text of a page that is mirrored."] * 2


@pytest.mark.parametrize("source, text", [
    ("<p>a<b>b</b>c<br>d</p>e", "abc d e"),
    ("<article><header><h1>T</h1></header><p>x<aside>y</aside>z</article><header>no</header>", "T x z"),
    ("<script>if (a < b) '</p>'</script><style>p{}</style>x<!-- <p>no --> y", "x y"),
    ("<div class='post-comments'>no<div>no</div>no</div><p class=\"ad\">no<p>yes <span hidden>no</span> &lt;b&gt;", "yes <b>"),
    ("<div class='has-sidebar'><div id=sidebar>no</div>yes</div>", "yes"),
    ("<main role=main>in <form>no</form> <section id='commentList'>no</section></main><div role='contentinfo'>no</div>", "in"),
    ('<a title="x > y">link</a> 1 < 2 </> &nbsp;&copy;&am', "link 1 < 2 ©&am"),
    ("<ul class=menu><li>no<ul><li>no</ul>no</ul><p>yes", "yes"),
    ("<title>no</title>cut <script>never closed", "cut"),
    ("x<![CDATA[no]]><?php no ?><!DOCTYPE no>y <unclosed", "xy"),
])
def test_markup(source, text):
    assert hosttext.extracted("http://h/", source, frozenset())[0] == text


def test_very_long_and_deep_pages():
    deep = "<div class='ad'>" * 20_000 + "no" + "</div>" * 20_000 + "yes"
    assert hosttext.extracted(None, deep, frozenset())[0] == "yes"
    long = "<p>" + "word " * 1_000_000
    assert len(hosttext.extracted(None, long, frozenset())[0]) == 4_999_999


def test_beginnings_have_enough_words():
    stream = ["a b", "c", "d e f g", "h"]
    found = hosttext.suffixes("x.org", stream)
    assert [n for _, n in found] == [3, 2, 1]
    assert found[2][0] == hosttext.suffixes("x.org", ["d e f g", "other"])[0][0]
    assert found[2][0] != hosttext.suffixes("y.org", ["d e f g"])[0][0]
