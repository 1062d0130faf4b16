"""Main text of web pages: what a host repeats goes, by the suffix array of its pages.

A page becomes a stream of tokens: one for each run of text between block tags, with the kind of
element that it stands in. The streams of a host's pages, end to end, have a suffix at each token;
sorted, two suffixes that begin alike are neighbours, and a beginning of ``LONG`` words or more that
suffixes of distinct pages share is a long repeated substring. Only that much of a suffix is needed to
decide, so the array is kept cut off at that depth: a Spark table of (host, beginning) with the least
and the greatest page that has it, in which equal beginnings have met (partial aggregation, so that
the menu of a host with a third of all pages is one row for each task). Tokens that such substrings
cover are boilerplate and are removed; unique runs are kept. Pages whose whole streams are equal count
as one page, or a mirrored page would erase its twin.

What markup declares comes before that evidence: text inside ``article`` or ``main`` is the page's own and
is kept though a copied article repeats it; scripts, styles, forms and the elements, roles and class
names of menus, headers, footers, sidebars, notices, adverts and comments go though they are unique.
Of a page with no ``article`` or ``main``, everything outside such elements is judged by repeats alone;
there, what other pages of the host quote in runs of whole blocks is taken for boilerplate.

Beginnings found on several pages are sent to the tasks as a set while there are at most ``HELD``, and are
joined to the pages beyond that; the results are equal. Null html is empty, a page without tags is one
run of text, a page without a host (null url, no ``://``) shares the host "". Rows that repeat are each
extracted. A text is only as long as its page: nothing is cut.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gistlet.llm.common import bound_batches, written

LONG = 4            # words of a repeated substring
HELD = 200_000      # beginnings of 16 bytes that are sent to the tasks

# Names of HTML, and words that name page furniture in class, id and role.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
DROPPED = frozenset("head script style title textarea iframe noembed noframes xmp noscript template svg math canvas object audio video "
                    "select button form nav footer aside dialog menu".split())
OUTER = frozenset(["header"])       # page furniture unless it is an article's own
OWN = frozenset(["article", "main"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
                   "main menu nav ol p pre section table ul".split())
FURNITURE = frozenset("ad ads adbox advert adverts advertisement advertising banner sponsor sponsored promo promotion menu navbar nav "
                      "navigation breadcrumb breadcrumbs footer sidebar aside widget widgets related recommended cookie cookies consent gdpr "
                      "notice notices popup modal overlay newsletter subscribe subscription share sharing social comment comments "
                      "disqus respond login search pagination pager toolbar topbar masthead skip".split())
OUTER_FURNITURE = frozenset(["header"])
ABOUT = frozenset("has with no without not is".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Places of a token.
MAIN, OPEN, LOST = 0, 1, 2


def _tag_end(text: str, at: int) -> int:
    """Index of the ``>`` that ends the tag at ``at``; quoted values may hold one; the length of the text if none does."""
    end = text.find(">", at)
    while end >= 0:
        piece = text[at:end]
        if piece.count('"') % 2 and text.find('"', end) >= 0:
            end = text.find(">", text.find('"', end))
        elif "='" in piece and piece.count("'") % 2 and text.find("'", end) >= 0:
            end = text.find(">", text.find("'", end))
        else:
            return end
        if end - at > 1 << 16:          # a quote that was never closed
            return text.find(">", at)
    first = text.find(">", at)
    return first if first >= 0 else len(text)


def _furniture(attributes: str, outer: bool) -> bool:
    """Whether class, id, role or hiding attributes name page furniture; ``outer``: outside an article."""
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name == "role" and value.strip().lower() in ROLES:
            return True
        if name in ("class", "id"):
            for label in value.split():
                words = {w.lower() for w in _PIECE.findall(label)}
                # "has-sidebar" speaks of a part, and is not that part
                if not words & ABOUT and (words & FURNITURE or outer and words & OUTER_FURNITURE):
                    return True
    return False


def tokens(text: str) -> list[tuple[int, str]]:
    """(place, text) of each run of text between block tags, white space as one space; empty runs are left out."""
    out: list[tuple[int, str]] = []
    held: list[str] = []                     # pieces of the run
    stack: list[tuple[str, int]] = []        # open elements that set a place, and those inside them of the same name
    place, at, n = OPEN, 0, len(text)

    def close_run() -> None:
        if held:
            # references are decided on the run's source, so that "&lt;" is never a tag
            run = " ".join(entities.unescape("".join(held)).split())
            if run:
                out.append((place, run))
            held.clear()

    def pop_to(name: str) -> int:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                del stack[i:]
                break
        return stack[-1][1] if stack else OPEN

    while at < n:
        lt = text.find("<", at)
        if lt < 0:
            held.append(text[at:])
            break
        if lt > at:
            held.append(text[at:lt])
        if text.startswith("<!--", lt):
            end = text.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if text.startswith("<![CDATA[", lt):
            end = text.find("]]>", lt)
            at = n if end < 0 else end + 3
            continue
        after = text[lt + 1:lt + 2]
        if after in ("!", "?"):
            end = text.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        closing = after == "/"
        m = _NAME.match(text, lt + 1 + closing)
        if not m:                            # a "<" that opens nothing is text
            if closing:
                end = text.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                held.append("<")
                at = lt + 1
            continue
        end = _tag_end(text, m.end())
        name, attributes = m[0].lower(), text[m.end():end]
        at = end + 1
        if name not in INLINE:
            close_run()
        if closing:
            if stack and any(s[0] == name for s in stack):
                close_run()
                place = pop_to(name)
            continue
        if name in ENDS_P and stack and stack[-1][0] == "p":
            close_run()
            stack.pop()
            place = stack[-1][1] if stack else OPEN
        if name in VOID or attributes.endswith("/") and name not in RAW:
            continue
        inner = place
        if name == "main":
            inner = MAIN
        elif place != LOST:
            if name in DROPPED or place == OPEN and name in OUTER:
                inner = LOST
            elif name in OWN:
                inner = MAIN
            elif attributes and name not in ("html", "body") and _furniture(attributes, place == OPEN):
                inner = LOST
        if inner != place or any(s[0] == name for s in stack):
            close_run()
            stack.append((name, inner))
            place = inner
        if name in RAW:                      # its text is no markup
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(text, at)
            if close is None:
                at = n
            else:
                end = text.find(">", close.end())
                at = n if end < 0 else end + 1
                place = pop_to(name)
    close_run()
    return out


def host_of(url: str | None) -> str:
    """What stands after the first ``://``, up to ``/``, ``?`` or ``#``, A-Z lower-cased."""
    _, found, rest = (url or "").partition("://")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].translate(_LOWER) if found else ""


_LOWER = {i: i + 32 for i in range(65, 91)}


def suffixes(host: str, stream: list[str], long: int = LONG) -> list[tuple[bytes, int]]:
    """For each token, the beginning of its suffix that has ``long`` words (hashed), and the tokens in it; none if it is too short."""
    sizes = [t.count(" ") + 1 for t in stream]
    out, j, words = [], 0, 0
    for i in range(len(stream)):
        if j < i:
            j, words = i, 0
        while j < len(stream) and words < long:
            words += sizes[j]
            j += 1
        if words < long:
            break
        h = hashlib.blake2b(digest_size=16)
        h.update(host.encode("utf-8", "surrogatepass"))
        for t in stream[i:j]:
            h.update(b"\0" + t.encode("utf-8", "surrogatepass"))
        out.append((h.digest(), j - i))
        words -= sizes[i]
    return out


def _stream(tokens_of: list[tuple[int, str]]) -> list[int]:
    """Places in the page of the tokens that repeats decide on: those outside the page's own text."""
    return [i for i, (place, _) in enumerate(tokens_of) if place != MAIN]


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """beginning (host included), page (hash of the stream): each once a page."""
    for b in batches:
        begins, pages = [], []
        for url, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if not text:
                continue
            all_tokens = tokens(text)
            stream = [all_tokens[i][1] for i in _stream(all_tokens)]
            found = {h for h, _ in suffixes(host_of(url), stream)}
            if found:
                whole = hashlib.blake2b("\0".join(t for _, t in all_tokens).encode("utf-8", "surrogatepass"), digest_size=8).digest()
                begins += found
                pages += [int.from_bytes(whole, "little", signed=True)] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(begins, pa.binary()), pa.array(pages, pa.int64())], names=["begin", "page"])


def extracted(url: str | None, text: str | None, repeated) -> tuple[str, int, int]:
    """Main text, tokens, and tokens that repeated beginnings cover."""
    all_tokens = tokens(text or "")
    at = _stream(all_tokens)
    gone = set()
    for i, (h, size) in enumerate(suffixes(host_of(url), [all_tokens[i][1] for i in at])):
        if h in repeated:
            gone.update(at[i:i + size])
    kept = [t for i, (place, t) in enumerate(all_tokens) if place != LOST and i not in gone]
    return " ".join(kept), len(all_tokens), len(gone)


OUT = "page_id long, url string, text string, n_chars long, n_runs long, n_repeated long"


def _out(ids: list, urls: list, rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
    texts = [r[0] for r in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()),
         pa.array([len(t) for t in texts], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.int64())], names=[c.split()[0] for c in OUT.split(", ")])


def main_text(pages: DataFrame, held: int = HELD) -> DataFrame:
    """page_id, url, text, n_chars, n_runs (runs of text found) and n_repeated (those covered by repeats) of every page."""
    spark = pages.sparkSession
    bound_batches(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    array = rows.select("url", "html").mapInArrow(_beginnings, "begin binary, page long")
    # the suffix array at the depth of LONG words: equal beginnings are neighbours, and have met here
    common = written(array.groupBy("begin").agg(F.min("page").alias("lo"), F.max("page").alias("hi"))
                     .where("lo < hi").select("begin"), "repeated")
    if common.count() <= held:
        sent = spark.sparkContext.broadcast(frozenset(bytes(r[0]) for r in common.toLocalIterator()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids, urls, texts = (b.column(i).to_pylist() for i in range(3))
                yield _out(ids, urls, [extracted(u, t, sent.value) for u, t in zip(urls, texts, strict=True)])

        return rows.mapInArrow(run, OUT)

    # more of them than a task should hold: each page meets its own, by the hash of its row (equal rows have equal ones)
    key = F.sha2(F.concat(F.coalesce("url", F.lit("")), F.lit("\n"), F.coalesce("html", F.lit(""))), 256)
    keyed = rows.withColumn("row", F.unhex(key))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for url, text, row in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                found = tokens(text or "")
                out += {(row, h) for h, _ in suffixes(host_of(url), [found[i][1] for i in _stream(found)])}
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in out], pa.binary()), pa.array([h for _, h in out], pa.binary())],
                                             names=["of", "start"])

    starts = written(keyed.select("url", "html", "row").mapInArrow(own, "of binary, start binary").distinct(), "starts")
    hits = starts.join(common, starts.start == common.begin).groupBy("of").agg(F.collect_set("start").alias("starts"))
    hits = written(hits, "hits")             # a page's own beginnings: no more than its tokens
    both = keyed.join(hits, keyed.row == hits.of, "left").select("page_id", "url", "html", "starts")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, urls, texts, found = (b.column(i).to_pylist() for i in range(4))
            yield _out(ids, urls, [extracted(u, t, frozenset(s or ())) for u, t, s in zip(urls, texts, found, strict=True)])

    return both.mapInArrow(joined, OUT)
