"""Main text of pages, by site style trees.

The pages of a host share templates.  Every element that directly holds text
is a node of its host's style tree: the path of tags and classes down to it.
All pages of a host are merged into the tree, and a node's importance is one
minus the mean normalised entropy of its texts over the host's distinct
pages: a text that comes with every page adds nothing (importance 0), texts
that differ from page to page are content (importance 1).  Branches below
:data:`LEAST_IMPORTANCE` on hosts with at least :data:`LEAST_PAGES` distinct
pages are removed.  In the other nodes each text is judged by itself, on the
same scale: one minus log(pages with it) / log(pages of the node).  A style tree
cuts a branch when every node in it is unimportant, so a text goes exactly if its
own node is; the presentation nodes of the dealt method (entropy of the child
style sequences, importance summed up over a branch) can keep a branch whole but
no text in it, and are not computed.  What an element announces about itself
counts first: menus, forms, adverts, comments, hidden elements and the like go by
tag, role, class or style, and an
article's plain paragraphs, headings and lists stay, so that copies of one
article do not make it look like a template; only a text repeated in a node of
importance :data:`SURE_IMPORTANCE` or more goes there too.  A class or id counts
if what it names is noise (``user-comments``, ``main-menu``, ``siteNav``,
``commentlist``, not ``has-sidebar``); an
outermost article or main element inside an element that is noise by its
class, id or as a form is content all the same, unless comments or adverts
enclose it or the page has an article outside.

Each page is parsed once, into a stored row of its blocks.  Text counts are
summed by Spark per (host, node, text) and stored once, so a host with a third of all pages is
reduced map-side; the removable nodes and texts are joined to the blocks of the
pages (by a broadcast while they are few, counted, else by a shuffle), and a page
gets the places of its own blocks that go.

Defined cases: null and empty html give empty text; pages without ``://`` in
a null or odd URL share the host ''; html that breaks off is closed at its
end, a quote inside an unquoted attribute is part of it; long pages are parsed
whole; repeated rows are pages of their own but count once in the tree; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm import common

LEAST_IMPORTANCE = 0.2
LEAST_PAGES = 5
#: A node of this importance is no copy of one article: texts that come with
#: every page are template even among an article's plain paragraphs.
SURE_IMPORTANCE = 0.5
BROADCAST_ROWS = 100_000

# HTML elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg textarea select title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body head html".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol menu dl table body article section div main".split())
NOISE_TAGS = frozenset("nav aside form button fieldset dialog menu head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Words in classes and ids of elements beside the content.
NOISE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notices overlay pager pagination popup promo promoted related reply replies respond share sharing sidebar "
    "signup social sponsor sponsored subscribe toolbar topbar widget widgets".split())
#: Words that also make a whole article noise.
NOISE_ARTICLES = frozenset("comment comments reply replies ad ads advert sponsored promo".split())
#: Words that make what they enclose noise, articles too.
NOISE_ENCLOSING = NOISE_ARTICLES | frozenset("adsense adverts advertisement advertising promoted sponsor disqus respond".split())
#: Words that leave a compound class (site-footer, navigation-main) what its
#: other words say.
NEUTRAL = frozenset("left right top bottom site page main user global google bar box block list item area inner outer "
                    "container wrapper wrap slot unit section".split())
#: Words that make a compound class (has-sidebar) say something else.
NEGATING = frozenset("has have with without no not is hide toggle content layout text body".split())
#: Noise of an element: none, by a form around it, by the words of a class or
#: id, for certain.  An article or main text is reset from the middle two.
CLEAN, IN_FORM, BY_WORD, CERTAIN = range(4)
FORMS = frozenset("form fieldset".split())
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li td th dd dt article main".split())

# Quotes count at the begin of a value only.
_VALUE = r"""\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)"""
_TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^\s/>=]++(?:{_VALUE})?+|[\s/=])*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s/=]|$)", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_CASED = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_COMPOUND = re.compile("(?:" + "|".join(sorted((w for w in NOISE_WORDS | NEUTRAL if len(w) > 2), key=len, reverse=True)) + ")+")
_PIECE = re.compile("|".join(sorted((w for w in NOISE_WORDS | NEUTRAL if len(w) > 2), key=len, reverse=True)))


class Block:
    """A run of text in one block: its text, style path, noise (as above),
    whether it is in an article (1: one inside an element that is noise by its
    words, else 2), and whether it is plain."""
    __slots__ = ("path", "text", "noise", "article", "plain")

    def __init__(self, path, text, noise, article, plain):
        self.path, self.text, self.noise, self.article, self.plain = path, text, noise, article, plain


def _words_of(name: str) -> list[str]:
    """The words of a class or id: parts in camelCase, and parts that are made
    up of known words (commentlist)."""
    out = []
    for part in _CASED.findall(name):
        part = part.lower()
        if part not in NOISE_WORDS and part not in NOISE_ENCLOSING and part not in NEUTRAL and _COMPOUND.fullmatch(part):
            out += _PIECE.findall(part)
        else:
            out.append(part)
    return [w for w in out if len(w) > 1]


def _noise_words(named: str) -> set[str]:
    """The noise words among classes and ids.  A name is noise if the last of
    its words that is not neutral is (``user-comments``, ``page-header``), or all
    of them are; a negating word (``has-sidebar``) makes it none."""
    noise, out = NOISE_WORDS | NOISE_ENCLOSING, set()
    for name in named.split():
        words = [w for w in _words_of(name) if w not in NEUTRAL]
        if words and words[-1] in noise and not NEGATING & set(words):
            out |= noise & set(words)
    return out


def _element(tag: str, attributes: str, parent: tuple) -> tuple:
    """(tag, path, noise, in article, plain, is root of an article)"""
    _, path, noise, article, _, _ = parent
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
    named = f"{values.get('class', '')} {values.get('id', '')}"
    words = _noise_words(named) if named != " " else set()
    role = values.get("role", "").lower()
    root = not article and (tag in ("article", "main") or role == "main" or values.get("itemprop", "").lower() == "articlebody")
    hidden = (bool(_HIDDEN.search(attributes)) and values.get("hidden", "").lower() != "until-found"
              or "style" in values and bool(_UNSEEN.search(values["style"])))
    own = CLEAN
    if tag == "article" or root:
        if words & NOISE_ARTICLES or hidden:
            own = CERTAIN
    elif tag not in ("html", "body"):
        if (tag in NOISE_TAGS - FORMS or role in NOISE_ROLES - FORMS or words & NOISE_ENCLOSING
                or tag == "footer" or (tag == "header" and not article) or hidden):
            own = CERTAIN
        elif words & NOISE_WORDS and not (article and words == {"header"}):
            own = BY_WORD
        elif tag in FORMS or role in FORMS:
            own = IN_FORM
    inside = article or ((1 if noise == BY_WORD else 2) if root and max(own, noise if noise == CERTAIN else CLEAN) == CLEAN else 0)
    noise = own if root and noise < CERTAIN else max(noise, own)
    path = f"{path}/{tag}" + ("." + ".".join(sorted(values["class"].split())) if values.get("class") else "")
    return tag, path, noise, inside, tag in PLAIN and not _WORD.search(named), root


def blocks(html: str) -> Iterator[Block]:
    """The text blocks of a page in order."""
    stack = [("", "", CLEAN, 0, False, False)]
    text: list[str] = []
    owner = stack[0]
    pos, end = 0, len(html)

    def flush() -> Iterator[Block]:
        nonlocal text
        joined = " ".join(entities.unescape("".join(text)).split())
        text = []
        if joined:
            yield Block(owner[1], joined, owner[2], owner[3], owner[4])

    def holder() -> tuple:
        # The innermost block element; inline noise within is left out below.
        return next((e for e in reversed(stack) if e[0] in BLOCK or not e[0]), stack[0])

    while pos < end:
        m = _TOKEN.search(html, pos)
        piece = html[pos:m.start() if m else end]
        if piece and (stack[-1][2] <= holder()[2]):
            if not text:
                owner = holder()
            text.append(piece)
        if not m:
            break
        pos = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            at = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if tag in BLOCK and (at or tag == "p"):
                yield from flush()
            if at:
                del stack[at:]
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, pos)
            if not m[3].endswith("/"):
                pos = close.end() if close else (end if tag in ("script", "style") else pos)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            yield from flush()
            if tag in CLOSES_P:
                at = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] in ("p", "article", "body", "div", "section", "td", "li")), 0)
                if at and stack[at][0] == "p":
                    del stack[at:]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in SIBLINGS.get(tag, ()):
                    del stack[k:]
                    break
                if stack[k][0] in SCOPE:
                    break
        if tag not in VOID:
            stack.append(_element(tag, m[3], stack[-1]))
    yield from flush()


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _candidates(every: list[Block]) -> list[Block]:
    """The blocks that are no noise.  A form that holds more text than the
    rest of the page is a wrapper around it."""
    size = [sum(len(b.text) for b in every if b.noise == kind) for kind in (CLEAN, IN_FORM)]
    return [b for b in every if b.noise == CLEAN or (b.noise == IN_FORM and size[IN_FORM] > size[CLEAN])]


def _parsed(batches):
    """(row, page_id, url, host, html) -> the first four, a hash of the page,
    and its candidate blocks as arrays of equal length: node (hash of the path),
    text hash, ``main`` (belongs to the main text unless the tree says no),
    ``exempt`` (an article's plain block) and, where ``main``, the text."""
    for batch in batches:
        columns = [[] for _ in range(6)]
        for html in batch.column("html").to_pylist():
            every = list(blocks(html or ""))
            found = _candidates(every)
            inside = max((b.article for b in found), default=0)
            nodes, hashes = [_hash(b.path) for b in found], [_hash(b.text) for b in found]
            main = [not inside or b.article == inside for b in found]
            page = _hash(repr([(_hash(b.path), _hash(b.text)) for b in every] if len(found) < len(every) else list(zip(nodes, hashes))))
            row = (page, nodes, hashes, main, [bool(b.article and b.plain) for b in found], [b.text if m else None for b, m in zip(found, main)])
            for column, value in zip(columns, row):
                column.append(value)
        types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.bool_()), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("row", "page_id", "url", "host")] + [pa.array(c, t) for c, t in zip(columns, types)],
            names=["row", "page_id", "url", "host", "page", "nodes", "hashes", "main", "exempt", "texts"])


def parsed(pages: DataFrame) -> DataFrame:
    """One stored row per page: its blocks (see :func:`_parsed`)."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).alias("host"),
                        F.col("html").cast("string").alias("html"))
    return common.stored(rows.mapInArrow(
        _parsed, "row long, page_id long, url string, host string, page long, nodes array<bigint>, hashes array<bigint>, "
                 "main array<boolean>, exempt array<boolean>, texts array<string>"), "parsed-pages")


def node_texts(done: DataFrame) -> DataFrame:
    """``host``, ``page``, ``node``, ``text`` (hash) of the blocks that the tree
    is built from; repeats included."""
    each = done.select("host", "page", F.explode(F.arrays_zip("nodes", "hashes")).alias("b"))
    return each.select("host", "page", F.col("b.nodes").alias("node"), F.col("b.hashes").alias("text"))


def text_counts(seen: DataFrame) -> DataFrame:
    """``host``, ``node``, ``text``, ``n`` of :func:`node_texts`; stored: on how
    many distinct pages the node has the text, and where ``text`` is null, on how
    many it has any."""
    rows = seen.count()
    # A node's texts on one page are one row: its pages need no grouping of their own.
    per_page = common.few(seen.groupBy("host", "page", "node").agg(F.collect_set("text").alias("texts")), rows)
    each = per_page.select("host", "node", F.explode(F.concat(F.array(F.lit(None).cast("long")), "texts")).alias("text"))
    return common.stored(common.few(each.groupBy("host", "node", "text").agg(F.count("*").alias("n")), rows), "text-counts")


def _nodes(counts: DataFrame) -> DataFrame:
    """``host``, ``node``, ``pages``, ``importance`` of :func:`text_counts`."""
    n = F.when(F.col("text").isNotNull(), F.col("n"))
    spread = counts.groupBy("host", "node").agg(
        F.max(F.when(F.col("text").isNull(), F.col("n"))).alias("pages"), F.sum(n * F.log(n)).alias("e"), F.sum(n).alias("all"))
    # Mean over occurrences of log(pages with the text) / log(pages).
    entropy = F.when(F.col("pages") > 1, F.col("e") / F.col("all") / F.log("pages")).otherwise(0.0)
    return spread.select("host", "node", "pages", (1 - entropy).alias("importance"))


def importance(seen: DataFrame) -> DataFrame:
    """``host``, ``node``, ``pages``, ``importance`` of :func:`node_texts`."""
    return _nodes(text_counts(seen))


def repeated_texts(counts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``host``, ``node``, ``text``, ``sure``: texts that come with so many of
    their node's pages that their own importance is low though the node's is
    not; ``sure`` where the node's other texts differ from page to page."""
    least = math.ceil(LEAST_PAGES ** (1 - LEAST_IMPORTANCE))
    counted = counts.where(F.col("text").isNotNull() & (F.col("n") >= least))
    return (counted.join(nodes.where((F.col("pages") >= LEAST_PAGES) & (F.col("importance") >= LEAST_IMPORTANCE)), ["host", "node"])
            .where(1 - F.log("n") / F.log("pages") < LEAST_IMPORTANCE)
            .select("host", "node", "text", (F.col("importance") >= SURE_IMPORTANCE).alias("sure")))


def template(counts: DataFrame) -> DataFrame:
    """The :func:`repeated_texts`, and the unimportant nodes with a null ``text``;
    stored."""
    nodes = _nodes(counts)
    low = (nodes.where((F.col("pages") >= LEAST_PAGES) & (F.col("importance") < LEAST_IMPORTANCE))
           .select("host", "node", F.lit(None).cast("long").alias("text"), F.lit(None).cast("boolean").alias("sure")))
    return common.stored(common.few(low.unionByName(repeated_texts(counts, nodes)), counts.count()), "template")


def main_text(html: str | None, low: frozenset[int], repeated: dict[tuple[int, int], bool] | None = None) -> str:
    """The blocks of one page that belong to its main text.  ``low``: nodes,
    ``repeated``: (node, text) -> sure."""
    found = _candidates(list(blocks(html or "")))
    inside = max((b.article for b in found), default=0)
    if inside:
        found = [b for b in found if b.article == inside]

    def stays(b: Block) -> bool:
        exempt, node = b.article and b.plain, _hash(b.path) if low or repeated else 0
        if low and not exempt and node in low:
            return False
        sure = repeated.get((node, _hash(b.text))) if repeated else None
        return sure is None or bool(exempt and not sure)

    return "\n\n".join(b.text for b in found if stays(b))


def removals(done: DataFrame, gone: DataFrame) -> DataFrame:
    """``row`` and ``drop``, the places of the blocks that go, of every page that
    loses some: blocks of unimportant nodes and texts (:func:`template`), but for
    an article's plain ones, which go with sure texts only."""
    each = done.select("row", "host", F.posexplode(F.arrays_zip("nodes", "hashes", "main", "exempt")).alias("at", "b"))
    each = (each.select("row", "host", "at", F.col("b.nodes").alias("node"), F.col("b.hashes").alias("text"),
                        F.col("b.main").alias("main"), F.col("b.exempt").alias("exempt")).where("main").drop("main"))
    low, repeated = gone.where("text is null").select("host", "node"), gone.where("text is not null")
    by_node = each.where("not exempt").join(common.fit_to_broadcast(low, BROADCAST_ROWS), ["host", "node"]).select("row", "at")
    by_text = (each.join(common.fit_to_broadcast(repeated, BROADCAST_ROWS), ["host", "node", "text"])
               .where("sure or not exempt").select("row", "at"))
    # At most the blocks of one page in a group.
    return by_node.unionByName(by_text).groupBy("row").agg(F.collect_set("at").alias("drop"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and the main ``text`` of every page."""
    done = parsed(pages)
    gone = removals(done, template(text_counts(node_texts(done))))
    gone = common.stored(common.few(gone, done.count()), "removals")
    left = done.select("row", "page_id", "url", "main", "texts").join(common.fit_to_broadcast(gone, BROADCAST_ROWS), "row", "left")
    stays = lambda t, i: F.get("main", i) & (F.col("drop").isNull() | ~F.array_contains("drop", i))
    return left.select("page_id", "url", F.array_join(F.filter("texts", stays), "\n\n").alias("text"))
