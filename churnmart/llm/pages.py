"""Main text of web pages with a style tree per site.

The pages of a host are merged into one tree: a node is a path of block elements with their
classes. For each node two distributions over the host's pages are counted: which child
sequences it has (presentation) and which texts (content). Their entropies, as shares of the
largest possible ones, weigh how much a node tells about a page. Branches that say almost the
same on every page of a host, while its pages differ, are cut from each page, as are elements
whose own markup names them menus, adverts, forms and the like. Of the rest the article is
taken, or everything if a page marks none.

Pages whose main blocks are equal (one article under two addresses) count as one page. The
fewer pages a node is on, the smaller its part of the host and the larger its part of the
text, the more equal pages it takes to cut it: see ``_prior``. An article, and what holds one,
is never cut; a branch inside one only if it stands on most pages of its host.

A host is never gathered: counts are partial aggregates, and pages meet the short list of
their host's unimportant nodes in a join that spreads the pages of large hosts.
"""

import html as entities
import re
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnmart.llm.common import arrow_map, id_type, slices, struct
from churnmart.operators.joins import hot_keys, salted_join
from churnmart.session import materialize

# Weight of content against presentation, and the importance, as a share of that of the whole
# page, below which a branch goes. A node counts as seen on ``PRIOR`` more pages that differ:
# little enough that a branch equal on two pages goes if these differ otherwise. More are
# added by its share of the text above ``LARGE_FROM``, and inside an article.
CONTENT_WEIGHT, UNIMPORTANT, PRIOR = 0.9, 0.1, 0.15
LARGE_FROM, LARGE_PRIOR, ARTICLE_PRIOR = 0.4, 4.0, 0.5

# Fixed values of HTML and of common class names.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NOISE_TAGS = frozenset("aside button canvas dialog footer form head label map menu nav object select".split())
_RAW = "iframe|noscript|script|style|svg|template|textarea|title"
_NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer login menu modal nav navbar navigation newsletter notice notices pager pagination popup promo recommended "
    "related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
# Names that are parts of pages in an article too; of the others the style tree decides there.
_ADVERTS = frozenset("ad ads advert adverts advertisement advertising promo sponsor sponsored".split())
_COMMENTS = frozenset("comment comments disqus".split())
_SURE_NAMES = _ADVERTS | _COMMENTS | frozenset(
    "breadcrumb breadcrumbs login modal nav navbar navigation newsletter pager pagination popup share sharing sidebar signup "
    "social subscribe toolbar".split()
)
# Words beside such a name that make it no other thing; "has" or "open" would tell a state.
_BESIDE = frozenset(
    "area bar block bottom box button buttons col column container content footer form global group head inner item items "
    "left link links list main message mobile outer page panel policy post primary right secondary section site slot text "
    "thread top unit wrap wrapper".split()
)
# Elements that no name makes noise, and those that only the name of an advert does.
_NEVER_NAMED = frozenset("article body h1 h2 h3 h4 h5 h6 html main".split())
_CONTAINERS = frozenset(
    "aside button center details dialog div dl fieldset figure footer form header menu nav ol section select table ul".split()
)
_NOISE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())
_ENDS_AT_SAME = {"li": ("li",), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
_ARTICLES = frozenset(("article", "main"))
_STOPS = frozenset("ul ol dl table tbody thead tfoot tr select menu".split())
# Elements that are nodes of the style tree.
_NODES = frozenset("article aside blockquote body details div dl figure footer form header main nav ol section table ul".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?:{_RAW})\b[^>]*(?:/>|>.*?(?:</(?:{_RAW})\s*>|\Z))"
    r"""|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>"']+|"[^"]*"|'[^']*')*+|[^>]*)>"""
    r"|<[!?/][^>]*(?:>|\Z)|<[a-z][^>]*\Z",
    re.S | re.I,
)
_NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _digest(text):
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


class _Element:
    __slots__ = ("article", "children", "content", "holds", "noise", "path", "size", "tag")

    def __init__(self, tag, path, noise, article):
        self.tag, self.path, self.noise, self.article = tag, path, noise, article
        self.children, self.content, self.size, self.holds = [], 0, 0, tag in _ARTICLES


def _named(tokens, names):
    """Whether a token is one of the names, alone or among words that only place it."""
    for token in tokens:
        parts = {p.lower() for p in _PARTS.findall(token) if not p.isdigit()}
        if not parts.isdisjoint(names) and parts <= _NOISE_NAMES | _BESIDE | names:
            return True
    return False


def _names(tag, rest, in_article):
    """(class text, whether class, id or role name noise, or a header) of the attributes of a tag.

    Only whole class and id tokens count. No name makes the page, its article or a heading
    noise, and text inside a container only that of an advert. Ids in an article often
    come from its headings: there they name adverts and comments only.
    """
    found = {"class": "", "id": "", "role": ""}
    for key, *values in _NAMED.findall(rest):
        found[key.lower()] = next((v for v in values if v), "")
    class_, id_ = found["class"].split(), found["id"].split()
    classes = ".".join(sorted(found["class"].lower().split()))
    if tag in _NEVER_NAMED:
        return classes, False, False
    if tag not in _CONTAINERS:
        noisy = _named(class_, _ADVERTS)
    elif in_article:
        noisy = _named(class_, _SURE_NAMES) or _named(id_, _ADVERTS | _COMMENTS)
    else:
        noisy = _named(class_ + id_, _NOISE_NAMES)
    noisy |= found["role"].lower() in _NOISE_ROLES
    header = tag in _CONTAINERS and _named(class_ + id_, frozenset(("header", "masthead")))
    return classes, noisy, header


def read_page(source: str, unimportant=frozenset(), nodes=None) -> str:
    """The main text of a page.

    ``nodes`` gets (path hash, children hash, content hash, characters outside noise, whether
    it is or holds an article, whether it lies in one) of each node.
    """
    digest = _digest
    root = _Element("", 0, False, False)
    stack, open_text, blocks, in_article, marked = [root], [], [], [], False
    counted = nodes is not None

    def flush():
        if open_text:
            text = " ".join(entities.unescape("".join(open_text)).split())
            open_text.clear()
            if text:
                top = stack[-1]
                if counted:
                    mark = digest(text)
                    for element in stack:
                        element.content = (element.content * 31 + mark) % (1 << 64)
                        element.size += 0 if top.noise else len(text)
                if not top.noise:
                    (in_article if top.article else blocks).append(text)

    def close(depth):
        while len(stack) > depth:
            element = stack.pop()
            if counted and element.tag in _NODES:
                nodes.append((
                    element.path, digest(" ".join(element.children)), element.content, element.size, element.holds, element.article,
                ))
            if stack:
                stack[-1].holds |= element.holds

    at = 0
    for token in _TOKEN.finditer(source):
        if token.start() > at and (counted or not stack[-1].noise):
            open_text.append(source[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                open_text.append(" ")
            continue
        block = tag in _BLOCKS
        if token["end"]:
            depth = next((n for n in range(len(stack) - 1, 0, -1) if stack[n].tag == tag), 0)
            if block:
                flush()
            if depth:
                close(depth)
            continue
        rest = token["rest"]
        classes, noisy, header = _names(tag, rest, stack[-1].article) if "=" in rest else ("", False, False)
        if not block and not noisy and tag not in _NOISE_TAGS:
            continue
        if block:
            flush()
            if stack[-1].tag == "p":
                close(len(stack) - 1)
            if tag in _ENDS_AT_SAME:
                for n in range(len(stack) - 1, 0, -1):
                    if stack[n].tag in _ENDS_AT_SAME[tag]:
                        close(n)
                        break
                    if stack[n].tag in _STOPS:
                        break
        above = stack[-1]
        name = f"{tag}.{classes}" if classes else tag
        above.children.append(name)
        path = digest(f"{above.path}/{name}") if tag in _NODES else above.path
        article = above.article or tag in _ARTICLES
        noise = (
            above.noise or noisy or tag in _NOISE_TAGS or (not above.article and (tag == "header" or header))
            or (tag in _NODES and tag not in _ARTICLES and path in unimportant)
        )
        marked |= article and not noise
        stack.append(_Element(tag, path, noise, article))
    if at < len(source) and (counted or not stack[-1].noise):
        open_text.append(source[at:])
    flush()
    close(1)
    return "\n".join(in_article if marked else blocks)


def host_of(url) -> str | None:
    try:
        return urlsplit(url).hostname if url else None
    except ValueError:
        return None


def _signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def page_mark(text: str) -> int:
    """Hash of the blocks at least half as long as the longest: short ones (a counter, a date) do not tell pages apart."""
    blocks = text.split("\n")
    least = max(map(len, blocks)) / 2
    return _digest("\n".join(b for b in blocks if len(b) >= least))


def style_nodes(pages: DataFrame) -> DataFrame:
    """One row per host, path and differing page: shape, content, share of the text, and the place to articles.

    The row with ``root`` stands for the page as a whole, against which its branches are measured.
    """
    schema = struct(
        host=T.StringType(), path=T.LongType(), root=T.BooleanType(), page=T.LongType(), shape=T.LongType(), content=T.LongType(),
        share=T.DoubleType(), holds=T.BooleanType(), inside=T.BooleanType(),
    )

    def task(batches):
        for batch in batches:
            for urls, sources in slices(batch, 64):
                rows = []
                for url, source in zip(urls, sources):
                    if not (host := host_of(url)):
                        continue
                    nodes = []
                    text = read_page(source or "", nodes=nodes)
                    mark, all_ = _signed(page_mark(text)), max(1, sum(map(len, text.split("\n"))))
                    merged = {}
                    for path, shape, content, size, holds, inside in nodes:
                        old = merged.get(path, (0, 0, 0, False, False))
                        merged[path] = (
                            (old[0] * 31 + shape) % (1 << 64), (old[1] * 31 + content) % (1 << 64),
                            old[2] + size, old[3] or holds, old[4] or inside,
                        )
                    rows.append((host, 0, True, mark, 0, mark, 1.0, True, False))
                    rows += [
                        (host, _signed(p), False, mark, _signed(s), _signed(c), min(1.0, n / all_), h, i)
                        for p, (s, c, n, h, i) in merged.items()
                    ]
                yield list(zip(*rows)) if rows else [[]] * 9

    seen = arrow_map(pages.select("url", "html"), schema, task)
    one = F.max(F.struct("shape", "content", "share", "holds", "inside")).alias("one")
    return seen.groupBy("host", "path", "root", "page").agg(one).select("host", "path", "root", "page", "one.*")


def importance(nodes: DataFrame) -> DataFrame:
    """(host, path, root, pages, importance): entropies of a node's shapes and contents.

    Of the columns share, holds and inside, where there are any, also the mean and the largest.
    """
    more = [c for c in ("share", "holds", "inside") if c in nodes.columns]

    def spread(column, others=()):
        found = [F.sum(c).alias(c) if c == "share" else F.max(c).alias(c) for c in others]
        counts = nodes.groupBy("host", "path", "root", column).agg(F.count("*").alias("n"), *found)
        return counts.groupBy("host", "path", "root").agg(
            F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("s"), *found
        ).select("host", "path", "root", "pages", *[
            (F.col(c) / F.col("pages") if c == "share" else F.col(c)).alias(c) for c in others
        ], F.when(
            F.col("pages") > 1, (F.log("pages") - F.col("s") / F.col("pages")) / F.log("pages")
        ).otherwise(1.0).alias(column))

    shape, content = spread("shape", more), spread("content").drop("pages")
    weight = F.lit(CONTENT_WEIGHT)
    return shape.join(content, ["host", "path", "root"]).select(
        "host", "path", "root", "pages", *more,
        ((1 - weight) * F.col("shape") + weight * F.col("content")).alias("importance"),
    )


def _prior():
    """On how many more, differing, pages a node counts as seen.

    Without spread, a node goes when its pages are over nine times as many: two pages for a
    small branch that all pages of a host have, ten for one that few have, twenty for one
    that is almost the whole text.
    """
    return (
        PRIOR
        + (1 - F.col("pages") / F.col("all_pages"))
        + LARGE_PRIOR * F.greatest(F.col("share") - LARGE_FROM, F.lit(0.0))
        + F.when(F.col("inside"), ARTICLE_PRIOR).otherwise(0.0)
    )


def unimportant_nodes(pages: DataFrame) -> DataFrame:
    """(host, paths): the nodes to cut from the pages of a host.

    Every node on two or more pages that differ is judged. One page of a host tells nothing.
    """
    found = materialize(importance(materialize(style_nodes(pages), "nodes")).where("pages > 1"), "importance")
    whole = found.where("root").select("host", F.col("importance").alias("whole"), F.col("pages").alias("all_pages"))
    few = (F.col("importance") * F.col("pages") + _prior()) / (F.col("pages") + _prior())
    free = ~F.col("holds") & (~F.col("inside") | (2 * F.col("pages") > F.col("all_pages")))
    low = found.where("not root").join(whole, "host").where(free & (few < UNIMPORTANT * F.col("whole")))
    return low.groupBy("host").agg(F.collect_list("path").alias("paths"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    NULL and empty pages have an empty text. Pages without a readable host are cleaned by
    their own markup alone. Rows with NULL or repeated ids stay rows of their own. Pages of
    any length are read whole. An empty table gives no rows. Columns other than page_id, url
    and html are not read.
    """
    # The host is read with the same function on both sides of the join.
    host = F.udf(host_of, "string", useArrow=True)("url")
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    # Pages of a host with more rows than a task should have are spread by their content.
    hot = hot_keys(rows.select("host"), "host")[0]
    joined = salted_join(rows, unimportant_nodes(pages), "host", F.xxhash64("url", "html"), hot=hot)
    joined = joined.select("page_id", "url", "html", "paths")
    schema = struct(page_id=id_type(pages, "page_id"), url=T.StringType(), text=T.StringType(), n_chars=T.LongType())

    def task(batches):
        for batch in batches:
            for ids, urls, sources, paths in slices(batch, 64):
                texts = [read_page(s or "", frozenset(p % (1 << 64) for p in low or ())) for s, low in zip(sources, paths)]
                yield ids, urls, texts, [len(t) for t in texts]

    return arrow_map(joined, schema, task)
