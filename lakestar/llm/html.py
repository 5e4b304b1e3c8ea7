"""Main text of web pages, by a template deduced from the pages of a host.

1. Each page becomes a sequence of tokens: its container tags, named by the path to them, and its texts
   outside an article, named by path and content. Pages of a host with equal content (their article, or
   else their texts without furniture) count once. Over the pages of a host, and over those of each of its
   layouts (equal paths of boxes), a token has an occurrence vector: how often each page has it. Vectors
   are compared by a digest that is summed up in any order, so a host of any size is an aggregate.
2. Tokens with equal vectors form a class. Classes that are large (`LARGE` tokens) and frequent (half of
   the pages of the host or of the layout, three at least) make the template: what pages are filled into.
   Their mean places order them; paths nest them. What lies between template tokens is a slot.
3. A page is matched with the template of its host and layout, token by token, in order. The text of the slots is kept
   where the elements around it are not furniture (menus, headers, footers, sidebars, notices, adverts,
   forms, scripts, styles, comments), by tag or by a whole value of class, id or role. Marks on what holds the
   page's article do not count. If the page marks its article, that is the slot that counts, whole;
   else texts that belong to the template are furniture too.

Templates meet pages by host and a salt, so a host with a third of all pages is spread over tasks. A row
carries the templates of all layouts of its host. Near copies with different texts count each.

White space inside a block becomes one space; blocks are joined in page order by one space. Line breaks
and tags other than inline ones separate blocks.

Defined results: null or empty html has the empty text. A page without a url, or of a host with too few
pages, has no template; its text is judged by the elements alone. Repeated rows have equal results.
Unclosed and unmatched tags are tolerated. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens of a large class; pages that a class is in at least, and their share of the host's.
LARGE, FEWEST, SHARE = 3, 3, 0.5
#: What tells layouts apart: tags of boxes, down to a depth.
BOXES = frozenset("html body div section main article header footer nav aside form table".split())
DEPTH = 6
SALTS = 64

INLINE = frozenset(
    "a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr math mi mn mo mrow ms msub msubsup msup mtext object semantics svg".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe textarea title".split())
#: Furniture whatever it holds. A form may be a page's wrapper.
NEVER = frozenset("nav aside footer button dialog menu select template annotation".split())
FURNITURE = NEVER | {"form"}
ARTICLE = frozenset("article main".split())
#: Values of class, id and role that mark furniture, alone or joined to each other and to words of place.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense alert banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies disqus footer form gdpr header login masthead menu modal nav "
    "navbar navigation newsletter notice notices pagination popup promo promoted promotion related replies reply "
    "search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
PLACES = frozenset(
    "site page global top bottom left right primary secondary box bar list container wrapper wrap section area block x".split()
)
MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S
)
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")


@lru_cache(1 << 16)
def _marks(names: tuple[str, ...], article: bool) -> bool:
    """Whether a value of class, id or role marks furniture; `article`: a header is none there."""
    for value in {v for name in names for v in name.split()}:
        found = WORDS.findall(value)
        if all(w in MARKS or w in PLACES for w in found) and any(w in MARKS and not (article and w == "header") for w in found):
            return True
    return False


class Element:
    """`root` is the article that an element is in, `below` whether it is furniture of that; `furniture` also
    counts what the article is in. `mark` is the furniture nearest above,
    `hidden` whether some of that is never a wrapper."""

    __slots__ = ("tag", "path", "furniture", "article", "root", "below", "mark", "hidden")

    def __init__(self, tag: str, above: Element | None, names: list[str]):
        self.tag = tag
        label = tag if not names else f"{tag}.{'.'.join(names)}"
        inline = tag in INLINE
        self.path = above.path if above and inline else f"{above.path if above else ''}/{label}"
        root = above.root if above else None
        fresh = tag in ARTICLE and (root is None or tag == "article" and root.tag == "main")
        self.root = self if fresh else root
        self.article = self.root is not None
        own = tag in FURNITURE or (tag == "header" and not self.article)
        exempt = fresh or tag in ("html", "body", "main")
        own = own or bool(names) and not exempt and _marks(tuple(names), self.article)
        self.furniture = own or bool(above and above.furniture)
        self.below = not fresh and (own or bool(above and above.below))
        self.hidden = tag in NEVER or bool(above and above.hidden)
        self.mark = self if own else above.mark if above else None


def parse(page: str) -> Iterator[tuple[str, Element | None, str]]:
    """The page in order: ("tag", element, ""), ("text", element, text) and ("break", element, "")."""
    stack: list[Element] = []
    at, size = 0, len(page)
    while at < size:
        found = MARKUP.search(page, at)
        begin = found.start() if found else size
        if begin > at:
            yield "text", stack[-1] if stack else None, unescape(page[at:begin])
        if not found:
            return
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            if tag not in INLINE:
                yield "break", stack[-1] if stack else None, ""
            continue
        if tag not in INLINE:
            yield "break", stack[-1] if stack else None, ""
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close and not found[3].endswith("/") else at if found[3].endswith("/") else size
            continue
        if tag in VOID or found[3].endswith("/"):
            continue
        if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option"):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag not in INLINE and stack[i].tag != "p":
                    break
        names = [(a or b or c).strip().lower() for _, a, b, c in NAMES.findall(found[3])] if found[3] else []
        element = Element(tag, stack[-1] if stack else None, names)
        stack.append(element)
        if tag not in INLINE:
            yield "tag", element, ""


def nodes(page: str) -> tuple[list[tuple[str, Element | None, str]], set[Element]]:
    """The parsed page, and its articles that stay although a mark or a form is around them: where no article
    is free of marks, the one with the most text and those under the same mark, if other free text is less."""
    found = list(parse(page))
    size: Counter = Counter()
    for what, e, text in found:
        if what == "text" and e and e.root and e.root.furniture and not e.root.hidden and not e.below:
            size[e.root] += len(text.strip())
    if not size:
        return found, set()
    free = [(e, len(text.strip())) for what, e, text in found if what == "text" and not (e and e.furniture)]
    largest, most = size.most_common(1)[0]
    if sum(n for _, n in free) >= most or any(n and e and e.root and e.root.tag == "article" for e, n in free):
        return found, set()
    return found, {root for root in size if root.mark is largest.mark}


def _token(what: str, path: str, text: str = "") -> int:
    return xxhash.xxh3_64_intdigest(f"{what} {path} {text}".encode("utf-8", "replace")) - (1 << 63)


def tokens(found: list[tuple[str, Element | None, str]]) -> Iterator[int]:
    """The tokens of a page that a template may hold, in order."""
    for what, element, text in found:
        if what == "tag":
            yield _token("tag", element.path)
        elif what == "text" and not (element and element.article):
            text = " ".join(text.split())
            if text:
                yield _token("text", element.path if element else "", text)


def layout(found: list[tuple[str, Element | None, str]]) -> int:
    """A digest of the boxes of a page outside its articles, never 0."""
    paths = {e.path for what, e, _ in found if what == "tag" and e.tag in BOXES and not (e.article and e.root is not e)}
    return _token("layout", "", "\n".join(sorted(x for x in paths if x.count("/") <= DEPTH))) | 1


def content(found: list[tuple[str, Element | None, str]], lifted: set[Element]) -> int:
    """A digest of the article of a page, or else of all texts that are not furniture by their elements."""
    kept = [(e, " ".join(text.split())) for what, e, text in found if what == "text"]
    kept = [(e, text) for e, text in kept if text and not (e and (e.below if e.root in lifted else e.furniture))]
    article = [text for e, text in kept if e and e.article]
    return _token("content", "", "\n".join(article or [text for _, text in kept]))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each host and content of a batch: the layout and the tokens of one page."""
    for batch in batches:
        seen: dict[tuple[str, int], tuple[int, bytes]] = {}
        for host, page in zip(*(batch.column(i).to_pylist() for i in range(2))):
            found, lifted = nodes(page)
            one = (layout(found), array("q", tokens(found)).tobytes())
            key = (host, content(found, lifted))
            seen[key] = min(seen.get(key, one), one)
        columns = list(zip(*((h, c, *one) for (h, c), one in seen.items()))) or [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "content", "layout", "tokens"]
        )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each host, layout (0 for all together) and token of a batch: the digest of its vector, pages,
    occurrences and places."""
    for batch in batches:
        found: dict[tuple[str, int, int], list[int]] = {}
        for host, page, kind, held in zip(*(batch.column(i).to_pylist() for i in range(4))):
            place: dict[int, int] = {}
            many = Counter()
            for i, token in enumerate(array("q", held)):
                place.setdefault(token, i)
                many[token] += 1
            many[0], place[0] = 1, 0
            for token, n in many.items():
                vector = xxhash.xxh3_64_intdigest(f"{page} {n}") - (1 << 63)
                for group in (0, kind):
                    entry = found.setdefault((host, group, token), [0, 0, 0, 0])
                    entry[0] ^= vector
                    entry[1] += 1
                    entry[2] += n
                    entry[3] += place[token]
        columns = list(zip(*((*key, *e) for key, e in found.items()))) or [[]] * 7
        kinds = [pa.string(), *[pa.int64()] * 6]
        names = ["host", "layout", "token", "vector", "pages", "times", "places"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def templates(pages: DataFrame) -> DataFrame:
    """`host` and `templates` for (host, html): of each layout (0 for all together) the tokens, in order, and
    their mean places."""
    read = pages.where("host is not null").select("host", "html")
    read = read.mapInArrow(_read, "host string, content long, layout long, tokens binary")
    # Copies count once, so that what they say is no template.
    once = read.groupBy("host", "content").agg(F.min(F.struct("layout", "tokens")).alias("page"))
    counted = once.select("host", "content", "page.layout", "page.tokens").mapInArrow(
        _counted, "host string, layout long, token long, vector long, pages long, times long, places long"
    )
    group = ["host", "layout"]
    counted = counted.groupBy(*group, "token").agg(
        F.bit_xor("vector").alias("vector"), *(F.sum(c).alias(c) for c in ("pages", "times", "places"))
    )
    counted = counted.where(F.col("pages") >= FEWEST)
    hosts = counted.where("token = 0").select(*group, F.col("pages").alias("all"))
    frequent = counted.where("token <> 0").join(hosts, group).where(F.col("pages") >= SHARE * F.col("all"))
    member = F.struct((F.col("places") / F.col("pages")).alias("place"), "token")
    classes = frequent.groupBy(*group, "vector", "pages", "times").agg(F.collect_list(member).alias("members"))
    large = classes.where(F.size("members") >= LARGE)
    ordered = large.groupBy(*group).agg(F.array_sort(F.flatten(F.collect_list("members"))).alias("m"))
    one = F.struct("layout", F.col("m.token").alias("tokens"), F.col("m.place").alias("places"))
    return ordered.groupBy("host").agg(F.collect_list(one).alias("templates"))


def _template(known: list[dict], kind: int) -> list[int]:
    """The tokens of the host's template and that of the layout, by the places in the layout first."""
    place: dict[int, float] = {}
    for group in (0, kind):
        for one in known:
            if one["layout"] == group:
                place.update(zip(one["tokens"], one["places"]))
    return sorted(place, key=lambda token: (place[token], token))


def main_text(page: str, template: list[int] | None) -> str:
    return _slots(*nodes(page), {token: i for i, token in enumerate(template or [])})


def _slots(found: list[tuple[str, Element | None, str]], lifted: set[Element], rank: dict[int, int]) -> str:
    furniture = lambda e: e.below if e.root in lifted else e.furniture
    marked = any(what == "text" and e and e.article and not furniture(e) and text.strip() for what, e, text in found)
    out, last = [], -1
    for what, element, text in found:
        if what == "tag":
            at = rank.get(_token("tag", element.path), -1)
            last = max(last, at)
            out.append(" ")
        elif what == "break":
            out.append(" ")
        elif element and furniture(element) or marked and not (element and element.article):
            out.append(" ")
        elif element is None or element.article:
            out.append(text if element or not text.isspace() else " ")
        else:
            at = rank.get(_token("text", element.path, " ".join(text.split())), -1)
            out.append(" " if at >= last >= 0 else text)
            last = max(last, at)
    return " ".join("".join(out).split())


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            texts, known, ranks = [], {}, {}
            hosts, pages, held = batch.column(3).to_pylist(), batch.column(2).to_pylist(), batch.column(4)
            for i, (host, page) in enumerate(zip(hosts, pages)):
                if host not in known:
                    known[host] = held[i].as_py() or []
                found, lifted = nodes(page)
                kind = layout(found) if known[host] else 0
                if (host, kind) not in ranks:
                    ranks[host, kind] = {token: k for k, token in enumerate(_template(known[host], kind))}
                texts.append(_slots(found, lifted, ranks[host, kind]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """`page_id`, `url` and `text` for each row of `pages`."""
    host = F.lower(F.regexp_extract(F.col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(
        F.when(host != "", host).alias("host"),
        F.col(id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    )
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    found = templates(rows).withColumn("salt", F.explode(F.expr(f"sequence(0, {SALTS - 1})")))
    # Pages without a host have one of their own each, so that they do not meet in one task.
    key = F.coalesce("host", F.xxhash64("page_id", "url").cast("string"))
    matched = rows.withColumns({"salt": salt, "host": key}).join(found, ["host", "salt"], "left")
    return matched.select("page_id", "url", "html", "host", "templates").mapInArrow(_extracted, "page_id long, url string, text string")
