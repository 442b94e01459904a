"""Main text of web pages by consensus host paths.

Each page is parsed into blocks (runs of text between block-level tags), each
below a container, whose generalised path lists the tags from the root with
their class names less digits. A page's containers are scored by the text they
hold outside links, half of it passed on to the container around; the pages of a
host vote, in Spark, for their best path, and every page is extracted again from
the host's winning path, widened to the article or main element around, else to
the widest container below the body whose other blocks are not links. A page
without that path uses its own best one.

Boilerplate (menus, headers and footers of the page, sidebars, notices, adverts,
forms, scripts, styles, reader comments) is left out by tag, role or class name.
A class name or id alone leaves out no element that holds the article: a main
element, an article at least as long as what articles and main hold outside such
elements, or most of the page's unlinked text. Within an article or main element only whole names
count (``related-posts``, not ``related-work``).

A page is parsed in one pass: an open element carries what its children need, paths
are numbered as a tree, and scores and flags are summed over it once, so deep or unclosed
nesting costs no more than its length.

Defined results: a NULL, empty or text-free page has the empty text; a URL
without a host votes with the others that have none; the winning path of equal
votes is the deepest, then the first by name; repeated rows are alike; only
``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import in_text_batches, stored

PATHS_BYTES = 8 << 20       # of hosts and paths that are broadcast
PAGES_A_PART = 20_000       # pages of a host that meet its path in one place, if they are too many to broadcast
PASS_ON = 0.5               # share of a container's score that the one around it gets

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre "
                  "section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("article body div main section td".split())
SKIP = frozenset("aside button dialog embed footer form head iframe menu nav noscript object script select style svg "
                 "template textarea title video audio canvas".split())
CLOSES_P = BLOCK - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "legend", "summary", "html", "body"}
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
LISTS, LISTED, CELLS = frozenset(("ul", "ol", "dl", "table")), ("li", "dt", "dd"), ("tr", "td", "th", "option")
# Class, id and role names of what is not the article.
NOISE = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments commentlist consent "
                  "contentinfo cookie cookies copyright disclaimer disqus footer header masthead menu nav navbar navigation "
                  "newsletter notice notices pagination popup promo promoted related replies respond search share sharing "
                  "sidebar signup social sponsor sponsored subscribe toolbar widget".split())
TALK = frozenset("comment comments commentlist disqus replies respond".split())
MODIFIERS = frozenset("has no non with without".split())      # first parts of names that tell of a page's layout
#: Parts of names that only tell of layout; with a word above they still name what is not the article.
LAYOUT = frozenset("area article articles bar block body bottom box button buttons column container content form group "
                   "icon icons inner item items left link links list main module outer overlay panel post posts primary row "
                   "section slot stories story this title top unit widget wrap wrapper".split())
FOREIGN = frozenset(("svg", "math"))
NAME = re.compile(r"[a-z]+")
MOST = 0.5                  # share of a page's unlinked text that no class name alone leaves out
MOST_TALK = 0.9             # the same for names of reader comments, which may be longer than the article


def named(attrs: list[tuple[str, str | None]], kinds: tuple[str, ...], names: frozenset[str], whole: bool = False) -> bool:
    """Whether an attribute of those kinds has a name that begins or ends with one of the words.

    With ``whole``, as within an article, all parts of the name must be such words or tell of
    layout: ``related-posts``, but not ``related-work``.
    """
    for name, value in attrs:
        if name in kinds and value:
            for word in value.lower().split():
                parts = NAME.findall(word)
                if not parts or parts[0] in MODIFIERS:
                    continue
                if whole:
                    if any(x in names for x in parts) and all(x in NOISE or x in LAYOUT for x in parts):
                        return True
                elif word in names or parts[0] in names or parts[-1] in names:
                    return True
    return False


def hidden(attrs: list[tuple[str, str | None]]) -> bool:
    return any(name == "hidden" or (name == "aria-hidden" and value == "true") for name, value in attrs)


class Noise:
    """An element whose class or id names what is not the article; its text decides in the end."""

    __slots__ = ("around", "talk", "main", "article", "holds", "text")

    def __init__(self, around: Noise | None, talk: bool, main: bool, article: bool) -> None:
        self.around, self.talk, self.main, self.article, self.text = around, talk, main, article, 0
        self.holds = article and not talk                   # an article that those around it hold, too


def unlinked(text: str, linked: int) -> int:
    return max(0, len(text) - linked)


class Open:
    """An open element with what its children need to know, so that none looks up the others."""

    __slots__ = ("tag", "path", "container", "skipped", "noise", "inside", "article", "link", "foreign", "near")

    def __init__(self, tag: str, path: int, container: int, skipped: bool, noise: Noise | None, inside: bool, article: bool,
                 link: bool, foreign: bool, near: dict[str, int]) -> None:
        self.tag, self.path, self.container, self.skipped, self.noise = tag, path, container, skipped, noise
        self.inside, self.article, self.link, self.foreign, self.near = inside, article, link, foreign, near


ROOT = Open("", 0, 0, False, None, False, False, False, False, {})


class Paths:
    """Generalised paths as a tree: each has a number, its parent's number, and its last step."""

    def __init__(self) -> None:
        self.number: dict[tuple[int, str], int] = {}
        self.parent, self.step, self.container, self.depth = [0], [""], [0], [0]

    def below(self, parent: int, step: str, container: int) -> int:
        got = self.number.get((parent, step))
        if got is None:
            got = self.number[parent, step] = len(self.parent)
            self.parent.append(parent)
            self.step.append(step)
            self.container.append(got if tag_of(step) in CONTAINER else container)
            self.depth.append(self.depth[parent] + 1)
        return got

    def find(self, text: str) -> int | None:
        """Number of a path given as text."""
        at = 0
        for step in text.split(">")[1:]:
            at = self.number.get((at, step), -1)
            if at < 0:
                return None
        return at

    def text(self, path: int) -> str:
        steps = []
        while path:
            steps.append(self.step[path])
            path = self.parent[path]
        return "".join(">" + x for x in reversed(steps))

    def nearest(self, chosen: list[int]) -> list[int]:
        """For each path, the chosen one that it is or lies below (0: none); parents have smaller numbers."""
        out = [0] * len(self.parent)
        for c in chosen:
            out[c] = c
        for p in range(1, len(out)):
            out[p] = out[p] or out[self.parent[p]]
        return out


class Blocks(HTMLParser):
    """Collects (container's path, text, characters in links) of each block of a page, in time linear in its length."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.paths = Paths()
        self.open: list[Open] = []
        self.tags: Counter[str] = Counter()                # of the open elements
        self.noises: list[Noise] = []
        self.found: list[tuple[int, str, int, Noise | None, bool]] = []
        self.buffer: list[str] = []
        self.linked = 0

    @property
    def last(self) -> Open:
        return self.open[-1] if self.open else ROOT

    def flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        if text:
            at = self.last
            self.found.append((at.container, text, self.linked, at.noise, at.inside))
            if at.noise is not None:
                at.noise.text += unlinked(text, self.linked)
        self.buffer, self.linked = [], 0

    def cut(self, length: int) -> None:
        for e in self.open[length:]:
            self.tags[e.tag] -= 1
        del self.open[length:]

    def pop(self, tags: tuple[str, ...]) -> None:
        """Close the innermost of the tags within its bounds."""
        near = self.last.near
        at = max((near[t] for t in tags if t in near), default=-1)
        if at >= 0:
            self.flush()
            self.cut(at)

    def near_of(self, tag: str) -> dict[str, int]:
        """Places of the innermost open elements that a later tag closes; a container or list bounds them."""
        near = self.last.near
        gone = (("p",) if tag in CONTAINER else ()) + (LISTED if tag in LISTS else ()) + (CELLS if tag == "table" else ())
        if any(t in near for t in gone):
            near = {t: i for t, i in near.items() if t not in gone}
        if tag == "p" or tag in CLOSES:
            near = near | {tag: len(self.open)}
        return near

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag in ("br", "wbr"):
                self.buffer.append(" " if tag == "br" else "")
            return
        if tag in CLOSES_P:
            self.pop(("p",))
        if tag in CLOSES:
            self.pop(CLOSES[tag])
        if tag in BLOCK:
            self.flush()
        around = self.last
        skipped = around.skipped or tag in SKIP or tag not in ("html", "body") and (
            hidden(attrs) or named(attrs, ("role",) if tag in BLOCK else ("class", "id", "role"), NOISE, around.inside))
        if tag == "header" and not around.inside:
            skipped = True
        names = [re.sub(r"\d+", "", c).replace(">", "") for n, v in attrs if n == "class" for c in (v or "").lower().split()]
        path = self.paths.below(around.path, ".".join([tag, *sorted(n for n in names if n)]), around.container)
        noise = around.noise
        if not skipped:
            talk = named(attrs, ("class", "id"), TALK, around.inside)
            outermost = tag == "article" and not around.article
            if noise is not None:                           # it holds them; so do those around it, see blocks()
                noise.main |= tag == "main"
                noise.article |= outermost and not talk
                noise.holds |= outermost and not talk
            if tag not in ("html", "body") and named(attrs, ("class", "id"), NOISE, around.inside):
                noise = Noise(noise, talk, tag == "main", outermost)
                self.noises.append(noise)
        self.open.append(Open(
            tag, path, self.paths.container[path], skipped, noise, around.inside or tag in ("article", "main"),
            around.article or tag == "article", around.link or tag == "a", around.foreign or tag in FOREIGN, self.near_of(tag)))
        self.tags[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # only drawings and formulas have elements that end at once; elsewhere the slash means nothing
        if not (tag in FOREIGN or self.last.foreign):
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.tags[tag]:
            if tag in BLOCK:
                self.flush()
            at = len(self.open) - 1
            while self.open[at].tag != tag:
                at -= 1
            self.cut(at)

    def handle_data(self, data: str) -> None:
        at = self.last
        if not at.skipped:
            self.buffer.append(data)
            if at.link:
                self.linked += len(data.strip())

    def blocks(self) -> list[tuple[int, str, int]]:
        """The blocks outside named noise, but for noise that holds the article."""
        for n in reversed(self.noises):                     # inner ones first: what they hold, those around hold too
            if n.around is not None:
                n.around.text += n.text
                n.around.main |= n.main
                n.around.article |= n.holds
                n.around.holds |= n.holds
        only_main = {None: True}                            # whether all around hold a main element
        for n in self.noises:
            only_main[n] = n.main and only_main[n.around]
        total = sum(unlinked(t, n) for _, t, n, _, _ in self.found)
        clean = sum(unlinked(t, n) for _, t, n, around, inside in self.found if inside and only_main[around])
        kept = {None: True}
        for n in self.noises:
            kept[n] = kept[n.around] and (
                n.main or n.article and (not clean or n.text >= clean and not n.talk)
                or n.text > total * (MOST_TALK if n.talk else MOST))
        return [(path, text, linked) for path, text, linked, around, _ in self.found if kept[around]]


class Page:
    """The blocks of a page and the tree of their paths."""

    def __init__(self, html: str | None):
        parser = Blocks()
        if html:
            parser.feed(html)
            parser.close()
            parser.flush()
        self.paths, self.blocks = parser.paths, parser.blocks()

    def scores(self) -> list[float]:
        """Score of each container's path: its text outside links, and half of what its containers pass on."""
        own = [0.0] * len(self.paths.parent)
        for path, text, linked in self.blocks:
            own[path] += max(0, len(text) - 2 * linked)
        for p in range(len(own) - 1, 0, -1):
            if own[p] and self.paths.container[p] == p:
                own[self.around(p)] += PASS_ON * own[p]
        return own

    def around(self, path: int) -> int:
        """The container around a path, 0 for none."""
        return self.paths.container[self.paths.parent[path]]

    def best(self) -> int | None:
        """The path of the highest score, then the deepest, then the first by name; None without any container."""
        own, held = self.scores(), set()
        for path, _, _ in self.blocks:
            while path and path not in held:
                held.add(path)
                path = self.around(path)
        most = max((own[p] for p in held), default=None)
        if most is None:
            return None
        ties = [p for p in held if own[p] == most]
        deepest = max(self.paths.depth[p] for p in ties)
        return min((p for p in ties if self.paths.depth[p] == deepest), key=self.paths.text)

    def below(self, path: int) -> list[str]:
        nearest = self.paths.nearest([path])
        return [text for own, text, _ in self.blocks if nearest[own]]

    def widened(self, path: int) -> int:
        """The outermost article around the path, else main, else the widest container below the body that adds no links."""
        chain = [path]
        while chain[-1]:
            chain.append(self.around(chain[-1]))
        for tag in ("article", "main"):
            if found := [p for p in chain if tag_of(self.paths.step[p]) == tag]:
                return found[-1]
        nearest = self.paths.nearest(chain[:-1])
        # the innermost container of the chain around each list of links
        linked = {nearest[own] for own, text, n in self.blocks if 2 * n > len(text)}
        widest = path
        for p in chain[1:-1]:
            if tag_of(self.paths.step[p]) == "body" or p in linked:
                break
            widest = p
        return widest


def tag_of(step: str) -> str:
    return step.split(".")[0]


def best_path(page: Page) -> tuple[str, float] | None:
    """Text and score of a page's best path."""
    best = page.best()
    return None if best is None else (page.paths.text(best), page.scores()[best])


def extract(html: str | None, path: str | None) -> str:
    """Text blocks below the widened path, or below the page's own best path if it has none below the path."""
    page = Page(html)
    at = page.paths.find(path) if path else None
    if not at or not page.below(at):
        at = page.best()
    return "\n\n".join(page.below(page.widened(at)) if at else [t for _, t, _ in page.blocks])


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, score) of each page's best container."""
    for batch in batches:
        rows = [(h, best_path(Page(p.as_py()))) for h, p in zip(batch.column(0).to_pylist(), batch.column(1))]
        rows = [(h, *b) for h, b in rows if b]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(
            list(zip(*rows)) or [()] * 3, (pa.string(), pa.string(), pa.float64()))], names=["host", "path", "score"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, n): the container path with the most pages' votes, then the most text, of each host; all its votes."""
    counted = (pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(votes, "host string, path string, score double")
               .groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(F.floor("score")).alias("score")))
    depth = F.size(F.split("path", ">"))
    return counted.groupBy("host").agg(
        F.min(F.struct(-F.col("n"), -F.col("score"), -depth, "path")).alias("best"), F.sum("n").alias("n")).select(
        "host", F.col("best.path").alias("path"), "n")


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of each page.

    The hosts' paths are measured first: up to PATHS_BYTES they are broadcast and no page is moved;
    more are joined, with the pages of each host dealt into as many parts as the largest host asks for.
    """
    pages = in_text_batches(pages)
    paths = stored(host_paths(pages), "html-paths")
    size, most = paths.agg(F.coalesce(F.sum(F.length("host") + F.length("path") + 64), F.lit(0)),
                           F.coalesce(F.max("n"), F.lit(0))).first()
    hosts = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    if size <= PATHS_BYTES:
        joined = hosts.join(F.broadcast(paths.select("host", "path")), "host", "left")
    else:
        parts = -(-most // PAGES_A_PART)
        dealt = paths.select("host", "path", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
        joined = hosts.withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.lit(parts)).cast("int")).join(
            dealt, ["host", "part"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [extract(h.as_py(), p.as_py()) for h, p in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())],
                                             names=["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "path").mapInArrow(run, f"page_id {kind}, url string, text string")
