"""Main text of web pages by consensus paths of their hosts.

Every page is cut into blocks of text, each with the path of its containers; a path step
is a tag with its first class, digits generalised. A page's containers are scored by
their text, links and prose; from the best one the vote climbs to the elements around it
while they add text of the article, and Spark counts the votes per host. Pages are then extracted again: from the winning path of their host if they
have it, else from their own best container. Menus, headers, footers, sidebars, notices,
adverts, forms and reader comments are left out inside the container as well. A name alone
does not decide: a section of the article whose class only begins with such a word, and a
header with the article's title, stay; a form or a marked element around the whole article
stays if it holds a heading and paragraphs.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm.common import lookup
from barline.plans import land

# Paths kept per host; a host with more layouts leaves the rest to each page's own vote.
PATHS = 3
# Share of a host's votes a path needs.
CONSENSUS = 0.1
# Steps of a path at most; what is nested deeper has the path of the element around it.
DEEPEST = 64
# Parts of a host where its pages or paths meet a row of their host.
SPREAD = 32

# Tags whose content is never text of the page.
SILENT = frozenset("script style noscript template svg iframe object canvas head title".split())
# Tags that may stand in a head; any other one ends it.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
# Tags around what is not the article.
OUTSIDE = frozenset("nav footer aside form button select option menu dialog textarea".split())
# Controls are left out whatever they hold.
CONTROLS = frozenset("button select option textarea".split())
# Characters in paragraphs that are an article without a heading.
LEAST = 200
# Words that mark such parts: a token of a class, id or role that is one or starts with one ...
_WORDS = (
    r"ads?|advert(?:s|is\w*)?|banners?|promo(?:s|tions?|ted)?|sponsor\w*|nav(?:bar|i|igation|s)?|"
    r"menu\w*|footer|sidebar|side-bar|cookie\w*|consent|notice|popup|modal|newsletter|subscribe|"
    r"share|social|related|comments?|comment(?:area|box|form|list|section)|disqus|breadcrumb\w*|"
    r"login|signup|widgets?|toolbar|pagination|masthead"
)
# ... or ends with one that names a part of the page ("main-nav"), but no state or layout
# ("comments-open", "has-sidebar").
_PARTS = (
    r"ads?|advert(?:s|is\w*)?|banners?|nav(?:bar|igation)?|menu|footer|sidebar|comments|"
    r"breadcrumbs?|pagination"
)
_STATE = r"open(?:ed)?|closed?|on|off|none|enabled|disabled|active|visible|hidden|collapsed|expanded"
_LAYOUT = r"has|have|no|not|with|without|is|show|hide|hidden|under|below|above|beside"
MARKS = re.compile(
    rf"(?:^|\s)(?!(?:{_LAYOUT})[-_])(?:(?:{_WORDS})(?![-_](?:{_STATE})(?:\s|$))(?![a-z])"
    rf"|\S*[-_:](?:{_PARTS})(?=\s|$))"
)
COMMENTS = re.compile(r"(?:^|\s)(?:\S*[-_])?(?:comment|disqus)")
# Names after a mark word that make it a part of the page ("share-buttons"), not a topic
# ("share-price").
_NAMED = (
    r"top|bottom|left|right|main|inner|outer|wrap(?:per)?|container|box|bar|area|slot|unit|block|section|"
    r"list|links?|buttons?|icons?|items?|posts?|stories|articles?|forms?|signup|notice|banner|overlay|"
    r"dialog|message|policy|law|consent|panel|menu|nav|media|[0-9]+"
)
# Parts that are never the article, whatever they hold.
_NEVER = re.compile(
    r"(?:\S*[-_:](?:nav(?:bar|igation)?|menu|footer|breadcrumbs?|pagination)|(?:nav(?:bar|igation)?|menu|footer|"
    r"cookies?|consent|notice|newsletter|subscribe|popup|modal|login|signup|breadcrumbs?|pagination)"
    rf"(?:[-_](?:{_NAMED}))*)"
)
_STRONG = re.compile(
    rf"(?:ads?|advert\w*|sponsor\w*|nav(?:bar|i|igation|s)?|footer|sidebar|side-bar|breadcrumb\w*|"
    rf"pagination)(?![a-z]).*|\S*[-_:](?:{_PARTS})|[^-_:]+(?:[-_](?:{_NAMED}))+"
)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
BLOCKS = frozenset(
    "address article aside blockquote body br dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A start tag that ends an open element of the same kind.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTAINERS = frozenset("article main section div body td".split())
# Block tags that end an open paragraph.
_ENDS_P = BLOCKS - {"br", "body", "html"}

_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*+>?|<\?[^>]*+>?"
    # No "<" outside quotes, so that tags that never end take linear time.
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|type)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)")

# Share of links from which added text is a menu or a list of teasers.
LINKED = 0.4
# Characters from which a paragraph beside the best container is prose by itself.
PROSE = 80
_HEADINGS = frozenset("h1 h2 h3".split())
# How many times a host's path the page's own article must score to be taken instead.
AGAINST = 2.0
# Elements that are left out unless the article around them has them as its own.
OWN = ("weak", "named", "header")

# Path, text, left out (0: no; 1: yes; from 2 on: an element of OWN), characters in links.
Block = tuple[str, str, int, int]


def step(tag: str, classes: str) -> str:
    """A path step: the tag and its first class, with digits generalised."""
    first = classes.split()[:1]
    return f"{tag}.{re.sub('[0-9]+', 'N', first[0].lower())}" if first else tag


def kind_of(marks: str) -> str:
    """What a class, id and role say: apart (never the article), marked, named (a mark word
    alone), weak (a mark word before another word), or nothing."""
    said = set()
    for token in marks.split() if MARKS.search(marks) else ():
        if not MARKS.search(token):
            continue
        if COMMENTS.search(token) or _NEVER.fullmatch(token):
            return "apart"
        strong = _STRONG.fullmatch(token)
        said.add("marked" if strong else "weak" if re.search("[-_:]", token) else "named")
    return next((kind for kind in ("marked", "named", "weak") if kind in said), "")


def tag_of(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def blocks(html: str) -> list[Block]:
    """The page's text blocks in order: path, text, left out or not, characters in links."""
    out: list[tuple[str, str, int, int]] = []
    # Elements that may be left out: number of the one around it, and its kind.
    flags: list[tuple[int, str]] = []
    # Of these, the ones with a control or a menu.
    controls: set[int] = set()
    # Open elements: tag, path, innermost of flags (-1: none), and whether it or one around
    # it is a link, an article.
    open_: list[tuple[str, str, int, bool, bool]] = []
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    linked = 0
    at = 0

    def path() -> str:
        return open_[-1][1] if open_ else ""

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(pieces)).split()) if pieces else ""
        if text:
            out.append((path(), text, open_[-1][2] if open_ else -1, linked))
        pieces.clear()
        linked = 0

    def close(position: int) -> None:
        if any(x[0] in BLOCKS for x in open_[position:]):
            flush()
        opened.subtract(x[0] for x in open_[position:])
        del open_[position:]

    while at < len(html):
        if open_ and open_[-1][0] in SILENT and open_[-1][0] != "head":
            # Raw text up to its own end tag.
            tag = open_[-1][0]
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            opened[tag] -= 1
            open_.pop()
            continue
        found = _TAG.search(html, at)
        if not found:
            pieces.append(html[at:])
            break
        if found.start() > at:
            piece = html[at : found.start()]
            if open_ and open_[-1][0] == "head" and piece.strip():
                close(len(open_) - 1)
            pieces.append(piece)
            if open_ and open_[-1][3]:
                linked += len(piece)
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:  # an end tag closes its element and all inside it
            for i in range(len(open_) - 1, -1, -1) if opened[tag] > 0 else ():
                if open_[i][0] == tag:
                    close(i)
                    break
            continue
        if open_ and open_[-1][0] == "head" and tag not in IN_HEAD:
            close(len(open_) - 1)
        if tag in BLOCKS:
            flush()
        for ends in (CLOSES.get(tag), {"p"} if tag in _ENDS_P and tag != "p" else None):
            if ends and any(opened[end] > 0 for end in ends):
                for i in range(len(open_) - 1, -1, -1):
                    if open_[i][0] in ends:
                        close(i)
                        break
                    if open_[i][0] in CONTAINERS or open_[i][0] in ("ul", "ol", "table", "dl"):
                        break
        said = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(found[3])}
        if open_ and open_[-1][2] >= 0:
            if tag in CONTROLS or tag == "nav" or tag == "input" and said.get("type") != "hidden":
                controls.add(open_[-1][2])
        if tag in VOID or found[3].endswith("/"):
            continue
        classes = entities.unescape(said.get("class", ""))
        marks = " ".join((classes, said.get("id", ""), said.get("role", "")))
        marks = _CAMEL.sub("-", marks).lower()
        _, around, flag, linking, inside = open_[-1] if open_ else ("", "", -1, False, False)
        kind = ""
        if tag in CONTROLS or tag in SILENT:
            kind = "never"
        elif tag in OUTSIDE and tag != "form":
            kind = "apart"
        elif tag == "header" and not inside:
            kind = "header"
        elif tag not in ("body", "html", "article", "main"):
            kind = kind_of(marks) or ("form" if tag == "form" else "")
        if kind in OWN and flag >= 0 and flags[flag][1] in OWN:
            kind = ""  # part of the element around it
        if kind:
            if flag >= 0 and flags[flag][1] in ("never", "apart") and kind != "never":
                kind = flags[flag][1]
            flags.append((flag, kind))
            flag = len(flags) - 1
        # Only blocks are steps, and not below DEEPEST: a path stays short on any page.
        if tag in BLOCKS and around.count("/") < DEEPEST - 1:
            around = f"{around}/{step(tag, classes)}" if around else step(tag, classes)
        open_.append(
            (tag, around, flag, linking or tag == "a", inside or tag in ("article", "main"))
        )
        opened[tag] += 1
    flush()
    left_out = dropped(out, flags, controls)
    return [
        (path, text, left_out[flag] if flag >= 0 else 0, linked) for path, text, flag, linked in out
    ]


class _Held:
    """Text of an element: all, in links, in paragraphs, and headings."""

    def __init__(self):
        self.size = self.linked = self.prose = self.headings = self.titles = 0

    def add(self, path: str, text: str, linked: int) -> None:
        tag, plain = tag_of(path), linked <= LINKED * len(text)
        self.size += len(text)
        self.linked += linked
        self.prose += len(text) - linked if tag == "p" and plain else 0
        self.headings += tag in _HEADINGS and plain
        self.titles += tag == "h1" and plain

    def take(self, other: _Held) -> None:
        for name, value in vars(other).items():
            setattr(self, name, getattr(self, name) + value)

    def article(self) -> bool:
        """A heading and paragraphs, or many paragraphs, and few links."""
        enough = self.prose >= PROSE if self.headings else self.prose >= LEAST
        return enough and self.linked <= LINKED * self.size


def dropped(
    found: list[tuple[str, str, int, int]], flags: list[tuple[int, str]], controls: set[int]
) -> list[int]:
    """Of each of ``flags``: 0 if it stays, 1 if it is left out, from 2 on if only an
    article around it can keep it.

    Menus, footers, notices and comments never stay. A marked element stays around an
    article, a heading and paragraphs, that the page has nowhere else: outside is no
    paragraph or heading, or inside is the only title (``h1``). A form stays around an article
    with more than half of the prose, or around all there is if it has no controls.
    """
    held = [_Held() for _ in flags]
    rest = _Held()
    total = 0
    for path, text, flag, linked in found:
        (held[flag] if flag >= 0 else rest).add(path, text, linked)
        if flag < 0 or flags[flag][1] not in ("never", "apart"):
            total += len(text) - linked
    busy = [k in controls for k in range(len(flags))]
    out = [1] * len(flags)
    for k in range(len(flags) - 1, -1, -1):  # what is inside comes after what is around
        around, kind = flags[k]
        here = held[k]
        if kind == "form":
            prose = here.size - here.linked
            alone = not busy[k] and 0 < total == prose
            out[k] = int(not (alone or here.article() and 2 * prose > total))
        elif kind in ("marked", "weak", "named"):
            only = not (rest.prose or rest.headings) or here.titles and not rest.titles
            if here.article() and only:
                out[k] = 0
        if kind in OWN and out[k] and not busy[k]:
            out[k] = 2 + 3 * k + OWN.index(kind)
        if around >= 0:
            busy[around] = busy[around] or busy[k] and kind != "never"
            if not out[k]:
                held[around].take(here)
    for k, (around, _) in enumerate(flags):
        if around >= 0 and out[around]:
            out[k] = 1
    return out


def containers(found: list[Block]) -> dict[str, float]:
    """Scores of the container paths of a page.

    Text counts for every container around it, a third less for each level up; text in
    links and in parts that are left out counts against it, and prose marks for it.
    """
    scores: dict[str, float] = {}
    for path, text, outside, linked in found:
        steps = path.split("/")
        worth = len(text) * (1.0 + 0.1 * min(10, text.count(",") + text.count(".")))
        worth = -worth if outside else worth - 2.0 * linked
        share = 1.0
        for depth in range(len(steps), 0, -1):
            tag = steps[depth - 1].partition(".")[0]
            if tag in CONTAINERS:
                bonus = 1.5 if tag in ("article", "main") else 1.0
                name = "/".join(steps[:depth])
                scores[name] = scores.get(name, 0.0) + worth * share * bonus
                share *= 0.67
    return scores


def _inside(path: str, top: str) -> bool:
    return not top or path == top or path.startswith(top + "/")


def _best(scores: dict[str, float]) -> str:
    return max(scores, key=lambda p: (scores[p], p.count("/"), p)) if scores else ""


def best_container(found: list[Block]) -> str:
    """The best container, or the highest element around it that adds to its article."""
    return climbed(found, _best(containers(found)))[0]


def climbed(found: list[Block], chosen: str, frames: bool = True) -> tuple[str, str]:
    """The highest element around ``chosen`` that adds to its article, and the element
    above where that ends ("" if nothing ends it).

    An element adds if the unflagged text it has beside the one below has few links. If
    it also has parts that are left out, or is the body, it is the page's frame: then
    the text must hold a heading or a paragraph of prose; without ``frames`` it ends there.
    """
    if not chosen:
        return "", ""
    # Per element around the chosen one: characters added, of these in links, whether some
    # of them are a heading or prose, and whether it has parts that are left out.
    depth = chosen.count("/")
    steps = chosen.split("/")
    added = [[0, 0, False, False] for _ in steps]
    for path, text, outside, linked in found:
        parts = path.split("/", depth + 1)
        common = 0
        for mine, other in zip(steps, parts, strict=False):
            if mine != other:
                break
            common += 1
        if not common or common > depth:
            continue
        at = added[common - 1]
        if outside:
            at[3] = True
            continue
        at[0] += len(text)
        at[1] += linked
        tag = tag_of(path)
        at[2] = at[2] or linked <= LINKED * len(text) and (tag in _HEADINGS or len(text) >= PROSE)
    top, frame, ended = depth, False, ""
    for k in range(depth - 1, -1, -1):
        size, linked, article, marked = added[k]
        frame = frame or marked or steps[k].partition(".")[0] in ("body", "html")
        if not size:
            continue
        if linked > LINKED * size or frame and not (article and frames):
            ended = "/".join(steps[: k + 1])
            break
        top = k
    return "/".join(steps[: top + 1]), ended


def chosen_container(found: list[Block], paths: list[str]) -> tuple[str, str]:
    """The element to extract, by the ``paths`` of the host that the page has, and the one
    above where its article ends.

    The first path around the page's own best container is taken, else the one that scores
    best; from there the page climbs as in the vote, but not into its frame. Its own
    container is taken if it holds an article of ``AGAINST`` times the score, and the
    host's path not the only title.
    """
    scores = containers(found)
    own = _best(scores)
    here = {path for path, _, outside, _ in found if not outside}
    present = [p for p in paths if any(_inside(path, p) for path in here)]
    if not present:
        return climbed(found, own)
    # The whole page tells nothing apart, unless most pages of the host are read that way.
    present = present[:1] + [p for p in present[1:] if tag_of(p) not in ("body", "html")]
    around = [p for p in present if _inside(own, p)]
    if around:
        return climbed(found, around[0], frames=False)
    worth = {p: max((v for c, v in scores.items() if _inside(c, p)), default=0.0) for p in present}
    theirs = max(present, key=lambda p: worth[p])
    mine, other = _Held(), _Held()
    for path, text, outside, linked in found:
        if not outside and _inside(path, own):
            mine.add(path, text, linked)
        if not outside and _inside(path, theirs):
            other.add(path, text, linked)
    if mine.article() and scores[own] >= AGAINST * worth[theirs] and (mine.titles or not other.titles):
        return climbed(found, own)
    return climbed(found, theirs, frames=False)


def main_text(found: list[Block], paths: list[str]) -> str:
    """Text inside the best of ``paths`` that the page has, else its best container.

    A title and lead right above it stay where a list of links beside them ends the
    article. A part of ``OWN`` stays if it has no controls and few links: a header if it has
    the only title, a section with a mark word in its name between text of the article or with a heading
    and a paragraph of its own, and if the name is nothing else, only with a heading or prose.
    """
    top, above = chosen_container(found, paths)
    whole = [k for k, b in enumerate(found) if not b[2] and _inside(b[0], top)]
    if not whole:
        return ""
    inside = set(whole)
    titled = any(tag_of(found[k][0]) == "h1" for k in whole)
    if tag_of(above) not in ("", "body", "html"):
        led = False
        for k, (path, text, outside, linked) in enumerate(found[: whole[0]]):
            if outside or path.rpartition("/")[0] != above or linked > LINKED * len(text):
                continue
            title = tag_of(path) == "h1" and not titled
            if title or tag_of(path) == "p" and (led or len(text) >= PROSE):
                inside.add(k)
                led = led or title
    parts: dict[int, list[int]] = {}
    for k, (path, _, outside, _) in enumerate(found):
        if outside > 1 and top and path != top and _inside(path, top):
            parts.setdefault(outside, []).append(k)
    for part, members in parts.items():
        held = _Held()
        for k in members:
            held.add(found[k][0], found[k][1], found[k][3])
        kind = OWN[(part - 2) % 3]
        if held.linked > LINKED * held.size:
            continue
        if kind == "header":
            stays = held.titles and not titled and tag_of(top) not in ("body", "html")
        else:
            between = whole[0] < members[0] and members[-1] < whole[-1]
            stays = between or held.headings and held.prose
            if kind == "named":
                stays = stays and (held.headings or held.prose >= PROSE)
        if stays:
            inside.update(members)
    return " ".join(found[k][1] for k in sorted(inside))


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, empty if there is none."""
    return F.lower(F.regexp_extract(url, _HOST.pattern, 1))


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame(
            {"_host": batch["_host"], "_path": [best_container(blocks(h)) for h in batch["_html"]]}
        )


def host_paths(rows: DataFrame, consensus: float = CONSENSUS, paths: int = PATHS) -> DataFrame:
    """Winning paths per host, best first: a host's votes are combined before the shuffle."""
    votes = (
        rows.select("_host", "_html")
        .mapInPandas(_votes, "_host string, _path string")
        .where("_path <> ''")
        .groupBy("_host", "_path")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # A host with a third of all pages may have as many paths: its sum meets them spread
    # over runs, and only paths with enough votes, 1 / consensus a host at most, are ranked.
    votes = land(votes.withColumn("_run", F.pmod(F.xxhash64("_path"), F.lit(SPREAD))), "votes")
    totals = votes.groupBy("_host").agg(F.sum("_n").alias("_all"))
    enough = lookup(votes, totals, ["_host"]).where(F.col("_n") >= F.col("_all") * consensus)
    by_votes = Window.partitionBy("_host").orderBy(F.desc("_n"), "_path")
    return (
        enough.withColumn("_rank", F.row_number().over(by_votes))
        .where(F.col("_rank") <= paths)
        .groupBy("_host")
        .agg(F.array_sort(F.collect_list(F.struct("_rank", "_path"))).alias("_won"))
        .select("_host", F.col("_won._path").alias("_paths"))
    )


def _extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [
            main_text(blocks(html), [] if paths is None else list(paths))
            for html, paths in zip(batch.pop("_html"), batch.pop("_paths"), strict=True)
        ]
        yield batch.assign(text=texts)


def main_texts(pages: DataFrame, consensus: float = CONSENSUS, paths: int = PATHS) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    A null html is an empty page with an empty text. Pages without a host in their url
    (a null url among them) vote together as one host. Repeated rows are extracted each.
    An empty table gives an empty result. Other columns are not looked at.
    """
    rows = pages.select(
        # As text: a batch of whole numbers with a null would come as doubles.
        F.col("page_id").cast("bigint").cast("string").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(host_of(F.col("url").cast("string")), F.lit("")).alias("_host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("_html"),
    )
    won = land(host_paths(rows, consensus, paths), "host-paths")
    # A host may hold a third of all pages: they meet their paths spread by page.
    salted = won.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return (
        rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SPREAD)).cast("int"))
        .join(salted, ["_host", "_salt"], "left")
        .select("page_id", "url", "_html", "_paths")
        .mapInPandas(
            _extracted,
            "page_id string, url string, text string",
        )
        .select(
            F.col("page_id").cast("bigint").alias("page_id"),
            "url",
            "text",
            F.length("text").cast("bigint").alias("n_chars"),
        )
    )
