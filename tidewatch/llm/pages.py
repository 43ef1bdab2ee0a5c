"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of tags and words. Tags score negative, words by where they stand, and one
linear scan finds the contiguous region with the highest sum. Weights are log odds learned from
pages that label their own content with an article or main element: how often a tag, or a word in
a given setting, lies inside that element against outside. Within the region, words whose setting
is not content (an advert between two paragraphs) are left out.

Class and id names speak against an element only if a whole name says what page furniture it is
("ad", "cookie-notice"), and not beside a name that wraps content. Other names with such a part
("has-sidebar") lower the score of words and never remove them. An element with most of the page's
words and its heading, or with nearly all words, is content whatever it is called.
"""

import functools
import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import least_hashes

#: Pages that weights are learned from, at most: those with the least hashes.
LABELLED_PAGES = 2000
#: Scores of what no labelled page has: a word, a word of page furniture, a tag.
WORD, FURNITURE, TAG = 2.0, -0.5, -0.25
#: The most that a word scores where a name may mean page furniture.
PERHAPS = 0.75
_CODE = "script|style|noscript|template|svg|iframe|textarea|select|object|title|math"
_PIECE = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_CODE})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>.*?(?:</\1\s*>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^<]*(?:>|\Z)|([^<]+|<)",
    re.DOTALL | re.IGNORECASE)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
_INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong"
                    " sub sup time tt u var wbr big strike".split())
_ASIDE = frozenset("nav aside footer form button dialog menu fieldset".split())
_LABEL = frozenset(["article", "main"])
_FURNITURE_PART = re.compile(
    r"ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|consent|"
    r"comments?|replies|respond|disqus|sidebar|menu|nav(?:bar|igation)?|breadcrumbs?|footer|masthead|"
    r"newsletter|subscribe|signup|share|sharing|social|related|recommended|popup|modal|notices?|alert|widget|"
    r"pagination|pager|login|search|toolbar|copyright")
#: Parts that a furniture name may have besides.
_PLAIN_PART = re.compile(
    r"\d*|area|bar|block|body|bottom|box|buttons?|container|content|default|form|group|header|holder|icons?|inner|items?|left|"
    r"links?|lists?|main|outer|panel|posts?|primary|right|secondary|section|side|site|slot|stories|the|thread|title|top|unit|wrap|wrapper")
#: Names of elements that hold content.
_CONTENT_PART = re.compile(r"article|body|content|entry|layout|main|page|post|story|text|wp|wrapper|container|site")
_PARTS = re.compile(r"[\s_:-]+|(?<=[a-z])(?=[A-Z])")
#: A name that much likelier on what wraps labelled content than elsewhere is no furniture, and the other way round.
WRAPS, OUTSIDE = 1.0, -2.0


def suspicion(names: str, weight: dict[str, float]) -> int:
    """What class, id and role names say of an element: 2 page furniture, 1 perhaps, 0 nothing."""
    whole = hint = some = False
    for name in names.split():
        parts = [p.lower() for p in _PARTS.split(name)]
        furniture = [bool(_FURNITURE_PART.fullmatch(p)) for p in parts]
        odds = weight.get("n:" + name.lower(), 0.0)
        if any(furniture):
            some = True
            whole |= all(f or _PLAIN_PART.fullmatch(p) for f, p in zip(furniture, parts, strict=True))
        elif _CONTENT_PART.fullmatch(parts[0]):
            hint = True
        hint |= odds >= WRAPS
        some |= odds <= OUTSIDE
    return 2 if whole and not hint else 1 if some and not (hint and not whole) else 0


@functools.lru_cache(maxsize=4096)
def _kinds(name: str, furniture: bool) -> tuple[str, ...]:
    """What an open element is looked for by."""
    return (name, *(["*label"] if name in _LABEL else []), *(["*furniture"] if furniture and name in _BLOCKS else []),
            *(["*outer"] if name not in _INLINE else []))


class _Elements:
    """The open elements of a page; every step costs the same however many are open."""

    def __init__(self):
        self.open: list[int] = []  # ids of open elements
        self.places: dict[str, list[int]] = {}  # where in ``open`` elements of a name, or of a kind, stand
        # Of all elements, in page order; the first stands for the page.
        self.parent, self.name, self.tagged, self.suspect, self.fenced = [-1], [""], [False], [0], [False]
        self.labelled, self.link, self.block, self.names = [False], [False], ["body"], [()]
        self.words, self.heading, self.wraps = [0], [False], [False]

    def top(self) -> int:
        return self.open[-1] if self.open else 0

    def push(self, name: str, names: str, weight: dict[str, float]):
        up = self.top()
        label = self.labelled[up] or name in _LABEL
        own = suspicion(names, weight) if names and name not in ("html", "body") else 0
        tagged = self.tagged[up] or name in _ASIDE or name == "head" or name == "header" and not self.labelled[up]
        self.parent.append(up)
        self.name.append(name)
        self.tagged.append(tagged)
        self.suspect.append(own)
        self.fenced.append(self.fenced[up] or tagged or own == 2)
        self.labelled.append(label)
        self.link.append(self.link[up] or name == "a")
        self.block.append(name if name in _BLOCKS else self.block[up])
        self.names.append(tuple(dict.fromkeys(names.lower().split())) if names else ())
        self.words.append(0)
        self.heading.append(not tagged and (name == "h1" or name in _LABEL and not own))
        self.wraps.append(name in _LABEL)
        for kind in _kinds(name, self.fenced[-1]):
            self.places.setdefault(kind, []).append(len(self.open))
        self.open.append(len(self.name) - 1)

    def last(self, kind: str) -> int:
        found = self.places.get(kind)
        return found[-1] if found else -1

    def cut(self, place: int):
        while len(self.open) > place:
            one = self.open.pop()
            for kind in _kinds(self.name[one], self.fenced[one]):
                self.places[kind].pop()

    def close(self, name: str):
        """A closing tag ends its element and those within, but neither labelled content nor, if inline, furniture."""
        place = self.last(name)
        fence = max(self.last("*label"), self.last("*furniture") if name in _INLINE else -1)
        if place >= 0 and place >= fence:
            self.cut(place)

    def close_paragraph(self, name: str):
        """A block ends an open paragraph, a list item an open item, and what stands in them."""
        place = self.last("*outer")
        if place >= 0 and self.name[self.open[place]] in (("p", "li") if name == "li" else ("p",)):
            self.cut(place)

    def judge(self) -> tuple[list[bool], list[bool]]:
        """Which elements are page furniture, and which may be; parents come before their children."""
        size = len(self.name)
        for one in range(size - 1, 0, -1):
            up = self.parent[one]
            self.words[up] += self.words[one]
            self.heading[up] |= self.heading[one]
            self.wraps[up] |= self.wraps[one]
        total = self.words[0]
        out, perhaps = [False] * size, [False] * size
        for one in range(1, size):
            up = self.parent[one]
            most = 2 * self.words[one] > total and self.heading[one] or 10 * self.words[one] > 9 * total
            lifted = most and total > 0
            out[one] = out[up] or self.tagged[one] or self.suspect[one] == 2 and not lifted
            perhaps[one] = perhaps[up] or self.suspect[one] == 1 or self.suspect[one] == 2 and lifted
        return out, perhaps


def _parse(page: str, weight: dict[str, float]) -> tuple[list[tuple[str, str, int]], _Elements]:
    """The page's tags and texts as (kind, text, element); ``kind`` as in ``pieces``."""
    out: list[tuple[str, str, int]] = []
    tree = _Elements()
    for found in _PIECE.finditer(page):
        closing, name, rest, text = found[2], found[3], found[4], found[5]
        top = tree.top()
        if text is not None:
            out.append(("w", text, top))
            if not tree.tagged[top] and not tree.link[top]:
                tree.words[top] += len(text.split())
        elif name:
            name = name.lower()
            if name in _BLOCKS:
                out.append(("block", "", top))
            if closing:
                tree.close(name)
            elif name not in _VOID and not rest.rstrip().endswith("/"):
                if name in _BLOCKS:
                    tree.close_paragraph(name)
                tree.push(name, " ".join(a or b or c for a, b, c in _NAMES.findall(rest)) if rest else "", weight)
            out.append((f"t:{name}", "", top))
    return out, tree


def pieces(page: str, weight: dict[str, float] | None = None) -> list[tuple[str, str, str, bool]]:
    """The page's tags and texts: (kind, text, setting, labelled).

    ``kind`` is "t:name" for tags, "block" where a block ends, "w" for text. ``setting`` tells
    where text stands: "other:" settings are page furniture, "perhaps:" ones have a name that
    may mean it. ``labelled``: inside an article.
    """
    parts, tree = _parse(page, weight or {})
    return _settings(parts, tree)


def _settings(parts, tree):
    furniture, perhaps = tree.judge()
    kinds = ["other:" if f else "perhaps:" if p else "" for f, p in zip(furniture, perhaps, strict=True)]
    return [(kind, text, (kinds[e] + ("a:" if tree.link[e] else "") + tree.block[e] if kind == "w" else kinds[e] if furniture[e] else ""),
             tree.labelled[e]) for kind, text, e in parts]


def count_weights(page: str) -> Counter:
    """How often each tag, each setting's words and each name occur inside and outside labelled content."""
    own: Counter = Counter()
    parts, tree = _parse(page, {})
    parts = _settings(parts, tree)
    if any(p[3] for p in parts):
        for kind, text, setting, labelled in parts:
            if kind == "w":
                own[f"w:{setting.removeprefix('perhaps:')}", labelled] += len(text.split())
            elif kind != "block":
                own[kind, labelled] += 1
        for names, wraps, labelled in zip(tree.names, tree.wraps, tree.labelled, strict=True):
            if wraps or not labelled:  # what stands within content says nothing of furniture
                own.update((f"n:{name}", wraps) for name in names)
    return own


def weights(counts: dict) -> dict[str, float]:
    """Log odds of inside against outside, words at least 1 apart from 0, tags at most -0.1.

    Those of class and id names tell what wraps labelled content from what stands outside.
    """
    inside, outside = Counter(), Counter()
    for (name, labelled), n in counts.items():
        (inside if labelled else outside)[name] += n
    out = {}
    for name in {*inside, *outside}:
        odds = math.log((inside[name] + 1) / (outside[name] + 1))
        if name[0] == "n":
            out[name] = odds
        elif name[0] == "t":
            out[name] = -min(2.0, max(0.1, 1.0 - odds / 4))
        elif "other:" in name:
            out[name] = -min(2.0, max(0.5, -odds))
        else:
            out[name] = min(4.0, max(1.0, odds)) if odds > -1 else -min(4.0, -odds)
    return out


def main_text(page: str, weight: dict[str, float]) -> str:
    """The texts of the best region, one blank line between blocks."""
    best = total = 0.0
    start = first = last = 0
    parts = pieces(page, weight)
    for k, (kind, text, setting, labelled) in enumerate(parts):
        if kind == "block" or labelled and setting.startswith("other:"):
            continue  # furniture within labelled content is left out below and must not end the region
        if kind == "w":
            words = len(text.split())
            own = weight.get(f"w:{setting.removeprefix('perhaps:')}", FURNITURE if setting.startswith("other:") else WORD)
            score = words * (min(own, PERHAPS) if setting.startswith("perhaps:") else own)
        else:
            score = weight.get(kind, TAG)
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, first, last = total, start, k + 1
    blocks, block = [], []
    for kind, text, setting, _ in parts[first:last]:
        if kind == "w" and not setting.startswith("other:"):
            block.append(text)
        elif kind == "t:br":
            block.append(" ")
        elif kind == "block":
            blocks.append(block)
            block = []
    blocks.append(block)
    whole = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n\n".join(b for b in whole if b)


def learn(labelled: DataFrame, most: int = LABELLED_PAGES) -> dict[str, float]:
    """Weights from at most ``most`` pages; pages without an article or main element teach nothing."""
    some = least_hashes(labelled.select("page_id", "html").filter("html is not null"), most, "page_id").select("html")

    def run(batches):
        own: Counter = Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                own.update(count_weights(page))
        yield pa.RecordBatch.from_pydict({
            "name": pa.array([k[0] for k in own], pa.string()), "inside": pa.array([k[1] for k in own], pa.bool_()),
            "n": pa.array(list(own.values()), pa.int64())})

    rows = some.mapInArrow(run, "name string, inside boolean, n long").groupBy("name", "inside").agg(F.sum("n").alias("n"))
    return weights({(r["name"], r["inside"]): r["n"] for r in rows.collect()})


def extract(web: DataFrame, weight: dict[str, float]) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    Needs ``page_id``, ``url`` and ``html``; other columns are left out. A null or empty page, and
    one whose words are all furniture, has an empty text. Repeated rows stay.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(page, weight) for page in batch.column("html").fill_null("").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return web.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def extract_pages(web: DataFrame) -> DataFrame:
    """Learn weights from the pages that label their content, then extract every page."""
    return extract(web, learn(web))
