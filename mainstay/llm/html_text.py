"""HTML extraction: a graphical model over the DOM tree, with sum-product messages up and down.

Nodes are the elements of a page and its runs of text. Each is content or not; a node's own signs (tag, words of class and
id, size and links of a run) say how likely, and potentials between parent and child tie the tree together.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard: elements without content, with raw text, that are never shown, that break lines.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set("script style head title template noscript iframe object svg annotation annotation-xml mphantom select textarea button input option".split())
# What may stand in a head; anything else ends an open one.
IN_HEAD = set("html title meta link base basefont bgsound style script noscript noframes template".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br input button select option textarea script style noscript svg math "
    "template object iframe mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder "
    "mover munderover mmultiscripts mprescripts mtable mtr mlabeledtr mtd maction menclose mfenced semantics annotation "
    "annotation-xml".split()
)
# An opening tag of the key ends an open one of the values, unless one of BARRIER is nearer.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
    "option": {"option"}, "body": {"head"},
}
BARRIER = set("ul ol dl table section article main div body html".split())
KEEP_P_OPEN = {"html", "head", "body", "li", "td", "th", "tr", "tbody", "thead", "tfoot", "dt", "dd", "option", "caption"}

# Tags whose choice says something of their own; lists, tables and boxes hold menus and articles alike.
TELLING = set("p h1 h2 h3 h4 h5 h6 pre blockquote figcaption article main article-worded main-worded nav footer aside form menu dialog header".split())
# What a page's author marks as content or not: labels of the training pages, and prior counts for signs they don't show.
MAIN_TAGS = {"article", "main"}
WORDED_TAGS = {f"{tag}-worded" for tag in MAIN_TAGS}
OTHER_TAGS = set("nav footer aside form menu dialog header".split())
# Elements that hold a page's parts; between them content begins and ends, below them it hardly does.
PARTS = set("html body article main article-worded main-worded div section center table tbody tr td header footer nav aside form".split())
OTHER_WORDS = set(
    "nav navbar navigation menu sidebar footer header masthead breadcrumb breadcrumbs ad ads advert adverts advertisement "
    "banner sponsor sponsored promo cookie cookies consent notice notices alert popup modal share sharing social related "
    "recommended comment comments reply replies disqus respond newsletter subscribe signup login search widget toolbar "
    "pagination pager skip copyright legal contentinfo complementary advertising announcement gdpr feedback trending "
    "recommendations".split()
)
MAIN_WORDS = set("article content post entry story main body text".split())
UNSHOWN = "unshown"
# A token of several words is a sign of its own. It leans to a listed word that it ends in, or begins with before a word
# for a box (comments-area); not behind one of NOT_OWN, which tell of a state or a topic (has-sidebar, category-social).
BOXES = set(
    "area list lists container wrapper wrap box section block panel inner outer holder group row item items link links button "
    "buttons icon icons bar slot unit form post posts article articles story stories content body text title thread feed column".split()
)
NOT_OWN = set("no non not without has have with is category categories tag topic format status type hide show enable disable allow".split())
# Listed words that name a part that isn't content in its title, too; an id with another one may be made from the title.
TITLES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo share sharing related recommended recommendations "
    "trending comment comments reply replies disqus respond feedback newsletter subscribe signup".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# Prior counts of the listed words, added to what the pages show: log ratios of both weigh once for a word of content,
# LISTED times for a word of the other list or a token that leans to one. An article or main that bears such a word weighs
# WORDED instead of MARK, so that its text decides; beside other marked ones, and without a word of content, BESIDE less.
# Only the tags of the lists above and what isn't shown
# weigh MARK, which nothing outvotes. Other tags and words weigh at most OTHER log units, signs of a run of text RUN, what
# a child takes from its parent is bounded by STICK, and children of one tag say no more to their parent than CROWD of
# them. Pages of one make would else teach that no list is ever content.
PRIOR = 10_000
LISTED, WORDED, BESIDE = 2.0, 9.0, 6.0
MARK, OTHER, RUN, STICK, CROWD = 1000.0, 2.0, 1.5, 0.995, 3
# Pages to learn from: about so many, picked by a hash of their number; signs rarer than RARE there are left out.
SAMPLE = 4000
RARE = 3
MOST_SIGNS = 5000

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S
)
_NAMES = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ID_ONLY = re.compile(r"""(?!.*(?:^|[\s"'/])(?:class|role)\s*=)(?:.*[\s"'/])?id\s*=\s*["']?([^\s"'>]*)""", re.I | re.S)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]+)))?""")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


@dataclass
class Tree:
    """Nodes in page order: parent's place, signs, and for runs of text the text."""

    parents: list[int] = field(default_factory=list)
    signs: list[list[str]] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)

    def add(self, parent: int, tag: str, signs: list[str], text: str | None = None) -> int:
        self.parents.append(parent)
        self.tags.append(tag)
        self.signs.append(signs)
        self.texts.append(text)
        return len(self.parents) - 1


def _run_signs(text: str, linked: int) -> list[str]:
    return [f"run={'linked' if 2 * linked > len(text) else 'plain'}{min(len(text).bit_length(), 9)}"]


def _leaning(words: list[str]) -> str | None:
    """The listed word that a token of several words leans to."""
    if words[0] in NOT_OWN:
        return None
    if words[-1] in OTHER_WORDS:
        return words[-1]
    return words[0] if words[0] in OTHER_WORDS and words[-1] in BOXES else None


def _names(tag: str, attributes: str) -> tuple[set[str], set[str]]:
    """Words and whole tokens of class, id and role, and the listed words that tokens lean to.

    `unshown` stands for an element that isn't shown. The id of a heading is made from its text and isn't read.
    """
    found, leans = set(), set()
    for m in _NAMES.finditer(attributes):
        if tag in HEADINGS and m[1].lower() == "id":
            continue
        for token in (m[2] or m[3] or m[4] or "").split():
            words = [w.lower() for w in _WORD.findall(token)]
            if len(words) > 1:
                found.add("-".join(words))
                if not OTHER_WORDS.isdisjoint(words):
                    lean = _leaning(words)
                    leans |= {lean} - {None, "header"} if lean and MAIN_WORDS & set(words) else {lean} - {None}
                    continue
            found.update(words)
    return (found | {UNSHOWN} if _unshown(attributes) else found), leans


def _unshown(attributes: str) -> bool:
    """Whether there is an attribute hidden, or display: none in a style; values of others don't count."""
    lower = attributes.lower()
    if "hidden" not in lower and "display" not in lower:
        return False
    found = [(m[1], m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(lower)]
    return any(name == "hidden" or name == "style" and _NOT_SHOWN.search(value) for name, value in found)


def parse(page: str) -> Tree:
    """The page as a tree; unclosed and stray tags are mended, every text ends up in a run."""
    tree = Tree()
    root = tree.add(-1, "#page", [])
    stack: list[tuple[str, int, bool]] = [("#page", root, False)]
    run: list[str] = []
    linked = others = 0
    # How often each tag is open, and the places of the open block elements.
    open_tags: Counter = Counter()
    blocks = [root]
    hidden = anchors = mains = 0
    # Listed words of elements that have no class or role but an id.
    ids: dict[int, str] = {}

    def flush() -> None:
        nonlocal run, linked
        text = " ".join("".join(run).split())
        if text:
            tree.add(blocks[-1], "#text", _run_signs(text, min(linked, len(text))), text)
        run, linked = [], 0

    def pop() -> None:
        nonlocal hidden, anchors, others, mains
        tag, _, other = stack[-1]
        if tag not in INLINE:
            flush()
            blocks.pop()
        open_tags[tag] -= 1
        mains -= tag in MAIN_TAGS
        hidden -= tag in UNSEEN
        anchors -= tag == "a"
        others -= other
        stack.pop()

    def pop_to(names: set[str], barrier: set[str]) -> None:
        if not any(open_tags[name] for name in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in names:
                while len(stack) > depth:
                    pop()
                return
            if stack[depth][0] in barrier:
                return

    def end_head() -> None:
        while stack[-1][0] == "head":
            pop()

    def say(text: str) -> None:
        nonlocal linked
        if text.strip(" \t\n\f\r"):
            end_head()
        if hidden or not text:
            return
        text = html.unescape(text) if "&" in text else text
        run.append(text)
        if anchors:
            linked += len(text.strip())

    at = 0
    while True:
        found = _TAG.search(page, at)
        if not found:
            say(page[at:])
            break
        say(page[at:found.start()])
        at = found.end()
        if not found[2]:
            continue
        name = found[2].lower()
        if found[1]:
            if name == "p" and not open_tags["p"]:
                flush()
            elif name not in VOID:
                pop_to({name}, set() if name not in INLINE else BARRIER)
            continue
        if name not in IN_HEAD:
            end_head()
        if name in ("br", "mtr", "mtd"):
            run.append(" ")
        if name == "br":
            continue
        if name not in INLINE and name not in KEEP_P_OPEN:
            pop_to({"p"}, BARRIER)
        if name in CLOSES:
            pop_to(CLOSES[name], BARRIER - {"body", "html"} if name == "body" else BARRIER)
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        other = False
        if name in INLINE:
            place = stack[-1][1]
        else:
            words, leans = _names(name, found[3]) if found[3] else (set(), set())
            if name in ("html", "body"):
                words, leans = set(), set()
            elif mains or MAIN_WORDS & words:
                words.discard("header")
                leans.discard("header")
            sign = name
            marked = not words.isdisjoint(OTHER_WORDS) or bool(leans) or UNSHOWN in words
            if name == "header" and mains or name in MAIN_TAGS and others:
                sign = f"{name}-inside"
            elif name in MAIN_TAGS and marked:
                sign = f"{name}-worded"
            other = sign in OTHER_TAGS or marked and sign != "main-worded"
            signs = [f"tag={sign}"] * (sign in TELLING) + [f"word={w}" for w in sorted(words) if len(w) <= 30]
            place = tree.add(blocks[-1], sign, signs + [f"lean={w}" for w in sorted(leans)])
            blocks.append(place)
            if mains and marked and (made := _ID_ONLY.match(found[3])):
                ids[place] = "-".join(w.lower() for w in _WORD.findall(made[1]))
        stack.append((name, place, other))
        open_tags[name] += 1
        mains += name in MAIN_TAGS
        others += other
        hidden += name in UNSEEN
        anchors += name == "a"
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            stop = end.start() if end else len(page)
            say(page[at:stop])
            at = stop
    while len(stack) > 1:
        pop()
    flush()
    _compare(tree, ids)
    return tree


def _compare(tree: Tree, ids: dict[int, str]) -> None:
    """Signs that rest on later parts of a page: ids made from a title, marked elements beside others."""
    for k, tag in enumerate(tree.tags):
        box = tree.parents[tree.parents[k]] if tag == "#text" else -1
        if box in ids and tree.tags[tree.parents[k]] in HEADINGS and ids[box] == "-".join(map(str.lower, _WORD.findall(tree.texts[k]))):
            tree.signs[box] = [s for s in tree.signs[box] if s[5:] not in OTHER_WORDS or s[5:] in TITLES]
    marks = [k for k, tag in enumerate(tree.tags) if tag in MAIN_TAGS or tag in WORDED_TAGS]
    for k in marks if len(marks) > 1 else ():
        if tree.tags[k] in WORDED_TAGS and not any(s[5:] in MAIN_WORDS for s in tree.signs[k]):
            tree.signs[k].append("beside")


def author_labels(tree: Tree) -> list[int] | None:
    """Content or not of each node as the page's own marks have it; None for a page that marks no content."""
    # The only element that a page marks as content is content whatever its words; so the words' prior counts can be outweighed.
    own = [tag in MAIN_TAGS or tag in WORDED_TAGS for tag in tree.tags]
    if sum(own) > 1:
        own = [tag in MAIN_TAGS for tag in tree.tags]
    if not any(own):
        return None
    labels: list[int] = []
    for parent, tag, main, signs in zip(tree.parents, tree.tags, own, tree.signs, strict=True):
        inside = labels[parent] if parent >= 0 else 0
        worded = any(s[5:] in OTHER_WORDS for s in signs if s[:5] in ("word=", "lean="))
        other = tag in OTHER_TAGS or f"word={UNSHOWN}" in signs or worded and not main
        labels.append(0 if other else 1 if main else inside)
    return labels


def observed(tree: Tree, labels: list[int]) -> Counter:
    """The signs and the parent-child labels of one page."""
    found: Counter = Counter()
    for parent, tag, label, signs in zip(tree.parents, tree.tags, labels, tree.signs, strict=True):
        found.update((s, label) for s in signs)
        if parent >= 0:
            found[f"from={labels[parent]}{tag in PARTS}", label] += 1
    return found


@dataclass
class ContentModel:
    """Log likelihood ratios of the signs, and P(child is content | parent) for children among PARTS and others."""

    signs: dict[str, float]
    given_other: dict[bool, float]
    given_content: dict[bool, float]

    def marginals(self, tree: Tree) -> list[float]:
        """Log odds of being content, by messages from the leaves up and from the root down.

        Nodes stand in page order, so every child comes after its parent: one pass backwards, one forwards. More than CROWD
        children of one tag are alike for reasons of their own, so each then says less to the parent.
        """
        own = [sum(map(self.signs.get, signs, [0.0] * len(signs))) for signs in tree.signs]
        n = len(own)
        part = [tag in PARTS for tag in tree.tags]
        alike = Counter(zip(tree.parents, tree.tags, strict=True))
        sent = [0.0] * n
        for k in range(n - 1, 0, -1):
            a, b = self.given_other[part[k]], self.given_content[part[k]]
            ratio = math.exp(max(-500.0, min(500.0, own[k])))
            sent[k] = math.log((1 - b + b * ratio) / (1 - a + a * ratio)) * min(1.0, CROWD / alike[tree.parents[k], tree.tags[k]])
            own[tree.parents[k]] += sent[k]
        belief = own[:]
        for k in range(1, n):
            a, b = self.given_other[part[k]], self.given_content[part[k]]
            odds = math.exp(max(-500.0, min(500.0, belief[tree.parents[k]] - sent[k])))
            belief[k] = own[k] + math.log((a + b * odds) / (1 - a + (1 - b) * odds))
        return belief

    def main_text(self, page: str | None) -> str:
        """The blocks that are likelier content than not, in page order."""
        tree = parse(page or "")
        odds = self.marginals(tree)
        return "\n\n".join(t for t, o in zip(tree.texts, odds, strict=True) if t is not None and o > 0)


def learn(pages: DataFrame, sample: int = SAMPLE) -> ContentModel:
    """Count signs and parent-child labels on about ``sample`` pages whose authors mark their content.

    Pages are picked by a hash of their number against the row count. With no marked page the prior counts stand alone.
    """
    step = max(1, pages.count() // sample)
    picked = pages.where(F.col("page_id").isNotNull()).where(F.pmod(F.xxhash64("page_id"), F.lit(step)) == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                tree = parse(value.as_py() or "")
                labels = author_labels(tree)
                if labels is None:
                    continue
                found.update(observed(tree, labels))
        rows = list(found.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int32()),
             pa.array([n for _, n in rows], pa.int64())], names=["sign", "label", "n"],
        )

    sums = picked.select("html").mapInArrow(count, "sign string, label int, n long").groupBy("sign", "label").agg(F.sum("n").alias("n"))
    counts: Counter = Counter()
    for row in sums.where(F.col("n") >= RARE).orderBy(F.desc("n"), "sign", "label").limit(MOST_SIGNS).collect():
        counts[row.sign, row.label] += row.n
    return _model(counts)


def _model(counts: Counter) -> ContentModel:
    """Log ratios of the counts with one half added; shares for the signs that every run of text has."""
    counts.update({(f"word={word}", 1): PRIOR for word in MAIN_WORDS})
    counts.update({(f"{kind}={word}", 0): PRIOR for word in OTHER_WORDS for kind in ("word", "lean")})
    times = {f"word={word}": 1.0 for word in MAIN_WORDS}
    times |= {f"{kind}={word}": LISTED for word in OTHER_WORDS for kind in ("word", "lean")}
    weights = {}
    for sign in {s for s, _ in counts if not s.startswith("from=")}:
        ratio = math.log((counts[sign, 1] + 0.5) / (counts[sign, 0] + 0.5))
        kind = sign[: sign.index("=") + 1]
        ratio *= times.get(sign, 1.0)
        bound = abs(ratio) if sign in times else OTHER
        if kind == "run=":
            bound = RUN
            all_of = [sum(n for (s, k), n in counts.items() if k == label and s.startswith(kind)) for label in (0, 1)]
            ratio -= math.log((all_of[1] + 1) / (all_of[0] + 1))
        weights[sign] = max(-bound, min(bound, ratio))
    weights |= {f"tag={tag}": MARK for tag in MAIN_TAGS} | {f"tag={tag}": -MARK for tag in OTHER_TAGS}
    weights |= {f"tag={tag}": WORDED for tag in WORDED_TAGS} | {"beside": -BESIDE, f"word={UNSHOWN}": -2 * MARK}

    def share(parent: int, part: bool) -> float:
        yes, no = counts[f"from={parent}{part}", 1], counts[f"from={parent}{part}", 0]
        return max(1 - STICK, min(STICK, (yes + (100 if parent else 1)) / (yes + no + 101)))

    return ContentModel(weights, *[{part: share(parent, part) for part in (False, True)} for parent in (0, 1)])


def extract(pages: DataFrame, model: ContentModel | None = None) -> DataFrame:
    """page_id, url, text and n_chars of each page, from its whole html.

    Character references are decoded, white space inside a block becomes one blank, blocks are joined by an empty line.
    A null or empty page, or one without content, has an empty text. Rows are treated one by one: repeated rows repeat, an
    empty table gives no rows; other columns aren't read.
    """
    model = model or learn(pages)

    @F.pandas_udf("string")
    def main_text(values: pd.Series) -> pd.Series:
        return values.map(model.main_text)

    found = pages.select("page_id", "url", main_text("html").alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
