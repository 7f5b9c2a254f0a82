"""Main text of web pages: the contiguous stretch of words and tags with the highest score.

Words score by where they stand, tags cost something; both weights come from labelled pages,
those whose author marked the article with ``article`` or ``main``; of several, the one with
most words counts. Counts of words inside and outside the marked part are added up over all
pages by place, at most a few thousand rows. A linear scan then finds the stretch of maximal
sum on each page by these weights alone, marked or not. Words in menus, adverts, forms and
the like are left out of the text wherever they stand, and so are comments and teasers that
are articles of their own. A class or id says so only as a whole, "ad" or "cookie-notice"; one
that merely holds such a word, "market-share" or "social-science", has a weight learned like
that of a place, and its words are left out if that is negative.
"""

from __future__ import annotations

import html
import re
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed names of HTML elements and of common page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "aside audio button canvas datalist dialog embed footer form frameset head iframe input map menu nav noembed noframes noscript object option script select style svg "
    "template textarea title video xmp".split()
)
PARTS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu modal nav navbar "
    "navigation newsletter notice notices pagination popup promo promotion related replies share sharing sidebar skip social sponsor sponsored subscribe toolbar widget".split()
)
# words that say where a part stands or how it is built, not what it is
LAYOUT = frozenset(
    "area bar block body bottom box column container footer global group holder inner item items left link links list main mobile outer page panel post posts right row section "
    "site slot sticky top unit wrap wrapper zone".split()
)
ROLES = frozenset("banner complementary contentinfo form menu menubar navigation search alert dialog".split())
MARKED = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FRAMES = frozenset("body center div main other section td th tbody table tr".split())
CLOSED_BY = {  # an element of this name ends at a new one of these
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option", "optgroup"]),
}
KNOWN = INLINE | VOID | RAW | DROPPED | PARTS | frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header html legend li main ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD_PARTS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def tokens(page: str):
    """(kind, name, attributes or text): 'open', 'close', 'text'; comments and declarations left out."""
    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            yield "text", "", page[at:]
            return
        if m.start() > at:
            yield "text", "", page[at : m.start()]
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            yield "close", name, ""
            continue
        yield "open", name, m[3]
        if name in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else size


def _part_of(name: str, attributes: str) -> tuple[bool, str]:
    """Whether an element is a dropped part, and else the part's name that its class or id holds beside other words."""
    if name in DROPPED:
        return True, ""
    if not attributes or name in ("html", "body"):
        return False, ""
    hint = ""
    for m in _MARK.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value.strip() in ROLES:
                return True, ""
            continue
        for token in value.split():
            words = _WORD_PARTS.findall(token)
            parts = [w for w in words if w in PARTS]
            if parts and all(w in PARTS or w in LAYOUT for w in words):
                return True, ""
            hint = hint or (parts[0] if parts else "")
    return bool(_HIDDEN.search(attributes)), hint


class Piece:
    """A run of text in one block: its words' place, whether it belongs to a dropped part, and the part's name that an element around it holds."""

    __slots__ = ("block", "place", "text", "marked", "dropped", "hint")

    def __init__(self, block, place, text, marked, dropped, hint=""):
        self.block, self.place, self.text, self.marked, self.dropped, self.hint = block, place, text, marked, dropped, hint


def _main_mark(found: list, ends: dict[int, int], drop: dict[int, bool]) -> tuple[int, int]:
    """Opening of the marked article, and of the innermost mark that holds most of it; -1 if there is none.

    The article is the mark with most words outside dropped parts. One that lies in a dropped
    part, or is one by its class, counts if it holds more than twice the words outside these.
    """
    size = len(found)
    words = [0]
    for kind, _, rest in found:
        words.append(words[-1] + (len(rest.split()) if kind == "text" else 0))

    def held(i: int) -> int:
        return words[ends.get(i, size)] - words[i]

    free, within, outside = [], [], 0
    gone = in_mark = at = 0  # ends of the dropped part and of the mark reached so far
    for i, (kind, name, _) in enumerate(found):
        if kind != "open":
            continue
        dropped = drop[i] and not (name == "header" and i < in_mark)
        if dropped and i >= gone:
            outside, at = outside + words[i] - words[at], ends.get(i, size)
            gone = at
        elif dropped:
            more = ends.get(i, size)
            if more > gone:  # elements that overlap
                gone = at = more
        if name in MARKED:
            (free if i >= gone else within).append(i)
            in_mark = max(in_mark, ends.get(i, size))
    outside += words[size] - words[at]
    best = max(free, key=held, default=-1)  # the outermost of equals
    other = max(within, key=held, default=-1)
    if other >= 0 and held(other) > 2 * outside:
        best = other
    if best < 0 or not held(best):
        return -1, -1
    inner = best
    marks = free + within
    for _ in range(64):
        marks = [i for i in marks if inner < i < ends.get(inner, size)]
        most = max(marks, key=held, default=-1)
        if most < 0 or 2 * held(most) <= held(inner):
            break
        inner = most
    return best, inner


def parse(page: str) -> tuple[list, bool]:
    """Events of a page in order, and whether it has a marked article.

    An event is a Piece or the name of a tag. Elements left open end where their parent does
    or where an element starts that cannot stand in them.
    """
    found = list(tokens(page))
    ends: dict[int, int] = {}
    open_at: list[tuple[str, int]] = []
    for i, (kind, name, _) in enumerate(found):
        if kind == "open" and name not in VOID:
            open_at.append((name, i))
        elif kind == "close":
            for k in range(len(open_at) - 1, max(-1, len(open_at) - 64), -1):
                if open_at[k][0] == name:
                    for _, j in open_at[k:]:
                        ends[j] = i
                    del open_at[k:]
                    break

    parts_at = {i: _part_of(name, rest) for i, (kind, name, rest) in enumerate(found) if kind == "open"}
    dropping_at = {i: part or found[i][1] == "header" for i, (part, _) in parts_at.items()}
    outer, frame = _main_mark(found, ends, dropping_at)

    events: list = []
    stack: list[tuple[str, bool, bool]] = []  # name, whether a dropped part starts here, whether the marked one does
    hints: list[tuple[int, str]] = []  # depth in the stack and part's name of the elements around
    drops = marks = block = articles = 0
    linked = 0
    for i, (kind, name, rest) in enumerate(found):
        while hints and hints[-1][0] >= len(stack):
            hints.pop()
        hint = hints[-1][1] if hints else ""
        if kind == "text":
            if rest.strip():
                inner = next((n for n, _, _ in reversed(stack) if n not in INLINE), "body")
                place = f"{'a:' if linked else ''}{inner if inner in KNOWN else 'other'}"
                events.append(Piece(block, place, rest, marks > 0, drops > 0, hint))
            else:
                events.append(Piece(block, "", " ", marks > 0, drops > 0, hint))
            continue
        if kind == "open":
            while stack and name in CLOSED_BY.get(_last_block(stack), ()):
                while True:
                    gone, was_drop, was_mark = stack.pop()
                    drops, marks, linked, articles = drops - was_drop, marks - was_mark, linked - (gone == "a"), articles - (gone in MARKED)
                    if gone not in INLINE:
                        break
                block += 1
            if name == "br":
                events.append(Piece(block, "", " ", marks > 0, drops > 0, hint))
            if name not in INLINE:
                block += 1
            if not drops and (name == "a" or name not in INLINE):  # a dropped part costs one tag, whatever it holds
                events.append(name if name in KNOWN else "other")
            if name in VOID or (rest.endswith("/") and name not in KNOWN):
                continue
            drop = dropping_at[i]
            if name == "header":
                drop = not articles  # an article's own heading belongs to it
            if drop and name not in RAW:
                # an element that holds the marked article is a frame around it, not a part
                drop = not i <= frame < ends.get(i, len(found))
            mark = i == outer and not drops
            if parts_at[i][1] and not i <= frame < ends.get(i, len(found)):
                hints.append((len(stack), parts_at[i][1]))
            stack.append((name, drop, mark))
            drops, marks, linked, articles = drops + drop, marks + mark, linked + (name == "a"), articles + (name in MARKED)
            continue
        dropping = drops
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                for gone, was_drop, was_mark in stack[k:]:
                    drops, marks, linked, articles = drops - was_drop, marks - was_mark, linked - (gone == "a"), articles - (gone in MARKED)
                    if gone not in INLINE:
                        block += 1
                del stack[k:]
                break
        if not dropping and (name == "a" or name not in INLINE):
            events.append("/" + name if name in KNOWN else "/other")
        if name not in INLINE:
            block += 1
    return events, any(isinstance(e, Piece) and e.marked and not e.dropped and e.place for e in events)


def _last_block(stack: list) -> str:
    for name, _, _ in reversed(stack):
        if name not in INLINE:
            return name
    return ""


def _counts(batches):
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for page in batch.column("html").to_pylist():
            events, labelled = parse(page or "")
            if not labelled:
                continue
            inside = [i for i, e in enumerate(events) if isinstance(e, Piece) and e.marked and e.place]
            first, last = inside[0], inside[-1]
            for i, e in enumerate(events):
                if isinstance(e, str):
                    counts.setdefault("<" + e, [0, 0])[0 if first <= i <= last else 1] += 1
                elif e.place and not e.dropped:
                    n, side = len(e.text.split()), 0 if e.marked else 1
                    counts.setdefault(e.place, [0, 0])[side] += n
                    if e.hint:
                        counts.setdefault("." + e.hint, [0, 0])[side] += n
        names = sorted(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([counts[n][0] for n in names], pa.int64()), pa.array([counts[n][1] for n in names], pa.int64())], ["feature", "inside", "outside"]
        )


def fit_weights(counts: list[tuple[str, int, int]]) -> dict[str, float]:
    """Weights by feature; ``word``, ``heading`` and ``link`` for unseen places of words, ``tag`` for unseen tags.

    A part's name (with a full stop before it) weighs like a place, and nothing when unseen.

    A word weighs the log of how much likelier its place is inside, between -4 and 2; frames
    without a meaning of their own never weigh less than unseen places. A tag always costs
    something, between 0.02 and 1.5.
    """
    words = {f: (i, o) for f, i, o in counts if not f.startswith("<")}
    tags = {f: (i, o) for f, i, o in counts if f.startswith("<")}
    out = {"word": 0.5, "heading": 1.0, "link": -0.5, "tag": -0.2}
    for f, (i, o) in words.items():
        out[f] = max(out["word"] if f in FRAMES else -4.0, min(2.0, log((i + 1) / (o + 1))))
    for f, (i, o) in tags.items():
        out[f] = -max(0.02, min(1.5, log((o + 1) / (i + 1))))
    return out


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """The contiguous stretch of highest sum, [start, end); the first of equals, and (0, 0) if no sum is positive."""
    best = total = 0.0
    start, span = 0, (0, 0)
    for i, score in enumerate(scores):
        total += score
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, span = total, (start, i + 1)
    return span


def main_blocks(page: str, weights: dict[str, float]) -> list[str]:
    """Text blocks of the best stretch of a page."""
    events, _ = parse(page)
    scores = []
    for e in events:
        if isinstance(e, str):
            scores.append(weights.get("<" + e, weights["tag"]))
            continue
        e.dropped = e.dropped or weights.get("." + e.hint, 0.0) < 0
        weight = weights.get(e.place, weights["link" if e.place.startswith("a:") else "heading" if e.place in HEADINGS else "word"])
        scores.append(weight * len(e.text.split()) if e.place and not e.dropped else 0.0)
    span = best_stretch(scores)
    blocks: list[str] = []
    parts: list[str] = []
    block = None
    # blocks are kept whole
    reached = [e.block for e in events[span[0] : span[1]] if isinstance(e, Piece) and e.place and not e.dropped]
    first, last = (reached[0], reached[-1]) if reached else (0, -1)
    for e in events:
        if isinstance(e, Piece) and first <= e.block <= last and not e.dropped:
            if e.block != block and parts:
                blocks.append("".join(parts))
                parts = []
            block = e.block
            parts.append(e.text)
    blocks.append("".join(parts))
    texts = (_SPACE.sub(" ", html.unescape(b)).strip() for b in blocks)
    return [t for t in texts if t]


def _extract(weights: dict[str, float], names: list[str]):
    def run(batches):
        for batch in batches:
            texts = ["\n\n".join(main_blocks(page or "", weights)) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(texts, pa.string())], [*names, "text"])

    return run


def main_text(pages: DataFrame, html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all but the page) and ``_text``, the main text of each page.

    Character references are decoded, white space within a block becomes one space, blocks are
    joined by two line feeds in page order. NULL, empty and wordless pages, and pages without
    a stretch of positive score, have an empty text. Pages are read whole, one at a time. Without
    any labelled page, fixed weights hold: words 0.5, words of headings 1, of links -0.5, tags -0.2. No rows: no rows.
    """
    carry = [c for c in pages.columns if c != html_col] if carry is None else carry
    names = [f"_c{i}" for i in range(len(carry))]
    rows = pages.select(*[F.col(c).alias(n) for c, n in zip(carry, names, strict=True)], F.col(html_col).cast("string").alias("html"))
    counted = rows.select("html").mapInArrow(_counts, "feature string, inside long, outside long")
    counted = counted.groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    weights = fit_weights([tuple(r) for r in counted.orderBy("feature").collect()])  # one row per known place or tag
    schema = ", ".join(f"{n} {pages.schema[c].dataType.simpleString()}" for n, c in zip(names, carry, strict=True))
    out = rows.mapInArrow(_extract(weights, names), f"{schema + ', ' if schema else ''}text string")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, carry, strict=True)], F.col("text").alias("_text"))
