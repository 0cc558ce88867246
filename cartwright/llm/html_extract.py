"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing and threshold clustering.

``html.parser`` streams events. A line is a block of text between block-level tags, with its text length, the tags inside
it and the share of link text. Ratios are smoothed with a Gaussian over neighbouring lines; lines above the standard
deviation of the smoothed ratios seed clusters of content, and the region with most text is the page's content from its first to
its last seed. Elements that are never article text (menus, forms, scripts, ...) are left out by tag before. The page's own mark
(``article``, ``main``) is a weight: marked lines count ``MARK`` times in ratios and in the comparison of clusters, and make
one cluster. If that wins, all marked lines are kept; clusters next to the winner stay when they hold a third of its weighted text.

Elements with a noise word in class, id or role are judged after the page is read, inner ones first: one that holds more weighted
text than the rest of the page, in more than one line or with marked lines in it, is a frame around the content and stays. Comments are never
frames, and articles in or among comments are no mark. If nothing else is left, the noise stays.

Defined cases: null, empty and tag-only pages give an empty text; unclosed and stray tags are tolerated; plain text
without tags is one line and kept; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "script style noscript template head title nav header footer aside form button select option textarea input label "
    "iframe object embed svg canvas video audio map dialog menu fieldset datalist output progress meter math".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dir div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ARTICLE = frozenset(["article", "main"])
MARK = 2  # weight of text that the page marks as its article
_CLOSES_P = BLOCKS - {"br"}
# Words in class, id or role that mark parts which are not article text.
_NOISE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|nav|navbar|navigation|"
    r"menu|menubar|breadcrumb|breadcrumbs|header|masthead|footer|sidebar|aside|complementary|contentinfo|widget|related|recommended|"
    r"share|sharing|social|comment|comments|disqus|respond|replies|reply|cookie|cookies|consent|notice|notices|gdpr|popup|"
    r"modal|overlay|newsletter|subscribe|subscription|signup|login|search|pagination|pager|toolbar|tags|alert|disclaimer|"
    r"skip|copyright|outbrain|taboola)(?:$|[\s_-]|\d)",
    re.I,
)

_COMMENTS = re.compile(r"(?:^|[\s_-])(?:comment|comments|disqus|respond|replies|reply)(?:$|[\s_-]|\d)", re.I)
# Words that describe a frame and not a part: what it has, how it is filed, whether comments are open.
_STATES = re.compile(
    r"(?:^|(?<=\s))(?:(?:has|with|without|no|tag|category)[-_]\S+|comments?[-_](?:open|closed|enabled|disabled))(?=\s|$)", re.I
)


class _Line:
    __slots__ = ("parts", "tags", "linked", "marked", "noise")

    def __init__(self, marked: bool, noise: int):
        self.parts: list[str] = []
        self.tags = 0
        self.linked = 0
        self.marked = marked
        self.noise = noise  # innermost element with a noise word, 0 for none


class LineParser(HTMLParser):
    """Collects the lines of a page; text inside left-out elements is not seen."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.open: list[tuple[str, bool, bool, int]] = []  # element, left out, article, noise element before (-1: no noise)
        self.parents: list[int] = [0]  # of noise elements, by number
        self.comments: list[bool] = [False]  # noise elements that are comments or inside of them
        self.out = self.links = self.inside = self.noise = 0
        self.line = _Line(False, 0)

    def _break(self) -> None:
        if self.line.parts or self.line.tags:
            self.lines.append(self.line)
        self.line = _Line(self.inside > 0, self.noise)

    def _left_out(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in DROPPED:
            return True
        if tag in ARTICLE or tag in ("body", "html"):
            return False
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "style" and value and re.search(r"display\s*:\s*none", value, re.I):
                return True
        return False

    def _noise_words(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
        """Whether the element has a noise word, and one of comments. Articles are judged by the latter only."""
        if tag in ("main", "body", "html"):
            return False, False
        noise = comments = False
        for name, value in attrs:
            if name in ("class", "id", "role") and value and _NOISE.search(value):
                value = _STATES.sub("", value)
                noise = noise or bool(_NOISE.search(value))
                comments = comments or bool(_COMMENTS.search(value))
        return comments if tag in ARTICLE else noise, comments

    def _leave(self, position: int) -> None:
        for tag, out, article, _ in self.open[position:]:
            self.out -= out
            self.inside -= article
            self.links -= tag == "a"
        for *_, before in self.open[position:]:
            if before >= 0:
                self.noise = before
                break
        del self.open[position:]

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSES_P:
            for i in range(len(self.open) - 1, -1, -1):  # an open paragraph ends where a block begins
                if self.open[i][0] == "p":
                    self._leave(i)
                    break
                if self.open[i][0] in BLOCKS:
                    break
        if tag in BLOCKS:
            self._break()
        if not self.out:
            self.line.tags += 1
        if tag in VOID:
            return
        out, article, before = self._left_out(tag, attrs), tag in ARTICLE, -1
        if out:
            self._break()
        elif not self.out:
            noise, comments = self._noise_words(tag, attrs)
            if noise:
                self._break()
                before = self.noise
                self.parents.append(before)
                self.comments.append(comments or self.comments[before])
                self.noise = len(self.parents) - 1
        self.open.append((tag, out, article and not self.out and not out and not self.comments[self.noise], before))
        self.out += out
        self.inside += self.open[-1][2]
        self.links += tag == "a"
        if article or before >= 0:
            self._break()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if tag in BLOCKS or any(x[1] or x[2] or x[3] >= 0 for x in self.open[i:]):
                    self._break()
                    self._leave(i)
                    self.line = _Line(self.inside > 0, self.noise)
                else:
                    self._leave(i)
                break
        if not self.out:
            self.line.tags += 1

    def handle_data(self, data):
        if not self.out:
            self.line.parts.append(data)
            if self.links:
                self.line.linked += len(data)


def without_noise(parser: LineParser, lines: list[tuple[str, int, int, bool, int]]) -> list[tuple[str, int, int, bool, int]]:
    """``lines`` (text, tags, linked, marked, noise element) outside of noise elements that are not frames around the content."""
    n = len(parser.parents)
    weight, count, marks = [0] * n, [0] * n, [False] * n
    for text, _, _, marked, noise in lines:
        weight[noise] += len(text) * (MARK if marked else 1)
        count[noise] += 1
        marks[noise] |= marked
    rest, gone = sum(weight), [False] * n
    for e in range(n - 1, 0, -1):  # inner elements have larger numbers
        if not parser.comments[e] and 2 * weight[e] > rest and (count[e] > 1 or marks[e]):
            up = parser.parents[e]
            weight[up] += weight[e]
            count[up] += count[e]
            marks[up] |= marks[e]
        else:
            gone[e] = True
            rest -= weight[e]
    for e in range(1, n):
        gone[e] |= gone[parser.parents[e]]
    return [x for x in lines if not gone[x[4]]] or lines


def smooth(values: list[float], sigma: float = 1.0) -> list[float]:
    """Gaussian smoothing over neighbouring lines, weights renormalised at the ends."""
    reach = max(1, math.ceil(2 * sigma))
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        weight = total = 0.0
        for d, k in zip(range(i - reach, i + reach + 1), kernel):
            if 0 <= d < len(values):
                weight += k
                total += k * values[d]
        out.append(total / weight)
    return out


def content_lines(texts: list[str], tags: list[int], linked: list[int], marked: list[bool], sigma: float = 1.0) -> list[int]:
    """Lines of the content region by clustered text-to-tag ratios, in order."""
    factor = [MARK if m else 1 for m in marked]
    ratios = [f * max(0, len(t) - l) / max(1, g) for t, g, l, f in zip(texts, tags, linked, factor)]
    level = smooth(ratios, sigma)
    mean = sum(level) / len(level)
    limit = min(math.sqrt(sum((x - mean) ** 2 for x in level) / len(level)), mean) if len(level) > 1 else 0.0
    seeds = [i for i, (x, r) in enumerate(zip(level, ratios)) if x >= limit and r > 0]
    if not seeds:
        return list(range(len(texts)))
    # Clusters of seeds: a run ends where more than `gap` lines in a row are below the threshold, and at the edge of the mark.
    gap, runs, before = 3, [], [0]
    for m in marked:
        before.append(before[-1] + m)
    for i in (i for i in seeds if not marked[i]):
        if runs and i - runs[-1][1] <= gap + 1 and before[i] == before[runs[-1][1]]:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    # Every cluster with its lines and its weighted text; the marked lines are one.
    clusters = []
    for first, last in runs:
        size = sum(len(t) for t in texts[first : last + 1])
        # A heading directly above the region belongs to it.
        while first > 0 and ratios[first - 1] > 0 and not marked[first - 1]:
            first -= 1
        while last < len(texts) - 1 and ratios[last + 1] > 0 and not marked[last + 1]:
            last += 1
        lines = [i for i in range(first, last + 1) if linked[i] < 0.7 * len(texts[i])]
        if lines:
            clusters.append((size, lines))
    if before[-1]:
        size = sum(MARK * len(texts[i]) for i in seeds if marked[i])
        clusters.append((size, [i for i, m in enumerate(marked) if m]))
    most, best = max(clusters, key=lambda c: c[0], default=(0, []))
    kept, near = set(best), {i + d for i in best for d in range(-gap - 1, gap + 2)}
    for size, lines in clusters:
        if 3 * size >= most and marked[lines[0]] != marked[best[0]] and not near.isdisjoint(lines):
            kept.update(lines)
    return sorted(kept)


def extract(html: str | None, sigma: float = 1.0) -> str:
    """Main text of one page."""
    if not html:
        return ""
    parser = LineParser()
    parser.feed(html)
    parser.close()
    parser._break()
    lines = []
    for line in parser.lines:
        text = " ".join("".join(line.parts).split())
        if text:
            lines.append((text, line.tags, line.linked, line.marked, line.noise))
    if not lines:
        return ""
    lines = without_noise(parser, lines)
    return " ".join(lines[i][0] for i in content_lines(*[[x[k] for x in lines] for k in range(4)], sigma))


def extract_pages(pages: DataFrame, sigma: float = 1.0) -> DataFrame:
    """page_id, url, text, n_chars of every page; a narrow pass without a shuffle."""
    key = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py(), sigma) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {key}, url string, text string, n_chars long")
