"""Main text of web pages by a minimum cut between content and boilerplate.

A page is cut into blocks of text at block-level tags. A small linear classifier
(region of the page, words, link density, headings) gives every block the cost of
calling it boilerplate and the cost of calling it content; these are its capacities
to the two terminals. Neighbouring blocks, and consecutive blocks of one parent
element, are joined by smoothness edges that are the heavier the closer the blocks
are in the DOM. The minimum cut labels all blocks of a page at once. Blocks whose
terminal difference exceeds all their edges keep that label in every minimum cut;
they are settled first and only the rest goes to max-flow.

Pages are independent rows: nothing is shuffled, and a task holds one slice of
pages. Null, empty and blank pages, and pages without content, give an empty text.
Malformed markup (unclosed tags, stray end tags, truncated pages) is read the
lenient way browsers do. Nothing is capped. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelark.llm.common import slices, table

_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script|style|noscript|template|textarea|iframe|title"
#: Dropped with what they hold if they are closed.
_DRAWN = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("svg", "annotation", "annotation-xml")}
_AWAY = frozenset("nav footer aside menu dialog button select search header option".split())
_FORMS = frozenset(("form", "fieldset"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SECTIONS = frozenset("nav header footer aside menu".split())
_AWAY_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
_AWAY_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice popup "
    "modal overlay newsletter subscribe subscription signup login sidebar widget comment comments commentlist reply replies disqus "
    "respond nav navbar navigation menu breadcrumb breadcrumbs footer masthead social share sharing related recommended recommendations "
    "toolbar pagination pager skip banner alert".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<raw>" + _RAW + r")\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>(?:.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<(?=/?[a-zA-Z])[^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")

# Weights of the classifier.
INSIDE, OUTSIDE, AWAY, LEADING, LINKED, PER_WORD, MOST_WORDS, HEADING, BASE = 4.0, 4.0, 12.0, 4.0, 3.0, 0.08, 2.0, 1.0, 0.5
# Blocks of so many unlinked words are prose; a name counts fully if the prose elsewhere is this share of that below it.
PROSE, ELSEWHERE = 10, 0.25
# Smoothness: neighbours in page order, and consecutive blocks of one parent.
ADJACENT, SIBLING = 0.4, 0.8


class Mark:
    """An element whose name, or being a form, speaks for boilerplate: a cost, no verdict."""

    __slots__ = ("weight", "holds", "around", "prose", "inside", "cost")

    def __init__(self, weight: float, around: Mark | None):
        # The next such element around this one; whether an <article> or <main> stands in the element.
        self.weight, self.around, self.holds = weight, around, False


class Block:
    """Text of a block with what the classifier needs."""

    __slots__ = ("parts", "linked", "away", "inside", "heading", "parent", "text", "mark")

    def __init__(self, away: bool, inside: bool, heading: bool, parent: int, mark: Mark | None = None):
        self.parts, self.linked, self.mark = [], 0, mark
        self.away, self.inside, self.heading, self.parent = away, inside, heading, parent


def _away(name: str, attrs: str, inside: bool) -> bool:
    if name in _AWAY and not (name == "header" and inside):
        return True
    if not attrs:
        return False
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), (a or b or c).lower()
        if key == "role" and value in _AWAY_ROLES:
            return True
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _named(name: str, attrs: str, inside: bool) -> float:
    """Weight of what class and id names say: AWAY for a whole name, LEADING for the first part of one."""
    found = AWAY if name in _FORMS else 0.0
    if not attrs or name in _HEADINGS or name in ("html", "body", "main"):
        return found
    for key, a, b, c in _ATTR.findall(attrs):
        key = key.lower()
        if key == "role" and (a or b or c).lower() == "form":
            return AWAY
        if key in ("class", "id"):
            for whole in (a or b or c).lower().split():
                lead = next(filter(None, _SPLIT.split(whole)), "")
                if lead in _AWAY_NAMES or (lead == "header" and not inside):
                    found = max(found, AWAY if lead == whole else LEADING)
    return found


def blocks_of(page: str) -> tuple[list[Block], list[Mark]]:
    """The non-empty blocks of a page in order, and its marks, outer ones before those inside."""
    found: list[Block] = []
    made: list[Mark] = []
    # name, away, inside, heading, id, innermost mark
    stack: list[tuple[str, bool, bool, bool, int, Mark | None]] = [("", False, False, False, 0, None)]
    ids, links, block, at = 0, 0, None, 0
    # Open elements by name, so that stray end tags cost nothing; drawings of which no end follows.
    opened: Counter[str] = Counter()
    unclosed: set[str] = set()

    def add(raw: str) -> None:
        nonlocal block
        if block is None:
            if not raw or raw.isspace():
                return
            top = stack[-1]
            # The parent of a block is the element around the one that holds its text.
            block = Block(top[1], top[2], top[3], stack[-2][4] if len(stack) > 1 else 0, top[5])
        block.parts.append(raw)
        if links:
            block.linked += len(raw)

    def close() -> None:
        nonlocal block
        if block is not None:
            block.text = " ".join(html.unescape("".join(block.parts)).split())
            if block.text:
                found.append(block)
            block = None

    def cut(k: int) -> None:
        opened.subtract(s[0] for s in stack[k:])
        del stack[k:]

    while m := _TOKEN.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in _DRAWN and not m["end"] and name not in unclosed:
            if m["attrs"].endswith("/"):
                continue
            if end := _DRAWN[name].search(page, at):
                at = end.end()
                continue
            unclosed.add(name)
        if name == "br":
            add(" ")
        elif name == "a":
            links = 0 if m["end"] else 1
        elif name in _BLOCKS or (
            name not in _VOID
            and m["attrs"]
            and not m["end"]
            and (_away(name, m["attrs"], stack[-1][2]) or _named(name, m["attrs"], stack[-1][2]))
        ):
            close()
            if m["end"]:
                if opened[name]:
                    cut(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name))
                continue
            if name in _VOID:
                continue
            while len(stack) > 1 and (stack[-1][0] in _HEADINGS or stack[-1][0] == "p" or (name == "li" == stack[-1][0])):
                cut(len(stack) - 1)
            if name in ("article", "main"):
                links = 0
                if any(opened[section] for section in _SECTIONS):
                    cut(next(k for k in range(1, len(stack)) if stack[k][0] in _SECTIONS))
            top, ids = stack[-1], ids + 1
            mark = top[5]
            if name in ("article", "main") and mark:
                mark.holds = True
            if weight := _named(name, m["attrs"], top[2]):
                mark = Mark(weight, mark)
                made.append(mark)
            inside = top[2] or name in ("article", "main")
            stack.append((name, top[1] or _away(name, m["attrs"], top[2]), inside, name in ("h1", "h2", "h3"), ids, mark))
            opened[name] += 1
        elif m["end"] and opened[name]:
            close()
            cut(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name))
    if at < len(page):
        add(page[at:])
    close()
    return found, made


def marked_costs(found: list[Block], made: list[Mark], prose: list[float]) -> list[float]:
    """Cost of calling each block content that the marks around it make.

    A mark loses weight as the element holds more of the page's prose, and all of it if
    it holds the only <article> or <main> with prose and half of the page's prose.
    """
    total = articles = 0.0
    for mark in made:
        mark.prose = mark.inside = 0.0
    for b, n in zip(found, prose):
        if b.away:
            continue
        total, articles = total + n, articles + n * b.inside
        if b.mark:
            b.mark.prose += n
            b.mark.inside += n * b.inside
    # Inner marks come after those around them: one pass back adds up what they hold.
    for mark in reversed(made):
        if around := mark.around:
            around.prose += mark.prose
            around.inside += mark.inside
            around.holds |= mark.holds
    for mark in made:
        under = mark.prose
        if mark.holds and mark.inside >= articles and 2 * under >= total:
            own = 0.0
        else:
            own = mark.weight * (min(1.0, (total - under) / (ELSEWHERE * under)) if under else 1.0)
        mark.cost = max(own, mark.around.cost if mark.around else 0.0)
    return [b.mark.cost if b.mark else 0.0 for b in found]


def costs(found: list[Block], made: list[Mark]) -> tuple[list[float], list[float]]:
    """Capacities to the content and the boilerplate terminal."""
    counts = [len(b.text.split()) for b in found]
    density = [min(1.0, b.linked / max(1, sum(map(len, b.parts)))) for b in found]
    free = [n * (1 - d) for n, d in zip(counts, density)]
    marks = marked_costs(found, made, [f if f >= PROSE else 0.0 for f in free])
    # Full weight only if <article> and <main> hold half of the unlinked words.
    within = sum(f for b, f in zip(found, free) if b.inside and not b.away)
    there = sum(f for b, f, mark in zip(found, free, marks) if not b.away and (b.inside or mark < LEADING))
    outside = OUTSIDE * min(1.0, 2 * within / there) if there else OUTSIDE * any(b.inside and not b.away for b in found)
    content, boilerplate = [], []
    for b, n, d, f, mark in zip(found, counts, density, free, marks):
        # Long unlinked text outvotes the first part of a name.
        words = max(min(MOST_WORDS, PER_WORD * n), min(MOST_WORDS + mark, PER_WORD * f) if mark <= LEADING else 0.0)
        content.append(BASE + INSIDE * b.inside + words + HEADING * b.heading)
        boilerplate.append(BASE + max(AWAY * b.away, mark) + LINKED * d * (1 - 0.5 * b.inside) + outside * (not b.inside))
    return content, boilerplate


def edges(found: list[Block]) -> dict[tuple[int, int], float]:
    """Smoothness between neighbours and between consecutive blocks of one parent."""
    weights: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            weights[i - 1, i] = ADJACENT
        if b.parent in last:
            j = last[b.parent]
            weights[j, i] = weights.get((j, i), 0.0) + SIBLING
        last[b.parent] = i
    return weights


def minimum_cut(content: list[float], boilerplate: list[float], weights: dict[tuple[int, int], float]) -> list[bool]:
    """Whether each node lies on the content side of a minimum cut (ties: content)."""
    n = len(content)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), w in weights.items():
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    spare = [c - b for c, b in zip(content, boilerplate)]
    around = [sum(e.values()) for e in near]
    label: list[bool | None] = [None] * n
    # Persistent nodes: their label is the same in every minimum cut.
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(spare[i]) >= around[i]:
            label[i] = spare[i] >= 0
            for j, w in near[i].items():
                if label[j] is None:
                    spare[j] += w if label[i] else -w
                    around[j] -= w
                    queue.append(j)
    open_nodes = [i for i in range(n) if label[i] is None]
    if open_nodes:
        for i, side in _max_flow(open_nodes, spare, near, label).items():
            label[i] = side
    return [bool(x) for x in label]


def _max_flow(nodes: list[int], spare: list[float], near: list[dict[int, float]], label: list) -> dict[int, bool]:
    """Dinic's algorithm on the open nodes; source -1 is content, sink -2 boilerplate."""
    residual: dict[int, dict[int, float]] = {-1: {}, -2: {}}
    for i in nodes:
        residual[i] = {j: w for j, w in near[i].items() if label[j] is None}
        residual[i][-2] = max(0.0, -spare[i])
        residual[i][-1] = 0.0
        residual[-1][i], residual[-2][i] = max(0.0, spare[i]), 0.0
    tiny = 1e-9
    while True:
        level, queue = {-1: 0}, deque([-1])
        while queue:
            u = queue.popleft()
            for v, c in residual[u].items():
                if c > tiny and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if -2 not in level:
            break
        rest = {u: iter(list(residual[u])) for u in level}
        path = [-1]
        while path:
            u = path[-1]
            if u == -2:
                flow = min(residual[a][b] for a, b in zip(path, path[1:]))
                cut = 0
                for k, (a, b) in enumerate(zip(path, path[1:])):
                    residual[a][b] -= flow
                    residual[b][a] = residual[b].get(a, 0.0) + flow
                    if residual[a][b] <= tiny and not cut:
                        cut = k + 1
                # Go back to the first full edge, and try that edge's start again.
                del path[cut:]
                continue
            for v in rest[u]:
                if residual[u][v] > tiny and level.get(v, -1) == level[u] + 1:
                    path.append(v)
                    break
            else:
                path.pop()
    # Nodes that can still reach the boilerplate terminal are boilerplate.
    back, queue = {-2}, deque([-2])
    while queue:
        v = queue.popleft()
        for u in residual[v]:
            if u not in back and residual[u].get(v, 0.0) > tiny:
                back.add(u)
                queue.append(u)
    return {i: i not in back for i in nodes}


def main_text(page: str | None) -> str:
    """Content blocks of a page in order, joined by blank lines."""
    if not page:
        return ""
    found, made = blocks_of(page)
    if not found:
        return ""
    content, boilerplate = costs(found, made)
    keep = minimum_cut(content, boilerplate, edges(found))
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text): the main text of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string")


def html_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


QUERIES = {"op7_html": html_query}
ORACLES: dict[str, str] = {}
