"""HTML extraction by minimum-cut labelling.

A classifier on text features prices each block as content and as boilerplate; menus, forms, adverts and the like
around a block shift its price. The prices are the capacities of its edges to the two terminals. Elements
that speak for content (an article, a class ``story``) are nodes too, priced as content. Smoothness
edges join neighbours in page order, blocks of the same element, and blocks with the element that holds them: so what
an element says can be outvoted by the blocks in it, and a block's text by what it stands among. The minimum
cut is the labelling of least total price; max-flow finds it.

The classifier is fitted on pages whose tags and names say what a block is (``fit``); it never sees them, so it
learns how text of either kind looks. It is unsure of short blocks (one-word paragraphs, captions); these get
their label from what they stand among.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidepool.llm.common import text_of
from tidepool.llm.html_blocks import Block, blocks

# Evidence of tags and names, in nats.
HOLDER_TAG = 40.0       # an article or the like is content
HOLDER_NAME = 8.0       # an element of such a name is; of either, plus HELD per block in it that is not in links
AGAINST = -6.0          # in a menu, advert, form, ...
OUTSIDE = -6.0          # not in the article that the page has
MOST = 3.0              # what the text alone can say, either way
# Smoothness.
NEXT = 0.6              # neighbours in page order
SAME_PARENT = 0.8       # neighbours among the blocks of one element
HELD = 2.0              # a block and the element that speaks for it
STRANGERS = 0.05        # neighbours of which one alone has evidence against it

FIT_PAGES = 2_000       # pages fitted on, about
PRIOR_BLOCKS = 200.0    # how many blocks the weights before fitting are worth
MOST_LOG = 7            # log2 of words, at most


class Classifier(NamedTuple):
    """Log odds of content by what a block's text looks like."""

    bias: float = -2.6
    words: float = 0.8      # per log2(1 + words)
    linked: float = -3.0    # all of it in links
    sentence: float = 0.6   # ends like a sentence
    heading: float = 0.9


def features(block: Block) -> tuple[int, int, int, int]:
    """(log2 of words, fourths in links, ends like a sentence, is a heading): few distinct values, so counts are enough to fit."""
    words = len(block.text.split())
    return (min(MOST_LOG, round(math.log2(1 + words))), round(4 * min(1.0, block.linked / len(block.text))),
            int(block.text.endswith((".", "!", "?", ":", "…", "。"))), int(block.tag[:1] == "h" and block.tag[1:].isdigit()))


def score(block: Block, weights: Classifier = Classifier()) -> float:
    """Log odds that the block is content."""
    log_words, linked, sentence, heading = features(block)
    text = (weights.bias + weights.words * log_words + weights.linked * linked / 4 + weights.sentence * sentence
            + weights.heading * heading)
    return max(-MOST, min(MOST, text)) + AGAINST * min(block.against, 1) + OUTSIDE * block.outside


def _against(block: Block) -> bool:
    return block.against > 0 or block.outside


def smoothness(page: list[Block]) -> dict[tuple[int, int], float]:
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for k, block in enumerate(page):
        near = {k - 1: NEXT} if k else {}
        if block.parent in last:
            near[last[block.parent]] = near.get(last[block.parent], 0.0) + SAME_PARENT
        for j, weight in near.items():
            edges[j, k] = STRANGERS if _against(page[j]) != _against(block) else weight
        last[block.parent] = k
    return edges


def min_cut(scores: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """The labels (True: content) of least price: max(0, -score) for content, max(0, score) for
    boilerplate, and an edge's weight where its ends differ. Of equal cuts, the least content."""
    n = len(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (a, b), w in edges.items():
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    rest, label = list(scores), [None] * n
    # A block whose own price outweighs all its edges has its label in a minimum cut; its edges become
    # prices of its neighbours.
    queue = deque(range(n))
    while queue:
        k = queue.popleft()
        if label[k] is not None or abs(rest[k]) <= sum(near[k].values()):
            continue
        label[k] = rest[k] > 0
        for j, w in near[k].items():
            rest[j] += w if label[k] else -w
            del near[j][k]
            queue.append(j)
        near[k] = {}
    left = [k for k in range(n) if label[k] is None]
    if all(rest[k] > 0 for k in left) or all(rest[k] <= 0 for k in left):
        for k in left:
            label[k] = rest[k] > 0
    else:
        for k, content in _max_flow(left, rest, near).items():
            label[k] = content
    return [bool(x) for x in label]


def _max_flow(nodes: list[int], scores: list[float], near: list[dict[int, float]]) -> dict[int, bool]:
    """Dinic's algorithm; the source's side of the cut is content."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {k: dict(near[k]) for k in nodes}
    room[source], room[sink] = {}, {}
    for k in nodes:
        if scores[k] > 0:
            room[source][k], room[k][source] = scores[k], 0.0
        elif scores[k] < 0:
            room[k][sink], room[sink][k] = -scores[k], 0.0
    tiny = 1e-9
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            k = queue.popleft()
            for j, r in room[k].items():
                if r > tiny and j not in level:
                    level[j] = level[k] + 1
                    queue.append(j)
        if sink not in level:
            return {k: k in level for k in nodes}
        todo = {k: iter(list(v)) for k, v in room.items()}
        path = [source]
        while path:
            k = path[-1]
            if k == sink:
                push = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= push
                    room[b][a] = room[b].get(a, 0.0) + push
                full = next(i for i, (a, b) in enumerate(zip(path, path[1:])) if room[a][b] <= tiny)
                # Go on from the first edge that is full; its start looks at it again and passes on.
                del path[full + 1:]
                continue
            for j in todo[k]:
                if room[k].get(j, 0.0) > tiny and level.get(j) == level[k] + 1:
                    path.append(j)
                    break
            else:
                path.pop()


def labels(found: list[Block], weights: Classifier = Classifier()) -> list[bool]:
    """Whether each block of a page is content."""
    scores, edges = [score(b, weights) for b in found], smoothness(found)
    nodes: dict[int, int] = {}
    for k, block in enumerate(found):
        if block.holder and not _against(block):
            if block.holder not in nodes:
                nodes[block.holder] = len(scores)
                scores.append(HOLDER_TAG if block.in_tag else HOLDER_NAME)
            edges[k, nodes[block.holder]] = HELD
            # Short text is no sign against an article, however much of it there is; links are.
            scores[nodes[block.holder]] += HELD * (2 * block.linked <= len(block.text))
    return min_cut(scores, edges)[:len(found)]


def main_text(page: str, weights: Classifier = Classifier()) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, content in zip(found, labels(found, weights)) if content)


_COUNTS = "log_words int, linked int, sentence int, heading int, content boolean, n bigint"


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        seen: dict[tuple, int] = {}
        for page in batch["_mincut_html"]:
            for block in blocks(page):
                if _against(block) or block.inside:  # what has no evidence has no label
                    row = (*features(block), not _against(block))
                    seen[row] = seen.get(row, 0) + 1
        yield pd.DataFrame([(*row, n) for row, n in seen.items()], columns=[c.split()[0] for c in _COUNTS.split(", ")])


def fit(pages: DataFrame, html: str = "html", rows: int = FIT_PAGES) -> Classifier:
    """A classifier fitted on about ``rows`` pages, drawn by hash (all, if there are no more): logistic regression, both kinds
    of blocks weighing the same, starting weights worth ``PRIOR_BLOCKS`` blocks.

    The label of a block is what tags and names around it say; its features are its text's alone. The driver
    gets one row per distinct feature and label, some hundreds at most, whatever the pages. Without blocks of
    both kinds the starting weights stay.
    """
    texts = pages.select(text_of(html).alias("_mincut_html"))
    total = texts.count()
    if total > rows:
        texts = texts.filter(F.pmod(F.xxhash64("_mincut_html"), F.lit(1 << 30)) < int(rows / total * (1 << 30)))
    counts = texts.mapInPandas(_count, _COUNTS).groupBy("log_words", "linked", "sentence", "heading", "content").agg(F.sum("n").alias("n"))
    found = sorted(tuple(r) for r in counts.collect())
    return _regress(found)


def _regress(found: list[tuple]) -> Classifier:
    """Newton's method on counts (features..., label, n), with a normal prior about the starting weights."""
    start = np.array(Classifier())
    if len({row[4] for row in found}) < 2:
        return Classifier()
    x = np.array([(1.0, a, b / 4, c, d) for a, b, c, d, _, _ in found])
    y = np.array([float(row[4]) for row in found])
    n = np.array([float(row[5]) for row in found])
    n *= np.where(y > 0, n.sum() / (2 * n[y > 0].sum()), n.sum() / (2 * n[y == 0].sum()))
    w = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - PRIOR_BLOCKS * (w - start)
        bend = (x.T * (n * p * (1 - p))) @ x + PRIOR_BLOCKS * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return Classifier(*(round(float(v), 6) for v in w))


def _extract(batches: Iterator[pd.DataFrame], weights: Classifier) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch["text"] = [main_text(page, weights) for page in batch.pop("_mincut_html")]
        yield batch


def extract(pages: DataFrame, html: str = "html", keep: list[str] | None = None,
            weights: Classifier | None = None) -> DataFrame:
    """The columns ``keep`` of ``pages`` (None: all) plus text, the main text: the content blocks in page
    order, joined by a line feed, white space inside a block turned into one space.

    Without ``weights`` the classifier is fitted on the pages themselves (see ``fit``). Null and empty pages have
    an empty text; a page of boilerplate alone too. A column ``text`` of ``pages`` is replaced. Given the
    weights, rows are independent; repeated rows give repeated results.
    """
    weights = fit(pages, html) if weights is None else weights
    keep = [c for c in (pages.columns if keep is None else keep) if c != "text"]
    of = lambda c: "`" + c.replace("`", "``") + "`"
    carried = F.struct(*(F.col(of(c)) for c in keep)) if keep else F.struct(F.lit(0).alias("none"))
    rows = pages.select(carried.alias("row"), text_of(html).alias("_mincut_html"))
    schema = StructType([rows.schema["row"], StructField("text", StringType())])
    out = rows.mapInPandas(lambda b: _extract(b, weights), schema)
    return out.select(*(F.col("row." + of(c)) for c in keep), "text")
