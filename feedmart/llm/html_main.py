"""Main text of a page as a minimum cut over its blocks.

A classifier gives every block a cost for being called content and one for being called boilerplate:
these are the capacities to the two terminals. Blocks next to each other, and consecutive blocks of one
parent, are joined by edges whose capacity falls with the distance in the document tree. The minimum
cut is the labelling of least total cost; it is found by maximum flow, after blocks whose own cost
outweighs all their edges have been decided (which leaves the minimum unchanged).

Each page is cut within its row, so any number of pages spreads over any number of tasks. Defined
results: null, empty and textless pages give an empty text; repeated rows are alike; an empty table
gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import re
from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.llm.html_blocks import Block, blocks

#: Costs are whole numbers, so that flows end.
UNIT = 100
#: Weights of the classifier, in its own units: positive speaks for content.
#: What an element's name or tag says is one cost among others: rich text between content can outvote it.
MARKED = 8.0
TAGS = {"p": 1.0, "h1": 1.0, "h2": 0.5, "h3": 0.5, "blockquote": 1.0, "pre": 1.0, "li": -0.5, "td": -0.3, "dt": -0.3}
LENGTH, SENTENCES, LINKS, NOTICE, OFFSET = 0.1, 0.4, -7.0, -4.0, -1.2
#: Smoothness of neighbours, of the next block of the same parent, and its loss by tree distance.
NEAR, SIBLING, DECAY = 2.0, 1.0, 0.6

_SENTENCE = re.compile(r"[.!?…](?:\s|$)")
_NOTICE = re.compile(r"©|\(c\) ?\d{4}|all rights reserved|cookie|sign (?:in|up)|log ?in\b|subscribe|privacy policy|terms of (?:use|service)", re.I)


def leaning(block: Block) -> float:
    """What the classifier says about one block: above 0 content, below 0 boilerplate."""
    words = block.text.count(" ") + 1
    score = OFFSET + LENGTH * min(words, 40) + SENTENCES * min(len(_SENTENCE.findall(block.text)), 4) + TAGS.get(block.tag, 0.0)
    score += LINKS * block.linked / len(block.text)
    if words < 25 and _NOTICE.search(block.text):
        score += NOTICE
    return score + MARKED * max(-1, block.side)


def edges(found: list[Block]) -> list[tuple[int, int, int]]:
    """(block, block, capacity): neighbours in the page, and the next block of the same parent."""
    out, last = [], {}
    for i, block in enumerate(found):
        if i:
            away = found[i - 1].depth + block.depth - 2 * block.shared
            out.append((i - 1, i, round(UNIT * NEAR * DECAY ** max(0, away - 2))))
        parent = block.parent
        if parent in last and last[parent] != i - 1:
            out.append((last[parent], i, round(UNIT * SIBLING)))
        last[parent] = i
    return [e for e in out if e[2] > 0]


def minimum_cut(costs: list[int], joined: list[tuple[int, int, int]]) -> list[bool]:
    """Label per node (True: content) of least cost. ``costs`` above 0 are paid by a node called
    boilerplate, below 0 by one called content; an edge is paid if its ends differ."""
    n = len(costs)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, w in joined:
        near[a][b] = near[a].get(b, 0) + w
        near[b][a] = near[b].get(a, 0) + w
    left, label = list(costs), [None] * n
    queue = deque(range(n))
    while queue:  # a node whose own cost outweighs its edges is decided, and leans on its neighbours
        i = queue.popleft()
        if label[i] is None and abs(left[i]) >= sum(near[i].values()) and left[i]:
            label[i] = left[i] > 0
            for j, w in near[i].items():
                left[j] += w if label[i] else -w
                del near[j][i]
                queue.append(j)
            near[i].clear()
    open_nodes = [i for i in range(n) if label[i] is None]
    if open_nodes:
        content = _max_flow(open_nodes, left, near)
        for i in open_nodes:
            label[i] = i in content
    return label


def _max_flow(nodes: list[int], costs: list[int], near: list[dict[int, int]]) -> set[int]:
    """The nodes on the content side of a minimum cut, by shortest augmenting levels."""
    source, sink = -1, -2
    room: dict[int, dict[int, int]] = {i: dict(near[i]) for i in nodes} | {source: {}, sink: {}}
    for i in nodes:
        if costs[i] > 0:
            room[source][i], room[i][source] = costs[i], 0
        elif costs[i] < 0:
            room[i][sink], room[sink][i] = -costs[i], 0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            a = queue.popleft()
            for b, r in room[a].items():
                if r > 0 and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if sink not in level:
            return {i for i in level if i != source}
        todo = {a: list(room[a]) for a in level}
        path = [source]
        while path:  # paths along the levels, depth first
            a = path[-1]
            if a == sink:
                flow = min(room[x][y] for x, y in zip(path, path[1:]))
                for x, y in zip(path, path[1:]):
                    room[x][y] -= flow
                    room[y][x] += flow
                cut = next(k for k, (x, y) in enumerate(zip(path, path[1:])) if room[x][y] == 0)
                del path[cut + 1 :]
                continue
            while todo[a] and not (room[a][todo[a][-1]] > 0 and level.get(todo[a][-1]) == level[a] + 1):
                todo[a].pop()
            if todo[a]:
                path.append(todo[a][-1])
            else:
                path.pop()
                if path:
                    todo[path[-1]].pop()


def main_text(html: str | None) -> str:
    """The blocks labelled content, in page order, with an empty line between them."""
    found = blocks(html)
    labels = minimum_cut([round(UNIT * leaning(b)) for b in found], edges(found))
    return "\n\n".join(b.text for b, content in zip(found, labels) if content)


def extracted(html: Column) -> Column:
    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in column], dtype=object)

    return run(F.coalesce(html, F.lit("")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: text and n_chars, its code points."""
    found = pages.select(id_col, url_col, extracted(F.col(html_col)).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
