"""Main text of web pages by minimum-cut labelling of their blocks.

A logistic classifier says for each block how likely it belongs to the article; its log odds are the
capacity between the block and one of two terminals, content and boilerplate. Blocks that follow each
other, or that lie below the same near elements, are joined by edges which are weaker the farther
apart they stand in the tree. The minimum cut, found by maximum flow, is the labelling that pays
least for going against the classifier and for parting neighbours.

Pages are not labelled, so the classifier learns from those that mark their parts: blocks inside an
article element against those in navigation, asides, footers, forms and parts named as such. Each
block is shown twice, once without that mark, so that the rest of the features learns to do without.
Weights start from ``PRIOR`` and are drawn to it, which is also the classifier without any page.
"""

from __future__ import annotations

import math
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.html_blocks import ASIDE, MAIN, NOWHERE, Block, blocks_of

#: The classifier is fitted on the blocks of at most so many pages, in the order of a hash of page_id,
#: and on at most so many blocks of a page, spread evenly over it.
TRAINING_PAGES, TRAINING_BLOCKS = 2_000, 200
#: Feature names and the weights that training starts from.
PRIOR = {
    "one": -0.5, "in_main": 5.0, "in_aside": -6.0, "linked": -3.0, "log_words": 0.4, "ends_sentence": 0.8,
    "commas": 0.4, "paragraph": 0.6, "heading": 0.4, "item": -0.4, "signs": -1.5, "share": 0.8,
}
#: Strength of the pull to the prior, what all training rows together weigh against it, and steps of
#: the fit. Pages of one make never speak so loud that an unseen mark counts for nothing.
RIDGE, EVIDENCE, STEPS = 4.0, 300.0, 30
#: Weight of the edge of two neighbours one step apart; of blocks below one element, parent, grandparent.
FOLLOWS, NEAR = 1.0, (0.8, 0.5, 0.25)
#: Log odds are cut off here: no block outweighs any number of neighbours.
MOST = 12.0
#: Pages scored at once.
PAGES = 256
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
SIGNS = ("©", "®", "|", "»", "›")


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block."""
    plain = [len(b.text) - b.linked for b in blocks]
    total = max(sum(plain), 1)
    rows = []
    for block, own in zip(blocks, plain):
        words = block.text.count(" ") + 1
        rows.append((
            1.0, block.place == MAIN, block.place == ASIDE, block.linked / len(block.text), math.log(words),
            block.text[-1] in ".!?…:\"”»", min(block.text.count(",") / words * 10, 2.0),
            block.tag in ("p", "blockquote", "pre"), block.tag in HEADINGS, block.tag in ("li", "option", "dt", "button"),
            any(s in block.text for s in SIGNS), min(own / total * 4, 1.0),
        ))
    return np.array(rows, float).reshape(-1, len(PRIOR))


def fit_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, drawn to the prior; both labels weigh the same."""
    prior = np.array(list(PRIOR.values()))
    w, counts = prior.copy(), np.bincount(y.astype(int), minlength=2)
    if not counts.all():
        return w
    rows = (min(EVIDENCE, len(y)) / (2 * counts))[y.astype(int)]
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (rows * (p - y)) + RIDGE * (w - prior)
        bend = (x * (rows * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def training_rows(blocks: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the marked blocks of a page, with and without the mark."""
    x = features(blocks)
    place = np.array([b.place for b in blocks], int)
    marked = np.flatnonzero(place != NOWHERE)
    if len(marked) > TRAINING_BLOCKS:
        marked = marked[np.linspace(0, len(marked) - 1, TRAINING_BLOCKS).astype(int)]
    shown, y = x[marked], (place[marked] == MAIN).astype(float)
    blind = shown.copy()
    names = list(PRIOR)
    blind[:, [names.index("in_main"), names.index("in_aside")]] = 0
    return np.concatenate([shown, blind]), np.concatenate([y, y])


def edges(blocks: list[Block]) -> dict[tuple[int, int], float]:
    """Smoothness between blocks (i, j), i before j; several reasons for one edge add up."""
    out: dict[tuple[int, int], float] = {}
    for j, block in enumerate(blocks):
        if j:
            out[j - 1, j] = FOLLOWS / max(block.steps, 1)
        for i, weight in zip(block.near, NEAR):
            if i >= 0:
                out[i, j] = out.get((i, j), 0.0) + weight
    return out


def minimum_cut(odds: np.ndarray, joined: dict[tuple[int, int], float]) -> np.ndarray:
    """Which blocks are content: the labelling of least cost, where going against ``odds`` costs
    their size and parting two joined blocks the weight of their edge.

    A block whose odds outweigh all its edges keeps its own label, whatever the rest, and hands its
    edges on to its neighbours' odds; flow runs over what is left then. Of several least cuts the one
    with the fewest content blocks is taken.
    """
    n = len(odds)
    cost = odds.astype(float).tolist()
    around: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), weight in joined.items():
        around[i][j] = around[j][i] = weight
    content = np.zeros(n, bool)
    open_ = [True] * n
    loose = [sum(a.values()) for a in around]
    queue = deque(i for i in range(n) if abs(cost[i]) > loose[i] or not around[i])
    while queue:
        i = queue.popleft()
        if not open_[i]:
            continue
        open_[i] = False
        content[i] = cost[i] > 0
        for j, weight in around[i].items():
            if open_[j]:
                cost[j] += weight if content[i] else -weight
                loose[j] -= weight
                if abs(cost[j]) > loose[j]:
                    queue.append(j)
    left = [i for i in range(n) if open_[i]]
    if left:
        content[left] = _source_side(left, cost, {i: {j: w for j, w in around[i].items() if open_[j]} for i in left})
    return content


def _source_side(nodes: list[int], cost: list[float], around: dict[int, dict[int, float]]) -> list[bool]:
    """Maximum flow by shortest augmenting paths in phases; the blocks that content still reaches."""
    tiny = 1e-9
    spare = {i: max(cost[i], 0.0) for i in nodes}  # from the content terminal
    drain = {i: max(-cost[i], 0.0) for i in nodes}  # to the other one
    rest = {i: dict(around[i]) for i in nodes}  # an edge can carry its weight either way
    while True:
        level = {i: 0 for i in nodes if spare[i] > tiny}
        queue, met = deque(level), False
        while queue:
            i = queue.popleft()
            met = met or drain[i] > tiny
            for j, room in rest[i].items():
                if room > tiny and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not met:
            return [i in level for i in nodes]
        ways = {i: iter(list(rest[i])) for i in level}
        for source in [i for i in level if level[i] == 0]:
            path = [source]
            while path and spare[source] > tiny:
                i = path[-1]
                if drain[i] > tiny:
                    flow = min([spare[source], drain[i], *(rest[a][b] for a, b in zip(path, path[1:]))])
                    spare[source] -= flow
                    drain[i] -= flow
                    for a, b in zip(path, path[1:]):
                        rest[a][b] -= flow
                        rest[b][a] += flow
                    full = next((k for k, (a, b) in enumerate(zip(path, path[1:])) if rest[a][b] <= tiny), None)
                    if full is not None:
                        del path[full + 1 :]
                    continue
                for j in ways[i]:
                    if rest[i][j] > tiny and level.get(j) == level[i] + 1:
                        path.append(j)
                        break
                else:
                    path.pop()


def main_blocks(blocks: list[Block], odds: np.ndarray) -> list[bool]:
    return minimum_cut(np.clip(odds, -MOST, MOST), edges(blocks)).tolist() if blocks else []


def fit_extractor(pages: DataFrame, html: str = "html", key: str = "page_id", most: int = TRAINING_PAGES) -> np.ndarray:
    """Weights of the classifier, fitted on at most ``most`` pages; ``PRIOR`` where none is marked."""
    chosen = (
        pages.where(F.col(key).isNotNull()).select(F.col(key).alias("_chosen")).distinct()
        .orderBy(F.xxhash64("_chosen"), "_chosen").limit(most)
    )
    sample = (
        pages.join(F.broadcast(chosen), F.col(key) == F.col("_chosen"))  # at most ``most`` ids
        .groupBy("_chosen").agg(F.min(html).alias("html"))
    )

    def describe(batches):
        for batch in batches:
            for page in batch.column("html"):
                x, y = training_rows(blocks_of(page.as_py() or ""))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(y), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"]
                )

    rows = sample.select("html").mapInArrow(describe, "label double, x array<double>").toArrow()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(PRIOR))
    y = rows["label"].to_numpy()
    order = np.lexsort((*x.T, y))  # sums do not depend on the order of tasks
    return fit_weights(x[order], y[order])


def with_main_text(pages: DataFrame, weights: np.ndarray, html: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of each page: its content blocks in page order, joined by a space.

    Whole pages are read; a null or empty page, or one without content, has an empty text. Rows that
    repeat count each, an empty table stays empty, a column of that name is replaced.
    """

    def run(batches):
        for batch in batches:
            texts: list[str] = []
            column = batch.column(html)
            for low in range(0, len(column), PAGES):
                pages = [blocks_of(page.as_py() or "") for page in column.slice(low, PAGES)]
                odds = np.concatenate([np.empty((0, len(PRIOR))), *map(features, pages)]) @ weights
                ends = np.cumsum([0, *map(len, pages)]).tolist()
                for blocks, a, b in zip(pages, ends, ends[1:]):
                    texts.append(" ".join(x.text for x, kept in zip(blocks, main_blocks(blocks, odds[a:b])) if kept))
            yield batch.append_column(name, pa.array(texts, pa.string()))

    kept = pages.drop(name) if name != html else pages
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(name, T.StringType())]))


def op12_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Main text of every page and its length in code points."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return with_main_text(pages, fit_extractor(pages)).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
