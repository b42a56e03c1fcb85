"""Main text of HTML pages by a recurrent block labeller.

A page is a sequence of text blocks (``leaves.leaves``).  Each block is read as a vector of its
tag path (hashed tags and names of the open elements), a vector of its hashed words, and a few
measures of its text.  A bidirectional LSTM runs over the whole page, so that each block is
classified in the light of all blocks before and after it; blocks classified as article make the
text.

No table labels blocks, so the network is fitted, once per Python process on the driver, on
``PAGES`` made-up pages of random structure whose labels are known (``leaves.Maker``).  It does
not depend on the table: a page's text is the same whatever pages stand beside it, and reruns
agree.  The weights, some hundred KB, are sent to the tasks; each page is labelled in one pass,
nothing is shuffled.

Defined cases: null and empty pages have the empty text; titles of the window, comments, scripts,
styles, templates, text fields and frames are no blocks; repeated rows are extracted each; an
empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricepanel.llm.leaves import TAG_SLOTS, Leaf, Maker, Paths, leaves
from pricepanel.llm.words import text_bytes, words
from pricepanel.session import ship

WORD_SLOTS = 512
TAG_CODE, WORD_CODE, HIDDEN = 16, 8, 16
PAGES = 700
EPOCHS = 14
#: Steps whose inputs are made at once, and pages labelled side by side.
STEPS, SIDE_BY_SIDE = 2048, 64
#: Characters of html read before their blocks are labelled.
PIECE_CHARS = 2_000_000


def _measures(page: list[Leaf]) -> np.ndarray:
    n = len(page)
    out = np.zeros((n, 9), np.float32)
    for k, leaf in enumerate(page):
        t = leaf.text
        size = len(t)
        count = t.count(" ") + 1
        out[k] = (np.log1p(size) / 6, np.log1p(count) / 5, leaf.linked / size, size / count / 10, t[-1] in ".!?", t.count(",") / count, t[:1].isupper(),
                  k / n, k > 0 and page[k - 1].path == leaf.path)
    return out


@dataclass
class Blocks:
    """Features of the blocks of some pages."""

    path: np.ndarray  # row of ``paths`` for each block
    paths: np.ndarray  # tag-path vectors of the distinct paths (as slots or as codes)
    words: np.ndarray
    measures: np.ndarray
    first: np.ndarray  # first block of each page, and their number


def word_bags(texts: list[str], codes: np.ndarray | None) -> np.ndarray:
    """Hashed words of each text: their shares, or the mean of their codes."""
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    w = words(data, offsets, trimmed=True)
    slots = (w.hashes % np.uint64(WORD_SLOTS)).astype(np.int64)
    n = np.maximum(1, w.counts)[:, None].astype(np.float32)
    if codes is None:
        bag = np.zeros((len(texts), WORD_SLOTS), np.float32)
        np.add.at(bag, (w.doc, slots), 1)
        return bag / n
    out = np.zeros((len(texts), codes.shape[1]), np.float32)
    full = np.flatnonzero(w.counts)
    if len(full):
        out[full] = np.add.reduceat(codes[slots], w.first[full], axis=0)
    return out / n


def encode(pages: list[list[Leaf]], paths: Paths, tag_codes: np.ndarray | None = None, word_codes: np.ndarray | None = None) -> Blocks:
    used = sorted({leaf.path for page in pages for leaf in page})
    row = {p: k for k, p in enumerate(used)}
    vectors = np.zeros((len(used), TAG_SLOTS if tag_codes is None else tag_codes.shape[1]), np.float32)
    for k, p in enumerate(used):
        s = paths.slots(p)
        if tag_codes is None:
            vectors[k, s] = 1
        else:
            vectors[k] = tag_codes[s].sum(0)
    flat = [leaf for page in pages for leaf in page]
    return Blocks(np.array([row[leaf.path] for leaf in flat], np.int64), vectors, word_bags([leaf.text for leaf in flat], word_codes),
                  np.concatenate([_measures(page) for page in pages] or [np.empty((0, 9), np.float32)]), np.concatenate([[0], np.cumsum([len(p) for p in pages])]).astype(np.int64))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _cell(z: np.ndarray, c: np.ndarray) -> tuple:
    i, f, o, g = _sigmoid(z[:, :HIDDEN]), _sigmoid(z[:, HIDDEN:2 * HIDDEN]), _sigmoid(z[:, 2 * HIDDEN:3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])
    c = f * c + i * g
    t = np.tanh(c)
    return o * t, c, (i, f, o, g, t)


class Labeller:
    """Codes of tags and words, an LSTM each way, and a logistic layer."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        width = TAG_CODE + WORD_CODE + 9
        self.p = {"tags": r.normal(0, 0.3, (TAG_SLOTS, TAG_CODE)), "words": r.normal(0, 0.3, (WORD_SLOTS, WORD_CODE)), "out": r.normal(0, 0.2, 2 * HIDDEN), "bias": np.zeros(1)}
        for way in ("f", "b"):
            self.p |= {way + "W": r.normal(0, width**-0.5, (width, 4 * HIDDEN)), way + "U": r.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)), way + "z": np.zeros(4 * HIDDEN)}
            self.p[way + "z"][HIDDEN:2 * HIDDEN] = 1
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def scores(self, b: Blocks) -> np.ndarray:
        """Log odds of every block being article; ``b`` holds codes.  Pages run side by side,
        those of like length together."""
        n = np.diff(b.first)
        out = np.full(len(b.path), self.p["bias"][0], np.float32)
        order = np.argsort(n, kind="stable")
        order = order[n[order] > 0]
        for s in range(0, len(order), SIDE_BY_SIDE):
            pages = order[s:s + SIDE_BY_SIDE][::-1]  # longest first: those still running are a prefix
            begin, size = b.first[pages], n[pages]
            for k, way in enumerate("fb"):
                w, u, z0 = self.p[way + "W"], self.p[way + "U"], self.p[way + "z"]
                h, c = np.zeros((2, len(pages), HIDDEN), np.float32)
                part = self.p["out"][k * HIDDEN:(k + 1) * HIDDEN]
                for a in range(0, int(size[0]), STEPS // len(pages) + 1):
                    steps = np.arange(a, min(int(size[0]), a + STEPS // len(pages) + 1))
                    live = np.searchsorted(-size, -steps, "left")
                    at = np.concatenate([begin[:m] + (t if way == "f" else size[:m] - 1 - t) for t, m in zip(steps, live)])
                    x = np.concatenate([b.paths[b.path[at]], b.words[at], b.measures[at]], 1) @ w + z0
                    lo = 0
                    for m in live.tolist():
                        h2, c2, _ = _cell(x[lo:lo + m] + h[:m] @ u, c[:m])
                        h[:m], c[:m] = h2, c2
                        out[at[lo:lo + m]] += h2 @ part
                        lo += m
        return out

    def gradient(self, b: Blocks, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss and its gradient; ``b`` holds slots."""
        p, n = self.p, np.diff(b.first)
        longest = int(n.max())
        step = np.arange(longest)
        inside = step[:, None] < n
        fore = np.where(inside, b.first[:-1] + step[:, None], 0)
        back = np.where(inside, b.first[1:] - 1 - step[:, None], 0)
        x = np.concatenate([(b.paths @ p["tags"])[b.path], b.words @ p["words"], b.measures], 1)
        logit, kept = np.full(len(y), p["bias"][0], np.float32), {}
        for k, (way, at) in enumerate((("f", fore), ("b", back))):
            z = (x @ p[way + "W"] + p[way + "z"])[at]
            h, c = np.zeros((2, len(n), HIDDEN), np.float32)
            saved_steps, hs = [], np.zeros((longest + 1, len(n), HIDDEN), np.float32)
            for t in range(longest):
                before = c
                h, c, gates = _cell(z[t] + h @ p[way + "U"], c)
                saved_steps.append((before, gates))
                hs[t + 1] = h
            kept[way] = saved_steps, hs, at
            logit[at[inside]] += hs[1:][inside] @ p["out"][k * HIDDEN:(k + 1) * HIDDEN]
        q = _sigmoid(logit)
        loss = float(-np.mean(np.where(y > 0, np.log(q + 1e-7), np.log(1 - q + 1e-7))))
        d = ((q - y) / len(y)).astype(np.float32)
        g = {"bias": np.array([d.sum()], np.float32), "out": np.zeros_like(p["out"])}
        dx = np.zeros_like(x)
        for k, way in enumerate("fb"):
            steps, hs, at = kept[way]
            part = p["out"][k * HIDDEN:(k + 1) * HIDDEN]
            dl = np.where(inside, d[at], 0)
            g["out"][k * HIDDEN:(k + 1) * HIDDEN] = dl.ravel() @ hs[1:].reshape(-1, HIDDEN)
            dz = np.zeros((longest, len(n), 4 * HIDDEN), np.float32)
            dh, dc = np.zeros((2, len(n), HIDDEN), np.float32)
            for t in range(longest - 1, -1, -1):
                before, (i, f, o, c_in, tc) = steps[t]
                dh = dh + dl[t][:, None] * part
                dc = dc + dh * o * (1 - tc * tc)
                dz[t] = np.concatenate([dc * c_in * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - c_in * c_in)], 1)
                dz[t][~inside[t]] = 0
                dh, dc = dz[t] @ p[way + "U"].T, np.where(inside[t][:, None], dc * f, 0)
            g[way + "U"] = hs[:-1].reshape(-1, HIDDEN).T @ dz.reshape(-1, 4 * HIDDEN)
            per_block = np.zeros((len(y), 4 * HIDDEN), np.float32)
            per_block[at[inside]] = dz[inside]
            g[way + "W"], g[way + "z"] = x.T @ per_block, per_block.sum(0)
            dx += per_block @ p[way + "W"].T
        per_path = np.zeros((len(b.paths), TAG_CODE), x.dtype)
        np.add.at(per_path, b.path, dx[:, :TAG_CODE])
        g["tags"], g["words"] = b.paths.T @ per_path, b.words.T @ dx[:, TAG_CODE:TAG_CODE + WORD_CODE]
        return loss, g


def made_pages(n: int, seed: int) -> tuple[list[list[Leaf]], Paths, list[np.ndarray]]:
    maker, paths, pages, labels = Maker(seed), Paths(), [], []
    for _ in range(n):
        page, y = maker.page()
        pages.append(leaves(page, paths))
        labels.append(np.array(y, np.float32))
    return pages, paths, labels


@functools.lru_cache(maxsize=2)
def fitted(pages: int = PAGES, epochs: int = EPOCHS, seed: int = 17, batch: int = 24, rate: float = 6e-3) -> Labeller:
    """The labeller, fitted by Adam on made-up pages; the same for the same arguments."""
    made, paths, labels = made_pages(pages, seed)
    every, y = encode(made, paths), np.concatenate(labels)
    size = np.diff(every.first)
    net, r, moment, square, step = Labeller(), np.random.default_rng(seed), {}, {}, 0
    for epoch in range(epochs):
        # pages of like length run together, the batches in any order
        order = np.argsort(size * r.uniform(0.8, 1.25, len(size)))
        batches = [order[s:s + batch] for s in range(0, len(order), batch)]
        for k in r.permutation(len(batches)):
            pick = batches[k]
            at = np.concatenate([np.arange(every.first[i], every.first[i + 1]) for i in pick])
            used, path = np.unique(every.path[at], return_inverse=True)
            # some tags and words are left out, and all words of some pages, so that none decides alone
            spoken = np.repeat(r.random(len(pick)) < 0.5, size[pick])
            b = Blocks(path, every.paths[used] * (r.random((len(used), TAG_SLOTS)) < 0.9), every.words[at] * spoken[:, None], every.measures[at],
                       np.concatenate([[0], np.cumsum(size[pick])]))
            _, g = net.gradient(b, y[at])
            step += 1
            pace = rate * (1 - step / (epochs * len(batches) + 1))
            for name, d in g.items():
                moment[name] = 0.9 * moment.get(name, 0) + 0.1 * d
                square[name] = 0.99 * square.get(name, 0) + 0.01 * d * d
                net.p[name] = net.p[name] - (pace * (moment[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def label(pages: list[str | None], net: Labeller) -> Iterator[tuple[list[Leaf], np.ndarray]]:
    """The blocks of each page and which of them are article."""
    a = 0
    while a < len(pages):
        paths, read, size = Paths(), [], 0
        while a < len(pages) and (not read or size < PIECE_CHARS):
            read.append(leaves(pages[a], paths))
            size += len(pages[a] or "")
            a += 1
        b = encode(read, paths, net.p["tags"], net.p["words"])
        keep = net.scores(b) > 0
        for k, page in enumerate(read):
            yield page, keep[b.first[k]:b.first[k + 1]]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    spark = pages.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(fitted())
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for b in batches:
            texts = [" ".join(leaf.text for leaf, yes in zip(page, keep) if yes) for page, keep in label(b.column("html").to_pylist(), net)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in src.schema}
    return src.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
