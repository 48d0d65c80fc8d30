"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: the text between one block-level tag and the next, with the path of open tags over it. Each block becomes
a vector of its tag path (names of tags, classes and ids, hashed), of its words (hashed), and of a few measures. A bidirectional
LSTM in numpy reads the whole sequence of a page, so every block is judged in the context of all others, and says for each whether it
belongs to the article. The blocks it takes are the text.

Pages have no labels, so the network is trained on labels that the pages' own structure gives where it is explicit (inside an article
element, inside navigation, and so on), on at most `SAMPLE` pages, and on as many made-up arrangements of the words of these pages in which
such elements are missing or named otherwise. What it learned is then applied to every page; the rules are not.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import share

#: Most pages to train on, those with the least hashes; each is read whole.
SAMPLE = 300
PATHS, WORDS, MEASURES = 96, 32, 6
HIDDEN = 20
EPOCHS = 14
#: Pages that are read side by side.
BATCH = 64

# Element names of HTML by the way they are treated.
BLOCKS = frozenset(
    """address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_CONTENT = frozenset("annotation annotation-xml head iframe noscript object script style svg template textarea title".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
DRAWN = frozenset(("svg", "math"))  # elements in which, and on which, a slash before the end closes a tag
CLOSES = {  # an element that opens ends an open one of these, if nothing of the second list stands between
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)[^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""",
    re.DOTALL | re.IGNORECASE | re.VERBOSE,
)
_BARE_VALUE = re.compile(r"""=\s*[^\s"'>]+\Z""")  # a slash at its end belongs to it
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+").findall


@dataclass
class Block:
    path: tuple[str, ...]  # names over the text, outermost first
    text: str
    linked: int  # characters inside links


def blocks(source: str | None) -> list[Block]:
    """The leaf blocks of a page in order, with white space collapsed and character references decoded. Broken markup is read as far as it
    goes; content that is never shown is left out."""
    source = source or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []  # names and path of open elements
    parts: list[str] = []
    state = {"hidden": 0, "links": 0, "linked": 0}

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append(Block(stack[-1][1] if stack else (), text, state["linked"]))
            state["linked"] = 0

    def pop() -> None:
        name, _ = stack.pop()
        state["hidden"] -= name in HIDDEN_CONTENT
        state["links"] -= name == "a"

    def close(names: tuple[str, ...], bounds: tuple[str, ...]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                while len(stack) > i:
                    pop()
                return
            if stack[i][0] in bounds:
                return

    at = 0
    for tag in _TAG.finditer(source):
        if stack and stack[-1][0] == "head" and source[at : tag.start()].strip():
            pop()  # its end tag may be left out, but it holds no text
        if tag.start() > at and not state["hidden"]:
            parts.append(source[at : tag.start()])
            if state["links"]:
                state["linked"] += tag.start() - at
        at = tag.end()
        name = (tag[3] or tag[6] or "").lower()
        if not name:
            continue
        if name == "br":
            parts.append(" ")
        elif name in BLOCKS:
            flush()
        if tag[2] or tag[5]:
            if name == "p" and not any(n == "p" for n, _ in stack):
                continue
            close((name,), ("body", "html") if name not in ("body", "html") else ())
            continue
        if name == "body":
            close(("head",), ("template", "body"))
        elif stack and stack[-1][0] == "head" and name not in IN_HEAD:
            pop()
        if name not in VOID:
            if (tag[4] or "").endswith("/") and not _BARE_VALUE.search(tag[4]) and (name in DRAWN or any(n in DRAWN for n, _ in stack)):
                continue
            if name in BLOCKS:
                close(("p",), ("button", "table", "td", "th", "caption", "object"))
            if name in CLOSES:
                close(*CLOSES[name])
            path = stack[-1][1] if stack else ()
            own = [name]
            for found in _NAMED.finditer(tag[4] or ""):
                own += [x.lower() for x in _NAME(found[1] or found[2] or found[3] or "")]
            stack.append((name, (*path, *own) if name in BLOCKS or len(own) > 1 else path))
            state["hidden"] += name in HIDDEN_CONTENT
            state["links"] += name == "a"
    if stack and stack[-1][0] == "head":
        pop()
    if not state["hidden"]:
        parts.append(source[at:])
    flush()
    return out


def _bucket(name: str) -> int:
    data = name.encode("utf-8", "replace")
    return sum((i + 1) * 31 * b + (b << (i % 5)) for i, b in enumerate(data)) % PATHS


class Features:
    """Vectors of blocks; those of paths are kept, as few differ."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}

    def path(self, names: tuple[str, ...]) -> np.ndarray:
        known = self.paths.get(names)
        if known is None:
            known = np.zeros(PATHS, np.float32)
            known[[_bucket(n) for n in names]] = 1
            if names:
                known[_bucket("leaf-" + names[-1])] = 1
            if len(self.paths) > 10_000:
                self.paths.clear()
            self.paths[names] = known
        return known

    def of(self, page: list[Block]) -> np.ndarray:
        n = len(page)
        out = np.zeros((n, PATHS + WORDS + MEASURES), np.float32)
        if not n:
            return out
        texts = [b.text.encode("utf-8", "replace") for b in page]
        sizes = np.array([len(t) for t in texts])
        found = W.find(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(sizes)]), W.SPACES, fold=True)
        counts = found.counts
        rows = np.repeat(np.arange(n), counts)
        hashed = np.bincount(rows * WORDS + (found.hashes % np.uint64(WORDS)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
        for i, b in enumerate(page):
            out[i, :PATHS] = self.path(b.path)
        out[:, PATHS : PATHS + WORDS] = hashed / np.sqrt(np.maximum(counts, 1))[:, None] / 2
        out[:, -6] = np.log1p(counts) / 4
        out[:, -5] = np.array([b.linked for b in page]) / np.maximum(sizes, 1)
        out[:, -4] = [min(1.0, sum(b.text.count(c) for c in ".!?,") / (1 + k / 8)) for b, k in zip(page, counts, strict=True)]
        out[:, -3] = np.arange(n) / n
        out[:, -2] = [len(b.path) / 16 for b in page]
        out[:, -1] = [b.text[-1] in ".!?" for b in page]
        return out


class Labeller:
    """Two LSTMs, one in either direction, and a logistic output over both."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        size = PATHS + WORDS + MEASURES
        rng = np.random.default_rng(11)
        self.w = weights or {
            f"{name}_{way}": value
            for way in "fb"
            for name, value in (
                ("x", rng.normal(0, 0.15, (size, 4 * HIDDEN)).astype(np.float32)), ("h", rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)),
                ("b", np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)),
            )
        } | {"out": rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32), "out_b": np.zeros(1, np.float32)}

    def _run(self, x: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """States of one direction, (time, page, HIDDEN); beyond a page's end states stay as they are."""
        times, pages, _ = x.shape
        given = x @ self.w[f"x_{way}"] + self.w[f"b_{way}"]
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((times, pages, HIDDEN), np.float32)
        for t in range(times) if way == "f" else range(times - 1, -1, -1):
            z = given[t] + h @ self.w[f"h_{way}"]
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * g
            squashed = np.tanh(new)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, squashed, m))
            c = np.where(m, new, c)
            h = np.where(m, o * squashed, h)
            out[t] = h
        return out

    def _padded(self, pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        longest = max(len(p) for p in pages)
        x = np.zeros((longest, len(pages), PATHS + WORDS + MEASURES), np.float32)
        mask = np.zeros((longest, len(pages)), bool)
        for k, p in enumerate(pages):
            x[: len(p), k], mask[: len(p), k] = p, True
        return x, mask

    def chances(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page the chance of every block; pages of like length are read side by side."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = [k for k in sorted(range(len(pages)), key=lambda k: len(pages[k])) if len(pages[k])]
        begin = 0
        while begin < len(order):
            end = begin + 1
            while end < len(order) and end - begin < BATCH and (len(pages[order[end]]) - len(pages[order[begin]])) * (end - begin) < 4096:
                end += 1
            group = order[begin:end]
            x, mask = self._padded([pages[k] for k in group])
            both = np.concatenate([self._run(x, mask, "f"), self._run(x, mask, "b")], 2)
            chance = 1 / (1 + np.exp(-(both @ self.w["out"] + self.w["out_b"])))
            for j, k in enumerate(group):
                out[k] = chance[: len(pages[k]), j]
            begin = end
        return out

    def learn(self, pages: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Backpropagation through time with Adam steps over shuffled batches."""
        rng = np.random.default_rng(3)
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.w.items()}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(pages))
            for begin in range(0, len(order), 16):
                group = [pages[k] for k in order[begin : begin + 16]]
                x, mask = self._padded([p for p, _ in group])
                y = np.zeros(mask.shape, np.float32)
                for k, (_, labels) in enumerate(group):
                    y[: len(labels), k] = labels
                kept: dict[str, list] = {"f": [], "b": []}
                states = {way: self._run(x, mask, way, kept[way]) for way in "fb"}
                both = np.concatenate([states["f"], states["b"]], 2)
                chance = 1 / (1 + np.exp(-(both @ self.w["out"] + self.w["out_b"])))
                error = np.where(mask, chance - y, 0) / max(1, mask.sum())
                slopes = {"out": np.einsum("tp,tph->h", error, both), "out_b": np.array([error.sum()], np.float32)}
                for k, way in enumerate("fb"):
                    slopes |= self._back(x, way, kept[way], error[:, :, None] * self.w["out"][k * HIDDEN : (k + 1) * HIDDEN])
                step += 1
                for k, slope in slopes.items():
                    first, second = moment[k]
                    first += 0.1 * (slope - first)
                    second += 0.001 * (slope * slope - second)
                    self.w[k] -= (0.01 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def _back(self, x: np.ndarray, way: str, kept: list, down: np.ndarray) -> dict[str, np.ndarray]:
        dh, dc = np.zeros(down.shape[1:], np.float32), np.zeros(down.shape[1:], np.float32)
        dz = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        to_h = np.zeros_like(self.w[f"h_{way}"])
        for t, h, c, i, f, o, g, squashed, m in reversed(kept):
            dh = dh + down[t]
            new_c = dc + dh * o * (1 - squashed**2)
            z = np.concatenate([new_c * g * i * (1 - i), new_c * c * f * (1 - f), dh * squashed * o * (1 - o), new_c * i * (1 - g * g)], 1)
            z = np.where(m, z, 0)
            dz[t] = z
            to_h += h.T @ z
            dh = np.where(m, z @ self.w[f"h_{way}"].T, dh)
            dc = np.where(m, new_c * f, dc)
        flat = dz.reshape(-1, 4 * HIDDEN)
        return {f"x_{way}": x.reshape(len(flat), -1).T @ flat, f"h_{way}": to_h, f"b_{way}": flat.sum(0)}


#: Names that say outright what a part of a page is; used for training labels alone.
ARTICLE = frozenset("article main content post entry story".split())
OTHER = frozenset(
    """ad ads advert advertisement aside banner breadcrumb button comment comments consent cookie footer form header menu nav navbar
    navigation newsletter notice popup promo related reply share sidebar social sponsor subscribe toolbar widget""".split()
)


def structural_labels(page: list[Block]) -> np.ndarray | None:
    """1 for blocks inside an article and nothing else, if the page says which those are. The innermost name counts, but for names of other
    parts around an article."""
    out = np.array([bool(ARTICLE & {*b.path}) and not OTHER & {*b.path} for b in page], np.float32)
    return out if out.any() else None


def _made_up(rng: random.Random, pool: list[str]) -> tuple[str, list[str]]:
    """A page in some arrangement, and the texts of its article."""

    def words(low: int, high: int) -> str:
        return " ".join(rng.choice(pool) for _ in range(rng.randint(low, high)))

    def sentence() -> str:
        return words(4, 18).capitalize() + rng.choice(".....?!")

    def text(most: int = 6) -> str:
        return " ".join(sentence() for _ in range(rng.randint(1, most)))

    def wrap(body: str, *ways: str) -> str:
        way = rng.choice(ways)
        name, _, label = way.partition(".")
        return f'<{name} {rng.choice(("class", "id"))}="{label}">{body}</{name}>' if label else f"<{name}>{body}</{name}>"

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{k}">{words(1, 3)}</a></li>' for k in range(n))

    article, shown = [], []
    for k in range(rng.randint(1, 12)):
        kind = rng.choice(("h2", "li", "blockquote", "pre", "td", "figure")) if k and rng.random() < 0.3 else "p"
        body = words(2, 6) if kind == "h2" else text()
        shown.append(body)
        around = {"td": "<table><tr>{}</tr></table>", "li": "<ul>{}</ul>"}.get(kind, "{}")
        article.append(around.format(f"<{kind}>{body}" + rng.choice(("</" + kind + ">", "" if kind in ("p", "li") else "</" + kind + ">"))))
        if rng.random() < 0.08:
            article.append(wrap(sentence(), "div.ad", "aside.promo", "div.share", "div.related", "aside", "div.newsletter"))
    title = words(2, 8)
    heading = f"<h1>{title}</h1>"
    shown.insert(0, title)
    top = [
        wrap(f"<ul>{links(rng.randint(2, 9))}</ul>", "nav", "div.menu", "div.nav", "ul.navigation", "div.navbar"),
        wrap(f"<p>{words(1, 6)}</p>", "header", "div.header", "div.banner", "div.top"),
        wrap(text(2), "div.ad", "div.notice", "div.cookie-consent", "section.alert", "div.advert", "div.sponsored"),
        wrap(f"<label>{words(1, 2)}</label><input><button>{words(1, 2)}</button>", "form", "form.search", "div.subscribe"),
    ]
    bottom = [
        wrap(f"<h3>{words(1, 3)}</h3><ul>{links(rng.randint(2, 6))}</ul>", "aside", "div.sidebar", "div.related", "div.widget"),
        wrap(f"<h3>{words(1, 2)}</h3>" + "".join(wrap(f"<b>{words(1, 2)}</b><p>{text(3)}</p>", "div.comment", "li.reply", "div.user-comment") for _ in range(rng.randint(1, 5))), "section.comments", "div.comments", "ol.comment-list", "div#discussion"),
        wrap(text(2), "div.ad", "div.promo", "div.newsletter", "div.advertisement", "div.notice"),
        wrap(f"<p>{sentence()}</p>", "footer", "div.footer", "div.copyright"),
    ]
    before = [x for x in top if rng.random() < 0.6]
    after = [x for x in bottom if rng.random() < 0.6]
    if rng.random() < 0.3:
        before.append(after.pop(rng.randrange(len(after)))) if after else None
    body = wrap(heading + "".join(article), "article", "article", "main", "div.content", "div.post", "div.article-body", "div.entry", "section", "div", "div.story")
    return "<html><head><title>t</title></head><body>" + "".join(before) + body + "".join(after) + "</body></html>", shown


def train(sources: list[str | None]) -> dict[str, np.ndarray]:
    """Weights learned from these pages; without any page there are still the made-up ones."""
    features, rng = Features(), random.Random(5)
    pages, pool = [], ["a", "the", "of", "page", "word", "line", "read", "more"]
    for source in sources:
        page = blocks(source)
        pool += [w for b in page[:40] for w in b.text.split()[:40] if w.isalpha()]
        labels = structural_labels(page)
        if labels is not None:
            pages.append((features.of(page), labels))
    for _ in range(max(SAMPLE, len(sources))):
        source, shown = _made_up(rng, pool)
        page, left = blocks(source), list(shown)
        labels = np.zeros(len(page), np.float32)
        for k, b in enumerate(page):
            if b.text in left and not OTHER & {*b.path}:
                left.remove(b.text)
                labels[k] = 1
        pages.append((features.of(page), labels))
    model = Labeller()
    model.learn(pages)
    return model.w


def fit(pages: DataFrame, page: str = "html") -> dict[str, np.ndarray]:
    """Train on the SAMPLE different pages with the least hashes; the hashes are compared first, so that few pages travel."""
    rows = pages.select(F.col(f"`{page}`").alias("html"), F.xxhash64(F.col(f"`{page}`")).alias("h")).where("html IS NOT NULL")
    least = rows.select("h").distinct().orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    chosen = rows.where(F.col("h") <= least).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect() if least is not None else []
    return train([r["html"] for r in chosen])


def extract(pages: DataFrame, weights: dict[str, np.ndarray], page: str = "html", carry: list[str] | None = None) -> DataFrame:
    """Every row as doc (a struct of its columns, or of those named by carry, so no name clashes) with text, the article's blocks in page order joined
    by line feeds. A null or empty page, or one without an article, has the empty text; repeated rows are rows of their own, and an empty table gives
    none."""
    held = share(pages.sparkSession, weights)
    rows = pages.select(F.struct(*(f"`{c}`" for c in carry or pages.columns)).alias("doc"), F.col(f"`{page}`").alias("html"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, features = Labeller(held()), Features()
        for batch in batches:
            column = batch.column(1)
            for row, end, _, _ in W.slices(column):
                found = [blocks(x) for x in column.slice(row, end - row).to_pylist()]
                chances = model.chances([features.of(p) for p in found])
                texts = ["\n".join(b.text for b, c in zip(p, chance, strict=True) if c >= 0.5) for p, chance in zip(found, chances, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(texts, pa.string())], names=["doc", "text"])

    return rows.mapInArrow(work, f"doc {rows.schema['doc'].dataType.simpleString()}, text string")
