"""Main text of web pages by a tree-structured graphical model (operator 6).

Every element of the DOM is a binary variable: main text or not. Node potentials weigh its tag, the
words of its class and id, the length and link share of its own text and whether it has a sentence;
edge potentials weigh the four parent-child states. The weights maximise the likelihood of the
labelled pages in html_pages.py (or of pages the caller gives): gradient ascent on observed minus
expected counts, which come from the same messages that serve prediction. One upward and one
downward sum-product pass give the exact marginal of each element in time linear in the page, and
the text blocks whose element has a marginal of at least 1/2 are the main text.

Character references are decoded, white space inside a block becomes one space, blocks are
joined in page order by a line feed. Script, style, form controls and the head are not text.

Edge cases: null and empty html and pages without main text give an empty text; unclosed and
stray tags follow the usual implied ends; nesting of any depth is handled without recursion;
the head ends at
its end tag, at body and at the first element or text that cannot be in it; `/>` closes svg, math and
what is inside them, and is ignored elsewhere, as in HTML; each run of text outside any block element
but html and body is a node of its own; repeated pages are rows of their own.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpilens.llm.html_pages import PAGES

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style head title noscript template textarea select option button svg iframe object".split())
BLOCK = frozenset(("address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th "
                   "thead tr ul").split())
# An opening tag ends these open elements, up to the nearest element of the second set.
IMPLIED = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"})}
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
FOREIGN = frozenset(("svg", "math"))
LABEL = "data-main"
WORD = re.compile(r"[a-z]+")
SENTENCE = re.compile(r"[.!?…。]['\"»”)]*(\s|$)")


class Dom(HTMLParser):
    """Elements in page order as parallel lists, and the runs of text with their block element."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.names, self.label = ["#page"], [-1], [()], [None]
        self.chars, self.link_chars, self.sentence = [0], [0], [False]
        self.blocks: list[tuple[int, list[str]]] = []
        self.stack, self.block, self.links, self.silent = [0], [0], 0, 0
        self.fresh, self.loose, self.foreign = True, 0, 0
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "head" and any(t != "html" for t in self.tag[1:3]):
            return                                     # a head after the first content is ignored
        if tag == "body":
            self._end_implied({"head"}, set())
        elif tag not in HEAD:
            self._end_head()
        if tag == "br" or tag == "hr":
            self.handle_data(" ")
        if tag in VOID:
            return
        if tag in BLOCK:
            self._end_implied({"p"}, {"table", "td", "th", "body", "article", "section", "div", "li", "blockquote"})
        if tag in IMPLIED:
            self._end_implied(*IMPLIED[tag])
        a = dict(attrs)
        node = self._node(tag, self.stack[-1], tuple(sorted(set(WORD.findall(
            f"{a.get('class') or ''} {a.get('id') or ''} {a.get('role') or ''}".lower())))), a.get(LABEL))
        self.stack.append(node)
        self.links += tag == "a"
        self.silent += tag in SILENT
        self.foreign += tag in FOREIGN
        if tag in BLOCK:
            self.block.append(node)
            self.fresh = True

    def _node(self, tag, parent, names=(), label=None) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.names.append(names)
        self.label.append(label)
        self.chars.append(0)
        self.link_chars.append(0)
        self.sentence.append(False)
        return len(self.tag) - 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.foreign and tag not in VOID:
            self._pop()

    def _end_head(self):
        if self.tag[self.stack[-1]] == "head":
            self._pop()

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        at = next((i for i in range(len(self.stack) - 1, 0, -1) if self.tag[self.stack[i]] == tag), 0)
        while at and len(self.stack) > at:
            self._pop()

    def _pop(self):
        node = self.stack.pop()
        tag = self.tag[node]
        self.links -= tag == "a"
        self.silent -= tag in SILENT
        self.foreign -= tag in FOREIGN
        if tag in BLOCK:
            self.block.pop()
            self.fresh = True

    def _end_implied(self, ends: set, stop: set):
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.tag[self.stack[i]]
            if t in ends:
                while len(self.stack) > i:
                    self._pop()
                return
            if t in stop:
                return

    def handle_data(self, data):
        if data.strip():
            self._end_head()
        if self.silent or not data:
            return
        node = self.block[-1]
        if self.tag[node] in ("#page", "html", "body"):
            if self.fresh or not self.loose:
                if not data.strip():
                    return
                self.loose, self.fresh = self._node("#text", node, (), "1"), True
            node = self.loose
        if self.fresh or self.blocks[-1][0] != node:
            self.blocks.append((node, []))
            self.fresh = False
        self.blocks[-1][1].append(data)
        n = len(data.strip())
        self.chars[node] += n
        if self.links:
            self.link_chars[node] += n
        if SENTENCE.search(data):
            self.sentence[node] = True

    def features(self, i: int) -> list[str]:
        n = self.chars[i]
        share = self.link_chars[i] / n if n else 0
        out = [f"tag={self.tag[i]}", f"size={min(9, n.bit_length())}"]
        if n:
            out += [f"links={int(share * 3.99)}", f"sentence={self.sentence[i]}"]
        return out + [f"name={w}" for w in self.names[i]]


class TreeModel:
    """Log-linear potentials fitted to labelled pages, and exact marginals by sum-product."""

    def __init__(self, pages: list[str], epochs: int = 120, rate: float = 0.5, decay: float = 0.002):
        self.node: dict[str, float] = {}
        self.edge = [[0.0, 0.0], [0.0, 0.0]]
        train = []
        for html in pages:
            d, label = Dom(html), []
            for i in range(len(d.tag)):
                label.append(int(d.label[i]) if d.label[i] in ("0", "1") else (label[d.parent[i]] if i else 0))
            train.append((d, [d.features(i) for i in range(len(d.tag))], label))
        power: dict = {}                               # Adagrad: squared gradients so far
        for _ in range(epochs):
            grad: dict = Counter()
            for d, feats, label in train:
                belief, pairs = self._infer(d, feats)
                for i, fs in enumerate(feats):
                    if i:
                        for f in fs:
                            grad[f] += label[i] - belief[i]
                        grad[label[d.parent[i]], label[i]] += 1
                        for ab, p in pairs[i]:
                            grad[ab] -= p
            for k, g in grad.items():
                old = self.edge[k[0]][k[1]] if isinstance(k, tuple) else self.node.get(k, 0.0)
                g -= decay * old * len(train)
                power[k] = power.get(k, 1e-6) + g * g
                new = old + rate * g / math.sqrt(power[k])
                if isinstance(k, tuple):
                    self.edge[k[0]][k[1]] = new
                else:
                    self.node[k] = new

    def _infer(self, d: Dom, feats: list[list[str]], want_pairs: bool = True):
        """Marginals of every element; with `want_pairs`, also of every parent-child pair. The page itself is not main."""
        n, e = len(d.tag), self.edge
        up = [[0.0, 0.0] for _ in range(n)]            # evidence at and below a node
        for i in range(1, n):
            up[i][1] = sum(self.node.get(f, 0.0) for f in feats[i])
        up[0][1] = -30.0
        sent = [(0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):
            u0, u1 = up[i]
            a, b = _add(e[0][0] + u0, e[0][1] + u1), _add(e[1][0] + u0, e[1][1] + u1)
            top = a if a > b else b
            sent[i] = (a - top, b - top)
            p = up[d.parent[i]]
            p[0] += a - top
            p[1] += b - top
        down = [(0.0, 0.0)] * n                        # evidence outside a node's subtree
        out, pairs = [0.0] * n, [()] * n
        for i in range(n):
            if i:
                p = d.parent[i]
                r0 = down[p][0] + up[p][0] - sent[i][0]
                r1 = down[p][1] + up[p][1] - sent[i][1]
                a, b = _add(r0 + e[0][0], r1 + e[1][0]), _add(r0 + e[0][1], r1 + e[1][1])
                top = a if a > b else b
                down[i] = (a - top, b - top)
                if want_pairs:
                    s = {(x, y): (r0, r1)[x] + e[x][y] + up[i][y] for x in (0, 1) for y in (0, 1)}
                    z = max(s.values())
                    w = {k: math.exp(v - z) for k, v in s.items()}
                    t = sum(w.values())
                    pairs[i] = tuple((k, v / t) for k, v in w.items())
            gap = down[i][0] + up[i][0] - down[i][1] - up[i][1]
            out[i] = 1 / (1 + math.exp(min(700.0, max(-700.0, gap))))
        return out, pairs

    def marginals(self, d: Dom) -> list[float]:
        return self._infer(d, [d.features(i) for i in range(len(d.tag))], False)[0]

    def main_text(self, html: str | None) -> str:
        if not html:
            return ""
        d = Dom(html)
        belief = self.marginals(d)
        lines = (" ".join("".join(parts).split()) for node, parts in d.blocks if belief[node] >= 0.5)
        return "\n".join(x for x in lines if x)


def _add(a: float, b: float) -> float:
    hi, lo = (a, b) if a > b else (b, a)
    return hi + math.log1p(math.exp(lo - hi)) if lo - hi > -700 else hi


def extract_text(pages: DataFrame, labelled: list[str] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) per row of `pages` (page_id, url, html)."""
    model = TreeModel(list(labelled if labelled is not None else PAGES))     # a few hundred weights

    def run(batches):
        for b in batches:
            texts = [model.main_text(h.as_py()) for h in b.column("html")]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", F.col("html").cast("string")).mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
