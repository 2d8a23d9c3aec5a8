"""Main text of web pages: boosted trees over DOM nodes and hierarchical decoding."""

from __future__ import annotations

import functools
import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tidewater.llm.rule_classifier import holds, paths

#: Elements without an end tag, elements whose content is no markup, elements that flow inside a block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg".split())
INLINE = set("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
             "time tt u var br img wbr".split())
#: An element of the first kind ends when one of the second kind begins.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
          "option": {"option"}}
#: Words in tag, class, id and role that tell of furniture and of the article.
FURNITURE = set("nav menu navbar header footer aside sidebar side notice cookie consent banner ad ads advert advertisement sponsor "
                "sponsored promo form newsletter subscribe comment comments reply replies discussion share social related "
                "breadcrumb breadcrumbs pagination pager widget popup modal login search copyright toolbar masthead button".split())
ARTICLE = set("article main content post entry story body text page".split())
#: A tag opens with its name; then come attributes, of which only a value after "=" may be quoted, up to ">".
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
ATTRIBUTE = re.compile(r"[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?)")
N_FEATURES = 15


class Node:
    __slots__ = ("tag", "parent", "kids", "names", "chars", "linked", "stops", "depth", "tags")

    def __init__(self, tag: str, parent: Node | None, names=frozenset()):
        self.tag, self.parent, self.names, self.kids = tag, parent, names, []
        self.chars = self.linked = self.stops = self.tags = 0
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.kids.append(self)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """Text runs ("text", text, ""), start tags ("start", name, class, id and role) and end tags ("end", name, "") in page order.

    Every position is read a bounded number of times, whatever is left open. As in browsers, a tag, comment or script that the
    page never ends takes the rest; a quote that is never closed is part of an unquoted value. Other elements without markup
    inside (``RAW``) lose their tag only when they never end; a self-closed one is empty.
    """
    at = start = 0
    endless = set()
    while (at := page.find("<", at)) >= 0:
        m = TAG.match(page, at)
        if m is None and page[at + 1:at + 2] not in ("!", "?", "/"):
            at += 1
            continue
        if at > start:
            yield "text", page[start:at], ""
        if m is None:
            mark = "-->" if page.startswith("<!--", at) else ">"
            end = page.find(mark, at + 2)
            at = start = end + len(mark) if end >= 0 else len(page)
            continue
        at, name, told = m.end(), m[2].lower(), []
        while (x := ATTRIBUTE.match(page, at)) and not x[1]:
            at = x.end()
            if x[2].lower() in ("class", "id", "role"):
                told.append(x[3] or x[4] or x[5] or "")
        at = start = x.end() if x else len(page)
        if x is None:
            break
        if m[1]:
            yield "end", name, ""
        elif name not in RAW:
            yield "start", name, " ".join(told).lower()
        elif page[at - 2] != "/" and name not in endless:
            end = raw_end(page, at, name)
            if end < 0 and name not in ("script", "style"):
                endless.add(name)
            else:
                at = start = end if end >= 0 else len(page)
    if start < len(page):
        yield "text", page[start:], ""


def raw_end(page: str, at: int, name: str) -> int:
    """The position after the end tag of a raw element that began before ``at``, -1 without one; drawings may be nested."""
    depth, last = 1, -1
    for m in re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])", re.I).finditer(page, at):
        if m[1]:
            depth, last = depth - 1, m.end()
        elif name == "svg" and page[page.find(">", m.end()) - 1] != "/":
            depth += 1
        if depth == 0:
            break
    return -1 if last < 0 else page.find(">", last) + 1 or len(page)


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """Block elements in page order and the text runs with their block; a None block ends a run. Broken markup is closed as browsers do.

    A block that begins or ends closes the inline elements open in its parent, so only those of the innermost block are kept.
    """
    root = Node("#", None)
    nodes, runs, blocks, inline, held = [root], [], [root], [], Counter()

    def close_inline(upto: int = 0) -> None:
        held.subtract(inline[upto:])
        del inline[upto:]

    def close_block() -> None:
        close_inline()
        held[blocks.pop().tag] -= 1

    for kind, name, told in tokens(page):
        node = blocks[-1]
        if kind == "text":
            runs.append((node, entities.unescape(name)))
            n = len(name.strip())
            node.chars += n
            node.linked += n if held["a"] > 0 else 0
            node.stops += sum(map(name.count, ".,;?!"))
        elif kind == "end":
            if held[name] <= 0:
                continue
            if name in INLINE:
                close_inline(max(i for i, x in enumerate(inline) if x == name))
                continue
            while blocks[-1].tag != name:
                close_block()
            close_block()
            runs.append((None, ""))
        elif name in VOID:
            if name in ("br", "hr"):
                runs.append((node, " ") if name == "br" else (None, ""))
        elif name in INLINE:
            inline.append(name)
            held[name] += 1
            node.tags += 1
        else:
            if node.tag == "p" or node.tag in CLOSES.get(name, ()):
                close_block()
            close_inline()
            blocks.append(Node(name, blocks[-1], frozenset(re.split(r"[^a-z]+", f"{name} {told}"))))
            held[name] += 1
            nodes.append(blocks[-1])
            runs.append((None, ""))
    return nodes, runs


def features(nodes: list[Node]) -> np.ndarray:
    """One row per block element: subtree density, attribute tokens (own and inherited), depth and siblings."""
    total, linked, stops, tags = ({id(n): getattr(n, a) for n in nodes} for a in ("chars", "linked", "stops", "tags"))
    for n in reversed(nodes):
        if n.parent:
            for d in (total, linked, stops, tags):
                d[id(n.parent)] += d[id(n)]
            tags[id(n.parent)] += 1
    out, bad, good = np.zeros((len(nodes), N_FEATURES)), {}, {}
    page = max(total[id(nodes[0])], 1)
    place = {id(k): i for n in nodes for i, k in enumerate(n.kids)}
    alike = {id(n): Counter(k.tag for k in n.kids) for n in nodes}
    for i, n in enumerate(nodes):
        p = n.parent
        own_bad, own_good = len(n.names & FURNITURE), len(n.names & ARTICLE)
        bad[id(n)], good[id(n)] = (own_bad + bad[id(p)], own_good + good[id(p)]) if p else (own_bad, own_good)
        size, kin = total[id(n)], len(p.kids) if p else 1
        out[i] = (math.log1p(size), size / page, linked[id(n)] / max(size, 1), stops[id(n)] / max(size, 1), math.log1p(n.chars),
                  tags[id(n)] / max(size, 1) * 100, own_bad, bad[id(n)] - own_bad, own_good, good[id(n)] - own_good, n.depth,
                  kin, place.get(id(n), 0) / kin, alike[id(p)][n.tag] / kin if p else 1.0,
                  n.tag in ("p", "h1", "h2", "h3", "blockquote", "pre", "li", "td"))
    return out


def layouts(pages: int, seed: int = 11) -> Iterator[tuple[str, str]]:
    """Generated pages of many layouts with the main text of each: the training set, as pages carry no labels."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(2, 9)))
    say = lambda lo, hi: " ".join(word() for _ in range(rng.integers(lo, hi))) + "."
    links = lambda: "".join(f'<li><a href="/x">{say(1, 4)}</a></li>' for _ in range(rng.integers(3, 9)))
    name = lambda *xs: str(rng.choice(xs))
    box = lambda t, c, x: f"<{t}>{x}</{t}>" if c is None else f'<{t} {name("class", "id")}="{c}">{x}</{t}>'

    def furniture() -> list[str]:
        return [box(*rng.permutation([["nav", ""], ["div", name("menu", "nav-bar", "navbar")]])[0], f"<ul>{links()}</ul>"),
                box("header", "site", f"<p>{say(2, 8)}</p>") if rng.random() < 0.5 else box("div", "header", f"<h2>{say(2, 6)}</h2>"),
                box("div", name("ad", "ads", "advert", "sponsored", "promo banner"), say(4, 30)),
                box("aside", None, f"<h3>{say(1, 4)}</h3><p>{say(5, 40)}</p>") if rng.random() < 0.5 else box("div", "sidebar", f"<p>{say(5, 40)}</p>"),
                box("div", name("cookie-notice", "notice", "consent"), f"<p>{say(5, 25)}</p>"),
                box("form", None, f"<label>{say(1, 3)}</label><input><button>{say(1, 2)}</button>"),
                box("div", name("related", "share social", "newsletter"), f"<p>{say(4, 20)}</p>")]

    for k in range(pages):
        several = rng.integers(60, 200) if k % 25 == 24 else rng.integers(1, 9)
        paragraphs = [say(*((2, 8) if rng.random() < 0.2 else (8, 90 if several < 60 else 30))) for _ in range(several)]
        title = say(2, 9)
        tags = [name("p", "p", "p", "p", "li", "blockquote", "h2") for _ in paragraphs]
        inside = [f"<h1>{title}</h1>"] + [f"<ul><li>{x}</li></ul>" if t == "li" else f"<{t}>{x}</{t}>" for t, x in zip(tags, paragraphs)]
        if rng.random() < 0.4:
            inside.insert(int(rng.integers(1, len(inside) + 1)), furniture()[int(rng.integers(2, 7))])
        main = box(*[("article", None), ("main", None), ("div", name("content", "post", "entry", "story")), ("div", None)][int(rng.integers(4))], "".join(inside))
        extra = [x for x in furniture() if rng.random() < 0.6]
        cut = int(rng.integers(0, len(extra) + 1))
        after = [box(name("section", "div"), name("comments", "comment-list", "replies", "discussion"), "".join(
            box("div", name("comment", "reply"), f"<p>{say(3, 60)}</p>") for _ in range(rng.integers(1, 5))))] if rng.random() < 0.5 else []
        foot = [box("footer", None, say(3, 12)) if rng.random() < 0.6 else box("div", "footer", f"<p>{say(3, 12)}</p>")]
        yield (f"<html><head><title>{title}</title></head><body>{''.join(extra[:cut])}{main}{''.join(extra[cut:] + after + foot)}</body></html>",
               "\n".join([title, *paragraphs]))


@functools.cache
def train(pages: int = 250, trees: int = 40, depth: int = 3) -> list[tuple[tuple, float]]:
    """Boosted trees as weighted paths (leaves and inner nodes): a node counts as content if some of its text is."""
    xs, ys = [], []
    for page, main in layouts(pages):
        nodes, runs = parse(page)
        wanted, has = set(main.split("\n")), {id(n): False for n in nodes}
        for n, t in runs:
            if n is not None and t.strip() in wanted:
                while n is not None:
                    has[id(n)], n = True, n.parent
        xs.append(features(nodes))
        ys += [has[id(n)] for n in nodes]
    x, y = np.concatenate(xs), np.array(ys, float)
    f, model = np.zeros(len(y)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        grown = paths(x, y - p, depth, 20)
        leaves = [r for r in grown if not any(len(o) > len(r) and o[:len(r)] == r for o in grown)]
        for rule in leaves:
            hit = holds(rule, x)
            step = 0.3 * float((y - p)[hit].sum() / max((p * (1 - p))[hit].sum(), 1.0))
            f[hit] += step
            model.append((rule, step))
    return model


def main_texts(pages: list[str | None], model) -> list[str]:
    """The main text of each page; the trees see the nodes of all pages at once."""
    parsed = [parse(p) if p else None for p in pages]
    found = [features(x[0]) for x in parsed if x]
    if not found:
        return [""] * len(pages)
    x = np.concatenate(found)
    f = np.zeros(len(x))
    for rule, step in model:
        f[holds(rule, x)] += step
    out, at = [], 0
    for page in parsed:
        n = len(page[0]) if page else 0
        out.append(chosen(*page, f[at:at + n]) if page else "")
        at += n
    return out


def chosen(nodes: list[Node], runs: list, f: np.ndarray) -> str:
    """The kept blocks. An element that goes takes its descendants along; the best consistent choice is found bottom up."""
    keep = {id(n): -math.log1p(math.exp(-v)) if v > -30 else v for n, v in zip(nodes, f)}
    drop = {id(n): -math.log1p(math.exp(v)) if v < 30 else -v for n, v in zip(nodes, f)}
    best = {}
    for n in reversed(nodes):
        for k in n.kids:
            best[id(k)] = keep[id(k)] > drop[id(k)]
            keep[id(n)] += max(keep[id(k)], drop[id(k)])
            drop[id(n)] += drop[id(k)]
    taken = {id(nodes[0]): keep[id(nodes[0])] > drop[id(nodes[0])]}
    for n in nodes[1:]:
        taken[id(n)] = taken[id(n.parent)] and best[id(n)]
    blocks, now, block = [], [], None
    for n, t in [*runs, (None, "")]:
        if n is None or n is not block:
            blocks.append(" ".join("".join(now).split()))
            now = []
        block = n
        if n is not None and taken[id(n)]:
            now.append(t)
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, model=None) -> DataFrame:
    """page_id, url, text and n_chars for each row; a null or empty page, or one without an article, has an empty text.

    Pages are read 200 at a time; equal rows give equal texts, an empty table gives no rows. A page, however long or broken,
    is read in time in proportion to its length; text outside any block counts as text of the page's root. The model (a few
    hundred numbers) travels with the task. Other columns are left out.
    """
    model = train() if model is None else model

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 200):
                part = batch.iloc[i:i + 200]
                text = main_texts([h if isinstance(h, str) else None for h in part["html"]], model)
                yield part[["page_id", "url"]].assign(text=text, n_chars=[len(t) for t in text])

    return pages.selectExpr("cast(page_id as bigint) as page_id", "cast(url as string) as url", "cast(html as string) as html").mapInPandas(
        run, "page_id long, url string, text string, n_chars long")
