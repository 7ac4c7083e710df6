"""The main subtree against a plain implementation of the densities, the rules
for wrappers, names and headings, and hostile pages."""

import math
import random
import time

import pytest

from surveywave.llm.html_text import main_text

L = "This is a sentence of eighty-two characters, with a comma in it, for the tests here."


# --- densities, from nested lists, by plain recursion ----------------------------

def random_tree(rng, depth=0):
    """(tag, children) with texts among the children."""
    tag = rng.choice(["div", "div", "section", "p", "ul", "a", "span"]) if depth else "body"
    children = []
    for _ in range(rng.randrange(1, 6) if depth < 4 and tag not in ("p", "a", "span") else 0):
        children.append(random_tree(rng, depth + 1))
    if tag in ("p", "a", "span") or rng.random() < 0.3:
        children.insert(rng.randrange(len(children) + 1), " ".join("w" * rng.randrange(1, 9) for _ in range(rng.choice([1, 2, 3, 8, 30]))))
    if tag in ("p", "div") and rng.random() < 0.2:
        children.append(("a", ["link " * rng.randrange(1, 6)]))
    return tag, children


def markup(node):
    if isinstance(node, str):
        return node
    return f"<{node[0]}>" + "".join(map(markup, node[1])) + f"</{node[0]}>"


def parts(node):
    return [c for c in node[1] if not isinstance(c, str)]


def chars(node):
    return sum(len(w) for c in node[1] if isinstance(c, str) for w in c.split()) + sum(map(chars, parts(node)))


def tags(node):
    return sum(1 + tags(c) for c in parts(node))


def link_chars(node):
    return chars(node) if node[0] == "a" else sum(map(link_chars, parts(node)))


def link_tags(node):
    return (node[0] == "a") + sum(map(link_tags, parts(node)))


def density(node, body):
    c, t, lc, lt = chars(node), max(1, tags(node)), link_chars(node), link_tags(node)
    if c == 0:
        return 0.0
    low = math.log(c / max(1, c - lc) * lc + link_chars(body) / max(1, chars(body)) * c + math.e)
    # a logarithm to the base `low`
    return c / t * math.log(max(1.0, c / max(1, lc) * t / max(1, lt))) / max(1.0, math.log(low))


def in_order(node):
    yield node
    for c in parts(node):
        yield from in_order(c)


BLOCKS = {"div", "section", "p", "ul", "body"}


def shown(node, out):
    """Texts with None at the borders of blocks."""
    if node[0] in BLOCKS:
        out.append(None)
    for c in node[1]:
        out.append(c) if isinstance(c, str) else shown(c, out)
    if node[0] in BLOCKS:
        out.append(None)


def plain(body):
    html = ("html", [body])
    nodes = list(in_order(html))
    if not chars(body):
        return ""
    above = {id(c): n for n in nodes for c in parts(n)}
    sums = [sum(density(c, body) for c in parts(n)) for n in nodes]
    path = [nodes[sums.index(max(sums))]]
    while id(path[-1]) in above:
        path.append(above[id(path[-1])])
    threshold = min(density(n, body) for n in path if chars(n))
    kept = {id(path[0])}
    for below, node in zip(path, path[1:]):
        kept |= {id(c) for c in parts(node) if c is not below and chars(c) and density(c, body) >= threshold and link_chars(c) * 2 < chars(c)}
    blocks = []
    for node in nodes:
        if id(node) in kept:
            out = []
            shown(node, out)
            held = ""
            for x in [*out, None]:
                if x is None:
                    blocks.append(" ".join(held.split()))
                    held = ""
                else:
                    held += x
    return "\n".join(b for b in blocks if b)


def test_random_trees_against_plain_densities():
    rng = random.Random(17)
    several = 0
    for _ in range(300):
        body = random_tree(rng)
        want = plain(body)
        assert main_text(f"<html>{markup(body)}</html>") == want, markup(body)
        several += 0 < len(want.split()) < len(" ".join(x for n in in_order(body) for x in n[1] if isinstance(x, str)).split())
    assert several > 50  # the method left something out


# --- wrappers, names, headings ----------------------------------------------------

@pytest.mark.parametrize("page,text", [
    (f"<body><form><div><p>{L}</p><p>{L} x</p></div></form></body>", f"{L}\n{L} x"),
    (f"<body><header><div><p>{L}</p><p>{L} x</p></div></header></body>", f"{L}\n{L} x"),
    (f"<article><p>{L}</p><div class='widget-text'><p>{L} x</p></div></article>", f"{L}\n{L} x"),
    (f"<article><p>{L}</p><div class='menu-description'><p>{L} x</p></div></article>", f"{L}\n{L} x"),
    (f"<body><h1>Title</h1><div class=content><p>{L}</p><p>{L} x</p><p>{L} y</p></div></body>", f"Title\n{L}\n{L} x\n{L} y"),
    (f"<body><div><h1>Title</h1><h2>Sub</h2></div><div class=content><p>{L}</p><p>{L} x</p></div></body>", f"Title\nSub\n{L}\n{L} x"),
    (f"<body><h1>Site</h1><nav>Home</nav><div class=content><p>{L}</p><p>{L} x</p></div></body>", f"{L}\n{L} x"),
    (f"<div class=post><p>{L}</p><p>{L} x</p></div><ol class='replies'><li>{L}<li>{L} z</ol>", f"{L}\n{L} x"),
    (f"<div class=post><p>{L}</p><p>{L} x</p></div><div id=respond><p>{L} z</p></div>", f"{L}\n{L} x"),
    (f"<article><p>{L}</p><div class=ad><p>{L} z</p></div><div class='footer-left'>{L} z</div></article>", L),
    ("<body><form><label>Name</label><input><label>Your message to us</label> send it</form></body>", ""),
    (f"<body><p>{L}</p><p>{L} x</p><form><p>Subscribe to our letter</p></form></body>", f"{L}\n{L} x"),
    (f"<article><p>{L}</p><section id='discussion'><p>{L} x</p></section></article>", f"{L}\n{L} x"),
    (f"<header><h1>Site</h1></header><article><p>{L}</p></article>", L)])
def test_wrappers_names_and_headings(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("unit", ["<div>|</p>", "<div>|</u>", "<b>|<hr>", "<article>|x", "<p>|<li>", "<tr><td>|</b>", "<h1>x</h1><div class='ad'>|y"])
def test_hostile_pages_cost_in_proportion(unit):
    def cost(n):
        page = "".join(part * n for part in unit.split("|"))
        start = time.process_time()
        main_text(page)
        return time.process_time() - start
    small, large = cost(5_000), cost(40_000)
    assert large < 24 * max(small, 0.02)  # eight times the page; 64 times the work if quadratic


def test_a_page_of_200000_open_and_stray_tags():
    start = time.process_time()
    main_text("<div>" * 200_000 + "</p>" * 200_000)
    assert time.process_time() - start < 6  # hours before
