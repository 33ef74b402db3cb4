"""Main text against a plain version of the scoring, and against pages that are odd, deep or broken."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.extract import main_text

LINES = frozenset("p h1 h2 h3 h4 h5 h6 li pre dt dd figcaption caption summary address".split())


def plain_text(tree):
    """The article of a tree of (tag, class, children), where a child is a tree or a text: every sum by a walk of its own."""
    nodes = []  # (tree, path of places)

    def walk(t, path):
        nodes.append((t, path))
        for i, c in enumerate(t[2]):
            if not isinstance(c, str):
                walk(c, (*path, i))

    walk(("#", "", [tree]), ())
    cut = lambda t: t[0] in ("nav", "aside", "footer", "form") or t[1] in ("ad", "comments") and t[0] != "article"
    at = {p: t for t, p in nodes}
    dead = lambda p: any(cut(at[p[:k]]) for k in range(len(p) + 1))
    blocks = []
    for t, p in nodes:
        run = []
        for i, c in enumerate([*t[2], ()]):
            if isinstance(c, str):
                run.append((i, c))
            elif run:
                text = " ".join("".join(c for _, c in run).split())
                if text and not dead(p):
                    blocks.append(((*p, run[0][0]), p, text))
                run = []
    blocks.sort()
    if not blocks:
        return ""
    weights = {"article": 25, "main": 20, "section": 3, "div": 3, "td": 2, "blockquote": 2, "ul": -2, "ol": -2, "table": -1}

    def score(p):
        got = 0.0
        for _, own, text in blocks:
            holder = own[:-1] if at[own][0] in LINES and own else own
            if holder[: len(p)] == p and (level := len(holder) - len(p)) < 5:
                got += (min(len(text) / 100, 3.0) + text.count(",") + (len(text) >= 25)) * (1 if level == 0 else 0.5 if level == 1 else 1 / (3 * level))
        return got + weights.get(at[p][0], 0) + (15 if at[p][1] == "content" else 0)

    order = [p for _, p in nodes]
    held = [p for p in order if any(own[: len(p)] == p for _, own, _ in blocks)]
    best = max(held, key=lambda p: (round(score(p), 9), -order.index(p)))
    for k in range(len(best), -1, -1):
        if at[best[:k]][0] in ("article", "main"):
            best = best[:k]
            break
    inside = [best]
    for p in held:
        if p and best and p != best and p[:-1] == best[:-1]:
            chars = sum(len(text) for _, own, text in blocks if own[: len(p)] == p)
            if score(p) >= max(10.0, 0.2 * score(best)) or at[p][0] == "p" and chars > 80:
                inside.append(p)
    return " ".join(text for _, own, text in blocks if any(own[: len(p)] == p for p in inside))


def html(tree):
    if isinstance(tree, str):
        return tree
    tag, name, children = tree
    return f"<{tag}{f' class={chr(34)}{name}{chr(34)}' if name else ''}>{''.join(map(html, children))}</{tag}>"


texts = st.sampled_from(["One. ", "Some words, and more of them, to count. ", "A long run of words that goes on, with commas, here, and there, until it is quite long enough to count for something. ", "x"])
lines = st.tuples(st.sampled_from(["p", "h2", "pre"]), st.sampled_from(["", "ad"]), st.lists(texts, max_size=2))
trees = st.recursive(lines, lambda inner: st.tuples(st.sampled_from(["div", "section", "article", "blockquote", "nav", "aside", "form"]), st.sampled_from(["", "", "content", "comments"]), st.lists(inner | texts, max_size=4)), max_leaves=14)


@settings(max_examples=300, deadline=None)
@given(trees)
def test_scores_are_those_of_the_plain_version(tree):
    assert main_text(html(tree)) == plain_text(tree)


@pytest.mark.parametrize("page, text", [
    ("<article><p>Energy is <math><mi>E</mi>=<mi>mc</mi></math> here.</p></article>", "Energy is E=mc here."),
    ('<article><p>First part, of the text.</p><section class="discussion"><p>What follows, from this, is discussed here.</p></section></article>', "First part, of the text. What follows, from this, is discussed here."),
    ('<article><p>Unplug it, first.</p><div class="warning">Do not touch the wire.</div></article>', "Unplug it, first. Do not touch the wire."),
    ('<article><p>Text, that counts, and more.</p><div class="related"><a href=x>Other page</a> <a href=y>Another page</a></div></article>', "Text, that counts, and more."),
    ('<article><p>Text, that counts.</p></article><div class="related"><p>Other things, that are elsewhere.</p></div>', "Text, that counts."),
    ('<p>Keep <span class="ad">buy <span>me</span> now</span>this, please.</p>', "Keep this, please."),
    ('<div><p>Keep <span class="ad">buy me<p>This, too, is text.</p><p>And this.</p></div>', "Keep This, too, is text. And this."),
    ('<div><p>One.</p><span class="ad">x <div>y</div> z</span> two, three</div>', "One. two, three"),
    ('<article><label>Note</label> the <object>gone</object>rest</article>', "Note the rest"),
    ("<article><ul><li>a<li>b<ul><li>c</ul><li>d</ul></article>", "a b c d"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"),
    ("<article><dl><dt>a<dd>b<dt>c</dl></article>", "a b c"),
    ("<article><h1>A<h2>B</h2>c</article>", "A B c"),
])
def test_what_belongs_to_the_article(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("piece", ["<div>", "<div><p>x", "<li>x", "<span class='ad'>x", "</section><div>", "<b>", "<table><tr><td>", "<p>x</b>", "<a href='", "<!-", "<div class='related'>x", "&amp;<", "<dl><dt>", "<ul><li><div>"])
def test_a_megabyte_of_anything(piece):
    """A second or so; a good deal more on a slow machine, but not the minutes that a square would take."""
    began = time.process_time()
    main_text(piece * (1_000_000 // len(piece)))
    assert time.process_time() - began < 40


def test_random_markup_never_fails():
    rng = random.Random(4)
    bits = ["<div>", "</div>", "<p>", "</p>", "<span class=ad>", "</span>", "<li>", "<ul>", "</ul>", "text, ", "<a href=x>", "</a>", "<table>", "<td>", "</table>", "<h1>", "</h1>", "<", ">", '"', "<!--", "-->", "<script>", "</script>", "<article>", "</article>", "<form>", "&lt;", "<br>"]
    for _ in range(2000):
        assert isinstance(main_text("".join(rng.choices(bits, k=40))), str)
