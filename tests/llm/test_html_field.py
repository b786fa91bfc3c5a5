"""The page field: linear time on ill-formed markup, pages without telling names, and its recursions against enumeration."""

import itertools
import math
import time

import numpy as np
import pytest

from finlens.llm import html_text as H

MB = 1 << 20
ILL = {"unclosed tags": "<p a b c ", "double quotes": '<p title="x ', "single quotes": "<a b='", "mixed quotes": "<a 'x>' \"", "nested": "<div>x", "signs": "<",
       "list items": "<li>x", "comments": "<!-- ", "scripts": "<script>", "references": "&", "declarations": "<!x ", "end tags": "</div>", "attributes": "<p class='a b' class=c>x"}


@pytest.mark.parametrize("name", ILL)
def test_a_megabyte_of_ill_formed_markup(name):
    field = H.default_field()
    page = (ILL[name] * (MB // len(ILL[name]) + 1))[:MB]
    t = time.process_time()
    H.main_text(page, field)
    assert time.process_time() - t < 5  # 2 s alone; quadratic work takes minutes


def test_deep_pages():
    field = H.default_field()
    t = time.process_time()
    H.main_text("".join(f"<div class=c{i}>x" for i in range(50000)), field)
    H.main_text("<div>" * 80000 + "</p>" * 80000, field)
    H.main_text("<button><p><div>" + "<h1>" * 100000, field)
    H.main_text("<title>" + "<" * MB, field)
    assert time.process_time() - t < 12


def test_tags_end_outside_quotes():
    kinds = lambda page: [(k, v.strip()) for k, v, _ in H._tokens(page)]
    assert kinds("<p title='a>b'>x</p>") == [("start", "p"), ("text", "x"), ("end", "p")]
    assert kinds('<p title="a>b>x</p>') == [("start", "p"), ("text", "b>x"), ("end", "p")]  # a quote that is never closed
    assert kinds("a < b <c") == [("text", "a < b <c")]
    assert kinds("<!-- a > b -->x<!-- never") == [("text", "x")]
    assert kinds("<script>if (a<b) '</p>'</SCRIPT >y") == [("raw", "script"), ("text", "y")]


def test_pages_without_telling_names_keep_their_article():
    field = H.default_field()
    prose = ["The boats came in early this morning, laden with fish.", "Nobody had expected so many of them."]
    assert H.main_text(f"<html><body><div class=col-8><h1>A visit</h1><p>{prose[0]} {prose[1]}</p></div></body></html>", field) == f"A visit\n{prose[0]} {prose[1]}"
    assert H.main_text(f"<table><tr><td><a href=/a>Home</a> <a href=/b>About</a></td><td><h1>Old</h1><p>{prose[0]}</p><p>{prose[1]}</p></td></tr></table>", field) == "\n".join(["Old", *prose])
    assert H.main_text(f"<p>{prose[0]}</p><p>{prose[1]}</p>", field) == "\n".join(prose)


@pytest.mark.parametrize("plain", [0.0, 1.0])
def test_held_out_pages(plain):
    """Fresh pages; with plain=1 every article stands in a box whose name never occurred in training, or in none."""
    field, right, n = H.default_field(), 0, 0
    for page in H.labelled_pages(150, seed=77, plain=plain):
        got = field.label([b[:3] for b in page])
        right += sum(g == b[3] for g, b in zip(got, page, strict=True))
        n += len(page)
    assert right / n > 0.97


def toy():
    items = [[("Some plain text here, with words.", (frozenset({"in:p"}), "p"), 0.0), ("Home", (frozenset({"in:nav"}), "nav"), 1.0), ("© x", (frozenset({"in:footer"}), "footer"), 0.0),
              ("Another sentence of the article.", (frozenset({"in:p", "in:article"}), "p"), 0.0)][:k] for k in (1, 2, 3, 4)]
    return [[(*b, i % 2) for i, b in enumerate(p)] for p in items]


def test_viterbi_against_enumeration():
    field = H.train(toy(), rounds=3)
    for page in toy():
        items = [b[:3] for b in page]
        gain = [sum(field.weights.get(x, 0.0) for x in [*i[1][0], *f]) for i, f in zip(items, H._described(items), strict=True)]
        score = lambda y: sum(g * l for g, l in zip(gain, y, strict=True)) + sum(field.move[a][b] for a, b in zip(y, y[1:], strict=False))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=len(items)), key=score)
        assert [int(x) for x in field.label(items)] == list(best)
    assert field.label([]) == []


def test_training_follows_the_gradient_of_the_likelihood():
    """One step of the trainer from zero moves every weight in the direction of the enumerated likelihood's gradient."""
    page = toy()[3]
    items, y = [b[:3] for b in page], [b[3] for b in page]
    names = [[*sorted(i[1][0]), *f] for i, f in zip(items, H._described(items), strict=True)]
    vocabulary = sorted({x for f in names for x in f})

    def likelihood(w, move):
        score = lambda z: sum(w[x] for f, l in zip(names, z, strict=True) if l for x in f) + sum(move[a][b] for a, b in zip(z, z[1:], strict=False))
        return score(y) - math.log(sum(math.exp(score(z)) for z in itertools.product((0, 1), repeat=len(y))))
    zero, flat = dict.fromkeys(vocabulary, 0.0), [[0.0, 0.0], [0.0, 0.0]]
    field = H.train([page], rounds=1, rate=1e-3, penalty=0.0)
    for x in vocabulary:
        slope = (likelihood({**zero, x: 1e-5}, flat) - likelihood({**zero, x: -1e-5}, flat)) / 2e-5
        # an Adagrad step from nothing: rate * g / sqrt(g^2 + tiny)
        assert abs(field.weights[x] - 1e-3 * slope / math.sqrt(slope**2 + 1e-6)) < 1e-6
    for a, b in itertools.product((0, 1), repeat=2):
        up = [[1e-5 * ((i, j) == (a, b)) for j in (0, 1)] for i in (0, 1)]
        slope = (likelihood(zero, up) - likelihood(zero, -np.array(up))) / 2e-5
        assert abs(field.move[a][b] - 1e-3 * slope / math.sqrt(slope**2 + 1e-6)) < 1e-6
