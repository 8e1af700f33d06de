import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from stewardry.llm import decontaminate, passages, suffix_array, texts
from stewardry.llm.decontaminate import Searcher, least_edits


def as_bytes(text):
    return np.frombuffer(text.encode(), np.uint8)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \t\n\x0bé.", max_size=60))
def test_words_are_cut_as_by_bytes_split(text):
    starts, ends = texts.word_spans(as_bytes(text))
    assert [text.encode()[a:b] for a, b in zip(starts, ends)] == text.encode().split()
    assert len(texts.word_hashes(as_bytes(text))) == len(starts)


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    text = as_bytes(" ".join(f"w{i % 97}" for i in range(3000)) + " " + "z" * 500 + " end")
    whole = texts.word_hashes(text)
    monkeypatch.setattr(texts, "_BLOCK", 64)
    assert np.array_equal(whole, texts.word_hashes(text))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 9))
def test_sliding_minimum(values, width):
    values = np.array(values, np.int64)
    expected = [min(values[i : i + width]) for i in range(len(values) - width + 1)]
    assert texts.sliding_min(values, width).tolist() == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=80))
def test_units_hold_every_window_once_and_equal_windows_share_anchors(values):
    width, gram = 8, 3
    hashed = texts.mix(np.array(values), 1)
    anchor, _, low, high, place = passages.units(hashed, width, gram)
    starts = [s for a, b in zip(low, high) for s in range(a, b + 1)]
    assert starts == list(range(max(0, len(values) - width + 1)))
    seen = {}
    for a, p, lo, hi in zip(anchor, place, low, high):
        for s in range(lo, hi + 1):
            assert seen.setdefault(tuple(values[s : s + width]), (a, p - s)) == (a, p - s)


def test_units_of_long_inputs_go_by_block(monkeypatch):
    monkeypatch.setattr(passages, "_MOST", 16)
    hashed = texts.mix(np.arange(100), 1)
    _, _, low, high, _ = passages.units(hashed, 8, 3)
    assert [s for a, b in zip(low, high) for s in range(a, b + 1)] == list(range(93))


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab", max_size=50))
def test_suffix_array_and_common_prefixes(text):
    data, raw = as_bytes(text), text.encode()
    order = suffix_array.suffix_array(data, 100)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    shared = suffix_array.common_prefixes(data, order, 100)
    for k in range(1, len(order)):
        a, b = raw[order[k - 1] :], raw[order[k] :]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=20), min_size=1, max_size=5), st.integers(1, 6))
def test_repeated_windows(pieces, width):
    counts = {}
    for p in pieces:
        for i in range(len(p) - width + 1):
            counts[p[i : i + width]] = counts.get(p[i : i + width], 0) + 1
    found = suffix_array.repeated_windows([as_bytes(p) for p in pieces], width)
    assert [f.tolist() for f in found] == [[counts[p[i : i + width]] > 1 for i in range(len(p) - width + 1)] for p in pieces]


def edit_distance_inside(item, region):
    row = list(range(len(item) + 1))
    best = row[-1]
    for word in region:
        new = [0]
        for i, own in enumerate(item):
            new.append(min(row[i + 1] + 1, new[i] + 1, row[i] + (own != word)))
        row = new
        best = min(best, row[-1])
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=12), st.lists(st.integers(0, 4), max_size=30))
def test_least_edits(item, region):
    assert least_edits(item, region) == edit_distance_inside(item, region)


def test_search_finds_edited_items():
    draw = random.Random(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(10, 60)))) for i in range(60)]
    own = Searcher(items, 0.2, 0.98)
    held, planted = 0, 0
    for i, text in items:
        words = text.split()
        for _ in range(int(0.2 * len(words))):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        around = [" ".join(draw.choices(vocabulary, k=100)) for _ in range(2)]
        found = own.search([as_bytes(around[0] + " " + " ".join(words) + " " + around[1]), as_bytes(around[0])])
        planted += 1
        held += (0, i) in {(t, name) for t, name, _, _ in found}
        assert all(t == 0 for t, *_ in found)
    assert held >= 0.9 * planted


def edited_copies(draw, items, vocabulary):
    """Copies with as many random edits as are allowed, and words around them."""
    for _, text in items:
        words = text.split()
        for _ in range(int(0.2 * len(words))):
            at, what = draw.randrange(len(words)), draw.randrange(3)
            words[at : at + (what != 0)] = [] if what == 1 else [draw.choice(vocabulary)]
        around = [" ".join(draw.choices(vocabulary, k=100)) for _ in range(2)]
        yield as_bytes(around[0] + " " + " ".join(words) + " " + around[1])


def test_search_finds_edited_copies_of_long_items():
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice((65, 300, 700))))) for i in range(60)]
    found = Searcher(items, 0.2, 0.98).search(list(edited_copies(draw, items, vocabulary)))
    assert sum((i, i) in {(t, name) for t, name, _, _ in found} for i in range(60)) >= 59
    assert all(t == name and edits <= 0.2 * n for t, name, n, edits in found)


def test_search_fails_where_walks_do_not_reach_the_recall(monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_WALKS", 1)
    with pytest.raises(ValueError):
        Searcher([(0, " ".join(f"w{i}" for i in range(40)))], 0.2, 0.98)


def test_search_finds_every_copy_of_short_items():
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    short = sorted({" ".join(draw.choices(vocabulary, k=1 + i % 4)) for i in range(200)})
    items = [*enumerate(short), (-1, "这是一个问题")]
    around = lambda k: " ".join(draw.choices(vocabulary, k=k))
    documents = [" ".join([*[around(k)] * (k > 0), text, *[around(k)] * (k > 0)]) for k in (0, 20) for _, text in items]
    found = Searcher(items, 0.2, 0.98).search([as_bytes(d) for d in documents])
    expected = {(t, name, len(text.split()), 0) for t, d in enumerate(documents) for name, text in items if f" {text} " in f" {d} "}
    assert len(found) == len(set(found)) and set(found) == expected
    whole = [(0, " ".join(draw.choices(vocabulary, k=90)))]
    assert Searcher(whole, 0, 0.98).search([as_bytes(around(30) + " " + whole[0][1])]) == [(0, 0, 90, 0)]


def test_items_of_one_template_cost_little(monkeypatch):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    template = text(24)
    items = [(i, f"{template} {text(10)}") for i in range(400)]
    held = items[::40]
    documents = [f"{text(50)} {template} {text(30)}" for _ in range(20)] + [f"{text(9)} {t} {text(9)}" for _, t in held]
    looked, plain = [], decontaminate.least_edits
    monkeypatch.setattr(decontaminate, "least_edits", lambda *a: looked.append(1) or plain(*a))
    found = Searcher(items, 0.2, 0.98).search([as_bytes(d) for d in documents])
    assert sorted((t, name) for t, name, _, _ in found) == [(20 + k, i) for k, (i, _) in enumerate(held)]
    assert len(looked) < 5 * len(documents)  # of 400 candidates in each of them
