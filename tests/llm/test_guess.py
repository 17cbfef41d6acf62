"""The guess cost against all segmentations."""

import itertools
import math
import random

import pytest

from corpusmill.llm import secrets


def least(value):
    """The least over all ways to cut value in two, each part again at its least cost."""
    return min([secrets.guess_cost(value), *(secrets.guess_cost(value[:k]) + secrets.guess_cost(value[k:]) for k in range(1, len(value)))])


@pytest.mark.parametrize("value", ["passwordddddd", "Xy7passwordddddd", "passwordefghi", "adminbvcxz", "xaaaabbbbb", "love" + "e" * 40])
def test_runs_that_begin_inside_a_word(value):
    assert secrets.guess_cost(value) <= least(value) + 1e-9


def test_random_values():
    rng = random.Random(6)
    for _ in range(400):
        value = "".join(rng.choice(["a", "b", "c", "d", "pass", "love", "Q", "w", "e", "#"]) for _ in range(rng.randrange(1, 12)))
        assert secrets.guess_cost(value) <= least(value) + 1e-9, value


def test_weak_values_with_some_more_characters():
    assert secrets.guess_cost("passwordddddd") < 3 and secrets.guess_cost("Xy7passwordddddd") < 8
    assert secrets.spans("password is Xy7passwordddddd") == []


@pytest.mark.parametrize("value", ["kqzvxwjhplmn", "xK9#q2v", "kqzvxwjh", "HQZTKWPXVB", "correcthorsebatterystaple"])
def test_dear_values_of_any_form(value):
    text = f"passphrase: {value} and secret is {value}."
    assert [text[s:e] for s, _, e, _ in secrets.spans(text)] == [value] * 2


@pytest.mark.parametrize("value", ["knowledge", "understanding", "Wissenschaft", "bibliothèque", "contraseña", "пароль", "letmein", "aB3!", "qwertyuiop"])
def test_words_and_cheap_values(value):
    assert secrets.spans(f"the secret is {value}, auth: {value}") == []


def span_cost(value, a, b):
    """The cost of value[a:b] as one span, written out anew."""
    low, n, out = value.lower()[a:b], b - a, []
    if n == 1:
        c = value[a]
        out.append(1.0 if c.isdigit() else 1.41 if c.isascii() and c.isalpha() else 1.52 if c.isascii() else 2.0)
    if n >= 3 and len(set(low)) == 1:
        out.append(0.3 + span_cost(value, b - 1, b) + 0.05 * n)
    if n >= 3 and all(y in secrets.NEXT_TO.get(x, ()) for x, y in zip(low, low[1:])):
        out.append(0.3 + 1.7 + 0.45 * n)
    if n >= 3 and {ord(y) - ord(x) for x, y in zip(low, low[1:])} in ({1}, {-1}):
        out.append(0.3 + 1.3 + 0.05 * n)
    if (m := secrets.DATE.match(value.lower(), a)) and m.end() == b:
        out.append(0.3 + (2.1 if n == 4 else 4.6))
    for form, more in ((low, 0.0), (low.translate(secrets.LEET), 0.6)):
        if form in secrets.WORDS and n >= 3:
            out.append(0.3 + math.log10(secrets.WORDS.index(form) + 2) + more + (0.0 if value[a:b].islower() else 0.6))
    return min(out, default=math.inf)


def least_of_all(value):
    cuts = range(1, len(value))
    return min(sum(span_cost(value, a, b) for a, b in itertools.pairwise((0, *c, len(value)))) for k in range(len(value)) for c in itertools.combinations(cuts, k))


@pytest.mark.parametrize("value", ["dragonnnnn", "masterrrrr", "monkeyyyyy1", "p@ssw0rd12", "qwertyu19x", "abcdcba999", "2020love", "asdfff123"])
def test_against_all_segmentations(value):
    assert abs(secrets.guess_cost(value) - least_of_all(value)) < 1e-9


def test_words_and_costs(spark):
    text = "passphrase: zorblax9zorblax and token=passwordpassword"
    docs = spark.createDataFrame([(1, text, "x"), (2, None, "y")], "doc_id long, text string, _secrets string")
    plain = {r.doc_id: [(x.kind, x.cost) for x in r._secrets] for r in secrets.scan(docs).collect()}
    assert [k for k, _ in plain[1]] == ["guess", "assign"] and plain[1][0][1] > 8 > plain[1][1][1] > 0 and plain[2] == []
    known = secrets.scan(docs, words=["zorblax", "password"]).collect()
    assert [x.kind for r in known for x in r._secrets] == ["assign"]


def test_letters_of_words_and_random_letters():
    words = "administration organisation strength geschichte krankenversicherung schwarz ubersetzung desarrollo gouvernement knowledge bibliotheque".split()
    assert sum(math.isinf(secrets.word_cost(w)) for w in words) <= 1
    rng = random.Random(3)
    drawn = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for _ in range(300)]
    assert sum(math.isinf(secrets.word_cost(w)) for w in drawn) >= 270
    assert secrets.word_cost("") == 0 and secrets.word_cost("пароль") == secrets.WORD_COST
