import random
import re
import textwrap

from linefold.llm import licenses

from .conftest import messy_rows


def brute(text):
    best = []
    for passage in re.split(r"[\r\n]+|(?<=[.!?:])[ \t]+", text or ""):
        own = set(licenses.bigrams_of(passage))
        found = []
        for i, (_, template) in enumerate(licenses.TEMPLATES):
            other = set(licenses.bigrams_of(template))
            if own:
                found.append((2 * len(own & other) / (len(own) + len(other)), -i))
        found = [f for f in found if f[0] >= licenses.THRESHOLD]
        if found:
            best.append(max(found))
    return best


def results(docs):
    return {r["doc_id"]: [(m["dice"], m["template"]) for m in r["licences"]] for r in licenses.scan(docs).select("doc_id", "licences").collect()}


def test_every_passage_that_can_match_holds_a_marker():
    markers = set(licenses.marker_words())
    for _, text in licenses.TEMPLATES:
        own = licenses.bigrams_of(text)
        bare = sum(not markers & set(b.split()) for b in own)
        for n in range(1, 4 * len(own)):  # a passage of n bigrams that shares unmarked ones only
            assert 2 * min(bare, n) / (n + len(own)) < licenses.THRESHOLD


def test_passages_against_all_templates(spark):
    texts = [t for _, t in licenses.TEMPLATES]
    texts += [f"Some prose here.\n{t}\nMore prose: {t}" for t in texts]
    texts += [t.upper().replace(" ", "  ") for t in texts[:14]]
    texts += ["Released under the terms of the MIT License.", "Licensed under CC BY 4.0.", "The mit license", "mit", "All rights", "license"]
    texts += [" ".join(t.split()[:-1]) for t in texts[:14]] + [" ".join(t.split()[2:]) for t in texts[:14]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert results(docs) == {i: brute(t) for i, t in enumerate(texts)}


def test_small_scale(small):
    got = results(small)
    assert got == {r["doc_id"]: brute(r["text"]) for r in small.collect()}
    assert any(got.values())


def test_messy_and_empty_tables(messy, nothing):
    assert licenses.scan(messy).count() == len(messy_rows())
    assert licenses.scan(nothing).count() == 0


def brute_notices(text):
    """Notices by all windows of all lengths, not only those between a template's own bigrams."""
    words = licenses.words_of(text or "")
    windows = []
    for i, (_, template) in enumerate(licenses.TEMPLATES):
        other = set(licenses.bigrams_of(template))
        low, high = licenses.size_bounds(len(other))
        for n in range(low, high + len(licenses.words_of(template)) - len(other)):
            for at in range(len(words) - n):
                own = set(zip(words[at : at + n], words[at + 1 : at + n + 1]))
                dice = 2 * len({f"{a} {b}" for a, b in own} & other) / (len(own) + len(other))
                if dice >= licenses.THRESHOLD:
                    windows.append((-dice, i, n, at))
    taken = []
    for dice, i, n, at in sorted(windows):
        if all(at + n < a or a + m < at for a, m, *_ in taken):
            taken.append((at, n, -dice, -i))
    return [(dice, template) for _, _, dice, template in sorted(taken)]


def notices_of(docs):
    return {r["doc_id"]: [(m["dice"], m["template"]) for m in r["licences"]] for r in licenses.notices(docs).select("doc_id", "licences").collect()}


def test_wrapped_and_embedded_notices(spark):
    texts = [f"Some prose here.\n{textwrap.fill(t, width)}\nmore of it" for _, t in licenses.TEMPLATES for width in (30, 72, 79)]
    whole = len(texts)
    texts += ["\n".join(" * " + line for line in textwrap.wrap(t, 60)) for _, t in licenses.TEMPLATES]
    texts += ["Distributed as free software under the MIT License", "All rights reserved. " * 4, "license", "", None]
    texts += [" ".join(t for _, t in licenses.TEMPLATES), "under the MIT License, under the MIT License and the MIT License"]
    rng = random.Random(3)
    words = [licenses.words_of(t) for _, t in licenses.TEMPLATES]
    for _ in range(30):  # notices with words lost, doubled and put in
        own = [w for t in rng.sample(words, 2) for w in t]
        texts.append(" ".join(rng.choice([w] * 12 + ["", f"{w} {w}", f"{w}\nthe"]) for w in own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = notices_of(docs)
    assert got == {i: brute_notices(t) for i, t in enumerate(texts)}
    for i in range(whole):
        assert (1.0, licenses.TEMPLATES[i // 3][0]) in [(dice, licenses.TEMPLATES[-n][0]) for dice, n in got[i]]
    assert got[whole + len(words)] == [(6 / 7, 0)]
    assert len(got[whole + len(words) + 1]) == 4


def test_notices_at_small_scale(small, messy, nothing):
    got, before = notices_of(small), results(small)
    short = [r for r in small.collect() if len(r["text"] or "") < 1500]
    assert {r["doc_id"]: got[r["doc_id"]] for r in short} == {r["doc_id"]: brute_notices(r["text"]) for r in short}
    assert any(got[r["doc_id"]] for r in short)
    assert all(len(got[i]) >= len(found) for i, found in before.items())
    assert licenses.notices(messy).count() == len(messy_rows())
    assert licenses.notices(nothing).count() == 0
