import random
import re
import time

import pytest

from usagelens.llm import licenses

from .texts import prose


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text or ""))


def base(text):
    w = words(text)
    places = []
    for label, phrase in licenses.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), sorted({x for _, x in places})


def check(rows):
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(r["text"])
        assert set(r["base_labels"]) <= set(r["labels"]) and r["labels"] == sorted(set(r["labels"]))
        assert 0 <= r["score"] <= 1


def test_sample_equals_word_by_word_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = licenses.scan(docs, ["doc_id", "text"]).collect()
    check(rows)
    assert {x for r in rows for x in r["labels"]} >= {"gpl", "gpl-3.0", "apache", "apache-2.0", "cc-by", "cc-by-nc-4.0", "mit"}


def test_hostile_rows(hostile, nothing):
    out = licenses.scan(hostile, ["doc_id", "text"])
    check(out.collect())
    assert out.count() == hostile.count()
    assert out.filter("coalesce(text, '') = '' AND (score > 0 OR n_words > 0 OR size(labels) > 0)").count() == 0
    assert licenses.scan(nothing, ["doc_id"]).collect() == []


def test_matching_statistics_equal_brute_force(monkeypatch):
    monkeypatch.setattr(licenses, "PIECE", 5)
    rng = random.Random(3)
    for _ in range(60):
        texts = [[rng.choice("abc").encode() for _ in range(rng.randint(1, 12))] for _ in range(3)]
        phrases = [t[:2] for t in texts] + [[b"c", b"a", b"b"]]
        machine = licenses.Automaton(texts, phrases)
        runs = {tuple(t[i:j]) for t in [*texts, *phrases] for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        read = [rng.choice("abcd").encode() for _ in range(40)]
        stream = list(machine.stream(licenses.words_of(b" ".join(read).decode())))
        assert stream[-1] == (40, 0, 0)
        known = {at: (run, state) for at, run, state in stream[:-1]}
        for at in range(40):
            longest = max((n for n in range(at + 2) if n == 0 or tuple(read[at - n + 1 : at + 1]) in runs))
            run, state = known.get(at, (0, 0))
            assert run == longest
            ended = {k for n, k in machine.phrases[state] if n <= run}
            assert {tuple(phrases[k]) for k in ended} == {
                tuple(p) for p in phrases if tuple(read[max(0, at - len(p) + 1) : at + 1]) == tuple(p)
            }
            if run >= licenses.LONG:
                here = tuple(read[at - run + 1 : at + 1])
                assert machine.places[state] == sorted(
                    (k, e) for k, t in enumerate(texts) for e in range(len(t)) if e >= run - 1 and tuple(t[e - run + 1 : e + 1]) == here
                )


def test_every_template_is_found_whole_and_altered():
    scanner = licenses.Scanner()
    rng = random.Random(1)
    for label, text in licenses.TEMPLATES:
        around = prose(4, 50) + "\n\n" + text.replace(" ", "\n # ") + "\n" + prose(5, 50)
        out = scanner.scan(around)
        own = [s for s in out["spans"] if s.label == label]
        assert len(own) == 1 and own[0].coverage == 1 and own[0].first_word == 50
        assert own[0].last_word - 50 + 1 == len(words(text))
        w = text.split()
        for _ in range(len(w) // 15):
            w[rng.randrange(len(w))] = "other"
        assert label in scanner.scan(" ".join(w))["labels"]
        half = " ".join(text.split()[: len(text.split()) // 3])
        assert label not in scanner.scan(half)["labels"]
    assert scanner.scan(prose(6, 500))["labels"] == []


def chained(matches, ends, size):
    """The best chain by trying all pairs."""
    best = []
    to = -1
    for m, places in zip(matches, ends):
        length = m.end - max(m.end - m.length + 1, to + 1) + 1
        if length <= 0:
            continue
        new = []
        for end in places:
            before = max((c for c, e in best if e < end - length + 1), default=0)
            new.append((before + length, end))
        best += new
        to = m.end
    return max((c for c, _ in best), default=0)


def test_chains_equal_all_pairs():
    rng = random.Random(9)
    for _ in range(100):
        at, matches, ends = 0, [], []
        for _ in range(rng.randint(1, 12)):
            n = rng.randint(2, 6)
            at += rng.randint(1, 8)
            matches.append(licenses.Match(at + 10, n, 0))
            ends.append(sorted(rng.sample(range(n - 1, 40), rng.randint(1, 3))))
        chain = licenses.Chains("x", 40)
        for m, e in zip(matches, ends):
            chain.add(m, e)
        chain.close()
        assert max((s.covered for s in chain.spans), default=0) == chained(matches, ends, 40)


@pytest.mark.parametrize("unit", ["gnu general public license ", "without warranty of any kind, ", "x"])
def test_long_repetitive_text_takes_linear_time(unit):
    start = time.perf_counter()
    out = licenses.Scanner().scan(unit * 100_000)
    assert time.perf_counter() - start < 30 and out["n_words"] > 0
    if unit.startswith("gnu"):
        assert (out["n_base"], out["first_word"], out["last_word"]) == (100_000, 0, 399_996)
