"""Fill-in-the-middle, license notices and spelling variants against plain versions of their definitions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkeval.llm import infill, license_scan, spelling

ODD = [None, "", " ", "a", "<P>x", "é漢字🙂 ab", "\n\n  x", "a" * 5000, "ab " * 3000, "a<S", "b <M> c", "one, two\tthree", "Žž"]


def by_hand(doc_id, text):
    text = text or ""
    words = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(words) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(p) for p in (words[:a], words[a:b], words[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(words), "plain", None, None, text
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if h[3] % 100 < 20 else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(words), "spm" if h[3] % 100 < 20 else "psm", len(prefix), len(middle), out


def test__skip_lists_reach_every_rank():
    rng = random.Random(1)
    for _ in range(40):
        texts = ["".join(rng.choice("ab é漢🙂.") for _ in range(rng.choice((0, 0, 1, 5, 300)))) for _ in range(rng.randint(0, 6))]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
        places, tokens, points = infill.token_starts(data, offsets)
        words = [re.findall("[A-Za-z]+|[^A-Za-z]", t) for t in texts]
        assert np.diff(tokens).tolist() == [len(w) for w in words]
        ends = np.append(places[1:], len(data))[: len(places)]
        lists = infill.SkipLists(tokens, points[ends] - points[places])
        asked = [(i, r) for i, w in enumerate(words) for r in range(len(w) + 1)]
        got = lists.seek(np.array([i for i, _ in asked], int), np.array([r for _, r in asked], int))
        assert got.tolist() == [len("".join(words[i][:r])) for i, r in asked]
    lists = infill.SkipLists(np.array([0, 5000]), np.ones(5000, int))
    assert len(lists.units) >= 4 and len(lists.units[-1]) < 60


def test__fill_in_middle(spark, docs):
    rows = [(i, t) for i, t in enumerate(ODD * 8)] + [(3, "a"), (3, "a"), (None, "no id at all")]
    out = infill.fill_in_middle(docs(rows, extra=("output", "h1", "N")))
    assert out.columns[-5:] == ["_n", "form", "prefix_chars", "middle_chars", "_output"]
    got = out.withColumn("back", infill.restored(F.col("_output"), F.col("form"))).collect()
    assert len(got) == len(rows) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r["_n"], r.form, r.prefix_chars, r.middle_chars, r["_output"]) == by_hand(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert infill.digests(docs([])).count() == 0


def brute_places(text, percent):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    base = [(label, i) for label, p in license_scan.PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    best = {}
    for label, notice in license_scan.TEMPLATES:
        wanted, width = set(notice.split()), len(notice.split()) * 5 // 4
        for i in range(len(words)):
            share = len(wanted & set(words[i : i + width]))
            if 100 * share >= percent * len(wanted):
                best[label] = max(best.get(label, 0), share / len(wanted))
    return words, base, best


def test__license_scan(spark, docs):
    rng = random.Random(2)
    vocabulary = sorted({w for _, n in license_scan.TEMPLATES for w in n.split()}) + ["mit", "cc", "by", "license", "the"] * 20
    rows = [(i, t) for i, t in enumerate(ODD)]
    for i in range(250):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if i % 2:
            notice = rng.choice(license_scan.TEMPLATES)[1].split()
            for _ in range(rng.randint(0, 2)):
                notice.insert(rng.randrange(len(notice) + 1), "so") if rng.random() < 0.5 else notice.pop(rng.randrange(len(notice)))
            at = rng.randrange(len(words) + 1)
            words[at:at] = notice
        rows.append((100 + i, rng.choice(["", ". "]) + "".join(rng.choice([w, w.upper()]) + rng.choice([" ", ", ", "\n", "-"]) for w in words)))
    rows += [(1000, "All Rights Reserved. all rights reserved"), (1000, "All Rights Reserved. all rights reserved"), (None, "CC BY-NC 4.0"), (1000, "other Klicense"), (2000, "x " * 30000 + "mit license")]
    for percent in (90, 70):
        got = Counter(tuple(r) for r in license_scan.scan_licenses(docs(rows, extra=("labels", "word", "n_words")), percent=percent).collect())
        want = Counter()
        for doc_id, text in rows:
            words, base, best = brute_places(text, percent)
            starts = [i for _, i in base]
            own, every = sorted({x for x, _ in base}), sorted({x for x, _ in base} | set(best))
            score = max([1.0] if base else [0.0], default=0.0)
            want[(doc_id, len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(own), ",".join(every), max(score, *best.values(), 0.0))] += 1
        assert got == want
    assert license_scan.scan_licenses(docs([])).count() == 0
    places = license_scan.license_places(docs([(5, "x all rights reserved")])).where("kind = 'phrase'").collect()
    assert [(r.doc_id, r.label, r.place, r.score, r.n_words) for r in places] == [(5, "reserved", 1, 1.0, 4)]
    for bad in ((("x", "Not Lower"),), (("x", ""),)):
        with pytest.raises(ValueError):
            license_scan.scan_licenses(docs([]), templates=bad)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test__pivots_do_not_overlap_and_lie_in_the_prefix():
    rng = random.Random(3)
    for _ in range(500):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(4, 9)))
        order = {g: i for i, g in enumerate(sorted((x + y for x in "abc" for y in "abc"), key=lambda g: (hash(g) % 7, g)))}
        last, prefix, (left, right) = spelling.choose_pivots(word, order)
        ranks = [order[word[i : i + 2]] for i in range(len(word) - 1)]
        assert prefix == [i for i, r in enumerate(ranks) if r <= last] and len(prefix) >= 3
        pairs = [(ranks[i] + ranks[j], i, j) for i in prefix for j in prefix if j >= i + 2]
        assert ranks[left] + ranks[right] == min(pairs)[0] and right >= left + 2 and {left, right} <= set(prefix)


@pytest.mark.parametrize("letters,size", [("ab", 300), ("abcé", 500), ("thereinsoè", 400)])
def test__near_pairs_are_all_pairs_one_edit_apart(spark, letters, size):
    rng = random.Random(size)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 8))) for _ in range(size)}
    for w in list(words)[: size // 3]:
        i = rng.randrange(len(w))
        words |= {x for x in (w[:i] + w[i + 1 :], w[:i] + "h" + w[i:], w[:i] + "h" + w[i + 1 :]) if len(x) >= 5}
    got = [tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")).collect()]
    listed = sorted(words)
    want = {(a, b) for i, a in enumerate(listed) for b in listed[i + 1 :] if abs(len(a) - len(b)) < 2 and one_edit(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test__spelling_variants(spark, docs):
    text = "colour " * 12 + "Colours color coLor\ncolor colors " * 3 + "colouré colouré×x " * 2 + "colr " * 5 + "colo3ur "
    rows = [(i, t) for i, t in enumerate([text, text, None, "", "abcd " * 9, "house, " * 200 + "hous " * 3, "horse " * 80, "nurse " * 40, "nurses " * 3])] + [(0, text), (None, "hause " * 4)]
    counts = Counter()
    for doc_id, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    words = {w: n for w, n in counts.items() if n >= 3}
    form = {}
    for w, n in words.items():
        near = sorted((-m, o) for o, m in words.items() if one_edit(w, o))
        form[w] = (len(near), near[0] if near and -near[0][0] >= 2 * n else None)

    def root(w):
        return root(form[w][1][1]) if form[w][1] else w

    want = {w: (form[w][1] and form[w][1][1], root(w), n, form[w][0], form[w][1] and -form[w][1][0]) for w, n in words.items()}
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(docs(rows, extra=("word", "n"))).collect()}
    assert got == want and len(got) > 6
    assert spelling.spelling_variants(docs([])).count() == 0


def test__roots_follow_long_chains(spark):
    chain = [f"w{i:02d}" for i in range(23)]
    forms = spark.createDataFrame([(a, b) for a, b in zip(chain, chain[1:])] + [("x", "w22"), ("y", "x"), ("w22", None)], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(forms).collect()} == {w: "w22" for w in [*chain[:-1], "x", "y"]}
