"""Decontamination, near-dedup, line dedup and substring dedup against brute force on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkeval.llm import decontamination, line_dedup, near_dedup, substring_dedup
from sparkeval.llm.textbits import mix


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text, width):
    w = words_of(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def random_text(rng, n, vocabulary=5000):
    return " ".join(f"w{rng.randint(0, vocabulary)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"e{rng.randint(0, 10**6)}" if rng.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    base = [random_text(rng, rng.randint(1, 120)) for _ in range(60)]
    texts = base + [edited(rng, rng.choice(base), rng.choice([0, 0.01, 0.03, 0.1])) for _ in range(120)]
    line = random_text(rng, 30)
    texts += [line + " " + random_text(rng, rng.randint(2, 12)) for _ in range(40)]
    texts += [None, "", " \n\t ", "one", "One", "one two", "ÀB c", "àb C", "x " * 3000, "y" * 20000]
    return list(enumerate(texts)) + [(5, texts[5]), (5, "another text for the same id"), (None, texts[7]), (None, None)]


@pytest.mark.parametrize("width", [2, 5])
def test__near_duplicates(docs, corpus, width):
    unique = [r for r in corpus if r[0] is not None][: len(corpus) - 4]
    sets = {i: shingles(t, width) for i, t in unique}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    want = sorted((i, len(s), root(i), root(i) == i) for i, s in sets.items())
    got = near_dedup.near_duplicates(docs(unique, extra=("node", "bands")).repartition(5), width=width)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == want


def test__near_duplicates_odd_rows(docs, corpus):
    got = near_dedup.near_duplicates(docs(corpus), width=5).collect()
    assert len(got) == len(corpus)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert near_dedup.near_duplicates(docs([])).count() == 0


def test__sketches_estimate_similarity():
    rng = np.random.default_rng(4)
    a = np.unique(mix(rng.integers(0, 2**62, 400).astype(np.uint64)))
    b = np.unique(np.concatenate([a[:320], mix(rng.integers(0, 2**62, 80).astype(np.uint64))]))
    pairs = near_dedup.sketch([a, b, a[:5]])
    assert abs((pairs[0] == pairs[1]).mean() - 320 / 480) < 0.15
    assert np.isin(pairs[2], a[:5]).all()


def test__components(spark):
    from sparkeval.llm.common import Scratch
    from sparkeval.llm.graph import components, merge

    scratch = Scratch(spark)
    edges = [(i, i + 1) for i in range(40, 60)] + [(100, k) for k in range(101, 130)] + [(7, 8), (8, 9), (9, 7), (3, 3)]
    roots = components(spark.createDataFrame(edges, "a bigint, b bigint"), scratch)
    found = dict(map(tuple, roots.collect()))
    groups = {}
    for node, root in found.items():
        groups.setdefault(root, set()).add(node)
    assert sorted(map(sorted, groups.values())) == [[7, 8, 9], list(range(40, 61)), list(range(100, 130))]
    more = dict(map(tuple, merge(roots, spark.createDataFrame([(9, 50), (1, 2)], "a bigint, b bigint"), scratch).collect()))
    assert more[7] == more[60] and more[1] == more[2] and more[100] != more[7]


def test__leaks(docs, spark, corpus):
    rng = random.Random(9)
    items = [(k, random_text(rng, n)) for k, n in enumerate([1, 3, 5, 9, 16, 40, 60, 200])] + [(50, None), (51, ""), (5, random_text(rng, 20))]
    texts = dict(items)
    held = [(1000 + k, f"{random_text(rng, 3000)} {edited(rng, t, 0.02).upper()} {random_text(rng, 500)}") for k, t in items if t]
    rows = corpus + held + [(2000, texts[7][: len(texts[7]) // 3])]
    want = sorted(
        (i, k, len(q), len(q & d), len(q & d) / len(q))
        for i, t in rows for d in [shingles(t, 5)] for k, p in items for q in [shingles(p, 5)] if q and len(q & d) >= 0.8 * len(q) if i is not None
    )
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.find_leaks(docs(rows, extra=("item_id",)).where("doc_id IS NOT NULL"), table)
    assert sorted(map(tuple, got.collect())) == want and len(want) >= 5
    leaked = {r[0] for r in want}
    clean = decontamination.decontaminate(docs(rows, extra=("score",)), table)
    assert sorted(r.doc_id for r in clean.collect() if r.doc_id is not None) == sorted(i for i, _ in rows if i is not None and i not in leaked)
    assert decontamination.find_leaks(docs([]), table).count() == 0
    assert decontamination.find_leaks(docs(rows), table.limit(0)).count() == 0
    assert decontamination.decontaminate(docs(rows), table.limit(0)).count() == len(rows)


def test__items_in_blocks(docs, spark):
    rng = random.Random(1)
    items = spark.createDataFrame([(k, random_text(rng, 30)) for k in range(20)], "item_id bigint, text string")
    blocks = list(decontamination.item_blocks(items, 5, limit=100))
    assert len(blocks) > 1 and sorted(i for ids, _ in blocks for i in ids) == list(range(20))


def line_truth(rows, percent=80):
    lines = []
    for key, text in rows:
        for place, line in enumerate(text.split("\n") if text is not None else []):
            tokens = frozenset(w for w in line.lower().replace("\t", " ").split(" ") if w)
            if tokens:
                lines.append((key, place, tokens))
    gone = set()
    for b, (key, place, own) in enumerate(lines):
        if any(100 * len(own & x) >= percent * len(own | x) for _, _, x in lines[:b]):
            gone.add((key, place))
    return {k: (sum(x[0] == k for x in lines), sum(g[0] == k for g in gone), None if t is None else "\n".join(s for p, s in enumerate(t.split("\n")) if (k, p) not in gone)) for k, t in rows}


def test__line_dedup(docs):
    rng = random.Random(6)
    base = [random_text(rng, rng.randint(1, 40), 300) for _ in range(80)]
    rows = [(0, None), (1, ""), (2, "\n \n"), (3, "a b\n\nA  b\na\tb\nb a")]
    for key in range(4, 60):
        rows.append((key, "\n".join(edited(rng, rng.choice(base), rng.choice([0, 0, 0.05, 0.15, 0.5])) for _ in range(rng.randint(0, 12)))))
    rows.append((60, "z " * 5000 + "\n" + "z"))
    table = docs(rows, extra=("row", "kept", "lines", "n_lines")).repartition(4)
    got = line_dedup.dedup_lines(table)
    assert got.columns == [*table.columns, "_n_lines", "n_removed"]
    want = line_truth(rows)
    assert {r.doc_id: (r["_n_lines"], r.n_removed, r.text) for r in got.collect()} == want
    assert sum(x[1] for x in want.values()) > 50
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test__line_dedup_long_lines(spark, docs):
    rng = np.random.default_rng(11)
    sets = []
    for n in (45, 58, 63, 70, 100, 118, 126, 135, 150, 210, 250, 260, 330):
        words = [f"w{x}" for x in rng.choice(1500, n, replace=False)]
        near, far = max(1, n // 10), n // 4
        sets += [words, words[near:] + [f"n{n}x{i}" for i in range(near // 2)], words[far:] + [f"f{n}x{i}" for i in range(far)], words + [f"l{n}x{i}" for i in range(n // 4)]]
    lines = [" ".join(rng.permutation(x)) for x in sets]
    alike = {(a, b) for b, y in enumerate(sets) for a, x in enumerate(sets[:b]) if 5 * len({*x} & {*y}) >= 4 * len({*x} | {*y})}
    got = line_dedup.dedup_lines(docs(list(enumerate(lines)))).where("n_removed > 0").select("doc_id").collect()
    assert {r.doc_id for r in got} == {b for _, b in alike} and alike
    # Unrelated lines of many words are told apart by their parities, so that no pair of them leaves the join.
    table = docs(list(enumerate(lines)))
    tokens = table.select("doc_id", line_dedup.ranked_tokens(F.col("text"), line_dedup.slot_levels(table)).alias("tokens"))
    at = F.shiftleft(F.size("tokens").cast("bigint"), 31).alias("at")
    wide = tokens.select("doc_id", at, F.explode(line_dedup._size_classes(F.size("tokens"), 80)).alias("class"), line_dedup.parities(F.col("tokens"), 80).alias("bits"))
    sized = wide.select("doc_id", "at", "class", *line_dedup.folded(F.col("bits"), line_dedup._width(F.col("class"))))
    other = sized.withColumnsRenamed({"doc_id": "other", "at": "cat"} | {b: f"c{b}" for b in line_dedup.BITS})
    passed = sized.join(other, "class").where((F.col("doc_id") < F.col("other")) & line_dedup._alike(80, line_dedup.BITS))
    passed = {tuple(r) for r in passed.select("doc_id", "other").collect()}
    assert alike <= passed and all(a // 4 == b // 4 for a, b in passed)


def test__line_dedup_odd_rows(docs):
    rows = [(None, "first line here\nnew"), (1, "first line here"), (1, "first line here"), (2, "new\nother words")]
    got = sorted(map(tuple, line_dedup.dedup_lines(docs(rows)).select("doc_id", "text", "n_removed").collect()), key=repr)
    assert got == sorted([(None, "first line here\nnew", 0), (1, "", 1), (1, "", 1), (2, "other words", 1)], key=repr)
    assert line_dedup.dedup_lines(docs([])).count() == 0


def test__compact_windows_are_the_cartesian_tree():
    rng = np.random.default_rng(8)
    for n, length in ((1, 1), (5, 2), (46, 46), (300, 46), (200, 7)):
        tokens = mix(rng.integers(0, 2**60, n).astype(np.uint64))
        want = []

        def grow(a, b):
            if b - a + 1 >= length:
                c = a + int(np.argmin(tokens[a : b + 1]))
                want.append((a, c, b))
                grow(a, c - 1)
                grow(c + 1, b)

        grow(0, n - 1)
        assert sorted(want) == sorted(zip(*(x.tolist() for x in substring_dedup.compact_windows(tokens, length))))


def test__repeated_passages(docs):
    rng = random.Random(12)
    passage, half = random_text(rng, 70), random_text(rng, 40)
    line = random_text(rng, 12)
    rows = [(i, f"{line} {random_text(rng, rng.randint(30, 200))}") for i in range(60)]
    rows += [(100 + i, f"{random_text(rng, rng.randint(0, 60))} {passage} {random_text(rng, rng.randint(0, 60))}") for i in range(12)]
    rows += [(200 + i, f"{random_text(rng, 30)} {half} {random_text(rng, 30)}") for i in range(12)]
    long = random_text(rng, 300)
    rows += [(300, long), (301, edited(rng, long, 0.02)), (302, long.upper()), (303, long), (304, f"{passage} {passage}")]
    rows += [(400, None), (401, ""), (402, "short text"), (None, long), (303, long)]
    got = substring_dedup.repeated_passages(docs(rows, extra=("node", "start", "value")).repartition(4)).collect()
    assert {r.doc_id for r in got} == {*range(100, 112), 300, 301, 302, 303, 304}
    for r in got:
        assert r.n_words >= 50 and 0.8 <= r.similarity <= 1 and r.source_id != r.doc_id
    for i in range(100, 112):
        assert any(r.n_words >= 70 and r.similarity >= 0.8 for r in got if r.doc_id == i)
    whole = {r.doc_id: (r.start, r.n_words, r.source_id) for r in got if r.doc_id in (300, 302, 303) and r.n_words == 300 and r.similarity == 1}
    assert whole == {300: (0, 300, 303), 302: (0, 300, 300), 303: (0, 300, 300)}
    assert substring_dedup.repeated_passages(docs([])).count() == 0


def test__exact_runs_of_fifty_words_are_all_found(docs):
    rng = random.Random(21)
    parts = [random_text(rng, rng.randint(30, 80)) for _ in range(25)]
    rows = [(i, " ".join(rng.choice(parts) if rng.random() < 0.5 else random_text(rng, rng.randint(5, 60)) for _ in range(rng.randint(1, 6)))) for i in range(80)]
    runs = {}
    for i, t in rows:
        w = words_of(t)
        for j in range(len(w) - 49):
            runs.setdefault(tuple(w[j : j + 50]), set()).add(i)
    want = {i for owners in runs.values() if len(owners) > 1 for i in owners}
    got = {r.doc_id for r in substring_dedup.repeated_passages(docs(rows)).select("doc_id").collect()}
    assert want <= got and len(want) > 10


def words_hashes(text):
    import pyarrow as pa

    return substring_dedup.word_hashes(pa.array([text]))[0]


def centred(make, first):
    """Texts from ``make()``, drawn again until the one at ``first`` is the smallest node, the centre of all groups."""
    while True:
        texts = make()
        nodes = [substring_dedup.sequence_node(words_hashes(t)) for t in texts]
        if min(nodes) == nodes[first]:
            return texts


def test__staggered_excerpts_keep_their_partners(docs):
    """d shares 60 words with b and 49 with x; x, the centre, explains b's words first."""
    rng = random.Random(31)
    rows = []
    for k in range(12):
        def make():
            whole = random_text(rng, 120, 10**6).split()
            return [" ".join(whole[:64]) + " " + random_text(rng, 20, 10**6), " ".join(whole), random_text(rng, 20, 10**6) + " " + " ".join(whole[15:75])]

        rows += [(10 * k + i, t) for i, t in enumerate(centred(make, 0))]
    got = {r.doc_id for r in substring_dedup.repeated_passages(docs(rows)).select("doc_id").collect()}
    assert got == {i for i, _ in rows}


def test__three_way_near_copies_are_all_found(docs):
    """x~b and b~d reach 0.8, x~d does not; x is the centre of every group."""
    rng = random.Random(32)
    rows = []
    for k in range(12):
        def make():
            b = random_text(rng, 64, 10**6).split()
            x, d = b.copy(), b.copy()
            x[34] = f"x{rng.random()}"
            d[32] = f"d{rng.random()}"
            return [" ".join(t) for t in (x, b, d)]

        rows += [(10 * k + i, t) for i, t in enumerate(centred(make, 0))]
        x, b, d = (shingles(t, 5) for _, t in rows[-3:])
        assert len(x & b) / len(x | b) >= 0.8 and len(b & d) / len(b | d) >= 0.8 and len(x & d) / len(x | d) < 0.8
    got = {r.doc_id for r in substring_dedup.repeated_passages(docs(rows)).select("doc_id").collect()}
    assert got == {i for i, _ in rows}


def linked(rows):
    """The sets of documents that the rows connect."""
    up = {}

    def top(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for r in rows:
        up[max(top(r.doc_id), top(r.source_id))] = min(top(r.doc_id), top(r.source_id))
    out = {}
    for i in up:
        out.setdefault(top(i), set()).add(i)
    return sorted(map(sorted, out.values()))


def test__passages_link_all_texts_that_share_them(docs):
    """x~b at the centre x explains both; d and its passage's copy y explain each other; b~d is the only link between them.
    Documents with copies keep their links to others."""
    rng = random.Random(33)
    rows, want = [], []
    for k in range(4):
        def make():
            b = random_text(rng, 64, 10**6).split()
            x, d = b.copy(), b.copy()
            x[34] = f"x{rng.random()}"
            d[32] = f"d{rng.random()}"
            return [" ".join(t) for t in (x, b, d)] + [" ".join(d) + " " + random_text(rng, 40, 10**6)]

        rows += [(10 * k + i, t) for i, t in enumerate(centred(make, 0))]
        want.append([10 * k + i for i in range(4)])
    passage = random_text(rng, 60, 10**6)
    for i in (100, 102):
        text = f"{random_text(rng, 30, 10**6)} {passage} {random_text(rng, 30, 10**6)}"
        rows += [(i, text), (i + 1, text)]
    got = substring_dedup.repeated_passages(docs(rows)).collect()
    assert linked(got) == [*want, [100, 101, 102, 103]]
    assert {(r.doc_id, r.source_id) for r in got if r.doc_id >= 100} == {(100, 101), (101, 100), (102, 103), (103, 102), (100, 102), (102, 100)}


def test__recall_of_edited_passages(docs):
    """Pairs of 50 to 60 words with one or two edits, against an alignment of everything."""
    rng = random.Random(41)
    rows, want = [], set()
    for k in range(400):
        a = random_text(rng, rng.randint(50, 60), 10**6).split()
        b = a.copy()
        for _ in range(rng.choice([1, 1, 2])):
            b[rng.randint(1, len(b) - 2)] = f"e{rng.random()}"
        texts = [" ".join([random_text(rng, 20, 10**6), *t, random_text(rng, 20, 10**6)]) for t in (a, b)]
        x, y = (words_hashes(t) for t in texts)
        if substring_dedup.align(x, y, [(0, 0, 0, len(x), 0, 0, 0, len(y))], 50, 80):
            want |= {2 * k, 2 * k + 1}
        rows += [(2 * k + i, t) for i, t in enumerate(texts)]
    got = {r.doc_id for r in substring_dedup.repeated_passages(docs(rows)).select("doc_id").collect()}
    print(f"recall {len(got & want)} of {len(want)}")
    assert got <= want and len(got & want) >= 0.995 * len(want) and len(want) > 300


def test__pairs_that_share_a_phrase_only_are_left_before_their_anchors():
    import numpy as np

    r = np.random.default_rng(6)
    phrase, draw = r.integers(0, 1 << 31, 49), lambda n: r.integers(0, 1 << 31, n)
    a, b = (np.concatenate([draw(200), phrase, draw(60), phrase, draw(200)]).astype(np.uint32) for _ in "ab")

    def anchors():
        raise AssertionError("anchors of a pair without a passage are read")
        yield

    assert substring_dedup.align(a, b, anchors(), 50, 80) == [] and not substring_dedup.comparable(a, b, 50)
    one = np.concatenate([draw(30), phrase, draw(1), draw(90)]).astype(np.uint32)
    other = np.concatenate([draw(70), one[30:80], draw(20)]).astype(np.uint32)  # one word more
    assert substring_dedup.comparable(one, other, 50)
    assert substring_dedup.align(one, other, [(0, 0, 0, len(one), 0, 0, 0, len(other))], 50, 80) == [(30, 50, 70, 50, 1.0)]
