"""Exact and near duplicates against plain Python."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from creditloom.llm import exact_dedup, near_dup

UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FOLD = str.maketrans(UP, UP.lower())


def plain_exact(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(FOLD)].append(doc)
    return Counter(
        (doc, max((d for d in members if d is not None), default=None), len(members))
        for members in groups.values()
        for doc in members
    )


ROWS = [
    (1, "Same text"), (2, "same TEXT"), (3, "other"), (4, None), (5, ""), (6, "É"), (7, "é"),
    (8, "same text "), (None, "same text"), (None, "alone"), (9, "x" * 200_000),
    (10, "X" * 200_000), (11, "twice"), (11, "twice"), (None, "nobody"), (None, "nobody"),
]


def test_exact_groups(documents, clashing):
    got = exact_dedup.dedup_exact(clashing(documents([(d, t, "s") for d, t in ROWS]))).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == plain_exact(ROWS)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.text_sha256 for r in got})


def test_exact_documents(documents, clashing):
    docs = clashing(documents([(d, t, "s") for d, t in ROWS]))
    left = exact_dedup.keep_documents(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(
        [2, 3, 5, 6, 7, 8, None, 10, 11, None]
    )


def test_exact_hot_group(documents):
    """A group past the share that counts as hot, in many runs."""
    rows = [(i, "copy" if i % 3 else f"own {i}", "s") for i in range(3000)]
    docs = documents(rows).repartition(13)
    got = exact_dedup.dedup_exact(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == plain_exact(
        [(d, t) for d, t, _ in rows]
    )


@pytest.mark.parametrize("keep", [exact_dedup.keep_documents, near_dup.keep_documents])
def test_empty_table(documents, keep):
    assert keep(documents([])).collect() == []


def shingle_set(text):
    words = near_dup_words(text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    grams = grams or ([tuple(words)] if words else [])
    seen, out = Counter(), set()
    for gram in grams:
        out.add((gram, seen[gram]))
        seen[gram] += 1
    return out


def near_dup_words(text):
    import re

    return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").translate(FOLD))


def plain_classes(texts):
    """Components of the pairs whose shingles are similar; without words, of equal texts."""
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingle_set(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            total = len(sets[i]) + len(sets[j]) - both
            same = (texts[i] or "") == (texts[j] or "")
            if both >= near_dup.SIMILAR * total if total else same:
                parent[find(i)] = find(j)
    roots = [find(i) for i in range(len(texts))]
    return {frozenset(i for i, r in enumerate(roots) if r == root) for root in set(roots)}


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        at = rng.randrange(len(words))
        if rng.random() < 0.5:
            words[at] = f"new{rng.randrange(10**6)}"
        else:
            words.insert(at, f"add{rng.randrange(10**6)}")
    return words


def test_near_classes(documents, clashing):
    rng = random.Random(3)
    texts = [None, "", "...", "...", "two words", "Two, words!", "other words", "one"]
    passage = [f"p{i}" for i in range(60)]
    for _ in range(25):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(20, 400))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(4)):
            texts.append(" ".join(edited(rng, words, rng.choice([0, 1, 2, 4, 12, 40]))))
        texts.append(" ".join(words[:60] + passage))  # many share a passage
    texts.append(" ".join(["again"] * 3000))
    texts.append(" ".join(["again"] * 2990))
    docs = clashing(documents(texts))
    got = defaultdict(set)
    rows = near_dup.classify(docs).collect()
    for row in rows:
        got[row.class_id].add(row.doc_id)
    assert len(rows) == len(texts)
    assert {frozenset(v) for v in got.values()} == plain_classes(texts)
    assert all(r.class_size == len(got[r.class_id]) for r in rows)
    assert Counter(r.class_id for r in rows if r.kept) == Counter(dict.fromkeys(got, 1))
    left = near_dup.keep_documents(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(got)


def test_near_repeats_and_nulls(documents):
    text = "a b c d e f g h i j"
    rows = [(None, text, "s"), (7, text, "s"), (7, text, "s"), (None, "x y z", "s")]
    got = near_dup.classify(documents(rows)).collect()
    assert sorted((r.class_size, r.class_id or -1) for r in got) == [(1, -1), (3, 7), (3, 7), (3, 7)]
    assert sum(r.kept for r in got) == 2
    left = near_dup.keep_documents(documents(rows)).collect()
    assert Counter(r.doc_id for r in left) == Counter([7, None])


def test_near_hot_group(documents):
    """One large group of near copies that differ in one word each."""
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join([*base[: i % 120], f"v{i}", *base[i % 120 :]]) for i in range(1500)]
    texts += [" ".join(f"u{i}x{j}" for j in range(30)) for i in range(500)]
    got = near_dup.classify(documents(texts)).collect()
    sizes = Counter(r.class_size for r in got)
    assert sizes == {1500: 1500, 1: 500}


def template_family(size, pairs, seed):
    """Texts of one template, about 0.78 to each other, but the first pairs, about 0.82."""
    rng = random.Random(seed)
    template = [f"t{i}" for i in range(700)]
    texts = []
    for i in range(size):
        both = [f"b{i // 2}x{j}" for j in range(20)] if i < 2 * pairs else []
        own = [f"o{i}x{j}" for j in range(98 - len(both) + rng.randrange(-2, 3))]
        texts.append(" ".join([*template, *both, *own]))
    return texts


def all_links(texts):
    """Every similar pair, by counting what each two texts share."""
    sets = [shingle_set(t) for t in texts]
    everywhere = set.intersection(*sets)
    holders, both = defaultdict(list), Counter()
    for i, own in enumerate(sets):
        for shingle in own - everywhere:
            holders[shingle].append(i)
    for held in holders.values():
        both.update((i, j) for i in held for j in held if i < j)
    return {
        (i, j)
        for i in range(len(sets))
        for j in range(i + 1, len(sets))
        if (n := len(everywhere) + both[i, j])
        >= near_dup.SIMILAR * (len(sets[i]) + len(sets[j]) - n)
    }


def test_near_pairs_of_template(documents):
    """No similar pair is lost among many texts that share sketches and are unlike."""
    texts = template_family(600, 60, 5)
    wanted = all_links(texts)
    assert wanted == {(2 * i, 2 * i + 1) for i in range(60)}
    got = defaultdict(list)
    for row in near_dup.classify(documents(texts)).collect():
        got[row.class_id].append(row.doc_id)
    assert {tuple(sorted(v)) for v in got.values() if len(v) > 1} == wanted


def test_near_stars_without_links(documents, monkeypatch):
    """That the chosen nodes link nothing does not end the search."""
    stars = near_dup._star_pairs
    monkeypatch.setattr(near_dup, "_star_pairs", lambda rows: stars(rows).limit(0))
    texts = template_family(300, 60, 6)
    sizes = Counter(r.class_size for r in near_dup.classify(documents(texts)).collect())
    assert sizes == {2: 120, 1: 180}


def test_unlike_texts_of_template_do_not_meet(documents, monkeypatch):
    """Texts that share rare shingles and are unlike are told apart without their texts."""
    rng = random.Random(8)
    template = [f"t{i}" for i in range(700)]
    texts = []
    for i in range(240):
        words = template.copy()
        for place in rng.sample(range(700), 12):
            words[place] = f"o{i}x{place}"
        texts.append(" ".join(words))
    met, linked = [], near_dup._linked

    def counted(pairs, texts):
        met.append(pairs.count())
        return linked(pairs, texts)

    monkeypatch.setattr(near_dup, "_linked", counted)
    wanted = all_links(texts)
    assert len(wanted) < 100
    got = [set(c) for c in plain_classes(texts)]
    rows = defaultdict(set)
    for row in near_dup.classify(documents(texts)).collect():
        rows[row.class_id].add(row.doc_id)
    assert sorted(map(sorted, rows.values())) == sorted(map(sorted, got))
    assert len(met) == 3 and met[2] < 200


def test_marks_differ_by_unshared_shingles_at_most():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), "", *(" ".join(edited(rng, words, n)) for n in (0, 1, 9, 80, 400))]
    labelled, counts = near_dup.shingles(texts)
    own = [set(x.tolist()) for x in near_dup._split(texts)]
    bits = near_dup.marks(labelled, counts)
    for a, one in zip(own, bits):
        for b, other in zip(own, bits):
            differ = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in one ^ other)
            assert differ <= len(a ^ b)
            assert (differ > 0) == (a != b)


def test_alignment_sees_order():
    a = " ".join(f"w{i}" for i in range(100))
    moved = " ".join(f"w{i}" for i in [*range(50, 100), *range(50)])
    x, y = near_dup._split([a, moved])
    assert near_dup.aligned(x, x) == 1.0
    assert near_dup.aligned(x, y) == 0.0
