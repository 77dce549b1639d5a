"""Classifier, decontamination and near copies: planted cases, brute force, edge cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from newsloom.llm import components, decontamination, edit_lsh, ngram_join, quality_classifier, set_partition

R = random.Random(11)
VOCABULARY = [f"{a}{b}{c}" for a in "bdfgk" for b in ("a", "e", "io", "u") for c in ("n", "rt", "s", "lm", "th", "x", "p")]


def prose(n, r=R):
    return [r.choice(VOCABULARY) for _ in range(n)]


def edited(words, k, r=R):
    words = list(words)
    for _ in range(k):
        at = r.randrange(len(words))
        kind = r.randrange(3)
        if kind == 0:
            words[at] = f"new{r.randrange(10**6)}"
        elif kind == 1:
            words.insert(at, f"new{r.randrange(10**6)}")
        elif len(words) > 1:
            del words[at]
    return words


# --- classifier -----------------------------------------------------------


def labelled(n, r):
    rows = []
    for i in range(n):
        words = prose(r.randint(30, 120), r)
        grade = r.choice([2, 2, 2, 2, 1, 0])
        if grade == 1:
            words = [w.upper() + "!!" for w in words]
        if grade == 0:
            for insult in r.sample(["dolt", "oaf", "lout", "knave"], 3):
                words.insert(r.randrange(len(words)), insult)
        rows.append((i, " ".join(words), grade))
    return rows


def test_classifier_on_held_out_rows(spark):
    rows = labelled(3000, random.Random(5))
    docs = spark.createDataFrame([(i, t, "own") for i, t, _ in rows], "doc_id bigint, text string, kept string")
    labels = spark.createDataFrame(
        [(i, int(g == 2), int(g == 0)) for i, _, g in rows if i < 2000] + [(1, None, 0), (None, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    got = quality_classifier.rate_documents(docs, labels, fit_rows=1500)
    assert got.columns == ["doc_id", "text", "expected_grade", "p_good", "kept"]
    kept = {r.doc_id: (r.kept, r.expected_grade) for r in got.collect()}
    for grade, least in ((2, 0.99), (1, 0.95), (0, 0.95)):
        of = [kept[i][0] == (g == 2) for i, _, g in rows if i >= 2000 and g == grade]
        assert np.mean(of) >= least, grade
    means = [np.mean([kept[i][1] for i, _, g in rows if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]


def test_classifier_edge_cases(spark):
    model = quality_classifier.fit(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "x " * 100_000), (3, "x " * 100_000), (None, "a")], "doc_id bigint, text string"
    )
    rows = quality_classifier.classify(docs, model).collect()
    assert len(rows) == 5 and len({r.p_good for r in rows}) == 1
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert len({r.kept for r in quality_classifier.rate_documents(docs, labels).collect()}) == 1
    assert quality_classifier.rate_documents(docs, labels.limit(0)).count() == 5
    assert quality_classifier.rate_documents(docs.limit(0), labels).count() == 0


def test_the_fit_is_an_optimum():
    """No small step in any direction makes the graded rows likelier, beyond what rounding leaves."""
    r = np.random.default_rng(8)
    n, decay = 400, 2e-4
    grades = r.integers(0, 3, n)
    pairs = [(i, 3 + k) for i, g in enumerate(grades) for k in range(4) if r.random() < (0.15 + 0.35 * (g == k % 3))]
    rows, found = np.array(pairs).T
    found = found.astype(np.uint64)
    model = quality_classifier.fit(rows, found, grades, steps=4000, decay=decay)
    assert len(model.keys) >= 3

    def likelihood(weights, thresholds):
        scores = np.zeros(n)
        for i, f in pairs:
            at = np.searchsorted(model.keys, np.uint64(f))
            if at < len(model.keys) and model.keys[at] == f:
                scores[i] += weights[at]
        above = [np.ones(n), *(1 / (1 + np.exp(t - scores)) for t in thresholds), np.zeros(n)]
        p = [above[g][i] - above[g + 1][i] for i, g in enumerate(grades)]
        return np.log(p).mean() - decay / 2 * (weights**2).sum()

    best = likelihood(model.weights, model.thresholds)
    for k in range(len(model.weights) + 2):
        for step in (-0.05, 0.05):
            weights, thresholds = model.weights.copy(), model.thresholds.copy()
            if k < len(weights):
                weights[k] += step
            else:
                thresholds[k - len(weights)] += step
            assert likelihood(weights, thresholds) < best


def test_features_are_screened_alike_in_spark_and_here(spark):
    rows = labelled(600, random.Random(6))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(0, "zzz another text")], "doc_id bigint, text string")
    grades = spark.createDataFrame([(i, g) for i, _, g in rows], "doc_id bigint, grade int")
    model = quality_classifier.train(docs, grades)
    texts = [min(t, "zzz another text") if i == 0 else t for i, t, _ in rows]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    want = quality_classifier.fit(
        *quality_classifier.distinct(*quality_classifier.features(data, offsets)), np.array([g for *_, g in rows])
    )
    assert (model.keys == want.keys).all()
    assert np.allclose(model.weights, want.weights) and np.allclose(model.thresholds, want.thresholds)


def test_thresholds_stay_in_order():
    r = np.random.default_rng(2)
    grades = r.integers(0, 3, 500)
    rows = np.arange(500)
    model = quality_classifier.fit(rows, grades.astype(np.uint64) + np.uint64(7), grades)
    assert model.thresholds[0] < model.thresholds[1]
    tails = model.tails(model.scores(500, rows, grades.astype(np.uint64) + np.uint64(7)))
    assert ((tails[:, 1] > 0.5) == (grades == 2)).all() and ((tails[:, 0] > 0.5) == (grades >= 1)).all()


# --- decontamination ------------------------------------------------------


def distance_to_best(item, words):
    """Edit distance of the item to the best stretch, by plain dynamic programming."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(words, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def test_bit_parallel_distances():
    r = random.Random(4)
    for _ in range(200):
        item, words = [[r.randrange(4) for _ in range(r.randint(1, n))] for n in (12, 40)]
        mask = {}
        for k, w in enumerate(item):
            mask[w] = mask.get(w, 0) | 1 << k
        got = edit_lsh._distances(mask, len(item), words)
        assert min(got + [len(item)]) == distance_to_best(item, words)
        assert edit_lsh._whole(item, words)[-1] >= got[-1]


def test_leaks_against_brute_force(spark):
    r = random.Random(8)
    items = [prose(n, r) for n in (5, 6, 8, 12, 17, 25, 26, 40, 41, 60, 90, 150, 400)]
    texts, planted = [], []
    for i, item in enumerate(items):
        most = int(0.1 * len(item))
        for k in sorted({0, 0, most // 2, most}):
            planted.append((len(texts), i, k))
            texts.append(" ".join(prose(r.randint(0, 60), r) + edited(item, k, r) + prose(r.randint(0, 60), r)))
        texts.append(" ".join(prose(30, r) + item[: len(item) // 2] + prose(30, r)))
    texts += [" ".join(prose(200, r)) for _ in range(30)]
    texts += [None, "", " ".join(items[5] * 3), "\n".join(w.upper() + "," for w in items[6])]
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id bigint, text string, leaks string")
    table = spark.createDataFrame(
        [(i, " ".join(x)) for i, x in enumerate(items)] + [(90, None), (91, ""), (92, "too few words"), (None, "")],
        "item_id bigint, text string",
    )
    got = decontamination.find_leaks(docs, table)
    found = defaultdict(set)
    for x in got.collect():
        found[x.doc_id].add(x.item_id)
        stretch = texts[x.doc_id].encode()[x.start_byte : x.end_byte].decode()
        words = re.findall(r"[a-z0-9]+", stretch.lower())
        assert distance_to_best(items[x.item_id], words) == x.edits <= int(0.1 * len(items[x.item_id]))
    split = [re.findall(r"[a-z0-9]+", (t or "").lower()) for t in texts]
    want = {
        (d, i) for d, w in enumerate(split) for i, x in enumerate(items) if distance_to_best(x, w) <= int(0.1 * len(x))
    }
    have = {(d, i) for d, s in found.items() for i in s}
    assert have <= want and len(have) >= 0.95 * len(want)
    assert all(i in found[d] for d, i, k in planted if k == 0)
    assert got.filter(f"doc_id = {len(texts) - 2}").count() == 3
    clean = decontamination.decontaminate(docs, table)
    assert {x.doc_id for x in clean.collect()} == set(range(len(texts))) - set(found)
    assert clean.columns == docs.columns
    several = decontamination.find_leaks(docs, table, block=4)
    assert {(x.doc_id, x.item_id) for x in several.collect()} >= {(d, i) for d, i, k in planted if k == 0}
    assert decontamination.find_leaks(docs.limit(0), table).count() == 0
    assert decontamination.find_leaks(docs, table.limit(0)).count() == 0


def test_recall_is_measured():
    items = [np.array([hash((i, k)) & (2**63 - 1) for k in range(40)], np.uint64) for i in range(150)]
    index = edit_lsh.Index(items, 0.1, 0.97)
    assert index.recall >= 0.97 and index.edits == [4] * 150


def test_every_size_band_has_the_recall():
    r = np.random.default_rng(4)
    sizes = [8] * 160 + [20] * 20 + [100] * 20 + [150] * 4
    items = [r.integers(1 << 62, size=n).astype(np.uint64) for n in sizes]
    index = edit_lsh.Index(items, 0.1, 0.97)
    assert index.recall == min(index.recalls.values()) >= 0.97
    # Edits other than those that the index was made with.
    for size in (8, 20, 100, 150):
        own = [i for i, n in enumerate(sizes) if n == size] * (400 // sizes.count(size))
        text, starts = index._trial(own, r)
        found = set()
        for item, start in index.candidates(text):
            for i, x in zip(item.tolist(), start.tolist()):
                found |= {k for k in np.flatnonzero(np.abs(starts - x) <= 4 + 2 * index.edits[i]).tolist() if own[k] == i}
        assert len(found) >= 0.94 * len(own), size


def test_a_recall_out_of_reach_is_refused(monkeypatch):
    monkeypatch.setattr(edit_lsh.Index, "_by_walk", lambda self, words, walk: iter(()))
    with pytest.raises(RuntimeError, match="8 to 8 words"):
        edit_lsh.Index([np.arange(8, dtype=np.uint64)], 0.1, 0.97)
    assert edit_lsh.Index([], 0.1, 0.97).recall == 1.0


# --- near copies ----------------------------------------------------------


def sets_of(texts):
    out = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def groups_by_brute_force(texts):
    sets = sets_of(texts)
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in texts}


def documents(spark, texts):
    rows = [(i, t, "own", 1) for i, t in texts.items()]
    return spark.createDataFrame(rows, "doc_id bigint, text string, key string, band int")


def test_groups_of_all_sizes(spark):
    r = random.Random(21)
    texts = [None, "", " \n", "One two", "one TWO", "one two three four five", "One two three four five six"]
    for n in (3, 5, 6, 8, 11, 20, 33, 36, 37, 48, 49, 70, 130, 500):
        base = prose(n, r)
        for _ in range(5):
            texts.append(" ".join(edited(base, r.randint(0, max(1, n // 25)), r)))
        texts.append(" ".join(base))
    texts.append(" ".join(prose(30_000, r)))
    texts.append(texts[-1] + " end")
    texts = dict(enumerate(texts))
    got = ngram_join.near_groups(documents(spark, texts))
    assert {x[0]: tuple(x[1:]) for x in got.collect()} == groups_by_brute_force(texts)


def test_frequent_segments_and_large_groups(spark):
    r = random.Random(22)
    passage, base = prose(60, r), [f"w{k}" for k in range(200)]
    texts = [" ".join(prose(r.randint(15, 50), r) + passage + prose(10, r)) for _ in range(120)]
    texts += [" ".join(edited(base, r.randint(1, 4), r)) for _ in range(110)]
    texts += [" ".join(edited(base, r.randint(6, 25), r)) for _ in range(20)]
    texts += [" ".join(base)] * 80
    other = base[:90] + [f"v{k}" for k in range(90)]
    texts += [" ".join(edited(other, r.randint(1, 5), r)) for _ in range(80)]
    r.shuffle(texts)
    texts = dict(enumerate(texts))
    got = ngram_join.near_groups(documents(spark, texts))
    assert {x[0]: tuple(x[1:]) for x in got.collect()} == groups_by_brute_force(texts)


def test_rows_without_id_repeated_rows_and_none(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "other words that stand alone"), (9, None), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter(tuple(x) for x in ngram_join.near_groups(docs).collect())
    assert got == {(None, 2, 4): 1, (4, 2, 4): 2, (None, 1, None): 1, (9, 0, 9): 2}
    kept = Counter((x.doc_id, x.text) for x in ngram_join.one_of_each(docs).collect())
    assert kept[4, "a b c d e f"] == 1 and kept[9, None] == 2
    assert ngram_join.near_groups(docs.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(10**9), r.randrange(10**9)) for _ in range(50)]
    chain = [r.randrange(10**12) for _ in range(60)]
    edges += list(zip(chain, chain[1:])) + [(5, 5), (chain[3], chain[40]), (chain[3], chain[40])]
    got = {x.node: x.root for x in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[c] for c in chain} == {min(chain)}
    assert all(got[a] == got[b] == min(a, b) for a, b in edges[:50])
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("texts", [["a b c d e f g"], [None, "", "x"]])
def test_shingles_of_slices(texts):
    from newsloom.llm.words import slices

    for _, data, offsets in slices(pa.array(texts, pa.string())):
        values, sizes = ngram_join.shingle_sets(data, offsets)
        assert sizes.tolist() == [len(s) for s in sets_of(dict(enumerate(texts))).values()]
        assert len(values) == sizes.sum()


@pytest.mark.parametrize("words", [1, 2, 3, 4, 5, 6])
def test_shingles_of_a_slice_with_few_words(words):
    text = " ".join("abcdef"[:words])
    long = np.frombuffer((text + " g h i j k l").encode(), np.uint8)
    values, sizes = ngram_join.shingle_sets(long[: len(text)], np.array([0, len(text)]))
    assert sizes.tolist() == [max(1, words - 4)] == [len(values)]
    # The same as beside another text.
    pair, both = ngram_join.shingle_sets(long, np.array([0, len(text), len(long)]))
    assert both[0] == sizes[0] and (pair[: both[0]] == values).all()


def test_an_entry_stays_short_when_sets_have_one_in_a_bucket():
    """As at many buckets, where the bytes of sets told with each entry made the shuffle grow faster than the input."""
    n = 5000
    r = np.random.default_rng(6)
    kinds = np.zeros(n, set_partition.KIND)
    kinds["set"], kinds["role"] = r.permutation(n), r.integers(0, 4, n)
    sig = np.sort(r.integers(0, 1 << 63, n).astype(np.uint64))
    blob = set_partition.pack(sig, np.arange(n), kinds)
    assert len(blob) < 9.1 * n
    got = set_partition.unpack(blob)
    want = {(int(s) & 0xFFFFFFFF, int(k["set"]), int(k["role"])) for s, k in zip(sig, kinds)}
    assert {(int(x["sig"]), int(x["set"]), int(x["role"])) for x in got} == want
    # Several entries of a set, more than 14 of one role among them.
    who = np.repeat([0, 1, 1, 2], [1, 20, 1, 3])
    few = np.array([(7, 1), (7, 0), (2**32 - 1, 0)], set_partition.KIND)
    got = set_partition.unpack(set_partition.pack(sig[: len(who)], who, few))
    assert Counter((int(x["set"]), int(x["role"])) for x in got) == {(7, 1): 1, (7, 0): 21, (2**32 - 1, 0): 3}


def test_parities_refuse_no_link_and_most_others():
    r = np.random.default_rng(7)
    refused = 0
    for n in [*range(1, 40), 100, 300, 341, 342, 1000, 5000] * 4:
        values = r.integers(0, 1 << 63, 2 * n).astype(np.uint64)
        one = values[:n]
        for common in {n, max(1, (6 * n + 6) // 7), (6 * n) // 7}:
            for more in {0, n - common, (n - common) // 2}:
                two = values[n - common : n + more]
                union = n + more
                linked = 100 * common >= 75 * union
                may = set_partition.may_link(n, set_partition.parity(one), len(two), set_partition.parity(two))
                assert may or not linked, (n, common, more)
        two = values[n // 2 : n + n // 2]
        refused += n >= 30 and not set_partition.may_link(n, set_partition.parity(one), n, set_partition.parity(two))
    assert refused >= 0.95 * 4 * 16


@pytest.mark.parametrize("bits", [1, 5])
def test_sets_with_one_short_number(spark, monkeypatch, bits):
    monkeypatch.setattr(ngram_join, "NUMBER_BITS", bits)
    r = random.Random(23)
    passage, texts = prose(40, r), []
    for n in (3, 5, 6, 20, 36, 49, 130):
        base = prose(n, r)
        texts += [" ".join(edited(base, r.randint(0, max(1, n // 25)), r)) for _ in range(3)]
    texts += [" ".join(prose(r.randint(5, 30), r) + passage) for _ in range(75)]
    texts = dict(enumerate(texts))
    got = ngram_join.near_groups(documents(spark, texts))
    assert {x[0]: tuple(x[1:]) for x in got.collect()} == groups_by_brute_force(texts)
