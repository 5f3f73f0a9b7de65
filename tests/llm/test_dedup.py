"""BagMinHash near-dedup against brute force over all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from sluice.llm import bagminhash, common
from sluice.llm import components as components_module
from sluice.llm.common import WorkFolder
from sluice.llm.components import components


def bag(text):
    w = (text or "").encode().split()
    return Counter(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def plain_classes(rows):
    """Smallest id of each class: equal texts, or overlap of 0.8 and more, directly or by others."""
    rows = [(i, t, bag(t)) for i, t in rows if i is not None]
    root = {i: i for i, *_ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, t, a) in enumerate(rows):
        for j, u, b in rows[:n]:
            if t is not None and u is not None and (t == u or similarity(a, b) >= 0.8):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.randint(3, 150))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    # Multisets: the same shingles, other counts.
    texts += ["la " * n for n in (50, 54, 90, 200)] + [None, None, "", "", " ", "one", "one", "one two", "x " * 30_000]
    # A hot group of near copies, in more than one block, with strays.
    base = [word() for _ in range(120)]
    for n in range(260):
        copy = list(base)
        for _ in range(n % 7):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    texts += [texts[0]] * 40
    rng.shuffle(texts)
    return texts


def test_classes_equal_brute_force(spark, documents):
    texts = corpus()
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, texts[5], "s"), (None, None, "s")]
    got = bagminhash.near_duplicates(documents(rows)).collect()
    assert len(got) == len(rows)
    assert sum(r.doc_id is None and r.class_id is None for r in got) == 2
    classes = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert classes == plain_classes([r[:2] for r in rows])


def test_chain_of_small_buckets(spark, documents):
    rng = random.Random(8)
    words = [str(rng.random()) for _ in range(400)]
    texts = [" ".join(words[i : i + 100]) for i in range(0, 300, 3)]
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(documents(texts)).collect()}
    assert got == plain_classes(list(enumerate(texts)))


def near_copies(n):
    rng = random.Random(n)
    base = [str(rng.random()) for _ in range(120)]
    texts = []
    for _ in range(n):
        copy = list(base)
        copy[rng.randrange(120)] = str(rng.random())
        texts.append(" ".join(copy))
    return texts


def test_work_on_a_group_of_near_copies_is_in_proportion(spark, documents, monkeypatch):
    """Links and compared pairs of a group grow with its rows, not with their square."""
    made = {}
    write = WorkFolder.write

    def counted(self, df, name):
        out = write(self, df, name)
        if name.startswith(("links", "pairs")):
            made[n] = made.get(n, 0) + out.count()
        return out

    monkeypatch.setattr(WorkFolder, "write", counted)
    for n in (200, 400):
        got = bagminhash.near_duplicates(documents(near_copies(n))).collect()
        assert {r.class_id for r in got} == {0}
    assert made[400] < 2.5 * made[200] and made[400] < 12 * 400


def test_a_bucket_of_unlike_texts_is_compared_in_full(spark):
    """Texts that share every bucket and a passage, in pairs that are similar only to each other."""
    rng = random.Random(11)
    rows, sets, passage = [], [], [str(rng.random()) for _ in range(60)]
    for i in range(150):
        words = [str(rng.random()) for _ in range(120)]
        for j in range(2):
            other = list(words)
            other[rng.randrange(120)] = str(rng.random())
            rows.append((2 * i + j, 0, 1))
            found = bagminhash.shingles(" ".join(other + passage))
            sets.append((2 * i + j, bytearray(bagminhash.occurrences(found).tobytes()), bytearray(25 * 8)))
    met = spark.createDataFrame(rows, "id long, band int, key long")
    sizes = spark.createDataFrame([(r[0], 176) for r in rows], "id long, n long")
    found = bagminhash.similar_classes(met, sizes, spark.createDataFrame(sets, "id long, set binary, bands binary"), WorkFolder(spark, "t"))
    assert {r.id: r.component for r in found.collect()} == {i: i - i % 2 for i in range(300)}


def test_repeated_rows_and_empty_table(spark, documents):
    rows = [(7, "a b c d e f g", "s"), (7, "a b c d e f g", "s"), (9, "a b c d e f g", "s"), (8, "other words stand in this text", "s")]
    got = sorted((r.doc_id, r.class_id) for r in bagminhash.near_duplicates(documents(rows)).collect())
    assert got == [(7, 7), (7, 7), (8, 8), (9, 7)]
    assert sorted(r.doc_id for r in bagminhash.one_of_each(documents(rows)).collect()) == [7, 8]
    assert bagminhash.near_duplicates(documents([])).collect() == []


A = "one river ran past the old mill and people came to see it every single day of that long and warm year"
NEAR = " ".join([A] * 3 + ["end"])
FAR = "quite other words stand here and nothing of them is found in any of the texts that came before this one"


def test_texts_under_one_id_stay_apart(spark, documents):
    """Neither a shared id nor a near copy of one of its texts takes the other text along."""
    got = sorted(r.text for r in bagminhash.one_of_each(documents([(5, A, "s"), (5, FAR, "s")])).collect())
    assert got == sorted([A, FAR])
    rows = [(5, " ".join([A] * 3), "s"), (5, FAR, "s"), (1, NEAR, "s")]
    assert sorted((r.doc_id, r.class_id) for r in bagminhash.near_duplicates(documents(rows)).collect()) == [(1, 1), (5, 1), (5, 5)]
    assert sorted((r.doc_id, r.text) for r in bagminhash.one_of_each(documents(rows)).collect()) == [(1, NEAR), (5, FAR)]


def test_rows_without_an_id_are_compared(spark, documents):
    rows = [(None, " ".join([A] * 3), "s")] * 3 + [(None, NEAR, "s"), (None, FAR, "s"), (None, None, "s"), (None, None, "s"), (0, FAR, "s"), (4, None, "s")]
    kept = [(r.doc_id, r.text) for r in bagminhash.one_of_each(documents(rows)).collect()]
    assert len(kept) == 5 and sum(i is None and t in (" ".join([A] * 3), NEAR) for i, t in kept) == 1
    assert Counter(x for x in kept if x[0] is not None or x[1] is None) == {(0, FAR): 1, (4, None): 1, (None, None): 2}


def test_many_repeats_of_a_row_are_one_class(spark, documents):
    rows = [(5, " ".join([A] * 3), "s")] * 200 + [(6, NEAR, "s")]
    made = documents(rows)
    assert Counter(r.class_id for r in bagminhash.near_duplicates(made).collect()) == {5: 201}
    assert [(r.doc_id, r.text) for r in bagminhash.one_of_each(made).collect()] == [rows[0][:2]]


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 5, b"x"), (2, "a b c d e f", 6, b"y")], "doc_id int, text string, class_id int, copy binary")
    assert sorted((r.doc_id, r.class_id) for r in bagminhash.near_duplicates(df).collect()) == [(1, 1), (2, 1)]
    assert bagminhash.one_of_each(df).columns == df.columns


@pytest.mark.parametrize("edits,repeats", [(4, 0), (15, 0), (6, 30)])
def test_signatures_are_unbiased(edits, repeats):
    rng, errors = random.Random(edits), []
    for _ in range(80):
        a = [str(rng.random()) for _ in range(150)]
        b = list(a)
        for _ in range(edits):
            b[rng.randrange(150)] = str(rng.random())
        many = [str(rng.random()) for _ in range(6)]
        a, b = " ".join(a + many * repeats), " ".join(b + many * (repeats // 2))
        s = bagminhash.signatures([bagminhash.shingles(a), bagminhash.shingles(b)])
        errors.append((s[0] == s[1]).mean() - similarity(bag(a), bag(b)))
    assert abs(np.mean(errors)) < 4 * np.std(errors) / np.sqrt(len(errors)) + 0.002
    assert np.std(errors) < 0.06


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r.id: r.component for r in components(df, WorkFolder(spark, "t"), "t").collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert components(df.limit(0), WorkFolder(spark, "t"), "t").collect() == []


@pytest.mark.parametrize("similarity_", [0.8, 0.6])
def test_prefix_keys_lose_no_similar_pair(similarity_):
    """Every pair of sets similar enough shares a (band, key), whichever shingles count as common."""
    rng = random.Random(11)
    base = rng.sample(range(10**6), 160)
    sets = [frozenset([7])]
    for _ in range(220):
        kept = rng.sample(base, rng.randint(110, 160))
        sets.append(frozenset(kept + rng.sample(range(10**6, 10**6 + 400), rng.randint(0, 25))))
    held = Counter(x for s in sets for x in s)
    weight = {x: n if n > 30 else 0 for x, n in held.items()}
    met = []
    for s in sets:
        keys = np.array(sorted(s, key=lambda x: (weight[x], x)), np.int64)
        common = sum(weight[x] > 0 for x in s)
        met.append({(b, int(k)) for b, some in bagminhash.prefix_keys(keys, common, similarity_) for k in some})
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= similarity_ * len(sets[i] | sets[j])]
    assert len(pairs) > 100 and all(met[i] & met[j] for i, j in pairs)


def test_stars_cost_no_round(spark, tmp_path):
    """Links that are stars already are only looked at; others are contracted to stars."""
    folder = WorkFolder(spark, "stars", str(tmp_path))
    stars = spark.createDataFrame([(5, 1), (7, 1), (9, 8), (3, 3)], "a long, b long")
    found = {(r.id, r.component) for r in components(stars, folder, "s").collect()}
    assert found == {(1, 1), (5, 1), (7, 1), (8, 8), (9, 8)}
    assert not folder_names(spark, folder, "s-1")
    chain = spark.createDataFrame([(i + 1, i) for i in range(40)], "a long, b long")
    assert {r.component for r in components(chain, folder, "c").collect()} == {0}


def folder_names(spark, folder, name):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.path}/{name}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_classes_are_looked_up_once_per_text(spark, tmp_path):
    """The join with the classes has a row of each text, not of each bucket of it."""
    folder = WorkFolder(spark, "classed", str(tmp_path))
    state = bagminhash.Contraction(None, folder, 0.8)
    met = spark.createDataFrame([(i, b, 100 + i % 2) for i in range(4) for b in range(25)], "id long, band int, key long")
    assert state.add(spark.createDataFrame([(2, 0)], "a long, b long")) == 1
    first = state.classes
    assert state.add(spark.createDataFrame([], "a long, b long")) == 0 and state.classes is first
    assert state.add(spark.createDataFrame([(3, 2)], "a long, b long")) == 1
    out = state.classed_buckets(met)
    assert sorted(map(tuple, out.select("id", "band", "key", "component").collect())) == sorted(
        (i, b, 100 + i % 2, 0 if i != 1 else 1) for i in range(4) for b in range(25)
    )
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join LeftOuter")


def test_small_tables_cost_few_shuffles(spark, documents, tmp_path, monkeypatch):
    """A round of the components shuffles three times, stars once; the whole job on few texts a bounded number of times."""
    shuffles, write = [], WorkFolder.write

    def counted(self, df, name):
        shuffles.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return write(self, df, name)

    monkeypatch.setattr(WorkFolder, "write", counted)
    folder = WorkFolder(spark, "shuffles", str(tmp_path))
    links = spark.createDataFrame([(5, 1), (7, 1), (9, 8), (8, 7)], "a long, b long")
    assert {r.component for r in components(links, folder, "c").collect()} == {1}
    assert sum(shuffles) <= 12
    shuffles.clear()
    stars = components(spark.createDataFrame([(5, 1), (7, 1)], "a long, b long"), folder, "s")
    assert sorted(map(tuple, stars.collect())) == [(1, 1), (5, 1), (7, 1)] and sum(shuffles) == 1
    shuffles.clear()
    assert {r.class_id for r in bagminhash.near_duplicates(documents(near_copies(60))).collect()} == {0}
    assert sum(shuffles) <= 45


@pytest.mark.parametrize("small", [0, 50_000])
def test_results_do_not_hang_on_what_is_broadcast(spark, documents, monkeypatch, small):
    monkeypatch.setattr(common, "SMALL_ROWS", small)
    monkeypatch.setattr(components_module, "SMALL_ROWS", small)
    texts = corpus(5)
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(documents(texts)).collect()}
    assert got == plain_classes(list(enumerate(texts)))
