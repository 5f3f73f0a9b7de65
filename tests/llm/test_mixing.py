"""Targets by water-filling, whole documents, training positions."""

import hashlib
from collections import defaultdict

import pytest

from sluice.llm import mixing


def plain_targets(sizes):
    """Share, stop at three times the size, share the excess again, until none is above."""
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda x: (x is None, x)))}
    total, capped, target = sum(sizes.values()), {}, {}
    while True:
        rest, open_ = total - sum(capped.values()), [s for s in sizes if s not in capped]
        target = {s: rest * weights[s] / sum(weights[o] for o in open_) for s in open_}
        over = [s for s in open_ if target[s] > 3 * sizes[s]]
        if not over:
            return target | capped
        capped |= {s: 3 * sizes[s] for s in over}


def rows_of(sizes_by_source):
    i, out = 0, []
    for s, sizes in sizes_by_source.items():
        for n in sizes:
            out.append((i, " ".join(["w"] * n), s))
            i += 1
    return out


CASES = [
    {"a": [10] * 40, "b": [3, 5, 100] * 10, "c": [1]},
    {"a": [1000], "b": [1] * 5, None: [7, 0, 3], "é": [20] * 9, "Z": [2] * 3},
    {"hot": [4, 9, 30, 2] * 60, **{f"s{i}": [i + 1] * 12 for i in range(12)}},
    {"only": [5, 5, 5]}, {"a": [0, 0], "b": [3]},
]


@pytest.mark.parametrize("case", CASES)
def test_targets_and_taken_words(documents, case):
    rows = [r.asDict() for r in mixing.mixed(documents(rows_of(case))).collect()]
    source_of = {i: s for i, _, s in rows_of(case)}
    sizes = {s: sum(v) for s, v in case.items()}
    want, taken = plain_targets(sizes), defaultdict(int)
    assert len(rows) == len(source_of)
    for r in rows:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        assert (r["first_position"] is None) == (r["copies"] == 0) and (r["first_position"] or 0) <= 1
        taken[s] += r["taken"]
    for s in sizes:
        assert taken[s] <= want[s] + 1e-6
        # Less is missing than the smallest document that was left out in the last pass holds.
        assert want[s] - taken[s] < max(case[s]) + 1e-6


def test_reruns_agree_and_positions_are_sorted(documents):
    docs = documents(rows_of(CASES[2])).repartition(5)
    one, two = mixing.mixed(docs), mixing.mixed(docs.repartition(3))
    assert sorted(one.collect(), key=str) == sorted(two.collect(), key=str)
    positions = [r.first_position for r in one.collect() if r.first_position is not None]
    assert positions == sorted(positions)


def test_training_order_repeats_rows_and_keeps_columns(documents):
    docs = documents(rows_of(CASES[0])).withColumnRenamed("lang", "mix_size").withColumnRenamed("n_chars", "_sum")
    plan = {r.doc_id: r.copies for r in mixing.mixed(docs).collect()}
    out = mixing.training_order(docs)
    counts = defaultdict(int)
    for r in out.collect():
        counts[r.doc_id] += 1
    assert out.columns == docs.columns and counts == {i: n for i, n in plan.items() if n}


def test_schedules_shift_sources_over_time(documents):
    """The second source starts heavy, the third one late."""
    rows = mixing.training_order(documents(rows_of({"a": [5] * 300, "b": [5] * 300, "c": [5] * 300}))).collect()
    middle = len(rows) // 2
    early, late = ({s: sum(r.source == s for r in part) for s in "abc"} for part in (rows[:middle], rows[middle:]))
    assert early["b"] > late["b"] and early["c"] < late["c"] and abs(early["a"] - late["a"]) < 30


def test_edges(documents):
    assert mixing.mixed(documents([])).collect() == []
    assert mixing.training_order(documents([])).collect() == []
    rows = mixing.mixed(documents([(1, None, None), (1, None, None), (None, "a b", "s"), (None, "a b", "s"), (2, "x " * 40_000, "s")])).collect()
    assert len(rows) == 5 and sorted(r.size for r in rows) == [0, 0, 2, 2, 40_000]


def plain_last_pass(docs, left):
    """Ids that the last pass takes from (id, size): a prefix in digest order, then the largest that fit."""
    fits, total, order = [], 0, sorted(docs, key=lambda d: hashlib.md5(str(d[0]).encode()).hexdigest())
    order = [d for d in order if 0 < d[1] <= left]
    while len(fits) < len(order) and total + order[len(fits)][1] <= left:
        total += order[len(fits)][1]
        fits.append(order[len(fits)])
    for d in sorted(order[len(fits):], key=lambda d: -d[1]):
        if total + d[1] <= left:
            total += d[1]
            fits.append(d)
    return {i for i, _ in fits}


LONG = {"a": [2933] + [11, 30, 64, 150] * 9, "b": [900, 700] + [1, 2, 40] * 15, "c": [8] * 30 + [500] * 3, "d": [10, 2000]}


@pytest.mark.parametrize("case", [*CASES, LONG])
def test_last_pass_leaves_out_no_document_that_fits(documents, case):
    made = rows_of(case)
    rows = {r.doc_id: r for r in mixing.mixed(documents(made)).collect()}
    for s, sizes in case.items():
        of_source = [(i, rows[i].size) for i, _, x in made if x == s]
        target = rows[of_source[0][0]].target
        passes = min(int(target // sum(sizes)), 3) if sum(sizes) else 0
        left = target - passes * sum(sizes) if passes < 3 else 0
        want = plain_last_pass(of_source, left)
        assert {i for i, n in of_source if n and rows[i].copies > passes} == want
        out = [n for i, n in of_source if n and i not in want]
        short = target - sum(rows[i].taken for i, _ in of_source)
        assert passes == 3 or not out or short < min(out)


def test_positions_of_the_last_pass_do_not_overlap(documents):
    """The last copies of a source lie one after the other, up to what it takes."""
    plan, names = mixing.mix_plan(documents(rows_of(LONG)))
    last = defaultdict(list)
    for r in plan.filter(f"{names['mix_last_at']} IS NOT NULL").collect():
        last[r.source].append((r[names["mix_last_at"]], r[names["mix_size"]], r[names["mix_source_size"]]))
    for rows in last.values():
        at = rows[0][2] * (min(rows)[0] // rows[0][2])
        for start, size, _ in sorted(rows):
            assert start == at
            at += size
